"""Run manifest: a commit record per stage and part, written last.

A stage's record says what it was made from (``wanted``: the digest of its input
fingerprints and rule tables) and what it wrote (per table: rows, rows without
text, content fingerprint). It is removed before the stage writes anything and
written after the last of its tables, so whatever a stopped run has left behind,
a folder half moved included, has no record and is made again. A later run
compares records instead of folders: a stage is skipped only if its inputs and
rules are those of the record, and as records name contents, a stage that is
made again and writes the same rows lets the stages after it be skipped.

Rows, empty texts and fingerprints are observed while a table is written: nothing
is read back to count it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scribal.operators.stats import fingerprint
from scribal.session import path_exists, qualified, remove_path

FOLDER = "manifest"
#: One part of a stage that has no parts of its own.
WHOLE = "all"


@dataclass(frozen=True)
class Output:
    """What a stage wrote to one table."""

    rows: int
    empty: int
    content: str


@dataclass(frozen=True)
class Record:
    """What a part of a stage was made from and what it wrote."""

    stage: str
    part: str
    wanted: str
    outputs: Mapping[str, Output] = field(default_factory=dict)


def digest(*values) -> str:
    """A digest of plain values (rule tables, fingerprints, parameters)."""
    return hashlib.sha256(json.dumps(values, ensure_ascii=False, sort_keys=True, default=list).encode()).hexdigest()


def file_fingerprint(spark: SparkSession, path: str, content: bool = True) -> str:
    """T6 over the files below ``path``: their names there, lengths and contents
    (or, without ``content``, the times of their last change: nothing is read)."""
    if not path_exists(spark, path):
        return "absent"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.substr(F.col("path"), F.lit(len(qualified(spark, path)) + 1))
    held = F.sha2("content", 256) if content else F.col("modificationTime").cast("string")
    row = fingerprint(files.select(name.alias("name"), "length", held.alias("held")), ["name", "length", "held"]).first()
    return f"{row['n_rows']}/{row['fingerprint']}"


def write_observed(df: DataFrame, path: str, text: Column | None = None, partition_by: Sequence[str] = ()) -> Output:
    """Write ``df`` as Parquet and give the rows, the rows whose ``text`` is empty and
    the content fingerprint that were observed on the way."""
    nested = [c for c, kind in df.dtypes if "<" in kind]
    parts = [F.to_json(F.struct(F.col(c).alias("v"))) if c in nested else F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    h = F.sha2(F.concat_ws("\u001f", *parts), 256)
    seen = Observation()
    watched = df.observe(
        seen, F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(text, F.lit("")) == "").alias("empty") if text is not None else F.lit(0).alias("empty"),
        F.coalesce(F.sum(F.conv(F.substring(h, 1, 15), 16, 10).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("content"))
    writer = watched.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)
    got = seen.get
    return Output(int(got.get("rows") or 0), int(got.get("empty") or 0), str(got.get("content") or 0))


def _path(stage_dir: str, stage: str, part: str) -> str:
    return f"{stage_dir.rstrip('/')}/{FOLDER}/stage={stage}/part={part}"


_OUTPUT = T.StructType([T.StructField("table", T.StringType()), T.StructField("rows", T.LongType()),
                        T.StructField("empty", T.LongType()), T.StructField("content", T.StringType())])
_RECORD = T.StructType([T.StructField("wanted", T.StringType()), T.StructField("outputs", T.ArrayType(_OUTPUT))])


def read_record(spark: SparkSession, stage_dir: str, stage: str, part: str = WHOLE) -> Record | None:
    path = _path(stage_dir, stage, part)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return None
    row = spark.read.schema(_RECORD).json(path).first()
    if row is None:
        return None
    return Record(stage, part, row["wanted"], {o["table"]: Output(o["rows"], o["empty"], o["content"]) for o in row["outputs"] or ()})


def drop_record(spark: SparkSession, stage_dir: str, stage: str, part: str = WHOLE) -> None:
    remove_path(spark, _path(stage_dir, stage, part))


def write_record(spark: SparkSession, stage_dir: str, record: Record) -> None:
    """The last thing a stage does: one row; it counts once its folder is committed."""
    rows = [(record.wanted, [(t, o.rows, o.empty, o.content) for t, o in sorted(record.outputs.items())])]
    spark.createDataFrame(rows, _RECORD).coalesce(1).write.mode("overwrite").json(_path(stage_dir, record.stage, record.part))


def stage_metrics(spark: SparkSession, stage_dir: str) -> DataFrame:
    """T4: ``(stage, part, table, n_rows, n_empty)`` of all committed stages, from
    their records."""
    path = f"{stage_dir.rstrip('/')}/{FOLDER}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "stage string, part string, table string, n_rows bigint, n_empty bigint")
    named = T.StructType([*_RECORD.fields, T.StructField("stage", T.StringType()), T.StructField("part", T.StringType())])
    records = spark.read.schema(named).option("recursiveFileLookup", False).json(path)
    return records.select("stage", "part", F.explode("outputs").alias("o")).select(
        "stage", "part", F.col("o.table").alias("table"), F.col("o.rows").alias("n_rows"), F.col("o.empty").alias("n_empty"))
