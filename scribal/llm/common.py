"""Pieces shared by the training-data operators."""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Callable, Iterable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

import scribal
from scribal.session import ensure_checkpoint_dir

#: A word is a longest run of characters other than these (ASCII white space).
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, read by Spark from wherever ``sf_dir`` lies."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Texts that one Arrow batch holds, where the session leaves Spark's default.
ROWS_PER_BATCH = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it,
    as when it is installed there too (else pass it by --py-files), and keep
    Arrow batches of texts small on both sides."""
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, str(ROWS_PER_BATCH))
    home = os.path.dirname(os.path.dirname(os.path.abspath(scribal.__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (home, known) if p)
    return spark


def words(text: Column) -> Column:
    """The words of ``text`` as an array; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def need(df: DataFrame, columns: Iterable[str]) -> None:
    """Fail early, and by name, when an input column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the input has {df.columns}")


_scopes = threading.local()


def _remove(spark: SparkSession, path: str) -> None:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def written(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, read back.

    Cuts the lineage where a result is used more than once or holds values
    (partition numbers, running ids) that must not be computed again after
    the loss of an executor. The folder is the one that spark.checkpoint.dir
    names; what is written is removed at the end of the ``frees_tables`` call
    that it belongs to, and else when the driver's session ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scribal-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    if getattr(_scopes, "open", None):
        _scopes.open[-1].append(path)
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0).cast("long")).alias("bytes"))
    writer = watched.write.partitionBy(partition_by) if partition_by else watched.write
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = seen.get  # rows and bytes, so that no job need count them
    return out


def frees_tables(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function whose result is written, and whose own tables are removed then."""

    @wraps(make)
    def run(*args, **named):
        if not hasattr(_scopes, "open"):
            _scopes.open = []
        _scopes.open.append(own := [])
        try:
            out = make(*args, **named)
            _scopes.open.pop()
            kept = written(out)
        except BaseException:
            if any(own is x for x in _scopes.open):
                _scopes.open.pop()
            raise
        for path in own:
            _remove(out.sparkSession, path)
        return kept

    return run


#: A table of up to this many bytes may be broadcast.
BROADCAST_BYTES = 48 << 20
_FIXED = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}


def _bytes_of(name: str, kind: str) -> Column:
    value = F.col(name)
    if kind in ("string", "binary"):
        size = F.octet_length(value) + 8
    elif kind.startswith("array<"):
        size = F.size(value) * 8 + 16
    else:
        size = F.lit(_FIXED.get(kind, 8 if "<" not in kind else 64))
    return F.coalesce(size, F.lit(8)).cast("long")


def _row_bytes(df: DataFrame) -> Column:
    return reduce(lambda a, b: a + b, [_bytes_of(f"`{c}`", kind) for c, kind in df.dtypes]) + 16


def small(df: DataFrame, most: int = BROADCAST_BYTES, of: DataFrame | None = None) -> DataFrame:
    """``df`` with a broadcast hint when its bytes are checked to be few; beyond
    that Spark joins it by a shuffle. For narrow rows of plain columns.

    What was written is known; ``of`` names a written table that ``df`` has no more
    rows and columns than. Else a job adds up the bytes."""
    known = getattr(df if of is None else of, "_written", None)
    size = known["bytes"] if known else df.agg(F.sum(_row_bytes(df))).first()[0] or 0
    return F.broadcast(df) if size <= most else df


def is_empty(df: DataFrame) -> bool:
    """Whether a table has no rows; what was written is known."""
    known = getattr(df, "_written", None)
    return known["rows"] == 0 if known else df.isEmpty()


def mark(text: Column) -> Column:
    """A number that tells apart the texts of rows with one key."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Each name, or one made from it, that no column of ``df`` has, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def one_of_equal(rows: DataFrame, many: DataFrame, same: Column, keys: list[str]) -> DataFrame:
    """``rows`` with one row of each group of ``keys`` that ``many`` names; the
    others, nearly all as a rule, are not shuffled."""
    if is_empty(many):
        return rows
    few = small(many)
    return rows.join(few, same, "left_anti").unionByName(rows.join(few, same, "left_semi").dropDuplicates(keys))


def keep_named(docs: DataFrame, judged: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with one row of every component: that of the least key, of several
    texts under it the one with the least mark, of equal rows one; ``judged`` has
    (key, mark, size, label, name) of every row. Rows of size 0 all stay."""
    k, m, own = unused(docs, "_key", "_mark", "_own")
    rows = written(judged.where("size > 0"))
    best = rows.where(F.col("key").eqNullSafe(F.col("name"))).groupBy("label").agg(F.min("mark").alias("best"))
    decided = written(rows.join(small(written(best)), "label").select(
        F.col("key").alias(k), F.col("mark").alias(m),
        (F.col("key").eqNullSafe(F.col("name")) & (F.col("mark") == F.col("best"))).alias("stays")))
    marked = docs.withColumn(own, mark(F.col(text)))
    same = F.col(key).eqNullSafe(F.col(k)) & (F.col(own) == F.col(m))
    kept = marked.join(small(written(decided.where("not stays").drop("stays").distinct())), same, "left_anti")
    many = decided.where("stays").groupBy(k, m).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return one_of_equal(kept, written(many), same, [key, own]).select(*docs.columns)
