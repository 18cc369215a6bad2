"""Giving CPU-heavy stages enough parallelism over few input splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Session setting: deal every input table to this many partitions. Unset (the
#: default, and right for large inputs) leaves the splits as they are read.
#: Text rules are CPU-bound per row, so a small single-file table, which arrives
#: as one split, gains from it.
PARTITIONS_SETTING = "scribal.input.partitions"


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin repartition to ``partitions``; None leaves ``df`` as it is.

    The rows' order changes: what depends on it must carry an explicit order
    column (see :func:`scribal.operators.collate.with_ord`).
    """
    return df if partitions is None else df.repartition(partitions)


def input_partitions(spark: SparkSession) -> int | None:
    """The setting's value, None when unset."""
    value = spark.conf.get(PARTITIONS_SETTING, None)
    return int(value) if value else None
