"""Quality reports: bracket balance (Q2); substring checks (Q1) are steps of the cleaning chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BROKEN = -1_000_000  # sticky marker: a closing bracket without an opener


def bracket_balance(df: DataFrame, text_col: str, id_col: str, first_line_only: bool = False) -> DataFrame:
    """Lines whose square brackets do not cancel out.

    Cancelling ``[]`` pairs repeatedly leaves a non-empty residue exactly
    when a running depth goes negative or does not end at zero. Returns
    ``(id, line_no, line)`` for every unbalanced line (0-based line_no).
    ``first_line_only`` restricts the check to the first line, as the
    upstream pipeline's check does.
    """
    lines = df.select(
        F.col(id_col), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line_no", "line")
    )
    if first_line_only:
        lines = lines.filter(F.col("line_no") == 0)
    brackets = F.regexp_replace(F.col("line"), r"[^\[\]]", "")
    steps = F.transform(F.split(brackets, ""), lambda c: F.when(c == "[", 1).otherwise(-1))
    depth = F.aggregate(
        steps,
        F.lit(0),
        lambda acc, d: F.when(acc < 0, acc).when(acc + d < 0, F.lit(_BROKEN)).otherwise(acc + d),
    )
    return (
        lines.filter(brackets != "")
        .withColumn("depth", depth)
        .filter(F.col("depth") != 0)
        .select(id_col, F.col("line_no").cast("bigint").alias("line_no"), "line")
    )
