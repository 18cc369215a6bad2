"""Rule tables from their JSON files.

Rule files are small configuration (tens to a few hundred pairs). Spark reads
them, from whatever store they lie in; the pairs keep their order, which is
part of a rule table's meaning, and are compiled into column expressions.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def load_pairs(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Ordered ``(old, new)`` pairs from a JSON object or a list of pairs."""
    data = json.loads(spark.read.option("wholetext", True).text(path).first()["value"])  # dicts keep member order
    if isinstance(data, dict):
        return [(str(k), str(v)) for k, v in data.items()]
    return [(str(a), str(b)) for a, b in data]


def rules_frame(spark: SparkSession, pairs: Sequence[tuple[str, str]], name: str) -> DataFrame:
    """A rule table as a DataFrame ``(rule, rule_no, old, new)`` for joins or
    reporting; ``rule_no`` preserves the order."""
    rows = [(name, i, a, b) for i, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(rows, "rule string, rule_no int, old string, new string")
