"""Keep-first over landings that arrive one by one.

A store holds the rows that are first of their key among all landings so far. A
landing is matched against a persistent index of key hashes and order numbers; the
rows of earlier landings are not read again. As "first" is decided by the order
number and not by the time of arrival, a later landing may bring a row that
comes before one that is stored: the stored one is then listed as gone. So
whatever the order in which landings arrive, the rows are those of one keep-first
over all of them.

Layout below the store's folder, one folder per landing in each table:

* ``index``: (hash, ord) of the keys whose least order number the landing set, in
  folders by hash bucket, so a lookup reads the buckets that the landing asks for;
* ``rows``: the landing's rows that came first when it arrived;
* ``gone``: (hash, ord) of stored rows that the landing has come before;
* ``landed``: the commit record, written last. Without it the landing does not
  exist: what a stopped one has left is removed when it is landed again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scribal.operators.collate import ORD, keep_first, key_hash
from scribal.session import materialize, path_exists, remove_path

_HASH, _PREVIOUS = "_hash", "_previous"
_TABLES = ("index", "rows", "gone")
_ENTRY = T.StructType([T.StructField(_HASH, T.StringType()), T.StructField(ORD, T.LongType())])


class KeepFirstStore:
    """The first row per key of all landings in ``path``.

    ``order_col`` holds whole numbers; of two landings' rows with one key and one
    number, that of the landing committed first stays.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order_col: str = ORD, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.order_col, self.buckets = list(keys), order_col, buckets

    def _folder(self, table: str, landing: str) -> str:
        return f"{self.path}/{table}/landing={landing}"

    def landings(self) -> list[str]:
        """Names of the committed landings."""
        if not path_exists(self.spark, f"{self.path}/landed"):
            return []
        found = self.spark.read.schema("landing string").json(f"{self.path}/landed")
        return sorted(r["landing"] for r in found.select("landing").distinct().collect())  # one row per landing

    def _read(self, table: str, schema: T.StructType) -> DataFrame | None:
        folders = [f for f in (self._folder(table, x) for x in self.landings()) if path_exists(self.spark, f)]
        return self.spark.read.schema(schema).parquet(*folders) if folders else None

    def _known(self, hashes: DataFrame) -> DataFrame:
        """``(hash, previous)``: what the index holds for these keys."""
        schema = T.StructType([*_ENTRY.fields, T.StructField("bucket", T.IntegerType())])
        parts = []
        for landing in self.landings():
            folder = self._folder("index", landing)
            if path_exists(self.spark, folder):  # its partition folders are found below a base of its own
                parts.append(self.spark.read.schema(schema).option("basePath", folder).parquet(folder))
        if not parts:
            return self.spark.createDataFrame([], f"{_HASH} string, {_PREVIOUS} bigint")
        index = parts[0]
        for part in parts[1:]:
            index = index.unionByName(part)
        met = index.join(hashes.select("bucket", _HASH), ["bucket", _HASH], "left_semi")
        return met.groupBy(_HASH).agg(F.min(ORD).alias(_PREVIOUS))

    def land(self, df: DataFrame, landing: str) -> None:
        """Add a landing; one that is there already is left as it is."""
        if not landing.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a landing's name has letters, digits, - and _ only")
        if path_exists(self.spark, f"{self._folder('landed', landing)}/_SUCCESS"):
            return
        for table in (*_TABLES, "landed"):
            remove_path(self.spark, self._folder(table, landing))
        number = F.coalesce(key_hash(df, self.keys).cast("string"), F.lit("null"))
        first = keep_first(df.select("*", number.alias(_HASH)), [_HASH], self.order_col)
        first = materialize(first)
        asked = first.select(_HASH, F.col(self.order_col).cast("bigint").alias(ORD),
                             F.pmod(F.xxhash64(_HASH), F.lit(self.buckets)).cast("int").alias("bucket"))
        matched = asked.join(self._known(asked), _HASH, "left")
        won = materialize(matched.filter(F.col(_PREVIOUS).isNull() | (F.col(ORD) < F.col(_PREVIOUS))))
        won.select(_HASH, ORD, "bucket").repartition("bucket").write.partitionBy("bucket").parquet(self._folder("index", landing))
        won.filter(F.col(_PREVIOUS).isNotNull()).select(_HASH, F.col(_PREVIOUS).alias(ORD)).write.parquet(self._folder("gone", landing))
        lost = asked.join(won, _HASH, "left_anti").select(_HASH)
        first.join(lost, _HASH, "left_anti").write.parquet(self._folder("rows", landing))
        self.spark.createDataFrame([(landing,)], "landing string").coalesce(1).write.json(self._folder("landed", landing))

    def rows(self) -> DataFrame | None:
        """The first row per key of all committed landings; None if there is none."""
        folders = [self._folder("rows", x) for x in self.landings()]
        if not folders:
            return None
        stored = self.spark.read.parquet(*folders)
        gone = self._read("gone", _ENTRY)
        if gone is not None:
            gone = gone.select(_HASH, F.col(ORD).alias(_PREVIOUS))
            same = (stored[_HASH] == gone[_HASH]) & (stored[self.order_col] == gone[_PREVIOUS])
            stored = stored.join(gone, same, "left_anti")
        return stored.drop(_HASH)
