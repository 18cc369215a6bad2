"""Keep-first over landings in any order, ties, and positions from files."""

import random

import pytest
from pyspark.sql import functions as F

from scribal.operators.collate import keep_first, keep_first_in_turn, union_common, with_ord
from scribal.operators.key_index import KeepFirstStore

SCHEMA = "id string, t string, ord long"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def landing(rng, start, n):
    return [(f"r{start + k}", rng.choice([None, "", *"abcdefghijklmnopqrstuvwxyz"]) , start + k) for k in rng.sample(range(n), n)]


def test_landings_in_any_order_equal_one(spark, tmp_path):
    rng = random.Random(5)
    parts = {"a": landing(rng, 0, 12), "b": landing(rng, 100, 12), "c": landing(rng, 200, 40)}
    whole = spark.createDataFrame([r for p in parts.values() for r in p], SCHEMA)
    expected = rows_of(keep_first(whole, ["t"]))
    for number, order in enumerate(("abc", "cba", "bca")):
        store = KeepFirstStore(spark, f"{tmp_path}/{number}", ["t"], buckets=4)
        assert store.rows() is None
        for name in order:
            store.land(spark.createDataFrame(parts[name], SCHEMA), name)
        assert rows_of(store.rows()) == expected and store.landings() == ["a", "b", "c"]
        store.land(spark.createDataFrame(parts["a"], SCHEMA), "a")  # again: nothing changes
        assert rows_of(store.rows()) == expected


def test_earlier_rows_are_not_read_and_stopped_landings_start_anew(spark, tmp_path, monkeypatch):
    store = KeepFirstStore(spark, str(tmp_path), ["t"])
    store.land(spark.createDataFrame([("x", "k", 5), ("y", "m", 6)], SCHEMA), "one")
    asked = []
    real = KeepFirstStore._folder
    monkeypatch.setattr(KeepFirstStore, "_folder", lambda self, t, x: asked.append((t, x)) or real(self, t, x))
    later = spark.createDataFrame([("z", "k", 2), ("w", "m", 9)], SCHEMA)
    store.land(later, "two")
    assert ("rows", "one") not in asked and ("index", "one") in asked
    monkeypatch.undo()
    assert rows_of(store.rows()) == [("y", "m", 6), ("z", "k", 2)]

    # a landing that stops after its index was written is not there
    third = spark.createDataFrame([("v", "k", 1), ("u", "new", 3)], SCHEMA)
    calls = {"n": 0}

    def third_time(self, table, name):
        if (table, name) == ("rows", "three"):
            calls["n"] += 1
            if calls["n"] == 2:  # the first call removes leftovers
                raise RuntimeError("lost")
        return real(self, table, name)

    monkeypatch.setattr(KeepFirstStore, "_folder", third_time)
    with pytest.raises(RuntimeError):
        store.land(third, "three")
    assert rows_of(store.rows()) == [("y", "m", 6), ("z", "k", 2)]
    monkeypatch.undo()
    store.land(third, "three")
    assert rows_of(store.rows()) == [("u", "new", 3), ("v", "k", 1), ("y", "m", 6)]
    with pytest.raises(ValueError):
        store.land(third, "../x")


def test_ties_and_equal_rows_leave_one(spark):
    rows = [("a", "k", 1), ("b", "k", 1), ("b", "k", 1), ("c", "m", 2), ("c", "m", 2), (None, None, 3), (None, None, 3)]
    out = rows_of(keep_first(spark.createDataFrame(rows, SCHEMA).repartition(3), ["t"]))
    assert [r[1:] for r in out] == [("k", 1), ("m", 2), (None, 3)]
    many = keep_first(spark.createDataFrame([(1, None, 5), (1, "", 4), (1, None, 3)], "i int, t string, ord long"), ["i", "t"])
    assert rows_of(many) == [(1, "", 4), (1, None, 3)]
    assert keep_first(spark.createDataFrame([], SCHEMA), ["t"]).count() == 0


def test_two_turns_evaluate_the_input_once(spark):
    counted = spark.sparkContext.accumulator(0)

    def seen(x):
        counted.add(1)
        return x

    rows = [("a", "1", "x", 1), ("b", "1", "y", 2), ("c", "2", "x", 3), ("d", "3", "y", 4)]
    once = spark.createDataFrame(spark.sparkContext.parallelize(rows, 1).map(seen), "id string, t string, g string, ord long")
    out = keep_first_in_turn(once, [["t"], ["g"]])
    assert rows_of(out.select("id")) == [("a",), ("d",)] and counted.value == 4
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 3


def test_positions_follow_files(spark, tmp_path):
    """The small first file comes first, though Spark reads the large one before it."""
    spark.createDataFrame([("dup", "first")], "t string, who string").write.parquet(f"{tmp_path}/d/a")
    big = spark.range(30_000).selectExpr("concat('t', id) t", "'second' who")
    big.unionByName(spark.createDataFrame([("dup", "second")], "t string, who string")).coalesce(1).write.parquet(f"{tmp_path}/d/b")
    df = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/d")
    placed = with_ord(df, 0)
    assert [r.who for r in keep_first(placed, ["t"]).filter("t = 'dup'").collect()] == ["first"]
    assert placed.agg(F.min("ord"), F.max("ord"), F.count_distinct("ord")).first() == (0, 30_001, 30_002)
    both = union_common([with_ord(df, 0), with_ord(df, 1)])
    assert both.select("ord").distinct().count() == 2 * 30_002
