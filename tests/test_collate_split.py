import pytest
from pyspark.sql import functions as F

from scribal.operators.collate import apply_filters, close_mapping, keep_first, standardise, union_common, with_ord
from scribal.operators.split import split_stratified


def test_keep_first_after_filter(spark):
    a = spark.createDataFrame([("A", "", 1), ("A", "t2", 2), ("A", "t3", 3), ("B", "x", 4)], "id string, t string, p long")
    df = apply_filters(with_ord(a, 0, "p").drop("p"), [F.col("t") != ""])
    out = {r.id: r.t for r in keep_first(df, ["id"]).collect()}
    assert out == {"A": "t2", "B": "x"}


def test_union_common_columns(spark):
    a = spark.createDataFrame([(1, "x", 5)], "id int, t string, extra int")
    b = spark.createDataFrame([(2, "y")], "id int, t string")
    u = union_common([with_ord(a, 0, "id"), with_ord(b, 1, "id")])
    assert u.columns == ["id", "t", "ord"] and u.count() == 2
    with pytest.raises(ValueError):
        union_common([a, b])


def test_keep_first_by_source_rank_then_position(spark, tmp_path):
    """A small first file wins over a large second one, whatever is read first."""
    spark.createDataFrame([("dup", "first", 1)], "t string, who string, p long").write.parquet(f"{tmp_path}/a")
    spark.range(50_000).selectExpr("concat('t', id) t", "'second' who", "id p").unionByName(
        spark.createDataFrame([("dup", "second", 0), (None, "null one", 60_000), (None, "null two", 60_001)],
                              "t string, who string, p long")).write.parquet(f"{tmp_path}/b")
    tables = [with_ord(spark.read.parquet(f"{tmp_path}/{n}"), i, "p") for i, n in enumerate("ab")]
    out = keep_first(union_common(tables), ["t"])
    assert [r.who for r in out.filter("t = 'dup'").collect()] == ["first"]
    assert [r.who for r in out.filter("t is null").collect()] == ["null one"]
    assert out.count() == 50_002
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_standardise_closure(spark):
    assert close_mapping([("a", "b"), ("b", "c")]) == {"a": "c", "b": "c"}
    df = spark.createDataFrame([("a",), ("b",), ("z",)], "g string")
    assert [r.g for r in standardise(df, "g", [("a", "b"), ("b", "c")]).collect()] == ["c", "c", "z"]


def test_split_sizes_disjoint_and_partition_independent(spark):
    rows = [(i, f"s{i % 3 if i % 10 else 9}", "Lexical" if i % 17 == 0 else "x") for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, period string, genre string")
    outs = []
    for parts in (1, 7):
        out = split_stratified(df.repartition(parts), "period", "id", route_to_train=F.col("genre") == "Lexical")
        outs.append(sorted((r.id, r.split) for r in out.collect()))
    assert outs[0] == outs[1]
    got = dict(outs[0])
    assert len(got) == 2000
    n_free = sum(1 for i in range(2000) if i % 17)
    n_test = sum(1 for v in got.values() if v == "test")
    assert n_test == -(-n_free * 5 // 100)
    assert all(got[i] == "train" for i in range(0, 2000, 17))


def test_split_keeps_null_strata_and_a_dominant_one(spark):
    rows = [(i, None if i % 20 == 0 else "rare" if i % 20 == 1 else "main") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, period string")
    out = split_stratified(df, "period", "id")
    got = [(r.id, r.period, r.split) for r in out.collect()]
    assert sorted((i, str(p)) for i, p, _ in got) == sorted((i, str(p)) for i, p in rows)
    n = {(p, s): sum(1 for _, q, t in got if (q, t) == (p, s)) for p in (None, "rare", "main") for s in ("test", "validation", "train")}
    assert sum(v for (_, s), v in n.items() if s == "test") == 150
    assert sum(v for (_, s), v in n.items() if s == "validation") == 150  # ceil(2850 * 5 / 95)
    assert n[None, "test"] in (7, 8) and n["rare", "test"] in (7, 8) and n["main", "test"] in (135, 136)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 3
    assert split_stratified(df.limit(0), "period", "id").count() == 0
