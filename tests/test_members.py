"""The member-wise scan against a JSON parser, on files of many splits."""

import json
import random

import pytest

from scribal.sources.catalogue import read_catalogue
from scribal.sources.members import read_members

VALUES = ["plain", "a } b", "{", "}", '"', '\\', "\\}", '\\"}{', "ü   é", "", "{\"x\": {\"y\": 1}}", "line\nbreak", "a: {", "\t"]


def catalogue(rng, n):
    members = {}
    for k in range(n):
        member = {rng.choice(["a", "b", "c{", "d}", "e\"f"]): rng.choice(VALUES) for _ in range(rng.randint(0, 5))}
        if rng.random() < 0.3:
            member["list"] = [rng.choice(VALUES) for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.1:
            member["nested"] = {"x": {"y": rng.choice(VALUES)}}
        members[rng.choice(["P", "Q}", 'R"', "S{", "T\\"]) + str(k)] = member
    return {"type": "cat } alogue {", "config": {"P0": {"a": "not a member"}}, "members": members, "after": {"Z": {"a": "nor this"}}}


def plain(value):
    return value if isinstance(value, str) else json.loads(json.dumps(value))


@pytest.mark.parametrize("indent", [None, 2])
def test_equals_a_json_parser(spark, tmp_path, indent):
    rng = random.Random(indent or 7)
    tree = catalogue(rng, 600)
    path = tmp_path / "catalogue.json"
    path.write_text(json.dumps(tree, indent=indent, ensure_ascii=indent is None), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = read_members(spark, str(path)).orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.key for r in rows] == list(tree["members"]) and [r.pos for r in rows] == list(range(600))
    for r in rows:
        expected = tree["members"][r.key]
        assert {k: v if isinstance(expected[k], str) else json.loads(v) for k, v in r.meta.items()} == expected


def test_many_members_run_in_many_tasks(spark, tmp_path):
    n = 200_000
    with open(tmp_path / "catalogue.json", "w", encoding="utf-8") as f:
        f.write('{"members":{' + ",".join(f'"P{k}":{{"id_text":"P{k}","note":"n }} }} {k % 7}"}}' for k in range(n)) + "}}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        raw = spark.read.option("lineSep", "}").text(f"{tmp_path}/catalogue.json")
        assert raw.rdd.getNumPartitions() > 4
        rows = read_members(spark, f"{tmp_path}/catalogue.json")
        assert rows.count() == n
        assert rows.filter("key <> concat('P', pos) or meta['id_text'] <> key").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_duplicate_keys_and_odd_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"members": {"x": {"v": "1"}, "y": {"v": "2"}, "x": {"v": "3"}}}')
    got = read_members(spark, str(tmp_path / "a.json")).orderBy("pos").collect()
    assert [(r.key, r.meta) for r in got] == [("x", {"v": "3"}), ("y", {"v": "2"})]
    (tmp_path / "b.json").write_text('{"members": {}}\n')
    assert read_members(spark, str(tmp_path / "b.json")).count() == 0
    (tmp_path / "royal").mkdir()
    assert read_catalogue(spark, str(tmp_path), "royal").count() == 0
