import json

import pytest
from pyspark.sql import functions as F

from scribal.operators import tree as tree_ops
from scribal.operators.lookups import glyph_index, glyph_pairs, invert, reading_index, reading_pairs
from scribal.operators.tree import assemble_text, flatten_tree, node_tokens, repair_brackets
from scribal.sources.signs import read_reading_index, read_sign_list

N6 = [("lugal", "", "lugal"), ("lugal", "[]", "[lugal]"), ("lu[gal", "[", "lu[gal"), ("lugal", "[", "[lugal"),
      ("lugal", "]", "lugal]"), ("ka[lam", "][", "ka][lam"), ("ka]lam", "][", "kalam"), ("a[b]c", "[][]", "[abc]"),
      ("abc", "]]", "abc]")]


def test_repair_brackets_micro(spark):
    df = spark.createDataFrame(N6, "t string, ideal string, e string")
    for r in df.select(repair_brackets(F.col("t"), F.col("ideal")).alias("g"), "e").collect():
        assert r.g == r.e


def _lemma(form, start=False, end=False, lang="sux"):
    return {"node": "l", "id": "i", "ref": "r", "inst": "x", "props": [],
            "f": {"form": form, "lang": lang, "gdl": [{"breakStart": "1"} if start else {}, {"breakEnd": "1"} if end else {}]}}


def test_tree_to_text(spark, tmp_path):
    tree = {"cdl": [{"node": "c", "type": "text", "id": "t", "cdl": [
        {"node": "d", "type": "surface"}, {"node": "d", "type": "line-start"},
        _lemma("lugal"), _lemma("e", start=True, end=True, lang="akk"),
        {"node": "c", "type": "sentence", "id": "s", "cdl": [_lemma("ki"), {"node": "d", "type": "nonx", "state": "missing"}]},
        {"node": "ll", "id": "q", "choices": [_lemma("hidden")]},
        {"node": "d", "type": "surface"}, {"node": "d", "type": "object"},
        {"node": "d", "type": "surface"}, {"node": "d", "type": "line-start"}, _lemma("mu")]}]}
    df = spark.createDataFrame([("T1", json.dumps(tree))], "id string, json string")
    out = assemble_text(node_tokens(flatten_tree(df))).first()
    assert out.transliteration == "#SURFACE#\nlugal [e] ki\n#MISSING#\n#SURFACE#\nmu"
    assert out.langs == "akk, sux"


def _plain_nodes(tree):
    """Every node with its path, by a plain walk; a chunk with an empty child list."""
    out, todo = [], [((), tree["cdl"])]
    while todo:
        path, children = todo.pop()
        for k, child in enumerate(children):
            at = (*path, k)
            chunk = child.get("node") == "c"
            out.append((at, {**child, "cdl": []} if chunk and isinstance(child.get("cdl"), list) else child))
            if chunk and isinstance(child.get("cdl"), list):
                todo.append((at, child["cdl"]))
    return sorted(out, key=lambda x: x[0])


@pytest.mark.parametrize("as_text", [False, True])
def test_deep_trees_in_one_query(spark, monkeypatch, as_text):
    """Fifty levels, mixed siblings, odd children; as VARIANT and, beyond its size, as text."""
    if as_text:
        monkeypatch.setattr(tree_ops, "VARIANT_BYTES", 10)
    deep = [_lemma("end")]
    for k in range(50):
        deep = [_lemma(f"a{k}"), {"node": "c", "type": "sentence", "id": str(k), "cdl": deep}, {"linkbase": [{"node": "c", "cdl": [{}]}]}]
    trees = {"deep": {"cdl": deep}, "flat": {"cdl": [_lemma("x"), {"node": "c", "id": "no list"}, {"node": "c", "cdl": []}]},
             "empty": {"cdl": []}, "none": {"other": 1}}
    rows = [(k, json.dumps(t)) for k, t in trees.items()] + [("bad", "{"), ("null", None), ("list", "[1]")]
    out = flatten_tree(spark.createDataFrame(rows, "id string, json string")).collect()
    got = {k: sorted(((tuple(r.path), json.loads(r.node)) for r in out if r.id == k), key=lambda x: x[0]) for k, _ in rows}
    assert got == {k: _plain_nodes(trees[k]) if "cdl" in trees.get(k, {}) else [] for k, _ in rows}
    assert max(len(r.path) for r in out) == 51


def test_endless_trees_are_refused(spark):
    deep = []
    for k in range(12):
        deep = [{"node": "c", "id": str(k), "cdl": deep}]
    df = spark.createDataFrame([("a", json.dumps({"cdl": deep}))], "id string, json string")
    with pytest.raises(Exception, match="RECURSION"):
        flatten_tree(df, max_depth=5)


def test_sign_list_reader_and_indexes(spark, tmp_path):
    sl = {"sl:signlist": {"j:letters": [{"sl:letter": {"j:signs": [
        {"sl:sign": {"n": "A&amp;B", "sl:ucun": "𒀀", "j:aka": [{"sl:aka": {"n": "AB"}}],
                     "j:values": [{"sl:v": {"n": "a"}}, {"other": 1}],
                     "j:forms": [{"sl:form": {"n": "A2", "j:values": [{"sl:v": {"n": "a"}}]}}]}},
        {"sl:sign": {"n": "AB", "sl:ucun": "𒀁", "j:values": [{"sl:v": {"n": "ab"}}]}}]}}]}}
    p = tmp_path / "sl.json"
    p.write_text(json.dumps(sl, ensure_ascii=False))
    q = tmp_path / "idx.json"
    q.write_text(json.dumps({"index": {"ab": "A2", "new": "AB"}}))
    signs = read_sign_list(spark, str(p))
    g = {r.glyph_name: (r.glyph, r.n_candidates) for r in glyph_index(glyph_pairs(signs)).collect()}
    assert g == {"A&B": ("𒀀", 1), "AB": ("𒀀", 2), "A2": ("", 0)}
    r = {x.reading: x.names for x in reading_index(reading_pairs(signs), read_reading_index(spark, str(q))).collect()}
    assert r == {"a": ["A&B", "A2"], "ab": ["A2"], "new": ["AB"]}
    inv = {x.glyph_name: x.readings for x in invert(spark.createDataFrame(list(r.items()), "reading string, names array<string>")).collect()}
    assert inv["A2"] == ["a", "ab"]
