"""Trees are taken apart as values; no value's schema is made for it."""

import contextlib
import io

from pyspark.sql import functions as F

from scribal.operators.tree import flatten_tree, node_problems


def test_a_chunk_is_taken_apart_without_its_children_as_text(spark):
    texts = spark.createDataFrame(
        [(1, '{"cdl":[{"node":"c","id":"a","cdl":[{"node":"l","id":"x"},[],7,{"node":"c","cdl":[null]},{"node":"c","cdl":[]},'
             '{"node":"c","cdl":{"a":1}}]}]}'), (2, '{"cdl":7}'), (3, "[1]"), (4, None)], "id int, json string")
    got = {tuple(r.path): r.node for r in flatten_tree(texts).collect()}
    assert got == {
        (0,): '{"cdl":[],"id":"a","node":"c"}', (0, 0): '{"id":"x","node":"l"}', (0, 1): "[]", (0, 2): "7",
        (0, 3): '{"cdl":[],"node":"c"}', (0, 3, 0): "null", (0, 4): '{"cdl":[],"node":"c"}',
        (0, 5): '{"cdl":{"a":1},"node":"c"}', (0, 5, 0): "1",
    }


def test_no_step_makes_the_schema_of_whole_nodes(spark):
    """The schema of a value walks all that it holds: a tree's, once per level."""
    nodes = spark.createDataFrame([('{"node":"l","id":"x","ref":7,"inst":"i","f":[],"props":{}}',)], "node string")
    judged = nodes.select(node_problems(F.col("node")).alias("p"))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        judged.explain(True)
    assert "schema_of_variant" not in out.getvalue()
    assert sorted(judged.first().p) == ["wrong type of f", "wrong type of props", "wrong type of ref"]
