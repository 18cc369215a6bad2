"""Rules that a text cannot need are passed over, with equal results."""

import random
import re

from pyref import apply_steps
from pyspark.sql import functions as F

from scribal.functions import rule_values as V
from scribal.functions.text import guarded_fold, literal_fold
from scribal.operators import clean as C
from scribal.operators.rulechain import apply_chain


def test_long_folds_are_guarded_and_equal(spark):
    rng = random.Random(5)
    olds = [old for old, _ in V.SIGN_LIST_REPLACEMENTS]
    texts = [None, "", "plain words", *["".join(rng.choice(olds + [" ", "a", "|", "("]) for _ in range(30)) for _ in range(200)]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    pairs = (*V.SIGN_LIST_REPLACEMENTS, ("", "z"))
    rows = df.select(guarded_fold(F.col("t"), pairs).alias("a"), literal_fold(F.col("t"), pairs).alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]


def test_long_folds_ask_no_regular_expression(spark):
    """The pairs are data: the expression stays as small for 800 as for 8, and no pattern is matched."""
    pairs = [(f"w{k}.", f"w{k + 1}.") for k in range(800)]
    df = spark.createDataFrame([("w0. a w799. w800.",), ("w79.9",), (None,)], "t string")
    folded = df.select(guarded_fold(F.col("t"), pairs).alias("t"))
    assert [r.t for r in folded.collect()] == ["w800. a w800. w800.", "w800.9", None]
    assert "rlike" not in folded._jdf.queryExecution().optimizedPlan().toString().lower()


def test_xon_guards_hold_wherever_a_search_string_does(spark):
    assert all(re.search(guard, old) for guard, pairs in C._xon_groups() for old, _ in pairs)
    assert all(re.search(s.pattern, old) for s in C.CHAIN if s.kind == "gfold" for old, _ in s.all_pairs())
    assert not any("|" in guard for guard, _ in C._xon_groups())


def test_every_guarded_step_names_what_its_matches_hold(spark):
    """Steps alone, on texts dense in their own marks, against Python's ``re``."""
    rng = random.Random(7)
    marks = ["x", "n", "O", "a", " ", "-", "\n", "[", "]", "(", ")", "<", ">", "$", "#MISSING#", "{", "}"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(1, 9))) for _ in range(600)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, t string")
    steps = list(dict.fromkeys(s for s in C.CHAIN if s.needs or s.kind == "gfold"))
    assert len([s for s in steps if s.needs]) > 10
    for step in steps:
        got = {r.id: r.t for r in apply_chain(df, "t", (step,), id_col="id").collect()}
        assert [got[str(i)] for i in range(len(texts))] == [apply_steps(t, (step,)) for t in texts], step.rule
