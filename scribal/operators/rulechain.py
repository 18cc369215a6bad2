"""Rules as data, compiled to Column expressions.

A chain is an ordered tuple of :class:`Step`. ``apply_chain`` turns it into
a handful of projections over one DataFrame: every step is a JVM
expression, there is no Python worker and no shuffle. Steps that need the
evolving text twice (``find``) start a new projection so Catalyst never
duplicates an expensive sub-expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scribal.functions.text import contains_any, find_replace, guarded, guarded_fold, let, literal_fold, regex_sub

CHECKS_COL = "_checks"


@dataclass(frozen=True)
class Step:
    """One rule.

    kind
        ``fold``   ordered literal ``pairs``
        ``gfold``  ordered literal ``groups`` of (guard regex, pairs): a group
                   runs only when its guard matches. The guard must match
                   whenever any of the group's search strings occurs, so a
                   skipped group is exactly a group of no-op replacements;
        ``find``   ``pattern``/``group`` matches rewritten by ``rewrite``:
                   ``const`` (to ``repl``), ``swap`` (``swap[0]`` -> ``swap[1]``
                   inside the match) or ``bar`` (hyphens stripped, ``-``
                   appended)
        ``regex``  global substitution ``pattern`` -> ``repl`` (Java syntax)
        ``patch``  per-text literal patches registered for chain point ``name``
        ``check``  report which ``needles`` occur (no data change)
    re2
        DuckDB/RE2 spelling for the oracle, as a sequence of
        (pattern, replacement) substitutions, when the Java one is not
        portable (lookahead, possessive quantifiers).
    """

    rule: str
    kind: str
    pairs: tuple = ()
    pattern: str = ""
    group: int = 0
    repl: str = ""
    rewrite: str = ""
    swap: tuple = ()
    needles: tuple = ()
    name: str = ""
    re2: tuple | None = field(default=None)
    groups: tuple = ()
    # find steps: a literal every match contains; rows without it skip the
    # regex scan (the step would be a no-op there)
    requires: str = ""
    # regex steps: literals of which every match contains one; texts without any
    # skip the scan
    needs: tuple = ()

    def all_pairs(self) -> tuple:
        return self.pairs if self.kind == "fold" else tuple(p for _, ps in self.groups for p in ps)


def _rewrite(step: Step):
    if step.rewrite == "const":
        return (lambda m: F.lit(step.repl)), None
    if step.rewrite == "swap":
        old, new = step.swap
        return (lambda m: F.replace(m, F.lit(old), F.lit(new))), None
    if step.rewrite == "bar":
        stripped = lambda m: F.replace(m, F.lit("-"), F.lit(""))
        return (lambda m: F.concat(stripped(m), F.lit("-"))), stripped
    raise ValueError(f"unknown rewrite {step.rewrite!r}")


def _patch_expr(col: Column, id_col: Column, patches: Sequence[tuple], point: str) -> Column:
    out = col
    for text_id, where, old, new in patches:
        if where != point:
            continue
        # an empty search string leaves the text unchanged, so the text is
        # referenced once and the expression stays linear in the patches
        search = F.when(id_col == F.lit(text_id), F.lit(old)).otherwise(F.lit(""))
        out = F.replace(out, search, F.lit(new))
    return out


def _guarded(guard: str, pairs: tuple):
    return lambda x: F.when(x.rlike(guard), guarded_fold(x, pairs)).otherwise(x)


def _group_folds(step: Step):
    def run(x: Column) -> Column:
        for guard, pairs in step.groups:
            x = let(x, _guarded(guard, pairs))
        return x

    return (lambda x: F.when(x.rlike(step.pattern), run(x)).otherwise(x)) if step.pattern else run


def apply_chain(
    df: DataFrame,
    text_col: str,
    chain: Sequence[Step],
    id_col: str | None = None,
    patches: Sequence[tuple] = (),
    report: bool = False,
) -> DataFrame:
    """Run ``chain`` over ``df[text_col]`` in place.

    With ``report=True`` a ``_checks array<struct<stage,rule>>`` column
    collects every check hit at the point of the chain where it is taken.
    """
    ident = F.col(id_col).cast("string") if id_col else None
    cur = F.col(text_col)
    pending = False
    check_cols: list[str] = []

    def flush(frame: DataFrame) -> DataFrame:
        return frame.withColumn(text_col, cur) if pending else frame

    for step in chain:
        if step.kind == "fold":
            fold = guarded_fold if len(step.pairs) > 4 else literal_fold
            cur, pending = fold(cur, step.pairs), True
        elif step.kind == "gfold":
            cur, pending = let(cur, _group_folds(step)), True
        elif step.kind == "regex":
            sub = lambda x, s=step: regex_sub(x, s.pattern, s.repl)
            cur, pending = guarded(cur, step.needs, sub) if step.needs else sub(cur), True
        elif step.kind == "patch":
            if ident is None:
                continue
            cur, pending = _patch_expr(cur, ident, patches, step.name), True
        elif step.kind == "find":
            df = flush(df)
            rewrite, search = _rewrite(step)
            found = find_replace(F.col(text_col), step.pattern, step.group, rewrite, search)
            if step.requires:
                found = F.when(F.col(text_col).contains(step.requires), found).otherwise(F.col(text_col))
            cur, pending = found, True
        elif step.kind == "check":
            if not report:
                continue
            df = flush(df)
            cur, pending = F.col(text_col), False
            # one column per check point, concatenated once at the end, so
            # no check expression is nested inside a later one
            name = f"_chk{len(check_cols)}"
            hits = contains_any(F.col(text_col), step.needles)
            df = df.withColumn(
                name, F.transform(hits, lambda r: F.struct(F.lit(step.name).alias("stage"), r.alias("rule")))
            )
            check_cols.append(name)
        else:
            raise ValueError(f"unknown step kind {step.kind!r}")
    df = flush(df)
    if report:
        prev = [F.col(CHECKS_COL)] if CHECKS_COL in df.columns else []
        parts = prev + [F.col(c) for c in check_cols]
        empty = F.array().cast("array<struct<stage:string,rule:string>>")
        df = df.withColumn(CHECKS_COL, F.concat(*parts) if parts else empty).drop(*check_cols)
    return df
