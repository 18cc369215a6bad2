"""Compile the same rule tables to DuckDB SQL for the correctness oracle.

The oracle is an independent engine (RE2 regexes, DuckDB list lambdas)
running the rules from the same data, so any engine-level difference in
regex or replacement semantics shows up as a value mismatch.
"""

from __future__ import annotations

from collections.abc import Sequence

from scribal.operators.rulechain import Step


def q(s: str) -> str:
    """A SQL string literal; newlines become ``chr(10)`` concatenations."""
    parts = s.split("\n")
    lits = ["'" + p.replace("'", "''") + "'" for p in parts]
    return "(" + " || chr(10) || ".join(lits) + ")" if len(lits) > 1 else lits[0]


def fold_sql(expr: str, pairs: Sequence[tuple[str, str]]) -> str:
    for old, new in pairs:
        expr = f"replace({expr}, {q(old)}, {q(new)})"
    return expr


def _regex_sql(expr: str, step: Step) -> str:
    subs = step.re2 if step.re2 is not None else ((step.pattern, step.repl),)
    for pat, repl in subs:
        if "(?=" in pat or "*+" in pat or "++" in pat or "(?d)" in pat:
            raise ValueError(f"{step.rule}: pattern not portable to RE2")
        if step.re2 is None and "$" in repl:
            raise ValueError(f"{step.rule}: Java replacement needs an RE2 spelling")
        expr = f"regexp_replace({expr}, {q(pat)}, {q(repl)}, 'g')"
    return expr


def _find_sql(col: str, step: Step) -> str:
    pat = step.re2[0][0] if step.re2 else step.pattern
    if step.rewrite == "const":
        search, rewrite = "m", q(step.repl)
    elif step.rewrite == "swap":
        search, rewrite = "m", f"replace(m, {q(step.swap[0])}, {q(step.swap[1])})"
    elif step.rewrite == "bar":
        search, rewrite = "replace(m, '-', '')", "replace(m, '-', '') || '-'"
    else:
        raise ValueError(step.rewrite)
    return (
        f"list_reduce(regexp_extract_all({col}, {q(pat)}, {step.group}), "
        f"lambda acc, m: replace(acc, {search}, {rewrite}), {col})"
    )


def chain_sql(
    base_sql: str,
    chain: Sequence[Step],
    text_col: str = "t",
    id_col: str | None = None,
    patches: Sequence[tuple] = (),
    report: bool = False,
    prefix: str = "c",
) -> tuple[list[str], str]:
    """Return (CTE definitions, name of the last CTE).

    ``base_sql`` must select ``text_col`` (and ``id_col`` for patches).
    With ``report`` a ``checks`` list of ``{stage, rule}`` structs is carried.
    """
    ctes: list[str] = []
    n = 0
    cur = f"{prefix}0"
    first = f"SELECT *{', []::STRUCT(stage VARCHAR, rule VARCHAR)[] AS checks' if report else ''} FROM ({base_sql})"
    ctes.append(f"{cur} AS MATERIALIZED ({first})")
    expr = text_col
    pending = False

    def flush():
        nonlocal cur, n, expr, pending
        if pending:
            n += 1
            nxt = f"{prefix}{n}"
            ctes.append(f"{nxt} AS MATERIALIZED (SELECT * REPLACE ({expr} AS {text_col}) FROM {cur})")
            cur = nxt
        expr, pending = text_col, False

    for step in chain:
        if step.kind in ("fold", "gfold"):
            expr, pending = fold_sql(expr, step.all_pairs()), True
        elif step.kind == "regex":
            expr, pending = _regex_sql(expr, step), True
        elif step.kind == "patch":
            if id_col is None:
                continue
            per_text: dict[str, list[tuple[str, str]]] = {}
            for text_id, where, old, new in patches:
                if where == step.name:
                    per_text.setdefault(text_id, []).append((old, new))
            if per_text:
                flush()
                whens = " ".join(f"WHEN {q(i)} THEN {fold_sql(text_col, pairs)}" for i, pairs in per_text.items())
                expr, pending = f"CASE CAST({id_col} AS VARCHAR) {whens} ELSE {text_col} END", True
                flush()
        elif step.kind == "find":
            flush()
            expr, pending = _find_sql(text_col, step), True
            flush()
        elif step.kind == "check":
            if not report:
                continue
            flush()
            needles = "[" + ", ".join(q(x) for x in step.needles) + "]"
            hits = (
                f"list_transform(list_filter({needles}, lambda r: contains({text_col}, r)), "
                f"lambda r: {{'stage': {q(step.name)}, 'rule': r}})"
            )
            n += 1
            nxt = f"{prefix}{n}"
            ctes.append(f"{nxt} AS MATERIALIZED (SELECT * REPLACE (list_concat(checks, {hits}) AS checks) FROM {cur})")
            cur = nxt
        else:
            raise ValueError(step.kind)
    flush()
    return ctes, cur


def with_query(ctes: Sequence[str], final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final
