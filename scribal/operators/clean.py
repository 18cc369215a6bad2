"""Editorial-markup removal (cleaning stage) as one Column chain.

``clean(df)`` adds the cleaned text column, runs the ordered rule chain,
converts internal tokens to published ones and drops texts that hold
nothing but tokens. The whole stage is a narrow transformation: it never
shuffles and scales linearly with the number of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scribal.functions import rule_values as V
from scribal.functions.text import literal_fold
from scribal.operators.rulechain import CHECKS_COL, Step, apply_chain

M = V.MISSING
NL = "\n"

# ---------------------------------------------------------------------------
# FIXED VALUES: regular expressions of the cleaning rules (Java syntax; a
# second spelling for RE2 where lookahead or possessive forms are needed).
# Nested-quantifier forms are flattened so long runs cannot exhaust the
# regex engine's stack; each flat form accepts exactly the same matches.
# ---------------------------------------------------------------------------
# K4a-c skip matches that would rewrite a lone newline/space/hyphen to
# itself (same output, far fewer replacements); the RE2 spellings keep the
# plain forms, so the oracle checks the equivalence.
COLLAPSE = (
    Step("K4a", "regex", pattern="[ -]++\n[ \n-]*+|\n[ \n-]++", repl=NL, re2=(("[ -]*\n[ \n-]*", NL),),
         needs=(" \n", "-\n", "\n ", "\n\n", "\n-")),
    Step("K4b", "regex", pattern="-++ [ -]*+| [ -]++", repl=" ", re2=(("-* [ -]*", " "),), needs=("- ", "  ", " -")),
    Step("K4c", "regex", pattern="--+", repl="-", re2=(("-+", "-"),), needs=("--",)),
    Step(
        "K4d",
        "regex",
        pattern="[ -]*#MISSING#(?:[ -]*+#MISSING#)*+[ -]*",
        repl=M,
        re2=(("[ -]*#MISSING#(?:[ -]*#MISSING#)*[ -]*", M),),
        needs=(M,),
    ),
    Step(
        "K4e",
        "regex",
        pattern="(?:\n#MISSING#(?=\n))++",
        repl=NL + M,
        re2=(("(?:\n#MISSING#)+\n", NL + M + NL),),
        needs=(NL + M + NL,),
    ),
)

GLOSSES = (
    Step("K3a", "find", pattern=r"\{\{[^\n]*?\}\}", rewrite="const", repl="", requires="{{"),
    Step("K3b", "find", pattern=r"\n[^\n]*?\}\}", rewrite="const", repl=NL, requires="}}"),
)

ENCLOSURE_ORDER = (
    Step("K7", "find", pattern=r"\(\[[- x]*?\)[- x]*?\]", rewrite="swap", swap=("([", "[("), requires="(["),
    Step("K8", "find", pattern=r"\[[^\n(\]]*?\([^\n)\]]*?\]\)", rewrite="swap", swap=("])", ")]"), requires="])"),
    Step("K9", "find", pattern=r"\{\[[^\n}\]]*?\}[^\n\]]*?\]", rewrite="swap", swap=("{[", "[{"), requires="{["),
    Step("K10", "find", pattern=r"\[[^\n{\]]*?\{[^\n\]]*?\]\}", rewrite="swap", swap=("]}", "}]"), requires="]}"),
    Step("K11", "find", pattern=r"<[^\n{>]*?\{[^\n}>]*?>\}", rewrite="swap", swap=(">}", "}>"), requires=">}"),
    Step("K12", "find", pattern=r"\{<[^\n}>]*?\}", rewrite="swap", swap=("{<", "<{"), requires="{<"),
)

ANGLE = (
    Step("K13a", "regex", pattern=r"<[^\n]*?>", repl="", needs=("<",)),
    Step("K13b", "regex", pattern=r"(?d)<[^\n>]*?(?:\n|$)", repl=M + NL,
         re2=((r"<[^\n>]*?(?:\n|$)", M + NL),), needs=("<",)),
    Step("K13c", "regex", pattern=r"(?:\n|^)[^\n<]*?>", repl=NL + M, needs=(">",)),
)

SEMICOLONS = (Step("K14", "fold", pairs=tuple(V.SEMICOLONS)),)
CURLY = (Step("K15", "fold", pairs=tuple(V.CURLY_HYPHENS)),)
BARS = (Step("K16", "find", pattern=r"(\|[^|a-z]*?\|)", group=1, rewrite="bar", requires="|"),)
PARENS_HYPHEN = (
    Step("K17a", "regex", pattern=r"-+\)", repl=")-", re2=((r"-+\)", ")-"),), needs=("-)",)),
    Step("K17b", "regex", pattern=r"\)([a-zA-Z])", repl=")-$1", re2=((r"\)([a-zA-Z])", r")-\1"),), needs=(")",)),
    Step("K17c", "fold", pairs=(("(-", "("),)),
)

SQUARE = (
    Step("K19a", "regex", pattern=r"\[[^\[\]\n]*?\]", repl=M, needs=("[",)),
    Step("K19b", "regex", pattern=r"\[[^\[\]\n]*?\]", repl=M, needs=("[",)),
    Step("K19c", "regex", pattern=r"\[[^\[\]\n]*?\n", repl=M + NL, needs=("[",)),
    Step("K19d", "regex", pattern=r"\n[^\[\]\n]*?\]", repl=NL + M, needs=("]",)),
)


def _xon_guard(ch: str) -> str:
    """Matches whenever a search string of the x/o/n pairs of ``ch`` occurs: in each of
    them ``c`` stands between two of these marks. A plain sequence is found in a
    fraction of the time that the strings' own alternatives take."""
    return rf"[ \n#(\[-]{ch}[ \n$#)\]-]"


def _xon_groups() -> tuple:
    """The 96 x/o/n pairs grouped per character, each group guarded by one
    scan that matches whenever any pair of the group could fire."""
    pairs = V.xon_pairs()
    per = len(V.XON_TEMPLATES)
    return tuple(
        (_xon_guard(ch), tuple(pairs[i * per:(i + 1) * per]))
        for i, ch in enumerate(V.XON_CHARS)
    )


def _xon_pass() -> tuple:
    return (
        Step(
            "K20a",
            "regex",
            pattern=r"(?d)([ \n-])([xXnNo])(?=[ \n-]|$)",
            repl="$1" + M,
            # RE2 has no lookahead: consume the delimiter and put it back;
            # two passes reach the matches whose delimiter was consumed.
            re2=((r"([ \n-])([xXnNo])([ \n-]|$)", r"\1" + M + r"\3"),) * 2,
        ),
        Step("K20b", "gfold", groups=_xon_groups(), pattern=_xon_guard("[" + "".join(V.XON_CHARS) + "]")),
        Step("K23", "patch", name="xon"),
    )


MISSING_MARKS = _xon_pass() * 3
DOLLARS = (Step("K21", "fold", pairs=tuple((s, M) for s in V.DOLLAR_LITERALS)),)
ELLIPSES = (Step("K22", "fold", pairs=tuple(V.ELLIPSIS)),)
STANDALONE_PARENS = (
    Step("K24", "find", pattern=r"(?d)(?:^|[\n -])(\([^\n)]++\))(?:$|[\n -])", group=1,
         rewrite="const", repl="", requires="(",
         re2=((r"(?:^|\n| |-)(\([^\n)]+\))(?:$|\n| |-)", ""),)),
)
MISSING_ALONE = (
    Step("K26a", "regex", pattern=r"\([ -]*#MISSING#[ -]*\)", repl=M, needs=(M,)),
    Step("K26b", "regex", pattern=r"\{[ -]*#MISSING#[ -]*\}", repl=M, needs=(M,)),
)
EMPTY_ENCLOSURES = (Step("K27", "fold", pairs=tuple(V.EMPTY_ENCLOSURES)),)
PUBLISH = (Step("K29", "fold", pairs=tuple(V.TOKEN_PUBLISH)),)


def _check(name: str, needles: Sequence[str]) -> Step:
    return Step("Q1", "check", name=name, needles=tuple(needles))


CHAIN = (
    # doubled marks, half brackets, glosses, runs of hyphens and gaps
    Step("K1", "fold", pairs=tuple(V.DOUBLE_ANGLE)),
    Step("K2", "fold", pairs=tuple(V.HALF_BRACKETS)),
    *GLOSSES,
    _check("glosses", ["{{", "}}"]),
    *COLLAPSE,
    _check("check_1", V.CHECK_1),
    # brackets, braces and parentheses that cross each other
    Step("K6", "patch", name="before_enclosures"),
    *ENCLOSURE_ORDER,
    Step("K12p", "patch", name="after_enclosures"),
    # angle brackets, line marks, bars, hyphens at parentheses
    *ANGLE,
    *SEMICOLONS,
    *CURLY,
    *BARS,
    *PARENS_HYPHEN,
    *COLLAPSE,
    _check("check_2", V.CHECK_2),
    # square brackets and every other sign of lost text
    *SQUARE,
    *MISSING_MARKS,
    *DOLLARS,
    _check("dollar", ["$"]),
    *ELLIPSES,
    *STANDALONE_PARENS,
    *COLLAPSE,
    _check("check_3", V.CHECK_3),
    # enclosures that hold a gap only, or nothing
    *MISSING_ALONE,
    *EMPTY_ENCLOSURES,
    *COLLAPSE,
    # last check, then the published tokens
    _check("check_final", V.CHECK_1 + V.CHECK_2 + V.CHECK_3 + V.CHECK_FINAL_EXTRA),
    *PUBLISH,
)

KEY = "transliteration_clean"


def published_residue(col: Column) -> Column:
    """Text with every published token (and newline) removed."""
    return literal_fold(col, [(t, "") for t in V.PUBLISHED_TOKENS])


def drop_empty(df: DataFrame, col: str = KEY) -> DataFrame:
    """Keep rows whose text holds something besides tokens (spaces count).

    Written as ``explode(filter(array(text), keep))`` rather than a
    ``Filter``: Catalyst would push a Filter below the chain's projection
    and evaluate the whole cleaning chain twice (once to test, once to
    output). The generator evaluates it once per row.
    """
    kept = F.filter(F.array(F.col(col)), lambda t: published_residue(t) != F.lit(""))
    others = [F.col(c) for c in df.columns if c != col]
    return df.select(*others, F.explode(kept).alias(col)).select(*df.columns)


def clean(
    df: DataFrame,
    text_col: str = "transliteration",
    id_col: str | None = "id",
    out_col: str = KEY,
    patches: Sequence[tuple] = tuple(V.TEXT_PATCHES),
    report: bool = False,
    chain: Sequence[Step] = CHAIN,
    filter_empty: bool = True,
) -> DataFrame:
    """Copy ``text_col`` to ``out_col``, clean it, drop token-only rows."""
    out = df.withColumn(out_col, F.col(text_col))
    out = apply_chain(out, out_col, chain, id_col=id_col, patches=patches, report=report)
    return drop_empty(out, out_col) if filter_empty else out


def violations(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Explode the ``_checks`` column of ``clean(..., report=True)``.

    One row per (text, check stage, offending substring).
    """
    # explode_outer + a filter above the generator: a plain explode makes
    # Catalyst infer ``size(_checks) > 0`` and push it below the cleaning
    # projection, which would evaluate the whole chain a second time.
    return (
        df.select(F.col(id_col), F.explode_outer(CHECKS_COL).alias("v"))
        .filter(F.col("v").isNotNull())
        .select(id_col, F.col("v.stage").alias("stage"), F.col("v.rule").alias("rule"))
    )
