"""Column-level building blocks for rule chains.

Every helper returns a JVM-side Column expression: no Python worker is
involved, so a chain of rules stays inside one projection per stage.

Rule kinds
----------
* ``literal_fold``  ordered literal replacements (the order matters; never
  reorder or de-duplicate a pair list).
* ``find_replace``  "find every match once, then replace each match text
  globally, in match order" - the semantics of ``findall`` followed by a
  loop of ``str.replace``. This is *not* ``regexp_replace``: a match that
  occurs again elsewhere (even where the pattern would not match there)
  is rewritten too.
* ``regex_sub``     a plain global regular-expression substitution.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_fold(col: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Apply ``replace(old, new)`` for each pair, in order, to ``col``: nested
    ``replace`` calls, which generate code. Every rule table is far smaller than
    what one expression may hold."""
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def guarded_fold(col: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """``literal_fold`` for long rule lists of which a text holds few search strings.

    The pairs are data that one expression goes through in order; whether a text holds
    a search string is asked first, as that costs a fraction of a replacement.
    """
    rules = F.array(*[F.struct(F.lit(old).alias("old"), F.lit(new).alias("new")) for old, new in pairs])
    return F.aggregate(rules, col, lambda text, rule: F.when(
        F.contains(text, rule["old"]), F.replace(text, rule["old"], rule["new"])).otherwise(text))


def guarded(col: Column, needs: Sequence[str], body: Callable[[Column], Column]) -> Column:
    """``body(col)`` for texts that hold any of ``needs``, others as they are."""

    def choose(x: Column) -> Column:
        held = F.contains(x, F.lit(needs[0]))
        for n in needs[1:]:
            held = held | F.contains(x, F.lit(n))
        return F.when(held, body(x)).otherwise(x)

    return let(col, choose)


def find_replace(
    col: Column,
    pattern: str,
    group: int,
    rewrite: Callable[[Column], Column],
    match_col: Callable[[Column], Column] | None = None,
) -> Column:
    """``for m in findall(pattern, s): s = s.replace(match_col(m), rewrite(m))``.

    ``match_col`` lets the searched text differ from the raw match.
    """
    search = match_col or (lambda m: m)

    def body(text: Column) -> Column:
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        # a match that comes again is as a rule gone by then: the test costs a
        # fraction of a replacement
        return F.aggregate(matches, text, lambda acc, m: F.when(
            F.contains(acc, search(m)), F.replace(acc, search(m), rewrite(m))).otherwise(acc))

    return let(col, body)


def let(col: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``col`` to a lambda variable so ``body`` may use it many times.

    The value is computed once; the expression tree stays linear however
    deeply such steps nest (a plain double reference would double it).
    """
    return F.transform(F.array(col), body).getItem(0)


def regex_sub(col: Column, pattern: str, replacement: str) -> Column:
    """Global regex substitution (Java syntax: ``$1`` for groups)."""
    return F.regexp_replace(col, pattern, replacement)


# Python's str.strip() set: every code point whose str.isspace() is true.
PY_WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def strip_ws(col: Column) -> Column:
    """Python ``str.strip()``: trims the full Unicode whitespace set."""
    return F.btrim(col, F.lit(PY_WHITESPACE))


def is_upper(col: Column) -> Column:
    """Python ``str.isupper()``: some upper-case letter, no lower/title-case one.

    Uses the Unicode *properties* (``ₓ`` counts as lower case), not
    ``upper(s) = s``, which is wrong for modifier letters.
    """
    return col.rlike(r"\p{IsUppercase}") & ~col.rlike(r"[\p{IsLowercase}\p{Lt}]")


def contains_any(col: Column, needles: Sequence[str]) -> Column:
    """Array of the needles that occur in ``col`` (in list order)."""
    arr = F.array(*[F.lit(n) for n in needles])
    # bound once: the lambda runs per needle, and an inlined upstream
    # expression would otherwise be re-evaluated for every needle
    return let(col, lambda text: F.filter(arr, lambda n: F.contains(text, n)))
