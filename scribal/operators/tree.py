"""Nested text trees -> ordered token table -> transliteration.

A text is a JSON document ``{"cdl": [node, ...]}``; chunk nodes (``c``)
hold child lists, so the tree is recursive and has no fixed schema.
``flatten_tree`` is one recursive query: the anchor takes each text's top nodes, a
step the children of the chunks that the step before has found, until none is
left. Nodes are VARIANT values, parsed once per text; no level is written, and
the result is written once, as each of its readers would run the recursion again.
``path`` (array of child positions) orders nodes in pre-order because arrays
compare lexicographically.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scribal.functions.rule_values import BLANK_SPACE, COLUMN, MISSING, RULING, SURFACE
from scribal.functions.text import let, strip_ws
from scribal.session import materialize

# VARIANT keeps the JSON type: a string "0" marks a break, a number 0 does not
_BRK = T.StructType([T.StructField("breakStart", T.VariantType()), T.StructField("breakEnd", T.VariantType())])
_GDL = T.StructType(_BRK.fields + [T.StructField("seq", T.ArrayType(_BRK)), T.StructField("group", T.ArrayType(_BRK))])
NODE_SCHEMA = T.StructType(
    [
        T.StructField("node", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("scope", T.StringType()),
        T.StructField("frag", T.StringType()),
        T.StructField("linkbase", T.StringType()),
        T.StructField(
            "f",
            T.StructType(
                [
                    T.StructField("form", T.StringType()),
                    T.StructField("lang", T.StringType()),
                    T.StructField("gdl", T.ArrayType(_GDL)),
                ]
            ),
        ),
    ]
)
NODE_KINDS = ["c", "d", "l", "ll"]
_FIELDS = "map<string,variant>"
# ---------------------------------------------------------------------------
# FIXED VALUES: the fields of each kind of node (required, other strings, other
# fields by JSON type) and the closed domains of their types.
# ---------------------------------------------------------------------------
REQUIRED = {"c": ["type", "id"], "d": ["type"], "l": ["id", "ref", "inst", "f", "props"], "ll": ["id", "choices"]}
STRINGS = {
    "c": ["type", "id", "label", "ref", "subtype", "tag"],
    "d": ["type", "ref", "label", "n", "subtype", "strict", "state", "extent", "scope", "frag", "lang", "delim", "queried",
          "flags", "o"],
    "l": ["id", "ref", "inst", "frag", "sig", "exoprj", "exolng", "exosig", "ftype", "cof-tails", "cof-head", "tail-sig", "bad"],
    "ll": ["id"],
}
OTHERS = {"c": {"cdl": "ARRAY", "implicit": "BOOLEAN"}, "d": {}, "l": {"f": "OBJECT", "props": "ARRAY", "para": "ARRAY"},
          "ll": {"choices": "ARRAY"}}
TYPES = {
    "c": ["discourse", "phrase", "sentence", "text"],
    "d": ["cell-start", "cell-end", "column", "field-start", "field-end", "line-start", "nonw", "nonx", "object", "surface"],
}
_BEGINS = {"STRING": '^"', "ARRAY": r"^\[", "OBJECT": r"^\{", "BOOLEAN": "^[tf]"}
PARA_FIELDS = ["class", "type", "text", "val", "bracketing_level"]
PARA_CLASSES = ["syntax", "boundary", "pointer"]
PARA_TYPES = ["and", "brack_o", "brack_c", "sentence", "no sentence", "no_sentence", "label", "pointer_ref"]


#: Levels after which a text counts as endless; the query fails then, by name.
MAX_DEPTH = 500
#: JSON of more bytes is walked as text: a VARIANT value holds 16 MiB at most.
VARIANT_BYTES = 15 << 20

# LIMIT ALL lifts the limit of rows that recursive queries have by default
_WALK = """
WITH RECURSIVE walk(id, path, node) MAX RECURSION LEVEL {depth} AS (
  SELECT t.id, array(e.pos), e.value
  FROM {{texts}} t, LATERAL variant_explode(try_variant_get(try_parse_json(t.json), '$.cdl', 'variant')) e
  UNION ALL
  SELECT w.id, array_append(w.path, e.pos), e.value
  FROM walk w, LATERAL variant_explode(try_variant_get(w.node, '$.cdl', 'variant')) e
  WHERE try_variant_get(w.node, '$.node', 'string') = 'c'
)
SELECT id, path, node FROM walk LIMIT ALL
"""
_WALK_TEXT = """
WITH RECURSIVE walk(id, path, node) MAX RECURSION LEVEL {depth} AS (
  SELECT t.id, array(e.pos), e.node
  FROM {{texts}} t, LATERAL posexplode(from_json(t.json, 'cdl array<string>').cdl) e(pos, node)
  UNION ALL
  SELECT w.id, array_append(w.path, e.pos), e.node
  FROM walk w, LATERAL posexplode(from_json(w.node, 'cdl array<string>').cdl) e(pos, node)
  WHERE get_json_object(w.node, '$.node') = 'c'
)
SELECT id, path, node FROM walk WHERE node IS NOT NULL LIMIT ALL
"""


def _filled(v: Column) -> Column:
    """Whether a value is a list of one item or more; its items are not looked at."""
    return F.try_variant_get(v, "$[0]", "variant").isNotNull()


def _bare(fields: Column, node: Column) -> Column:
    """A node as JSON text; a chunk's child list has been walked: an empty one stands for it."""
    emptied = F.transform_values(fields, lambda k, v: F.when(
        (k == "cdl") & _filled(v), F.parse_json(F.lit("[]"))).otherwise(v))
    return F.when(F.try_variant_get(fields["node"], "$", "string") == "c", F.to_json(emptied)).otherwise(node)


def flatten_tree(texts: DataFrame, id_col: str = "id", json_col: str = "json", max_depth: int = MAX_DEPTH) -> DataFrame:
    """``(id, path array<int>, node string)`` for every node, written to the
    shared folder; sort by ``path`` for pre-order.

    Only chunks are crawled; ``ll`` choices and linkbase contents are not. A
    chunk's own row holds its fields with an empty child list. Text that is no JSON
    or holds no node list has no nodes.
    """
    spark = texts.sparkSession
    given = texts.select(F.col(id_col).alias("id"), F.col(json_col).alias("json"))
    large = F.octet_length("json") > VARIANT_BYTES
    walked = spark.sql(_WALK.format(depth=max_depth), texts=given.filter(~large))
    # a chunk is taken apart as the value it is: its children are never written as
    # text again, level after level
    fields = F.try_variant_get("node", "$", _FIELDS)
    text = F.to_json("node")
    chunk = F.try_variant_get("node", "$.node", "string") == "c"
    out = walked.select("id", "path", F.when(chunk, _bare(fields, text)).otherwise(text).alias("node"))
    if not given.filter(large).limit(1).isEmpty():
        long = spark.sql(_WALK_TEXT.format(depth=max_depth), texts=given.filter(large))
        out = out.unionByName(long.select("id", "path", _bare(F.from_json("node", _FIELDS), F.col("node")).alias("node")))
    return materialize(out)


def node_kind(n: Column) -> Column:
    """C | d | l | ll | linkbase | null (unknown: a schema violation)."""
    return F.when(n["node"].isin(*NODE_KINDS), n["node"]).when(n["linkbase"].isNotNull(), F.lit("linkbase"))


def discontinuity_token(n: Column) -> Column:
    """The type decides first, then the state (null = no token)."""
    t, state, scope = n["type"], n["state"], n["scope"]
    return (
        F.when(t == "object", F.lit(None))
        .when(t == "line-start", F.lit("\n"))
        .when(t == "column", F.lit(f"\n{COLUMN}\n"))
        .when(t == "surface", F.lit(SURFACE))
        .when(state == "missing", F.lit(f"\n{MISSING}\n"))
        .when((state == "blank") & (scope == "line"), F.lit(f"\n{MISSING}\n"))
        .when((state == "blank") & (scope == "space"), F.lit(f"\n{BLANK_SPACE}\n"))
        .when(state == "ruling", F.lit(f"\n{RULING}\n"))
        .cast("string")
    )


def _truthy(v: Column) -> Column:
    """A JSON value counts unless it is null, false, zero or empty."""
    kind, text = F.schema_of_variant(v), F.to_json(v)
    number = F.try_variant_get(v, "$", "double")
    return F.coalesce(
        F.when(kind == "VOID", F.lit(False))
        .when(kind == "STRING", text != '""')
        .when(kind == "BOOLEAN", text == "true")
        .when(kind.startswith("ARRAY"), text != "[]")
        .when(kind.startswith("OBJECT"), text != "{}")
        .otherwise(number != 0), F.lit(False))


def _marks(b: Column) -> Column:
    return F.concat(
        F.when(_truthy(b["breakStart"]), F.lit("[")).otherwise(F.lit("")),
        F.when(_truthy(b["breakEnd"]), F.lit("]")).otherwise(F.lit("")),
    )


def bracket_sequence(gdl: Column) -> Column:
    """Per item, its ``seq`` then ``group`` children, then itself."""
    empty = F.array().cast(T.ArrayType(_BRK))

    def item(i):
        kids = F.concat(F.coalesce(i["seq"], empty), F.coalesce(i["group"], empty))
        return F.concat(F.array_join(F.transform(kids, _marks), ""), _marks(i))

    return F.coalesce(F.array_join(F.transform(gdl, item), ""), F.lit(""))


def _brackets(t: Column) -> Column:
    return F.regexp_replace(t, r"[^\[\]]", "")


def _unbracket(t: Column) -> Column:
    return F.replace(F.replace(t, F.lit("["), F.lit("")), F.lit("]"), F.lit(""))


def _insert_before_first(t: Column, ch: str, before: str, otherwise: Column) -> Column:
    pos = F.locate(before, t)
    return F.when(pos == 0, otherwise).otherwise(F.overlay(t, F.lit(ch), pos, F.lit(0)))


def repair_brackets(text: Column, ideal: Column) -> Column:
    """Make a lemma's square brackets agree with its ideal sequence.

    Every intermediate text is bound once, so the expression stays linear in
    the number of rules."""
    return let(F.struct(text.alias("t"), ideal.alias("ideal"), _brackets(text).alias("actual")), _repaired)


def _repaired(x: Column) -> Column:
    text, ideal, actual = x["t"], x["ideal"], x["actual"]

    def enclosed() -> Column:  # R2: ideal is "[...]"
        opened = F.when(actual.startswith("["), text).otherwise(F.concat(F.lit("["), text))
        closed = let(opened, lambda r: F.when(actual.endswith("]"), r).otherwise(F.concat(r, F.lit("]"))))
        return let(closed, lambda r: F.when(_brackets(r) == ideal, r).otherwise(
            F.concat(F.lit("["), _unbracket(text), F.lit("]"))))

    def fallback(r4: Column) -> Column:  # R5
        fb = let(_unbracket(r4), lambda r: F.when(ideal.contains("[]"), F.concat(F.lit("["), r, F.lit("]"))).otherwise(r))
        fb = let(fb, lambda r: F.when(ideal.startswith("["), F.concat(F.lit("["), r)).otherwise(r))
        return let(fb, lambda r: F.when(ideal.endswith("]"), F.concat(r, F.lit("]"))).otherwise(r))

    # R3 then R4 (R4 tests the actual sequence from before R3)
    r3 = F.when(ideal.startswith("]") & ~actual.startswith("]"),
                _insert_before_first(text, "]", "[", F.concat(text, F.lit("]")))).otherwise(text)
    r4 = let(r3, lambda r: F.when(ideal.endswith("[") & ~actual.endswith("["),
                                  _insert_before_first(r, "[", "]", F.concat(F.lit("["), r))).otherwise(r))
    r5 = let(r4, lambda r: F.when(_brackets(r) == ideal, r).otherwise(fallback(r)))
    return (
        F.when(ideal == "", text)
        .when(ideal == actual, text)
        .when(ideal.startswith("[") & ideal.endswith("]"), enclosed())
        .otherwise(r5)
    )


def lemma_text(n: Column) -> Column:
    """``frag`` if non-empty, else the form, else empty."""
    return F.when(F.coalesce(n["frag"], F.lit("")) != "", n["frag"]).otherwise(F.coalesce(n["f"]["form"], F.lit("")))


def node_tokens(nodes: DataFrame) -> DataFrame:
    """``(id, path, kind, tok, lang)``: one row per node, N1 + N3-N6."""
    n = F.col("n")
    parsed = nodes.select("id", "path", F.from_json("node", NODE_SCHEMA).alias("n"))
    kind = node_kind(n)
    text = lemma_text(n)
    lemma = repair_brackets(text, bracket_sequence(n["f"]["gdl"]))
    tok = F.when(kind == "d", discontinuity_token(n)).when(kind == "l", lemma)
    lang = F.when(kind == "l", n["f"]["lang"])
    return parsed.select("id", "path", kind.alias("kind"), tok.alias("tok"), lang.alias("lang"))


# FIXED VALUE: an in-band token, as matched by the surface filter
_TOKEN_RE = r"(?U)#\S*?#"


def assemble_text(tokens: DataFrame) -> DataFrame:
    """``(id, transliteration, langs)``; one ordered regroup per text.

    Texts with malformed nodes are rejects; call :func:`tree_rejects`.
    """
    grouped = tokens.groupBy("id").agg(
        F.array_sort(F.collect_list(F.when(F.coalesce(F.col("tok"), F.lit("")) != "",
                                           F.struct("path", "tok")))).alias("_t"),
        F.array_sort(F.collect_set(F.when(F.coalesce(F.col("lang"), F.lit("")) != "", F.col("lang")))).alias("_l"),
    )
    joined = F.array_join(F.transform(F.col("_t"), lambda s: s["tok"]), " ")
    surfaces = F.transform(F.split(joined, SURFACE, -1), strip_ws)
    content = lambda s: F.replace(F.replace(F.regexp_replace(s, _TOKEN_RE, ""), F.lit("\n"), F.lit("")),
                                  F.lit(" "), F.lit(""))
    kept = F.filter(surfaces, lambda s: content(s) != "")
    text = F.when(F.size(kept) > 0,
                  F.concat(F.lit(SURFACE + "\n"), F.array_join(kept, f"\n{SURFACE}\n"))).otherwise(F.lit(""))
    text = F.regexp_replace(text, " *\n *", "\n")
    text = F.regexp_replace(text, "\n+", "\n")
    text = F.regexp_replace(text, " +", " ")
    return grouped.select("id", strip_ws(text).alias("transliteration"), F.array_join("_l", ", ").alias("langs"))


def _named(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def _kind_problems(kind: str, fields: Column) -> Column:
    """Problems of a node known to be of ``kind``, as an array of texts."""
    allowed = _named(["node", *dict.fromkeys([*REQUIRED[kind], *STRINGS[kind], *OTHERS[kind]])])
    unknown = F.array_except(F.map_keys(fields), allowed)
    missing = F.filter(_named(REQUIRED[kind]), lambda f: ~F.map_contains_key(fields, f))

    def wrong(name: str, json_type: str) -> Column:
        # a value's text tells its type by how it begins
        right = F.to_json(fields[name]).rlike(_BEGINS[json_type])
        return F.when(F.map_contains_key(fields, name) & ~F.coalesce(right, F.lit(False)), F.lit(name))

    types = [wrong(n, "STRING") for n in STRINGS[kind]] + [wrong(n, t) for n, t in OTHERS[kind].items()]
    mistyped = F.array_compact(F.array(*types))
    parts = [
        F.transform(unknown, lambda f: F.concat(F.lit("unknown field "), f)),
        F.transform(missing, lambda f: F.concat(F.lit("missing field "), f)),
        F.transform(mistyped, lambda f: F.concat(F.lit("wrong type of "), f)),
    ]
    none = F.array().cast("array<string>")
    if kind in TYPES:
        value = F.try_variant_get(fields["type"], "$", "string")
        parts.append(F.when(~value.isin(*TYPES[kind]), F.array(F.lit("value outside domain: type"))).otherwise(none))
    if kind == "l":
        entries = F.from_json(F.to_json(fields["para"]), "array<map<string,string>>")
        bad = F.exists(entries, lambda e: (F.size(F.array_except(F.map_keys(e), _named(PARA_FIELDS))) > 0)
                       | (F.size(F.array_except(_named(PARA_FIELDS), F.map_keys(e))) > 0)
                       | ~e["class"].isin(*PARA_CLASSES) | ~e["type"].isin(*PARA_TYPES))
        parts.append(F.when(F.coalesce(bad, F.lit(False)), F.array(F.lit("malformed para"))).otherwise(none))
    return F.concat(*parts)


def node_problems(node: Column) -> Column:
    """What is wrong with one node (JSON text): an array, empty if nothing."""

    def judge(fields: Column) -> Column:
        kind = F.try_variant_get(fields["node"], "$", "string")
        out = F.when(fields.isNull(), F.array(F.lit("not an object")))
        for k in NODE_KINDS:
            out = out.when(kind == k, _kind_problems(k, fields))
        out = out.when(F.map_contains_key(fields, "linkbase"), F.array().cast("array<string>"))
        return out.otherwise(F.array(F.lit("unknown node kind")))

    return let(F.from_json(node, _FIELDS), judge)


def tree_rejects(texts: DataFrame, nodes: DataFrame, id_col: str = "id", json_col: str = "json") -> DataFrame:
    """``(id, scope, reason)`` of texts that cannot be used, one row each: text
    files that are no JSON or hold no node list (scope ``text``), and texts with
    nodes that break the node tables (scope ``tree``; the problems, in order)."""
    parsed = F.try_parse_json(F.col(json_col))
    top = F.try_variant_get(parsed, "$.cdl", "variant")
    listed = _filled(top) | F.coalesce(F.to_json(top) == "[]", F.lit(False))
    reason = F.when(parsed.isNull(), F.lit("malformed JSON")).when(~listed, F.lit("no node list"))
    files = texts.select(F.col(id_col).alias("id"), F.lit("text").alias("scope"), reason.alias("reason"))
    problems = nodes.select("id", F.explode(node_problems(F.col("node"))).alias("reason"))
    trees = problems.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("reason")), "; ").alias("reason"))
    return files.filter(F.col("reason").isNotNull()).unionByName(
        trees.select("id", F.lit("tree").alias("scope"), "reason"))
