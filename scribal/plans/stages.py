"""The six-stage corpus run as Spark jobs over stage tables (S7, S8, S10,
S12, S13).

Each stage reads the previous stage's Parquet table and writes its own: the
written table is the lineage cut. Every stage, and every corpus of the ingest,
leaves a record of what it was made from and what it wrote (see
:mod:`scribal.plans.manifest`), as the last thing it does; a later run makes again
what has no record or was made from other inputs or rules, and nothing else.
Paths may lie in any store that Spark reads. No stage collects data to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scribal.operators import clean as C
from scribal.operators import resolve as R
from scribal.operators import stats as S
from scribal.functions import rule_values as V
from scribal.operators.collate import collate
from scribal.operators.lookups import glyph_index, glyph_pairs, invert, reading_index, reading_pairs
from scribal.operators.split import split_stratified
from scribal.operators.tree import assemble_text, flatten_tree, node_tokens, tree_rejects
from scribal.sources.catalogue import CORPORA, attach_texts, conform_catalogue, read_catalogue, read_texts
from scribal.sources.rules import load_pairs
from scribal.sources.signs import read_reading_index, read_sign_list
from scribal.plans import manifest as M
from scribal.session import materialize, path_exists, remove_path

STAGES = ["ingest", "collate", "clean", "lookups", "glyphs", "split"]
_REJECTS = "corpus string, id string, scope string, reason string"
#: Rule tables that a run may replace, by name.
RULES: dict[str, list[tuple[str, str]]] = {
    "genres": V.GENRE_NORMALIZATION, "signs": V.SIGN_LIST_REPLACEMENTS, "numbers": V.READING_FIXES,
    "names": V.GLYPH_NAME_REPLACEMENTS,
}


def _path(stage_dir: str, name: str) -> str:
    return f"{stage_dir.rstrip('/')}/{name}"


def write_stage(df: DataFrame, stage_dir: str, name: str, partition_by: list[str] | None = None, text: str | None = None) -> M.Output:
    """Write a stage table; rows, rows with an empty ``text`` and the content's
    fingerprint are observed on the way."""
    return M.write_observed(df, _path(stage_dir, name), F.col(text) if text else None, partition_by or ())


def read_stage(spark: SparkSession, stage_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(_path(stage_dir, name))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with quoted multi-line values (texts hold newlines)."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def import_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    if schema:
        r = r.schema(schema)
    return r.csv(path).na.fill("")


def read_rejects(spark: SparkSession, stage_dir: str) -> DataFrame:
    """``(corpus, id, scope, reason)``; readable when nothing was rejected."""
    path = _path(stage_dir, "rejects")
    return spark.read.schema(_REJECTS).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], _REJECTS)


def load_rules(spark: SparkSession, paths: Mapping[str, str] | None) -> dict[str, list[tuple[str, str]]]:
    """The built-in rule tables, with those of ``paths`` read from files."""
    unknown = set(paths or {}) - set(RULES)
    if unknown:
        raise ValueError(f"unknown rule tables {sorted(unknown)}; there are {sorted(RULES)}")
    return RULES | {name: load_pairs(spark, path) for name, path in (paths or {}).items()}


def ingest_corpus(spark: SparkSession, landing: str, corpus: str, kind: str, rank: int) -> tuple[DataFrame, DataFrame]:
    """S2-S6 + N1-N10 of one corpus: ``(texts, rejects)``. Each catalogue member
    is in one of both; ``langs`` is replaced by the tree's languages."""
    good, cat_rejects = conform_catalogue(read_catalogue(spark, landing, corpus), corpus, kind, rank)
    rows, missing = attach_texts(good, read_texts(spark, landing, corpus))
    rows = materialize(rows)
    files = rows.select("id", "json").dropDuplicates(["id"])
    nodes = flatten_tree(files)
    bad = materialize(tree_rejects(files, nodes))
    text = assemble_text(node_tokens(nodes)).withColumnRenamed("id", "_k")
    out = rows.drop("json", "langs").join(bad.select("id").distinct(), "id", "left_anti")
    out = out.join(text, out["id"] == text["_k"], "left").drop("_k")
    for c in ("transliteration", "langs"):
        out = out.withColumn(c, F.coalesce(c, F.lit("")))
    tree_bad = rows.select("corpus", "id").join(bad, "id").select("corpus", "id", "scope", "reason")
    return out, cat_rejects.unionByName(missing).unionByName(tree_bad)


def stage_ingest(spark: SparkSession, landing: str, stage_dir: str, corpus: str, kind: str, rank: int) -> dict[str, M.Output]:
    """One landed corpus; what an earlier run has left of it goes."""
    for name in ("texts", "rejects"):
        remove_path(spark, f"{_path(stage_dir, name)}/corpus={corpus}")
    texts, rejects = ingest_corpus(spark, landing, corpus, kind, rank)
    return {"rejects": write_stage(rejects, stage_dir, "rejects", ["corpus"]),
            "texts": write_stage(texts, stage_dir, "texts", ["corpus"], "transliteration")}


def stage_collate(spark: SparkSession, stage_dir: str, genres: Sequence[tuple[str, str]] = tuple(V.GENRE_NORMALIZATION),
                  corpora: Sequence[str] = tuple(c for c, _ in CORPORA)) -> dict[str, M.Output]:
    """``corpora``: those whose texts take part, in union order."""
    texts = read_stage(spark, stage_dir, "texts")
    tables = [texts.filter(F.col("corpus") == c).drop("corpus") for c in corpora]
    return {"collated": write_stage(collate(tables, genre_rules=genres), stage_dir, "collated", text="transliteration")}


def stage_clean(spark: SparkSession, stage_dir: str) -> dict[str, M.Output]:
    return {"cleaned": write_stage(C.clean(read_stage(spark, stage_dir, "collated")), stage_dir, "cleaned", text="transliteration_clean")}


def stage_lookups(spark: SparkSession, stage_dir: str, sign_list: str, reading_list: str) -> dict[str, M.Output]:
    signs = read_sign_list(spark, sign_list)
    readings = reading_index(reading_pairs(signs), read_reading_index(spark, reading_list))
    return {"readings": write_stage(readings, stage_dir, "readings"),
            "glyphs": write_stage(glyph_index(glyph_pairs(signs)), stage_dir, "glyphs", text="glyph")}


def stage_glyphs(spark: SparkSession, stage_dir: str, signs: Sequence[tuple[str, str]] = tuple(V.SIGN_LIST_REPLACEMENTS),
                 numbers: Sequence[tuple[str, str]] = tuple(V.READING_FIXES),
                 names: Sequence[tuple[str, str]] = tuple(V.GLYPH_NAME_REPLACEMENTS)) -> dict[str, M.Output]:
    texts = materialize(R.prepare(read_stage(spark, stage_dir, "cleaned"), replacements=signs))
    readings = read_stage(spark, stage_dir, "readings")
    glyphs = read_stage(spark, stage_dir, "glyphs")
    parallel, tokens, details = R.add_glyphs(texts, readings, glyphs, invert(readings), ["id", "ord"],
                                             number_rules=numbers, name_rules=names)
    full = parallel.join(texts.select("id", "period", "genre"), "id").select(
        "id", "ord", "period", "genre", "transliteration", "glyph_names", "glyphs")
    occ = materialize(S.occurrences(tokens, details, "ord"))  # ties go to the first text in order
    return {"parallel": write_stage(R.dedup_parallel(full), stage_dir, "parallel", text="transliteration"),
            "wordform_details": write_stage(details, stage_dir, "wordform_details"),
            "stats_rates": write_stage(S.conversion_rates(occ), stage_dir, "stats_rates"),
            "stats_top": write_stage(S.top_unresolved(occ), stage_dir, "stats_top"),
            "stats_observed": write_stage(S.observed_readings(occ), stage_dir, "stats_observed")}


def stage_split(spark: SparkSession, stage_dir: str, seed: int = 42) -> dict[str, M.Output]:
    parallel = read_stage(spark, stage_dir, "parallel")
    out = split_stratified(parallel, "period", "id", route_to_train=F.col("genre") == "Lexical", seed=seed)
    splits = write_stage(out.drop("ord"), stage_dir, "splits", ["split"], "transliteration")
    final = read_stage(spark, stage_dir, "splits")
    counts = S.glyph_count(final)
    content = S.fingerprint(final, ["id", "period", "genre", "transliteration", "glyph_names", "glyphs"])
    return {"splits": splits, "totals": write_stage(counts.join(content, "n_rows"), stage_dir, "totals")}  # one row each


class _Run:
    """The parts of a run, each made unless its record says that it is there."""

    def __init__(self, spark: SparkSession, stage_dir: str, from_stage: int | None):
        self.spark, self.stage_dir, self.from_stage = spark, stage_dir, from_stage

    def part(self, stage: str, part: str, made_from, make) -> dict[str, M.Output]:
        """What the part wrote, now or in the run that its record is of."""
        wanted = M.digest(stage, part, made_from)
        known = M.read_record(self.spark, self.stage_dir, stage, part)
        number = STAGES.index(stage) + 1
        if known is not None:
            before, forced = self.from_stage is not None and number < self.from_stage, self.from_stage is not None and number >= self.from_stage
            if before or known.wanted == wanted and not forced:
                return dict(known.outputs)
        M.drop_record(self.spark, self.stage_dir, stage, part)
        outputs = make()
        M.write_record(self.spark, self.stage_dir, M.Record(stage, part, wanted, outputs))
        return outputs


def _contents(outputs: Mapping[str, M.Output]) -> dict[str, tuple[int, str]]:
    return {table: (o.rows, o.content) for table, o in outputs.items()}


def _fixed_rules() -> str:
    """The built-in rule tables that stages use besides those of :data:`RULES`."""
    return M.digest({k: sorted(v) if isinstance(v, (set, frozenset)) else v for k, v in vars(V).items() if k.isupper()})


def run_stages(spark: SparkSession, landing: str, stage_dir: str, sign_list: str, reading_list: str,
               from_stage: int | None = None, rules: Mapping[str, str] | None = None, by_content: bool = True) -> None:
    """Make whatever is not there or was made from something else.

    ``from_stage`` (1-based, as :data:`STAGES`) makes that stage and those after
    it in any case, and takes what the stages before it have committed as it is.
    ``rules`` names rule files (see :data:`RULES`) that replace built-in tables.
    Landed files are told apart by their contents, which reads them once a run, or
    without ``by_content`` by length and time of change.
    """
    r = load_rules(spark, rules)
    run, fixed = _Run(spark, stage_dir, from_stage), _fixed_rules()
    landed = [(rank, c, kind) for rank, (c, kind) in enumerate(CORPORA) if path_exists(spark, f"{landing.rstrip('/')}/{c}")]
    texts = {
        corpus: run.part("ingest", corpus, [M.file_fingerprint(spark, f"{landing.rstrip('/')}/{corpus}", by_content), kind, rank, fixed],
                         lambda: stage_ingest(spark, landing, stage_dir, corpus, kind, rank))
        for rank, corpus, kind in landed}
    corpora = [c for _, c, _ in landed]
    collated = run.part("collate", M.WHOLE, [[(c, _contents(o)) for c, o in texts.items()], r["genres"], fixed],
                        lambda: stage_collate(spark, stage_dir, r["genres"], corpora))
    cleaned = run.part("clean", M.WHOLE, [_contents(collated), fixed], lambda: stage_clean(spark, stage_dir))
    lists = [M.file_fingerprint(spark, p, by_content) for p in (sign_list, reading_list)]
    lookups = run.part("lookups", M.WHOLE, [lists, fixed], lambda: stage_lookups(spark, stage_dir, sign_list, reading_list))
    parallel = run.part("glyphs", M.WHOLE, [_contents(cleaned), _contents(lookups), r["signs"], r["numbers"], r["names"], fixed],
                        lambda: stage_glyphs(spark, stage_dir, r["signs"], r["numbers"], r["names"]))
    run.part("split", M.WHOLE, [_contents(parallel), fixed], lambda: stage_split(spark, stage_dir))


STAGE_TABLES = ["texts", "collated", "cleaned", "readings", "glyphs", "parallel", "splits"]


def stage_counts(spark: SparkSession, stage_dir: str) -> DataFrame:
    """T4: ``(stage, n_rows)`` for every written stage table (Parquet row
    counts come from file footers, so this reads no data pages)."""
    found = [n for n in STAGE_TABLES if path_exists(spark, _path(stage_dir, n))]
    if not found:
        return spark.createDataFrame([], "stage string, n_rows bigint")
    return reduce(DataFrame.unionByName, [
        read_stage(spark, stage_dir, n).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("stage"), "n_rows")
        for n in found])
