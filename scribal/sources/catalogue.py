"""Corpus registry, catalogue and text readers, id rules, conformance.

Layout of a landing folder per corpus: a ``catalogue.json`` somewhere
below ``<landing>/<corpus>/`` (``{"members": {text_id: {field: value}}}``)
and one JSON tree per text in a ``corpusjson`` folder next to it.
Catalogues keep JSON member order (the keep-first order) and let the last
duplicate key win, as Python does; a large one is read in many tasks (see
:mod:`scribal.sources.members`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scribal.operators.collate import order_number
from scribal.session import path_exists
from scribal.sources.members import read_members

# ---------------------------------------------------------------------------
# FIXED VALUES: corpora in union order (= keep-first precedence), with the
# text model each uses.
# ---------------------------------------------------------------------------
CORPORA = [
    ("admin_ed12", "base"),
    ("admin_ed3a", "base"),
    ("admin_ed3b", "base"),
    ("admin_oakk", "base"),
    ("admin_lagash2", "base"),
    ("admin_ur3", "ur3"),
    ("early_lit", "early_literary"),
    ("oldbab_lit", "oldbab_literary"),
    ("royal", "royal"),
    ("incantations", "base"),
    ("liturgies", "base"),
    ("udughul", "base"),
    ("varia", "base"),
]

# FIXED VALUES: catalogue fields of every text, then the extra ones per model
BASE_FIELDS = [
    "id_text", "designation", "language", "object_type", "period", "genre", "subgenre", "supergenre",
    "excavation_no", "museum_no", "primary_publication", "provenience", "publication_history",
    "accession_no", "bdtns_id", "date_of_origin", "images", "langs", "project", "public", "status",
    "trans", "uri", "xproject",
]
REQUIRED_FIELDS = ["provenience", "project"]
EXTRA_FIELDS = {
    "base": [],
    "ur3": [
        "acquisition_history", "ark_number", "atf_source", "atf_up", "author", "author_remarks",
        "cdli_comments", "citation", "collection", "date_entered", "date_remarks", "date_updated",
        "dates_referenced", "db_source", "electronic_publication", "external_id",
        "google_earth_collection", "height", "id", "id_text_int", "lineart_up", "material",
        "object_remarks", "photo_up", "provenience_remarks", "publication_date",
        "published_collation", "seal_id", "seal_information", "subgenre_remarks", "thickness",
        "translation_source", "width",
    ],
    "early_literary": ["id_composite", "keywords", "place"],
    "oldbab_literary": ["chap", "distribution", "id_composite", "keywords", "place", "provdist", "sec1", "sec2",
                        "sources"],
    "royal": ["distribution", "id_composite", "keywords", "place", "primary_edition", "provdist", "ruler",
              "sources"],
}

# FIXED VALUES: closed value domains of catalogue fields ("" = unspecified)
DOMAINS = {
    "genre": ["Administrative", "Astronomical", "Hymn-Prayer", "fake (modern)", "Legal", "Letter", "Lexical",
              "Lexical; School", "Literary", "Liturgy", "Mathematical", "Ritual", "Royal Inscription",
              "Royal/Monumental", "Scientific", "uncertain", ""],
    "language": ["Akkadian", "non-Sumerian (Eblaite)", "non-Sumerian (undetermined)", "Sumerian", "S-A bilingual", ""],
    "object_type": ["barrel", "Brand", "brick", "bulla", "Bulla", "Bulla (?)", "Clay sealing", "cone", "cylinder",
                    "Cylinder Seal", "Cylindrical tablet", "Door sealing", "Envelope (?)", "Envelope - Closed",
                    "Envelope - Closed (?)", "Envelope - Fragment", "Envelope - Fragment (?)", "Fake", "Fake (?)",
                    "Jar sealing", "Label", "Label (?)", "Other", "other (see object remarks)", "prism",
                    "Reproduction or cast", "Reproduction or cast (?)", "Round tablet", "seal (not impression)",
                    "sealing", "tablet", "Tablet", "tablet & envelope", "Tablet and envelope",
                    "Tablet and Envelope", "tag", "Uncertain", ""],
    "period": ["Early Dynastic I-II", "Early Dynastic IIIa", "Early Dynastic IIIb", "Ebla", "fake", "Lagash II",
               "Middle Babylonian", "Neo-Assyrian", "Neo-Babylonian", "Old Akkadian", "Old Babylonian",
               "Pre-Uruk V", "Ur III", "Uncertain", "Unknown", ""],
    "status": ["A", "D", "I", ""],
    "supergenre": ["ELA", "LEX", "LIT", "STL", "unknown", "UNK", ""],
    "xproject": ["CDLI", ""],
}


def corpora(spark: SparkSession) -> DataFrame:
    """``(corpus, corpus_rank, kind)`` - a fixed 13-row dimension."""
    return spark.createDataFrame([(c, i, k) for i, (c, k) in enumerate(CORPORA)], "corpus string, corpus_rank int, kind string")


def allowed_fields(kind: str) -> list[str]:
    return BASE_FIELDS + EXTRA_FIELDS[kind]


def text_id_expr(kind: str, id_text: Column, id_composite: Column | None) -> Column:
    """Which catalogue field names a text's file."""
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    if kind in ("early_literary", "oldbab_literary"):
        return F.when(blank(id_composite), F.coalesce(id_text, F.lit(""))).otherwise(id_composite)
    if kind == "royal":
        return F.when(blank(id_text), F.coalesce(id_composite, F.lit(""))).otherwise(id_text)
    return F.coalesce(id_text, F.lit(""))


def catalogue_from_text(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """S2 body: whole-file catalogue JSON -> ``(pos, key, meta map)`` rows."""
    schema = T.StructType([T.StructField("members", T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())))])
    parsed = raw.select(F.from_json(F.col(value_col), schema)["members"].alias("m"))
    return parsed.select(F.posexplode(F.map_entries("m")).alias("pos", "e")).select(
        "pos", F.col("e.key").alias("key"), F.col("e.value").alias("meta")
    )


def catalogue_folder(spark: SparkSession, landing: str, corpus: str) -> str | None:
    """The folder of the corpus's catalogue: of several the least deep one, then the
    first by name. Its texts are read from there, not from other folders."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "catalogue.json").load(f"{landing.rstrip('/')}/{corpus}"))  # paths only
    first = found.select("path").orderBy(F.size(F.split("path", "/")), "path").limit(1).collect()
    return first[0]["path"].rpartition("/")[0] if first else None


def read_catalogue(spark: SparkSession, landing: str, corpus: str) -> DataFrame:
    """One row per catalogue member of ``corpus``, in member order; none if no
    catalogue has landed."""
    folder = catalogue_folder(spark, landing, corpus)
    if folder is None:
        return catalogue_from_text(spark.createDataFrame([], "value string"))
    return read_members(spark, f"{folder}/catalogue.json")


def conform_catalogue(cat: DataFrame, corpus: str, kind: str, corpus_rank: int) -> tuple[DataFrame, DataFrame]:
    """Typed columns, text id, ``ord``; returns ``(good, rejects)``.

    Rejects (``scope = 'catalogue'``): unknown fields, missing required
    fields, values outside a closed domain, or an empty text id.
    """
    allowed = allowed_fields(kind)
    meta = F.col("meta")
    unknown = F.array_except(F.map_keys(meta), F.array(*[F.lit(a) for a in allowed]))
    missing = F.filter(F.array(*[F.lit(r) for r in REQUIRED_FIELDS]), lambda r: ~F.map_contains_key(meta, r))
    bad_domain = F.filter(
        F.array(*[F.when(~F.coalesce(meta[f], F.lit("")).isin(*vals), F.lit(f)) for f, vals in DOMAINS.items()]),
        lambda x: x.isNotNull(),
    )
    id_text = meta["id_text"]
    id_comp = meta["id_composite"] if "id_composite" in allowed else None
    file_id = text_id_expr(kind, id_text, id_comp)
    cols = {("id_" if f == "id" else f): F.coalesce(meta[f], F.lit("")) for f in allowed}  # S6: null -> ""
    x = cat.select(
        F.lit(corpus).alias("corpus"),
        order_number(corpus_rank, F.col("pos")).alias("ord"),
        file_id.alias("id"),
        *[v.alias(k) for k, v in cols.items()],
        F.concat(
            F.transform(unknown, lambda k: F.concat(F.lit("unknown field "), k)),
            F.transform(missing, lambda k: F.concat(F.lit("missing field "), k)),
            F.transform(bad_domain, lambda k: F.concat(F.lit("value outside domain: "), k)),
            F.when(file_id == "", F.array(F.lit("no text id"))).otherwise(F.array().cast("array<string>")),
        ).alias("_problems"),
    )
    good = x.filter(F.size("_problems") == 0).drop("_problems")
    rejects = x.filter(F.size("_problems") > 0).select(
        "corpus", "id", F.lit("catalogue").alias("scope"), F.array_join("_problems", "; ").alias("reason")
    )
    return good, rejects


def read_texts(spark: SparkSession, landing: str, corpus: str) -> DataFrame:
    """S3: ``(file_id, json)`` for every text file beside the corpus's catalogue."""
    folder = catalogue_folder(spark, landing, corpus)
    if folder is None or not path_exists(spark, f"{folder}/corpusjson"):
        return spark.createDataFrame([], "file_id string, json string")
    raw = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(f"{folder}/corpusjson")
    name = F.col("_metadata.file_name")
    return raw.select(F.regexp_replace(name, r"\.json$", "").alias("file_id"), F.col("value").alias("json"))


def attach_texts(good: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3 join: catalogue rows left-joined to their files; a missing file is
    a text reject (the row is not dropped silently)."""
    j = good.join(texts, good["id"] == texts["file_id"], "left")
    ok = j.filter(F.col("json").isNotNull()).drop("file_id")
    rejects = j.filter(F.col("json").isNull()).select(
        "corpus", "id", F.lit("text").alias("scope"), F.lit("missing text file").alias("reason")
    )
    return ok, rejects
