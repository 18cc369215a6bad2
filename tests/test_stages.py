import json

import pytest

from scribal.plans import manifest as M
from scribal.plans import stages
from scribal.plans.stages import export_csv, import_csv, load_rules, read_rejects, read_stage, run_stages, stage_counts


def _lemma(form, lang="sux"):
    return {"node": "l", "id": "i", "ref": "r", "inst": "x", "props": [], "f": {"form": form, "lang": lang, "gdl": []}}


def _tree(*lines):
    cdl = [{"node": "d", "type": "surface"}]
    for words in lines:
        cdl.append({"node": "d", "type": "line-start"})
        cdl.extend(_lemma(w) for w in words)
    return {"cdl": [{"node": "c", "type": "text", "id": "t", "cdl": cdl}]}


def _write_corpus(root, corpus, members, texts):
    d = root / corpus / "x"
    (d / "corpusjson").mkdir(parents=True)
    (d / "catalogue.json").write_text(json.dumps({"members": members}, ensure_ascii=False))
    for tid, tree in texts.items():
        (d / "corpusjson" / f"{tid}.json").write_text(tree if isinstance(tree, str) else json.dumps(tree, ensure_ascii=False))


def test_run_stages_end_to_end(spark, tmp_path):
    landing = tmp_path / "landing"
    base = {"provenience": "p", "project": "q", "language": "Sumerian", "period": "Ur III", "genre": "Administrative"}
    members = {f"P{i}": dict(base, id_text=f"P{i}") for i in range(1, 41)}
    members["P40"]["genre"] = "Lexical"
    members["P39"]["bogus"] = "1"  # unknown field -> catalogue reject
    texts = {f"P{i}": _tree(["lugal", f"{i}", "ki"], ["mu", "x", "[ma]"]) for i in range(1, 39)}
    texts["P2"] = texts["P1"]  # duplicate transliteration -> dropped by keep-first
    royal = {"R1": dict(base, id_text="", id_composite="Q1", genre="Royal/Monumental"), "P1": dict(base, id_text="P1")}
    for bad in ("BAD", "NOKEY", "ENUM", "EMPTY"):
        members[bad] = dict(base, id_text=bad)
    texts |= {"BAD": "{", "NOKEY": {"text": []}, "ENUM": {"cdl": [{"node": "d", "type": "nothing"}]}, "EMPTY": {"cdl": []}}
    _write_corpus(landing, "admin_ed12", members, texts)
    _write_corpus(landing, "royal", royal, {"Q1": _tree(["lugal", "ki"]), "P1": _tree(["other", "text"])})
    sl = {"sl:signlist": {"j:letters": [{"sl:letter": {"j:signs": [
        {"sl:sign": {"n": "LUGAL", "sl:ucun": "𒈗", "j:values": [{"sl:v": {"n": "lugal"}}]}},
        {"sl:sign": {"n": "KI", "sl:ucun": "𒆠", "j:values": [{"sl:v": {"n": "ki"}}]}},
        {"sl:sign": {"n": "MU", "sl:ucun": "𒈬", "j:values": [{"sl:v": {"n": "mu"}}]}},
        {"sl:sign": {"n": "DIŠ", "sl:ucun": "𒁹", "j:values": [{"sl:v": {"n": "1(diš)"}}]}}]}}]}}
    (tmp_path / "sl.json").write_text(json.dumps(sl, ensure_ascii=False))
    (tmp_path / "idx.json").write_text(json.dumps({"index": {}}))
    stages = str(tmp_path / "stages")
    (landing / "royal" / "x" / "old" / "corpusjson").mkdir(parents=True)  # another folder's texts are not this catalogue's
    (landing / "royal" / "x" / "old" / "corpusjson" / "Q1.json").write_text(json.dumps(_tree(["wrong"])))
    (landing / "royal" / "x" / "old" / "catalogue.json").write_text(json.dumps({"members": {"W": {}}}))
    run_stages(spark, str(landing), stages, str(tmp_path / "sl.json"), str(tmp_path / "idx.json"))
    metrics = {(r.stage, r.part, r.table): (r.n_rows, r.n_empty) for r in M.stage_metrics(spark, stages).collect()}
    assert metrics["ingest", "admin_ed12", "texts"] == (39, 1) and metrics["ingest", "royal", "texts"] == (2, 0)
    assert metrics["split", "all", "splits"][0] == metrics["glyphs", "all", "parallel"][0]

    rejects = {(r.id, r.scope) for r in read_rejects(spark, stages).collect()}
    assert {"BAD", "NOKEY", "ENUM"} == {i for i, s in rejects if i in ("BAD", "NOKEY", "ENUM")}
    ingested = {r.id: r for r in read_stage(spark, stages, "texts").collect()}
    assert not {"BAD", "NOKEY", "ENUM"} & set(ingested) and all(r.langs is not None for r in ingested.values())
    assert ingested["EMPTY"].transliteration == "" and ingested["EMPTY"].langs == ""
    assert ("P39", "catalogue") in rejects and ("P39", "text") not in rejects
    assert ("P40", "text") in rejects  # no text file
    collated = {r.id: r for r in read_stage(spark, stages, "collated").collect()}
    assert "P1" in collated and collated["Q1"].genre == "Royal Inscription"
    assert collated["P1"].transliteration.startswith("#SURFACE#\nlugal 1 ki\nmu x [ma]")
    par = {r.id: r for r in read_stage(spark, stages, "parallel").collect()}
    assert "P2" not in par  # same text as P1, later in order
    assert par["P1"].transliteration == "<SURFACE>\nlugal 1(diš) ki\nmu..."
    assert par["P1"].glyphs == "<SURFACE>\n𒈗𒁹𒆠\n𒈬..."
    splits = read_stage(spark, stages, "splits")
    assert splits.count() == len(par)
    assert read_stage(spark, stages, "totals").first().n_rows == len(par)
    counts = {r.stage: r.n_rows for r in stage_counts(spark, stages).collect()}
    assert counts["parallel"] == len(par) and counts["texts"] >= counts["collated"] >= counts["cleaned"]
    assert dict((r.stage, r.n_rows) for r in stage_counts(spark, str(tmp_path / "none")).collect()) == {}

    # A finished corpus is skipped, a later start reuses what is written
    before = {r.id: r.split for r in splits.collect()}
    (tmp_path / "names.json").write_text(json.dumps({"LUGAL": "KI"}))
    run_stages(spark, str(landing), stages, str(tmp_path / "sl.json"), str(tmp_path / "idx.json"), from_stage=5,
               rules={"names": str(tmp_path / "names.json")})
    again = {r.id: r for r in read_stage(spark, stages, "parallel").collect()}
    assert again["P1"].glyphs == "<SURFACE>\n𒆠𒁹𒆠\n𒈬..."  # the rule file took effect
    assert set(before) >= set(again)
    top = read_stage(spark, stages, "stats_top").collect()
    assert all(r.category_total >= r.n for r in top)


class _Lost(Exception):
    pass


def test_resume_by_records(spark, tmp_path, monkeypatch):
    """A run makes what has no record or was made from something else, and no more."""
    landing, out = tmp_path / "landing", str(tmp_path / "stages")
    base = {"provenience": "p", "project": "q", "language": "Sumerian", "period": "Ur III", "genre": "Administrative"}
    for corpus, ids in (("royal", "AB"), ("varia", "CDE")):
        _write_corpus(landing, corpus, {i: dict(base, id_text=i) for i in ids}, {i: _tree(["lugal", i, "ki"]) for i in ids})
    sign = {"n": "LUGAL", "sl:ucun": "𒈗", "j:values": [{"sl:v": {"n": "lugal"}}]}
    (tmp_path / "sl.json").write_text(json.dumps({"sl:signlist": {"j:letters": [{"sl:letter": {"j:signs": [{"sl:sign": sign}]}}]}}))
    (tmp_path / "idx.json").write_text(json.dumps({"index": {}}))
    (tmp_path / "genres.json").write_text(json.dumps([["Nothing", "Else"]]))
    made = []
    for name in ("ingest", "collate", "clean", "lookups", "glyphs", "split"):
        real = getattr(stages, f"stage_{name}")
        monkeypatch.setattr(stages, f"stage_{name}", lambda *a, real=real, name=name, **k: made.append(
            f"{name}:{a[3]}" if name == "ingest" else name) or real(*a, **k))

    def run(**more):
        made.clear()
        run_stages(spark, str(landing), out, str(tmp_path / "sl.json"), str(tmp_path / "idx.json"),
                   rules={"genres": str(tmp_path / "genres.json")}, **more)
        return list(made)

    assert run() == ["ingest:royal", "ingest:varia", "collate", "clean", "lookups", "glyphs", "split"]
    assert run() == []
    # an edited rule file: its stage is made again, and nothing after it if the rows stay the same
    (tmp_path / "genres.json").write_text(json.dumps([["Nothing", "Other"]]))
    assert run() == ["collate"]
    (tmp_path / "genres.json").write_text(json.dumps([["Administrative", "Admin"]]))
    assert run() == ["collate", "clean", "glyphs", "split"]
    assert {r.genre for r in read_stage(spark, out, "splits").collect()} == {"Admin"}
    # an edited text: its corpus and what follows
    (landing / "varia" / "x" / "corpusjson" / "C.json").write_text(json.dumps(_tree(["lugal", "new"])))
    assert run() == ["ingest:varia", "collate", "clean", "glyphs", "split"]
    # a run that is lost between the tables of a stage leaves no record of it
    real_write, written = stages.write_stage, []

    def lost(df, stage_dir, name, *a, **k):
        if name == "stats_rates":
            raise _Lost
        written.append(name)
        return real_write(df, stage_dir, name, *a, **k)

    (landing / "royal" / "x" / "corpusjson" / "A.json").write_text(json.dumps(_tree(["lugal", "other"])))
    with monkeypatch.context() as m:
        m.setattr(stages, "write_stage", lost)
        with pytest.raises(_Lost):
            run()
    assert "parallel" in written and M.read_record(spark, out, "glyphs") is None
    assert run() == ["glyphs", "split"]
    # one that is lost inside the ingest leaves a folder, which does not count
    M.drop_record(spark, out, "ingest", "royal")
    assert run() == ["ingest:royal"]
    assert sorted(r.id for r in read_stage(spark, out, "texts").collect()) == list("ABCDE")
    assert run(from_stage=6) == ["split"]
    counts = {(r.stage, r.part, r.table): r.n_rows for r in M.stage_metrics(spark, out).collect()}
    assert counts["collate", "all", "collated"] == 5 and counts["ingest", "royal", "rejects"] == 0


def test_file_fingerprints_and_empty_tables(spark, tmp_path):
    (tmp_path / "d").mkdir()
    assert M.file_fingerprint(spark, str(tmp_path / "none")) == "absent"
    (tmp_path / "d" / "a.json").write_text("{}")
    one = M.file_fingerprint(spark, str(tmp_path / "d"))
    (tmp_path / "d" / "a.json").write_text("{ }")
    assert M.file_fingerprint(spark, str(tmp_path / "d")) != one
    (tmp_path / "d" / "a.json").write_text("{}")
    assert M.file_fingerprint(spark, str(tmp_path / "d")) == one
    empty = spark.createDataFrame([], "t string, names array<string>")
    assert M.write_observed(empty, str(tmp_path / "e")) == M.Output(0, 0, "0")
    rows = spark.createDataFrame([("a", ["x"]), ("", None), (None, [])], "t string, names array<string>")
    seen = [M.write_observed(rows.repartition(n), str(tmp_path / f"o{n}"), rows["t"]) for n in (1, 3)]
    assert seen[0] == seen[1] and (seen[0].rows, seen[0].empty) == (3, 2)
    assert M.stage_metrics(spark, str(tmp_path / "none")).count() == 0


def test_rule_files_and_empty_rejects(spark, tmp_path):
    with pytest.raises(ValueError):
        load_rules(spark, {"nothing": "x"})
    assert read_rejects(spark, str(tmp_path)).count() == 0


def test_csv_round_trip(spark, tmp_path):
    rows = [("a", 'one\ntwo "quoted", comma', ""), ("b", "", "x")]
    df = spark.createDataFrame(rows, "id string, t string, u string")
    export_csv(df, str(tmp_path / "c"))
    assert sorted(tuple(r) for r in import_csv(spark, str(tmp_path / "c"), "id string, t string, u string").collect()) == rows
