import json

from scribal.functions import rule_values as V
from scribal.sources.rules import load_pairs, rules_frame


def test_load_pairs_keeps_order(spark, tmp_path):
    m = tmp_path / "m.json"
    m.write_text(json.dumps(dict(V.GENRE_NORMALIZATION)))
    assert load_pairs(spark, str(m)) == V.GENRE_NORMALIZATION
    lst = tmp_path / "l.json"
    lst.write_text(json.dumps([list(p) for p in V.SIGN_LIST_REPLACEMENTS], ensure_ascii=False))
    assert load_pairs(spark, str(lst)) == V.SIGN_LIST_REPLACEMENTS
    df = rules_frame(spark, V.READING_FIXES, "reading_fixes")
    assert [r.old for r in df.orderBy("rule_no").collect()] == [a for a, _ in V.READING_FIXES]


def test_fixed_table_sizes():
    assert len(V.SIGN_LIST_REPLACEMENTS) == 87 and len(V.READING_FIXES) == 33
    assert len(V.GLYPH_NAME_REPLACEMENTS) == 6 and len(V.GENRE_NORMALIZATION) == 12
    assert len(V.xon_pairs()) == 96
