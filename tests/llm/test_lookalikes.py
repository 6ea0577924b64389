import pytest

from reelspan.llm import lookalikes as la

SCHEMA = "source_table string, record_key string, text string, tidy string"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("é", "é"),
        ("Đo⁠àn tro‍ng", "Đoàn trong"),
        ("a b　c d", "a b c d"),
        ("ＡＢ１．", "AB1."),
        ("ﬁlm Ⅳ", "film IV"),
        ("120 m²  ok", "120 m²  ok"),
        ("\U0001f469‍\U0001f33e OK", "\U0001f469‍\U0001f33e OK"),
        ("I͏I", "II"),
        ("‍Theo", "Theo"),
        ("a\tb\nc", "a\tb\nc"),
        ("38°C", "38°C"),
        ("", ""),
        ("x­y", "xy"),
    ],
)
def test_characters(text, want):
    assert la.tidy(text) == want
    assert la.tidy(want) == want


def fixed(spark, texts):
    df = spark.createDataFrame([("ocr", str(i), t, "clash") for i, t in enumerate(texts)], SCHEMA)
    res = la.consistent_texts(df)
    changed = {r["record_key"] for r in la.changed_records(res).collect()}
    return {r["record_key"]: r["consistent"] for r in res.collect()}, changed


def test_mixed_tokens_need_the_vocabulary(spark):
    texts = ["nhà phở TRẠM", "nһà", "TНUYỀN", "ТRẠM", "Кафе", "Кафe", "Δv", None, "", "ɡa", "ga"]
    got, changed = fixed(spark, texts)
    assert got["1"] == "nhà" and got["3"] == "TRẠM" and got["9"] == "ga"
    assert got["2"] == "TНUYỀN", "no such word in the corpus"
    assert got["4"] == "Кафе" and got["5"] == "Кафе"
    assert got["6"] == "Δv" and got["7"] is None and got["8"] == ""
    assert changed == {"1", "3", "5", "9"}


def test_accents_on_foreign_bases_and_long_text(spark):
    texts = ["quảng", "quа̉ng", "quảng nһà " * 5000, "nhà", "quảng"]
    got, changed = fixed(spark, texts)
    assert got["1"] == "quảng" and got["2"] == "quảng nhà " * 5000 and changed == {"1", "2"}


def test_empty_table(spark):
    assert la.consistent_texts(spark.createDataFrame([], SCHEMA)).count() == 0
