import random

import pytest

from reelspan.llm import language as lg

PHRASES = {
    "vi": ["chiếc xe đạp cũ", "những người câu cá", "trên sân khấu lớn", "bầu trời nhiều mây", "đang sửa lại mái nhà", "trước cổng trường", "không ai bị thương"],
    "en": ["the old bicycle", "several fishermen", "on the large stage", "the sky is overcast", "is repairing the roof", "in front of the school", "nobody was hurt"],
    "de": ["das alte Fahrrad", "mehrere Fischer", "auf der großen Bühne", "der Himmel ist bedeckt", "repariert das Dach", "vor der Schule", "niemand wurde verletzt"],
    "fr": ["le vieux vélo", "plusieurs pêcheurs", "sur la grande scène", "le ciel est couvert", "répare le toit", "devant l'école", "personne n'est blessé"],
    "es": ["la bicicleta vieja", "varios pescadores", "en el escenario grande", "el cielo está nublado", "está reparando el techo", "frente a la escuela", "nadie ha resultado herido"],
    "pt": ["a bicicleta velha", "vários pescadores", "no palco grande", "o céu está nublado", "está consertando o telhado", "em frente à escola", "ninguém ficou ferido"],
    "id": ["sepeda yang tua", "beberapa nelayan", "di atas panggung besar", "langit masih mendung", "sedang memperbaiki atap", "di depan sekolah", "tidak ada yang terluka"],
}


def sentence(rng, lang):
    return " ".join(rng.sample(PHRASES[lang], 3)).capitalize() + "."


def corpus(n=60, seed=1):
    rng = random.Random(seed)
    rows = []
    for lang in PHRASES:
        for _ in range(n):
            label = lang if rng.random() > 0.05 else rng.choice(list(PHRASES))
            rows.append((len(rows), " ".join(sentence(rng, lang) for _ in range(3)), label, lang))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = [(label, " ".join(w)) for _, t, label, _ in corpus() for w in lg.sentences(t)]
    return lg.fit(rows)


def langs(model, text):
    return [(lg.LANGS[x[0]], x[3]) for x in lg.Labeller(model).label([lg.sentences(text)])[0]]


def test_held_out_accuracy(model):
    rng = random.Random(99)
    right = total = 0
    for lang in PHRASES:
        for k in range(40):
            s = sentence(rng, lang)
            s = [s, s.upper(), " ".join(lg.unaccented(w) for w in s.split())][k % 3]
            right += langs(model, s)[0][0] == lang
            total += 1
    assert right / total >= 0.97


def test_markup_quotes_and_short_texts(model):
    assert lg.sentences('{"scene": "on the stage", "objects": ["a b c d e"]}') == []
    assert lg.sentences("```json\n{\"a\": 1}\n``` https://x.example/a #tag 12:30") == []
    assert lg.sentences("*** 697.798") == [] and lg.sentences("") == []
    assert len(lg.sentences('On voit le vieux vélo ("in front of the school").')) == 1


def test_switch_inside_a_line_without_marks(model):
    text = " ".join(PHRASES["en"]) + " " + " ".join(PHRASES["vi"])
    found = langs(model, text)
    assert [x for x, _ in found] == ["en", "vi"]
    assert abs(found[0][1] - len(" ".join(PHRASES["en"]).split())) <= 2


def test_labels():
    assert [lg.bare_label(x) for x in ("VI", "vi-VN", "pt_BR", "", None, "und", "unknown", "n/a", " en ")] == ["vi", "vi", "pt", None, None, None, None, None, "en"]


def test_found_rows(spark):
    rng = random.Random(5)
    rows = [(i, t, label, "x") for i, t, label, _ in corpus()]
    true = {i: lang for i, _, _, lang in corpus()}
    mixed = [(1000, sentence(rng, "vi") + " " + sentence(rng, "de"), "vi", "x"), (1001, sentence(rng, "fr"), None, "x"), (1002, "12:30", None, "x"), (1003, None, "en", "x"), (1004, sentence(rng, "pt"), "und", "x"), (1005, sentence(rng, "en"), "en-GB", "x")]
    df = spark.createDataFrame(rows + mixed, "doc_id long, text string, lang string, confidence string")
    got = {(r["doc_id"], r["lang"]) for r in lg.wrong_or_mixed(lg.document_languages(lg.segments(df))).collect()}
    assert {(d, x) for d, x in got if d >= 1000} == {(1000, "vi"), (1000, "de"), (1001, "fr"), (1004, "pt")}
    want = {(i, true[i]) for i, _, label, _ in rows if label != true[i]}
    assert {(d, x) for d, x in got if d < 1000} == want


def test_very_long_text_in_pieces(spark, model):
    rng = random.Random(6)
    body = " ".join(sentence(rng, "fr") for _ in range(6000)) + " " + " ".join(PHRASES["de"] * 700).replace(".", "")
    df = spark.createDataFrame([(1, body, "fr"), (2, sentence(rng, "es"), "es")], "doc_id long, text string, lang string")
    rows = lg.segments(df, model).orderBy("doc_id", "segment").collect()
    mine = [r for r in rows if r["doc_id"] == 1]
    assert [r["segment"] for r in mine] == list(range(len(mine))) and len(mine) > 6000
    assert [r["sentence"] for r in mine] == sorted(r["sentence"] for r in mine)
    assert {r["lang"] for r in mine} == {"fr", "de"} and [r["lang"] for r in rows if r["doc_id"] == 2] == ["es"]


def test_no_labels_and_empty(spark):
    schema = "doc_id long, text string, lang string"
    assert lg.segments(spark.createDataFrame([(1, "a b c d e", None)], schema)).count() == 0
    assert lg.segments(spark.createDataFrame([], schema)).count() == 0


def test_every_document_gets_a_row(spark, model):
    rows = [(1, "Xin chào bạn", "vi"), (2, "12:30", "en"), (3, None, "en"), (4, "привет как дела сегодня друг мой", None), (5, '{"scene": "on the large stage", "x": 1}', "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    segs = lg.segments(df, model)
    got = {r["doc_id"]: (r["lang"], r["words"], r["full"]) for r in segs.collect()}
    assert got == {1: ("vi", 3, False), 2: (None, 0, False), 3: (None, 0, False), 4: (None, 6, True), 5: ("en", 6, False)}
    docs = {r["doc_id"]: (r["lang"], r["confidence"]) for r in lg.document_languages(segs).collect()}
    assert set(docs) == set(got) and docs[2] == (None, 0.0) and docs[1][0] == "vi"
    assert lg.wrong_or_mixed(lg.document_languages(segs)).count() == 0


def test_no_word_is_lost_in_a_long_stretch():
    for n in (4, 5, 2000, 2001, 2003, 2004, 4001):
        got = lg.sentences("a " * n)
        assert sum(map(len, got)) == n and min(map(len, got)) >= lg.MIN_WORDS


def test_confidence_is_about_right():
    import numpy as np

    rows = [(label, " ".join(w)) for _, t, label, _ in corpus(200, seed=3) for w in lg.sentences(t)]
    model = lg.fit(rows)
    rng = random.Random(8)
    labeller, sure = lg.Labeller(model), []
    for lang in PHRASES:
        for _ in range(150):
            words = rng.sample(sentence(rng, lang).lower().strip(".").split(), 2)  # short and hard
            (x, m, _, _), = labeller.label([[words]])[0]
            sure.append((float(model.confidence(np.array([m]))[0]), lg.LANGS[x] == lang))
    mean, right = np.mean([c for c, _ in sure]), np.mean([r for _, r in sure])
    assert abs(mean - right) < 0.2


def test_words_are_scored_alike_in_any_batch(model):
    rng = random.Random(4)
    docs = [[sentence(rng, lang).lower().strip(".").split()] for lang in PHRASES for _ in range(5)]
    one = lg.Labeller(model)
    small = lg.Labeller(model, most_words=10)
    alone = [lg.Labeller(model).label([d])[0] for d in docs]
    for many in (one.label(docs), [small.label([d])[0] for d in docs]):
        for a, b in zip(many, alone):
            assert [(x[0], x[2], x[3]) for x in a] == [(x[0], x[2], x[3]) for x in b]
