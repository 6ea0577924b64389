import random

from reelspan.llm import contamination as ct

WORDS = [a + b for a in ("ba", "do", "ki", "lu", "me", "na", "po", "ra", "si", "tu") for b in ("lan", "mor", "net", "pik", "sol", "tar", "vem", "zu")]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def leaks(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id long")
    i = spark.createDataFrame(items, "item_id long, text string, doc_id long")
    return {(r["doc_id"], r["item_id"]): (r["edits"], r["whole_run"]) for r in ct.leaks(d, i, **kw).collect()}


def test_fold():
    assert ct.fold("Đường PHỐ, số-9 straße_x") == ["duong", "pho", "so", "9", "strasse", "x"]


def test_against_shared_runs(spark):
    rng = random.Random(7)
    items = [(i, text(rng, 24), 0) for i in range(30)]
    items.append((30, items[0][1], 0))
    docs, want = [], set()
    for d in range(120):
        body = text(rng, rng.randrange(0, 60))
        if rng.random() < 0.6:
            i = rng.randrange(30)
            words = items[i][1].split()
            n = rng.choice([5, 7, 8, 9, 24])
            at = rng.randrange(0, len(words) - n + 1)
            part = " ".join(words[at : at + n])
            body = f"{body}. {part.upper()}!\n{text(rng, 10)}"
        docs.append((d, body, 0))
    for d, body, _ in docs:
        w = ct.fold(body)
        runs = {tuple(w[j : j + 8]) for j in range(len(w) - 7)}
        for i, t, _ in items:
            v = t.split()
            if runs & {tuple(v[j : j + 8]) for j in range(len(v) - 7)}:
                want.add((d, i))
    got = leaks(spark, docs, items)
    assert {k for k, (_, whole) in got.items() if whole} == want
    assert len(want) > 20
    assert {k for k, (_, whole) in leaks(spark, docs, items, shard_chars=900).items() if whole} == want


def test_edited_passage_is_found_but_not_whole(spark):
    rng = random.Random(9)
    item = text(rng, 12)
    words = item.split()
    bent = " ".join(words[:6] + [words[6][:-1] + "x"] + words[7:])
    got = leaks(spark, [(1, "zz " + bent + " zz", 0), (2, text(rng, 30), 0)], [(1, item, 0)])
    assert set(got) == {(1, 1)} and got[(1, 1)] == (1, False)


def test_nulls_empty_long_and_repeats(spark):
    rng = random.Random(3)
    item = text(rng, 10)
    long = text(rng, 40_000) + " " + item
    docs = [(1, None, 0), (2, "", 0), (3, "?!", 0), (4, long, 0), (4, long, 0), (None, item, 0)]
    items = [(1, item, 0), (2, None, 0), (3, "", 0), (None, item, 0)]
    assert leaks(spark, docs, items) == {(4, 1): (0, True)}
    assert leaks(spark, docs, []) == {}
    assert leaks(spark, [], items) == {}


def test_banded_distance_against_full_table():
    import numpy as np

    rng = random.Random(1)
    index = ct.ItemIndex([(0, "balan domor kinet lupik mesol natar povem razu")], min_words=8, edit_rate=0.1, q=6)
    passage = "balan domor kinet lupik mesol natar povem razu"
    for _ in range(40):
        s = list(passage)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(s))
            s[at] = rng.choice(["", "x", s[at] + "y"])
        s = "".join(s)
        full = [0] * (len(s) + 1)
        for i, c in enumerate(passage, 1):
            new = [i]
            for j, e in enumerate(s, 1):
                new.append(min(full[j - 1] + (c != e), full[j] + 1, new[j - 1] + 1))
            full = new
        got = ct._banded_distance(index, ct._codes(s), np.array([0]), np.array([0]), 7)
        assert got[0] == min(full) if min(full) <= index.w_edits[0] else got[0] > index.w_edits[0]


def test_very_long_document_counts_every_passage_once(monkeypatch):
    rng = random.Random(5)
    item = text(rng, 20)
    words = item.split()
    doc = words[:10] + text(rng, 300).split() + words[6:20] + text(rng, 50).split()
    index = ct.ItemIndex([(1, item)], min_words=8, edit_rate=0.04, q=8)
    whole = ct.scan(index, [doc])
    monkeypatch.setattr(ct, "BATCH_CHARS", 400)
    assert ct.scan_long(index, doc) == whole
    assert len(whole[0, 0][0]) == 3 + 7


def test_short_items_are_passages(spark):
    docs = [(1, "zz Ab, cd yy", 0), (2, "zab cd yy", 0), (3, "x", 0), (4, "ab cd " * 20, 0)]
    items = [(1, "ab cd", 0), (2, "X", 0), (3, "yy", 0)]
    assert set(leaks(spark, docs, items)) == {(1, 1), (1, 3), (2, 3), (3, 2), (4, 1)}


def test_found_within_the_edit_budget_however_large():
    rng = random.Random(11)
    item = " ".join("".join(rng.choice("abcdefghij") for _ in range(15)) for _ in range(8))  # 127 characters: 5 edits
    for _ in range(60):
        s = list(item)
        for at in rng.sample(range(len(s)), 5):
            s[at] = "z" if rng.random() < 0.5 else s[at] + "z"
        index = ct.ItemIndex([(1, item)], min_words=8, edit_rate=0.04, q=8)
        doc = ct.fold(text(rng, rng.randrange(30)) + " " + "".join(s) + " " + text(rng, 20))
        assert (0, 0) in ct.scan(index, [doc])
    import pytest

    with pytest.raises(ValueError):
        ct.ItemIndex([(1, item)], min_words=8, edit_rate=0.2, q=8)
