"""Language of documents and of their segments, by hierarchical discrimination.

The family of a segment is decided first, by one linear support vector machine per
family; then one-versus-one machines separate the languages within that family. All are
linear in the counts of hashed character n-grams of words, so a word has one row of scores,
which is computed once and kept, and the score of any stretch is a sum over its words.
Sentences are cut at line ends and sentence marks; in long stretches (speech-recogniser
style) windows of words are scored, and where they disagree the switch points are found by
dynamic programming over words.

The machines are fitted here, on at most ``sentences_per_label`` sentences a label from
the labelled documents (``per_document`` of each, their first ``words_per_sentence`` words),
picked by hash over whole texts; each sentence is used with and without its accents. The
first fit leaves out a fifth: sentences it contradicts are dropped for the second, as some
labels are wrong, and on the fifth the confidence is calibrated (logistic in the margin, label
errors allowed for). Everything else covers all documents and moves no rows.

Defined cases: every document gives at least one segment. A text without a full sentence is
one segment of all its words with ``full`` false; a null text, one without words, or a segment
mostly in letters of another script has no language (null) and confidence 0. Markup tails
(JSON, code fences, addresses, tags, time stamps) and short quotations are no sentences; labels
compare without case and region; labels that are null or no language code are missing;
repeated documents give repeated rows before ``distinct``; without any labelled sentence
nothing is returned; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Language families of the corpus.
FAMILIES = {"vietic": ("vi",), "malayic": ("id",), "germanic": ("en", "de"), "romance": ("fr", "es", "pt")}
LANGS = tuple(x for group in FAMILIES.values() for x in group)
DIM = 1 << 13
SIZES = (1, 2, 3, 4, 5)
MIN_WORDS = 4
#: A stretch without sentence marks is cut after this many words, so that memory stays bounded.
MAX_WORDS = 2000
#: Words of a window and of the step between windows in stretches without sentence marks.
WINDOW, HOP = 8, 4
#: Margin from which a window that disagrees with its sentence makes the sentence be searched for switches.
SURE_WINDOW = 0.68
BATCH_CHARS = 150_000

_MARKUP = regex.compile(r"```.*?(?:```|\Z)|\{[^{}]*\}|\[[^\[\]\n]{0,40}\]|https?://\S+|www\.\S+|[#@][\p{L}\p{N}_]+|[<][^<>\n]{0,80}[>]", regex.S)
_QUOTE = regex.compile(r"\(\s*[\"“][^\"”\n]{0,80}[\"”]\s*\)|[\"“][^\"“”\n]{0,60}[\"”]")
_PIECE = regex.compile(r"[\p{L}\p{M}]+|[\n\r]|[.!?…。](?=\s)")
_PLAIN = str.maketrans({"đ": "d", "ß": "s"})


def bare_label(label: str | None) -> str | None:
    """The language a label names, or None where it names none; case and region are ignored."""
    if label is None:
        return None
    code = regex.split(r"[-_]", label.strip().lower())[0]
    return code if regex.fullmatch(r"[a-z]{2}", code) else None


def _runs(text: str) -> list[list[str]]:
    """The words of a text in lower case, one list per stretch between line ends and sentence marks."""
    out: list[list[str]] = [[]]
    for piece in _PIECE.findall(unicodedata.normalize("NFC", text).lower()):
        if piece[0] in "\n\r.!?…。":
            if out[-1]:
                out.append([])
        else:
            out[-1].append(piece)
    return out


def sentences(text: str) -> list[list[str]]:
    """The sentences of a text as lists of lower-case words; long ones in pieces, the last of which takes a short rest."""
    out = []
    for words in _runs(_QUOTE.sub(" ", _MARKUP.sub("\n", text))):
        if len(words) >= MIN_WORDS:
            cuts = [*range(0, max(1, len(words) - MIN_WORDS + 1), MAX_WORDS), len(words)]
            out += [words[a:b] for a, b in zip(cuts, cuts[1:])]
    return out


def all_words(text: str) -> list[str]:
    """All words of a text that has no sentence: outside markup and quotations, else anywhere."""
    for kept in (_QUOTE.sub(" ", _MARKUP.sub("\n", text)), text):
        words = [w for run in _runs(kept) for w in run]
        if words:
            return words
    return []


def unaccented(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word) if unicodedata.category(c) != "Mn").translate(_PLAIN)


def _buckets(codes: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = np.full(len(codes) - n + 1, n * 0x9E3779B1, np.uint64)
        for j in range(n):
            h = (h ^ codes[j : len(codes) - n + 1 + j]) * np.uint64(0x100000001B3)
            h ^= h >> np.uint64(23)
    return (h >> np.uint64(7)).astype(np.int64) & (DIM - 1)


def _latin(word: str) -> bool:
    return word.isascii() or all(ord(c) < 0x250 or 0x300 <= ord(c) < 0x370 or 0x1E00 <= ord(c) < 0x1F00 for c in word)


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, number of the word) of all n-grams of words, each between blanks."""
    joined = "\0".join(f" {w} " for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    of = np.cumsum(codes == 0)
    buckets, owners = [], []
    for n in SIZES:
        if len(codes) < n:
            continue
        whole = np.flatnonzero((of[n - 1 :] == of[: len(codes) - n + 1]) & (codes[: len(codes) - n + 1] != 0))
        buckets.append(_buckets(codes, n)[whole])
        owners.append(of[whole])
    return np.concatenate(buckets), np.concatenate(owners)


@dataclass
class Model:
    """Columns of ``weights``: the families, then the pairs of languages within families.

    ``scale`` and ``shift`` turn the margin of a stretch into a confidence.
    """

    weights: np.ndarray
    families: list[str]
    pairs: list[tuple[str, str]] = field(default_factory=list)
    known: set[str] = field(default_factory=set)
    scale: float = 0.6
    shift: float = 0.0

    def confidence(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * margin + self.shift, -30, 30)))

    def word_scores(self, words: list[str]) -> np.ndarray:
        """One row per word: its scores, then its characters with the blank, then 1 for letters of another script."""
        out = np.zeros((len(words), self.weights.shape[1] + 2), np.float32)
        use = [i for i, w in enumerate(words) if _latin(w)]
        if use:
            bucket, owner = word_grams([words[i] for i in use])
            order = np.argsort(owner, kind="stable")
            first = np.searchsorted(owner[order], np.arange(len(use)))
            out[use, :-2] = np.add.reduceat(self.weights[bucket[order]], first, axis=0)
        out[:, -2] = [len(w) + 1 for w in words]
        out[:, -1] = 1
        out[use, -1] = 0
        return out

    def decide(self, scores: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index into LANGS and margin of stretches with these score sums."""
        f = scores[:, : len(self.families)]
        top = f.argmax(1)
        ranked = np.sort(f, axis=1)
        margin = ranked[:, -1] - (ranked[:, -2] if f.shape[1] > 1 else 0)
        lang = np.zeros(len(scores), np.int64)
        for i, name in enumerate(self.families):
            here = np.flatnonzero(top == i)
            group = [x for x in FAMILIES[name] if x in self.known]
            if not len(here) or not group:
                continue
            votes, sums = np.zeros((len(here), len(group))), np.zeros((len(here), len(group)))
            closest = np.full((len(here), len(group)), np.inf)
            for j, (a, b) in enumerate(self.pairs):
                if a in group and b in group:
                    s = scores[here, len(self.families) + j]
                    x, y = group.index(a), group.index(b)
                    votes[:, x] += s > 0
                    votes[:, y] += s <= 0
                    sums[:, x] += s
                    sums[:, y] -= s
                    closest[:, x] = np.minimum(closest[:, x], s)
                    closest[:, y] = np.minimum(closest[:, y], -s)
            best = (votes * 1e6 + np.clip(sums, -1e5, 1e5)).argmax(1)
            lang[here] = np.array([LANGS.index(x) for x in group])[best]
            margin[here] = np.minimum(margin[here], 2 * np.maximum(closest[np.arange(len(here)), best], 0))
        return lang, margin / np.sqrt(np.maximum(chars, 1))

    def language_columns(self) -> np.ndarray:
        """Weights that turn the score columns into one score per language, for switch points."""
        m = np.full((len(self.families) + len(self.pairs), len(LANGS)), 0.0)
        for k, lang in enumerate(LANGS):
            for i, name in enumerate(self.families):
                if lang in FAMILIES[name]:
                    m[i, k] = 1.0
            for j, (a, b) in enumerate(self.pairs):
                m[len(self.families) + j, k] = 0.7 if lang == a else -0.7 if lang == b else 0.0
        return m


def _svm(x: np.ndarray, y: np.ndarray, steps: int = 80, strength: float = 30.0) -> np.ndarray:
    """Linear SVMs (squared hinge, no bias) for all columns of y in {-1, 0, 1}; 0 is left out."""
    use = (y != 0).astype(np.float32)
    share = use / np.maximum(np.where(y > 0, (y > 0).sum(0), (y < 0).sum(0)), 1)  # both sides weigh the same
    c = (strength * share * use.sum(0) / 2).astype(np.float32)
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    v = np.random.default_rng(1).normal(size=(x.shape[1], 1)).astype(np.float32)
    for _ in range(12):
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v)
    top = float(np.linalg.norm(x @ v)) ** 2
    rate = 1.0 / (1.0 + 2 * top * c.max(0))
    z, t = w.copy(), 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ z))
        grad = z - 2 * (x.T @ (c * y * slack))
        new = z - rate * grad
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = new + ((t - 1) / t2) * (new - w)
        w, t = new, t2
    return w


def _calibrated(margin: np.ndarray, right: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the logistic that best explains on which held-out sentences label and machine agree.

    Where the margin is widest the machine is taken to be right, so what disagrees there
    measures the share of wrong labels.
    """
    wide = margin >= np.quantile(margin, 0.7)
    wrong = min(0.4, max(1e-3, 1 - float(right[wide].mean())))
    best = (-np.inf, 0.6, 0.0)
    for scale in np.geomspace(0.05, 5, 24):
        for shift in np.linspace(-3, 3, 25):
            p = 1 / (1 + np.exp(-np.clip(scale * margin + shift, -30, 30)))
            agree = (1 - wrong) * p + wrong / len(LANGS) * (1 - p)
            fit_of = float(np.log(np.where(right, agree, 1 - agree)).sum())
            best = max(best, (fit_of, float(scale), float(shift)))
    return best[1], best[2]


def fit(rows: list[tuple[str, str]]) -> Model | None:
    """A model from (label, sentence) rows."""
    rows = [(label, s) for label, s in rows if label in LANGS]
    if not rows:
        return None
    bare = [" ".join(unaccented(w) for w in s.split(" ")) for _, s in rows]
    texts = [s for _, s in rows] + bare
    words = sorted({w for t in texts for w in t.split(" ")})
    bucket, owner = word_grams(words)
    order = np.argsort(owner, kind="stable")
    grams = dict(zip(words, np.split(bucket[order], np.searchsorted(owner[order], np.arange(1, len(words))))))
    x = np.zeros((len(texts), DIM), np.float32)
    for i, t in enumerate(texts):
        x[i] = np.bincount(np.concatenate([grams[w] for w in t.split(" ")]), minlength=DIM)
    chars = np.array([len(t) + 1 for t in texts])
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x /= norm

    def machines(use: np.ndarray) -> Model:
        labels = [rows[i][0] for i in use]
        known = set(labels)
        families = [f for f, g in FAMILIES.items() if known & set(g)]
        pairs = [(a, b) for g in FAMILIES.values() for i, a in enumerate(g) for b in g[i + 1 :] if a in known and b in known]
        y = np.zeros((len(use), len(families) + len(pairs)), np.float32)
        for i, label in enumerate(labels):
            for j, f in enumerate(families):
                y[i, j] = 1 if label in FAMILIES[f] else -1
            for j, (a, b) in enumerate(pairs):
                y[i, len(families) + j] = 1 if label == a else -1 if label == b else 0
        return Model(_svm(x[np.concatenate([use, use + len(rows)])], np.concatenate([y, y])), families, pairs, known)

    label = np.array([LANGS.index(name) for name, _ in rows])
    held = np.arange(len(rows)) % 5 == 4
    first = machines(np.flatnonzero(~held) if len({name for (name, _), h in zip(rows, held) if not h}) == len({name for name, _ in rows}) else np.arange(len(rows)))
    got, margin = first.decide(x @ first.weights * norm, chars)
    kept = np.flatnonzero(got[: len(rows)] == label)
    model = machines(kept) if len(kept) else first
    both = np.concatenate([held, held])
    if both.sum() >= 40:
        model.scale, model.shift = _calibrated(margin[both], got[both] == np.concatenate([label, label])[both])
    return model


def train(documents: DataFrame, *, text: str = "text", label: str = "lang", doc_id: str = "doc_id", sentences_per_label: int = 350, per_document: int = 4, words_per_sentence: int = 40) -> Model | None:
    """Fit on at most ``sentences_per_label`` sentences a label, picked by hash."""
    src = documents.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"), F.split(F.lower(F.trim(label)), "[-_]")[0].alias("l")).where(F.col("l").isin(*LANGS))
    counts = {r["l"]: r["count"] for r in src.groupBy("l").count().collect()}
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("l") == name, F.lit(min(1.0, 1.5 * sentences_per_label / n))).otherwise(share)
    picked = src.where(F.pmod(F.xxhash64("d", F.lit(11)), F.lit(1 << 20)) < share * (1 << 20))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, l, s = [], [], []
            for i, t, name in zip(b.column("d").to_pylist(), b.column("t").to_pylist(), b.column("l").to_pylist()):
                found = sentences(t)
                step = max(1, len(found) // per_document)
                for k in range(0, len(found), step):
                    words = found[k]
                    if len(words) >= 5:
                        d.append((i * 1_000_003 + k * 7_919) & 0x7FFFFFFF)
                        l.append(name)
                        s.append(" ".join(words[:words_per_sentence]))
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(l, pa.string()), pa.array(s, pa.string())], names=["k", "l", "s"])

    made = picked.mapInArrow(cut, "k long, l string, s string")
    rows, seen = [], Counter()
    for r in made.orderBy(F.xxhash64("k", "s"), "s").limit(len(LANGS) * sentences_per_label * 4).collect():
        if seen[r["l"]] < sentences_per_label:
            seen[r["l"]] += 1
            rows.append((r["l"], r["s"]))
    return fit(rows)


def _switches(model: Model, columns: np.ndarray, scores: np.ndarray) -> list[tuple[int, int]]:
    """Word ranges of one language each, by dynamic programming with a cost per switch; short ranges join the one before."""
    known = np.array([x in model.known for x in LANGS])
    emit = scores.astype(float) @ columns
    emit[:, ~known] = -1e9
    spread = np.abs(emit[:, known]).mean() + 1e-9
    cost = 6.0 * spread
    score, back = emit[0].copy(), []
    for e in emit[1:]:
        best = int(score.argmax())
        switch = score[best] - cost > score
        back.append(np.where(switch, best, np.arange(len(score))))
        score = np.where(switch, score[best] - cost, score) + e
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    path.reverse()
    cuts = [0]
    for i in range(1, len(path)):
        if path[i] != path[i - 1] and i - cuts[-1] >= MIN_WORDS and len(path) - i >= MIN_WORDS:
            cuts.append(i)
    return list(zip(cuts, [*cuts[1:], len(path)]))


class Labeller:
    """A model with the scores of the words met so far (at most ``most_words``, then begun anew)."""

    def __init__(self, model: Model, most_words: int = 300_000):
        self.model, self.most_words = model, most_words
        self.columns = model.language_columns()
        self._number: dict[str, int] = {}
        self._scores = np.zeros((0, model.weights.shape[1] + 2), np.float32)

    def _of_words(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self._number]
        if len(self._number) + len(new) > self.most_words and self._number:
            self._number, self._scores = {}, self._scores[:0]
            new = list(dict.fromkeys(words))
        if new:
            self._number.update(zip(new, range(len(self._number), len(self._number) + len(new))))
            self._scores = np.concatenate([self._scores, self.model.word_scores(new)])
        return self._scores[np.fromiter(map(self._number.__getitem__, words), np.int64, len(words))]

    def _judge(self, sums: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lang, margin = self.model.decide(sums[:, :-2], sums[:, -2])
        return np.where(2 * sums[:, -1] > words, -1, lang), margin

    def label(self, docs: list[list[list[str]]]) -> list[list[tuple[int, float, int, int]]]:
        """Per document its segments: (index into LANGS or -1, margin, first sentence, words)."""
        out: list[list[tuple[int, float, int, int]]] = [[] for _ in docs]
        runs = [w for d in docs for w in d]
        if not runs:
            return out
        size = np.array([len(w) for w in runs])
        begin = np.concatenate([[0], np.cumsum(size)])
        scores = self._of_words([w for run in runs for w in run])
        sums = np.concatenate([np.zeros((1, scores.shape[1])), np.cumsum(scores, axis=0, dtype=np.float64)])
        lang, margin = self._judge(sums[begin[1:]] - sums[begin[:-1]], size)
        long = np.flatnonzero(size >= WINDOW + HOP)
        windows = -(-(size[long] - WINDOW) // HOP) + 1
        of = np.repeat(long, windows)
        number = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = begin[of] + np.minimum(number * HOP, size[of] - WINDOW)
        got, sure = self._judge(sums[at + WINDOW] - sums[at], np.full(len(at), WINDOW))
        mixed = set(of[(got != lang[of]) & (sure > SURE_WINDOW)].tolist())
        owner = [(i, k) for i, d in enumerate(docs) for k in range(len(d))]
        for i, ((doc, sent), x, m, n) in enumerate(zip(owner, lang.tolist(), margin.tolist(), size.tolist())):
            if i not in mixed:
                out[doc].append((x, m, sent, n))
                continue
            for lo, hi in _switches(self.model, self.columns, scores[begin[i] : begin[i + 1], :-2]):
                y, c = self._judge((sums[begin[i] + hi] - sums[begin[i] + lo])[None], np.array([hi - lo]))
                out[doc].append((int(y[0]), float(c[0]), sent, hi - lo))
        return out


def segments(documents: DataFrame, model: Model | None = None, *, text: str = "text", label: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, label, segment, sentence, lang, confidence, margin, words, full): every segment's language."""
    spark = documents.sparkSession
    schema = "doc_id long, label string, segment int, sentence int, lang string, confidence double, margin double, words int, full boolean"
    model = model or train(documents, text=text, label=label, doc_id=doc_id)
    if model is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(model)
    src = documents.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"), F.col(label).alias("l"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        labeller = Labeller(m)
        before = 0  # segments so far of a document that goes on
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.bool_())
        names = ["doc_id", "label", "segment", "sentence", "lang", "confidence", "margin", "words", "full"]

        def flush(held: list[tuple[int, str | None, list[list[str]], int, bool]]) -> pa.RecordBatch:
            nonlocal before
            cols: list[list] = [[] for _ in range(8)]
            for (d, l, _, first, full), segs in zip(held, labeller.label([x[2] for x in held])):
                before = before if first else 0
                for lang, margin, sent, words in segs or [(-1, 0.0, 0, 0)]:
                    for col, v in zip(cols, (d, l, before, first + sent, LANGS[lang] if lang >= 0 else None, margin if lang >= 0 else 0.0, words, full)):
                        col.append(v)
                    before += 1
            sure = np.where([x is not None for x in cols[4]], m.confidence(np.array(cols[5], float)), 0.0)
            cols.insert(5, sure.tolist())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        held, chars = [], 0
        for b in batches:
            for d, t, l in zip(b.column("d").to_pylist(), b.column("t").to_pylist(), b.column("l").to_pylist()):
                found, first = sentences(t or ""), 0
                full = bool(found)
                if not full:
                    words = all_words(t or "")
                    found = [words] if words else []
                while first < len(found) or not first:  # a very long document goes in pieces
                    last, size = first, 0
                    while last < len(found) and size < BATCH_CHARS:
                        size += sum(map(len, found[last])) + len(found[last])
                        last += 1
                    held.append((d, l, found[first:last], first, full))
                    chars += size + 1
                    first = max(last, 1)
                    if chars >= BATCH_CHARS:
                        yield flush(held)
                        held, chars = [], 0
        if held:
            yield flush(held)

    return src.mapInArrow(find, schema)


def document_languages(segs: DataFrame, *, sure_margin: float = 2.9, min_words: int = 5, long_margin: float = 0.68, long_words: int = 12) -> DataFrame:
    """(doc_id, label, lang, words, confidence, full): languages of the sure segments of each document.

    The language of most words counts from its best segment on; any further language needs
    a segment of ``min_words`` words and ``sure_margin``, or one of ``long_words`` words
    and ``long_margin``. A document without any language has one row with null.
    """
    per = segs.groupBy("doc_id", "label", "lang").agg(
        F.sum("words").alias("words"),
        F.max("confidence").alias("confidence"),
        F.max("full").alias("full"),
        F.max(F.when(F.col("lang").isNotNull() & (((F.col("margin") >= sure_margin) & (F.col("words") >= min_words)) | ((F.col("margin") >= long_margin) & (F.col("words") >= long_words))), 1).otherwise(0)).alias("sure"),
    )
    per_doc = per.groupBy("doc_id", "label").agg(F.collect_list(F.struct(F.col("lang").isNotNull().alias("has"), "words", "lang", "confidence", "full", "sure")).alias("all"))
    ranked = per_doc.withColumn("all", F.reverse(F.array_sort("all"))).select("doc_id", "label", F.posexplode("all").alias("rank", "x"))
    return ranked.where((F.col("rank") == 0) | (F.col("x.sure") == 1)).select("doc_id", "label", "x.lang", "x.words", "x.confidence", "x.full")


def wrong_or_mixed(langs: DataFrame) -> DataFrame:
    """(doc_id, lang): the true language of documents with full sentences where the label is missing or wrong, and all languages of mixed documents."""
    bare = F.regexp_extract(F.lower(F.trim("label")), r"^([a-z]{2})(?:[-_].*)?$", 1)
    per = langs.where(F.col("full") & F.col("lang").isNotNull()).groupBy("doc_id", "label").agg(F.collect_set("lang").alias("langs"))
    odd = per.where((F.size("langs") > 1) | F.col("label").isNull() | (bare != F.col("langs")[0]))
    return odd.select("doc_id", F.explode("langs").alias("lang")).distinct()
