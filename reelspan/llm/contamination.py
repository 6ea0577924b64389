"""Evaluation passages inside corpus documents, by q-gram lemma filtering.

A passage (a window of ``min_words`` words of an item, n characters) stands in a document
with at most e = floor(edit_rate * n) edits. Of every ``stride`` characters of the document one
q-gram is looked up in the index of item q-grams. The stretch that holds the passage begins
at least (n - e - q + 1) / stride of them, an edit spoils at most q / stride (rounded up), and
the rest lie on diagonals that differ by at most e. Hits are counted per (document,
item) in overlapping bands of diagonals, passages that reach this bound are kept and
verified by a banded alignment. Nothing is shuffled and no document is cut: a very long
one is scanned in overlapping pieces whose passages are united.

The items are the stated query set. They go to the executors in shards of at most
``shard_chars`` characters, so what is broadcast is bounded however many items there are.

Defined cases: null or empty texts and items give no row; text is compared as lower-case
words without accents joined by one blank; an item below ``min_words`` words is one
passage; passages too short for the bound (below ``q + stride - 1`` characters) are looked up as whole words;
repeated items each count; an edit rate that leaves no bound is refused; other columns are
ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = regex.compile(r"[\p{L}\p{N}]+")
_ASCII_WORD = re.compile(r"[a-z0-9A-Z]+")

class _Fold(dict):
    """What each character of lower-cased text becomes; filled as characters turn up."""

    def __missing__(self, cp: int) -> str:
        made = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if unicodedata.category(c) != "Mn").replace("đ", "d")
        self[cp] = made
        return made


_FOLD = _Fold()
#: Characters and documents scanned at once; bounds memory, results do not depend on it.
BATCH_CHARS = 200_000
MAX_DOCS = 1 << 15
Leaks = dict[tuple[int, int], tuple[set[int], int, bool]]


def fold(text: str) -> list[str]:
    """Words of a text: runs of letters and digits, lower case, without accents."""
    plain = text.lower() if text.isascii() else text.casefold().translate(_FOLD)
    return _ASCII_WORD.findall(plain) if plain.isascii() else _WORD.findall(plain)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


def _grams(codes: np.ndarray, q: int, stride: int = 1) -> np.ndarray:
    """A hash of the run of q characters at every ``stride``-th position."""
    base = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        out = codes[: len(codes) - q + 1 : stride].copy()
        for j in range(1, q):
            out = out * base + codes[j : len(codes) - q + 1 + j : stride]
        return out ^ (out >> np.uint64(29))


class ItemIndex:
    """The q-grams and passages of one shard of items."""

    def __init__(self, items: list[tuple[int, str]], *, min_words: int, edit_rate: float, q: int, stride: int = 4):
        self.q, self.stride, self.ids = q, stride, []
        self.short: dict[tuple[str, ...], list[tuple[int, int]]] = {}  # words -> (item, passage)
        texts, w_item, w_from, w_to, self.shingles = [], [], [], [], []
        for item_id, text in items:
            words = fold(text)
            if not words:
                continue
            joined = " ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            k = len(self.ids)
            self.ids.append(item_id)
            texts.append(joined)
            span = min(min_words, len(words))
            for i in range(len(words) - span + 1):
                w_item.append(k)
                w_from.append(starts[i])
                w_to.append(ends[i + span - 1])
            self.shingles.append({tuple(words[i : i + min_words]) for i in range(len(words) - min_words + 1)})
        self.texts = [_codes(t) for t in texts]
        self.most_words = max((t.count(" ") + 1 for t in texts), default=0)
        self.w_item, self.w_from, self.w_to = (np.asarray(a, np.int64) for a in (w_item, w_from, w_to))
        n = self.w_to - self.w_from
        self.w_edits = (n * edit_rate).astype(np.int64)
        self.w_need = (n - self.w_edits - q + 1) // stride - self.w_edits * -(-q // stride)
        if ((self.w_need < 1) & (self.w_edits > 0)).any():
            raise ValueError("the edit rate leaves no q-gram that a passage must share: lower edit_rate, q or stride")
        for x in np.flatnonzero(self.w_need < 1).tolist():
            words = texts[w_item[x]][w_from[x] : w_to[x]]
            self.short.setdefault(tuple(words.split(" ")), []).append((w_item[x], x))
        self.short_sizes = sorted({len(k) for k in self.short})
        #: bands start every ``step`` diagonals and span two steps, so that the hits of a passage fit in one
        self.step = max(4, int(self.w_edits.max(initial=0)))
        self.w_first = np.searchsorted(self.w_item, np.arange(len(self.ids) + 1))
        self.w_need = np.where(self.w_need < 1, 1 << 40, self.w_need)
        self.item_need = np.array([self.w_need[a:b].min() for a, b in zip(self.w_first, self.w_first[1:])], np.int64)
        # by position in an item: the last passage that begins there or before, the first whose last q-gram is there or later
        self.base = np.cumsum([0, *map(len, self.texts)])
        flat_from, flat_to = self.base[self.w_item] + self.w_from, self.base[self.w_item] + self.w_to - q
        spots = np.arange(self.base[-1])
        self.w_last = np.searchsorted(flat_from, spots, "right") - 1
        self.w_begin = np.maximum(np.searchsorted(flat_to, spots), np.repeat(self.w_first[:-1], np.diff(self.base)))
        self.longest = max((len(t) for t in self.texts), default=0)
        grams = [(_grams(t, q), i) for i, t in enumerate(self.texts) if len(t) >= q]
        h = np.concatenate([g for g, _ in grams]) if grams else np.zeros(0, np.uint64)
        item = np.concatenate([np.full(len(g), i) for g, i in grams]) if grams else np.zeros(0, np.int64)
        pos = np.concatenate([np.arange(len(g)) for g, _ in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.post_item, self.post_pos = item[order].astype(np.int64), pos[order].astype(np.int64)
        self.hashes, first = np.unique(h[order], return_index=True)
        self.first = np.append(first, len(h)).astype(np.int64)
        self.bits = 20
        self.filter = np.zeros(1 << self.bits, bool)
        self.filter[(self.hashes >> np.uint64(64 - self.bits)).astype(np.int64)] = True


def _banded_distance(index: ItemIndex, text: np.ndarray, w: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Edits to turn passage w into some stretch of the text near the diagonal ``at``.

    All pairs advance together, one passage character at a time, over diagonals
    at - width .. at + width; start and end in the text are free within the band. Pairs
    beyond the edit budget of their passage may come back as a large number.
    """
    n = index.w_to[w] - index.w_from[w]
    longest, cells = int(n.max()), 2 * width + 1
    big = 1 << 20
    chars = np.zeros((len(w), longest), np.uint64)
    for j, x in enumerate(w):
        chars[j, : n[j]] = index.texts[index.w_item[x]][index.w_from[x] : index.w_to[x]]
    base = at + index.w_from[w] - width
    col = np.arange(cells, dtype=np.int16)
    row = np.zeros((len(w), cells), np.int16)
    result = np.full(len(w), big, np.int64)
    padded = np.concatenate([np.zeros(longest + cells, text.dtype), text, np.zeros(longest + cells, text.dtype)])
    here = np.clip(base + longest + cells, 0, len(padded) - longest - cells)[:, None] + np.arange(cells)
    live = np.arange(len(w))
    for i in range(longest):
        if i % 8 == 7:  # a pair beyond its budget stays beyond it
            stay = row.min(1) <= index.w_edits[w[live]]
            live, row, here, chars = live[stay], row[stay], here[stay], chars[stay]
        if not len(live):
            break
        new = row + (padded[here + i] != chars[:, i : i + 1])
        np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])
        row = np.minimum.accumulate(new - col, axis=1) + col
        done = n[live] == i + 1
        if done.any():
            result[live[done]] = row[done].min(1)
            live, row, here, chars = live[~done], row[~done], here[~done], chars[~done]
    return result


def scan(index: ItemIndex, docs: list[list[str]]) -> Leaks:
    """(document number, item number) -> passages, least edits, whether min_words words in a row are equal."""
    found = _scan(index, docs)
    for d, words in enumerate(docs):
        for k in index.short_sizes:
            for j in range(len(words) - k + 1):
                for i, x in index.short.get(tuple(words[j : j + k]), ()):
                    passages, _, whole = found.get((d, i), (set(), 0, False))
                    found[d, i] = (passages | {x}, 0, whole)
    return found


def _scan(index: ItemIndex, docs: list[list[str]]) -> Leaks:
    q, gap = index.q, 1
    parts, starts, at = [], [], 0
    for words in docs:
        t = _codes(" ".join(words))
        starts.append(at)
        parts += [t, np.zeros(q + gap, np.uint64)]
        at += len(t) + q + gap
    text = np.concatenate(parts)
    if len(text) < q or not len(index.hashes):
        return {}
    looked = np.arange(0, len(text) - q + 1, index.stride)
    h = _grams(text, q, index.stride)
    cand = np.flatnonzero(index.filter[(h >> np.uint64(64 - index.bits)).astype(np.int64)])
    slot = np.minimum(np.searchsorted(index.hashes, h[cand]), len(index.hashes) - 1)
    ok = index.hashes[slot] == h[cand]
    cand, slot = looked[cand[ok]], slot[ok]
    if not len(cand):
        return {}
    count = index.first[slot + 1] - index.first[slot]
    doc_at = np.repeat(cand, count)
    into = np.arange(len(doc_at)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(index.first[slot], count)
    item, pos = index.post_item[into], index.post_pos[into]
    edges = np.asarray(starts)
    doc = np.searchsorted(edges, doc_at, "right") - 1
    diag = doc_at - edges[doc] - pos + index.longest
    step = index.step
    block = diag // step + 1
    d_bits, g_bits, p_bits = (int(x).bit_length() for x in (len(docs), block.max() + 1, index.longest))
    high = ((item << d_bits) | doc) << g_bits | block
    if len(index.ids).bit_length() + d_bits + g_bits + p_bits <= 63:
        packed = np.sort((high << p_bits) | pos)
        key, pos = packed >> p_bits, packed & ((1 << p_bits) - 1)
    else:
        order = np.lexsort((pos, high))
        key, pos = high[order], pos[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    blocks, size = key[new], np.diff(np.append(new, len(key)))
    nxt = np.append((blocks[1:] == blocks[:-1] + 1) * size[1:], 0)
    need = index.item_need[blocks >> (d_bits + g_bits)]
    band = np.flatnonzero(size + nxt >= need)
    if not len(band):
        return {}
    end = new + size
    end2 = np.where(nxt > 0, end + nxt, end)[band]
    length = end2 - new[band]
    hit = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length) + np.repeat(new[band], length)
    region = np.repeat(np.arange(len(band)), length)
    side = index.longest + 1
    place = np.sort(region * side + pos[hit])
    place = place[np.append(True, place[1:] != place[:-1])]  # one hit per passage character
    of = place // side
    last = np.arange(len(place)) + need[band][of] - 1
    near = np.minimum(last, len(place) - 1)
    r_item = blocks[band] >> (d_bits + g_bits)
    dense = np.flatnonzero((last == near) & (of[near] == of))  # these and the hits up to ``last`` are as many as the item needs
    in_item = index.base[r_item[of[dense]]] - of[dense] * side
    begin, end = index.w_begin[in_item + place[last[dense]]], index.w_last[in_item + place[dense]]
    some = np.maximum(end - begin + 1, 0)
    pairs = np.arange(int(some.sum())) - np.repeat(np.cumsum(some) - some, some) + np.repeat(of[dense] * len(index.w_item) + begin, some)
    pairs = np.unique(pairs)
    r, w = pairs // max(1, len(index.w_item)), pairs % max(1, len(index.w_item))
    inside = np.searchsorted(place, r * side + index.w_to[w] - q, "right") - np.searchsorted(place, r * side + index.w_from[w])
    keep = inside >= index.w_need[w]
    r, w = r[keep], w[keep]
    if not len(r):
        return {}
    mid = (blocks[band] & ((1 << g_bits) - 1)) * step - index.longest  # the middle diagonal of the band
    r_doc = (blocks[band] >> g_bits) & ((1 << d_bits) - 1)
    best: dict[tuple[int, int], tuple[set[int], int]] = {}
    for s in range(0, len(r), 4096):
        rr, ww = r[s : s + 4096], w[s : s + 4096]
        edits = _banded_distance(index, text, ww, edges[r_doc[rr]] + mid[rr], 2 * step)
        good = edits <= index.w_edits[ww]
        for d, i, e, x in zip(r_doc[rr][good].tolist(), r_item[rr][good].tolist(), edits[good].tolist(), ww[good].tolist()):
            passages, least = best.get((d, i), (set(), e))
            passages.add(x)
            best[d, i] = (passages, min(least, e))
    out: Leaks = {}
    for (d, i), (passages, e) in best.items():
        words, wanted = docs[d], index.shingles[i]
        n = len(next(iter(wanted))) if wanted else 0
        out[d, i] = (passages, e, bool(n) and any(tuple(words[j : j + n]) in wanted for j in range(len(words) - n + 1)))
    return out


def scan_long(index: ItemIndex, words: list[str]) -> Leaks:
    """As ``scan`` for one very long document, in pieces that overlap by more than any item."""
    overlap = 2 * index.most_words + 16
    best: Leaks = {}
    at = 0
    while at < len(words):
        end, chars = at, 0
        while end < len(words) and chars < BATCH_CHARS:
            chars += len(words[end]) + 1
            end += 1
        for key, (passages, e, whole) in scan(index, [words[max(0, at - overlap) : end]]).items():
            more, least, also = best.get(key, (set(), e, False))
            best[key] = (more | passages, min(least, e), also or whole)
        at = end
    return best


def leaks(documents: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", min_words: int = 8, edit_rate: float = 0.04, q: int = 8, stride: int = 4, shard_chars: int = 4_000_000) -> DataFrame:
    """(doc_id, item_id, passages, edits, whole_run): items leaked into documents.

    ``whole_run`` says whether at least min_words words in a row stand in both exactly.
    """
    spark = documents.sparkSession
    use = items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t"))
    size = use.agg(F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("c"), F.count("*").alias("n")).first()
    shards = max(1, -(-int(size["c"]) // shard_chars), -(-int(size["n"]) // 100_000))
    schema = "doc_id long, item_id long, passages int, edits int, whole_run boolean"
    src = documents.where(F.col(text).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"))
    out = []
    for shard in range(shards):
        part = use.where(F.pmod(F.xxhash64("i"), F.lit(shards)) == shard)
        index = spark.sparkContext.broadcast(ItemIndex([(r["i"], r["t"]) for r in part.collect()], min_words=min_words, edit_rate=edit_rate, q=q, stride=stride))

        def find(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            ix = index.value

            def flush(ids: list[int], docs: list[list[str]], scan=scan) -> pa.RecordBatch:  # type: ignore[no-untyped-def]
                rows = [(d, i, len(passages), e, whole) for (d, i), (passages, e, whole) in scan(ix, docs).items()]
                cols = list(zip(*rows)) if rows else [[], [], [], [], []]
                return pa.RecordBatch.from_arrays(
                    [pa.array([ids[d] for d in cols[0]], pa.int64()), pa.array([ix.ids[i] for i in cols[1]], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.bool_())],
                    names=["doc_id", "item_id", "passages", "edits", "whole_run"],
                )

            ids, docs, chars = [], [], 0
            for b in batches:
                for d, t in zip(b.column("d").to_pylist(), b.column("t").to_pylist()):
                    words = fold(t)
                    if not words:
                        continue
                    if len(t) > BATCH_CHARS:
                        yield flush([d], words, scan_long)
                        continue
                    ids.append(d)
                    docs.append(words)
                    chars += len(t)
                    if chars >= BATCH_CHARS or len(docs) >= MAX_DOCS:
                        yield flush(ids, docs)
                        ids, docs, chars = [], [], 0
            if docs:
                yield flush(ids, docs)

        out.append(src.mapInArrow(find, schema))
    return reduce(DataFrame.unionByName, out)
