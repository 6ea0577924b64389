"""One consistent form for texts that look alike but differ in their characters.

Character level, per text: composed normal form; invisible characters removed (joiners
inside emoji stay); every other space becomes U+0020; width variants and ligature-like
compatibility variants become plain letters, digits or punctuation (superscripts stay).
Token level: the dominant script of each token is determined; in tokens of mixed script
the letters of other scripts are replaced by look-alikes of one script, and only if the
result is a word of the corpus vocabulary, which is gathered from all tokens of one
script in all texts. Distinct mixed tokens are joined with the vocabulary; texts are never
grouped.

Defined cases: a null text stays null and is not changed; an empty text stays empty;
words wholly of one script, emoji joiners, superscripts and repeated plain spaces are
left alone; line breaks and tabs are left alone; repeated rows give repeated rows.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspan.session import stored

# Latin letters and the Cyrillic, Greek and rare Latin letters that look like them.
LOOK_ALIKES = {
    "A": "\u0410\u0391", "B": "\u0412\u0392", "C": "\u0421\u03f9", "E": "\u0415\u0395", "G": "\u050c", "H": "\u041d\u0397",
    "I": "\u0406\u04c0\u0399", "J": "\u0408\u037f", "K": "\u041a\u039a", "M": "\u041c\u039c", "N": "\u039d", "O": "\u041e\u039f",
    "P": "\u0420\u03a1", "Q": "\u051a", "S": "\u0405", "T": "\u0422\u03a4", "V": "\u0474", "W": "\u051c", "X": "\u0425\u03a7",
    "Y": "\u04ae\u0423\u03a5", "Z": "\u0396", "Đ": "\u0189\u00d0",
    "a": "\u0430\u03b1\u0251", "b": "\u042c\u044c", "c": "\u0441\u03f2", "d": "\u0501", "e": "\u0435", "g": "\u050d\u0261", "h": "\u04bb\u043d",
    "i": "\u0456\u03b9\u0131\u0269", "j": "\u0458\u03f3", "k": "\u043a\u03ba", "l": "\u04cf", "m": "\u043c", "n": "\u03b7\u043f", "o": "\u043e\u03bf\u03c3",
    "p": "\u0440\u03c1\u01bf", "q": "\u051b", "r": "\u0433", "s": "\u0455", "t": "\u0442\u03c4", "u": "\u03c5\u03bc", "v": "\u0475\u03bd\u028b", "w": "\u051d\u0461\u03c9",
    "x": "\u0445\u03c7", "y": "\u0443\u04af\u03b3", "đ": "\u00f0",
}
_TO_LATIN = {odd: latin for latin, odds in LOOK_ALIKES.items() for odd in odds}
_RARE = set("\u0251\u0261\u0189\u00d0\u00f0\u0131\u0269\u028b\u01bf")
_INVISIBLE_LETTERS = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180E, 0x3164, 0xFFA0, 0x2800}
_EMOJI = regex.compile(r"[\p{Extended_Pictographic}\p{Emoji_Modifier}️⃣\U0001F1E6-\U0001F1FF]")
_TOKEN = regex.compile(r"[\p{L}\p{N}\p{M}]+(?:['’][\p{L}\p{N}\p{M}]+)*")
_KINDS = ("<wide>", "<narrow>", "<compat>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>", "<square>", "<small>", "<vertical>", "<circle>")
_EAST = {"HAN", "HIRAGANA", "KATAKANA", "HANGUL", "BOPOMOFO"}


@lru_cache(maxsize=65536)
def _plain(c: str) -> str | None:
    """What a character becomes, or None if it stays as it is."""
    cp = ord(c)
    cat = unicodedata.category(c)
    if cp in _INVISIBLE_LETTERS or cat == "Cf" or (cat == "Cc" and c not in "\t\n\r\x0b\x0c\x85"):
        return ""
    if 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF or 0x180B <= cp <= 0x180D:
        return ""
    if cat == "Zs":
        return None if c == " " else " "
    if cat in ("Zl", "Zp"):
        return " "
    kind = unicodedata.decomposition(c).split(" ", 1)[0]
    if kind in _KINDS and cat[0] in "LNP":
        form = unicodedata.normalize("NFKC", c)
        return form if form != c and not form.startswith(" ") else None
    if kind in ("<wide>", "<narrow>", "<small>"):
        return unicodedata.normalize("NFKC", c)
    return None


def tidy(text: str) -> str:
    """The character-level form of a text."""
    if text.isascii() and not any(ord(c) < 32 and c not in "\t\n\r\x0b\x0c" or c == "\x7f" for c in text):
        return text
    out, n = [], len(text)
    for i, c in enumerate(text):
        p = _plain(c)
        if p is None:
            out.append(c)
        elif p == "" and (c == "‍" or 0xFE00 <= ord(c) <= 0xFE0F or 0xE0020 <= ord(c) <= 0xE007F):
            before = i > 0 and (_EMOJI.match(text[i - 1]) or 0xE0020 <= ord(text[i - 1]) <= 0xE007F)
            after = c != "‍" or (i + 1 < n and _EMOJI.match(text[i + 1]))
            out.append(c if before and after else "")
        else:
            out.append(p)
    return unicodedata.normalize("NFC", "".join(out))


@lru_cache(maxsize=65536)
def _script(c: str) -> str | None:
    if not c.isalpha():
        return None
    if c in _RARE:
        return "LATIN RARE"
    name = unicodedata.name(c, "UNKNOWN").split(" ", 1)[0]
    name = "HAN" if name in ("CJK", "IDEOGRAPHIC") else name
    return "EAST ASIAN" if name in _EAST or name == "HALFWIDTH" else name


_FROM_LATIN: dict[str, dict[str, str]] = {"CYRILLIC": {}, "GREEK": {}}
for _k, _v in _TO_LATIN.items():
    _s = _script(_k)
    if _s in _FROM_LATIN:
        _FROM_LATIN[_s].setdefault(_v, _k)


def scripts(token: str) -> Counter:
    return Counter(s for s in map(_script, token) if s)


def candidates(token: str) -> list[str]:
    """Forms of a mixed token in one script, that of its dominant letters first."""
    count = scripts(token)
    if len(count) < 2:
        return []
    order = [s for s, _ in sorted(count.items(), key=lambda x: (-x[1], x[0])) if s != "LATIN RARE"]
    order += [s for s in ("LATIN",) if s not in order]
    out = []
    for target in order:
        made = []
        for c in token:
            s = _script(c)
            if s is None or s == target:
                made.append(c)
                continue
            latin = c if s == "LATIN" else _TO_LATIN.get(c)
            swap = latin if target == "LATIN" else _FROM_LATIN.get(target, {}).get(latin or "")
            if swap is None:
                break
            made.append(swap)
        else:
            form = unicodedata.normalize("NFC", "".join(made))
            if form != token:
                out.append(form)
    return out


def _key(word: str) -> str:
    return word.casefold()


def _first_pass(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, tidied, mixed, plain = b.column("text").to_pylist(), [], [], []
        for t in texts:
            if t is None:
                tidied.append(None)
                mixed.append(None)
                plain.append(None)
                continue
            f = tidy(t)
            odd, usual = [], set()
            for m in _TOKEN.finditer(f):
                w = m[0]
                if w.isascii() or len(scripts(w)) < 2:
                    usual.add(_key(w))
                else:
                    odd.append(w)
            tidied.append(f)
            mixed.append(sorted(set(odd)))
            plain.append(sorted(usual))
        strings = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays([b.column(k) for k in keys] + [b.column("text"), pa.array(tidied, pa.string()), pa.array(mixed, strings), pa.array(plain, strings)], names=[*keys, "text", "tidy", "mixed", "plain"])


def _rewrite(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for t, swaps in zip(b.column("tidy").to_pylist(), b.column("swaps").to_pylist()):
            if t is not None and swaps:
                table = {s["word"]: s["fixed"] for s in swaps}
                t = unicodedata.normalize("NFC", _TOKEN.sub(lambda m: table.get(m[0], m[0]), t))
            out.append(t)
        yield pa.RecordBatch.from_arrays([b.column(k) for k in keys] + [b.column("text"), pa.array(out, pa.string())], names=[*keys, "text", "consistent"])


def consistent_texts(texts: DataFrame) -> DataFrame:
    """texts (source_table, record_key, text) with ``consistent`` added."""
    keys = ["source_table", "record_key"]
    base = "source_table string, record_key string, text string"
    first = stored(texts.select(*keys, "text").mapInArrow(lambda b: _first_pass(b, keys), base + ", tidy string, mixed array<string>, plain array<string>"), "tidy-texts")

    @F.pandas_udf("array<string>")
    def forms(words):  # type: ignore[no-untyped-def]
        return words.map(candidates)

    words = first.select(F.explode("mixed").alias("word")).distinct()
    tried = words.select("word", F.posexplode(forms("word")).alias("rank", "fixed"))
    vocabulary = first.select(F.explode("plain").alias("v")).distinct()
    known = tried.withColumn("v", _fold_column(F.col("fixed"))).join(vocabulary, "v", "left_semi")
    swaps = known.groupBy("word").agg(F.min_by("fixed", "rank").alias("fixed"))
    odd = first.where(F.size("mixed") > 0).select(*keys, "text", "tidy", "mixed").withColumn("_row", F.monotonically_increasing_id())
    odd = stored(odd, "mixed-texts")
    fixes = odd.select("_row", F.explode("mixed").alias("word")).join(swaps, "word").groupBy("_row").agg(F.collect_list(F.struct("word", "fixed")).alias("swaps"))
    repaired = odd.join(fixes, "_row", "left").select(*keys, "text", "tidy", "swaps").mapInArrow(lambda b: _rewrite(b, keys), base + ", consistent string")
    rest = first.where(F.col("mixed").isNull() | (F.size("mixed") == 0)).select(*keys, "text", F.col("tidy").alias("consistent"))
    return rest.unionByName(repaired)


def _fold_column(c):  # type: ignore[no-untyped-def]
    @F.pandas_udf("string")
    def fold(s):  # type: ignore[no-untyped-def]
        return s.map(_key)

    return fold(c)


def changed_records(result: DataFrame) -> DataFrame:
    """The records whose text had to change."""
    return result.where(F.col("text").isNotNull() & (F.col("text") != F.col("consistent"))).select("source_table", "record_key").distinct()
