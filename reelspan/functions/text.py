"""Text expressions: normal forms, analysis, parsing. All are columns unless noted."""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Composed normal form; null stays null."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def collapse(c: Column) -> Column:
    """White space runs become one blank; ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def recognized_text(c: Column) -> Column:
    """Composed normal form, white space collapsed."""
    return collapse(nfc(c))


def class_name(c: Column) -> Column:
    """Comparable class name: lower case, underscores as blanks, white space collapsed."""
    return F.trim(F.regexp_replace(F.replace(F.lower(F.trim(c)), F.lit("_"), F.lit(" ")), r"\s+", " "))


def non_blank(c: Column) -> Column:
    """Stripped text, or null if nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def join_texts(*cols: Column, sep: str = " ") -> Column:
    """The non-blank texts joined; null if there is none."""
    kept = F.filter(F.array(*[non_blank(c) for c in cols]), lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.array_join(kept, sep))


def keyword_array(c: Column) -> Column:
    """Comma-separated keywords as an array of stripped, non-empty ones."""
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")


@lru_cache(maxsize=1)
def _accents() -> tuple[str, str]:
    """Composed Latin letters and their bare forms, from the Unicode decompositions."""
    pairs = []
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(cp))
        if len(base) > 1 and base[0].isascii():
            pairs.append((chr(cp), base[0]))
    pairs += [("đ", "d"), ("Đ", "D")]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold_accents(c: Column) -> Column:
    """Letters without accents, by one translation inside the JVM; combining marks drop out."""
    src, dst = _accents()
    return F.regexp_replace(F.translate(c, src, dst), r"\p{Mn}+", "")


def tokens(c: Column) -> Column:
    """Lower-case words (runs of letters and digits)."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def shingles(words: Column, low: int = 2, high: int = 3) -> Column:
    """Word n-grams of low..high words, joined by blanks, in order."""
    def grams(n: int) -> Column:
        at = F.sequence(F.lit(1), F.size(words) - n + 1)
        return F.when(F.size(words) >= n, F.transform(at, lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))

    return F.concat(*[grams(n) for n in range(low, high + 1)])


def analyzed(c: Column) -> Column:
    """Index terms: words, their accent-free forms and shingles of two and three words."""
    words = tokens(c)
    bare = tokens(fold_accents(c))
    return F.array_distinct(F.concat(words, bare, shingles(words), shingles(bare)))


def clock_ms(c: Column, *, strict: bool = True) -> Column:
    """Hours:minutes:seconds:milliseconds as milliseconds; parts may exceed their usual range (00:75:00:000).

    Anything but four whole numbers, or a negative one, fails the job; null with ``strict`` off.
    """
    part = lambda i: F.get(F.split(c, ":"), F.lit(i)).try_cast("long")
    parts = [part(i) for i in range(4)]
    ok = (F.size(F.split(c, ":")) == 4) & reduce(lambda a, b: a & b, [p.isNotNull() & (p >= 0) for p in parts])
    value = parts[0] * 3_600_000 + parts[1] * 60_000 + parts[2] * 1000 + parts[3]
    bad = F.raise_error(F.concat(F.lit("not hours:minutes:seconds:milliseconds: "), c)).cast("long") if strict else F.lit(None).cast("long")
    return F.when(c.isNull(), F.lit(None).cast("long")).when(F.coalesce(ok, F.lit(False)), value).otherwise(bad)


def _fenced(c: Column) -> Column:
    """The first object that stands alone between two fences, or null."""
    between = F.slice(F.split(c, "```"), 2, F.greatest(F.size(F.split(c, "```")) - 2, F.lit(0)))
    bare = F.transform(between, lambda x: F.btrim(F.regexp_replace(x, r"\Ajson", ""), F.lit(" \t\n\r\f")))
    return F.get(F.filter(bare, lambda x: x.startswith("{") & x.endswith("}")), F.lit(0))


def _braced(c: Column) -> Column:
    """From the first opening to the last closing brace, or null."""
    opens, closes = F.instr(c, "{"), F.length(c) - F.instr(F.reverse(c), "}") + 1
    return F.when((opens > 0) & (F.instr(c, "}") > 0) & (closes > opens), F.substring(c, opens, closes - opens + 1))


def caption_json(c: Column) -> Column:
    """The JSON text of a caption: a fenced block first, else the outermost braces; null if it does not parse."""
    picked = F.coalesce(_fenced(c), _braced(c))
    return F.when(F.try_parse_json(picked).isNotNull(), picked)


def caption_text(c: Column) -> Column:
    """What stands before the JSON; the whole text if there is no JSON or nothing before it."""
    blanks = F.lit(" \t\n\r\f")
    at = F.when(_fenced(c).isNotNull(), F.instr(c, "```")).when(_braced(c).isNotNull(), F.instr(c, "{"))
    head = F.btrim(F.substring(c, F.lit(1), at - 1), blanks)
    return F.coalesce(F.nullif(head, F.lit("")), F.btrim(c, blanks))


def has_keys(json_text: Column, keys: tuple[str, ...] = ("scene", "objects", "actions")) -> Column:
    """Whether a JSON object has all keys; false for null."""
    found = F.json_object_keys(json_text)
    return F.coalesce(F.forall(F.array(*map(F.lit, keys)), lambda k: F.array_contains(found, k)), F.lit(False))


def chat_content(payload: Column) -> Column:
    """Text of the first choice of a chat completion: a string, or text parts joined by line breaks."""
    plain = F.get_json_object(payload, "$.choices[0].message.content")
    parts = F.from_json(plain, "array<struct<type string, text string>>")
    texts = F.filter(F.transform(F.filter(parts, lambda p: p["type"] == "text"), lambda p: p["text"]), lambda t: t.isNotNull())
    return F.when(plain.startswith("["), F.array_join(texts, "\n")).otherwise(plain)


def sql_literal(c: Column, kind: str = "string") -> Column:
    """A value as SQL text: NULL, a number, or a quoted string with quotes doubled."""
    if kind == "number":
        return F.coalesce(c.cast("string"), F.lit("NULL"))
    if kind == "float":
        return F.coalesce(F.format_string("%.9g", c.cast("double")), F.lit("NULL"))
    return F.coalesce(F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))


def safe_component(c: Column) -> Column:
    """A path component of letters, digits, dot, dash and underscore; `unknown` if nothing is left."""
    cleaned = F.regexp_replace(F.regexp_replace(F.trim(c), r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit("unknown"))


def url_join(base: Column, path: Column) -> Column:
    """base/path with one slash between and each path segment percent-encoded."""
    encoded = F.array_join(F.transform(F.split(F.regexp_replace(path, r"^/+", ""), "/"), lambda p: F.replace(F.url_encode(p), F.lit("+"), F.lit("%20"))), "/")
    return F.concat(F.regexp_replace(base, r"/+$", ""), F.lit("/"), encoded)


def url_origin(c: Column) -> Column:
    """scheme://host[:port] of a valid http(s) address, else null."""
    return F.nullif(F.regexp_extract(c, r"^(https?://[^/\s?#]+)", 1), F.lit(""))


def fill_template(template: str, **values: Column) -> Column:
    """Replace {name} marks by columns; null values become empty."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return out


def bullet_list(texts: Column) -> Column:
    """An array of texts as lines that start with a dash."""
    return F.array_join(F.transform(texts, lambda t: F.concat(F.lit("- "), t)), "\n")


def fraction(c: Column) -> Column:
    """A rate written `a/b` or `a`; null where it is no number or b is zero."""
    parts = F.split(c, "/")
    b = F.when(F.size(parts) > 1, F.get(parts, F.lit(1)).try_cast("double")).otherwise(F.lit(1.0))
    return F.try_divide(parts[0].try_cast("double"), b)
