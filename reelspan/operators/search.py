"""Text search over documents: building them, an inverted index, and scored queries.

A document has doc_id, source_type, entity_id, video_id, title, keywords, description,
content, language, timestamp_ms, start_ms, end_ms and an array of text regions.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, replace
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspan.functions import ids, text
from reelspan.operators import aggregates, joins, validate

SOURCES = ("video_metadata", "ocr_frame", "transcript", "caption")
_REGIONS = "array<struct<n:int,text:string,language:string,x_min:double,x_max:double,y_min:double,y_max:double>>"
_COLUMNS = {
    "doc_id": "string", "source_type": "string", "entity_id": "string", "video_id": "string", "title": "string", "keywords": "string", "description": "string", "content": "string",
    "language": "string", "timestamp_ms": "bigint", "start_ms": "bigint", "end_ms": "bigint", "regions": _REGIONS,
}


def _document(df: DataFrame, source: str, entity: str, **cols: Column) -> DataFrame:
    given = {"source_type": F.lit(source), "entity_id": F.col(entity), "doc_id": ids.document_id(F.lit(source), F.col(entity)), **cols}
    return df.select(*[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in _COLUMNS.items()])


def video_documents(videos: DataFrame) -> DataFrame:
    """Title, description and keywords; a video with nothing but blanks gives none."""
    words = F.array_join(F.filter(F.transform("keywords", lambda k: text.non_blank(k)), lambda k: k.isNotNull()), " ")
    content = text.join_texts(F.col("title"), F.col("description"), words)
    return _document(videos, "video_metadata", "video_id", video_id=F.col("video_id"), title=text.non_blank(F.col("title")), keywords=text.non_blank(words), description=text.non_blank(F.col("description")), content=content).where("content IS NOT NULL")


def ocr_documents(ocr: DataFrame, frames: DataFrame) -> DataFrame:
    """One document per frame with its texts in order and its regions."""
    bodies = aggregates.ocr_bodies(ocr)
    joined = bodies.join(frames.select("frame_id", "video_id", "timestamp_ms"), "frame_id")
    return _document(joined, "ocr_frame", "frame_id", video_id=F.col("video_id"), content=F.col("content"), language=F.col("language"), timestamp_ms=F.col("timestamp_ms"), regions=F.col("regions"))


def transcript_documents(segments: DataFrame) -> DataFrame:
    return _document(segments.where(text.non_blank(F.col("text")).isNotNull()), "transcript", "segment_id", video_id=F.col("video_id"), content=F.trim("text"), language=F.col("language"), start_ms=F.col("start_ms"), end_ms=F.col("end_ms"))


def caption_documents(captions: DataFrame, frames: DataFrame, shots: DataFrame, clips: DataFrame) -> DataFrame:
    """Captions whose video can be resolved; others are left out."""
    resolved = joins.chained_video_id(captions, frames, shots, clips).where(F.col("video_id").isNotNull() & text.non_blank(F.col("text")).isNotNull())
    return _document(resolved, "caption", "caption_id", video_id=F.col("video_id"), content=F.trim("text"))


def all_documents(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def postings(documents: DataFrame, fields: tuple[str, ...] = ("title", "keywords", "description", "content"), key: str = "doc_id") -> DataFrame:
    """(term, field, key, tf, positions, field_len): the inverted index. Terms are accent-free words."""
    stacked = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), text.tokens(text.fold_accents(F.col(f))).alias("words")) for f in fields]))
    per = documents.select(key, stacked.alias("x")).where(F.size("x.words") > 0)
    terms = per.select(key, F.col("x.field").alias("field"), F.size("x.words").alias("field_len"), F.posexplode("x.words").alias("pos", "term"))
    return terms.groupBy("term", "field", key, "field_len").agg(F.count("*").alias("tf"), F.array_sort(F.collect_list("pos")).alias("positions"))


def field_stats(index: DataFrame, key: str = "doc_id") -> DataFrame:
    """(field, docs, avg_len)."""
    lens = index.select("field", key, "field_len").distinct()
    return lens.groupBy("field").agg(F.count("*").alias("docs"), F.avg("field_len").alias("avg_len"))


def bm25(index: DataFrame, terms: list[str], boosts: dict[str, float], *, key: str = "doc_id", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(key, score): per field the sum over terms of boosted BM25, the best field counts."""
    stats = field_stats(index, key)
    hits = index.where(F.col("term").isin(*terms) & F.col("field").isin(*boosts))
    df = hits.groupBy("term", "field").agg(F.count("*").alias("df"))
    boost = F.lit(0.0)
    for f, w in boosts.items():
        boost = F.when(F.col("field") == f, F.lit(float(w))).otherwise(boost)
    idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = boost * idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("field_len") / F.col("avg_len")))
    scored = hits.join(df, ["term", "field"]).join(stats, "field").withColumn("s", part)
    return scored.groupBy(key, "field").agg(F.sum("s").alias("s")).groupBy(key).agg(F.max("s").alias("score"))


def phrase_matches(index: DataFrame, phrase: str, field: str = "content", key: str = "doc_id") -> DataFrame:
    """(key, hits): how often the words of the phrase stand in a row in the field."""
    words = phrase.lower().split()
    first = None
    for i, w in enumerate(words):
        at = index.where((F.col("term") == w) & (F.col("field") == field)).select(key, F.explode("positions").alias("p")).select(key, (F.col("p") - i).alias("p"))
        first = at if first is None else first.join(at, [key, "p"], "left_semi")
    return first.groupBy(key).agg(F.count("*").alias("hits"))  # type: ignore[union-attr]


def fuzzy_terms(index: DataFrame, term: str) -> DataFrame:
    """(term, distance): index terms within the distance allowed for the length: 0 to 2 letters none, 3 to 5 one, else two."""
    allowed = 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2
    near = index.where(F.length("term").between(len(term) - allowed, len(term) + allowed)).select("term").distinct()
    return near.withColumn("distance", F.levenshtein("term", F.lit(term), allowed)).where("distance >= 0")


def simple_score(query: str, title: Column, content: Column) -> Column:
    """Phrase in content 10, in title 15; each distinct term in content 2, in title 3. Accents and case are ignored."""
    words = query.lower().split()
    c, t = F.coalesce(text.fold_accents(F.lower(content)), F.lit("")), F.coalesce(text.fold_accents(F.lower(title)), F.lit(""))
    one = lambda col, s, w: F.when(col.contains(s), w).otherwise(0)
    score = one(c, query.lower(), 10) + one(t, query.lower(), 15)
    for w in dict.fromkeys(words):
        score = score + one(c, w, 2) + one(t, w, 3)
    return score


@lru_cache(maxsize=1)
def _letters() -> dict[str, str]:
    """For each plain letter the composed Latin letters that fold to it."""
    out: dict[str, str] = {}
    for cp in range(0x80, 0x1F00):
        bare = "".join(c for c in unicodedata.normalize("NFD", chr(cp).lower()) if unicodedata.category(c) != "Mn").replace("đ", "d")
        if len(bare) == 1 and bare.isascii() and bare.isalpha():
            out[bare] = out.get(bare, bare) + chr(cp)
    return out


def highlighted(c: Column, terms: list[str]) -> Column:
    """Terms as whole words between <em> marks; case and accents are ignored as in matching."""
    plain = ["".join(f"[{_letters().get(ch, ch)}]\\p{{M}}*" if ch.isalnum() else _quote(ch) for ch in word) for t in terms for word in _fold_query(t)]
    return F.regexp_replace(c, r"(?iU)(?<![\p{L}\p{N}\p{M}])(" + "|".join(dict.fromkeys(plain)) + r")(?![\p{L}\p{N}\p{M}])", "<em>$1</em>") if plain else c


def has_phrase(c: Column, words: list[str]) -> Column:
    """Whether the words stand in a row in a text, compared as accent-free words."""
    line = F.concat(F.lit(" "), F.array_join(text.tokens(text.fold_accents(c)), " "), F.lit(" "))
    return line.contains(" " + " ".join(words) + " ")


def _quote(term: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in term)


@dataclass(frozen=True)
class SearchQuery:
    """A search request; ``offset`` follows from page and top_k unless from_ is given."""

    query_text: str
    top_k: int = 50
    from_: int = 0
    page: int = 1
    sort_by: str = "score"
    source_types: tuple[str, ...] = ()
    video_ids: tuple[str, ...] = ()
    language: str | None = None
    start_ms: int | None = None
    end_ms: int | None = None
    ocr_region: str | None = None
    use_fuzzy: bool = False
    use_highlight: bool = False

    def checked(self) -> SearchQuery:
        if not self.query_text.strip():
            raise ValueError("empty query")
        if self.top_k < 1 or self.from_ < 0 or self.page < 1:
            raise ValueError("top_k and page begin at 1, from_ at 0")
        if set(self.source_types) - set(SOURCES):
            raise ValueError("unknown source type")
        if self.start_ms is not None and self.end_ms is not None and self.end_ms <= self.start_ms:
            raise ValueError("end_ms must follow start_ms")
        return replace(self, query_text=self.query_text.strip())

    @property
    def offset(self) -> int:
        return (self.page - 1) * self.top_k if self.page > 1 and self.from_ == 0 else self.from_


def filtered(documents: DataFrame, q: SearchQuery) -> DataFrame:
    """The documents a query may find: sources, videos, language, time, region."""
    out = documents
    if q.source_types:
        out = out.where(F.col("source_type").isin(*q.source_types))
    if q.video_ids:
        out = out.where(F.col("video_id").isin(*q.video_ids))
    if q.language:
        out = out.where(F.col("language") == q.language)
    if q.start_ms is not None or q.end_ms is not None:
        out = out.where(validate.temporal_match(q.start_ms, q.end_ms))
    if q.ocr_region:
        out = out.where(validate.region_match(F.col("regions"), q.ocr_region))
    return out


def paged(scored: DataFrame, q: SearchQuery, key: str = "doc_id") -> DataFrame:
    """Order by score or field (a leading dash: descending), then key; skip and take."""
    if q.sort_by == "score":
        order = [F.desc("score"), F.asc(key)]
    else:
        name = q.sort_by.lstrip("-")
        order = [F.col(name).desc_nulls_last() if q.sort_by.startswith("-") else F.col(name).asc_nulls_last(), F.asc(key)]
    return scored.orderBy(*order).offset(q.offset).limit(q.top_k)


def _hits(documents: DataFrame, query: SearchQuery, index: DataFrame | None) -> DataFrame:
    """Hits of a query: phrase in content (x6), best boosted field, phrase in a region (x3), content terms within the edit distance (x1); one clause must match.

    Only the hits of a query leave the index; the documents are read once for filters and highlights.
    """
    q = query.checked()
    found = filtered(documents, q)
    index = postings(documents) if index is None else index
    words = [w for w in _fold_query(q.query_text) if w]
    clauses = [bm25(index, words, {"title": 5, "keywords": 4, "content": 3, "description": 1})]
    clauses.append(phrase_matches(index, " ".join(words)).select("doc_id", (F.lit(6.0) * F.col("hits") / (F.col("hits") + 1)).alias("score")))
    in_region = found.where(F.exists("regions", lambda r: has_phrase(r["text"], words)))
    clauses.append(in_region.select("doc_id", F.lit(3.0).alias("score")))
    if q.use_fuzzy:
        for w in words:
            near = fuzzy_terms(index, w).select("term")
            clauses.append(index.where("field = 'content'").join(near, "term", "left_semi").select("doc_id").distinct().withColumn("score", F.lit(1.0)))
    total = reduce(DataFrame.unionByName, clauses).groupBy("doc_id").agg(F.sum("score").alias("score"))
    return found.join(total, "doc_id")


def _marked(hits: DataFrame, q: SearchQuery) -> DataFrame:
    """Hits with ``highlight`` and the marked texts of matching regions, if the query wants them."""
    if not q.use_highlight:
        return hits
    words = _fold_query(q.query_text)
    marked = F.transform(F.filter("regions", lambda r: has_phrase(r["text"], words)), lambda r: highlighted(r["text"], [q.query_text]))
    return hits.withColumn("highlight", highlighted(F.col("content"), [q.query_text])).withColumn("region_highlights", marked)


def matches(documents: DataFrame, query: SearchQuery, index: DataFrame | None = None) -> DataFrame:
    """All hits of a query."""
    return _marked(_hits(documents, query, index), query.checked())


def search(documents: DataFrame, query: SearchQuery, index: DataFrame | None = None) -> DataFrame:
    """One page of the hits of a query; only what is shown is marked."""
    q = query.checked()
    return _marked(paged(_hits(documents, q, index), q), q)


def _fold_query(s: str) -> list[str]:
    bare = "".join(c for c in unicodedata.normalize("NFD", s.lower()) if unicodedata.category(c) != "Mn").replace("đ", "d")
    return "".join(c if c.isalnum() else " " for c in bare).split()


def publish_views(documents: DataFrame, prefix: str = "text_") -> list[str]:
    """One temporary view per source over a documents table; returns their names."""
    names = []
    for s in SOURCES:
        documents.where(F.col("source_type") == s).createOrReplaceTempView(prefix + s)
        names.append(prefix + s)
    return names


def health(spark, views: list[str]) -> bool:  # type: ignore[no-untyped-def]
    """Whether all published views are there."""
    return all(spark.catalog.tableExists(v) for v in views)
