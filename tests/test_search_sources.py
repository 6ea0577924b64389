from pyspark.sql import functions as F

from reelspan.operators import search
from reelspan.plans import media
from reelspan.session import table

DATA = "/root/testdata/sf0.001"


def test_corpus_has_all_four_sources(spark):
    docs = media._documents(spark, DATA).select("doc_id", "source_type", "entity_id", "language").cache()
    assert {r["source_type"] for r in docs.select("source_type").distinct().collect()} == set(search.SOURCES)
    spoken = table(spark, DATA, "documents").where("source = 'transcript' AND trim(text) <> ''")
    found = docs.where("source_type = 'transcript'")
    want = {(f"transcript:{r['doc_id']}:v1", r["lang"]) for r in spoken.collect()}
    assert want and {(r["doc_id"], r["language"]) for r in found.collect()} == want
    kinds = docs.where("source_type = 'caption'").groupBy(F.substring("entity_id", 1, 2).alias("k")).count().collect()
    assert {r["k"] for r in kinds} == {"f:", "c:", "s:"}
    assert docs.count() == docs.select("doc_id").distinct().count()
    docs.unpersist()


def test_phrases_highlights_and_fuzzy_terms(spark):
    from pyspark.sql import functions as F

    from reelspan.operators import search

    marked = lambda t, *q: spark.range(1).select(search.highlighted(F.lit(t), list(q)).alias("x")).first()["x"]
    assert marked("Cây CẦU tre, cau-tre; cầuu", "cau") == "Cây <em>CẦU</em> tre, <em>cau</em>-tre; cầuu"
    assert marked("Ca\u0302\u0300u \u0111i đi", "cầu đi") == "<em>Ca\u0302\u0300u</em> <em>\u0111i</em> <em>đi</em>"
    has = lambda t: spark.range(1).select(search.has_phrase(F.lit(t), ["cau", "tre"]).alias("x")).first()["x"]
    assert has("một CẦU, tre") and not has("cau trenn") and not has("xcau tre") and not has("")
    docs = search.all_documents(search.transcript_documents(spark.createDataFrame([("1", "v", "cau", None, 0, 1), ("2", "v", "cua", None, 0, 1), ("3", "v", "xyz", None, 0, 1)], "segment_id string, video_id string, text string, language string, start_ms long, end_ms long")))
    score = {r["entity_id"]: r["score"] for r in search.search(docs, search.SearchQuery("cầu", use_fuzzy=True)).collect()}
    plain = {r["entity_id"]: r["score"] for r in search.search(docs, search.SearchQuery("cầu")).collect()}
    assert set(plain) == {"1"} and set(score) == {"1"} and abs(score["1"] - plain["1"] - 1) < 1e-9  # "cua" is two edits away
