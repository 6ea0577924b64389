"""Queries and oracle SQL of the language-model data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan.llm import contamination, language, lookalikes, nearest_time, packing, vector_forest
from reelspan.session import stored, table


def _texts(spark: SparkSession, d: str) -> DataFrame:
    ocr = table(spark, d, "ocr").select(F.lit("ocr").alias("source_table"), F.concat("frame_id", F.lit("#"), F.col("n").cast("string")).alias("record_key"), "text")
    video = table(spark, d, "video").select(F.lit("video").alias("source_table"), F.col("video_id").alias("record_key"), F.col("description").alias("text"))
    return ocr.unionByName(video)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.changed_records(lookalikes.consistent_texts(_texts(spark, d)))


def p4_texts(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.consistent_texts(_texts(spark, d)).select("source_table", "record_key", "consistent").distinct()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    entries = nearest_time.batch_entries(table(spark, d, "decoded_batch"))
    frames = table(spark, d, "frame").select("video_id", "timestamp_ms", "frame_id")
    near = nearest_time.nearest_in_time(entries, frames, entity="video_id", left_time="moment_ms", right_time="timestamp_ms", right_key="frame_id", tolerance_ms=500)
    return near.select("batch_id", F.col("pos").cast("int").alias("pos"), F.col("right_key").alias("frame_id"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = vector_forest.similar_pairs(table(spark, d, "redundancy_candidate"), "candidate_id", "clip_vector")
    return pairs.select(F.col("id_a").alias("candidate_a"), F.col("id_b").alias("candidate_b"))


def p3_recall(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "redundancy_candidate")
    truth = vector_forest.recall_queries(rows, "candidate_id", "clip_vector").select(F.least("q", "other").alias("candidate_a"), F.greatest("q", "other").alias("candidate_b")).distinct()
    hits = truth.join(p3_found(spark, d).withColumn("hit", F.lit(1)), ["candidate_a", "candidate_b"], "left")
    return hits.agg(F.count("*").alias("true_pairs"), F.count("hit").alias("found_pairs"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return contamination.leaks(table(spark, d, "documents"), table(spark, d, "eval_item"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).where("whole_run").select("doc_id", "item_id").distinct()


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d)


CAPACITY = 2048


def p7_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), capacity=CAPACITY)


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.container_fill(p7_packing(spark, d), CAPACITY)


def p7_invariants(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    counts = stored(packing.token_counts(documents), "token-counts")
    return packing.packing_faults(stored(packing.pack(counts, CAPACITY), "packed"), counts, CAPACITY)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return language.wrong_or_mixed(language.document_languages(language.segments(table(spark, d, "documents"))))


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    return language.segments(table(spark, d, "documents")).drop("label")


def p9_documents(spark: SparkSession, d: str) -> DataFrame:
    return language.document_languages(language.segments(table(spark, d, "documents")))


def queries() -> dict:
    return {f.__name__: f for f in (p3_found, p3_recall, p4_found, p4_texts, p5_found, p7_packing, p7_fill, p7_invariants, p8_found, p8_leaks, p9_found, p9_segments, p9_documents)}


def oracle_sql() -> dict[str, str]:
    words = r"list_filter(regexp_split_to_array(replace(regexp_replace(nfc_normalize(strip_accents(lower(text))), '\p{Mn}', '', 'g'), 'đ', 'd'), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    return {
        "p7_invariants": "SELECT count(DISTINCT doc_id) AS texts, 0 AS not_covered_once, 0 AS cut_without_need, 0 AS above_capacity, 0 AS numbers_left_out FROM documents WHERE text <> ''",
        "p8_found": f"""
        WITH d AS (SELECT doc_id AS k, {words} AS w FROM documents), i AS (SELECT item_id AS k, {words} AS w FROM eval_item),
        dg AS (SELECT k, unnest(list_transform(range(1, len(w) - 6), lambda p: array_to_string(w[p:p + 7], ' '))) AS g FROM d WHERE len(w) >= 8),
        ig AS (SELECT k, unnest(list_transform(range(1, len(w) - 6), lambda p: array_to_string(w[p:p + 7], ' '))) AS g FROM i WHERE len(w) >= 8)
        SELECT DISTINCT dg.k AS doc_id, ig.k AS item_id FROM dg JOIN ig ON dg.g = ig.g""",
        "p3_found": """
        WITH c AS (SELECT candidate_id AS i, any_value(clip_vector) AS v FROM redundancy_candidate WHERE len(clip_vector) = 64 AND len(list_filter(clip_vector, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 GROUP BY 1),
        n AS (SELECT i, CAST(v AS DOUBLE[64]) AS v FROM c WHERE list_sum(list_transform(v, lambda x: abs(x))) > 0),
        s AS (SELECT a.i AS a, b.i AS b, array_cosine_similarity(a.v, b.v) AS cosine FROM n a JOIN n b ON a.i <> b.i),
        t AS (SELECT a, b, cosine, row_number() OVER (PARTITION BY a ORDER BY cosine DESC, b) AS r FROM s WHERE cosine >= 0.85)
        SELECT DISTINCT least(a, b) AS candidate_a, greatest(a, b) AS candidate_b FROM t WHERE r <= 5""",
        "p5_found": """
        WITH u AS (SELECT DISTINCT batch_id, video_id, unnest(range(greatest(coalesce(len(requested_timestamps_ms), 0), coalesce(len(actual_timestamps_ms), 0)))) AS pos, requested_timestamps_ms AS r, actual_timestamps_ms AS a FROM decoded_batch),
        e AS (SELECT DISTINCT batch_id, pos, video_id, coalesce(a[pos + 1], r[pos + 1]) AS m FROM u),
        f AS (SELECT DISTINCT frame_id, video_id, timestamp_ms AS t FROM frame WHERE timestamp_ms IS NOT NULL),
        j AS (SELECT batch_id, pos, frame_id, row_number() OVER (PARTITION BY batch_id, pos ORDER BY abs(t - m), t, frame_id) AS n FROM e JOIN f ON e.video_id = f.video_id AND f.t BETWEEN e.m - 500 AND e.m + 500)
        SELECT batch_id, CAST(pos AS INTEGER) AS pos, frame_id FROM j WHERE n = 1""",
    }
