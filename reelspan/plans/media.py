"""Relational, vector, box, text and search queries over the media tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspan.functions import geometry, ids, text, vectors
from reelspan.operators import aggregates, classes, joins, lookups, search, selectors, stretches, validate, vector_search
from reelspan.plans import common as c
from reelspan.session import stored, table
from reelspan.sources import readers, sinks

_Q: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):  # type: ignore[no-untyped-def]
    def add(f):  # type: ignore[no-untyped-def]
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


# joins and sets


@_query(
    f"""WITH v AS (SELECT candidate_id, video_id, row_number() OVER (PARTITION BY video_id ORDER BY frame_idx, candidate_id) - 1 AS pos FROM {c.CANDIDATES} WHERE video_id IS NOT NULL)
    SELECT v.candidate_id, f.frame_id FROM v JOIN {c.FRAMES} f ON f.video_id = v.video_id AND f.n = v.pos + 1 WHERE f.source = 'official'"""
)
def positional_vector_join(spark: SparkSession, d: str) -> DataFrame:
    rows = c.candidates(spark, d).where("video_id IS NOT NULL").select("candidate_id", "video_id", "frame_idx")
    v = stretches.Placed(rows, ["video_id"], ["frame_idx", "candidate_id"]).numbered("pos").result().withColumn("pos", F.col("pos") - 1)
    refs = c.frames(spark, d).where("source = 'official'").select("video_id", "n", "frame_id")
    return joins.positional_join(v, refs, key="video_id", pos="pos", n="n").select("candidate_id", "frame_id")


@_query(f"SELECT shot_id FROM {c.SOUND_SHOTS} WHERE shot_id NOT IN (SELECT shot_id FROM clip_record WHERE scale_type = 'fixed_window' AND shot_id IS NOT NULL)")
def pending_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return joins.pending(c.sound_shots(spark, d), table(spark, d, "clip_record"), "shot_id", scale_type="fixed_window").select("shot_id")


@_query(f"SELECT frame_id FROM {c.FRAMES} WHERE shot_id IN (SELECT shot_id FROM object_track WHERE confidence_sum >= 2)")
def retained_semi_join(spark: SparkSession, d: str) -> DataFrame:
    return joins.retained(c.frames(spark, d), table(spark, d, "object_track").where("confidence_sum >= 2"), "shot_id").select("frame_id")


@_query("SELECT DISTINCT shot_id FROM frame WHERE shot_id IS NOT NULL AND shot_id NOT IN (SELECT shot_id FROM shot WHERE shot_id IS NOT NULL)")
def missing_parent_check(spark: SparkSession, d: str) -> DataFrame:
    return joins.missing_parents(table(spark, d, "frame"), table(spark, d, "shot"), "shot_id")


@_query(f"SELECT s.shot_id, count(k.clip_id) AS clips, CASE WHEN count(k.clip_id) = 0 THEN 'no_clip_vectors' END AS failure FROM {c.SHOTS} s LEFT JOIN {c.CLIPS} k ON s.shot_id = k.shot_id GROUP BY 1")
def shots_left_or_failure(spark: SparkSession, d: str) -> DataFrame:
    j = joins.left_or_failure(c.shots(spark, d).select("shot_id"), c.clips(spark, d).select("shot_id", "clip_id"), "shot_id")
    return j.groupBy("shot_id").agg(F.count("clip_id").alias("clips"), F.max("failure").alias("failure"))


_CAPTIONS = f"""(SELECT 'f:' || frame_id AS caption_id, frame_id, NULL AS clip_id, NULL AS shot_id, text FROM {c.OCR} WHERE n = 1
  UNION ALL SELECT 'c:' || clip_id, NULL, clip_id, NULL, sampling_strategy FROM {c.CLIPS} UNION ALL SELECT 's:' || shot_id, NULL, NULL, shot_id, video_id FROM {c.SHOTS})"""


def _captions(spark: SparkSession, d: str, *, every: bool = False) -> DataFrame:
    """Captions of frames, clips and shots: of a frame the text n = 1, or every text with n in its caption_id."""
    none = F.lit(None).cast("string")
    o = c.ocr(spark, d) if every else c.ocr(spark, d).where("n = 1")
    frame_caption = F.concat(F.lit("f:"), "frame_id", F.lit(":"), F.col("n").cast("string")) if every else F.concat(F.lit("f:"), "frame_id")
    f = o.select(frame_caption.alias("caption_id"), "frame_id", none.alias("clip_id"), none.alias("shot_id"), "text")
    k = c.clips(spark, d).select(F.concat(F.lit("c:"), "clip_id").alias("caption_id"), none.alias("frame_id"), "clip_id", none.alias("shot_id"), F.col("sampling_strategy").alias("text"))
    s = c.shots(spark, d).select(F.concat(F.lit("s:"), "shot_id").alias("caption_id"), none.alias("frame_id"), none.alias("clip_id"), "shot_id", F.col("video_id").alias("text"))
    return f.unionByName(k).unionByName(s)


@_query(
    f"""SELECT x.caption_id, coalesce(f.video_id, s.video_id, cs.video_id) AS video_id FROM {_CAPTIONS} x LEFT JOIN {c.FRAMES} f ON x.frame_id = f.frame_id LEFT JOIN {c.SHOTS} s ON x.shot_id = s.shot_id
    LEFT JOIN {c.CLIPS} k ON x.clip_id = k.clip_id LEFT JOIN {c.SHOTS} cs ON k.shot_id = cs.shot_id"""
)
def caption_video_chain(spark: SparkSession, d: str) -> DataFrame:
    return joins.chained_video_id(_captions(spark, d), c.frames(spark, d), c.shots(spark, d), c.clips(spark, d)).select("caption_id", "video_id")


_ALL_CAPTIONS = _CAPTIONS.replace("'f:' || frame_id AS caption_id", "'f:' || frame_id || ':' || n AS caption_id").replace(" WHERE n = 1", "")


@_query(
    f"""SELECT x.caption_id, coalesce(f.video_id, s.video_id, cs.video_id) AS video_id FROM {_ALL_CAPTIONS} x LEFT JOIN {c.FRAMES} f ON x.frame_id = f.frame_id LEFT JOIN {c.SHOTS} s ON x.shot_id = s.shot_id
    LEFT JOIN {c.CLIPS} k ON x.clip_id = k.clip_id LEFT JOIN {c.SHOTS} cs ON k.shot_id = cs.shot_id"""
)
def caption_video_all(spark: SparkSession, d: str) -> DataFrame:
    """As caption_video_chain, with every text of a frame."""
    return joins.chained_video_id(_captions(spark, d, every=True), c.frames(spark, d), c.shots(spark, d), c.clips(spark, d)).select("caption_id", "video_id")


@_query("SELECT frame_id, count(*) AS rows FROM frame GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(spark: SparkSession, d: str) -> DataFrame:
    return joins.key_conflicts(table(spark, d, "frame"), "frame_id")


@_query(f"SELECT video_id, title FROM {c.VIDEOS}")
def current_videos(spark: SparkSession, d: str) -> DataFrame:
    return c.videos(spark, d).select("video_id", "title")


@_query("SELECT coalesce(a.video_id, b.video_id) AS video_id, CASE WHEN b.video_id IS NULL THEN 'left' ELSE 'right' END AS side FROM (SELECT DISTINCT video_id FROM video) a FULL JOIN (SELECT DISTINCT video_id FROM frame) b ON a.video_id = b.video_id WHERE a.video_id IS NULL OR b.video_id IS NULL")
def coverage_set_diff(spark: SparkSession, d: str) -> DataFrame:
    return joins.symmetric_difference(table(spark, d, "video"), table(spark, d, "frame"), "video_id")


@_query(
    """WITH old AS (SELECT * FROM shot WHERE shot_index % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY shot_id ORDER BY ingested_at) = 1), new AS (SELECT *, CASE WHEN shot_index % 5 = 0 THEN end_ms + 1 ELSE end_ms END AS e FROM shot QUALIFY row_number() OVER (PARTITION BY shot_id ORDER BY ingested_at) = 1)
    SELECT CASE WHEN o.shot_id IS NULL THEN 'inserted' WHEN n.video_id IS DISTINCT FROM o.video_id THEN 'conflict' WHEN n.start_ms IS NOT DISTINCT FROM o.start_ms AND n.e IS NOT DISTINCT FROM o.end_ms THEN 'unchanged' ELSE 'updated' END AS status, count(*) AS rows
    FROM new n LEFT JOIN old o ON n.shot_id = o.shot_id GROUP BY 1"""
)
def upsert_status(spark: SparkSession, d: str) -> DataFrame:
    first = joins.first_arrivals(table(spark, d, "shot"), "shot_id").select("shot_id", "video_id", "shot_index", "start_ms", "end_ms")
    new = first.withColumn("end_ms", F.when(F.col("shot_index") % 5 == 0, F.col("end_ms") + 1).otherwise(F.col("end_ms")))
    return joins.upsert_status(new, first.where("shot_index % 3 <> 0"), "shot_id", ["start_ms", "end_ms"], ["video_id"]).groupBy("status").agg(F.count("*").alias("rows"))


@_query("SELECT r_name, count(*) AS nations, CAST(sum(n_nationkey) AS BIGINT) AS key_sum FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def dimension_join(spark: SparkSession, d: str) -> DataFrame:
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).groupBy("r_name").agg(F.count("*").alias("nations"), F.sum("n_nationkey").cast("long").alias("key_sum"))


@_query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)")
def order_customer_check(spark: SparkSession, d: str) -> DataFrame:
    cust = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return joins.missing_parents(table(spark, d, "orders"), cust, "o_custkey")


# aggregates


@_query(
    f"""SELECT shot_id, source, min(timestamp_ms) AS start_ms, greatest(max(timestamp_ms), min(timestamp_ms) + 1) AS end_ms, count(*) AS observation_count, round(avg(fps), 6) AS average_rate
    FROM {c.FRAMES} WHERE shot_id IS NOT NULL AND timestamp_ms IS NOT NULL GROUP BY 1, 2"""
)
def track_summary(spark: SparkSession, d: str) -> DataFrame:
    f = c.frames(spark, d).where("shot_id IS NOT NULL AND timestamp_ms IS NOT NULL")
    t = aggregates.track_summary(f, ["shot_id", "source"], confidence="fps")
    return t.select("shot_id", "source", "start_ms", "end_ms", "observation_count", F.round("average_confidence", 6).alias("average_rate"))


@_query(f"SELECT class_id, count(*) AS tracks, CAST(sum(observation_count) AS BIGINT) AS observations, round(sum(confidence_sum) / sum(CASE WHEN confidence_sum IS NOT NULL THEN observation_count END), 6) AS confidence FROM {c.TRACKS} WHERE observation_count > 0 GROUP BY 1")
def class_track_totals(spark: SparkSession, d: str) -> DataFrame:
    t = c.tracks(spark, d).where("observation_count > 0")
    return t.groupBy("class_id").agg(F.count("*").alias("tracks"), F.sum("observation_count").alias("observations"), F.round(F.sum("confidence_sum") / F.sum(F.when(F.col("confidence_sum").isNotNull(), F.col("observation_count"))), 6).alias("confidence"))


@_query(
    f"""WITH x AS (SELECT shot_id, unnest(range(1, 65)) AS i, CAST(clip_vector AS DOUBLE[]) AS v FROM {c.CANDIDATES} WHERE shot_id IS NOT NULL), m AS (SELECT shot_id, i, avg(v[i]) AS m FROM x GROUP BY 1, 2),
    n AS (SELECT shot_id, sqrt(sum(m * m)) AS l FROM m GROUP BY 1) SELECT m.shot_id, round(max(CASE WHEN i = 1 THEN m / l END), 6) AS first, round(sum(m / l), 6) AS total FROM m JOIN n ON m.shot_id = n.shot_id WHERE l > 1e-12 GROUP BY 1"""
)
def masked_mean_pool(spark: SparkSession, d: str) -> DataFrame:
    p = vectors.mean_pool(c.candidates(spark, d).where("shot_id IS NOT NULL"), ["shot_id"], "clip_vector", dim=64).where("pooled IS NOT NULL")
    return p.select("shot_id", F.round(F.col("pooled")[0], 6).alias("first"), F.round(F.aggregate("pooled", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


@_query(
    f"""WITH x AS (SELECT video_id, unnest(range(1, 65)) AS i, CAST(clip_vector AS DOUBLE[]) AS v, 1 + coalesce(center_distance, 0) AS w FROM {c.CANDIDATES} WHERE video_id IS NOT NULL), m AS (SELECT video_id, i, sum(w * v[i]) / sum(w) AS m FROM x GROUP BY 1, 2),
    n AS (SELECT video_id, sqrt(sum(m * m)) AS l FROM m GROUP BY 1) SELECT m.video_id, round(sum(m / l), 6) AS total FROM m JOIN n ON m.video_id = n.video_id WHERE l > 1e-12 GROUP BY 1"""
)
def weighted_shot_pool(spark: SparkSession, d: str) -> DataFrame:
    p = vectors.mean_pool(c.candidates(spark, d).where("video_id IS NOT NULL"), ["video_id"], "clip_vector", weight=1 + F.coalesce("center_distance", F.lit(0.0)), dim=64).where("pooled IS NOT NULL")
    return p.select("video_id", F.round(F.aggregate("pooled", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


@_query(
    """WITH o AS (SELECT * FROM ocr QUALIFY row_number() OVER (PARTITION BY frame_id, n ORDER BY ingested_at NULLS LAST) = 1),
    k AS (SELECT * FROM o WHERE trim(text) <> '' AND x_min BETWEEN 0 AND 1 AND x_max BETWEEN 0 AND 1 AND y_min BETWEEN 0 AND 1 AND y_max BETWEEN 0 AND 1 AND x_min <= x_max AND y_min <= y_max)
    SELECT frame_id, string_agg(trim(text), chr(10) ORDER BY n) AS content, arg_min(language, n) FILTER (WHERE trim(language) <> '') AS language, count(*) AS regions FROM k GROUP BY 1"""
)
def doc_build_ocr(spark: SparkSession, d: str) -> DataFrame:
    b = aggregates.ocr_bodies(c.ocr(spark, d))
    return b.select("frame_id", "content", "language", F.size("regions").cast("long").alias("regions"))


@_query(f"SELECT video_id, count(*) AS rows, round(avg(l), 5) AS mean_norm, round(min(l), 5) AS min_norm, round(max(l), 5) AS max_norm FROM (SELECT video_id, sqrt(list_inner_product(CAST(clip_vector AS DOUBLE[]), CAST(clip_vector AS DOUBLE[]))) AS l FROM {c.CANDIDATES}) GROUP BY 1")
def artifact_norm_stats(spark: SparkSession, d: str) -> DataFrame:
    s = aggregates.norm_stats(c.candidates(spark, d), "clip_vector", "video_id")
    return s.select("video_id", "rows", *[F.round(x, 5).alias(x) for x in ("mean_norm", "min_norm", "max_norm")])


@_query("SELECT max(TRY_CAST(event_type AS DOUBLE)) AS max_event_type, avg(TRY_CAST(event_type AS DOUBLE)) AS avg_event_type, max(TRY_CAST(v AS DOUBLE)) AS max_v, round(avg(TRY_CAST(v AS DOUBLE)), 6) AS avg_v FROM (SELECT event_type, CASE WHEN event_id % 10 = 0 THEN '[N/A]' ELSE CAST(user_id AS VARCHAR) END AS v FROM events)")
def sample_summary(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_type", F.when(F.col("event_id") % 10 == 0, "[N/A]").otherwise(F.col("user_id").cast("string")).alias("v"))
    return aggregates.sample_summary(e, "event_type", "v").withColumn("avg_v", F.round("avg_v", 6))


@_query("SELECT CASE WHEN count(DISTINCT clip_builder_version) = 1 THEN max(clip_builder_version) END AS clip_builder_version, CASE WHEN count(DISTINCT sampling_version) = 1 THEN max(sampling_version) END AS sampling_version, CASE WHEN count(DISTINCT scale_type) = 1 THEN max(scale_type) END AS scale_type FROM clip_record")
def single_valued_metadata(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.single_value(table(spark, d, "clip_record"), "clip_builder_version", "sampling_version", "scale_type")


@_query(f"SELECT shot_id, bool_or(confidence_sum >= observation_count * 0.8) AS has_speech FROM {c.TRACKS} WHERE shot_id IS NOT NULL AND confidence_sum IS NOT NULL GROUP BY 1")
def any_flag(spark: SparkSession, d: str) -> DataFrame:
    t = c.tracks(spark, d).where("shot_id IS NOT NULL AND confidence_sum IS NOT NULL")
    return aggregates.any_speech(t, "shot_id", F.col("confidence_sum") >= F.col("observation_count") * F.lit(0.8))


@_query(
    """WITH p AS (SELECT vec_id % 10 AS part, vec_id, label % 3 AS cl, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), q AS (SELECT a.part, a.vec_id, a.cl, b.cl AS d, avg(list_distance(a.v, b.v)) AS m FROM p a JOIN p b ON a.part = b.part AND a.vec_id <> b.vec_id GROUP BY 1, 2, 3, 4),
    s AS (SELECT part, vec_id, coalesce(max(CASE WHEN cl = d THEN m END), 0) AS a, min(CASE WHEN cl <> d THEN m END) AS b FROM q GROUP BY 1, 2), k AS (SELECT part, count(DISTINCT cl) AS k, count(*) AS n FROM p GROUP BY 1)
    SELECT k.part, round(CASE WHEN any_value(k) < 2 OR any_value(k) >= any_value(n) THEN CAST('-infinity' AS DOUBLE) ELSE avg(CASE WHEN greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) END, 6) AS silhouette FROM k LEFT JOIN s ON k.part = s.part GROUP BY 1"""
)
def silhouette_score(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select((F.col("vec_id") % 10).alias("part"), "vec_id", (F.col("label") % 3).alias("cl"), F.col("embedding").alias("v"))
    return aggregates.silhouette(e, part="part", point="vec_id", cluster="cl", vector="v").select("part", F.round("silhouette", 6).alias("silhouette"))


@_query(
    f"""WITH p AS (SELECT video_id, (width % 8) * 64 + (least(floor((frame_idx % 256) / 32.0), 7)) * 8 + least(floor((timestamp_ms % 256) / 32.0), 7) AS bin, count(*) AS n FROM {c.FRAMES} WHERE video_id IS NOT NULL AND frame_idx >= 0 AND timestamp_ms >= 0 AND width IS NOT NULL GROUP BY 1, 2)
    SELECT video_id, CAST(bin AS BIGINT) AS bin, round(n / sqrt(sum(n * n) OVER (PARTITION BY video_id)), 6) AS share, count(*) OVER (PARTITION BY video_id) AS bins FROM p"""
)
def color_histogram(spark: SparkSession, d: str) -> DataFrame:
    f = c.frames(spark, d).where("video_id IS NOT NULL AND frame_idx >= 0 AND timestamp_ms >= 0 AND width IS NOT NULL")
    px = f.select("video_id", (F.col("width") % 8 * 32).alias("h"), (F.col("frame_idx") % 256).alias("s"), (F.col("timestamp_ms") % 256).alias("v"))
    return aggregates.color_histogram(px, "video_id").select("video_id", "bin", F.round("share", 6).alias("share"), "bins")


# vectors and retrieval

_TOPK = """WITH s AS (SELECT q.vec_id AS query_id, e.vec_id AS item_id, list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS score, q.label AS ql, e.label AS el FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0),
  t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM s)"""


def _top(spark: SparkSession, d: str, k: int) -> DataFrame:
    e = table(spark, d, "embeddings")
    return vector_search.exact_top_k(e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector")), e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector")), k)


def _relevant(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "label")
    return q.join(e.select(F.col("vec_id").alias("item_id"), "label"), "label").where("query_id <> item_id").select("query_id", "item_id")


@_query(f"{_TOPK} SELECT query_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM t WHERE rank <= 10")
def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    return _top(spark, d, 10).withColumn("score", F.round("score", 6))


@_query(f"{_TOPK} SELECT round(coalesce(avg(h), 0), 6) AS recall FROM (SELECT query_id, max(CASE WHEN ql = el AND query_id <> item_id THEN 1 ELSE 0 END) AS h FROM t WHERE rank <= 5 GROUP BY 1)")
def recall_at_k(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.recall_at_k(_top(spark, d, 10), _relevant(spark, d), 5).select(F.round("recall", 6).alias("recall"))


@_query(f"{_TOPK} SELECT round(coalesce(avg(h), 0), 6) AS mrr FROM (SELECT query_id, coalesce(1.0 / min(CASE WHEN ql = el AND query_id <> item_id THEN rank END), 0) AS h FROM t WHERE rank <= 10 GROUP BY 1)")
def mean_reciprocal_rank(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.mean_reciprocal_rank(_top(spark, d, 10), _relevant(spark, d)).select(F.round("mrr", 6).alias("mrr"))


@_query(
    """WITH r AS (SELECT * FROM redundancy_candidate QUALIFY row_number() OVER (PARTITION BY candidate_id ORDER BY ingested_at NULLS LAST) = 1),
    n AS (SELECT *, len(list_filter(clip_vector, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AS fin, sqrt(list_sum(list_transform(list_filter(clip_vector, lambda x: x IS NOT NULL), lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS l FROM r)
    SELECT fault, count(*) AS rows FROM (SELECT unnest(list_filter([CASE WHEN clip_vector IS NULL THEN 'missing' END, CASE WHEN len(clip_vector) <> 64 THEN 'dimension' END, CASE WHEN NOT fin THEN 'not_finite' END, CASE WHEN fin AND coalesce(l, 0) = 0 AND clip_vector IS NOT NULL THEN 'zero' END], lambda x: x IS NOT NULL)) AS fault FROM n) GROUP BY 1"""
)
def vector_quality_gate(spark: SparkSession, d: str) -> DataFrame:
    r = joins.first_arrivals(table(spark, d, "redundancy_candidate"), "candidate_id")
    return r.select(F.explode(vectors.vector_faults(F.col("clip_vector"), 64, unit_tolerance=None)).alias("fault")).groupBy("fault").agg(F.count("*").alias("rows"))


@_query("SELECT vec_id, row_number() OVER (ORDER BY label, vec_id) + 100 AS vector_id FROM embeddings")
def faiss_id_assign(spark: SparkSession, d: str) -> DataFrame:
    return ids.next_ids(table(spark, d, "embeddings").select("vec_id", "label"), 100, "label", "vec_id", name="vector_id").select("vec_id", "vector_id")


# boxes


@_query(f"SELECT class_id, count(*) AS rows FROM {c.TRACKS} WHERE confidence_sum / observation_count >= 0.6 AND observation_count > 0 AND class_id IN ('c001', 'c003') GROUP BY 1")
def class_filter(spark: SparkSession, d: str) -> DataFrame:
    t = c.tracks(spark, d).where("observation_count > 0").withColumn("confidence", F.col("confidence_sum") / F.col("observation_count"))
    return validate.by_classes(validate.by_confidence(t, 0.6), class_ids=["c001", "c003"]).groupBy("class_id").agg(F.count("*").alias("rows"))


@_query(f"SELECT frame_id, n, round(confidence, 6) AS confidence, round(y_min, 6) AS y_min, round(x_max, 6) AS x_max FROM {c.OCR} WHERE confidence >= 0.25 AND text IS NOT NULL")
def detection_unzip_filter(spark: SparkSession, d: str) -> DataFrame:
    o = c.ocr(spark, d).where("text IS NOT NULL AND confidence IS NOT NULL")
    s = lambda x: F.col(x).cast("string")
    packed = o.select(F.col("frame_id").alias("video_id"), F.lit(0).alias("keyframe_index"), F.array(s("confidence")).alias("detection_scores"), F.array("language").alias("detection_class_names"), F.array("text").alias("detection_class_entities"), F.array(F.array(s("y_min"), s("x_min"), s("y_max"), s("x_max"))).alias("detection_boxes"), F.array(s("n")).alias("detection_class_labels"))
    u = readers.unzip_detections(packed, 0.25)
    return u.select(F.col("video_id").alias("frame_id"), F.col("class_label").alias("n"), F.round("confidence", 6).alias("confidence"), F.round("bbox.y_min", 6).alias("y_min"), F.round("bbox.x_max", 6).alias("x_max"))


_IOU = """greatest(0, least(a.x_max, b.x_max) - greatest(a.x_min, b.x_min)) * greatest(0, least(a.y_max, b.y_max) - greatest(a.y_min, b.y_min))"""


@_query(
    f"""WITH p AS (SELECT a.frame_id, a.n AS n1, b.n AS n2, {_IOU} AS i, greatest(0, a.x_max - a.x_min) * greatest(0, a.y_max - a.y_min) + greatest(0, b.x_max - b.x_min) * greatest(0, b.y_max - b.y_min) AS s FROM {c.OCR} a JOIN {c.OCR} b ON a.frame_id = b.frame_id AND a.n < b.n)
    SELECT frame_id, n1, n2, round(CASE WHEN s - i > 0 THEN i / (s - i) ELSE 0 END, 6) AS iou FROM p WHERE i > 0"""
)
def iou_pairs(spark: SparkSession, d: str) -> DataFrame:
    o = c.ocr(spark, d).select("frame_id", "n", "x_min", "y_min", "x_max", "y_max")
    a, b = (o.select("frame_id", *[F.col(x).alias(f"{x}_{i}") for x in ("n", "x_min", "y_min", "x_max", "y_max")]) for i in (1, 2))
    box = lambda i: geometry.Box(*[F.col(f"{x}_{i}") for x in ("x_min", "y_min", "x_max", "y_max")])
    j = a.join(b, "frame_id").where("n_1 < n_2").where(geometry.intersection(box(1), box(2)) > 0)
    return j.select("frame_id", F.col("n_1").alias("n1"), F.col("n_2").alias("n2"), F.round(geometry.iou(box(1), box(2)), 6).alias("iou"))


@_query(f"SELECT frame_id, n, round(least(greatest(x_min * 2 - 0.5, 0), 1), 6) AS x1, round(least(greatest(y_max * 2 - 0.5, 0), 1), 6) AS y2 FROM {c.OCR} WHERE x_min IS NOT NULL AND y_max IS NOT NULL")
def box_normalize(spark: SparkSession, d: str) -> DataFrame:
    o = c.ocr(spark, d).where("x_min IS NOT NULL AND y_max IS NOT NULL")
    px = geometry.Box(*[(F.col(x) * 2 - 0.5) * s for x, s in (("x_min", 1280.0), ("y_min", 720.0), ("x_max", 1280.0), ("y_max", 720.0))])
    b = px.clipped(F.lit(1280.0), F.lit(720.0)).normalized(F.lit(1280.0), F.lit(720.0))
    return o.select("frame_id", "n", F.round(b.x1, 6).alias("x1"), F.round(b.y2, 6).alias("y2"))


@_query(
    f"""WITH m AS (SELECT frame_id, median(y_max * 720 - y_min * 720) AS m FROM {c.OCR} GROUP BY 1), o AS (SELECT o.*, round_even((y_min * 720 + y_max * 720) / 2 / greatest(8, m / 2), 0) AS l, (x_min * 1280 + x_max * 1280) / 2 AS cx FROM {c.OCR} o JOIN m ON o.frame_id = m.frame_id)
    SELECT frame_id, n, CAST(row_number() OVER (PARTITION BY frame_id ORDER BY l NULLS FIRST, cx NULLS FIRST, n) AS INTEGER) AS reading_rank FROM o"""
)
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    px = geometry.Box(F.col("x_min") * 1280, F.col("y_min") * 720, F.col("x_max") * 1280, F.col("y_max") * 720)
    return geometry.reading_order(c.ocr(spark, d), "frame_id", px, "n").select("frame_id", "n", "reading_rank")


@_query(
    f"""WITH h AS (SELECT shot_id, xor(frame_idx * 2654435761, frame_idx) AS h, min(candidate_id) AS i, count(*) AS n FROM {c.CANDIDATES} WHERE shot_id IS NOT NULL AND frame_idx IS NOT NULL GROUP BY 1, 2)
    SELECT a.shot_id, a.i AS a, b.i AS b, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) AS bits, a.n AS copies_a, b.n AS copies_b FROM h a JOIN h b ON a.shot_id = b.shot_id AND a.i < b.i WHERE bit_count(xor(a.h, b.h)) <= 8"""
)
def near_duplicate_hash_pairs(spark: SparkSession, d: str) -> DataFrame:
    h = c.candidates(spark, d).where("shot_id IS NOT NULL AND frame_idx IS NOT NULL").select("shot_id", "candidate_id", (F.col("frame_idx") * 2654435761).bitwiseXOR(F.col("frame_idx")).alias("h"))
    return joins.hamming_pairs(h, key="shot_id", row_id="candidate_id", hash_col="h", limit=8)


@_query()
def nms(spark: SparkSession, d: str) -> DataFrame:
    o = c.ocr(spark, d).where("x_min IS NOT NULL AND x_max IS NOT NULL AND y_min IS NOT NULL AND y_max IS NOT NULL AND confidence IS NOT NULL").select("frame_id", "n", "confidence", "x_min", "y_min", "x_max", "y_max")
    return selectors.non_maximum_suppression(o, frame="frame_id", class_col=None, score="confidence", box=("x_min", "y_min", "x_max", "y_max"), limit=0.45, order="n")


# validation


def _rules_sql(source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS reason, count(*) AS rows FROM {source} WHERE {w} HAVING count(*) > 0" for k, w in rules.items())


def _rule_counts(df: DataFrame, rules: dict) -> DataFrame:  # type: ignore[type-arg]
    return validate.with_reasons(df, rules).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


@_query(_rules_sql("shot", {"shot_id_missing": "shot_id IS NULL", "video_id_missing": "video_id IS NULL", "time_missing": "start_ms IS NULL OR end_ms IS NULL", "time_negative": "start_ms < 0", "time_reversed": "end_ms <= start_ms", "frames_reversed": "end_frame_idx < start_frame_idx"}))
def shot_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return _rule_counts(table(spark, d, "shot"), validate.shot_rules())


@_query(_rules_sql("frame", {"source_unknown": "source NOT IN ('official', 'extracted')", "official_with_shot": "source = 'official' AND shot_id IS NOT NULL", "official_without_n": "source = 'official' AND n IS NULL", "rate_not_positive": "fps <= 0", "time_missing": "timestamp_ms IS NULL"}))
def frame_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return _rule_counts(table(spark, d, "frame"), validate.frame_rules())


@_query(_rules_sql("clip_record", {"shot_id_missing": "shot_id IS NULL", "time_missing": "start_ms IS NULL OR end_ms IS NULL", "time_reversed": "end_ms <= start_ms", "frames_missing": "start_frame_idx IS NULL OR end_frame_idx IS NULL", "frame_count": "target_num_frames <= 0"}))
def clip_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return _rule_counts(table(spark, d, "clip_record"), validate.clip_rules())


@_query(_rules_sql("object_track", {"time_reversed": "end_ms <= start_ms", "no_observation": "observation_count <= 0", "confidence_missing": "confidence_sum IS NULL", "confidence_range": "confidence_sum < 0 OR confidence_sum > observation_count"}))
def track_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return _rule_counts(table(spark, d, "object_track"), validate.track_rules())


@_query(_rules_sql("ocr", {"text_blank": "text IS NULL OR trim(text) = ''", "box_range": "x_min NOT BETWEEN 0 AND 1 OR x_max NOT BETWEEN 0 AND 1 OR y_min NOT BETWEEN 0 AND 1 OR y_max NOT BETWEEN 0 AND 1", "box_order": "x_min >= x_max OR y_min >= y_max", "confidence_range": "confidence NOT BETWEEN 0 AND 1"}))
def ocr_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return _rule_counts(table(spark, d, "ocr"), validate.ocr_rules())


# ids and scalar functions


@_query(f"SELECT frame_id, made FROM (SELECT frame_id, video_id || '_' || lpad(CAST(n AS VARCHAR), CAST(greatest(3, length(CAST(n AS VARCHAR))) AS INTEGER), '0') AS made FROM {c.FRAMES} WHERE source = 'official' AND n IS NOT NULL AND video_id IS NOT NULL) WHERE length(made) <= 15")
def official_frame_ids(spark: SparkSession, d: str) -> DataFrame:
    f = c.frames(spark, d).where("source = 'official' AND n IS NOT NULL AND video_id IS NOT NULL")
    return f.select("frame_id", ids.official_frame_id(F.col("video_id"), F.col("n")).alias("made")).where("made IS NOT NULL")


@_query("SELECT video_id, max(CAST(nullif(regexp_extract(frame_id, '_E([0-9]+)$', 1), '') AS BIGINT)) AS last_seq FROM frame WHERE source = 'extracted' GROUP BY 1")
def extracted_frame_seq(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "frame").where("source = 'extracted'").groupBy("video_id").agg(F.max(ids.extracted_seq(F.col("frame_id"))).alias("last_seq"))


@_query()
def embedding_uuids(spark: SparkSession, d: str) -> DataFrame:
    k = c.sound_clips(spark, d)
    return k.select("clip_id", ids.uuid5(F.lit("media"), F.col("video_id"), F.col("shot_id"), F.col("start_ms"), F.col("end_ms"), F.col("clip_builder_version")).alias("uuid"))


@_query(f"SELECT video_id, lower(replace(strip_accents(replace(replace(title, 'đ', 'd'), 'Đ', 'D')), chr(769), '')) AS folded FROM {c.VIDEOS} WHERE title IS NOT NULL")
def accent_fold_match(spark: SparkSession, d: str) -> DataFrame:
    return c.videos(spark, d).where("title IS NOT NULL").select("video_id", F.lower(text.fold_accents(F.col("title"))).alias("folded"))


_WORDS = r"regexp_extract_all(lower(title), '[\p{L}\p{N}]+')"


@_query(f"SELECT video_id, len(w) AS words, CASE WHEN len(w) >= 2 THEN len(w) - 1 ELSE 0 END + CASE WHEN len(w) >= 3 THEN len(w) - 2 ELSE 0 END AS grams, w[1] || ' ' || w[2] AS first_gram FROM (SELECT video_id, {_WORDS} AS w FROM {c.VIDEOS} WHERE title IS NOT NULL) WHERE len(w) >= 2")
def analyzer_shingles(spark: SparkSession, d: str) -> DataFrame:
    w = text.tokens(F.col("title"))
    v = c.videos(spark, d).where("title IS NOT NULL").select("video_id", w.alias("w"), text.shingles(w).alias("g")).where(F.size("w") >= 2)
    return v.select("video_id", F.size("w").cast("long").alias("words"), F.size("g").cast("long").alias("grams"), F.col("g")[0].alias("first_gram"))


@_query(r"""WITH l AS (SELECT doc_id, unnest(regexp_extract_all(text, '\[([0-9]+:[0-9]+:[0-9]+:[0-9]+)\]', 1)) AS s FROM documents)
    SELECT doc_id, s, CAST(split_part(s, ':', 1) AS BIGINT) * 3600000 + CAST(split_part(s, ':', 2) AS BIGINT) * 60000 + CAST(split_part(s, ':', 3) AS BIGINT) * 1000 + CAST(split_part(s, ':', 4) AS BIGINT) AS ms FROM l""")
def timestamp_parse(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\[([0-9]+:[0-9]+:[0-9]+:[0-9]+)\]"), F.lit(1))).alias("s"))
    return t.withColumn("ms", text.clock_ms(F.col("s")))


_BLANKS = "' ' || chr(9) || chr(10) || chr(12) || chr(13)"


@_query(f"""WITH t AS (SELECT doc_id, text, list_transform(string_split(text, '```'), lambda x: trim(CASE WHEN starts_with(x, 'json') THEN substr(x, 5) ELSE x END, {_BLANKS})) AS f FROM documents WHERE source = 'caption' AND text IS NOT NULL),
    p AS (SELECT doc_id, text, coalesce(list_filter(f[2:len(f) - 1], lambda x: starts_with(x, '{{') AND ends_with(x, '}}'))[1], CASE WHEN instr(text, '{{') > 0 AND instr(reverse(text), '}}') > 0 AND length(text) - instr(reverse(text), '}}') + 1 > instr(text, '{{') THEN substr(text, instr(text, '{{'), length(text) - instr(reverse(text), '}}') + 2 - instr(text, '{{')) END) AS j FROM t)
    SELECT doc_id, json_valid(j) AND j IS NOT NULL AS has_json, coalesce(json_valid(j) AND list_has_all(json_keys(j), ['scene', 'objects', 'actions']), false) AS complete, CASE WHEN json_valid(j) THEN json_extract_string(j, '$.scene') END AS scene,
      trim(CASE WHEN j IS NULL THEN text WHEN trim(substr(text, 1, instr(text, '{{') - 1), {_BLANKS}) = '' THEN text ELSE regexp_replace(substr(text, 1, instr(text, '{{') - 1), '```(json)?\\s*\\z', '') END, {_BLANKS}) AS said FROM p""")
def caption_parse(spark: SparkSession, d: str) -> DataFrame:
    j = text.caption_json(F.col("text"))
    p = table(spark, d, "documents").where("source = 'caption' AND text IS NOT NULL").select("doc_id", j.alias("j"), text.caption_text(F.col("text")).alias("said"))
    return p.select("doc_id", F.col("j").isNotNull().alias("has_json"), text.has_keys(F.col("j")).alias("complete"), F.get_json_object("j", "$.scene").alias("scene"), "said")


@_query(f"SELECT video_id, len(list_filter(keywords, lambda x: trim(x) <> '')) AS kept, nullif(array_to_string(list_filter(keywords, lambda x: trim(x) <> ''), ','), '') AS joined FROM {c.VIDEOS} WHERE keywords IS NOT NULL")
def keyword_arrays(spark: SparkSession, d: str) -> DataFrame:
    back = text.keyword_array(F.array_join("keywords", ","))
    return c.videos(spark, d).where("keywords IS NOT NULL").select("video_id", F.size(back).cast("long").alias("kept"), F.nullif(F.array_join(back, ","), F.lit("")).alias("joined"))


@_query(f"""SELECT video_id, 'INSERT INTO video (video_id, title, duration_ms) VALUES (' || coalesce('''' || replace(video_id, '''', '''''') || '''', 'NULL') || ', ' || coalesce('''' || replace(title, '''', '''''') || '''', 'NULL') || ', ' || coalesce(CAST(duration_ms AS VARCHAR), 'NULL') || ');' AS sql FROM {c.VIDEOS}""")
def sql_statements(spark: SparkSession, d: str) -> DataFrame:
    v = c.videos(spark, d)
    cols = {"video_id": "string", "title": "string", "duration_ms": "number"}
    made = sinks.insert_statements(v.withColumn("_key", F.col("video_id")), "video", cols, keep=["_key"])
    return made.select(F.col("_key").alias("video_id"), "sql")


@_query(r"SELECT DISTINCT source, upper(trim(regexp_replace(lower(trim(source)), '_', ' ', 'g'))) AS label, coalesce(nullif(regexp_replace(source, '[^A-Za-z0-9._-]+', '_', 'g'), ''), 'unknown') AS path FROM documents WHERE source IS NOT NULL")
def name_normal_forms(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "documents").where("source IS NOT NULL").select("source").distinct()
    return s.select("source", F.upper(text.class_name(F.col("source"))).alias("label"), text.safe_component(F.col("source")).alias("path"))


@_query(f"SELECT video_id, regexp_extract(watch_url, '^(https?://[^/]+)', 1) AS origin, regexp_extract(watch_url, '^(https?://[^/]+)', 1) || '/v/' || video_id AS url FROM {c.VIDEOS} WHERE watch_url LIKE 'http%'")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    o = text.url_origin(F.col("watch_url"))
    return c.videos(spark, d).where("watch_url LIKE 'http%'").select("video_id", o.alias("origin"), text.url_join(o, F.concat(F.lit("/v/"), "video_id")).alias("url"))


@_query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE round(user_id / CAST(event_id % 5 AS DOUBLE), 6) END AS rate FROM events")
def rate_fractions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.concat(F.col("user_id").cast("string"), F.lit("/"), (F.col("event_id") % 5).cast("string")).alias("r"))
    return e.select("event_id", F.round(text.fraction(F.col("r")), 6).alias("rate"))


@_query()
def recognized_texts(spark: SparkSession, d: str) -> DataFrame:
    return c.ocr(spark, d).where("text IS NOT NULL").select("frame_id", "n", text.recognized_text(F.col("text")).alias("text"))


@_query(f"SELECT t.track_id, k.canonical_id, k.canonical_name FROM {c.TRACKS} t JOIN {classes.canonical_sql()} ON CAST(regexp_extract(t.class_id, '^c([0-9]+)$', 1) AS INTEGER) = k.class_index WHERE regexp_full_match(t.class_id, 'c[0-9]+')")
def canonical_classes(spark: SparkSession, d: str) -> DataFrame:
    t = c.tracks(spark, d).withColumn("class_index", classes.class_id_index(F.col("class_id"))).where("class_index BETWEEN 0 AND 79")
    return classes.with_canonical(t).select("track_id", "canonical_id", "canonical_name")


@_query(f"SELECT shot_id, shot_index FROM {c.SHOTS} WHERE video_id = 'L1_V1' ORDER BY shot_index, shot_id")
def shots_of_video(spark: SparkSession, d: str) -> DataFrame:
    return lookups.shots_of_video(c.shots(spark, d), "L1_V1").select("shot_id", "shot_index")


@_query(f"SELECT frame_id, frame_idx FROM {c.FRAMES} WHERE video_id = 'L1_V1' ORDER BY frame_idx, frame_id")
def frames_of_video(spark: SparkSession, d: str) -> DataFrame:
    return lookups.frames_of_video(c.frames(spark, d), "L1_V1").select("frame_id", "frame_idx")


@_query(f"SELECT frame_id FROM {c.FRAMES} WHERE source = 'extracted' OR (source = 'official' AND video_id IN (SELECT video_id FROM {c.VIDEOS}))")
def usable_frames(spark: SparkSession, d: str) -> DataFrame:
    return lookups.usable_frames(c.frames(spark, d).select("frame_id", "video_id", "source"), c.videos(spark, d)).select("frame_id")


@_query(f"SELECT scale_type, count(*) AS firsts, min(clip_id) AS least FROM (SELECT * FROM {c.SOUND_CLIPS} QUALIFY row_number() OVER (PARTITION BY shot_id ORDER BY start_ms, end_ms, clip_id) = 1) GROUP BY 1")
def first_clip_per_shot(spark: SparkSession, d: str) -> DataFrame:
    k = c.sound_clips(spark, d).select("shot_id", "start_ms", "end_ms", "clip_id", "scale_type")
    return lookups.first_distinct(k, ["shot_id"], "start_ms", "end_ms", "clip_id").groupBy("scale_type").agg(F.count("*").alias("firsts"), F.min("clip_id").alias("least"))


@_query(
    f"""WITH l AS (SELECT track_id, shot_id, row_number() OVER (PARTITION BY shot_id ORDER BY track_id) AS r FROM {c.TRACKS} WHERE shot_id IS NOT NULL), f AS (SELECT frame_id, frame_idx, timestamp_ms, shot_id, row_number() OVER (PARTITION BY shot_id ORDER BY frame_id) AS r FROM {c.FRAMES} WHERE shot_id IS NOT NULL)
    SELECT l.track_id, f.frame_idx, f.timestamp_ms FROM l JOIN f ON l.shot_id = f.shot_id AND l.r = f.r"""
)
def observation_migration(spark: SparkSession, d: str) -> DataFrame:
    w = lambda key: F.row_number().over(Window.partitionBy("shot_id").orderBy(key))
    links = c.tracks(spark, d).where("shot_id IS NOT NULL").select("track_id", F.concat_ws("#", "shot_id", w("track_id").cast("string")).alias("detection_id"))
    f = c.frames(spark, d).where("shot_id IS NOT NULL")
    half = F.lit(0.5)
    found = f.select(F.concat_ws("#", "shot_id", w("frame_id").cast("string")).alias("detection_id"), "frame_id", half.alias("confidence"), *[half.alias(x) for x in ("x_min", "x_max", "y_min", "y_max")])
    return joins.observations_from_detections(links, found, f).select("track_id", "frame_idx", "timestamp_ms")


# search


def _documents(spark: SparkSession, d: str) -> DataFrame:
    v = search.video_documents(c.videos(spark, d))
    o = search.ocr_documents(c.ocr(spark, d), c.frames(spark, d))
    t = search.transcript_documents(_transcripts(spark, d))
    k = search.caption_documents(_captions(spark, d, every=True), c.frames(spark, d), c.shots(spark, d), c.clips(spark, d))
    return search.all_documents(v, o, t, k)


def _transcripts(spark: SparkSession, d: str) -> DataFrame:
    """The transcript rows of documents; the table has no times for them."""
    none = F.lit(None).cast("bigint")
    return table(spark, d, "documents").where("source = 'transcript'").select(F.col("doc_id").cast("string").alias("segment_id"), "video_id", "text", F.col("lang").alias("language"), none.alias("start_ms"), none.alias("end_ms"))


@_query(
    f"""WITH x AS (SELECT video_id, list_filter([nullif(trim(title), ''), nullif(trim(description), ''), nullif(array_to_string(list_filter(list_transform(keywords, lambda k: trim(k)), lambda k: k <> ''), ' '), '')], lambda s: s IS NOT NULL) AS p FROM {c.VIDEOS})
    SELECT 'video_metadata:' || video_id || ':v1' AS doc_id, video_id, array_to_string(p, ' ') AS content FROM x WHERE len(p) > 0"""
)
def doc_build_metadata(spark: SparkSession, d: str) -> DataFrame:
    return search.video_documents(c.videos(spark, d)).select("doc_id", "video_id", "content")


@_query(
    f"""WITH v AS (SELECT 'video_metadata' AS source_type, video_id AS id FROM {c.VIDEOS} WHERE trim(title) <> '' OR trim(description) <> '' OR len(list_filter(keywords, lambda k: trim(k) <> '')) > 0),
    o AS (SELECT DISTINCT 'ocr_frame' AS source_type, o.frame_id AS id FROM {c.OCR} o JOIN {c.FRAMES} f ON o.frame_id = f.frame_id WHERE trim(o.text) <> '' AND x_min BETWEEN 0 AND 1 AND x_max BETWEEN 0 AND 1 AND y_min BETWEEN 0 AND 1 AND y_max BETWEEN 0 AND 1 AND x_min <= x_max AND y_min <= y_max),
    t AS (SELECT 'transcript' AS source_type, CAST(doc_id AS VARCHAR) AS id FROM documents WHERE source = 'transcript' AND trim(text) <> ''),
    k AS (SELECT 'caption' AS source_type, 'f:' || o.frame_id || ':' || o.n AS id FROM {c.OCR} o JOIN {c.FRAMES} f ON o.frame_id = f.frame_id WHERE trim(o.text) <> '' AND f.video_id IS NOT NULL
      UNION ALL SELECT 'caption', 'c:' || k.clip_id FROM {c.CLIPS} k JOIN {c.SHOTS} s ON k.shot_id = s.shot_id WHERE trim(k.sampling_strategy) <> '' AND s.video_id IS NOT NULL UNION ALL SELECT 'caption', 's:' || shot_id FROM {c.SHOTS} WHERE trim(video_id) <> '')
    SELECT source_type, count(*) AS docs, count(DISTINCT id) AS ids FROM (FROM v UNION ALL FROM o UNION ALL FROM t UNION ALL FROM k) GROUP BY 1"""
)
def doc_counts(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).groupBy("source_type").agg(F.count("*").alias("docs"), F.count_distinct("doc_id").alias("ids"))


_TOKENS = r"regexp_extract_all(lower(strip_accents(replace(replace(text, 'đ', 'd'), 'Đ', 'D'))), '[\p{L}\p{N}]+')"
_POST = f"""WITH w AS (SELECT doc_id, {_TOKENS} AS w FROM documents WHERE text IS NOT NULL), t AS (SELECT doc_id, len(w) AS fl, unnest(w) AS term FROM w),
  p AS (SELECT doc_id, any_value(fl) AS fl, term, count(*) AS tf FROM t GROUP BY doc_id, term), st AS (SELECT count(*) AS docs, avg(fl) AS al FROM (SELECT DISTINCT doc_id, fl FROM p))"""


def _index(spark: SparkSession, d: str) -> DataFrame:
    return search.postings(table(spark, d, "documents").select("doc_id", F.col("text").alias("content")), ("content",))


@_query(f"{_POST} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM p GROUP BY 1 HAVING count(*) >= 20")
def postings_stats(spark: SparkSession, d: str) -> DataFrame:
    return _index(spark, d).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf")).where("df >= 20")


@_query(f"{_POST} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM p GROUP BY 1")
def postings_all_terms(spark: SparkSession, d: str) -> DataFrame:
    """As postings_stats, rare terms too."""
    return _index(spark, d).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


@_query(
    f"""{_POST}, h AS (SELECT doc_id, fl, term, tf, count(*) OVER (PARTITION BY term) AS df FROM p WHERE term IN ('thuyen', 'bicycle', 'market'))
    SELECT doc_id, round(sum(ln(1 + (docs - df + CAST(0.5 AS DOUBLE)) / (df + CAST(0.5 AS DOUBLE))) * tf * CAST(2.2 AS DOUBLE) / (tf + CAST(1.2 AS DOUBLE) * (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * fl / al))), 6) AS score FROM h, st GROUP BY 1 ORDER BY sum(ln(1 + (docs - df + CAST(0.5 AS DOUBLE)) / (df + CAST(0.5 AS DOUBLE))) * tf * CAST(2.2 AS DOUBLE) / (tf + CAST(1.2 AS DOUBLE) * (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * fl / al))) DESC, doc_id LIMIT 50"""
)
def bm25_search(spark: SparkSession, d: str) -> DataFrame:
    return search.bm25(_index(spark, d), ["thuyen", "bicycle", "market"], {"content": 1.0}).orderBy(F.desc("score"), "doc_id").limit(50).withColumn("score", F.round("score", 6))


@_query(f"WITH w AS (SELECT doc_id, {_TOKENS} AS w FROM documents WHERE text IS NOT NULL), n AS (SELECT doc_id, len(list_filter(range(1, len(w) - 1), lambda i: w[i] = 'khan' AND w[i + 1] = 'gia' AND w[i + 2] = 'vo')) AS hits FROM w) SELECT doc_id, hits FROM n WHERE hits > 0")
def phrase_match(spark: SparkSession, d: str) -> DataFrame:
    return search.phrase_matches(_index(spark, d), "khan gia vo")


@_query(f"{_POST} SELECT DISTINCT term, levenshtein(term, 'bicycla') AS distance FROM p WHERE levenshtein(term, 'bicycla') <= 2")
def fuzzy_match(spark: SparkSession, d: str) -> DataFrame:
    return search.fuzzy_terms(_index(spark, d), "bicycla").select("term", F.col("distance").cast("long").alias("distance"))


_FOLD = "coalesce(strip_accents(replace(lower({0}), 'đ', 'd')), '')"
_SCORE = " + ".join(f"CASE WHEN contains({f}, '{s}') THEN {w} ELSE 0 END" for s, cw, tw in (("cau tre", 10, 15), ("cau", 2, 3), ("tre", 2, 3)) for f, w in ((_FOLD.format("description"), cw), (_FOLD.format("title"), tw)))
_SCORED = f"(SELECT video_id, title, {_SCORE} AS score FROM {c.VIDEOS})"


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return c.videos(spark, d).select("video_id", "title", search.simple_score("cau tre", F.col("title"), F.col("description")).alias("score"))


@_query(f"SELECT video_id, score FROM {_SCORED} WHERE score > 0")
def search_scored(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where("score > 0").select("video_id", "score")


@_query(f"SELECT video_id, score FROM {_SCORED} WHERE score > 0 ORDER BY score DESC, video_id LIMIT 10 OFFSET 10")
def search_paged(spark: SparkSession, d: str) -> DataFrame:
    return search.paged(_scored(spark, d).where("score > 0").select("video_id", "score"), search.SearchQuery("cau tre", top_k=10, page=2), "video_id")


@_query(f"SELECT video_id, title FROM {_SCORED} WHERE score > 0 ORDER BY title DESC NULLS LAST, video_id LIMIT 10")
def search_sorted_field(spark: SparkSession, d: str) -> DataFrame:
    return search.paged(_scored(spark, d).where("score > 0"), search.SearchQuery("cau tre", top_k=10, sort_by="-title"), "video_id").select("video_id", "title")


@_query(f"SELECT shot_id FROM {c.SHOTS} WHERE start_ms < 90000 AND end_ms > 30000")
def search_temporal_filter(spark: SparkSession, d: str) -> DataFrame:
    s = c.shots(spark, d).withColumn("timestamp_ms", F.lit(None).cast("long"))
    return s.where(validate.temporal_match(30_000, 90_000)).select("shot_id")


@_query("SELECT DISTINCT frame_id FROM ocr WHERE trim(text) <> '' AND x_min BETWEEN 0 AND 1 AND x_max BETWEEN 0 AND 1 AND y_min BETWEEN 0 AND 1 AND y_max <= 0.25 AND x_min <= x_max AND y_min <= y_max AND y_max >= 0")
def search_region_filter(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.ocr_bodies(c.ocr(spark, d)).where(validate.region_match(F.col("regions"), "top")).select("frame_id")


@_query()
def full_search(spark: SparkSession, d: str) -> DataFrame:
    docs = stored(_documents(spark, d), "documents")  # else every clause builds all documents again
    index = stored(search.postings(docs), "postings")
    hits = search.search(docs, search.SearchQuery("cây cầu tre", top_k=50, use_fuzzy=True, use_highlight=True), index)
    return hits.select("doc_id", F.round("score", 6).alias("score"), "highlight")


_FOLDED = r"regexp_extract_all(lower(strip_accents(replace(replace({0}, 'đ', 'd'), 'Đ', 'D'))), '[\p{{L}}\p{{N}}]+')"
_ALL_DOCUMENTS = f"""v AS (SELECT 'video_metadata:' || video_id || ':v1' AS doc_id, nullif(trim(title), '') AS title, nullif(trim(description), '') AS description, nullif(array_to_string(list_filter(list_transform(keywords, lambda k: trim(k)), lambda k: k <> ''), ' '), '') AS keywords FROM {c.VIDEOS}),
    vd AS (SELECT doc_id, title, keywords, description, array_to_string(list_filter([title, description, keywords], lambda s: s IS NOT NULL), ' ') AS content, CAST([] AS VARCHAR[]) AS regions FROM v),
    o AS (SELECT 'ocr_frame:' || o.frame_id || ':v1', NULL, NULL, NULL, string_agg(trim(text), chr(10) ORDER BY o.n), list(trim(text)) FROM {c.OCR} o JOIN {c.FRAMES} f ON o.frame_id = f.frame_id WHERE trim(text) <> '' AND x_min BETWEEN 0 AND 1 AND x_max BETWEEN 0 AND 1 AND y_min BETWEEN 0 AND 1 AND y_max BETWEEN 0 AND 1 AND x_min <= x_max AND y_min <= y_max GROUP BY 1),
    t AS (SELECT 'transcript:' || doc_id || ':v1', NULL, NULL, NULL, trim(text), CAST([] AS VARCHAR[]) FROM documents WHERE source = 'transcript' AND trim(text) <> ''),
    k AS (SELECT 'caption:f:' || o.frame_id || ':' || o.n || ':v1', NULL, NULL, NULL, trim(o.text), CAST([] AS VARCHAR[]) FROM {c.OCR} o JOIN {c.FRAMES} f ON o.frame_id = f.frame_id WHERE trim(o.text) <> '' AND f.video_id IS NOT NULL
      UNION ALL SELECT 'caption:c:' || k.clip_id || ':v1', NULL, NULL, NULL, trim(k.sampling_strategy), CAST([] AS VARCHAR[]) FROM {c.CLIPS} k JOIN {c.SHOTS} s ON k.shot_id = s.shot_id WHERE trim(k.sampling_strategy) <> '' AND s.video_id IS NOT NULL
      UNION ALL SELECT 'caption:s:' || shot_id || ':v1', NULL, NULL, NULL, trim(video_id), CAST([] AS VARCHAR[]) FROM {c.SHOTS} WHERE trim(video_id) <> ''),
    docs AS (SELECT doc_id, {_FOLDED.format("coalesce(title, '')")} AS ti, {_FOLDED.format("coalesce(keywords, '')")} AS ke, {_FOLDED.format("coalesce(description, '')")} AS de, {_FOLDED.format("content")} AS co, regions FROM (FROM vd WHERE content <> '' UNION ALL FROM o UNION ALL FROM t UNION ALL FROM k))"""


@_query(
    f"""WITH {_ALL_DOCUMENTS}, m AS (SELECT doc_id, list_has_any(list_concat(ti, ke, de, co), ['cay', 'cau', 'tre']) AS w, len(list_filter(range(1, len(co) - 1), lambda i: co[i] = 'cay' AND co[i + 1] = 'cau' AND co[i + 2] = 'tre')) AS p,
      len(list_filter(regions, lambda r: contains(' ' || array_to_string({_FOLDED.format("r")}, ' ') || ' ', ' cay cau tre '))) AS r, len(list_filter(list_transform(co, lambda x: regexp_replace(x, '[^\x00-\x7f]', '#', 'g')), lambda x: levenshtein(x, 'cay') <= 1 OR levenshtein(x, 'cau') <= 1 OR levenshtein(x, 'tre') <= 1)) > 0 AS z FROM docs)
    SELECT doc_id, w AS has_word, CAST(p AS INTEGER) AS phrases, CAST(r AS INTEGER) AS regions, z AS near FROM m WHERE w OR p > 0 OR r > 0 OR z"""
)
def search_matches(spark: SparkSession, d: str) -> DataFrame:
    """Every hit of a search over all four sources, with the clauses that match."""
    docs = stored(_documents(spark, d), "documents")
    index = stored(search.postings(docs), "postings")
    q = search.SearchQuery("cây cầu tre", use_fuzzy=True, use_highlight=True)
    hits = search.matches(docs, q, index).select("doc_id", F.coalesce(F.size("region_highlights"), F.lit(0)).alias("regions"))
    words = index.where(F.col("term").isin("cay", "cau", "tre")).select("doc_id").distinct().withColumn("has_word", F.lit(True))
    near = index.where("field = 'content'").where(" OR ".join(f"levenshtein(term, '{w}') <= 1" for w in ("cay", "cau", "tre"))).select("doc_id").distinct().withColumn("near", F.lit(True))
    phrases = search.phrase_matches(index, "cay cau tre").select("doc_id", F.col("hits").cast("int").alias("phrases"))
    joined = hits.join(words, "doc_id", "left").join(near, "doc_id", "left").join(phrases, "doc_id", "left")
    return joined.select("doc_id", F.coalesce("has_word", F.lit(False)).alias("has_word"), F.coalesce("phrases", F.lit(0)).alias("phrases"), F.greatest("regions", F.lit(0)).alias("regions"), F.coalesce("near", F.lit(False)).alias("near"))


# greedy selections


@_query()
def time_keyframes(spark: SparkSession, d: str) -> DataFrame:
    return selectors.select_time_keyframes(c.sound_shots(spark, d), c.frames(spark, d))


@_query()
def sparse_candidates(spark: SparkSession, d: str) -> DataFrame:
    s = c.sound_shots(spark, d).withColumn("fps", F.lit(25.0))
    return selectors.sparse_candidates(s, c.frames(spark, d).where("shot_id IS NOT NULL AND frame_idx IS NOT NULL").select("shot_id", "frame_idx"))


def _shot_candidates(spark: SparkSession, d: str) -> DataFrame:
    return c.candidates(spark, d).where("shot_id IS NOT NULL AND frame_idx IS NOT NULL").select("candidate_id", "video_id", "shot_id", "frame_idx", "clip_vector", F.coalesce("center_distance", F.lit(0.0)).alias("center_distance"))


@_query()
def facility_select(spark: SparkSession, d: str) -> DataFrame:
    return selectors.facility_representatives(_shot_candidates(spark, d), key="shot_id", frame="frame_idx", vector="clip_vector").select("shot_id", "candidate_id")


@_query()
def redundancy_dedup(spark: SparkSession, d: str) -> DataFrame:
    return selectors.redundancy_dedup(_shot_candidates(spark, d)).select("shot_id", "candidate_id")


@_query()
def cross_shot_dedup(spark: SparkSession, d: str) -> DataFrame:
    s = c.sound_shots(spark, d).select("shot_id", "shot_index")
    return selectors.cross_shot_dedup(_shot_candidates(spark, d).where("video_id IS NOT NULL").join(s, "shot_id")).select("video_id", "candidate_id")


@_query()
def kmeans_representatives(spark: SparkSession, d: str) -> DataFrame:
    return selectors.cluster_representatives(_shot_candidates(spark, d), key="shot_id", frame="frame_idx", vector="clip_vector").select("shot_id", "candidate_id")


def _candidates_and_existing(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A fifth of the candidates stand for frames a shot has already."""
    k = _shot_candidates(spark, d)
    return k.where("candidate_id % 5 <> 0"), k.where("candidate_id % 5 = 0")


@_query()
def redundancy_with_existing(spark: SparkSession, d: str) -> DataFrame:
    new, have = _candidates_and_existing(spark, d)
    return selectors.redundancy_dedup(new, existing=have.select("shot_id", "frame_idx")).select("shot_id", "candidate_id")


@_query()
def hybrid_keyframes(spark: SparkSession, d: str) -> DataFrame:
    new, have = _candidates_and_existing(spark, d)
    return selectors.hybrid_keyframes(new, existing=have).select("shot_id", "candidate_id")


@_query()
def hybrid_status(spark: SparkSession, d: str) -> DataFrame:
    new, have = _candidates_and_existing(spark, d)
    return selectors.selection_status(c.sound_shots(spark, d), new, selectors.hybrid_keyframes(new, existing=have))


@_query()
def caption_times(spark: SparkSession, d: str) -> DataFrame:
    return selectors.caption_times(c.sound_shots(spark, d))


@_query()
def anchor_frames(spark: SparkSession, d: str) -> DataFrame:
    return selectors.anchor_frames(c.sound_shots(spark, d), c.frames(spark, d).where("shot_id IS NOT NULL").select("frame_id", "shot_id", "timestamp_ms", "source", "frame_idx"))


@_query()
def diverse_anchor_frames(spark: SparkSession, d: str) -> DataFrame:
    """Anchors and the most different further frames; the candidate at a frame lends its vector."""
    f = c.frames(spark, d).where("shot_id IS NOT NULL").select("frame_id", "shot_id", "timestamp_ms", "source", "frame_idx")
    k = _shot_candidates(spark, d).groupBy("shot_id").agg(F.min_by("clip_vector", "candidate_id").alias("vector"))
    return selectors.anchor_frames(c.sound_shots(spark, d), f, vectors=f.join(k, "shot_id").select("frame_id", "vector"))


@_query()
def caption_frames(spark: SparkSession, d: str) -> DataFrame:
    """Sharpness and brightness stand in for those of decoded frames."""
    k = _shot_candidates(spark, d).select("candidate_id", "shot_id", F.col("clip_vector").alias("vector"), F.bround(F.col("frame_idx") * 40).cast("long").alias("timestamp_ms"), (F.col("candidate_id") % 97).cast("double").alias("sharpness"), (F.col("candidate_id") % 255).cast("double").alias("brightness"))
    return selectors.caption_frames(k, c.sound_shots(spark, d)).select("shot_id", "candidate_id")


@_query()
def ocr_temporal_dedup(spark: SparkSession, d: str) -> DataFrame:
    o = c.ocr(spark, d).where("text IS NOT NULL AND x_min IS NOT NULL AND x_max IS NOT NULL AND y_min IS NOT NULL AND y_max IS NOT NULL")
    f = c.frames(spark, d).where("shot_id IS NOT NULL AND timestamp_ms IS NOT NULL").select("frame_id", "shot_id", "timestamp_ms")
    rows = o.join(f, "frame_id").select("frame_id", "n", "shot_id", "timestamp_ms", "text", "x_min", "y_min", "x_max", "y_max")
    return selectors.temporal_text_dedup(rows, key=["shot_id"], text="text", time="timestamp_ms", box=("x_min", "y_min", "x_max", "y_max"), order=["frame_id", "n"]).select("frame_id", "n", "shot_id")


@_query()
def hash_text_cache(spark: SparkSession, d: str) -> DataFrame:
    h = c.frames(spark, d).where("shot_id IS NOT NULL AND frame_idx IS NOT NULL").select("shot_id", "frame_id", (F.col("frame_idx") * 2654435761).bitwiseXOR(F.col("frame_idx")).alias("h"))
    return selectors.hash_cache(h, key=["shot_id"], order="frame_id", hash_col="h").select("frame_id", "reused_from")


@_query(
    f"""WITH k AS (SELECT shot_id, clip_id, start_ms, scale_type AS text FROM {c.SOUND_CLIPS} WHERE trim(scale_type) <> ''), a AS (SELECT shot_id, count(*) AS n, string_agg('- ' || text, chr(10) ORDER BY start_ms, clip_id) AS l, min(text) AS t FROM k GROUP BY 1)
    SELECT s.shot_id, CASE WHEN n IS NULL THEN 'none' WHEN n = 1 THEN 'reuse' ELSE 'summarize' END AS mode, CASE WHEN n = 1 THEN t ELSE l END AS text FROM {c.SHOTS} s LEFT JOIN a ON s.shot_id = a.shot_id"""
)
def shot_captions(spark: SparkSession, d: str) -> DataFrame:
    return selectors.shot_captions(c.shots(spark, d), c.sound_clips(spark, d).select("shot_id", "clip_id", "start_ms", F.col("scale_type").alias("text")))


# logs


@_query("SELECT shot_id, arg_max(end_ms, ingested_at) AS end_ms FROM shot WHERE end_ms IS NOT NULL GROUP BY 1")
def checkpoint_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return sinks.last_per_key(table(spark, d, "shot").where("end_ms IS NOT NULL").select("shot_id", "end_ms", "ingested_at"), "shot_id", "ingested_at").select("shot_id", "end_ms")


@_query()
def frame_detection_json(spark: SparkSession, d: str) -> DataFrame:
    return sinks.frame_json(c.ocr(spark, d).select("frame_id", "n", "text", "confidence"))


def queries() -> dict:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
