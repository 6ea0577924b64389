"""Filters, boxes and text expressions over the media tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan.functions import geometry, text
from reelspan.operators import classes, lookups, validate
from reelspan.plans import common as c
from reelspan.session import table
from reelspan.sources import sinks

_Q: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str):  # type: ignore[no-untyped-def]
    def add(f):  # type: ignore[no-untyped-def]
        _Q[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return add


# filters

_NAMED = f"(SELECT track_id, class_id, 'Class_' || CAST(CAST(substr(class_id, 2) AS INTEGER) % 5 AS VARCHAR) AS class_name FROM {c.TRACKS} WHERE regexp_full_match(class_id, 'c[0-9]+'))"


@_query(
    f"""SELECT 'name' AS filter, track_id FROM {_NAMED} WHERE class_name = 'Class_1' UNION ALL SELECT 'either', track_id FROM {_NAMED} WHERE class_name = 'Class_2' OR class_id = 'c001'
    UNION ALL SELECT 'neither given', track_id FROM {_NAMED}"""
)
def class_filter_branches(spark: SparkSession, d: str) -> DataFrame:
    """Names in any spelling, ids or names, empty lists (nothing), no lists (everything)."""
    t = c.tracks(spark, d).where("class_id RLIKE '^c[0-9]+$'").select("track_id", "class_id", F.concat(F.lit("Class_"), (F.substring("class_id", 2, 20).cast("int") % 5).cast("string")).alias("class_name"))
    given = {"name": {"names": [" CLASS  1"]}, "either": {"names": ["class_2"], "class_ids": ["c001"]}, "empty": {"names": [], "class_ids": []}, "neither given": {}}
    parts = [validate.by_classes(t, **kw).select(F.lit(n).alias("filter"), "track_id") for n, kw in given.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@_query(f"SELECT frame_id FROM {c.FRAMES} WHERE timestamp_ms >= 10000 AND timestamp_ms < 20000")
def frames_in_range(spark: SparkSession, d: str) -> DataFrame:
    return c.frames(spark, d).where(validate.in_range(F.col("timestamp_ms"), F.lit(10_000), F.lit(20_000))).select("frame_id")


@_query(
    f"""WITH x AS (SELECT 's' || shot_id AS id, start_ms AS a, end_ms AS b, NULL AS t FROM {c.SHOTS} UNION ALL SELECT 'f' || frame_id, NULL, NULL, timestamp_ms FROM {c.FRAMES})
    SELECT 'both' AS bounds, id FROM x WHERE (a < 90000 AND b > 30000) OR (t >= 30000 AND t < 90000) UNION ALL SELECT 'from', id FROM x WHERE (a IS NOT NULL AND b > 100000) OR t >= 100000 UNION ALL SELECT 'to', id FROM x WHERE (b IS NOT NULL AND a < 5000) OR t < 5000"""
)
def temporal_filters(spark: SparkSession, d: str) -> DataFrame:
    """Intervals and points, with one bound or both."""
    none = F.lit(None).cast("long")
    s = c.shots(spark, d).select(F.concat(F.lit("s"), "shot_id").alias("id"), "start_ms", "end_ms", none.alias("timestamp_ms"))
    x = s.unionByName(c.frames(spark, d).select(F.concat(F.lit("f"), "frame_id").alias("id"), none.alias("start_ms"), none.alias("end_ms"), "timestamp_ms"))
    parts = [x.where(validate.temporal_match(a, b)).select(F.lit(n).alias("bounds"), "id") for n, a, b in (("both", 30_000, 90_000), ("from", 100_000, None), ("to", None, 5_000))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_REGIONS = {"top": "y_max <= 0.25", "header": "y_max <= 0.25", "bottom": "y_min >= 0.75", "footer": "y_min >= 0.75", "left": "x_max <= 0.35", "right": "x_min >= 0.65", "center": "x_min < 0.65 AND x_max > 0.35 AND y_min < 0.75 AND y_max > 0.25"}


@_query(" UNION ALL ".join(f"SELECT '{k}' AS region, frame_id FROM {c.OCR} WHERE {w} GROUP BY frame_id" for k, w in _REGIONS.items()))
def region_filters(spark: SparkSession, d: str) -> DataFrame:
    per = c.ocr(spark, d).groupBy("frame_id").agg(F.collect_list(F.struct("x_min", "x_max", "y_min", "y_max")).alias("r"))
    hit = F.filter(F.array(*[F.when(validate.region_match(F.col("r"), k), F.lit(k)) for k in _REGIONS]), lambda x: x.isNotNull())
    return per.select(F.explode(hit).alias("region"), "frame_id")


@_query(f"SELECT frame_id, n FROM {c.OCR} WHERE trim(text) <> '' AND confidence >= 0.45")
def text_gate(spark: SparkSession, d: str) -> DataFrame:
    return validate.text_gate(c.ocr(spark, d)).select("frame_id", "n")


@_query(f"SELECT frame_id, n FROM {c.OCR} WHERE n % 4 - 1 >= 0 AND x_max > x_min AND y_max > y_min")
def usable_boxes(spark: SparkSession, d: str) -> DataFrame:
    return validate.usable_boxes(c.ocr(spark, d).withColumn("internal_track_id", F.col("n") % 4 - 1)).select("frame_id", "n")


_MAPPINGS = "(SELECT vec_id AS faiss_id, label, CASE WHEN vec_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS index_version, CASE WHEN vec_id % 3 = 0 THEN 'a' ELSE 'b' END AS model_name FROM embeddings)"


@_query(f"SELECT faiss_id FROM {_MAPPINGS} WHERE label IN (1, 3) AND index_version = 'v1' AND model_name = 'b'")
def embedding_mappings(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("faiss_id"), "label", F.when(F.col("vec_id") % 2 == 0, "v1").otherwise("v2").alias("index_version"), F.when(F.col("vec_id") % 3 == 0, "a").otherwise("b").alias("model_name"))
    return lookups.mappings(e, "label", [1, 3], version="v1", model="b").unionByName(lookups.mappings(e, "label", [])).select("faiss_id")


@_query("SELECT vec_id, CASE WHEN label = 3 THEN 'failed' ELSE 'success' END AS status, CASE WHEN label = 3 THEN 'decode' END AS failure_reason FROM embeddings WHERE label IS NOT NULL")
def embedding_outcomes(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", "label")
    done, failed = e.where("label <> 3").select("vec_id"), e.where("label = 3").select("vec_id", F.lit("decode").alias("failure_reason"))
    return lookups.embedding_outcomes(done, failed).select("vec_id", "status", "failure_reason")


@_query(f"SELECT clip_id FROM {c.CLIPS} WHERE shot_id = (SELECT min(shot_id) FROM clip_record) UNION ALL SELECT 'frame ' || frame_id FROM {c.FRAMES} WHERE shot_id = (SELECT min(shot_id) FROM clip_record) UNION ALL SELECT 'video ' || video_id FROM {c.VIDEOS}")
def ordered_lookups(spark: SparkSession, d: str) -> DataFrame:
    """Clips and frames of one shot, and all videos."""
    shot = table(spark, d, "clip_record").agg(F.min("shot_id")).first()[0]
    k, f, v = lookups.clips_of_shot(c.clips(spark, d), shot), lookups.frames_of_shot(c.frames(spark, d), shot), lookups.video_list(c.videos(spark, d))
    return k.select("clip_id").unionByName(f.select(F.concat(F.lit("frame "), "frame_id").alias("clip_id"))).unionByName(v.select(F.concat(F.lit("video "), "video_id").alias("clip_id")))


@_query(f"SELECT track_id, n AS class_index, CASE WHEN n BETWEEN 0 AND 999 THEN 'c' || lpad(CAST(n AS VARCHAR), 3, '0') END AS class_id, CASE WHEN n BETWEEN 0 AND 4 THEN 'kind ' || n ELSE 'class_' || n END AS class_name FROM (SELECT track_id, CAST(track_id % 1100 AS INTEGER) - 50 AS n FROM {c.TRACKS})")
def class_index_names(spark: SparkSession, d: str) -> DataFrame:
    known = spark.createDataFrame([(i, f"kind {i}") for i in range(5)], "class_index int, class_name string")
    t = c.tracks(spark, d).select("track_id", (F.col("track_id") % 1100 - 50).cast("int").alias("class_index"))
    return classes.with_names(t, known).select("track_id", "class_index", classes.index_class_id(F.col("class_index")).alias("class_id"), "class_name")


@_query(f"SELECT 'shot' AS kind, shot_id AS id, start_ms, NULL AS class_id FROM {c.SHOTS} UNION ALL SELECT 'track', CAST(track_id AS VARCHAR), start_ms, class_id FROM {c.TRACKS}")
def record_stream(spark: SparkSession, d: str) -> DataFrame:
    """Shots and tracks as one stream of records of different columns."""
    s = c.shots(spark, d).select(F.lit("shot").alias("kind"), F.col("shot_id").alias("id"), "start_ms")
    t = c.tracks(spark, d).select(F.lit("track").alias("kind"), F.col("track_id").cast("string").alias("id"), "start_ms", "class_id")
    return classes.union_all(s, t)


# text


@_query(r"SELECT doc_id, trim(regexp_replace(text, '[\t\n\x0b\f\r\x{85}\p{Z}]+', ' ', 'g')) AS flat FROM documents WHERE text IS NOT NULL")
def collapsed_blanks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", text.collapse(F.col("text")).alias("flat"))


@_query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN text || chr(10) || 'more' ELSE NULL END AS answer FROM documents WHERE text IS NOT NULL AND NOT starts_with(text, '[')")
def chat_answers(spark: SparkSession, d: str) -> DataFrame:
    """The answer in chat completions: a text, text parts, or none."""
    t = table(spark, d, "documents").where("text IS NOT NULL AND NOT startswith(text, '[')").select("doc_id", "text")
    wrap = lambda content: F.to_json(F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices")))
    part = lambda kind, value: F.struct(F.lit(kind).alias("type"), value.alias("text"))
    parts = F.array(part("text", F.col("text")), part("image", F.lit(None).cast("string")), part("text", F.lit("more")))
    payload = F.when(F.col("doc_id") % 3 == 0, wrap(F.col("text"))).when(F.col("doc_id") % 3 == 1, wrap(parts)).otherwise(F.lit('{"choices": []}'))
    return t.select("doc_id", text.chat_content(payload).alias("answer"))


@_query(f"SELECT video_id, 'Title: ' || coalesce(title, '') || chr(10) || coalesce(array_to_string(list_transform(keywords, lambda k: '- ' || k), chr(10)), '') AS prompt FROM {c.VIDEOS}")
def filled_templates(spark: SparkSession, d: str) -> DataFrame:
    return c.videos(spark, d).select("video_id", text.fill_template("Title: {title}\n{list}", title=F.col("title"), list=text.bullet_list(F.col("keywords"))).alias("prompt"))


# boxes

_PX = "least(greatest({0} * {1}, 0), {1} - 1)"


@_query(
    f"""WITH o AS (SELECT frame_id, n, x_min * 1280 AS a, y_min * 720 AS b, x_max * 1280 AS c, y_max * 720 AS d FROM {c.OCR} WHERE x_max > x_min AND y_max > y_min), l AS (SELECT frame_id, n, least(greatest(a, 0), 1279) AS a, least(greatest(b, 0), 719) AS b, least(greatest(c, 0), 1279) AS c, least(greatest(d, 0), 719) AS d FROM o)
    SELECT frame_id, n, a < c AND b < d AS sound, round(CASE WHEN a < c AND b < d THEN a END, 6) AS left_x, round(CASE WHEN a < c AND b < d THEN d END, 6) AS low_y, round(CASE WHEN a < c AND b < d THEN least(greatest((a + c) / 2 + (c - (a + c) / 2) * 1.1, 0), 1279) END, 6) AS wide_x FROM l"""
)
def quadrilaterals(spark: SparkSession, d: str) -> DataFrame:
    """Corners of boxes in any order, put in order, clipped, and widened by a tenth."""
    point = lambda x, y: F.struct((F.col(x) * 1280).alias("x"), (F.col(y) * 720).alias("y"))
    w, h = F.lit(1280.0), F.lit(720.0)
    o = c.ocr(spark, d).where("x_max > x_min AND y_max > y_min")
    q = o.select("frame_id", "n", geometry.quadrilateral(F.array(point("x_max", "y_max"), point("x_min", "y_max"), point("x_max", "y_min"), point("x_min", "y_min")), w, h).alias("q"))
    wide = geometry.expanded(F.col("q"), 0.1, w, h)
    box = geometry.bounding_box(F.col("q"), w, h)
    return q.select("frame_id", "n", F.col("q").isNotNull().alias("sound"), F.round(box.x1 * 1280, 6).alias("left_x"), F.round(F.get("q", F.lit(2))["y"], 6).alias("low_y"), F.round(F.get(wide, F.lit(2))["x"], 6).alias("wide_x"))


@_query(
    f"""SELECT candidate_id, CAST(sum(CASE WHEN list_extract(v, CAST(i AS INTEGER)) > m AND i > 1 THEN CAST(1 AS HUGEINT) << CAST(64 - i AS INTEGER) WHEN list_extract(v, CAST(i AS INTEGER)) > m THEN -(CAST(1 AS HUGEINT) << 63) ELSE 0 END) AS BIGINT) AS hash
    FROM (SELECT candidate_id, CAST(clip_vector AS DOUBLE[]) AS v, list_reduce(CAST(clip_vector AS DOUBLE[]), lambda a, b: a + b) / 64 AS m FROM {c.CANDIDATES}), range(1, 65) t(i) GROUP BY 1"""
)
def average_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of 64 values hashed like pictures of 8 x 8 gray values."""
    return c.candidates(spark, d).select("candidate_id", geometry.average_hash(F.col("clip_vector").cast("array<double>")).alias("hash"))


@_query(f"SELECT frame_id, n, CAST(round_even(x_min * 1280, 0) AS BIGINT) AS px, round(x_min, 6) AS share FROM {c.OCR} WHERE x_min IS NOT NULL")
def pixels_and_shares(spark: SparkSession, d: str) -> DataFrame:
    """Whole pixels beside normalized values, as exports carry them."""
    return c.ocr(spark, d).where("x_min IS NOT NULL").select("frame_id", "n", F.bround(F.col("x_min") * 1280).cast("long").alias("px"), F.round("x_min", 6).alias("share"))


@_query(f"SELECT frame_id, count(*) AS detections, max(confidence) AS best, count(text) AS texts FROM {c.OCR} WHERE confidence IS NOT NULL GROUP BY 1")
def frame_json_parsed(spark: SparkSession, d: str) -> DataFrame:
    """The detections of a frame as one JSON text, parsed again; the first is the most confident."""
    made = sinks.frame_json(c.ocr(spark, d).where("confidence IS NOT NULL").select("frame_id", "n", "text", "confidence"))
    back = made.select(F.from_json("json", "frame_id string, detections array<struct<n:int,text:string,confidence:double>>").alias("j"))
    return back.select("j.frame_id", F.size("j.detections").cast("long").alias("detections"), F.col("j.detections")[0]["confidence"].alias("best"), F.size(F.filter("j.detections", lambda x: x["text"].isNotNull())).cast("long").alias("texts"))


def queries() -> dict:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
