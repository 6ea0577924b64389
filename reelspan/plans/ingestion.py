"""Sources and sinks as queries: files are written from the tables to the shared folder, read back and compared."""

from __future__ import annotations

import io
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan import schemas
from reelspan.operators import search
from reelspan.plans import common as c
from reelspan.session import scratch_path, table
from reelspan.sources import readers, sinks

_Q: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str):  # type: ignore[no-untyped-def]
    def add(f):  # type: ignore[no-untyped-def]
        _Q[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return add


def _write_files(rows: DataFrame, root: str) -> str:
    """Write rows (path, body) as one file each below ``root``, on the executors."""
    local = root.removeprefix("file://").removeprefix("file:")

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, body in zip(b["path"], b["body"]):
                at = f"{local}/{path}"
                os.makedirs(os.path.dirname(at), exist_ok=True)
                with open(at, "wb") as f:
                    f.write(body if isinstance(body, bytes) else bytes(body))
            yield pd.DataFrame({"n": [len(b)]})

    os.makedirs(local, exist_ok=True)
    rows.select("path", F.col("body").cast("binary").alias("body")).mapInPandas(put, "n long").agg(F.sum("n")).collect()
    return root


# sources


@_query(f"SELECT video_id, title, left(description, 500) AS description, len(keywords) AS keywords, strftime(publish_date, '%Y-%m-%d') AS publish_date, duration_ms // 1000 * 1000 AS duration_ms FROM {c.VIDEOS} WHERE video_id IS NOT NULL")
def source_media_info(spark: SparkSession, d: str) -> DataFrame:
    v = c.videos(spark, d).where("video_id IS NOT NULL")
    made = F.to_json(F.struct("title", "description", "author", "channel_id", "channel_url", "watch_url", "thumbnail_url", "keywords", F.date_format("publish_date", "dd/MM/yyyy").alias("publish_date"), F.expr("duration_ms div 1000").alias("length")))
    root = _write_files(v.select(F.concat(F.url_encode("video_id"), F.lit(".json")).alias("path"), made.alias("body")), scratch_path(spark, "media-info"))
    return readers.media_info(spark, root).select("video_id", "title", "description", F.nullif(F.size("keywords"), F.lit(-1)).cast("long").alias("keywords"), F.date_format("publish_date", "yyyy-MM-dd").alias("publish_date"), "duration_ms")


@_query("SELECT DISTINCT video_id FROM frame WHERE video_id IS NOT NULL AND video_id NOT IN (SELECT video_id FROM video WHERE video_id IS NOT NULL)")
def source_new_videos(spark: SparkSession, d: str) -> DataFrame:
    return readers.new_videos(table(spark, d, "frame").where("video_id IS NOT NULL").select("video_id").distinct(), table(spark, d, "video"))


_MAPPED = f"(SELECT * FROM {c.FRAMES} WHERE source = 'official' AND n IS NOT NULL AND video_id IS NOT NULL AND pts_time IS NOT NULL AND frame_idx IS NOT NULL)"


@_query(f"SELECT video_id, n, pts_time, fps, frame_idx, CAST(round_even(pts_time * 1000, 0) AS BIGINT) AS timestamp_ms, 'official' AS source FROM {_MAPPED}")
def source_keyframe_map(spark: SparkSession, d: str) -> DataFrame:
    f = c.frames(spark, d).where("source = 'official' AND n IS NOT NULL AND video_id IS NOT NULL AND pts_time IS NOT NULL AND frame_idx IS NOT NULL")
    line = F.concat_ws(",", F.col("n").cast("string"), F.col("pts_time").cast("string"), F.coalesce(F.col("fps").cast("string"), F.lit("")), F.col("frame_idx").cast("string"))
    per = f.groupBy("video_id").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("rows"))
    body = F.concat(F.lit("﻿n,pts_time,fps,frame_idx\n"), "rows", F.lit("\n"))
    root = _write_files(per.select(F.concat(F.url_encode("video_id"), F.lit(".csv")).alias("path"), body.alias("body")), scratch_path(spark, "maps"))
    return readers.official_frames(readers.keyframe_map(spark, root)).select("video_id", "n", "pts_time", "fps", "frame_idx", "timestamp_ms", "source")


_BOXED = "text IS NOT NULL AND confidence IS NOT NULL AND x_min IS NOT NULL AND x_max IS NOT NULL AND y_min IS NOT NULL AND y_max IS NOT NULL AND language IS NOT NULL"
_OBJECTS = f"(SELECT f.video_id, f.n AS keyframe_index, o.* EXCLUDE (frame_id) FROM {c.OCR} o JOIN {c.FRAMES} f ON o.frame_id = f.frame_id WHERE f.source = 'official' AND f.n IS NOT NULL AND f.video_id IS NOT NULL AND {_BOXED})"


def _objects(spark: SparkSession, d: str) -> DataFrame:
    o = c.ocr(spark, d).where(_BOXED).withColumnRenamed("n", "k")
    f = c.frames(spark, d).where("source = 'official' AND n IS NOT NULL AND video_id IS NOT NULL").select("frame_id", "video_id", F.col("n").alias("keyframe_index"))
    return o.join(f, "frame_id")


@_query(f"SELECT video_id, keyframe_index, CAST(n AS INTEGER) AS class_label, text AS class_name, language AS class_mid, confidence, y_min, x_max FROM {_OBJECTS} WHERE confidence >= 0.25")
def source_organizer_objects(spark: SparkSession, d: str) -> DataFrame:
    s = lambda x: F.col(x).cast("string")
    rows = _objects(spark, d).groupBy("video_id", "keyframe_index").agg(F.array_sort(F.collect_list(F.struct("k", *[s(x).alias(x) for x in ("confidence", "y_min", "x_min", "y_max", "x_max")], "language", "text"))).alias("a"))
    each = lambda f: F.transform("a", f)
    body = F.to_json(
        F.struct(
            each(lambda x: x["confidence"]).alias("detection_scores"), each(lambda x: x["language"]).alias("detection_class_names"), each(lambda x: x["text"]).alias("detection_class_entities"),
            each(lambda x: F.array(x["y_min"], x["x_min"], x["y_max"], x["x_max"])).alias("detection_boxes"), each(lambda x: x["k"].cast("string")).alias("detection_class_labels"),
        )
    )
    path = F.concat(F.url_encode("video_id"), F.lit("/"), F.lpad(F.col("keyframe_index").cast("string"), 4, "0"), F.lit(".json"))
    root = _write_files(rows.select(path.alias("path"), body.alias("body")), scratch_path(spark, "objects"))
    got = readers.organizer_objects(spark, f"{root}/*")
    return got.select("video_id", "keyframe_index", "class_label", "class_name", "class_mid", "confidence", F.col("bbox.y_min").alias("y_min"), F.col("bbox.x_max").alias("x_max"))


@_query(f"SELECT video_id, keyframe_index, text AS class_name, confidence, x_min FROM {_OBJECTS}")
def source_detection_lines(spark: SparkSession, d: str) -> DataFrame:
    box = F.struct("y_min", "x_min", "y_max", "x_max").alias("bbox")
    one = F.to_json(F.struct("video_id", "keyframe_index", "confidence", F.col("language").alias("class_mid"), F.col("text").alias("class_name"), F.col("k").cast("int").alias("class_label"), box))
    per = _objects(spark, d).groupBy("video_id", "keyframe_index").agg(F.array_join(F.array_sort(F.collect_list(one)), "\n\n").alias("body"))
    path = F.concat(F.url_encode("video_id"), F.lit("/"), F.col("keyframe_index").cast("string"), F.lit(".jsonl"))
    root = _write_files(per.select(path.alias("path"), "body"), scratch_path(spark, "detections"))
    return readers.detection_lines(spark, f"{root}/*").select("video_id", "keyframe_index", "class_name", "confidence", F.col("bbox.x_min").alias("x_min"))


@_query("SELECT CAST(i AS INTEGER) AS label, '/m/' || i AS class_id, 'class ' || i AS class_name FROM range(1, 602) t(i)")
def source_class_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.range(1, 602).select(F.col("id").cast("int").alias("label"), F.concat(F.lit("/m/"), F.col("id").cast("string")).alias("class_id"), F.concat(F.lit("class "), F.col("id").cast("string")).alias("class_name"))
    path = scratch_path(spark, "classes")
    rows.write.option("header", True).csv(path)
    return readers.class_vocabulary(spark, path)


@_query("SELECT CAST(label AS VARCHAR) AS video_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos, len(embedding) AS dim, CAST(embedding[1] AS DOUBLE) AS first FROM embeddings WHERE label IS NOT NULL")
def source_npy_vectors(spark: SparkSession, d: str) -> DataFrame:
    """One matrix file per label, rows in order of vec_id, read back row by row."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        np.save(out, np.stack(pdf.sort_values("vec_id")["embedding"].to_numpy()).astype(np.float32))
        return pd.DataFrame({"path": [f"{pdf['label'].iloc[0]}.npy"], "body": [out.getvalue()]})

    files = table(spark, d, "embeddings").where("label IS NOT NULL").select("label", "vec_id", "embedding").groupBy("label").applyInPandas(pack, "path string, body binary")
    root = _write_files(files, scratch_path(spark, "npy"))
    return readers.npy_vectors(spark, root).select("video_id", "pos", F.size("vector").cast("long").alias("dim"), F.col("vector")[0].cast("double").alias("first"))


@_query("SELECT f AS format, s_suppkey, s_name, s_acctbal FROM supplier, (VALUES ('csv'), ('jsonl'), ('parquet')) v(f)")
def source_any_table(spark: SparkSession, d: str) -> DataFrame:
    """The same table in three formats, read with one schema."""
    rows = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    root, kinds = scratch_path(spark, "tables"), ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    rows.write.option("header", True).csv(f"{root}/a.csv")
    rows.write.json(f"{root}/a.jsonl")
    rows.write.parquet(f"{root}/a.parquet")
    parts = [readers.any_table(spark, f"{root}/a.{f}", kinds).withColumn("format", F.lit(f)) for f in ("csv", "jsonl", "parquet")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_query(f"SELECT video_id, watch_url AS video_url FROM {c.VIDEOS} WHERE watch_url LIKE 'http%' AND NOT regexp_matches(watch_url, '[\\s,]') AND NOT regexp_matches(video_id, '[\\s,]') AND video_id <> ''")
def source_video_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Lines of id and address with a tab, a comma or blanks between."""
    v = c.videos(spark, d).where(r"watch_url LIKE 'http%' AND NOT watch_url RLIKE '[\\s,]' AND NOT video_id RLIKE '[\\s,]' AND video_id <> ''")
    between = F.element_at(F.array(*map(F.lit, ("\t", ",", ", ", "   "))), F.pmod(F.hash("video_id"), F.lit(4)) + 1)
    path = scratch_path(spark, "manifest")
    v.select(F.concat("video_id", between, "watch_url").alias("value")).write.text(path)
    return readers.video_manifest(spark, path)


@_query(f"SELECT shot_id FROM {c.SHOTS} ORDER BY video_id NULLS FIRST, shot_index NULLS FIRST, shot_id LIMIT 150 OFFSET 50")
def source_row_slice(spark: SparkSession, d: str) -> DataFrame:
    s = c.shots(spark, d).select("shot_id", "video_id", "shot_index")
    return readers.row_slice(s, 50, 200, "video_id", "shot_index", "shot_id").select("shot_id")


@_query(f"SELECT shot_id, video_id FROM {c.SHOTS} WHERE video_id IN (SELECT DISTINCT video_id FROM {c.SHOTS} WHERE video_id IS NOT NULL ORDER BY 1 LIMIT 20 OFFSET 10)")
def source_video_slice(spark: SparkSession, d: str) -> DataFrame:
    return readers.video_slice(c.shots(spark, d).where("video_id IS NOT NULL").select("shot_id", "video_id"), 10, 30)


def _artifact_rows(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    bad = F.col("label") == 3
    return e.select(F.col("vec_id").cast("string").alias("entity_id"), F.when(bad, "failed").otherwise("success").alias("status"), F.when(bad, "decode").alias("failure_reason"), F.when(~bad, F.col("embedding")).alias("vector"))


@_query(
    """WITH s AS (SELECT CAST(vec_id AS VARCHAR) AS entity_id, label, embedding, row_number() OVER (ORDER BY CAST(vec_id AS VARCHAR)) - 1 AS r FROM embeddings WHERE label IS DISTINCT FROM 3)
    SELECT entity_id, 'success' AS status, CAST(r // 300 AS INTEGER) AS vector_shard, CAST(r % 300 AS INTEGER) AS vector_row, CAST(embedding[1] AS DOUBLE) AS first FROM s UNION ALL SELECT CAST(vec_id AS VARCHAR), 'failed', NULL, NULL, NULL FROM embeddings WHERE label = 3"""
)
def sink_embedding_artifact(spark: SparkSession, d: str) -> DataFrame:
    """Vectors and failures written as an artifact, verified by its digests and read back."""
    path = scratch_path(spark, "artifact")
    sinks.write_artifact(_artifact_rows(spark, d), path, rows_per_shard=300)
    sinks.verify_artifact(spark, path)
    good = readers.embedding_artifact(spark, path).select("entity_id", "status", "vector_shard", "vector_row", F.col("vector")[0].cast("double").alias("first"))
    bad = readers.embedding_artifact(spark, path, status="failed").select("entity_id", "status", "vector_shard", "vector_row", F.lit(None).cast("double").alias("first"))
    return good.unionByName(bad)


@_query(f"SELECT video_id || '.' || CASE WHEN shots % 3 = 0 THEN 'JPG' ELSE 'webp' END AS name, shots AS length FROM (SELECT video_id, count(*) AS shots FROM {c.SHOTS} WHERE regexp_full_match(video_id, '[A-Za-z0-9_]+') GROUP BY 1)")
def source_image_files(spark: SparkSession, d: str) -> DataFrame:
    """Pictures below a folder by suffix; other files are passed over."""
    per = c.shots(spark, d).where("video_id RLIKE '^[A-Za-z0-9_]+$'").groupBy("video_id").count()
    pictures = per.select(F.concat(F.lit("deep/"), "video_id", F.when(F.col("count") % 3 == 0, ".JPG").otherwise(".webp")).alias("path"), F.repeat(F.lit("x"), F.col("count").cast("int")).alias("body"))
    other = per.select(F.concat(F.lit("deep/"), "video_id", F.lit(".txt")).alias("path"), F.lit("x").alias("body"))
    root = _write_files(pictures.unionByName(other), scratch_path(spark, "pictures"))
    return readers.image_files(spark, root).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length")


@_query(f"SELECT video_id, coalesce(video_path, watch_url) AS media_path FROM {c.VIDEOS} WHERE video_id IS NOT NULL")
def source_media_paths(spark: SparkSession, d: str) -> DataFrame:
    v = c.videos(spark, d).where("video_id IS NOT NULL")
    first, second = (v.where(f"{x} IS NOT NULL").select("video_id", F.col(x).alias("media_path")) for x in ("video_path", "watch_url"))
    return readers.media_paths(v.select("video_id"), first, second)


# sinks

_ORPHAN_FREE = f"(SELECT * FROM {c.SHOTS} WHERE video_id IN (SELECT video_id FROM video WHERE video_id IS NOT NULL) AND shot_id IS NOT NULL)"


@_query(f"SELECT shot_id, video_id, start_ms FROM {_ORPHAN_FREE} UNION ALL SELECT 'refused: ' || x, NULL, NULL FROM (VALUES ('orphan'), ('repeated'), ('stored')) v(x)")
def sink_checked_insert(spark: SparkSession, d: str) -> DataFrame:
    """Shots inserted in two goes; rows with unknown videos, repeated keys or stored keys are refused as a whole."""
    s = c.shots(spark, d).where("shot_id IS NOT NULL").select("shot_id", "video_id", "start_ms")
    videos = table(spark, d, "video").where("video_id IS NOT NULL").select("video_id").distinct()
    good = s.join(videos, "video_id", "left_semi").select("shot_id", "video_id", "start_ms")
    path, refused = scratch_path(spark, "shots"), []
    even = F.pmod(F.xxhash64("shot_id"), F.lit(2)) == 0
    sinks.checked_insert(good.where(even), path, parents={"video_id": videos}, key=["shot_id"])
    sinks.checked_insert(good.where(~even), path, parents={"video_id": videos}, key=["shot_id"])
    one = spark.createDataFrame([("x", "no such video", 1)], "shot_id string, video_id string, start_ms long")
    known = videos.limit(1).select(F.lit("x").alias("shot_id"), "video_id", F.lit(1).cast("long").alias("start_ms"))
    for name, rows in (("orphan", one), ("repeated", known.unionByName(known)), ("stored", good.limit(1))):
        try:
            sinks.checked_insert(rows, path, parents={"video_id": videos}, key=["shot_id"])
        except ValueError:
            refused.append((f"refused: {name}", None, None))
    return spark.read.parquet(path).unionByName(spark.createDataFrame(refused, "shot_id string, video_id string, start_ms long"))


@_query(f"WITH t AS (SELECT track_id AS local_id, shot_id, 1000 + row_number() OVER (ORDER BY shot_id, track_id) AS track_id FROM {c.TRACKS} WHERE shot_id IS NOT NULL) SELECT t.track_id, t.shot_id, o.start_frame_idx AS frame_idx FROM t JOIN {c.TRACKS} o ON t.local_id = o.track_id")
def sink_tracks_with_observations(spark: SparkSession, d: str) -> DataFrame:
    """Tracks get new ids, their observations follow."""
    t = c.tracks(spark, d).where("shot_id IS NOT NULL")
    made, moved = sinks.tracks_with_observations(t.select(F.col("track_id").alias("local_id"), "shot_id"), t.select(F.col("track_id").alias("local_id"), F.col("start_frame_idx").alias("frame_idx")), 1000, "shot_id", "local_id")
    return moved.join(made.select("track_id", "shot_id"), "track_id").select("track_id", "shot_id", "frame_idx")


@_query("SELECT * FROM (SELECT DISTINCT class_id, 'class ' || class_id AS class_name FROM object_track WHERE class_id IS NOT NULL) UNION ALL SELECT * FROM (VALUES ('new', 'a new class'), ('conflict', 'refused'))")
def sink_insert_class(spark: SparkSession, d: str) -> DataFrame:
    """A new class is added once, a stored one is returned, another name for it is refused."""
    k = table(spark, d, "object_track").where("class_id IS NOT NULL").select("class_id", F.concat(F.lit("class "), "class_id").alias("class_name")).distinct()
    k = sinks.insert_class(spark, k, "new", "a new class")
    k = sinks.insert_class(spark, k, "new", "a new class")
    try:
        sinks.insert_class(spark, k, "new", "another name")
    except ValueError:
        return k.unionByName(spark.createDataFrame([("conflict", "refused")], "class_id string, class_name string"))
    return k


@_query("SELECT count(*) AS rows, sum(n) AS returned FROM (SELECT count(*) AS n FROM ocr WHERE n = 0 UNION ALL SELECT count(*) FROM ocr WHERE n <> 0) x JOIN (SELECT 1) ON true".replace("count(*) AS rows, sum(n)", "CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n) AS BIGINT)"))
def sink_append_unchecked(spark: SparkSession, d: str) -> DataFrame:
    o, path = table(spark, d, "ocr"), scratch_path(spark, "detections")
    n = sinks.append_unchecked(o.where("n = 0"), path) + sinks.append_unchecked(o.where("n <> 0"), path)
    return spark.read.parquet(path).agg(F.count("*").alias("rows"), F.lit(n).cast("long").alias("returned"))


@_query(f"SELECT video_id, coalesce(title, '') AS title, coalesce(CAST(duration_ms AS VARCHAR), '') AS duration_ms FROM {c.VIDEOS} WHERE video_id IS NOT NULL AND NOT regexp_matches(coalesce(title, ''), '[\\n\\r\"\\\\]')")
def sink_csv(spark: SparkSession, d: str) -> DataFrame:
    """CSV with empty fields for nulls, read back as text."""
    v = c.videos(spark, d).where(r"video_id IS NOT NULL AND NOT coalesce(title, '') RLIKE '[\\n\\r\"\\\\]'").select("video_id", "title", "duration_ms")
    path = scratch_path(spark, "csv")
    sinks.write_csv(v, path)
    return spark.read.option("header", True).option("emptyValue", "").option("nullValue", "\x00").schema("video_id string, title string, duration_ms string").csv(path).na.fill("")


@_query("SELECT vec_id, CAST(label AS BIGINT) + 1 AS label, 2 AS version, (SELECT max(vec_id) FROM embeddings) AS top_id FROM embeddings")
def sink_published_version(spark: SparkSession, d: str) -> DataFrame:
    """Two versions are published, the pointer names the second."""
    e, root = table(spark, d, "embeddings").select("vec_id", F.col("label").cast("long").alias("label")), scratch_path(spark, "versions")
    top = e.agg(F.max("vec_id")).first()[0]
    sinks.publish_version(e, root, "1", {"top_id": 0, "version": 1})
    sinks.publish_version(e.withColumn("label", F.col("label") + 1), root, "2", {"top_id": int(top), "version": 2})
    rows, counters = sinks.current_version(spark, root)
    return rows.select("vec_id", "label", F.lit(counters["version"]).cast("int").alias("version"), F.lit(counters["top_id"]).cast("long").alias("top_id"))


def _source_documents(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents")
    return t.select(F.col("doc_id").cast("string").alias("doc_id"), F.when(F.col("source").isin(*search.SOURCES), F.col("source")).otherwise("caption").alias("source_type"), F.col("text").alias("content"))


@_query(
    """SELECT CASE WHEN source IN ('video_metadata', 'ocr_frame', 'transcript', 'caption') THEN source ELSE 'caption' END AS source_type, count(*) AS docs, count(*) FILTER (WHERE doc_id % 3 = 0) AS renewed,
    (SELECT count(*) FROM documents WHERE text IS NOT NULL AND doc_id % 3 = 0) AS indexed, (SELECT count(*) FROM documents WHERE text IS NULL AND doc_id % 3 = 0) AS failed FROM documents WHERE text IS NOT NULL GROUP BY 1"""
)
def sink_index_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents are indexed, a third of them again with new content; one view per source is published over the result."""
    docs, root = _source_documents(spark, d), scratch_path(spark, "search")
    sinks.index_documents(docs, root, "1")
    again = docs.where(F.col("doc_id").cast("long") % 3 == 0).withColumn("content", F.concat(F.lit("renewed "), "content"))
    done = sinks.index_documents(again, root, "2")
    names = search.publish_views(sinks.current_version(spark, root)[0])
    if not search.health(spark, names):
        raise ValueError("a view is missing")
    parts = [spark.table(n) for n in names]
    per = search.all_documents(*parts).groupBy("source_type").agg(F.count("*").alias("docs"), F.count_if(F.col("content").startswith("renewed ")).alias("renewed"))
    return per.select("source_type", "docs", "renewed", F.lit(done["indexed"]).cast("long").alias("indexed"), F.lit(done["failed"]).cast("long").alias("failed"))


@_query(f"SELECT shot_id, video_id, shot_index, start_ms, end_ms, start_frame_idx, end_frame_idx FROM {c.SHOTS}")
def contract_shots(spark: SparkSession, d: str) -> DataFrame:
    """Shots in the columns and types of the contract."""
    return schemas.conform(c.shots(spark, d), schemas.SHOT)


def queries() -> dict:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
