"""Writers: checked inserts, upserts, artifacts, SQL text, versioned publication."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspan.functions import ids, text
from reelspan.operators import joins
from reelspan.session import stored


def _fs(spark: SparkSession, path: str):  # type: ignore[no-untyped-def]
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, p = _fs(spark, src)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(dst)):
        raise OSError(f"cannot rename {src} to {dst}")


def _put(spark: SparkSession, path: str, body: str) -> None:
    """Write a small file beside its place and put it there by one rename that replaces what was there."""
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    fs, p = _fs(spark, tmp)
    out = fs.create(p, True)
    try:
        out.write(bytearray(body.encode()))
    finally:
        out.close()
    jvm = spark._jvm
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    replacing = spark.sparkContext._gateway.new_array(kinds, 1)
    replacing[0] = kinds.OVERWRITE
    target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(p), target, replacing)


def _get(spark: SparkSession, path: str) -> str:
    return spark.read.option("wholetext", True).text(path).first()[0]


def checked_insert(rows: DataFrame, path: str, *, parents: dict[str, DataFrame], key: list[str]) -> None:
    """Append rows to a table after foreign keys and the primary key have been checked, all or nothing."""
    spark = rows.sparkSession
    for name, parent in parents.items():
        joins.require_parents(rows, parent, name)
    if joins.key_conflicts(rows, *key).limit(1).count():
        raise ValueError(f"repeated {key}")
    if exists(spark, path) and rows.join(spark.read.parquet(path).select(*key), key, "left_semi").limit(1).count():
        raise ValueError(f"{key} stored already")
    rows.write.mode("append").parquet(path)


def append_unchecked(rows: DataFrame, path: str) -> int:
    """Append rows without looking up parents or keys; returns their number."""
    kept = stored(rows, "append")
    kept.write.mode("append").parquet(path)
    return kept.count()


def tracks_with_observations(tracks: DataFrame, observations: DataFrame, top_id: int, *order: str) -> tuple[DataFrame, DataFrame]:
    """Tracks with new ids and their observations moved from local to new ids; an unknown local id raises."""
    joins.require_parents(observations, tracks, "local_id")
    made = ids.next_ids(tracks, top_id, *order, name="track_id")
    moved = observations.join(made.select("local_id", "track_id"), "local_id").drop("local_id")
    return made.drop("local_id"), moved


def upsert(incoming: DataFrame, existing: DataFrame, key: str, values: list[str], identity: list[str] = ()) -> tuple[DataFrame, DataFrame]:  # type: ignore[assignment]
    """(the table after the upsert, incoming rows with their status); an identity conflict raises."""
    status = joins.upsert_status(incoming, existing, key, values, identity)
    clash = [r[0] for r in status.where("status = 'conflict'").select(key).limit(10).collect()]
    if clash:
        raise ValueError(f"identity conflict: {clash}")
    after = existing.join(incoming.select(key), key, "left_anti").unionByName(incoming.select(*existing.columns))
    return after, status


def insert_class(spark: SparkSession, existing: DataFrame, class_id: str, class_name: str) -> DataFrame:
    """The classes with this one; the same id under another name raises."""
    found = existing.where(F.col("class_id") == class_id).limit(1).collect()
    if found:
        if found[0]["class_name"] != class_name:
            raise ValueError(f"{class_id} is {found[0]['class_name']}")
        return existing
    return existing.unionByName(spark.createDataFrame([(class_id, class_name)], "class_id string, class_name string"))


def write_artifact(rows: DataFrame, path: str, *, rows_per_shard: int = 25_000, metadata: dict[str, str] | None = None) -> dict:
    """Embedding rows (entity_id, status, vector, ...) as vectors, metadata and a manifest with checksums.

    Rows are numbered within shards, written beside the place and renamed there; an
    existing artifact is refused.
    """
    spark = rows.sparkSession
    if exists(spark, path):
        raise FileExistsError(path)
    tmp = path + ".tmp"
    good = ids.next_ids(rows.where("status = 'success'"), -1, "entity_id", name="_row")
    good = good.withColumn("vector_shard", F.floor(F.col("_row") / F.lit(rows_per_shard)).cast("int")).withColumn("vector_row", (F.col("_row") % rows_per_shard).cast("int")).drop("_row")
    failed = rows.where("status <> 'success'").withColumn("vector_shard", F.lit(None).cast("int")).withColumn("vector_row", F.lit(None).cast("int"))
    good.select("vector_shard", "vector_row", "vector").write.option("maxRecordsPerFile", rows_per_shard).parquet(f"{tmp}/vectors")
    good.drop("vector").unionByName(failed.drop("vector")).write.partitionBy("status").parquet(f"{tmp}/metadata")
    file_digests(spark, tmp).write.parquet(f"{tmp}/checksums")
    sums = _digest_of(spark.read.parquet(f"{tmp}/checksums"))
    counts = {r["status"]: r["count"] for r in spark.read.parquet(f"{tmp}/metadata").groupBy("status").count().collect()}
    manifest = {"counts": counts, "files": sums, "rows_per_shard": rows_per_shard, "metadata": metadata or {}}
    manifest["checksum"] = hashlib.sha256(json.dumps(manifest, sort_keys=True).encode()).hexdigest()
    _put(spark, f"{tmp}/manifest.json", json.dumps(manifest))
    _rename(spark, tmp, path)
    return manifest


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(file, sha256) of the vector and metadata files of an artifact, hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load([f"{path}/vectors", f"{path}/metadata"])
    return files.select(F.regexp_extract("path", r"((?:vectors|metadata)/[^:]*)\z", 1).alias("file"), F.sha2("content", 256).alias("sha256"))


def _digest_of(digests: DataFrame) -> dict[str, str | int]:
    """Number of files and one digest over all of theirs."""
    row = digests.agg(F.count("*").alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws(" ", "file", "sha256"))), "\n").cast("binary"), 256).alias("d")).first()
    return {"number": row["n"], "sha256": row["d"]}


def verify_artifact(spark: SparkSession, path: str) -> dict:
    """The manifest of an artifact whose files and manifest carry the digests written with it; else raises."""
    manifest = json.loads(_get(spark, f"{path}/manifest.json"))
    body = {k: v for k, v in manifest.items() if k != "checksum"}
    if hashlib.sha256(json.dumps(body, sort_keys=True).encode()).hexdigest() != manifest["checksum"] or _digest_of(file_digests(spark, path)) != manifest["files"]:
        raise ValueError(f"{path} is not as it was written")
    return manifest


def insert_statements(rows: DataFrame, table: str, columns: dict[str, str], *, conflict: str = "", keep: list[str] = ()) -> DataFrame:  # type: ignore[assignment]
    """(keep, sql): one INSERT per row; columns are name -> string, number or float."""
    values = F.concat_ws(", ", *[text.sql_literal(F.col(c), kind) for c, kind in columns.items()])
    tail = f" ON CONFLICT {conflict}" if conflict else ""
    return rows.select(*keep, F.concat(F.lit(f"INSERT INTO {table} ({', '.join(columns)}) VALUES ("), values, F.lit(f"){tail};")).alias("sql"))


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header; null becomes an empty field."""
    flat = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns])
    flat.write.option("header", True).option("emptyValue", "").csv(path)


def image_url(base: Column, path: Column) -> Column:
    return text.url_join(base, path)


def last_per_key(log: DataFrame, key: str, seq: str) -> DataFrame:
    """An append-only log with the last row of each key."""
    others = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*others), seq).alias("_x")).select(key, "_x.*")


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def publish_version(rows: DataFrame, root: str, version: str, counters: dict[str, int] | None = None) -> None:
    """Write a version beside the others and point `current` at it by one rename."""
    spark = rows.sparkSession
    target = f"{root}/versions/{version}"
    if exists(spark, target):
        raise FileExistsError(target)
    rows.write.parquet(target)
    _put(spark, f"{root}/current.json", json.dumps({"version": version, "counters": counters or {}}))


def publish_changes(batch: DataFrame, root: str, version: str, *, key: str, order: str, buckets: int = 64) -> None:
    """A version in which the latest row per key wins; only the buckets the batch touches are written again.

    A key belongs to a bucket by its hash; the pointer names the folder of each bucket.
    """
    spark = batch.sparkSession
    target = f"{root}/versions/{version}"
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    new = stored(batch, "changes")
    parts = json.loads(_get(spark, f"{root}/current.json")).get("parts", {}) if exists(spark, f"{root}/current.json") else {}
    touched = [str(r["_b"]) for r in new.select(bucket.alias("_b")).distinct().collect()]  # at most ``buckets``
    before = [parts[b] for b in touched if b in parts]
    rows = new.unionByName(spark.read.schema(new.schema).parquet(*before)) if before else new
    after = last_per_key(rows, key, order).select(*new.columns).withColumn("_b", bucket)
    after.repartition("_b").write.partitionBy("_b").parquet(target)
    parts |= {b: f"{target}/_b={b}" for b in touched}
    _put(spark, f"{root}/current.json", json.dumps({"version": version, "counters": {}, "parts": parts, "schema": new.schema.json()}))


def current_version(spark: SparkSession, root: str) -> tuple[DataFrame, dict[str, int]]:
    """The rows the pointer names, and the counters published with them."""
    at = json.loads(_get(spark, f"{root}/current.json"))
    if "parts" in at:
        schema = T.StructType.fromJson(json.loads(at["schema"]))
        paths = sorted(at["parts"].values())
        return (spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)), at["counters"]
    return spark.read.parquet(f"{root}/versions/{at['version']}"), at["counters"]


def index_documents(documents: DataFrame, root: str, version: str) -> dict[str, int]:
    """Publish a version in which these documents replace those of the same doc_id.

    A doc_id that stands on several rows raises; rows without doc_id or content fail.
    """
    spark = documents.sparkSession
    ok = F.col("doc_id").isNotNull() & (F.trim("doc_id") != "") & F.col("content").isNotNull()
    marked = stored(documents.withColumn("_ok", F.coalesce(ok, F.lit(False))), "to-index")
    good = marked.where("_ok").drop("_ok")
    if joins.key_conflicts(good, "doc_id").limit(1).count():
        raise ValueError("repeated doc_id")
    after = good
    if exists(spark, f"{root}/current.json"):
        before, _ = current_version(spark, root)
        after = before.join(good.select("doc_id"), "doc_id", "left_anti").unionByName(good)
    publish_version(after, root, version)
    indexed = good.count()
    return {"indexed": indexed, "failed": marked.count() - indexed}


def frame_json(detections: DataFrame, key: str = "frame_id") -> DataFrame:
    """(key, json): all detections of a frame as one JSON text, in order of confidence."""
    others = [c for c in detections.columns if c != key]
    rows = detections.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("_o"), F.struct(*others).alias("d")))).alias("a"))
    return rows.select(key, F.to_json(F.struct(F.col(key), F.transform("a", lambda x: x["d"]).alias("detections"))).alias("json"))
