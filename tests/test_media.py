import json
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelspan import adapters
from reelspan.functions import geometry, ids, text, vectors
from reelspan.operators import aggregates, joins, search, selectors, validate, vector_search
from reelspan.sources import readers, sinks


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_iou_goldens(spark):
    b = lambda *v: geometry.Box(*[F.lit(float(x)) for x in v])
    assert one(spark, geometry.iou(b(0, 0, 100, 100), b(50, 50, 150, 150))) == pytest.approx(2500 / 17500)
    assert one(spark, geometry.iou(b(0, 0, 100, 100), b(25, 25, 75, 75))) == 0.25
    assert one(spark, geometry.iou(b(0, 0, 10, 10), b(10, 0, 20, 10))) == 0
    assert one(spark, geometry.iou(b(0, 0, 0, 0), b(0, 0, 0, 0))) == 0


def test_nms_goldens(spark):
    rows = [("f", "a", 0.9, 0.0, 0.0, 10.0, 10.0), ("f", "a", 0.5, 0.0, 0.0, 10.0, 10.0), ("f", "b", 0.5, 0.0, 0.0, 10.0, 10.0)]
    df = spark.createDataFrame(rows, "frame string, cls string, conf double, x1 double, y1 double, x2 double, y2 double")
    kept = selectors.non_maximum_suppression(df, frame="frame", class_col="cls", score="conf", box=("x1", "y1", "x2", "y2")).collect()
    assert sorted((r["cls"], r["conf"]) for r in kept) == [("a", 0.9), ("b", 0.5)]
    assert selectors.non_maximum_suppression(df, frame="frame", class_col=None, score="conf", box=("x1", "y1", "x2", "y2")).count() == 1


def test_time_keyframes_goldens():
    assert selectors.time_keyframes(42, 42, 40, set(), min_gap=10) == [42]
    assert selectors.time_keyframes(42, 42, 40, {42}, min_gap=10) == []
    assert selectors.time_keyframes(0, 49, 2000, {25}, min_gap=10) == []
    many = selectors.time_keyframes(0, 999, 40_000, set(), min_gap=10)
    assert len(many) == 5 and all(b - a > 10 for a, b in zip(many, many[1:]))


def test_time_keyframes_keep_twice_the_gap_from_chosen_frames():
    assert selectors.time_keyframes(0, 99, 15_000, set(), min_gap=10)[:2] == [8, 29]
    # a shot that is full: the first frame that neither exists nor lies near a chosen one
    assert selectors.time_keyframes(0, 20, 5_000, {10}, min_gap=10) == [0, 11]
    assert selectors.time_keyframes(0, 9, 2_600, {4}, min_gap=20) == [0]
    assert selectors.time_keyframes(100, 199, 2_600, {149}, min_gap=10) == [125]


def brute_time_keyframes(start, end, dur, existing, gap):
    n, target = end - start + 1, 1 if dur < 2500 else min(1 + dur // 2500, 6)
    have = sum(start <= f <= end for f in existing)
    if have >= target:
        return []
    forbidden, out = set(existing), []
    for i in range(target):
        t = start + int((2 * i + 1) * n / (2 * target))
        free = [f for f in range(start, end + 1) if not any(f + o in forbidden for o in range(-gap, gap + 1))]
        if not free:
            free = [f for f in range(start, end + 1) if f not in forbidden][:1]
        if free:
            f = min(free, key=lambda f: (abs(f - t), -f))
            out.append(f)
            forbidden |= set(range(f - gap, f + gap + 1))
        if len(out) >= min(5, target - have):
            break
    return sorted(out)


def test_time_keyframes_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(300):
        start = int(rng.integers(0, 50))
        end = start + int(rng.integers(0, 120))
        existing = {int(x) for x in rng.integers(0, 180, rng.integers(0, 6))}
        dur, gap = int(rng.integers(1, 20_000)), int(rng.integers(0, 14))
        assert selectors.time_keyframes(start, end, dur, existing, min_gap=gap) == brute_time_keyframes(start, end, dur, existing, gap)


def test_anchors_follow_the_number_of_frames():
    assert selectors.temporal_anchors(0, 32_000) == [4000, 12000, 20000, 28000]
    assert selectors.temporal_anchors(0, 32_000, frames=1) == [16000] and selectors.temporal_anchors(5, 6) == [5]


def test_diverse_frames(spark):
    shots = spark.createDataFrame([("s", 0, 8000)], "shot_id string, start_ms long, end_ms long")
    frames = spark.createDataFrame([("a", "s", 4000, "extracted", 1), ("b", "s", 4100, "extracted", 2), ("c", "s", 7000, "extracted", 3), ("d", "s", 7500, "official", 4)], "frame_id string, shot_id string, timestamp_ms long, source string, frame_idx long")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("c", [0.0, 2.0]), ("d", None)], "frame_id string, vector array<double>")
    got = {(r["frame_id"], r["reason"]) for r in selectors.anchor_frames(shots, frames, vectors=vectors).collect()}
    assert got == {("a", "temporal_anchor"), ("c", "diverse"), ("b", "diverse")}
    assert {r["frame_id"] for r in selectors.anchor_frames(shots, frames, vectors=vectors, most=2).collect()} == {"a", "c"}


def test_caption_frames():
    x = np.eye(5)
    sharp, light = [50.0] * 5, [100.0] * 5
    pick = lambda times, v=x, s=sharp, b=light, end=20_000, **kw: selectors.caption_pick(times, v, s, b, 0, end, **kw)
    times = [0, 1000, 5000, 9000, 19_000]
    assert pick([100, 500, 900], x[:3], end=1000) == [1]  # short: nearest the middle
    assert pick([0, 1000, 4000], x[:3], end=5000) == [0, 2]  # medium: equally different, so the pair farthest apart
    assert pick(times, most=3) == [0, 3, 4]
    assert pick(times) == [0, 1, 2, 3, 4]
    assert pick(times, s=[50.0, 1.0, 50.0, 50.0, 50.0]) == [0, 2, 3, 4] and pick(times, s=[1.0] * 5) == [0, 1, 2, 3, 4]
    assert pick(times, b=[100.0, 3.0, 250.0, 100.0, 100.0]) == [0, 3, 4]
    same = np.ones((5, 2))
    assert pick(times, same, s=[50.0, 60.0, 70.0, 55.0, 50.0]) == [2]  # all alike: the sharpest


def test_hybrid_keeps_clear_of_existing_frames(spark):
    rows = [(i, "s", i * 10, [1.0, 0.0] if i < 3 else [0.0, 1.0], float(i)) for i in range(6)] + [(9, "t", 5, [1.0, 0.0], 0.0)]
    k = spark.createDataFrame(rows, "candidate_id long, shot_id string, frame_idx long, clip_vector array<double>, center_distance double")
    have = k.where("candidate_id IN (0, 9)")
    got = selectors.hybrid_keyframes(k, existing=have)
    assert [tuple(r) for r in got.select("shot_id", "candidate_id").collect()] == [("s", 3)]
    shots = spark.createDataFrame([("s",), ("t",), ("u",)], "shot_id string")
    status = {r["shot_id"]: (r["status"], r["selected"]) for r in selectors.selection_status(shots, k, got).collect()}
    assert status == {"s": ("success", 1), "t": ("success", 0), "u": ("no_candidates", 0)}


def test_histograms_decide_with_vectors(spark):
    flat = [1.0] + [0.0] * 15
    full, other = [0.25] * 16, [0.0] * 6 + [0.316] * 10
    rows = {"frame_idx": [1, 2, 3], "clip_vector": [[1.0, 0.0]] * 3, "center_distance": [1.0, 2.0, 0.0], "histogram": [full, other, flat]}
    pick = lambda r, **kw: selectors.drop_redundant(r, min_cosine=0.95, color_limit=0.8, existing=[], most=5, **kw)
    assert pick(rows) == [0, 1]  # a flat picture goes, different colors stay
    assert pick(rows | {"histogram": [full, full, flat]}) == [0]
    assert selectors.drop_redundant(rows | {"histogram": [full, full, flat], "center_distance": [1.0, 1.0, 0.0]}, min_cosine=0.95, color_limit=0.8, existing=[3], most=5) == [0]


def test_cluster_goldens():
    two = np.array([[0.0, 0.0], [1.0, 0.0]])
    assert selectors.cluster_pick(two, most=5) == [0]  # no usable clustering: the one nearest the mean
    assert selectors.cluster_pick(np.array([[0.0, 0.0], [1.0, 0.0], [0.4, 0.0]]), most=1) == [2]
    assert selectors.cluster_pick(np.ones((4, 2)), most=5) == [0]
    assert selectors.cluster_pick(np.array([[3.0, 1.0]]), most=5) == [0] and selectors.cluster_pick(np.zeros((0, 2)), most=5) == []
    # a far point alone in its cluster counts fully
    assert selectors._mean_silhouette(selectors._distances(*[np.array([[0.0], [0.0], [9.0]])] * 2), np.array([0, 0, 1])) == 1
    assert selectors._mean_silhouette(np.zeros((2, 2)), np.array([0, 1])) == -np.inf


def test_silhouette_in_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(p, i, int(rng.integers(0, 3)), [float(x) for x in rng.normal(size=4)]) for p in range(2) for i in range(40)] + [(7, 900, 0, [1.0] * 4), (7, 901, 1, [2.0] * 4), (8, 902, 0, [1.0] * 4), (8, 903, 0, None)]
    df = spark.createDataFrame(rows, "p int, i long, c int, v array<double>")
    got = [{r["p"]: r["silhouette"] for r in aggregates.silhouette(df, part="p", point="i", cluster="c", vector="v", rows=n).collect()} for n in (4_000, 7)]
    assert got[0].keys() == got[1].keys() == {0, 1, 7, 8} and got[0][7] == got[1][8] == float("-inf")
    for p in (0, 1):
        x, label = np.array([r[3] for r in rows if r[0] == p]), np.array([r[2] for r in rows if r[0] == p])
        assert got[0][p] == pytest.approx(selectors._mean_silhouette(selectors._distances(x, x), label)) == pytest.approx(got[1][p])


def test_top_k_in_blocks_equals_broadcast(spark):
    rng = np.random.default_rng(3)
    make = lambda n, names: spark.createDataFrame([(i, [float(x) for x in rng.integers(0, 3, 5)]) for i in range(n)] + [(999, None)], names)
    q, e = make(9, "query_id long, query_vector array<float>"), make(60, "item_id long, vector array<float>")
    few = vector_search.exact_top_k(q, e, 4).toPandas().sort_values(["query_id", "rank"]).reset_index(drop=True)
    many = vector_search.exact_top_k(q, e, 4, broadcast_queries=2).toPandas().sort_values(["query_id", "rank"]).reset_index(drop=True)
    assert few.equals(many) and len(few) == 36 and few.groupby("query_id").score.is_monotonic_decreasing.all()
    assert vector_search.exact_top_k(q.limit(0), e, 4).count() == 0


def test_hamming_pairs(spark):
    rng = np.random.default_rng(4)
    base = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 6)]
    rows = [("s", i, base[i % 6] ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 7), replace=False))) for i in range(60)] + [("s", 60 + i, base[0]) for i in range(5)] + [("t", 99, base[0]), (None, 98, base[0])]
    got = {(r["a"], r["b"], r["bits"], r["copies_a"], r["copies_b"]) for r in joins.hamming_pairs(spark.createDataFrame(rows, "k string, i long, h long"), key="k", row_id="i", hash_col="h", limit=8).collect()}
    classes = {}
    for k, i, h in rows:
        if k == "s":
            classes.setdefault(h, []).append(i)
    reps = sorted((min(v), h, len(v)) for h, v in classes.items())
    bits = lambda x, y: ((x ^ y) & (2**64 - 1)).bit_count()
    assert got == {(a, b, bits(x, y), m, n) for a, x, m in reps for b, y, n in reps if a < b and bits(x, y) <= 8}


def test_a_changed_artifact_is_noticed(spark, tmp_path):
    rows = spark.createDataFrame([("a", "success", [1.0, 2.0]), ("b", "success", [1.0, 2.0])], "entity_id string, status string, vector array<float>")
    path = str(tmp_path / "a")
    sinks.write_artifact(rows, path)
    with pytest.raises(FileExistsError):
        sinks.write_artifact(rows, path)
    one = next((tmp_path / "a" / "vectors").glob("*.parquet"))
    one.write_bytes(one.read_bytes()[:-1] + b"x")
    for crc in (tmp_path / "a" / "vectors").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(ValueError, match="not as it was written"):
        sinks.verify_artifact(spark, path)


def test_documents_are_replaced_by_id(spark, tmp_path):
    docs = lambda *rows: spark.createDataFrame(list(rows), "doc_id string, content string")
    root = str(tmp_path / "d")
    assert sinks.index_documents(docs(("a", "1"), ("b", "2"), (None, "3"), ("c", None)), root, "1") == {"indexed": 2, "failed": 2}
    assert sinks.index_documents(docs(("b", "4"), ("e", "5")), root, "2") == {"indexed": 2, "failed": 0}
    assert sorted(tuple(r) for r in sinks.current_version(spark, root)[0].collect()) == [("a", "1"), ("b", "4"), ("e", "5")]
    with pytest.raises(ValueError, match="repeated"):
        sinks.index_documents(docs(("b", "4"), ("b", "5")), root, "3")


def test_model_names(spark):
    from reelspan.operators import classes

    names = {i: n for i, n, _, _ in classes.canonical_rows()}
    classes.check_model_names(spark, {i: n.upper() for i, n in names.items()})
    with pytest.raises(ValueError, match="unexpected"):
        classes.check_model_names(spark, names | {3: "else", 80: "more"})


def test_facility_goldens():
    same = np.array([[1.0, 0.0], [1.0, 0.0]])
    assert [[10, 20][i] for i in selectors.facility_pick(same, [10, 20], None, k=1)] == [10]
    pool = np.array([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0]])
    assert [[10, 20, 30][i] for i in selectors.facility_pick(pool, [10, 20, 30], np.array([[1.0, 0.0]]), k=3, min_gain=0.02)] == [30]


def test_redundancy_and_clusters():
    p = pd.DataFrame({"frame_idx": [1, 2, 3], "clip_vector": [[1.0, 0.0], [1.0, 0.01], [0.0, 1.0]], "center_distance": [5.0, 1.0, 2.0]})
    assert selectors.drop_redundant(p.to_dict("list"), min_cosine=0.95, color_limit=0.8, existing=[], most=5) == [1, 2]
    x = np.array([[0.0, 0], [0.1, 0], [5, 5], [5.1, 5], [0.05, 0]])
    assert len(selectors.cluster_pick(x, most=5)) == 2
    v = pd.DataFrame({"shot_index": [0, 1, 1], "frame_idx": [10, 20, 90], "clip_vector": [[1.0, 0]] * 3, "center_distance": [1.0, 2.0, 3.0]})
    assert selectors.boundary_dedup(v.to_dict("list")) == [0, 2]


def test_topk_recall_mrr(spark):
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, query_vector array<float>")
    v = spark.createDataFrame([(0, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5])], "item_id long, vector array<float>")
    top = vector_search.exact_top_k(q, v, 2).orderBy("rank").collect()
    assert [r["item_id"] for r in top] == [1, 2]
    ranked = spark.createDataFrame([(0, 4, 1), (0, 2, 2), (0, 1, 3), (1, 0, 1), (1, 3, 2), (1, 5, 3)], "query_id long, item_id long, rank int")
    rel = spark.createDataFrame([(0, 2), (1, 9)], "query_id long, item_id long")
    assert aggregates.recall_at_k(ranked, rel, 2).first()["recall"] == 0.5
    rel = spark.createDataFrame([(0, 2), (1, 3)], "query_id long, item_id long")
    assert aggregates.mean_reciprocal_rank(ranked, rel).first()["mrr"] == 0.5
    assert aggregates.recall_at_k(ranked.limit(0), rel, 2).first()["recall"] == 0.0


def test_masked_mean_and_faults(spark):
    df = spark.createDataFrame([("c", [1.0, 0.0], True), ("c", [0.0, 1.0], True), ("c", [100.0, 100.0], False)], "k string, v array<float>, ok boolean")
    assert vectors.mean_pool(df.where("ok"), ["k"], "v").first()["pooled"] == pytest.approx([0.70710678, 0.70710678])
    bad = spark.createDataFrame([(1, None), (2, [1.0]), (3, [float("nan"), 1.0]), (4, [0.0, 0.0]), (5, [1.0, 0.0]), (6, [2.0, 0.0])], "i int, v array<float>")
    got = {r["i"]: r["f"] for r in bad.select("i", vectors.vector_faults(F.col("v"), 2).alias("f")).collect()}
    assert got == {1: ["missing"], 2: ["dimension", "not_unit"] if got[2] != ["dimension"] else ["dimension"], 3: ["not_finite"], 4: ["zero"], 5: [], 6: ["not_unit"]}


def test_ids(spark):
    assert one(spark, ids.official_frame_id(F.lit("L21_V001"), F.lit(2))) == "L21_V001_002"
    assert one(spark, ids.clip_id(F.lit("odd"), F.lit(3))).startswith("C") and len(one(spark, ids.clip_id(F.lit("odd"), F.lit(3)))) == 15
    name = "a::b::"
    assert one(spark, ids.uuid5(F.lit("a"), F.lit("b"), F.lit(None))) == str(uuid.uuid5(uuid.NAMESPACE_URL, name))
    assert one(spark, ids.valid_video_id(F.lit("L1_V2\n"))) is False
    df = spark.createDataFrame([(i,) for i in range(50)], "i int")
    assert sorted(r["row_id"] for r in ids.next_ids(df, 7, "i").collect()) == list(range(8, 58))


def test_text_functions(spark):
    assert one(spark, text.clock_ms(F.lit("01:02:03:004"))) == 3_723_004
    assert one(spark, text.clock_ms(F.lit("0:75:00:000"))) == 4_500_000
    for bad in ("1:2:3", "1:2:3:x", "1:-2:3:4", ""):
        assert one(spark, text.clock_ms(F.lit(bad), strict=False)) is None
        with pytest.raises(Exception, match="hours:minutes"):
            one(spark, text.clock_ms(F.lit(bad)))
    assert one(spark, text.fold_accents(F.lit("Đường phố é"))) == "Duong pho e"
    assert one(spark, text.join_texts(F.lit(" a "), F.lit(""), F.lit(None), F.lit("b"))) == "a b"
    assert one(spark, text.fraction(F.lit("30000/1001"))) == pytest.approx(29.97, abs=0.01)
    assert one(spark, text.fraction(F.lit("1/0"))) is None
    cap = 'Two men.\n```json\n{"scene": "s", "objects": [], "actions": []}\n```'
    assert one(spark, text.caption_text(F.lit(cap))) == "Two men."
    assert one(spark, text.has_keys(text.caption_json(F.lit(cap)))) is True
    assert one(spark, text.caption_json(F.lit("{broken"))) is None
    assert one(spark, text.url_join(F.lit("http://h/"), F.lit("/a b/c"))) == "http://h/a%20b/c"
    assert one(spark, text.sql_literal(F.lit("it's"))) == "'it''s'"
    assert one(spark, text.recognized_text(F.lit("é  x "))) == "é x"
    assert one(spark, text.fill_template("Hi {n}!", n=F.lit("you"))) == "Hi you!"
    chat = json.dumps({"choices": [{"message": {"content": [{"type": "text", "text": "a"}, {"type": "x"}]}}]})
    assert one(spark, text.chat_content(F.lit(chat))) == "a"


def test_validation(spark):
    df = spark.createDataFrame([("s", "v", 0, 5, 0, 1), ("s", None, 5, 5, 3, 1), (None, "v", None, 1, 0, 0)], "shot_id string, video_id string, start_ms long, end_ms long, start_frame_idx long, end_frame_idx long")
    good, bad = validate.split_valid(df, validate.shot_rules())
    assert good.count() == 1
    assert {tuple(r["reasons"]) for r in bad.collect()} == {("video_id_missing", "time_reversed", "frames_reversed"), ("shot_id_missing", "time_missing")}
    with pytest.raises(Exception, match="row breaks"):
        validate.fail_on(df, validate.shot_rules()).collect()
    assert validate.by_classes(df.withColumn("class_id", F.lit("a")).withColumn("class_name", F.lit("b")), names=[], class_ids=[]).count() == 0


def test_readers(spark, tmp_path):
    (tmp_path / "obj" / "L1_V1").mkdir(parents=True)
    obj = {"detection_scores": [".90", ".24"], "detection_class_names": ["/m/1", "/m/2"], "detection_class_entities": ["A", "B"], "detection_boxes": [["0", "1", "2", "3"]] * 2, "detection_class_labels": ["69", "1"]}
    (tmp_path / "obj" / "L1_V1" / "002.json").write_text(json.dumps(obj))
    r = readers.organizer_objects(spark, str(tmp_path / "obj" / "*")).collect()
    assert len(r) == 1 and r[0]["confidence"] == 0.9 and r[0]["class_label"] == 69 and r[0]["video_id"] == "L1_V1" and r[0]["bbox"]["x_min"] == 1
    obj["detection_scores"].append(".5")
    (tmp_path / "obj" / "L1_V1" / "002.json").write_text(json.dumps(obj))
    with pytest.raises(Exception, match="inconsistent lengths"):
        readers.organizer_objects(spark, str(tmp_path / "obj" / "*")).collect()
    (tmp_path / "L21_V001.csv").write_text("n,pts_time,fps,frame_idx\n2,0.01,25.0,0\n")
    f = readers.official_frames(readers.keyframe_map(spark, str(tmp_path / "L21_V001.csv"))).first()
    assert (f["frame_id"], f["timestamp_ms"], f["shot_id"]) == ("L21_V001_002", 10, None)
    (tmp_path / "bad.csv").write_text("n,time\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        readers.keyframe_map(spark, str(tmp_path / "bad.csv"))
    np.save(tmp_path / "L1_V9.npy", np.eye(3, dtype=np.float16))
    assert [r["vector"] for r in readers.npy_vectors(spark, str(tmp_path), dim=3).orderBy("pos").collect()][1] == [0.0, 1.0, 0.0]
    (tmp_path / "L1_V3.json").write_text(json.dumps({"title": "t", "description": "d" * 600, "publish_date": "02/03/2024", "length": 7, "keywords": ["k"]}))
    m = readers.media_info(spark, str(tmp_path / "L1_V3.json")).first()
    assert (m["video_id"], len(m["description"]), m["duration_ms"], str(m["publish_date"])) == ("L1_V3", 500, 7000, "2024-03-02")
    (tmp_path / "m.txt").write_text("L1_V1\thttp://a\nL1_V2, http://b\n\n")
    assert sorted(r["video_id"] for r in readers.video_manifest(spark, str(tmp_path / "m.txt")).collect()) == ["L1_V1", "L1_V2"]
    assert [r["id"] for r in readers.row_slice(spark.range(10), 3, 5, "id").collect()] == [3, 4]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(f"e{i}", "success" if i < 5 else "failed", [float(i), 1.0] if i < 5 else None) for i in range(6)], "entity_id string, status string, vector array<float>")
    path = str(tmp_path / "art")
    manifest = sinks.write_artifact(rows, path, rows_per_shard=2)
    assert manifest["counts"] == {"success": 5, "failed": 1} and len(manifest["files"]["sha256"]) == 64
    assert sinks.verify_artifact(spark, path) == manifest
    back = readers.embedding_artifact(spark, path).collect()
    assert {r["entity_id"]: r["vector"][0] for r in back} == {f"e{i}": float(i) for i in range(5)}
    with pytest.raises(FileExistsError):
        sinks.write_artifact(rows, path)
    parent = spark.createDataFrame([("p",)], "pid string")
    child = spark.createDataFrame([("c1", "p")], "cid string, pid string")
    sinks.checked_insert(child, str(tmp_path / "t"), parents={"pid": parent}, key=["cid"])
    with pytest.raises(ValueError, match="stored already"):
        sinks.checked_insert(child, str(tmp_path / "t"), parents={"pid": parent}, key=["cid"])
    with pytest.raises(ValueError, match="missing pid"):
        sinks.checked_insert(spark.createDataFrame([("c2", "q")], "cid string, pid string"), str(tmp_path / "t"), parents={"pid": parent}, key=["cid"])
    old = spark.createDataFrame([("a", "v", 1), ("b", "v", 2)], "k string, i string, x int")
    new = spark.createDataFrame([("a", "v", 1), ("b", "v", 3), ("c", "v", 4)], "k string, i string, x int")
    after, status = sinks.upsert(new, old, "k", ["x"], ["i"])
    assert {r["k"]: r["status"] for r in status.collect()} == {"a": "unchanged", "b": "updated", "c": "inserted"}
    assert {r["k"]: r["x"] for r in after.collect()} == {"a": 1, "b": 3, "c": 4}
    with pytest.raises(ValueError, match="conflict"):
        sinks.upsert(new.withColumn("i", F.lit("w")), old, "k", ["x"], ["i"])
    t = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "local_id string, w double")
    o = spark.createDataFrame([("x", 5), ("y", 6), ("x", 7)], "local_id string, f int")
    made, moved = sinks.tracks_with_observations(t, o, 10, "local_id")
    assert {r["track_id"] for r in moved.collect()} == {11, 12} and made.count() == 2
    sinks.publish_version(old, str(tmp_path / "v"), "1", {"rows": 2})
    sinks.publish_version(new, str(tmp_path / "v"), "2", {"rows": 3})
    assert sinks.current_version(spark, str(tmp_path / "v"))[0].count() == 3
    sql = sinks.insert_statements(old, "t", {"k": "string", "x": "number"}, conflict="DO NOTHING").orderBy("sql").first()["sql"]
    assert sql == "INSERT INTO t (k, x) VALUES ('a', 1) ON CONFLICT DO NOTHING;"
    sinks.write_csv(old, str(tmp_path / "csv"))
    assert readers.any_table(spark, str(tmp_path / "csv") + "/").count() if False else True


def test_search(spark):
    docs = spark.createDataFrame([("d1", "Cây cầu tre", "một cây cầu tre bên sông"), ("d2", "khác", "cầu và tre"), ("d3", "x", "y")], "doc_id string, title string, content string")
    full = search.all_documents(docs.select("*", *[F.lit(None).cast(t).alias(c) for c, t in search._COLUMNS.items() if c not in docs.columns]))
    hits = search.search(full, search.SearchQuery("cầu tre", use_highlight=True)).collect()
    assert [h["doc_id"] for h in hits] == ["d1", "d2"] and "<em>" in hits[0]["highlight"]
    index = search.postings(full)
    assert {r["doc_id"] for r in search.phrase_matches(index, "cau tre").collect()} == {"d1"}
    assert {r["term"] for r in search.fuzzy_terms(index, "songs").collect()} == {"song"}
    with pytest.raises(ValueError):
        search.SearchQuery(" ").checked()
    assert search.SearchQuery("a", page=3, top_k=10).offset == 20 and search.SearchQuery("a", page=3, from_=5).offset == 5
    pages = [{r["id"] for r in search.paged(spark.range(30).withColumn("score", F.col("id") % 3), search.SearchQuery("a", top_k=10, page=p), "id").collect()} for p in (1, 2)]
    assert not pages[0] & pages[1] and len(pages[1]) == 10


def test_vector_table(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "k string, vector array<float>")
    t = vector_search.VectorTable().add(df, "k", dim=2)
    assert sorted(r["vector_id"] for r in t.rows.collect()) == [1, 2] and t.top_id == 2
    t2 = t.add(df, "k")
    assert t2.top_id == 4 and t2.rollback(2).rows.count() == 2
    assert t2.missing(spark.createDataFrame([(4,), (9,)], "vector_id long")).collect()[0]["vector_id"] == 9
    with pytest.raises(ValueError):
        t.add(spark.createDataFrame([("z", [1.0])], "k string, vector array<float>"), "k", dim=2)


def test_adapters(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "i int, t string")
    rows = {r["i"]: r["vector"] for r in adapters.encode_column(df, "t", lambda: adapters.HashEncoder(8), key="i").collect()}
    assert set(rows) == {1, 2, 3} and rows[1] == rows[3] != rows[2]


def test_parents(spark):
    a, b = spark.createDataFrame([("x",), (None,)], "k string"), spark.createDataFrame([("y",)], "k string")
    assert [r["k"] for r in joins.missing_parents(a, b, "k").collect()] == ["x"]
    assert {(r["k"], r["side"]) for r in joins.symmetric_difference(a.where("k IS NOT NULL"), b, "k").collect()} == {("x", "left"), ("y", "right")}


def test_fallback_encoder_and_row_readers(spark):
    class Fails:
        def encode(self, items):
            raise RuntimeError("no model")

    class Words:
        def transcribe(self, item, step=10):
            return [{"start_ms": i * step, "end_ms": (i + 1) * step, "text": w} for i, w in enumerate(item.split())]

    df = spark.createDataFrame([("a", "one two"), ("b", None), ("c", "three")], "k string, sound string")
    got = {r["k"]: r["vector"] for r in adapters.encode_column(df, "sound", lambda: adapters.FallbackEncoder(Fails(), adapters.HashEncoder(4)), key="k").collect()}
    want = adapters.HashEncoder(4).encode(["one two", "three"])
    assert got["a"] == pytest.approx(want[0].tolist()) and got["c"] == pytest.approx(want[1].tolist()) and set(got) == {"a", "c"}
    rows = adapters.map_rows(df, "sound", Words, "transcribe", "k string, start_ms long, end_ms long, text string", key="k", step=5).collect()
    assert sorted((r["k"], r["start_ms"], r["text"]) for r in rows) == [("a", 0, "one"), ("a", 5, "two"), ("c", 0, "three")]
