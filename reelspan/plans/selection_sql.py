"""SQL of the greedy selections: one recursion step per item, box, anchor or part, the choice so far as a list."""

from __future__ import annotations

from reelspan.plans import common as c

_AREA = "greatest({0}.x_max - {0}.x_min, 0) * greatest({0}.y_max - {0}.y_min, 0)"
_BOTH = "greatest(0, least({0}.x_max, {1}.x_max) - greatest({0}.x_min, {1}.x_min)) * greatest(0, least({0}.y_max, {1}.y_max) - greatest({0}.y_min, {1}.y_min))"
_BOXED = "x_min IS NOT NULL AND x_max IS NOT NULL AND y_min IS NOT NULL AND y_max IS NOT NULL"


def _alike(a: str, b: str, limit: float) -> str:
    both = _BOTH.format(a, b)
    union = f"({_AREA.format(a)} + {_AREA.format(b)} - {both})"
    return f"({union} > 0 AND {both} / {union} >= {limit})"


NMS = f"""WITH RECURSIVE b AS (SELECT frame_id, n, confidence, x_min, y_min, x_max, y_max, row_number() OVER (PARTITION BY frame_id ORDER BY confidence DESC, n) AS r FROM {c.OCR} WHERE {_BOXED} AND confidence IS NOT NULL),
w AS (SELECT frame_id, r, [{{'n': n, 'x_min': x_min, 'y_min': y_min, 'x_max': x_max, 'y_max': y_max}}] AS kept FROM b WHERE r = 1
  UNION ALL SELECT b.frame_id, b.r, CASE WHEN len(list_filter(w.kept, lambda k: {_alike("k", "b", 0.45)})) > 0 THEN w.kept ELSE list_append(w.kept, {{'n': b.n, 'x_min': b.x_min, 'y_min': b.y_min, 'x_max': b.x_max, 'y_max': b.y_max}}) END
  FROM w JOIN b ON b.frame_id = w.frame_id AND b.r = w.r + 1),
f AS (SELECT frame_id, unnest(list_transform(arg_max(kept, r), lambda k: k.n)) AS n FROM w GROUP BY 1)
SELECT b.frame_id, b.n, confidence, x_min, y_min, x_max, y_max FROM b JOIN f ON b.frame_id = f.frame_id AND b.n = f.n"""

TEMPORAL_TEXTS = f"""WITH RECURSIVE b AS (SELECT o.frame_id, o.n, f.shot_id, f.timestamp_ms AS t, lower(text) AS k, x_min, y_min, x_max, y_max, row_number() OVER (PARTITION BY f.shot_id, lower(text) ORDER BY f.timestamp_ms, o.frame_id, o.n) AS r
  FROM {c.OCR} o JOIN {c.FRAMES} f ON o.frame_id = f.frame_id WHERE text IS NOT NULL AND {_BOXED} AND f.shot_id IS NOT NULL AND f.timestamp_ms IS NOT NULL),
w AS (SELECT shot_id, k, r, [{{'f': frame_id, 'n': n, 't': t, 'x_min': x_min, 'y_min': y_min, 'x_max': x_max, 'y_max': y_max}}] AS kept FROM b WHERE r = 1
  UNION ALL SELECT b.shot_id, b.k, b.r, CASE WHEN len(list_filter(w.kept, lambda q: b.t - q.t <= 3000 AND {_alike("q", "b", 0.5)})) > 0 THEN w.kept ELSE list_append(w.kept, {{'f': b.frame_id, 'n': b.n, 't': b.t, 'x_min': b.x_min, 'y_min': b.y_min, 'x_max': b.x_max, 'y_max': b.y_max}}) END
  FROM w JOIN b ON b.shot_id = w.shot_id AND b.k = w.k AND b.r = w.r + 1),
f AS (SELECT shot_id, unnest(arg_max(kept, r)) AS x FROM w GROUP BY shot_id, k)
SELECT x.f AS frame_id, x.n AS n, shot_id FROM f"""

HASH_CACHE = f"""WITH RECURSIVE b AS (SELECT shot_id, frame_id, xor(frame_idx * 2654435761, frame_idx) AS h, row_number() OVER (PARTITION BY shot_id ORDER BY frame_id) AS r FROM {c.FRAMES} WHERE shot_id IS NOT NULL AND frame_idx IS NOT NULL),
w AS (SELECT shot_id, r, frame_id, CAST(NULL AS VARCHAR) AS reused_from, [{{'h': h, 'f': frame_id}}] AS kept FROM b WHERE r = 1
  UNION ALL SELECT shot_id, r, frame_id, hit, CASE WHEN hit IS NULL THEN list_append(kept, {{'h': h, 'f': frame_id}}) ELSE kept END
  FROM (SELECT b.shot_id, b.r, b.frame_id, b.h, w.kept, list_filter(w.kept, lambda k: bit_count(xor(k.h, b.h)) <= 4)[1].f AS hit FROM w JOIN b ON b.shot_id = w.shot_id AND b.r = w.r + 1))
SELECT frame_id, reused_from FROM w"""

ANCHORS = f"""WITH RECURSIVE s AS (SELECT shot_id, start_ms AS a, end_ms AS e, greatest(1, least(4, (end_ms - start_ms + 7999) // 8000)) AS n FROM {c.SOUND_SHOTS}),
f AS (SELECT shot_id, count(*) AS many, list({{'i': frame_id, 't': timestamp_ms, 'o': CASE WHEN source IS DISTINCT FROM 'extracted' THEN 1 ELSE 0 END, 'x': coalesce(frame_idx, 1152921504606846976)}}) AS fs FROM {c.FRAMES} WHERE shot_id IS NOT NULL AND timestamp_ms IS NOT NULL GROUP BY 1),
w AS (SELECT s.shot_id, a, e, least(n, many) AS n, fs, 0 AS i, CAST([] AS VARCHAR[]) AS used FROM s JOIN f ON s.shot_id = f.shot_id
  UNION ALL SELECT shot_id, a, e, n, fs, i + 1, list_append(used, list_sort(list_transform(list_filter(fs, lambda x: NOT list_contains(used, x.i)), lambda x: {{'d': abs(x.t - CAST(floor(a + (e - a) * (i + 0.5) / n) AS BIGINT)), 'o': x.o, 'x': x.x, 'i': x.i}}))[1].i)
  FROM w WHERE i < n AND len(used) < len(fs))
SELECT shot_id, unnest(used) AS frame_id, 'temporal_anchor' AS reason FROM (SELECT shot_id, arg_max(used, i) AS used FROM w GROUP BY 1)"""

_HAVE = f"(SELECT video_id, list(DISTINCT frame_idx) AS fs FROM {c.FRAMES} WHERE frame_idx IS NOT NULL AND video_id IS NOT NULL GROUP BY 1)"

TIME_KEYFRAMES = f"""WITH RECURSIVE s AS (SELECT shot_id, s.video_id, start_frame_idx AS a, end_frame_idx AS z, end_frame_idx - start_frame_idx + 1 AS n,
    CASE WHEN end_ms - start_ms < 2500 THEN 1 ELSE least(1 + (end_ms - start_ms) // 2500, 6) END AS target, list_filter(coalesce(h.fs, []), lambda x: x BETWEEN start_frame_idx - 10 AND end_frame_idx + 10) AS have
  FROM {c.SOUND_SHOTS} s LEFT JOIN {_HAVE} h ON s.video_id = h.video_id),
q AS (SELECT *, target - len(list_filter(have, lambda x: x BETWEEN a AND z)) AS short FROM s),
w AS (SELECT shot_id, video_id, a, z, n, target, have, least(5, short) AS need, 0 AS i, CAST([] AS BIGINT[]) AS taken FROM q WHERE short > 0
  UNION ALL SELECT shot_id, video_id, a, z, n, target, have, need, i + 1, CASE WHEN pick IS NULL THEN taken ELSE list_append(taken, pick) END FROM
    (SELECT *, coalesce(-list_sort(list_transform(list_filter(range(a, z + 1), lambda x: len(list_filter(have, lambda h: abs(h - x) <= 10)) = 0 AND len(list_filter(taken, lambda t: abs(t - x) <= 20)) = 0), lambda x: {{'d': abs(x - least(greatest(a + (2 * i + 1) * n // (2 * target), a), z)), 'm': -x}}))[1].m,
      list_filter(range(a, z + 1), lambda x: NOT list_contains(have, x) AND len(list_filter(taken, lambda t: abs(t - x) <= 10)) = 0)[1]) AS pick FROM w WHERE i < target AND len(taken) < need))
SELECT shot_id, video_id, unnest(taken) AS frame_idx FROM (SELECT shot_id, video_id, arg_max(taken, i) AS taken FROM w GROUP BY 1, 2)"""

SPARSE = f"""WITH h AS (SELECT shot_id, list(DISTINCT frame_idx) AS fs FROM {c.FRAMES} WHERE shot_id IS NOT NULL AND frame_idx IS NOT NULL GROUP BY 1),
s AS (SELECT s.shot_id, start_frame_idx AS a, end_frame_idx AS z, (start_frame_idx + end_frame_idx) // 2 AS m, least(least(start_frame_idx + 2, end_frame_idx), greatest(end_frame_idx - 2, start_frame_idx)) AS lo,
    greatest(least(start_frame_idx + 2, end_frame_idx), greatest(end_frame_idx - 2, start_frame_idx)) AS hi, coalesce(h.fs, []) AS have FROM {c.SOUND_SHOTS} s LEFT JOIN h ON s.shot_id = h.shot_id),
k AS (SELECT *, list_sort(list_filter(list_distinct(list_append(range(lo, hi + 1, 12), m)), lambda x: len(list_filter(have, lambda y: abs(y - x) <= 10)) = 0)) AS good FROM s),
p AS (SELECT shot_id, CASE WHEN len(good) BETWEEN 1 AND 64 THEN good WHEN len(good) > 64 THEN list_distinct(list_transform(range(0, 64), lambda i: good[1 + CAST(round(i * (len(good) - 1) / 63.0) AS BIGINT)]))
    ELSE list_transform(list_sort(list_transform(list_filter(range(a, z + 1), lambda x: len(list_filter(have, lambda y: abs(y - x) <= 10)) = 0), lambda x: {{'d': abs(x - m), 'x': x}}))[1:1], lambda t: t.x) END AS fs FROM k)
SELECT shot_id, unnest(fs) AS frame_idx FROM p"""

_CANDIDATES = f"(SELECT candidate_id, shot_id, video_id, frame_idx, coalesce(center_distance, 0) AS center_distance, CAST(clip_vector AS DOUBLE[]) AS v, sqrt(list_inner_product(CAST(clip_vector AS DOUBLE[]), CAST(clip_vector AS DOUBLE[]))) AS l FROM {c.CANDIDATES} WHERE shot_id IS NOT NULL AND frame_idx IS NOT NULL)"

FACILITY = f"""WITH RECURSIVE x AS (SELECT shot_id, candidate_id, v, l, row_number() OVER (PARTITION BY shot_id ORDER BY frame_idx, candidate_id) AS r FROM {_CANDIDATES}),
m AS (SELECT a.shot_id, a.r, list(least(greatest(list_inner_product(a.v, b.v) / (greatest(a.l, 1e-12) * greatest(b.l, 1e-12)), 0), 1) ORDER BY b.r) AS s FROM x a JOIN x b ON a.shot_id = b.shot_id GROUP BY 1, 2),
g AS (SELECT shot_id, count(*) AS n, list(s ORDER BY r) AS sims FROM m GROUP BY 1),
w AS (SELECT shot_id, n, sims, 0 AS i, CAST([] AS BIGINT[]) AS picked, list_transform(range(1, n + 1), lambda j: CAST(0 AS DOUBLE)) AS cover, true AS going FROM g
  UNION ALL SELECT shot_id, n, sims, i + 1, CASE WHEN stop THEN picked ELSE list_append(picked, best) END, CASE WHEN stop THEN cover ELSE list_transform(range(1, n + 1), lambda j: greatest(cover[j], sims[best][j])) END, NOT stop FROM
    (SELECT *, i > 0 AND gains[best] / n < 0.01 AS stop FROM (SELECT *, list_filter(range(1, n + 1), lambda j: gains[j] >= top - 1e-12)[1] AS best FROM (SELECT *, list_max(gains) AS top FROM
      (SELECT *, list_transform(range(1, n + 1), lambda k: CASE WHEN list_contains(picked, k) THEN -1 ELSE list_sum(list_transform(range(1, n + 1), lambda j: greatest(sims[k][j] - cover[j], 0))) END) AS gains FROM w WHERE going AND i < least(5, n))))))
SELECT x.shot_id, x.candidate_id FROM (SELECT shot_id, unnest(arg_max(picked, i)) AS r FROM w GROUP BY 1) p JOIN x ON x.shot_id = p.shot_id AND x.r = p.r"""

TRANSCRIPTS = f"""WITH RECURSIVE i AS (SELECT frame_id, n * 100 AS s, n * 100 + 90 AS e, trim(text) AS t, len(regexp_split_to_array(trim(text), '\\s+')) AS k, row_number() OVER (PARTITION BY frame_id ORDER BY n) AS r FROM {c.OCR} WHERE text IS NOT NULL AND trim(text) <> ''),
w AS (SELECT frame_id, r, s, e, t, k, 0 AS no FROM i WHERE r = 1
  UNION ALL SELECT i.frame_id, i.r, CASE WHEN w.k >= 8 THEN i.s ELSE w.s END, i.e, CASE WHEN w.k >= 8 THEN i.t ELSE w.t || ' ' || i.t END, CASE WHEN w.k >= 8 THEN i.k ELSE w.k + i.k END, CASE WHEN w.k >= 8 THEN w.no + 1 ELSE w.no END FROM w JOIN i ON i.frame_id = w.frame_id AND i.r = w.r + 1)
SELECT frame_id, no AS segment_no, arg_max(s, r) AS start_ms, arg_max(e, r) AS end_ms, arg_max(t, r) AS text FROM w GROUP BY 1, 2"""

_WHITE = r"[\t\n\x0b\f\r\x{85}\p{Z}]+"
RECOGNIZED = f"SELECT frame_id, n, trim(regexp_replace(nfc_normalize(text), '{_WHITE}', ' ', 'g')) AS text FROM {c.OCR} WHERE text IS NOT NULL"

_NAME = "concat_ws('::', 'media', coalesce(k.video_id, ''), coalesce(k.shot_id, ''), coalesce(CAST(k.start_ms AS VARCHAR), ''), coalesce(CAST(k.end_ms AS VARCHAR), ''), coalesce(k.clip_builder_version, ''))"
UUIDS = f"""WITH h AS (SELECT clip_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({_NAME})) AS h FROM {c.SOUND_CLIPS} k)
SELECT clip_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || CASE (strpos('0123456789abcdef', h[17]) - 1) % 4 WHEN 0 THEN '8' WHEN 1 THEN '9' WHEN 2 THEN 'a' ELSE 'b' END || h[18:20] || '-' || h[21:32] AS uuid FROM h"""

CAPTION_TIMES = f"""SELECT shot_id, start_ms + CAST(floor((end_ms - start_ms) * (i + 0.5) / n) AS BIGINT) AS timestamp_ms FROM (SELECT shot_id, start_ms, end_ms, n, unnest(range(n)) AS i
  FROM (SELECT *, CASE WHEN end_ms - start_ms <= 1500 THEN 3 ELSE least(16, greatest(6, (end_ms - start_ms + 1499) // 1500)) END AS n FROM {c.SOUND_SHOTS}))"""

# one row goes per step: of the most similar pair above the limits the one farther from the centre, nearer to an existing frame, later
REDUNDANCY = f"""WITH RECURSIVE x AS (SELECT shot_id, candidate_id, frame_idx, center_distance, v, l, row_number() OVER (PARTITION BY shot_id ORDER BY frame_idx, center_distance, candidate_id) AS r FROM {_CANDIDATES} WHERE candidate_id % 5 <> 0),
e AS (SELECT shot_id, list(frame_idx) AS fs FROM {_CANDIDATES} WHERE candidate_id % 5 = 0 GROUP BY 1),
wx AS (SELECT x.*, rank() OVER (PARTITION BY x.shot_id ORDER BY center_distance, -coalesce(list_min(list_transform(e.fs, lambda f: abs(f - frame_idx))), 1152921504606846976), frame_idx, r) AS worth FROM x LEFT JOIN e ON x.shot_id = e.shot_id),
p AS (SELECT a.shot_id, list({'{'}'s': list_inner_product(a.v, b.v) / (a.l * b.l), 'a': a.r, 'b': b.r, 'gone': CASE WHEN a.worth > b.worth THEN a.r ELSE b.r END{'}'}) AS pairs FROM wx a JOIN wx b ON a.shot_id = b.shot_id AND a.r < b.r
  WHERE list_inner_product(a.v, b.v) / (a.l * b.l) > 0.95 GROUP BY 1),
w AS (SELECT shot_id, pairs, CAST([] AS BIGINT[]) AS dropped, 0 AS i FROM p
  UNION ALL SELECT shot_id, list_filter(pairs, lambda q: q.a <> gone AND q.b <> gone), list_append(dropped, gone), i + 1 FROM
    (SELECT *, list_sort(list_transform(list_filter(pairs, lambda q: q.s >= list_max(list_transform(pairs, lambda z: z.s)) - 1e-12), lambda q: {'{'}'a': q.a, 'b': q.b, 'gone': q.gone{'}'}))[1].gone AS gone FROM w WHERE len(pairs) > 0)),
g AS (SELECT shot_id, arg_max(dropped, i) AS dropped FROM w GROUP BY 1)
SELECT x.shot_id, x.candidate_id FROM x LEFT JOIN g ON x.shot_id = g.shot_id WHERE NOT list_contains(coalesce(g.dropped, []), x.r) QUALIFY row_number() OVER (PARTITION BY x.shot_id ORDER BY (SELECT worth FROM wx WHERE wx.candidate_id = x.candidate_id)) <= 64"""

CROSS_SHOT = f"""WITH RECURSIVE x AS (SELECT k.video_id, s.shot_index, candidate_id, frame_idx, center_distance, v, l FROM {_CANDIDATES} k JOIN {c.SOUND_SHOTS} s ON k.shot_id = s.shot_id WHERE k.video_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY video_id, shot_index ORDER BY frame_idx, center_distance) AS rn, count(*) OVER (PARTITION BY video_id, shot_index) AS n, dense_rank() OVER (PARTITION BY video_id ORDER BY shot_index NULLS FIRST) AS g FROM x),
w AS (SELECT video_id, g, frame_idx, center_distance, v, l, true AS alive, false AS gone FROM o WHERE g = 1 AND rn = n
  UNION ALL SELECT video_id, g, frame_idx, center_distance, v, l, NOT (gone AND n = 1), gone FROM
    (SELECT z.video_id, z.g, z.frame_idx, z.center_distance, z.v, z.l, z.n, w.alive AND a.frame_idx - w.frame_idx <= 150 AND list_inner_product(a.v, w.v) / (a.l * w.l) > 0.9 AND (a.n > 1 OR a.center_distance > w.center_distance) AS gone
     FROM w JOIN o a ON a.video_id = w.video_id AND a.g = w.g + 1 AND a.rn = 1 JOIN o z ON z.video_id = a.video_id AND z.g = a.g AND z.rn = z.n))
SELECT o.video_id, o.candidate_id FROM o JOIN w ON o.video_id = w.video_id AND o.g = w.g WHERE NOT (o.rn = 1 AND w.gone)"""

ALL = {
    "cross_shot_dedup": CROSS_SHOT, "redundancy_dedup": REDUNDANCY.replace(" WHERE candidate_id % 5 <> 0", "").replace("WHERE candidate_id % 5 = 0", "WHERE false"),
    "caption_times": CAPTION_TIMES, "redundancy_with_existing": REDUNDANCY,
    "nms": NMS, "ocr_temporal_dedup": TEMPORAL_TEXTS, "hash_text_cache": HASH_CACHE, "anchor_frames": ANCHORS, "time_keyframes": TIME_KEYFRAMES, "sparse_candidates": SPARSE, "facility_select": FACILITY,
    "transcript_coalesce": TRANSCRIPTS, "recognized_texts": RECOGNIZED, "embedding_uuids": UUIDS,
}
