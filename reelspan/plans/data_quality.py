"""Queries and oracle SQL of the core data problems."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan.operators import intervals, references
from reelspan.session import table
from reelspan.sources import csv_lines


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    parts = [references.orphan_references(table(spark, d, r.child_table), table(spark, d, r.parent_table), r) for r in references.MEDIA_REFERENCES]
    return reduce(DataFrame.unionByName, parts)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("child_table", "child_key").distinct()


def p1_orphan_counts(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_report(_orphans(spark, d))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return csv_lines.rejected(csv_lines.parse_lines(table(spark, d, "raw_line"), with_fields=False)).select("line_id")


def p2_reject_counts(spark: SparkSession, d: str) -> DataFrame:
    bad = csv_lines.rejected(csv_lines.parse_lines(table(spark, d, "raw_line"), with_fields=False))
    return bad.groupBy("file_name", "record_kind", "reason").agg(F.count("*").alias("lines"))


def p2_loaded_shots(spark: SparkSession, d: str) -> DataFrame:
    return csv_lines.loaded(csv_lines.parse_lines(table(spark, d, "raw_line")), "shot")


def p2_loaded_clips(spark: SparkSession, d: str) -> DataFrame:
    return csv_lines.loaded(csv_lines.parse_lines(table(spark, d, "raw_line")), "clip")


def _kinds(spark: SparkSession, d: str, op, *cols: str) -> DataFrame:
    parts = [op(table(spark, d, t), e).select(F.lit(k).alias("interval_kind"), F.col("entity").alias("entity_id"), *cols) for k, t, e in (("shot", "shot", "video_id"), ("clip", "clip_record", "shot_id"))]
    return parts[0].unionByName(parts[1])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _kinds(spark, d, intervals.interval_gaps, F.col("gap_start").alias("gap_start_ms"), F.col("gap_end").alias("gap_end_ms"))


def p6_periods(spark: SparkSession, d: str) -> DataFrame:
    return _kinds(spark, d, intervals.continuous_periods, F.col("period_start").alias("period_start_ms"), F.col("period_end").alias("period_end_ms"))


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_orphan_counts, p2_found, p2_reject_counts, p2_loaded_shots, p2_loaded_clips, p6_found, p6_periods)}


def _orphan_sql() -> str:
    parts = []
    for r in references.MEDIA_REFERENCES:
        parts.append(f"""SELECT '{r.child_table}' AS child_table, c.k AS child_key, c.fk, c.t,
          CASE WHEN p.pk IS NULL THEN 'missing' WHEN p.gone THEN 'withdrawn' ELSE 'late' END AS reason
        FROM (SELECT CAST({r.child_key} AS VARCHAR) AS k, {r.fk} AS fk, min(ingested_at) AS t FROM {r.child_table} WHERE {r.fk} IS NOT NULL GROUP BY 1, 2) c
        LEFT JOIN (SELECT {r.parent_key} AS pk, min(ingested_at) AS t, arg_max(deleted_at IS NOT NULL, ingested_at) AS gone FROM {r.parent_table} GROUP BY 1) p ON c.fk = p.pk
        WHERE p.pk IS NULL OR p.gone OR p.t > c.t""")
    return " UNION ALL ".join(parts)


_F = r'(?:[^",]*|"(?:[^"]|"")*")'
_N = r'(?:[ \t]*[0-9]+[ \t]*|"[ \t]*[0-9]+[ \t]*")'


def _lines_sql() -> str:
    """Raw lines with the verdict of regular expressions alone."""
    digits = lambda c: f"ltrim(regexp_replace({c}, '[^0-9]', '', 'g'), '0')"
    small = lambda c: f"(length({digits(c)}) < 19 OR length({digits(c)}) = 19 AND {digits(c)} <= '9223372036854775807')"
    le = lambda a, b: f"(length({digits(a)}) < length({digits(b)}) OR length({digits(a)}) = length({digits(b)}) AND {digits(a)} <= {digits(b)})"
    return rf"""
    WITH t AS (SELECT *, regexp_replace(regexp_replace(line, '^\x{{FEFF}}', ''), '\r\z', '') AS s FROM raw_line),
    u AS (SELECT *, CASE record_kind
        WHEN 'shot' THEN regexp_extract(s, '(?s)\A{_F},{_F},{_F},{_F},{_F},({_N}),({_N})\z', ['a', 'b'])
        WHEN 'clip' THEN regexp_extract(s, '(?s)\A(?:[A-Z0-9]{{1,15}}|"[A-Z0-9]{{1,15}}"),{_F},{_F},{_F},({_N}),({_N}),{_F},{_F}\z', ['a', 'b']) END AS m,
        coalesce(line_no = 1 AND s = CASE record_kind WHEN 'shot' THEN 'shot_id,video_id,shot_index,start_ms,end_ms,start_frame_idx,end_frame_idx'
          WHEN 'clip' THEN 'clip_id,shot_id,start_ms,end_ms,start_frame_idx,end_frame_idx,sampling_fps,clip_path' END, false) AS header FROM t),
    v AS (SELECT *, coalesce(m.a <> '' AND {small('m.a')} AND {small('m.b')} AND {le('m.a', 'm.b')}, false) AS sound FROM u)
    """


def _loaded_sql(kind: str) -> str:
    names = csv_lines.LAYOUT[kind]
    groups = ",".join([f"({_F})"] * len(names))
    keys = ", ".join(f"'c{i}'" for i in range(len(names)))
    un = lambda i: rf"""CASE WHEN f.c{i} LIKE '"%' THEN replace(substr(f.c{i}, 2, length(f.c{i}) - 2), '""', '"') ELSE f.c{i} END"""
    types = {"shot_index": "INTEGER", "start_ms": "BIGINT", "end_ms": "BIGINT", "sampling_fps": "DOUBLE", "start_frame_idx": "BIGINT", "end_frame_idx": "BIGINT"}
    cols = ", ".join(f"TRY_CAST({un(i)} AS {types[n]}) AS {n}" if n in types else f"{un(i)} AS {n}" for i, n in enumerate(names))
    return rf"""{_lines_sql()}, w AS (SELECT line_id, regexp_extract(s, '(?s)\A{groups}\z', [{keys}]) AS f FROM v WHERE sound AND NOT header AND record_kind = '{kind}')
    SELECT line_id, {cols} FROM w"""


def _reasons_sql() -> str:
    """Rejects by the first fault in the documented order."""
    small = "(length(x) < 19 OR length(x) = 19 AND x <= '9223372036854775807')"
    return rf"""{_lines_sql()}, r AS (SELECT v.*, CASE WHEN record_kind = 'shot' THEN 7 WHEN record_kind = 'clip' THEN 8 END AS wide FROM v WHERE NOT sound AND NOT header),
    k AS (SELECT *, CASE WHEN wide IS NULL THEN 'record_kind' WHEN s IS NULL THEN 'column_count' WHEN NOT regexp_matches(s, '(?s)\A{_F}(,{_F})*\z') THEN 'quoting'
        WHEN NOT regexp_matches(s, CASE wide WHEN 7 THEN '(?s)\A{_F}(,{_F}){{6}}\z' ELSE '(?s)\A{_F}(,{_F}){{7}}\z' END) THEN 'column_count'
        WHEN wide = 8 AND NOT regexp_matches(s, '\A([A-Z0-9]{{1,15}}|"[A-Z0-9]{{1,15}}"),') THEN 'clip_id'
        WHEN m.a = '' OR NOT {small.replace("x", "ltrim(regexp_replace(m.a, '[^0-9]', '', 'g'), '0')")} OR NOT {small.replace("x", "ltrim(regexp_replace(m.b, '[^0-9]', '', 'g'), '0')")} THEN 'frame_index' ELSE 'frame_order' END AS reason FROM r)
    SELECT file_name, record_kind, reason, count(*) AS lines FROM k GROUP BY 1, 2, 3"""


def _runs_sql() -> str:
    return """
    WITH i AS (SELECT 'shot' AS k, video_id AS e, start_ms AS s, end_ms AS t FROM shot WHERE video_id IS NOT NULL AND end_ms > start_ms
      UNION ALL SELECT 'clip', shot_id, start_ms, end_ms FROM clip_record WHERE shot_id IS NOT NULL AND end_ms > start_ms),
    o AS (SELECT *, max(t) OVER (PARTITION BY k, e ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM i)
    """


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"SELECT DISTINCT child_table, child_key FROM ({_orphan_sql()})",
        "p1_orphan_counts": f"SELECT child_table, strftime(date_trunc('month', t), '%Y-%m-%d') AS period, reason, count(*) AS orphan_rows, count(DISTINCT fk) AS orphan_keys FROM ({_orphan_sql()}) GROUP BY 1, 2, 3",
        "p2_found": f"{_lines_sql()} SELECT line_id FROM v WHERE NOT sound AND NOT header",
        "p2_reject_counts": _reasons_sql(),
        "p2_loaded_shots": _loaded_sql("shot"),
        "p2_loaded_clips": _loaded_sql("clip"),
        "p6_found": f"{_runs_sql()} SELECT k AS interval_kind, e AS entity_id, b AS gap_start_ms, s AS gap_end_ms FROM o WHERE s > b",
        "p6_periods": f"{_runs_sql()}, n AS (SELECT *, sum(CASE WHEN b IS NULL OR s > b THEN 1 ELSE 0 END) OVER (PARTITION BY k, e ORDER BY s, t ROWS UNBOUNDED PRECEDING) AS p FROM o) SELECT k AS interval_kind, e AS entity_id, min(s) AS period_start_ms, max(t) AS period_end_ms FROM n GROUP BY k, e, p",
    }
