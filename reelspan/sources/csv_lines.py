"""Loading physical CSV lines as shots and clips, with broken lines kept apart.

The lines of a batch are parsed into Arrow columns at once; a line of another shape leaves a
hole in them. A block of lines fails if it has a hole, if its frame indexes do not fit a
64-bit column or if an end lies below its start; it is then halved, and its halves again,
until each broken line stands alone. Only these lines are diagnosed, by a strict
character-level reading, which has the last word. Lines stay in Arrow arrays all the way, no
shuffle takes place and no line is dropped.

Defined cases: a null or empty line has a wrong column count; an unknown or null
record_kind is a fault of its own; a header line (line_no 1, exact text) loads nothing
and is no fault; one byte order mark at the start and one carriage return at the end are
removed; blanks around frame indexes are spaces and tabs; several faults give the first
in the order quoting, column_count, clip_id, frame_index, frame_order; extra columns are
ignored; repeated lines are all returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Field names by record kind, in the order of the file.
LAYOUT = {
    "shot": ("shot_id", "video_id", "shot_index", "start_ms", "end_ms", "start_frame_idx", "end_frame_idx"),
    "clip": ("clip_id", "shot_id", "start_ms", "end_ms", "start_frame_idx", "end_frame_idx", "sampling_fps", "clip_path"),
}
BLOCK_LINES = 256
_FIELD = r'(?:"(?:[^"]|"")*"|[^",]*)'
_NUMBER = r'(?:"[ \t]*[0-9]+[ \t]*"|[ \t]*[0-9]+[ \t]*)'
_SHAPE = {"start_frame_idx": _NUMBER, "end_frame_idx": _NUMBER, "clip_id": r'(?:"[A-Z0-9]{1,15}"|[A-Z0-9]{1,15})'}


def _pattern(kind: str, named: tuple[str, ...]) -> str:
    """A whole sound line of a kind, with groups for the columns ``named``."""
    return r"(?s)\A" + ",".join(f"({'?P<' + n + '>' if n in named else '?:'}{_SHAPE.get(n, _FIELD)})" for n in LAYOUT[kind]) + r"\z"


_FRAMES = ("start_frame_idx", "end_frame_idx")
_BOUNDS, _COLUMNS = ({kind: _pattern(kind, names if named is None else named) for kind, names in LAYOUT.items()} for named in (_FRAMES, None))
_DIGITS = re.compile(r"[ \t]*([0-9]+)[ \t]*")
_CLIP_ID = re.compile(r"[A-Z0-9]{1,15}")


def split_strict(line: str) -> list[str] | None:
    """Fields of a line, or None where a quote encloses anything but a whole field."""
    fields, at, n = [], 0, len(line)
    while True:
        if at < n and line[at] == '"':
            at, parts = at + 1, []
            while True:
                close = line.find('"', at)
                if close < 0:
                    return None
                parts.append(line[at:close])
                if line[close + 1 : close + 2] == '"':
                    parts.append('"')
                    at = close + 2
                    continue
                at = close + 1
                break
            if at < n and line[at] != ",":
                return None
            fields.append("".join(parts))
        else:
            stop = line.find(",", at)
            stop = n if stop < 0 else stop
            if '"' in line[at:stop]:
                return None
            fields.append(line[at:stop])
            at = stop
        if at >= n:
            return fields
        at += 1


def diagnose(kind: str | None, line: str | None) -> tuple[str | None, list[str] | None, int | None, int | None]:
    """(reason or None, fields, start frame, end frame) of one cleaned line."""
    if kind not in LAYOUT:
        return "record_kind", None, None, None
    if line is None:
        return "column_count", None, None, None
    fields = split_strict(line)
    if fields is None:
        return "quoting", None, None, None
    names = LAYOUT[kind]
    if len(fields) != len(names):
        return "column_count", None, None, None
    if kind == "clip" and not _CLIP_ID.fullmatch(fields[0]):
        return "clip_id", None, None, None
    bounds = []
    for name in _FRAMES:
        m = _DIGITS.fullmatch(fields[names.index(name)])
        digits = m and (m[1].lstrip("0") or "0")
        if not digits or len(digits) > 19 or int(digits) >= 1 << 63:
            return "frame_index", None, None, None
        bounds.append(int(digits))
    if bounds[1] < bounds[0]:
        return "frame_order", None, None, None
    return None, fields, bounds[0], bounds[1]


def _unquoted(column: pa.Array) -> pa.Array:
    if not pc.any(pc.starts_with(column, '"')).as_py():
        return column
    inner = pc.replace_substring(pc.utf8_slice_codeunits(column, 1, -1), '""', '"')
    return pc.if_else(pc.starts_with(column, '"'), inner, column)


def _parsed(kind: str, lines: pa.Array, with_fields: bool) -> dict[str, pa.Array]:
    """The columns of lines of one kind (all, or the frame indexes only), null where a line has another shape."""
    found = pc.extract_regex(lines, (_COLUMNS if with_fields else _BOUNDS)[kind])
    columns = dict(zip(LAYOUT[kind] if with_fields else _FRAMES, map(_unquoted, found.flatten())))
    return columns | {f"trimmed_{n}": pc.ascii_trim(columns[n], " \t") for n in _FRAMES}


def _bounds(columns: dict[str, pa.Array], at: int, n: int) -> tuple[pa.Array, pa.Array] | None:
    """The frame indexes of a block of parsed lines if every line is sound, else None."""
    first, last = (columns[f"trimmed_{c}"].slice(at, n) for c in _FRAMES)
    if first.null_count:
        return None
    try:
        first, last = first.cast(pa.int64()), last.cast(pa.int64())
    except pa.ArrowInvalid:
        return None
    return (first, last) if pc.all(pc.less_equal(first, last)).as_py() else None


def _field_lists(columns: list[pa.Array]) -> pa.Array:
    """One list of fields per line."""
    wide, n = len(columns), len(columns[0])
    flat = pa.concat_arrays(columns).take(pa.array(np.arange(wide * n).reshape(wide, n).T.ravel()))
    return pa.ListArray.from_arrays(pa.array(np.arange(0, wide * n + 1, wide), pa.int32()), flat)


def _load(batches: Iterator[pa.RecordBatch], keep: list[str], with_fields: bool) -> Iterator[pa.RecordBatch]:
    lists = pa.list_(pa.string())
    for batch in batches:
        n, kinds = batch.num_rows, batch.column("record_kind")
        lines = pc.replace_substring_regex(batch.column("line"), "\\A\ufeff", "")
        lines = pc.replace_substring_regex(lines, r"\r\z", "")
        top = pc.fill_null(pc.equal(batch.column("line_no"), 1), False)
        header = pa.array(np.zeros(n, bool))
        # pieces of the result and the rows they belong to
        rows: list[np.ndarray] = []
        reasons: list[pa.Array] = []
        fields: list[pa.Array] = []
        bounds: list[tuple[pa.Array, pa.Array]] = []

        def add(at: np.ndarray, reason: pa.Array, found: pa.Array, first: pa.Array, last: pa.Array) -> None:
            rows.append(at)
            reasons.append(reason)
            fields.append(found)
            bounds.append((first, last))

        def strictly(kind: str | None, at: np.ndarray, part: pa.Array) -> None:
            got = [diagnose(kind, line) for line in part.to_pylist()]
            cols = [pa.array([g[i] for g in got], t) for i, t in enumerate((pa.string(), lists, pa.int64(), pa.int64()))]
            add(at, *cols)

        known = np.zeros(n, bool)
        for kind, names in LAYOUT.items():
            mine = pc.fill_null(pc.equal(kinds, kind), False)
            head = pc.and_(pc.and_(mine, top), pc.fill_null(pc.equal(lines, ",".join(names)), False))
            header = pc.or_(header, head)
            known |= mine.to_numpy(zero_copy_only=False)
            at = np.flatnonzero(pc.and_not(mine, head).to_numpy(zero_copy_only=False))
            mine_lines = lines.take(pa.array(at))
            todo = [(lo, min(lo + BLOCK_LINES, len(at))) for lo in range(0, len(at), BLOCK_LINES)]
            columns = _parsed(kind, mine_lines, with_fields)
            while todo:
                lo, hi = todo.pop()
                sound = _bounds(columns, lo, hi - lo)
                if sound is not None:
                    found = _field_lists([columns[n].slice(lo, hi - lo) for n in names]) if with_fields else pa.nulls(hi - lo, lists)
                    add(at[lo:hi], pa.nulls(hi - lo, pa.string()), found, *sound)
                elif hi - lo > 1:
                    half = (lo + hi) // 2
                    todo += [(lo, half), (half, hi)]
                else:
                    strictly(kind, at[lo:hi], mine_lines.slice(lo, 1))
        rest = np.flatnonzero(~known)
        if len(rest):
            strictly(None, rest, lines.take(pa.array(rest)))
        heads = np.flatnonzero(header.to_numpy(zero_copy_only=False))
        empty = pa.nulls(len(heads), pa.int64())
        add(heads, pa.nulls(len(heads), pa.string()), pa.nulls(len(heads), lists), empty, empty)
        back = pa.array(np.argsort(np.concatenate(rows), kind="stable"))
        made = [pa.concat_arrays(x).take(back) for x in (reasons, fields, [f for f, _ in bounds], [t for _, t in bounds])]
        if not with_fields:
            del made[1]
        names = keep + ["is_header", "reason", *(["fields"] if with_fields else []), "first_frame", "last_frame"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [header] + made, names=names)


def parse_lines(lines: DataFrame, *, with_fields: bool = True) -> DataFrame:
    """line_id, file_name, line_no, record_kind, line and: is_header, reason (null: sound),
    fields (unless left out), first_frame, last_frame."""
    keep = ["line_id", "file_name", "line_no", "record_kind", "line"]
    src = lines.select(*keep)
    kinds = dict(src.dtypes)
    made = "is_header boolean, reason string, " + ("fields array<string>, " if with_fields else "") + "first_frame long, last_frame long"
    schema = ", ".join(f"{c} {kinds[c]}" for c in keep) + ", " + made
    return src.mapInArrow(lambda b: _load(b, keep, with_fields), schema)


def loaded(parsed: DataFrame, kind: str) -> DataFrame:
    """The sound lines of one kind as typed columns; unchecked numbers that are none become null."""
    names = LAYOUT[kind]
    rows = parsed.where(F.col("reason").isNull() & ~F.col("is_header") & (F.col("record_kind") == kind))
    number = {"shot_index": "int", "start_ms": "long", "end_ms": "long", "sampling_fps": "double"}
    cols = []
    for i, n in enumerate(names):
        if n == "start_frame_idx":
            cols.append(F.col("first_frame").alias(n))
        elif n == "end_frame_idx":
            cols.append(F.col("last_frame").alias(n))
        else:
            f = F.col("fields")[i]
            cols.append((f.try_cast(number[n]) if n in number else f).alias(n))
    return rows.select("line_id", *cols)


def rejected(parsed: DataFrame) -> DataFrame:
    """The lines that do not load, with the reason."""
    return parsed.where(F.col("reason").isNotNull()).select("line_id", "file_name", "line_no", "record_kind", "line", "reason")
