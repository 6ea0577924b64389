import csv
import io
import random

import pytest

from reelspan.sources import csv_lines as cl

SHOT = "L1_V1_S000,L1_V1,0,0,100,0,9"
CLIP = "L1V1S000C01,L1_V1_S000,0,100,0,9,25.0,clips/x.mp4"
SCHEMA = "line_id long, file_name string, line_no int, record_kind string, line string"
BIG = str(2**63)


@pytest.mark.parametrize(
    ("kind", "line", "reason"),
    [
        ("shot", SHOT, None),
        ("clip", CLIP, None),
        ("shot", "﻿" + SHOT + "\r", None),
        ("shot", '"a,b",L1_V1,0,0,100," 0 ",9', None),
        ("shot", 'a""b' + SHOT, "quoting"),
        ("shot", '"a"b,v,0,0,100,0,9', "quoting"),
        ("shot", '"a,v,0,0,100,0,9', "quoting"),
        ("shot", "a,v,0,0,100,0", "column_count"),
        ("shot", SHOT + ",", "column_count"),
        ("shot", "", "column_count"),
        ("shot", None, "column_count"),
        ("shot", "a,v,0,0,100,-1,9", "frame_index"),
        ("shot", "a,v,0,0,100,1.0,9", "frame_index"),
        ("shot", "a,v,0,0,100,,9", "frame_index"),
        ("shot", "a,v,0,0,100,٣,9", "frame_index"),
        ("shot", f"a,v,0,0,100,0,{BIG}", "frame_index"),
        ("shot", f"a,v,0,0,100,0,{2**63 - 1}", None),
        ("shot", "a,v,0,0,100,0," + "0" * 40 + "7", None),
        ("shot", "a,v,0,0,100,9,8", "frame_order"),
        ("shot", "a,v,x,y,z, 7 ,\t8", None),
        ("clip", CLIP.replace("L1V1S000C01", "l1v1s000c01"), "clip_id"),
        ("clip", CLIP.replace("L1V1S000C01", "A" * 16), "clip_id"),
        ("clip", CLIP.replace("L1V1S000C01", ""), "clip_id"),
        ("clip", CLIP.replace("L1V1S000C01", " A"), "clip_id"),
        ("clip", CLIP.replace("clips/x.mp4", '"a ""b"", c"'), None),
        ("other", SHOT, "record_kind"),
        (None, SHOT, "record_kind"),
    ],
)
def test_reasons(spark, kind, line, reason):
    df = spark.createDataFrame([(1, "f", 2, kind, line)], SCHEMA)
    assert [r["reason"] for r in cl.parse_lines(df).collect()] == [reason]


def test_header_only_on_first_line(spark):
    head = ",".join(cl.LAYOUT["shot"])
    rows = [(1, "f", 1, "shot", "﻿" + head + "\r"), (2, "f", 2, "shot", head), (3, "g", 1, "clip", head)]
    got = {r["line_id"]: (r["is_header"], r["reason"]) for r in cl.parse_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == (True, None)
    assert got[2] == (False, "frame_index")
    assert got[3][0] is False and got[3][1] is not None


def test_blocks_agree_with_single_lines(spark):
    rng = random.Random(5)
    lines = []
    for i in range(3000):
        buf = io.StringIO()
        csv.writer(buf, quoting=rng.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL]), lineterminator="").writerow([f"s{i}", rng.choice(["v", "a,b", 'q"q']), i, 0, 1, rng.randint(0, 5), rng.randint(0, 5)])
        line = buf.getvalue()
        if rng.random() < 0.1:
            at = rng.randrange(len(line))
            line = line[:at] + rng.choice(['"', ",", "", "x", "\n", "\r"]) + line[at + 1 :]
        lines.append((i, "f", i + 2, "shot", line))
    got = {r["line_id"]: (r["reason"], r["fields"], r["first_frame"]) for r in cl.parse_lines(spark.createDataFrame(lines, SCHEMA)).collect()}
    for i, _, _, kind, line in lines:
        reason, fields, first, _ = cl.diagnose(kind, line)
        assert got[i] == (reason, fields, first)


def test_typed_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "f", 2, "shot", "a,v,x,5,6,7,8"), (2, "f", 3, "clip", CLIP)], SCHEMA)
    shot = cl.loaded(cl.parse_lines(df), "shot").collect()[0]
    assert (shot["shot_index"], shot["start_ms"], shot["start_frame_idx"]) == (None, 5, 7)
    clip = cl.loaded(cl.parse_lines(df), "clip").collect()[0]
    assert (clip["clip_id"], clip["sampling_fps"], clip["end_frame_idx"]) == ("L1V1S000C01", 25.0, 9)
    assert cl.parse_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    wide = df.withColumn("reason", df.line)
    assert cl.rejected(cl.parse_lines(wide)).count() == 0


def test_only_broken_lines_are_read_strictly(spark, monkeypatch):
    import pyarrow as pa

    rng = random.Random(3)
    lines = [CLIP.replace("0,9,25", "9,0,25") if rng.random() < 0.05 else CLIP for _ in range(1000)]
    read = []
    monkeypatch.setattr(cl, "diagnose", lambda kind, line, was=cl.diagnose: (read.append(line), was(kind, line))[1])
    batch = pa.RecordBatch.from_pydict({"line_no": pa.array(range(2, 1002), pa.int32()), "record_kind": ["clip"] * 1000, "line": lines})
    for with_fields in (True, False):
        read.clear()
        (out,) = cl._load(iter([batch]), ["line_no"], with_fields)
        assert len(read) == sum(x != CLIP for x in lines)
        assert [r is not None for r in out.column("reason").to_pylist()] == [x != CLIP for x in lines]
        assert out.column("first_frame").null_count == len(read)
