import glob
import os
import subprocess
import sys

import pytest

DATA = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_names_and_core_without_the_subpackage():
    code = (
        "import sys; sys.modules['reelspan.llm'] = None; import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); "
        "assert set(o) <= set(q) and 'p1_found' in q and 'p6_found' in q; "
        "assert not any(n.startswith(('p3_', 'p4_', 'p5_', 'p7_', 'p8_', 'p9_')) for n in q)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def rows_of(frame):
    def cell(x):
        if x is None or str(x) in ("<NA>", "NaT", "nan"):
            return "~"
        return f"{x:.5f}" if isinstance(x, float) else str(x)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", ["p1_found", "p2_found", "p6_found", "p6_periods", "clip_frame_bounds", "short_shot_merge", "coverage_weights", "asof_nearest_frame", "frame_shot_assignment", "bm25_search", "reading_order", "stream_sessions", "canonical_classes"])
def test_query_beside_sql(spark, name):
    import duckdb

    from reelspan import registry

    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    mine = registry.queries()[name](spark, DATA).toPandas()
    theirs = con.execute(registry.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows_of(mine) == rows_of(theirs)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_flagship(spark):
    from reelspan import registry

    assert registry.flagship(spark, DATA).count() > 0
