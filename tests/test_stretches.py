import random

import pytest

from reelspan.operators.stretches import Placed


@pytest.mark.parametrize("hot", [0.0, 0.6])
def test_values_equal_those_of_whole_groups(spark, hot):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < hot else rng.choice(["a", "b", None, "c"]), i * 7 % 400, rng.choice([None, 1, 2, 5])) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, t int, v int")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        got = Placed(df, ["g"], ["t"]).numbered("n", total="all").previous("v", "before").following("v", "after").running("t", "sum").result()
        assert len({r["_p"] for r in Placed(df, ["g"], ["t"]).rows.select("_p").distinct().collect()}) == 7
        got = {(r["g"], r["t"]): (r["v"], r["n"], r["all"], r["before"], r["after"], r["sum"]) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = {}
    for g in {r[0] for r in rows}:
        mine, total = sorted(((r[1], r[2]) for r in rows if r[0] == g), key=lambda x: x[0]), 0
        for i, (t, v) in enumerate(mine):
            total += t
            want[g, t] = (v, i + 1, len(mine), mine[i - 1][1] if i else None, mine[i + 1][1] if i + 1 < len(mine) else None, total)
    assert got == want


def test_empty(spark):
    df = spark.createDataFrame([], "g string, t int")
    assert Placed(df, ["g"], ["t"]).numbered("n").previous("t", "p").result().count() == 0
