"""Sessions against a walk over the sorted rows, for any width of the stretches."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from compare import bag
from loamflow.operators.sessions import sessions

START = datetime(2024, 1, 1)


def walk(rows, gap):
    by_key = defaultdict(list)
    for k, s, v in rows:
        if s is not None:
            by_key[k].append((s, v))
    out = []
    for k, own in by_key.items():
        own.sort()
        groups = [[own[0]]]
        for row in own[1:]:
            if row[0] - groups[-1][-1][0] >= gap:
                groups.append([])
            groups[-1].append(row)
        out += [(k, START + timedelta(seconds=g[0][0]), START + timedelta(seconds=g[-1][0]), len(g), sum(v for _, v in g)) for g in groups]
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [10, 25, 60, 100_000])
@pytest.mark.parametrize("top", [150, 3000])
def test_sessions(spark, width, top):
    rng = random.Random(width + top)
    rows = [(rng.choice(["hot", "hot", "hot", "x", None]), None if rng.random() < 0.03 else rng.randrange(-top, top), rng.randrange(9))
            for _ in range(400)]
    df = spark.createDataFrame([(k, None if s is None else START + timedelta(seconds=s), v) for k, s, v in rows],
                               "k STRING, ts TIMESTAMP_NTZ, v LONG")
    assert bag(sessions(df, ["k"], "ts", 10, ["v"], width)) == walk(rows, 10)


def test_one_long_session_and_none(spark):
    df = spark.sql("SELECT 'hot' AS k, TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts FROM range(5000)")
    (row,) = sessions(df, ["k"], "ts", 5, width_seconds=5).collect()
    assert (row.n_rows, row.session_end - row.session_start) == (5000, timedelta(seconds=4999))
    assert sessions(df.limit(0), ["k"], "ts", 5).count() == 0
