import math
import random

import pytest

from crowdpulse.functions.timegrid import last_slot, parse_utc, slot_index
from crowdpulse.operators.timegrid import Running, periodic_snapshot, sliding_sum, time_bounds


def test_slots_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(t,) for t in range(-25, 40)], "ts_s long")
    for r in df.select("ts_s", slot_index("ts_s", 5, 10).alias("k")).collect():
        assert r.k == math.ceil((r.ts_s - 5) / 10) == last_slot(r.ts_s, 5, 10)


def test_times(spark):
    df = spark.createDataFrame([
        ("2019-04-02T00:05:00Z",), ("2021-06-17T05:40:00.999Z",), ("yesterday",), (None,), ("2019-04-02 00:05:00",),
    ], "t string")
    assert [r[0] for r in df.select(parse_utc("t")).collect()] == [1554163500, 1623908400, None, None, None]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_snapshot_and_sliding_sum_against_model(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("aab"), 100 + rng.randrange(500), rng.randrange(9)) for _ in range(80)]
    df = spark.createDataFrame(rows, "g string, ts_s long, v long")
    origin, until = time_bounds(df, None)
    assert (origin, until) == (min(t for _, t, _ in rows), max(t for _, t, _ in rows))
    every, stop = 30, math.ceil((until - origin) / 30)
    ticks = [origin + every * k for k in range(1, stop + 1)]
    aggs = [Running("n", "count"), Running("s", "sum", "v"), Running("lo", "min", "v"), Running("hi", "max", "v")]
    got = periodic_snapshot(df, ["g"], aggs, every, origin, until).collect()
    expected = []
    for tick in ticks:
        for g in "ab":
            vs = [v for h, t, v in rows if h == g and t <= tick]
            if vs:
                expected.append((tick, g, len(vs), sum(vs), min(vs), max(vs)))
    assert sorted(tuple(r) for r in got) == sorted(expected)
    got = sliding_sum(df, ["g"], {"s": "v"}, every, 4 * every, origin, until).collect()
    expected = []
    for tick in ticks:
        for g in "ab":
            vs = [v for h, t, v in rows if h == g and tick - 4 * every < t <= tick]
            if vs:
                expected.append((tick, g, sum(vs)))
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_window_must_fit_the_step(spark):
    with pytest.raises(ValueError):
        sliding_sum(spark.range(1), ["id"], {}, 7, 10, 0, 1)
