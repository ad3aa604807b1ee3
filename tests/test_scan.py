"""Segmented scans against plain loops, with keys over many partitions."""
import math
import random

import pytest

from lotwise.operators.scan import decayed_vectors, segmented_sums


def _timeline(seed, n=1500):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        key = rng.choice(["hot"] * 8 + ["b", "c", None, "d"])
        rows.append((key, rng.randrange(60), rng.randrange(3), rng.choice([None, 1, 2, 5])))
    return rows


@pytest.mark.parametrize("parts", [1, 4, 23])
def test_sums_equal_a_loop(spark, parts):
    rows = _timeline(1)
    df = spark.createDataFrame(rows, "k string, t int, kind int, v int")
    out = segmented_sums(df, ["k"], ["t", "kind"], ["v"], n_partitions=parts).collect()
    assert len(out) == len({r[:3] for r in rows})
    for r in out:
        expected = sum(v or 0 for k, t, kind, v in rows if k == r["k"] and (t, kind) <= (r["t"], r["kind"]))
        assert r["run_v"] == expected


def test_a_busy_time_of_a_busy_key_is_spread(spark):
    """90 % of the rows in one hour of one key: no partition holds most of them."""
    df = spark.range(20_000).selectExpr(
        "'hot' as k", "if(id % 10 = 0, id * 100000, id % 3600) as t", "1 as v")
    out = segmented_sums(df, ["k"], ["t"], ["v"], n_partitions=16)
    assert out.agg({"run_v": "max"}).first()[0] == 20_000
    from lotwise.operators.scan import _ranged
    sizes = [r["count"] for r in _ranged(df.distinct(), ["k", "t"], 16).groupBy("__part").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_empty_timeline(spark):
    df = spark.createDataFrame([], "k string, t int, v int")
    assert segmented_sums(df, ["k"], ["t"], ["v"]).count() == 0


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_decayed_vectors_equal_direct_profiles(spark, parts):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        key = rng.choice(["hot"] * 6 + ["b", None])
        if rng.random() < 0.3:
            rows.append((key, float(rng.randrange(40)), None, None, f"s{i}"))
        else:
            rows.append((key, float(rng.randrange(40)), [rng.randrange(4), 2], [rng.random(), 1.5], None))
    df = spark.createDataFrame(rows, "key string, time double, places array<int>, amounts array<double>, tag string")
    out = {r["tag"]: r for r in decayed_vectors(df, 5, 0.7, "tag", n_partitions=parts).collect()}
    assert set(out) == {r[4] for r in rows if r[4]}
    for key, time, _, _, tag in rows:
        if tag:
            expected = [0.0] * 5
            for k, t, places, amounts, _ in rows:
                if k == key and t <= time and places:
                    for p, a in zip(places, amounts):
                        expected[p] += a * math.exp(-0.7 * (time - t))
            assert all(abs(x - y) < 1e-9 for x, y in zip(out[tag]["vector"], expected))


def test_decay_over_decades_stays_finite(spark):
    rows = [("u", 0.0, [0], [1.0], None), ("u", 40_000.0, [1], [1.0], None), ("u", 40_001.0, None, None, "s")]
    df = spark.createDataFrame(rows, "key string, time double, places array<int>, amounts array<double>, tag string")
    vector = decayed_vectors(df, 2, 0.5, "tag").first()["vector"]
    assert vector[0] == 0.0 and abs(vector[1] - math.exp(-0.5)) < 1e-12
