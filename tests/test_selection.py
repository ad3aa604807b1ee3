"""Exact quantiles against Spark's own percentile."""
import random

import pytest
from pyspark.sql import functions as F

from lotwise.operators.selection import exact_quantiles, group_quantiles

QS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]


def _rows(seed, n):
    rng = random.Random(seed)
    return [(rng.choice(["hot"] * 8 + ["b", None, "single"]), rng.choice([rng.gauss(0, 1e6), float(rng.randrange(5)), None]),
             10.0 ** rng.randrange(-300, 300), 7.0, rng.randrange(3), None) for _ in range(n)]


SCHEMA = "g string, x double, wide double, same double, few int, none double"


@pytest.mark.parametrize("n", [1, 2, 7, 4000])
def test_equals_percentile(spark, n):
    df = spark.createDataFrame(_rows(n, n), SCHEMA).repartition(5)
    columns = ["x", "wide", "same", "few", "none"]
    out = exact_quantiles(df, columns, QS)
    for c in columns:
        expected = df.agg(F.percentile(c, F.array(*map(F.lit, QS)))).first()[0]
        assert out[c] == ([None] * len(QS) if expected is None else pytest.approx(expected, rel=1e-12))


def test_groups_equal_percentile(spark):
    df = spark.createDataFrame(_rows(3, 3000) + [("empty", None, 1.0, 1.0, 1, None)], SCHEMA).repartition(6)
    names = {"low": 0.1, "mid": 0.5, "high": 0.9}
    for by in (["g"], ["g", "few"]):
        out = {tuple(r[b] for b in by): tuple(r[n] for n in names)
               for r in group_quantiles(df, by, "x", names).collect()}
        expected = {tuple(r[b] for b in by): tuple(r[n] for n in names) for r in df.groupBy(*by).agg(
            *[F.percentile("x", q).alias(n) for n, q in names.items()]).collect()}
        assert set(out) == set(expected)
        for key, values in expected.items():
            assert out[key] == (values if values[0] is None else pytest.approx(values, rel=1e-12))


def test_a_row_has_one_entry_per_column_however_many_ranks_are_wanted(spark):
    from lotwise.operators import selection as Q
    ranges = [(4, 0.0, 1.0), (5, 2.0, 3.0), (6, 10.0, 20.0)]
    rows = spark.createDataFrame([(-1.0,), (0.5,), (1.5,), (3.0,), (20.0,), (21.0,), (None,)], "v double")
    found = [tuple(r["e"])[:2] for r in rows.select(Q._entry(F.col("v"), ranges).alias("e")).collect()]
    assert [r for r, _ in found] == [None, 4, None, 5, 6, None, None]
    assert [b for r, b in found if r is not None] == [512, 1023, 1023]
