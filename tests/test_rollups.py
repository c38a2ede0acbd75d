"""Percentiles by counting against sorted values: hot groups, repeats, very wide ranges, nulls."""

import math
import random

import pytest

from meshloom.operators import rollups


def slow(values, share):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    at = share * (len(v) - 1)
    lo, hi = math.floor(at), math.ceil(at)
    return v[lo] if lo == hi else v[lo] * (hi - at) + v[hi] * (at - lo)


@pytest.fixture(scope="module")
def groups():
    r = random.Random(3)
    return {
        "hot": [r.gauss(0, 1) for _ in range(4000)], "same": [2.5] * 300, "mostly": [1.0] * 500 + [r.random() for _ in range(300)], "wide": [r.choice([-1, 1]) * 10 ** r.uniform(-6, 6) for _ in range(200)],
        "ends": [-1.7e308, 1.7e308, 1.6e308, -1.6e308, 1.5e308], "one": [7.0], None: [1.0, 2.0, None, float("nan")], "close": [1.0, math.nextafter(1.0, 2)] * 20, "nothing": [None, float("nan")],
    }


def test_exact_percentiles_equal_sorted_values(spark, groups):
    rows = spark.createDataFrame([(g, x) for g, v in groups.items() for x in v], "dataset string, x double").repartition(5)
    shares = [0.0, 0.5, 0.95, 1.0]
    got = {(r.dataset, r.share): r.p for r in rollups.exact_percentiles(rows, "dataset", "x", shares).collect()}
    assert set(got) == {(g, s) for g in groups if g != "nothing" for s in shares}
    for (g, s), p in got.items():
        assert p == pytest.approx(slow(groups[g], s), rel=1e-12), (g, s)


def test_statistics_are_the_same_whichever_way_they_are_found(spark, groups):
    rows = spark.createDataFrame([(a, b) for a, b in zip(groups["hot"], groups["mostly"] * 5, strict=True)], "a double, b double")
    held, counted = ({r.metric: tuple(r) for r in rollups.stage_stats(rows, ["a", "b"], held).collect()} for held in (10**7, 10))
    assert held.keys() == counted.keys() == {"a", "b"} and all(x == pytest.approx(y) for m in held for x, y in zip(held[m][1:], counted[m][1:], strict=True))
    table = spark.createDataFrame([(g, x) for g, v in groups.items() for x in v if g != "wide" and (x is None or x == x)], "dataset string, x double")
    plain, passes = ({r.dataset: r.p for r in rollups.percentile(table, "dataset", "x", 0.95, held).collect()} for held in (10**7, 10))
    assert plain.keys() == passes.keys() and plain["nothing"] is passes["nothing"] is None and all(passes[g] == pytest.approx(p) for g, p in plain.items() if p is not None)
    assert rollups.exact_percentiles(rows.limit(0), "a", "b", [0.5]).collect() == []
