import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveyloom.operators import ordered as O


def frame(spark, values, group="g"):
    return spark.createDataFrame([(group, v) for v in values], "variable string, value double")


PROBS = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [5.0] * 7, [0.0, -0.0, 0.0], [-3.0, -2.5, 0.0, 1e-300, 1e300, 7.0],
    [1e9 + i * 1e-3 for i in range(50)], [float(i % 3) for i in range(100)] + [1e6]])
def test_quantiles_are_exact(spark, values):
    row = O.exact_quantiles(frame(spark, values), ["variable"], "value", PROBS).first()
    for k, p in PROBS.items():
        assert row[k] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e12, 1e12, allow_nan=False), min_size=1, max_size=60))
def test_quantiles_property(spark, values):
    row = O.exact_quantiles(frame(spark, values), ["variable"], "value", {"q": 0.3}).first()
    assert row["q"] == pytest.approx(np.quantile(values, 0.3), rel=1e-9, abs=1e-9)


def test_quantiles_skip_missing_and_split_groups(spark):
    df = frame(spark, [1.0, 3.0, None, float("nan")]).unionByName(frame(spark, [10.0], "h"))
    got = {r["variable"]: r["m"] for r in O.exact_quantiles(df, ["variable"], "value", {"m": 0.5}).collect()}
    assert got == {"g": 2.0, "h": 10.0}


def test_cells_are_monotone(spark):
    rng = random.Random(3)
    values = sorted([rng.uniform(-1, 1) * 10 ** rng.randint(-20, 20) for _ in range(500)] + [0.0])
    cells = [r[1] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
             .select("i", O.value_cell(F.col("v"))).orderBy("i").collect()]
    assert cells == sorted(cells)


def test_rank_min_with_hot_value_and_missing(spark):
    values = [5.0] * 50 + [7.0, 9.0, 1.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    got = {r["id"]: r["r"] for r in O.rank_min(df, "v", "r").collect()}
    assert len(got) == len(values)
    assert got[51] == 1 and got[50] == 2 and got[0] == got[49] == 3 and got[52] == 53 and got[53] is None


def test_hashed_position_is_a_permutation_and_stable(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("g"))
    a = {r["id"]: r["p"] for r in O.hashed_position(df, ["g"], ["id"], 1, "p").collect()}
    b = {r["id"]: r["p"] for r in O.hashed_position(df.repartition(5), ["g"], ["id"], 1, "p").collect()}
    assert a == b
    assert sorted(p for i, p in a.items() if i % 3 == 0) == list(range(1, 335))


def test_first_per_group_puts_missing_last(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "d")], "k int, o int, v string")
    got = {r["k"]: r["v"] for r in O.first_per_group(df, ["k"], ["o", "v"]).collect()}
    assert got == {1: "b", 2: "d"}


def test_best_per_objective(spark):
    df = spark.createDataFrame([("a", 0.9, 0.1), ("b", 0.5, 0.4), ("c", 0.5, 0.4), ("d", None, 0.9)],
                               "m string, recall double, precision double")
    got = {r["objective"]: r["m"] for r in O.best_per_objective(df, [
        {"label": "recall", "where": F.col("precision") >= 0.25, "by": ["recall", "precision"]},
        {"label": "any", "by": ["recall"]}, {"label": "none", "where": F.col("recall") > 2, "by": ["recall"]}], ["m"]).collect()}
    assert got == {"recall": "b", "any": "a"}


def test_top_k_exclusive_equals_greedy(spark):
    rng = random.Random(5)
    items = [f"v{i}" for i in range(30)]
    groups = [items[0:3], items[10:12], items[20:25]]
    scored = [(v, rng.randint(1, 12)) for v in items]
    got = [r["v"] for r in O.top_k_exclusive(spark.createDataFrame(scored, "v string, r int"), "v", "r", groups, 18).collect()]
    want, used = [], set()
    for v, _ in sorted(scored, key=lambda x: (x[1], x[0])):
        if not any(v in g and (set(g) - {v}) & used for g in groups):
            want.append(v)
            used.add(v)
    assert got == want[:18]


def test_share_and_mean_rank(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0), ("c", 4.0, 1.0)], "v string, x double, y double")
    assert [round(r["share"], 4) for r in O.share(df, "x").orderBy("v").collect()] == [0.125, 0.375, 0.5]
    assert [r["mean_rank"] for r in O.mean_rank(df, "x", "y").orderBy("v").collect()] == [2.0, 1.5, 2.0]


def sizes(df):
    """Rows of each slot."""
    return sorted(r["count"] for r in df.groupBy("_slot").count().collect())


@pytest.mark.parametrize("build", [
    lambda i: F.lit(1_700_000_000) + i,                                        # epoch seconds
    lambda i: F.format_string("Customer#%09d", i),                             # names with one prefix
    lambda i: F.when(i % 3 == 0, F.lit(5)).otherwise(i),                       # one value on a third of all rows
    lambda i: F.lit(2.0) ** (i % 50) + i / 7])
def test_slots_are_even_whatever_the_values(spark, build):
    df = spark.range(200_000, numPartitions=8).select("id", build(F.col("id")).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = sizes(O.slotted(df, [], [F.col("v").desc(), F.xxhash64("id", "v")]))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == 8 and sum(found) == 200_000 and found[-1] < 2 * 25_000


def test_ranks_and_totals_across_slots(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice(["a", "b", None]), rng.choice([1.0, 1.0, 1.0, 2.0, 3.0, float(k % 40), None, float("nan")])) for k in range(3000)]
    df = spark.createDataFrame(rows, "id int, g string, v double").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for descending in (True, False):
            there = [(g, v) for _, g, v in rows if v is not None and v == v]
            want = {(i, g): None if v is None or v != v else 1 + sum(h == g and (w > v if descending else w < v) for h, w in there) for i, g, v in rows}
            got = O.rank_min(df, "v", "r", by=["g"], descending=descending).collect()
            assert {(r["id"], r["g"]): r["r"] for r in got} == want and len(got) == len(rows)
            whole = {r["id"]: r["r"] for r in O.rank_min(df, "v", "r", descending=descending).collect()}
            assert whole == {i: None if v is None or v != v else 1 + sum(w > v if descending else w < v for _, w in there) for i, g, v in rows}
            sums = O.running_totals(df, ["g"], "v", {"n": F.count(F.lit(1))}, descending)
            for r in sums.collect():
                assert r["cum_n"] == sum(h == r["g"] and (w >= r["v"] if descending else w <= r["v"]) for h, w in there)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rank_has_no_exchange_by_value(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    plan = O.rank_min(df, "v", "r")._jdf.queryExecution().toString()
    assert "hashpartitioning(v#" not in plan


@pytest.mark.parametrize("cell_rows", [1, 7, 100])
def test_quantile_cells_are_cut_until_they_are_small(spark, cell_rows):
    rng = random.Random(cell_rows)
    values = [1.7e9 + k for k in range(900)] + [1.7e9 + 0.5] * 300 + [float("inf"), float("-inf"), -1e308, 1e308, 0.0, -0.0, 5e-324]
    rng.shuffle(values)
    df = frame(spark, values[:600]).unionByName(frame(spark, values[600:], "h"))
    for r in O.exact_quantiles(df, ["variable"], "value", {"a": 0.1, "b": 0.5, "c": 0.9}, cell_rows).collect():
        part = sorted(values[:600] if r["variable"] == "g" else values[600:])
        for name, p in (("a", 0.1), ("b", 0.5), ("c", 0.9)):
            assert r[name] == pytest.approx(np.quantile(part, p), rel=1e-12)
    whole = O.exact_quantiles(frame(spark, values), [], "value", {"b": 0.5}, cell_rows).first()
    assert whole["b"] == pytest.approx(np.quantile(values, 0.5))


def harmonic(n):
    return sum(1 / j for j in range(1, n)) - 0.5772156649015329


def brute_information(rows, k):
    sizes = {y: sum(b == y for _, b in rows) for _, y in rows}
    rows = [(x, y) for x, y in rows if sizes[y] > 1]
    total = 0.0
    for i, (x, y) in enumerate(rows):
        own = min(k, sizes[y] - 1)
        r = sorted(abs(x - u) for j, (u, v) in enumerate(rows) if v == y and j != i)[own - 1]
        m = sum(abs(x - u) < r or (r == 0 and u == x) for u, _ in rows)
        own = own if r else sum(u == x and v == y for u, v in rows)
        total += harmonic(own) - harmonic(sizes[y]) - harmonic(m)
    return max(0.0, harmonic(len(rows)) + total / len(rows))


@pytest.mark.parametrize("k, partitions", [(3, 2), (5, 40), (1, 8)])
def test_neighbour_information_is_the_brute_force(spark, k, partitions):
    from surveyloom.operators.stats import neighbour_information

    rng = random.Random(k)
    rows = [(float(rng.choice([rng.randrange(400), 7, rng.randrange(5)]) + (300 * y if y < 3 else 0)), y)
            for y in [rng.choice([0, 0, 0, 1, 2]) for _ in range(250)] + [3] + [4, 4]]
    noise = [rng.randrange(10**6) / 8 for _ in rows]
    df = spark.createDataFrame([(a, b, y) for (a, y), b in zip(rows, noise)] + [(1.0, 1.0, None)], "a double, b double, y int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["variable"]: r["mutual_info"] for r in neighbour_information(df, ["a", "b"], "y", k).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got["a"] == pytest.approx(brute_information(rows, k), abs=1e-9)
    assert got["b"] == pytest.approx(brute_information([(b, y) for (_, y), b in zip(rows, noise)], k), abs=1e-9)
    assert got["a"] > 0.1


def test_digamma(spark):
    from surveyloom.operators.stats import digamma

    for n, v in spark.range(1, 60).select("id", digamma(F.col("id"))).collect():
        assert v == pytest.approx(harmonic(n), abs=1e-11)
