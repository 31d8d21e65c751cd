import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fieldpulse.operators import quantile, skew
from fieldpulse.operators.quantile import group_stats
from fieldpulse.operators.skew import HotGroups, hot_limit, spread_join

ALL_HOT = HotGroups(min_rows=0, max_groups=1_000_000, slots=64)


def nearest_rank(values, q=0.95):
    return sorted(values)[math.ceil(q * len(values)) - 1]


def stats(spark, groups, hot=HotGroups()):
    rows = [(key, float(value)) for key, values in groups.items() for value in values]
    frame = spark.createDataFrame(rows, "k string, value double")
    return {row["k"]: (row["p95"], row["count"], row["average"])
            for row in group_stats(frame, ["k"], hot=hot).collect()}


@pytest.mark.parametrize("hot", [HotGroups(), ALL_HOT])
def test_hand_worked_ranks(spark, hot):
    expected = {1: 1, 2: 2, 10: 10, 19: 19, 20: 19, 21: 20, 100: 95}
    got = stats(spark, {str(n): range(1, n + 1) for n in expected}, hot)
    assert {int(k): v[0] for k, v in got.items()} == expected
    assert {int(k): v[1] for k, v in got.items()} == {n: n for n in expected}


def test_selection_is_exact_on_mixed_groups(spark):
    rng = random.Random(7)
    groups = {
        "uniform": [rng.random() for _ in range(30_000)],
        "outliers": [rng.random() for _ in range(5_000)] + [1e300, -1e300, 1e-300],
        "few values": [float(rng.randrange(3)) for _ in range(9_000)],
        "one value": [4.0] * 3_000,
        "heavy at the rank": [float(i) for i in range(900)] + [5_000.0] * 400 + [6_000.0] * 10,
        "small": [3.0, 1.0, 2.0],
        "negative": [-rng.expovariate(1.0) for _ in range(2_500)],
    }
    expected = {key: (nearest_rank(values), len(values)) for key, values in groups.items()}
    for hot in (HotGroups(), HotGroups(min_rows=2_600, slots=64), ALL_HOT):
        got = stats(spark, groups, hot)
        assert {key: row[:2] for key, row in got.items()} == expected
        for key, values in groups.items():
            if key != "outliers":
                assert got[key][2] == pytest.approx(sum(values) / len(values))


def test_rank_is_narrowed_until_one_task_can_rank_it(spark, monkeypatch):
    """Few values per task and hardly any cuts, so that slices are cut again and again; one value has nearly all rows of a group."""
    monkeypatch.setattr(quantile, "CUT_OFFSETS", (-900,))
    monkeypatch.setattr(quantile, "EVEN_CUTS", 4)
    looked = []
    narrow = quantile._select_rank
    monkeypatch.setattr(quantile, "_select_rank", lambda rows, keys, value, hot: narrow(rows, keys, value, hot, most=20))
    written = quantile._written
    monkeypatch.setattr(quantile, "_written", lambda frame, purpose: looked.append(purpose) or written(frame, purpose))
    rng = random.Random(3)
    groups = {"many": [rng.random() for _ in range(4_000)], "heavy": [float(i) for i in range(1_000)] + [2_000.0] * 3_000 + [3_000.0 + i for i in range(300)]}
    got = stats(spark, groups, ALL_HOT)
    assert {key: row[:2] for key, row in got.items()} == {key: (nearest_rank(values), len(values)) for key, values in groups.items()}
    assert looked.count("rank-cuts") >= 2


@pytest.mark.parametrize("hot", [None, ALL_HOT])
def test_weights_stand_for_equal_values(spark, hot):
    rng = random.Random(4)
    rows = [(key, float(rng.randrange(40)), rng.randrange(1, 30)) for key in "abc" for _ in range(60)]
    frame = spark.createDataFrame(rows, "k string, value double, n long")
    got = {row.k: (row.p95, row["count"], row.average) for row in group_stats(frame, ["k"], hot=hot, weight="n").collect()}
    for key in "abc":
        values = [value for k, value, n in rows if k == key for _ in range(n)]
        assert got[key] == (nearest_rank(values), len(values), pytest.approx(sum(values) / len(values)))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from("abc"),
                       st.lists(st.floats(-1e6, 1e6).map(lambda x: x + 0.0), min_size=1, max_size=60),
                       min_size=1))
def test_both_paths_agree_with_sorting(spark, groups):
    expected = {key: nearest_rank(values) for key, values in groups.items()}
    for hot in (HotGroups(), ALL_HOT):
        assert {key: row[0] for key, row in stats(spark, groups, hot).items()} == expected


def test_limit(spark):
    frame = spark.range(1000).selectExpr("CASE WHEN id < 400 THEN 'hot' ELSE 'k' || id END AS k")
    assert hot_limit(frame, ["k"], HotGroups(min_rows=500)) is None
    assert hot_limit(frame, ["k"], HotGroups(min_rows=100)) == 100
    # At most two groups may hold more than half of the rows each.
    assert hot_limit(frame, ["k"], HotGroups(min_rows=1, max_groups=2)) is None
    assert hot_limit(frame, ["k"], HotGroups(min_rows=1, max_groups=5)) == 200
    assert hot_limit(frame.where("false"), ["k"], HotGroups(min_rows=0)) is None


def test_spread_join_gives_the_plain_join(spark):
    rows = spark.range(2_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN 'warm' ELSE 'k' || id % 50 END AS k")
    one = rows.select("k").distinct().where("k <> 'k7'").selectExpr("k", "'row of ' || k AS text")
    hot = HotGroups(min_rows=100, slots=1 << 12)
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = rows.join(one, ["k"], how)
        spread = spread_join(rows, one, ["k"], "id", how, hot).select(*plain.columns)
        assert sorted(spread.collect(), key=str) == sorted(plain.collect(), key=str)
    assert spread_join(rows, one, ["k"], "id", "inner").count() == rows.join(one, "k").count()


def test_spread_join_splits_the_hot_key(spark):
    rows = spark.range(3_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'k' || id END AS k")
    one = rows.select("k").distinct()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_join(rows, one, ["k"], "id", "inner", HotGroups(min_rows=50))
        parts = joined.where("k = 'hot'").selectExpr("spark_partition_id() AS p").distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts > 4


def test_first_look_takes_a_sample(spark):
    """A task shuffles a small share of its groups, and a hot group among them is still found."""
    hot = HotGroups(min_rows=100_000, sampled=1_000)
    groups = spark.range(200_000, numPartitions=2).selectExpr("if(id % 2 = 0, -1, id) AS k")
    assert hot_limit(groups, ["k"], HotGroups(min_rows=50_000, sampled=1_000)) == 50_000
    assert hot_limit(groups.where("k >= 0"), ["k"], HotGroups(min_rows=50_000, sampled=1_000)) is None
    assert skew._slot_counts(groups.where("k >= 0"), ["k"], hot).count() < 1_500
