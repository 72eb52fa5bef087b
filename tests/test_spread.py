from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from folia.operators import spread
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 1 has a third of all rows, most of them copies of one another."""
    data = [(1, "copy")] * 150 + [(1, f"v{i}") for i in range(50)] + [(k % 60 + 2, f"w{k}") for k in range(400)]
    data += [(None, "x")] * 30 + [(99, "y")]
    return spark.createDataFrame(data, "k int, v string").repartition(6)


def test_hot_keys_finds_only_keys_over_the_limit(skewed):
    assert rows(spread.hot_keys(skewed, ["k"], 100)) == [(1,)]
    assert spread.hot_keys(skewed, ["k"], 200) is None
    assert spread.hot_keys(skewed, ["k"]) is None
    assert rows(spread.hot_keys(skewed, ["k"], 29)) == [(1,), (None,)]


def test_hot_keys_raises_its_threshold_until_they_fit(skewed, monkeypatch):
    monkeypatch.setattr(spread, "MAX_HOT_KEYS", 3)
    assert rows(spread.hot_keys(skewed, ["k"], 2)) == [(1,), (None,)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_with_hot_keys_is_the_plain_join(spark, skewed, how):
    lookup = spark.createDataFrame([(k, f"name{k}") for k in range(0, 40)], "k int, name string")
    hot = spread.hot_keys(skewed, ["k"], 6)
    assert hot is not None
    assert rows(spread.lookup_join(skewed, lookup, ["k"], how, hot)) == rows(skewed.join(lookup, ["k"], how))


def test_fan_out_join_with_hot_keys_is_the_plain_left_join(spark, skewed):
    parents = spark.createDataFrame([(k, f"p{k}") for k in [*range(0, 70), 99]] + [(None, "none")], "k int, p string")
    hot = spread.hot_keys(skewed, ["k"], 6)
    got = spread.fan_out_join(parents, skewed, ["k"], hot).select("k", "p", "v")
    assert rows(got) == rows(parents.join(skewed, "k", "left").select("k", "p", "v"))


def test_hot_rows_are_not_shuffled_by_their_key(spark, skewed):
    """The hot side of the join is broadcast, whatever Spark would choose for the rest."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup = spark.createDataFrame([(k, f"name{k}") for k in range(0, 40)], "k int, name string")
        hot = spread.hot_keys(skewed, ["k"], 100)
        plan = spread.lookup_join(skewed, lookup, ["k"], "left", hot)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [k" in plan and "SortMergeJoin [k" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_running_start_is_the_exact_running_sum(spark):
    data = [(i % 3, i % 17, i, i % 5 + 1) for i in range(500)]
    df = spark.createDataFrame(data, "k int, b int, i int, w int").repartition(5)
    got = {r["i"]: r["start"] for r in spread.running_start(df, ["k"], "b", ["i"], F.col("w")).collect()}
    total = defaultdict(int)
    for k, b, i, w in sorted(data):
        assert got[i] == total[k]
        total[k] += w


@pytest.mark.parametrize("part_size", [7, 40, 100])
def test_number_parts_keeps_every_row_in_full_parts(skewed, part_size):
    parted, parts = spread.number_parts(skewed, ["k"], part_size)
    got = parted.filter("k is not null").collect()
    assert Counter((r["k"], r["v"]) for r in got) == Counter(
        (r["k"], r["v"]) for r in skewed.filter("k is not null").collect()
    )
    sizes = Counter((r["k"], r["part"]) for r in got)
    several = {r["k"]: r["_parts"] for r in parts.collect()} if parts is not None else {}
    for k, n in Counter(r["k"] for r in got).items():
        full, rest = divmod(n, part_size)
        expected = [part_size] * full + ([rest] if rest else [])
        assert [sizes[(k, p)] for p in range(len(expected))] == expected
        assert several.get(k, 1) == len(expected)


def test_parts_depend_on_the_rows_of_their_key_alone(spark, skewed):
    """Other keys, few or many, hot or not, change nothing."""
    part = lambda df: {(r["k"], r["v"], r["part"]) for r in spread.number_parts(df, ["k"], 40)[0].filter("k = 1").collect()}
    assert part(skewed) == part(skewed.filter("k = 1").repartition(7))


def test_number_parts_leaves_small_keys_alone(skewed):
    parted, parts = spread.number_parts(skewed, ["k"], 1000)
    assert parts is None and rows(parted.drop("part")) == rows(skewed)


def test_many_oversized_keys_get_the_same_parts_as_a_few(skewed, monkeypatch):
    """Whether the keys are broadcast, sorted by the task of their key, or both, as key 1 here."""
    children = skewed.unionByName(skewed.filter("k is null"))
    parts_of = lambda: Counter(tuple(r) for r in spread.number_parts(children, ["k"], 3)[0].select("k", "v", "part").collect())
    few = parts_of()
    monkeypatch.setattr(spread, "MAX_HOT_KEYS", 3)
    assert parts_of() == few
    monkeypatch.setattr(spread, "MAX_HOT_KEYS", 20)
    monkeypatch.setattr(spread, "HOT_ROWS", 100)
    assert parts_of() == few


def test_parts_by_bytes_are_the_same_for_many_oversized_keys(spark, monkeypatch):
    data = [(i % 50, "x" * (i % 90), -0.0 if i % 4 else None) for i in range(900)]
    children = spark.createDataFrame(data, "k int, v string, d double").repartition(5)
    parts_of = lambda: Counter(tuple(r) for r in spread.number_parts(children, ["k"], 5, 60)[0].select("k", "v", "d", "part").collect())
    few = parts_of()
    monkeypatch.setattr(spread, "MAX_HOT_KEYS", 3)
    assert parts_of() == few


@pytest.mark.parametrize("part_size", [3, 1000])
def test_more_rows_make_more_tasks_and_not_larger_ones(spark, monkeypatch, part_size):
    """The session has three shuffle partitions, whatever the size of the table."""
    monkeypatch.setattr(spread, "MAX_HOT_KEYS", 10, raising=False)
    monkeypatch.setattr(spread, "HOT_ROWS", 500, raising=False)
    monkeypatch.setattr(spread, "TASK_ROWS", 100, raising=False)
    for n in (1000, 6000):
        children = spark.range(n).select((F.col("id") % (n // 5)).alias("k"), "id").repartition(4)
        parted, _ = spread.number_parts(children, ["k"], part_size)
        each = [r["count"] for r in parted.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(each) == n and max(each) <= 200
