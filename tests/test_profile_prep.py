import math
import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from folia.functions import bin_column
from folia.operators import prep as R
from folia.operators import profile as P
from tests.conftest import rows


@pytest.fixture(scope="module")
def loans(spark):
    data = [
        ("L1", "Male", "0", 100, 0.0), ("L2", "Male", "3+", 128, 2200.0), ("L3", None, "0", None, -5.0),
        ("L4", "Female", None, 200, 2200.5), ("L5", "Female", "3+", 201, None), ("L6", None, "1", None, 0.0),
        ("L7", None, "1", 127, 10.0),
    ]
    return spark.createDataFrame(data, "id string, gender string, dependents string, amount int, co double")


def test_modes_skip_null_and_take_the_lowest_on_ties(loans):
    assert R.modes(loans, ["gender", "dependents", "amount"]).first() == ("Female", "0", 100)
    assert R.modes(loans.filter("id = 'L3'"), ["gender", "dependents"]).first() == (None, "0")
    assert rows(R.all_modes(loans, "gender")) == [("Female",), ("Male",)]
    assert rows(R.all_modes(loans, "dependents")) == [("0",), ("1",), ("3+",)]
    assert R.top_value(loans, "gender").first() == ("Female", 2)


def test_fill_values_are_cast_and_fitted_apart(spark, loans):
    fill = R.fit_fill_values(loans, ["gender", "dependents"], ["amount"])
    assert fill.values == {"gender": "Female", "dependents": "0", "amount": 128}
    filled = fill.apply(loans)
    assert filled.filter("gender is null or dependents is null or amount is null").count() == 0
    other = spark.createDataFrame([(None,)], "amount int")
    assert R.FillValues({"amount": 127.5}).apply(other).first()[0] == 127
    nothing = R.fit_fill_values(loans.filter("id = 'L3'"), ["gender"], ["amount"])
    assert nothing.values == {} and nothing.apply(loans) is loans


def test_approximate_median_is_a_value_of_the_column(spark):
    even = spark.createDataFrame([(i,) for i in range(1, 11)], "v int")
    assert R.approximate_medians(even, ["v"]).first()[0] == 5
    assert P.exact_quantiles(even, "v", [0.5], interpolate=False) == [5.0]
    assert P.exact_quantiles(even, "v", [0.5]) == [5.5]
    assert R.approximate_medians(even.filter("v < 0"), ["v"]).first()[0] is None


@pytest.mark.parametrize("column,edges,labels,special,expected", [
    ("amount", [100, 200], ["Small", "Medium", "Large"], None, ["Small", "Medium", "Large", "Medium", "Large", "Large", "Medium"]),
    ("co", [2200], ["Low", "High"], {0: "None"}, ["None", "Low", "Low", "High", "High", "None", "Low"]),
])
def test_bins_are_right_closed_and_null_falls_to_the_last(loans, column, edges, labels, special, expected):
    got = loans.orderBy("id").select(bin_column(column, edges, labels, special)).collect()
    assert [r[0] for r in got] == expected


def test_bins_check_their_arguments():
    with pytest.raises(ValueError):
        bin_column("x", [1], ["a"])
    with pytest.raises(ValueError):
        bin_column("x", [2, 1], ["a", "b", "c"])


def test_null_counts_profile_and_distinct(loans):
    assert dict(P.null_counts(loans).collect()) == {"id": 0, "gender": 3, "dependents": 1, "amount": 2, "co": 1}
    assert ("amount", "int", 5) in [tuple(r) for r in P.column_profile(loans).collect()]
    assert [r[0] for r in P.sorted_distinct(loans, "gender").collect()] == ["Female", "Male", None]
    assert P.conditional_counts(loans, zero=F.col("co") == 0, other=F.col("co") != 0).first() == (2, 4)


@pytest.mark.parametrize("kind", ["uniform", "ties", "heavy_tail", "constant"])
def test_quantiles_are_exact(spark, kind):
    rnd = random.Random(kind)
    make = {
        "uniform": lambda: rnd.random(),
        "ties": lambda: 3.0 if rnd.random() < 0.4 else float(rnd.randrange(1000)),
        "heavy_tail": lambda: math.exp(rnd.gauss(0, 6)),
        "constant": lambda: 1.5,
    }[kind]
    values = [make() for _ in range(4001)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(4)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.999, 1.0]
    got = P.exact_quantiles(df, "v", probabilities)
    assert got == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)
    lower = P.exact_quantiles(df, "v", [0.25, 0.5], interpolate=False)
    assert lower == [sorted(values)[math.ceil(q * len(values)) - 1] for q in (0.25, 0.5)]


def test_quantiles_keep_the_type_of_the_column(spark):
    big = [2**53 + 1 + 2 * i for i in range(101)]
    df = spark.createDataFrame([(v, Decimal(v) / 100) for v in big], "b bigint, d decimal(20,2)").repartition(3)
    assert P.exact_quantiles(df, "b", [0.0, 0.5, 1.0], interpolate=False) == [big[0], big[50], big[100]]
    assert P.exact_quantiles(df, "d", [0.5], interpolate=False) == [Decimal(big[50]) / 100]


def test_many_ties_are_one_row_and_no_window_is_unpartitioned(spark, capfd):
    """Over half of the rows are one value; what is ranked are distinct values."""
    df = spark.range(20_000).select(F.when(F.col("id") % 5 < 3, 0.0).otherwise(F.col("id").cast("double")).alias("v"))
    values = sorted(0.0 if i % 5 < 3 else float(i) for i in range(20_000))
    ranks = [11_999, 12_000, 12_010, 19_999]
    assert P.order_statistics(df, "v", ranks) == [values[r] for r in ranks]
    assert "No Partition Defined" not in capfd.readouterr().err


def test_describe_and_fence_match_pandas(spark):
    rnd = random.Random(5)
    values = [round(rnd.gauss(10, 3), 2) for _ in range(500)] + [100.0, 22.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    series = pd.Series(values)
    got = P.describe(df, "v").first()
    assert list(got) == pytest.approx(list(series.describe()))
    q1, q3 = series.quantile(0.25), series.quantile(0.75)
    fence = q3 + 1.5 * (q3 - q1)
    assert list(P.outlier_count(df, "v").first()) == pytest.approx([fence, (series >= fence).sum()])
    on_fence = spark.createDataFrame([(float(v),) for v in [0, 0, 0, 4, 4, 10]], "v double")
    assert P.outlier_count(on_fence, "v").first() == (10.0, 1)
    empty = P.describe(df.filter("v < -1000"), "v").first()
    assert empty["count"] == 0 and empty["q50"] is None
    assert P.outlier_count(df.filter("v < -1000"), "v").first() == (None, 0)


def test_density_is_the_kernel_sum(spark):
    values = [1.0, 2.0, 2.0, 5.0, 9.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = P.density(df, "v", points=30).orderBy("x").collect()
    h = np.std(values, ddof=1) * len(values) ** -0.2
    grid = np.linspace(min(values) - 3 * h, max(values) + 3 * h, 30)
    want = [sum(np.exp(-0.5 * ((x - np.array(values)) / h) ** 2)) / (len(values) * h * np.sqrt(2 * np.pi)) for x in grid]
    assert [r["x"] for r in got] == pytest.approx(list(grid))
    assert [r["density"] for r in got] == pytest.approx(want)
    assert P.density(df.filter("v = 2"), "v").count() == 0


@pytest.mark.parametrize("error", [1e-2, 1e-4])
def test_density_is_within_its_error(spark, error):
    rnd = random.Random(3)
    values = [rnd.gauss(0, 1) if rnd.random() < 0.9 else rnd.gauss(40, 5) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    h = np.std(values, ddof=1) * len(values) ** -0.2
    got = P.density(df, "v", points=50, error=error).collect()
    want = [np.exp(-0.5 * ((r["x"] - np.array(values)) / h) ** 2).sum() / (len(values) * h * np.sqrt(2 * np.pi)) for r in got]
    off = max(abs(r["density"] - w) for r, w in zip(got, want))
    assert 0 < off <= error / (h * np.sqrt(2 * np.pi))


def test_quantiles_of_several_columns(spark):
    rnd = random.Random(6)
    data = [(rnd.randrange(50), rnd.gauss(0, 1), rnd.randrange(10**6) if rnd.random() < 0.5 else None, None) for _ in range(3000)]
    df = spark.createDataFrame(data, "a int, b double, c int, d int").repartition(3)
    probabilities = {"a": [0.5, 0.9], "b": [0.01], "c": [0.25, 0.5], "d": [0.5]}
    got = P.exact_quantiles_of(df, probabilities, interpolate=False)
    for k, c in enumerate("abc"):
        values = sorted(r[k] for r in data if r[k] is not None)
        assert got[c] == [values[math.ceil(p * len(values)) - 1] for p in probabilities[c]]
    assert got["d"] == [None]


def test_select_features(loans):
    assert R.select_features(loans, ["gender"], ["amount"], "dependents", ["id"]).columns == ["id", "gender", "amount", "dependents"]
