import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation
from pyspark.sql import functions as F

from folia.operators import models as M
from tests.conftest import rows


@pytest.fixture(scope="module")
def loans(spark):
    rnd = random.Random(0)
    data = []
    for i in range(400):
        gender, area, credit = rnd.choice(["Male", "Female"]), rnd.choice(["Urban", "Rural", "Semi"]), rnd.randrange(2)
        status = "Y" if rnd.random() < (0.9 if credit else 0.2) else "N"
        data.append((f"L{i}", gender, area, credit, status))
    return spark.createDataFrame(data, "id string, gender string, area string, credit int, status string")


def test_logistic_regression_on_the_recorded_rows(spark):
    # The rows the published coefficients belong to.
    data = [(1.0, [1.0, 2.0, 3.0]), (0.0, [2.0, 1.0, 0.0]), (0.0, [3.0, 3.0, 3.0]), (1.0, [0.0, 2.0, 1.0])]
    df = spark.createDataFrame([(y, Vectors.dense(x)) for y, x in data], ["label", "features"])
    fitted = M.logistic_regression("label", iterations=10).fit(df)
    got = {r["feature"]: r["coefficient"] for r in M.coefficients(spark, fitted, ["a", "b", "c"]).collect()}
    # The published coefficients and intercept.
    assert got["a"] == pytest.approx(-7.160704699870721, rel=1e-4)
    assert got["b"] == pytest.approx(-0.8790457903861922, rel=1e-4)
    assert got["c"] == pytest.approx(2.9592088779777836, rel=1e-4)
    assert got["(intercept)"] == pytest.approx(7.365745492696742, rel=1e-4)


def test_hash_split_is_disjoint_whole_and_independent_of_layout(spark, loans):
    train, test = M.hash_split(loans, "id")
    assert rows(train.unionByName(test)) == rows(loans)
    assert train.join(test, "id").count() == 0
    assert 0.7 < train.count() / 400 < 0.9
    again, _ = M.hash_split(loans.repartition(7), "id")
    assert rows(again) == rows(train)
    other, _ = M.hash_split(loans, "id", seed="x")
    assert rows(other) != rows(train)
    missing = spark.createDataFrame([(None,)], "id string")
    assert M.hash_split(missing, "id")[0].count() == 1


def test_random_split_is_whole(loans):
    train, test = M.random_split(loans)
    assert train.count() + test.count() == 400


def test_index_is_by_frequency_then_value_and_keeps_unseen(spark):
    train = spark.createDataFrame([("b",), ("b",), ("c",), ("a",), (None,)], "v string")
    (indexer,) = M.index_stages(["v"])
    fitted = indexer.fit(train)
    other = spark.createDataFrame([("a",), ("b",), ("c",), ("new",), (None,)], "v string")
    assert [r["v_idx"] for r in fitted.transform(other).collect()] == [1.0, 0.0, 2.0, 3.0, 3.0]
    assert M.index_stages([]) == []


def test_features_are_assembled_in_order(loans):
    prepared = M.fit_features(loans, ["gender", "area"], ["credit"], "status").transform(loans)
    vector = vector_to_array(M.FEATURES)
    check = prepared.filter(
        (vector[0] != F.col("gender_idx")) | (vector[1] != F.col("area_idx")) | (vector[2] != F.col("credit"))
    )
    assert check.count() == 0


def test_keeping_unknown_labels_adds_a_class(loans):
    for invalid, classes in (("error", 2), ("keep", 3)):
        prepared = M.fit_features(loans, ["gender"], ["credit"], "status", label_invalid=invalid).transform(loans)
        fitted = M.logistic_regression("status_idx", 20).fit(prepared)
        assert fitted.numClasses == classes
        table = M.coefficients(loans.sparkSession, fitted, ["gender_idx", "credit"])
        assert table.select("class").distinct().count() == (1 if classes == 2 else 3)


def test_comparison_ranks_the_models(loans):
    train, test = M.hash_split(loans, "id")
    scores = M.compare_models(train, test, ["gender", "area"], ["credit"], "status").orderBy("position").collect()
    assert [r["model"] for r in scores] == ["Logistic Regression", "Decision Tree", "Random Forest"]
    assert all(0.7 < r["accuracy"] <= 1 for r in scores)
    best = max(r["accuracy"] for r in scores)
    assert [r["is_best"] for r in scores] == [r["position"] == min(x["position"] for x in scores if x["accuracy"] == best) for r in scores]
    only = M.compare_models(train, test, ["area"], ["credit"], "status", [("one", LogisticRegression(labelCol="status_idx", maxIter=5))])
    assert [(r["model"], r["is_best"]) for r in only.collect()] == [("one", True)]


def test_one_fitted_pipeline_equals_features_then_model(spark, loans, scratch):
    train, test = M.hash_split(loans, "id")
    tree = M.decision_tree("status_idx")
    whole = M.training_pipeline(["gender", "area"], ["credit"], "status", tree).fit(train)
    whole.write().save(f"{scratch}/model")
    loaded = PipelineModel.load(f"{scratch}/model")
    features = M.fit_features(train, ["gender", "area"], ["credit"], "status")
    stepwise = tree.fit(features.transform(train)).transform(features.transform(test))
    assert rows(loaded.transform(test).select("id", "prediction")) == rows(stepwise.select("id", "prediction"))


def test_first_listed_wins_a_tie(spark):
    scores = spark.createDataFrame([(0, 0.5), (1, 0.9), (2, 0.9)], "position int, accuracy double")
    assert M.best_by(scores, "accuracy", "position").first()["position"] == 1


def test_accuracy_as_value_and_as_table(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 0.0, 1.0), ("b", 0.0, 0.0), ("b", 1.0, 1.0)], "g string, label double, prediction double")
    assert M.accuracy(df, "label") == 0.75
    assert rows(M.accuracy_by(df, "label", by=["g"])) == [("a", 0.5), ("b", 1.0)]
    assert M.accuracy_by(df, "label").first()[0] == 0.75


def test_many_categories_are_grouped_by_the_label(spark):
    data = [(f"c{i % 40}", float(i % 3), "yes" if i % 40 < 20 else "no") for i in range(800)]
    df = spark.createDataFrame([*data, (None, 0.0, "no")], "c string, x double, y string").repartition(3)
    assert M.wide_columns(df, ["c", "y"]) == ["c"]
    table = M.category_groups(df, "c", (F.col("y") == "yes").cast("int"))
    groups = {r["value"]: r["grp"] for r in table.collect()}
    assert len(groups) == 40 and set(groups.values()) <= set(map(float, range(31)))
    assert max(groups[f"c{i}"] for i in range(20, 40)) < min(groups[f"c{i}"] for i in range(20))
    grouped = M.group_columns(spark.createDataFrame([("c3",), ("new",), (None,)], "c string"), {"c": table})
    assert {(r["c"], r["c_group"]) for r in grouped.collect()} == {("c3", groups["c3"]), ("new", 31.0), (None, 31.0)}
    prepared = M.group_columns(df, {"c": table}).na.fill({"c": "-"})
    features = M.fit_features(prepared, [], ["x", "c_group"], "y")
    fitted = M.decision_tree("y_idx").fit(features.transform(prepared))
    assert M.accuracy(fitted.transform(features.transform(prepared)), "y_idx") == 1.0
    scores = M.compare_models(df, df, ["c"], ["x"], "y").orderBy("position").collect()
    assert [r["accuracy"] for r in scores][1:] == [1.0, 1.0]


def test_models_score_after_an_observed_query(spark, loans):
    """A training summary holds the session, which can't be sent to a task any more."""
    seen = Observation()
    loans.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 400
    train, test = M.hash_split(loans, "id")
    assert M.compare_models(train, test, ["gender"], ["credit"], "status").filter("accuracy > 0.5").count() == 3
    assert M.compare_models(train, test.limit(0), ["gender"], ["credit"], "status").filter("accuracy IS NULL").count() == 3


def test_index_tables_of_several_columns(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("a", 1), (None, 3), ("c", None)], "v string, w int").repartition(3)
    (indexer,) = M.index_stages(["v", "w"])
    want = indexer.fit(df).transform(df)
    assert rows(M.index_columns(df, ["v", "w"]).select("v", "w", "v_idx", "w_idx")) == rows(want.select("v", "w", "v_idx", "w_idx"))


def test_index_table_is_the_indexer(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), (None,), ("c",), ("b",), ("d",)], "v string").repartition(3)
    (indexer,) = M.index_stages(["v"])
    want = indexer.fit(df).transform(df)
    assert rows(M.index_columns(df, ["v"]).select("v", "v_idx")) == rows(want.select("v", "v_idx"))
