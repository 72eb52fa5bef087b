"""Training and comparing classifiers on one reproducible split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    Classifier,
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.functions import hash_bucket
from folia.operators.spread import place_by_range
from folia.session import kept, new_path

# Split and model settings.
TRAIN_PERCENT = 80
SEED = 42
LOGISTIC_ITERATIONS = 100
TREE_DEPTH = 5
FOREST_TREES = 100

FEATURES = "features"
# Categories that trees take one by one, so that with the next index for others they fit
# Spark's 32 bins; a column of more is grouped.
MOST_CATEGORIES = 31


def hash_split(
    df: DataFrame, key: str, train_percent: int = TRAIN_PERCENT, seed: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the row key.

    Unlike a random split the result does not depend on how the data is laid
    out, so a recomputed partition cannot move rows between the halves.
    """
    bucket = hash_bucket(key, 100, seed)
    # A NULL key has no bucket; such rows go to the training side.
    train = F.coalesce(bucket < train_percent, F.lit(True))
    return df.filter(train), df.filter(~train)


def random_split(df: DataFrame, train_percent: int = TRAIN_PERCENT, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Spark's seeded random split; it depends on the layout of the data."""
    train, test = df.randomSplit([train_percent / 100, 1 - train_percent / 100], seed=seed)
    return train, test


def index_stages(columns: Sequence[str], invalid: str = "keep") -> list[StringIndexer]:
    """Indexers by falling frequency, ties by value; "keep" gives unseen values and NULL the next index."""
    names = list(columns)
    if not names:
        return []
    return [
        StringIndexer(inputCols=names, outputCols=[f"{c}_idx" for c in names], handleInvalid=invalid)
    ]


def _category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for the values of all columns, from one scan; NULL is left out."""
    cells = df.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    return cells.na.drop().groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def index_tables(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of all columns with their index by falling frequency, ties by value: (column, value, idx).

    The same indexes as `index_stages`, as a table: the distinct values of all columns are
    counted in one scan and ranked by ranges of (column, count, value), and none come to
    the driver. NULL has no row; it takes the next index.
    """
    order = F.struct("column", -F.col("n"), "value").alias("order")
    placed = place_by_range(_category_counts(df, columns).select("column", "value", order), "order", "place")
    first = placed.groupBy("column").agg(F.min("place").alias("first"))  # a row per column
    ranked = placed.join(F.broadcast(first), "column")
    return ranked.select("column", "value", (F.col("place") - F.col("first")).cast("double").alias("idx"))


def index_table(df: DataFrame, column: str) -> DataFrame:
    """The `index_tables` of one column: (value, idx)."""
    return index_tables(df, [column]).select("value", "idx")


def index_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`df` with `<column>_idx` for each column, from joined index tables; NULL gets the number
    of distinct values."""
    columns = list(dict.fromkeys(columns))
    if not columns:
        return df
    tables = index_tables(df, columns)
    sizes = {r["column"]: float(r["n"]) for r in tables.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = df
    for c in columns:
        key, idx = f"_{c}_value", f"{c}_idx"
        own = tables.filter(F.col("column") == c).select(F.col("value").alias(key), F.col("idx").alias(idx))
        out = out.withColumn(key, F.col(c).cast("string")).join(own, key, "left")
        out = out.withColumn(idx, F.coalesce(F.col(idx), F.lit(sizes.get(c, 0.0)))).drop(key)
    return out


def category_groups(df: DataFrame, column: str, target: str | Column, groups: int = MOST_CATEGORIES) -> DataFrame:
    """Values of a column in at most `groups` groups of about equal weight: (value, grp).

    Values are ordered by the mean of the number `target` among their rows, ties by value; for
    two classes no split of the values is better than one of this order. The order is taken by
    ranges, so neither a task nor the driver holds the values, and a value has one group.
    """
    cell = F.col(target) if isinstance(target, str) else target
    rows = df.select(F.col(column).cast("string").alias("value"), cell.cast("double").alias("y")).filter("value IS NOT NULL")
    stats = rows.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"))
    placed = place_by_range(stats.select("value", "n", F.struct("mean", "value").alias("order")), "order", "start", "n")
    total = stats.agg(F.sum("n").alias("total"))  # one row
    return placed.crossJoin(F.broadcast(total)).select("value", F.expr(f"CAST(start * {groups} div total AS double)").alias("grp"))


def group_columns(df: DataFrame, tables: dict[str, DataFrame], groups: int = MOST_CATEGORIES) -> DataFrame:
    """`df` with `<column>_group` for each column of `tables`, made by `category_groups`; NULL and
    values that the tables do not know get the next group."""
    out = df
    for c, table in tables.items():
        key, grp = f"_{c}_value", f"{c}_group"
        own = table.select(F.col("value").alias(key), F.col("grp").alias(grp))
        out = out.withColumn(key, F.col(c).cast("string")).join(own, key, "left")
        out = out.withColumn(grp, F.coalesce(F.col(grp), F.lit(float(groups)))).drop(key)
    return out


def wide_columns(df: DataFrame, columns: Sequence[str], most: int = MOST_CATEGORIES) -> list[str]:
    """Those of the columns that have more than `most` values; an action."""
    if not columns:
        return []
    counts = _category_counts(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    found = {r["column"] for r in counts.collect()}  # a row per column
    return [c for c in columns if c in found]


def feature_names(categorical: Sequence[str], numeric: Sequence[str]) -> list[str]:
    return [*[f"{c}_idx" for c in categorical], *numeric]


def feature_stages(categorical: Sequence[str], numeric: Sequence[str], invalid: str = "keep") -> list:
    """Indexers for the categorical columns and the assembly of all features into one vector."""
    assembler = VectorAssembler(inputCols=feature_names(categorical, numeric), outputCol=FEATURES)
    return [*index_stages(categorical, invalid), assembler]


def label_stage(label: str, invalid: str = "error") -> StringIndexer:
    """Indexer of the label. "keep" would add a class for unknown labels."""
    return StringIndexer(inputCol=label, outputCol=f"{label}_idx", handleInvalid=invalid)


def fit_features(
    train: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str,
    *,
    invalid: str = "keep",
    label_invalid: str = "error",
) -> PipelineModel:
    """Indexers, label indexer and assembler, fitted on the training rows."""
    stages = [*feature_stages(categorical, numeric, invalid), label_stage(label, label_invalid)]
    return Pipeline(stages=stages).fit(train)


def training_pipeline(
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str,
    classifier: Classifier,
    *,
    label_invalid: str = "error",
) -> Pipeline:
    """Features, label and one classifier as a single estimator, to be fitted,
    saved and applied to raw rows as one model."""
    return Pipeline(stages=[*feature_stages(categorical, numeric), label_stage(label, label_invalid), classifier])


def logistic_regression(label: str, iterations: int = LOGISTIC_ITERATIONS) -> LogisticRegression:
    return LogisticRegression(labelCol=label, featuresCol=FEATURES, maxIter=iterations)


def decision_tree(label: str, depth: int = TREE_DEPTH, seed: int = SEED, bins: int = MOST_CATEGORIES + 1) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol=FEATURES, maxDepth=depth, seed=seed, maxBins=bins)


def random_forest(
    label: str, trees: int = FOREST_TREES, depth: int = TREE_DEPTH, seed: int = SEED, bins: int = MOST_CATEGORIES + 1
) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=label, featuresCol=FEATURES, numTrees=trees, maxDepth=depth, seed=seed, maxBins=bins
    )


def standard_classifiers(label: str) -> list[tuple[str, Classifier]]:
    """The three models of the comparison, in their listed order."""
    return [
        ("Logistic Regression", logistic_regression(label)),
        ("Decision Tree", decision_tree(label)),
        ("Random Forest", random_forest(label)),
    ]


def detached(spark: SparkSession, model: Model) -> Model:
    """The model as it is read back from the shared folder, without its training summary.

    A summary of two classes holds the session. Once a query of that session was observed,
    no task that carries such a model can be serialized.
    """
    path = new_path(spark, "model")
    model.write().save(path)
    return type(model).load(path)


def accuracy(predictions: DataFrame, label: str, prediction: str = "prediction") -> float:
    """Share of rows whose prediction equals the label; an action."""
    evaluator = MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=prediction, metricName="accuracy"
    )
    return evaluator.evaluate(predictions)


def accuracy_by(
    predictions: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy as a table, over all rows or per group."""
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return predictions.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def compare_models(
    train: DataFrame,
    test: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str,
    classifiers: Sequence[tuple[str, Classifier]] | None = None,
    *,
    label_invalid: str = "error",
) -> DataFrame:
    """Scores of several classifiers on one split: (position, model, accuracy, is_best).

    Features are fitted once, on the training rows; columns of more than MOST_CATEGORIES
    values enter as ordered groups of their values. Both halves are written as vectors with
    their label, and fitted models are read back from the shared folder, so a lost
    executor costs a re-read. All models score the test rows in one scan. A
    model's accuracy is NULL when there are no test rows.
    """
    spark = train.sparkSession
    label_idx = f"{label}_idx"
    wide = wide_columns(train, categorical)
    if wide:
        signs = label_stage(label, label_invalid).fit(train).transform(train)
        tables = {c: category_groups(signs, c, (F.col(label_idx) > 0).cast("int")) for c in wide}
        train, test = (group_columns(half, tables) for half in (train, test))
    narrow = [c for c in categorical if c not in wide]
    prepared = fit_features(train, narrow, [*numeric, *[f"{c}_group" for c in wide]], label, label_invalid=label_invalid)
    learn, judge = (kept(spark, lambda half=half: prepared.transform(half).select(FEATURES, label_idx), "half") for half in (train, test))
    models = list(classifiers or standard_classifiers(label_idx))
    scored = judge
    for place, (_, classifier) in enumerate(models):
        model = detached(spark, classifier.fit(learn))
        predicted = F.col(model.getPredictionCol()).alias(f"_predicted_{place}")
        scored = model.transform(scored).select(*scored.columns, predicted)
    hits = [F.avg((F.col(label_idx) == F.col(f"_predicted_{i}")).cast("double")) for i in range(len(models))]
    row = scored.agg(*[h.alias(f"a{i}") for i, h in enumerate(hits)]).first()
    table = spark.createDataFrame([(i, name, row[i]) for i, (name, _) in enumerate(models)], "position int, model string, accuracy double")
    first = best_by(table, "accuracy", "position").select("position").scalar()
    return table.withColumn("is_best", F.col("position") == first)


def best_by(scores: DataFrame, metric: str, position: str) -> DataFrame:
    """The row with the highest metric; the first listed wins a tie."""
    return scores.orderBy(F.desc(metric), F.asc(position)).limit(1)


def coefficients(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """Fitted logistic coefficients as rows (class, feature, coefficient), intercepts included.

    A two-class model has one row set, for class 1.
    """
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    classes = [1] if len(matrix) == 1 else range(len(matrix))
    rows = []
    for cls, weights, intercept in zip(classes, matrix, intercepts):
        rows += [(cls, name, float(w)) for name, w in zip(names, weights)]
        rows.append((cls, "(intercept)", float(intercept)))
    return spark.createDataFrame(rows, "class int, feature string, coefficient double")
