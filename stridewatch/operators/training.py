"""Multiclass tree ensembles with Spark MLlib, and the record of a training run."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    Imputer,
    IndexToString,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import observed

# The training parameters and the seed.
FOREST = {"numTrees": 100, "maxDepth": 8, "seed": 42}
BOOSTED = {"maxIter": 200, "stepSize": 0.1, "maxDepth": 8, "seed": 42}
VALIDATION_FRACTION = 0.1

VALIDATES = "__validates"


def usable_features(train: DataFrame, feature_cols: list[str]) -> tuple[list[str], list[str]]:
    """(columns with at least one observed value, those of them that lack some). A single wide pass.

    A median needs an observed value.
    """
    read = [(c, observed(F.col(c))) for c in feature_cols]
    seen = train.agg(
        *[F.bool_or(known).alias(f"some{i}") for i, (_, known) in enumerate(read)],
        *[F.bool_and(known).alias(f"all{i}") for i, (_, known) in enumerate(read)],
    ).first()
    usable = [(c, seen[f"all{i}"]) for i, c in enumerate(feature_cols) if seen[f"some{i}"]]
    return [c for c, _ in usable], [c for c, whole in usable if not whole]


def missing_indicators(columns: list[str]) -> SQLTransformer:
    """A stage that adds, for each column, whether its reading is missing. A median looks like a reading;
    with the indicator a tree can tell them apart."""
    added = "".join(
        f", CAST(`{c}` IS NULL OR isnan(CAST(`{c}` AS DOUBLE)) AS DOUBLE) AS `{c}__missing`" for c in columns
    )
    return SQLTransformer(statement=f"SELECT *{added} FROM __THIS__")


def with_validation_subjects(
    train: DataFrame, subject_col: str, fraction: float = VALIDATION_FRACTION, seed: int = 42
) -> DataFrame:
    """Mark all rows of about this share of the subjects, those with the smallest hashes, at least one.

    Rows of one subject resemble each other, so a row-wise cut would validate on what was trained on.
    """
    order = F.xxhash64(F.lit(seed), F.col(subject_col).cast("string"))
    subjects = train.select(order.alias("h")).distinct()
    cut = subjects.agg(F.percentile_approx("h", fraction, 10_000))
    return train.withColumn(VALIDATES, order <= cut.scalar())


def fit_boosted_classes(
    rows: DataFrame, classes: int, params: dict, *, validated: bool, parallelism: int = 4
) -> OneVsRestModel:
    """One boosted ensemble a class over (features, label_index), each stopped on its own.

    ``OneVsRest`` drops the validation column, so the classes are fitted here; the class with the
    largest raw margin wins, as there. An ensemble stops when a round no longer improves the loss on the rows
    marked by ``VALIDATES``, and keeps the rounds up to its best.
    """
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    trees = GBTClassifier(featuresCol="features", labelCol="__is_class", **params)
    if validated:
        trees = trees.setValidationIndicatorCol(VALIDATES)

    def fit(k: int):
        return trees.fit(kept.withColumn("__is_class", (F.col("label_index") == k).cast("double")))

    try:
        with ThreadPool(min(parallelism, classes)) as pool:
            models = pool.map(inheritable_thread_target(rows.sparkSession)(fit), range(classes))
    finally:
        kept.unpersist()
    one_vs_rest = OneVsRest(classifier=trees, featuresCol="features", labelCol="label_index")
    return one_vs_rest._copyValues(OneVsRestModel(models=models))


def rounds_used(model: PipelineModel) -> list[int]:
    """Rounds of each class of a boosted model; trees of a forest."""
    classifier = model.stages[-2]
    parts = classifier.models if isinstance(classifier, OneVsRestModel) else [classifier]
    return [part.getNumTrees for part in parts]


def train_classifier(
    train: DataFrame,
    feature_cols: list[str],
    label_col: str,
    *,
    boosted: bool = False,
    params: dict | None = None,
    subject_col: str | None = None,
    validation_fraction: float = VALIDATION_FRACTION,
) -> PipelineModel:
    """Fit imputation, missing-value indicators, label index, assembly and classifier as one saved unit.

    The medians live inside the model, so training and scoring cannot drift apart. ``boosted``
    trains one boosted ensemble per class; the default is a random forest. With ``subject_col`` a boosted
    ensemble stops early, judged on some subjects that it is not fitted on; a single subject
    leaves none to judge on, and all rounds are fitted.
    """
    inputs, gaps = usable_features(train, feature_cols)
    if not inputs:
        raise ValueError("no feature column has an observed value")
    filled = [f"{c}__filled" for c in inputs]
    labels = StringIndexer(
        inputCol=label_col, outputCol="label_index", stringOrderType="alphabetAsc"
    ).fit(train.select(label_col))
    imputer = Imputer(strategy="median", inputCols=inputs, outputCols=filled)
    assembler = VectorAssembler(
        inputCols=[*filled, *[f"{c}__missing" for c in gaps]], outputCol="features"
    )
    readable = IndexToString(
        inputCol="prediction", outputCol="predicted_label", labels=labels.labels
    )
    kept = [*inputs, label_col]
    if boosted and subject_col:
        train = with_validation_subjects(train, subject_col, validation_fraction)
        kept.append(VALIDATES)
    indexed = labels.transform(train.select(*kept))
    prepared = Pipeline(stages=[imputer, missing_indicators(gaps), assembler]).fit(indexed)
    rows = prepared.transform(indexed)
    if boosted:
        sides = rows.select(VALIDATES).distinct().count() if subject_col else 1
        columns = ["features", "label_index", *([VALIDATES] if sides == 2 else [])]
        classifier = fit_boosted_classes(
            rows.select(*columns), len(labels.labels), params or BOOSTED, validated=sides == 2
        )
    else:
        classifier = RandomForestClassifier(
            featuresCol="features", labelCol="label_index", **(params or FOREST)
        ).fit(rows)
    return PipelineModel([*prepared.stages, classifier, readable])


def model_contract(model: PipelineModel, df: DataFrame) -> list[tuple[str, str]]:
    """(name, type) of every input, to be stored with the version."""
    kinds = dict(df.dtypes)
    return [(name, kinds[name]) for name in model.stages[0].getInputCols()]


def run_record(
    model_name: str,
    run_id: str,
    params: dict,
    measured: DataFrame,
    tags: dict[str, str | Column],
    *,
    metric_cols: list[str] | None = None,
) -> DataFrame:
    """One ``runs`` row. ``measured`` is a one-row frame with the metrics; tags may use it too."""

    def as_map(values: dict, kind: str) -> Column:
        pairs = [
            part
            for key, value in values.items()
            for part in (F.lit(key), value if isinstance(value, Column) else F.lit(str(value)))
        ]
        return F.create_map(*pairs).cast(f"map<string,{kind}>")

    numbers = {c: F.col(c).cast("double") for c in metric_cols or measured.columns}
    return measured.select(
        F.lit(model_name).alias("model_name"),
        F.lit(run_id).alias("run_id"),
        F.lit("FINISHED").alias("status"),
        F.current_timestamp().alias("start_time"),
        as_map(params, "string").alias("params"),
        as_map(numbers, "double").alias("metrics"),
        as_map(tags, "string").alias("tags"),
    )
