"""The stages from raw text to the drift report, in order.

Each stage reads tables, writes tables and enforces its contract; a failed contract or gate raises
and so stops the run. What reaches the driver is the gate result, the champion row, the report row
and failed expectations.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, drift, features, metrics, profile, quality, registry, scoring
from ..operators import training
from ..session import observing_session, wide_code_generation
from ..sources import (
    REJECTED,
    append_history,
    claim_folder,
    claim_next,
    overwrite_table,
    read_delimited_sensor,
    read_history,
    rejected_lines,
    sensor_schema,
)
from ..sources.delimited import SENSORS
from .features import feature_plan

GOLD_KEYS = ["subject_id", "activity_id", "win", "phase"]
GOLD_IDS = [*GOLD_KEYS, "split", "generated_at", "sample_count"]
PREDICTION = "predicted_activity_id"
OUTPUT_TYPE = "bigint"
LINEAGE = ["model_name", "model_version", "model_run_id", "scored_at"]


@dataclass(frozen=True)
class Settings:
    """Thresholds and choices of a run; every limit of a contract or gate is a parameter."""

    root: str
    model_name: str = "activity_classifier"
    train_subjects: Sequence[int] = (101, 102, 103, 104, 105, 106)
    holdout_subjects: Sequence[int] = (107, 108, 109)
    expected_subjects: int = 9
    reject_limit: float = 1.0  # share of broken lines that is still accepted
    slow_null_rate: tuple[float, float] = (0.85, 0.95)
    feature_null_limit: float = 0.05
    checked_features: Sequence[str] = ("hand_acc16_x_mean",)  # besides the slow signal's
    window_seconds: float = features.WINDOW_SECONDS
    sample_hz: int = features.SAMPLE_HZ
    completeness: float = features.COMPLETENESS
    boosted: bool = False
    params: dict | None = None  # of the trees; None takes the defaults
    validation_fraction: float = training.VALIDATION_FRACTION  # of the subjects; boosted only
    floor: float = registry.ABSOLUTE_FLOOR
    regression_tolerance: float = registry.REGRESSION_TOLERANCE
    performance_tolerance: float = drift.PERFORMANCE_TOLERANCE
    bins: int = drift.BINS
    claim_wait_seconds: float = 60.0  # for another writer's promotion that began earlier

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def tree_params(self) -> dict:
        return self.params or (training.BOOSTED if self.boosted else training.FOREST)

    @property
    def expected_samples(self) -> int:
        return int(self.sample_hz * self.window_seconds)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A history, or no rows of the given schema before its first batch."""
    try:
        return read_history(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ingest(spark: SparkSession, raw_path: str, settings: Settings) -> DataFrame:
    """Raw text to ``bronze_readings``; returns the profile per subject.

    The contract is measured during the write; only the number of subjects takes a scan of its one column.
    Lines that could not be read as they stand keep their readable values in the table and are added to
    ``rejected_lines`` with the reason.
    """
    own = observing_session(spark)
    raw = read_delimited_sensor(own, raw_path, rejected_col=REJECTED)
    rejected = quality.WrittenContract(
        raw,
        [quality.rate_at_most("rejected lines", F.col(REJECTED).isNotNull(), settings.reject_limit)],
    )
    readings = cleaning.clean_readings(
        rejected.observed.drop(REJECTED), sensor_cols=sensor_schema().names
    )
    contract = quality.WrittenContract(
        readings,
        [
            quality.not_empty(),
            quality.null_rate_between("heart_rate", *settings.slow_null_rate),
            quality.no_row("no transient activity", F.col("activity_id") == 0),
            quality.distinct_exactly("subject_id", settings.expected_subjects),
        ],
    )
    overwrite_table(contract.observed, settings.at("bronze_readings"))
    bronze = spark.read.parquet(settings.at("bronze_readings"))
    faults = rejected.result(spark)
    if faults.first()["observed"]:  # only then is the text read again, for the broken lines
        kept = rejected_lines(read_delimited_sensor(spark, raw_path, rejected_col=REJECTED))
        append_history(kept.withColumn("ingested_at", F.current_timestamp()), settings.at("rejected_lines"))
    quality.enforce(
        quality.all_checks(
            faults,
            contract.result(spark),
            quality.check(bronze, contract.left_over),
            quality.require_columns(bronze, ["subject_id", "activity_id"], "orient_"),
        )
    )
    return profile.ingest_profile(bronze)


def build_features(spark: SparkSession, settings: Settings) -> DataFrame:
    """``bronze_readings`` to ``gold_features``; returns the profile per split."""
    own = observing_session(spark)
    bronze = own.read.parquet(settings.at("bronze_readings"))
    plan = feature_plan(
        bronze,
        sensor_cols=cleaning.columns_with_prefix(bronze, [f"{s}_" for s in SENSORS]),
        slow_col="heart_rate",
        window_seconds=settings.window_seconds,
        expected=settings.expected_samples,
        completeness=settings.completeness,
        train_subjects=settings.train_subjects,
        holdout_subjects=settings.holdout_subjects,
    )
    stamped = plan.withColumn("generated_at", F.current_timestamp())
    contract = quality.WrittenContract(stamped, gold_expectations(settings))
    with wide_code_generation(own):
        # Training, scoring and monitoring each read one split.
        overwrite_table(contract.observed, settings.at("gold_features"), partition_by=["split"])
    gold = spark.read.parquet(settings.at("gold_features"))
    quality.enforce(quality.all_checks(contract.result(spark), gold_relations(gold)))
    return profile.split_profile(gold)


def gold_expectations(settings: Settings) -> list[quality.Expectation]:
    """What can be said of the feature table row by row and in sums."""
    split = F.col("split")
    needed = features.required_samples(settings.expected_samples, settings.completeness)
    limit = settings.feature_null_limit
    return [
        quality.not_empty(),
        *[quality.no_null(key) for key in [*GOLD_KEYS, "split"]],
        quality.null_rate_below("heart_rate_mean", limit),
        *[quality.null_rate_below(column, limit) for column in settings.checked_features],
        quality.some_row("train has rows", split == "train"),
        quality.some_row("holdout has rows", split == "holdout"),
        quality.no_row("no partial window", F.col("sample_count") < needed),
    ]


def gold_relations(gold: DataFrame) -> DataFrame:
    """What relates rows of the feature table to each other: these read a few columns of the written table."""
    split = F.col("split")
    keys = profile.class_balance(gold).drop("count")
    return quality.all_checks(
        quality.require_columns(
            gold, [*GOLD_KEYS, "split", "heart_rate_mean", "heart_rate_std", "sample_count"]
        ),
        quality.expect_empty(
            "no subject in two splits", quality.split_leakage(gold, "subject_id")
        ),
        quality.expect_empty(
            "same activities in both splits",
            quality.class_coverage(
                keys.filter(split == "train"), keys.filter(split == "holdout"), "activity_id"
            ),
        ),
    )


def gold_contract(gold: DataFrame, settings: Settings) -> DataFrame:
    """The whole contract of a feature table that is already there."""
    return quality.all_checks(
        quality.check(gold, gold_expectations(settings)), gold_relations(gold)
    )


def train(spark: SparkSession, settings: Settings) -> str:
    """Fit, evaluate on the holdout and record the run; returns its id."""
    gold = spark.read.parquet(settings.at("gold_features"))
    fit_on, hold = gold.filter("split = 'train'"), gold.filter("split = 'holdout'")
    inputs = features.feature_columns(gold, GOLD_IDS)
    model = training.train_classifier(
        fit_on,
        inputs,
        "activity_id",
        boosted=settings.boosted,
        params=settings.tree_params,
        subject_col="subject_id",
        validation_fraction=settings.validation_fraction,
    )
    run_id = uuid.uuid4().hex
    path = settings.at(f"models/{run_id}")
    model.write().save(path)

    scored = scoring.score(model, hold, ["activity_id"], PREDICTION, OUTPUT_TYPE)
    # The holdout is scored once; the record and the report are made from these few rows.
    counted = metrics.confusion(scored, "activity_id", PREDICTION)
    overwrite_table(counted, settings.at(f"run_counts/{run_id}"))
    counts = spark.read.parquet(settings.at(f"run_counts/{run_id}"))
    measured = (
        metrics.evaluation(counts)
        .select(
            F.col("macro_f1").alias("holdout_macro_f1"),
            F.col("weighted_f1").alias("holdout_weighted_f1"),
            F.col("accuracy").alias("holdout_accuracy"),
            profile.sample_sizes(fit_on, hold).select(F.struct("*")).scalar().alias("sizes"),
            F.lit(len(inputs)).alias("n_features"),
            profile.provenance_list(fit_on, "subject_id").scalar().alias("train_subjects"),
            profile.provenance_list(hold, "subject_id").scalar().alias("holdout_subjects"),
        )
        .withColumns(
            {"train_rows": F.col("sizes.reference_rows"), "holdout_rows": F.col("sizes.current_rows")}
        )
        .drop("sizes")
    )
    tags = {
        "train_subjects": F.col("train_subjects"),
        "holdout_subjects": F.col("holdout_subjects"),
        "feature_table": "gold_features",
        "split_strategy": "subject-level holdout",
        "model_path": path,
    }
    numbers = [c for c in measured.columns if not c.endswith("_subjects")]
    record = training.run_record(
        settings.model_name, run_id, settings.tree_params, measured, tags, metric_cols=numbers
    )
    append_history(record, settings.at("runs"))
    report = metrics.classification_report(counts).withColumn("run_id", F.lit(run_id))
    append_history(report, settings.at("run_reports"))
    write_baseline(spark, settings, run_id)
    return run_id


def write_baseline(spark: SparkSession, settings: Settings, run_id: str) -> None:
    """What drift is measured against, taken from the training rows once and kept with the run."""
    gold = spark.read.parquet(settings.at("gold_features"))
    fit_on = gold.filter("split = 'train'")
    kept = {"run_id": F.lit(run_id), "bins": F.lit(settings.bins)}
    labels = drift.label_counts(fit_on, "activity_id").withColumn("run_id", F.lit(run_id))
    append_history(labels, settings.at("baseline_labels"), ["run_id"])
    edges = drift.baseline(fit_on, gold_inputs(gold), settings.bins).withColumns(kept)
    append_history(edges, settings.at("baselines"), ["run_id", "bins"])


def baseline_of(spark: SparkSession, settings: Settings, run_id: str) -> tuple[DataFrame, DataFrame]:
    """(edges and counts, label counts) of a run. A run that has none for this number of bins gets them
    now: one of before baselines were kept, or one with other settings."""
    try:
        edges = read_history(spark, settings.at("baselines"), run_id=run_id, bins=settings.bins)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        write_baseline(spark, settings, run_id)
        edges = read_history(spark, settings.at("baselines"), run_id=run_id, bins=settings.bins)
    labels = read_history(spark, settings.at("baseline_labels"), run_id=run_id)
    # a second baseline of the run repeats the same rows
    return edges, labels.select("category", "n").distinct()


def promote(spark: SparkSession, settings: Settings) -> Row:
    """Register the latest run, judge it, record the decision and move an alias.

    Raises if the gate fails; by then the tags and the challenger alias are written. Several writers may promote at
    once: version and place in the alias history are claimed, and who comes second is judged against the first.
    """
    runs = read_or_empty(spark, settings.at("runs"), registry.RUNS)
    versions = read_or_empty(spark, settings.at("model_versions"), registry.MODEL_VERSIONS)
    events = read_or_empty(spark, settings.at("model_aliases"), registry.MODEL_ALIASES)
    run = registry.latest_run(runs.filter(F.col("model_name") == settings.model_name)).first()
    if run is None:
        raise registry.GateFailed(f"no finished run of {settings.model_name}")
    wanted = spark.createDataFrame([(settings.model_name,)], "model_name string")
    path = run.tags["model_path"]
    gold = spark.read.parquet(settings.at("gold_features"))
    contract = training.model_contract(PipelineModel.load(path), gold)
    newest = registry.next_version(wanted, versions).first().version - 1
    version = claim_next(spark, claim_folder(settings.at("claims"), settings.model_name, "versions"), newest, run.run_id)
    seq, events = claim_alias_move(spark, settings, events, run.run_id)
    held = registry.champion_lookup(
        wanted, events, read_or_empty(spark, settings.at("model_versions"), registry.MODEL_VERSIONS), runs_now(spark, settings)
    ).select(
        "model_name",
        F.col("version").alias("champion_version"),
        F.col("score").alias("champion_score"),
    )
    entry = wanted.select(
        "model_name",
        F.lit(version).cast("long").alias("version"),
        F.lit(run.run_id).alias("run_id"),
        F.array(
            *[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type")) for n, t in contract]
        ).alias("inputs"),
        F.struct(F.lit(PREDICTION).alias("name"), F.lit(OUTPUT_TYPE).alias("type")).alias("output"),
        F.lit(path).alias("path"),
    )
    candidate = entry.join(held, "model_name", "left").withColumns(
        {
            "candidate_score": F.lit(run.metrics.get(registry.METRIC)).cast("double"),
            "has_signature": F.lit(set(gold_inputs(gold)) >= {n for n, _ in contract} != set()),
        }
    )
    limits = {
        "floor": settings.floor,
        "regression_tolerance": settings.regression_tolerance,
    }
    # One row: settled here, so that the appends below cannot change what they derive from.
    result = registry.evaluate_gate(candidate, **limits)
    decided = result.collect()
    judged = spark.createDataFrame(decided, result.schema)
    columns = ["model_name", "version", "run_id", "inputs", "output", "path"]
    append_history(judged.select(*columns), settings.at("model_versions"))
    append_history(registry.gate_tags(judged, **limits), settings.at("model_tags"))
    moves = registry.alias_moves(judged, events).withColumn("seq", F.lit(seq).cast("long"))
    append_history(moves, settings.at("model_aliases"))
    outcome = decided[0]
    if not outcome.passed:
        raise registry.GateFailed(
            f"version {outcome.version} of {outcome.model_name} failed {outcome.failed_checks}: "
            f"score {outcome.candidate_score}, {outcome.comparison}; kept as challenger"
        )
    return outcome


def runs_now(spark: SparkSession, settings: Settings) -> DataFrame:
    return read_or_empty(spark, settings.at("runs"), registry.RUNS)


def claim_alias_move(
    spark: SparkSession, settings: Settings, events: DataFrame, owner: str
) -> tuple[int, DataFrame]:
    """(claimed place in the alias history, events before it).

    Where another writer holds a place before ours, its move is awaited, so that ours is judged after it. One that does
    not come within ``claim_wait_seconds`` was given up.
    """
    own = F.col("model_name") == settings.model_name
    newest = events.where(own).agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
    seq = claim_next(spark, claim_folder(settings.at("claims"), settings.model_name, "aliases"), newest, owner)
    until = time.monotonic() + settings.claim_wait_seconds
    while seq > newest + 1:
        events = read_or_empty(spark, settings.at("model_aliases"), registry.MODEL_ALIASES)
        between = events.where(own & (F.col("seq") > newest) & (F.col("seq") < seq))
        if between.select("seq").distinct().count() == seq - newest - 1 or time.monotonic() >= until:
            break
        time.sleep(1)
    return seq, events


def gold_inputs(gold: DataFrame) -> list[str]:
    """The columns of the feature table that a model may use."""
    return features.feature_columns(gold, GOLD_IDS)


def drift_history(spark: SparkSession, settings: Settings) -> DataFrame:
    """All drift reports of the model, newest first."""
    reports = read_history(spark, settings.at("drift_metrics"))
    return reports.filter(F.col("model_name") == settings.model_name).orderBy(F.desc("computed_at"))


def champion_of(spark: SparkSession, settings: Settings) -> Row:
    """Version, run, path, inputs and promoted score of the current champion."""
    versions = read_or_empty(spark, settings.at("model_versions"), registry.MODEL_VERSIONS)
    wanted = spark.createDataFrame([(settings.model_name,)], "model_name string")
    held = registry.champion_lookup(
        wanted,
        read_or_empty(spark, settings.at("model_aliases"), registry.MODEL_ALIASES),
        versions,
        read_or_empty(spark, settings.at("runs"), registry.RUNS),
    ).filter(F.col("version").isNotNull())
    found = held.join(versions.select("model_name", "version", "path", "inputs", "output"), ["model_name", "version"])
    champion = found.first()
    if champion is None:
        raise LookupError(f"{settings.model_name} has no champion")
    return champion


def score_batch(spark: SparkSession, settings: Settings, split: str = "holdout") -> DataFrame:
    """Append the champion's predictions; returns the summary of its history."""
    champion = champion_of(spark, settings)
    batch = spark.read.parquet(settings.at("gold_features")).filter(F.col("split") == split)
    scoring.require_inputs(batch, [(i["name"], i["type"]) for i in champion.inputs])
    model = PipelineModel.load(champion.path)
    scored = scoring.score(model, batch, GOLD_KEYS, champion.output.name, champion.output.type)
    batch_id = uuid.uuid4().hex
    stamped = scoring.stamp_lineage(
        scored, settings.model_name, champion.version, champion.run_id
    ).withColumns({"scored_at": F.current_timestamp(), "batch_id": F.lit(batch_id)})
    append_history(stamped, settings.at("predictions"), ["model_version"])
    written = read_history(spark, settings.at("predictions"), model_version=champion.version)
    # what the metrics need of this batch: a row for each pair of classes
    counts = metrics.confusion(
        written.filter(F.col("batch_id") == batch_id), "activity_id", champion.output.name
    ).withColumns(
        {
            "batch_id": F.lit(batch_id),
            "model_name": F.lit(settings.model_name),
            "model_version": F.lit(champion.version).cast("long"),
            "scored_at": F.current_timestamp(),
        }
    )
    append_history(counts, settings.at("scored_counts"), ["model_version"])
    history = read_history(spark, settings.at("predictions"), model_version=champion.version)
    return profile.scored_summary(history.filter(F.col("model_name") == settings.model_name))


def scored_metrics(spark: SparkSession, settings: Settings, model_version: int, since=None) -> DataFrame:
    """Macro and weighted F1 and accuracy over all batches of a version, or those scored since; reads no scored row."""
    kept = read_history(spark, settings.at("scored_counts"), model_version=model_version)
    kept = kept.filter(F.col("model_name") == settings.model_name)
    if since is not None:
        kept = kept.filter(F.col("scored_at") >= F.lit(since))
    return metrics.evaluation(metrics.merged_counts(kept))


def monitor(spark: SparkSession, settings: Settings, split: str = "holdout") -> Row:
    """Append the drift report and return it; raises on degraded performance."""
    champion = champion_of(spark, settings)
    gold = spark.read.parquet(settings.at("gold_features"))
    predictions = read_history(
        spark, settings.at("predictions"), model_version=champion.version
    ).filter(F.col("model_name") == settings.model_name)
    quality.enforce(quality.expect_any("champion has predictions", predictions))
    current = scoring.join_predictions(gold.filter(F.col("split") == split), predictions)
    promoted = spark.createDataFrame(
        [(settings.model_name, champion.version, champion.run_id, champion.score)],
        "model_name string, model_version bigint, model_run_id string, promoted_macro_f1 double",
    )
    inputs = gold_inputs(gold)
    # The training side was counted when the champion was trained: only the current rows are read.
    edges, labels = baseline_of(spark, settings, champion.run_id)
    # Every feature's PSI is kept, and the report is made from what was written.
    report_id = uuid.uuid4().hex
    found = drift.psi_from_baseline(edges, current, inputs, settings.bins)
    detail = drift.psi_detail(found).withColumns(
        {
            "model_name": F.lit(settings.model_name),
            "model_version": F.lit(champion.version).cast("long"),
            "computed_at": F.current_timestamp(),
            "report_id": F.lit(report_id),
        }
    )
    append_history(detail, settings.at("drift_features"), ["report_id"])
    written = read_history(spark, settings.at("drift_features"), report_id=report_id)
    report = drift.drift_report(
        None,
        current,
        inputs,
        promoted,
        bins=settings.bins,
        performance_tolerance=settings.performance_tolerance,
        feature_psi=written.select("feature", "psi"),
        reference_labels=labels,
    ).withColumns({"computed_at": F.current_timestamp(), "report_id": F.lit(report_id)})
    # The row is collected once and written from the driver: the report is not computed twice.
    rows = report.collect()
    append_history(spark.createDataFrame(rows, report.schema), settings.at("drift_metrics"))
    warning = drift.alert(rows[0].asDict(), settings.performance_tolerance)
    if warning:
        print(warning)
    return rows[0]


def verify(spark: SparkSession, settings: Settings) -> None:
    """The contracts of the finished tables, as the last step of a run."""
    gold = spark.read.parquet(settings.at("gold_features"))
    predictions = read_history(spark, settings.at("predictions"))
    quality.enforce(
        quality.all_checks(
            gold_contract(gold, settings),
            quality.check(predictions, [quality.no_null(c) for c in LINEAGE]),
            quality.expect_empty(
                "predicted classes are known",
                quality.unknown_values(
                    predictions.select(F.col(PREDICTION).cast("int").alias(PREDICTION)),
                    PREDICTION,
                    gold,
                    "activity_id",
                ),
            ),
        )
    )


def run_all(spark: SparkSession, raw_path: str, settings: Settings) -> Row:
    ingest(spark, raw_path, settings)
    build_features(spark, settings)
    train(spark, settings)
    promote(spark, settings)
    score_batch(spark, settings)
    report = monitor(spark, settings)
    verify(spark, settings)
    return report
