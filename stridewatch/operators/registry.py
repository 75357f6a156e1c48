"""Model registry over tables: runs, versions, tags and alias events.

Every function maps DataFrames to DataFrames and handles many models at once. Version numbers and
alias sequence numbers assume one writer per model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import at_least

# Alias names, gate limits and the metric they apply to.
CHAMPION = "champion"
CHALLENGER = "challenger"
ABSOLUTE_FLOOR = 0.75
REGRESSION_TOLERANCE = 0.01
FLOAT_SLACK = 1e-9
METRIC = "holdout_macro_f1"

RUNS = (
    "model_name string, run_id string, status string, start_time timestamp, params map<string,string>, "
    "metrics map<string,double>, tags map<string,string>"
)
MODEL_VERSIONS = (
    "model_name string, version bigint, run_id string, "
    "inputs array<struct<name:string,type:string>>, output struct<name:string,type:string>, path string"
)
MODEL_TAGS = "model_name string, version bigint, key string, value string"
MODEL_ALIASES = (
    "model_name string, alias string, version bigint, seq bigint, moved_at timestamp"
)


def latest_run(runs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Newest finished run, overall or per group; an aggregate, so nothing is sorted."""
    by = by or []
    rest = [c for c in runs.columns if c not in by]
    newest = F.max_by(F.struct(*rest), F.struct("start_time", "run_id"))
    return (
        runs.filter(F.col("status") == "FINISHED")
        .groupBy(*by)
        .agg(newest.alias("run"))
        .filter(F.col("run").isNotNull())
        .select(*by, "run.*")
    )


def next_version(requested: DataFrame, versions: DataFrame) -> DataFrame:
    """(model_name, version) to assign to each requested model."""
    newest = versions.groupBy("model_name").agg(F.max("version").alias("newest"))
    return (
        requested.select("model_name")
        .distinct()
        .join(newest, "model_name", "left")
        .select("model_name", (F.coalesce("newest", F.lit(0)) + 1).cast("long").alias("version"))
    )


def alias_current(events: DataFrame) -> DataFrame:
    """Where each alias points now. A rollback is one more event, so the latest event wins."""
    return events.groupBy("model_name", "alias").agg(F.max_by("version", "seq").alias("version"))


def champion_lookup(
    models: DataFrame,
    events: DataFrame,
    versions: DataFrame,
    runs: DataFrame,
    *,
    alias: str = CHAMPION,
    metric: str = METRIC,
) -> DataFrame:
    """(model_name, version, run_id, score) per model; nulls where no champion exists."""
    held = alias_current(events.filter(F.col("alias") == alias)).select("model_name", "version")
    scores = runs.select("run_id", F.col("metrics")[metric].alias("score"))
    return (
        models.select("model_name")
        .distinct()
        .join(held, "model_name", "left")
        .join(versions.select("model_name", "version", "run_id"), ["model_name", "version"], "left")
        .join(scores, "run_id", "left")
        .select("model_name", "version", "run_id", "score")
    )


def evaluate_gate(
    candidates: DataFrame,
    *,
    floor: float = ABSOLUTE_FLOOR,
    regression_tolerance: float = REGRESSION_TOLERANCE,
) -> DataFrame:
    """Judge every candidate row (candidate_score, has_signature, champion_score).

    Adds ``checks``, ``failed_checks``, ``passed`` and ``comparison``. Limits are inclusive. A null
    champion score means there is nothing to regress against; a NaN score never passes. A champion
    whose run lacks the metric also has a null score, and ``comparison`` says so if the candidate
    rows carry a ``champion_version``.
    """
    score, rival = F.col("candidate_score"), F.col("champion_score")
    # 0.84 - 0.85 is slightly below -0.01 in binary, hence the slack.
    keeps_up = rival.isNull() | at_least(score - rival, -(regression_tolerance + FLOAT_SLACK))
    checks = {
        "signature_present": F.coalesce(F.col("has_signature"), F.lit(False)),
        "above_floor": at_least(score, floor),
        "no_regression": keeps_up,
    }
    without_rival = F.lit("no existing champion")
    if "champion_version" in candidates.columns:
        without_rival = F.when(
            F.col("champion_version").isNotNull(), F.lit("champion without a score")
        ).otherwise(without_rival)
    names = list(checks)
    return (
        candidates.withColumn(
            "checks", F.create_map(*[part for k in names for part in (F.lit(k), checks[k])])
        )
        .withColumn(
            "failed_checks",
            F.filter(F.array(*[F.lit(k) for k in names]), lambda k: ~F.col("checks")[k]),
        )
        .withColumn("passed", F.size("failed_checks") == 0)
        .withColumn(
            "comparison",
            F.when(rival.isNull(), without_rival).otherwise(
                F.format_string("champion %.4f, delta %+.4f", rival, score - rival)
            ),
        )
    )


def gate_tags(
    judged: DataFrame,
    *,
    metric: str = METRIC,
    floor: float = ABSOLUTE_FLOOR,
    regression_tolerance: float = REGRESSION_TOLERANCE,
) -> DataFrame:
    """(model_name, version, key, value): the decision as text, one row per tag."""
    # The tag keys.
    fixed: dict[str, Column] = {
        "gate_passed": F.col("passed").cast("string"),
        "gate_metric": F.lit(metric),
        "gate_candidate_score": F.format_string("%.4f", F.col("candidate_score")),
        "gate_floor": F.lit(str(floor)),
        "gate_regression_tolerance": F.lit(str(regression_tolerance)),
        "gate_comparison": F.col("comparison"),
        "source_run_id": F.col("run_id"),
    }
    settled = F.create_map(*[part for k, v in fixed.items() for part in (F.lit(k), v)])
    per_check = F.transform_values(
        F.transform_keys("checks", lambda k, _: F.concat(F.lit("gate_check_"), k)),
        lambda _, ok: ok.cast("string"),
    )
    return judged.select(
        "model_name", "version", F.explode(F.map_concat(settled, per_check)).alias("key", "value")
    )


def alias_moves(judged: DataFrame, events: DataFrame) -> DataFrame:
    """Alias events after a gate: a pass becomes champion, a failure stays challenger.

    A failed candidate never touches the champion pointer.
    """
    newest = events.groupBy("model_name").agg(F.max("seq").alias("newest"))
    return judged.join(newest, "model_name", "left").select(
        "model_name",
        F.when(F.col("passed"), CHAMPION).otherwise(CHALLENGER).alias("alias"),
        F.col("version").cast("long").alias("version"),
        (F.coalesce("newest", F.lit(0)) + 1).cast("long").alias("seq"),
        F.current_timestamp().alias("moved_at"),
    )


def rollback(events: DataFrame, model_name: str, version: int, alias: str = CHAMPION) -> DataFrame:
    """The event that points an alias back at an older version."""
    return events.filter(F.col("model_name") == model_name).agg(
        F.lit(model_name).alias("model_name"),
        F.lit(alias).alias("alias"),
        F.lit(version).cast("long").alias("version"),
        (F.coalesce(F.max("seq"), F.lit(0)) + 1).cast("long").alias("seq"),
        F.current_timestamp().alias("moved_at"),
    )


class GateFailed(RuntimeError):
    """A candidate did not pass the promotion gate."""
