"""Registered queries over the test tables, each next to the SQL that must give the same rows.

Stand-ins: ``events`` are the readings (user = subject, event type = activity, ``value`` = fast
sensor, every tenth ``value`` = slow signal), ``lineitem`` columns are features, ``orders`` give a
multiclass label and prediction, events also play training runs and alias moves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import micros
from ..operators import cleaning, drift, features, metrics, profile, quality, registry, scoring
from ..operators import sketches, training, windows
from ..operators.filling import forward_fill
from ..operators.quantiles import evenly_spaced, exact_quantiles, long_form, name_of_feature
from ..session import observing_session
from ..sources import (
    REJECTED,
    append_history,
    read_delimited_sensor,
    read_history,
    rejected_lines,
    shared_folder,
    write_bucketed,
)
from .features import feature_plan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DAY = 86_400
GROUP = ["subject_id", "activity_id"]
WINDOW = [*GROUP, "win", "phase"]
TRAIN_COHORTS, HOLDOUT_COHORTS = [0, 1], [2]


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def rounded_energy(df: DataFrame, *columns: str) -> DataFrame:
    """Means of squares of two-digit numbers often end in a five at the seventh digit, and sums in
    another order fall on either side of it. A nudge, here and in the SQL, sends all to one side."""
    return rounded(df.withColumn("fast_energy", F.col("fast_energy") + 1e-9), "fast_energy", *columns)


# --- readings -------------------------------------------------------------------------------


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("subject_id"),
        F.col("event_type").alias("activity_id"),
        "ts",
        (F.col("user_id") % 4).alias("cohort"),
        F.col("value").alias("fast"),
        F.when(F.col("event_id") % 10 == 0, F.col("value")).alias("slow"),
    )


def readings_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).withColumn("slow", F.coalesce("slow", F.lit(float("nan"))))


READINGS_SQL = """
readings AS (
  SELECT event_id, user_id AS subject_id, event_type AS activity_id, ts, user_id % 4 AS cohort,
         value AS fast, CASE WHEN event_id % 10 = 0 THEN value END AS slow
  FROM events)"""

FILLED_SQL = f"""{READINGS_SQL},
filled AS (
  SELECT *, last_value(slow IGNORE NULLS) OVER (
    PARTITION BY subject_id, activity_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS slow_filled
  FROM readings)"""


def windowed_sql(source: str, days: int) -> str:
    size = days * DAY * 1_000_000
    return f"""windowed AS (
  SELECT s.*, p.phase,
         CAST(floor((epoch_us(ts) - p.phase * {size // 2}) / {size}.0) AS BIGINT) AS win
  FROM {source} s, (VALUES (0), (1)) p(phase))"""


FAST_STATS_SQL = """round(avg(fast), 6) AS fast_mean, round(stddev_samp(fast), 6) AS fast_std,
         min(fast) AS fast_min, max(fast) AS fast_max, round(avg(fast * fast) + 1e-9, 6) AS fast_energy"""
SLOW_STATS_SQL = """round(avg(slow_filled), 6) AS slow_mean,
         round(stddev_samp(slow_filled), 6) AS slow_std, max(slow_filled) AS slow_max"""
SPLIT_SQL = (
    "CASE WHEN cohort IN (0, 1) THEN 'train' WHEN cohort = 2 THEN 'holdout' "
    "ELSE 'unassigned' END AS split"
)


def day_windows(df: DataFrame) -> DataFrame:
    return windows.assign_overlapping_windows(df, "ts", DAY)


def filled_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forward_fill(
        readings(spark, sf_dir), "slow", partition_cols=GROUP, order_col="ts", tie_col="event_id"
    )


def labelled_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day windows with their split, the input of the profile queries."""
    keys = [*WINDOW, "cohort"]
    wide = features.window_features(day_windows(readings(spark, sf_dir)), keys, ["fast"])
    return features.assign_split(
        wide,
        subject_col="cohort",
        train_subjects=TRAIN_COHORTS,
        holdout_subjects=HOLDOUT_COHORTS,
    )


LABELLED_SQL = f"""{READINGS_SQL},
{windowed_sql("readings", 1)},
labelled AS (
  SELECT subject_id, activity_id, win, phase, {SPLIT_SQL}, count(*) AS sample_count
  FROM windowed GROUP BY subject_id, activity_id, win, phase, cohort)"""


@query(
    f"""WITH {FILLED_SQL}, kept AS (SELECT * FROM filled WHERE activity_id <> 'error'),
{windowed_sql("kept", 10)}
SELECT subject_id, activity_id, cohort, win, phase, {FAST_STATS_SQL}, {SLOW_STATS_SQL},
       count(*) AS sample_count, {SPLIT_SQL}
FROM windowed GROUP BY subject_id, activity_id, cohort, win, phase HAVING count(*) >= 4 * 0.9"""
)
def sensor_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    stable = cleaning.drop_transient(
        cleaning.normalize_nan_to_null(readings_with_nan(spark, sf_dir), ["slow"]),
        transient="error",
    )
    plan = feature_plan(
        stable,
        sensor_cols=["fast"],
        slow_col="slow",
        time_col="ts",
        tie_col="event_id",
        window_seconds=10 * DAY,
        expected=4,
        split_by="cohort",
        train_subjects=TRAIN_COHORTS,
        holdout_subjects=HOLDOUT_COHORTS,
    )
    return rounded_energy(plan, "fast_mean", "fast_std", "slow_mean", "slow_std")


# --- projections and filters ------------------------------------------------------------------


@query(
    r"""SELECT doc_id, TRY_CAST(regexp_extract(source, 'src(\d\d)', 1) AS INTEGER) AS subject_id
FROM documents"""
)
def regex_key_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = table(spark, sf_dir, "documents").select("doc_id", "source")
    return cleaning.extract_subject(sources, "source", r"src(\d\d)").drop("source")


@query(
    """WITH raw AS (
  SELECT event_id, value AS fast,
         CASE WHEN event_id % 10 = 0 THEN value ELSE 'NaN'::DOUBLE END AS slow FROM events)
SELECT event_id, fast, CASE WHEN isnan(slow) THEN NULL ELSE slow END AS slow FROM raw"""
)
def nan_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = readings_with_nan(spark, sf_dir).select("event_id", "fast", "slow")
    return cleaning.normalize_nan_to_null(raw, ["fast", "slow"])


@query("SELECT o_custkey, o_totalprice FROM orders")
def drop_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_columns_like(table(spark, sf_dir, "orders"), "o_order")


@query(
    """SELECT event_id, CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2
  WHEN 'purchase' THEN 3 END AS INTEGER) AS activity_id
FROM events WHERE event_type NOT IN ('error', 'signup')"""
)
def filter_transient(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    code = (
        F.when(kind == "error", 0.0)
        .when(kind == "click", 1.0)
        .when(kind == "view", 2.0)
        .when(kind == "purchase", 3.0)
    )
    coded = table(spark, sf_dir, "events").select("event_id", code.alias("activity_id"))
    return cleaning.drop_transient(coded).withColumn(
        "activity_id", F.col("activity_id").cast("int")
    )


@query(
    r"""SELECT doc_id, TRY_CAST(regexp_extract(source, 'src(\d\d)', 1) AS INTEGER) AS subject_id
FROM documents WHERE regexp_matches(source, 'src\d\d')"""
)
def filter_key_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.require_key(regex_key_extract(spark, sf_dir), "subject_id")


@query(f"WITH {READINGS_SQL} SELECT event_id, {SPLIT_SQL} FROM readings")
def assign_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.assign_split(
        readings(spark, sf_dir).select("event_id", "cohort"),
        subject_col="cohort",
        train_subjects=TRAIN_COHORTS,
        holdout_subjects=HOLDOUT_COHORTS,
    ).drop("cohort")


@query(
    """SELECT o_orderkey, CASE WHEN c_acctbal < 0 THEN 'holdout' WHEN c_acctbal >= 5000 THEN 'train'
  ELSE 'unassigned' END AS split
FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
)
def assign_split_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    lists = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.when(balance < 0, "holdout").when(balance >= 5000, "train").alias("split"),
    )
    return features.assign_split_from_table(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        lists.filter(F.col("split").isNotNull()),
        subject_col="o_custkey",
    ).drop("o_custkey")


@query(
    f"""WITH {LABELLED_SQL}
SELECT subject_id, activity_id, win, phase, sample_count FROM labelled WHERE sample_count >= 1.8"""
)
def drop_partial_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = day_windows(readings(spark, sf_dir)).groupBy(*WINDOW).agg(
        F.count(F.lit(1)).alias("sample_count")
    )
    return features.drop_partial_windows(counted, window_seconds=2, sample_hz=1)


@query(
    f"""WITH {LABELLED_SQL}
SELECT subject_id, activity_id, win, phase, sample_count FROM labelled WHERE split = 'holdout'"""
)
def split_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = labelled_windows(spark, sf_dir).filter(F.col("split") == "holdout")
    return held_out.select(*WINDOW, "sample_count")


@query(
    """SELECT event_id, 'activity-model' AS model_name, v AS model_version, r AS model_run_id
FROM events, (SELECT max(s_suppkey) AS v, max_by(s_name, s_suppkey) AS r FROM supplier)"""
)
def lineage_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    champion = table(spark, sf_dir, "supplier").agg(
        F.lit("activity-model").alias("model_name"),
        F.max("s_suppkey").alias("model_version"),
        F.max_by("s_name", "s_suppkey").alias("model_run_id"),
    )
    rows = table(spark, sf_dir, "events").select("event_id")
    return scoring.stamp_lineage_from(rows, champion)


# --- windows and aggregates -------------------------------------------------------------------


@query(f"WITH {FILLED_SQL} SELECT event_id, slow, slow_filled FROM filled")
def forward_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled_readings(spark, sf_dir).select("event_id", "slow", "slow_filled")


QUERIES["forward_fill"] = QUERIES.pop("forward_filled")
ORACLE["forward_fill"] = ORACLE.pop("forward_filled")


@query(
    f"""WITH {READINGS_SQL}
SELECT event_id, last_value(slow IGNORE NULLS) OVER (PARTITION BY activity_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS slow_filled
FROM readings"""
)
def forward_fill_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five groups hold all rows; each is filled in many chunks of time."""
    filled = forward_fill(
        readings(spark, sf_dir),
        "slow",
        partition_cols=["activity_id"],
        order_col="ts",
        tie_col="event_id",
        span_seconds=6 * 3600,
    )
    return filled.select("event_id", "slow_filled")


@query(
    f"""WITH {READINGS_SQL},
coarse AS (SELECT *, date_trunc('day', ts) AS day FROM readings),
instants AS (
  SELECT activity_id, day, max(slow) AS here FROM coarse GROUP BY activity_id, day),
carried AS (
  SELECT activity_id, day, last_value(here IGNORE NULLS) OVER (PARTITION BY activity_id ORDER BY day
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM instants)
SELECT event_id, coalesce(slow, value) AS slow_filled
FROM coarse JOIN carried USING (activity_id, day)"""
)
def forward_fill_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Very many rows at each place, and no column that tells them apart."""
    coarse = readings_with_nan(spark, sf_dir).withColumn("day", F.date_trunc("day", "ts"))
    filled = forward_fill(
        coarse, "slow", partition_cols=["activity_id"], order_col="day", span_seconds=3 * DAY
    )
    return filled.select("event_id", "slow_filled")


@query(
    f"WITH {READINGS_SQL}, {windowed_sql('readings', 1)} SELECT event_id, win, phase FROM windowed"
)
def overlapping_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_windows(readings(spark, sf_dir).select("event_id", "ts")).drop("ts")


@query(ORACLE["overlapping_windows"])
def overlapping_windows_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).select("event_id", "ts")
    return windows.assign_windows_by_union(rows, "ts", DAY).drop("ts")


@query(
    f"""WITH {READINGS_SQL}, {windowed_sql('readings', 1)}
SELECT subject_id, win * {DAY * 1_000_000} + phase * {DAY * 500_000} AS start_us,
       count(*) AS readings
FROM windowed GROUP BY subject_id, win, phase"""
)
def sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = windows.assign_sliding_windows(readings(spark, sf_dir), "ts", DAY)
    counted = spans.groupBy("subject_id", "window_start").agg(F.count(F.lit(1)).alias("readings"))
    return counted.select(
        "subject_id", micros(counted, "window_start").alias("start_us"), "readings"
    )


@query(
    f"""WITH {READINGS_SQL}, {windowed_sql('readings', 1)}
SELECT subject_id, activity_id, win, phase, {FAST_STATS_SQL}, count(*) AS sample_count
FROM windowed GROUP BY subject_id, activity_id, win, phase"""
)
def window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = features.window_features(day_windows(readings(spark, sf_dir)), WINDOW, ["fast"])
    return rounded_energy(wide, "fast_mean", "fast_std")


@query(
    f"""WITH {FILLED_SQL}, {windowed_sql('filled', 1)}
SELECT subject_id, activity_id, win, phase, {SLOW_STATS_SQL}, count(*) AS sample_count
FROM windowed GROUP BY subject_id, activity_id, win, phase"""
)
def filled_signal_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = features.window_features(
        day_windows(filled_readings(spark, sf_dir)), WINDOW, [], {"slow_filled": "slow"}
    )
    return rounded(wide, "slow_mean", "slow_std")


@query(
    f"""WITH {READINGS_SQL}
SELECT subject_id, count(*) AS "rows", count(DISTINCT activity_id) AS activities,
       round(avg(CAST(slow IS NULL AS INTEGER)), 3) AS null_rate
FROM readings GROUP BY subject_id"""
)
def ingest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.ingest_profile(readings(spark, sf_dir), signal_col="slow")


@query(
    f"""WITH {READINGS_SQL}
SELECT round(avg(CAST(slow IS NULL AS INTEGER)), 6) AS slow,
       round(avg(CAST(fast IS NULL AS INTEGER)), 6) AS fast FROM readings"""
)
def null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        profile.null_rates(readings(spark, sf_dir), ["slow", "fast"]), "slow", "fast"
    )


@query("SELECT count(DISTINCT user_id) AS subjects FROM events")
def distinct_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_count(table(spark, sf_dir, "events"), "user_id", "subjects")


@query(
    f"""WITH {LABELLED_SQL}
SELECT split, count(*) AS windows, count(DISTINCT subject_id) AS subjects,
       count(DISTINCT activity_id) AS activities
FROM labelled GROUP BY split"""
)
def split_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.split_profile(labelled_windows(spark, sf_dir))


@query(
    f"""WITH {LABELLED_SQL}
SELECT activity_id, split, count(*) AS "count" FROM labelled GROUP BY activity_id, split"""
)
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.class_balance(labelled_windows(spark, sf_dir))


@query(
    """SELECT c_mktsegment, string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) AS members
FROM (SELECT DISTINCT c_mktsegment, c_nationkey AS k FROM customer) GROUP BY c_mktsegment"""
)
def provenance_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.provenance_list(
        table(spark, sf_dir, "customer"), "c_nationkey", ["c_mktsegment"]
    )


# --- classification metrics ---------------------------------------------------------------------


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five true classes; the sixth predicted class is never true."""
    return table(spark, sf_dir, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("label"),
        (F.col("o_custkey") % 6 + 1).cast("int").alias("prediction"),
        "o_custkey",
        "o_orderdate",
    )


SCORED_SQL = """
scored AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS label,
         CAST(o_custkey % 6 + 1 AS INTEGER) AS prediction, o_custkey, o_orderdate
  FROM orders)"""


def per_class_sql(source: str) -> str:
    return f"""
per_class AS (
  SELECT class, hits / CASE WHEN predicted = 0 THEN 1 ELSE predicted END AS "precision",
         hits / CASE WHEN support = 0 THEN 1 ELSE support END AS recall,
         2 * hits / (predicted + support) AS f1, support
  FROM (
    SELECT c.class,
           (SELECT count(*) FROM {source} WHERE label = c.class AND prediction = c.class)
             AS hits,
           (SELECT count(*) FROM {source} WHERE label = c.class) AS support,
           (SELECT count(*) FROM {source} WHERE prediction = c.class) AS predicted
    FROM (SELECT label AS class FROM {source} UNION SELECT prediction FROM {source}) c))"""


@query(
    """SELECT round(avg(CAST(quality = toxic AS INTEGER)), 6) AS accuracy FROM labels"""
)
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = metrics.confusion(table(spark, sf_dir, "labels"), "quality", "toxic")
    return rounded(metrics.accuracy(counts), "accuracy")


@query(
    f"""WITH {SCORED_SQL}, {per_class_sql("scored")}
SELECT round(avg(f1), 6) AS macro_f1 FROM per_class"""
)
def macro_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = metrics.confusion(scored_orders(spark, sf_dir))
    return rounded(metrics.macro_f1(counts), "macro_f1")


@query(
    f"""WITH {SCORED_SQL}, {per_class_sql("scored")}
SELECT round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM per_class"""
)
def weighted_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = metrics.confusion(scored_orders(spark, sf_dir))
    return rounded(metrics.weighted_f1(counts), "weighted_f1")


@query(
    f"""WITH {SCORED_SQL}, {per_class_sql("scored")},
report AS (
  SELECT CAST(class AS VARCHAR) AS class, "precision", recall, f1, support FROM per_class
  UNION ALL SELECT 'macro avg', avg("precision"), avg(recall), avg(f1), sum(support)
    FROM per_class
  UNION ALL SELECT 'weighted avg', sum("precision" * support) / sum(support),
    sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
    FROM per_class
  UNION ALL SELECT 'accuracy', NULL, NULL, avg(CAST(label = prediction AS INTEGER)), count(*)
    FROM scored)
SELECT class, round("precision", 6) AS "precision", round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM report"""
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = metrics.confusion(scored_orders(spark, sf_dir))
    return rounded(metrics.classification_report(counts), "precision", "recall", "f1")


@query(
    f"""WITH {SCORED_SQL}, held AS (SELECT * FROM scored WHERE o_custkey % 3 = 0),
rest AS (SELECT * FROM scored WHERE o_custkey % 3 <> 0),
a AS (WITH {per_class_sql("held")} SELECT avg(f1) AS f FROM per_class),
b AS (WITH {per_class_sql("rest")} SELECT avg(f1) AS f FROM per_class)
SELECT round(a.f, 6) AS realised_macro_f1, round(b.f, 6) AS promoted_macro_f1,
       round(a.f - b.f, 6) AS performance_delta FROM a, b"""
)
def performance_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_orders(spark, sf_dir)
    held = F.col("o_custkey") % 3 == 0
    realised = metrics.macro_f1(metrics.confusion(scored.filter(held)))
    promoted = metrics.macro_f1(metrics.confusion(scored.filter(~held)))
    delta = metrics.performance_delta(
        realised.withColumnRenamed("macro_f1", "realised_macro_f1"),
        promoted.withColumnRenamed("macro_f1", "promoted_macro_f1"),
    )
    return rounded(delta, *delta.columns)


@query(
    f"""WITH {SCORED_SQL}, gappy AS (
  SELECT CASE WHEN o_custkey % 11 <> 0 THEN label END AS label,
         CASE WHEN o_custkey % 7 <> 0 THEN prediction END AS prediction, o_custkey FROM scored),
known AS (SELECT * FROM gappy WHERE label IS NOT NULL),
{per_class_sql("known")},
named AS (SELECT * FROM per_class WHERE class IS NOT NULL),
right_ones AS (SELECT avg(CAST(coalesce(label = prediction, false) AS INTEGER)) AS a FROM known)
SELECT round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1,
       round(any_value(a), 6) AS accuracy, round(any_value(a), 6) AS summary_accuracy,
       round(any_value(a), 6) AS report_accuracy
FROM named, right_ones"""
)
def metrics_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metrics under one rule: no label, no row; no prediction, a miss."""
    gappy = scored_orders(spark, sf_dir).withColumns(
        {
            "label": F.when(F.col("o_custkey") % 11 != 0, F.col("label")).cast("double"),
            "prediction": F.when(F.col("o_custkey") % 7 != 0, F.col("prediction").cast("double"))
            .otherwise(F.lit(float("nan"))),
        }
    )
    counts = metrics.confusion(gappy)
    summary = profile.scored_summary(
        gappy, label_col="label", prediction_col="prediction", time_col="o_orderdate"
    )
    report = metrics.classification_report(counts).filter("class = 'accuracy'")
    together = metrics.evaluation(counts).select(
        "macro_f1",
        "weighted_f1",
        metrics.accuracy(counts).scalar().alias("accuracy"),
        summary.select("accuracy").scalar().alias("summary_accuracy"),
        report.select("f1").scalar().alias("report_accuracy"),
    )
    return rounded(together, *together.columns)


@query(
    f"""WITH {SCORED_SQL}
SELECT count(*) AS "rows", round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy,
       epoch_us(max(o_orderdate)) AS latest_run FROM scored"""
)
def scored_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = profile.scored_summary(
        scored_orders(spark, sf_dir),
        label_col="label",
        prediction_col="prediction",
        time_col="o_orderdate",
    )
    return rounded(summary.withColumn("latest_run", micros(summary, "latest_run")), "accuracy")


# --- drift --------------------------------------------------------------------------------------

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SHIFTED = ["quantity_up", "price_scaled", "tax_same"]


def line_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    current = F.col("l_suppkey") % 3 == 0
    return lines.filter(~current), lines.filter(current)


def shifted_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A mild shift, a strong shift and none, on the current side."""
    before, after = line_sides(spark, sf_dir)
    names = dict(zip(SHIFTED, ["l_quantity", "l_extendedprice", "l_tax"]))
    keep = ["l_linenumber", "l_partkey"]
    return (
        before.select(*keep, *[F.col(c).alias(name) for name, c in names.items()]),
        after.select(
            *keep,
            (F.col("l_quantity") + 5).alias("quantity_up"),
            (F.col("l_extendedprice") * 2).alias("price_scaled"),
            F.col("l_tax").alias("tax_same"),
        ),
    )


SIDES_SQL = """
sides AS (
  UNPIVOT (SELECT l_suppkey % 3 <> 0 AS is_ref, l_quantity, l_extendedprice, l_discount, l_tax
           FROM lineitem)
  ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE value)"""

SHIFTED_SQL = """
sides AS (
  UNPIVOT (SELECT l_suppkey % 3 <> 0 AS is_ref,
             CASE WHEN l_suppkey % 3 <> 0 THEN l_quantity ELSE l_quantity + 5 END AS quantity_up,
             CASE WHEN l_suppkey % 3 <> 0 THEN l_extendedprice ELSE l_extendedprice * 2 END
               AS price_scaled,
             l_tax AS tax_same
           FROM lineitem)
  ON quantity_up, price_scaled, tax_same INTO NAME feature VALUE value)"""

_PROBABILITIES = ", ".join(f"{p!r}::DOUBLE" for p in evenly_spaced(drift.BINS))
EDGES_SQL = f"""
edges AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(value, [{_PROBABILITIES}]))) AS edges,
         count(*) AS n
  FROM sides WHERE is_ref AND value IS NOT NULL AND NOT isnan(value) GROUP BY feature)"""

HISTOGRAM_SQL = f"""{EDGES_SQL},
histogram AS (
  SELECT s.feature, len(list_filter(e.edges[2:-2], lambda x: x <= s.value)) AS bin,
         count_if(is_ref) AS n_ref, count_if(NOT is_ref) AS n_cur
  FROM sides s LEFT JOIN edges e ON s.feature = e.feature
  WHERE s.value IS NOT NULL AND NOT isnan(s.value)
  GROUP BY s.feature, bin)"""

PSI_SQL = f"""{HISTOGRAM_SQL},
floored AS (
  SELECT feature, greatest(n_ref / sum(n_ref) OVER (PARTITION BY feature), 1e-6) AS r,
         greatest(n_cur / sum(n_cur) OVER (PARTITION BY feature), 1e-6) AS c
  FROM histogram),
feature_psi AS (SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM floored GROUP BY feature)"""


@query(
    f"""WITH {SIDES_SQL}, {EDGES_SQL}
SELECT feature, n, i - 1 AS edge_no, round(edges[i], 6) AS edge
FROM (SELECT feature, n, edges, unnest(range(1, len(edges) + 1)) AS i FROM edges)"""
)
def quantile_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, _ = line_sides(spark, sf_dir)
    edges = drift.quantile_edges(reference, LINE_FEATURES)
    listed = edges.select("feature", "n", F.posexplode("edges").alias("edge_no", "edge"))
    return rounded(listed.withColumn("edge_no", F.col("edge_no").cast("long")), "edge")


@query(ORACLE["quantile_edges"])
def quantile_edges_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same edges from coarse sketches, so that buckets hold many distinct values."""
    reference, _ = line_sides(spark, sf_dir)
    found = exact_quantiles(reference, LINE_FEATURES, evenly_spaced(drift.BINS), accuracy=10, inner_cuts=3)
    edges = found.select("feature", "n", F.array_distinct("quantiles").alias("edges"))
    listed = edges.select("feature", "n", F.posexplode("edges").alias("edge_no", "edge"))
    return rounded(listed.withColumn("edge_no", F.col("edge_no").cast("long")), "edge")


@query(
    f"""WITH {SIDES_SQL}, {HISTOGRAM_SQL}
SELECT feature, CAST(bin AS INTEGER) AS bin, CAST(n_ref AS BIGINT) AS n_ref,
       CAST(n_cur AS BIGINT) AS n_cur FROM histogram"""
)
def histogram_by_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = line_sides(spark, sf_dir)
    edges = drift.quantile_edges(reference, LINE_FEATURES)
    return drift.histogram_by_edges(reference, current, LINE_FEATURES, edges)


@query(f"WITH {SIDES_SQL}, {PSI_SQL} SELECT feature, round(psi, 6) AS psi FROM feature_psi")
def feature_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = line_sides(spark, sf_dir)
    return rounded(drift.psi(reference, current, LINE_FEATURES), "psi")


@query(ORACLE["feature_psi"])
def psi_from_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's edges and counts are written once; PSI then reads them and the current rows."""
    reference, current = line_sides(spark, sf_dir)
    path = shared_folder(spark, "baseline")
    drift.baseline(reference, LINE_FEATURES).write.parquet(path)
    return rounded(drift.psi_from_baseline(spark.read.parquet(path), current, LINE_FEATURES), "psi")


def batch_sketches(spark: SparkSession, sides: DataFrame, features_: list[str], split: str) -> DataFrame:
    """Quantile sketches of three batches, each appended by itself, read back as one history."""
    path = shared_folder(spark, "sketches")
    for batch in range(3):
        rows = sides.filter(F.col(split) % 3 == batch)
        kept = sketches.quantile_sketches(rows, features_).withColumn("batch", F.lit(batch))
        append_history(kept, path, ["batch"])
    return read_history(spark, path)


@query(
    f"""WITH {SIDES_SQL}
SELECT feature, count(*) AS n, CAST(p.i AS INTEGER) AS quantile_no, true AS within
FROM sides, (SELECT unnest(range(0, {drift.BINS + 1})) AS i) p
WHERE is_ref AND value IS NOT NULL AND NOT isnan(value) GROUP BY feature, p.i"""
)
def merged_sketch_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of three merged batches, each held against exact counts of the values below it."""
    reference, _ = line_sides(spark, sf_dir)
    kept = batch_sketches(spark, reference, LINE_FEATURES, "l_orderkey")
    points = evenly_spaced(drift.BINS)
    found = sketches.merged_quantiles(kept, points)
    # four rows, one a feature
    long = long_form(reference, LINE_FEATURES).selectExpr(name_of_feature(LINE_FEATURES), "value")
    met = long.join(F.broadcast(found.select("feature", "quantiles")), "feature")
    counts = [
        F.struct(
            F.count_if(F.col("value") < F.get("quantiles", F.lit(i))).alias("below"),
            F.count_if(F.col("value") <= F.get("quantiles", F.lit(i))).alias("upto"),
            F.lit(p).alias("p"),
        )
        for i, p in enumerate(points)
    ]
    held = met.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.array(*counts).alias("counts"))
    stated = held.join(found.select("feature", F.col("n").alias("sketched")), "feature").filter("n = sketched")
    listed = stated.select("feature", "n", F.posexplode("counts").alias("quantile_no", "c"))
    error = sketches.rank_error()
    within = (F.col("c.below") / F.col("n") - error <= F.col("c.p")) & (
        F.col("c.p") <= F.col("c.upto") / F.col("n") + error
    )
    return listed.select("feature", "n", "quantile_no", within.alias("within"))


@query(
    f"""WITH {SHIFTED_SQL}, {PSI_SQL}
SELECT feature, true AS close,
       CASE WHEN psi >= 0.25 THEN 'significant' WHEN psi >= 0.1 THEN 'moderate' ELSE 'stable' END AS band
FROM feature_psi"""
)
def psi_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of three merged batches against a baseline, from sketches alone, next to the exact PSI."""
    reference, current = shifted_sides(spark, sf_dir)
    kept = batch_sketches(spark, current, SHIFTED, "l_partkey")
    near = sketches.psi_from_sketches(drift.baseline(reference, SHIFTED), kept, SHIFTED)
    exact = drift.psi(reference, current, SHIFTED).withColumnRenamed("psi", "exact")
    both = near.join(exact, "feature")
    # a share is off by the rank error; the floor of a share makes the largest term about ln(10^6) times that
    limit = 2 * drift.BINS * sketches.rank_error() * 14
    close = F.abs(F.col("psi") - F.col("exact")) <= limit
    return both.select("feature", close.alias("close"), drift.band(F.col("psi")).alias("band"))


COUNTED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "WITH c AS (UNPIVOT (SELECT "
    + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in COUNTED)
    + """ FROM lineitem) ON COLUMNS(*) INTO NAME "column" VALUE exact)
SELECT "column", exact, true AS within FROM c"""
)
def merged_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts of two batches that share most values, from merged sketches, next to the exact ones."""
    lines = table(spark, sf_dir, "lineitem")
    path = shared_folder(spark, "distinct")
    for batch in range(2):
        rows = lines.filter(F.col("l_linenumber") % 2 == batch)
        append_history(sketches.distinct_sketches(rows, COUNTED).withColumn("batch", F.lit(batch)), path, ["batch"])
    near = sketches.merged_distinct(read_history(spark, path))
    counts = lines.agg(*[F.count_distinct(c).alias(c) for c in COUNTED])
    exact = counts.unpivot([], COUNTED, "column", "exact")
    off = F.abs(F.col("distinct_values") / F.col("exact") - 1)
    within = off <= 3 * sketches.distinct_error()
    return near.join(exact, "column").select("column", "exact", within.alias("within"))


GUARDED = ["constant", "few_values", "only_reference", "never", "far_apart"]


@query(
    """WITH price AS (
  SELECT min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders),
sides AS (
  SELECT o_custkey % 3 <> 0 AS is_ref,
         CASE WHEN o_custkey % 3 <> 0 THEN o_totalprice ELSE o_totalprice + 1e9 END AS value
  FROM orders),
"""
    + EDGES_SQL.replace("SELECT feature,", "SELECT 'far_apart' AS feature,").replace(
        " GROUP BY feature", ""
    )
    + """,
histogram AS (
  SELECT len(list_filter(e.edges[2:-2], lambda x: x <= s.value)) AS bin,
         count_if(is_ref) AS n_ref, count_if(NOT is_ref) AS n_cur
  FROM sides s, edges e GROUP BY bin),
floored AS (
  SELECT greatest(n_ref / sum(n_ref) OVER (), 1e-6) AS r,
         greatest(n_cur / sum(n_cur) OVER (), 1e-6) AS c FROM histogram)
SELECT 'far_apart' AS feature, true AS defined, round(sum((c - r) * ln(c / r)), 6) AS psi
FROM floored
UNION ALL SELECT f, false, NULL
FROM (VALUES ('constant'), ('few_values'), ('only_reference'), ('never')) v(f)"""
)
def psi_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    is_ref = F.col("o_custkey") % 3 != 0
    price, never = F.col("o_totalprice"), F.lit(None).cast("double")
    # The cheapest order is a reference or a current row; either way fewer than ten values.
    cheapest = orders.agg(F.min("o_totalprice").alias("low"))
    shaped = orders.select(
        is_ref.alias("is_ref"),
        F.lit(1.0).alias("constant"),
        F.when(price == cheapest.scalar(), price).alias("few_values"),
        F.when(is_ref, price).alias("only_reference"),
        never.alias("never"),
        F.when(is_ref, price).otherwise(price + 1e9).alias("far_apart"),
    )
    found = drift.psi(shaped.filter("is_ref"), shaped.filter("NOT is_ref"), GUARDED)
    defined = ~F.isnan("psi")
    return found.select(
        "feature",
        defined.alias("defined"),
        F.when(defined, F.round("psi", 6)).alias("psi"),
    )


@query(
    """WITH counts AS (
  SELECT o_orderpriority, count_if(o_custkey % 3 <> 0) AS n_ref,
         count_if(o_custkey % 3 = 0) AS n_cur FROM orders GROUP BY o_orderpriority),
floored AS (
  SELECT greatest(n_ref / sum(n_ref) OVER (), 1e-6) AS r,
         greatest(n_cur / sum(n_cur) OVER (), 1e-6) AS c FROM counts)
SELECT round(sum((c - r) * ln(c / r)), 6) AS psi FROM floored"""
)
def categorical_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    current = F.col("o_custkey") % 3 == 0
    found = drift.categorical_psi(
        orders.filter(~current), "o_orderpriority", orders.filter(current), "o_orderpriority"
    )
    return rounded(found, "psi")


@query(
    f"""WITH {SHIFTED_SQL}, {PSI_SQL}
SELECT count(*) AS features_compared, CAST(count_if(psi >= 0.25) AS BIGINT) AS features_significant,
       CAST(count_if(psi >= 0.1 AND psi < 0.25) AS BIGINT) AS features_moderate,
       round(max(psi), 6) AS max_feature_psi, max_by(feature, psi) AS top_drifted_feature
FROM feature_psi"""
)
def psi_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drift.psi(*shifted_sides(spark, sf_dir), SHIFTED)
    return rounded(drift.psi_bands(found), "max_feature_psi")


@query(
    f"""WITH {SHIFTED_SQL}, {PSI_SQL}
SELECT feature, round(psi, 6) AS psi FROM feature_psi ORDER BY psi DESC, feature LIMIT 20"""
)
def top_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drift.psi(*shifted_sides(spark, sf_dir), SHIFTED)
    return rounded(drift.top_drifted(found), "psi")


@query(
    """SELECT c_custkey, CASE
  WHEN c_acctbal / 100000 < -0.002 THEN 'performance_degraded'
  WHEN c_nationkey % 5 = 0 OR (c_nationkey % 5 <> 1 AND c_acctbal / 20000 >= 0.25)
    THEN 'drift_detected'
  WHEN c_nationkey % 5 <> 1 AND c_acctbal / 20000 >= 0.1 THEN 'drift_moderate'
  ELSE 'ok' END AS status
FROM customer"""
)
def drift_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("c_nationkey") % 5
    undefined = F.lit(float("nan"))
    status = drift.drift_status(
        F.when(kind == 0, 1).otherwise(0),
        F.when(kind == 1, undefined).otherwise(F.col("c_acctbal") / 20000),
        F.col("c_acctbal") / 100000,
        performance_tolerance=0.002,
    )
    return table(spark, sf_dir, "customer").select("c_custkey", status.alias("status"))


@query(
    f"""WITH {SHIFTED_SQL}, {PSI_SQL},
scored AS (SELECT l_linenumber AS label, CAST(l_partkey % 7 + 1 AS INTEGER) AS prediction
           FROM lineitem WHERE l_suppkey % 3 = 0),
{per_class_sql("scored")},
mix AS (
  SELECT category, sum(n_ref) AS n_ref, sum(n_cur) AS n_cur FROM (
    SELECT l_linenumber AS category, 1 AS n_ref, 0 AS n_cur FROM lineitem WHERE l_suppkey % 3 <> 0
    UNION ALL SELECT prediction, 0, 1 FROM scored) GROUP BY category),
floored_mix AS (
  SELECT greatest(n_ref / sum(n_ref) OVER (), 1e-6) AS r,
         greatest(n_cur / sum(n_cur) OVER (), 1e-6) AS c FROM mix),
champion AS (
  SELECT max(s_suppkey) AS model_version, max_by(s_name, s_suppkey) AS model_run_id,
         avg(s_suppkey % 2) AS promoted FROM supplier),
parts AS (
  SELECT 'line-model' AS model_name, champion.*,
    (SELECT sum(n_ref) FROM mix) AS reference_rows, (SELECT sum(n_cur) FROM mix) AS current_rows,
    (SELECT count_if(psi >= 0.25) FROM feature_psi) AS features_significant,
    (SELECT count_if(psi >= 0.1 AND psi < 0.25) FROM feature_psi) AS features_moderate,
    (SELECT max(psi) FROM feature_psi) AS max_psi,
    (SELECT max_by(feature, psi) FROM feature_psi) AS top_drifted_feature,
    (SELECT sum((c - r) * ln(c / r)) FROM floored_mix) AS prediction_psi,
    (SELECT avg(f1) FROM per_class) AS realised
  FROM champion)
SELECT model_name, model_version, model_run_id, CAST(reference_rows AS BIGINT) AS reference_rows,
  CAST(current_rows AS BIGINT) AS current_rows,
  CAST(features_significant AS BIGINT) AS features_significant,
  CAST(features_moderate AS BIGINT) AS features_moderate, round(max_psi, 6) AS max_feature_psi,
  top_drifted_feature, round(prediction_psi, 6) AS prediction_psi,
  round(promoted, 6) AS promoted_macro_f1, round(realised, 6) AS realised_macro_f1,
  round(realised - promoted, 6) AS performance_delta,
  CASE WHEN realised - promoted < -0.05 THEN 'performance_degraded'
       WHEN features_significant > 0 OR prediction_psi >= 0.25 THEN 'drift_detected'
       WHEN features_moderate > 0 OR prediction_psi >= 0.1 THEN 'drift_moderate'
       ELSE 'ok' END AS status
FROM parts"""
)
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = shifted_sides(spark, sf_dir)
    champion = table(spark, sf_dir, "supplier").agg(
        F.lit("line-model").alias("model_name"),
        F.max("s_suppkey").alias("model_version"),
        F.max_by("s_name", "s_suppkey").alias("model_run_id"),
        F.avg(F.col("s_suppkey") % 2).alias("promoted_macro_f1"),
    )
    scored = current.withColumn("prediction", (F.col("l_partkey") % 7 + 1).cast("int"))
    report = drift.drift_report(
        reference,
        scored,
        SHIFTED,
        champion,
        label_col="l_linenumber",
        prediction_col="prediction",
    )
    return rounded(
        report,
        "max_feature_psi",
        "prediction_psi",
        "promoted_macro_f1",
        "realised_macro_f1",
        "performance_delta",
    )


# --- joins, sets and histories --------------------------------------------------------------------


@query(
    f"""WITH {READINGS_SQL}, {windowed_sql('readings', 1)},
gold AS (SELECT subject_id, activity_id, win, phase, count(*) AS sample_count FROM windowed
         GROUP BY ALL),
predictions AS (
  SELECT subject_id, win, phase, arg_max(activity_id, (ts, activity_id)) AS predicted_activity_id
  FROM windowed GROUP BY subject_id, win, phase)
SELECT subject_id, win, phase, activity_id, sample_count, predicted_activity_id
FROM gold JOIN predictions USING (subject_id, win, phase)"""
)
def join_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reading appends a prediction, so a window has as many predictions as readings."""
    return scoring.join_predictions(*windows_and_predictions(spark, sf_dir))


def windows_and_predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = day_windows(readings(spark, sf_dir))
    gold = rows.groupBy(*WINDOW).agg(F.count(F.lit(1)).alias("sample_count"))
    predictions = rows.select(
        "subject_id",
        "win",
        "phase",
        F.col("activity_id").alias("predicted_activity_id"),
        F.col("ts").alias("scored_at"),
    )
    return gold, predictions


@query(ORACLE["join_predictions"])
def join_predictions_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join over tables dealt into buckets by its keys: neither side is shuffled again."""
    held = []
    for df in windows_and_predictions(spark, sf_dir):
        path = shared_folder(spark, "bucketed")
        name = "bucketed_" + path.rsplit("-", 1)[1]
        write_bucketed(df, name, scoring.WINDOW_KEYS, 8, path)
        held.append(spark.table(name))
    return scoring.join_predictions(*held)


@query(
    """SELECT DISTINCT o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"""
)
def unknown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    return quality.unknown_values(
        table(spark, sf_dir, "orders"), "o_custkey", known, "c_custkey"
    )


@query(
    """SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'"""
)
def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    return quality.shared_keys(orders.filter(status == "F"), orders.filter(status == "O"), "o_custkey")


@query(ORACLE["split_leakage"])
def split_leakage_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    labelled = table(spark, sf_dir, "orders").select(
        "o_custkey", F.when(status == "F", "train").when(status == "O", "holdout").alias("split")
    )
    return quality.split_leakage(labelled, "o_custkey")


@query(
    """WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'),
r AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O')
SELECT o_custkey, 'left' AS only_in FROM (FROM a EXCEPT FROM r)
UNION ALL SELECT o_custkey, 'right' FROM (FROM r EXCEPT FROM a)"""
)
def class_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    return quality.class_coverage(
        orders.filter(status == "F"), orders.filter(status == "O"), "o_custkey"
    )


@query(
    """WITH daily AS (
  SELECT date_trunc('day', ts) AS d, count(*) AS readings, max(value) AS peak FROM events GROUP BY d)
SELECT epoch_us(d) AS computed_us, readings,
       CASE WHEN day(d) > 15 THEN peak END AS peak FROM daily"""
)
def history_append_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two report batches; the second brings a new column. Newest first."""
    events = table(spark, sf_dir, "events")
    daily = events.groupBy(F.date_trunc("day", "ts").alias("computed_at")).agg(
        F.count(F.lit(1)).alias("readings"), F.max("value").alias("peak")
    )
    late = F.dayofmonth("computed_at") > 15
    path = shared_folder(spark, "history")
    append_history(daily.filter(~late).drop("peak"), path)
    append_history(daily.filter(late), path)
    history = read_history(spark, path).orderBy(F.col("computed_at").desc())
    return history.select(micros(history, "computed_at").alias("computed_us"), "readings", "peak")


# --- registry ---------------------------------------------------------------------------------------


def registry_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every event is a run of its user's model; clicks, purchases and views were registered, and
    purchases and signups moved an alias."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    model = F.concat(F.lit("model-"), F.col("user_id")).alias("model_name")
    run = F.concat(F.lit("run-"), F.col("event_id")).alias("run_id")
    return {
        "runs": events.select(
            model,
            run,
            F.when(kind == "error", "FAILED").otherwise("FINISHED").alias("status"),
            F.col("ts").alias("start_time"),
            F.create_map(F.lit(registry.METRIC), F.col("value") / 100).alias("metrics"),
        ),
        "versions": events.filter(kind.isin("click", "purchase", "view")).select(
            model, F.col("event_id").alias("version"), run
        ),
        "aliases": events.filter(kind.isin("purchase", "signup")).select(
            model,
            F.when(kind == "purchase", registry.CHAMPION)
            .otherwise(registry.CHALLENGER)
            .alias("alias"),
            F.col("event_id").alias("version"),
            F.col("event_id").alias("seq"),
            F.col("ts").alias("moved_at"),
        ),
    }


REGISTRY_SQL = """
models AS (SELECT DISTINCT 'model-' || user_id AS model_name FROM events),
runs AS (
  SELECT 'model-' || user_id AS model_name, 'run-' || event_id AS run_id, event_id,
         event_type <> 'error' AS finished, ts, value / 100 AS score FROM events),
versions AS (SELECT model_name, event_id AS version, run_id FROM runs
  WHERE event_id IN (SELECT event_id FROM events WHERE event_type IN ('click', 'purchase', 'view'))),
held AS (
  SELECT 'model-' || user_id AS model_name,
         CASE event_type WHEN 'purchase' THEN 'champion' ELSE 'challenger' END AS alias,
         max(event_id) AS version
  FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY ALL),
newest AS (
  SELECT * FROM runs WHERE finished
  QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY ts DESC, run_id DESC) = 1),
champions AS (
  SELECT m.model_name, h.version, v.run_id, r.score FROM models m
  LEFT JOIN held h ON h.model_name = m.model_name AND h.alias = 'champion'
  LEFT JOIN versions v ON v.model_name = m.model_name AND v.version = h.version
  LEFT JOIN runs r ON r.run_id = v.run_id)"""


@query(
    f"""WITH {REGISTRY_SQL}
SELECT model_name, run_id, round(score, 6) AS score FROM newest"""
)
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = registry.latest_run(registry_tables(spark, sf_dir)["runs"], ["model_name"])
    score = F.round(F.col("metrics")[registry.METRIC], 6)
    return newest.select("model_name", "run_id", score.alias("score"))


@query(
    f"""WITH {REGISTRY_SQL}
SELECT m.model_name, coalesce(max(v.version), 0) + 1 AS version
FROM models m LEFT JOIN versions v USING (model_name) GROUP BY m.model_name"""
)
def next_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = registry_tables(spark, sf_dir)
    return registry.next_version(tables["runs"], tables["versions"])


@query(
    f"""WITH {SIDES_SQL}, {PSI_SQL}
SELECT feature, round(psi, 6) AS psi,
       CASE WHEN psi >= 0.25 THEN 'significant' WHEN psi >= 0.1 THEN 'moderate' ELSE 'stable' END AS band
FROM feature_psi"""
)
def drift_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = line_sides(spark, sf_dir)
    return rounded(drift.psi_detail(drift.psi(reference, current, LINE_FEATURES)), "psi")


@query(
    "SELECT "
    + ", ".join(
        f"round(avg(CAST(l_{c} IS NULL AS INTEGER)), 6) AS l_{c}" for c in ("quantity", "extendedprice", "discount", "tax")
    )
    + " FROM lineitem"
)
def prefixed_null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature columns of a table, by prefix and without its ids."""
    lines = table(spark, sf_dir, "lineitem")
    numbers = lines.select([c for c, kind in lines.dtypes if kind == "double"])
    chosen = features.feature_columns(lines.select(cleaning.columns_with_prefix(numbers, ["l_"])), [])
    return rounded(profile.null_rates(lines, chosen), *chosen)


@query(f"WITH {REGISTRY_SQL} SELECT model_name, alias, version FROM held")
def alias_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.alias_current(registry_tables(spark, sf_dir)["aliases"])


def champions(tables: dict[str, DataFrame]) -> DataFrame:
    return registry.champion_lookup(
        tables["runs"], tables["aliases"], tables["versions"], tables["runs"]
    )


@query(
    f"""WITH {REGISTRY_SQL}
SELECT model_name, version, run_id, round(score, 6) AS score FROM champions"""
)
def champion_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(champions(registry_tables(spark, sf_dir)), "score")


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest run of every model against its champion; some runs lack a signature."""
    tables = registry_tables(spark, sf_dir)
    latest = registry.latest_run(tables["runs"], ["model_name"])
    held = champions(tables).select(
        "model_name",
        F.col("version").alias("champion_version"),
        F.col("score").alias("champion_score"),
    )
    number = F.replace(F.col("run_id"), F.lit("run-"), F.lit("")).cast("long")
    candidates = latest.join(held, "model_name", "left").select(
        "model_name",
        number.alias("version"),
        "run_id",
        F.col("metrics")[registry.METRIC].alias("candidate_score"),
        (number % 7 != 0).alias("has_signature"),
        "champion_version",
        "champion_score",
    )
    return registry.evaluate_gate(candidates, floor=0.25)


JUDGED_SQL = f"""{REGISTRY_SQL},
judged AS (
  SELECT n.model_name, n.event_id AS version, n.run_id, n.score AS s, c.score AS c,
         n.event_id % 7 <> 0 AS signed, n.score >= 0.25 AS cleared,
         c.score IS NULL OR n.score - c.score >= -(0.01 + 1e-9) AS kept,
         CASE WHEN c.score IS NULL THEN 'no existing champion'
              ELSE printf('champion %.4f, delta %+.4f', c.score, n.score - c.score) END AS note
  FROM newest n LEFT JOIN champions c USING (model_name))"""


@query(
    f"""WITH {JUDGED_SQL}
SELECT model_name, version, signed AND cleared AND kept AS passed, note AS comparison,
       array_to_string(list_filter([CASE WHEN NOT signed THEN 'signature_present' END,
         CASE WHEN NOT cleared THEN 'above_floor' END,
         CASE WHEN NOT kept THEN 'no_regression' END], lambda x: x IS NOT NULL), ',')
         AS failed_checks
FROM judged"""
)
def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).select(
        "model_name",
        "version",
        "passed",
        "comparison",
        F.array_join("failed_checks", ",").alias("failed_checks"),
    )


@query(
    f"""WITH {JUDGED_SQL},
moves AS (
  SELECT model_name, CASE WHEN signed AND cleared AND kept THEN 'champion' ELSE 'challenger' END AS alias,
         version FROM judged)
SELECT model_name, alias, version FROM moves
UNION ALL SELECT model_name, alias, version FROM held ANTI JOIN moves USING (model_name, alias)"""
)
def alias_after_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where aliases point once every model's latest run has been judged."""
    events = registry_tables(spark, sf_dir)["aliases"]
    moves = registry.alias_moves(judged(spark, sf_dir), events)
    return registry.alias_current(events.unionByName(moves, allowMissingColumns=True))


@query(
    f"""WITH {REGISTRY_SQL}
SELECT model_name, alias, version FROM held WHERE model_name <> 'model-1' OR alias <> 'champion'
UNION ALL SELECT 'model-1', 'champion', 1"""
)
def alias_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = registry_tables(spark, sf_dir)["aliases"]
    back = registry.rollback(events, "model-1", 1)
    return registry.alias_current(events.unionByName(back, allowMissingColumns=True))


@query(
    f"""WITH {JUDGED_SQL}
SELECT model_name, version, t.k AS key, t.v AS value FROM judged, unnest([
  {{'k': 'gate_passed', 'v': CAST(signed AND cleared AND kept AS VARCHAR)}},
  {{'k': 'gate_metric', 'v': 'holdout_macro_f1'}},
  {{'k': 'gate_candidate_score', 'v': printf('%.4f', s)}},
  {{'k': 'gate_floor', 'v': '0.25'}},
  {{'k': 'gate_regression_tolerance', 'v': '0.01'}},
  {{'k': 'gate_comparison', 'v': note}},
  {{'k': 'source_run_id', 'v': run_id}},
  {{'k': 'gate_check_signature_present', 'v': CAST(signed AS VARCHAR)}},
  {{'k': 'gate_check_above_floor', 'v': CAST(cleared AS VARCHAR)}},
  {{'k': 'gate_check_no_regression', 'v': CAST(kept AS VARCHAR)}}]) AS u(t)"""
)
def gate_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.gate_tags(judged(spark, sf_dir), floor=0.25)


# --- contracts ----------------------------------------------------------------------------------------


@query(
    f"""WITH {READINGS_SQL}, rates AS (
  SELECT avg(CAST(slow IS NULL AS INTEGER)) AS s, avg(CAST(fast IS NULL AS INTEGER)) AS f
  FROM readings)
SELECT 'slow null rate in [0.85, 0.95]' AS expectation, round(s, 6) AS observed,
       s BETWEEN 0.85 AND 0.95 AS passed FROM rates
UNION ALL SELECT 'fast null rate below 0.05', round(f, 6), f < 0.05 FROM rates"""
)
def contract_null_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = quality.check(
        readings(spark, sf_dir),
        [quality.null_rate_between("slow", 0.85, 0.95), quality.null_rate_below("fast", 0.05)],
    )
    return rounded(result, "observed")


@query(
    f"""WITH {LABELLED_SQL}, n AS (
  SELECT count(DISTINCT activity_id) AS d, count(*) AS all_rows, count_if(split = 'train') AS t,
         count_if(split = 'holdout') AS h FROM labelled)
SELECT '5 distinct activity_id' AS expectation, CAST(d AS DOUBLE) AS observed, d = 5 AS passed FROM n
UNION ALL SELECT 'has rows', all_rows, all_rows > 0 FROM n
UNION ALL SELECT 'train has rows', t, t > 0 FROM n
UNION ALL SELECT 'holdout has rows', h, h > 0 FROM n"""
)
def contract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check(labelled_windows(spark, sf_dir), count_expectations())


def count_expectations() -> list[quality.Expectation]:
    return [
        quality.distinct_exactly("activity_id", 5),
        quality.not_empty(),
        quality.some_row("train has rows", F.col("split") == "train"),
        quality.some_row("holdout has rows", F.col("split") == "holdout"),
    ]


@query(
    f"""WITH {LABELLED_SQL}, n AS (
  SELECT count_if(activity_id = 'error') AS e, count_if(sample_count < 2) AS p FROM labelled)
SELECT 'no transient activity' AS expectation, CAST(e AS DOUBLE) AS observed, e = 0 AS passed FROM n
UNION ALL SELECT 'no partial window', p, p = 0 FROM n"""
)
def contract_forbidden(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check(
        labelled_windows(spark, sf_dir),
        [
            quality.no_row("no transient activity", F.col("activity_id") == "error"),
            quality.no_row("no partial window", F.col("sample_count") < 2),
        ],
    )


CONTRACT_KEYS = ["subject_id", "activity_id", "ts", "slow"]


@query(
    f"WITH {READINGS_SQL} "
    + " UNION ALL ".join(
        f"SELECT 'no null {key}' AS expectation, CAST(count_if({key} IS NULL) AS DOUBLE) AS observed,"
        f" count_if({key} IS NULL) = 0 AS passed FROM readings"
        for key in CONTRACT_KEYS
    )
)
def contract_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check(readings(spark, sf_dir), [quality.no_null(key) for key in CONTRACT_KEYS])


# --- training and scoring -------------------------------------------------------------------------------


@query(
    """WITH s AS (SELECT *, CASE WHEN vec_id % 4 = 0 THEN 'holdout' ELSE 'train' END AS split FROM embeddings)
SELECT split, count(*) AS "rows", 'vector-model' AS model_name, CAST(1 AS BIGINT) AS model_version,
       'run-1' AS model_run_id, CAST(0 AS BIGINT) AS unknown_predictions,
       CASE WHEN split = 'train' THEN true END AS beats_largest_class
FROM s GROUP BY split"""
)
def train_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the training split, save and reload the model, score every vector with lineage.

    The rows are facts that SQL can state: how many rows of each split were scored and under which
    lineage, that no prediction is a class the training split lacks, and that on the training split the
    model does better than naming the largest class. The labels of these vectors are drawn at random, so
    nothing can be said about the holdout.
    """
    raw = table(spark, sf_dir, "embeddings")
    widths = raw.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()  # two numbers
    if widths[0] != widths[1]:
        raise ValueError(f"vectors of {widths[0]} to {widths[1]} entries")
    inputs = [f"x{i}" for i in range(widths[0])]
    vectors = raw.select(
        "vec_id",
        "label",
        F.when(F.col("vec_id") % 4 == 0, "holdout").otherwise("train").alias("split"),
        *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(inputs)],
    )
    train = vectors.filter("split = 'train'")
    model = training.train_classifier(train, inputs, "label")
    path = shared_folder(spark, "model")
    model.write().save(path)
    loaded = training.PipelineModel.load(path)
    scored = scoring.score(loaded, vectors, ["vec_id", "label", "split"], "predicted_label_id")
    stamped = scoring.stamp_lineage(scored, "vector-model", 1, "run-1")
    scores_path = shared_folder(spark, "scores")
    stamped.write.parquet(scores_path)
    written = spark.read.parquet(scores_path)
    known = train.select(F.col("label").cast("long").alias("known")).distinct()
    flagged = written.join(F.broadcast(known), F.col("predicted_label_id") == F.col("known"), "left")
    largest = written.groupBy("split", "label").count().groupBy("split").agg(F.max("count").alias("largest"))
    facts = flagged.groupBy("split", "model_name", "model_version", "model_run_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("known").isNull()).alias("unknown_predictions"),
        F.count_if(F.col("label") == F.col("predicted_label_id")).alias("right"),
    )
    return facts.join(largest, "split").select(
        "split",
        "rows",
        "model_name",
        "model_version",
        "model_run_id",
        "unknown_predictions",
        F.when(F.col("split") == "train", F.col("right") > F.col("largest")).alias("beats_largest_class"),
    )


BOOSTED_ROUNDS = 30


@query(
    """WITH steps AS (
  SELECT vec_id,
         greatest(-8, least(7, floor(CAST(embedding[1] AS DOUBLE) * 4))) AS a,
         greatest(-8, least(7, floor(CAST(embedding[2] AS DOUBLE) * 4))) AS b,
         CAST(floor(CAST(embedding[3] AS DOUBLE) * 4) AS BIGINT) % 3 = 0 AS missing
  FROM embeddings)
SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN 'holdout' ELSE 'train' END AS split,
       CASE WHEN missing THEN 3 WHEN a < 0 THEN 0 WHEN b < 0 THEN 1 ELSE 2 END AS predicted,
       true AS stopped_early
FROM steps"""
)
def train_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted ensembles stopped early by subject, saved, reloaded, and every prediction compared.

    The label is a rule over steps of the vectors, so a right model predicts it on the holdout too. Whether the
    third entry is missing decides first, and its median is no missing value: that takes the indicator.
    """

    def entry(i: int):
        return F.floor(F.get("embedding", F.lit(i)).cast("double") * 4)

    def step(i: int):
        return F.greatest(F.lit(-8), F.least(F.lit(7), entry(i))).cast("double")

    rule = F.when(F.col("c").isNull(), 3).when(F.col("a") < 0, 0).when(F.col("b") < 0, 1).otherwise(2)
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.when(F.col("vec_id") % 4 == 0, "holdout").otherwise("train").alias("split"),
        (F.col("vec_id") % 30).alias("subject_id"),
        step(0).alias("a"),
        step(1).alias("b"),
        F.when(entry(2) % 3 != 0, step(2)).alias("c"),
    ).withColumn("label", rule)
    limits = {"maxIter": BOOSTED_ROUNDS, "stepSize": 0.8, "maxDepth": 3, "seed": 42, "validationTol": 0.2}
    model = training.train_classifier(
        vectors.filter("split = 'train'"), ["a", "b", "c"], "label", boosted=True, params=limits, subject_col="subject_id"
    )
    path = shared_folder(spark, "boosted-model")
    model.write().save(path)
    loaded = training.PipelineModel.load(path)
    early = any(n < BOOSTED_ROUNDS for n in training.rounds_used(loaded))
    scored = scoring.score(loaded, vectors, ["vec_id", "split"], "predicted", "int")
    return scored.withColumn("stopped_early", F.lit(early))


@query(ORACLE["contract_counts"])
def contract_during_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expectations of ``contract_counts``, measured while the table is written; the distinct one afterwards."""
    contract = quality.WrittenContract(labelled_windows(observing_session(spark), sf_dir), count_expectations())
    path = shared_folder(spark, "contract")
    contract.observed.write.parquet(path)
    return contract.result(spark).unionByName(quality.check(spark.read.parquet(path), contract.left_over))


@query(ORACLE["macro_f1"])
def incremental_macro_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three scored batches leave their confusion counts; the metric over all of them reads only those."""
    scored = scored_orders(spark, sf_dir)
    path = shared_folder(spark, "scored-counts")
    for batch in range(3):
        part = scored.filter(F.pmod(F.hash("o_orderkey"), F.lit(3)) == batch)
        append_history(metrics.confusion(part).withColumn("batch", F.lit(batch)), path, ["batch"])
    return rounded(metrics.macro_f1(metrics.merged_counts(read_history(spark, path))), "macro_f1")


LINE_SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in ("event_id", "user_id", "value")])


@query(
    """WITH kinds AS (
  SELECT CASE event_id % 50 WHEN 0 THEN 'too few values' WHEN 1 THEN 'too many values'
                            WHEN 2 THEN 'not a number' WHEN 3 THEN 'not a number' END AS reason,
         CASE event_id % 50 WHEN 2 THEN 'user_id' WHEN 3 THEN 'value' END AS "column"
  FROM events)
SELECT reason, "column", count(*) AS lines FROM kinds WHERE reason IS NOT NULL GROUP BY reason, "column"
UNION ALL SELECT 'read as they stand', NULL, count_if(reason IS NULL) FROM kinds"""
)
def rejected_line_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text copy of the events in which some lines are broken, read back with the reasons."""
    kind = F.col("event_id") % 50
    path = shared_folder(spark, "lines")
    table(spark, sf_dir, "events").select(
        F.when(kind == 0, F.concat_ws(" ", "event_id", "user_id"))
        .when(kind == 1, F.concat_ws(" ", "event_id", "user_id", "value", F.lit("7")))
        .when(kind == 2, F.concat_ws(" ", "event_id", F.lit("x17"), "value"))
        .when(kind == 3, F.concat_ws(" ", "event_id", "user_id", F.lit("1.2.3")))
        .when(kind == 4, F.concat_ws(" ", "event_id", "user_id", F.lit("NaN")))
        .otherwise(F.concat_ws(" ", "event_id", "user_id", "value"))
    ).write.text(path)
    raw = read_delimited_sensor(spark, path, LINE_SCHEMA, rejected_col=REJECTED)
    found = rejected_lines(raw, LINE_SCHEMA).groupBy("reason", "column").agg(F.count(F.lit(1)).alias("lines"))
    whole = raw.agg(F.count_if(F.col(REJECTED).isNull()).alias("lines")).select(
        F.lit("read as they stand").alias("reason"), F.lit(None).cast("string").alias("column"), "lines"
    )
    return found.unionByName(whole)
