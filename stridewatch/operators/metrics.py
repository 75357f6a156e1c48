"""Classification metrics as aggregations over a confusion table.

Only :func:`confusion` reads the scored rows. Everything after it works on at most classes x
classes rows, so a class that holds most of the data makes no difference.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_missing


def outcomes(
    df: DataFrame, label_col: str = "label", prediction_col: str = "prediction"
) -> DataFrame:
    """(label, prediction, n) of all rows; NaN counts as null on both sides."""
    label, prediction = (
        F.when(~is_missing(df, c), F.col(c)).alias(name)
        for c, name in ((label_col, "label"), (prediction_col, "prediction"))
    )
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def labelled(counts: DataFrame) -> DataFrame:
    """What the metrics are about: rows without a label are left out, an absent prediction is a
    miss of its label and no class of its own."""
    return counts.filter(F.col("label").isNotNull())


def confusion(
    df: DataFrame, label_col: str = "label", prediction_col: str = "prediction"
) -> DataFrame:
    return labelled(outcomes(df, label_col, prediction_col))


def merged_counts(counts: DataFrame) -> DataFrame:
    """One confusion table from those of several batches: counts add up, rates would not."""
    return counts.groupBy("label", "prediction").agg(F.sum("n").alias("n"))


def accuracy(counts: DataFrame) -> DataFrame:
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return counts.agg(F.try_divide(right, F.sum("n")).alias("accuracy"))


def per_class(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 of every class seen as a label or as a prediction.

    A score with a zero denominator is 0, not missing, so a class that is never predicted right
    pulls the macro average down.
    """
    hit = F.col("label") == F.col("prediction")
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    F.when(hit, F.col("n")).otherwise(0).alias("hits"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                ),
                F.struct(
                    F.col("prediction").alias("class"),
                    F.lit(0).cast("long").alias("hits"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                ),
            )
        )
    )
    totals = sides.filter(F.col("class").isNotNull()).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("hits", "support", "predicted")]
    )

    def share(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return totals.select(
        "class",
        share(F.col("hits"), F.col("predicted")).alias("precision"),
        share(F.col("hits"), F.col("support")).alias("recall"),
        share(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "hits",
    )


def macro_f1(counts: DataFrame) -> DataFrame:
    return per_class(counts).agg(F.avg("f1").alias("macro_f1"))


def weighted_f1(counts: DataFrame) -> DataFrame:
    return per_class(counts).agg(
        F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias(
            "weighted_f1"
        )
    )


def evaluation(counts: DataFrame) -> DataFrame:
    """The three headline metrics as one row."""
    return per_class(counts).agg(
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias(
            "weighted_f1"
        ),
    )


def classification_report(counts: DataFrame) -> DataFrame:
    """One row per class, then accuracy, macro average and weighted average."""
    classes = per_class(counts)
    scores = ["precision", "recall", "f1"]
    macro = classes.agg(
        F.lit("macro avg").alias("class"),
        *[F.avg(c).alias(c) for c in scores],
        F.sum("support").alias("support"),
    )
    weighted = classes.agg(
        F.lit("weighted avg").alias("class"),
        *[
            F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c)
            for c in scores
        ],
        F.sum("support").alias("support"),
    )
    # As in the usual text report, accuracy fills the F1 column only.
    overall = classes.agg(
        F.lit("accuracy").alias("class"),
        F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        F.try_divide(F.sum("hits"), F.sum("support")).alias("f1"),
        F.sum("support").alias("support"),
    )
    named = classes.withColumn("class", F.col("class").cast("string")).drop("hits")
    return named.unionByName(overall).unionByName(macro).unionByName(weighted)


def performance_delta(realised: DataFrame, promoted: DataFrame) -> DataFrame:
    """Realised minus promoted macro F1; both inputs are one-row frames."""
    return realised.withColumn(
        "promoted_macro_f1", promoted.select("promoted_macro_f1").scalar()
    ).withColumn("performance_delta", F.col("realised_macro_f1") - F.col("promoted_macro_f1"))
