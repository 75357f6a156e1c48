"""URL filter: host and path rules, and logistic regression on hashed character n-grams for the rest.

Only DataFrame functions and Spark ML run here. The classifier learns from a small labelled table of
URLs; the table given here is the author's own and can be replaced by a larger one.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 15
GRAM_SIZES = (3, 4, 5)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Host words of unwanted and of ordinary sites. Each becomes several URLs of the labelled table.
UNWANTED = (
    "cheap-pills", "pills-shop", "online-pharmacy", "viagra-sale", "casino-win", "best-casino", "slots-jackpot",
    "poker-bonus", "free-bets", "sports-bets", "betting-odds", "adult-x", "xxx-videos", "adult-cams", "porn-tube",
    "spam-farm", "link-farm", "seo-spam", "ads-track", "click-track", "ads-banner", "popup-ads", "payday-loans",
    "quick-cash", "crack-keygen", "warez-torrent", "free-prizes", "win-iphone", "replica-watches", "miracle-diet",
)
ORDINARY = (
    "news", "weather", "library", "university", "museum", "recipes", "gardening", "history", "science", "physics",
    "open-data", "city-library", "high-school", "bird-watch", "town-hall", "music", "theatre", "travel", "railway",
    "hospital", "teaching", "astronomy", "software", "documentation", "community", "translation", "interesting",
    "theory", "weathering", "northern", "southern", "brothers", "rethink", "another", "nation", "station", "together",
    "there", "thinking", "others", "health", "earth", "author", "tension", "relation", "tender", "thread", "shelter",
    "whither", "heather", "onion", "easter", "inland", "estate", "reason", "readers", "those", "enable", "trails",
)
PREFIXES = ("", "www.", "blog.", "m.")
ENDINGS = ("example.com", "example.net", "example.org")
PATHS = ("/en/17", "/de/401.html", "/fr/58?page=2&ref=x", "/es/993/", "/en/2024#top", "")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): label 1 is unwanted. Prefixes, endings and paths are dealt evenly to both classes."""
    rows = []
    for label, names in ((1.0, UNWANTED), (0.0, ORDINARY)):
        for i, name in enumerate(names):
            for k, prefix in enumerate(PREFIXES):
                path = PATHS[(i + k) % len(PATHS)]
                rows.append((f"https://{prefix}{name}.{ENDINGS[(i + k) % len(ENDINGS)]}{path}", label))
    table = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for u, y in rows])
    return spark.range(1).select(F.inline(table))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and for urls without ``://``."""
    mark = F.instr(url, "://")
    rest = F.substr(url, mark + F.lit(3))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(mark > 0, host).otherwise(""), F.when(mark > 0, path).otherwise("")


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path; a mark in front keeps the two apart."""

    def of(text: Column, mark: str) -> list[Column]:
        marked = F.concat(F.lit(mark), text, F.lit(" "))
        return [
            F.when(
                F.length(marked) >= n,
                F.transform(
                    F.sequence(F.lit(1), F.length(marked) - F.lit(n - 1)),
                    lambda i, n=n: F.concat(F.lit(mark), F.substr(marked, i, F.lit(n))),
                ),
            ).otherwise(F.array().cast("array<string>"))
            for n in GRAM_SIZES
        ]

    return F.concat(*of(host, "^"), *of(path, "/"))


def featured(df: DataFrame) -> DataFrame:
    """``df`` with columns ``_grams`` and ``_features`` from its columns ``host`` and ``path``."""
    hashed = HashingTF(numFeatures=BUCKETS, binary=True, inputCol="_grams", outputCol="_features")
    return hashed.transform(df.withColumn("_grams", grams(F.col("host"), F.col("path"))))


def train(labelled: DataFrame) -> LogisticRegressionModel:
    """A classifier from (url, label) rows."""
    host, path = host_and_path(F.col("url"))
    rows = featured(labelled.select("label", host.alias("host"), path.alias("path")))
    learner = LogisticRegression(
        featuresCol="_features", labelCol="label", probabilityCol="_p", rawPredictionCol="_raw",
        predictionCol="_prediction", regParam=0.001, maxIter=60,
    )
    return learner.fit(rows)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, null where none does.

    A rule ``host/path`` fits the host and all hosts below it, if the path begins with the rule's. Rules are
    a short list of the job's own settings, hence one expression; the longest is asked first.
    """
    rule = verdict = F.lit(None).cast("string")
    for text, decision in sorted(set(rules), key=lambda r: (len(r[0]), r)):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def judge(
    pages: DataFrame, rules: list[tuple[str, str]], model: LogisticRegressionModel, threshold: float = 0.5
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score), one row for each row of ``pages``.

    The rule's verdict where one fits, else block at a score of at least ``threshold``. Null urls have an empty
    host and path and are scored as such; other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    split = featured(pages.select("page_id", host.alias("host"), path.alias("path")))
    scored = model.transform(split).withColumn("score", vector_to_array("_p")[1])
    rule, decision = rule_of(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(decision, learned).alias("verdict"), "score"
    )
