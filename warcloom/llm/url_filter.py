"""URL verdicts by rules, and by gradient-boosted trees on lexical features where no rule fits.

Everything is DataFrame functions and Spark's own boosted trees; the trees learn
from labelled URLs and see only the URL's letters: lengths, depth, digit share,
entropy, parameters, and how often URLs with the same suffix were blocked.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = [
    "url_length", "host_length", "path_length", "depth", "labels", "longest_label", "digit_share", "host_digits", "hyphens",
    "entropy", "parameters", "query_length", "has_fragment", "secure", "suffix_rate", "domain_rate",
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does.

    A rule is (verdict, "host/path"). It fits its host and all subdomains when the
    path starts with the rule's. Rules of one length go by name.
    """
    rule = verdict = F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: (len(r[1]), r[1]), reverse=False):
        domain, _, below = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + below)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def _entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.split(text, "")
    shares = F.transform(F.array_distinct(letters), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / F.length(text))
    return F.when(F.length(text) > 0, -F.aggregate(shares, F.lit(0.0), lambda total, p: total + F.when(p > 0, p * F.log2(p)).otherwise(0.0))).otherwise(0.0)


def lexical(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """``urls`` plus host, path and every feature but the suffix rates."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path = host_and_path(F.col(url_col))
    out = urls.withColumn("host", host).withColumn("path", path)
    labels = F.split("host", r"\.")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    return out.select(
        "*", F.length(url).cast("double").alias("url_length"), F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"), F.length(F.regexp_replace("path", "[^/]", "")).cast("double").alias("depth"),
        F.size(labels).cast("double").alias("labels"), F.array_max(F.transform(labels, F.length)).cast("double").alias("longest_label"),
        (digits / F.greatest(F.length(url), F.lit(1))).alias("digit_share"),
        F.length(F.regexp_replace("host", "[^0-9]", "")).cast("double").alias("host_digits"),
        F.length(F.regexp_replace("host", "[^-]", "")).cast("double").alias("hyphens"), _entropy(url).alias("entropy"),
        F.when(F.length(query) > 0, F.size(F.split(query, "&"))).otherwise(0).cast("double").alias("parameters"),
        F.length(query).cast("double").alias("query_length"), (F.instr(url, "#") > 0).cast("double").alias("has_fragment"),
        F.startswith(url, F.lit("https:")).cast("double").alias("secure"),
    )


class UrlModel:
    """Trees, and block rates per suffix with a bounded number of rows."""

    def __init__(self, trees: GBTClassificationModel | None, rates: dict[int, DataFrame], base: float):
        self.trees, self.rates, self.base = trees, rates, base

    def features(self, rows: DataFrame) -> DataFrame:
        for labels, name in ((1, "suffix_rate"), (2, "domain_rate")):
            # One row per suffix of the bounded training sample.
            table = F.broadcast(self.rates[labels].toDF("_suffix", name))
            rows = rows.join(table, _suffix(F.col("host"), labels) == F.col("_suffix"), "left").drop("_suffix").withColumn(
                name, F.coalesce(name, F.lit(self.base)))
        return rows

    def probability(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with lexical features) plus ``block_probability``."""
        if self.trees is None:
            return rows.withColumn("block_probability", F.lit(self.base))
        full = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(self.features(rows))
        scored = self.trees.transform(full)
        return scored.withColumn("block_probability", vector_to_array(self.trees.getProbabilityCol())[1]).drop(
            "_features", "suffix_rate", "domain_rate", "rawPrediction", "probability", "prediction")


def fit(labelled: DataFrame, max_train: int = 20_000, trees: int = 10, depth: int = 4, seed: int = 5) -> UrlModel:
    """Fit on at most ``max_train`` labelled URLs (columns url, label 1 = block), chosen by hash.

    Without URLs of both labels the share of blocked ones (0 if there are none) stands for every URL.
    """
    sample = labelled.where(F.col("label").isNotNull()).select("url", F.col("label").cast("double").alias("label"))
    sample = sample.orderBy(F.xxhash64("url"), "url", "label").limit(max_train)
    rows = lexical(sample).repartition(1).sortWithinPartitions("url", "label").persist()
    counted = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    total = sum(counted.values())
    base = counted.get(1.0, 0) / total if total else 0.0
    spark = labelled.sparkSession
    rates = {}
    for labels in (1, 2):
        # Smoothed by ten URLs at the overall rate; at most max_train rows.
        found = rows.groupBy(_suffix(F.col("host"), labels).alias("s")).agg(
            ((F.sum("label") + 10 * base) / (F.count("*") + 10)).alias("r")).collect()
        rates[labels] = spark.createDataFrame([(r["s"], r["r"]) for r in found], "s string, r double")
    model = UrlModel(None, rates, base)
    if len(counted) > 1:
        full = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(model.features(rows))
        model.trees = GBTClassifier(
            featuresCol="_features", labelCol="label", maxIter=trees, maxDepth=depth, maxBins=32, seed=seed).fit(full)
    rows.unpersist()
    return model


def verdicts(pages: DataFrame, rules: list[tuple[str, str]], model: UrlModel | None = None, url_col: str = "url") -> DataFrame:
    """``pages`` plus host, path, rule, verdict and block_probability.

    The rule's verdict where one fits, else the model's (block from one half).
    Without a model, it is fitted on the URLs that a rule decides. A null url has
    empty host and path and is judged on empty text. Rows are neither merged nor
    dropped; input columns with the name of a result are replaced.
    """
    base = lexical(pages.select(F.struct(*pages.columns).alias("_row"), F.col(url_col).alias("url")))
    rule, decision = matching_rule(F.col("host"), F.col("path"), rules)
    judged = base.withColumn("rule", rule).withColumn("_decision", decision)
    if model is None:
        model = fit(judged.where(F.col("_decision").isNotNull()).select(
            "url", (F.col("_decision") == "block").cast("int").alias("label")))
    scored = model.probability(judged)
    learned = F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow")
    results = ["host", "path", "rule", "verdict", "block_probability"]
    return scored.withColumn("verdict", F.coalesce("_decision", learned)).select(
        *[F.col("_row")[c].alias(c) for c in pages.columns if c not in results], *results)
