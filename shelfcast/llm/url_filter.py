"""URL filter: host and path rules, and logistic regression for the rest.

A rule fits its host and all subdomains if the path starts with the rule's; the
longest fitting rule decides.  All other urls go to a logistic regression on
hashed character n-grams of host and path.  It is trained from a small labelled
table (url, label 1 = block); by default that is a sample of ``TRAIN_URLS`` urls
of the table itself that a rule decides, least hash first, so the model carries
the rules' verdicts over to urls that no rule fits.  Hashing, fitting and scoring
are Spark's own (JVM) operators; only the fitted coefficients reach the driver.

Defined cases: null or a url without ``://`` has empty host and path, and the
model decides; without labelled rows every url that no rule decides is allowed, and
with labels of one kind only, that kind decides; repeated rows get equal verdicts;
an empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import ascii_lower, hash52, pick, staged

# Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
TRAIN_URLS = 4000          # bound of the labelled sample
NGRAMS = (3, 4)
FEATURES = 1 << 16
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def parts(url: Column) -> tuple[Column, Column]:
    given = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(given, URL, 1)), F.regexp_extract(given, URL, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as struct (n, rule, verdict); else null."""
    def fit(verdict: str, rule_host: str, rule_path: str) -> Column:
        rule = rule_host + rule_path
        return F.when(((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path),
                      F.struct(F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
    return F.array_max(F.array(*[fit(*r) for r in rules]))


def ngrams(host: Column, path: Column, sizes: Sequence[int] = NGRAMS) -> Column:
    text = F.concat(F.lit("^"), host, F.lit(" "), path, F.lit("$"))
    return F.flatten(F.array(*[
        F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)),
                                                lambda i, n=n: text.substr(i, F.lit(n))))
        .otherwise(F.array().cast("array<string>")) for n in sizes]))


def hashed(df: DataFrame) -> DataFrame:
    tf = HashingTF(numFeatures=FEATURES, binary=True, inputCol="__grams", outputCol="features")
    return tf.transform(df.withColumn("__grams", ngrams(F.col("host"), F.col("path")))).drop("__grams")


def fit_urls(labelled: DataFrame):
    """Model from (host, path, label); None without rows.  ``labelled`` is a small table."""
    rows = hashed(labelled)
    if rows.isEmpty():
        return None
    return LogisticRegression(maxIter=40, regParam=0.01, standardization=False).fit(rows)


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None,
                rules: Sequence[tuple[str, str, str]] = RULES, train_urls: int = TRAIN_URLS) -> DataFrame:
    """page_id, host, path, rule, verdict, p_block: one row for each row of ``pages``."""
    host, path = parts(F.col("url"))
    split = pick(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    ruled = split.withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    label = (F.col("__rule.verdict") == "block").cast("double")
    if labelled is None:
        # ordered and bounded: the same rows in the same order in every run
        labelled = staged(ruled.where("__rule IS NOT NULL").select("host", "path", label.alias("label")).distinct()
                          .orderBy(hash52(F.col("host"), F.col("path")), "host", "path").limit(train_urls).coalesce(1),
                          "url-labels")
    else:
        h, p = parts(F.col("url"))
        labelled = pick(labelled, "url", "label").select(h.alias("host"), p.alias("path"), F.col("label").cast("double"))
    model = fit_urls(labelled)
    if model is None:
        scored = ruled.withColumn("p_block", F.lit(0.0))
    else:
        scored = model.transform(hashed(ruled)).withColumn("p_block", vector_to_array("probability")[1])
    return scored.select(
        "page_id", "host", "path", F.col("__rule.rule").alias("rule"),
        F.coalesce(F.col("__rule.verdict"), F.when(F.col("p_block") >= 0.5, F.lit("block")).otherwise("allow")).alias("verdict"),
        F.round("p_block", 6).alias("p_block"))
