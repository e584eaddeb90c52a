"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

URLs that a rule decides are the labelled ones. Trees learn the verdict from the
text of the URL only: lengths, depth, digit ratio, entropy, parameter counts and
statistics of host suffixes and path tokens among labelled URLs. A bounded
sample of distinct labelled URLs (``TRAIN_URLS``, least hash first, both labels)
fits the trees, each weighing as many rows as it has; the suffix statistics count
all labelled URLs. Features are built-in expressions.

Defined results: a null URL or one without ``://`` has an empty host and path,
no rule, and features of zero length; with labels of one kind only the verdict is
that kind, without labels it is "allow". Repeated rows get equal verdicts. An
empty table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import pick, ship, written

# (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
TRAIN_URLS = 20_000
LEAST_URLS = 1_000
TREES, DEPTH = 12, 4
# Weight of the overall share in a suffix statistic.
PRIOR = 10.0


def split_url(url: Column):
    """``(host, path)``."""
    found = F.instr(url, "://")
    rest = F.when(found > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def match_rules(rules=RULES):
    """``(rule, verdict)`` of the longest rule that fits ``host`` and ``path``, or null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The last one to be applied wins, so longer rules come later.
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (
            (F.col("host") == host) | F.col("host").endswith("." + host)
        ) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _count(column, pattern):
    return F.regexp_count(column, F.lit(pattern)).cast("double")


def _entropy(column):
    """Bits per character."""
    letters = F.filter(F.split(column, ""), lambda c: c != "")
    size = F.greatest(F.size(letters), F.lit(1)).cast("double")
    parts = F.transform(
        F.array_distinct(letters),
        lambda c: F.size(F.filter(letters, lambda x: x == c)) / size,
    )
    return F.aggregate(parts, F.lit(0.0), lambda a, p: a - p * F.log2(p))


def lexical_features(urls: DataFrame) -> DataFrame:
    """Adds one column per feature and the keys ``suffix1``, ``suffix2``, ``token``."""
    url = F.coalesce("url", F.lit(""))
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return urls.withColumns(
        {
            "f_length": F.length(url).cast("double"),
            "f_host": F.length("host").cast("double"),
            "f_path": F.length("path").cast("double"),
            "f_labels": _count(F.col("host"), r"[^.]+"),
            "f_depth": _count(F.col("path"), "/[^/]+"),
            "f_digits": _count(url, "[0-9]") / size,
            "f_other": _count(url, "[^A-Za-z0-9]") / size,
            "f_hyphens": _count(F.col("host"), "-"),
            "f_entropy": _entropy(url),
            "f_host_entropy": _entropy(F.col("host")),
            "f_params": _count(query, "[^&]+"),
            "f_query": F.length(query).cast("double"),
            "f_fragment": F.instr(url, "#").cast("boolean").cast("double"),
            "f_secure": F.lower(url).startswith("https://").cast("double"),
            "f_file": F.regexp_like("path", F.lit(r"\.[A-Za-z0-9]{1,5}$")).cast("double"),
            "suffix1": F.substring_index("host", ".", -1),
            "suffix2": F.substring_index("host", ".", -2),
            "token": F.regexp_extract("path", "^/([^/]*)", 1),
        }
    )


LEXICAL = [
    "f_length", "f_host", "f_path", "f_labels", "f_depth", "f_digits", "f_other", "f_hyphens",
    "f_entropy", "f_host_entropy", "f_params", "f_query", "f_fragment", "f_secure", "f_file",
]
KEYS = ("suffix1", "suffix2", "token")


def _statistics(labelled: DataFrame, key: str, share: float) -> DataFrame:
    """Smoothed share of blocked URLs for each value of ``key``."""
    sums = labelled.groupBy(key).agg(F.sum("label").alias("b"), F.count("*").alias("n"))
    return sums.select(key, ((F.col("b") + PRIOR * share) / (F.col("n") + PRIOR)).alias(f"s_{key}"))


def _sample(vectors: DataFrame, labelled: DataFrame) -> DataFrame:
    """``(features, label, weight)`` of distinct labelled URLs, those with the least hashes.

    Each label has its share of ``TRAIN_URLS``, but ``LEAST_URLS`` or all of its URLs
    at least. Weights are the rows of a URL, times the URLs of its label that it stands for.
    """
    hashed = F.xxhash64("url")
    hashes = written(labelled.select("label", hashed.alias("hash")).distinct(), "url-hashes")
    counts = {r["label"]: r["count"] for r in hashes.groupBy("label").count().collect()}
    urls = sum(counts.values())
    taken, weight = F.lit(False), F.lit(None).cast("double")
    for label, n in counts.items():
        most = min(n, max(LEAST_URLS, TRAIN_URLS * n // urls))
        of_label = hashes.filter(F.col("label") == label)
        cut = of_label.orderBy("hash").limit(most).agg(F.max("hash").alias("cut")).first()["cut"]
        taken |= (F.col("label") == label) & (hashed <= cut)
        weight = F.when(F.col("label") == label, n / most).otherwise(weight)
    return (
        vectors.filter("by_rule is not null")
        .select("features", (F.col("by_rule") == "block").cast("double").alias("label"), "url")
        .filter(taken)
        .groupBy("url")
        .agg(
            F.first("features").alias("features"),
            F.first("label").alias("label"),
            F.count("*").alias("rows"),
        )
        .select("features", "label", (F.col("rows") * weight).alias("weight"))
    )


def judge_urls(pages: DataFrame, page_id="page_id", url="url", rules=RULES) -> DataFrame:
    """``(page_id, url, host, path, rule, verdict, block_score)``."""
    base = pick(pages, page_id=page_id, url=url)
    host, path = split_url(F.col("url"))
    ruled = base.withColumn("host", host).withColumn("path", path)
    rule, verdict = match_rules(rules)
    ruled = ruled.withColumn("rule", rule).withColumn("by_rule", verdict)
    # One pass computes the features; all later passes scan them.
    rows = written(lexical_features(ruled), "url-features")
    labelled = rows.filter("by_rule is not null").withColumn(
        "label", (F.col("by_rule") == "block").cast("double")
    )
    seen = labelled.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    plain = rows.select("page_id", "url", "host", "path", "rule", "by_rule")
    if not seen["n"] or seen["blocked"] in (0, seen["n"]):
        rest = "block" if seen["n"] and seen["blocked"] else "allow"
        return _verdicts(plain.withColumn("block_score", F.lit(float(rest == "block"))))
    share = seen["blocked"] / seen["n"]
    scored = reduce(
        lambda df, key: df.join(_statistics(labelled, key, share), key, "left"), KEYS, rows
    ).fillna(share, [f"s_{key}" for key in KEYS])
    inputs = LEXICAL + [f"s_{key}" for key in KEYS]
    vectors = written(
        VectorAssembler(inputCols=inputs, outputCol="features")
        .transform(scored)
        .select("page_id", "url", "host", "path", "rule", "by_rule", "features"),
        "url-vectors",
    )
    train = _sample(vectors, labelled).repartition(4).cache()
    model = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, seed=7, subsamplingRate=1.0, weightCol="weight"
    ).fit(train)
    train.unpersist()
    score = vector_to_array("probability")[1]
    return _verdicts(model.transform(vectors).withColumn("block_score", score))


def _verdicts(rows: DataFrame) -> DataFrame:
    learned = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return rows.select(
        "page_id",
        "url",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", learned).alias("verdict"),
        "block_score",
    )


def op10_query(spark, sf_dir) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict", "block_score")


ship(__name__)
