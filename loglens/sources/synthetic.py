"""Seeded synthetic access-log lines, generated in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The categories of generated lines with their probabilities.
RESPONSES = (("200", 0.9), ("404", 0.04), ("500", 0.02), ("301", 0.04))
VERBS = (("GET", 0.6), ("POST", 0.1), ("DELETE", 0.1), ("PUT", 0.2), ("BADVERB", 0.0))
ANOMALOUS_VERBS = (("GET", 0.4), ("POST", 0.1), ("DELETE", 0.1), ("PUT", 0.2), ("BADVERB", 0.2))
RESOURCES = (
    "/list",
    "/wp-content",
    "/wp-admin",
    "/explore",
    "/search/tag/list",
    "/app/main/posts",
    "/posts/posts/explore",
    "/apps/cart.jsp?appID=",
)
NUMBERED_RESOURCE = "/apps/cart.jsp?appID="
NUMBER_RANGE = (1000, 10000)
BYTES_MEAN, BYTES_DEVIATION = 5000, 50
STEP_SECONDS = (30, 300)
# Shares of five browser families; the texts are this package's own.
AGENTS = (
    ("Mozilla/5.0 (X11; Linux x86_64; rv:120.0) Gecko/20100101 Firefox/120.0", 0.5),
    ("Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 Chrome/119.0 Safari/537.36", 0.3),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 13_0) AppleWebKit/605.1 Safari/605.1", 0.1),
    ("Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; Trident/5.0)", 0.05),
    ("Opera/9.80 (X11; Linux x86_64) Presto/2.12 Version/12.16", 0.05),
)
REFERRERS = (
    "http://example.com/",
    "http://example.org/home",
    "http://example.net/search",
    "http://example.edu/blog/post",
)


def _weighted_choice(choices, draw: Column) -> Column:
    total, column = 0.0, None
    for value, share in choices:
        total += share
        if share > 0:
            condition = draw < total
            column = F.when(condition, value) if column is None else column.when(condition, value)
    last = [value for value, share in choices if share > 0][-1]
    return column.otherwise(last)


def _uniform_choice(values, draw: Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(v) for v in values]), (F.floor(draw * len(values)) + 1).cast("int")
    )


def _between(low: int, high: int, draw: Column) -> Column:
    """Uniform integer from ``low`` to ``high``, both included."""
    return (F.floor(draw * (high - low + 1)) + low).cast("bigint")


def _draw(seed: int, name: str) -> Column:
    """Uniform in [0, 1): the upper 53 bits of a hash of seed, name and id."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(name), F.col("id")), 11)
    return bits / F.lit(float(1 << 53))


def _normal_draw(seed: int, name: str) -> Column:
    """Standard normal from two uniform draws."""
    radius = F.sqrt(-2 * F.log(1 - _draw(seed, f"{name} radius")))
    return radius * F.cos(2 * F.pi() * _draw(seed, f"{name} angle"))


def line_columns(ids: DataFrame, start: str, seed: int, anomalies: bool = False) -> DataFrame:
    """Turn rows with ``id`` into rows with the parts of a line and ``message``.

    Times advance by the mean step per id plus a jitter below one step, so they
    need no running sum over all lines.
    """
    names = (
        "step", "ip1", "ip2", "ip3", "ip4", "verb", "uri", "number", "status", "from", "agent"
    )
    # Draws depend on seed, name and id only, so partitions do not change a line.
    draws = {f"_{name}": _draw(seed, name) for name in names}
    drawn = ids.select("id", *[d.alias(n) for n, d in draws.items()]).withColumn(
        "_bytes", _normal_draw(seed, "bytes")
    )

    def draw(name):
        return F.col(f"_{name}")

    low, high = STEP_SECONDS
    mean = (low + high) // 2
    resource = drawn.withColumn("_resource", _uniform_choice(RESOURCES, draw("uri")))
    parts = resource.select(
        "id",
        (
            F.lit(start).cast("timestamp")
            + F.make_dt_interval(secs=F.col("id") * mean + _between(0, mean - 1, draw("step")))
        ).alias("ts"),
        F.concat_ws(
            ".",
            _between(1, 223, draw("ip1")),
            *[_between(0, 255, draw(f"ip{i}")) for i in (2, 3, 4)],
        ).alias("clientip"),
        _weighted_choice(ANOMALOUS_VERBS if anomalies else VERBS, draw("verb")).alias("verb"),
        F.when(
            F.col("_resource") == NUMBERED_RESOURCE,
            F.concat("_resource", _between(*NUMBER_RANGE, draw("number")).cast("string")),
        )
        .otherwise(F.col("_resource"))
        .alias("request"),
        _weighted_choice(RESPONSES, draw("status")).alias("response"),
        (F.col("_bytes") * BYTES_DEVIATION + BYTES_MEAN).cast("bigint").alias("bytes"),
        _uniform_choice(REFERRERS, draw("from")).alias("referrer"),
        _weighted_choice(AGENTS, draw("agent")).alias("agent"),
    )
    line = F.format_string(
        '%s - - [%s +0000] "%s %s HTTP/1.0" %s %d "%s" "%s"',
        "clientip",
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
        "verb",
        "request",
        "response",
        "bytes",
        "referrer",
        "agent",
    )
    return parts.withColumn("message", line)


def synthetic_access_log(
    spark: SparkSession,
    n: int,
    start: str = "2024-01-01 00:00:00",
    seed: int = 0,
    anomalies: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    ids = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return line_columns(ids, start, seed, anomalies)


def synthetic_log_stream(
    spark: SparkSession, rows_per_second: int = 10, seed: int = 0, anomalies: bool = False,
    start: str = "2024-01-01 00:00:00",
) -> DataFrame:
    """The same lines without an end, from the built-in rate source."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return line_columns(rate.select(F.col("value").alias("id")), start, seed, anomalies)
