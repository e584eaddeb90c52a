"""Access-log views derived from the given tables.

The tables hold no access logs. Every event becomes one combined-format line,
and the place of the event's customer becomes its location.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.functions.parsing import parse_combined_log
from loglens.operators.lookup import lookup_join
from loglens.session import spread_small_input

_VERB = """CASE event_type WHEN 'view' THEN 'GET' WHEN 'click' THEN 'GET'
 WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'PUT' ELSE 'BADVERB' END"""
_STATUS = """CASE WHEN event_type = 'error' THEN '500'
 WHEN event_id % 25 = 0 THEN '404' ELSE '200' END"""
# The place of a nation; every tenth one has no city.
_PLACE = {
    "country_name": "n_name",
    "region_name": "r_name",
    "city_name": "CASE WHEN n_nationkey % 10 <> 3 THEN n_name END",
    "latitude": "CAST(n_nationkey * 3 - 36 AS DOUBLE)",
    "longitude": "CAST(n_nationkey * 14 - 170 AS DOUBLE)",
}
_ADDRESS = """concat('10.', shiftright(user_id, 16) % 256, '.',
 shiftright(user_id, 8) % 256, '.', user_id % 256)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_log_line(events: DataFrame) -> DataFrame:
    """Add ``message``: the combined-format line of an event."""
    line = f"""concat({_ADDRESS},
 ' - - [', date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), ' +0000] "', {_VERB},
 ' /', event_type, '/', event_id % 58, ' HTTP/1.1" ', {_STATUS},
 ' ', cast(round(value * 100) as bigint), ' "-" "agent-', user_id % 7, '"')"""
    return events.withColumn("message", F.expr(line))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread_small_input(table(spark, sf_dir, "events"))
    return with_log_line(events).select("event_id", "user_id", "message")


def parsed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_combined_log(log_lines(spark, sf_dir))


def user_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, geoip)``; every tenth nation has no city."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey",
        "named_struct(" + ", ".join(f"'{n}', {sql}" for n, sql in _PLACE.items()) + ") AS geoip",
    )
    customer = table(spark, sf_dir, "customer")
    return customer.join(places, customer.c_nationkey == places.n_nationkey).select(
        F.col("c_custkey").alias("user_id"), "geoip"
    )


def event_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, geoip)`` of every event, without its log line."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return lookup_join(events, user_places(spark, sf_dir), "user_id", salt_by="event_id")


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed lines with ``geoip``; some ``response`` texts are not numbers."""
    return _located(parsed_logs(spark, sf_dir), user_places(spark, sf_dir))


def stream_log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of :func:`log_records` as a stream."""
    lines = with_log_line(stream_table(spark, sf_dir, "events"))
    parsed = parse_combined_log(lines.select("event_id", "user_id", "message"))
    return _located(parsed, user_places(spark, sf_dir))


def _located(parsed: DataFrame, places: DataFrame) -> DataFrame:
    located = lookup_join(parsed, places, "user_id", salt_by="event_id")
    response = F.when(F.col("event_id") % 97 == 0, "-").otherwise(F.col("response"))
    return located.withColumn("response", response)


def _customer_ranges(spark, sf_dir, width: int, covered: str) -> DataFrame:
    """Ranges of so many customers, placed where their first one lives."""
    first = F.min(F.struct("c_custkey", "c_nationkey"))["c_nationkey"]
    blocks = (
        table(spark, sf_dir, "customer")
        .groupBy(F.expr(f"c_custkey div {width}").alias("block"))
        .agg(F.min("c_custkey").alias("lo"), F.max("c_custkey").alias("hi"), first.alias("n"))
    )
    nation = table(spark, sf_dir, "nation")
    base = 10 << 24
    return blocks.join(nation, blocks.n == nation.n_nationkey).select(
        (F.col("lo") + base).alias("ip_start"),
        (F.expr(covered) + base).alias("ip_end"),
        F.col("n_name").alias("geo_city"),
    )


def address_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IP ranges: the first three quarters of every 60 customers, and around them the first
    half of every 600. Other addresses have no range."""
    inner = _customer_ranges(spark, sf_dir, 60, "lo + (hi - lo) * 3 div 4")
    return inner.unionByName(_customer_ranges(spark, sf_dir, 600, "lo + (hi - lo) div 2"))


def location_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`address_ranges` with the places of :func:`user_places`."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_name AS geo_city", *[f"{sql} AS {name}" for name, sql in _PLACE.items()]
    )
    return address_ranges(spark, sf_dir).join(places, "geo_city").drop("geo_city")


def raw_lines(events: DataFrame) -> DataFrame:
    """``(event_id, message)``: log lines as collected, some of them of another form."""
    broken = F.when(
        F.col("event_id") % 89 == 0, F.concat(F.lit("restart "), F.col("message"))
    ).otherwise(F.col("message"))
    return with_log_line(events).select("event_id", broken.alias("message"))


def stream_table(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    """A table as a file stream; works for one file and for a folder of files."""
    schema = table(spark, sf_dir, name).schema
    pattern = f"{sf_dir}/{name}.parque[t]"
    return spark.readStream.schema(schema).options(**options).parquet(pattern)
