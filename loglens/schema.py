"""Declared schemas. Nothing in the package infers a schema from data."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _fields(spark_type, *names):
    return [StructField(name, spark_type) for name in names]


GEOIP_SCHEMA = StructType(
    _fields(StringType(), "ip")
    + _fields(LongType(), "area_code")
    + _fields(StringType(), "postal_code")
    + _fields(LongType(), "dma_code")
    + _fields(
        StringType(),
        "country_code2",
        "country_code3",
        "country_name",
        "continent_code",
        "region_name",
        "city_name",
    )
    + _fields(DoubleType(), "latitude", "longitude")
    + _fields(StringType(), "timezone", "real_region_name")
    # [longitude, latitude]
    + _fields(ArrayType(DoubleType()), "location")
)

LOG_SCHEMA = StructType(
    _fields(
        StringType(),
        "message",
        "@version",
        "@timestamp",
        "path",
        "host",
        "type",
        "clientip",
        "ident",
        "auth",
        "timestamp",
        "verb",
        "request",
        "httpversion",
        "response",
        "bytes",
        "referrer",
        "agent",
    )
    + _fields(GEOIP_SCHEMA, "geoip")
)
