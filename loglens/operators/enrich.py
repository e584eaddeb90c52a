"""Lookup joins that add locations: IP ranges and a gazetteer of addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.functions.parsing import ipv4_number, parse_combined_log
from loglens.operators.lookup import BROADCAST_BYTES, lookup_join, measured_bytes
from loglens.schema import GEOIP_SCHEMA
from loglens.session import written

# Bits of an IPv4 address.
_BITS = 32


def _key(length, prefix):
    """A prefix and its length as one number."""
    return length.cast("bigint") * (1 << _BITS) + prefix


def prefix_cover(ranges: DataFrame) -> DataFrame:
    """``(key, length, place)``: the address prefixes that make up each range.

    A prefix belongs to a range when all its addresses do and those of the prefix one
    bit shorter do not. There are at most two of each length, so at most 62 for a
    range. Of ranges with one prefix in common the smallest gives its place, so that with
    nested ranges the longest prefix of an address is that of the innermost range.
    """
    places = [c for c in ranges.columns if c not in ("ip_start", "ip_end")]
    start, end = F.col("ip_start"), F.col("ip_end")
    levels = ranges.select(
        start,
        end,
        F.struct(*places).alias("place"),
        F.explode(F.sequence(F.lit(0), F.lit(_BITS))).alias("length"),
    )
    rest = F.lit(_BITS) - F.col("length")

    def whole_blocks(bits):
        """First and last prefix of that many free bits which lie within the range."""
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)
        return (
            F.call_function("shiftright", start + size - 1, bits),
            F.call_function("shiftright", end + 1, bits) - 1,
        )

    first, last = whole_blocks(rest)
    wider_first, wider_last = whole_blocks(rest + 1)
    none_wider = (F.col("length") == 0) | (wider_first > wider_last)
    beside = F.array_compact(
        F.array(
            F.when(first < 2 * wider_first, first), F.when(last > 2 * wider_last + 1, last)
        )
    )
    prefixes = F.when(none_wider & (first <= last), F.sequence(first, last)).when(
        ~none_wider, beside
    )
    return (
        levels.select("ip_start", "ip_end", "place", "length", F.explode(prefixes).alias("prefix"))
        .select(
            _key(F.col("length"), F.col("prefix")).alias("key"),
            "length",
            "place",
            F.struct(end - start, start, "place").alias("size"),
        )
        .groupBy("key")
        .agg(F.min("length").alias("length"), F.min_by("place", "size").alias("place"))
    )


def _prefix_key(length):
    return _key(F.lit(length), F.shiftright("_ip", _BITS - length))


def _by_each_length(facts: DataFrame, cover: DataFrame, lengths) -> DataFrame:
    """One map-side join a length, the longest first; rows do not move."""
    place = F.lit(None).cast(cover.schema["place"].dataType)
    for length in lengths:
        known = cover.filter(F.col("length") == length).select(
            F.col("key").alias("_known"), F.col("place").alias(f"_place{length}")
        )
        facts = facts.join(F.broadcast(known), _prefix_key(length) == F.col("_known"), "left")
        facts = facts.drop("_known")
        place = F.coalesce(place, F.col(f"_place{length}"))
    return facts.withColumn("_place", place).drop(*[f"_place{n}" for n in lengths])


def _by_address(facts: DataFrame, cover: DataFrame, lengths, row_id, limit) -> DataFrame:
    """Different addresses meet their prefixes; then the facts meet the addresses."""
    keys = F.explode(F.array(*[_prefix_key(n) for n in lengths])).alias("key")
    asked = facts.filter("_ip IS NOT NULL").select("_ip").distinct().select("_ip", keys)
    met = lookup_join(asked, cover, "key", salt_by="_ip", how="inner", broadcast_bytes=limit)
    found = met.groupBy("_ip").agg(F.max_by("place", "length").alias("_place"))
    found = written(found, "address-places")
    return lookup_join(facts, found, "_ip", salt_by=row_id, broadcast_bytes=limit)


def geoip_enrich(
    logs: DataFrame,
    ranges: DataFrame,
    row_id: str,
    ip: str = "clientip",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the columns of ``ranges`` for the innermost range that holds the address.

    ``ranges`` has ``ip_start``, ``ip_end`` (BIGINT, inclusive). They become a table of
    address prefixes, and a row takes the place of its longest prefix there: joins by
    equality only, one match a row however crowded a part of the address space is.
    Columns of ``logs`` that ``ranges`` has as well are replaced.

    Tables measured within ``broadcast_bytes`` are joined where the rows are. Larger ones are
    asked by the different addresses, each once for every length that occurs; a stream has
    to be enriched batch by batch then.
    """
    places = [c for c in ranges.columns if c not in ("ip_start", "ip_end")]
    cover = written(prefix_cover(ranges), "prefix-cover")
    # At most 33 lengths.
    lengths = sorted((r[0] for r in cover.select("length").distinct().collect()), reverse=True)
    facts = logs.drop(*places).withColumn("_ip", ipv4_number(F.col(ip)))
    if not lengths:
        found = facts.withColumn("_place", F.lit(None).cast(cover.schema["place"].dataType))
    elif measured_bytes(cover) <= broadcast_bytes:
        found = _by_each_length(facts, cover, lengths)
    elif logs.isStreaming:
        raise ValueError("this table of ranges is too large to join with a stream")
    else:
        found = _by_address(facts, cover, lengths, row_id, broadcast_bytes)
    kept = [F.col(f"`{c}`") for c in facts.columns if c != "_ip"]
    return found.select(*kept, *[F.col(f"_place.`{c}`").alias(c) for c in places])


def located_records(
    lines: DataFrame, ranges: DataFrame, row_id: str, message: str = "message",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Raw lines to log records: the parsed fields and a ``geoip`` struct.

    ``ranges`` may have any of the members of the struct as columns; the others are null,
    but for ``ip`` and ``location``. Addresses without a range have no struct.
    """
    given = [f for f in GEOIP_SCHEMA.fields if f.name in ranges.columns]
    place = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in given])
    table = ranges.select("ip_start", "ip_end", place.alias("geoip"))
    found = geoip_enrich(
        parse_combined_log(lines, message), table, row_id, broadcast_bytes=broadcast_bytes
    )
    members = {f.name: F.lit(None).cast(f.dataType) for f in GEOIP_SCHEMA.fields}
    members |= {f.name: F.col("geoip")[f.name] for f in given}
    members["ip"] = F.col("clientip")
    if {"latitude", "longitude"} <= set(ranges.columns):
        members["location"] = F.array(F.col("geoip.longitude"), F.col("geoip.latitude"))
    whole = F.struct(*[column.alias(name) for name, column in members.items()])
    return found.withColumn("geoip", F.when(F.col("geoip").isNotNull(), whole))


def _places(gazetteer: DataFrame) -> DataFrame:
    return gazetteer.groupBy("address").agg(F.min(F.struct("lat", "lng")).alias("_place"))


def geocode_lookup(
    rows: DataFrame,
    gazetteer: DataFrame,
    row_id: str,
    address: str = "address",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``lat``, ``lng`` (0.0 when unknown) and ``geocoded``.

    ``gazetteer`` is ``(address, lat, lng)``. Of several places with one address
    the one with the smallest coordinates is taken, so the answer is stable.
    """
    places = _places(gazetteer).withColumnRenamed("address", address)
    joined = lookup_join(rows, places, address, salt_by=row_id, broadcast_bytes=broadcast_bytes)
    return joined.withColumns(
        {
            "lat": F.coalesce("_place.lat", F.lit(0.0)),
            "lng": F.coalesce("_place.lng", F.lit(0.0)),
            "geocoded": F.col("_place").isNotNull(),
        }
    ).drop("_place")


# Names of the SQL functions and the coordinate each returns.
GEOCODE_FUNCTIONS = {"geocodeCityCountryLat": "lat", "geocodeCityCountryLng": "lng"}


def register_geocode_functions(gazetteer: DataFrame, view: str = "gazetteer_places") -> None:
    """SQL functions ``(address) -> coordinate``, 0.0 when unknown.

    They are SQL bodies, not Python: each call becomes a left join with the
    gazetteer. For both coordinates at once :func:`geocode_lookup` joins once.
    """
    spark = gazetteer.sparkSession
    _places(gazetteer).selectExpr("address", "_place.lat", "_place.lng").createOrReplaceTempView(
        view
    )
    for name, coordinate in GEOCODE_FUNCTIONS.items():
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(place STRING) RETURNS DOUBLE
            RETURN coalesce((SELECT max({coordinate}) FROM {view} WHERE address = place),
                            CAST(0 AS DOUBLE))"""
        )
