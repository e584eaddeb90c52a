"""Column expressions for access-log text. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.functions.once import at_most_once

# The field names of a combined log line and the pattern that
# yields them, one capturing group per field, in this order.
COMBINED_FIELDS = (
    "clientip",
    "ident",
    "auth",
    "timestamp",
    "verb",
    "request",
    "httpversion",
    "rawrequest",
    "response",
    "bytes",
    "referrer",
    "agent",
)
_QUOTED = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
COMBINED_PATTERN = (
    r"^(\S+) (\S+) (\S+) \[([^\]]+)\] "
    r'"(?:(\w+) (\S+)(?: HTTP/([0-9.]+))?|(.*?))" '
    r"(\d+) (?:(\d+)|-) "
    rf"({_QUOTED}) ({_QUOTED})\r?\z"
)
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
MINUTE_FORMAT = "yyyy-MM-dd--HH-mm"

_SEPARATOR = "\u0001"


def combined_parts(message: Column) -> Column:
    """Array of the twelve captured texts; another length when nothing matched.

    A single replacement evaluates the pattern once per line; extracting each
    group on its own would evaluate it twelve times. Lines that contain the
    separator themselves take the group-by-group way.
    """
    groups = range(1, len(COMBINED_FIELDS) + 1)
    joined = F.regexp_replace(
        message, F.lit(COMBINED_PATTERN), F.lit(_SEPARATOR.join(f"${i}" for i in groups))
    )
    by_group = F.array(*[F.regexp_extract(message, COMBINED_PATTERN, i) for i in groups])
    return F.when(F.instr(message, _SEPARATOR) == 0, F.split(joined, _SEPARATOR, -1)).when(
        message.rlike(COMBINED_PATTERN), by_group
    )


def parse_combined_log(lines: DataFrame, message: str = "message") -> DataFrame:
    """Add the twelve fields and ``parsed``; fields not captured are NULL.

    A plan that uses none of them does not match the pattern, any other does so once.
    Filters on columns of ``lines`` belong before it.
    """
    parts = lines.withColumn("_parts", at_most_once(combined_parts(F.col(message))))
    parsed = F.coalesce(F.size("_parts") == len(COMBINED_FIELDS), F.lit(False))
    fields = {
        name: F.nullif(F.when(parsed, F.get("_parts", F.lit(i))), F.lit(""))
        for i, name in enumerate(COMBINED_FIELDS)
    }
    return parts.withColumns({**fields, "parsed": parsed}).drop("_parts")


def parse_log_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(LOG_TIME_FORMAT))


def text_to_double(text: Column) -> Column:
    """Numeric value of a text, NULL when it is not a number."""
    return text.try_cast("double")


def minute_stamp(ts: Column) -> Column:
    return F.date_format(ts, MINUTE_FORMAT)


def strip_commas(text: Column) -> Column:
    return F.coalesce(F.replace(text, F.lit(","), F.lit("")), F.lit(""))


def split_csv_line(line: Column) -> Column:
    return F.split(line, ",", -1)


def ipv4_number(address: Column) -> Column:
    """Dotted IPv4 text as BIGINT, NULL when it is not an IPv4 address."""
    octets = F.split(address, r"\.", -1)
    parts = [octets[i].try_cast("bigint") for i in range(4)]
    valid = address.rlike(r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$")
    for part in parts:
        valid = valid & (part <= 255)
    number = parts[0]
    for part in parts[1:]:
        number = number * 256 + part
    return F.when(valid, number)
