from pyspark.sql import functions as F

from loglens.functions import parsing
from loglens.functions.split import hash_split, random_split
from loglens.schema import LOG_SCHEMA

# The public sample line of a combined access log; its fields below are golden values.
SAMPLE = (
    '83.149.9.216 - - [04/Jan/2015:05:13:42 +0000] '
    '"GET /presentations/logstash-monitorama-2013/images/kibana-search.png HTTP/1.1" 200 203023 '
    '"http://semicomplete.com/presentations/logstash-monitorama-2013/" '
    '"Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_1) AppleWebKit/537.36 (KHTML, like Gecko) '
    'Chrome/32.0.1700.77 Safari/537.36"'
)


def _parse(spark, *lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, message string")
    return [r.asDict() for r in parsing.parse_combined_log(df).orderBy("i").collect()]


def test_sample_line(spark):
    (row,) = _parse(spark, SAMPLE)
    assert row["parsed"]
    assert row["clientip"] == "83.149.9.216"
    assert row["ident"] == row["auth"] == "-"
    assert row["timestamp"] == "04/Jan/2015:05:13:42 +0000"
    assert row["verb"] == "GET"
    assert row["request"].endswith("kibana-search.png")
    assert row["httpversion"] == "1.1"
    assert row["rawrequest"] is None
    assert (row["response"], row["bytes"]) == ("200", "203023")
    assert row["referrer"].startswith('"http://') and row["referrer"].endswith('/"')
    assert row["agent"].startswith('"Mozilla') and row["agent"].endswith('Safari/537.36"')


def test_odd_lines(spark):
    head = '1.2.3.4 - bob [04/Jan/2015:05:13:42 +0000] '
    rows = _parse(
        spark,
        head + '"GET /a HTTP/1.0" 304 - "-" "x"',
        head + '"GET /a" 200 5 "-" "x"',
        head + '"\\x16\\x03 garbage" 400 5 "-" "x"',
        head + '"BADVERB /a HTTP/1.0" 200 5 "-" "say \\"hi\\" now"',
        "not a log line",
        head + '"GET /a\u0001b HTTP/1.0" 200 5 "-" "x"',
        None,
        "",
    )
    no_bytes, no_version, garbage, escaped, bad, separator, missing, empty = rows
    assert no_bytes["bytes"] is None and no_bytes["response"] == "304"
    assert no_version["httpversion"] is None and no_version["request"] == "/a"
    assert garbage["verb"] is None and garbage["rawrequest"] == "\\x16\\x03 garbage"
    assert escaped["verb"] == "BADVERB" and escaped["agent"] == '"say \\"hi\\" now"'
    assert separator["parsed"] and separator["request"] == "/a\u0001b"
    for row in (bad, missing, empty):
        assert not row["parsed"]
        assert all(row[name] is None for name in parsing.COMBINED_FIELDS)


def test_very_long_fields(spark):
    agent = '"' + 'a' * 200_000 + '\\"' * 20_000 + '"'
    (row,) = _parse(spark, f'1.2.3.4 - - [04/Jan/2015:05:13:42 +0000] "GET /a" 200 5 "-" {agent}')
    assert row["parsed"] and row["agent"] == agent


def test_scalar_functions(spark):
    row = (
        spark.range(1)
        .select(
            parsing.minute_stamp(
                parsing.parse_log_time(F.lit("04/Jan/2015:07:13:42 +0200"))
            ).alias("minute"),
            parsing.parse_log_time(F.lit("yesterday")).alias("no_time"),
            parsing.text_to_double(F.lit("404")).alias("number"),
            parsing.text_to_double(F.lit("-")).alias("no_number"),
            parsing.strip_commas(F.lit("1,2,")).alias("stripped"),
            parsing.strip_commas(F.lit(None).cast("string")).alias("blank"),
            parsing.split_csv_line(F.lit("a,,c")).alias("cells"),
            parsing.ipv4_number(F.lit("10.0.1.2")).alias("ip"),
            parsing.ipv4_number(F.lit("255.255.255.255")).alias("last_ip"),
            parsing.ipv4_number(F.lit("10.0.1.256")).alias("bad_ip"),
            parsing.ipv4_number(F.lit("::1")).alias("other_ip"),
        )
        .first()
    )
    assert row["minute"] == "2015-01-04--05-13" and row["no_time"] is None
    assert row["number"] == 404.0 and row["no_number"] is None
    assert row["stripped"] == "12" and row["blank"] == ""
    assert row["cells"] == ["a", "", "c"]
    assert row["ip"] == (10 << 24) + 258 and row["last_ip"] == 2**32 - 1
    assert row["bad_ip"] is None and row["other_ip"] is None


def test_split_is_disjoint_complete_and_stable(spark):
    ids = spark.range(10_000)
    train, test = hash_split(ids, "id")
    again, _ = hash_split(ids.repartition(3), "id")
    assert train.count() + test.count() == 10_000
    assert train.join(test, "id").isEmpty()
    assert train.exceptAll(again).isEmpty()
    assert 3_800 < train.count() < 4_200
    first, second = random_split(ids)
    assert first.count() + second.count() == 10_000 and 3_700 < first.count() < 4_300


def test_schema_has_the_nested_place():
    assert len(LOG_SCHEMA.fields) == 18
    assert len(LOG_SCHEMA["geoip"].dataType.fields) == 15


def test_carriage_return_is_not_part_of_the_agent(spark):
    line = '1.2.3.4 - - [04/Jan/2024:05:13:42 +0000] "GET /x HTTP/1.0" 200 5 "-" "agent"\r'
    row = parsing.parse_combined_log(spark.createDataFrame([(line,)], "message string")).first()
    assert row["parsed"] and row["agent"] == '"agent"'


def _patterns(df):
    """How often the optimized plan replaces the pattern."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(")


def test_pattern_runs_once_or_not_at_all(spark, tmp_path):
    lines = spark.createDataFrame([(1, SAMPLE), (2, "no line")], "i int, message string")
    lines.write.parquet(str(tmp_path / "lines"))
    parsed = parsing.parse_combined_log(spark.read.parquet(str(tmp_path / "lines")))
    assert _patterns(parsed.agg(F.count("*"))) == 0
    assert _patterns(parsed.select("i").distinct()) == 0
    several = parsed.filter("parsed and verb = 'GET' and response = '200'").select("verb", "agent")
    for used in (parsed, several, parsed.groupBy("parsed", "verb").count()):
        assert _patterns(used) == 1
    assert parsed.count() == 2 and [r["verb"] for r in several.collect()] == ["GET"]
