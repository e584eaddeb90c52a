import random

from pyspark.sql import functions as F

from loglens.operators import enrich, features
from loglens.operators.lookup import hot_keys, lookup_join, measured_bytes
from loglens.operators.ordering import running_totals


def _facts(spark, n=9_000):
    """A third of the rows has key 7, some have none."""
    return spark.range(n).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 500)
        .alias("key"),
    )


def _dim(spark):
    return spark.range(400).select(F.col("id").alias("key"), F.concat(F.lit("d"), "id").alias("name"))


def test_hot_keys(spark):
    found = dict(hot_keys(_facts(spark), "key", 8))
    assert set(found) == {7}
    assert 3 <= found[7] <= 4


def test_hot_keys_may_be_as_many_as_partitions(spark):
    # 1,500 keys of four rows and 3,000 of one; the average of 3,000 partitions is three.
    facts = spark.range(9_000).select(
        F.when(F.col("id") < 6_000, F.col("id") % 1_500).otherwise(F.col("id")).alias("key")
    )
    assert dict(hot_keys(facts, "key", 3_000)) == dict.fromkeys(range(1_500), 2)


def test_salted_join_equals_plain_join(spark):
    facts, dim = _facts(spark), _dim(spark)
    plain = facts.join(dim, "key", "left").select("row_id", "key", "name")
    for limit in (0, 1 << 20):
        joined = lookup_join(facts, dim, "key", salt_by="row_id", broadcast_bytes=limit)
        joined = joined.select("row_id", "key", "name")
        assert joined.count() == 9_000
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_salted_join_spreads_the_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(_facts(spark), _dim(spark), "key", salt_by="row_id", broadcast_bytes=0)
        sizes = [
            r["count"]
            for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # One task would hold 3,000 rows of the hot key and its share of the rest.
    assert sum(sizes) == 9_000 and max(sizes) < 3_000


def test_measured_bytes_grow_with_text(spark):
    small = spark.range(100).select(F.lit("x").alias("t"))
    large = spark.range(100).select(F.repeat(F.lit("x"), 10_000).alias("t"))
    assert measured_bytes(large) - measured_bytes(small) == 100 * 9_999


def test_running_totals_in_many_tasks(spark):
    df = spark.range(5_000).select(
        "id", (F.col("id") * 37 % 11).alias("g"), (F.col("id") % 5).alias("x")
    )
    order = [F.desc("g"), F.asc("id")]
    totals = {"position": F.lit(1), "total": F.col("x")}
    one = running_totals(df, order, totals)
    many = running_totals(df, order, totals, single_task_rows=400)
    assert many.count() == 5_000
    assert one.exceptAll(many).isEmpty()


def test_string_index_paths_agree(spark):
    df = spark.range(3_000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 97)).alias("v"),
    )
    plain = features.string_index(df, "v", "i", "row_id")
    wide = features.string_index(df, "v", "i", "row_id", broadcast_bytes=0, single_task_rows=10)
    assert plain.exceptAll(wide).isEmpty() and wide.count() == 3_000
    counts = df.groupBy("v").count().collect()
    order = [r["v"] for r in sorted(counts, key=lambda r: (-r["count"], r["v"]))]
    found = {r["v"]: r["i"] for r in plain.select("v", "i").distinct().collect()}
    assert found == {v: float(i) for i, v in enumerate(order)}


def test_index_of_null_is_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "row_id int, v string")
    found = features.string_index(df, "v", "i", "row_id").collect()
    assert {r["row_id"]: r["i"] for r in found} == {1: 0.0, 2: None}


def _number(address):
    a, b, c, d = map(int, address.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


RANGES = [
    ("10.0.0.0", "10.0.0.255", "one"),
    ("10.0.1.0", "10.3.255.255", "wide"),
    ("10.9.0.7", "10.9.0.7", "single"),
    ("200.0.0.0", "255.255.255.255", "top"),
]


def _ranges(spark, rows):
    return spark.createDataFrame(
        [(_number(a), _number(b), c) for a, b, c in rows],
        "ip_start bigint, ip_end bigint, place string",
    )


def test_geoip_ranges(spark):
    expected = {
        "10.0.0.0": "one",
        "10.0.0.255": "one",
        "10.0.1.0": "wide",
        "10.2.200.1": "wide",
        "10.4.0.0": None,
        "10.9.0.6": None,
        "10.9.0.7": "single",
        "255.255.255.255": "top",
        "not an address": None,
        None: None,
    }
    logs = spark.createDataFrame(
        [(i, a, "before", 1) for i, a in enumerate(expected)],
        "row_id int, clientip string, place string, length int",
    )
    for limit in (0, 1 << 26):
        made = enrich.geoip_enrich(logs, _ranges(spark, RANGES), "row_id", broadcast_bytes=limit)
        assert made.columns == ["row_id", "clientip", "length", "place"]
        assert {r["clientip"]: r["place"] for r in made.collect()} == expected
        none = enrich.geoip_enrich(logs, _ranges(spark, RANGES[:0]), "row_id", broadcast_bytes=limit)
        assert [r["place"] for r in none.collect()] == [None] * len(expected)


def test_geoip_struct_is_replaced(spark):
    logs = spark.createDataFrame([(1, "10.0.0.9")], "row_id int, clientip string").selectExpr(
        "*", "named_struct('city_name', 'old', 'latitude', 1D) AS geoip"
    )
    ranges = _ranges(spark, RANGES).selectExpr(
        "ip_start", "ip_end", "named_struct('city_name', place, 'latitude', 2D) AS geoip"
    )
    row = enrich.geoip_enrich(logs, ranges, "row_id").first()
    assert tuple(row["geoip"]) == ("one", 2.0)


def test_prefix_cover_is_exact_and_least(spark):
    draw = random.Random(4)
    bounds = [sorted(draw.sample(range(300), 2)) for _ in range(60)]
    bounds += [[0, 2**32 - 1], [1, 2**32 - 1], [0, 0], [7, 7], [9, 8], [2**32 - 1, 2**32 - 1]]
    for low, high in bounds:
        rows = spark.createDataFrame([(low, high, "x")], "ip_start bigint, ip_end bigint, place string")
        blocks = sorted(
            ((r["key"] % 2**32) << (32 - r["length"]), 2 ** (32 - r["length"]))
            for r in enrich.prefix_cover(rows).collect()
        )
        at = low
        for start, size in blocks:
            assert start == at and start % size == 0
            at += size
        assert at == max(low, high + 1)
        # No two neighbours could be one prefix.
        assert not any(
            a[1] == b[1] and a[0] % (2 * a[1]) == 0 for a, b in zip(blocks, blocks[1:])
        )


def test_crowded_and_nested_ranges(spark):
    """Thousands of ranges in one /16, inside wider ones."""
    draw = random.Random(8)
    base, rows = 10 << 24, [(10 << 24, (10 << 24) + 65_535, "outer")]
    at = 0
    while at < 65_000:
        size = draw.randrange(1, 12)
        rows.append((base + at, base + at + size - 1, f"r{at}"))
        at += size + draw.randrange(3)
    middle = (base + 100, base + 60_000, "middle")
    table = spark.createDataFrame([*rows, middle], "ip_start bigint, ip_end bigint, place string")
    asked = [draw.randrange(70_000) for _ in range(2_000)] + [5] * 500
    logs = spark.createDataFrame(
        [(i, f"10.{n >> 16}.{n >> 8 & 255}.{n & 255}") for i, n in enumerate(asked)],
        "row_id int, clientip string",
    )
    holder = {}
    for low, high, place in [rows[0], middle, *rows[1:]]:
        holder.update((n - base, place) for n in range(low, high + 1))
    for limit in (0, 1 << 26):
        made = enrich.geoip_enrich(logs, table, "row_id", broadcast_bytes=limit).collect()
        assert {r["row_id"]: r["place"] for r in made} == {
            i: holder.get(n) for i, n in enumerate(asked)
        }


def test_geocode(spark):
    gazetteer = spark.createDataFrame(
        [("Moscow", 55.7522, 37.6156), ("Null Island", 0.0, 0.0), ("Twin", 2.0, 1.0), ("Twin", 1.0, 9.0)],
        "address string, lat double, lng double",
    )
    rows = spark.createDataFrame(
        [(1, "Moscow"), (2, "Nowhere"), (3, "Null Island"), (4, None), (5, "Twin")],
        "row_id int, address string",
    )
    expected = {
        1: (55.7522, 37.6156, True),
        2: (0.0, 0.0, False),
        3: (0.0, 0.0, True),
        4: (0.0, 0.0, False),
        5: (1.0, 9.0, True),
    }
    made = enrich.geocode_lookup(rows, gazetteer, "row_id")
    assert {r["row_id"]: (r["lat"], r["lng"], r["geocoded"]) for r in made.collect()} == expected
    enrich.register_geocode_functions(gazetteer)
    rows.createOrReplaceTempView("geocode_rows")
    sql = "SELECT row_id, geocodeCityCountryLat(address) AS lat FROM geocode_rows"
    assert {r["row_id"]: r["lat"] for r in spark.sql(sql).collect()} == {
        k: v[0] for k, v in expected.items()
    }
