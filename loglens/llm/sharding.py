"""Sharding by extendible hashing.

The directory is indexed by leading bits of a hash of the document id. A bucket
above the byte limit splits on its next bit, and only such buckets do, until
every bucket fits. Bits are cells of one histogram: the total of every prefix of
every cell is summed in one grouping, and the bucket of a cell is its shortest
prefix that fits. Cells that are still too large at the deepest bit of a round
get a finer histogram in the next round.

Defined results: a null text has no bytes; a null id hashes like the text
"null". Rows with one id share a bucket, so a bucket that no bit can split (one
id, or one document above the limit) is cut into consecutive pieces at the
deepest level, by running bytes; a single document above the limit is a shard of
its own. An empty table gives no shard. Other columns do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglens.llm.common import pick, ship, written

HASH_BITS = 60
SHARD_BYTES = 8 * 1024 * 1024
# Bits beyond those that equal buckets would need: room for uneven ones.
SPARE_BITS = 6


def _bits(doc_id):
    """60 leading bits of an md5 of the id, as a long."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _shifted(number, bits):
    return F.call_function("shiftright", number, bits)


def _bucket_cells(cells: DataFrame, first: int, depth: int, limit: int) -> DataFrame:
    """``(cell, bucket_depth)`` of all cells; null depth: too large even at ``depth``.

    ``cells(cell, bytes)`` are totals of ``depth``-bit prefixes.
    """
    levels = F.explode(F.sequence(F.lit(first), F.lit(depth))).alias("d")
    prefix = _shifted(F.col("cell"), F.lit(depth) - F.col("d"))
    every = cells.select("cell", "bytes", levels).withColumn("prefix", prefix)
    fits = (
        every.groupBy("d", "prefix")
        .agg(F.sum("bytes").alias("total"))
        .filter(F.col("total") <= limit)
    )
    found = (
        every.select("cell", "d", "prefix")
        .join(fits, ["d", "prefix"])
        .groupBy("cell")
        .agg(F.min("d").alias("bucket_depth"))
    )
    return cells.select("cell").join(found, "cell", "left")


def extendible_shards(
    docs: DataFrame, doc_id="doc_id", text="text", limit=SHARD_BYTES
) -> DataFrame:
    """``(doc_id, n_bytes, depth, bucket, piece)``: bucket is the prefix as a number."""
    slim = pick(docs, doc_id=doc_id, text=text).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        _bits(F.col("doc_id")).alias("bits"),
    )
    rest = written(slim, "shard-sizes")
    total = rest.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b")).first()["b"]
    first = 0
    depth = min(HASH_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SPARE_BITS)
    done = None
    while True:
        at = _shifted(F.col("bits"), F.lit(HASH_BITS - depth)).alias("cell")
        placed = rest.withColumn("cell", at)
        cells = placed.groupBy("cell").agg(F.sum("n_bytes").alias("bytes"))
        buckets = _bucket_cells(cells, first, depth, limit)
        found = placed.join(buckets, "cell")
        fitting = found.filter("bucket_depth is not null").select(
            "doc_id",
            "n_bytes",
            F.col("bucket_depth").alias("depth"),
            _shifted(F.col("cell"), F.lit(depth) - F.col("bucket_depth")).alias("bucket"),
            F.lit(0).cast("bigint").alias("piece"),
        )
        done = fitting if done is None else done.unionByName(fitting)
        over = found.filter("bucket_depth is null").select("doc_id", "n_bytes", "bits")
        over = written(over, "shard-rest")
        if over.isEmpty():
            return done
        if depth == HASH_BITS:
            return done.unionByName(_pieces(over, limit))
        rest, first, depth = over, depth + 1, min(HASH_BITS, depth + 12)


def _pieces(rows: DataFrame, limit: int) -> DataFrame:
    """Buckets of one hash: consecutive pieces within the limit.

    Sizes only, and in subgroups by a second hash first, so that no task sorts
    the whole of a hot id. Each subgroup starts pieces of its own.
    """
    hot = rows.groupBy("bits").agg(F.count("*").alias("n"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / 100_000)).cast("bigint")
    spread = rows.join(hot, "bits").withColumn(
        "part", F.pmod(F.xxhash64("n_bytes", F.monotonically_increasing_id()), parts)
    )
    spread = written(spread, "shard-parts")
    run = Window.partitionBy("bits", "part").orderBy("n_bytes", F.monotonically_increasing_id())
    before = F.coalesce(
        F.sum("n_bytes").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    # Items up to half the limit fill pieces of half-open ranges; larger ones stand alone.
    half = limit // 2
    large = F.col("n_bytes") > half
    piece = F.when(large, F.row_number().over(run) * 2 + 1).otherwise(
        F.floor(before / F.lit(max(1, half))) * 2
    )
    return spread.withColumn("in_part", piece).select(
        "doc_id",
        "n_bytes",
        F.lit(HASH_BITS).alias("depth"),
        F.col("bits").alias("bucket"),
        (F.col("in_part") * F.col("n") + F.col("part")).cast("bigint").alias("piece"),
    )


def op7_query(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    placed = extendible_shards(docs)
    return placed.select(
        "doc_id", "n_bytes", F.col("depth").cast("int").alias("depth"), "bucket", "piece"
    )


# All depths; pieces of buckets that no bit splits are left to the brute-force test.
OP7_SQL = f"""
WITH sized AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         CAST(concat('0x', substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15)) AS BIGINT)
           AS bits
  FROM documents
),
levels AS (SELECT CAST(range AS INTEGER) AS depth FROM range(0, {HASH_BITS + 1})),
prefixes AS (
  SELECT depth, bits >> ({HASH_BITS} - depth) AS bucket, sum(n_bytes) AS total
  FROM sized, levels GROUP BY ALL HAVING sum(n_bytes) <= {SHARD_BYTES}
),
found AS (
  SELECT s.doc_id, s.n_bytes, p.depth, p.bucket,
         row_number() OVER (PARTITION BY s.doc_id ORDER BY p.depth) AS nth
  FROM sized s, levels l, prefixes p
  WHERE p.depth = l.depth AND p.bucket = s.bits >> ({HASH_BITS} - l.depth)
)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, depth, bucket, CAST(0 AS BIGINT) AS piece
FROM found WHERE nth = 1
"""

ship(__name__)
