"""Vectors of path segments from the segments beside them.

Equal requests count once, with their number as weight. Segments that stand near one
another are counted by a shuffle, the counts become associations (how much more often
than by chance), and the table of associations is factorised block by block (alternating
least squares), with one row factor a segment: its vector. No task and not the driver
holds all segments or all pairs; the number of different segments is bounded only by
the factorisation's 32-bit numbers.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglens.operators.lookup import lookup_join
from loglens.operators.ordering import running_totals
from loglens.session import checkpointed, written

# The batch function travels with its task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Segments on either side that count as near.
REACH = 5
SIZE = 16
SEED = 11


def segments(column):
    """The parts of a path without its empty ones."""
    return F.filter(F.split(column, "/"), lambda part: part != "")


def weighted_requests(df: DataFrame, column: str = "request") -> DataFrame:
    """``(words, weight)`` of every different request."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("weight"))
        .select(segments(F.col(column)).alias("words"), "weight")
    )


def cooccurrences(requests: DataFrame, reach: int = REACH) -> DataFrame:
    """``(word, other, n)``: how often ``other`` stands within ``reach`` of ``word``."""
    places = F.sequence(F.lit(1), F.size("words"))
    at = requests.filter(F.size("words") > 1).select("words", "weight", F.explode(places).alias("i"))
    after = F.slice("words", F.col("i") + 1, F.lit(reach))
    pairs = at.select(
        F.element_at("words", F.col("i")).alias("word"), F.explode(after).alias("other"), "weight"
    )
    both = F.array(
        F.struct("word", "other"), F.struct(F.col("other").alias("word"), F.col("word").alias("other"))
    )
    return (
        pairs.select(F.inline(both), "weight")
        .groupBy("word", "other")
        .agg(F.sum("weight").alias("n"))
    )


def associations(pairs: DataFrame, totals: DataFrame) -> DataFrame:
    """``(word, other, value)``: the logarithm of n over what chance gives, if above 0."""
    whole = totals.agg(F.sum("n").alias("n")).scalar().cast("double")
    other = totals.select(F.col("word").alias("other"), F.col("n").alias("n_other"))
    sides = lookup_join(
        pairs, totals.withColumnRenamed("n", "n_word"), "word", salt_by=("word", "other")
    )
    sides = lookup_join(sides, other, "other", salt_by=("word", "other"))
    value = F.log(F.col("n") * whole / (F.col("n_word").cast("double") * F.col("n_other")))
    return sides.withColumn("value", value).filter("value > 0").select("word", "other", "value")


def token_vectors(
    requests: DataFrame, size: int = SIZE, seed: int = SEED, reach: int = REACH, **params
) -> DataFrame:
    """``(word, n, vector array<float>)`` of every segment that stands beside another one."""
    pairs = written(cooccurrences(requests, reach), "cooccurrences")
    totals = checkpointed(pairs.groupBy("word").agg(F.sum("n").alias("n")))
    ranks = running_totals(totals, [F.desc("n"), F.asc("word")], {"number": F.lit(1)})
    numbers = written(ranks.select("word", "n", F.col("number").cast("int").alias("number")), "words")
    rated = associations(pairs, totals)
    for side in ("word", "other"):
        named = numbers.select(F.col("word").alias(side), F.col("number").alias(f"{side}_number"))
        rated = lookup_join(rated, named, side, salt_by=("word", "other"))
    model = ALS(
        rank=size,
        userCol="word_number",
        itemCol="other_number",
        ratingCol="value",
        implicitPrefs=True,
        seed=seed,
        **params,
    ).fit(written(rated.select("word_number", "other_number", "value"), "associations"))
    factors = model.userFactors.select(
        F.col("id").alias("number"), F.col("features").alias("vector")
    )
    found = numbers.join(factors, "number", "left").drop("number")
    # Segments that are beside others no more often than by chance have no direction.
    none = F.array_repeat(F.lit(0.0).cast("float"), size)
    return written(found.withColumn("vector", F.coalesce("vector", none)), "token-vectors")


def request_vectors(
    df: DataFrame, column: str = "request", out: str = "requestWords", size=SIZE, seed=SEED,
    row_id: str | None = None, **params,
) -> DataFrame:
    """``df`` with the mean vector of the segments of each request; zero without any."""
    vectors = token_vectors(weighted_requests(df, column), size, seed, **params).drop("n")
    known = df.select(column).filter(F.col(column).isNotNull()).distinct()
    words = known.select(column, F.posexplode(segments(F.col(column))).alias("place", "word"))
    placed = lookup_join(words, vectors, "word", salt_by=(column, "place"))
    sums = [F.sum(F.get("vector", F.lit(i))).alias(f"_{i}") for i in range(size)]
    means = placed.groupBy(column).agg(F.count(F.lit(1)).alias("_n"), *sums)
    mean = F.array(*[F.coalesce(F.col(f"_{i}") / F.col("_n"), F.lit(0.0)) for i in range(size)])
    means = written(means.select(column, mean.alias("_mean")), "request-vectors")
    salted = df if row_id else df.withColumn("_row", F.monotonically_increasing_id())
    found = lookup_join(salted, means, column, salt_by=row_id or "_row")
    zero = F.array_repeat(F.lit(0.0), size)
    return found.withColumn(out, array_to_vector(F.coalesce("_mean", zero))).drop("_mean", "_row")


def _nearest_batches(names, matrix, k):
    def run(batches):
        for batch in batches:
            words = np.array(batch.column("word").to_pylist(), dtype=object)
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            vectors = flat.reshape(len(words), -1).astype(np.float64)
            norms = np.linalg.norm(vectors, axis=1)
            likeness = matrix @ (vectors / np.where(norms > 0, norms, 1)[:, None]).T
            rows = []
            for name, cosines in zip(names, likeness):
                usable = np.flatnonzero((words != name) & (norms > 0))
                best = usable[np.argsort(-cosines[usable], kind="stable")[: k + 1]]
                # Equals of the last one stay, so that ties do not depend on batches.
                if len(best):
                    best = usable[cosines[usable] >= cosines[best[-1]]]
                rows += [(name, words[i], float(cosines[i])) for i in best]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), _KINDS)] if rows else _NONE,
                names=["word", "neighbour", "cosine"],
            )

    return run


_KINDS = (pa.string(), pa.string(), pa.float64())
_NONE = [pa.array([], t) for t in _KINDS]


def nearest_tokens(vectors: DataFrame, asked: int = 20, k: int = 5) -> DataFrame:
    """``(word, rank, neighbour, cosine)``: the ``k`` nearest segments of the most frequent ones.

    ``asked`` segments are the query set: a small matrix that goes to all blocks of segments.
    """
    rows = vectors.orderBy(F.desc("n"), "word").limit(asked).collect()
    names = [r["word"] for r in rows]
    matrix = np.array([r["vector"] for r in rows], dtype=np.float64).reshape(len(rows), -1)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = matrix / np.where(norms > 0, norms, 1)
    found = vectors.select("word", "vector").mapInArrow(
        _nearest_batches(names, matrix, k), "word string, neighbour string, cosine double"
    )
    best = Window.partitionBy("word").orderBy(F.desc("cosine"), "neighbour")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
