"""Train/test split by a stable hash of the row key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Share of rows used for training, in percent, and the seed of
# the random variant.
TRAIN_PERCENT = 40
SPLIT_SEED = 11


def is_train(row_id: Column, percent: int = TRAIN_PERCENT) -> Column:
    """Depends on the key only, so partitioning and retries cannot change it."""
    prefix = F.substring(F.md5(row_id.cast("string").cast("binary")), 1, 8)
    return F.conv(prefix, 16, 10).cast("bigint") % 100 < percent


def hash_split(df: DataFrame, row_id: str, percent: int = TRAIN_PERCENT):
    marked = is_train(F.col(row_id), percent)
    return df.filter(marked), df.filter(~marked)


def random_split(df: DataFrame, weights=(0.4, 0.6), seed: int = SPLIT_SEED):
    train, test = df.randomSplit(list(weights), seed=seed)
    return train, test
