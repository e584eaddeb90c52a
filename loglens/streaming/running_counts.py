"""Running counts of a stream: one small table a batch, merged into a base now and then.

A batch writes the counts of its own rows and nothing else, so what a trigger writes does
not depend on how long the stream has run. Every ``every`` batches the counts up to there
become a new base. The totals after a batch are the last base and at most ``every`` tables
after it; which ones follows from the batch's number alone, so a repeated batch finds
and replaces exactly what its first attempt saw.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.session import remove_folder

COMPACT_EVERY = 20


@dataclass(frozen=True)
class RunningCounts:
    """Counts under ``path``; ``weight`` is summed, all other columns are the key."""

    path: str
    query: str
    every: int = COMPACT_EVERY
    weight: str = "weight"

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/query_id={self.query}/{kind}/{batch_id}"

    def _base(self, batch_id: int) -> int:
        """The last batch that the base for ``batch_id`` includes; -1 for none."""
        return batch_id // self.every * self.every - 1

    def _summed(self, rows: DataFrame) -> DataFrame:
        key = [c for c in rows.columns if c != self.weight]
        return rows.groupBy(*key).agg(F.sum(self.weight).alias(self.weight))

    def add(self, counts: DataFrame, batch_id: int) -> None:
        """Stores the counts of a batch, and a new base where one is due."""
        counts.write.mode("overwrite").parquet(self._folder("delta", batch_id))
        if (batch_id + 1) % self.every:
            return
        totals = self.totals(counts.sparkSession, counts.schema, batch_id)
        totals.write.mode("overwrite").parquet(self._folder("base", batch_id))
        # A repeat of this batch still needs the base before it and what came after that.
        last = self._base(batch_id)
        spark = counts.sparkSession
        for old in range(max(0, last + 1 - self.every), last + 1):
            remove_folder(spark, self._folder("delta", old))
        remove_folder(spark, self._folder("base", last - self.every))

    def totals(self, spark, schema, batch_id: int) -> DataFrame:
        """Counts of all batches up to ``batch_id``."""
        base = self._base(batch_id)
        folders = [self._folder("delta", n) for n in range(base + 1, batch_id + 1)]
        if base >= 0:
            folders.append(self._folder("base", base))
        return self._summed(spark.read.schema(schema).parquet(*folders))
