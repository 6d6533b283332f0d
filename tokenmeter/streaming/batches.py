"""A table that micro-batches add to, whose rows fold to one value per key.

Micro-batch ``n`` writes its own part to ``<path>/batch_id=n`` (overwrite: a
retried batch replaces what it wrote) and reads what the batches before it
left.  Every earlier part must be there: a missing one fails the job instead of
counting as empty.  Every ``COMPACT_EVERY`` batches the parts before are folded
into ``<path>-folded/upto=n`` when batch ``n`` is written, so a batch reads a
bounded number of parts; which ones follows from ``n`` alone.  Readers from
outside take ``n`` from the names of the parts and read the same way."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tokenmeter.streaming.io import batch_folder

COMPACT_EVERY = 50


class BatchTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, fold: Callable[[DataFrame], DataFrame], every: int = COMPACT_EVERY):
        self.spark, self.path, self.schema, self.fold, self.every = spark, path.rstrip("/"), schema, fold, every

    def write(self, part: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % self.every == 0:
            self.before(batch_id).write.mode("overwrite").parquet(self._folded(batch_id))
        part.write.mode("overwrite").parquet(batch_folder(self.path, batch_id))

    def _read(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _folded(self, upto: int) -> str:
        return f"{self.path}-folded/upto={upto}"

    def before(self, batch_id: int) -> DataFrame:
        """The folded rows of batches 0 .. batch_id - 1."""
        if batch_id <= 0:
            return self.spark.createDataFrame([], self.schema)
        base = (batch_id - 1) // self.every * self.every
        parts = [batch_folder(self.path, i) for i in range(base, batch_id)]
        return self.fold(self._read(*([self._folded(base)] if base else []), *parts))

    def all(self) -> DataFrame:
        """The folded rows of every batch so far; a gap in the parts is an error."""
        names = {int(re.search(r"/batch_id=(\d+)/", f).group(1)) for f in self.spark.read.schema(self.schema).parquet(self.path).inputFiles()}
        if names != set(range(len(names))):
            raise RuntimeError(f"{self.path}: parts missing before batch {max(names)}")
        return self.before(len(names))
