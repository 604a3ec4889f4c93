"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..sources.staging import shared_dir, stored

__all__ = ["Memo", "SLICE", "settled", "shared_dir", "slices", "stored", "table", "text_slices", "worker_kept"]

#: Rows of an Arrow batch that Python keeps while it works on one piece.
SLICE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """The rows, computed once, on reliable storage, with no lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text", max_bytes: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices whose texts come to about max_bytes; a longer text stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if i > start and total + size > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


_kept: dict = {}


def worker_kept(key: object, make: Callable[[], object]):
    """What a Python worker keeps from task to task; of one operator at a time, so that operators that run one after another don't add up."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


class Memo(dict):
    """A function's results by argument (a string or bytes); emptied at a bound of entries or of their arguments' length, so that memory stays level. Long arguments are not kept."""

    LONG, HELD = 256, 1 << 24

    def __init__(self, function, bound: int = 400_000):
        super().__init__()
        self.function, self.bound, self.held = function, bound, 0

    def __missing__(self, key):
        value, size = self.function(key), len(key)
        if size > self.LONG:
            return value
        if len(self) >= self.bound or self.held > self.HELD:
            self.clear()
            self.held = 0
        self.held += size
        self[key] = value
        return value
