"""Helpers that the training-data operators share: reading, shared folders, byte kernels."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteweave.shared import delete, fresh, remove, shared_dir  # noqa: F401  as the operators import them from here
from siteweave.shared import stored as written  # noqa: F401

#: The white space of the word rule [^\x20\x09-\x0D]+; all of it is one byte long in UTF-8.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a piece holds about `most` bytes of the string column, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the rows' offsets into them (nulls are empty)."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None else np.empty(0, dtype=np.uint8)
    return raw, offs - offs[0]


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ and the number of words in each row."""
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    word = ~SPACE[raw]
    edge = np.empty(len(raw) + 1, dtype=bool)
    edge[0] = edge[-1] = True
    np.not_equal(word[1:], word[:-1], out=edge[1:-1])
    edge[offsets] = True  # words don't run on from one row to the next
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = word[starts]
    starts, ends = starts[keep], ends[keep]
    upto = np.searchsorted(starts, offsets)
    return starts, ends, np.diff(upto)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def schema_with(df: DataFrame, **fields: str) -> T.StructType:
    """df's schema with further fields, given as type strings."""
    more = T.StructType.fromDDL(",".join(f"`{k}` {v}" for k, v in fields.items()))
    return T.StructType([*df.schema.fields, *more.fields])


class Recent(dict):
    """Values of the keys used of late: as a table fills up, it becomes the older one and a new one is begun. A key
    without a value is given make(key) when it is read."""

    def __init__(self, most: int, make: Callable | None = None) -> None:
        super().__init__()
        self.most, self.make, self.older = most, make, {}

    def turn(self, more: int) -> None:
        if len(self) + more > self.most:
            self.older = dict(self)
            self.clear()

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.turn(1)
        self[key] = value
        return value

    def missing(self, keys: set) -> list:
        """The keys without a value; those with one in the older table move up. All of them can then be read from this one."""
        self.turn(len(keys))
        new = []
        for key in keys:
            if key not in self:
                if key in self.older:
                    self[key] = self.older[key]
                else:
                    new.append(key)
        return new


#: What this worker keeps from task to task, by operator; workers serve one operator after the other.
KEPT: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """The operator's store in this worker; those of other operators are emptied, so that they don't add up."""
    for name, store in KEPT.items():
        if name != operator and store:
            store.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
    return KEPT.setdefault(operator, {})
