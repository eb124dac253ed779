"""A Bloom filter of fixed size over 64-bit hashes, to leave out most rows before an exact join or count.

Its size is a parameter and bounds what reaches the driver and every task; more
hashes than it can tell apart only let more rows through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import mix

FILTER_BYTES = 16 << 20
FILTER_HASHES = 3


class Filter:
    """A Bloom filter over 64-bit hashes as an array of 64-bit words."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(h: np.ndarray, n_bits: int) -> list[np.ndarray]:
        step = mix(h + np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)
        return [(h + np.uint64(i) * step) % np.uint64(n_bits) for i in range(FILTER_HASHES)]

    def holds(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for p in self.places(h, len(self.bits) * 64):
            found &= (self.bits[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def filter_of(hashes: DataFrame, filter_bytes: int) -> Filter:
    """A filter that holds column ``h``: tasks set bits, their words are combined by OR, ``filter_bytes`` at most reach the driver."""
    n = filter_bytes // 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.unique(np.concatenate(Filter.places(b.column("h").to_numpy().view(np.uint64), n * 64)))
            slot, start = np.unique(p >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (p & np.uint64(63)), start) if len(p) else p
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array(bits.view(np.int64))], names=["slot", "bits"])

    words = hashes.select("h").mapInArrow(run, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(n, np.uint64)
    out[words.column("slot").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return Filter(out)


def rows_held(rows: DataFrame, column: str, held: Filter) -> DataFrame:
    """The rows whose hash in ``column`` the filter holds."""
    bits = rows.sparkSession.sparkContext.broadcast(held.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filter(bits.value)
        for b in batches:
            yield b.filter(pa.array(own.holds(b.column(column).to_numpy().view(np.uint64))))

    return rows.mapInArrow(run, rows.schema)
