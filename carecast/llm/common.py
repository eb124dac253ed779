"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

__all__ = ["materialize", "map_texts", "read", "text_column", "text_slices", "fingerprint128", "CHUNK_CHARS"]

#: Texts handed to one numpy pass together, in characters; bounds a task's working memory.
CHUNK_CHARS = 500_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_column(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fingerprint128(*cols: Column) -> list[Column]:
    """Two 64-bit hashes with different seeds: equality of both stands for equality of the value."""
    return [F.xxhash64(F.lit(101), *cols), F.xxhash64(F.lit(202), *cols)]


def text_ranges(sizes: np.ndarray, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of these sizes that hold about ``limit`` together (a longer text stands alone)."""
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, side="right")))
        yield start, stop
        start = stop


def text_slices(column: pa.Array, limit: int = CHUNK_CHARS) -> Iterator[tuple[slice, list[str]]]:
    """Consecutive slices of a text column of about ``limit`` bytes, and their texts; only these are Python objects at a time."""
    for start, stop in text_ranges(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), limit):
        yield slice(start, stop), column.slice(start, stop - start).to_pylist()


def map_texts(df: DataFrame, fn: Callable[[list], pd.DataFrame], schema: str) -> DataFrame:
    """The columns of ``df`` but text, followed by what ``fn`` makes of the texts, row by row.

    Runs on Arrow batches, so the other columns pass through unchanged (a
    null doc_id beside 64-bit ones stays exact). ``fn`` sees about
    ``CHUNK_CHARS`` characters at a time.
    """
    keep = [c for c in df.columns if c != "text"]
    head = ", ".join(f"`{n}` {t}" for n, t in df.select(*keep).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, texts in text_slices(b.column("text")):
                out = pa.RecordBatch.from_pandas(fn(texts), preserve_index=False)
                n = part.stop - part.start
                columns = [b.column(c).slice(part.start, n) for c in keep] + out.columns
                yield pa.RecordBatch.from_arrays(columns, names=keep + out.schema.names)

    return df.mapInArrow(run, f"{head}, {schema}" if head else schema)
