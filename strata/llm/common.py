"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.scratch import scratch_dir

#: What separates words, in UTF-8 texts (space, and tab to carriage return).
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
WORD = re.compile(WORD_PATTERN)

#: Letters of a word or number, or one other visible character; for classifiers.
TOKEN = re.compile(r"\w+|[^\w\s]")

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that classifiers never learn from."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % 3
    return F.coalesce(fold == 1, F.lit(False))


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again; cuts the lineage."""
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the splitmix64 finaliser)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hash(word: str | bytes) -> int:
    """64 bits of a word, the same in every process."""
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


class WordHashes(dict):
    """Hashes of words, remembered up to a bound."""

    LIMIT = 150_000

    def __missing__(self, word: str | bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = word_hash(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: Rows and bytes of a small batch.
ROWS, BYTES = 512, 2 * 1024 * 1024


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow``, with ``ROWS`` rows a batch: Spark's 10,000 long texts would fill a worker."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(setting)) <= ROWS:
        df.sparkSession.conf.set(setting, str(ROWS))
    return df.mapInArrow(run, schema)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ROWS, size: int = BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` rows and ``size`` bytes at most, but for single long rows."""
    waiting, held, weight = [], 0, 0
    for batch in batches:
        for part in _split(batch, rows, size):
            if waiting and (held + part.num_rows > rows or weight + part.nbytes > size):
                yield _joined(waiting)
                waiting, held, weight = [], 0, 0
            waiting.append(part)
            held, weight = held + part.num_rows, weight + part.nbytes
    if waiting:
        yield _joined(waiting)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _split(batch: pa.RecordBatch, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``rows`` rows and, but for single rows, ``size`` bytes."""
    if batch.nbytes <= size and 0 < batch.num_rows <= rows:
        yield batch
        return
    ends = np.cumsum(sum((_lengths(c) for c in batch.columns), np.zeros(batch.num_rows, np.int64)))
    at, before = 0, 0
    while at < batch.num_rows:
        end = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + size, "right"))))
        yield batch.slice(at, end - at)
        at, before = end, int(ends[end - 1])


def _lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each value of a text or binary column, about those of a list, 8 of others."""
    kind, size = column.type, None
    if pa.types.is_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_string(kind) or pa.types.is_large_binary(kind):
        size = pc.binary_length(column)
    elif pa.types.is_list(kind) or pa.types.is_large_list(kind):
        size = pc.multiply(pc.list_value_length(column), 8)
    if size is None:
        return np.full(len(column), 8, np.int64)
    return pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def map_rows(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str | StructType,
    rows: int = ROWS,
    size: int = BYTES,
) -> DataFrame:
    """``function`` on small Arrow batches of every partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, rows, size):
            out = function(batch)
            if out is not None and out.num_rows:
                yield out

    return map_batches(df, run, schema)
