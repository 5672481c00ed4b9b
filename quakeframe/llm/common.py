"""What several operators use: tables in the shared folder, Arrow mapping, words and shingles as arrays."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quakeframe.session import work_dir

SHINGLE_WORDS = 5


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back, which cuts the lineage."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A name that no column of ``df`` has, in upper or lower case."""
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return name


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[tuple]], schema: str | StructType, block: int = 512) -> DataFrame:
    """``mapInArrow`` for a function from an iterator of columns (lists by name) to tuples of output columns.

    Batches are cut into blocks of ``block`` rows and, where they have a ``text``, of 8 MB of it (or a single
    longer one), so that the Python values of a block are bounded. At its end a task gives back what it no
    longer needs: the process serves other stages.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema
    out = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns() -> Iterator[dict]:
            for batch in batches:
                for at in range(0, batch.num_rows, block):
                    part = batch.slice(at, block)
                    texts = "text" in part.schema.names and pa.types.is_string(part.schema.field("text").type)
                    for cut in byte_blocks([part], "text") if texts else [part]:
                        yield dict(zip(cut.schema.names, cut.columns))

        try:
            for result in rows(columns()):
                arrays = [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(result, out)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)
        finally:
            give_back()

    return df.mapInArrow(run, fields)


def give_back() -> None:
    """Returns free memory of this process to the system, which an idle Python worker would keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


def byte_blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that the values of ``column`` in one block have ``limit`` bytes at most, or are a single one."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def shards(spark: SparkSession, each: int = 16) -> int:
    """Into how many groups to deal counts that are merged group by group: ``each`` for a shuffle partition."""
    return each * int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_number(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are not greater than ``key``; looks at every 64th first."""
    coarse = F.array(*map(F.lit, bounds[63::64])) if len(bounds) >= 64 else None
    passed = F.size(F.filter(coarse, lambda b: b <= key)) if coarse is not None else F.lit(0)
    fine = F.slice(F.array(*map(F.lit, bounds)), passed * 64 + 1, F.lit(64)) if bounds else F.array().cast("array<bigint>")
    return passed * 64 + F.size(F.filter(fine, lambda b: b <= key))


def id_bounds(docs: DataFrame, key: Column, ranges: int) -> list[int]:
    """The distinct ids at which ranges of about equally many rows begin, the smallest id first.

    One value per range; only the ids are read. An empty table has none.
    """
    at = [i / ranges for i in range(ranges)]
    row = docs.agg(F.min(key).alias("least"), F.percentile_approx(key, at, max(10_000, 20 * ranges)).alias("b")).first()
    return sorted({row["least"], *row["b"]}) if row["least"] is not None else []


def ordered_ranges(spark: SparkSession, rows: int, per_range: int) -> int:
    """Ranges for a table in id order: as many as shuffles have partitions, more if they grow too large."""
    return max(1, min(rows, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_range))))


# ---------------------------------------------------------------------------- hashing of words

_U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits depend on all input bits (splitmix64)."""
    x = x + _U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_BYTE = mix(np.arange(1, 257, dtype=_U64))
_WORD_BYTE = np.ones(256, dtype=bool)
_WORD_BYTE[[9, 10, 11, 12, 13, 32]] = False
_PLACE = mix(np.arange(1 << 32, (1 << 32) + 64, dtype=_U64)) | _U64(1)
_OFFSET = mix(np.arange(1 << 40, (1 << 40) + SHINGLE_WORDS, dtype=_U64)) | _U64(1)


def _places(length: int) -> np.ndarray:
    """A random odd factor for each place in a word."""
    global _PLACE
    if length > len(_PLACE):
        _PLACE = mix(np.arange(1 << 32, (1 << 32) + 2 * length, dtype=_U64)) | _U64(1)
    return _PLACE


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words (runs of bytes that aren't ASCII white space), in order."""
    raw = np.frombuffer(data, dtype=np.uint8)
    word = _WORD_BYTE[raw]
    padded = np.zeros(len(raw) + 2, dtype=np.int8)
    padded[1:-1] = word
    edges = np.flatnonzero(np.diff(padded))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, dtype=_U64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    terms = _BYTE[raw[word]] * _places(int(lengths.max()))[place]
    return mix(np.add.reduceat(terms, first) + lengths.astype(_U64))


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words; of fewer words, one hash of all; of none, none."""
    n = len(words)
    if not n:
        return words
    runs = max(1, n - SHINGLE_WORDS + 1)
    total = np.full(runs, min(n, SHINGLE_WORDS), dtype=_U64)
    for j in range(min(n, SHINGLE_WORDS)):
        total += words[j : j + runs] * _OFFSET[j]
    return mix(total)
