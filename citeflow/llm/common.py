"""Shared helpers of the ``llm`` subpackage: scratch tables, bounded text blocks,
vectorised tokens and hashes over the bytes of many texts at once.

Texts reach Python as Arrow batches (``spark.sql.execution.arrow.maxBytesPerBatch``
bounds them) and are worked on in blocks of at most ``BLOCK_BYTES`` (or one text, if it
is longer), so the memory of a task does not grow with its partition.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.session import ensure_checkpoint_dir, scratch_path

BLOCK_BYTES = 4 << 20
ARROW_BYTES = 8 << 20

U64 = np.uint64
_RNG = np.random.default_rng(20240607)
#: a random 64-bit value per byte; ``LOWER`` gives A-Z those of a-z
BYTE_HASH = _RNG.integers(0, 2**64, 256, dtype=U64)
LOWER_HASH = BYTE_HASH.copy()
LOWER_HASH[65:91] = BYTE_HASH[97:123]
BASE = 0x9E3779B97F4A7C13
BASE_INV = pow(BASE, -1, 2**64)
#: x20 and x09-x0D
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS: dict[int, np.ndarray] = {}


_READY: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Once per application: where the Python workers cannot import this package (the application
    was started without it), its functions travel with their code instead of by name."""
    app = spark.sparkContext.applicationId
    if app in _READY:
        return

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import importlib.util

        import pyarrow

        for batch in batches:
            there = importlib.util.find_spec("citeflow") is not None
            yield pyarrow.RecordBatch.from_arrays([pyarrow.array([there] * batch.num_rows)], ["there"])

    if not spark.range(1).mapInArrow(look, "there boolean").first()[0]:
        cloudpickle.register_pickle_by_value(sys.modules["citeflow"])
    _READY.add(app)


def bound_batches(spark: SparkSession) -> None:
    """Python tasks see at most ``ARROW_BYTES`` (or one row) of a table at a time."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > ARROW_BYTES:
        spark.conf.set(key, str(ARROW_BYTES))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back: what follows
    does not repeat the work, and an executor that is lost takes nothing with it."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    bound_batches(spark)
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    if Scratch.open:
        Scratch.open[-1].tables.append(back)
    return back


def release(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` returned, once their last readers have been written. Shuffle files
    of the jobs that are done go when the driver's JVM collects their plans, so it is asked to."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        spark._jvm.System.gc()


class Scratch:
    """``with Scratch() as scratch``: at its end, what ``stored`` wrote inside is deleted, but for the tables
    given to ``scratch.keep``, which the result still reads."""

    open: list[Scratch] = []

    def __enter__(self) -> Scratch:
        self.tables: list[DataFrame] = []
        Scratch.open.append(self)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self.tables = [t for t in self.tables if t is not df]
        if len(Scratch.open) > 1:
            Scratch.open[-2].tables.append(df)  # the caller's, if it has a scope of its own
        return df

    def __exit__(self, *_) -> None:
        Scratch.open.remove(self)
        release(*self.tables)


def least_hashed(df: DataFrame, key: str, n: int, total: int) -> DataFrame:
    """The ``n`` rows of ``df`` (``total`` rows) with the least hash of ``key``. Rows that cannot be among
    them are left out first, so the final merge sees little more than ``n``."""
    share = F.pmod(F.xxhash64(key), F.lit(1 << 31)) / float(1 << 31)
    margin = 1.3 + 40 / max(n, 1)
    return df.where(share < margin * n / max(total, 1)).orderBy(share, key).limit(n)


def partitions_for(spark: SparkSession, rows: int, per_task: int) -> int:
    """Shuffle partitions for ``rows``: at least the session's, else ``per_task`` rows each."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, U64)
        have[0] = 1
        _POWERS[base] = have = np.cumprod(have, dtype=U64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64-bit values."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def text_blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[slice, list[bytes]]]:
    """Row ranges of a batch with the UTF-8 bytes of their texts (null: empty)."""
    texts = batch.column(column).cast(pa.binary()).to_pylist()
    start = size = 0
    for i, t in enumerate(texts):
        if t is None:
            texts[i] = t = b""
        if size and size + len(t) > limit:
            yield slice(start, i), texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts)), texts[start:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of all texts, A-Z lower-cased: their 64-bit hashes,
    the word range of each text (``bounds[i]:bounds[i + 1]``), and where each word stands
    (start, end) in the returned joined bytes."""
    raw = b"\n".join(texts)
    buf = np.frombuffer(raw, np.uint8)
    n = len(buf)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    at = np.concatenate([[0], np.cumsum(sizes)])
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, U64), np.zeros(len(texts) + 1, np.int64), none, none, buf
    word = np.empty(n + 2, np.int8)
    word[0] = word[-1] = 0
    word[1:-1] = ~SPACE[buf]
    step = np.diff(word)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    hashes = np.empty(len(starts), U64)
    lo = 0
    while lo < len(starts):  # very long texts in segments of whole words
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + (8 << 20), "right")))
        a, b = int(starts[lo]), int(ends[hi - 1])
        sums = np.zeros(b - a + 1, U64)
        np.cumsum(LOWER_HASH[buf[a:b]] * powers(BASE, b - a), out=sums[1:])
        s = starts[lo:hi] - a
        hashes[lo:hi] = (sums[ends[lo:hi] - a] - sums[s]) * powers(BASE_INV, b - a + 1)[s]
        lo = hi
    return mix(hashes + (ends - starts).astype(U64)), np.searchsorted(starts, at), starts, ends, buf


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words of each text as (text index, 64-bit hash), sorted
    by both; a text with fewer words has its whole sequence as one, one without words none."""
    counts = np.diff(bounds)
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    rolled = np.zeros(n, U64)
    weights = powers(0xD6E8FEB86659FD93 | 3, size)
    owner = np.repeat(np.arange(len(counts)), counts)
    left = bounds[1:][owner] - np.arange(n)  # words from here to the text's end
    for j in range(min(size, n)):
        part = words[j:] * weights[j]
        rolled[: n - j] += np.where(left[: n - j] > j, part, U64(0))
    full = np.minimum(counts, size)[owner]
    keep = (left >= size) | ((counts[owner] < size) & (left == counts[owner]))
    values = mix(rolled[keep] + full[keep].astype(U64))
    who = owner[keep]
    order = np.lexsort((values, who))
    who, values = who[order], values[order]
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (values[1:] != values[:-1])
    return who[new], values[new]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + counts[i] - 1`` for every i, one after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def document_columns(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so others may have any name."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
