"""Token-id files: canonical length-limited Huffman code, independent blocks, checkpoints.

``write_ids`` turns a table of id sequences into a folder of three Parquet tables:

``codebook``  ``id, bits``: the code length of every id that occurs. The code is canonical (codes
              of one length ascend with the id, longer codes follow shorter ones), so lengths are
              all a reader needs. Lengths come from the counts over all ids by package-merge and
              are at most ``MOST_BITS``.
``blocks``    ``part, block, first, n_ids, doc_ids, sizes, checkpoints, bits``: whole documents of
              at least ``BLOCK_IDS`` ids together (the last of a part: fewer), coded on their own.
              ``first``: ids of the same part before the block. ``checkpoints``: the bit
              offset of every ``STEP``-th id (unsigned 32-bit, 64-bit in blocks over 2^32 bits).
``parts``     ``part, base, n_ids``: ids of all parts before this one. Parts are ranges of the
              order (``doc_id`` ascending, nulls first, then the key ``tie``), one per task.

A reader takes any block alone. All lanes between checkpoints are decoded at once: each step
looks the next bits of every lane up in one table of ``2 ** longest`` entries. ``read_range``
prunes blocks by the statistics of ``first`` and starts at the checkpoint before the wanted id.

Spark writes, commits and reads the files, so any Hadoop path will do and a lost executor's
blocks are made again; the driver sees counts of ids (at most the vocabulary) only.

Results: a null or empty text is its closing id alone; repeated rows are stored each on its own
(equal ids are ordered by the text's hash; which of two equal rows is first does not show);
an empty table gives an empty folder that reads back as no rows; other columns are left out. A very
long text is one document in a block of its own.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeflow.llm.chunks import ChunkEncoder, split_before_space
from citeflow.llm.common import partitions_for, prepare, read, stored, text_blocks
from citeflow.session import scratch_path

#: the longest code: one look-up table of 2^18 entries decodes every id
MOST_BITS = 18
BLOCK_IDS = 1 << 16
STEP = 128
#: texts a task works on at a time
TEXT_BYTES = 2 << 20
#: ids of a part, so a task sorts and codes some tens of MB
PART_IDS = 32_000_000
BLOCKS = ("part int, block int, first long, n_ids long, doc_ids array<long>, sizes array<long>, "
          "checkpoints binary, bits binary")


def code_lengths(counts: np.ndarray, limit: int = MOST_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 where the count is 0."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    n = len(leaves)
    level, kinds = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        half = len(level) // 2
        packages = level[0:2 * half:2] + level[1:2 * half:2]
        merged = np.concatenate([leaves, packages])
        at = np.argsort(merged, kind="stable")
        level = merged[at]
        kinds.append(at < n)
    # the cheapest 2n - 2 items of the last level; its packages stand for pairs of the level before
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for kind in reversed(kinds):
        leaf = int(kind[:take].sum())
        lengths[:leaf] += 1
        take = 2 * (take - leaf)
    out[order] = lengths
    return out


class Codebook:
    """Codes of all ids, and the table that decodes them."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.longest = int(lengths.max()) if len(lengths) else 0
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        bits = self.lengths[order]
        # canonical: each code is the one before plus one, shifted to its own length
        spans = np.int64(1) << (self.longest - bits)
        starts = np.cumsum(spans) - spans
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = (starts >> (self.longest - bits)).astype(np.uint64)
        self.table = np.zeros(1 << self.longest, np.uint32)
        self.table[:int(spans.sum())] = np.repeat((order << 5 | bits).astype(np.uint32), spans)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of the ids, and the bit offset of every ``STEP``-th."""
        bits = self.lengths[ids]
        if not bits.all():
            raise ValueError("an id is not in the codebook")
        ends = np.cumsum(bits)
        starts = ends - bits
        word = starts >> 5
        shifted = self.codes[ids] << (64 - (starts & 31) - bits).astype(np.uint64)
        words = np.zeros(int(ends[-1] + 31) // 32 + 1 if len(ids) else 0, np.uint64)
        if len(ids):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            # bits of different ids never overlap, so sums are unions
            words[word[first]] = np.add.reduceat(shifted >> np.uint64(32), first)
            last = np.append(first[1:], len(ids)) - 1  # only the last id of a word reaches into the next
            words[word[last] + 1] += shifted[last] & np.uint64(0xFFFFFFFF)
        size = int(ends[-1] + 7) // 8 if len(ids) else 0
        return words.astype(">u4").tobytes()[:size], starts[::STEP]

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """``n`` ids from the first checkpoint on, all lanes between checkpoints at once."""
        raw = np.frombuffer(bits + b"\0" * 8, np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at, most = checkpoints.astype(np.int64), len(window) - 1
        out = np.empty((STEP, len(at)), np.uint32)
        drop = np.uint32(32 - self.longest)
        for k in range(min(STEP, n)):
            found = self.table[(window[np.minimum(at >> 3, most)] << (at & 7).astype(np.uint32)) >> drop]
            out[k] = found >> 5
            at = at + (found & 31)
        return out.T.reshape(-1)[:n]


def pack_checkpoints(at: np.ndarray) -> bytes:
    return at.astype("<u4" if not len(at) or at[-1] < 1 << 32 else "<u8").tobytes()


def unpack_checkpoints(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if len(raw) == 4 * -(-n // STEP) else "<u8")


#: ASCII letters, digits, other printable characters but the apostrophe (it may begin a contraction); 0: no cut there
CLASS = np.zeros(256, np.int8)
CLASS[33:127] = 3
CLASS[48:58] = 2
CLASS[[*range(65, 91), *range(97, 123)]] = 1
CLASS[39] = 0


def split_classes(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Chunks as ``split_before_space``, cut further between ASCII letters, digits and other characters, where the
    byte-level pre-tokenizer always cuts; blocks that may hold special tokens are not."""
    chunks, bounds = split_before_space(texts)
    buf = np.frombuffer(chunks.buffers()[2], np.uint8)
    if b"<|" in buf.tobytes():
        return chunks, bounds
    kind = CLASS[buf]
    first = np.zeros(len(buf), bool)
    first[1:] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    old = np.frombuffer(chunks.buffers()[1], np.int32)[:len(chunks) + 1]
    first[old[:-1]] = True
    starts = np.flatnonzero(first)
    offsets = np.append(starts, len(buf)).astype(np.int32)
    return (pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buf)]),
            np.searchsorted(starts, old[bounds]))


#: last bytes of white space outside ASCII
WIDE_ENDS = (b"\xc2\x85", b"\xc2\xa0")
WIDE_STARTS = (b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80")
JOINED = 256


def _joinable(chunk: bytes) -> bytes | None:
    """The chunk as it may stand after any other such chunk, with the pre-tokenizer cutting just before it (and
    after a line feed, where it has no white space of its own); ``None``: not so."""
    first, last = chunk[0], chunk[-1]
    if last < 33 or last > 126 and (chunk[-2:] in WIDE_ENDS or chunk[-3:-1] in WIDE_STARTS) or b"<|" in chunk:
        return None
    if first == 32 or 9 <= first <= 13:
        return chunk
    return b"\n" + chunk if 33 <= first <= 126 else None


_ENCODERS: dict[str, ChunkEncoder] = {}


def library_ids(path: str) -> ChunkEncoder:
    """Ids by the tokenizers library, each distinct chunk once per worker: new chunks go through it many
    together, and the bytes that each id stands for tell which are whose."""
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        vocabulary = tokenizer.get_vocab()
        sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            sizes[i] = len(token)  # a character for each byte
        feed = np.dtype("<u4").itemsize * len(tokenizer.encode("\n", add_special_tokens=False).ids)

        def each(texts: list[str]) -> list[bytes]:
            return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        def encode(chunks: list[bytes]) -> list[bytes]:
            out: list[bytes | None] = [None] * len(chunks)
            ready = [(i, r) for i, c in enumerate(chunks) if (r := _joinable(c)) is not None]
            groups = [ready[a:a + JOINED] for a in range(0, len(ready), JOINED)]
            for group, raw in zip(groups, each([b"".join(r for _, r in g).decode() for g in groups])):
                ends = np.cumsum(sizes[np.frombuffer(raw, "<u4")])
                want = np.cumsum([len(r) for _, r in group])
                at = np.searchsorted(ends, want)
                if at[-1] >= len(ends) or (ends[at] != want).any():
                    continue  # some id reaches over two chunks: one by one, below
                stops = (4 * (at + 1)).tolist()
                for (i, r), a, b in zip(group, [0, *stops], stops):
                    out[i] = raw[a + feed:b] if len(r) > len(chunks[i]) else raw[a:b]
            left = [i for i, o in enumerate(out) if o is None]
            for i, raw in zip(left, each([chunks[i].decode() for i in left])):
                out[i] = raw
            return out

        _ENCODERS[path] = ChunkEncoder(split_classes, encode, limit=600_000)
    return _ENCODERS[path]


def id_type(path: str) -> str:
    """The narrowest unsigned type that holds every id of a vocabulary file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    most = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    return "<u2" if most < 1 << 16 else "<u4"


def token_ids(docs: DataFrame, path: str, close_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, tie`` (the text's hash) ``, ids`` (binary: little-endian ids of ``id_type``,
    the closing id last)."""
    prepare(docs.sparkSession)
    kind = id_type(path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_ids(path)
        close = np.array([close_id], kind).tobytes()
        for batch in batches:
            for rows, texts in text_blocks(batch, "text", TEXT_BYTES):
                ids, bounds = encoder.ids(texts)
                raw = ids.astype(kind).tobytes()
                at = (bounds * np.dtype(kind).itemsize).tolist()
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[rows], batch.column("tie")[rows],
                    pa.array([raw[a:b] + close for a, b in zip(at, at[1:])], pa.binary())], ["doc_id", "tie", "ids"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    return rows.mapInArrow(work, "doc_id long, tie long, ids binary")


def id_counts(tokens: DataFrame, kind: str) -> np.ndarray:
    """How often each id occurs in all rows: tasks count densely, Spark sums per id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            some = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind))
            if len(some) > len(counts):
                counts, some = some.astype(np.int64), counts
            counts[:len(some)] += some
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts[found], pa.int64())], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(work, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def _code_blocks(lengths: np.ndarray, kind: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, part = Codebook(lengths), TaskContext.get().partitionId()
        block = first = size = 0
        docs: list[int | None] = []
        held: list[bytes] = []

        def coded() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), kind)
            bits, at = book.encode(ids)
            sizes = [len(h) // np.dtype(kind).itemsize for h in held]
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
                pa.array([len(ids)], pa.int64()), pa.array([docs], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                pa.array([pack_checkpoints(at)], pa.binary()), pa.array([bits], pa.binary()),
            ], ["part", "block", "first", "n_ids", "doc_ids", "sizes", "checkpoints", "bits"])

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                docs.append(doc)
                held.append(ids)
                size += len(ids) // np.dtype(kind).itemsize
                if size >= BLOCK_IDS:
                    yield coded()
                    block, first, size, docs, held = block + 1, first + size, 0, [], []
        if held:
            yield coded()

    return work


def write_ids(tokens: DataFrame, kind: str, path: str, part_ids: int = PART_IDS) -> str:
    """``tokens`` (``doc_id, tie, ids``; read several times, so a stored table) as the files
    described above, below ``path``."""
    spark = tokens.sparkSession
    counts = id_counts(tokens, kind)
    lengths = code_lengths(counts)
    found = np.flatnonzero(lengths).tolist()
    spark.createDataFrame([(i, int(lengths[i])) for i in found], "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    parts = partitions_for(spark, int(counts.sum()), part_ids)
    # rows of one id, or of none, may be many: equal rows are told apart so that ranges can split them
    keys = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc(), F.col("row").asc()]
    ordered = (tokens.withColumn("row", F.monotonically_increasing_id())
               .repartitionByRange(parts, *keys).sortWithinPartitions(*keys))
    ordered.select("doc_id", "ids").mapInArrow(_code_blocks(lengths, kind), BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    sums = (spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids")))
    # one row per part
    base = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums.select("part", F.coalesce(base, F.lit(0)).alias("base"), "n_ids").write.parquet(f"{path}/parts")
    return path


def _opened(spark: SparkSession, path: str) -> tuple[np.ndarray, DataFrame]:
    """The code lengths (a row per id of the vocabulary), and all blocks with ``base`` of their part."""
    rows = spark.read.schema("id int, bits int").parquet(f"{path}/codebook").collect()
    lengths = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.uint8)
    for r in rows:
        lengths[r["id"]] = r["bits"]
    parts = spark.read.schema("part int, base long, n_ids long").parquet(f"{path}/parts")
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return lengths, blocks.join(F.broadcast(parts.select("part", "base")), "part")  # a row per task of the writer


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids`` (array of int). With ``digest``
    the ids are not moved: ``ids_crc32`` of them as unsigned 32-bit integers comes instead."""
    prepare(spark)
    lengths, blocks = _opened(spark, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(lengths)
        for batch in batches:
            columns = (batch.column(c) for c in ("first", "base", "n_ids", "doc_ids", "sizes", "checkpoints", "bits"))
            for first, base, n, docs, sizes, at, bits in zip(*(c.to_pylist() for c in columns)):
                ids = book.decode(bits, unpack_checkpoints(at, n), n)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                if digest:
                    raw = ids.astype("<u4").tobytes()
                    last = pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(np.append(starts, n).astype(np.int32), ids.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), pa.array(base + first + starts, pa.int64()), pa.array(sizes, pa.int64()), last,
                ], ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    return blocks.mapInArrow(work, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>"))


def read_range(spark: SparkSession, path: str, lo: int, hi: int) -> DataFrame:
    """The ids at positions ``lo`` to ``hi - 1`` of the whole sequence, as ``position, ids`` runs:
    only blocks that hold some are read, and each is decoded from the checkpoint before the first."""
    prepare(spark)
    lengths, blocks = _opened(spark, path)
    begin = F.col("base") + F.col("first")
    wanted = blocks.where((begin < hi) & (begin + F.col("n_ids") > lo))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(lengths)
        for batch in batches:
            for first, base, n, at, bits in zip(*(batch.column(c).to_pylist() for c in ("first", "base", "n_ids", "checkpoints", "bits"))):
                a, b = max(lo - base - first, 0), min(hi - base - first, n)
                lanes = slice(a // STEP, -(-b // STEP))
                from_id = lanes.start * STEP
                ids = book.decode(bits, unpack_checkpoints(at, n)[lanes], min(lanes.stop * STEP, n) - from_id)
                yield pa.RecordBatch.from_arrays([pa.array([base + first + a], pa.int64()),
                                                  pa.array([ids[a - from_id:b - from_id].tolist()], pa.list_(pa.int32()))], ["position", "ids"])

    return wanted.mapInArrow(work, "position long, ids array<int>")


def op13_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the 50k byte-level vocabulary, written and read back."""
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    tokens = stored(token_ids(read(spark, sf_dir, "documents"), vocabulary), "ids")
    return read_ids(spark, write_ids(tokens, id_type(vocabulary), scratch_path(spark, "llm-id-files")), digest=True)
