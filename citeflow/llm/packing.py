"""Best-fit packing of token sequences by linear grouping.

The pieces of all documents are known by their lengths alone, 1 to ``capacity``, so a
histogram of at most ``capacity`` rows describes the whole problem whatever the input:

1. Large lengths (over a share of the capacity) are sorted downwards and cut into groups
   of equal cardinality; each is rounded up to the largest of its group.
2. For the few rounded sizes, configurations (which sizes share a sequence) are optimised
   by repeatedly taking the fullest configuration as often as the remaining counts allow.
3. The documents of each group take the slots of its size; what rounding left free in each
   sequence is known exactly.
4. Small lengths go, largest first, to the fullest open sequence that still holds them.

Steps 2 to 4 work on runs (so many equal sequences), not on documents; the runs are a few
per length. The runs say, for every length, which sequence its r-th piece goes to. Spark
numbers the pieces of each length (in salted sub-groups, as one length may hold most of
the rows) and joins them with the runs.

Results: a null or empty text is its closing id alone; repeated rows are packed each on its
own; documents longer than the capacity are cut into full pieces, the last may be shorter;
an empty input gives no rows; other columns are left out.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeflow.llm.chunks import ChunkEncoder, split_words
from citeflow.llm.common import document_columns, partitions_for, read, stored, text_blocks

CAPACITY = 2048
#: the plan is made for each number of groups and each border of the small lengths; the best counts
GROUPS = (24, 96)
SMALL_SHARES = (2, 3, 4, 6, 12)
#: bytes of text that a task works on at a time
BLOCK = 2 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_ENCODERS: dict[str, ChunkEncoder] = {}


def library_encoder(path: str) -> ChunkEncoder:
    """Ids by the tokenizers library, each distinct word once per worker."""
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def encode(runs: list[bytes]) -> list[bytes]:
            found = tokenizer.encode_batch_fast([r.decode() for r in runs], add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() for e in found]

        _ENCODERS[path] = ChunkEncoder(split_words, encode, limit=400_000)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, close_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``doc_id, piece, start, length, ids_crc32``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path)
        for batch in batches:
            for rows, texts in text_blocks(batch, "text", BLOCK):
                ids, bounds = encoder.ids(texts)
                at = bounds.tolist()
                owner, piece, start, length, crc = [], [], [], [], []
                for i in range(len(texts)):
                    own = np.append(ids[at[i]:at[i + 1]], np.uint32(close_id)).astype("<u4")
                    for k, a in enumerate(range(0, len(own), capacity)):
                        cut = own[a:a + capacity]
                        owner.append(i)
                        piece.append(k)
                        start.append(a)
                        length.append(len(cut))
                        crc.append(zlib.crc32(cut.tobytes()))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[rows].take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return document_columns(docs, id_col, text_col).mapInArrow(work, PIECES)


def _linear_groups(counts: np.ndarray, floor: int, groups: int) -> list[list[list[int]]]:
    """Groups of nearly equal cardinality, from the largest length down: lists of [length, count].
    A length may lie in two groups; a group of one length needs no rounding."""
    lengths = [[n, int(counts[n])] for n in range(len(counts) - 1, floor, -1) if counts[n]]
    size = -(-sum(c for _, c in lengths) // groups) if lengths else 0
    out: list[list[list[int]]] = []
    room = 0
    for n, c in lengths:
        while c:
            if not room:
                out.append([])
                room = size
            take = min(c, room)
            out[-1].append([n, take])
            c -= take
            room -= take
    return out


def _fullest(sizes: list[int], left: list[int], capacity: int) -> list[int]:
    """How many of each size to take so that a sequence is as full as it can be (bounded by
    what is left), by a table over the capacity; larger sizes are preferred among equals."""
    first = next(i for i, c in enumerate(left) if c)  # the largest size left is always taken
    via = {sizes[first]: None}
    for i in range(first, len(sizes)):
        most = min(left[i] - (i == first), capacity // sizes[i])
        layer = dict.fromkeys(via, 0)
        for _ in range(most):
            grown = {}
            for used, times in layer.items():
                if used + sizes[i] <= capacity and used + sizes[i] not in via:
                    grown[used + sizes[i]] = (i, used)
            if not grown:
                break
            via |= grown
            layer = dict.fromkeys(grown, 0)
    take = [0] * len(sizes)
    take[first] = 1
    used = max(via)
    while via[used] is not None:
        i, used = via[used]
        take[i] += 1
    return take


Runs = list[tuple[int, int, int, int]]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Runs:
    """The runs of ``plan_one`` with the fewest sequences over ``GROUPS`` and ``SMALL_SHARES``."""
    made = [plan_one(counts, capacity, g, s) for s in SMALL_SHARES for g in GROUPS]
    return min(made, key=lambda runs: max((first + n for _, first, n, _ in runs), default=0))


def plan_one(counts: np.ndarray, capacity: int, groups: int, small_share: int) -> Runs:
    """Runs ``(length, first sequence, sequences, offset)``: each of the ``sequences`` from the
    first on holds one piece of that length at that offset. ``counts[n]``: pieces of length n.
    Its size and its time depend on the capacity and the number of groups only."""
    floor = capacity // small_share
    grouped = _linear_groups(counts, floor, groups)
    sizes = [g[0][0] for g in grouped]
    left = [sum(c for _, c in g) for g in grouped]
    runs: list[tuple[int, int, int, int]] = []
    #: open runs of sequences by tokens used: used -> list of [first sequence, sequences]
    room: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    sequence = 0
    while any(left):
        take = _fullest(sizes, left, capacity)
        times = min(n // t for n, t in zip(left, take) if t)
        # substitute documents: every slot takes the next documents of its group
        open_runs = [[sequence, times, 0]]
        sequence += times
        for i, t in enumerate(take):
            left[i] -= times * t
            for _ in range(t):
                filled = []
                for at, n, used in open_runs:
                    while n:
                        length, have = grouped[i][0]
                        m = min(n, have)
                        runs.append((length, at, m, used))
                        filled.append([at, m, used + length])
                        at += m
                        n -= m
                        grouped[i][0][1] -= m
                        if not grouped[i][0][1]:
                            grouped[i].pop(0)
                open_runs = filled
        for at, n, used in open_runs:
            room[used].append([at, n])
    used_now = [u for u in range(capacity + 1) if room[u]]
    for length in range(min(floor, len(counts) - 1), 0, -1):
        todo = int(counts[length])
        while todo:
            k = bisect.bisect_right(used_now, capacity - length) - 1
            if k < 0:  # nothing holds it: new sequences of this length alone, filled up by the smaller ones
                each = capacity // length
                new = max(1, todo // each)
                per = min(each, todo)
                for j in range(per):
                    runs.append((length, sequence, new, j * length))
                todo -= new * per
                target, entry = per * length, [sequence, new]
                sequence += new
            else:
                u = used_now[k]
                at, n = room[u].pop()
                m = min(n, todo)
                if m < n:
                    room[u].append([at + m, n - m])
                if not room[u]:
                    used_now.pop(k)
                runs.append((length, at, m, u))
                todo -= m
                target, entry = u + length, [at, m]
            if not room[target]:
                bisect.insort(used_now, target)
            room[target].append(entry)
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY, planner: Callable[[np.ndarray, int], Runs] = plan) -> DataFrame:
    """``pieces`` (with ``doc_id, piece, length`` from 1 to ``capacity``) with ``sequence_id`` and
    ``offset``. The driver sees the histogram of lengths (at most ``capacity`` rows)."""
    spark = pieces.sparkSession
    salts = partitions_for(spark, 256, 1)
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(salts)).cast("int"))
    spread = stored(pieces.groupBy("length", "salt").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for r in spread.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    runs = planner(counts, capacity)
    # the r-th piece of a length belongs to the run that covers rank r
    starts: dict[int, int] = {}
    rows = []
    for length, first, n, offset in runs:
        rank = starts.get(length, 0)
        rows.append((length, rank, rank + n, first - rank, offset))
        starts[length] = rank + n
    slots = spark.createDataFrame(rows, "length long, rank_from long, rank_to long, shift long, offset long")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = spread.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = (pieces.withColumn("row", F.row_number().over(within) - 1)
                .join(bases.drop("n"), ["length", "salt"])
                .withColumn("rank", F.col("base") + F.col("row")))
    # runs of one length follow one another: each (length, salt) keeps those that its ranks meet
    met = (bases.join(F.broadcast(slots), "length")  # at most a few runs per length
           .where((F.col("rank_from") < F.col("base") + F.col("n")) & (F.col("rank_to") > F.col("base")))
           .groupBy("length", "salt")
           .agg(F.array_sort(F.collect_list(F.struct("rank_from", "rank_to", "shift", "offset"))).alias("runs")))
    hit = F.filter("runs", lambda r: (r["rank_from"] <= F.col("rank")) & (F.col("rank") < r["rank_to"]))[0]
    return (numbered.join(met, ["length", "salt"])
            .withColumn("run", hit)
            .withColumn("sequence_id", F.col("run.shift") + F.col("rank"))
            .withColumn("offset", F.col("run.offset"))
            .drop("salt", "row", "base", "rank", "runs", "run"))


def packed_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Whole documents to packed pieces: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    pieces = stored(token_pieces(docs, path, capacity), "pieces")
    return pack(pieces, capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, in 2048-token sequences of the 49k word vocabulary."""
    import public_tokenizers

    return packed_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
