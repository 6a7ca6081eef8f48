"""Brown class-based n-grams: exchange clustering, class transitions, word emissions.

    P(w | v) = P(class(w) | class(v)) * P(w | class(w))

1. Texts become blocks once: the distinct words of about ``BLOCK`` bytes of text, and the
   texts as positions in that list. Everything later reads the blocks.
2. Words are counted over all training texts: each block sends its distinct words to hash
   buckets, where they are summed.
3. The ``FREQUENT`` most frequent words are clustered by exchange: all their bigrams that occur are counted;
   in each sweep every word is moved to the class with the largest gain of the class-bigram
   likelihood, half of the words a sweep, so that neighbours do not move at once.
4. Every other word joins a class by its contexts: each occurrence votes for the class that the
   classes to its left and right make most probable. So all words of the corpus have one.
5. Class transitions and emissions are counted over all training tokens, and texts are scored.

Smoothing: transitions are add-a-half; a class gives words that it has not seen the mass of its
words seen once; all of it is interpolated with the unigram model, which does the same. The
probabilities of the known words, of the end, and of one unknown word add up to 1.

Results: a null or empty text is its end alone; repeated rows count as often as they stand;
rows with a null id are held out of nothing (they train) ; with no training text every word
is unknown; an empty input gives no rows; other columns are left out. Words are told by
64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.llm.common import U64, document_columns, partitions_for, read, stored, text_blocks, word_hashes

CLASSES = 64
FREQUENT = 4096
SWEEPS = 8
WEIGHT = 0.9
HELD_OUT = (7, 2)
BLOCK = 4 << 20
#: cells of bigrams that a task holds before it sends them on
CELLS = 1 << 20
#: stands for the end of a text among the word hashes
END = U64(0x0E0D0E0D0E0D0E0D)
#: context classes beyond the words' own: any word that is not frequent, and the end
OTHER, STOP = CLASSES, CLASSES + 1


def _shrink(x: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(x.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _grow(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, ids, held, sizes`` (of the texts, tokens with the end), ``words`` (distinct hashes by
    falling count), ``counts`` (in training texts), ``tokens`` (positions in ``words``)."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for rows, texts in text_blocks(batch, "text", BLOCK):
            hashes, sizes = [], []
            for _, part in text_blocks(pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"]), "text", BLOCK // 2):
                words, bounds, *_ = word_hashes(part)
                n = np.diff(bounds)
                ends = np.cumsum(n + 1) - 1
                joined = np.empty(len(words) + len(part), U64)
                at_end = np.zeros(len(joined), bool)
                at_end[ends] = True
                joined[at_end] = END
                joined[~at_end] = words
                hashes.append(joined)
                sizes.append(n + 1)
            hashes, sizes = np.concatenate(hashes), np.concatenate(sizes)
            ids = batch.column("doc_id")[rows]
            modulus, held_rest = HELD_OUT
            held = np.array([i is not None and zlib.crc32(str(i).encode()) % modulus == held_rest for i in ids.to_pylist()])
            words, inverse = np.unique(hashes, return_inverse=True)
            train = ~np.repeat(held, sizes)
            counts = np.bincount(inverse[train], minlength=len(words))
            order = np.argsort(-counts, kind="stable")
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            number += 1
            yield pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                pa.array([held.tolist()], pa.list_(pa.bool_())), pa.array([sizes.tolist()], pa.list_(pa.int64())),
                pa.array([words[order].tobytes()], pa.binary()), pa.array([counts[order].astype("<u4").tobytes()], pa.binary()),
                pa.array([_shrink(place[inverse])], pa.binary()),
            ], ["block", "ids", "held", "sizes", "words", "counts", "tokens"])


BLOCKS = "block long, ids array<long>, held array<boolean>, sizes array<long>, words binary, counts binary, tokens binary"


def _bucket_of(words: np.ndarray, buckets: int) -> np.ndarray:
    return ((words >> U64(20)) % U64(buckets)).astype(np.int64)


def _scatter(buckets: int):
    """Words and training counts of each block by bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, w, c in zip(*(batch.column(k).to_pylist() for k in ("block", "words", "counts"))):
                words, counts = np.frombuffer(w, U64), np.frombuffer(c, "<u4")
                seen = counts > 0
                words, counts = words[seen], counts[seen]
                bucket = _bucket_of(words, buckets)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
                parts = [order[a:b] for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(buckets), pa.int64()), pa.array([words[p].tobytes() for p in parts], pa.binary()),
                    pa.array([counts[p].tobytes() for p in parts], pa.binary())], ["bucket", "words", "counts"])

    return work


def _top_words(most: int):
    """Of each task: the sums over its words (``word`` null) and its ``most`` most frequent words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, c = [], []
        for batch in batches:
            w += [np.frombuffer(b, U64) for b in batch.column("words").to_pylist()]
            c += [np.frombuffer(b, "<u4") for b in batch.column("counts").to_pylist()]
        if not w:
            return
        words, inverse = np.unique(np.concatenate(w), return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate(c), minlength=len(words)).astype(np.int64)
        top = np.lexsort((words, -counts))[:most]
        yield pa.RecordBatch.from_arrays([
            pa.array([None, *words[top].view(np.int64).tolist()], pa.int64()), pa.array([int(counts.sum()), *counts[top].tolist()], pa.int64()),
            pa.array([len(words)] + [0] * len(top), pa.int64()), pa.array([int((counts == 1).sum())] + [0] * len(top), pa.int64()),
        ], ["word", "n", "kinds", "once"])

    return work


class _Frequent:
    """The frequent words as numbers from 1; the end is the last, 0 is any other word."""

    def __init__(self, words: np.ndarray):
        self.sorted = np.sort(words)
        self.stop = len(words) + 1

    def __call__(self, words: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return np.where(words == END, self.stop, 0)
        at = np.minimum(np.searchsorted(self.sorted, words), len(self.sorted) - 1)
        return np.where(words == END, self.stop, np.where(self.sorted[at] == words, at + 1, 0))


def _summed(cells: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells, sorted, and the sums of their counts."""
    cells, counts = np.concatenate(cells), np.concatenate(counts)
    order = np.argsort(cells, kind="stable")
    cells, counts = cells[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, np.int64)
    return cells[first], np.add.reduceat(counts, first) if len(first) else counts


def _pairs(table, buckets: int):
    """Bigram counts of the frequent words (and 0 and the end) in the training texts of a task. Only
    cells that occur are held, about ``CELLS`` at a time; what is sent twice is summed behind."""

    def send(cells: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        bucket = cells % buckets
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
        parts = [order[a:b] for a, b in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays([
            pa.array(range(buckets), pa.int64()), pa.array([cells[p].astype("<i4").tobytes() for p in parts], pa.binary()),
            pa.array([counts[p].astype("<i8").tobytes() for p in parts], pa.binary())], ["bucket", "cells", "counts"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = table.value
        width = frequent.stop + 1
        held_cells, held_counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for w, t, held, sizes in zip(*(batch.column(k).to_pylist() for k in ("words", "tokens", "held", "sizes"))):
                ids = frequent(np.frombuffer(w, U64))[_grow(t)]
                before = np.concatenate([[frequent.stop], ids[:-1]])
                train = ~np.repeat(np.array(held, bool), sizes)
                cells, counts = np.unique((before * width + ids)[train], return_counts=True)
                held_cells, held_counts = _summed([held_cells, cells], [held_counts, counts])
                if len(held_cells) > CELLS:
                    yield send(held_cells, held_counts)
                    held_cells, held_counts = held_cells[:0].copy(), held_counts[:0].copy()
        if len(held_cells):
            yield send(held_cells, held_counts)

    return work


def _sum_pairs(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, n = [], []
        for batch in batches:
            x += [np.frombuffer(b, "<i4") for b in batch.column("cells").to_pylist()]
            n += [np.frombuffer(b, "<i8") for b in batch.column("counts").to_pylist()]
        if not x:
            return
        cells, counts = _summed(x, n)
        for a in range(0, len(cells), 500_000):
            c = cells[a:a + 500_000]
            yield pa.RecordBatch.from_arrays([pa.array(c // width, pa.int32()), pa.array(c % width, pa.int32()),
                                              pa.array(counts[a:a + 500_000])], ["v", "w", "n"])

    return work


def _plogp(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def _exchange(classes: np.ndarray, joint: np.ndarray, sweep: int):
    """The best class of each word, from its counts with the classes to its right and left."""
    size = joint.sum(axis=1)[:CLASSES]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            best = []
            for word, cells in zip(frame["word"], frame["cells"]):
                now = int(classes[word])
                right, left = np.zeros(CLASSES + 2), np.zeros(CLASSES + 2)
                for cell in cells:
                    (right if cell["side"] else left)[cell["other"]] = cell["n"]
                if (word + sweep) % 2:
                    best.append(now)
                    continue
                rows, columns, sizes = joint[:CLASSES].copy(), joint[:, :CLASSES].T.copy(), size.copy()
                rows[now] = np.maximum(rows[now] - right, 0)  # without the word itself
                columns[now] = np.maximum(columns[now] - left, 0)
                n = right.sum()
                sizes[now] -= n
                gain = ((_plogp(rows + right) - _plogp(rows)).sum(axis=1) + (_plogp(columns + left) - _plogp(columns)).sum(axis=1)
                        - 2 * (_plogp(sizes + n) - _plogp(sizes)))
                best.append(int(np.argmax(gain)))
            yield pd.DataFrame({"word": frame["word"], "best": best})

    return work


def exchange_classes(pairs: DataFrame, n_words: int, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """Class of each frequent word number (0: OTHER, the last: STOP), and the joint counts of
    classes (a row: the one before). The driver sees a class per frequent word."""
    spark = pairs.sparkSession
    classes = np.concatenate([[OTHER], np.arange(n_words) % CLASSES, [STOP]]).astype(np.int64)

    def with_classes() -> DataFrame:
        table = spark.createDataFrame([(i, int(c)) for i, c in enumerate(classes)], "id int, c int")
        return (pairs.join(F.broadcast(table.toDF("v", "cv")), "v")  # n_words + 2 rows
                .join(F.broadcast(table.toDF("w", "cw")), "w"))

    def joint_counts(df: DataFrame) -> np.ndarray:
        joint = np.zeros((CLASSES + 2, CLASSES + 2))
        for r in df.groupBy("cv", "cw").agg(F.sum("n").alias("n")).collect():
            joint[r["cv"], r["cw"]] = r["n"]
        return joint

    for sweep in range(sweeps if n_words else 0):
        df = with_classes()
        sides = (df.groupBy(F.col("v").alias("word"), F.lit(1).alias("side"), F.col("cw").alias("other")).agg(F.sum("n").alias("n"))
                 .unionByName(df.groupBy(F.col("w").alias("word"), F.lit(0).alias("side"), F.col("cv").alias("other")).agg(F.sum("n").alias("n"))))
        words = (sides.where(f"word > 0 and word <= {n_words}").groupBy("word")
                 .agg(F.collect_list(F.struct("side", "other", "n")).alias("cells")))  # at most 2 * (CLASSES + 2) cells
        moved = words.mapInPandas(_exchange(classes, joint_counts(df), sweep), "word int, best int").collect()
        after = classes.copy()
        for r in moved:
            after[r["word"]] = r["best"]
        if (after == classes).all() and sweep % 2:
            break
        classes = after
    return classes, joint_counts(with_classes())


def _context_classes(joint: np.ndarray) -> np.ndarray:
    """The most probable class of a word between two context classes."""
    to = joint[:, :CLASSES] + 0.01
    onward = joint[:CLASSES] + 0.01
    score = np.log(to / to.sum(axis=1, keepdims=True))[:, :, None] + np.log(onward / onward.sum(axis=1, keepdims=True))[None]
    return score.argmax(axis=1).astype(np.uint8)


def _votes(table, buckets: int):
    """For each block and bucket: its words, training counts, and the votes of the words that are
    not frequent, as (position in the part, class, number)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, classes, by_context = table.value
        for batch in batches:
            for block, w, c, t, held, sizes in zip(*(batch.column(k).to_pylist() for k in ("block", "words", "counts", "tokens", "held", "sizes"))):
                words, counts, tokens = np.frombuffer(w, U64), np.frombuffer(c, "<u4"), _grow(t)
                number = frequent(words)
                context = classes[number][tokens]
                rare = (number == 0)[tokens] & ~np.repeat(np.array(held, bool), sizes)
                before = np.concatenate([[STOP], context[:-1]])
                after = np.concatenate([context[1:], [STOP]])
                key, n = np.unique(tokens[rare].astype(np.int64) * 256 + by_context[before[rare], after[rare]], return_counts=True)
                bucket = _bucket_of(words, buckets)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                place = np.empty(len(words), np.int64)
                place[order] = np.arange(len(words)) - np.repeat(cuts[:-1], np.diff(cuts))
                of = bucket[key >> 8]
                by = np.argsort(of, kind="stable")
                vote_cuts = np.searchsorted(of[by], np.arange(buckets + 1)).tolist()
                at, vote, n = place[key >> 8][by].astype("<u4"), (key & 255)[by].astype(np.uint8), n[by].astype("<u4")
                cuts = cuts.tolist()
                span, votes = list(zip(cuts, cuts[1:])), list(zip(vote_cuts, vote_cuts[1:]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(buckets), pa.int64()), pa.array([block] * buckets, pa.int64()),
                    pa.array([words[order[a:b]].tobytes() for a, b in span], pa.binary()), pa.array([counts[order[a:b]].tobytes() for a, b in span], pa.binary()),
                    *(pa.array([x[a:b].tobytes() for a, b in votes], pa.binary()) for x in (at, vote, n)),
                ], ["bucket", "block", "words", "counts", "at", "vote", "n"])

    return work


def _settle(table):
    """Counts and classes of all words of a bucket, back to each block in the order it sent them
    (``totals``, ``classes``); and rows with a null block: tokens and words seen once per class."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, classes, _ = table.value
        got = [b for batch in batches for b in batch.to_pylist()]
        if not got:
            return
        sent = [np.frombuffer(b["words"], U64) for b in got]
        words, inverse = np.unique(np.concatenate(sent), return_inverse=True)
        totals = np.bincount(inverse, weights=np.concatenate([np.frombuffer(b["counts"], "<u4") for b in got]), minlength=len(words)).astype(np.int64)
        firsts = np.cumsum([0, *map(len, sent)])
        index = np.concatenate([inverse[firsts[i] + np.frombuffer(b["at"], "<u4").astype(np.int64)] for i, b in enumerate(got)])
        vote = np.concatenate([np.frombuffer(b["vote"], np.uint8) for b in got])
        weight = np.concatenate([np.frombuffer(b["n"], "<u4") for b in got])
        key, at = np.unique(index.astype(np.int64) * 256 + vote, return_inverse=True)
        votes = np.bincount(at, weights=weight, minlength=len(key))
        best = np.lexsort((key & 255, -votes, key >> 8))
        first = best[np.concatenate([[True], np.diff(key[best] >> 8) > 0])] if len(best) else best
        number = frequent(words)
        of = np.minimum(classes[number], 255).astype(np.uint8)
        of[number == 0] = 0
        of[(key >> 8)[first]] = (key & 255)[first]
        for i, b in enumerate(got):
            mine = inverse[firsts[i]:firsts[i + 1]]
            yield pa.RecordBatch.from_arrays([
                pa.array([b["block"]], pa.int64()), pa.array([b["bucket"]], pa.int64()), pa.array([totals[mine].astype("<i8").tobytes()], pa.binary()),
                pa.array([of[mine].tobytes()], pa.binary())], ["block", "bucket", "totals", "classes"])
        mass = np.bincount(of, weights=totals, minlength=CLASSES + 2).astype("<i8")
        once = np.bincount(of[totals == 1], minlength=CLASSES + 2).astype("<i8")
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([mass.tobytes()], pa.binary()), pa.array([once.tobytes()], pa.binary())],
                                         ["block", "bucket", "totals", "classes"])

    return work


def _known(buckets: int):
    """``block, ids, held, sizes, tokens`` with the counts and classes of the block's words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, classes = [], []
            for w, answers in zip(batch.column("words").to_pylist(), batch.column("answers").to_pylist()):
                words = np.frombuffer(w, U64)
                order = np.argsort(_bucket_of(words, buckets), kind="stable")
                answers = sorted(answers, key=lambda a: a["bucket"])
                t, c = np.empty(len(words), "<i8"), np.empty(len(words), np.uint8)
                t[order] = np.frombuffer(b"".join(a["totals"] for a in answers), "<i8")
                c[order] = np.frombuffer(b"".join(a["classes"] for a in answers), np.uint8)
                totals.append(t.astype("<u4" if t.max(initial=0) < 2**32 else "<i8").tobytes())
                classes.append(c.tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("ids", "held", "sizes", "tokens")),
                                              pa.array(totals, pa.binary()), pa.array(classes, pa.binary())],
                                             ["ids", "held", "sizes", "tokens", "totals", "classes"])

    return work


def _totals(b: bytes, words: int) -> np.ndarray:
    return np.frombuffer(b, "<u4" if len(b) == 4 * words else "<i8").astype(np.int64)


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joint class counts of the training tokens of a task."""
    joint = np.zeros((CLASSES + 2) ** 2, np.int64)
    for batch in batches:
        for t, c, held, sizes in zip(*(batch.column(k).to_pylist() for k in ("tokens", "classes", "held", "sizes"))):
            of = np.frombuffer(c, np.uint8).astype(np.int64)[_grow(t)]
            before = np.concatenate([[STOP], of[:-1]])
            train = ~np.repeat(np.array(held, bool), sizes)
            joint += np.bincount((before * (CLASSES + 2) + of)[train], minlength=len(joint))
    cells = np.flatnonzero(joint)
    yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(joint[cells], pa.int64())], ["cell", "n"])


def _scores(table):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_train, kinds, known, unknown, unknown_class = table.value
        for batch in batches:
            for ids, held, sizes, t, tot, c in zip(*(batch.column(k).to_pylist() for k in ("ids", "held", "sizes", "tokens", "totals", "classes"))):
                of = np.frombuffer(c, np.uint8).astype(np.int64)
                counts = _totals(tot, len(of))
                tokens = _grow(t)
                of, counts = of[tokens], counts[tokens]
                sizes = np.array(sizes)
                firsts = np.cumsum(sizes) - sizes
                seen = counts > 0
                for i in np.flatnonzero(~seen):  # an unknown word takes the class that its left context expects
                    of[i] = unknown_class[STOP if i == 0 else of[i - 1]]
                before = np.concatenate([[STOP], of[:-1]])
                score = np.where(seen, np.log10(np.maximum(counts, 1)) + known[before, of], unknown[before])
                base = np.log10((counts + 1) / (n_train + kinds + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(sizes, pa.int64()),
                    pa.array(np.add.reduceat(seen.astype(np.int64), firsts), pa.int64()), pa.array(np.full(len(sizes), n_train), pa.int64()),
                    pa.array(np.add.reduceat(base, firsts)), pa.array(np.add.reduceat(score, firsts)),
                ], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return work


def class_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` (log10)."""
    spark = docs.sparkSession
    blocks = stored(document_columns(docs, id_col, text_col).mapInArrow(_blocks, BLOCKS), "blocks")
    total = blocks.agg(F.sum(F.length("words") / 8)).first()[0] or 0
    buckets = partitions_for(spark, int(total), 750_000)
    tops = stored(blocks.select("block", "words", "counts").mapInArrow(_scatter(buckets), "bucket long, words binary, counts binary")
                  .repartition(buckets, "bucket").mapInArrow(_top_words(FREQUENT), "word long, n long, kinds long, once long"), "vocabulary")
    n_train, kinds, once = (int(x or 0) for x in tops.where("word is null").agg(F.sum("n"), F.sum("kinds"), F.sum("once")).first())
    top = tops.where(F.col("word") != int(END.view(np.int64))).orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").toPandas()
    frequent = _Frequent(top["word"].to_numpy(np.int64).view(U64))
    numbers = spark.sparkContext.broadcast(frequent)
    few = partitions_for(spark, 1, 1)
    pairs = stored(blocks.select("words", "tokens", "held", "sizes").mapInArrow(_pairs(numbers, few), "bucket long, cells binary, counts binary")
                   .repartition(few, "bucket").mapInArrow(_sum_pairs(frequent.stop + 1), "v int, w int, n long"), "pairs")
    classes, joint = exchange_classes(pairs, len(top))
    model = spark.sparkContext.broadcast((frequent, classes, _context_classes(joint)))
    sent = blocks.select("block", "words", "counts", "tokens", "held", "sizes").mapInArrow(
        _votes(model, buckets), "bucket long, block long, words binary, counts binary, at binary, vote binary, n binary")
    answers = stored(sent.repartition(buckets, "bucket").mapInArrow(_settle(model), "block long, bucket long, totals binary, classes binary"), "answers")
    mass, seen_once = np.zeros(CLASSES + 2), np.zeros(CLASSES + 2)
    for r in answers.where("block is null").toLocalIterator():
        mass += np.frombuffer(r["totals"], "<i8")
        seen_once += np.frombuffer(r["classes"], "<i8")
    back = answers.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("bucket", "totals", "classes")).alias("answers"))
    known = stored(blocks.select("block", "ids", "held", "sizes", "tokens", "words").join(back, "block").mapInArrow(
        _known(buckets), "ids array<long>, held array<boolean>, sizes array<long>, tokens binary, totals binary, classes binary"), "known")
    joint = np.zeros((CLASSES + 2) ** 2)
    moves = known.select("tokens", "classes", "held", "sizes").mapInArrow(_transitions, "cell long, n long")
    for r in moves.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        joint[r["cell"]] = r["n"]
    table = spark.sparkContext.broadcast((n_train, kinds, *_tables(joint.reshape(CLASSES + 2, -1), mass, seen_once, n_train, once)))
    return known.mapInArrow(_scores(table), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _tables(joint: np.ndarray, mass: np.ndarray, once: np.ndarray, n_train: int, seen_once: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log10 of what multiplies a known word's count, by the classes before and of it; log10 of the
    probability of the unknown word by the class before; the class it is taken for."""
    move = joint + 0.5
    move[:, OTHER] = 0
    move /= move.sum(axis=1, keepdims=True)
    unseen = (once + 0.5) / (mass + 1)  # of each class's mass
    unseen[STOP] = 0
    unseen_all = (seen_once + 0.5) / (n_train + 1)
    emit = np.where(mass > 0, (1 - unseen) / np.maximum(mass, 1), 0)
    unseen = np.where(mass > 0, unseen, 1.0)
    unseen[OTHER] = 0
    known = WEIGHT * move * emit + (1 - WEIGHT) * (1 - unseen_all) / max(n_train, 1)
    unknown = WEIGHT * (move @ unseen) + (1 - WEIGHT) * unseen_all
    return np.log10(known), np.log10(unknown), (move * unseen)[:, :CLASSES].argmax(axis=1)


def op1_brown_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under the class model and the unigram base."""
    return class_model_scores(read(spark, sf_dir, "documents"))
