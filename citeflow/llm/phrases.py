"""Phrase collocations: pairs of frequency-ranked ids counted in direct-address tiles.

1. Texts become parts: the sequence of words of some documents as positions in the part's own
   dictionary (a part ends after ``PART_TOKENS`` words or ``PART_BYTES`` of dictionary), breaks as -1.
2. Words are summed over the parts (a row per word and part). Those that occur ``least`` times get ids
   by descending count, and each part gets the ids of its words back; others become breaks, as no frequent
   phrase holds them.
3. Adjacent ids are counted per part (``PairTiles``): a pair's tile is ``(a // SIDE, b // SIDE)``. Among the
   ``DENSE_IDS`` most frequent ids a well-filled tile is one dense ``bincount`` over all its cells; all other tiles
   keep their pairs as sorted coordinates with counts. Spark sums the pairs over the parts.
4. Each part learns which of its pairs are frequent, with their totals, and ranks them by those in turn; the
   sequence of their ranks is counted by the same tiles: two overlapping pairs that follow one another are a
   phrase of three words. Ranks are the part's own, so counts leave it under the pairs themselves.

Nothing is broadcast and no dictionary is held whole: a task holds a part and the words or pairs
of it. A hot word or pair is one row per part. Counts are whole: nothing is sampled or capped.

Results: null or empty texts have no words; a null ``lang`` is ``und``; repeated rows count each; a language
without frequent phrases has no rows; ties go by score, count and the phrase's bytes; an empty table gives
no rows; other columns are left out, whatever their names. A text longer than a block is a block alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeflow.llm.common import bound_batches, prepare, read, release, stored, text_blocks
from citeflow.operators.sampling import with_row_index
from citeflow.session import reliable_checkpoint

LEAST, NESTED, TOP = 10, 50, 2000
PART_TOKENS = 3_000_000
PART_BYTES = 40 << 20
TEXT_BYTES = 2 << 20
SIDE, DENSE_IDS = 512, 2048
#: a dense tile pays from this share of its cells
FILLED = 1 / 16
#: pairs of a part that wait to be sorted
WAITING = 1_000_000
ROW_WORDS = 20_000

# classes of bytes: 0 in a word, 1 between words, 2 between pieces
KIND = np.zeros(256, np.int8)
KIND[[0x20, 0x09]] = 1
KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def piece_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All words in order, A-Z lower-cased, and whether the next word is in the same piece."""
    buf = FOLD[np.frombuffer(b"\n".join(texts), np.uint8)]
    kind = KIND[buf]
    word = np.zeros(len(buf) + 2, np.int8)
    word[1:-1] = kind == 0
    step = np.diff(word)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    cuts = np.concatenate([[0], np.cumsum(kind == 2)])
    joined = np.zeros(len(starts), bool)
    joined[:-1] = cuts[starts[1:]] == cuts[ends[:-1]]
    kept = np.ascontiguousarray(buf[word[1:-1] == 1])
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    return words, joined


class _Part:
    """The dictionary of a part: (language, word) -> position, and how often each occurs."""

    def __init__(self):
        self.places: dict[str, dict[bytes, int]] = {}
        self.words: list[tuple[str, bytes]] = []
        self.counts = np.zeros(1 << 12, np.int64)
        self.tokens = self.bytes = 0

    def add(self, lang: str, texts: list[bytes]) -> np.ndarray:
        words, joined = piece_words(texts)
        if not len(words):
            return np.zeros(0, np.int32)
        coded = words.dictionary_encode()
        places, found = self.places.setdefault(lang, {}), []
        for w in coded.dictionary.to_pylist():
            place = places.get(w)
            if place is None:
                places[w] = place = len(self.words)
                self.words.append((lang, w))
                self.bytes += len(w) + 100
            found.append(place)
        ids = np.array(found, np.int32)[coded.indices.to_numpy(zero_copy_only=False)]
        if len(self.words) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros(len(self.words), np.int64)])
        some = np.bincount(ids)
        self.counts[:len(some)] += some
        self.tokens += len(ids)
        out = np.full(len(ids) + int((~joined).sum()), -1, np.int32)
        out[np.arange(len(ids)) + np.concatenate([[0], np.cumsum(~joined)[:-1]])] = ids
        return out

    def full(self) -> bool:
        return self.tokens >= PART_TOKENS or self.bytes >= PART_BYTES


_PARTS = "part long, ids binary, first int, langs array<string>, words array<string>, counts array<long>"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "ids", "first", "langs", "words", "counts"]
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64())]
    number = TaskContext.get().partitionId() << 32
    part = _Part()

    def dictionary() -> Iterator[pa.RecordBatch]:
        for a in range(0, len(part.words), ROW_WORDS):
            some = part.words[a:a + ROW_WORDS]
            row = [number, None, a, [s[0] for s in some], [s[1].decode() for s in some], part.counts[a:a + len(some)]]
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for rows, texts in text_blocks(batch, "text", TEXT_BYTES):
            here = langs[rows]
            for lang in sorted(set(here)):
                ids = part.add(lang, [t for t, x in zip(texts, here) if x == lang])
                if len(ids):
                    row = [number, ids.tobytes(), None, None, None, None]
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)
            if part.full():
                yield from dictionary()
                number, part = number + 1, _Part()
    yield from dictionary()


class PairTiles:
    """Counts of pairs of non-negative ids below 2^31."""

    def __init__(self):
        self.dense: list[np.ndarray] = []
        self.sparse: list[np.ndarray] = []
        self.waiting = 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray) -> None:
        """Adjacent ids of a sequence; negative ones are breaks."""
        a, b = ids[:-1].astype(np.int64), ids[1:].astype(np.int64)
        here = (a >= 0) & (b >= 0)
        a, b = a[here], b[here]
        top = (a < DENSE_IDS) & (b < DENSE_IDS)
        tiles = DENSE_IDS // SIDE
        self.dense.append(((((a // SIDE) * tiles + b // SIDE) * SIDE + a % SIDE) * SIDE + b % SIDE)[top].astype(np.int32))
        self.sparse.append(a[~top] << 32 | b[~top])
        self.waiting += len(a)
        if self.waiting >= WAITING:
            self._settle()

    @staticmethod
    def _coordinates(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted coordinates: equal ones become one with their count."""
        keys.sort()
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[new], np.diff(np.append(new, len(keys)))

    def _join(self, found: list[tuple[np.ndarray, np.ndarray]]) -> None:
        keys, n = (np.concatenate(x) for x in zip((self.keys, self.counts), *found))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        self.keys, self.counts = keys[new], np.add.reduceat(n, new) if len(new) else n

    def _settle(self) -> None:
        if not self.waiting:
            return
        cells, tiles = SIDE * SIDE, DENSE_IDS // SIDE
        codes = np.concatenate(self.dense)
        tile = codes // cells
        order = np.argsort(tile, kind="stable")  # a radix sort: tiles are few
        codes, ends = codes[order], np.cumsum(np.bincount(tile, minlength=tiles * tiles))
        sparse, found, start = self.sparse, [], 0
        for t, end in enumerate(ends.tolist()):
            local = codes[start:end] - t * cells
            start = end
            base = ((t // tiles * SIDE) << 32) + t % tiles * SIDE
            if len(local) >= FILLED * cells:
                counts = np.bincount(local, minlength=cells)
                there = np.flatnonzero(counts)
                found.append((base + ((there // SIDE) << 32) + there % SIDE, counts[there]))
            elif len(local):
                local = local.astype(np.int64)
                sparse.append(base + ((local // SIDE) << 32) + local % SIDE)
        self._join([*found, self._coordinates(np.concatenate(sparse))])
        self.dense, self.sparse, self.waiting = [], [], 0

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs ``a << 32 | b``, sorted, and their counts."""
        self._settle()
        return self.keys, self.counts


def _pair_rows(part: int, tiles: PairTiles) -> Iterator[pa.RecordBatch]:
    keys, counts = tiles.found()
    for a in range(0, len(keys), 1 << 18):
        some = keys[a:a + (1 << 18)]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), part)), pa.array(some), pa.array(counts[a:a + (1 << 18)])], ["part", "pair", "n"])


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part, pair, n`` of the sequences of a stored table; a part that is cut over tasks has rows from each."""
    part, tiles = None, PairTiles()
    for batch in batches:
        for p, raw in zip(batch.column("part").to_pylist(), batch.column("ids").to_pylist()):
            if p != part and part is not None:
                yield from _pair_rows(part, tiles)
                tiles = PairTiles()
            part = p
            tiles.add(np.frombuffer(raw, np.int32))
    if part is not None:
        yield from _pair_rows(part, tiles)


def _by_part(batches: Iterator[pa.RecordBatch], value) -> Iterator[tuple[int, object, np.ndarray]]:
    """Rows of (part, dictionary row or sequence), dictionaries first: (part, what ``value`` makes of
    the dictionary, each sequence)."""
    part, head, made = None, [], None
    for batch in batches:
        for p, ids, keys, to in zip(*(batch.column(c).to_pylist() for c in ("part", "ids", "keys", "to"))):
            if p != part:
                part, head, made = p, [], None
            if ids is None:
                head.append((np.frombuffer(keys, np.int64), np.frombuffer(to, np.int64)))
                continue
            if made is None:
                made = value(*(np.concatenate(x) for x in zip(*head))) if head else value(*[np.zeros(0, np.int64)] * 2)
                head = []
            yield part, made, np.frombuffer(ids, np.int32)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``part, key, value``, sorted by part, as one row of bytes for each part in a batch."""
    for batch in batches:
        parts, keys, to = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "key", "value"))
        at = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
        rows = [(int(parts[a]), None, keys[a:b].astype(np.int64).tobytes(), to[a:b].astype(np.int64).tobytes()) for a, b in zip(at, at[1:]) if b > a]
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["part", "ids", "keys", "to"])


def _with_dictionaries(sequences: DataFrame, routed: DataFrame) -> DataFrame:
    """Each part's dictionary rows (``part, key, value``, packed in the tasks that send them), then its sequences."""
    packed = routed.sortWithinPartitions("part").mapInArrow(_packed, "part long, ids binary, keys binary, to binary")
    empty = F.lit(None).cast("binary")
    both = packed.unionByName(sequences.select("part", "ids", empty.alias("keys"), empty.alias("to")))
    return both.repartition("part").sortWithinPartitions("part", F.col("ids").isNotNull())


def _word_sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions in the part's dictionary to word ids; rare words are breaks, and runs of breaks one."""
    def table(keys: np.ndarray, to: np.ndarray) -> np.ndarray:
        out = np.full(int(keys.max()) + 2 if len(keys) else 1, -1, np.int32)
        out[keys] = to
        return out

    for part, ids_of, raw in _by_part(batches, table):
        ids = ids_of[np.where((raw < 0) | (raw >= len(ids_of)), len(ids_of) - 1, raw)]  # the last entry is -1
        kept = ids >= 0
        kept[1:] |= ids[:-1] >= 0
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([ids[kept].tobytes()], pa.binary())], ["part", "ids"])


def _count_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``head, tail, n``: frequent pairs of words that follow one another, overlapping in a word."""
    def table(keys: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, first = np.unique(keys, return_index=True)
        by_rank = np.lexsort((keys, -totals[first]))
        ranks = np.empty(len(keys), np.int32)
        ranks[by_rank] = np.arange(len(keys), dtype=np.int32)
        return keys, ranks, keys[by_rank]

    def rows(ranked: np.ndarray, tiles: PairTiles) -> Iterator[pa.RecordBatch]:
        pairs, counts = tiles.found()
        for a in range(0, len(pairs), 1 << 18):
            some = pairs[a:a + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(ranked[some >> 32]), pa.array(ranked[some & 0xFFFFFFFF]), pa.array(counts[a:a + (1 << 18)])],
                                             ["head", "tail", "n"])

    last, names, tiles = None, None, PairTiles()
    for part, (keys, ranks, ranked), ids in _by_part(batches, table):
        if part != last and last is not None:
            yield from rows(names, tiles)
            tiles = PairTiles()
        last, names = part, ranked
        if not len(keys) or len(ids) < 3:
            continue
        a, b = ids[:-1].astype(np.int64), ids[1:].astype(np.int64)
        pairs = np.where((a < 0) | (b < 0), -1, a << 32 | b)
        at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
        tiles.add(np.where(keys[at] == pairs, ranks[at], -1))
    if last is not None:
        yield from rows(names, tiles)


def _ranked(counts: DataFrame, keys: list[str]) -> DataFrame:
    """``counts`` with ``id``: the position by descending ``n``, ties by ``keys``."""
    return with_row_index(reliable_checkpoint(counts.orderBy(F.desc("n"), *keys)), "id")


def _total(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Rows (one or so per key and part) whose ``n`` comes to ``least`` over all parts, with that ``total``."""
    return rows.withColumn("total", F.sum("n").over(Window.partitionBy(*keys))).where(F.col("total") >= least)


def _score(a: str, left: str, right: str) -> Column:
    """``floor(1000000 * a * a / (left * right))`` exactly, by whole decimals of 38 digits (counts below 10^16)."""
    wide = lambda c: f"CAST({c} AS DECIMAL(16, 0))"
    return F.expr(f"({wide(a)} * {wide(a)} * CAST(1000000 AS DECIMAL(7, 0))) DIV ({wide(left)} * {wide(right)})").cast("long")


def candidates(docs: DataFrame, least: int = LEAST, nested: int = NESTED, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """All phrases of two and three words that occur ``least`` times and are not nested in a longer one:
    ``lang, phrase, a, l, r, n, score``."""
    spark = docs.sparkSession
    prepare(spark)
    bound_batches(spark)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    parts = stored(rows.mapInArrow(_parts, _PARTS), "parts")
    entry = F.explode(F.arrays_zip("langs", "words", "counts"))
    words = (parts.where("ids IS NULL").select("part", "first", F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("at", "e"))
             .select("part", (F.col("first") + F.col("at")).cast("long").alias("key"), F.col("e.langs").alias("lang"),
                     F.col("e.words").alias("word"), F.col("e.counts").alias("n")))
    per_lang = (parts.where("ids IS NULL").select(entry.alias("e")).groupBy(F.col("e.langs").alias("lang"))
                .agg(F.sum("e.counts").alias("all_words")))
    per_lang = stored(per_lang, "languages")
    often = stored(_total(words, ["lang", "word"], least).select("part", "key", "lang", "word", "total"), "often")
    known = stored(_ranked(often.groupBy("lang", "word").agg(F.max("total").alias("n")), ["lang", "word"])
                   .withColumn("id", F.col("id").cast("int")), "words")
    routed = often.join(known.select("lang", "word", "id"), ["lang", "word"]).select("part", "key", F.col("id").alias("value"))
    sequences = stored(_with_dictionaries(parts.where("ids IS NOT NULL"), routed).mapInArrow(_word_sequences, "part long, ids binary"), "sequences")
    release(parts)
    release(often)
    # one row per pair and part goes through the shuffle; of the frequent ones, each part learns its own
    some = _total(sequences.mapInArrow(_count_pairs, "part long, pair long, n long"), ["pair"], least)
    some = stored(some.select("part", F.col("pair").alias("key"), F.col("total").alias("value")), "often-pairs")
    triples = (_with_dictionaries(sequences, some).mapInArrow(_count_triples, "head long, tail long, n long")
               .groupBy("head", "tail").agg(F.sum("n").alias("a")).where(F.col("a") >= least))
    triples = stored(triples, "triples")
    pairs = stored(some.groupBy("key").agg(F.max("value").alias("a")), "pairs")
    release(sequences)
    release(some)

    pair = pairs.select("key", F.shiftright("key", 32).cast("int").alias("w1"),
                        F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("w2"), "a")
    word = lambda k: known.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"word{k}"), F.col("n").alias(f"n{k}"),
                                  *([F.col("lang")] if k == 1 else []))
    # a pair is nested if a phrase of three that holds it occurs nearly as often
    holds = (triples.select(F.explode(F.array("head", "tail")).alias("key"), "a").groupBy("key").agg(F.max("a").alias("longer")))
    two = pair.join(holds, "key", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < nested * F.col("a")))
    two = (two.join(word(1), "w1").join(word(2), "w2")
           .select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"))
           .withColumn("score", _score("a", "l", "r")))
    three = (triples.join(pair.select(F.col("key").alias("head"), "w1", "w2", F.col("a").alias("n12")), "head")
             .join(pair.select(F.col("key").alias("tail"), F.col("w2").alias("w3"), F.col("a").alias("n23")), "tail")
             .join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
             .withColumn("first", _score("a", "n1", "n23")).withColumn("second", _score("a", "n12", "n3")))
    early = F.col("first") <= F.col("second")
    three = three.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a",
                         F.when(early, F.col("n1")).otherwise(F.col("n12")).alias("l"),
                         F.when(early, F.col("n23")).otherwise(F.col("n3")).alias("r"), F.least("first", "second").alias("score"))
    return (two.unionByName(three).join(per_lang, "lang")
            .select("lang", "phrase", "a", "l", "r", F.col("all_words").alias("n"), "score"))


def best_phrases(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language with their ``rank``. A language is first cut in salted shares, as many as
    let a share and what all shares leave be of about one size. ``found`` is read twice: a stored table."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salts = max(1, isqrt(found.count() // top))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    whole = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return (some.withColumn("rank", whole.cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op12_phrase_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language over all documents."""
    return best_phrases(stored(candidates(read(spark, sf_dir, "documents")), "phrases"))
