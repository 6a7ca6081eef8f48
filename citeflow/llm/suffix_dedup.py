"""Repeated byte strings by anchored suffix sorting (deep-shallow).

A byte goes if a ``length``-byte string that covers it also starts anywhere else. Sorting
every suffix of a corpus would move each byte many times; only these are sorted:

1. In every window of ``length`` bytes the ``gram``-byte string with the least hash is an
   anchor, so equal windows have their anchors at equal places. About one position in 128 is one.
2. Anchors meet by the hash of their gram, and by that of all bytes that windows around them
   can hold. An anchor whose whole surroundings occur twice is settled: all of them go.
   These are counts, combined before they are shuffled.
3. What is left are anchors with the same gram but different surroundings, near the ends of
   matches. In each group the suffixes that start behind the anchors are sorted, and the
   reversed prefixes before them, by deep-shallow sorting: multikey quicksort to a shallow
   depth, then a blind trie for each group of strings that agree so far. Common prefixes of
   neighbours give how far any two anchors agree to both sides, and so which windows repeat.
4. A group of more than ``GROUP`` different surroundings (a passage in very many documents)
   is split first: windows that start in the nearer and in the farther half before the anchor
   share a longer gram, by which their groups split, as often as it takes. Surroundings that
   are equal by then are counted as in 2, so no task holds an unbounded group.

Results: offsets are in UTF-8 bytes; a null or empty text has no bytes and loses none; a text
shorter than ``length`` loses none; repeated rows are occurrences of each other; an empty
input gives no rows; columns of the input other than those returned are left out (or kept
as they are, for ``without_repeats``). Equal hashes of 128 bits and more are taken as equal strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.llm.common import (BASE, BASE_INV, BYTE_HASH, U64, Scratch, document_columns, mix, partitions_for, powers, read,
                                 release, signed, stored, text_blocks)

LENGTH = 400
GRAM = 144
#: different surroundings that one group of the local sort may hold
GROUP = 768
SHALLOW = 24
BLOCK = 1 << 20
#: anchors whose bytes are wanted are told to the scan by a table of so many bits, made in ranges
SLOTS = 1 << 25
RANGE = 1 << 15
OCCURRENCE = "doc_id long, row_key long, pos long, gram long, around long, lo long, hi long"


def _sums(buf: np.ndarray) -> np.ndarray:
    out = np.zeros(len(buf) + 1, U64)
    np.cumsum(BYTE_HASH[buf] * powers(BASE, len(buf)), out=out[1:])
    return out


def _hash_between(sums: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
    size = U64(end.start - start.start) if isinstance(start, slice) else (end - start).astype(U64)
    return mix((sums[end] - sums[start]) * powers(BASE_INV, len(sums))[start] + size)


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from minima that run within blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(U64).max, U64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1: n])


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text index, position, gram hash, hash of the surroundings, first and last byte of the
    surroundings) of the anchors of one block of texts. The surroundings are the windows that
    have this anchor: each window has one, told by its own bytes."""
    raw = b"".join(texts)
    if len(texts) > 1 or len(raw) <= 2 * BLOCK:
        return _anchors(raw, np.cumsum([len(t) for t in texts], dtype=np.int64), length, gram, len(raw))
    # one very long text: windows that start in one segment after another
    found = []
    for a in range(0, len(raw), BLOCK):
        part = raw[a:a + BLOCK + length - 1]
        text, pos, grams, around, lo, hi = _anchors(part, np.array([len(part)]), length, gram, BLOCK)
        found.append((text, pos + a, grams, around, lo + a, hi + a))
    return tuple(np.concatenate(x) for x in zip(*found))


def _anchors(raw: bytes, ends: np.ndarray, length: int, gram: int, starts_below: int) -> tuple[np.ndarray, ...]:
    buf = np.frombuffer(raw, np.uint8)
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return none, none, none.view(U64), none.view(U64), none, none
    sizes = np.diff(ends, prepend=0)
    sums = _sums(buf)
    n = len(buf) - gram + 1
    left = (np.repeat(ends, sizes)[:n] - np.arange(n)).astype(np.int32)  # bytes to the end of the text
    grams = _hash_between(sums, slice(0, n), slice(gram, gram + n))
    bits = U64(len(buf).bit_length())
    keyed = np.where(left >= gram, ((grams >> bits) << bits) | np.arange(n, dtype=U64), np.iinfo(U64).max)
    lows = _window_minima(keyed, length - gram + 1)
    del keyed
    start = np.flatnonzero(left[: len(lows)][:starts_below] >= length)
    if not len(start):
        return none, none, none.view(U64), none.view(U64), none, none
    at = (lows[start] & ((U64(1) << bits) - U64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    pos, lo = at[first], start[first]
    hi = start[np.append(first[1:], len(at)) - 1] + length
    text = np.searchsorted(ends, pos, "right")
    around = mix(_hash_between(sums, lo, hi) + mix((pos - lo).astype(U64) * U64(4096) + (hi - pos).astype(U64)))
    base = (ends - sizes)[text]
    return text, pos - base, grams[pos], around, lo - base, hi - base


def _occurrences(length: int, gram: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_blocks(batch, "text", BLOCK):
                text, pos, grams, around, lo, hi = anchors(texts, length, gram)
                who = pa.array(text, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[rows].take(who), batch.column("row_key")[rows].take(who),
                    pa.array(pos, pa.int64()), pa.array(signed(grams)), pa.array(signed(around)), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()),
                ], ["doc_id", "row_key", "pos", "gram", "around", "lo", "hi"])

    return work


def _slot(gram: np.ndarray, around: np.ndarray) -> np.ndarray:
    return (mix(around ^ gram) & U64(SLOTS - 1)).astype(np.int64)


def _marked(table: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (table[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def _surroundings(table, length: int, gram: int):
    """The bytes around the anchors whose slot is marked: ``left`` of them stand before the gram."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            for rows, texts in text_blocks(batch, "text", BLOCK):
                text, pos, grams, around, lo, hi = anchors(texts, length, gram)
                hit = np.flatnonzero(_marked(bits, _slot(grams, around)))
                who = pa.array(text[hit], pa.int64())
                cut = [texts[t][a:b] for t, a, b in zip(text[hit].tolist(), lo[hit].tolist(), hi[hit].tolist())]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[rows].take(who), batch.column("row_key")[rows].take(who),
                    pa.array(pos[hit], pa.int64()), pa.array(signed(grams[hit])), pa.array(signed(around[hit])),
                    pa.array((pos - lo)[hit], pa.int64()), pa.array(cut, pa.binary()),
                ], ["doc_id", "row_key", "pos", "gram", "around", "left", "bytes"])

    return work


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slot = np.unique(_slot(np.asarray(batch.column("gram")).view(U64), np.asarray(batch.column("around")).view(U64)))
        yield pa.RecordBatch.from_arrays([pa.array(slot // RANGE), pa.array(slot % RANGE)], ["part", "slot"])


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        part, slot = np.asarray(batch.column("part")), np.asarray(batch.column("slot"))
        for p in np.unique(part).tolist():
            parts.setdefault(p, np.zeros(RANGE, bool))[slot[part == p]] = True
    yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int64()), pa.array([np.packbits(b).tobytes() for b in parts.values()], pa.binary())], ["part", "bits"])


def _bit_table(anchored: DataFrame) -> np.ndarray:
    """The packed bits of the slots of ``gram, around``: of one size, whatever the input."""
    spark = anchored.sparkSession
    made = anchored.select("gram", "around").mapInArrow(_slots, "part long, slot long").repartition(partitions_for(spark, 1, 1), "part")
    table = np.zeros(SLOTS // 8, np.uint8)
    for r in made.mapInArrow(_bits, "part long, bits binary").toLocalIterator():
        table[r["part"] * (RANGE // 8):(r["part"] + 1) * (RANGE // 8)] = np.frombuffer(r["bits"], np.uint8)
    return table


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def blind_trie_order(strings: list[bytes], members: list[int]) -> list[tuple[int, int]]:
    """``members`` in the order of their strings, each with its common prefix with the one before.

    A node holds the depth at which its children differ and a child per next byte (-1: the
    string ends there). A new string runs down by these bytes alone, is compared once with
    any leaf below, and hangs where that comparison ended."""
    root: list = [None, None, [members[0]]]  # depth, children, leaves of equal strings
    for m in members[1:]:
        s, node = strings[m], root
        path = []
        while node[1] is not None:
            path.append(node)
            byte = s[node[0]] if node[0] < len(s) else -1
            node = node[1].get(byte) or next(iter(node[1].values()))
        other = strings[node[2][0]]
        same = common_prefix(s, other)
        if same == len(s) == len(other):
            node[2].append(m)
            continue
        for above in path:
            if above[0] >= same:
                node = above
                break
        byte = s[same] if same < len(s) else -1
        if node[1] is not None and node[0] == same:
            node[1][byte] = [None, None, [m]]
        else:
            old = other[same] if same < len(other) else -1
            below = list(node)
            node[:] = [same, {old: below, byte: [None, None, [m]]}, None]
    out: list[tuple[int, int]] = []
    todo: list[tuple[list, int]] = [(root, 0)]
    while todo:
        node, depth = todo.pop()
        if node[1] is None:
            size = len(strings[node[2][0]])
            out += [(m, size if k else depth) for k, m in enumerate(node[2])]
        else:
            ordered = sorted(node[1].items())
            todo += [(child, node[0]) for _, child in reversed(ordered[1:])]
            todo.append((ordered[0][1], depth))
    return out


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """The order of the strings and the common prefix of each with the one before it (0 for the
    first): multikey quicksort by eight bytes a step down to ``shallow`` bytes, then blind tries."""
    out: list[tuple[int, int]] = []
    todo: list[tuple[list[int], int]] = [(list(range(len(strings))), 0)]
    while todo:
        part, depth = todo.pop()
        if len(part) == 1:
            out.append((part[0], -1))
            continue
        if depth >= shallow:
            order = blind_trie_order(strings, part)
            out.append((order[0][0], -1))
            out += order[1:]
            continue
        # the next eight bytes and how many of them there are
        keys = {i: (strings[i][depth:depth + 8].ljust(8, b"\0"), min(8, max(0, len(strings[i]) - depth))) for i in part}
        pivot = keys[part[len(part) // 2]]
        less = [i for i in part if keys[i] < pivot]
        same = [i for i in part if keys[i] == pivot]
        more = [i for i in part if keys[i] > pivot]
        if more:
            todo.append((more, depth))
        if same:
            todo.append((same, depth + 8))
        if less:
            todo.append((less, depth))
    order = [i for i, _ in out]
    lcp = [0] * len(out)
    for k in range(1, len(out)):
        known = out[k][1]
        lcp[k] = known if known >= 0 else common_prefix(strings[order[k - 1]], strings[order[k]])
    return order, lcp


def _agreement(strings: list[bytes]) -> np.ndarray:
    """Common prefixes of all strings of one bounded group, from the sorted neighbours'."""
    order, lcp = deep_shallow(strings)
    n = len(order)
    out = np.empty((n, n), np.int16)
    lcp_a = np.array(lcp, np.int16)
    rank = np.array(order)
    for k in range(n):
        out[rank[k], rank[k]] = len(strings[order[k]])
        if k + 1 < n:
            run = np.minimum.accumulate(lcp_a[k + 1:])
            out[rank[k], rank[k + 1:]] = run
            out[rank[k + 1:], rank[k]] = run
    return out


def _matches(length: int, gram: int):
    """Intervals that go, for the surroundings with one occurrence of the groups of a task."""
    need = length - gram

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        table = table.sort_by("g")
        g = table["g"].to_numpy()
        single = table["n"].to_numpy() == 1
        pos, left = table["pos"].to_numpy(), table["left"].to_numpy()
        cut = table["bytes"].to_pylist()
        ends = np.append(np.flatnonzero(np.diff(g)) + 1, len(g)).tolist()
        who, start, end = [], [], []
        a = 0
        for b in ends:
            at = left[a:b].tolist()
            behind = [cut[i][at[i - a] + gram:] for i in range(a, b)]
            before = [cut[i][:at[i - a]][::-1] for i in range(a, b)]
            if b - a == 2:
                r, l = common_prefix(*behind), common_prefix(*before)
                if l + r >= need:
                    for i in (a, a + 1):
                        if single[i]:
                            who.append(i)
                            start.append(int(pos[i]) - l)
                            end.append(int(pos[i]) + gram + r)
            else:
                right, back = _agreement(behind), _agreement(before)
                hit = (right + back >= need) & single[a:b, None]
                np.fill_diagonal(hit, False)
                x, y = np.nonzero(hit)
                if len(x):
                    found = np.unique(np.stack([x, back[x, y], right[x, y]]), axis=1)
                    who += (a + found[0]).tolist()
                    start += (pos[a + found[0]] - found[1]).tolist()
                    end += (pos[a + found[0]] + gram + found[2]).tolist()
            a = b
        rows = pa.array(who, pa.int64())
        out = pa.Table.from_arrays([table["doc_id"].take(rows), table["row_key"].take(rows),
                                    pa.chunked_array([pa.array(start, pa.int64())]), pa.chunked_array([pa.array(end, pa.int64())])],
                                   ["doc_id", "row_key", "start", "end"])
        yield from out.combine_chunks().to_batches()

    return work


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), _row_key(id_col, text_col))


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string")).alias("row_key")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_key, start, end``: byte intervals (they may overlap) that cover exactly what
    goes; ``row_key`` tells rows with one id apart."""
    docs = _keyed(docs, id_col, text_col)
    with Scratch() as scratch:
        spans = [scratch.keep(s) for s in _span_tables(docs, length, gram)]
    return reduce(DataFrame.unionByName, spans)


def _span_tables(docs: DataFrame, length: int, gram: int) -> list[DataFrame]:
    """Stored tables of spans, one or two for each step."""
    spark = docs.sparkSession
    found = stored(docs.mapInArrow(_occurrences(length, gram), OCCURRENCE), "anchors")
    one = F.struct("doc_id", "row_key", "pos")
    around = found.groupBy("gram", "around").agg(F.count("*").alias("n"), F.min(one).alias("at"))
    around = stored(around.join(around.groupBy("gram").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
                                .where("total > 1"), "gram"), "around")
    # 2: surroundings that occur twice go everywhere
    twice = around.where("n > 1").select("gram", "around")
    meet = around.where("kinds > 1").select("gram", "around", "n", "at.*")
    spans = [stored(found.join(twice, ["gram", "around"]).select("doc_id", "row_key", F.col("lo").alias("start"), F.col("hi").alias("end")), "spans")]
    release(found)
    # 3: one occurrence of each of the others, with its bytes
    marked = spark.sparkContext.broadcast(_bit_table(meet))
    cut = docs.mapInArrow(_surroundings(marked, length, gram), "doc_id long, row_key long, pos long, gram long, around long, left long, bytes binary")
    same = [cut[c].eqNullSafe(meet[c]) for c in ("gram", "around", "doc_id", "row_key", "pos")]
    level = stored(cut.join(meet, same).select(cut["doc_id"], cut["row_key"], cut["pos"], cut["gram"].alias("g"), cut["around"],
                                                 "n", "left", "bytes").dropDuplicates(["g", "around"])
                   .withColumns({"near": F.lit(0), "far": F.lit(length - gram)}), "surroundings")
    release(around)
    while True:
        sizes = level.groupBy("g").agg(F.count("*").alias("size"))
        groups = stored(level.join(sizes.where("size > 1"), "g"), "groups")
        release(level)
        large, rows = groups.agg(F.max("size") > GROUP, F.count("*")).first()
        local = groups.where(F.col("size") <= GROUP).select("g", "n", "doc_id", "row_key", "pos", "left", "bytes")
        spans.append(stored(local.repartition(partitions_for(spark, rows, 20_000), "g")
                            .mapInArrow(_matches(length, gram), "doc_id long, row_key long, start long, end long"), "spans"))
        if not large:
            return spans
        # 4: halves of the windows' starts, told by how many bytes before the anchor they stand
        mid = ((F.col("near") + F.col("far")) / 2).cast("int")
        halves = F.array(F.struct(F.col("near").alias("lo"), mid.alias("hi")), F.struct((mid + 1).alias("lo"), F.col("far").alias("hi")))
        right = F.length("bytes") - F.col("left") - gram
        split = (groups.where(F.col("size") > GROUP).drop("size").withColumn("half", F.explode(halves))
                 .withColumns({"lo": F.col("half.lo"), "hi": F.col("half.hi"), "right": right})
                 .where((F.col("lo") <= F.col("hi")) & (F.col("left") >= F.col("lo")) & (F.col("right") >= length - gram - F.col("hi"))))
        l, r = F.least("left", "hi"), F.least(F.col("right"), length - gram - F.col("lo"))
        core = F.expr(f"substring(bytes, int(left - lo + 1), int(lo + {length} - hi))")
        split = split.withColumns({"core": core, "l": l, "r": r})
        split = split.withColumn("bytes", F.expr(f"substring(bytes, int(left - l + 1), int(l + {gram} + r))"))
        split = stored(split.select("doc_id", "row_key", "pos", "n", "bytes", F.col("l").alias("left"), F.col("lo").alias("near"), F.col("hi").alias("far"),
                                    F.xxhash64("g", "lo", "hi", "core").alias("g"), F.xxhash64("bytes", "l", "r", F.lit(1)).alias("around")), "halves")
        counts = split.groupBy("g", "around").agg(F.sum("n").alias("total"), F.min(one).alias("first"))
        both = stored(split.join(counts, ["g", "around"]), "both")
        release(groups, split)
        spans.append(stored(both.where("total > 1 and n = 1").select(
            "doc_id", "row_key", (F.col("pos") - F.col("left")).alias("start"),
            (F.col("pos") - F.col("left") + F.length("bytes")).alias("end")), "spans"))
        level = stored(both.where(one.eqNullSafe(F.col("first"))).drop("n", "first").withColumnRenamed("total", "n")
                       .dropDuplicates(["g", "around"]), "surroundings")
        release(both)


def _cut(texts: list[bytes], spans: list[list[dict] | None]) -> Iterator[tuple[bytes, int, int]]:
    """What is left of each text, how many bytes went, and in how many runs."""
    for t, own in zip(texts, spans):
        kept, at, runs = [], 0, 0
        for a, b in sorted((s["start"], min(s["end"], len(t))) for s in own or ()):
            if a > at or not runs:
                kept.append(t[at:a])
                runs += 1
                at = b
            else:
                at = max(at, b)
        kept.append(t[at:])
        left = b"".join(kept)
        yield left, len(t) - len(left), runs


def _with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``spans`` of each row; a document has at most a span per
    anchor and partner group."""
    spans = spans.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = spans.withColumnsRenamed({"doc_id": "own_id", "row_key": "own_key"})
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), _row_key(id_col, text_col))
    return rows.join(spans, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("row_key") == F.col("own_key")), "left").select("row", "spans")


def repeat_digest(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            for rows, texts in text_blocks(batch, "text"):
                done = [(len(t), gone, runs, hashlib.sha256(left).hexdigest())
                        for t, (left, gone, runs) in zip(texts, _cut(texts, spans[rows].to_pylist()))]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*done), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[rows], *columns],
                                                 ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    plain = document_columns(docs, id_col, text_col)
    found = _with_spans(plain, repeated_spans(plain, length), "doc_id", "text")
    return found.select("row.doc_id", "row.text", "spans").mapInArrow(
        work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with what is left of each text. A character that was cut in two goes whole."""
    schema = docs.schema
    at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.column("row").flatten()
            texts = columns[at].cast(pa.binary()).to_pylist()
            left = [t if t is None or not s else next(_cut([t], [s]))[0].decode("utf-8", "ignore").encode()
                    for t, s in zip(texts, batch.column("spans").to_pylist())]
            columns[at] = pa.array(left, pa.binary()).cast(columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    spans = repeated_spans(docs, length, gram, id_col, text_col)
    return _with_spans(docs, spans, id_col, text_col).mapInArrow(work, schema)


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 400-byte string of all documents that starts in two places goes in both."""
    return repeat_digest(read(spark, sf_dir, "documents"))
