"""BPE encoding and decoding with forced boundaries.

A pair of bytes that stands inside no token of the vocabulary can never be merged, so a
text may be cut there: no merge crosses the cut, and each side merges as it would alone.
Texts are split as the byte-level pre-tokenizer does, the pieces are cut at every such
pair, each distinct fragment is merged once (lowest rank first), and the ids are put
together again. Decoding gathers the bytes of the ids.

Results: a null or empty text has no ids and decodes to the empty text; the string of a
special token in a text is that token, as in the vocabulary's own library; repeated rows
and equal texts give equal rows; any other column of the input is left out. A text of any
length is worked on whole (a single one larger than a block makes its own block).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from citeflow.llm.chunks import ChunkEncoder, split_before_space
from citeflow.llm.common import document_columns, ragged, read, text_blocks

# The byte-level pre-tokenizer's pattern.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


NO_MERGE = 1 << 60
#: bytes of a fragment from which pairs wait in a heap
LONG = 64


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(odd)) for b in range(256)]


class ForcedBoundaryBpe:
    """A byte-level BPE vocabulary file and its two directions over blocks of texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, added = spec["pre_tokenizer"], spec["added_tokens"]
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError(f"{path}: not a plain byte-level vocabulary")
        alphabet = {c: b for b, c in enumerate(byte_alphabet())}
        vocab = spec["model"]["vocab"]
        as_bytes = {t: bytes(alphabet[c] for c in t) for t in vocab if all(c in alphabet for c in t)}
        self.special = {t["content"]: t["id"] for t in added}
        size = max([*vocab.values(), *self.special.values()]) + 1
        table = [b""] * size
        for t, b in as_bytes.items():
            table[vocab[t]] = b
        for t, i in self.special.items():
            table[i] = t.encode()
        self.token_sizes = np.array([len(b) for b in table], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_pool = np.frombuffer(b"".join(table), np.uint8)
        self.single = [vocab[c] for c in byte_alphabet()]
        #: pair of ids (20 bits each) -> rank and new id (20 bits)
        self.merges: dict[int, int] = {}
        #: pairs of bytes that stand somewhere inside a token
        self.inside = np.zeros((256, 256), bool)
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges[vocab[a] << 20 | vocab[b]] = rank << 20 | vocab[a + b]
        for b in as_bytes.values():
            for pair in zip(b, b[1:]):
                self.inside[pair] = True
        self.joined = {(a << 8) | b for a, b in zip(*np.nonzero(self.inside))}
        self.pattern = regex.compile(PATTERN)
        self.stops = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.fragments: dict[bytes, bytes] = {}
        self.encoder = ChunkEncoder(split_before_space, self._chunks)

    def _merge(self, fragment: bytes) -> bytes:
        """The lowest-ranked pair first, leftmost of equals; no later pair can rank lower."""
        if len(fragment) > LONG:
            return self._merge_long(fragment)
        ids, get = [self.single[b] for b in fragment], self.merges.get
        keys = [get(a << 20 | b, NO_MERGE) for a, b in zip(ids, ids[1:])]
        while keys:
            low = min(keys)
            if low == NO_MERGE:
                break
            i = keys.index(low)
            ids[i:i + 2] = [low & 0xFFFFF]
            del keys[i]
            if i:
                keys[i - 1] = get(ids[i - 1] << 20 | ids[i], NO_MERGE)
            if i < len(keys):
                keys[i] = get(ids[i] << 20 | ids[i + 1], NO_MERGE)
        return pack(f"<{len(ids)}I", *ids)

    def _merge_long(self, fragment: bytes) -> bytes:
        """The same for a fragment of any length: pairs wait in a heap by rank and place, and a linked
        list holds what is left; a pair whose ids have changed meanwhile is passed over."""
        get = self.merges.get
        ids = [self.single[b] for b in fragment]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [(key, i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (key := get(a << 20 | b)) is not None]
        heapify(waiting)
        while waiting:
            key, i = heappop(waiting)
            j = after[i]
            if j >= n or ids[i] < 0 or get(ids[i] << 20 | ids[j]) != key:
                continue
            ids[i], ids[j] = key & 0xFFFFF, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (new := get(ids[i] << 20 | ids[k])) is not None:
                    heappush(waiting, (new, i))
            h = before[i]
            if h >= 0 and (new := get(ids[h] << 20 | ids[i])) is not None:
                heappush(waiting, (new, h))
        left = [x for x in ids if x >= 0]
        return pack(f"<{len(left)}I", *left)

    def _piece(self, piece: bytes) -> bytes:
        """Ids of one pre-token: cut where no token has the pair inside, encode each fragment."""
        joined, start, out = self.joined, 0, []
        for i in range(1, len(piece) + 1):
            if i == len(piece) or (piece[i - 1] << 8 | piece[i]) not in joined:
                fragment = piece[start:i]
                ids = self.fragments.get(fragment)
                if ids is None:
                    if len(self.fragments) > 300_000:
                        self.fragments.clear()
                    self.fragments[fragment] = ids = self._merge(fragment)
                out.append(ids)
                start = i
        return b"".join(out)

    def _text(self, text: str) -> bytes:
        return b"".join(self._piece(p.encode()) for p in self.pattern.findall(text))

    def _chunks(self, chunks: list[bytes]) -> list[bytes]:
        return [self._text(c.decode()) for c in chunks]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the id range of each. Special tokens are cut out first."""
        if self.stops is None or not any(s.encode() in t for s in self.special for t in texts):
            return self.encoder.ids(texts)
        parts: list[bytes] = []
        owner: list[tuple[int, int | None]] = []
        for i, t in enumerate(texts):
            text, last = t.decode(), 0
            for m in self.stops.finditer(text):
                parts.append(text[last:m.start()].encode())
                owner.append((i, self.special[m[0]]))
                last = m.end()
            parts.append(text[last:].encode())
            owner.append((i, None))
        ids, bounds = self.encoder.ids(parts)
        out, sizes = [], np.zeros(len(texts), np.int64)
        for k, (i, stop) in enumerate(owner):
            got = ids[bounds[k]:bounds[k + 1]]
            out += [got] if stop is None else [got, np.array([stop], "<u4")]
            sizes[i] += len(got) + (stop is not None)
        return np.concatenate(out).astype("<u4"), np.concatenate([[0], np.cumsum(sizes)])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each range of ids; bytes that form no character become U+FFFD."""
        sizes = self.token_sizes[ids]
        pool = self.token_pool[ragged(self.token_starts[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds].tolist()
        return [pool[a:b].decode("utf-8", "replace").encode() for a, b in zip(ends, ends[1:])]


_LOADED: dict[str, ForcedBoundaryBpe] = {}


def vocabulary(path: str) -> ForcedBoundaryBpe:
    """One per Python worker; its caches live as long as the worker."""
    if path not in _LOADED:
        _LOADED[path] = ForcedBoundaryBpe(path)
    return _LOADED[path]


def bpe_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, ids`` (array of long) ``, decoded`` (string). See the module for the rules."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for rows, texts in text_blocks(batch, "text"):
                ids, bounds = bpe.encode(texts)
                lists = pa.LargeListArray.from_arrays(bounds, ids.astype(np.int64)).cast(pa.list_(pa.int64()))
                decoded = pa.array(bpe.decode(ids, bounds)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[rows], lists, decoded], ["doc_id", "ids", "decoded"])

    return document_columns(docs, id_col, text_col).mapInArrow(work, "doc_id long, ids array<long>, decoded string")


def bpe_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` without moving the ids: the
    digests are taken in the task that encodes and decodes the text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for rows, texts in text_blocks(batch, "text"):
                ids, bounds = bpe.encode(texts)
                at = bounds.tolist()
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[rows], pa.array(np.diff(bounds), pa.int64()),
                    pa.array([sha(ids[a:b].tobytes()) for a, b in zip(at, at[1:])], pa.string()),
                    pa.array([sha(t) for t in bpe.decode(ids, bounds)], pa.string()),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return document_columns(docs, id_col, text_col).mapInArrow(
        work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the 50k byte-level vocabulary and back."""
    import public_tokenizers

    return bpe_digest(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
