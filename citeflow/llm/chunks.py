"""Token ids of whole texts through a bounded cache of white-space chunks.

Both public byte-pair vocabularies used here never merge across a step from other
characters to white space, so a text's ids are those of its chunks one after another.
Chunks repeat a lot: each distinct chunk of a block is encoded once, and the ids of the
texts are gathered from them without a loop over tokens.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from citeflow.llm.common import SPACE, ragged


def _after_wide_space(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before ``at`` is white space outside ASCII."""
    pad = np.concatenate([np.zeros(3, np.uint8), buf])
    p1, p2, p3 = pad[at + 2], pad[at + 1], pad[at]
    two = (p2 == 0xC2) & ((p1 == 0x85) | (p1 == 0xA0))
    general = (p3 == 0xE2) & (p2 == 0x80) & (((p1 >= 0x80) & (p1 <= 0x8A)) | np.isin(p1, [0xA8, 0xA9, 0xAF]))
    others = ((p3 == 0xE1) & (p2 == 0x9A) & (p1 == 0x80)) | ((p3 == 0xE2) & (p2 == 0x81) & (p1 == 0x9F)) | ((p3 == 0xE3) & (p2 == 0x80) & (p1 == 0x80))
    return two | general | others


def split_before_space(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Chunks that begin where white space follows something else (so white space leads its
    word), and the chunk range of each text. Texts do not share chunks."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    space = SPACE[buf]
    first = np.zeros(len(buf), bool)
    cut = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    first[cut[~_after_wide_space(buf, cut)]] = True
    first[at[:-1][np.diff(at) > 0]] = True
    starts = np.flatnonzero(first)
    offsets = np.append(starts, len(buf)).astype(np.int32)
    chunks = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buf)])
    return chunks, np.searchsorted(starts, at)


#: 1: ASCII letters; 2: other ASCII but the apostrophe (it may begin a contraction); 0: the rest
KIND = np.zeros(256, np.int8)
KIND[:128] = 2
KIND[[*range(65, 91), *range(97, 123)]] = 1
KIND[39] = 0
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def split_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Runs without ASCII white space, cut between ASCII letters and other ASCII, A-Z lower-cased,
    and the range of each text: for vocabularies that lower-case, drop white space and keep
    letters apart from the rest. Blocks that may hold special tokens are not cut or folded."""
    raw = b"\n".join(texts)
    buf = np.frombuffer(raw, np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)]).astype(np.int64)
    word = ~SPACE[buf]
    first = word.copy()
    first[1:] &= ~word[:-1]
    if b"<|" not in raw:
        kind = KIND[buf]
        first[1:] |= (kind[1:] + kind[:-1] == 3) & word[1:] & word[:-1]
        buf = FOLD[buf]
    starts = np.flatnonzero(first)
    kept = np.ascontiguousarray(buf[word])
    offsets = np.append(np.flatnonzero(first[word]), len(kept)).astype(np.int32)
    runs = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    return runs, np.searchsorted(starts, at)


class ChunkEncoder:
    """Ids of blocks of texts; the cache holds at most ``limit`` chunks and starts anew when full."""

    def __init__(self, split: Callable, encode: Callable[[list[bytes]], list[bytes]], limit: int = 300_000):
        self.split, self.encode, self.limit = split, encode, limit
        self.cache: dict[bytes, bytes] = {}

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids as unsigned 32-bit integers, and the id range of each text."""
        chunks, bounds = self.split(texts)
        if not len(chunks):
            return np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        coded = chunks.dictionary_encode()
        keys = coded.dictionary.to_pylist()
        cache = self.cache
        if len(cache) > self.limit:
            cache.clear()
        new = [k for k in keys if k not in cache]
        if new:
            cache.update(zip(new, self.encode(new)))
        found = [cache[k] for k in keys]
        pool = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        firsts = np.cumsum(sizes) - sizes
        index = coded.indices.to_numpy(zero_copy_only=False)
        counts = sizes[index]
        total = np.concatenate([[0], np.cumsum(counts)])
        return pool[ragged(firsts[index], counts)], total[bounds]
