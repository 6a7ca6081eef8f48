"""op1: how many words are exchange-clustered, and what counting their bigrams holds in memory."""

import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from llm_helpers import documents
from citeflow.llm import brown_lm


def test_4000_words_are_clustered_by_exchange(spark, monkeypatch):
    seen, whole = [], brown_lm.exchange_classes

    def noted(pairs, n_words):
        seen.append(n_words)
        return whole(pairs, n_words, 1)

    monkeypatch.setattr(brown_lm, "exchange_classes", noted)
    rows = [(i, " ".join(f"w{(i * 400 + j) % 4000}" for j in range(800))) for i in range(40)]
    assert brown_lm.class_model_scores(documents(spark, rows)).count() == 40
    assert seen == [4000]


@pytest.mark.parametrize("cells", [1 << 20, 5])
def test_bigrams_are_counted_sparsely(monkeypatch, cells):
    monkeypatch.setattr(brown_lm, "CELLS", cells, raising=False)
    rng = np.random.default_rng(1)
    words = np.unique(rng.integers(1, 2**62, 4096).astype(np.uint64))
    frequent = brown_lm._Frequent(words)
    batches, want = [], Counter()
    for _ in range(3):
        tokens = rng.integers(0, len(words), 500)
        ids = frequent(words)[tokens]
        want.update(zip([frequent.stop, *ids[:-1].tolist()], ids.tolist()))
        batches.append(pa.RecordBatch.from_pydict({"words": [words.tobytes()], "tokens": [brown_lm._shrink(tokens)], "held": [[False]], "sizes": [[500]]}))
    tracemalloc.start()
    sent = list(brown_lm._pairs(SimpleNamespace(value=frequent), 4)(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20
    got = Counter()
    width = frequent.stop + 1
    for batch in brown_lm._sum_pairs(width)(iter(sent)):
        for v, w, n in zip(*(batch.column(k).to_pylist() for k in ("v", "w", "n"))):
            assert (v, w) not in got
            got[v, w] = n
    assert got == want
