"""op3: the unknown class has its rows also where most lines are repeats."""

import pytest

from llm_helpers import documents
from citeflow.llm import licenses


class Seen(Exception):
    pass


def test_unknown_rows_do_not_shrink_with_repeats(spark, monkeypatch):
    def noted(paragraphs):
        raise Seen(len(paragraphs))

    monkeypatch.setattr(licenses, "_training_rows", noted)
    rows = [(i, "\n".join(f"line {i * 100 + j}" for j in range(100))) for i in range(50)]
    rows += [(100 + i, "the same line\n" * 10_000) for i in range(40)]
    with pytest.raises(Seen) as got:
        licenses.train(documents(spark, rows))
    assert got.value.args == (licenses.UNKNOWN_ROWS,)
