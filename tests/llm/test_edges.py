"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_helpers import CLASHING, EDGES, documents
from citeflow.llm import (brown_lm, forced_bpe, language_id, licenses, line_templates, multi_index, packing, partenum,
                          suffix_dedup, syncmers)


@pytest.fixture(scope="module")
def edges(spark):
    return documents(spark, EDGES).withColumns({c: F.lit(f"extra {c}") for c in CLASHING})


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark, EDGES).where("doc_id < 0").withColumns({c: F.lit("x") for c in CLASHING})


def public(name):
    import public_tokenizers

    return public_tokenizers.path(name)


OPERATORS = {
    "class_model_scores": brown_lm.class_model_scores,
    "bpe_digest": lambda d: forced_bpe.bpe_digest(d, public("byte_bpe_50k.json")),
    "line_report": line_templates.line_report,
    "near_duplicates": partenum.near_duplicates,
    "repeat_digest": suffix_dedup.repeat_digest,
    "fingerprints": syncmers.fingerprints,
    "license_scan": lambda d: licenses.scan(d.select("doc_id", "text"), licenses.train(d)),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_a_row_for_each_row(edges, nothing, name):
    rows = OPERATORS[name](edges).collect()
    ids = sorted(str(r["doc_id"]) for r in rows)
    assert ids == sorted(str(e[0]) for e in EDGES)
    # repeated rows give equal rows
    twice = [r for r in rows if r["doc_id"] == 4]
    assert name == "fingerprints" or twice[0] == twice[1]
    assert OPERATORS[name](nothing).count() == 0


def test_packing_edges(edges, nothing):
    rows = packing.packed_documents(edges, public("word_bpe_49k.json")).collect()
    assert {str(r["doc_id"]) for r in rows} == {str(e[0]) for e in EDGES}
    fill = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= packing.CAPACITY
    assert packing.packed_documents(nothing, public("word_bpe_49k.json")).count() == 0


def test_near_duplicate_edges(edges):
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in partenum.near_duplicates(edges).collect()}
    assert got[1, 0] == 1 and got[2, 0] == 2 and got[3, 0] == 3
    assert got[4, 1] == 4 and got[5, 1] == 4
    assert got[6, 1] == got[7, 1] == 6
    assert got[None, 0] is None


def test_repeats_edges(edges):
    got = {r["doc_id"]: r for r in suffix_dedup.repeat_digest(edges).collect()}
    assert got[1]["n_bytes"] == 0 and got[4]["n_removed"] == 0
    assert got[9]["n_removed"] == got[9]["n_bytes"] and got[10]["n_removed"] == 5000
    assert (got[11]["n_removed"], got[11]["n_spans"]) == (5000, 1)


def test_columns_that_filters_return(spark, edges, nothing):
    for df in (edges, nothing):
        assert suffix_dedup.without_repeats(df).columns == df.columns
        assert line_templates.without_recurring_lines(df).columns == df.columns
    kept = language_id.known_language(edges, language_id.fit_text_model(edges))
    assert kept.columns == edges.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert 4 in ids and 9 in ids
    assert language_id.known_language(nothing, language_id.fit_text_model(nothing)).count() == 0


def test_language_evidence_may_be_null(spark):
    model = language_id.fit_text_model(documents(spark, [(1, "the and of the", "en", "a"), (2, "der und die das", "de", "b"), (3, None, None, None)]))
    rows = spark.createDataFrame([(1, None, None, None), (2, "der und", None, None), (3, "", "de", None), (4, "the of", "xx", "h.example.de"),
                                  (5, "123", None, "nodots")], "key long, text string, declared string, host string")
    got = {r["key"]: r for r in language_id.identify(rows, model).collect()}
    assert got[1]["rejected"] and got[1]["lang"] is None
    assert got[2]["lang"] == "de" and got[4]["lang"] == "en" and got[5]["rejected"]
    pages = spark.createDataFrame([(1, None, None), (2, "nonsense", "<p>the of"), (3, "http://a.de/", '<html class="x" LANG=de>der')], "page_id long, url string, html string")
    assert language_id.identify_pages(pages, model).count() == 3


def test_vector_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [1.0]),
            (8, [0.5, 0.5]), (20, [0.0, 1.0]), (None, [1.0, 1.0]), (40, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in CLASHING})
    got = multi_index.nearest_neighbours(df, F.col("vec_id") % 20 == 0).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert by[0] == [(1, 1.0), (2, 1.0), (8, 0.5), (20, 0.0)]
    assert by[20] == [(8, 0.5), (0, 0.0), (1, 0.0), (2, 0.0)]
    assert set(by) == {0, 20}
    assert multi_index.nearest_neighbours(df.where("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_stages_keep_the_columns(spark, edges):
    docs = edges.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").schema.names == docs.columns
