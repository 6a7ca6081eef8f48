"""Language identification by Bayesian fusion of independent evidence.

    P(lang | all) ~ P(text | lang) * P(declared | lang) * P(suffix | lang) * P(lang | host)

* Text: a byte trigram model per language (the third byte given two, A-Z lower-cased), fitted on
  at most ``FIT_ROWS`` labelled texts a language (those with the least hash of their id, for the
  ``MOST_LANGS`` most frequent labels). Its log
  likelihood counts ``TEMPER`` fold, as neighbouring bytes are not independent.
* Declared language (a page's markup) and address suffix (the last label of the host): how often
  each language bears each value, from the texts' posteriors over all rows, smoothed.
* Host prior: shares of the languages per host, drawn towards those of its domain, of its
  suffix and of all rows in turn, each by ``STRENGTH`` rows. These are grouped sums over all
  rows; a row's own share is taken out of what it is judged by.

Beside the languages stands an unknown one. Its texts are single bytes, as frequent as in all fitted
languages together; it has ``UNKNOWN`` of the prior and bears declared values and suffixes as all rows
do. Text in a language without labels, or in none, has few of a model's trigrams and falls to it.

A row is rejected if its text holds no letter (bytes A-Z, a-z or beyond ASCII) and it declares
nothing known, or if no language reaches ``LEAST`` of the fused probability.

Results: a null text, declaration or address is no evidence; so is a declared value that no
labelled text bears; repeated rows count as often as they stand; without labelled texts every
row is rejected; an empty input gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeflow.llm.common import Scratch, read, stored, text_blocks

FIT_ROWS = 2000
MOST_LANGS = 64
TRIGRAMS = 1 << 18
TEMPER = 0.3
STRENGTH = 8.0
LEAST = 0.5
UNKNOWN = 0.01
SMOOTH = 0.5
#: bytes of text that a task works on at a time
BLOCK = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: ASCII punctuation
MARKS = r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"

MARKUP = r"(?is)<html[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})"
TAGS = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z#0-9]{1,10};"


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigram slots, bigrams and last bytes of the joined texts' trigrams, where each text's grams begin, and how many."""
    joined = b"".join(b"  " + t for t in texts)
    buf = LOWER[np.frombuffer(joined, np.uint8)].astype(np.uint32)
    pair = (buf[:-2] << 8) | buf[1:-1] if len(buf) > 2 else np.zeros(0, np.uint32)
    slot = ((pair * np.uint32(0x9E3779B1)) ^ (buf[2:] * np.uint32(0x85EBCA77))) >> np.uint32(32 - 18) if len(buf) > 2 else pair
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + 2) - sizes - 2
    return slot, pair, buf[2:], starts, sizes


def fit_text_model(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Languages, and log probabilities by language of trigram slots (``P(third | two)`` is the slot's
    count over the pair's) and of pairs; and those of single bytes over all languages. The counts are grouped sums over the fitting rows."""
    rows = labelled.select(F.col(id_col).alias("id"), F.lower(F.col(lang_col)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("id is not null and text is not null and lang is not null")
    counts = rows.groupBy("lang").agg(F.count("*").alias("of")).orderBy(F.desc("of"), "lang").limit(MOST_LANGS)
    # ids first: a share of each language that surely holds its least hashes, then exactly those
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 31)) / float(1 << 31)
    order = Window.partitionBy("lang").orderBy(share, "id")
    picked = (rows.select("id", "lang").join(F.broadcast(counts), "lang").where(share < 1.3 * FIT_ROWS / F.col("of"))
              .withColumn("n", F.row_number().over(order)).where(F.col("n") <= FIT_ROWS).select("id", "lang").distinct())
    rows = rows.join(F.broadcast(picked), ["id", "lang"]).select("lang", "text")  # at most FIT_ROWS * MOST_LANGS ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for part, texts in text_blocks(batch, "text", BLOCK):
                own = langs[part]
                for lang in set(own):
                    slot, pair, _, starts, sizes = _grams([t for t, l in zip(texts, own) if l == lang])
                    keep = np.zeros(len(slot), bool)
                    for s, n in zip(starts.tolist(), sizes.tolist()):
                        keep[s:s + n] = True
                    table = tables.setdefault(lang, np.zeros(TRIGRAMS + 65536, np.int64))
                    table[:TRIGRAMS] += np.bincount(slot[keep], minlength=TRIGRAMS)
                    table[TRIGRAMS:] += np.bincount(pair[keep], minlength=65536)
        for lang, table in tables.items():
            cell = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cell), pa.string()), pa.array(cell), pa.array(table[cell])], ["lang", "cell", "n"])

    counted = rows.mapInArrow(work, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counted["lang"].unique().tolist())  # at most (TRIGRAMS + 65536) cells a language
    tables = np.zeros((len(langs), TRIGRAMS + 65536))
    for i, lang in enumerate(langs):
        own = counted[counted["lang"] == lang]
        tables[i, own["cell"]] = own["n"]
    single = tables[:, TRIGRAMS:].sum(axis=0).reshape(256, 256).sum(axis=0) + SMOOTH
    return langs, np.log(tables[:, :TRIGRAMS] + 1 / 256).astype(np.float32), np.log(tables[:, TRIGRAMS:] + 1.0).astype(np.float32), np.log(single / single.sum())


def _likelihoods(table):
    """``key, letters, likelihood`` (log, per language and of the unknown one, tempered) of each text, whole."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, tri, two, single = table.value
        for batch in batches:
            for rows, texts in text_blocks(batch, "text", BLOCK):
                slot, pair, third, starts, sizes = _grams(texts)
                out = np.zeros((len(texts), len(tri) + 1))
                some = sizes > 0
                for i in range(len(tri) + 1):
                    gain = tri[i][slot].astype(np.float64) - two[i][pair] if i < len(tri) else single[third]
                    sums = np.concatenate([[0.0], np.cumsum(gain)])
                    out[some, i] = sums[starts[some] + sizes[some]] - sums[starts[some]]
                letters = [bool(LETTER[np.frombuffer(t, np.uint8)].any()) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column("key")[rows], pa.array(letters), pa.array((TEMPER * out).tolist(), pa.list_(pa.float64()))],
                                                 ["key", "letters", "likelihood"])

    return work


def _softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    raised = F.transform(scores, lambda s: F.exp(s - top))
    return F.transform(raised, lambda r: r / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def _sums(rows: DataFrame, keys: list[str], n: int, name: str) -> DataFrame:
    """Sums of the posteriors by language for each value of ``keys``."""
    return rows.groupBy(*keys).agg(F.array(*[F.sum(F.col("posterior")[i]) for i in range(n)]).alias(name))


def identify(rows: DataFrame, model: tuple) -> DataFrame:
    """``rows``: ``key, text, declared, host`` (strings; any may be null). Per row: ``key, text_lang,
    lang`` (null if rejected) ``, probability, rejected``."""
    spark = rows.sparkSession
    langs = model[0]
    n = len(langs)
    if not n:
        return rows.select("key", F.lit(None).cast("string").alias("text_lang"), F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("probability"), F.lit(True).alias("rejected"))
    table = spark.sparkContext.broadcast(model)
    host = F.lower(F.col("host"))
    labels = F.split(host, r"\.")
    side = rows.select("key", F.lower("declared").alias("declared"), host.alias("host"),
                       F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".").alias("domain"),
                       F.element_at(labels, -1).alias("suffix"), "text")
    kind = dict(rows.dtypes)["key"]
    # texts go through the model in the scan; what moves on are a few numbers a row
    names = F.array(*map(F.lit, langs))
    known = F.when(F.array_contains(names, F.col("declared")), F.col("declared"))
    packed = side.select(F.struct("key", known.alias("declared"), "host", "domain", "suffix").alias("key"), "text")
    seen = packed.mapInArrow(_likelihoods(table), f"key struct<key:{kind},declared:string,host:string,domain:string,suffix:string>, letters boolean, likelihood array<double>")
    prior_of_unknown = F.lit(float(np.log(UNKNOWN)))
    seen = seen.select("key.*", "letters", F.slice("likelihood", 1, n).alias("likelihood"), (F.get("likelihood", F.lit(n)) + prior_of_unknown).alias("unknown"))
    flat = F.array_repeat(F.lit(1.0 / n), n)
    seen = stored(seen.withColumn("posterior", F.when(F.col("letters"), F.slice(_softmax(F.concat("likelihood", F.array("unknown"))), 1, n)).otherwise(flat)), "likelihoods")

    total = seen.agg(*[F.coalesce(F.sum(F.col("posterior")[i]), F.lit(0.0)) for i in range(n)]).first()
    mass = sum(total) or 1.0
    overall = F.array(*[F.lit((t + 1.0) / (mass + n)) for t in total])
    out = seen
    for key in ("suffix", "domain", "host", "declared"):
        sums = _sums(seen.where(F.col(key).isNotNull()), [key], n, f"n_{key}").withColumnRenamed(key, f"by_{key}")
        out = out.join(sums, F.col(key) == F.col(f"by_{key}"), "left").drop(f"by_{key}")
    prior = overall
    for key in ("suffix", "domain", "host"):
        others = F.zip_with(f"n_{key}", "posterior", lambda a, b: F.greatest(a - b, F.lit(0.0)))
        out = out.withColumn("above", prior).withColumn("others", others)
        size = F.aggregate("others", F.lit(0.0), lambda a, b: a + b)
        drawn = F.zip_with("others", "above", lambda a, b: (a + STRENGTH * b) / (size + STRENGTH))
        out = out.withColumn("prior", F.when(F.col("others").isNull(), F.col("above")).otherwise(drawn))
        prior = F.col("prior")

    def evidence(key: str) -> Column:
        """log P(value | language) from the other rows; the denominator is that of the language."""
        totals = F.array(*[F.lit(float(t) + 1.0) for t in total])
        value = F.zip_with(F.zip_with(f"n_{key}", "posterior", lambda a, b: F.greatest(a - b, F.lit(0.0)) + SMOOTH), totals, lambda a, b: F.log(a / b))
        return F.when(F.col(f"n_{key}").isNull(), F.array_repeat(F.lit(0.0), n)).otherwise(value)

    text = F.when(F.col("letters"), F.col("likelihood")).otherwise(F.array_repeat(F.lit(0.0), n))
    fused = F.zip_with(F.zip_with(text, evidence("declared"), lambda a, b: a + b), F.zip_with(evidence("suffix"), F.transform("prior", lambda p: F.log(p)), lambda a, b: a + b), lambda a, b: a + b)

    def borne(key: str) -> Column:
        """log of the share of all rows that bear the value."""
        rows_with = F.aggregate(f"n_{key}", F.lit(SMOOTH), lambda a, b: a + b)
        return F.when(F.col(f"n_{key}").isNull(), 0.0).otherwise(F.log(rows_with / F.lit(float(mass) + 1.0)))

    neither = F.when(F.col("letters"), F.col("unknown")).otherwise(prior_of_unknown) + borne("declared") + borne("suffix")
    out = out.withColumn("fused", F.concat(fused, F.array(neither)))
    out = out.withColumn("fused", F.slice(_softmax(F.col("fused")), 1, n))
    best = F.array_max("fused")
    lang = F.get(names, (F.array_position("fused", best) - 1).cast("int"))
    by_text = F.aggregate("posterior", F.lit(0.0), lambda a, b: a + b) >= LEAST
    rejected = (~F.col("letters") & F.col("declared").isNull()) | (best < LEAST)
    return out.select("key", F.when(F.col("letters") & by_text, F.get(names, (F.array_position("posterior", F.array_max("posterior")) - 1).cast("int"))).alias("text_lang"),
                      F.when(~rejected, lang).alias("lang"), best.alias("probability"), rejected.alias("rejected"))


def identify_pages(pages: DataFrame, model: tuple) -> DataFrame:
    """Whole pages: markup gives the declared language, the address gives host and suffix."""
    html = F.col("html").cast("string")
    declared = F.nullif(F.regexp_extract(html, MARKUP, 1), F.lit(""))
    host = F.nullif(F.regexp_extract(F.col("url").cast("string"), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit(""))
    rows = pages.select(F.col("page_id").alias("key"), F.regexp_replace(html, TAGS, " ").alias("text"), declared.alias("declared"), host.alias("host"))
    return identify(rows, model)


def known_language(docs: DataFrame, model: tuple) -> DataFrame:
    """``docs`` without the rejected ones. The declared language is ``lang``, the host ``source``. What is
    rejected as it stands is judged again without its punctuation: marks after each word are of no language."""
    key = F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text", "lang", "source").alias("hash"))
    rows = docs.select(key.alias("key"), F.col("text").cast("string").alias("text"), F.col("lang").alias("declared"), F.col("source").alias("host"))
    with Scratch() as scratch:
        first = stored(identify(rows, model).where("rejected").select(F.col("key").alias("_first")).distinct(), "rejected-first")
        again = rows.join(first, F.col("key").eqNullSafe(F.col("_first")), "left_semi").withColumn("text", F.trim(F.regexp_replace("text", MARKS, "")))
        gone = scratch.keep(stored(identify(again, model).where("rejected").select("key.*").distinct(), "rejected"))
    same = F.col("doc_id").cast("long").eqNullSafe(gone["id"]) & (F.xxhash64(docs["text"], docs["lang"], docs["source"]) == gone["hash"])
    return docs.join(gone, same, "left_anti")


def op2_bayes_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, by a text model of the documents' labels."""
    model = fit_text_model(read(spark, sf_dir, "documents"))
    return identify_pages(read(spark, sf_dir, "pages"), model).withColumnRenamed("key", "page_id")
