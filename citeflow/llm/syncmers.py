"""Document fingerprints from closed syncmers, with DataFrame functions only.

A text is its sequence of words (ideographs and Thai or kana letters are words of their
own). A k-mer is ``K`` words; its inner substrings are the ``K - S + 1`` runs of ``S`` words.
It is chosen if the least hash of its inner substrings lies at its first or last place.
Whether a k-mer is chosen depends on its own words only, so a passage gives the same anchors
wherever it stands, and any ``K - S`` neighbouring k-mers hold at least one.

The fingerprint holds every chosen k-mer of the text, in order of position, as links: the
hash of an anchor, of the anchor before it and of the distance between the two (the first: its
own hash alone). A link that two texts share is thus two anchors that match at one offset.
The likeness of two fingerprints is the number of distinct links in common by that in either.
A common link whose rank among the common ones differs between the texts by more than ``DRIFT`` of
their number stands in a passage that moved, and counts half. Ranks among common links do
not change with what is inserted, deleted or edited between them.

Results: a null or empty text, or one of white space only, has an empty fingerprint; a text
of fewer than ``K`` words has its whole sequence as its only anchor; two empty fingerprints
are alike (1), an empty and another are not (0); a link that a text repeats counts once, where it
first stands; rows with a null id come first; rows with one
id follow one another by a hash of their text; with a single row the next document is the
row itself; an empty input gives no rows; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeflow.llm.common import document_columns, partitions_for, read

K, S = 5, 2
#: a common link has moved if its rank differs by more than one of so many parts
DRIFT = 8
#: rows that follow one another in one window; the document order is cut into ranges of about so many
RANGE_ROWS = 4000
MOST_RANGES = 10_000
SCRIPTS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}"
WORD = rf"[{SCRIPTS}]|[^\s{SCRIPTS}]+"


def _with_words(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Adds ``<prefix>_w`` (word hashes) and ``<prefix>_g`` (hashes of S neighbouring words).
    Each stands in its own projection: lambdas below read them many times."""
    words = F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0)), lambda word: F.xxhash64(word))
    df = df.withColumn(f"{prefix}_w", words)
    w = F.col(f"{prefix}_w")
    index = F.sequence(F.lit(0), F.greatest(F.size(w) - S, F.lit(0)))
    return df.withColumn(f"{prefix}_g", F.transform(index, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(S)])))


def _anchors(prefix: str) -> Column:
    """``array<struct<pos, hash>>`` of the chosen k-mers; ``pos`` counts words."""
    w, g = F.col(f"{prefix}_w"), F.col(f"{prefix}_g")
    last = K - S

    def chosen(i: Column) -> Column:
        middle = F.least(*[F.get(g, i + j) for j in range(1, last)])
        return (F.get(g, i) <= middle) | (F.get(g, i + last) <= middle) | (F.get(g, i) == F.get(g, i + last))

    places = F.filter(F.sequence(F.lit(0), F.greatest(F.size(w) - K, F.lit(0))), chosen)
    picked = F.transform(places, lambda i: F.struct(i.alias("pos"), F.xxhash64(*[F.get(w, i + j) for j in range(K)]).alias("hash")))
    whole = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(w).alias("hash")))
    nothing = F.filter(whole, lambda _: F.lit(False))
    return F.when(F.size(w) == 0, nothing).when(F.size(w) < K, whole).otherwise(picked)


def _with_links(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Adds ``<prefix>_links``: the links between neighbouring anchors, in order of position."""
    df = _with_words(df, text, prefix).withColumn(f"{prefix}_a", _anchors(prefix))
    anchors = F.col(f"{prefix}_a")

    def link(own: Column, i: Column) -> Column:
        before = F.get(anchors, i - 1)
        return F.when(i == 0, own["hash"]).otherwise(F.xxhash64(before["hash"], own["hash"], own["pos"] - before["pos"]))

    return df.withColumn(f"{prefix}_links", F.transform(anchors, link)).drop(f"{prefix}_w", f"{prefix}_g", f"{prefix}_a")


def _written(links: Column) -> Column:
    """Links as text: their eight bytes each, one after another, in base 64."""
    return F.replace(F.base64(F.unhex(F.array_join(F.transform(links, lambda x: F.lpad(F.hex(x), 16, "0")), ""))), F.lit("\r\n"), F.lit(""))


def closed_syncmers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_words, anchors`` (``array<struct<pos, hash>>``, by position)."""
    df = _with_words(document_columns(docs, id_col, text_col), "text", "own")
    return df.select("doc_id", F.size("own_w").alias("n_words"), _anchors("own").alias("anchors"))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Adds ``name``: the likeness (0 to 1) of the link arrays ``a`` and ``b``."""

    def ranked(links: Column) -> Column:
        return F.sort_array(F.transform(links, lambda x, i: F.struct(x.alias("link"), i.alias("rank"))))

    # the same links twice, in the order of either text; sorted by link they stand side by side
    df = df.withColumn("in_a", F.array_intersect(a, b)).withColumn("in_b", F.array_intersect(b, a))
    common = F.size("in_a")
    drifts = F.zip_with(ranked(F.col("in_a")), ranked(F.col("in_b")), lambda x, y: F.abs(x["rank"] - y["rank"]))
    moved = F.size(F.filter(drifts, lambda d: d * DRIFT > F.greatest(common, F.lit(DRIFT))))
    either = F.size(F.array_union(a, b))
    share = F.when(either == 0, F.lit(1.0)).otherwise((common - moved / 2) / F.greatest(either, F.lit(1)))
    return df.withColumn(name, share).drop("in_a", "in_b")


def _ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``ord`` (ids, nulls first) and ``range``; and for the first ``ord`` of each range,
    the range before it (of the first: the last) - one row a range, at most ``MOST_RANGES``."""
    spark = docs.sparkSession
    docs = docs.withColumn("ord", F.coalesce("doc_id", F.lit(-(2**63))))
    total = docs.count()
    wanted = min(MOST_RANGES, partitions_for(spark, total, RANGE_ROWS))
    cuts = [i / wanted for i in range(1, wanted)]
    bounds = sorted(set(docs.agg(F.percentile_approx("ord", cuts, 100 * wanted)).first()[0] or []))
    step = max(1, int(len(bounds) ** 0.5))
    coarse = bounds[step - 1::step]
    fine = [bounds[i:i + step] for i in range(0, len(bounds), step)] + [[]]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b < F.col("ord")))

    longs = "array<long>"
    upper = below(F.lit(coarse).cast(longs)) if coarse else F.lit(0)
    table = F.array(*[F.array(*map(F.lit, f)).cast(longs) for f in fine])
    docs = docs.withColumn("upper", upper)
    docs = docs.withColumn("range", F.col("upper") * step + below(F.get(table, F.col("upper")))).drop("upper")
    firsts = sorted(docs.groupBy("range").agg(F.min("ord").alias("ord")).collect())
    before = [(r["ord"], firsts[i - 1]["range"], int(i == 0)) for i, r in enumerate(firsts)]
    return docs, spark.createDataFrame(before, "first_ord long, before int, wraps int")


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` (``doc_id, text, ...``) with ``next_<c>`` for each of ``columns``: that of the next row by
    id, after the last of the first. Ranges of ids are windows of their own; the rows at the
    head of a range are also dealt to the range before, as followers only."""
    docs, before = _ranges(docs)
    copies = F.array(F.struct(F.col("range").alias("at"), F.lit(0).alias("late"), F.lit(False).alias("extra")),
                     F.struct(F.col("before").alias("at"), F.col("wraps").alias("late"), F.lit(True).alias("extra")))
    dealt = (docs.join(F.broadcast(before), F.col("ord") == F.col("first_ord"), "left")
             .withColumn("copy", F.explode(F.filter(copies, lambda c: c["at"].isNotNull())))
             .select(*docs.columns, "copy.at", "copy.late", "copy.extra"))
    order = Window.partitionBy("at").orderBy("late", "ord", F.xxhash64("text"), "text", "extra")
    for c in columns:
        dealt = dealt.withColumn(f"next_{c}", F.lead(c).over(order))
    return dealt.where(~F.col("extra")).drop("at", "late", "extra", "ord", "range")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    The edited text has the last half of its code points replaced by the first as many of the next."""
    docs = document_columns(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    own = _with_links(docs, "text", "own").withColumnRenamed("own_links", "links")
    both = with_next(own, ["text", "links"]).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    both = both.withColumn("edited", edited).select("doc_id", "n_chars", "links", "next_links", "edited")
    both = _with_links(both, "edited", "ed").withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    both = with_likeness(with_likeness(both, "links", "ed_links", "near_edited"), "links", "next_links", "near_next")
    return both.select(
        "doc_id", "n_chars", "edited_sha256", _written(F.col("links")).alias("fingerprint"),
        _written(F.col("ed_links")).alias("edited_fingerprint"), "near_edited", "near_next")


def op8_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints(read(spark, sf_dir, "documents"))
