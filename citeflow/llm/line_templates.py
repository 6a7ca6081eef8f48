"""Line dedup by a log-template tree of fixed depth, with DataFrame functions only.

A line is its tokens between spaces. Tokens with a digit are variable fields. The tree sends
a line to a leaf by its number of tokens and its ``DEPTH`` leading tokens (fields as ``<*>``).
In a leaf, lines that are equal up to their fields are one template; and the leaf's template
takes at each place the token that most of its lines have there, and holds every line that
agrees with it in at least ``SIMILARITY`` of the places; other places are variable.

A template recurs if its lines stand in documents of at least ``SHAPES`` shapes (number of
lines, and number of tokens in steps of an eighth of an octave). Copies of one document, also
slightly edited ones, have one shape or a few, so what a group of copies repeats within itself is
left to the near-duplicate stage; a line that recurs across different documents goes.

Counts are combined before each shuffle, over (line, shape) and then over lines; texts move
once, to meet the lines that they lose. Lines are told by 64-bit hashes.

Results: blank lines are kept, and so are lines in which fewer than half of the tokens are
constant; a null text stays null, an empty one empty; the other lines keep their order;
repeated rows are documents of one shape; an empty input gives no rows; other columns of the
input are left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.llm.common import Scratch, document_columns, read, release, stored

DEPTH = 3
SIMILARITY = 0.7
SHAPES = 8
#: documents whose lines are looked at token by token are told to the scan by so many slots
SLOTS = 1 << 16
FIELD = r"(?<!\S)[^\s\d]*+\d\S*"


def _masked(line: Column) -> Column:
    """Fields as ``<*>``; lines without digits, most of them, are only looked at."""
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, FIELD, "<*>")).otherwise(line)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _count(line: Column, part: str) -> Column:
    return ((F.length(line) - F.length(F.replace(line, F.lit(part), F.lit("")))) / len(part)).cast("int")


def _leaf(line: Column, tokens: Column) -> Column:
    return F.xxhash64(tokens, F.substring_index(line, " ", DEPTH))


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def told_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``id, key, shape, lines``: of each line its hash (fields masked), its leaf, and whether
    it can be a template's (not blank, at least half of its tokens constant). Texts are read here
    once; what follows works on these numbers."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), _row_key(id_col, text_col).alias("key"), _lines(text).alias("l")).where("l is not null")
    rows = rows.select("id", "key", F.transform("l", lambda l: F.struct(_masked(l).alias("l"), (_count(l, " ") + 1).alias("tokens"))).alias("l"))
    told = F.transform("l", lambda s: F.struct(
        F.xxhash64(s["l"]).alias("line"), _leaf(s["l"], s["tokens"]).alias("leaf"),
        ((F.length(F.trim(s["l"])) > 0) & (F.when(F.contains(s["l"], F.lit("<*>")), 2 * _count(s["l"], "<*>")).otherwise(0) <= s["tokens"])).alias("some")))
    tokens = F.aggregate("l", F.lit(0), lambda n, s: n + s["tokens"])
    shape = F.xxhash64(F.size("l"), F.floor(F.log2(F.greatest(tokens, F.lit(1)).cast("double")) * 8))
    return rows.select("id", "key", shape.alias("shape"), told.alias("lines"))


def recurring_lines(docs: DataFrame, told: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shapes: int = SHAPES, similarity: float = SIMILARITY) -> DataFrame:
    """``line``: hashes of all lines of recurring templates. ``told`` is the stored ``told_lines``."""
    rows = told.select("shape", F.explode(F.array_distinct(F.filter("lines", lambda l: l["some"]))).alias("l"))
    counted = stored(rows.select("shape", "l.line", "l.leaf").groupBy("leaf", "line", "shape").agg(F.count("*").alias("docs")), "lines")
    exact = counted.groupBy("leaf", "line").agg(F.count("*").alias("shapes")).where(F.col("shapes") >= shapes)
    exact = stored(exact.select("leaf", "line"), "recurring")

    # leaves in which the lines that are left could make a template together
    rest = counted.join(exact, ["leaf", "line"], "left_anti")
    leaves = (rest.groupBy("leaf", "shape").agg(F.min("line").alias("low"), F.max("line").alias("high"))
              .groupBy("leaf").agg(F.count("*").alias("shapes"), F.min("low").alias("low"), F.max("high").alias("high"))
              .where((F.col("shapes") >= shapes) & (F.col("low") < F.col("high"))).select("leaf"))
    leaves = stored(leaves, "leaves")
    # one place of each of their lines, and the documents that hold those
    places = told.select("key", F.posexplode("lines").alias("at", "l")).where("l.some").select("key", "at", "l.leaf", "l.line")
    places = places.join(leaves, "leaf", "left_semi").join(exact, ["leaf", "line"], "left_anti")
    places = stored(places.groupBy("leaf", "line").agg(F.min(F.struct("key", "at")).alias("p")).select("leaf", "line", "p.*"), "places")
    release(leaves)
    slots = places.select(F.pmod("key", F.lit(SLOTS)).alias("slot")).distinct()  # at most SLOTS rows
    texts = docs.select(_row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(F.broadcast(slots), F.pmod("key", F.lit(SLOTS)) == F.col("slot"), "left_semi")
    texts = texts.select("key", F.posexplode(_lines(F.col("text"))).alias("at", "l")).join(places, ["key", "at"])
    texts = texts.dropDuplicates(["leaf", "line"]).select("leaf", "line", F.split(_masked(F.col("l")), " ", -1).alias("tokens"))
    texts = stored(texts, "leaf-lines")
    votes = texts.select("leaf", F.posexplode("tokens").alias("place", "token")).groupBy("leaf", "place", "token").agg(F.count("*").alias("n"))
    most = votes.groupBy("leaf", "place").agg(F.max(F.struct("n", "token")).alias("top"))
    templates = most.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("place", "top.token"))).alias("template"))
    agree = F.size(F.filter(F.zip_with("tokens", F.col("template.token"), lambda a, b: a.eqNullSafe(b)), lambda same: same))
    held = texts.join(templates, "leaf").where(agree >= similarity * F.size("tokens")).select("leaf", "line")
    wide = (counted.join(held, ["leaf", "line"]).groupBy("leaf", "shape").agg(F.count("*").alias("n"))
            .groupBy("leaf").agg(F.count("*").alias("shapes")).where(F.col("shapes") >= shapes).select("leaf"))
    general = held.join(wide, "leaf", "left_semi").select("line")
    return stored(exact.select("line").unionByName(general).distinct(), "dropped")


def _with_drops(docs: DataFrame, id_col: str, text_col: str, shapes: int, similarity: float) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``drops``: the numbers of the lines it loses (null: none)."""
    with Scratch() as scratch:
        told = stored(told_lines(docs, id_col, text_col), "told")
        dropped = recurring_lines(docs, told, id_col, text_col, shapes, similarity)
        # a line of a third of all documents is one key of this join: its other side is one row
        own = told.select("id", "key", F.posexplode("lines").alias("at", "l")).where("l.some").select("id", "key", "at", "l.line")
        own = own.join(dropped, "line", "left_semi").groupBy("id", "key").agg(F.collect_set("at").alias("drops"))
        own = scratch.keep(stored(own.withColumnsRenamed({"id": "own_id", "key": "own_key"}), "drops"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), _row_key(id_col, text_col).alias("key"))
    return rows.join(own, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("key") == F.col("own_key")), "left").select("row", "drops")


def _kept(text: Column, drops: Column) -> Column:
    """The text of the lines that stay."""
    left = F.filter(_lines(text), lambda _, i: ~F.array_contains(drops, i))
    return F.when(drops.isNull(), text).otherwise(F.array_join(left, "\n"))


def without_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            shapes: int = SHAPES, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of ``text_col``."""
    both = _with_drops(docs, id_col, text_col, shapes, similarity)
    kept = _kept(F.col(f"row.`{text_col}`"), F.col("drops"))
    return both.select(*[kept.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_lines, n_dropped, kept_chars, kept_sha256``."""
    docs = document_columns(docs, id_col, text_col)
    both = _with_drops(docs, "doc_id", "text", SHAPES, SIMILARITY)
    text = F.coalesce("row.text", F.lit(""))
    both = both.select("row.doc_id", (_count(text, "\n") + 1).cast("long").alias("n_lines"),
                       F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"), _kept(text, F.col("drops")).alias("kept"))
    return both.select("doc_id", "n_lines", "n_dropped",
                       F.length("kept").cast("long").alias("kept_chars"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_log_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of templates that recur across them."""
    return line_report(read(spark, sf_dir, "documents"))
