"""Row synthesis by a conditional chain: rows that need not exist in the source.

Within a batch, a column's value is drawn given the ``ORDER`` columns before it, as a model of lines
draws the next token given the last ones. Where a context was seen fewer than ``least`` times, the
draw backs off to a shorter one, at last to the column alone. Batches are independent.

All counts come from one pass: every row gives each column's (column, context, value), and Spark
sums them, so the table that the chain reads holds distinct combinations only. Values of a context
are ordered and take ranges as wide as their counts; a draw is integer arithmetic on (seed, batch, column,
draw) modulo the context's total and picks the value whose range holds it, so the rows are
the same on any layout and in SQL. A column costs one equi-join of the draws with the contexts and one
with their ranges; draws never meet values of another context. Values travel as text and are cast back.

``synthesize_valid`` keeps the lines that a validator accepts and draws the others again, at
most ``rounds`` times; the status tells per batch what was requested, generated, valid, redrawn and is short.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeflow import constants as K
from citeflow.operators.synthesis import BROADCAST_BYTES, draw_sql
from citeflow.session import scratch_path

ORDER = 2
#: rows that a context needs, else a shorter one is used
LEAST = 20
#: times that lines are drawn at most
ROUNDS = 4


def _written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: a short plan for what follows, and nothing to lose."""
    path = scratch_path(df.sparkSession, "chain")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chain_counts(source: DataFrame, batches: Sequence[Sequence[str]] = K.BATCHES) -> DataFrame:
    """``batch, place, c2, c1, value, n, lo, total`` for every back-off level: contexts (null where the level
    has none; ``level`` columns), their values by text with ranges ``lo`` to ``lo + n`` of ``total``; a written table."""
    cells = []
    for b, cols in enumerate(batches):
        text = [F.col(c).cast("string") for c in cols]
        for k in range(len(cols)):
            cells.append(F.struct(F.lit(b).alias("batch"), F.lit(k).alias("place"),
                                  (text[k - 2] if k > 1 else F.lit(None).cast("string")).alias("c2"),
                                  (text[k - 1] if k > 0 else F.lit(None).cast("string")).alias("c1"), text[k].alias("value")))
    whole = source.select(F.explode(F.array(*cells)).alias("s")).select("s.*").groupBy("batch", "place", "c2", "c1", "value").agg(F.count("*").alias("n"))
    whole = _written(whole)
    levels = []
    for level in range(ORDER + 1):
        keys = ["c1"] if level == 1 else ["c2", "c1"] if level == 2 else []
        rows = whole.where(F.col("place") >= level).groupBy("batch", "place", *keys, "value").agg(F.sum("n").alias("n"))
        for c in ("c2", "c1"):
            if c not in keys:
                rows = rows.withColumn(c, F.lit(None).cast("string"))
        levels.append(rows.select(F.lit(level).alias("level"), "batch", "place", "c2", "c1", "value", "n"))
    both = reduce(DataFrame.unionByName, levels)
    of = ["level", "batch", "place", "c2", "c1"]
    run = Window.partitionBy(*of).orderBy(F.asc_nulls_first("value")).rowsBetween(Window.unboundedPreceding, -1)
    return _written(both.withColumn("lo", F.coalesce(F.sum("n").over(run), F.lit(0))).withColumn("total", F.sum("n").over(Window.partitionBy(*of))))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def chain_lines(counts: DataFrame, draws: DataFrame, batch: int, cols: Sequence[str], seed: int = 42, least: int = LEAST) -> DataFrame:
    """``draws`` (``slot, draw``) with a text column for each of ``cols``, drawn one after another."""
    rows = draws
    for k in range(len(cols)):
        of = counts.where((F.col("batch") == batch) & (F.col("place") == k))
        rows = rows.withColumn("_u", F.expr(draw_sql("draw", batch * 1000 + k, seed)))
        found = rows.withColumns({"_k2": F.col(f"_v{k - 2}") if k > 1 else F.lit(None).cast("string"), "_k1": F.col(f"_v{k - 1}") if k > 0 else F.lit(None).cast("string")})
        # the longest context that was seen often enough; the empty one always serves
        totals = []
        for level in range(1, min(k, ORDER) + 1):
            seen = of.where((F.col("level") == level) & (F.col("total") >= least) & (F.col("lo") == 0)).select("c2", "c1").distinct()
            names = {"c2": f"_s2{level}", "c1": f"_s1{level}"}
            seen = seen.withColumnsRenamed(names).withColumn(f"_ok{level}", F.lit(True))
            on = _same("_k1", f"_s1{level}") & (_same("_k2", f"_s2{level}") if level == 2 else F.lit(True))
            found = found.join(seen, on, "left").drop(*names.values())
            totals.append(f"_ok{level}")
        level = reduce(lambda a, b: F.when(F.col(b[1]), b[0]).otherwise(a), enumerate(totals, 1), F.lit(0))
        found = found.withColumn("_level", level).drop(*totals)
        found = found.withColumns({"_c1": F.when(F.col("_level") >= 1, F.col("_k1")), "_c2": F.when(F.col("_level") == 2, F.col("_k2"))})
        ranges = of.select(F.col("level").alias("_level"), F.col("c2").alias("_r2"), F.col("c1").alias("_r1"), F.col("value").alias(f"_v{k}"), "n", "lo", "total")
        at = F.col("_u") % F.col("total")
        hit = (found.alias("f").join(ranges.alias("r"), (F.col("f._level") == F.col("r._level")) & _same("_c2", "_r2") & _same("_c1", "_r1")
                                     & (at >= F.col("lo")) & (at < F.col("lo") + F.col("n"))))
        rows = hit.select("slot", "draw", *[f"_v{i}" for i in range(k + 1)])
        if k % 3 == 2:  # short plans: a few thousand narrow rows
            rows = _written(rows)
    return rows.select("slot", "draw", *[F.col(f"_v{i}").alias(c) for i, c in enumerate(cols)])


def _slots(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id").alias("slot"), F.col("id").alias("draw"))


def _typed(lines: DataFrame, source: DataFrame, cols: Sequence[str]) -> DataFrame:
    return lines.withColumns({c: F.col(c).cast(source.schema[c].dataType) for c in cols})


def pair_validator(source: DataFrame, pairs: Sequence[tuple[str, str]]) -> Callable[[DataFrame], DataFrame]:
    """A line is valid if each pair of its values stands together in some row of the source. The pairs
    are columns that the chain does not draw from one another; only distinct pairs are kept."""
    known = []
    for i, (a, b) in enumerate(pairs):
        seen = source.select(F.col(a).cast("string").alias(f"_a{i}"), F.col(b).cast("string").alias(f"_b{i}")).distinct()
        known.append(_written(seen))

    def check(lines: DataFrame) -> DataFrame:
        for i, ((a, b), seen) in enumerate(zip(pairs, known)):
            if a in lines.columns and b in lines.columns:
                lines = lines.join(seen, _same(a, f"_a{i}") & _same(b, f"_b{i}"), "left_semi")
        return lines

    return check


def synthesize_valid(source: DataFrame, validator: Callable[[DataFrame], DataFrame] | None = None, batches: Sequence[Sequence[str]] = K.BATCHES,
                     n: int = K.SYNTH_LINES, seed: int = 42, rounds: int = ROUNDS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``draw_id`` and up to ``n`` rows that the validator accepts in every batch (lines of the batches
    side by side), and the status by batch: ``requested, generated, valid, redrawn, short``.

    ``validator`` takes lines of one batch (text columns) and returns those that are valid. Slot s is
    drawn as number ``s + round * n``; a slot that is valid keeps its line."""
    spark = source.sparkSession
    counts = chain_counts(source, batches)
    kept, status = [], []
    for b, cols in enumerate(batches):
        cols, todo, done, generated = list(cols), _slots(spark, n), None, 0
        for turn in range(rounds if validator else 1):
            open_slots = todo.count() if turn else n
            if not open_slots:
                break
            generated += open_slots
            lines = _written(chain_lines(counts, todo, b, cols, seed, least))
            good = _written(validator(lines)) if validator else lines
            done = good if done is None else done.unionByName(good)
            left = todo.join(good.select("slot"), "slot", "left_anti")
            todo = _written(left.withColumn("draw", F.col("draw") + n))
        done = _written(done) if done is not None else chain_lines(counts, todo, b, cols, seed, least)
        valid = done.count()
        status.append((b, n, generated, valid, max(0, generated - n), n - valid))
        kept.append(_typed(done.drop("draw"), source, cols))
    rows = reduce(lambda x, y: x.join(y, "slot"), kept)
    order = [c for c in source.columns if any(c in x for x in batches)]
    table = spark.createDataFrame(status, "batch int, requested long, generated long, valid long, redrawn long, short long")
    return rows.select(F.col("slot").alias("draw_id"), *order), table


def unseen_share(synthetic: DataFrame, source: DataFrame, batches: Sequence[Sequence[str]] = K.BATCHES) -> DataFrame:
    """Per batch: ``generated`` lines, and how many stand in no row of the source (``unseen``)."""
    synthetic, parts = _written(synthetic), []
    for b, cols in enumerate(batches):
        made = synthetic.groupBy(*cols).agg(F.count("*").alias("n"))
        size = synthetic.count() * len(cols) * 64
        own = source.select(*[F.col(c).alias(f"_{c}") for c in cols])
        lines = made.select(*cols)
        lines = F.broadcast(lines) if size <= BROADCAST_BYTES else lines  # at most the lines made
        # of the source only rows that equal a made line go on, at most those lines from each task
        there = own.join(lines, reduce(lambda x, y: x & y, (own[f"_{c}"].eqNullSafe(lines[c]) for c in cols)), "left_semi").distinct()
        new = made.join(there, reduce(lambda x, y: x & y, (made[c].eqNullSafe(there[f"_{c}"]) for c in cols)), "left_anti")
        parts.append(made.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("generated")).select(
            F.lit(b).alias("batch"), "generated", new.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar().alias("unseen")))
    return reduce(DataFrame.unionByName, parts)
