"""Look-alike row synthesis by column batches.

The columns are split into batches (the original used two batches of nine).
Within a batch, rows keep their joint distribution; across batches they are
independent, exactly as when each batch is learnt and generated on its own and
the generated lines are joined side by side.

The distinct tuples of a batch are sorted by value and take consecutive ranges as
wide as their counts; a draw is a position in 0..N-1 and picks the tuple whose range
holds it. Positions come from integer arithmetic on (seed, batch, draw), so the same
rows come out whatever the files, partitions or cores are. The ranges are cut into
buckets, by which the few draws meet them in an equi-join; one grouping by draw id
zips the batches. Every step is distributed and the work is O(N + n).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeflow import constants as K

# bytes of a table that is bounded by a parameter, up to which it is broadcast
BROADCAST_BYTES = 32 << 20
#: buckets into which the positions of a batch are cut
RANGES = 1024
PRIME = 2147483647


def draw_sql(draw: str, batch: int, seed: int) -> str:
    """A number below 2^62 for a draw, as SQL text that means the same in most engines: squares
    modulo a prime, so neighbouring draws and batches are unrelated."""
    x = f"(({draw} + 1) * 16807 + {seed % PRIME} * 7919 + {batch + 1} * 104729) % {PRIME}"
    for step in range(3):
        x = f"(({x}) * ({x}) + {1013904223 % PRIME} + {batch * 7 + step}) % {PRIME}"
    return f"(({x}) * 2147483648 + ({x}) * 48271 % {PRIME})"


def _tuple_ranges(source: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct tuples with their range ``lo`` <= position < ``hi``: a sorted, checkpointed table, summed
    within its partitions, whose totals (a row a partition) are summed in turn."""
    from citeflow.session import reliable_checkpoint
    counted = source.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    ordered = reliable_checkpoint(counted.orderBy(*[F.asc_nulls_first(c) for c in cols]))
    tagged = ordered.withColumn("_mid", F.monotonically_increasing_id()).withColumn("_pid", F.shiftright("_mid", 33))
    totals = tagged.groupBy("_pid").agg(F.sum("_n").alias("_total"))
    totals = totals.select("_pid", (F.sum("_total").over(Window.orderBy("_pid")) - F.col("_total")).alias("_base"))
    run = F.sum("_n").over(Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0))
    return (tagged.withColumn("_run", run).join(totals, "_pid")
            .withColumn("hi", F.col("_base") + F.col("_run")).withColumn("lo", F.col("hi") - F.col("_n"))
            .select(*cols, "lo", "hi"))


def synthesize(source: DataFrame, batches: Sequence[Sequence[str]] = K.BATCHES,
               n: int = K.SYNTH_LINES, seed: int = 42) -> DataFrame:
    """``draw_id`` and n synthetic rows; columns in source order."""
    spark = source.sparkSession
    total = source.count()
    picked = []
    for i, cols in enumerate(batches):
        cols = list(cols)
        width = max(1, -(-total // RANGES))
        ranges = _tuple_ranges(source, cols).withColumn(
            "_bucket", F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"(hi - 1) div {width}"))))
        draws = spark.range(n).select(F.col("id").alias("draw_id"), F.expr(f"{draw_sql('id', i, seed)} % {max(1, total)}").alias("_at"))
        draws = draws.withColumn("_bucket", F.expr(f"_at div {width}"))
        if n * 24 <= BROADCAST_BYTES:  # three numbers a draw
            draws = F.broadcast(draws)
        hit = (F.col("_at") >= F.col("lo")) & (F.col("_at") < F.col("hi"))
        picked.append(ranges.join(draws, "_bucket").where(hit).select("draw_id", *cols))
    zipped = reduce(lambda a, b: a.join(b, "draw_id"), picked)
    order = [c for c in source.columns if any(c in b for b in batches)]
    return zipped.select("draw_id", *order)


def batch_quality(synthetic: DataFrame, source: DataFrame,
                  batches: Sequence[Sequence[str]] = K.BATCHES, requested: int = K.SYNTH_LINES) -> DataFrame:
    """Per batch: lines requested, generated, and valid (tuple present in the
    source), and the valid fraction.

    Synthetic tuples are collapsed to (tuple, count) (at most ``requested`` rows).
    The source is never shuffled: it is semi-joined against that broadcast table
    (a proven size bound), the matching tuples are de-duplicated with a map-side
    partial aggregation (at most ``requested`` rows per task, however hot a tuple
    is), and only those few rows meet the synthetic counts.
    """
    from citeflow.session import reliable_checkpoint
    # the synthetic rows (n of them) are read twice per batch: materialize once
    synthetic = reliable_checkpoint(synthetic)
    parts = []
    for i, cols in enumerate(batches):
        cols = list(cols)
        gen = synthetic.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
        size = gen.agg(F.sum(sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) + 16 for c in cols), F.lit(0)))).first()[0] or 0
        tuples = gen.select(F.struct(*cols).alias("made"))
        tuples = F.broadcast(tuples) if size <= BROADCAST_BYTES else tuples

        def same(left: DataFrame, right: DataFrame):
            return reduce(lambda a, b: a & b, (left[c].eqNullSafe(right[f"made.{c}"]) for c in cols))

        own = source.select(*cols)
        present = own.join(tuples, same(own, tuples), "left_semi").distinct().select(F.struct(*cols).alias("made"))
        valid = gen.join(present, same(gen, present), "left_semi")
        parts.append(gen.agg(F.sum("n").alias("generated")).select(
            F.lit(i).alias("batch"), F.lit(requested).alias("requested"), "generated",
            valid.select(F.coalesce(F.sum("n"), F.lit(0))).scalar().alias("valid")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("valid_fraction", F.col("valid") / F.col("requested"))
