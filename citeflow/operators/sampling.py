"""Limits, top-k, splits.

``limit_stable`` and ``top_k`` order by an explicit key first, so the rows they
return do not depend on partitioning. Spark runs ``orderBy(...).limit(k)`` as
``TakeOrderedAndProject``: each task keeps its own top k and one final task
merges them, i.e. tasks x k rows. That is small for a small k or a small input;
for a large input and a large k (a 10,000-row export over tens of thousands of
tasks) the final task would receive hundreds of millions of rows. Above
``TREE_TOPK_CANDIDATES`` the merge therefore goes through one intermediate
level: rows are salted by the task that produced them, a ``row_number() <= k``
window per salt lets Spark apply its map-side partial group limit (at most k
rows leave each task), about sqrt(tasks) salts merge those, and only
salts x k rows reach the final ``TakeOrderedAndProject``. The result is exact:
every row of the global top k is in the top k of its task and of its salt.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# tasks x k above which the top-k merge goes through an intermediate level
TREE_TOPK_CANDIDATES = 1_000_000


def task_estimate(df: DataFrame) -> int:
    """Tasks feeding a final merge, estimated from the optimizer's size of the input without
    running or listing anything: its bytes over ``maxPartitionBytes``, at least one per core.
    (``df.rdd.getNumPartitions()`` would be exact, but on a plan with a shuffle adaptive
    execution runs the shuffle stages to answer it, computing the input twice.)"""
    spark = df.sparkSession
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        split = split_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
        return max(-(-size // split), spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no plan access (e.g. Spark Connect)
        return 1


def split_bytes(size: str) -> int:
    """A byte setting such as ``128m`` or ``134217728b``."""
    units = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    size = size.strip().lower().removesuffix("b") or "0"
    return int(size[:-1]) * units[size[-1]] if size[-1] in units else int(size)


def ordered_limit(df: DataFrame, k: int, order: Sequence[Column | str],
                  tree_above: int = TREE_TOPK_CANDIDATES) -> DataFrame:
    """``df.orderBy(*order).limit(k)`` whose final merge stays bounded at any scale."""
    tasks = task_estimate(df)
    spark = df.sparkSession
    group_limit = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if tasks * k <= tree_above or tasks < 4 or not 0 < k <= group_limit:
        return df.orderBy(*order).limit(k)
    salts = max(2, math.isqrt(tasks))
    cols = df.columns
    w = Window.partitionBy("_salt").orderBy(*order)
    level = (df.withColumn("_salt", F.spark_partition_id() % F.lit(salts))
             .withColumn("_rank", F.row_number().over(w))
             .where(F.col("_rank") <= F.lit(k))
             .select(*cols))
    return level.orderBy(*order).limit(k)


def limit_stable(df: DataFrame, n: int, order_by: Sequence[str] | None = None,
                 tree_above: int = TREE_TOPK_CANDIDATES) -> DataFrame:
    """First ``n`` rows by ``order_by`` (all columns by default: duplicates are
    indistinguishable, so the result is deterministic)."""
    keys = list(order_by) if order_by else df.columns
    return ordered_limit(df, n, keys, tree_above)


def top_k(df: DataFrame, k: int, by: str, descending: bool = True,
          tie_break: Sequence[str] | None = None,
          tree_above: int = TREE_TOPK_CANDIDATES) -> DataFrame:
    """Distributed top-k by one column, ties broken by the other columns."""
    rest = list(tie_break) if tie_break is not None else [c for c in df.columns if c != by]
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return ordered_limit(df, k, [first, *rest], tree_above)


def key_split(df: DataFrame, key: Column | str, buckets: int = 5, test_buckets: int = 1,
              split_col: str | None = None):
    """Deterministic train/test split by a row key: ``pmod(key, buckets) <
    test_buckets`` is test. Stable under repartitioning and recomputation (unlike
    an unseeded ``randomSplit`` whose rows can move if a task is re-run on a
    different partitioning). With ``split_col`` returns one DataFrame with a
    'train'/'test' label instead of a pair."""
    k = F.col(key) if isinstance(key, str) else key
    # a null key is on the training side in both forms
    is_test = F.coalesce(F.pmod(k, F.lit(buckets)) < F.lit(test_buckets), F.lit(False))
    if split_col:
        return df.withColumn(split_col, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))
    return df.where(~is_test), df.where(is_test)


def random_split(df: DataFrame, train_fraction: float = 0.8, seed: int = 42):
    """Seeded random split (the original used an unseeded 80/20 split)."""
    train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return train, test


# partitions (offset rows of 16 bytes) up to which the offsets table is broadcast
MAX_BROADCAST_OFFSETS = 1_000_000


def with_row_index(df: DataFrame, name: str = "row_idx") -> DataFrame:
    """Dense 0..N-1 index in partition order without collecting: partition
    offsets come from a table with one row per partition, broadcast up to
    ``MAX_BROADCAST_OFFSETS`` partitions (16 MB) and joined by shuffle beyond.
    Its ordered window sees one row per partition, never data rows.
    The input must be file-backed or checkpointed: then its partitioning is
    deterministic (and reading its partition count runs no job); on a sorted,
    checkpointed input the index is the global sort position."""
    try:
        parts = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD access (e.g. Spark Connect): keep the shuffle join
        parts = MAX_BROADCAST_OFFSETS + 1
    tagged = df.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumns({"_pid": F.shiftright("_mid", 33),
                                 "_pos": F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    if parts <= MAX_BROADCAST_OFFSETS:
        offsets = F.broadcast(offsets)
    return (tagged.join(offsets, "_pid")
            .withColumn(name, F.col("_off") + F.col("_pos"))
            .drop("_mid", "_pid", "_pos", "_off"))
