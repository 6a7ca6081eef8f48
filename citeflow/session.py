"""Session construction and shared scratch locations.

On a cluster, intermediate files (round trips, saved models, stream sinks and
checkpoints) must live in the shared folder named by ``spark.checkpoint.dir``;
never in a machine-local temporary folder. Only when that setting is unset on a
local master (tests, local runs) do we set one of our own; unset on a cluster is
an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a
    # whole-stage-codegen method above that runs interpreted. With this limit
    # Spark falls back to per-operator code for such (rare, very wide) subtrees.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Spark applies its map-side partial limit to ``row_number() <= k`` windows
    # only up to this k; the bounded top-k merge (operators/sampling) relies on it
    # for exports of up to 100,000 rows.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def get_session(app: str = "citeflow", master: str | None = None,
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the library defaults. ANSI mode stays on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def keep_methods_compiled(spark: SparkSession) -> None:
    """The session default for ``hugeMethodLimit`` in a session that somebody else built, unless it is set
    there: with Spark's own (65535) a wide projection becomes one method that the JVM only interprets."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, DEFAULT_CONF[key])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (set one only if unset)."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root and sc.getCheckpointDir():
        root = sc.getCheckpointDir()          # set by the application itself
    if not root:
        if not sc.master.startswith("local"):
            # a machine-local folder would scatter checkpoints over executor disks
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS or object store): "
                             "citeflow writes checkpoints and scratch tables below it")
        root = os.path.join(tempfile.gettempdir(), "citeflow-checkpoints")   # local runs only
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_root(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/citeflow/{name}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df):
    """Cut lineage with a reliable checkpoint in the shared folder (never a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
