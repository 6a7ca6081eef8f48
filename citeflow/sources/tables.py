"""Table sources and sinks: Parquet, CSV (header, explicit or inferred schema), paths.

Object-store paths work as any Hadoop path (``s3a://``; the old ``s3n`` scheme no
longer exists in current Hadoop, so it is rewritten to ``s3a``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def resolve_path(path: str) -> str:
    """Map legacy object-store schemes onto the current connector."""
    if path.startswith("s3n://"):
        return "s3a://" + path[len("s3n://"):]
    return path


_SPREAD: dict[tuple, str] = {}


#: bytes per core up to which an under-split input is copied
SPREAD_BYTES = 4 << 20


def wants_copy(size: int, partitions: int, cores: int) -> bool:
    return partitions < cores and size <= cores * SPREAD_BYTES


def spread(df: DataFrame) -> DataFrame:
    """Give an under-split Parquet input (a bare scan or a projection of one) as many
    splits as the cluster has cores.

    A scan yields one task per file split, and a Parquet split only holds work if
    a row group starts in it: a small table stored as one row group is scanned,
    and every narrow operator after it (the whole clean) runs, in one task. A
    round-robin ``repartition`` does not help, because Catalyst pushes the
    filters (and the expressions they reference) through it into the scan task.
    So an under-split input is written once per session, as ``cores`` files, to
    the shared checkpoint folder and read from there: later scans are parallel
    and keep column pruning and filter pushdown.

    Scale bound: only an input of at most ``SPREAD_BYTES`` per core is copied (by its
    size, not by its number of splits). A larger one is returned untouched; no
    copy or shuffle is added at scale.
    """
    spark = df.sparkSession
    try:
        cores = spark.sparkContext.defaultParallelism
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        # a bare scan (no exchange): planning its RDD runs no job
        if not wants_copy(size, df.rdd.getNumPartitions(), cores):
            return df
        # few files: the input is small
        files = tuple(sorted(df.inputFiles()))
    except Exception:  # noqa: BLE001 - no RDD access (e.g. Spark Connect): leave as is
        return df
    if not files:
        return df
    key = (spark.sparkContext.applicationId, files, tuple(df.columns))
    if key not in _SPREAD:
        from citeflow.session import scratch_path
        path = scratch_path(spark, "spread")
        df.repartition(cores).write.mode("overwrite").parquet(path)
        _SPREAD[key] = path
    return spark.read.parquet(_SPREAD[key])


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_splits: bool = True,
               columns: list[str] | None = None) -> DataFrame:
    """One TESTDATA table (Parquet: columnar, pushdown and pruning for free).
    ``columns`` prunes before a spread copy, so the copy holds only what is read."""
    df = spark.read.parquet(f"{resolve_path(sf_dir).rstrip('/')}/{name}.parquet")
    if columns is not None:
        df = df.select(*columns)
    return spread(df) if spread_splits else df


KEEP_SPACE = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer_schema: bool = False, header: bool = True, exact: bool = False) -> DataFrame:
    """CSV scan with a header. Prefer an explicit schema: inference costs an extra
    full pass over the input before the real job starts. ``exact`` keeps white space
    at the ends of values and line breaks inside quotes (files are then not split),
    as ``write_csv(exact=True)`` writes them; without, Spark's defaults hold, as in the
    original."""
    reader = spark.read.option("header", str(header).lower())
    if exact:
        reader = reader.options(multiLine="true", escape='"', **KEEP_SPACE)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    return reader.csv(resolve_path(path))


def read_raw_export(spark: SparkSession, path: str) -> DataFrame:
    """Raw citation export: header CSV read as text (no inference pass, which
    would cost a full extra scan and can mistype codes such as ``T5`` as
    timestamps), names standardized, known numeric code columns ``try_cast``."""
    from pyspark.sql import functions as F

    from citeflow import constants as K
    from citeflow.operators.columns import standardize_names
    df = standardize_names(read_csv(spark, path))
    casts = {c: "int" for c in K.std(K.RAW_INTEGER_COLUMNS)}
    casts.update({c: "bigint" for c in K.std(K.RAW_LONG_COLUMNS)})
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items() if c in df.columns})


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False,
              header: bool = True, exact: bool = False) -> str:
    """CSV sink with a header. Parallel by default (one file per task). With
    ``single_file`` the tasks write their parts all the same; the files are then joined into
    one behind one header (``join_files``), so no task sees all rows."""
    options = {"quoteAll": "true", "escape": '"', **KEEP_SPACE} if exact else {}
    if not single_file:
        df.write.mode(mode).option("header", str(header).lower()).options(**options).csv(resolve_path(path))
        return path
    from citeflow.session import scratch_path
    spark = df.sparkSession
    parts, names = scratch_path(spark, "csv-parts"), scratch_path(spark, "csv-header")
    df.write.options(**options).csv(parts)
    folders = [parts]
    if header:  # a row of the names, quoted as values are
        row = spark.createDataFrame([tuple(df.columns)], ", ".join(f"_{i} string" for i in range(len(df.columns))))
        row.coalesce(1).write.options(**options).csv(names)
        folders.insert(0, names)
    return join_files(spark, folders, path, mode)


def join_files(spark: SparkSession, folders: list[str], path: str, mode: str = "overwrite") -> str:
    """The part files of ``folders``, in order, as one file in the folder ``path``. All tasks have written
    the rows; here bytes are put one behind the other: by the file system itself where it can
    (HDFS), else through a buffer of 1 MB. The parts are deleted when the file stands."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    folder = hadoop.fs.Path(resolve_path(path))
    fs = folder.getFileSystem(conf)
    if fs.exists(folder):
        if mode == "ignore":
            return path
        if mode == "overwrite":
            fs.delete(folder, True)
        elif mode != "append":
            raise FileExistsError(path)
    sources = []
    for f in folders:
        p = hadoop.fs.Path(f)
        found = [x.getPath() for x in p.getFileSystem(conf).listStatus(p) if x.getPath().getName().startswith("part-") and x.getLen()]
        sources += sorted(found, key=lambda x: x.getName())
    target = hadoop.fs.Path(folder, f"part-{uuid.uuid4().hex[:8]}.csv")
    out = fs.create(target, True)
    if fs.getScheme() == "hdfs" and sources and all(p.getFileSystem(conf).getUri().equals(fs.getUri()) for p in sources):
        out.close()
        blocks = spark.sparkContext._gateway.new_array(hadoop.fs.Path, len(sources))
        for i, p in enumerate(sources):
            blocks[i] = p
        fs.concat(target, blocks)  # moves blocks, no bytes
    else:
        try:
            for p in sources:
                part = p.getFileSystem(conf).open(p)
                try:
                    hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
                finally:
                    part.close()
        finally:
            out.close()
    for f in folders:
        p = hadoop.fs.Path(f)
        p.getFileSystem(conf).delete(p, True)
    return path


def ingest_csv(spark: SparkSession, path: str, schema: StructType | str, out: str, header: bool = True,
               exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """CSV lines into two tables from one scan: ``(good, bad)``. Lines with too few or too many fields, or with a
    field that is not of its type, are bad: ``line`` (as it came) and ``source_file``. Good rows have
    the schema's columns. Both are written below ``out`` (the folder is replaced) and read back."""
    from pyspark.sql import functions as F
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    kept = "_line"
    reader = (spark.read.option("header", str(header).lower()).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", kept)
              .schema(StructType(list(fields)).add(kept, "string")))
    if exact:
        reader = reader.options(multiLine="true", escape='"', **KEEP_SPACE)
    rows = reader.csv(resolve_path(path))
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col(kept).isNotNull().alias("_bad"))
    rows.write.mode("overwrite").partitionBy("_bad").parquet(resolve_path(out))
    whole = StructType(list(fields)).add(kept, "string").add("_file", "string").add("_bad", "boolean")
    both = spark.read.schema(whole).parquet(resolve_path(out))
    return (both.where("NOT _bad").select(*[f"`{f.name}`" for f in fields]),
            both.where("_bad").select(F.col(kept).alias("line"), F.col("_file").alias("source_file")))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(resolve_path(path))
    return path
