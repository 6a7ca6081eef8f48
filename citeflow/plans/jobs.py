"""Runnable jobs: the entry points of the original application.

* ``clean``   raw citation export (CSV with header) -> cleaned table (CSV or Parquet)
* ``train``   cleaned table -> fitted models (saved) + held-out metrics
* ``publish`` table -> JSON messages (Kafka topic or a folder of JSON-lines files)
* ``stream``  JSON messages -> scored stream, and the messages that cannot be scored
* ``profile`` cleaned table -> row count, describe, missing values, value shares
* ``sample``  cleaned table + model -> feature rows of the test split as CSV

Usage::

    python -m citeflow.plans.jobs clean   --input s3a://bucket/raw.csv --output s3a://bucket/clean --keep summons_number
    python -m citeflow.plans.jobs train   --input s3a://bucket/clean --model s3a://bucket/model --key summons_number
    python -m citeflow.plans.jobs publish --input s3a://bucket/sample --kafka host:9092 --topic t
    python -m citeflow.plans.jobs stream  --model s3a://bucket/model --kafka host:9092 --topic t \\
        --output s3a://bucket/scored --invalid s3a://bucket/invalid --checkpoint s3a://bucket/ckpt
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citeflow import constants as K
from citeflow.operators import models as MD
from citeflow.operators.clean import CLEANED_SCHEMA, CleanOptions, clean_citations
from citeflow.operators.profile import describe_stats, missing_audit, observe_audit, observed_audit, row_count, value_share
from citeflow.operators.sampling import key_split, limit_stable, random_split
from citeflow.sources.messages import to_messages
from citeflow.sources.models import load_model, save_model
from citeflow.sources.tables import read_csv, read_raw_export, resolve_path, write_csv, write_parquet
from citeflow.streaming import scorer as S


def clean_job(spark: SparkSession, input_path: str, output_path: str, fmt: str = "csv",
              single_file: bool = False,
              options: CleanOptions = CleanOptions(), audit_path: str | None = None) -> DataFrame:
    """Raw export -> cleaned 18-column table, written to ``output_path``.

    The raw header is standardized, so exports with spaces, trailing spaces or
    the misspelt header read the same. Written in parallel, also as a ``single_file`` (CSV).
    With ``audit_path`` the rows and missing values of raw and cleaned table are gathered
    while the clean is written (one scan) and stored there as CSV.
    """
    raw = read_raw_export(spark, input_path)

    def write(df: DataFrame) -> None:
        if fmt == "parquet":
            write_parquet(df.repartition(1) if single_file else df, output_path)
        else:
            write_csv(df, output_path, single_file=single_file)

    if audit_path:
        cleaned, report = clean_observed(raw, write, options)
        write_csv(report, audit_path)
    else:
        cleaned = clean_citations(raw, options)
        write(cleaned)
    if fmt == "parquet":
        return spark.read.parquet(resolve_path(output_path))
    return read_csv(spark, output_path, schema=cleaned.schema)


def clean_observed(raw: DataFrame, write: Callable[[DataFrame], None],
                   options: CleanOptions = CleanOptions()) -> tuple[DataFrame, DataFrame]:
    """The cleaned table, after ``write`` has written it, and ``stage, column_name, missing, n_rows`` of
    the raw and the cleaned table, gathered in the one pass of that write."""
    raw, before = observe_audit(raw, "raw")
    cleaned, after = observe_audit(clean_citations(raw, options), "cleaned")
    write(cleaned)
    rows = observed_audit(raw, before, "raw") + observed_audit(cleaned, after, "cleaned")
    return cleaned, raw.sparkSession.createDataFrame(rows, "stage string, column_name string, missing long, n_rows long")


def read_cleaned(spark: SparkSession, path: str, fmt: str = "csv", keep: tuple[str, ...] = ()) -> DataFrame:
    """A cleaned table written by ``clean_job`` in the same format; ``keep`` names the extra
    whole-number columns it was written with (a CSV's header tells where they stand)."""
    if fmt == "parquet":
        return spark.read.parquet(resolve_path(path))
    types = dict(part.split() for part in CLEANED_SCHEMA.split(", ")) | dict.fromkeys(keep, "bigint")
    names = read_csv(spark, path).columns
    return read_csv(spark, path, schema=", ".join(f"{c} {types.get(c, 'string')}" for c in names))


def train_job(spark: SparkSession, cleaned: DataFrame, model_path: str | None = None,
              key: str | None = None, seed: int = 42, num_trees: int = K.FOREST_TREES,
              models=("random_forest", "decision_tree")) -> DataFrame:
    """Fit indexers on the training split, fit the classifiers, save each with its feature
    stages as one ``PipelineModel`` (the forest at ``model_path``, the tree at
    ``<model_path>-tree``) and return held-out metrics per model.

    With ``key`` the split is by ``pmod(key, 5) == 0`` (stable under
    recomputation); without, a seeded 80/20 random split.
    """
    if key:
        train, test = key_split(cleaned, F.col(key), buckets=5, test_buckets=1)
    else:
        train, test = random_split(cleaned, K.TRAIN_FRACTION, seed)
    # the split is deterministic over the stored table, so it is scanned twice
    # (index counts, featurization) instead of cached whole; train_models
    # persists only the featurized rows the fits read many times
    feats = MD.fit_feature_model(train)
    ests = {"random_forest": MD.forest(feats, num_trees=num_trees, seed=seed),
            "decision_tree": MD.tree(feats, seed=seed)}
    chosen = [m for m in models if m in ests]
    fitted = dict(zip(chosen, MD.train_models(train, feats, [ests[m] for m in chosen])))
    if model_path and "random_forest" in fitted:
        save_model(fitted["random_forest"], model_path)
    if model_path and "decision_tree" in fitted:
        save_model(fitted["decision_tree"], f"{model_path}-tree")
    out = None
    for name, model in fitted.items():
        m = MD.classification_metrics(MD.score(model, test, decode=False)) \
            .select(F.lit(name).alias("model"), "*")
        out = m if out is None else out.unionByName(m)
    return out


def publish_job(table: DataFrame, kafka: str | None = None, topic: str | None = None,
                output_path: str | None = None) -> None:
    """Rows as JSON messages (every value as text): to a topic with key = value, or the values as
    lines of files in ``output_path``."""
    if kafka:
        S.kafka_publish(table, kafka, topic)
    else:
        to_messages(table, key=False).write.mode("overwrite").text(resolve_path(output_path))


def stream_job(spark: SparkSession, model_path: str, output_path: str | None, checkpoint: str,
               kafka: str | None = None, topic: str | None = None, files: str | None = None,
               fmt: str = "parquet", available_now: bool = False, trigger: str = K.STREAM_TRIGGER,
               invalid_path: str | None = None, batch_bytes: str | None = None) -> list[StreamingQuery]:
    """Score JSON messages with a saved model; returns the running queries. Messages that cannot
    be scored go, as they came, to ``invalid_path`` (``<output_path>-invalid`` if unset), with a
    checkpoint of their own; a broker's message key stays beside the score."""
    model = load_model(model_path)
    if kafka:
        messages = S.kafka_message_source(spark, kafka, topic)
    else:
        messages = S.file_message_source(spark, files, max_bytes_per_trigger=batch_bytes)
    keep = [c for c in messages.columns if c == "key"]
    if invalid_path is None and output_path is not None:
        invalid_path = f"{output_path}-invalid"
    if output_path is not None:  # files: one read of the source for both sinks
        return [S.start_routed_sink(messages, model, output_path, invalid_path, checkpoint, keep=keep,
                                    available_now=available_now, trigger=trigger, fmt=fmt)]
    scored, bad = S.score_messages(messages, model, keep=keep), S.invalid_messages(messages)
    return [S.start_sink(scored, output_path, checkpoint, available_now=available_now, trigger=trigger, fmt=fmt),
            S.start_sink(bad, invalid_path, f"{checkpoint}-invalid", available_now=available_now,
                         trigger=trigger, fmt=fmt)]


def profile_job(cleaned: DataFrame, output_path: str) -> list[str]:
    """The profile reports as CSV folders below ``output_path``."""
    reports = {"row_count": row_count(cleaned), "describe": describe_stats(cleaned), "missing": missing_audit(cleaned)}
    for c in ("meridiem", "time_hour", "registration_state", "plate_type", K.TARGET, "month"):
        reports[f"share_{c}"] = value_share(cleaned, c)
    return [write_csv(report, f"{output_path}/{name}") for name, report in reports.items()]


def sample_job(cleaned: DataFrame, model_path: str, output_path: str, key: str | None = None,
               rows: int = K.SAMPLE_EXPORT_ROWS, seed: int = 42) -> str:
    """The first ``rows`` feature rows of the test split, as CSV: what ``publish`` sends."""
    _, test = (key_split(cleaned, F.col(key)) if key else random_split(cleaned, K.TRAIN_FRACTION, seed))
    features = load_model(model_path).transform(test).select(*K.FEATURES)
    return write_csv(limit_stable(features, rows), output_path)


def main(argv=None) -> None:
    from citeflow.session import get_session
    p = argparse.ArgumentParser(prog="citeflow")
    sub = p.add_subparsers(dest="job", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--input", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--format", default="csv", choices=["csv", "parquet"])
    c.add_argument("--single-file", action="store_true")
    c.add_argument("--keep", nargs="*", default=[])
    c.add_argument("--audit")
    t = sub.add_parser("train")
    t.add_argument("--input", required=True)
    t.add_argument("--model")
    t.add_argument("--key")
    t.add_argument("--format", default="csv", choices=["csv", "parquet"])
    b = sub.add_parser("publish")
    b.add_argument("--input", required=True)
    b.add_argument("--kafka")
    b.add_argument("--topic")
    b.add_argument("--output")
    r = sub.add_parser("profile")
    r.add_argument("--input", required=True)
    r.add_argument("--output", required=True)
    r.add_argument("--format", default="csv", choices=["csv", "parquet"])
    e = sub.add_parser("sample")
    e.add_argument("--input", required=True)
    e.add_argument("--model", required=True)
    e.add_argument("--output", required=True)
    e.add_argument("--key")
    e.add_argument("--format", default="csv", choices=["csv", "parquet"])
    s = sub.add_parser("stream")
    s.add_argument("--model", required=True)
    s.add_argument("--output")
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--kafka")
    s.add_argument("--topic")
    s.add_argument("--files")
    s.add_argument("--invalid")
    s.add_argument("--format", default="parquet")
    args = p.parse_args(argv)
    spark = get_session(app=f"citeflow-{args.job}")
    keep = (args.key,) if getattr(args, "key", None) else ()
    if args.job == "clean":
        clean_job(spark, args.input, args.output, fmt=args.format, single_file=args.single_file,
                  options=CleanOptions(keep=tuple(args.keep)), audit_path=args.audit)
    elif args.job == "train":
        table = read_cleaned(spark, args.input, args.format, keep)
        train_job(spark, table, args.model, key=args.key).show(truncate=False)
    elif args.job == "publish":
        publish_job(read_csv(spark, args.input), args.kafka, args.topic, args.output)
    elif args.job == "profile":
        profile_job(read_cleaned(spark, args.input, args.format), args.output)
    elif args.job == "sample":
        sample_job(read_cleaned(spark, args.input, args.format, keep), args.model, args.output, args.key)
    else:
        S.finish(stream_job(spark, args.model, args.output, args.checkpoint, kafka=args.kafka, topic=args.topic,
                            files=args.files, fmt=args.format, invalid_path=args.invalid))


if __name__ == "__main__":
    main()
