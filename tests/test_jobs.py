"""The three jobs chained on a raw-style export: clean -> train -> stream."""

from pyspark.sql import functions as F

from citeflow import constants as K
from citeflow.operators.columns import to_title_names
from citeflow.plans.catalog import publish_messages
from citeflow.plans.jobs import clean_job, read_cleaned, stream_job, train_job
from citeflow.session import scratch_path
from citeflow.sources.fixture import citations
from citeflow.streaming.scorer import finish
from citeflow.sources.tables import write_csv


def test_clean_train_stream_jobs(spark, sf_small):
    raw_path = scratch_path(spark, "job-raw")
    # the fixture as a raw export: header names with spaces, as in the original CSV
    write_csv(to_title_names(citations(spark, sf_small), sep=" "), raw_path)
    out_path = scratch_path(spark, "job-clean")
    cleaned = clean_job(spark, raw_path, out_path, fmt="parquet")
    assert cleaned.columns == K.CLEANED_COLUMNS
    expected = citations(spark, sf_small)
    from citeflow.operators.clean import clean_citations
    assert cleaned.count() == clean_citations(expected).count()

    model_path = scratch_path(spark, "job-model")
    metrics = train_job(spark, read_cleaned(spark, out_path, "parquet"), model_path, num_trees=5)
    got = {(r["model"], r["metric"]) for r in metrics.collect()}
    assert ("random_forest", "f1") in got and ("decision_tree", "accuracy") in got

    # stream: index the cleaned rows with the saved model's stages, publish, score
    from citeflow.sources.models import load_model
    model = load_model(model_path)
    msgs = model.transform(read_cleaned(spark, out_path, "parquet")).select(*K.FEATURES)
    src = publish_messages(msgs, scratch_path(spark, "job-msgs"))
    sink = scratch_path(spark, "job-scored")
    queries = stream_job(spark, model_path, sink, scratch_path(spark, "job-ckpt"), files=src,
                         available_now=True)
    finish(queries, 300)
    scored = spark.read.parquet(sink)
    assert scored.count() == msgs.count()
    assert scored.where(F.col("predicted_label").isNull()).count() == 0


def test_clean_job_csv_output_reads_back_typed(spark, sf_small):
    from citeflow.operators.clean import CLEANED_SCHEMA
    raw_path = scratch_path(spark, "job-raw2")
    write_csv(to_title_names(citations(spark, sf_small), sep=" "), raw_path)
    out = scratch_path(spark, "job-clean-csv")
    clean_job(spark, raw_path, out, fmt="csv", single_file=True)
    back = read_cleaned(spark, out)
    assert back.schema.simpleString() == spark.createDataFrame([], CLEANED_SCHEMA).schema.simpleString()
    assert back.count() > 0


def test_unset_checkpoint_dir_is_an_error_on_a_cluster():
    import pytest
    from citeflow.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class RuntimeConf:
        def get(self, key):
            raise KeyError(key)

    class Session:
        sparkContext = Context()
        conf = RuntimeConf()

    with pytest.raises(ValueError, match="shared folder"):
        checkpoint_root(Session())


def test_clean_keep_train_key_publish_stream_chain(spark, sf_small):
    from citeflow.operators.clean import CleanOptions
    from citeflow.plans.jobs import profile_job, publish_job, sample_job
    from citeflow.sources.tables import read_csv
    raw, out = scratch_path(spark, "chain-raw"), scratch_path(spark, "chain-clean")
    write_csv(to_title_names(citations(spark, sf_small), sep=" "), raw)
    clean_job(spark, raw, out, options=CleanOptions(keep=("summons_number",)))
    cleaned = read_cleaned(spark, out, keep=("summons_number",))
    model, sample, messages, sink = (scratch_path(spark, f"chain-{n}") for n in ("model", "sample", "messages", "scored"))
    train_job(spark, cleaned, model, key="summons_number", num_trees=3)
    from citeflow.sources.models import load_model
    assert load_model(f"{model}-tree").stages
    sample_job(cleaned, model, sample, key="summons_number", rows=50)
    publish_job(read_csv(spark, sample), output_path=messages)
    bad = spark.createDataFrame([("not json",)], "value string")
    bad.write.mode("append").text(messages)
    finish(stream_job(spark, model, sink, f"{sink}-ckpt", files=messages, available_now=True), 300)
    assert spark.read.parquet(sink).count() == 50
    assert [r[0] for r in spark.read.parquet(f"{sink}-invalid").collect()] == ["not json"]
    assert len(profile_job(cleaned, scratch_path(spark, "chain-reports"))) == 9
