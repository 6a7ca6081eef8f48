"""One file from parallel parts, quarantined lines, metrics gathered while a table is written."""

import glob

import pytest
from pyspark.sql import functions as F

from citeflow import constants as K
from citeflow.operators.profile import missing_audit
from citeflow.plans.catalog import cleaned, fixture
from citeflow.plans.jobs import clean_observed
from citeflow.session import scratch_path
from citeflow.sources.tables import ingest_csv, join_files, read_csv, write_csv, write_parquet


def parts(path):
    return [open(p, "rb").read() for p in sorted(glob.glob(f"{path.removeprefix('file:')}/part-*"))]


@pytest.mark.parametrize("exact", [False, True])
def test_one_file_equals_the_parts(spark, exact):
    rows = [(i, 'a "quoted", text', " x ", None if i % 3 else "line\nbreak") for i in range(500)]
    df = spark.createDataFrame(rows, "id int, `a,b` string, sp string, n string").repartitionByRange(7, "id")
    one, many = scratch_path(spark, "t-one"), scratch_path(spark, "t-many")
    write_csv(df, one, single_file=True, exact=exact)
    write_csv(df, many, header=False, exact=exact)
    found = parts(one)
    assert len(found) == 1 and len(parts(many)) == 7
    header, rest = found[0].split(b"\n", 1)
    assert rest == b"".join(parts(many)) and header.count(b"a,b") == 1 and found[0].count(b"a,b") == 1
    if exact:
        assert sorted(read_csv(spark, one, schema=df.schema, exact=True).collect()) == sorted(df.collect())


def test_one_file_modes_and_nothing(spark):
    df = spark.range(3).select(F.col("id").cast("string"))
    path = scratch_path(spark, "t-modes")
    write_csv(df, path, single_file=True)
    write_csv(df, path, single_file=True, mode="ignore")
    with pytest.raises(FileExistsError):
        write_csv(df, path, single_file=True, mode="error")
    write_csv(df.where("id = 'x'"), path, single_file=True)
    assert parts(path) == [b"id\n"]
    write_csv(df, path, single_file=True, mode="append", header=False)
    assert sorted(parts(path)) == [b"0\n1\n2\n", b"id\n"]


def test_no_task_writes_all_rows(spark):
    df = spark.range(0, 8000, 1, 8).select(F.col("id").cast("string"), F.spark_partition_id().alias("part"))
    path = write_csv(df, scratch_path(spark, "t-tasks"), single_file=True)
    back = read_csv(spark, path, schema="id string, part int")
    assert back.count() == 8000 and back.select("part").distinct().count() == 8
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_each_line_is_in_one_table(spark):
    lines = ["id,n,d,s", "1,2,3.5,ok", "1,2,3.5", "1,2,3.5,ok,more", "x,2,3.5,ok", "4,2,y,ok", "", '5,2,1,"a,b"', "6,,,", "7,2,1,"]
    path = scratch_path(spark, "t-lines")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    good, bad = ingest_csv(spark, path, "id long, n int, d double, s string", scratch_path(spark, "t-ingested"))
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2, 3.5, "ok"), (5, 2, 1.0, "a,b"), (6, None, None, None), (7, 2, 1.0, None)]
    assert sorted(r["line"] for r in bad.collect()) == sorted(["1,2,3.5", "1,2,3.5,ok,more", "x,2,3.5,ok", "4,2,y,ok"])
    assert all(r["source_file"].endswith(".txt") for r in bad.collect())
    assert good.select("s").count() == 4  # fewer columns read, the same rows
    none = scratch_path(spark, "t-none")
    spark.createDataFrame([], "value string").coalesce(1).write.text(none)
    good, bad = ingest_csv(spark, none, "id long", scratch_path(spark, "t-ingested"))
    assert good.count() == bad.count() == 0


def test_metrics_come_with_the_write(spark, sf_small):
    raw = fixture(spark, sf_small)
    path = scratch_path(spark, "t-observed")
    jobs = []

    def write(df):
        spark.sparkContext.setJobGroup("t-observed", "one write")
        write_parquet(df, path)
        jobs.extend(spark.sparkContext.statusTracker().getJobIdsForGroup("t-observed"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    _, report = clean_observed(raw, write)
    assert len(jobs) == 1  # one scan and nothing else
    want = {("raw", c): (n, raw.count()) for c, n in missing_audit(raw).first().asDict().items()}
    own = cleaned(spark, sf_small)
    want |= {("cleaned", c): (n, own.count()) for c, n in missing_audit(own).first().asDict().items()}
    assert {(r["stage"], r["column_name"]): (r["missing"], r["n_rows"]) for r in report.collect()} == want
    assert spark.read.parquet(path).count() == own.count() and len(K.CLEANED_COLUMNS) == 18
    assert join_files(spark, [], scratch_path(spark, "t-joined-none"))
