"""Cleaning semantics: hand-written rows per edge case."""

import pytest
from pyspark.sql import functions as F

from citeflow import constants as K
from citeflow.functions import canonicalize, clamp_hour, hour_of, meridiem_of, weekday_of
from citeflow.operators.clean import CleanOptions, clean_citations, cleaning_stages
from citeflow.operators.columns import blank_to_null_all, standardize_names
from citeflow.operators.profile import value_share
from citeflow.sources.fixture import citations
from citeflow.sources.tables import read_raw_export

RAW_HEADER = ["Summons Number", "Registration State", "Plate Type", "Issue Date", "Violation Code",
              "Vehicle Body Type", "Vehicle Make", "Issuing Agency", "Street Code1", "Street Code2",
              "Street Code3", "Violation Location", "Violation Precinct", "Issuer Precinct",
              "Issuer Command", "Violation Time", "Violation County",
              "Violation In Front Of Or Opposite", "Days Parking In Effect    ", "Community Council ",
              "Meter Number"]


def _raw_row(**over):
    base = {"Summons Number": "1", "Registration State": "NY", "Plate Type": "PAS",
            "Issue Date": "07/15/2013", "Violation Code": "21", "Vehicle Body Type": "SUBN",
            "Vehicle Make": "FORD", "Issuing Agency": "T", "Street Code1": "100",
            "Street Code2": "200", "Street Code3": "300", "Violation Location": "14",
            "Violation Precinct": "14", "Issuer Precinct": "14", "Issuer Command": "T103",
            "Violation Time": "0752A", "Violation County": "NY",
            "Violation In Front Of Or Opposite": "F", "Days Parking In Effect    ": "",
            "Community Council ": "", "Meter Number": ""}
    base.update(over)
    return [base[h] for h in RAW_HEADER]


@pytest.fixture()
def raw_csv(spark, tmp_path):
    """A small raw export with the original header (spaces, trailing spaces)."""
    rows = [
        _raw_row(),                                               # kept
        _raw_row(**{"Summons Number": "2", "Violation County": "QUEENS"}),  # -> QS
        _raw_row(**{"Summons Number": "3", "Violation County": "KINGS"}),   # -> K
        _raw_row(**{"Summons Number": "4", "Issue Date": "02/29/2013"}),    # impossible date
        _raw_row(**{"Summons Number": "5", "Issue Date": "07/15/2011"}),    # year out of range
        _raw_row(**{"Summons Number": "6", "Registration State": "99"}),    # sentinel
        _raw_row(**{"Summons Number": "7", "Plate Type": "999"}),           # sentinel
        _raw_row(**{"Summons Number": "8", "Violation County": "103"}),     # sentinel
        _raw_row(**{"Summons Number": "9", "Violation County": ""}),        # null target
        _raw_row(**{"Summons Number": "10", "Violation Time": "1330P"}),    # hour 13 -> 1.0
        _raw_row(**{"Summons Number": "11", "Violation Time": "0830"}),     # no meridiem
        _raw_row(**{"Summons Number": "12", "Vehicle Make": ""}),           # blank feature
        _raw_row(**{"Summons Number": "13", "Issue Date": "bad"}),          # malformed
        _raw_row(**{"Summons Number": "14", "Violation County": "RICH"}),   # -> R
    ]
    path = tmp_path / "raw.csv"
    with open(path, "w") as fh:
        fh.write(",".join(RAW_HEADER) + "\n")
        for r in rows:
            fh.write(",".join(r) + "\n")
    return read_raw_export(spark, str(path))


def test_raw_export_cleans_to_18_columns(raw_csv):
    out = clean_citations(raw_csv, CleanOptions(keep=("summons_number",)))
    assert out.columns == ["summons_number"] + K.CLEANED_COLUMNS
    rows = {r["summons_number"]: r for r in out.collect()}
    assert sorted(rows) == [1, 2, 3, 10, 14]
    assert rows[2]["violation_county"] == "QS"      # unanchored rules, as the original
    assert rows[3]["violation_county"] == "K"
    assert rows[14]["violation_county"] == "R"
    assert rows[10]["time_hour"] == 1.0
    assert rows[1]["time_hour"] == 7.0 and rows[1]["meridiem"] == "A"
    assert rows[1]["month"] == 7.0 and rows[1]["day"] == 0.0   # 15 July 2013 was a Monday


def test_standardize_names_fixes_trailing_spaces(raw_csv):
    names = standardize_names(raw_csv).columns
    assert "days_parking_in_effect" in names and "community_council" in names
    assert all(" " not in n for n in names)


def test_anchored_rules_leave_queens(spark):
    df = spark.createDataFrame([("QUEENS",), ("QUEEN",), ("NYC",)], "c string")
    got = [r[0] for r in df.select(canonicalize("c", anchored=True)).collect()]
    assert got == ["QUEENS", "Q", "NY"]
    got = [r[0] for r in df.select(canonicalize("c")).collect()]
    assert got == ["QS", "Q", "NY"]


def test_bad_text_is_null_not_error(spark):
    df = spark.createDataFrame([("02/29/2013", "xx"), ("bad", None), ("1/2/2014", "0101P")],
                               "d string, t string")
    out = df.select(weekday_of("d").alias("w"), hour_of("t").alias("h"), meridiem_of("t").alias("m")).collect()
    assert out[0]["w"] is None and out[0]["h"] is None
    assert out[1]["w"] is None and out[1]["m"] is None
    assert out[2]["w"] == 3 and out[2]["h"] == 1.0 and out[2]["m"] == "P"


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(0.0,), (12.0,), (12.5,), (None,)], "h double")
    assert [r[0] for r in df.select(clamp_hour("h")).collect()] == [1.0, 12.0, 1.0, None]


def test_blank_to_null_only_touches_strings(spark):
    df = spark.createDataFrame([("", 0), ("a", None)], "s string, i int")
    assert blank_to_null_all(df).collect() == [(None, 0), ("a", None)]


def test_hour_drop_mode_and_packaged_options(spark, sf_small):
    src = citations(spark, sf_small)
    fill = clean_citations(src).count()
    drop = clean_citations(src, CleanOptions(hour_mode="drop")).count()
    packaged = clean_citations(src, CleanOptions(sentinels={"violation_county": "103"},
                                                 canonicalize_first=True)).count()
    assert drop < fill <= packaged


def test_fixture_clean_matches_known_counts(spark, sf_mid):
    out = clean_citations(citations(spark, sf_mid))
    shares = {r[K.TARGET]: r["count"] for r in value_share(out, K.TARGET).collect()}
    assert shares == {"BX": 2885, "K": 2905, "NY": 2840, "Q": 2939, "QS": 1426, "R": 4310}


def test_value_shares_sum_to_100(spark, sf_small):
    st = cleaning_stages(citations(spark, sf_small))
    total = value_share(st["featured"], "year").agg(F.sum("percentage")).first()[0]
    assert abs(total - 100.0) < 1e-9


def test_clean_plan_has_no_shuffle_or_python(spark, sf_small):
    from citeflow.sources.fixture import citations_from_lineitem
    from citeflow.sources.tables import read_table
    raw = citations_from_lineitem(read_table(spark, sf_small, "lineitem", spread_splits=False))
    plan = clean_citations(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_filters_reach_parquet_on_stored_raw(spark, sf_small):
    from citeflow.session import scratch_path
    path = scratch_path(spark, "t-stored-raw")
    citations(spark, sf_small).write.parquet(path)
    df = clean_citations(spark.read.parquet(path))
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    assert "Not(EqualTo(registration_state,99))" in plan and "Not(EqualTo(plate_type,999))" in plan
    read_schema = [line for line in plan.splitlines() if line.startswith("ReadSchema")][0]
    assert "summons_number" not in read_schema and "violation_precinct" not in read_schema
    assert "Exchange" not in plan


def test_spread_gives_under_split_input_parallel_splits(spark, sf_small):
    from citeflow.sources.tables import read_table
    raw = read_table(spark, sf_small, "lineitem", spread_splits=False)
    spread = read_table(spark, sf_small, "lineitem")
    cores = spark.sparkContext.defaultParallelism
    assert spread.rdd.getNumPartitions() >= min(cores, 2)
    assert sorted(spread.collect()) == sorted(raw.collect())
    # the copy is made once per session: a second read points at the same files
    assert read_table(spark, sf_small, "lineitem").inputFiles() == spread.inputFiles()


def test_canonicalize_regex_and_literal_rules(spark):
    df = spark.createDataFrame([("A.C",), ("ABC",), ("N$Y",)], "c string")
    rules = [("A.C", "x"), ("$", "d")]      # regex rule (dot, anchor) vs literal text
    got = [r[0] for r in df.select(canonicalize("c", rules)).collect()]
    assert got == ["xd", "xd", "N$Yd"]


def test_clean_over_spread_copy_has_no_exchange(spark, sf_mid):
    from citeflow.plans.catalog import stages
    cleaned = stages(spark, sf_mid)["cleaned"]
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "RoundRobinPartitioning" not in plan
    assert cleaned.rdd.getNumPartitions() >= min(spark.sparkContext.defaultParallelism, 2)
