"""Query catalog: each registered query binds library operators to the TESTDATA
tables (through the ``citations`` fixture derived from ``lineitem``) and, where
the operator is SQL-expressible, carries an independent DuckDB oracle.

Every query reads whole tables; limits appear only where they are the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow import constants as K
from citeflow.functions import (canonicalize, clamp_hour, hour_of, month_of, weekday_of,
                                year_of)
from citeflow.operators import columns as C
from citeflow.operators import profile as P
from citeflow.operators.clean import CleanOptions, cleaning_stages
from citeflow.operators.features import frequency_index
from citeflow.operators.filters import drop_sentinels, dropna_any, dropna_subset
from citeflow.operators.sampling import key_split, limit_stable, top_k
from citeflow.plans.batch_job import split_key
from citeflow.plans.oracles import with_stages
from citeflow.session import scratch_path
from citeflow.sources import messages as M
from citeflow.sources.fixture import CITATION_COLUMNS, citations
from citeflow.sources.tables import ingest_csv, read_csv, read_table, write_csv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


_STAGES: dict[tuple, dict] = {}
_FIXTURES: dict[tuple, DataFrame] = {}


def fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``citations`` fixture over the whole ``lineitem`` table, one plan per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FIXTURES:
        _FIXTURES[key] = citations(spark, sf_dir)
    return _FIXTURES[key]


def stages(spark: SparkSession, sf_dir: str, keep=()):
    """The cleaning stages over the fixture, built once per session and input:
    DataFrames are immutable plans, so reports share them (as a user keeps the
    cleaned frame for several reports) instead of re-analysing a dozen
    intermediate plans per report. Every report still runs over the whole table."""
    key = (spark.sparkContext.applicationId, sf_dir, tuple(keep))
    if key not in _STAGES:
        _STAGES[key] = cleaning_stages(fixture(spark, sf_dir), CleanOptions(keep=tuple(keep)))
    return _STAGES[key]


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages(spark, sf_dir)["cleaned"]


def cleaned_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows plus the row key ``summons_number`` (not a feature)."""
    return stages(spark, sf_dir, keep=("summons_number",))["cleaned"]


SPLIT_SQL = "(summons_number // 10) % 5"

STRING_COLS = ["registration_state", "plate_type", "issue_date", "vehicle_body_type", "vehicle_make",
               "issuing_agency", "issuer_command", "violation_time", "violation_county",
               "violation_in_front_of_or_opposite"]
NUMERIC_CLEANED = ["violation_code", "street_code1", "street_code2", "street_code3",
                   "violation_location", "issuer_precinct", "month", "day", "time_hour"]
ALL_CLEANED = ", ".join(K.CLEANED_COLUMNS)


def _cols(cols):
    return ", ".join(cols)


# ---------------------------------------------------------------- sources / sinks

@register("csv_scan", with_stages("citations", "SELECT " + ", ".join(
    (f"nullif({c}, '') AS {c}" if c in STRING_COLS else c) for c in CITATION_COLUMNS)
    + " FROM citations"))
def q_csv_scan(spark, sf_dir):
    """Raw export as CSV with a header, read back with an explicit schema.

    CSV cannot tell a blank field from a missing one: Spark reads both as null,
    as when the original job scanned its raw export."""
    src = fixture(spark, sf_dir)
    path = write_csv(src, scratch_path(spark, "csv_scan"))
    return read_csv(spark, path, schema=src.schema)


@register("csv_sink", with_stages("cleaned", "SELECT * FROM cleaned"))
def q_csv_sink(spark, sf_dir):
    """Cleaned table written as header CSV (parallel files), read back."""
    out = cleaned(spark, sf_dir)
    path = write_csv(out, scratch_path(spark, "csv_sink"))
    return read_csv(spark, path, schema=out.schema)


@register("csv_single_file", with_stages("cleaned", "SELECT *, 1 AS n_files FROM cleaned"))
def q_csv_single_file(spark, sf_dir):
    """Cleaned table as one CSV file, joined from the parts that all tasks wrote, read back."""
    out = cleaned(spark, sf_dir)
    path = write_csv(out, scratch_path(spark, "csv_single"), single_file=True)
    back = read_csv(spark, path, schema=out.schema)
    return back.withColumn("n_files", F.lit(len(back.inputFiles())))


#: lines with too few fields, a field that is no number, too many fields
LINE_SQL = ("CASE WHEN event_id % 10 = 3 THEN concat_ws(',', CAST(event_id AS {t}), CAST(user_id AS {t})) "
            "WHEN event_id % 10 = 5 THEN concat_ws(',', concat('x', CAST(event_id AS {t})), CAST(user_id AS {t}), event_type) "
            "WHEN event_id % 10 = 7 THEN concat_ws(',', CAST(event_id AS {t}), CAST(user_id AS {t}), event_type, 'more') "
            "ELSE concat_ws(',', CAST(event_id AS {t}), CAST(user_id AS {t}), event_type) END")


@register("csv_quarantine", "SELECT CASE WHEN bad THEN NULL ELSE event_id END AS event_id, CASE WHEN bad THEN NULL ELSE user_id END AS user_id, "
          "CASE WHEN bad THEN NULL ELSE event_type END AS event_type, CASE WHEN bad THEN line END AS line FROM "
          f"(SELECT *, event_id % 10 IN (3, 5, 7) AS bad, {LINE_SQL.format(t='VARCHAR')} AS line FROM events)")
def q_csv_quarantine(spark, sf_dir):
    """Events as CSV lines, some of them short, long or not numbers, scanned once into two tables:
    good rows, and bad lines as they came."""
    path = scratch_path(spark, "csv-lines")
    read_table(spark, sf_dir, "events").select(F.expr(LINE_SQL.format(t="STRING")).alias("line")).write.text(path)
    good, bad = ingest_csv(spark, path, "event_id long, user_id long, event_type string", scratch_path(spark, "ingested"), header=False)
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(bad.select("line"), allowMissingColumns=True)


@register("publish_json", with_stages("cleaned", "SELECT " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in K.CLEANED_COLUMNS) + ", CAST(violation_county AS VARCHAR) AS key_county, true AS key_is_value FROM cleaned"))
def q_publish_json(spark, sf_dir):
    """Rows -> JSON messages (every value as text, key = value) -> parsed back, with the message
    key beside them. The value goes through binary, as a broker delivers it."""
    msgs = M.to_messages(cleaned(spark, sf_dir))
    msgs = msgs.select("key", F.col("value").cast("binary").alias("value"))
    county = F.get_json_object("key", "$.violation_county").alias("key_county")
    parsed = M.parse_messages(msgs.select("value", county, (F.col("key") == F.col("value").cast("string")).alias("key_is_value")),
                              K.CLEANED_COLUMNS, keep=["key_county", "key_is_value"])
    return parsed


# ---------------------------------------------------------------- projections

RENAMES = {"violation_time": "Violation_Time", "registration_state": "Registration_State",
           "plate_type": "Plate_Type", "violation_county": "Violation_County"}


@register("rename_columns", with_stages("citations", "SELECT " + ", ".join(
    f'{c} AS "{RENAMES.get(c, c)}"' for c in CITATION_COLUMNS) + " FROM citations"))
def q_rename_columns(spark, sf_dir):
    mapping = dict(K.RAW_NAME_FIXES)  # absent here: ignored
    mapping.update(RENAMES)
    return C.rename_columns(fixture(spark, sf_dir), mapping)


def _title(c: str, sep: str) -> str:
    return sep.join(w[:1].upper() + w[1:] for w in c.split("_"))


@register("normalize_names", with_stages("citations", "SELECT " + ", ".join(
    f'{c} AS "{_title(c, "_")}"' for c in CITATION_COLUMNS) + " FROM citations"))
def q_normalize_names(spark, sf_dir):
    """Export-style names with spaces ('Street Code1') -> underscores."""
    return C.normalize_names(C.to_title_names(fixture(spark, sf_dir), sep=" "))


KEPT_AFTER_DROP = [c for c in CITATION_COLUMNS if c not in K.DROP_COLUMNS]


@register("drop_columns", with_stages("citations", f"SELECT {_cols(KEPT_AFTER_DROP)} FROM citations"))
def q_drop_columns(spark, sf_dir):
    return C.drop_columns(fixture(spark, sf_dir), K.DROP_COLUMNS)


@register("struct_flatten", """
    SELECT event_id, event_type, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events""")
def q_struct_flatten(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    parsed = ev.select("event_id", "event_type", F.from_json("props", "k bigint").alias("data"))
    return C.flatten_struct(parsed, "data", keep=["event_id", "event_type"])


@register("json_parse", """
    SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS absent
    FROM events""")
def q_json_parse(spark, sf_dir):
    """Text fields: a number token is kept as its text; a missing field is null."""
    ev = read_table(spark, sf_dir, "events")
    return M.parse_json_column(ev, "props", ["k", "absent"], keep=["event_id"])


@register("bulk_cast", with_stages("citations", "SELECT " + ", ".join(
    f"try_cast({c} AS DOUBLE) AS {c}" for c in CITATION_COLUMNS) + " FROM citations"))
def q_bulk_cast(spark, sf_dir):
    return C.cast_all(fixture(spark, sf_dir), "double")


@register("blank_to_null", with_stages("citations", "SELECT " + ", ".join(
    (f"nullif({c}, '') AS {c}" if c in STRING_COLS else c) for c in CITATION_COLUMNS)
    + " FROM citations"))
def q_blank_to_null(spark, sf_dir):
    return C.blank_to_null_all(fixture(spark, sf_dir))


@register("clamp_hour", with_stages("citations", """
    SELECT summons_number, violation_time,
           try_cast(substring(violation_time, 1, 2) AS DOUBLE) AS hour_raw,
           CASE WHEN try_cast(substring(violation_time, 1, 2) AS DOUBLE) <= 0.0
                  OR try_cast(substring(violation_time, 1, 2) AS DOUBLE) > 12.0 THEN CAST(1.0 AS DOUBLE)
                ELSE try_cast(substring(violation_time, 1, 2) AS DOUBLE) END AS time_hour
    FROM citations"""))
def q_clamp_hour(spark, sf_dir):
    src = fixture(spark, sf_dir)
    return src.select("summons_number", "violation_time", hour_of("violation_time").alias("hour_raw"),
                      clamp_hour(hour_of("violation_time")).alias("time_hour"))


@register("time_features", with_stages("featured", """
    SELECT summons_number, issue_date, violation_time, month, year, day, meridiem, time_hour
    FROM featured"""))
def q_time_features(spark, sf_dir):
    st = stages(spark, sf_dir)["featured"]
    return st.select("summons_number", "issue_date", "violation_time", "month", "year", "day",
                     "meridiem", "time_hour")


@register("date_parts", with_stages("featured", "SELECT summons_number, issue_date, month, year FROM featured"))
def q_date_parts(spark, sf_dir):
    src = fixture(spark, sf_dir)
    return src.select("summons_number", "issue_date", month_of("issue_date").alias("month"),
                      year_of("issue_date").alias("year"))


@register("weekday_feature", with_stages("featured", "SELECT summons_number, issue_date, day FROM featured"))
def q_weekday_feature(spark, sf_dir):
    src = fixture(spark, sf_dir)
    return src.select("summons_number", "issue_date",
                      weekday_of("issue_date").cast("double").alias("day"))


@register("safe_cast", with_stages("citations", """
    SELECT summons_number,
           try_cast(registration_state AS INTEGER) AS state_code,
           try_cast(plate_type AS INTEGER) AS plate_code,
           try_cast(violation_time AS DOUBLE) AS time_number
    FROM citations"""))
def q_safe_cast(spark, sf_dir):
    src = fixture(spark, sf_dir)
    return src.select("summons_number",
                      F.col("registration_state").try_cast("int").alias("state_code"),
                      F.col("plate_type").try_cast("int").alias("plate_code"),
                      F.col("violation_time").try_cast("double").alias("time_number"))


# ---------------------------------------------------------------- filters

@register("year_range_filter", with_stages("year_filtered", "SELECT summons_number, issue_date, year FROM year_filtered"))
def q_year_range_filter(spark, sf_dir):
    return stages(spark, sf_dir)["year_filtered"].select("summons_number", "issue_date", "year")


@register("sentinel_filter", with_stages("citations", """
    SELECT * FROM citations
    WHERE registration_state <> '99' AND plate_type <> '999' AND violation_county <> '103'"""))
def q_sentinel_filter(spark, sf_dir):
    return drop_sentinels(fixture(spark, sf_dir), K.SENTINEL_VALUES)


@register("dropna_subset", with_stages("citations", "SELECT * FROM citations WHERE violation_county IS NOT NULL"))
def q_dropna_subset(spark, sf_dir):
    return dropna_subset(fixture(spark, sf_dir), [K.TARGET])


@register("dropna_any", with_stages("citations", "SELECT * FROM (SELECT " + ", ".join(
    (f"nullif({c}, '') AS {c}" if c in STRING_COLS else c) for c in CITATION_COLUMNS)
    + " FROM citations) WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in CITATION_COLUMNS)))
def q_dropna_any(spark, sf_dir):
    return dropna_any(C.blank_to_null_all(fixture(spark, sf_dir)))


# ---------------------------------------------------------------- scalar functions

@register("canonicalize_values", with_stages("citations", """
    SELECT summons_number, violation_county AS county_raw,
      regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        violation_county, 'KINGS', 'K', 'g'), 'QUEEN', 'Q', 'g'), 'BRONX', 'BX', 'g'),
        'RC', 'R', 'g'), 'RICH', 'R', 'g'), 'NYC', 'NY', 'g') AS violation_county
    FROM citations"""))
def q_canonicalize_values(spark, sf_dir):
    src = fixture(spark, sf_dir)
    return src.select("summons_number", F.col(K.TARGET).alias("county_raw"),
                      canonicalize(K.TARGET).alias(K.TARGET))


# ---------------------------------------------------------------- profiling

@register("row_count", with_stages("cleaned", "SELECT count(*) AS n FROM cleaned"))
def q_row_count(spark, sf_dir):
    return P.row_count(cleaned(spark, sf_dir))


def _share_sql(stage: str, col: str) -> str:
    return with_stages(stage, f"""
        SELECT {col}, count(*) AS count,
               (CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE)) * 100 AS percentage
        FROM {stage} GROUP BY {col}""")


# (query suffix, stage the report reads, column) in the order of the original profiling
VALUE_SHARES = [
    ("year", "featured", "year"),
    ("meridiem", "year_filtered", "meridiem"),
    ("time_hour", "meridiem_nulled", "time_hour"),
    ("registration_state", "hour_fixed", "registration_state"),
    ("plate_type", "state_filtered", "plate_type"),
    ("violation_county_raw", "plate_filtered", "violation_county"),
    ("month", "cleaned", "month"),
    ("violation_county", "cleaned", "violation_county"),
]


def _share_query(stage: str, col: str):
    def q(spark, sf_dir):
        return P.value_share(stages(spark, sf_dir)[stage], col)
    return q


for _suffix, _stage, _col in VALUE_SHARES:
    register(f"value_share_{_suffix}", _share_sql(_stage, _col))(_share_query(_stage, _col))


def _describe_sql(c: str) -> str:
    if c in NUMERIC_CLEANED:
        x = f"CAST({c} AS DOUBLE)"
        return (f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS stddev, "
                f"min({x}) AS min, max({x}) AS max, CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM cleaned")
    return (f"SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, min(CAST({c} AS VARCHAR)), max(CAST({c} AS VARCHAR)) FROM cleaned")


@register("describe_stats", with_stages("cleaned", "\nUNION ALL\n".join(
    _describe_sql(c) for c in sorted(K.CLEANED_COLUMNS, key=lambda c: c not in NUMERIC_CLEANED))))
def q_describe_stats(spark, sf_dir):
    """All 18 cleaned columns, numbers and text."""
    return P.describe_stats(cleaned(spark, sf_dir))


def _audit_sql(c: str) -> str:
    if c in STRING_COLS:
        return (f"count_if(contains({c}, 'None') OR contains({c}, 'NULL') OR {c} = '' "
                f"OR {c} IS NULL) AS {c}")
    return f"count_if({c} IS NULL) AS {c}"


@register("missing_audit", with_stages("citations", "SELECT " + ", ".join(
    _audit_sql(c) for c in CITATION_COLUMNS) + " FROM citations"))
def q_missing_audit(spark, sf_dir):
    """Audit of the raw export (the cleaned table audits to all zeros; see tests)."""
    return P.missing_audit(fixture(spark, sf_dir))


def _observed_sql(stage: str, name: str, cols) -> str:
    audits = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {_audit_sql(c).rsplit(' AS ', 1)[0]} AS missing, count(*) AS n_rows FROM {stage}" for c in cols)
    return f"SELECT '{name}' AS stage, * FROM ({audits})"


@register("clean_observed", with_stages("cleaned", _observed_sql("citations", "raw", CITATION_COLUMNS) + " UNION ALL "
                                        + _observed_sql("cleaned", "cleaned", K.CLEANED_COLUMNS)))
def q_clean_observed(spark, sf_dir):
    """Rows and missing values of the raw and the cleaned table, gathered while the clean is written."""
    from citeflow.plans.jobs import clean_observed
    from citeflow.sources.tables import write_parquet
    return clean_observed(fixture(spark, sf_dir), lambda df: write_parquet(df, scratch_path(spark, "observed")))[1]


@register("column_corr", with_stages("blanks_nulled", """
    SELECT round(corr(coalesce(CAST(violation_location AS DOUBLE), 0.0),
                      coalesce(CAST(violation_precinct AS DOUBLE), 0.0)), 10) AS corr
    FROM blanks_nulled"""))
def q_column_corr(spark, sf_dir):
    return P.column_corr(stages(spark, sf_dir)["blanks_nulled"], "violation_location",
                         "violation_precinct")


@register("column_corr_pairwise", with_stages("blanks_nulled", """
    SELECT round(corr(CAST(violation_location AS DOUBLE), CAST(violation_precinct AS DOUBLE)), 10) AS corr
    FROM blanks_nulled"""))
def q_column_corr_pairwise(spark, sf_dir):
    return P.column_corr(stages(spark, sf_dir)["blanks_nulled"], "violation_location",
                         "violation_precinct", nulls_as_zero=False)


@register("schema_table", with_stages("cleaned", """
    SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name,
           CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
                WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' ELSE lower(column_type) END
             AS data_type,
           CAST(count(*) OVER () AS INTEGER) AS n_columns, (SELECT count(*) FROM cleaned) AS n_rows
    FROM (DESCRIBE SELECT * FROM cleaned)"""))
def q_schema_table(spark, sf_dir):
    return P.schema_table(cleaned(spark, sf_dir))


def _fraction_sql(c: str) -> str:
    miss = f"{c} IS NULL OR {c} = ''" if c in STRING_COLS else f"{c} IS NULL"
    return (f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {miss} THEN 1.0 ELSE 0.0 END), 6) "
            f"AS missing_fraction FROM citations")


@register("missing_fraction", with_stages("citations", "\nUNION ALL\n".join(
    _fraction_sql(c) for c in CITATION_COLUMNS)))
def q_missing_fraction(spark, sf_dir):
    return P.missing_fraction(fixture(spark, sf_dir))


# ---------------------------------------------------------------- sort / limit / split

@register("limit_n", with_stages("cleaned", f"SELECT * FROM cleaned ORDER BY {ALL_CLEANED} LIMIT 100"))
def q_limit_n(spark, sf_dir):
    return limit_stable(cleaned(spark, sf_dir), 100)


@register("topk_desc", with_stages("cleaned", "SELECT * FROM cleaned ORDER BY violation_code DESC, "
                                   + ", ".join(c for c in K.CLEANED_COLUMNS if c != "violation_code")
                                   + " LIMIT 10"))
def q_topk_desc(spark, sf_dir):
    return top_k(cleaned(spark, sf_dir), 10, "violation_code")


@register("split_train_test", with_stages("cleaned_keyed", f"""
    SELECT summons_number, violation_county,
           CASE WHEN {SPLIT_SQL} < 1 THEN 'test' ELSE 'train' END AS split
    FROM cleaned_keyed"""))
def q_split_train_test(spark, sf_dir):
    df = key_split(cleaned_keyed(spark, sf_dir), split_key(), buckets=5, test_buckets=1,
                   split_col="split")
    return df.select("summons_number", K.TARGET, "split")


# ---------------------------------------------------------------- category index

def _index_sql(cols, stage="cleaned_keyed") -> str:
    unions = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n "
        f"FROM {stage} WHERE {c} IS NOT NULL GROUP BY {c}" for c in cols)
    return with_stages(stage, f"""
        SELECT column_name, value, n,
               CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) - 1 AS DOUBLE) AS idx
        FROM ({unions})""")


def _whole(spark, sf_dir):
    """All rows of the written cleaned table (model building starts from the processed
    table, as in the original; it also keeps the optimizer's work on the index plan
    independent of how the raw columns were derived)."""
    from citeflow.plans.batch_job import materialized_clean
    return materialized_clean(spark, sf_dir)


@register("category_index", _index_sql(K.CATEGORY_COLUMNS))
def q_category_index(spark, sf_dir):
    """Frequency-ranked index of the 14 category columns over all cleaned rows."""
    return frequency_index(_whole(spark, sf_dir), K.CATEGORY_COLUMNS)


@register("label_index", _index_sql([K.TARGET]))
def q_label_index(spark, sf_dir):
    return frequency_index(_whole(spark, sf_dir), [K.TARGET])


# ---------------------------------------------------------------- features and models

def _index_join_sql(columns: str | None = None, tail: str = "", fit: str = "true", rows: str = "true") -> str:
    """Rows with every category replaced by its fitted index (unseen -> number of labels),
    plus the label index: the assembled features. ``fit`` and ``rows`` tell which rows the
    index is fitted on and applied to; ``columns`` overrides the output list; ``tail``
    appends ORDER BY / LIMIT."""
    joins, feats = [], []
    for i, c in enumerate(K.CATEGORY_COLUMNS + [K.TARGET]):
        joins.append(f"LEFT JOIN (SELECT value, idx FROM ix WHERE column_name = '{c}') j{i} "
                     f"ON CAST(t.{c} AS VARCHAR) = j{i}.value")
        out = "label" if c == K.TARGET else f"{c}_index"
        feats.append(f"coalesce(j{i}.idx, CAST((SELECT count(*) FROM ix WHERE column_name = '{c}') "
                     f"AS DOUBLE)) AS {out}")
    inner = (f"SELECT t.summons_number, t.month, t.day, t.time_hour, {', '.join(feats)} "
             f"FROM (SELECT * FROM cleaned_keyed WHERE {rows}) t " + " ".join(joins))
    body = f"SELECT {columns or '*'} FROM ({inner}) {tail}"
    return with_stages("cleaned_keyed", f", ix AS ({_index_body(fit)})\n{body}")


TRAIN_SQL, TEST_SQL = f"{SPLIT_SQL} >= 1", f"{SPLIT_SQL} < 1"


def _index_body(fit: str = "true") -> str:
    cols = K.CATEGORY_COLUMNS + [K.TARGET]
    unions = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n "
        f"FROM cleaned_keyed WHERE {fit} AND {c} IS NOT NULL GROUP BY {c}" for c in cols)
    return (f"SELECT column_name, value, n, CAST(row_number() OVER (PARTITION BY column_name "
            f"ORDER BY n DESC, value) - 1 AS DOUBLE) AS idx FROM ({unions})")


def _fitted(spark, sf_dir):
    from citeflow.plans.batch_job import fitted
    return fitted(spark, sf_dir)


def _whole_features(spark, sf_dir):
    """Feature stages fitted on all cleaned rows, once per session and input."""
    from citeflow.operators.models import fit_feature_model
    key = (spark.sparkContext.applicationId, sf_dir, "features")
    if key not in _FEATURES:
        _FEATURES[key] = fit_feature_model(_whole(spark, sf_dir))
    return _FEATURES[key]


_FEATURES: dict[tuple, object] = {}


def _feature_columns(df: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array("features")
    return df.select("summons_number", "label",
                     *[arr[i].alias(name) for i, name in enumerate(K.FEATURES)])


@register("assemble_features", _index_join_sql())
def q_assemble_features(spark, sf_dir):
    """All cleaned rows through the fitted indexers and the 17-slot assembler."""
    return _feature_columns(_whole_features(spark, sf_dir).transform(_whole(spark, sf_dir)))


@register("decode_labels", with_stages("cleaned_keyed", f""", lbl AS ({_index_body()})
    SELECT idx, value AS label FROM lbl WHERE column_name = '{K.TARGET}'
    UNION ALL
    SELECT CAST(count(*) AS DOUBLE) AS idx, CAST(CAST(count(*) AS DOUBLE) AS VARCHAR) AS label
    FROM lbl WHERE column_name = '{K.TARGET}'"""))
def q_decode_labels(spark, sf_dir):
    """Every class index (incl. the keep bucket) decoded through the fitted labels."""
    from citeflow.functions.text import decode_label
    from citeflow.operators.features import label_names
    labels = label_names(_whole_features(spark, sf_dir))
    idx = frequency_index(_whole(spark, sf_dir), [K.TARGET]).select("idx")
    keep = spark.range(1).select(F.lit(float(len(labels))).alias("idx"))
    return idx.unionByName(keep).select("idx", decode_label("idx", labels).alias("label"))


def _predictions(model, test):
    from citeflow.operators.models import score
    return score(model, test).select("summons_number", "label", "prediction", "p_target",
                                     "predicted_label")


INDEX_COLUMNS = [f"{c}_index" for c in K.CATEGORY_COLUMNS]


@register("fit_features", _index_join_sql("summons_number, " + ", ".join(INDEX_COLUMNS) + ", label"))
def q_fit_features(spark, sf_dir):
    """Fitted feature stages applied to all cleaned rows: the 14 category indices and the label."""
    rows = _whole_features(spark, sf_dir).transform(_whole(spark, sf_dir))
    return rows.select("summons_number", *INDEX_COLUMNS, "label")


@register("fit_features_joined", ORACLES["fit_features"])
def q_fit_features_joined(spark, sf_dir):
    """The same table with every category column joined with the stored index, its labels nowhere
    on the driver."""
    from citeflow.operators.models import fit_feature_model
    rows = _whole(spark, sf_dir)
    model = fit_feature_model(rows, joined=K.CATEGORY_COLUMNS)
    return model.transform(rows).select("summons_number", *INDEX_COLUMNS, "label")


@register("train_forest")
def q_train_forest(spark, sf_dir):
    f = _fitted(spark, sf_dir)
    return _predictions(f.forest, f.test)


@register("train_tree")
def q_train_tree(spark, sf_dir):
    f = _fitted(spark, sf_dir)
    return _predictions(f.tree, f.test)


def _county_rank(where: str = "true") -> str:
    return (f"SELECT CAST({K.TARGET} AS VARCHAR) AS county, CAST(row_number() OVER (ORDER BY count(*) DESC, {K.TARGET}) - 1 AS DOUBLE) AS label "
            f"FROM cleaned_keyed WHERE {where} GROUP BY {K.TARGET}")


# a tree that may split on the hour alone, down to single hours, predicts the most
# frequent class of each hour, ties to the class with the smaller index
_BY_HOUR_SQL = with_stages("cleaned_keyed", f""", lbl AS ({_county_rank(TRAIN_SQL)}),
    votes AS (SELECT c.time_hour, l.label, l.county, count(*) AS n FROM cleaned_keyed c JOIN lbl l ON c.{K.TARGET} = l.county
              WHERE {TRAIN_SQL} GROUP BY ALL),
    best AS (SELECT time_hour, label AS prediction, county AS predicted_label,
                    coalesce(max(n) FILTER (WHERE label = {K.TARGET_CLASS}) OVER (PARTITION BY time_hour), 0) / CAST(sum(n) OVER (PARTITION BY time_hour) AS DOUBLE) AS p_target
             FROM votes QUALIFY row_number() OVER (PARTITION BY time_hour ORDER BY n DESC, label) = 1)
    SELECT summons_number, c.time_hour, prediction, predicted_label, round(p_target, 12) AS p_target
    FROM cleaned_keyed c JOIN best b ON c.time_hour = b.time_hour WHERE {TEST_SQL}""")


HOUR = ["time_hour"]


def _by_hour(spark, sf_dir, estimator):
    """The library's own path over the hour alone: features and classifier fitted on the training
    rows, test rows scored."""
    from citeflow.operators.models import fit_feature_model, score, train_model
    from citeflow.plans.batch_job import train_test
    train, test = train_test(spark, sf_dir)
    features = fit_feature_model(train, cols=[], features=HOUR)
    model = train_model(train, features, estimator(features))
    return score(model, test, compile_trees=True)


@register("tree_by_hour", _BY_HOUR_SQL)
def q_tree_by_hour(spark, sf_dir):
    """Decision tree over one continuous feature, deep enough to isolate every hour."""
    from citeflow.operators.models import tree
    return _by_hour(spark, sf_dir, lambda f: tree(f, max_depth=13)).select("summons_number", "time_hour", "prediction", "predicted_label", F.round("p_target", 12).alias("p_target"))


@register("forest_by_hour", _BY_HOUR_SQL)
def q_forest_by_hour(spark, sf_dir):
    """Forest without bootstrap over the same feature: every tree is that tree."""
    from citeflow.operators.models import forest
    return _by_hour(spark, sf_dir, lambda f: forest(f, num_trees=3, max_depth=13, bootstrap=False, subset="all")).select(
        "summons_number", "time_hour", "prediction", "predicted_label", F.round("p_target", 12).alias("p_target"))


@register("classification_metrics", with_stages("cleaned_keyed", f""", lbl AS ({_county_rank()}),
    pred AS (SELECT l.label AS y, CAST(c.time_hour % 7 AS DOUBLE) AS p FROM cleaned_keyed c JOIN lbl l ON c.{K.TARGET} = l.county),
    per AS (SELECT y, count(*) AS actual, count(*) FILTER (WHERE p = y) AS tp FROM pred GROUP BY y),
    got AS (SELECT p, count(*) AS predicted FROM pred GROUP BY p),
    q AS (SELECT actual, tp, CASE WHEN coalesce(predicted, 0) > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0 END AS pr, CAST(tp AS DOUBLE) / actual AS rc
          FROM per LEFT JOIN got ON per.y = got.p),
    m AS (SELECT sum(tp) * 1.0 / sum(actual) AS accuracy, sum(pr * actual) / sum(actual) AS wp, sum(rc * actual) / sum(actual) AS wr,
                 sum((CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END) * actual) / sum(actual) AS f1 FROM q),
    t AS (SELECT 'f1' AS metric, f1 AS v FROM m UNION ALL SELECT 'accuracy', accuracy FROM m
          UNION ALL SELECT 'weightedPrecision', wp FROM m UNION ALL SELECT 'weightedRecall', wr FROM m)
    SELECT metric, round(v, 10) AS value, round(1.0 - v, 10) AS error FROM t"""))
def q_classification_metrics(spark, sf_dir):
    """Metrics of a prediction that SQL can write down: the hour modulo 7 against the county's index."""
    from citeflow.operators.models import classification_metrics
    rows = _whole_features(spark, sf_dir).transform(_whole(spark, sf_dir))
    return classification_metrics(rows.select("label", (F.col("time_hour") % 7).cast("double").alias("prediction")))


@register("batch_score")
def q_batch_score(spark, sf_dir):
    """Forest scores for every cleaned row (train and test)."""
    from citeflow.plans.batch_job import materialized_clean
    f = _fitted(spark, sf_dir)
    return _predictions(f.forest, materialized_clean(spark, sf_dir))


UNSEEN = "a value that no row holds"


@register("batch_score_report", with_stages("cleaned_keyed", "SELECT 2 * count(*) AS n_rows, 0 AS mismatches FROM cleaned_keyed"))
def q_batch_score_report(spark, sf_dir):
    """All cleaned rows, and all of them with values that the indices do not know, scored by the
    compiled forest and by the model itself: rows, and rows that differ in any bit."""
    from citeflow.operators.models import score
    from citeflow.plans.batch_job import materialized_clean
    f = _fitted(spark, sf_dir)
    rows = materialized_clean(spark, sf_dir)
    odd = rows.withColumns({c: F.lit(UNSEEN) if rows.schema[c].dataType.simpleString() == "string" else F.lit(-1).cast(rows.schema[c].dataType)
                            for c in K.CATEGORY_COLUMNS[::2]})
    rows = rows.unionByName(odd)
    keys = ["summons_number", "label", "prediction", "p_target", "predicted_label"]
    return _agreement(score(f.forest, rows, compile_trees=True).select(*keys), score(f.forest, rows, compile_trees=False).select(*keys), keys)


@register("evaluate_model")
def q_evaluate_model(spark, sf_dir):
    from citeflow.plans.batch_job import run_job
    return run_job(spark, sf_dir, models=("random_forest", "decision_tree"))


@register("flagship")
def q_flagship(spark, sf_dir):
    """The packaged job: clean -> index -> fit forest -> score -> evaluate."""
    from citeflow.plans.batch_job import run_job
    return run_job(spark, sf_dir)


FLAGSHIP = "flagship"


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """Save the whole fitted model (overwrite), load it back and score the test rows."""
    from citeflow.sources.models import load_model, save_model
    f = _fitted(spark, sf_dir)
    path = save_model(f.forest, scratch_path(spark, "model"))
    return _predictions(load_model(path), f.test)


def _agreement(one: DataFrame, two: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows of the first table, and rows by which the two tables differ (as bags)."""
    both = one.select(*keys, F.lit(1).alias("one"), F.lit(0).alias("two")).unionByName(
        two.select(*keys, F.lit(0).alias("one"), F.lit(1).alias("two")))
    per = both.groupBy(*keys).agg(F.sum("one").alias("one"), F.sum("two").alias("two"))
    return per.agg(F.sum("one").alias("n_rows"), F.sum(F.abs(F.col("one") - F.col("two"))).alias("mismatches"))


_SAME_SQL = with_stages("cleaned_keyed", f"SELECT count(*) AS n_rows, 0 AS mismatches FROM cleaned_keyed WHERE {TEST_SQL}")


@register("model_roundtrip_report", _SAME_SQL)
def q_model_roundtrip_report(spark, sf_dir):
    """Test rows scored by the fitted model and by its saved and reloaded copy."""
    keys = ["summons_number", "label", "prediction", "p_target", "predicted_label"]
    f = _fitted(spark, sf_dir)
    return _agreement(_predictions(f.forest, f.test), q_model_roundtrip(spark, sf_dir), keys)


@register("stream_batch_report", _SAME_SQL)
def q_stream_batch_report(spark, sf_dir):
    """The same messages scored as a stream and as a batch."""
    from citeflow.streaming.scorer import score_messages
    stream = q_stream_score(spark, sf_dir)
    messages = M.to_messages(index_messages(spark, sf_dir), key=False)
    batch = score_messages(messages, _fitted(spark, sf_dir).forest)
    return _agreement(stream, batch, [*K.FEATURES, "prediction", "predicted_label"])


@register("topk_probability")
def q_topk_probability(spark, sf_dir):
    """Test rows with the highest class-1 probability (distributed top-k)."""
    f = _fitted(spark, sf_dir)
    return top_k(_predictions(f.forest, f.test), 5, "p_target",
                 tie_break=["summons_number", "label", "prediction"])


@register("sample_export", _index_join_sql(
    "summons_number, " + ", ".join(K.FEATURES),
    "ORDER BY " + ", ".join(["summons_number"] + K.FEATURES) + f" LIMIT {K.SAMPLE_EXPORT_ROWS}",
    fit=TRAIN_SQL, rows=TEST_SQL))
def q_sample_export(spark, sf_dir):
    """10,000 test rows with features as doubles, original text columns dropped,
    written as CSV and read back (the message source for the stream job)."""
    f = _fitted(spark, sf_dir)
    rows = f.features.transform(f.test)
    export = limit_stable(rows.select("summons_number", *K.FEATURES), K.SAMPLE_EXPORT_ROWS,
                          order_by=["summons_number"] + K.FEATURES)
    path = write_csv(export, scratch_path(spark, "sample_export"))
    return read_csv(spark, path, schema=export.schema)


# ---------------------------------------------------------------- streaming

def publish_messages(df: DataFrame, path: str) -> str:
    """Rows -> JSON-lines message files (one file per task) in ``path``."""
    M.to_messages(df, key=False).write.mode("overwrite").text(path)
    return path


def index_messages(spark, sf_dir):
    """Test rows as the stream's messages: category indices and numeric features."""
    f = _fitted(spark, sf_dir)
    rows = f.features.transform(f.test)
    return rows.select(*[F.col(c) for c in K.FEATURES])


#: bytes of messages per micro-batch: a batch does not grow with the backlog
STREAM_BATCH_BYTES = str(64 << 20)


@register("stream_score")
def q_stream_score(spark, sf_dir):
    """File-stream source -> parse -> cast -> assemble -> forest -> label text ->
    Parquet sink with checkpoint, drained with an availableNow trigger.

    The backlog is paced into micro-batches of ``STREAM_BATCH_BYTES`` of message files."""
    from citeflow.streaming.scorer import file_message_source, run_available_now, score_messages
    f = _fitted(spark, sf_dir)
    src = publish_messages(index_messages(spark, sf_dir), scratch_path(spark, "messages"))
    sink, ckpt = scratch_path(spark, "scored"), scratch_path(spark, "scored-ckpt")
    scored = score_messages(file_message_source(spark, src, max_bytes_per_trigger=STREAM_BATCH_BYTES), f.forest)
    run_available_now(scored, sink, ckpt)
    return spark.read.parquet(sink)


BAD_EVENT = "event_id % 10 = 3"


@register("stream_invalid", f"""
    SELECT CAST(event_id AS VARCHAR) AS key, CASE WHEN {BAD_EVENT} THEN 'bad' ELSE 'lacks a feature' END AS reason,
           CASE WHEN {BAD_EVENT} THEN 'not json ' || CAST(event_id AS VARCHAR) END AS value
    FROM events WHERE {BAD_EVENT} OR event_id % 10 = 7""")
def q_stream_invalid(spark, sf_dir):
    """Events as scoring messages, some of them broken or without a feature: what the stream's
    second sink holds, by the messages' keys. (The first sink holds all the others.)"""
    from citeflow.streaming.scorer import finish, invalid_messages, score_messages, start_sink
    f = _fitted(spark, sf_dir)
    messages = _mixed_messages(spark, sf_dir)
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    finish([start_sink(score_messages(messages, f.forest, keep=["key"]), good, f"{good}-ckpt", available_now=True),
            start_sink(invalid_messages(messages), bad, f"{bad}-ckpt", available_now=True)])
    if spark.read.parquet(good).count() + spark.read.parquet(bad).count() != read_table(spark, sf_dir, "events").count():
        raise RuntimeError("the two sinks do not hold every message once")
    broken = F.col("value").startswith("not json ")
    return spark.read.parquet(bad).select("key", F.when(broken, "bad").otherwise("lacks a feature").alias("reason"),
                                          F.when(broken, F.col("value")).alias("value"))


@register("stream_routed", f"""
    SELECT CAST(event_id AS VARCHAR) AS key, CASE WHEN {BAD_EVENT} THEN 'bad' WHEN event_id % 10 = 7 THEN 'lacks a feature' ELSE 'scored' END AS outcome,
           1 AS copies FROM events""")
def q_stream_routed(spark, sf_dir):
    """The same messages through one query that reads its source once and writes both sinks: where
    each message is, and how often."""
    from citeflow.streaming.scorer import finish, start_routed_sink
    f = _fitted(spark, sf_dir)
    good, bad = scratch_path(spark, "routed"), scratch_path(spark, "routed-bad")
    finish([start_routed_sink(_mixed_messages(spark, sf_dir), f.forest, good, bad, f"{good}-ckpt", keep=["key"], available_now=True)])
    broken = F.col("value").startswith("not json ")
    rows = (spark.read.parquet(good).select("key", F.lit("scored").alias("outcome"))
            .unionByName(spark.read.parquet(bad).select("key", F.when(broken, "bad").otherwise("lacks a feature").alias("outcome"))))
    return rows.groupBy("key", "outcome").agg(F.count("*").alias("copies"))


def _mixed_messages(spark, sf_dir):
    """A stream of events as scoring messages, some of them broken or without a feature."""
    from citeflow.streaming.scorer import file_message_source
    ev = read_table(spark, sf_dir, "events")
    fields = [(F.col("event_id") % (i + 2)).cast("string").alias(c) for i, c in enumerate(K.FEATURES)]
    lacking = F.to_json(F.struct(*fields[1:]))
    value = (F.when(F.expr(BAD_EVENT), F.concat(F.lit("not json "), F.col("event_id").cast("string")))
             .when(F.col("event_id") % 10 == 7, lacking).otherwise(F.to_json(F.struct(*fields))))
    src = scratch_path(spark, "mixed-messages")
    ev.select(F.to_json(F.struct(F.col("event_id").cast("string").alias("key"), value.alias("value"))).alias("line")).write.text(src)
    source = file_message_source(spark, src, max_bytes_per_trigger=STREAM_BATCH_BYTES)
    return source.select(F.from_json("value", "key string, value string").alias("m")).select("m.*")


@register("stream_scan", """
    SELECT event_id, user_id, event_type, value, ts,
           try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events""")
def q_stream_scan(spark, sf_dir):
    """Events published as JSON messages, read back through a file-stream source
    with an explicit text schema, cast to their types, sunk to Parquet."""
    from citeflow.streaming.scorer import file_message_source, run_available_now
    ev = read_table(spark, sf_dir, "events")
    src = publish_messages(ev, scratch_path(spark, "events-messages"))
    fields = ev.columns
    parsed = M.parse_messages(file_message_source(spark, src), fields)
    typed = parsed.select(
        F.col("event_id").try_cast("bigint").alias("event_id"),
        F.col("user_id").try_cast("bigint").alias("user_id"), "event_type",
        F.col("value").try_cast("double").alias("value"),
        F.col("ts").try_cast("timestamp_ntz").alias("ts"),
        F.from_json("props", "k bigint")["k"].alias("k"))
    sink, ckpt = scratch_path(spark, "events-sink"), scratch_path(spark, "events-ckpt")
    run_available_now(typed, sink, ckpt)
    return spark.read.parquet(sink)


# ---------------------------------------------------------------- attribution

RAW_FEATURES = K.NUMERIC + K.CATEGORY_COLUMNS


EXPLAINED_COLUMNS = ["summons_number", *K.CLEANED_COLUMNS]


def _explained(spark, sf_dir):
    """The first test rows by all columns: their number is the operator's parameter."""
    f = _fitted(spark, sf_dir)
    return limit_stable(f.test.select(*EXPLAINED_COLUMNS), K.EXPLAIN_ROWS)


@register("shapley_attribution")
def q_shapley_attribution(spark, sf_dir):
    """Sampled Shapley values of the forest's class-1 probability for 5 rows at the original's budget:
    50,000 coalitions, each against all 100 background rows."""
    from citeflow.operators.attribution import attribution_table
    f = _fitted(spark, sf_dir)
    return attribution_table(f.forest, _explained(spark, sf_dir), f.train, RAW_FEATURES)


#: weights of an additive score, whose Shapley values are w * (x - mean of the background)
ADDITIVE = {"month": 0.25, "day": -1.5, "time_hour": 2.0}


@register("shapley_additive", with_stages("cleaned_keyed", f""",
    x AS (SELECT row_number() OVER (ORDER BY {_cols(EXPLAINED_COLUMNS)}) AS explained, * FROM
          (SELECT {_cols(EXPLAINED_COLUMNS)} FROM cleaned_keyed WHERE {TEST_SQL} ORDER BY ALL LIMIT {K.EXPLAIN_ROWS})),
    b AS (SELECT month, day, time_hour FROM cleaned_keyed WHERE {TRAIN_SQL} ORDER BY ALL LIMIT {K.BACKGROUND_ROWS}),
    m AS (SELECT avg(month) AS month, avg(day) AS day, avg(time_hour) AS time_hour FROM b)
    """ + " UNION ALL ".join(f"""
    SELECT explained - 1 AS explained, summons_number, '{c}' AS feature, round({w} * (x.{c} - m.{c}) + 0.0, 6) + 0.0 AS phi FROM x, m"""
                              for c, w in ADDITIVE.items())))
def q_shapley_additive(spark, sf_dir):
    """The same operator over an additive score of three features."""
    from citeflow.operators.attribution import background_rows, shapley_values
    from citeflow.operators.sampling import with_row_index
    from citeflow.session import reliable_checkpoint
    f = _fitted(spark, sf_dir)
    rows = reliable_checkpoint(_explained(spark, sf_dir).orderBy(*EXPLAINED_COLUMNS))
    rows = reliable_checkpoint(with_row_index(rows, "explained"))
    score = sum((F.col(c) * w for c, w in ADDITIVE.items()), F.lit(0.0))
    phi = shapley_values(lambda df: df.withColumn("v", score), rows, background_rows(f.train, list(ADDITIVE)),
                         list(ADDITIVE), coalitions=400)
    return (phi.join(rows.select("explained", "summons_number"), "explained")
            .select("explained", "summons_number", "feature", (F.round("phi", 6) + 0.0).alias("phi")))


@register("shapley_exact")
def q_shapley_exact(spark, sf_dir):
    """The rows of ``shapley_attribution`` explained exactly: leaf paths of the forest, no sampling."""
    from citeflow.operators.tree_shapley import exact_attribution_table
    f = _fitted(spark, sf_dir)
    return exact_attribution_table(f.forest, _explained(spark, sf_dir), f.train, RAW_FEATURES)


@register("shapley_exact_report", with_stages("cleaned_keyed", f"SELECT count(*) AS n_rows, 0 AS unequal FROM cleaned_keyed WHERE {TEST_SQL}"))
def q_shapley_exact_report(spark, sf_dir):
    """Every test row explained exactly: rows, and rows whose values do not sum to f(x) - base."""
    from citeflow.operators.tree_shapley import exact_attribution_table
    f = _fitted(spark, sf_dir)
    rows = exact_attribution_table(f.forest, f.test, f.train, RAW_FEATURES)
    gap = F.abs(F.aggregate("shap_values", F.lit(0.0), lambda a, x: a + x) - (F.col("probability") - F.col("base_value")))
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(gap > 1e-9).alias("unequal"))


@register("shapley_exact_by_hour", _BY_HOUR_SQL.replace("SELECT summons_number, c.time_hour, prediction, predicted_label, round(p_target, 12) AS p_target", f"""
    , back AS (SELECT avg(p_target) AS base FROM (SELECT time_hour FROM cleaned_keyed WHERE {TRAIN_SQL} ORDER BY time_hour LIMIT {K.BACKGROUND_ROWS}) x JOIN best USING (time_hour))
    SELECT summons_number, round(p_target, 9) AS probability, round(base, 9) AS base_value, round(p_target - base, 9) + 0.0 AS phi""").replace(
    "JOIN best b ON", "CROSS JOIN back JOIN best b ON"))
def q_shapley_exact_by_hour(spark, sf_dir):
    """The tree over the hour alone, every test row explained: its value is f(x) - base."""
    from citeflow.operators.models import fit_feature_model, train_model, tree
    from citeflow.operators.tree_shapley import exact_attribution_table
    from citeflow.plans.batch_job import train_test
    train, test = train_test(spark, sf_dir)
    features = fit_feature_model(train, cols=[], features=HOUR)
    model = train_model(train, features, tree(features, max_depth=13))
    rows = exact_attribution_table(model, test.select("summons_number", K.TARGET, *HOUR), train, HOUR)
    return rows.select("summons_number", F.round("probability", 9).alias("probability"), F.round("base_value", 9).alias("base_value"),
                       (F.round(F.col("shap_values")[0], 9) + 0.0).alias("phi"))


@register("shapley_kernel")
def q_shapley_kernel(spark, sf_dir):
    """The same rows by the kernel estimator at the original's budget: 50,000 coalitions against 100 rows."""
    from citeflow.operators.kernel_shapley import kernel_attribution_table
    f = _fitted(spark, sf_dir)
    return kernel_attribution_table(f.forest, _explained(spark, sf_dir), f.train, RAW_FEATURES)


#: how far an estimate at the full budget may be from the exact value
KERNEL_TOLERANCE = 0.001


@register("shapley_kernel_report", f"SELECT {K.EXPLAIN_ROWS} AS n_rows, {K.EXPLAIN_ROWS * len(RAW_FEATURES)} AS n_values, 0 AS too_far, 0 AS unequal")
def q_shapley_kernel_report(spark, sf_dir):
    """Kernel estimates against exact values: values further apart than ``KERNEL_TOLERANCE``, and rows
    whose estimates do not sum to f(x) - base."""
    from citeflow.operators.kernel_shapley import kernel_attribution_table
    from citeflow.operators.tree_shapley import exact_attribution_table
    f = _fitted(spark, sf_dir)
    explained = _explained(spark, sf_dir)
    exact = exact_attribution_table(f.forest, explained, f.train, RAW_FEATURES).select(*EXPLAINED_COLUMNS, F.col("shap_values").alias("exact"))
    # keys may repeat; rows that are equal in all columns have equal values
    exact = exact.dropDuplicates(EXPLAINED_COLUMNS)
    rows = kernel_attribution_table(f.forest, explained, f.train, RAW_FEATURES).join(exact, EXPLAINED_COLUMNS)
    far = F.zip_with("shap_values", "exact", lambda a, b: F.when(F.abs(a - b) > KERNEL_TOLERANCE, 1).otherwise(0))
    gap = F.abs(F.aggregate("shap_values", F.lit(0.0), lambda a, x: a + x) - (F.col("probability") - F.col("base_value")))
    return rows.agg(F.count("*").alias("n_rows"), F.sum(F.size("shap_values")).alias("n_values"),
                    F.sum(F.aggregate(far, F.lit(0), lambda a, x: a + x)).alias("too_far"), F.count_if(gap > 1e-9).alias("unequal"))


@register("shapley_kernel_additive", ORACLES["shapley_additive"])
def q_shapley_kernel_additive(spark, sf_dir):
    """The kernel estimator over the additive score: all coalitions of three features, so exact."""
    from citeflow.operators.attribution import background_rows
    from citeflow.operators.kernel_shapley import kernel_values
    from citeflow.operators.sampling import with_row_index
    from citeflow.session import reliable_checkpoint
    f = _fitted(spark, sf_dir)
    rows = reliable_checkpoint(_explained(spark, sf_dir).orderBy(*EXPLAINED_COLUMNS))
    rows = reliable_checkpoint(with_row_index(rows, "explained"))
    score = sum((F.col(c) * w for c, w in ADDITIVE.items()), F.lit(0.0))
    names = list(ADDITIVE)
    phi = kernel_values(lambda df: df.withColumn("v", score), rows, background_rows(f.train, names), names)
    return (phi.join(rows.select("explained", "summons_number"), "explained")
            .select("explained", "summons_number", F.posexplode("phi").alias("at", "phi"))
            .select("explained", "summons_number", F.element_at(F.array(*[F.lit(c) for c in names]), F.col("at") + 1).alias("feature"),
                    (F.round("phi", 6) + 0.0).alias("phi")))


# ---------------------------------------------------------------- synthesis

def _synth_source(spark, sf_dir):
    from citeflow.plans.batch_job import materialized_clean
    return materialized_clean(spark, sf_dir).select(*K.CLEANED_COLUMNS)


def _synth_sql(tail: str) -> str:
    """The draws of ``operators/synthesis`` and the tuple that each falls on, for both batches."""
    from citeflow.operators.synthesis import draw_sql
    ctes = []
    for i, cols in enumerate(K.BATCHES):
        order = ", ".join(f"{c} NULLS FIRST" for c in cols)
        ctes.append(f""", t{i} AS (SELECT {_cols(cols)}, n, sum(n) OVER (ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS hi
            FROM (SELECT {_cols(cols)}, count(*) AS n FROM cleaned GROUP BY ALL)),
            d{i} AS (SELECT draw_id, {draw_sql('draw_id', i, 42)} % (SELECT sum(n) FROM t{i}) AS at FROM range({K.SYNTH_LINES}) r(draw_id)),
            g{i} AS (SELECT d.draw_id, {_cols(cols)} FROM d{i} d JOIN t{i} t ON d.at >= t.hi - t.n AND d.at < t.hi)""")
    return with_stages("cleaned", "".join(ctes) + "\n" + tail)


@register("synthesize_rows", _synth_sql(f"SELECT g0.draw_id, {_cols(K.CLEANED_COLUMNS)} FROM g0 JOIN g1 ON g0.draw_id = g1.draw_id"))
def q_synthesize_rows(spark, sf_dir):
    """2,000 look-alike rows learnt from the whole cleaned table in two column
    batches (joint within a batch, independent across batches)."""
    from citeflow.operators.synthesis import synthesize
    return synthesize(_synth_source(spark, sf_dir), K.BATCHES, K.SYNTH_LINES, seed=42)


@register("synth_quality", _synth_sql(" UNION ALL ".join(
    f"SELECT {i} AS batch, {K.SYNTH_LINES} AS requested, count(*) AS generated, count(*) AS valid, count(*) / {K.SYNTH_LINES}.0 AS valid_fraction FROM g{i}"
    for i in range(len(K.BATCHES)))))
def q_synth_quality(spark, sf_dir):
    """Per batch: requested, generated and valid lines."""
    from citeflow.operators.synthesis import batch_quality, synthesize
    src = _synth_source(spark, sf_dir)
    return batch_quality(synthesize(src, K.BATCHES, K.SYNTH_LINES, seed=42), src, K.BATCHES,
                         K.SYNTH_LINES)


#: columns whose pairs a line must share with some row: two the chain does not draw from one another
VALID_PAIRS = [("plate_type", "vehicle_make"), ("issuer_precinct", "violation_county"), ("meridiem", "violation_county")]


def _chain_sql(tail: str, rounds: int = 1, pairs=()) -> str:
    """The chain of ``operators/chain_synthesis`` in SQL: every column's draw given the two before it, for
    all slots and rounds; then the first valid round of each slot."""
    from citeflow.operators.chain_synthesis import LEAST
    from citeflow.operators.synthesis import draw_sql
    out = [", src AS (SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in K.CLEANED_COLUMNS) + " FROM cleaned)"]
    for i, (a, b) in enumerate(pairs):
        out.append(f", ok{i} AS (SELECT DISTINCT {a} AS a, {b} AS b FROM src)")
    for b, cols in enumerate(K.BATCHES):
        out.append(f", l{b}_0 AS (SELECT draw % {K.SYNTH_LINES} AS slot, draw FROM range({K.SYNTH_LINES * rounds}) r(draw))")
        for k, c in enumerate(cols):
            before = cols[max(0, k - 2):k][::-1]  # the nearest first
            picks, joins = [], []
            for level in range(len(before) + 1):
                keys = before[:level]
                group = ", ".join([*keys, c])
                part = f"PARTITION BY {', '.join(keys)}" if keys else ""
                name = f"t{b}_{k}_{level}"
                out.append(f", {name} AS (SELECT {group}, n, sum(n) OVER ({part}) AS total, sum(n) OVER ({part} ORDER BY {c} NULLS FIRST ROWS UNBOUNDED PRECEDING) - n AS lo"
                           f" FROM (SELECT {group}, count(*) AS n FROM src GROUP BY {group}))")
                if level:
                    same = " AND ".join(f"x{level}.{x} IS NOT DISTINCT FROM d.{x}" for x in keys)
                    joins.append(f"LEFT JOIN (SELECT DISTINCT {', '.join(keys)}, true AS ok FROM {name} WHERE total >= {LEAST}) x{level} ON {same}")
            level_sql = "CASE " + " ".join(f"WHEN x{lv}.ok THEN {lv}" for lv in range(len(before), 0, -1)) + " ELSE 0 END" if before else "0"
            out.append(f", u{b}_{k} AS (SELECT d.*, {draw_sql('d.draw', b * 1000 + k, 42)} AS u, {level_sql} AS level FROM l{b}_{k} d {' '.join(joins)})")
            for level in range(len(before) + 1):
                same = "".join(f" AND t.{x} IS NOT DISTINCT FROM d.{x}" for x in before[:level])
                picks.append(f"SELECT d.* EXCLUDE (u, level), t.{c} FROM u{b}_{k} d JOIN t{b}_{k}_{level} t ON d.level = {level}{same} AND d.u % t.total >= t.lo AND d.u % t.total < t.lo + t.n")
            out.append(f", l{b}_{k + 1} AS ({' UNION ALL '.join(picks)})")
        checks = [f"EXISTS (SELECT 1 FROM ok{i} WHERE ok{i}.a IS NOT DISTINCT FROM l.{x} AND ok{i}.b IS NOT DISTINCT FROM l.{y})"
                  for i, (x, y) in enumerate(pairs) if x in cols and y in cols]
        out.append(f", v{b} AS (SELECT *, {' AND '.join(checks) or 'true'} AS valid FROM l{b}_{len(cols)} l)")
        out.append(f", g{b} AS (SELECT * FROM v{b} WHERE valid QUALIFY row_number() OVER (PARTITION BY slot ORDER BY draw) = 1)")
    return with_stages("cleaned", "".join(out) + "\n" + tail)


def _as_text(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, *[F.col(c).cast("string").alias(c) for c in K.CLEANED_COLUMNS])


@register("synthesize_chain", _chain_sql(f"SELECT g0.slot AS draw_id, {_cols(K.CLEANED_COLUMNS)} FROM g0 JOIN g1 ON g0.slot = g1.slot"))
def q_synthesize_chain(spark, sf_dir):
    """2,000 rows by the conditional chain, each column given the two before it: rows that need not
    exist in the source (values as text)."""
    from citeflow.operators.chain_synthesis import synthesize_valid
    return _as_text(synthesize_valid(_synth_source(spark, sf_dir))[0], "draw_id")


@register("synth_unseen", _chain_sql(" UNION ALL ".join(
    f"SELECT {b} AS batch, count(*) AS generated, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM src WHERE "
    + " AND ".join(f"src.{c} IS NOT DISTINCT FROM g{b}.{c}" for c in cols) + f")) AS unseen FROM g{b}" for b, cols in enumerate(K.BATCHES))))
def q_synth_unseen(spark, sf_dir):
    """Per batch: lines that the chain made, and those that no source row holds."""
    from citeflow.operators.chain_synthesis import synthesize_valid, unseen_share
    src = _synth_source(spark, sf_dir)
    return unseen_share(synthesize_valid(src)[0], src)


@register("synth_status", _chain_sql(" UNION ALL ".join(
    f"SELECT {b} AS batch, {K.SYNTH_LINES} AS requested, {K.SYNTH_LINES} + redrawn AS generated, valid, redrawn, {K.SYNTH_LINES} - valid AS short FROM "
    f"(SELECT count(*) AS valid FROM g{b}), (SELECT coalesce(sum(CASE WHEN first IS NULL THEN 3 ELSE first // {K.SYNTH_LINES} END), 0) AS redrawn FROM "
    f"(SELECT slot, min(draw) FILTER (WHERE valid) AS first FROM v{b} GROUP BY slot))" for b in range(len(K.BATCHES))), 4, VALID_PAIRS))
def q_synth_status(spark, sf_dir):
    """Per batch: lines requested, generated in all rounds, valid, drawn again, and still short after
    four rounds, with a validator over pairs of columns."""
    from citeflow.operators.chain_synthesis import pair_validator, synthesize_valid
    src = _synth_source(spark, sf_dir)
    return synthesize_valid(src, pair_validator(src, VALID_PAIRS))[1]


@register("synthesize_valid", _chain_sql(f"SELECT g0.slot AS draw_id, {_cols(K.CLEANED_COLUMNS)} FROM g0 JOIN g1 ON g0.slot = g1.slot", 4, VALID_PAIRS))
def q_synthesize_valid(spark, sf_dir):
    """Rows of the chain that the validator accepts, invalid lines drawn again up to four times."""
    from citeflow.operators.chain_synthesis import pair_validator, synthesize_valid
    src = _synth_source(spark, sf_dir)
    return _as_text(synthesize_valid(src, pair_validator(src, VALID_PAIRS))[0], "draw_id")
