"""The ``citations`` table derived from TESTDATA ``lineitem``.

A projection of ``lineitem`` with planted dirt (sentinels, blanks, nulls, county
aliases, malformed dates and times) in the column layout of a raw citation export.
The expressions are written in SQL common to Spark and DuckDB, so the same text
builds the Spark DataFrame (``selectExpr``: a narrow, shuffle-free projection of the
scan) and the DuckDB oracle CTE. The table grows linearly with ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citeflow.sources.tables import read_table

CITATION_EXPRESSIONS: list[tuple[str, str]] = [
    ("summons_number", "l_orderkey*10+l_linenumber"),
    ("registration_state",
     "case when l_orderkey%41=0 then '99' when l_orderkey%43=0 then '' "
     "else concat('S',cast(l_suppkey%50 as varchar(10))) end"),
    ("plate_type", "case when l_partkey%47=0 then '999' when l_partkey%3=0 then 'COM' else 'PAS' end"),
    ("issue_date",
     "case when l_partkey%101=0 then 'bad' else concat(lpad(cast(month(l_shipdate) as varchar(2)),2,'0'),'/',"
     "lpad(cast(day(l_shipdate) as varchar(2)),2,'0'),'/',cast(2011+l_suppkey%5 as varchar(4))) end"),
    ("violation_code", "cast(l_quantity as int)"),
    ("vehicle_body_type", "concat('B',cast(l_partkey%7 as varchar(2)))"),
    ("vehicle_make", "case when l_partkey%53=0 then null else concat('M',cast(l_partkey%60 as varchar(3))) end"),
    ("issuing_agency", "l_returnflag"),
    ("street_code1", "cast(l_suppkey as int)"),
    ("street_code2", "cast(l_partkey%500 as int)"),
    ("street_code3", "cast(l_orderkey%500 as int)"),
    ("violation_location", "case when l_orderkey%29=0 then null else cast(l_suppkey%77 as int) end"),
    ("violation_precinct", "cast(l_suppkey%77 as int)"),
    ("issuer_precinct", "cast(l_suppkey%80 as int)"),
    ("issuer_command", "concat('T',cast(l_suppkey%30 as varchar(3)))"),
    ("violation_time",
     "case when l_partkey%97=0 then null when l_partkey%89=0 then '' when l_partkey%83=0 then "
     "concat(lpad(cast(l_orderkey%24 as varchar(2)),2,'0'),'30') else "
     "concat(lpad(cast(l_orderkey%14 as varchar(2)),2,'0'),lpad(cast(l_partkey%60 as varchar(2)),2,'0'),"
     "case when l_linenumber%2=0 then 'A' else 'P' end) end"),
    ("violation_county",
     "case l_orderkey%14 when 0 then 'NY' when 1 then 'NYC' when 2 then 'K' when 3 then 'KINGS' "
     "when 4 then 'Q' when 5 then 'QUEEN' when 6 then 'QUEENS' when 7 then 'BX' when 8 then 'BRONX' "
     "when 9 then 'R' when 10 then 'RC' when 11 then 'RICH' when 12 then '103' else null end"),
    ("violation_in_front_of_or_opposite", "case when l_linestatus='F' then 'F' else 'O' end"),
]

CITATION_COLUMNS = [name for name, _ in CITATION_EXPRESSIONS]


def citations_sql(source: str = "lineitem") -> str:
    """The fixture as a SELECT over ``source`` (used verbatim in oracle CTEs)."""
    cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in CITATION_EXPRESSIONS)
    return f"SELECT\n  {cols}\nFROM {source}"


def citations_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Spark form: one narrow projection, so column pruning reaches the scan."""
    return lineitem.selectExpr(*[f"{expr} AS {name}" for name, expr in CITATION_EXPRESSIONS])


# the lineitem columns the fixture reads
SOURCE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_returnflag", "l_linestatus", "l_shipdate"]


def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations_from_lineitem(read_table(spark, sf_dir, "lineitem", columns=SOURCE_COLUMNS))
