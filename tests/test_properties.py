"""Property tests against brute-force Python on small generated inputs."""

from hypothesis import given, settings
from hypothesis import strategies as st

from citeflow.constants import COUNTY_RULES
from citeflow.functions import canonicalize, clamp_hour

ALPHABET = "KINGSQUEBROXCHY0123 "


def _chain(value):
    if value is None:
        return None
    for pattern, replacement in COUNTY_RULES:
        value = value.replace(pattern, replacement)
    return value


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=12)), min_size=1, max_size=40))
def test_canonicalize_equals_sequential_replace(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = [r[0] for r in df.select(canonicalize("c")).collect()]
    assert got == [_chain(v) for v in values]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-30, 30, allow_nan=False)), min_size=1, max_size=40))
def test_clamp_equals_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "h double")
    got = [r[0] for r in df.select(clamp_hour("h")).collect()]
    assert got == [None if v is None else (1.0 if v <= 0 or v > 12 else v) for v in values]
