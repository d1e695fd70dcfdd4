"""Parsing by shape against the layouts' own formatters."""

import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wattline.contracts import TIMESTAMP_FORMATS
from wattline.functions.timefmt import parse_timestamp

ODD = ["", " ", "2012-01-01", "2012-01-01 00:00", "2012-1-1 00:00", "2012-02-30 10:00", "2012-02-29 10:00", "2013-02-29 10:00",
       "2012-13-01 00:00", "2012-00-10 00:00", "2012-12-31 24:00", "2012-12-31 23:60", "2012-12-31 23:59:59", "2012-12-31 23:59:60",
       "31/12/2012 23:59", "31/12/2012 23:59:59", "12/31/2012 00:00", "31/12/12 00:00", "2012/12/31 00:00", "31-12-2012 00:00",
       "0000-01-01 00:00", "0001-01-01 00:00", "9999-12-31 23:59", "12012-01-01 00:00", "+2012-01-01 00:00", "-2012-01-01 00:00",
       " 2012-01-01 00:00", "2012-01-01 00:00 ", "2012-01-01  00:00", "2012-01-01T00:00", "2012-01-01 00:00:00.5",
       "2012-01-01 00:00Z", "2012-01-01 00:00 UTC", "2012-01-01 0:00", "01/01/0000 00:00", "01/01/0001 00:00", None,
       "2012-03-25 02:30", "\u0662\u0660\u0661\u0662-01-01 00:00", "2012-01-01 00:00\n", "x2012-01-01 00:00"]


def both(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    slow = F.coalesce(*[F.try_to_timestamp("t", F.lit(f)) for f in TIMESTAMP_FORMATS]).cast("timestamp_ntz")
    # As text: Python's datetime cannot hold every year.
    return df.select("t", parse_timestamp("t").cast("string").alias("fast"), slow.cast("string").alias("slow")).collect()


def agree(r):
    """The shapes take four digits as a year, the formatters also a signed year: that is no reading's date."""
    if r.t and re.search(r"(^|/)[+-][0-9]", r.t):
        return r.fast is None
    return r.fast == r.slow


def test_odd_spellings(spark):
    assert all(agree(r) for r in both(spark, ODD))
    assert sum(r.fast is not None for r in both(spark, ODD)) >= 8


def test_generated_spellings(spark):
    part = st.integers(0, 99).map(lambda n: f"{n:02d}")
    near = st.integers(0, 13).map(lambda n: f"{n:02d}")
    year = st.integers(1, 9999).map(lambda n: f"{n:04d}")
    found = []

    @given(st.one_of(st.builds(lambda y, m, d, h, i: f"{y}-{m}-{d} {h}:{i}", year, near, part, part, part),
                     st.builds(lambda y, m, d, h, i, s: f"{d}/{m}/{y} {h}:{i}:{s}", year, near, near, near, near, near),
                     st.text("0123456789-/: ", max_size=20)))
    @settings(max_examples=600, deadline=None, database=None)
    def collect(text):
        found.append(text)

    collect()
    for r in both(spark, found):
        assert agree(r), r
