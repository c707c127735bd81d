"""Wide projections are written under a limit that lets the JVM compile them, and the session's own setting comes back."""

import pytest
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.queries import QUERIES

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_held_rows_are_written_under_the_limit(spark, monkeypatch):
    seen, inner = [], session.scratch
    before = spark.conf.get(LIMIT)
    assert session.held(spark.range(3)).count() == 3 and spark.conf.get(LIMIT) == before
    with session.wide_rows(spark):
        seen.append(spark.conf.get(LIMIT))
    assert seen == ["8000"] and spark.conf.get(LIMIT) == before and session.scratch is inner
    with pytest.raises(Exception, match="no such row"):
        session.held(spark.range(1).select(F.raise_error(F.lit("no such row")).cast("int").alias("x")))
    assert spark.conf.get(LIMIT) == before


def test_collapsing_shuffles_what_is_asked_for(spark):
    plan = QUERIES["collapse_duplicates"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "cess" not in plan and "l_linenumber" in plan
