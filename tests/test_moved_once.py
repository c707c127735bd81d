"""Upserts whose live set and file are alike in size move each row once."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerline.operators import upsert
from ledgerline.sources import registers

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["natural_upsert_live", "natural_upsert_history", "upsert_counters"])
def test_rows_are_dealt_out_once(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(invoice_no") == plan.count("Exchange hashpartitioning") == 2  # the early rows and the later ones
    assert "Join" not in plan and plan.count("Scan parquet") == 2


@pytest.mark.parametrize("seed", range(3))
def test_the_window_cuts_as_the_join_does(spark, seed):
    r = random.Random(seed)
    live = [(r.choice("abcdefg"), h, str(i)) for i, h in enumerate("xyzuvw")] + [(None, "x", "9")]  # keys may stand twice
    rows = [(r.choice(["a", "b", "c", None]), i, h) for i, h in enumerate("xyzuvwst")]
    day = F.lit("2024-01-01").cast("date")
    old = spark.createDataFrame(live, "k string, row_hash string, id string").withColumns({"valid_from": day, "valid_to": F.lit("9999-12-31").cast("date")})
    new = spark.createDataFrame(rows, "k string, line int, row_hash string").withColumn("valid_from", F.date_add(day, F.col("line") + 1))
    once = old.where(F.col("id").isin([x[2] for x in {x[0]: x for x in live}.values()]))
    for incoming in (new, new.limit(0)):
        a, b = (sorted(map(str, upsert.natural(incoming, once, ["k"], small=small).collect())) for small in (True, False))
        assert a == b
    kept = [{x.live_id for x in upsert.natural(new, old, ["k"], small=small).collect() if x.live_id} for small in (True, False)]
    assert kept[0] == kept[1]


def test_columns_under_the_hash_make_no_groups(spark):
    rows = spark.createDataFrame([("f", 2, "h", "p"), ("f", 1, "h", "p"), ("f", 3, "i", None), ("f", 4, "i", None)], "path string, line int, row_hash string, party string")
    both = [sorted(map(tuple, registers.collapsed(rows, hashed=hashed).collect())) for hashed in ((), ("party",))]
    assert both[0] == both[1] == [("f", 1, "h", "p", 2), ("f", 3, "i", None, 2)]
