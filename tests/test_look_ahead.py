"""A load that another has overtaken sees it before it computes anything, and a file is collapsed once."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import load, upsert
from ledgerline.sources import commitlog
from ledgerline.sources.commitlog import Conflict
from ledgerline.sources.store import TenantStore
from tests.test_commits import _row
from tests.test_load import HEAD, files, up


def test_an_overtaken_load_stages_nothing(spark, tmp_path):
    one, two, three = (TenantStore(spark, str(tmp_path), "acme") for _ in range(3))
    one.attempt("b1"), two.attempt("b2"), three.attempt("b3")
    load.load(one, files(spark, f"{HEAD}\n{_row('B1')}\n{_row('B2')}"), up("PURCHASE_REGISTER", 1))
    out = load.load(two, files(spark, f"{HEAD}\n{_row('B1', '2024-04-09', 7)}"), up("PURCHASE_REGISTER", 2))
    assert out.counts["superseded"] == 1
    names = one.log.files.names
    assert len(names(f"{one.path}/silver/purchase_register")) == 2 and not names(f"{one.path}/work")
    load.load(three, files(spark, f"{HEAD}\n{_row('B9')}"), up("PURCHASE_REGISTER", 3))  # other keys: nothing is done again
    assert len(names(f"{one.path}/silver/purchase_register")) == 3


def test_look_ahead_asks_for_keys_and_spares_its_own_batch(spark, tmp_path):
    store, late = TenantStore(spark, str(tmp_path), "acme"), TenantStore(spark, str(tmp_path), "acme")
    keys = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k string")
    late.attempt("b"), late.attempt("a")
    store.stage_live("t", "a", ["k"], keys("x", None).withColumns({"id": F.col("k"), "removed": F.lit(False)}))
    assert late.live_size("t", "b") == 0 and store.commit("a") and store.live_size("t", "c") == 2
    late.look_ahead("t", "b", keys("y"), ["k"])
    late.look_ahead("u", "b", keys("x"), ["k"])
    late.look_ahead("t", "a", keys("x"), ["k"])  # publish finds that it is there
    for k in ("x", None):
        with pytest.raises(Conflict):
            late.attempt("b")
            late._attempts["b"].state = commitlog.State()
            late.look_ahead("t", "b", keys(k), ["k"])


def test_only_a_small_file_cuts_the_live_set_by_a_join(spark, tmp_path, monkeypatch):
    asked, touching = [], upsert.touching
    monkeypatch.setattr(upsert, "touching", lambda *a: asked.append(1) or touching(*a))
    store = TenantStore(spark, str(tmp_path), "acme")
    rows = "\n".join(_row(f"B{i}") for i in range(12))
    load.load(store, files(spark, f"{HEAD}\n{rows}"), up("PURCHASE_REGISTER", 1))
    again = load.load(store, files(spark, f"{HEAD}\n{rows}\n{_row('C')}"), up("PURCHASE_REGISTER", 2))
    assert not asked and (again.counts["unchanged"], again.counts["inserted"]) == (12, 1)
    small = load.load(store, files(spark, f"{HEAD}\n{_row('B3', '2024-04-20', 9)}"), up("PURCHASE_REGISTER", 3))
    assert asked and (small.counts["superseded"], small.counts["inserted"]) == (1, 0)
