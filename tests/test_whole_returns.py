"""Returns refiled with one figure changed."""

import copy
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import load, views
from ledgerline.sources import returns
from ledgerline.sources.store import TenantStore
from tests.test_documents import TWO_B
from tests.test_load import up

BOX = {"txval": 1, "iamt": 1, "camt": 1, "samt": 1, "csamt": 1}
FOUR = {k: v for k, v in BOX.items() if k != "txval"}
THREE_B = {
    "gstin": "29A", "ret_period": "042024", "arn": "A", "filing_date": "20-05-2024", "filing_status": "Filed",
    "sup_details": {k: dict(BOX) for k in ("osup_det", "osup_zero", "osup_nil_exmp", "isup_rev", "osup_nongst")},
    "itc_elg": {"itc_avl": [{"ty": "OTH", **FOUR}], "itc_net": dict(FOUR)}, "inward_sup": {"isup_details": [{"ty": "GST", "inter": 1, "intra": 1}, {"ty": "NONGST", "inter": 1, "intra": 1}]}, "intr_ltfee": {"intr_details": dict(FOUR)},
}


def leaves(x, at=()):
    for k, v in x.items() if isinstance(x, dict) else enumerate(x):
        yield from leaves(v, (*at, k)) if isinstance(v, (dict, list)) else [(*at, k)]


def changed(payload, at, value):
    out = inner = copy.deepcopy(payload)
    for k in at[:-1]:
        inner = inner[k]
    inner[at[-1]] = value
    return out


def hashes(spark, payloads, schema, parse):
    rows = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)], "path int, value string").coalesce(1)
    heads, *_, refused = parse(rows.select("path", F.from_json("value", schema).alias("p")), F.lit("2024-04-01").cast("date"))
    assert refused.count() == 0
    return [r.row_hash for r in heads.orderBy("path").collect()]


def test_every_field_of_a_3b_counts(spark):
    fixed = {"gstin", "ret_period", "ty"}
    new = {"arn": "B", "filing_date": "21-05-2024", "filing_status": "Late"}
    all_ = [changed(THREE_B, at, new.get(at[-1], 2)) for at in leaves(THREE_B) if at[-1] not in fixed]
    found = hashes(spark, [THREE_B, *all_, THREE_B], returns.GSTR_3B, returns.gstr_3b)
    assert len(all_) == 3 + 25 + 4 + 4 + 4 + 4 and len(set(found)) == len(all_) + 1 and found[0] == found[-1]


def test_every_field_of_a_2b_counts(spark):
    base = copy.deepcopy(TWO_B)
    docs = base["data"]["docdata"]
    docs["b2b"][0] |= {"supprd": "042024", "supfileddt": "11-05-2024", "supfilingmode": "A"}
    docs["b2b"][0]["inv"][0] |= {"typ": "R", "pos": "29", "rev": "N", "rsn": "P", "irn": "x", "irngendate": "03-04-2024", "diffprcnt": "1"}
    docs["impg"][0] |= {"refdt": "05-04-2024", "isamd": "N"}
    docs["isd"][0] |= {"trdnm": "U", "doctype": "ISDI"}
    dates = {"supfileddt", "irngendate", "refdt", "idt", "boedt", "docdt"}
    all_ = [changed(base, at, "01-01-2024" if at[-1] in dates else 77 if at[-1] in ("num", "rt", "val", "txval", "igst", "cgst", "sgst", "cess") else "Z") for at in leaves(base) if at[1] in ("docdata", "itcsumm")]
    found = hashes(spark, [base, *all_, base], returns.GSTR_2B, returns.gstr_2b)
    assert len(set(found)) == len(all_) + 1 and found[0] == found[-1]


@pytest.mark.parametrize("kind, payload, at", [("GSTR_3B", THREE_B, ("inward_sup", "isup_details", 1, "intra")), ("GSTR_2B", TWO_B, ("data", "itcsumm", "itcnotavl", "x", "igst"))])
def test_refiled_returns_supersede(spark, tmp_path, kind, payload, at):
    store = TenantStore(spark, str(tmp_path), "acme")
    for i, p in enumerate((payload, changed(payload, at, 5))):
        (tmp_path / f"in{i}").mkdir()
        (tmp_path / f"in{i}" / "r.json").write_text(json.dumps(p))
    assert load.load(store, str(tmp_path / "in0"), up(kind, 1)).status == "ACCEPTED"
    assert load.load(store, str(tmp_path / "in0"), up(kind, 2)).status == "UNCHANGED"
    assert load.load(store, str(tmp_path / "in1"), up(kind, 3)).counts["superseded"] == 1
    if kind == "GSTR_3B":
        live = views.view(store, "v1_gstr_3b_inward_supply").where("superseded_at is null").orderBy("at").collect()
        assert [(r.supply_type, int(r.inter_state_amount), int(r.intra_state_amount)) for r in live] == [("GST", 1, 1), ("NONGST", 1, 5)]
        head = views.view(store, "v1_gstr_3b").where("superseded_at is null").first()
        assert (head.filing_status, head.filing_date, int(head.isup_rev_igst), int(head.interest_cess), int(head.outward_cess)) == ("Filed", dt.date(2024, 5, 20), 1, 1, 1)
    else:
        line = views.view(store, "v1_gstr_2b_line").where("superseded_at is null and section = 'IMPG'").first()
        assert line.port_code == "P"
