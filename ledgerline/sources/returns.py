"""Portal return JSON: GSTR-2B and GSTR-3B (S-05, S-06, P-18 to P-20, U-09's hashes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import coerce, fiscal, hashing

_N = "decimal(18,2)"
_TAX = f"igst:{_N},cgst:{_N},sgst:{_N},cess:{_N}"
GSTR_2B = (
    "data struct<gstin:string,rtnprd:string,version:string,gendt:string,docdata:struct<"
    f"b2b:array<struct<ctin:string,trdnm:string,supprd:string,supfileddt:string,supfilingmode:string,inv:array<struct<inum:string,typ:string,idt:string,val:{_N},pos:string,rev:string,itcavl:string,rsn:string,irn:string,irngendate:string,diffprcnt:string,items:array<struct<num:int,rt:decimal(6,3),txval:{_N},{_TAX}>>>>>>,"
    "cdnr:array<map<string,string>>,"
    f"impg:array<struct<boenum:string,boedt:string,refdt:string,portcode:string,isamd:string,txval:{_N},igst:{_N},cess:{_N}>>,"
    f"isd:array<struct<ctin:string,trdnm:string,doctype:string,docnum:string,docdt:string,{_TAX}>>>,"
    f"itcsumm:struct<itcavl:map<string,struct<{_TAX}>>,itcnotavl:map<string,struct<{_TAX}>>>>"
)
_BOX = f"struct<txval:{_N},iamt:{_N},camt:{_N},samt:{_N},csamt:{_N}>"
_TY = f"array<struct<ty:string,iamt:{_N},camt:{_N},samt:{_N},csamt:{_N}>>"
GSTR_3B = (
    "gstin string, ret_period string, arn string, filing_date string, filing_status string, "
    f"sup_details struct<osup_det:{_BOX},osup_zero:{_BOX},osup_nil_exmp:{_BOX},isup_rev:{_BOX},osup_nongst:{_BOX}>, "
    "inter_sup struct<unreg_details:array<map<string,string>>,comp_details:array<map<string,string>>,uin_details:array<map<string,string>>>, "
    f"itc_elg struct<itc_avl:{_TY},itc_rev:{_TY},itc_inelg:{_TY},itc_net:struct<iamt:{_N},camt:{_N},samt:{_N},csamt:{_N}>>, "
    f"inward_sup struct<isup_details:array<struct<ty:string,inter:{_N},intra:{_N}>>>, "
    f"intr_ltfee struct<intr_details:struct<iamt:{_N},camt:{_N},samt:{_N},csamt:{_N}>>"
)
#: The kinds that a 3B box may hold.
BOXES = {"itc_avl": ("IMPG", "IMPS", "ISRC", "ISD", "OTH"), "itc_rev": ("RUL", "OTH"), "itc_inelg": ("RUL", "OTH"), "isup": ("GST", "NONGST")}


def payloads(spark: SparkSession, path: str, schema: str, glob: str = "*.json") -> DataFrame:
    """One row per file: path, payload (null when it isn't JSON of this form)."""
    text = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path, wholetext=True)
    return text.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", schema).alias("p"))


def _once(rows: DataFrame) -> DataFrame:
    """The payload as a column of its own (explode), so that a field isn't parsed from the text again for each use."""
    return rows.withColumn("p", F.explode(F.array("p")))


def _day(c: Column) -> Column:
    return coerce.any_date(c)


#: Columns of a 2B line that only some sections have, in the order of the line's hash.
_MORE = {
    "document_type": "string", "document_value": _N, "place_of_supply": "string", "reverse_charge": "string", "itc_unavailable_reason": "string", "supplier_filed_period": "string", "supplier_filed_date": "date", "supplier_filing_mode": "string",
    "irn": "string", "irn_date": "date", "differential_percent": "string", "reference_date": "date", "port_code": "string", "is_amended": "string",
}


def _more(**own: Column) -> list[Column]:
    return [own.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in _MORE.items()]


def _hashes(lines: DataFrame, order: Column, name: str) -> DataFrame:
    """(path, name): the hashes of a file's lines in order; ``h`` is the last field of ``order``."""
    return lines.groupBy("path").agg(F.transform(F.sort_array(F.collect_list(order)), lambda x: x.h).alias(name))


def _all(*names: str) -> Column:
    return F.concat(*[F.coalesce(n, F.array().cast("array<string>")) for n in names])


def gstr_2b(rows: DataFrame, period: Column) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Statements, document lines (B2B, IMPG and ISD as one union), the stored summary, and refusals.

    rows: path, p (GSTR_2B). A wrong period or a section that isn't verified (cdnr) refuses the file.
    """
    rows = _once(rows)
    d = F.col("p.data")
    reason = (
        F.when(d.isNull() | d.gstin.isNull(), "not a GSTR-2B payload")
        .when(~d.rtnprd.eqNullSafe(fiscal.return_period(period)), "return period differs")
        .when(F.size(F.coalesce(d.docdata.cdnr, F.array())) > 0, "unverified section: cdnr")
    )
    seen = rows.withColumn("reason", reason)
    good = seen.where("reason is null").select("path", d.alias("d"))
    base = good.select("path", F.col("d.gstin").alias("gstin"), F.col("d.rtnprd").alias("rtnprd"), "d")
    inv = base.select("path", "gstin", F.explode("d.docdata.b2b").alias("s")).select("path", "gstin", "s", F.explode("s.inv").alias("i"))
    b2b = inv.select("path", "gstin", "s", "s.ctin", "s.trdnm", "i", F.explode("i.items").alias("x")).select(
        "path", "gstin", F.lit("B2B").alias("section"), "ctin", "trdnm", F.col("i.inum").alias("doc_number"), _day(F.col("i.idt")).alias("doc_date"),
        F.col("x.num").alias("line_number"), F.col("x.rt").alias("gst_rate"), F.col("x.txval").alias("taxable_value"), "x.igst", "x.cgst", "x.sgst", "x.cess", F.col("i.itcavl").alias("itc_available"),
        *_more(
            document_type=F.col("i.typ"), document_value=F.col("i.val"), place_of_supply=F.col("i.pos"), reverse_charge=F.col("i.rev"), itc_unavailable_reason=F.col("i.rsn"), supplier_filed_period=F.col("s.supprd"),
            supplier_filed_date=_day(F.col("s.supfileddt")), supplier_filing_mode=F.col("s.supfilingmode"), irn=F.col("i.irn"), irn_date=_day(F.col("i.irngendate")), differential_percent=F.col("i.diffprcnt"),
        ),
    )
    none = lambda t: F.lit(None).cast(t)
    impg = base.select("path", "gstin", F.explode("d.docdata.impg").alias("x")).select(
        "path", "gstin", F.lit("IMPG").alias("section"), none("string").alias("ctin"), none("string").alias("trdnm"), F.col("x.boenum").alias("doc_number"), _day(F.col("x.boedt")).alias("doc_date"),
        F.lit(1).alias("line_number"), none("decimal(6,3)").alias("gst_rate"), F.col("x.txval").alias("taxable_value"), "x.igst", none(_N).alias("cgst"), none(_N).alias("sgst"), "x.cess", none("string").alias("itc_available"),
        *_more(reference_date=_day(F.col("x.refdt")), port_code=F.col("x.portcode"), is_amended=F.col("x.isamd")),
    )
    isd = base.select("path", "gstin", F.explode("d.docdata.isd").alias("x")).select(
        "path", "gstin", F.lit("ISD").alias("section"), "x.ctin", "x.trdnm", F.col("x.docnum").alias("doc_number"), _day(F.col("x.docdt")).alias("doc_date"),
        F.lit(1).alias("line_number"), none("decimal(6,3)").alias("gst_rate"), none(_N).alias("taxable_value"), "x.igst", "x.cgst", "x.sgst", "x.cess", none("string").alias("itc_available"),
        *_more(document_type=F.col("x.doctype")),
    )
    lines = b2b.unionByName(impg).unionByName(isd)
    parts = [base.select("path", "gstin", F.lit(kind).alias("availability"), F.explode(f"d.itcsumm.{box}").alias("category", "x")) for kind, box in (("AVAILABLE", "itcavl"), ("NOT_AVAILABLE", "itcnotavl"))]
    summary = parts[0].unionByName(parts[1]).select("path", "gstin", "availability", "category", "x.igst", "x.cgst", "x.sgst", "x.cess")
    line_hash = hashing.row_hash("section", "ctin", "trdnm", "doc_number", "doc_date", "line_number", "gst_rate", "taxable_value", "igst", "cgst", "sgst", "cess", "itc_available", *_MORE)
    hashes = _hashes(lines, F.struct("section", F.coalesce("ctin", F.lit("")).alias("ctin"), "doc_number", "line_number", line_hash.alias("h")), "hs")
    totals = _hashes(summary, F.struct("availability", "category", hashing.row_hash("availability", "category", "igst", "cgst", "sgst", "cess").alias("h")), "ts")
    statements = base.join(hashes, "path", "left").join(totals, "path", "left").select("path", "gstin", "rtnprd", _day(F.col("d.gendt")).alias("generated_on"), hashing.document_hash(hashing.row_hash("gstin", "rtnprd"), _all("hs", "ts")).alias("row_hash"))
    return statements, lines, summary, seen.where("reason is not null").select("path", "reason")


def _checked_3b(rows: DataFrame, period: Column) -> DataFrame:
    rows = _once(rows)
    p = F.col("p")
    some = lambda c: F.size(F.coalesce(c, F.array())) > 0
    stray = lambda box, allowed: F.exists(F.coalesce(p.itc_elg[box].ty, F.array()), lambda t: ~F.coalesce(t.isin(*allowed), F.lit(False)))
    reason = (
        F.when(p.isNull() | p.gstin.isNull(), "not a GSTR-3B payload")
        .when(~p.ret_period.eqNullSafe(fiscal.return_period(period)), "return period differs")
        .when(some(p.inter_sup.unreg_details) | some(p.inter_sup.comp_details) | some(p.inter_sup.uin_details), "unverified section: inter_sup")
        .when(stray("itc_avl", BOXES["itc_avl"]) | stray("itc_rev", BOXES["itc_rev"]) | stray("itc_inelg", BOXES["itc_inelg"]), "unknown ty")
        .when(F.exists(F.coalesce(p.inward_sup.isup_details.ty, F.array()), lambda t: ~F.coalesce(t.isin(*BOXES["isup"]), F.lit(False))), "unknown ty")
    )
    return rows.withColumn("reason", reason)


#: Statement columns from the amounts of a box: prefix -> (box, whether it has a taxable value).
_AMOUNTS = {
    "outward": ("sup_details.osup_det", True), "osup_zero": ("sup_details.osup_zero", True), "osup_nil_exempt": ("sup_details.osup_nil_exmp", True), "isup_rev": ("sup_details.isup_rev", True), "osup_nongst": ("sup_details.osup_nongst", True),
    "itc_net": ("itc_elg.itc_net", False), "interest": ("intr_ltfee.intr_details", False),
}
_HEADS = {"igst": "iamt", "cgst": "camt", "sgst": "samt", "cess": "csamt"}


def inward_supply(rows: DataFrame, period: Column) -> DataFrame:
    """A GSTR-3B's inward supplies, a line for each of their kinds. rows: path, p (GSTR_3B); refused files have none."""
    good = _checked_3b(rows, period).where("reason is null")
    found = good.select("path", F.col("p.gstin").alias("gstin"), F.posexplode("p.inward_sup.isup_details").alias("at", "x"))
    return found.select("path", "gstin", "at", F.col("x.ty").alias("supply_type"), F.col("x.inter").alias("inter_state_amount"), F.col("x.intra").alias("intra_state_amount"))


def gstr_3b(rows: DataFrame, period: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Statements, detail lines of boxes 4A, 4B and 4D as one union, and refusals. rows: path, p (GSTR_3B)."""
    seen = _checked_3b(rows, period)
    good = seen.where("reason is null")
    boxes = [F.struct(F.lit(name).alias("box"), F.col(f"p.itc_elg.{box}").alias("xs")) for name, box in (("4A", "itc_avl"), ("4B", "itc_rev"), ("4D", "itc_inelg"))]
    details = good.select("path", F.col("p.gstin").alias("gstin"), F.explode(F.array(*boxes)).alias("b")).select("path", "gstin", "b.box", F.posexplode("b.xs").alias("at", "x")).select("path", "gstin", "box", "at", "x.ty", "x.iamt", "x.camt", "x.samt", "x.csamt")
    hashes = _hashes(details, F.struct("box", "at", hashing.row_hash("box", "ty", "iamt", "camt", "samt", "csamt").alias("h")), "hs")
    inward = _hashes(inward_supply(rows, period), F.struct("at", hashing.row_hash(F.lit("inward"), "supply_type", "inter_state_amount", "intra_state_amount").alias("h")), "ws")
    amounts = {f"{name}_{head}": F.col(f"p.{box}.{of}") for name, (box, taxable) in _AMOUNTS.items() for head, of in (({"taxable_value": "txval"} if taxable else {}) | _HEADS).items()}
    statements = good.select(
        "path", F.col("p.gstin").alias("gstin"), F.col("p.ret_period").alias("ret_period"), F.col("p.arn").alias("arn"), _day(F.col("p.filing_date")).alias("filing_date"), F.col("p.filing_status").alias("filing_status"),
        *[c.alias(name) for name, c in amounts.items()],
    )
    own = hashing.row_hash("gstin", "ret_period", "arn", "filing_date", "filing_status", *amounts)
    statements = statements.join(hashes, "path", "left").join(inward, "path", "left").withColumn("row_hash", hashing.document_hash(own, _all("hs", "ws"))).drop("hs", "ws")
    return statements, details, seen.where("reason is not null").select("path", "reason")
