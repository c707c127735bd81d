"""Queries over files, documents, returns and checks: they build the operators' inputs from the driver's tables and call the operators.

The input of a query is text as it arrives (CSV, NDJSON, JSON payloads, pages), made
by column expressions from a table; its SQL says what must come out of it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions import coerce, hashing, text
from ledgerline.operators import archetypes, documents, load, matching, readers, recon, upsert, views
from ledgerline.plans import catalogue
from ledgerline.plans.contracts import CONTRACTS
from ledgerline.plans.dispatch import AD_BANKS
from ledgerline.plans.registers import BY_TABLE, SALES_HEADER, SALES_LINE
from ledgerline.queries import MONEY, PURCHASES, purchases, query, t
from ledgerline.session import held, scratch
from ledgerline.sources import bronze, intake, registers, returns
from ledgerline.sources.store import TenantStore


def text_of(name: str | Column) -> Column:
    return (F.col(name) if isinstance(name, str) else name).cast("string")


def _files(rows: DataFrame, by: Column, order: Column, line: Column, head: str | None) -> DataFrame:
    """(path, content): the lines of each file in order. A file holds one nation's or part's rows, a bounded number in these tables."""
    lines = rows.select(by.cast("string").alias("path"), F.struct(order.alias("o"), line.alias("line")).alias("x"))
    body = lines.groupBy("path").agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x.line), "\n").alias("body"))
    return body.select("path", F.concat(F.lit(head + "\n" if head else ""), F.col("body")).cast("binary").alias("content"))


_PLACED = "row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey)"


# files (S-01 to S-04, S-09, S-11, S-13)


@query(f"SELECT s_nationkey::VARCHAR AS path, ({_PLACED} + 1)::INT AS line, s_suppkey::VARCHAR AS id, 'a, \"' || s_name || '\"' || chr(10) || 'b' AS name FROM supplier")
def csv_cells(spark, sf):
    """S-01: quoted cells hold commas, quotes and line ends; records are counted."""
    cell = F.concat(F.lit('"a, ""'), F.col("s_name"), F.lit('""\nb"'))
    files = _files(t(spark, sf, "supplier"), F.col("s_nationkey"), F.col("s_suppkey"), F.concat_ws(",", text_of("s_suppkey"), cell), "id,name")
    out = registers.cells(files, ["id", "name"])
    return out.select("path", "line", F.col("cells")["id"].alias("id"), F.col("cells")["name"].alias("name"))


@query(f"""SELECT s_nationkey::VARCHAR AS path, {_PLACED}::INT AS line, CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey::VARCHAR END AS id, CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 3 = 0 THEN 'true' END AS flag,
  CASE WHEN s_suppkey % 5 = 0 THEN 'not JSON' END AS problem FROM supplier""")
def ndjson_cells(spark, sf):
    """S-02: a bad line is a problem of its row; numbers and booleans become text."""
    good = F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 3 == 0, True).alias("flag")))
    line = F.when(F.col("s_suppkey") % 5 == 0, "{oops").otherwise(good)
    files = _files(t(spark, sf, "supplier"), F.col("s_nationkey"), F.col("s_suppkey"), line, None)
    out = registers.cells(files, ["id"], "NDJSON")
    return out.select("path", "line", F.col("cells")["id"].alias("id"), F.col("cells")["flag"].alias("flag"), "problem")


@query(f"SELECT s_nationkey::VARCHAR AS path, ({_PLACED} + 1)::INT AS line, s_suppkey::VARCHAR AS doc_number FROM supplier WHERE s_nationkey % 2 = 0 UNION ALL SELECT DISTINCT s_nationkey::VARCHAR, NULL::INT, 'missing columns: doc_number' FROM supplier WHERE s_nationkey % 2 = 1")
def transaction_cells(spark, sf):
    """S-04: header names are trimmed and lower-cased; a file that lacks a column is refused whole."""
    s = t(spark, sf, "supplier")
    even = _files(s.where("s_nationkey % 2 = 0"), F.col("s_nationkey"), F.col("s_suppkey"), text_of("s_suppkey"), " Doc_Number ")
    odd = _files(s.where("s_nationkey % 2 = 1"), F.col("s_nationkey"), F.col("s_suppkey"), text_of("s_suppkey"), "number")
    out = registers.cells(even.unionByName(odd), ["doc_number"], lower=True)
    return out.select("path", "line", F.coalesce("fatal", F.col("cells")["doc_number"]).alias("doc_number"))


@query("""WITH r AS (SELECT o_custkey % 5 AS path, o_orderkey, row_number() OVER (PARTITION BY o_custkey % 5 ORDER BY o_orderkey) + 1 AS line, o_orderdate::DATE AS d, o_totalprice::DECIMAL(18,2) AS v FROM orders)
  SELECT path::VARCHAR AS path, line::INT AS line, 'P' || o_orderkey AS payment_ref, d AS payment_date, v AS amount, NULL AS message FROM r WHERE o_orderkey % 7 <> 0
  UNION ALL SELECT path::VARCHAR, line::INT, NULL, NULL, NULL, 'payment_date: not a date: 31/12/2024' FROM r WHERE o_orderkey % 7 = 0""")
def register_file(spark, sf):
    """S-01, P-17, U-16: a payment register is read whole; bad rows are refused one by one."""
    o = t(spark, sf, "orders")
    day = F.when(F.col("o_orderkey") % 7 == 0, "31/12/2024").otherwise(F.to_date("o_orderdate").cast("string"))
    line = F.concat_ws(",", day, F.col("o_totalprice").cast(MONEY).cast("string"), F.lit(""), F.lit(""), F.lit(""), F.concat(F.lit("P"), text_of("o_orderkey")), F.lit(" "))
    good, bad, _ = registers.read(spark, _files(o, F.col("o_custkey") % 5, F.col("o_orderkey"), line, ",".join(BY_TABLE["payment_register"].names)), BY_TABLE["payment_register"])
    none = lambda kind: F.lit(None).cast(kind)
    return good.select("path", "line", "payment_ref", "payment_date", "amount", none("string").alias("message")).unionByName(bad.select("path", F.col("source_line").alias("line"), none("string").alias("payment_ref"), none("date").alias("payment_date"), none(MONEY).alias("amount"), "message"))


@query("SELECT o_custkey AS ref, CASE WHEN bool_or(o_orderkey % 4 = 0) THEN min(CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey || '.json' END) WHEN bool_or(o_orderkey % 4 = 1) THEN min(CASE WHEN o_orderkey % 4 = 1 THEN o_orderkey || '.csv' END) ELSE min(o_orderkey || '.pdf') END AS name FROM orders WHERE o_orderkey % 4 < 3 GROUP BY 1")
def preferred_files(spark, sf):
    """S-09: one file a reference: JSON before CSV before PDF, then by name; others don't count."""
    ext = F.element_at(F.array(*[F.lit(x) for x in (".json", ".csv", ".pdf", ".txt")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    name = F.concat(text_of("o_orderkey"), ext)
    listing = t(spark, sf, "orders").select(F.col("o_custkey").alias("ref"), name.alias("name"), F.concat(F.lit("in/29A/042024/"), name).alias("path"))
    return intake.preferred(listing, "29A", "042024").select("ref", "name")


@query("SELECT s_suppkey, CASE WHEN s_nationkey >= 20 THEN 'UNKNOWN_TYPE' WHEN s_nationkey % 3 = 0 THEN 'OUT_OF_SCOPE' END AS type_refusal, CASE WHEN s_nationkey < 20 THEN 'src' || s_nationkey END AS source_system FROM supplier")
def type_gate(spark, sf):
    """S-11, S-13, J-09: whether a type is known and in scope, and the source of its reference."""
    kinds = t(spark, sf, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("doc_type_code"), (F.col("n_nationkey") % 3 != 0).alias("in_scope"))
    rows = t(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("doc_type_code"), F.col("s_nationkey").alias("ref"))
    gated = intake.type_gate(rows, kinds)
    refs = kinds.select(F.col("doc_type_code").alias("ref"), "doc_type_code", F.concat(F.lit("src"), text_of("doc_type_code")).alias("source_system"))
    known = intake.with_source(gated.select("s_suppkey", "ref"), refs).select("s_suppkey", "source_system")
    return gated.select("s_suppkey", "type_refusal").join(known, "s_suppkey", "left")


@query("SELECT printf('DOC-%06d', d) AS doc_number, k::VARCHAR AS line_number, true AS priced FROM range(500) a(d), range(1, 4) b(k)")
def mock_transactions(spark, sf):
    """S-23: whose rows each have a price and one of the four rates."""
    rows = registers.mock_transactions(spark, 500)
    return rows.select("doc_number", "line_number", ((F.col("unit_price").cast("double") >= 1000) & F.col("gst_rate").isin("5", "12", "18", "28")).alias("priced"))


# coercions (P-04, P-08, P-10, P-12, P-13, P-25, P-28 to P-30)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 5 = 1 THEN NULL ELSE l_partkey END::INT AS n, CASE WHEN l_partkey % 5 = 0 THEN 0 WHEN l_partkey % 5 = 1 THEN NULL ELSE l_extendedprice END::DECIMAL(18,2) AS or_zero,
  CASE WHEN l_partkey % 5 <> 2 THEN (l_partkey % 90000 + 1000)::VARCHAR END AS hsn, CASE WHEN l_partkey % 5 <> 3 THEN l_quantity END::DECIMAL(6,3) AS rate, l_partkey % 5 IN (1, 2, 3) AS bad, CASE WHEN l_partkey % 5 = 4 THEN 'USD' ELSE 'INR' END AS currency FROM lineitem""")
def cell_coercions(spark, sf):
    """P-04, P-08, P-10, P-13, P-25."""
    k = F.col("l_partkey") % 5
    whole = F.when(k == 1, "1.5").otherwise(text_of("l_partkey"))
    amount = F.when(k == 0, "  ").when(k == 1, "x").otherwise(text_of(F.col("l_extendedprice").cast(MONEY)))
    code = F.when(k == 2, "12").otherwise(text_of(F.col("l_partkey") % 90000 + 1000))
    rate = F.when(k == 3, "100.5").otherwise(text_of(F.col("l_quantity").cast("decimal(6,3)")))
    (n, bad_n), (hsn, bad_hsn), (r, bad_rate) = coerce.attribute("int", whole), coerce.attribute("hsn", code), coerce.attribute("rate", rate)
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", n.alias("n"), coerce.number_or_zero(amount).alias("or_zero"), hsn.alias("hsn"), r.alias("rate"), (bad_n | bad_hsn | bad_rate).alias("bad"), coerce.currency(F.when(k == 4, "USD").otherwise(" ")).alias("currency"))


@query("""SELECT o_orderkey AS line, 'itc_eligibility' AS column_name, o_orderpriority AS value, 'INVALID' AS violation FROM orders WHERE o_orderpriority <> '1-URGENT'
  UNION ALL SELECT max(o_orderkey), 'o_custkey', o_custkey::VARCHAR, 'CONFLICT' FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def broken_rules(spark, sf):
    """P-28, P-30: values outside the closed vocabulary of a table, and keys that exist."""
    o = t(spark, sf, "orders")
    rows = o.select(F.col("o_orderkey").alias("line"), F.when(F.col("o_orderpriority") == "1-URGENT", "ELIGIBLE").otherwise(F.col("o_orderpriority")).alias("itc_eligibility"))
    outside = documents.outside_vocabulary(rows, "purchase_register").withColumn("violation", documents.violation(F.lit(False), F.lit(True)))
    keys = o.groupBy("o_custkey").agg(F.max("o_orderkey").alias("line"), F.count(F.lit(1)).alias("n"))
    again = keys.withColumn("violation", documents.violation(F.col("n") > 1, F.lit(False))).where("violation is not null")
    return outside.unionByName(again.select("line", F.lit("o_custkey").alias("column_name"), text_of("o_custkey").alias("value"), "violation"))


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'counterparty_gstin: required' ELSE 'counterparty_gstin: wrong shape' END AS problem FROM supplier WHERE s_suppkey % 3 <> 2""")
def party_rules(spark, sf):
    """P-11, P-12: a required party without a number, and numbers of a wrong shape."""
    raw = F.when(F.col("s_suppkey") % 3 == 0, " ").when(F.col("s_suppkey") % 3 == 1, "29 aaaaa").otherwise("29 aaaaa0000a1z5")
    cells = F.from_json(F.to_json(F.struct(raw.alias("counterparty_gstin"))), "map<string,string>")
    rows = t(spark, sf, "supplier").select("s_suppkey", cells.alias("cells"))
    problems = documents.transaction_rows(rows, CONTRACTS["PURCHASE_REGISTER"]).select("s_suppkey", "problems")
    return problems.select("s_suppkey", F.explode(F.filter("problems", lambda p: F.startswith(p, F.lit("counterparty_gstin")))).alias("problem"))


# header/line documents (P-08 to P-17, A-01, Q-02)

_TXN = """
n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax) AS rn FROM lineitem),
c AS (SELECT l_orderkey, l_partkey, l_orderkey % 50 AS path, CASE WHEN l_orderkey % 50 = 3 THEN least(rn, 2) ELSE rn END AS line_number, l_extendedprice::DECIMAL(18,2) AS v, l_orderkey * 100 + rn AS line FROM n),
twice AS (SELECT path, l_orderkey, line_number, min(line) AS line FROM c GROUP BY ALL HAVING count(*) > 1),
wrong AS (SELECT path, line, 'hsn_sac: not a hsn: 1' AS message FROM c WHERE path = 7 AND l_partkey % 3 = 0
  UNION ALL SELECT path, line, 'line_number: given twice: ' || line_number FROM twice)"""


def _transactions(spark, sf):
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax")
    x = t(spark, sf, "lineitem").withColumn("rn", F.row_number().over(order))
    number = F.when(F.col("l_orderkey") % 50 == 3, F.least("rn", F.lit(2))).otherwise(F.col("rn"))  # file 3 gives numbers twice
    hsn = F.when((F.col("l_orderkey") % 50 == 7) & (F.col("l_partkey") % 3 == 0), "1").otherwise(" 8471 ")
    pairs = {
        "doc_number": F.concat(F.lit("D"), text_of("l_orderkey")), "doc_date": F.lit("03/04/2024"), "line_number": text_of(number), "hsn_sac": hsn, "quantity": F.lit("1"), "unit_price": F.lit("1"),
        "taxable_value": text_of(F.col("l_extendedprice").cast(MONEY)), "gst_rate": text_of((F.col("l_tax") * 100).cast("decimal(6,3)")), "place_of_supply": F.lit("29"), "cgst_amount": F.lit(" "), "igst_amount": F.lit("2.50"),
    }
    cells = F.map_from_arrays(F.array(*[F.lit(k) for k in pairs]), F.array(*pairs.values()))
    rows = x.select((F.col("l_orderkey") % 50).alias("path"), (F.col("l_orderkey") * 100 + F.col("rn")).alias("line"), cells.alias("cells"))
    return documents.transactions(rows, CONTRACTS["SALES_REGISTER"], hold=held)


@query(f"""WITH {_TXN} SELECT path, 'D' || l_orderkey AS doc_number, sum(v)::DECIMAL(18,2) AS total_taxable_value, (2.5 * count(*))::DECIMAL(18,2) AS total_tax_value, (sum(v) + 2.5 * count(*))::DECIMAL(18,2) AS total_value,
  count(*)::BIGINT AS row_count, min(line) AS first_line, DATE '2024-04-03' AS doc_date, '29' AS place_of_supply FROM c WHERE path NOT IN (SELECT path FROM wrong) GROUP BY path, l_orderkey""")
def transaction_documents(spark, sf):
    return _transactions(spark, sf)[0].select("path", "doc_number", "total_taxable_value", "total_tax_value", "total_value", "row_count", "first_line", "doc_date", "place_of_supply")


@query(f"WITH {_TXN} SELECT path, line, message FROM wrong")
def transaction_problems(spark, sf):
    return _transactions(spark, sf)[2].select("path", "line", "message")


_SALE = """
s AS (SELECT o_orderkey // 2 % 40 AS path, o_orderkey * 2 + k AS line, 'S' || (o_orderkey // 2) AS invoice_no, o_orderkey, k, o_totalprice::DECIMAL(18,2) AS v FROM orders, range(2) r(k)),
h AS (SELECT path, invoice_no, count(DISTINCT o_orderkey) AS n, min(line) AS line, count(*) AS c, count(DISTINCT k + 2 * (o_orderkey % 2)) AS lines, count(DISTINCT CASE WHEN path = 3 THEN o_orderkey END) AS irns FROM s GROUP BY ALL),
bad AS (SELECT path, line, 'irn: rows disagree' AS message FROM h WHERE irns > 1)"""


def _sales(spark, sf):
    o = t(spark, sf, "orders").withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    path = F.expr("o_orderkey div 2") % 40
    irn = F.when(path == 3, text_of("o_orderkey")).otherwise("")
    pairs = {"invoice_no": F.concat(F.lit("S"), text_of(F.expr("o_orderkey div 2"))), "invoice_date": F.lit("2024-04-03"), "invoice_type": F.lit("B2B"), "line_number": text_of(F.col("k") + 2 * (F.col("o_orderkey") % 2) + 1), "taxable_value": text_of(F.col("o_totalprice").cast(MONEY)), "irn": irn}
    cells = F.map_from_arrays(F.array(*[F.lit(k) for k in pairs]), F.array(*pairs.values()))
    rows = o.select(path.alias("path"), (F.col("o_orderkey") * 2 + F.col("k")).alias("line"), cells.alias("cells"))
    return documents.sales(registers.typed(rows, SALES_HEADER + SALES_LINE), hold=held)


@query(f"WITH {_SALE} SELECT path, invoice_no, line, c::BIGINT AS row_count, 'INR' AS currency FROM h WHERE path NOT IN (SELECT path FROM bad)")
def sales_documents(spark, sf):
    """S-03, P-15 to P-17."""
    return _sales(spark, sf)[0].select("path", "invoice_no", "line", "row_count", "currency")


@query(f"WITH {_SALE} SELECT path, line, message FROM bad")
def sales_problems(spark, sf):
    return _sales(spark, sf)[2].select("path", "line", "message")


# returns (S-05, S-06, P-18 to P-20, Q-02)


def _payload_3b(spark, sf):
    amount = lambda x: x.cast(MONEY)
    o = t(spark, sf, "orders")
    value = F.col("o_totalprice").cast(MONEY)
    box = lambda base, tax: F.struct(amount(base).alias("txval"), amount(tax).alias("iamt"), amount(F.lit(0)).alias("camt"), amount(F.lit(0)).alias("samt"), amount(F.lit(1)).alias("csamt"))
    credit = lambda ty, tax: F.struct(F.lit(ty).alias("ty"), amount(tax).alias("iamt"), amount(F.lit(0)).alias("camt"), amount(F.lit(0)).alias("samt"), amount(F.lit(0)).alias("csamt"))
    ty = F.when(F.col("o_orderkey") % 9 == 0, "ODD").otherwise("OTH")
    body = F.struct(
        F.concat(F.lit("G"), text_of("o_custkey")).alias("gstin"), F.when(F.col("o_orderkey") % 10 == 3, "052024").otherwise("042024").alias("ret_period"), text_of("o_orderkey").alias("arn"), F.lit("20-05-2024").alias("filing_date"), F.lit("FILED").alias("filing_status"),
        F.struct(box(value, F.lit(5)).alias("osup_det"), box(F.lit(7), F.lit(2)).alias("isup_rev")).alias("sup_details"),
        F.struct(F.array(credit("IMPG", value), F.struct(ty.alias("ty"), amount(F.lit(3)).alias("iamt"), amount(F.lit(0)).alias("camt"), amount(F.lit(0)).alias("samt"), amount(F.lit(0)).alias("csamt"))).alias("itc_avl"), F.array(credit("RUL", F.lit(4))).alias("itc_rev")).alias("itc_elg"),
        F.struct(F.array(F.struct(F.lit("GST").alias("ty"), amount(F.lit(11)).alias("inter"), value.alias("intra"))).alias("isup_details")).alias("inward_sup"),
    )
    return o.select(text_of("o_orderkey").alias("path"), F.from_json(F.to_json(body), returns.GSTR_3B).alias("p"))


_APRIL = "2024-04-01"
_FILED = "f AS (SELECT o_orderkey::VARCHAR AS path, 'G' || o_custkey AS gstin, o_totalprice::DECIMAL(18,2) AS v FROM orders WHERE o_orderkey % 10 <> 3 AND o_orderkey % 9 <> 0)"


@query(f"WITH {_FILED} SELECT path, gstin, '042024' AS ret_period, path AS arn, DATE '2024-05-20' AS filing_date, 'FILED' AS filing_status, v AS outward_taxable_value, 5::DECIMAL(18,2) AS outward_igst, 7::DECIMAL(18,2) AS isup_rev_taxable_value, 2::DECIMAL(18,2) AS isup_rev_igst, 1::DECIMAL(18,2) AS isup_rev_cess FROM f")
def gstr_3b_statements(spark, sf):
    return returns.gstr_3b(_payload_3b(spark, sf), F.lit(_APRIL).cast("date"))[0].select("path", "gstin", "ret_period", "arn", "filing_date", "filing_status", "outward_taxable_value", "outward_igst", "isup_rev_taxable_value", "isup_rev_igst", "isup_rev_cess")


@query(f"WITH {_FILED} SELECT path, '4A' AS box, 0::INT AS at, 'IMPG' AS ty, v AS iamt FROM f UNION ALL SELECT path, '4A', 1, 'OTH', 3 FROM f UNION ALL SELECT path, '4B', 0, 'RUL', 4 FROM f")
def gstr_3b_credits(spark, sf):
    """S-06, P-19: boxes 4A, 4B and 4D as one union."""
    return returns.gstr_3b(_payload_3b(spark, sf), F.lit(_APRIL).cast("date"))[1].select("path", "box", "at", "ty", "iamt")


@query(f"WITH {_FILED} SELECT path, gstin, 'GST' AS supply_type, 11::DECIMAL(18,2) AS inter_state_amount, v AS intra_state_amount FROM f")
def v1_gstr_3b_inward_supply(spark, sf):
    return returns.inward_supply(_payload_3b(spark, sf), F.lit(_APRIL).cast("date")).drop("at")


@query("SELECT o_orderkey::VARCHAR AS path, CASE WHEN o_orderkey % 10 = 3 THEN 'return period differs' ELSE 'unknown ty' END AS reason FROM orders WHERE o_orderkey % 10 = 3 OR o_orderkey % 9 = 0")
def gstr_3b_refusals(spark, sf):
    """P-18, P-20."""
    return returns.gstr_3b(_payload_3b(spark, sf), F.lit(_APRIL).cast("date"))[2]


def _payload_2b(spark, sf):
    money = lambda x: x.cast(MONEY)
    x = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("num"), F.col("l_partkey").alias("part"), F.col("l_extendedprice").cast(MONEY).alias("txval")))).alias("items"))
    items = F.transform("items", lambda i: F.struct(i.num.alias("num"), F.lit(18).cast("decimal(6,3)").alias("rt"), i.txval.alias("txval"), money(F.lit(9)).alias("igst")))
    invoice = F.struct(F.concat(F.lit("I"), text_of("l_orderkey")).alias("inum"), F.lit("05-04-2024").alias("idt"), F.lit("29").alias("pos"), items.alias("items"))
    data = F.struct(
        F.lit("29A").alias("gstin"), F.lit("042024").alias("rtnprd"),
        F.struct(
            F.array(F.struct(F.lit("27B").alias("ctin"), F.array(invoice).alias("inv"))).alias("b2b"),
            F.array(F.struct(F.lit("BE").alias("boenum"), F.lit("06-04-2024").alias("boedt"), money(F.lit(50)).alias("txval"), money(F.lit(9)).alias("igst"))).alias("impg"),
        ).alias("docdata"),
        F.struct(F.create_map(F.lit("nonrevsup"), F.struct(money(F.size("items") * 9 + F.when(F.col("l_orderkey") % 2 == 0, 9).otherwise(0)).alias("igst"))).alias("itcavl")).alias("itcsumm"),
    )
    return x.select(text_of("l_orderkey").alias("path"), F.from_json(F.to_json(F.struct(data.alias("data"))), returns.GSTR_2B).alias("p"))


@query("""SELECT l_orderkey::VARCHAR AS path, 'B2B' AS section, '27B' AS ctin, 'I' || l_orderkey AS doc_number, DATE '2024-04-05' AS doc_date, l_linenumber::INT AS line_number, l_extendedprice::DECIMAL(18,2) AS taxable_value, '29' AS place_of_supply FROM lineitem
  UNION ALL SELECT DISTINCT l_orderkey::VARCHAR, 'IMPG', NULL, 'BE', DATE '2024-04-06', 1, 50::DECIMAL(18,2), NULL FROM lineitem""")
def gstr_2b_lines(spark, sf):
    """S-05: the document sections as one union."""
    return returns.gstr_2b(_payload_2b(spark, sf), F.lit(_APRIL).cast("date"))[1].select("path", "section", "ctin", "doc_number", "doc_date", "line_number", "taxable_value", "place_of_supply")


@query("SELECT l_orderkey::VARCHAR AS path, (count(*) * 9)::DECIMAL(28,2) AS said_igst, (count(*) * 9 + 9)::DECIMAL(28,2) AS line_igst FROM lineitem WHERE l_orderkey % 2 = 1 GROUP BY 1")
def summary_disagreement(spark, sf):
    """Q-02, S-05's summary: statements whose summary isn't the sum of their lines."""
    _, lines, summary, _ = returns.gstr_2b(_payload_2b(spark, sf), F.lit(_APRIL).cast("date"))
    return documents.summary_disagrees(summary, lines).select("path", "said_igst", "line_igst")


# a tenant's store (S-18 to S-20, U-07 to U-09, V-08, V-12)


def _store(spark: SparkSession) -> TenantStore:
    return TenantStore(spark, scratch(spark, "store"), "acme")


def _upload(kind: str, n: str, day: int, **more) -> load.Upload:
    return load.Upload(**(dict(document_type=kind, entity_id="e", gstin="29A", ingest_id=f"i{n}", batch_id=n, now=dt.datetime(2024, 5, day), period_start=dt.date(2024, 4, 1), period_end=dt.date(2024, 4, 30)) | more))


def _bills(spark, sf, kind: str) -> DataFrame:
    """Suppliers' documents of two types: each number is given by two parties in one file."""
    own = {"SEZ_BILL_OF_ENTRY": ("be_number,be_date", "B"), "EWAY_BILL_OUTWARD_REGISTER": ("ewb_number,ewb_date", "E")}[kind]
    s = t(spark, sf, "supplier").withColumn("party", F.explode(F.array(*[F.lit(f"{n}AAAAA0000A1Z5") for n in (27, 29)])))
    line = F.concat_ws(",", F.concat(F.lit(own[1]), text_of("s_suppkey")), F.lit("2024-04-03,1,8471,1"), text_of("s_suppkey"), text_of("s_suppkey"), F.lit("18"), F.col("party"), F.concat(F.lit("X"), text_of("s_suppkey")), F.lit("2024-04-03"))
    return _files(s, F.lit("f.csv"), F.struct("s_suppkey", "party"), line, f"doc_number,doc_date,line_number,hsn_sac,quantity,unit_price,taxable_value,gst_rate,counterparty_gstin,{own[0]}")


_BILLS = "FROM supplier, (VALUES ('27AAAAA0000A1Z5'), ('29AAAAA0000A1Z5')) p(party)"


@query(f"SELECT batch_id, k || s_suppkey AS doc_number, party AS gstin, s_suppkey::DECIMAL(18,2) AS taxable_value, 'X' || s_suppkey AS own_number, true AS live {_BILLS}, (VALUES ('0012', 'B'), ('0013', 'E')) b(batch_id, k)")
def v1_transaction_line(spark, sf):
    """U-08, V-08, J-01: two types in one store; ids keep their zeros, attributes stay, and a line has one header."""
    store = _store(spark)
    for n, kind in (("0012", "SEZ_BILL_OF_ENTRY"), ("0013", "EWAY_BILL_OUTWARD_REGISTER")):
        load.load(store, _bills(spark, sf, kind), _upload(kind, n, 1))
    heads = views.view(store, "v1_transaction_document").select(F.col("id").alias("header_id"), F.coalesce(F.col("attributes")["be_number"], F.col("attributes")["ewb_number"]).alias("own_number"))
    lines = views.view(store, "v1_transaction_line").join(heads, "header_id")
    return lines.select("batch_id", "doc_number", F.col("counterparty_gstin").alias("gstin"), "taxable_value", "own_number", F.col("superseded_at").isNull().alias("live"))


@query(f"SELECT 'B' || s_suppkey AS doc_number, party AS gstin, true AS live, 1::BIGINT AS batches {_BILLS}")
def replayed_batch(spark, sf):
    """S-19: a batch that is loaded again under its id changes nothing."""
    store = _store(spark)
    for day in (1, 2):
        load.load(store, _bills(spark, sf, "SEZ_BILL_OF_ENTRY"), _upload("SEZ_BILL_OF_ENTRY", "0012", day))
    n = store.manifests().count()
    return store.rows("transaction_document").select("doc_number", "gstin", F.col("superseded_at").isNull().alias("live"), F.lit(n).cast("long").alias("batches"))


@query("""WITH a AS (SELECT o_orderkey AS ref, o_custkey, CASE WHEN o_orderkey % 11 = 0 THEN 'UNSUPPORTED_EXTENSION' END AS refusal FROM orders),
  f AS (SELECT o_custkey, min(ref) FILTER (ref % 2 = 0) AS early, min(ref) AS first FROM a WHERE refusal IS NULL GROUP BY 1)
  SELECT ref, refusal, CASE WHEN refusal IS NULL THEN coalesce(early, first)::VARCHAR END AS held_by, length('file of ' || o_custkey) AS size_bytes,
    CASE WHEN refusal IS NULL THEN early IS NOT NULL OR ref <> first END AS deduplicated, CASE WHEN refusal IS NULL THEN 'OK' END AS verdict FROM a LEFT JOIN f USING (o_custkey)""")
def bronze_intake(spark, sf):
    """S-15, S-16, S-18: half of the files come in, then all of them; bytes are kept once, and each re-read is checked."""
    store = _store(spark)
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("ref"), F.lit("e").alias("entity_id"), F.lit("PURCHASE_REGISTER").alias("document_type"), F.concat(text_of("o_orderkey"), F.when(F.col("o_orderkey") % 11 == 0, ".exe").otherwise(".csv")).alias("filename"), F.lit("2024-05-01").cast("timestamp").alias("received_at"), F.concat(F.lit("file of "), text_of("o_custkey")).cast("binary").alias("content"))
    bronze.receive(store, o.where("ref % 2 = 0"))
    receipts = bronze.receive(store, o)
    checked = bronze.reread(store, bronze.ledger(store)).select("content_hash", "verdict")
    out = receipts.join(checked, "content_hash", "left")
    return out.select("ref", "refusal", "held_by", "size_bytes", "deduplicated", F.when(F.col("refusal").isNull(), F.col("verdict")).alias("verdict"))


def _sales_files(rows: DataFrame) -> DataFrame:
    """Sales files, one for each customer: two lines an invoice; ``more`` is added to the first line's value."""
    names = [c.name for c in SALES_HEADER + SALES_LINE]
    lines = rows.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    value = F.col("o_totalprice").cast(MONEY) + F.when(F.col("k") == 1, F.col("more")).otherwise(0)
    given = {"invoice_no": F.concat(F.lit("S"), text_of("o_orderkey")), "invoice_date": F.lit("2024-04-03"), "invoice_type": F.lit("B2B"), "invoice_igst": F.lit("7.25"), "invoice_cgst": F.lit("1"), "line_number": text_of("k"), "taxable_value": text_of(value.cast(MONEY))}
    line = F.concat_ws(",", *[given.get(n, F.lit("")) for n in names])
    return _files(lines, F.col("o_custkey"), F.struct("o_orderkey", "k"), line, ",".join(names))


@query("""WITH o AS (SELECT o_orderkey, o_totalprice::DECIMAL(18,2) AS v FROM orders)
  SELECT 'S' || o_orderkey AS invoice_no, o_orderkey % 5 <> 0 AS live, 8.25::DECIMAL(18,2) AS total_tax, 2::BIGINT AS lines, (2 * v)::DECIMAL(28,2) AS taxable_value, DATE '9999-12-31' AS valid_to FROM o
  UNION ALL SELECT 'S' || o_orderkey, true, 8.25, 2, 2 * v + 1, DATE '9999-12-31' FROM o WHERE o_orderkey % 5 = 0""")
def sales_loads(spark, sf):
    """U-07, V-09, J-01: sales are loaded twice; of the invoices that come again those are superseded whose lines differ, and lines stay with their version."""
    store, o = _store(spark), t(spark, sf, "orders").withColumn("more", F.lit(0))
    load.load(store, _sales_files(o), _upload("SALES_REGISTER", "1", 1))
    again = o.where("o_orderkey % 5 < 2").withColumn("more", F.when(F.col("o_orderkey") % 5 == 0, 1).otherwise(0))
    load.load(store, _sales_files(again), _upload("SALES_REGISTER", "2", 2))
    lines = views.view(store, "v1_sales_register_line").groupBy(F.col("header_id").alias("id")).agg(F.count(F.lit(1)).alias("lines"), F.sum("taxable_value").cast("decimal(28,2)").alias("taxable_value"))
    heads = views.view(store, "v1_sales_register").select("id", "invoice_no", F.col("superseded_at").isNull().alias("live"), "total_tax", "valid_to")
    return heads.join(lines, "id").drop("id")


_NEW_ROWS = "b AS (SELECT supplier_gstin, invoice_no, row_hash, valid_from, l_partkey % 2 AS batch, min(line) AS line FROM purchases GROUP BY ALL)"


@query(f"""WITH {PURCHASES}, {_NEW_ROWS}, v AS (SELECT *, lag(row_hash) OVER w AS prev, row_number() OVER (PARTITION BY supplier_gstin, invoice_no ORDER BY batch DESC, line DESC) AS n FROM b WINDOW w AS (PARTITION BY supplier_gstin, invoice_no ORDER BY batch, line))
  SELECT supplier_gstin, invoice_no, arg_min(row_hash, n) AS row_hash, arg_min(valid_from, n) AS valid_from, count(*) FILTER (prev IS NULL OR prev <> row_hash) AS versions, 1::BIGINT AS live FROM v GROUP BY ALL""")
def interleaved_loads(spark, sf):
    """S-19, U-02, U-15: two loads that both start from the empty store; the later one meets the other's keys and is done again, so each key has one live version."""
    root = scratch(spark, "store")
    rows = purchases(spark, sf, dealt=True).withColumn("path", F.lit("f.csv"))
    stores = [TenantStore(spark, root, "acme") for _ in range(2)]
    for k, store in enumerate(stores):
        store.attempt(f"{k}")  # both read the same state
    for k, store in enumerate(stores):
        part = registers.collapsed(rows.where(F.col("l_partkey") % 2 == k).select("path", "line", "row_hash", "supplier_gstin", "invoice_no", "invoice_date", "taxable_value"), hashed=["supplier_gstin", "invoice_no"])
        load.load_rows(store, part, _upload("PURCHASE_REGISTER", f"{k}", k + 1))
    versions = stores[0].rows("purchase_register")
    alive = F.col("superseded_at").isNull()
    last = lambda c: F.max(F.when(alive, c))
    out = versions.groupBy("supplier_gstin", "invoice_no").agg(last(F.unhex("row_hash")).alias("_hash"), last(F.col("valid_from")).alias("valid_from"), F.count(F.lit(1)).alias("versions"), F.count_if(alive).alias("live"))
    return out.select("supplier_gstin", "invoice_no", F.lower(F.hex("_hash")).alias("row_hash"), "valid_from", "versions", "live")  # a hash moves as bytes, half its text


_POINTS = [(known, valid) for known in ("2024-05-10", "2024-05-25") for valid in ("1995-06-01", "1997-06-01")]


@query(f"""WITH c AS (SELECT o_custkey, min((o_orderdate::DATE, o_orderkey, o_totalprice::DECIMAL(18,2))) AS a, max((o_orderdate::DATE, o_orderkey, o_totalprice::DECIMAL(18,2))) AS z FROM orders GROUP BY 1),
  r AS (SELECT o_custkey, a[1] AS d1, a[3] AS v1, z[1] AS d2, z[3] AS v2, o_custkey % 3 <> 0 AND a[2] <> z[2] AND (a[1] <> z[1] OR a[3] <> z[3]) AS moved FROM c),
  p AS (SELECT * FROM (VALUES {", ".join(f"(DATE '{k}', DATE '{v}')" for k, v in _POINTS)}) t(known, valid)),
  x AS (SELECT o_custkey, d1 AS f, CASE WHEN moved AND known >= DATE '2024-05-20' THEN CASE WHEN d2 > d1 THEN d2 END ELSE DATE '9999-12-31' END AS u, v1 AS v, known, valid FROM r, p
    UNION ALL SELECT o_custkey, d2, DATE '9999-12-31', v2, known, valid FROM r, p WHERE moved AND known >= DATE '2024-05-20')
  SELECT known, valid, 'C' || o_custkey AS invoice_no, f AS valid_from, u AS valid_to, v AS taxable_value FROM x WHERE u IS NOT NULL AND f <= valid AND valid < u""")
def bitemporal_points(spark, sf):
    """U-04, W-06: what a store knew at two times of what held on two days; ends that came later aren't known earlier."""
    store = _store(spark)
    row = F.struct(F.to_date("o_orderdate").alias("d"), "o_orderkey", F.col("o_totalprice").cast(MONEY).alias("v"))
    held = t(spark, sf, "orders").groupBy("o_custkey").agg(F.min(row).alias("a"), F.max(row).alias("z"))
    for n, day, c in (("1", 1, "a"), ("2", 20, "z")):
        own = held.where("o_custkey % 3 <> 0") if c == "z" else held
        rows = own.select(F.lit("f.csv").alias("path"), F.col("o_custkey").alias("line"), F.lit(None).cast("string").alias("supplier_gstin"), F.concat(F.lit("C"), text_of("o_custkey")).alias("invoice_no"), F.col(f"{c}.d").alias("invoice_date"), F.col(f"{c}.v").alias("taxable_value"))
        load.load_rows(store, rows.withColumn("row_hash", hashing.row_hash("invoice_no", "invoice_date", "taxable_value")), _upload("PURCHASE_REGISTER", n, day))
    out = None
    for known, valid in _POINTS:
        at = store.as_of("purchase_register", known, valid, ["entity_id", "gstin", "supplier_gstin", "invoice_no"])
        at = at.select(F.lit(known).cast("date").alias("known"), F.lit(valid).cast("date").alias("valid"), "invoice_no", "valid_from", "valid_to", "taxable_value")
        out = at if out is None else out.unionByName(at)
    return out


# readers over prepared rows (V-02, V-14, V-16, J-01, J-03, U-11, A-08)


@query(f"""WITH {PURCHASES} SELECT line AS purchase_record_id, invoice_no, NULL AS supplier_name, taxable_value, gst_rate FROM purchases""")
def purchase_candidates(spark, sf):
    """V-16."""
    rows = purchases(spark, sf).withColumns({"id": F.col("line"), **{c: F.lit(None).cast("string") for c in ("tax_period", "hsn_sac", "gl_code", "cost_centre", "rcm_flag", "recorded_at", "superseded_at", "batch_id", "bronze_ingest_id", "valid_to")}})
    return readers.purchase_candidates(rows).select("purchase_record_id", "invoice_no", "supplier_name", "taxable_value", "gst_rate")


@query("SELECT s_suppkey AS record_id, s_name AS person_name, 'Employee' AS employment_or_payment_classification, s_acctbal::DECIMAL(18,2) AS gross_amount FROM supplier")
def payroll_evidence(spark, sf):
    """V-14."""
    none = {c: F.lit(None).cast("string") for c in ("entity_id", "gstin", "role_title", "tds_section", "tds_deducted", "valid_from", "valid_to", "recorded_at", "superseded_at", "batch_id", "bronze_ingest_id", "row_hash")}
    rows = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("person_name"), F.lit("Employee").alias("classification"), F.col("s_acctbal").cast(MONEY).alias("gross_amount"))
    return readers.payroll_evidence(rows.withColumns(none)).select("record_id", "person_name", "employment_or_payment_classification", "gross_amount")


@query("SELECT o_orderkey AS doc_number, l_linenumber, o_orderdate::DATE AS day FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 3 = 0 AND o_orderstatus <> 'F'")
def current_documents_with_lines(spark, sf):
    """V-02, W-03, J-01: the live documents of a batch and their lines."""
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_number"), (F.col("o_orderkey") % 3).cast("string").alias("batch_id"), F.to_date("o_orderdate").alias("day"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("superseded_at"))
    lines = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_number"), "l_linenumber")
    return readers.with_lines(readers.current_documents(o, "0"), lines, "doc_number", "day")


@query("SELECT l_orderkey AS record_id, l_linenumber, o_orderdate::DATE AS superseded_on FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F'")
def closed_children(spark, sf):
    """U-11: facts of closed records are closed with them."""
    kids = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("record_id"), "l_linenumber", F.lit(None).cast("date").alias("superseded_at"))
    closed = t(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("record_id"), F.to_date("o_orderdate").alias("superseded_at"))
    return upsert.children_of_closed(kids, closed).withColumnRenamed("superseded_at", "superseded_on")


@query("SELECT o_custkey, a AS n_before, b AS n_after FROM (SELECT o_custkey, count(*)::BIGINT AS a, nullif(count(*) FILTER (o_orderkey % 5 <> 0), 0)::BIGINT AS b FROM orders GROUP BY 1) WHERE a IS DISTINCT FROM b")
def count_audit(spark, sf):
    """A-08."""
    o = t(spark, sf, "orders")
    return views.counts_agree(o, o.where("o_orderkey % 5 <> 0"), "o_custkey")


# text documents (X-05 to X-10)


def _labelled(spark, sf, *pairs: tuple[str, Column]) -> DataFrame:
    page = F.concat_ws("\n", F.lit("A document with a text layer"), *[F.concat(F.lit(f"{label}: "), value) for label, value in pairs])
    return t(spark, sf, "orders").select(text_of("o_orderkey").alias("doc_id"), text_of("o_custkey").alias("entity_id"), "o_orderkey", F.array(page).alias("pages"))


def _written(name: str) -> Column:
    return F.date_format(F.to_date(name), "dd MMMM yyyy")


@query("SELECT o_orderkey::VARCHAR AS doc_id, 'LUT' AS instrument_type, 'GSTN' AS issuing_authority, 'N' || o_custkey AS instrument_number, o_orderdate::DATE AS valid_from, o_orderdate::DATE + 100 AS valid_to, 'ACTIVE' AS status FROM orders")
def entitlement_records(spark, sf):
    end = F.date_format(F.date_add(F.to_date("o_orderdate"), 100), "dd MMMM yyyy")
    docs = _labelled(spark, sf, ("LUT ARN", F.concat(F.lit("N"), text_of("o_custkey"))), ("Validity", F.concat(_written("o_orderdate"), F.lit(" to "), end)))
    return archetypes.entitlements(archetypes.extracted(docs, "LUT"), "LUT").drop("entity_id")


@query("SELECT o_orderkey::VARCHAR AS doc_id, 'RBI' AS authority, 'R' || o_orderkey AS reference_number, o_orderdate::DATE AS event_date, o_totalprice::DECIMAL(14,2) AS amount, 'RBI_COMPOUNDING_ORDER:' || o_orderkey AS batch_id FROM orders")
def proceeding_records(spark, sf):
    """X-08, X-10: records, each with the batch of one that its document makes."""
    docs = _labelled(spark, sf, ("Compounding Application No.", F.concat(F.lit("R"), text_of("o_orderkey"))), ("Date of Compounding Order", _written("o_orderdate")), ("Compounding Amount Paid", F.format_number(F.col("o_totalprice").cast(MONEY), 2)))
    rows = archetypes.proceedings(archetypes.extracted(docs, "RBI_COMPOUNDING_ORDER"), "RBI_COMPOUNDING_ORDER")
    batches = archetypes.single_document_batches(rows, "RBI_COMPOUNDING_ORDER", "event_date").select("batch_id", F.element_at(F.split("batch_id", ":"), 2).alias("doc_id"))
    return rows.select("doc_id", "authority", "reference_number", "event_date", "amount").join(batches, "doc_id")


@query("SELECT o_orderkey::VARCHAR AS doc_id, 'CIN' || o_custkey AS reference_number, o_orderdate::DATE AS as_of_date FROM orders WHERE o_orderkey % 4 <> 0")
def master_records(spark, sf):
    day = F.when(F.col("o_orderkey") % 4 == 0, "soon").otherwise(_written("o_orderdate"))
    docs = _labelled(spark, sf, ("Corporate Identification Number (CIN)", F.concat(F.lit("CIN"), text_of("o_custkey"))), ("Date of Incorporation", day))
    return archetypes.masters(archetypes.extracted(docs, "CERTIFICATE_OF_INCORPORATION"), "CERTIFICATE_OF_INCORPORATION").select("doc_id", "reference_number", "as_of_date")


@query("SELECT o_orderkey::VARCHAR AS path, 'L' || o_orderkey AS doc_number, (o_orderkey % 1000 + 1)::DECIMAL(18,2)::VARCHAR AS taxable_value, '5.00' AS gst_rate, '996791' AS hsn_sac FROM orders")
def consignment_rows(spark, sf):
    """X-06: the rate is computed from the amounts."""
    base = F.col("o_orderkey") % 1000 + 1
    docs = _labelled(spark, sf, ("Consignment Note (LR) No.", F.concat(F.lit("L"), text_of("o_orderkey"))), ("Consignment Note Date", _written("o_orderdate")), ("GTA GSTIN", F.lit("24AAAAA0000A1Z5")), ("GTA Name", F.lit("Fast")), ("Freight Charges", F.format_number(base.cast(MONEY), 2)), ("GST Payable under RCM", F.format_number((base * 0.05).cast(MONEY), 2)))
    rows = archetypes.transaction_row(archetypes.extracted(docs, "GTA_INVOICE_CONSIGNMENT_NOTE"), "GTA_INVOICE_CONSIGNMENT_NOTE")
    cell = lambda n: F.col("cells")[n].alias(n)
    return rows.select("path", cell("doc_number"), cell("taxable_value"), cell("gst_rate"), cell("hsn_sac"))


@query("""SELECT s_suppkey::VARCHAR AS path, i::INT AS line, printf('EMP%04d', i) AS ref_no, 'Some Name' AS person_name, 'Employee' AS classification, '192' AS tds_section, (s_suppkey * 1000)::VARCHAR AS gross_amount FROM supplier, range(1, 4) r(i) WHERE i < 3""")
def payroll_text_rows(spark, sf):
    """X-05, X-08: a row without a section is none."""
    row = lambda i, section: F.concat(F.lit(f"EMP{i:04d} Some Name Employee {section} "), F.format_number(F.col("s_suppkey") * 1000, 0), F.lit(" 100"))
    page = F.concat_ws("\n", F.lit("Register of pay for the month"), row(1, "192"), row(2, "192"), row(3, "none"), F.lit("Note: EMP0009 is the end"))
    docs = t(spark, sf, "supplier").select(text_of("s_suppkey").alias("doc_id"), F.array(page).alias("pages"))
    cells, _ = archetypes.register_rows(docs, "PAYROLL_TDS_REGISTER")
    cell = lambda n: F.col("cells")[n].alias(n)
    return cells.select("path", (F.col("line") - 1).cast("int").alias("line"), *[cell(n) for n in ("ref_no", "person_name", "classification", "tds_section", "gross_amount")])


@query("SELECT s_suppkey, 'INV/EXP/24-25/' || printf('%04d', s_suppkey % 10000) AS export_invoice_no, '2024-04-03' AS invoice_date, 'USD 5,000' AS amount_foreign, 'HDFC Bank, Fort Branch' AS ad_bank, 'FIRC/2024/MH/17' AS firc_no, 'Realised' AS realisation_status FROM supplier")
def realisation_text_rows(spark, sf):
    page = F.concat(F.lit("Register of remittances\nINV/EXP/24- 25/"), F.format_string("%04d", F.col("s_suppkey") % 10000), F.lit(f" 03-Apr-2024 USD 5,000 {AD_BANKS[0]} FIRC/2024/MH/ 17 Realised\nBoth bank-issued papers are kept"))
    docs = t(spark, sf, "supplier").select("s_suppkey", F.array(page).alias("pages"))
    return text.realisation_rows(docs, list(AD_BANKS)).drop("pages")


@query("""SELECT s_suppkey::VARCHAR AS doc_id, 'Holder A' AS holder_name, s_suppkey::DECIMAL(18,0) AS shares, p::DECIMAL(5,2) AS pct_holding, f::DATE AS valid_from, u::DATE AS valid_to FROM supplier, (VALUES (60.5, '2024-04-01', '2025-03-31'), (40, '2023-04-01', '2024-03-31')) v(p, f, u)""")
def shareholding_facts(spark, sf):
    """X-07: two facts a row, one for each fiscal year."""
    s = t(spark, sf, "supplier")
    facts = F.create_map(F.lit("as_of_date"), F.lit("2024-06-30"))
    row = F.create_map(F.lit("holder_name"), F.lit("Holder A "), F.lit("shares"), text_of("s_suppkey"), F.lit("pct_current_fy"), F.lit("60.5"), F.lit("pct_prior_fy"), F.lit("40"), F.lit("pledged"), F.lit("Yes"))
    docs = s.select(text_of("s_suppkey").alias("doc_id"), F.lit("e").alias("entity_id"), F.lit("EXTRACTED").alias("outcome"), facts.alias("facts"), F.array(row).alias("rows"))
    return archetypes.shareholdings(docs).select("doc_id", "holder_name", "shares", "pct_holding", "valid_from", "valid_to")


# reconciliation (R-01, R-04, R-05, R-07, R-12 to R-14, R-17 to R-19)


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_tax::DECIMAL(18,2) <> 0 AND EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')")
def recon_amended_credit(spark, sf):
    key = [F.lit("r").alias("recipient_gstin"), F.lit("s").alias("supplier_gstin")]
    amended = t(spark, sf, "lineitem").select(*key, F.col("l_orderkey").alias("original_invoice_no"), F.col("l_tax").alias("itc_delta"), "l_orderkey", "l_linenumber", "l_partkey")
    claims = t(spark, sf, "orders").where("o_orderstatus = 'F'").select(*key, F.col("o_orderkey").alias("original_invoice_no"))
    return recon.amended_after_credit(amended, claims).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT o_orderkey AS shipping_bill_no FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def recon_unfiled_manifest(spark, sf):
    filed = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("shipping_bill_no"), F.when(F.col("l_returnflag") == "R", "Filed").otherwise("Open").alias("egm_status"))
    return recon.unfiled_manifest(t(spark, sf, "orders").select(F.col("o_orderkey").alias("shipping_bill_no")), filed).select("shipping_bill_no")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE abs(l_extendedprice::DECIMAL(18,2) - (l_extendedprice * (1 - l_discount * 0.3))::DECIMAL(18,2)) > l_extendedprice::DECIMAL(18,2)::DOUBLE * 0.01")
def recon_value_variance(spark, sf):
    bills = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("fob_value_inr"), (F.col("l_extendedprice") * (1 - F.col("l_discount") * 0.3)).alias("gstr1_table6a_value"))
    return recon.value_variance(bills).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0")
def recon_export_without_bill(spark, sf):
    return recon.export_without_bill(t(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "  ").otherwise("B").alias("shipping_bill_no"))).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE < DATE '1995-01-01' + (o_custkey % 500)::INT")
def recon_early_credit(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("gstin"), F.to_date("o_orderdate").alias("credit_date"))
    since = F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), (F.col("gstin") % 500).cast("int")), "dd/MM/yyyy")
    return recon.credit_before_registration(o, o.select("gstin").distinct().withColumn("effective_date_of_registration", since)).select("o_orderkey")


@query("""SELECT gstin, collected_base::DECIMAL(28,2) AS collected_base, declared::DECIMAL(28,2) AS declared FROM (SELECT o_custkey AS gstin, sum(o_totalprice::DECIMAL(18,2)) AS collected_base FROM orders WHERE o_custkey % 3 > 0 GROUP BY 1) FULL JOIN (SELECT o_custkey AS gstin, sum(o_totalprice::DECIMAL(18,2)) AS declared FROM orders WHERE o_custkey % 3 < 2 GROUP BY 1) USING (gstin)
  WHERE abs(coalesce(collected_base, 0) - coalesce(declared, 0)) > 1""")
def recon_collected_base(spark, sf):
    o = t(spark, sf, "orders").select(F.col("o_custkey").alias("gstin"), F.lit("m").alias("operator"), F.lit("2024-04").alias("tax_period"), F.col("o_totalprice").alias("net_value"), F.col("o_totalprice").alias("taxable_value"))
    return recon.collected_base_differs(o.where("gstin % 3 > 0"), o.where("gstin % 3 < 2")).select("gstin", "collected_base", "declared")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_custkey % 100 > 60")
def recon_slow_refunds(spark, sf):
    return recon.slow_refunds(t(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "Paid").otherwise("Pending").alias("status"), text_of(F.col("o_custkey") % 100).alias("days_pending"))).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_totalprice::DECIMAL(18,2) > 0 AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 3)")
def recon_import_tax(spark, sf):
    entries = t(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("be_no"), F.col("o_totalprice").alias("igst_paid"))
    stated = t(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") == 3, "IMPG").otherwise("B2B").alias("section"), F.col("l_orderkey").alias("doc_number"))
    return recon.import_tax_missing(entries, stated).select("o_orderkey")


@query("SELECT s_suppkey AS iec, 2 AS branch_sl_no FROM supplier UNION ALL SELECT s_suppkey, 1 FROM supplier WHERE s_suppkey % 2 = 0")
def recon_branch_without_gstin(spark, sf):
    branch = lambda n, g: F.struct(F.lit(n).alias("branch_sl_no"), g.alias("gstin"))
    codes = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("iec"), F.array(branch(1, F.when(F.col("s_suppkey") % 2 == 1, "G").otherwise(" ")), branch(2, F.lit(None).cast("string"))).alias("branches"))
    return recon.branch_without_gstin(codes).select("iec", "branch_sl_no")


@query("SELECT o_orderkey, (o_totalprice::DECIMAL(18,2) - 50000)::DECIMAL(18,2) AS shortfall FROM orders WHERE o_orderdate::DATE < DATE '1996-01-01' AND o_totalprice::DECIMAL(18,2) > 50000")
def recon_expired_obligation(spark, sf):
    rows = t(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("export_obligation_inr"), F.lit(50000).alias("eo_fulfilled_inr"), F.date_format("o_orderdate", "dd-MM-yyyy").alias("eo_due_date"))
    return recon.expired_obligation(rows, F.lit("1996-01-01").cast("date")).select("o_orderkey", "shortfall")


@query("""SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS invoice_id, o_orderkey AS return_id, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey END AS bill_id,
    CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 4 <> 0 THEN 'COMPLETE' WHEN o_orderkey % 5 <> 0 THEN 'NO_BILL' WHEN o_orderkey % 4 <> 0 THEN 'NO_INVOICE' ELSE 'RETURN_ONLY' END AS status FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL SELECT o_orderkey, NULL, NULL, 'INVOICE_ONLY' FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 5 = 0
  UNION ALL SELECT NULL, NULL, o_orderkey, 'BILL_ONLY' FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 4 <> 0""")
def three_way_match(spark, sf):
    """J-13: invoice, table 6A and shipping bill, by party and normalised number, within a rupee and a week; every row of each side comes out once."""
    o, key = t(spark, sf, "orders"), F.col("o_orderkey")
    value, day = F.col("o_totalprice").cast(MONEY), F.to_date("o_orderdate")
    stated = value + F.when(key % 3 == 0, F.lit(0.5).cast(MONEY)).otherwise(0) + F.when(key % 5 == 0, 5).otherwise(0)
    side = lambda number, amount, on: o.select(key.alias("id"), F.col("o_custkey").alias("party"), matching.normal_number(number).alias("number"), amount.alias("amount"), on.alias("day"))
    invoices = side(F.format_string("INV-%09d", key), value, day)
    returns = side(F.format_string("inv %d", key), stated, F.date_add(day, 3)).where("id % 7 <> 0")
    bills = side(F.format_string("INV/%012d", key), stated, F.date_add(day, 5)).where("id % 4 <> 0")
    return matching.three_way(invoices, returns, bills, ["party", "number"])


# the catalogue (C-03, C-05, J-08, J-12, A-09)


@query("""WITH v AS (UNPIVOT (SELECT l_linenumber::VARCHAR AS line_number, CASE WHEN l_partkey % 11 <> 0 THEN l_partkey::VARCHAR || '00' END AS hsn_sac, (l_tax * 100 + CASE WHEN l_suppkey % 13 = 0 THEN 95 ELSE 0 END)::DECIMAL(6,3)::VARCHAR AS gst_rate,
    CASE l_returnflag WHEN 'R' THEN 'inr' ELSE 'INR' END AS currency, CASE l_linestatus WHEN 'O' THEN 'B2B' ELSE 'B2X' END AS invoice_type FROM lineitem) ON COLUMNS(*) INTO NAME field VALUE value)
  SELECT field, CASE field WHEN 'line_number' THEN 'int' WHEN 'gst_rate' THEN 'rate' ELSE 'text' END AS type, field IN ('line_number', 'invoice_type') AS required, count(*) AS cells,
    count(*) FILTER (CASE field WHEN 'line_number' THEN value::INT < 1 WHEN 'hsn_sac' THEN length(value) NOT BETWEEN 4 AND 8 WHEN 'gst_rate' THEN value::DECIMAL(6,3) > 100 WHEN 'currency' THEN value = 'inr' ELSE value = 'B2X' END) AS refused
  FROM v GROUP BY ALL""")
def catalogue_fields(spark, sf):
    """C-03, C-05: what a client that knows the published fields alone would refuse of all lines' cells."""
    cells = t(spark, sf, "lineitem").select(
        text_of("l_linenumber").alias("line_number"),
        F.when(F.col("l_partkey") % 11 != 0, F.concat(text_of("l_partkey"), F.lit("00"))).alias("hsn_sac"),
        F.expr("cast(cast(l_tax * 100 + if(l_suppkey % 13 = 0, 95, 0) as decimal(6,3)) as string)").alias("gst_rate"),
        F.when(F.col("l_returnflag") == "R", "inr").otherwise("INR").alias("currency"),
        F.when(F.col("l_linestatus") == "O", "B2B").otherwise("B2X").alias("invoice_type"),
    )
    values = cells.select(F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("value")) for n in cells.columns])).alias("x")).select("x.*").where("value is not null")
    fields = catalogue.fields(spark).where("document_type = 'SALES_REGISTER'")
    return catalogue.refused(values, fields).groupBy("field", "type", "required").agg(F.count(F.lit(1)).alias("cells"), F.count_if("refused").alias("refused"))


# rules of the tables (C-04, C-05, P-28)

_CHECKED = """x AS (SELECT l_orderkey * 10 + l_linenumber AS line, CASE WHEN l_linenumber = 7 THEN 0 ELSE l_linenumber END AS line_number,
    CASE WHEN l_partkey % 11 <> 0 THEN l_partkey::VARCHAR || '00' END AS hsn_sac, (l_tax * 100 + CASE WHEN l_suppkey % 13 = 0 THEN 95 ELSE 0 END)::DECIMAL(6,3) AS gst_rate,
    CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE 0 END::DECIMAL(18,2) AS igst, CASE WHEN l_partkey % 5 = 0 THEN 2 ELSE 0 END::DECIMAL(18,2) AS cgst, CASE WHEN l_partkey % 7 <> 0 THEN 0 END::DECIMAL(18,2) AS sgst,
    CASE WHEN l_returnflag = 'R' THEN 'inr' ELSE 'INR' END AS currency, CASE WHEN l_returnflag = 'A' THEN '7' WHEN l_returnflag = 'N' THEN '27' END AS place_of_supply,
    CASE l_linestatus WHEN 'O' THEN 'B2B' ELSE 'B2X' END AS invoice_type, CASE WHEN l_suppkey % 10 = 0 THEN '29AAAAA0000A1Z' || (l_suppkey % 4) WHEN l_suppkey % 10 = 1 THEN '29' || l_suppkey END AS customer_gstin FROM lineitem)"""


@query(f"""WITH {_CHECKED}
  SELECT line, 'sales_register_line_line_number_check' AS constraint_name, 'line_number' AS column_name, line_number::VARCHAR AS value FROM x WHERE line_number <= 0
  UNION ALL SELECT line, 'sales_register_line_hsn_sac_check', 'hsn_sac', hsn_sac FROM x WHERE length(hsn_sac) NOT BETWEEN 4 AND 8
  UNION ALL SELECT line, 'sales_register_line_gst_rate_tax_rate', 'gst_rate', gst_rate::VARCHAR FROM x WHERE gst_rate > 100
  UNION ALL SELECT line, 'sales_register_line_igst_rule', 'igst, cgst, sgst', 'igst=' || igst || ', cgst=' || cgst || ', sgst=' || coalesce(sgst::VARCHAR, 'null') FROM x WHERE igst > 0 AND cgst > 0
  UNION ALL SELECT line, 'sales_register_currency_check', 'currency', currency FROM x WHERE currency = 'inr'
  UNION ALL SELECT line, 'sales_register_place_of_supply_check', 'place_of_supply', place_of_supply FROM x WHERE place_of_supply = '7'
  UNION ALL SELECT line, 'sales_register_invoice_type_vocabulary', 'invoice_type', invoice_type FROM x WHERE invoice_type = 'B2X'
  UNION ALL SELECT line, 'sales_register_customer_gstin_gstin', 'customer_gstin', customer_gstin FROM x WHERE customer_gstin NOT LIKE '29AAAAA%'""")
def broken_checks(spark, sf):
    """P-28, C-05: every rule of the sales register's two tables, over all lines; nulls keep a rule, unless what is known breaks it."""
    when = lambda c, v: F.when(F.expr(c), v)
    rows = t(spark, sf, "lineitem").select(
        F.expr("l_orderkey * 10 + l_linenumber").alias("line"),
        when("l_linenumber = 7", 0).otherwise(F.col("l_linenumber")).alias("line_number"),
        when("l_partkey % 11 <> 0", F.concat(text_of("l_partkey"), F.lit("00"))).alias("hsn_sac"),
        F.expr("cast(l_tax * 100 + if(l_suppkey % 13 = 0, 95, 0) as decimal(6,3))").alias("gst_rate"),
        F.expr("cast(if(l_suppkey % 3 = 0, 1, 0) as decimal(18,2))").alias("igst"),
        F.expr("cast(if(l_partkey % 5 = 0, 2, 0) as decimal(18,2))").alias("cgst"),
        F.expr("cast(if(l_partkey % 7 <> 0, 0, null) as decimal(18,2))").alias("sgst"),
        when("l_returnflag = 'R'", "inr").otherwise("INR").alias("currency"),
        when("l_returnflag = 'A'", "7").when(F.expr("l_returnflag = 'N'"), "27").alias("place_of_supply"),
        when("l_linestatus = 'O'", "B2B").otherwise("B2X").alias("invoice_type"),
        when("l_suppkey % 10 = 0", F.concat(F.lit("29AAAAA0000A1Z"), text_of(F.expr("l_suppkey % 4")))).when(F.expr("l_suppkey % 10 = 1"), F.concat(F.lit("29"), text_of("l_suppkey"))).alias("customer_gstin"),
    )
    return documents.broken_checks(rows, "sales_register", "sales_register_line")
