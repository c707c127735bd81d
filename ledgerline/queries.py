"""Every operator as a query over the driver's tables, with SQL that gives the same rows.

The tables stand in for tax data: lineitem for register rows (its key repeats,
so rows supersede each other), orders for documents, suppliers for parties,
events for batches and uploads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import coerce, fiscal, hashing, text
from ledgerline.operators import documents, readers, recon, settings, upsert
from ledgerline.plans.registers import Column
from ledgerline.sources import intake, registers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


MONEY = "decimal(18,2)"


def purchases(spark: SparkSession, sf: str, dealt: bool = False) -> DataFrame:
    """lineitem as purchase register rows; ``line`` orders the versions of a key. dealt: by number of invoice, while the other columns are numbers still."""
    number = F.concat(F.lit("PI/"), F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string"))
    x = t(spark, sf, "lineitem").withColumn("invoice_no", number)
    if dealt:
        x = x.repartition("invoice_no")
    day = F.to_date("l_shipdate")
    value = F.col("l_extendedprice").cast(MONEY)
    rate = (F.col("l_tax") * 100).cast("decimal(6,3)")
    tax = F.round(value * rate / 100, 2).cast(MONEY)
    inter = F.col("l_suppkey") % 3 == 0
    half = F.round(tax / 2, 2).cast(MONEY)
    zero = F.lit(0).cast(MONEY)
    return x.select(
        F.lit("E1").alias("entity_id"),
        F.concat(F.lit("29AAAAA0000A1Z"), (F.col("l_suppkey") % 4).cast("string")).alias("gstin"),
        F.when(F.col("l_suppkey") % 10 != 0, F.format_string("27BBBBB%04dB1Z5", F.col("l_suppkey") % 10000)).alias("supplier_gstin"),
        "invoice_no",
        day.alias("invoice_date"),
        day.alias("valid_from"),
        value.alias("taxable_value"),
        rate.alias("gst_rate"),
        F.when(inter, tax).otherwise(zero).alias("igst"),
        F.when(inter, zero).otherwise(half).alias("cgst"),
        F.when(inter, zero).otherwise(half).alias("sgst"),
        F.when(F.col("l_partkey") % 5 != 0, zero).alias("cess"),
        F.concat_ws("|", day.cast("string"), F.format_string("%09d", "l_partkey"), F.format_string("%09d", "l_suppkey"), F.format_string("%06d", F.col("l_quantity").cast("int")), F.format_string("%012d", (value * 100).cast("long"))).alias("line"),
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    ).withColumn("row_hash", hashing.row_hash("supplier_gstin", "invoice_no", "invoice_date", "taxable_value"))


PURCHASES = """
p0 AS (SELECT *, CAST(l_shipdate AS DATE) AS d, CAST(l_extendedprice AS DECIMAL(18,2)) AS v, CAST(l_tax * 100 AS DECIMAL(6,3)) AS r FROM lineitem),
p1 AS (SELECT *, CAST(v * r * 0.01 AS DECIMAL(18,2)) AS tax FROM p0),
p2 AS (SELECT 'E1' AS entity_id, '29AAAAA0000A1Z' || (l_suppkey % 4) AS gstin,
  CASE WHEN l_suppkey % 10 <> 0 THEN format('27BBBBB{:04d}B1Z5', l_suppkey % 10000) END AS supplier_gstin,
  'PI/' || l_orderkey || '/' || l_linenumber AS invoice_no, d AS invoice_date, d AS valid_from, v AS taxable_value, r AS gst_rate,
  CASE WHEN l_suppkey % 3 = 0 THEN tax ELSE 0 END::DECIMAL(18,2) AS igst,
  CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE (tax * 0.5)::DECIMAL(18,2) END::DECIMAL(18,2) AS cgst,
  CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE (tax * 0.5)::DECIMAL(18,2) END::DECIMAL(18,2) AS sgst,
  CASE WHEN l_partkey % 5 <> 0 THEN 0 END::DECIMAL(18,2) AS cess,
  concat_ws('|', d::VARCHAR, format('{:09d}', l_partkey), format('{:09d}', l_suppkey), format('{:06d}', l_quantity::INT), format('{:012d}', (v * 100)::BIGINT)) AS line,
  l_orderkey, l_partkey, l_suppkey, l_linenumber FROM p1),
purchases AS (SELECT *, sha256(concat_ws(chr(31), coalesce(supplier_gstin, ''), invoice_no, invoice_date::VARCHAR, taxable_value::VARCHAR)) AS row_hash FROM p2)"""

KEY = ["entity_id", "gstin", "supplier_gstin", "invoice_no"]
CUT = "1997-01-01"


def _split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A live set (the last early version of each key) and a file of the later rows. A key's rows, and so those of a hash, have one number: they move once."""
    rows = purchases(spark, sf, dealt=True).select(*KEY, "line", "row_hash", "valid_from")
    early = upsert.live_versions(rows.where(F.col("valid_from") < CUT), KEY, [F.desc("line"), F.desc("row_hash")])
    live = early.select(*KEY, "row_hash", "valid_from", F.lit(upsert.OPEN_END).cast("date").alias("valid_to"), hashing.surrogate("live", "row_hash").alias("id"))
    return live, registers.collapsed(rows.where(F.col("valid_from") >= CUT), "entity_id", ["supplier_gstin", "invoice_no"])


_SPLIT = f"""
live AS (SELECT entity_id, gstin, supplier_gstin, invoice_no, row_hash, valid_from, DATE '9999-12-31' AS valid_to FROM purchases WHERE valid_from < DATE '{CUT}'
  QUALIFY row_number() OVER (PARTITION BY entity_id, gstin, supplier_gstin, invoice_no ORDER BY line DESC, row_hash DESC) = 1),
inc AS (SELECT entity_id, gstin, supplier_gstin, invoice_no, row_hash, valid_from, line, count(*) OVER (PARTITION BY row_hash) AS copies FROM purchases WHERE valid_from >= DATE '{CUT}'
  QUALIFY row_number() OVER (PARTITION BY row_hash ORDER BY line) = 1),
u AS (SELECT *, 1 AS new, DATE '9999-12-31' AS valid_to FROM inc UNION ALL BY NAME
  SELECT l.*, NULL AS line, 0 AS new FROM live l WHERE EXISTS (SELECT 1 FROM inc i WHERE i.entity_id = l.entity_id AND i.gstin = l.gstin AND i.supplier_gstin IS NOT DISTINCT FROM l.supplier_gstin AND i.invoice_no = l.invoice_no)),
v AS (SELECT *, lag(row_hash) OVER w AS prev, lag(1) OVER w AS has_prev FROM u WINDOW w AS (PARTITION BY entity_id, gstin, supplier_gstin, invoice_no ORDER BY new, line NULLS FIRST)),
x AS (SELECT *, new = 1 AND has_prev = 1 AND prev = row_hash AS same FROM v),
y AS (SELECT * REPLACE (coalesce(same, false) AS same) FROM x),
z AS (SELECT *, (SELECT NULL) AS nothing,
  lead(CASE WHEN NOT same THEN valid_from END IGNORE NULLS) OVER w AS next_from FROM y WINDOW w AS (PARTITION BY entity_id, gstin, supplier_gstin, invoice_no ORDER BY new, line NULLS FIRST)),
done AS (SELECT entity_id, gstin, supplier_gstin, invoice_no, row_hash, valid_from, copies,
  CASE WHEN next_from > valid_from THEN next_from ELSE valid_to END AS valid_to,
  CASE WHEN new = 0 THEN CASE WHEN next_from IS NOT NULL THEN 'closed' ELSE 'kept' END WHEN same THEN 'unchanged' WHEN has_prev = 1 THEN 'superseded' ELSE 'inserted' END AS action,
  next_from IS NULL AND NOT same AS is_live FROM z)"""


@query(f"WITH {PURCHASES},{_SPLIT} SELECT gstin, supplier_gstin, invoice_no, row_hash, valid_from, valid_to FROM done WHERE is_live")
def natural_upsert_live(spark, sf):
    live, new = _split(spark, sf)
    return upsert.natural(new, live, KEY, small=False).where("is_live").select(*KEY[1:], "row_hash", "valid_from", "valid_to")


@query(f"WITH {PURCHASES},{_SPLIT} SELECT gstin, supplier_gstin, invoice_no, row_hash, action, valid_from, valid_to FROM done")
def natural_upsert_history(spark, sf):
    live, new = _split(spark, sf)
    return upsert.natural(new, live, KEY, small=False).select(*KEY[1:], "row_hash", "action", "valid_from", "valid_to")


@query(f"""WITH {PURCHASES},{_SPLIT} SELECT count(*) FILTER (action = 'inserted') AS inserted, count(*) FILTER (action = 'unchanged') AS unchanged,
  count(*) FILTER (action = 'superseded') AS superseded, coalesce(sum(copies - 1), 0)::BIGINT AS collapsed, 0::BIGINT AS rejected FROM done""")
def upsert_counters(spark, sf):
    live, new = _split(spark, sf)
    return upsert.counters(upsert.natural(new, live, KEY, small=False))


@query(f"""WITH {PURCHASES} SELECT invoice_no, row_hash, line, CASE WHEN EXISTS (SELECT 1 FROM purchases l WHERE l.valid_from < DATE '{CUT}' AND l.row_hash = p.row_hash AND l.gstin = p.gstin) THEN 'unchanged' ELSE 'inserted' END AS action
  FROM purchases p""")
def content_upsert(spark, sf):
    rows = purchases(spark, sf).withColumn("tax_period", F.lit("2024-04"))
    return upsert.content(rows, rows.where(F.col("valid_from") < CUT)).select("invoice_no", "row_hash", "line", "action")


QUERIES["content_upsert_all"], ORACLES["content_upsert_all"] = content_upsert, ORACLES["content_upsert"]


@query(f"""WITH {PURCHASES} SELECT invoice_no, supplier_gstin, line, lag(line) OVER w AS supersedes, lead(valid_from) OVER w AS superseded_at FROM purchases
  WINDOW w AS (PARTITION BY invoice_no, supplier_gstin ORDER BY valid_from, line)""")
def version_chain(spark, sf):
    return upsert.chained(purchases(spark, sf), ["invoice_no", "supplier_gstin"], "valid_from", "line").select("invoice_no", "supplier_gstin", "line", "supersedes", "superseded_at")


@query(f"WITH {PURCHASES} SELECT row_hash, count(*)::BIGINT AS copies, min(line) AS line FROM purchases GROUP BY row_hash")
def collapse_duplicates(spark, sf):
    rows = purchases(spark, sf).select("entity_id", "row_hash", "line")  # a row goes through the shuffle whole: what is not asked for stays behind
    return registers.collapsed(rows, "entity_id").select("row_hash", "copies", "line")


@query(f"WITH {PURCHASES} SELECT l_orderkey, l_linenumber, line, row_hash FROM purchases")
def row_hash(spark, sf):
    return purchases(spark, sf).select("l_orderkey", "l_linenumber", "line", "row_hash")


@query(f"WITH {PURCHASES} SELECT supplier_gstin, invoice_no, count(*)::BIGINT AS n FROM purchases GROUP BY ALL HAVING count(*) > 1")
def duplicate_live_keys(spark, sf):
    rows = purchases(spark, sf).withColumn("superseded_at", F.lit(None).cast("timestamp"))
    return upsert.duplicate_live_keys(rows, ["supplier_gstin", "invoice_no"])


@query(f"""WITH {PURCHASES} SELECT md5('purchase_register:' || line) AS id, invoice_no AS invoice_number, supplier_gstin, taxable_value AS total_taxable_value,
  (cgst + sgst + igst + cess)::DECIMAL(18,2) AS total_tax_value, (taxable_value + cgst + sgst + igst + cess)::DECIMAL(18,2) AS total_value, 'INR' AS currency FROM purchases""")
def v1_purchase_invoice(spark, sf):
    none = F.lit(None)
    rows = purchases(spark, sf).withColumns({"id": F.col("line"), "batch_id": none, "valid_to": none, "recorded_at": none, "superseded_at": none, "bronze_ingest_id": none})
    out = readers.purchase_invoices(rows)
    return out.select(F.replace("invoice_id", F.lit("-"), F.lit("")).alias("id"), "invoice_number", "supplier_gstin", "total_taxable_value", "total_tax_value", "total_value", "currency")


@query(f"WITH {PURCHASES} SELECT l_orderkey, line, (coalesce(cgst, 0) + coalesce(sgst, 0) + coalesce(igst, 0) + coalesce(cess, 0))::DECIMAL(18,2) AS total_tax FROM purchases")
def v1_sales_total_tax(spark, sf):
    rows = purchases(spark, sf).select("l_orderkey", "line", *[F.col(h).alias(f"invoice_{h}") for h in ("cgst", "sgst", "igst", "cess")])
    return readers.sales_register(rows).select("l_orderkey", "line", "total_tax")


@query(f"""WITH {PURCHASES} SELECT l_orderkey, sum(taxable_value)::DECIMAL(18,2) AS total_taxable_value, sum(igst + cgst + sgst)::DECIMAL(18,2) AS total_tax_value,
  sum(taxable_value + igst + cgst + sgst)::DECIMAL(18,2) AS total_value, count(*)::BIGINT AS row_count FROM purchases GROUP BY 1""")
def document_totals(spark, sf):
    tax = F.col("igst") + F.col("cgst") + F.col("sgst")
    return purchases(spark, sf).groupBy("l_orderkey").agg(*documents.totals(F.col("taxable_value"), tax))


@query("""SELECT o_orderkey, o_totalprice::DECIMAL(18,2) AS stated, s AS line_total FROM orders JOIN (SELECT l_orderkey, sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(18,2) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
  WHERE o_totalprice::DECIMAL(18,2) <> s""")
def header_disagreement(spark, sf):
    heads = t(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast(MONEY).alias("stated"))
    lines = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").cast(MONEY).alias("value"))
    return documents.header_disagrees(heads, lines, "o_orderkey", "stated", "value")


@query("""SELECT l_orderkey, sha256(concat_ws(chr(31), 'H' || l_orderkey, string_agg(h, chr(31) ORDER BY l_linenumber, h))) AS document_hash
  FROM (SELECT l_orderkey, l_linenumber, sha256(concat_ws(chr(31), l_linenumber::VARCHAR, l_partkey::VARCHAR)) AS h FROM lineitem) GROUP BY 1""")
def document_hash(spark, sf):
    lines = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", hashing.row_hash("l_linenumber", "l_partkey").alias("h"))
    hs = lines.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "h"))), lambda x: x.h).alias("hs"))
    return hs.select("l_orderkey", hashing.document_hash(F.concat(F.lit("H"), F.col("l_orderkey").cast("string")), F.col("hs")).alias("document_hash"))


_CELLS = """c AS (SELECT *, CASE WHEN l_partkey % 7 = 0 THEN 'abc' WHEN l_partkey % 11 = 0 THEN '  ' ELSE ' ' || l_extendedprice::DECIMAL(18,2)::VARCHAR END AS amount,
  CASE WHEN l_suppkey % 13 = 0 THEN '2024-13-45' WHEN l_suppkey % 17 = 0 THEN NULL ELSE l_shipdate::DATE::VARCHAR END AS txn_date, CASE WHEN l_linenumber = 3 THEN 'maybe' WHEN l_linenumber = 4 THEN 'YES' ELSE '' END AS is_paid FROM lineitem),
k AS (SELECT l_orderkey, l_linenumber, l_partkey, nullif(trim(amount), '') AS amount, nullif(trim(txn_date), '') AS txn_date, nullif(trim(is_paid), '') AS is_paid FROM c),
j AS (SELECT *, CASE WHEN txn_date IS NULL AND amount IS NULL THEN 'txn_date|required: txn_date, amount' WHEN txn_date IS NULL THEN 'txn_date|required: txn_date' WHEN amount IS NULL THEN 'amount|required: amount'
  WHEN txn_date = '2024-13-45' THEN 'txn_date|txn_date: not a date: 2024-13-45' WHEN amount = 'abc' THEN 'amount|amount: not a money: abc' WHEN is_paid = 'maybe' THEN 'is_paid|is_paid: not a boolean: maybe' END AS reject FROM k)"""
_SPEC = (Column("txn_date", "date", True), Column("amount", "money", True), Column("is_paid", "boolean"))


def _cells(spark, sf):
    x = t(spark, sf, "lineitem")
    amount = F.when(F.col("l_partkey") % 7 == 0, "abc").when(F.col("l_partkey") % 11 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("l_extendedprice").cast(MONEY).cast("string")))
    day = F.when(F.col("l_suppkey") % 13 == 0, "2024-13-45").when(F.col("l_suppkey") % 17 != 0, F.to_date("l_shipdate").cast("string"))
    paid = F.when(F.col("l_linenumber") == 3, "maybe").when(F.col("l_linenumber") == 4, "YES").otherwise("")
    raw = x.select("l_orderkey", "l_linenumber", "l_partkey", day.alias("r_txn_date"), amount.alias("r_amount"), paid.alias("r_is_paid"))
    return registers.typed(raw, _SPEC, lambda n: F.col(f"r_{n}"))


@query(f"WITH {_CELLS} SELECT l_orderkey, l_linenumber, l_partkey, split_part(reject, '|', 1) AS column_name, split_part(reject, '|', 2) AS message FROM j WHERE reject IS NOT NULL")
def reject_rows(spark, sf):
    return _cells(spark, sf).where("reject is not null").select("l_orderkey", "l_linenumber", "l_partkey", F.col("reject.column").alias("column_name"), F.col("reject.message").alias("message"))


@query(f"""WITH {_CELLS} SELECT l_orderkey, l_linenumber, l_partkey, txn_date::DATE AS txn_date, amount::DECIMAL(18,2) AS amount, coalesce(is_paid = 'YES', false) AS is_paid,
  sha256(concat_ws(chr(31), txn_date, amount, coalesce(is_paid, ''))) AS row_hash FROM j WHERE reject IS NULL""")
def typed_rows(spark, sf):
    return _cells(spark, sf).where("reject is null").select("l_orderkey", "l_linenumber", "l_partkey", "txn_date", "amount", "is_paid", "row_hash")


@query("""SELECT o_orderkey, printf('%04d-%02d', y, (y + 1) % 100) AS fy, make_date(y::INT, 4, 1) AS fy_start, make_date((y + 1)::INT, 3, 31) AS fy_end, strftime(d, '%m%Y') AS return_period
  FROM (SELECT o_orderkey, o_orderdate::DATE AS d, CASE WHEN month(o_orderdate) >= 4 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS y FROM orders)""")
def financial_year(spark, sf):
    day = F.to_date("o_orderdate")
    low, high = fiscal.containing(day)
    return t(spark, sf, "orders").select("o_orderkey", fiscal.label(day).alias("fy"), low.alias("fy_start"), high.alias("fy_end"), fiscal.return_period(day).alias("return_period"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN b = 0 THEN 0 ELSE round(a * 100 / b, 2) END::DECIMAL(5,2) AS gst_rate
  FROM (SELECT *, (l_quantity * 1.5)::DECIMAL(20,4) AS a, l_extendedprice::DECIMAL(20,4) AS b FROM lineitem)""")
def gst_rate_halfup(spark, sf):
    rate = coerce.gst_rate((F.col("l_quantity") * 1.5).cast("decimal(20,4)"), F.col("l_extendedprice").cast("decimal(20,4)"))
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", rate.alias("gst_rate"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE d END AS parsed FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
def written_dates(spark, sf):
    day = F.to_date("o_orderdate")
    shape = F.when(F.col("o_orderkey") % 4 == 0, day.cast("string")).when(F.col("o_orderkey") % 4 == 1, F.date_format(day, "dd/MM/yyyy")).when(F.col("o_orderkey") % 4 == 2, F.date_format(day, "dd-MM-yyyy")).otherwise(F.date_format(day, "yyyy.MM.dd"))
    return t(spark, sf, "orders").select("o_orderkey", coerce.any_date(shape).alias("parsed"))


@query(f"WITH {PURCHASES} SELECT line, invoice_no FROM purchases WHERE igst > 0 AND (cgst + l_orderkey % 2 > 0)")
def tax_heads_clash(spark, sf):
    p = purchases(spark, sf).withColumn("cgst", F.col("cgst") + F.col("l_orderkey") % 2)
    return p.where(coerce.tax_heads_clash(F.col("igst"), F.col("cgst"), F.col("sgst") * 0)).select("line", "invoice_no")


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'required' WHEN s_suppkey % 3 = 1 THEN 'shape' END AS problem FROM supplier WHERE s_suppkey % 3 <> 2""")
def gstin_rules(spark, sf):
    raw = F.when(F.col("s_suppkey") % 3 == 0, " ").when(F.col("s_suppkey") % 3 == 1, "29 aaaaa").otherwise("29 aaaaa0000a1z5")
    g = coerce.gstin(raw)
    problem = F.when(g.isNull(), "required").when(~g.rlike(coerce.GSTIN["domain"]) | ~g.rlike(coerce.GSTIN["file"]) | ~g.rlike(coerce.GSTIN["text"]), "shape")
    return t(spark, sf, "supplier").select("s_suppkey", problem.alias("problem")).where("problem is not null")


@query("SELECT o_orderkey, o_orderpriority AS value FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
def vocabulary_antijoin(spark, sf):
    words = spark.createDataFrame([("1-URGENT",), ("2-HIGH",)], "value string")
    return documents.unknown_values(t(spark, sf, "orders"), "o_orderpriority", words).select("o_orderkey", F.col("o_orderpriority").alias("value"))


def _batches(spark, sf):
    e = t(spark, sf, "events")
    ready = F.col("ts").cast("timestamp_ntz")
    return e.select(F.col("event_id").alias("batch_id"), F.col("event_type").alias("document_type"), ready.alias("ready_at"), F.when(F.col("event_id") % 9 == 0, "SUPERSEDED").otherwise("READY").alias("status"), F.when(F.col("event_id") % 9 == 0, F.col("event_id") + 1).alias("superseded_by"))


_BATCHES = "b AS (SELECT event_id AS batch_id, event_type AS document_type, ts AS ready_at, CASE WHEN event_id % 9 = 0 THEN 'SUPERSEDED' ELSE 'READY' END AS status, CASE WHEN event_id % 9 = 0 THEN event_id + 1 END AS superseded_by FROM events)"
_V = {"rule_catalog_version": "r1", "corpus_version": "c1", "tenant_pack_version": "t1"}


def _executions(spark, sf):
    e = t(spark, sf, "events").where("event_id % 2 = 0")
    return e.select(F.col("event_id").alias("batch_id"), F.when(F.col("event_id") % 4 == 0, "r1").otherwise("r0").alias("rule_catalog_version"), F.lit("c1").alias("corpus_version"), F.lit("t1").alias("tenant_pack_version"))


@query(f"WITH {_BATCHES} SELECT batch_id, document_type, ready_at FROM b WHERE status = 'READY' AND superseded_by IS NULL AND batch_id % 4 <> 0")
def pending_batches_antijoin(spark, sf):
    return readers.pending_batches(_batches(spark, sf), _executions(spark, sf), _V, limit=None).select("batch_id", "document_type", "ready_at")


@query(f"""WITH {_BATCHES} SELECT batch_id, ready_at FROM b WHERE status = 'READY' AND superseded_by IS NULL AND batch_id % 4 <> 0 AND document_type = 'click'
  AND ready_at > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 1 HOUR ORDER BY ready_at, batch_id LIMIT 100""")
def late_batch_overlap(spark, sf):
    return readers.pending_batches(_batches(spark, sf), _executions(spark, sf), _V, since="2024-01-20 00:00:00", document_type="click").select("batch_id", "ready_at")


@query("SELECT event_id AS batch_id, 'r1' AS rule_catalog_version FROM events WHERE event_id % 3 = 0 AND event_id % 4 <> 0")
def record_executions(spark, sf):
    new = t(spark, sf, "events").where("event_id % 3 = 0").select(F.col("event_id").alias("batch_id"), *[F.lit(v).alias(k) for k, v in _V.items()])
    return readers.record_executions(_executions(spark, sf), new.unionByName(new)).select("batch_id", "rule_catalog_version")


@query("SELECT 'c' || user_id % 5 AS consumer_name, event_type AS document_type, max(ts) AS watermark FROM events GROUP BY ALL")
def watermarks(spark, sf):
    e = t(spark, sf, "events").select(F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string")).alias("consumer_name"), F.col("event_type").alias("document_type"), F.col("ts").alias("watermark"), "event_id")
    return readers.watermark(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"))


@query("""SELECT count(*) FILTER (status IN ('READY', 'ACCEPTED')) * 100.0::DOUBLE / nullif(count(*), 0) AS percent, max(ready_at) AS last_ingestion_at
  FROM (SELECT CASE WHEN event_type = 'error' THEN 'QUARANTINED' ELSE 'READY' END AS status, ts AS ready_at FROM events)""")
def command_center_quality(spark, sf):
    rows = t(spark, sf, "events").select(F.when(F.col("event_type") == "error", "QUARANTINED").otherwise("READY").alias("status"), F.col("ts").alias("ready_at"), F.lit(None).alias("superseded_by"))
    return readers.data_quality(rows)


def _notices(spark, sf):
    return t(spark, sf, "orders").select(F.col("o_orderkey").alias("notice_id"), F.col("o_orderpriority").alias("notice_number"), F.lit("x").alias("issue_category"), F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") == "P", "Awaiting Approval").otherwise("Open").alias("status"), F.when(F.col("o_orderpriority") == "1-URGENT", "Critical").when(F.col("o_orderpriority") == "2-HIGH", "High").otherwise("Low").alias("risk"), F.to_date("o_orderdate").alias("response_due_date"))


_NOTICES = "n AS (SELECT o_orderkey AS notice_id, o_orderpriority AS p, CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'P' THEN 'Awaiting Approval' ELSE 'Open' END AS status, CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High' ELSE 'Low' END AS risk, o_orderdate::DATE AS due FROM orders)"


@query(f"WITH {_NOTICES} SELECT count(*) FILTER (status NOT IN ('Closed', 'Submitted')) AS pending_count, min(due) AS next_sla_at FROM n")
def command_center_notices(spark, sf):
    return readers.notice_counts(_notices(spark, sf))


@query(f"""WITH {_NOTICES} SELECT notice_id::VARCHAR AS id, p AS title, 'x' AS description, CASE WHEN risk = 'Critical' THEN 'CRITICAL' WHEN status = 'Awaiting Approval' THEN 'PENDING_APPROVAL' ELSE 'REQUIRED' END AS severity
  FROM n WHERE status NOT IN ('Closed', 'Submitted') AND (risk IN ('High', 'Critical') OR due <= DATE '1996-01-01' + 7)""")
def command_center_actions(spark, sf):
    return readers.open_actions(_notices(spark, sf), F.lit("1996-01-01").cast("date"))


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(spark, sf):
    e = t(spark, sf, "events").select(F.col("user_id").alias("doc_type_code"), F.col("ts").alias("pinned_at"), F.col("event_id").alias("id"), "event_type")
    return readers.latest_pins(e).select(F.col("doc_type_code").alias("user_id"), F.col("id").alias("event_id"), "event_type")


@query("SELECT user_id AS doc_type_code, 'purchase' AS artifact_id FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) WHERE event_type <> 'purchase'")
def roll_pins_forward(spark, sf):
    pins = t(spark, sf, "events").select(F.col("user_id").alias("doc_type_code"), F.col("ts").alias("pinned_at"), F.col("event_id").alias("id"), F.col("event_type").alias("artifact_id"))
    release = pins.select("doc_type_code").distinct().withColumn("artifact_id", F.lit("purchase"))
    return readers.rolled_forward(pins, release, F.lit("2025-01-01").cast("timestamp_ntz")).select("doc_type_code", "artifact_id")


@query("""WITH top AS (SELECT o_custkey AS c, o_orderpriority AS p, max_by(o_orderkey, o_orderdate::VARCHAR || printf('%012d', o_orderkey)) AS k FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY ALL)
  SELECT c_custkey AS fact_id, b.k AS board, s.k AS service, CASE WHEN b.k IS NOT NULL AND s.k IS NOT NULL THEN 'BOARD_RESOLUTION_AND_SERVICE_AGREEMENT_ON_FILE' WHEN b.k IS NOT NULL THEN 'BOARD_RESOLUTION_ON_FILE' WHEN s.k IS NOT NULL THEN 'SERVICE_AGREEMENT_ON_FILE' ELSE 'CLIENT_LIST_ONLY' END AS evidence_status, 3 AS n_references
  FROM customer LEFT JOIN top b ON b.c = c_custkey AND b.p = '1-URGENT' LEFT JOIN top s ON s.c = c_custkey AND s.p = '2-HIGH'""")
def director_evidence(spark, sf):
    directors = t(spark, sf, "customer").select(F.col("c_custkey").alias("fact_id"), F.col("c_custkey").alias("entity_id"), F.lit("d").alias("din"), F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("bronze_ingest_id"))
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "BOARD_RESOLUTION_DIRECTOR_APPOINTMENT").when(F.col("o_orderpriority") == "2-HIGH", "DIRECTOR_SERVICE_AGREEMENT").otherwise("OTHER")
    contracts = t(spark, sf, "orders").select(F.col("o_custkey").alias("entity_id"), kind.alias("contract_type"), F.col("o_orderkey").alias("contract_id"), F.col("o_orderkey").cast("string").alias("bronze_ingest_id"), F.col("o_orderdate").alias("recorded_at"), F.lit(None).alias("superseded_at"))
    out = readers.director_evidence(directors, contracts)
    return out.select("fact_id", F.col("board_resolution_reference").alias("board"), F.col("service_agreement_reference").alias("service"), "evidence_status", F.size("source_record_references").alias("n_references"))


@query("""SELECT s_suppkey AS entity_id, CASE s_suppkey % 3 WHEN 0 THEN 'Active' WHEN 1 THEN 'Cancelled' ELSE 'Suspended' END AS registration_status, CASE WHEN s_suppkey % 3 <> 0 THEN DATE '2024-01-01' + (s_suppkey % 300)::INT END AS effective_to FROM supplier""")
def status_date_parse(spark, sf):
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("s_suppkey") % 300).cast("int")), "dd-MMM-yyyy")
    status = F.when(F.col("s_suppkey") % 3 == 0, "Active").when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("Cancelled ("), day, F.lit(")"))).otherwise(F.concat(F.lit("Suspended ("), day, F.lit(")")))
    rows = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity_id"), F.lit("g").alias("gstin"), F.lit("Regular").alias("registration_type"), status.alias("status"), F.lit(None).cast("date").alias("effective_date"), F.lit(None).alias("recorded_at"), F.lit(None).alias("bronze_ingest_id"))
    return readers.registration_history(rows).select("entity_id", "registration_status", "effective_to")


def _instruments(spark, sf):
    p = t(spark, sf, "part")
    code = F.substring(F.format_string("%08d", F.col("p_partkey") * 7919 % 100000000), 1, F.element_at(F.array(F.lit(2), F.lit(4), F.lit(6), F.lit(8)), (F.col("p_size") % 4 + 1).cast("int")))
    start = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_partkey") % 700).cast("int"))
    return p.select(F.col("p_partkey").alias("instrument_id"), (F.col("p_partkey") % 20).alias("entity_id"), F.lit("LUT").alias("instrument_type"), F.col("p_name").alias("instrument_number"), start.alias("valid_from"), F.date_add(start, 500).alias("valid_to"), F.when(F.col("p_partkey") % 6 == 0, "SUSPENDED").otherwise("ACTIVE").alias("status"), F.when(F.col("p_partkey") % 50 != 0, F.array(code)).alias("scope_hsn"), F.lit(None).alias("superseded_at"))


def _supplies(spark, sf):
    o = t(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("supply_id"), (F.col("o_custkey") % 20).alias("entity_id"), F.lit("LUT").alias("instrument_type"), F.format_string("%08d", F.col("o_orderkey") * 7919 % 100000000).alias("hsn"), F.to_date("o_orderdate").alias("day"))


_ENTITLED = """i AS (SELECT p_partkey AS id, p_partkey % 20 AS e, DATE '1995-01-01' + (p_partkey % 700)::INT AS f, DATE '1995-01-01' + (p_partkey % 700)::INT + 500 AS u,
  CASE WHEN p_partkey % 50 <> 0 THEN left(printf('%08d', p_partkey * 7919 % 100000000), ((p_size % 4) + 1) * 2) END AS code FROM part WHERE p_partkey % 6 <> 0),
s AS (SELECT o_orderkey AS supply_id, o_custkey % 20 AS e, printf('%08d', o_orderkey * 7919 % 100000000) AS hsn, o_orderdate::DATE AS day FROM orders),
m AS (SELECT s.supply_id, i.id, i.f FROM s JOIN i ON s.e = i.e AND s.day BETWEEN i.f AND i.u AND (i.code IS NULL OR starts_with(s.hsn, i.code)))"""


@query(f"WITH {_ENTITLED} SELECT supply_id, id AS instrument_id, row_number() OVER (PARTITION BY supply_id ORDER BY f DESC, id) AS rank FROM m")
def entitlement_asof(spark, sf):
    return readers.entitlements(_supplies(spark, sf), _instruments(spark, sf), given=()).select("supply_id", "instrument_id", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {_ENTITLED} SELECT supply_id, EXISTS (SELECT 1 FROM m WHERE m.supply_id = s.supply_id) AS entitled FROM s")
def is_entitled(spark, sf):
    return readers.is_entitled(_supplies(spark, sf), _instruments(spark, sf)).select("supply_id", "entitled")


for _name in ("entitlement_asof", "is_entitled"):  # the names under which the whole tables were first asked
    QUERIES[f"{_name}_all"], ORACLES[f"{_name}_all"] = QUERIES[_name], ORACLES[_name]


@query("""SELECT p_partkey, array_to_string(list_distinct_sorted, ',') AS prefixes FROM (SELECT p_partkey, list_sort(list_distinct(list_append([left(c, n) FOR n IN [2, 4, 6, 8] IF n <= greatest(2, length(c))], c))) AS list_distinct_sorted
  FROM (SELECT p_partkey, left(printf('%08d', p_partkey * 7919 % 100000000), (4 + p_size % 5)::INT) AS c FROM part))""")
def hsn_prefix_scope(spark, sf):
    code = F.substr(F.format_string("%08d", F.col("p_partkey") * 7919 % 100000000), F.lit(1), (F.col("p_size") % 5 + 4).cast("int"))
    return t(spark, sf, "part").select("p_partkey", F.array_join(F.array_sort(readers.hsn_prefixes(code)), ",").alias("prefixes"))


@query("""WITH r AS (SELECT event_id % 500 AS ingest_id, count(*) AS rejected_rows FROM events WHERE event_type = 'error' AND event_id % 3 = 0 GROUP BY 1),
  l AS (SELECT DISTINCT event_id % 500 AS ingest_id FROM events)
  SELECT l.ingest_id, CASE WHEN l.ingest_id % 4 = 0 THEN CASE WHEN l.ingest_id % 8 = 0 THEN 'QUARANTINED' ELSE 'PENDING' END WHEN rejected_rows > 0 THEN 'PARTIAL' ELSE 'ACCEPTED' END AS outcome,
  CASE WHEN l.ingest_id % 4 <> 0 THEN 10 + coalesce(rejected_rows, 0) END AS row_count, coalesce(rejected_rows, 0) AS rejected_rows FROM l LEFT JOIN r USING (ingest_id)""")
def artefact_outcomes(spark, sf):
    e = t(spark, sf, "events").withColumn("ingest_id", F.col("event_id") % 500)
    ledger = e.select("ingest_id").distinct()
    done = ledger.where("ingest_id % 4 <> 0").select(F.col("ingest_id").alias("bronze_manifest_ref"), F.col("ingest_id").alias("batch_id"), F.lit(10).cast("long").alias("row_count"))
    out = readers.artefact_outcomes(ledger, done, e.where("event_type = 'error' and event_id % 3 = 0"), ledger.where("ingest_id % 8 = 0"))
    return out.select("ingest_id", "outcome", "row_count", "rejected_rows")


@query("""SELECT event_id AS ingest_id, first_value(event_id) OVER w AS held_by, first_value(event_id) OVER w <> event_id AS duplicate FROM events WINDOW w AS (PARTITION BY md5(props) ORDER BY event_id % 10 <> 0 DESC, ts, event_id) QUALIFY event_id % 10 <> 0""".replace("event_id % 10 <> 0 DESC", "(event_id % 10 <> 0)::INT"))
def content_hash_dedup(spark, sf):
    e = t(spark, sf, "events").select(F.col("event_id").alias("ingest_id"), F.lit("t").alias("tenant"), F.md5(F.col("props").cast("binary")).alias("content_hash"), F.col("ts").alias("received_at"))
    return intake.first_copies(e.where("ingest_id % 10 <> 0"), e.where("ingest_id % 10 = 0")).select("ingest_id", "held_by", "duplicate")


@query("""SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'EMPTY_FILE' WHEN doc_id % 11 = 0 THEN 'FILE_TOO_LARGE' WHEN doc_id % 4 = 3 THEN 'UNSUPPORTED_EXTENSION' END AS refusal,
  CASE doc_id % 4 WHEN 0 THEN 'CSV' WHEN 1 THEN 'NDJSON' WHEN 2 THEN 'PDF' END AS content_format FROM documents""")
def intake_gate(spark, sf):
    name = F.concat(F.lit("f."), F.element_at(F.array(*[F.lit(x) for x in ("csv", "JSON", "pdf", "exe")]), (F.col("doc_id") % 4 + 1).cast("int")))
    size = F.when(F.col("doc_id") % 7 == 0, 0).when(F.col("doc_id") % 11 == 0, intake.MAX_BYTES + 1).otherwise(5)
    return t(spark, sf, "documents").select("doc_id", intake.refusal(name, size).alias("refusal"), intake.content_format(name).alias("content_format"))


@query("""SELECT s_suppkey, value, scope FROM (SELECT s_suppkey % 20 AS s_suppkey, s_nationkey AS value, CASE s_suppkey % 3 WHEN 0 THEN 'entity' WHEN 1 THEN 'tenant' ELSE 'platform' END AS scope, s_suppkey AS v, s_suppkey % 3 AS rk, s_nationkey % 4 AS priority FROM supplier)
  QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY rk, priority DESC, v DESC) = 1""")
def resolved_settings(spark, sf):
    s = t(spark, sf, "supplier")
    scope = F.element_at(F.array(*[F.lit(x) for x in ("entity", "tenant", "platform")]), (F.col("s_suppkey") % 3 + 1).cast("int"))
    rows = s.select((F.col("s_suppkey") % 20).alias("setting_key"), F.col("s_nationkey").alias("value"), scope.alias("scope"), (F.col("s_nationkey") % 4).alias("priority"), F.col("s_suppkey").alias("version"), F.lit("2020-01-01").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    return readers.resolved_settings(rows, ["entity", "tenant", "platform"], F.lit("2024-01-01").cast("date")).select(F.col("setting_key").alias("s_suppkey"), "value", "scope")


@query("""WITH w AS (SELECT p_partkey AS id, p_brand AS k, DATE '2020-01-01' + (p_partkey * 37 % 3000)::INT AS f, DATE '2020-01-01' + (p_partkey * 37 % 3000 + p_size)::INT AS u FROM part)
  SELECT a.id AS a_id, b.id AS b_id FROM w a JOIN w b ON a.k = b.k AND (a.f < b.f OR (a.f = b.f AND a.id < b.id)) AND a.u >= b.f""")
def overlap_audit(spark, sf):
    start = (F.col("p_partkey") * 37 % 3000).cast("int")
    origin = F.lit("2020-01-01").cast("date")
    rows = t(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("k"), F.date_add(origin, start).alias("f"), F.date_add(origin, start + F.col("p_size")).alias("u"))
    return readers.overlapping(rows, "k", "f", "u", "id").select("a_id", "b_id")


@query("""WITH w AS (SELECT p_partkey AS id, p_brand AS k, CASE WHEN p_partkey % 101 <> 0 THEN DATE '2020-01-01' + (p_partkey * 37 % 3000)::INT END AS f,
    CASE WHEN p_partkey % 89 = 0 THEN NULL WHEN p_partkey % 83 = 0 THEN DATE '9999-12-31' ELSE DATE '2020-01-01' + (p_partkey * 37 % 3000 + p_size)::INT END AS u FROM part),
  x AS (SELECT id, k, coalesce(f, DATE '0001-01-01') AS f, coalesce(u, DATE '9999-12-31') AS u FROM w)
  SELECT a.id AS a_id, b.id AS b_id FROM x a JOIN x b ON a.k = b.k AND (a.f < b.f OR (a.f = b.f AND a.id < b.id)) AND a.u >= b.f""")
def open_overlaps(spark, sf):
    """J-11, Q-10, V-20: windows without a start or an end, or with the end that stands for none, among short ones."""
    start = (F.col("p_partkey") * 37 % 3000).cast("int")
    origin = F.lit("2020-01-01").cast("date")
    no_start, no_end, far = (F.col("p_partkey") % n == 0 for n in (101, 89, 83))
    ends = F.when(no_end, F.lit(None)).when(far, F.lit("9999-12-31").cast("date")).otherwise(F.date_add(origin, start + F.col("p_size")))
    rows = t(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("k"), F.when(~no_start, F.date_add(origin, start)).alias("f"), ends.alias("u"))
    return readers.overlapping(rows, "k", "f", "u", "id").select("a_id", "b_id")


@query("""SELECT e.event_id, (SELECT s.event_type FROM events s WHERE s.event_id % 5 = 0 AND s.user_id = e.user_id AND s.ts <= e.ts ORDER BY s.ts DESC LIMIT 1) AS status FROM events e WHERE e.event_id % 5 <> 0""")
def asof_status(spark, sf):
    e = t(spark, sf, "events")
    states = e.where("event_id % 5 = 0").select("user_id", F.col("ts").alias("since"), F.col("event_type").alias("status"))
    return readers.as_of(e.where("event_id % 5 <> 0"), states, ["user_id"], "ts", "since", ["status"]).select("event_id", "status")


@query("""SELECT gstin, tax_period, stated, declared, (coalesce(stated, 0) - coalesce(declared, 0))::DECIMAL(18,2) AS short FROM
  (SELECT l_suppkey % 7 AS gstin, strftime(l_shipdate, '%Y-%m') AS tax_period, sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(38,2) AS stated FROM lineitem GROUP BY ALL) a FULL JOIN
  (SELECT o_custkey % 7 AS gstin, strftime(o_orderdate, '%Y-%m') AS tax_period, sum(o_totalprice::DECIMAL(18,2))::DECIMAL(38,2) AS declared FROM orders GROUP BY ALL) b USING (gstin, tax_period) WHERE coalesce(stated, 0) - coalesce(declared, 0) > 1""")
def recon_full_outer(spark, sf):
    out = t(spark, sf, "lineitem").select((F.col("l_suppkey") % 7).alias("gstin"), F.date_format("l_shipdate", "yyyy-MM").alias("tax_period"), F.col("l_extendedprice").alias("taxable_value"))
    said = t(spark, sf, "orders").select((F.col("o_custkey") % 7).alias("gstin"), F.date_format("o_orderdate", "yyyy-MM").alias("tax_period"), F.col("o_totalprice").alias("t31a_taxable_value"))
    return recon.understated_liability(out, said).drop("check").withColumns({"stated": F.col("stated").cast("decimal(38,2)"), "declared": F.col("declared").cast("decimal(38,2)")})


@query("""SELECT gstin, tax_period, (coalesce(claimed, 0) - coalesce(offered, 0))::DECIMAL(18,2) AS gap, CASE WHEN coalesce(claimed, 0) < coalesce(offered, 0) THEN 'R-09' ELSE 'R-10' END AS "check" FROM
  (SELECT l_suppkey % 7 AS gstin, strftime(l_shipdate, '%Y-%m') AS tax_period, sum(l_tax::DECIMAL(18,2)) AS claimed FROM lineitem GROUP BY ALL) a FULL JOIN
  (SELECT l_suppkey % 7 AS gstin, strftime(l_shipdate, '%Y-%m') AS tax_period, sum(l_discount::DECIMAL(18,2)) AS offered FROM lineitem GROUP BY ALL) b USING (gstin, tax_period) WHERE abs(coalesce(claimed, 0) - coalesce(offered, 0)) > 1""")
def recon_credit(spark, sf):
    x = t(spark, sf, "lineitem").select((F.col("l_suppkey") % 7).alias("gstin"), F.date_format("l_shipdate", "yyyy-MM").alias("tax_period"), "l_tax", "l_discount")
    return recon.credit_against_statement(x.withColumn("itc", F.col("l_tax")), x.withColumn("itc", F.col("l_discount"))).select("gstin", "tax_period", "gap", "check")


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_suppkey % 4 = 0 AND l_shipdate::DATE >= DATE '1996-01-01' + (s_suppkey % 100)::INT""")
def recon_cancelled_party(spark, sf):
    invoices = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("supplier_gstin"), F.to_date("l_shipdate").alias("invoice_date"))
    gone = F.when(F.col("s_suppkey") % 4 == 0, F.date_format(F.date_add(F.lit("1996-01-01").cast("date"), (F.col("s_suppkey") % 100).cast("int")), "dd-MM-yyyy"))
    return recon.cancelled_party(invoices, t(spark, sf, "supplier").select(F.col("s_suppkey").alias("gstin"), gone.alias("cancellation_date")), "supplier_gstin", "R-03").select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT o_orderkey AS invoice_no, CASE WHEN o_orderdate::DATE >= DATE '1999-01-01' THEN 100000 ELSE 200000 END AS threshold FROM orders
  WHERE o_orderdate::DATE >= DATE '1995-06-01' AND o_totalprice >= CASE WHEN o_orderdate::DATE >= DATE '1999-01-01' THEN 100000 ELSE 200000 END AND o_orderkey % 3 <> 0""")
def recon_threshold(spark, sf):
    o = t(spark, sf, "orders").select(F.lit("IN").alias("scope"), F.col("o_orderkey").alias("invoice_no"), F.to_date("o_orderdate").alias("invoice_date"), F.col("o_totalprice").alias("value"))
    steps = spark.createDataFrame([("IN", "1995-06-01", 200000), ("IN", "1999-01-01", 100000)], "scope string, d string, threshold int").select("scope", F.to_date("d").alias("effective_from"), "threshold")
    return recon.above_threshold_without(o, o.where("invoice_no % 3 = 0"), steps, "R-15").select("invoice_no", "threshold")


@query("SELECT o_orderkey, (l.d - o_orderdate::DATE)::INT AS days_late FROM orders JOIN (SELECT l_orderkey, max(l_shipdate)::DATE AS d FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey WHERE l.d > o_orderdate::DATE")
def recon_late_filing(spark, sf):
    last = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.to_date(F.max("l_shipdate")).alias("filing_date"))
    return recon.late_filings(t(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("due_date")).join(last, "o_orderkey")).select("o_orderkey", "days_late")


@query("SELECT o_orderkey AS shipping_bill_no FROM orders WHERE o_orderdate::DATE + INTERVAL 12 MONTH < DATE '2000-01-01' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def recon_unrealised(spark, sf):
    bills = t(spark, sf, "orders").select(F.col("o_orderkey").alias("shipping_bill_no"), F.to_date("o_orderdate").alias("shipping_bill_date"))
    done = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("shipping_bill_no"), F.when(F.col("l_returnflag") == "R", "Realised").otherwise("Pending").alias("realisation_status"))
    return recon.unrealised(bills, done, F.lit("2000-01-01").cast("date")).select("shipping_bill_no")


@query("""SELECT event_id, section, amount FROM (SELECT event_id, 'K' AS section, (props->>'$.k')::BIGINT AS amount FROM events UNION ALL SELECT event_id, 'V', floor(value)::BIGINT FROM events) WHERE amount > 50""")
def json_section_union(spark, sf):
    e = t(spark, sf, "events").withColumn("p", F.from_json("props", "k long"))
    both = e.select("event_id", F.lit("K").alias("section"), F.col("p.k").alias("amount")).unionByName(e.select("event_id", F.lit("V").alias("section"), F.floor("value").cast("long").alias("amount")))
    return both.where("amount > 50")


@query("SELECT event_type, key, sum(v)::BIGINT AS total FROM (SELECT event_type, 'k' AS key, (props->>'$.k')::BIGINT AS v FROM events) WHERE v IS NOT NULL GROUP BY ALL")
def map_explode_summary(spark, sf):
    e = t(spark, sf, "events").select("event_type", F.explode(F.from_json("props", "map<string,long>")).alias("key", "v"))
    return e.groupBy("event_type", "key").agg(F.sum("v").alias("total"))


@query("SELECT l.event_id AS fact_id, r.event_id AS bronze_ingest_id, md5(r.props) AS content_hash FROM events l JOIN events r ON r.event_id = l.event_id // 2")
def lineage_join(spark, sf):
    e = t(spark, sf, "events")
    facts = e.select(F.col("event_id").alias("fact_id"), F.expr("event_id div 2").alias("bronze_ingest_id"))
    ledger = e.select(F.col("event_id").alias("ingest_id"), F.col("event_type").alias("object_key"), F.md5(F.col("props").cast("binary")).alias("content_hash"))
    return readers.lineage(facts, ledger).select("fact_id", "bronze_ingest_id", "content_hash")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'NO_TEXT_LAYER' WHEN o_orderkey % 5 = 1 THEN 'PARTIAL' ELSE 'EXTRACTED' END AS outcome, CASE WHEN o_orderkey % 5 = 1 THEN 'valid_from' ELSE '' END AS missing,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'No ' || o_orderkey END AS number, CASE WHEN o_orderkey % 5 > 1 THEN o_orderdate::DATE::VARCHAR END AS valid_from, CASE WHEN o_orderkey % 5 > 1 THEN (o_totalprice::DECIMAL(18,2))::VARCHAR END AS amount FROM orders""")
def label_values(spark, sf):
    day = F.date_format("o_orderdate", "dd MMMM yyyy")
    money = F.format_number(F.col("o_totalprice").cast(MONEY), 2)
    page = F.when(F.col("o_orderkey") % 5 == 0, "  scan ").when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit("CERTIFICATE of something\nlicence no. : No "), F.col("o_orderkey").cast("string")))
    page = page.otherwise(F.concat(F.lit("Licence No.: No "), F.col("o_orderkey").cast("string"), F.lit("\nDate of Issue: "), day, F.lit(" (renewable)\nAmount Paid in full "), money, F.lit("\nDate of Issue: 01 January 1900")))
    docs = t(spark, sf, "orders").select("o_orderkey", F.array(page).alias("pages"))
    out = text.label_outcome(docs, [("number", "text", True, "Licence No."), ("valid_from", "date", True, "Date of Issue"), ("amount", "money", False, "Amount Paid")])
    fact = lambda n: F.when(F.col("outcome") != "NO_TEXT_LAYER", F.col("facts")[n]).alias(n)
    return out.select("o_orderkey", "outcome", F.array_join("missing", ",").alias("missing"), fact("number"), fact("valid_from"), fact("amount"))


@query("""SELECT o_orderkey, 'Holder ' || o_custkey AS holder, o_custkey::VARCHAR AS shares, CASE WHEN o_orderkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS pledged FROM orders""")
def wrapped_table_rows(spark, sf):
    who = F.col("o_custkey").cast("string")
    pledged = F.when(F.col("o_orderkey") % 2 == 0, "Yes").otherwise("No")
    page = F.concat(F.lit("Shareholding pattern\nName Shares Pledged\nHolder\n"), who, F.lit("  "), F.format_number("o_custkey", 0), F.lit("\n"), pledged, F.lit("\nEnd of list"))
    docs = t(spark, sf, "orders").select("o_orderkey", F.array(page).alias("pages"))
    out = text.table_rows(docs, r"(?P<holder>Holder \d+)\s+(?P<shares>[\d,]+)\s+(?P<pledged>Yes|No)", [("holder", "text"), ("shares", "money"), ("pledged", "text")])
    r = out.select("o_orderkey", F.explode("rows").alias("r"))
    return r.select("o_orderkey", *[F.col("r")[n].alias(n) for n in ("holder", "shares", "pledged")])


@query("""SELECT o_orderkey, k.n::INT AS place, 'Holder ' || (o_custkey + k.n) AS holder, (o_custkey * 1000 + k.n)::DECIMAL(18,2) AS shares, (o_totalprice::DECIMAL(18,2) + k.n)::DECIMAL(18,2) AS amount, o_orderdate::DATE AS since
  FROM orders, (VALUES (1), (2), (3)) k(n) WHERE k.n <= o_orderkey % 4""")
def document_rows(spark, sf):
    """X-04 as SQL's table function: typed rows that wrap differently in each document, between lines that are none."""
    text.register(spark)
    t(spark, sf, "orders").createOrReplaceTempView("ledgerline_orders")
    return spark.sql(r"""
      WITH docs AS (SELECT o_orderkey, transform(sequence(0, cast(o_orderkey % 4 as int)), k -> if(k = 0, 'Holders and others\nHolder Name Shares\nHolder 12',
          concat('Holder', if(k % 2 = 0, '\n', ' '), o_custkey + k, '\n', format_number(o_custkey * 1000 + k, 0), if(o_orderkey % 3 = 0, '\n\n ', ' '),
            format_number(cast(o_totalprice as decimal(18,2)) + k, 2), '\n', date_format(o_orderdate, 'dd-MMM-yyyy'), '\nNote ', k))) AS pages FROM ledgerline_orders)
      SELECT o_orderkey, r.* FROM docs, LATERAL document_rows(pages, '(?P<holder>Holder \\d+)\\s+(?P<shares>[\\d,]+)\\s+(?P<amount>[\\d,]+\\.\\d\\d)\\s+(?P<since>\\d{2}-[A-Za-z]{3}-\\d{4})', 'holder text, shares money, amount money, since date') r""")


@query("""WITH s AS (SELECT p_partkey % 5 AS k, CASE WHEN p_partkey % 10 <> 0 THEN p_size % 25 END AS e, CASE WHEN p_partkey % 10 <> 0 AND p_partkey % 3 = 1 THEN (p_partkey % 4) * 25 + p_size % 25 END AS g,
    DATE '1992-01-01' + (p_partkey * 37 % 3500)::INT AS f, CASE WHEN p_partkey % 2 = 1 THEN DATE '1992-01-01' + (p_partkey * 37 % 3500 + p_size * 10)::INT END AS u, p_partkey AS version, p_retailprice::DECIMAL(18,2) AS v FROM part),
  o AS (SELECT o_orderkey, o_orderkey % 5 AS k, o_custkey % 25 AS e, o_custkey % 100 AS g, o_orderdate::DATE AS d FROM orders),
  x AS (SELECT o_orderkey, d, 2 AS level, s.* EXCLUDE (k, e, g) FROM o JOIN s ON o.k = s.k AND o.e = s.e AND o.g = s.g AND f <= d
    UNION ALL SELECT o_orderkey, d, 1, s.* EXCLUDE (k, e, g) FROM o JOIN s ON o.k = s.k AND o.e = s.e AND s.g IS NULL AND f <= d
    UNION ALL SELECT o_orderkey, d, 0, s.* EXCLUDE (k, e, g) FROM o JOIN s ON o.k = s.k AND s.e IS NULL AND f <= d),
  l AS (SELECT o_orderkey, d, level, u, v FROM x QUALIFY row_number() OVER (PARTITION BY o_orderkey, level ORDER BY f DESC, version DESC) = 1)
  SELECT o_orderkey, level::INT AS level, v AS value FROM l WHERE u IS NULL OR u > d QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY level DESC) = 1""")
def settings_in_force(spark, sf):
    """W-04, V-18: all orders ask for the setting in force on their day; parts are the rows of tenant, entities and GSTINs."""
    begin = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("p_partkey") * 37 % 3500).cast("int"))
    rows = t(spark, sf, "part").select(
        (F.col("p_partkey") % 5).alias("setting_id"),
        F.expr("if(p_partkey % 10 <> 0, p_size % 25, null)").cast("long").alias("entity_id"),
        F.expr("if(p_partkey % 10 <> 0 and p_partkey % 3 = 1, (p_partkey % 4) * 25 + p_size % 25, null)").alias("gstin"),
        begin.alias("effective_from"),
        F.when(F.col("p_partkey") % 2 == 1, F.date_add(begin, F.col("p_size") * 10)).alias("effective_to"),
        F.col("p_partkey").alias("version"),
        F.col("p_retailprice").cast(MONEY).alias("value"),
    )
    asks = t(spark, sf, "orders").select("o_orderkey", F.expr("o_orderkey % 5").alias("setting_id"), F.expr("o_custkey % 25").alias("entity_id"), F.expr("o_custkey % 100").alias("gstin"), F.to_date("o_orderdate").alias("day"))
    return settings.in_force(asks, rows, "day", ["value"]).select("o_orderkey", "level", "value")
