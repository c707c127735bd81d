"""Header/line documents (A-01 to A-03, A-11, P-08 to P-17, P-23, P-28 to P-30, Q-01, Q-02)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import coerce, hashing
from ledgerline.plans.checks import checks_of
from ledgerline.plans.contracts import LINE_KINDS, OPTIONAL, REQUIRED, Contract
from ledgerline.plans.registers import SALES_HEADER, SALES_LINE, VOCABULARIES

#: Writes rows that several results come from, and reads them back.
Hold = Callable[[DataFrame], DataFrame]


def same(rows: DataFrame) -> DataFrame:
    """Holds nothing: each result is planned from the input."""
    return rows


_ZERO_IF_BLANK = ("cgst_amount", "sgst_amount", "igst_amount", "cess_amount", "itc_amount")


def transaction_rows(rows: DataFrame, contract: Contract, rule: str = "file") -> DataFrame:
    """P-08 to P-14: typed cells of a transaction file, with ``problems``: all that is wrong with each row."""
    own = contract.doc + contract.line
    kinds = {"doc_date": "date", **LINE_KINDS, **{a.name: a.kind for a in own}}
    names = dict.fromkeys([*REQUIRED, *kinds, "counterparty_name", "currency"])
    # cells and their values are columns of their own, so that no test computes them again; explode: nor what the cells come from
    rows = rows.withColumn("cells", F.explode(F.array("cells")))
    rows = rows.withColumns({f"_t_{n}": coerce.cell(F.col("cells")[n]) for n in names} | {"_t_counterparty_gstin": coerce.gstin(F.col("cells")["counterparty_gstin"])})
    rows = rows.withColumns({f"_v_{n}": coerce.attribute(k, F.col(f"_t_{n}"))[0] for n, k in kinds.items()})
    cell = lambda n: F.col(f"_t_{n}")
    value = lambda n: F.col(f"_v_{n}")
    tests = [F.when(cell(n).isNull(), f"{n}: required") for n in REQUIRED]
    tests += [F.when(cell(n).isNotNull() & value(n).isNull(), F.concat(F.lit(f"{n}: not a {k}: "), cell(n))) for n, k in kinds.items() if k != "text"]
    tests += [F.when(cell(a.name).isNull(), f"{a.name}: required") for a in own if a.required]
    gstin = F.col("_t_counterparty_gstin")
    if contract.counterparty == "REQUIRED":
        tests.append(F.when(gstin.isNull(), "counterparty_gstin: required"))
    if contract.counterparty == "FOREIGN":
        tests.append(F.when(gstin.isNotNull(), "counterparty_gstin: a foreign party has none"))
        tests.append(F.when(cell("counterparty_name").isNull(), "counterparty_name: required"))
    else:
        tests.append(F.when(~gstin.rlike(coerce.GSTIN[rule]), "counterparty_gstin: wrong shape"))
    zero = lambda n: F.when(cell(n).isNull(), F.lit(0).cast("decimal(18,2)")).otherwise(value(n)) if n in _ZERO_IF_BLANK else value(n)
    out = {n: zero(n) for n in kinds} | {"doc_number": cell("doc_number"), "counterparty_gstin": gstin, "counterparty_name": cell("counterparty_name"), "currency": coerce.currency(F.col("cells")["currency"])}
    clash = coerce.tax_heads_clash(F.col("igst_amount"), F.col("cgst_amount"), F.col("sgst_amount"))
    typed = rows.withColumns(out)
    typed = typed.withColumn("problems", F.array_compact(F.array(*tests, F.when(clash, "igst excludes cgst and sgst"))))
    return typed.drop(*[c for c in typed.columns if c.startswith(("_t_", "_v_"))])


def transactions(rows: DataFrame, contract: Contract, file: str = "path", hold: Hold = same) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A-01, A-02, P-15, P-17: documents, lines, and what is wrong; a file with one bad row is refused whole.

    All three come from the typed rows; ``hold`` writes these, so that cells are coerced once.
    """
    group = [file, "doc_number", "counterparty_gstin"]
    typed = hold(transaction_rows(rows, contract).drop("cells"))
    # the bad files are few and narrow, and found by sums that combine before the shuffle
    again = typed.where("line_number is not null").groupBy(*group, "line_number").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("line")).where("n > 1")
    twice = again.select(file, "line", F.concat(F.lit("line_number: given twice: "), F.col("line_number").cast("string")).alias("message"))
    wrong = typed.select(file, "line", F.explode("problems").alias("message")).unionByName(twice)
    good = typed.join(wrong.select(file).distinct(), file, "left_anti").drop("problems")
    first = [F.min_by(c, "line").alias(c) for c in ("doc_date", "counterparty_name", "currency", *(a.name for a in contract.doc))]
    tax = F.col("cgst_amount") + F.col("sgst_amount") + F.col("igst_amount") + F.col("cess_amount")
    documents = good.groupBy(*group).agg(*first, *totals(F.col("taxable_value"), tax), F.min("line").alias("first_line"))
    return documents, good, wrong


def totals(taxable: Column, tax: Column) -> list[Column]:
    """A-02, A-03: sums of a document, and its lines."""
    money = "decimal(18,2)"
    return [F.sum(taxable).cast(money).alias("total_taxable_value"), F.sum(tax).cast(money).alias("total_tax_value"), F.sum(taxable + tax).cast(money).alias("total_value"), F.count(F.lit(1)).alias("row_count")]


def sales(rows: DataFrame, file: str = "path", hold: Hold = same) -> tuple[DataFrame, DataFrame, DataFrame]:
    """P-15 to P-17, U-07's hash: sales headers with ``row_hash``, lines, and what is wrong; a bad file is refused whole.

    ``rows`` come from ``sources.registers.typed`` over the header and line columns together; ``hold`` writes them once for all three.
    """
    rows = hold(rows)
    wrong = sales_problems(rows, file, hold)
    heads, lines = sales_documents(rows.join(wrong.select(file).distinct(), file, "left_anti"), file)
    return heads, lines, wrong


def sales_problems(rows: DataFrame, file: str = "path", hold: Hold = same) -> DataFrame:
    """P-15 to P-17: (file, line, message) of rows that were rejected and of documents whose rows disagree.

    Documents that may be wrong are found first, and held: by sums over numbers, which combine before the
    shuffle and aren't sorted. Their cells alone are compared by column.
    """
    names, group = [c.name for c in SALES_HEADER], [file, "invoice_no"]
    said = {n: F.coalesce(F.col("cells")[n], F.lit("")) for n in names if n != "invoice_no"}
    good = rows.where("reject is null")
    # rows that agree have one digest, in which each cell stands behind its length; its numbers make no strings to sort
    digest = F.sha2(F.concat_ws(hashing.UNIT, *[x for s in said.values() for x in (F.length(s).cast("string"), s)]), 256)
    parts = [F.conv(F.substring("_digest", at, 15), 16, 10).cast("long") for at in (1, 16, 31, 46)]
    unlike = good.select(*group, digest.alias("_digest")).groupBy(*group).agg(*[(F.min(p) != F.max(p)).alias(f"_{i}") for i, p in enumerate(parts)]).where("_0 or _1 or _2 or _3")
    twice = good.where("line_number is not null").groupBy(*group, "line_number").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    found = hold(unlike.select(*group).unionByName(twice.select(*group)).distinct()).select(*[F.col(c).alias(f"_{c}") for c in group])
    doubtful = good.join(found, F.col(file).eqNullSafe(F.col(f"_{file}")) & F.col("invoice_no").eqNullSafe(F.col("_invoice_no")), "left_semi")
    differ = [F.when(F.min(s) != F.max(s), F.lit(f"{n}: rows disagree")) for n, s in said.items()]
    doubles = F.when(F.count_distinct("line_number") < F.count("line_number"), F.lit("line_number: given twice"))
    checked = doubtful.groupBy(*group).agg(F.array_compact(F.array(*differ, doubles)).alias("ms"), F.min("line").alias("line"))
    return rows.where("reject is not null").select(file, "line", F.col("reject.message").alias("message")).unionByName(checked.select(file, "line", F.explode("ms").alias("message")))


def sales_documents(good: DataFrame, file: str = "path") -> tuple[DataFrame, DataFrame]:
    """Headers with U-07's hash, and lines, of rows of which none is wrong."""
    names, group = [c.name for c in SALES_HEADER], [file, "invoice_no"]
    line_hash = hashing.row_hash(*[coerce.cell(F.col("cells")[c.name]) for c in SALES_LINE])
    head_hash = hashing.row_hash(*[coerce.cell(F.col("cells")[n]) for n in names])
    heads = good.withColumns({"_line_hash": line_hash, "_head_hash": head_hash}).groupBy(*group).agg(
        F.min_by(F.struct(*[n for n in names if n != "invoice_no"], F.col("_head_hash").alias("_head")), "line").alias("_first"),
        F.transform(F.sort_array(F.collect_list(F.struct("line_number", "_line_hash"))), lambda x: x["_line_hash"]).alias("_lines"),
        F.count(F.lit(1)).alias("row_count"),
        F.min("line").alias("line"),
    )  # a document's lines: bounded by its file
    heads = heads.select(*group, "_first.*", "_lines", "row_count", "line")
    heads = heads.withColumn("row_hash", hashing.document_hash(F.col("_head"), F.col("_lines"))).withColumn("currency", coerce.currency(F.col("currency"))).drop("_head", "_lines")
    return heads, good.select(file, "invoice_no", *[c.name for c in SALES_LINE])


def outside_vocabulary(rows: DataFrame, table: str) -> DataFrame:
    """P-28, P-29: (line, column_name, value) of cells that a closed vocabulary doesn't hold."""
    tests = [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*v), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"))) for (t, c), v in VOCABULARIES.items() if t == table and c in rows.columns]
    if not tests:
        return rows.select("line", F.lit("").alias("column_name"), F.lit("").alias("value")).limit(0)
    return rows.select("line", F.explode(F.array_compact(F.array(*tests))).alias("x")).select("line", "x.column_name", "x.value")


def broken_checks(rows: DataFrame, *tables: str) -> DataFrame:
    """P-28, C-05: (line, constraint_name, column_name, value) of each rule of the tables that a row breaks.

    A rule counts where the rows have all its columns; one that isn't true for want of a
    value is kept. All rules are tested in one pass over the rows.
    """
    tests = []
    for check in (c for t in tables for c in checks_of(t) if set(c.columns) <= set(rows.columns)):
        said = F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in check.columns])
        value = said if len(check.columns) > 1 else F.col(check.columns[0]).cast("string")
        tests.append(F.when(~F.expr(check.text), F.struct(F.lit(check.name).alias("constraint_name"), F.lit(", ".join(check.columns)).alias("column_name"), value.alias("value"))))
    none = "array<struct<constraint_name:string,column_name:string,value:string>>"
    found = F.array_compact(F.array(*tests)) if tests else F.array().cast(none)
    return rows.select("line", F.explode(found).alias("x")).select("line", "x.*")


def unknown_values(rows: DataFrame, column: str, vocabulary: DataFrame) -> DataFrame:
    """P-29 with the vocabulary as a table (value)."""
    return rows.where(F.col(column).isNotNull()).join(vocabulary.select(F.col("value").alias(column)), column, "left_anti")


CONFLICT, INVALID = "CONFLICT", "INVALID"


def violation(unique: Column, other: Column) -> Column:
    """P-30: CONFLICT for a key that exists, INVALID for any other broken rule."""
    return F.when(unique, CONFLICT).when(other, INVALID)


def header_disagrees(headers: DataFrame, lines: DataFrame, key: str, head_total: str, line_value: str) -> DataFrame:
    """Q-01: documents whose stated total isn't the sum of their lines; both are stored."""
    sums = lines.groupBy(key).agg(F.sum(line_value).cast("decimal(18,2)").alias("line_total"))
    return headers.join(sums, key).where(F.col(head_total).isNotNull() & (F.col(head_total) != F.col("line_total")))


def summary_disagrees(summary: DataFrame, lines: DataFrame) -> DataFrame:
    """Q-02: the stored 2B summary of available credit against the sum of its lines, by path and head."""
    heads = ("igst", "cgst", "sgst", "cess")
    said = summary.where("availability = 'AVAILABLE'").groupBy("path").agg(*[F.sum(h).alias(f"said_{h}") for h in heads])
    summed = lines.groupBy("path").agg(*[F.sum(h).alias(f"line_{h}") for h in heads])
    out = said.join(summed, "path", "full_outer")
    differs = F.lit(False)
    for h in heads:
        differs = differs | (F.coalesce(f"said_{h}", F.lit(0)) != F.coalesce(f"line_{h}", F.lit(0)))
    return out.where(differs)
