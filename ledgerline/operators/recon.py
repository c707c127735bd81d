"""Reconciliation checks over portal and register rows (R-01 to R-19).

Each check takes DataFrames with the portal files' column names and returns the
findings with a ``check`` column. Joins are equi-joins on party, invoice or
period with the inequality as a residual, so they shuffle by key and nothing
else; monthly checks sum first and join the sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions import coerce

#: As many steps of thresholds are broadcast at most.
STEPS = 10_000


def _found(rows: DataFrame, check: str) -> DataFrame:
    return rows.withColumn("check", F.lit(check))


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


def amended_after_credit(amendments: DataFrame, claims: DataFrame) -> DataFrame:
    """R-01: credit was taken on an invoice that its supplier amended in a later period."""
    key = ["recipient_gstin", "supplier_gstin", "original_invoice_no"]
    later = amendments.where(_money("itc_delta") != 0)
    return _found(later.join(claims.select(*key).distinct(), key, "left_semi"), "R-01")


def cancelled_party(invoices: DataFrame, parties: DataFrame, party: str, check: str) -> DataFrame:
    """R-02, R-03: invoices of a party dated on or after its registration was cancelled."""
    gone = parties.where(F.col("cancellation_date").isNotNull()).select(F.col("gstin").alias(party), coerce.any_date(F.col("cancellation_date").cast("string")).alias("cancelled_on"))
    return _found(invoices.join(gone, party).where(F.col("invoice_date") >= F.col("cancelled_on")), check)


def unfiled_manifest(bills: DataFrame, manifests: DataFrame) -> DataFrame:
    """R-04: shipping bills without a filed export manifest."""
    filed = manifests.where(F.upper("egm_status") == "FILED").select("shipping_bill_no")
    return _found(bills.join(filed, "shipping_bill_no", "left_anti"), "R-04")


def value_variance(bills: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """R-05: the value in the return differs from the shipping bill's by more than the tolerance."""
    fob, stated = _money("fob_value_inr"), _money("gstr1_table6a_value")
    return _found(bills.where(F.abs(fob - stated) > fob * tolerance), "R-05")


def unrealised(bills: DataFrame, realisations: DataFrame, today: Column, months: int = 12) -> DataFrame:
    """R-06: exports older than the limit without a realisation certificate."""
    done = realisations.where(F.upper("realisation_status").isin("REALISED", "REALIZED")).select("shipping_bill_no")
    old = F.add_months(coerce.any_date(F.col("shipping_bill_date").cast("string")), months) < today
    return _found(bills.where(old).join(done, "shipping_bill_no", "left_anti"), "R-06")


def export_without_bill(returns: DataFrame) -> DataFrame:
    """R-07: an export in the return that names no shipping bill."""
    return _found(returns.where(coerce.cell("shipping_bill_no").isNull()), "R-07")


def understated_liability(outward: DataFrame, summaries: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """R-08: the monthly return states less than the invoices; either side may be missing."""
    said = outward.groupBy("gstin", "tax_period").agg(F.sum(_money("taxable_value")).alias("stated"))
    paid = summaries.groupBy("gstin", "tax_period").agg(F.sum(_money("t31a_taxable_value")).alias("declared"))
    both = said.join(paid, ["gstin", "tax_period"], "full_outer")
    short = F.coalesce("stated", F.lit(0)) - F.coalesce("declared", F.lit(0))
    return _found(both.withColumn("short", short.cast("decimal(18,2)")).where(F.col("short") > tolerance), "R-08")


def credit_against_statement(claimed: DataFrame, statement: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """R-09, R-10: monthly credit short of or over what the statement offers."""
    took = claimed.groupBy("gstin", "tax_period").agg(F.sum(_money("itc")).alias("claimed"))
    offered = statement.groupBy("gstin", "tax_period").agg(F.sum(_money("itc")).alias("offered"))
    both = took.join(offered, ["gstin", "tax_period"], "full_outer")
    gap = (F.coalesce("claimed", F.lit(0)) - F.coalesce("offered", F.lit(0))).cast("decimal(18,2)")
    return both.withColumn("gap", gap).where(F.abs("gap") > tolerance).withColumn("check", F.when(F.col("gap") < 0, "R-09").otherwise("R-10"))


def late_filings(filings: DataFrame) -> DataFrame:
    """R-11."""
    day = lambda c: coerce.any_date(F.col(c).cast("string"))
    late = F.datediff(day("filing_date"), day("due_date"))
    return _found(filings.withColumn("days_late", late).where("days_late > 0"), "R-11")


def credit_before_registration(credits: DataFrame, registrations: DataFrame) -> DataFrame:
    """R-12: distributed credit dated before its receiver was registered."""
    since = registrations.select("gstin", coerce.any_date(F.col("effective_date_of_registration").cast("string")).alias("since"))
    return _found(credits.join(since, "gstin").where(F.col("credit_date") < F.col("since")), "R-12")


def collected_base_differs(collected: DataFrame, sales: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """R-13: a marketplace's base for tax collected differs from the turnover declared through it."""
    key = ["gstin", "operator", "tax_period"]
    a = collected.groupBy(*key).agg(F.sum(_money("net_value")).alias("collected_base"))
    b = sales.groupBy(*key).agg(F.sum(_money("taxable_value")).alias("declared"))
    both = a.join(b, key, "full_outer")
    return _found(both.where(F.abs(F.coalesce("collected_base", F.lit(0)) - F.coalesce("declared", F.lit(0))) > tolerance), "R-13")


def slow_refunds(refunds: DataFrame, days: int = 60) -> DataFrame:
    """R-14: refunds that wait longer than the limit; withdrawn or paid ones don't count."""
    waiting = ~F.coalesce(F.upper("status").isin("SANCTIONED", "PAID", "WITHDRAWN", "REJECTED"), F.lit(False))
    return _found(refunds.where(waiting & (F.col("days_pending").try_cast("int") > days)), "R-14")


def above_threshold_without(invoices: DataFrame, references: DataFrame, thresholds: DataFrame, check: str) -> DataFrame:
    """R-15, R-16: invoices over the threshold of their day without a reference number.

    thresholds: scope, effective_from, threshold; invoices: scope, invoice_no, invoice_date, value.
    """
    key = Window.partitionBy("scope").orderBy("effective_from")
    steps = thresholds.select("scope", F.col("effective_from").alias("_from"), F.lead("effective_from").over(key).alias("_until"), "threshold")
    # the steps of a published threshold are a handful; past the bound Spark joins by scope
    few = steps.limit(STEPS + 1).count() <= STEPS
    since = (F.col("invoice_date") >= F.col("_from")) & (F.col("_until").isNull() | (F.col("invoice_date") < F.col("_until")))
    judged = invoices.join(F.broadcast(steps) if few else steps, "scope").where(since).drop("_from", "_until")
    over = judged.where(F.col("value") >= F.col("threshold"))
    return _found(over.join(references.select("invoice_no"), "invoice_no", "left_anti"), check)


def import_tax_missing(entries: DataFrame, statement: DataFrame) -> DataFrame:
    """R-17: import tax paid that the statement's import section lacks."""
    seen = statement.where("section = 'IMPG'").select(F.col("doc_number").alias("be_no"))
    return _found(entries.where(_money("igst_paid") > 0).join(seen, "be_no", "left_anti"), "R-17")


def branch_without_gstin(codes: DataFrame) -> DataFrame:
    """R-18: branches of an importer code without a GSTIN. codes: iec, branches array<struct<branch_sl_no, gstin>>."""
    return _found(codes.select("iec", F.explode("branches").alias("b")).select("iec", "b.*").where(coerce.cell("gstin").isNull()), "R-18")


def expired_obligation(licences: DataFrame, today: Column) -> DataFrame:
    """R-19: export obligations past their day with a shortfall."""
    short = (_money("export_obligation_inr") - _money("eo_fulfilled_inr")).cast("decimal(18,2)")
    due = coerce.any_date(F.col("eo_due_date").cast("string"))
    return _found(licences.withColumn("shortfall", short).where((due < today) & (F.col("shortfall") > 0)), "R-19")


def open_demands(notices: DataFrame, stays: DataFrame, settled: DataFrame) -> DataFrame:
    """Demands to act on: those stayed by a court or settled aren't findings."""
    return notices.join(stays.select(F.col("demand_reference").alias("notice_no")), "notice_no", "left_anti").join(settled.select("notice_no"), "notice_no", "left_anti")
