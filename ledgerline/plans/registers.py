"""Declared registers: columns, keys and periods of the 26 flat register tables (U-16).

Column kinds follow from names by one rule; ``!`` marks a required column and
``:kind`` overrides the rule.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

ENVELOPE = ("id", "entity_id", "gstin", "tax_period", "fy", "doc_type_code", "batch_id", "bronze_ingest_id", "row_hash", "valid_from", "valid_to", "recorded_at", "superseded_at")

_MONEY = {"value", "amount", "cgst", "sgst", "igst", "cess", "balance", "tcs", "fee", "charges", "payout", "availed", "reversed", "liability", "advance", "deducted", "mrp", "withheld", "freight", "packing", "insurance", "discount"}


def kind_of(name: str) -> str:
    """The kind that a column's name stands for."""
    words = name.split("_")
    if "date" in words or name == "paid_period":
        return "date"
    if words[0] in ("is", "has") or name in ("rcm_flag", "mrp_applicable", "reverse_charge"):
        return "boolean"
    if words[-1] in ("days", "months") or name == "line_number":
        return "int"
    if "qty" in words or name == "quantity":
        return "qty"
    if name == "unit_price":
        return "price"
    if words[-1] == "rate":
        return "rate"
    return "money" if _MONEY & set(words) else "text"


@dataclass(frozen=True)
class Column:
    name: str
    kind: str
    required: bool = False


def columns(line: str) -> tuple[Column, ...]:
    out = []
    for token in line.split():
        m = re.fullmatch(r"(\w+?)(?::(\w+))?(!?)", token)
        out.append(Column(m[1], m[2] or kind_of(m[1]), bool(m[3])))
    return tuple(out)


@dataclass(frozen=True)
class Register:
    table: str
    types: tuple[str, ...]
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()  # natural key after entity_id and gstin; empty: the content is the key
    period: str = "tax_period"
    valid_from: str | None = None
    extra: dict = field(default_factory=dict, hash=False)

    def __post_init__(self):
        names = [c.name for c in self.columns]
        if len(set(names)) != len(names):
            raise ValueError(f"{self.table}: a column is declared twice")
        if shadow := set(names) & set(ENVELOPE):
            raise ValueError(f"{self.table}: {sorted(shadow)} belong to the envelope")
        if self.period not in ("tax_period", "fy"):
            raise ValueError(f"{self.table}: unknown period {self.period}")
        if lost := set(self.key) - set(names) - {self.period}:
            raise ValueError(f"{self.table}: unknown key columns {sorted(lost)}")
        if self.valid_from and not any(c.name == self.valid_from and c.kind == "date" and c.required for c in self.columns):
            raise ValueError(f"{self.table}: valid_from must be a required date")

    @property
    def natural(self) -> bool:
        return bool(self.key)

    @property
    def key_columns(self) -> tuple[str, ...]:
        return ("entity_id", "gstin", *(self.key or (self.period, "row_hash")))

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)


def _register(table: str, types: str, line: str, key: str = "", period: str = "tax_period", valid_from: str | None = None) -> Register:
    return Register(table, tuple(types.split()), columns(line), tuple(key.split()), period, valid_from)


_HEADS = "gst_rate cgst sgst igst"

#: The tables' columns and keys.
REGISTERS = (
    _register("credit_debit_note_register", "CREDIT_DEBIT_NOTE_REGISTER", f"note_type! note_no! note_date! original_invoice_no! customer_gstin supply_type reason_code reason_text adjusted_taxable_value! {_HEADS} cess note_value", "note_no", valid_from="note_date"),
    _register("purchase_register", "PURCHASE_REGISTER", f"supplier_gstin invoice_no! invoice_date! hsn_sac taxable_value! {_HEADS} cess gl_code! cost_centre! itc_eligibility rcm_flag", "supplier_gstin invoice_no", valid_from="invoice_date"),
    _register("advance_receipt_register", "ADVANCE_RECEIPT_REGISTER", "receipt_no receipt_date! amount! customer customer_gstin supply_type gst_rate gst_paid_on_advance invoice_linkage is_adjusted", valid_from="receipt_date"),
    _register("unbilled_revenue_schedule", "UNBILLED_REVENUE_SCHEDULE", "item_id description contract_ref customer customer_gstin amount! date_of_service_completion"),
    _register("job_work_dispatch_register", "JOBWORK_DISPATCH_REGISTER", "challan_no date_of_goods_dispatch_to_job_worker! description hsn qty uom taxable_value job_worker_gstin expected_return_date", valid_from="date_of_goods_dispatch_to_job_worker"),
    _register("running_account_contract_register", "CONTINUOUS_SUPPLY_CONTRACT_REGISTER", "contract_ref! customer customer_gstin billing_frequency statement_date delivery_date amount", "contract_ref"),
    _register("audited_pl_account", "AUDITED_PROFIT_AND_LOSS", "gl_code gl_account! narration account_type amount! dr_cr gst_treatment", period="fy"),
    _register("trial_balance", "TRIAL_BALANCE", "gl_code! account_description! opening_balance closing_balance dr_cr gst_treatment", "gl_code", "fy"),
    _register("balance_sheet", "BALANCE_SHEET", "line_item! gl_code category amount!", "line_item", "fy"),
    _register("fixed_asset_register", "FIXED_ASSET_REGISTER", "asset_id! description hsn purchase_date purchase_value itc_availed useful_life_months date_of_disposal disposal_value disposal_type", "asset_id"),
    _register("creditor_ageing_report", "CREDITOR_AGEING_REPORT", "supplier_gstin supplier_name invoice_no! invoice_date! outstanding_amount! ageing_days ageing_bucket as_at_date!", "as_at_date supplier_gstin invoice_no", valid_from="as_at_date"),
    _register("payment_register", "SUPPLIER_PAYMENT_REGISTER", "payment_date! amount! supplier_gstin supplier_name invoice_no payment_ref payment_mode", valid_from="payment_date"),
    _register("bank_statement_outward", "BANK_STATEMENT_OUTWARD", "txn_date! amount! beneficiary beneficiary_account narration bank_ref invoice_ref", valid_from="txn_date"),
    _register("bank_statement_inward_forex", "BANK_STATEMENT_INWARD_FX", "txn_date! amount_fcy! currency! amount_inr remitter ad_bank_ref export_invoice_ref firc_no", valid_from="txn_date"),
    _register("stock_inventory_register", "STOCK_REGISTER", "sku! description hsn opening_qty closing_qty write_off_qty write_off_value", "tax_period sku"),
    _register("product_sku_master", "SKU_MASTER", "sku! description hsn mrp_applicable declared_mrp", "sku"),
    _register("inter_gstin_transaction_register", "INTER_GSTIN_TRANSACTION_REGISTER", f"from_gstin! to_gstin! txn_type txn_date! invoice_no description hsn_sac taxable_value! {_HEADS}", valid_from="txn_date"),
    _register("cost_allocation_register", "COST_ALLOCATION_REGISTER", "from_gstin to_gstin allocation_basis description amount! has_invoice invoice_no"),
    _register("platform_settlement_report", "AMAZON_MTR FLIPKART_GTR MARKETPLACE_SETTLEMENT_SSR MARKETPLACE_DISBURSEMENT_DRR MARKETPLACE_RETURNS_VRET FOOD_DELIVERY_PARTNER_REPORT OTHER_MARKETPLACE_SETTLEMENT", f"report_type! operator! order_no order_date invoice_no invoice_date buyer_state taxable_value {_HEADS} tcs marketplace_fee shipping_charges net_payout"),
    _register("itc_reversal_register", "ITC_REVERSAL_REGISTER", "reversal_type! reversal_basis cgst_reversed sgst_reversed igst_reversed cess_reversed remarks"),
    _register("rcm_register", "RCM_REGISTER", "rcm_category! supplier_gstin supplier_name invoice_no invoice_date taxable_value! gst_rate rcm_liability cgst sgst igst paid_period is_paid"),
    _register("foreign_currency_payment_register", "FOREIGN_CURRENCY_PAYMENT_REGISTER", "payment_date! amount_fcy! currency! amount_inr vendor country purpose invoice_contract_ref", valid_from="payment_date"),
    _register("common_input_service_invoice", "HO_COMMON_INPUT_SERVICE_INVOICE", f"invoice_no! invoice_date! supplier_gstin service_category taxable_value! {_HEADS}", "supplier_gstin invoice_no", valid_from="invoice_date"),
    _register("payroll_tds_register", "PAYROLL_TDS_REGISTER", "ref_no! person_name! role_title classification! tds_section! gross_amount! tds_deducted!", "tax_period ref_no"),
    _register("firc_brc_register", "FIRC_BRC_REGISTER", "export_invoice_no! invoice_date! amount_foreign:text! ad_bank! firc_no realisation_status!", "tax_period export_invoice_no", valid_from="invoice_date"),
    _register("form_15ca_15cb", "FORM_15CA_15CB", "form_15ca_ack_no! remittee_name! remittance_amount_inr nature_of_remittance form_15cb_cert_no classification tax_withheld_inr", "tax_period form_15ca_ack_no"),
)
BY_TABLE = {r.table: r for r in REGISTERS}
BY_TYPE = {t: r for r in REGISTERS for t in r.types}

#: The sales register's layout: header cells repeat on each line.
SALES_HEADER = columns(
    "invoice_no! invoice_date! customer_gstin invoice_type! supply_type place_of_supply reverse_charge currency trade_discount freight packing insurance "
    "invoice_taxable_value invoice_cgst invoice_sgst invoice_igst invoice_cess invoice_total_value irn ewb_no"
)
SALES_LINE = columns("line_number! hsn_sac description qty uom unit_price taxable_value! gst_rate cgst sgst igst cess total_value")

#: P-28: fixed values: closed vocabularies by table and column.
VOCABULARIES = {
    ("credit_debit_note_register", "note_type"): ("CN", "DN"),
    ("advance_receipt_register", "supply_type"): ("GOODS", "SERVICE"),
    ("purchase_register", "itc_eligibility"): ("ELIGIBLE", "INELIGIBLE", "BLOCKED", "PARTIAL"),
    ("audited_pl_account", "account_type"): ("REVENUE", "EXPENSE", "OTHER"),
    ("audited_pl_account", "dr_cr"): ("DR", "CR"),
    ("trial_balance", "dr_cr"): ("DR", "CR"),
    ("balance_sheet", "category"): ("ADVANCE_FROM_CUSTOMER", "UNBILLED_REVENUE", "DEFERRED_REVENUE", "CREDITOR", "CAPITAL_GOODS", "OTHER"),
    ("fixed_asset_register", "disposal_type"): ("SALE", "SCRAP", "TRANSFER", "WRITE_OFF", "OTHER"),
    ("inter_gstin_transaction_register", "txn_type"): ("STOCK_TRANSFER", "CROSS_CHARGE", "CAPITAL_GOOD_TRANSFER", "OTHER"),
    ("platform_settlement_report", "report_type"): ("MTR", "GTR", "SSR", "DRR", "VRET", "FDP", "OTHER"),
    ("itc_reversal_register", "reversal_type"): ("RULE_42", "RULE_43", "SEC_17_5", "OTHER"),
    ("common_input_service_invoice", "service_category"): ("RENT", "IT", "INSURANCE", "AUDIT", "OTHER"),
    ("sales_register", "invoice_type"): ("B2B", "B2CL", "B2CS", "EXP", "SEZWP", "SEZWOP", "DE"),
    ("sales_register", "supply_type"): ("GOODS", "SERVICE", "COMPOSITE", "MIXED"),
}
