"""Which transform loads a document type (D-01)."""

from __future__ import annotations

from ledgerline.plans.contracts import CONTRACTS, EXTRACTIONS
from ledgerline.plans.registers import BY_TYPE

PDF_FED = ("PAYROLL_TDS_REGISTER", "FIRC_BRC_REGISTER", "FORM_15CA_15CB")
#: The banks whose names the remittance register's rows may start with.
AD_BANKS = ("HDFC Bank, Fort Branch", "ICICI Bank, Nariman Point")
RETURNS = {"GSTR_2B": "GSTN_JSON", "GSTR_3B": "GSTN_JSON"}
NEEDED = {
    "SALES_REGISTER": ("entity_id", "gstin", "period_start", "period_end"),
    "REGISTER_LOADER": ("entity_id", "gstin", "period_start", "period_end"),
    "TRANSACTION": ("entity_id",),
    "GSTN_JSON": ("entity_id", "gstin", "period_start"),
    "PDF_EXTRACTION": ("entity_id",),
}


def mechanism(document_type: str) -> str:
    """The mechanism of a type; a type without one is refused."""
    if document_type == "SALES_REGISTER":
        return "SALES_REGISTER"
    if document_type in RETURNS:
        return RETURNS[document_type]
    if document_type in EXTRACTIONS or document_type in PDF_FED:
        return "PDF_EXTRACTION"
    if document_type in BY_TYPE:
        return "REGISTER_LOADER"
    if document_type in CONTRACTS:
        return "TRANSACTION"
    raise LookupError(f"no loader for {document_type}")


def require(document_type: str, **given) -> str:
    """The mechanism, once all that it needs is given."""
    found = mechanism(document_type)
    needed = NEEDED["REGISTER_LOADER" if document_type in PDF_FED else found]
    if lost := [n for n in needed if given.get(n) in (None, "")]:
        raise ValueError(f"{document_type} needs {', '.join(lost)}")
    return found
