"""Facts in document text: label lines (X-01 to X-03) and repeating rows (X-04).

Label look-ups are regular expressions over the text column, so they stay in
the JVM. Rows that wrap over several lines need a scan of the lines in order;
that is the one place for a Python function, run on Arrow batches.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

LEAST_TEXT, WINDOW = 20, 8
MONEY = r"[\d,]+(?:\.\d+)?"
GSTIN = r"[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][1-9A-Z]Z[0-9A-Z]"
DATES = ((r"\d{1,2}\s+[A-Za-z]+\s+\d{4}", ("d MMMM yyyy", "d MMM yyyy")), (r"\d{1,2}-[A-Za-z]{3}-\d{4}", ("d-MMM-yyyy",)), (r"\d{4}-\d{2}-\d{2}", ("yyyy-MM-dd",)))


def quoted(text: str) -> str:
    """A label as a pattern that means itself."""
    return re.sub(r"([^\w\s])", r"\\\1", text)


def _first(c: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def page_text(pages: Column) -> Column:
    return F.array_join(pages, "\n")


def has_text(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"^\s+|\s+$", "")) >= LEAST_TEXT


def raw_value(text: Column, label: str, kind: str) -> Column:
    """What stands after ``Label:`` on the first such line; for money and dates also after a label without a colon."""
    name = quoted(label)
    found = F.trim(_first(text, rf"(?im)^[ \t]*{name}[ \t]*:[ \t]*(.*)$", 1))
    if kind == "money":
        return F.coalesce(found, _first(text, rf"(?im)^[ \t]*{name}\b.*?({MONEY})[ \t]*$", 1))
    if kind == "date":
        row = rf"(?im)^[ \t]*{name}\b[^\n]*?(?:\n)?[^\n]*?(\d{{1,2}}\s*-\s*[A-Za-z]{{3}}\s*-\s*\d{{4}}|\d{{1,2}}\s+[A-Za-z]+\s+\d{{4}})"
        return F.coalesce(found, F.regexp_replace(_first(text, row, 1), r"\s*-\s*", "-"))
    return found


def written_date(c: Column) -> Column:
    """The first date in the text, in any of the written forms."""
    tries = [F.try_to_date(F.regexp_replace(_first(c, p), r"\s+", " "), f) for p, formats in DATES for f in formats]
    return F.coalesce(*tries)


def coerced(kind: str, raw: Column) -> Column:
    """X-03, as text: dates are ISO, a range is 'from/to'."""
    halves = F.split(raw, r"(?i)\bto\b", 2)
    return {
        "text": lambda: F.trim(raw),
        "date": lambda: written_date(raw).cast("string"),
        "date_range": lambda: F.when(F.size(halves) == 2, F.concat(written_date(halves[0]).cast("string"), F.lit("/"), written_date(halves[1]).cast("string"))),
        "money": lambda: F.regexp_replace(_first(raw, MONEY), ",", ""),
        "int": lambda: _first(raw, r"\d+"),
        "gstin": lambda: _first(F.upper(F.replace(raw, F.lit(" "), F.lit(""))), GSTIN),
        "hsn": lambda: _first(raw, r"\d{4,10}"),
    }[kind]()


def label_outcome(docs: DataFrame, fields: list[tuple[str, str, bool, str]], pages: str = "pages") -> DataFrame:
    """Adds outcome (EXTRACTED, PARTIAL, NO_TEXT_LAYER), missing, failed and facts (map) for (name, kind, required, label) fields."""
    once = lambda rows, name, value: rows.withColumn(name, F.explode(F.array(value)))  # noqa: E731  explode: what is read of it is not computed again
    out = once(docs, "_text", page_text(F.col(pages)))
    raw, value = (lambda n: F.col("_raw")[n]), (lambda n: F.col("_value")[n])
    if fields:
        out = once(out, "_raw", F.struct(*[raw_value(F.col("_text"), label, kind).alias(name) for name, kind, _, label in fields]))
        out = once(out, "_value", F.struct(*[coerced(kind, raw(name)).alias(name) for name, kind, _, _ in fields]))
    entries = [F.struct(F.lit(name).alias("key"), value(name).alias("value")) for name, *_ in fields]
    needed = [name for name, _, required, _ in fields if required]
    missing = [F.when(raw(n).isNull(), F.lit(n)) for n in needed]
    failed = [F.when(raw(n).isNotNull() & value(n).isNull(), F.lit(n)) for n in needed]
    none = F.array().cast("array<string>")
    some = lambda xs: F.array_compact(F.array(*xs)) if xs else none
    facts = F.map_from_entries(F.filter(F.array(*entries), lambda e: e.value.isNotNull())) if entries else F.create_map().cast("map<string,string>")
    out = out.withColumns({"missing": some(missing), "failed": some(failed), "facts": facts})
    none_found = (F.size("missing") == 0) & (F.size("failed") == 0)
    out = out.withColumn("outcome", F.when(~F.coalesce(has_text(F.col("_text")), F.lit(False)), "NO_TEXT_LAYER").when(none_found, "EXTRACTED").otherwise("PARTIAL")).drop("_text", "_raw", "_value")
    silent = F.col("outcome") == "NO_TEXT_LAYER"
    return out.withColumns({"missing": F.when(silent, none).otherwise(F.col("missing")), "failed": F.when(silent, none).otherwise(F.col("failed"))})


_STRPTIME = ("%d %B %Y", "%d-%b-%Y", "%Y-%m-%d")
#: Kinds that are what a pattern finds in the cell.
_FOUND = {"money": MONEY, "int": r"\d+", "gstin": GSTIN, "hsn": r"\d{4,10}"}


def _written_date(raw: str) -> dt.date | None:
    for (pattern, _), form in zip(DATES, _STRPTIME, strict=True):
        for shown in re.findall(pattern, raw)[:1]:
            try:
                return dt.datetime.strptime(shown, form).date()
            except ValueError:
                pass
    return None


def _reader(kind: str) -> Callable[[str], str | None]:
    """X-03 for the cells of a column: text, or null where a cell doesn't coerce."""
    if kind == "text":
        return str.strip
    if kind == "date":
        return lambda raw: (day := _written_date(raw)) and day.isoformat()
    find, tidy = re.compile(_FOUND[kind]).search, (lambda raw: raw.replace(" ", "").upper()) if kind == "gstin" else str
    return lambda raw: (m := find(tidy(raw))) and m[0].replace(",", "")


class RowForm:
    """A table's row: its pattern, and how its named groups become cells.

    The lines of a document are one string with a space between any two. A row may start
    at any line and covers up to WINDOW lines. A partial match tells whether a line can begin
    a row at all: most can't and are left at their first look; the others' windows grow.
    """

    def __init__(self, pattern: str, columns: Iterable[tuple[str, str]]):
        self.names = [name for name, _ in columns]
        self.readers = [_reader(kind) for _, kind in columns]
        self.begins, self.match = regex.compile(pattern).fullmatch, re.compile(pattern).fullmatch

    def cells(self, match: re.Match) -> list[str] | None:
        values = [read(raw) for read, raw in zip(self.readers, match.group(*self.names) if len(self.names) > 1 else [match.group(*self.names)], strict=True)]
        return None if None in values else values

    def taken(self, flat: str, start: int, ends: list[int]) -> tuple[int, list[str]] | None:
        """The least number of lines from ``start`` on that are a row whose cells coerce, and the cells."""
        if not self.begins(flat[start : ends[0]], partial=True):
            return None
        for n, end in enumerate(ends, 1):
            if (match := self.match(flat[start:end])) and (values := self.cells(match)) is not None:
                return n, values
        return None

    def rows(self, pages: Iterable[str] | None) -> Iterator[list[str]]:
        lines = [line for page in pages or () for raw in (page or "").splitlines() if (line := raw.strip())]
        flat, ends = " ".join(lines), list(accumulate((len(x) + 1 for x in lines), initial=-1))
        at = 0
        while at < len(lines):
            found = self.taken(flat, ends[at] + 1, ends[at + 1 : at + 1 + WINDOW])
            if found:
                yield found[1]
            at += found[0] if found else 1


def table_rows(docs: DataFrame, pattern: str, columns: list[tuple[str, str]], pages: str = "pages") -> DataFrame:
    """X-04: adds ``rows``, array<map<string,string>>, the table's rows in order; at each line the shortest window of lines that is a row."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        form = RowForm(pattern, columns)
        for batch in batches:
            yield pa.array([[list(zip(form.names, row, strict=True)) for row in form.rows(p)] for p in batch.to_pylist()], pa.list_(pa.map_(pa.string(), pa.string())))

    return docs.withColumn("rows", F.arrow_udf(run, "array<map<string,string>>")(F.col(pages)))


#: Kinds of a SQL table function's columns, and their values from a cell's text.
_TYPED = {"text": (StringType(), str), "gstin": (StringType(), str), "hsn": (StringType(), str), "int": (LongType(), int), "money": (DecimalType(18, 2), Decimal), "date": (DateType(), dt.date.fromisoformat)}


class DocumentRows:
    """X-04 as a table function of SQL: a table's rows with typed columns, and ``place``, their number in the document.

    ``SELECT * FROM docs, LATERAL document_rows(pages, '<pattern>', 'holder text, shares money')``;
    pattern and columns are constants, and the columns give the result its schema. Null pages have no
    rows; a number that its type can't hold makes its cell null.
    """

    def __init__(self):
        self.form = None

    @staticmethod
    def columns(text: str) -> list[tuple[str, str]]:
        out = [tuple(c.split()) for c in text.split(",")]
        if bad := [c for c in out if len(c) != 2 or c[1] not in _TYPED]:
            raise ValueError(f"not a name and a kind of {sorted(_TYPED)}: {bad}")
        return out

    @staticmethod
    def analyze(pages: AnalyzeArgument, pattern: AnalyzeArgument, columns: AnalyzeArgument) -> AnalyzeResult:
        if not (pattern.isConstantExpression and columns.isConstantExpression):
            raise ValueError("pattern and columns must be constants")
        declared = DocumentRows.columns(columns.value)
        if lost := {name for name, _ in declared} - regex.compile(pattern.value).groupindex.keys():
            raise ValueError(f"columns without a group in the pattern: {sorted(lost)}")
        typed = [StructField(name, _TYPED[kind][0]) for name, kind in declared]
        return AnalyzeResult(StructType([StructField("place", IntegerType()), *typed]))

    def eval(self, pages, pattern, columns):
        if self.form is None:
            declared = self.columns(columns)
            self.form, self.types = RowForm(pattern, declared), [_TYPED[kind][1] for _, kind in declared]
        for at, row in enumerate(self.form.rows(pages), 1):
            yield at, *[_held(of, value) for of, value in zip(self.types, row, strict=True)]


def _held(of: Callable, value: str):
    out = of(value)
    if of is Decimal:
        out = round(out, 2)
        return out if abs(out) < 10**16 else None
    return None if of is int and abs(out) >= 1 << 63 else out


def register(spark: SparkSession) -> None:
    """Makes ``document_rows`` known to the session's SQL."""
    spark.udtf.register("document_rows", F.udtf(DocumentRows, useArrow=False))


def payroll_rows(docs: DataFrame, pages: str = "pages", place: str | None = None) -> DataFrame:
    """X-05: payroll register rows, each from its EMP or CONS number to the next; the note at the end is cut. ``place`` names a column for a row's place in its document."""
    body = F.split(page_text(F.col(pages)), "Note:", 2)[0]
    chunks = docs.select("*", F.posexplode(F.split(body, r"(?=\b(?:EMP|CONS)\d{4}\b)")).alias("_at", "_chunk")).where(F.col("_chunk").rlike(r"^(EMP|CONS)\d{4}"))
    ref = F.regexp_extract("_chunk", r"^(?:EMP|CONS)\d{4}", 0)
    rest = F.trim(F.regexp_replace(F.substr("_chunk", F.length(ref) + 1), r"\s+", " "))
    trail = r"\b(\d{3}[A-Z]?)\s+([\d,]+)\s+([\d,]+)\s*$"
    out = chunks.withColumns({"ref_no": ref, "_rest": rest}).where(F.col("_rest").rlike(trail))
    middle = F.trim(F.regexp_replace("_rest", trail, ""))
    out = out.withColumn("_middle", middle).where(F.col("_middle").rlike(r"\b(Employee|Contractor|Professional)\b"))
    last = r"^(.*)\b(Employee|Contractor|Professional)\b"
    return out.select(
        *docs.columns,
        "ref_no",
        F.trim(F.regexp_extract("_middle", last, 1)).alias("person_name"),
        F.regexp_extract("_middle", last, 2).alias("classification"),
        F.regexp_extract("_rest", trail, 1).alias("tds_section"),
        F.replace(F.regexp_extract("_rest", trail, 2), F.lit(","), F.lit("")).alias("gross_amount"),
        F.replace(F.regexp_extract("_rest", trail, 3), F.lit(","), F.lit("")).alias("tds_deducted"),
        *([F.col("_at").alias(place)] if place else []),
    )


def realisation_rows(docs: DataFrame, banks: list[str], pages: str = "pages", place: str | None = None) -> DataFrame:
    """X-05: inward remittance register rows, each from its export invoice number to the next. ``place`` as in ``payroll_rows``."""
    start = r"INV/EXP/\d{2}-\s*\d{2}/\d{4}"
    body = F.split(page_text(F.col(pages)), "Both bank-issued", 2)[0]
    head = rf"^({start})\s+(\d{{2}}-[A-Za-z]{{3}}-\d{{4}})\s+([A-Z]{{3}})\s*([\d,]+)\s+(.*)$"
    flat = F.trim(F.regexp_replace("_chunk", r"\s+", " "))
    out = docs.select("*", F.posexplode(F.split(body, rf"(?={start})")).alias("_at", "_chunk")).withColumn("_flat", flat).where(F.col("_flat").rlike(head))
    after = F.regexp_extract("_flat", head, 5)
    bank = F.coalesce(*[F.when(F.startswith(after, F.lit(b)), F.lit(b)) for b in banks], F.lit("")) if banks else F.lit("")
    out = out.withColumns({"_bank": bank, "_after": after}).withColumn("_rest", F.trim(F.substr("_after", F.length("_bank") + 1)))
    firc = r"FIRC/\d{4}/[A-Z]{2}/\s*\d+"
    has = F.col("_rest").rlike(firc)
    return out.select(
        *docs.columns,
        F.replace(F.regexp_replace(F.regexp_extract("_flat", head, 1), r"-\s+", "-"), F.lit(" "), F.lit("")).alias("export_invoice_no"),
        F.try_to_date(F.regexp_extract("_flat", head, 2), "dd-MMM-yyyy").cast("string").alias("invoice_date"),
        F.concat_ws(" ", F.regexp_extract("_flat", head, 3), F.regexp_extract("_flat", head, 4)).alias("amount_foreign"),
        F.col("_bank").alias("ad_bank"),
        F.when(has, F.regexp_replace(F.regexp_extract("_rest", firc, 0), r"\s+", "")).otherwise(F.lit("")).alias("firc_no"),
        F.when(has, F.trim(F.regexp_replace("_rest", rf"^.*?{firc}", ""))).otherwise(F.regexp_replace("_rest", r"-\s+", "-")).alias("realisation_status"),
        *([F.col("_at").alias(place)] if place else []),
    )


def remittance_row(facts: Column) -> Column:
    """X-05: the one row of a remittance certificate, from its label facts; the rupee figure is the bracketed one."""
    raw = facts["remittance_amount_raw"]
    text = lambda name: F.coalesce(facts[name], F.lit(""))
    return F.struct(
        facts["form_15ca_ack_no"].alias("form_15ca_ack_no"),
        facts["remittee_name"].alias("remittee_name"),
        F.replace(F.regexp_extract(raw, r"\(\s*([\d,]+)\s*equivalent\)", 1), F.lit(","), F.lit("")).alias("remittance_amount_inr"),
        *[text(n).alias(n) for n in ("nature_of_remittance", "form_15cb_cert_no", "classification")],
        F.lit("").alias("tax_withheld_inr"),
    )
