"""Content hashes and deterministic ids (U-01, A-11, P-26)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = "\x1f"


def row_hash(*cells: Column | str) -> Column:
    """SHA-256 over trimmed text cells in order; null counts as empty, so a null never shifts its neighbours."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cells]
    return F.sha2(F.concat_ws(UNIT, *parts), 256)


def document_hash(header: Column, lines: Column) -> Column:
    """SHA-256 over the header's hash and the array of line hashes in line order."""
    return F.sha2(F.concat_ws(UNIT, header, F.array_join(lines, UNIT)), 256)


def surrogate(name: str, *key: Column | str) -> Column:
    """A uuid that depends on the key alone: the same after any retry or repartitioning."""
    h = F.md5(F.concat_ws(":", F.lit(name), *[F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in key]).cast("binary"))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
