"""Every tax query against its SQL."""

import pytest

from ledgerline import document_queries  # noqa: F401  registers its queries
from ledgerline.queries import ORACLES, QUERIES
from tests import oracle

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
#: Queries that find nothing in the smallest tables.
RARE = ("recon_credit",)


@pytest.fixture(scope="module")
def duck():
    return {sf: oracle.connect(sf) for sf in (SF, LARGER)}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    sf = LARGER if name in RARE else SF
    oracle.check(QUERIES[name](spark, sf), duck[sf], ORACLES[name])
