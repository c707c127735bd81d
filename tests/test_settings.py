"""Settings in force, against the definition read off row by row."""

import datetime as dt
import random

import pytest

from ledgerline.operators import settings

DAY = dt.date(2024, 1, 1)
ROWS = "setting_id string, entity_id string, gstin string, effective_from date, effective_to date, version int, value int"


def plain(rows, key, entity, gstin, day):
    """The value in force, or None."""
    for level, scope in ((2, (entity, gstin)), (1, (entity, None)), (0, (None, None))):
        if level == 2 and None in scope or level == 1 and entity is None:
            continue
        begun = [r for r in rows if r[0] == key and r[1:3] == scope and r[3] and r[3] <= day and (r[4] is None or r[4] > r[3])]
        if begun:
            last = max(begun, key=lambda r: (r[3], r[5]))
            if last[4] is None or last[4] > day:
                return level, last[6]
    return None


@pytest.mark.parametrize("few", [settings.SCOPES, 0])
def test_as_defined(spark, few, monkeypatch):
    monkeypatch.setattr(settings, "SCOPES", few)
    draw = random.Random(few + 3)
    day = lambda: DAY + dt.timedelta(draw.randrange(60))
    rows = []
    for n in range(150):
        entity = draw.choice([None, "e", "f", ""])
        begin = draw.choice([day(), day(), day(), None])
        rows.append((draw.choice(["a", "b", None]), entity, entity and draw.choice([None, "1", "2"]), begin, draw.choice([None, day()]), n, n))
    rows.append(("a", None, "1", DAY, None, 999, 999))  # a GSTIN without an entity is no scope
    rows.append(("c", "e", None, DAY, DAY, 1, 1))  # an empty window hides nothing
    rows.append(("c", None, None, DAY, None, 1, 7))
    asks = [(i, draw.choice("abcd"), draw.choice(["e", "f", "g", "", None]), draw.choice(["1", "2", "9", None]), draw.choice([day(), day(), day(), None])) for i in range(400)]
    points = spark.createDataFrame([*asks, asks[0]], "id int, setting_id string, entity_id string, gstin string, day date")
    got = sorted((r.id, r.level, r.value) for r in settings.in_force(points, spark.createDataFrame(rows, ROWS), "day", ["value"]).collect())
    want = [(i, *found) for i, k, e, g, d in [*asks, asks[0]] if d and (found := plain(rows, k, e, g, d))]
    assert got == sorted(want) and {level for _, level, _ in want} == {0, 1, 2}


def test_no_rows(spark):
    points = spark.createDataFrame([(1, "a", "e", "1", DAY)], "id int, setting_id string, entity_id string, gstin string, day date")
    assert settings.in_force(points, spark.createDataFrame([], ROWS), "day", ["value"]).count() == 0
    assert settings.in_force(points.limit(0), spark.createDataFrame([("a", None, None, DAY, None, 1, 1)], ROWS), "day", ["value"]).count() == 0
