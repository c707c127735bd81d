"""The stateful poll against the batch anti-join, on late, repeated and restarted input."""

import datetime as dt

from ledgerline.operators import readers
from ledgerline.sources.store import TenantStore
from ledgerline.streaming import cursor
from tests.test_readers import V, manifest


def test_state_equals_the_anti_join(spark, tmp_path):
    store = TenantStore(spark, str(tmp_path / "s"), "acme")
    ran, seen = str(tmp_path / "ran"), []

    def wake(name="q", versions=V):
        stream = cursor.arrivals(spark, f"{store.path}/manifest", files_per_trigger=1)
        cursor.poll_with_state(stream, ran, versions, lambda batches, _: seen.extend(r.batch_id for r in batches.collect()), str(tmp_path / name)).awaitTermination()

    def pending(versions=V):
        return sorted({r.batch_id for r in readers.pending_batches(store.manifests(), cursor.executions(spark, ran), versions, limit=None).collect()})

    store.publish(manifest(1))
    store.publish(manifest(2, status="SUPERSEDED"))
    assert pending() == ["b1"]
    wake()
    store.publish(manifest(3, ready="2024-04-30 23:30:00"))  # commits late, within the overlap
    assert pending() == ["b3"]
    again = store.manifests().where("batch_id = 'b1'")
    again.write.parquet(f"{store.path}/manifest/again")  # the same batch is offered once more
    wake()
    wake()  # a restart with nothing new
    assert seen == ["b1", "b3"] and pending() == []
    wake("other")  # a query without a checkpoint starts from what ran
    assert seen == ["b1", "b3"]
    other = V | {"corpus_version": "c2"}
    assert pending(other) == ["b1", "b3"]
    wake("third", other)
    assert sorted(seen[2:]) == ["b1", "b3"] and pending(other) == []
    times = {r.ready_at for r in cursor.executions(spark, ran).collect()}
    assert times == {dt.datetime(2024, 5, 1), dt.datetime(2024, 4, 30, 23, 30)}
