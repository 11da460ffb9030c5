"""Marts of the registered queries are loaded in steps whose number does not grow with the cluster."""

import pytest

from checks import marts
from eventmart.sources import line_items


@pytest.fixture
def sent(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(marts, "scratch", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(marts, "FILE_ROWS", 100)
    return marts._inbox(spark, sf)


def test_the_stream_loads_one_piece_at_a_time(spark, sf, sent, tmp_path):
    """A piece fills several files, and all of them are one load, in the order of arrival."""
    loads = []

    def note(batch, number):
        loads.append(batch.selectExpr("count(*) AS n", "min(timestamp) AS first", "max(timestamp) AS last").first())

    query = sent.writeStream.foreachBatch(note).option("checkpointLocation", str(tmp_path / "notes")).trigger(availableNow=True).start()
    query.awaitTermination()
    files = [f for f in (tmp_path / "inbox").iterdir() if f.name.startswith("part-")]
    assert len(files) > marts.STREAM_SLICES and len(loads) == marts.STREAM_SLICES
    assert all(a.last < b.first for a, b in zip(loads, loads[1:]))
    assert sum(load.n for load in loads) == line_items.messages(spark, sf, copies=True).count()
