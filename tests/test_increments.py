"""Increments of viewing events: equal to a full rebuild, restartable, and no more read or written than needed."""

import datetime as dt
import random
from pathlib import Path

import pytest

from mediaspark import schemas
from mediaspark.jobs import increments
from mediaspark.jobs import silver as silver_job
from mediaspark.layout import LakeLayout
from mediaspark.operators import increment, silver
from mediaspark.sinks import tables
from mediaspark.sources.tables import read_table
from tests.helpers import collected, frame
from tests.test_silver import event

ZONE = "UTC"


@pytest.fixture()
def lake(tmp_path):
    return LakeLayout(str(tmp_path / "lake"))


def deliver(spark, lake, *rows, source="viewing_events_batch"):
    tables.append(frame(spark, schemas.VIEWING_EVENT, *rows), lake.bronze(source), lake.fmt)


def stored(spark, lake):
    return read_table(spark, lake, "silver", increments.TABLE)


def log(spark, lake):
    found = increments.run(spark, lake, ZONE)
    return sorted((r.source, int(r.batch.split("_")[0]), r.files, r.added, r.removed, r.days) for r in found.collect())


def test_random_deliveries_equal_the_full_rebuild(spark, lake):
    rng = random.Random(7)
    sent = {name: [] for name in increments.SOURCES}
    for go in range(3):
        for name in increments.SOURCES:
            rows = [
                event(rng.choice([None, *(f"e{i}" for i in range(25))]), rng.choice([None, "soon", *(f"2025-01-0{d}T{h:02}:59:59Z" for d in (1, 2, 3) for h in (0, 12, 23))]),
                      user=rng.choice("abc"), kind=rng.choice(["PLAY", "pause"]))
                for _ in range(rng.randrange(1, 30))
            ]
            deliver(spark, lake, *rows, source=name)
            sent[name] += rows
        increments.run(spark, lake, ZONE, max_files=1 + go % 2)
        batch, stream = (frame(spark, schemas.VIEWING_EVENT, *sent[name]) for name in increments.SOURCES)
        whole = silver.events(batch, stream, ZONE).drop("_silver_processed_at")
        assert collected(stored(spark, lake).select(*whole.columns)) == collected(whole)


def test_only_new_files_and_changed_days(spark, lake):
    deliver(spark, lake, event("a", "2025-01-01T10:00:00Z"), event("b", "2025-01-05T10:00:00Z"))
    deliver(spark, lake, event("a", "2025-01-01T10:00:00Z"))
    first = log(spark, lake)
    assert [(b, added, removed, days) for _, b, _, added, removed, days in first] == [(0, 2, 0, 2)]
    kept = {f: f.stat().st_mtime_ns for f in _files(lake, "2025-01-01")}
    deliver(spark, lake, event("b", "2025-01-05T10:00:00Z"))  # known
    deliver(spark, lake, event("b", "2025-01-04T23:00:00Z"), event("c", "2025-01-04T01:00:00Z"))  # earlier, in another day
    assert log(spark, lake)[1:] == [("viewing_events_batch", 1, log(spark, lake)[1][2], 2, 1, 2)]
    assert {f: f.stat().st_mtime_ns for f in _files(lake, "2025-01-01")} == kept  # a day without changes is not written
    assert not _files(lake, "2025-01-05")  # its only row has moved
    assert collected(stored(spark, lake), "event_id", "event_date") == [("a", dt.date(2025, 1, 1)), ("b", dt.date(2025, 1, 4)), ("c", dt.date(2025, 1, 4))]
    again = log(spark, lake)
    assert len(again) == 2
    files = collected(read_table(spark, lake, "silver", increments.LEDGER), "file")
    assert len(files) == len(set(files)) == sum(entry[2] for entry in again)


def _files(lake, day):
    return list(Path(lake.silver(increments.TABLE)).glob(f"event_date={day}/*.parquet"))


def test_look_back_is_as_stated(spark, lake):
    deliver(spark, lake, event("a", "2025-01-05T10:00:00Z"))
    increments.run(spark, lake, ZONE, look_back=1)
    deliver(spark, lake, event("a", "2025-01-06T10:00:00Z"))
    increments.run(spark, lake, ZONE, look_back=1)
    assert stored(spark, lake).count() == 1
    deliver(spark, lake, event("a", "2025-01-07T10:00:00Z"))  # two days away
    increments.run(spark, lake, ZONE, look_back=1)
    assert stored(spark, lake).count() == 2


@pytest.mark.parametrize("broken", ["overwrite_folders", "overwrite"])
def test_a_stopped_increment_is_finished_by_the_next_run(spark, lake, monkeypatch, broken):
    deliver(spark, lake, event("a", "2025-01-01T10:00:00Z"), event("b", "2025-01-02T10:00:00Z"))
    increments.run(spark, lake, ZONE)
    deliver(spark, lake, event("a", "2025-01-01T09:00:00Z"), event("c", "2025-01-02T10:00:00Z"))

    def fail(*_):
        raise OSError("the disk is gone")

    with monkeypatch.context() as patch:
        patch.setattr(increments, broken, fail)
        with pytest.raises(Exception, match="the disk is gone"):
            increments.run(spark, lake, ZONE)
    increments.run(spark, lake, ZONE)
    first = collected(stored(spark, lake).filter("event_id = 'a'").selectExpr("unix_seconds(event_ts) % 86400 DIV 3600"))
    assert first == [(9,)] and collected(stored(spark, lake), "event_id") == [("a",), ("b",), ("c",)]
    assert not list(Path(lake.silver("_staging")).glob("*"))


def test_the_silver_job_counts_what_increments_add(spark, lake):
    from tests.test_jobs import database_frames

    sources = database_frames(spark)
    for name, (df, _) in sources.items():
        tables.overwrite(df, lake.bronze(name), lake.fmt)
    tables.overwrite(frame(spark, schemas.CONTENT_METADATA), lake.bronze("content_metadata"), lake.fmt)
    tables.overwrite(frame(spark, schemas.CAMPAIGNS), lake.bronze("campaigns"), lake.fmt)
    deliver(spark, lake, event("a", "2025-01-01T10:00:00Z"), event("b", "2025-01-02T10:00:00Z"))
    assert dict(collected(silver_job.run(spark, lake, "2024-01-31", ZONE, look_back=2)))["viewing_events"] == 2
    deliver(spark, lake, event("a", "2025-01-01T09:00:00Z"), event("c", "2025-01-02T10:00:00Z"))
    assert dict(collected(silver_job.run(spark, lake, "2024-01-31", ZONE, look_back=2)))["viewing_events"] == 1


def test_days_near_the_ends_of_the_calendar():
    assert increment.near_days([dt.date.min, dt.date(2025, 1, 1)], 1) == [dt.date.min, dt.date(2024, 12, 31), dt.date(2025, 1, 1), dt.date(2025, 1, 2)]


def test_a_first_increment_is_staged_once(spark, lake, monkeypatch):
    staged = []
    real = increments.overwrite_folders

    def noted(df, *rest):
        staged.extend(sorted(p.name for p in Path(lake.silver("_staging")).glob("*/*") if not p.parent.name.endswith("_files")))
        return real(df, *rest)

    monkeypatch.setattr(increments, "overwrite_folders", noted)
    deliver(spark, lake, event("a", "2025-01-01T10:00:00Z"), event("b", "2025-01-02T10:00:00Z"), event("c", "soon"))
    assert [entry[3:] for entry in log(spark, lake)] == [(2, 0, 2)]
    assert staged == ["days"]
    deliver(spark, lake, event("a", "2025-01-01T09:00:00Z"))
    assert log(spark, lake)[1][3:] == (1, 1, 1) and staged == ["days", "changed", "days", "new"]
