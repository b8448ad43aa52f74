"""Snapshots: renames, added columns, absent and rewritten ones, two writers; pins of files that change."""

import glob

import pytest

from broadloom.session import scratch
from broadloom.sources import scans, snapshots
from broadloom.sources.snapshots import SnapshotTable


def test_snapshots_keep_their_names_and_rows(spark):
    t = SnapshotTable(spark, scratch(spark))
    assert t.snapshot() is None
    with pytest.raises(ValueError, match="no snapshot"):
        t.read()
    t.commit(spark.createDataFrame([(1, "a"), (2, "b")], "k long, old string"))
    t.commit(None, {"old": "new"})
    t.commit(spark.createDataFrame([(3, 0.5)], "k long, old double"))  # a name that is free again is another field
    assert sorted(t.read(1).collect()) == [(1, "a"), (2, "b")] and t.read(1).columns == ["k", "old"]
    assert sorted(t.read(2).collect()) == [(1, "a"), (2, "b")] and t.read(2).columns == ["k", "new"]
    assert sorted(map(tuple, t.read(3, ["k", "new", "old"]).collect())) == [(1, "a", None), (2, "b", None), (3, None, 0.5)]
    assert len({t.snapshot(n).fingerprint for n in (1, 2, 3)}) == 3
    with pytest.raises(ValueError, match="no snapshot 9"):
        t.read(9)
    with pytest.raises(ValueError, match="no columns"):
        t.read(1, ["new"])
    with pytest.raises(ValueError, match="another type"):
        t.commit(spark.createDataFrame([("x",)], "k string"))
    with pytest.raises(ValueError, match="rename"):
        t.commit(None, {"gone": "x"})


def test_rewritten_files_are_refused(spark):
    path = scratch(spark)
    t = SnapshotTable(spark, path)
    t.commit(spark.range(5).coalesce(1))
    t.commit(spark.range(5, 9).coalesce(1))
    (file,) = glob.glob(f"{t.snapshot().folders[1].removeprefix('file://')}/*.parquet")
    spark.range(100, 200).coalesce(1).write.mode("overwrite").parquet(f"{path}/other")
    (other,) = glob.glob(f"{path.removeprefix('file://')}/other/*.parquet")
    assert t.read(2).count() == 9
    with open(other, "rb") as a, open(file, "wb") as b:
        b.write(a.read())
    assert t.read(1).count() == 5
    with pytest.raises(ValueError, match="rewritten"):
        t.read(2)


def test_of_two_writers_one_wins(spark, monkeypatch):
    t = SnapshotTable(spark, scratch(spark))
    t.commit(spark.range(2))
    real = snapshots.create_once

    def slow(session, path, text):  # another writer commits between this one's files and its marker
        monkeypatch.setattr(snapshots, "create_once", real)
        SnapshotTable(spark, t.path).commit(spark.range(10, 12))
        return real(session, path, text)

    monkeypatch.setattr(snapshots, "create_once", slow)
    with pytest.raises(ValueError, match="another writer"):
        t.commit(spark.range(20, 22))
    assert sorted(r.id for r in t.read().collect()) == [0, 1, 10, 11]


def test_pins_refuse_rewritten_files(spark):
    path = scratch(spark)
    spark.range(5).coalesce(1).write.parquet(path)
    pin = scans.PinnedTable.of(spark.read.parquet(path))
    assert pin.read(spark).count() == 5
    (file,) = glob.glob(f"{path.removeprefix('file://')}/*.parquet")
    with open(file, "ab") as f:
        f.write(b"x")
    with pytest.raises(ValueError, match="not what they were"):
        pin.read(spark)


def test_of_two_publishers_one_wins_and_staged_rows_are_not_seen(spark, monkeypatch):
    from broadloom.plans import audit as A

    path = scratch(spark)
    mine, other = (spark.createDataFrame([("x", n), ("y", n)], "column_name string, row_count long") for n in (1, 2))
    real = A.create_once

    def slow(session, marker, text):
        monkeypatch.setattr(A, "create_once", real)
        assert A.publish(spark, other, path, "a", True) == 3
        return real(session, marker, text)

    monkeypatch.setattr(A, "create_once", slow)
    with pytest.raises(ValueError, match="another payload"):
        A.publish(spark, mine, path, "a", True)
    assert A.publish(spark, other, path, "a", True) == 0

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(A, "create_once", crash)  # between the rows and the marker
    with pytest.raises(RuntimeError):
        A.publish(spark, mine, path, "b", True)
    assert {(r.audit_id, r.record_kind) for r in A.published(spark, path).collect()} == {("a", "field"), ("a", "complete")} and A.published(spark, path).count() == 3
    monkeypatch.setattr(A, "create_once", real)
    assert A.publish(spark, mine, path, "b", True) == 3
    assert {r.audit_id for r in A.latest_observations(spark, path).collect()} == {"b"}
