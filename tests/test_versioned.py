"""The versioned table: kills, conflicts, idempotence, reading and clearing up."""

import threading

import pytest

from ticklake.sources.versioned import VersionedTable

SCHEMA = "symbol long, day long, close double"


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "prices"), ["symbol", "day"], ["symbol"], buckets=4)


def rows(df):
    return sorted(map(tuple, df.select("symbol", "day", "close").collect()))


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_merge_and_history(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.merge(frame(spark, [(1, 1, 1.0), (2, 1, 2.0), (2, 1, 1.5)])) == 1
    assert rows(table.read()) == [(1, 1, 1.0), (2, 1, 2.0)]
    up = frame(spark, [(1, 1, 9.0), (1, 2, 3.0), (3, 1, 4.0)])
    assert table.merge(up) == 2 and table.merge(up) == 3
    assert rows(table.read()) == [(1, 1, 9.0), (1, 2, 3.0), (2, 1, 2.0), (3, 1, 4.0)]
    assert rows(table.read(1)) == [(1, 1, 1.0), (2, 1, 2.0)]
    assert table.merge(frame(spark, [])) == 4 and len(rows(table.read())) == 4
    wider = frame(spark, [(5, 1, 1.0)]).selectExpr("*", "'x' note")
    table.merge(wider)
    assert table.read().filter("note is null").count() == 4 and table.read().filter("note = 'x'").count() == 1
    assert len(table.vacuum(keep=1)) >= 1 and len(rows(table.read())) == 5 and table.versions() == [5]


@pytest.mark.parametrize("point", ["_write", "_commit"])
def test_killed_writer_leaves_the_old_version(spark, table, monkeypatch, point):
    table.merge(frame(spark, [(1, 1, 1.0), (2, 1, 2.0)]))
    before, real = rows(table.read()), getattr(VersionedTable, point)

    def killed(self, *args):
        if point == "_write":
            real(self, *args)                       # the data are all there, the commit is not
        raise KeyboardInterrupt
    monkeypatch.setattr(VersionedTable, point, killed)
    with pytest.raises(KeyboardInterrupt):
        table.merge(frame(spark, [(1, 1, 5.0), (9, 1, 5.0)]))
    monkeypatch.undo()
    assert rows(table.read()) == before and table.versions() == [1]
    table.merge(frame(spark, [(1, 1, 5.0), (9, 1, 5.0)]))
    assert rows(table.read()) == [(1, 1, 5.0), (2, 1, 2.0), (9, 1, 5.0)]


def test_two_writers_lose_no_rows(spark, table, monkeypatch):
    """Both write from the same version; one commits first, the other merges again."""
    table.merge(frame(spark, [(1, 0, 0.0)]))
    both, real, errors = threading.Barrier(2, timeout=120), VersionedTable._write, []
    met = threading.local()

    def write(self, *args):
        out = real(self, *args)
        if not getattr(met, "once", False):
            met.once = True
            both.wait()
        return out
    monkeypatch.setattr(VersionedTable, "_write", write)

    def run(day):
        try:
            table.merge(frame(spark, [(s, day, float(day)) for s in range(1, 6)]))
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    threads = [threading.Thread(target=run, args=(d,)) for d in (1, 2)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert not errors and table.versions() == [1, 2, 3]
    assert rows(table.read()) == sorted([(1, 0, 0.0)] + [(s, d, float(d)) for s in range(1, 6) for d in (1, 2)])


def test_taken_version_is_refused(table, spark):
    table.merge(frame(spark, [(1, 1, 1.0)]))
    assert table._commit(table._manifest()) is False and rows(table.read()) == [(1, 1, 1.0)]
