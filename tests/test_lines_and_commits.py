"""Event lines with positions, and the sink whose rows become visible by commit."""

import os
import random

import pyarrow as pa
import pytest

from eventide.sinks import committed
from eventide.sources import lines
from eventide.streaming.jobs import run_until_done


def plain_lines(data: bytes):
    """(position, next position, line), by splitting the whole."""
    out, at = [], 0
    for piece in data.split(b"\n"):
        last = at + len(piece) == len(data)
        if piece or not last:
            out.append((at, at + len(piece) + (not last), piece.removesuffix(b"\r")))
        at += len(piece) + 1
    return out


def test_ranges_share_lines_out_once():
    rnd = random.Random(3)
    for _ in range(300):
        data = b"".join(rnd.choice([b"\n", b"\r\n", b"a", b"bcd", "é".encode(), b"x" * 30]) for _ in range(rnd.randint(0, 40)))
        step, block = rnd.randint(1, 25), rnd.randint(1, 20)
        got = []
        for a in range(0, len(data), step):
            for rows in lines.lines_between(pa.BufferReader(data), a, min(len(data), a + step), block):
                got += rows
        assert got == plain_lines(data)


def put(folder, name, text, mode="w"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", mode, newline="") as f:
        f.write(text)


def reader(*folders, **options):
    return lines.LinesReader({"path": ",".join(folders), **options})


def rows_of(r, start, end):
    return [row for p in r.partitions(start, end) for b in r.read(p) for row in b.to_pylist()]


@pytest.mark.parametrize("range_bytes", [1, 7, 1 << 20])
def test_a_growing_file_and_later_files(tmp_path, range_bytes):
    a = str(tmp_path / "a")
    r = reader(a, rangeBytes=str(range_bytes))
    assert r.latestOffset() == {} and rows_of(r, {}, {}) == []  # no folder yet
    put(a, "1", "one\n\ntw")
    put(a, "_hidden", "no\n")
    first = r.latestOffset()
    assert first == {a: ["1", 5]}
    assert [x["value"] for x in rows_of(r, {}, first)] == [b"one", b""]
    put(a, "1", "o\nlast", "a")
    put(a, "2", "")
    second = r.latestOffset()
    assert [x["value"] for x in rows_of(r, first, second)] == [b"two", b"last"]  # complete, as a file follows
    put(a, "3", "3\n")
    assert [x["value"] for x in rows_of(r, second, r.latestOffset())] == [b"3"]
    assert rows_of(r, {}, first) + rows_of(r, first, second) == rows_of(r, {}, second)  # replays agree


def test_a_start_behind_any_row(tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    for k in range(3):
        put(a, f"f{k}", "".join(f"a{k}-{i}\n" for i in range(9)))
    put(b, "f0", "b0\nb1\n")
    r = reader(a, b, rangeBytes="11")
    whole = rows_of(r, {}, r.latestOffset())
    of_a = [x for x in whole if x["folder"] == a]
    assert len(of_a) == 27 and len(whole) == 29
    for k, x in enumerate(of_a):
        given = reader(a, b, rangeBytes="11", startingOffsets=f'{{"{a}": ["{x["file"]}", {x["next_position"]}]}}')
        assert [y for y in rows_of(given, given.initialOffset(), given.latestOffset()) if y["folder"] == a] == of_a[k + 1:]
    latest = reader(a, b, startingOffsets="latest")
    assert rows_of(latest, latest.initialOffset(), latest.latestOffset()) == []
    with pytest.raises(ValueError, match="not read"):
        reader(a, startingOffsets='{"elsewhere": ["f", 0]}')


def test_stream_from_latest_goes_on_from_its_checkpoint(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    put(src, "1", "old\n")
    for text in (None, "new\nnewer\n"):
        if text:
            put(src, "2", text)
        stream = lines.read_event_lines(spark, src, "latest")
        run_until_done(committed.write_committed(stream, out, ck, trigger="availableNow"))
    got = committed.read_committed(spark, out, lines.SCHEMA)
    assert sorted(bytes(r.value) for r in got.collect()) == [b"new", b"newer"]
    assert lines.position_behind(got) == {src: ("2", 10)}


def batch(*values):
    return pa.record_batch([pa.array(values, pa.int64())], names=["v"])


def visible(spark, path):
    return sorted(r.v for r in committed.read_committed(spark, path, "v long").collect())


def test_killed_attempts_and_replays(spark, tmp_path):
    path = str(tmp_path / "t")
    w = committed.CommittedWriter(path, file_rows=2)
    assert visible(spark, path) == []

    def dies():
        yield batch(1, 2, 3)
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        w.write(dies())
    again = w.write(iter([batch(1, 2, 3), batch(), batch(4)]))
    twin = w.write(iter([batch(1, 2, 3), batch(4)]))  # a speculative copy that does not report
    assert again.rows == 4 and len(again.files) == 2 and twin.rows == 4
    assert visible(spark, path) == []  # nothing before the commit
    w.commit([again, w.write(iter([])), None], 0)
    assert visible(spark, path) == [1, 2, 3, 4]
    w.commit([w.write(iter([batch(1, 2, 3, 4)]))], 0)  # replayed
    assert visible(spark, path) == [1, 2, 3, 4]
    failed = w.write(iter([batch(5)]))
    w.abort([failed, None], 1)
    pinned = committed.read_committed(spark, path, "v long", up_to_batch=0)
    w.commit([w.write(iter([batch(6)]))], 1)
    assert visible(spark, path) == [1, 2, 3, 4, 6] and pinned.count() == 4
    assert committed.remove_orphans(path) == 3  # one of the killed attempt, two of the copy
    assert visible(spark, path) == [1, 2, 3, 4, 6]
    assert [c["rows"] for c in committed.commits(path)] == [4, 1]


def test_an_empty_batch_commits(spark, tmp_path):
    path = str(tmp_path / "t")
    w = committed.CommittedWriter(path, file_rows=2)
    w.commit([w.write(iter([]))], 0)
    assert visible(spark, path) == [] and committed.commits(path)[0]["files"] == []
