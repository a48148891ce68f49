"""Growing line files and the index sink: offsets, pieces, restart after a crash."""

import glob
import json
import os
import random

import pytest

from streamlens.sources import datasources as ds
from streamlens.sources import sinks


def run(spark, src, index, ck, **options):
    docs = sinks.index_documents(ds.growing_lines(spark, src, **options))
    q = ds.index_stream(docs, index, ck, available_now=True)
    assert q.awaitTermination(120) and q.exception() is None


def add(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "ab") as f:
        f.write(data)


def texts(spark, index):
    return sorted(json.loads(r.doc)[sinks.INDEX_FIELD] for r in ds.read_index(spark, index).collect())


def test_growing_files_and_restart(spark, tmp_path):
    src, index, ck = (str(tmp_path / x) for x in ("src", "index", "ck"))
    add(f"{src}/a.log", "one\ntwo\nhalf a li".encode())
    add(f"{src}/_hidden", b"no\n")
    run(spark, src, index, ck)
    assert texts(spark, index) == ["one", "two"]
    add(f"{src}/a.log", "ne\r\nthreé\n".encode())
    add(f"{src}/b.log", b"other\n\n")
    run(spark, src, index, ck)
    want = sorted(["one", "two", "half a line", "threé", "other", ""])
    assert texts(spark, index) == want
    run(spark, src, index, ck)  # nothing new
    assert texts(spark, index) == want


def test_killed_between_the_index_and_the_commit_log(spark, tmp_path):
    """The batch is in the index, Spark does not know: it is replayed and changes nothing."""
    src, index, ck = (str(tmp_path / x) for x in ("src", "index", "ck"))
    add(f"{src}/a.log", b"".join(b"line %d\n" % i for i in range(500)))
    run(spark, src, index, ck, piece_bytes=100)
    for f in glob.glob(f"{ck}/commits/*") + glob.glob(f"{ck}/commits/.*.crc"):
        os.remove(f)
    add(f"{src}/a.log", b"more\n")
    run(spark, src, index, ck, piece_bytes=100)  # the replayed batch
    run(spark, src, index, ck, piece_bytes=100)
    assert texts(spark, index) == sorted([f"line {i}" for i in range(500)] + ["more"])
    named = {r for r in os.listdir(f"{index}/data") if r.endswith(".json")}
    marked = {n for m in glob.glob(f"{index}/committed/*.json") for n in json.load(open(m))}
    assert marked == named  # the replayed batch's second files are gone


def test_files_without_a_marker_are_not_in_the_index(spark, tmp_path):
    index = str(tmp_path / "index")
    w = ds.IndexWriter({"path": index}, ["_id", "doc"])
    first = w.write(iter([{"_id": "1", "doc": "x"}]))
    lost = w.write(iter([{"_id": "2", "doc": "y"}]))
    w.commit([first, w.write(iter([]))], 0)
    assert [(r._id, r.doc) for r in ds.read_index(spark, index).collect()] == [("1", "x")]
    w.abort([lost, None], 1)
    assert len(os.listdir(f"{index}/data")) == 1
    assert ds.read_index(spark, str(tmp_path / "none")).collect() == []


@pytest.mark.parametrize("piece", [1, 3, 7, 64, 1 << 20])
def test_pieces_give_each_line_once(tmp_path, piece, monkeypatch):
    rng = random.Random(piece)
    monkeypatch.setattr(ds, "_BLOCK", 5)
    data = "\n".join("é" * rng.randrange(6) + "x" * rng.randrange(9) for _ in range(60)).encode()
    add(f"{tmp_path}/f", data)
    r = ds.LineReader({"path": str(tmp_path), "pieceBytes": str(piece)})
    end = r.latestOffset()
    assert data[:end["f"]].endswith(b"\n") and b"\n" not in data[end["f"]:]
    middle = {"f": data.index(b"\n", 50) + 1}
    for start in ({}, middle):
        got = [x for p in r.partitions(start, end) for b in r.read(p) for x in b.column(0).to_pylist()]
        assert got == data[start.get("f", 0):end["f"]].decode().split("\n")[:-1]
    with pytest.raises(ValueError):
        r.partitions({"f": len(data) + 1}, end)
