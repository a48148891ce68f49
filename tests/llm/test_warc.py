"""WARC writer and salvage reader: round trip, damage, edges."""

import base64
import hashlib
import random

from conftest import SF001
from streamlens.llm import queries, warc


def expected(rows):
    out = []
    for i, h in rows:
        p = (h or "").encode()
        top = max((j for j, g in rows if (g or "").encode() == p and j is not None), default=None)
        own = i == top
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if own else "revisit", None if own else top))
    return sorted(out, key=str)


def test_query_matches_brute_force(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()]
    got = queries.op2_warc(spark, SF001).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows)


def test_edges_both_forms(spark, tmp_path):
    rows = [(1, "a\r\n\r\nWARC/1.1\r\nWARC-Type: x"), (2, "same"), (3, "same"), (3, "same"), (None, "same"), (4, None), (5, ""), (None, "only"),
            (6, "é" * 70000), (7, "\x1f\x8b\x08")]
    df = spark.createDataFrame([(i, f"http://x/{i}\r\nq", h, "clash") for i, h in rows], "page_id long, url string, html string, key string")
    for compress in (True, False):
        path = str(tmp_path / f"a{compress}")
        warc.write_archives(warc.with_originals(df), path, compress=compress, rotate=3)
        got = warc.read_archives(spark, path).collect()
        assert all(r.failed_check is None for r in got)
        assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows)
        assert sorted(bytes(r.payload).decode() for r in got if r.record_type == "response") == sorted(["same", "same", "", "only", *[h for i, h in rows if i in (1, 6, 7)]])
    warc.write_archives(warc.with_originals(df.limit(0)), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).collect() == []
    short = warc.with_originals(df, least=5).collect()
    assert all(r.refers_to is None for r in short)


def damaged(compress):
    recs = [warc.record(i, "u", f"payload {i} ".encode() * 30) for i in range(20)]
    parts = [warc._member(r + b"\r\n\r\n", 6) if compress else r + b"\r\n\r\n" for r in recs]
    return parts


def test_salvage_recovers_the_rest():
    rng = random.Random(1)
    for compress in (True, False):
        parts = damaged(compress)
        for _ in range(60):
            bad = rng.randrange(20)
            hit = bytearray(parts[bad])
            at = rng.randrange(len(hit))
            hit[at:at + 3] = bytes(x ^ 0x55 for x in hit[at:at + 3])
            data = b"".join(parts[:bad]) + bytes(hit) + b"".join(parts[bad + 1:])
            seen = list(warc.Salvage(data))
            good = [h["warc-record-id"] for _, _, why, h, _ in seen if not why]
            want = [f"<urn:page:{i}>" for i in range(20) if i != bad]
            # damage in a header that is not checked may leave the record valid
            assert [g for g in good if g in want] == want
            assert len(good) - len(want) in (0, 1)
            spans = [(a, n) for a, n, *_ in seen]
            assert spans[0][0] == 0 and sum(n for _, n in spans) == len(data)
            assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
        cut = b"".join(parts)[:-7]
        seen = list(warc.Salvage(b"junk" + cut))
        assert [bool(w) for _, _, w, _, _ in seen] == [True] + [False] * 19 + [True]


def test_quoted_record_stays_quarantined():
    inner = warc.record(99, "u", b"inner") + b"\r\n\r\n"
    outer = bytearray(warc.record(1, "u", b"x" * 50 + inner) + b"\r\n\r\n")
    outer[outer.index(b"xxxx") + 2] ^= 1
    data = bytes(outer) + warc.record(2, "u", b"after") + b"\r\n\r\n"
    seen = list(warc.Salvage(data))
    assert [(w, h.get("warc-record-id")) for _, _, w, h, _ in seen] == [("block digest", None), ("", "<urn:page:2>")]


def test_one_bad_record_in_a_member_of_several():
    recs = [warc.record(i, "u", f"payload {i} ".encode() * 30) + b"\r\n\r\n" for i in range(8)]
    bad = recs[3].replace(b"payload 3", b"payl0ad 3", 1)
    member = warc._member(b"".join([*recs[:3], bad, *recs[4:]]), 6)
    after = warc._member(warc.record(50, "u", b"after") + b"\r\n\r\n", 6)
    ids = lambda data: [h.get("warc-record-id") or w for _, _, w, h, _ in warc.Salvage(data)]
    name = lambda i: f"<urn:page:{i}>"
    assert ids(member + after) == [*map(name, range(3)), "block digest", *map(name, range(4, 8)), name(50)]
    rng = random.Random(3)
    big = [warc.record(i, "u", rng.randbytes(3000)) + b"\r\n\r\n" for i in range(8)]
    whole = warc._member(b"".join(big), 6)
    assert ids(whole[:len(whole) * 9 // 16]) == [*map(name, range(4)), "gzip member"]
    crc = whole[:-8] + bytes(4) + whole[-4:]
    assert ids(crc + after) == [*map(name, range(7)), "gzip member", name(50)]
