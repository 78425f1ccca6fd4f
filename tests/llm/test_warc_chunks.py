"""Operator 3: the chunked record table gives the payloads back, in chunks of a fixed size."""

import gzip
import hashlib
import random

import pytest

from chanlake.llm import warc
from chanlake.session import shared_path

SCHEMA = "page_id long, url string, html string, data string, last boolean"


def _write(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", True) for r in rows], SCHEMA).repartition(3)
    path = shared_path(spark, "test", "warc")
    warc.write_archives(warc.plan_records(df, "page_id", "url", "html", 100), path, **kw)
    return path


@pytest.mark.parametrize("segment, chunk", [(1 << 20, 100), (700, 64), (1000, 1000), (50, 7), (1 << 20, 1 << 16)])
def test_chunks_are_the_payload(spark, segment, chunk):
    rng = random.Random(segment + chunk)
    rows = [(i, f"u{i}", rng.choice([None, "", "x" * 99, "\r\n\r\n" * rng.randrange(50), "no blank line " * rng.randrange(400),
                                     f"é{i}\r\n" * rng.randrange(300), "WARC/1.1\r\n\r\nx" * 9])) for i in range(40)]
    rows.append((99, "u", "long " * 60_000))
    got = {}
    for r in warc.read_chunks(spark, _write(spark, rows, segment_bytes=segment), chunk).collect():
        got.setdefault(r["record_id"], []).append(r)
    assert len(got) == len(rows)
    for i, _, html in rows:
        data, own = (html or "").encode(), sorted(got[f"{warc.ID}{i}"], key=lambda r: r["chunk_no"])
        assert [r["chunk_no"] for r in own] == list(range(len(own)))
        assert [r["last"] for r in own] == [False] * (len(own) - 1) + [True]
        assert all(r["n"] == len(r["data"]) <= chunk for r in own)
        if own[0]["record_type"] == "revisit":
            assert own[0]["payload_bytes"] == len(data) and own[0]["digest"] == hashlib.sha256(data).hexdigest()
            continue
        assert b"".join(bytes(r["data"]) for r in own) == data
        at = 0
        for r in own:
            at += r["n"]
            assert r["payload_bytes"] == at and r["digest"] == hashlib.sha256(data[:at]).hexdigest()


def test_foreign_record_is_cut_by_size(spark, tmp_path):
    """Another writer's record in one piece, without a blank line."""
    body = b"y" * 1_000_000
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:1>\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress((head + body + b"\r\n\r\n") * 2))
    rows = warc.read_chunks(spark, f"file://{tmp_path}", 4096).collect()
    assert len(rows) == 2 * -(-len(body) // 4096) and max(r["n"] for r in rows) == 4096
    assert {r["digest"] for r in rows if r["last"]} == {hashlib.sha256(body).hexdigest()}
    assert all(r["complete"] for r in rows)


def test_one_row_above_a_segment_with_default_settings(spark):
    text = "".join(f"line {i}\r\n\r\n" for i in range(200_000))
    path = _write(spark, [(1, "u", text)])
    row = warc.read_records(spark, path).first()
    assert (row["payload_bytes"], row["digest"], row["complete"]) == (
        len(text), hashlib.sha256(text.encode()).hexdigest(), True) and len(text) > 2 << 20
