"""Archives: exact round trip, framing, digests."""

import hashlib
import io

import pytest

from roadpulse.llm import warc


def test_records_and_broken_archives():
    data = warc.page_record(1, "http://a/ü\r\nX: y", "é\r\n\r\nWARC/1.1".encode(), None) + warc.page_record(2, None, b"", 1)
    (a, block), (b, head) = list(warc.records(io.BytesIO(data)))
    assert block.endswith("é\r\n\r\nWARC/1.1".encode()) and a["warc-type"] == "response" and "x" not in a
    row = warc.page_of(a, block, "p", True)
    assert row["digest_ok"] and row["payload_bytes"] == 14 and row["payload"] == "é\r\n\r\nWARC/1.1".encode()
    assert warc.page_of(b, head, "p", True)["refers_to"] == 1 and b["warc-type"] == "revisit"
    assert not warc.page_of(a, block[:-1] + b"?", "p", True)["digest_ok"]
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records(io.BytesIO(data[:-5])))
    assert list(warc.records(io.BytesIO(b""))) == []


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [(i, f"u{i}", f"<p>{i % 7}" * (i % 5), "x") for i in range(60)]
    rows += [(60, None, None, "x"), (61, "u", "", None), (62, "u", "long " * 200_000, "x"), (None, "n", "<p>1", "x"), (63, "r", "same", "x"), (63, "r", "same", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    manifest = warc.write_archives(df, f"file://{tmp_path}/w")
    got = [r.asDict() for r in warc.read_archives(manifest).collect()]
    assert len(got) == len(rows) == sum(r.records for r in manifest.collect()) and all(r["digest_ok"] for r in got)
    groups = {}
    for page, _, html, _ in rows:
        groups.setdefault(html or "", []).append(page if page is not None else -1)
    want = []
    for page, url, html, _ in rows:
        top = max(groups[html or ""])
        want.append((page, url, len((html or "").encode()), "response" if page == top else "revisit", None if page == top else top))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r["page_id"], r["url"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got], key=key) == sorted(want, key=key)
    texts = {p: h for p, _, h, _ in rows}
    for r in got:
        if r["record_type"] == "response":
            assert r["payload"] == (texts[r["page_id"]] or "").encode()
            assert hashlib.sha1(r["payload"]).digest() == __import__("base64").b32decode(r["payload_digest"])


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_report(df).collect() == []
