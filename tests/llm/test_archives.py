"""WARC archives: bytes, odd payloads, revisits."""

import gzip
import hashlib
import random
import zlib

import pytest

from plumbline.llm import queries, warc

ROWS = "page_id long, url string, html string, record_id string, type string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS).repartition(3)


def by_hand(rows, least=1000):
    out, groups = [], {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least:
            groups.setdefault(data, []).append(page)
    for data, ids in groups.items():
        first = max((i for i in ids if i is not None), default=None)
        ids.remove(first)
        digest = hashlib.sha1(data).hexdigest()
        out += [(first, len(data), digest, "response", None)]
        out += [(i, len(data), digest, "revisit", first) for i in ids]
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) < least:
            out.append((page, len(data), hashlib.sha1(data).hexdigest(), "response", None))
    return out


ODD = [
    "", None, "\r\n\r\n", "\r\n", "\r", "a\r\n", "a\r\n\r\n", "\r\n\r\na", "a\r\n\r", "\r\n\r\n\r\n\r\n", "é\r\n\r\nü",
    "WARC/1.1\r\nWARC-Type: revisit\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "HTTP/1.1 200 OK\r\n\r\n", "\n\n", "﻿x", "\x00\x1f\x8b",
]


def run(spark, rows, tmp_path_factory):

    folder = str(tmp_path_factory.mktemp("in"))
    pages(spark, rows).write.parquet(f"{folder}/pages.parquet")
    return [tuple(r) for r in queries.op12_warc_revisits(spark, folder).collect()]


@pytest.mark.parametrize("seed", [0, 1])
def test_revisits(spark, tmp_path_factory, seed):
    rng = random.Random(seed)
    texts = [*ODD, "x" * 999, "x" * 1000, "é" * 500, "é" * 499 + "a", "big\r\n\r\n" * 30_000, *(p or "" for p in ODD[4:])]
    texts += ["hot" * 400] * 300 + ["w\r\n\r\n" * 300, "w\r\n\r\n" * 300 + "\r\n"] * 5
    rng.shuffle(texts)
    urls = [None, "http://a/?x=1", "", "no\r\nWARC-Type: revisit", "ü"]
    rows = [(k * 7 - 500, rng.choice(urls), t) for k, t in enumerate(texts)]
    rows += [(None, None, "hot" * 400), (None, "u", None), (None, "u", "n" * 1000), (None, "u", "n" * 1000), (1, "u", "d" * 1000), (1, "u", "d" * 1000)]
    assert sorted(run(spark, rows, tmp_path_factory), key=str) == sorted(by_hand(rows), key=str)


def test_no_pages(spark, tmp_path_factory):
    assert run(spark, [], tmp_path_factory) == []


def test_archive_holds_the_very_bytes(spark, tmp_path):
    rows = [(k, f"http://x/{k}", t) for k, t in enumerate(ODD)]
    warc.write_archive(pages(spark, rows), f"{tmp_path}/a", "page_id", "url", "html")
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "a").glob("part-*.gz"))
    assert whole.count(b"WARC/1.1\r\nWARC-Type: response\r\n") == len(ODD)
    found = {r["source_id"]: r for r in warc.read_archive(spark, f"{tmp_path}/a").collect()}
    for page, url, html in rows:
        row = found[str(page)]
        assert bytes(row["payload"]) == (html or "").encode() and row["uri"] == url
        assert row["stated_digest"] == "sha1:" + row["payload_digest"]
    assert warc.read_archive(spark, f"{tmp_path}/a", payload=False).where("payload IS NOT NULL").isEmpty()


def record(kind, number, block, *fields):
    head = [f"WARC/1.0\r\nWARC-Type: {kind}", f"WARC-Record-ID: <urn:x:{number}>", *fields, f"Content-Length: {len(block)}"]
    return gzip.compress(("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n")


def test_archives_from_elsewhere(spark, tmp_path):
    """A gzip member for each record, other types, binary payloads, revisits that are there already."""
    page = b"HTTP/1.0 200 Fine\r\nX-Own: 1\r\n\r\n" + bytes(range(256)) * 8
    http = "content-type: application/http;msgtype=response"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.warc.gz").write_bytes(
        record("warcinfo", 0, b"software: x\r\n", "Content-Type: application/warc-fields")
        + record("response", 1, page, http, "X-Source-ID: 5", "WARC-Target-URI: u:1")
        + record("request", 2, b"GET / HTTP/1.0\r\n\r\n", "Content-Type: application/http; msgtype=request")
        + record("revisit", 3, b"", "WARC-Refers-To: <urn:x:1>", "X-Source-ID: 7", "WARC-Profile: p", "X-Folded: a\r\n b")
    )
    (tmp_path / "in" / "two.warc.gz").write_bytes(record("response", 4, page, http, "X-Source-ID: 9"))
    warc.deduplicate_archive(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    from plumbline.llm.common import written

    records = written(warc.read_archive(spark, f"{tmp_path}/out"))
    found = {r["record_id"]: r for r in records.collect()}
    assert {k[7:-1]: r["type"] for k, r in found.items()} == {
        "0": "warcinfo", "1": "revisit", "2": "request", "3": "revisit", "4": "response",
    }
    assert bytes(found["<urn:x:4>"]["payload"]) == page.partition(b"\r\n\r\n")[2]
    assert bytes(found["<urn:x:1>"]["head"]).startswith(b"HTTP/1.0 200 Fine\r\nX-Own: 1\r\n")
    assert found["<urn:x:3>"]["refers_to"] == found["<urn:x:1>"]["refers_to"] == "<urn:x:4>"
    assert found["<urn:x:3>"]["profile"] == "p" and bytes(found["<urn:x:0>"]["payload"]) == b"software: x\r\n"
    full = {r["record_id"]: r["payload_bytes"] for r in warc.resolved(records).collect()}
    assert full["<urn:x:1>"] == full["<urn:x:3>"] == 2048


def test_cut_archive_is_an_error(spark, tmp_path):
    (tmp_path / "in").mkdir()
    data = gzip.decompress(record("resource", 1, b"x" * 5000))
    (tmp_path / "in" / "one.warc.gz").write_bytes(gzip.compress(data[:3000]))
    with pytest.raises(Exception, match="ends inside of a record"):
        warc.read_archive(spark, f"{tmp_path}/in").collect()


def test_revisit_of_a_missing_record(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.warc.gz").write_bytes(record("revisit", 1, b"", "WARC-Refers-To: <urn:x:8>") + record("revisit", 2, b""))
    from plumbline.llm.common import written

    found = warc.resolved(written(warc.read_archive(spark, f"{tmp_path}/in").drop("payload"))).collect()
    assert [(r["type"], r["payload_bytes"], r["refers_source"]) for r in found] == [("revisit", None, None)] * 2


def test_archives_are_compressed_at_a_low_level(spark, tmp_path):
    """Records are packed and unpacked twice, so time counts more than the last share of space."""
    words = [f"word{(k * k) % 977} " for k in range(4000)]
    df = spark.createDataFrame([(k, "http://a/", "".join(words[k:])) for k in range(40)], "id long, url string, html string")
    warc.write_archive(df.coalesce(1), str(tmp_path / "a"), "id", "url", "html")
    (file,) = (tmp_path / "a").glob("*.gz")
    text = gzip.decompress(file.read_bytes())
    low, usual = (len(zlib.compress(text, level)) for level in (3, 6))
    assert abs(file.stat().st_size - low) < abs(file.stat().st_size - usual)
