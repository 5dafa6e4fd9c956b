import hashlib
import io
import random
import zlib

import pytest

from marquetry.llm import warc


def member(page_id, payload, refers_to=None):
    return warc.encode_record(page_id, "http://x/\r\ny", payload, hashlib.sha1(payload).hexdigest(), refers_to, refers_to is not None)


def test_a_record_is_one_gzip_member_and_reads_back():
    rng = random.Random(1)
    payloads = [b"", b"a", bytes(rng.randrange(256) for _ in range(50_000)), b"\r\n\r\nWARC/1.1\r\n\r\n" * 9]
    members = [member(i, p) for i, p in enumerate(payloads)] + [member(9, payloads[2], refers_to=2)]
    plain = zlib.decompress(members[0], 31)
    assert plain.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and plain.endswith(b"\r\n\r\n")
    for chunk in (1, 7, 1 << 18):
        if chunk == 1:
            members_read, want = members[:2], payloads[:2]
        else:
            members_read, want = members, [*payloads, b""]
        records = list(warc.read_records(io.BytesIO(b"".join(members_read)), chunk))
        assert [p for _, p in records] == want
    assert records[-1][0]["warc-refers-to"] == records[2][0]["warc-record-id"]
    assert records[0][0]["warc-target-uri"] == "http://x/%0D%0Ay"


def broken(data, old, new):
    plain = zlib.decompress(data, 31)
    assert old in plain
    return zlib.compress(plain.replace(old, new, 1), 6, 31)


@pytest.mark.parametrize(
    "data, message",
    [
        (broken(member(1, b"hello"), b"hello", b"hellO"), "block digest"),
        (broken(member(1, b"hello"), b"WARC-Payload-Digest: sha1:", b"WARC-Payload-Digest: sha1:A"), "payload digest"),
        (broken(member(1, b"hello"), b"Content-Length: 8", b"Content-Length: 7"), "Content-Length|digest"),
        (broken(member(1, b"hello"), b"WARC/1.1", b"HTTP/1.1"), "version"),
        (member(1, b"hello")[:-12], "within"),
        (zlib.compress(zlib.decompress(member(1, b"a"), 31) * 2, 6, 31), "more than one record"),
        (zlib.compress(b"WARC/1.1\r\nWARC-Type: response\r\n", 6, 31), "header"),
    ],
)
def test_broken_archives_are_errors(data, message):
    with pytest.raises(ValueError, match=message):
        list(warc.read_records(io.BytesIO(data)))


def test_round_trip(spark):
    long, other = "x" * 1000, "é" * 500
    rows = [(1, "u", long), (5, "v", long), (3, None, long), (2, "u", other), (9, "u", other + "y"), (4, "w", "short"), (6, "w", "short"), (7, "z", None), (8, "z", ""), (10, "t", long * 900)]
    rows += [(5, "again", long), (None, "n", long)]
    pages = spark.createDataFrame([(*r, "e", 1) for r in rows], "page_id long, url string, html string, sha1 string, bytes int").repartition(3)
    got = sorted((tuple(r) for r in warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)
    want = []
    for page_id, _, text in rows:
        data = (text or "").encode()
        revisit = text == long and page_id != 5
        want.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 5 if revisit else None))
    assert got == sorted(want, key=repr)


def test_archives_of_bounded_size_hold_payloads(spark, tmp_path):
    rows = [(i, f"u{i}", f"page {i} " + "z" * (i * 37 % 900)) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    archives = warc.write(pages, f"file://{tmp_path}", archive_bytes=4000)
    assert archives.count() > 6
    read = warc.read(archives, with_payload=True).collect()
    assert sorted((r["page_id"], r["target_uri"], r["payload"].decode()) for r in read) == sorted(rows)
    assert warc.round_trip(pages.limit(0)).collect() == []
