import base64
import hashlib
import io
import os
import struct

import pytest
import zstandard
from llm_frames import SF
from oracle_check import compare, connect

from warcloom.llm import catalogue
from warcloom.llm import warc_zstd as W


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def brute(rows):
    first, members = {}, {}
    for page, _, html in rows:
        key = html or ""
        members[key] = members.get(key, 0) + 1
        if page is not None:
            first[key] = min(page, first.get(key, page))
    out = []
    for page, _, html in rows:
        key = html or ""
        again = members[key] > 1 and key in first and page != first[key]
        payload = key.encode()
        out.append((page, len(payload), digest(payload), "revisit" if again else "response", first[key] if again else None))
    return sorted(out, key=repr)


def run(spark, rows, path, **options):
    df = spark.createDataFrame([(p, u, h, "x", 1) for p, u, h in rows], "page_id long, url string, html string, digest string, members int")
    W.write_pages(df, path, **options)
    found = W.read_archives(spark, path).collect()
    assert [r.error for r in found if r.error] == []
    return sorted(((int(r.record_id[10:-1]) if r.record_id != "<urn:page:>" else None, r.payload_bytes, r.payload_digest, r.record_type,
                    int(r.refers_to[10:-1]) if r.refers_to else None) for r in found), key=repr), found


def test_table_equals_sql(spark):
    assert compare(spark, connect(SF), SF, catalogue.QUERIES["op13_warc_archives"], catalogue.ORACLES["op13_warc_archives"]) is None


AWKWARD = [
    (5, "http://a.org/", "same"), (3, "http://b.org/x y\r\nEvil: 1", "same"), (9, None, "same"), (None, "http://c.org/é", "same"), (None, None, "lone"),
    (None, "http://d.org/", "lone"), (20, "u", None), (21, "u", ""), (22, "v", "\r\n\r\n WARC/1.1 é\U0001f600"), (23, "w", "x" * 3_000_000),
    (3, "http://b.org/", "same"), (-4, "", "minus"), (-3, "", "minus"),
]


def test_awkward_pages(spark, tmp_path):
    got, found = run(spark, AWKWARD, str(tmp_path / "a"))
    assert got == brute(AWKWARD)
    payloads = {r.payload_digest: bytes(r.payload) for r in found if r.record_type == "response"}
    assert all(digest(p) == d for d, p in payloads.items()) and len(payloads) == 6
    assert {r.target_uri for r in found} >= {"http://b.org/x%20y%0D%0AEvil:%201", "http://c.org/é"}


def test_common_payload_and_dictionary(spark, tmp_path):
    rows = [(i, f"http://h{i}.org/", "<html>" + ("hot" if i % 3 == 0 else f"<p>page {i} of the site</p>" * 20)) for i in range(900)]
    path = str(tmp_path / "a")
    assert run(spark, rows, path)[0] == brute(rows)
    names = [n for n in os.listdir(path) if n.endswith(".warc.zst")]
    with open(f"{path}/{names[0]}", "rb") as f:
        assert f.read(4) == W._DICTIONARY
    (tmp_path / "a" / "left-by-a-failed-task.warc.zst").write_bytes(b"junk")
    assert W.read_archives(spark, path).count() == 900
    assert run(spark, rows, str(tmp_path / "b"), least_bytes=10**6)[0] == sorted(
        ((i, len(h), digest(h.encode()), "response", None) for i, _, h in rows), key=repr)


def test_empty_table(spark, tmp_path):
    assert run(spark, [], str(tmp_path / "a"))[0] == []


def archive(contents, dictionary=b"", packed=True):
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    out = b""
    if dictionary:
        inner = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
        out = W._DICTIONARY + struct.pack("<I", len(inner)) + inner
    packer = zstandard.ZstdCompressor(dict_data=known, write_checksum=True)
    return out, [packer.compress(c) for c in contents]


def records(n=6):
    return [W.record(i, f"http://x{i}.org", f"page {i} ".encode() * 50, hashlib.sha1(f"page {i} ".encode() * 50).digest(), "response", None, "2020-01-01T00:00:00Z") for i in range(n)]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_frames_of_any_chunking(monkeypatch, packed, chunk):
    monkeypatch.setattr(W, "_CHUNK", chunk)
    head, parts = archive(records(), b"page org http WARC/1.1 " * 30, packed)
    found = list(W.frames(io.BytesIO(head + b"".join(parts))))
    assert [c for _, _, c, _ in found] == records() and all(e is None for *_, e in found)
    assert [(o, n) for o, n, _, _ in found] == [(len(head) + sum(map(len, parts[:i])), len(p)) for i, p in enumerate(parts)]


@pytest.mark.parametrize("chunk", [3, 1 << 20])
def test_broken_places_cost_one_row_each(monkeypatch, chunk):
    monkeypatch.setattr(W, "_CHUNK", chunk)
    head, parts = archive(records())
    spoiled = bytearray(parts[2])
    spoiled[-1] ^= 0xFF  # the checksum no longer fits
    data = b"".join([parts[0], b"rubbish", parts[1], bytes(spoiled), parts[3], struct.pack("<I", 0x184D2A50) + struct.pack("<I", 3) + b"abc", parts[4], parts[5][:-9]])
    found = list(W.frames(io.BytesIO(head + data)))
    assert [c for _, _, c, _ in found if c is not None] == [r for i, r in enumerate(records()) if i not in (2, 5)]
    gaps = [(o, n) for o, n, c, _ in found if c is None]
    at = len(parts[0])
    second = at + 7 + len(parts[1])
    assert gaps == [(at, 7), (second, len(spoiled)), (len(data) - len(parts[5]) + 9, len(parts[5]) - 9)]


@pytest.mark.parametrize(("change", "reason"), [
    (lambda r: r.replace(b"WARC/1.1", b"XARC/1.1"), "no WARC record"), (lambda r: r[:-2], "the block has"), (lambda r: r + r, "the block has"),
    (lambda r: r.replace(b"page 0", b"page X"), "its digest"), (lambda r: r.replace(b"WARC-Date", b"WARC-Dote"), "missing warc-date"),
    (lambda r: r.replace(b"Content-Length: 350", b"Content-Length: 351"), "its head says 351"), (lambda r: r.replace(b"WARC-Type: ", b"WARC-Type "), "colon"),
    (lambda r: b"WARC/1.1\r\nWARC-Type: x", "does not end"),
])
def test_headers_and_lengths_are_checked(change, reason):
    with pytest.raises(ValueError, match=reason):
        W.checked(change(records(1)[0]))


def test_one_bad_record_leaves_the_others(spark, tmp_path):
    head, parts = archive([records()[0], b"WARC/1.1\r\nnothing\r\n\r\n", records()[1]])
    (tmp_path / "x.warc.zst").write_bytes(head + b"".join(parts))
    for path in (tmp_path, tmp_path / "x.warc.zst"):
        rows = sorted(W.read_archives(spark, str(path)).collect(), key=lambda r: r.ordinal)
        assert [r.error is None for r in rows] == [True, False, True] and rows[2].payload_bytes == 350
