import base64
import gzip
import hashlib
import io

import pytest

from barloom.llm import warc

ROWS = [
    (1, "http://a/\r\nX: y", "<p>é</p>"),
    (2, None, "<p>é</p>"),
    (3, "http://c", None),
    (4, "http://d", ""),
    (5, "http://e", "x" * 300_000),
    (5, "http://e", "x" * 300_000),
    (6, "http://f", "WARC/1.1\r\n\r\n\r\n\r\n"),
    (None, "http://g", "<p>é</p>"),
    (None, "http://h", "only"),
    (None, "http://h", "only"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, sha string")


def brute(rows, least=0):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        to = max(same) if same and len(data) >= least and max(same) != page_id else None
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), sha, "revisit" if to is not None else "response", to))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 5, 1000])
def test_round_trip(spark, folder, least):
    pages = frame(spark, ROWS)
    back = warc.read_archives(warc.write_archives(pages, folder, min_bytes=least)).collect()
    assert sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=repr
    ) == brute(ROWS, least)
    payloads = sorted(((r.page_id, bytes(r.payload).decode()) for r in back if r.record_type == "response"), key=repr)
    kept = {(r.page_id, r.payload_digest) for r in back if r.record_type == "response"}
    expected = [
        (p, h or "")
        for p, _, h in ROWS
        if (p, base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()) in kept
    ]
    assert payloads == sorted(expected, key=repr)


def test_small_files_and_empty_table(spark, folder):
    pages = frame(spark, ROWS).coalesce(1)
    manifest = warc.write_archives(pages, folder, most=100)
    assert manifest.count() == len(ROWS) and warc.read_archives(manifest).count() == len(ROWS)
    none = warc.write_archives(pages.limit(0), folder + "/none")
    assert warc.read_archives(none).count() == 0


def test_members_are_records():
    parts = [warc.record(i, "u", b"p" * i) for i in (1, 100_000)]
    data = b"".join(gzip.compress(p) for p in parts)
    assert list(warc.members(io.BytesIO(data))) == parts


def test_damage_is_found():
    data = warc.record(1, "u", b"payload")
    headers, block = warc.parse(data)
    assert warc.checked(headers, block) == (b"payload", 7)
    with pytest.raises(warc.WarcError, match="digest"):
        warc.checked(*warc.parse(data.replace(b"payload", b"paYload")))
    with pytest.raises(warc.WarcError, match="length"):
        warc.parse(data[:-5] + data[-4:])
    with pytest.raises(warc.WarcError, match="ends inside"):
        list(warc.members(io.BytesIO(gzip.compress(data)[:-4])))
