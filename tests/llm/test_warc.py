"""Archives: exact round trips, revisits against a plain count, and frames on their own."""

from __future__ import annotations

import hashlib
import io
import struct

import pytest
import zstandard

from sparkprep.llm.warc import (
    SKIPPABLE, dictionary_frame, read_archives, record, records_of, train_dictionary, write_archives,
)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, payload string")


def test_round_trip_and_revisits(spark):
    big, other = "<p>" + "é" * 600, "x" * 1000
    rows = [
        (1, "http://a/", big), (7, "http://b/\r\nX: y", big), (7, "http://b/\r\nX: y", big), (3, None, big),
        (4, "http://c/", "small"), (5, "http://d/", "small"), (6, "http://e/", None), (8, "http://f/", ""),
        (9, "http://g/ü", "line\r\n\r\nWARC/1.1\r\n" * 90), (None, "http://h/", other), (None, "http://i/", other),
        (10, "http://j/", "y" * 999), (11, "http://k/", "y" * 999), (12, "http://l/", "z" * 3_000_000),
    ]
    back = read_archives(write_archives(pages(spark, rows))).collect()
    assert len(back) == len(rows)
    got = {}
    for r in back:
        got.setdefault((r["page_id"], r["url"]), []).append(r)
    for page_id, url, payload in rows:
        r = got[page_id, url and url.replace("\r", "%0D").replace("\n", "%0A")][0]
        data = (payload or "").encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        revisit = page_id in (1, 3)
        assert r["record_type"] == ("revisit" if revisit else "response")
        assert r["refers_to"] == (7 if revisit else None)
        assert r["payload"] == (None if revisit else payload or "")


def test_empty_table(spark):
    assert read_archives(write_archives(pages(spark, []))).count() == 0


def test_records_stand_alone_behind_the_dictionary():
    texts = [f"<html><p>page number {i}, with words {i * 7} like the others</p></html>".encode() * 9 for i in range(300)]
    records = [record(i, f"http://a/{i}", t, hashlib.sha1(t).hexdigest(), len(t), None) for i, t in enumerate(texts)]
    dictionary = train_dictionary(records)
    data = zstandard.ZstdCompressionDict(dictionary)
    packer = zstandard.ZstdCompressor(dict_data=data)
    frames = [packer.compress(r) for r in records]
    archive = dictionary_frame(dictionary) + b"".join(frames)
    assert struct.unpack("<I", archive[:4])[0] == SKIPPABLE
    assert sum(map(len, frames)) < sum(len(zstandard.compress(r)) for r in records)
    read = list(records_of(io.BytesIO(archive)))
    assert [f["x-page-id"] for f, _ in read] == [str(i) for i in range(300)]
    assert all(block.endswith(t) for (_, block), t in zip(read, texts))
    assert zstandard.ZstdDecompressor(dict_data=data).decompress(frames[17]) == records[17]


def test_damage_is_found():
    r = record(1, "http://a/", b"abc", hashlib.sha1(b"abc").hexdigest(), 3, None)
    with pytest.raises(ValueError):
        list(records_of(io.BytesIO(zstandard.compress(r[:-4] + b"zzzz"))))
