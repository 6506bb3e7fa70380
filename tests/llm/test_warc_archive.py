import gzip
import hashlib
import struct

import pytest
import zstandard

from lakesync.llm import warc_archive as wa
from lakesync.llm.common import Scratch

SHAPE = "page_id long, url string, html string"


def table(spark, pages, **more):
    manifest = wa.write_archives(pages, Scratch(spark, "test").path("warc"), **more)
    return manifest.collect(), wa.read_archives(manifest).collect()


def content(path):
    store, file = wa.open_store(path)
    with store.open_input_stream(file) as source:
        return source.read()


def given():
    copies, big = "é" * 60, "<p>" + "x" * 300_000
    rows = [(i, f"http://h/{i}", f"<html><body>page {i} " + "lorem ipsum " * (i % 9) + "</body></html>") for i in range(60)]
    rows += [(100, None, copies), (70, "http://h/ ü\r\nX: y", copies), (80, "u", copies), (81, "u", "short"), (82, "u", "short"), (83, "u", None), (84, "u", ""), (85, "u", big), (2**60 + 1, "u", big)]
    rows += [(None, "u", copies), (None, "u", "z" * 200), (90, "u", "y" * 150), (90, "u", "y" * 150), (None, None, None)]
    return rows


def test_round_trip_and_revisits(spark):
    rows = given()
    df = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 AS digest", "2 AS row", "3 AS refers_to", "4 AS bytes")
    manifest, found = table(spark, df)
    assert sum(r["records"] for r in manifest) == len(found) == len(rows)
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(first.get(data, i), i)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = first.get(data) if len(data) >= 100 and data in first and first[data] != i else None
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if to is not None else "response", to, None if to is not None else data))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_files_start_with_a_dictionary_and_have_a_frame_for_each_record(spark):
    manifest, _ = table(spark, spark.createDataFrame(given(), SHAPE))
    for r in manifest:
        data = content(r["path"])
        magic, size = struct.unpack("<II", data[:8])
        assert magic == wa.SKIPPABLE_MAGIC and len(data) == r["bytes"]
        held = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
        reader = zstandard.ZstdDecompressor(dict_data=wa._dictionary(held))
        rest, n = data[8 + size :], 0
        while rest:  # by the library's own idea of where a frame ends
            part = reader.decompressobj()
            assert part.decompress(rest).startswith(b"WARC/1.1\r\n")
            rest, n = part.unused_data, n + 1
        assert n == r["records"]


def test_damage_is_noticed():
    raw = wa.warc_record("1", "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert wa.parse_record(raw)[2] == b"payload"
    for bad in (raw.replace(b"payload", b"pAyload"), raw[:-1], b"WARC/0.9" + raw[8:]):
        with pytest.raises(ValueError):
            wa.parse_record(bad)
    with pytest.raises(ValueError):
        list(wa.read_archive(gzip.compress(raw)))


def test_dictionaries():
    assert wa.build_dictionary([]) == b"" and wa.build_dictionary([b"", b"ab"]) == b"ab"
    assert wa.build_dictionary([f"<html>{k} common words and tags {k % 7}</html>".encode() * 20 for k in range(500)])[:4] == struct.pack("<I", wa.DICTIONARY_MAGIC)


def test_small_files_and_empty_tables(spark, monkeypatch):
    rows = spark.createDataFrame(given(), SHAPE)
    assert table(spark, rows.where("false")) == ([], [])
    _, found = table(spark, rows.where("length(html) = 0"))
    assert [r["payload_bytes"] for r in found] == [0]


def test_large_ids_beside_nulls(spark):
    ids = [2**60 + 1, 2**60 + 3, None, 2**53 + 1, 5]
    _, found = table(spark, spark.createDataFrame([(i, "u", "same " * 50) for i in ids[:4]] + [(5, None, "own " * 50)], SHAPE).coalesce(1))
    got = {(r["page_id"], r["refers_to"], r["record_type"]) for r in found}
    assert got == {(2**60 + 1, 2**53 + 1, "revisit"), (2**60 + 3, 2**53 + 1, "revisit"), (None, 2**53 + 1, "revisit"), (2**53 + 1, None, "response"), (5, None, "response")}


def test_reruns_agree_and_lost_attempts_are_not_read(spark):
    rows = spark.createDataFrame([(i, "u", f"<p>{'long page ' * 9000 if i % 2 else 'text'} {i}") for i in range(50)], SHAPE)
    one, two = (wa.write_archives(rows, Scratch(spark, "test").path("warc")) for _ in range(2))
    first, second = ([(r["records"], r["bytes"]) for r in m.orderBy("path").collect()] for m in (one, two))
    assert first == second
    store, file = wa.open_store(one.first()["path"])
    with store.open_output_stream(f"{file.rpartition('/')[0]}/pages-00000-000-99.warc.zst") as out:
        out.write(b"half a file")
    assert wa.read_archives(one).count() == 50


def test_a_hot_payload_is_dealt_over_tasks(spark, monkeypatch):
    from lakesync.llm import common

    monkeypatch.setattr(common, "HOT_LEAST", 10)
    _, found = table(spark, spark.createDataFrame([(i, "u", "hot " * 50) for i in range(100)] + [(200 + i, "u", f"own {i} " * 50) for i in range(9)], SHAPE))
    assert sorted((r["page_id"], r["refers_to"]) for r in found if r["record_type"] == "revisit") == [(i, 0) for i in range(1, 100)]
    assert len(found) == 109
