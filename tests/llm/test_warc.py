import hashlib
import os
import random
import zlib

import pytest

from snapledger.llm import warc
from snapledger.session import new_dir

LONG = "<p>" + "word " * 60 + "</p>"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, path string, position long").repartition(3)


def messy_pages():
    rng = random.Random(5)
    rows = [(9, "http://a/1", LONG), (4, "http://a/ü?x=1%20&y=\r\nEvil: 1", LONG), (6, None, LONG), (1, "u", None), (2, "u", ""), (3, "u", "short"), (5, "u", "short")]
    rows += [(20 + k, f"http://h/{k}", "".join(chr(rng.choice([10, 13, 65, 228, 20013, 128512])) for _ in range(rng.randint(0, 4000)))) for k in range(30)]
    rows += [(60, "big", "z" * 500_000), (61, "http", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n" * 20)]
    return rows


@pytest.mark.parametrize("split", [warc.SPLIT_BYTES, 700])
def test_round_trip(spark, split):
    rows = messy_pages()
    manifest = warc.write_archives(pages(spark, rows), new_dir(spark, "warc"))
    got = {r.page_id: r for r in warc.read_archives(spark, manifest, split_bytes=split).collect()}
    assert len(got) == len(rows)
    first = {}
    for i, _, html in rows:
        first[html or ""] = min(i, first.get(html or "", i))
    for i, url, html in rows:
        data, r = (html or "").encode(), got[i]
        revisit = len(data) >= 100 and first[html or ""] != i
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", first[html]) if revisit else ("response", None))
        assert r.url == url
        assert r.payload is None if revisit else bytes(r.payload) == data


def test_archives_are_plain_gzip_members(spark):
    manifest = warc.write_archives(pages(spark, messy_pages()), new_dir(spark, "warc")).collect()
    assert sum(m.records for m in manifest) == len(messy_pages())
    for m in manifest:
        data, records = open(m.path.removeprefix("file:"), "rb").read(), 0
        while data:
            unpack = zlib.decompressobj(31)
            text = unpack.decompress(data)
            assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            data, records = unpack.unused_data, records + 1
        assert records == m.records


def test_noise_between_members_and_false_magic_are_passed_over(spark, tmp_path):
    good = [warc.record(i, "u", b"payload %d" % i, hashlib.sha256(b"payload %d" % i).hexdigest(), None, "2020-01-01T00:00:00Z") for i in range(3)]
    other = zlib.compressobj(6, zlib.DEFLATED, 31)
    no_warc = other.compress(b"no record at all") + other.flush()
    data = warc.MAGIC + b"noise" + good[0] + no_warc + good[1][:-9] + good[2] + warc.MAGIC
    path = os.path.join(tmp_path, "a.warc.gz")
    open(path, "wb").write(data)
    manifest = spark.createDataFrame([(path, len(data), 3)], warc.MANIFEST_SCHEMA)
    for split in (13, 100, 1 << 20):
        assert sorted(r.page_id for r in warc.read_archives(spark, manifest, split_bytes=split).collect()) == [0, 2]


def test_repeated_rows_missing_ids_and_an_empty_table(spark):
    rows = [(3, "u", LONG), (3, "u", LONG), (None, "u", LONG), (8, "u", LONG)]
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to) for r in warc.round_trip(pages(spark, rows)).collect()), key=str)
    assert got == [(0, "response", None), (3, "response", None), (3, "response", None), (8, "revisit", 3)]
    assert warc.round_trip(pages(spark, rows).filter("page_id < 0")).collect() == []
