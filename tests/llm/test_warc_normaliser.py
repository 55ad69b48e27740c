"""Monolithic archives, members, offsets and revisits against brute force."""

import gzip
import hashlib
import io
import json
import os
import zlib

import pytest

from candlewick.llm import warc_normaliser as W
from candlewick.llm.common import prepare
from candlewick.session import scratch_path

SCHEMA = "page_id bigint, url string, html string, record_type string"


def pages():
    long = "<p>é" + "x" * 200 + "</p>"
    rows = [(i, f"http://a.example/{i}?q= \n", f"<html>{i}" + "y" * (i * 7)) for i in range(60)]
    rows += [(100 + i, None, long) for i in range(5)] + [(90, "u", long), (91, "u", "small"), (92, "u", "small"),
                                                         (93, "u", ""), (94, "u", None), (95, "big", "z" * 3_000_000)]
    return [(*r, "clash") for r in rows + [rows[0], (90, "u", long), (None, "n", long), (None, "n", "q" * 150)]]


def slow(rows):
    least = {}
    for p, _, h, _ in rows:
        if p is not None and len((h or "").encode()) >= 100:
            least[h] = min(p, least.get(h, p))
    out = []
    for p, _, h, _ in rows:
        b = (h or "").encode()
        ref = least.get(h) if least.get(h) != p else None
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if ref is not None else "response", ref))
    return sorted(out, key=str)


def test_pages_are_read_back(spark):
    prepare(spark)
    df = spark.createDataFrame(pages(), SCHEMA).repartition(4)
    assert sorted(map(tuple, W.archive_pages(df).collect()), key=str) == slow(pages())
    assert W.archive_pages(df.limit(0)).collect() == []


def test_members_offsets_and_rolling(spark):
    prepare(spark)
    root = scratch_path(spark, "warc-test").removeprefix("file:")
    raw, done, index = (f"{root}/{x}" for x in ("whole", "records", "index"))
    df = spark.createDataFrame(pages(), SCHEMA).repartition(2)
    files = W.write_monolithic(df, raw, archive_bytes=5000)
    assert files.count() > 2
    assert sum(r.records for r in W.normalise(files, raw, done, index).collect()) == len(pages())
    for name in sorted(os.listdir(raw)):
        if not name.endswith(".warc.gz"):
            continue
        own, = (x for x in os.listdir(done) if x.startswith(name.removesuffix(".warc.gz")))  # and its attempt
        whole, members = open(f"{raw}/{name}", "rb").read(), open(f"{done}/{own}", "rb").read()
        one = zlib.decompressobj(31)
        assert one.decompress(whole) == gzip.decompress(members) and one.eof and not one.unused_data
        end = 0
        for line in open(f"{index}/{own}.json"):
            e = json.loads(line)
            assert e["offset"] == end
            end += e["length"]
            got = zlib.decompress(members[e["offset"]:end], 31)
            assert got.startswith(b"WARC/1.1\r\n") and got.endswith(b"\r\n\r\n") and W.read_record(got)[0] == e["page_id"]
        assert end == len(members)


def test_streams_of_members_long_records_and_damage():
    recs = [W.record(i, "u", b"x" * n, n, hashlib.sha256(b"x" * n).hexdigest(), None)
            for i, n in enumerate((0, 10, 500_000, 3))]
    for data in (gzip.compress(b"".join(recs)), b"".join(map(gzip.compress, recs))):
        out = io.BytesIO()
        assert len(list(W.normalise_stream(io.BytesIO(data), out))) == 4
        assert gzip.decompress(out.getvalue()) == b"".join(recs)
        with pytest.raises((ValueError, zlib.error)):
            list(W.normalise_stream(io.BytesIO(data[:-30]), io.BytesIO()))
    with pytest.raises(ValueError):
        W.read_record(recs[1].replace(b"x" * 10, b"x" * 9 + b"y"))


def test_files_of_other_attempts_change_nothing(spark, tmp_root, monkeypatch):
    """A late or speculative attempt leaves whole archives and sidecars beside the committed ones."""
    prepare(spark)
    rows = [(i, f"http://x/{i}", f"<p>page {i}</p>" * 20) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    normalise = W.normalise

    def twice(files, raw, root, index):
        normalise(files.limit(1), raw, root, index)  # an attempt whose result nobody takes
        return normalise(files, raw, root, index)

    monkeypatch.setattr(W, "normalise", twice)
    W.write_monolithic(pages.limit(7), f"{tmp_root}/whole")  # another attempt's archives
    got = W.archive_pages(pages, tmp_root).collect()
    assert sorted(r.page_id for r in got) == list(range(40))
    import os
    from candlewick.session import local_fs_path
    assert len(os.listdir(local_fs_path(f"{tmp_root}/index"))) > spark.read.json(f"{tmp_root}/index").select("file").distinct().count() - 1
