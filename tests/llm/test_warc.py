"""Archives written, searched and read back, against the pages themselves."""

import base64
import gzip
import hashlib

import pytest

from clausewise.llm import warc
from clausewise.session import shared_dir

SCHEMA = "page_id long, url string, html string, key string, name string, archive int"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "mine", "x", 1) for r in rows], SCHEMA).repartition(partitions)


def brute(rows, revisit_from=0):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        data, low = (html or "").encode(), first.get(html or "")
        again = len(data) >= revisit_from and low is not None and page_id != low
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if again else "response", low if again else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    some = [(i, f"http://Host{i % 7}.Example.com:80/p/{i}?q=1#top", f"<html>{i // 3}</html>\r\n\r\nü") for i in range(200)]
    some += [(900 + i, "https://hot.example.org/", "same page") for i in range(300)]
    some += [(5000, None, None), (5001, "", ""), (5002, "no host at all", "x" * 300000), (5003, "http://a b\r\n.c/é  ", "WARC/1.1\r\n\r\n")]
    some += [(6000, "http://r.com/", "repeated")] * 3 + [(6001, "http://r.com/", "repeated"), (None, "http://r.com/", "repeated"), (None, None, "alone")]
    return some


@pytest.fixture(scope="module")
def written(spark, rows):
    path = shared_dir(spark)
    warc.write(frame(spark, rows), path)
    return path


def plain(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_round_trip(spark, rows, written):
    found = warc.find_captures(spark, written, frame(spark, rows), by_page=True)
    got = warc.fetch(written, found)
    assert plain(got) == brute(rows)
    html = {r[0]: r[2] or "" for r in rows if r[0] is not None}
    for r in got.collect():
        if r.record_type == "response" and r.page_id is not None:
            assert bytes(r.payload).decode() == html[r.page_id]
        if r.record_type == "revisit":
            assert r.payload is None and html[r.refers_to] == html.get(r.page_id, "repeated")


def test_search_by_url(spark, rows, written):
    urls = ["HTTPS://user@HOT.example.org/#x", "http://host3.example.com/p/3?q=1", "http://nowhere.example.org/", "http://r.com/"]
    queries = spark.createDataFrame([(u, i, "mine") for i, u in enumerate(urls)], "url string, page_id int, key string")
    got = sorted((r.key, r.page_id) for r in warc.find_captures(spark, written, queries).collect() if r.page_id is not None)
    wanted = [("com,example,host3)/p/3?q=1", 3), ("com,r)/", 6000), ("com,r)/", 6000), ("com,r)/", 6000), ("com,r)/", 6001)]
    assert got == sorted(wanted + [("org,example,hot)/", 900 + i) for i in range(300)])


def test_files_are_warc(spark, written):
    store, at = warc.open_store(f"{written}/archive")
    names = {r.archive for r in spark.read.parquet(f"{written}/captures").select("archive").distinct().collect()}
    for name in names:
        with store.open_input_file(f"{at}/{name}") as f:
            data = gzip.decompress(f.read())
        records = 0
        while data:  # a reader that knows nothing of the index
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            size = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n"
            data, records = rest[size + 4 :], records + 1
        assert records == spark.read.parquet(f"{written}/captures").where(f"archive = '{name}'").count() + 1


def test_small_blocks_and_bounds(spark, rows):
    path = shared_dir(spark)
    captures = [(f"k{i % 5}", i // 9, "a", i, 1) for i in range(500)] + [("k1", None, "a", -1, 1)]
    frame = spark.createDataFrame(captures, warc.CAPTURES)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    warc.write_index(frame.repartition(4), path, lines=7)
    spark.conf.unset(merging)
    parts = [tuple(r) for r in spark.read.parquet(f"{path}/parts").collect()]
    assert len(parts) > 1
    index, order = warc.Index(path, parts), lambda c: (warc._entry(*c[:2]), c[3])
    for low, high in [(("k1", None), ("k1", 7)), (("k3", 4), ("k3", 4)), (("k", 0), ("z", 0)), (("k9", 0), ("k9", 9)), (("k1", None), ("k1", None))]:
        wanted = [c for c in captures if warc._entry(*low) <= warc._entry(*c[:2]) <= warc._entry(*high)]
        assert sorted(index.find(warc._entry(*low), warc._entry(*high)), key=order) == sorted(wanted, key=order)


def test_smallest_size_of_revisits(spark):
    path, rows = shared_dir(spark), [(1, "u", "ab"), (2, "u", "ab"), (3, "v", "a longer one"), (4, "v", "a longer one")]
    warc.write(frame(spark, rows), path, revisit_from=5)
    got = warc.fetch(path, spark.read.parquet(f"{path}/captures"))
    assert plain(got) == brute(rows, 5)


def test_tampered_payload():
    data = warc.page_record(1, "http://x/", b"payload", None)
    assert warc.read_record(data)[1] == b"payload"
    with pytest.raises(ValueError):
        warc.read_record(data.replace(b"payload\r\n", b"pAyload\r\n"))


def test_empty(spark):
    path = shared_dir(spark)
    warc.write(frame(spark, []), path)
    assert warc.fetch(path, warc.find_captures(spark, path, frame(spark, [(1, "http://x/", "")]), by_page=True)).count() == 0
