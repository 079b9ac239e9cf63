"""WARC archives of pages with a two-level capture index (operator 13).

``write`` makes one WARC record per page, each a gzip member of its own in a ``.warc.gz`` file, and
notes where it lies. Of equal payloads the one with the smallest page_id is written as a response, the others as revisits
of it (HTTP head alone). Pages are written by the tasks that hold them; a file counts only if the table
of captures that Spark commits names it, so retried tasks leave files that nobody reads, and nothing else.

The captures are sorted by (key, page_id), the key being the URL with its host reversed (``com,example)/path``), and
written as compressed blocks of LINES lines. A part of the index has a block file and a sparse directory with
the first entry of each block. ``lookup`` finds an entry by three binary searches: the part among
the parts' first entries (one row per part, so their number is bounded by the number of tasks that wrote
the index), the block in the part's directory, the line in the block; only that block is read. ``fetch`` sorts
captures by file and place and reads ranges, neighbours at once.

Files are read and written through ``pyarrow.fs``, under the folder given; it has to be one that all executors reach.

A null html is an empty payload, a null URL an empty key (and no WARC-Target-URI). A row without page_id revisits the
smallest page_id of its payload, if there is one. Repeated rows stay; those with the smallest page_id of a payload
are all responses. Key and page_id need not be unique: a lookup returns all captures of an entry. Payloads
of fewer than ``revisit_from`` bytes are all responses. An empty table gives no archive and an empty index. Other columns
are not used, whatever their names.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausewise.llm.common import lookup as join_few_hot
from clausewise.llm.common import small_batches, table
from clausewise.session import materialise, shared_dir

ARCHIVE_BYTES = 256 << 20
LINES = 2000
#: Neighbouring records are read at once up to so many bytes.
READ_BYTES = 4 << 20
#: Compressed records that a task reads.
TASK_BYTES = 64 << 20
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = "key string, page_id long, archive string, offset long, length long"
RECORDS = "page_id long, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file, given as a path or URI."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def with_key(rows: DataFrame) -> DataFrame:
    """rows with ``key``: url with its host reversed, without scheme, user, fragment and default port, blanks as %20."""
    bare = F.regexp_replace(F.coalesce("url", F.lit("")), r"(?s)#.*$", "")
    staged = rows.withColumn("_rest", F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""))
    staged = staged.withColumn("_host", F.regexp_extract("_rest", r"^[^/?]*", 0))
    name = F.regexp_replace(F.lower("_host"), r"^.*@|:(80|443)?$", "")
    turned = F.array_join(F.reverse(F.split(name, r"\.")), ",")
    key = F.concat(turned, F.lit(")"), F.substr("_rest", F.length("_host") + 1))
    spelled = F.when(F.col("_rest") == "", "").otherwise(F.regexp_replace(key, r"[\x00-\x20\x7f]", "%20"))
    return staged.withColumn("key", spelled).drop("_rest", "_host")


def _revisits(named: DataFrame, revisit_from: int) -> DataFrame:
    """(page_id, name, refers_to) of the pages whose payload has a smaller page_id; names stand for payloads."""
    thin = materialise(named.where(F.octet_length("html") >= revisit_from).select("page_id", "name"))
    groups = thin.groupBy("name").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_uses")).where("_uses > 1")
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("refers_to"))
    met = join_few_hot(thin, groups, "name", thin.count())
    return met.where(later & F.col("refers_to").isNotNull()).select("page_id", "name", "refers_to").distinct()


class _Archive:
    """A growing file of gzip members."""

    def __init__(self, folder: str) -> None:
        self.name, self.size = f"{uuid.uuid4().hex}.warc.gz", 0
        store, at = open_store(folder)
        self.out = store.open_output_stream(f"{at}/{self.name}", compression=None, buffer_size=1 << 20)
        head = b"software: clausewise\r\nformat: WARC File Format 1.1\r\n"
        self.add(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("Content-Type", "application/warc-fields")], head))

    def add(self, record: bytes) -> tuple[int, int]:
        member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        data = member.compress(record) + member.flush()
        self.out.write(data)
        self.size += len(data)
        return self.size - len(data), len(data)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("WARC-Date", DATE), ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _urn(page_id: int | None) -> str:
    return "<urn:x-page:none>" if page_id is None else f"<urn:x-page:{page_id}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or a revisit without the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _urn(page_id))]
    if url is not None:
        fields.append(("WARC-Target-URI", _UNSAFE.sub(lambda x: f"%{ord(x[0]):02X}", url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if refers_to is not None:
        fields += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Type", "application/http; msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _record(fields, http + payload if refers_to is None else http)


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = [x.partition(": ") for x in head.decode().split("\r\n")[1:]]
    return {name: value for name, _, value in lines}, rest


def read_record(data: bytes) -> tuple:
    """(page_id, payload, payload_bytes, payload_digest, record_type, refers_to) of a page's record; checked."""
    fields, rest = _headers(data)
    block = rest[: int(fields["Content-Length"])]
    http, payload = _headers(block)
    kind, size, digest = fields["WARC-Type"], int(http["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (len(payload), found) != (size, digest):
            raise ValueError(f"{fields['WARC-Record-ID']}: payload does not agree with its digest")
    number = lambda urn: None if urn in (None, _urn(None)) else int(urn[len("<urn:x-page:") : -1])
    page_id, refers_to = number(fields["WARC-Record-ID"]), number(fields.get("WARC-Refers-To"))
    return page_id, payload if kind == "response" else None, size, digest, kind, refers_to


def write(pages: DataFrame, path: str, revisit_from: int = 0) -> None:
    """Archives of (page_id, url, html), their captures and the index of these, in the folder ``path``."""
    html = F.coalesce("html", F.lit(""))
    rows = with_key(pages.select("page_id", "url", html.alias("html")))
    named = rows.withColumn("name", F.substring(F.unhex(F.sha2("html", 256)), 1, 16))
    found = _revisits(named, revisit_from).select(F.col("page_id").alias("p"), F.col("name").alias("n"), "refers_to")
    typed = named.join(found, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("name") == F.col("n")), "left")
    typed = typed.select("key", "page_id", "url", F.encode("html", "UTF-8").alias("payload"), "refers_to")
    store, at = open_store(f"{path}/archive")
    store.create_dir(at, recursive=True)
    archive_bytes = ARCHIVE_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in small_batches(batches):
            out = []
            for key, page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                archive = archive or _Archive(f"{path}/archive")
                place = archive.add(page_record(page_id, url, payload, refers_to))
                out.append((key, page_id, archive.name, *place))
                if archive.size >= archive_bytes:
                    archive.out.close()
                    archive = None
            yield _batch(out, CAPTURES)
        if archive:
            archive.out.close()

    typed.mapInArrow(run, CAPTURES).write.parquet(f"{path}/captures")
    write_index(pages.sparkSession.read.schema(CAPTURES).parquet(f"{path}/captures"), path)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _entry(key: str, page_id: int | None) -> tuple[str, bool, int]:
    """What entries are sorted by, as Spark sorts them: a missing page_id comes first."""
    return key, page_id is not None, page_id or 0


def _parse(line: str) -> tuple:
    key, page_id, archive, offset, length = line.split(" ")
    return key, None if page_id == "-" else int(page_id), archive, int(offset), int(length)


def write_index(captures: DataFrame, path: str, lines: int = LINES) -> None:
    """Sorted captures in compressed blocks, a sparse directory per part, and one row per part."""
    store, at = open_store(f"{path}/index")
    store.create_dir(at, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, size, held, directory = uuid.uuid4().hex, None, 0, [], []
        last = None

        def close_block() -> None:
            nonlocal size
            key, page_id = held[0].split(" ")[:2]
            data = zlib.compress("\n".join(held).encode(), LEVEL)
            out.write(data)
            directory.append(f"{key} {page_id} {name}.blocks {size} {len(data)}")
            size += len(data)
            held.clear()

        store, at = open_store(f"{path}/index")
        for batch in small_batches(batches, lines):
            for key, page_id, archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                out = out or store.open_output_stream(f"{at}/{name}.blocks", compression=None, buffer_size=1 << 20)
                page = "-" if page_id is None else page_id
                held.append(f"{key} {page} {archive} {offset} {length}")
                last = (key, page_id)
                if len(held) == lines:
                    close_block()
        if out:
            if held:
                close_block()
            out.close()
            data = zlib.compress("\n".join(directory).encode(), LEVEL)
            with store.open_output_stream(f"{at}/{name}.directory", compression=None) as whole:
                whole.write(data)
            key, page_id = _parse(directory[0])[:2]
            yield _batch([(key, page_id, *last, name)], "key string, page_id long, last_key string, last_page long, part string")

    spread = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    parts = spread.mapInArrow(run, "key string, page_id long, last_key string, last_page long, part string")
    parts.write.parquet(f"{path}/parts")


class Index:
    """Search in a written index, for use inside a task; it holds one directory and one block."""

    def __init__(self, path: str, parts: list[tuple]) -> None:
        """parts: (key, page_id, last_key, last_page, part), one of each part."""
        self.store, self.at = open_store(f"{path}/index")
        self.parts = sorted(parts, key=lambda x: _entry(*x[:2]))
        self.firsts = [_entry(*x[:2]) for x in self.parts]
        self.lasts = [_entry(*x[2:4]) for x in self.parts]
        self._part = self._block = (None, [], [])

    def _directory(self, number: int) -> tuple[list, list]:
        if self._part[0] != number:
            with self.store.open_input_file(f"{self.at}/{self.parts[number][4]}.directory") as f:
                rows = [_parse(x) for x in zlib.decompress(f.read()).decode().split("\n")]
            self._part = (number, [_entry(*x[:2]) for x in rows], rows)
        return self._part[1:]

    def _lines(self, file: str, offset: int, length: int) -> tuple[list, list]:
        if self._block[0] != (file, offset):
            with self.store.open_input_file(f"{self.at}/{file}") as f:
                rows = [_parse(x) for x in zlib.decompress(f.read_at(length, offset)).decode().split("\n")]
            self._block = ((file, offset), [_entry(*x[:2]) for x in rows], rows)
        return self._block[1:]

    def find(self, low: tuple, high: tuple) -> Iterator[tuple]:
        """All captures from the entry low to the entry high, in order."""
        # the part and the block before the first that begins after low may end with it
        number = bisect.bisect_left(self.lasts, low)
        while number < len(self.parts) and self.firsts[number] <= high:
            firsts, blocks = self._directory(number)
            block = max(0, bisect.bisect_left(firsts, low) - 1)
            while block < len(blocks) and firsts[block] <= high:
                keys, rows = self._lines(*blocks[block][2:])
                for at in range(bisect.bisect_left(keys, low), bisect.bisect_right(keys, high)):
                    yield rows[at]
                block += 1
            number += 1


def find_captures(spark: SparkSession, path: str, queries: DataFrame, by_page: bool = False) -> DataFrame:
    """Captures of the URLs in queries (url), or of (url, page_id) if ``by_page``; each once."""
    parts = [tuple(r) for r in spark.read.parquet(f"{path}/parts").collect()]  # one row per task that wrote the index
    page = F.col("page_id") if by_page else F.lit(None).cast("long")
    keyed = with_key(queries.select("url", page.alias("page_id"))).select("key", "page_id")
    spread = keyed.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, before = Index(path, parts), None
        for batch in small_batches(batches):
            out = []
            for query in zip(*(c.to_pylist() for c in batch.columns)):
                if query != before:
                    low = _entry(*query)
                    out += index.find(low, low if by_page else (query[0], True, 1 << 63))
                    before = query
            yield _batch(out, CAPTURES)

    return spread.mapInArrow(run, CAPTURES)


def fetch(path: str, captures: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of captures, by range reads: columns as in RECORDS, the payload left out if it is not wanted."""

    def read(rows: list[tuple]) -> Iterator[bytes]:
        """Members of one file in order; those that follow each other are read together."""
        store, at = open_store(f"{path}/archive")
        with store.open_input_file(f"{at}/{rows[0][0]}") as f:
            start = 0
            while start < len(rows):
                end = start + 1
                begin, stop = rows[start][1], rows[start][1] + rows[start][2]
                while end < len(rows) and rows[end][1] == stop and stop - begin < READ_BYTES:
                    stop += rows[end][2]
                    end += 1
                data = f.read_at(stop - begin, begin)
                for _, offset, length in rows[start:end]:
                    yield zlib.decompress(data[offset - begin : offset - begin + length], 31)
                start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows, out = list(zip(*(c.to_pylist() for c in batch.columns))), []
            cuts = [i for i in range(len(rows) + 1) if i in (0, len(rows)) or rows[i][0] != rows[i - 1][0]]
            for a, b in zip(cuts, cuts[1:]):
                for data in read(rows[a:b]):
                    page_id, payload, *others = read_record(data)
                    out.append((page_id, payload if payloads else None, *others))
            yield _batch(out, RECORDS)

    # the rows are thin, what is read for them is not: tasks by the bytes to read, not by the size of the rows
    places = materialise(captures.select("archive", "offset", "length"))
    size = places.agg(F.sum("length")).first()[0] or 0
    tasks = max(places.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES + 1)
    spread = places.repartitionByRange(int(tasks), "archive", "offset").sortWithinPartitions("archive", "offset")
    records = spread.mapInArrow(run, RECORDS)
    return records if payloads else records.drop("payload")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages, look every one up in the index and read it back."""
    pages, path = table(spark, sf_dir, "pages"), shared_dir(spark)
    write(pages, path)
    return fetch(path, find_captures(spark, path, pages, by_page=True), payloads=False)


ORACLE = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
           min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
)
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id > first OR (page_id IS NULL AND first IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first OR page_id IS NULL THEN first END AS refers_to
FROM p
"""
