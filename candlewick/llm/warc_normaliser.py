"""WARC archives: written as one gzip stream each, normalised to one member per record, read by offset.

1. Pages are classified on Spark: the smallest page_id of equal payloads is a response, the others revisit it.
2. Each task writes its records to monolithic archives (one gzip stream for a whole file), which roll over
   at a bounded size.
3. The normaliser inflates such a stream once, in pieces, rewrites every record as its own gzip member and
   writes a sidecar offset index (JSON lines).  Memory is one piece, however long a record is.
4. The reader is a scan of the sidecars: each record is fetched by its offset alone.

Files go to a shared folder (a URI that pyarrow's file systems open: a mount, object store or HDFS).  They are
written under a task's own name and then moved, so a repeated task replaces equal content.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import staged
from candlewick.session import scratch_path

#: Smaller payloads are always written in full.
REVISIT_BYTES = 100
#: Uncompressed bytes after which an archive is closed (the record that passes it is its last).
ARCHIVE_BYTES = 128 << 20
PIECE = 1 << 16
WHOLE_LEVEL, MEMBER_LEVEL = 1, 5
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the tables carry no time of capture
GZIP = 31

INDEX = "file string, offset bigint, length bigint, record_id string, type string, page_id bigint"
READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def classified(pages: DataFrame) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, refers_to)`` of each row.

    Payloads are equal if their SHA-256 is.  Rows that repeat the smallest page_id are responses as
    well; a null page_id revisits any response that has an id.
    """
    df = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                      F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    df = df.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"),
                         "payload_digest": F.sha2("payload", 256)})
    large = F.col("payload_bytes") >= REVISIT_BYTES
    least = (df.filter(large).groupBy(F.col("payload_digest").alias("__key"))
             .agg(F.min("page_id").alias("__least")))
    # small payloads get keys of their own, which meet nothing
    key = F.when(large, F.col("payload_digest")).otherwise(F.concat(F.lit("small "), F.xxhash64("page_id", "url")))
    out = df.withColumn("__key", key).join(least, "__key", "left")
    other = F.col("__least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__least"))
    return out.select("page_id", "url", "payload", "payload_bytes", "payload_digest",
                      F.when(other, F.col("__least")).alias("refers_to"))


def record_urn(page_id: int | None, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str,
           refers_to: int | None) -> bytes:
    """One WARC record: HTTP head and payload, or the head alone for a revisit."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<{record_urn(page_id, digest)}>"), ("WARC-Date", DATE),
            ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block)))]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if page_id is not None:
        head.append(("Page-Id", str(page_id)))
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<{record_urn(refers_to, digest)}>"), ("WARC-Profile", PROFILE),
                 ("Refers-To-Page-Id", str(refers_to))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


def parsed_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


class Inflated:
    """Bytes of a gzip file (of one stream or of many members), inflated piece by piece."""

    def __init__(self, source):
        self.source, self.engine, self.kept, self.over = source, zlib.decompressobj(GZIP), b"", False
        self.open = False

    def more(self) -> bool:
        """Adds a piece to ``kept``; False at the end."""
        while not self.over:
            raw = self.engine.unconsumed_tail or self.source.read(PIECE)
            if not raw and not self.open:
                self.over = True
                break
            got = self.engine.decompress(raw, PIECE)  # without input: what the engine still holds
            if not (raw or got or self.engine.eof):
                raise ValueError("the gzip stream ends early")
            self.open = True
            if self.engine.eof:
                rest = self.engine.unused_data
                self.engine, self.open = zlib.decompressobj(GZIP), False
                if rest:
                    self.source = _Before(rest, self.source)
            if got:
                self.kept += got
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the stream."""
        seen = 0
        while (at := self.kept.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.kept)
            if not self.more():
                if self.kept:
                    raise ValueError("the stream ends inside a record's head")
                return None
        out, self.kept = self.kept[:at + len(mark)], self.kept[at + len(mark):]
        return out

    def pieces(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.kept and not self.more():
                raise ValueError("the stream ends inside a record")
            out, self.kept = self.kept[:size], self.kept[size:]
            size -= len(out)
            yield out


class _Before:
    """A reader that gives ``first`` before the rest of ``source``."""

    def __init__(self, first: bytes, source):
        self.first, self.source = first, source

    def read(self, n: int) -> bytes:
        if self.first:
            out, self.first = self.first[:n], self.first[n:]
            return out
        return self.source.read(n)


def normalise_stream(source, sink) -> Iterator[dict]:
    """Rewrite the records of a gzip stream as members of ``sink``; gives each one's index entry."""
    stream, offset = Inflated(source), 0
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = parsed_head(head)
        member = zlib.compressobj(MEMBER_LEVEL, zlib.DEFLATED, GZIP)
        start = offset
        for part in (head, *stream.pieces(int(fields["content-length"]) + 4)):
            if got := member.compress(part):
                sink.write(got)
                offset += len(got)
        got = member.flush()
        sink.write(got)
        offset += len(got)
        page = fields.get("page-id")
        yield {"offset": start, "length": offset - start, "record_id": fields["warc-record-id"].strip("<>"),
               "type": fields["warc-type"], "page_id": None if page is None else int(page)}


def _file_system(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root)


def _write_batches(batches: Iterator[pa.RecordBatch], root: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    fs, base = _file_system(root)
    part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
    done, out, size = [], None, 0

    def close():
        nonlocal out
        out.write(engine.flush())
        out.close()
        fs.move(temp, f"{base}/{name}")
        done.append(name)
        out = None

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if out is None:
                # An attempt's own names: one that ends late, or runs beside another, replaces nothing.
                name, size = f"part-{part:05d}-{attempt}-{len(done):05d}.warc.gz", 0
                temp = f"{base}/_{attempt}-{name}"
                out, engine = fs.open_output_stream(temp, compression=None), zlib.compressobj(WHOLE_LEVEL, zlib.DEFLATED, GZIP)
            data = record(*row)
            out.write(engine.compress(data))
            size += len(data)
            if size >= archive_bytes:
                close()
    if out is not None:
        close()
    yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["file"])


def _normalise_batches(batches: Iterator[pa.RecordBatch], raw: str, root: str, index: str) -> Iterator[pa.RecordBatch]:
    (fs, src), (_, dst), (_, idx) = _file_system(raw), _file_system(root), _file_system(index)
    attempt = TaskContext.get().taskAttemptId()
    for b in batches:
        files, counts = b.column(0).to_pylist(), []
        for i, file in enumerate(files):
            name = files[i] = f"{file.removesuffix('.warc.gz')}-{attempt}.warc.gz"
            n, temps = 0, (f"{dst}/_{name}", f"{idx}/_{name}.json")
            with fs.open_input_stream(f"{src}/{file}", compression=None) as source, \
                    fs.open_output_stream(temps[0], compression=None) as sink, \
                    fs.open_output_stream(temps[1], compression=None) as side:
                for entry in normalise_stream(source, sink):
                    side.write(json.dumps({"file": name, **entry}).encode() + b"\n")
                    n += 1
            fs.move(temps[0], f"{dst}/{name}")
            fs.move(temps[1], f"{idx}/{name}.json")
            counts.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(counts, pa.int64())],
                                         names=["file", "records"])


def read_record(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page_id, payload bytes, payload digest, type, refers_to) of one inflated record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = parsed_head(head)
    http, _, payload = rest[:int(fields["content-length"])].partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if fields["warc-type"] == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    page, refers = fields.get("page-id"), fields.get("refers-to-page-id")
    return (None if page is None else int(page), size, digest, fields["warc-type"],
            None if refers is None else int(refers))


def _read_batches(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    fs, base = _file_system(root)
    name, source = None, None
    for b in batches:
        rows = []
        for file, offset, length in zip(*(c.to_pylist() for c in b.columns)):
            if file != name:
                if source:
                    source.close()
                name, source = file, fs.open_input_file(f"{base}/{file}")
            source.seek(offset)
            rows.append(read_record(zlib.decompress(source.read(length), GZIP)))
        if rows:
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                             names=["page_id", "payload_bytes", "payload_digest", "record_type",
                                                    "refers_to"])
    if source:
        source.close()


def write_monolithic(pages: DataFrame, root: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` to archives of one gzip stream each in ``root``; returns their names."""
    fs, base = _file_system(root)
    fs.create_dir(base, recursive=True)
    names = classified(pages).mapInArrow(lambda x: _write_batches(x, root, archive_bytes), "file string")
    return staged(names, "warc-files")


def normalise(files: DataFrame, raw: str, root: str, index: str) -> DataFrame:
    """Normalise the archives ``files(file)`` of ``raw`` into ``root``, with sidecars in ``index``; returns
    (file, records) of the archives that committed attempts wrote (others may have left theirs beside them)."""
    for x in (root, index):
        fs, base = _file_system(x)
        fs.create_dir(base, recursive=True)
    n = max(1, files.count())
    out = files.repartition(n, "file").mapInArrow(lambda x: _normalise_batches(x, raw, root, index),
                                                   "file string, records bigint")
    return staged(out, "warc-normalised")


def read_index(index: DataFrame, root: str) -> DataFrame:
    """Records of the archives in ``root`` by the rows ``index(file, offset, length, ...)``."""
    return index.select("file", "offset", "length").mapInArrow(lambda x: _read_batches(x, root), READ)


def archive_pages(pages: DataFrame, root: str | None = None) -> DataFrame:
    """Write ``pages(page_id, url, html)`` to normalised archives below ``root`` and read them back.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to; one row for each page.  Defined
    cases: null html is the empty payload; null urls have no target; rows that repeat a page are written
    each; an empty table writes no archive and gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    root = root or scratch_path(spark, "warc")
    raw, done, index = f"{root}/whole", f"{root}/records", f"{root}/index"
    files = normalise(write_monolithic(pages, raw), raw, done, index)
    return read_index(spark.read.schema(INDEX).json(index).join(files.select("file"), "file"), done)
