"""WARC archives: writing them from a table, and normalising monolithic gzip files.

An archive compressed as one gzip stream can only be read from its start. The normaliser inflates such a
stream once, in pieces, rewrites every record as a gzip member of its own, and writes a sidecar index with
the offset and length of each member, so that single records can be read later.

Archives are written by Spark's text writer. The normaliser and the reader open files in tasks through
``pyarrow.fs``, so the folder for archives must be one that every executor reaches (a shared mount, HDFS, an
object store). Files are written under a name of their own and then moved, so a repeated task does no harm.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from plantmetrics.llm.arrow import map_columns, record_batch
from plantmetrics.sources import scratch_path, stage

# Line ends, digits of base 32 in both alphabets, and texts of the record format.
CRLF = "\r\n"
DIGITS_32, RFC_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"

INDEX_COLUMNS = "page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long"
PIECE = 1 << 20
#: Compression of normalised members: little larger than at level 6, in under half of the time.
LEVEL = 2


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a column: five hex digits at a time are four of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)]
    return F.translate(F.upper(F.concat(*parts)), DIGITS_32, RFC_32)


def page_records(pages: DataFrame, min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """``record``: one WARC record per row of ``pages`` (page_id, url, html), as text without its last line ends.

    A null html is an empty payload. Of rows with equal payloads of at least ``min_revisit_bytes`` bytes, those
    with the smallest page_id are responses (more than one if the row is repeated) and the others revisit it;
    all smaller ones are responses. A null page_id comes after all others and is never referred to unless no
    other row has the payload, in which case all are responses. Control characters and spaces in a url are
    escaped; a null or empty url is written as a urn of the page. Other columns are ignored.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    )
    rows = rows.withColumns({"digest": sha1_base32(F.col("html")), "size": F.octet_length("html").cast("long")})
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    first = first.where("copies > 1").select(F.col("digest").alias("shared"), "first")
    rows = rows.join(first, F.col("digest") == F.col("shared"), "left")
    revisit = (F.col("size") >= min_revisit_bytes) & (
        (F.col("page_id") > F.col("first")) | (F.col("page_id").isNull() & F.col("first").isNotNull())
    )
    rows = rows.withColumn("revisit", F.coalesce(revisit, F.lit(False)))
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\x00-\\x20\\x7F]", "%20")
    block = F.when(F.col("revisit"), F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), "html"))

    def header(key: str, value: Column) -> Column:
        return F.concat(F.lit(f"{key}: "), value)

    head = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        F.when(F.col("revisit"), F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        header("WARC-Record-ID", F.concat(F.lit("<"), name, F.lit(">"))),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", F.when(url == "", name).otherwise(url)),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        header("WARC-Payload-Length", F.col("size").cast("string")),
        F.when(F.col("revisit"), header("WARC-Refers-To", F.format_string("<urn:page:%d>", "first"))),
        F.when(F.col("revisit"), F.lit(f"WARC-Profile: {SAME_PAYLOAD}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        header("Content-Length", F.octet_length(block).cast("string")),
    )
    return rows.select(F.concat(head, F.lit(CRLF + CRLF), block).alias("record"))


def write_archives(records: DataFrame, folder: str) -> None:
    """Write ``record`` texts to gzip files of one stream each, one file per task."""
    records.select("record").write.option("compression", "gzip").option("lineSep", CRLF + CRLF).text(folder)


def _files(spark: SparkSession, folder: str, ending: str) -> DataFrame:
    """``path`` of the files; their content stays unread."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{ending}").load(folder)
    return found.select("path")


def _open(path: str):
    system, name = fs.FileSystem.from_uri(path)
    return system, name


class _Inflated:
    """Bytes of a gzip file, of one or several members, as a stream of bounded memory.

    A file that ends before its last member does (or before that member's trailer) is an error.
    """

    def __init__(self, raw):
        self.raw, self.inflater = raw, zlib.decompressobj(31)
        self.waiting, self.begun = b"", False
        self.ready, self.at = b"", 0  # what is inflated, and how much of it is taken

    def _more(self) -> bool:
        data = self.waiting or self.raw.read(PIECE)
        if not data:
            if self.begun and not self.inflater.eof:
                raise ValueError("archive ends inside a gzip member")
            return False
        if self.inflater.eof:
            self.inflater = zlib.decompressobj(31)
        self.begun = True
        self.ready = self.ready[self.at :] + self.inflater.decompress(data, PIECE)
        self.at = 0
        self.waiting = self.inflater.unconsumed_tail or self.inflater.unused_data
        return True

    def line(self) -> bytes:
        """Up to and with the next line feed; empty at the end."""
        searched = self.at
        while (end := self.ready.find(b"\n", searched)) < 0:
            searched = len(self.ready) - self.at
            if not self._more():
                end = len(self.ready) - 1
                break
        found = self.ready[self.at : end + 1]
        self.at = end + 1
        return found

    def pieces(self, size: int) -> Iterator[bytes]:
        while size:
            if self.at == len(self.ready) and not self._more():
                raise ValueError("archive ends inside a record")
            piece = self.ready[self.at : self.at + size]
            self.at += len(piece)
            size -= len(piece)
            if piece:
                yield piece


def _records(stream: _Inflated) -> Iterator[tuple[bytes, dict[str, str]]]:
    """(head, headers) of each record; the caller must take the block before the next one."""
    while line := stream.line():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head, headers = line, {}
        while (line := stream.line()).strip():
            head += line
            key, _, value = line.decode("utf-8", "replace").partition(":")
            headers[key.strip().lower()] = value.strip()
        yield head + b"\r\n", headers


def normalise_archives(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Rewrite every gzip archive in ``folder`` to ``target``: a member per record, and an index beside it.

    Returns ``(archive, sidecar, records, bytes)`` after all files are written. An empty archive gives an empty
    one with an empty index.
    """
    kind = StructType.fromDDL("archive string, sidecar string, records long, bytes long")
    arrow = to_arrow_schema(kind)

    def one(path: str) -> tuple[str, str, int, int]:
        source, name = _open(path)
        system, base = _open(target)
        stem = posixpath.join(base, posixpath.basename(name).split(".")[0])
        system.create_dir(base, recursive=True)
        trial, offset, count = f"{stem}.{uuid.uuid4().hex}.tmp", 0, 0
        with source.open_input_stream(name, compression=None) as raw, system.open_output_stream(
            f"{trial}.gz", compression=None
        ) as out, system.open_output_stream(f"{trial}.idx", compression=None) as index:
            stream = _Inflated(raw)
            for head, headers in _records(stream):
                deflater, start = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), offset
                offset += out.write(deflater.compress(head))
                for piece in stream.pieces(int(headers["content-length"])):
                    offset += out.write(deflater.compress(piece))
                offset += out.write(deflater.compress(b"\r\n\r\n") + deflater.flush())
                entry = {"offset": start, "length": offset - start, "id": headers.get("warc-record-id")}
                entry |= {"type": headers.get("warc-type"), "uri": headers.get("warc-target-uri")}
                entry |= {"digest": headers.get("warc-payload-digest")}
                index.write(json.dumps(entry).encode() + b"\n")
                count += 1
        system.move(f"{trial}.gz", f"{stem}.warc.gz")
        system.move(f"{trial}.idx", f"{stem}.warc.idx")
        return f"{stem}.warc.gz", f"{stem}.warc.idx", count, offset

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield record_batch([[value] for value in one(path)], arrow)

    return stage(_files(spark, folder, ".gz").mapInArrow(run, kind), "archives")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecar indexes as a table: ``archive`` (path), offset, length, id, type, uri, digest."""
    kind = "offset long, length long, id string, type string, uri string, digest string"
    rows = spark.read.schema(kind).option("pathGlobFilter", "*.warc.idx").json(folder)
    return rows.withColumn("archive", F.regexp_replace(F.input_file_name(), "\\.idx$", ".gz"))


def _page(name: str | None) -> int | None:
    number = (name or "").strip("<>").removeprefix("urn:page:")
    return int(number) if number else None


def read_records(index: DataFrame) -> DataFrame:
    """Read single records at the offsets of ``index``: the columns of ``INDEX_COLUMNS`` with archive and offset.

    Digest and size are taken anew from the payload of responses, and from the headers of revisits, which have
    none. A payload that doesn't fit its digest is an error.
    """

    def work(archives, offsets, lengths):
        system, found = {}, []
        for archive, offset, length in zip(archives, offsets, lengths, strict=True):
            if archive not in system:
                place, name = _open(archive)
                system = {archive: place.open_input_file(name)}
            data = zlib.decompress(system[archive].read_at(length, offset), 31)
            head, _, block = data.partition(b"\r\n\r\n")
            lines = (line.partition(b":") for line in head.split(b"\r\n")[1:])
            headers = {key.decode().lower(): value.strip().decode() for key, _, value in lines}
            digest = headers["warc-payload-digest"].removeprefix("sha1:")
            size, kind = int(headers["warc-payload-length"]), headers["warc-type"]
            if kind == "response":
                payload = block[: int(headers["content-length"])].partition(b"\r\n\r\n")[2]
                own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if own != digest or len(payload) != size:
                    raise ValueError(f"record at {offset} of {archive} doesn't fit its digest")
                digest, size = own, len(payload)
            refers = _page(headers.get("warc-refers-to"))
            found.append((_page(headers["warc-record-id"]), kind, refers, digest, size))
        columns = zip(*found, strict=True) if found else [[]] * 5
        return [*map(list, columns), archives, offsets]

    schema = INDEX_COLUMNS + ", archive string, offset long"
    return map_columns(index.select("archive", "offset", "length"), work, schema)


def archive_pages(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives, normalise them, and read every record back through the index.

    One row per row of ``pages``; see ``page_records`` for nulls and ties. An empty table gives no rows.
    """
    spark = pages.sparkSession
    base = folder or scratch_path(spark, "warc")
    write_archives(page_records(pages, min_revisit_bytes), f"{base}/raw")
    written = normalise_archives(spark, f"{base}/raw", f"{base}/normal").agg(F.sum("records")).first()[0]
    if not written:
        return spark.createDataFrame([], INDEX_COLUMNS + ", archive string, offset long")
    return read_records(read_index(spark, f"{base}/normal"))
