"""WARC archives: written as text by Spark, read by a Python data source that skips what is not asked for."""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from ruleframe.session import stage

#: Column and WARC header field; the ``Length`` field is an extension of ours.
FIELDS = {
    "warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To",
    "target_uri": "WARC-Target-URI", "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest",
    "payload_length": "WARC-Payload-Length", "content_type": "Content-Type",
}
_SCHEMA = ", ".join(f"{c} string" for c in FIELDS) + ", content_length long, payload binary"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcPartition(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class WarcReader(DataSourceReader):
    """Plans a partition per group of files, keeps the filters it can decide from headers, and
    decodes payloads of the records that pass them only."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.size = int(options.get("partitionbytes", 128 << 20))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            known = isinstance(f, (EqualTo, In, IsNotNull, StringStartsWith)) and len(f.attribute) == 1
            if known and f.attribute[0] in FIELDS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, root = fs.FileSystem.from_uri(self.path)
        infos = [store.get_file_info(root)]
        if infos[0].type == fs.FileType.Directory:
            infos = store.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted((i.path, i.size) for i in infos if i.type == fs.FileType.File and i.base_name[:1] not in "._")
        groups: list[list[str]] = []
        filled = self.size
        for path, size in files:
            if filled + size > self.size or not groups:
                groups.append([])
                filled = 0
            groups[-1].append(path)
            filled += size
        return [WarcPartition(g) for g in groups]

    def _wanted(self, record: dict[str, str]) -> bool:
        for f in self.filters:
            value = record.get(f.attribute[0])
            if isinstance(f, IsNotNull):
                passed = value is not None
            elif value is None:
                passed = False
            elif isinstance(f, EqualTo):
                passed = value == f.value
            elif isinstance(f, In):
                passed = value in f.value
            else:
                passed = value.startswith(f.value)
            if not passed:
                return False
        return True

    def read(self, partition: WarcPartition) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        names = [*FIELDS, "content_length", "payload"]
        kinds = [pa.string()] * len(FIELDS) + [pa.int64(), pa.binary()]
        rows, held = [], 0
        for path in partition.files:
            with store.open_input_file(path) as file:
                stream = io.BufferedReader(file, 1 << 20)
                if path.endswith(".gz"):
                    stream = gzip.GzipFile(fileobj=stream)
                for record in self._records(stream):
                    rows.append(record)
                    held += len(record[-1] or b"")
                    if held > 4 << 20 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def _records(self, stream) -> Iterator[tuple]:
        while True:
            line = stream.readline()
            if not line:
                return
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no WARC record where one should start: {line[:60]!r}")
            headers = {}
            for line in iter(stream.readline, b""):
                if not line.strip():
                    break
                field, _, value = line.decode("utf-8", "replace").partition(":")
                headers[field.strip().lower()] = value.strip()
            if not headers.get("content-length", "").isdigit():
                raise ValueError(f"a WARC record without a content length: {headers.get('warc-record-id')}")
            length = int(headers["content-length"])
            record = {c: headers[f.lower()] for c, f in FIELDS.items() if f.lower() in headers}
            if not self._wanted(record) or not self.payload:
                stream.seek(length, io.SEEK_CUR)
                payload = None
            else:
                block = stream.read(length)
                if len(block) < length:
                    raise ValueError("the archive ends inside a record")
                http = record.get("content_type", "").startswith("application/http")
                payload = block.partition(b"\r\n\r\n")[2] if http else block
            if self._wanted(record):
                yield (*(record.get(c) for c in FIELDS), length, payload)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``: files or folders of WARC records, gzip or plain.

    Columns: the header fields, content_length and payload (an HTTP block without its head). Options:
    ``payload`` false leaves payloads out, ``partitionBytes`` bounds the files of a task. Equality, IN,
    prefix and IS NOT NULL on header columns are decided from the headers, before a payload is read.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, as WARC digests are written: 20 bits, or four digits, at a time."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    # The digits of conv and those of base32.
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_warc(
    pages: DataFrame, path: str, *, id: str = "page_id", url: str = "url", html: str = "html", least: int = 0,
    records_per_file: int = 200_000,
) -> None:
    """Write one WARC record per page to new text files below ``path``.

    The payload is the page in UTF-8, null as empty. Of pages with equal payloads of at least ``least``
    bytes the smallest id is a response (null ids last, rows that repeat it too) and the others are
    revisits without a payload that refer to it; smaller payloads are always responses. A null id has a
    record id of its payload; a null URL no target; white space and control characters in a URL are
    percent-encoded. An empty table gives an archive without records. Spark's text writer makes the
    files, so any file system that it reaches will do; equal payloads meet by their digest in a join with the
    digests that occur again, which Spark splits if very many pages share one.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(id).cast("string").alias("name"), F.col(id).alias("id"), F.col(url).alias("url"), payload.alias("html"),
        F.octet_length(payload).alias("bytes"), base32_sha1(payload).alias("digest"),
    )
    # Digests that occur again, written first: payloads meet them without being moved if they are few.
    again = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("of"), "first")
    rows = rows.join(stage(again, "digests"), F.col("digest") == F.col("of"), "left")
    again = (F.col("bytes") >= least) & F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first")))
    address = F.col("url")
    for code in (*range(0x21), 0x7F):
        address = F.replace(address, F.lit(chr(code)), F.lit(f"%{code:02X}")) if chr(code) in "\t\n\r " else address
    address = F.regexp_replace(address, "[\\x00-\\x1F\\x7F]", "")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit("\r\n\r\n")
    )
    block = F.concat(head, F.when(again, F.lit("")).otherwise(F.col("html")))
    identity = F.concat(F.lit("<urn:page:"), F.coalesce("name", F.concat(F.lit("sha1:"), F.col("digest"))), F.lit(">"))

    def line(field: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{field}: "), value, F.lit("\r\n")), F.lit(""))

    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", identity),
        line("WARC-Refers-To", F.when(again, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))),
        line("WARC-Profile", F.when(again, F.lit(_REVISIT))),
        line("WARC-Target-URI", address),
        line("WARC-Date", F.lit("2000-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block,
    )
    lines = rows.select(record.alias("value"))
    # A record ends in two line ends, which are the writer's line separator.
    lines.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file).text(path)


def read_warc(spark: SparkSession, path: str, **options) -> DataFrame:
    """The records below ``path``; filters on header columns are pushed into the source."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(**options).load(path)


def page_records(records: DataFrame, kind: str = "long") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of archives ``write_warc`` made.

    Length and digest of a response are those of its payload, as read; one whose header names another digest
    raises. A revisit has none, and they are those its header has of the payload it refers to.
    """
    number = "^<urn:page:(.*)>$"
    page = F.regexp_extract("record_id", number, 1)
    own = F.when((F.col("warc_type") == "response") & F.col("payload").isNotNull(), F.col("payload"))
    header, digest = F.regexp_replace("payload_digest", "^sha1:", ""), base32_sha1(own)
    wrong = F.raise_error(F.concat(F.lit("the payload does not have the digest of its header: "), F.col("record_id")))
    return records.select(
        F.when(~page.startswith("sha1:"), page).cast(kind).alias("page_id"),
        F.coalesce(F.octet_length(own), F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(own.isNull(), header).when(digest == header, digest).otherwise(wrong.cast("string")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.regexp_extract("refers_to", number, 1).cast(kind).alias("refers_to"),
    )


def read_pages(spark: SparkSession, path: str, kind: str = "long") -> DataFrame:
    """``page_records`` of an archive: payloads of responses only; revisits by their headers, which a pushed filter
    and the option without payloads keep from reading anything else."""
    responses = read_warc(spark, path).where("warc_type = 'response'")
    revisits = read_warc(spark, path, payload="false").where("warc_type = 'revisit'")
    return page_records(responses, kind).union(page_records(revisits, kind))
