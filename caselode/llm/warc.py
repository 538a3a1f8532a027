"""WARC archives: writing pages as transactions of linked records, and assembling them again.

A page becomes a request, a response (or a revisit of an equal payload) and a metadata record,
which name the response in WARC-Concurrent-To. Reading parses whole archive files in tasks, groups
records by that link, and gives one nested row per capture.

Archives are written by Spark's own text writer: a line per transaction, CRLF between lines, each
file one gzip stream. Payloads are text, so their bytes are UTF-8.
"""

import base64
import hashlib
import zlib
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
#: Transactions of one archive file at most; a file is parsed by one task, as a stream.
RECORDS_PER_FILE = 20_000
CRLF = "\r\n"

RECORD = (
    "key string, kind string, record_id string, page string, target_uri string, payload_bytes long, "
    "payload_digest string, refers_to string, payload string"
)


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of some bytes: every 20 bits are four digits."""
    digits = F.concat(*[F.lpad(F.conv(F.substring(F.sha1(data), 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(kind: str, *parts: Column) -> Column:
    """<urn:uuid:...> that follows from what the record is about."""
    name = F.concat_ws("/", F.lit(kind), *[F.coalesce(p, F.lit("-")) for p in parts])
    return F.concat(
        F.lit("<urn:uuid:"),
        F.regexp_replace(F.md5(name), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
        F.lit(">"),
    )


def _record(kind, headers: dict, block: Column) -> Column:
    """One record without the two line ends that follow it. Headers with a null value are left out."""
    lines = [F.lit(VERSION), F.concat(F.lit("WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers.items()]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), block)


def write_archives(pages: DataFrame, path: str, id_col="page_id", url_col="url", html_col="html", min_bytes=0):
    """Write a transaction per row of `pages` as gzip-compressed archives below `path`.

    Of equal payloads of at least `min_bytes` bytes, the one with the smallest id is a response,
    the others revisits without payload; rows that repeat the smallest id are all responses.
    Null html is an empty payload; a null url has no target header. A null id counts as greater
    than all others; if a payload has null ids only, all are responses. Record ids follow from id and payload;
    those of pages without an id also from their place in the writing task. An empty id is an id. Line ends in urls are
    percent-encoded. Other columns are not written. An empty table writes archives without records.
    """
    body = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), body.alias("body"))
    digested = rows.withColumn("digest", base32_sha1(F.encode("body", "UTF-8")))
    keys = digested.select("id", "digest", F.octet_length("body").alias("size")).filter(F.col("size") >= min_bytes)
    firsts = keys.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    # only revisits meet the pages again; a payload of a third of all pages is one row of `firsts`
    revisits = (
        keys.select("id", "digest").join(firsts, "digest").filter(F.col("first").isNotNull())
        .filter(~F.col("id").eqNullSafe(F.col("first"))).select("id", "digest", "first").distinct()
    )
    linked = digested.alias("p").join(
        revisits.alias("r"),
        F.col("p.id").eqNullSafe(F.col("r.id")) & (F.col("p.digest") == F.col("r.digest")),
        "left",
    ).select("p.*", "r.first").withColumn("row", F.monotonically_increasing_id())

    text = lambda c: F.url_encode(F.col(c).cast("string"))
    # pages without an id have record ids of their own, so that equal ones are not one group when read
    name = F.coalesce(text("id"), F.concat(F.lit("null:"), F.col("row").cast("string")))
    own = record_id("response", name, F.col("digest"))
    uri = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    shared = {"WARC-Target-URI": uri, "WARC-Date": F.lit(DATE)}
    is_revisit = F.col("first").isNotNull()
    size = F.octet_length("body").cast("string")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(CRLF * 2),
        F.when(is_revisit, F.lit("")).otherwise(F.col("body")),
    )
    response = _record(
        F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response")),
        shared
        | {
            "WARC-Record-ID": own,
            "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("digest")),
            "WARC-Profile": F.when(
                is_revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
            ),
            "WARC-Refers-To": F.when(is_revisit, record_id("response", text("first"), F.col("digest"))),
            "Content-Type": F.lit("application/http; msgtype=response"),
        },
        http,
    )
    request = _record(
        "request",
        shared
        | {
            "WARC-Record-ID": record_id("request", name, F.col("digest")),
            "WARC-Concurrent-To": own,
            "Content-Type": F.lit("application/http; msgtype=request"),
        },
        F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1" + CRLF * 2)),
    )
    metadata = _record(
        "metadata",
        shared
        | {
            "WARC-Record-ID": record_id("metadata", name, F.col("digest")),
            "WARC-Concurrent-To": own,
            "Content-Type": F.lit("application/warc-fields"),
        },
        F.coalesce(F.concat(F.lit("page: "), text("id"), F.lit(CRLF)), F.lit("")),
    )
    # the writer adds the second line end after the last record
    value = F.concat(F.concat_ws(CRLF * 2, request, response, metadata), F.lit(CRLF))
    (
        linked.select(value.alias("value")).write.option("lineSep", CRLF).option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    )


class _Stream:
    """Bytes of a file that may be gzip-compressed, in one or many members, inflated as they are read."""

    def __init__(self, content, step=1 << 18):
        self.content, self.at, self.step = memoryview(content), 0, step
        self.buffer, self.left = bytearray(), 0
        self.inflate = zlib.decompressobj(31) if bytes(content[:2]) == b"\x1f\x8b" else None

    def _more(self) -> bool:
        del self.buffer[: self.left]
        self.left = 0
        if self.at >= len(self.content):
            return False
        part = self.content[self.at : self.at + self.step]
        self.at += len(part)
        if self.inflate is None:
            self.buffer += part
            return True
        self.buffer += self.inflate.decompress(part)
        while self.inflate.eof and self.inflate.unused_data:
            rest = self.inflate.unused_data
            self.inflate = zlib.decompressobj(31)
            self.buffer += self.inflate.decompress(rest)
        if self.inflate.eof:
            self.inflate = zlib.decompressobj(31)
        return True

    def until(self, mark: bytes):
        """What comes before the mark, which is passed over; None at the end of the file."""
        look = self.left
        while (at := self.buffer.find(mark, look)) < 0:
            seen = len(self.buffer) - self.left
            if not self._more():
                return None
            look = max(0, seen - len(mark))
        out = bytes(self.buffer[self.left : at])
        self.left = at + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.left < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.buffer[self.left : self.left + n])
        self.left += n
        return out


def parse(content):
    """(headers, block) of every record of an archive file; header names in lower case."""
    stream = _Stream(content)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode().lstrip(CRLF).split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        block = stream.take(int(headers["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record is longer than it says")
        yield headers, block


def _http(block):
    """Headers and payload of an HTTP message."""
    head, _, payload = block.partition(b"\r\n\r\n")
    pairs = (line.partition(":") for line in head.decode("latin-1").split(CRLF)[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}, payload


def read_records(spark: SparkSession, path: str, with_payload=True) -> DataFrame:
    """Every request, response, revisit and metadata record of the archives below `path`.

    A response's payload is checked against its digest and its length.
    """

    def parsed(batch):
        for content in batch.column("content"):
            rows = {f: [] for f in ("key", "kind", "record_id", "page", "target_uri", "payload_bytes",
                                    "payload_digest", "refers_to", "payload")}
            held = 0
            for headers, block in parse(content.as_buffer()):
                kind = headers["warc-type"]
                if kind not in ("request", "response", "revisit", "metadata"):
                    continue
                size = digest = page = payload = None
                if kind in ("response", "revisit"):
                    http, body = _http(block)
                    size = int(http["content-length"])
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response":
                        if base64.b32encode(hashlib.sha1(body).digest()).decode() != digest or len(body) != size:
                            raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
                        payload = body.decode() if with_payload else None
                elif kind == "metadata":
                    fields = dict(x.split(": ", 1) for x in block.decode().split(CRLF) if ": " in x)
                    page = unquote(fields["page"].replace("+", " ")) if "page" in fields else None
                held += len(payload or "")
                for name, value in zip(rows, (
                    headers.get("warc-concurrent-to", headers["warc-record-id"]), kind, headers["warc-record-id"],
                    page, headers.get("warc-target-uri"), size, digest, headers.get("warc-refers-to"), payload,
                )):
                    rows[name].append(value)
                if held > 1 << 24 or len(rows["key"]) >= 10_000:
                    yield rows
                    rows, held = {f: [] for f in rows}, 0
            yield rows

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return map_batches(files, parsed, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One row per capture: id, page, target_uri, and nested request, response and metadata.

    Records are joined by the response that they name. Captures that are alike in everything, as
    rows that repeat, stay as many as they were; a capture without a request or a metadata record
    has null there. `refers_to` of a revisit is the page of the response that it names.
    """
    of = lambda kinds: F.collect_list(F.when(F.col("kind").isin(*kinds), F.struct(
        "kind", "record_id", "page", "target_uri", "payload_bytes", "payload_digest", "refers_to", "payload")))
    together = (
        records.groupBy("key")
        .agg(of(["request"]).alias("a"), of(["response", "revisit"]).alias("b"), of(["metadata"]).alias("c"))
        .select("key", F.explode(F.arrays_zip("a", "b", "c")).alias("x"))
        .filter(F.col("x.b").isNotNull())
    )
    rows = together.select(
        "key",
        F.col("x.c.page").alias("page"),
        F.col("x.b.target_uri").alias("target_uri"),
        F.struct(F.col("x.a.record_id").alias("record_id")).alias("request"),
        F.col("x.b").alias("response"),
        F.struct(F.col("x.c.record_id").alias("record_id"), F.col("x.c.page").alias("page")).alias("metadata"),
    )
    return rows


def with_referred_pages(rows: DataFrame) -> DataFrame:
    """`rows` of captures() with `refers_to`: the page of the response that a revisit names, else null."""
    named = rows.filter(F.col("response.kind") == "response").select(
        F.col("key").alias("named"), F.col("page").alias("refers_to")
    ).distinct()
    return rows.join(named, rows["response.refers_to"] == named["named"], "left").drop("named")
