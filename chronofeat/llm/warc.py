"""WARC records: responses, and the metadata and conversion records derived from them.

Every response gives a ``metadata`` record (its HTTP status and headers,
digests, title and links, as ``application/warc-fields``) and a ``conversion``
record (its text as ``text/plain``).  Both refer to the response by its record
id and keep its target, date and payload digest; their own ids follow from the
response's, so a task that runs again writes the same records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from typing import Dict, Iterator, List, Optional, Tuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_code
from .dom import INSIDE_TAG

Headers = List[Tuple[str, str]]


def digest(data: bytes) -> str:
    """``sha1:`` and the base-32 digest, as WARC writers give it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(0).join(parts).encode('utf-8', 'surrogatepass')).digest()[:16], version=5)}>"


def _line(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n\x00]+", " ", value).strip()


def write_record(headers: Headers, block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {_line(v)}\r\n" for k, v in headers)
    return head.encode("utf-8", "surrogatepass") + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def read_record(data: bytes, at: int = 0) -> Tuple[Headers, bytes, int]:
    """(headers, block, place after the record) of the record at ``at``; a block
    that is cut off gives what is there.  ValueError where no record begins or
    its Content-Length is no number; the place is always beyond ``at``."""
    end = data.find(b"\r\n\r\n", at)
    if end < 0 or not data.startswith(b"WARC/", at):
        raise ValueError(f"no WARC record at byte {at}")
    lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
    headers: Headers = []
    for x in lines:
        if x[:1] in (" ", "\t") and headers:           # a folded line
            headers[-1] = (headers[-1][0], headers[-1][1] + " " + x.strip())
        elif ":" in x:
            k, v = x.split(":", 1)
            headers.append((k.strip(), v.strip()))
    length = get(headers, "Content-Length") or ""
    if not re.fullmatch(r"[0-9]{1,18}", length):
        raise ValueError(f"record at byte {at} has the Content-Length {length!r}")
    size, start = int(length), end + 4
    after = start + size
    while data.startswith(b"\r\n", after):
        after += 2
    return headers, data[start:start + size], after


def get(headers: Headers, name: str) -> Optional[str]:
    """First value of a header, whatever its case."""
    name = name.lower()
    return next((v for k, v in headers if k.lower() == name), None)


def split_http(block: bytes) -> Tuple[str, Headers, bytes]:
    """(status line, headers, body as sent) of an HTTP response."""
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("iso-8859-1").split("\r\n")
    return lines[0], [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:]) if k], body


def _codings(headers: Headers, name: str) -> List[str]:
    """Codings of all headers of that name, the one applied last first."""
    found = [x.strip().lower() for k, v in headers if k.lower() == name for x in v.split(",")]
    return [x for x in reversed(found) if x and x != "identity"]


class BrokenBody(ValueError):
    """A chunked body that breaks off after some of its chunks."""


def _unchunk(body: bytes) -> bytes:
    """The chunks' contents.  ValueError where not even the first chunk can be
    read (the body is not chunked), BrokenBody where a later one cannot."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]{1,15}", size):
            raise (BrokenBody if at else ValueError)(f"no chunk at byte {at}")
        n = int(size, 16)
        if not n:
            return b"".join(out)
        if end + 2 + n > len(body):
            raise BrokenBody(f"the chunk at byte {at} is cut off")
        out.append(body[end + 2:end + 2 + n])
        at = end + 2 + n
        at += 2 if body.startswith(b"\r\n", at) else 0


def _inflate(body: bytes) -> bytes:
    """Deflate with the zlib wrapper, or raw as some servers send it."""
    try:
        return zlib.decompress(body)
    except zlib.error:
        z = zlib.decompressobj(-zlib.MAX_WBITS)
        out = z.decompress(body) + z.flush()
        if not z.eof:
            raise
        return out


def _is_text(body: bytes) -> bool:
    try:
        return b"\0" not in body and body.decode("utf-8") is not None
    except UnicodeDecodeError:
        return False


def undo_codings(headers: Headers, body: bytes) -> Tuple[bytes, Optional[str]]:
    """The body without transfer and content codings, and the coding that could
    not be undone, if any: one that is not known here (br, zstd, ...) or is
    broken.  UTF-8 text under such a coding was decoded before; it stays as
    sent.  A chunked body that breaks off is not handed on in part."""
    for coding in _codings(headers, "transfer-encoding") + _codings(headers, "content-encoding"):
        try:
            if not body:
                continue
            elif coding == "chunked":
                body = _unchunk(body)
            elif coding in ("gzip", "x-gzip"):
                body = gzip.decompress(body)
            elif coding == "deflate":
                body = _inflate(body)
            elif not _is_text(body):
                return body, coding
        except BrokenBody:
            return body, coding
        except (OSError, EOFError, ValueError, zlib.error):
            if not _is_text(body):
                return body, coding
    return body, None


def plain_body(headers: Headers, body: bytes) -> bytes:
    """The body without transfer and content codings, as far as they can be undone."""
    return undo_codings(headers, body)[0]


def decode_body(headers: Headers, body: bytes) -> str:
    m = re.search(r"charset=[\"']?([-\w]+)", get(headers, "Content-Type") or "", re.I) or \
        re.search(r"<meta[^>]+charset=[\"']?([-\w]+)", body[:2048].decode("iso-8859-1"), re.I)
    try:
        return body.decode(m[1] if m else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


_UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|head|noscript|template)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li|main"
                    rf"|nav|ol|p|pre|section|table|td|th|tr|ul|body|html)\b{INSIDE_TAG}>", re.I)
_TAG = re.compile(rf"<[!/?a-zA-Z]{INSIDE_TAG}>")
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.S | re.I)
_LINK = re.compile(r"<a\s[^>]*?href\s*=\s*[\"']?([^\"'\s>]+)", re.I)


def plain_text(page: str) -> str:
    """All text of a page, a line for each stretch between block tags."""
    text = html.unescape(_TAG.sub("", _BREAK.sub("\n", _UNSEEN.sub(" ", page))))
    return "\n".join(x for x in (" ".join(line.split()) for line in text.split("\n")) if x)


def response_record(key: str, url: Optional[str], page: str, date: str) -> bytes:
    """A response record for a page fetched from ``url``."""
    body = page.encode("utf-8", "surrogatepass")
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             + f"Content-Length: {len(body)}\r\n\r\n".encode() + body)
    payload = digest(body)
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", record_id(key, url or "", payload)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", url))
    return write_record(headers + [("WARC-Payload-Digest", payload), ("WARC-Block-Digest", digest(block)),
                                   ("Content-Type", "application/http; msgtype=response")], block)


def derive(headers: Headers, block: bytes) -> Iterator[Tuple[str, bytes]]:
    """(type, record) of the metadata and the conversion record of a response.
    A body whose coding cannot be undone has no text: its metadata names the
    coding as ``undecoded-coding``, and there is no conversion record."""
    source = get(headers, "WARC-Record-ID") or record_id("", digest(block))
    status, http, sent = split_http(block)
    body, undecoded = undo_codings(http, sent)
    page = "" if undecoded else decode_body(http, body)
    payload = get(headers, "WARC-Payload-Digest") or digest(sent)
    kept = [(k, v) for k, v in ((k, get(headers, k)) for k in ("WARC-Target-URI", "WARC-Date")) if v is not None]
    title = _TITLE.search(page)
    fields = [("source-payload-digest", payload), ("source-block-digest", get(headers, "WARC-Block-Digest") or digest(block)),
              ("http-status", status)]
    fields += [(f"http-header-{k.lower()}", v) for k, v in http]
    fields += [(f"source-{k.lower()}", v) for k, v in headers
               if k.lower() not in ("warc-type", "content-length", "warc-payload-digest", "warc-block-digest")]
    if undecoded:
        fields.append(("undecoded-coding", undecoded))
    if title:
        fields.append(("title", " ".join(html.unescape(title[1]).split())))
    fields += [("outlink", html.unescape(u)) for u in _LINK.findall(page)]
    meta = "".join(f"{k}: {_line(v)}\r\n" for k, v in fields).encode("utf-8", "surrogatepass")
    text = plain_text(page).encode("utf-8", "surrogatepass")
    for kind, media, data in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", text)):
        if undecoded and kind == "conversion":
            continue
        yield kind, write_record([("WARC-Type", kind), ("WARC-Record-ID", record_id(source, kind)), ("WARC-Refers-To", source),
                                  *kept, ("WARC-Payload-Digest" if kind == "conversion" else "WARC-Source-Payload-Digest",
                                          digest(data) if kind == "conversion" else payload),
                                  ("WARC-Block-Digest", digest(data)), ("Content-Type", media)], data)


def _member(data: bytes, at: int, step: int = 1 << 16) -> Tuple[bytes, int]:
    """(content of the gzip member at ``at``, place after it)."""
    z, out = zlib.decompressobj(31), []
    while at < len(data) and not z.eof:
        out.append(z.decompress(data[at:at + step]))
        at += step
    return b"".join(out), min(at, len(data)) - len(z.unused_data)


# --- on tables


def page_responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """``page_id, record``: a WARC response for every row.  Null HTML is an empty
    body; a null url leaves the target out; rows that repeat give equal records."""
    ship_code(pages.sparkSession)
    source = pages.select(F.col(id_col).alias("page_id"), F.col(id_col).cast("string").alias("key"),
                          F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                records = [response_record(k or "", u, h or "", date)
                           for k, u, h in zip(*[b.column(c).to_pylist() for c in (1, 2, 3)])]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(records, pa.binary())], ["page_id", "record"])

    return source.mapInArrow(run, source.selectExpr("page_id", "cast('' as binary) as record").schema)


def build_derivatives(records: DataFrame, record_col: str = "record", keep: Tuple[str, ...] = ()) -> DataFrame:
    """Two rows for every response in ``record_col`` (whole WARC records), one
    (metadata) where its coding cannot be undone: the columns in ``keep``, ``warc_type, record_id, refers_to, target_uri, date,
    payload_digest, block_digest, n_bytes`` (of the block) and ``record``.

    Defined cases: names in ``keep`` that the result has too, or that are
    repeated, are refused with a ValueError before any job; null, damaged and
    other records (requests, metadata, ...) give no rows; repeated responses give repeated rows; an empty table gives
    an empty result."""
    names = [k.lower() for k in (*keep, "warc_type", "record_id", "refers_to", "target_uri", "date", "payload_digest",
                                 "block_digest", "n_bytes", "record", "__cf_record")]
    if len(set(names)) < len(names):
        raise ValueError(f"keep={keep} repeats a name or clashes with a column of the result")
    ship_code(records.sparkSession)
    source = records.select(*keep, F.col(record_col).alias("__cf_record"))
    schema = source.selectExpr(*[f"`{k}`" for k in keep], "cast(null as string) as warc_type", "cast(null as string) as record_id", "cast(null as string) as refers_to", "cast(null as string) as target_uri",
                               "cast(null as string) as date", "cast(null as string) as payload_digest", "cast(null as string) as block_digest", "0L as n_bytes",
                               "cast('' as binary) as record").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                rows, origin = [], []
                for i, data in enumerate(b.column(len(keep)).to_pylist()):
                    try:
                        headers, block, _ = read_record(data or b"")
                    except ValueError:
                        continue
                    if get(headers, "WARC-Type") != "response":
                        continue
                    for kind, record in derive(headers, block):
                        own, data2, _ = read_record(record)
                        rows.append((kind, get(own, "WARC-Record-ID"), get(own, "WARC-Refers-To"), get(own, "WARC-Target-URI"),
                                     get(own, "WARC-Date"), get(own, "WARC-Payload-Digest") or get(own, "WARC-Source-Payload-Digest"),
                                     get(own, "WARC-Block-Digest"), len(data2), record))
                        origin.append(i)
                if rows:
                    cols = [b.column(k).take(pa.array(origin)) for k in range(len(keep))]
                    kinds = [pa.string()] * 7 + [pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        cols + [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                        [*keep, "warc_type", "record_id", "refers_to", "target_uri", "date", "payload_digest", "block_digest",
                         "n_bytes", "record"])

    return source.mapInArrow(run, schema)


_STARTS = re.compile(rb"(?:(?<=\n)|(?<![\s\S]))WARC/|\x1f\x8b\x08")


def records_of(data: bytes) -> Iterator[Tuple[int, Optional[bytes], Optional[str]]]:
    """``(place, record, damage)`` of a WARC file's records, in order.  Where no
    record can be read, one entry gives the place and the reason, and reading
    goes on at the next place where a record or a gzip member begins."""
    at, bad = 0, False
    while at < len(data):
        try:
            if data[at:at + 2] == b"\x1f\x8b":
                one, after = _member(data, at)
                read_record(one)
            else:
                after = read_record(data, at)[2]
                one = data[at:after]
        except (ValueError, EOFError, OSError, zlib.error) as e:
            if not bad:
                yield at, None, str(e)[:200] or type(e).__name__
            bad = True
            found = _STARTS.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        bad = False
        yield at, one, None
        at = max(after, at + 1)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``path, offset, record, damage`` of WARC files, plain or with one gzip
    member per record.  A damaged stretch is one row without a record: its
    place and the reason; the records behind it are read.  A file is a task's
    unit of work and must fit Spark's binary file source (2 GB); crawls write
    files of about 1 GB."""
    ship_code(spark)
    schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("record", pa.binary()), ("damage", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows: List[tuple] = []
                for found in records_of(data):
                    rows.append((name, *found))
                    if len(rows) >= 500:
                        yield out(rows)
                        rows = []
                if rows:
                    yield out(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "path string, offset bigint, record binary, damage string")


def warc_fields(record: bytes) -> Dict[str, List[str]]:
    """Fields of a metadata record's block."""
    _, block, _ = read_record(record)
    out: Dict[str, List[str]] = {}
    for x in block.decode("utf-8", "replace").split("\r\n"):
        k, sep, v = x.partition(": ")
        if sep:
            out.setdefault(k, []).append(v)
    return out
