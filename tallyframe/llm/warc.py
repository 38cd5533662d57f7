"""WARC archives: writer and splittable reader.

Writer.  One gzip member per record, written by Spark's text sink (which writes a
string column's bytes as they are) into any store that Spark can write to.  The
sink ends every row with one zero byte; a member ends in its length mod 2**32,
little-endian, so the last byte of a member under 16 MiB is a zero byte that is
left out of the row; longer members get an empty member behind them.  The files
are plain concatenated gzip members, named by Spark (no ``.gz`` suffix, as Hadoop
would then read them whole).

Reader.  Tasks read byte ranges: Hadoop's line reader with the gzip magic
``1f 8b 08`` as line separator gives each task the candidates that start in
its range.  A candidate is a record if it inflates to the end with the right
CRC and starts with ``WARC/``.  Where the magic occurs by chance inside a member, the
pieces are put together again: inside a task at once; across the end of a range
by a second step over the few pieces that are left, file by file.

Edge cases: null payload is an empty one; a null page id or url leaves its header
out and reads back as null; payloads that are equal in rows with the same id
are responses in each row; records whose ids are all null are responses; an empty
table gives an empty archive and result; other columns are ignored.  Bytes that
no record claims and records without an end raise an error.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import materialize, scratch_path

MAGIC = b"\x1f\x8b\x08"
#: Payloads from this size on are written once; later ones refer to them.
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
_END = bytes.fromhex("1f8b08000000000000ff03000000000000000000")  # empty member

RECORD = ("page_id long, url string, record_type string, refers_to long, payload binary, "
          "payload_bytes long, payload_digest string")


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One uncompressed record; ``refers_to`` makes it a revisit without payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = http if refers_to is not None else http + payload
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """The record as gzip member(s), ending in a zero byte."""
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = c.compress(record) + c.flush()
    return out if out[-1] == 0 else out + _END


def _opt(v):
    return None if v is None or v is pd.NA or (isinstance(v, float) and np.isnan(v)) else v


def _write(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        rows = []
        for page_id, url, html, digest, to in zip(pdf["page_id"], pdf["url"], pdf["html"], pdf["digest"], pdf["to"]):
            page_id, to = _opt(page_id), _opt(to)
            rows.append(member(_record(None if page_id is None else int(page_id), _opt(url), (_opt(html) or "").encode(),
                                       digest, None if to is None else int(to)))[:-1])
        yield pd.DataFrame({"value": rows})


def write(pages: DataFrame, path: str) -> None:
    """One record per row of pages (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = F.octet_length("html") >= REVISIT_BYTES
    last = (rows.where(large).groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
            .where("n > 1").select("digest", "last"))
    rows = rows.join(last, "digest", "left").withColumn(
        "to", F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")))
    (rows.select(F.col("page_id").cast("string"), "url", "html", "digest", F.col("to").cast("string"))
     .mapInPandas(_write, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\0").text(path))


def _parse(raw: bytes) -> tuple | None:
    """RECORD's values of one uncompressed record, or None."""
    if not raw.startswith(b"WARC/"):
        return None
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
    body = rest[:int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    said = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:] if ": " in x)
    page = lambda name: int(fields[name][10:-1]) if name in fields else None  # noqa: E731  <urn:page:N>
    url = fields.get("WARC-Target-URI")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    size = int(said["Content-Length"])
    if kind != "revisit" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"record {fields.get('WARC-Record-ID')}: payload and digest differ")
    return page("WARC-Record-ID"), url, kind, page("WARC-Refers-To"), None if kind == "revisit" else payload, size, digest


def _inflate(piece: bytes) -> tuple[str, bytes]:
    """('whole', record); ('part', first bytes) if bytes are missing; ('no', b'')."""
    d = zlib.decompressobj(31)
    try:
        out = d.decompress(MAGIC + piece)
    except zlib.error:
        return "no", b""
    if not d.eof:
        return "part", out[:5]
    return ("no", b"") if d.unused_data else ("whole", out)


class _Joiner:
    """Takes candidates in file order; gives records and keeps what can't be decided here."""

    def __init__(self, payload: bool = True):
        self.payload = payload
        self.open: list[bytes] | None = None
        self.records: list[tuple] = []
        self.stray: list[tuple[int, bytes]] = []  # (place, piece) before the first sure member of a range
        self.sure = False

    def take(self, place: int, piece: bytes, inside: bool) -> None:
        """inside: the range starts inside the file, perhaps inside a member."""
        if self.open is not None:
            joined = MAGIC.join([*self.open, piece])
            said, raw = _inflate(joined)
            if said == "whole":
                self.open = None
                self._keep(raw)
                return
            alone, raw = _inflate(piece)
            if alone == "whole" and (not raw or raw.startswith(b"WARC/")):
                raise ValueError("bytes of a record are missing")
            self.open.append(piece)
            return
        said, raw = _inflate(piece)
        if said == "whole" and (not raw or raw.startswith(b"WARC/")):
            self._keep(raw)
        elif said == "part" and (raw == b"WARC/" or self.sure or not inside):
            self.open, self.sure = [piece], True
        elif inside and not self.sure:
            self.stray.append((place, piece))
        else:
            raise ValueError("bytes that belong to no record")

    def _keep(self, raw: bytes) -> None:
        self.sure = True
        if raw:  # not the empty member behind a long one
            r = _parse(raw)
            self.records.append(r if self.payload else (*r[:4], None, *r[5:]))


_PIECE = RECORD + ", kind string, file string, start long, place long, piece binary"
_COLS = ["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"]


def _frame(records: list[tuple], pieces: list[tuple] = ()) -> pd.DataFrame:
    rows = [(*r, "record", None, None, None, None) for r in records] + [(None,) * 7 + p for p in pieces]
    f = pd.DataFrame(rows, columns=[*_COLS, "kind", "file", "start", "place", "piece"])
    return f.astype({c: "Int64" for c in ("page_id", "refers_to", "payload_bytes", "start", "place")})


def _scan(it: Iterator[pd.DataFrame], payload: bool) -> Iterator[pd.DataFrame]:
    at, joiner, n = None, None, 0

    def left() -> list[tuple]:
        out = [("stray", at[0], at[1], p, x) for p, x in joiner.stray]
        if joiner.open is not None:
            out.append(("open", at[0], at[1], n, MAGIC.join(joiner.open)))
        return out

    for pdf in it:
        records, pieces = [], []
        for file, start, value in zip(pdf["file"], pdf["start"], pdf["value"]):
            if (file, start) != at:
                if joiner is not None:
                    records += joiner.records
                    pieces += left()
                at, joiner, n = (file, start), _Joiner(payload), 0
            n += 1
            if n == 1 and start == 0 and value == b"":
                continue  # what stands before the first magic of a file
            joiner.take(n, value, start > 0)
        if joiner is not None:
            records += joiner.records
            joiner.records = []
        yield _frame(records, pieces)
    if joiner is not None:
        yield _frame(joiner.records, left())


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """RECORD columns of every record under ``path``; without ``payload`` that column is null (its
    digest and length are checked all the same)."""
    lines = (spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                     F.col("value").cast("binary").alias("value")))
    found = materialize(lines.mapInPandas(lambda it: _scan(it, payload), _PIECE), "warc-scan")
    names = [c.split()[0] for c in RECORD.split(", ")]
    whole = found.where("kind = 'record'").select(*names)
    split = (found.where("kind <> 'record'").select("file", "start", "place", "piece")
             .groupBy("file").applyInPandas(lambda pdf: _stitch(pdf, payload), RECORD))
    return whole.union(split)


def _stitch(pdf: pd.DataFrame, payload: bool) -> pd.DataFrame:
    """Members cut by the end of a range: the open piece, then the strays of the next ranges."""
    joiner = _Joiner(payload)
    for place, piece in pdf.sort_values(["start", "place"])[["place", "piece"]].itertuples(index=False):
        joiner.take(place, piece, False)
    if joiner.open is not None:
        raise ValueError("a record has no end")
    return _frame(joiner.records)[_COLS]


def op6(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes the archives, reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    path = scratch_path(spark, "warc")
    write(pages.select("page_id", "url", "html"), path)
    return read(spark, path, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


ORACLE = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to, url
FROM m
"""
