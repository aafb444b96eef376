"""WARC archives: writing captures, reading records, assembling transactions.

Writing: every row is a capture of three records, request, response (or revisit) and
metadata, each a gzip member of its own; request and metadata name the response in
WARC-Concurrent-To.  Of captures with equal payloads of at least ``least`` bytes the one
with the smallest id is the response; the others are revisits without the payload, which
name it in WARC-Refers-To and keep digest and length of the whole payload.  A task rolls
over to a new file after ``roll`` bytes.

Reading streams one record at a time; the digest of a payload that is there is computed
anew and must be the one in the header.

Assembly joins the records by the concurrent-to identifier into one nested row per
capture.  Record ids are names made from id, url and digest, so a retried task writes
the same ones; rows that repeat give records that repeat, which are counted and come
back as often.

Cases: a null payload is empty; null urls have no target; null ids are never the
smallest, so they revisit a payload that another row has (all null: all are responses);
control and non-ASCII characters in urls are percent-encoded, brackets stay wherever they
are; an empty table gives no file and no row; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm import files
from vantage.llm.common import map_arrow, materialize, scratch, slices

# fixed values: format version and revisit profile of the WARC standard
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROLL = 64 << 20
#: host and path of an address; fits every string, also where a host's brackets do not match
_PARTS = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?([^?#]*)")


def _name(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, repr(parts))}>"


def _target(url: str | None) -> str | None:
    return None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = [VERSION, *(f"{k}: {v}".encode() for k, v in fields if v is not None),
            b"Content-Length: %d" % len(block), b"", b""]
    return gzip.compress(b"\r\n".join(head) + block + b"\r\n\r\n", 6, mtime=0)


def _capture(i, url, payload: bytes, size: int, digest: str, first, date: str) -> Iterator[bytes]:
    own, target = _name(i, url, digest), _target(url)
    revisit = first is not None
    common = [("WARC-Target-URI", target), ("WARC-Date", date)]
    host, path = _PARTS.match(target or "").groups("")
    ask = f"GET {path or '/'} HTTP/1.1\r\nHost: {host}\r\n\r\n"
    yield _record([("WARC-Type", "request"), ("WARC-Record-ID", _name("request", own)), ("WARC-Concurrent-To", own),
                   *common, ("Content-Type", "application/http; msgtype=request")], ask.encode())
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    yield _record([("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own), *common,
                   ("WARC-Payload-Digest", f"sha256:{digest}"),
                   ("WARC-Refers-To", _name(*first, digest) if revisit else None),
                   ("WARC-Profile", PROFILE if revisit else None),
                   ("Content-Type", "application/http; msgtype=response")], answer if revisit else answer + payload)
    about = "" if i is None else f"page-id: {i}\r\n"
    yield _record([("WARC-Type", "metadata"), ("WARC-Record-ID", _name("metadata", own)), ("WARC-Concurrent-To", own),
                   *common, ("Content-Type", "application/warc-fields")], about.encode())


def write_warc(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               least: int = 100, date: str = "1970-01-01T00:00:00Z", roll: int = ROLL) -> DataFrame:
    """Write the archives; returns the manifest (path, records), also in ``folder``."""
    pages = (df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
             .withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long")))
    # payloads that more than one row has, with the first row of each; no payload moves
    firsts = materialize(
        pages.where(F.col("size") >= least).groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "url"))).alias("first"))
        .where("n > 1 AND first IS NOT NULL").select("digest", "first"), "firsts")
    dealt = (pages.join(firsts, "digest", "left")
             .select("id", "url", "payload", "size", "digest",
                     F.expr("IF(id <=> first.id, NULL, first)").alias("first")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, uri, size, count = None, "", 0, 0
        for batch in slices(batches, "payload"):
            for i, url, payload, length, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    (uri, out), size, count = files.create(folder, ".warc.gz"), 0, 0
                first = (first["id"], first["url"]) if first else None
                for record in _capture(i, url, payload.encode(), length, digest, first, date):
                    out.write(record)
                    size, count = size + len(record), count + 1
                if size >= roll:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [uri], "records": [count]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [uri], "records": [count]})

    listed = map_arrow(dealt, run, "path string, records long")
    listed.write.parquet(f"{folder}/manifest")
    return df.sparkSession.read.schema(listed.schema).parquet(f"{folder}/manifest")


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of an archive."""
    with gzip.GzipFile(fileobj=stream) as f:
        while line := f.readline():
            if line.strip() != VERSION:
                raise ValueError(f"not a WARC record: {line[:40]!r}")
            head = {}
            while (line := f.readline().strip()):
                k, _, v = line.decode().partition(": ")
                head[k] = v
            yield head, f.read(int(head["Content-Length"]))
            f.read(4)


_RECORD = ("type string, id string, concurrent string, refers string, target string, digest string, "
           "size long, page_id long, payload binary")


def read_records(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """One row per record of the listed archives, a file a task.  ``size`` and ``digest`` are
    of the whole payload, ``payload`` is what the record holds of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _RECORD.split(", ")]
        schema = pa.schema(list(zip(names, [pa.string()] * 6 + [pa.int64()] * 2 + [pa.binary()])))
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for head, block in records(files.open_stream(path)):
                    kind, size, page, body = head["WARC-Type"], None, None, None
                    digest = head.get("WARC-Payload-Digest", "").partition(":")[2] or None
                    if kind in ("response", "revisit"):
                        http, _, body = block.partition(b"\r\n\r\n")
                        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))
                        if kind == "response" and (len(body) != size or hashlib.sha256(body).hexdigest() != digest):
                            raise ValueError(f"payload of {head['WARC-Record-ID']} in {path} is damaged")
                    elif kind == "metadata":
                        page = dict(x.split(": ", 1) for x in block.decode().split("\r\n") if x).get("page-id")
                    body = body if payload and kind == "response" else None
                    rows.append((kind, head["WARC-Record-ID"], head.get("WARC-Concurrent-To"), head.get("WARC-Refers-To"),
                                 head.get("WARC-Target-URI"), digest, size, page and int(page), body))
                    held += 500 + len(body or b"")
                    if held >= 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    n = max(1, manifest.count())  # a row a file
    return map_arrow(manifest.select("path").repartition(n), run, _RECORD)


def assemble(recs: DataFrame) -> DataFrame:
    """One nested row per capture: page_id, request, response, metadata, refers_to (the page
    of the response that a revisit stands for)."""
    answers = (recs.where("type IN ('response', 'revisit')").groupBy("id")
               .agg(F.count("*").alias("times"), F.first(F.struct("type", "target", "digest", "size", "refers", "payload"))
                    .alias("response")))
    # only records with the wanted type name another by concurrent-to; repeats are one
    side = lambda kind: (recs.where(F.col("type") == kind).groupBy(F.col("concurrent").alias("id"))
                         .agg(F.first(F.struct(F.col("id").alias("record"), "target", "page_id")).alias(kind)))
    met = answers.join(side("request"), "id", "left").join(side("metadata"), "id", "left")
    met = materialize(met.select("id", "times", "request", "response", "metadata"), "captures")
    pointed = met.where("response.type = 'response'").select(F.col("id").alias("refers"), F.col("metadata.page_id").alias("refers_to"))
    return (met.withColumn("refers", F.col("response.refers")).join(pointed, "refers", "left")
            .select(F.col("metadata.page_id").alias("page_id"), "request", "response", "metadata", "refers_to",
                    F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("time"))
            .drop("time"))


def warc_round_trip(df: DataFrame, folder: str | None = None, payload: bool = False, **columns) -> DataFrame:
    """Write ``df`` as archives in a (new) shared folder, read them back and assemble."""
    folder = folder or scratch(df.sparkSession, "warc")
    recs = read_records(write_warc(df, folder, **columns), payload)
    return assemble(materialize(recs, "records"))  # three sides are taken from it
