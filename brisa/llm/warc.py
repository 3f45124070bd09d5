"""WARC archives: written by tasks into a shared folder, indexed first, read back by coalesced byte ranges."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brisa.llm.common import partitions
from brisa.session import settle, work_path

SMALLEST, GAP, RANGE, FILE_BYTES = 1000, 1 << 16, 1 << 22, 1 << 30
_INDEX = ("file string, offset bigint, length bigint, url string, digest string, page_id bigint, record_type string, refers_to bigint")
_RECORDS = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def filesystem(path: str):
    """File system and path for tasks; any scheme that pyarrow knows (file, hdfs, s3, gs)."""
    from pyarrow import fs

    if "://" not in path and path.startswith("file:"):
        path = "file://" + path[5:]
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member with a WARC/1.1 record; a revisit holds headers only."""
    body = b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 2024-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        # a line break would end the header
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(body)}")
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + z.flush()


def parse(raw: bytes) -> dict:
    """The record in one gzip member."""
    head, _, rest = zlib.decompress(raw, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    payload = rest[:int(fields["Content-Length"])]
    ident = lambda f: int(fields[f][10:-1]) if len(fields.get(f, "")) > 11 else None
    url = fields.get("WARC-Target-URI")
    whole = fields["WARC-Type"] == "response"
    declared = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
    digest = hashlib.sha1(payload).hexdigest() if whole else declared
    if digest != declared:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {"page_id": ident("WARC-Record-ID"), "url": None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"), "record_type": fields["WARC-Type"],
            "refers_to": ident("WARC-Refers-To"), "payload_bytes": len(payload) if whole else int(fields["X-Payload-Length"]), "payload_digest": digest, "payload": payload if whole else None}


def revisits(pages: DataFrame, key: str = "page_id", text: str = "html", smallest: int = SMALLEST) -> DataFrame:
    """``pages`` as (page_id, url, html, digest, refers_to): refers_to is set where an equal payload with a larger id exists.

    Of equal payloads of at least ``smallest`` bytes the largest id is the response; rows that repeat
    that id are responses too, rows without id are revisits of it; without any id all are responses.
    """
    p = pages.select(F.col(key).cast("bigint").alias("page_id"), "url", F.coalesce(text, F.lit("")).alias("html")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    big = F.octet_length("html") >= smallest
    top = p.where(big).groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("c")).where("c > 1 and top is not null").select("digest", "top")
    refers = F.when(big & ~F.col("page_id").eqNullSafe(F.col("top")), F.col("top"))
    return p.join(settle(top, "digests"), "digest", "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def write(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes one or more archives for each task and returns the index: file, offset, length, url, digest, … of each record.

    A task names its files anew, so a task run twice leaves files that no index row names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        out, name, offset = None, "", 0
        for b in batches:
            found = []
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                if out is None or offset >= file_bytes:
                    if out is not None:
                        out.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)      # the records are members already
                raw = record(page_id, url, html.encode(), digest, refers_to, refers_to is not None)
                out.write(raw)
                found.append((name, offset, len(raw), url, digest, page_id, "response" if refers_to is None else "revisit", refers_to))
                offset += len(raw)
            types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found) if found else [[]] * 8, types)], ["file", "offset", "length", "url", "digest", "page_id", "record_type", "refers_to"])
        if out is not None:
            out.close()

    return settle(rows.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(run, _INDEX), "warc-index")


def read(selected: DataFrame, folder: str, gap: int = GAP, most: int = RANGE, payload: bool = True) -> DataFrame:
    """The records named by ``selected`` index rows; neighbouring byte ranges of a file are read at once.

    Ranges are joined over gaps of up to ``gap`` bytes until ``most`` bytes; a longer record is read alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        name, f = None, None
        for b in batches:
            rows = list(zip(*(b.column(k).to_pylist() for k in range(3))))
            i = 0
            while i < len(rows):
                file, start, end, j = rows[i][0], rows[i][1], rows[i][1] + rows[i][2], i + 1
                while j < len(rows) and rows[j][0] == file and rows[j][1] - end <= gap and rows[j][1] + rows[j][2] - start <= most:
                    end, j = max(end, rows[j][1] + rows[j][2]), j + 1
                if file != name:
                    if f is not None:
                        f.close()
                    name, f = file, fs.open_input_file(f"{base}/{file}")
                block = f.read_at(end - start, start)
                got = [parse(block[o - start:o - start + n]) for _, o, n in rows[i:j]]
                cols = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}
                yield pa.RecordBatch.from_arrays([pa.array([g[c] if payload or c != "payload" else None for g in got], t) for c, t in cols.items()], list(cols))
                i = j
        if f is not None:
            f.close()

    at = selected.select("file", "offset", "length").repartitionByRange(partitions(selected.sparkSession), "file", "offset").sortWithinPartitions("file", "offset")
    return at.mapInArrow(run, _RECORDS)


def round_trip(pages: DataFrame, key: str = "page_id", text: str = "html", smallest: int = SMALLEST) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page, as read back from the archives.

    Null payloads are empty; null urls have no target header; page ids are integers.
    """
    folder = work_path(pages.sparkSession, "warc")
    index = write(revisits(pages, key, text, smallest), folder)
    return read(index, folder, payload=False).select(F.col("page_id").alias(key), "payload_bytes", "payload_digest", "record_type", "refers_to")
