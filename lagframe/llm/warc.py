"""WARC archives written with an index first, read by coalesced byte ranges.

Payloads are grouped by digest, and of equal ones the record with the
largest page_id is the response, the others revisit it. Each task writes
its records as single gzip members to archives of its own and reports for
each record file, offset, length, URL and digest; that index is a written
table. A reader selects index rows, sorts them by file and offset, joins
neighbouring ranges to one read and parses the records out of it, so it
touches only the selected parts of the archives.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagframe.llm.common import RangeReader, make_folder, map_columns, open_output, pick, stage
from lagframe.session import scratch_path

ARCHIVE_BYTES = 1 << 30    # a task starts a new archive beyond this
READ_BYTES = 8 << 20       # of one read at most, unless a record is longer
TASK_BYTES = 32 << 20      # of archives that a reading task takes, about
READ_GAP = 64 << 10        # unselected bytes read over rather than sought
RECORD_DATE = "2024-01-01T00:00:00Z"
# Fixed values of the WARC format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:lagframe:page:"

INDEX_SCHEMA = ("page_id long, path string, offset long, length long, url string, payload_digest string, "
                "record_type string, refers_to long")
RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<{RECORD_ID}{'null' if page_id is None else page_id}>"


def parse_id(text: str | None) -> int | None:
    value = text[len(RECORD_ID) + 1:-1] if text else "null"
    return None if value == "null" else int(value)


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, keeper: int | None) -> bytes:
    """One record as a gzip member; a revisit of ``keeper`` holds no payload."""
    revisit = keeper is not None and keeper != page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)),
              ("WARC-Date", RECORD_DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", str(len(block)))]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(keeper))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return gzip.compress(f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n", 6, mtime=0)


def parse_record(member: bytes) -> tuple:
    """The RECORD_SCHEMA values of one gzip member; a response's payload is measured anew."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"no WARC record: {version[:40]}")
    field = dict(x.split(": ", 1) for x in lines)
    http, _, payload = rest[:int(field["Content-Length"])].partition(b"\r\n\r\n")
    digest, kind = field["WARC-Payload-Digest"].removeprefix("sha1:"), field["WARC-Type"]
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if kind == "response" and (base32_sha1(payload), len(payload)) != (digest, size):
        raise ValueError(f"{field['WARC-Record-ID']}: payload doesn't match its digest")
    return (parse_id(field["WARC-Record-ID"]), size, digest, kind, parse_id(field.get("WARC-Refers-To")),
            field.get("WARC-Target-URI"))


def write_archives(pages: DataFrame, path: str, min_payload: int = 0) -> DataFrame:
    """Write a record per row and return the index, a written table.

    Null html is an empty payload, equal to any other; payloads under
    ``min_payload`` bytes are never revisited. Null URLs give records without
    a target. Of rows repeated under the page_id that is the response, all
    are responses; a null page_id revisits a numbered equal or is a response.
    An empty table writes no archive. Very large pages are one record.
    """
    make_folder(path)
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = (pick(pages, "page_id", "url", "html").select("page_id", "url", html.alias("payload"))
            .withColumn("digest", F.sha1("payload")))
    copies = rows.where(F.octet_length("payload") >= min_payload) if min_payload else rows
    keepers = stage(copies.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
                    .where("n > 1 and keeper is not null").select("digest", "keeper"), "keepers")
    joined = rows.join(keepers, "digest", "left").select("page_id", "url", "payload", "digest", "keeper")

    def write(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        out, to, offset = None, "", 0
        for batch in batches:
            index: dict[str, list] = {c.split()[0]: [] for c in INDEX_SCHEMA.split(", ")}
            for page_id, url, payload, sha1, keeper in zip(*batch.values(), strict=True):
                if out is None or offset > ARCHIVE_BYTES:
                    if out:
                        out.close()
                    # a name of its own for every attempt; the index lists those of finished tasks
                    to, offset = f"{path}/{uuid.uuid4().hex}.warc.gz", 0
                    out = open_output(to)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                record = make_record(page_id, url, payload, digest, keeper)
                out.write(record)
                revisit = keeper is not None and keeper != page_id
                values = (page_id, to, offset, len(record), url, digest, "revisit" if revisit else "response",
                          keeper if revisit else None)
                for column, value in zip(index.values(), values, strict=True):
                    column.append(value)
                offset += len(record)
            yield index
        if out:
            out.close()

    return stage(map_columns(joined, write, INDEX_SCHEMA), "warc-index")


def coalesced(rows: list[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Runs of (path, offset, length), sorted, that are worth one read each."""
    run: list[tuple[str, int, int]] = []
    for path, offset, length in rows:
        if run and (path != run[-1][0] or offset > run[-1][1] + run[-1][2] + READ_GAP
                    or offset + length - run[0][1] > READ_BYTES):
            yield run
            run = []
        run.append((path, offset, length))
    if run:
        yield run


def read_records(index: DataFrame) -> DataFrame:
    """The records of the given index rows, read and checked."""
    ordered = pick(index, "path", "offset", "length")
    # the index is small beside the archives: tasks follow the bytes they read
    tasks = -(-(ordered.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES) or 1
    ordered = ordered.repartitionByRange(tasks, "path", "offset").sortWithinPartitions("path", "offset")

    def read(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        opened = ("", None)
        for batch in batches:
            for run in coalesced(list(zip(batch["path"], batch["offset"], batch["length"], strict=True))):
                path, first = run[0][:2]
                if opened[0] != path:
                    if opened[1]:
                        opened[1].__exit__()
                    opened = (path, RangeReader(path))
                block = opened[1].read(first, max(o + n for _, o, n in run) - first)
                records = [parse_record(block[o - first:o - first + n]) for _, o, n in run]
                yield {c.split()[0]: [r[i] for r in records] for i, c in enumerate(RECORD_SCHEMA.split(", "))}

    return map_columns(ordered, read, RECORD_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Every page as read back from the archives, by way of the index."""
    return read_records(write_archives(pages, scratch_path(pages.sparkSession, "warc")))
