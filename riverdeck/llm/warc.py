"""WARC archives: a writer, and a reader that splits them.

An archive is a row of gzip members, one record each. The reader deals byte ranges to tasks. A task scans
its range for gzip's magic bytes, takes a place for a member only if it inflates to a WARC header that can
be read, goes on from member to member from there, and owns the records that start inside its range; the
last of them may end beyond it. So one large archive is read by many tasks, without an index.

Payloads that occur more than once and have at least `REVISIT_BYTES` are written once: the record of the
largest page_id is the response, the others are revisits that refer to it and have no payload.

Archives are written by the tasks under names of their own; only names that a finished task has handed
back are read, so a task that runs again leaves no record twice. Memory is one record.

Defined cases: a null html is an empty payload; a null url has no Target-URI; a null page_id is never the
response others refer to unless no copy has an id, and then all are responses; rows with one page_id and
one payload are all responses; line breaks in urls are percent-encoded; an empty table writes no archive.
Only page_id, url and html are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverdeck.llm.columns import text_or_empty
from riverdeck.llm.shipping import ship
from riverdeck.session import pinned, scratch_path

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 512 * 2 ** 20
SPLIT_BYTES = 4 * 2 ** 20
TASK_BYTES = 128 * 2 ** 20  # of archives that a task reads, split by split, where there are more than a cluster's slots
READ_BYTES = 256 * 2 ** 10
MAGIC = b"\x1f\x8b\x08"
STEP_BYTES = 64 * 2 ** 10
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:riverdeck:page:"


def record(page_id: str, url: str | None, payload: bytes, digest: str, size: int, refers_to: str | None) -> bytes:
    """One gzip member. `digest` and `size` are the full payload's; a revisit has the HTTP header only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{ID}{page_id}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: <{ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, root: str) -> DataFrame:
    """Write the pages' records below `root`; (path, bytes) of each archive."""
    ship(pages.sparkSession)
    payload = F.encode(text_or_empty("html"), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("bigint"))
    copies = pinned(rows.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(
        F.count("*").alias("n"), F.max("page_id").alias("target")).filter("n > 1").select("digest", "target"), "copies")
    typed = rows.join(copies, "digest", "left").withColumn("refers_to", F.when(
        (F.col("size") >= REVISIT_BYTES) & F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target")),
        F.col("target")))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, folder = fs.FileSystem.from_uri(root)
        out, path, written = None, "", 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None or written >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                        yield pd.DataFrame({"path": [path], "bytes": [written]})
                    store.create_dir(folder, recursive=True)
                    path = f"{folder}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                    out, written = store.open_output_stream(path, compression=None), 0
                member = record(row.page_id or "", row.url, row.payload or b"", row.digest, int(row.size), row.refers_to)
                out.write(member)
                written += len(member)
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [path], "bytes": [written]})

    return pinned(typed.select(
        F.col("page_id").cast("string").alias("page_id"), "url",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "digest", "size",
        F.col("refers_to").cast("string").alias("refers_to")).mapInPandas(write, "path string, bytes bigint"), "archives")


class _Window:
    """Bytes of a file from any place on, read ahead in pieces."""

    def __init__(self, file):
        self.file, self.start, self.held = file, 0, b""
        self.size = file.size()

    def at(self, place: int, want: int) -> memoryview:
        """Up to `want` bytes from `place`; fewer only at the file's end."""
        want = min(want, self.size - place)
        if want <= 0:
            return memoryview(b"")
        if not self.start <= place or place + want > self.start + len(self.held):
            self.file.seek(place)
            self.start, self.held = place, self.file.read(max(want, READ_BYTES))
        low = place - self.start
        return memoryview(self.held)[low:low + want]


def _head(data: bytes) -> tuple[dict[str, str], int] | None:
    """The header fields of a record (names in lower case) and where its block starts; None if it has none."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/1.") or end < 0:
        return None
    fields = {}
    for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        return None
    return fields, end + 4


def _is_record(window: _Window, place: int) -> bool:
    """Whether a member starts here that inflates to a WARC header, however long that is."""
    unpack, data, seen = zlib.decompressobj(31), bytearray(), 0
    try:
        while not unpack.eof:
            piece = unpack.unconsumed_tail
            if not piece:
                piece = window.at(place, 4096)
                place += len(piece)
            out = unpack.decompress(piece, STEP_BYTES)
            data += out
            if not data.startswith(b"WARC/1."[:len(data)]) or data.find(b"\r\n\r\n", seen) >= 0:
                break
            if not (piece or out):
                break  # the file ends inside the header
            seen = max(0, len(data) - 3)
    except zlib.error:
        return False
    return _head(bytes(data)) is not None


def _member(window: _Window, place: int) -> tuple[bytes, int]:
    """A member's content, and where the next one starts."""
    unpack, parts = zlib.decompressobj(31), []
    while not unpack.eof:
        piece = window.at(place, 16_384)
        if not piece:
            raise EOFError("an archive ends inside a record")
        place += len(piece)
        parts.append(unpack.decompress(piece))
    return b"".join(parts), place - len(unpack.unused_data)


def records(file, start: int, end: int) -> Iterator[bytes]:
    """The records that start in [start, end)."""
    window, place = _Window(file), start
    while place < end:
        if not (window.at(place, 3) == MAGIC and _is_record(window, place)):
            seen = bytes(window.at(place + 1, min(READ_BYTES // 2, end - place - 1 + len(MAGIC) - 1)))
            found = seen.find(MAGIC)
            place = place + 1 + (found if found >= 0 else max(len(seen) - len(MAGIC) + 1, 1))
            continue
        data, place = _member(window, place)
        yield data


def parsed(data: bytes, with_payload: bool) -> tuple:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, intact, payload) of a record."""
    fields, at = _head(data)
    block = memoryview(data)[at:at + int(fields["content-length"])]
    http = data.find(b"\r\n\r\n", at) + 4 - at
    stated = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
    page_id = fields["warc-record-id"].strip("<>").removeprefix(ID) or None
    refers_to = fields["warc-refers-to"].strip("<>").removeprefix(ID) if "warc-refers-to" in fields else None
    if fields["warc-type"] == "revisit":
        size = next(int(line.partition(b":")[2]) for line in bytes(block[:http]).split(b"\r\n")
                    if line.lower().startswith(b"content-length:"))
        return page_id, fields.get("warc-target-uri"), "revisit", size, stated, refers_to, True, None
    payload = block[http:]
    digest = hashlib.sha1(payload).hexdigest()
    return (page_id, fields.get("warc-target-uri"), "response", len(payload), digest, refers_to, digest == stated,
            bytes(payload) if with_payload else None)


def read_archives(archives: DataFrame, root: str, with_payload: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, bytes) of archives -> their records. A task reads a byte range, or, where ranges outnumber the
    cluster's slots by far, as many as make up `TASK_BYTES`."""
    ship(archives.sparkSession)
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(split_bytes).cast("bigint"))
    splits = archives.filter("bytes > 0").select("path", F.explode(starts).alias("start"), F.least(
        F.col("start") + split_bytes, "bytes").alias("end"))
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "intact", "payload"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = fs.FileSystem.from_uri(root)
        for batch in batches:
            for split in batch.itertuples(index=False):
                with store.open_input_file(split.path) as file:
                    rows = []
                    for data in records(file, split.start, split.end):
                        rows.append(parsed(data, with_payload))
                        if len(rows) == 256:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=names)

    count, size = splits.agg(F.count("*"), F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0))).first()
    slots = 4 * archives.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(count, max(slots, -(-size // TASK_BYTES))))
    return splits.repartition(tasks).mapInPandas(
        read, "page_id string, url string, record_type string, payload_bytes bigint, payload_digest string, "
              "refers_to string, intact boolean, payload binary")


def archive_report(pages: DataFrame) -> DataFrame:
    """The pages written as archives and read back."""
    root = scratch_path(pages.sparkSession, "warc")
    found = read_archives(write_archives(pages, root), root, with_payload=False)
    kind = pages.schema["page_id"].dataType
    return found.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast(kind).alias("refers_to"))


WARC_SQL = f"""
with hashed as (select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as digest from pages),
last as (select digest, max(page_id) as target from hashed where n >= {REVISIT_BYTES} group by digest)
select page_id, cast(n as bigint) as payload_bytes, h.digest as payload_digest,
       case when target is not null and page_id is distinct from target then 'revisit' else 'response' end as record_type,
       case when target is not null and page_id is distinct from target then target end as refers_to
from hashed h left join last l on h.digest = l.digest and n >= {REVISIT_BYTES}
"""
