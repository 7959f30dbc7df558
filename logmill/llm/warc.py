"""Web archives: writing records, an index of them, and reading selected records by coalesced byte ranges.

Each task writes archives of its own in the folder given, one gzip member a record, and returns the index rows of what it wrote. The index
is a Parquet table that only finished tasks reach, so an archive that a lost task left behind is never read. Readers take the index, sort
the selected records by file and offset, and fetch neighbouring ones with one read.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, joined, partitions, scratch_path, slices, written

FILE_BYTES = 1 << 30  # an archive is closed beyond this
GAP, SPAN = 64 << 10, 8 << 20  # ranges with a smaller gap between are read together, up to this many bytes
FEW = 500_000  # pages that refer to others, if their list is broadcast
INDEX = "file string, offset long, length long, page_id long, url string, payload_digest string, record_type string"


def plan_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, url, html (null: empty), digest (SHA-1, bare lower-case hex), payload_bytes, refers_to.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest page_id is written in full, the others refer to it.
    If several rows carry that page_id, all of them are written in full; a null page_id is smaller than any other, and if all are null all
    are written in full. Which pages refer to others is found on digests alone, without html: hot digests are split (see ``joined``). That
    list of pages is broadcast while it has at most ``FEW`` rows; beyond, pages meet it by page_id and digest, of which none is hot.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("long").alias("payload_bytes"))
    long = written(rows.where(F.col("payload_bytes") >= least).select("page_id", F.unhex("digest").alias("key")), "digests")
    again = written(long.groupBy("key").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "last"), "repeated")
    revisits = joined(long, again, "key").where(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))).distinct()
    revisits = written(revisits.select(F.col("page_id").alias("p"), "key", F.col("last").alias("refers_to")), "revisits")
    dropped(long)
    dropped(again)
    side = F.broadcast(revisits) if revisits.count() <= FEW else revisits
    return rows.join(side, F.col("page_id").eqNullSafe(F.col("p")) & (F.unhex("digest") == F.col("key")), "left").drop("p", "key")


def _record(page_id: int | None, url: str | None, html: str, digest: str, size: int, refers_to: int | None) -> bytes:
    name = "null" if page_id is None else page_id
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",  # the table has no time
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
    ]
    body = b""
    if refers_to is None:
        body = html.encode("utf-8")
        head.append("Content-Type: text/html; charset=utf-8")
    else:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the rows of ``plan_records`` as archives in ``folder``; the index of what was written, a row a record, kept in ``folder``/index.

    ``folder`` is a URL that all executors reach. An empty table gives an empty index.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    if out is None or offset >= file_bytes:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        store.create_dir(root, recursive=True)
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    data = gzip.compress(_record(r["page_id"], r["url"], r["html"], r["digest"], r["payload_bytes"], r["refers_to"]), 1, mtime=0)
                    out.write(data)
                    rows.append((name, offset, len(data), r["page_id"], r["url"], r["digest"], "response" if r["refers_to"] is None else "revisit"))
                    offset += len(data)
                columns = list(zip(*rows, strict=True)) or [()] * 7
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["file", "offset", "length", "page_id", "url", "payload_digest", "record_type"])
        finally:
            if out is not None:
                out.close()

    index = records.select("page_id", "url", "html", "digest", "payload_bytes", "refers_to").mapInArrow(run, INDEX)
    index.write.parquet(f"{folder}/index")
    return records.sparkSession.read.parquet(f"{folder}/index")


def coalesced(entries: list[tuple[int, int]], gap: int = GAP, span: int = SPAN) -> Iterator[tuple[int, int, list[int]]]:
    """(start, end, entries inside) of the reads that fetch sorted (offset, length) entries."""
    start = end = 0
    inside: list[int] = []
    for k, (offset, length) in enumerate(entries):
        if inside and (offset - end > gap or offset + length - start > span):
            yield start, end, inside
            inside = []
        if not inside:
            start = end = offset
        end = max(end, offset + length)
        inside.append(k)
    if inside:
        yield start, end, inside


def _parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    plain = zlib.decompress(data, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def read_archives(selected: DataFrame, folder: str, stretch: int = 64 << 20) -> DataFrame:
    """The records of the index rows ``selected``: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload (null for a revisit).

    Records are dealt to tasks by file and stretch of ``stretch`` bytes and read in the order of their offsets. A response whose payload
    has another digest or length than its header says stops the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)

        def page(text: str | None) -> int | None:
            return None if text is None or text == "<urn:page:null>" else int(text[len("<urn:page:") : -1])

        def parse(data: bytes) -> tuple:
            fields, body = _parsed(data)
            kind, digest, size = fields["WARC-Type"], fields["WARC-Payload-Digest"][5:], int(fields["X-Payload-Length"])
            if kind == "response" and (len(body) != size or hashlib.sha1(body).hexdigest() != digest):
                raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
            return page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, page(fields.get("WARC-Refers-To")), size, digest, body if kind == "response" else None

        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        for batch in batches:
            files = batch.column(0).to_pylist()
            where = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            a = 0
            for b in range(1, len(files) + 1):
                if b < len(files) and files[b] == files[a]:
                    continue
                with store.open_input_file(f"{root}/{files[a]}") as f:
                    for start, end, inside in coalesced(where[a:b]):
                        f.seek(start)
                        data = f.read(end - start)
                        rows = [parse(data[o - start : o - start + n]) for o, n in (where[a + k] for k in inside)]
                        for i, j in slices([r[6] or b"" for r in rows], 8 << 20):
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:j], strict=True), kinds, strict=True)], names=names)
                a = b

    spark = selected.sparkSession
    dealt = selected.select("file", "offset", "length").repartition(partitions(spark), "file", F.floor(F.col("offset") / stretch)).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


def archive_and_read_back(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all ``pages`` as archives in a new folder of the shared one (or in ``folder``) and read every record back.

    A null html is an empty payload, a null url an empty target; extra columns are ignored. Result as of ``read_archives``. The archives
    stay, as the result is read from them; remove the folder once that is done with.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    index = write_archives(plan_records(pages), folder)
    return read_archives(index, folder)
