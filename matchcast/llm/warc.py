"""WARC archives with an index, read back by coalesced byte ranges."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchcast.llm.common import byte_texts, join_groups, map_arrow, settle, shared_folder

LEAST_SHARED = 1000  # bytes from which equal payloads are written once
ARCHIVE_BYTES = 128 << 20
GAP = 64 << 10  # bytes between two wanted records that are read along
RANGE_BYTES = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2020-01-01T00:00:00Z"  # pages carry no date, and reruns should write the same bytes


def _line(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unline(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record, a gzip member of its own. A revisit has the headers of its page, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {RECORD_DATE}"]
    head.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


def parse_record(member: bytes) -> dict:
    """The headers and the block of a record, and of the block the payload."""
    whole = zlib.decompress(member, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"the record {fields.get('WARC-Record-ID')} does not end where it says")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    return {"fields": fields, "payload": payload, "payload_bytes": length}


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


INDEX = "archive string, offset long, length long, url string, digest string, page_id long, record_type string"


def _writer(folder: str):
    """Each task writes archives of its own names, so that what a lost or repeated task left is in no index."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(folder)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            ids, urls, refs = (batch.column(c).to_pylist() for c in ("page_id", "url", "refers_to"))
            for page, url, payload, digest, revisits, ref in zip(
                ids, urls, byte_texts(batch.column("html")), batch.column("digest").to_pylist(), batch.column("revisits").to_pylist(), refs
            ):
                kind = "revisit" if revisits else "response"
                data = record(page, url, payload, digest, kind, ref)
                if out is None or at + len(data) > ARCHIVE_BYTES and at:
                    if out is not None:
                        out.close()
                    file, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    name, out = f"{folder}/{file}", store.open_output_stream(f"{path}/{file}", compression=None)
                out.write(data)
                rows.append((name, at, len(data), url, digest, page, kind))
                at += len(data)
            if rows:
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in INDEX.split(", ")])
        if out is not None:
            out.close()

    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)`` below ``folder``; the index of the records is returned.

    Of rows with equal payloads of at least ``LEAST_SHARED`` bytes those with the largest page_id are responses (all, if
    they repeat), the others revisits that refer to it; smaller payloads are responses. A row without page_id revisits
    any that has one. The index is written as Parquet in the same folder, and only its records count: a task that is
    run again writes new archives. ``folder`` is a URI or path all executors can write to.
    """
    spark = pages.sparkSession
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    size = F.octet_length("html")
    groups = rows.filter(size >= LEAST_SHARED).groupBy("digest", size.alias("bytes")).agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    groups = settle(groups.filter("n > 1"))
    joined = join_groups(rows.withColumn("bytes", size), groups, ["digest", "bytes"], "n", F.struct("page_id", "url"))
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    typed = joined.select("page_id", "url", "html", "digest", revisits.alias("revisits"), F.when(revisits, F.col("first")).alias("refers_to"))
    where = spark._jvm.org.apache.hadoop.fs.Path(folder + "/archives")
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(where)
    uri = store.makeQualified(where).toUri()
    index = map_arrow(typed, _writer(f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"), INDEX)
    index.write.parquet(folder + "/index")
    return spark.read.parquet(folder + "/index")


def _ranges(entries: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Join neighbours to ranges: ``(archive, offset, length, [(offset, length)])``."""
    held: list[tuple[int, int]] = []
    archive, begin, end = "", 0, 0
    for name, offset, length in entries:
        if held and (name != archive or offset - end > GAP or offset + length - begin > RANGE_BYTES):
            yield archive, begin, end - begin, held
            held = []
        if not held:
            archive, begin, end = name, offset, offset
        held.append((offset, length))
        end = max(end, offset + length)
    if held:
        yield archive, begin, end - begin, held


RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _reader(keep_payload: bool):
    def run(batches):
        opened, source = "", None
        for batch in batches:
            entries = list(zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))))
            for archive, begin, length, members in _ranges(entries):
                if archive != opened:
                    store, path = pafs.FileSystem.from_uri(archive)
                    source, opened = store.open_input_file(path), archive
                data = source.read_at(length, begin)
                out = []
                for offset, size in members:
                    found = parse_record(data[offset - begin : offset - begin + size])
                    fields, kind = found["fields"], found["fields"]["WARC-Type"]
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and hashlib.sha1(found["payload"]).hexdigest() != digest:
                        raise ValueError(f"the payload of {fields['WARC-Record-ID']} has another digest")
                    url = fields.get("WARC-Target-URI")
                    out.append(
                        (_page(fields["WARC-Record-ID"]), None if url is None else _unline(url), kind, _page(fields.get("WARC-Refers-To")),
                         found["payload_bytes"], digest, found["payload"] if keep_payload else None)
                    )
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], [f.split()[0] for f in RECORDS.split(", ")])

    return run


def read_records(index: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records that ``index`` lists, which may be any selection of a written index.

    Entries are sorted by archive and offset over all tasks; a task reads neighbours that are at most ``GAP``
    bytes apart in one range of at most ``RANGE_BYTES`` (a larger record alone), and checks each response's digest.
    """
    wanted = index.select("archive", "offset", "length").repartitionByRange("archive", "offset").sortWithinPartitions("archive", "offset")
    return map_arrow(wanted, _reader(keep_payload), RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read every record back."""
    index = write_archives(pages, shared_folder(pages.sparkSession))
    return read_records(index, keep_payload=False)
