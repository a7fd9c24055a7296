"""WARC archives: pages as records, a normaliser for archives in one gzip stream, and reading by offsets.

``write_archives`` writes monolithic archives, one gzip stream for a whole file. ``normalise`` inflates each file once,
as a stream, rewrites every record as a gzip member of its own and writes a sidecar index of their offsets, so that
``read_records`` can inflate single records. Payloads that repeat become revisit records without payload that refer to
the response; what a revisit stands for is read from that response.

Cases: a null payload is empty; payloads under ``least`` bytes and pages without an id are always responses; rows that
share both id and payload are written each; a null url leaves the target out; control characters in a url are escaped;
an empty table makes no archives; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backsight.llm import files
from backsight.llm.components import write

READ = 1 << 20
_PAGE = "urn:x-page:"
_INDEX = "page_id long, record_type string, refers_to long, digest string, url string, archive string, offset long, size long"


def duplicate_roles(pages: DataFrame, least: int = 100, page: str = "page_id", payload: str = "html") -> DataFrame:
    """(page_id, digest, refers_to) of the pages that revisit the smallest page with an equal payload."""
    body = F.encode(F.coalesce(F.col(payload).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page).cast("long").alias("page_id"), F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("size"))
    rows = rows.where((F.col("size") >= least) & F.col("page_id").isNotNull()).select("page_id", "digest")
    rows, _ = write(rows, "page-digests")
    first = rows.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("last > refers_to")
    return rows.join(first.select("digest", "refers_to"), "digest").where("page_id > refers_to").distinct()


def _record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{_PAGE}{'null' if page is None else page}>"), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)))
    head.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if refers_to is None:
        block += payload
    else:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<{_PAGE}{refers_to}>")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _page_of(value: str | None) -> int | None:
    found = (value or "").strip("<>").removeprefix(_PAGE)
    return int(found) if found not in ("", "null") else None


def records(blocks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(head, the record's bytes with head and closing line ends) from an inflated stream, one record held at a time."""
    held = bytearray()
    more = iter(blocks)

    def fill(size: int) -> bool:
        while len(held) < size:
            block = next(more, None)
            if block is None:
                return False
            held.extend(block)
        return True

    while fill(1):
        looked, end = 0, -1
        while (end := held.find(b"\r\n\r\n", looked)) < 0:
            looked = max(0, len(held) - 3)
            if not fill(len(held) + 1):
                raise ValueError("the archive ends inside a head")
        head = parse_head(bytes(held[:end]))
        size = end + 4 + int(head["content-length"]) + 4
        if not fill(size) or held[size - 4 : size] != b"\r\n\r\n":
            raise ValueError("the archive ends inside a record")
        yield head, bytes(held[:size])
        del held[:size]


def inflated(file) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, in bounded blocks."""
    inflater, packed, begun = zlib.decompressobj(31), b"", False
    while packed or (packed := file.read(READ)):
        block, begun = inflater.decompress(packed, READ), True
        packed = inflater.unconsumed_tail
        if block:
            yield block
        if inflater.eof:
            packed, inflater, begun = inflater.unused_data, zlib.decompressobj(31), False
    while begun and (block := inflater.decompress(inflater.unconsumed_tail, READ)):
        yield block
    if begun and not inflater.eof:
        raise ValueError("the gzip stream is cut")


def write_archives(pages: DataFrame, least: int = 100, page: str = "page_id", url: str = "url", payload: str = "html", most_bytes: int = 256 << 20) -> DataFrame:
    """(archive): the written files, each one gzip stream of at most about ``most_bytes``."""
    folder = files.new_folder(pages.sparkSession, "archives")
    roles = duplicate_roles(pages, least, page, payload)
    body = F.encode(F.coalesce(F.col(payload).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256)).join(roles, ["page_id", "digest"], "left").select("page_id", "url", "body", "digest", "refers_to")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, made, size = None, [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    made.append(files.new_file(folder, ".warc.gz"))
                    out, packer, size = files.writer(made[-1]), zlib.compressobj(6, zlib.DEFLATED, 31), 0
                packed = packer.compress(_record(*row))
                out.write(packed)
                size += len(packed)
                if size >= most_bytes:
                    out.write(packer.flush())
                    out.close()
                    out = None
        if out is not None:
            out.write(packer.flush())
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], ["archive"])

    written, _ = write(rows.mapInArrow(work, "archive string"), "archive-list")
    return written


def _spread(listed: DataFrame, count: int) -> DataFrame:
    return listed.repartitionByRange(max(1, count), "archive")


def normalise(archives: DataFrame) -> DataFrame:
    """One row per record of the rewritten archives: what it is and at which offset its member lies.

    Each archive is inflated once; beside each new archive lies a sidecar ``.idx`` with a line for every record.
    """
    folder = files.new_folder(archives.sparkSession, "normalised")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address in batch.column(0).to_pylist():
                target = files.new_file(folder, ".warc.gz")
                out, index, offset, rows = files.writer(target), files.writer(f"{target}.idx"), 0, []
                for head, record in records(inflated(files.reader(address))):
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = packer.compress(record) + packer.flush()
                    out.write(member)
                    digest = head.get("warc-payload-digest", "").removeprefix("sha256:")
                    row = (_page_of(head.get("warc-record-id")), head["warc-type"], _page_of(head.get("warc-refers-to")), digest, head.get("warc-target-uri"), target, offset, len(member))
                    index.write(f"{offset} {len(member)} {head['warc-type']} {head['warc-record-id']} {digest}\n".encode())
                    rows.append(row)
                    offset += len(member)
                    if len(rows) >= 4096:
                        yield _index_batch(rows)
                        rows = []
                out.close()
                index.close()
                yield _index_batch(rows)

    made, _ = write(_spread(archives, archives.count()).mapInArrow(work, _INDEX), "record-index")
    return made


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _INDEX.split(", ")]
    kinds = [pa.int64() if x.endswith("long") else pa.string() for x in _INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def read_records(index: DataFrame) -> DataFrame:
    """(page_id, record_type, refers_to, payload_bytes, payload_digest) read from each record's own member.

    The payload of a revisit is that of the response it refers to.
    """
    ranges = index.select("archive", "offset", "size").repartition("archive", F.floor(F.col("offset") / (64 << 20))).sortWithinPartitions("archive", "offset")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = file = None
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for address, offset, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if address != name:
                    name, file = address, files.reader(address)
                file.seek(offset)
                ((head, record),) = records(iter([zlib.decompress(file.read(size), 31)]))
                block = record[record.index(b"\r\n\r\n") + 4 : -4]
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                named = head["warc-payload-digest"].removeprefix("sha256:")
                response = head["warc-type"] == "response"
                digest = hashlib.sha256(payload).hexdigest() if response else named
                if digest != named:
                    raise ValueError(f"damaged payload in {address} at {offset}")
                row = (_page_of(head["warc-record-id"]), head["warc-type"], _page_of(head.get("warc-refers-to")), len(payload) if response else None, digest)
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"])

    schema = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"
    found, _ = write(ranges.mapInArrow(work, schema), "records")
    responses = found.where("record_type = 'response' and page_id is not null")
    sizes = responses.select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("referred")).distinct()
    revisits = found.where("record_type = 'revisit'").join(sizes, ["refers_to", "payload_digest"], "left")
    revisits = revisits.select("page_id", "record_type", "refers_to", F.col("referred").alias("payload_bytes"), "payload_digest")
    return found.where("record_type <> 'revisit'").unionByName(revisits)
