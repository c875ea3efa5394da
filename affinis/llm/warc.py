"""WARC records in seekable Zstandard bundles.

Every page becomes one WARC/1.1 record. Records are gathered into independent Zstandard frames; a bundle ends with a
skippable frame that holds the seek table (compressed and decompressed size of each frame) in the public seekable format, so
a reader fetches the table from the end of the file and decompresses only the frames it wants. The index maps a record
identifier to bundle, frame, offset in the frame, and length.

Of pages with equal payloads of at least `least` bytes the one with the largest id is stored in full; the others are revisit
records that refer to it. Bundles go to a folder all executors share, under a name of their own for every attempt; a
bundle counts only if its task's index rows were committed.

Defined cases: a null page has an empty payload; null ids are kept, and count as smaller than any other; rows with the same
largest id are all stored in full; a null url leaves out the target; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from affinis.session import pin, scratch_dir

# Fixed values of the formats: seekable Zstandard, WARC.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 256 << 20
INDEX = "record_id string, bundle string, frame long, at long, length long"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record; `digest` is the hex SHA-1 of the payload, `refers_to` the page that holds an equal one."""
    sha = base64.b32encode(bytes.fromhex(digest)).decode()
    body = HTTP % len(payload)
    body += payload if refers_to is None else b""
    head = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}"]
    head += [f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{sha}"]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", c, d) for c, d in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(read_tail) -> list[tuple[int, int]]:
    """(start, compressed size) of each frame; `read_tail(n)` gives the last n bytes of the bundle."""
    count, descriptor, magic = struct.unpack("<IBI", read_tail(9))
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    width = 12 if descriptor & 0x80 else 8
    entries, at, out = read_tail(9 + count * width)[:-9], 0, []
    for k in range(count):
        size = struct.unpack_from("<I", entries, k * width)[0]
        out.append((at, size))
        at += size
    return out


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("/") else f"file://{folder}")


class _Bundle:
    """A bundle being written: collects records into frames, frames into a file."""

    def __init__(self, store, root: str, name: str, frame_bytes: int):
        import zstandard

        self.name, self.frame_bytes = name, frame_bytes
        self.out = store.open_output_stream(f"{root}/{name}", compression=None)
        self.zstd = zstandard.ZstdCompressor(level=3)
        self.frames, self.held, self.size, self.total = [], [], 0, 0

    def add(self, data: bytes) -> tuple[int, int]:
        if self.held and self.size + len(data) > self.frame_bytes:
            self.end_frame()
        place = (len(self.frames), self.size)
        self.held.append(data)
        self.size += len(data)
        return place

    def end_frame(self) -> None:
        packed = self.zstd.compress(b"".join(self.held))
        self.out.write(packed)
        self.frames.append((len(packed), self.size))
        self.total += len(packed)
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self.end_frame()
        self.out.write(seek_table(self.frames))
        self.out.close()


def revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, url, html, digest, refers_to (null for responses).

    Only ids and digests are grouped; the winners of digests that repeat are joined back by digest.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    measured = pages.withColumns({"digest": F.sha1(F.encode(payload, "UTF-8")), "n_bytes": F.octet_length(payload)})
    large = measured.where(F.col("n_bytes") >= least).select("page_id", "digest")
    first = large.groupBy("digest").agg(F.max("page_id").alias("winner"), F.count("*").alias("n")).where("n > 1").drop("n")
    out = measured.join(pin(first), "digest", "left")
    loses = (F.col("n_bytes") >= least) & F.coalesce(F.col("page_id") < F.col("winner"), F.col("winner").isNotNull() & F.col("page_id").isNull())
    return out.select("page_id", "url", "html", "digest", F.when(loses, F.col("winner")).alias("refers_to"))


def write_bundles(
    pages: DataFrame, folder: str, least: int = 1000, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> DataFrame:
    """Write the bundles; returns the committed index (INDEX), one row a record."""

    def write(batches):
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        stem, number, bundle = f"bundle-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", 0, None
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                page_id, url, page, digest, refers_to = (batch.column(c)[k].as_py() for c in range(5))
                data = record(page_id, url, (page or "").encode("utf-8"), digest, refers_to)
                if bundle is None:
                    bundle = _Bundle(store, root, f"{stem}-{number:04d}.warc.zst", frame_bytes)
                frame, at = bundle.add(data)
                rows.append((record_id(page_id, digest), bundle.name, frame, at, len(data)))
                if bundle.total >= bundle_bytes:
                    bundle.close()
                    bundle, number = None, number + 1
            if rows:
                yield pa.RecordBatch.from_pydict(
                    dict(zip(("record_id", "bundle", "frame", "at", "length"), map(list, zip(*rows))))
                )
        if bundle is not None:
            bundle.close()

    slim = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return pin(revisits(slim, least).mapInArrow(write, INDEX))


def fetch(store, root: str, bundle: str, wanted: dict[int, list[tuple[int, int]]]):
    """Records of one bundle by frame and (offset, length), reading the seek table and those frames only."""
    import zstandard

    path, size = f"{root}/{bundle}", store.get_file_info(f"{root}/{bundle}").size
    with store.open_input_file(path) as source:
        frames = read_seek_table(lambda n: source.read_at(n, size - n))
        for frame, places in sorted(wanted.items()):
            start, packed = frames[frame]
            data = zstandard.ZstdDecompressor().decompress(source.read_at(packed, start))
            for at, length in places:
                yield data[at : at + length]


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of the indexed records, from the bundles.

    An index in the order it was written gives each task runs of one bundle; a frame is decompressed once a run.
    """

    def read(batches):
        store, root = _store(folder)
        for batch in batches:
            wanted: dict[str, dict[int, list[tuple[int, int]]]] = {}
            for row in batch.to_pylist():
                wanted.setdefault(row["bundle"], {}).setdefault(row["frame"], []).append((row["at"], row["length"]))
            out = []
            for bundle, frames in wanted.items():
                for data in fetch(store, root, bundle, frames):
                    fields, block = parse(data)
                    head, _, payload = block.partition(b"\r\n\r\n")
                    revisit = fields["WARC-Type"] == "revisit"
                    stated = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    n = int(head.rpartition(b"Content-Length: ")[2])
                    if not revisit and (hashlib.sha1(payload).hexdigest() != stated or len(payload) != n):
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
                    page, target = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
                    out.append((page and int(page), fields.get("WARC-Target-URI"), n, stated, fields["WARC-Type"], target and int(target)))
            columns = list(zip(*out)) or [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            )

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return index.select("record_id", "bundle", "frame", "at", "length").mapInArrow(read, schema)


def warc_round_trip(pages: DataFrame, least: int = 1000) -> DataFrame:
    folder = scratch_dir(pages.sparkSession, "warc")
    return read_records(write_bundles(pages, folder, least), folder)
