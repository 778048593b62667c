"""WARC archives as seekable Zstandard bundles with an index of records."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from orestack.llm.common import saved
from orestack.sources import workspace

# Fixed values of the seekable format: the skippable frame of the seek table, and the end of its footer.
SEEK_FRAME, SEEK_END = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
INDEX = "page_id long, bundle string, frame long, offset long, length long"
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, "
          "payload binary")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names another response."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
              f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        fields.append("WARC-Target-URI: " + url.replace("\n", "%0A").replace("\r", "%0D"))
    fields += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                   f"WARC-Refers-To: <urn:page:{refers_to}>"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """The fields of ``RECORD`` from the bytes of a record; a payload that fails its digest is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not have its digest")

    def page(name: str) -> int | None:
        found = fields.get(name, "<urn:page:null>")[10:-1]
        return None if found == "null" else int(found)

    return (page("WARC-Record-ID"), fields.get("WARC-Target-URI"), kind, page("WARC-Refers-To"), digest,
            int(fields["X-Payload-Length"]), payload if kind == "response" else None)


class Bundle:
    """A file of independent Zstandard frames of whole records, and a seek table at its end."""

    def __init__(self, path: str):
        import zstandard
        from pyarrow import fs

        self.path = path
        system, place = fs.FileSystem.from_uri(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.file = system.open_output_stream(place, compression=None)
        self.compressor = zstandard.ZstdCompressor(level=3, write_content_size=True)
        self.frames: list[tuple[int, int]] = []
        self.pending, self.size, self.written = [], 0, 0
        self.entries: list[tuple[int | None, str, int, int, int]] = []

    def add(self, page_id: int | None, raw: bytes) -> None:
        self.entries.append((page_id, self.path, len(self.frames), self.size, len(raw)))
        self.pending.append(raw)
        self.size += len(raw)
        if self.size >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.pending:
            packed = self.compressor.compress(b"".join(self.pending))
            self.file.write(packed)
            self.frames.append((len(packed), self.size))
            self.written += len(packed)
            self.pending, self.size = [], 0

    def close(self) -> pd.DataFrame:
        """Ends the file; the index rows of its records."""
        self.flush()
        table = b"".join(struct.pack("<II", *frame) for frame in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEK_END)
        self.file.write(struct.pack("<II", SEEK_FRAME, len(table)) + table)
        self.file.close()
        return pd.DataFrame(self.entries, columns=["page_id", "bundle", "frame", "offset", "length"]).astype({"page_id": "Int64"})


class Frames:
    """The frames of a bundle by number, read through its seek table."""

    def __init__(self, path: str):
        import zstandard
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(place)
        end = self.file.size()
        number, _, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != SEEK_END:
            raise ValueError(f"{path} has no seek table")
        table = self.file.read_at(8 * number, end - 9 - 8 * number)
        self.sizes = [struct.unpack_from("<II", table, 8 * i) for i in range(number)]
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)
        self.decompressor = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        packed, size = self.sizes[number]
        return self.decompressor.decompress(self.file.read_at(packed, self.starts[number]), max_output_size=size)


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per page to bundles below ``folder``; returns the index, also kept as a table.

    ``pages`` has ``page_id``, ``url`` and ``html``; others are not read. Of pages with equal payloads the
    one with the smallest id becomes a response and the others revisit it; a null html is an empty
    payload, and empty payloads are equal too. A null id is never named by a revisit: pages that have
    only null ids are all responses, and so are rows that repeat the smallest id. Line ends in a URL are
    percent-encoded. An empty table gives an empty index. A task writes files under names of its own, and the index names those of the attempt
    that counted, so a lost executor leaves at most files that no index row points to.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha1", F.sha1("html"))
    # Written, so that a hot payload meets a plain shuffle, which adaptive execution can split.
    first = saved(rows.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                  .filter("n > 1").select("sha1", "first"), "warc-firsts")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    known = rows.join(first, "sha1", "left").select("page_id", "url", "html", "sha1", refers.alias("refers_to"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle, part = None, TaskContext.get().partitionId()

        def number(value) -> int | None:
            return None if pd.isna(value) else int(value)

        for batch in batches:
            for page_id, url, html, sha1, refers_to in zip(*(batch[c] for c in batch.columns)):
                if bundle is None:
                    bundle = Bundle(f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.warc.zst")
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                bundle.add(number(page_id), record(number(page_id), url, html.encode(), digest, number(refers_to)))
                if bundle.written >= BUNDLE_BYTES:
                    yield bundle.close()
                    bundle = None
        if bundle is not None:
            yield bundle.close()

    # Ids travel as text, so that a null does not turn long ids into floats.
    text = known.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return saved(text.mapInPandas(write, INDEX), "warc-index")


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that index rows point to, with the columns of ``RECORD``.

    Every frame that is needed is read by its place in the seek table and unpacked once per task.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, frames, data = (None, None), None, b""
        for batch in batches:
            out, size = [], 0
            for bundle, frame, offset, length in zip(batch["bundle"], batch["frame"], batch["offset"], batch["length"]):
                if bundle != at[0]:
                    frames = Frames(bundle)
                if (bundle, frame) != at:
                    data, at = frames.frame(frame), (bundle, frame)
                found = parse(data[offset: offset + length])
                out.append(found if payloads else (*found[:-1], None))
                size += length if payloads else 0
                if size > FRAME_BYTES * 16:
                    yield table(out)
                    out, size = [], 0
            if out:
                yield table(out)

    def table(rows: list[tuple]) -> pd.DataFrame:
        names = [field.split()[0] for field in RECORD.split(", ")]
        return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    near = index.withColumn("_stretch", F.expr("frame div 64")).repartition("bundle", "_stretch")
    return near.sortWithinPartitions("bundle", "frame", "offset").mapInPandas(read, RECORD)


def archive(pages: DataFrame) -> DataFrame:
    """Writes the pages to bundles in the shared folder and reads every record back."""
    folder = workspace.new_folder(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return read_records(write_bundles(pages, folder), payloads=False)
