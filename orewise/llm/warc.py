"""WARC archives with a chunked record table.

Payloads are written to and read from archives as rows of at most ``chunk_bytes`` bytes,
told apart by record identifier and chunk number, each with the SHA-256 of the payload up
to its end. The reader holds one chunk at a time, the writer the payloads of one small batch
of rows (Spark's own rows hold a payload whole) and packs them chunk by chunk. A record longer than its archive
still has room for goes into it whole; archives are closed at ``archive_bytes``.

Archives are files of the shared folder, opened through pyarrow's file systems, so its URI
may be that of any store that pyarrow and Spark both reach. A task writes files under
names of its own and only the manifest that it returns makes them part of the result, so
tasks that are lost or run twice leave no record behind.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from itertools import chain

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, small_batches, work_path, written

CHUNK_BYTES = 1 << 20
ARCHIVE_BYTES = 64 << 20
#: Payloads below this length never are revisits.
REVISIT_BYTES = 100
#: Tasks that read archives, at most; each takes its archives one after another.
READERS = 20_000
#: Level of the records' own gzip members.
LEVEL = 1
MANIFEST = "archive string, records long, bytes long"
CHUNKS = "page_id long, record_id string, record_type string, refers_to long, url string, chunk int, data binary, end long, sha256 string, last boolean"


def _open(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


def notes(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """pages(page_id, html) -> page_id, digest, refers_to, repeated, to_repeated: what is special about rows of a page_id and payload.

    refers_to is the smallest page_id that has the payload, of least_bytes or more, if that
    is another one (a null page_id is another one); repeated says that several rows are equal
    in page_id and payload, to_repeated that several are so in refers_to and payload. Rows
    with nothing of it have no line. Payloads are compared by SHA-256; groups of copies of
    any size are partial aggregates, and texts aren't shuffled.
    """
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "utf-8"), F.lit("").cast("binary"))
    ids = pages.select(F.col("page_id").cast("long"), F.sha2(payload, 256).alias("digest"), (F.octet_length(payload) >= least_bytes).alias("long"))
    same = written(ids.groupBy("page_id", "digest", "long").agg(F.count("*").alias("n")), "digests")
    first = (
        same.where("long").groupBy("digest")
        .agg(F.min("page_id").alias("least"), F.min_by("n", "page_id").alias("n_least"), F.count("*").alias("pages"))
        .where("pages > 1 and least is not null").drop("pages")
    )
    other = F.coalesce(F.col("page_id") > F.col("least"), F.col("least").isNotNull())
    out = same.join(first, "digest", "left").select(
        "page_id", "digest", F.when(other, F.col("least")).alias("refers_to"), (F.col("n") > 1).alias("repeated"), (other & (F.col("n_least") > 1)).alias("to_repeated")
    )
    return out.where("refers_to is not null or repeated")


def _header(kind: str, rid: str, url: str | None, length: int, sha: str, refers: str | None) -> bytes:
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{rid}>"), ("WARC-Date", "1970-01-01T00:00:00Z")]
    fields += [("WARC-Target-URI", " ".join(url.split()))] if url else []
    fields += [("WARC-Refers-To", f"<urn:uuid:{refers}>")] if refers else []
    fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")] if kind == "revisit" else []
    fields += [("WARC-Payload-Digest", f"sha256:{sha}"), ("Content-Type", "text/html"), ("Content-Length", str(length))]
    return b"WARC/1.1\r\n" + "".join(f"{a}: {b}\r\n" for a, b in fields).encode() + b"\r\n"


class _Archive:
    """One archive being written: a gzip member for each record."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        fs, path = _open(self.uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.file, self.records, self.bytes = fs.open_output_stream(path), 0, 0

    def add(self, pieces) -> None:
        pack = zlib.compressobj(LEVEL, wbits=31)
        for x in pieces:
            self.put(pack.compress(x))
        self.put(pack.flush())
        self.records += 1

    def put(self, data: bytes) -> None:
        if data:
            self.file.write(data)
            self.bytes += len(data)

    def close(self) -> tuple[str, int, int]:
        self.file.close()
        return self.uri, self.records, self.bytes


def record_id(page_id: int | None, digest: str) -> str:
    """The identifier of the only record of a page_id and payload."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}"))


def write(pages: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """pages(page_id, url, html) -> the manifest (archive, records, bytes) of the archives below folder.

    A record for a row; the payload is the html in UTF-8 (null: empty). Revisits hold the
    payload's digest and length and no payload. Rows equal in page_id and payload to the
    smallest page_id's are responses, and a null page_id revisits any other of its payload.
    Every record has an identifier of its own: it follows from page_id and payload where one
    row alone has them, and is drawn at random where rows repeat. A revisit names its response's
    identifier, if there is but one, and always its page_id.
    """
    small_batches(pages.sparkSession, 200)
    known = written(notes(pages), "notes").select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "refers_to", "repeated", "to_repeated")
    few = known.count() <= BROADCAST_ROWS
    source = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    source = source.withColumn("digest", F.sha2(F.coalesce(F.encode("html", "utf-8"), F.lit("").cast("binary")), 256))
    same = F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d"))
    source = source.join(F.broadcast(known) if few else known, same, "left").select("page_id", "url", "refers_to", "digest", "html", "repeated", "to_repeated")

    def run(batches):
        archive = None
        for batch in batches:
            for page_id, url, refers, digest, html, repeated, to_repeated in zip(*(batch.column(k) for k in range(7))):
                payload = memoryview(html.as_buffer() if html.is_valid else b"")
                page, to, sha = page_id.as_py(), refers.as_py(), digest.as_py()
                archive = archive or _Archive(folder)
                own = str(uuid.uuid4()) if repeated.as_py() else record_id(page, sha)
                other = None if to is None or to_repeated.as_py() else record_id(to, sha)
                head = _header("response" if to is None else "revisit", own, url.as_py(), len(payload) if to is None else 0, sha, other)
                more = [] if page is None else [f"X-Page-ID: {page}"]
                more += [] if to is None else [f"X-Refers-To-Page: {to}", f"X-Payload-Length: {len(payload)}"]
                head = head[:-2] + "".join(f"{x}\r\n" for x in more).encode() + b"\r\n"
                body = () if to is not None else (payload[k : k + chunk_bytes] for k in range(0, len(payload), chunk_bytes))
                archive.add(chain((head,), body, (b"\r\n\r\n",)))
                if archive.bytes >= archive_bytes:
                    yield _manifest(archive)
                    archive = None
        if archive:
            yield _manifest(archive)

    return written(source.mapInArrow(run, MANIFEST), "manifest")


def _manifest(archive: _Archive) -> pa.RecordBatch:
    uri, records, size = archive.close()
    return pa.RecordBatch.from_pydict({"archive": [uri], "records": pa.array([records], pa.int64()), "bytes": pa.array([size], pa.int64())})


class _Plain:
    """The plain bytes of a file of gzip members, never more than asked for plus one read."""

    def __init__(self, file, read_bytes: int = 1 << 16):
        self.file, self.size, self.pack, self.raw, self.ready = file, read_bytes, None, b"", bytearray()

    def fill(self, n: int) -> bool:
        """Until n bytes are ready, or the file ends."""
        while len(self.ready) < n:
            if not self.raw:
                self.raw = self.file.read(self.size)
                if not self.raw:
                    return False
            self.pack = self.pack or zlib.decompressobj(wbits=31)
            self.ready += self.pack.decompress(self.raw, max(n - len(self.ready), 1 << 16))
            self.raw = self.pack.unconsumed_tail
            if self.pack.eof:
                self.raw, self.pack = self.pack.unused_data, None
        return True

    def take(self, n: int) -> bytes:
        if not self.fill(n):
            raise EOFError("an archive ends within a record")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out

    def header(self) -> dict[str, str] | None:
        while (at := self.ready.find(b"\r\n\r\n")) < 0:
            if not self.fill(len(self.ready) + 1):
                if self.ready:
                    raise EOFError("an archive ends within a header")
                return None
        lines = self.take(at + 4).decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("no WARC record here")
        return {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:] if x)}


def _chunks(file, chunk_bytes: int):
    """A tuple in the order of CHUNKS for each chunk of each record."""
    plain = _Plain(file)
    while (head := plain.header()) is not None:
        left, end, k, sha = int(head["content-length"]), 0, 0, hashlib.sha256()
        page, to = head.get("x-page-id"), head.get("x-refers-to-page")
        same = (page and int(page), head["warc-record-id"][10:-1], head["warc-type"], to and int(to), head.get("warc-target-uri"))
        while left or not k:
            data = plain.take(min(left, chunk_bytes))
            left, end = left - len(data), end + len(data)
            sha.update(data)
            digest = sha.hexdigest() if to is None else head["warc-payload-digest"].removeprefix("sha256:")
            yield (*same, k, data, end if to is None else int(head["x-payload-length"]), digest, not left)
            k += 1
        if to is None and "sha256:" + digest != head["warc-payload-digest"]:
            raise ValueError(f"the payload of {same[1]} has another digest")
        if plain.take(4) != b"\r\n\r\n":
            raise ValueError("a record's end is missing")


def read(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The archives of a manifest -> CHUNKS, one row per chunk of a record; an empty payload has one.

    end is the number of payload bytes up to and with the chunk.
    sha256 is the digest of the payload up to and with the chunk, carried from chunk to
    chunk; the last one's is checked against the header. A revisit has one empty chunk and
    its response's digest. A broken archive raises.
    """
    schema = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("chunk", pa.int32()), ("data", pa.binary()), ("end", pa.int64()), ("sha256", pa.string()), ("last", pa.bool_())])

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), schema)], schema=schema)

    def run(batches):
        for files in batches:
            for uri in files.column(0).to_pylist():
                fs, path = _open(uri)
                with fs.open_input_stream(path) as file:
                    rows, size = [], 0
                    for x in _chunks(file, chunk_bytes):
                        rows.append(x)
                        size += len(x[6]) + 500
                        if size > 4 * chunk_bytes:
                            yield batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch(rows)

    files = manifest.select("archive")
    return files.repartition(min(READERS, max(1, files.count())), "archive").mapInArrow(run, CHUNKS)


def payloads(chunks: DataFrame) -> DataFrame:
    """CHUNKS -> page_id, payload_bytes, payload_digest, record_type, refers_to: a row for a record.

    The last chunk's running length and digest are the payload's, so nothing is gathered.
    """
    return chunks.where("last").select(
        "page_id", F.col("end").alias("payload_bytes"), F.col("sha256").alias("payload_digest"), "record_type", "refers_to"
    )


def archived(pages: DataFrame) -> DataFrame:
    """The chunk table of archives of pages, written to a new folder of the shared one and read back."""
    return read(write(pages, work_path(pages.sparkSession, "warc")))
