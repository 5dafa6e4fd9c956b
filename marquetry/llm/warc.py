"""WARC archives: a writer of one gzip member per record, and a sequential reader.

Writer. Each task writes the records of its partition to archives of bounded size in the shared
folder, under names that hold the task's attempt; only archives that a finished task reports are
read, so what a lost attempt left behind is never seen. Of records with equal payloads of at least
``least_bytes`` the one with the largest page_id is a response and the others are revisits that
refer to it; shorter ones are all responses.

Reader. An archive is read once from front to back: compressed bytes go through an incremental
decompressor, a new one for each gzip member, a record's block is framed by its Content-Length, and
block and payload digests are verified. A broken frame or digest raises an error.

Contract. A null payload is empty and a null URL is left out. Rows that share page_id and payload
are records of their own, all of them responses if they have the largest page_id. A null page_id is
never the largest unless all are null. An empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.session import scratch_path, staged

#: Payloads shorter than this are stored again rather than referred to.
LEAST_BYTES = 1000
#: Size of compressed records after which a task begins another archive.
ARCHIVE_BYTES = 256 << 20
DATE = "1970-01-01T00:00:00Z"
LEVEL = 4
CHUNK = 1 << 18
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Extension field with the table's key, as WARC readers pass over names they do not know.
KEY_FIELD = "X-Page-Id"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, sha1_hex: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {sha1_hex}')}>"


def _one_line(value: str) -> str:
    """A field's value without line ends and other control characters, as a URL escapes them."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def encode_record(
    page_id: int | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: int | None, is_revisit: bool
) -> bytes:
    """One record as one gzip member."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not is_revisit:
        block += payload
    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, sha1_hex)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()),
        ("WARC-Block-Digest", _sha1(block)),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(3, ("WARC-Target-URI", _one_line(url)))
    if page_id is not None:
        fields.append((KEY_FIELD, str(page_id)))
    if is_revisit:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(refers_to, sha1_hex))]
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"
    return zlib.compress(head + block + b"\r\n\r\n", LEVEL, 31)


def _decompressed(stream, chunk: int) -> Iterator[bytes | None]:
    """Pieces of the decompressed archive; None where a gzip member ends."""
    member, rest = None, b""
    while data := rest or stream.read(chunk):
        rest = b""
        member = member or zlib.decompressobj(31)
        if piece := member.decompress(data, 4 * chunk):
            yield piece
        rest = member.unconsumed_tail
        if member.eof:
            rest, member = member.unused_data, None
            yield None
    if member is not None:
        raise ValueError("the archive ends within a gzip member")


class _Frames:
    """Bytes of one gzip member after another, by line end or by length."""

    def __init__(self, stream, chunk: int):
        self._pieces, self._held, self._ended = _decompressed(stream, chunk), bytearray(), False

    def _more(self) -> bool:
        if self._ended or (piece := next(self._pieces, b"")) is None:
            self._ended = True
            return False
        self._held += piece
        return bool(piece)

    def until(self, mark: bytes) -> bytes | None:
        """What stands before ``mark``; None at the end of the archive."""
        seen = 0
        while (at := self._held.find(mark, seen)) < 0:
            seen = max(0, len(self._held) - len(mark))
            if not self._more():
                if self._held:
                    raise ValueError("a record ends within its header")
                return None
        out = bytes(self._held[:at])
        del self._held[: at + len(mark)]
        return out

    def exactly(self, n: int) -> bytes:
        while len(self._held) < n:
            if not self._more():
                raise ValueError("a record is shorter than its Content-Length")
        out = bytes(self._held[:n])
        del self._held[:n]
        return out

    def end_of_member(self) -> None:
        while not self._ended and not self._held:
            self._more()
        if self._held:
            raise ValueError("a gzip member holds more than one record")
        self._ended = False


def read_records(stream, chunk: int = CHUNK) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and payload of each record in an archive, verified; a revisit's payload is empty."""
    frames = _Frames(stream, chunk)
    while (head := frames.until(b"\r\n\r\n")) is not None:
        first, *lines = head.split(b"\r\n")
        if not first.startswith(b"WARC/"):
            raise ValueError("a record does not begin with its version")
        fields = {k.decode().lower(): v.strip().decode() for k, _, v in (x.partition(b":") for x in lines)}
        block = frames.exactly(int(fields["content-length"]))
        if frames.exactly(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its Content-Length says")
        frames.end_of_member()
        if fields["warc-block-digest"] != _sha1(block):
            raise ValueError(f"block digest of {fields['warc-record-id']} differs")
        payload = block.partition(b"\r\n\r\n")[2]
        if fields["warc-type"] == "response" and fields["warc-payload-digest"] != _sha1(payload):
            raise ValueError(f"payload digest of {fields['warc-record-id']} differs")
        yield fields, payload


def with_revisits(pages: DataFrame, page_id: str, payload: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, sha1 and, for rows that repeat another's payload, that row's page_id."""
    rows = pages.withColumns({"sha1": F.sha1(payload), "bytes": F.octet_length(payload)})
    repeated = (
        rows.filter(F.col("bytes") >= least_bytes)
        .groupBy("sha1", "bytes")
        .agg(F.max(page_id).alias("keeper"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .drop("copies")
    )
    revisit = F.coalesce(F.col("keeper") > F.col(page_id), F.col("keeper").isNotNull() & F.col(page_id).isNull())
    return rows.join(repeated, ["sha1", "bytes"], "left").withColumn("revisit", F.coalesce(revisit, F.lit(False)))


def write(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = LEAST_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write the archives and return (archive, records, bytes), a row for each."""
    columns = pages.select(page_id, url, F.coalesce(payload, F.lit("")).alias(payload))
    rows = with_revisits(columns, page_id, payload, least_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, base = pafs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        out, done, path, records, size = None, [], "", 0, 0
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(batch.num_columns)), strict=True):
                key, url_at, data, sha1_hex, keeper, is_revisit = (v.as_py() for v in row)
                if out is None:
                    path, records, size = f"{name}-{len(done):04d}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{base}/{path}", compression=None)
                member = encode_record(key, url_at, data.encode(), sha1_hex, keeper, is_revisit)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    out = done.append((f"{folder}/{path}", records, size))
        if out is not None:
            out.close()
            done.append((f"{folder}/{path}", records, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["archive", "records", "bytes"])

    chosen = rows.select(page_id, url, payload, "sha1", "keeper", "revisit")
    return staged(chosen.mapInArrow(run, "archive string, records long, bytes long"), "archives")


READ_SCHEMA = (
    "record_id string, record_type string, page_id long, target_uri string, "
    "payload_bytes long, payload_digest string, refers_to_record string"
)


def read(archives: DataFrame, archive: str = "archive", with_payload: bool = False) -> DataFrame:
    """The records of the archives named in ``archives``, an archive read by one task from front to back.

    A revisit has the digest that its fields name, and null payload_bytes.
    """
    schema = READ_SCHEMA + ", payload binary" * with_payload

    def rows(path: str) -> Iterator[dict]:
        files, at = pafs.FileSystem.from_uri(path)
        with files.open_input_stream(at, compression=None) as stream:
            for fields, payload in read_records(stream):
                response = fields["warc-type"] == "response"
                key = fields.get(KEY_FIELD.lower())
                yield {
                    "record_id": fields["warc-record-id"],
                    "record_type": fields["warc-type"],
                    "page_id": None if key is None else int(key),
                    "target_uri": fields.get("warc-target-uri"),
                    "payload_bytes": len(payload) if response else None,
                    "payload_digest": base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex(),
                    "refers_to_record": fields.get("warc-refers-to"),
                    "payload": payload if with_payload else None,
                }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema(
            [(f, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[k]) for f, k in (c.split(" ") for c in schema.split(", "))]
        )
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held, size = [], 0
                for row in rows(path):
                    held.append(row)
                    size += len(row["payload"] or b"")
                    if len(held) == 1000 or size > 16 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=kinds)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=kinds)

    # A number of partitions that is given stays as it is; few bytes name much work here.
    return archives.select(archive).repartition(max(1, archives.count()), archive).mapInArrow(run, schema)


def with_referred(records: DataFrame) -> DataFrame:
    """Revisits with the page and payload size of the response that they refer to, its digest checked."""
    named = records.filter("refers_to_record IS NOT NULL").select(F.col("refers_to_record").alias("record_id")).distinct()
    referred = (
        records.filter("record_type = 'response'")
        .join(named, "record_id", "left_semi")
        .groupBy(F.col("record_id").alias("refers_to_record"))
        .agg(
            F.max("page_id").alias("refers_to"),
            F.max("payload_bytes").alias("referred_bytes"),
            F.max("payload_digest").alias("referred_digest"),
        )
    )
    checked = F.when(
        F.col("refers_to_record").isNull() | (F.col("referred_digest") == F.col("payload_digest")), F.col("payload_digest")
    ).otherwise(F.raise_error(F.lit("a revisit's response is missing or differs")))
    return records.join(referred, "refers_to_record", "left").select(
        "page_id",
        F.coalesce("payload_bytes", "referred_bytes").alias("payload_bytes"),
        checked.alias("payload_digest"),
        "record_type",
        "refers_to",
        "record_id",
        "target_uri",
    )


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back, record by record."""
    folder = scratch_path(pages.sparkSession, "warc")
    archives = write(pages, folder, page_id, url, payload)
    return with_referred(staged(read(archives), "records"))
