"""WARC archives, each record a Zstandard frame under a dictionary that leads the file."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trivet.llm.common import hash60, new_path

#: Format constants: the skippable frame that holds a dictionary, a Zstandard frame.
DICT_MAGIC, ZSTD_MAGIC = 0x184D2A5D, 0xFD2FB528


def train_dictionary(samples: list[bytes], size: int = 112_640) -> bytes:
    """A dictionary from whole records; too few or too small samples give an empty one."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 10)), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has no payload, but its length and digest are those of the page."""
    kind = "revisit" if revisit else "response"
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{url}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-Id: {'' if refers_to is None else refers_to}"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and HTTP body of each record; frames are decompressed one by one, so memory holds one record."""
    head = stream.read(8)
    if len(head) < 8:
        return
    magic, size = struct.unpack("<II", head)
    if magic != DICT_MAGIC:
        raise ValueError("no dictionary frame leads the archive")
    raw = stream.read(size)
    unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw)) if raw else zstandard.ZstdDecompressor()
    rest = b""
    while True:
        frame, parts = unzip.decompressobj(), []
        while not frame.eof:
            data = rest or stream.read(1 << 16)
            rest = b""
            if not data:
                if parts:
                    raise ValueError("the archive ends within a record")
                return
            parts.append(frame.decompress(data))
        rest = frame.unused_data
        header, _, tail = b"".join(parts).partition(b"\r\n\r\n")
        lines = header.decode().split("\r\n")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        body = tail[: int(fields["Content-Length"])]
        yield fields, body.partition(b"\r\n\r\n")[2]


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    min_payload: int = 0,
    level: int = 3,
    dict_samples: int = 1000,
    dict_max_record: int = 65_536,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> str:
    """Writes a record for each page, an archive for each task, and returns the folder.

    The dictionary is trained on the driver from the dict_samples pages with the smallest id hash
    among those of at most dict_max_record bytes (bounds on the training alone), and leads every
    archive in a skippable frame; each record is a frame of its own. Of pages with one payload of
    min_payload bytes or more the one with the smallest id (null last, then the first row) is the
    response; the others are revisits that name it. Rows are told apart by their place in the scan, so
    pages must read alike each time, as files do. Smallest ids come from a map-side aggregate on the payload's
    SHA-256, and payloads that occur once need no join partner; hot payloads are salted.

    Null html is an empty payload; of rows that repeat one page id and payload one at most is the
    response. An empty table gives a folder without archives; other columns are ignored. An archive is written under a name of its attempt and renamed when whole, so a lost
    or doubled task leaves no part behind. The folder must be one that pyarrow's file systems open
    (file, hdfs, s3, gs); it lies in the shared folder unless given.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), F.monotonically_increasing_id().alias("row"))
    h = hash60(F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    share = p.count()
    sample = p.where(F.octet_length("html").between(1, dict_max_record)).where(h < int(min(1.0, 2.0 * dict_samples / max(1, share)) * (1 << 60)))
    few = sample.withColumn("h", h).orderBy("h").limit(dict_samples).collect()
    dictionary = train_dictionary([record(r["page_id"], r["url"], x := r["html"].encode(), _digest(x), None, False) for r in few])

    id_order = F.struct(F.col("page_id").isNull().alias("n"), F.col("page_id").alias("v"), F.col("row").alias("r"))
    ids = p.select("page_id", "row", F.sha2("html", 256).alias("d"), F.octet_length("html").alias("b")).where(F.col("b") >= min_payload)
    salts = 16
    salt = F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int")
    twice = ids.groupBy("d").agg(F.min(id_order).alias("first"), F.count("*").alias("k")).where("k > 1")
    twice = twice.select("d", F.col("first.v").alias("refers"), F.col("first.r").alias("fr"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("s"))
    later = ids.withColumn("s", salt).join(twice, ["d", "s"]).where("row <> fr").select("row", "d", "refers", F.lit(True).alias("again"))
    p = p.withColumn("d", F.sha2("html", 256))
    todo = p.join(later, ["row", "d"], "left").select("page_id", "url", "html", "refers", F.coalesce("again", F.lit(False)).alias("again"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        name = f"{base}/pages-{task.partitionId():06d}"
        draft = f"{base}/_draft-{task.taskAttemptId()}"
        zip_ = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor(level=level)
        fs.create_dir(base, recursive=True)
        n = 0
        with fs.open_output_stream(draft, compression=None) as out:
            out.write(dictionary_frame(dictionary))
            for b in batches:
                for i in range(b.num_rows):
                    page, url, html, refers, again = (c[i].as_py() for c in b.columns)
                    payload = html.encode()
                    out.write(zip_.compress(record(page, url, payload, _digest(payload), refers, again)))
                    n += 1
        fs.move(draft, f"{name}.warc.zst")
        yield pa.RecordBatch.from_arrays([pa.array([f"{name}.warc.zst"]), pa.array([n], pa.int64())], names=["file", "n"])

    done = todo.mapInArrow(write, "file string, n long").agg(F.sum("n")).first()[0] or 0
    if done != share:
        raise RuntimeError(f"{done} records written of {share} pages")
    return folder


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def read_archives(spark, folder: str) -> DataFrame:
    """A row for each record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    Archives are read as streams, one record in memory; a response whose payload does not have its
    recorded digest and length is an error.
    """
    fs, base = pafs.FileSystem.from_uri(folder)
    found = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))
    names = sorted(f.path for f in found if f.path.endswith(".warc.zst"))
    files = spark.createDataFrame([(x,) for x in names], "file string").repartition(max(1, len(names)))
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                with store.open_input_stream(name, compression=None) as stream:
                    rows, size = [], 0
                    for f, payload in read_archive(stream):
                        digest, n = f["WARC-Payload-Digest"].removeprefix("sha1:"), int(f["X-Payload-Length"])
                        if f["WARC-Type"] == "response" and (len(payload) != n or _digest(payload) != digest):
                            raise ValueError(f"a damaged record in {name}")
                        page, refers = f["X-Page-Id"], f.get("X-Refers-To-Page-Id")
                        rows.append((int(page) if page else None, f["WARC-Target-URI"], n, digest, f["WARC-Type"], int(refers) if refers else None, payload))
                        size += n
                        if size > 4_000_000:
                            yield _batch(rows)
                            rows, size = [], 0
                    yield _batch(rows)

    return files.mapInArrow(read, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)], names=[n for n, _ in kinds])
