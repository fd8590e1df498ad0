"""WARC archives in which equal payloads are written once.

Revisits are resolved on headers alone: page id, digest and sizes are shuffled by digest, the row
with the largest page id of each becomes the response, and the others are joined to it. Payloads
meet their resolved headers once, when the archives are written with fresh headers; a revisit has
no payload. Archives are written by Spark's text writer, with gzip, and so to any store: a
record's last line feed is the writer's line end.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from station_telemetry.llm.common import stored
from station_telemetry.session import new_folder

#: Bytes of an archive file that records are dealt for; a longer record has a file of its own size.
FILE_BYTES = 16 << 20
#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN = "2024-01-01T00:00:00Z"
_SALTS = 32


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _headed(batches):
    for batch in batches:
        press = zstandard.ZstdCompressor(level=3).compress
        payloads = [h or b"" for h in batch.column("html").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array([len(p) for p in payloads], pa.int64()),
                pa.array([payload_digest(p) for p in payloads]),
                pa.array([press(p) for p in payloads], pa.binary()),
            ],
            names=["page_id", "url", "payload_bytes", "payload_digest", "squeezed"],
        )


def resolved(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds record_type, refers_to (page_id) and target (uid) to headers.

    headers: uid (unique), page_id, payload_bytes, payload_digest. Equal payloads of at least
    `least_bytes` have one response, the largest (page_id, uid), nulls smallest; the rest revisit it.
    """
    rank = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "uid")
    large = headers.where(F.col("payload_bytes") >= least_bytes)
    # The winner of a digest is combined per task first, and goes to every salt of a crowded digest.
    first = large.groupBy("payload_digest").agg(F.max(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(
        "payload_digest",
        F.col("first.page_id").alias("first_page"),
        F.col("first.uid").alias("first_uid"),
        F.explode(
            F.when(F.col("n") > 10_000, F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(-1)))
        ).alias("salt"),
    )
    calm, crowded = first.where("salt < 0").drop("salt"), first.where("salt >= 0")
    joined = headers.join(calm, "payload_digest", "left")
    if not crowded.isEmpty():
        salted = headers.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(_SALTS)).cast("int"))
        hot = crowded.select("payload_digest").distinct()
        joined = (
            headers.join(F.broadcast(hot), "payload_digest", "left_anti").join(calm, "payload_digest", "left")
        ).unionByName(
            salted.join(F.broadcast(hot), "payload_digest", "left_semi")
            .join(crowded, ["payload_digest", "salt"])
            .drop("salt")
        )
    revisit = F.col("first_uid").isNotNull() & (F.col("first_uid") != F.col("uid"))
    return joined.select(
        "uid",
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_page")).alias("refers_to"),
        F.when(revisit, F.col("first_uid")).alias("target"),
    )


def _record_id(uid: int) -> str:
    h = hashlib.sha256(b"record %d" % uid).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-4{h[13:16]}-8{h[17:20]}-{h[20:32]}>"


def record(
    uid: int, page_id: int | None, url: str | None, size: int, payload: bytes, digest: str, target: int | None
) -> bytes:
    """A record with fresh headers; with a target it is a revisit and has no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if target is not None else http + payload
    lines = [
        VERSION,
        f"WARC-Type: {'response' if target is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(uid)}",
        f"WARC-Date: {WRITTEN}",
        "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        f"Page-Row: {uid}",
        "Page-ID: " + ("" if page_id is None else str(page_id)),
    ]
    if target is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(target)}", f"Refers-To-Row: {target}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _recorded(batches):
    for batch in batches:
        got = batch.to_pydict()
        payloads = [b"" if z is None else zstandard.decompress(z) for z in batch.column("squeezed").to_pylist()]
        # The writer ends each row with the record's last line feed.
        yield pa.RecordBatch.from_pydict(
            {
                "value": pa.array(
                    [
                        record(*x)[:-1]
                        for x in zip(got["uid"], got["page_id"], got["url"], got["payload_bytes"], payloads, got["payload_digest"], got["target"])
                    ],
                    pa.binary(),
                )
            }
        )


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Writes a record for every row of pages (page_id, url, html) to WARC files below `path`.

    Null html is an empty payload, a null url an empty target. Rows that repeat a page_id are
    records of their own. An empty table leaves a folder without records. Other columns are ignored.
    """
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        pages["html"].alias("html"),
    )
    rows = rows.mapInArrow(
        _headed, "page_id long, url string, payload_bytes long, payload_digest string, squeezed binary"
    )
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()), "pages")
    headers = rows.select("uid", "page_id", "payload_bytes", "payload_digest")
    found = resolved(headers, least_bytes).select("uid", "target")
    n, total, most = headers.agg(F.count(F.lit(1)), F.sum("payload_bytes"), F.max("payload_bytes")).first()
    mean = (total or 0) // max(1, n) + 700
    per_file = max(1, min(FILE_BYTES // mean, 8 * FILE_BYTES // ((most or 0) + 700)))
    joined = rows.join(found, "uid").withColumn("squeezed", F.when(F.col("target").isNull(), F.col("squeezed")))
    values = joined.mapInArrow(_recorded, "value binary").select(F.col("value").cast("string").alias("value"))
    values.write.option("lineSep", "\n").option("maxRecordsPerFile", per_file).option(
        "compression", "gzip"
    ).text(path)


def parsed(data: bytes):
    """(headers, block) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"no record begins at byte {at}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        size = int(headers["Content-Length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) != size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut short")
        yield headers, block
        at = end + 8 + size


def _read(batches):
    for batch in batches:
        for content in batch.column("content"):
            out = {n: [] for n in ("uid", "page_id", "url", "record_type", "target", "digest", "payload")}
            for headers, block in parsed(gzip.decompress(content.as_py())):
                payload = block.split(b"\r\n\r\n", 1)[1]
                revisit = headers["WARC-Type"] == "revisit"
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if not revisit and payload_digest(payload) != digest:
                    raise ValueError(f"payload of {headers['WARC-Record-ID']} isn't what its digest says")
                out["uid"].append(int(headers["Page-Row"]))
                out["page_id"].append(int(headers["Page-ID"]) if headers["Page-ID"] else None)
                out["url"].append(headers["WARC-Target-URI"])
                out["record_type"].append(headers["WARC-Type"])
                out["target"].append(int(headers["Refers-To-Row"]) if revisit else None)
                out["digest"].append(digest)
                out["payload"].append(None if revisit else payload)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out)
            )


def read_archives(spark, path: str) -> DataFrame:
    """(uid, page_id, url, record_type, target, digest, payload) of all records below `path`.

    A file is read whole, so `write_archives` bounds their size. The payload of a revisit is null.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    schema = (
        "uid long, page_id long, url string, record_type string, target long, digest string, payload binary"
    )
    return files.select("content").mapInArrow(_read, schema)


def originals(records: DataFrame) -> DataFrame:
    """Revisits joined to the responses they refer to: page_id, payload_bytes and so on, one row each."""
    sized = records.select(
        "uid", "page_id", "record_type", "target", "digest", F.octet_length("payload").cast("long").alias("size")
    )
    sized = stored(sized, "records")
    used = sized.where("record_type = 'revisit'").select(F.col("target").alias("of")).distinct()
    responses = sized.where("record_type = 'response'").select(
        F.col("uid").alias("of"),
        F.col("page_id").alias("refers_to"),
        F.col("size").alias("of_size"),
        F.col("digest").alias("of_digest"),
    )
    joined = sized.withColumn("of", F.col("target")).join(responses.join(used, "of", "left_semi"), "of", "left")
    return joined.select(
        "page_id",
        F.coalesce("size", "of_size").alias("payload_bytes"),
        F.coalesce("of_digest", "digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op4_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = new_folder(spark, "archives")
    write_archives(pages, path)
    return originals(read_archives(spark, path))
