"""WARC archives: writing and reading them, and resolving records that repeat a payload."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import discard, join_counted, shuffles_dropped, written

#: Ends the header, the head of the HTTP message and the record.
END = "\r\n\r\n"
LEAST_BYTES = 1000
#: Records of one archive file at most, so that files can be read side by side.
FILE_RECORDS = 50_000
#: Payload bytes of a batch of records.
BATCH_BYTES = 4 << 20
#: Archives are compressed twice and read back twice; higher levels cost more time than they save space.
LEVEL = {"compression": "gzip", "zlib.compress.level": "THREE"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A header field of our own with the id of the row a record was made from.
SOURCE_ID = "X-Source-ID"

_FIELDS = {
    "record_id": "warc-record-id",
    "type": "warc-type",
    "uri": "warc-target-uri",
    "date": "warc-date",
    "source_id": SOURCE_ID.lower(),
    "refers_to": "warc-refers-to",
    "refers_uri": "warc-refers-to-target-uri",
    "profile": "warc-profile",
    "stated_digest": "warc-payload-digest",
    "content_type": "content-type",
}
_RECORDS = ", ".join(f"{name} string" for name in _FIELDS) + (
    ", payload_bytes long, payload_digest string, payload_check long, head binary, payload binary"
)
HTTP = "application/http"


def _field(name: str, value: Column) -> Column:
    """A line of the header, nothing for a null. Line breaks inside of the value are percent-encoded."""
    value = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _record(revisit: bool = False) -> Column:
    """A whole record but for its end, as text of the very bytes. A revisit has no payload."""
    block = [F.col("head")] if revisit else [F.col("head"), F.col("payload")]
    size = sum((F.octet_length(part) for part in block[1:]), F.octet_length(block[0]))
    header = [
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.lit("revisit") if revisit else F.col("type")),
        _field("WARC-Record-ID", F.col("record_id")),
        _field("WARC-Date", F.col("date")),
        _field("WARC-Target-URI", F.col("uri")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field(SOURCE_ID, F.col("source_id")),
        _field("WARC-Refers-To", F.col("refers_to")),
        _field("WARC-Refers-To-Target-URI", F.col("refers_uri")),
        _field("WARC-Profile", F.coalesce("profile", F.lit(PROFILE)) if revisit else F.col("profile")),
        _field("Content-Type", F.col("content_type")),
        F.concat(F.lit("Content-Length: "), size.cast("string"), F.lit(END)),
    ]
    return F.concat(*header, *(part.cast("string") for part in block)).alias("value")


def _write(records: DataFrame, path: str) -> None:
    """Archive files of records, one gzip stream each."""
    out = records.write.option("lineSep", END).options(**LEVEL).option("maxRecordsPerFile", FILE_RECORDS)
    with shuffles_dropped(records.sparkSession):
        out.text(path)


def write_archive(rows: DataFrame, path: str, source_id: str, uri: str, payload: str) -> None:
    """A response record for each row, in `.gz` files below `path`.

    The payload is text (as UTF-8) or binary; null is empty. A null uri or id leaves its header out;
    repeated rows are records of their own. Further columns are not looked at.
    """
    content = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    at = rows.select(
        F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")).alias("record_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        F.col(uri).cast("string").alias("uri"),
        F.col(source_id).cast("string").alias("source_id"),
        content.alias("payload"),
    )
    message = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
    head = F.concat(F.lit(message), F.octet_length("payload").cast("string"), F.lit(END)).cast("binary")
    known = {"type": "response", "content_type": f"{HTTP}; msgtype=response"}
    nothing = {name: F.lit(None).cast("string") for name in ("refers_to", "refers_uri", "profile")}
    _write(
        at.withColumns({"head": head, "payload_digest": F.sha1("payload")} | nothing)
        .withColumns({name: F.lit(value) for name, value in known.items()})
        .select(_record()),
        path,
    )


def _header(chunk: bytes) -> dict[str, str]:
    first, *lines = chunk.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no record starts with {first[:40]!r}")
    fields: dict[str, str] = {}
    name = ""
    for line in lines:
        if line[:1] in (" ", "\t") and name:  # a folded line
            fields[name] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            fields[name] = value.removeprefix(" ")
    return fields


def _records(chunks: Iterator[tuple[str, bytes]]) -> Iterator[tuple[dict, bytes]]:
    """Header and block of every record. A file's chunks are what lies between the places where END
    stands, in order; blocks may hold END, so their length tells where they end."""
    end = END.encode()
    file, fields, need, parts, have = None, None, 0, [], 0
    for name, chunk in chunks:
        if name != file:
            if fields is not None:
                raise ValueError(f"{file} ends inside of a record")
            file = name
        if fields is not None:
            have += len(chunk) + (len(end) if parts else 0)
            parts.append(chunk)
            if have < need:
                continue
            block = end.join(parts) if len(parts) > 1 else chunk
            yield fields, block[:need]
            fields, chunk = None, block[need:]
        chunk = chunk.lstrip(b"\r\n")  # a block that ends with a line break moves the cut
        if chunk:
            fields, parts, have = _header(chunk), [], 0
            need = int(fields["content-length"])
    if fields is not None:
        raise ValueError(f"{file} ends inside of a record")


def _parsed(with_payload: bool):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            files = batch.column("file").to_pylist()
            yield from zip(files, (v.as_py() for v in batch.column("value")), strict=True)

    def rows(out: list[tuple]) -> pa.RecordBatch:
        texts = [pa.array(column, pa.string()) for column in list(zip(*out, strict=True))[: len(_FIELDS)]]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
        rest = [pa.array(c, k) for c, k in zip(list(zip(*out, strict=True))[len(_FIELDS) :], kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*texts, *rest], [part.split()[0] for part in _RECORDS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for fields, block in _records(chunks(batches)):
            head, payload = b"", block
            if fields.get("content-type", "").startswith(HTTP):
                *first, payload = block.partition(END.encode())
                head = b"".join(first)
            check = hashlib.blake2b(payload, digest_size=8).digest()
            out.append(
                (
                    *(fields.get(field) for field in _FIELDS.values()),
                    len(payload),
                    hashlib.sha1(payload).hexdigest(),
                    int.from_bytes(check, "little", signed=True),
                    head,
                    payload if with_payload else None,
                )
            )
            size += len(head) + (len(payload) if with_payload else 256)
            if size > BATCH_BYTES:
                yield rows(out)
                out, size = [], 0
        if out:
            yield rows(out)

    return run


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all `.gz` archives below `path`: header fields, length and SHA-1 of the payload as it was
    read, a second hash of 64 bits, the head of the HTTP message, and the payload unless it isn't asked for.
    The payload of a record that is no HTTP message is its whole block.

    Each file is read by one task as a stream of pieces; no more than a record is held at once. Fields a
    record lacks are null. A file that ends inside of a record is an error. The archives may come
    from elsewhere: payloads are found by their stated length, whatever they hold.
    """
    pieces = spark.read.option("lineSep", END).text(path)
    at = pieces.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    return at.mapInArrow(_parsed(payload), _RECORDS)


def repeated(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Records whose payload another record holds: `record_id` and so on, with `refers_to` and `refers_uri` of the
    original: the one with the greatest source id, as a number (null ids last; of equal ids any one).

    Payloads are equal if length, SHA-1 and a second hash are. Only headers are shuffled, by these three;
    originals of very many records are joined by broadcast. `records` must be a written table.
    """
    keys = ["payload_digest", "payload_check", "payload_bytes"]
    large = records.where((F.col("payload_bytes") >= least_bytes) & (F.col("type") == "response")).drop("refers_to", "refers_uri")
    order = F.struct(F.col("source_id").try_cast("decimal(38,0)").alias("number"), "source_id", "record_id", "uri")
    groups = large.groupBy(*keys).agg(F.count("*").alias("n"), F.max(order).alias("original")).where("n > 1")
    found = join_counted(large, groups, keys, "n").where("record_id <> original.record_id")
    return found.select(
        "record_id", "date", "uri", "source_id", "profile", "content_type", "head", *keys,
        F.col("original.record_id").alias("refers_to"), F.col("original.uri").alias("refers_uri"),
    )


def deduplicate_archive(spark: SparkSession, source: str, target: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write the archive below `source` anew below `target`: of response records with equal payloads of at least
    `least_bytes` one stays, and the others become revisit records without payload that refer to it.

    Headers are written afresh: lengths and digests are those of the payload as it was read, and header fields
    other than those of `read_archive` go. HTTP heads and records of other types stay; earlier revisits
    stay too and refer to the record that holds the payload now."""
    headers = written(read_archive(spark, source, payload=False).drop("payload"))
    revisits = written(repeated(headers, least_bytes))
    others = read_archive(spark, source).where("type IS DISTINCT FROM 'revisit'")
    # by hash at every size: ids of revisits grow with the archive and are not broadcast, payloads not sorted
    others = others.join(revisits.select("record_id").hint("shuffle_hash"), "record_id", "left_anti").select(_record())
    moved = revisits.select(
        F.col("record_id").alias("refers_to"), F.col("refers_to").alias("now"), F.col("refers_uri").alias("now_uri")
    )
    earlier = headers.where("type = 'revisit'").join(moved, "refers_to", "left").withColumns(
        {
            "refers_to": F.coalesce("now", "refers_to"),
            "refers_uri": F.coalesce("now_uri", "refers_uri"),
            "payload_digest": F.regexp_replace("stated_digest", "^sha1:", ""),
        }
    )
    revisited = [rows.select(_record(revisit=True)) for rows in (revisits, earlier)]
    _write(others.unionByName(revisited[0]).unionByName(revisited[1]), target)
    discard(headers, revisits)


def resolved(records: DataFrame) -> DataFrame:
    """Every record with length and digest of its full payload; those of a revisit are its original's, whose
    source id becomes `refers_source`. A revisit of a record that isn't there has nulls for them.

    `records` must be a written table. Originals with very many revisits are joined by broadcast.
    """
    revisits = records.where("type = 'revisit'")
    counts = revisits.where("refers_to IS NOT NULL").groupBy("refers_to").agg(F.count("*").alias("n"))
    originals = records.where("type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("source_id").alias("refers_source"), "payload_bytes", "payload_digest"
    )
    known = written(counts.join(originals, "refers_to"))
    out = ["record_id", "type", "source_id", "payload_bytes", "payload_digest", "refers_source"]
    found = join_counted(revisits.drop("payload_bytes", "payload_digest"), known, ["refers_to"], "n").select(*out)
    others = records.where("type <> 'revisit'").withColumn("refers_source", F.lit(None).cast("string")).select(*out)
    lost = revisits.join(known.select("refers_to"), "refers_to", "left_anti")
    nothing = {"payload_bytes": "long", "payload_digest": "string", "refers_source": "string"}
    lost = lost.withColumns({name: F.lit(None).cast(kind) for name, kind in nothing.items()}).select(*out)
    result = written(others.unionByName(found).unionByName(lost))
    discard(known)
    return result
