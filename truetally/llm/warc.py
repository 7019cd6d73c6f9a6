"""Operator 8: WARC archives with a two-level capture index.

Pages are sorted by reversed-host URL key (ranges of key and page id, so one
large host spreads over many tasks). Each task writes one archive of
gzip members and, beside it, the index of its captures in compressed blocks;
the first and last key and the place of every block go to a sparse directory,
a Parquet table. Look-ups of a table of URLs are one Spark job: each key finds
its archives by a binary search in their bounds (one pair per writing task),
its blocks by a join within the archive, and its captures by a binary search
in the block; neighbouring records then come by one range read. A block is read
once for all its keys, however many there are.

Payloads met more than once (at least ``REVISIT_BYTES`` long) are stored once,
under the largest page id; the others become revisit records.

Files go to the shared folder through a file-system client that takes the
folder's URI. Each attempt of a task writes files of its own name, and only
files that the directory names are ever read, so a repeated or lost task
leaves no trace in the results.

Defined cases: null html is an empty payload; null URLs sort first under an
empty key; a null page id is kept as null; rows that repeat the page id of the
stored copy are responses too; rows that agree in id, URL and payload get
record ids of their own; an empty table gives an empty archive. Records carry
the time of writing as their date, unless a date column is named.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import itertools
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from truetally.llm.common import on_workers, scratch, small_side, written

REVISIT_BYTES = 1000
BLOCK_CAPTURES = 256
#: Repeated payloads up to which their table (about 100 bytes a row) is broadcast, so that pages move only once.
KEPT_ROWS = 300_000
#: Packed records that one block covers at most (plus one record): a reader holds that much.
BLOCK_BYTES = 4 << 20
LEVEL = 4
#: Characters of an archive's bounds that are compared; longer common beginnings only name more archives.
BOUND_CHARS = 64
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DIRECTORY = "first_key string, first_page long, last_key string, archive string, block string, offset long, length long, captures long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def surt(url: Column) -> Column:
    """Reversed-host sort key: ``https://www.a.example/x`` becomes ``example,a,www)/x``."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?#]*)", 1))
    path = F.substr(rest, F.length(host) + 1)
    key = F.when(host == "", path).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), path))
    for raw, code in ((" ", "%20"), ("\t", "%09"), ("\n", "%0A"), ("\r", "%0D")):  # a key stays one field of one line
        key = F.replace(key, F.lit(raw), F.lit(code))
    return key


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             date_col: str | None = None) -> DataFrame:
    """Pages with payload, digest, record id and the record that a revisit refers to.

    ``date_col``: a timestamp column of the capture times.
    """
    now = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    date = F.lit(now) if date_col is None else F.coalesce(
        F.date_format(F.to_utc_timestamp(F.col(date_col).cast("timestamp"), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit(now))
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                        surt(F.col(url_col)).alias("key"),
                        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"),
                        date.alias("date"))
    base = base.withColumn("digest", F.sha1("payload"))
    base = base.withColumn("record", F.unhex(F.substring(F.sha2(F.concat_ws(
        "\n", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "digest", "url"), 256), 1, 32)))
    # one row per payload met more than once; unique payloads never meet the join
    kept = (base.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest")
            .agg(F.max(F.struct("page_id", "record")).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
            .select("digest", F.col("best.page_id").alias("keeper"), F.col("best.record").alias("keeper_record")))
    kept = small_side(written(kept.withColumn("digest", F.unhex("digest")), "kept-payloads"), KEPT_ROWS) \
        .withColumn("digest", F.lower(F.hex("digest")))
    return (base.join(kept, "digest", "left")
            .withColumn("refers_to", F.when((F.octet_length("payload") >= REVISIT_BYTES)
                                            & ~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")))
            .withColumn("refers_record", F.when(F.col("refers_to").isNotNull(), F.col("keeper_record")))
            .drop("keeper", "keeper_record"))


def _client(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def _gzip(data: bytes) -> bytes:
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _record_id(record: bytes, copy: int) -> str:
    """The id of a record; further equal rows get ids derived from the first one's."""
    ident = uuid.UUID(bytes=record)
    return f"<urn:uuid:{uuid.uuid5(ident, str(copy)) if copy else ident}>"


def _record(page_id, url: str, payload: bytes, digest: str, refers_to, date: str, record: bytes, refers_record, copy: int) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    head = [f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {_record_id(record, copy)}", f"WARC-Date: {date}",
            "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"),
            f"WARC-Payload-Digest: sha1:{digest}", f"Page-ID: {'' if page_id is None else page_id}",
            f"Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_record, 0)}",
                 f"Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(body)}\r\n\r\n")
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def _parse(record: bytes) -> dict:
    """The fields of one unpacked record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    ident = lambda v: int(v) if v else None
    body = rest[:int(fields["Content-Length"])]
    response = fields["WARC-Type"] == "response"
    if response:
        digest, size = hashlib.sha1(body).hexdigest(), len(body)
        if f"sha1:{digest}" != fields["WARC-Payload-Digest"]:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
    else:
        digest, size = fields["WARC-Payload-Digest"][5:], int(fields["Payload-Length"])
    return {"page_id": ident(fields["Page-ID"]), "url": fields["WARC-Target-URI"], "payload": body,
            "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": ident(fields.get("Refers-To-Page")), "fields": fields}


def write_archive(rows: DataFrame, folder: str, block_captures: int = BLOCK_CAPTURES) -> DataFrame:
    """Write archives and index blocks of :func:`captures` rows; returns the directory, itself written as Parquet."""
    spark = on_workers(rows.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = index = None
        fs, base = _client(folder)
        lines: list[bytes] = []
        out: list[tuple] = []
        first, last, size = (None, None), None, 0
        before, copy = None, 0

        def flush_block():
            nonlocal lines, size
            if lines:
                block = zlib.compress(b"".join(lines), 6)
                out.append((*first, last, name + ".warc.gz", name + ".cdx", index.tell(), len(block), len(lines)))
                index.write(block)
                lines, size = [], 0

        for batch in batches:
            if archive is None and batch.num_rows:
                fs.create_dir(base, recursive=True)
                name = f"part-{uuid.uuid4().hex}"
                archive = fs.open_output_stream(f"{base}/{name}.warc.gz", compression=None)
                index = fs.open_output_stream(f"{base}/{name}.cdx", compression=None)
            for key, *fields in zip(*(batch.column(i).to_pylist() for i in range(9)), strict=True):
                page_id, record = fields[0], fields[6]
                before, copy = record, copy + 1 if record == before else 0
                packed = _gzip(_record(*fields, copy))
                if not lines:
                    first = (key, page_id)
                last = key
                lines.append(f"{key} {'-' if page_id is None else page_id} {archive.tell()} {len(packed)}\n".encode())
                archive.write(packed)
                size += len(packed)
                if len(lines) >= block_captures or size >= BLOCK_BYTES:
                    flush_block()
        if archive is not None:
            flush_block()
            archive.close()
            index.close()
        cols = list(zip(*out, strict=True)) or [()] * 8
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)],
                                         names=["first_key", "first_page", "last_key", "archive", "block", "offset",
                                                "length", "captures"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (rows.select("key", "page_id", "url", "payload", "digest", "refers_to", "date", "record", "refers_record")
              .repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id", "record"))
    placed.mapInArrow(write, DIRECTORY).write.parquet(f"{folder}/directory")
    return spark.read.schema(DIRECTORY).parquet(f"{folder}/directory")


def read_archive(directory: DataFrame, folder: str) -> DataFrame:
    """Every record, read by range reads along the index; payload bytes are hashed anew."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _client(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{base}/{row['block']}") as f:
                    block = zlib.decompress(f.read_at(row["length"], row["offset"])).decode().split("\n")[:-1]
                places = [tuple(map(int, x.rsplit(" ", 2)[1:])) for x in block]
                with fs.open_input_file(f"{base}/{row['archive']}") as f:
                    start = places[0][0]
                    data = f.read_at(places[-1][0] + places[-1][1] - start, start)
                found = []
                for at, size in places:
                    r = _parse(zlib.decompress(data[at - start:at - start + size], 31))
                    found.append((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"],
                                  r["refers_to"]))
                cols = list(zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(cols, [pa.int64(), pa.int64(), pa.string(), pa.string(),
                                                                 pa.int64()], strict=True)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    spark = on_workers(directory.sparkSession)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return directory.select("archive", "block", "offset", "length").repartition(parts).mapInArrow(read, RECORDS)


def lookup_urls(directory: DataFrame, folder: str, urls: DataFrame, url_col: str = "url",
                payloads: bool = False) -> DataFrame:
    """The records of all URLs of a table, each record once; with ``payloads`` also (url, payload)."""
    spark = on_workers(directory.sparkSession)
    # one row per archive, so per task that wrote; keys cut to BOUND_CHARS
    cut = lambda x: F.substring(x, 1, BOUND_CHARS)
    tops = sorted(tuple(r) for r in directory.groupBy("archive").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high"))
                  .select(cut("low"), cut("high"), "archive").collect())
    lows, highs, archives = ([x[i] for x in tops] for i in range(3))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, where = [], []
            for key in batch.column(0).to_pylist():
                cut = key[:BOUND_CHARS]
                found = archives[bisect.bisect_left(highs, cut):bisect.bisect_right(lows, cut)]
                keys += [key] * len(found)
                where += found
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(where, pa.string())], names=["key", "at"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client, base = _client(folder)
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
            for (archive, block, offset, length), group in itertools.groupby(rows, key=lambda r: r[:4]):
                with client.open_input_file(f"{base}/{block}") as f:
                    lines = zlib.decompress(f.read_at(length, offset)).decode().split("\n")[:-1]
                keys = [x.rsplit(" ", 3)[0] for x in lines]
                hits = [i for *_, key in group for i in range(bisect.bisect_left(keys, key), bisect.bisect_right(keys, key))]
                places = [tuple(map(int, lines[i].rsplit(" ", 2)[1:])) for i in hits]
                found = []
                with client.open_input_file(f"{base}/{archive}") as f:
                    # neighbours in the archive come by one read; a block covers BLOCK_BYTES at most
                    for _, near in itertools.groupby(enumerate(places), key=lambda x: hits[x[0]] - x[0]):
                        near = [p for _, p in near]
                        start = near[0][0]
                        data = f.read_at(near[-1][0] + near[-1][1] - start, start)
                        found += [_parse(zlib.decompress(data[at - start:at - start + size], 31)) for at, size in near]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], k) for n, k in kinds],
                                                     names=[n for n, _ in kinds])

    kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64())]
    kinds += [("url", pa.string()), ("payload", pa.binary())] if payloads else []
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = urls.select(surt(F.col(url_col)).alias("key")).distinct().mapInArrow(place, "key string, at string")
    blocks = directory.select("archive", "block", "offset", "length", "first_key", "last_key")
    hits = (keys.join(blocks, (F.col("at") == F.col("archive")) & (F.col("key") >= F.col("first_key"))
                      & (F.col("key") <= F.col("last_key")))
            .select("archive", "block", "offset", "length", "key"))
    return (hits.repartition(parts, "archive", "offset").sortWithinPartitions("archive", "offset", "key")
            .mapInArrow(read, RECORDS + (", url string, payload binary" if payloads else "")))


def lookup(directory: DataFrame, folder: str, url: str) -> list[dict]:
    """The records of one URL as a list, for a URL with few captures; :func:`lookup_urls` returns a table."""
    one = directory.sparkSession.createDataFrame([(url,)], "url string")
    return [r.asDict() for r in lookup_urls(directory, folder, one, payloads=True).collect()]


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all pages to a fresh archive, then find the records of all their URLs through the index."""
    directory, folder = archive_of(pages.sparkSession, pages)
    return lookup_urls(directory, folder, pages)


def archive_of(spark: SparkSession, pages: DataFrame) -> tuple[DataFrame, str]:
    """(directory, folder) of a fresh archive of ``pages``."""
    folder = scratch(spark, "warc")
    return write_archive(captures(pages), folder), folder
