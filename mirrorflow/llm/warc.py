"""WARC archives of pages in Zstandard frames with a dictionary of their own.

An archive begins with a skippable frame that holds a dictionary built from its records; each record
is a frame of its own, compressed with it. An archive that has reached a size is ended and another
begun, with a dictionary of its own, so that writers and readers hold no more than one of that size.
Spark's text writer puts each archive into a file, with all it knows of file systems and of tasks that
fail: what it writes after a row is set to an empty skippable frame, which readers of the format
pass over. Archives are read back as binary files.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
#: An empty skippable frame, all of it ASCII.
SEPARATOR = struct.pack("<II", SKIPPABLE[0], 0).decode("ascii")

MIN_REVISIT_BYTES = 1000
DICTIONARY_BYTES = 32 << 10
TRAIN_BYTES = 2 << 20
ARCHIVE_BYTES = 64 << 20
LEVEL = 3
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_types(pages: DataFrame, id_col: str, text_col: str, min_bytes: int) -> DataFrame:
    """``pages`` with ``payload_digest`` (hexadecimal SHA-1), ``record_type`` and ``refers_to``.

    Pages are told alike by SHA-256 and length. The texts are not in the join that finds the
    revisits, whose rows alone meet the pages again.
    """
    payload = F.coalesce(F.col(text_col), F.lit(""))
    key, size = F.sha2(payload, 256), F.octet_length(payload)
    slim = pages.select(F.col(id_col).alias("_id"), key.alias("_key"), size.alias("_size"))
    slim = slim.filter(F.col("_size") >= min_bytes)
    groups = slim.groupBy("_key", "_size").agg(F.max("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    groups = groups.filter("_n > 1 and _first is not null")
    revisits = (
        slim.join(groups, ["_key", "_size"])
        .filter("_id is null or _id < _first")
        .select("_id", "_key", "_first")
        .distinct()
    )
    rows = pages.withColumn("_own", key)
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_key"))
    return rows.join(revisits, same, "left").select(
        *pages.columns,
        F.sha1(payload).alias("payload_digest"),
        F.when(F.col("_first").isNull(), "response").otherwise("revisit").alias("record_type"),
        F.col("_first").alias("refers_to"),
    )


def record(page_id, url, text, digest: str, kind: str, refers_to, date: str) -> bytes:
    """The bytes of one WARC record."""

    def urn(x) -> str:
        return f"<urn:page:{'' if pd.isna(x) else int(x)}>"

    payload = ("" if pd.isna(text) else text).encode("utf-8")
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {date}"]
    if not pd.isna(url):
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    coded = base64.b32encode(bytes.fromhex(digest)).decode()
    head.append(f"WARC-Payload-Digest: sha1:{coded}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {_REVISIT}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary trained on records, of a sixteenth of their size at most; their own first bytes
    if there are too few to train on."""
    size = max(1024, min(DICTIONARY_BYTES, sum(map(len, records)) // 16))
    try:
        return zstandard.train_dictionary(size, records, k=256, d=8)
    except zstandard.ZstdError:
        start = b"".join(records)[:size]
        return zstandard.ZstdCompressionDict(start or b"\0" * 8, zstandard.DICT_TYPE_RAWCONTENT)


def frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """The frames of one archive: the dictionary, then each record.

    The dictionary is built from the first ``TRAIN_BYTES`` of records, the memory that this takes.
    """
    waiting, held, packer = [], 0, None

    def begun() -> Iterator[bytes]:
        nonlocal packer
        dictionary = build_dictionary(waiting)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        data = dictionary.as_bytes()
        yield struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data
        yield from map(packer.compress, waiting)

    for one in records:
        if packer:
            yield packer.compress(one)
            continue
        waiting.append(one)
        held += len(one)
        if held >= TRAIN_BYTES:
            yield from begun()
            waiting = []
    if waiting:
        yield from begun()


def archives(records: Iterator[bytes], archive_bytes: int) -> Iterator[bytes]:
    """Archives of the records in order, each ended by the record with which it reaches ``archive_bytes``.

    What waits for a dictionary does not count before it is compressed.
    """
    for first in records:
        some, size = [], 0

        def own() -> Iterator[bytes]:
            yield first
            while size < archive_bytes and (one := next(records, None)) is not None:
                yield one

        for frame in frames(own()):
            some.append(frame)
            size += len(frame)
        yield b"".join(some)


def write_archives(
    records: DataFrame, path: str, id_col: str, url_col: str, text_col: str, date: str,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write the archives of each partition below ``path``, a file each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for batch in batches for row in batch.itertuples(index=False, name=None))
        for archive in archives((record(*row, date) for row in rows), archive_bytes):
            yield pd.DataFrame({"archive": [archive]})

    rows = records.select(
        F.col(id_col).cast("string"), F.col(url_col), F.col(text_col), "payload_digest", "record_type",
        F.col("refers_to").cast("string"),
    )
    out = rows.mapInPandas(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    writer = out.write.option("lineSep", SEPARATOR).option("compression", "none")
    writer.option("maxRecordsPerFile", 1).text(path)


def _frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from the sizes in its headers."""
    mark = data[at + 4]
    single, content = mark >> 5 & 1, mark >> 6
    at += 5 + (1 - single) + (0, 1, 2, 4)[mark & 3] + (single, 2, 4, 8)[content]
    last = False
    while not last:
        block = int.from_bytes(data[at : at + 3], "little")
        last = bool(block & 1)
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
    return at + 4 * (mark >> 2 & 1)


def records_of(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one after the other."""
    data, at, unpacker = memoryview(archive), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at) if len(data) - at >= 8 else (0, 0)
        if magic in SKIPPABLE:
            if magic == DICTIONARY_MAGIC:
                dictionary = zstandard.ZstdCompressionDict(bytes(data[at + 8 : at + 8 + size]))
                unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
            at += 8 + size
        elif magic == FRAME_MAGIC:
            end = _frame_end(data, at)
            yield unpacker.decompress(data[at:end])
            at = end
        else:
            raise ValueError(f"no frame begins at byte {at}")


def parsed(one: bytes) -> tuple:
    """Page id, payload size, digest, type and the id referred to of a record, and its payload.

    Raises ``ValueError`` if a payload does not have the digest that its record states.
    """
    head, _, block = one.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.decode().rsplit("Content-Length: ", 1)[1].split("\r\n")[0])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response" and (
        len(payload) != size or hashlib.sha1(payload).hexdigest() != digest
    ):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")

    def number(name: str) -> int | None:
        value = fields.get(name, "<urn:page:>")[len("<urn:page:") : -1]
        return int(value) if value else None

    return number("WARC-Record-ID"), size, digest, fields["WARC-Type"], number("WARC-Refers-To"), payload


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` and
    ``payload`` (null for a revisit) of all records below ``path``."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def table(rows: list[tuple]) -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=names)
            return out.astype({"page_id": "Int64", "refers_to": "Int64"})

        for batch in batches:
            for archive in batch["content"]:
                rows, held = [], 0
                for one in records_of(archive):
                    *fields, payload = parsed(one)
                    rows.append((*fields, payload if fields[3] == "response" else None))
                    held += len(payload)
                    if held >= 8 << 20:
                        yield table(rows)
                        rows, held = [], 0
                yield table(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(
        run,
        "page_id long, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload binary",
    )


def archive_pages(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
    date: str = "1970-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write all rows of ``pages`` to archives below ``path``, which must not exist.

    Of rows with equal payloads of at least ``min_bytes`` those with the largest id are responses
    and the others revisit it; all shorter ones are responses. A null text is an empty payload, a
    null url leaves its header out. A null id is less than any other and written as none; if
    all ids of a group are null its rows are all responses. Rows that share an id share its type
    for equal payloads. Other columns are not looked at. An empty table gives a folder without archives.
    An archive ends with the record with which it reaches ``archive_bytes``.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(text_col).alias("text"))
    typed = record_types(rows, "id", "text", min_bytes)
    write_archives(typed, path, "id", "url", "text", date, archive_bytes)
