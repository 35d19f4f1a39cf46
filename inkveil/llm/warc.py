"""WARC archives: written as whole-file gzip, normalised to one gzip member a record with an offset index, read by it.

`write` turns pages into WARC/1.1 records. Spark's own text writer makes the files: a record is a row, the record
separator its line separator, gzip its compression, so a file is one gzip stream of many records on any file
system. Of records with equal payloads of `min_revisit` bytes or more, that of the smallest page_id is a response
and the others are revisits without a payload; the smallest ids come from an aggregate by digest, and the join back
is one that adaptive execution can split where a third of all pages are equal.

`normalise` inflates each such file once, as a stream, and rewrites every record as a gzip member of its own, beside a
sidecar index of offsets and lengths. Both files are written under a name of the attempt and moved in place when
complete, so a task that is lost and run again leaves the same two files. `read` takes the index and opens single
members by their offsets; it checks digests and lengths of what it reads.

A null html is an empty payload; a null url gives no target header. A null page_id makes a response. Rows that
repeat the smallest page_id of a payload are all responses.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkveil.session import scratch_dir, staged

INDEX = "archive string, offset long, length long, record_type string, record_id string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
END = "\r\n\r\n"


@dataclass(frozen=True)
class WarcParams:
    min_revisit: int = 100
    level: int = 6
    #: Records of one file at most.
    file_records: int = 20_000
    date: str = "2024-01-01T00:00:00Z"
    read_bytes: int = 1 << 20


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def records(pages: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """page_id, record_type, refers_to and the text of each page's record, without the separator that ends it."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha2("html", 256), "n": F.octet_length("html")})
    large = rows.where(F.col("n") >= params.min_revisit)
    firsts = staged(large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("m"))
                    .where("m > 1 and first is not null").select("digest", "first"), "first-payloads")
    rows = rows.join(firsts, "digest", "left")
    revisit = F.coalesce(F.col("page_id") != F.col("first"), F.lit(False))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit(END))
    block = F.octet_length(head) + F.when(revisit, 0).otherwise(F.col("n"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    fields = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(params.date)),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", _record_id(F.col("first"))))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block), F.lit("\r\n"))
    return rows.select(
        "page_id", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
        F.concat(fields, head, F.when(revisit, "").otherwise(F.col("html"))).alias("record"))


def write(pages: DataFrame, folder: str, params: WarcParams = WarcParams()) -> None:
    """Whole-file gzip archives of all records below `folder`."""
    records(pages, params).select("record").write.option("compression", "gzip").option("lineSep", END).option(
        "maxRecordsPerFile", params.file_records).text(folder)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and the block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return fields, rest[:int(fields["content-length"])]


def inflated(source: bytes | IO[bytes], params: WarcParams) -> Iterator[bytes]:
    """The stream of a gzip file, whatever its number of members, in pieces; no more than two of them are held."""
    stream = io.BytesIO(source) if isinstance(source, bytes) else source
    most, held = 4 * params.read_bytes, b""
    while held := held or stream.read(params.read_bytes):
        member = zlib.decompressobj(31)
        while not member.eof:
            data = member.decompress(held, most)
            while data:
                yield data
                data = b"" if member.eof else member.decompress(member.unconsumed_tail, most)
            if not member.eof and not (held := stream.read(params.read_bytes)):
                raise ValueError("gzip stream ends early")
        held = member.unused_data


_LENGTH = re.compile(rb"^content-length:[ \t]*(\d+)", re.I | re.M)


def split(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a stream, each with its separator."""
    held = bytearray()
    need = None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                found = _LENGTH.search(held, 0, end + 2)
                if not found:
                    raise ValueError("record without a length")
                need = end + 4 + int(found[1]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("archive ends inside a record")


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _opened(uri: str):
    """A file as a stream, its bytes as they are."""
    system, path = _file_system(uri)
    return system.open_input_stream(path, compression=None)


def _normalise(batches: Iterator[pa.RecordBatch], folder: str, params: WarcParams) -> Iterator[pa.RecordBatch]:
    system, root = _file_system(folder)
    system.create_dir(root, recursive=True)
    for rows in batches:
        for path in rows.column("path").to_pylist():
            name = re.sub(r"\W", "_", path.rsplit("/", 1)[-1].split(".")[0])
            attempt = f"{root}/.{name}-{uuid.uuid4().hex}"
            index: list[list] = [[], [], [], []]
            offset = 0
            with _opened(path) as source, system.open_output_stream(f"{attempt}.warc.gz", compression=None) as out:
                for record in split(inflated(source, params)):
                    fields, _ = parse(record)
                    packer = zlib.compressobj(params.level, zlib.DEFLATED, 31)
                    member = packer.compress(record) + packer.flush()
                    out.write(member)
                    for column, value in zip(index, (offset, len(member), fields["warc-type"], fields["warc-record-id"]), strict=True):
                        column.append(value)
                    offset += len(member)
            with system.open_output_stream(f"{attempt}.idx", compression=None) as out:
                for row in zip(*index, strict=True):
                    out.write("\t".join([f"{name}.warc.gz", *map(str, row)]).encode() + b"\n")
            for kind in ("warc.gz", "idx"):
                system.move(f"{attempt}.{kind}", f"{root}/{name}.{kind}")
            yield pa.RecordBatch.from_arrays([pa.array([f"{name}.warc.gz"]), pa.array([len(index[0])], pa.int64())], ["archive", "n"])


def normalise(spark: SparkSession, archives: str, folder: str, params: WarcParams = WarcParams()) -> DataFrame:
    """Every gzip file below `archives` with one member a record, and its index, below `folder`; (archive, n records).

    Spark lists the files and deals them out; their content is read by the tasks, as streams, so a file may be larger
    than a value or a task's memory.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(archives).select("path")
    written = files.mapInArrow(partial(_normalise, folder=folder, params=params), "archive string, n long")
    return staged(written, "normalised")


def _member(record: bytes) -> tuple:
    fields, block = parse(record)
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"content-length:[ \t]*(\d+)", head, re.I)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    page = lambda name: int(x) if (x := fields.get(name, "").removeprefix("<urn:x-page:").removesuffix(">")) else None
    if fields["warc-type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} is not what its record says")
    return (page("warc-record-id"), size, digest, fields["warc-type"], page("warc-refers-to"), fields.get("warc-target-uri"),
            payload if fields["warc-type"] == "response" else None)


def _read(batches: Iterator[pa.RecordBatch], folder: str, whole: bool) -> Iterator[pa.RecordBatch]:
    system, root = _file_system(folder)
    name, archive = None, None
    columns = [c.split()[0] for c in READ.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            found = []
            rows = batch.slice(start, 256)
            for own, offset, length in zip(*(rows.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                if own != name:
                    name, archive = own, system.open_input_file(f"{root}/{own}")
                archive.seek(offset)
                row = _member(zlib.decompress(archive.read(length), 31))
                found.append(row if whole else (*row[:-1], None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), kind) for x, kind in zip(zip(*found, strict=True), kinds, strict=True)], columns)


def index(spark: SparkSession, folder: str) -> DataFrame:
    """All sidecar indexes below `folder`."""
    return spark.read.schema(INDEX).option("sep", "\t").option("quote", "").option("pathGlobFilter", "*.idx").csv(folder)


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of normalised archives, each opened by its offset; revisits have the length and digest they refer to."""
    return index(spark, folder).mapInArrow(partial(_read, folder=folder, whole=payloads), READ)


def round_trip(pages: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """Pages written, normalised and read back from the normalised archives below the shared scratch folder."""
    spark = pages.sparkSession
    root = scratch_dir(spark, "warc")
    write(pages, f"{root}/written", params)
    if normalise(spark, f"{root}/written", f"{root}/normalised", params).agg(F.sum("n")).first()[0] is None:
        return spark.createDataFrame([], READ).drop("url", "payload")
    return read(spark, f"{root}/normalised", payloads=False).drop("url", "payload")
