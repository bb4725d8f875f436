"""Legacy ARC archives converted to WARC.

An ARC file starts with a version block that names the fields of the record
header lines: version 1 has five, version 2 ten.  Each record is a header line
and a payload of the declared length.  The converter parses these and
synthesises what WARC wants besides: record ids, W3C timestamps, record types
(a payload seen before becomes a revisit that refers to the first), and block
and payload digests.  A header line's IP address becomes ``WARC-IP-Address``; every archive
opens with a ``warcinfo`` record made from the version block of its first segment.
Archives are written to shared storage and read back, each by a task of its own.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrisk.llm.common import null_safe_join, salt, stage, work_path

#: Header line fields by ARC version, fixed by the format.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}

#: Name space of the synthesised record ids.
IDS = uuid.uuid5(uuid.NAMESPACE_URL, "urn:panelrisk:arc")

#: An archive file is closed once it has this many bytes.
ARCHIVE_BYTES = 32 << 20

#: Most partitions that archives are dealt into for reading.
READERS = 20_000

#: Address fields that name no address.
NO_ADDRESS = ("", "-", "0.0.0.0")


@dataclass(frozen=True)
class ArcRecord:
    url: str
    date: str
    content_type: str
    payload: bytes
    fields: dict[str, str]


# -- ARC --------------------------------------------------------------------

def version_block(version: int, name: str = "segment.arc", date: str = "20000101000000") -> bytes:
    """The record that opens an ARC file."""
    body = f"{version} 0 panelrisk\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    extra = " 200 - - 0 " + name if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 {date} text/plain{extra} {len(body)}\n".encode() + body + b"\n"


def parse_arc(content: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file, its version block not among them.

    Field names come from the version block; the last field is always the
    declared length, by which the payload is cut, whatever it holds.  URLs of
    old crawlers may contain blanks: surplus words belong to the URL."""
    at, fields = 0, None
    while at < len(content):
        if content[at:at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = content.find(b"\n", at)
        if end < 0:
            raise ValueError("ARC: header line without an end")
        words = content[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        names = fields or (ARC_FIELDS[2] if len(words) >= len(ARC_FIELDS[2]) else ARC_FIELDS[1])
        if len(words) < len(names) or not words[-1].isdigit():
            raise ValueError(f"ARC: header line does not have the {len(names)} declared fields")
        surplus = len(words) - len(names)
        row = dict(zip(names, [" ".join(words[: surplus + 1]), *words[surplus + 1:]], strict=True))
        size = int(words[-1])
        payload = content[end + 1:end + 1 + size]
        if len(payload) < size:
            raise ValueError("ARC: payload shorter than its declared length")
        at = end + 1 + size
        if fields is None:
            if not row["URL"].startswith("filedesc:"):
                raise ValueError("ARC: no version block")
            lines = payload.decode("utf-8", "replace").split("\n")
            number = lines[0].split(" ")[0]
            if not number.isdigit() or int(number) not in ARC_FIELDS:
                raise ValueError(f"ARC: unknown version {number!r}")
            fields = lines[1].split(" ") if len(lines) > 1 and lines[1] else ARC_FIELDS[int(number)]
            continue
        yield ArcRecord(row["URL"], row["Archive-date"], row["Content-type"], payload, row)


def version_fields(content: bytes) -> dict[str, str]:
    """What the version block of an ARC file says: its name, date, version and origin."""
    end = content.find(b"\n")
    words = content[:end].decode("utf-8", "replace").rstrip("\r").split(" ")
    if end < 0 or not words[0].startswith("filedesc:") or not words[-1].isdigit():
        raise ValueError("ARC: no version block")
    line = content[end + 1:end + 1 + int(words[-1])].decode("utf-8", "replace").split("\n")[0].split(" ")
    return {"name": words[0].removeprefix("filedesc://"), "date": words[2] if len(words) > 2 else "",
            "version": line[0], "origin": " ".join(line[2:])}


def w3c_date(digits: str) -> str:
    """ARC's 14 digits (or fewer: the rest is lowest) as WARC's timestamp."""
    low = "00000101000000"
    digits = (digits + low[len(digits):])[:14] if digits.isdigit() else "19700101000000"
    try:
        when = datetime.strptime(digits, "%Y%m%d%H%M%S").replace(tzinfo=UTC)
    except ValueError:
        when = datetime(1970, 1, 1, tzinfo=UTC)
    return when.strftime("%Y-%m-%dT%H:%M:%SZ")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record_id(key: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(IDS, str(key))}>"


# -- WARC -------------------------------------------------------------------

def warc_record(record: ArcRecord, key: int | None, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC/1.1 record.  A revisit has no payload: it names the record that
    has, and the full payload's length and digest."""
    block = b"" if revisit else record.payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(key)}",
            f"WARC-Date: {w3c_date(record.date)}", f"WARC-Target-URI: {record.url}",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block) if revisit else digest}",
            f"X-Page-Id: {'' if key is None else key}", f"X-Payload-Length: {len(record.payload)}"]
    if (address := record.fields.get("IP-address", "")) not in NO_ADDRESS:
        head.append(f"WARC-IP-Address: {address}")
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"Content-Type: {record.content_type}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def warcinfo_record(version: dict[str, str], filename: str) -> bytes:
    """The record that opens an archive, from an ARC version block."""
    block = "".join(f"{k}: {v}\r\n" for k, v in (
        ("software", "panelrisk"), ("format", "WARC File Format 1.1"), ("description", "converted from ARC"),
        ("arc-name", version["name"]), ("arc-version", version["version"]), ("arc-origin", version["origin"]))).encode()
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id(filename)}",
            f"WARC-Date: {w3c_date(version['date'])}", f"WARC-Filename: {filename}",
            f"WARC-Block-Digest: sha1:{sha1_base32(block)}", "Content-Type: application/warc-fields",
            f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(stream, piece: int = 1 << 20) -> Iterator[bytes]:
    """Members of a gzip archive, one at a time."""
    inflate, out, held = zlib.decompressobj(31), [], stream.read(piece)
    while held:
        out.append(inflate.decompress(held))
        if inflate.eof:
            yield b"".join(out)
            held, inflate, out = inflate.unused_data or stream.read(piece), zlib.decompressobj(31), []
        else:
            held = stream.read(piece)
    if out:
        raise ValueError("WARC: archive ends inside a member")


def packed(record: bytes) -> bytes:
    """A record as a gzip member of its own."""
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def parse_warc(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; the declared length must hold."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("WARC: no version line")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("WARC: block does not have its declared length")
    return fields, rest[:size]


# -- the job ----------------------------------------------------------------

def as_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``page_id`` and an ARC segment (``arc``: version block and one record)
    for each page; even ids are version 1, the others version 2.

    A null payload is empty, a null URL ``unknown:``; line breaks in a URL
    become blanks."""
    body = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    url = F.translate(F.coalesce(F.col(url_col), F.lit("unknown:")), "\r\n", "  ")
    size = F.octet_length(body).cast("string")
    # the crawl date that the table lacks: seconds after 2000 by id
    date = F.date_format(F.timestamp_seconds(F.lit(946684800) + F.pmod(F.coalesce(F.col(id_col), F.lit(0)),
                                                                       F.lit(600_000_000))), "yyyyMMddHHmmss")
    one = F.concat_ws(" ", url, F.lit("0.0.0.0"), date, F.lit("text/html"), size)
    two = F.concat_ws(" ", url, F.lit("0.0.0.0"), date, F.lit("text/html"), F.lit("200"), F.lit("-"), F.lit("-"),
                      F.lit("0"), F.lit("segment.arc"), size)
    first = F.coalesce(F.pmod(F.col(id_col), F.lit(2)) == 0, F.lit(True))
    head = F.when(first, F.concat(F.lit(version_block(1).decode()), one)).otherwise(
        F.concat(F.lit(version_block(2).decode()), two))
    return pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.concat(F.encode(F.concat(head, F.lit("\n")), "UTF-8"), body,
                                 F.encode(F.lit("\n"), "UTF-8")).alias("arc"))


def arc_digests(arcs: DataFrame) -> DataFrame:
    """``page_id``, the hash of the ``segment``, and the payload's ``bytes``
    and ``digest`` of the records of ARC segments, by declared lengths."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, none, of, len(r.payload), sha1_base32(r.payload))
                    for i, none, of, a in zip(b["page_id"], b["no_id"], b["segment"], b["arc"], strict=True)
                    for r in parse_arc(a)]
            yield pd.DataFrame(rows, columns=["page_id", "no_id", "segment", "bytes", "digest"])

    found = _whole_ids(_with_segment(arcs)).mapInPandas(
        run, "page_id long, no_id boolean, segment long, bytes long, digest string")
    return found.select(F.when(~F.col("no_id"), F.col("page_id")).alias("page_id"), "segment", "bytes", "digest")


def _with_segment(arcs: DataFrame) -> DataFrame:
    """Segments and their hashes, which tell rows that repeat an id apart; where
    hashes clash, digests still do."""
    return arcs.withColumn("segment", F.xxhash64("arc"))


def _whole_ids(arcs: DataFrame) -> DataFrame:
    """Ids without nulls (those would make pandas read the others as floats), and where they were."""
    return arcs.withColumns({"page_id": F.coalesce("page_id", F.lit(0)), "no_id": F.col("page_id").isNull()})


def first_of_payload(digests: DataFrame, least_bytes: int) -> DataFrame:
    """The least ``page_id`` of each (digest, bytes) that several records
    share: ``digest, bytes, first_id``.  Records are combined before they
    move, so a hot payload is one row from each task."""
    return (digests.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes")
            .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))


def convert(arcs: DataFrame, name: str = "warc", least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Convert ARC segments to WARC archives on shared storage; ``path`` and
    number of ``records`` of each archive.

    Every task writes gzip archives, one member for each record, under names
    of its attempt; the manifest is staged by Spark, so that it lists exactly
    one attempt of each task, and files of lost attempts are never read."""
    spark = arcs.sparkSession
    folder = work_path(spark, name)
    digests = stage(arc_digests(arcs), "arc-digests")
    first = first_of_payload(digests, least_bytes)
    salted = digests.withColumn("_salt", salt(F.col("page_id")))
    slices = salted.groupBy("digest", "bytes", "_salt").agg(F.lit(1).alias("_x")).drop("_x")
    known = salted.join(slices.join(first, ["digest", "bytes"]), ["digest", "bytes", "_salt"])
    # only repeated payloads are listed here, once for each segment that has them, with the least id of theirs
    known = known.where("page_id IS NOT NULL").groupBy("page_id", "segment", "digest", "bytes").agg(
        F.min("first_id").alias("first_id"))
    known = known.groupBy("page_id", "segment").agg(F.collect_list(F.struct("digest", "bytes", "first_id")).alias("firsts"))
    todo = _whole_ids(null_safe_join(_with_segment(arcs), known, ["page_id", "segment"]).drop("segment"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else
                                               f"file://{folder}")
        store.create_dir(base, recursive=True)
        out, path, records, size, done = None, "", 0, 0, []
        for b in batches:
            for key, none, firsts, a in zip(b["page_id"].tolist(), b["no_id"], b["firsts"], b["arc"], strict=True):
                key = None if none else key
                first_of = {(x["digest"], x["bytes"]): x["first_id"] for x in (() if firsts is None else firsts)}
                for r in parse_arc(a):
                    if out is None:
                        path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                        out, records, size = store.open_output_stream(path, compression=None), 0, 0
                        out.write(packed(warcinfo_record(version_fields(a), path.rsplit("/", 1)[1])))
                    digest = sha1_base32(r.payload)
                    of = first_of.get((digest, len(r.payload)), key)
                    revisit = not none and of != key
                    data = packed(warc_record(r, key, digest, of, revisit))
                    out.write(data)
                    records += 1
                    size += len(data)
                    if size >= archive_bytes:
                        out.close()
                        done.append((path, records))
                        out = None
        if out is not None:
            out.close()
            done.append((path, records))
        yield pd.DataFrame(done, columns=["path", "records"]).astype({"path": "object", "records": "int64"})

    manifest = stage(todo.mapInPandas(run, "path string, records long"), "warc-manifest")
    return manifest.withColumn("folder", F.lit(folder))


def read_archives(manifest: DataFrame) -> DataFrame:
    """Records of the listed archives, read member by member: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to``, then ``record_id,
    date, url``.  Every response's digest is checked against its block.

    A manifest is small, so its number of partitions is given: left to the size of its rows,
    one task would read all archives."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "date", "url"]
        for b in batches:
            for folder, path, records in zip(b["folder"], b["path"], b["records"], strict=True):
                store, _ = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else
                                                    f"file://{folder}")
                rows = []
                with store.open_input_stream(path, compression=None) as stream:
                    for member in members(stream):
                        f, block = parse_warc(member)
                        if f["WARC-Type"] == "warcinfo":
                            continue
                        digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                        if f["WARC-Type"] == "response" and sha1_base32(block) != digest:
                            raise ValueError("WARC: payload does not have its digest")
                        rows.append((int(f["X-Page-Id"]) if f["X-Page-Id"] else None, int(f["X-Payload-Length"]),
                                     digest, f["WARC-Type"],
                                     int(f["X-Refers-To-Page"]) if "X-Refers-To-Page" in f else None,
                                     f["WARC-Record-ID"], f["WARC-Date"], f["WARC-Target-URI"]))
                if len(rows) != records:
                    raise ValueError("WARC: archive does not have the records its manifest lists")
                frame = pd.DataFrame(rows, columns=names, dtype=object)
                yield frame.assign(**{c: pd.array(frame[c].tolist(), dtype="Int64") for c in ("page_id", "refers_to")})

    files = manifest.repartition(max(1, min(manifest.count(), READERS)), F.col("path"))
    return files.mapInPandas(run, "page_id long, payload_bytes long, payload_digest string, record_type string,"
                                  " refers_to long, record_id string, date string, url string")


def convert_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", *,
                  least_bytes: int = 0) -> DataFrame:
    """Pages as legacy ARC records, converted to WARC archives and read back;
    one row for each page (see ``read_archives``).

    Of records with equal payloads of at least ``least_bytes`` bytes the one
    with the least id is the response, the others are revisits.  Null payloads
    are empty.  Records with a null id are responses and never referred to;
    rows that repeat an id are records of their own, each judged by its own
    payload.  Other columns are not looked at.  An empty table gives an empty
    result."""
    return read_archives(convert(as_arc(pages, id_col, url_col, payload_col), least_bytes=least_bytes))

