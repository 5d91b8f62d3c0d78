"""WARC records in ZIP archives, read by range without extraction.

An archive is a ZIP of stored members: ``archive/*.warc.gz`` with one gzip member a
record, and ``indexes/index.cdxj`` that says where each record lies. Stored members are byte ranges
of the archive, so a record is a range too. The reader takes an archive's end records, the ZIP64 ones
where they are present, and its central directory, finds the stored WARC members and
indexes, and reads each record from its own range; members that no index covers are
walked through once for the records' places. Places go round as rows, so an archive's records are read by many tasks.

Archives lie in a folder that all executors share. A task writes under a name of its own and
reports it; files of attempts that failed are in no report and never read.

Defined results: a null payload is empty, a null or odd URL keeps its text with control characters percent-encoded;
of equal payloads of at least ``least`` bytes the row with the largest id is the response, rows with that very
id too, and null ids are the smallest; repeated rows are records of their own; a member that is compressed or encrypted
holds no ranges and is an error if it is a WARC; an empty table gives no archive and no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit
from zipfile import ZIP_STORED, ZipFile

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.llm.common import slices, table
from quillwork.operators.joins import lookup_join
from quillwork.session import materialise, new_folder, widen

LEAST_REVISIT = 1000
ARCHIVE_BYTES, MEMBER_BYTES, ARCHIVE_RECORDS = 256 << 20, 32 << 20, 200_000
DATE = "2000-01-01T00:00:00Z"
LEVEL = 4
#: Bytes and records that are read in one go, and the gap that is read over.
SPAN_BYTES, SPAN_RECORDS, GAP_BYTES = 4 << 20, 1000, 16 << 10
PIECE_BYTES = 1 << 20
WARCS, INDEXES = (".warc", ".warc.gz"), (".cdxj", ".cdx")
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_ID = "X-Page-Id"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path inside it; Hadoop's name for S3 is understood."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


# -- writing ------------------------------------------------------------------


def captures(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", least: int = LEAST_REVISIT
) -> DataFrame:
    """(page_id, url, payload, record_id, refers_to): refers_to names the response with the same payload, if it is another.

    Only digests are grouped, combined before the shuffle; groups of one are dropped before they meet the pages.
    """
    payload = F.coalesce(F.col(payload_column), F.lit(""))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in (id_column, url_column)]
    told = F.md5(F.concat_ws("\n", *parts, F.sha2(payload, 256)))
    urn = F.concat(F.lit("<urn:uuid:"), *[p for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for p in (F.substring(told, a, n), F.lit("-"))][:-1], F.lit(">"))
    keyed = pages.select(
        F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), payload.alias("payload"), urn.alias("record_id"),
        F.when(F.octet_length(payload) >= least, F.sha2(payload, 256)).alias("same"),
    )
    groups = (
        keyed.where("same IS NOT NULL").groupBy("same")
        .agg(F.count("*").alias("n"), F.max(F.struct("page_id", "record_id")).alias("first"))
        .where("n > 1").select("same", "first")
    )
    met = lookup_join(keyed, materialise(groups, "equal"), ["same"], spread=["record_id"], how="left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    return met.select("page_id", "url", "payload", "record_id", F.when(other, F.col("first.record_id")).alias("refers_to"))


def clean_url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def sort_key(url: str) -> str:
    """The host's parts from the last to the first, then the path: neighbours in a site are neighbours in the index."""
    try:
        parts = urlsplit(url)
        host = ",".join(reversed((parts.hostname or "").split(".")))
    except ValueError:
        return url
    return f"{host}){parts.path}" + (f"?{parts.query}" if parts.query else "")


def warc_record(page_id, url: str, payload: bytes, record_id: str, refers_to: str | None, date: str = DATE) -> tuple[bytes, str]:
    """The bytes of a response or revisit record, and its payload digest as WARC writes it."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    fields = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", url)]
    if refers_to:
        fields += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", refers_to)]
    if page_id is not None:
        fields.append((PAGE_ID, clean_url(str(page_id))))
    fields += [("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n", digest


class ArchiveWriter:
    """One ZIP: WARC members of bounded size, then the index."""

    def __init__(self, folder: str, member_bytes: int = MEMBER_BYTES):
        system, inside = _opened(folder)
        system.create_dir(inside, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        self.path, self.member_bytes = f"{folder}/{name}", member_bytes
        self.out = system.open_output_stream(f"{inside}/{name}")
        self.zip = ZipFile(self.out, "w", ZIP_STORED)
        self.lines: list[str] = []
        self.members, self.member, self.at, self.bytes = 0, None, 0, 0

    def add(self, url: str, record: bytes, digest: str, date: str = DATE) -> None:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        packed = packer.compress(record) + packer.flush()
        if self.member is None or self.at and self.at + len(packed) > self.member_bytes:
            self._next_member()
        self.member.write(packed)
        told = {"url": url, "digest": digest, "offset": self.at, "length": len(packed), "filename": self.name}
        self.lines.append(f"{clean_url(sort_key(url))} {re.sub(r'[^0-9]', '', date)} {json.dumps(told)}")
        self.at += len(packed)
        self.bytes += len(packed)

    def _next_member(self) -> None:
        if self.member:
            self.member.close()
        self.name, self.members, self.at = f"data-{self.members:05d}.warc.gz", self.members + 1, 0
        self.member = self.zip.open(f"archive/{self.name}", "w", force_zip64=True)

    def close(self) -> tuple[str, int, int]:
        if self.member:
            self.member.close()
        with self.zip.open("indexes/index.cdxj", "w", force_zip64=True) as index:
            for line in sorted(self.lines):
                index.write(line.encode() + b"\n")
        self.zip.close()
        self.out.close()
        return self.path, self.bytes, len(self.lines)


def write_archives(
    records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, member_bytes: int = MEMBER_BYTES,
    archive_records: int = ARCHIVE_RECORDS,
) -> DataFrame:
    """Write ``captures`` below ``folder``; (path, bytes, records) of every archive, written down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            for part in slices(batch, "payload"):
                for at, payload in enumerate(part.column("payload")):
                    page_id, url, record_id, refers_to = (part.column(c)[at].as_py() for c in ("page_id", "url", "record_id", "refers_to"))
                    url = clean_url(url)
                    record, digest = warc_record(page_id, url, payload.as_buffer().to_pybytes(), record_id, refers_to)
                    writer = writer or ArchiveWriter(folder, member_bytes)
                    writer.add(url, record, digest)
                    if writer.bytes >= archive_bytes or len(writer.lines) >= archive_records:
                        done.append(writer.close())
                        writer = None
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "bytes", "records"]
        )

    return materialise(records.mapInArrow(run, "path string, bytes long, records long"), "archives")


# -- the directory ------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    stored: bool
    size: int
    packed: int
    header: int  # place of the local header


END, END64, LOCATOR, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def find_directory(file, size: int) -> tuple[int, int, int, int]:
    """(place, size, entries of the central directory, bytes before the archive proper)."""
    begin = max(0, size - (1 << 16) - 22)
    tail = file.read_at(size - begin, begin)
    at = tail.rfind(END)
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of a central directory: not a ZIP archive, or cut short")
    disk, first_disk, _, entries, length, place = struct.unpack_from("<HHHHII", tail, at + 4)
    end = begin + at
    locator = file.read_at(20, end - 20) if end >= 20 else b""
    if locator[:4] == LOCATOR:
        (told,) = struct.unpack_from("<Q", locator, 8)
        # bytes before the archive move everything: then the record ends where the locator begins
        for end64 in (told, end - 20 - 56):
            record = file.read_at(56, end64) if 0 <= end64 <= end - 76 else b""
            if record[:4] == END64:
                break
        else:
            raise ValueError("the ZIP64 end record is not where its locator says")
        disk, first_disk, _, entries, length, place = struct.unpack_from("<IIQQQQ", record, 16)
        end = end64
    elif FULL16 in (disk, first_disk, entries) or FULL32 in (length, place):
        raise ValueError("sizes stand in a ZIP64 end record that is not there")
    if disk or first_disk:
        raise ValueError("archives over several disks are not read")
    before = end - length - place
    if before < 0:
        raise ValueError("the central directory does not fit into the archive")
    return place + before, length, entries, before


def members_of(file, size: int, piece: int = PIECE_BYTES) -> Iterator[Member]:
    """The central directory's entries, read piece by piece."""
    place, length, entries, before = find_directory(file, size)
    held, end = b"", place + length
    for _ in range(entries):
        while len(held) < 46 or len(held) < 46 + sum(struct.unpack_from("<HHH", held, 28)):
            more = file.read_at(min(piece, end - place), place) if place < end else b""
            if not more:
                raise ValueError("the central directory is cut short")
            held, place = held + more, place + len(more)
        if held[:4] != ENTRY:
            raise ValueError("no entry where the central directory should have one")
        flags, method = struct.unpack_from("<HH", held, 8)
        packed, size_ = struct.unpack_from("<II", held, 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", held, 28)
        (header,) = struct.unpack_from("<I", held, 42)
        name = held[46 : 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = held[46 + n_name : 46 + n_name + n_extra]
        at = 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == 1:  # ZIP64: only the fields that are full in the entry, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
                size_ = next(wide) if size_ == FULL32 else size_
                packed = next(wide) if packed == FULL32 else packed
                header = next(wide) if header == FULL32 else header
            at += 4 + n
        yield Member(name, method == 0 and not flags & 1, size_, packed, header + before)
        held = held[46 + n_name + n_extra + n_comment :]


def data_begin(file, member: Member) -> int:
    """Where a member's bytes begin: its local header has lengths of its own."""
    head = file.read_at(30, member.header)
    if head[:4] != LOCAL:
        raise ValueError(f"no local header of {member.name}")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def list_members(archives: DataFrame) -> DataFrame:
    """(path, name, stored, size, begin) of every member of the archives at ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inside = _opened(path)
                with system.open_input_file(inside) as file:
                    rows = [(path, m.name, m.stored, m.size, data_begin(file, m)) for m in members_of(file, file.size())]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["path", "name", "stored", "size", "begin"]) if rows else _none("path string, name string, stored bool, size int64, begin int64")

    return archives.select("path").mapInArrow(run, "path string, name string, stored boolean, size long, begin long")


def _none(names: str) -> pa.RecordBatch:
    fields = [f.split() for f in names.split(", ")]
    kinds = {"string": pa.string(), "bool": pa.bool_(), "int64": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([], kinds[k]) for _, k in fields], names=[n for n, _ in fields])


# -- the records --------------------------------------------------------------


def _pieces(file, begin: int, size: int, piece: int = PIECE_BYTES) -> Iterator[bytes]:
    for at in range(begin, begin + size, piece):
        yield file.read_at(min(piece, begin + size - at), at)


def indexed(file, begin: int, size: int) -> Iterator[tuple[str, int, int]]:
    """(file name, offset, length) of the lines of a CDXJ index."""
    held = b""
    for piece in _pieces(file, begin, size):
        *lines, held = (held + piece).split(b"\n")
        yield from map(_place, filter(None, lines))
    if held.strip():
        yield _place(held)


def _place(line: bytes) -> tuple[str, int, int]:
    told = json.loads(line[line.index(b"{") :])
    return told["filename"], int(told["offset"]), int(told["length"])


def walked(file, begin: int, size: int, packed: bool) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records of a WARC member without an index."""
    if packed:  # a gzip member a record
        start, at, unpacker = 0, 0, zlib.decompressobj(31)
        for piece in _pieces(file, begin, size):
            while piece:
                unpacker.decompress(piece)
                rest = unpacker.unused_data
                at += len(piece) - len(rest)
                if unpacker.eof:
                    yield start, at - start
                    start, unpacker = at, zlib.decompressobj(31)
                piece = rest
        if at > start:
            raise ValueError("a record is cut short")
        return
    at = 0
    while at < size:
        head = b""
        while b"\r\n\r\n" not in head:
            more = file.read_at(min(4096, size - at - len(head)), begin + at + len(head))
            if not more:
                raise ValueError("a record is cut short")
            head += more
        text = head[: head.index(b"\r\n\r\n")]
        length = len(text) + 4 + int(re.search(rb"(?i)\ncontent-length:[ \t]*([0-9]+)", text)[1]) + 4
        yield at, length
        at += length


def list_records(archives: DataFrame) -> DataFrame:
    """(path, member, places): where the records of the archives lie, some records a row.

    places holds the offset in the archive file and the length of each record.
    """

    def found(path: str) -> Iterator[tuple[str, str, list[dict]]]:
        system, inside = _opened(path)
        with system.open_input_file(inside) as file:
            members = list(members_of(file, file.size()))
            unreadable = [m.name for m in members if m.name.endswith((*WARCS, *INDEXES)) and not m.stored]
            if unreadable:
                raise ValueError(f"{path}: {unreadable[0]} is not stored, so it has no ranges")
            warcs = {m.name: (data_begin(file, m), m.size, m.name) for m in members if m.name.endswith(WARCS)}
            short = {name.rsplit("/", 1)[-1]: place for name, place in warcs.items()}
            covered = set()

            def from_indexes():
                for m in members:
                    if m.name.endswith(INDEXES):
                        for name, offset, length in indexed(file, data_begin(file, m), m.size):
                            begin, size, member = warcs.get(name) or short[name]
                            if offset + length > size:
                                raise ValueError(f"{path}: a record of {member} lies outside of it")
                            covered.add(member)
                            yield member, begin + offset, length

            def from_members():
                for name, (begin, size, _) in warcs.items():
                    if name not in covered:
                        for offset, length in walked(file, begin, size, name.endswith(".gz")):
                            yield name, begin + offset, length

            for places in (from_indexes, from_members):
                held: dict[str, list[tuple[int, int]]] = {}
                for member, at, length in places():
                    held.setdefault(member, []).append((at, length))
                    if len(held[member]) == 50 * SPAN_RECORDS:
                        yield from spans(path, member, held.pop(member))
                for member, rest in held.items():
                    yield from spans(path, member, rest)

    def spans(path: str, member: str, places: list[tuple[int, int]]) -> Iterator[tuple[str, str, list[dict]]]:
        run: list[dict] = []
        for at, length in sorted(places):
            if run and (len(run) == SPAN_RECORDS or at + length - run[0]["at"] > SPAN_BYTES):
                yield path, member, run
                run = []
            run.append({"at": at, "length": length})
        if run:
            yield path, member, run

    kind = pa.list_(pa.struct([("at", pa.int64()), ("length", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for row in found(path):
                    yield pa.RecordBatch.from_arrays([pa.array([row[0]]), pa.array([row[1]]), pa.array([row[2]], kind)], names=["path", "member", "places"])

    rows = archives.select("path")
    return rows.mapInArrow(run, "path string, member string, places array<struct<at:long,length:long>>")


def parse_record(record: bytes) -> dict:
    """Header fields by lower-case name, type, and the payload; an HTTP head before it is cut off."""
    end = record.index(b"\r\n\r\n")
    first, *lines = record[:end].decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines:
        if line[:1] in " \t" and fields:  # a folded line belongs to the field before
            last = next(reversed(fields))
            fields[last] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
    length = int(fields["content-length"])
    block = record[end + 4 : end + 4 + length]
    if len(block) < length:
        raise ValueError("a record is cut short")
    if fields.get("content-type", "").startswith("application/http"):
        block = block[block.index(b"\r\n\r\n") + 4 :]
    return {"fields": fields, "type": fields["warc-type"], "payload": block}


def hex_digest(told: str | None) -> str | None:
    """A SHA-1 digest as bare hex, from the base 32 or the hex that WARC files hold."""
    if not told or not told.lower().startswith("sha1:"):
        return None
    told = told[5:]
    return told.lower() if len(told) == 40 else base64.b32decode(told.upper() + "=" * (-len(told) % 8)).hex()


def read_records(places: DataFrame, payloads: bool = True, tasks: int | None = None) -> DataFrame:
    """The records at ``places``, parsed; read by range, neighbouring ranges together.

    payload_bytes and payload_digest are of the payload that was read. A revisit has none, and
    its digest is what its header tells. verified is false where a response's header tells another digest.
    """
    columns = ["path", "member", "at", "record_type", "record_id", "refers_to", "url", "page_id", "payload_bytes", "payload_digest", "verified", "payload"]
    kinds = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.bool_(), pa.binary()]

    def row(path: str, member: str, at: int, raw: bytes) -> tuple:
        record = parse_record(zlib.decompress(raw, 31) if raw[:2] == b"\x1f\x8b" else raw)
        fields, told = record["fields"], hex_digest(record["fields"].get("warc-payload-digest"))
        here = (path, member, at, record["type"], fields.get("warc-record-id"), fields.get("warc-refers-to"), fields.get("warc-target-uri"), fields.get(PAGE_ID.lower()))
        if record["type"] == "revisit":
            return *here, None, told, None, None
        digest = hashlib.sha1(record["payload"]).hexdigest()
        return *here, len(record["payload"]), digest, told is None or told == digest, record["payload"] if payloads else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            for path, member, wanted in zip(*(batch.column(c).to_pylist() for c in ("path", "member", "places"))):
                if path != name:
                    if file:
                        file.close()
                    system, inside = _opened(path)
                    name, file = path, system.open_input_file(inside)
                rows = []
                for span in _together([(p["at"], p["length"]) for p in wanted]):
                    begin = span[0][0]
                    held = file.read_at(max(at + n for at, n in span) - begin, begin)
                    rows += [row(path, member, at, held[at - begin : at - begin + n]) for at, n in span]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=columns)
        if file:
            file.close()

    tasks = tasks or int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = places.repartition(tasks, "path", "member", "places")
    schema = "path string, member string, at long, record_type string, record_id string, refers_to string, url string, page_id string, payload_bytes long, payload_digest string, verified boolean, payload binary"
    return dealt.mapInArrow(run, schema).drop(*([] if payloads else ["payload"]))


def _together(places: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Runs of ranges with small gaps between them."""
    out: list[list[tuple[int, int]]] = []
    end = None
    for at, length in sorted(places):
        if end is None or at - end > GAP_BYTES:
            out.append([])
            end = at
        out[-1].append((at, length))
        end = max(end, at + length)
    return out


def resolved(records: DataFrame, *columns: str) -> DataFrame:
    """Records with what a revisit takes from its response: id as ``response_page``, and its size and digest.

    ``columns`` of the response, such as payload, replace those of the revisit too. A revisit whose response is not among
    the records keeps nulls. Only responses that are referred to are joined.
    """
    taken = ["payload_bytes", "payload_digest", *columns]
    first = records.where("record_type = 'revisit'").select(F.col("refers_to").alias("record_id")).distinct()
    responses = records.where("record_type <> 'revisit'")
    lookup = (
        responses.join(first, "record_id", "left_semi").groupBy(F.col("record_id").alias("refers_to"))
        .agg(F.max("page_id").alias("response_page"), *[F.first(c).alias(f"response_{c}") for c in taken])
    )
    met = lookup_join(records.where("record_type = 'revisit'"), materialise(lookup, "responses"), ["refers_to"], ["record_id"], how="left")

    def column(name: str) -> Column:
        return F.col(f"response_{name}").alias(name) if name in taken else F.col(name)

    revisits = met.select(*[column(c) for c in records.columns], "response_page")
    return responses.withColumn("response_page", F.lit(None).cast("string")).unionByName(revisits)


def op13_warc_zip(spark, sf_dir: str) -> DataFrame:
    pages = widen(table(spark, sf_dir, "pages"))
    archives = write_archives(captures(pages), new_folder(spark, "warc"))
    records = materialise(read_records(list_records(archives), payloads=False), "records")
    return resolved(records).select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("response_page").cast("long").alias("refers_to"),
    )


ORACLE_SQL = """
SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN top END AS refers_to
FROM (
    SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
           max(page_id) OVER (PARTITION BY html) AS top,
           octet_length(encode(html)) >= 1000 AND page_id IS DISTINCT FROM max(page_id) OVER (PARTITION BY html) AS revisit
    FROM (SELECT page_id, coalesce(html, '') AS html FROM pages))
"""
