"""Operator 12, WARC: archives written and read through a PySpark Python data source, format ``warc``.

Reading: the plan has a partition per archive file, small files packed up to ``packBytes`` together; each is
read by one task, record by record. A record's headers are parsed first. Predicates on them (record type,
identifiers, URI, date, digest, content type and length: comparison, IN, null and text tests) are pushed
down by Spark and decided on the headers alone; a record that they reject, and every record where the read schema has
no ``payload``, has its payload skipped: by a seek in plain archives and in members that carry their own
length (the ``sl`` extra field of the WARC standard's annex on gzip, written here), otherwise by inflating to the
member's end without keeping anything. The unit of work is a file, since gzip members can't be found
from the middle of a file with certainty; the writer begins a new file after ``rollBytes``.

Writing: a task writes files of its own name, one gzip member per record (option ``compression`` = ``none``: plain),
each file with a ``warcinfo`` record in front. The commit lists the files of the tasks that succeeded in a
manifest, and only listed files are read back, so lost executors and repeated tasks leave no records twice.
Folders without a manifest are foreign: all their ``*.warc`` and ``*.warc.gz`` files are read.

Spark 4.1 keeps the filters that were pushed last with the relation, also for later queries of the same frame
that have other filters. So the reader takes only predicates that belong to the frame itself, those given to
``read_archive`` (or in the option ``predicates``): every query of the frame has them. Other filters stay with
Spark. Option ``pushFilters`` = ``all`` takes all that headers can decide, for a frame that one query reads.

``with_revisits`` decides which records are responses: of equal payloads (SHA-256 and length) of at least
``min_bytes`` bytes the row with the greatest id, and of rows that repeat that id the last one; the others
are revisits of it and are stored without the payload. ``resolve`` finds a revisit's response again.

Null payloads are empty; null ids come lowest and are kept as missing; null URLs leave the header out; control characters
in header values are percent-encoded. Empty tables give an archive without page records. Rows are read twice for
deduplication, so they must come in the same order both times, as they do from files; ``cut`` anything else.
Extra columns aren't written.
"""

from __future__ import annotations

import io
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from .runtime import cut

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("record_type string, record_id string, target_uri string, date string, content_type string, "
          "content_length long, payload_digest string, refers_to string, headers map<string,string>, payload binary")
#: Header field of each column that filters can be decided on.
FIELDS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
          "content_type": "content-type", "content_length": "content-length", "payload_digest": "warc-payload-digest",
          "refers_to": "warc-refers-to"}
HTTP = "application/http"
MANIFEST = "_manifest-"
BLOCK, BATCH_BYTES, BATCH_ROWS = 1 << 20, 16 << 20, 1000
PACK_BYTES, ROLL_BYTES = 128 << 20, 1 << 30


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder; a path without a scheme is local, or shared and mounted."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


# ---- records as bytes -------------------------------------------------------------------------

def _field(name: str, value: str) -> bytes:
    clean = "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)
    return f"{name}: {clean}\r\n".encode()


def record_bytes(kind: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record: version, type, given fields (missing ones left out), length and block."""
    head = b"".join(_field(n, v) for n, v in [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))] if v is not None)
    return VERSION.encode() + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member with its compressed and its full length in the ``sl`` extra field."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    total = 10 + 2 + 12 + len(body) + 8
    if total >= 1 << 32 or len(data) >= 1 << 32:        # lengths that the field can't hold
        return b"\x1f\x8b\x08\x00" + bytes(5) + b"\xff" + body + zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")
    extra = b"sl" + (8).to_bytes(2, "little") + total.to_bytes(4, "little") + len(data).to_bytes(4, "little")
    return (b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + len(extra).to_bytes(2, "little") + extra + body
            + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little"))


class Window:
    """A file read in blocks, with cheap jumps."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.data = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at``."""
        if at < self.start or at + n > self.start + len(self.data):
            n = min(n, max(0, self.size - at))
            if at < self.start or at + n > self.start + len(self.data):
                self.file.seek(at)
                self.start, self.data = at, self.file.read(max(n, BLOCK))
        return self.data[at - self.start:at - self.start + n]


def _parsed(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    found: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:            # a folded value
            found[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            found[last] = value.strip()
    return found


class _Plain:
    """Bytes of a plain archive from ``at``."""

    def __init__(self, window: Window, at: int):
        self.window, self.at = window, at

    def more(self, n: int) -> bytes:
        data = self.window.get(self.at, min(n, BLOCK))
        self.at += len(data)
        return data

    def end(self, left: int) -> int:
        """Where the next record begins, ``left`` bytes of this one being unread."""
        return self.at + left


class _Member:
    """The inflated bytes of the gzip member at ``at``."""

    def __init__(self, window: Window, at: int):
        self.window, self.begin, self.length = window, at, None
        fixed = window.get(at, 12)
        flags, at = fixed[3], at + 10
        if flags & 4:
            size = int.from_bytes(fixed[10:12], "little")
            extra, at = window.get(at + 2, size), at + 2 + size
            while len(extra) >= 4:
                n = int.from_bytes(extra[2:4], "little")
                if extra[:2] == b"sl" and n == 8:
                    self.length = int.from_bytes(extra[4:8], "little")
                extra = extra[4 + n:]
        for bit in (8, 16):                             # name and comment, ended by a zero byte
            while flags & bit and (c := window.get(at, 1)) != b"\x00":
                if not c:
                    raise ValueError("truncated gzip member")
                at += 1
            at += bool(flags & bit)
        self.at = at + (2 if flags & 2 else 0)
        self.inflate, self.rest = zlib.decompressobj(-15), b""

    def more(self, n: int) -> bytes:
        while not self.inflate.eof:
            if not self.rest:
                self.rest = self.window.get(self.at, 1 << 14 if n < BLOCK else BLOCK)
                if not self.rest:
                    raise ValueError("truncated gzip member")
                self.at += len(self.rest)
            data = self.inflate.decompress(self.rest, n)
            self.rest = self.inflate.unconsumed_tail or self.inflate.unused_data
            if data:
                return data
        return b""

    def end(self, left: int) -> int:
        if self.length:
            return self.begin + self.length
        while data := self.more(BLOCK):
            left -= len(data)
        if left < -4:                                   # more than the blank lines after a record
            raise ValueError(f"several records in the gzip member at byte {self.begin}")
        return self.at - len(self.rest) + 8


def records(file, size: int, wanted, with_payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Header fields, and the payload where it is asked for, of the records that ``wanted`` accepts by their fields."""
    window, at = Window(file, size), 0
    while at < size:
        start = window.get(at, 4)
        if start[:2] in (b"\r\n", b"\n"):                 # space between plain records
            at += 2 if start[:1] == b"\r" else 1
            continue
        part = _Member(window, at) if start[:3] == b"\x1f\x8b\x08" else _Plain(window, at)
        head = bytearray()
        while (cut_at := head.find(b"\r\n\r\n", max(0, len(head) - 4100))) < 0:
            data = part.more(4096)
            if not data:
                raise ValueError(f"record without an end of headers at byte {at}")
            head += data
        fields = _parsed(bytes(head[:cut_at]))
        length = int(fields.get("content-length", 0))
        left = length - (len(head) - cut_at - 4)         # may be negative: the record's end was read too
        if wanted(fields):
            payload = None
            if with_payload:
                out = io.BytesIO()
                out.write(head[cut_at + 4:cut_at + 4 + length])
                while left > 0:
                    data = part.more(left)
                    if not data:
                        raise ValueError(f"truncated record at byte {at}")
                    out.write(data)
                    left -= len(data)
                payload = out.getvalue()
                if fields.get("content-type", "").startswith(HTTP):
                    payload = payload.partition(b"\r\n\r\n")[2]
            yield fields, payload
        at = part.end(left)


# ---- reading ------------------------------------------------------------------------------------

@dataclass
class Files(ds.InputPartition):
    """Archive files of one task: names and sizes."""
    files: tuple[tuple[str, int], ...]


def _test(f: ds.Filter):
    """A filter as a function of the header fields, or None where headers can't decide it."""
    if isinstance(f, ds.Not):
        inner = _test(f.child)
        # a missing value satisfies neither a comparison nor its negation
        return inner and (lambda h: None if (x := inner(h)) is None else not x)
    path = getattr(f, "attribute", ())
    if len(path) != 1 or path[0] not in FIELDS:
        return None
    name, number = FIELDS[path[0]], path[0] == "content_length"

    def value(h):
        v = h.get(name)
        return int(v) if number and v is not None else v

    def compare(how):
        return lambda h: None if (v := value(h)) is None else how(v)

    if isinstance(f, ds.IsNull):
        return lambda h: value(h) is None
    if isinstance(f, ds.IsNotNull):
        return lambda h: value(h) is not None
    if isinstance(f, ds.In):
        return compare(lambda v: v in f.value)
    if isinstance(f, ds.EqualNullSafe):
        return lambda h: value(h) == f.value
    plain = {ds.EqualTo: lambda v: v == f.value, ds.GreaterThan: lambda v: v > f.value, ds.LessThan: lambda v: v < f.value,
             ds.GreaterThanOrEqual: lambda v: v >= f.value, ds.LessThanOrEqual: lambda v: v <= f.value,
             ds.StringStartsWith: lambda v: v.startswith(f.value), ds.StringEndsWith: lambda v: v.endswith(f.value),
             ds.StringContains: lambda v: f.value in v}
    return compare(plain[type(f)]) if type(f) in plain else None


#: Predicates by name: the filter that Spark pushes, and the condition that makes it.
PREDICATES = {
    "=": (ds.EqualTo, lambda c, v: c == v), "in": (ds.In, lambda c, v: c.isin(*v)),
    "<": (ds.LessThan, lambda c, v: c < v), "<=": (ds.LessThanOrEqual, lambda c, v: c <= v),
    ">": (ds.GreaterThan, lambda c, v: c > v), ">=": (ds.GreaterThanOrEqual, lambda c, v: c >= v),
    "startswith": (ds.StringStartsWith, lambda c, v: c.startswith(v)), "endswith": (ds.StringEndsWith, lambda c, v: c.endswith(v)),
    "contains": (ds.StringContains, lambda c, v: c.contains(v)), "isnull": (ds.IsNull, lambda c, v: c.isNull()),
    "isnotnull": (ds.IsNotNull, lambda c, v: c.isNotNull())}


def _filter(column: str, how: str, value=None) -> ds.Filter:
    kind = PREDICATES[how][0]
    if kind in (ds.IsNull, ds.IsNotNull):
        return kind((column,))
    return kind((column,), tuple(value) if kind is ds.In else value)


class WarcReader(ds.DataSourceReader):
    def __init__(self, names: list[str], schema: pa.Schema, options: dict):
        self.names, self.schema, self.path = names, schema, options["path"]
        self.pack = int(options.get("packbytes", PACK_BYTES))
        self.own = [_filter(*p) for p in json.loads(options.get("predicates", "[]"))]
        self.all = options.get("pushfilters") == "all"
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters):
        for f in filters:
            if (self.all or f in self.own) and _test(f) is not None:
                self.filters.append(f)
            else:
                yield f

    def files(self) -> list[tuple[str, int]]:
        fs, root = open_folder(self.path)
        if fs.get_file_info(root).type == pafs.FileType.File:
            return [(root, fs.get_file_info(root).size)]
        listed = {i.path: i for i in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if i.is_file}
        manifests = [p for p in listed if p.rsplit("/", 1)[-1].startswith(MANIFEST)]
        if manifests:
            names = [n for p in manifests for n in fs.open_input_stream(p).read().decode().split("\n") if n]
            return sorted((f"{root}/{n}", listed[f"{root}/{n}"].size) for n in names)
        return sorted((p, i.size) for p, i in listed.items() if p.endswith((".warc", ".warc.gz")))

    def partitions(self):
        packed, size, out = [], 0, []
        for path, n in self.files():
            if packed and size + n > self.pack:
                out.append(Files(tuple(packed)))
                packed, size = [], 0
            packed.append((path, n))
            size += n
        return [*out, Files(tuple(packed))]

    def read(self, partition):
        fs, _ = open_folder(self.path)
        tests = [_test(f) for f in self.filters]
        with_payload = "payload" in self.names
        rows, size = [], 0
        for path, n in partition.files:
            with fs.open_input_file(path) as file:
                for fields, payload in records(file, n, lambda h: all(t(h) for t in tests), with_payload):
                    rows.append((fields, payload))
                    size += len(payload or b"") + 256
                    if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield self.batch(rows)
                        rows, size = [], 0
        if rows:
            yield self.batch(rows)

    def batch(self, rows) -> pa.RecordBatch:
        def column(name):
            if name == "payload":
                return [p for _, p in rows]
            if name == "headers":
                return [list(h.items()) for h, _ in rows]
            if name == "content_length":
                return [int(h["content-length"]) if "content-length" in h else None for h, _ in rows]
            return [h.get(FIELDS[name]) for h, _ in rows]
        return pa.RecordBatch.from_arrays([pa.array(column(f.name), f.type) for f in self.schema], schema=self.schema)


# ---- writing ------------------------------------------------------------------------------------

@dataclass
class Written(ds.WriterCommitMessage):
    names: list[str]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.gzip = options.get("compression", "gzip") != "none"
        self.roll = int(options.get("rollbytes", ROLL_BYTES))
        self.software = options.get("software", "spark-warc")

    def write(self, iterator) -> Written:
        fs, root = open_folder(self.path)
        fs.create_dir(root, recursive=True)
        names, file, size = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if file is None or size >= self.roll:
                        if file is not None:
                            file.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc{'.gz' if self.gzip else ''}")
                        file, size = fs.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                        size += self.put(file, record_bytes("warcinfo", [
                            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Filename", names[-1]),
                            ("Content-Type", "application/warc-fields")], _field("software", self.software) + _field("format", VERSION)))
                    size += self.put(file, page_record(row))
        finally:
            if file is not None:
                file.close()
        return Written(names)

    def put(self, file, data: bytes) -> int:
        data = gzip_member(data) if self.gzip else data
        file.write(data)
        return len(data)

    def commit(self, messages) -> None:
        fs, root = open_folder(self.path)
        fs.create_dir(root, recursive=True)
        old = [i.path for i in fs.get_file_info(pafs.FileSelector(root)) if i.base_name.startswith(MANIFEST)] if self.overwrite else []
        with fs.open_output_stream(f"{root}/{MANIFEST}{uuid.uuid4().hex}", compression=None) as out:
            out.write("\n".join(n for m in messages if m for n in m.names).encode())
        for path in old:
            fs.delete_file(path)

    def abort(self, messages) -> None:
        """Files of a failed write stay unlisted."""


def page_record(row: dict) -> bytes:
    """The record of a page: an HTTP response with its payload, or a revisit with the HTTP header only."""
    payload = row.get("payload") or b""
    size = row.get("payload_bytes")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload) if size is None else size}\r\n\r\n".encode()
    kind = row["record_type"]
    fields = [("WARC-Record-ID", row["record_id"]), ("WARC-Date", row.get("date")), ("WARC-Target-URI", row.get("target_uri")),
              ("WARC-Payload-Digest", row.get("payload_digest")), ("Content-Type", f"{HTTP}; msgtype=response")]
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", row.get("refers_to"))]
    fields += row.get("headers") or []
    return record_bytes(kind, fields, http if kind == "revisit" else http + payload)


def _plain(options) -> dict[str, str]:
    return {k.lower(): v for k, v in options.items()}


class WarcSource(ds.DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return RECORD

    def reader(self, schema):
        from pyspark.sql.pandas.types import to_arrow_schema
        return WarcReader(schema.names, to_arrow_schema(schema), _plain(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(_plain(self.options), overwrite)


def register(spark: SparkSession) -> SparkSession:
    """Make the format known to the session, with filters pushed down to it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


# ---- pages --------------------------------------------------------------------------------------

def payload_digest(payload: Column) -> Column:
    """SHA-1 of bytes in upper-case base 32: five bytes, ten hex digits, make eight characters."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_uri(*parts: Column) -> Column:
    """A record id that the same parts give again."""
    h = F.md5(F.concat_ws("/", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def with_revisits(pages: DataFrame, archive: str, id_column: str = "page_id", url: str = "url", payload: str = "html",
                  min_bytes: int = 0) -> DataFrame:
    """Rows as records to be written: record_type, record_id, refers_to, target_uri, digest, headers, payload."""
    body = F.encode(F.coalesce(F.col(payload).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(url).cast("string").alias("target_uri"),
                        body.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"))
    rows = rows.select("*", F.when(F.col("payload_bytes") >= min_bytes, F.concat(F.sha2("payload", 256), F.lit("/"), F.col("payload_bytes"))).alias("same"))
    # one small row per task and payload; payloads that occur once need none
    first = (rows.where("same IS NOT NULL").groupBy("same").agg(F.max(F.struct("id", "row"))["row"].alias("response"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    marked = rows.join(cut(first, "payloads"), "same", "left")
    revisit = F.col("response").isNotNull() & (F.col("response") != F.col("row"))
    place = F.lit(archive)
    return marked.select(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        record_uri(place, F.col("row")).alias("record_id"), "target_uri",
        F.concat(F.lit("sha1:"), payload_digest(F.col("payload"))).alias("payload_digest"),
        F.when(revisit, record_uri(place, F.col("response"))).alias("refers_to"),
        F.map_filter(F.create_map(F.lit("X-Page-Id"), F.col("id").cast("string")), lambda k, v: v.isNotNull()).alias("headers"),
        "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, **columns: str) -> None:
    """Write pages as WARC records under ``path``, equal payloads once."""
    register(pages.sparkSession)
    records_ = with_revisits(pages, path, min_bytes=min_bytes, **columns)
    records_.write.format("warc").mode("append").option("path", path).save()


def read_archive(spark: SparkSession, path: str, columns: list[str] | None = None,
                 where: list[tuple] = ()) -> DataFrame:
    """Records of an archive that satisfy all predicates ``where``, as (column, name in PREDICATES, value); they
    are pushed down. With ``columns`` only those (without ``payload`` none is decoded)."""
    reader = register(spark).read.format("warc").option("predicates", json.dumps([list(p) for p in where]))
    if columns is not None:
        kinds = dict(c.strip().split(" ", 1) for c in RECORD.split(", "))
        reader = reader.schema(", ".join(f"{c} {kinds[c]}" for c in columns))
    df = reader.load(path)
    for column, how, *value in where:
        df = df.where(PREDICATES[how][1](F.col(column), value[0] if value else None))
    return df


def resolve(spark: SparkSession, path: str) -> DataFrame:
    """Every page record of an archive with its whole payload's size and digest: page_id, payload_bytes,
    payload_digest, record_type, refers_to (the response's page), verified (the digest in the header is the payload's)."""
    page = F.col("headers")["x-page-id"].cast("long")
    said = F.regexp_replace("payload_digest", "^sha1:", "")
    responses = read_archive(spark, path, ["record_type", "record_id", "payload_digest", "headers", "payload"], [("record_type", "=", "response")])
    responses = cut(responses.select("record_id", page.alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                                     payload_digest(F.col("payload")).alias("payload_digest"), said.alias("said")), "responses")
    revisits = read_archive(spark, path, ["record_type", "record_id", "payload_digest", "refers_to", "headers"], [("record_type", "=", "revisit")])
    revisits = revisits.select(F.col("refers_to").alias("response_id"), page.alias("page_id"), said.alias("said"))
    response = responses.select(F.col("record_id").alias("response_id"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest")
    found = revisits.join(response, "response_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to",
        F.coalesce(F.col("said") == F.col("payload_digest"), F.lit(False)).alias("verified"))
    return responses.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
                            F.lit(None).cast("long").alias("refers_to"), (F.col("said") == F.col("payload_digest")).alias("verified")).unionByName(found)
