"""WARC archives: a writer of per-record gzip members and a salvaging reader.

Of records with equal payloads of at least ``REVISIT_BYTES`` one is written as a
response and the others as revisits that refer to it.  Files go to a folder all
executors share, one for each partition, under a temporary name until complete,
so a task that runs twice replaces its own file.

The reader checks every record: gzip checksum, version line, header block,
Content-Length, closing line ends and block digest.  Where a check fails it
looks for the next gzip member or version line that holds a valid record, goes
on from there and reports the bytes between as a quarantined gap.  A member may
hold many records; inside it the search goes on in what it inflates to.  All that a
damaged member inflates to before the fault is kept: records in it that their digest
proves are recovered, be it that only the member's checksum is wrong.  The
reader works by offset, inflates as it goes and holds one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_dir

#: Payloads below this size are always written whole.
REVISIT_BYTES = 1000
#: What one row can hold: no record that was written from a row is longer.
MOST_BYTES = (1 << 31) - 1
#: Bytes in which the header block of an uncompressed record must end.
MOST_HEAD = 1 << 26
LEVEL = 4
_MAGIC, _VERSION, _END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "path string, kind string, start long, stop long, reason string, record_id string, record_type string, uri string, refers_to string, payload binary, payload_bytes long, payload_digest string"


def _b32(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(record_id: str, uri: str | None, payload: bytes, refers_to: str | None = None) -> bytes:
    """One uncompressed record; a revisit carries the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_clean(record_id)}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: {_b32(payload)}",
        f"WARC-Block-Digest: {_b32(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        lines.insert(3, f"WARC-Target-URI: {_clean(uri)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_clean(refers_to)}>"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + _END + block + _END


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _as_uri(path: str) -> str:
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


def write(records: DataFrame, folder: str) -> DataFrame:
    """Writes rows ``record_id, uri, payload, refers_to``; returns ``path, records, bytes``.

    A null payload is written as an empty one.  A partition without rows writes
    no file.
    """

    def out(it):
        from pyspark import TaskContext

        fs, base = _filesystem(folder)
        name = f"{base}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        part = f"{name}.{uuid.uuid4().hex}.tmp"
        sink, n, size = None, 0, 0
        for pdf in it:
            for rid, uri, payload, refers in zip(pdf["record_id"], pdf["uri"], pdf["payload"], pdf["refers_to"]):
                if sink is None:
                    fs.create_dir(base, recursive=True)
                    sink = fs.open_output_stream(part, compression=None)
                pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                raw = pack.compress(record(rid, uri, payload or b"", refers)) + pack.flush()
                sink.write(raw)
                n, size = n + 1, size + len(raw)
        if sink is not None:
            sink.close()
            fs.move(part, name)
            yield pd.DataFrame({"path": [f"{folder}/{name.rsplit('/', 1)[1]}"], "records": [n], "bytes": [size]})

    return records.select("record_id", "uri", "payload", "refers_to").mapInPandas(out, "path string, records long, bytes long")


class _Bytes:
    """Random access to a file with a window of recent bytes."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.window = file, size, 0, b""

    def get(self, start: int, n: int) -> bytes:
        n = max(0, min(n, self.size - start))
        if not (self.at <= start and start + n <= self.at + len(self.window)):
            want = min(max(n, 1 << 18), self.size - start)
            self.window, self.at = (self.file.read_at(want, start) if want > 0 else b""), start
        return self.window[start - self.at : start - self.at + n]

    def find(self, start: int) -> int:
        """Offset of the next gzip member or version line at or after ``start``; -1 if none."""
        while start < self.size:
            chunk = self.get(start, 1 << 18)
            hits = [i for i in (chunk.find(_MAGIC), chunk.find(_VERSION)) if i >= 0]
            if hits:
                return start + min(hits)
            if start + len(chunk) >= self.size:
                return -1
            start += len(chunk) - len(_VERSION) + 1
        return -1


class Damaged(ValueError):
    pass


class _Member:
    """The content of the gzip member at ``start``, inflated as far as it is asked for.

    The deflate stream is inflated without its gzip frame, and checksum and length are checked
    here, so whatever comes out before a fault stays.  With ``plain`` the header is taken
    as one of ten bytes, whatever its flags say.
    """

    def __init__(self, src: _Bytes, start: int, plain: bool = False):
        self.src, self.error = src, ""
        self.first = self.at = start + 10 if plain else self._body(start)
        self.z = zlib.decompressobj(-15)
        self.base, self.held = 0, bytearray()
        self.crc, self.size, self.tail, self.ended = 0, 0, b"", False

    def _body(self, start: int) -> int:
        """Where the deflate stream begins: after the header and the fields that its flags name."""
        head = self.src.get(start, 10)
        at, flags = start + 10, head[3] if len(head) == 10 else 0xE0
        if flags & 0xE0:
            self.error = "gzip: header is damaged"
            return at
        if flags & 4:
            at += 2 + int.from_bytes(self.src.get(at, 2), "little")
        for flag in (8, 16):
            if flags & flag:
                end = self.src.get(at, 1 << 16).find(b"\0")
                if end < 0:
                    self.error = "gzip: header does not end"
                at += end + 1
        return at + 2 if flags & 2 else at

    def _take(self, out: bytes):
        self.held += out
        self.crc, self.size = zlib.crc32(out, self.crc), self.size + len(out)

    def _salvage(self, data: bytes):
        """Inflates ``data``, in which a fault lies, up to the last byte before it."""
        while data and not self.error:
            saved = self.z.copy()
            try:
                out = self.z.decompress(data)
            except zlib.error as e:
                self.z = saved
                if len(data) > 1:
                    self._salvage(data[: len(data) // 2])
                    data = data[len(data) // 2 :]
                    continue
                try:  # one byte may still say a few things before it goes wrong
                    while out := self.z.decompress(data, 1):
                        self._take(out)
                        data = self.z.unconsumed_tail
                except zlib.error:
                    pass
                self.error = f"gzip: {e}"
                return
            self._take(out)
            self.at += len(data) - len(self.z.unused_data)
            return

    def get(self, start: int, n: int) -> bytes:
        while self.base + len(self.held) < start + n and not self.ended and not self.error:
            data = self.tail or self.src.get(self.at, 1 << 16)
            if not data:
                self.error = "member is cut off"
                break
            saved = self.z.copy()
            try:
                out = self.z.decompress(data, 1 << 22)
            except zlib.error:
                self.z, self.tail = saved, b""
                self._salvage(data)
            else:
                self._take(out)
                self.tail = b"" if self.z.eof else self.z.unconsumed_tail  # at its end zlib may name what is left twice
                self.at += len(data) - len(self.tail) - len(self.z.unused_data)
            if self.z.eof and not self.ended:
                self.ended = True
                said = self.src.get(self.at, 8)
                if said != self.crc.to_bytes(4, "little") + (self.size & 0xFFFFFFFF).to_bytes(4, "little"):
                    self.error = "gzip: checksum or length differ" if len(said) == 8 else "member is cut off"
        return bytes(self.held[start - self.base : start - self.base + n])

    def stop(self) -> int:
        """Where what was read ends: behind the trailer, if it is sound."""
        return self.at + 8 if self.ended and not self.error else self.at

    def place(self, offset: int) -> int:
        """The offset in the file up to which the first ``offset`` inflated bytes are told."""
        z, at, done, step = zlib.decompressobj(-15), self.first, 0, 1 << 12
        while done < offset and at < self.at:
            saved, data = z.copy(), self.src.get(at, min(step, self.at - at))
            out = len(z.decompress(data))
            if done + out >= offset and len(data) > 1:
                z, step = saved, len(data) // 2
                continue
            at, done = at + len(data), done + out
        return at

    def drop(self, upto: int):
        """Forgets what lies before ``upto``."""
        del self.held[: upto - self.base]
        self.base = upto

    def find(self, start: int) -> int:
        """Offset of the next version line at or after ``start``; -1 if none."""
        while chunk := self.get(start, 1 << 18):
            hit = chunk.find(_VERSION)
            if hit >= 0:
                return start + hit
            if len(chunk) < len(_VERSION):
                return -1
            start += len(chunk) - len(_VERSION) + 1
            self.drop(start)
        return -1


def _headers(raw: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    last = None
    for line in raw.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and last:
            found[last] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            found[last] = value.strip()
        elif line:
            raise Damaged("header line without a colon")
    return found


def _parse(get, start: int, most_head: int) -> tuple[dict, bytes, int, bool]:
    """Headers, block and end of the record that ``get`` yields bytes of; whether a digest proved the block."""
    head, n = b"", 1 << 12
    while True:
        head = get(start, n)
        if not head.startswith(_VERSION):
            raise Damaged("no version line")
        stop = head.find(_END)
        if stop >= 0:
            break
        if len(head) < n or n > most_head:
            raise Damaged("header block does not end")
        n *= 4
    version, _, rest = head[:stop].partition(b"\r\n")
    headers = _headers(rest)
    length = headers.get("content-length", "")
    if not length.isdigit() or int(length) > MOST_BYTES:
        raise Damaged("Content-Length is missing or wrong")
    body = start + stop + len(_END)
    block = get(body, int(length) + len(_END))
    if len(block) != int(length) + len(_END) or not block.endswith(_END):
        raise Damaged("block does not end where it says")
    block = block[: -len(_END)]
    said = headers.get("warc-block-digest", "")
    if said.startswith("sha1:") and said != _b32(block):
        raise Damaged("block digest differs")
    return headers, block, body + len(block) + len(_END), said.startswith("sha1:")


def _inside(src: _Bytes, start: int, plain: bool = False):
    """What the gzip member at ``start`` holds.

    Returns where to go on, where the bytes begin that are lost (-1: none are) and why, and
    whether a record was found.  Offsets are those of the file; a gap inside
    also names the inflated bytes.
    """
    member, at, bad, why, last = _Member(src, start, plain), 0, -1, "", -1
    while member.get(at, 1):
        try:
            headers, block, end, proved = _parse(member.get, at, MOST_BYTES)
            member.get(end, 1)  # to the member's own checksum, if it ends here
            if member.error and not proved:
                raise Damaged(member.error)
        except Damaged as e:
            if bad < 0:
                bad, why = at, str(e)
            at = member.find(at + 1)
            if at < 0:
                break
            continue
        if bad >= 0:
            yield "gap", member.place(bad) if last >= 0 else start, member.place(at), f"{why}; inflated bytes {bad} to {at}", b""
            bad = -1
        yield "record", start, member.stop(), headers, block
        member.drop(end)
        at = last = end
    if last < 0:
        return (member.stop() if member.ended and not member.error else start + 1), start, member.error or why or "an empty member", False
    if member.ended and bad < 0:  # all of it was read; its checksum alone may be wrong
        return member.stop(), member.at if member.error else -1, member.error, True
    lost = member.place(last)
    if member.ended and not member.error:
        yield "gap", lost, member.stop(), f"{why}; inflated bytes from {last}", b""
        return member.stop(), -1, "", True
    # what follows the last good record may hold the next member, if this one was cut off; a
    # version line right there is that of the stored record that has just failed
    return lost + (src.get(lost, len(_VERSION)) == _VERSION), lost, member.error or why, True


def records_of(file, size: int):
    """Yields ('record', start, stop, headers, block) and ('gap', start, stop, reason, b'').

    A gap begins where the last good record ends.  The search goes on right behind it, so
    no record comes twice and none that can be read is passed over.
    """
    src = _Bytes(file, size)
    at, bad, why, good = 0, -1, "", True
    while at < size:
        plain = src.get(at, len(_VERSION)) == _VERSION
        tries = [] if plain else [False, True] if src.get(at, 3) == _MAGIC else [True] if good else []
        found = False
        for forced in tries:  # a header whose bytes are damaged hides a sound stream
            inner = _inside(src, at, forced)
            try:
                while True:
                    row = next(inner)
                    if 0 <= bad < at:  # a trailer may be missing without a byte lost
                        yield "gap", bad, at, why, b""
                    bad = -1
                    yield row
            except StopIteration as end:
                resume, lost, reason, found = end.value
            if found or not forced and resume > at + 1:
                break
        if tries and (found or src.get(at, 3) == _MAGIC and resume > at + 1):
            good = lost < 0
            if not good and bad < 0 and lost < size:
                bad, why = lost, reason
            at = resume if good or not found else src.find(resume)
        elif plain:
            try:
                headers, block, stop, _ = _parse(src.get, at, MOST_HEAD)
            except Damaged as e:
                if bad < 0:
                    bad, why = at, str(e)
                good, at = False, src.find(at + 1)
            else:
                if 0 <= bad < at:
                    yield "gap", bad, at, why, b""
                bad = -1
                yield "record", at, stop, headers, block
                good, at = True, stop
        else:
            if bad < 0:
                bad, why = at, reason if tries else "no version line"
            good, at = False, src.find(at + 1)
        if at < 0:
            break
    if bad >= 0:
        yield "gap", bad, size, why, b""


def _row(path, kind, start, stop, what, block, keep_payload):
    if kind == "gap":
        return (path, kind, start, stop, what, None, None, None, None, None, None, None)
    rid, refers = what.get("warc-record-id", "").strip("<>"), what.get("warc-refers-to")
    payload, length = block, len(block)
    if block.startswith(b"HTTP/"):
        top, _, payload = block.partition(_END)
        said = _headers(top.partition(b"\r\n")[2]).get("content-length", "")
        length = int(said) if said.isdigit() else len(payload)
    kind_of = what.get("warc-type")
    if kind_of == "revisit":
        said = what.get("warc-payload-digest", "")
        digest = base64.b32decode(said[5:]).hex() if said.startswith("sha1:") else None
        payload = None
    else:
        digest, length = hashlib.sha1(payload).hexdigest(), len(payload)
    return (path, kind, start, stop, None, rid, kind_of, what.get("warc-target-uri"), refers and refers.strip("<>"), payload if keep_payload else None, length, digest)


def read(files: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Rows of ``RECORD`` for column ``path`` of ``files``: records and quarantined gaps.

    A revisit has no payload; its size and digest are those of the full one.
    """
    names = [f.split()[0] for f in RECORD.split(", ")]

    def out(it):
        for pdf in it:
            for path in pdf["path"]:
                fs, name = _filesystem(_as_uri(path))
                rows, held = [], 0
                with fs.open_input_file(name) as file:
                    for kind, start, stop, what, block in records_of(file, file.size()):
                        rows.append(_row(path, kind, start, stop, what, block, keep_payload))
                        held += len(block) if keep_payload else 200
                        if held > 1 << 22:
                            yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})

    return files.select("path").mapInPandas(out, RECORD)


def gaps(rows: DataFrame) -> DataFrame:
    """The quarantine log: where bytes were passed over, and why."""
    return rows.filter("kind = 'gap'").select("path", "start", "stop", "reason")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` of the archives in a folder, a file a task."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder).select("path", "length")
    return found.repartition("path").select("path")


def remove(folder: str) -> None:
    """Deletes a folder of archives that nothing reads any more."""
    fs, base = _filesystem(_as_uri(folder))
    fs.delete_dir(base)


def archive_pages(pages: DataFrame, folder: str, html: str = "html", url: str = "url", id_col: str = "page_id") -> DataFrame:
    """Writes one record a row of ``pages``; returns the files, already written.

    Of rows with equal payloads of at least ``REVISIT_BYTES`` that with the
    largest id is the response.  Null html is an empty payload; rows of null id
    are responses of their own.  Rows that repeat id and payload are alike.  Other
    columns are not read; an empty table writes no file.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url).alias("uri"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("whole", F.octet_length("payload") >= REVISIT_BYTES)
    # two digests, so that payloads that share one stay apart; small pages meet nothing and are dealt evenly
    spread = F.concat(F.lit("-"), F.pmod(F.xxhash64("id", "payload"), F.lit(1 << 20)).cast("string"))
    rows = rows.withColumn("digest", F.when(F.col("whole"), F.concat(F.sha1("payload"), F.md5("payload"))).otherwise(spread))
    same = rows.filter("whole").groupBy("digest").agg(F.max("id").alias("last"), F.count("*").alias("n")).filter("n > 1")
    joined = rows.join(same.select(F.col("digest").alias("d"), "last"), F.col("digest") == F.col("d"), "left")
    made = joined.select(
        F.concat(F.lit("urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("none"))).alias("record_id"),
        "uri",
        "payload",
        F.when(F.col("id") != F.col("last"), F.concat(F.lit("urn:page:"), F.col("last").cast("string"))).alias("refers_to"),
    )
    return cut(write(made, folder))


def round_trip(pages: DataFrame) -> DataFrame:
    """Archives ``pages`` in the shared folder and reads the archives back.

    One row per row of ``pages``, none of an empty table: a gap in what was just written is an
    error.  The archives stay in the shared folder; ``remove`` deletes a folder of them.
    """
    spark = pages.sparkSession
    folder = f"{_as_uri(shared_dir(spark)).rstrip('/')}/warc-{uuid.uuid4().hex}"
    files = archive_pages(pages, folder)
    files = files.repartition(max(1, min(files.count(), 10_000)), "path")
    rows = read(files, keep_payload=False)
    lost = F.raise_error(F.concat_ws(" ", F.lit("quarantined:"), "path", "start", "stop", "reason")).cast("string")
    rows = rows.withColumn("kind", F.when(F.col("kind") == "gap", lost).otherwise(F.col("kind"))).filter("kind = 'record'")

    def number(col: str):
        return F.regexp_extract(F.col(col), r"^urn:page:(-?\d+)$", 1).try_cast("bigint")

    return rows.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id <> last THEN last END AS refers_to
FROM m
"""
