"""Block-gzipped, position-sorted text: read in splits, and by regions through its index.

A block-gzip file is a chain of gzip members of at most 64 KB that each tell their own size, so
any byte range can be read on its own: a split begins at the first block in it, skips the
line that the block before has begun, and ends with the line that crosses into the next split.
With an index beside the file (``.tbi``) a query for regions reads only the blocks that hold them.

``spark.read.format("bgzf").load(path)`` gives ``contig, pos, value`` (the whole line) of all
lines but comments.  Regions come from filters on contig and pos, where the session pushes
filters to Python sources, or from the option ``regions`` (``1:100-200,2``, from 1, ends included).
Files are read through Arrow's file systems: local paths, and the stores they know by URI.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "contig string, pos bigint, value string"
#: Bytes of a split, and the gap up to which two index chunks are read as one.
SPLIT, NEAR = 64 << 20, 1 << 16
#: The block's magic, its empty last block, the index's magic and bins (shift of a bin's width, number of its first).
MAGIC = b"\x1f\x8b\x08\x04"
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
INDEX = b"TBI\x01"
LEVELS = [(29, 0), (26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)]
LINEAR = 14
FAR = 1 << 29


def filesystem(uri: str):
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.replace("file:/", "file:///", 1)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class Blocks:
    """The blocks of one file by offset."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.window = file, size, 0, b""
        self.bytes_read = 0

    def _get(self, start: int, n: int) -> bytes:
        n = max(0, min(n, self.size - start))
        if not self.at <= start <= start + n <= self.at + len(self.window):
            self.window, self.at = self.file.read_at(min(max(n, 1 << 17), self.size - start), start), start
            self.bytes_read += len(self.window)
        return self.window[start - self.at : start - self.at + n]

    def length(self, start: int) -> int:
        """Bytes of the block at ``start``; 0 if none begins there."""
        head = self._get(start, 12)
        if len(head) < 12 or not head.startswith(MAGIC):
            return 0
        extra = self._get(start + 12, int.from_bytes(head[10:12], "little"))
        while len(extra) >= 4:
            n = int.from_bytes(extra[2:4], "little")
            if extra[:2] == b"BC" and n == 2:
                return int.from_bytes(extra[4:6], "little") + 1
            extra = extra[4 + n :]
        return 0

    def first(self, start: int) -> int:
        """Offset of the first block at or after ``start``; the file's size if none."""
        while start < self.size:
            some = self._get(start, 1 << 17)
            hit = some.find(MAGIC)
            if hit < 0:
                start += max(1, len(some) - 3)
                continue
            n = self.length(start + hit)
            if n and (start + hit + n == self.size or self.length(start + hit + n)):
                return start + hit
            start += hit + 1
        return self.size

    def text(self, start: int, n: int) -> bytes:
        raw = self._get(start, n)
        if len(raw) < n:
            raise ValueError(f"the block at {start} is cut off")
        skip = 12 + int.from_bytes(raw[10:12], "little")
        out = zlib.decompress(raw[skip:-8], -15)
        if zlib.crc32(out) != int.from_bytes(raw[-8:-4], "little"):
            raise ValueError(f"the block at {start} is damaged")
        return out

    def lines(self, start: int, within: int = 0) -> Iterator[tuple[int, int, bytes]]:
        """(block, place in it, line) of the lines from a place on; a place may be in mid-line."""
        rest, at = b"", (start, within)
        while start < self.size:
            n = self.length(start)
            if not n:
                raise ValueError(f"no block begins at {start}")
            text = self.text(start, n)
            place = within
            within = 0
            while (end := text.find(b"\n", place)) >= 0:
                yield *at, rest + text[place:end]
                rest, place = b"", end + 1
                at = (start, place) if place < len(text) else (start + n, 0)
            rest += text[place:]
            start += n
        if rest:
            yield *at, rest


@dataclass
class Part(InputPartition):
    """Lines of ``path`` from a place on, to a virtual offset, or to the block at or after ``stop``."""

    path: str
    start: int
    within: int
    stop: int
    virtual: bool
    whole: bool  # whether it begins with a line, not inside one


def part_lines(src: Blocks, part: Part) -> Iterator[bytes]:
    start = part.start if part.whole else src.first(part.start)
    # lines that begin right at the next split's first block are still of this one
    stop = (part.stop >> 16, part.stop & 0xFFFF) if part.virtual else (src.first(part.stop), 1)
    lines = src.lines(start, part.within)
    if not part.whole and next(lines, None) is None:
        return
    for block, place, line in lines:
        if (block, place) >= stop:
            return
        yield line


def read_index(raw: bytes) -> dict[str, tuple[dict[int, list[tuple[int, int]]], list[int]]]:
    """``contig: (bins, linear)``: chunks of virtual offsets a bin, and the first offset of every 16 kb."""
    data, at = b"", 0
    while at < len(raw):
        piece = zlib.decompressobj(31)
        data += piece.decompress(raw[at:])
        at = len(raw) - len(piece.unused_data)
    if not data.startswith(INDEX):
        raise ValueError("this is no index")
    n_ref, *_, n_names = struct.unpack_from("<8i", data, 4)
    names, at = data[36 : 36 + n_names].split(b"\0")[:n_ref], 36 + n_names
    out = {}
    for name in names:
        bins: dict[int, list[tuple[int, int]]] = {}
        (n_bins,) = struct.unpack_from("<i", data, at)
        at += 4
        for _ in range(n_bins):
            number, n = struct.unpack_from("<Ii", data, at)
            flat = struct.unpack_from(f"<{2 * n}Q", data, at + 8)
            bins[number] = list(zip(flat[::2], flat[1::2]))
            at += 8 + 16 * n
        (n,) = struct.unpack_from("<i", data, at)
        out[name.decode()] = bins, list(struct.unpack_from(f"<{n}Q", data, at + 4))
        at += 4 + 8 * n
    return out


def write_index(contigs: dict[str, tuple[dict[int, list[tuple[int, int]]], list[int]]]) -> bytes:
    names = b"".join(c.encode() + b"\0" for c in contigs)
    data = INDEX + struct.pack("<8i", len(contigs), 2, 1, 2, 0, ord("#"), 0, len(names)) + names
    for bins, linear in contigs.values():
        data += struct.pack("<i", len(bins))
        for number, chunks in bins.items():
            data += struct.pack("<Ii", number, len(chunks)) + b"".join(struct.pack("<2Q", *c) for c in chunks)
        data += struct.pack(f"<i{len(linear)}Q", len(linear), *linear)
    return b"".join(_block(data[i : i + 65280]) for i in range(0, len(data), 65280)) + END


def _block(text: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = z.compress(text) + z.flush()
    head = MAGIC + bytes(4) + b"\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(packed) + 25)
    return head + packed + struct.pack("<2I", zlib.crc32(text), len(text))


def bin_of(start: int, end: int) -> int:
    """The narrowest bin that holds [start, end), from 0."""
    return next(first + (start >> shift) for shift, first in reversed(LEVELS) if start >> shift == (end - 1) >> shift)


def chunks_of(index, contig: str, start: int, end: int) -> list[tuple[int, int]]:
    """Stretches of virtual offsets that may hold lines in [start, end), from 0, near ones joined."""
    if contig not in index or start >= end:
        return []
    start, end = max(start, 0), max(end, 1)
    bins, linear = index[contig]
    least = linear[min(start >> LINEAR, len(linear) - 1)] if linear else 0
    wanted = [range(first + (start >> shift), first + (min(end, FAR) - 1 >> shift) + 1) for shift, first in LEVELS]
    found = sorted(c for number, cs in bins.items() if any(number in w for w in wanted) for c in cs if c[1] > least)
    out: list[tuple[int, int]] = []
    for a, b in found:
        if out and (a >> 16) <= (out[-1][1] >> 16) + NEAR:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((max(a, least), b))
    return out


def regions_of(text: str) -> list[tuple[str, int, int]]:
    """``1:100-200,2`` as (contig, start, end) from 0, end excluded; a whole contig from -1, as a place may be 0."""
    out = []
    for piece in filter(None, text.split(",")):
        contig, _, span = piece.strip().rpartition(":") if ":" in piece else (piece.strip(), "", "")
        a, _, b = span.partition("-")
        out.append((contig, int(a) - 1 if a else -1, int(b) if b else FAR))
    return out


class BlockGzip(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bgzf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("split", SPLIT))
        self.regions = regions_of(options["regions"]) if options.get("regions") else None
        self.contigs: list[str] | None = None
        self.low, self.high = -1, FAR

    def pushFilters(self, filters):
        """Filters tell which blocks to read; Spark still applies each of them to the rows."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") else None
            if column == "contig" and isinstance(f, (EqualTo, In)):
                names = [f.value] if isinstance(f, EqualTo) else list(f.value)
                self.contigs = [c for c in names if self.contigs is None or c in self.contigs]
            elif column == "pos" and isinstance(f, EqualTo):
                self.low, self.high = max(self.low, f.value - 1), min(self.high, f.value)
            elif column == "pos" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, f.value - isinstance(f, GreaterThanOrEqual))
            elif column == "pos" and isinstance(f, (LessThan, LessThanOrEqual)):
                self.high = min(self.high, f.value - isinstance(f, LessThan))
        return filters

    def partitions(self) -> list[Part]:
        """Byte ranges of the files; of an indexed file, where regions are asked for, the ranges that hold them."""
        from pyarrow import fs as pafs

        fs, path = filesystem(self.path)
        info = fs.get_file_info(path)
        scheme = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else ""
        infos = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(path))
        files = {i.path: i.size for i in infos if i.is_file}
        regions = self.regions
        if regions is None and self.contigs is not None:
            regions = [(c, self.low, self.high) for c in self.contigs]
        out: list[Part] = []
        for name in sorted(n for n in files if not n.rpartition("/")[2].startswith(("_", ".")) and not n.endswith(".tbi")):
            beside = f"{name}.tbi"
            indexed = beside in files or info.is_file and fs.get_file_info(beside).is_file
            if regions is None or not indexed:
                ranges = [(0, 0, files[name] << 16, False)]
            else:
                with fs.open_input_file(beside) as f:
                    index = read_index(f.read())
                spans = sorted(s for r in regions for s in chunks_of(index, *r))
                ranges = []
                for a, b in spans:  # regions may share blocks, lines come once
                    if ranges and a < ranges[-1][2]:
                        ranges[-1] = (*ranges[-1][:2], max(b, ranges[-1][2]), True)
                    else:
                        ranges.append((a >> 16, a & 0xFFFF, b, True))
            for start, within, stop, virtual in ranges:
                cuts = list(range(start + self.split, stop >> 16, self.split))
                edges = [start, *cuts]
                for k, begin in enumerate(edges):
                    last = k == len(edges) - 1
                    end = (stop if virtual else stop >> 16) if last else edges[k + 1]
                    out.append(Part(scheme + name, begin, within if k == 0 else 0, end, virtual and last, k == 0))
        return out or [Part("", 0, 0, 0, False, True)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        fs, name = filesystem(part.path)
        wanted = None if self.regions is None else self.regions
        with fs.open_input_file(name) as file:
            contigs, places, lines = [], [], []

            def batch():
                columns = [pa.array(contigs, pa.string()), pa.array(places, pa.int64()), pa.array(lines, pa.binary()).cast(pa.string())]
                return pa.RecordBatch.from_arrays(columns, names=["contig", "pos", "value"])

            for line in part_lines(Blocks(file, file.size()), part):
                if line.startswith(b"#") or not line:
                    continue
                contig, pos, *_ = line.split(b"\t", 2)
                contig, pos = contig.decode(), int(pos)
                if wanted is not None and not any(c == contig and a < pos <= b for c, a, b in wanted):
                    continue
                contigs.append(contig)
                places.append(pos)
                lines.append(line)
                if len(lines) >= 8192:
                    yield batch()
                    contigs, places, lines = [], [], []
            if lines:
                yield batch()


def register(spark: SparkSession) -> None:
    """Makes ``bgzf`` known to the session, and lets filters reach Python sources."""
    spark.dataSource.register(BlockGzip)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_sorted(lines: DataFrame, folder: str, files: int | None = None) -> DataFrame:
    """Writes (contig, pos, value) as block-gzipped files in order, each with its index; returns ``path, lines, bytes``.

    Files are ranges of (contig, pos); a file is written under a temporary name and moved, so a
    task that runs twice replaces its own.
    """

    def out(it):
        from pyspark import TaskContext

        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        name = f"{base}/part-{TaskContext.get().partitionId():06d}.vcf.gz"
        index: dict[str, tuple[dict[int, list[tuple[int, int]]], list[int]]] = {}
        text, offset, n = bytearray(), 0, 0
        with fs.open_output_stream(f"{name}.tmp", compression=None) as sink:

            def flush(most: int) -> None:
                nonlocal offset
                while len(text) > most:
                    raw = _block(bytes(text[:65280]))
                    sink.write(raw)
                    offset += len(raw)
                    del text[:65280]

            for pdf in it:
                for contig, pos, value in zip(pdf["contig"], pdf["pos"], pdf["value"]):
                    flush(65279)
                    bins, linear = index.setdefault(contig, ({}, []))
                    begin = offset << 16 | len(text)
                    text += value.encode() + b"\n"
                    flush(65279)
                    end, width = offset << 16 | len(text), max(1, len(value.split("\t", 4)[3]) if value.count("\t") > 3 else 1)
                    first = max(pos - 1, 0)
                    chunks = bins.setdefault(bin_of(first, first + width), [])
                    if chunks and chunks[-1][1] == begin:
                        chunks[-1] = (chunks[-1][0], end)
                    else:
                        chunks.append((begin, end))
                    for k in range(first >> LINEAR, (first + width - 1 >> LINEAR) + 1):
                        linear.extend([begin if not linear else linear[-1]] * (k - len(linear)))
                        if len(linear) == k:
                            linear.append(begin)
                    n += 1
            flush(0)
            sink.write(END)
        if n:
            with fs.open_output_stream(f"{name}.tbi", compression=None) as f:
                f.write(write_index(index))
            fs.move(f"{name}.tmp", name)
            yield pd.DataFrame({"path": [name], "lines": [n], "bytes": [offset + len(END)]})
        else:
            fs.delete_file(f"{name}.tmp")

    rows = lines.select("contig", F.col("pos").cast("bigint").alias("pos"), "value")
    order = ["contig", "pos", "value"]
    ranged = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).mapInPandas(out, "path string, lines long, bytes long")
