"""FASTA files as tiles, by a data source whose partitions are byte ranges.

A range is read from its first byte, and past its end only as far as its last tile's overlap asks, so no row is a chromosome and
nothing is cut out of one. What stands before a range's first header belongs to a contig that began in an earlier range; an
index of the ranges, a row for each contig that a range touches, tells which and how far it had come.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

TILE, RANGE = 65_536, 16 << 20
#: Bytes of a header line at most.
HEADER = 65_536
ROWS = "file string, range long, part int, contig string, at long, n int, before string, ends boolean, seq string"
BATCH = 64
#: Ranges whose index is sent to every task, some 20 MB; with more, tiles are dealt by their range.
FEW = 200_000


class Range(InputPartition):
    def __init__(self, file: str, start: int, end: int):
        super().__init__((file, start))
        self.file, self.start, self.end = file, start, end


class Lines:
    """Lines of a file from byte `at` on, without line ends."""

    def __init__(self, stream: pa.NativeFile, at: int, whole: bool):
        self.stream, self.at, self.whole = stream, at, whole

    def __iter__(self) -> Iterator[tuple[int, bool, bytes]]:
        """(first byte, begins a line, bytes): long lines come in pieces."""
        at, whole, rest = self.at, self.whole, b""
        while block := self.stream.read(1 << 18):
            rest += block
            *lines, rest = rest.split(b"\n")
            for line in lines:
                yield at, whole, line
                at, whole = at + len(line) + 1, True
            if len(rest) > 1 << 16 and not (whole and rest[:1] == b">"):  # headers come whole
                yield at, whole, rest
                at, whole, rest = at + len(rest), False, b""
        if rest:
            yield at, whole, rest


class FastaReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.tile, self.overlap = int(options.get("tile", TILE)), int(options.get("overlap", 0))
        self.range, self.index = int(options.get("range", RANGE)), options.get("index", "false") == "true"

    def partitions(self) -> list[Range]:
        store, path = pafs.FileSystem.from_uri(self.path)
        info = store.get_file_info(path)
        found = [info] if info.is_file else [f for f in store.get_file_info(pafs.FileSelector(path, recursive=True)) if f.is_file and not f.base_name.startswith(("_", "."))]
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        out = []
        for f in sorted(found, key=lambda f: f.path):
            step = f.size if f.path.endswith((".gz", ".bgz")) else self.range  # what is packed is read from its start
            out += [Range(f.path, s, min(s + step, f.size)) for s in range(0, f.size, max(1, step))]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(self.path)
        packed = partition.file.endswith((".gz", ".bgz"))
        with store.open_input_file(partition.file) as file:
            stream = pa.CompressedInputStream(file, "gzip") if packed else file
            start, whole, before = self.first_line(file, partition.start) if partition.start else (0, True, "")
            rows = self.rows(partition.file, partition.start, (1 << 62) if packed else partition.end, Lines(stream, start, whole), before)
            yield from self.batches(rows)

    def first_line(self, file: pa.NativeFile, start: int) -> tuple[int, bool, str]:
        """(the range's first byte that is not of a header before it, whether that begins a line, the base before it); leaves
        the file there."""
        back = min(start, HEADER)
        file.seek(start - back)
        head = file.read(back)
        line = head[head.rfind(b"\n") + 1 :]
        if line[:1] == b">" and (b"\n" in head or back == start):
            at = start
            while block := file.read(1 << 12):
                if b"\n" in block:
                    at += block.index(b"\n") + 1
                    break
                at += len(block)
            file.seek(at)
            return at, True, ""
        solid = head.rstrip()
        of_header = solid[solid.rfind(b"\n") + 1 :][:1] == b">" and (b"\n" in solid or back == start)
        return start, not line, "" if of_header else solid[-1:].decode("utf-8", "replace")

    def batches(self, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("range", pa.int64()), ("part", pa.int32()), ("contig", pa.string()), ("at", pa.int64()), ("n", pa.int32()), ("before", pa.string()), ("ends", pa.bool_()), ("seq", pa.string())])
        held: list[tuple] = []
        for row in rows:
            held.append(row)
            if len(held) == BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

    def rows(self, file: str, start: int, end: int, lines: Lines, before: str) -> Iterator[tuple]:
        """Rows of ROWS. Part 0 is what stands before the first header; `at` counts within the part. The index has a row for each
        part, with its bases in `at`."""
        part, contig, at, buffer, own = 0, None, 0, bytearray(), 0
        over = False  # past the range's end, where only the last tile's overlap is wanted

        def tiles(last: bool) -> Iterator[tuple]:
            nonlocal at, buffer, before, own
            while own >= self.tile and len(buffer) >= self.tile + self.overlap or last and own:
                n = min(self.tile, own)
                seq = bytes(buffer[: n + self.overlap])
                text = seq.decode("utf-8", "replace")
                yield file, start, part, contig, at, n, before, last and len(buffer) <= n + self.overlap and closed, text
                before, at, own = text[n - 1], at + n, own - n
                del buffer[:n]

        closed = True  # the contig ends in what is held
        for where, whole, line in lines:
            if whole and line[:1] == b">":
                closed = True
                if self.index:
                    yield file, start, part, contig, at, 0, "", True, ""
                else:
                    yield from tiles(True)
                if where >= end:
                    return
                part, contig, at, buffer, before, own, over = part + 1, line[1:].decode("utf-8", "replace").split(None, 1)[0] if line[1:].split() else "", 0, bytearray(), "", 0, False
                continue
            over = over or where >= end
            bases = line.translate(None, b" \t\r\v\f")
            inside = bases
            if not over and where + len(line) > end:  # the line goes on past the range
                inside = line[: end - where].translate(None, b" \t\r\v\f")
            elif over:
                inside = b""
            if self.index:
                at += len(inside)
                if where + len(line) >= end:
                    break
                continue
            own += len(inside)
            buffer += bases
            yield from tiles(False)
            if (over or where + len(line) >= end) and len(buffer) >= own + self.overlap:
                closed = False
                break
        if self.index:
            yield file, start, part, contig, at, 0, "", True, ""
        else:
            yield from tiles(True)


class FastaTiles(DataSource):
    """Options: path, tile (bases of a tile), overlap (bases after it), range (bytes of a partition), index (true: one row for each
    part of a range)."""

    @classmethod
    def name(cls) -> str:
        return "fasta_tiles"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> DataSourceReader:
        return FastaReader(dict(self.options))


def read_fasta_tiles(spark: SparkSession, path: str, overlap: int = 0, tile: int = TILE, range_bytes: int = RANGE) -> DataFrame:
    """(contig, at, n, before, ends, seq): the n bases of a contig from base `at` on, in `seq` with up to `overlap` that follow; the base
    before them; and whether the contig ends in `seq`. `operators.sequence` takes such frames wherever it takes (contig, seq).

    For files (plain, or gzip in one partition each) in stores that pyarrow opens by the path. Names end at white space, which is
    also left out of sequences; bases are single bytes. A contig that the file names twice has two sequences of tiles.
    """
    spark.dataSource.register(FastaTiles)
    options = {"path": path, "tile": str(tile), "overlap": str(overlap), "range": str(range_bytes)}
    tiles = spark.read.format("fasta_tiles").options(**options).load()
    parts = spark.read.format("fasta_tiles").options(**options, index="true").load().groupBy("file", "range").agg(F.max_by(F.struct("contig", F.col("at").alias("bases")), "part").alias("last"), F.max("part").alias("parts"))
    # one row for each range of a file
    earlier = W.partitionBy("file").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("file").orderBy("range")
    named = parts.withColumn("began", F.max(F.when(F.col("parts") > 0, F.col("range"))).over(earlier)).withColumn("total", F.sum("last.bases").over(upto.rowsBetween(W.unboundedPreceding, 0)))
    # bases since the last header: all parts that end ranges from that header's range on
    carried = named.withColumn("contig0", F.last(F.when(F.col("parts") > 0, F.col("last.contig")), ignorenulls=True).over(earlier)).withColumn("upto", F.lag("total").over(upto))
    start = named.select(F.col("file").alias("f"), F.col("range").alias("r"), (F.col("total") - F.col("last.bases")).alias("base"))
    carry = carried.join(start, (F.col("file") == F.col("f")) & (F.col("began") == F.col("r")), "left").select(F.col("file").alias("f"), F.col("range").alias("r"), "contig0", (F.col("upto") - F.col("base")).alias("at0"))
    if len(FastaReader(options).partitions()) <= FEW:
        carry = F.broadcast(carry)
    joined = tiles.join(carry, (F.col("file") == F.col("f")) & (F.col("range") == F.col("r")))
    first = F.col("part") == 0
    placed = joined.select(
        F.when(first, F.col("contig0")).otherwise(F.col("contig")).alias("contig"), F.when(first, F.coalesce("at0", F.lit(0)) + F.col("at")).otherwise(F.col("at")).alias("at"), "n", "before", "ends", "seq"
    )
    return placed.where("contig is not null")
