"""Text lines in plain, gzip and Zstandard files as one table, and shards of lines with limits on records and bytes.

Both are Python data sources. The reader makes one partition per file, decodes the file as a stream and hands lines over in Arrow batches, so
a task holds one decoded block whatever the size of the file. The writer gets lines dealt to numbered shards; a task writes its shards
in a folder of its own attempt, and the commit moves them to their names, so a retry or a speculative copy leaves nothing behind. Files are reached
through Arrow's file systems, by the scheme of the path. ``text_tree_sink`` writes plain lines in a folder per key in the same way.
"""

from __future__ import annotations

import gzip
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from contextlib import ExitStack
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from loomtab.operators.ordered import row_index, running_by_slices
from loomtab.session import written

BLOCK = 1 << 16
"""Bytes read from a file at a time."""
BATCH = 1 << 20
"""Bytes of lines in one Arrow batch, about."""
LEVEL = 3
SUFFIXES = {"none": "", "gzip": ".gz", "zstd": ".zst"}
NO_KEY = "__HIVE_DEFAULT_PARTITION__"
UNUSABLE = (OSError, EOFError, zlib.error)


def located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (fs.LocalFileSystem(), path)


def zstd_blocks(stream) -> Iterator[bytes]:
    """Content of all frames one after another."""
    import zstandard

    frame, decoder = None, zstandard.ZstdDecompressor()
    while block := stream.read(BLOCK):
        while block:
            frame = frame or decoder.decompressobj()
            try:
                yield frame.decompress(block)
            except zstandard.ZstdError as e:
                raise OSError(str(e)) from e
            block = frame.unused_data if frame.eof else b""
            frame = None if frame.eof else frame
    if frame:
        raise EOFError("the file ends inside a frame")


def decoded(stream, name: str) -> Iterator[bytes]:
    """Blocks of a file's content, by the ending of its name."""
    if name.endswith(".zst"):
        yield from zstd_blocks(stream)
        return
    source = gzip.GzipFile(fileobj=stream) if name.endswith(".gz") else stream
    while block := source.read(BLOCK):
        yield block


def lines_of(blocks: Iterator[bytes]) -> Iterator[list[bytes]]:
    held = b""
    for block in blocks:
        *whole, held = (held + block).split(b"\n")
        if whole:
            yield whole
    if held:
        yield [held]


@dataclass
class FilePartition(InputPartition):
    path: str


class LineReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> Sequence[FilePartition]:
        system, path = located(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.File:
            return [FilePartition(self.path)]
        found = system.get_file_info(fs.FileSelector(path, recursive=True))
        prefix = self.path[:len(self.path) - len(path)] if self.path.endswith(path) else ""
        names = sorted(f.path for f in found if f.type == fs.FileType.File and not any(p[:1] in "._" for p in f.path[len(path):].split("/") if p))
        return [FilePartition(prefix + n) for n in names] or [FilePartition("")]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, path = located(partition.path)
        number, values, size = 0, [], 0

        def batch(problem: str | None = None) -> pa.RecordBatch:
            n = len(values)
            texts = [v.decode("utf-8", "replace").removesuffix("\r") for v in values] + [None] * (problem is not None)
            places = [*range(number - n, number)] + [number] * (problem is not None)
            out = pa.RecordBatch.from_arrays([pa.array([partition.path] * len(texts), pa.string()), pa.array(places, pa.int64()), pa.array(texts, pa.string()),
                                              pa.array([None] * n + [problem] * (problem is not None), pa.string())], ["file", "number", "value", "problem"])
            values.clear()
            return out

        try:
            with system.open_input_stream(path, compression=None) as stream:
                for lines in lines_of(decoded(stream, path)):
                    for start in range(0, len(lines), 10_000):
                        part = lines[start:start + 10_000]
                        values += part
                        number += len(part)
                        size += sum(map(len, part))
                        if size > BATCH:
                            yield batch()
                            size = 0
        except UNUSABLE as e:
            yield batch(f"{type(e).__name__}: {e}")
            return
        if values:
            yield batch()


@dataclass
class Shards(WriterCommitMessage):
    moves: list[tuple[str, str]]


class LineWriter(DataSourceArrowWriter):
    """Lines (shard, value) to ``part-00000.jsonl`` and so on; rows come sorted by shard, each shard to one task."""

    def __init__(self, path: str, compression: str, overwrite: bool):
        self.path, self.suffix = path, ".jsonl" + SUFFIXES[compression]
        system, folder = located(path)
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            if not overwrite:
                raise FileExistsError(path)
            system.delete_dir(folder)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shards:
        system, folder = located(self.path)
        attempt, moves, shard = f"{folder}/_temporary/{uuid.uuid4().hex}", [], None
        system.create_dir(attempt, recursive=True)
        with ExitStack() as open_:
            sink = None
            for batch in iterator:
                numbers, values = batch.column("shard").to_pylist(), batch.column("value").to_pylist()
                for at, number in enumerate(numbers):
                    if number != shard:
                        open_.close()
                        shard, name = number, f"part-{number:05d}{self.suffix}"
                        moves.append((f"{attempt}/{name}", f"{folder}/{name}"))
                        sink = open_.enter_context(self.opened(system, moves[-1][0], open_))
                    sink.write(values[at].encode() + b"\n")
        return Shards(moves)

    def opened(self, system: fs.FileSystem, path: str, open_: ExitStack):
        stream = open_.enter_context(system.open_output_stream(path, compression=None))
        if self.suffix.endswith(".zst"):
            import zstandard

            return zstandard.ZstdCompressor(level=LEVEL).stream_writer(stream, closefd=False)
        return gzip.GzipFile(fileobj=stream, mode="wb", mtime=0) if self.suffix.endswith(".gz") else stream

    def commit(self, messages: list[Shards | None]) -> None:
        system, folder = located(self.path)
        system.create_dir(folder, recursive=True)
        for message in messages:
            for source, target in message.moves if message else ():
                system.move(source, target)
        self.abort(messages)

    def abort(self, messages: list[Shards | None]) -> None:
        system, folder = located(self.path)
        if system.get_file_info(f"{folder}/_temporary").type != fs.FileType.NotFound:
            system.delete_dir(f"{folder}/_temporary")


@dataclass
class Branches(WriterCommitMessage):
    """The files a task has written, as their number by folder."""

    top: str
    attempt: str
    counts: dict[str, int]

    @property
    def moves(self) -> Iterator[tuple[str, str]]:
        for folder, n in self.counts.items():
            for k in range(n):
                yield f"{self.top}/_temporary/{self.attempt}/{folder}/{k}", f"{self.top}/{folder}/part-{self.attempt}-{k:05d}.txt"


def key_folder(key: str, value: str | None) -> str:
    """``key=value`` as Spark names the folder of a partition."""
    return f"{key}=" + (re.sub(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value) if value else NO_KEY)


class TreeWriter(LineWriter):
    """Lines (key, value) to files of at most ``max_records`` lines in a folder per key; rows of a task come sorted by key. NULL is an empty line."""

    def __init__(self, path: str, key: str, max_records: int, overwrite: bool):
        super().__init__(path, "none", overwrite)
        self.key, self.max_records = key, max_records

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Branches:
        system, top = located(self.path)
        done, last, left = Branches(top, uuid.uuid4().hex, {}), None, 0
        with ExitStack() as open_:
            sink = None
            for batch in iterator:
                for key, value in zip(batch.column("key").to_pylist(), batch.column("value")):
                    if not left or key != last:
                        open_.close()
                        name, last, left = key_folder(self.key, key), key, self.max_records
                        k, at = done.counts.get(name, 0), f"{top}/_temporary/{done.attempt}/{name}"
                        if not k:
                            system.create_dir(at, recursive=True)
                        sink = open_.enter_context(system.open_output_stream(f"{at}/{k}", compression=None, buffer_size=BLOCK))
                        done.counts[name] = k + 1
                    sink.write((value.as_py() or b"") + b"\n")
                    left -= 1
        return done

    def commit(self, messages: list[Branches | None]) -> None:
        system, top = located(self.path)
        for name in {n for message in messages if message for n in message.counts}:
            system.create_dir(f"{top}/{name}", recursive=True)
        super().commit(messages)


class TextTree(DataSource):
    """Sink of ``key`` and ``value``: text files in a folder per key."""

    @classmethod
    def name(cls) -> str:
        return "loomtab_text_tree"

    def writer(self, schema: T.StructType, overwrite: bool) -> TreeWriter:
        return TreeWriter(self.options["path"], self.options["key"], int(self.options["max_records"]), overwrite)


class Lines(DataSource):
    """``file``, ``number`` (from 0), ``value`` of each line; a file that cannot be read to its end adds a row with its ``problem``."""

    @classmethod
    def name(cls) -> str:
        return "loomtab_lines"

    def schema(self) -> str:
        return "file string, number long, value string, problem string"

    def reader(self, schema: T.StructType) -> LineReader:
        return LineReader(self.options["path"])

    def writer(self, schema: T.StructType, overwrite: bool) -> LineWriter:
        return LineWriter(self.options["path"], self.options.get("compression", "none"), overwrite)


def text_tree_sink(df: DataFrame, path: str, key: str, value: str, max_records: int) -> None:
    """Text files of at most ``max_records`` lines below ``key=...`` folders, as ``partitionBy(key)`` with ``maxRecordsPerFile`` writes them.

    On a local or mounted file system Hadoop without its native library starts four processes for each file it makes (modes of the file
    and of its checksum file), which costs more than the lines where files are small; there the files are made by ``TreeWriter``. Elsewhere Spark's sink has no such cost.
    """
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = df.select(F.col(key), F.col(value))
    if system.getUri().getScheme() != "file":
        rows.write.partitionBy(key).option("maxRecordsPerFile", max_records).text(path)
        return
    spark.dataSource.register(TextTree)
    dealt = rows.select(F.col(key).cast("string").alias("key"), F.col(value).cast("binary").alias("value")).sortWithinPartitions("key")
    dealt.write.format(TextTree.name()).options(path=system.makeQualified(place).toUri().getPath(), key=key, max_records=max_records).mode("append").save()


def line_scan(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a file or of all files below a folder: ``.zst``, ``.gz`` and plain ones side by side."""
    spark.dataSource.register(Lines)
    return spark.read.format(Lines.name()).option("path", path).load()


def jsonl_any(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows of all JSON lines, problems): a problem is a file that ends early or is damaged (``number`` lines could be read), or a line that is no JSON."""
    lines = line_scan(spark, path)
    kept = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField("_line", T.StringType())])
    parsed = lines.where("problem IS NOT NULL OR length(trim(value)) > 0") \
        .withColumn("r", F.from_json("value", kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"}))
    rows = parsed.where("problem IS NULL AND r._line IS NULL").select("r.*").drop("_line")
    problems = parsed.where("problem IS NOT NULL OR r._line IS NOT NULL").select("file", "number", F.coalesce("problem", F.concat(F.lit("no JSON: "), "r._line")).alias("problem"))
    return rows, problems


def sharded(df: DataFrame, order: Sequence[str], value: str, max_records: int, max_bytes: int) -> DataFrame:
    """(shard, order..., value): shards 0, 1, ... of at most ``max_records`` lines and ``max_bytes`` bytes, line ends included.

    Lines are dealt by running sums of their bytes. A line belongs to the window of the sums in which it ends, so a window holds
    its own width and what reaches into it from before: less than the widest line. Lines are therefore classed by size: those above half the
    limit, or beyond it, stand alone; those above a quarter fill windows of half the limit, and so on down to
    those of at most a sixteenth, which fill windows of fifteen sixteenths. A class may hold nearly all lines, so the sums
    are taken over range slices. ``order`` must be a total order; it alone decides, neither the
    number of tasks nor a retry. NULL lines are left out.
    """
    if max_records < 1 or max_bytes < 1:
        raise ValueError("a shard holds at least one line")
    sized = df.select(*order, F.col(value).alias("_v")).where("_v IS NOT NULL").withColumn("_size", F.octet_length("_v").cast("long") + 1)
    steps = [2 ** c for c in range(1, 5)]
    rank = sum((F.when(F.col("_size") * s <= max_bytes, 1).otherwise(0) for s in steps), F.lit(0))
    placed = running_by_slices(sized.withColumn("_class", rank), ["_class"], order, {"_end": ("sum", F.col("_size")), "_count": ("sum", F.lit(1).cast("long"))})
    width = F.element_at(F.lit([max(1, max_bytes - max_bytes // s) for s in steps]).cast("array<bigint>"), F.greatest(F.col("_class"), F.lit(1)))
    window = F.when(F.col("_class") == 0, F.col("_count")).otherwise(F.floor((F.col("_end") - 1) / width))
    placed = written(placed.withColumns({"_window": window, "_part": F.floor((F.col("_count") - 1) / max_records)}).drop("_size", "_end", "_count"), "shards")
    unit = ["_class", "_window", "_part"]
    numbers = row_index(placed.select(*unit).distinct(), [], unit, "shard")
    return placed.join(numbers, unit).select(F.col("shard").cast("int").alias("shard"), *order, F.col("_v").alias("value"))


def sharded_jsonl(df: DataFrame, path: str, order: Sequence[str], max_records: int, max_bytes: int, compression: str = "zstd", mode: str = "append") -> None:
    """Rows as JSON lines in ``part-00000.jsonl.zst`` and so on, each at or below both limits (bytes before compression) and in order."""
    df.sparkSession.dataSource.register(Lines)
    lines = sharded(df.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.to_json(F.struct(*df.columns)).alias("_json")),
                    [f"_o{i}" for i in range(len(order))], "_json", max_records, max_bytes)
    dealt = lines.repartition("shard").sortWithinPartitions("shard", *[f"_o{i}" for i in range(len(order))]).select("shard", "value")
    dealt.write.format(Lines.name()).option("path", path).option("compression", compression).mode(mode).save()
