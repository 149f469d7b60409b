"""Capture folders as Spark data sources: a reader by file and byte range, a stream that resumes inside files, and a sink that commits batches.

"captures" reads text files below a folder, a line a row or a file a row. A row says its file, the key that the file's path names, and the byte
at which it begins: file order, which decides what is latest in an append-only log, whatever dates say. Files are pruned by key before they are
opened, and a large log is read in ranges by several tasks. As a stream its offset is the end of the last whole line of each file, so that a
restart goes on where the last batch ended, inside files too; files that shrink fail the stream, as logs are only appended to.

"committed_captures" writes in two phases: tasks write files that nothing refers to, and the driver names them in one commit file a batch. A batch
that was committed is not written again, whoever repeats it; files of failed tasks are never read.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from veriloom.session import ship

SCHEMA = "key string, path string, at long, text string"
#: Bytes of a file that one task reads; rows that a batch holds are of so many bytes.
RANGE, BATCH = 64 << 20, 4 << 20
#: Tasks that a read is dealt to, at most, unless they would have more than RANGE bytes each.
TASKS = 64
TAIL = 1 << 16


def register(spark: SparkSession) -> None:
    """Make both formats known to a session, and let filters reach the reader (a session setting that Spark has off)."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CaptureSource)
    spark.dataSource.register(CommittedSink)


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """A file system and the path in it: of a URI, or of a local path."""
    return pafs.FileSystem.from_uri(uri) if re.match(r"^[a-z0-9]+:/", uri) else (pafs.LocalFileSystem(), uri)


@dataclass
class Range(InputPartition):
    """Rows that begin in [low, high) of a file."""

    path: str
    key: str
    low: int
    high: int


@dataclass
class Share(InputPartition):
    """What one task reads: ranges that follow one another, those that adjoin as one."""

    ranges: list[Range]

    @property
    def key(self) -> str:
        """The key of its first range."""
        return self.ranges[0].key


def shares(ranges: list[Range]) -> list[Share]:
    """Ranges dealt to tasks in order, by bytes: small ranges don't make many tasks, large ones aren't put together."""
    step = max(-(-sum(r.high - r.low for r in ranges) // TASKS), 1)
    out: list[Share] = []
    held = most = 0
    for r in ranges:
        size = r.high - r.low
        if not out or held + size > most:
            out.append(Share([r]))
            held, most = size, max(min(step, RANGE), size)
            continue
        mine, last = out[-1].ranges, out[-1].ranges[-1]
        held += size
        if last.path == r.path and last.high == r.low and size:
            mine[-1] = Range(r.path, r.key, last.low, r.high)
        else:
            mine.append(r)
    return out


class Folder:
    """The files of a source: options path, glob (of file names), key (a pattern whose first group is a path's key), whole (a file a row), range."""

    def __init__(self, options: dict):
        self.uri = options["path"]
        self.glob = re.compile(re.escape(options.get("glob", "*")).replace(r"\*", "[^/]*").replace(r"\?", "[^/]") + r"\Z")
        self.key = re.compile(options.get("key", r"([^/]+)/[^/]+\Z"))
        self.whole = str(options.get("whole", "false")).lower() == "true"
        self.range = int(options.get("range", RANGE))

    def files(self, keys: set[str] | None = None) -> list[tuple[str, str, int]]:
        """(path, key, size), by path."""
        fs, root = _open(self.uri)
        out = []
        for f in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
            m = self.key.search(f.path)
            if f.is_file and m and self.glob.match(f.base_name) and not re.search(r"/[._][^/]*\Z", f.path) and (keys is None or m[1] in keys):
                out.append((f.path, m[1], f.size))
        return sorted(out)

    def ranges(self, path: str, key: str, low: int, high: int) -> Iterator[Range]:
        step = max(1, high - low) if self.whole else self.range
        for at in range(low, high, step):
            yield Range(path, key, at, min(at + step, high))
        if self.whole and high == low:
            yield Range(path, key, low, high)

    def read(self, part: Range, end: int | None = None) -> Iterator[pa.RecordBatch]:
        """The rows of a range. A line is of the range in which it begins; the last line of a file needs no end."""
        fs, _ = _open(self.uri)
        with fs.open_input_file(part.path) as f:
            if self.whole:
                yield self._batch(part, [0], [f.read()])
                return
            at, size = part.low, f.size() if end is None else end
            if at:  # the line that the byte before belongs to is another range's
                f.seek(at - 1)
                at = at - 1 + self._line_end(f)
                f.seek(at)
            places, lines, rest, held = [], [], b"", 0
            while at < part.high:
                piece = f.read(min(1 << 20, size - at - len(rest)))
                last = not piece
                rest += piece
                parts = rest.split(b"\n")
                rest = b"" if last else parts.pop()
                for line in parts:
                    if at >= part.high or (last and not line):
                        break
                    places.append(at)
                    lines.append(line)
                    at += len(line) + 1
                    held += len(line) + 64
                if held > BATCH:
                    yield self._batch(part, places, lines)
                    places, lines, held = [], [], 0
                if last:
                    break
            if places:
                yield self._batch(part, places, lines)

    @staticmethod
    def _line_end(f) -> int:
        """How many bytes from here to the begin of the next line, or to the end."""
        n = 0
        while piece := f.read(1 << 16):
            k = piece.find(b"\n")
            if k >= 0:
                return n + k + 1
            n += len(piece)
        return n

    @staticmethod
    def _batch(part: Range, places: list[int], texts: list[bytes]) -> pa.RecordBatch:
        said = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
        return pa.RecordBatch.from_arrays([pa.array([part.key] * len(said)), pa.array([part.path] * len(said)), pa.array(places, pa.int64()), said], names=["key", "path", "at", "text"])


class CaptureReader(DataSourceReader):
    def __init__(self, folder: Folder):
        self.folder, self.keys = folder, None

    def pushFilters(self, filters: list[Filter]):
        """Equality and membership of the key are taken here, so that other files aren't opened."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("key",):
                mine = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.keys = mine if self.keys is None else self.keys & mine
            else:
                yield f

    def partitions(self):
        return shares([r for path, key, size in self.folder.files(self.keys) for r in self.folder.ranges(path, key, 0, size)])

    def read(self, part: Share):
        for r in part.ranges:
            yield from self.folder.read(r)


class CaptureStream(DataSourceStreamReader):
    """Offset: path -> the byte after the last whole line that was read (whole=true: the file's size). An entry a file."""

    def __init__(self, folder: Folder):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {path: self._whole_lines(path, size) for path, _, size in self.folder.files()}

    def _whole_lines(self, path: str, size: int) -> int:
        """The byte after the file's last line end: a line that is being written waits for the next batch."""
        if self.folder.whole:
            return size
        fs, _ = _open(self.folder.uri)
        with fs.open_input_file(path) as f:
            high = size
            while high > 0:
                low = max(0, high - TAIL)
                f.seek(low)
                k = f.read(high - low).rfind(b"\n")
                if k >= 0:
                    return low + k + 1
                high = low
        return 0

    def partitions(self, start: dict, end: dict):
        out = []
        keys = {path: key for path, key, _ in self.folder.files()}
        for path, high in sorted(end.items()):
            low = start.get(path, 0)
            if high < low or (self.folder.whole and path in start and high != low):
                raise ValueError(f"{path} is not what it was: {low} bytes were read of it, it has {high}")
            if high > low or (self.folder.whole and path not in start):
                out += self.folder.ranges(path, keys.get(path, self.folder.key.search(path)[1]), low, high)
        return shares(out)

    def read(self, part: Share):
        for r in part.ranges:
            yield from self.folder.read(r)

    def commit(self, end: dict) -> None:
        """Nothing to give back: files stay."""


class CaptureSource(DataSource):
    """Format "captures"; options as Folder's."""

    @classmethod
    def name(cls) -> str:
        return "captures"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return CaptureReader(Folder(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return CaptureStream(Folder(self.options))


def captures(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(key, path, at, text) of the lines, or whole files, below a folder. In file order by (path, at)."""
    register(spark)
    return spark.read.format("captures").options(path=path, **options).load()


def captures_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same as a stream, of lines as they are appended or files as they appear."""
    register(spark)
    return spark.readStream.format("captures").options(path=path, **options).load()


# ---- the committing sink


@dataclass
class Written(WriterCommitMessage):
    """A task's file."""

    file: str | None
    rows: int


class Store:
    """data/: files of rows. commits/: one file a batch, which names that batch's files; it appears whole or not at all."""

    def __init__(self, uri: str, schema: pa.Schema):
        self.uri, self.schema = uri.rstrip("/"), schema

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _open(self.uri)
        fs.create_dir(f"{root}/data", recursive=True)
        file, rows, writer = f"{uuid.uuid4().hex}.parquet", 0, None
        for b in iterator:
            if b.num_rows:
                writer = writer or pq.ParquetWriter(f"{root}/data/{file}", b.schema, filesystem=fs)
                writer.write_batch(b)
                rows += b.num_rows
        if writer is None:
            return Written(None, 0)
        writer.close()
        return Written(file, rows)

    def commit(self, messages: list[Written | None], batch: str) -> bool:
        """Whether the batch is new; if it isn't, the files that were written for it again are deleted."""
        fs, root = _open(self.uri)
        name = f"{root}/commits/{batch}.json"
        fs.create_dir(f"{root}/commits", recursive=True)
        if fs.get_file_info(name).type != pafs.FileType.NotFound:
            self.discard(messages)
            return False
        made = [{"file": m.file, "rows": m.rows} for m in messages if m and m.file]
        draft = f"{root}/commits/.{batch}-{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as f:
            f.write(json.dumps({"batch": batch, "files": made}).encode())
        fs.move(draft, name)
        return True

    def discard(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.uri)
        for m in messages:
            if m and m.file:
                fs.delete_file(f"{root}/data/{m.file}")

    @staticmethod
    def files(uri: str) -> list[str]:
        """Paths of the files that commits name."""
        fs, root = _open(uri.rstrip("/"))
        if fs.get_file_info(f"{root}/commits").type == pafs.FileType.NotFound:
            return []
        out = []
        for f in sorted(fs.get_file_info(pafs.FileSelector(f"{root}/commits")), key=lambda f: f.path):
            if f.is_file and f.base_name.endswith(".json") and not f.base_name.startswith("."):
                with fs.open_input_stream(f.path) as s:
                    out += [f"{uri.rstrip('/')}/data/{x['file']}" for x in json.loads(s.read())["files"]]
        return out


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, store: Store, batch: str):
        self.store, self.batch = store, batch

    def write(self, iterator):
        return self.store.write(iterator)

    def commit(self, messages):
        self.store.commit(messages, self.batch)

    def abort(self, messages):
        self.store.discard(messages)


class StreamWriter(DataSourceStreamArrowWriter):
    """A stream's batch ids name its commits, after the stream's own name, so that several streams may share a store."""

    def __init__(self, store: Store, name: str):
        self.store, self.name = store, name

    def write(self, iterator):
        return self.store.write(iterator)

    def commit(self, messages, batchId: int) -> None:
        self.store.commit(messages, f"{self.name}-{batchId:012d}")

    def abort(self, messages, batchId: int) -> None:
        self.store.discard(messages)


class CommittedSink(DataSource):
    """Format "committed_captures"; options path, and batch (of a batch write) or stream (of a stream; default stream)."""

    @classmethod
    def name(cls) -> str:
        return "committed_captures"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("committed batches aren't overwritten")
        if not re.fullmatch(r"[A-Za-z0-9_-]+", self.options.get("batch", "")):
            raise ValueError("a batch write needs the option batch, of letters, digits, _ and -")
        return BatchWriter(Store(self.options["path"], schema), self.options["batch"])

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return StreamWriter(Store(self.options["path"], schema), self.options.get("stream", "stream"))


def commit_rows(rows: DataFrame, path: str, batch: str) -> None:
    """Write rows as a batch, unless a batch of that name was committed."""
    register(rows.sparkSession)
    rows.write.format("committed_captures").mode("append").options(path=path, batch=batch).save()


def committed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all committed batches."""
    files = Store.files(path)
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
