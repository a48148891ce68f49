"""#2 and #6 as Python data sources: line files that grow, and an index with exactly-once commits.

``streamlens_lines`` reads a folder of line files as a stream, also lines added to a file that was read before (Spark's
own text source takes each file once). The offset is the number of bytes taken of each file, always up to a line's
end; a line still without its end waits. A micro-batch's new bytes are cut into pieces of ``pieceBytes``, one task
each, and a piece yields the lines that begin in it.

``streamlens_index`` writes documents (``_id``, ``doc``) as JSON lines. Tasks write files that nobody sees; their names go
to the driver as commit messages, and one marker per micro-batch, put in place by a rename, makes them part of the
index. A batch that Spark replays after a crash finds its marker and leaves no second copy; files without a marker
are not part of the index.

Both reach their folder through :mod:`pyarrow.fs` (a mounted path, or a URI that it knows). Files may be
removed once read; one that becomes shorter is an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceStreamWriter, InputPartition, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

_BLOCK = 1 << 16


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _files(fs: pafs.FileSystem, base: str) -> dict[str, int]:
    """name -> bytes of the files of a folder (hidden ones left out)."""
    found = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))
    return {f.base_name: f.size for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._"}


# ---- lines ---------------------------------------------------------------------------------

@dataclass
class Piece(InputPartition):
    """Bytes [start, stop) of a file; ``whole``: a line begins at ``start``."""

    name: str
    start: int
    stop: int
    whole: bool


class LineReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.piece = int(options.get("pieceBytes", 64 << 20))
        if self.piece < 1:
            raise ValueError("pieceBytes must be at least 1")
        self.ends: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        fs, base = _open(self.path)
        out = {}
        for name, size in sorted(_files(fs, base).items()):
            if self.ends.get(name, (-1, 0))[0] != size:
                self.ends[name] = (size, self._last_end(fs, f"{base}/{name}", size))
            out[name] = self.ends[name][1]
        return out

    @staticmethod
    def _last_end(fs: pafs.FileSystem, path: str, size: int) -> int:
        """The place behind the last line end; looked for from the back."""
        with fs.open_input_file(path) as f:
            while size:
                start = max(0, size - _BLOCK)
                f.seek(start)
                at = f.read(size - start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                size = start
        return 0

    def partitions(self, start: dict, end: dict) -> Sequence[Piece]:
        out = []
        for name, stop in end.items():
            first = start.get(name, 0)
            if stop < first:
                raise ValueError(f"{name} became shorter: {first} bytes were read, {stop} are left")
            out += [Piece(name, at, min(at + self.piece, stop), at == first) for at in range(first, stop, self.piece)]
        return out

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        fs, base = _open(self.path)
        with fs.open_input_file(f"{base}/{partition.name}") as f:
            # a piece's own lines begin in it; the one that runs into it belongs to the piece before
            at = partition.start if partition.whole else partition.start - 1
            f.seek(at)
            skip, rest, lines = not partition.whole, b"", []
            while True:
                data = f.read(_BLOCK)
                if not data:
                    break
                parts = (rest + data).split(b"\n")
                rest = parts.pop()
                for line in parts:
                    begin, at = at, at + len(line) + 1
                    if skip:
                        skip = False
                    elif begin < partition.stop:
                        lines.append(line.removesuffix(b"\r").decode(errors="replace"))
                if at >= partition.stop:
                    break
                if len(lines) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
                    lines = []
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "streamlens_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema: StructType) -> LineReader:
        return LineReader(dict(self.options))


def growing_lines(spark: SparkSession, path: str, piece_bytes: int = 64 << 20) -> DataFrame:
    """#2 the lines of the files of a folder as a stream, those added to read files too."""
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format("streamlens_lines").option("path", path).option("pieceBytes", str(piece_bytes)).load()


# ---- index -------------------------------------------------------------------------------------

@dataclass
class Written(WriterCommitMessage):
    name: str | None
    rows: int


class IndexWriter(DataSourceStreamWriter):
    def __init__(self, options: dict, names: list[str]):
        self.path, self.names = options["path"], names

    def write(self, iterator) -> Written:
        fs, base = _open(self.path)
        fs.create_dir(f"{base}/data", recursive=True)
        name, out, n = f"{uuid.uuid4().hex}.json", None, 0
        for row in iterator:
            out = out or fs.open_output_stream(f"{base}/data/{name}")
            out.write(json.dumps({c: row[c] for c in self.names}).encode() + b"\n")
            n += 1
        if out is None:
            return Written(None, 0)
        out.close()
        return Written(name, n)

    def _drop(self, messages) -> None:
        fs, base = _open(self.path)
        for m in messages:
            if m is not None and m.name is not None:
                fs.delete_file(f"{base}/data/{m.name}")

    def commit(self, messages, batchId: int) -> None:
        fs, base = _open(self.path)
        fs.create_dir(f"{base}/committed", recursive=True)
        marker = f"{base}/committed/{batchId:020d}.json"
        if fs.get_file_info(marker).type != pafs.FileType.NotFound:
            self._drop(messages)  # the batch is in the index already
            return
        made = f"{base}/committed/.{uuid.uuid4().hex}"
        with fs.open_output_stream(made) as f:
            f.write(json.dumps([m.name for m in messages if m is not None and m.name is not None]).encode())
        fs.move(made, marker)

    def abort(self, messages, batchId: int) -> None:
        self._drop(messages)


class DocumentIndex(DataSource):
    @classmethod
    def name(cls) -> str:
        return "streamlens_index"

    def streamWriter(self, schema: StructType, overwrite: bool) -> IndexWriter:
        return IndexWriter(dict(self.options), schema.names)


def index_stream(docs: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """#6 start writing the documents of a stream (:func:`streamlens.sources.sinks.index_documents`) to the index."""
    docs.sparkSession.dataSource.register(DocumentIndex)
    w = docs.writeStream.format("streamlens_index").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if available_now else w).start()


def read_index(spark: SparkSession, path: str, schema: str = "_id string, doc string") -> DataFrame:
    """The committed documents of an index."""
    fs, base = _open(path)
    names: list[str] = []
    for marker in sorted(_files(fs, f"{base}/committed")):
        with fs.open_input_stream(f"{base}/committed/{marker}") as f:
            names += json.loads(f.read())
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json([f"{path}/data/{n}" for n in names])
