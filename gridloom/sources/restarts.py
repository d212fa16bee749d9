"""Text tables of a run's restarts as a data source: `output-NNNN/<subdir>/<quantity>..asc`.

    restarts.register(spark)
    spark.read.format("gridloom_restarts").option("subdir", "data_asc_0D").load("/runs/a")

Rows are (restart, quantity, path, line, value): one per line of text, `line` its place in bytes, which orders the
lines of a file. Filters on restart and quantity are taken over by the source, so that directories and files they
rule out are neither listed nor opened. Every file is one partition, or several of `split` bytes if it is longer.
Paths may be anything that pyarrow's file systems open (local, hdfs://, s3://, gs://).
"""

from __future__ import annotations

import fnmatch
import posixpath
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds

NAME = "gridloom_restarts"
SCHEMA = "restart int, quantity string, path string, line bigint, value string"
ENDING = "..asc"
_OUTPUT = re.compile(r"output-(\d{4})")
SPLIT = 128 << 20
#: Bytes of text that become one batch.
BATCH = 4 << 20


def register(spark: SparkSession) -> None:
    """Make the source known to a session; filters reach Python sources only where the session allows it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RestartTables)


@dataclass
class Piece(ds.InputPartition):
    """Lines of a file that start in [start, stop)."""

    restart: int
    quantity: str
    path: str
    start: int
    stop: int


class RestartTables(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "RestartReader":
        return RestartReader(dict(self.options))


_TESTS: dict[type, Callable] = {
    ds.EqualTo: lambda v, w: v == w, ds.In: lambda v, w: v in w, ds.GreaterThan: lambda v, w: v > w, ds.LessThan: lambda v, w: v < w,
    ds.GreaterThanOrEqual: lambda v, w: v >= w, ds.LessThanOrEqual: lambda v, w: v <= w, ds.StringStartsWith: lambda v, w: v.startswith(w),
    ds.StringEndsWith: lambda v, w: v.endswith(w), ds.StringContains: lambda v, w: w in v,
}


class RestartReader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.subdir = options.get("subdir", "data_asc_0D").strip("/")
        self.pattern = options.get("quantity", "*")
        self.split = int(options.get("split", SPLIT))
        self.tests: list[tuple[str, Callable]] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        """Keep what can be told from names; Spark applies the rest. `restart` and `quantity` are never null."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in ("restart", "quantity") and isinstance(f, ds.IsNotNull):
                continue
            made = self._test(f) if column in ("restart", "quantity") else None
            if made is None:
                yield f
            else:
                self.tests.append((column, made))

    @staticmethod
    def _test(f: ds.Filter) -> Callable | None:
        compare = _TESTS.get(type(f))
        value = getattr(f, "value", None)
        if compare is None or value is None or isinstance(value, tuple) and None in value:
            return None
        return lambda v: compare(v, value)

    def _passes(self, column: str, value) -> bool:
        return all(test(value) for name, test in self.tests if name == column)

    def partitions(self) -> list[Piece]:
        store, root = file_system(self.root)
        pieces = []
        for directory in sorted(store.get_file_info(fs.FileSelector(root)), key=lambda i: i.path):
            found = _OUTPUT.fullmatch(posixpath.basename(directory.path))
            if not found or not self._passes("restart", int(found.group(1))):
                continue
            inside = fs.FileSelector(posixpath.join(directory.path, self.subdir), allow_not_found=True)
            for file in sorted(store.get_file_info(inside), key=lambda i: i.path):
                base = posixpath.basename(file.path)
                quantity = base.removesuffix(ENDING)
                if file.type != fs.FileType.File or quantity == base or not fnmatch.fnmatchcase(quantity, self.pattern):
                    continue
                if self._passes("quantity", quantity):
                    for start in range(0, max(file.size, 1), self.split):
                        pieces.append(Piece(int(found.group(1)), quantity, file.path, start, min(start + self.split, file.size)))
        # Spark plans at least one partition.
        return pieces or [Piece(0, "", "", 0, 0)]

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        if not piece.path:
            return
        store, _ = file_system(self.root)
        with store.open_input_file(piece.path) as file:
            for places, lines in line_batches(file, piece.start, piece.stop):
                size = len(lines)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([piece.restart] * size, pa.int32()), pa.array([piece.quantity] * size), pa.array([piece.path] * size),
                     pa.array(places, pa.int64()), pa.array(lines, pa.string())],
                    names=["restart", "quantity", "path", "line", "value"])


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def line_batches(file, start: int, stop: int, size: int = BATCH) -> Iterator[tuple[list[int], list[str]]]:
    """(places, lines) of the lines that start in [start, stop), whole even if they end beyond it."""
    # A line belongs to the piece in which it starts: the byte before tells whether one starts right here.
    at = max(start - 1, 0)
    file.seek(at)
    held = b""
    skipping = start > 0
    while at < stop:
        block = file.read(size)
        held += block
        if skipping:
            cut = held.find(b"\n")
            if cut < 0:
                at, held = at + len(held), b""
                if not block:
                    return
                continue
            at, held, skipping = at + cut + 1, held[cut + 1:], False
        last = held.rfind(b"\n") if block else len(held)
        if last < 0:
            continue
        places, lines = [], []
        for raw in held[:last].split(b"\n") if held[:last] or block else []:
            if at >= stop:
                break
            places.append(at)
            lines.append(raw.removesuffix(b"\r").decode("utf-8", "replace"))
            at += len(raw) + 1
        held = held[last + 1:]
        if lines:
            yield places, lines
        if not block:
            return
