"""Files that hold one JSON array each, read by several tasks.

Where an object of the array begins cannot be told from the bytes around it: a brace may stand inside a string, and a quote may
be escaped. But what a range of bytes does to the reader's state can be told without knowing that state: how it moves the
nesting depth if it begins outside a string and if it begins inside one, and whether it turns the one into the other. So large
files are read twice. The first scan gives one such summary for each range. Put together in order, these give the state at the
start of every range, and the second scan reads the objects that begin in each range, on beyond its end where need be.

A file may also hold one object, or several one after another. Elements of an array that are not objects are left out. Text
is UTF-8. Bytes are read in ranges through Arrow's file systems; packed files and file systems that Arrow cannot open go
through Spark's own reader, one task a file.
"""

import json

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from speechframe.session import ship_package

#: Bytes that a task reads at most, by default in one range. Larger files are cut into ranges; small files and small ranges share a task.
RANGE_BYTES = 64 << 20
#: Bytes looked at in one go.
BLOCK = 4 << 20
#: Bytes read in one go once only the last object's end is missing.
TAIL = 64 << 10
#: Bytes before a range that are searched for the beginning of a run of backslashes, in one go.
LOOK_BACK = 256

SUMMARY = "path string, start long, base int, turns boolean, outside long, inside long"
PACKED = (".gz", ".bz2", ".zst", ".xz", ".snappy", ".lz4", ".deflate")

_QUOTE, _BACKSLASH, _OPEN, _CLOSE = b'"\\{}'
_NESTING = np.zeros(256, dtype=np.int64)
_NESTING[list(b"{[")] = 1
_NESTING[list(b"}]")] = -1


def _open(path: str):
    system, at = fs.FileSystem.from_uri(path if "://" in path else path.replace(":/", ":///", 1))
    return system.open_input_file(at)


def _is_escaped(file, at: int) -> bool:
    """Whether an odd number of backslashes stands before the byte at ``at``."""
    run, stop = 0, at
    while stop:
        start = max(0, stop - LOOK_BACK)
        before = file.read_at(stop - start, start)
        tail = len(before) - len(before.rstrip(b"\\"))
        run, stop = run + tail, start
        if tail < len(before):
            break
    return run % 2 == 1


def structure(block: np.ndarray, escaped: bool):
    """(quotes, brackets, escaped): places of the quotes that open or close a string, of all brackets, and whether the next byte is escaped."""
    quotes, brackets = np.flatnonzero(block == _QUOTE), np.flatnonzero(_NESTING[block])
    slashes = np.flatnonzero(block == _BACKSLASH)
    if escaped:
        quotes, slashes = quotes[quotes > 0], slashes[slashes > 0]
    if not len(slashes):
        return quotes, brackets, False
    ends = np.flatnonzero(np.append(np.diff(slashes) != 1, True))
    lengths = np.diff(np.append(-1, ends))
    after = slashes[ends[lengths % 2 == 1]] + 1
    return np.setdiff1d(quotes, after, assume_unique=True), brackets, bool(len(after)) and after[-1] == len(block)


def _base(block: bytes) -> int | None:
    """The depth of a file's objects by its beginning: 1 in an array, else 0; None if there are blanks alone."""
    head = block.removeprefix(b"\xef\xbb\xbf").lstrip()
    return int(head[:1] == b"[") if head else None


def _blocks(file, start: int, end: int):
    """Successive blocks of [start, end) as (offset, bytes)."""
    while start < end:
        block = file.read_at(min(BLOCK, end - start), start)
        if not block:
            return
        yield start, block
        start += len(block)


def summarize(path: str, start: int, end: int) -> tuple:
    """What the bytes [start, end) do to the reader's state. ``base`` is the depth of the objects if only blanks come before, null if all is blank."""
    turns, moves, base = False, [0, 0], None
    with _open(path) as file:
        escaped = _is_escaped(file, start)
        for at, block in _blocks(file, start, end):
            base = _base(block) if base is None else base
            data = np.frombuffer(block, dtype=np.uint8)
            quotes, brackets, escaped = structure(data, escaped)
            steps, inside = _NESTING[data[brackets]], np.searchsorted(quotes, brackets) % 2
            moves[turns] += int(steps[inside == 0].sum())
            moves[not turns] += int(steps[inside == 1].sum())
            turns ^= len(quotes) % 2 == 1
    return path, start, base, bool(turns), moves[0], moves[1]


def put_together(summaries: list[tuple], end: dict) -> list[tuple]:
    """(path, start, end, in_string, depth, base) of each range, from the summaries of all ranges of all files."""
    pieces, by_file = [], {}
    for path, start, base, turns, outside, inside in summaries:
        by_file.setdefault(path, []).append((start, base, turns, outside, inside))
    for path, own in by_file.items():
        own.sort()
        in_string, depth, base = False, 0, next((b for _, b, *_ in own if b is not None), 0)
        for start, _, turns, outside, inside in own:
            pieces.append((path, start, end[path, start], in_string, depth, base))
            depth += inside if in_string else outside
            in_string ^= turns
    return pieces


def objects(path: str, start: int, end: int, in_string: bool, depth: int, base: int | None):
    """Lists of the objects that begin in [start, end), as text. ``base`` None is found at the beginning of the file."""
    with _open(path) as file:
        size, at, pending = file.size(), start, None
        escaped = _is_escaped(file, start)
        while at < size and (at < end or pending is not None):
            block = file.read_at(min(BLOCK, end - at) if at < end else TAIL, at)
            base = _base(block) if base is None else base
            data = np.frombuffer(block, dtype=np.uint8)
            quotes, brackets, escaped = structure(data, escaped)
            brackets = brackets[(np.searchsorted(quotes, brackets) + in_string) % 2 == 0]
            steps = _NESTING[data[brackets]]
            depths = depth + np.cumsum(steps)
            opened = brackets[(data[brackets] == _OPEN) & (depths - steps == base)]
            closed = brackets[(data[brackets] == _CLOSE) & (depths == base)]
            opened = opened[opened + at < end]
            found = []
            if pending is not None:
                if len(closed):
                    found.append(b"".join([*pending, block[: closed[0] + 1]]))
                    pending = None
                else:
                    pending.append(block)
            last = np.searchsorted(closed, opened)
            for first, stop in zip(opened.tolist(), last.tolist()):
                if stop < len(closed):
                    found.append(block[first : closed[stop] + 1])
                else:
                    pending = [block[first:]]
            yield [f.decode("utf-8", "replace") for f in found]
            depth, in_string, at = int(depths[-1]) if len(depths) else depth, bool(in_string ^ (len(quotes) % 2 == 1)), at + len(block)


class Pieces(InputPartition):
    """The ranges that one task reads, by file."""

    def __init__(self, pieces: list):
        self.pieces = pieces


class RangeReader(DataSourceReader):
    def __init__(self, tasks: list, summaries: bool):
        self.tasks, self.summaries = tasks, summaries

    def __getstate__(self):
        # a task is sent its own ranges only
        return {"tasks": [], "summaries": self.summaries}

    def partitions(self):
        return [Pieces(t) for t in self.tasks]

    def read(self, partition: Pieces):
        for path, ranges in partition.pieces:
            for piece in ranges:
                if self.summaries:
                    yield summarize(path, *piece)
                    continue
                for found in objects(path, *piece):
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["value"])


class JsonArraySource(DataSource):
    """``json_array``: the objects of JSON array files as text, or with the option ``summaries`` a summary of each range.

    The option ``tasks`` is the JSON list of tasks, each a list of files with their ranges.
    """

    @classmethod
    def name(cls):
        return "json_array"

    def schema(self):
        return SUMMARY if "summaries" in self.options else "value string"

    def reader(self, schema):
        return RangeReader(json.loads(self.options["tasks"]), "summaries" in self.options)


def _packed(pieces: list, task_bytes: int) -> list:
    """Ranges dealt out to tasks of about ``task_bytes`` each, in order: lists of (path, its ranges)."""
    tasks, size = [], task_bytes
    for path, start, end, *state in pieces:
        if size + end - start > task_bytes:
            tasks.append([])
            size = 0
        if not tasks[-1] or tasks[-1][-1][0] != path:
            tasks[-1].append((path, []))
        tasks[-1][-1][1].append((start, end, *state))
        size += end - start
    return tasks


def _readable(path: str) -> bool:
    try:
        with _open(path):
            return not path.endswith(PACKED)
    except (OSError, ValueError, pa.ArrowException):
        return False


def read_objects(spark: SparkSession, files: list[tuple[str, int]], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``value``: the text of every object of the array ``files``, given with their sizes."""
    ship_package(spark)
    spark.dataSource.register(JsonArraySource)
    source = spark.read.format("json_array")
    # a task reads many small ranges, as long as every core has some
    task_bytes = max(range_bytes, min(RANGE_BYTES, sum(size for _, size in files) // (2 * spark.sparkContext.defaultParallelism)))
    small = [(path, 0, size, False, 0, None) for path, size in files if size <= range_bytes]
    cut = [(path, at, min(size, at + range_bytes)) for path, size in files if size > range_bytes for at in range(0, size, range_bytes)]
    if cut:
        # one row for each range of ``range_bytes``
        rows = source.option("summaries", "true").option("tasks", json.dumps(_packed(cut, task_bytes))).load().collect()
        cut = put_together([tuple(r) for r in rows], {(path, start): end for path, start, end in cut})
    return spark.read.format("json_array").option("tasks", json.dumps(_packed(small + cut, task_bytes))).load()


def read_arrays(spark: SparkSession, path: str, schema: T.StructType, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of all array files that ``path`` names."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path).select("path", "length")
    files = sorted((r.path, r.length) for r in listed.collect())  # names and sizes, which any scan plans with
    plain = [p for p, _ in files if not _readable(p)]
    cut = [f for f in files if f[0] not in set(plain)]
    parts = []
    if cut:
        parts.append(read_objects(spark, cut, range_bytes).select(F.from_json("value", schema).alias("r")).select("r.*"))
    if plain or not parts:
        parts.append(spark.read.schema(schema).option("multiLine", True).json(plain) if plain else spark.createDataFrame([], schema))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
