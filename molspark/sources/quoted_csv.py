"""Splittable reading of CSV files whose quoted cells span lines.

A file is cut into the byte ranges of Spark's text source, which end at line
ends. Whether a line end is the end of a record depends on everything before it
in the file, but only through one bit: inside a quoted cell or not. So every
range is run through the quote automaton from both states; the transitions of
a file's ranges are composed in order, which gives each range its true first
state; and the ranges are then parsed side by side. A record that crosses a
border is put together from the pieces that its ranges hand over.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.session import few_tasks

#: A line that begins outside and ends inside a quoted cell. Quotes count at the
#: start of a cell only; inside they are doubled. Every repetition is possessive,
#: so a line is read once.
_TO_OPEN = r'(?:(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]|"")*+'
#: The same for a whole line in Java's dialect.
ENDS_OPEN = rf"^{_TO_OPEN}\z"
_OPEN = re.compile(_TO_OPEN + r"\Z")
_CELL = re.compile(r'(?:[^"]|"")*+')

OUTSIDE, NEW, SAME = 0, 1, 2


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the end of a line lies in a quoted cell, if its start does or not."""
    at = 0
    if inside:
        at = _CELL.match(line).end()
        if at == len(line):
            return True
        at = line.find(",", at + 1) + 1
        if not at:
            return False
    return _OPEN.match(line, at) is not None


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, at, value): the lines with the hash of their file's path and the
    start of their range. Lines end at line feeds only."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.Array]]:
    """The stretches of a batch that belong to one range: (file, at, lines)."""
    file, at = batch["file"].to_numpy(), batch["at"].to_numpy()
    cuts = [0, *((file[1:] != file[:-1]) | (at[1:] != at[:-1])).nonzero()[0] + 1, len(file)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield int(file[a]), int(at[a]), batch["value"].slice(a, b - a)


def _quoted(lines: pa.Array) -> list[int]:
    return pc.indices_nonzero(pc.match_substring(lines, '"')).to_pylist()


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each range's last state from either first state: outside a record, in one
    that begins in the range, or still in the one that was open at its start."""
    ends: dict[tuple[int, int], list[int]] = {}
    for batch in batches:
        for file, at, lines in _ranges(batch):
            state = ends.setdefault((file, at), [OUTSIDE, SAME])
            for i in _quoted(lines):
                line = lines[i].as_py()
                for k in (0, 1):
                    if not ends_inside(line, state[k] != OUTSIDE):
                        state[k] = OUTSIDE
                    elif state[k] == OUTSIDE:
                        state[k] = NEW
    if ends:
        yield pa.record_batch([pa.array([k[0] for k in ends], pa.int64()), pa.array([k[1] for k in ends], pa.int64()),
                               pa.array([v[0] for v in ends.values()], pa.int32()),
                               pa.array([v[1] for v in ends.values()], pa.int32())],
                              ["file", "at", "outside", "inside"])


def first_states(spark: SparkSession, paths: list[str]) -> tuple[dict[tuple[int, int], int | None], set[int]]:
    """For every range (file, start) the start of the range that has the first
    line of the record open at its border, or None; and the files with a record
    that crosses a border or is never closed. The driver holds one entry a range."""
    rows = (few_tasks(_lines(spark, paths)).mapInArrow(_transitions, "file bigint, at bigint, outside int, inside int")
            .orderBy("file", "at").collect())
    firsts, torn, file, since = {}, set(), None, None
    for r in rows:
        if r["file"] != file:
            file, since = r["file"], None
        firsts[file, r["at"]] = since
        end = r["outside"] if since is None else r["inside"]
        since = None if end == OUTSIDE else r["at"] if end == NEW else since
        if since is not None:
            torn.add(file)
    return firsts, torn


def _parse(text: str, cols: list[str]) -> pa.Table:
    """Whole records as a table of strings; empty cells without quotes are null,
    records of another width are filled with nulls or cut."""
    odd: list[str] = []

    def other(row):
        odd.append(row.text)
        return "skip"

    raw = text.encode()
    types = {c: pa.string() for c in cols}
    table = pacsv.read_csv(
        pa.py_buffer(raw), pacsv.ReadOptions(column_names=cols, use_threads=False, block_size=len(raw) + 2),
        pacsv.ParseOptions(newlines_in_values=True, invalid_row_handler=other),
        pacsv.ConvertOptions(column_types=types, strings_can_be_null=True, null_values=[""], quoted_strings_can_be_null=False))
    if odd:
        rows = [(x + [""] * len(cols))[:len(cols)] for x in csv.reader(io.StringIO("\n".join(odd), newline="")) if x]
        table = pa.concat_tables([table, pa.table({c: pa.array([r[i] or None for r in rows], pa.string())
                                                   for i, c in enumerate(cols)}, schema=table.schema)])
    return table


def _batches(table: pa.Table, file: int, at: int) -> Iterator[pa.RecordBatch]:
    n = table.num_rows
    columns = [*table.columns, pa.array([file] * n, pa.int64()), pa.array([at] * n, pa.int64())]
    yield from pa.Table.from_arrays(columns, names=[*table.column_names, "file", "at"]).to_batches(max_chunksize=10_000)


class _Range:
    """The lines of one range as they come: whole records, and the pieces of
    those that cross its borders."""

    def __init__(self, file: int, at: int, first: int | None):
        self.file, self.at, self.first = file, at, first
        self.inside = self.foreign = first is not None  # in the record that an earlier range begins
        self.fresh, self.open = True, []

    def add(self, lines: pa.Array) -> tuple[list[str], list[str]]:
        """(lines of the foreign record, lines of whole records)"""
        if self.fresh and self.at == 0:
            lines = lines.slice(1)  # the header
        self.fresh = False
        start, last = 0, -1  # last: the last line that ends a record
        for i in _quoted(lines):
            if not self.inside:
                last = i - 1
            self.inside = ends_inside(lines[i].as_py(), self.inside)
            if not self.inside:
                last = i
                if self.foreign:
                    self.foreign, start = False, i + 1
        if not self.inside:
            last = len(lines) - 1
        if self.foreign:
            return lines.to_pylist(), []
        foreign = lines.slice(0, start).to_pylist()
        if last < start:
            self.open += lines.slice(start).to_pylist()
            return foreign, []
        whole = self.open + lines.slice(start, last + 1 - start).to_pylist()
        self.open = lines.slice(last + 1).to_pylist()
        return foreign, whole


def _walk(batches: Iterator[pa.RecordBatch], firsts) -> Iterator[tuple[_Range, list[str], list[str], bool]]:
    """(range, foreign lines, lines of whole records, whether the range ends)."""
    now = None
    for batch in batches:
        for file, at, lines in _ranges(batch):
            if now is None or (file, at) != (now.file, now.at):
                if now is not None:
                    yield now, [], [], True
                now = _Range(file, at, firsts[file, at])  # an unknown range is an error, not a guess
            yield now, *now.add(lines), False
    if now is not None:
        yield now, [], [], True


def _records(firsts, names: list[str]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, _, whole, _ in _walk(batches, firsts.value):
            if whole:
                yield from _batches(_parse("\n".join(whole) + "\n", names), one.file, 2 * one.at)
    return read


def _pieces(firsts, torn: set[int]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(file, start of the record's first range, at, text) of the pieces of
        records that cross a border."""
        foreign: list[str] = []
        for one, lines, _, ended in _walk(batches, firsts.value):
            if one.file not in torn:
                continue
            foreign += lines
            if not ended:
                continue
            out = [(one.first, foreign)] if foreign else []
            out += [(one.at, one.open)] if one.open else []
            foreign = []
            if out:
                yield pa.record_batch([pa.array([one.file] * len(out), pa.int64()), pa.array([o for o, _ in out], pa.int64()),
                                       pa.array([one.at] * len(out), pa.int64()), pa.array(["\n".join(x) for _, x in out])],
                                      ["file", "origin", "at", "text"])
    return read


def _joined(names: list[str]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, at, text in zip(*[batch[c].to_pylist() for c in ("file", "origin", "text")]):
                inside = False
                for line in text.split("\n"):
                    inside = ends_inside(line, inside)
                yield from _batches(_parse(text + ('"' if inside else "") + "\n", names), file, 2 * at + 1)
    return read


def read_quoted_csv(spark: SparkSession, paths: list[str], cols: list[str]) -> DataFrame:
    """The records of CSV files with a header line as strings, plus ``_file``
    (path) and ``_at`` (twice the start of the range that has the record's first
    line, and one more for the record that crosses the range's end).

    Empty cells without quotes are null, records that are too short are filled
    with nulls and too long ones cut; a quote that is never closed ends with its
    file. One file is read by as many tasks as it has ranges."""
    # Ranges depend on the number of cores, which may change between two scans.
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    firsts, torn = first_states(spark, paths)
    known = spark.sparkContext.broadcast(firsts)  # one entry a range
    names = [f"c{i}" for i in range(len(cols))]
    schema = ", ".join([*[f"{n} string" for n in names], "file bigint", "at bigint"])
    lines = few_tasks(_lines(spark, paths))
    rows = lines.mapInArrow(_records(known, names), schema)
    listed = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("f"))
    path_of = {r["h"]: r["f"] for r in listed.select("f", F.xxhash64("f").alias("h")).collect()}  # one entry a file
    if torn:
        # The very same scan: a filter by file would change its list of files, and with it the ranges.
        pieces = lines.mapInArrow(_pieces(known, torn), "file bigint, origin bigint, at bigint, text string")
        whole = pieces.groupBy("file", "origin").agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "\n").alias("text"))
        rows = rows.unionByName(whole.mapInArrow(_joined(names), schema))
    name = F.create_map(*[x for h, f in path_of.items() for x in (F.lit(h), F.lit(f))])
    return rows.select(*[F.col(n).alias(c) for n, c in zip(names, cols)], name[F.col("file")].alias("_file"),
                       F.col("at").alias("_at"))
