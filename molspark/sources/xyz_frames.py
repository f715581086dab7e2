"""XYZ files of many frames (S5-S9), read in byte ranges.

A file is cut into the ranges of Spark's text source. Whether a line of digits
is a frame's count line or its comment depends on the lines before it, but only
through one bit: was the line just before a count line? Every range is run from
both states; the transitions of a file's ranges are composed in order, which
gives each range its first state and the number of the frame open at its
border. Frames are then cut side by side, and one that crosses a border is put
together from the pieces that its ranges hand over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.functions.text import strip as strip_text
from molspark.session import few_tasks
from molspark.sources.xyz import parse_xyz

_SCHEMA = "file bigint, frame bigint, at bigint, stem string, text string"


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, at, stem, value): the lines with the hash of their file's path and
    the start of their range. The stem stands at lines of digits only, which are
    count lines unless they are the comment of one."""
    digits = F.col("value").rlike(r"^[ \t]*+[0-9]++[ \t\r]*+\z")
    # File names come percent-encoded; a plus sign is itself there.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.when(digits, stem).alias("stem"), "value")


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The stretches of a batch that belong to one range: ((file, at), rows)."""
    file, at = batch["file"].to_numpy(), batch["at"].to_numpy()
    cuts = [0, *((file[1:] != file[:-1]) | (at[1:] != at[:-1])).nonzero()[0] + 1, len(file)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield (int(file[a]), int(at[a])), batch.slice(a, b - a)


def count_lines(digits: list[int], lines: int, after_count: bool) -> tuple[list[int], bool]:
    """Which of the lines of digits are count lines: those that do not come
    right after one. ``after_count``: the state before the first line; returned
    is that after the last."""
    found, last = [], -1 if after_count else -2
    for i in digits:
        if i - 1 != last:
            found.append(i)
            last = i
    return found, last == lines - 1


def _digits(rows: pa.RecordBatch) -> list[int]:
    return pc.indices_nonzero(pc.is_valid(rows["stem"])).to_pylist()


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each range's number of count lines and last state, from either first state."""
    ends: dict[tuple[int, int], list[list]] = {}
    for batch in batches:
        for key, rows in _ranges(batch):
            digits = _digits(rows)
            for state in ends.setdefault(key, [[0, False], [0, True]]):
                found, state[1] = count_lines(digits, rows.num_rows, state[1])
                state[0] += len(found)
    if ends:
        yield pa.record_batch(
            [pa.array([k[i] for k in ends], pa.int64()) for i in (0, 1)]
            + [pa.array([v[s][0] for v in ends.values()], pa.int64()) for s in (0, 1)]
            + [pa.array([v[s][1] for v in ends.values()], pa.bool_()) for s in (0, 1)],
            ["file", "at", "n_outside", "n_after", "outside", "after"])


def first_states(spark: SparkSession, paths: str | list[str]) -> dict[tuple[int, int], tuple[int, bool]]:
    """For every range but the first of its file: the number of frames that begin
    before it, and whether the line before it is a count line. One entry a range."""
    rows = (few_tasks(_lines(spark, paths).drop("value"))
            .mapInArrow(_transitions, "file bigint, at bigint, n_outside bigint, n_after bigint, outside boolean, after boolean")
            .orderBy("file", "at").collect())
    states, file, frames, after = {}, None, 0, False
    for r in rows:
        if r["file"] != file:
            file, frames, after = r["file"], 0, False
        if r["at"]:
            states[file, r["at"]] = (frames, after)
        frames += r["n_after"] if after else r["n_outside"]
        after = r["after"] if after else r["outside"]
    return states


class _Open:
    """The frame that a range has open: its lines so far, in chunks."""

    def __init__(self, key: tuple[int, int], frame: int, after: bool):
        self.key, self.frame, self.after = key, frame, after
        self.stem: str | None = None
        self.chunks: list[pa.Array] = []
        self.foreign = True  # its count line, if any, lies in an earlier range

    def text(self) -> str:
        return "\n".join(x for c in self.chunks for x in c.to_pylist())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                           ["file", "frame", "at", "stem", "text"])


def _cut(states, torn: bool):
    """Frames that lie within one range, or with ``torn`` the pieces that stand
    at the borders: before a range's first count line and from its last on."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Open | None = None

        def piece() -> list[tuple]:
            return [(now.key[0], now.frame, now.key[1], now.stem, now.text())] if now and now.chunks else []

        for batch in batches:
            for key, rows in _ranges(batch):
                if now is None or key != now.key:
                    if torn and (out := piece()):
                        yield _batch(out)
                    # An unknown range is an error, not a guess.
                    before, after = (0, False) if key[1] == 0 else states.value[key]
                    now = _Open(key, before - 1, after)
                lines = rows["value"]
                found, now.after = count_lines(_digits(rows), len(lines), now.after)
                if not found:
                    now.chunks.append(lines)
                    continue
                if found[0]:
                    now.chunks.append(lines.slice(0, found[0]))
                if now.chunks and now.foreign == torn:
                    yield _batch(piece())
                if not torn and len(found) > 1:
                    stops = pa.array(found, pa.int32())
                    whole = pa.ListArray.from_arrays(stops, lines.slice(0, found[-1]))
                    n = len(found) - 1
                    yield pa.record_batch(
                        [pa.array([key[0]] * n, pa.int64()), pa.array(now.frame + 1 + np.arange(n)),
                         pa.array([key[1]] * n, pa.int64()), rows["stem"].take(pc.cast(stops[:-1], pa.int64())),
                         pc.binary_join(whole, "\n")], ["file", "frame", "at", "stem", "text"])
                now.frame += len(found)
                now.stem, now.foreign = rows["stem"][found[-1]].as_py(), False
                now.chunks = [lines.slice(found[-1])]
        if torn and (out := piece()):
            yield _batch(out)
    return read


def read_frames(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(stem, frame, text): every frame of the files, from its count line to the
    line before the next one. Lines before a file's first count line are frame
    -1 without a stem. One file is read by as many tasks as it has ranges."""
    # Ranges depend on the number of cores, which may change between two scans.
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    states = spark.sparkContext.broadcast(first_states(spark, paths))  # one entry a border
    lines = few_tasks(_lines(spark, paths))
    whole = lines.mapInArrow(_cut(states, False), _SCHEMA)
    pieces = F.array_sort(F.collect_list(F.struct("at", "text")))
    joined = (lines.mapInArrow(_cut(states, True), _SCHEMA).groupBy("file", "frame")
              .agg(F.min("stem").alias("stem"), F.array_join(F.transform(pieces, lambda x: x["text"]), "\n").alias("text")))
    return whole.select("stem", "frame", "text").union(joined.select("stem", "frame", "text"))


def read_xyz_frames(spark: SparkSession, paths: str | list[str], mode: str = "annotated", charge_col_idx: int | None = None,
                    id_from: str = "file") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(molecules, atoms, failures) of XYZ files, folders or patterns whose files
    hold any number of frames; ``mode`` and ``charge_col_idx`` as in ``parse_xyz``.

    ``id_from``: ``file`` names frame 0 by the file's stem and frame k
    ``<stem>#<k>``; ``comment`` takes the comment's unique_id or a content hash.
    Blank lines count nowhere but as a comment. A frame with more or fewer atom
    lines than it announces, with a malformed one, or lines without any count
    line are failures; the frames around them are read."""
    if id_from not in ("file", "comment"):
        raise ValueError(f"unknown id_from {id_from!r}")
    frames = read_frames(spark, paths)
    lines = F.split("text", "\n")
    atoms_in = F.size(F.filter(F.slice(lines, 3, F.greatest(F.size(lines) - 2, F.lit(0))), lambda x: strip_text(x) != ""))
    announced = strip_text(F.element_at(lines, 1))
    name = F.when(F.col("frame") > 0, F.concat("stem", F.lit("#"), F.col("frame").cast("string"))).otherwise(F.col("stem"))
    told = frames.where((F.col("frame") >= 0) | (strip_text(F.col("text")) != "")).select(
        name.alias("_name"), "text", "frame", atoms_in.alias("_lines"), announced.alias("_announced"))
    right = (F.col("frame") >= 0) & F.col("_announced").try_cast("long").eqNullSafe(F.col("_lines").cast("long"))
    molecules, atoms, failures = parse_xyz(told.where(right).select("_name", "text"), "text", mode=mode, charge_col_idx=charge_col_idx,
                                           id_col="_name" if id_from == "file" else None)
    reason = F.when(F.col("frame") < 0, F.lit("lines without a count line")).otherwise(
        F.format_string("%d atom lines, %s announced", F.col("_lines"), F.col("_announced")))
    wrong = told.where(~right).select(F.lit("parse_xyz").alias("stage"), F.col("_name").alias("unique_id"),
                                      F.lit(None).cast("string").alias("smiles"), reason.alias("reason"))
    return molecules.drop("_name"), atoms, failures.unionByName(wrong)
