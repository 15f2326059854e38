"""Group header + follower lines into records, at any file split.

A line that matches ``header_regex`` as a whole starts a record; the lines
up to the next header are its followers.  Input splits cut files at
arbitrary bytes, so a record may start in one split and end in the next one
(or several later ones).

A scan delivers the lines of a split in file order, so almost every record
is whole inside one task and needs no shuffle:

1. Spark reads the lines with their file, split start (``file_block_start``),
   whether they are headers (the regex runs in the scan's stage) and their
   byte length.
2. ``mapInArrow`` cuts each split's lines into parts at headers: the numbered
   records of the split, and before its first header at most one fragment
   (number -1).  This works on whole Arrow columns; the line lists of a batch
   are slices of its value column.
3. All but a split's edges, the fragment and the last record, are complete.
   Only edges move: a text-free pass (flags and lengths, no text) gives each
   split's number of records, a running ``last`` over the splits of a file
   names the record each fragment belongs to, and a grouping by record joins
   the edges' lines.  Fragments without an owner are dropped before that.

So no exchange carries the text of a record that lies inside a split, at the
price of reading the files again for the edges.  ``record_sizes`` and
``skipped_records`` use the text-free pass alone: no text leaves the scan.

Fragments before the first header of a file have no owner: they are
dropped (``leading='drop'``, the format's grammar) or form a record of
their own without header (``leading='keep'``).  Records longer than
``max_bytes`` (joined with ``\\n``) are skipped (F11): never gathered, in a
task or by the grouping; ``skipped_records`` lists them.  Without
``max_bytes`` a part of over ``RECORD_BYTES`` inside a split fails the job
with a message instead of exhausting the task.  ``record_pieces`` cuts such
records (and any stretch without a header) into rows of bounded size.

Every header starts exactly one record, with zero or more followers —
zero-vote cases in a row, the first case of a file, and non-case lines
after votes are all their own records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomlog.functions.scalar import record_text
from loomlog.session import ship_package

#: The longest part of a record a task gathers when no limit is given.
RECORD_BYTES = 512 * 1024 * 1024
#: Text in a row of ``record_pieces``, about.
PIECE_BYTES = 1024 * 1024

_PART = "file string, block long, seq long, piece long, last boolean, part_bytes long"


def positioned_lines(spark: SparkSession, path: str | list[str], larger_than: int | None = None) -> DataFrame:
    """Lines with the file and split (start byte) they come from; ``larger_than``:
    of files with more bytes only (the others are not opened)."""
    lines = spark.read.text(path, lineSep="\n")
    if larger_than is not None:
        lines = lines.where(F.col("_metadata.file_size") > larger_than)
    return lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def is_header(value: Column, header_regex: str) -> Column:
    """the regex has to match the whole line."""
    return value.rlike(rf"(?s)\A(?:{header_regex})\z")


# ------------------------------------------------------------ in a task

class _Cutter:
    """Cuts the lines of a task, split by split, into parts.

    ``keep``: None for sizes only, else which parts come with their lines:
    'inner' (complete inside the split), 'edges', or 'all'.  A part of more
    than ``max_bytes`` has no lines; ``piece_bytes`` begins a new part inside
    a record wherever so many bytes are full."""

    def __init__(self, keep: str | None, max_bytes: int | None, piece_bytes: int | None):
        self.keep, self.max_bytes, self.piece_bytes = keep, max_bytes, piece_bytes
        self.split: tuple | None = None                            # file and block of the open part
        self.seq, self.piece = 0, 0
        self.size = 0                                              # bytes of the open part, a line end for each line
        self.before = 0                                            # bytes of its record before it
        self.begun = 0                                             # piece in which its last line begins
        self.lines: list[pa.Array] = []

    def _starts(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per line: whether a split begins, whether a part begins; and the lines' bytes, summed up."""
        file, block = batch.column(0), np.asarray(batch.column(1))
        split = np.ones(len(block), bool)
        split[1:] = np.asarray(pc.not_equal(file.slice(1), file.slice(0, len(file) - 1))) | (block[1:] != block[:-1])
        split[0] = self.split != (file[0].as_py(), int(block[0]))
        starts = split | np.asarray(batch.column(2).cast(pa.int8())).astype(bool)
        ends = np.cumsum(np.asarray(batch.column(3)).astype(np.int64) + 1)
        if self.piece_bytes:                                       # the piece of its record in which a line begins
            base = np.concatenate([[0], ends[:-1]])
            of = np.maximum.accumulate(np.where(starts, np.arange(len(starts)), -1))
            piece = (base - np.where(of >= 0, base[of], -(self.before + self.size))) // self.piece_bytes
            starts = starts | (piece > np.concatenate([[self.begun], piece[:-1]]))
            self.begun = int(piece[-1])
        return split, starts, ends

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches of (file, block, header, size[, value]) in, parts out."""
        names = ["file", "block", "seq", "piece", "last", "part_bytes"] + ["lines"] * (self.keep is not None)
        for batch in batches:
            if not batch.num_rows:
                continue
            split, starts, ends = self._starts(batch)
            header = np.asarray(batch.column(2).cast(pa.int8())).astype(bool)
            at = np.flatnonzero(starts)
            value = batch.column(4) if self.keep else None
            first = int(at[0]) if len(at) else batch.num_rows
            earlier = self.before + self.size                      # bytes of the open record in batches before
            if first:                                              # lines of the part that is open
                self._add(int(ends[first - 1]), value.slice(0, first) if self.keep else None)
            if not len(at):
                continue
            if self.split is not None and (done := self._open(bool(split[at[0]]), names)) is not None:
                yield done
            # every part that begins here; the last one stays open
            new, head = split[at], header[at]
            index = np.arange(len(at))
            opened = np.maximum.accumulate(np.where(new, index, -1))
            more = np.cumsum(new | head) - 1                       # a piece goes on with its record's number
            seq = np.where(opened >= 0, more - more[opened] + np.where(head[opened], 0, -1), self.seq + more + 1)
            fresh = np.maximum.accumulate(np.where(new | head, index, -1))
            piece = np.where(fresh >= 0, index - fresh, index + self.piece + 1)
            begin = np.append(0, ends)[at]
            size = np.diff(np.append(begin, ends[-1]))
            file, block = batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))
            if len(at) > 1:
                lines = None
                if self.keep:
                    lines = pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), value.slice(at[0], at[-1] - at[0]))
                out = self._parts(file[:-1], block[:-1], seq[:-1], piece[:-1], new[1:], size[:-1], lines, names)
                if out is not None:
                    yield out
            record = int(begin[fresh[-1]]) if fresh[-1] >= 0 else -earlier
            self.before = int(begin[-1]) - record
            self.split = (file[-1].as_py(), block[-1].as_py())
            self.seq, self.piece, self.size, self.lines = int(seq[-1]), int(piece[-1]), 0, []
            self._add(int(size[-1]), value.slice(at[-1]) if self.keep else None)
        if self.split is not None and (done := self._open(True, names)) is not None:
            yield done

    def _add(self, size: int, lines: pa.Array | None) -> None:
        self.size += size
        if lines is None:
            return
        if self.max_bytes is not None and self.size - 1 > self.max_bytes:
            self.lines = []
            return
        if self.max_bytes is None and not self.piece_bytes and self.size > RECORD_BYTES:
            raise ValueError(f"a record of over {RECORD_BYTES} bytes: give max_bytes to skip it, or use record_pieces")
        self.lines.append(lines)

    def _open(self, last: bool, names: list[str]) -> pa.RecordBatch | None:
        """The open part, now that it has ended."""
        lines = None
        if self.keep:
            values = pa.concat_arrays(self.lines) if self.lines else pa.array([], pa.string())
            lines = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        file, block = self.split
        return self._parts(pa.array([file]), pa.array([block], pa.int64()), np.array([self.seq]), np.array([self.piece]),
                           np.array([last]), np.array([self.size]), lines, names)

    def _parts(self, file, block, seq, piece, last, size, lines, names) -> pa.RecordBatch | None:
        columns = [file, block, pa.array(seq, pa.int64()), pa.array(piece, pa.int64()), pa.array(last), pa.array(size, pa.int64())]
        if not self.keep:
            return pa.RecordBatch.from_arrays(columns, names)
        edge = last | (seq < 0)
        wanted = {"all": np.ones(len(edge), bool), "edges": edge, "inner": ~edge}[self.keep]
        if self.max_bytes is not None:                             # too long already: not gathered
            wanted = wanted & (size - 1 <= self.max_bytes)
        if not wanted.any():
            return None
        out = pa.RecordBatch.from_arrays([*columns, lines], names)
        return out if wanted.all() else out.filter(pa.array(wanted))


def _cut(lines: DataFrame, header_regex: str, keep: str | None, max_bytes: int | None = None,
         piece_bytes: int | None = None) -> DataFrame:
    ship_package(lines.sparkSession)
    flagged = lines.select("file", "block", is_header(F.col("value"), header_regex).alias("header"),
                           F.octet_length("value").alias("size"), *(["value"] if keep else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _Cutter(keep, max_bytes, piece_bytes).run(batches)

    return flagged.mapInArrow(run, _PART + (", lines array<string>" if keep else ""))


# ------------------------------------------------------------ in Spark

def _owners(lines: DataFrame, header_regex: str) -> DataFrame:
    """(file, block, own_block, own_seq): the last record begun in an earlier
    split of the file; one row per split, from a count of its headers in the scan."""
    begun = F.count_if(is_header(F.col("value"), header_regex))
    splits = lines.groupBy("file", "block").agg((begun - 1).alias("last_seq"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("last_seq") >= 0, F.struct(F.col("block"), F.col("last_seq")))
    return splits.select(F.col("file").alias("own_file"), F.col("block").alias("in_block"),
                         F.last(own, ignorenulls=True).over(earlier).alias("own"))


def _with_record(parts: DataFrame, owners: DataFrame) -> DataFrame:
    """Parts with the record (rec_block, rec_pos) they belong to; -1, -1 without one."""
    joined = parts.join(owners, (F.col("file") == F.col("own_file")) & (F.col("block") == F.col("in_block")), "left")
    inside = F.col("seq") >= 0
    none = F.lit(-1).cast("bigint")
    return joined.withColumns({
        "rec_block": F.when(inside, F.col("block")).otherwise(F.coalesce("own.block", none)),
        "rec_pos": F.when(inside, F.col("seq")).otherwise(F.coalesce("own.last_seq", none))}).drop("own_file", "in_block", "own")


def record_sizes(lines: DataFrame, header_regex: str) -> DataFrame:
    """(file, rec_block, rec_pos, n_bytes) of every record; no text leaves the scan."""
    sizes = _cut(lines, header_regex, None)
    inner = sizes.where("seq >= 0 AND NOT last").select("file", F.col("block").alias("rec_block"), F.col("seq").alias("rec_pos"),
                                                        (F.col("part_bytes") - 1).alias("n_bytes"))
    edges = _with_record(sizes.where("seq < 0 OR last"), _owners(lines, header_regex))
    return inner.unionByName(edges.groupBy("file", "rec_block", "rec_pos").agg((F.sum("part_bytes") - 1).alias("n_bytes")))


def group_lines(lines: DataFrame, header_regex: str, max_bytes: int | None = None,
                leading: str = "drop") -> DataFrame:
    """Records from positioned lines (columns file, block, value).

    Output: file, rec_block, rec_pos (split and number of the record in it;
    -1 for a header-less leading record), has_header, header, lines
    (array<string>, file order), n_bytes.
    """
    if leading not in ("drop", "keep"):
        raise ValueError("leading must be 'drop' or 'keep'")
    inner = _cut(lines, header_regex, "inner", max_bytes).select(
        "file", F.col("block").alias("rec_block"), F.col("seq").alias("rec_pos"), "lines")
    edges = _with_record(_cut(lines, header_regex, "edges", max_bytes), _owners(lines, header_regex))
    if leading == "drop":
        edges = edges.where(F.col("rec_pos") >= 0)
    if max_bytes is not None:
        all_edges = _with_record(_cut(lines, header_regex, None).where("seq < 0 OR last"), _owners(lines, header_regex))
        fits = all_edges.groupBy("file", "rec_block", "rec_pos").agg((F.sum("part_bytes") - 1).alias("n")).where(F.col("n") <= max_bytes)
        edges = edges.join(fits.drop("n"), ["file", "rec_block", "rec_pos"], "left_semi")
    joined = edges.groupBy("file", "rec_block", "rec_pos").agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", "lines"))).alias("parts"))
    extended = joined.select("file", "rec_block", "rec_pos", F.flatten(F.transform("parts", lambda p: p["lines"])).alias("lines"))
    out = inner.unionByName(extended)
    return out.select("file", "rec_block", "rec_pos", (F.col("rec_pos") >= 0).alias("has_header"),
                      F.element_at("lines", 1).alias("header"), "lines",
                      F.octet_length(F.array_join("lines", "\n")).alias("n_bytes"))


def skipped_records(lines: DataFrame, header_regex: str, max_bytes: int, leading: str = "drop") -> DataFrame:
    """the records ``group_lines`` leaves out for their size: file,
    rec_block, rec_pos, n_bytes."""
    sizes = record_sizes(lines, header_regex).where(F.col("n_bytes") > max_bytes)
    return sizes.where(F.col("rec_pos") >= 0) if leading == "drop" else sizes


def record_pieces(lines: DataFrame, header_regex: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Records of any length as rows of bounded size: file, rec_block, rec_pos
    (-1, -1 before a file's first header), block, piece, lines.

    A row holds at most ``piece_bytes`` of text and the line that goes over it.
    The rows of a record in the order of (block, piece) are its lines.  No text is
    shuffled but that of fragments whose owner's name comes by a join."""
    parts = _cut(lines, header_regex, "all", piece_bytes=piece_bytes)
    whole = parts.where("seq >= 0").withColumns({"rec_block": F.col("block"), "rec_pos": F.col("seq")})
    fragments = _with_record(parts.where("seq < 0"), _owners(lines, header_regex))
    return whole.unionByName(fragments).select("file", "rec_block", "rec_pos", "block", "piece", "lines")


def group_records(spark: SparkSession, path: str | list[str], header_regex: str,
                  max_bytes: int | None = None, leading: str = "drop") -> DataFrame:
    """Records of text file(s); see the module doc."""
    return group_lines(positioned_lines(spark, path), header_regex, max_bytes, leading)


def with_record_text(records: DataFrame) -> DataFrame:
    """Add ``record_text`` = ``header,{l1;l2;…}`` (header alone when
    the record has no followers)."""
    return records.withColumn("record_text", record_text(F.col("lines")))
