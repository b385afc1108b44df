"""Records of large CSV files with quoted line breaks, read by many tasks.

Spark's ``multiLine`` reader takes a file as one task, because a line break ends
a record only outside quotes.  Whether a line begins outside quotes is the parity
of all quote characters before it, and parities add up:

1. the files are read as text lines, in splits (``file_block_start``), which many tasks do.
   A task has the lines of its splits in order, so it counts along and no line is shuffled;
2. every split gives one row: its lines, the parity of its quotes, and its last line that begins
   a record if the split is entered outside quotes, and if it is entered inside;
3. a prefix over the splits of a file (one row each) gives every split the parity
   it is entered with and the record that is open there.  This small table is kept in the
   scratch folder and broadcast;
4. the splits are read again: a running parity marks the lines that begin a record, and the
   lines of a record are joined by line breaks.  Only the parts of records that reach over an end
   of their split, two a split at most, are shuffled, gathered by the line that began the record
   and kept in the scratch folder.

Quotes are doubled within quoted cells (RFC 4180, ``CSV_OPTIONS``).  A quote within an
unquoted cell counts as well, so files with such cells need ``multi_line=True``, the
reader by file.  Lines end with ``\\n`` or ``\\r\\n``.  A quote that is never closed makes the
rest of its file one record, as it does in the reader by file.  Blank records are dropped by the
binding, files without a line give none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadlens.session import work_dir

LINE_SEPARATOR = "\n"
_BLOCK = ["file_path", "block_start"]
_LINE = [*_BLOCK, "file_time", "line"]
SUMMARY = "file_path string, block_start long, lines long, odd long, last_even long, last_odd long"
PIECES = "file_path string, block_start long, file_time timestamp, line string, line_no long, pos long, whole boolean"


def _readers() -> tuple[Callable, Callable]:
    """The functions of steps 2 and 4 over a task's lines (defined here, so that they travel with the plan).

    A line's place in its file is twice the split's offset plus its place in the split: a split has at
    most one line more than bytes, so places of different splits are apart and in order.
    """
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool, np.ndarray]]:
        """Consecutive lines of one split, whether they begin it, and the parity of the quotes of each."""
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = batch.column(0), batch.column(1)
            other = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1])).to_numpy(zero_copy_only=False)
            odd = pc.count_substring(batch.column(3), '"').to_numpy(zero_copy_only=False).astype(np.int64) % 2
            cuts = [0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                split = files[a].as_py(), blocks[a].as_py()
                yield batch.slice(a, b - a), split != last, odd[a:b]
                last = split

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file_path", "block_start", "lines", "odd", "last_even", "last_odd"]
        kinds = [pa.string(), *[pa.int64()] * 5]
        row: list = []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row, kinds)], names=names)

        for lines, new, odd in runs(batches):
            if new:
                if row:
                    yield done()
                row = [lines.column(0)[0].as_py(), lines.column(1)[0].as_py(), 0, 0, None, None]
            before = (row[3] + np.cumsum(odd) - odd) % 2
            for parity in (0, 1):
                at = np.flatnonzero(before == parity)
                if len(at):
                    row[4 + parity] = 2 * row[1] + row[2] + int(at[-1])
            row[2] += len(odd)
            row[3] += int(odd.sum())
        if row:
            yield done()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file_path", "block_start", "file_time", "line", "line_no", "pos", "whole"]
        # of the current split: its constants, lines seen, parity, and the record that is not yet done
        same: list[pa.Scalar] = []
        count = parity = expected = 0
        text: list[str] = []
        first = pos = None
        own = False

        def rows(lines: pa.Array, firsts: list | np.ndarray, at: list | np.ndarray, whole: bool) -> pa.RecordBatch:
            n = len(lines)
            return pa.RecordBatch.from_arrays(
                [*[pa.repeat(v, n) for v in same], lines, pa.array(firsts, pa.int64()), pa.array(at, pa.int64()), pa.repeat(whole, n)], names=names)

        def pending(whole: bool) -> pa.RecordBatch:
            return rows(pa.array([LINE_SEPARATOR.join(text)], pa.string()), [first], [pos], whole)

        def ended() -> Iterator[pa.RecordBatch]:
            if same and count != expected:
                raise ValueError(f"{same[0]} is read in other splits than before")
            if text:
                yield pending(own and parity == 0)

        for lines, new, odd in runs(batches):
            if new:
                yield from ended()
                same = [lines.column(i)[0] for i in range(3)]
                entry, first, expected = (lines.column(i)[0].as_py() for i in (4, 5, 6))
                if entry is None:
                    raise ValueError(f"{same[0]} is read in other splits than before")
                count, parity, text, own = 0, entry, [], False
                pos = 2 * same[1].as_py()
            place = 2 * same[1].as_py() + count
            starts = np.flatnonzero((parity + np.cumsum(odd) - odd) % 2 == 0)
            line, n = lines.column(3), len(odd)
            head = int(starts[0]) if len(starts) else n
            text += line[:head].to_pylist()
            if len(starts):
                if text:
                    yield pending(own)
                ends = starts[1:]
                if len(ends):
                    inner = pa.ListArray.from_arrays(pa.array(starts - head, pa.int32()), line[head:int(ends[-1])])
                    yield rows(pc.binary_join(inner, LINE_SEPARATOR), place + starts[:-1], place + starts[:-1], True)
                begin = int(starts[-1])
                text, first, pos, own = line[begin:].to_pylist(), place + begin, place + begin, True
            count += n
            parity = int(parity + odd.sum()) % 2
        yield from ended()

    return summaries, pieces


def _kept(df: DataFrame) -> DataFrame:
    """A small table, computed once and read from the scratch folder."""
    path = work_dir(df.sparkSession, "csv_split")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_entries(blocks: DataFrame) -> DataFrame:
    """Per split: the parity it is entered with, the first line of the record open there, and its number of lines."""
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    entered = blocks.withColumn("entry", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("entry") == 0, F.col("last_even")).otherwise(F.col("last_odd"))
    return entered.withColumn("begun", begun).select(*_BLOCK, "entry", F.max("begun").over(earlier).alias("open"), "lines")


def records(lines: DataFrame) -> DataFrame:
    """Lines (line, file_path, block_start, file_time, line_no), as the files are scanned -> records of the same columns.

    ``line_no`` becomes the place of a record's first line in its file.
    """
    summaries, pieces = _readers()
    rows = lines.select(*_LINE)
    entries = _kept(split_entries(rows.mapInArrow(summaries, SUMMARY)))
    # a left join: no filter reaches the scan, whose splits would be others with fewer files
    entered = rows.join(F.broadcast(entries), _BLOCK, "left").select(*_LINE, "entry", "open", "lines")
    found = entered.mapInArrow(pieces, PIECES)
    parts = F.array_sort(F.collect_list(F.struct("pos", "line", "block_start")))
    joined = found.filter(~F.col("whole")).groupBy("file_path", "line_no").agg(F.min("file_time").alias("file_time"), parts.alias("parts")).select(
        F.array_join(F.col("parts.line"), LINE_SEPARATOR).alias("line"), "file_path",
        F.col("parts")[0]["block_start"].alias("block_start"), "file_time", "line_no")
    single = found.filter("whole").select("line", "file_path", "block_start", "file_time", "line_no")
    return single.unionByName(_kept(joined)).withColumn("line", F.regexp_replace("line", "\r$", ""))


def lines_of(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Text lines as ``csv_feed.lines_of``, ended by ``\\n`` alone, so that other breaks stay in their cells."""
    from threadlens.sources.csv_feed import line_columns

    return spark.read.option("lineSep", LINE_SEPARATOR).text(paths).select(*line_columns())
