"""CSV feeds bound by header name, with rescue of unexpected cells.

Spark's CSV reader binds an explicit schema by *position*, even with
``header=true``: a file whose columns come in another order is silently
mis-read.  The feeds here are instead read as text lines and parsed in one
pass, all with built-in expressions:

1. the first line of every file is its header (``_metadata.file_path``,
   ``file_block_start = 0`` and the smallest row id within the split); the
   header table is joined to the lines in the same plan;
2. every other line is parsed positionally with ``from_csv`` (same quote and
   escape rules as the header) into an array of cells, as wide as the widest
   line of this input (one small aggregate);
3. each expected column takes the cell at the first position of its name in
   the file's header (a missing column gives NULL);
4. every other cell goes to ``_rescued_data`` as JSON together with the file
   path, under its header name; a repeated name gets its position appended, a
   nameless column is ``_c<position>``.  A line with more cells than the header
   is rescued whole (``_line``).  So no cell is lost, whatever the header.

By default lines are records (the reference's feeds do not set multi-line
quoting).  With ``multi_line=True`` Spark's CSV reader splits records whose
quoted values hold line breaks, and the same header binding and rescue
apply; records wider than the widest header are rescued whole; a file is one
task.  ``multi_line="split"`` reads such files in splits (``csv_split``).  The same
functions serve batch reads and streaming micro-batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.schemas import INGESTED_AT, RESCUE_COLUMN
from threadlens.sources import csv_split

CSV_OPTIONS = {"quote": '"', "escape": '"'}
# A record's text may hold line breaks, which are kept as they are.
RECORD_OPTIONS = {"multiLine": "true"}
SOURCE_FILE = "_source_file"
SOURCE_LINE = "_source_line"
SOURCE_TIME = "_source_time"
# The order of deliveries that share an ingestion time: files by age, lines by place.
DELIVERY_ORDER = [SOURCE_TIME, SOURCE_FILE, SOURCE_LINE]


def _clean_name(c: Column) -> Column:
    """Header name without surrounding blanks or a leading byte-order mark."""
    return F.trim(F.regexp_replace(c, "^\ufeff", ""))


def _cells(line: Column, width: int, options: dict) -> Column:
    schema = ", ".join(f"c{i} STRING" for i in range(width))
    parsed = F.from_csv(line, schema, options)
    return F.array(*[parsed[f"c{i}"] for i in range(width)])


def _cell_count(line: Column) -> Column:
    """Cells of a CSV record: delimiters outside quoted parts, plus one."""
    plain = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1


def lines_of(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Text lines with their file, split offset and an in-split order."""
    return spark.read.text(paths).select(*line_columns())


def line_columns() -> list[Column]:
    return [
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.monotonically_increasing_id().alias("line_no"),
    ]


def parse_by_name(lines: DataFrame, expected: list[str], options: dict | None = None,
                  max_columns: int | None = None) -> DataFrame:
    """Parse header-bearing CSV lines into ``expected`` columns (+ rescue).

    ``lines`` has (line, file_path, block_start, file_time, line_no).
    ``max_columns`` is the number of cells parsed per line; by default the
    widest line of this input.  Lines with more cells are rescued whole.
    """
    opts = {**CSV_OPTIONS, **(options or {})}
    if max_columns is None:
        max_columns = lines.agg(F.max(_cell_count(F.col("line")))).first()[0] or 1
    width = max(max_columns, len(expected))
    headers = (
        lines.filter(F.col("block_start") == 0)
        .groupBy("file_path")
        .agg(F.min(F.struct("line_no", "line")).alias("_h"))
        .select("file_path", F.col("_h.line_no").alias("_header_no"), F.col("_h.line").alias("_header"))
        .select("file_path", "_header_no", _cell_count(F.col("_header")).alias("_n_names"),
                F.transform(_cells(F.col("_header"), width, opts), _clean_name).alias("_names"))
    )
    data = lines.join(headers, "file_path").filter(
        F.col("line_no") != F.col("_header_no")
    ).filter(F.length(F.trim("line")) > 0)
    return bind_by_name(data.select("line", "file_path", "file_time", F.col("line_no").alias("_pos"), "_names", "_n_names",
                                    _cells(F.col("line"), width, opts).alias("_cells"),
                                    _cell_count(F.col("line")).alias("_n_cells")), expected)


def bind_by_name(rows: DataFrame, expected: list[str]) -> DataFrame:
    """Rows (line, file_path, file_time, _pos, _names, _n_names, _cells, _n_cells) -> expected columns + rescue.

    ``_names`` is the file's header, ``_cells`` the record's cells, both
    positional; ``_n_names`` and ``_n_cells`` are their true counts; the record
    text ``line`` is kept only for rescued rows.  The record's origin is kept
    as ``_source_time`` (age of its file), ``_source_file`` and ``_source_line``
    (its position within the file's read order), which order deliveries that
    share an ingestion time.
    """
    def cell(name: str) -> Column:
        pos = F.array_position("_names", F.lit(name))
        return F.when(pos > 0, F.element_at("_cells", pos.cast("int")))

    # positions (from 1) of the cells that no expected column takes, and their unique names
    place = F.sequence(F.lit(1), F.least(F.col("_n_names"), F.size("_names")).cast("int"))
    taken = F.array(*[F.array_position("_names", F.lit(c)).cast("int") for c in expected])
    others = F.filter(place, lambda p: ~F.array_contains(taken, p))

    def named(p: Column) -> Column:
        name = F.element_at("_names", p)
        unnamed = name.isNull() | (name == "")
        again = (F.array_position("_names", name) < p) | name.isin("_file_path", "_line")
        return (F.when(unnamed, F.concat(F.lit("_c"), p.cast("string")))
                .when(again, F.concat_ws("_", name, p.cast("string"))).otherwise(name))

    names = F.transform(others, named)
    clash = F.size(F.array_distinct(names)) < F.size(names)
    whole = (F.col("_n_cells") > F.col("_n_names")) | (F.col("_n_cells") > F.size("_cells")) | clash
    extras = F.map_from_arrays(F.concat(names, F.array(F.lit("_file_path"))),
                               F.concat(F.transform(others, lambda p: F.element_at("_cells", p)), F.array(F.col("file_path"))))
    rescue = (
        F.when(whole, F.to_json(F.struct(F.col("line").alias("_line"), F.col("file_path").alias("_file_path"))))
        .when(F.size(names) > 0, F.to_json(extras))
    )
    return rows.select(*[cell(c).alias(c) for c in expected], rescue.alias(RESCUE_COLUMN),
                       F.col("file_time").alias(SOURCE_TIME), F.col("file_path").alias(SOURCE_FILE), F.col("_pos").alias(SOURCE_LINE))


def multiline_records(reader, paths, width: int, options: dict | None = None) -> DataFrame:
    """Records of CSV files whose quoted values may hold line breaks.

    Spark's CSV reader (``multiLine``) splits the records into ``width``
    positional text cells; each file is read by one task, in order, so its
    first record is its header.  ``reader`` is ``spark.read`` or
    ``spark.readStream``.
    """
    opts = {**CSV_OPTIONS, **(options or {})}
    schema = ", ".join(f"c{i} STRING" for i in range(width)) + ", _raw STRING"
    df = (reader.schema(schema).options(**opts).option("header", False).option("multiLine", True)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_raw").csv(paths))
    cells = F.array(*[F.col(f"c{i}") for i in range(width)])
    # the reader keeps the text of every record that isn't exactly ``width`` cells wide
    return df.select(
        cells.alias("_cells"),
        F.coalesce(F.col("_raw"), F.to_csv(F.struct(*[f"c{i}" for i in range(width)]), opts)).alias("line"),
        F.coalesce(_cell_count(F.col("_raw")), F.lit(width)).alias("_n_cells"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )


def widest_header(spark: SparkSession, paths: str | list[str]) -> int:
    """Cells of the widest first line of these files (one small aggregate; 0 without files)."""
    firsts = lines_of(spark, paths).filter(F.col("block_start") == 0).groupBy("file_path").agg(F.min(F.struct("line_no", "line")).alias("h"))
    return firsts.agg(F.max(_cell_count(F.col("h.line")))).first()[0] or 0


def bind_multiline(records: DataFrame, expected: list[str]) -> DataFrame:
    """Header per file (its first record), then ``bind_by_name``."""
    numbered = records.withColumn("_row_no", F.monotonically_increasing_id())
    headers = (
        numbered.groupBy("file_path")
        .agg(F.min(F.struct("_row_no", "_cells", "_n_cells")).alias("_h"))
        .select("file_path", F.col("_h._row_no").alias("_header_no"), F.col("_h._n_cells").alias("_n_names"),
                F.transform("_h._cells", _clean_name).alias("_names"))
    )
    data = numbered.join(headers, "file_path").filter(F.col("_row_no") != F.col("_header_no"))
    return bind_by_name(data.select("line", "file_path", "file_time", F.col("_row_no").alias("_pos"), "_names", "_n_names",
                                    "_cells", "_n_cells"), expected)


def read_feed(spark: SparkSession, paths: str | list[str], expected: list[str],
              options: dict | None = None, multi_line: bool | str = False,
              max_columns: int | None = None) -> DataFrame:
    """Batch read of a CSV feed by header name, stamped with ``ingested_at``."""
    if multi_line == "split":
        rows = parse_by_name(csv_split.records(csv_split.lines_of(spark, paths)), expected, {**RECORD_OPTIONS, **(options or {})}, max_columns)
    elif multi_line:
        width = max(max_columns or widest_header(spark, paths), len(expected))
        rows = bind_multiline(multiline_records(spark.read, paths, width, options), expected)
    else:
        rows = parse_by_name(lines_of(spark, paths), expected, options, max_columns)
    return rows.withColumn(INGESTED_AT, F.current_timestamp())
