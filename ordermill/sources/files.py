"""Raw sales files.

Every CSV column is read as text under its header name; typing is left to the cleaning operators.
Three extra columns record where a row stood, so that "first" has a meaning after any shuffle.
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions import ISO_DATE, pick_date_formats
from ordermill.functions.dates import DATE_LAYOUTS
from ordermill.operators.cleaning import validate_schema
from ordermill.schemas import NA_TOKENS
from ordermill.sources.heads import first_lines
from ordermill.sources.places import place_columns

# Ascending order of these three is input order: file by name, part of the file, row of the part.
SOURCE_ORDER = ["_file", "_block", "_row"]

Paths = str | list[str]

_BROKEN = "_broken_line"


class OpenQuoteError(ValueError):
    """A file with a quote that is never closed: what follows it cannot be told apart into records."""


def csv_options(multi_line: bool, check_header: bool = True) -> dict[str, str]:
    """Reader options: header by name, doubled quotes, optionally line breaks inside quotes.

    ``enforceSchema=false`` makes Spark compare every file's header with the schema and fail on a
    difference, instead of filling columns by position.  Column pruning is off because it hides
    lines with too many fields.
    """
    return {
        "header": "true",
        "escape": '"',
        "multiLine": str(multi_line).lower(),
        "enforceSchema": str(not check_header).lower(),
        "columnPruning": "false",
        "columnNameOfCorruptRecord": _BROKEN,
    }


def csv_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in [*columns, _BROKEN]])


def finish_csv(df: DataFrame, columns: list[str], multi_line: bool) -> DataFrame:
    """Number the rows, reject lines with too many fields and null the no-value texts.

    Lines with too few fields are filled with nulls.
    """
    one_more = ", ".join(f"c{i} string" for i in range(len(columns) + 1))
    line_options = {"escape": '"', "multiLine": str(multi_line).lower()}
    surplus = F.from_csv(F.col(_BROKEN), one_more, line_options)[f"c{len(columns)}"]
    too_long = F.col(_BROKEN).isNotNull() & surplus.isNotNull()
    # Spark refuses a scan of the broken-line column alone, hence the first column in the message.
    start = F.coalesce(F.col(f"`{columns[0]}`"), F.lit(""))
    message = F.concat(F.lit("line has more fields than the header, at "), start, F.lit(": "), F.col(_BROKEN))
    numbered = df if "_row" in df.columns else df.withColumn("_row", F.monotonically_increasing_id())
    checked = numbered.where(F.when(too_long, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return checked.select(
        *[F.when(~F.col(f"`{name}`").isin(NA_TOKENS), F.col(f"`{name}`")).alias(name) for name in columns],
        *SOURCE_ORDER,
    )


def _header(spark: SparkSession, path: Paths) -> tuple[list[str], bool]:
    """Column names of the first file, taken from its first line, and whether Spark can compare them.

    It cannot where a heading is blank, as that of a saved row index is, or occurs twice: such
    columns go by the names Spark makes up for them.
    """
    reader = spark.read.option("escape", '"')
    columns = reader.option("header", "true").csv(path).columns
    first = reader.option("header", "false").csv(path).first()
    return columns, first is not None and columns == list(first)


def list_files(spark: SparkSession, path: Paths) -> DataFrame:
    """Name, length and modification time of every file; contents are not read."""
    listed = spark.read.format("binaryFile").load(path)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def literal_path(name: str) -> str:
    """A file name safe from being taken for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", name)


def _pieces(spark: SparkSession, path: Paths, quoted_only: bool = False) -> DataFrame:
    """The text between line ends of any kind, in splits whatever the size of a file.

    ``_row`` and ``_part`` order the pieces of a block; ``odd`` is 1 where the piece holds an odd number of quotes.
    A quote in the middle of an unquoted field (``5" pipe``) has letters on both sides and does not count.
    ``quoted_only`` leaves out lines without any quote before they are looked at more closely.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", *place_columns())
    if quoted_only:
        lines = lines.where(F.contains("value", F.lit('"')))
    numbered = lines.withColumn("_row", F.monotonically_increasing_id())
    parts = F.split("value", "\r")
    cut = numbered.select("_file", "_block", "_row", F.size(parts).alias("_parts"), F.posexplode(parts).alias("_part", "text"))
    bare = F.regexp_replace("text", r'(?<=[^",])"(?=[^",])', "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    return cut.withColumn("odd", F.when(F.contains("text", F.lit('"')), quotes % 2).otherwise(0).cast("int"))


def _odd_pieces(spark: SparkSession, path: Paths) -> dict[str, int]:
    """Files that have line breaks inside quoted fields, each with its number of pieces with an odd number of quotes."""
    files = _pieces(spark, path, quoted_only=True).where("odd = 1").groupBy("_file").count()
    return {unquote(row._file): row["count"] for row in files.toLocalIterator()}


_PLACE = ["_block", "_row", "_part"]


def _open_quotes(spark: SparkSession, path: Paths, n_columns: int) -> DataFrame:
    """For each file, ``line`` (from 1) and ``place`` of the piece that most likely opens a quote never closed.

    Every block carries both states, begun outside quotes and inside.  A piece speaks for having begun outside where it
    has no quote and as many fields as the heading, or its first quote stands where a field begins; for inside where
    its first quote stands where a field ends.  With one quote too many, all states after it are the wrong ones.  So
    the piece is the one for which the evidence before it, each piece counted with its state's sign, less that after
    it, is largest; twice the evidence before it and its own differ from that by the sum over the file.
    """
    block = Window.partitionBy("_file", "_block")
    earlier_blocks = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = block.orderBy("_row", "_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    sign = lambda quotes: 1 - 2 * (F.coalesce(quotes, zero) % 2)

    pieces = _pieces(spark, path)
    lone = F.regexp_replace(F.regexp_replace("text", r'(?<=[^",])"(?=[^",])', ""), '""', "")
    fields = F.length(lone) - F.length(F.replace(lone, F.lit(","), F.lit(""))) + 1
    opens, closes = lone.rlike('^([^"]*,)?"'), lone.rlike('^[^"]*"(,|$)')
    speaks = F.when(~F.contains(lone, F.lit('"')), (fields == n_columns).cast("int"))
    speaks = speaks.when(opens & ~closes, 1).when(closes & ~opens, -1).otherwise(0)
    ended = (F.col("_part") > 0) & (F.col("_part") == F.col("_parts") - 1) & (F.col("text") == "")  # after a return
    # Texts stay where they are: only what they say is brought together by block.
    pieces = pieces.select("_file", *_PLACE, "odd", speaks.alias("speaks"), (~ended).cast("int").alias("lines"))
    pieces = pieces.withColumn("evidence", F.col("speaks") * sign(F.sum("odd").over(earlier)))

    of_block = pieces.groupBy("_file", "_block").agg(*[F.sum(c).alias(f"all_{c}") for c in ("odd", "evidence", "lines")])
    of_block = of_block.withColumn("sign", sign(F.sum("all_odd").over(earlier_blocks)))
    before = [
        F.coalesce(F.sum(F.col("sign") * F.col("all_evidence")).over(earlier_blocks), zero).alias("evidence_before"),
        F.coalesce(F.sum("all_lines").over(earlier_blocks), zero).alias("lines_before"),
    ]
    running = pieces.select(
        "_file",
        *_PLACE,
        "odd",
        (2 * F.coalesce(F.sum("evidence").over(earlier), zero) + F.col("evidence")).alias("evidence"),
        (F.coalesce(F.sum("lines").over(earlier), zero) + 1).alias("line"),
    )
    found = running.where("odd = 1").join(of_block.select("_file", "_block", "sign", *before), ["_file", "_block"])
    weight = 2 * F.col("evidence_before") + F.col("sign") * F.col("evidence")
    line = F.col("lines_before") + F.col("line")
    best = F.max_by(F.struct(line.alias("line"), F.struct(*_PLACE).alias("place")), F.struct(weight, -line))
    return found.groupBy("_file").agg(best.alias("best")).select("_file", "best.line", "best.place")


def _refuse_open_quotes(spark: SparkSession, files: list[str], n_columns: int) -> None:
    found = _open_quotes(spark, [literal_path(name) for name in files], n_columns).orderBy("_file").limit(5).collect()
    named = "; ".join(f"line {row.line} of {unquote(row._file)}" for row in found)
    raise OpenQuoteError(f"a quote is opened and never closed in {named}" + (f" (and in {len(files) - len(found)} more files)" if len(files) > len(found) else ""))


def _records(pieces: DataFrame) -> DataFrame:
    """Records (_file, _block, _row, text, heading) of files with line breaks inside quotes, put together in parallel.

    Whether a piece begins inside quotes is the parity of all quotes before it.  Each block's own parity is one
    small row; running over a file's blocks it gives the state each block begins with, and within a block the
    state runs over its pieces.  A record begins at a piece outside quotes.  What a block has before its
    first record belongs to the last record of the blocks before.
    """
    block = Window.partitionBy("_file", "_block")
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    in_order = block.orderBy("_row", "_part")
    zero = F.lit(0).cast("bigint")

    parity = pieces.groupBy("_file", "_block").agg(F.sum("odd").alias("odds"))
    opened = parity.select("_file", "_block", F.coalesce(F.sum("odds").over(before), zero).alias("_opened"))
    seen = F.coalesce(F.sum("odd").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), zero)
    begins = ((F.col("_opened") + seen) % 2 == 0).cast("int")
    blank = F.col("text").rlike("^[ \t\ufeff]*$")
    lines = pieces.join(opened, ["_file", "_block"]).withColumn("begins", begins).withColumn("blank", blank)
    lines = lines.withColumn("number", F.sum("begins").over(in_order)).drop("_opened")
    heading = F.min(F.when((F.col("begins") == 1) & ~F.col("blank"), F.col("number"))).over(block)
    lines = lines.withColumn("_heading", F.when(F.col("_block") == 0, heading))

    # The pieces of a record that lie in one block are joined where they are; only what a block has before its first
    # record, a row a block, goes to another one.
    runs = lines.groupBy("_file", "_block", "number").agg(
        F.array_sort(F.collect_list(F.struct("_row", "_part", "text"))).alias("pieces"), F.max(F.coalesce(F.col("number") == F.col("_heading"), F.lit(False))).alias("heading")
    )
    follows = lambda p: F.concat(F.when(p["_part"] == 0, "\n").otherwise("\r"), p["text"])
    joined = F.transform("pieces", lambda p, i: F.when((i == 0) & (F.col("number") > 0), p["text"]).otherwise(follows(p)))
    runs = runs.select("_file", "_block", "number", F.array_join(joined, "").alias("text"), "heading")

    ends = lines.groupBy("_file", "_block").agg(F.max("number").alias("_last"))
    holder = F.last(F.when(F.col("_last") > 0, F.struct("_block", "_last")), ignorenulls=True).over(before)
    owners = ends.select("_file", "_block", holder.alias("_owner"))
    heads = runs.where("number = 0").join(owners, ["_file", "_block"])
    tails = heads.groupBy("_file", F.col("_owner._block").alias("_of_block")).agg(
        F.max("_owner._last").alias("_of_row"), F.array_sort(F.collect_list(F.struct("_block", "text"))).alias("tail")
    )
    tails = tails.select("_file", F.col("_of_block").alias("_block"), "_of_row", F.array_join("tail.text", "").alias("tail"))
    whole = F.when(F.col("number") == F.col("_of_row"), F.concat("text", "tail")).otherwise(F.col("text"))
    records = runs.where("number > 0").join(tails, ["_file", "_block"], "left").select("_file", "_block", F.col("number").alias("_row"), whole.alias("text"), "heading")
    return records.where(~F.col("text").rlike("^[ \t\r\n\ufeff]*$"))


def _read_records(spark: SparkSession, path: Paths, columns: list[str], comparable: bool, cut: bool = False) -> DataFrame:
    """Rows of files with line breaks inside quoted fields; their headings must be ``columns``.

    ``cut`` reads each file to the line whose quote is never closed.
    """
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": _BROKEN}
    pieces = _pieces(spark, path)
    if cut:
        ends = _open_quotes(spark, path, len(columns)).select("_file", "place")
        pieces = pieces.join(F.broadcast(ends), "_file").where(F.struct(*_PLACE) < F.col("place")).drop("place")
    records = _records(pieces)
    if comparable:
        names = ", ".join(f"c{i} string" for i in range(len(columns)))
        found = F.from_csv(F.ltrim(F.col("text"), F.lit("\ufeff")), names, options)
        same = F.array(*[found[f"c{i}"] for i in range(len(columns))]) == F.array(*map(F.lit, columns))
        refused = F.raise_error(F.concat(F.lit("CSV header does not conform to that of the first file: "), F.col("_file"))).cast("boolean")
        records = records.where(F.when(F.col("heading") & ~F.coalesce(same, F.lit(False)), refused).otherwise(~F.col("heading")))
    else:
        records = records.where(~F.col("heading"))
    fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))] + [T.StructField(_BROKEN, T.StringType())])
    parsed = F.from_csv("text", ", ".join(f"`{f.name}` string" for f in fields), options)
    rows = records.withColumn("r", parsed).select(
        *[F.col(f"r.c{i}").alias(name) for i, name in enumerate(columns)], F.col(f"r.{_BROKEN}").alias(_BROKEN), *SOURCE_ORDER
    )
    return finish_csv(rows, columns, True)


def _by_line_breaks(spark: SparkSession, path: Paths, n_columns: int, on_open_quote: str) -> list[tuple[Paths, bool, bool]]:
    """Paths to read, each with whether its fields hold line breaks and whether a quote is never closed."""
    broken = _odd_pieces(spark, path)
    if not broken:
        return [(path, False, False)]
    open_ = [name for name, n in broken.items() if n % 2]
    if open_ and on_open_quote == "fail":
        _refuse_open_quotes(spark, sorted(open_), n_columns)
    names = [row.path for row in list_files(spark, path).select("path").toLocalIterator()]
    groups = []
    for breaks, unclosed in ((True, False), (True, True), (False, False)):
        some = [literal_path(name) for name in names if (name in broken, broken.get(name, 0) % 2 == 1) == (breaks, unclosed)]
        if some:
            groups.append((some, breaks, unclosed))
    return groups


def _read_csv(spark: SparkSession, path: Paths, multi_line: bool | None, on_open_quote: str) -> DataFrame:
    columns, comparable = _header(spark, path)
    if not comparable and len(_files_by_header(spark, path)) > 1:
        raise ValueError("the files have different headers; read them with mixed_headers=True")
    parts = []
    groups = [(path, False, False)] if multi_line is False else _by_line_breaks(spark, path, len(columns), on_open_quote)
    for files, breaks, unclosed in groups:
        if breaks:
            parts.append(_read_records(spark, files, columns, comparable, unclosed))
        else:
            scan = spark.read.schema(csv_schema(columns)).options(**csv_options(False, comparable)).csv(files)
            parts.append(finish_csv(scan.select("*", *place_columns()), columns, False))
    return reduce(DataFrame.unionByName, parts)


def _files_by_header(spark: SparkSession, path: Paths) -> list[list[str]]:
    """File names grouped by header line: one name per file, as in Spark's own listing of the path."""
    groups: dict[str, list[str]] = {}
    for file, header in first_lines(list_files(spark, path)).orderBy("header", "path").toLocalIterator():
        groups.setdefault(header, []).append(literal_path(file))
    return list(groups.values())


def _union(one: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of both; a column only one of them has is empty in the other, unless it is required."""
    for df in (one, other):
        validate_schema(df)
    return one.unionByName(other, allowMissingColumns=True)


def read_raw(
    spark: SparkSession,
    path: Paths,
    fmt: str = "csv",
    multi_line: bool | None = None,
    mixed_headers: bool = False,
    on_open_quote: str = "fail",
) -> DataFrame:
    """Raw rows of files or folders, with the ``SOURCE_ORDER`` columns.

    A line of blanks is no row, and a line feed, a return or both end a line outside quotes, in a file of any
    size.  Files are read in splits; one pass over the text finds those with line breaks inside quoted fields, whose records
    are put together in parallel.  ``multi_line=False`` says that there are none and saves the pass.
    ``mixed_headers=True`` admits files whose columns stand in different orders; it costs a look at
    the start of every file.  Raises ``FileNotFoundError`` for an absent path.

    A file with an odd number of quotes has one that is never closed: ``OpenQuoteError`` names its line, or with
    ``on_open_quote="stop"`` such a file is read to that line.
    """
    if on_open_quote not in ("fail", "stop"):
        raise ValueError(f"on_open_quote must be 'fail' or 'stop', not {on_open_quote!r}")
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"fmt must be 'csv' or 'parquet', not {fmt!r}")
    try:
        if fmt == "parquet":
            return spark.read.parquet(*([path] if isinstance(path, str) else path)).select(
                "*",
                F.col("_metadata.file_path").alias("_file"),
                F.lit(0).cast("bigint").alias("_block"),
                F.col("_metadata.row_index").alias("_row"),
            )
        groups = [path]
        if mixed_headers:
            groups = _files_by_header(spark, path) or groups
        return reduce(
            _union, [_read_csv(spark, files, multi_line, on_open_quote) for files in groups]
        )
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            raise FileNotFoundError(f"no source at {path}") from error
        raise


def infer_layouts(spark: SparkSession, path: Paths) -> list[str]:
    """Date layouts of a CSV source: the one that reads its first date, or all when none does.

    Looks at the first file only, and at later ones only while no date was found; one name at a time.
    """
    files, last = list_files(spark, path), ""
    while row := files.where(F.col("path") > last).agg(F.min("path").alias("path")).first():
        if row.path is None:
            break
        last = row.path
        file = literal_path(last)
        columns, comparable = _header(spark, file)
        if "order_date" not in columns:
            continue
        scan = spark.read.schema(csv_schema(columns)).options(**csv_options(True, comparable)).csv(file)
        dates = scan.where(F.col("order_date").isNotNull() & ~F.col("order_date").isin(NA_TOKENS))
        found = dates.select(pick_date_formats(F.col("order_date")).alias("layout")).first()
        if found is not None:
            return DATE_LAYOUTS if found.layout is None else [found.layout]
    return [ISO_DATE]
