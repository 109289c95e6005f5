"""File sources: CSV whose columns drift, JSON Lines, the audit log, file listings."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnlake import schemas
from tarnlake.operators.upkeep import head_sample
from tarnlake.session import stage

AUDIT_LOG = (
    "user_identity struct<arn: string>, event_time timestamp, event_name string, workgroup string, "
    "request_parameters struct<query: string, bucketName: string, `key`: string>, "
    "additional_event_data string"
)

# A quoted cell; a backslash, as Spark writes, or a second quote escapes a quote in it.
QUOTED = r'"[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+"'


class ByHeader(NamedTuple):
    """Rows mapped by header, and ``file, value, reason`` of the lines that do not fit theirs."""

    rows: DataFrame
    rejected: DataFrame


def text_lines(reader, path: str | list[str]) -> DataFrame:
    """``value, file, block`` of every line below ``path``; ``reader`` is ``spark.read`` or ``spark.readStream``."""
    return reader.option("recursiveFileLookup", "true").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _cells(line: Column) -> Column:
    """The cells of a line, quotes still on."""
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",({QUOTED}|[^,]*)"), F.lit(1))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ","))


def _value(cell: Column) -> Column:
    """A cell without its quotes; NULL if nothing is left."""
    inner = F.regexp_replace(cell.substr(F.lit(2), F.length(cell) - 2), r'\\(")|"(")', "$1$2")
    return F.nullif(F.when(cell.startswith('"'), inner).otherwise(cell), F.lit(""))


def _name(cell: Column) -> Column:
    """A header cell as a column name: lower case, no padding or byte-order mark."""
    return F.lower(F.btrim(cell, F.lit(' "\t\r\ufeff')))


def read_headers(lines: DataFrame, key_col: str | None = None) -> DataFrame:
    """Stored ``file, header, names``: the first line of each file that is not blank, and its cells.

    A header without ``key_col``, or with a name twice, is an error that names the file.
    """
    first = (
        lines.where((F.col("block") == 0) & (F.btrim("value") != ""))
        .select("file", "value", F.monotonically_increasing_id().alias("seq"))
        .groupBy("file").agg(F.min_by("value", "seq").alias("header")))
    first = first.withColumn("names", F.transform(_cells(F.col("header")), _name))
    named = F.filter("names", lambda name: name != "")
    fault = F.when(F.size(F.array_distinct(named)) < F.size(named), "a name twice")
    if key_col is not None:
        fault = F.when(~F.array_contains("names", key_col), f"no column {key_col}").otherwise(fault)
    names = F.when(
        fault.isNotNull(), F.raise_error(F.concat(F.lit("header with "), fault, F.lit(": "), "file"))
    ).otherwise(F.col("names"))
    return stage(first.select("file", "header", names.alias("names")), "csv-headers")


def marked_by_header(lines: DataFrame, headers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Map each file's cells to ``columns`` by the names in that file's header.

    A line that does not fit has only ``__file``, ``__line`` and ``__reason``.

    A column a file lacks is NULL; a line that repeats the header word for word is
    none.  Lines with more or fewer cells than their header, or an open quote, are
    rejected, so a quoted line break shows up there.  If all files share one header
    nothing is joined; else headers, one row a file, are, and AQE picks how and
    splits a file that holds much of the lines.
    """
    # Metadata: whether all headers are one.
    shape = headers.agg(
        F.min("header").alias("low"), F.max("header").alias("high"), F.any_value("names").alias("names")).first()
    body = lines.where(F.btrim("value") != "").select("file", "value")
    alone = shape["low"] is not None and shape["low"] == shape["high"]
    if alone:
        body = body.withColumns({"header": F.lit(shape["high"]), "names": F.lit(shape["names"])})
    else:
        body = body.join(headers, "file", "left")
    body = body.where(F.col("header").isNull() | (F.col("value") != F.col("header")))
    body = body.withColumn("cells", _cells(F.col("value")))
    quoted = F.contains("value", F.lit('"'))
    opened = F.exists("cells", lambda cell: cell.startswith('"') & ~cell.rlike(f"^{QUOTED}$"))
    size = F.size("cells")
    reason = (
        F.when(F.col("header").isNull(), "no header")
        .when(quoted & opened, "an open quote")
        .when(quoted & (F.array_join("cells", ",") != F.col("value")), "text after a quote")
        .when(size != F.size("names"), F.concat_ws(
            " ", size.cast("string"), F.lit("cells below a header of"), F.size("names").cast("string"))))
    place = {name: F.array_position("names", name).cast("int") for name in columns}
    fits = F.col("__reason").isNull()
    cells = [F.when(fits & (at > 0), _value(F.get("__cells", at - 1))).alias(name) for name, at in place.items()]
    marked = body.select("file", "value", "names", F.col("cells").alias("__cells"), reason.alias("__reason"))
    return marked.select(*cells, F.when(~fits, F.col("file")).alias("__file"), F.when(~fits, F.col("value")).alias("__line"), "__reason")


def _by_reason(marked: DataFrame, columns: Sequence[str]) -> ByHeader:
    names = [F.col(f"`{c}`") for c in columns]
    rejected = marked.where("__reason IS NOT NULL").select(
        F.col("__file").alias("file"), F.col("__line").alias("value"), F.col("__reason").alias("reason"))
    return ByHeader(marked.where("__reason IS NULL").select(*names), rejected)


def split_by_header(lines: DataFrame, headers: DataFrame, columns: Sequence[str]) -> ByHeader:
    """``marked_by_header`` as rows and rejected lines; each of them parses the lines anew."""
    return _by_reason(marked_by_header(lines, headers, columns), columns)


def parse_once(lines: DataFrame, headers: DataFrame, columns: Sequence[str]) -> ByHeader:
    """``split_by_header`` with the lines parsed once: what comes out is stored.

    Where no line was rejected, statistics of the stored files say so without reading them.
    """
    return _by_reason(stage(marked_by_header(lines, headers, columns), "csv-parsed"), columns)


def split_csv_by_header(
    spark: SparkSession, path: str | list[str], key_col: str, columns: Sequence[str],
) -> ByHeader:
    """Text columns of CSV files with differing headers, and the lines that do not fit theirs."""
    lines = text_lines(spark.read, path)
    return split_by_header(lines, read_headers(lines, key_col), columns)


def read_csv_by_header(
    spark: SparkSession, path: str | list[str], key_col: str, columns: Sequence[str],
) -> DataFrame:
    """The rows of ``split_csv_by_header``; a line that does not fit its header is an error."""
    return strict(split_csv_by_header(spark, path, key_col, columns))


def split_all_columns(spark: SparkSession, path: str | list[str], glob: str | None = None) -> ByHeader:
    """``split_csv_by_header`` for every column that some file's header names; ``glob`` limits the file names."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = text_lines(reader, path)
    headers = read_headers(lines)
    # Metadata only: the distinct column names over all headers reach the driver.
    found = headers.select(F.explode("names").alias("name")).where("name != ''").distinct().orderBy("name")
    names = [row["name"] for row in found.collect()]
    if not names:
        raise ValueError(f"no header below {path}")
    return parse_once(lines, headers, names)


def strict(parsed: ByHeader) -> DataFrame:
    """The rows, provided that no line was rejected."""
    odd = parsed.rejected.first()
    if odd is not None:
        raise ValueError(f"{odd['reason']}: {odd['file']}")
    return parsed.rows


def split_transactions(spark: SparkSession, root: str) -> ByHeader:
    """Raw transactions as text.  ``event_date`` comes from the file, not its folder."""
    return split_csv_by_header(spark, root, "transaction_id", schemas.RAW_TRANSACTION_COLUMNS)


def parse_transactions(spark: SparkSession, root: str) -> ByHeader:
    """``split_transactions`` for who needs both rows and rejected lines: the files are parsed once."""
    lines = text_lines(spark.read, root)
    return parse_once(lines, read_headers(lines, "transaction_id"), schemas.RAW_TRANSACTION_COLUMNS)


def read_transactions(spark: SparkSession, root: str) -> DataFrame:
    """``split_transactions`` of files in which every line fits its header."""
    return strict(split_transactions(spark, root))


def read_customers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw customers from JSON Lines, all text."""
    return spark.read.schema(schemas.RAW_CUSTOMERS).json(path)


def read_audit_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema(AUDIT_LOG).json(path)


def file_inventory(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, length, modificationTime`` of every file below ``path``.

    The content column is pruned from the scan, so no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", "modificationTime")


def sample_lines(
    spark: SparkSession, path: str | list[str], n: int = 100, max_bytes: int = 1048576,
) -> DataFrame:
    """The first ``n`` lines of each file that lie wholly in its first ``max_bytes``.

    Columns ``file, line_number, value``; line 1 is the header.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq")).where(F.col("block") < max_bytes)
    head = head_sample(lines, n, ["file"], ["block", "seq"])
    # At most n rows per file remain, so ordered windows per file are small.
    order = Window.partitionBy("file").orderBy("block", "seq")
    end = F.sum(F.octet_length("value") + 1).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        head.withColumn("line_number", F.row_number().over(order)).withColumn("__end", end)
        .where(F.col("__end") <= max_bytes + 1).select("file", "line_number", "value")
    )


def discover_schema(spark: SparkSession, path: str, table: str, fmt: str = "csv") -> DataFrame:
    """One table inferred from all files below ``path``.

    Rows ``table, column, type, is_partition``.  Folder names ``k=v`` give the
    partition columns.  For CSV the columns are the union of all files' headers,
    each typed from all its values: the narrowest of bigint, double, timestamp
    that every value fits, else string.
    """
    if fmt != "csv":
        found = spark.read.option("mergeSchema", "true").format(fmt).load(path)
        partitions = set(_partition_names(spark, path))
        rows = [(table, f.name, f.dataType.simpleString(), f.name in partitions) for f in found.schema.fields]
        return spark.createDataFrame(rows, "`table` string, `column` string, type string, is_partition boolean")
    partitions = _partition_names(spark, path)
    parsed = split_all_columns(spark, path)
    names, cells = parsed.rows.columns, strict(parsed)
    types = [("bigint", "bigint"), ("double", "double"), ("timestamp", "timestamp")]
    checks = [
        F.count_if(F.col(f"`{n}`").isNotNull() & F.col(f"`{n}`").try_cast(kind).isNull()).alias(f"{kind}{i}")
        for i, n in enumerate(names) for kind, _ in types
    ] + [F.count(f"`{n}`").alias(f"n{i}") for i, n in enumerate(names)]

    def kind_of(i: int) -> Column:
        chosen = F.lit("string")
        for kind, label in reversed(types):
            chosen = F.when(F.col(f"{kind}{i}") == 0, F.lit(label)).otherwise(chosen)
        return F.when(F.col(f"n{i}") == 0, F.lit("string")).otherwise(chosen)

    rows = [
        F.struct(F.lit(table).alias("table"), F.lit(n).alias("column"), kind_of(i).alias("type"),
                 F.lit(False).alias("is_partition"))
        for i, n in enumerate(names) if n not in partitions
    ] + [
        F.struct(F.lit(table).alias("table"), F.lit(p).alias("column"), F.lit("string").alias("type"),
                 F.lit(True).alias("is_partition"))
        for p in partitions
    ]
    return cells.agg(*checks).select(F.inline(F.array(*rows)))


def _partition_names(spark: SparkSession, path: str) -> list[str]:
    """Names of ``k=v`` folders below ``path``; metadata, a handful of names."""
    folder = F.explode(F.regexp_extract_all("path", F.lit("/([^/=]+)=[^/]*(?=/)"), F.lit(1)))
    found = file_inventory(spark, path).select(folder.alias("name")).distinct().orderBy("name")
    return [row["name"] for row in found.collect()]
