"""Read order, inventory and event files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.schemas import GPS_EVENT, INVENTORY_DOCUMENT, ORDERS, STATUS_EVENT, text_only
from larderline.sources import records

# How documents lie in a file: the file is one array or one object; or it has an
# object per line; or it is an array with an object per line.
JSON_LAYOUTS = ("whole", "lines", "array_lines")


# Quotes within a quoted value are doubled, blanks belong to their
# value, and an empty text is told from a missing one by its quotes. No text
# equals the mark for missing values, so only a value that is not there is one.
CSV_DIALECT = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\u0000",
}
# Holds a row that does not have the columns of its header.
_TORN = "_row_as_it_came"


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _line_breaks(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, "\r\n", ""))


def _require(rows: DataFrame, holds: Column, message: str, record: Column) -> DataFrame:
    """The rows; the job fails on the first that the condition does not hold for."""
    text = F.concat(F.lit(f"{message}: "), F.coalesce(record, F.lit("")))
    return rows.filter(F.assert_true(holds, text).isNull())


def _declared(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns. A row that is not as its header says must be whole:
    without a line break, and with both halves of each pair of quotes."""
    torn = (_count(F.col(_TORN), '"') % 2 == 1) | (_line_breaks(F.col(_TORN)) > 0)
    whole = F.coalesce(~torn, F.lit(True))
    return _require(rows, whole, "torn row", F.col(_TORN)).select(*schema.names)


def _files_with_open_lines(spark: SparkSession, path: str) -> list[str]:
    """The files in which a quote is still open where a line ends. There are no
    more than Spark lists to read them."""
    lines = records.pieces(spark, path)
    is_open = _count(F.col("piece"), '"') % 2 == 1
    return [row.file for row in lines.filter(is_open).select("file").distinct().collect()]


def _joined_csv(
    spark: SparkSession, path: str, names: list[str], with_breaks: list[str]
) -> DataFrame:
    """The rows of files whose values hold line breaks, as the header names them."""
    lines = records.pieces(spark, path, "\n").filter(F.col("file").isin(with_breaks))
    found = records.joined(lines, records.Shape(_count(F.col("piece"), '"')), "\n")
    record = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)"))
    found = found.withColumn("record", record.otherwise(F.col("record")))
    title = F.lower(F.replace("record", F.lit('"'), F.lit("")))
    titled = ~F.col("first") | (title == ",".join(names).lower())
    rows = _require(found, titled, f"header is not that of other files, {names}", F.col("record"))
    # Names may be any text, so columns are numbered while they are parsed.
    numbered = [f"c{at}" for at in range(len(names))]
    kinds = ", ".join(f"{name} string" for name in [*numbered, _TORN])
    options = {**CSV_DIALECT, "columnNameOfCorruptRecord": _TORN}
    # Inlined, a record is parsed once; a struct would be parsed anew wherever one
    # of its fields is used.
    parsed = rows.filter(~F.col("first") & (F.btrim("record") != "")).select(
        "record", F.inline(F.array(F.from_csv("record", kinds, options)))
    )
    # Each line break has to turn up in a value, or the record is more than one.
    values = [F.coalesce(_line_breaks(F.col(name)), F.lit(0)) for name in numbered]
    all_there = sum(values[1:], values[0]) == _line_breaks(F.col("record"))
    as_titled = F.col(_TORN).isNull() | (_line_breaks(F.col("record")) == 0)
    whole = _require(parsed, all_there & as_titled, "torn row", F.col("record"))
    return whole.select(
        *[F.col(at).alias(name) for at, name in zip(numbered, names, strict=True)]
    )


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The declared columns as text, found by their names in the header. Files
    whose headers differ from each other are refused, not misread.

    A value between quotes may hold line breaks. The quotes of every line are
    counted first. Files in which all are closed at line ends are read as they
    are; the records of the others are put together from the lines of their
    splits. A file with a quote that is never closed is refused.
    """
    reader = spark.read.options(**CSV_DIALECT).option("enforceSchema", False)
    names = reader.csv(path).columns
    with_breaks = _files_with_open_lines(spark, path)
    named = [T.StructField(name, T.StringType()) for name in names]
    marked = T.StructType([*named, T.StructField(_TORN, T.StringType())])
    rows = reader.schema(marked).option("columnNameOfCorruptRecord", _TORN).csv(path)
    if not with_breaks:
        return _declared(rows, schema)
    others = rows.filter(~F.col("_metadata.file_path").isin(with_breaks))
    joined = _joined_csv(spark, path, names, with_breaks)
    return _declared(others, schema).union(joined.select(*schema.names))


def read_orders_csv(spark: SparkSession, path: str) -> DataFrame:
    """Orders as text; ``operators.loading`` types or rejects them."""
    return _read_csv(spark, path, ORDERS)


def read_gps_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, GPS_EVENT)


def read_status_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, STATUS_EVENT)


def _stream_csv(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None
) -> DataFrame:
    """The same columns as files arrive. A stream cannot look into its files
    first: they must have these columns in this order, and are checked for it.
    One task reads a whole file, record by record, as values may hold line breaks.
    What looks like a value whose quote is never closed stops the stream: one over
    lines that begins with a quote without its other half, or that ends with a
    line break and holds as many separators as a row."""
    marked = T.StructType([*text_only(schema), T.StructField(_TORN, T.StringType())])
    reader = spark.readStream.schema(marked).options(**CSV_DIALECT).option("multiLine", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    reader = reader.option("enforceSchema", False).option("columnNameOfCorruptRecord", _TORN)
    rows = _declared(reader.csv(path), schema)
    for name in schema.names:
        value = F.col(name)
        halved = value.startswith('"') & (_count(value, '"') % 2 == 1)
        swallowed = F.rlike(value, F.lit(r"[\r\n]\z")) & (_count(value, ",") >= len(schema) - 1)
        is_open = (_line_breaks(value) > 0) & (halved | swallowed)
        rows = _require(rows, ~F.coalesce(is_open, F.lit(False)), "torn row", value)
    return rows


def stream_gps_csv(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    return _stream_csv(spark, path, GPS_EVENT, files_per_batch)


def stream_status_csv(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    return _stream_csv(spark, path, STATUS_EVENT, files_per_batch)


def _field(document: Column, name: str) -> Column:
    """A field by its name in any case; the first one, if several match."""
    same = F.filter(F.map_entries(document), lambda x: F.lower(x.key) == name.lower())
    return F.get(same, 0).value


def _joined_json(spark: SparkSession, path: str) -> DataFrame:
    """The documents of files that hold them in any shape, a text each. Files are
    read in splits and cut at each brace that opens; a document begins where one
    does outside of all others."""
    pieces = records.pieces(spark, path, "{")
    bare = F.regexp_replace("piece", r"\\[\s\S]", "")
    quoted = r'"[^"]*("|$)'
    outside = F.regexp_replace(bare, quoted, "")
    inside = F.regexp_replace(F.regexp_replace(bare, r'^[^"]*("|$)', ""), quoted, "")
    shape = records.Shape(_count(bare, '"'), -_count(outside, "}"), -_count(inside, "}"), 1)
    found = records.joined(pieces, shape, "{")
    # What stands around documents: brackets, commas and blanks.
    opening, closing = r"^[\s\ufeff\[]+", r"[\s,\]]+$"
    first = F.col("first")
    _require_closed_arrays(found, closing)
    document = F.when(first, F.regexp_replace("record", opening, "")).otherwise(
        F.concat(F.lit("{"), "record")
    )
    return found.select(F.regexp_replace(document, closing, "").alias("value"))


def _require_closed_arrays(found: DataFrame, closing: str) -> None:
    end = F.regexp_extract("record", f"({closing})", 1)
    opened = F.when(F.col("first"), _count(F.col("record"), "[")).otherwise(0)
    arrays = found.groupBy("file").agg(
        F.sum(opened).alias("opened"), F.sum(_count(end, "]")).alias("closed")
    )
    torn = arrays.filter("opened != closed").first()
    if torn is not None:
        raise ValueError(f"malformed JSON: {torn.opened} arrays, {torn.closed} ends in {torn.file}")


def read_inventory_json(spark: SparkSession, path: str, layout: str = "whole") -> DataFrame:
    """Inventory documents as text columns; malformed JSON fails the job.

    Files of the ``whole`` layout, arrays or objects of any shape, are split as
    well, but their content is shuffled and written once to find the documents.
    Name the layout of files that have an object per line, as most exports do,
    and nothing has to be moved.
    """
    if layout not in JSON_LAYOUTS:
        raise ValueError(f"layout must be one of {JSON_LAYOUTS}, not {layout!r}")
    if layout == "whole":
        texts = _joined_json(spark, path)
    else:
        texts = spark.read.text(path)
        if layout == "array_lines":
            # What a line holds, without what joins it to the lines around it.
            inside = F.regexp_replace(F.trim("value"), r"^[\[,\s]+|[\],\s]+$", "")
            texts = texts.select(inside.alias("value"))
    # Read as the content of an array, a text with several documents gives all of
    # them, and what is no document fails. All are arrays of arrays here.
    array = F.when(F.startswith("value", F.lit("[")), F.col("value")).otherwise(
        F.concat(F.lit("["), F.col("value"), F.lit("]"))
    )
    nested = T.ArrayType(T.ArrayType(T.MapType(T.StringType(), T.StringType())))
    content = F.concat(F.lit("["), array, F.lit("]"))
    documents = F.flatten(F.from_json(content, nested, {"mode": "FAILFAST"}))
    parsed = texts.filter(F.trim("value") != "").select(F.explode(documents).alias("document"))
    return parsed.select(
        *[_field(F.col("document"), name).alias(name) for name in INVENTORY_DOCUMENT.names]
    )
