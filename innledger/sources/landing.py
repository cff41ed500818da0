"""Landing files: CSV in, CSV out."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from innledger.schemas import INGESTION_COLUMN, LANDING_TABLES


def landing_schema(spark: SparkSession, path: str, table: str) -> StructType:
    """Declared types in the order of the file's header; other columns are strings."""
    known = LANDING_TABLES.get(table, {})
    header = _options(spark.read).csv(path).columns
    return StructType([StructField(c, known.get(c, StringType())) for c in header])


#: Holds the text of a record with a cell that is not of its type, or too few or many cells.
REJECTED = "_rejected_record"


def read_landing(
    spark: SparkSession,
    path: str,
    table: str,
    infer: bool = False,
    one_line: bool = False,
    ranges: bool = False,
) -> DataFrame:
    """One landing file (or folder of files) with a header row.

    Types are declared, so only the header is read ahead. A cell that does not fit its type
    becomes NULL, and the record it stands in is kept as text in ``REJECTED``. Quoted cells
    may hold line breaks; ``one_line`` says that none does, and lets Spark split a large
    file into several tasks. ``ranges`` splits files that do have line breaks in cells (see
    ``records``). ``infer`` has Spark look at the data for the types instead, at the cost of
    a second pass; then nothing is rejected.
    """
    if ranges and infer:
        raise ValueError("ranges of a file are read with declared types")
    reader = _options(spark.read).option("multiLine", not one_line)
    if infer:
        inferred = reader.option("inferSchema", True).csv(path)
        return inferred.withColumn(REJECTED, F.lit(None).cast("string"))
    schema = landing_schema(spark, path, table).add(REJECTED, "string")
    if ranges:
        options = {**_CSV, "multiLine": "true", "columnNameOfCorruptRecord": REJECTED}
        named = [f"`{x.name.replace('`', '``')}` {x.dataType.simpleString()}" for x in schema]
        cells = F.from_csv("record", ", ".join(named), options)
        return records(spark, path).select(cells.alias("cells")).select("cells.*")
    return (
        reader.option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", REJECTED)
        .schema(schema)
        .csv(path)
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files as text in the column ``record``, headers left out.

    Files are cut into ranges of bytes that are read side by side. Whether a line begins a
    record depends on all quotes before it; their parity is a sum over the ranges of a file,
    so only one row a range is gathered, and within a range a running sum does the rest.
    Lines go through one exchange, to the range they came from; what ranges share, at most
    two pieces of each, is put together after it.

    Quotes must stand around whole cells, doubled inside. A record in which they do not fails
    the query, since the records after it could not be told; such files are for the reading
    without ranges. So are files whose headers differ.
    """
    odd = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("line"),
        F.pmod(odd, F.lit(2)).alias("odd"),
    )
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    open_ranges = lines.groupBy("file", "range").agg(F.sum("odd").alias("quotes")).select(
        "file", "range", F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2)).alias("inside")
    )
    earlier = Window.partitionBy("file", "range").orderBy("line")
    quotes = F.coalesce(F.sum("odd").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = (
        lines.repartition("file", "range")
        .join(open_ranges, ["file", "range"])
        .withColumn("begins", (F.pmod(F.col("inside") + quotes, F.lit(2)) == 0).cast("long"))
        .withColumn("record", F.sum("begins").over(earlier))
    )
    # Most lines are records by themselves.
    alone = (F.col("begins") == 1) & (F.col("odd") == 0)
    single = numbered.filter(alone).select("file", "range", "record", F.col("value").alias("text"))
    pieces = (
        numbered.filter(~alone)
        .groupBy("file", "range", "record")
        .agg(
            F.array_sort(F.collect_list(F.struct("line", "value"))).alias("lines"),
            F.sum("odd").alias("quotes"),
        )
        .select(
            "file", "range", "record",
            F.array_join(F.col("lines.value"), "\n").alias("text"),
            # The piece that goes on from an earlier range has the number 0.
            F.expr("record = 0 OR quotes % 2 = 1").alias("shared"),
        )
    )
    so_far = Window.partitionBy("file").orderBy("range", "record")
    shared = (
        pieces.filter("shared")
        .withColumn("nth", F.sum(F.expr("CAST(record > 0 AS BIGINT)")).over(so_far))
        .groupBy("file", "nth")
        .agg(F.array_sort(F.collect_list(F.struct("range", "record", "text"))).alias("parts"))
        .select(
            "file",
            F.col("parts")[0]["range"].alias("range"),
            F.col("parts")[0]["record"].alias("record"),
            F.array_join(F.col("parts.text"), "\n").alias("text"),
        )
    )
    several = pieces.filter("NOT shared").drop("shared").unionByName(shared)
    cells = F.regexp_replace("text", '"[^"]*"', "\u0001")
    irregular = F.contains("text", F.lit('"')) & cells.rlike('"|[^,\u0001]\u0001|\u0001[^,\u0001]')
    message = F.concat(F.lit("quotes inside a cell in "), "file", F.lit(": "), "text")
    return (
        single.unionByName(several)
        .filter("NOT (range = 0 AND record = 1)")
        .withColumn("text", F.expr("if(endswith(text, '\r'), left(text, length(text) - 1), text)"))
        .filter("text != ''")
        .select(F.when(irregular, F.raise_error(message)).otherwise(F.col("text")).alias("record"))
    )


#: Quotes inside a cell are doubled; blanks around a cell belong to it.
_CSV = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _options(reader_or_writer):
    return reader_or_writer.options(header="true", **_CSV)


def stamped(df: DataFrame) -> DataFrame:
    """Add the time of ingestion, one value for the whole query."""
    return df.withColumn(INGESTION_COLUMN, F.current_timestamp())


def ingest(
    spark: SparkSession,
    folder: str,
    table: str,
    infer: bool = False,
    one_line: bool = False,
    ranges: bool = False,
) -> DataFrame:
    """The bronze form of ``folder/table.csv``, with rejected records in ``REJECTED``."""
    return stamped(read_landing(spark, f"{folder}/{table}.csv", table, infer, one_line, ranges))


def write_landing(df: DataFrame, folder: str, table: str) -> None:
    """Write ``folder/table.csv`` as a folder of parts, each with a header row."""
    _options(df.write.mode("overwrite")).csv(f"{folder}/{table}.csv")
