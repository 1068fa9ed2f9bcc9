"""CSV files whose quoted fields span lines, read in ranges instead of whole.

A reader that meets a line break inside quotes cannot start in the middle of a file, so
``multiLine`` gives a file to one task.  Here a file is read line by line in ranges, as any
text file, and its records are put together afterwards:

1. Every line tells its number of quotes; a running sum within its range says whether an
   even or odd number came before it there.
2. Per range, one row: the parity of its quotes, and how many lines would begin a record
   if the range itself began outside or inside quotes.  A running sum over these rows (one
   a range, about 128 MB of file each) says which of the two it is, and which record the
   lines before its first record belong to.
3. A line that begins a record and has an even number of quotes is a record.  Only the
   lines of other records meet in a group (range, number within it), in file order.

So the text moves once, by range, and lines of records that span lines once more.  Every
task holds lines of one range or one record at a time.

Defined results: quoting as in RFC 4180 (a quote inside a quoted field is doubled); a file
whose line break is CR LF has LF in its fields, as the whole-file reader gives it; empty
lines outside quotes are no records; a file whose quotes do not pair up is an error, since
every record after the odd one would be wrong.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE = ["file", "block"]
#: name of the j-th field while a record is parsed
FIELD = "_{}"


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _ranges(lines: DataFrame) -> DataFrame:
    """One row a range: whether it begins inside quotes (null in a file whose quotes do not pair
    up), and the last record begun before it."""
    first = F.struct("block", "place")
    per = lines.groupBy(*RANGE).agg(
        F.sum("quotes").alias("quotes"), F.count_if(F.col("before") % 2 == 0).alias("outside"), F.count_if(F.col("before") % 2 == 1).alias("inside"),
        F.min_by(F.endswith("value", F.lit("\r")), first).alias("crlf"))
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    paired = F.sum("quotes").over(whole) % 2 == 0
    carried = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2
    per = per.withColumn("carried", F.when(paired, carried))
    per = per.withColumn("begun", F.when(F.col("carried") == 0, F.col("outside")).otherwise(F.col("inside")))
    last = F.last(F.when(F.col("begun") > 0, F.struct("block", "begun")), ignorenulls=True).over(earlier)
    return per.select(*RANGE, "carried", last.alias("open"), F.first("crlf").over(order).alias("crlf"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, number, record): every record of the files, by the range and place it begins in."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
             .withColumn("quotes", _quotes(F.col("value"))))
    order = Window.partitionBy(*RANGE).orderBy("place")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("before", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)))
    lines = lines.join(_ranges(lines), RANGE)
    begins = (F.col("before") + F.col("carried")) % 2 == 0
    lines = lines.withColumn("begins", begins).withColumn("number", F.sum(F.col("begins").cast("long")).over(order))
    line = F.when(F.col("crlf"), F.regexp_replace("value", r"\r$", "")).otherwise(F.col("value"))
    # a line before the first record of its range belongs to the last one begun earlier in the file
    lines = lines.select("file", line.alias("line"), F.col("block").alias("at"), "place", "begins", "quotes", "carried",
                         F.when(F.col("number") > 0, F.col("block")).otherwise(F.col("open.block")).alias("block"),
                         F.when(F.col("number") > 0, F.col("number")).otherwise(F.col("open.begun")).alias("number"))
    alone = F.col("begins") & (F.col("quotes") % 2 == 0)
    single = lines.where(alone).select("file", "block", "number", F.col("line").alias("record"))
    # raised in this branch alone: of a file without pairs the other one has no rows
    broken = F.raise_error(F.concat(F.lit("quotes do not pair up in "), F.col("file"))).cast("long")
    rest = lines.where(F.col("carried").isNull() | ~alone).withColumn("number", F.when(F.col("carried").isNull(), broken).otherwise(F.col("number")))
    parts = rest.groupBy("file", "block", "number").agg(F.sort_array(F.collect_list(F.struct("at", "place", "line"))).alias("parts"))
    several = parts.select("file", "block", "number", F.array_join(F.col("parts.line"), "\n").alias("record"))
    return single.unionByName(several).where("record <> ''")


def scan_csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows as text columns named by the header, which is the first record of every file."""
    names = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path).columns
    fields = ", ".join(f"{FIELD.format(j)} string" for j in range(len(names)))
    rows = csv_records(spark, path).where("NOT (block = 0 AND number = 1)")
    parsed = rows.select(F.from_csv("record", fields, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}).alias("row"))
    return parsed.select(*(F.col(f"row.{FIELD.format(j)}").alias(name) for j, name in enumerate(names)))
