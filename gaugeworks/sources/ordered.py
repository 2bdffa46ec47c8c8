"""Several CSV files as one ordered table: files by name, rows as they stand in their file.

A file with quoted line breaks can't be split, so each is one split of Spark's reader and its rows get
rising ids; the ids' least value per file turns them into row numbers.  Files may have different headers.
What is kept per file is one row (name, header, rows before it), ranked by a range sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.operators.relational import GateError, global_rank
from gaugeworks.session import materialise


def header_width(spark: SparkSession, path: str) -> int:
    """Cells of the widest header line, at most; names that hold a comma only make it larger."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    first = lines.where("value <> ''").groupBy("path").agg(F.min_by(F.size(F.split("value", ",")), "at").alias("n"))
    return first.agg(F.max("n").alias("n")).first().n or 0


def csv_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, file_no, row_no, position, cells) of all rows of the header CSV files at a path or pattern.

    file_no counts files from 0 by name, then by path; row_no counts a file's rows from 1; position counts the rows of all files from 1.
    cells: map from the file's own header to text, empty where a row is short; of equal names the last
    counts.  A byte order mark is no part of a name.  Header names don't hold line breaks.  Files without a line have no number.
    """
    width = header_width(spark, path)
    if not width:
        raise GateError(f"no header in {path}")
    raw = spark.read.schema(", ".join(f"c{i} string" for i in range(width))).option("header", False).option("multiLine", True).option("escape", '"').csv(path)
    rows = materialise(raw.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("file_name"), F.monotonically_increasing_id().alias("_id"), F.array(*[F.col(f"c{i}") for i in range(width)]).alias("_cells")))
    files = rows.groupBy("_path", "file_name").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"), F.min_by("_cells", "_id").alias("_head"))
    files = global_rank(files, F.col("file_name"), F.col("_path"), name="_rank")
    before = F.sum(F.col("_rows") - 1).over(Window.orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1))  # one row for each file
    names = F.transform("_head", lambda n: F.regexp_replace(n, "^\ufeff", ""))
    files = files.select("_path", "_first", (F.col("_rank") - 1).alias("file_no"), F.coalesce(before, F.lit(0)).alias("_before"), names.alias("_head"))
    later = lambda n, i: F.coalesce(F.array_contains(F.slice("_head", i + 2, F.lit(width)), n), F.lit(False))
    used = F.filter(F.transform("_head", lambda n, i: F.struct(n.alias("n"), i.alias("i"))), lambda x: x.n.isNotNull() & ~later(x.n, x.i))
    both = rows.join(files.withColumn("_used", used).drop("_head"), "_path").where("_id > _first")
    row = F.col("_id") - F.col("_first")
    cells = F.map_from_entries(F.transform("_used", lambda x: F.struct(x.n, F.coalesce(F.get("_cells", x.i), F.lit("")))))
    return both.select("file_name", "file_no", row.alias("row_no"), (F.col("_before") + row).alias("position"), cells.alias("cells"))


def columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """The ordered rows with these cells as columns, null where empty or not in the file."""
    return rows.select("file_name", "file_no", "row_no", "position", *[F.nullif(F.try_element_at("cells", F.lit(n)), F.lit("")).alias(n) for n in names])
