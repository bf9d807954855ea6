"""CSV readers, writers and the cleaning job for raw exports."""

from __future__ import annotations

import csv
import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskspark.functions.cleaning import clean_id, clean_numeric, numeric_like
from riskspark.session import cut_lineage

NUMERIC_SHARE = 0.3
_QUOTING = {"quote": '"', "escape": '"'}


def _local_quotes(batches):
    """Per line of a block: its place, quotes before it in the block and its own (both modulo 2), and how many lines up to it, blank
    ones aside, have an even or odd number before them."""
    now, place, quotes, seen = None, 0, 0, [0, 0]
    for batch in batches:
        own = pc.fill_null(pc.count_substring(batch.column("value"), '"'), 0).to_numpy(zero_copy_only=False).astype(np.int64) & 1
        blank = pc.equal(pc.utf8_trim_whitespace(batch.column("value")), "").to_pylist()
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        out = np.empty((5, batch.num_rows), np.int64)
        for at, mine in enumerate(own.tolist()):
            if (files[at], blocks[at]) != now:
                now, place, quotes, seen = (files[at], blocks[at]), 0, 0, [0, 0]
            seen[quotes] += not blank[at]
            out[:, at] = place, quotes, mine, *seen
            place, quotes = place + 1, quotes ^ mine
        names = [*batch.schema.names, "place", "before", "own", "even", "odd"]
        yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x) for x in out]], names=names)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, record) of the records of CSV files, quoted line breaks included; ``number`` counts them from 1 in each file.

    Files are read in blocks. A line starts a record if an even number of quotes stands before it in its file: every block
    counts its own quotes, the parities of earlier blocks are carried into it, and so are their numbers of records. A
    line that starts a record and ends it stays where it was read; only lines of longer records are brought together.
    Blank lines between records are no records. A quote that is never closed makes the rest of its file one record.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    local = lines.mapInArrow(_local_quotes, "file string, block long, value string, place long, before long, own long, even long, odd long")
    blocks = local.groupBy("file", "block").agg((F.sum("own") % 2).alias("parity"), F.max("even").alias("even"), F.max("odd").alias("odd"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = blocks.withColumn("open", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)
    starts = F.when(F.col("open") == 0, F.col("even")).otherwise(F.col("odd"))
    carried = opened.withColumn("offset", F.coalesce(F.sum(starts).over(earlier), F.lit(0))).select("file", "block", "open", "offset")
    # Stored, so that Spark knows how few rows it has and need not move the lines to join them.
    carried = cut_lineage(carried, "csv-blocks")

    # An open quote before the block turns even and odd around.
    whole = (F.col("before") == F.col("open")) & (F.col("own") == 0)
    placed = local.join(carried, ["file", "block"]).withColumns({"number": F.col("offset") + starts, "whole": whole})
    single = placed.where("whole").select("file", "number", F.col("value").alias("record"))
    parts = placed.where("not whole").groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("block", "place", "value"))).alias("parts"))
    longer = parts.select("file", "number", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("record"))
    record = F.regexp_replace("record", "\r$", "")
    return single.unionByName(longer).withColumn("record", record).where("trim(record) <> ''")


def read_raw_csv(spark: SparkSession, path: str, number: str | None = None) -> DataFrame:
    """Every column as text, named by the first record of the first file; each file has a header of its own.

    ``number`` names a further column with the record's place in the first file, 1 being the first behind the header; NULL in later files.
    """
    records = csv_records(spark, path)
    head = records.where("number = 1").agg(F.min_by("record", "file").alias("names"), F.min("file").alias("file")).first()
    first = head["names"]
    if first is None:
        return spark.createDataFrame([], StructType([]))
    cells = next(csv.reader(io.StringIO(first.lstrip("\ufeff"), newline="")))
    names = [n if n and [x.lower() for x in cells].count(n.lower()) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(cells)]
    schema = StructType([StructField(n, StringType()) for n in names])
    parsed = records.where("number > 1").select(F.when(F.col("file") == head["file"], F.col("number") - 1).alias("_n"), F.from_csv("record", schema.toDDL(), {**_QUOTING, "maxCharsPerColumn": "-1"}).alias("r"))
    return parsed.select("r.*", *([F.col("_n").alias(number)] if number else []))


def drop_subheader(df: DataFrame, is_subheader: Column | None = None, number: str | None = None) -> DataFrame:
    """Drop the second header row of an export.

    With ``is_subheader`` the matching rows go, with no need for row order. With ``number``, a column of ``read_raw_csv``, the
    first data row of the first file goes, and the column. With neither, the frame has to be read by Spark's own reader:
    the first data row goes, the least (file, block start, row id), found by one small aggregate and removed by a filter.
    """
    if is_subheader is not None:
        return df.where(~F.coalesce(is_subheader, F.lit(False)))
    if number is not None:
        return df.where(~F.col(number).eqNullSafe(F.lit(1))).drop(number)
    names = df.columns
    place = F.struct("_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    placed = df.select("*", place.alias("_place"))
    first = placed.agg(F.min("_place").alias("p")).first()["p"]
    if first is None:
        return df
    is_first = (
        (F.col("_place.file_name") == first["file_name"])
        & (F.col("_place.file_block_start") == first["file_block_start"])
        & (F.col("_place.row") == first["row"])
    )
    return placed.where(~is_first).select(*names)


def numeric_shares(df: DataFrame, exclude: tuple[str, ...] = ("cst_dim_id",)) -> DataFrame:
    """(column, share of number-like cells), all columns in one aggregate."""
    names = [n for n in df.columns if n not in exclude]
    cells = [
        F.struct(F.lit(n).alias("column_name"), F.avg(numeric_like(F.col(n)).cast("int")).alias("share")) for n in names
    ]
    return df.agg(F.array(*cells).alias("m")).select(F.inline("m"))


def detect_numeric_like(df: DataFrame, threshold: float = NUMERIC_SHARE, exclude: tuple[str, ...] = ("cst_dim_id",)) -> list[str]:
    """Text columns whose share of number-like cells exceeds ``threshold``."""
    rows = numeric_shares(df, exclude).collect()  # one row per column of the table
    return [r["column_name"] for r in rows if r["share"] is not None and r["share"] > threshold]


def clean_raw(df: DataFrame, threshold: float = NUMERIC_SHARE) -> DataFrame:
    """Clean the id column and every number-like column of an all-text frame."""
    numeric = set(detect_numeric_like(df, threshold))
    out = {n: clean_numeric(F.col(n)) for n in df.columns if n in numeric}
    if "cst_dim_id" in df.columns:
        out["cst_dim_id"] = clean_id(F.col("cst_dim_id"))
    return df.withColumns(out)


def convert_raw(spark: SparkSession, source: str, target: str, is_subheader: Column | None = None) -> None:
    """Raw export in, clean CSV out."""
    rows = read_raw_csv(spark, source, "_number")
    rows = drop_subheader(rows, number="_number") if is_subheader is None else drop_subheader(rows.drop("_number"), is_subheader)
    clean_raw(rows).write.option("header", True).options(**_QUOTING).csv(target)


def load_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Bulk load with a fixed schema, bound by the names in the header; a row that does not fit stops the load.

    Columns may stand in any order, and further ones are left out. A missing column, or a file of the folder with
    another header than the first, is an error.
    """
    names = spark.read.option("header", True).csv(path).columns
    absent = [f.name for f in schema.fields if f.name not in names]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    known = {f.name: f for f in schema.fields}
    bound = StructType([known.get(n, StructField(n, StringType())) for n in names])
    reader = spark.read.schema(bound).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    return reader.csv(path).select(*schema.fieldNames())


def read_training_csv(spark: SparkSession, path: str, label: str = "target", encoding: str = "windows-1251") -> DataFrame:
    """The merged training file: ``;``-separated, in a legacy code page, integer label."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    raw = spark.read.option("header", True).option("sep", ";").option("encoding", encoding).csv(path)
    return raw.withColumn(label, F.col(label).cast("int"))


def write_training_csv(df: DataFrame, path: str, encoding: str = "windows-1251") -> None:
    df.sparkSession.conf.set("spark.sql.legacy.javaCharsets", "true")
    df.write.option("header", True).option("sep", ";").option("encoding", encoding).csv(path)


def write_metrics_csv(df: DataFrame, path: str) -> None:
    """A metrics table (one row per model and scenario) as one CSV file."""
    df.coalesce(1).write.option("header", True).option("encoding", "UTF-8").csv(path)
