"""Readers (S01-S07, S09-S16, S24-S26)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.scale import attach, ordered_scan
from tidemill.session import materialise


def _reader(spark: SparkSession, recursive: bool, pattern: str | None):
    r = spark.read
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    return r


def read_json(spark: SparkSession, path, schema, multiline: bool = False, recursive: bool = False, pattern: str | None = None) -> DataFrame:
    """JSON lines, or with ``multiline`` one JSON value per file."""
    return _reader(spark, recursive, pattern).schema(schema).option("multiLine", multiline).json(path)


def read_csv(
    spark: SparkSession, path, schema, sep: str = ",", header: bool = True, recursive: bool = False, pattern: str | None = None
) -> DataFrame:
    """CSV with a stated schema; gzip is read by file suffix; empty text is null."""
    return _reader(spark, recursive, pattern).schema(schema).option("header", header).option("sep", sep).csv(path)


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_checked(spark: SparkSession, path, schema: T.StructType, fmt: str = "json", **options) -> tuple[DataFrame, DataFrame]:
    """(good rows, broken lines with their file) of JSON-lines or headerless CSV files.

    Nothing is dropped silently: a line that does not parse goes to the second frame.
    """
    wide = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", **options}
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("source_file"), "value")
    parse = {"json": F.from_json("value", wide, opts), "csv": F.from_csv("value", F.lit(_ddl(wide)), opts)}[fmt]
    parsed = lines.where(F.trim("value") != "").withColumn("_p", parse)
    broken = parsed.where(F.col("_p._bad").isNotNull()).select("source_file", F.col("value").alias("record"))
    return parsed.where(F.col("_p._bad").isNull()).select(*[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields]), broken


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def canonical_key(name: str) -> str:
    return re.sub(r"\s+", "", name).lower()


def match_headers(df: DataFrame, canonical: Sequence[str]) -> DataFrame:
    """Pick ``canonical`` columns by name, ignoring case and blanks; missing ones are null."""
    have = {canonical_key(c): c for c in df.columns}
    cols = []
    for want in canonical:
        found = have.get(canonical_key(want))
        cols.append(F.col(f"`{found}`").alias(want) if found else F.lit(None).cast("string").alias(want))
    return df.select(*cols)


def csv_cells(line: Column) -> Column:
    """Cells of a CSV line of any width; quotes are undone, empty cells are null."""
    cell = r',("[^"\\]*(?:(?:\\.|"")[^"\\]*)*"|[^,]*)'
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(cell), F.lit(1))

    def plain(c: Column) -> Column:
        inner = F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), r'\\(.)|"(")', "$1$2")
        return F.nullif(F.when(c.startswith('"') & (F.length(c) > 1), inner).otherwise(c), F.lit(""))

    return F.transform(found, plain)


def _records(spark: SparkSession, paths: Sequence[str], width: int | None) -> DataFrame:
    """(source_file, cells) of every CSV record that is not blank."""
    name = F.col("_metadata.file_path").alias("source_file")
    if width is None:
        lines = spark.read.text(list(paths)).select(name, "value").where(F.trim("value") != "")
        return lines.select("source_file", csv_cells(F.col("value")).alias("cells"))
    columns = [f"c{i}" for i in range(width)]
    reader = spark.read.schema(text_schema(columns)).option("multiLine", True).option("escape", '"')
    records = reader.csv(list(paths)).select(name, F.array(*columns).alias("cells"))
    return records.where(F.exists("cells", lambda c: c.isNotNull()))


def read_loose(
    spark: SparkSession, paths: Sequence[str], canonical: Sequence[str], width: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """CSV files whose headers differ in case and blanks, as one frame of text.

    All rows are read in one distributed scan without header handling. Each file's
    header record is recognised by its content and mapped to positions, so files
    may order their columns differently. Second result: files with no usable header.

    Without ``width`` records are lines, of any number of cells, and large files are
    split. With it, for files whose quoted cells hold line breaks, records go through
    the CSV reader with up to ``width`` cells, a file a task.
    """
    wanted = {canonical_key(c): c for c in canonical}
    cells = _records(spark, paths, width)
    keys = F.transform("cells", lambda c: F.lower(F.regexp_replace(c, r"\s+", "")))
    names = F.array(*[F.lit(k) for k in wanted])
    cells = cells.withColumn("keys", keys).withColumn("hits", F.size(F.array_intersect(names, "keys")))
    is_header = F.col("hits") == len(wanted)
    place = [F.max(F.when(is_header, F.array_position("keys", F.lit(k)))).alias(f"p{i}") for i, k in enumerate(wanted)]
    files = cells.groupBy("source_file").agg(F.count(F.lit(1)).alias("_n"), *place)
    known = files.where(F.col("p0").isNotNull())
    body = attach(cells.where(~is_header), known, ["source_file"], "_n").where(F.col("p0").isNotNull())
    picked = [F.get(F.col("cells"), (F.col(f"p{i}") - 1).cast("int")).alias(c) for i, c in enumerate(canonical)]
    return body.select(*picked, "source_file"), files.where(F.col("p0").isNull()).select("source_file")


def combine_logs(df: DataFrame, keep: Sequence[str], required: str) -> DataFrame:
    """Keep some columns of the log, drop rows without ``required``."""
    return df.where(F.col(required).isNotNull() & (F.col(required) != "")).select(*keep)


def read_labelled_text(spark: SparkSession, root: str) -> DataFrame:
    """(label, path, text) of a folder tree; the label is the folder name."""
    raw = spark.read.option("recursiveFileLookup", "true").text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    return raw.select(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("label"), path.alias("path"), F.col("value").alias("text"))


def with_source_file(df: DataFrame, out: str = "file", folder: bool = False) -> DataFrame:
    """Add the name of the file each row came from, or of its folder (call right after a read)."""
    if folder:
        return df.withColumn(out, F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))
    return df.withColumn(out, F.col("_metadata.file_name"))


def number_lines(spark: SparkSession, path: str, out: str) -> DataFrame:
    """(line, text) of a text file or a folder of parts, lines numbered from 0 in the order of
    the files' names and of the lines in them.

    Files are read in blocks. A block's lines pass a task one after the other, so a line's place in
    it is known as it is read; the lines of earlier blocks are added by prefix sums over one
    row per block. No line is sorted or sent anywhere.
    """
    at = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row")]
    lines = materialise(spark.read.text(path).select(*at, F.col("value").alias(out)))
    blocks = lines.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = ordered_scan(blocks, [F.col("_file"), F.col("_block")], {"_upto": F.col("_n")})
    offsets = before.select("_file", "_block", (F.col("_upto") - F.col("_n") - F.col("_first")).alias("_shift"))
    return lines.join(offsets, ["_file", "_block"]).select((F.col("_row") + F.col("_shift")).alias("line"), out)


def zip_lines(spark: SparkSession, a: str, b: str) -> DataFrame:
    """Two line-aligned files side by side."""
    return number_lines(spark, a, "a").join(number_lines(spark, b, "b"), "line")


def token_budget(df: DataFrame, text: str, key: str, n: int) -> DataFrame:
    """Rows in order of the unique ``key`` until the running word count passes ``n``; the row
    that passes it is still taken.

    Only keys and counts are scanned; the texts of the rows taken are joined afterwards.
    """
    words = F.size(F.filter(F.split(F.col(text), r"\s+"), lambda w: w != ""))
    run = ordered_scan(df.select(key, words.cast("bigint").alias("n_tokens")), [F.col(key)], {"run": F.col("n_tokens")})
    return df.join(run.where(F.col("run") - F.col("n_tokens") <= n), key)


def explode_json(df: DataFrame, col: str, schema: str) -> DataFrame:
    """Parse a JSON column and explode its array elements or map entries."""
    parsed = df.withColumn("_j", F.from_json(F.col(col), schema))
    return parsed.select(*[c for c in df.columns if c != col], F.explode("_j"))


def lookup_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is asked for; one semi join, no chunks of ids."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def between_dates(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """One closed date range; pushed to the scan, prunes date partitions."""
    kind = df.schema[col].dataType.simpleString()
    return df.where((F.col(col) >= F.lit(lo).cast(kind)) & (F.col(col) <= F.lit(hi).cast(kind)))
