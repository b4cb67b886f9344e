"""Files of a raw drop: listing, text lines, encoding, hashes and the manifest."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelens.schemas import MANIFEST

SUCCESS, FAILED = "SUCCESS", "FAILED"
FORMATS = {".csv": "csv", ".json": "json"}
# Source keys under which a format is stored and may be forced to load again.
SOURCE_KEYS = {"csv": "pt_csv", "json": "pt_json"}
BOM = "﻿"
# A file up to this size is read as one value where its content is needed whole.
WHOLE_FILE = 256 << 20


def base_name(path) -> Column:
    return F.regexp_replace(path, r"^.*[\\/]", "")


def format_of(path: str = "source_path") -> Column:
    """``csv`` or ``json`` by extension, NULL for anything else."""
    extension = F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))
    names = [F.when(extension == suffix, name) for suffix, name in FORMATS.items()]
    return F.coalesce(*names)


def _binary(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
    )


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every file below a folder with its format; contents are not read."""
    return _binary(spark, folder, "*").select(
        F.col("path").alias("source_path"),
        base_name("path").alias("source_file_name"),
        F.col("length").alias("file_size_bytes"),
        format_of("path").alias("source_format"),
    )


def fingerprint(texts: DataFrame) -> DataFrame:
    """(source_path, file_hash) of numbered lines (source_path, line_no, bytes, file_size_bytes), order included.

    Two sums of 64 bits each over the SHA-256 of a line with its number: parts of a file add up in any order, so no
    task holds a file.
    """
    digest = F.sha2(F.concat(F.col("line_no").cast("string"), F.lit(":"), "bytes"), 256)
    lanes = [F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    sums = texts.groupBy("source_path").agg(
        F.max("file_size_bytes").alias("size"), F.count("*").alias("n"),
        *[F.sum(lane).cast("decimal(38,0)").cast("string").alias(f"lane{i}") for i, lane in enumerate(lanes)],
    )
    return sums.select("source_path", F.sha2(F.concat_ws(":", "size", "n", "lane0", "lane1"), 256).alias("file_hash"))


def hashed_files(
    spark: SparkSession, folder: str, pattern: str = "*.{csv,json}", whole: int = WHOLE_FILE
) -> DataFrame:
    """Files with a hash of their content: SHA-256 where a file fits a value, else its lines' fingerprint.

    The size belongs to the content, so equal files are hashed alike. Only files of up to ``whole`` bytes are read
    as one value.
    """
    listed = list_files(spark, folder).filter("source_format is not null")
    fits = (
        _binary(spark, folder, pattern)
        .filter(F.col("length") <= whole)
        .select(F.col("path").alias("source_path"), F.sha2("content", 256).alias("file_hash"))
    )
    large = _binary(spark, folder, pattern).filter(F.col("length") > whole).select("path")
    if not large.isEmpty():
        numbered = with_line_numbers(scan(spark, folder, pattern, "\n").filter(F.col("file_size_bytes") > whole))
        same = F.regexp_replace("source_path", "^file:/+", "file:/").alias("source_path")
        fits = fits.unionByName(fingerprint(numbered).select(same, "file_hash"))
    return listed.join(fits, "source_path")


def scan(spark: SparkSession, folder: str, pattern: str, separator: str | None = None) -> DataFrame:
    """Texts of all files between separators (line ends where None), in one scan that splits large files.

    ``block`` and ``position`` order the texts of a file.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    if separator is not None:
        reader = reader.option("lineSep", separator)
    return reader.text(folder).select(
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
        F.col("value").alias("bytes"),
        F.col("_metadata.file_size").alias("file_size_bytes"),
    )


def lines(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Lines of all files in one scan that splits large files.

    ``block`` and ``position`` order the lines of a file.
    """
    return scan(spark, folder, pattern).drop("file_size_bytes")


def encodings(raw: DataFrame) -> DataFrame:
    """Encoding per file: UTF-8 when every line is valid, else Latin-1."""
    broken = F.count_if(~F.is_valid_utf8("bytes"))
    return raw.groupBy("source_path").agg(
        F.when(broken == 0, "utf-8").otherwise("latin-1").alias("encoding")
    )


def decoded(encoding="encoding", column: str = "bytes") -> Column:
    """The line as text in its file's encoding, without a byte-order mark."""
    latin = F.decode(F.col(column).cast("binary"), "ISO-8859-1")
    text = F.when(F.col(encoding) == "latin-1", latin).otherwise(F.col(column))
    return F.when(text.startswith(BOM), F.substring(text, 2, 2_000_000_000)).otherwise(text)


def first_lines(raw: DataFrame, count: int) -> DataFrame:
    """The first lines of every file, numbered from 0.

    Only a file's first block is looked at, and each task keeps no more than ``count`` lines of a
    file before the shuffle.
    """
    order = Window.partitionBy("source_path").orderBy("position")
    return (
        raw.filter("block = 0")
        .withColumn("line_no", F.row_number().over(order))
        .filter(F.col("line_no") <= count)
        .withColumn("line_no", F.col("line_no") - 1)
    )


def with_line_numbers(raw: DataFrame) -> DataFrame:
    """Adds ``line_no`` (from 0) without gathering a file in one task.

    Blocks are counted, the few counts are added up per file, and each line takes its block's
    offset plus its own place in the block.
    """
    blocks = raw.groupBy("source_path", "block").agg(
        F.count("*").alias("_lines"), F.min("position").alias("_first")
    )
    before = (
        Window.partitionBy("source_path")
        .orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = blocks.select(
        "source_path", "block", "_first",
        F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_before"),
    )
    return (
        raw.join(offsets, ["source_path", "block"])
        .withColumn("line_no", F.col("_before") + F.col("position") - F.col("_first"))
        .drop("_before", "_first")
    )


def not_loaded(files: DataFrame, manifest: DataFrame, force: bool = False, forced=()) -> DataFrame:
    """Files whose content was not loaded before; forced source keys always load."""
    if force:
        return files
    done = (
        manifest.filter(F.col("status") == SUCCESS)
        .select("file_hash")
        .distinct()
        .withColumn("_done", F.lit(True))
    )
    key = F.coalesce(
        *[F.when(F.col("source_format") == f, F.lit(k)) for f, k in SOURCE_KEYS.items()],
        F.lit(""),
    )
    joined = files.join(done, "file_hash", "left")
    return joined.filter(F.col("_done").isNull() | key.isin(*forced)).drop("_done")


def not_registered(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Files without a successful registry row of their name."""
    done = registry.filter(F.col("status") == "success").select("source_file_name")
    return files.join(done, "source_file_name", "left_anti")


def manifest_rows(files: DataFrame, ingest_date: str) -> DataFrame:
    """Manifest rows of processed files; ``error_message`` decides the status."""
    failed = F.col("error_message").isNotNull()
    return files.select(
        "source_path",
        F.coalesce("file_hash", F.lit("")).alias("file_hash"),
        F.when(failed, FAILED).otherwise(SUCCESS).alias("status"),
        F.lit(ingest_date).alias("ingest_date"),
        F.current_timestamp().alias("updated_at"),
        F.coalesce("error_message", F.lit("")).alias("error_message"),
    ).select(*MANIFEST.fieldNames())


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Ingested, skipped and failed files, as one row; ``outcome`` holds one of these words."""
    words = ("ingested", "skipped", "failed")
    return outcomes.agg(*[F.count_if(F.col("outcome") == w).alias(w) for w in words])


def load_counts(files: DataFrame, loaded: DataFrame, *keys: str) -> DataFrame:
    """Rows loaded per file, 0 for a file that brought none."""
    keys = keys or ("source_file_name",)
    counts = loaded.groupBy(*keys).agg(F.count("*").alias("rows_loaded"))
    return (
        files.select(*keys)
        .distinct()
        .join(counts, list(keys), "left")
        .withColumn("rows_loaded", F.coalesce("rows_loaded", F.lit(0)))
        .withColumn("verified", F.col("rows_loaded") > 0)
    )
