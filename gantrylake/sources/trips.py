"""Raw hourly trip files: headerless, all text, eight fields, plain or gzip."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gantrylake.schemas import PARTITION_KEY, RAW_TRIP_COLUMNS, RAW_TRIP_SCHEMA
from gantrylake.sources.storage import lines, plain, unpacked

#: The verdict on a file that was read to its end.
SOUND = "sound"
NAMES = ["file_name", "line", "verdict"]

# --- fixed values: file name patterns, upper or lower case --------------------------------
PACKED_FILES = "*.[cC][sS][vV].[gG][zZ]"
PLAIN_FILES = "*.[cC][sS][vV]"
ANY_FILES = "*.{[cC][sS][vV],[cC][sS][vV].[gG][zZ]}"


def is_index_header(columns: list[str] = RAW_TRIP_COLUMNS) -> Column:
    """True for the row ``0,1,2,…`` that some files carry in place of a header."""
    return reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(str(i)) for i, c in enumerate(columns)))


def read_trips(spark: SparkSession, path: str | list[str], files: str = ANY_FILES, tolerant: bool = False) -> DataFrame:
    """All trip files below a folder, one text column per field.

    Short rows are padded with NULL, fields past the eighth are dropped. A damaged file fails the job;
    with ``tolerant`` its readable part is returned, and whoever asks must leave the rows of
    :func:`damaged_files` out; :func:`read_checked` gives rows and verdicts from one read. Plain text splits by block, gzip is one task per file.
    """
    raw = (
        spark.read.schema(RAW_TRIP_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", files)
        .option("ignoreCorruptFiles", str(tolerant).lower())
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return raw.where(~is_index_header())


def read_trip_months(spark: SparkSession, root: str, months: list[str] | None = None, files: str = ANY_FILES) -> DataFrame:
    """Trip files under ``root/yyyymm=…/``, with the month as a text column.

    The month filter is on the partition column, so other months are never listed into the scan. Files of other
    names are left alone; a damaged file fails the job (see :func:`checked_trip_months`).
    """
    schema = T.StructType([*RAW_TRIP_SCHEMA.fields, T.StructField(PARTITION_KEY, T.StringType())])
    raw = spark.read.schema(schema).option("pathGlobFilter", files).csv(root)
    if months is not None:
        raw = raw.where(F.col(PARTITION_KEY).isin(months))
    return raw.where(~is_index_header())


def checked_trip_months(spark: SparkSession, root: str, months: list[str] | None = None, files: str = PACKED_FILES) -> DataFrame:
    """The same rows as :func:`read_checked` gives them, damaged files named by their closing row."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", files).load(root)
    month = F.col(PARTITION_KEY).cast("string")
    wanted = listing if months is None else listing.where(month.isin(months))
    checked = read_checked(wanted.select(F.col("_metadata.file_path").alias("file_name")))
    return checked.withColumn(PARTITION_KEY, F.regexp_extract("file_name", f"{PARTITION_KEY}=([^/]*)/", 1))


def stream_trips(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same rows as a stream that picks up files as they land."""
    reader = (
        spark.readStream.schema(RAW_TRIP_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", ANY_FILES)
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path).where(~is_index_header())


def with_file_name(raw: DataFrame, column: str = "file_name") -> DataFrame:
    """Tag rows with the full path of the file they were read from."""
    return raw.withColumn(column, F.col("_metadata.file_path"))


def file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None, files: str = ANY_FILES) -> DataFrame:
    """The files that land below a folder as a stream of their paths; contents are pruned from the scan."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", files)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select(F.col("path").alias("file_name"))


def file_list(spark: SparkSession, path: str | list[str], files: str = ANY_FILES) -> DataFrame:
    """Paths of the files below a folder, dealt to tasks by size; contents are pruned from the scan."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", files).load(path)
    return listing.select(F.col("_metadata.file_path").alias("file_name"))


def read_checked(files: DataFrame) -> DataFrame:
    """Trip rows of the listed files (column ``file_name``), with one closing row per file that holds its ``verdict``.

    Each file is read once, by the task that has its row, piece by piece, so its size does not matter. The verdict is
    ``sound``, or what stopped the reading; it stands on a row of its own, whose fields are NULL, and rows
    read before the damage was found come before it. Lines end at a line feed; blank lines are no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file_name").to_pylist():
                verdict = SOUND
                try:
                    for block in lines(unpacked(name) if name.lower().endswith(".gz") else plain(name)):
                        yield pa.record_batch(
                            [pa.array([name] * len(block), pa.string()), block.cast(pa.binary()), pa.nulls(len(block), pa.string())], NAMES
                        )
                except ValueError as damage:
                    verdict = str(damage)
                yield pa.record_batch([pa.array([name]), pa.nulls(1, pa.binary()), pa.array([verdict])], NAMES)

    rows = files.select("file_name").mapInArrow(read, "file_name string, line binary, verdict string")
    line = F.rtrim(F.col("line").cast("string"), F.lit("\r\n"))
    options = {"mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    schema = ", ".join(f"{name} string" for name in RAW_TRIP_COLUMNS)
    parsed = rows.select("file_name", "verdict", F.from_csv(line, schema, options).alias("trip"), (F.btrim(line) == "").alias("blank"))
    trips = parsed.where("verdict IS NOT NULL OR NOT blank").select("file_name", "verdict", "trip.*")
    return trips.where(~is_index_header())


def damaged_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file_name`` (full path) and ``reason`` of packed files that cannot be unpacked to their end."""
    checked = read_checked(file_list(spark, path, PACKED_FILES))
    return checked.where(F.col("verdict") != SOUND).select("file_name", F.col("verdict").alias("reason"))


def require_rows(raw: DataFrame) -> DataFrame:
    """Fail where a folder holds nothing to read; stops at the first row found."""
    if raw.isEmpty():
        raise FileNotFoundError("no trip rows found")
    return raw
