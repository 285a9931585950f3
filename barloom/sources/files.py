"""Daily bar files and the small CSV inputs. Schemas are explicit, never inferred."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..arguments import day
from .. import schemas as S

# The day a file belongs to: the last YYYY-MM-DD in its path (file or folder name).
# Anchored: in a path without a day the search would else begin anew at each of its letters.
_DAY_IN_PATH = r"^.*(\d{4}-\d{2}-\d{2})"


def ingest_order() -> Column:
    """Position of a row in its input: day, file, block within the file, row within the block.

    Must be taken at the scan, before any shuffle. A partition that is read again
    after an executor loss gives the same values.
    """
    return F.struct(
        file_day().alias("day"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def file_day() -> Column:
    return F.try_to_date(F.regexp_extract("_metadata.file_path", _DAY_IN_PATH, 1), "yyyy-MM-dd")


def malformed_line(columns) -> Column:
    """The text of a line that does not fit.

    The reader only parses the columns that a plan asks for, and a line is malformed by what it
    parses. A hash of all of them, which every number exceeds or equals, asks for all in any plan.
    """
    return F.when(F.hash(*columns) >= F.lit(-(1 << 31)), F.col("malformed"))


def _bar_lines(reader, path) -> DataFrame:
    """Every line of the bar files."""
    return (
        reader.schema(S.BAR_LINE)
        .option("columnNameOfCorruptRecord", "malformed")
        .option("pathGlobFilter", "*.txt")
        .option("recursiveFileLookup", "true")
        .option("dateFormat", "yyyyMMdd")
        .csv(path)
    )


def _whole_volume() -> dict[str, Column]:
    """The volume as a whole number; a line whose volume is none is malformed as well."""
    volume = F.col("volume").try_cast("bigint")
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in S.BAR])
    odd = F.col("volume").isNotNull() & volume.isNull()
    return {"volume": volume, "malformed": F.coalesce(malformed_line(S.BAR), F.when(odd, line))}


def read_bar_lines(spark: SparkSession, path, start_year=None, start_date=None) -> DataFrame:
    """Headerless `*.txt` bar files, whole years from `start_year` or days from `start_date`.

    A line with a number or date that does not parse, or with too few or many fields, has its
    text in `malformed`. The day condition only uses file metadata, so files outside it are not
    opened.
    """
    raw = _bar_lines(spark.read, path)
    of_file = file_day()
    if start_year is not None:
        raw = raw.where(F.year(of_file) >= int(start_year))
    if start_date is not None:
        raw = raw.where(of_file >= day(start_date))
    raw = raw.select(*S.BAR, of_file.alias("file_day"), ingest_order().alias("seq"), "malformed")
    return raw.withColumns(_whole_volume())


def read_bar_files(spark: SparkSession, path, start_year=None, start_date=None) -> DataFrame:
    """The well-formed rows of `read_bar_lines`."""
    return read_bar_lines(spark, path, start_year, start_date).where("malformed is null").drop("malformed")


def stream_bar_files(spark: SparkSession, path, start_date=None, max_files=None) -> DataFrame:
    """The same scan as an incremental file stream, malformed lines included."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = _bar_lines(reader, path)
    of_file = file_day()
    if start_date is not None:
        raw = raw.where(of_file >= day(start_date))
    return raw.select(
        *S.BAR,
        "malformed",
        of_file.alias("file_day"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def shape_batch(batch: DataFrame) -> DataFrame:
    """A micro-batch of the stream in the shape of `read_bar_lines`."""
    row = F.monotonically_increasing_id().alias("row")
    place = F.struct(F.col("file_day").alias("day"), "file", "block", row).alias("seq")
    return batch.select(*S.BAR, "file_day", place, "malformed").withColumns(_whole_volume())


def _csv(spark, path, schema, **options) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("dateFormat", "yyyyMMdd")
        .options(**options)
        .csv(path)
        .select("*", ingest_order().alias("pos"))
    )


def read_pairs(spark, path) -> DataFrame:
    """One of the two files of reviewed replacements; a line that does not fit is in `malformed`."""
    lines = _csv(spark, path, S.PAIR_FILE, columnNameOfCorruptRecord="malformed").withColumnRenamed("pos", "seq")
    return lines.withColumn("malformed", malformed_line(["pair", *S.BAR]))


def read_renames(spark, path) -> DataFrame:
    return _csv(spark, path, S.RENAMES)


def read_multipliers(spark, path) -> DataFrame:
    return _csv(spark, path, S.MULTIPLIERS).withColumnRenamed("pos", "seq")


def read_index_feed(spark, path) -> DataFrame:
    """One or several CSV landings (a list of paths), stacked into one scan."""
    return _csv(spark, path, S.INDEX_FEED).withColumnRenamed("pos", "seq")


def read_scrip_map(spark, path) -> DataFrame:
    return _csv(spark, path, S.SCRIP_MAP)


def read_manual_fixes(spark, path) -> DataFrame:
    """The file is in the Windows code page, which Spark's CSV reader does not list.

    It equals Latin-1 but for the bytes 0x80 to 0x9f, which are translated after reading.
    """
    special = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]
    special = [(latin, windows) for latin, windows in special if windows]
    latin, windows = ("".join(side) for side in zip(*special))
    raw = _csv(spark, path, S.MANUAL_FIX, encoding="iso-8859-1")
    return raw.withColumns({c: F.translate(c, latin, windows) for c in ("symbol", "correct_symbol")})


def read_index_current(spark, path) -> DataFrame:
    return _csv(spark, path, S.INDEX_CURRENT).drop("pos")
