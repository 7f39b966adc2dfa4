"""Readers for the flight, fare and weather files (SRC-1..5, SRC-8..10).

Every reader returns the table's explicit schema (no inference pass). Columns are
matched by name, case ignored: CSV files are grouped by their own header line first,
since Spark would apply one header to all files of a read. A file without
a key column of its table is an error; other absent columns become typed nulls.
CSV values are converted with ``try_cast``; ``malformed_counts`` says how many
values that turns into nulls, and ``malformed_values`` which. Pruning and pushdown are left
to Catalyst: operators select what they use, so ``ReadSchema`` lists the used columns alone.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.schemas import FARE_SCHEMA, FLIGHT_SCHEMA, REQUEST_SCHEMA, WEATHER_SCHEMA

JUNK_COLUMN = "Unnamed: 27"
#: Partition column of converted tables; kept by the readers so that filters on it prune folders.
PART_YEAR = "part_year"
#: The file a fare row came from: one file is one batch of the scale repair.
SOURCE_FILE = "source_file"

#: Files below as many bytes are read through for their header line.
SMALL_FILE = 8 << 20
#: Partition column of tables converted with a quarantine: 1 for rows with malformed values, else 0.
QUARANTINED = "quarantined"
#: Beside them the record as it was read, and what is wrong with it.
RECORD, MALFORMED = "quarantined_record", "quarantined_values"
#: Prefix of the columns that hold the converted texts (``with_typed``).
TYPED = "_typed_"

KEY_COLUMNS = {
    "flights": ("FL_DATE", "ORIGIN", "DEST"),
    "fares": ("YEAR", "QUARTER", "ORIGIN", "ITIN_FARE"),
    "weather": ("NAME", "DATE"),
    "requests": ("ORIGIN", "DEST", "travel_date"),
}
SCHEMAS = {"flights": FLIGHT_SCHEMA, "fares": FARE_SCHEMA, "weather": WEATHER_SCHEMA, "requests": REQUEST_SCHEMA}


def _paths(paths: str | Iterable[str]) -> list[str]:
    out = [paths] if isinstance(paths, str) else list(paths)
    if not out:
        # SRC-10: the reference stops when no input file matches.
        raise ValueError("no input files given")
    return out


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    """SRC-4: drop columns that exist; a no-op for absent ones."""
    present = [n for n in names if n in df.columns]
    return df.drop(*present) if present else df


def select_existing(df: DataFrame, needed: Iterable[str]) -> DataFrame:
    """SRC-5: projection that tolerates missing columns."""
    return df.select([F.col(f"`{c}`") for c in needed if c in df.columns])


def _named(columns: Iterable[str], where: str) -> dict[str, str]:
    """Lower-cased column name -> column; two columns that differ in case only are an error."""
    out: dict[str, str] = {}
    for column in columns:
        if out.setdefault(column.strip().lower(), column) != column:
            raise ValueError(f"{where}: columns {out[column.strip().lower()]!r} and {column!r} clash")
    return out


def _conform(df: DataFrame, kind: str, cast, where: str) -> DataFrame:
    """Select the table schema's columns by name, whatever their case and order."""
    have = _named(df.columns, where)
    missing = [k for k in KEY_COLUMNS[kind] if k.lower() not in have]
    if missing:
        raise ValueError(f"{where}: no column {', '.join(missing)} among "
                         + ", ".join(c for c in df.columns if not c.startswith(TYPED)))
    carried = [c for c in (PART_YEAR, SOURCE_FILE, QUARANTINED, RECORD, MALFORMED) if c in df.columns]
    return df.select([
        (F.col(f"`{TYPED}{f.name}`") if f"{TYPED}{f.name}" in df.columns
         else cast(F.col(f"`{have[f.name.lower()]}`"), f.dataType) if f.name.lower() in have
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in SCHEMAS[kind].fields
    ] + carried)


def _split_files(spark: SparkSession) -> SparkSession:
    """A session that plans one partition for each split of a file."""
    split = spark.newSession()
    for name, value in {"spark.sql.files.openCostInBytes": str(1 << 60),
                        "spark.sql.files.minPartitionNum": "1"}.items():
        split.conf.set(name, value)
    return split


def _first_lines(spark: SparkSession, paths: list[str]) -> list[tuple[str, str]]:
    """(file, first line) of every file of ``paths``, read by tasks; the driver opens no file.

    Files below ``SMALL_FILE`` bytes are packed and read through. Of larger ones every split is
    a partition, and the first row of the split at byte 0 is kept: the scan runs in the JVM
    and no task reads more than one split. Either plan lists its files alone.
    """
    def lines(session: SparkSession) -> DataFrame:
        return session.read.option("recursiveFileLookup", True).text(paths)

    file, size = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size")
    start = F.col("_metadata.file_block_start")
    small = lines(spark).where((size < SMALL_FILE) & (start == 0)) \
        .select(file, "value", F.monotonically_increasing_id().alias("at")) \
        .groupBy("file").agg(F.min_by("value", "at").alias("value"))
    # the lower 33 bits number the rows of a partition
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    large = lines(_split_files(spark)).where(size >= SMALL_FILE) \
        .select(file, "value", start.alias("start"), row.alias("row")) \
        .where("row = 0 and start = 0").select("file", "value")
    return [tuple(r) for part in (small, large) for r in part.collect()]


def _csv_headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Header -> the files that have it."""
    try:
        lines = _first_lines(spark, paths)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no file matches {', '.join(paths)}") from e
        raise
    if not lines:
        raise ValueError(f"no header line in {', '.join(paths)}")
    jvm = spark.sparkContext._jvm
    by_line: dict[str, list[str]] = {}
    for file, line in sorted(lines):
        by_line.setdefault(line.lstrip("\ufeff"), []).append(file)
    groups: dict[tuple[str, ...], list[str]] = {}
    for line, names in by_line.items():
        parsed = jvm.com.univocity.parsers.csv.CsvParser(
            jvm.com.univocity.parsers.csv.CsvParserSettings()).parseLine(line)
        # pandas writes an empty name for a trailing column
        header = tuple((n or "").strip() or f"_c{i}" for i, n in enumerate(parsed or []))
        groups.setdefault(header, []).extend(names)
    return groups


def _faulty(header: tuple[str, ...], kind: str) -> str | None:
    """Why files with this header cannot be read as ``kind``; ``None`` if they can."""
    try:
        have = _named(header, "header")
    except ValueError as e:
        return str(e)
    missing = [k for k in KEY_COLUMNS[kind] if k.lower() not in have]
    return f"no column {', '.join(missing)}" if missing else None


def _csv_parts(spark: SparkSession, paths: list[str], with_file: bool,
               headers: dict[tuple[str, ...], list[str]] | None = None) -> list[DataFrame]:
    """One DataFrame of texts per distinct header."""
    parts = []
    for header, group in (headers or _csv_headers(spark, paths)).items():
        _named(header, group[0])
        names = StructType([StructField(n, StringType()) for n in header])
        raw = spark.read.option("header", True).schema(names).csv(group)
        if with_file:
            raw = raw.select("*", F.col("_metadata.file_path").alias("_file"))
        # names that the readers give columns of their own
        own = {PART_YEAR, SOURCE_FILE, QUARANTINED, RECORD.lower(), MALFORMED.lower()}
        raw = drop_if_present(raw, JUNK_COLUMN, *[n for n in header if n.lower() in own])
        parts.append(raw.withColumnRenamed("_file", SOURCE_FILE) if with_file else raw)
    return parts


def _read(spark: SparkSession, paths, fmt: str, kind: str, years: tuple[int, int] | None = None,
          with_file: bool = False) -> DataFrame:
    files = _paths(paths)
    if fmt == "csv":
        parts = [_conform(raw, kind, lambda col, t: col.try_cast(t), ", ".join(files))
                 for raw in _csv_parts(spark, files, with_file)]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
    elif fmt == "parquet":
        raw = spark.read.parquet(*files)
        if QUARANTINED in raw.columns:  # a folder level: what was set aside is not read
            raw = raw.where(F.col(QUARANTINED) == 0).drop(QUARANTINED, RECORD, MALFORMED)
        if with_file and SOURCE_FILE not in raw.columns:
            raw = raw.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
        out = _conform(drop_if_present(raw, JUNK_COLUMN), kind, lambda col, t: col.cast(t), ", ".join(files))
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    if years is not None:
        if PART_YEAR in out.columns:
            out = out.where(F.col(PART_YEAR).between(*years))
        else:
            out = out.where(row_year(kind).between(*years))
    return out


def row_year(kind: str):
    """The year a row belongs to."""
    return {"flights": F.year("FL_DATE"), "weather": F.year("DATE"), "fares": F.col("YEAR")}[kind]


def with_typed(kind: str, raw: DataFrame) -> DataFrame:
    """``raw`` with every text that needs conversion converted once, for counts, checks and the table alike."""
    have = _named(raw.columns, kind)
    return raw.withColumns({
        f"{TYPED}{f.name}": F.col(f"`{have[f.name.lower()]}`").try_cast(f.dataType)
        for f in SCHEMAS[kind].fields if f.name.lower() in have and not isinstance(f.dataType, StringType)})


def _malformed(kind: str, raw: DataFrame) -> dict[str, tuple[Column, Column, str]]:
    """Column -> (whether its text is malformed, the text, the type it should have)."""
    have = _named(raw.columns, kind)
    out = {}
    for f in SCHEMAS[kind].fields:
        if f.name.lower() in have:
            text = F.col(f"`{have[f.name.lower()]}`")
            typed = f"{TYPED}{f.name}"
            value = F.col(f"`{typed}`") if typed in raw.columns else text.try_cast(f.dataType)
            out[f.name] = (text.isNotNull() & value.isNull(), text, f.dataType.simpleString())
    return out


def malformed_counts(kind: str, raw: DataFrame) -> dict[str, Column]:
    """Column -> aggregate counting texts that ``try_cast`` turns into null."""
    return {name: F.count_if(bad) for name, (bad, _, _) in _malformed(kind, raw).items()}


def any_malformed(kind: str, raw: DataFrame) -> Column:
    """Whether a row has a malformed value."""
    return functools.reduce(lambda a, b: a | b, [bad for bad, _, _ in _malformed(kind, raw).values()])


def malformed_values(kind: str, raw: DataFrame) -> Column:
    """The malformed values of a row: array of (column, text, reason), empty for a good row."""
    return F.filter(F.array(*[
        F.when(bad, F.struct(F.lit(name).alias("column"), text.alias("text"), F.lit(f"not {kind_}").alias("reason")))
        for name, (bad, text, kind_) in _malformed(kind, raw).items()]), lambda v: v.isNotNull())


def read_quarantine(spark: SparkSession, table: str) -> DataFrame:
    """``file, row, column, text, reason`` of what ``convert_csv`` set aside beside ``table``.

    One row per malformed value; ``row`` is the whole record as JSON, so that it can be
    corrected and converted again. A file that could not be read at all has one row with
    its reason alone.
    """
    raw = spark.read.parquet(table)
    if QUARANTINED not in raw.columns:
        return spark.createDataFrame([], "file string, row string, column string, text string, reason string")
    return raw.where(F.col(QUARANTINED) == 1).select(F.col(SOURCE_FILE).alias("file"), F.col(RECORD).alias("row"),
                                         F.explode(MALFORMED).alias("v")).select("file", "row", "v.*")


def read_flights(spark: SparkSession, paths, fmt: str = "csv",
                 years: tuple[int, int] | None = None) -> DataFrame:
    """SRC-1: on-time performance files -> one flights DataFrame."""
    return _read(spark, paths, fmt, "flights", years)


def read_fares(spark: SparkSession, paths, fmt: str = "csv", years: tuple[int, int] | None = None,
               with_file: bool = False) -> DataFrame:
    """SRC-2: fare itinerary files -> one fares DataFrame.

    ``with_file`` adds the column ``source_file``, the batch key of the scale repair.
    """
    return _read(spark, paths, fmt, "fares", years, with_file)


def read_weather(spark: SparkSession, paths, fmt: str = "csv",
                 years: tuple[int, int] | None = None) -> DataFrame:
    """SRC-3: daily station files -> one weather DataFrame."""
    return _read(spark, paths, fmt, "weather", years)


def read_requests(spark: SparkSession, paths, fmt: str = "csv") -> DataFrame:
    """RAM-7: files of route requests (ORIGIN, DEST, travel_date); an unreadable date is null."""
    return _read(spark, paths, fmt, "requests").select(*[f.name for f in REQUEST_SCHEMA.fields])


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its (Hadoop) file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def read_metrics_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """SRC-9: a saved metrics table, or None when it was never written."""
    if not path_exists(spark, path):
        return None
    return spark.read.json(path)


def read_saved_report(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None,
                      columns: Iterable[str] | None = None) -> DataFrame | None:
    """SRC-8: a report saved by an earlier run, missing numbers as 0.

    ``columns``: those to take, as far as the report has them (an older run may not).

    A report that was never written gives an empty DataFrame of ``schema``
    (or None without one) instead of failing, so a later step can still
    assemble what exists.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema) if schema is not None else None
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    report = reader.load(path).na.fill(0)
    return report if columns is None else select_existing(report, columns)


__all__ = ["drop_if_present", "select_existing", "read_flights", "read_fares", "read_weather",
           "read_requests", "read_metrics_if_exists", "read_saved_report", "read_quarantine", "path_exists"]
