"""Convert the raw CSV drops to parquet once.

CSV is row-based and re-parsed by every job; parquet gives column pruning,
predicate pushdown and vectorized reads. Tables are written partitioned by
``part_year`` (a name no source column has), so year filters prune whole folders;
fares keep the file each row came from, the batch of the scale repair.

With a quarantine, rows with malformed values and files that cannot be read are set
aside instead: they go to a folder level of their own in the same table and the same
write, so the files are read once, and the readers prune that level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarmac.sources.files import (MALFORMED, PART_YEAR, QUARANTINED, RECORD, SCHEMAS, SOURCE_FILE, _conform,
                                  _csv_headers, _csv_parts, _faulty, _paths, any_malformed,
                                  malformed_counts, malformed_values, row_year, with_typed)

#: What a quarantined row has beside the columns of its table.
ASIDE = f"{RECORD} string, {MALFORMED} array<struct<column:string,text:string,reason:string>>"


def partition_column(kind: str, df: DataFrame) -> DataFrame:
    return df.withColumn(PART_YEAR, row_year(kind))


def _bad_files(spark: SparkSession, kind: str, bad: dict[str, str]) -> DataFrame:
    """One quarantined row for each unreadable file."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCHEMAS[kind].fields)
    rows = [(*[None] * len(SCHEMAS[kind].fields), file, 1, None, [(None, None, reason)])
            for file, reason in bad.items()]
    return spark.createDataFrame(rows, f"{columns}, {SOURCE_FILE} string, {QUARANTINED} int, {ASIDE}")


def convert_csv(spark: SparkSession, kind: str, paths, out_dir: str, quarantine: bool = False) -> dict[str, int]:
    """Read one kind of CSV drop with its explicit schema and write parquet by year.

    Returns, for each column, how many values were malformed; they are counted while
    the rows are written, without another pass. By default they become null. With
    ``quarantine`` their rows are set aside (``read_quarantine`` gives them with the text and
    the reason), and so are files without a readable header; the result then also has
    ``rows``, ``kept``, ``quarantined`` and ``unreadable_files``.
    """
    files = _paths(paths)
    headers, bad_files = _csv_headers(spark, files), {}
    if quarantine:
        faults = {h: _faulty(h, kind) for h in headers}
        bad_files = {f: faults[h] for h, names in headers.items() if faults[h] for f in names}
        headers = {h: names for h, names in headers.items() if not faults[h]}
        if not headers:
            raise ValueError(f"no readable file: {bad_files}")
    observed, df = [], None
    for raw in _csv_parts(spark, files, quarantine or kind == "fares", headers):
        seen, record = Observation(), [f"`{c}`" for c in raw.columns if c != SOURCE_FILE]
        raw = with_typed(kind, raw)
        counts = [agg.alias(n) for n, agg in malformed_counts(kind, raw).items()]
        bad = any_malformed(kind, raw)
        if quarantine:
            counts += [F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("quarantined")]
        part = _conform(raw.observe(seen, *counts).withColumns({
            QUARANTINED: bad.cast("int"),
            RECORD: F.when(bad, F.to_json(F.struct(*record))),
            MALFORMED: F.when(bad, malformed_values(kind, raw))} if quarantine else {}), kind,
            lambda col, t: col.try_cast(t), ", ".join(files))
        df = part if df is None else df.unionByName(part)
        observed.append(seen)
    if bad_files:
        df = df.unionByName(_bad_files(spark, kind, bad_files))
    # No shuffle: the source files are monthly or yearly, so each input split
    # (spark.sql.files.maxPartitionBytes) writes into one or two year folders.
    # Hash-repartitioning by year would leave one task per year (a handful
    # of tasks each writing terabytes); the files per year are bounded by the
    # split count and maxRecordsPerFile instead.
    levels = [QUARANTINED, PART_YEAR] if quarantine else [PART_YEAR]
    (partition_column(kind, df).write.mode("overwrite").partitionBy(*levels)
     .option("maxRecordsPerFile", 5_000_000).parquet(out_dir))
    bad: dict[str, int] = {}
    for seen in observed:
        for name, n in seen.get.items():
            bad[name] = bad.get(name, 0) + n
    if quarantine:
        bad |= {"kept": bad["rows"] - bad["quarantined"], "unreadable_files": len(bad_files)}
    return bad
