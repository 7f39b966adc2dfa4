"""Streaming ingestion: summaries merged over micro-batches equal the batch reports."""

import os

from pyspark.sql import functions as F

from tarmac.plans import summary as sm
from tarmac.plans.catalog import FIX, queries
from tarmac.testing.compare import _rows_hash

SF = "/root/testdata/sf0.01"


def test_stream_summary_equals_batch(spark, tmp_path):
    from tarmac.sources import testviews as tv
    from tarmac.streaming.ingest import merged_summary, start_summary_stream
    flights = tv.flights(spark, SF).drop("ROW_KEY")
    src = str(tmp_path / "landing")
    # three "monthly" drops of files
    for i, (lo, hi) in enumerate([(1, 4), (5, 8), (9, 12)]):
        (flights.where(F.month("FL_DATE").between(lo, hi))
         .write.mode("overwrite").parquet(os.path.join(src, f"drop{i}")))
    # the file source reads files under the folder; point it at all drops
    query = start_summary_stream(spark, os.path.join(src, "*"), str(tmp_path / "summary"),
                                 max_files_per_trigger=1)
    query.awaitTermination(300)
    assert query.exception() is None
    merged = merged_summary(spark, str(tmp_path / "summary"))
    batches = spark.read.parquet(str(tmp_path / "summary" / "deltas")).select("batch_id").distinct()
    assert batches.count() >= 3

    for name, df in {**sm.delay_reports(merged, FIX), **sm.traffic_reports(merged)}.items():
        direct = queries()[name](spark, SF)
        h1, _ = _rows_hash(df.columns, [tuple(r) for r in df.collect()])
        h2, _ = _rows_hash(direct.columns, [tuple(r) for r in direct.collect()])
        assert h1 == h2, name


def test_stream_reads_csv_drops(spark, tmp_path):
    from tarmac.schemas import FLIGHT_CSV_SCHEMA
    from tarmac.streaming.ingest import merged_summary, start_summary_stream
    header = ",".join(f.name for f in FLIGHT_CSV_SCHEMA.fields)
    land = tmp_path / "landing"
    land.mkdir()
    for i, date in enumerate(["2019-01-05", "2019-02-06"]):
        row = [date, "AA", "12", "ATL", "ORD", "930", "935", "5", "10", "", "", "", "1100",
               "1104", "4", "0", "", "0", "120", "119", "100", "606", "", "", "", "", "", ""]
        (land / f"m{i}.csv").write_text(header + "\n" + ",".join(row) + "\n")
    q = start_summary_stream(spark, str(land), str(tmp_path / "summary"), fmt="csv")
    q.awaitTermination(300)
    assert q.exception() is None
    s = merged_summary(spark, str(tmp_path / "summary"))
    routes = s.where("gid = 3").collect()
    assert len(routes) == 1 and routes[0].n == 2 and routes[0].dep_sum == 10.0


RUN = """
import sys
sys.path.insert(0, {root!r})
from tarmac.session import get_spark
from tarmac.streaming.ingest import compact, merged_summary, start_summary_stream
spark = get_spark("local[2]", "ingest", {{"spark.checkpoint.dir": {ckpt!r}, "spark.sql.shuffle.partitions": "2"}})
q = start_summary_stream(spark, {land!r}, {table!r}, fmt="csv")
q.awaitTermination(200)
assert q.exception() is None
print("N", sum(r.n for r in merged_summary(spark, {table!r}).where("gid = 3").collect()))
compact(spark, {table!r})
print("N", sum(r.n for r in merged_summary(spark, {table!r}).where("gid = 3").collect()))
spark.stop()
"""


def test_two_applications_ingest_each_file_once(tmp_path):
    import subprocess
    import sys
    land = tmp_path / "landing"
    land.mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = RUN.format(root=root, ckpt=str(tmp_path / "ckpt"), land=str(land), table=str(tmp_path / "summary"))
    seen = []
    for i, files in enumerate((["a", "b"], ["c"])):
        for name in files:  # each file with a column order of its own
            order = ["DEST", "ORIGIN", "FL_DATE", "DEP_DELAY"][:: 1 if name == "a" else -1]
            row = {"DEST": "ORD", "ORIGIN": "ATL", "FL_DATE": "2019-01-05", "DEP_DELAY": "5"}
            (land / f"{name}.csv").write_text(",".join(order) + "\n" + ",".join(row[c] for c in order) + "\n")
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=250, cwd=root)
        assert out.returncode == 0, out.stderr[-2000:]
        seen.append([line for line in out.stdout.splitlines() if line.startswith("N ")])
    assert seen == [["N 2", "N 2"], ["N 3", "N 3"]]
