"""Readers with explicit schemas, junk-column handling and missing columns."""

import pytest

from tarmac.schemas import FLIGHT_CSV_SCHEMA, FLIGHT_SCHEMA
from tarmac.sources import files


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_read_flights_csv_drops_junk_column(spark, tmp_path):
    header = ",".join(f.name for f in FLIGHT_CSV_SCHEMA.fields)
    row = ["2019-01-05", "AA", "12", "ATL", "ORD", "930", "935", "5", "10", "", "", "", "1100",
           "1104", "4", "0", "", "0", "120", "119", "100", "606", "", "", "", "", "", ""]
    path = _write(tmp_path, "f.csv", header + "\n" + ",".join(row) + "\n")
    df = files.read_flights(spark, [path])
    assert df.columns == [f.name for f in FLIGHT_SCHEMA.fields]
    r = df.first()
    assert r.ORIGIN == "ATL" and r.DEP_DELAY == 5.0 and r.WEATHER_DELAY is None
    assert str(r.FL_DATE) == "2019-01-05" and r.CRS_DEP_TIME == 930


def test_read_fares_tolerates_missing_columns(spark, tmp_path):
    path = _write(tmp_path, "fare.csv", "YEAR,QUARTER,ORIGIN,ITIN_FARE,EXTRA\n2010,1,ATL,250.5,x\n")
    df = files.read_fares(spark, path)
    r = df.first()
    assert (r.YEAR, r.QUARTER, r.ORIGIN, r.ITIN_FARE) == (2010, 1, "ATL", 250.5)
    assert r.ITIN_YIELD is None and "EXTRA" not in df.columns


def test_read_weather_casts_dates(spark, tmp_path):
    path = _write(tmp_path, "w.csv", "STATION,NAME,DATE,PRCP,TMAX\nS1,ATLANTA,2012-03-04,0.25,71\n")
    r = files.read_weather(spark, path).first()
    assert str(r.DATE) == "2012-03-04" and r.PRCP == 0.25 and r.TMAX == 71.0 and r.SNOW is None


def test_empty_path_list_raises(spark):
    with pytest.raises(ValueError):
        files.read_flights(spark, [])


def test_drop_and_select_existing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `Unnamed: 27` int")
    assert files.drop_if_present(df, "Unnamed: 27", "zzz").columns == ["a"]
    assert files.select_existing(df, ["zzz", "a"]).columns == ["a"]


def test_parquet_round_trip(spark, tmp_path):
    from tarmac.sources import testviews
    df = testviews.flights(spark, "/root/testdata/sf0.001")
    out = str(tmp_path / "flights")
    df.write.parquet(out)
    back = files.read_flights(spark, [out], fmt="parquet")
    assert back.count() == df.count()
    assert back.columns == [f.name for f in FLIGHT_SCHEMA.fields]


def test_metrics_if_exists(spark, tmp_path):
    assert files.read_metrics_if_exists(spark, str(tmp_path / "none")) is None
    p = str(tmp_path / "m")
    spark.createDataFrame([(1.0, 2.0, 0.5)], "rmse double, mae double, r2 double").write.json(p)
    assert files.read_metrics_if_exists(spark, p).first().rmse == 1.0


def test_convert_csv_partitions_by_year(spark, tmp_path):
    from tarmac.sources.convert import convert_csv
    header = ",".join(f.name for f in FLIGHT_CSV_SCHEMA.fields)
    rows = []
    for date in ("2018-12-31", "2019-01-01"):
        r = [date, "AA", "1", "ATL", "ORD", "900"] + [""] * 22
        rows.append(",".join(r))
    path = _write(tmp_path, "f.csv", header + "\n" + "\n".join(rows) + "\n")
    out = str(tmp_path / "pq")
    convert_csv(spark, "flights", [path], out)
    back = spark.read.parquet(out)
    assert sorted(r.part_year for r in back.select("part_year").collect()) == [2018, 2019]
    for read in (files.read_flights(spark, out, "parquet", years=(2019, 2019)),
                 files.read_flights(spark, out, "parquet").where("part_year = 2019")):
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "part_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert [str(r.FL_DATE) for r in read.collect()] == ["2019-01-01"]


def test_read_saved_report(spark, tmp_path):
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    schema = StructType([StructField("ORIGIN", StringType()), StructField("avg", DoubleType())])
    assert files.read_saved_report(spark, str(tmp_path / "none"), schema=schema).count() == 0
    assert files.read_saved_report(spark, str(tmp_path / "none")) is None
    p = str(tmp_path / "r")
    spark.createDataFrame([("A", None), ("B", 2.0)], schema).write.parquet(p)
    got = {r.ORIGIN: r.avg for r in files.read_saved_report(spark, p).collect()}
    assert got == {"A": 0.0, "B": 2.0}


def test_read_flights_by_header_name(spark, tmp_path):
    text = ("DEST,ORIGIN,FL_DATE,DEP_DELAY,EXTRA,OP_CARRIER\n"
            "ORD,ATL,2015-07-04,12.5,zzz,DL\n"
            "JFK,BOS,not-a-date,oops,zzz,B6\n")
    df = files.read_flights(spark, _write(tmp_path, "f2.csv", text))
    rows = {r.ORIGIN: r for r in df.collect()}
    assert rows["ATL"].DEST == "ORD" and rows["ATL"].DEP_DELAY == 12.5
    assert str(rows["ATL"].FL_DATE) == "2015-07-04" and rows["ATL"].DISTANCE is None
    # malformed values become null instead of failing the job
    assert rows["BOS"].FL_DATE is None and rows["BOS"].DEP_DELAY is None


def test_convert_keeps_fare_year_and_batches(spark, tmp_path):
    from tarmac.operators.fares import repair_fare_scale
    from tarmac.sources.convert import convert_csv
    rows = "".join(f"2015,1,ATL,{3.9 + i / 100},0.01,500\n" for i in range(11))
    path = _write(tmp_path, "fares.csv", "YEAR,QUARTER,ORIGIN,ITIN_FARE,ITIN_YIELD,DISTANCE\n" + rows + "bad,1,ATL,x,,\n")
    out = str(tmp_path / "pq")
    bad = convert_csv(spark, "fares", path, out)
    assert bad["YEAR"] == 1 and bad["ITIN_FARE"] == 1 and bad["ORIGIN"] == 0
    back = files.read_fares(spark, out, "parquet", with_file=True)
    assert {r.YEAR for r in back.collect()} == {2015, None}
    assert {r.source_file.rsplit("/", 1)[1] for r in back.collect()} == {"fares.csv"}
    repaired = repair_fare_scale(back, ("source_file",)).where("YEAR = 2015")
    assert round(repaired.agg({"ITIN_FARE": "avg"}).first()[0], 2) == 395.0


def test_each_file_by_its_own_header(spark, tmp_path):
    a = _write(tmp_path, "a.csv", "ORIGIN,DEST,FL_DATE\nATL,ORD,2015-07-04\n")
    b = _write(tmp_path, "b.csv", "dest,origin,fl_date,DEP_DELAY\nSFO,LAX,2015-07-05,4\n")
    got = {(r.ORIGIN, r.DEST, str(r.FL_DATE), r.DEP_DELAY) for r in files.read_flights(spark, [a, b]).collect()}
    assert got == {("ATL", "ORD", "2015-07-04", None), ("LAX", "SFO", "2015-07-05", 4.0)}


def test_absent_key_or_clashing_columns_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="DEST"):
        files.read_flights(spark, _write(tmp_path, "a.csv", "ORIGIN,FL_DATE\nATL,2015-07-04\n"))
    with pytest.raises(ValueError, match="clash"):
        files.read_flights(spark, _write(tmp_path, "b.csv", "ORIGIN,origin,DEST,FL_DATE\nA,B,C,2015-07-04\n"))
    with pytest.raises(FileNotFoundError):
        files.read_flights(spark, str(tmp_path / "none*.csv"))


def test_quarantine_holds_what_is_not_kept(spark, tmp_path):
    from tarmac.sources.convert import convert_csv
    good = "ORIGIN,DEST,FL_DATE,DEP_DELAY\nATL,ORD,2015-07-04,1.5\nATL,SFO,someday,x\nBOS,SFO,2015-07-05,\n"
    _write(tmp_path, "a.csv", good)
    _write(tmp_path, "b.csv", "dest,origin,fl_date,quarantined_values\nSFO,LAX,2015-07-06,own\n")
    _write(tmp_path, "c.csv", "ORIGIN,FL_DATE\nATL,2015-07-04\n")
    _write(tmp_path, "d.csv", "")
    out = str(tmp_path / "table")
    report = convert_csv(spark, "flights", str(tmp_path / "*.csv"), out, quarantine=True)
    assert (report["rows"], report["kept"], report["quarantined"], report["unreadable_files"]) == (4, 3, 1, 1)
    assert report["DEP_DELAY"] == 1 and report["FL_DATE"] == 1
    back = files.read_flights(spark, out, "parquet")
    assert {r.ORIGIN for r in back.collect()} == {"ATL", "BOS", "LAX"} and back.count() == 3
    assert files.QUARANTINED not in back.columns
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "quarantined" in plan.split("PartitionFilters: [")[1].split("]")[0]
    aside = {(r.file.rsplit("/", 1)[1], r.column, r.text, r.reason): r.row
             for r in files.read_quarantine(spark, out).collect()}
    assert set(aside) == {("a.csv", "FL_DATE", "someday", "not date"), ("a.csv", "DEP_DELAY", "x", "not double"),
                          ("c.csv", None, None, "no column DEST")}
    assert '"DEST":"SFO"' in aside["a.csv", "FL_DATE", "someday", "not date"]
    plain = str(tmp_path / "plain")
    convert_csv(spark, "flights", [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], plain)
    assert files.read_flights(spark, plain, "parquet").count() == 4
    assert files.read_quarantine(spark, plain).count() == 0


def test_headers_of_many_files_are_read_by_tasks(spark, tmp_path):
    land = tmp_path / "land"
    for i in range(2000):
        folder = land / f"day={i % 7}"
        folder.mkdir(parents=True, exist_ok=True)
        names = ["ORIGIN", "DEST", "FL_DATE"][:: 1 if i % 3 else -1]
        (folder / f"f{i}.csv").write_text(",".join(names) + "\n" + "x,y,z\n" * 3)
    headers = files._csv_headers(spark, [str(land)])
    assert {h: len(names) for h, names in headers.items()} == {
        ("ORIGIN", "DEST", "FL_DATE"): 1333, ("FL_DATE", "DEST", "ORIGIN"): 667}
    assert len({n for names in headers.values() for n in names}) == 2000
    # the shared session keeps its own settings
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(1 << 60)


def test_first_line_of_large_and_packed_files(spark, tmp_path, monkeypatch):
    import gzip
    monkeypatch.setattr(files, "SMALL_FILE", 1 << 20)
    (tmp_path / "big.csv").write_text("FL_DATE,ORIGIN,DEST\n" + "2015-07-04,ATL,ORD\n" * 400_000)
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write("﻿DEST,ORIGIN,FL_DATE\nORD,ATL,2015-07-04\n")
    headers = files._csv_headers(spark, [str(tmp_path)])
    assert set(headers) == {("FL_DATE", "ORIGIN", "DEST"), ("DEST", "ORIGIN", "FL_DATE")}
    assert files.read_flights(spark, str(tmp_path)).where("DEST = 'ORD'").count() == 400_001
