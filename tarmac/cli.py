"""Command line: the batch jobs (convert, reports, models) and ingestion.

    python -m tarmac.cli convert  --kind flights --input 'Delays/*.csv' --output wh/flights
    python -m tarmac.cli reports  --flights wh/flights --fares wh/fares --weather wh/weather \
                                  --out processed [--input-format parquet] [--output-format csv]
    python -m tarmac.cli models   --flights wh/flights --fares wh/fares --out models \
                                  --processed processed
    python -m tarmac.cli route    --requests asked.csv --routes wh/routes --out answers \
                                  [--flights wh/flights --fares wh/fares]
    python -m tarmac.cli ingest   --kind flights --source landing/flights --summary wh/flight_summary

Paths may be globs or folders on any Hadoop file system. The session comes
from ``spark-submit`` (cluster settings, ``spark.checkpoint.dir``); run
directly, a local session is created.
"""

from __future__ import annotations

import argparse
import os

from tarmac.session import get_spark, remove_tables


def _session(args):
    return get_spark(args.master, "tarmac-" + args.command)


def cmd_convert(args) -> None:
    from tarmac.sources.convert import convert_csv
    spark = _session(args)
    report = convert_csv(spark, args.kind, args.input, args.output, quarantine=not args.keep_malformed)
    for name, n in report.items():
        if n:
            print(f"{name}: {n}")


def _inputs(spark, args):
    from tarmac.sources import dimensions
    from tarmac.sources.files import read_fares, read_flights, read_weather
    fmt = args.input_format
    return (read_flights(spark, args.flights, fmt), read_fares(spark, args.fares, fmt),
            read_weather(spark, args.weather, fmt), dimensions.airports(spark),
            dimensions.carriers(spark))


def cmd_reports(args) -> None:
    """Traffic, delay, fare, weather and network reports, route tables and the bundle."""
    from tarmac.operators.recommend import ensemble_summary_record, thresholds_record
    from tarmac.plans.batch_reports import run
    from tarmac.plans.sinks import save_record
    from tarmac.streaming.ingest import merged_summary
    spark = _session(args)
    flights, fares, weather, airports, carriers = _inputs(spark, args)
    kept = {"flight_summary": ("flights", args.flight_summary), "fare_cells": ("fares", args.fare_summary),
            "weather_summary": ("weather", args.weather_summary)}
    run(spark, flights, fares, weather, airports, carriers, args.out, args.output_format,
        **{name: merged_summary(spark, path, kind) for name, (kind, path) in kept.items() if path})
    save_record(ensemble_summary_record(spark), os.path.join(args.out, "ensemble_model_summary"))
    save_record(thresholds_record(spark), os.path.join(args.out, "recommendation_thresholds"))


def cmd_route(args) -> None:
    """Answer a file of route requests from the stored routes, made from the flights if not there yet."""
    from tarmac.functions.defaults import THRESHOLDS
    from tarmac.operators.joins import materialize
    from tarmac.plans import routes, summary as sm
    from tarmac.plans.sinks import save_table
    from tarmac.sources.files import path_exists, read_fares, read_flights, read_requests, read_saved_report
    spark = _session(args)
    days = os.path.join(args.routes, "weekday_delays")
    if args.flights and not path_exists(spark, days):
        summary = materialize(sm.flight_summary(read_flights(spark, args.flights, args.input_format)), "flight-summary")
        fares = sm.settled_fares(sm.fare_cells(read_fares(spark, args.fares, args.input_format)))
        facts = routes.route_facts(summary, sm.fare_reports(fares, THRESHOLDS)["fare_by_origin"])
        routes.save_routes(facts, "tarmac_routes", os.path.join(args.routes, "table"))
        save_table(sm.delay_reports(summary, THRESHOLDS)["daily_delays"], days)
    known = routes.open_routes(spark, "tarmac_routes", os.path.join(args.routes, "table"))
    weekdays = read_saved_report(spark, days)
    if weekdays is None:
        raise SystemExit("no routes stored yet: name --flights and --fares")
    save_table(routes.answer(read_requests(spark, args.requests, args.requests_format), known, weekdays),
               args.out, args.output_format)


def cmd_models(args) -> None:
    """Train, evaluate and save the baseline delay, fare and improved delay models."""
    from pyspark.sql import functions as F
    from tarmac.operators.fares import repair_fare_scale
    from tarmac.plans import models
    from tarmac.plans.sinks import save_record, save_table
    from tarmac.sources.files import read_fares, read_flights, read_metrics_if_exists
    spark = _session(args)
    flights = read_flights(spark, args.flights, args.input_format)
    fares = repair_fare_scale(read_fares(spark, args.fares, args.input_format))
    out, processed = args.out, args.processed

    rf = models.train_delay_rf(flights)
    rf.save(os.path.join(out, "delay_rf_model"))
    save_record(rf.metrics, os.path.join(processed, "delay_model_metrics"))
    save_table(rf.importances.coalesce(1), os.path.join(processed, "delay_feature_importance"),
               "csv")

    fare = models.train_fare_gbt(fares)
    fare.save(os.path.join(out, "fare_gbt_model"))
    save_record(fare.metrics, os.path.join(processed, "fare_model_metrics"))

    v2 = models.train_delay_gbt(flights, exclude_leaky=args.exclude_leaky)
    v2_path = os.path.join(out, "delay_rf_model_v2")
    v2.save(v2_path)
    save_record(v2.metrics.withColumn("model_path", F.lit(v2_path)),
                os.path.join(processed, "delay_model_metrics_v2"))
    save_table(v2.importances.coalesce(1), os.path.join(processed, "delay_feature_importance_v2"),
               "csv")
    baseline = read_metrics_if_exists(spark, os.path.join(processed, "delay_model_metrics"))
    save_record(models.model_comparison(baseline, v2.metrics),
                os.path.join(processed, "delay_model_comparison_v2"))


def cmd_ingest(args) -> None:
    """Pick up new files of one kind and extend their stored summary."""
    from tarmac.streaming.ingest import start_summary_stream
    spark = _session(args)
    query = start_summary_stream(spark, args.source, args.summary, args.input_format,
                                 available_now=not args.continuous, kind=args.kind)
    query.awaitTermination()


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="tarmac")
    p.add_argument("--master", default=None, help="only for runs outside spark-submit")
    sub = p.add_subparsers(dest="command", required=True)

    c = sub.add_parser("convert")
    c.add_argument("--kind", choices=["flights", "fares", "weather"], required=True)
    c.add_argument("--input", nargs="+", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--keep-malformed", action="store_true",
                   help="keep rows with unreadable values, as nulls, instead of setting them aside")
    c.set_defaults(func=cmd_convert)

    r = sub.add_parser("route")
    r.add_argument("--requests", nargs="+", required=True)
    r.add_argument("--routes", required=True, help="folder of the stored routes")
    r.add_argument("--out", required=True)
    r.add_argument("--flights", nargs="+", help="tables to make the routes from when there are none yet")
    r.add_argument("--fares", nargs="+")
    for name, default in (("input", "parquet"), ("requests", "csv"), ("output", "parquet")):
        r.add_argument(f"--{name}-format", default=default, choices=["csv", "parquet"])
    r.set_defaults(func=cmd_route)

    for name, func in (("reports", cmd_reports), ("models", cmd_models)):
        s = sub.add_parser(name)
        s.add_argument("--flights", nargs="+", required=True)
        s.add_argument("--fares", nargs="+", required=True)
        s.add_argument("--weather", nargs="+", required=(name == "reports"))
        s.add_argument("--input-format", default="parquet", choices=["csv", "parquet"])
        s.add_argument("--out", required=True)
        s.set_defaults(func=func)
        if name == "reports":
            s.add_argument("--output-format", default="parquet", choices=["csv", "parquet"])
            for kind in ("flight", "fare", "weather"):
                s.add_argument(f"--{kind}-summary", help="summary table kept by the ingest command")
        else:
            s.add_argument("--processed", required=True)
            s.add_argument("--exclude-leaky", action="store_true")

    i = sub.add_parser("ingest")
    i.add_argument("--source", required=True)
    i.add_argument("--summary", required=True)
    i.add_argument("--kind", choices=["flights", "fares", "weather"], default="flights")
    i.add_argument("--input-format", default="parquet", choices=["csv", "parquet"])
    i.add_argument("--continuous", action="store_true")
    i.set_defaults(func=cmd_ingest)

    args = p.parse_args(argv)
    try:
        args.func(args)
    finally:  # outputs are written: this run's intermediate tables go
        remove_tables(_session(args))


if __name__ == "__main__":
    main()
