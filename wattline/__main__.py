"""Command line: the runs a user of the original scripts performs.

    python -m wattline extract   --archives DIR --landing DIR [--start-year 2012]
    python -m wattline load-table --data DIR --table PATH --rejected PATH [--by-year]
    python -m wattline features  --data DIR --out PATH [--weather BLOCKS --start D --end D]
    python -m wattline weather-load  --weather BLOCKS --start D --end D --table PATH
    python -m wattline forecast-load --records JSON --table PATH --rejected PATH
    python -m wattline cities-load   --records JSON --table PATH --rejected PATH
    python -m wattline train     --data DIR --registry ROOT [--weather BLOCKS --start D --end D]
    python -m wattline stream    --landing DIR --table PATH --rejected PATH

The session comes from `spark-submit` / the environment; `--master` is for
local runs only.
"""

from __future__ import annotations

import argparse
import json

from wattline.contracts import FIRST_DATA_YEAR


def _weather(spark, args):
    """The requested days of landed weather, or None without `--weather`."""
    if not args.weather:
        return None
    from wattline.sources.weather import fetch_weather
    return fetch_weather(spark, args.weather, args.start, args.end).drop("latitude", "longitude")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="wattline")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    ex = sub.add_parser("extract")
    ex.add_argument("--archives", required=True)
    ex.add_argument("--landing", required=True)
    ex.add_argument("--start-year", type=int, default=FIRST_DATA_YEAR, help="first yearly archive; 0 takes every archive")
    lt = sub.add_parser("load-table")
    lt.add_argument("--data", required=True)
    lt.add_argument("--table", required=True)
    lt.add_argument("--rejected", required=True)
    lt.add_argument("--by-year", action="store_true")
    ft = sub.add_parser("features")
    ft.add_argument("--data", required=True)
    ft.add_argument("--out", required=True)
    wl = sub.add_parser("weather-load")
    wl.add_argument("--table", required=True)
    fl = sub.add_parser("forecast-load")
    fl.add_argument("--records", required=True)
    fl.add_argument("--table", required=True)
    fl.add_argument("--rejected", required=True)
    cl = sub.add_parser("cities-load")
    cl.add_argument("--records", required=True)
    cl.add_argument("--table", required=True)
    cl.add_argument("--rejected", required=True)
    tr = sub.add_parser("train")
    tr.add_argument("--data", required=True)
    tr.add_argument("--registry", default=None)
    tr.add_argument("--model-name", default="load_model")
    for parser in (ft, wl, tr):
        parser.add_argument("--weather", default=None, required=parser is wl)
        parser.add_argument("--start", default=None)
        parser.add_argument("--end", default=None)
    st = sub.add_parser("stream")
    st.add_argument("--landing", required=True)
    st.add_argument("--table", required=True)
    st.add_argument("--rejected", required=True)
    args = ap.parse_args(argv)

    from wattline.session import get_session
    spark = get_session(args.master)

    if args.cmd == "extract":
        from wattline.sources.archive import download_and_extract
        written = download_and_extract(spark, args.archives, args.landing, args.start_year or None)
        print(json.dumps({"extracted": written.count()}))
    elif args.cmd == "load-table":
        from wattline.plans.table_load import load_table
        print(json.dumps(load_table(spark, args.data, args.table, args.rejected, by_year=args.by_year)))
    elif args.cmd == "features":
        from wattline.plans.training import write_features
        from wattline.sources.delimited import load_all_data
        write_features(load_all_data(spark, args.data), args.out, _weather(spark, args))
        print(json.dumps({"written": args.out}))
    elif args.cmd == "weather-load":
        from wattline.plans.weather_load import load_hourly
        print(json.dumps({"inserted": load_hourly(spark, args.weather, args.start, args.end, args.table)}))
    elif args.cmd == "forecast-load":
        from wattline.plans.weather_load import load_daily
        print(json.dumps(load_daily(spark, args.records, args.table, args.rejected)))
    elif args.cmd == "cities-load":
        from wattline.plans.weather_load import load_cities
        print(json.dumps(load_cities(spark, args.records, args.table, args.rejected)))
    elif args.cmd == "train":
        from wattline.plans.training import run_training
        from wattline.sources.delimited import load_all_data
        res = run_training(spark, load_all_data(spark, args.data), registry_root=args.registry,
                           model_name=args.model_name, weather=_weather(spark, args))
        for r in res.metrics.orderBy("ordinal").collect():
            print(json.dumps({"model": r["model"], "r2": r["r2"], "rmse": r["rmse"], "mape": r["mape"]}))
        print(json.dumps({"best": res.best, "r2": res.best_r2, "version": res.version}))
    elif args.cmd == "stream":
        from wattline.streaming import start_incremental_load
        start_incremental_load(spark, args.landing, args.table, args.rejected).awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
