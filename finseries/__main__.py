"""Command line: curation jobs and the analytic questions on published tables.

    python -m finseries curate --dataset stocks --landing DIR --table DIR [--layout files]
    python -m finseries watch  --dataset crypto --landing DIR --table DIR
    python -m finseries query  snapshot --table DIR --dataset stocks [--out DIR]

``curate`` runs one scheduled load (scan, type, name, publish a new run);
``watch`` republishes only when landed files are new, overwritten or gone (a manifest of
the files is kept with each run); ``query`` answers one question on the newest
complete run and writes the whole result as Parquet (``--out``) or prints its
first ``--rows`` rows.  ``--input-gb`` and ``--cores`` size scan splits and
shuffle partitions for the job (``session.sizing_conf``).
"""

from __future__ import annotations

import argparse
import sys

from finseries.operators import forecast, indicators, movers, snapshot, trends
from finseries.schemas import DATASETS
from finseries.session import get_session, remove_scratch, sizing_conf
from finseries.sources import raw, store


def _forecast(table, key, args, baseline: bool):
    train = store.stage(forecast.training_set(table, key), "training")
    if baseline:
        return forecast.forecast_baseline(train, key, args.horizon, with_fitted=True)
    return forecast.combined(train, forecast.forecast_additive(train, key, args.horizon), key, args.show_last)


# question -> function(table, key, name, args)
QUESTIONS = {
    "latest_dates": lambda t, k, n, a: snapshot.latest_dates(t),
    "top_assets": lambda t, k, n, a: snapshot.top_assets(t, k, a.k, a.scope, a.by),
    "snapshot": lambda t, k, n, a: snapshot.snapshot_change(t, k, n, a.k),
    "sparkline": lambda t, k, n, a: snapshot.sparkline(t, k, n, a.k, a.days),
    "history": lambda t, k, n, a: trends.history(t, k, a.span, a.assets, _by_name(k, a)),
    "open_close": lambda t, k, n, a: trends.open_close(t, k, LABELS.get(a.dataset, k), a.k, a.days,
                                                       a.assets, _by_name(k, a)),
    "yoy": lambda t, k, n, a: indicators.yoy(t, a.indicators, a.years, key=k),
    "rolling": lambda t, k, n, a: indicators.rolling_mean(t, a.indicators, a.window, key=k),
    "movers": lambda t, k, n, a: movers.top_movers(t.na.drop(subset=movers.NUMERIC), a.k),
    "forecast": lambda t, k, n, a: _forecast(t, k, a, baseline=False),
    "forecast_band": lambda t, k, n, a: forecast.band(_forecast(t, k, a, baseline=False)),
    "forecast_baseline": lambda t, k, n, a: _forecast(t, k, a, baseline=True),
}

def _by_name(key, args):
    """Chosen assets are display names; look them up unless the key is the name."""
    label = LABELS.get(args.dataset)
    return None if (args.assets is None or label in (None, key)) else label


# the display name used in open/close series names per dataset
LABELS = {"stocks": "stock", "crypto": "crypto"}

# the key and name columns each question uses per dataset
KEYS = {
    "stocks": ("stock", "symbol"),
    "crypto": ("symbol", "crypto"),
    "economic_indicators": ("indicator", "indicator"),
    "commodities": ("commodity", "commodity"),
    "top_gainers": ("ticker", "ticker"),
}


def _floor(text: str):
    return None if text == "none" else ("default" if text == "default" else text)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="finseries")
    p.add_argument("--input-gb", type=float, help="size of the largest input")
    p.add_argument("--cores", type=int, default=8, help="cores of the job, with --input-gb")
    sub = p.add_subparsers(dest="cmd", required=True)
    for cmd in ("curate", "watch"):
        c = sub.add_parser(cmd)
        c.add_argument("--dataset", required=True, choices=sorted(DATASETS))
        c.add_argument("--landing", required=True)
        c.add_argument("--table", required=True)
        c.add_argument("--layout", default="files", choices=["files", "partitioned"])
        c.add_argument("--floor", default="default", help="YYYY-MM-DD, 'default' or 'none'")
        c.add_argument("--no-header", action="store_true")
        c.add_argument("--by-name", action="store_true", help="map each file's header by name")
        if cmd == "curate":
            c.add_argument("--single-file", action="store_true")
            c.add_argument("--partition-by", nargs="*", default=None)
            c.add_argument("--keep", type=int, default=2)
            c.add_argument("--sort-within", nargs="*", default=None,
                           help="order rows inside each file (for example: date)")
    q = sub.add_parser("query")
    q.add_argument("question", choices=sorted(QUESTIONS))
    q.add_argument("--table", required=True)
    q.add_argument("--dataset", required=True, choices=sorted(KEYS))
    q.add_argument("--out", help="write the whole answer there as Parquet; without it the first --rows rows are printed")
    q.add_argument("--rows", type=int, default=1000, help="rows printed without --out")
    q.add_argument("--show-last", type=int, default=30, help="actual days in a forecast")
    q.add_argument("--indicators", nargs="*", default=None, help="series to keep (yoy, rolling)")
    q.add_argument("--k", type=int, default=10)
    q.add_argument("--scope", default="latest", choices=["latest", "all"])
    q.add_argument("--by", default="rows", choices=["rows", "volume"])
    q.add_argument("--days", type=int, default=7)
    q.add_argument("--span", default="1M")
    q.add_argument("--assets", nargs="*", default=None, help="display names to keep (history, open_close)")
    q.add_argument("--years", type=int, nargs="*", default=[2023, 2024])
    q.add_argument("--window", type=int, default=3)
    q.add_argument("--horizon", type=int, default=15)
    args = p.parse_args(argv)

    spark = get_session(extra=sizing_conf(int(args.input_gb * 2 ** 30), args.cores) if args.input_gb else None)
    if args.cmd == "curate":
        df = raw.curate(spark, args.landing, args.dataset, args.layout, _floor(args.floor),
                        header=not args.no_header, by_name=args.by_name)
        print(store.publish(df, args.table, partition_by=args.partition_by,
                            single_file=args.single_file, keep=args.keep,
                            sort_within=args.sort_within or (["date"] if "date" in df.columns else None)))
    elif args.cmd == "watch":
        from finseries.streaming.ingest import republish_on_arrival
        for run in republish_on_arrival(spark, args.landing, args.dataset, args.table, args.layout,
                                        _floor(args.floor), header=not args.no_header,
                                        by_name=args.by_name):
            print(run)
    else:
        table = store.read_curated(spark, args.table)
        key, name = KEYS[args.dataset]
        result = QUESTIONS[args.question](table, key, name, args)
        if args.out:
            result.write.mode("errorifexists").parquet(args.out)
            print(args.out)
        else:
            for row in result.limit(args.rows).toLocalIterator():
                print("\t".join("" if v is None else str(v) for v in row))
        remove_scratch(spark)  # staged training sets
    return 0


if __name__ == "__main__":
    sys.exit(main())
