"""Command line for cluster runs (``spark-submit`` a driver script calling ``main``).

  python -m quitanda star    --sf-dir DIR --raw-root OUT          driver star tables → nine raw tables
  python -m quitanda land    --raw-root DIR --landing OUT --date D raw tables → landing (status per table)
  python -m quitanda load    --landing DIR --raw-root OUT --date D [--append | --stream]
  python -m quitanda build   --raw-root DIR --out OUT [--layers ...] [--env E] [--no-gate]
  python -m quitanda model   NAME --raw-root DIR --out OUT [--env E] one model, from its parents' tables
  python -m quitanda test    [NAME ...] --raw-root DIR --out OUT [--env E]   tests of written models

Settings (master, executors, shuffle partitions, spark.checkpoint.dir) come
from ``spark-submit``; nothing here assumes a local machine.
"""

from __future__ import annotations

import argparse
import json
import sys

from quitanda.plans.models import LAYERS, MODELS, Warehouse
from quitanda.schemas import RAW_SCHEMAS
from quitanda.session import get_session, scratch_path


def _raw_paths(raw_root: str) -> dict[str, str]:
    return {t: f"{raw_root.rstrip('/')}/{t}" for t in RAW_SCHEMAS}


def cmd_star(spark, args) -> dict:
    from quitanda.plans.materialize import write_table
    from quitanda.schemas import RAW_SORT_KEYS
    from quitanda.sources.star import raw_table
    for t in RAW_SCHEMAS:
        write_table(raw_table(spark, args.sf_dir, t), f"{args.raw_root.rstrip('/')}/{t}", RAW_SORT_KEYS[t])
    return {"written": list(RAW_SCHEMAS)}


def cmd_land(spark, args) -> dict:
    from quitanda.sources.landing import extract_to_landing
    out = {}
    for t, p in _raw_paths(args.raw_root).items():
        df = spark.read.parquet(p).select(*RAW_SCHEMAS[t].fieldNames())
        st = extract_to_landing(spark, df, args.landing, t, args.date, args.env)
        out[t] = {"status": st.status, "rows": st.rows, "path": st.path}
    return out


def cmd_load(spark, args) -> dict:
    from quitanda.sources.landing import load_raw, read_landing
    from quitanda.streaming.landing_stream import load_landing_incrementally
    out = {}
    for t, p in _raw_paths(args.raw_root).items():
        if args.stream:
            ckpt = f"{args.checkpoint or scratch_path(spark, 'stream-load', unique=False)}/{t}"
            df = load_landing_incrementally(spark, args.landing, t, p, ckpt, args.env)
        else:
            landed = read_landing(spark, args.landing, t, args.date, RAW_SCHEMAS[t], args.env)
            if landed is None:
                out[t] = "no landing data"
                continue
            df = load_raw(landed, p, t, args.date, mode="append" if args.append else "replace_date")
        out[t] = "loaded"
    return out


def cmd_build(spark, args) -> dict:
    from quitanda.plans.pipeline import run_pipeline
    wh = Warehouse.from_tables(spark, _raw_paths(args.raw_root))
    res = run_pipeline(spark, wh, args.out, layers=args.layers, gate=not args.no_gate, env=args.env)
    failed = [] if res.test_results is None else \
        [r.asDict() for r in res.test_results.where("violations > 0").collect()]
    return {"layers": res.layers_done, "failed_tests": failed}


def _written(spark, args, skip: set[str]) -> tuple[Warehouse, str | None]:
    """Warehouse over the tables that ``build`` or ``model`` have written; models without one come from the raw layer."""
    from quitanda.plans.materialize import database_for
    from quitanda.plans.pipeline import use_existing
    wh = Warehouse.from_tables(spark, _raw_paths(args.raw_root))
    database = database_for(args.env) if args.env else None
    use_existing(spark, wh, args.out, skip, database)
    return wh, database


def cmd_model(spark, args) -> dict:
    from quitanda.plans.materialize import materialize
    wh, database = _written(spark, args, {args.name})
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    materialize(spark, MODELS[args.name], wh.model(args.name), args.out, database=database)
    return {"written": args.name}


def cmd_test(spark, args) -> dict:
    from quitanda.plans.pipeline import run_tests
    unknown = set(args.names) - set(MODELS)
    if unknown:
        raise SystemExit(f"no such model: {', '.join(sorted(unknown))}")
    wh, _ = _written(spark, args, set())
    return {"failed_tests": run_tests(spark, wh, args.names or list(MODELS), args.out)}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="quitanda")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("star"); p.add_argument("--sf-dir", required=True); p.add_argument("--raw-root", required=True)
    p = sub.add_parser("land"); p.add_argument("--raw-root", required=True); p.add_argument("--landing", required=True)
    p.add_argument("--date", required=True); p.add_argument("--env")
    p = sub.add_parser("load"); p.add_argument("--landing", required=True); p.add_argument("--raw-root", required=True)
    p.add_argument("--date"); p.add_argument("--env"); p.add_argument("--append", action="store_true")
    p.add_argument("--stream", action="store_true"); p.add_argument("--checkpoint")
    p = sub.add_parser("build"); p.add_argument("--raw-root", required=True); p.add_argument("--out", required=True)
    p.add_argument("--layers", nargs="*", choices=LAYERS); p.add_argument("--no-gate", action="store_true")
    p.add_argument("--env")
    p = sub.add_parser("model"); p.add_argument("name", choices=sorted(MODELS))
    p.add_argument("--raw-root", required=True); p.add_argument("--out", required=True); p.add_argument("--env")
    p = sub.add_parser("test"); p.add_argument("names", nargs="*", metavar="NAME")
    p.add_argument("--raw-root", required=True); p.add_argument("--out", required=True); p.add_argument("--env")
    args = ap.parse_args(argv)
    if args.cmd == "load" and not args.stream and not args.date:
        ap.error("load needs --date unless --stream")
    spark = get_session()
    result = {"star": cmd_star, "land": cmd_land, "load": cmd_load, "build": cmd_build,
              "model": cmd_model, "test": cmd_test}[args.cmd](spark, args)
    print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
