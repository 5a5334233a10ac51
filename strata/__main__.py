"""Command line: ``python -m strata run|validate|ingest ...``.

* ``run``: build bronze -> silver -> gold -> quality into ``--root``, from
  the nine sources as parquet folders under ``--sources`` (``--source
  name=place`` moves one; a place is a folder or ``table:<catalog table>``), or
  from the test-data views of ``--source-dir``.  ``--events`` is the bronze
  folder that ``ingest`` writes; ``--skip-streaming`` leaves the event table
  out, ``--skip-quality`` the rules; ``--no-gate`` reports failed checks
  without failing the run.  A failed table or check gives exit code 1.
* ``validate``: evaluate the quality rules of one layer (or all) over the
  tables already written under ``--root``; exit code 1 when a check failed.
* ``ingest``: run the event intake over a landing folder until it is drained
  or ``--timeout`` seconds passed; with ``--max-messages`` take exactly that
  many, or what came within the time.
* ``redeliver``: one round over the quarantined messages, with the repaired
  ones (``message_id, data``) as JSON lines under ``--repaired``.
"""

from __future__ import annotations

import argparse
import json
import sys

from strata.session import build_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--source-dir")
    r.add_argument("--sources")
    r.add_argument("--source", action="append", default=[], metavar="NAME=PLACE")
    r.add_argument("--events")
    r.add_argument("--skip-quality", action="store_true")
    r.add_argument("--keep-versions", type=int, default=None)
    r.add_argument("--root", required=True)
    r.add_argument("--layers", default="bronze,silver,gold,quality")
    r.add_argument("--skip-streaming", action="store_true")
    r.add_argument("--no-gate", action="store_true")
    r.add_argument("--year", type=int, action="append", default=None, help="write only this year of the year-partitioned tables (repeatable)")
    v = sub.add_parser("validate")
    v.add_argument("--root", required=True)
    v.add_argument("--layer", choices=["bronze", "silver", "gold", "all"], default="all")
    i = sub.add_parser("ingest")
    for name in ("landing", "bronze", "quarantine", "checkpoint"):
        i.add_argument(f"--{name}", required=True)
    i.add_argument("--max-files-per-trigger", type=int, default=None)
    i.add_argument("--timeout", type=float, default=None)
    i.add_argument("--max-messages", type=int, default=None)
    d = sub.add_parser("redeliver")
    d.add_argument("--bronze", required=True)
    d.add_argument("--repaired")
    d.add_argument("--max-attempts", type=int, default=5)
    ap.add_argument("--master", default=None)
    ap.add_argument("--cluster", action="store_true", help="apply session.CLUSTER_CONF sizing")
    args = ap.parse_args(argv)

    spark = build_session(args.master, cluster=args.cluster)
    if args.cmd == "run":
        from strata.plans.quality import DataQualityError
        from strata.plans.run import LayerError, run
        from strata.sources import registered
        from strata.sources import testviews as tv
        from strata.streaming.ingest import read_bronze
        if args.source_dir:
            sources, events = tv.sources(spark, args.source_dir), tv.bronze_events_view(spark, args.source_dir)
        else:
            places = {n: f"{args.sources}/{n}" for n in registered.REQUIRED} if args.sources else {}
            sources, events = registered.read_sources(spark, places | dict(x.split("=", 1) for x in args.source)), None
        if args.events:
            events = read_bronze(spark, args.events)
        layers = [x for x in args.layers.split(",") if not (x == "quality" and args.skip_quality)]
        try:
            report = run(spark, sources, args.root, layers=tuple(layers), events=None if args.skip_streaming else events,
                         gate=not args.no_gate, keep_versions=args.keep_versions, years=args.year)
        except LayerError as e:
            print(json.dumps(e.report, default=str, indent=1))
            print(e, file=sys.stderr)
            return 1
        except DataQualityError as e:
            print(e, file=sys.stderr)
            return 1
        print(json.dumps(report, default=str, indent=1))
        return 0
    if args.cmd == "validate":
        from strata.plans.quality import DataQualityError, enforce, evaluate, rules_for
        from strata.plans.registry import SPECS
        from strata.plans.run import read_table
        tables = {k: df for k in SPECS if (df := read_table(spark, args.root, *k)) is not None}
        results = evaluate(spark, tables, rules_for(
            args.layer, with_stream=("silver", "streaming_eventos_clean") in tables))
        results.show(100, truncate=False)
        try:
            enforce(results)
        except DataQualityError as e:
            print(e, file=sys.stderr)
            return 1
        return 0
    if args.cmd == "ingest" and args.max_messages:
        from strata.streaming.bounded import take_messages
        print(take_messages(spark, args.landing, args.bronze, args.quarantine, args.checkpoint, args.max_messages, args.timeout or 0.0))
        return 0
    if args.cmd == "redeliver":
        from strata.streaming.redelivery import redeliver
        repaired = spark.read.schema("message_id string, data string").json(args.repaired) if args.repaired else None
        print(json.dumps(redeliver(spark, args.bronze, repaired, args.max_attempts)))
        return 0
    if args.cmd == "ingest":
        from strata.streaming.ingest import FILES_PER_TRIGGER, ingest_events, run_bounded
        q = ingest_events(spark, args.landing, args.bronze, args.quarantine, args.checkpoint,
                          max_files_per_trigger=args.max_files_per_trigger or FILES_PER_TRIGGER)
        run_bounded(q, args.timeout)
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
