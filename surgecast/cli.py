"""Command line: the reference's run steps as Spark jobs.

    python -m surgecast.cli setup   --base /data/campaigns
    python -m surgecast.cli produce --events /root/testdata/sf0.01 --out /data/campaigns/inbox
    python -m surgecast.cli stream  --base /data/campaigns --source files --path '/data/campaigns/inbox/*'
    python -m surgecast.cli batch   --base /data/campaigns --messages '/data/campaigns/inbox/*'
    python -m surgecast.cli report  --base /data/campaigns

``stream`` runs until stopped; on SIGINT/SIGTERM the running micro-batch is
completed and committed, then the query ends (the checkpoint makes the next
start resume from there). Every field of ``CampaignConfig`` is an option of
``stream`` and ``batch`` (``--window-duration``, ``--kafka-bootstrap``, ...).
"""

from __future__ import annotations

import argparse
import dataclasses
import signal
import sys
import threading

from pyspark.sql import functions as F

from surgecast.config import CampaignConfig
from surgecast.operators import reports as R
from surgecast.plans.chain import campaign_plan
from surgecast.session import batch_ids, build_session, path_exists
from surgecast.sources import wire
from surgecast.sources.reference_tables import read_cells, read_consents, read_replies, read_table, setup_tables
from surgecast.streaming.runner import clean_events, start_intake, start_pipeline, start_summary, stop_after_batch
from surgecast.streaming.sinks import DecisionSink, RejectSink
from surgecast.streaming.sources import file_messages, kafka_messages


def _paths(base: str) -> dict[str, str]:
    b = base.rstrip("/")
    return {
        "consents": f"{b}/consents",
        "cells": f"{b}/cells",
        "feed": f"{b}/dashboard-feed",
        "sent": f"{b}/sent",
        "rejects": f"{b}/rejects",
        "intake": f"{b}/intake",
        "intake_checkpoint": f"{b}/intake-checkpoint",
        "summary": f"{b}/summary",
        "summary_checkpoint": f"{b}/summary-checkpoint",
        "checkpoint": f"{b}/checkpoint",
    }


# shorter names of some settings
_ALIASES = {"trigger_interval": "--trigger", "require_target_cell": "--target-cells", "signal_floor_dbm": "--signal-floor"}


def _config_options(parser) -> None:
    """One option per field of ``CampaignConfig``."""
    for f in dataclasses.fields(CampaignConfig):
        names = ["--" + f.name.replace("_", "-"), *filter(None, [_ALIASES.get(f.name)])]
        if "bool" in str(f.type):
            parser.add_argument(*names, dest=f.name, action=argparse.BooleanOptionalAction, default=f.default)
        else:
            parser.add_argument(*names, dest=f.name, type=int if "int" in str(f.type) else str, default=f.default)


def _config(args) -> CampaignConfig:
    return CampaignConfig(**{f.name: getattr(args, f.name) for f in dataclasses.fields(CampaignConfig)})


def cmd_setup(spark, args):
    paths = setup_tables(spark, args.base)
    if args.show:
        read_consents(spark, paths["consents"]).orderBy("clientId").show(args.show, truncate=False)
        read_cells(spark, paths["cells"]).orderBy("cellId").show(args.show, truncate=False)


def cmd_produce(spark, args):
    """Encode the events table as JSON message files (the producer's format):
    time-ordered files, one per slice, then a sentinel that closes windows."""
    from surgecast.streaming.replay import write_inbox

    write_inbox(spark, args.events, args.out, n_slices=args.files)


def cmd_stream(spark, args):
    p = _paths(args.base)
    cfg = _config(args)
    if args.source == "kafka":
        messages = kafka_messages(spark, cfg)
    else:
        messages = file_messages(spark, args.path, max_files_per_trigger=args.max_files)
    queries, asked = [], stop_on_signals()
    if args.rejects:
        # decode once: the pipeline reads the clean part of the intake table
        queries.append(start_intake(spark, messages, p["intake"], p["intake_checkpoint"], cfg, available_now=args.available_now))
        if args.available_now:
            wait_for(queries, asked)
        messages = clean_events(spark, p["intake"], max_files_per_trigger=args.max_files)
    q, _ = start_pipeline(
        spark,
        messages,
        p["consents"],
        p["cells"],
        p["feed"],
        p["sent"],
        args.checkpoint or p["checkpoint"],
        cfg,
        available_now=args.available_now,
        refresh_tables=args.refresh_tables,
        kafka_sink=args.kafka_sink,
        console_rows=args.console_rows,
        replies_path=args.replies,
    )
    queries.append(q)
    if args.summary:
        if args.available_now:
            wait_for(queries, asked)
        queries.append(start_summary(spark, p["feed"], p["summary"], p["summary_checkpoint"], cfg, available_now=args.available_now))
    wait_for(queries, asked)


def stop_on_signals() -> threading.Event:
    """An event that SIGINT and SIGTERM set."""
    asked = threading.Event()
    for s in (signal.SIGINT, signal.SIGTERM):
        signal.signal(s, lambda *_: asked.set())
    return asked


def wait_for(queries, asked: threading.Event) -> None:
    """Until all queries end, or, once asked to stop, their running batches."""
    while any(q.isActive for q in queries):
        if asked.wait(0.5):
            for q in queries:
                stop_after_batch(q)
    for q in queries:
        q.awaitTermination()  # raises what ended the query


def cmd_batch(spark, args):
    """The same chain over a bounded set of message files, written once."""
    p = _paths(args.base)
    cfg = _config(args)
    used = sorted({*batch_ids(spark, p["feed"]), *batch_ids(spark, p["sent"])})
    batch_id = args.batch_id if args.batch_id is not None else (used[-1] + 1 if used else 0)
    if batch_id in used and not args.replace:
        raise SystemExit(f"batch {batch_id} exists; --replace overwrites it")
    decoded = wire.decode(spark.read.text(args.messages), keep=["value"])
    if args.rejects:
        RejectSink(p["rejects"], cfg)(decoded, batch_id)
    events = decoded.drop("value")
    replies = read_replies(spark, args.replies) if args.replies else None
    plan = campaign_plan(events, read_consents(spark, p["consents"]), read_cells(spark, p["cells"]), cfg, replies=replies)
    from surgecast.operators.windows import flatten_window

    DecisionSink(p["feed"], p["sent"], cfg, console_rows=args.console_rows)(flatten_window(plan.decisions), batch_id)


def cmd_report(spark, args):
    sent = R.read_sent(spark, _paths(args.base)["sent"])
    sent.orderBy(F.col("batch"), F.col("clientId")).show(args.rows, truncate=False)
    R.alert_summary(R.read_feed(spark, _paths(args.base)["feed"])).orderBy("segment", "aiDecision").show()
    if path_exists(spark, _paths(args.base)["summary"]):
        read_table(spark, _paths(args.base)["summary"]).orderBy("segment", "aiDecision").show()


def main(argv=None, spark=None):
    """Run one command; with ``spark`` given, use that session and keep it."""
    ap = argparse.ArgumentParser(prog="surgecast")
    ap.add_argument("--master", default="local[*]")
    ap.add_argument("--shuffle-partitions", type=int, default=8)
    sub = ap.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("setup")
    s.add_argument("--base", required=True)
    s.add_argument("--show", type=int, default=0, help="print this many rows of each table")

    s = sub.add_parser("produce")
    s.add_argument("--events", required=True, help="folder holding events.parquet")
    s.add_argument("--out", required=True)
    s.add_argument("--files", type=int, default=5)

    for name in ("stream", "batch"):
        s = sub.add_parser(name)
        s.add_argument("--base", required=True)
        _config_options(s)
        s.add_argument("--console-rows", type=int, default=0)
        s.add_argument("--rejects", action="store_true", help="also write the reject table")
        s.add_argument("--replies", default=None, help="reply table of an outside decision service")
    st = sub.choices["stream"]
    st.add_argument("--source", choices=["kafka", "files"], default="kafka")
    st.add_argument("--path", default=None)
    st.add_argument("--max-files", type=int, default=1)
    st.add_argument("--checkpoint", default=None)
    st.add_argument("--available-now", action="store_true")
    st.add_argument("--refresh-tables", action="store_true")
    st.add_argument("--kafka-sink", action="store_true")
    st.add_argument("--summary", action="store_true", help="also keep a running summary of the alerts")
    bt = sub.choices["batch"]
    bt.add_argument("--messages", required=True)
    bt.add_argument("--batch-id", type=int, default=None, help="default: the next free id")
    bt.add_argument("--replace", action="store_true", help="overwrite an existing batch")

    s = sub.add_parser("report")
    s.add_argument("--base", required=True)
    s.add_argument("--rows", type=int, default=20)

    args = ap.parse_args(argv)
    own = spark is None
    if own:
        spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)
    {"setup": cmd_setup, "produce": cmd_produce, "stream": cmd_stream, "batch": cmd_batch, "report": cmd_report}[
        args.cmd
    ](spark, args)
    if own:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
