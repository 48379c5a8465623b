"""The command line steps in-process, and a processing-time stream with the
console view."""

import time

from surgecast import cli
from surgecast.config import CampaignConfig
from surgecast.operators import reports as R
from surgecast.sources.reference_tables import setup_tables
from surgecast.streaming.replay import write_inbox
from surgecast.streaming.runner import start_pipeline
from surgecast.streaming.sources import file_messages
from tests.conftest import SF_SMALL


def test_cli_setup_produce_batch_report(spark, scratch, capsys):
    base = f"{scratch}/c"
    cli.main(["setup", "--base", base, "--show", "5"], spark=spark)
    assert "CLIENT_0001" in capsys.readouterr().out
    cli.main(["produce", "--events", SF_SMALL, "--out", f"{base}/inbox", "--files", "3"], spark=spark)
    cli.main(["batch", "--base", base, "--messages", f"{base}/inbox/*", "--batch-id", "3"], spark=spark)
    feed = R.read_feed(spark, f"{base}/dashboard-feed")
    assert feed.count() == 14 and {r.batch for r in feed.select("batch").collect()} == {3}
    cli.main(["report", "--base", base, "--rows", "2"], spark=spark)
    out = capsys.readouterr().out
    assert "STANDARD" in out and "SEND" in out


def test_processing_time_trigger_and_console(spark, scratch, capsys):
    tables = setup_tables(spark, f"{scratch}/tables")
    write_inbox(spark, SF_SMALL, f"{scratch}/inbox", n_slices=2)
    q, sink = start_pipeline(
        spark,
        file_messages(spark, f"{scratch}/inbox/*", max_files_per_trigger=1),
        tables["consents"],
        tables["cells"],
        f"{scratch}/feed",
        f"{scratch}/sent",
        f"{scratch}/checkpoint",
        CampaignConfig(trigger_interval="1 second"),
        console_rows=3,
    )
    try:
        deadline = time.time() + 120
        while time.time() < deadline and sum(t[1] for t in sink.tallies) < 14:
            time.sleep(1)
    finally:
        q.stop()  # stop between micro-batches; the checkpoint keeps the progress
    assert sum(t[1] for t in sink.tallies) == 14
    assert R.read_feed(spark, f"{scratch}/feed").count() == 14
    out = capsys.readouterr().out
    assert "| STANDARD |" in out and "(Sevilla) |" in out
