"""Replies of an outside decision service, in batch, stream and command line."""

import time

from pyspark.sql import functions as F

from surgecast import cli
from surgecast.config import CampaignConfig
from surgecast.operators import decide as D
from surgecast.operators import reports as R
from surgecast.plans import catalog
from surgecast.sources.reference_tables import read_replies, write_replies
from surgecast.streaming.runner import Decider, RefreshingSink
from surgecast.streaming.sinks import DecisionSink
from tests.conftest import SF_MID, SF_SMALL
from tests.helpers import assert_same, spark_rows
from surgecast.plans.oracle_sql import SQL

SEND = '{"decision":"SEND","reasoning":"r","smsText":"hola"}'


def candidates(spark):
    return catalog.flat(catalog.plan_for(spark, SF_SMALL).candidates)


def replies(spark, rows):
    return spark.createDataFrame(rows, "windowStart long, clientId string, cellId string, reply string, repliedAt long")


def test_late_missing_and_unusable_replies_leave_it_to_the_rules(spark):
    c = candidates(spark).orderBy("windowStart", "clientId", "cellId")
    rows = c.collect()
    end = lambda r: r["windowEnd"]
    key = lambda r: (r["windowStart"], r["clientId"], r["cellId"])
    table = [
        (*key(rows[0]), SEND, end(rows[0]) + 300_000),  # at the bound
        (*key(rows[1]), SEND, end(rows[1]) + 300_001),  # past it
        (*key(rows[2]), "no idea", end(rows[2])),
        (*key(rows[3]), SEND, None),  # unknown time
        (*key(rows[4]), SEND.replace("SEND", "SKIP"), end(rows[4]) - 5),
        (*key(rows[4]), "{" + SEND, end(rows[4]) + 999_999),  # a late one does not count beside it
        (None, None, None, SEND, 0),
    ]
    out = {key(r): r for r in D.decide_with_replies(c, replies(spark, table)).collect()}
    assert len(out) == len(rows)
    assert [out[key(rows[i])]["decisionSource"] for i in range(6)] == ["external", "rules", "rules", "rules", "external", "rules"]
    assert out[key(rows[0])]["smsText"] == "hola" and out[key(rows[4])]["aiDecision"] == "SKIP"
    rules = {key(r): r for r in D.decide(c).collect()}
    for i in (1, 2, 3, 5):
        for name in ("aiDecision", "aiReasoning", "smsText", "skipCode"):
            assert out[key(rows[i])][name] == rules[key(rows[i])][name]


def test_chain_with_replies_mid(spark, duck_mid):
    assert_same(catalog.q_reply_alerts(spark, SF_MID), duck_mid, SQL["reply_alerts"])


def test_lookup_reads_the_days_of_the_batch_only(spark, scratch):
    table = [(d * 86_400_000 + 30_000, "CLIENT_0001", "CELL_003", SEND, d * 86_400_000) for d in range(5)]
    write_replies(replies(spark, table), f"{scratch}/replies")
    write_replies(replies(spark, table[:1]), f"{scratch}/replies")  # appended
    got = read_replies(spark, f"{scratch}/replies", 86_400_000, 2 * 86_400_000)
    assert [r["windowStart"] for r in got.collect()] == [86_430_000]
    assert "PartitionFilters: [isnotnull(day" in got._jdf.queryExecution().executedPlan().toString()
    assert read_replies(spark, f"{scratch}/replies").count() == 6
    assert read_replies(spark, f"{scratch}/none").count() == 0


def test_replies_that_come_between_two_batches(spark, scratch):
    """The table is looked up in every micro-batch; a replay of a batch decides
    as before unless a reply came in time after all."""
    c = candidates(spark)
    sink = DecisionSink(f"{scratch}/feed", f"{scratch}/sent")
    decider = Decider(sink, CampaignConfig(), f"{scratch}/replies")
    decider(c, 0)  # no table yet
    rules = R.alerts(D.decide(c), with_stamp=False)
    feed = lambda b: R.read_feed(spark, sink.feed_path).where(F.col("batch") == b).select(*catalog.ALERT_NO_STAMP)
    assert spark_rows(feed(0)) == spark_rows(rules)
    table = c.select("windowStart", "clientId", "cellId", F.lit(SEND).alias("reply"), (F.col("windowEnd") + 1000).alias("repliedAt"))
    write_replies(table, f"{scratch}/replies")
    decider(c, 1)
    assert {r["smsText"] for r in feed(1).collect()} == {"hola"}
    decider(c.limit(0), 2)
    assert feed(2).count() == 0


def test_replies_with_refreshed_tables(spark, scratch):
    from surgecast.sources.reference_tables import setup_tables

    tables = setup_tables(spark, f"{scratch}/tables")
    agg = catalog.flat(catalog.W.window_aggregate(catalog.deduped_for(spark, SF_SMALL)))
    c = candidates(spark)
    write_replies(c.select("windowStart", "clientId", "cellId", F.lit(SEND).alias("reply"), F.col("windowEnd").alias("repliedAt")), f"{scratch}/replies")
    sink = DecisionSink(f"{scratch}/feed", f"{scratch}/sent")
    RefreshingSink(tables["consents"], tables["cells"], sink, CampaignConfig(), f"{scratch}/replies")(agg, 0)
    assert {r["smsText"] for r in R.read_feed(spark, sink.feed_path).collect()} == {"hola"}


def test_command_line_with_every_part(spark, scratch, capsys):
    """Intake, replies and summary from the command line, as a stream and as a
    batch."""
    base = f"{scratch}/c"
    cli.main(["setup", "--base", base], spark=spark)
    cli.main(["produce", "--events", SF_SMALL, "--out", f"{base}/inbox", "--files", "2"], spark=spark)
    write_replies(catalog.reply_table(catalog.plan_for(spark, SF_SMALL).candidates), f"{base}/replies")
    began = time.time()
    cli.main(
        ["stream", "--base", base, "--source", "files", "--path", f"{base}/inbox/*", "--max-files", "9", "--available-now", "--rejects", "--replies", f"{base}/replies", "--summary"],
        spark=spark,
    )
    assert time.time() - began < 300
    want = catalog.q_reply_alerts(spark, SF_SMALL).drop("decisionSource")
    assert spark_rows(R.read_feed(spark, f"{base}/dashboard-feed").select(*catalog.ALERT_NO_STAMP)) == spark_rows(want)
    cli.main(["report", "--base", base], spark=spark)
    assert capsys.readouterr().out.count("|aiDecision|") >= 2  # the feed's summary and the running one
    cli.main(["batch", "--base", f"{base}", "--messages", f"{base}/inbox/*", "--replies", f"{base}/replies", "--batch-id", "77"], spark=spark)
    again = R.read_feed(spark, f"{base}/dashboard-feed").where("batch = 77").select(*catalog.ALERT_NO_STAMP)
    assert spark_rows(again) == spark_rows(want)
