"""Commit log of the decision sinks: what a micro-batch has published.

The CSV feed and the Parquet SEND table of a micro-batch are written to staged
folders first and their files moved into ``batch=<id>``; nothing of them counts
yet. One small JSON file in the log then names the files of both, and readers
take named files only: a batch is visible in both tables or in neither,
wherever a run was cut off. A replayed batch gets a new attempt; the latest one
counts, and the files of earlier ones are removed.

A commit also holds by how much the batch changes the number of alerts per
segment and decision (an attempt takes back what the one before it added), so
the log is a source for a running summary (``runner.start_summary``).

The log lies in the feed's folder; the SEND folder has a file that names it.
Folders without a log (written by other means) are read as they are.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast.session import list_names, make_path, path_exists, read_text, rename_path, write_text

LOG_FOLDER, POINTER = "_commits", "_commits_at"

CHANGE = T.StructType(
    [
        T.StructField("segment", T.StringType(), True),
        T.StructField("aiDecision", T.StringType(), True),
        T.StructField("alerts", T.LongType(), True),
    ]
)
COMMIT = T.StructType(
    [
        T.StructField("batch", T.LongType(), True),
        T.StructField("attempt", T.LongType(), True),
        T.StructField("feed", T.ArrayType(T.StringType()), True),
        T.StructField("sent", T.ArrayType(T.StringType()), True),
        T.StructField("alerts", T.ArrayType(CHANGE), True),
        T.StructField("change", T.ArrayType(CHANGE), True),
    ]
)


@dataclass(frozen=True)
class CommitLog:
    spark: SparkSession
    path: str

    @classmethod
    def of_sinks(cls, spark: SparkSession, feed_path: str, sent_path: str) -> "CommitLog":
        """The log of a pair of sinks, made at the first start."""
        log = cls(spark, f"{feed_path}/{LOG_FOLDER}")
        make_path(spark, log.path)
        if not path_exists(spark, f"{sent_path}/{POINTER}"):
            make_path(spark, sent_path)
            write_text(spark, f"{sent_path}/{POINTER}", log.path)
        return log

    @classmethod
    def at(cls, spark: SparkSession, sink_path: str) -> "CommitLog | None":
        """The log that covers a sink folder, if any."""
        if path_exists(spark, f"{sink_path}/{LOG_FOLDER}"):
            return cls(spark, f"{sink_path}/{LOG_FOLDER}")
        if path_exists(spark, f"{sink_path}/{POINTER}"):
            return cls(spark, read_text(spark, f"{sink_path}/{POINTER}").strip())
        return None

    def last(self, batch_id: int) -> dict | None:
        """The latest commit of a batch."""
        names = [n for n in list_names(self.spark, self.path, f"{batch_id:012d}.*.json") if re.fullmatch(r"\d+\.\d+\.json", n)]
        return json.loads(read_text(self.spark, f"{self.path}/{max(names)}")) if names else None

    def publish(self, batch_id: int, feed: list[str], sent: list[str], alerts: list[dict]) -> None:
        """Make the files of a batch (names in its folders) the ones that
        count. ``alerts``: rows of (segment, aiDecision, alerts)."""
        before = self.last(batch_id)
        change = {(a["segment"], a["aiDecision"]): a["alerts"] for a in alerts}
        for a in before["alerts"] if before else []:
            key = (a["segment"], a["aiDecision"])
            change[key] = change.get(key, 0) - a["alerts"]
        attempt = before["attempt"] + 1 if before else 0
        rows = [{"segment": s, "aiDecision": d, "alerts": n} for (s, d), n in change.items() if n]
        entry = {"batch": batch_id, "attempt": attempt, "feed": feed, "sent": sent, "alerts": alerts, "change": rows}
        staged = f"{self.path}/_{uuid.uuid4().hex}"
        write_text(self.spark, staged, json.dumps(entry, ensure_ascii=False))
        if not rename_path(self.spark, staged, f"{self.path}/{batch_id:012d}.{attempt:04d}.json"):
            raise RuntimeError(f"batch {batch_id}: another run has published attempt {attempt}")

    def table(self) -> DataFrame:
        """The latest commit of each batch."""
        commits = self.spark.read.schema(COMMIT).json(self.path)
        latest = F.max_by(F.struct(*[c for c in COMMIT.names if c != "batch"]), "attempt").alias("c")
        return commits.groupBy("batch").agg(latest).select("batch", "c.*")

    def files(self, sink: str) -> list[str]:
        """The published files of ``feed`` or ``sent``, below the sink's folder."""
        named = self.table().select("batch", F.explode(sink).alias("name")).orderBy("batch", "name").collect()
        return [f"batch={r['batch']}/{r['name']}" for r in named]

    def changes(self) -> DataFrame:
        """The changes of the summary as a stream."""
        commits = self.spark.readStream.schema(COMMIT).json(self.path)
        return commits.select(F.explode("change").alias("c")).select("c.*")
