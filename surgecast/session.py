"""Session construction and the shared work folder.

Jobs that must cut lineage or keep streaming state write under the folder the
cluster names in ``spark.checkpoint.dir``. Only when a session has none (local
tests) do we pick a fresh local folder and record it on the session.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

from surgecast.operators.joins import runtime_filter_conf

CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"


def _local_cores(master: str) -> int | None:
    m = re.fullmatch(r"local\[(\d+|\*)(?:,\d+)?\]", master.strip())
    if not m:
        return 1 if master.strip() == "local" else None
    return os.cpu_count() or 1 if m.group(1) == "*" else int(m.group(1))


def build_session(
    master: str = "local[*]",
    app_name: str = "surgecast",
    shuffle_partitions: int = 8,
    extra: dict | None = None,
) -> SparkSession:
    """A session tuned for this workload (used by tests, bench and CLI runs).

    Adaptive execution stays on (skew splitting, join re-planning). Merging
    small shuffle partitions is turned off only for a local master whose
    partition count does not exceed its cores: there every partition already
    has its own core, and merging them serialises the work.
    """
    cores = _local_cores(master)
    coalesce = cores is None or shuffle_partitions > cores
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", str(coalesce).lower())
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.noDataMicroBatches.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SURGECAST_DRIVER_MEMORY", "8g"))
    )
    for k, v in (runtime_filter_conf() | (extra or {})).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one only when unset."""
    sc = spark.sparkContext
    path = sc.getConf().get(CHECKPOINT_DIR_KEY, None) or spark.conf.get(CHECKPOINT_DIR_KEY, None)
    if not path:
        path = sc.getCheckpointDir()
    if not path:
        # A folder of one machine serves a local master only: on a cluster
        # every executor would write to its own disk.
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(f"set {CHECKPOINT_DIR_KEY} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="surgecast-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def make_path(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def file_states(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of a file or of a folder's files."""
    fs, p = _path(spark, path)
    return sorted((str(s.getPath()), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p))


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Ids of the ``batch=<id>`` folders under ``path``."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    names = (str(s.getPath().getName()) for s in fs.listStatus(p))
    return sorted(int(n[6:]) for n in names if re.fullmatch(r"batch=\d+", n))


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/surgecast/{name}-{uuid.uuid4().hex[:12]}"


def list_names(spark: SparkSession, path: str, pattern: str = "*") -> list[str]:
    """Names in a folder that match a glob pattern, hidden ones included."""
    fs, p = _path(spark, path)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(p, pattern))
    return sorted(s.getPath().getName() for s in found or [])


def rename_path(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file; False if the target is there already."""
    fs, p = _path(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    return not fs.exists(to) and fs.rename(p, to)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a file over another one in one step."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs
    p = fs.Path(source)
    context = fs.FileContext.getFileContext(p.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    how = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    how[0] = getattr(fs, "Options$Rename").OVERWRITE
    context.rename(p, fs.Path(target), how)
