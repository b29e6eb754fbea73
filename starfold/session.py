"""Session settings the library relies on."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings applied by :func:`build_session`. AQE re-plans joins from measured
# sizes, coalesces small shuffle partitions and splits skewed ones; dynamic
# partition overwrite replaces only the partitions a batch writes.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
READ_SIZE = "spark.sql.files.maxPartitionBytes"
#: Most bytes of packed rows that a task of :func:`small_reads` takes.
PACKED_BYTES = 32 << 20


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "starfold",
                  extra: dict | None = None) -> SparkSession:
    """Local/test session; on a cluster use the platform's session and only
    make sure a shared checkpoint directory is configured."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**SESSION_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions),
                 **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the platform (a distributed file system
    path every executor can reach); unset, it is an error. Only a session in
    one process (``local[...]``), whose executors share the driver's disk,
    gets a scratch folder of its own.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="starfold-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf.rstrip("/")


def open_writers(spark: SparkSession, number: int = 64) -> None:
    """Let a task that writes folders by value keep up to ``number`` of them open, unless the session says otherwise.

    Without, it sorts its rows by folder first; beyond that number it still does.
    """
    if spark.conf.get(WRITERS, "0") == "0":
        spark.conf.set(WRITERS, str(number))


@contextmanager
def small_reads(spark: SparkSession) -> Iterator[None]:
    """Within it, a task reads at most ``PACKED_BYTES`` of files, or fewer if the session says so.

    Raw rows pack to few bytes and take much work: at the usual 128 MB a batch
    of 200 million of them is a few tasks more than a small cluster has cores,
    which idle while the last ones run, and a task holds the hashes and open
    files of millions of rows at once.
    """
    earlier = spark.conf.get(READ_SIZE)
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() <= PACKED_BYTES:
        yield
        return
    spark.conf.set(READ_SIZE, str(PACKED_BYTES))
    try:
        yield
    finally:
        spark.conf.set(READ_SIZE, earlier)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point ``SparkContext.setCheckpointDir`` at the shared folder."""
    root = checkpoint_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for staged tables."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/starfold/{name}-{uuid.uuid4().hex}"
