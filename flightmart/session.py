"""Session helpers: a sensibly configured session and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs rely on.  AQE coalesces small shuffle partitions, splits
# skewed ones (joins and REBALANCE) and re-plans joins from runtime sizes.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.parquet.filterPushdown": "true",
    # The cleaning stage fuses ~20 wide CASE expressions into one generated
    # method.  HotSpot never JIT-compiles methods over 8000 bytes of bytecode,
    # so such a method runs interpreted (~3x slower here).  With this limit
    # Spark falls back to per-operator generated code split into small,
    # compilable methods for exactly those stages (value suggested by the
    # Spark documentation for HotSpot).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(
    app: str = "flightmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster leave ``master`` unset; ``shuffle_partitions`` should be
    sized so one partition is ~100-200 MB of shuffled data.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """``conf`` for what runs inside, then the session's own values again."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def compile_wide_stages(spark: SparkSession) -> None:
    """Hold the session to the default above for generated methods, if its own
    limit is higher.  It stays set, as the frames run after the call returns."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) > int(DEFAULT_CONF[limit]):
        spark.conf.set(limit, DEFAULT_CONF[limit])


def hold_arrow_batches(spark: SparkSession, most: int) -> None:
    """Hold the session's Arrow batches to ``most`` bytes, if its own limit is
    higher.  It stays set, as the frames run after the call returns."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(limit))
    if not 0 < own <= most:
        spark.conf.set(limit, str(most))


def _checkpoint_base(spark: SparkSession) -> str | None:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the cluster's shared checkpoint folder.

    The base is read from ``spark.checkpoint.dir``.  Only a local-mode
    session without that setting (tests) gets its own temporary base; on a
    cluster a missing setting is an error, because a machine-local folder
    is not visible to executors and dies with them.
    """
    base = _checkpoint_base(spark)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="flightmart-")
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts, uuid.uuid4().hex])
