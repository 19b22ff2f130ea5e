"""Session settings the package relies on."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Runtime settings; each one changes results, so they are applied to any session given to us.
SEMANTIC_CONF = {
    # Clocks are UTC instants everywhere.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of rejecting the record.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # One value of a wrong type leaves the record's other values readable.
    "spark.sql.json.enablePartialResults": "true",
    # The older form of timestamps has no bounds in footers, so neither files nor row groups can be passed over.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# The check of a record makes 54,000 bytes of code when it is generated as one method, and the JVM never compiles a
# method of more than 8,000.  Under this limit Spark generates such steps in parts.
CODE_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Settings for large inputs; only applied to sessions that we build.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # No Python call site is recorded for each column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results, and the speed of record checks, depend on to an existing session."""
    for key, value in {**SEMANTIC_CONF, **CODE_CONF}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_OWN_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the session names it.

    Executors on other machines cannot read a folder of the driver's own disk, so a cluster without
    ``spark.checkpoint.dir`` is an error.  With a local master, driver and executors are one process
    and a folder is made here; it goes when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _OWN_ROOTS:
        own = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _OWN_ROOTS[context.applicationId] = own
    return _OWN_ROOTS[context.applicationId]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a reduced table to the shared folder and read it back.

    Later steps then start from files that outlive any executor, know their size, and do not repeat
    the work that made them.
    """
    path = f"{checkpoint_root(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**SCALE_CONF, **SEMANTIC_CONF, **(extra or {})}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
