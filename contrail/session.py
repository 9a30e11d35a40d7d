"""Session construction and a few cluster-safety helpers.

Everything here is plain Spark configuration.  Library functions never
create a session themselves; they take the caller's session or DataFrames.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package expects.  AQE re-plans joins and
# coalesces shuffle partitions at runtime; skew-join splits hot partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "contrail",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster ``master`` stays ``None`` so spark-submit decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared (HDFS/S3/ABFS) folder there; without one a
    cluster session is an error.  Only a ``local`` master gets a scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext; the conf is enough
        sc = None
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and sc is not None:
        path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not re.match(r"local(\[|$)", master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="contrail-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a plan is reused by several downstream jobs (model training)
    so that a lost executor recomputes from the checkpoint, not from scans.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and reread.

    Unlike a checkpoint, which holds whole rows uncompressed, the columns are
    encoded, a reader takes only those it needs, and the planner knows the size.
    The result carries nothing of its plan along, not even the constraints the
    optimizer derived; in a loop those double each round.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system its scheme names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
