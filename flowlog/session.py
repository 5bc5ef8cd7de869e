"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "flowlog",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Session with UTC time, AQE and skew-join handling switched on.

    On a cluster pass ``master=None`` and let the launcher decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small partitions).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name it: on other than a local master an unset folder is an
    error. Local runs (tests) get a scratch folder.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        if path.split(":")[-1].strip("/") not in (context.getCheckpointDir() or ""):
            context.setCheckpointDir(path)
        return path
    if not context.getCheckpointDir():
        if context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is unset; name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="flowlog-ckpt-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame, name: str | None = None) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and return a scan of it.

    With ``name`` the result is written as a Parquet table under the folder
    (survives executor loss and can be re-read by later jobs); without it a
    reliable ``checkpoint()`` is used.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    if name is None:
        return df.checkpoint(eager=True)
    path = os.path.join(base, "tables", name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
