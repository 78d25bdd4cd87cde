"""Session settings and the shared folder used for written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "gaugeline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs are tuned for; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and every executor reach, for written intermediate tables.

    It lies below the folder in ``spark.checkpoint.dir``, else below the one given to
    ``setCheckpointDir``, else below the warehouse. A session that has none of them raises, and so does one whose
    executors are elsewhere and whose warehouse is a folder of this machine, as it is unless set: rows would be lost.
    """
    places = (
        spark.conf.get("spark.checkpoint.dir", None),
        spark.sparkContext.getCheckpointDir(),
        spark.conf.get("spark.sql.warehouse.dir", None),
    )
    base = next((place for place in places if place), None)
    fallen_back = base is not None and base == places[2] and not any(places[:2])
    if base is None or (fallen_back and not on_one_machine(spark) and base.startswith(("file:", "/"))):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def on_one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors are one process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder made by ``shared_folder`` once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
