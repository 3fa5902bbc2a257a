"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hosts and exit addresses may be shared by very many endpoints; their
    # lookups are joins whose big side AQE may split.
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master=None, app="endpulse", **conf):
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark, purpose):
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. A
    machine-local folder is used in local mode only, where there is just one
    machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="endpulse-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
