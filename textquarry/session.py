"""One place for the session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that results depend on; everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "textquarry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times and AQE; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | conf).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    """Table ``name`` of a data folder (any file system Spark reads)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
