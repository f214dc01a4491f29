"""Session settings the jobs are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from pagemill.storage import LOCAL_SCRATCH


def local_session(cpus: int | str = 8, app: str = "pagemill", **conf: str) -> SparkSession:
    """A local session for tests and bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.checkpoint.dir", LOCAL_SCRATCH)  # one machine: it is shared
        .config("spark.driver.memory", os.environ.get("PAGEMILL_DRIVER_MEMORY", "12g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, as ``--py-files`` would; once a context."""
    import pathlib
    import shutil
    import tempfile

    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = pathlib.Path(__file__).resolve().parent
    archive = shutil.make_archive(
        str(pathlib.Path(tempfile.mkdtemp(prefix="pagemill-py-")) / root.name), "zip", root.parent, root.name
    )
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()
