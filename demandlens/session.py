"""Session defaults, the checkpoint location and the package on the workers."""

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app="demandlens", master=None, **conf):
    """A session with adaptive execution and skew-join splitting on.

    On a cluster the submitting side sets the master, the memory, the number of
    shuffle partitions and ``spark.checkpoint.dir``; nothing here overrides it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped = set()


def ship_package(spark):
    """Send this package to the Python workers of a session, which need not have it installed
    or be started from its folder. Once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix=f'{package.name}-')}/{package.name}", "zip",
                                      package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def shared_folder(spark):
    """The folder named in ``spark.checkpoint.dir``, which all executors share.

    Only a local session, where driver and executors share one disk, may fall
    back to a fresh temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="demandlens-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark, name):
    """A new path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df):
    """``df`` cut from its lineage by a checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
