"""Session set-up and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "jobsignal", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder() -> str:
    """A folder of this process, for a local session that names none; removed at its end."""
    folder = tempfile.mkdtemp(prefix="jobsignal-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def working_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one the cluster names, for tables between two jobs.

    Where nothing is named, a local session takes a folder that is removed when the process ends;
    any other has to name one.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
