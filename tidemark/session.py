"""Session settings the operators rely on, and the shared scratch folder."""

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution. Sizing is left to the caller and to AQE."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of an application, once: their tasks import it, from
    whatever folder they run."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    folder = tempfile.mkdtemp(prefix="tidemark-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "tidemark.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for place, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(place, name)
                    out.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares between its nodes, as `spark.checkpoint.dir` names it.

    Where nothing is configured a local session gets a temporary one, which goes when the process
    ends; any other session has to name a folder all its machines see."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder (nothing is created)."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings for one write, put back after it."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
