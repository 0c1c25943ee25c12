"""Session, table access and durable intermediate results."""

from __future__ import annotations

import atexit
import hashlib
import io
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lexmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine is written for; callers may override any of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where that is unset and everything runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = tempfile.mkdtemp(prefix="lexmill-")
        atexit.register(shutil.rmtree, _own_dir[app], True)
    return "file://" + _own_dir[app]


def durable(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    This cuts the lineage and survives the loss of executors; the columns are
    stored compressed, which a plain RDD checkpoint would not do. The files stay
    as long as the driver lives, as the result reads them lazily.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"lexmill-{label}-{uuid.uuid4().hex}")
    if path.startswith(("file:", "/")):  # other file systems are cleared by whoever names the folder
        atexit.register(shutil.rmtree, path.removeprefix("file://").removeprefix("file:"), True)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Hands this package to the Python workers, wherever they run; once per application."""
    context = spark.sparkContext
    if any(os.path.basename(x).startswith("lexmill-code-") for x in context.listFiles):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(root):  # already imported from such an archive
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                entry = zipfile.ZipInfo(os.path.join("lexmill", os.path.relpath(path, root)))
                with open(path, "rb") as f:
                    out.writestr(entry, f.read())
    name = f"lexmill-code-{hashlib.sha1(data.getvalue()).hexdigest()[:16]}.zip"
    context.addPyFile(_put(spark, name, data.getvalue()))


def _put(spark: SparkSession, name: str, data: bytes) -> str:
    """Writes a file of the shared folder whole or not at all; its path."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    path, part = make(f"{shared_dir(spark)}/{name}"), make(f"{shared_dir(spark)}/{uuid.uuid4().hex}-{name}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        out = files.create(part)
        out.write(data)
        out.close()
        files.rename(part, path)
    return path.toString()


def share_file(spark: SparkSession, name: str, data: bytes) -> str:
    """Puts a file into the shared folder and hands it to every executor, also to later ones; its name for ``SparkFiles.get``.

    ``name`` must tell the contents apart, as a hash does.
    """
    context = spark.sparkContext
    if name not in {os.path.basename(x) for x in context.listFiles}:
        context.addFile(_put(spark, name, data))
    return name


def forget(df: DataFrame) -> None:
    """Remove the files behind a result of :func:`durable` that nothing reads any more."""
    spark = df.sparkSession
    for name in {os.path.dirname(x) for x in df.inputFiles()}:
        if "/lexmill-" in name:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
