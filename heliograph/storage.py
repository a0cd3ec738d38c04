"""Shared folders, and documents that are replaced as a whole."""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where none is set, one of this machine if all tasks run on it, else an error."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if where is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="shared-")
            atexit.register(shutil.rmtree, _OWN[app].removeprefix("file://"), True)
        where = _OWN[app]
    return where


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and nothing before it runs again."""
    where = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a document: it is written beside its place and renamed, so readers see the old or the new one, on any file system Spark reads."""
    jvm = spark.sparkContext._jvm
    new, fs = _path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(new, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(new, _path(spark, path)[0], options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A document's text, or null where there is none."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_object(spark: SparkSession, path: str, value: dict) -> None:
    """A JSON object, keys sorted, replaced as a whole."""
    if not isinstance(value, dict):
        raise TypeError("only objects are stored")
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n")


def read_object(spark: SparkSession, path: str) -> dict | None:
    text = read_text(spark, path)
    value = None if text is None else json.loads(text)
    if value is not None and not isinstance(value, dict):
        raise ValueError(f"{path} holds no object")
    return value


def load_state(spark: SparkSession, path: str, default: dict | None = None, version: int = 1) -> dict:
    """A collector's state; where there is none, the default.  Another version is an error."""
    value = read_object(spark, path)
    value = {"version": version, **(default or {})} if value is None else value
    if value.setdefault("version", version) != version:
        raise ValueError(f"{path} has version {value['version']}, not {version}")
    return value


save_state = write_object
