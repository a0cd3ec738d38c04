"""What the operators share: tables, Arrow mapping over blocks of texts, and small checks."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.shipping import ship
from llm.words import blocks_of


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Sessions that allow Arrow batches of more bytes are held to so many, which bounds a Python worker's memory; lower settings stay.
MOST_BATCH_BYTES = 8 << 20


def _ready(spark: SparkSession) -> None:
    ship(spark, "heliograph")
    ship(spark, "llm")
    # Arrow batches by bytes: a batch of the default 10,000 rows takes a worker some 200 MB if texts are long
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_BYTES)) > MOST_BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES, str(MOST_BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names in spark.checkpoint.dir.

    Where none is set, as in tests, a folder of this machine will do if all tasks run on
    it; on a cluster that is an error, as executors don't share such a folder.
    """
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


def cut(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: nothing before it runs again, and lost executors don't matter.

    Unlike ``checkpoint()`` the rows are computed once, not once to count and once to write.
    """
    spark = df.sparkSession
    _ready(spark)
    where = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(where)
    return spark.read.schema(df.schema).parquet(where)


def drop(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes the files of tables from ``cut`` once no later step reads them."""
    jvm = spark.sparkContext._jvm
    for t in tables:
        for f in {x.rpartition("/")[0] for x in t.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def whole_id(df: DataFrame, id_col: str) -> Column:
    """The identifier as a long; a column of another type than whole numbers is an error, as no cast keeps identifiers apart."""
    kind = df.select(F.col(id_col)).dtypes[0][1]
    if kind not in ("tinyint", "smallint", "int", "bigint", "void"):
        raise TypeError(f"identifiers in {id_col} must be whole numbers, not {kind}")
    return F.col(id_col).cast("long")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the identifier and the text, under fixed names; other columns can have any names."""
    _ready(df.sparkSession)
    return df.select(whole_id(df, id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def map_texts(df: DataFrame, of_block: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str) -> DataFrame:
    """mapInArrow over blocks of about a megabyte of text, so memory doesn't depend on how long texts are."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks_of(batch):
                out = of_block(block)
                if isinstance(out, pa.Table):
                    yield from out.to_batches()
                else:
                    yield out

    return df.mapInArrow(each, schema)
