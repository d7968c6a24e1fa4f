"""What the operators share: text classes, row keys, tables in the cluster's shared folder."""

from __future__ import annotations

import atexit
import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words end at these characters only.
SPACE = r"\x20\x09-\x0D"
#: Internal columns; input columns of any other name pass through untouched.
OWN = "__ow_"

#: Rows of an Arrow batch of texts.
BATCH_ROWS = 1000

_made: list[tuple[SparkSession, str]] = []
_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, one machine has a temporary folder, and
    a cluster an error, since its executors have no folder in common that is known here."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="orthoweave-"))
        found = _own[0]
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes the rows as a Parquet table in the shared folder and reads them back with the same schema."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/orthoweave/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def clean() -> None:
    """Removes the tables written by materialize; results that still read them must have been consumed."""
    while _made:
        spark, path = _made.pop()
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session is gone; the folder belongs to the cluster
            return


def bounded_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of BATCH_ROWS at most, as a batch is held whole on both sides; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    found = F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+")
    return F.filter(found, lambda w: w != "")


def bucket(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
