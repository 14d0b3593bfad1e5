"""What the training-data operators share: table access and durable intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

#: Rows of an id list that may be broadcast; longer lists are joined by a shuffle.
BROADCAST_IDS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once for each SparkContext."""
    sc = spark.sparkContext
    if not any(f.rpartition("/")[2] == "laddermill.zip" for f in sc.listFiles):
        root = Path(__file__).resolve().parents[2]
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-')}/laddermill", "zip", root, "laddermill"))


#: Folders of intermediate tables written by this process.
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); a temporary one only on a single machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back, so a lost executor never repeats the work before it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_intermediate(spark: SparkSession) -> None:
    """Deletes all tables that `materialize` has written; for when the results that read them have been written."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    while _WRITTEN:
        path = hadoop(_WRITTEN.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, bound: int = BROADCAST_IDS) -> DataFrame:
    """df, to be broadcast only if a count finds at most `bound` rows (of a few short columns)."""
    return F.broadcast(df) if df.count() <= bound else df


def semi_by_id(df: DataFrame, ids: DataFrame, key: str, bound: int = BROADCAST_IDS) -> DataFrame:
    """Rows of df whose key is in ids: ids are broadcast only if a count finds at most `bound` of them."""
    return df.join(small(ids.select(key).distinct(), bound), key, "left_semi")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def counted(values: Column) -> Column:
    """array<struct<value, n>>: the different values of an array without nulls, and how often it has each."""
    firsts = lambda s: F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (x != F.get(s, i - 1)), i)), lambda i: i.isNotNull())
    runs = lambda s, at: F.transform(at, lambda i, j: F.struct(F.get(s, i).alias("value"), (F.coalesce(F.get(at, j + 1), F.size(s)) - i).alias("n")))
    return let(F.sort_array(values), lambda s: let(firsts(s), lambda at: runs(s, at)))
