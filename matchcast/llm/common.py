"""Reading tables, scratch tables in the shared folder, and joins that stand hot keys."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_SHARE = 1000  # a key with more than this fraction of all rows is split; so at most this many are hot
SALTS = 64
ROWS = 512  # of an Arrow batch that are worked on at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see.

    It lies in ``spark.checkpoint.dir``; where that is unset, in the warehouse, which is shared too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends, its size is known.

    Shuffle files of what is no longer referred to go with the driver's garbage, which is why that is collected.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    spark._jvm.System.gc()
    found = spark.read.schema(df.schema).parquet(path)
    found._settled_at = path
    return found


def release(df: DataFrame) -> None:
    """Delete the files of a settled table that nothing reads any more."""
    path = getattr(df, "_settled_at", None)
    if path is None:
        return
    spark = df.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def text_hash(text: str | Column = "text") -> Column:
    """With the id, names a document's row: rows equal in both are copies of one another."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def join_groups(
    rows: DataFrame, groups: DataFrame, keys: list[str], size: str, spread: Column, how: str = "left"
) -> DataFrame:
    """Give each of ``rows`` the columns of its group, where one group may hold a third of all rows.

    ``groups`` has one row per key and the number of ``rows`` it stands for in ``size``; it should
    be settled, as it is read three times. Keys are not null. Groups with more than 1/1000 of
    all rows, so at most 1000, are told to the rows by a broadcast; each is dealt out over 64
    tasks by ``spread``, to which its one row is copied.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    limit = max(total // HOT_SHARE, 1)
    hot = groups.filter(F.col(size) > limit).select(*keys, F.lit(True).alias("_hot"))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    left = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_hot")
    salts = F.when(F.col(size) > limit, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = groups.withColumn("_salt", F.explode(salts))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def drop_rows(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``gone(id, h)`` names, all columns as they were."""
    return _by_row(docs, gone, id_col, text_col, "left_anti")


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``kept(id, h)`` names, all columns as they were."""
    return _by_row(docs, kept, id_col, text_col, "left_semi")


def _by_row(docs: DataFrame, named: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    key = [F.col(id_col).alias("_id"), text_hash(text_col).alias("_h")]
    listed = named.select(F.col("id").alias("_id2"), F.col("h").alias("_h2"))
    keyed = docs.select("*", *key)
    same = F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_h") == F.col("_h2"))
    return keyed.join(listed, same, how).select(*(F.col(f"`{c}`") for c in docs.columns))


def _ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once a session: they need not have it installed.

    A zip of its sources is written to the shared folder, from where Spark brings it to each Python worker.
    """
    context = spark.sparkContext
    if getattr(context, "_matchcast_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent).as_posix())
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/matchcast-{uuid.uuid4().hex}.zip")
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(where)
    out.write(bytearray(held.getvalue()))
    out.close()
    context.addPyFile(store.makeQualified(where).toString())
    context._matchcast_shipped = True


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow``, on executors that have this package, and by few rows at a time to need less memory."""
    _ship(df.sparkSession)

    def by_few(batches):
        return function(b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS))

    return df.mapInArrow(by_few, schema)


def byte_texts(column: pa.Array) -> list[bytes]:
    """The texts of a batch in UTF-8; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def out_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
