"""Helpers shared by the training-data operators: shared scratch tables, word splitting, appended columns."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAP_BITS = 2**26  # 8 MB
_KEEP = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Runs of digits, letters a-z and non-ASCII characters, after lower-casing A-Z only, as UTF-8."""
    return text.encode().translate(_KEEP).split() if text else []


def sql_words(text: str) -> str:
    """The same words as a Spark SQL array expression over the given text expression."""
    lower = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', 0)"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only local sessions may go without."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tablemill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Tables written to the shared folder to cut lineage: what a lost executor held can be read again.

    Tables dropped early free their disk; the rest go when the driver's Python ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/tablemill/{name}-{uuid.uuid4().hex}"
        atexit.register(self._remove, self.root)

    def path(self, label: str) -> str:
        return f"{self.root}/{label}"

    def table(self, df: DataFrame, label: str) -> DataFrame:
        df.write.parquet(self.path(label))
        return self.spark.read.schema(df.schema).parquet(self.path(label))

    def drop(self, label: str) -> None:
        self._remove(self.path(label))

    def _remove(self, path: str) -> None:
        sc = self.spark.sparkContext
        if sc._jsc is None:
            return
        try:
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001  the session may have ended before the driver's Python
            return


def free_name(taken: list[str], name: str) -> str:
    """The name, with underscores put before it until no column has it."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def append(df: DataFrame, of: str, fields: list[T.StructField], fn: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """df with further columns, which fn makes from each Arrow batch of column `of`. No shuffle; rows keep their order."""
    schema = T.StructType([*df.schema.fields, *fields])
    index = df.columns.index(of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                cols = [*part.columns, *fn(part.column(index))]
                yield pa.RecordBatch.from_arrays(cols, names=[*part.schema.names, *(f.name for f in fields)])

    return df.mapInArrow(run, schema)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def maybe(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of docs whose key is a doc of named, and by chance some others, without a shuffle of docs: a bit map of
    MAP_BITS bits, whatever the number of names, is broadcast. Where it is full, more rows pass; the caller's join drops them."""
    bit = lambda c: F.pmod(F.xxhash64(F.lit(5), c), F.lit(MAP_BITS))
    slots = named.select(bit("doc").alias("bit")).select(F.expr("bitmap_bucket_number(bit)").alias("bucket"), F.expr("bitmap_bit_position(bit)").alias("at"))
    maps = slots.groupBy("bucket").agg(F.expr("bitmap_construct_agg(at)").alias("map"))
    own = docs.withColumn("bit", bit("key")).select(*docs.columns, F.expr("bitmap_bucket_number(bit)").alias("bucket"), F.expr("cast(bitmap_bit_position(bit) as int)").alias("at"))
    byte = "cast(conv(hex(substring(map, at div 8 + 1, 1)), 16, 10) as int)"
    return own.join(F.broadcast(maps), "bucket").where(F.expr(f"(shiftright({byte}, cast(at % 8 as int)) & 1) = 1")).select(*docs.columns)


def empty(df: DataFrame) -> bool:
    return df.select(F.lit(1)).limit(1).count() == 0
