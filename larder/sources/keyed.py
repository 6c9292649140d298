"""Collections in hash partitions of their key: updates in place, and membership without reading all keys.

A collection is a folder with ``data`` (partitioned by the hash of the key), ``filters`` (a blocked Bloom filter of the keys
of each partition, as rows) and ``layout`` (key column and sizes). A batch of updates rewrites the partitions that hold its
keys and no other file. New documents are first looked up in the filters: what no filter holds is new for certain, and only
the rest meets the keys of the partitions that they fall in.

Every step can be run again after a crash. Updated partitions are staged as a whole under the batch's name before they
replace the old ones. Filter rows are written before the documents: a filter that knows too much costs a look at the keys,
one that knows too little would let a document in twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.joins import one_per_key, unknown, update_by_key
from larder.session import materialise

PARTITIONS = 64
#: Blocks of 256 bits in the filter of one partition. Twenty keys a block give about one false hit in a hundred; with
#: more keys there are more false hits, and no wrong results.
BLOCKS = 4096
WORDS = 4
PART = "part_"


def exists(spark: SparkSession, path: str) -> bool:
    """Does a file or folder exist in the path's own file system?"""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def part_of(key: Column, partitions: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


def bits_of(key: Column, blocks: int) -> list[Column]:
    """Block of a key, then two set bits in each of the block's words."""
    h = F.xxhash64(key, F.lit(1))
    spots = [F.shiftright(h, 12 * i).bitwiseAND(63).cast("int") for i in range(WORDS)]
    more = [F.shiftright(h, 12 * i + 6).bitwiseAND(63).cast("int") for i in range(WORDS)]
    one = F.lit(1).cast("bigint")

    def at(i: Column) -> Column:
        return F.call_function("shiftleft", one, i)

    block = F.pmod(F.xxhash64(key, F.lit(2)), F.lit(blocks)).cast("int")
    return [block.alias("block"), *[at(a).bitwiseOR(at(b)).alias(f"w{i}") for i, (a, b) in enumerate(zip(spots, more, strict=True))]]


def layout(spark: SparkSession, path: str) -> tuple[str, int, int]:
    """Key column, number of partitions and of filter blocks of a collection."""
    return tuple(spark.read.parquet(f"{path}/layout").first())


def create(docs: DataFrame, path: str, key: str, partitions: int = PARTITIONS, blocks: int = BLOCKS) -> None:
    """Write a collection of one document at least. Documents without a key lie in the partition of the null hash.

    The layout comes last: a collection without one isn't there yet.
    """
    spark = docs.sparkSession
    docs = docs.withColumn(PART, part_of(F.col(key), partitions))
    _filters(docs, key, blocks).write.mode("overwrite").partitionBy(PART).parquet(f"{path}/filters")
    docs.repartition(PART).write.mode("overwrite").partitionBy(PART).parquet(f"{path}/data")
    rows = [(key, partitions, blocks)]
    spark.createDataFrame(rows, "key string, partitions int, blocks int").write.mode("overwrite").parquet(f"{path}/layout")


def _filters(docs: DataFrame, key: str, blocks: int) -> DataFrame:
    """(part_, block, w0..w3): the bits of all keys, combined on the map side."""
    bits = docs.where(F.col(key).isNotNull()).select(PART, *bits_of(F.col(key), blocks))
    return bits.groupBy(PART, "block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def _data(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/data")


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All documents."""
    return _data(spark, path).drop(PART)


def _parts(df: DataFrame) -> list[int]:
    """The partitions that rows fall in: a list no longer than their fixed number."""
    return sorted(r[0] for r in df.select(PART).distinct().collect())


def update(spark: SparkSession, path: str, updates: DataFrame, column: str, row_key: str, batch: str) -> int:
    """Set ``column`` on the first document (smallest ``row_key``) of each updated key; returns the partitions rewritten.

    ``updates`` has (key, column); of several rows of a key the largest value counts; null keys and keys without a document
    change nothing. ``batch`` names the batch. The last batch may be run again, whole or after a crash, and gives the same collection; an
    earlier one would bring its staged partitions back.
    """
    key, partitions, _ = layout(spark, path)
    staged = f"{path}/batches/{batch}"
    if not exists(spark, f"{staged}/_SUCCESS"):
        patch = materialise(updates.where(F.col(key).isNotNull()).select(key, column), "updates")
        parts = _parts(patch.select(part_of(F.col(key), partitions).alias(PART)))
        touched = _data(spark, path).where(F.col(PART).isin(parts))
        # a document's partition follows from its key, so it stays where it is
        done = update_by_key(touched, patch, key, column, row_key)
        done.repartition(PART).write.mode("overwrite").partitionBy(PART).parquet(staged)
    if not any_rows(spark, staged):
        return 0
    rows = spark.read.parquet(staged)
    parts = _parts(rows)
    rows.repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(f"{path}/data")
    return len(parts)


def any_rows(spark: SparkSession, path: str) -> bool:
    """Has a written folder any partition? One without rows has no file to take a schema from."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return any(f.getPath().getName().startswith(PART) for f in found)


def possible(docs: DataFrame, path: str) -> DataFrame:
    """The documents whose key a filter holds; all others are not in the collection. Adds the partition."""
    key, partitions, blocks = layout(docs.sparkSession, path)
    plain = docs.withColumn(PART, part_of(F.col(key), partitions))
    asked = plain.select("*", F.struct(*bits_of(F.col(key), blocks)).alias("_bits"))
    filters = docs.sparkSession.read.parquet(f"{path}/filters").alias("f")
    held = (F.col(f"_asked.{PART}") == F.col(f"f.{PART}")) & (F.col("_asked._bits.block") == F.col("f.block"))
    for i in range(WORDS):
        want = F.col(f"_asked._bits.w{i}")
        held = held & (F.col(f"f.w{i}").bitwiseAND(want) == want)
    return asked.alias("_asked").join(filters, held, "left_semi").drop("_bits")


def absent(docs: DataFrame, path: str) -> DataFrame:
    """Documents whose key the collection doesn't have; null keys are never in it.

    Keys are read only from the partitions of the documents that a filter holds.
    """
    spark = docs.sparkSession
    key, *_ = layout(spark, path)
    hits = materialise(possible(docs.select(key).distinct(), path), "possible-keys")
    return unknown(docs, known_keys(spark, path, hits), key)


def known_keys(spark: SparkSession, path: str, hits: DataFrame) -> DataFrame:
    """The keys among ``hits`` that the collection has, from the key column of their partitions."""
    key, *_ = layout(spark, path)
    keys = _data(spark, path).where(F.col(PART).isin(_parts(hits))).select(PART, key)
    return hits.join(keys, [PART, key], "left_semi").select(key)


def append_unknown(docs: DataFrame, path: str, order: str) -> int:
    """Append the documents whose key is new, of several with one key that of the smallest ``order``; returns their number.

    Documents without a key are left out. Running a batch again appends nothing.
    """
    spark = docs.sparkSession
    key, partitions, blocks = layout(spark, path)
    single = one_per_key(docs.where(F.col(key).isNotNull()), key, order).select(*docs.columns)
    new = materialise(absent(single, path).withColumn(PART, part_of(F.col(key), partitions)), "new-documents")
    _filters(new, key, blocks).write.mode("append").partitionBy(PART).parquet(f"{path}/filters")
    new.repartition(PART).write.mode("append").partitionBy(PART).parquet(f"{path}/data")
    return new.count()


def append_or_create(docs: DataFrame, path: str, key: str, order: str) -> int:
    """``append_unknown``, which creates a collection that isn't there yet."""
    if exists(docs.sparkSession, f"{path}/layout/_SUCCESS"):
        return append_unknown(docs, path, order)
    single = one_per_key(docs.where(F.col(key).isNotNull()), key, order).select(*docs.columns)
    single = materialise(single, "first-documents")
    n = single.count()
    if n:
        create(single, path, key)
    return n


def merge_filters(spark: SparkSession, path: str) -> None:
    """Replace the filter rows of all batches by one set, after many appends."""
    bits = [F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]
    merged = materialise(spark.read.parquet(f"{path}/filters").groupBy(PART, "block").agg(*bits), "merged-filters")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(f"{path}/filters")
