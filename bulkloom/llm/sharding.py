"""Sharding by a two-pass external shuffle: seeded hashes scatter, Fisher-Yates shuffles each bucket, buckets are laid end to end."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, repeat_numbers, row_ordinal, shield, shuffle_parts, stored

#: Bytes of text that a bucket holds on average; a task shuffles one bucket in memory.
BUCKET_BYTES = 8 << 20
#: Buckets that one shuffle partition holds, about.
PER_TASK = 2
#: Buckets whose counts are summed at a time, before the sums themselves are.
RANGE = 4096
#: Offsets of buckets are broadcast up to so many rows.
MAX_BROADCAST = 1_000_000


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A permutation of 0..n-1: each place from the last down swaps with a random place at or below it."""
    draws = np.random.Generator(np.random.PCG64(seed)).random(n)
    order = list(range(n))
    for i in range(n - 1, 0, -1):
        j = int(draws[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def bucket_offsets(counts: DataFrame) -> DataFrame:
    """(_bucket, _before) from (_bucket, count): rows in all buckets before it.

    Buckets are summed by ranges of RANGE first, so that the one window over all ranges has a row for every RANGE buckets.
    """
    ranged = counts.withColumn("_range", F.floor(F.col("_bucket") / RANGE))
    up_to = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    sums = ranged.groupBy("_range").agg(F.sum("count").alias("_sum")).select(F.col("_range").alias("_of"), F.coalesce(F.sum("_sum").over(up_to(W.partitionBy(F.lit(0)).orderBy("_range"))), F.lit(0)).alias("_first"))
    inside = F.coalesce(F.sum("count").over(up_to(W.partitionBy("_range").orderBy("_bucket"))), F.lit(0))
    return ranged.withColumn("_inside", inside).join(sums, F.col("_range") == F.col("_of")).select("_bucket", (F.col("_first") + F.col("_inside")).alias("_before"))


def shard(docs: DataFrame, shards: int = 16, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """docs with size, shard (0 to shards - 1) and slot (0, 1, ... without gaps in each shard), in random order.

    First pass: rows scatter by a seeded hash of doc_id and text into so many buckets that one holds about bucket_bytes; rows
    equal in both are numbered, and the number is hashed too, so that they scatter like all others and no bucket is hot. Second pass: each bucket is
    put in order of that hash, shuffled by Fisher-Yates with a seed of its own, and takes its place after the buckets
    before it. The whole order is then cut into shards whose counts differ by one at most, so a bucket goes to one
    shard or two neighbours. A shuffle partition holds about PER_TASK buckets, at any size of the table.

    size is the text's UTF-8 bytes plus 1 (null: none). Null and repeated doc_ids, repeated rows and empty texts are
    rows like others; copies of a text are spread, not kept together; an empty table gives an empty one. Runs agree,
    however the files are split. Columns of docs with the added names are replaced.
    """
    docs, restore = shield(stored(docs), ["doc_id", "text"])
    names = docs.columns
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    total, n = docs.agg(F.sum(size), F.count("*")).first()
    buckets = max(1, math.ceil((total or 0) / bucket_bytes))
    rows = docs.withColumns({"size": size, "_ord": row_ordinal(), "_key": F.xxhash64(F.lit(seed), "doc_id", "text")})
    numbers = repeat_numbers(rows.select("_ord", "_key"))
    rows = rows.withColumn("_nth", F.lit(None).cast("long")) if numbers is None else rows.join(numbers, F.col("_ord") == F.col("_row"), "left").drop("_row")
    rows = rows.withColumn("_scatter", F.xxhash64(F.lit(seed), "_key", F.coalesce("_nth", F.lit(0).cast("long")))).drop("_ord", "_key", "_nth")
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_scatter"), F.lit(buckets)).cast("int"))
    counts = materialise(rows.groupBy("_bucket").count(), "bucket-counts")
    offsets = materialise(bucket_offsets(counts), "bucket-offsets")
    parts = max(shuffle_parts(docs.sparkSession), -(-buckets // PER_TASK))
    if buckets <= MAX_BROADCAST:  # ranges of buckets: no partition holds more than its share
        rows = rows.repartitionByRange(parts, "_bucket").join(F.broadcast(offsets), "_bucket")
    else:
        rows = rows.repartition(parts, "_bucket").join(offsets, "_bucket")
    rows = rows.select("_bucket", "_before", "_scatter", *names, "size")
    fields = [f for f in rows.schema.fields if f.name not in ("_bucket", "_before", "_scatter")]
    schema = T.StructType([*fields, T.StructField("_at", T.LongType())])

    def shuffle(table: pa.Table) -> pa.Table:
        bucket, start = table["_bucket"][0].as_py(), table["_before"][0].as_py()
        by_hash = np.argsort(table["_scatter"].to_numpy(), kind="stable")
        order = by_hash[fisher_yates(table.num_rows, seed * 1_000_003 + bucket)]
        kept = table.drop_columns(["_bucket", "_before", "_scatter"]).take(pa.array(order))
        return kept.append_column("_at", pa.array(np.arange(start, start + table.num_rows)))

    out = rows.groupBy("_bucket").applyInArrow(shuffle, schema)
    less, more = divmod(n or 0, shards)
    cut = more * (less + 1)
    at = F.col("_at")
    long_ = at < cut
    which = F.when(long_, F.floor(at / (less + 1))).otherwise(more + F.floor((at - cut) / max(less, 1)))
    slot = F.when(long_, at % (less + 1)).otherwise((at - cut) % max(less, 1))
    return restore(out.withColumns({"shard": which.cast("int"), "slot": slot.cast("long")}), ["size", "shard", "slot"])


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write docs as one folder per shard, rows of a file in slot order."""
    out = shard(docs, **options)
    out.repartitionByRange(max(1, options.get("shards", 16)), "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op1(docs: DataFrame) -> DataFrame:
    out = shard(docs.select("doc_id", "text"))
    crc = F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b"").cast("binary")))
    return out.select("doc_id", "size", crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
