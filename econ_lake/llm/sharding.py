"""Operator 6, sharding: a Feistel permutation with cycle walking over global row numbers.

Rows get the numbers 0..n-1 in an order that depends on the rows alone; a keyed Feistel network permutes
[0, 2^b), the smallest power of two that holds n; values of n or more are permuted again (cycle walking) until
they fall below n.  The place p of a row gives shard = p mod shards and slot = p div shards, so shard sizes
differ by one row at most (law ``rows``), and the place of any row number can be computed without the others.
DataFrame operations only.

Defined results: a null text has no bytes; a null doc_id sorts first; repeated rows are rows of their own;
an empty table gives no rows; other columns are not read; texts are measured whole.  Equal texts (the contract's groups)
needn't share a shard under the law ``rows``: they are told by text_crc32, and each row has a place of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from econ_lake.llm.shared import stored

SHARDS, OVERHEAD = 40, 16
#: Row numbers are counted within so many hash buckets; a bucket is the unit of sorting.
NUMBER_BUCKETS = 8192
ROUNDS = 6
#: A walk leaves [0, n) with a chance below 1/2 at each step; one of more than so many steps is reported, not cut.
WALK = 96


def _half_round(value: Column, key: int, bits: int) -> Column:
    """Round function: the low ``bits`` bits of a hash of value and key."""
    return F.xxhash64(value, F.lit(key)).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def feistel(place: Column, bits: int, seed: int) -> Column:
    """A permutation of [0, 2^bits): an unbalanced Feistel network whose halves take turns."""
    low, high = bits // 2, bits - bits // 2
    left, right = F.shiftright(place, low), place.bitwiseAND(F.lit((1 << low) - 1).cast("long"))
    for k in range(ROUNDS):
        if k % 2:
            right = right.bitwiseXOR(_half_round(left, seed + k, low))
        else:
            left = left.bitwiseXOR(_half_round(right, seed + k, high))
    return F.shiftleft(left, low).bitwiseOR(right)


def permuted(number: Column, n: int, seed: int) -> Column:
    """The place of row ``number`` among n."""
    if n <= 1:
        return number
    bits = max(2, (n - 1).bit_length())
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), feistel(number, bits, seed),
                         lambda at, _: F.when(at < n, at).otherwise(feistel(at, bits, seed)))
    return F.when(walked < n, walked).otherwise(
        F.raise_error(F.lit(f"a cycle walk took more than {WALK} steps; use another seed")).cast("long"))


def row_numbers(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``number``: 0..n-1 without gaps, the same however the rows are partitioned.

    Rows are counted per hash bucket of all the columns in ``order``, the bucket counts (a fixed number of them) are summed up, and
    each bucket is numbered on its own, so no task sees more than its buckets.
    """
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(NUMBER_BUCKETS)))
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = counts.select("bucket", (F.sum("rows").over(Window.orderBy("bucket")) - F.col("rows")).alias("before"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("bucket").orderBy(*order)))
    return (ranked.join(F.broadcast(before), "bucket")  # NUMBER_BUCKETS rows at most
            .withColumn("number", F.col("before") + F.col("rank") - 1).drop("bucket", "before", "rank"))


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = 20240229) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(docs.select("doc_id", (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
                              F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")), "sizes")
    n = rows.count()
    place = permuted(F.col("number"), n, seed)
    return (row_numbers(rows, ["doc_id", "text_crc32", "size"]).withColumn("place", place).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.pmod(F.col("place"), F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard")))
