"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, ranges, overfull ranges divided again.

Law ``bytes``: shards hold nearly equal sums of sizes (UTF-8 bytes plus one). Records are ordered by the key (md5 of the text, doc_id), so
equal texts lie side by side and a group of them is cut only where a boundary of equal bytes falls into it.

1. Each record draws for the sample with a chance in proportion to its size; quantiles of the sampled keys are the
   splitters of fine ranges, many per shard.
2. Sizes of the ranges are counted exactly. A range of more than its fair share is divided by splitters sampled inside it, until none
   is overfull or only one key is left in it.
3. Exact running sums over the ranges, and inside each range, give every record its place in the order of all bytes. Its
   shard is the sixteenth its middle byte falls into; its slot counts up inside the shard.

The sample only decides how the work is spread: shards follow from keys and sizes alone, so reruns agree. All on
DataFrame functions; nothing is held by one task but a range, the sample and a row per range.

Defined cases: a null text counts as an empty one (size 1); a null doc_id orders first; repeated rows each get a slot of
their own; an empty table gives an empty result; columns of other names are kept away from the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from footfall.session import materialise

LAW = "bytes"
#: Fine ranges per shard, sampled keys per range, and times its mean share at which a range is overfull.
RANGES = 16
SAMPLED = 24
OVERFULL = 3.0
ROUNDS = 4


def _key(text_md5: Column, doc_id: Column) -> Column:
    return F.struct(text_md5.alias("text_md5"), F.coalesce(doc_id, F.lit(-(2**63)).cast("long")).alias("id"))


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return (F.xxhash64(*parts).bitwiseAND(F.lit(2**52 - 1))) / F.lit(float(2**52))


def _place(key: Column, bounds: Column, steps: int) -> Column:
    """How many of the sorted bounds are at or below the key, by bisection."""
    def step(at: Column, width: Column) -> Column:
        probe = F.get(bounds, at + width - 1)
        return F.when(probe.isNotNull() & (probe <= key), at + width).otherwise(at)

    widths = F.array(*[F.lit(1 << i) for i in reversed(range(steps))])
    return F.aggregate(widths, F.lit(0), step)


def _split(rows: DataFrame, totals: DataFrame, fine: Column, salt: int) -> DataFrame:
    """``rows`` (range, key, size) with their ranges cut into about ``fine`` (a column of ``totals``) parts each.

    The sample of a range has some dozens of keys per part, whatever the size of the range. Its quantiles go to the rows as an array, one
    per range.
    """
    parts = totals.withColumn("fine", fine)
    chance = F.col("size") * F.col("fine") * SAMPLED / F.col("bytes")
    sampled = rows.join(parts, "range").where(
        _unit(F.lit(salt), F.col("key.text_md5"), F.col("key.id")) < chance
    ).select("range", "key", "fine")
    rank = F.row_number().over(W.partitionBy("range").orderBy("key"))
    count = F.count(F.lit(1)).over(W.partitionBy("range"))
    # the keys at the quantiles: where rank / count passes a multiple of 1 / fine
    quantile = F.floor(rank * F.col("fine") / count)
    before = F.floor((rank - 1) * F.col("fine") / count)
    bounds = sampled.select("range", "key", quantile.alias("q"), before.alias("p"), "fine").where("q > p and q < fine").groupBy(
        "range"
    ).agg(F.array_sort(F.collect_set("key")).alias("bounds"))
    return rows.join(bounds, "range", "left")


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law), per row."""
    text = F.coalesce("text", F.lit(""))
    keyed = materialise(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        _key(F.md5(text), F.col("doc_id")).alias("key"),
    ), "keyed")
    total, n = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not n:
        return keyed.select(
            "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), F.lit(0).alias("shard"),
            F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    fair = total / (shards * RANGES)
    ranged = keyed.select("key", "size", "doc_id", "text_crc32", F.lit("").alias("range"))
    totals = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high"))
    steps = (2 * shards * RANGES).bit_length()
    for salt in range(ROUNDS):
        overfull = totals.where((F.col("bytes") > OVERFULL * fair) & (F.col("low") < F.col("high")))
        if salt and overfull.isEmpty():
            break
        parted = _split(ranged, overfull.select("range", "bytes"), F.ceil(F.col("bytes") / fair), salt)
        part = F.when(F.col("bounds").isNull(), F.lit("")).otherwise(
            F.lpad(_place(F.col("key"), F.col("bounds"), steps).cast("string"), 6, "0")
        )
        ranged = materialise(parted.withColumn("range", F.concat("range", part)).drop("bounds"), "ranged")
        totals = materialise(ranged.groupBy("range").agg(
            F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high")
        ), "ranges")

    counts = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        "range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("bytes", "rows")]
    )
    inside = W.partitionBy("range").orderBy("key", "size", "text_crc32")
    upto = inside.rowsBetween(W.unboundedPreceding, 0)
    middle = F.col("bytes_before") + F.sum("size").over(upto) - F.col("size") / 2
    placed = ranged.join(starts, "range").select(
        "doc_id", "size", "text_crc32", F.least(F.floor(middle * shards / total), F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("rows_before") + F.row_number().over(inside) - 1).alias("place"),
    )
    placed = materialise(placed, "placed")
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(firsts, "shard").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("place") - F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> None:
    """The documents under ``path``, a folder per shard, by their doc_id and text; ids are taken to be unique."""
    found = shard(docs, shards).select(F.col("doc_id").alias("_id"), "shard", "slot")
    rows = docs.join(found, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
    rows.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
