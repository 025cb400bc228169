"""Data checks: stored features against recomputed ones, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.ratios import near
from footfall.session import materialise


def _verdict(stored: DataFrame, fresh: DataFrame, key: str, column: str, same: Column) -> DataFrame:
    a = stored.select(key, F.col(column).alias("_stored"), F.lit(True).alias("_has_stored"))
    b = fresh.select(key, F.col(column).alias("_fresh"), F.lit(True).alias("_has_fresh"))
    both = a.join(b, key, "full_outer")
    return both.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("_has_stored").isNull()).alias("only_fresh"),
        F.count_if(F.col("_has_fresh").isNull()).alias("only_stored"),
        F.count_if(F.col("_has_stored") & F.col("_has_fresh") & ~same).alias("differing"),
    ).select(F.lit(column).alias("feature"), "*")


def counts_agree(stored: DataFrame, fresh: DataFrame, key: str, column: str) -> DataFrame:
    """One row: keys, keys in one side only, keys whose counts differ."""
    return _verdict(stored, fresh, key, column, F.col("_stored").eqNullSafe(F.col("_fresh")))


def ratios_agree(
    stored: DataFrame, fresh: DataFrame, key: str, column: str, tolerance: float = 1e-6
) -> DataFrame:
    """The same within a tolerance, NULL equal to NULL."""
    return _verdict(stored, fresh, key, column, near(F.col("_stored"), F.col("_fresh"), tolerance))


def all_agree(stored: DataFrame, fresh: DataFrame, key: str, tolerance: float = 1e-6) -> DataFrame:
    """A row per feature of two tables of one key, from one join: keys, stored values, keys in one side only, keys that differ.

    Doubles agree within the tolerance, everything else exactly; NULL equals NULL.
    """
    names = [c for c in stored.columns if c != key]
    a = stored.select(key, *[F.col(c).alias(f"a{i}") for i, c in enumerate(names)], F.lit(True).alias("_has_stored"))
    b = fresh.select(key, *[F.col(c).alias(f"b{i}") for i, c in enumerate(names)], F.lit(True).alias("_has_fresh"))
    both = F.col("_has_stored") & F.col("_has_fresh")
    differing = []
    for i, c in enumerate(names):
        x, y = F.col(f"a{i}"), F.col(f"b{i}")
        same = near(x, y, tolerance) if stored.schema[c].dataType.typeName() == "double" else x.eqNullSafe(y)
        differing.append(F.count_if(both & ~same).alias(f"d{i}"))
    row = a.join(b, key, "full_outer").agg(
        F.count(F.lit(1)).alias("keys"), F.count_if(F.col("_has_stored").isNull()).alias("only_fresh"),
        F.count_if(F.col("_has_fresh").isNull()).alias("only_stored"),
        *[F.count(f"a{i}").alias(f"p{i}") for i in range(len(names))], *differing,
    )
    parts = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"p{i}").alias("present"), F.col(f"d{i}").alias("differing"))
        for i, c in enumerate(names)
    ])
    return row.select(F.inline(parts), "keys", "only_fresh", "only_stored")


#: Buckets of keys a fingerprint is kept for: the bound on what is broadcast.
BUCKETS = 1 << 16
#: The bucket of rows without a key, which agree with nothing.
_NO_KEY = -1


def _bucket(key: str, buckets: int) -> Column:
    return F.coalesce(F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(buckets))), F.lit(_NO_KEY)).cast("int")


def fingerprints(table: DataFrame, key: str, names: list[str], buckets: int = BUCKETS) -> DataFrame:
    """A row per bucket of keys: rows, and for each column its values present and a hash of its (key, value) pairs that
    doesn't depend on their order: the exclusive-or of 64-bit hashes and the sum of their lower 31 bits.

    Hashes are summed before the shuffle, so a table of any size sends a row per task and bucket.
    """
    columns = []
    for i, c in enumerate(names):
        pair = F.xxhash64(F.lit(i), F.col(key), F.col(c), F.col(c).isNull())
        columns += [
            F.count(c).alias(f"p{i}"), F.bit_xor(pair).alias(f"x{i}"),
            F.sum(pair.bitwiseAND(F.lit((1 << 31) - 1))).alias(f"s{i}"),
        ]
    return table.groupBy(_bucket(key, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), *columns)


def agree_by_fingerprint(
    stored: DataFrame, fresh: DataFrame, key: str, tolerance: float = 1e-6, buckets: int = BUCKETS
) -> DataFrame:
    """The rows of :func:`all_agree` for tables whose keys are unique; only buckets whose fingerprints differ are joined.

    Where all agree, neither table is shuffled or joined. Equal fingerprints mean equal values but for a chance of 2^-95 per
    bucket and column. Doubles that are close but not the same differ in the fingerprint and are compared in the join. Rows without
    a key are always compared. Both tables are read twice where something differs; give written ones.
    """
    names = [c for c in stored.columns if c != key]
    spark = stored.sparkSession
    a = fingerprints(stored, key, names, buckets)
    b = fingerprints(fresh, key, names, buckets)
    marks = [c for c in a.columns if c != "bucket"]
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in marks if not c.startswith("p")]
    agrees = F.col("a.bucket").isNotNull() & F.col("b.bucket").isNotNull() & (F.col("a.bucket") != _NO_KEY)
    for equal in same:
        agrees = agrees & equal
    met = materialise(a.alias("a").join(b.alias("b"), F.col("a.bucket") == F.col("b.bucket"), "full_outer").select(
        F.coalesce("a.bucket", "b.bucket").alias("bucket"), agrees.alias("agrees"), F.col("a.rows").alias("rows"),
        *[F.col(f"a.p{i}").alias(f"p{i}") for i in range(len(names))],
    ), "fingerprints")
    zero = F.lit(0).cast("bigint")
    parts = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.sum(f"p{i}"), zero).alias("present"), zero.alias("differing"))
        for i, c in enumerate(names)
    ])
    settled = met.where("agrees").agg(parts.alias("parts"), F.coalesce(F.sum("rows"), zero).alias("keys")).select(
        F.inline("parts"), "keys", zero.alias("only_fresh"), zero.alias("only_stored")
    )
    open_buckets = met.where("not agrees").select(F.col("bucket").alias("_bucket"))
    if open_buckets.isEmpty():
        return settled
    # at most a row per bucket, whatever the tables hold
    listed = F.broadcast(open_buckets)
    left, right = (
        t.join(listed, _bucket(key, buckets) == F.col("_bucket"), "left_semi") for t in (stored, fresh)
    )
    numbers = ["present", "differing", "keys", "only_fresh", "only_stored"]
    both = settled.unionByName(all_agree(left, right, key, tolerance))
    return both.groupBy("feature").agg(*[F.sum(n).alias(n) for n in numbers])


def hour_is_tied(stored: DataFrame, tied: DataFrame, key: str, column: str) -> DataFrame:
    """Whether the stored hour is one of the hours sharing the highest count (at most 24 a key)."""
    sets = tied.groupBy(key).agg(F.collect_set(F.col(column).cast("int")).alias("_hours"))
    return stored.join(sets, key, "left").select(
        key, column, F.array_contains("_hours", F.col(column)).alias("is_peak")
    )


def duplicate_keys(table: DataFrame, key: str) -> DataFrame:
    return table.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def shape(table: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and columns of a table."""
    return table.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.lit(len(table.columns)).cast("bigint").alias("columns"),
    )
