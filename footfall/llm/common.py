"""What several operators share: tables, folds, and the words of a text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts of the documents that labels or languages are never learned from.
FOLDS = 5


BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Let an Arrow batch hold about 8 MB (``size`` bytes) of texts, unless the session names a bound itself.

    Spark's own bound, 10,000 rows or 64 MB, is held several times by every task: in the JVM's buffers, as Arrow and as Python strings.
    """
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, str(size))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves no remainder; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def row_digest(row: Column) -> Column:
    """A digest of a struct's content that orders rows of any column types, maps included; equal rows have equal digests."""
    return F.md5(F.to_json(row))


def doc_draw(seed: str, doc_id: Column) -> Column:
    """A number in [0, 1) that depends on seed and id alone."""
    text = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(text, 1, 13), 16, 10).cast("bigint") / F.lit(float(16**13))


def bounded_sample(
    docs: DataFrame, seed: str, max_rows: int, max_chars: int, labels: DataFrame | None = None
) -> list[tuple]:
    """A repeatable draw of (doc_id, text, label) rows for a classifier fit on the driver.

    The label is a column of ``docs``, or of ``labels`` with the same doc_id. About ``max_rows`` rows and
    ``max_chars`` characters at most: a first pass counts both, from lengths alone, and the share drawn by the hash of
    doc_id follows; only drawn rows' texts are moved. Texts are whole. A text longer than a sixteenth of
    the character bound is left out of the fit, so that no single row can break the bound. Rows
    whose text or label is null don't count.
    """
    docs = docs.where(F.length("text") <= max_chars // 16)

    def labelled(kept: Column, *columns: Column) -> DataFrame:
        if labels is None:
            return docs.where(kept & F.col("label").isNotNull()).select(*columns, "label")
        known = labels.select("doc_id", "label").where(kept & F.col("label").isNotNull())
        return docs.where(kept).select("doc_id", *columns).join(known, "doc_id")

    counts = F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))
    rows, chars = labelled(F.lit(True), F.length("text").alias("n")).agg(*counts).first()
    share = min(1.0, max_rows / max(rows, 1), max_chars / max(chars, 1))
    drawn = doc_draw(seed, F.col("doc_id")) < share if share < 1 else F.lit(True)
    found = labelled(drawn, F.col("doc_id").alias("id"), F.col("text")).select("id", "text", "label")
    return sorted(map(tuple, found.collect()), key=repr)


def text_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, whole texts) of each Arrow batch; a null text is an empty one."""
    for batch in batches:
        yield batch.column(0), [x or "" for x in batch.column(1).to_pylist()]


def as_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)


def map_texts(docs: DataFrame, function, schema: str) -> DataFrame:
    """``function`` over Arrow batches of (doc_id, text) alone, whatever else the table holds."""
    return docs.select("doc_id", "text").mapInArrow(function, schema)
