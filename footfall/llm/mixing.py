"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

1. Targets: each source's share of all tokens by its weight; what exceeds three times its own tokens is shared again among
   the rest by weight, until none is above (the water level, found in one sorted pass over the sources).
2. Schedule: slot n draws the point frac(n * golden ratio) and the source whose stretch of the cumulative targets holds it.
   Any run of slots holds each source nearly in proportion. The slots of a source are ranked; ranks beyond its target are
   dropped and the few that a source lacks in the end are added behind the last slot.
3. Blocks: a source's documents, in the order of a hash, are one stream of tokens, cut into blocks of equal size. Slot k of a
   source takes block k, starting over after the last one; its last slot takes only the tokens up to the target.
4. A document takes what the slots of its blocks take of it.

Every ranking and running total goes over hash buckets or runs of slots first and inside one of them then, so no task
holds a source. Everything follows from ids, sizes and names: reruns agree.

Defined cases: a null text, or one without words, has size 0 and takes nothing; a null source is a source of its own, last in
order; repeated rows each count; a source without words has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from footfall.llm.common import row_digest
from footfall.session import materialise

GOLDEN = 0.6180339887498949
WORD = r"[^\x20\x09-\x0D]+"
#: Most times that a token is taken.
MOST = 3
BUCKETS = 4096
#: Slots of a run, ranked by one task, and cells of the unit interval that slots and sources meet in.
RUN = 8192
CELLS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """A text for every source, the null one included, that orders like them with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def targets(sizes: DataFrame, cycle: int = 3) -> DataFrame:
    """source_key, source_size, target and the stretch [low, high) of the unit interval, per source.

    Sources in order weigh 1, 2, ..., ``cycle``, repeating. One row per source goes through one task here.
    """
    by = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    order = W.orderBy("source_key")
    weighed = by.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("double"))
    room = weighed.withColumn("room", (F.col("source_size") * MOST).cast("double"))
    level = W.orderBy(F.col("room") / F.col("weight"), "source_key")
    every = W.partitionBy()
    filled = room.withColumns({
        "below": F.coalesce(F.sum("room").over(level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
        "above": F.sum("weight").over(level.rowsBetween(0, W.unboundedFollowing)),
        "total": F.sum("source_size").over(every).cast("double"),
    }).withColumn("rise", (F.col("total") - F.col("below")) / F.col("above"))
    # the first source, in the order of room by weight, that the water doesn't cover gives its level
    water = F.min(F.when(F.col("rise") <= F.col("room") / F.col("weight"), F.struct(
        (F.col("room") / F.col("weight")).alias("at"), F.col("source_key"), F.col("rise").alias("level")
    ))).over(every)["level"]
    share = filled.withColumn("target", F.least("room", water * F.col("weight")))
    cumulative = F.sum("target").over(order.rowsBetween(W.unboundedPreceding, 0))
    return share.withColumn("high", cumulative).select(
        "source_key", "source_size", "target",
        (F.col("high") - F.col("target")).alias("low"), "high", F.sum("target").over(every).alias("total"),
    )


def schedule(plan: DataFrame, block: int) -> DataFrame:
    """slot, source_key and rank (from 0) of every slot: the low-discrepancy order in which blocks are taken."""
    spark = plan.sparkSession
    total = round(plan.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0])
    n = -(-total // block)
    whole = F.floor("target")
    per_epoch = F.ceil(F.col("source_size") / block)
    quota = F.floor(whole / F.col("source_size")) * per_epoch + F.ceil(whole % F.col("source_size") / block)
    stretches = plan.where("target >= 1").select(
        "source_key", quota.alias("quota"), (F.col("low") / F.col("total")).alias("low"), (F.col("high") / F.col("total")).alias("high"),
        F.explode(F.sequence(
            F.floor(F.col("low") / F.col("total") * CELLS), F.least(F.floor(F.col("high") / F.col("total") * CELLS), F.lit(CELLS - 1))
        )).alias("cell"),
    )
    point = F.col("slot") * F.lit(GOLDEN)
    points = spark.range(1, n + 1).select(F.col("id").alias("slot")).withColumn("x", point - F.floor(point)).withColumn(
        "cell", F.floor(F.col("x") * CELLS)
    )
    held = points.join(stretches, "cell").where("low <= x and x < high").select(
        "slot", "source_key", "quota", F.floor(F.col("slot") / RUN).alias("run")
    )
    runs = held.groupBy("source_key", "run").agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(F.sum("c").over(W.partitionBy("source_key").orderBy("run").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(W.partitionBy("source_key", "run").orderBy("slot")) - 1
    ranked = held.join(runs.select("source_key", "run", before.alias("before")), ["source_key", "run"]).select(
        "slot", "source_key", "quota", (F.col("before") + inside).alias("rank")
    ).where("rank < quota").drop("quota")
    got = runs.groupBy("source_key").agg(F.sum("c").alias("got"))
    lacking = plan.where("target >= 1").select("source_key", quota.alias("quota")).join(got, "source_key", "left").withColumn(
        "got", F.coalesce("got", F.lit(0))
    ).where("got < quota")
    added = lacking.select("source_key", F.explode(F.sequence("got", F.col("quota") - 1)).alias("rank"))
    return ranked.unionByName(added.select((F.col("rank") + F.lit(n + 1)).alias("slot"), "source_key", "rank"))


def mix(docs: DataFrame, block: int = 2048, seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, taken and first_slot (null where nothing is taken), per row."""
    return _mixed(docs, block, seed).select("doc_id", "source", "size", "source_size", "target", "taken", "first_slot")


def _mixed(docs: DataFrame, block: int, seed: str) -> DataFrame:
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    sizes = materialise(docs.select(
        "doc_id", "source", _source_key(F.col("source")).alias("source_key"), word_count(F.col("text")).alias("size"),
        F.md5(F.concat_ws("|", F.lit(seed), text_id)).alias("place"),
    ), "sizes")
    plan = materialise(targets(sizes), "targets")

    # each document's first token in its source's stream
    bucket = F.conv(F.substring("place", 1, 3), 16, 10).cast("int")
    rows = sizes.withColumn("bucket", bucket)
    sums = rows.groupBy("source_key", "bucket").agg(F.sum("size").alias("words"))
    before = W.partitionBy("source_key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("source_key", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    within = W.partitionBy("source_key", "bucket").orderBy("place", "size").rowsBetween(W.unboundedPreceding, -1)
    stream = rows.join(starts, ["source_key", "bucket"]).withColumn(
        "first", F.col("start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    ).join(plan.select("source_key", "source_size", "target"), "source_key")

    # what each block gives, and when: whole visits, and the tokens of the last, shortened one
    per_epoch = F.ceil(F.col("source_size") / block)
    length = F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    slots = schedule(plan, block).join(plan, "source_key").withColumns({
        "epoch": F.floor(F.col("rank") / per_epoch), "block": F.col("rank") % per_epoch,
    }).withColumn(
        "tokens", F.least(length, F.floor("target") - F.col("epoch") * F.col("source_size") - F.col("block") * block)
    ).where("tokens > 0")
    visits = slots.groupBy("source_key", "block").agg(
        F.sum((F.col("tokens") == length).cast("int")).alias("whole"),
        F.max(F.when(F.col("tokens") < length, F.col("tokens")).otherwise(0)).alias("part"),
        F.min("slot").alias("slot"),
    )
    last = F.col("first") + F.col("size") - 1
    pieces = stream.where("size > 0").select(
        "source_key", "place", "first", "size",
        F.explode(F.sequence(F.floor(F.col("first") / block), F.floor(last / block))).alias("block"),
    ).join(visits, ["source_key", "block"])
    begin = F.greatest(F.col("first") - F.col("block") * block, F.lit(0))
    end = F.least(F.col("first") + F.col("size") - F.col("block") * block, F.lit(block))
    taken = pieces.groupBy("source_key", "place", "first").agg(
        F.sum((end - begin) * F.col("whole") + F.greatest(F.least(end, "part") - begin, F.lit(0))).alias("taken"),
        F.min("slot").alias("first_slot"),
    )
    # documents of size 0 share their first token with the next one, so they must not find its row
    mine = F.when(F.col("size") > 0, F.col("first")).otherwise(-1)
    return stream.withColumn("first", mine).join(taken, ["source_key", "place", "first"], "left").withColumns({
        "taken": F.coalesce("taken", F.lit(0)).cast("long"), "first_slot": F.when(F.col("taken") > 0, F.col("first_slot")),
    })


def apply(docs: DataFrame, block: int = 2048, seed: str = "mix") -> DataFrame:
    """The documents as the mix takes them: whole, as often as their words are taken, to the nearest whole number (halves up).

    Only the document in which a source's target ends is taken in part, so a source's words differ from what the mix takes by at
    most half of that document. Documents without words have nothing to take and are left out. Along a source's stream the
    number of copies falls once, by one, so each source has one place where it falls: other documents are compared with
    it where they are, and texts need no shuffle. Columns may be of any type.
    """
    times = F.floor((F.col("taken") * 2 + F.col("size")) / (F.col("size") * 2)).cast("long")
    found = _mixed(docs, block, seed).where("size > 0").select("source_key", "place", "size", "first", times.alias("times"))
    marked = materialise(found, "mixed")
    most = marked.groupBy("source_key").agg(F.max("times").alias("most"))
    falls = materialise(marked.join(most, "source_key").groupBy("source_key").agg(
        F.max("most").alias("most"), F.min(F.when(F.col("times") < F.col("most"), F.col("place"))).alias("fall")
    ).where("most > 0"), "falls")
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # documents travel as one column, so that none of theirs can clash
    placed = docs.select(
        F.struct(*docs.columns).alias("doc"), _source_key(F.col("source")).alias("source_key"),
        word_count(F.col("text")).alias("size"), F.md5(F.concat_ws("|", F.lit(seed), text_id)).alias("place"),
    ).where("size > 0").join(falls, "source_key")
    times = F.when(F.col("fall").isNull() | (F.col("place") < F.col("fall")), F.col("most")).otherwise(F.col("most") - 1)
    plain = placed.where("fall is null or place <> fall").select("doc", times.alias("times"))
    # the documents at the fall, one per source unless rows repeat an id
    alike = ["source_key", "place", "size"]
    cut = marked.join(falls.where("fall is not null").select("source_key", F.col("fall").alias("place")), ["source_key", "place"]).select(
        *alike, "times", F.row_number().over(W.partitionBy(*alike).orderBy("first")).alias("copy")
    )
    in_order = W.partitionBy(*alike).orderBy("doc.text", row_digest(F.col("doc")))
    at_fall = placed.where("place = fall").select(*alike, "doc", F.row_number().over(in_order).alias("copy"))
    copies = plain.unionByName(at_fall.join(cut, [*alike, "copy"]).select("doc", "times")).where("times > 0")
    return copies.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("doc.*")
