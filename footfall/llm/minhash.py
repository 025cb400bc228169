"""MinHash near-dedup: fast similarity sketches, banding, and exact verification on whole sets.

A document's set are its distinct word shingles, as 64-bit hashes. The sketch has ``size`` coordinates. In round after round every shingle
is thrown into a hashed coordinate and leaves a value there; earlier rounds win, then the least value. Later rounds
throw all shingles into one coordinate each, so every coordinate is filled whatever the size of the set, and the
share of equal coordinates concentrates about the similarity as it would for independent hashes. Bands of
coordinates are the buckets' keys: at similarity 0.8 a pair shares none of 64 bands of 8 with probability
0.000008, at 0.2 it shares one with probability 0.0002.

Equal sets are one class with one representative. Candidates among representatives are compared by the block, never as rows of pairs:

1. Each bucket names as its centre the member that meets the most others in all its buckets. A document's home
   is the best-placed centre it meets; homes are cut into blocks of bounded size. A block compares its own documents
   with each other and with the centre that visits it.
2. Buckets that still hold several components send their documents outside the main component to visit the
   homes of the others, in all their blocks. Visitors stream past a block's documents.

So every two documents that share a bucket are compared, unless they are known to be connected, and no link
between them is lost. Blocks give spanning edges only. All documents of a crowded bucket are fetched once; a bitmap of fixed size keeps most others
out of that shuffle.

Defined cases: a document without words, or text, has an empty set and links with nothing; fewer words than a
shingle has make one shingle; equal texts are one class; rows that repeat a doc_id count as one linked document; rows without a
doc_id link with nothing and are kept; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from footfall.llm.common import as_batch, map_texts, row_digest, text_batches
from footfall.llm.components import components
from footfall.session import materialise

FULL = np.uint64(2**64 - 1)
REMEMBERED_WORDS = 250_000
#: Bits of the bitmap that keeps documents without candidates out of the fetch: 4 MB whatever the data.
BITMAP = 1 << 25


@dataclass(frozen=True)
class Settings:
    """Shingles of ``words`` words link at ``percent`` of their union; sketches of bands times rows coordinates."""

    words: int = 5
    percent: int = 80
    bands: int = 64
    rows: int = 8
    #: Mean documents, and most shingles, of a block.
    block: int = 128
    block_shingles: int = 400_000

    @property
    def size(self) -> int:
        return self.bands * self.rows


def _mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeds(n: int, salt: int) -> np.ndarray:
    return _mix((np.arange(n, dtype=np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15))


class Shingler:
    """Texts to sorted arrays of distinct shingle hashes; remembers words up to a bound."""

    def __init__(self, words: int):
        self.words, self.memory = words, {}
        self.salt = _seeds(2 * words + 2, 1)

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()  # bytes: A-Z only, and the six ASCII white spaces
        if len(self.memory) > REMEMBERED_WORDS:
            self.memory = {}
        memory = self.memory
        for w in set(words).difference(memory):
            memory[w] = xxhash.xxh3_64_intdigest(w)
        codes = np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))
        k = min(self.words, len(words))
        if not k:
            return codes
        total = np.full(len(words) - k + 1, self.salt[self.words + k], np.uint64)
        for j in range(k):
            total = _mix(total + codes[j : len(words) - k + 1 + j] * (self.salt[j] | np.uint64(1)))
        return np.unique(total)


class Sketcher:
    def __init__(self, s: Settings):
        self.s, self.seeds = s, _seeds(2 * s.size, 1 << 20)
        self.odd = _seeds(s.rows, 1 << 21) | np.uint64(1)
        self.band = _seeds(s.bands, 1 << 22)

    def sketch(self, shingles: np.ndarray) -> np.ndarray:
        """One value per coordinate, the round in its highest bits."""
        size, n = self.s.size, len(shingles)
        out = np.full(size, FULL, np.uint64)
        rounds = np.arange(2 * size, dtype=np.uint64) << np.uint64(64 - (2 * size - 1).bit_length())
        shift = np.uint64((2 * size - 1).bit_length())
        at, step = 0, max(1, -(-8 * size // max(n, 1)))
        while at < size and (out == FULL).any():
            to = min(size, at + step)
            x = _mix(shingles[None, :] ^ self.seeds[at:to, None])
            value = rounds[at:to, None] | (x >> shift)
            np.minimum.at(out, (x % np.uint64(size)).ravel().astype(np.intp), value.ravel())
            at, step = to, max(1, step // 4)
        for i in np.flatnonzero(out == FULL).tolist():
            out[i] = rounds[size + i] | (_mix(shingles ^ self.seeds[size + i]).min() >> shift)
        return out

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        coordinates = self.sketch(shingles).reshape(self.s.bands, self.s.rows)
        return _mix(_mix((_mix(coordinates) * self.odd).sum(axis=1)) + self.band).view(np.int64)


def sketches(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n (size of the set), two hashes of the whole set, and the band keys, per row with a doc_id."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bands", pa.list_(pa.int64())),
    ])

    def run(batches: Iterable[pa.RecordBatch]):
        shingler, sketcher = Shingler(s.words), Sketcher(s)
        for ids, texts in text_batches(batches):
            for start in range(0, len(texts), 1000):
                sets = [shingler(t) for t in texts[start : start + 1000]]
                marks = np.array(
                    [np.frombuffer(xxhash.xxh3_128_digest(x.tobytes()), np.int64) for x in sets], np.int64
                ).reshape(-1, 2)
                yield as_batch(schema, [
                    ids.slice(start, len(sets)), [len(x) for x in sets], marks[:, 0], marks[:, 1],
                    [sketcher.bands(x) if len(x) else None for x in sets],
                ])

    return map_texts(docs, run, "doc_id long, n long, s1 long, s2 long, bands array<long>")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link, by exact counts."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.intersect1d(a, b, assume_unique=True).size
    return 100 * both >= percent * (len(a) + len(b) - both)


def links(own: list[np.ndarray], others: list[np.ndarray], percent: int) -> np.ndarray:
    """All linking pairs (i, j) of two lists of sets, by exact counts of common shingles."""
    if len(own) * len(others) <= 16:
        found = [(i, j) for i, a in enumerate(own) for j, b in enumerate(others) if linked(a, b, percent)]
        return np.array(found, np.int64).reshape(-1, 2)
    sizes, lists = [np.array([len(x) for x in part], np.int64) for part in (own, others)], (own, others)
    values, place = np.unique(np.concatenate([*own, *others]), return_inverse=True)
    row = np.concatenate([np.repeat(np.arange(len(part)), size) for part, size in zip(lists, sizes)])
    cut = int(sizes[0].sum())
    both = np.zeros((len(own), len(others)), np.float64)
    order = [np.argsort(place[:cut], kind="stable"), np.argsort(place[cut:], kind="stable") + cut]
    width = 4096
    stops = [np.searchsorted(place[o], np.arange(0, len(values) + width, width)) for o in order]
    for c in range(len(stops[0]) - 1):
        # common shingles of a slice of all values, as a product of 0/1 matrices
        sides = []
        for o, stop, part in zip(order, stops, lists):
            pick = o[stop[c] : stop[c + 1]]
            side = np.zeros((len(part), width), np.float32)
            side[row[pick], place[pick] - c * width] = 1
            sides.append(side)
        both += sides[0] @ sides[1].T
    return np.argwhere(100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both))


def _blocks(rows: Iterator[tuple]) -> Iterator[tuple[list[tuple], Iterator[tuple]]]:
    """(residents, visitors) of each block, from rows sorted by block and then residents first."""
    held: list[tuple] = []
    key = None
    visitors: list[tuple] = []
    for row in rows:
        if row[:2] != key:
            if held:
                yield held, visitors
            key, held, visitors = row[:2], [], []
        (visitors if row[2] else held).append(row)
        if len(visitors) == 64:
            if held:
                yield held, visitors
            visitors = []
    if held:
        yield held, visitors


def compare(placed: DataFrame, s: Settings) -> DataFrame:
    """Spanning edges (a, b) of the links within blocks, and of residents with visitors.

    ``placed`` has home, block, visits, id and text. Residents of a block are held; visitors come in parcels of 64.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]):
        shingler = Shingler(s.words)
        # a few texts at a time become Python's, however many an Arrow batch holds
        rows = (
            row for batch in batches for start in range(0, batch.num_rows, 256)
            for row in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns))
        )
        known: list[tuple] = []
        for held, visitors in _blocks(rows):
            edges = []
            if held is not known:
                known, sets = held, [shingler(r[4]) for r in held]
                edges += _spanning([r[3] for r in held], links(sets, sets, s.percent) if len(held) > 1 else ())
            if visitors:
                found = links(sets, [shingler(r[4]) for r in visitors], s.percent)
                edges += [(held[i][3], visitors[j][3]) for i, j in _first_of_each(found)]
            edges = [(a, b) for a, b in edges if a != b]
            if edges:
                yield as_batch(schema, [list(c) for c in zip(*edges)])

    ordered = placed.select("home", "block", "visits", "id", "text").repartition("home", "block")
    return ordered.sortWithinPartitions("home", "block", "visits").mapInArrow(run, "a long, b long")


def _spanning(ids: list[int], found) -> list[tuple[int, int]]:
    parent = list(range(len(ids)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    out = []
    for i, j in found:
        if i < j and (a := root(int(i))) != (b := root(int(j))):
            parent[b] = a
            out.append((ids[i], ids[j]))
    return out


def _first_of_each(found) -> list[tuple[int, int]]:
    """A spanning forest of the bipartite graph of residents and visitors."""
    ids = [("held", int(i)) for i, _ in found] + [("comes", int(j)) for _, j in found]
    places = {x: n for n, x in enumerate(dict.fromkeys(ids))}
    pairs = [(places[("held", int(i))], places[("comes", int(j))]) for i, j in found]
    names = list(places)
    kept = _spanning(list(range(len(names))), sorted((min(p), max(p)) for p in pairs))
    return [(names[a][1], names[b][1]) if names[a][0] == "held" else (names[b][1], names[a][1]) for a, b in kept]


def _bit(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(BITMAP))


def _bitmap(wanted: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with the bit of each id set; as it fills up, it only tells fewer apart."""
    bits = wanted.select(_bit(F.col("id")).alias("bit")).groupBy(F.floor(F.col("bit") / 32).alias("word"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 32).cast("int"))
    words = bits.agg(F.bit_or(one).alias("bits"))
    bitmap = np.zeros(BITMAP // 32, np.uint32)
    table = words.toArrow()
    bitmap[table.column(0).to_numpy()] = table.column(1).to_numpy().astype(np.uint32)
    return bitmap


def _by_bitmap(docs: DataFrame, bitmap: np.ndarray, inside: bool) -> DataFrame:
    """As one column ``doc``, the documents whose bit is set, or those whose bit is not, which have no listed id.

    A null id is not listed.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            bit = batch.column(1).to_numpy()
            hit = (bit >= 0) & ((shared.value[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1).astype(bool)
            yield batch.select([0]).filter(pa.array(hit == inside))

    bit = F.when(F.col("doc_id").isNull(), F.lit(-1).cast("long")).otherwise(_bit(F.col("doc_id")))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), bit.alias("bit"))
    return rows.mapInArrow(run, rows.select("doc").schema)


def fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (column id and others, ids once) with its documents' texts."""
    some = _by_bitmap(docs.where(F.col("text").isNotNull()).select("doc_id", "text"), _bitmap(wanted), True)
    return some.select(F.col("doc.doc_id").alias("id"), "doc.text").join(wanted, "id")


def near_duplicates(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links) and kept, per row of ``docs``."""
    s = settings or Settings()
    base = materialise(sketches(docs, s), "sketches")
    named = base.where(F.col("doc_id").isNotNull())
    sets = named.where(F.col("n") > 0).groupBy("s1", "s2").agg(F.min("doc_id").alias("class"))
    filled = named.where(F.col("n") > 0).select("doc_id", "n", "s1", "s2").join(sets, ["s1", "s2"])
    empty = named.where(F.col("n") == 0).select("doc_id", "n", F.col("doc_id").alias("class"))
    members = materialise(filled.select("doc_id", "n", "class").unionByName(empty), "members")

    heads = members.where(F.col("doc_id") == F.col("class")).groupBy("class").agg(F.max("n").alias("n"))
    rows = named.join(heads.select(F.col("class").alias("doc_id")), "doc_id", "left_semi").select(
        F.col("doc_id").alias("id"), F.explode("bands").alias("key")
    )
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1)
    crowded = materialise(rows.join(counts, "key"), "crowded")
    degree = crowded.groupBy("id").agg(F.sum("c").alias("degree"))
    ranked = materialise(crowded.join(degree, "id").select("key", "id", "degree"), "ranked")
    rank = F.struct("degree", (-F.col("id")).alias("minus"))
    centres = ranked.groupBy("key").agg(F.max(rank).alias("centre"))
    homes = ranked.join(centres, "key").groupBy("id").agg(F.max("centre").alias("centre")).select(
        "id", (-F.col("centre.minus")).alias("home")
    ).join(heads.select(F.col("class").alias("id"), "n"), "id")
    totals = homes.groupBy("home").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("docs") / s.block), F.ceil(F.col("shingles") / s.block_shingles))
    place = materialise(homes.join(totals, "home").select(
        "id", "home", F.pmod(F.xxhash64("id"), blocks).cast("long").alias("block"),
    ), "places")
    texts = materialise(fetch(docs, place), "texts")

    resident = texts.select("home", "block", F.lit(0).alias("visits"), "id", "text")
    calls = place.select("home", "block").distinct().select(F.col("home").alias("id"), F.col("home").alias("to"), "block")
    visitors = texts.select("id", "text").join(calls, "id").select(
        F.col("to").alias("home"), "block", F.lit(1).alias("visits"), "id", "text"
    )
    # texts of one id that are not equal, in rows that repeat it, hang together through their class
    same = members.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b")
    first = compare(resident.unionByName(visitors), s).unionByName(same.select("a", "b"))
    stars = components(first)

    now = materialise(
        ranked.select("key", "id").join(place, "id").join(stars, "id", "left")
        .withColumn("component", F.coalesce("component", "id")), "buckets",
    )
    parts = now.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
    mains = parts.groupBy("key").agg(
        F.max(F.struct("c", (-F.col("component")).alias("minus"))).alias("main"), F.count(F.lit(1)).alias("parts")
    ).where("parts > 1").select("key", (-F.col("main.minus")).alias("main"))
    mixed = now.join(mains, "key")
    # a host is a home with all its blocks: the buckets name few homes, however many blocks these have
    hosts = mixed.groupBy("key", F.col("home").alias("to")).agg(F.min("component").alias("low"), F.max("component").alias("high"))
    sent = mixed.where("component <> main").select("key", "id", "component").join(hosts, "key").where(
        "low <> component or high <> component"
    ).select("id", "to").distinct()
    parts = place.select(F.col("home").alias("to"), F.col("block").alias("at")).distinct()
    own = place.select("id", "home", "block")
    calls = sent.join(parts, "to").join(own, "id").where("not (home = to and block = at)").select("id", "to", "at")
    calls = materialise(calls, "calls")
    visitors = texts.select("id", "text").join(calls, "id").select(
        F.col("to").alias("home"), F.col("at").alias("block"), F.lit(1).alias("visits"), "id", "text"
    )
    visited = calls.select(F.col("to").alias("home"), F.col("at").alias("block")).distinct()
    second = compare(resident.join(visited, ["home", "block"], "left_semi").unionByName(visitors), s)
    final = components(stars.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(second))

    out = members.join(final.select(F.col("id").alias("class"), "component"), "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "class").alias("component_id")
    )
    unnamed = base.where(F.col("doc_id").isNull()).select(
        "doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
    )
    return out.unionByName(unnamed).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents, as they are, without those that are near copies of a kept one.

    Of rows that repeat a kept doc_id one stays, that of the least text, then of the least digest of the row; columns may be
    of any type. Documents that the bitmap rules out pass without a shuffle.
    """
    found = near_duplicates(docs, settings).where(F.col("doc_id").isNotNull())
    marked = materialise(
        found.groupBy("doc_id").agg(F.bool_and("kept").alias("keep"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 or not keep").select(F.col("doc_id").alias("id"), "keep"), "marked",
    )
    bitmap = _bitmap(marked)
    surely, perhaps = (_by_bitmap(docs, bitmap, inside) for inside in (False, True))
    rest = perhaps.withColumn("id", F.col("doc.doc_id")).join(marked, "id", "left")
    first = F.row_number().over(W.partitionBy("id").orderBy("doc.text", row_digest(F.col("doc"))))
    repeated = rest.where("keep").withColumn("place", first).where("place = 1").select("doc")
    return surely.unionByName(rest.where("keep is null").select("doc")).unionByName(repeated).select("doc.*")
