"""Toxicity: nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Fitted on a bounded draw of labelled texts on the driver. Terms are all words of the draw, and besides them, with a weight
of their own, leaning ones: words and word beginnings (so that a stem counts whatever follows it) that are more common
among toxic texts than among the others, beyond chance; of nested beginnings the most telling stays. Beside the leaning ones
stands one term that every text holds by its number of words, so a single telling word weighs less in a long text.
A text is its TF-IDF vector over the words and that over the leaning terms, each with a fixed share of the squared length, which is one.
Words that no text of the draw holds are in no product and don't count. The
labelled vectors lie in blocks; an inverted index keeps each term's largest weight per block. A query adds up its terms'
block maxima, visits blocks from the largest bound down, and stops when the next bound is below the k-th
best cosine; where many blocks are left after the first one, it reads them by term in one pass. So its neighbours are
exactly those that a full scan would find (equal cosines: the smaller
id first). Votes count by the inverse of the squared distance, so that a copy outweighs the rest, shrunk towards the rate of all labels; leave-one-out votes of the labelled texts
fit a logistic curve that turns a vote into a probability. The nearest examples are kept as evidence.

Defined cases: a null text is an empty one and is scored like any other, with the labelled texts nearest to it
(all hold the lumped term); without labelled rows every score is 0; a null doc_id stays null and counts as held out; labels that are null are left
out, several of one id count as toxic if one of them does; repeated rows each give their own row; whole
texts are read; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from heapq import nsmallest

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import as_batch, bounded_sample, held_out, map_texts, text_batches

WORD = regex.compile(r"\p{L}+")
#: Lengths of the word beginnings that can be terms.
BEGINNINGS = range(3, 9)
END = "$"
REMEMBERED = 50_000


@dataclass(frozen=True)
class Settings:
    max_rows: int = 6_000
    max_chars: int = 12_000_000
    neighbours: int = 15
    block: int = 64
    #: Toxic texts that must hold a term, and the log-likelihood ratio it must reach.
    least_texts: int = 3
    least_ratio: float = 16.0
    #: How many times more common a term must be among toxic texts than among the others.
    least_lift: float = 3.0
    max_terms: int = 4_096
    #: Share of the leaning terms in a squared length; the words have the rest.
    lean: float = 0.5
    #: What is added to a squared distance before its inverse weighs a vote.
    nearly: float = 0.01
    #: Weight of the general rate in a vote.
    shrink: float = 1.0
    #: Labelled texts whose votes fit the curve.
    calibrate: int = 1_000


def _terms_of(word: str) -> list[str]:
    return [word[:n] for n in BEGINNINGS if n <= len(word)] + [word + END]


def _without_copies(texts: list[str]) -> list[set[str]]:
    """The distinct words of each text; near copies, told by their two least word hashes, as one.

    Otherwise any rare word of a text that was copied often would look telling.
    """
    groups: dict[tuple, set[str]] = defaultdict(set)
    for text in texts:
        words = set(WORD.findall(text.lower()))
        groups[tuple(nsmallest(2, (zlib.crc32(w.encode()) for w in words)))] |= words
    return list(groups.values())


def _ratio(a: int, b: int, positives: int, negatives: int) -> float:
    """Log-likelihood ratio of a term held by a of the positives and b of the negatives."""
    total, held = positives + negatives, a + b
    cells = (
        (a, held * positives), (b, held * negatives),
        (positives - a, (total - held) * positives), (negatives - b, (total - held) * negatives),
    )
    return 2 * sum(n * math.log(n * total / e) for n, e in cells if n > 0)


def choose_terms(rows: list[tuple], s: Settings) -> list[str]:
    """Terms that lean to the toxic texts, of nested ones the most telling."""
    toxic = _without_copies([t for _, t, y in rows if y])
    rest = _without_copies([t for _, t, y in rows if not y])
    held: Counter[str] = Counter()
    for words in toxic:
        held.update({t for w in words for t in _terms_of(w)})
    held = Counter({t: n for t, n in held.items() if n >= s.least_texts})
    others: Counter[str] = Counter()
    for words in rest:
        others.update({t for w in words for t in _terms_of(w) if t in held})
    scored = {}
    for term, a in held.items():
        b = others[term]
        if a * len(rest) >= s.least_lift * b * len(toxic):
            ratio = _ratio(a, b, len(toxic), len(rest))
            if ratio >= s.least_ratio:
                scored[term] = ratio
    chosen: list[str] = []
    for term in sorted(scored, key=lambda t: (-scored[t], t.endswith(END), -len(t), t)):
        stem = term.rstrip(END)
        if not any(stem.startswith(c.rstrip(END)) or c.rstrip(END).startswith(stem) for c in chosen):
            chosen.append(term)
        if len(chosen) == s.max_terms:
            break
    return sorted(chosen)


class Postings:
    """Values of terms at n places: as rows where a term has at least ``dense`` places, by place elsewhere."""

    def __init__(self, terms: np.ndarray, places: np.ndarray, values: np.ndarray, n_terms: int, n: int, dense: int):
        length = np.bincount(terms, minlength=n_terms)
        common = np.flatnonzero(length >= dense)
        self.row = np.full(n_terms, -1)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), n))
        wide = self.row[terms] >= 0
        self.rows[self.row[terms[wide]], places[wide]] = values[wide]
        self.places, self.values = places[~wide], values[~wide]
        self.start = np.searchsorted(terms[~wide], np.arange(n_terms + 1))

    def sums(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sums of weight times value at each place, over the entries of the terms alone."""
        row = self.row[terms]
        wide = row >= 0
        total = np.zeros(self.rows.shape[1])
        if wide.any():
            # einsum and not a BLAS product, whose threads wait busily
            total += np.einsum("i,ij->j", weights[wide], self.rows[row[wide]])
            terms, weights = terms[~wide], weights[~wide]
        begin = self.start[terms]
        length = self.start[terms + 1] - begin
        at = np.repeat(begin - np.cumsum(length) + length, length)
        at += np.arange(len(at))
        products = np.repeat(weights, length)
        products *= self.values[at]
        return total + np.bincount(self.places[at], products, len(total))


class Index:
    """Vectors of the labelled texts, in blocks, with each term's largest weight per block.

    Terms are the leaning ones, then all words; behind them, the lumped one.
    """

    def __init__(self, leaning: list[str], rows: list[tuple], s: Settings):
        self.s, self.leaning = s, leaning
        self._scan = None
        words = sorted({w for _, text, _ in rows for w in WORD.findall(text.lower())})
        self.terms = [*leaning, *words]
        self.place = {w: i for i, w in enumerate(words, len(leaning))}
        counts = [self.count(text) for _, text, _ in rows]
        holding = np.zeros(len(self.terms) + 1)
        for c in counts:
            holding[list(c)] += 1
        self.idf = np.log(1 + len(rows) / np.maximum(holding, 1))
        vectors = [self.arrays(c) for c in counts]
        # alike vectors side by side make tight blocks
        def alike(i: int):
            terms, weights = vectors[i]
            first = np.lexsort((terms, -weights))[:8]
            return [(-weights[j], terms[j]) for j in first], rows[i][0]

        order = sorted(range(len(rows)), key=alike)
        self.ids = [rows[i][0] for i in order]
        self.labels = np.array([float(rows[i][2]) for i in order])
        rank = {i: r for r, i in enumerate(sorted(range(len(rows)), key=lambda i: (rows[i][0], i)))}
        self.tie = np.array([rank[i] for i in order])
        # entries by text, and the same by term
        self.text_start = np.cumsum([0, *(len(vectors[i][0]) for i in order)])
        self.text_terms = np.concatenate([vectors[i][0] for i in order]).astype(np.int64)
        self.text_weights = np.concatenate([vectors[i][1] for i in order])
        places = np.repeat(np.arange(len(order), dtype=np.int64), np.diff(self.text_start))
        by_term = np.argsort(self.text_terms, kind="stable")
        terms, places, weights = self.text_terms[by_term], places[by_term], self.text_weights[by_term]
        n_terms, n_blocks = len(self.terms) + 1, -(-len(order) // s.block)
        self.postings = Postings(terms, places, weights, n_terms, len(order), max(1, len(order) // 4))
        # each term's largest weight per block that holds it
        cell = terms * n_blocks + places // s.block
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        self.largest = Postings(
            terms[first], cell[first] % n_blocks, np.maximum.reduceat(weights, first), n_terms, n_blocks, max(1, n_blocks // 4)
        )
        self._query = np.zeros(len(self.terms) + 1)
        self.rate = (sum(y for *_, y in rows) + 0.5) / (len(rows) + 1)
        self.slope, self.offset = 1.0, 0.0
        self._calibrate()

    def __getstate__(self):
        return {**self.__dict__, "_scan": None}  # the automaton is made anew where it is needed

    @property
    def vectors(self) -> list[dict[int, float]]:
        return [dict(zip(t.tolist(), w.tolist())) for t, w in map(self._labelled, range(len(self.ids)))]

    def _labelled(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.text_start[place], self.text_start[place + 1])
        return self.text_terms[own], self.text_weights[own]

    def count(self, text: str) -> dict[int, int]:
        """Occurrences of each leaning term, of each word of the draw, and of all words to the next power of two."""
        low, found = text.lower(), defaultdict(int)
        lumped = {len(self.terms): 1 << text.count(" ").bit_length()}
        place = self.place.get
        found.update((p, n) for w, n in Counter(WORD.findall(low)).items() if (p := place(w)) is not None)
        if not self.leaning:
            return {**found, **lumped}
        if self._scan is None:
            self._scan = ahocorasick.Automaton()
            for t, term in enumerate(self.leaning):
                stem = term.rstrip(END)
                self._scan.add_word(stem, (t, len(stem), term.endswith(END)))
            self._scan.make_automaton()
        for end, (t, length, whole) in self._scan.iter(low):
            start = end - length
            if start >= 0 and low[start].isalpha():
                continue
            if whole and end + 1 < len(low) and low[end + 1].isalpha():
                continue
            found[t] += 1
        return {**found, **lumped}

    def arrays(self, count: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of length one: the TF-IDF of all words, beside that of leaning and lumped terms."""
        terms = np.fromiter(count, np.int64, len(count))
        weights = (1 + np.log(np.fromiter(count.values(), float, len(count)))) * self.idf[terms]
        word = (terms >= len(self.leaning)) & (terms < len(self.terms))
        for part, share in ((word, 1 - self.s.lean), (~word, self.s.lean)):
            if part.any():
                weights[part] *= math.sqrt(share / (weights[part] @ weights[part]))
        return terms, weights / math.sqrt(weights @ weights)

    def vector(self, count: dict[int, int]) -> dict[int, float]:
        terms, weights = self.arrays(count)
        return dict(zip(terms.tolist(), weights.tolist()))

    def nearest(self, vector: dict[int, float], k: int, without: int = -1) -> list[tuple[float, int]]:
        return self.search(np.fromiter(vector, np.int64, len(vector)), np.fromiter(vector.values(), float, len(vector)), k, without)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k nearest labelled texts as (cosine, place), and the blocks' bounds decide how many are read.

        Where the bounds rule out few of the blocks, the rest are read by term, in one pass, instead of block by block.
        """
        bounds = self.largest.sums(terms, weights)
        order = np.argsort(-bounds, kind="stable")
        self._query[terms] = weights
        best: list[tuple[float, int, int]] = []
        for n, b in enumerate(order.tolist()):
            # bounds and cosines are sums in different orders: a hair of slack keeps ties
            least = best[k - 1][0] - 1e-9 if len(best) >= k else 0.0
            if bounds[b] <= 0 or bounds[b] < least:
                break
            if n >= 1 and np.count_nonzero(bounds >= least) - n > 6:
                best = self._best(self.postings.sums(terms, weights), 0, k, without)
                break
            at = b * self.s.block
            starts = self.text_start[at : at + self.s.block + 1]
            own = slice(starts[0], starts[-1])
            cosine = np.add.reduceat(self.text_weights[own] * self._query[self.text_terms[own]], starts[:-1][: len(self.ids) - at] - starts[0])
            best = sorted(best + self._best(cosine, at, k, without), reverse=True)[:k]
        self._query[terms] = 0
        return [(c, place) for c, _, place in best]

    def _best(self, cosine: np.ndarray, at: int, k: int, without: int) -> list[tuple[float, int, int]]:
        """The k largest cosines above 0 as (cosine, -tie, place), of equal ones those of smaller ids."""
        if at <= without < at + len(cosine):
            cosine[without - at] = 0
        least = max(np.partition(cosine, -k)[-k] - 1e-9, 1e-300) if len(cosine) > k else 1e-300
        found = [(round(float(cosine[j]), 12), -int(self.tie[at + j]), at + int(j)) for j in np.flatnonzero(cosine >= least)]
        return sorted(found, reverse=True)[:k]

    def vote(self, found: list[tuple[float, int]]) -> float:
        """Share of toxic neighbours, each by the inverse of its squared distance, so that a copy outweighs the rest."""
        weights = [1 / (1 - c + self.s.nearly) for c, _ in found]
        toxic = sum(w * self.labels[p] for w, (_, p) in zip(weights, found))
        return (toxic + self.s.shrink * self.rate) / (sum(weights) + self.s.shrink)

    def _calibrate(self) -> None:
        """The logistic curve from leave-one-out votes of evenly spaced labelled texts."""
        places = range(0, len(self.ids), max(1, len(self.ids) // self.s.calibrate))
        votes = np.array([self.vote(self.search(*self._labelled(p), self.s.neighbours, p)) for p in places])
        y = self.labels[list(places)]
        if not 0 < y.sum() < len(y):
            return
        x = np.column_stack([_logit(votes), np.ones(len(votes))])
        beta = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            # a weak pull towards the vote as it is keeps the curve finite where votes separate the labels
            gradient = x.T @ (y - p) - (beta - [1.0, 0.0])
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), gradient)
            beta += np.clip(step, -1, 1)
            if abs(step).max() < 1e-9:
                break
        self.slope, self.offset = max(0.0, float(beta[0])), float(beta[1])

    def probability(self, vote: float) -> float:
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * float(_logit(vote)) + self.offset)))))


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit(rows: list[tuple], settings: Settings | None = None) -> Index | None:
    """An index over (id, text, label) rows; None without any."""
    s = settings or Settings()
    return Index(choose_terms(rows, s), rows, s) if rows else None


def learn(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Index | None:
    """Fits on labelled rows whose id is not held out."""
    s = settings or Settings()
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
    texts = docs.where(~held_out(F.col("doc_id")))
    return fit(bounded_sample(texts, "toxicity", s.max_rows, s.max_chars, known), s)


class Scorer:
    """Scores texts; remembers the outcome of texts it has met."""

    def __init__(self, index: Index | None):
        self.index, self.known = index, {}

    def score(self, text: str) -> tuple[float, str]:
        index = self.index
        if index is None:
            return 0.0, ""
        key = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if key not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known = {}
            found = index.search(*index.arrays(index.count(text)), index.s.neighbours)
            evidence = ",".join(f"{index.ids[p]}:{int(index.labels[p])}:{c:.3f}" for c, p in found[:3])
            self.known[key] = index.probability(index.vote(found)), evidence
        return self.known[key]


def score(docs: DataFrame, index: Index | None) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence (id:label:cosine of the nearest) of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("evidence", pa.string())])
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by the settings' rows and terms

    def run(batches: Iterable[pa.RecordBatch]):
        scorer = Scorer(shared.value)
        for ids, texts in text_batches(batches):
            found = [scorer.score(t) for t in texts]
            yield as_batch(schema, [ids, [p for p, _ in found], [e for _, e in found]])

    scored = map_texts(docs, run, "doc_id long, score double, evidence string")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted, "evidence")


def keep_clean(docs: DataFrame, index: Index | None) -> DataFrame:
    """The documents, as they are, that are not predicted to be toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterable[pa.RecordBatch]):
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([scorer.score(t or "")[0] < 0.5 for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
