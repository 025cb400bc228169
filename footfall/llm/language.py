"""Language ID: averaged hashed subword embeddings under a linear softmax, trained by SGD in numpy.

A word's subwords are its character n-grams with marked ends, hashed to rows of an embedding table. A text is
the average over all subwords of all its words; a linear layer and a softmax give the languages. Fitted
on a bounded draw of texts on the driver; a part kept aside sets the temperature of the softmax, which
calibrates the score, and the lowest score at which the predictions that are kept are right often enough.

The model is linear before the softmax, so each word has a fixed vector of scores. Workers remember it, up to a
bound, and a text costs one look-up per word. New words are hashed together, all n-grams of a slice of them at a time.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and not accepted; without any row to learn
from every text is ``und``; a null doc_id stays null and counts as held out; repeated rows each give their own row; whole texts
are read; columns other than doc_id, text and, for the fit, lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import as_batch, bounded_sample, held_out, map_texts, text_batches

UNKNOWN = "und"
#: Words whose scores a worker remembers before it starts anew.
REMEMBERED_WORDS = 400_000
#: Characters whose n-grams are hashed at a time.
SLICE_CHARS = 1 << 16


@dataclass(frozen=True)
class Settings:
    """Bounds of the fit and shape of the model."""

    max_rows: int = 3_000
    max_chars: int = 8_000_000
    buckets: int = 1 << 15
    dim: int = 16
    shortest: int = 1
    longest: int = 4
    epochs: int = 4
    rate: float = 0.5
    #: Share of the draw that is kept aside, and how often accepted predictions must be right on it.
    aside: float = 0.2
    precision: float = 0.99
    seed: int = 7


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # of each subword row, a score per language
    bias: np.ndarray
    temperature: float
    least: float
    settings: Settings


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ (table & 1) * np.uint32(0xEDB88320)
    return table


_CRC = _crc_table()


def _rows(text: str, left: np.ndarray, s: Settings) -> np.ndarray:
    """For each length of n-grams and each of the first characters of ``text``, the row of the n-gram that begins there.

    The row is the CRC32 of the n-gram's UTF-8 bytes, modulo the buckets. ``left`` says how many characters of its word
    a character has before it, itself included; an n-gram that would leave its word has the row after the last.
    """
    data = np.frombuffer((text + "\0" * s.longest).encode(), np.uint8)
    starts = np.flatnonzero(data & 0xC0 != 0x80)
    widths = np.diff(starts, append=len(data))
    n, widest = len(left), int(widths.max())
    rows = np.empty((s.longest - s.shortest + 1, n), np.int64)
    state = np.full(n, 0xFFFFFFFF, np.uint32)
    for k in range(s.longest):
        # an n-gram's state goes on from that of the n-gram one shorter by the bytes of its last character
        at, width = starts[k : k + n], widths[k : k + n]
        state = _CRC[(state ^ data[at]) & 0xFF] ^ (state >> 8)
        for byte in range(1, widest):
            more = np.flatnonzero(width > byte)
            state[more] = _CRC[(state[more] ^ data[at[more] + byte]) & 0xFF] ^ (state[more] >> 8)
        if k + 1 >= s.shortest:
            rows[k + 1 - s.shortest] = np.where(left > k, ~state & (s.buckets - 1), s.buckets)
    return rows


def subwords(words: list[str], s: Settings) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(which words, rows of their n-grams by length and character, each word's first character) in slices.

    A word longer than a slice is alone in several, cut from its beginning, so its slices don't depend on other words.
    """
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(words):
        before = int(ends[start] - sizes[start])
        stop = max(int(np.searchsorted(ends, before + SLICE_CHARS, side="right")), start + 1)
        marked = "".join(f"<{w}>" for w in words[start:stop])
        last, size = ends[start:stop] - before, sizes[start:stop]
        end_of = np.repeat(last, np.minimum(size, SLICE_CHARS))
        for at in range(0, len(marked), SLICE_CHARS):
            n = min(SLICE_CHARS, len(marked) - at)
            rows = _rows(marked[at : at + n + s.longest - 1], end_of[:n] - np.arange(at, at + n), s)
            yield slice(start, stop), rows, last - size
        start = stop


def words_of(text: str) -> list[str]:
    return text.lower().split()


def has_letter(text: str) -> bool:
    return next(filter(str.isalpha, text), None) is not None


def _rows_by_word(words: list[str], s: Settings) -> dict[str, np.ndarray]:
    found: dict[str, list[np.ndarray]] = {w: [] for w in words}
    for which, rows, first in subwords(words, s):
        for w, part in zip(words[which], np.split(rows, first[1:], axis=1)):
            found[w].append(part[part < s.buckets].astype(np.int32))
    return {w: parts[0] if len(parts) == 1 else np.concatenate(parts) for w, parts in found.items()}


def _bag(words: list[str], memory: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    rows = np.concatenate([memory[w] for w in words])
    index, n = np.unique(rows, return_counts=True)
    return index, n / len(rows)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple], settings: Settings | None = None) -> Model | None:
    """A model from (id, text, language) rows; None where no row has a letter."""
    s = settings or Settings()
    rows = [(t, lang) for _, t, lang in rows if has_letter(t)]
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return None
    rng = np.random.default_rng(s.seed)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    aside = int(len(rows) * s.aside)
    memory = _rows_by_word(list({w: None for text, _ in rows for w in words_of(text)}), s)

    def bags(part, short: bool):
        out = []
        for text, lang in part:
            words, y = words_of(text), languages.index(lang)
            out.append((*_bag(words, memory), y))
            if short and len(words) > 24:
                # a short passage as well, so that short texts are not strange to the model
                n = int(rng.integers(2, 16))
                at = int(rng.integers(0, len(words) - n))
                out.append((*_bag(words[at : at + n], memory), y))
        return out

    train, check = bags(rows[aside:], True), bags(rows[:aside], False)
    embedding = rng.uniform(-1 / s.dim, 1 / s.dim, (s.buckets, s.dim))
    weights, bias = np.zeros((s.dim, len(languages))), np.zeros(len(languages))
    steps, done = s.epochs * len(train), 0
    for _ in range(s.epochs):
        for i in rng.permutation(len(train)):
            index, share, y = train[i]
            rate = s.rate * (1 - done / steps)
            done += 1
            hidden = share @ embedding[index]
            error = _softmax(hidden @ weights + bias)
            error[y] -= 1
            back = weights @ error
            weights -= rate * np.outer(hidden, error)
            bias -= rate * 0.1 * error
            # rows of rare subwords would hardly move with their share of one text; its root evens this out
            embedding[index] -= rate * np.outer(np.sqrt(share), back)
    scores = embedding @ weights
    check = check or train
    raw = np.array([share @ scores[index] + bias for index, share, _ in check])
    truth = np.array([y for *_, y in check])
    grid = np.geomspace(0.1, 10, 41)
    loss = [-np.log(np.maximum(_softmax(raw / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(raw / temperature)
    best, right = p.max(axis=1), p.argmax(axis=1) == truth
    order = np.argsort(-best, kind="stable")
    kept = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(kept >= s.precision)
    least = float(best[order][good[-1]]) if len(good) else 1.0
    return Model(languages, scores, bias, temperature, least, s)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        # a further column counts subwords; the further row is that of no subword
        counted = np.column_stack([model.scores, np.ones(len(model.scores))])
        self.table = np.concatenate([counted, np.zeros((1, counted.shape[1]))])
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.sums = np.zeros((0, len(self.model.languages) + 1))

    def _learn(self, words: set[str]) -> None:
        new = list(words.difference(self.place))
        if not new:
            return
        sums = np.zeros((len(new), self.table.shape[1]))
        for which, rows, first in subwords(new, self.model.settings):
            picked = self.table[rows[0]]
            for longer in rows[1:]:
                picked += self.table[longer]
            sums[which] += np.add.reduceat(picked, first, axis=0)
        start = len(self.sums)
        self.sums = np.concatenate([self.sums, sums])
        self.place.update(zip(new, range(start, start + len(new))))

    def score(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        """Language, probability and whether it is accepted, for each text."""
        m, out = self.model, ([], [], [])
        for start in range(0, len(texts), 256):
            part = [words_of(t) if has_letter(t) else [] for t in texts[start : start + 256]]
            if len(self.place) > REMEMBERED_WORDS:
                self._forget()
            seen: set[str] = set()
            for words in part:
                seen.update(words)
            self._learn(seen)
            place = self.place.__getitem__
            for words in part:
                if not words:
                    language, p = UNKNOWN, 0.0
                else:
                    total = self.sums[np.fromiter(map(place, words), np.int64, len(words))].sum(axis=0)
                    probability = _softmax((total[:-1] / total[-1] + m.bias) / m.temperature)
                    best = int(probability.argmax())
                    language, p = m.languages[best], float(min(1.0, probability[best]))
                for column, value in zip(out, (language, p, bool(words) and p >= m.least)):
                    column.append(value)
        return out


def learn(docs: DataFrame, settings: Settings | None = None) -> Model | None:
    """Fits on rows with a language whose id is not held out."""
    s = settings or Settings()
    rows = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", F.col("lang").alias("label"))
    return fit(bounded_sample(rows, "language", s.max_rows, s.max_chars), s)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted for every whole text."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_()),
    ])
    # the model's size is fixed by its settings and the number of languages
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value) if shared.value else None
        for ids, texts in text_batches(batches):
            n = len(texts)
            found = scorer.score(texts) if scorer else ([UNKNOWN] * n, [0.0] * n, [False] * n)
            yield as_batch(schema, [ids, *found])

    scored = map_texts(docs, run, "doc_id long, lang_pred string, score double, accepted boolean")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
