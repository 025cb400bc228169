"""Periodic runs of words: Lyndon words by grouping, extended to both sides.

1. A word that occurs once in its text lies in no run, so texts fall into pieces between such words; pieces below the least
   length hold no run. The pieces of a slice of texts form one sequence, with a boundary lower than all words between them.
2. The first phase of a suffix sorter by groups: positions are grouped by word, and groups taken from the highest down. A
   position taken leaves the list of open positions; the open position before it is its parent. Parents that share a group and
   lead equally many positions of the group taken move to a new group right above their own. When a position is
   taken, the way to the next open position is its longest Lyndon word. This is done under both orders of the words.
3. Each run has a Lyndon word of one of the orders as its root, whose length is the smallest period. Common extensions to the right and
   left of (i, i + period) give the whole run; those long enough, told apart by start, are the runs.

Work is linear in the words but for the extensions, of which each run needs one. A text is worked by one task, whole; slices of texts bound
the memory of the others.

Defined cases: a null or empty text has no words and no runs; repeated rows each give their rows; a null doc_id is kept, and
``echoed``, a change of words that only the query asks for, leaves such a document alone; an empty table gives an empty result; other
columns stay out of the work. Ids must fit a long.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from footfall.llm.common import as_batch, map_texts
from footfall.llm.words import coded, raw, slices

#: Bytes of texts that are worked at a time; a longer text is worked alone.
SLICE = 4_000_000
#: Extensions up to this length are taken for all candidates at once, longer ones one by one.
STEPS = 16


@dataclass(frozen=True)
class Settings:
    """A run has at least ``least`` words and twice its period."""

    least: int = 12


def longest_lyndon(symbols: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word from each position, under the order of the numbers; 0 at boundaries.

    Boundaries are -1; the first and the last symbol are boundaries, and no word goes across one.
    """
    order = np.argsort(symbols, kind="stable")
    cuts = np.flatnonzero(np.diff(symbols[order])) + 1
    members = [part.tolist() for part in np.split(order, cuts)]
    sizes = [len(part) for part in members]
    group = np.empty(len(symbols), np.int64)
    group[order] = np.repeat(np.arange(len(members)), sizes)
    group = group.tolist()
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    left, right = list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
    length = [0] * len(symbols)
    taken = len(members) - 1
    while taken > 0:
        led: dict[int, int] = {}
        for i in members[taken]:
            if group[i] == taken:
                parent, after = left[i], right[i]
                length[i] = after - i
                left[after], right[parent] = parent, after
                led[parent] = led.get(parent, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for parent, times in led.items():
            own = group[parent]
            if own and sizes[own] > 1:
                moved.setdefault((times, own), []).append(parent)
        # fewer times first: each new group goes right above the last one made from the same
        last: dict[int, int] = {}
        for times, own in sorted(moved) if len(moved) > 1 else moved:
            parents = moved[times, own]
            if len(parents) == sizes[own] and own not in last:
                continue  # the whole group would move
            made, under = len(members), last.get(own, own)
            members.append(parents)
            sizes.append(len(parents))
            sizes[own] -= len(parents)
            for parent in parents:
                group[parent] = made
            over = above[under]
            below.append(under)
            above.append(over)
            above[under] = below[over] = made
            last[own] = made
        taken = below[taken]
    return np.array(length, np.int64)


def _same(symbols: np.ndarray, a: int, b: int, step: int) -> int:
    """How many symbols from a and from b on are equal, going forwards (step 1) or backwards (-1)."""
    done, width = 0, 64
    while True:
        x = symbols[a + done : a + done + width] if step > 0 else symbols[max(a - done - width + 1, 0) : a - done + 1][::-1]
        y = symbols[b + done : b + done + width] if step > 0 else symbols[max(b - done - width + 1, 0) : b - done + 1][::-1]
        n = min(len(x), len(y))
        differ = x[:n] != y[:n]
        if differ.any():
            return done + int(differ.argmax())
        if n < width:
            return done + n
        done, width = done + width, width * 2


def _reach(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """As ``_same`` for many pairs, but at most STEPS."""
    found = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    for k in range(STEPS):
        open_ = open_[symbols[a[open_] + step * k] == symbols[b[open_] + step * k]]
        found[open_] += 1
    return found


def find(symbols: np.ndarray, least: int) -> np.ndarray:
    """(start, length, period) of every run, a row each, sorted."""
    rows = [np.empty((0, 3), np.int64)]
    top = symbols.max()
    for ordered in (symbols, np.where(symbols < 0, -1, top - symbols)):
        lyndon = longest_lyndon(ordered)
        at = np.flatnonzero(lyndon)
        period = lyndon[at]
        # most positions differ at once to both sides
        near = (symbols[at] == symbols[at + period]) | (symbols[at - 1] == symbols[at + period - 1])
        at, period = at[near], period[near]
        ahead, back = _reach(symbols, at, at + period, 1), _reach(symbols, at - 1, at + period - 1, -1)
        long = (ahead == STEPS) | (back == STEPS)
        whole = ~long & (ahead + back + period >= np.maximum(least, 2 * period))
        rows.append(np.stack([at - back, ahead + back + period, period], 1)[whole])
        by = np.flatnonzero(long)[np.lexsort((at[long], period[long]))]
        start = stop = of = 0
        for i, q in zip(at[by].tolist(), period[by].tolist()):
            if q == of and start <= i and i + q <= stop:
                continue  # a root inside the run just found
            right, left = _same(symbols, i, i + q, 1), _same(symbols, i - 1, i + q - 1, -1)
            if right + left >= q:
                start, stop, of = i - left, i + q + right, q
                if stop - start >= least:
                    rows.append(np.array([[start, stop - start, q]]))
    return np.unique(np.concatenate(rows), axis=0)


def texts_runs(codes: list[np.ndarray], least: int = Settings.least) -> list[np.ndarray]:
    """The runs of each sequence of numbers, as rows of (start, length, period) sorted by start, then period."""
    sizes = np.array([len(c) for c in codes])
    every = np.concatenate(codes) if len(codes) else np.empty(0, np.int64)
    text = np.repeat(np.arange(len(codes)), sizes)
    _, number, count = np.unique(text * (every.max(initial=0) + 1) + every, return_inverse=True, return_counts=True)
    again = count[number] > 1
    # pieces: stretches of repeated words within a text
    breaks = np.ones(len(every) + 1, bool)
    breaks[1:-1] = (again[1:] != again[:-1]) | (text[1:] != text[:-1])
    edges = np.flatnonzero(breaks)
    starts, ends = edges[:-1], edges[1:]
    fit = again[starts] & (ends - starts >= least) if len(every) else np.empty(0, bool)
    found: list[list[tuple[int, int, int]]] = [[] for _ in codes]
    if fit.any():
        starts, lengths = starts[fit], (ends - starts)[fit]
        heads = np.concatenate([[0], np.cumsum(lengths + 1)])
        symbols = np.full(heads[-1] + 1, -1, np.int64)
        place = np.repeat(starts - heads[:-1] - 1, lengths) + np.setdiff1d(np.arange(heads[-1]), heads, assume_unique=True)
        symbols[np.setdiff1d(np.arange(heads[-1]), heads, assume_unique=True)] = every[place]
        firsts = np.cumsum(sizes) - sizes
        for start, length, period in find(symbols, least).tolist():
            piece = int(np.searchsorted(heads, start, side="right")) - 1
            at = start - int(heads[piece]) - 1 + int(starts[piece])
            found[text[at]].append((at - int(firsts[text[at]]), length, period))
    return [np.array(sorted(f, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3) for f in found]


def dropped(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def echoed(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, of every tenth document made periodic from some place on, as crc32 of its id decides."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * ((n - a) // p + 1))[: n - a]


def _each(batches: Iterable[pa.RecordBatch], least: int, echo: bool) -> Iterator[tuple[list, list, list]]:
    """(ids, words, runs) of slices of texts."""
    for piece in slices(batches, "text", SLICE):
        ids = piece.column("doc_id").to_pylist()
        texts = [t.split() for t in raw(piece.column("text"))]
        if echo:
            texts = [echoed(i, t) for i, t in zip(ids, texts)]
        numbers = coded([w for t in texts for w in t])
        yield ids, texts, texts_runs(np.split(numbers, np.cumsum([len(t) for t in texts])[:-1]), least)


def periodic_runs(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, start, length, period) of every run; places count words from 0."""
    least = settings.least

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for ids, _, runs in _each(batches, least, False):
            of = [i for i, r in zip(ids, runs) for _ in range(len(r))]
            yield as_batch(schema, [of, *np.concatenate(runs).T])

    return map_texts(docs, rows, "doc_id long, start long, length long, period long")


def collapsed(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, text): each text with every run cut to its first period, its words joined by single spaces."""
    least = settings.least

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
        for ids, texts, runs in _each(batches, least, False):
            yield as_batch(schema, [ids, [_kept(t, r).decode() for t, r in zip(texts, runs)]])

    return map_texts(docs, rows, "doc_id long, text string")


def _kept(words: list[bytes], runs: np.ndarray) -> bytes:
    if len(runs):
        gone = dropped(runs, len(words)).tolist()
        words = [w for w, g in zip(words, gone) if not g]
    return b" ".join(words)


DIGESTS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def digests(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A row per document whose words are ``echoed``: the longest run, and digests of all runs and of the collapsed text."""
    least = settings.least

    def summary(runs: np.ndarray) -> list:
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
        longest = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2]), default=[None] * 3)
        power = 1000 * longest[1] // longest[2] if len(runs) else None
        return [len(runs), *longest, power, hashlib.sha256(listed.encode()).hexdigest()]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        schema = pa.schema([(c.split()[0], k) for c, k in zip(DIGESTS.split(", "), kinds)])
        for ids, texts, runs in _each(batches, least, True):
            lists = [summary(r) for r in runs]
            shas = [hashlib.sha256(_kept(t, r)).hexdigest() for t, r in zip(texts, runs)]
            yield as_batch(schema, [ids, *map(list, zip(*lists)), shas])

    return map_texts(docs, rows, DIGESTS)
