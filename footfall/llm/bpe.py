"""Byte-level BPE: corpus-level merge replay over the distinct pre-tokens of a block of texts.

The distinct pre-tokens of a block lie behind each other as one list of byte pieces. An inverted index
maps each pair (by the rank of its merge) to the places where it stands; merges are replayed in rank
order, each touching only the neighbours of its places. Every pre-token is merged once per block however
often it occurs, and results of earlier blocks are remembered up to a bound, so a common word costs a
dictionary look-up. A block is one Arrow batch of a task, so nothing needs a shuffle or a broadcast.

Defined cases: a null text is an empty one and gives no tokens; a null doc_id stays null; repeated rows
each give their own row; texts of any length are encoded whole; columns other than doc_id and text are
not read. The text decoded from the ids is the text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from footfall.llm.common import as_batch, map_texts, text_batches

#: Characters of remembered text, per worker, after which the memory starts anew.
REMEMBERED_CHARS = 8_000_000


class Vocabulary:
    """The ranks of a rank file, as bytes to id and id to bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.rank = {base64.b64decode(token): int(number) for token, number in pairs}
        self.packed = {token: number.to_bytes(4, "little") for token, number in self.rank.items()}
        self.token = np.full(max(self.rank.values()) + 1, None, dtype=object)
        for token, number in self.rank.items():
            self.token[number] = token

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.token[np.frombuffer(ids, "<u4")].tolist())


NONE = np.iinfo(np.int32).max
#: Ranks whose waiting places are sorted together.
BAND = 256


def encode_alone(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """One word by itself: the lowest-ranked pair, leftmost first, until none is left."""
    heap = [(r, i, i + 2) for i in range(len(word) - 1) if (r := rank.get(word[i : i + 2])) is not None]
    heapify(heap)
    # ends[i]: where the piece that begins at i ends; starts[i]: where the piece that ends at i begins
    ends, starts = list(range(1, len(word) + 1)), [-1, *range(len(word))]
    while heap:
        _, i, end = heappop(heap)
        if ends[i] < 0 or ends[i] >= len(word) or ends[ends[i]] != end:
            continue
        ends[ends[i]] = -1
        ends[i], starts[end] = end, i
        if end < len(word) and (r := rank.get(word[i : ends[end]])) is not None:
            heappush(heap, (r, i, ends[end]))
        if i > 0 and (r := rank.get(word[starts[i] : end])) is not None:
            heappush(heap, (r, starts[i], end))
    out, i = [], 0
    while i < len(word):
        out.append(rank[word[i : ends[i]]])
        i = ends[i]
    return out


class Merges:
    """The merges of a vocabulary, and their replay over many words at once."""

    def __init__(self, rank: dict[bytes, int]):
        self.rank = rank
        self.size = max(rank.values()) + 1
        get = rank.get
        pairs = {
            a * self.size + b: r
            for token, r in rank.items()
            for i in range(1, len(token))
            if (a := get(token[:i])) is not None and (b := get(token[i:])) is not None
        }
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.byte = np.array([rank[bytes([i])] for i in range(256)], np.int32)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens, NONE where they don't merge."""
        key = a.astype(np.int64) * self.size + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, dict[int, list[int]]]:
        """Token ids of all words in a row, each word's end in that row, and the words encoded alone.

        The words lie behind each other. ``waiting`` is the inverted index: places of pairs by rank, sorted
        when their band of ranks comes up. Ranks are taken in order; a merge rewrites the ids and links of
        its places and looks up the two new pairs beside each. In a few words a merge makes a pair of a
        lower rank than its own; those leave the replay and are encoded alone, so the order is exact.
        """
        lengths = np.array([len(w) for w in words], np.int64)
        stops = np.cumsum(lengths)
        starts = stops - lengths
        token = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        n = len(token)
        left, right = np.arange(-1, n - 1, dtype=np.int32), np.arange(1, n + 1, dtype=np.int32)
        full = lengths > 0
        left[starts[full]], right[stops[full] - 1] = -1, -1
        here = np.full(n, NONE, np.int32)
        inner = np.flatnonzero(right >= 0).astype(np.int32)
        here[inner] = self.pair(token[inner], token[inner + 1])
        inner = inner[here[inner] != NONE]
        waiting = [(here[inner], inner)] if len(inner) else []
        alone: set[int] = set()
        low = 0
        while waiting:
            ranks, places = (np.concatenate(x) for x in zip(*waiting))
            low = int(ranks.min()) // BAND * BAND
            now = ranks < low + BAND
            waiting = [(ranks[~now], places[~now])] if not now.all() else []
            ranks, places = ranks[now], places[now]
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            queue = {int(ranks[i]): places[i:j] for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranks)])}
            more: dict[int, list[int]] = {}
            heap = sorted(queue)
            while heap:
                r = heappop(heap)
                p = queue.pop(r, ())
                if r in more:
                    p = np.concatenate([p, np.array(more.pop(r), np.int32)]).astype(np.int32)
                p = np.sort(p[here[p] == r])
                if not len(p):
                    continue
                p = p[np.flatnonzero(np.diff(p, prepend=-1))]
                q = right[p]
                if (p[1:] == q[:-1]).any():
                    p = np.array(_apart(p.tolist(), q.tolist()), np.int32)
                    q = right[p]
                token[p], token[q], here[q] = r, -1, NONE
                after = right[q]
                right[p] = after
                some = after >= 0
                left[after[some]] = p[some]
                before = left[p]
                new_right = np.full(len(p), NONE, np.int32)
                new_right[some] = self.pair(token[p[some]], token[after[some]])
                here[p] = new_right
                back = before >= 0
                before, by = before[back], p[back]
                new_left = self.pair(token[before], token[by])
                here[before] = new_left
                ranks, places = np.concatenate([new_right, new_left]), np.concatenate([p, before])
                if (ranks < r).any():
                    for word in np.unique(np.searchsorted(stops, places[ranks < r], "right")).tolist():
                        alone.add(word)
                        here[starts[word] : stops[word]] = NONE
                    ranks = here[places]
                keep = ranks != NONE
                ranks, places = ranks[keep], places[keep]
                near = ranks < low + BAND
                if near.any():
                    for rank, place in zip(ranks[near].tolist(), places[near].tolist()):
                        if rank in more:
                            more[rank].append(place)
                        else:
                            more[rank] = [place]
                            if rank not in queue:
                                heappush(heap, rank)
                    ranks, places = ranks[~near], places[~near]
                if len(ranks):
                    waiting.append((ranks, places))
        live = token >= 0
        ends = np.cumsum(live)[stops - 1] if n else np.zeros(len(words), np.int64)
        ends[~full] = 0
        return token[live], np.maximum.accumulate(ends) if len(ends) else ends, {
            i: encode_alone(words[i], self.rank) for i in sorted(alone)
        }


def _apart(p: list[int], q: list[int]) -> list[int]:
    """Of places whose pairs overlap, as in aaa, those that are merged: leftmost first."""
    out, taken = [], -1
    for a, b in zip(p, q):
        if a != taken:
            out.append(a)
            taken = b
    return out


class Encoder:
    """Whole texts to packed ids (little-endian unsigned 32-bit).

    A text is cut at single spaces between non-space characters, where the pattern always starts a new
    match, and each unit's ids are remembered. Texts with other runs of white space go through the
    pattern as a whole.
    """

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(path)
        self.merges = Merges(self.vocabulary.rank)
        self.find = regex.compile(pattern).findall
        self.units: dict[str, bytes]
        self.words: dict[str, bytes]
        self.forget()

    def _learn_words(self, words: set[str]) -> None:
        new = list(words.difference(self.words))
        raw = [w.encode() for w in new]
        whole = list(map(self.vocabulary.packed.get, raw))  # a word that is a token needs no merges
        rest = [i for i, p in enumerate(whole) if p is None]
        tokens, ends, alone = self.merges.replay([raw[i] for i in rest])
        packed, start = tokens.astype("<u4").tobytes(), 0
        for i, end in zip(rest, (ends * 4).tolist()):
            whole[i] = packed[start:end]
            start = end
        for i, ids in alone.items():
            whole[rest[i]] = np.array(ids, "<u4").tobytes()
        self.words.update(zip(new, whole))
        self.chars += sum(map(len, new))

    def forget(self) -> None:
        """Workers live on between tasks; what a task has remembered must not pile up beside other operators' work."""
        self.units, self.words, self.chars = {}, {}, 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of a block of texts."""
        if self.chars > REMEMBERED_CHARS:
            self.forget()
        units, find = self.units, self.find
        # the first unit has no space before it; its key holds a space, as no other unit can
        keys = [["\0 " + (cut := text.split(" "))[0], *cut[1:]] if text else [] for text in texts]
        missing: set[str] = set()
        for own in keys:
            missing.update(own)
        odd, cuts, words = set(), {}, set()
        for unit in missing.difference(units):
            head = unit.startswith("\0 ")
            body = unit[2:] if head else unit
            if body.isalpha():
                cuts[unit] = one = (body if head else " " + body,)
                words.update(one)
            elif body and not body[0].isspace() and not body[-1].isspace():
                cuts[unit] = some = find(body if head else " " + body)
                words.update(some)
            else:
                odd.add(unit)
        whole = {i: find(texts[i]) for i, own in enumerate(keys) if odd and not odd.isdisjoint(own)}
        for found in whole.values():
            words.update(found)
        self._learn_words(words)
        known = self.words.__getitem__
        for unit, found in cuts.items():
            units[unit] = known(found[0]) if len(found) == 1 else b"".join(map(known, found))
            self.chars += len(unit)
        unit_ids = units.__getitem__
        return [b"".join(map(known, whole[i]) if i in whole else map(unit_ids, own)) for i, own in enumerate(keys)]


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def _blocks(batches: Iterable[pa.RecordBatch], chars: int = 4_000_000) -> Iterator[tuple[pa.Array, list[str]]]:
    """Pieces of each Arrow batch of about so many characters."""
    for ids, texts in text_batches(batches):
        start, held = 0, 0
        for i, text in enumerate(texts):
            held += len(text)
            if held >= chars or i == len(texts) - 1:
                yield ids.slice(start, i + 1 - start), texts[start : i + 1]
                start, held = i + 1, 0


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every whole text, by the ranks of the file at ``path``, without special tokens."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(batches):
        encoder = _encoder(path, pattern)
        for ids, texts in _blocks(batches):
            yield as_batch(schema, [ids, [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]])
        encoder.forget()

    return map_texts(docs, run, "doc_id long, ids array<long>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); ids that make no valid UTF-8 give the replacement character."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        vocabulary = _encoder(path, r"\S+|\s+").vocabulary
        for batch in batches:
            texts = [
                vocabulary.decode(np.asarray(x or [], "<u4").tobytes()).decode("utf-8", "replace")
                for x in batch.column(1).to_pylist()
            ]
            yield as_batch(schema, [batch.column(0), texts])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encodes every whole text, decodes the ids, and returns the count and both digests."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
    ])

    def run(batches):
        encoder = _encoder(path, pattern)
        decoded = encoder.vocabulary.decode
        for ids, texts in _blocks(batches):
            coded = encoder.encode(texts)
            yield as_batch(schema, [
                ids,
                [len(x) // 4 for x in coded],
                [hashlib.sha256(x).hexdigest() for x in coded],
                [hashlib.sha256(decoded(x)).hexdigest() for x in coded],
            ])
        encoder.forget()

    return map_texts(docs, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
