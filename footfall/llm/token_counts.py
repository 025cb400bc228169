"""Token counts by trie-shared dynamic programming over distinct pre-tokens.

A unigram model gives each piece a score; a pre-token's tokens are the pieces of its best-scoring cut. The
best score up to a place depends only on the characters before it, so pre-tokens with a common prefix share that
prefix's forward scores. The distinct pre-tokens of a block of texts are put into a trie, each node's score
is computed once, and the node where a pre-token ends keeps its number of tokens. A text's count is the sum over its
pre-tokens. Workers remember the counts, up to a bound.

Pre-tokens are the text's words, split at white space, each with a mark in front that stands for the space.
A character that is no piece by itself becomes its UTF-8 bytes, one token each, with the penalty of an unknown piece. Of
cuts with equal scores, the one whose last piece is longest counts, likewise for what comes before it.

Defined cases: a null or empty text has no tokens; a null doc_id stays null; repeated rows each give their
own row; words of any length are cut whole; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from footfall.llm.common import as_batch, map_texts, text_batches

SPACE = "▁"
#: Below the lowest score of a piece.
UNKNOWN_PENALTY = 10.0
REMEMBERED_CHARS = 6_000_000
#: Words beyond this length are not remembered.
LONG = 200


class Unigram:
    """Pieces with scores, and the penalty of a character that none of them covers."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY

    @classmethod
    def from_file(cls, path: str) -> Unigram:
        """The plain pieces of a sentencepiece file and their scores."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = (
            i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        )
        return cls({model.id_to_piece(i): model.get_score(i) for i in plain})


def walk(words: list[str], model: Unigram) -> list[int]:
    """Numbers of tokens of ``words``, which are distinct and sorted.

    Sorted words are the terminals of their trie in the order of a depth-first walk, so only the nodes on
    the path to the last word are held. What a word shares with the one before it is the part of the path
    that stays; every node of the trie is entered, and its forward score computed, once.
    """
    scores, longest, unknown = model.scores, model.longest, model.unknown
    score, count, out, last = [0.0], [0], [], ""
    for word in words:
        shared, most = 0, min(len(word), len(last))
        while shared < most and word[shared] == last[shared]:
            shared += 1
        del score[shared + 1 :], count[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            best, tokens = None, 0
            for start in range(max(0, end - longest), end):
                piece = scores.get(word[start:end])
                if piece is not None and (best is None or score[start] + piece > best):
                    best, tokens = score[start] + piece, count[start] + 1
            if word[end - 1] not in scores and (best is None or score[end - 1] + unknown > best):
                best, tokens = score[end - 1] + unknown, count[end - 1] + len(word[end - 1].encode())
            score.append(best)
            count.append(tokens)
        out.append(count[-1])
        last = word
    return out


class Counter:
    def __init__(self, model: Unigram):
        self.model = model
        self.known: dict[str, int]
        self.forget()

    def forget(self) -> None:
        """Workers live on between tasks; what a task has remembered must not pile up beside other operators' work."""
        self.known, self.chars = {}, 0

    def count(self, texts: list[str]) -> list[int]:
        out = []
        for start in range(0, len(texts), 1024):
            part = [t.split() for t in texts[start : start + 1024]]
            if self.chars > REMEMBERED_CHARS:
                self.forget()
            seen: set[str] = set()
            for words in part:
                seen.update(words)
            new, once = sorted(seen.difference(self.known)), {}
            for word, n in zip(new, walk([SPACE + w for w in new], self.model)):
                if len(word) > LONG:
                    once[word] = n
                else:
                    self.known[word] = n
                    self.chars += len(word)
            for words in part:
                if once:
                    out.append(sum(once[w] if w in once else self.known[w] for w in words))
                else:
                    out.append(sum(map(self.known.__getitem__, words)))
        return out


@lru_cache(maxsize=1)
def _counter(path: str) -> Counter:
    return Counter(Unigram.from_file(path))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words and n_tokens of every whole text, by the pieces of the file at ``path``."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]):
        counter = _counter(path)
        for ids, texts in text_batches(batches):
            yield as_batch(schema, [ids, [len(t.split()) for t in texts], counter.count(texts)])
        counter.forget()

    return map_texts(docs, run, "doc_id long, n_words long, n_tokens long")
