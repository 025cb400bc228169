"""BPE, token counts, personal data, languages and toxicity, against plain versions and held-out rows."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from conftest import CASES
from tokenizers import Tokenizer, models

from footfall.llm import bpe, language, pii, token_counts, toxicity

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _random_texts(n, seed=5):
    rng = random.Random(seed)
    odd = "aàb \n\t  's'll0123٣½\x1c\x85　​漢字😀.,-!ëẞthe\r\x0b "
    plain = "abcdefghijklmnopqrstuvwxyz"
    texts = ["".join(rng.choices(odd, k=rng.randrange(60))) for _ in range(n)]
    texts += ["".join(rng.choices(plain, k=rng.randrange(40))) for _ in range(n)]
    return texts + ["a" * 5000, "ab" * 3000 + " ", " " * 300 + "x", "the" * 900, "\n \n  x", "<|endoftext|> it's"]


def test_bpe_gives_the_library_s_ids(library):
    texts = _random_texts(4000)
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for block in (texts[:1000], texts):  # the second time, part of the words are remembered
        for text, ids in zip(block, encoder.encode(block)):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)
            assert encoder.vocabulary.decode(ids) == text.encode()


def test_words_that_leave_the_replay_are_encoded_alike(library):
    """Each word by itself gives the library's ids, as the words do that meet a lower rank late."""
    rank = bpe.Vocabulary(RANKS).rank
    for word in _random_texts(300):
        for piece in regex.findall(public_tokenizers.PATTERN, word):
            assert bpe.encode_alone(piece.encode(), rank) == library.encode_ordinary(piece)


def test_bpe_query_cases(docs, no_docs, library):
    got = bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for i, text, *_ in CASES:
        ids = library.encode_ordinary(text or "")
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    back = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((i, t or "") for i, t, *_ in CASES), key=repr)
    assert bpe.digests(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_counts_equal_the_library_s(docs, no_docs, table_of):
    model = token_counts.Unigram.from_file(PIECES)
    library = Tokenizer(models.Unigram([("<unk>", model.unknown), *model.scores.items()], 0, False))
    words = sorted({w for r in table_of("documents").limit(60).collect() for w in r.text.split()})
    words = [w for w in words if all(c in model.scores for c in w)]
    marked = [token_counts.SPACE + w for w in words]
    assert len(words) > 3000
    assert token_counts.walk(sorted(marked), model) == [len(library.encode(w).tokens) for w in sorted(marked)]
    rows = token_counts.token_counts(docs, PIECES).collect()
    counter = token_counts.Counter(model)
    want = [(i, len((t or "").split()), counter.count([t or ""])[0]) for i, t, *_ in CASES]
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(no_docs, PIECES).count() == 0


def test_token_counts_by_every_cut():
    """All cuts of short words by hand: the best score wins, unknown characters count their bytes."""
    model = token_counts.Unigram({"a": -1.0, "b": -1.5, "ab": -2.6, "abc": -2.0, "c": -3.0, "▁": -0.5, "▁a": -1.2})

    def best(word):
        found = {0: (0.0, 0)}
        for end in range(1, len(word) + 1):
            options = [
                (found[s][0] + model.scores[word[s:end]], found[s][1] + 1) for s in range(end) if word[s:end] in model.scores
            ]
            if word[end - 1] not in model.scores:
                options.append((found[end - 1][0] + model.unknown, found[end - 1][1] + len(word[end - 1].encode())))
            found[end] = max(options, key=lambda o: o[0])
        return found[len(word)][1]

    words = sorted({"▁" + w for w in ("a", "ab", "abc", "abcab", "cab", "xaé", "é", "bbb", "abx")})
    assert token_counts.walk(words, model) == [best(w) for w in words]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _plain_base(text):
    """The fixed patterns, searched as they stand."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans_are_those_of_the_plain_patterns(table_of):
    rng = random.Random(3)
    alphabet = "a.b@c-_+1 2(3)4.5 0@.com 4111111111111111"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(80))) for _ in range(20_000)]
    texts += [r.text for r in table_of("documents", "sf0.01").select("text").collect()]
    texts += [CASES[7][1], "1.2.3.4.5.6.7.8 300.1.1.1 1.1.1.0001", "a@b.c_d@e.f", "@x.y", "+1 234 567 8+12 345 678"]
    found = 0
    for text in texts:
        base = [tuple(s[:3]) for s in pii.base_spans(text)]
        assert base == _plain_base(text), text
        found += len(base)
    assert found > 500


def test_more_spans_need_checksum_and_context():
    assert [s.kind for s in pii.find("pay to DE89 3704 0044 0532 0130 00 please")] == ["iban"]
    assert pii.find("pay to DE88 3704 0044 0532 0130 00 please") == []
    assert [s.kind for s in pii.find("my amex card 378282246310005")] == ["card"]
    assert pii.find("order 378282246310005") == []
    assert [s.kind for s in pii.find("tel. 030 123 4567")] == ["phone"]
    assert pii.find("from 030 123 4567 on") == []
    text = CASES[7][1]
    assert pii.redact(text, pii.find(text)) == "mail me at <EMAIL> or <PHONE>, card <CARD>, ip <IP>"
    assert luhn_of("4111111111111111") and not luhn_of("4111111111111112")


def luhn_of(digits):
    return pii.luhn(digits)


@pytest.mark.parametrize("after", [" BIC COBADEFFXXX", " 2024", " DE02 1203 0000 0000 2020 51", " AND MORE", ""])
@pytest.mark.parametrize("iban", ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "NO93 8601 1117 947", "ZZ11 3704 0044 0532 0130 00"])
def test_an_iban_ends_where_its_checksum_says(iban, after):
    """What follows in capitals or digits is no part of it; a country without a known length ends at a group."""
    if iban.startswith("ZZ"):
        iban = next(f"ZZ{n:02}{iban[4:]}" for n in range(2, 99) if pii.mod97(f"ZZ{n:02}{iban[4:]}".replace(" ", "")))
    text = f"IBAN {iban}{after}"
    found = [text[s.start : s.end] for s in pii.find(text) if s.kind == "iban"]
    assert found == [iban] + ([after[1:]] if after.startswith(" DE") else [])


def test_personal_data_query_cases(docs, no_docs):
    rows = {(r.doc_id, r.base_sha256, r.spans) for r in pii.digests(docs).collect()}
    want = set()
    for i, text, *_ in CASES:
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in _plain_base(text or ""))
        want.add((i, hashlib.sha256(written.encode()).hexdigest(), written))
    assert rows == want
    assert pii.digests(no_docs).count() == 0
    clean = {r.doc_id: r for r in pii.redacted(docs).collect()}
    assert clean[5].text is None and clean[5].n_chars is None and clean[1].text == CASES[0][1]
    assert clean[8].text.startswith("mail me at <EMAIL>") and clean[8].n_chars == len(clean[8].text)
    assert pii.redacted(docs).columns == docs.columns
    assert [tuple(r)[:2] for r in pii.spans(docs).collect()] == [(8, k) for k in ("email", "ip", "card", "phone")]


def _held(i):
    return i is None or zlib.crc32(str(i).encode()) % 5 == 0


def test_languages_of_held_out_rows(table_of):
    docs = table_of("documents", "sf0.01")
    model = language.learn(docs)
    rows = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == _held(r.doc_id) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    kept = [r for r in held if r.accepted]
    assert len(kept) > 0.8 * len(held) and sum(r.lang == r.lang_pred for r in kept) >= 0.98 * len(kept)
    assert all(0 <= r.score <= 1 for r in rows)
    again = language.predict(docs, language.learn(docs)).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in rows} == {(r.doc_id, r.lang_pred, r.score) for r in again}


def test_language_never_reads_held_out_labels(table_of):
    from pyspark.sql import functions as F

    docs = table_of("documents").select("doc_id", "text", "lang")
    wrong = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, "xx").otherwise(F.col("lang")))
    a, b = (language.predict(docs, language.learn(d)).collect() for d in (docs, wrong))
    assert a == b


def test_language_cases(docs, no_docs):
    rows = language.predict(docs, language.learn(docs)).collect()
    assert len(rows) == len(CASES)
    by_id = {r.doc_id: r for r in rows}
    assert {i for i in (4, 5, 7) if by_id[i].lang_pred != "und"} == set()
    assert by_id[10].lang_pred in {"en", "de", "es"} and by_id[None].held_out
    none = language.predict(docs, language.learn(no_docs)).collect()
    assert {r.lang_pred for r in none} == {"und"} and len(none) == len(CASES)
    assert language.predict(no_docs, None).count() == 0


def _plain_subwords(word, s):
    marked = f"<{word}>"
    grams = [marked[i : i + n] for n in range(s.shortest, s.longest + 1) for i in range(len(marked) - n + 1)]
    return [zlib.crc32(x.encode()) & (s.buckets - 1) for x in grams]


def _language_model(seed=3, **settings):
    s, rng = language.Settings(**settings), np.random.default_rng(seed)
    return language.Model(["de", "en", "es"], rng.normal(size=(s.buckets, 3)), rng.normal(size=3), 0.5, 0.9, s)


@pytest.mark.parametrize("lengths", [{}, {"shortest": 2, "longest": 6}, {"shortest": 3, "longest": 3}])
def test_language_scores_are_plain_averages_over_subwords(monkeypatch, lengths):
    monkeypatch.setattr(language, "REMEMBERED_WORDS", 100)
    model = _language_model(**lengths)
    long = "xé漢" * language.SLICE_CHARS + "z"  # a word of several slices
    texts = [*_random_texts(400), long, f"a {long} b", "a>b <c> <> > <", "İSTANBUL ΣΑΣ.Σ 😀", "A", "漢", "1 2"]
    found = list(zip(*language.Scorer(model).score(texts)))
    assert len(found) == len(texts) and any(x[0] == "und" for x in found)
    for text, (name, p, accepted) in zip(texts, found):
        rows = [r for w in text.lower().split() for r in _plain_subwords(w, model.settings)]
        if not any(c.isalpha() for c in text):
            assert (name, p, accepted) == ("und", 0.0, False)
            continue
        z = (model.scores[rows].mean(axis=0) + model.bias) / model.temperature
        plain = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert name == model.languages[plain.argmax()] and p == pytest.approx(plain.max(), abs=1e-9)
        assert accepted == (p >= model.least)


def test_language_hashes_new_words_together():
    words = [f"w{i:x}ord{i * 7919 % 10_007}" for i in range(5_000)]
    texts = [" ".join(words[i : i + 50]) for i in range(0, len(words), 50)]
    scorer, calls = language.Scorer(_language_model()), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        scorer.score(texts)
    finally:
        sys.setprofile(None)
    # a call for every n-gram of every word would be some 40 calls a word
    assert calls < 8 * len(words)


@pytest.fixture(scope="module")
def toxic_rows(table_of):
    docs, labels = table_of("documents", "sf0.1"), table_of("labels", "sf0.1")
    found = toxicity.score(docs, toxicity.learn(docs, labels))
    return found.join(labels, "doc_id", "left").collect()


def test_toxicity_of_held_out_rows(toxic_rows):
    held = [r for r in toxic_rows if r.held_out and r.toxic is not None]
    hits = sum(r.predicted and r.toxic for r in held)
    assert hits >= 0.9 * sum(r.toxic for r in held)
    assert hits >= 0.95 * sum(r.predicted for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in toxic_rows)
    # the score is a probability: mean score and share agree
    assert abs(sum(r.score for r in held) - sum(r.toxic for r in held)) < 0.03 * len(held)


def test_neighbours_are_those_of_a_full_scan(table_of):
    joined = table_of("documents", "sf0.01").join(table_of("labels", "sf0.01"), "doc_id").orderBy("doc_id").collect()
    rows = [(r.doc_id, r.text, r.toxic) for r in joined]
    index = toxicity.fit(rows, toxicity.Settings(block=8))
    dense = np.zeros((len(index.vectors), len(index.terms) + 1))
    for i, v in enumerate(index.vectors):
        dense[i, list(v)] = list(v.values())
    for r in rows[::5]:
        v = index.vector(index.count(r[1]))
        q = np.zeros(dense.shape[1])
        q[list(v)] = list(v.values())
        cosine = np.round(dense @ q, 12)
        want = sorted(range(len(dense)), key=lambda i: (-cosine[i], index.tie[i]))[:15]
        got = index.nearest(v, 15)
        assert [p for _, p in got] == want
        assert np.allclose([c for c, _ in got], cosine[want])


def test_copies_of_toxic_texts_without_leaning_terms_are_found():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=40)) for _ in range(400)]
    rows = [(i, f"{t} idiot" if i < 40 else t, int(i < 45)) for i, t in enumerate(texts)]
    scorer = toxicity.Scorer(toxicity.fit(rows))
    for i, text, toxic in rows:
        score, evidence = scorer.score(text)
        assert evidence.startswith(f"{i}:{toxic}:1.000,") and (score >= 0.5) == toxic
    # near copies too, and words that no labelled text holds make no difference
    assert all(scorer.score(" ".join(texts[i].split()[2:]) + " xyzzy")[0] >= 0.5 for i in range(40, 45))


def test_toxicity_cases(spark, docs, no_docs, table_of):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (6, 0), (10, 1), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert len(rows) == len(CASES) and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.score(docs, toxicity.learn(docs, labels.limit(0))).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.score(no_docs, None).count() == 0
    kept = toxicity.keep_clean(docs, None)
    assert kept.columns == docs.columns and kept.count() == len(CASES)


def test_toxicity_never_reads_held_out_labels(table_of):
    from pyspark.sql import functions as F

    docs, labels = table_of("documents", "sf0.01"), table_of("labels", "sf0.01")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    wrong = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.score(docs, toxicity.learn(docs, x)).collect() for x in (labels, wrong))
    assert a == b
