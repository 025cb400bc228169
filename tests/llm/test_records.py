"""Periodic runs, the filter audit and the archives against plain versions."""

from __future__ import annotations

import glob
import hashlib
import io
import random
import re
import tracemalloc
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from conftest import CASES
from pyspark.sql import functions as F

from footfall.llm import filters, runs, warc, words

# periodic runs


def _lyndon(s):
    """Longest Lyndon words by their definition: lower than all their own suffixes."""
    ends = range(len(s) + 1)
    return [max(j - i for j in ends if j > i and all(s[i:j] < s[k:j] for k in range(i + 1, j))) for i in range(len(s))]


def _runs(s, least):
    found = {}
    for q in range(1, len(s) // 2 + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((i, n, q) for (i, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _sequences(seed, n):
    draw = random.Random(seed)
    for _ in range(n):
        s = [draw.randrange(draw.randint(1, 5)) for _ in range(draw.randint(0, 60))]
        if s and draw.random() < 0.5:
            s = (s[: draw.randint(1, 15)] * 60)[: len(s) + 10]
            if draw.random() < 0.5:
                s[draw.randrange(len(s))] = 9
        yield s


def test_grouping_gives_the_longest_lyndon_words():
    for s in _sequences(1, 300):
        symbols = np.array([-1, *s, -1])
        assert runs.longest_lyndon(symbols)[1:-1].tolist() == _lyndon(s)


@pytest.mark.parametrize("least", [2, 12])
def test_runs_by_brute_force(least):
    texts = list(_sequences(2, 400))
    found = runs.texts_runs([np.array(t, np.int64) for t in texts], least)
    for text, rows in zip(texts, found):
        assert [tuple(r) for r in rows.tolist()] == _runs(text, least)


def test_long_periodic_texts_are_linear():
    for s in (np.zeros(200_000, np.int64), np.arange(200_000) % 2, np.arange(200_000) % 70_000):
        (found,) = runs.texts_runs([s])
        assert len(found) == 1 and found[0, 1] == 200_000
    (found,) = runs.texts_runs([np.random.default_rng(1).integers(0, 2, 100_000)])
    assert all(n >= 12 and n >= 2 * q for _, n, q in found.tolist())


def _plain_digest(doc_id, text):
    words_ = runs.echoed(doc_id, re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()))
    rows = _runs(words_, 12)
    gone = {i for s, n, q in rows for i in range(s + q, s + n)}
    best = min(rows, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (
        len(rows), *best, 1000 * best[1] // best[2] if rows else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in rows).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words_) if i not in gone)).hexdigest(),
    )


def test_runs_of_the_cases(spark, docs, no_docs):
    want = Counter((i, *_plain_digest(i, t)) for i, t, *_ in CASES)
    assert Counter(map(tuple, runs.digests(docs).collect())) == want
    assert runs.digests(no_docs).count() == runs.periodic_runs(no_docs).count() == runs.collapsed(no_docs).count() == 0
    text = "so it goes " * 9 + "and then it ends"
    one = spark.createDataFrame([(3, text)], "doc_id long, text string")
    assert [tuple(r) for r in runs.periodic_runs(one).collect()] == [(3, 0, 27, 3)]
    assert runs.collapsed(one).first().text == "so it goes and then it ends"


def test_every_tenth_document_is_echoed():
    doc_id = next(i for i in range(100) if runs.zlib.crc32(str(i).encode()) % 10 == 0)
    listed = [str(i).encode() for i in range(50)]
    g = runs.zlib.crc32(str(doc_id).encode()) // 10
    a = g % 50
    p = 1 + (50 - a) // (3 + g % 8)
    assert runs.echoed(doc_id, listed) == [listed[i if i < a else a + (i - a) % p] for i in range(50)]
    assert runs.echoed(None, listed) == listed and runs.echoed(doc_id, []) == []


def test_slices_hold_whole_rows():
    batch = pa.record_batch({"text": pa.array(["a" * n if n else None for n in (5, 0, 3, 40, 2, 2)])})
    parts = [p.column("text").to_pylist() for p in words.slices([batch], "text", 8)]
    assert parts == [["aaaaa", None, "aaa"], ["a" * 40], ["aa", "aa"]]


# filters


def _failed(text, first, doc_id):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = {
        "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": bool(re.search("[#$%&*|]", text)), "E": doc_id is not None and doc_id > first,
    }
    return {f for f, bad in fails.items() if bad}


def _audit(rows, labels):
    """By walking every order, document by document."""
    firsts, good, toxic = {}, set(), set()
    for doc_id, text, _ in rows:
        if doc_id is not None:
            firsts[text or ""] = min(firsts.get(text or "", doc_id), doc_id)
    for doc_id, quality, bad in labels:
        good |= {doc_id} if quality == 1 else set()
        toxic |= {doc_id} if bad == 1 else set()
    by_part = defaultdict(list)
    for doc_id, text, source in rows:
        failed = _failed(text or "", firsts.get(text or ""), doc_id)
        known = doc_id is not None
        by_part[source or ""].append((failed, known and doc_id in good, known and doc_id in toxic))
    out, shares = {}, Counter()
    for part, docs in by_part.items():
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order):
                gone = [d for d in left if f in d[0]]
                again = sum(f in d[0] for d in docs) - len(gone)
                left = [d for d in left if f not in d[0]]
                alone = sum(d[0] == {f} for d in docs)
                out[part, order, step + 1] = (len(left), len(gone), again, alone, sum(d[1] for d in gone), sum(d[2] for d in gone))
                shares[part, f] += len(gone)
    return {key: (*row, shares[key[0], key[1][key[2] - 1]]) for key, row in out.items()}


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, None, 1), (9, 1, 1), (None, 1, 1), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def _audited(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in df.collect()}


def test_audit_of_the_cases(spark, docs, no_docs, labels):
    plain = [(i, t, s) for i, t, _, s in CASES]
    given = [tuple(r) for r in labels.collect()]
    assert _audited(filters.audit(docs, labels)) == _audit(plain, given)
    assert filters.audit(no_docs, labels).count() == 0
    unlabelled = _audited(filters.audit(docs, labels.limit(0)))
    assert unlabelled == _audit(plain, [])


def test_matrix_counts_words(spark, docs):
    """Shards in terms of one dictionary, whose terms are dense, with several buckets and blocks."""
    made = filters.matrix(docs.repartition(3), bucket_words=2)
    terms = {r.term: r.word for r in made.dictionary.collect()}
    assert sorted(terms) == list(range(len(terms))) and len(set(terms.values())) == len(terms)
    have = Counter()
    for shard in made.shards.collect():
        for r, doc in enumerate(shard.docs):
            cells = range(shard.first[r], shard.first[r + 1])
            have[doc.doc_id, frozenset((terms[shard.term[c]], shard.n[c]) for c in cells)] += 1
    want = Counter((i, frozenset(Counter(re.findall(r"[^\x20\x09-\x0D]+", t or "")).items())) for i, t, *_ in CASES)
    assert have == want


def test_words_of_slices_end_with_their_texts():
    texts = pa.array(["ab", "cd ef", None, "", " gh\t\x0bi j ", "ab"])
    first, code, word = words.split(texts.slice(0))
    listed = [[word[c].as_py().decode() for c in code[first[t] : first[t + 1]]] for t in range(len(texts))]
    assert listed == [["ab"], ["cd", "ef"], [], [], ["gh", "i j"], ["ab"]]
    first, code, word = words.split(texts.slice(1, 2))
    assert first.tolist() == [0, 2, 2] and len(word) == 2


# archives


PAGES = [
    # page_id, url, html
    (7, "http://a.example/x y", "<p>" + "same page " * 30), (3, "http://a.example/", "<p>" + "same page " * 30),
    (9, None, "<p>" + "same page " * 30), (None, "http://b.example/", "<p>" + "same page " * 30),
    (4, "http://c.example/\r\nX: y", "short"), (5, None, "short"), (6, "http://d.example/", None), (8, "u", ""),
    (10, "http://e.example/ä", "ä" * 50), (11, "v", "ä" * 50), (12, "w", "\r\n\r\nWARC/1.1\r\n" * 20),
    (13, "x", "x" * 300_000), (14, "y", "z" * 99), (15, "y", "z" * 99), (16, "y", warc.BETWEEN * 30),
    (17, "http://f.example/", "twice"), (17, "http://f.example/", "twice"),
]


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    for name in "size digest first first_url payload key hot copies n".split():
        df = df.selectExpr("*", f"'other' as `{name}`")
    return df


def _archived(rows, least=100):
    firsts = {}
    for page_id, _, html in rows:
        if page_id is not None and len((html or "").encode()) >= least:
            firsts[html] = min(firsts.get(html, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        first = firsts.get(html)
        again = first is not None and first != page_id
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first if again else None))
    return Counter(out)


def test_archives_give_the_pages_back(spark, pages, tmp_path):
    assert Counter(map(tuple, warc.round_trip(pages).collect())) == _archived(PAGES)
    warc.write(pages, f"{tmp_path}/archive")
    back = {r.page_id: r for r in warc.read(spark, f"{tmp_path}/archive").collect()}
    assert back[3].html == PAGES[1][2] and back[7].html is None and back[12].html == PAGES[10][2]
    assert back[4].url == "http://c.example/%0D%0AX:%20y" and back[5].url == "urn:page:5" and back[10].url == "http://e.example/%C3%A4"
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archives_are_plain_zstandard_with_their_dictionary(spark, tmp_path):
    """Another reader, given the dictionary of the leading frame, reads the rest as one stream; records are a frame each."""
    many = spark.range(400).select(
        F.col("id").alias("page_id"), F.lit("http://a.example/").alias("url"),
        F.concat(F.lit("<html><body><p>"), F.repeat(F.md5(F.col("id").cast("string")), 20)).alias("html"),
    )
    warc.write(many.coalesce(2), f"{tmp_path}/archive")
    files = [f for f in glob.glob(f"{tmp_path}/archive/part-*") if not f.endswith(".crc")]
    seen = 0
    for name in files:
        data = open(name, "rb").read()
        magic, size = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
        assert magic == warc.DICTIONARY_FRAME and int.from_bytes(data[8:12], "little") == warc.DICTIONARY
        known = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        reader = zstandard.ZstdDecompressor(dict_data=known)
        whole = reader.stream_reader(io.BytesIO(data[8 + size :]), read_across_frames=True).read()
        assert whole == b"".join(warc.frames(data))
        seen += sum(1 for _ in warc.frames(data)) - 1
        packed = len(data) - size - 8
        alone = sum(len(zstandard.compress(f)) for f in warc.frames(data))
        assert packed < alone  # the dictionary helps
    assert seen == 400


def test_frames_of_every_kind():
    texts = [b"", b"x", b"ab" * 40_000, bytes(range(256)) * 3, random.Random(1).randbytes(200_000)]
    data = b""
    for text in texts:
        for checksum in (False, True):
            for size in (False, True):
                packed = zstandard.ZstdCompressor(write_checksum=checksum, write_content_size=size)
                data += packed.compress(text) + warc.BETWEEN.encode()
    at, ends = 0, 0
    while at < len(data):
        at, ends = warc.frame_end(memoryview(data), at), ends + 1
    assert at == len(data) and ends == 2 * 4 * len(texts)
    with pytest.raises(ValueError):
        warc.frame_end(memoryview(b"nothing here"), 0)


def test_payloads_of_many_pages_are_looked_up_by_broadcast(spark):
    """Above and below a thousandth of the rows."""
    text = F.when(F.col("id") < 900, "hot " * 40).when(F.col("id") < 902, "cold " * 40).otherwise(F.repeat(F.md5(F.col("id").cast("string")), 4))
    many = spark.range(3_000).select((F.col("id") + 5).alias("page_id"), F.lit("u").alias("url"), text.alias("html"))
    found = warc.records(many).where("first is not null").groupBy("first").count().collect()
    assert sorted(map(tuple, found)) == [(5, 899), (905, 1)]


# personal data: spans kept apart


def test_spans_are_kept_apart_as_by_comparing_all():
    from footfall.llm import pii

    draw = random.Random(5)
    for _ in range(300):
        taken = [(a, a + draw.randint(1, 9)) for a in (draw.randrange(80) for _ in range(draw.randint(0, 8)))]
        starts = sorted(draw.sample(range(90), draw.randint(0, 12)))
        spans = [(a, min(a + draw.randint(1, 6), b)) for a, b in zip(starts, [*starts[1:], 99])]
        want = [(a, b) for a, b in spans if not any(x < b and a < y for x, y in taken)]
        assert list(pii._free(spans, pii._merged(taken))) == want


def test_texts_full_of_spans_take_time_in_proportion():
    import time

    from footfall.llm import pii

    def seconds(n):
        start = time.perf_counter()
        assert len(pii.find("tel 030 123 4567 x, " * n)) == n
        return time.perf_counter() - start

    seconds(1_000)
    few, many = min(seconds(4_000) for _ in range(3)), min(seconds(16_000) for _ in range(3))
    assert many < 8 * few


def test_blocks_come_from_small_arrow_batches(spark, monkeypatch):
    from footfall.llm.common import BATCH_KEY

    named = spark.conf.get(BATCH_KEY, None)
    spark.conf.unset(BATCH_KEY)
    try:
        monkeypatch.setattr(filters, "BLOCK", 4000)
        docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.repeat(F.lit("some words "), 50).alias("text"))
        rows = filters.measured(docs.coalesce(1))
        assert spark.conf.get(BATCH_KEY) == "4000"
        assert rows.count() == 200 and rows.agg(F.sum("words")).first()[0] == 200 * 100
    finally:
        spark.conf.unset(BATCH_KEY) if named is None else spark.conf.set(BATCH_KEY, named)


def test_a_block_is_the_same_in_pieces_and_takes_less_memory(monkeypatch):
    draw = random.Random(5)
    texts = [" ".join(f"w{draw.randrange(3000)}" for _ in range(draw.randrange(400))) for _ in range(1500)] + ["", "x", " "]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])

    def made(size):
        monkeypatch.setattr(filters, "PIECE", size)
        tracemalloc.start()
        first, code, n, words = filters._counted(batch)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return (first.tolist(), code.tolist(), n.tolist(), words.to_pylist()), peak

    (whole, most), (pieces, least) = made(1 << 30), made(50_000)
    assert pieces == whole and least < most / 2
    for r, text in ((0, texts[0]), (1500, ""), (1501, "x"), (1502, " ")):
        own = slice(whole[0][r], whole[0][r + 1])
        assert {whole[3][c].decode(): n for c, n in zip(whole[1][own], whole[2][own])} == Counter(text.split())
