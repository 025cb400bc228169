"""Mixing, near-duplicates, vectors, search, sharding and the pipeline against plain versions and SQL."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import oracle
import pytest
from conftest import CASES
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from footfall.llm import embeddings, minhash, mixing, pii, sharding, topk, toxicity
from footfall.llm import queries as llm

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_query_matches_sql(spark, name):
    assert oracle.difference(llm.QUERIES[name](spark, SF), oracle.connect(SF), llm.ORACLE[name]) is None


def test_each_operator_has_one_query():
    numbers = [re.match(r"op(\d+)_", name) for name in llm.QUERIES]
    assert sorted(int(m[1]) for m in numbers) == list(range(1, 14))
    assert set(llm.QUERIES) | {"pipeline"} <= set(entry_point.queries())


# mixing


def _words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _water(sizes):
    """Targets by repeated sharing, as the contract words it."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1.0 for i, s in enumerate(names)}
    left, target, open_ = float(sum(sizes.values())), dict.fromkeys(names, 0.0), set(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not full:
            return {**target, **share}
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def _check_mix(rows, block):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
        assert (r.first_slot is None) == (r.taken == 0)
    want = _water(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
    for s in sizes:
        assert taken[s] == math.floor(want[s] + 1e-9) or abs(taken[s] - want[s]) <= 1


@pytest.mark.parametrize("block", [3, 16, 2048])
def test_mix_cases(docs, no_docs, block):
    rows = mixing.mix(docs, block).collect()
    assert sorted((r.doc_id, r.size) for r in rows if r.doc_id) == sorted((i, _words(t)) for i, t, *_ in CASES if i)
    _check_mix(rows, block)
    assert sorted(rows, key=repr) == sorted(mixing.mix(docs.repartition(5), block).collect(), key=repr)
    assert mixing.mix(no_docs, block).count() == 0


def test_mix_with_capped_sources(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "abcdefgh"[min(7, i // 3)]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for block in (4, 64):
        _check_mix(mixing.mix(df, block).collect(), block)


def test_schedule_is_even_at_every_point(spark):
    """Any beginning of the schedule holds each source nearly in proportion."""
    rows = [(s, 1000 * (i + 1)) for i, s in enumerate("abcdef")]
    sizes = spark.createDataFrame(rows, "source_key string, size long")
    plan = mixing.targets(sizes)
    slots = mixing.schedule(plan, 7).orderBy("slot").collect()
    target = {r.source_key: r.target for r in plan.collect()}
    total, seen, n = sum(target.values()), defaultdict(int), 0
    ranks = defaultdict(list)
    for r in slots:
        ranks[r.source_key].append(r["rank"])
        seen[r.source_key] += 1
        n += 1
        assert all(abs(seen[s] - n * target[s] / total) < 8 for s in target)
    assert all(x == list(range(len(x))) for x in ranks.values())


def test_mix_applied(docs, no_docs):
    """Whole texts only, each as often as its words are taken, to the nearest whole number."""
    want = Counter()
    for r in mixing.mix(docs, 16).collect():
        want[r.doc_id, r.source] += (2 * r.taken + r.size) // (2 * r.size) if r.size else 0
    out = mixing.apply(docs, 16)
    assert out.columns == docs.columns
    rows = out.collect()
    assert Counter((r.doc_id, r.source) for r in rows) == +want
    texts = defaultdict(set)
    for i, t, *_ in CASES:
        texts[i].add(t)
    assert all(r.text in texts[r.doc_id] for r in rows)
    assert mixing.apply(no_docs).count() == 0


# near-duplicates


def _sets(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def _components(ids, edges):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def _plain_near(rows, k):
    sets = [(i, _sets(t, k)) for i, t in rows]
    edges = [
        (i, j) for n, (i, a) in enumerate(sets) for j, b in sets[:n]
        if a and b and 100 * len(a & b) >= 80 * len(a | b)
    ]
    return _components([i for i, _ in rows], edges)


def _copies(n, seed):
    """A base of 60 words, and copies with up to a dozen changed words: similarities all around the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(900)}" for _ in range(60)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(13)):
            words[rng.randrange(60)] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_all_pairs(spark, k):
    texts = _copies(300, 1) + _copies(40, 2) + _copies(5, 3) * 3 + [" ".join(f"u{i}w{j}" for j in range(30)) for i in range(60)]
    rows = [(1000 - i if i % 2 else i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = _plain_near(rows, k)
    got = minhash.near_duplicates(df, minhash.Settings(words=k, block=16)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(_sets(t, k)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    kept = {r.doc_id for r in minhash.keep_first(df, minhash.Settings(words=k)).collect()}
    assert kept == set(want.values())


def test_near_duplicate_cases(docs, no_docs):
    rows = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect() if r.doc_id)
    alone = [(i, i, True) for i in (1, 4, 5, 6, 7, 8, 9, 10, 11, 11, 12)]
    assert rows == sorted([*alone, (2, 1, False), (3, 1, False)])
    unnamed = [r for r in minhash.near_duplicates(docs).collect() if r.doc_id is None]
    assert [(r.component_id, r.kept) for r in unnamed] == [(None, True)]
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    assert minhash.near_duplicates(no_docs).count() == 0 and minhash.keep_first(no_docs).count() == 0


def test_rows_with_maps(spark):
    """Columns that Spark can't order don't stop the operators that return documents."""
    rows = [(i // 2, " ".join(f"w{i // 2}x{j}" for j in range(9)), "s", {"k": i}) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, meta map<string,int>")
    kept = minhash.keep_first(df).collect()
    assert sorted(r.doc_id for r in kept) == list(range(6)) and all(r.meta["k"] // 2 == r.doc_id for r in kept)
    mixed = mixing.apply(df, 16).collect()
    assert all((r.doc_id, r.text, r.source, r.meta) in rows for r in mixed)
    assert Counter(r.meta["k"] for r in mixed) == dict.fromkeys(range(12), 1)


def test_sketches_fill_and_estimate():
    """Every coordinate is filled for any size of set, and equal coordinates estimate the similarity."""
    s = minhash.Settings(words=2)
    sketcher, rng = minhash.Sketcher(s), np.random.default_rng(0)
    for n in (1, 2, 7, 100, 5000):
        assert (sketcher.sketch(rng.integers(0, 2**63, n).astype(np.uint64)) != minhash.FULL).all()
    errors = []
    for n in (20, 300, 4000):
        for share in (0.5, 0.8, 0.95):
            x = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
            both = int(n * share)
            a, b = x[:n], np.concatenate([x[:both], x[n : 2 * n - both]])
            truth = both / (2 * n - both)
            errors.append(abs((sketcher.sketch(a) == sketcher.sketch(b)).mean() - truth))
    assert max(errors) < 0.12 and np.mean(errors) < 0.03


# vectors


def _vector_rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 4, dim))
    rows = []
    for i in range(n):
        x = centres[i % len(centres)] + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.25, 0.35, 3.0])
        rows.append((i, [float(v) for v in x], 0))
    rows += [(n, rows[0][1], 0), (n + 1, [2 * v for v in rows[0][1]], 0), (n + 2, None, 0), (n + 3, [], 0)]
    rows += [(n + 4, [0.0] * dim, 0), (n + 5, [float("nan")] * dim, 0), (n + 6, [None] + [1.0] * (dim - 1), 0)]
    rows += [(n + 7, [float("inf")] * dim, 0), (n + 8, [1e300] * dim, 0), (n + 9, [1.0] * dim, 0), (n + 10, [1.0, 2.0], 0)]
    return rows + [(None, rows[1][1], 0), (3, rows[3][1], 0)]


def _valid(x):
    return x is not None and len(x) and all(v is not None and math.isfinite(v) for v in x)


def test_vectors_equal_all_pairs(spark):
    rows = _vector_rows(700, 24, 4)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n", F.lit("x"))
    unit = [
        (i, np.array(x) / max(map(abs, x)) / np.linalg.norm(np.array(x) / max(map(abs, x))))
        for i, x, _ in rows if i is not None and _valid(x) and any(x)
    ]
    links, edges = defaultdict(int), []
    for p, (i, a) in enumerate(unit):
        for q, (j, b) in enumerate(unit):
            if p != q and len(a) == len(b) and a @ b >= 0.9:
                links[p] += 1
                edges.append((i, j))
    component = _components({i for i, *_ in rows if i is not None}, edges)
    want = [(i, links[p], component[i]) for p, (i, _) in enumerate(unit)]
    used = {i for i, _ in unit}
    want += [(i, 0, i) for i, *_ in rows if i not in used]
    for s in (embeddings.Settings(), embeddings.Settings(leaf=40, block=32)):
        got = embeddings.near_duplicates(df, s).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == sorted(want, key=repr)
        assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_forest_finds_links_in_small_leaves(spark):
    """Recall of the leaves alone, against all pairs, where leaves are far smaller than the table."""
    rows = [r for r in _vector_rows(2000, 24, 9) if r[0] is not None and r[0] < 2000][:2000]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    s = embeddings.Settings(leaf=60)
    classes = embeddings.packed(df).withColumn("size", F.lit(1).cast("long")).cache()
    leaves = embeddings.in_leaves(classes, embeddings.forests(classes, s), s).cache()
    x = np.array([r.embedding for r in df.orderBy("vec_id").collect()], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(x @ x.T >= 0.9, 1))
    sides = defaultdict(set)
    for r in leaves.select("kind", "path", "id").collect():
        sides[r.id].add((r.kind, r.path))
    assert leaves.groupBy("kind", "path").count().agg(F.max("count")).first()[0] < len(x) / 4
    assert len(a) > 20 and np.mean([bool(sides[i] & sides[j]) for i, j in zip(a.tolist(), b.tolist())]) > 0.99


def test_top_k_equals_all_products(spark):
    rows = _vector_rows(900, 24, 5)
    rows = [(i, x, y) for i, x, y in rows if x is None or not any(v is not None and abs(v) > 1e200 for v in x)]
    rows += [(2000, [1e13] * 24, 0), (2001, [-3e13, 2e13] * 12, 0), (2100, rows[5][1], 0), (2101, rows[5][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("norm", F.lit("x"))
    whole = [(i, [math.floor(1024 * v) for v in x]) for i, x, _ in rows if i is not None and _valid(x)]
    limit, want = 2**63 - 1, []
    queries = {i for i, _ in whole if i % 50 == 0}
    for q in queries:
        found = [
            (-max(-limit - 1, min(limit, sum(a * b for a, b in zip(x, y)))), j)
            for i, x in whole if i == q for j, y in whole if j != q and len(x) == len(y)
        ]
        want += [(q, n + 1, j, -score) for n, (score, j) in enumerate(sorted(found)[:10])]
    got = [tuple(r) for r in topk.top_k(df, lambda i: i % 50 == 0).collect()]
    assert sorted(got) == sorted(want)
    assert topk.top_k(df.limit(0), lambda i: i % 50 == 0).count() == 0


def test_search_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(4000, 32)) * np.geomspace(2000, 20, 32) * rng.pareto(2, (4000, 1)))
    order = np.argsort(-np.linalg.norm(x, axis=1))
    x, ids = x[order], np.arange(4000)
    _, turn = np.linalg.eigh(x.T @ x)
    search = topk.Search(ids[:50], x[:50], turn[:, ::-1].copy(), 10)
    for start in range(0, 4000, 250):
        part = x[start : start + 250]
        if not search.spent(np.linalg.norm(part, axis=1).max()):
            search.visit(ids[start : start + 250], part)
    products = x[:50] @ x.T
    products[np.arange(50), np.arange(50)] = -np.inf
    for q in range(50):
        want = sorted((-int(products[q, j]), j) for j in range(4000) if j != q)[:10]
        assert search.best[q] == want
    assert search.scored < 0.2 * 50 * 4000


# sharding


def _check_shards(rows, docs, shards):
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=repr) == want
    total, most = sum(s for _, s, _ in want), max(s for _, s, _ in want)
    by = defaultdict(list)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by[r.shard].append(r)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
        assert abs(sum(r["size"] for r in part) - total / shards) <= most
    return by


def test_shards_of_skewed_texts(spark):
    """A third of all rows with one text, one text with a third of all bytes: sums stay near equal."""
    rng = random.Random(2)
    rows = [(i, "the same text") for i in range(3000)] + [(3000 + i, "y" * rng.randrange(200)) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sharding.shard(df).collect()
    by = _check_shards(got, rows, 16)
    groups = defaultdict(set)
    texts = dict(rows)
    for r in got:
        groups[texts[r.doc_id]].add(r.shard)
    # equal texts are cut only where a boundary falls into them
    assert sum(len(g) - 1 for g in groups.values()) <= len(by) - 1
    assert sorted(map(tuple, got)) == sorted(map(tuple, sharding.shard(df.repartition(3)).collect()))


def test_shard_cases(docs, no_docs):
    for shards in (1, 3, 16):
        _check_shards(sharding.shard(docs, shards).collect(), [(i, t) for i, t, *_ in CASES], shards)
    assert sharding.shard(no_docs).count() == 0


def test_sharding_stays_on_dataframe_functions(docs, monkeypatch):
    plan = sharding.shard(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shards_written(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 4


# pipeline


def _run(spark, docs, tmp_path):
    frames = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "/root/testdata/sf0.01")
        if n < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        path = str(tmp_path / str(n))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        frames.append(docs)
    return frames


def test_pipeline_against_a_plain_version(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = _run(spark, docs, tmp_path)
    first = {r.doc_id: r for r in docs.collect()}

    index = toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scorer = toxicity.Scorer(index)
    clean = {i for i, r in first.items() if scorer.score(r.text)[0] < 0.5}
    assert {r.doc_id for r in frames[0].collect()} == clean and len(clean) < len(first)

    component = _plain_near([(i, first[i].text) for i in sorted(clean)], 5)
    assert {r.doc_id for r in frames[1].collect()} == set(component.values()) and len(set(component.values())) < len(clean)

    redacted = {i: pii.redact(first[i].text, pii.find(first[i].text)) for i in set(component.values())}
    third = {r.doc_id: r for r in frames[2].collect()}
    assert {i: r.text for i, r in third.items()} == redacted
    assert all(r.n_chars == len(r.text) for r in third.values())

    copies = {r.doc_id: (2 * r.taken + r.size) // (2 * r.size) for r in mixing.mix(frames[2]).where("size > 0").collect()}
    mixed = frames[3].collect()
    assert Counter(r.doc_id for r in mixed) == +Counter(copies)
    assert all(r.text == redacted[r.doc_id] for r in mixed)

    digests = sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in frames[3].collect())
    assert sorted((r.doc_id, r.decoded_sha256) for r in frames[4].collect()) == digests
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, frames[4].collect()))


def test_pipeline_cases(spark, docs, no_docs, tmp_path):
    frames = _run(spark, docs, tmp_path / "some")
    assert [f.count() > 0 for f in frames] == [True] * 5
    assert [f.count() for f in _run(spark, no_docs, tmp_path / "none")] == [0] * 5
