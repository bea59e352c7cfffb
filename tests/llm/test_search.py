"""Nearest vectors, ranked search and spelling variants: against brute force, and on odd rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratinglens.llm import neighbours, ranking, variants
from ratinglens.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, word string, n long, block long, term string, item string, score int, rank int"
VECTORS = "vec_id long, embedding array<double>, id long, vec string, block int, asks int, score int, of int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", "z", 3, 4) for i, t in rows], DOCS)


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3, 4, 5) for i, v in rows], VECTORS)


# nearest vectors


def cosine(a, b):
    return float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))


def test_nearest_vectors_recall(spark):
    table = pd.read_parquet(f"{SF_DIR}/embeddings.parquet")
    raw = np.array(table.embedding.tolist(), dtype=np.float64)
    got = QUERIES["op11_nearest_vectors"](spark, SF_DIR).toPandas()
    asked = table.vec_id[table.vec_id % 50 == 0].tolist()
    assert sorted(got.query_id.unique()) == asked
    hits = 0
    for query, own in got.sort_values("rank").groupby("query_id"):
        assert own["rank"].tolist() == [1, 2, 3, 4, 5]
        vector = raw[table.index[table.vec_id == query][0]]
        scores = {i: cosine(vector, v) for i, v in zip(table.vec_id, raw, strict=True) if i != query}
        assert own.score.tolist() == pytest.approx([scores[i] for i in own.vec_id], abs=1e-12)
        assert list(zip(-own.score, own.vec_id, strict=True)) == sorted(zip(-own.score, own.vec_id, strict=True))
        hits += len(set(own.vec_id) & set(sorted(scores, key=lambda i: (-scores[i], i))[:5]))
    assert hits >= 0.95 * 5 * len(asked)


def test_nearest_vectors_of_many_blocks(spark, monkeypatch):
    """Clusters and a vector with many copies, in small blocks and query groups."""
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    monkeypatch.setattr(neighbours, "QUERY_GROUP", 7)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 24))
    raw = [(centres[i % 20] + 0.2 * rng.standard_normal(24)).tolist() for i in range(600)] + [[1.0] * 24] * 300
    table = vectors_of(spark, list(enumerate(raw)))
    got = neighbours.nearest(table, F.col("id") % 50 == 0).toPandas()
    assert len(got) == 18 * 5
    hits = 0
    for query, own in got.groupby("query_id"):
        order = sorted((i for i in range(900) if i != query), key=lambda i: (-round(cosine(raw[query], raw[i]), 12), i))[:5]
        hits += len(set(order) & set(own.vec_id))
        if query >= 600:  # equal vectors: smallest ids, exact
            assert own.sort_values("rank").vec_id.tolist() == order and own.score.tolist() == pytest.approx([1] * 5)
    assert hits >= 0.95 * len(got)


def test_nearest_vectors_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]),  # a repeated row counts once
        (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, [-1.0, 0.0]), (3, [0.9, 0.1]),  # an id with two vectors: its best
        (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]),
        (50, [0.0, 0.0]), (11, [1e-300, 0.0]), (12, [1e300, 1e300]),
    ]
    got = neighbours.nearest(vectors_of(spark, rows), F.col("id") % 50 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [
        (0, 1, 1), (0, 2, 11), (0, 3, 3), (0, 4, 2), (0, 5, 12)
    ]
    assert [round(r.score, 9) for r in sorted(got, key=lambda r: r["rank"])[3:]] == [round(math.sqrt(0.5), 9)] * 2
    few = neighbours.nearest(vectors_of(spark, rows[:5]), F.col("id") % 50 == 0)
    assert [r.vec_id for r in few.orderBy("rank").collect()] == [1, 2, 3]  # all candidates, if fewer
    assert neighbours.nearest(vectors_of(spark, rows[:1]), F.col("id") % 50 == 0).count() == 0
    empty = neighbours.nearest(vectors_of(spark, []), F.col("id") % 50 == 0)
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]
    asks_none = neighbours.nearest(vectors_of(spark, rows), F.lit(None).cast("boolean"))
    assert asks_none.count() == 0
    with pytest.raises(ValueError):
        neighbours.nearest(vectors_of(spark, rows), F.lit(True), k=0)


# ranked search


def ranked(docs, items, top=10):
    term = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    bags = [(i, Counter(term.findall((t or "").translate(LOWER)))) for i, t in docs]
    bags = [(i, b, b.total()) for i, b in bags if b]
    n_docs, total = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    by_item = defaultdict(set)
    for item, text in items:
        by_item[item] |= set(term.findall((text or "").translate(LOWER)))
    out = []
    for item, own in by_item.items():
        scores = []
        for i, bag, n in bags:
            m = 100 - 90 + (90 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in own & bag.keys()
            )
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda s: (*s[:2], s[2] or 0))[:top])]
    return out


def rows_of(found):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=repr)


@pytest.mark.parametrize("leaf", [1, 3, 64])
def test_tree_finds_what_a_full_scan_finds(monkeypatch, leaf):
    monkeypatch.setattr(ranking, "LEAF", leaf)
    rng = np.random.default_rng(leaf)
    for _ in range(10):
        n, n_terms = int(rng.integers(1, 300)), 30
        terms = [np.sort(rng.choice(n_terms, int(rng.integers(1, 9)), replace=False)) for _ in range(n)]
        terms[n // 2 :] = [terms[0]] * (n - n // 2)  # many of one path
        tfs = [rng.integers(1, 6, len(t)) for t in terms]
        m = rng.integers(10, 400, n)
        tree = ranking.TermTree(list(range(n)), m, terms, tfs, n_terms)
        for _ in range(10):
            own = np.sort(rng.choice(n_terms, 6, replace=False))
            weights = rng.integers(0, 500, n_terms)
            scores = [
                sum(int(weights[t]) * ((10**9 * int(f)) // (1000 * int(f) + 8 * int(m[d]))) for t, f in zip(terms[d], tfs[d], strict=True) if t in own)
                for d in range(n)
            ]
            want = sorted((-s, False, d) for d, s in enumerate(scores) if s > 0)[:10]
            assert tree.best(own, weights[own], 10) == want


@pytest.mark.parametrize(("documents", "terms"), [(8192, 50_000), (30, 50_000), (200, 100)])
def test_ranked_search(spark, monkeypatch, documents, terms):
    """All sizes of trees and item blocks give the ranking of a full scan."""
    monkeypatch.setattr(ranking, "TREE_DOCUMENTS", documents)
    monkeypatch.setattr(ranking, "BLOCK_TERMS", terms)
    docs = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    items = pd.read_parquet(f"{SF_DIR}/benchmark.parquet")
    if terms < 50_000:
        items = items[:8]
    want = ranked(zip(docs.doc_id, docs.text, strict=True), zip(items.item_id, items.text, strict=True))
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = ranking.rank_documents(table, spark.createDataFrame(items))
    assert rows_of(found) == sorted(want, key=repr)


def test_ranked_search_odd_rows(spark):
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    docs = [
        (1, None), (2, ""), (3, " \n!"), (4, "Red fox, red hen"), (4, "Red fox, red hen"), (5, "red fox red hen"), (None, "red fox red hen"),
        (6, long), (7, "blue"), (8, "Été été É"),
    ]
    items = [(1, "RED fox"), (1, "fox hen hen"), (2, None), (3, "word1 word976 blue"), (None, "blue"), (4, "nowhere"), (5, "été")]
    schema = "item_id long, text string, doc_id string, term int"
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items], schema)
    found = ranking.rank_documents(docs_of(spark, docs), bench)
    got = rows_of(found)
    assert got == sorted(ranked(docs, items), key=repr)
    assert [r[2] for r in sorted(got, key=lambda r: r[1]) if r[0] == 1] == [4, 4, 5, None]
    assert ranking.rank_documents(docs_of(spark, []), bench).count() == 0
    assert ranking.rank_documents(docs_of(spark, docs), spark.createDataFrame([], schema)).count() == 0
    assert [r.doc_id for r in ranking.rank_documents(docs_of(spark, docs), bench, top=1).where("item_id = 1").collect()] == [4]
    with pytest.raises(ValueError):
        ranking.rank_documents(docs_of(spark, docs), bench, top=0)


def test_tree_leaves_out_subtrees(spark):
    """A search reads few leaves where the bounds tell them apart."""
    ids = list(range(4000))
    terms = [np.array([0, 1]) if i < 40 else np.array([i % 50 + 2, 60 + i % 7]) for i in ids]
    tfs = [np.array([5, 5]) if i < 40 else np.array([1, 1]) for i in ids]
    tree = ranking.TermTree(ids, np.full(4000, 100, dtype=np.int64), terms, tfs, 67)
    assert len(tree.low) > 40 and tree.low[0] == 0 and tree.high[0] == 4000
    read = []
    scored = ranking._scores
    try:
        ranking._scores = lambda w, tf, m: read.append(len(tf)) or scored(w, tf, m)
        best = tree.best(np.array([0, 1, 5, 60]), np.array([50, 50, 10, 1]), 10)
    finally:
        ranking._scores = scored
    assert [b[2] for b in best] == list(range(10))
    assert len(read) <= 3  # the bounds of all nodes, and the leaf with the best


# spelling variants


def spelled(rows, min_length=5, min_count=3):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= min_length:
                counts[word] += 1
    words = {w: n for w, n in counts.items() if n >= min_count}
    near, holes = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            holes[w[:k], w[k + 1 :]].add(w)
            if (less := w[:k] + w[k + 1 :]) in words:
                near[w].add(less)
                near[less].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_spelling_variants(spark):
    docs = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    got = {tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_spelling_variants"](spark, SF_DIR).collect()}
    assert got == spelled(zip(docs.doc_id, docs.text, strict=True))
    assert any(form != root for _, form, root, *_ in got if form)


def test_spelling_variants_in_small_chunks(spark, monkeypatch):
    """Blocks over the chunk size, many visitors, and few remembered words."""
    monkeypatch.setattr(variants, "CHUNK", 7)
    monkeypatch.setattr(variants, "VISITORS", 5)
    monkeypatch.setattr(variants, "REMEMBERED", 50)
    rng = np.random.default_rng(4)
    stems = ["".join(rng.choice(list("abcé"), 6)) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(stems, 40) if i % 2 else stems[:60])) for i in range(120)]
    found = variants.spelling_variants(docs_of(spark, rows)).collect()
    want = spelled(rows)
    assert {tuple(r[c] for c in COLUMNS) for r in found} == want and len(found) == len(want)
    assert sum(w[4] for w in want) > 300


def test_spelling_variants_odd_rows(spark):
    letters = "AbÀ×ÿ" * 700  # over the length of single precision
    rows = [
        (1, None), (2, ""), (3, "12 !? 中文 Ā"), (4, "Colour colour COLOUR color color color colors colors colors"), (4, "colour color"),
        (4, "colour color"), (None, "color color colour colour"), (5, "coloĀur color中color"), (6, "four four four fives fives fives"),
        *[(i, f"{letters} {letters}x {letters[:-1]}") for i in range(20, 26)], (10, "color " * 60_000),
    ]
    got = variants.spelling_variants(docs_of(spark, rows)).collect()
    assert {tuple(r[c] for c in COLUMNS) for r in got} == spelled(rows)
    assert {r.word for r in got if len(r.word) > 2000 and r.n_near == 2} == {letters.translate(LOWER)}
    assert variants.spelling_variants(docs_of(spark, [])).count() == 0
    assert variants.spelling_variants(docs_of(spark, [(1, None)])).count() == 0
    short = variants.spelling_variants(docs_of(spark, [(1, "ab b ab b")]), min_length=1, min_count=2).collect()
    assert {(r.word, r.n_near) for r in short} == {("ab", 1), ("b", 1)}


def test_roots_of_a_long_chain(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("a", "b")]
    got = {r.word: r.root for r in variants.roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {**{f"w{i}": "w37" for i in range(37)}, "a": "b"}
