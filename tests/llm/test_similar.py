"""The Jaccard join and nearest neighbours against brute force."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter
from functools import partial
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import documents, edge_rows, sentence
from pyspark.sql import functions as F

from gridmart.llm import jaccard, nearest
from gridmart.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, width, percent):
    """(id, set size, smallest reachable id) by comparing all pairs."""
    sets = []
    for _, text, *_ in rows:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and group[i] != group[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
    least = {}
    for (doc_id, *_), g in zip(rows, group):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return Counter((r[0], len(s), least.get(g) if s else r[0]) for r, s, g in zip(rows, sets, group))


def variants(seed, base_words, n, changes):
    dice = random.Random(seed)
    base = sentence(seed, base_words).split(" ")
    for _ in range(n):
        words = list(base)
        for _ in range(dice.randint(0, changes)):
            at = dice.randrange(len(words))
            words[at : at + 1] = dice.choice([[], [f"x{dice.randrange(30)}"], [words[at], "again"]])
        yield " ".join(words)


def found(frame):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in frame.collect())


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_edge_rows(edge, nothing, width, percent):
    classes = jaccard.similarity_classes(edge, words_each=width, percent=percent)
    assert found(classes) == brute(edge_rows(), width, percent)
    assert jaccard.similarity_classes(nothing, words_each=width, percent=percent).count() == 0


@pytest.mark.parametrize(("width", "percent", "changes"), [(3, 90, 6), (3, 90, 14), (5, 80, 12), (2, 60, 30)])
def test_groups_of_near_copies(spark, width, percent, changes):
    rows = [(1000 * g + i, t, "en", "a") for g in range(5) for i, t in enumerate(variants(g, 60 + 50 * g, 45, changes))]
    passage = sentence(99, 40)
    rows += [(9000 + i, passage + " " + sentence(500 + i, 15), "en", "a") for i in range(40)]
    random.Random(1).shuffle(rows)
    classes = jaccard.similarity_classes(documents(spark, rows), words_each=width, percent=percent)
    assert found(classes) == brute(rows, width, percent)


def test_a_task_indexes_copies_of_a_set_once():
    texts = ["a b c d e f"] * 40 + ["A  b c d e\tf", "q r s t u v", "", " "]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])] * 2
    counts = SimpleNamespace(value=np.zeros(1 << jaccard.SKETCH_BITS, np.uint16))
    rows = [r for b in jaccard._prefixes(iter(batches), 3, 50, counts) for r in b.to_pylist()]
    # Two sets of four shingles, of which a similarity of half leaves three in front.
    assert len(rows) == len({(r["token"], r["c1"]) for r in rows}) == 6
    assert {(r["n"], r["pos"]) for r in rows} == {(4, 0), (4, 1), (4, 2)}


def test_differences_of_a_group_grow_as_its_sets(spark, monkeypatch):
    """Copies with a few changes out of many that others have too: each is compared with a root or two."""
    dice = random.Random(5)
    rows = []
    for i in range(300):
        words = [f"w{k}" for k in range(150)]
        for _ in range(dice.randint(0, 6)):
            words[dice.randrange(150)] = f"x{dice.randrange(6)}"
        rows.append((i, " ".join(words), "en", "a"))
    kept = []
    derived = jaccard._derived
    monkeypatch.setattr(jaccard, "_derived", lambda around, percent: (kept.append(around), derived(around, percent))[1])
    assert found(jaccard.similarity_classes(documents(spark, rows), words_each=5, percent=80)) == brute(rows, 5, 80)
    counts = kept[0].agg(F.count("*").alias("rows"), F.countDistinct("node").alias("sets")).first()
    assert counts["sets"] > 200
    assert counts["rows"] < 2 * counts["sets"]


def test_one_of_each_class_stays(edge):
    classes = brute(edge_rows(), 5, 80)
    kept = Counter((r["doc_id"], r["text"]) for r in jaccard.representatives(edge).collect())
    assert all(n == 1 for (i, t), n in kept.items() if (t or "").split())
    homes = {c for (_, n, c), _ in classes.items() if n}
    assert {i for i, t in kept if (t or "").split()} == homes
    bare = Counter((i, t) for i, t, *_ in edge_rows() if not (t or "").split())
    assert {k for k in kept if not (k[1] or "").split()} == set(bare)
    assert jaccard.representatives(edge).columns == edge.columns


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(301, 302), (302, 303), (303, 301), (5, 5)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    homes = {r["node"]: r["component"] for r in connected_components(frame).collect()}
    assert homes == {i: 0 for i in range(41)} | {100: 100} | {200 + i: 100 for i in range(30)} | {301: 301, 302: 301, 303: 301}


def vectors(n, dim, seed=0, scale=None):
    random_ = np.random.default_rng(seed)
    points = random_.normal(size=(n, dim))
    return points if scale is None else points * random_.uniform(*scale, size=(n, 1))


@pytest.mark.parametrize("scale", [None, (0.5, 1.0)])
def test_recall_against_all_pairs(spark, scale):
    points = vectors(1500, 16, 3, scale).astype(np.float32)
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id bigint, embedding array<float>")
    rows = nearest.nearest(frame, F.col("vec_id") % 20 == 0, k=10).collect()
    exact = points.astype(float) @ points.astype(float).T
    np.fill_diagonal(exact, -np.inf)
    hits = 0
    for r in rows:
        assert abs(r["score"] - exact[r["query_id"], r["vec_id"]]) < 1e-12
        hits += r["vec_id"] in np.argsort(-exact[r["query_id"]])[:10]
    assert hits >= 0.9 * 10 * 75
    assert Counter(r["query_id"] for r in rows) == Counter({q: 10 for q in range(0, 1500, 20)})


def test_rows_that_take_no_part_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, 0.5 * (i % 2)]) for i in range(40)]
    bad = [(100, None), (120, [0.0, 0.0]), (140, [nan, 1.0]), (160, [inf, 1.0]), (180, [None, 1.0]), (200, [1.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame(good + bad + good[:5], "vec_id bigint, embedding array<double>")
    frame = frame.withColumn("score", F.lit("x")).withColumn("rank", F.lit(1))
    rows = nearest.nearest(frame, F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in rows] == (
        [(0, k, v) for k, v in zip(range(1, 6), [1, 2, 3, 4, 5])] + [(20, k, v) for k, v in zip(range(1, 6), [0, 1, 2, 3, 4])]
    )


def ranking(rows, k):
    """(query_id, rank, vec_id) against all vectors, products summed in the order of the components."""
    wanted = []
    for q, asked in ((i, v) for i, v in rows if i % 20 == 0):
        scores = []
        for i, held in rows:
            total = 0.0
            for a, b in zip(asked, held):
                total += a * b
            scores += [(-total, i)] * (i != q)
        wanted += [(q, rank, i) for rank, (_, i) in enumerate(sorted(scores)[:k], 1)]
    return wanted


def ranked(frame):
    return [tuple(r)[:3] for r in frame.orderBy("query_id", "rank").collect()]


def test_an_outlier_norm_does_not_shorten_the_lists(spark):
    points = vectors(3000, 64, 5)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    points[1] *= 300
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id bigint, embedding array<double>")
    rows = nearest.nearest(frame, F.col("vec_id") % 20 == 0).collect()
    assert Counter(r["query_id"] for r in rows) == Counter({q: 20 for q in range(0, 3000, 20)})
    exact = points @ points.T
    np.fill_diagonal(exact, -np.inf)
    hits = sum(r["vec_id"] in np.argsort(-exact[r["query_id"]])[:20] for r in rows)
    assert hits >= 0.95 * 20 * 150


@pytest.mark.parametrize("n", [5, 20, 21, 60])
def test_small_tables_are_ranked_whole(spark, n):
    rows = [(i, p.tolist()) for i, p in enumerate(vectors(n, 64, n, (0.01, 100)))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = ranked(nearest.nearest(frame, F.col("vec_id") % 20 == 0, n_probes=2))
    assert [f[:2] for f in found] == [w[:2] for w in ranking(rows, 20)]
    if n <= 21:
        assert found == ranking(rows, 20)


@pytest.mark.parametrize(("n", "n_queries", "norm"), [(203, 1, 3000), (203, 37, 3000), (101, 5, 1e6), (203, 1, 1e-9)])
def test_a_block_keeps_the_smallest_of_equal_vectors(n, n_queries, norm):
    import pyarrow as pa

    points = vectors(n_queries, 65, 1)
    base = points[0] / np.linalg.norm(points[0])
    vectors_ = pa.table({"id": range(n), "bucket": [0] * n, "vector": [(norm * base).tolist()] * n})
    queries = pa.table({"id": range(1000, 1000 + n_queries), "buckets": [[0]] * n_queries, "vector": (points / 8 + base).tolist()})
    found = nearest._block_best((), queries, vectors_, 65, 20).to_pydict()
    assert list(zip(found["query_id"], found["vec_id"])) == [(1000 + q, i) for q in range(n_queries) for i in range(20)]


@pytest.mark.parametrize(("block", "size"), [(nearest.BLOCK_VECTORS, 1e-8), (64, 300)])
def test_equal_vectors_of_any_norm_tie(spark, monkeypatch, block, size):
    monkeypatch.setattr(nearest, "BLOCK_VECTORS", block)
    points = vectors(400, 64, 8)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    base = points[7].copy()
    points[1::2] = 300 * base
    points[::20] = 0.3 * points[::20] + base
    points[33::40] *= 1.5
    points *= size
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    assert ranked(nearest.nearest(frame, F.col("vec_id") % 20 == 0)) == ranking(rows, 20)


def test_few_or_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert nearest.nearest(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (7, [2.0, 1.0])], schema)
    assert [tuple(r) for r in nearest.nearest(two, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 7, 4.0)]


def test_probing_order_starts_at_home_and_never_uses_both_walls():
    order = nearest.probing_order(4, 60)
    assert order[:3] == [(), (0,), (1,)]
    assert len(set(order)) == 60
    assert all(len({min(r, 7 - r) for r in ranks}) == len(ranks) for ranks in order)


def test_texts_are_compressed_before_they_are_shuffled_and_shared_tokens_need_no_join(spark, monkeypatch):
    plans = {}
    kept = jaccard.stored

    def keep(frame, name):
        plans[name] = frame._jdf.queryExecution().optimizedPlan().toString()
        return kept(frame, name)

    monkeypatch.setattr(jaccard, "stored", keep)
    rows = [(i, t, "en", "a") for i, t in enumerate(variants(3, 80, 40, 14))]
    classes = jaccard.similarity_classes(documents(spark, rows), words_each=3, percent=90)
    assert found(classes) == brute(rows, 3, 90)
    assert "Join" not in plans["jaccard-outliers"]
    assert 0 <= plans["jaccard-sets"].find("Join") < plans["jaccard-sets"].find("MapInArrow")


def test_the_driver_holds_the_sketch_in_two_bytes_a_count(edge):
    texts = edge.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    schema = "doc_id bigint, text_hash bigint, n int, c1 bigint, c2 bigint, part int, counts binary"
    described = jaccard.map_batches(texts, partial(jaccard._describe, words_each=3), schema).cache()
    described.count()
    tracemalloc.start()
    sketch = jaccard._sketch(described)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sketch.nbytes == 2 << jaccard.SKETCH_BITS and peak < 2 * sketch.nbytes
    tokens = np.concatenate([jaccard.shingle_set(r[1], 3) for r in edge_rows()]) >> np.uint64(64 - jaccard.SKETCH_BITS)
    counts = np.bincount(tokens.astype(np.int64), minlength=len(sketch))
    assert (sketch == np.minimum(np.log1p(counts) * jaccard.LOG_STEPS, 65535).astype(np.uint16)).all()
