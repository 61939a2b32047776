"""Sharding and mixing against their laws and against plain loops."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import pytest
from llm.conftest import documents, edge_rows, sentence

from gridmart.llm import mixing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("n_shards", [1, 5, 24])
def test_shards(edge, n_shards):
    rows = sharding.shard_by_bytes(edge, n_shards=n_shards).collect()
    size = lambda t: len((t or "").encode()) + 8
    expected = Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t, _, _ in edge_rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < n_shards
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_even_with_a_hot_group_and_equal_rows(spark):
    rows = [(i, sentence(i, 60), "en", "a") for i in range(900)]
    rows += [(5000 + i, sentence(1, 60), "en", "a") for i in range(600)]
    rows += [(7, sentence(7, 60), "en", "a")] * 600
    placed = sharding.shard_by_bytes(documents(spark, rows), n_shards=8).collect()
    filled = Counter()
    for r in placed:
        filled[r["shard"]] += r["size"]
    most = max(r["size"] for r in placed)
    assert max(filled.values()) - min(filled.values()) <= 2 * most + 0.004 * sum(filled.values()) / 8
    homes = defaultdict(set)
    for r in placed:
        if r["doc_id"] is not None and r["doc_id"] < 900 and r["doc_id"] not in (1, 7):
            homes[r["text_crc32"]].add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())


def test_no_documents_no_shards(nothing):
    assert sharding.shard_by_bytes(nothing).count() == 0


def _targets_by_filling(sizes: dict) -> dict:
    """Shares by weight, capped, the excess shared again until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target = {s: 0.0 for s in names}
    left, open_ = float(sum(sizes.values())), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share, left = left, 0.0
        for s in sorted(open_, key=names.index):
            target[s] += share * weight[s] / total
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def test_mix(edge):
    rows = mixing.mix(edge).collect()
    words = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for _, text, _, source in edge_rows():
        sizes[source] += words(text)
    targets = _targets_by_filling(sizes)
    pairs = {(sizes[s], round(t, 6)) for s, t in targets.items()}
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((i, words(t)) for i, t, _, _ in edge_rows())
    assert {(r["source_size"], round(r["target"], 6)) for r in rows} == pairs
    taken = Counter()
    for r in rows:
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        taken[r["source_size"]] += r["taken"]
    assert sum(taken.values()) <= sum(sizes.values())
    again = mixing.mix(edge.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_sources_come_near_their_targets(spark):
    rows = [(i, sentence(i, 5 + i % 40), "en", f"s{i % 5}") for i in range(1500)]
    rows += [(9000 + i, sentence(i, 30), "en", "hot") for i in range(700)] + [(20_000, "one two", "en", "tiny")]
    mixed = mixing.mix(documents(spark, rows)).collect()
    taken, target = Counter(), {}
    for r in mixed:
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
    assert all(abs(taken[s] - t) <= 45 for s, t in target.items())


def test_mix_is_in_order_and_whole(edge):
    copies = mixing.mixed_copies(edge).filter("in_mix").orderBy("served").collect()
    sent = 0
    for earlier, later in zip(copies, copies[1:]):
        assert earlier["finish"] <= later["finish"]
    for row in copies:
        sent += row["size"]
        assert row["served"] == sent


def test_mixed_documents_have_their_copies(edge):
    wanted = Counter()
    for r in mixing.mix(edge).collect():
        wanted[r["doc_id"], r["size"]] += r["copies"]
    found = Counter((r["doc_id"], len(WORD.findall(r["text"] or ""))) for r in mixing.mixed_documents(edge).collect())
    assert found == Counter({k: n for k, n in wanted.items() if n})
    assert mixing.mixed_documents(edge).columns == edge.columns


def test_rows_alike_but_for_the_source_are_mixed_apart(spark):
    rows = [(i % 9 if i % 3 else None, sentence(i % 9, 8), lang, s) for i in range(45) for lang, s in [("en", "a"), ("de", "a"), ("en", None), ("en", "c"), ("en", "d")]]
    rows += [(100 + i, sentence(i, 30), "en", "b") for i in range(40)]
    frame = documents(spark, rows)
    key = lambda r: (r["doc_id"], r["source"], r["size"])
    mixed = mixing.mixed_documents(frame).collect()
    assert {r["source"] for r in mixed} == {"a", "b", "c", "d", None}
    assert {r["lang"] for r in mixed if r["source"] == "a"} == {"de", "en"}
    held, taken = Counter((i, t, lang, s) for i, t, lang, s in rows), Counter((r["doc_id"], r["text"], r["lang"], r["source"]) for r in mixed)
    assert all(n <= 3 * held[row] for row, n in taken.items())
    copies = Counter(key(r) for r in mixing.mixed_copies(frame).filter("in_mix").collect())
    assert Counter((r["doc_id"], r["source"], len(WORD.findall(r["text"]))) for r in mixed) == copies
    assert mixing.mix(frame).count() == len(rows)


def test_nothing_to_mix(spark, nothing):
    assert mixing.mix(nothing).count() == 0
    assert mixing.mixed_documents(nothing).count() == 0
    bare = documents(spark, [(1, None, "en", "a"), (2, " ", "en", None)])
    assert {r["taken"] for r in mixing.mix(bare).collect()} == {0}
