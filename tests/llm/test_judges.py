"""Language, quality rules, weak labels and the pipeline."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pytest
from llm.conftest import documents, edge_rows, sentence

import __spark_entry__ as contract
import corpus_pipeline
from gridmart.llm import jaccard, language_id, quality_rules, weak_labels
from gridmart.llm.common import read_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_language_rows(edge, nothing):
    rows = language_id.identify(edge).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, *_ in edge_rows())
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert r["lang_pred"] in ("en", "de", "xx", "und")
    blank = {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 6)}
    assert blank == {1: "und", 2: "und", 3: "und", 6: "und"}
    held = {r["doc_id"]: r["held_out"] for r in rows}
    import zlib

    assert all(held[i] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in edge_rows() if i is not None)
    assert held[None] is False
    assert language_id.identify(nothing).count() == 0


def test_held_out_accuracy(spark, sf_dir):
    docs = read_documents(spark, sf_dir)
    held = language_id.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.96 * len(held)
    assert sum(r["rejected"] for r in held) <= 0.03 * len(held)


def test_predictions_ignore_the_label_and_the_id(spark):
    texts = [sentence(i, 40, "de" if i % 2 else "en") for i in range(60)]
    rows = [(i, t, "de" if i % 2 else "en", "a") for i, t in enumerate(texts)]
    dictionaries = language_id.train_dictionaries(documents(spark, rows))
    judge = language_id.Classifier(dictionaries)
    swapped = [(1000 - i, t, None, "b") for i, t, *_ in rows]
    found = language_id.identify(documents(spark, swapped), dictionaries=dictionaries).collect()
    assert {(r["doc_id"], r["lang_pred"]) for r in found} == {(1000 - i, judge.classify(t)[0]) for i, t, *_ in rows}
    assert language_id.Classifier({}).classify("text") == ("und", 0.0, True)


def test_dictionaries_learn_from_all_sampled_texts_alike(spark):
    rows = [(i, f"word{i}x " + sentence(i, 100 if i % 2 else 5), "en", "a") for i in range(300)]
    rows += [(1000 + i, f"long{i}x " * 40_000, "en", "a") for i in range(8)]
    rows += [(2000, "hot " * 500, "en", "a")] * 300 + [(None, "null " * 500, "en", "a")] * 300
    content = language_id.train_dictionaries(documents(spark, rows))["en"]
    learnt = [i for i, *_ in rows[:300] if zlib.crc32(str(i).encode()) % 5]
    assert all(b"word%dx " % i in content for i in learnt)
    assert 100_000 < len(content) <= 128_000
    assert content.count(b"hot ") <= 500 and content.count(b"null ") <= 500
    assert content.count(b"long") * 7 <= 110_000


def test_short_texts_are_told_apart():
    texts = {lang: "\n".join(sentence(i, 40, lang) for i in range(200)).encode() for lang in ("de", "en")}
    judge = language_id.Classifier(texts)
    for text, lang in [("Thing shed.", "en"), ("Under ich.", "de"), ("Whing", "en"), ("Keit", "de")]:
        assert judge.classify(text)[::2] == (lang, False)
    assert judge.classify("漢字")[::2] == ("de", True)


def counts_of(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
    )


def test_counts(edge, spark):
    more = [(i, t, "en", "a") for i, t in enumerate(["a b c d e a b c d e", "x " * 9, "a b c d e f a b c d e g\n" * 2, "| # <>", "l\nl\n \nl"])]
    for rows in (edge_rows(), more):
        frame = edge if rows is not more else documents(spark, more)
        measured = quality_rules.measure(frame).collect()
        names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        assert Counter(tuple(r[n] for n in names) for r in measured) == Counter((i, *counts_of(t)) for i, t, *_ in rows)


def test_base_and_missing_labels(edge, nothing, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    for r in quality_rules.apply_rules(edge, none).collect():
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed)
    assert quality_rules.apply_rules(nothing, none).count() == 0
    assert quality_rules.kept_documents(nothing, none).count() == 0


def test_rules_reject_what_labels_call_bad(spark):
    rows, labels = [], []
    for i in range(4000):
        bad = i % 4 == 0
        text = sentence(i % 300, 20)
        rows.append((i, text.replace(" ", "### ") if bad else text, "en", "a"))
        labels.append((i, 0 if bad else 1))
    labels += [(0, 0), (None, 1), (5, 7)]
    frame = documents(spark, rows)
    ruled = quality_rules.apply_rules(frame, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    assert all(r["kept"] == (r["doc_id"] % 4 != 0) for r in ruled)
    assert {tuple(r["rejected_by"]) for r in ruled if not r["kept"]} == {("symbols",)}
    kept = quality_rules.kept_documents(frame, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert {r["doc_id"] for r in kept.collect()} == {i for i in range(4000) if i % 4}
    assert kept.columns == frame.columns


def test_texts_are_measured_once_and_never_shuffled(spark, edge, monkeypatch):
    written = []
    store = quality_rules.stored
    monkeypatch.setattr(quality_rules, "stored", lambda frame, name: (written.append(frame), store(frame, name))[1])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id bigint, quality int")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(name, None) for name in names]
    try:
        for name in names:
            spark.conf.set(name, "-1")
        kept = quality_rules.kept_documents(edge, labels)
        assert len(written) == 1
        for frame in (*written, kept):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" not in re.sub(r"(?s)InMemoryRelation.*", "", plan)
        rows = Counter(r["doc_id"] for r in kept.collect())
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert rows == Counter(r["doc_id"] for r in quality_rules.apply_rules(edge, labels).collect() if r["kept"])


def test_binomial_tail_is_exact():
    for k, n, p in [(0, 10, 0.1), (3, 20, 0.2), (20, 20, 0.5), (7, 50, 0.05)]:
        plain = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality_rules.binomial_tail(k, n, p) == pytest.approx(plain)


def test_cutoffs_need_evidence_and_a_gain():
    last = len(quality_rules.GRID)
    row = lambda n_good, n_bad, bucket: ("en", "symbols", bucket, n_good, n_bad)
    assert quality_rules.choose_cutoffs([row(50, 0, 0), row(0, 50, last)]) == {}  # too few to be sure
    assert quality_rules.choose_cutoffs([row(5000, 0, 0), row(0, 500, last)]) == {("en", "symbols"): quality_rules.GRID[-1]}
    assert quality_rules.choose_cutoffs([row(5000, 0, 0), row(900, 500, last)]) == {}  # too many good ones above
    assert quality_rules.choose_cutoffs([row(5000, 10, 0)]) == {}  # nothing to gain
    found = quality_rules.choose_cutoffs([row(5000, 0, 0), row(2, 300, 6), row(0, 100, last)])
    assert found == {("en", "symbols"): quality_rules.GRID[5]}


def test_weak_labels(edge, nothing):
    rows = weak_labels.classify(edge).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, *_ in edge_rows())
    for r in rows:
        assert 0 <= r["score"] <= 1 and 0 <= r["posterior"] <= 1
        assert r["n_votes"] == len(r["votes"].replace("-", ""))
        assert r["good"] == (r["score"] + r["posterior"] >= 1)
    assert weak_labels.classify(nothing).count() == 0


def test_estimation_finds_the_accuracies():
    import numpy as np

    dice = np.random.default_rng(1)
    right = [0.9, 0.8, 0.7, 0.95]
    patterns = Counter()
    for good in dice.random(20_000) < 0.6:
        patterns["".join(str(int(good == (dice.random() < a))) for a in right)] += 1
    posterior, prior, accuracy = weak_labels.estimate(patterns)
    assert prior == pytest.approx(0.6, abs=0.05)
    assert accuracy == pytest.approx(right, abs=0.05)
    assert posterior["1111"] > 0.95 > 0.05 > posterior["0000"]


def test_accuracy_on_labelled_documents(spark, sf_dir):
    docs = read_documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = weak_labels.classify(docs).join(labels, "doc_id").collect()
    clean, junk = [r for r in rows if r["quality"]], [r for r in rows if not r["quality"]]
    assert sum(r["good"] for r in clean) >= 0.95 * len(clean)
    assert sum(not r["good"] for r in junk) >= 0.8 * len(junk)


def test_every_dealt_query_is_registered():
    names = set(contract.queries())
    assert {f"op{n}_" for n in range(1, 11)} == {n[: n.index("_") + 1] for n in names if re.match(r"op\d+_", n)}
    assert "pipeline" in names


def test_pipeline_stages(spark, edge, sf_dir, tmp_path):
    docs = edge
    kept_columns = edge.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "language_id":
            clear = {r["doc_id"] for r in language_id.identify(docs).collect() if not r["rejected"]}
            assert {r["doc_id"] for r in after.collect()} == clear
        elif name == "ngram_jaccard":
            homes = {r["component_id"] for r in jaccard.similarity_classes(docs).collect()}
            assert {r["doc_id"] for r in after.collect()} == homes
        if name != "byte_level_bpe":
            assert after.columns == kept_columns
        else:
            assert after.count() == docs.count()
        docs = after
    assert docs.count() > 0
