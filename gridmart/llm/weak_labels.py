"""A quality classifier from weak labels.

Heuristic labellers vote good, bad or abstain on every document. Expectation maximisation over
the counts of all vote patterns estimates how often each labeller is right about good and about bad
documents, without any true label. The posterior of a document's pattern is its soft label;
a logistic scorer over hashed character trigrams learns them, so that documents on which the
labellers abstain or err are judged by what they look like.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import WORD, map_batches

TRAINING_ROWS = 16_000
TRAINING_TASKS = 8
HASH_BITS = 15
EPOCHS = 6
RATE = 2.0
ITERATIONS = 200
ABSTAIN, BAD, GOOD = "-", "0", "1"


def _bad(condition: Column) -> Column:
    return F.when(condition, F.lit(BAD)).otherwise(F.lit(ABSTAIN))


def _good(condition: Column) -> Column:
    return F.when(condition, F.lit(GOOD)).otherwise(F.lit(ABSTAIN))


def votes(text: Column) -> Column:
    """The labellers' votes on a text, a character each, as one string.

    Lacking a defect says little, so those that look for one vote bad or abstain; others look for
    signs of prose and vote good or abstain.
    """
    words = F.regexp_count(text, F.lit(WORD))
    letters = F.greatest(F.length(text), F.lit(1))
    symbols = F.regexp_count(text, F.lit("[#*$%&|<>]")) / letters
    capitals = F.regexp_count(text, F.lit(r"\p{Lu}")) / letters
    shouts = F.regexp_count(text, F.lit("!!")) / F.greatest(words, F.lit(1))
    sentences = F.regexp_count(text, F.lit(r"[.?!](?=\s|$)"))
    length = F.length(text) / F.greatest(words, F.lit(1))
    split = F.split(text, " ")
    variety = F.size(F.array_distinct(split)) / F.size(split)
    lines = F.split(text, "\n")
    repeated = 1 - F.size(F.array_distinct(lines)) / F.size(lines)
    enough = words >= 20
    return F.concat(
        _bad(words < 2),
        _bad(symbols > 0.02),
        _bad(capitals > 0.3),
        _bad(shouts > 0.1),
        _bad(enough & (sentences * 80 < words)),
        _bad((length > 16) | (length < 3)),
        _bad(enough & (variety < 0.25)),
        _bad((F.size(lines) >= 4) & (repeated > 0.4)),
        _good((words >= 3) & (sentences * 40 > words) & (sentences <= words / 2) & (symbols < 0.005)),
        _good((capitals < 0.1) & (shouts == 0) & (symbols < 0.005) & (words >= 2)),
        _good((words >= 3) & (variety > 0.4) & (length > 3.5) & (length < 12) & (symbols < 0.005)),
    )


def estimate(patterns: dict[str, int], iterations: int = ITERATIONS) -> tuple[dict[str, float], float, np.ndarray]:
    """Posterior of good by pattern, the share of good documents, and each labeller's accuracy:
    the probability that the class is what it votes, when it votes.

    Each labeller votes good, bad or abstains with probabilities of its own for good and for bad
    documents, independently of the others given the class. The start is the majority of the votes. The
    counts of all documents enter, 3 ** labellers of them at most.
    """
    names = sorted(patterns)
    counts = np.array([patterns[p] for p in names], float)
    table = np.array([[(ABSTAIN, BAD, GOOD).index(v) for v in p] for p in names])
    cast = np.stack([table == outcome for outcome in range(3)], axis=2).astype(float)
    good = 1 / (1 + np.exp(2.0 * cast[:, :, 1].sum(axis=1) - cast[:, :, 2].sum(axis=1)))
    for _ in range(iterations):
        prior = float(np.clip((counts * good).sum() / counts.sum(), 0.01, 0.99))
        logs = []
        for weight in (counts * (1 - good), counts * good):
            rates = (np.einsum("p,plo->lo", weight, cast) + 1) / (weight.sum() + 3)
            logs.append(np.einsum("plo,lo->p", cast, np.log(rates)))
        good = 1 / (1 + np.exp(np.clip(logs[0] - logs[1] + np.log1p(-prior) - np.log(prior), -500, 500)))
    voted = np.einsum("p,plo->lo", counts, cast)[:, 1:]
    agreed = np.stack([(counts * (1 - good)) @ cast[:, :, 1], (counts * good) @ cast[:, :, 2]], axis=1)
    return dict(zip(names, good.tolist(), strict=True)), prior, (agreed.sum(axis=1) + 1) / (voted.sum(axis=1) + 2)


def _trigrams(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character trigrams and their weights, of length one together."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8).astype(np.uint32)
    if len(data) < 3:
        data = np.pad(data, (0, 3 - len(data)))
    keys = (data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA77) + data[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - bits)
    used, counts = np.unique(keys, return_counts=True)
    weights = np.sqrt(counts)
    return used, weights / np.sqrt((weights**2).sum())


def _train(batches: Iterator[pa.RecordBatch], bits: int, epochs: int) -> Iterator[pa.RecordBatch]:
    """Weights learnt from one share of the sample by gradient steps; the last one is the bias."""
    weights = np.zeros((1 << bits) + 1)
    rows = []
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("posterior").to_pylist(), strict=True):
            rows.append((*_trigrams(text, bits), label))
    order = np.random.default_rng(1)
    for epoch in range(epochs):
        step = RATE / (1 + epoch)
        for i in order.permutation(len(rows)):
            used, values, label = rows[i]
            error = label - _sigmoid(weights[used] @ values + weights[-1])
            weights[used] += step * error * values
            weights[-1] += 0.1 * step * error
    yield pa.RecordBatch.from_arrays(
        [pa.array([len(rows)], pa.int64()), pa.array([weights.astype(np.float32).tobytes()], pa.binary())], ["n", "weights"]
    )


def _sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _score(batches: Iterator[pa.RecordBatch], bits: int, shared: Broadcast) -> Iterator[pa.RecordBatch]:
    weights = shared.value
    for batch in batches:
        scores = []
        for text in batch.column("text").to_pylist():
            used, values = _trigrams(text, bits)
            scores.append(float(_sigmoid(weights[used] @ values + weights[-1])))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("votes"), pa.array(scores, pa.float64())], ["doc_id", "votes", "score"]
        )


def classify(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    training_rows: int = TRAINING_ROWS,
    bits: int = HASH_BITS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """One row per document: doc_id, votes, n_votes, posterior (of the votes alone), score (of the
    scorer) and good (the mean of both at least 0.5).

    All documents enter the estimate of the labellers; the scorer learns from about
    ``training_rows`` documents drawn by hash, in a fixed number of shares whose weights are
    averaged. A null text counts as an empty one. Repeated rows and null ids stay rows of their
    own; an empty table gives an empty result; other columns are not read.
    """
    spark = documents.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = documents.select(F.col(id_column).alias("doc_id"), text.alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    patterns = {r["votes"]: r["n"] for r in rows.groupBy(votes(F.col("text")).alias("votes")).agg(F.count("*").alias("n")).collect()}
    total = sum(patterns.values())
    if not total:
        none = "votes string, n_votes int, posterior double, score double, good boolean"
        return spark.createDataFrame([], f"doc_id {id_type}, {none}")
    posterior, _, _ = estimate(patterns)
    known = spark.createDataFrame(sorted(posterior.items()), "votes string, posterior double")

    drawn = F.xxhash64(F.lit("weak"), "doc_id", "text") / F.lit(2.0**64) + 0.5 < training_rows / total
    sample = rows.filter(drawn).select("text", votes(F.col("text")).alias("votes")).join(known, "votes")
    shares = sample.select("text", "posterior").repartition(TRAINING_TASKS)
    learnt = map_batches(shares, partial(_train, bits=bits, epochs=epochs), "n bigint, weights binary").collect()
    weighted = [(r["n"], np.frombuffer(r["weights"], np.float32).astype(float)) for r in learnt if r["n"]]
    weights = sum(n * w for n, w in weighted) / max(1, sum(n for n, _ in weighted)) if weighted else np.zeros((1 << bits) + 1)
    shared = spark.sparkContext.broadcast(weights)  # 8 bytes << bits

    voted = rows.select("doc_id", "text", votes(F.col("text")).alias("votes"))
    scored = map_batches(voted, partial(_score, bits=bits, shared=shared), f"doc_id {id_type}, votes string, score double")
    n_votes = F.length(F.translate("votes", ABSTAIN, ""))
    return scored.join(known, "votes").select(
        "doc_id", "votes", n_votes.alias("n_votes"), "posterior", "score", (F.col("posterior") + F.col("score") >= 1).alias("good")
    )
