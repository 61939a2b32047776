"""License scans: an exact set-similarity join of text blocks with license templates.

A template is a short run of words. Its blocks of a text are the windows of twice its length
that start at every multiple of its length, so that each run of as many words as the template has
lies whole in a block. A block matches when it holds at least ``percent`` of the template's
distinct words; a phrase is a template that has to be held whole, with its words one after the other.

Words are ordered by rising count over the whole corpus. A template of m words of which ``least`` are
wanted is indexed by its first m - least + 1 words in that order (prefix). A block that meets
such a word is dropped if it has fewer than ``least`` words of templates (length), if none of its own first
words is among the template's first (prefix), or if too few words follow the first common one on
either side (position). What remains is compared in full, so that no match is lost.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import id_and_text, map_batches, worker_state

PERCENT = 90
# The index is broadcast: this bounds it, and it holds templates alone, whatever the corpus.
MOST_TEMPLATE_WORDS = 1_000_000


class Template(NamedTuple):
    label: str
    text: str
    is_phrase: bool = False


# The phrases and labels of the base.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)

# The notices that public licenses ask to be put into a work.
NOTICES = (
    Template("apache", "Licensed under the Apache License, Version 2.0."),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    Template(
        "agpl",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template(
        "cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    Template(
        "cc0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work.",
    ),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3."),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted",
    ),
    Template(
        "lgpl",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ),
    Template("mit", "Released under the MIT License."),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction",
    ),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("unlicense", "This is free and unencumbered software released into the public domain."),
)

# Words are runs of ASCII letters and digits and of all other characters than ASCII; A-Z are lower-cased.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_PLAIN).split()


def least_shared(size: int, percent: int, is_phrase: bool) -> int:
    """Distinct words of a template of ``size`` that a matching block has at least."""
    return size if is_phrase else max(1, (percent * size + 99) // 100)


class Match(NamedTuple):
    template: int
    first_word: int
    shared: int


class TemplateIndex:
    """Templates by the first of their words in the order of the corpus."""

    def __init__(self, templates: Sequence[Template], counts: dict[bytes, int], percent: int = PERCENT):
        self._words = [words_of(t.text) for t in templates]
        vocabulary = {w for words in self._words for w in words}
        self._rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
        self._is_phrase = [t.is_phrase for t in templates]
        self._ranks = [sorted({self._rank[w] for w in words}) for words in self._words]
        self._least = [
            least_shared(len(r), percent, phrase) for r, phrase in zip(self._ranks, self._is_phrase, strict=True)
        ]
        self._places = [{r: p for p, r in enumerate(ranks)} for ranks in self._ranks]
        self._lists: dict[bytes, list[int]] = {}
        by_rank = {r: w for w, r in self._rank.items()}
        for t, ranks in enumerate(self._ranks):
            for r in ranks[: len(ranks) - self._least[t] + 1]:
                self._lists.setdefault(by_rank[r], []).append(t)
        self._listed = frozenset(self._lists)

    def matches(self, words: list[bytes]) -> list[Match]:
        """Each matching block of each notice and each place of each phrase, once."""
        if self._listed.isdisjoint(words):
            return []
        found: set[Match] = set()
        seen: set[tuple[int, int]] = set()
        for i, word in enumerate(words):
            for t in self._lists.get(word, ()):
                length = len(self._words[t])
                for block in range(max(0, i // length - 1), i // length + 1):
                    if (t, block) not in seen:
                        seen.add((t, block))
                        found.update(self._match(t, words, block * length, (block + 2) * length))
        return sorted(found)

    def _match(self, t: int, words: list[bytes], start: int, end: int) -> Iterator[Match]:
        rank, least, places = self._rank, self._least[t], self._places[t]
        own = sorted({rank[w] for w in words[start:end] if w in rank})
        if len(own) < least:
            return
        first = next((q for q, r in enumerate(own[: len(own) - least + 1]) if r in places), None)
        if first is None or 1 + min(len(places) - places[own[first]], len(own) - first) - 1 < least:
            return
        shared = sum(r in places for r in own)
        if shared < least:
            return
        if not self._is_phrase[t]:
            yield Match(t, start, shared)
            return
        phrase = self._words[t]
        size = len(phrase)
        for i in range(start, min(end, len(words)) - size + 1):
            if words[i : i + size] == phrase:
                yield Match(t, i, shared)

    def size(self, t: int) -> int:
        return len(self._ranks[t])


def _count_words(batches: Iterator[pa.RecordBatch], vocabulary: frozenset[bytes]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update(w for w in words_of(text) if w in vocabulary)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
    )


def word_counts(texts: DataFrame, templates: Sequence[Template]) -> dict[bytes, int]:
    """How often the words of the templates occur in the whole corpus."""
    vocabulary = frozenset(w for t in templates for w in words_of(t.text))
    counted = map_batches(texts.select("text"), partial(_count_words, vocabulary=vocabulary), "word binary, n bigint")
    return {bytes(r["word"]): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


_MATCHES = pa.list_(
    pa.struct(
        [("label", pa.string()), ("is_phrase", pa.bool_()), ("first_word", pa.int64()), ("containment", pa.float64())]
    )
)


def _scan(
    batches: Iterator[pa.RecordBatch], key: tuple, templates: Sequence[Template], shared: Broadcast
) -> Iterator[pa.RecordBatch]:
    index: TemplateIndex = worker_state(key, lambda: shared.value)
    for batch in batches:
        counts, rows = [], []
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            counts.append(len(words))
            rows.append(
                [
                    {
                        "label": templates[m.template].label,
                        "is_phrase": templates[m.template].is_phrase,
                        "first_word": m.first_word,
                        "containment": m.shared / index.size(m.template),
                    }
                    for m in index.matches(words)
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(rows, _MATCHES)],
            ["doc_id", "n_words", "matches"],
        )


def find_licenses(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates: Sequence[Template] = PHRASES + NOTICES,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document: doc_id, n_words and matches, an array of (label, is_phrase, first_word,
    containment): every place of a phrase and every matching block of a notice, words counted from 0.

    A null text counts as an empty one and matches nothing, as do texts without words. Repeated rows and null
    ids stay rows of their own; an empty table gives an empty result; other columns are not read.
    Templates without words are refused, as are more than ``MOST_TEMPLATE_WORDS`` words of templates.
    """
    sizes = [len(words_of(t.text)) for t in templates]
    if not all(sizes) or sum(sizes) > MOST_TEMPLATE_WORDS:
        raise ValueError("templates need words, and too many are not supported")
    if not 0 < percent <= 100:
        raise ValueError("percent must lie in 1..100")
    spark = documents.sparkSession
    texts = id_and_text(documents, id_column, text_column)
    index = TemplateIndex(templates, word_counts(texts, templates), percent)
    shared = spark.sparkContext.broadcast(index)  # words of the templates alone
    key = (spark.sparkContext.applicationId, uuid.uuid4().hex)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    return map_batches(
        texts,
        partial(_scan, key=key, templates=tuple(templates), shared=shared),
        f"doc_id {id_type}, n_words bigint, "
        "matches array<struct<label: string, is_phrase: boolean, first_word: bigint, containment: double>>",
    )


def license_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of found licenses.

    ``n_base`` counts the places of phrases, ``labels`` are those of phrases and notices, ``score`` is the
    largest containment, 0 without a match.
    """
    base = F.filter("matches", lambda m: m["is_phrase"])
    joined = lambda rows: F.array_join(F.array_sort(F.array_distinct(F.transform(rows, lambda m: m["label"]))), ",")
    starts = F.transform("base", lambda m: m["first_word"])
    return found.withColumn("base", base).select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined("base").alias("base_labels"),
        joined("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("score"),
    )
