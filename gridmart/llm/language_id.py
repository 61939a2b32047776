"""Language identification by compression.

Each language has a raw-content dictionary of its own training texts. A text is compressed with
every dictionary, in blocks so that the dictionary and not the text's own beginning explains it;
the language with the smallest total wins. Where the runner-up is nearly as small the text is
rejected. Short texts find no match that saves a byte and are equally large for all: exact ties go to the
language whose dictionary lacks the fewest of the text's pieces of 3 to 5 bytes, if it is clearly the fewest.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import map_batches, worker_state

DICTIONARY_BYTES = 128_000
TRAINING_ROWS = 400
BLOCK_BYTES = 600
LEVEL = 6
MARGIN = 0.01
SHARPNESS = 40.0
PIECES = (3, 4, 5)
UNKNOWN = "und"


def held_out(id_column: Column) -> Column:
    """Documents that are never learnt from: a fifth, by the checksum of the id as text."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train_dictionaries(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    dictionary_bytes: int = DICTIONARY_BYTES,
    rows: int = TRAINING_ROWS,
) -> dict[str, bytes]:
    """A dictionary for each language: equal shares of a bounded random sample of its distinct texts.

    About ``rows`` texts of each language reach the driver, as excerpts at hashed places; a text shorter
    than its share leaves the rest to the others. Rows without a language, without a letter or held out
    are not learnt from, and equal texts are one.
    """
    usable = documents.select(
        F.col(lang_column).alias("lang"),
        F.col(text_column).alias("text"),
        F.xxhash64(F.lit("language"), F.col(text_column)).alias("draw"),
        held_out(F.col(id_column)).alias("held"),
    ).filter(F.col("lang").isNotNull() & ~F.col("held") & F.col("text").rlike(r"\p{L}"))
    distinct = F.approx_count_distinct("draw", 0.02).alias("n")
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(distinct).collect()}
    if not counts:
        return {}
    chance, length = F.lit(0.0), F.lit(0)
    for lang, n in counts.items():
        of_lang = F.col("lang") == lang
        # A sample that is small by chance, or has many short texts, still fills the dictionary.
        share = min(dictionary_bytes, 16 * dictionary_bytes // min(rows, max(1, n)))
        chance = F.when(of_lang, F.lit(1.0 if n <= rows else rows / n)).otherwise(chance)
        length = F.when(of_lang, F.lit(share)).otherwise(length)
    drawn = (F.col("draw") / F.lit(2.0**64) + 0.5) < chance
    spare = F.greatest(F.length("text") - length, F.lit(0))
    place = F.pmod(F.xxhash64(F.lit("place"), "draw"), spare + 1).cast("int") + 1
    sample = usable.filter(drawn).select("lang", "draw", F.substring(F.col("text"), place, length).alias("text"))
    sample = sample.groupBy("lang", "draw").agg(F.min("text").alias("text"))
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in sample.toLocalIterator():
        texts.setdefault(r["lang"], []).append((r["draw"], r["text"]))
    return {lang: _in_shares([_plain(text) for _, text in sorted(texts[lang])], dictionary_bytes) for lang in sorted(texts)}


def _in_shares(contents: list[bytes], total: int) -> bytes:
    """The beginnings of all contents, as long as each other where there is enough, ``total`` bytes at most."""
    left, taken = total, {}
    for place, i in enumerate(sorted(range(len(contents)), key=lambda i: len(contents[i]))):
        taken[i] = (contents[i] + b"\n")[: left // (len(contents) - place)]
        left -= len(taken[i])
    return b"".join(taken[i] for i in range(len(contents)))


def _plain(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def _pieces(content: bytes) -> list[bytes]:
    spaced = b" " + b" ".join(content.split()) + b" "
    return [spaced[i : i + n] for n in PIECES for i in range(len(spaced) - n + 1)]


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], block: int = BLOCK_BYTES, margin: float = MARGIN):
        import zstandard

        self._langs = list(dictionaries)
        self._block = block
        self._margin = margin
        self._known = [frozenset(_pieces(content)) for content in dictionaries.values()]
        self._compressors = []
        for content in dictionaries.values():
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            self._compressors.append(
                zstandard.ZstdCompressor(dict_data=raw, write_checksum=False, write_content_size=False, write_dict_id=False)
            )

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the margin to the runner-up is too narrow."""
        if not text or not self._langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        data = _plain(text)
        blocks = [data[i : i + self._block] for i in range(0, len(data), self._block)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self._compressors]
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], self._langs[i]))
        best = sizes[order[0]]
        score = 1.0 / sum(math.exp(min(0.0, SHARPNESS * (best - s) / best)) for s in sizes)
        narrow = len(order) > 1 and sizes[order[1]] - best < self._margin * sizes[order[1]]
        tied = [i for i in order if sizes[i] == best]
        if len(tied) > 1:
            pieces = _pieces(data)
            lacking = {i: sum(p not in self._known[i] for p in pieces) for i in tied}
            tied.sort(key=lambda i: (lacking[i], self._langs[i]))
            fewest, next_ = lacking[tied[0]], lacking[tied[1]]
            narrow = next_ == fewest or next_ - fewest < self._margin * next_
        return self._langs[tied[0]], score, narrow


def _classify_batches(
    batches: Iterator[pa.RecordBatch], key: tuple, margin: float, shared: Broadcast, passed: list[str]
) -> Iterator[pa.RecordBatch]:
    classifier = worker_state(key, lambda: Classifier(shared.value, margin=margin))
    for batch in batches:
        found = [classifier.classify(text) for text in batch.column("text").to_pylist()]
        columns = [batch.column(c) for c in passed]
        columns += [
            pa.array([lang for lang, _, _ in found], pa.string()),
            pa.array([score for _, score, _ in found], pa.float64()),
            pa.array([narrow for _, _, narrow in found], pa.bool_()),
        ]
        yield pa.RecordBatch.from_arrays(columns, [*passed, "lang_pred", "score", "rejected"])


def identify(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    margin: float = MARGIN,
    keep: tuple[str, ...] = (),
    dictionaries: dict[str, bytes] | None = None,
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score and rejected, after the columns
    named in ``keep`` as __kept_0, __kept_1, ... (whole rows, for filtering).

    Null texts and texts without a letter are ``und`` with score 0, rejected; so is everything if
    no language could be learnt. Ties of the sizes are broken by the pieces of 3 to 5 bytes that a dictionary
    lacks; ties in those too go to the language first by name, and are rejected as narrow. Repeated rows and null ids (never held out) stay rows of their own; an empty table gives
    an empty result.
    """
    if dictionaries is None:
        dictionaries = train_dictionaries(documents, id_column, text_column, lang_column)
    shared = documents.sparkSession.sparkContext.broadcast(dictionaries)  # DICTIONARY_BYTES a language
    key = (documents.sparkSession.sparkContext.applicationId, uuid.uuid4().hex)
    names = [f"__kept_{i}" for i in range(len(keep))]
    texts = documents.select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column).alias("text"),
        held_out(F.col(id_column)).alias("held_out"),
        *[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)],
    )
    passed = ["doc_id", "held_out", *names]

    kinds = {f.name: f.dataType.simpleString() for f in texts.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in passed) + ", lang_pred string, score double, rejected boolean"
    run = partial(_classify_batches, key=key, margin=margin, shared=shared, passed=passed)
    found = map_batches(texts, run, schema)
    return found


def confident_documents(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    margin: float = MARGIN,
) -> DataFrame:
    """The documents whose language is told clearly, with all their columns, whatever these are called."""
    columns = documents.columns
    found = identify(documents, id_column, text_column, lang_column, margin, keep=tuple(columns))
    clear = found.filter(~F.col("rejected"))
    return clear.select(*[F.col(f"__kept_{i}").alias(c) for i, c in enumerate(columns)])
