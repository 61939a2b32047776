"""Token counts by two tiers of word lengths.

The counts of a sentencepiece model are wanted for every text. First tier: the most frequent
words of the corpus with their numbers of tokens, a table of at most ``table_words`` words of
``LONGEST_SHARED`` characters, broadcast. Second tier: each worker's cache of the other words
it meets. No word is shuffled but the few most frequent of each task.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import id_and_text, map_batches, worker_state
from gridmart.llm.words import WordCache

MODEL = "piece_bpe_32k.model"
TABLE_WORDS = 20_000
TASK_WORDS = 4_096
COUNTED_WORDS = 300_000
LONGEST_SHARED = 40


def model_path(path: str | None) -> str:
    if path is not None:
        return path
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def _processor(path: str | None):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path(path))


def _lengths(processor, words: list[str]) -> list[int]:
    return [len(ids) for ids in processor.encode(words, num_threads=1)] if words else []


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update((text or "").split(" "))
            if len(counts) > COUNTED_WORDS:
                counts = Counter({w: n for w, n in counts.items() if n > 1})
    top = [(w, n) for w, n in counts.most_common(TASK_WORDS) if n > 1 and 0 < len(w) <= LONGEST_SHARED]
    yield pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["word", "n"]
    )


def _counter(path: str | None, known: dict[str, int]) -> tuple:
    model = _processor(path)
    return model, WordCache(lambda word: len(model.encode(word)), "", known)


def _count_tokens(
    batches: Iterator[pa.RecordBatch], key: tuple, path: str | None, shared: Broadcast
) -> Iterator[pa.RecordBatch]:
    model, cache = worker_state(key, lambda: _counter(path, shared.value))
    for batch in batches:
        counts = []
        for text in batch.column("text").to_pylist():
            if not text:
                counts.append(0)
                continue
            values = cache.values(text)
            counts.append(len(model.encode(text)) if values is None else sum(values))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
            ["doc_id", "n_bytes", "n_tokens"],
        )


def frequent_words(texts: DataFrame, table_words: int = TABLE_WORDS) -> list[str]:
    """The words with the largest counts over all texts, counted inside the tasks.

    A task that meets more than ``COUNTED_WORDS`` different words forgets those seen once; this
    can only change which words are shared, never a count of tokens.
    """

    counted = map_batches(texts.select("text"), _count_words, "word string, n bigint")
    top = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(table_words)
    return [row["word"] for row in top.collect()]


def count_tokens(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 4096,
    path: str | None = None,
    table_words: int = TABLE_WORDS,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``).

    A null text counts as an empty one: 0 bytes, 0 tokens. Repeated rows and null ids stay rows
    of their own; an empty table gives an empty result; other columns are not read. Texts with
    two spaces in a row, or with white space beside a space, go to the model whole.
    """
    spark = documents.sparkSession
    texts = id_and_text(documents, id_column, text_column)
    processor = _processor(path)
    words = [w for w in frequent_words(texts, table_words) if "▁" not in w and not w[0].isspace() and not w[-1].isspace()]
    shared = spark.sparkContext.broadcast(dict(zip(words, _lengths(processor, words), strict=True)))
    key = (spark.sparkContext.applicationId, uuid.uuid4().hex)

    sized = texts.select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
    )
    id_type = texts.schema["doc_id"].dataType.simpleString()
    counted = map_batches(sized, partial(_count_tokens, key=key, path=path, shared=shared), f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
