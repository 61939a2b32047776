"""Alignment of two tokenizers' tokens on the same texts.

Both encode a text whole: A (byte-level BPE) with a space before it, B (pieces) without, as its model adds
one. Their tokens then cover the same bytes. Anchors are the places before which a token of each ends and behind
which both go on with a token that starts with a space; they cut a document into windows of token
ids of both. Windows repeat, so that a window is aligned once for each worker and kept by its ids.

Inside a window the ends that both sides share cut the tokens into groups; the last tokens of a group
are linked. How often two ids are linked over the whole corpus is counted from the pairs of each
document; a table of the most frequent pairs is broadcast, the others find their counts by a join.
"""

from __future__ import annotations

import hashlib
import json
import os
import string
from array import array
from collections.abc import Callable, Iterator
from functools import partial
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import map_batches, stored, worker_state

BYTE_MODEL = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
MARKS = string.punctuation
LAST_PLAIN = "\u0250"  # letters before it are letters to every library
CACHE_BYTES = 110_000_000
ENTRY_BYTES = 200
LONGEST_KEPT = 64
WINDOW_LIMIT = 500_000
TABLE_PAIRS = 200_000
FLUSH_PAIRS = 1_000_000
_LOW = (1 << 32) - 1


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies.

    Fixed by the format: printable Latin-1 characters stand for themselves, the other bytes, in
    order, are the characters from U+0100 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Vocabulary(NamedTuple):
    """A tokenizer's ids with their bytes, and how it encodes many texts."""

    tokens: list[bytes]
    encode: Callable[[list[str]], list[list[int]]]
    parts_marks: bool = False  # never merges letters with the marks behind them
    plain_words: Callable[[str], list[int]] | None = None  # encodes words of letters with a space before each


def token_bytes(tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer."""
    letters = byte_letters()
    tokens = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        tokens[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode("utf-8")
    return tokens


def byte_vocabulary(path: str) -> Vocabulary:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokens = token_bytes(tokenizer)

    def encode(texts: list[str]) -> list[list[int]]:
        coded = tokenizer.encode_batch_fast([" " + text for text in texts], add_special_tokens=False)
        return [c.ids for c in coded]

    return Vocabulary(tokens, encode, True, letter_words(path, tokens))


def letter_words(path: str, tokens: list[bytes]) -> Callable[[str], list[int]] | None:
    """The same merges for words of letters, by a library that is faster at them.

    It takes ids as the order of the merges, so that the file has to number them so; None if it does not.
    """
    import tiktoken

    with open(path, encoding="utf-8") as source:
        spec = json.load(source)
    model = spec["model"]
    if spec.get("normalizer") or model.get("type") != "BPE":
        return None
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    by_order = sorted(model["vocab"], key=model["vocab"].get)
    base = [t for t in by_order if len(t) == 1]
    if len(base) != 256 or by_order[256 : 256 + len(merged)] != merged or by_order[:256] != base:
        return None
    ranks = {tokens[model["vocab"][t]]: model["vocab"][t] for t in by_order[: 256 + len(merged)]}
    return tiktoken.Encoding("words", pat_str=r" ?\p{L}+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def piece_vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(model.piece_size()):
        piece = model.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode("utf-8"))
    return Vocabulary(tokens, lambda texts: model.encode(texts, num_threads=1))


class Window(NamedTuple):
    groups: str
    links: bytes


class _Side:
    """One tokenizer: whole texts to ids, through the encodings of their words.

    Tokens never reach over a space between two other characters than white space, so that a text's ids are
    those of its words behind a space each. The words that a batch of texts has and the cache lacks are encoded
    by one call.
    """

    def __init__(self, vocabulary: Vocabulary):
        self._vocabulary = vocabulary
        self.code = "H" if len(vocabulary.tokens) <= 1 << 16 else "I"
        self.widths = [len(t) for t in vocabulary.tokens]
        self.names = list(map(str, range(len(vocabulary.tokens))))
        self.sizes = np.array(self.widths, np.int64)
        self.spaced = np.array([t[:1] == b" " for t in vocabulary.tokens])
        self._words: dict[str, bytes | None] = {}
        self._held = 0

    def _ids(self, texts: list[str]) -> list[bytes | None]:
        """The ids of each text, None where their bytes are not those of a space and the text."""
        token, code = self._vocabulary.tokens.__getitem__, self.code
        coded = self._vocabulary.encode(texts)
        wanted = [f" {text}".encode() for text in texts]
        # Mostly all are right, which one comparison tells.
        if b"".join(map(token, chain.from_iterable(coded))) == b"".join(wanted):
            return [array(code, ids).tobytes() for ids in coded]
        given = (b"".join(map(token, ids)) for ids in coded)
        return [
            array(code, ids).tobytes() if own == bytes_ else None
            for ids, own, bytes_ in zip(coded, given, wanted, strict=True)
        ]

    def learn(self, words: set[str]) -> None:
        if self._held > CACHE_BYTES:
            self._words, self._held = {}, 0
        known = self._words
        fresh = [word for word in words if word not in known]
        if not self._vocabulary.parts_marks:
            known.update(zip(fresh, self._ids(fresh), strict=True))
        else:
            # Marks behind a letter are a piece of their own: the word before them is often known.
            bodies = {w: w.rstrip(MARKS) for w in fresh if w[-1] in MARKS and w[0].isalpha()}
            bodies = {w: body for w, body in bodies.items() if body[-1].isalpha() and "<" not in w}
            whole = {w for w in fresh if w not in bodies} | {body for body in bodies.values() if body not in known}
            letters = [w for w in whole if self._vocabulary.plain_words and w.isalpha() and max(w) < LAST_PLAIN]
            known.update(zip(letters, self._ids_of_letters(letters), strict=True))
            others = list(whole.difference(letters))
            known.update(zip(others, self._ids(others), strict=True))
            marks = {w[len(body) :] for w, body in bodies.items()}
            marked = dict(zip(marks, map(self._marks, marks), strict=True))
            for w, body in bodies.items():
                known[w] = None if known[body] is None else known[body] + marked[w[len(body) :]]
        self._held += sum(map(len, fresh)) + ENTRY_BYTES * len(fresh)

    def _ids_of_letters(self, words: list[str]) -> list[bytes]:
        """The ids of words of letters alone: they start at the tokens with a space, and no other has one."""
        if not words:
            return []
        joined = " " + " ".join(words)
        ids = np.array(self._vocabulary.plain_words(joined), self.code)
        if int(self.sizes[ids].sum()) != len(joined.encode("utf-8")):
            raise ValueError("the vocabulary lacks a byte")
        data, starts = ids.tobytes(), np.flatnonzero(self.spaced[ids]) * ids.itemsize
        ends = [*starts[1:].tolist(), len(data)]
        return [data[i:j] for i, j in zip(starts.tolist(), ends, strict=True)]

    def _marks(self, marks: str) -> bytes:
        """Ids of marks alone, as they are behind a letter."""
        ids = self._vocabulary.encode(["x" + marks])[0]
        return array(self.code, ids[1:]).tobytes()

    def encode(self, text: str) -> bytes | None:
        """The ids of a whole text, None if they do not give it back."""
        return self._ids([text])[0]

    def of_words(self, words: list[str]) -> list[bytes | None]:
        """The ids of each word that was learnt."""
        return [*map(self._words.__getitem__, words)]


def apart(text: str) -> list[str] | None:
    """The words of a text, or None where white space adjoins a space, or where a space's sign stands."""
    words = text.split(" ")
    for word in words:
        if not word or word[0].isspace() or word[-1].isspace():
            return None
    return None if "▁" in text else words


class Aligner:
    """Aligns texts; windows are kept by their ids."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self._a, self._b = _Side(a), _Side(b)
        self._windows: dict[tuple[bytes, bytes], Window] = {}

    def _window(self, key: tuple[bytes, bytes]) -> Window:
        a, b = array(self._a.code, key[0]), iter(array(self._b.code, key[1]))
        widths_a, widths_b, names_a, names_b = self._a.widths, self._b.widths, self._a.names, self._b.names
        groups, links, own_a, own_b, end_a, end_b, other = [], [], "", "", 0, 0, 0
        for last in a:
            end_a += widths_a[last]
            own_a = f"{own_a},{names_a[last]}" if own_a else names_a[last]
            while end_b < end_a:
                other = next(b)
                end_b += widths_b[other]
                own_b = f"{own_b},{names_b[other]}" if own_b else names_b[other]
            if end_a == end_b:
                groups.append(f"{own_a}|{own_b}")
                links.append(last << 32 | other)
                own_a = own_b = ""
        return Window(";".join(groups), array("q", links).tobytes())

    def _kept(self, key: tuple[bytes, bytes]) -> Window:
        found = self._windows.get(key)
        if found is None:
            found = self._window(key)
            if len(key[0]) + len(key[1]) <= LONGEST_KEPT:
                if len(self._windows) >= WINDOW_LIMIT:
                    self._windows = {}
                self._windows[key] = found
        return found

    def windows(self, ids_a: bytes, ids_b: bytes) -> list[tuple[bytes, bytes]]:
        """The ids of both sides between anchors, as bytes.

        For a text taken apart these are the ids of its words: both sides' start with the space before the
        word, hold no other, and were found to cover the same bytes.
        """
        side_a, side_b = self._a, self._b
        a, b = np.frombuffer(ids_a, side_a.code), np.frombuffer(ids_b, side_b.code)
        start_a, start_b = (np.cumsum(side.sizes[ids]) - side.sizes[ids] for side, ids in ((side_a, a), (side_b, b)))
        marked_a, marked_b = np.flatnonzero(side_a.spaced[a]), np.flatnonzero(side_b.spaced[b])
        shared = np.zeros(int(start_a[-1]) + int(side_a.sizes[a[-1]]), np.int8)
        shared[start_a[marked_a]] = 1
        shared[start_b[marked_b]] += 1
        both = shared == 2
        cut_a = (marked_a[both[start_a[marked_a]]] * a.itemsize).tolist()
        cut_b = (marked_b[both[start_b[marked_b]]] * b.itemsize).tolist()
        if not cut_a or cut_a[0] or cut_b[0]:
            cut_a, cut_b = [0, *cut_a], [0, *cut_b]
        ends_a, ends_b = [*cut_a[1:], len(ids_a)], [*cut_b[1:], len(ids_b)]
        return list(
            zip(
                [ids_a[i:j] for i, j in zip(cut_a, ends_a, strict=True)],
                [ids_b[i:j] for i, j in zip(cut_b, ends_b, strict=True)],
                strict=True,
            )
        )

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, int, str, np.ndarray]]:
        """Of each text: tokens of A, tokens of B, the groups as text, and a pair of ids for each link
        (A's in the upper 32 bits). All are empty where a side's tokens do not give the text back.
        """
        split = [apart(text) if text else None for text in texts]
        words = set().union(*filter(None, split))
        self._a.learn(words)
        self._b.learn(words)
        del words
        get, kept = self._windows.get, self._kept
        size_a, size_b = array(self._a.code).itemsize, array(self._b.code).itemsize
        for text, own in zip(texts, split, strict=True):
            if own is None:
                ids_a = [self._a.encode(text) if text else None]
                ids_b = [self._b.encode(text) if ids_a[0] is not None else None]
            else:
                ids_a, ids_b = self._a.of_words(own), self._b.of_words(own)
            if None in ids_a or None in ids_b:
                yield 0, 0, "", np.empty(0, np.int64)
                continue
            keys = self.windows(ids_a[0], ids_b[0]) if own is None else zip(ids_a, ids_b, strict=True)
            found = [get(key) or kept(key) for key in keys]
            links = np.frombuffer(b"".join([w.links for w in found]), np.int64)
            n_a, n_b = sum(map(len, ids_a)) // size_a, sum(map(len, ids_b)) // size_b
            yield n_a, n_b, ";".join([w.groups for w in found]), links


def _paths(byte_path: str | None, piece_path: str | None) -> tuple[str, str]:
    if byte_path is None or piece_path is None:
        import public_tokenizers

        byte_path = byte_path or public_tokenizers.path(BYTE_MODEL)
        piece_path = piece_path or public_tokenizers.path(PIECE_MODEL)
    return byte_path, piece_path


def new_aligner(byte_path: str | None = None, piece_path: str | None = None) -> Aligner:
    byte_path, piece_path = _paths(byte_path, piece_path)
    return Aligner(byte_vocabulary(byte_path), piece_vocabulary(piece_path))


ALIGNED = "n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs binary, times binary"


def _align(
    batches: Iterator[pa.RecordBatch], byte_path: str | None, piece_path: str | None, keep: bool
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        aligner = worker_state(("aligner", byte_path, piece_path), lambda: new_aligner(byte_path, piece_path))
        rows = []
        for n_a, n_b, groups, links in aligner.align(batch.column("text").to_pylist()):
            pairs, times = np.unique(links, return_counts=True)
            digest = hashlib.sha256(groups.encode("ascii")).hexdigest() if groups else ""
            row = (n_a, n_b, len(links), digest, pairs.tobytes(), times.astype(np.uint32).tobytes())
            rows.append((*row, groups) if keep else row)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.string()]
        names = ["n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times", "groups"]
        columns = [pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names) if keep else 6)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names[: len(columns)]])


def aligned_documents(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    byte_path: str | None = None,
    piece_path: str | None = None,
    keep: bool = False,
) -> DataFrame:
    """The stored alignment, a row for each document: row (unique), doc_id, n_a, n_b, n_groups, groups_sha256, its
    different pairs and their times (64- and 32-bit numbers), with ``keep`` also the groups as text.

    Null and empty texts have no tokens, nor have texts that the tokens of a side do not give back; their
    digest is empty. Repeated rows and null ids stay rows of their own; other columns are not read.
    """
    texts = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, {ALIGNED}" + (", groups string" if keep else "")
    run = partial(_align, byte_path=byte_path, piece_path=piece_path, keep=keep)
    return stored(map_batches(texts, run, schema).withColumn("row", F.monotonically_increasing_id()), "aligned")


class _PairSums:
    """Sums of pairs in sorted arrays, added up whenever enough of them wait."""

    def __init__(self):
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def add(self, pairs: np.ndarray, times: np.ndarray) -> None:
        self._waiting.append((pairs, times.astype(np.int64)))
        self._held += len(pairs)
        if self._held >= FLUSH_PAIRS:
            self._waiting = [self.total()]

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        pairs = np.concatenate([p for p, _ in self._waiting] or [np.empty(0, np.int64)])
        times = np.concatenate([t for _, t in self._waiting] or [np.empty(0, np.int64)])
        own, place = np.unique(pairs, return_inverse=True)
        sums = np.zeros(len(own), np.int64)
        np.add.at(sums, place, times)
        self._held = 0
        return own, sums


def _sum_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = _PairSums()
    for batch in batches:
        for pairs, times in zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist(), strict=True):
            sums.add(np.frombuffer(pairs, np.int64), np.frombuffer(times, np.uint32))
    yield pa.RecordBatch.from_arrays([pa.array(column) for column in sums.total()], ["pair", "n"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n and best: how often two ids are linked, and whether no other id of A is linked more often
    with the pair's id of B."""
    counts = map_batches(aligned.select("pairs", "times"), _sum_pairs, "pair bigint, n bigint")
    counts = stored(counts.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    b = F.col("pair").bitwiseAND(F.lit(_LOW))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    joined = counts.withColumn("b", b).join(most, "b")
    return stored(joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-bests")


class _Table(NamedTuple):
    pairs: np.ndarray
    counts: np.ndarray
    best: np.ndarray


def _shared_table(counts: DataFrame, table_pairs: int) -> _Table:
    """The most frequent pairs, ``table_pairs`` of 17 bytes at most."""
    top = counts.orderBy(F.desc("n"), "pair").limit(table_pairs).collect()
    top.sort()
    column = lambda i, kind: np.array([r[i] for r in top], kind)
    return _Table(column(0, np.int64), column(1, np.int64), column(2, np.int64))


def _look_up(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    worker_state("aligned pairs", dict)
    table: _Table = shared.value
    for batch in batches:
        n_best, sums, rest, rest_times = [], [], [], []
        for pairs, times in zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist(), strict=True):
            pairs, times = np.frombuffer(pairs, np.int64), np.frombuffer(times, np.uint32).astype(np.int64)
            if len(table.pairs):
                at = np.minimum(np.searchsorted(table.pairs, pairs), len(table.pairs) - 1)
                known = table.pairs[at] == pairs
            else:
                at, known = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
            at, own = at[known], times[known]
            n_best.append(int(own @ table.best[at]) if len(at) else 0)
            sums.append(int(own @ table.counts[at]) if len(at) else 0)
            rest.append(pairs[~known])
            rest_times.append(times[~known])
        columns = [batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")]
        columns += [pa.array(n_best, pa.int64()), pa.array(sums, pa.int64())]
        columns += [pa.array(v, pa.list_(pa.int64())) for v in (rest, rest_times)]
        names = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_best", "count_sum", "rest", "times"]
        yield pa.RecordBatch.from_arrays(columns, names)


def align(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    byte_path: str | None = None,
    piece_path: str | None = None,
    table_pairs: int = TABLE_PAIRS,
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_links`` is the number of linked token pairs, ``count_sum`` the sum of their counts in the whole corpus,
    ``n_best`` how many of them have their B id's highest count. Rows without tokens have zeros and an
    empty digest (see ``aligned_documents``). An empty table gives an empty result.
    """
    spark: SparkSession = documents.sparkSession
    aligned = aligned_documents(documents, id_column, text_column, byte_path, piece_path)
    counts = pair_counts(aligned)
    shared = spark.sparkContext.broadcast(_shared_table(counts, table_pairs))
    id_type = aligned.schema["doc_id"].dataType.simpleString()
    schema = (
        f"row bigint, doc_id {id_type}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
        "n_best bigint, count_sum bigint, rest array<bigint>, times array<bigint>"
    )
    scored = stored(map_batches(aligned, partial(_look_up, shared=shared), schema), "aligned-counted")

    # Pairs beyond the table are rarer than all inside it: no key of this join is hot.
    rest = scored.filter(F.size("rest") > 0).select("row", F.explode(F.arrays_zip("rest", "times")).alias("of"))
    rest = rest.select("row", F.col("of.rest").alias("pair"), F.col("of.times").alias("times")).join(counts, "pair")
    more = rest.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    done = scored.filter(F.size("rest") == 0)
    open_ = scored.filter(F.size("rest") > 0).join(more, "row").withColumns(
        {"n_best": F.col("n_best") + F.col("more_best"), "count_sum": F.col("count_sum") + F.col("more_sum")}
    )
    columns = ["doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256"]
    return done.select(*columns).unionByName(open_.select(*columns))
