"""Byte-level BPE encoding and decoding by backtracking over longest matches.

Bytes are mapped to Latin-1 characters, so that one automaton over strings finds every token
at every place of a piece. The encoding of a piece is the only chain of tokens in which each
neighbouring pair is compatible: encoding the two tokens' bytes together gives the same two
tokens back. The encoder takes the longest match, falls back to shorter ones while the pair is
not compatible, and steps back over a place once no token fits behind it. Each place is given
up at most once, so that the work grows with the length of the piece.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame

from gridmart.llm.common import id_and_text, map_batches, worker_state
from gridmart.llm.words import WordCache

RANKS = "byte_bpe_50k.tiktoken"
PAIR_LIMIT = 200_000
PIECE_LIMIT = 100_000
WORD_BYTES = 60_000_000
LONGEST_KEPT = 100


def read_ranks(path: str | None) -> dict[bytes, int]:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(RANKS)
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class BytePairEncoder:
    """Encoder of single pieces; ranks are token ids and the order of the merges."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ids = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.token = {rank: token for token, rank in ranks.items()}
        self.width = {rank: len(token) for token, rank in ranks.items()}
        self._matches = ahocorasick.Automaton()
        for text, rank in self.ids.items():
            self._matches.add_word(text, rank)
        self._matches.make_automaton()
        self.shorter = {rank: self._longest_below(text) for text, rank in self.ids.items()}
        self._parts: dict[int, tuple[int, int]] = {}
        self._merges: dict[tuple[int, int], int] = {}
        self._compatible: dict[tuple[int, int], bool] = {}
        for text, rank in sorted(self.ids.items(), key=lambda x: x[1]):
            if len(text) > 1:
                self._split(text, rank)
        self._compatible = {}

    def _longest_below(self, text: str) -> int:
        """Id of the longest token that starts this one and is shorter, or -1."""
        return next((self.ids[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in self.ids), -1)

    def _split(self, text: str, rank: int) -> None:
        """Record the two earlier tokens whose merge makes this one."""
        for k in range(len(text) - 1, 0, -1):
            left, right = self.ids.get(text[:k], rank), self.ids.get(text[k:], rank)
            if left < rank and right < rank and self._holds(left, right):
                self._parts[rank] = left, right
                self._merges[left, right] = rank
                return

    def _holds(self, left: int, right: int) -> bool:
        """Whether encoding both tokens' bytes together gives these two tokens.

        The tokens at the seam are taken apart, the later merge first (of equal ones, the right
        one, since merges run from the left). If at some step the two at the seam could have
        merged before the one just undone was made, the pair would not have come about.
        """
        parts, merges = self._parts, self._merges
        before = 1 << 60
        while True:
            merged = merges.get((left, right))
            if merged is not None and merged < before:
                return False
            left_made = left if left in parts else -1
            right_made = right if right in parts else -1
            if left_made == right_made == -1:
                return True
            if left_made > right_made:
                before, left = left, parts[left][1]
            else:
                before, right = right + 1, parts[right][0]

    def compatible(self, left: int, right: int) -> bool:
        known = self._compatible.get((left, right))
        if known is None:
            if len(self._compatible) >= PAIR_LIMIT:
                self._compatible = {}
            known = self._compatible[left, right] = self._holds(left, right)
        return known

    def encode(self, piece: bytes) -> list[int]:
        text = piece.decode("latin-1")
        whole = self.ids.get(text)
        if whole is not None:
            return [whole]
        size = len(text)
        width, shorter, compatible = self.width, self.shorter, self.compatible
        given_up = bytearray(size + 1)
        chain: list[int] = []
        at, moved = 0, False
        longest = self._matches.iter_long(text)  # every byte is a token: matches leave no gap
        token = next(longest)[1] if size else -1
        while at < size:
            while token >= 0 and (
                given_up[at + width[token]] or (chain and not compatible(chain[-1], token))
            ):
                token = shorter[token]
                moved = True
            if token >= 0:
                chain.append(token)
                at += width[token]
                if moved and at < size:
                    longest, moved = self._matches.iter_long(text, at), False
                token = next(longest)[1] if at < size else -1
            elif chain:
                given_up[at] = 1
                last = chain.pop()
                at -= width[last]
                token = shorter[last]
                moved = True
            else:
                raise ValueError("a byte of the piece is not in the vocabulary")
        return chain


class TextEncoder:
    """Texts to little-endian 32-bit ids and back, pieces split by the tokenizer's pattern."""

    def __init__(self, path: str | None = None, pattern: str | None = None):
        import regex

        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        self._pieces = regex.compile(pattern)
        self._encoder = BytePairEncoder(read_ranks(path))
        tokens = self._encoder.token
        self._token = [tokens.get(rank, b"") for rank in range(max(tokens) + 1)]
        self._words = WordCache(self._whole, " ", limit=WORD_BYTES)
        self._kept: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        pieces = [text] if text.isalpha() or text[:1] == " " and text[1:].isalpha() else self._pieces.findall(text)
        return b"".join(map(self._piece, pieces))

    def _piece(self, piece: str) -> bytes:
        ids = self._kept.get(piece)
        if ids is None:
            ids = array("I", self._encoder.encode(piece.encode("utf-8"))).tobytes()
            if len(self._kept) >= PIECE_LIMIT:
                self._kept = {}
            if len(piece) <= LONGEST_KEPT:
                self._kept[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        values = self._words.values(text)
        return self._whole(text) if values is None else b"".join(values)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._token.__getitem__, memoryview(ids).cast("I")))


def _encode_batches(
    batches: Iterator[pa.RecordBatch], path: str | None, pattern: str | None, keep: bool
) -> Iterator[pa.RecordBatch]:
    encoder = worker_state(("byte pairs", path, pattern), lambda: TextEncoder(path, pattern))
    for batch in batches:
        counts, id_digests, text_digests, kept_ids, kept_texts = [], [], [], [], []
        for text in batch.column("text").to_pylist():
            ids = encoder.encode(text or "")
            decoded = encoder.decode(ids)
            counts.append(len(ids) // 4)
            id_digests.append(hashlib.sha256(ids).hexdigest())
            text_digests.append(hashlib.sha256(decoded).hexdigest())
            if keep:
                kept_ids.append(ids)
                kept_texts.append(decoded.decode("utf-8"))
        columns = [
            batch.column("doc_id"),
            pa.array(counts, pa.int64()),
            pa.array(id_digests, pa.string()),
            pa.array(text_digests, pa.string()),
        ]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep:
            columns += [pa.array(kept_ids, pa.binary()), pa.array(kept_texts, pa.string())]
            names += ["ids", "decoded"]
        yield pa.RecordBatch.from_arrays(columns, names)


def encode_decode(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    pattern: str | None = None,
    keep: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256; with ``keep`` also the
    ids (binary, little-endian unsigned 32-bit) and the decoded text.

    A null text counts as an empty one: no tokens, the digests of nothing. Repeated rows and null
    ids stay rows of their own; an empty table gives an empty result; other columns are not
    read. Texts in which a space adjoins other white space are split as a whole.
    """
    texts = id_and_text(documents, id_column, text_column)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    run = partial(_encode_batches, path=path, pattern=pattern, keep=keep)
    return map_batches(texts, run, schema + (", ids binary, decoded string" if keep else ""))
