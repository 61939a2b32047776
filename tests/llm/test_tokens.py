"""Byte-level BPE, token counts and record files against the libraries themselves."""

from __future__ import annotations

import hashlib
import io
import random
import sys
import zlib
from array import array
from collections import Counter

import pyarrow as pa
import pytest
from llm.conftest import edge_rows

from gridmart.llm import byte_pairs, records, token_counts

ODD = list("abcdeéß ñ  \n\t\r.,!'s1239½漢字 　▁😀\x00\x1c\x85") + ["<|endoftext|>", " w", "'s", ", ", "the", "ing"]


def odd_texts(n, seed):
    dice = random.Random(seed)
    return ["".join(dice.choice(ODD) for _ in range(dice.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_pairs.read_ranks(None), special_tokens={}
    )


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_texts_encode_as_the_library_does_and_decode_back(tiktoken_encoding):
    encoder = byte_pairs.TextEncoder()
    for text in odd_texts(3000, 1):
        ids = encoder.encode(text)
        assert list(memoryview(ids).cast("I")) == tiktoken_encoding.encode_ordinary(text)
        assert encoder.decode(ids).decode("utf-8") == text


def test_pieces_encode_as_the_merges_do(tiktoken_encoding):
    encoder = byte_pairs.TextEncoder()._encoder
    dice = random.Random(2)
    for _ in range(3000):
        piece = bytes(dice.choice(b"aeithnsor -'") for _ in range(dice.randint(1, 60)))
        assert encoder.encode(piece) == tiktoken_encoding._encode_single_piece(piece)
    long = b"ab" * 3000 + b"the" * 3000
    assert encoder.encode(long) == tiktoken_encoding._encode_single_piece(long)
    assert encoder.encode(b"") == []


def test_encode_decode_rows(edge, nothing, tiktoken_encoding):
    actual = Counter(tuple(r) for r in byte_pairs.encode_decode(edge).collect())
    expected = Counter()
    for doc_id, text, _, _ in edge_rows():
        ids = array("I", tiktoken_encoding.encode_ordinary(text or "")).tobytes()
        digests = hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
        expected[doc_id, len(ids) // 4, *digests] += 1
    assert actual == expected
    assert byte_pairs.encode_decode(nothing).count() == 0
    kept = byte_pairs.encode_decode(edge, keep=True).filter("doc_id = 8").first()
    assert kept["decoded"].startswith("▁x é") and len(kept["ids"]) == 4 * kept["n_tokens"]


def test_token_counts(edge, nothing):
    model = token_counts._processor(None)
    counted = token_counts.count_tokens(edge, limit=100, table_words=50)
    expected = Counter()
    for doc_id, text, _, _ in edge_rows():
        n = len(model.encode(text)) if text else 0
        expected[doc_id, len((text or "").encode()), n, n > 100] += 1
    assert Counter(tuple(r) for r in counted.collect()) == expected
    assert token_counts.count_tokens(nothing).count() == 0


def test_words_are_counted_as_whole_texts_are():
    from gridmart.llm.words import WordCache

    model = token_counts._processor(None)
    cache = WordCache(lambda word: len(model.encode(word)), "", limit=2_000)
    split = 0
    for text in odd_texts(3000, 3):
        values = cache.values(text) if text else [0]
        if values is not None:
            split += 1
            assert sum(values) == len(model.encode(text)), text
    assert split > 500


def test_frequent_words_come_from_all_texts(edge):
    words = token_counts.frequent_words(edge.select("text"), 5)
    counts = Counter(w for _, t, _, _ in edge_rows() for w in (t or "").split(" ") if w)
    assert set(words) <= {w for w, n in counts.items() if n >= sorted(counts.values())[-8]}


def test_record_files_round_trip(spark, edge, nothing, tokenizer, tmp_path):
    manifest = records.write_records(edge, str(tmp_path))
    rows = records.read_records(manifest, with_ids=True).collect()
    start = 0
    by_id = sorted(edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(rows) == len(by_id)
    expected = Counter()
    for doc_id, text, _, _ in by_id:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        expected[doc_id, len(ids), zlib.crc32(array("I", ids).tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == expected
    for row in sorted(rows, key=lambda r: r["start"]):
        assert row["start"] == start
        start += row["n_tokens"]
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert order == [r[0] for r in by_id]
    assert records.read_records(records.write_records(nothing, str(tmp_path / "none"))).count() == 0


def test_the_index_finds_any_record(edge, tmp_path):
    file = records.write_records(edge, str(tmp_path)).first()["file"]
    index = records.read_index(file.removesuffix(".records") + ".index")
    for offset, n_ids in reversed(index):
        assert len(records.read_record(file, offset).ids) == n_ids


def test_ids_of_words_and_marks_are_those_of_whole_texts(tokenizer):
    encoder = records.IdEncoder(None)
    for text in odd_texts(3000, 5):
        assert list(array("H", encoder.encode(text))) == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_a_batch_are_those_of_its_texts(tokenizer):
    encoder = records.IdEncoder(None)
    texts = ["", " ", "naïve co-op, Straße's don't. İx ªb ×y word<|endoftext|>, end", "a" * 300, "x\t y", "the  the", *odd_texts(500, 6)]
    expected = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert [list(array("H", ids)) for ids in encoder.encode_all(pa.array(["cut off", *texts]).slice(1))] == expected
    assert encoder.encode_all([]) == []


def test_no_python_step_for_each_word_of_a_batch():
    encoder = records.IdEncoder(None)
    encoder.encode("the first, of marks")
    steps = []
    for n in (100, 5_000):
        text = " ".join("".join(chr(97 + int(d)) for d in str(i)) + "," * (i % 2) for i in range(n))
        calls = []
        sys.setprofile(lambda frame, event, arg, calls=calls: calls.append(event))
        try:
            encoder.encode_all([text] * 3)
        finally:
            sys.setprofile(None)
        steps.append(len(calls))
    assert steps[1] < steps[0] + 100


@pytest.mark.parametrize("at", [0, 9, 14, 30, -1])
def test_damage_is_noticed(at):
    data = bytearray(records.frame(7, array("H", range(20)).tobytes(), 2))
    assert records.read_frame(io.BytesIO(bytes(data))).doc_id == 7
    data[at] ^= 1
    with pytest.raises(ValueError):
        records.read_frame(io.BytesIO(bytes(data)))
    with pytest.raises(ValueError):
        records.read_frame(io.BytesIO(bytes(data[:-6])))
