"""Token ids in files of length-delimited records, with an index of offsets.

A record file is a run of frames: the payload's length (unsigned 64-bit), the masked checksum
of those 8 bytes (unsigned 32-bit), the payload and its masked checksum, all little-endian. A
payload is the id's flag (1 byte: 0 null, 1 given), the document id (signed 64-bit), the bytes per
token (1 byte: 2 or 4) and the token ids. The index beside it has, for every record, its offset and
number of ids (two unsigned 64-bit numbers), so that a reader can visit records in any order.
"""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmart.llm.alignment import letter_words, token_bytes
from gridmart.llm.common import map_batches, stored, worker_state
from gridmart.session import new_table_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
MASK_DELTA = 0xA282EAD8
FRAME = struct.Struct("<QI")
CHECK = struct.Struct("<I")
HEAD = struct.Struct("<BqB")
ENTRY = struct.Struct("<QQ")
BUFFER_BYTES = 4 << 20
# Letters to every library, as far as LAST_PLAIN, and marks but the one that special tokens start with.
LETTERS = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]"
MARKS = f"[{re.escape(string.punctuation.replace('<', ''))}]"
RESULT_ROWS = 10_000

MANIFEST = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


class Record(NamedTuple):
    doc_id: int | None
    ids: array


def masked(data: bytes) -> int:
    """A checksum that is safe to store beside data that holds checksums itself."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    payload = HEAD.pack(doc_id is not None, doc_id or 0, width) + ids
    length = struct.pack("<Q", len(payload))
    return length + CHECK.pack(masked(length)) + payload + CHECK.pack(masked(payload))


def read_frame(source) -> Record | None:
    """The next record of an open file, or None at its end; broken ones raise ValueError."""
    head = source.read(FRAME.size)
    if not head:
        return None
    if len(head) < FRAME.size:
        raise ValueError("the file ends inside a frame")
    length, check = FRAME.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError("a length fails its checksum")
    payload = source.read(length)
    tail = source.read(CHECK.size)
    if len(payload) < length or len(tail) < CHECK.size:
        raise ValueError("the file ends inside a frame")
    if masked(payload) != CHECK.unpack(tail)[0]:
        raise ValueError("a payload fails its checksum")
    given, doc_id, width = HEAD.unpack_from(payload)
    ids = array("H" if width == 2 else "I")
    ids.frombytes(payload[HEAD.size :])
    return Record(doc_id if given else None, ids)


def read_index(path: str) -> list[tuple[int, int]]:
    """(offset, number of ids) of each record of an index file."""
    filesystem, name = _filesystem(path)
    with filesystem.open_input_stream(name) as source:
        return list(ENTRY.iter_unpack(source.read()))


def read_record(path: str, offset: int) -> Record:
    """One record of a file, by its offset."""
    filesystem, name = _filesystem(path)
    with filesystem.open_input_file(name) as source:
        source.seek(offset)
        return read_frame(source)


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else _as_uri(path))


def _as_uri(path: str) -> str:
    return "file://" + path.removeprefix("file:")


def _joined(words: pa.StringArray) -> str:
    """The words with a space between them."""
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " ")[0].as_py()


class IdEncoder:
    """Texts to token ids with the tokenizers library.

    A batch of texts is cut into words by Arrow; each of its different words is encoded once, plain words of
    letters by the same merges in a library that is faster at them. The ids of the texts are gathered from
    those of their words, without a step in Python for every word.
    """

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        self._tokenizer = Tokenizer.from_file(path)
        tokens = token_bytes(self._tokenizer)
        self.code = "H" if len(tokens) <= 1 << 16 else "I"
        self._spaced = np.array([t[:1] == b" " for t in tokens])
        self._sizes = np.array([len(t) for t in tokens], np.int64)
        self._letters = letter_words(path, tokens)
        self._marks = lru_cache(10_000)(self._whole)

    def _whole(self, text: str) -> bytes:
        return self._all([text])[0]

    def _all(self, texts: list[str]) -> list[bytes]:
        coded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, c.ids).tobytes() for c in coded]

    def _ids(self, texts: list[str]) -> pa.LargeBinaryArray:
        return pa.array(self._all(texts), pa.large_binary())

    def _of_letters(self, words: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of words of letters with a space before each: they start at the tokens with a space."""
        if not len(words):
            return self._ids([])
        joined = " " + _joined(words)
        ids = np.array(self._letters(joined), self.code)
        starts = np.flatnonzero(self._spaced[ids])
        if int(self._sizes[ids].sum()) != len(joined.encode("utf-8")) or len(starts) != len(words):
            raise ValueError("the vocabulary lacks a byte")
        cuts = np.append(starts, len(ids)) * ids.itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(cuts), pa.py_buffer(ids)])

    def _of_words(self, words: pa.StringArray) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
        """Ids of different words, as they are behind a space, where in these each word's are, and whether
        a word can be encoded on its own: not with white space beside the space, nor with "▁"."""
        plain = pc.match_substring_regex(words, f"^{LETTERS}+$") if self._letters else pa.array(np.zeros(len(words), bool))
        marked = pc.match_substring_regex(words, f"^{LETTERS}+{MARKS}+$") if self._letters else plain
        odd = words.filter(pc.invert(pc.or_(plain, marked)))
        # Marks behind a letter are a piece of their own: the word before them is often known.
        behind = words.filter(marked)
        whole = pa.concat_arrays([words.filter(plain), pc.replace_substring_regex(behind, f"{MARKS}+$", "")]).dictionary_encode()
        letters = self._of_letters(whole.dictionary).take(whole.indices)
        n_plain = len(whole) - len(behind)
        tails = pc.replace_substring_regex(behind, f"^{LETTERS}+", "").dictionary_encode()
        tail_ids = pa.array([self._marks(t) for t in tails.dictionary.to_pylist()], pa.large_binary()).take(tails.indices)
        ended = pc.binary_join_element_wise(letters.slice(n_plain), tail_ids, pa.scalar(b"", pa.large_binary()))
        others = _joined(odd).split(" ") if len(odd) else []
        apart = [bool(w) and w == w.strip() and "▁" not in w for w in others]
        other_ids = self._ids([" " + w if own else "" for w, own in zip(others, apart, strict=True)])

        places, alone = np.empty(len(words), np.int64), np.ones(len(words), bool)
        plain, marked = plain.to_numpy(zero_copy_only=False), marked.to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(marked), rest := np.flatnonzero(~(plain | marked))])
        places[order] = np.arange(len(words))
        alone[rest] = apart
        return pa.concat_arrays([letters.slice(0, n_plain), ended, other_ids]), places, alone

    def encode_all(self, texts: list[str] | pa.StringArray) -> list[bytes]:
        """The ids of each text, of which none is null."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return []
        parts = pc.split_pattern(texts, " ")
        ends = parts.offsets.to_numpy().astype(np.int64)
        ends -= ends[0]
        later = np.ones(ends[-1], bool)
        later[ends[:-1]] = False
        flat = parts.flatten()
        coded = flat.filter(pa.array(later)).dictionary_encode()
        word = coded.indices.to_numpy()
        known, places, alone = self._of_words(coded.dictionary)
        firsts = flat.take(pa.array(ends[:-1])).to_pylist()
        # Texts with white space beside a space are encoded whole, and leave nothing to gather.
        separate = np.array([bool(w) and not w[-1].isspace() for w in firsts], bool)
        separate[np.repeat(np.arange(len(texts)), np.diff(ends) - 1)[~alone[word]]] = False
        first = pa.array([w if own else "" for w, own in zip(firsts, separate.tolist(), strict=True)]).dictionary_encode()
        order = np.empty(ends[-1], np.int64)
        order[later] = places[word]
        order[ends[:-1]] = first.indices.to_numpy() + len(known)
        pool = pa.concat_arrays([known, self._ids(first.dictionary.to_pylist())])
        gathered = pool.take(pa.array(order))
        _, offsets, data = gathered.buffers()
        cuts = np.frombuffer(offsets, np.int64, len(gathered) + 1)[ends].tolist()
        data = memoryview(data or b"")
        return [
            bytes(data[i:j]) if own else self._whole(text.as_py())
            for text, own, i, j in zip(texts, separate.tolist(), cuts, cuts[1:], strict=False)
        ]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def _write(
    batches: Iterator[pa.RecordBatch], folder: str, path: str | None, end_id: int
) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    name = f"{folder}/{task.partitionId():06d}-{task.taskAttemptId()}"
    target = index = None
    offset = n_docs = n_ids = 0
    for batch in batches:
        encoder = worker_state(("token ids", path), lambda: IdEncoder(path))
        width = array(encoder.code).itemsize
        end = array(encoder.code, [end_id]).tobytes()
        coded = encoder.encode_all(batch.column("text"))
        for doc_id, own in zip(batch.column("doc_id").to_pylist(), coded, strict=True):
            if target is None:
                filesystem, place = _filesystem(name)
                filesystem.create_dir(os.path.dirname(place), recursive=True)
                target = filesystem.open_output_stream(f"{place}.records", buffer_size=BUFFER_BYTES)
                index = filesystem.open_output_stream(f"{place}.index", buffer_size=BUFFER_BYTES)
            ids = own + end
            data = frame(doc_id, ids, width)
            target.write(data)
            index.write(ENTRY.pack(offset, len(ids) // width))
            offset += len(data)
            n_docs += 1
            n_ids += len(ids) // width
    if target is not None:
        target.close()
        index.close()
        row = {"part": [task.partitionId()], "file": [name + ".records"], "n_docs": [n_docs], "n_ids": [n_ids]}
        yield pa.RecordBatch.from_pydict(row, schema=MANIFEST)


def write_records(
    documents: DataFrame,
    folder: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """Encode all documents into record files under ``folder``, in ascending order of their ids.

    Returns the manifest, a row for each file: part, file, n_docs, n_ids. The files' order is that
    of their parts. Each attempt of a task writes files of its own name and the manifest holds those of the attempts
    that succeeded, so that lost executors leave nothing behind that is read. Null ids come
    first; equal ids follow the hash of their texts. A null text counts as an empty one and,
    like it, has the end id alone. An empty table gives an empty manifest.
    """
    folder = folder if "://" in folder else _as_uri(folder)
    text = F.coalesce(F.col(text_column), F.lit(""))
    ordered = (
        documents.select(
            F.col(id_column).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"),
            F.monotonically_increasing_id().alias("row"),
        )
        .repartitionByRange("doc_id", "tie", "row")
        .sortWithinPartitions("doc_id", "tie", "row")
        .select("doc_id", "text")
    )

    return stored(map_batches(ordered, partial(_write, folder=folder, path=path, end_id=end_id), "part int, file string, n_docs bigint, n_ids bigint"), "records-manifest")


def _batch_of(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 4 + with_ids]
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids]
    columns = zip(*[row[: 4 + with_ids] for row in rows], strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _read(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
            filesystem, name = _filesystem(file)
            rows: list[tuple] = []
            with filesystem.open_input_stream(name, buffer_size=BUFFER_BYTES) as source:
                while (record := read_frame(source)) is not None:
                    ids = np.asarray(record.ids).astype(np.uint32).tobytes()
                    rows.append((record.doc_id, base, len(record.ids), zlib.crc32(ids), ids if with_ids else None))
                    base += len(record.ids)
                    if len(rows) == RESULT_ROWS:
                        yield _batch_of(rows, with_ids)
                        rows = []
            if rows:
                yield _batch_of(rows, with_ids)


def read_records(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per record of the files of a manifest: doc_id, start (ids of all records before it),
    n_tokens, ids_crc32 (of the ids as unsigned 32-bit numbers) and, if asked for, ids."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    n_files = manifest.count()

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    return map_batches(files.repartition(max(1, n_files)), partial(_read, with_ids=with_ids), schema)


def token_records(
    spark: SparkSession, documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Write all documents to new record files in the shared folder and read them back."""
    folder = new_table_path(spark, "records")
    return read_records(write_records(documents, folder, id_column, text_column))
