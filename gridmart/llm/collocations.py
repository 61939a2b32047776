"""Phrase collocations from FM-indexes over word ids, one for each shard of texts.

A shard is a run of texts of one language, its words numbered and its pieces parted by 0. Its index is the
Burrows-Wheeler transform of that sequence and of its reverse, both in the order of as many words of
context as the wanted phrases have, which is all that these need. Every phrase is an interval of rows in both. One
step extends all intervals at once by the words that stand before them (or, in the
reverse transform, behind them): the symbols inside an interval, counted, give the longer phrases, their numbers
and their intervals. Nothing is enumerated that does not occur.

Counts are sums over the shards. A phrase can be frequent only if all its words are, and its beginning and end
of one word less: words that are rare over all shards are one symbol, and phrases of each
length are counted after those one shorter, whose frequent ones reach the tasks as a bitmap of fixed size by hash.
The bitmap only leaves phrases out that cannot be frequent; the fuller it is, the fewer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import map_batches, stored

SHARD_WORDS = 750_000
OUT_ROWS = 200_000
SALTS = 256
BITMAP_BITS = 26
RARE = 1  # the symbol of words that are rare over all shards
UNKNOWN = "und"
_CUT = b"\xff"  # in no UTF-8 text
# Pieces end at . , ; : ! ? and at the line ends 0x0A to 0x0D, words at blanks and tabs; A-Z are lower-cased.
_PLAIN = bytes(
    0xFF if b in b".,;:!?" or 0x0A <= b <= 0x0D else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


class _Vocabulary(dict):
    """Words numbered as they come; 0 is what parts pieces."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def sorted_contexts(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the ``depth`` symbols that start there, the sequence taken as a ring."""
    bits = int(symbols.max()).bit_length() or 1
    if bits * depth <= 63:
        key = symbols.astype(np.int64)
        for k in range(1, depth):
            key = (key << bits) | np.roll(symbols, -k)
        return np.argsort(key, kind="stable")
    order = np.arange(len(symbols))
    for k in range(depth - 1, -1, -1):
        order = order[np.argsort(np.roll(symbols, -k)[order], kind="stable")]
    return order


def transform(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The symbol before each position, in the order of the positions' contexts."""
    return symbols[sorted_contexts(symbols, depth) - 1]


class Extensions(NamedTuple):
    parent: np.ndarray
    symbol: np.ndarray
    start: np.ndarray
    count: np.ndarray
    smaller: np.ndarray


class HalfIndex:
    """One transform with the steps from a row to that of the symbol before it."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self._step = np.empty(len(rows), np.int32)
        self._step[np.argsort(rows, kind="stable")] = np.arange(len(rows), dtype=np.int32)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(rows))])
        self._extended = np.concatenate([[0], np.cumsum(rows != 0)])

    def extended(self, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Occurrences in each interval that have a word, not a piece's end, before them."""
        return self._extended[start + count] - self._extended[start]

    def extend(self, start: np.ndarray, count: np.ndarray) -> Extensions:
        """All extensions of the intervals by the symbol before, in order of interval and symbol.

        ``smaller`` is the number of occurrences whose symbol is smaller: the place of the longer
        phrase's interval inside that of the shorter one in the other transform.
        """
        before = np.cumsum(count) - count
        parent = np.repeat(np.arange(len(start)), count)
        at = np.arange(len(parent)) - before[parent] + start[parent]
        symbol = self.rows[at].astype(np.int64)
        order = np.argsort(parent * (int(self.rows.max()) + 1) + symbol, kind="stable")
        parent, symbol = parent[order], symbol[order]
        new = np.ones(len(order), bool)
        new[1:] = (parent[1:] != parent[:-1]) | (symbol[1:] != symbol[:-1])
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(order)))
        parent = parent[first]
        return Extensions(parent, symbol[first], self._step[at[order[first]]], sizes, first - before[parent])


class Phrases(NamedTuple):
    """Phrases of one length: their symbols, number, and occurrences with a word before and behind."""

    symbols: list[np.ndarray]
    count: np.ndarray
    left: np.ndarray
    right: np.ndarray


class PhraseIndex:
    """Both transforms of a shard."""

    def __init__(self, backward: np.ndarray, forward: np.ndarray):
        self._left, self._right = HalfIndex(backward), HalfIndex(forward)

    def phrases(
        self, depth: int, first_word: int = 1, keeps: Callable[[list[np.ndarray]], np.ndarray] | None = None
    ) -> Iterator[Phrases]:
        """Phrases of 1 to ``depth`` words, of symbols from ``first_word`` on, which ``keeps`` keeps.

        A phrase that is not kept is not extended.
        """
        starts = self._left.starts
        symbol = np.flatnonzero(np.diff(starts) > 0)
        symbol = symbol[symbol >= first_word]
        symbols, left = [symbol], starts[symbol]
        right, count = left, starts[symbol + 1] - left
        for length in range(1, depth + 1):
            yield Phrases(symbols, count, self._left.extended(left, count), self._right.extended(right, count))
            if length == depth:
                return
            # The interval on one side comes from the step, on the other from the place inside the old one.
            at_left = length % 2 == 1
            found = self._left.extend(left, count) if at_left else self._right.extend(right, count)
            found = Extensions(*(part[found.symbol >= first_word] for part in found))
            symbols = [s[found.parent] for s in symbols]
            symbols = [found.symbol, *symbols] if at_left else [*symbols, found.symbol]
            if keeps is not None:
                kept = keeps(symbols)
                found, symbols = Extensions(*(part[kept] for part in found)), [s[kept] for s in symbols]
            parent, _, start, count, smaller = found
            left, right = (start, right[parent] + smaller) if at_left else (left[parent] + smaller, start)


def phrase_places(ids: list[np.ndarray]) -> np.ndarray:
    """The bit of each phrase, by a hash of its word ids."""
    mixed = np.zeros(len(ids[0]), np.uint64)
    for column in ids:
        mixed = (mixed + column.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return (mixed >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _set_bits(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << BITMAP_BITS - 3, np.uint8)
    for batch in batches:
        if batch.num_rows:
            places = phrase_places([batch.column(i).to_numpy() for i in range(length)])
            np.bitwise_or.at(bits, places >> 3, np.uint8(1) << (places & 7).astype(np.uint8))
    packed = bits.view("<i8")
    used = np.flatnonzero(packed)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(packed[used])], ["place", "bits"])


def _bitmap(phrases: DataFrame, length: int) -> np.ndarray:
    """Which bits the phrases have: 1 << BITMAP_BITS bits, whatever their number."""
    ids = phrases.select(*[f"w{k}" for k in range(1, length + 1)])
    found = map_batches(ids, partial(_set_bits, length=length), "place bigint, bits bigint")
    rows = found.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()  # 1 << BITMAP_BITS - 6 rows
    packed = np.zeros(1 << BITMAP_BITS - 6, "<i8")
    packed[rows["place"].to_numpy()] = rows["bits"].to_numpy()
    return packed.view(np.uint8)


def _has_bit(bitmap: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
    places = phrase_places(ids)
    return (bitmap[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def _packed(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values.astype("<i4").tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i4")


class _Shard:
    """The words of one language that a task has met since its last index."""

    def __init__(self):
        self.words = _Vocabulary({_CUT: 0})
        self.parts: list[np.ndarray] = [np.zeros(1, np.int32)]
        self.size = 0

    def add(self, text: str | None) -> int:
        tokens = ((text or "").encode("utf-8").translate(_PLAIN) + _CUT).replace(_CUT, b" \xff ").split()
        part = np.fromiter(map(self.words.__getitem__, tokens), np.int32, len(tokens))
        self.parts.append(part)
        self.size += len(part)
        return len(part)

    def row(self, lang: str) -> pa.RecordBatch:
        symbols = np.concatenate(self.parts)
        counts = np.bincount(symbols, minlength=len(self.words))
        words = [w.decode("utf-8") for w in self.words if w != _CUT]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang], pa.string()),
                pa.array([words], pa.list_(pa.string())),
                pa.array([counts[1:]], pa.list_(pa.int64())),
                pa.array([_packed(symbols)], pa.binary()),
            ],
            ["lang", "words", "counts", "symbols"],
        )


def _collect(batches: Iterator[pa.RecordBatch], shard_words: int) -> Iterator[pa.RecordBatch]:
    shards: dict[str, _Shard] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            shard = shards.setdefault(lang, _Shard())
            held += shard.add(text)
            if held >= 2 * shard_words:
                lang = max(shards, key=lambda name: shards[name].size)
            if shards[lang].size >= shard_words or held >= 2 * shard_words:
                held -= shards[lang].size
                yield shards.pop(lang).row(lang)
    for lang, shard in shards.items():
        yield shard.row(lang)


def build_shards(texts: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """A row for each shard: shard, lang, its words and their counts by number, and the sequence of numbers.

    A shard holds about ``shard_words`` words of one task's texts, and at least one text.
    """
    shards = map_batches(
        texts.select("lang", "text"),
        partial(_collect, shard_words=shard_words),
        "lang string, words array<string>, counts array<bigint>, symbols binary",
    )
    return stored(shards.withColumn("shard", F.monotonically_increasing_id()), "phrase-shards")


def _renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences whose frequent words are numbered by rising id, behind 0 for cuts and 1 for all other words."""
    for batch in batches:
        for i in range(batch.num_rows):
            known = batch.column("known")[i].values
            places, ids = (np.asarray(known.field(k)) for k in ("place", "id"))
            order = np.argsort(ids)
            symbols = _unpacked(batch.column("symbols")[i].as_py())
            numbers = np.full(max(int(symbols.max()), int(places.max())) + 1, RARE, np.int32)
            numbers[0] = 0
            numbers[places[order]] = np.arange(len(order)) + RARE + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[order]], pa.list_(pa.int64())), pa.array([_packed(numbers[symbols])], pa.binary())],
                ["ids", "symbols"],
            )


def _enumerate(batches: Iterator[pa.RecordBatch], length: int, bitmaps: dict[int, Broadcast]) -> Iterator[pa.RecordBatch]:
    """The phrases of ``length`` words of each shard whose parts can all be frequent."""
    names = [f"w{k}" for k in range(1, length + 1)] + ["n", "n_left", "n_right"]
    for batch in batches:
        for i in range(batch.num_rows):
            ids = np.concatenate([np.zeros(RARE + 1, np.int64), np.asarray(batch.column("ids")[i].values)])
            symbols = _unpacked(batch.column("symbols")[i].as_py())

            def keeps(phrase: list[np.ndarray], ids: np.ndarray = ids) -> np.ndarray:
                words = [ids[s] for s in phrase]
                kept = np.ones(len(words[0]), bool)
                if len(words) in bitmaps:
                    kept &= _has_bit(bitmaps[len(words)].value, words)
                if len(words) - 1 in bitmaps:
                    shorter = bitmaps[len(words) - 1].value
                    kept &= _has_bit(shorter, words[1:]) & _has_bit(shorter, words[:-1])
                return kept

            index = PhraseIndex(transform(symbols, length), transform(symbols[::-1], length))
            for found in index.phrases(length, RARE + 1, keeps):
                pass
            for at in range(0, len(found.count), OUT_ROWS):
                cut = slice(at, at + OUT_ROWS)
                columns = [ids[s[cut]] for s in found.symbols] + [v[cut].astype(np.int64) for v in found[1:]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


class PhraseCounts(NamedTuple):
    """Stored tables: all words (lang, word, n), the frequent ones with their id, and frequent phrases by length."""

    words: DataFrame
    known: DataFrame
    phrases: dict[int, DataFrame]


def _numbered(words: DataFrame, least: int) -> DataFrame:
    """Words with n >= ``least`` and dense ids: small numbers take little room in a shuffle."""
    known = stored(
        words.filter(F.col("n") >= least).withColumns(
            {"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()}
        ),
        "phrase-words",
    )
    parts = known.groupBy("part").agg(F.count("*").alias("size"), F.min("row").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    parts = parts.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first"))
    return known.join(parts.select("part", "base"), "part").select(
        "lang", "word", "n", (F.col("row") + F.col("base")).alias("id")
    )


def count_phrases(
    documents: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    depth: int = 3,
    least: int = 10,
    shard_words: int = SHARD_WORDS,
) -> PhraseCounts:
    """Phrases of 2 to ``depth`` words that occur at least ``least`` times in texts of one language.

    They have the word ids w1, w2, ..., n, n_left and n_right (occurrences with a further word
    before and behind them in the piece). Null languages are ``und``.
    """
    spark = documents.sparkSession
    texts = documents.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_column).alias("text")
    )
    shards = build_shards(texts, shard_words)
    local = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "of"))
    local = local.select("shard", "lang", (F.col("place") + 1).alias("place"), F.col("of.words").alias("word"), "of.counts")
    words = stored(local.groupBy("lang", "word").agg(F.sum("counts").alias("n")), "phrase-all-words")
    known = stored(_numbered(words, least), "phrase-known-words")

    met = local.select("shard", "lang", "word", "place").join(known.select("lang", "word", "id"), ["lang", "word"])
    met = met.groupBy("shard").agg(F.collect_list(F.struct("place", "id")).alias("known"))
    wanted = shards.select("shard", "symbols").join(met, "shard").select("known", "symbols")
    sequences = stored(map_batches(wanted, _renumber, "ids array<bigint>, symbols binary"), "phrase-sequences")

    phrases: dict[int, DataFrame] = {}
    bitmaps: dict[int, Broadcast] = {}
    for length in range(2, depth + 1):
        ids = [f"w{k}" for k in range(1, length + 1)]
        schema = ", ".join(f"{c} bigint" for c in [*ids, "n", "n_left", "n_right"])
        found = map_batches(sequences, partial(_enumerate, length=length, bitmaps=dict(bitmaps)), schema)
        # Each shard has every phrase once, so that nothing is won by adding up before the shuffle.
        sums = found.repartition(*ids).groupBy(*ids).agg(*[F.sum(c).alias(c) for c in ("n", "n_left", "n_right")])
        phrases[length] = stored(sums.filter(F.col("n") >= least), "phrase-counts")
        if length < depth:
            bitmaps[length] = spark.sparkContext.broadcast(_bitmap(phrases[length], length))  # 1 << BITMAP_BITS bits
    return PhraseCounts(words, known, phrases)


def _exact(column: Column) -> Column:
    return column.cast("decimal(19, 0)")


def _score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 a a / (l r)), whose products can pass 64 bits."""
    return F.call_function("div", (_exact(a) * _exact(a)).cast("decimal(31, 0)") * F.lit(1_000_000), _exact(l) * _exact(r))


def _ranked(rows: DataFrame, first: int) -> DataFrame:
    """Of each language the rows that could be among its ``first`` by score and number, ties kept."""
    best = [F.desc("score"), F.desc("a")]
    salt = F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(SALTS))
    split = rows.withColumn("salt", salt).withColumn("place", F.rank().over(Window.partitionBy("lang", "salt").orderBy(*best)))
    split = split.filter(F.col("place") <= first)
    whole = split.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*best)))
    return whole.filter(F.col("place") <= first).drop("salt", "place")


def collocations(
    documents: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    least: int = 10,
    absorbed_percent: int = 50,
    first: int = 2_000,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The ``first`` phrases of 2 to 3 words of each language: lang, rank, phrase, a, l, r, n, score, n_left, n_right.

    a is the phrase's number, l and r those of its two sides at the cut with the lowest score
    floor(1000000 a a / (l r)), n the number of words of the language. Phrases inside a longer candidate that
    occurs at least ``absorbed_percent`` as often are left out. Null texts are empty; null languages are ``und``;
    repeated rows count each time; an empty table gives an empty result; other columns are not read. A language without
    a phrase of ``least`` occurrences has no rows.
    """
    words, known, phrases = count_phrases(documents, text_column, lang_column, 3, least, shard_words)
    totals = words.groupBy("lang").agg(F.sum("n").alias("of"))
    side = lambda name: known.select(F.col("id").alias(f"w{name}"), F.col("n").alias(f"n{name}"))
    pairs, triples = phrases[2], phrases[3]

    part = lambda a, b, name: pairs.select(F.col("w1").alias(a), F.col("w2").alias(b), F.col("n").alias(name))
    cut = triples.join(part("w1", "w2", "n12"), ["w1", "w2"]).join(part("w2", "w3", "n23"), ["w2", "w3"])
    cut = cut.join(side(1), "w1").join(side(3), "w3")
    early, late = _score(F.col("n"), F.col("n1"), F.col("n23")), _score(F.col("n"), F.col("n12"), F.col("n3"))
    columns = ["w1", "w2", "w3", F.col("n").alias("a"), "l", "r", "score", "n_left", "n_right"]
    cut = cut.withColumns({"early": early, "late": late}).withColumns(
        {
            "l": F.when(F.col("early") <= F.col("late"), F.col("n1")).otherwise(F.col("n12")),
            "r": F.when(F.col("early") <= F.col("late"), F.col("n23")).otherwise(F.col("n3")),
            "score": F.least("early", "late"),
        }
    ).select(*columns)

    longer = triples.select("w1", "w2", F.col("n").alias("of")).unionByName(
        triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("n").alias("of"))
    )
    longer = longer.groupBy("w1", "w2").agg(F.max("of").alias("of"))
    free = pairs.join(longer, ["w1", "w2"], "left").filter(
        F.col("of").isNull() | (F.col("of") * 100 < F.col("n") * absorbed_percent)
    )
    free = free.join(side(1), "w1").join(side(2), "w2")
    free = free.withColumns(
        {"w3": F.lit(None).cast("bigint"), "l": F.col("n1"), "r": F.col("n2"), "score": _score(F.col("n"), F.col("n1"), F.col("n2"))}
    ).select(*columns)

    spelt = lambda k: known.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"word{k}"))
    rows = cut.unionByName(free).join(known.select(F.col("id").alias("w1"), "lang"), "w1")
    best = stored(_ranked(rows, first), "phrase-best")
    named = best.join(spelt(1), "w1").join(spelt(2), "w2").join(spelt(3), "w3", "left")
    named = named.withColumn("phrase", F.concat_ws(" ", "word1", "word2", "word3"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    named = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)
    return named.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("of").alias("n"), "score", "n_left", "n_right"
    )
