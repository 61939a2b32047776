"""N-gram Jaccard join: documents whose shingle sets are similar, and the classes they form.

Two sets of sizes n and m with a similarity of at least q percent share a token among the first
``n - ceil(q n / 100) + 1`` of each, in any order common to all. The order here is by rising count
over the whole corpus, from a sketch of fixed size, so that lists of the index stay short.

Skipping in the index. The entries of a token's list are grouped in blocks of sets around one root. A block knows
the range of its sizes and the most tokens that any of its entries has left from its position
on; a set that could not reach the overlap with the best of them skips the block.

Skipping by answers. Of the sets that share lists with a set, the one in most lists leads it to a root, a set
in the middle of many similar ones. Every set is compared in full with its root, and with the
roots of the blocks it does not skip. For sets y, z near a root of P tokens, with D(y) the tokens in
which y differs from it, c(y) = 100 |missing| + q |added| and s the size of D(y) & D(z),

    y and z link  <=>  (100 + q) s >= c(y) + c(z) - (100 - q) P.

So the answers of all sets near a root follow from their small differences to it. Sets with
c(y) <= (100 - q) P link to the root itself; two such sets are in one class already. Only the others
(outliers) are looked up by the difference tokens they share, and as (100 + q) s - c(y) <= 100 s,
an outlier has to share at least (c - (100 - q) P) / 100 of them.

A set that is not near its root is a root of its own; a set is compared with a root of others only
if it can be near one of the root's sets by the triangle inequality of the Jaccard distance.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import map_batches, settled, ship_package, worker_state
from gridmart.llm.components import connected_components

SKETCH_BITS = 23
SKETCH_PARTS = 256
LOG_STEPS = 2_900
NEAR_PERCENT = 50
OUT_ROWS = 50_000
OUTLIER_BLOCK = 2_048
SET_BLOCK = 8_192

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    values = (values + _ODD[seed & 1]) * _ODD[0]
    values = (values ^ (values >> np.uint64(30))) * _ODD[2]
    values = (values ^ (values >> np.uint64(27))) * _ODD[3]
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, words_each: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text.

    A-Z is lower-cased, words end at ASCII white space. A text with fewer words than a shingle
    has one shingle, all of them; a text without words has none.
    """
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    width = min(words_each, len(words))
    count = len(words) - width + 1
    joined = hashes[:count] + np.uint64(width)
    for k in range(1, width):
        joined = _mixed(joined) + hashes[k : k + count]
    return np.unique(_mixed(joined))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _identity(tokens: np.ndarray) -> tuple[int, int]:
    """A 128-bit digest of a set."""
    sums = [_mixed(tokens, seed) for seed in (0, 1)]
    return tuple(int(np.add.reduce(s, dtype=np.uint64).astype(np.int64)) for s in sums)


def _describe(batches: Iterator[pa.RecordBatch], words_each: int) -> Iterator[pa.RecordBatch]:
    """A row for each document with its set's size and identity; then the task's token counts."""
    worker_state("jaccard", dict)
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    for batch in batches:
        sizes, first, second = [], [], []
        for text in batch.column("text").to_pylist():
            tokens = shingle_set(text, words_each)
            np.add.at(counts, (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            a, b = _identity(tokens)
            sizes.append(len(tokens))
            first.append(a)
            second.append(b)
        n = len(sizes)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int32()),
                pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
            ],
            DESCRIBED,
        )
    if counts.any():
        parts = counts.reshape(SKETCH_PARTS, -1)
        used = [i for i in range(SKETCH_PARTS) if parts[i].any()]
        n = len(used)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(n, batch.column("doc_id").type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()),
                pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(used, pa.int32()),
                pa.array([zlib.compress(parts[i].tobytes(), 1) for i in used], pa.binary()),
            ],
            DESCRIBED,
        )


DESCRIBED = ["doc_id", "text_hash", "n", "c1", "c2", "part", "counts"]


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Logarithms of the summed counts of each part, in two bytes: they only order tokens."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, packed in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            counts = np.frombuffer(zlib.decompress(packed), np.uint32).astype(np.int64)
            sums[part] = sums[part] + counts if part in sums else counts
    logs = [np.minimum(np.log1p(counts) * LOG_STEPS, np.iinfo(np.uint16).max).astype(np.uint16) for counts in sums.values()]
    packed = [zlib.compress(part.tobytes(), 1) for part in logs]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], ["part", "logs"])


def _sketch(described: DataFrame) -> np.ndarray:
    """Logarithms of the counts of all tokens of the corpus, by the first bits of their hashes.

    Each part is summed by one task, so that the driver holds two bytes a count and never the counts.
    """
    parts = described.filter(F.col("part").isNotNull()).select("part", "counts").repartition("part")
    logs = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.uint16)
    for row in map_batches(parts, _add_counts, "part int, logs binary").collect():  # 2 bytes << SKETCH_BITS
        logs[row["part"]] = np.frombuffer(zlib.decompress(row["logs"]), np.uint16)
    return logs.ravel()


def _prefixes(
    batches: Iterator[pa.RecordBatch], words_each: int, percent: int, shared: Broadcast
) -> Iterator[pa.RecordBatch]:
    """The index entries of every set: token, half its identity, size and position in the common order.

    Copies of a set have the same entries: a task gives them once, so that a group of copies sends an entry
    a task, however large it is.
    """
    worker_state("jaccard", dict)
    counts = shared.value
    given: set[tuple[int, int]] = set()  # an identity for each distinct set of the task's texts
    shift = np.uint64(64 - SKETCH_BITS)
    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            tokens = shingle_set(text, words_each)
            n = len(tokens)
            identity = _identity(tokens)
            if n == 0 or identity in given:
                continue
            given.add(identity)
            length = n - (percent * n + 99) // 100 + 1
            order = np.argsort(counts[(tokens >> shift).astype(np.int64)], kind="stable")[:length]
            rows.append((_signed(tokens[order]), identity[0], n))
            held += length
            if held >= OUT_ROWS:
                yield _entries(rows)
                rows, held = [], 0
    if rows:
        yield _entries(rows)


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    lengths = [len(tokens) for tokens, *_ in rows]
    spread = lambda values, kind: pa.array(np.repeat(np.array(values, kind), lengths))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([tokens for tokens, *_ in rows])),
            spread([r[1] for r in rows], np.int64), spread([r[2] for r in rows], np.int32),
            pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in lengths])),
        ],
        ["token", "c1", "n", "pos"],
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts: they take less than half of their sets' room, and give the sets again."""
    import zstandard

    worker_state("jaccard", dict)
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [packer.compress(text.encode("utf-8")) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(packed, pa.binary())], ["doc_id", "text_hash", "packed"]
        )


def _unpacked(packed: bytes, words_each: int) -> np.ndarray:
    import zstandard

    return shingle_set(zstandard.decompress(packed).decode("utf-8"), words_each)


def _compare(batches: Iterator[pa.RecordBatch], words_each: int, percent: int, near: int) -> Iterator[pa.RecordBatch]:
    """Differences of a set to a root: root_size, cost and the tokens in which they differ, null where the
    similarity is below ``near`` percent."""
    worker_state("jaccard", dict)
    for batch in batches:
        sizes, costs, differences = [], [], []
        for own, root in zip(batch.column("own").to_pylist(), batch.column("other").to_pylist(), strict=True):
            a, b = _unpacked(own, words_each), _unpacked(root, words_each)
            common = np.intersect1d(a, b, assume_unique=True)
            missing, added = len(b) - len(common), len(a) - len(common)
            sizes.append(len(b))
            costs.append(100 * missing + percent * added)
            if 100 * len(common) < near * (len(a) + len(b) - len(common)):
                differences.append(None)
            else:
                differences.append(_signed(np.setxor1d(a, b, assume_unique=True)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node"), batch.column("root"), pa.array(sizes, pa.int64()), pa.array(costs, pa.int64()),
                pa.array(differences, pa.list_(pa.int64())),
            ],
            ["node", "root", "root_size", "cost", "differs"],
        )


def _compared(pairs: DataFrame, sets: DataFrame, words_each: int, percent: int, near: int) -> DataFrame:
    own = sets.select("node", F.col("packed").alias("own"))
    other = sets.select(F.col("node").alias("root"), F.col("packed").alias("other"))
    both = pairs.select("node", "root").join(own, "node").join(other, "root")
    schema = "node bigint, root bigint, root_size bigint, cost bigint, differs array<bigint>"
    return map_batches(both, partial(_compare, words_each=words_each, percent=percent, near=near), schema)


def _could_link(n: str, rest: Column, least: str, most: str, most_rest: str, percent: int) -> Column:
    """Whether a set could reach the overlap with some set of a block: of sizes from ``least`` to ``most`` and
    with ``most_rest`` tokens at most from their positions on."""
    size, low, high = F.col(n), F.col(least), F.col(most)
    partner = F.greatest(low, F.ceil(size * percent / 100))
    overlap = F.ceil((size + partner) * percent / (100 + percent))
    fits = (high * 100 >= size * percent) & (size * 100 >= low * percent)
    return fits & (F.least(rest, F.col(most_rest)) >= overlap)


def _alive(entries: DataFrame, percent: int) -> DataFrame:
    """The entries that some other set of their list could pair with.

    A list is cut in blocks of similar sizes; partners are in the set's own block or a neighbour.
    """
    step = math.log(100 / percent) * 1.0001 if percent < 100 else 1e-9
    rest = F.col("n") - F.col("pos")
    banded = entries.withColumn("band", F.floor(F.log("n") / step))
    blocks = banded.groupBy("token", F.col("band").alias("near")).agg(
        F.min("c1").alias("first"), F.max("c1").alias("last"),
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(rest).alias("most_rest"),
    )
    probes = banded.withColumn("near", F.explode(F.array(*[F.col("band") + k for k in (-1, 0, 1)])))
    met = probes.join(blocks, ["token", "near"]).filter((F.col("first") != F.col("c1")) | (F.col("last") != F.col("c1")))
    met = met.filter(_could_link("n", rest, "least", "most", "most_rest", percent))
    return met.select("token", "c1", "n", "pos").distinct()


def _sized(pairs: DataFrame, nodes: DataFrame, near: int) -> DataFrame:
    """The pairs whose sizes alone do not rule out a similarity of ``near`` percent."""
    size = lambda name, alias: nodes.select(F.col("node").alias(name), F.col("n").alias(alias))
    sized = pairs.join(size("node", "own_n"), "node").join(size("root", "root_n"), "root")
    fits = F.least("own_n", "root_n") * 100 >= F.greatest("own_n", "root_n") * near
    return sized.filter(fits).select("node", "root")


def _roots(entries: DataFrame) -> DataFrame:
    """(node, root): from each set to the leader that it meets most often, and on from there.

    The leader of a list is the one whose own lists hold most sets together, so that no chain comes back: in a group of
    near copies, where all have equally many lists, that is a copy without rare changes.
    """
    sizes = entries.groupBy("token").agg(F.count("*").alias("held"))
    weights = entries.join(sizes, "token").groupBy("node").agg(F.sum("held").alias("weight"))
    ranked = entries.join(weights, "node")
    leaders = ranked.groupBy("token").agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("leader"))
    met = entries.select("token", "node").join(leaders, "token").groupBy("node", "leader").agg(F.count("*").alias("times"))
    best = met.groupBy("node").agg(F.max(F.struct("times", "leader")).alias("best"))
    roots = settled(best.select("node", (-F.col("best.leader.minus")).alias("root")), "jaccard-roots")
    while True:
        onward = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = roots.join(onward, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
        moved = settled(moved, "jaccard-roots")
        roots = moved.select("node", "root")
        if moved.filter("moved").isEmpty():
            return roots


def _held(roots: DataFrame) -> DataFrame:
    """Roots with their label, and how many sets each has."""
    return roots.join(roots.groupBy("root").agg(F.count("*").alias("held")), "root")


def _larger(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root): two other groups at most that a set could belong to as well. Of the largest groups in its lists
    these are the one met most often and the largest one."""
    rooted = entries.select("token", "node").join(_held(roots), "node")
    largest = rooted.groupBy("token").agg(F.max(F.struct("held", (-F.col("root")).alias("minus"))).alias("largest"))
    met = rooted.join(largest, "token").groupBy("node", "root", "largest").agg(F.count("*").alias("times"))
    met = met.groupBy("node", "root").agg(F.max(F.struct("times", "largest")).alias("often"), F.max("largest").alias("largest"))
    groups = F.explode(F.array_distinct(F.array(-F.col("often.largest.minus"), -F.col("largest.minus"))))
    return met.select("node", F.col("root").alias("own"), groups.alias("root")).filter("root != own").select("node", "root")


def _gathered(own: DataFrame, roots: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``own`` and ``roots`` after each set has moved to the largest group among those whose root is near it."""
    sizes = roots.groupBy("root").agg(F.count("*").alias("held"))
    row = F.struct(*own.columns)
    moved = others.join(sizes, "root").groupBy("node").agg(F.max_by(row, F.struct("held", -F.col("root"))).alias("row"))
    moved = settled(moved.select("row.*"), "jaccard-moved")
    own = own.join(moved.select("node"), "node", "left_anti").select(*moved.columns).unionByName(moved)
    onward = moved.select("node", F.col("root").alias("next"))
    roots = roots.join(onward, "node", "left").select("node", F.coalesce("next", "root").alias("root"))
    return settled(own, "jaccard-own"), settled(roots, "jaccard-roots")


def _guests(entries: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the sets that may link to a set around another root, one of more sets.

    Sets of the smaller group visit the larger one, ties by number: a large group whose rare variants lead groups
    of their own then sends nobody to these.
    """
    rooted = entries.join(_held(roots), "node")
    rest = F.col("n") - F.col("pos")
    blocks = rooted.groupBy("token", F.col("root").alias("block"), F.col("held").alias("block_held")).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(rest).alias("most_rest")
    )
    return (
        rooted.join(blocks, "token")
        .filter(F.struct("block_held", -F.col("block")) > F.struct("held", -F.col("root")))
        .filter(_could_link("n", rest, "least", "most", "most_rest", percent))
        .select("node", F.col("block").alias("root"))
        .distinct()
    )


def _derived(around: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) of the sets around common roots, from their differences alone."""
    limit = (100 - percent) * F.col("root_size")
    direct = around.filter(F.col("cost") <= limit).select(F.col("node").alias("a"), F.col("root").alias("b"))
    least = F.ceil((F.col("cost") - limit) / 100).cast("int")
    asked = lambda name: F.when(least > 0, F.col(name)).alias(name)
    tokens = around.select(
        "root", asked("node"), asked("cost"), F.when(least > 0, least).alias("least"), F.explode("differs").alias("token")
    )
    # Tokens that no other set differs in cannot be shared. A window tells, each difference is shuffled once for it.
    times = F.count("*").over(Window.partitionBy("root", "token"))
    listed = tokens.withColumn("times", times).filter((F.col("times") > 1) & F.col("node").isNotNull())
    listed = listed.groupBy("root", "node", "cost", "least").agg(F.collect_list("token").alias("differs"))
    listed = settled(listed.filter(F.size("differs") >= F.col("least")), "jaccard-outliers")
    # Blocks of outliers meet blocks of sets of the same root.
    asking = listed.groupBy("root").agg(F.ceil(F.count("*") / OUTLIER_BLOCK).cast("int").alias("cuts"))
    held = around.groupBy("root").agg(F.ceil(F.count("*") / SET_BLOCK).cast("int").alias("set_cuts"))
    cuts = asking.join(held, "root")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = listed.join(cuts, "root").withColumn("cut", own("cuts")).withColumn("set_cut", every("set_cuts"))
    right = around.join(cuts, "root").withColumn("set_cut", own("set_cuts")).withColumn("cut", every("cuts"))
    keys = ["root", "cut", "set_cut"]
    ship_package(around.sparkSession)
    found = (
        left.select(*keys, "node", "cost", "differs").groupBy(*keys)
        .cogroup(right.select(*keys, "node", "cost", "root_size", "differs").groupBy(*keys))
        .applyInArrow(partial(_block_links, percent=percent), "a bigint, b bigint")
    )
    return direct.unionByName(found)


def _block_links(key: tuple, outliers: pa.Table, sets: pa.Table, percent: int) -> pa.Table:
    """Enough links between the outliers and the sets of a block to connect all that link.

    Shared difference tokens are counted by their lists of sets; sets that link to the root stand for
    it. A link that joins what is joined already is left out, so that there are fewer than
    outliers and sets together.
    """
    edges: list[tuple[int, int]] = []
    if len(outliers) and len(sets):
        root = key[0].as_py()
        node, cost = sets["node"].to_numpy(), sets["cost"].to_numpy()
        limit = (100 - percent) * sets["root_size"][0].as_py()
        differs = sets["differs"].combine_chunks()
        order = np.argsort(tokens := differs.flatten().to_numpy(), kind="stable")
        holder = np.repeat(np.arange(len(node)), np.diff(differs.offsets.to_numpy()))[order]
        tokens = tokens[order]
        home: dict[int, int] = {}

        def top(x: int) -> int:
            while (above := home.get(x, x)) != x:
                home[x] = home.get(above, above)
                x = home[x]
            return x

        for name, own_cost, own in zip(outliers["node"].to_pylist(), outliers["cost"].to_pylist(), outliers["differs"].to_pylist(), strict=True):
            own = np.array(own, np.int64)
            starts, ends = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
            shared = np.bincount(np.concatenate([holder[a:b] for a, b in zip(starts, ends)]), minlength=len(node))
            linked = (shared > 0) & ((100 + percent) * shared >= cost + own_cost - limit) & (node != name)
            others = node[linked & (cost > limit)].tolist()
            if (linked & (cost <= limit)).any():
                others.append(root)
            for other in others:
                x, y = top(name), top(other)
                if x != y:
                    home[x] = y
                    edges.append((name, other))
    return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})


def _classes(
    documents: DataFrame, id_column: str, text_column: str, words_each: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Documents with shingles by class (doc_id, text_hash, n, h1, h2), and those without."""
    spark = documents.sparkSession
    texts = documents.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    keyed = texts.withColumn("text_hash", F.xxhash64("text"))
    id_type = keyed.schema["doc_id"].dataType.simpleString()
    described = map_batches(
        keyed, partial(_describe, words_each=words_each),
        f"doc_id {id_type}, text_hash bigint, n int, c1 bigint, c2 bigint, part int, counts binary",
    )
    described = settled(described, "jaccard-documents")
    shared = spark.sparkContext.broadcast(_sketch(described))  # 2 bytes << SKETCH_BITS
    described = described.filter(F.col("part").isNull()).select("doc_id", "text_hash", "n", "c1", "c2")

    prefixes = map_batches(
        texts.select("text"), partial(_prefixes, words_each=words_each, percent=percent, shared=shared),
        "token bigint, c1 bigint, n int, pos int",
    )
    # What a list holds is told by a window over it: its entries are shuffled once and every text is
    # shingled once for them. Tasks write them as they come, without a table of all their tokens.
    whole = Window.partitionBy("token")
    entries = prefixes.select(
        "*", F.min("c1").over(whole).alias("a"), F.max("c1").over(whole).alias("b"), F.count("*").over(whole).alias("times"),
        F.min("n").over(whole).alias("least"), F.max("n").over(whole).alias("most"),
    )
    # Lists of one set go, and those of two whose sizes are too far apart.
    entries = entries.filter("a < b").filter((F.col("times") > 2) | (F.col("least") * 100 >= F.col("most") * percent))
    entries = entries.groupBy("token", "c1").agg(F.min("n").alias("n"), F.min("pos").alias("pos"))
    entries = settled(entries, "jaccard-entries")
    shared.destroy()
    entries = settled(_alive(entries, percent), "jaccard-alive")
    # Where sets share the half, each gets the entries of all of them: more to compare, none lost.
    nodes = described.join(entries.select("c1").distinct(), "c1").select("c1", "c2", "n").distinct()
    nodes = settled(nodes.withColumn("node", F.monotonically_increasing_id()), "jaccard-nodes")
    entries = entries.drop("n").join(nodes, "c1").select("token", "node", "n", "pos")
    entries = settled(entries, "jaccard-index")

    source = described.join(nodes, ["c1", "c2"]).groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("of"))
    source = source.select("node", F.col("of.doc_id").alias("of_id"), F.col("of.text_hash").alias("text_hash"))
    # Of a side that grows with the input no size is known: merged alike at every size.
    source = source.hint("merge")
    # Texts are compressed before this shuffle, which is the largest of all.
    packed = map_batches(keyed, _packed, f"doc_id {id_type}, text_hash bigint, packed binary")
    sets = packed.join(source, (packed["text_hash"] == source["text_hash"]) & packed["doc_id"].eqNullSafe(source["of_id"]))
    sets = settled(sets.select("node", "packed").dropDuplicates(["node"]), "jaccard-sets")

    roots = _roots(entries)
    pairs = _sized(roots.filter("node != root"), nodes, NEAR_PERCENT)
    own = _compared(pairs, sets, words_each, percent, NEAR_PERCENT).filter(F.col("differs").isNotNull())
    own = settled(own, "jaccard-own")
    near = own.select("node", F.lit(True).alias("near"))
    roots = roots.join(near, "node", "left").select("node", F.when(F.col("near"), F.col("root")).otherwise(F.col("node")).alias("root"))
    roots = settled(roots, "jaccard-roots")
    # Variants that led groups of their own gather around one root, else every set would visit every such group.
    pairs = _sized(_larger(entries, roots), nodes, NEAR_PERCENT)
    others = _compared(pairs, sets, words_each, percent, NEAR_PERCENT).filter(F.col("differs").isNotNull())
    own, roots = _gathered(own, roots, others)
    near_guests = NEAR_PERCENT - (100 - percent)
    pairs = _sized(_guests(entries, roots, percent), nodes, near_guests)
    guests = _compared(pairs, sets, words_each, percent, near_guests)
    around = own.unionByName(guests.filter(F.col("differs").isNotNull()))
    around = settled(around, "jaccard-around")
    found = connected_components(_derived(around, percent))

    labels = nodes.join(found, "node")
    heads = nodes.select(F.col("node").alias("component"), F.col("c1").alias("h1"), F.col("c2").alias("h2"))
    labels = labels.join(heads, "component").select("c1", "c2", "h1", "h2")
    classed = described.filter("n > 0").join(labels, ["c1", "c2"], "left").select(
        "doc_id", "text_hash", "n", F.coalesce("h1", "c1").alias("h1"), F.coalesce("h2", "c2").alias("h2")
    )
    return settled(classed, "jaccard-classes"), described.filter("n = 0")


def similarity_classes(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words_each: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents link when 100 * common shingles >= ``percent`` * all shingles of both; the component
    is the smallest id reachable by links, the document's own included. Texts without words and
    null texts have no shingles and link with nothing. Null ids are never the smallest; a
    component of null ids only has a null one. Repeated rows have equal sets, so they share a component. An empty
    table gives an empty result; other columns are not read.
    """
    classed, bare = _classes(documents, id_column, text_column, words_each, percent)
    least = classed.groupBy("h1", "h2").agg(F.min("doc_id").alias("component_id"))
    return (
        classed.join(least, ["h1", "h2"])
        .select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id")
        .unionByName(
            bare.select("doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id"))
        )
    )


def representatives(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words_each: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The documents, with all their columns, of which each class keeps one: that of the smallest id.

    Null ids are kept only where a class has no other. Documents without shingles are all kept. Of repeated rows
    of the smallest id, one stays.
    """
    columns = documents.columns
    classed, bare = _classes(documents, id_column, text_column, words_each, percent)
    rows = classed.groupBy("h1", "h2", "doc_id", "text_hash").agg(F.count("*").alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "rows")).alias("first")
    chosen = rows.groupBy("h1", "h2").agg(first).select("first.doc_id", "first.text_hash", "first.rows")
    chosen = chosen.unionByName(bare.select("doc_id", "text_hash", F.lit(1).cast("bigint").alias("rows")).distinct())
    chosen = settled(chosen, "jaccard-kept").toDF("__id", "__hash", "__rows")
    keyed = documents.withColumn("__text_hash", F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))))
    kept = keyed.join(chosen, (F.col("__text_hash") == F.col("__hash")) & F.col(id_column).eqNullSafe(F.col("__id")))
    single = kept.filter("__rows = 1").select(*columns)
    repeated = kept.filter("__rows > 1").dropDuplicates(["__hash", "__id"]).select(*columns)
    return single.unionByName(repeated)
