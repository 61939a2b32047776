"""Shards of near equal bytes by histogram sort.

Every row gets a sort key: a hash of its text, then of its id, then of its number among rows
that are equal in both. Probes are key prefixes. Each round counts the exact bytes below every
probe with one aggregation, keeps for each splitter the one interval that its ideal place falls
in, and probes only that one more finely, until the splitter is within the tolerance or the
interval holds a single row. The rows are then exchanged once, by ranges of the key, so that
each shard is a run of sorted partitions.

Equal texts are neighbours and share a shard, unless a splitter within the tolerance has to
pass through them; a group that is larger than a shard is spread over several.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import stored

N_SHARDS = 24
TOLERANCE = 0.001
DIGITS = 12
KEY_LENGTH = 3 * DIGITS
PROBE_DIGITS = 3


def _digits(*columns: Column) -> Column:
    return F.substring(F.lpad(F.hex(F.xxhash64(*columns)), 16, "0"), 17 - DIGITS, DIGITS)


@dataclass
class _Cell:
    prefix: str
    below: int
    size: int
    rows: int
    first: str
    last: str


def _splitters(keyed: DataFrame, total: int, n_shards: int, tolerance: float) -> list[str]:
    """Keys between the shards: a row's shard is the number of splitters not above its key.

    The driver holds at most 16 ** PROBE_DIGITS cells for each splitter, whatever the input.
    """
    slack = tolerance * total / n_shards
    ideal = {j: total * j / n_shards for j in range(1, n_shards)}
    found: dict[int, str] = {}
    opened = {j: ("", 0) for j in ideal}  # the interval of each splitter: prefix, bytes below it
    while opened:
        by_length: dict[int, set[tuple[str, int]]] = {}
        for prefix, below in opened.values():
            by_length.setdefault(len(prefix), set()).add((prefix, below))
        cells: dict[str, list[_Cell]] = {}
        for length, intervals in by_length.items():
            counted = keyed.filter(F.substring("key", 1, length).isin([p for p, _ in intervals])) if length else keyed
            counted = counted.groupBy(F.substring("key", 1, length + PROBE_DIGITS).alias("probe")).agg(
                F.sum("size").alias("size"), F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")
            )
            below = dict(intervals)
            for r in sorted(counted.collect(), key=lambda r: r["probe"]):
                prefix = r["probe"][:length]
                cells.setdefault(prefix, []).append(_Cell(r["probe"], below[prefix], r["size"], r["n"], r["lo"], r["hi"]))
                below[prefix] += r["size"]
        still: dict[int, tuple[str, int]] = {}
        for j, (prefix, _) in opened.items():
            inside = cells.get(prefix)
            if not inside:  # no row at all
                found[j] = "~"
                continue
            cell = next((c for c in inside if c.below + c.size >= ideal[j]), inside[-1])
            under, over = ideal[j] - cell.below, cell.below + cell.size - ideal[j]
            if min(under, over) <= slack or cell.rows == 1 or cell.first == cell.last:
                found[j] = cell.prefix if under <= over else cell.prefix + "~"
                continue
            same = next(i for i, (a, b) in enumerate(zip(cell.first, cell.last, strict=True)) if a != b)
            still[j] = (cell.first[: max(same, len(cell.prefix))], cell.below)
        opened = still
    return [found[j] for j in sorted(found)]


def shard_by_bytes(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    n_shards: int = N_SHARDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    ``size`` is the UTF-8 length of the text plus 8; a null text has no bytes and the checksum of
    an empty one. Shards differ by twice the tolerance (a share of a shard) and two documents
    at most. Slots number the rows of a shard from 0 in the order of the key. Null ids are ids
    like any other; repeated rows are numbered and can be split over shards; an empty table
    gives an empty result; other columns are not read.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = documents.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + F.lit(8)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.concat(_digits(text), _digits(F.col(id_column))).alias("start"),
    )
    # Equal rows are counted before the shuffle and numbered after it.
    counted = rows.groupBy("doc_id", "size", "text_crc32", "start").agg(F.count("*").alias("copies"))
    keyed = counted.select(
        "doc_id", "size", "text_crc32", "start", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    ).select("doc_id", "size", "text_crc32", F.concat("start", _digits(F.col("start"), F.col("copy"))).alias("key"))
    keyed = stored(keyed, "shard-keys")

    total = keyed.agg(F.sum("size")).first()[0] or 0
    splitters = _splitters(keyed, total, n_shards, tolerance)
    shard = F.lit(0)
    for splitter in splitters:
        shard = shard + (F.col("key") >= F.lit(splitter)).cast("int")
    ordered = (
        keyed.withColumn("shard", shard)
        .repartitionByRange(F.col("key"))
        .sortWithinPartitions("key")
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("place", 33).cast("int"))
    )
    ordered = stored(ordered, "shard-order")

    # A shard starts anew in each partition it reaches: its first place there, and the rows before.
    runs = ordered.groupBy("shard", "part").agg(F.min("place").alias("first_place"), F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "part", "first_place", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return ordered.join(runs, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("before") + F.col("place") - F.col("first_place")).alias("slot"),
    )
