"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are put in a random but fixed order. A document finishes at the virtual
time at which its source, served at the rate of its target, has sent all tokens up to and with
it. Serving all sources by rising finish time keeps each near its share at every moment; the
mix ends when the budget is used up. A source with a target above its size starts anew, up to
``REPEATS`` times in all.

Running sums are never taken over a whole source or the whole mix in one task: they run within
cells of bounded size, with the sums of the cells before added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import WORD, settled

REPEATS = 3
WEIGHTS = (1, 2, 3)
CELL_ROWS = 4_000
KEY_DIGITS = 16


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def row_key(id_column: Column, text: Column) -> Column:
    """Place of a row in its source's order, by digest: alike for rows with equal id and text."""
    parts = (F.coalesce(id_column.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, KEY_DIGITS)


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Per source: source_no, source_size, target (tokens of the mix).

    The budget, all tokens there are, is shared by weight; no target exceeds ``repeats`` times
    the source's size, and what is over goes to the others by weight. With the sources ordered
    by the share at which they reach that limit, the rate is that of the first source which
    does not reach it. ``totals`` has one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = len(weights)
    weight = reduce(
        lambda w, k: w.when((F.col("source_no") - 1) % kinds == k, weights[k]), range(1, kinds),
        F.when((F.col("source_no") - 1) % kinds == 0, weights[0]),
    )
    named = totals.withColumn("source_no", F.row_number().over(by_name)).withColumn("weight", weight)
    named = named.withColumn("most", F.col("source_size") * repeats)
    named = named.withColumn("full_at", F.col("most") / F.col("weight"))
    everything = Window.partitionBy()
    filling = Window.orderBy("full_at", "source_no")
    named = (
        named.withColumn("budget", F.sum("source_size").over(everything))
        .withColumn("full", F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("open", F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("rate", (F.col("budget") - F.col("full") + F.col("most")) / F.col("open"))
    )
    rate = F.max(F.when(F.col("rate") <= F.col("full_at"), F.col("rate"))).over(everything)
    return named.withColumn("rate", rate).select(
        "source",
        "source_no",
        "source_size",
        "budget",
        F.least(F.col("most").cast("double"), F.col("rate") * F.col("weight")).alias("target"),
    )


def _running(rows: DataFrame, group: list[str], cell: str, order: list[str], value: str) -> DataFrame:
    """Adds ``upto``: the sum of ``value`` over the group in order, up to and with the row."""
    keys = [*group, cell]
    before = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy(*keys).agg(F.sum(value).alias("cell_sum"))
    cells = cells.select(*keys, F.coalesce(F.sum("cell_sum").over(before), F.lit(0)).alias("cell_start"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.join(cells, keys)
        .withColumn("upto", F.col("cell_start") + F.sum(value).over(within))
        .drop("cell_start")
    )


def mixed_copies(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
) -> DataFrame:
    """Every copy the mix could take, in cells of rising finish time: doc_id, source, row_key, number,
    size, source_size, target, copy (from 0), finish, served (tokens sent up to and with the copy) and
    in_mix. Documents without words have one row, outside the mix.

    Read in the order of finish (then key, number, copy), the rows of the mix are the mixed corpus.
    """
    rows = documents.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        words_of(F.col(text_column)).alias("size"),
        row_key(F.col(id_column), F.col(text_column)).alias("row_key"),
    )
    # Equal rows are counted before the shuffle and numbered after it.
    counted = rows.groupBy("doc_id", "source", "size", "row_key").agg(F.count("*").alias("copies"))
    numbered = counted.select(
        "doc_id", "source", "size", "row_key", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("number")
    )
    place = F.substring(F.md5(F.concat_ws("|", "row_key", F.col("number").cast("string")).cast("binary")), 1, KEY_DIGITS)
    numbered = settled(numbered.withColumn("place", place), "mix-rows")

    totals = numbered.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    targets = settled(source_targets(totals, weights, repeats), "mix-targets")
    n_rows = numbered.count()
    digits = 1
    while 16**digits * CELL_ROWS < n_rows:
        digits += 1
    served = numbered.join(
        targets.withColumnRenamed("source", "target_source"), F.col("source").eqNullSafe(F.col("target_source"))
    ).drop("target_source")
    served = served.withColumn("cell", F.substring("place", 1, digits))
    served = _running(served, ["source_no"], "cell", ["place", "row_key", "number"], "size").drop("cell")

    queued = served.filter(F.col("size") > 0).select(
        *[c for c in served.columns], F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("copy")
    )
    finish = (F.col("copy") * F.col("source_size") + F.col("upto")) / F.col("target")
    cells = max(16, n_rows * repeats // CELL_ROWS)
    queued = queued.withColumn("finish", finish).drop("upto")
    queued = queued.withColumn("moment", F.floor(F.col("finish") * cells))
    queued = _running(queued, [], "moment", ["finish", "place", "row_key", "number", "copy"], "size")
    columns = ["doc_id", "source", "row_key", "number", "size", "source_size", "target", "copy", "finish"]
    taken = queued.select(*columns, F.col("upto").alias("served"), (F.col("upto") <= F.col("budget")).alias("in_mix"))
    wordless = served.filter(F.col("size") == 0).select(
        "doc_id", "source", "row_key", "number", "size", "source_size", "target",
        F.lit(0).alias("copy"), F.lit(None).cast("double").alias("finish"),
        F.lit(None).cast("bigint").alias("served"), F.lit(False).alias("in_mix"),
    )
    return taken.unionByName(wordless)


def mix(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
) -> DataFrame:
    """One row per document: doc_id, row_key, size, source_size, target, copies (0 to ``repeats``) and
    taken (size times copies).

    A null text has no words and, like every text without words, is never taken. A null source
    is a source, the last one. Repeated rows are rows of their own in the queue. An empty table
    gives an empty result; other columns are not read. Reruns give the same rows.
    """
    rows = _copies_of_rows(mixed_copies(documents, id_column, text_column, source_column, weights, repeats))
    return rows.withColumn("taken", F.col("size") * F.col("copies")).drop("source", "number")


def _copies_of_rows(copies: DataFrame) -> DataFrame:
    keys = ["doc_id", "source", "row_key", "number", "size", "source_size", "target"]
    return copies.groupBy(*keys).agg(F.sum(F.col("in_mix").cast("int")).cast("int").alias("copies"))


def mixed_documents(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
) -> DataFrame:
    """The rows of the mix with all their columns, a row for each copy taken."""
    columns = documents.columns
    plan = _copies_of_rows(mixed_copies(documents, id_column, text_column, source_column, weights, repeats))
    plan = plan.groupBy(F.col("row_key").alias("__mix_plan_key"), F.col("source").alias("__mix_source")).agg(
        F.count("*").alias("__mix_rows"), F.sum("copies").alias("__mix_copies")
    )
    plan = settled(plan.filter(F.col("__mix_copies") > 0), "mix-plan")
    keyed = documents.withColumn("__mix_key", row_key(F.col(id_column), F.col(text_column)))
    same = (F.col("__mix_key") == F.col("__mix_plan_key")) & F.col(source_column).eqNullSafe(F.col("__mix_source"))
    chosen = keyed.join(plan, same).drop("__mix_plan_key", "__mix_source")
    single = chosen.filter(F.col("__mix_rows") == 1).select(*columns, "__mix_copies")
    # Rows of one key and source take the same copies but for one more of the first in order; equal rows
    # are one row here, taken as often as all of them together.
    group = [*columns, "__mix_key", "__mix_rows", "__mix_copies"]
    repeated = chosen.filter(F.col("__mix_rows") > 1).groupBy(*group).agg(F.count("*").alias("__mix_equal"))
    spread = Window.partitionBy("__mix_key", source_column).orderBy(*columns)
    upto = F.sum("__mix_equal").over(spread.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    repeated = repeated.withColumn("__mix_upto", upto).withColumn("__mix_more", F.expr("__mix_copies % __mix_rows"))
    more = F.greatest(F.lit(0), F.least("__mix_upto", "__mix_more") - F.col("__mix_upto") + F.col("__mix_equal"))
    each = F.expr("__mix_copies div __mix_rows")
    repeated = repeated.withColumn("__mix_copies", F.col("__mix_equal") * each + more).select(*columns, "__mix_copies")
    both = single.unionByName(repeated.filter(F.col("__mix_copies") > 0))
    return both.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__mix_copies")))).select(*columns)
