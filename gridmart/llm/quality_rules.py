"""Quality rules with risk-controlled thresholds.

Four ratios are measured on every document. For each ratio, cutoff of a fixed grid and stratum
(a language), the labelled good documents with a ratio above the cutoff are counted. A cutoff
is admissible if the exact binomial upper bound of its false rejection rate is at most the rule's share
of ``risk``, at a confidence shared by Bonferroni's correction over all strata, rules and
cutoffs tested. The admissible cutoff that rejects most bad documents, net of good ones, is
used; without one, the rule is off in that stratum.

Then, with probability ``1 - error`` over the labelled sample, no stratum loses more than
``risk`` of its good documents to the rules.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import WORD, stored

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
SYMBOLS = "[#*$%&|<>]"
RISK = 0.05
ERROR = 0.05
RULES = ("symbols", "duplicate_lines", "repeated_words", "capitals")
GRID = (0.0, 0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)


def _computed(frame: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """The columns named, each evaluated once per row.

    Expressions that a later lambda function reads would otherwise be merged into it and run
    again for every element; the generator in between prevents that.
    """
    fields = F.struct(*[value.alias(name) for name, value in columns.items()])
    return frame.select(*keep, F.inline(F.array(fields)))


def measure(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: dict[str, str] | None = None) -> DataFrame:
    """Counts of each document: doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, n_capitals; ``keep`` maps further output names to columns.

    Words are compared by 64-bit hashes, windows by hashes of those. A null text has no words.
    """
    keep = keep or {}
    kept = ["doc_id", *keep]
    texts = documents.select(
        F.col(id_column).alias("doc_id"),
        *[F.col(column).alias(name) for name, column in keep.items()],
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    counted = _computed(
        texts,
        *kept,
        hashes=F.transform(words, lambda word: F.xxhash64(word)),
        word_chars=(F.length("text") - F.regexp_count("text", F.lit(r"[\x20\x09-\x0D]"))).cast("bigint"),
        n_symbols=F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint"),
        n_capitals=F.regexp_count("text", F.lit(r"\p{Lu}")).cast("bigint"),
        lines=lines,
    )
    kept += ["word_chars", "n_symbols", "n_capitals"]
    n = F.size("hashes")
    windows = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = _computed(
        counted,
        *kept,
        n_words=n.cast("bigint"),
        n_lines=F.size("lines").cast("bigint"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        windows=windows,
    )
    kept += ["n_words", "n_lines", "n_dup_lines"]
    ordered = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda window, at: F.struct(window.alias("window"), at.alias("at")))),
    )
    counted = _computed(counted, *kept, ordered=ordered)
    # Equal windows are neighbours now; the places of those that have one, in rising order.
    before = F.concat(F.array(F.lit(None).cast("bigint")), F.col("ordered.window"))
    after = F.concat(F.slice(F.col("ordered.window"), 2, F.size("ordered")), F.array(F.lit(None).cast("bigint")))
    same_before = F.zip_with("ordered", before, lambda own, prior: F.struct(own["at"].alias("at"), own["window"].alias("window"), F.coalesce(own["window"] == prior, F.lit(False)).alias("again")))
    same_either = F.zip_with(
        same_before, after,
        lambda own, later: F.when(own["again"] | F.coalesce(own["window"] == later, F.lit(False)), own["at"]),
    )
    places = F.sort_array(F.array_compact(same_either))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("words"), F.lit(-WINDOW).alias("last")),
        lambda state, at: F.struct(
            (state["words"] + F.least(F.lit(WINDOW), at - state["last"])).alias("words"), at.alias("last")
        ),
        lambda state: state["words"],
    )
    n_repeat = F.when(F.col("ordered").isNull(), 0).otherwise(covered).cast("bigint")
    return counted.select(*kept, n_repeat.alias("n_repeat_words"))


def ratios() -> dict[str, Column]:
    share = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))
    return {
        "symbols": share("n_symbols", "word_chars"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` of ``n`` events of probability ``p``."""
    if k >= n:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def choose_cutoffs(counts: list[tuple], risk: float = RISK, error: float = ERROR) -> dict[tuple, float]:
    """Cutoffs by (stratum, rule) from rows of (stratum, rule, bucket, good, bad).

    A bucket is the number of grid cutoffs below the ratio: a document is rejected at cutoff i
    if its bucket is above i. The bound at confidence 1 - d is at most r exactly if seeing as few
    rejections has a probability of at most d under a rate of r.
    """
    tables: dict[tuple, list[list[int]]] = {}
    for stratum, rule, bucket, good, bad in counts:
        table = tables.setdefault((stratum, rule), [[0, 0] for _ in range(len(GRID) + 1)])
        table[bucket][0] += good
        table[bucket][1] += bad
    strata = {stratum for stratum, _ in tables}
    level = error / max(1, len(strata) * len(RULES) * len(GRID))
    allowed = risk / len(RULES)
    chosen = {}
    for key, table in tables.items():
        n_good = sum(good for good, _ in table)
        best = 0
        for i in range(len(GRID) - 1, -1, -1):  # from the loosest on; only a gain moves it
            good, bad = (sum(row[side] for row in table[i + 1 :]) for side in (0, 1))
            if good > allowed * n_good or binomial_tail(good, n_good, allowed) > level:
                break
            if bad - good > best:
                best, chosen[key] = bad - good, GRID[i]
    return chosen


def apply_rules(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    stratum_column: str = "lang",
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """One row per document: doc_id, stratum, the counts of ``measure``, base_failed, rejected_by
    (names of the rules) and kept.

    ``labels`` has doc_id and quality (1 good, 0 bad; others are ignored); a document with
    several labels counts as good if one says so. Null ids match no label. A null stratum is a
    stratum. A null text fails the base. Repeated rows are judged, and as holdout counted, one by one. An empty
    table gives an empty result; without labels only the base applies; other columns are not
    read.
    """
    measured = stored(measure(documents, id_column, text_column, {"stratum": stratum_column}), "quality-counts")
    return _ruled(measured, _cutoff_table(measured, labels, risk, error))


def kept_documents(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    stratum_column: str = "lang",
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """The documents that ``apply_rules`` keeps, with all their columns."""
    names = {f"__kept_{i}": column for i, column in enumerate(documents.columns)}
    # Stored with their counts, documents are measured once and never shuffled; the cutoffs read the counts alone.
    measured = stored(measure(documents, id_column, text_column, {"stratum": stratum_column, **names}), "quality-counts")
    kept = _ruled(measured, _cutoff_table(measured, labels, risk, error)).filter("kept")
    return kept.select(*[F.col(name).alias(column) for name, column in names.items()])


def _cutoff_table(measured: DataFrame, labels: DataFrame, risk: float, error: float) -> DataFrame:
    """A row for each stratum with a rule on: known, and a cutoff or null for each rule."""
    judged = labels.filter(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max("quality").alias("quality")
    )
    held_out = measured.filter(~base_failed()).join(judged, F.col("doc_id") == F.col("label_id"))
    by_rule = F.array(*[F.struct(F.lit(name).alias("rule"), ratio.alias("ratio")) for name, ratio in ratios().items()])
    bucket = F.size(F.filter(F.array(*map(F.lit, GRID)), lambda cutoff: cutoff < F.col("ratio")))
    counts = (
        held_out.select("stratum", "quality", F.inline(by_rule))
        .groupBy("stratum", "rule", bucket.alias("bucket"))
        .agg(F.sum(F.expr("int(quality = 1)")).alias("good"), F.sum(F.expr("int(quality = 0)")).alias("bad"))
    )
    # Strata x rules x grid rows at most, for the driver's arithmetic.
    cutoffs = choose_cutoffs([tuple(r) for r in counts.collect()], risk, error)
    strata = sorted({stratum for stratum, _ in cutoffs}, key=lambda s: (s is None, s))
    rows = [(stratum, *[cutoffs.get((stratum, rule)) for rule in RULES]) for stratum in strata]
    stratum_type = measured.schema["stratum"].dataType.simpleString()
    schema = f"known {stratum_type}, " + ", ".join(f"cut_{rule} double" for rule in RULES)
    return measured.sparkSession.createDataFrame(rows, schema)


def _ruled(measured: DataFrame, table: DataFrame) -> DataFrame:
    # A stratum has a rule only by several hundred labels: the table fits a broadcast, and the rows stay where they are.
    ruled = measured.join(F.broadcast(table), F.col("stratum").eqNullSafe(F.col("known")), "left")
    over = [F.when(ratio > F.col(f"cut_{rule}"), F.lit(rule)) for rule, ratio in ratios().items()]
    ruled = ruled.withColumn("base_failed", base_failed()).withColumn("rejected_by", F.array_compact(F.array(*over)))
    ruled = ruled.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
    return ruled.drop("known", *[f"cut_{rule}" for rule in RULES])
