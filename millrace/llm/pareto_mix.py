"""Mixing sources to target weights with whole documents, drawn by Pareto order sampling.

A source's target is its share by weight, at most ``most`` times its own words; what a source cannot take is
shared out again. Every document is first taken as many whole times as the target holds the source. The words
still missing come from one more copy of some documents: each has a random odds, divided by the odds of the
source's missing share, and the least ratios win (Pareto order sampling). The draw is made in classes of size,
a factor of 4 each, longest documents first: a class takes the run of least ratios whose words come nearest to
what the classes so far should hold, so the miss of one class is made good by shorter documents.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window

from millrace.llm.common import cut, with_prefix_sums

WEIGHTS = (3, 1, 2)
PERCENT = 150
MOST = 2
SEED = 12

_WORD = r"[^ \t-\r]+"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def draw(seed: int) -> Column:
    """A number in (0, 1) that depends on the seed, the id and the text alone; null ids and texts count as empty."""
    doc_id, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text"))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), doc_id, F.lit(":"), text).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / 2.0**52


def targets(sizes: DataFrame, weights: Sequence[int], percent: int, most: int) -> DataFrame:
    """(place, source, source_size, target) of each source, from rows with ``source`` and ``size``.

    Sources stand in the order of code points, null last; weights repeat in that order. All targets together are
    ``percent`` of all words, unless ``most`` times every source is less.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_prefix_sums(totals.withColumn("nameless", F.col("source").isNull()), ["nameless", "source"], "source_size", "mix-sources")
    cycle = F.array(*map(F.lit, weights))
    ranked = cut(
        ranked.select(
            F.col("row_index").alias("place"),
            "source",
            "source_size",
            (F.col("source_size") * most).alias("bound"),
            F.element_at(cycle, (F.col("row_index") % len(weights) + 1).cast("int")).alias("weight"),
        ),
        "mix-ranked",
    )
    full, level = None, 0.0
    whole = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = (whole[0] or 0) * percent / 100
    level = wanted / (whole[1] or 1)
    while True:  # one row returns each time; a source that is full stays so
        stopped = F.col("bound") <= F.col("weight") * F.lit(level)
        held = ranked.agg(
            F.count_if(stopped), F.sum(F.when(stopped, F.col("bound"))), F.sum(F.when(~stopped, F.col("weight")))
        ).first()
        if held[0] == full or not held[2]:
            break
        full, level = held[0], (wanted - (held[1] or 0)) / held[2]
    target = F.least(F.col("bound").cast("double"), F.col("weight") * F.lit(level))
    return ranked.select("place", "source", "source_size", target.alias("target"))


def _nearest_runs(placed: DataFrame) -> DataFrame:
    """(place, down, end_row): of each source and class the row before which all rows get one more copy."""
    classes = placed.groupBy("place", "down").agg(
        F.min("row_index").alias("first_row"),
        F.min("sum_before").alias("first_sum"),
        F.sum("size").alias("class_size"),
        F.first("source_size").alias("source_size"),
        F.first("extra").alias("extra"),
    )
    longer = Window.partitionBy("place").orderBy("down").rowsBetween(Window.unboundedPreceding, 0)  # one row per power of 4
    share = F.try_divide(F.col("extra") * F.sum("class_size").over(longer), "source_size")
    classes = cut(classes.withColumn("due", F.round(F.coalesce(share, F.lit(0.0))).cast("long")), "mix-classes")
    chosen: list[DataFrame] = []
    for (down,) in classes.where("extra > 0").select("down").distinct().orderBy("down").collect():  # one per power of 4
        open_classes = classes.where((F.col("down") == down) & (F.col("extra") > 0))
        if chosen:
            before = reduce(DataFrame.union, chosen).groupBy("place").agg(F.sum("words").alias("words"))
            open_classes = open_classes.join(before, "place", "left")
        else:
            open_classes = open_classes.withColumn("words", F.lit(0))
        due = open_classes.select(
            "place", "first_sum", (F.col("due") - F.coalesce("words", F.lit(0))).alias("due")
        )
        run = placed.where(F.col("down") == down).join(due, "place")
        run = run.withColumn("words", F.col("sum_before") - F.col("first_sum") + F.col("size"))
        run = run.withColumn("end_row", F.col("row_index") + 1)
        run = run.withColumn("gap", F.abs(F.col("words") - F.col("due")))
        best = run.where(F.col("gap") < F.abs("due")).groupBy("place").agg(F.min(F.struct("gap", "end_row", "words")).alias("best"))
        chosen.append(cut(best.select("place", F.lit(down).alias("down"), "best.end_row", "best.words"), "mix-chosen"))
    if not chosen:
        return classes.select("place", "down", F.col("first_row").alias("end_row"))
    return reduce(DataFrame.union, chosen).select("place", "down", "end_row")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = PERCENT,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of each row; taken is copies times size.

    A null text has no words and takes none, as has an empty one. Null sources are one source. Repeated rows each
    have a place of their own; which of them is drawn makes no difference. Rows with equal ids and other texts are
    drawn apart. Other columns are ignored; an empty table gives none. The same rows give the same mix, however they
    are partitioned. A source misses its target by half of its shortest documents or so, as whole copies allow.
    """
    sizes = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), draw(seed).alias("u")), "mix-sizes")
    aims = targets(sizes, weights, percent, most)
    goal = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0))
    known = (
        sizes.join(aims.withColumnRenamed("source", "aim"), F.col("source").eqNullSafe(F.col("aim")))
        .drop("aim")
        .withColumn("whole", whole)
        .withColumn("extra", goal - F.col("whole") * F.col("source_size"))
    )
    chance = F.try_divide("extra", "source_size")  # null for a source without words
    ratio = (F.col("u") / (1 - F.col("u"))) / (chance / (1 - chance))
    known = known.withColumn("ratio", F.when(F.col("extra") > 0, ratio)).drop("u")
    known = known.withColumn("down", -F.ceil(F.length(F.bin("size")) / 2).cast("int"))
    placed = cut(with_prefix_sums(known, ["place", "down", "ratio", "doc_id", "size"], "size", "mix-order"), "mix-placed")
    runs = cut(_nearest_runs(placed), "mix-runs")  # written, so that Spark knows how small it is
    drawn = placed.join(runs, ["place", "down"], "left").withColumn(
        "copies", F.col("whole") + F.coalesce((F.col("row_index") < F.col("end_row")).cast("int"), F.lit(0))
    )
    return drawn.select(
        "doc_id", "source", "size", "source_size", "target", F.col("copies").cast("int").alias("copies"),
        (F.col("copies") * F.col("size")).alias("taken"),
    )
