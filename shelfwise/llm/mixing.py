"""Mixing sources to target weights by weighted fair queueing.

Sources share the budget (all words) by weight; a source's target stops at ``MAX_EPOCHS`` times its
size, and the excess is shared again among the others.  Each source's documents stand in one shuffled
queue (by a keyed hash of id and text), repeated up to ``MAX_EPOCHS`` times.  A document's virtual
finish time is the words its source has served so far, over the source's target; the queues merge by a
range sort on virtual time, and the mix ends where the running total passes the budget.

Both running totals are made without a hot task.  A queue is cut into ranges of the hash, and virtual
time into ranges of equal length; the totals of the ranges are small tables, and only rows of the same
range are sorted together.  Hashes spread evenly, and so do documents over virtual time, so a source
that holds a third of all rows is spread over all ranges.  Within a range totals count from the middle
of a document, so that the last one is taken if more than half of it fits: a source's words differ from
its target by about half a document at most.

Defined results: a null or empty text has size 0 and is taken 0 times; a null source is a source of its
own, the last; repeated rows are documents of their own, and as rows of equal id, source and text stand
for each other, they share their copies evenly.  An empty table, or one without words, gives targets of
0.  Results depend on the rows alone, not on their partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import checkpointed

#: Weights of the sources in code-point order, repeating; null comes last.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 42
#: Rows that a range holds on average.
ROWS_PER_RANGE = 5_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_no, source_size, target) from (source, size): one row for each source.

    Sources that reach their limit first (the least limit for their weight) form a prefix of the order
    by limit / weight; running sums over that order tell for each whether it stops.  The windows run
    over one row for each source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    by_source = (by_source
                 .withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
                 .withColumn("weight", w).withColumn("limit", F.col("source_size") * max_epochs))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "nth")
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    shared = (by_source.withColumn("budget", F.sum("source_size").over(everything))
              .withColumn("left", F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0)))
              .withColumn("among", F.sum("weight").over(everything)
                          - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("stops", F.col("limit") * F.col("among") <= F.col("left") * F.col("weight")))
    rest = shared.withColumns({
        "free_words": F.first(F.when(~F.col("stops"), F.col("left")), True).over(
            order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        "free_weight": F.first(F.when(~F.col("stops"), F.col("among")), True).over(
            order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    return rest.select("source", F.col("nth").alias("source_no"), "source_size", F.when(F.col("stops"), F.col("limit").cast("double")).otherwise(
        F.col("free_words") * F.col("weight") / F.col("free_weight")).alias("target"))


def row_key(id_col: str, seed: int) -> Column:
    """64-bit identity of a row's id, source and text; in its order, documents are shuffled."""
    cols = [F.col(id_col).cast("string"), F.col("source").cast("string"), F.col("text")]
    return F.xxhash64(F.lit(seed), *[x for c in cols for x in (F.isnull(c), c)])


def _running(rows: DataFrame, part: list[str], order: list, value: str) -> DataFrame:
    """``rows`` with ``upto``: the sum of ``value`` over this and all earlier rows of its group.

    ``part``: the columns of the group, then the range of the order to which a row belongs.
    """
    before = Window.partitionBy(*part[:-1]).orderBy(part[-1]).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*part).agg(F.sum(value).alias("in_part"))
    offsets = sums.select(*part, F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("before_part"))
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.join(offsets, part).withColumn("upto", F.col("before_part") + F.sum(value).over(inside))
            .drop("before_part"))


def plan(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
         id_col: str = "doc_id") -> DataFrame:
    """(id, key, nth, size, source_size, target, copies) of each document.

    ``key`` is the row's identity, ``nth`` tells rows of equal identity apart, ``copies`` says how often
    the mix takes the document.
    """
    sized = docs.select(F.col(id_col).alias("id"), F.col("source").cast("string").alias("source"),
                        word_count(F.col("text")).alias("size"), row_key(id_col, seed).alias("key"))
    sized = checkpointed(sized)  # one pass over the texts, whatever follows
    total = sized.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("words")).first()
    ranges = max(1, total["n"] // ROWS_PER_RANGE)
    wanted = targets(sized.select("source", "size"), weights, max_epochs).withColumnRenamed("source", "of")
    queued = sized.join(wanted, F.col("source").eqNullSafe(F.col("of"))).drop("source", "of")
    queued = queued.withColumn("part", F.floor(F.shiftrightunsigned("key", 32) * ranges / (1 << 32)))
    queue = _running(queued, ["source_no", "part"], ["key", "id"], "size").drop("part")

    # A queue comes to a further round only if its target is beyond the rounds before.
    rounds = F.expr(f"filter(sequence(0, {max_epochs - 1}), e -> e * source_size < target)")
    served = (queue.filter("size > 0").withColumn("epoch", F.explode(rounds))
              .withColumn("finish", (F.col("upto") - F.col("size") / 2 + F.col("epoch") * F.col("source_size"))
                          / F.col("target"))
              .filter("finish < 2")  # the budget is spent at about virtual time 1
              .withColumn("part", F.floor(F.col("finish") * ranges))
              .select("key", "source_no", "size", "epoch", "finish", "part"))
    merged = _running(served, ["part"], ["finish", "source_no", "key", "epoch"], "size")
    taken = merged.filter(F.col("upto") - F.col("size") / 2 <= total["words"]).groupBy("key").agg(
        F.count("*").alias("taken"))
    equal = Window.partitionBy("key")
    each = (queued.withColumn("nth", F.row_number().over(equal.orderBy("id")))
            .withColumn("rows", F.count("*").over(equal)).join(taken, "key", "left")
            .withColumn("taken", F.coalesce("taken", F.lit(0))))
    copies = F.floor(F.col("taken") / F.col("rows")) + (F.col("nth") <= F.col("taken") % F.col("rows")).cast("long")
    return each.select("id", "key", "nth", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        id_col: str = "doc_id") -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as the mix takes it, with all its columns."""
    wanted = plan(docs, weights, max_epochs, seed, id_col).filter("copies > 0").select(
        F.col("key").alias("_mix_key"), F.col("nth").alias("_mix_nth"), F.col("copies").alias("_mix_copies"))
    rows = docs.withColumn("_mix_key", row_key(id_col, seed))
    rows = rows.withColumn("_mix_nth", F.row_number().over(Window.partitionBy("_mix_key").orderBy(F.lit(1))))
    out = rows.join(wanted, ["_mix_key", "_mix_nth"]).withColumn(
        "_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))))
    return out.select(*[f"`{c}`" for c in docs.columns])
