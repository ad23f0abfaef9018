"""Mixing sources to target weights along a time-varying curriculum.

Every source has a target (its share of all words by weight, at most
``max_repeats`` times its size) and a schedule: its weight over training
time, linear between evenly spaced knots. The schedule's integral, scaled
to the target, is the source's cumulative demand. A source's documents
stand in a fixed random order and are gone through as often as the target
asks; a copy whose first word is the c-th of its source is due when the
demand reaches c, so inverting the demand gives its training position.
Sorting the copies by position by range yields the mix.

Running sums within a source are taken in two steps: within small hash
buckets, and over the buckets' totals. A hot source is many buckets, so no
task sees more than a few of them. The words taken need ids and sizes only; texts
are shuffled where the copies themselves are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagframe.llm.common import pick, positional, stage, word_count
from lagframe.plans.guards import broadcast_dimension

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
#: Weight at evenly spaced times of the training, by the source's place in the cycle.
SCHEDULES = ((1.0, 1.0, 1.0), (0.5, 1.0, 1.5), (1.5, 1.0, 0.5))
BUCKET_ROWS = 500   # rows of a bucket on average
SOURCE = "source_key"
#: What the mix is sorted by: training position, then the order within the source.
ORDER = ("mix_due", "mix_hash", "mix_copy")
TASK_BITS = 33      # row numbers of one task in monotonically_increasing_id


def source_key(column: str) -> Column:
    """Sources as text that sorts by code point with null last."""
    name = F.col(column).cast("string")
    return F.when(name.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), name))


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: source_size, n_docs, place, target; written.

    All words are shared out by weight; a target stops at ``max_repeats``
    times the source's size and the excess goes to the others by weight.
    At the end every target is the smaller of its limit and weight x level
    for one common level. The level rises round by round, as the sources that
    stand at their limits leave the excess to the others, until none is added;
    a round is one sum over the sources. Sources without words get 0.
    """
    sums = sized.groupBy(SOURCE).agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = number_rows(sums.repartitionByRange(SOURCE).sortWithinPartitions(SOURCE), "sources") \
        .withColumnRenamed("at", "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    limited = ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(max_repeats))
    level, full = 0.0, -1
    while True:
        at_limit = F.col("limit") <= F.col("weight") * level
        n, every, kept, free = limited.agg(
            F.count_if(at_limit), F.sum("source_size"), F.sum(F.when(at_limit, F.col("limit")).otherwise(0.0)),
            F.sum(F.when(at_limit, 0.0).otherwise(F.col("weight")))).first()
        if n == full or not free:
            break
        level, full = (every - kept) / free, n
    # with every source at its limit there is nothing left to share
    target = F.col("limit") if not free else F.least("limit", F.col("weight") * level)
    return limited.select(SOURCE, "source_size", "n_docs", "place", target.alias("target"))


def place_documents(rows: DataFrame, sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``rows`` (with size, row_hash and SOURCE) and ``first``: the words of the source
    before them in its random order.

    ``sized`` holds the same columns of the same rows, written, for the buckets' totals.
    """
    unit = F.pmod(F.xxhash64("row_hash", F.lit(17)), F.lit(1 << 40)) / float(1 << 40)
    buckets = F.ceil(F.col("n_docs") / F.lit(float(BUCKET_ROWS)))
    goals = targets.select(SOURCE, "source_size", "n_docs", "place", "target")

    def bucketed(df: DataFrame) -> DataFrame:
        return df.join(goals, SOURCE).withColumn("bucket", F.floor(unit * buckets))

    sums = bucketed(sized).groupBy(SOURCE, "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy(SOURCE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(sums.select(SOURCE, "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0))
                               .alias("bucket_first")), "buckets")
    inside = (Window.partitionBy(SOURCE, "bucket").orderBy("row_hash", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    summed = bucketed(rows).withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return (summed.join(starts, [SOURCE, "bucket"])
            .withColumn("first", F.col("bucket_first") + F.col("inside")).drop("bucket_first", "inside", "bucket"))


def copy_words(copy: int) -> Column:
    """Words taken of a document's n-th copy; a copy across the target is cut there."""
    start = F.col("source_size") * copy + F.col("first")
    left = F.round(F.col("target")).cast("long") - start
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))


def due_time(words: Column, schedules: tuple = SCHEDULES) -> Column:
    """Training time in [0, 1] at which the source's demand reaches ``words``."""
    out = F.lit(None).cast("double")
    share = F.when(F.col("target") > 0, F.least(F.lit(1.0), words / F.col("target"))).otherwise(0.0)
    for k, knots in enumerate(schedules):
        step = 1.0 / (len(knots) - 1)
        areas = [(a + b) / 2 * step for a, b in zip(knots, knots[1:])]
        total, done = sum(areas), 0.0
        due = F.lit(1.0)
        segments = []
        for i, area in enumerate(areas):
            # within a segment the demand is a*x + (b - a)*x*x/2 with x in steps
            a, slope = knots[i] * step, (knots[i + 1] - knots[i]) * step
            asked = F.greatest(F.lit(0.0), share * total - done)
            x = asked * 2 / (a + F.sqrt(F.greatest(F.lit(0.0), a * a + 2 * slope * asked))) if a or slope else F.lit(0.0)
            segments.append((done + area, (i + F.least(F.lit(1.0), x)) * step))
            done += area
        for end, value in reversed(segments):
            due = F.when(share * total <= end, value).otherwise(due)
        out = F.when(F.col("place") % len(schedules) == k, due).otherwise(out)
    return out


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, SOURCE and a hash that orders a source's documents."""
    rows = pick(docs, "doc_id", "source", "text")
    return rows.select("doc_id", source_key("source").alias(SOURCE), word_count(F.col("text")).alias("size"),
                       F.xxhash64("doc_id", "text").alias("row_hash"))


def taken_copies(placed: DataFrame, schedules: tuple = SCHEDULES) -> DataFrame:
    """Rows of ``placed``, one per copy the mix takes, with its words and the ORDER columns."""
    copies = F.array(*[F.struct(F.lit(k).alias("n"), copy_words(k).alias("words"),
                                due_time((F.col("source_size") * k + F.col("first")).cast("double"), schedules)
                                .alias("due")) for k in range(MAX_REPEATS)])
    return (placed.withColumn("copy", F.explode(F.filter(copies, lambda c: c["words"] > 0)))
            .withColumns({"words": F.col("copy.words"), "mix_due": F.col("copy.due"),
                          "mix_hash": F.col("row_hash"), "mix_copy": F.col("copy.n")}).drop("copy"))


def in_order(copies: DataFrame) -> DataFrame:
    """Rows with the ORDER columns, sorted by range into the order of training."""
    return copies.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)


def number_rows(rows: DataFrame, name: str) -> DataFrame:
    """Range-sorted ``rows`` with ``at``, their number from 0; written.

    A row's number within its task comes with the sorting; only the tasks'
    row counts are added up, one number a task.
    """
    numbered = stage(rows.withColumn("id", F.monotonically_increasing_id()), name) \
        .withColumn("task", F.shiftright("id", TASK_BITS))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = (numbered.groupBy("task").agg(F.count("*").alias("n"))
              .select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    inside = F.col("id").bitwiseAND(F.lit((1 << TASK_BITS) - 1))
    return (numbered.join(broadcast_dimension(stage(starts, "starts")), "task")
            .withColumn("at", F.col("start") + inside).drop("task", "start", "id"))


def taken_words(docs: DataFrame, schedules: tuple = SCHEDULES) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_due and first_order of every document.

    ``first_due`` is the training position in [0, 1] of the document's first
    copy, ``first_order`` the number of that copy in the whole mix, from 0;
    both are null where nothing is taken. Null and empty texts have size 0
    and nothing is taken of them; null sources are one source, the last.
    Repeated rows are documents of their own and stand next to each other.
    An empty table gives none.
    """
    sized = stage(sized_documents(docs), "sized")
    placed = stage(place_documents(sized, sized, source_targets(sized)), "placed")
    columns = ["doc_id", "size", "source_size", "target"]
    mix = number_rows(in_order(taken_copies(placed, schedules)), "mix")
    # rows with words differ in where they start within their source
    used = (mix.groupBy(*columns, SOURCE, "row_hash", "first")
            .agg(F.sum("words").alias("taken"), F.min("mix_due").alias("first_due"),
                 F.min("at").alias("first_order")))
    rest = placed.where(copy_words(0) <= 0).withColumns({
        "taken": F.lit(0).cast("long"), "first_due": F.lit(None).cast("double"),
        "first_order": F.lit(None).cast("long")})
    columns += ["taken", "first_due", "first_order"]
    return used.select(*columns).unionByName(rest.select(*columns))


def dated_documents(docs: DataFrame) -> DataFrame:
    """The copies the mix takes: all columns of ``docs`` and the ORDER columns, unsorted.

    A copy that the target cuts keeps its first words, one space between
    them; documents without words, null texts too, aren't taken. Null sources are one
    source; repeated rows and null doc_ids are documents of their own; an empty table
    gives none. Columns of ``docs`` named like ORDER, in any case, give way to those.
    Texts are counted twice, for the sizes and beside their row, and shuffled
    once, to the windows that place them.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ORDER]) \
        if any(c.lower() in ORDER for c in docs.columns) else docs
    at = positional(docs)
    names = {n: f"c{docs.columns.index(n)}" for n in ("doc_id", "source", "text")}
    counted = at.withColumns({SOURCE: source_key(names["source"]), "size": word_count(F.col(names["text"])),
                              "row_hash": F.xxhash64(names["doc_id"], names["text"])})
    sized = stage(counted.select(SOURCE, "size", "row_hash"), "sized")
    placed = place_documents(counted, sized, source_targets(sized))
    words = F.split(F.regexp_replace(names["text"], "^[\\x20\\x09-\\x0D]+", ""), "[\\x20\\x09-\\x0D]+")
    cut = F.array_join(F.slice(words, 1, F.greatest(F.lit(1), F.col("words").cast("int"))), " ")
    taken = (taken_copies(placed)
             .withColumn(names["text"], F.when(F.col("words") < F.col("size"), cut).otherwise(F.col(names["text"]))))
    return taken.select(*at.columns, *ORDER).toDF(*docs.columns, *ORDER)


def mix_documents(docs: DataFrame) -> DataFrame:
    """The copies of ``dated_documents``, its columns but ORDER, sorted by position."""
    dated = dated_documents(docs)
    at = positional(dated)
    order = at.columns[-len(ORDER):]
    sorted_ = at.repartitionByRange(*order).sortWithinPartitions(*order)
    return sorted_.select(*at.columns[:-len(ORDER)]).toDF(*dated.columns[:-len(ORDER)])
