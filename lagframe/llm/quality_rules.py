"""Quality rules whose cutoffs are certified on labelled holdouts.

Every document gets five counts over its whole text. A document fails the
base rules outright when it is too short or repeats itself too much. The other
rules have no fixed cutoff: on a fixed grid of their statistics, each
stratum (language) gets one vector of cutoffs, and the vector is admitted
only if the exact binomial bound shows, at a level corrected for the number
of strata, that all rules together reject no more than the allowed share of
good documents. The vectors tried are a sequence fixed beforehand, by the
bad labels and a small part of the good ones that the bound doesn't use.
Each rejects what the one before does and more. The trial stops at the first
that can't be certified, so that neither the rules nor the sequence need
further correction. Of the certified vectors the one that best parts bad
from good is used, or none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagframe.llm.common import SPACES, map_columns, pick, positional, prepare, stage
from lagframe.plans.guards import broadcast_dimension

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"

#: Rules: share of bad signs in thousandths, over which a document is rejected.
RULES = {
    "symbols": "1000 * n_symbols / greatest(word_chars, 1)",
    "dup_lines": "1000 * n_dup_lines / greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words / greatest(n_words, 1)",
    "long_words": "100 * word_chars / greatest(n_words, 1)",
    "short": "1000 * 20 / greatest(n_words, 20)",
}
GRID = 100          # cutoffs tried per rule, evenly spaced up to the top
GRID_TOP = {"symbols": 1000, "dup_lines": 1000, "repeats": 1000, "long_words": 3000, "short": 1000}
MAX_FALSE_REJECTION = 0.02
MISTAKE_PROBABILITY = 0.05
PLAN_PARTS = 6      # every sixth good label plans the sequence, the others certify it
CUTOFF_ROWS = 500_000  # strata whose cutoffs are broadcast; beyond that the join shuffles
NEVER = 1 << 30

COUNTS_SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                 "n_repeat_words long, n_lines long")
COUNT_NAMES = [c.split()[0] for c in COUNTS_SCHEMA.split(", ")]


def repeat_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of words occurring twice or more.

    Windows are compared exactly: a word is its number among the text's
    words, and windows are numbered from pairs of numbered halves.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    if len(seen) > len(words) - window:
        return 0
    size, distinct = 1, len(seen)
    while size < window:
        step = min(size, window - size)
        codes = codes[:len(codes) - step] * distinct + codes[step:]
        size += step
        if size == window or distinct ** 2 > 1 << 31:
            codes = np.unique(codes, return_inverse=True)[1].astype(np.int64)
            distinct = int(codes.max()) + 1
        else:
            distinct *= distinct
    often = np.flatnonzero(np.bincount(codes)[codes] > 1)
    if not len(often):
        return 0
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, often, 1)
    np.add.at(edges, often + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)))


def text_counts(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of a whole text."""
    if not text:
        return (0,) * len(COUNT_NAMES)
    data = text.encode()
    words = data.split()
    visible = data.translate(None, SPACES)
    chars = len(text) - (len(data) - len(visible))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.translate(None, SPACES)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words), len(lines)


def count_texts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` (columns without text) and the counts of every whole text."""
    types = dict(docs.dtypes)

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            rows = [text_counts(x) for x in batch["text"]]
            yield {c: batch[c] for c in keep} | {n: [r[i] for r in rows] for i, n in enumerate(COUNT_NAMES)}

    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keep), COUNTS_SCHEMA])
    return map_columns(docs.select(*keep, "text"), work, schema)


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")


def grid_index(rule: str) -> Column:
    """Grid cell of a rule's statistic; a cutoff c rejects the cells from c on."""
    cell = F.expr(f"cast(floor(({RULES[rule]}) * {GRID} / {GRID_TOP[rule]}) as int)")
    return F.least(cell, F.lit(GRID))


def binomial_tail(k: int, n: int, p: float) -> float:
    """Exact P(X <= k) of a binomial variable."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def allowed_losses(n: int, share: float, level: float) -> int:
    """The most rejected of ``n`` good documents that refute, at ``level``, that
    more than ``share`` of all good ones are rejected; -1 if none would."""
    low, high = -1, n - 1
    while low < high:
        k = (low + high + 1) // 2
        low, high = (k, high) if binomial_tail(k, n, share) <= level else (low, k - 1)
    return low


def plan_sequence(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """The step at which each rule rejects each cell, from counts by rule and cell.

    One step lowers one rule's cutoff as far as it gains most bad documents
    for the good ones it costs; steps that gain none are left out (NEVER).
    """
    steps = np.full(good.shape, NEVER, dtype=np.int64)
    at = [good.shape[1]] * len(good)
    step = 0
    while True:
        best = None
        for r, end in enumerate(at):
            lost = np.cumsum(good[r, end - 1:0:-1])
            gain = np.cumsum(bad[r, end - 1:0:-1])
            if not len(gain) or not gain[-1]:
                continue
            # half a document is added to the cost, so that a free step with more gain comes first
            rate = gain / (lost + 0.5)
            k = int(np.argmax(rate))
            if best is None or rate[k] > best[0]:
                best = rate[k], r, end - 1 - k
        if best is None:
            return steps
        _, r, cell = best
        steps[r, cell:at[r]] = step
        at[r], step = cell, step + 1


def certify(good: np.ndarray, bad: np.ndarray, share: float, level: float) -> int | None:
    """The last step of the sequence to take, from the documents first rejected at each.

    The last entry counts those never rejected. Steps are certified in
    their order up to the first whose joint rejection is not refuted to be
    over ``share``.
    """
    n_good, n_bad = int(good.sum()), int(bad.sum())
    if not n_good or not n_bad:
        return None
    lost, caught = np.cumsum(good[:-1]), np.cumsum(bad[:-1])
    certified = int(np.searchsorted(lost, allowed_losses(n_good, share, level), side="right"))
    gain = caught[:certified] / n_bad - lost[:certified] / n_good
    return int(np.argmax(gain)) if certified and gain.max() > 1e-12 else None


def planned(key: tuple, rows: pa.Table) -> pa.Table:
    """The sequence of one stratum: by rule, the step of each cell."""
    good, bad = (np.zeros((len(RULES), GRID + 1), dtype=np.int64) for _ in range(2))
    rule, cell = (rows[n].to_numpy() for n in ("rule", "cell"))
    np.add.at(good, (rule, cell), rows["good"].to_numpy())
    np.add.at(bad, (rule, cell), rows["bad"].to_numpy())
    return pa.table({"stratum": pa.array([key[0].as_py()], pa.string()),
                     "steps": pa.array([plan_sequence(good, bad).tolist()], pa.list_(pa.list_(pa.int32())))})


def fit_cutoffs(counts: DataFrame, labels: DataFrame, max_false_rejection: float = MAX_FALSE_REJECTION,
                mistake_probability: float = MISTAKE_PROBABILITY) -> DataFrame:
    """stratum, n_good (labels the bound rests on) and cutoffs (a cell by rule,
    null if uncertified) of every labelled stratum; written.

    ``counts`` has doc_id, stratum and the counts. A doc_id labelled more
    than once counts once, as good if any label says so; null labels and
    labels without a document don't count. Documents that fail the base
    rules are out already and are left aside. Every stratum is fitted by
    itself, one small group of rules x cells numbers each, however many
    there are.
    """
    prepare(counts.sparkSession)
    known = (pick(labels, "doc_id", "quality").where("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    cells = F.array(*[grid_index(r) for r in RULES])
    plans = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(PLAN_PARTS)) == 0
    held = stage(counts.where(~base_failed()).join(known, "doc_id")
                 .select("stratum", cells.alias("cells"), (F.col("quality") > 0).alias("good"), plans.alias("plans"))
                 .groupBy("stratum", "cells")
                 .agg(F.count_if(F.col("good") & F.col("plans")).alias("good_planning"),
                      F.count_if(F.col("good") & ~F.col("plans")).alias("good"),
                      F.count_if(~F.col("good")).alias("bad")), "held")
    strata = held.select("stratum").distinct().count()
    level = mistake_probability / max(1, strata)
    tables = (held.select("stratum", "good_planning", "bad", F.posexplode("cells").alias("rule", "cell"))
              .groupBy("stratum", "rule", "cell")
              .agg(F.sum("good_planning").alias("good"), F.sum("bad").alias("bad")))
    plan = stage(tables.groupBy("stratum").applyInArrow(planned, "stratum string, steps array<array<int>>"), "plan")
    first = F.array_min(F.zip_with("steps", "cells", lambda steps, cell: F.get(steps, cell)))
    reached = (held.join(plan, "stratum").groupBy("stratum", first.alias("step"))
               .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))

    def chosen(key: tuple, rows: pa.Table) -> pa.Table:
        order = np.argsort(rows["step"].to_numpy())
        step, good, bad = (rows[n].to_numpy()[order] for n in ("step", "good", "bad"))
        if step[-1] != NEVER:
            step, good, bad = (np.append(x, y) for x, y in ((step, NEVER), (good, 0), (bad, 0)))
        last = certify(good, bad, max_false_rejection, level)
        return pa.table({"stratum": pa.array([key[0].as_py()], pa.string()),
                         "n_good": pa.array([int(good.sum())], pa.int64()),
                         "last": pa.array([None if last is None else int(step[last])], pa.int32())})

    found = reached.groupBy("stratum").applyInArrow(chosen, "stratum string, n_good long, last int")
    # a rule's cutoff is the least of its cells rejected by then
    cutoffs = F.transform("steps", lambda steps: F.size(F.filter(steps, lambda x: x > F.col("last"))))
    return stage(found.join(plan, "stratum")
                 .select("stratum", "n_good", F.when(F.col("last").isNotNull(), cutoffs).alias("cutoffs")), "cutoffs")


def kept(rows: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``rows`` with stratum and counts, and ``kept``: whether each passes.

    Strata without labels or without certified cutoffs have the base rules only.
    """
    limits = cutoffs.where("cutoffs is not null").select(F.col("stratum").alias("limits_of"), "cutoffs")
    passes = F.lit(True)
    for i, rule in enumerate(RULES):
        passes = passes & (grid_index(rule) < F.col("cutoffs")[i])
    return (rows.join(broadcast_dimension(limits, CUTOFF_ROWS), F.col("stratum") == F.col("limits_of"), "left")
            .withColumn("kept", ~base_failed() & F.coalesce(passes, F.lit(True)))
            .drop("limits_of", "cutoffs"))


def stratum_of(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def rule_counts(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum and the counts of every document, as a written table."""
    parts = pick(docs, "doc_id", stratum, "text").select("doc_id", stratum_of(stratum).alias("stratum"), "text")
    return stage(count_texts(parts, ["doc_id", "stratum"]), "counts")


def judge_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, the counts, base_failed and kept of every document.

    Null and empty texts have no words and fail the base rules. Repeated
    rows are judged each on its own. A null stratum is a stratum. Without
    labels only the base rules decide; an empty table gives none.
    """
    counts = rule_counts(docs, stratum)
    cutoffs = fit_cutoffs(counts, labels)
    return kept(counts.withColumn("base_failed", base_failed()), cutoffs)


def keep_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    Texts are counted once, beside their row, and written with the counts;
    the cutoffs are fitted and applied to the written table. Null and empty
    texts fail the base rules; repeated rows are judged each on its own, a
    null doc_id or stratum like any other; an empty table gives none.
    """
    prepare(docs.sparkSession)
    at = positional(docs)
    text, group, doc_id = (f"c{docs.columns.index(n)}" for n in ("text", stratum, "doc_id"))

    @F.arrow_udf(COUNTS_SCHEMA)
    def counted(texts: pa.Array) -> pa.Array:
        rows = [text_counts(x) for x in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.int64())
                                           for i in range(len(COUNT_NAMES))], COUNT_NAMES)

    rows = stage(at.withColumn("counts", counted(text)).withColumn("stratum", stratum_of(group)), "counted")
    cutoffs = fit_cutoffs(rows.select(F.col(doc_id).alias("doc_id"), "stratum", "counts.*"), labels)
    return (kept(rows.select(*at.columns, "counts.*", "stratum"), cutoffs).where("kept")
            .select(*at.columns).toDF(*docs.columns))
