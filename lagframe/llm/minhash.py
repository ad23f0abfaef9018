"""Near-duplicate groups by tensored MinHash banding with full verification.

A document is its set of distinct word shingles, as 64-bit hashes. Equal
sets are found by fingerprint first, so that thousands of copies count as
one from there on. For the rest two small collections of minhash groups are
computed, and every pair of one group from each forms a table key: with m
groups of r minhashes on either side, m * m tables of 2r minhashes come
from 2mr hash functions instead of 2rmm.

A bucket is never expanded into pairs. Each has one leader, and members are
compared with their leader on full sets. Only a document that isn't linked
to a leader of its is then compared with the other documents it shares a
table with, as far as their components differ and their sizes allow a link.
So all colliding pairs are decided, most of them without being listed.
Components come from label exchange over the links.

At 12 x 3 minhashes a side, a pair with similarity 0.8 shares a table with
probability 0.9996, one with 0.9 with 1 - 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagframe.llm.common import map_columns, number_lists, pick, positional, stage
from lagframe.plans.guards import broadcast_dimension

GROUPS = 12          # minhash groups on either side
GROUP_HASHES = 3     # minhashes of a group
BLOCK = 4096         # shingles hashed at once
WANTED_ROWS = 500_000   # ids broadcast at most (16 bytes each); beyond, the texts are shuffled to them
SKETCH_BITS = 1024   # of the parity sketch, a multiple of 64
SIGNATURE_SCHEMA = ("doc_id long, hash long, n_shingles long, sum_print long, xor_print long, "
                    "left array<long>, right array<long>")
PRINTS = ("n_shingles", "sum_print", "xor_print")

_SEEDS = np.random.default_rng(20240229).integers(1, 1 << 63, (2, 2 * GROUPS * GROUP_HASHES), dtype=np.uint64)
_XOR, _TIMES = _SEEDS[0][:, None], _SEEDS[1][:, None] | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; a shorter text is one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        out = out * _STEP + hashes[i:i + n]
    return np.unique(mix(out))


def minhash_groups(shingles: np.ndarray) -> np.ndarray:
    """Keys of the 2 x GROUPS minhash groups; a key also tells its group."""
    least = np.full(_XOR.shape[0], np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), BLOCK):
        least = np.minimum(least, ((shingles[at:at + BLOCK] ^ _XOR) * _TIMES).min(axis=1))
    keys = np.arange(2 * GROUPS, dtype=np.uint64)
    for column in least.reshape(2 * GROUPS, GROUP_HASHES).T:
        keys = mix(keys * _STEP + column)
    return keys


def prints(s: np.ndarray) -> tuple[int, int, int]:
    """Size of a shingle set and two numbers that tell it from others."""
    return (len(s), int(mix(s).sum(dtype=np.uint64).view(np.int64)),
            int(np.bitwise_xor.reduce(s).view(np.int64)) if len(s) else 0)


def hashed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the text's hash, which tells rows of one doc_id apart."""
    return pick(docs, "doc_id", "text").withColumn("hash", F.xxhash64("text"))


def sign(docs: DataFrame, width: int) -> DataFrame:
    """Size, fingerprint and minhash groups of every document; written."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        none = np.empty(0, dtype=np.uint64)
        for batch in batches:
            found, keys = [], []
            for text in batch["text"]:
                s = shingle_set(text, width)
                found.append(prints(s))
                keys.append(minhash_groups(s) if len(s) else none)
            yield ({"doc_id": batch["doc_id"], "hash": batch["hash"],
                    "left": number_lists([k[:GROUPS] for k in keys]), "right": number_lists([k[GROUPS:] for k in keys])}
                   | {n: [f[i] for f in found] for i, n in enumerate(PRINTS)})

    return stage(map_columns(hashed(docs), work, SIGNATURE_SCHEMA), "signatures")


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the set in each of SKETCH_BITS cells, as longs.

    Two sketches differ in at most as many bits as the sets differ in
    shingles: a bound that never rules out a link.
    """
    cells = np.bincount((shingles & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64)


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node, shingles, sketch of each class in ``wanted`` (node, doc, hash and prints); written.

    The text is taken from one row of the class's doc_id and text hash.
    """

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            found = [(node, s) for node, t, *p in zip(*(batch[c] for c in ("node", "text", *PRINTS)), strict=True)
                     if prints(s := shingle_set(t, width)) == tuple(p)]
            yield {"node": [n for n, _ in found], "shingles": number_lists([s for _, s in found]),
                   "sketch": number_lists([parity_sketch(s) for _, s in found])}

    wanted = broadcast_dimension(wanted.withColumnRenamed("hash", "text_hash"), WANTED_ROWS)
    texts = hashed(docs)
    rows = (texts.join(wanted, (texts["doc_id"] == wanted["doc"]) & (texts["hash"] == wanted["text_hash"]))
            .dropDuplicates(["node"]))
    return stage(map_columns(rows.select("node", "text", *PRINTS), work,
                             "node long, shingles array<long>, sketch array<long>"), "sets")


def active_documents(classes: DataFrame) -> DataFrame:
    """node, n_shingles and those groups that another class has too; written.

    Only a group that two classes share can be part of a table key that
    they share, so all others are left out before keys are formed: most
    documents share none on one of the sides and have no key at all.
    """
    groups = classes.select("node", F.explode(F.concat(
        F.transform("left", lambda g: F.struct(F.lit(True).alias("is_left"), g.alias("g"))),
        F.transform("right", lambda g: F.struct(F.lit(False).alias("is_left"), g.alias("g"))))).alias("x")) \
        .select("node", "x.is_left", "x.g")
    shared = stage(groups.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"), "shared")
    sides = [F.array_sort(F.collect_list(F.when(c, F.col("g")))) for c in (F.col("is_left"), ~F.col("is_left"))]
    found = (groups.join(shared, "g").groupBy("node").agg(sides[0].alias("left"), sides[1].alias("right"))
             .where("size(left) > 0 and size(right) > 0"))
    return stage(classes.select("node", "n_shingles").join(found, "node"), "active")


def bucket_members(active: DataFrame) -> DataFrame:
    """node, leader of every member of a bucket with two classes or more; written.

    A table key combines a left with a right group. The leader is the least
    member: one long per key, combined before the shuffle. A document has
    the same leader in many tables, so few pairs are left to compare.
    """
    keys = (active.select("node", F.explode("left").alias("x"), "right")
            .select("node", "x", F.explode("right").alias("y"))
            .select("node", F.xxhash64("x", "y").alias("key")))
    leaders = keys.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    leaders = stage(leaders.select("key", "leader"), "leaders")
    return stage(keys.join(leaders, "key").select("node", "leader").distinct(), "members")


def shared_shingles(sets: DataFrame) -> DataFrame:
    """node, n_own: how many of its shingles no other of the documents has; written."""
    once = (sets.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle")
            .agg(F.min("node").alias("node"), F.max("node").alias("last")).where("node = last"))
    return stage(once.groupBy("node").agg(F.count("*").alias("n_own")), "own")


def unsettled_pairs(active: DataFrame, unlinked: DataFrame, components: DataFrame, sets: DataFrame,
                    percent: int) -> DataFrame:
    """a, b of the colliding pairs that the leaders left open; written.

    A link within a bucket joins two members of its leader's component, or
    one of them isn't linked to the leader. So it's enough to compare the
    latter with whatever they share a table with outside their component.
    A link needs an intersection of at least percent / (100 + percent) of
    both sizes together, and neither document can bring more to it than the
    shingles that any other document has; nor may their parity sketches
    differ in more bits than the sets of a link in shingles. Pairs meet at the first left group
    they have in common, so each comes up once however many tables it shares.
    """
    known = (active.join(components, "node", "left")
             .join(unlinked.withColumn("open", F.lit(True)), "node", "left")
             .join(shared_shingles(sets), "node", "left").join(sets.select("node", "sketch"), "node")
             .select("node", "n_shingles", (F.col("n_shingles") - F.coalesce("n_own", F.lit(0))).alias("n_shared"),
                     "left", "right", *[F.col("sketch")[i].alias(f"s{i}") for i in range(SKETCH_BITS // 64)],
                     F.coalesce("component", "node").alias("component"),
                     F.coalesce("open", F.lit(False)).alias("open"))
             .where(f"100 * n_shared >= {percent} * n_shingles"))
    rows = stage(known, "known").withColumn("g", F.explode("left"))
    differ = " + ".join(f"bit_count(u.s{i} ^ r.s{i})" for i in range(SKETCH_BITS // 64))
    pairs = rows.where("open").alias("u").join(rows.alias("r"), F.expr(f"""u.g = r.g and u.component <> r.component
        and (not r.open or u.node < r.node)
        and 100 * least(u.n_shingles, r.n_shingles) >= {percent} * greatest(u.n_shingles, r.n_shingles)
        and {100 + percent} * least(u.n_shared, r.n_shared) >= {percent} * (u.n_shingles + r.n_shingles)
        and {100 + percent} * ({differ}) <= {100 - percent} * (u.n_shingles + r.n_shingles)
        and array_min(array_intersect(u.left, r.left)) = u.g and arrays_overlap(u.right, r.right)"""))
    return stage(pairs.select(F.expr("least(u.node, r.node) a"), F.expr("greatest(u.node, r.node) b")), "unsettled")


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, common and total (sizes of intersection and union) of each pair; written."""
    sides = [sets.select(F.col("node").alias(c), F.col("shingles").alias(f"of_{c}")) for c in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    return stage(both.select("a", "b", common.alias("common"),
                             (F.size("of_a") + F.size("of_b") - common).alias("total")), "compared")


def connected(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) of every node with a link.

    Each round a node takes the least label around it and then that label's
    label; every round's labels are written, so no lineage grows.
    """
    edges = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                         .alias("e")).select("e.a", "e.b")
    labels = stage(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        around = (edges.join(labels, edges["b"] == labels["node"]).groupBy("a")
                  .agg(F.min("component").alias("around")))
        near = stage(labels.join(around, labels["node"] == around["a"])
                     .select("node", F.col("component").alias("old"),
                             F.least("component", "around").alias("component")), "labels")
        up = near.select(F.col("node").alias("parent"), F.col("component").alias("grand"))
        labels = stage(near.join(up, near["component"] == up["parent"], "left")
                       .select("node", "old", F.least("component", "grand").alias("component")), "labels")
        if labels.where("component < old").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")


def grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, hash and n_shingles of every row, with component and class (null without shingles); written.

    Rows of equal shingle sets are a class, numbered apart from doc_ids: rows
    that share a doc_id but not their shingles are in classes of their own.
    """
    signed = sign(docs, width)
    # the numbers stand as the table is written at once
    classes = stage(signed.where("n_shingles > 0").groupBy(*PRINTS)
                    .agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "hash"))).alias("row"),
                         F.first("left").alias("left"), F.first("right").alias("right")).where("row is not null")
                    .select(*PRINTS, F.col("row.doc_id").alias("doc"), F.col("row.hash").alias("hash"), "left", "right")
                    .withColumn("node", F.monotonically_increasing_id()), "classes")
    active = active_documents(classes)
    members = bucket_members(active)
    wanted = stage(classes.select("node", "doc", "hash", *PRINTS).join(members.select("node").distinct(), "node"), "wanted")
    sets = full_sets(docs, wanted, width)
    linked = F.expr(f"100 * common >= {percent} * total")
    compared = compare(members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")), sets)
    links = compared.where(linked).select("a", "b")
    components = connected(links)
    unlinked = stage(compared.where(~linked).select(F.col("b").alias("node")).distinct(), "unlinked")
    more = compare(unsettled_pairs(active, unlinked, components, sets, percent), sets).where(linked).select("a", "b")
    if not more.isEmpty():
        components = connected(links.unionByName(more))
    chosen = classes.select(*PRINTS, "node").join(components, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    return stage(signed.select("doc_id", "hash", *PRINTS).join(chosen, list(PRINTS), "left"), "grouped")


def near_duplicates(docs: DataFrame, width: int, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Documents are linked when 100 * intersection >= percent * union of their
    shingle sets; component_id is the least doc_id reachable. Null, empty
    and wordless texts have no shingles, are linked with nothing and stay.
    Rows that repeat a doc_id are each judged by their own text. A row without doc_id
    can only equal another text: it belongs to that text's component, or to none
    and is kept. An empty table gives none.
    """
    found = grouped(docs, width, percent)
    least = (found.where("component is not null and doc_id is not null").groupBy("component")
             .agg(F.min("doc_id").alias("component_id")))
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (found.join(least, "component", "left").withColumn("component_id", component)
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept")))


def keep_first(docs: DataFrame, width: int, percent: int = 80) -> DataFrame:
    """One document of each near-duplicate group, with all columns.

    That of the least doc_id stays, of several texts under it that of the
    least hash. Rows that repeat a doc_id and its text are one document; another
    text under the same doc_id is another document and judged by itself. Texts
    without words have no duplicates but such repeats. Rows without a doc_id all stay;
    an empty table gives none.
    """
    found = grouped(docs, width, percent).where("doc_id is not null")
    keepers = (found.where("component is not null").groupBy("component")
               .agg(F.min(F.struct("doc_id", "hash")).alias("keeper")))
    judged = stage(found.join(keepers, "component", "left").groupBy("doc_id", "hash")
                   .agg(F.first(F.coalesce(F.struct("doc_id", "hash") == F.col("keeper"), F.lit(True))).alias("kept"),
                        F.count("*").alias("n")), "judged")
    at = positional(docs)
    key, text = (f"c{docs.columns.index(n)}" for n in ("doc_id", "text"))
    at = at.withColumn("row_hash", F.xxhash64(text))

    def rows_of(which: str, name: str) -> tuple[DataFrame, Column]:
        some = stage(judged.where(which).select(F.col("doc_id").alias("of_doc"), F.col("hash").alias("of_hash")), name)
        return (broadcast_dimension(some, WANTED_ROWS),
                (F.col(key) == F.col("of_doc")) & (F.col("row_hash") == F.col("of_hash")))

    gone, is_gone = rows_of("not kept", "gone")
    out = at.join(gone, is_gone, "left_anti")
    again, is_again = rows_of("kept and n > 1", "again")
    if not again.isEmpty():
        out = (out.join(again, is_again, "left_anti")
               .unionByName(out.join(again, is_again, "left_semi").dropDuplicates([key, "row_hash"])))
    return out.drop("row_hash").toDF(*docs.columns)
