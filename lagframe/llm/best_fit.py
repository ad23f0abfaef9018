"""Bulk-synchronous best-fit packing of documents into sequences.

Texts are encoded once; from then on only pieces (sizes and checksums) move.
Pieces longer than half a sequence open one each. The others follow in
classes of size, the largest first. A round of a class works in steps that
all tasks take together:

* sequences offer the room they have left as gaps, one for each piece that
  surely fits, and a smaller one of what remains;
* pieces and gaps are sorted by range, from large to small, a gap before the
  pieces of its size;
* each task sweeps its range: a piece takes the tightest gap still open before
  it. Among pieces after the same gap the rank decides: the first in order gets
  it, the next one the successor;
* what a task leaves open, gaps and pieces in their order, is matched across
  tasks by the numbers left in each of them;
* rooms are updated, and the pieces without a gap go on to the next round.

Counts by size tell beforehand how many pieces a round can place. Where some
would stay behind, classes of at most 1/k of a sequence open new ones, k pieces
each, in the same round; smaller pieces try what is left first. A round shuffles
the pieces of one class and as many gaps as they can need, never texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from lagframe.llm.common import map_columns, pick, prepare, stage
from lagframe.llm.tokens import encoder

SEQUENCE_TOKENS = 2048
END_ID = 0
# Classes of at most 1/k of a sequence for k up to this; then halves.
WHOLE_PARTS = 7
SMALLEST_CLASS = 32
# Small pieces that stay behind try again as long as a round places this share of them.
LEAST_PLACED = 0.1
# Or as long as they need more than this share of all sequences.
FEW_SEQUENCES = 0.001

PIECE_COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32")
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
GAP_SCHEMA = "sequence_id long, room long, slot long"
EVENT_SCHEMA = f"width long, is_gap boolean, {PIECE_SCHEMA}, {GAP_SCHEMA}"
SWEPT_SCHEMA = f"state string, part int, at long, {PIECE_SCHEMA}, {GAP_SCHEMA}"


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """The pieces of every document; only one longer than ``capacity`` has several."""

    def cut(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        with encoder(tokenizer) as code:
            for batch in batches:
                rows = []
                for doc_id, ids in zip(batch["doc_id"], code.encode(batch["text"], end_id), strict=True):
                    bounds = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                    rows += [(doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                             for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
                yield {n: [r[i] for r in rows] for i, n in enumerate(PIECE_COLUMNS)}

    return stage(map_columns(pick(docs, "doc_id", "text"), cut, PIECE_SCHEMA), "pieces")


def size_classes(capacity: int) -> list[tuple[int, int, int | None]]:
    """(over, up to, pieces a new sequence takes at most) of every class; None: as their sizes allow."""
    uppers = [(capacity // k, k) for k in range(2, WHOLE_PARTS + 1)]
    top = capacity // (WHOLE_PARTS + 1)
    while top > SMALLEST_CLASS:
        uppers.append((top, None))
        top //= 2
    uppers.append((top, None))
    bounds = [u for u, _ in uppers[1:]] + [0]
    return [(low, up, k) for low, (up, k) in zip(bounds, uppers) if low < up]


def offered_slots(rooms: dict[int, int], pieces: int, widest: int) -> list[int]:
    """Slots of ``widest`` that a sequence offers, by its room.

    The smallest rooms offer first, all they have, until every piece has
    a slot; those of the last level share what is still needed.
    """
    slots, needed = [0] * (max(rooms, default=0) + 1), pieces
    for room in sorted(rooms):
        if needed > 0 and room >= widest:
            slots[room] = min(room // widest, -(-needed // rooms[room]))
            needed -= slots[room] * rooms[room]
    return slots


def gap_widths(rooms: dict[int, int], slots: list[int], least: int, widest: int) -> dict[int, int]:
    """Gaps on offer by width: those that ``gaps_of`` gives."""
    out = {widest: sum(slots[room] * n for room, n in rooms.items())}
    last = last_offer(slots)
    for room, n in rooms.items():
        if room <= last and slots[room] == room // widest and room % widest >= least:
            out[room % widest] = out.get(room % widest, 0) + n
    return out


def last_offer(slots: list[int]) -> int:
    """The largest room that offers gaps; every room if none has a full slot."""
    return max((room for room, n in enumerate(slots) if n), default=len(slots))


def left_behind(sizes: dict[int, int], widths: dict[int, int]) -> dict[int, int]:
    """Pieces by size that a sweep over these gaps can't place."""
    out, free = {}, 0
    for width in sorted({*sizes, *widths}, reverse=True):
        free += widths.get(width, 0)
        n = sizes.get(width, 0)
        if n > free:
            out[width] = n - free
        free = max(0, free - n)
    return out


def gaps_of(rooms: DataFrame, slots: list[int], least: int, widest: int) -> DataFrame:
    """The gaps on offer: full slots, and the rest of a room where a piece may fit it.

    A room beyond those that offer a full slot offers nothing; one too small
    for a full slot offers itself.
    """
    offered = F.expr(f"element_at(array({','.join(map(str, slots))}), cast(room + 1 as int))")
    wide = rooms.where(f"room between {least} and {last_offer(slots)}").withColumn("n", offered)
    full = wide.where("n > 0").select(F.lit(widest).cast("long").alias("width"), "sequence_id", "room",
                                      F.explode(F.expr("sequence(1L, cast(n as bigint))")).alias("slot"))
    rest = wide.where(f"n = room div {widest}").select(
        F.expr(f"room % {widest}").cast("long").alias("width"), "sequence_id", "room", F.lit(0).cast("long").alias("slot"))
    return full.unionByName(rest.where(f"width >= {least}"))


def nearest_open(is_gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces and the gaps they take, pieces left, gaps left, by position.

    A piece takes the last gap before it that no earlier piece has taken, as
    brackets close. Brackets of one depth take turns, so sorting by depth
    puts each piece behind its gap.
    """
    level = np.cumsum(np.where(is_gap, 1, -1))
    low = np.minimum.accumulate(np.minimum(level, 0))
    alone = ~is_gap & (level < np.concatenate([[0], low[:-1]]))
    depth = level - low + ~is_gap
    at = np.flatnonzero(~alone)
    at = at[np.argsort(depth[at], kind="stable")]
    follows = is_gap[at[:-1]] & ~is_gap[at[1:]] & (depth[at[:-1]] == depth[at[1:]])
    pieces, gaps = at[1:][follows], at[:-1][follows]
    open_gap = is_gap.copy()
    open_gap[gaps] = False
    return pieces, gaps, np.flatnonzero(alone), np.flatnonzero(open_gap)


def sweep(events: DataFrame) -> DataFrame:
    """Pairs found within each range, and what the range leaves open in its order; written."""
    out = to_arrow_schema(StructType.fromDDL(SWEPT_SCHEMA))
    of_piece, of_gap = list(PIECE_COLUMNS), ["sequence_id", "room", "slot"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows, part = pa.Table.from_batches(batches), TaskContext.get().partitionId()
        pieces, gaps, pieces_left, gaps_left = nearest_open(rows["is_gap"].to_numpy())
        for state, piece, gap, n in (("pair", pieces, gaps, len(pieces)), ("piece", pieces_left, None, len(pieces_left)),
                                     ("gap", None, gaps_left, len(gaps_left))):
            columns = {"state": pa.array([state] * n, pa.string()), "part": pa.array(np.full(n, part), pa.int32()),
                       "at": pa.array(np.arange(n), pa.int64())}
            for names, which in ((of_piece, piece), (of_gap, gap)):
                for name in names:
                    kind = out.field(name).type
                    columns[name] = pa.nulls(n, kind) if which is None else rows[name].take(pa.array(which))
            yield from pa.table(columns, schema=out).to_batches()

    # from wide to narrow; gaps come first, those of the smaller room last, so that they are taken first
    order = [F.desc("width"), F.desc("is_gap"), F.desc("room"),
             *map(F.asc, ("sequence_id", "slot", "doc_id", "piece", "ids_crc32"))]
    ordered = events.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ordered.mapInArrow(run, SWEPT_SCHEMA), "swept")


def across(left: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Matches between ranges, from (part, pieces left, gaps left) of each.

    (part, first, n, gap_part, top): the pieces first to first + n - 1 of
    ``part`` take the gaps top, top - 1, ... of ``gap_part``. At most two a range.
    """
    out, stack = [], []
    for part, pieces, gaps in sorted(left):
        first = 0
        while first < pieces and stack:
            gap_part, m = stack.pop()
            n = min(m, pieces - first)
            out.append((part, first, n, gap_part, m - 1))
            first += n
            if n < m:
                stack.append((gap_part, m - n))
        if gaps:
            stack.append((part, gaps))
    return out


def match(pieces: DataFrame, gaps: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Pieces with the gap they take, pieces left, and the number of the former."""
    spark = pieces.sparkSession
    fields = [c.split() for c in EVENT_SCHEMA.split(", ")]

    def event(df: DataFrame, **known) -> DataFrame:
        have = {**known, **{c: F.col(c) for c in df.columns}}
        return df.select(*[have.get(n, F.lit(None)).cast(t).alias(n) for n, t in fields])

    events = event(pieces, width=F.col("length"), is_gap=F.lit(False)).unionByName(event(gaps, is_gap=F.lit(True)))
    swept = sweep(events)
    totals = {(r["part"], r["state"]): r["count"] for r in swept.groupBy("part", "state").count().collect()}
    parts = {p for p, _ in totals}
    links = across([(p, totals.get((p, "piece"), 0), totals.get((p, "gap"), 0)) for p in parts])
    columns = [*PIECE_COLUMNS, "sequence_id", "room", "slot"]
    found = swept.where("state = 'pair'").select(*columns)
    left = swept.where("state = 'piece'")
    n = sum(v for (_, state), v in totals.items() if state == "pair")
    if links:
        # two rows a range at most
        near = F.broadcast(spark.createDataFrame(links, "in_part int, first long, n long, gap_part int, top long"))
        left = left.select("part", "at", *PIECE_COLUMNS).join(
            near, (F.col("part") == F.col("in_part")) & (F.col("at") >= F.col("first"))
            & (F.col("at") < F.col("first") + F.col("n")), "left").withColumn("gap_at", F.expr("top - (at - first)"))
        taken = swept.where("state = 'gap'").select(F.col("part").alias("gap_part"), F.col("at").alias("gap_at"),
                                                    "sequence_id", "room", "slot")
        found = found.unionByName(left.where("gap_part is not null").join(taken, ["gap_part", "gap_at"]).select(*columns))
        left = left.where("gap_part is null")
        n += sum(link[2] for link in links)
    return found, left.select(*PIECE_COLUMNS), n


def settle(found: DataFrame, capacity: int) -> DataFrame:
    """Pieces with their place: those of one sequence behind each other; written."""
    before = Window.partitionBy("sequence_id").orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.lit(capacity) - F.col("room") + F.coalesce(F.sum("length").over(before), F.lit(0))
    return stage(found.select(*PIECE_COLUMNS, "sequence_id", offset.cast("long").alias("offset")), "placed")


def histogram(df: DataFrame, column: str) -> dict[int, int]:
    """Rows by value of a column of whole numbers up to the sequence length."""
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


def pack_best_fit(docs: DataFrame, tokenizer: str, sequence_tokens: int = SEQUENCE_TOKENS,
                  end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents, each with its place in one of few sequences.

    ``docs`` has doc_id and text; other columns are ignored. Null and empty
    texts are documents of ``end_id`` alone; a null doc_id stays null, and
    repeated rows are packed each on its own. An empty table gives none.
    Only documents longer than a sequence are cut; their first piece may be
    shorter, the others fill a sequence each. Ties of size go by doc_id,
    piece and checksum, so a rerun packs alike up to the numbers of the sequences.
    The driver holds counts by size, at most ``sequence_tokens`` of them, and two
    counts a range.
    """
    spark = prepare(docs.sparkSession)
    pieces = cut_documents(docs, tokenizer, sequence_tokens, end_id)
    half = sequence_tokens // 2
    # written at once, so the numbers stand; a task that is run again writes its file anew
    placed = [stage(pieces.where(f"length > {half}").withColumn("sequence_id", F.monotonically_increasing_id())
                    .withColumn("offset", F.lit(0).cast("long")), "placed")]
    rooms = placed[0].select("sequence_id", (F.lit(sequence_tokens) - F.col("length")).alias("room")).where("room > 0")
    opened, sizes = 0, histogram(pieces.where(f"length <= {half}"), "length")
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    few = int(FEW_SEQUENCES * tokens / sequence_tokens)
    for low, high, most in size_classes(sequence_tokens):
        left, counts = pieces.where(f"length > {low} and length <= {high}"), {s: n for s, n in sizes.items() if low < s <= high}
        tried = False
        while counts:
            n, least, widest = sum(counts.values()), min(counts), max(counts)
            levels = histogram(rooms.where(f"room >= {least}"), "room")
            slots = offered_slots(levels, n, widest)
            behind = left_behind(counts, gap_widths(levels, slots, least, widest))
            placeable = n - sum(behind.values())
            total = sum(s * m for s, m in behind.items())
            new = -(-sum(behind.values()) // most) if most else -(-total // sequence_tokens)
            if behind and (most or tried or placeable < LEAST_PLACED * n or new <= 1 + few):
                added = spark.range(-opened - new, -opened).select(F.col("id").alias("sequence_id"),
                                                                   F.lit(sequence_tokens).cast("long").alias("room"))
                rooms, opened = rooms.unionByName(added), opened + new
                levels[sequence_tokens] = levels.get(sequence_tokens, 0) + new
                slots = offered_slots(levels, n, widest)
                behind = left_behind(counts, gap_widths(levels, slots, least, widest))
            found, left, matched = match(left, gaps_of(rooms, slots, least, widest))
            if matched != n - sum(behind.values()):
                raise RuntimeError(f"{matched} of {n} pieces placed, {sum(behind.values())} were to stay behind")
            placed.append(settle(found, sequence_tokens))
            used = placed[-1].groupBy(F.col("sequence_id").alias("of")).agg(F.sum("length").alias("used"))
            rooms = stage(rooms.join(used, rooms["sequence_id"] == used["of"], "left")
                          .select("sequence_id", (F.col("room") - F.coalesce("used", F.lit(0))).alias("room"))
                          .where("room > 0"), "rooms")
            tried, counts = matched < 2 * LEAST_PLACED * n, behind
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out
