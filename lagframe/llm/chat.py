"""Minimum-cost repair of the turns of a conversation, and its rendering.

Legal conversations have an optional system turn, then user and assistant
in turns, and end with the assistant. A turn can be kept, given another
role, merged into the turn before it, or preceded by empty turns; each edit
has a cost. Dynamic programming over the automaton's four states finds the
cheapest legal sequence.

Turns are sorted by conversation and turn over the cluster by range, so a
conversation of any length is spread over tasks. A task's share of a
conversation acts on the states like a small cost matrix. The driver
receives these matrices of the two conversations at either end of each
task, chains them and so fixes the states at the seams; every task then
traces its share back between its own. Rendering is by turn as well: a
conversation's text is its segments in order, and no task joins them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagframe.llm.common import map_columns, pick
from lagframe.session import checkpoint_dir

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE_COST, RELABEL_COST, INSERT_COST = 1, 2, 3
FAR = 1 << 40
SEGMENT_BITS = 33
SEAM_SCHEMA = "part long, rows long, one boolean, head_key long, head array<long>, tail_key long, tail array<long>"
TURN_SCHEMA = ("conv_id long, turn long, role string, new_role string, action string, inserted_before int, "
               "inserted_after int, segment_no long, segment string")


def insertions() -> list[list[tuple[int, ...] | None]]:
    """Shortest runs of inserted turns that lead from one state to another."""
    out: list[list[tuple[int, ...] | None]] = [[None] * 4 for _ in range(4)]
    for s in range(4):
        out[s][s] = ()
        line = [s]
        for at in line:
            for t in NEXT[at]:
                if out[s][t] is None:
                    out[s][t] = (*out[s][at], t)
                    line.append(t)
    return out


INSERTIONS = insertions()


def steps_of(role: int) -> list[list[tuple[int, str, tuple[int, ...]] | None]]:
    """For a turn of ``role`` (0 if unknown): the cheapest way from state to state.

    A way is (cost, action, inserted states). Of equal ones the one with
    fewer insertions wins, then keeping before merging before relabelling.
    """
    out: list[list] = [[None] * 4 for _ in range(4)]
    for s in range(4):
        ways = []
        for mid in range(4):
            put = INSERTIONS[s][mid]
            if put is None:
                continue
            for t in NEXT[mid]:
                ways.append((len(put) * INSERT_COST + (0 if t == role else RELABEL_COST), len(put),
                             0 if t == role else 2, t, "keep" if t == role else "relabel", put))
            if mid != START:
                ways.append((len(put) * INSERT_COST + MERGE_COST + (0 if mid == role else RELABEL_COST), len(put),
                             1 if mid == role else 3, mid, "merge" if mid == role else "merge_relabel", put))
        for cost, _, _, t, action, put in sorted(ways, key=lambda w: w[:4]):
            if out[s][t] is None:
                out[s][t] = (cost, action, put)
    return out


STEPS = [steps_of(r) for r in range(4)]
ENDING = [FAR if INSERTIONS[s][ASSISTANT] is None else len(INSERTIONS[s][ASSISTANT]) * INSERT_COST for s in range(4)]
ENDING[START] = FAR


def role_state(role: str | None) -> int:
    name = (role or "").strip().lower()
    return ROLES.index(name) + 1 if name in ROLES else 0


def advance(costs: list[int], role: int) -> list[int]:
    steps = STEPS[role]
    return [min(costs[s] + steps[s][t][0] if steps[s][t] else FAR for s in range(4)) for t in range(4)]


def span_matrix(roles: list[int]) -> list[int]:
    """Least cost from each state to each over a run of turns, row by row."""
    out = []
    for s in range(4):
        costs = [0 if t == s else FAR for t in range(4)]
        for r in roles:
            costs = advance(costs, r)
        out += [min(c, FAR) for c in costs]
    return out


def trace(roles: list[int], start: int, end: int | None) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """The cheapest (from, to, action, inserted) of each turn; ``end`` None: the best legal end."""
    costs, back = [0 if s == start else FAR for s in range(4)], []
    for r in roles:
        steps = STEPS[r]
        came = [min((costs[s] + steps[s][t][0] if steps[s][t] else FAR, s) for s in range(4)) for t in range(4)]
        back.append([s for _, s in came])
        costs = [min(c, FAR) for c, _ in came]
    state = min(range(4), key=lambda s: (costs[s] + ENDING[s], s)) if end is None else end
    out = []
    for r, came in zip(reversed(roles), reversed(back), strict=True):
        before = came[state]
        _, action, put = STEPS[r][before][state]
        out.append((before, state, action, put))
        state = before
    return out[::-1]


def solve_seams(seams: list[tuple]) -> dict[int, tuple[int, int | None]]:
    """(state its first conversation starts in, state its last one ends in) by task.

    None as an end: the conversation ends there.
    """
    seams = sorted(x for x in seams if x[1])
    starts = {x[0]: START for x in seams}
    ends: dict[int, int | None] = {x[0]: None for x in seams}
    i = 0
    while i < len(seams):
        # the tasks that share the conversation at this task's end
        chain, j = [(seams[i][0], seams[i][6])], i
        while j + 1 < len(seams) and seams[j + 1][3] == seams[i][5]:
            j += 1
            chain.append((seams[j][0], seams[j][4]))
            if not seams[j][2]:
                break
        if len(chain) > 1:
            costs = [[0 if s == START else FAR for s in range(4)]]
            for _, m in chain:
                costs.append([min(FAR, min(costs[-1][s] + m[4 * s + t] for s in range(4))) for t in range(4)])
            state = min(range(4), key=lambda s: (costs[-1][s] + ENDING[s], s))
            for k in range(len(chain) - 1, 0, -1):
                m = chain[k][1]
                state = min(range(4), key=lambda s: (costs[k][s] + m[4 * s + state], s))
                starts[chain[k][0]] = state
                ends[chain[k - 1][0]] = state
        i = max(j, i + 1)
    return {p: (starts[p], ends[p]) for p in starts}


def opening(state: int) -> str:
    return f"<|{ROLES[state - 1]}|>\n"


def render(before: int, after: int, action: str, put: tuple[int, ...], text: str | None) -> str:
    """A turn's segment; it closes the turn before it, as a merge may follow its own."""
    plain = (text or "").replace("<|", "< |")
    out, open_turn = "", before != START
    for state in put:
        out, open_turn = out + "<|end|>\n" * open_turn + opening(state), True
    if action.startswith("merge"):
        return out + ("" if put else "\n") + plain
    return out + "<|end|>\n" * open_turn + opening(after) + plain


def repair_conversations(turns: DataFrame) -> DataFrame:
    """One row per turn: its new role, the edits, and its rendered segment.

    Turns stand in the order of turn (nulls first), then role and text, so
    ties and repeated rows have a fixed order; rows without a conv_id are
    one conversation. Unknown and null roles are relabelled or merged; null
    texts are empty, and "<|" in a text becomes "< |" so that it can't pass
    for a tag. ``inserted_before`` and ``inserted_after`` count empty turns,
    which are rendered in the segment. An empty table gives none.
    """
    checkpoint_dir(turns.sparkSession)
    keys = ("conv_id", "turn", "role", "text")
    rows = pick(turns, *keys).withColumn("hash", F.xxhash64("role", "text"))
    # written in this order: both passes below see the same shares
    ordered = (rows.repartitionByRange("conv_id", "turn", "hash").sortWithinPartitions(*keys)
               .drop("hash").checkpoint())

    def runs(batches: Iterator[dict[str, list]]) -> Iterator[tuple[int | None, list[tuple]]]:
        """The conversations of a share in order, each as (turn, role, text) rows."""
        key, held, begun = None, [], False
        for batch in batches:
            for conv, *row in zip(*(batch[k] for k in keys), strict=True):
                if begun and conv != key:
                    yield key, held
                    held = []
                key, begun = conv, True
                held.append(row)
        if begun:
            yield key, held

    def seam(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        head = tail = None
        n = 0
        for key, held in runs(batches):
            n += 1
            tail = (key, [role_state(r) for _, r, _ in held])
            head = head or tail
        if n:
            values = (TaskContext.get().partitionId(), n, n == 1, head[0], span_matrix(head[1]),
                      tail[0], span_matrix(tail[1]))
            yield {c.split()[0]: [v] for c, v in zip(SEAM_SCHEMA.split(", "), values, strict=True)}

    seams = solve_seams([tuple(r) for r in map_columns(ordered.select("conv_id", "turn", "role", F.lit("").alias("text")),
                                                       seam, SEAM_SCHEMA).collect()])

    def repair(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        part = TaskContext.get().partitionId()
        first, last = seams.get(part, (START, None))
        number, waiting = part << SEGMENT_BITS, None

        def rows_of(key, held, start, end) -> dict[str, list]:
            nonlocal number
            out = []
            path = trace([role_state(r) for _, r, _ in held], start, end)
            for i, ((turn, role, text), (before, after, action, put)) in enumerate(zip(held, path, strict=True)):
                segment, more = render(before, after, action, put, text), ()
                if end is None and i == len(held) - 1:
                    more = INSERTIONS[after][ASSISTANT]
                    segment += "".join("<|end|>\n" + opening(s) for s in more) + "<|end|>\n"
                out.append((key, turn, role, ROLES[after - 1], action, len(put), len(more), number, segment))
                number += 1
            return {c.split()[0]: [r[i] for r in out] for i, c in enumerate(TURN_SCHEMA.split(", "))}

        start = first
        for run in runs(batches):
            if waiting:
                yield rows_of(*waiting, start, None)
                start = START
            waiting = run
        if waiting:
            yield rows_of(*waiting, start, last)

    return map_columns(ordered, repair, TURN_SCHEMA)
