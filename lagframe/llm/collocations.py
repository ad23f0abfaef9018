"""Phrase collocations by multikey quicksort of suffix pointers.

A suffix is what follows from a word to the end of its piece, up to the
greatest phrase length. Suffixes are routed by their leading words, so that all
that open alike meet in one task, and there a three-way quicksort splits
pointers to them word by word. What equals the pivot is one phrase: the
weight of that part is its count, and only that part is sorted by the next word.
Parts that weigh less than the least count are abandoned, at any depth.

A leading word that holds a large share of all words would fill a task. Such
words are found first, by a count of words, and their suffixes are routed by
two words; pairs of large share by three, and so on. What these heavy
prefixes count is known from their own count. A task sends the suffixes of one
prefix as one row, equal ones added up before. Arrow and numpy split, number and group
the words of a chunk of texts at a time.

Scores compare a phrase with its parts by exact integers.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lagframe.llm.common import arrow_rows, pick, prepare, releasing, stage

LEAST_COUNT = 10
MAX_WORDS = 3
SUBSUMED_PERCENT = 50
TOP = 2000
UNKNOWN_LANGUAGE = "und"
SCALE = 1_000_000
TOP_PARTS = 16
CHUNK_BYTES = 3 << 20         # of texts whose words a task numbers, adds up and sends on at once
SMALL_PART = 4096             # pointers of a part that is sorted at once
ROUTED_BATCH_ROWS = 4_000     # rows of routed suffixes and of counts in an Arrow batch; few of them are long
TASK_POINTERS = 2_000_000     # suffixes of a sorting task, about
SORTED_POINTERS = 400_000     # suffixes sorted at once, unless one prefix has more
# A prefix is heavy from one part in so many of all words on; no more prefixes can be heavy.
LEAST_PARTS, MOST_PARTS = 200, 100_000
SUFFIX_SCHEMA = "lang string, prefix string, weight long, tails string"

# Piece ends become line feeds, tabs spaces; what is left between spaces and line feeds are words.
_CLEANED = bytes(10 if b in b".,;:!?\n\v\f\r" else 32 if b == 9 else b for b in range(256))


def cleaned(text: str | None) -> bytes:
    """The text with A to Z lowered, a line feed at each piece's end and spaces between words."""
    return (text or "").encode().lower().translate(_CLEANED) + b"\n"


def chunks(data: bytes, size: int) -> Iterator[bytes]:
    """Cleaned texts cut behind piece ends, about ``size`` bytes each; a longer piece stays whole."""
    at = 0
    while at < len(data):
        end = data.find(b"\n", at + size) + 1 or len(data)
        yield data[at:end]
        at = end


class Coded:
    """The words of cleaned texts as numbers: ``names`` of the words, and by place the word and those that follow it.

    ``columns[j]`` is the word j places on, -1 behind the end of the piece; places of piece ends are left out.
    """

    def __init__(self, data: bytes, n: int):
        found = pc.split_pattern(pa.array([data.replace(b"\n", b" \n ").decode()], pa.large_string()), " ").flatten()
        coded = found.dictionary_encode()
        self.names = coded.dictionary
        codes = coded.indices.to_numpy().astype(np.int64)
        codes = codes[codes != self.number("")]
        end = self.number("\n")
        alive = codes != end
        self.columns = [codes]
        for j in range(1, n):
            follows = np.full(len(codes), end)
            follows[:-j] = codes[j:]
            alive = alive & (follows != end)
            self.columns.append(np.where(alive, follows, -1))
        self.columns = [c[codes != end] for c in self.columns]
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), self.names, pa.scalar("", pa.large_string()))
        self.parts = pa.concat_arrays([self.names, spaced, pa.array([""], pa.large_string())])

    def number(self, word: str) -> int:
        """The word's number, one that no word has if it doesn't occur."""
        at = pc.index(self.names, pa.scalar(word, pa.large_string())).as_py()
        return len(self.names) if at < 0 else at

    def phrase_keys(self, at: np.ndarray, first: int, n: int) -> np.ndarray:
        """A number for the ``n`` words from place ``first`` on: equal ones for equal words."""
        size, key, top = len(self.names) + 2, np.zeros(len(at), dtype=np.int64), 1
        for column in self.columns[first:first + n]:
            if top > (1 << 62) // size:
                key = np.unique(key, return_inverse=True)[1]
                top = len(at) + 1
            key, top = key * size + column[at] + 1, top * size
        return key

    def phrases(self, at: np.ndarray, first: int | np.ndarray, end: int | np.ndarray) -> pa.Array:
        """The words from place ``first`` up to place ``end`` of each, or to the piece's end, joined by spaces."""
        n, parts = len(self.names), []
        for j, column in enumerate(self.columns):
            shown = (column[at] >= 0) & (j >= first) & (j < end)
            # a word, a space and the word, or nothing
            parts.append(self.parts.take(pa.array(np.where(shown, column[at] + np.where(j > first, n, 0), 2 * n))))
        return pc.binary_join_element_wise(*parts, pa.scalar("", pa.large_string()))

    def holds(self, at: np.ndarray, n: int, first: int, known: set[bytes]) -> np.ndarray:
        """Whether the ``n`` words from place ``first`` on are one of the ``known`` phrases."""
        whole = self.columns[first + n - 1][at] >= 0
        out = np.zeros(len(at), dtype=bool)
        if not known or not whole.any():
            return out
        # a phrase of words that all occur here is told by its words' numbers
        listed = pc.index_in(self.names, pa.array(sorted({w for k in known for w in k.decode().split(" ")}), pa.large_string()))
        there = pc.is_valid(listed).to_numpy(zero_copy_only=False)
        near = whole & np.logical_and.reduce([there[c[at]] & (c[at] >= 0) for c in self.columns[first:first + n]])
        some = np.flatnonzero(near)
        if len(some):
            keys, which, back = np.unique(self.phrase_keys(at[some], first, n), return_index=True, return_inverse=True)
            names = self.phrases(at[some[which]], first, first + n).to_pylist()
            out[some] = np.array([x.encode() in known for x in names])[back]
        return out


def map_chunks(docs: DataFrame, size: int, n: int, rows: Callable[[str, Coded], Iterator[pa.RecordBatch]],
               schema: str) -> DataFrame:
    """``rows`` of the words of each language's texts, gathered to about ``size`` bytes in a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = defaultdict(list)
        n_held = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                for chunk in chunks(b"".join(texts), size):
                    coded = Coded(chunk, n)
                    for found in rows(lang, coded) if len(coded.columns[0]) else ():
                        yield from (found.slice(i, ROUTED_BATCH_ROWS) for i in range(0, found.num_rows, ROUTED_BATCH_ROWS))
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = cleaned(text)
                held[UNKNOWN_LANGUAGE if lang is None else lang].append(data)
                n_held += len(data)
                if n_held >= size:
                    yield from sent()
                    n_held = 0
        yield from sent()

    prepare(docs.sparkSession)
    return pick(docs, "lang", "text").mapInArrow(releasing(work), schema)


def batch_of(lang: str, **columns: pa.Array) -> pa.RecordBatch:
    """Columns of one language; texts as Spark takes them."""
    n = len(next(iter(columns.values())))
    arrays = [pa.array([lang], pa.string()).take(pa.array(np.zeros(n, dtype=np.int64)))]
    arrays += [c.cast(pa.string()) if pa.types.is_large_string(c.type) else c for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, ["lang", *columns])


def count_phrases(docs: DataFrame, n: int, heavy: dict[str, set[bytes]] | None, name: str) -> DataFrame:
    """lang, phrase, n of the phrases of ``n`` words; written. Tasks add up before the shuffle.

    With ``heavy`` only those whose first and last n - 1 words are both heavy.
    """

    def rows(lang: str, coded: Coded) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(coded.columns[n - 1] >= 0)
        if heavy is not None:
            known = heavy.get(lang, set())
            at = at[coded.holds(at, n - 1, 0, known)]
            at = at[coded.holds(at, n - 1, 1, known)] if len(at) else at
        if len(at):
            _, which, counts = np.unique(coded.phrase_keys(at, 0, n), return_index=True, return_counts=True)
            yield batch_of(lang, phrase=coded.phrases(at[which], 0, n), n=pa.array(counts, pa.int64()))

    found = map_chunks(docs, CHUNK_BYTES, n, rows, "lang string, phrase string, n long")
    return stage(found.groupBy("lang", "phrase").agg(F.sum("n").alias("n")), name)


def route_suffixes(docs: DataFrame, hot: dict[str, set[bytes]], max_words: int) -> DataFrame:
    """lang, prefix, weight and the tails of that weight, one to a line: the suffixes of a chunk by prefix.

    Equal suffixes are one, of their number's weight. A prefix is a word, and goes on as long as it is heavy.
    Suffixes of a single word aren't sent, nor those that are heavy prefixes themselves, as all that
    opens them is counted already.
    """

    def rows(lang: str, coded: Coded) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(coded.columns[1] >= 0) if max_words > 1 else np.empty(0, dtype=np.int64)
        if not len(at):
            return
        _, which, weights = np.unique(coded.phrase_keys(at, 0, max_words), return_index=True, return_counts=True)
        at, known = at[which], hot.get(lang, set())
        length, heavy, done = np.ones(len(at), dtype=np.int64), np.ones(len(at), dtype=bool), np.zeros(len(at), dtype=bool)
        for depth in range(1, max_words):
            some = np.flatnonzero(heavy)
            heavy[some] = coded.holds(at[some], depth, 0, known)
            done |= heavy & (coded.columns[depth][at] < 0)
            heavy &= ~done
            length[heavy] += 1
        at, length, weights = at[~done], length[~done], weights[~done]
        if not len(at):
            return
        # the prefix as far as it goes, then the weight: rows are what agrees in both
        shown = np.stack([np.where(j < length, column[at], -1) for j, column in enumerate(coded.columns)])
        order = np.lexsort((weights, *shown[::-1]))
        at, length, weights, shown = at[order], length[order], weights[order], shown[:, order]
        new = np.append(True, (shown[:, 1:] != shown[:, :-1]).any(axis=0) | (weights[1:] != weights[:-1]))
        first = np.flatnonzero(new)
        tails = coded.phrases(at, length, max_words)
        lists = pa.LargeListArray.from_arrays(pa.array(np.append(first, len(at)), pa.int64()), tails)
        yield batch_of(lang, prefix=coded.phrases(at[first], 0, length[first]), weight=pa.array(weights[first], pa.int64()),
                       tails=pc.binary_join(lists, pa.scalar("\n", pa.large_string())))

    return map_chunks(docs, CHUNK_BYTES, max_words, rows, SUFFIX_SCHEMA)


def small_part(words: np.ndarray, weights: np.ndarray, part: np.ndarray, depth: int, least: int) -> Iterator[tuple[int, int, int]]:
    """What ``three_way`` yields of a small part, by sorting it once by all words from ``depth`` on."""
    rest = words[part, depth:]
    order = np.lexsort(rest.T[::-1])
    rest, part = rest[order], part[order]
    weight, new = weights[part], np.zeros(len(part), dtype=bool)
    new[0] = True
    for d in range(rest.shape[1]):
        new[1:] |= rest[1:, d] != rest[:-1, d]
        first = np.flatnonzero(new)
        counts = np.add.reduceat(weight, first)
        hits = np.flatnonzero((counts >= least) & (rest[first, d] >= 0))
        if not len(hits):
            return      # longer phrases count no more
        for i in hits.tolist():
            yield depth + d + 1, int(part[first[i]]), int(counts[i])


def three_way(words: np.ndarray, weights: np.ndarray, pointers: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, pointer, count) of every prefix of the suffixes that ``pointers`` point to, if it counts ``least``.

    ``words`` holds the words' numbers by depth, -1 behind a suffix's end. Parts of
    up to SMALL_PART pointers are sorted at once, as quicksorts do with small parts.
    """
    top = int(weights[pointers].max())
    stack = [(pointers, 0)]
    while stack:
        part, depth = stack.pop()
        if len(part) <= SMALL_PART:
            yield from small_part(words, weights, part, depth, least)
            continue
        key = words[part, depth]
        pivot = sorted((key[0], key[len(key) // 2], key[-1]))[1]
        equal = part[key == pivot]
        if len(equal) < len(part):
            for side in (part[key < pivot], part[key > pivot]):
                # the rest is abandoned, as are all that follow it
                if len(side) * top >= least and (top == 1 or weights[side].sum() >= least):
                    stack.append((side, depth))
        count = len(equal) if top == 1 else int(weights[equal].sum())
        if pivot >= 0 and count >= least:
            yield depth + 1, int(equal[0]), count
            if depth + 1 < words.shape[1]:
                stack.append((equal, depth + 1))


def group_bounds(rows: pa.Table) -> np.ndarray:
    """Where the rows of a lang and prefix begin, in a table sorted by them, and its end."""
    new = np.zeros(len(rows), dtype=bool)
    new[0] = True
    for name in ("lang", "prefix"):
        column = rows[name].combine_chunks()
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.append(np.flatnonzero(new), len(rows))


def sort_suffixes(rows: pa.Table, least: int) -> Iterator[tuple[str, str, int]]:
    """(lang, phrase, count) of the phrases of two words or more, from routed rows in order of lang and prefix."""
    bounds = group_bounds(rows)
    lines = pc.split_pattern(rows["tails"].combine_chunks().cast(pa.large_string()), "\n")
    per_row = pc.list_value_length(lines).to_numpy()
    first_line = np.append(0, np.cumsum(per_row))
    weights = np.repeat(rows["weight"].to_numpy(), per_row)
    tails = pc.split_pattern(lines.flatten(), " ")
    coded = tails.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    flat = coded.indices.to_numpy().astype(np.int32)
    if "" in names:
        flat[flat == names.index("")] = -1
    sizes = pc.list_value_length(tails).to_numpy().astype(np.int64)
    first = np.cumsum(sizes) - sizes
    words = np.full((len(sizes), int(sizes.max())), -1, dtype=np.int32)
    for depth in range(words.shape[1]):
        has = sizes > depth
        words[has, depth] = flat[first[has] + depth]
    starts = first_line[bounds]
    total = np.add.reduceat(weights, starts[:-1])
    for g in np.flatnonzero(total >= least).tolist():
        lang, prefix = (rows[c][int(bounds[g])].as_py() for c in ("lang", "prefix"))
        if " " in prefix:
            yield lang, prefix, int(total[g])
        for depth, at, count in three_way(words, weights, np.arange(starts[g], starts[g + 1]), least):
            yield lang, " ".join([prefix, *(names[w] for w in words[at, :depth])]), count


def sorted_counts(suffixes: DataFrame, tasks: int, least: int) -> DataFrame:
    """lang, phrase, n of the frequent phrases in the routed suffixes; written."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])

    def pointers(rows: pa.Table) -> int:
        return len(rows) + (pc.sum(pc.count_substring(rows["tails"], "\n")).as_py() or 0)

    def found(rows: pa.Table) -> pa.RecordBatch:
        out = list(sort_suffixes(rows, least))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += pointers(pa.Table.from_batches([batch]))
            if size >= SORTED_POINTERS:
                rows = pa.Table.from_batches(held)
                # the last prefix may go on in the next batch
                cut = int(group_bounds(rows)[-2])
                if cut:
                    yield found(rows.slice(0, cut))
                    rows = rows.slice(cut)
                held, size = rows.to_batches(), pointers(rows)
        if held:
            yield found(pa.Table.from_batches(held))

    ordered = suffixes.repartition(tasks, "lang", "prefix").sortWithinPartitions("lang", "prefix")
    with arrow_rows(suffixes.sparkSession, ROUTED_BATCH_ROWS):
        return stage(ordered.mapInArrow(releasing(work), "lang string, phrase string, n long"), "phrases")


def frequent_phrases(docs: DataFrame, least: int = LEAST_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): n of every word, and of the phrases with ``least`` occurrences, by lang and phrase.

    Phrases have one to ``max_words`` words and lie within a piece.
    """
    words = count_phrases(docs, 1, None, "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    tasks = -(-total // TASK_POINTERS) or 1
    heavy_from = total // min(MOST_PARTS, max(LEAST_PARTS, tasks)) + 1
    hot: dict[str, set[bytes]] = defaultdict(set)
    known, frequent = words, words.where(f"n >= {least}")
    for n in range(1, max_words):
        # at most MOST_PARTS of each length, by the bound itself
        level = defaultdict(set)
        for r in known.where(f"n >= {heavy_from}").select("lang", "phrase").collect():
            level[r["lang"]].add(r["phrase"].encode())
        for lang, found in level.items():
            hot[lang] |= found
        if not level or n + 1 == max_words:
            break
        known = count_phrases(docs, n + 1, dict(level), "heavy")
        # others of these phrases are counted by the sort
        frequent = frequent.unionByName(known.where(f"n >= {max(heavy_from, least)}"))
    suffixes = route_suffixes(docs, dict(hot), max_words)
    return words, frequent.unionByName(sorted_counts(suffixes, tasks, least))


def scored(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of the phrases of two words or more.

    Of all cuts into a first part and a rest the one of the lowest score
    floor(SCALE * a * a / (l * r)) counts, ties to the shortest first part.
    Counts of up to 10^15 keep the products exact.
    """
    size = F.size(F.split("phrase", " "))
    cut = (phrases.withColumn("size", size).where("size > 1")
           .withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
           .withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
           .withColumn("rest", F.expr("substring_index(phrase, ' ', k - size)")))
    for part, count in (("first", "l"), ("rest", "r")):
        cut = cut.join(phrases.select("lang", F.col("phrase").alias(part), F.col("n").alias(count)), ["lang", part])
    score = F.expr(f"""cast({SCALE} as decimal(7,0)) * (cast(n as decimal(15,0)) * cast(n as decimal(15,0)))
        div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))""")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return (cut.groupBy("lang", "phrase", F.col("n").alias("a")).agg(best.alias("best"))
            .select("lang", "phrase", "a", "best.l", "best.r", "best.score"))


def without_subsumed(candidates: DataFrame, percent: int) -> DataFrame:
    """Drop phrases that lie within a longer one with ``percent`` of their occurrences."""
    size = F.size(F.split("phrase", " "))
    inner = (candidates.select("lang", "a", F.split("phrase", " ").alias("ws")).where("size(ws) > 2")
             .select("lang", "a", F.explode(F.expr("""flatten(transform(sequence(2, size(ws) - 1), n ->
                 transform(sequence(1, size(ws) - n + 1), i -> array_join(slice(ws, i, n), ' '))))""")).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("a").alias("of_longer")))
    return (candidates.join(inner, ["lang", "phrase"], "left")
            .where(f"of_longer is null or 100 * of_longer < {percent} * a").drop("of_longer"))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST_COUNT, max_words: int = MAX_WORDS,
                 percent: int = SUBSUMED_PERCENT) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Letters A to Z are lowered; pieces end at ``.,;:!?`` and line ends, words
    at spaces and tabs. Null texts are empty, a null lang is ``und``; other columns
    are ignored, and repeated rows count as often as they stand. Ties go by score,
    a, then phrase in byte order. An empty table gives none. ``top`` is a report's length.
    """
    words, phrases = frequent_phrases(docs, least, max_words)
    kept = without_subsumed(stage(scored(phrases), "scored"), percent)
    best_first = [F.desc("score"), F.desc("a"), F.asc("phrase")]

    def ranked(df: DataFrame, *group: Column | str) -> DataFrame:
        order = Window.partitionBy("lang", *group).orderBy(*best_first)
        return df.withColumn("rank", F.row_number().over(order).cast("long")).where(f"rank <= {top}")

    # a language's phrases are ranked in parts first, so the last task gets at most TOP_PARTS * top of it
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return (ranked(ranked(kept.withColumn("part", part), "part"))
            .join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


SQL = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
places as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from words),
grams as (
  select lang, ws[i:i + k - 1] as g, k from places, (values (1), (2), (3)) as sizes(k) where i + k - 1 <= len(ws)),
counts as (select lang, array_to_string(g, ' ') as phrase, k, count(*)::hugeint as f from grams group by all),
totals as (select lang, sum(f)::bigint as n from counts where k = 1 group by lang),
candidates as (select lang, phrase, k, f as a, string_split(phrase, ' ') as ws from counts where f >= {LEAST_COUNT} and k > 1),
sides as (select lang, phrase, k, a, ws, unnest(range(1, k)) as cut from candidates),
parts as (
  select lang, phrase, k, a, cut, array_to_string(ws[:cut], ' ') as head, array_to_string(ws[cut + 1:], ' ') as rest from sides),
frequent as (select lang, phrase, f from counts where f >= {LEAST_COUNT}),
cuts as (
  select c.lang, c.phrase, c.k, c.a, c.cut, x.f as l, y.f as r, {SCALE}::hugeint * c.a * c.a // (x.f * y.f) as score
  from parts c join frequent x on x.lang = c.lang and x.phrase = c.head
  join frequent y on y.lang = c.lang and y.phrase = c.rest),
best as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
longer as (
  select lang, array_to_string(string_split(phrase, ' ')[s:s + 1], ' ') as phrase, max(a) as top
  from best, (values (1), (2)) as starts(s) where k = 3 group by all),
kept as (
  select b.* from best b left join longer using (lang, phrase)
  where top is null or 100 * top < {SUBSUMED_PERCENT} * a)
select kept.lang, row_number() over (partition by kept.lang order by score desc, a desc, phrase) as rank, phrase,
       a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
from kept join totals using (lang)
qualify rank <= {TOP}
"""
