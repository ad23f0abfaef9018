"""Language identification: averaged hashed subwords and a linear softmax.

A text is lower-cased and everything but letters becomes a space. Its
subwords are the 2 to 4 byte windows that don't reach over a word's end;
each is hashed to a bucket, the buckets' embeddings are averaged and a
linear layer with softmax gives the languages' probabilities. Embeddings
and layer are trained together by stochastic gradient descent in numpy on
a bounded sample of labelled rows, spread over all languages; tasks count the
subwords of their whole texts. Part of the sample calibrates the model: a
temperature for the scores and the score under which a prediction is rejected.

For prediction both layers fold into one bucket x language table, so a text
costs one histogram of its subwords and one product.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagframe.llm.common import has_letter, map_columns, pick, positional, prepare
from lagframe.llm.quality_rules import allowed_losses

SAMPLE_ROWS = 8000        # labelled rows trained and calibrated on, at most, but one of every language
BUCKETS = 1 << 14
DIMENSION = 16
EPOCHS = 4
LEARNING_RATE = 0.8
CALIBRATION_PART = 5      # every fifth sampled row calibrates
TARGET_ACCURACY = 0.98    # of accepted calibration rows
MAX_FALSE_REJECTION = 0.02    # of rightly predicted texts, by their score
MISTAKE_PROBABILITY = 0.05
HELD_OUT_PARTS = 5
UNDETERMINED = "und"
CHUNK = 1 << 20           # subwords of a text that are counted at once

# For ASCII texts: bytes that are no letters become spaces.
_BLANK = bytes(b if 97 <= b <= 122 else 32 for b in range(256))
_ORDERS = (2, 3, 4)
_SHIFT = np.uint32(33 - BUCKETS.bit_length())
_FACTOR = np.uint32(0x9E3779B1)
_OFFSETS = {n: np.uint32(n * 0x85EBCA6B % (1 << 32)) for n in _ORDERS}


class _LettersOnly(dict):
    """For other texts: characters that are no letters become spaces."""

    def __missing__(self, point: int) -> int:
        self[point] = point if chr(point).isalpha() else 32
        return self[point]


_LETTERS = _LettersOnly()


def letters_of(text: str) -> bytes:
    """The lower-cased text in UTF-8 with spaces for all but letters, and one at either end."""
    low = text.lower()
    return b" " + (low.encode().translate(_BLANK) if low.isascii() else low.translate(_LETTERS).encode()) + b" "


def subword_counts(text: str) -> np.ndarray:
    """Histogram over the buckets of all subwords of a text of any length."""
    data = np.frombuffer(letters_of(text), dtype=np.uint8)
    out = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(data), CHUNK):
        # each window is counted where it starts; the longest ones reach into the next chunk
        part = data[at:at + CHUNK + max(_ORDERS) - 1]
        wide, space = part.astype(np.uint32), part == 32
        value, inner = wide + np.uint32(1), None
        for order in _ORDERS:
            n = len(part) - order + 1
            if n <= 0:
                break
            value = value[:n] * np.uint32(257) + wide[order - 1:]
            if order == 2:
                keep = ~(space[:-1] & space[1:])
            else:
                inner = space[1:1 + n] if inner is None else inner[:n] | space[order - 2:order - 2 + n]
                keep = ~inner
            hashed = (value * _FACTOR + _OFFSETS[order]) * np.uint32(0xC2B2AE35) >> _SHIFT
            out += np.bincount(hashed[:CHUNK][keep[:CHUNK]], minlength=BUCKETS)
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray        # bucket x language: embedding times output layer
    temperature: float
    threshold: float

    def logits(self, counts: np.ndarray) -> np.ndarray:
        total = counts.sum()
        return counts @ self.table / total if total else np.zeros(len(self.languages))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the prediction is accepted."""
        if not text or not has_letter(text) or not self.languages:
            return UNDETERMINED, 0.0, False
        p = softmax(self.logits(subword_counts(text)) / self.temperature)
        k = int(np.argmax(p))
        return self.languages[k], float(min(1.0, p[k])), bool(p[k] >= self.threshold)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def held_out() -> Column:
    """Whether crc32(doc_id as text) mod 5 is 0; a null doc_id is never learnt from."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.col("doc_id").isNull() | (F.crc32(key.cast("binary")) % HELD_OUT_PARTS == 0)


def training_sample(docs: DataFrame) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, buckets, shares) of a bounded, repeatable sample of labelled rows, even over all languages.

    Of each language the rows with the least hashes are taken, up to its share of
    SAMPLE_ROWS, and one at least; equal rows count once. Only hashes are ranked.
    Tasks count the subwords of the sampled texts, so the driver gets
    at most 10 * BUCKETS bytes a row, compressed, whatever the texts' lengths.
    """
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()) \
        .withColumn("unit", F.xxhash64("doc_id", "text"))
    languages = rows.select("lang").distinct().count()
    if not languages:
        return []
    each = max(1, SAMPLE_ROWS // languages)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("unit"))
    last = (rows.select("lang", "unit").distinct().withColumn("rank", rank).where(F.col("rank") <= each)
            .groupBy("lang").agg(F.max("unit").alias("last")))
    # one row a language, as many as the sample has
    last = F.broadcast(last.withColumnRenamed("lang", "of_lang"))
    taken = (rows.join(last, (F.col("lang") == F.col("of_lang")) & (F.col("unit") <= F.col("last")))
             .dropDuplicates(["lang", "unit"]))

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            at = [i for i, t in enumerate(batch["text"]) if has_letter(t)]
            counts = [subword_counts(batch["text"][i]) for i in at]
            yield {"lang": [batch["lang"][i] for i in at], "unit": [batch["unit"][i] for i in at],
                   "counts": [packed(c) for c in counts]}

    found = map_columns(taken.select("lang", "text", "unit"), work, "lang string, unit long, counts binary")
    return [(r["lang"], *unpacked(r["counts"])) for r in sorted(found.collect(), key=lambda r: (r["unit"], r["lang"]))]


def packed(counts: np.ndarray) -> bytes:
    """A histogram for the way to the driver: steps between the buckets used, then their counts, compressed."""
    used = np.flatnonzero(counts)
    return zlib.compress(np.diff(used, prepend=0).astype("<u2").tobytes() + counts[used].astype("<i8").tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets used and their shares of all subwords."""
    plain = zlib.decompress(data)
    n = len(plain) // 10
    counts = np.frombuffer(plain, "<i8", n, 2 * n)
    return np.cumsum(np.frombuffer(plain, "<u2", n)).astype(np.uint16), (counts / counts.sum()).astype(np.float32)


def train(sample: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> LanguageModel:
    """Fit, calibrate and fold the model; the sample's order is the training order."""
    languages = sorted({lang for lang, _, _ in sample})
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0)), 1.0, 0.0)
    at = {lang: i for i, lang in enumerate(languages)}
    rows = [(at[lang], used, share) for lang, used, share in sample]
    fit = [r for i, r in enumerate(rows) if i % CALIBRATION_PART] or rows
    check = [r for i, r in enumerate(rows) if not i % CALIBRATION_PART]
    rng = np.random.default_rng(seed)
    embed = rng.uniform(-1.0 / DIMENSION, 1.0 / DIMENSION, (BUCKETS, DIMENSION)).astype(np.float32)
    layer = np.zeros((DIMENSION, len(languages)), dtype=np.float32)
    steps, step = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(fit)):
            label, used, share = fit[i]
            rate = np.float32(LEARNING_RATE * (1 - step / steps))
            step += 1
            mean = share @ embed[used]
            error = softmax(mean @ layer)
            error[label] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            # as for a mean over subwords, every subword present gets the whole gradient's share
            embed[used] -= rate * back
    table = (embed @ layer).astype(np.float64)
    model = LanguageModel(languages, table, 1.0, 0.0)
    calibrate(model, check)
    return model


def calibrate(model: LanguageModel, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
    """Temperature by likelihood; threshold by the accuracy of what is accepted,
    and never under a low quantile of the right rows' scores."""
    if not rows:
        return
    z = np.stack([share.astype(np.float64) @ model.table[used] for _, used, share in rows])
    y = np.array([label for label, _, _ in rows])
    # a few mistakes short of certain, so that a faultless sample doesn't make every score 1
    sure = (np.count_nonzero(z.argmax(axis=1) == y) + 1) / (len(y) + 2)

    def loss(t: float) -> float:
        p = np.clip(softmax(z / t)[np.arange(len(y)), y], 1e-12, 1 - 1e-12)
        return -float((sure * np.log(p) + (1 - sure) * np.log1p(-p)).mean())

    model.temperature = min((2.0 ** (k / 4) for k in range(-16, 17)), key=loss)
    p = softmax(z / model.temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-score, kind="stable")
    accuracy = np.cumsum(right[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(accuracy >= TARGET_ACCURACY)
    accurate = float(score[order][good[-1]]) if len(good) else 1.0
    model.threshold = max(accurate, low_score(score[right]))


def low_score(scores: np.ndarray) -> float:
    """The highest of ``scores`` that rejects, of all texts scored like them, no
    more than MAX_FALSE_REJECTION, but for a chance of MISTAKE_PROBABILITY.

    The share under the m-th least of n scores is over p with a chance of
    P(Bin(n, p) < m), exactly. Too few scores for the bound give the least
    of them; no scores give 1.
    """
    n = len(scores)
    if not n:
        return 1.0
    m = 1 + max(0, allowed_losses(n, MAX_FALSE_REJECTION, MISTAKE_PROBABILITY))
    return float(np.sort(scores)[m - 1])


def fit_languages(docs: DataFrame) -> LanguageModel:
    """A model from the rows of ``docs`` that aren't held out."""
    return train(training_sample(pick(docs, "doc_id", "text", "lang")))


def predict_languages(docs: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """``keep`` and lang_pred, score, accepted for every whole text.

    Only the text decides. Null, empty and letterless texts are ``und``
    with score 0 and aren't accepted; repeated rows are judged alike; an
    empty table gives none. Without any labelled row all texts are ``und``.
    """
    types = dict(docs.dtypes)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages numbers: 26 MB at most

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            found = [shared.value.predict(x) for x in batch["text"]]
            names = ("lang_pred", "score", "accepted")
            yield {c: batch[c] for c in keep} | {n: [f[i] for f in found] for i, n in enumerate(names)}

    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keep), "lang_pred string, score double, accepted boolean"])
    columns = list(dict.fromkeys([*keep, "text"]))
    return map_columns(pick(docs, *columns), work, schema)


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose language is identified, with all their columns.

    Only the text decides: null, empty and letterless texts go, repeated rows
    are judged alike, a null doc_id or lang like any other; an empty table gives none.
    """
    prepare(docs.sparkSession)
    at = positional(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def accepted(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.predict(x)[2] for x in texts.to_pylist()], pa.bool_())

    return at.where(accepted(f"c{docs.columns.index('text')}")).toDF(*docs.columns)
