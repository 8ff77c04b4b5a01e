"""Language-model scoring with a log-bilinear model.

Tokens are words with A-Z lower-cased and one end token a text.  The model
predicts a token's *unit*: each of the `FREQUENT` commonest words is one, all
other words share `CLASSES` units by their last letters.  With context words
u, v (one and two places back) the predicted vector is L1 r[u] + L2 r[v], and a
unit scores its inner product with the target vector plus a bias.  Within a
shared unit a word has the add-one share of its training count, with one place
for unseen words, so the probabilities of a context sum to one.

Training is noise-contrastive, in numpy, on all training texts: every task
trains on its own texts from the same start and the parameters are averaged
with the number of tokens as weight, in a shuffle; `EPOCHS` rounds.
With so few units the normaliser of *every* context is one batched matrix
product, so scoring a token is a look-up and an inner product.

Counts cover all training texts.  Words outside the `KNOWN` commonest, whose
counts are broadcast, are looked up in a shuffled join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DoubleType, FloatType, IntegerType, LongType, StringType,
                               StructField, StructType)

from tessera.llm.common import held_out, written

FREQUENT, CLASSES = 895, 128
KNOWN = 1 << 17  # words whose counts are broadcast
WIDTH = 16  # of the vectors
EPOCHS = 1
BATCH, NOISE, RATE = 4096, 64, 0.3
FOLDS = 7
END = b""  # no word is empty
_SALT = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[bytes]:
    """Words of a text and the end token."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def word_class(word: bytes) -> int:
    """The shared unit (0 to CLASSES - 1) of a word, by its last three bytes."""
    return int((int.from_bytes(word[-3:], "little") * int(_SALT) >> 40) % CLASSES)


@dataclass
class Vocabulary:
    """What scoring needs of the training counts; bounded by `KNOWN` words."""

    counts: dict[bytes, int]  # of the commonest words
    n_tokens: int
    n_words: int  # distinct
    class_tokens: np.ndarray  # per shared unit
    class_words: np.ndarray

    def __post_init__(self):
        ranked = sorted(self.counts, key=lambda w: (-self.counts[w], w))[:FREQUENT]
        self.unit = {w: k for k, w in enumerate(ranked)}
        self.shared = len(self.unit)  # first shared unit
        self.start = self.shared + CLASSES  # context before the text
        self.n_units = self.start  # predicted: frequent and shared


class Units(dict):
    """Word -> unit, filled as words come."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary.unit)
        self.shared = vocabulary.shared

    def __missing__(self, word: bytes) -> int:
        return self.shared + word_class(word)


@dataclass
class LogBilinear:
    context: np.ndarray  # (units + 1, width): r, with the start
    mix: np.ndarray  # (2, width, width): L1, L2
    target: np.ndarray  # (units, width)
    bias: np.ndarray  # (units,)

    @staticmethod
    def new(unigram: np.ndarray) -> LogBilinear:
        rng = np.random.default_rng(7)
        n = len(unigram)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return LogBilinear(draw(n + 1, WIDTH), np.stack([np.eye(WIDTH, dtype=np.float32) for _ in range(2)]),
                           draw(n, WIDTH), np.log(unigram).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.mix, self.target, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def replaced(self, flat: np.ndarray) -> LogBilinear:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at:at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return LogBilinear(*out)

    def predicted(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        return self.context[u] @ self.mix[0] + self.context[v] @ self.mix[1]

    def normalisers(self) -> np.ndarray:
        """log of the sum over units of exp(score), for every pair of context
        units: one batch of matrix products for each unit two places back."""
        one, two = self.context @ self.mix[0], self.context @ self.mix[1]
        out = np.empty((len(two), len(one)), np.float32)
        base = one @ self.target.T + self.bias  # (u, unit)
        high = base.max(axis=1, keepdims=True)
        weight = np.exp(base - high)  # exp(a + b) = exp(a) exp(b): one product sums over the units
        shift = two @ self.target.T  # (v, unit)
        top = shift.max(axis=1, keepdims=True)
        out[:] = np.log(np.maximum(np.exp(shift - top) @ weight.T, 1e-35)) + top + high.T
        return out


def contexts(units: np.ndarray, ends: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Units one and two places back in concatenated texts; `ends` are the
    places of the end tokens."""
    one, two = np.empty_like(units), np.empty_like(units)
    one[1:], two[2:] = units[:-1], units[:-2]
    first = np.concatenate([[0], ends[:-1] + 1])
    one[first] = start
    two[first] = start
    second = first + 1
    two[second[second < len(units)]] = start
    two[first] = start
    return one, two


class _Trainer:
    """Noise-contrastive estimation with AdaGrad steps on batches."""

    def __init__(self, model: LogBilinear, unigram: np.ndarray, seed: int):
        self.m = model.replaced(model.flat())
        self.noise = unigram
        self.log_noise = np.log(unigram * NOISE).astype(np.float32)
        self.heavy = np.cumsum(unigram)
        self.rng = np.random.default_rng(seed)
        self.second = [np.full(p.shape, 1e-2, np.float32) for p in self.m.parts()]
        self.seen = 0

    def _step(self, k: int, gradient: np.ndarray) -> None:
        self.second[k] += gradient * gradient
        self.m.parts()[k][...] -= RATE * gradient / np.sqrt(self.second[k])

    def batch(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> None:
        m = self.m
        noise = np.minimum(np.searchsorted(self.heavy, self.rng.random(NOISE)), len(self.heavy) - 1)
        ru, rv = m.context[u], m.context[v]
        h = ru @ m.mix[0] + rv @ m.mix[1]
        q, qn = m.target[w], m.target[noise]
        sigmoid = lambda x: 1 / (1 + np.exp(-x))
        data = sigmoid((h * q).sum(1) + m.bias[w] - self.log_noise[w]) - 1  # (batch,)
        fake = sigmoid(h @ qn.T + m.bias[noise] - self.log_noise[noise])  # (batch, noise)
        dh = data[:, None] * q + fake @ qn
        scale = np.float32(1 / len(w))
        dt, db = np.zeros_like(m.target), np.zeros_like(m.bias)
        _add_rows(dt, w, data[:, None] * h)
        np.add.at(dt, noise, fake.T @ h)
        db += np.bincount(w, data, len(db)).astype(np.float32)
        np.add.at(db, noise, fake.sum(0))
        dc = np.zeros_like(m.context)
        _add_rows(dc, u, dh @ m.mix[0].T)
        _add_rows(dc, v, dh @ m.mix[1].T)
        dm = np.stack([ru.T @ dh, rv.T @ dh])
        for k, g in enumerate((dc, dm, dt, db)):
            self._step(k, g * scale)
        self.seen += len(w)


def _add_rows(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    order = np.argsort(at, kind="stable")
    keys = at[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    out[keys[starts]] += np.add.reduceat(rows[order], starts)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over the texts of `docs` (text); words as bytes."""
    schema = StructType([StructField("word", BinaryType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for b in batches:
            for text in b.column("text"):
                counts.update(tokens(text.as_py()))
                if len(counts) > 400_000:
                    yield rows()
        yield rows()

    return docs.mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the written counts: totals, the `KNOWN` commonest words, and per
    shared unit the tokens and distinct words outside the `FREQUENT`."""
    # the least count that no more than KNOWN words reach, from a histogram with 16 steps a power of two
    step = F.floor(F.log2("n") * 16).cast("int")
    room, least = KNOWN, None
    for at, n in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        if n > room:
            break
        room, least = room - n, at
    top = counts.where(step >= least).collect() if least is not None else []  # KNOWN rows at most
    known = {bytes(r.word): r.n for r in top}
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    schema = StructType([StructField("unit", IntegerType()), StructField("n", LongType())])

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            unit = [word_class(w) for w in b.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(unit, pa.int32()), b.column("n")], ["unit", "n"])

    tokens_of, words_of = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.mapInArrow(classed, schema).groupBy("unit").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        tokens_of[r.unit], words_of[r.unit] = r.n, r.words
    out = Vocabulary(known, total[0], total[1], tokens_of, words_of)
    for w in out.unit:
        tokens_of[word_class(w)] -= known[w]
        words_of[word_class(w)] -= 1
    return out


def unigram(v: Vocabulary) -> np.ndarray:
    counts = np.concatenate([np.array([v.counts[w] for w in v.unit], float), v.class_tokens]) + 1
    return counts / counts.sum()


def _text_units(texts: list[str | None], units: Units) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    words = [tokens(t) for t in texts]
    ends = np.cumsum([len(w) for w in words]) - 1
    flat = np.fromiter((u for w in words for u in map(units.__getitem__, w)), np.int64, int(ends[-1]) + 1)
    return flat, ends, words


def train(docs: DataFrame, v: Vocabulary, epochs: int = EPOCHS) -> LogBilinear:
    """The averaged model of all tasks; `docs` has the column text."""
    noise = unigram(v)
    model = LogBilinear.new(noise)
    schema = StructType([StructField("block", IntegerType()), StructField("weight", DoubleType()),
                         StructField("values", ArrayType(FloatType()))])
    block = 4096
    for epoch in range(epochs):
        def run(batches: Iterator[pa.RecordBatch], model=model, epoch=epoch) -> Iterator[pa.RecordBatch]:
            trainer, units = _Trainer(model, noise, 1000 + epoch), Units(v)
            for b in batches:
                texts = b.column("text").to_pylist()
                for at in range(0, len(texts), 256):
                    flat, ends, _ = _text_units(texts[at:at + 256], units)
                    one, two = contexts(flat, ends, v.start)
                    order = trainer.rng.permutation(len(flat))
                    for s in range(0, len(order), BATCH):
                        some = order[s:s + BATCH]
                        trainer.batch(one[some], two[some], flat[some])
            if trainer.seen:
                flat = trainer.m.flat()
                parts = [flat[k:k + block] for k in range(0, len(flat), block)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(len(parts)), pa.int32()), pa.array([float(trainer.seen)] * len(parts)),
                    pa.array([p.tolist() for p in parts], pa.list_(pa.float32()))], schema.fieldNames())

        trained = docs.select("text").mapInArrow(run, schema)
        # one row a block and place: sums that combine before the shuffle
        summed = trained.select("block", "weight", F.posexplode("values").alias("place", "value")).groupBy("block", "place").agg(
            (F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("value"))
        flat = model.flat()
        rows = summed.select((F.col("block") * block + F.col("place")).alias("k"), "value").toPandas()  # as many as parameters
        flat[rows["k"].to_numpy()] = rows["value"].to_numpy()
        model = model.replaced(flat)
    return model


class Scorer:
    """Scores texts with the broadcast counts; what needs the count of another
    word is left to a join."""

    def __init__(self, v: Vocabulary, model: LogBilinear):
        self.v, self.model, self.norm = v, model, model.normalisers()
        self.number = {w: k for k, w in enumerate(v.counts)}
        counts = np.array(list(v.counts.values()), float)
        self.log_count = np.log10(counts + 1)
        self.units = Units(v)
        self.unit = np.array([self.units[w] for w in v.counts], np.int64).reshape(-1)
        # log10 of the places in a word's shared unit; 0 for a unit of its own
        self.places = np.concatenate([np.zeros(v.shared), np.log10(v.class_tokens + v.class_words + 1)])

    def score(self, texts: list[str | None]) -> list[tuple]:
        """Per text: tokens, known ones, sum of log10(c + 1), log10
        probability but for the other words' log10(c + 1), the other words
        and how often each occurs."""
        words = [tokens(t) for t in texts]
        lengths = np.array([len(w) for w in words])
        ends = np.cumsum(lengths) - 1
        get = self.number.get
        number = np.fromiter((get(x, -1) for w in words for x in w), np.int64, int(ends[-1]) + 1)
        other = np.flatnonzero(number < 0)
        unit = self.unit[number] if len(self.unit) else np.zeros(len(number), np.int64)
        text_of = np.repeat(np.arange(len(texts)), lengths)
        starts = ends - lengths + 1
        rare: list[Counter] = [Counter() for _ in texts]
        for place, t in zip(other.tolist(), text_of[other].tolist()):
            w = words[t][place - starts[t]]
            unit[place] = self.units[w]
            rare[t][w] += 1
        log_count = np.where(number >= 0, self.log_count[number] if len(self.log_count) else 0.0, 0.0)
        one, two = contexts(unit, ends, self.v.start)
        m = self.model
        logs = np.empty(len(unit))
        for s in range(0, len(unit), 65536):
            e = slice(s, s + 65536)
            u, v, w = one[e], two[e], unit[e]
            logs[e] = (m.predicted(u, v) * m.target[w]).sum(1) + m.bias[w] - self.norm[v, u]
        logs /= math.log(10)
        logs += np.where(unit >= self.v.shared, log_count - self.places[unit], 0.0)
        sums = lambda x: np.add.reduceat(x, starts)
        return list(zip(lengths.tolist(), sums((number >= 0).astype(np.int64)).tolist(), sums(log_count).tolist(), sums(logs).tolist(), rare))


def score(docs: DataFrame, v: Vocabulary, counts: DataFrame, model: LogBilinear) -> DataFrame:
    """Adds to the rows of `docs` (with a column text and no column of these
    names): n_tokens, n_known, train_tokens, base_score, score; drops text."""
    shared = docs.sparkSession.sparkContext.broadcast((v, model))
    keep = [f for f in docs.schema.fields if f.name != "text"]
    rare = ArrayType(StructType([StructField("word", BinaryType()), StructField("times", LongType())]))
    schema = StructType([*keep, StructField("n_tokens", LongType()), StructField("n_known", LongType()),
                         StructField("log_counts", DoubleType()), StructField("logs", DoubleType()), StructField("rare", rare)])
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows = list(zip(*scorer.score(part.column("text").to_pylist())))
                others = [[{"word": w, "times": n} for w, n in r.items()] for r in rows[4]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()),
                     pa.array(rows[2], pa.float64()), pa.array(rows[3], pa.float64()), pa.array(others, rare_type)], schema.fieldNames())

    part = written(docs.mapInArrow(run, schema).withColumn("rid", F.monotonically_increasing_id()), "scores")
    words = part.select("rid", F.explode("rare").alias("r")).select("rid", "r.word", "r.times")
    c = F.coalesce(F.col("n"), F.lit(0))
    found = words.join(counts, "word", "left").groupBy("rid").agg(
        F.sum(F.col("times") * F.log10(c + 1)).alias("more"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"))
    more = F.coalesce("more", F.lit(0.0))
    places = math.log10(v.n_tokens + v.n_words + 1)
    return part.join(found, "rid", "left").select(
        *names, "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(v.n_tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + more - F.col("n_tokens") * places).alias("base_score"), (F.col("logs") + more).alias("score"))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10 probabilities of the whole text, end token included).

    Learns from the rows that are not held out (crc32(id as text) mod `folds`
    is not 2; a null id is not held out).  A null text counts as empty: one
    end token.  Rows that repeat count and score alike; an empty table gives no
    rows; with rows but no training rows every word is unseen.  Only id and
    text are read."""
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col, folds).alias("held_out"), F.col(text_col).alias("text"))
    training = rows.where(~F.col("held_out")).select("text")
    counts = written(count_words(training), "word-counts")
    v = vocabulary(counts)
    return score(rows, v, counts, train(training, v))
