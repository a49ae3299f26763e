"""Toxic passages as maximum-scoring segments of token log-odds.

Each word gets the log-odds of toxic against other labelled documents with an informative
Dirichlet prior (the background of both classes).  A linear-time scan (Ruzzo and Tompa) finds all
maximal-scoring segments of a document.  Segment scores of documents without toxic passages follow
an extreme-value law, fitted on labelled documents; it says how surprising the best segment of a
text of that length is, which segments are significant, and how surprising several are together.  A
logistic curve over this evidence gives the score.

Words are features themselves and through their beginnings of 5 to 7 characters, which covers
inflected and compound forms; the feature that tells most decides.  Features are hashed into
`BUCKETS` slots, so the model has a fixed size.

The model is fitted on at most `train_rows` labelled documents (those with the smallest hash of
their id): log-odds on four fifths, extreme-value law and curve on the rest, so that no text is
judged by odds it helped to set.  Every document is scored over its whole text, in one pass
without a shuffle.

Null and empty texts have no segment and get the curve's value for no evidence.  A document
labelled twice counts as toxic if one label says so; null labels count as none.  Without labels of
both classes all texts get the share of toxic labels (0 without any).  Extra columns are not read,
except that `remove_toxic` passes them through.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import map_rows, materialize, small_batches
from dimweave.llm.decontamination import WORD_BYTES

BUCKETS = 1 << 20
BEGINNINGS = (7, 6, 5)
TRAIN_ROWS = 20_000
PRIOR = 2_000.0
FLOOR = 4.0
Z_LEAST = 4.0
DRIFT = 2.0
SIGNIFICANT = 0.01
SHORTEST = 30  # shorter texts count as so long: a few words have no room for chance
NOTHING = -5.0
KNOWN_WORDS = 100_000


def features(word: bytes) -> list[int]:
    """Slots of a word: itself, then its beginnings."""
    slots = [zlib.crc32(word) % BUCKETS]
    letters = word.decode("utf-8", "replace")
    for n in BEGINNINGS:
        if len(letters) > n:
            slots.append(zlib.crc32(b"^" + letters[:n].encode()) % BUCKETS)
    return slots


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(WORD_BYTES).split()


class WordScores(dict):
    """Scores of words, worked out once each; emptied when it holds too many."""

    def __init__(self, odds: np.ndarray, certain: np.ndarray):
        super().__init__()
        self.odds, self.certain = odds, certain

    def __missing__(self, word: bytes) -> float:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        slots = features(word)
        best = max(slots, key=lambda s: abs(self.certain[s]))
        self[word] = score = float(self.odds[best]) - DRIFT
        return score


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score), best first, in linear time.

    Only stretches in which something is positive are looked at one by one."""
    stack: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum at the end
    total = np.concatenate([[0.0], np.cumsum(scores)])
    for at in np.flatnonzero(scores > 0).tolist():
        start, before, after = at, total[at], total[at + 1]
        while stack:
            # the latest segment whose sum before is smaller
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= before:
                k -= 1
            if k < 0 or stack[k][3] >= after:
                break
            start, before = stack[k][0], stack[k][2]
            del stack[k:]
        stack.append((start, at + 1, before, after))
    return sorted(((s, e, b - a) for s, e, a, b in stack), key=lambda x: -x[2])


@dataclass
class Model:
    odds: np.ndarray | None
    certain: np.ndarray | None
    decay: float = 1.0
    scale: float = 1.0
    curve: tuple[float, ...] = ()
    share: float = 0.0

    def surprise(self, score: float, words: int) -> float:
        """-log of the number of segments this good that a clean text of that length has."""
        return self.decay * score - math.log(self.scale * max(words, SHORTEST))

    def evidence(self, found: list[float], words: int) -> tuple[float, float]:
        """How surprising the best segment is, and the r best together for the r that is most so.

        Of segments as good as the r-th, a clean text has E on average; r or more come with a
        probability of at most exp(-(r ln(r / E) - r + E))."""
        together = 0.0
        rated = [self.surprise(x, words) for x in found]
        for r, x in enumerate(rated, 1):
            expected = math.exp(min(-x, 50.0))
            if expected < r:
                together = max(together, r * (math.log(r) + x) - r + expected)
        return max([NOTHING, *rated[:1]]), math.log1p(together)

    def probability(self, best: float, added: float) -> float:
        if not self.curve:
            return self.share
        a, b, c = self.curve
        return 1.0 / (1.0 + math.exp(-min(max(a + b * best + c * added, -500.0), 500.0)))


def log_odds(toxic: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds with an informative Dirichlet prior, and their z-scores.

    The prior says that a word is as frequent in either class: its pseudo-counts, `FLOOR` and a
    part of the background of both classes, are dealt out by the sizes of the classes, so a word
    never seen has odds of exactly 0."""
    both = toxic + other
    prior = FLOOR + PRIOR * both / both.sum()
    a = toxic + prior * (toxic.sum() / both.sum())
    b = other + prior * (other.sum() / both.sum())
    odds = np.log(a / toxic.sum()) - np.log(b / other.sum())
    certain = odds / np.sqrt(1 / a + 1 / b)
    return np.where(np.abs(certain) < Z_LEAST, 0, odds).astype(np.float32), certain.astype(
        np.float32
    )


def extreme_values(best: np.ndarray, lengths: np.ndarray) -> tuple[float, float]:
    """Decay and scale of P(best >= x) = 1 - exp(-scale * length * exp(-decay * x)), by moments
    of what is left when the logarithm of the length is taken off."""
    decay = math.pi / (math.sqrt(6) * max(float(np.std(best)), 0.05))
    for _ in range(20):
        rest = best - np.log(lengths) / decay
        decay = 0.5 * decay + 0.5 * math.pi / (math.sqrt(6) * max(float(np.std(rest)), 0.05))
    rest = best - np.log(lengths) / decay
    return decay, math.exp(decay * float(np.mean(rest)) - 0.5772156649)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """A ridge logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] + [1e-2] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + ridge @ weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(w) for w in weights)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training(docs: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    """Text, label and part (0: odds, 1: calibration) of the labelled documents learnt from."""
    part = F.crc32(F.col("doc_id").cast("string")) % 5
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (part != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_rows)
        .select("doc_id", "toxic", (part == 4).cast("int").alias("part"))
    )
    # at most `train_rows` rows of three numbers
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").drop("doc_id")


def fit(docs: DataFrame, labels: DataFrame, *, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from the labelled documents outside the held-out fifth."""
    spark = docs.sparkSession
    sample = materialize(training(docs, labels, train_rows), "toxic-training")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        seen: Counter[tuple[bool, bytes]] = Counter()
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                seen.update((label == 1, w) for w in words_of(text.as_py()))
        slots: Counter[tuple[bool, int]] = Counter()
        for (toxic, word), n in seen.items():
            for slot in features(word):
                slots[toxic, slot] += n
        yield [(slot, n if toxic else 0, 0 if toxic else n) for (toxic, slot), n in slots.items()]

    counted = map_rows(
        sample.filter("part = 0").select("text", "toxic"), count, "slot int, toxic long, other long"
    )
    # at most BUCKETS rows of three numbers
    table = counted.groupBy("slot").agg(F.sum("toxic"), F.sum("other")).toPandas()
    toxic, other = np.zeros(BUCKETS), np.zeros(BUCKETS)
    toxic[table.iloc[:, 0]], other[table.iloc[:, 0]] = table.iloc[:, 1], table.iloc[:, 2]
    shares = {bool(y): n for y, n in sample.groupBy(F.col("toxic") == 1).count().collect()}
    model = Model(None, None, share=shares.get(True, 0) / max(sum(shares.values()), 1))
    if not toxic.any() or not other.any():
        return model
    model.odds, model.certain = log_odds(toxic, other)
    # at most `train_rows` rows of a label, a length and the best scores
    parts = map_rows(
        sample.filter("part = 1").select("text", "toxic"),
        _scored(spark.sparkContext.broadcast(model)),
        "toxic int, length long, scores array<double>",
    ).toPandas()
    if parts["toxic"].nunique() < 2:
        return model
    clean = parts[(parts["toxic"] == 0) & (parts["length"] > 0)]
    best = np.array([s[0] if len(s) else 0.0 for s in clean["scores"]])
    lengths = np.maximum(clean["length"].to_numpy(float), SHORTEST)
    model.decay, model.scale = extreme_values(best, lengths)
    pairs = zip(parts["scores"], parts["length"], strict=True)
    evidence = [model.evidence(list(s), n) for s, n in pairs]
    model.curve = logistic(np.array(evidence), parts["toxic"].to_numpy(float))
    return model


def _scored(model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        of = WordScores(model.value.odds, model.value.certain)
        for batch in batches:
            rows = []
            for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                scores = word_scores(text.as_py(), of)
                rows.append((int(y == 1), len(scores), [x[2] for x in segments(scores)]))
            yield rows

    return run


def word_scores(text: str | None, of: WordScores) -> np.ndarray:
    return np.array([of[w] for w in words_of(text)], dtype=np.float64)


def _judge(model: Model):
    """A text's score, and its significant segments as word ranges."""
    of = WordScores(model.odds, model.certain)

    def judge(text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        if model.odds is None:
            return model.share, []
        scores = word_scores(text, of)
        found = segments(scores)
        rated = [(s, e, model.surprise(x, len(scores))) for s, e, x in found]
        kept = [x for x in rated if x[2] >= -math.log(SIGNIFICANT)]
        return model.probability(*model.evidence([x[2] for x in found], len(scores))), kept

    return judge


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, `score`, `predicted`, and the significant `passages` as word ranges with their
    surprise in nats."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        judge = _judge(shared.value)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                score, kept = judge(text.as_py())
                found = [{"start": s, "end": e, "nats": x} for s, e, x in sorted(kept)]
                rows.append((doc, score, int(score >= 0.5), found))
            yield rows

    return map_rows(
        docs.select("doc_id", "text"),
        run,
        f"doc_id {kind}, score double, predicted int, "
        "passages array<struct<start:int,end:int,nats:double>>",
    )


def remove_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with a score under 0.5, with all their columns, in one pass."""
    text = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(shared.value)
        for batch in batches:
            keep = [judge(t.as_py())[0] < 0.5 for t in batch.column(text)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
