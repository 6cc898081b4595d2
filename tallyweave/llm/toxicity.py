"""Toxicity by class-conditional Kneser-Ney models.

Two character models, one of toxic and one of ordinary labelled texts, share every backoff level:
only the longest n-grams are counted per class, all shorter ones are Kneser-Ney continuation counts
of both classes together. An expression seen once or never in a class therefore falls back to the
same probabilities in both models, and says little about either.

A word's evidence is its log-likelihood under the toxic model less that under the ordinary one. A
text is scored by length-normalised evidence, of the whole text and of its strongest passages of
``PASSAGES`` words, so that a long text does not dilute an insult. A logistic curve fitted on labelled
rows brings these measures to 0..1.

Empty texts and texts without words have no evidence: every measure is 0 and the curve gives their
score. Rows, also repeated ones, are scored independently of each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.text import fold, segment_sums, slices, whole_text

ORDER = 6
PASSAGES = (1, 4, 12)
DISCOUNT = 0.75
#: Labelled rows of each class that the models learn from, at most.
TRAIN_ROWS = 6_000
#: Longest n-grams kept, the most frequent ones; it bounds the model that is sent to executors.
MAX_GRAMS = 1_500_000
THRESHOLD = 0.7
_BITS = 10
_WORD = re.compile(r"[^\W\d_]+")
_EDGE = 1  # marks both ends of a word


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of length ORDER of each word between its edges, packed into 60 bits, and how many.

    A character takes 10 bits: its code point, beyond the Basic Latin to Latin Extended blocks a hash.
    """
    sizes = np.fromiter(map(len, vocabulary), dtype=np.int64, count=len(vocabulary)) + 1
    if not len(sizes):
        return np.zeros(0, np.int64), sizes
    pad = "\x01" * (ORDER - 1)
    flat = np.frombuffer((pad + f"\x01{pad}".join(vocabulary) + "\x01").encode(
        "utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    flat = np.where(flat < 592, flat, 592 + flat % 431)
    packed = np.zeros(len(flat) - ORDER + 1, np.int64)
    for k in range(ORDER):
        packed = (packed << _BITS) | flat[k:len(flat) - ORDER + 1 + k]
    # a word of n letters starts its n+1 n-grams at its padding; the next word starts ORDER-1 later
    starts = np.concatenate([[0], np.cumsum(sizes + ORDER - 1)[:-1]])
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return packed[at + np.arange(len(at))], sizes


def _totals(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, inverse = np.unique(keys, return_inverse=True)
    return found, np.bincount(inverse, weights=values, minlength=len(found))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class _Level:
    """Counts of one n-gram length: of n-grams, and per context the total and the distinct ends."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = _totals(keys, counts)
        self.contexts, self.total = _totals(self.keys >> _BITS, self.counts)
        _, self.kinds = _totals(self.keys >> _BITS, np.ones(len(self.keys)))

    def mix(self, wanted: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Interpolated Kneser-Ney probability given that of the shorter context."""
        at, seen = _find(self.keys, wanted)
        count = np.where(seen, self.counts[at] if len(self.keys) else 0.0, 0.0)
        at, known = _find(self.contexts, wanted >> _BITS)
        if not len(self.contexts):
            return lower
        total = np.where(known, self.total[at], 1.0)
        kinds = np.where(known, self.kinds[at], 0.0)
        mixed = (np.maximum(count - DISCOUNT, 0) + DISCOUNT * kinds * lower) / total
        return np.where(known, mixed, lower)


class Models:
    """The two models; ``evidence`` gives each word's log-likelihood ratio in nats."""

    def __init__(self, keys: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray):
        self.tops = [_Level(keys[n > 0], n[n > 0].astype(float)) for n in (toxic, ordinary)]
        self.shared, left = [], np.unique(keys)
        for length in range(ORDER - 1, 0, -1):
            shorter = left & ((1 << (_BITS * length)) - 1)
            self.shared.append(_Level(shorter, np.ones(len(shorter))))
            left = np.unique(shorter)

    def evidence(self, vocabulary: list[str]) -> np.ndarray:
        packed, sizes = grams(vocabulary)
        if not len(sizes):
            return np.zeros(0)
        packed, back = np.unique(packed, return_inverse=True)
        p = np.full(len(packed), 1.0 / (1 << _BITS))
        for length, level in zip(range(1, ORDER), reversed(self.shared)):
            p = level.mix(packed & ((1 << (_BITS * length)) - 1), p)
        ratio = np.log(self.tops[0].mix(packed, p)) - np.log(self.tops[1].mix(packed, p))
        return segment_sums(ratio[back], sizes)


def measures(models: Models, texts: list[str]) -> np.ndarray:
    """Per text: mean evidence a word over the whole text, then over the strongest run of each of
    ``PASSAGES`` words; what a shorter text lacks counts as words without evidence."""
    out = np.zeros((len(texts), 1 + len(PASSAGES)))
    for part in slices(texts):
        lists = [words(t) for t in texts[part]]
        sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        codes, kinds = pd.factorize(np.array([w for ws in lists for w in ws], dtype=object))
        if not len(codes):
            continue
        values = models.evidence(list(kinds))[codes]
        out[part, 0] = segment_sums(values, sizes) / np.maximum(sizes, 1)
        total, ends = np.concatenate([[0], np.cumsum(values)]), np.cumsum(sizes)
        some = np.flatnonzero(sizes)
        rows = np.arange(part.start, part.stop)[some]
        for k, length in enumerate(PASSAGES):
            runs = np.where(sizes == 0, 0, np.maximum(sizes - length + 1, 1))
            begin = np.concatenate([[0], np.cumsum(runs)[:-1]])
            first = np.repeat(ends - sizes - begin, runs) + np.arange(runs.sum())
            last = np.minimum(first + length, np.repeat(ends, runs))
            out[rows, 1 + k] = np.maximum.reduceat(total[last] - total[first], begin[some]) / length
    return out


@dataclass
class Scorer:
    """Models with the fitted curve; ``weights`` are of the measures and the constant."""

    models: Models
    weights: np.ndarray

    def __call__(self, texts: list[str]) -> np.ndarray:
        x = measures(self.models, texts) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps, both classes weighted as they occur."""
    full = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(full.shape[1])
    penalty = ridge * np.diag([1.0] * x.shape[1] + [1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -40, 40)))
        step = np.linalg.solve((full * (p * (1 - p) + 1e-9)[:, None]).T @ full + penalty,
                               full.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic, part) of at most ``rows`` labelled documents of each class.

    The rows with the smallest hash of their id are taken, each in part 0 or 1; labels of ids with
    crc32 modulo 3 equal to 1 are held out. Unlabelled (null) rows and ids do not count; of several
    labels of an id the highest holds.
    """
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
                          & (fold("doc_id", 3) != 1))
             .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
             .withColumn("_order", F.xxhash64("_id")))
    parts = [known.where(F.col("_toxic") == k).orderBy("_order", "_id").limit(rows)
             for k in (0, 1)]
    # at most 2 * rows ids with a number each
    chosen = F.broadcast(parts[0].unionAll(parts[1]))
    return (docs.select(F.col("doc_id").alias("_doc"), whole_text().alias("text"))
            .join(chosen, F.col("_doc") == F.col("_id"))
            .select("text", F.col("_toxic").alias("toxic"),
                    F.pmod(F.col("_order"), F.lit(2)).alias("part")))


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for (toxic, part), rows in batch.groupby(["toxic", "part"]):
            texts = rows["text"].tolist()
            for piece in slices(texts):
                codes, kinds = pd.factorize(np.array(
                    [w for t in texts[piece] for w in words(t)], dtype=object))
                if not len(codes):
                    continue
                packed, sizes = grams(list(kinds))
                keys, counts = _totals(packed, np.repeat(np.bincount(codes), sizes))
                yield pd.DataFrame({"gram": keys, "part": part,
                                    "toxic": counts.astype(np.int64) * toxic,
                                    "ordinary": counts.astype(np.int64) * (1 - toxic)})


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Scorer:
    """Learn both models and the curve from a bounded sample of labelled rows.

    The sample is cut in two: models of either part measure the other one, and the curve is fitted to
    those measures, as texts that a model has seen look surer than they are. The final models know
    both parts. Without labelled rows every text scores 0.5.
    """
    spark = docs.sparkSession
    sample = training_rows(docs, labels, rows)
    counted = (sample.mapInPandas(
        _count_grams, "gram long, part int, toxic long, ordinary long")
        .groupBy("gram").agg(*[F.sum(F.when(F.col("part") == k, F.col(c)).otherwise(0)).alias(
            f"{c}{k}") for k in (0, 1) for c in ("toxic", "ordinary")])
        .orderBy(F.expr("toxic0 + toxic1 + ordinary0 + ordinary1").desc(), "gram")
        .limit(MAX_GRAMS).toPandas())
    keys = counted["gram"].to_numpy(np.int64)
    counts = {c: counted[c].to_numpy(np.int64)
              for c in ("toxic0", "toxic1", "ordinary0", "ordinary1")}
    halves = []
    for k in (0, 1):
        some = (counts[f"toxic{k}"] + counts[f"ordinary{k}"]) > 0
        halves.append(Models(keys[some], counts[f"toxic{k}"][some], counts[f"ordinary{k}"][some]))
    sent = spark.sparkContext.broadcast(halves)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, own in batch.groupby("part"):
                x = measures(sent.value[1 - int(part)], own["text"].tolist())
                yield pd.DataFrame(np.column_stack([x, own["toxic"].to_numpy(np.float64)]),
                                   columns=names)

    names = [f"m{k}" for k in range(1 + len(PASSAGES))] + ["toxic"]
    seen = sample.mapInPandas(measure, ", ".join(f"{n} double" for n in names)).toPandas()
    weights = (fit_curve(seen[names[:-1]].to_numpy(), seen["toxic"].to_numpy())
               if seen["toxic"].nunique() == 2 else np.zeros(len(names)))
    return Scorer(Models(keys, counts["toxic0"] + counts["toxic1"],
                         counts["ordinary0"] + counts["ordinary1"]), weights)


def score_column(scorer: Scorer, docs: DataFrame, text: str = "text") -> Column:
    """Toxicity of a text column, 0..1; the model is broadcast, its size is bounded by training."""
    sent = docs.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(sent.value(batch.tolist()))

    return score(whole_text(text))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``THRESHOLD`` on) of every row."""
    scorer = train(docs, labels)
    return (docs.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"),
                        score_column(scorer, docs).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that do not score as toxic."""
    return docs.where(score_column(train(docs, labels), docs) < THRESHOLD)
