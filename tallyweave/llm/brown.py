"""Language-model scores by Brown's class-based bigrams.

    P(w1 .. wn) = product of P(class of wi | class of wi-1) * P(wi | class of wi)

Tokens are the words of a text between white space, A-Z in lower case, and one end; a text begins
after an end. Exchange clustering assigns words to ``CLASSES`` classes so that the likelihood of
adjacent classes is greatest. What is exchanged are units: each of the ``WORDS`` most frequent words,
and for the others ``SHAPES`` groups by their last letters, so that every word, known or not, has a
class. Each sweep sums the classes to the left and right of every unit over the corpus, in Spark, and
moves units one after the other to the class that gains most; the best of all sweeps is kept.

Transitions are interpolated with the frequency of the class; in a word's emission every known word
gives up ``DISCOUNT`` of its count to one unknown word of the class. All counts are of the whole
training part of the corpus. Counts of the ``HEAD`` most frequent words, a bounded table, are sent to
the executors; other tokens meet theirs in a join.

Null and empty texts are one end token. With nothing to learn from, every token is unknown and has the
base probability of 1. Repeated rows are scored, and counted, each.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.shared import stored
from tallyweave.llm.text import documents, fold, slices

CLASSES = 32
WORDS = 3000
SHAPES = 1000
HEAD = 200_000
SWEEPS = 5
DISCOUNT = 0.5
PULL = 20.0
FOLDS = 10
#: The end of a text, which no word between white space can be.
END = b""


def tokens(text: str) -> list[bytes]:
    return [*text.encode("utf-8", "surrogatepass").lower().split(), END]


def shape(word: bytes) -> int:
    """Group of a word that is not among the frequent ones: by its last three letters."""
    tail = word.decode("utf-8", "replace").rstrip(".,;:!?|\"')")[-3:]
    return WORDS + zlib.crc32(tail.encode("utf-8", "replace")) % SHAPES


@dataclass
class Head:
    """The most frequent words in order, their counts, and units of all words."""

    words: list[bytes]
    counts: np.ndarray
    units: np.ndarray
    index: dict[bytes, int] = field(default_factory=dict, repr=False)

    @classmethod
    def of(cls, words: list[bytes], counts: np.ndarray) -> Head:
        units = np.array([k if k < WORDS else shape(w) for k, w in enumerate(words)], np.int64)
        return cls(words, counts, units)

    def __getstate__(self):
        return self.words, self.counts, self.units

    def __setstate__(self, state):
        self.words, self.counts, self.units = state
        self.index = {}

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Of all tokens: place in the head or -1, unit; the words not there; tokens a text."""
        if not self.index:
            self.index = {w: k for k, w in enumerate(self.words)}
        lists = [tokens(t) for t in texts]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = [w for ws in lists for w in ws]
        find = self.index.get
        place = np.fromiter((find(w, -1) for w in flat), np.int64, len(flat))
        rare = [flat[k] for k in np.flatnonzero(place < 0).tolist()]
        unit = np.empty(len(flat), np.int64)
        unit[place >= 0] = self.units[place[place >= 0]] if len(self.units) else 0
        unit[place < 0] = np.fromiter(map(shape, rare), np.int64, len(rare))
        return place, unit, rare, sizes


def count_words(train: DataFrame) -> DataFrame:
    """(word, c) of all training tokens; the end is the empty word."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts):
                found = Counter()
                for t in texts[part]:
                    found.update(tokens(t))
                yield pd.DataFrame({"word": [w.decode("utf-8", "replace") for w in found],
                                    "c": list(found.values())})

    return train.select("text").mapInPandas(count, "word string, c long").groupBy("word").agg(
        F.sum("c").alias("c"))


def head_of(vocabulary: DataFrame) -> Head:
    """The words whose counts are all above some bound, as many as ``HEAD`` allows."""
    most = 1 << 20
    steps = vocabulary.groupBy(F.least("c", F.lit(most)).alias("c")).agg(
        F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).limit(HEAD).collect()
    held, least = 0, None
    for row in steps:
        if held + row["n"] > HEAD and held:
            break
        held, least = held + row["n"], row["c"]
    if least is None:
        return Head.of([], np.zeros(0, np.int64))
    rows = (vocabulary.where(F.col("c") >= least).orderBy(F.desc("c"), "word").limit(HEAD)
            .toPandas())
    return Head.of([w.encode("utf-8", "replace") for w in rows["word"]],
                   rows["c"].to_numpy(np.int64))


def unit_pairs(train: DataFrame, head: Head) -> DataFrame:
    """(a, b, n): how often unit b follows unit a; (WORDS + SHAPES)^2 rows at most."""
    sent = train.sparkSession.sparkContext.broadcast(head)
    width = WORDS + SHAPES
    end = _end_unit(head)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts):
                _, unit, _, _ = sent.value.read(texts[part])
                before = np.concatenate([[end], unit[:-1]])  # each text ends with an end
                pair, n = np.unique(before * width + unit, return_counts=True)
                yield pd.DataFrame({"a": (pair // width).astype(np.int32),
                                    "b": (pair % width).astype(np.int32), "n": n})

    return train.select("text").mapInPandas(count, "a int, b int, n long").groupBy("a", "b").agg(
        F.sum("n").alias("n"))


def _end_unit(head: Head) -> int:
    return int(head.units[head.words.index(END)]) if END in head.words else shape(END)


def _gain(table: np.ndarray) -> np.ndarray:
    return np.where(table > 0, table * np.log(np.maximum(table, 1e-300)), 0.0)


def sweep(classes: np.ndarray, left: np.ndarray, right: np.ndarray, own: np.ndarray,
          half: int) -> np.ndarray:
    """Move every second unit, the most frequent first, to the class that gains most.

    ``left`` and ``right`` count the classes before and after each unit, ``own`` its pairs with
    itself. They are those at the start of the sweep; the class table is kept up to date.
    """
    out = classes.copy()
    many = left.shape[1]
    table = np.zeros((many, many))
    np.add.at(table, out, right)
    size = right.sum(axis=1)
    eye = np.eye(many)
    for u in np.argsort(-size, kind="stable"):
        if (int(u) + half) % 2 or not size[u]:
            continue
        now, l, r, s = out[u], left[u].astype(float), right[u].astype(float), float(own[u])
        l[now] -= s
        r[now] -= s
        rest = table.copy()
        rest[now] -= r
        rest[:, now] -= l
        rest[now, now] -= s
        np.maximum(rest, 0, out=rest)
        rows, cols = rest.sum(axis=1), rest.sum(axis=0)
        # the gain of row and column c of the table with the unit in class c, for every c at once
        new_row = rest + r[None, :]
        new_col = rest + l[:, None]
        corner = np.diag(rest) + r + l + s
        gain = ((_gain(new_row) - _gain(rest)).sum(axis=1) - np.diag(_gain(new_row))
                + (_gain(new_col) - _gain(rest)).sum(axis=0) - np.diag(_gain(new_col))
                + np.diag(_gain(rest)) + _gain(corner))
        # totals of classes before and after change as well
        after = rows[None, :] + l[None, :] + eye * (r.sum() + s)
        ahead = cols[None, :] + r[None, :] + eye * (l.sum() + s)
        gain -= _gain(after).sum(axis=1) + _gain(ahead).sum(axis=1)
        best = int(gain.argmax())
        if gain[best] <= gain[now] + 1e-9:
            best = now
        out[u] = best
        table = rest
        table[best] += r
        table[:, best] += l
        table[best, best] += s
    return out


def likelihood(table: np.ndarray) -> float:
    """Log-likelihood of adjacent classes (as far as it depends on the classes)."""
    return float(_gain(table).sum() - _gain(table.sum(axis=1)).sum()
                 - _gain(table.sum(axis=0)).sum())


def cluster(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Class of every unit and the table of adjacent classes, after ``SWEEPS`` sweeps."""
    width = WORDS + SHAPES
    classes = np.arange(width) % CLASSES
    spark = pairs.sparkSession
    own = np.zeros(width)
    for row in pairs.where("a = b").collect():  # a row a unit
        own[row["a"]] = row["n"]
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    for k in range(SWEEPS + 1):
        sent = spark.sparkContext.broadcast(classes.astype(np.int32))

        def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                a, b = batch["a"].to_numpy(), batch["b"].to_numpy()
                n = batch["n"].to_numpy()
                for unit, near, side in ((a, sent.value[b], 1), (b, sent.value[a], 0)):
                    key, back = np.unique(unit.astype(np.int64) * CLASSES + near,
                                          return_inverse=True)
                    yield pd.DataFrame({
                        "side": side, "unit": (key // CLASSES).astype(np.int32),
                        "near": (key % CLASSES).astype(np.int32),
                        "n": np.bincount(back, weights=n).astype(np.int64)})

        # at most 2 * units * classes rows
        found = (pairs.mapInPandas(around, "side int, unit int, near int, n long")
                 .groupBy("side", "unit", "near").agg(F.sum("n").alias("n")).toPandas())
        sides = np.zeros((2, width, CLASSES))
        sides[found["side"], found["unit"], found["near"]] = found["n"]
        table = np.zeros((CLASSES, CLASSES))
        np.add.at(table, classes, sides[1])
        now = likelihood(table)
        if best is None or now > best[0]:
            best = now, classes, table
        if k < SWEEPS:
            classes = sweep(classes, sides[0], sides[1], own, k)
    return best[1], best[2]


@dataclass
class Model:
    """What a token's probabilities are made of, besides the counts of rare words."""

    head: Head
    classes: np.ndarray
    step: np.ndarray  # log10 of transitions
    size: np.ndarray  # training tokens of each class
    kinds: np.ndarray  # and words
    total: int
    words: int
    end: int

    def emission(self, c: np.ndarray, of: np.ndarray) -> np.ndarray:
        """log10 P(word | class) of words with counts c."""
        size, kinds = self.size[of], self.kinds[of]
        mass = np.where(c > 0, c - DISCOUNT, DISCOUNT * kinds)
        return np.where(size > 0, np.log10(np.maximum(mass, 1e-300) / np.maximum(size, 1)), 0.0)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.total + 0.1 * (self.words + 1)))


def train(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the table (word, c) of all training words, stored."""
    own = documents(docs.where(fold("doc_id", FOLDS) != 0))
    vocabulary = stored(count_words(own))
    sums = vocabulary.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    head = head_of(vocabulary)
    classes, table = cluster(stored(unit_pairs(own, head)))
    sent = docs.sparkSession.sparkContext.broadcast((head, classes))

    def of_class(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, owner = sent.value
        index = {w: k for k, w in enumerate(known.words)}
        for batch in batches:
            words = [w.encode("utf-8", "replace") for w in batch["word"]]
            unit = [known.units[k] if (k := index.get(w, -1)) >= 0 else shape(w) for w in words]
            mine = owner[np.array(unit, np.int64)]
            yield pd.DataFrame({
                "k": np.arange(CLASSES, dtype=np.int32),
                "size": np.bincount(mine, weights=batch["c"], minlength=CLASSES).astype(np.int64),
                "kinds": np.bincount(mine, minlength=CLASSES)})

    size, kinds = np.zeros((2, CLASSES))
    for row in (vocabulary.mapInPandas(of_class, "k int, size long, kinds long").groupBy("k")
                .agg(F.sum("size").alias("size"), F.sum("kinds").alias("kinds")).collect()):
        size[row["k"]], kinds[row["k"]] = row["size"], row["kinds"]
    share = (table.sum(axis=0) + 1) / (table.sum() + CLASSES)
    step = np.log10((table + PULL * share) / (table.sum(axis=1, keepdims=True) + PULL))
    return Model(head, classes, step, size, kinds, sums["n"] or 0, sums["v"],
                 int(classes[_end_unit(head)])), vocabulary


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row, with the
    score a token as perplexity."""
    model, vocabulary = train(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = dict(docs.dtypes)["doc_id"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, made = sent.value, TaskContext.get().partitionId() << 40
        emit = own.emission(own.head.counts, own.classes[own.head.units])
        base = own.base(own.head.counts)
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts):
                place, unit, rare, sizes = own.head.read(texts[part])
                near = own.classes[unit]
                ends = np.cumsum(sizes)
                before = np.concatenate([[own.end], near[:-1]])
                before[(ends - sizes)] = own.end
                known = place >= 0
                at = np.maximum(place, 0)
                value = own.step[before, near]
                if len(emit):
                    value = value + np.where(known, emit[at], 0.0)
                first = ends - sizes
                cuts = np.concatenate([[0], np.cumsum(~known)])
                names = [w.decode("utf-8", "replace") for w in rare]
                groups = near[~known].astype(np.int32)
                yield pd.DataFrame({
                    "row": made + np.arange(len(sizes)),
                    "doc_id": batch["doc_id"].iloc[part].to_numpy(),
                    "held_out": batch["held_out"].iloc[part].to_numpy(),
                    "n_tokens": sizes, "n_known": np.add.reduceat(known.astype(np.int64), first),
                    "base_score": np.add.reduceat(
                        np.where(known, base[at] if len(base) else 0.0, 0.0), first),
                    "score": np.add.reduceat(value, first),
                    "rare": [names[cuts[a]:cuts[b]] for a, b in zip(first, ends)],
                    "rare_class": [groups[cuts[a]:cuts[b]] for a, b in zip(first, ends)]})
                made += len(sizes)

    rows = documents(docs).withColumn("held_out", fold("doc_id", FOLDS) == 0)
    found = stored(rows.mapInPandas(
        read, f"row long, doc_id {id_type}, held_out boolean, n_tokens long, n_known long, "
              "base_score double, score double, rare array<string>, rare_class array<int>"))
    missing = found.where(F.size("rare") > 0).select(
        "row", F.inline(F.arrays_zip("rare", "rare_class")))
    c = F.coalesce("c", F.lit(0))
    size, kinds = (F.element_at(F.array(*[F.lit(float(x)) for x in xs]), F.col("rare_class") + 1)
                   for xs in (model.size, model.kinds))
    mass = F.when(c > 0, c - DISCOUNT).otherwise(DISCOUNT * kinds)
    late = (missing.join(vocabulary, F.col("rare") == F.col("word"), "left")
            .groupBy("row").agg(
                F.sum((c > 0).cast("long")).alias("_known"),
                F.sum(F.log10((c + 0.1) / F.lit(model.total + 0.1 * (model.words + 1)))
                      ).alias("_base"),
                F.sum(F.when(size > 0, F.log10(mass / size)).otherwise(0.0)).alias("_score")))
    whole = found.drop("rare", "rare_class").join(late, "row", "left")
    score = F.col("score") + F.coalesce("_score", F.lit(0.0))
    return whole.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        score.alias("score"), F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"))
