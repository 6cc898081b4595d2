"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of words with smallest period q, at least 3 * q words (and ``LEAST``) long, that no
neighbouring word extends. At scale s the words are cut into blocks of s. A run of a period from s up
to 2 * s - 1 holds a whole block together with what stands a period later, since it is long enough.
So for every block its occurrences at those distances are sought: the sum of squared differences
of block and window at a distance is 0 exactly if they agree. All sums of a block come from one
convolution by a number-theoretic transform modulo ``PRIME``. Words count as small numbers, so that no sum
reaches the prime and each is exact; different words may share a number, so a zero may be a false one
but none is missed. The smallest scale, of ``SMALLEST`` words, also takes the distances below it.

A zero at distance d is the seed of an extension: neighbouring blocks with the same distance are taken
together and compared word by word with what stands d later, up to a block further on both sides,
where the next block did not agree. Stretches that are long enough are runs of period d, unless the same
stretch has a smaller period; then that one, which divides d, has been found too.

A block that holds a word with no equal word within reach can occur nowhere in its window and is not
transformed. A transform is made of products with small matrices, which are exact in floating point.

Several texts are searched at once as one sequence, in which words of different texts differ. Null and
empty texts have no words and no runs. Rows, also repeated ones, are searched each; an empty table gives
no rows. A text is searched whole however long, in memory in proportion to its length. Only doc_id and
text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.text import documents, slices
from tallyweave.session import bind

#: A run has at least so many words, and so many periods.
LEAST, TIMES = 24, 3
#: Words of a block at the smallest scale; LEAST leaves room for one there with any smaller period.
SMALLEST = 8
#: Words of a block at most: larger scales keep it, and take their distances in several windows.
LARGEST = 1 << 19
# A prime 7 * 2**20 + 1 below 2**23 and a generator of its multiplicative group.
PRIME, ROOT = 7 * 2 ** 20 + 1, 3
#: A transform's factors have at most so many points: sums of so many products stay below 2**53.
POINTS = 128
#: Numbers in one batch of transforms.
BATCH = 1 << 20
NEVER = 1 << 60


def residue(x: np.ndarray) -> np.ndarray:
    """The residues of whole numbers below 2**53 that are nearest to zero."""
    return x - np.rint(x * (1.0 / PRIME)) * PRIME


@cache
def powers(size: int, rows: int, columns: int) -> np.ndarray:
    """w ** (i * j) for a root w of unity of the given order, as residues nearest to zero."""
    root, table = pow(ROOT, (PRIME - 1) // size, PRIME), np.ones(size, dtype=np.int64)
    for k in range(1, size):
        table[k] = table[k - 1] * root % PRIME
    at = np.arange(rows)[:, None] * np.arange(columns) % size
    return residue(table[at].astype(np.float64))


def transform(x: np.ndarray) -> np.ndarray:
    """Number-theoretic transforms of the rows; their length is a power of two up to 2**20."""
    size = x.shape[1]
    if size <= POINTS:
        return residue(x @ powers(size, size, size))
    first = min(POINTS, 1 << size.bit_length() // 2)
    rest = size // first
    inner = residue(np.matmul(powers(first, first, first), x.reshape(len(x), first, rest)))
    inner = residue(inner * powers(size, first, rest))
    outer = transform(inner.reshape(-1, rest)).reshape(len(x), first, rest)
    return outer.transpose(0, 2, 1).reshape(len(x), size)


def zeros(values: np.ndarray, begin: np.ndarray, size: int, low: int, high: int):
    """(block, distance) where the block of ``size`` values from ``begin`` equals, value by value, what
    stands a distance from ``low`` to ``high`` later. ``values`` are whole numbers whose squared
    differences summed over a block stay below the prime, as far as the last distance reaches."""
    count = high - low + 1
    length = 1 << (size + count - 2).bit_length()
    window = size + count - 1
    square = np.concatenate([[0.0], np.cumsum(values * values)])
    inverse = float(pow(length, PRIME - 2, PRIME))
    back = np.concatenate([[0], np.arange(length - 1, 0, -1)])
    found = []
    for k in range(0, len(begin), max(1, BATCH // length)):
        own = begin[k:k + max(1, BATCH // length)]
        block = np.zeros((len(own), length))
        block[:, :size] = values[own[:, None] + np.arange(size)]
        later = np.zeros((len(own), length))
        later[:, :window] = values[own[:, None] + low + np.arange(window)]
        product = residue(transform(block)[:, back] * transform(later))
        cross = residue(transform(product)[:, back][:, :count] * inverse)
        at = own[:, None] + low + np.arange(count)
        both = (square[own + size] - square[own])[:, None] + square[at + size] - square[at]
        row, shift = np.nonzero(residue(both - 2 * cross) == 0)
        found.append((k + row, shift + low))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def reach(ids: np.ndarray) -> np.ndarray:
    """How far behind each word the next equal one stands."""
    order = np.argsort(ids, kind="stable")
    out = np.full(len(ids), NEVER, dtype=np.int64)
    same = ids[order[1:]] == ids[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


class Found:
    """Runs found so far, and whether one of them explains a seed."""

    def __init__(self):
        self.runs: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, period: int) -> None:
        self.runs[start, end] = min(period, self.runs.get((start, end), period))

    def explain(self, start: np.ndarray, end: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Where a run covers start..end with a smaller period that divides the distance: then the
        stretch that the seed extends to is that run."""
        if not self.runs:
            return np.zeros(len(start), dtype=bool)
        own = np.array(sorted((a, b, q) for (a, b), q in self.runs.items()))
        last = np.maximum.accumulate(own[:, 1])
        widest = np.maximum.accumulate(np.where(own[:, 1] == last, np.arange(len(own)), 0))
        k = np.searchsorted(own[:, 0], start, side="right") - 1
        period = own[widest[k], 2]
        return (k >= 0) & (last[k] >= end) & (distance % period == 0) & (period < distance)


def extend(ids: np.ndarray, begin: int, end: int, size: int, d: int, found: Found) -> None:
    """Add the runs of period d that hold words of begin..end together with what is d later."""
    need = max(LEAST, TIMES * d) - d
    first, last = max(0, begin - size), min(len(ids) - d, end + size)
    equal = np.concatenate([[False], ids[first:last] == ids[first + d:last + d], [False]])
    edge = np.flatnonzero(equal[1:] != equal[:-1]) + first
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if b - a >= need and b > begin and a < end:
            found.add(a, b + d, d)


def find_runs(ids: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs, by start and period; none is longer than ``longest``."""
    n, found = len(ids), Found()
    scale, near = SMALLEST, reach(ids)
    with np.errstate(over="ignore"):
        mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    low = 1
    while max(LEAST, TIMES * low) <= longest:
        size, high = min(scale, LARGEST), 2 * scale - 1
        blocks = n // size
        near_all = near[:blocks * size].reshape(blocks, size).max(axis=1) <= high
        begin = np.flatnonzero(near_all) * size
        kinds = np.uint64(((PRIME - 1) // size) ** 0.5)  # differences stay below
        values = np.concatenate([mixed % kinds, np.zeros(3 * scale + size, np.uint64)])
        values, step = values.astype(np.float64), max(size, SMALLEST * 2 - 1)
        for d in range(low, high + 1, step) if len(begin) else ():
            block, distance = zeros(values, begin, size, d, min(high, d + step - 1))
            start = begin[block]
            inside = start + size + distance <= n
            _seeds(ids, start[inside], distance[inside], size, found)
        scale, low = 2 * scale, 2 * scale
    return sorted((a, b, q) for (a, b), q in found.runs.items())


def _seeds(ids: np.ndarray, start: np.ndarray, distance: np.ndarray, size: int,
           found: Found) -> None:
    """Chain neighbouring blocks of one distance and extend each chain."""
    order = np.lexsort((start, distance))
    start, distance = start[order], distance[order]
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = (distance[1:] != distance[:-1]) | (start[1:] != start[:-1] + size)
    first = np.flatnonzero(fresh)
    end = start[np.append(first[1:], len(start)) - 1] + size if len(first) else start
    begin, d = start[first], distance[first]
    # A chain that is too short by itself must go on at one of its ends.
    n = len(ids)
    before = (begin > 0) & (ids[begin - 1] == ids[begin - 1 + d])
    after = (end + d < n) & (ids[np.minimum(end, n - 1)] == ids[np.minimum(end + d, n - 1)])
    long = (end - begin >= np.maximum(LEAST, TIMES * d) - d) | before | after
    keep = long & ~found.explain(begin, begin + size + d, d)
    for a, b, q in zip(begin[keep].tolist(), end[keep].tolist(), d[keep].tolist()):
        extend(ids, a, b, size, q, found)


def runs_of(texts: list[str]) -> tuple[list[list[str]], list[list[tuple[int, int, int]]]]:
    """The words of each text, and its runs as (start, length, period) by start and period."""
    # bytes.split cuts at the blank and at the bytes 9 to 13, which occur in no other character.
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    known: dict[bytes, int] = {}
    number = known.setdefault
    flat = np.fromiter((number(x, len(known)) for w in words for x in w), np.int64, sizes.sum())
    flat += np.repeat(np.arange(len(words)) * max(1, len(known)), sizes)
    begin = np.cumsum(sizes) - sizes
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(flat):
        runs = find_runs(flat, int(sizes.max()))
        of = np.searchsorted(begin + sizes, [a for a, _, _ in runs], side="right")
        for k, (a, b, q) in zip(of.tolist(), runs):
            out[k].append((a - int(begin[k]), b - a, q))
    return words, out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words but those that a run repeats, joined by blanks."""
    if runs:
        depth = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            depth[start + period] += 1
            depth[start + length] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(depth)[:-1] == 0).tolist()]
    return b" ".join(words).decode("utf-8", "replace")


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, the runs of each row's text, and the text without the words that runs repeat."""
    id_type = dict(docs.dtypes)["doc_id"]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts):
                words, runs = runs_of(texts[part])
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[part].to_numpy(),
                    "runs": [[{"start": a, "length": n, "period": q} for a, n, q in own]
                             for own in runs],
                    "collapsed": [collapse(w, own) for w, own in zip(words, runs)]})

    return documents(docs).mapInPandas(
        search, f"doc_id {id_type}, "
        "runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the words of about a tenth of the rows repeat from some word on.

    With h the crc32 of the doc_id as text: if h ends in 0, words from number a = g % n on, g being
    h / 10, are words a up to a + p - 1 over and over, p = 1 + (n - a) / (3 + g % 8), rounded down.
    Texts without words, and rows without doc_id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # Only chosen texts are split; the split is bound, so that it is made once for each row.
    cut = F.when(h % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    own = bind(documents(docs), _g=F.floor(h / 10).cast("long"), _words=cut)
    a = (F.col("_g") % F.size("_words")).cast("int")
    p = (1 + F.floor((F.size("_words") - a) / (3 + F.col("_g") % 8))).cast("int")
    own = bind(own, _a=F.when(F.size("_words") > 0, a), _p=F.when(F.size("_words") > 0, p))

    def repeated(word: Column, i: Column) -> Column:
        return F.when(i < F.col("_a"), word).otherwise(
            F.get("_words", F.col("_a") + (i - F.col("_a")) % F.col("_p")))

    text = F.when(F.col("_a").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform("_words", repeated), " "))
    return own.select("doc_id", text.alias("text"))


def digest_runs(docs: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the one of greatest length / period, and digests of each row."""
    found = periodic_runs(docs)
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda top, r: F.when(
        r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    row = bind(found, _best=best)
    return row.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col("_best")[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
