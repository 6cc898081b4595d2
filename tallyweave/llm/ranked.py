"""Ranked lexical search by the Best Position Algorithm over impact lists.

The terms of the items are looked for in all documents: one pass writes, for every document with a term,
its number of terms and those of the items that it holds, and sums give the global counts. Then every
part of ``PART`` such entries is searched by itself. For each term it has the list of its documents by
impact, the greatest first. An item's lists are read downwards together. A document that comes into sight
is looked up in all the item's lists, which gives its whole score and its positions there. A list's best
position is the last one before which every position has been seen, read or looked up; what follows it
has no greater impact. A document not yet seen lies behind the best position of every list, so the
impacts behind them add up to a bound on its score. Reading stops when that bound is strictly below the
score of the k-th best document so far, so that no document of equal score is missed. The parts' best
are merged by score, then doc_id.

Items are taken in blocks of ``TERMS`` terms at most, so what is sent to all tasks is bounded; each block
reads the documents once. An item of more terms is a block by itself.

Scores are whole numbers. Null texts have no terms and match nothing; items without terms get no rows.
Rows that repeat are documents of their own, also with one doc_id; those without doc_id rank behind those
with one. Rows of one item_id are ranked each by itself. Empty tables give no rows. A document is read
whole, however long. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyweave.llm.shared import stored
from tallyweave.llm.text import documents, segment_sums, whole_text

TOP = 50
#: Distinct terms of the items that are searched together.
TERMS = 200_000
#: Entries (document, term) searched together.
PART = 4_000_000
#: Positions read of each list before the bound is looked at; doubled up to ``STRIDE``.
FIRST, STRIDE = 16, 1024
#: Groups in which the parts' hits are merged first.
MERGES = 64
# Fixed value: bytes that are part of a term, the capitals as small letters, all others as blanks.
FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str) -> list[bytes]:
    """The terms of a text in order: ASCII letters (small ones) and digits and all beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


def impacts(weight: np.ndarray, tf: np.ndarray, size: np.ndarray, n: int, total: int):
    """What a term of each weight adds to the score of a document of ``size`` terms that holds it
    ``tf`` times; n documents have ``total`` terms."""
    # The scale of the score, and half of a document's length normalised.
    norm = 100 - 50 + (50 * size * n) // max(1, total)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * norm))


class Lists:
    """Impact lists of a part: entries by term, then by impact from the greatest on."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, kinds: int):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.term = term[order]
        self.begin = np.searchsorted(self.term, np.arange(kinds + 1))
        # Direct access: where each document's entries stand in the lists.
        self.at = np.argsort(self.doc, kind="stable")
        self.first = np.searchsorted(self.doc[self.at], np.arange(int(doc.max(initial=-1)) + 2))
        self.asked = np.zeros(kinds, dtype=bool)
        self.seen = np.zeros(len(doc), dtype=bool)
        self.known = np.zeros(len(self.first), dtype=bool)

    def look_up(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The scores of documents under the asked terms, and their positions in those lists."""
        size = self.first[docs + 1] - self.first[docs]
        end = np.cumsum(size)
        own = self.at[np.arange(end[-1]) + np.repeat(self.first[docs] - (end - size), size)]
        of = np.repeat(np.arange(len(docs)), size)
        keep = self.asked[self.term[own]]
        counts = np.bincount(of[keep], minlength=len(docs))
        return segment_sums(self.impact[own[keep]], counts), own[keep]

    def search(self, codes: np.ndarray, k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents, and their scores, among which are all that score at least ``bar``, which k
        others reach, and as much as the k-th best of the part."""
        begin, end = self.begin[codes], self.begin[codes + 1]
        begin, end = begin[end > begin], end[end > begin]
        self.asked[codes] = True
        best = begin.copy()
        top = np.full(k, bar, dtype=np.int64)
        docs, scores, touched = [], [], []
        depth, step = 0, FIRST
        while len(begin):
            now = [np.arange(a, b) for a, b in zip(
                np.minimum(begin + depth, end).tolist(),
                np.minimum(begin + depth + step, end).tolist())]
            new = np.unique(self.doc[np.concatenate(now)])
            new = new[~self.known[new]]
            if len(new):
                self.known[new] = True
                score, places = self.look_up(new)
                self.seen[places] = True
                touched.append(places)
                top = np.partition(np.concatenate([top, score]), len(score))[-k:]
                docs.append(new)
                scores.append(score)
            depth, step = depth + step, min(STRIDE, 2 * step)
            bound = 0
            for t, (b, e) in enumerate(zip(best.tolist(), end.tolist())):
                while b < e:  # on to the first position that has not been seen
                    part = self.seen[b:b + 2 * step]
                    gap = int(part.argmin())
                    if not part[gap]:
                        b += gap
                        break
                    b += len(part)
                b = min(b, e)
                best[t] = b
                if b < e:
                    bound += int(self.impact[b])
            if bound < top[0] or bound == 0:
                break
        self.asked[codes] = False
        for places in touched:
            self.seen[places] = False
        for own in docs:
            self.known[own] = False
        if not docs:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        keep = scores >= max(1, top[0])
        return docs[keep], scores[keep]


class Best:
    """The k best hits of an item so far: by score, then doc_id, the missing one last."""

    def __init__(self, k: int):
        self.k, self.hits, self.bar = k, [], 0

    def add(self, ids: list, scores: list[int]) -> None:
        self.hits += zip(scores, ids)
        self.hits.sort(key=lambda h: (-h[0], h[1] is None, 0 if h[1] is None else h[1]))
        del self.hits[self.k:]
        if len(self.hits) == self.k:
            self.bar = self.hits[-1][0]


def _entries(docs: DataFrame, codes: dict[bytes, int]) -> DataFrame:
    """Of each document with a term: doc_id, its number of terms, and codes and counts of those
    that ``codes`` knows."""
    id_type = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(codes)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = shared.value.get
        for batch in batches:
            sizes, own, times = [], [], []
            for text in batch["text"]:
                words = terms(text)
                held = Counter(map(find, words))
                held.pop(None, None)
                sizes.append(len(words))
                own.append(np.fromiter(held.keys(), np.int32, len(held)))
                times.append(np.fromiter(held.values(), np.int32, len(held)))
            out = pd.DataFrame({"doc_id": batch["doc_id"], "size": sizes, "codes": own,
                                "times": times})
            yield out[out["size"] > 0]

    return documents(docs).mapInPandas(
        count, f"doc_id {id_type}, size long, codes array<int>, times array<int>")


def _hits(entries: DataFrame, asked: list[np.ndarray], weight: np.ndarray, n: int, total: int,
          k: int) -> DataFrame:
    """The k best documents of each item in each task: the item's number, doc_id and score."""
    id_type = dict(entries.dtypes)["doc_id"]
    shared = entries.sparkSession.sparkContext.broadcast((asked, weight))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, weights = shared.value
        best = [Best(k) for _ in items]
        for ids, doc, term, tf, size in _parts(batches):
            impact = impacts(weights[term], tf, size, n, total)
            some = impact > 0
            lists = Lists(doc[some], term[some], impact[some], len(weights))
            for own, codes in zip(best, items):
                docs, scores = lists.search(codes, k, own.bar)
                if len(docs):
                    own.add([ids[d] for d in docs.tolist()], scores.tolist())
        rows = [(i, d, s) for i, own in enumerate(best) for s, d in own.hits]
        yield pd.DataFrame({"item": [r[0] for r in rows],
                            "doc_id": pd.Series([r[1] for r in rows], dtype=object),
                            "score": [r[2] for r in rows]})

    return entries.mapInPandas(search, f"item int, doc_id {id_type}, score long")


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Batches put together to parts of about PART entries: ids of the documents, and by entry the
    document's place in the part, code, count and size of the document."""
    held, entries = [], 0
    for batch in batches:
        held.append(batch)
        entries += sum(map(len, batch["codes"]))
        if entries >= PART:
            yield _part(held)
            held, entries = [], 0
    if held:
        yield _part(held)


def _part(held: list[pd.DataFrame]) -> tuple:
    ids = [None if pd.isna(d) else d for b in held for d in b["doc_id"].tolist()]
    codes = [c for b in held for c in b["codes"]]
    lengths = np.array([len(c) for c in codes], dtype=np.int64)
    times = [c for b in held for c in b["times"]]
    size = np.concatenate([b["size"].to_numpy(np.int64) for b in held])
    none = [np.zeros(0, dtype=np.int64)]
    return (ids, np.repeat(np.arange(len(ids)), lengths),
            np.concatenate(none + codes).astype(np.int64),
            np.concatenate(none + times).astype(np.int64), np.repeat(size, lengths))


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, set[bytes]]]]:
    """Items with their terms, in blocks of at most TERMS distinct terms, read one partition at a
    time."""
    held, known = [], set()
    for row in items.select("item_id", whole_text().alias("text")).toLocalIterator():
        own = set(terms(row["text"]))
        if held and len(known | own) > TERMS:
            yield held
            held, known = [], set()
        held.append((row["item_id"], own))
        known |= own
    if held:
        yield held


def _search_block(docs: DataFrame, block: list[tuple[object, set[bytes]]], item_type: str,
                  k: int) -> DataFrame:
    spark = docs.sparkSession
    codes = {t: c for c, t in enumerate(sorted(set().union(*(own for _, own in block))))}
    entries = stored(_entries(docs, codes))
    n, total = entries.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    weight = np.zeros(len(codes), dtype=np.int64)
    for code, df in entries.select(F.explode("codes").alias("code")).groupBy(
            "code").count().collect():  # as many rows as the block has terms
        weight[code] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    asked = [np.array(sorted(codes[t] for t in own), dtype=np.int64) for _, own in block]
    hits = _hits(entries, asked, weight, n, total, k)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("item", "_group").orderBy(*order)
    # Many tasks' hits of an item meet in groups first.
    hits = hits.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(MERGES)))
    hits = hits.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    ranked = hits.withColumn(
        "rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)],
                                  f"item int, item_id {item_type}")
    return ranked.where(F.col("rank") <= k).join(F.broadcast(names), "item").select(
        "item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of every item."""
    item_type = dict(items.dtypes)["item_id"]
    out = None
    for block in _blocks(items):
        found = _search_block(docs, block, item_type, k)
        out = found if out is None else out.unionAll(found)
    if out is None:
        return empty(docs.sparkSession, item_type, dict(docs.dtypes)["doc_id"])
    return out


def empty(spark: SparkSession, item_type: str, id_type: str) -> DataFrame:
    return spark.createDataFrame(
        [], f"item_id {item_type}, rank int, doc_id {id_type}, score long")
