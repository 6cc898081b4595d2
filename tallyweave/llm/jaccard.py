"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

A text is the set of its runs of ``WORDS`` lower-cased words; a text of fewer words is one run. Equal
sets form one node, so copies are never compared or expanded.

The forest has ``TREES`` prefix tries of MinHash labels. Two texts of similarity s share the first d
labels of a tree with probability s^d. Starting with ``LONGEST`` labels, the prefixes are shortened
until texts at the threshold meet in some tree with probability ``RECALL``; texts below the node
reached are candidates. Candidates that meet directly or through others form a family. Families are
verified exactly, every member against every other, in pairs of blocks of ``BLOCK`` members, so that
a family of any size is spread over tasks; a block pair gives each member's number of links and one
edge to its least linked member, not the pairs.

Rows without a word link to nothing and are a class of their own, as are rows without doc_id, whose
class is null. Rows with one doc_id are one document: a class holds all its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.components import components
from tallyweave.llm.shared import stored
from tallyweave.llm.text import documents, slices

WORDS = 5
THRESHOLD = 0.8
TREES = 24
LONGEST = 10
RECALL = 0.999
BLOCK = 128
#: Word hashes that a worker keeps; beyond it starts afresh.
CACHE = 500_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def depth(threshold: float = THRESHOLD, trees: int = TREES, longest: int = LONGEST,
          recall: float = RECALL) -> int:
    """The longest prefix at which texts at the threshold meet often enough, 1 at least."""
    labels = longest
    while labels > 1 and 1 - (1 - threshold ** labels) ** trees < recall:
        labels -= 1
    return labels


class Shingler:
    """Sorted distinct 64-bit hashes of the runs of words of texts."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.known: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        lists = [t.lower().split() for t in texts]
        if len(self.known) > CACHE:
            self.known.clear()
        for word in set().union(*lists) - self.known.keys():
            self.known[word] = xxhash.xxh64_intdigest(word)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        find = self.known.__getitem__
        hashes = np.fromiter((find(w) for ws in lists for w in ws), np.uint64, sizes.sum())
        runs = np.zeros(len(hashes), np.uint64)
        for k in range(min(self.words, len(hashes))):
            runs[:len(hashes) - k] = runs[:len(hashes) - k] * _MIX + hashes[k:]
        runs ^= runs >> np.uint64(32)
        runs *= _MIX
        runs ^= runs >> np.uint64(29)
        out, start = [], 0
        for size, own in zip(sizes.tolist(), lists):
            if 0 < size < self.words:
                out.append(np.array([xxhash.xxh64_intdigest(" ".join(own))], np.uint64))
            else:
                out.append(np.unique(runs[start:start + max(0, size - self.words + 1)]))
            start += size
        return out


def forest_labels(sets: list[np.ndarray], trees: int, labels: int, seed: int = 1) -> np.ndarray:
    """A hash of the first ``labels`` MinHash labels in each tree, one row a set (none empty)."""
    factors = np.random.default_rng(seed).integers(
        1, 1 << 63, (trees, labels), dtype=np.uint64) | np.uint64(1)
    nodes = np.zeros((len(sets), trees), np.uint64)
    start = 0
    while start < len(sets):  # some sets at a time, so that they stay in the processor's cache
        end, held = start, 0
        while end < len(sets) and (end == start or held + len(sets[end]) <= 50_000):
            held += len(sets[end])
            end += 1
        flat = np.concatenate(sets[start:end])
        begin = np.concatenate([[0], np.cumsum([len(s) for s in sets[start:end]])[:-1]])
        for tree in range(trees):
            node = np.full(end - start, tree + 1, np.uint64)
            for factor in factors[tree]:
                least = np.minimum.reduceat(flat * factor, begin)
                node = (node ^ (least >> np.uint64(13))) * _MIX
                node ^= node >> np.uint64(31)
            nodes[start:end, tree] = node
        start = end
    return nodes


def prints(docs: DataFrame, words: int, trees: int, labels: int) -> DataFrame:
    """doc_id, set_key (null without words) and the tree nodes of every row."""
    id_type = dict(docs.dtypes)["doc_id"]

    def fingerprint(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(words)
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts):
                sets = shingle(texts[part])
                some = [k for k, s in enumerate(sets) if len(s)]
                nodes: list = [None] * len(sets)
                if some:
                    made = forest_labels([sets[k] for k in some], trees, labels).astype(np.int64)
                    for k, row in zip(some, made):
                        nodes[k] = row
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[part].to_numpy(),
                    "set_key": [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None
                                for s in sets],
                    "nodes": nodes})

    return documents(docs).mapInPandas(
        fingerprint, f"doc_id {id_type}, set_key string, nodes array<long>")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets with each other."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    common = times > 1
    column = (np.cumsum(common) - 1)[code]
    keep = common[code]
    owner, column = owner[keep], column[keep]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    width = 4096
    for first in range(0, int(common.sum()), width):
        a, b = np.searchsorted(column, [first, first + width])
        table = np.zeros((len(sets), width), np.float32)
        table[owner[a:b], column[a:b] - first] = 1
        out += table @ table.T
    return out


def verify(sets: list[np.ndarray], ids: np.ndarray, copies: np.ndarray, blocks: np.ndarray,
           threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each member: the copies it links to, and the least id of those it is joined to here.

    Members of one block are compared with each other, of two blocks with those of the other one.
    """
    shared = overlaps(sets)
    size = np.array([len(s) for s in sets], np.float64)
    linked = shared >= threshold * (size[:, None] + size[None, :] - shared) - 1e-9
    if blocks.min() != blocks.max():
        linked &= blocks[:, None] != blocks[None, :]
    linked &= ids[:, None] != ids[None, :]
    links = (linked * copies[None, :]).sum(axis=1)
    least = ids.copy()
    while True:  # spread the least id along links
        best = np.where(linked, least[None, :], least[:, None]).min(axis=1)
        if (best == least).all():
            return links, least
        least = best


def _families(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of rows with equal (family, i, j), which may go on over batches."""
    held: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        keys = batch[["family", "i", "j"]]
        cuts = np.flatnonzero((keys != keys.shift()).any(axis=1).to_numpy()).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(batch)]):
            own = batch.iloc[a:b]
            key = tuple(keys.iloc[a])
            if key != last and held:
                yield pd.concat(held)
                held = []
            last = key
            held.append(own)
    if held:
        yield pd.concat(held)


def join(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, trees: int = TREES,
         longest: int = LONGEST, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (least doc_id of its class), n_links (other rows at the threshold or more,
    copies included) and n_copies (rows with the same set) of every row."""
    found = stored(prints(docs, words, trees, depth(threshold, trees, longest, recall)))
    known = found.where(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    sets = stored(known.groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    heads = known.join(sets.select("set_key", F.col("rep").alias("doc_id")),
                       ["set_key", "doc_id"])
    nodes = heads.select(F.col("doc_id").alias("rep"), F.explode("nodes").alias("node"))
    firsts = (nodes.groupBy("node").agg(F.min("rep").alias("head"), F.max("rep").alias("tail"))
              .where(F.col("head") < F.col("tail")).select("node", "head"))
    meets = nodes.join(firsts, "node").select(F.col("rep").alias("a"), F.col("head").alias("b"))
    family = stored(components(meets))
    many = family.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    members = (family.join(stored(many), "root")
               .join(sets.groupBy("rep").agg(F.max("copies").alias("copies")),
                     F.col("node") == F.col("rep"))
               .select("rep", F.col("root").alias("family"), "copies", blocks.alias("_blocks"),
                       F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("block")))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    spread = (documents(docs).join(members, F.col("doc_id") == F.col("rep"))
              .select("family", "rep", "copies", "block", "text", other.alias("_other"))
              .select("family", F.least("block", "_other").alias("i"),
                      F.greatest("block", "_other").alias("j"), "rep", "copies", "block", "text")
              .repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "rep"))
    id_type = dict(docs.dtypes)["doc_id"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(words)
        for own in _families(batches):
            ids = own["rep"].to_numpy()
            links, least = verify(shingle(own["text"].tolist()), ids, own["copies"].to_numpy(),
                                  own["block"].to_numpy(), threshold)
            yield pd.DataFrame({"rep": ids, "links": links.astype(np.int64), "least": least})

    compared = stored(spread.mapInPandas(
        compare, f"rep {id_type}, links long, least {id_type}"))
    classes = components(compared.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    linked = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    judged = (sets.join(linked, "rep", "left")
              .join(classes.withColumnRenamed("node", "rep"), "rep", "left")
              .select("set_key", F.coalesce("root", "rep").alias("class_id"),
                      (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.col("copies").alias("n_copies")))
    loose = found.where(F.col("doc_id").isNull() | F.col("set_key").isNull()).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("n_copies"))
    return known.select("doc_id", "set_key").join(stored(judged), "set_key").select(
        "doc_id", "class_id", "n_links", "n_copies").unionAll(loose)


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each class, all columns: the one with the least doc_id. Rows without doc_id stay;
    of rows that repeat a doc_id one stays."""
    first = join(docs).where(F.col("class_id") == F.col("doc_id")).select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.select(docs.columns).unionAll(docs.where(F.col("doc_id").isNull()))
