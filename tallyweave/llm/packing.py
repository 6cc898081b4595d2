"""Best-fit packing of token sequences, bulk-synchronous over runs of equal lengths.

Every document becomes token ids with an end id, cut into pieces of ``SIZE`` ids, of which the first
may be shorter. Pieces of one length are interchangeable, and so are sequences with equal gaps, so
both are sorted as runs: one per length and one per range of sequences in the same state. Starting
with the longest, all pieces of a length sweep the gap runs from the smallest that fits upwards. The
ranks of the pieces resolve who gets which gap: the k-th piece of a length goes to the k-th place of
the sweep. Gaps shrink together, what is left over opens new sequences, and the next length follows.
This is best-fit decreasing, with one round a length whatever the number of documents.

The runs come from a count per length (``SIZE`` rows at most) and are bounded by ``SIZE`` too, so the
sweeps need no task of their own; ranking and placing the pieces are distributed. A piece's rank is
its number within its task plus the counts of the tasks before it.

Null text is the empty text and packs as the end id alone. Repeated rows are packed each. An empty
table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from bisect import insort
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyweave.llm.shared import stored
from tallyweave.llm.text import WordCodes, documents, slices

SIZE = 1024
END = 2
#: Encoded words that a worker keeps; beyond it starts afresh.
CACHE = 400_000


class Encoder(WordCodes):
    """Token ids of texts as little-endian unsigned 32-bit bytes, remembering words.

    Merging the adjacent pair whose token comes first in the vocabulary, as tiktoken does, gives what
    the tokenizer's list of merges gives: a token's parts always come before it, so merges happen in
    order of the vocabulary, and between given ends the same bytes are merged to the same tokens.
    """

    def __init__(self, path: str):
        vocabulary = json.loads(Path(path).read_bytes())["model"]["vocab"]
        # the letters that stand for bytes: printable ones for themselves, then from U+0100 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(plain)]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}
        ranks = {bytes(map(byte.__getitem__, word)): n for word, n in vocabulary.items()
                 if not word.startswith("<|")}
        self.coder = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN,
                                       mergeable_ranks=ranks, special_tokens={})
        super().__init__(ranks[b"\n"], CACHE)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.coder.encode_ordinary(text), dtype="<u4")


def cut(ids: bytes) -> list[tuple[int, int, int]]:
    """(start, length, crc32 of the ids) of the pieces of a document, the odd one first."""
    n = len(ids) // 4
    starts = [0] if n <= SIZE else list(range(n % SIZE or SIZE, n, SIZE))
    starts = starts if starts[0] == 0 else [0, *starts]
    return [(a, b - a, zlib.crc32(ids[a * 4:b * 4]))
            for a, b in zip(starts, [*starts[1:], n])]


def pieces(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every row, with ``task`` and ``nth``: the number of
    the task that made it and the number among the pieces of its length there. To be stored."""
    end = np.array([END], dtype="<u4").tobytes()
    id_type = dict(docs.dtypes)["doc_id"]

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, task = Encoder(tokenizer), TaskContext.get().partitionId()
        made = np.zeros(SIZE + 1, np.int64)
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts):
                rows, at = [], []
                for k, ids in enumerate(encoder(texts[part])):
                    for number, (start, length, crc) in enumerate(cut(ids + end)):
                        rows.append((number, start, length, crc, task, made[length]))
                        at.append(k)
                        made[length] += 1
                out = pd.DataFrame(rows, columns=[
                    "piece", "start", "length", "ids_crc32", "task", "nth"])
                out.insert(0, "doc_id", batch["doc_id"].iloc[part].iloc[at].to_numpy())
                yield out

    return documents(docs).mapInPandas(
        encode, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, task int, "
                "nth long")


def sweep(counts: dict[int, int]) -> tuple[pd.DataFrame, int]:
    """Where the pieces of each length go, and the number of sequences.

    Rows (length, first, sequence, offset), sorted: pieces of a length with ranks from ``first`` up
    to the next row go to sequences from ``sequence`` on, one each, at ``offset``.
    """
    placed: list[tuple[int, int, int, int]] = []
    gaps: list[tuple[int, int, int]] = []  # (gap, first sequence, how many), sorted
    opened = 0

    def fill(run: tuple[int, int, int], length: int, rank: int, left: int) -> int:
        """Put up to ``left`` pieces into a run, sequence after sequence; how many went in."""
        gap, first, many = run
        each = gap // length
        full, rest = min(many, left // each), left % each
        groups = [(first, full, each)]
        if full < many and rest:
            groups.append((first + full, 1, rest))
        used = 0
        for start, some, times in groups:
            for k in range(times if some else 0):
                placed.append((length, rank + used, start, SIZE - gap + k * length))
                used += some
            if some and gap > times * length:
                insort(gaps, (gap - times * length, start, some))
        beyond = first + sum(g[1] for g in groups)
        if beyond < first + many:
            insort(gaps, (gap, beyond, first + many - beyond))
        return used

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        fitting = [g for g in gaps if g[0] >= length]
        gaps[:] = [g for g in gaps if g[0] < length]
        for k, run in enumerate(fitting):
            if not left:
                for other in fitting[k:]:
                    insort(gaps, other)
                break
            used = fill(run, length, rank, left)
            rank, left = rank + used, left - used
        if left:
            many = -(-left // (SIZE // length))
            fill((SIZE, opened, many), length, rank, left)
            opened += many
    return pd.DataFrame(placed, columns=["length", "first", "sequence", "offset"]), opened


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Pieces of all documents with sequence_id and offset."""
    cutted = stored(pieces(docs, tokenizer))
    each = cutted.groupBy("length", "task").agg(F.count(F.lit(1)).alias("_n"))
    before = each.select("length", "task", (F.sum("_n").over(
        W.partitionBy("length").orderBy("task")) - F.col("_n")).alias("_before"))
    ranked = cutted.join(before, ["length", "task"]).withColumn(
        "_rank", F.col("nth") + F.col("_before"))
    counts = {r["length"]: r["n"] for r in  # one row a length
              each.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan, _ = sweep(counts)
    # bounded by SIZE, whatever the number of documents
    sent = docs.sparkSession.sparkContext.broadcast(
        {int(k): [own[c].to_numpy(np.int64) for c in ("first", "sequence", "offset")]
         for k, own in plan.groupby("length")})

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank = batch.pop("_rank").to_numpy(np.int64)
            length = batch["length"].to_numpy(np.int64)
            sequence, offset = np.zeros((2, len(batch)), np.int64)
            for own in np.unique(length):
                first, to, start = sent.value[int(own)]
                rows = np.flatnonzero(length == own)
                at = np.searchsorted(first, rank[rows], side="right") - 1
                sequence[rows] = to[at] + rank[rows] - first[at]
                offset[rows] = start[at]
            yield batch.assign(sequence_id=sequence, offset=offset)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    types = dict(cutted.dtypes)
    return ranked.select(*names, "_rank").mapInPandas(
        place, ", ".join(f"{n} {types[n]}" for n in names) + ", sequence_id long, offset long")
