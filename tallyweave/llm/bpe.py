"""Byte-level BPE by tree reduction: encodings of parts are joined like elements of a monoid.

Each match of the pattern is encoded by itself: its bytes are halved down to leaves of at most ``SHORT``
bytes, which are merged as they are, and the encodings of neighbours are joined. To join two, the last tokens of the left one and the first of the
right one are encoded anew as one string, at first one token of each, then more and more,
until the outermost tokens of the window come out as they were (or the window has reached that end).
Then nothing outside can change: token sequences are encodings exactly if each two neighbours are the
encoding of their bytes, and all pairs of neighbours outside the window are as before.

Decoding looks up each token's bytes and concatenates them up a tree as well.

Null text is the empty text, with no tokens. Rows, also repeated ones, are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from tallyweave.llm.text import WordCodes, documents, slices

#: Words that a worker remembers, and short byte strings; beyond it starts afresh.
CACHE = 600_000
SHORT = 8
#: Windows up to so many bytes are merged by plain search, longer ones with a heap.
SIMPLE = 32
LEAF = 4096
NONE = 1 << 40


class TreeEncoder(WordCodes):
    def __init__(self, path: str):
        lines = map(bytes.split, Path(path).read_bytes().splitlines())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        get = self.ranks.get
        self.two = [get(bytes((a, b)), NONE) for a in range(256) for b in range(256)]
        self.bytes = [bytes([b]) for b in range(256)]
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.short: dict[bytes, list[int]] = {}
        self.pairs: dict[int, list[int]] = {}
        self.windows: dict[bytes, list[int]] = {}
        self.pieces: dict[str, bytes] = {}
        super().__init__(self.ranks[b"\n"], CACHE)

    def ids(self, text: str) -> np.ndarray:
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        for memory in (self.short, self.pairs, self.windows):
            if len(memory) > CACHE:
                memory.clear()
        found = self.pattern.findall(text)
        known = self.pieces
        for piece in set(found) - known.keys():
            data = piece.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(data)
            known[piece] = array("I", self.encode(data) if whole is None else [whole]).tobytes()
        return np.frombuffer(b"".join(map(known.__getitem__, found)), dtype="<u4")

    def encode(self, data: bytes) -> list[int]:
        """Ids of a byte string by halves."""
        size = len(data)
        if size <= SHORT:
            found = self.short.get(data)
            if found is not None:
                return found
            out = self.short[data] = self.merge(data)
            return out
        return self.join(self.encode(data[:size // 2]), self.encode(data[size // 2:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring strings from theirs."""
        if not left or not right:
            return left or right
        a, b = left[-1], right[0]
        key = a << 20 | b
        middle = self.pairs.get(key)
        if middle is None:
            middle = self.pairs[key] = self.merge(self.tokens[a] + self.tokens[b])
        i = j = 1  # tokens of the left and of the right one in the window
        while True:
            calm = middle[0] == left[-i] or i == len(left)
            still = middle[-1] == right[j - 1] or j == len(right)
            if calm and still:
                return left[:-i] + middle + right[j:]
            if not calm:
                i = min(len(left), i + 1 + i // 4)
            if not still:
                j = min(len(right), j + 1 + j // 4)
            window = b"".join(map(self.tokens.__getitem__, left[-i:] + right[:j]))
            middle = self.windows.get(window)
            if middle is None:
                middle = self.merge(window)
                if len(window) <= SIMPLE:
                    self.windows[window] = middle

    def merge(self, data: bytes) -> list[int]:
        """Ids of a window by merging the pair of least rank, the leftmost first."""
        ranks = self.ranks
        if len(data) <= SIMPLE:
            parts, find, two = [self.bytes[b] for b in data], ranks.get, self.two
            found = [two[a << 8 | b] for a, b in zip(data, data[1:])]
            while found and (least := min(found)) != NONE:
                i = found.index(least)
                parts[i] += parts.pop(i + 1)
                del found[i]
                if i < len(found):
                    found[i] = find(parts[i] + parts[i + 1], NONE)
                if i:
                    found[i - 1] = find(parts[i - 1] + parts[i], NONE)
            return [ranks[x] for x in parts]
        n = len(data)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        end = list(range(1, n + 1))  # a part that begins at i ends at end[i]; 0 if merged away
        heap = [(r, i, i + 2) for i in range(n - 1)
                if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i]
            if not end[i] or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(data[i:end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            h = before[i]
            if h >= 0 and (r := ranks.get(data[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:end[i]]])
            i = after[i]
        return out

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ids, concatenated up a tree over leaves of ``LEAF`` tokens."""
        find = self.tokens.__getitem__
        level = [b"".join(map(find, ids[k:k + LEAF])) for k in range(0, len(ids), LEAF)] or [b""]
        while len(level) > 1:
            level = [b"".join(level[k:k + 2]) for k in range(0, len(level), 2)]
        return level[0]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> TreeEncoder:
    """This process's encoder, which keeps what it remembers from task to task."""
    return TreeEncoder(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, the ids and the bytes they decode to, of every row; ``path`` names the ranks."""
    id_type = dict(docs.dtypes)["doc_id"]

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(path)
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts):
                ids = [np.frombuffer(x, "<u4") for x in encoder(texts[part])]
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[part].to_numpy(),
                    "ids": [x.astype(np.int32) for x in ids],
                    "decoded": [encoder.decode(x.tolist()) for x in ids]})

    return documents(docs).mapInPandas(
        encode, f"doc_id {id_type}, ids array<int>, decoded binary")


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the decoded bytes, of every row.

    Digests are made where the ids are, so that these need not leave the worker.
    """
    id_type = dict(docs.dtypes)["doc_id"]

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(path)
        decimal = {n: str(n) for n in encoder.tokens}.__getitem__
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts):
                rows = []
                for data in encoder(texts[part]):
                    ids = np.frombuffer(data, "<u4").tolist()
                    rows.append((len(ids),
                                 hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest(),
                                 hashlib.sha256(encoder.decode(ids)).hexdigest()))
                out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
                out.insert(0, "doc_id", batch["doc_id"].iloc[part].to_numpy())
                yield out

    return documents(docs).mapInPandas(
        digest, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
