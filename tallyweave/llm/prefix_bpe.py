"""BPE encoding by dynamic programming over prefixes, and decoding.

The encoding of a byte string is the one sequence of tokens in which no two neighbours could have been
merged otherwise, and dropping its last token leaves the encoding of a shorter prefix. So each prefix
has one last token: a token that ends there and is compatible with the last token of the prefix before
it. Tokens that end at a position are found with a suffix automaton of the vocabulary: its state and
match length give the longest one, suffix links the shorter ones. They are tried from the longest on,
and the first compatible one is stored. Following the stored tokens back from the end gives the ids.

Two tokens are compatible if, undoing their merges from the latest on, no merge across their seam would
have come first. This is remembered per pair.

The tokenizer file may have plain added tokens, which are cut out of a text first, and must split by
the byte-level pattern. Decoding concatenates the bytes of the ids.

Null text is the empty text, with no tokens. Rows, also repeated ones, are encoded each; an empty table
gives no rows. Texts of any length are encoded whole: the memory a text takes is a multiple of its own
size. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from tallyweave.llm.text import WordCodes, documents, slices

#: Words that a worker remembers, and pieces; beyond it starts afresh.
CACHE = 600_000
PIECES = 200_000
#: A piece's bytes are matched in runs of so many, each begun one token's length before.
RUN = 512
#: Bytes matched in one batch.
BATCH = 1 << 22
#: Pairs whose compatibility is remembered.
PAIRS = 1 << 21
# Letters and numbers of Unicode 17, which the tokenizers library (at Unicode 16) holds for
# neither, as hexadecimal ranges.
NEWER = """558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF
10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686
16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191
191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE
1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479
3D000-3FC3F"""


def split_pattern() -> regex.Pattern:
    """How the byte-level pre-tokenizer splits a text."""
    new = "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in NEWER.split())
    letter, digit = rf"[\p{{L}}--[{new}]]", rf"[\p{{N}}--[{new}]]"
    other = rf"[[^\p{{White_Space}}\p{{L}}\p{{N}}]{new}]"
    # Fixed value: the alternatives of the pattern.
    return regex.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{digit}+| ?{other}+"
        r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+", regex.V1)


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: visible ones by themselves,
    the others by the letters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Table:
    """A map from integers to small integers that looks many keys up at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(len(keys) * 2 + 1))) + 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, -1, dtype=np.int32)
        at, left = self.slot(keys), np.arange(len(keys))
        while len(left):
            first = np.full(1 << bits, -1, dtype=np.int64)
            free = left[self.keys[at[left]] < 0]
            first[at[free]] = free
            put = np.unique(first[at[free]])
            self.keys[at[put]], self.values[at[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) & self.mask

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = self.slot(keys)
        here = self.keys[at]
        out = np.where(here == keys, self.values[at], -1)
        lost = np.flatnonzero((here != keys) & (here >= 0))
        while len(lost):
            at[lost] = (at[lost] + 1) & self.mask
            here = self.keys[at[lost]]
            hit = here == keys[lost]
            out[lost[hit]] = self.values[at[lost[hit]]]
            lost = lost[~hit & (here >= 0)]
        return out


class Automaton:
    """Suffix automaton of a set of byte strings: a state stands for the factors with equal ends."""

    def __init__(self, words: list[bytes]):
        self.length, self.link, edge, labels = [0], [-1], {}, [[]]
        self.state_of = []
        for word in words:
            last = 0
            for byte in word:
                last = self._add(last, byte, edge, labels)
            self.state_of.append(last)
        # A later copy may have taken over the word that ended in its original.
        for k, word in enumerate(words):
            state = self.state_of[k]
            while self.length[self.link[state]] >= len(word):
                state = self.link[state]
            self.state_of[k] = state
        keys = np.fromiter(edge.keys(), np.int64, len(edge))
        self.edge = Table(keys, np.fromiter(edge.values(), np.int32, len(edge)))
        self.length = np.array(self.length, dtype=np.int32)
        self.link = np.array(self.link, dtype=np.int32)

    def _add(self, last: int, byte: int, edge: dict[int, int], labels: list[list[int]]) -> int:
        length, link = self.length, self.link

        def split(state: int) -> int:
            """The state of the longest factor of ``state`` + byte that the edge stands for."""
            target = edge[state << 8 | byte]
            if length[target] == length[state] + 1:
                return target
            copy = len(length)
            length.append(length[state] + 1)
            link.append(link[target])
            labels.append(list(labels[target]))
            for b in labels[target]:
                edge[copy << 8 | b] = edge[target << 8 | b]
            link[target] = copy
            while state >= 0 and edge.get(state << 8 | byte) == target:
                edge[state << 8 | byte] = copy
                state = link[state]
            return copy

        if last << 8 | byte in edge:
            return split(last)
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        labels.append([])
        state = last
        while state >= 0 and state << 8 | byte not in edge:
            edge[state << 8 | byte] = new
            labels[state].append(byte)
            state = link[state]
        if state >= 0:
            link[new] = split(state)
        return new

    def matches(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray):
        """For each step, the lanes (longest first) still running, and their state and match length.

        Lane k reads ``size[k]`` bytes from ``begin[k]``; the sizes must descend.
        """
        state = np.zeros(len(begin), dtype=np.int64)
        held = np.zeros(len(begin), dtype=np.int32)
        for step in range(int(size[0]) if len(size) else 0):
            lanes = int(np.searchsorted(-size, -step, side="left"))
            byte = data[begin[:lanes] + step]
            now = state[:lanes]
            to = self.edge(now << 8 | byte)
            held[:lanes] += 1
            lost = np.flatnonzero(to < 0)
            while len(lost):
                now[lost] = self.link[now[lost]]
                held[lost] = self.length[now[lost]] + 1
                to[lost] = self.edge(now[lost] << 8 | byte[lost])
                lost = lost[to[lost] < 0]
            state[:lanes] = to
            yield step, lanes, state, held


class Vocabulary:
    """What encoding needs of a tokenizer file: small enough for a broadcast.

    Tokens are numbered by byte value, then by merge; ``ids`` gives the file's numbers.
    """

    _encoder = None

    def __init__(self, path: str):
        file = json.loads(Path(path).read_text(encoding="utf-8"))
        model, pre = file["model"], file["pre_tokenizer"]
        plain = not any(model.get(k) for k in (
            "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback",
            "ignore_merges"))
        if file["normalizer"] or model["type"] != "BPE" or not plain or (
                pre["type"], pre["add_prefix_space"], pre.get("use_regex", True)) != (
                "ByteLevel", False, True):
            raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
        if any(t[k] for t in file["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"an added token that takes in its surroundings: {path}")
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        letters, numbers = byte_letters(), model["vocab"]
        own = {c: b for c, b in letters.items()}
        self.tokens = [b""] * 256
        self.ids = [0] * 256
        for c, b in letters.items():
            self.tokens[b], self.ids[b] = bytes([b]), numbers[c]
        self.left, self.right, self.rank = list(range(256)), list(range(256)), {}
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            if a + b in own:
                raise ValueError(f"two merges make {a + b!r}: {path}")
            x, y, new = own[a], own[b], len(self.tokens)
            own[a + b] = new
            self.tokens.append(self.tokens[x] + self.tokens[y])
            self.ids.append(numbers[a + b])
            self.left.append(x)
            self.right.append(y)
            self.rank[x << 24 | y] = new
        sound = [t for t in range(len(self.tokens))
                 if t < 256 or self.fits(self.left[t], self.right[t], t)]
        self.size = [len(t) for t in self.tokens]
        self._chains(sound)

    def fits(self, a: int, b: int, before: int = 1 << 30) -> bool:
        """Whether neighbours a and b both come out, given that only merges earlier than ``before``
        are made: no merge across their seam comes before the merges that make them."""
        while True:
            across = self.rank.get(a << 24 | b)
            if across is not None and across < before:
                return False
            if a < 256 and b < 256:
                return True
            if a > b:  # made last, so the seam faced its right part until then
                before, a = a, self.right[a]
            else:  # of equal merges the left one is made first
                before, b = b + 1, self.left[b]

    def _chains(self, sound: list[int]) -> None:
        """``longest``: by state, the longest token among its factors; ``shorter``: by token, the
        longest other token that ends it."""
        auto = self.automaton = Automaton([self.tokens[t] for t in sound])
        inside: dict[int, list[int]] = {}
        for t, state in sorted(zip(sound, auto.state_of), key=lambda x: self.size[x[0]]):
            inside.setdefault(state, []).append(t)
        longest = np.full(len(auto.length), -1, dtype=np.int32)
        self.shorter = np.full(len(self.tokens), -1, dtype=np.int32)
        for state in np.argsort(auto.length, kind="stable").tolist():
            known = longest[auto.link[state]] if state else -1
            for t in inside.get(state, ()):
                self.shorter[t], known = known, t
            longest[state] = known
        self.longest = longest
        del auto.state_of

    def encoder(self) -> PrefixEncoder:
        """This process's encoder, which keeps what it remembers from task to task."""
        if self._encoder is None:
            self._encoder = PrefixEncoder(self)
        return self._encoder

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_encoder": None}


class PrefixEncoder(WordCodes):
    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        self.pattern = split_pattern()
        cuts = "|".join(map(regex.escape, sorted(v.added, key=len, reverse=True)))
        self.cut = regex.compile(f"({cuts})") if cuts else None
        self.sizes = np.array(v.size, dtype=np.int32)
        self.shorter = v.shorter.tolist()
        self.reach = max(v.size)
        self.names = np.array(v.ids, dtype="<u4")
        self.bytes_of = dict(zip(v.ids, v.tokens)) | {n: t.encode() for t, n in v.added.items()}
        self.fixed = {t: np.array([n], "<u4").tobytes() for t, n in v.added.items()}
        self.pieces = dict(self.fixed)
        self.pairs: dict[int, bool] = {}
        super().__init__(int(self.names[ord("\n")]), CACHE)

    def split(self, text: str) -> list[str]:
        """Added tokens and matches of the pattern, in order."""
        if self.cut is None or not any(t in text for t in self.vocabulary.added):
            return self.pattern.findall(text)
        out: list[str] = []
        for k, part in enumerate(self.cut.split(text)):
            out += [part] if k % 2 else self.pattern.findall(part)
        return out

    def ids(self, text: str) -> np.ndarray:
        if len(self.pieces) > PIECES:
            self.pieces = dict(self.fixed)
        if len(self.pairs) > PAIRS:
            self.pairs = {}
        found = self.split(text)
        new, held, size = list(set(found) - self.pieces.keys()), [], 0
        for piece in new:
            held.append(piece)
            size += len(piece)
            if size > BATCH:
                self.learn(held)
                held, size = [], 0
        self.learn(held)
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, found)), dtype="<u4")

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces: match all of them at once, then fill each one's table of last tokens."""
        data = [p.encode("utf-8", "surrogatepass") for p in pieces]
        ends = self.endings(data)
        size, shorter, pairs = self.vocabulary.size, self.shorter, self.pairs
        fits, at, number = self.vocabulary.fits, 0, self.names
        for piece, own in zip(pieces, data):
            last: list[int] = []
            for i, token in enumerate(ends[at:at + len(own)], 1):
                while (before := i - size[token]) > 0:
                    pair = last[before - 1] << 24 | token
                    good = pairs.get(pair)
                    if good is None:
                        good = pairs[pair] = fits(last[before - 1], token)
                    if good:
                        break
                    token = shorter[token]
                last.append(token)
            at += len(own)
            out, i = [], len(own)
            while i:
                out.append(last[i - 1])
                i -= size[last[i - 1]]
            self.pieces[piece] = number[out[::-1]].tobytes()

    def endings(self, data: list[bytes]) -> list[int]:
        """The longest token that ends at each byte of each piece, one after another."""
        if not data:
            return []
        sizes = np.array([len(d) for d in data])
        starts = np.cumsum(sizes) - sizes
        lanes = -(-sizes // RUN)  # a state depends on the bytes of one token at most
        piece = np.repeat(np.arange(len(data)), lanes)
        skip = (np.arange(len(piece)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * RUN
        begin = np.maximum(skip - self.reach, 0)
        size = np.minimum(skip + RUN, sizes[piece]) - begin
        order = np.argsort(-size, kind="stable")
        begin, size, skip, piece = begin[order], size[order], skip[order], piece[order]
        warm = skip - begin
        flat = np.frombuffer(b"".join(data), dtype=np.uint8).astype(np.int64)
        out = np.zeros(len(flat), dtype=np.int32)
        auto, longest = self.vocabulary.automaton, self.vocabulary.longest
        first = starts[piece] + begin
        for step, running, state, held in auto.matches(flat, first, size):
            token = longest[state[:running]]
            over = np.flatnonzero(self.sizes[token] > held[:running])
            while len(over):
                token[over] = self.vocabulary.shorter[token[over]]
                over = over[self.sizes[token[over]] > held[over]]
            keep = warm[:running] <= step
            out[first[:running][keep] + step] = token[keep]
        return out.tolist()

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, added tokens by their text."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, the ids and the text they decode to, of every row; ``path`` is a tokenizer file."""
    id_type = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = shared.value.encoder()
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts):
                ids = [np.frombuffer(x, "<u4") for x in encoder(texts[part])]
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[part].to_numpy(),
                    "ids": [x.astype(np.int32) for x in ids],
                    "decoded": [encoder.decode(x).decode("utf-8", "replace") for x in ids]})

    return documents(docs).mapInPandas(
        encode, f"doc_id {id_type}, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the decoded text, of every row.

    Digests are made where the ids are, so that these need not leave the worker.
    """
    id_type = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = shared.value.encoder()
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts):
                rows = []
                for data in encoder(texts[part]):
                    text = encoder.decode(np.frombuffer(data, "<u4")).decode("utf-8", "replace")
                    rows.append((len(data) // 4, hashlib.sha256(data).hexdigest(),
                                 hashlib.sha256(text.encode()).hexdigest()))
                out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
                out.insert(0, "doc_id", batch["doc_id"].iloc[part].to_numpy())
                yield out

    return documents(docs).mapInPandas(
        digest, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
