"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds every substring of a bounded sample of labelled text. A
text is parsed against it greedily: each phrase is the longest match that goes on from where the
last one ended. Text of the same language matches long stretches, so it needs few phrases. The
estimate of its cross entropy is phrases * log2(length of the longest sample) / characters; the
language with the least wins, ties go to the one with more labelled rows, then in alphabetical order.

Letters are lower-cased; every run of other characters counts as one space. Whole texts are parsed,
in pieces of ``PIECE`` characters, at whose borders a phrase ends in all languages alike; the pieces
of many texts step through an automaton side by side.

A null text, one without a letter, and any text if nothing was learned is ``und`` with score 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.text import code_points, fold, segment_sums, slices, whole_text

#: Labelled rows a language is learned from, at most, and the characters taken of each, at most.
TRAIN_ROWS = 64
EXCERPT = 640
#: Languages learned, at most: the ones with most rows.
MAX_LANGS = 64
#: Letters told apart in all samples together, the most frequent ones; others match nothing.
MAX_LETTERS = 250
PIECE = 512
UNKNOWN = "und"
#: Cross entropy (bits a character) from which text is like none of the languages.
FOREIGN = 9.0
_STRANGE, _SPACE, _FIRST = 0, 1, 2


def squeeze(text: str) -> np.ndarray:
    """Code points in lower case with every run of non-letters as one space, and none at the ends."""
    return code_points(" ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()))


class Letters:
    """Classes of code points: a strange letter, space, or one of the letters of the samples."""

    def __init__(self, samples: list[str]):
        found, counts = np.unique(np.concatenate(
            [np.zeros(0, np.uint32)] + [code_points(s) for s in samples]), return_counts=True)
        found = found[np.argsort(-counts, kind="stable")]
        kept = [int(c) for c in found if c != 32][:MAX_LETTERS]
        self.codes = {c: _FIRST + k for k, c in enumerate(kept)}
        self.pad = _FIRST + len(kept)
        self.table = None

    def classes(self, points: np.ndarray) -> np.ndarray:
        """Class of each code point, other characters than letters as spaces."""
        if self.table is None:
            letter = np.fromiter((chr(c).isalpha() for c in range(0x3000)), bool, 0x3000)
            self.table = np.where(letter, _STRANGE, _SPACE).astype(np.uint8)
            for c, k in self.codes.items():
                if c < 0x3000:
                    self.table[c] = k
        out = self.table[np.minimum(points, 0x2FFF)]
        far = np.flatnonzero(points >= 0x3000)
        if len(far):
            kinds, back = np.unique(points[far], return_inverse=True)
            own = [self.codes.get(c, _STRANGE) if chr(c).isalpha() else _SPACE
                   for c in kinds.tolist()]
            out[far] = np.array(own, np.uint8)[back]
        return out


def automaton(classes: list[int], width: int) -> np.ndarray:
    """Suffix automaton of a sample as a flat table ``[state * width + class] -> state * width``.

    Where a phrase cannot go on, the entry leads to the start of the next phrase, and its lowest bit
    is set (states are even: ``width`` is). The last class is padding and stays in its state.
    """
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in classes:
        now = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = now
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                twin = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    dead = len(follow)  # behind a letter that is nowhere in the sample, a phrase by itself
    table = np.full((dead + 1, width), -1, np.int64)
    for state, out in enumerate(follow):
        for c, to in out.items():
            table[state, c] = to
    restart = np.where(table[0] < 0, dead, table[0]) * width + 1
    table = np.where(table < 0, restart, table * width)
    table[0] -= table[0] & 1  # at the start no phrase is broken off
    table[:, width - 1] = np.arange(dead + 1) * width
    return table.astype(np.int32).ravel()


@dataclass
class Parser:
    """Automata of the learned languages in the order that ties go by; ``bits`` is the price of a
    phrase: log2 of the length of the longest sample."""

    langs: list[str]
    letters: Letters
    width: int
    tables: list[np.ndarray]
    bits: float

    @classmethod
    def learn(cls, samples: dict[str, str]) -> Parser:
        """Of squeezed sample texts by language; languages without letters are left out."""
        langs = [k for k, s in samples.items() if s.strip()]
        letters = Letters([samples[k] for k in langs])
        width = letters.pad + 1 + (letters.pad + 1) % 2
        tables = [automaton(letters.classes(code_points(samples[k])).tolist(), width)
                  for k in langs]
        longest = max([2] + [len(samples[k]) for k in langs])
        return cls(langs, letters, width, tables, float(np.log2(longest)))

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross entropy of each text (rows) in each language, and the number of its letters."""
        out = np.full((len(texts), len(self.langs)), np.inf)
        letters = np.zeros(len(texts), np.int64)
        for part in slices(texts):
            own = [t.lower() for t in texts[part]]
            flat = self.letters.classes(code_points("\n".join(own)))
            sizes = np.fromiter(map(len, own), np.int64, len(own))
            starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
            text = np.repeat(np.arange(len(own)), sizes + (np.arange(len(own)) < len(own) - 1))
            space = flat == _SPACE
            letters[part] = np.bincount(text[~space], minlength=len(own))
            keep = ~space
            keep[1:] |= ~space[:-1]  # the first of a run of spaces after a letter
            keep[starts[1:] - 1] = False  # what stands between two texts
            flat, text = flat[keep], text[keep]
            chars = np.bincount(text, minlength=len(own))
            if not len(flat) or not self.langs:
                continue
            first = np.concatenate([[0], np.cumsum(chars)[:-1]])
            pieces = -(-chars // PIECE)
            begin = np.repeat(first - np.concatenate([[0], np.cumsum(pieces)[:-1]]) * PIECE,
                              pieces) + np.arange(pieces.sum()) * PIECE
            end = np.repeat(first + chars, pieces)
            at = begin[None, :] + np.arange(min(PIECE, chars.max()))[:, None]
            steps = np.where(at < end[None, :], flat[np.minimum(at, len(flat) - 1)],
                             self.width - 1).astype(np.int32)
            for k, table in enumerate(self.tables):
                state = np.zeros(len(begin), np.int32)
                cut = np.ones(len(begin), np.int32)
                for step in steps:
                    state = table.take(state + step)
                    broken = state & 1
                    cut += broken
                    state -= broken
                phrases = segment_sums(cut, pieces)
                out[part, k] = phrases * self.bits / np.maximum(chars, 1)
        return out, letters

    def predict(self, texts: list[str]) -> pd.DataFrame:
        """lang_pred, score (how much less entropy than the second language has) and entropy."""
        bits, letters = self.entropies(texts)
        if not self.langs:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0,
                                 "entropy": np.inf})
        order = np.sort(bits, axis=1)
        second = order[:, 1] if len(self.langs) > 1 else np.full(len(texts), np.inf)
        with np.errstate(invalid="ignore"):
            score = np.where(np.isfinite(second), 1 - order[:, 0] / second, 1.0)
        known = letters > 0
        names = np.array(self.langs + [UNKNOWN], dtype=object)
        return pd.DataFrame({
            "lang_pred": names[np.where(known, bits.argmin(axis=1), len(self.langs))],
            "score": np.where(known, score, 0.0),
            "entropy": np.where(known, order[:, 0], np.inf)})


def train(docs: DataFrame, rows: int = TRAIN_ROWS, excerpt: int = EXCERPT) -> Parser:
    """Learn from texts and non-null ``lang`` of rows whose crc32(doc_id) modulo 5 is not 0.

    Of each language the ``rows`` rows with the smallest hashes of their ids are taken, and of each
    the ``excerpt`` characters in its middle.
    """
    own = docs.select("doc_id", "lang", whole_text().alias("text")).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 5) != 0))
    top = (own.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect())
    samples: dict[str, list[str]] = {r["lang"]: [] for r in top}
    if not samples:
        return Parser.learn({})
    start = F.greatest(F.lit(1), ((F.length("text") - excerpt) / 2).cast("int") + 1)
    picks = [own.where(F.col("lang") == lang)
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
             .select("lang", F.substring("text", start, F.lit(excerpt)).alias("text"))
             for lang in samples]
    chosen = picks[0]
    for more in picks[1:]:
        chosen = chosen.unionAll(more)
    for row in chosen.collect():  # at most MAX_LANGS * rows excerpts
        samples[row["lang"]].append(row["text"])
    joined = {k: " ".join(sorted(v)) for k, v in samples.items()}
    return Parser.learn({k: "".join(map(chr, squeeze(s))) for k, s in joined.items()})


def predict_column(parser: Parser, docs: DataFrame, text: str = "text") -> Column:
    """Struct of lang_pred, score and entropy; the automata are broadcast, bounded by the sample."""
    sent = docs.sparkSession.sparkContext.broadcast(parser)

    @F.pandas_udf("lang_pred string, score double, entropy double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield sent.value.predict(batch.tolist())

    return predict(whole_text(text))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and entropy (bits a character) of every row."""
    parser = train(docs)
    found = docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"),
                        predict_column(parser, docs).alias("_found"))
    return found.select("doc_id", "held_out", "_found.lang_pred", "_found.score",
                        F.when(F.col("_found.entropy") < float("inf"),
                               F.col("_found.entropy")).alias("entropy"))


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are in one of the learned languages.

    Rejected are texts without a letter and those as far as random letters from every language.
    """
    found = predict_column(train(docs), docs)
    return docs.where((found["lang_pred"] != UNKNOWN) & (found["entropy"] < FOREIGN))
