"""Helpers shared by the operators on documents."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_text(text: str | Column = "text") -> Column:
    """The text itself, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id counts as the empty text."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def documents(docs: DataFrame) -> DataFrame:
    """doc_id and whole text only, so that other columns cannot clash."""
    return docs.select(F.col("doc_id"), whole_text().alias("text"))


def slices(texts: list[str], most: int = 4_000_000) -> Iterator[slice]:
    """Consecutive slices of about ``most`` characters; a longer text is a slice of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield slice(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def code_points(text: str) -> np.ndarray:
    """One uint32 per code point; a lone surrogate stays as it is."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def segment_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments of the given sizes; an empty segment sums to 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


_ODD = re.compile(r"\s\s|\A\s|\s\Z")


class WordCodes:
    """Token ids of texts under a pattern that joins a space only to what follows it.

    A text without white space at its ends or next to other white space is then its first part up to
    a space and each further part with its space, each encoded alone. Parts are remembered, up to
    ``most`` of them. ``ids`` encodes any text, ``line`` is the token of a line end.
    """

    def __init__(self, line: int, most: int):
        self.line, self.most = line, most
        self.heads: dict[str, bytes] = {"": b""}
        self.spaced: dict[str, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        raise NotImplementedError

    def _learn(self, known: dict[str, bytes], parts: set[str], before: str) -> None:
        """Encode parts, many in one call with a line end between two.

        A line end with no white space beside it is a token of its own, so a part's ids end at the
        next line end that is not one of its own.
        """
        new = list(parts - known.keys())
        for start in range(0, len(new), 5000):
            own = new[start:start + 5000]
            ids = self.ids(before + ("\n" + before).join(own))
            cuts = np.append(np.flatnonzero(ids == self.line), len(ids))
            ends = cuts[np.cumsum([p.count("\n") + 1 for p in own]) - 1] * 4
            data, begin = ids.tobytes(), 0
            for part, end in zip(own, ends.tolist()):
                known[part] = data[begin:end]
                begin = end + 4

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit bytes."""
        if len(self.heads) + len(self.spaced) > self.most:
            self.heads, self.spaced = {"": b""}, {}
        odd = [_ODD.search(t) is not None for t in texts]
        lists = [[] if o else t.split(" ") for o, t in zip(odd, texts)]
        firsts = [p[0] if p else "" for p in lists]
        rest = [p[1:] for p in lists]
        self._learn(self.heads, set(firsts), "")
        self._learn(self.spaced, set().union(*rest), " ")
        head, find = self.heads.__getitem__, self.spaced.__getitem__
        return [self.ids(t).tobytes() if o else head(f) + b"".join(map(find, r))
                for o, t, f, r in zip(odd, texts, firsts, rest)]
