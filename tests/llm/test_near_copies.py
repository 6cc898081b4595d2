"""Classes of near copies against every pair compared."""

import numpy as np
import pytest

from tallyweave.llm import fingerprints as P


def _classes(prints, least):
    """Class of every fingerprint by comparing all pairs."""
    like = P.likeness(prints[:, None, :], prints[None, :, :]) >= least
    root = np.arange(len(prints))
    while True:
        best = np.where(like, root[None, :], len(prints)).min(axis=1)
        if (best == root).all():
            return root.tolist()
        root = best


def _changed(rng, print_, n):
    out = print_.copy()
    at = rng.choice(P.SAMPLES, n, replace=False)
    out[at] ^= rng.integers(1, 256, n, dtype=np.uint8)
    return out


def _found(spark, prints):
    return spark.createDataFrame([(i, p.tobytes()) for i, p in enumerate(prints)],
                                 "doc_id long, fingerprint binary")


def _got(spark, prints, least):
    got = {bytes(r.fingerprint): r.class_id
           for r in P.near_copies(_found(spark, prints), least).collect()}
    return [got.get(p.tobytes(), i) for i, p in enumerate(prints)]


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, least):
    monkeypatch.setattr(P, "BLOCK", 16)
    rng = np.random.default_rng(5)
    most = P.SAMPLES - next(k for k in range(P.SAMPLES + 1) if P.likeness(
        np.arange(P.SAMPLES), np.where(np.arange(P.SAMPLES) < k, np.arange(P.SAMPLES), -1)) >= least)
    prints = []
    for _ in range(12):  # pairs as unlike as they may be and a little more, spread over all samples
        one = rng.integers(0, 256, P.SAMPLES, dtype=np.uint8)
        prints += [one, _changed(rng, one, most), _changed(rng, one, most + 1)]
    # one bucket of many texts: the first is like none of them, some are like each other
    start = rng.integers(0, 256, P.SAMPLES, dtype=np.uint8)
    for _ in range(60):
        one = rng.integers(0, 256, P.SAMPLES, dtype=np.uint8)
        one[:24] = start[:24]
        prints.append(one)
        if rng.integers(2):
            prints.append(_changed(rng, one, most // 2))
    prints = np.array(prints)
    assert _got(spark, prints, least) == _classes(prints, least)


def test_members_unlike_their_first_one_are_linked(spark):
    rng = np.random.default_rng(1)
    first, second = rng.integers(0, 256, (2, P.SAMPLES), dtype=np.uint8)
    second[:32] = first[:32]
    third = second.copy()
    third[np.arange(34, P.SAMPLES, 8)] ^= 1  # one sample of every later band of eight
    prints = np.array([first, second, third])
    assert _got(spark, prints, 0.8) == _classes(prints, 0.8) == [0, 1, 1]


def test_least_likeness_is_checked(spark):
    with pytest.raises(ValueError, match="least likeness"):
        P.least_equal(0)
