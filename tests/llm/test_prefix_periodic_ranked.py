"""Prefix BPE, periodic runs and ranked search: against brute force, and on odd rows."""

import hashlib
import random
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyweave.llm import periodic, prefix_bpe, ranked
from tests.llm.test_edges import SCHEMA, rows
from tests.llm.test_kernels import TEXTS

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


# --- prefix BPE ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return prefix_bpe.Vocabulary(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    whole = Tokenizer.from_file(TOKENIZER)
    whole.no_truncation()
    whole.no_padding()
    return whole


def test_prefix_encoder_equals_the_library(vocabulary, library):
    rng = random.Random(1)
    texts = TEXTS + [
        "a <|endoftext|>", "<|endoftext|>x <|endoftext|><|endoftext|> \n <|endoftext|>\ny",
        "<|endoftext", "x" * 5000, "-=" * 3000, "ab" * 1500 + "c", "字" * 3000]
    texts += ["".join(rng.choice("etaoin shr,.\n") for _ in range(300)) for _ in range(60)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2fff)]))
                      for _ in range(150)) for _ in range(60)]
    own = prefix_bpe.PrefixEncoder(vocabulary)
    for _ in range(2):  # cold and remembered
        for text, data in zip(texts, own(texts)):
            ids = np.frombuffer(data, "<u4")
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
            assert own.decode(ids).decode("utf-8", "replace") == library.decode(
                ids.tolist(), skip_special_tokens=False)


def test_prefix_encoder_knows_the_library_s_letters(vocabulary, library):
    own = vocabulary.encoder()
    for c in [*range(0x3000), *range(0x1D000, 0x1F000, 7), *range(0x32000, 0x34000, 5), 0x10FFFF]:
        text = f"a{chr(c)}a {chr(c)}1{chr(c)}{chr(c)} !{chr(c)}!"
        cut = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert own.pattern.findall(text) == cut, hex(c)


def test_last_tokens_are_those_of_every_prefix(vocabulary, library):
    own = vocabulary.encoder()
    word = " unbelievablyantidisestablishment"
    for k in range(1, len(word) + 1):
        assert own.ids(word[:k]).tolist() == library.encode(word[:k]).ids


def test_automaton_finds_longest_matches():
    rng = random.Random(2)
    words = sorted({bytes(rng.choices(b"abc", k=rng.randint(1, 6))) for _ in range(30)})
    auto = prefix_bpe.Automaton(words)
    text = bytes(rng.choices(b"abc", k=400))
    data = np.frombuffer(text, np.uint8).astype(np.int64)
    got = [int(held[0]) for _, _, _, held in auto.matches(data, np.array([0]), np.array([400]))]
    for i, n in enumerate(got, 1):
        assert n == max(k for k in range(i + 1) if any(text[i - k:i] in w for w in words))


def test_prefix_documents(spark, docs, library):
    own = {}
    for d, t, *_ in rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        own.setdefault(d, (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                           hashlib.sha256((t or "").encode()).hexdigest()))
    got = prefix_bpe.digest_documents(docs, TOKENIZER).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows())
    assert all(tuple(r)[1:] == own[r["doc_id"]] for r in got)
    full = prefix_bpe.encode_documents(docs, TOKENIZER).where("doc_id = 31").first()
    assert full["decoded"] == dict((r[0], r[1]) for r in rows())[31]
    assert prefix_bpe.digest_documents(docs.limit(0), TOKENIZER).count() == 0


# --- periodic runs ---------------------------------------------------------------------------

def slow_runs(words):
    out = {}
    for q in range(1, len(words) // periodic.TIMES + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(periodic.LEAST, periodic.TIMES * q):
                out.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((a, b - a, q) for (a, b), q in out.items())


def periodic_texts(seed, count):
    rng, out = random.Random(seed), []
    for _ in range(count):
        some = [f"w{i}" for i in range(rng.choice([1, 2, 3, 5, 30]))]
        words = rng.choices(some, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 4)):
            part = rng.choices(some, k=rng.choice([1, 2, 3, 5, 8, 9, 13, 15, 16, 17, 31, 33, 64]))
            words += (part * 9)[:rng.randint(1, 300)] + rng.choices(some, k=rng.randint(0, 5))
        out.append(" ".join(words * rng.choice([1, 1, 3])))
    inner = ["a"] * 40 + ["b"] * 33
    return [*out, " ".join(inner * 5), " ".join(["a"] * 23), " ".join(["a"] * 24), "", " \t\x0b "]


@pytest.mark.parametrize("largest", [8, 32, 1 << 19])
def test_runs_equal_brute_force(largest, monkeypatch):
    monkeypatch.setattr(periodic, "LARGEST", largest)
    texts = periodic_texts(largest, 120)
    words, runs = periodic.runs_of(texts)
    for text, own, found in zip(texts, words, runs):
        assert [w.decode() for w in own] == text.split()
        assert found == slow_runs(own)


@pytest.mark.parametrize("size", [8, 128, 1024, 1 << 15])
def test_transform_is_exact(size):
    rng, p = random.Random(size), periodic.PRIME
    row = {rng.randrange(size): rng.randrange(p) for _ in range(4)}
    x = np.zeros((1, size))
    x[0, list(row)] = list(row.values())
    got = periodic.transform(periodic.residue(x))[0].astype(np.int64) % p
    w = pow(periodic.ROOT, (p - 1) // size, p)
    for k in [0, 1, size // 2 + 1, size - 1]:
        assert got[k] == sum(v * pow(w, i * k, p) for i, v in row.items()) % p


def test_zeros_are_the_equal_windows():
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.integers(0, 2, 400), np.zeros(64)]).astype(np.float64)
    begin = np.arange(0, 360, 16)
    block, d = periodic.zeros(values, begin, 16, 16, 31)
    want = [(k, s) for k, a in enumerate(begin) for s in range(16, 32)
            if (values[a:a + 16] == values[a + s:a + s + 16]).all()]
    assert list(zip(block.tolist(), d.tolist())) == want


def planted(doc_id, text):
    words, h = (text or "").encode().split(), crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_run_digests_of_documents(spark):
    extra = [(100 + k, t) for k, t in enumerate(periodic_texts(7, 40))]
    own = [(r[0], r[1]) for r in rows()] + extra + [(500, "a b " * 30), (501, "a\nb\x0b" * 20)]
    docs = spark.createDataFrame(
        [(*r, 1, 2, "x") for r in own],
        "doc_id long, text string, runs int, period int, collapsed string").repartition(4)
    want = Counter()
    for d, t in own:
        words = planted(d, t)
        runs, drop, best = slow_runs(words), set(), None
        for r in runs:
            drop.update(range(r[0] + r[2], r[0] + r[1]))
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        want[(d, len(runs), *(best or (None,) * 3),
              1000 * best[1] // best[2] if best else None,
              hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())] += 1
    got = periodic.digest_runs(periodic.with_planted_runs(docs))
    assert Counter(tuple(r) for r in got.collect()) == want
    assert sum(k[1] > 0 for k in want) > 10
    assert periodic.digest_runs(periodic.with_planted_runs(docs.limit(0))).count() == 0


# --- ranked search ---------------------------------------------------------------------------

def slow_ranks(docs, items, k):
    import math
    import re
    def cut(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub(
            "[A-Z]", lambda m: m.group().lower(), t or ""))
    own = [(d, cut(t)) for d, t in docs]
    own = [(d, Counter(ws), len(ws)) for d, ws in own if ws]
    n, total = len(own), sum(s for _, _, s in own)
    df = Counter(w for _, c, _ in own for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for w, c in df.items()}
    out = []
    for item, text in items:
        hits = []
        for d, c, s in own:
            m = 100 - 50 + (50 * s * n) // total
            score = sum(weight[w] * (1_000_000_000 * c[w] // (1000 * c[w] + 20 * m))
                        for w in set(cut(text)) if w in c)
            hits += [(-score, d is None, d or 0)] if score else []
        out += [(item, r, None if h[1] else h[2], -h[0])
                for r, h in enumerate(sorted(hits)[:k], 1)]
    return Counter(out)


def search_rows(seed):
    rng = random.Random(seed)
    some = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(2000)]
    docs = [(i, " ".join(rng.choices(some, k=rng.choice([1, 5, 30, 200])))) for i in range(400)]
    docs += [(400 + i, docs[i % 3][1]) for i in range(60)] + [(1, docs[1][1]), (None, docs[2][1])]
    docs += [(900, None), (901, ""), (902, " ..."), (903, "É straße W1,w2-W3"), (904, "w1 " * 50_000)]
    items = [(i, " ".join(rng.choices(some, k=rng.choice([1, 3, 40])))) for i in range(20)]
    items += [(50, None), (51, ""), (52, "unheard"), (53, docs[2][1]), (53, "w1"), (None, "W2 É")]
    return docs, items


@pytest.mark.parametrize("terms", [200_000, 40])
def test_ranks_equal_scoring_everything(spark, monkeypatch, terms):
    monkeypatch.setattr(ranked, "TERMS", terms)
    docs, items = search_rows(5)
    table = spark.createDataFrame([(*d, 1, 2) for d in docs],
                                  "doc_id long, text string, score int, rank int").repartition(3)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, item int")
    got = Counter(tuple(r) for r in ranked.rank_documents(table, asked).collect())
    assert got == slow_ranks(docs, items, ranked.TOP)
    assert ranked.rank_documents(table.limit(0), asked).count() == 0
    assert ranked.rank_documents(table, asked.limit(0)).count() == 0


def test_reading_stops_early_and_keeps_ties():
    rng = np.random.default_rng(4)
    docs, kinds = 20_000, 4
    doc, term = np.repeat(np.arange(docs), kinds), np.tile(np.arange(kinds), docs)
    impact = (1e6 / (1 + rng.permutation(docs * kinds))).astype(np.int64) + 1
    impact[4 * 77:4 * 77 + 4] = impact[4 * 99:4 * 99 + 4] = 600_000  # two of equal score
    lists = ranked.Lists(doc, term, impact, kinds)
    looked = []
    find = lists.look_up
    lists.look_up = lambda d: (looked.extend(d.tolist()), find(d))[1]
    got, score = lists.search(np.arange(kinds), 1, 0)
    assert sorted(got.tolist()) == [77, 99] and set(score.tolist()) == {2_400_000}
    assert len(looked) < docs / 10
    again, _ = lists.search(np.arange(kinds), 1, 2_400_000)
    assert sorted(again.tolist()) == [77, 99]
    assert not lists.seen.any() and not lists.known.any()


def test_parts_hold_every_entry_once(monkeypatch):
    import pandas as pd
    monkeypatch.setattr(ranked, "PART", 50)
    rng = random.Random(6)
    own = [(d, [*range(rng.randint(0, 9))]) for d in range(100)]
    batches = [pd.DataFrame({"doc_id": [d for d, _ in own[k:k + 7]], "size": 9,
                             "codes": [np.array(c, np.int32) for _, c in own[k:k + 7]],
                             "times": [np.array(c, np.int32) + 1 for _, c in own[k:k + 7]]})
               for k in range(0, 100, 7)]
    parts = list(ranked._parts(iter(batches)))
    assert len(parts) > 3
    got = [(ids[d], c, n) for ids, doc, code, tf, _ in parts
           for d, c, n in zip(doc.tolist(), code.tolist(), tf.tolist())]
    assert got == [(d, c, c + 1) for d, cs in own for c in cs]
