"""The operators' local parts against brute force."""

import base64
import collections
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tallyweave.llm import bpe, fingerprints, html, jaccard, langid, packing, search, urls
from tallyweave.llm.text import slices

TEXTS = ["", " ", "\n", " a", "a ", "a  b", "a\nb", "a\n b c\n\nd e", "\na b\n", "x y z",
         "<|endoftext|> a b", "a 　b", "é\x1cb c\td", "'s don't I'll", "1 2  3   4",
         "a\x85b c", "abc" * 700, "ab" * 501 + "a", "日本語 テキスト" * 9, "😀" * 40, "-" * 301]


def test_word_codes_equal_the_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("etaoin shr,.\n") for _ in range(300)) for _ in range(40)]
    own = packing.Encoder(path)
    for _ in range(2):  # cold and remembered
        got = [np.frombuffer(x, "<u4").tolist() for x in own(texts)]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_tree_encoder_equals_tiktoken_and_decodes():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens={})
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("etaoinéß ") for _ in range(500)) for _ in range(40)]
    own = bpe.TreeEncoder(path)
    for text, data in zip(texts, own(texts)):
        ids = np.frombuffer(data, "<u4").tolist()
        assert ids == whole.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


@pytest.mark.parametrize("seed", range(20))
def test_sweep_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 1024, rng.randint(1, 1024), rng.randint(1, 300)])
               for _ in range(rng.choice([0, 1, 50, 600]))]
    _, opened = packing.sweep(collections.Counter(lengths))
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        gap = min(fits) if fits else packing.SIZE
        if fits:
            gaps.remove(gap)
        gaps.append(gap - n)
    assert opened == len(gaps)


def test_cut_keeps_the_odd_piece_first():
    assert packing.cut(b"\0" * 4 * 2500)[0][:2] == (0, 452)
    assert [p[1] for p in packing.cut(b"\0" * 4 * 2048)] == [1024, 1024]
    assert packing.cut(b"\0" * 4)[0][:2] == (0, 1)


def test_automaton_counts_greedy_phrases():
    sample, rng = "abracadabra banana", random.Random(3)
    parser = langid.Parser.learn({"xx": sample})
    for _ in range(60):
        text = "".join(rng.choice("abrcdnz ") for _ in range(rng.randint(1, 60)))
        text = " ".join(text.split())
        if not text:
            continue
        phrases = i = 0
        while i < len(text):
            j = i + 1
            while j < len(text) and text[i:j + 1] in sample:
                j += 1
            phrases, i = phrases + 1, j
        bits, _ = parser.entropies([text])
        assert abs(bits[0, 0] * len(text) / parser.bits - phrases) < 1e-6


def test_verify_counts_every_link():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 40, 30).astype(np.uint64)) for _ in range(60)]
    ids, copies = np.arange(60), rng.integers(1, 4, 60)
    links, _ = jaccard.verify(sets, ids, copies, np.zeros(60, int), 0.5)
    for i in range(60):
        want = sum(copies[j] for j in range(60) if j != i
                   and len(np.intersect1d(sets[i], sets[j])) >= 0.5 * len(np.union1d(sets[i], sets[j])))
        assert links[i] == want


def test_depth_reaches_the_recall():
    d = jaccard.depth()
    assert 1 - (1 - 0.8 ** d) ** jaccard.TREES >= jaccard.RECALL
    assert 1 - (1 - 0.8 ** (d + 1)) ** jaccard.TREES < jaccard.RECALL


def test_embedding_is_stable_and_measures_edits():
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefghij ") for _ in range(30_000))
    edit = text[:9000] + "xyz" + text[9000:]
    other = "".join(rng.choice("abcdefghij ") for _ in range(30_000))
    own = fingerprints.Embedding()
    together = own([text, edit, "", other, "a"])
    assert (together[0] == fingerprints.Embedding()([text])[0]).all()
    assert fingerprints.likeness(together[0], together[1]) > 0.9
    assert fingerprints.likeness(together[0], together[3]) < 0.1
    assert not together[2].any()


@pytest.mark.parametrize("held", [False, True])
def test_segments_are_walked_to_their_end(held):
    rng = random.Random(8)
    size, own = fingerprints.SEGMENT, fingerprints.Embedding()
    if held:  # walks that would never move of themselves
        own.moves[:] = 0
    texts = ["".join(rng.choices("abcdefghij ", k=size + 40)) for _ in range(20)]
    edits = [t[:size - 100] + "".join(rng.choices("klmnopqrst", k=100)) + t[size:] for t in texts]
    prints = own(texts + edits)
    share = (prints[:20] != prints[20:]).mean()
    assert 0.005 < share < 0.03  # 100 of 8,192 characters are 0.012


@pytest.mark.parametrize("step", [1, 50, 1_000_000])
def test_part_search_equals_scoring_all(step, monkeypatch):
    monkeypatch.setattr(search, "STEP", step)
    rng = np.random.default_rng(6)
    for _ in range(5):
        terms, asked = 30, search.Queries(50.0, 10)
        weight = rng.random(terms) + 0.1
        lists = [rng.permutation(terms)[:rng.integers(1, 9)].tolist() for _ in range(40)]
        lists[0] = list(range(terms))
        asked.add(list(range(40)), [list(map(str, q)) for q in lists], [weight[q] for q in lists])
        asked.ready()
        code = np.array([asked.index[str(t)] for t in range(terms)])
        score = np.zeros((40, 0))
        for _ in range(3):  # three parts, the last of copies of the second
            rows = 400
            if score.shape[1] < 800:
                row, term = rng.integers(0, rows, 6000), (rng.integers(0, 900, 6000) ** .5).astype(int)
            lengths = np.bincount(row, minlength=rows)
            ids = np.arange(score.shape[1], score.shape[1] + rows)
            part = search.Part(row, code[term], lengths, asked.weight, 50.0, ids,
                               np.zeros(rows, bool))
            part.search(asked)
            own = np.zeros((40, rows))
            for q, ts in enumerate(lists):
                for t in code[ts]:
                    has = part.term == t
                    own[q, part.row[has]] += part.impact[has]
            score = np.hstack([score, own])
        for q in range(40):
            want = np.lexsort((np.arange(score.shape[1]), -score[q]))[:10]
            assert asked.doc[q].tolist() == want.tolist()
            assert np.allclose(asked.score[q], score[q][want])


def test_long_queries_hold_a_bounded_matrix():
    rng = np.random.default_rng(7)
    terms, rows, asked = 600, 20_000, search.Queries(50.0, 10)
    weight = rng.random(terms) + 0.1
    asked.add(list(range(10)), [list(map(str, range(terms)))] * 10, [weight] * 10)
    asked.ready()
    row, term = rng.integers(0, rows, 500_000), rng.integers(0, terms, 500_000)
    part = search.Part(row, term, np.bincount(row, minlength=rows), asked.weight, 50.0,
                       np.arange(rows), np.zeros(rows, bool), asked.grid)
    tracemalloc.start()
    part.search(asked)
    assert tracemalloc.get_traced_memory()[1] < 70_000_000
    tracemalloc.stop()
    score = np.bincount(part.row, part.impact, rows)
    want = np.lexsort((np.arange(rows), -score))[:10]
    assert asked.doc[9].tolist() == want.tolist() and (asked.score[9] == score[want]).all()


def test_html_keeps_the_article_only():
    page = ('<html><head><title>t</title></head><body><nav><a href=1>Home</a></nav>'
            '<div id="cookie-notice">We use cookies</div><div class="post-content"><h1>Head</h1>'
            '<p>First <b>bold</b> and &eacute;&#128;\n text<p>Second one<ul><li>item</ul></div>'
            '<div id="comments"><p>' + "A reader wrote this. " * 30 + '</p></div>'
            '<form>Send</form><footer>(c)</footer>')
    assert html.extract(page) == "Head\n\nFirst bold and é€ text\n\nSecond one\n\nitem"
    assert html.extract(None) == html.extract("") == ""
    assert html.extract("plain &amp; simple") == "plain & simple"
    assert html.extract("&#55296;&#1114112;<p>x") .endswith("x")


def test_url_model_learns_its_table():
    model = urls.train()
    hosts, _, paths = zip(*(u.partition("/") for u, _ in urls.LABELLED))
    p = model(list(hosts), ["/" + x for x in paths])
    assert ((p >= 0.5) == np.array([k == 1 for _, k in urls.LABELLED])).all()
    assert model([""], [""])[0] < 0.5


def test_slices_cover_everything():
    texts = ["x" * n for n in (0, 5, 0, 9, 1, 30, 2)]
    assert [k for s in slices(texts, 10) for k in range(s.start, s.stop)] == list(range(7))
