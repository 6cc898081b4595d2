"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator."""

import math
import random
from collections import Counter
from zlib import crc32

import public_tokenizers
import pytest

import corpus_pipeline
from tallyweave.llm import (
    bpe,
    brown,
    fingerprints,
    html,
    jaccard,
    langid,
    packing,
    search,
    toxicity,
    urls,
)
from tallyweave.llm.queries import URL_RULES

WORDS = "the of and river stone light green house walks under bridge while morning sings".split()
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, "
          "class_id long, text_ string, row long")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def rows():
    base = [" ".join(random.Random(i).choices(WORDS, k=40 + i)) for i in range(24)]
    texts = base + [base[0], base[0] + " extra", None, "", "   ", "!!!", "one two", "one two",
                    " ".join(base) * 20]
    out = [(i, t, ["en", "de", None][i % 3], "s", None, 0.5, 1, "x", 2)
           for i, t in enumerate(texts)]
    return [*out, (None, base[3], "en", None, 1, None, None, None, None), out[5], out[5]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    own = [(i, 1, int(i % 4 == 0)) for i in range(24)] + [(None, 1, 1), (2, None, None)]
    return spark.createDataFrame(own, "doc_id long, quality int, toxic int")


OPERATORS = {
    "jaccard": lambda d, lab: jaccard.join(d),
    "brown": lambda d, lab: brown.score_documents(d),
    "langid": lambda d, lab: langid.identify(d),
    "fingerprints": lambda d, lab: fingerprints.fingerprints(d),
    "bpe": lambda d, lab: bpe.digest_documents(d, RANKS),
    "search": lambda d, lab: search.more_like(d, d.where("doc_id % 5 = 0")),
    "toxicity": lambda d, lab: toxicity.score_documents(d, lab),
    "packing": lambda d, lab: packing.pack(d, TOKENIZER),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, docs, labels, name):
    assert OPERATORS[name](docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("name", [n for n in OPERATORS if n not in ("search", "packing")])
def test_one_row_each(docs, labels, name):
    got = Counter(r["doc_id"] for r in OPERATORS[name](docs, labels).collect())
    assert got == Counter(r[0] for r in rows())


def test_jaccard_classes(docs):
    got = {r["doc_id"]: r for r in jaccard.join(docs).collect()}
    assert got[24]["class_id"] == got[25]["class_id"] == 0
    assert got[0]["n_links"] == 2 and got[0]["n_copies"] == 2
    assert got[5]["n_copies"] == 3 and got[31]["class_id"] == 30
    assert got[27]["class_id"] == 27 and got[27]["n_links"] == 0
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 1 and ids.count(5) == 1 and 24 not in ids and 27 in ids


def test_blocks_of_a_large_family(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    text = " ".join(f"w{k}" for k in range(200))
    own = [(i, f"{text} v{i}") for i in range(50)]
    got = jaccard.join(spark.createDataFrame(own, "doc_id long, text string")).collect()
    assert {(r["class_id"], r["n_links"]) for r in got} == {(0, 49)}


def test_brown_counts_and_gain(docs):
    own = [(r[0], [*(r[1] or "").encode().lower().split(), b""]) for r in rows()]
    key = {d: crc32(("" if d is None else str(d)).encode()) % 10 for d, _ in own}
    count = Counter(w for d, ws in own if key[d] for w in ws)
    total, kinds = sum(count.values()), len(count)
    want = {d: sum(math.log10((count[w] + .1) / (total + .1 * (kinds + 1))) for w in ws)
            for d, ws in own}
    for r in brown.score_documents(docs).collect():
        words = dict(own)[r["doc_id"]]
        assert r["train_tokens"] == total and r["n_tokens"] == len(words)
        assert r["n_known"] == sum(count[w] > 0 for w in words)
        assert abs(r["base_score"] - want[r["doc_id"]]) < 1e-6 and r["score"] <= 1e-9


def test_search_equals_scoring_every_row(docs):
    own = [(d, search.terms(t or "")) for d, t, *_ in rows()]
    df = Counter(w for _, ws in own for w in set(ws))
    n, mean = len(own), sum(len(ws) for _, ws in own) / len(own)
    idf = {w: math.log(1 + (n - k + .5) / (k + .5)) for w, k in df.items()}
    asked = {}
    for d, ws in own:
        if d is not None and d % 5 == 0:
            asked.setdefault(d, Counter()).update(ws)
    got = {}
    for r in search.more_like(docs, docs.where("doc_id % 5 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    for q, tf in asked.items():
        keep = sorted((w for w in tf if df[w] > 1), key=lambda w: (-tf[w] * idf[w], w))
        score = []
        for d, ws in own:
            c = Counter(ws)
            score.append((-round(sum(
                idf[w] * c[w] * 2.2 / (c[w] + 1.2 * (.25 + .75 * len(ws) / mean))
                for w in keep[:search.TERMS] if c[w]), 9), d is None, d or 0))
        want = sorted(s for s in score if s[0] < 0)[:search.TOP]
        have = sorted(got.get(q, []))
        assert [None if s[1] else s[2] for s in want] == [h[1] for h in have]
        assert all(abs(h[2] + s[0]) < 1e-8 for h, s in zip(have, want))


def test_search_by_all_terms_equals_scoring_every_row(spark):
    rng, some = random.Random(9), [f"w{k}" for k in range(90)]
    texts = [" ".join(rng.choices(some, k=rng.choice([5, 20, 200]))) for _ in range(60)]
    texts[30], texts[40] = texts[0], "only here"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = [Counter(search.terms(t)) for t in texts]
    df, size = Counter(w for c in own for w in c), [sum(c.values()) for c in own]
    idf = {w: math.log(1 + (60 - k + .5) / (k + .5)) for w, k in df.items()}
    got = {}
    for r in search.more_like(docs, docs.where("doc_id % 10 = 0"), keep=None).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    for q in range(0, 60, 10):
        want = sorted((-round(sum(
            idf[w] * c[w] * 2.2 / (c[w] + 1.2 * (.25 + .75 * n * 60 / sum(size)))
            for w in own[q] if c[w]), 9), d) for d, (c, n) in enumerate(zip(own, size)))
        want = [s for s in want if s[0] < 0][:search.TOP]
        have = sorted(got[q])
        assert [s[1] for s in want] == [h[1] for h in have]
        assert all(abs(h[2] + s[0]) < 1e-8 for h, s in zip(have, want))
    assert max(len(own[q]) for q in range(0, 60, 10)) > search.LONG


def test_packing_is_gapless(docs):
    got = packing.pack(docs, TOKENIZER).collect()
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.SIZE
    assert {r["doc_id"] for r in got} == {r[0] for r in rows()}
    assert [r["length"] for r in got if r["doc_id"] == 27] == [1]


def test_fingerprints_wrap_and_agree(docs):
    got = {}
    for r in fingerprints.fingerprints(docs).collect():
        got.setdefault(r["doc_id"], r)
    assert got[0]["fingerprint"] == got[24]["fingerprint"]
    assert got[0]["class_id"] == got[24]["class_id"] == 0
    assert got[26]["n_chars"] == 0 and set(got[26]["fingerprint"]) == {"0"}


def test_languages_without_letters_are_undetermined(docs):
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert {got[k]["lang_pred"] for k in (26, 27, 28, 29)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_toxicity_without_labels_is_even(docs, labels):
    got = toxicity.score_documents(docs, labels.limit(0)).collect()
    assert {r["score"] for r in got} == {0.5} and {r["predicted"] for r in got} == {0}


def test_toxicity_finds_its_words(spark):
    bad = [(i, " ".join(WORDS[(i + k) % 14] for k in range(30)) + " vilescum vileclown"
            if i % 3 == 0 else " ".join(WORDS[(i * 5 + k) % 14] for k in range(30)))
           for i in range(300)]
    docs = spark.createDataFrame(bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)],
                                   "doc_id long, toxic int")
    held = [r for r in toxicity.score_documents(docs, labels).collect() if r["held_out"]]
    assert len(held) > 50
    assert all(r["predicted"] == (r["doc_id"] % 3 == 0) for r in held)


def test_url_rules(spark):
    own = [(1, "HTTP://WWW.Example.COM/en/x?q"), (2, "http://a.example.com/en/"),
           (3, "http://x.org.net/es/1"), (4, None), (5, "no scheme"), (6, "http://x.com"),
           (7, "http://notexample.com/en/1#f"), (8, "http://h.net?x/es/"), (8, "")]
    got = {r["page_id"]: r for r in urls.judge(
        spark.createDataFrame(own, "page_id long, url string"), URL_RULES).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"]) == (
        "www.example.com", "/en/x", "www.example.com/en/")
    assert got[2]["verdict"] == "block" and got[3]["rule"] == "net/es/"
    assert (got[4]["host"], got[4]["path"], got[4]["verdict"]) == ("", "", "allow")
    assert got[6]["rule"] is None and got[7]["rule"] == "com/" and got[8]["path"] == ""


def test_pages(spark):
    own = [(1, None, None), (2, "u", ""), (3, "u", "<p>a  b</p><script>x</script>")]
    pages = spark.createDataFrame(own, "page_id long, url string, html string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html.extract_pages(pages).collect()}
    assert got == {1: ("", 0), 2: ("", 0), 3: ("a b", 3)}


def test_pipeline_stages_keep_columns(spark, docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path)).cache()
        assert now.columns == docs.columns
    assert 0 < now.count() < docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).count() >= now.count()
