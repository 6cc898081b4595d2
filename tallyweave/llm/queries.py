"""The named queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import (
    bpe,
    brown,
    fingerprints,
    html,
    jaccard,
    langid,
    packing,
    periodic,
    prefix_bpe,
    ranked,
    search,
    toxicity,
    urls,
)
from tallyweave.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_toxicity(spark, sf_dir):
    """Toxicity score of every document by class-conditional Kneser-Ney models."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "labels"))


@query
def op1_ngram_jaccard_join(spark, sf_dir):
    """Class of near copies and number of links of every document."""
    return jaccard.join(table(spark, sf_dir, "documents"))


@query
def op3_language_id(spark, sf_dir):
    """Language of every document by cross-parsing entropy."""
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op10_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"))


@query
def op5_byte_bpe(spark, sf_dir):
    """Digests of the byte-level BPE ids of every document and of what they decode to."""
    return bpe.digest_documents(table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


# The rules that come before the model.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


@query
def op6_url_filter(spark, sf_dir):
    """Verdict on every page's URL by rules, or else by the model."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op9_html_extraction(spark, sf_dir):
    """Main text of every page by composite text density."""
    return html.extract_pages(table(spark, sf_dir, "pages"))


@query
def op4_document_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query
def op2_brown_class_lm(spark, sf_dir):
    """log10 probability of every document under class-based bigrams."""
    return brown.score_documents(table(spark, sf_dir, "documents"))


@query
def op7_top_k_search(spark, sf_dir):
    """The ten documents most like every document whose id is divisible by 20, by all its terms."""
    docs = table(spark, sf_dir, "documents")
    return search.more_like(docs, docs.where(F.col("doc_id") % 20 == 0), keep=None)


@query
def op11_prefix_bpe(spark, sf_dir):
    """Digests of the byte-level BPE ids of every document and of the text they decode to."""
    return prefix_bpe.digest_documents(table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("byte_bpe_50k.json"))


@query
def op12_periodic_runs(spark, sf_dir):
    """Runs of repeated words in every document, some with planted ones, and what collapses them."""
    return periodic.digest_runs(periodic.with_planted_runs(table(spark, sf_dir, "documents")))


@query
def op13_ranked_search(spark, sf_dir):
    """The 50 documents that score best for every item of the benchmark."""
    return ranked.rank_documents(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


ORACLES["op13_ranked_search"] = r"""
WITH fixed AS (SELECT '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS term,
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS capitals, 'abcdefghijklmnopqrstuvwxyz' AS small),
docs AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), capitals, small), term) AS terms FROM documents, fixed),
items AS (
  SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), capitals, small), term)) AS terms FROM benchmark, fixed),
asked AS (SELECT i, item_id, unnest(terms) AS t FROM items),
sums AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms
         FROM docs WHERE len(terms) > 0),
held AS (
  SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(terms) AS t FROM docs)
  WHERE t IN (SELECT t FROM asked) GROUP BY d, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM held GROUP BY t), sums),
scored AS (
  SELECT i, item_id, doc_id, d, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (
    100 - 50 + (50 * len(terms) * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN held USING (t) JOIN weights USING (t) JOIN docs USING (d), sums
  GROUP BY i, item_id, doc_id, d)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0) WHERE rank <= 50
"""
