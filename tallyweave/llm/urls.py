"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

The model is trained on a small table of labelled URLs. Character n-grams of the host and of the path
are hashed, apart from each other, into ``BUCKETS`` features; each URL's features have length 1. A
URL is blocked if its probability reaches ``THRESHOLD``.

A rule is a host and the start of a path. It fits its host and all subdomains, on paths that start
so; of several that fit the longest decides, and no model is asked.

Without ``://`` or if null, host and path are empty; no rule fits and the model decides by its
constant, which allows. Rows, also repeated ones, are judged each.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
GRAMS = (3, 4, 5)
THRESHOLD = 0.5
PRIOR = 0.35

# The labelled URLs that the model learns from (1: to be blocked).
LABELLED = [
    ("cheap-pills.example.com/buy/now", 1), ("www.cheap-meds-online.example.net/order", 1),
    ("spam-farm.example.org/links/12", 1), ("www.link-farm.example.com/page/3", 1),
    ("best-casino-bonus.example.net/win", 1), ("free-casino.example.org/slots/777", 1),
    ("online-poker-room.example.com/deposit", 1), ("hot-adult-videos.example.net/xxx/1", 1),
    ("xxx-cams.example.com/live", 1), ("free-porn-tube.example.org/watch/9", 1),
    ("replica-watches.example.com/rolex", 1), ("payday-loans-fast.example.net/apply", 1),
    ("download-warez.example.org/crack/keygen", 1), ("torrent-cracks.example.net/serial", 1),
    ("cheap-viagra.example.org/shop", 1), ("pills-discount.example.com/cialis", 1),
    ("seo-spam.example.net/backlinks", 1), ("win-free-prize.example.com/claim", 1),
    ("click-bait-farm.example.org/top10", 1), ("malware-host.example.com/setup.exe", 1),
    ("phishing-login.example.net/verify/account", 1), ("m.spam-blog.example.com/en/4", 1),
    ("blog.casino-tips.example.org/en/9", 1), ("cheap-pills.example.net/de/55.html", 1),
    ("spam-farm.example.com/fr/81", 1), ("adult-dating.example.org/es/7", 1),
    ("free-bets.example.org/en/31", 1), ("sports-bets.example.com/odds", 1),
    ("ads-track.example.net/pixel", 1), ("ads-server.example.org/track/click", 1),
    ("adult-x.example.org/en/3", 1), ("casino-win.example.net/de/8", 1),
    ("www.example.com/en/12", 0), ("example.org/about", 0), ("blog.example.net/2020/05/post", 0),
    ("news.example.com/world/report.html", 0), ("m.weather.example.org/en/25", 0),
    ("university.example.org/courses/physics", 0), ("docs.example.net/guide/install", 0),
    ("shop.garden.example.com/tools/12", 0), ("www.history-museum.example.org/fr/114", 0),
    ("blog.theren.example.net/en/455", 0), ("ththan.example.org/de/612/", 0),
    ("www.thernd.example.com/es/240.html", 0), ("city-library.example.net/es/books", 0),
    ("forum.cooking.example.com/thread/88", 0), ("m.tionth.example.org/fr/66", 0),
    ("wiki.example.org/article/river", 0), ("recipes.example.com/soup/onion", 0),
    ("www.thered.example.net/en/334/", 0), ("travel.example.com/de/berlin", 0),
    ("blog.ourth.example.com/en/960", 0), ("science.example.net/paper/17.html", 0),
    ("m.music.example.org/en/album/3", 0), ("sports.example.com/results/2021", 0),
    ("therin.example.net/fr/770", 0), ("www.health-service.example.org/en/advice", 0),
    ("parliament.example.net/de/debates", 0), ("thst.example.com/es/18", 0),
]


def host_of(url: str | Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case."""
    found = F.regexp_extract(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")),
                             r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.regexp_extract(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")),
                            r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_column(rules: list[tuple[str, str]], host: Column, path: Column) -> Column:
    """Struct of rule and verdict of the longest rule that fits, null if none does."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
                       ).otherwise(found)
    return found


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all URLs, and how many each URL has."""
    buckets, sizes = [], []
    for host, path in zip(hosts, paths):
        grams = {part + text[i:i + n] for part, text in (("h", f"^{host}$"), ("p", path))
                 if text not in ("", "^$") for n in GRAMS for i in range(len(text) - n + 1)}
        buckets += [xxhash.xxh32_intdigest(g) % BUCKETS for g in grams]
        sizes.append(len(grams))
    return np.array(buckets, np.int64), np.array(sizes, np.int64)


@dataclass
class Model:
    weights: np.ndarray
    constant: float

    def __call__(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Probability that a URL is to be blocked."""
        buckets, sizes = features(hosts, paths)
        total = np.concatenate([[0], np.cumsum(self.weights[buckets])])
        ends = np.cumsum(sizes)
        z = (total[ends] - total[ends - sizes]) / np.sqrt(np.maximum(sizes, 1)) + self.constant
        return 1 / (1 + np.exp(-z))


def train(labelled: list[tuple[str, int]] = LABELLED, rounds: int = 400, rate: float = 4.0,
          ridge: float = 0.002) -> Model:
    """Ridge-penalised logistic regression by gradient steps on a small table of URLs.

    The constant is fixed by ``PRIOR``, so that a URL with nothing to judge by is allowed.
    """
    hosts, paths = zip(*((h, "/" + p) for h, _, p in (u.partition("/") for u, _ in labelled)))
    y = np.array([k for _, k in labelled], float)
    buckets, sizes = features(list(hosts), list(paths))
    x = np.zeros((len(y), BUCKETS), np.float32)
    np.add.at(x, (np.repeat(np.arange(len(y)), sizes), buckets), 1)
    x /= np.sqrt(np.maximum(sizes, 1))[:, None]
    weights, constant = np.zeros(BUCKETS), float(np.log(PRIOR / (1 - PRIOR)))
    for _ in range(rounds):
        miss = 1 / (1 + np.exp(-(x @ weights + constant))) - y
        weights -= rate * (x.T @ miss / len(y) + ridge * weights)
    return Model(weights, constant)


def judge(pages: DataFrame, rules: list[tuple[str, str]], model: Model | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's probability (null where a rule decides)."""
    sent = pages.sparkSession.sparkContext.broadcast(model or train())  # BUCKETS weights

    @F.pandas_udf("double")
    def probability(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for host, path in batches:
            yield pd.Series(sent.value(host.tolist(), path.tolist()))

    parts = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    ruled = parts.withColumn("_found", rule_column(rules, F.col("host"), F.col("path")))
    scored = ruled.withColumn("_p", probability("host", "path"))
    by_model = F.when(F.col("_p") >= THRESHOLD, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", F.col("_found.rule").alias("rule"),
        F.coalesce("_found.verdict", by_model).alias("verdict"),
        F.when(F.col("_found.rule").isNull(), F.col("_p")).alias("block_probability"))
