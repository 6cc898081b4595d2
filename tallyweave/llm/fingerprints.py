"""Document fingerprints by randomised edit embedding.

A shared random walk reads a text: at each step the character under the pointer is put out, and a bit
drawn for that step and character says whether the pointer moves on. Two texts are walked alike; after
an edit their walks fall into step again, so that edits become substitutions in what is put out, and
edit distance becomes Hamming distance. Texts are walked in segments of ``SEGMENT`` characters, which
many texts do side by side. Each is walked to its end: that takes two steps a character on average, and
a walk with no more than about one step left for each character moves on at every step, so that
``STEPS`` steps always suffice.

A fingerprint samples ``SAMPLES`` positions of the embedding, the same ones for texts of like length:
of random ranks of all positions the least one before the text's end, and where the walk of a segment
has ended before that position the next record of the ranks before it. A sample is one byte, a hash of
the last 16 characters put out. Likeness of two fingerprints is the share of equal samples, less what
chance gives. Texts without a character have the fingerprint of zeros; equal texts have equal ones.

Near copies are found by banding: samples are cut into one band more than samples may differ at the
least likeness, so that two fingerprints as alike as that agree in a band and meet in a bucket. Each is
verified against the bucket's first one and links are closed to classes; those that are then not in the
class of their bucket's first one are verified against all others of the bucket, in pairs of blocks, which
joins more classes. Equal fingerprints are one node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.components import components
from tallyweave.llm.shared import stored
from tallyweave.llm.text import code_points, documents, slices

SEGMENT = 8192
#: Two steps a character, and eight standard deviations of the steps that many characters take.
STEPS = 2 * SEGMENT + 1024
SAMPLES = 128
LIKENESS = 0.8
#: Members of a bucket that are compared at once with as many others of it.
BLOCK = 1024
#: Characters of texts walked at a time; a longer text is walked alone.
WALKED = 3_000_000
#: After so many steps the walks that have ended are set aside.
ROUND = 64


class Embedding:
    """The shared walk and the sampled positions, drawn from a seed."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.moves = rng.integers(0, 2, (STEPS, 256), dtype=np.uint8)
        self.moves[:, 0] = 0  # the end of a segment holds the pointer
        self.marks = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2)
        self.rng = np.random.default_rng(seed + 1)
        self.records = [[int(p)] for p in np.zeros(SAMPLES)]

    def positions(self, ends: int) -> list[np.ndarray]:
        """Of each sample the positions that are less in rank than all before, up to ``ends``."""
        # of ranks drawn for each position the next record after p is at about p / uniform
        for k in range(SAMPLES):
            rng = np.random.default_rng((17, k))
            found, p = [0], 1.0
            while p < ends:
                p = np.floor(p / max(rng.random(), 1e-12)) + 1
                found.append(int(p) - 1)
            self.records[k] = found
        return [np.array(r, np.int64) for r in self.records]

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Samples of each text, one row of bytes a text."""
        out = np.zeros((len(texts), SAMPLES), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        if not sizes.sum():
            return out
        points = code_points("".join(texts)) * np.uint32(2654435761)
        classes = (1 + (points >> np.uint32(7)) % np.uint32(255)).astype(np.uint8)
        del points
        parts = -(-sizes // SEGMENT)
        doc = np.repeat(np.arange(len(texts)), parts)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.repeat(np.cumsum(sizes) - sizes, parts) + nth * SEGMENT
        length = np.minimum(SEGMENT, np.repeat(np.cumsum(sizes), parts) - begin)
        flat = np.zeros(len(classes) + len(doc), np.uint8)
        flat[np.arange(len(classes)) + np.repeat(np.arange(len(doc)), length)] = classes
        order = np.argsort(-length, kind="stable")
        pos = (begin + np.arange(len(doc)))[order]
        stop = pos + length[order]
        rows = [np.flatnonzero(nth[order] == s) for s in range(int(nth.max()) + 1)]
        positions = self.positions((int(nth.max()) + 1) * STEPS)
        wanted: dict[int, list[tuple[int, int]]] = {}
        taken: dict[int, np.ndarray] = {}
        for p in np.unique(np.concatenate(positions)).tolist():
            if p < len(rows) * STEPS:
                wanted.setdefault(p % STEPS, []).append((p // STEPS, p))
        mark, ended = np.zeros(len(doc), np.uint64), np.full(len(doc), STEPS, np.int64)
        alive, shift = len(doc), np.uint64(4)
        for step in range(STEPS):
            if step % ROUND == 0:
                # walks are in order of length, so they end nearly in order; what lies between waits
                over = np.flatnonzero((pos[:alive] >= stop[:alive]) & (ended[:alive] == STEPS))
                ended[over] = step
                still = np.flatnonzero(ended[:alive] == STEPS)
                alive = int(still[-1]) + 1 if len(still) else 0
                if not alive:
                    break
                # these must move at every step of the round to be sure of reaching their end
                late = np.flatnonzero(stop[:alive] - pos[:alive] > STEPS - step - 2 * ROUND)
            here = flat.take(pos[:alive])
            mark[:alive] <<= shift
            mark[:alive] += self.marks.take(here)
            move = self.moves[step].take(here)
            if len(late):
                move[late] = here[late] > 0
            pos[:alive] += move
            for s, p in wanted.get(step, ()):
                own = rows[s][:np.searchsorted(rows[s], alive)]
                value = np.zeros(len(texts), np.uint8)
                value[doc[order[own]]] = (mark[own] * np.uint64(0x9E3779B97F4A7C15)
                                          >> np.uint64(56)).astype(np.uint8)
                taken[p] = value
        last = np.zeros(len(texts), np.int64)  # of whole segments the steps, and those of the last
        back = np.empty(len(doc), np.int64)
        back[order] = np.minimum(ended, STEPS)
        some = parts > 0
        last[some] = ((parts[some] - 1) * STEPS + back[np.cumsum(parts)[some] - 1])
        first = np.cumsum(parts) - parts
        for k, record in enumerate(positions):
            at = np.searchsorted(record, last, side="left") - 1
            for r in range(int(at.max()), -1, -1):
                mine = np.flatnonzero(some & (at == r))
                s, step = divmod(int(record[r]), STEPS)
                alive = back[first[mine] + s] > step
                at[mine[~alive]] = r - 1
                mine = mine[alive]
                if len(mine):
                    out[mine, k] = taken[int(record[r])][mine]
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, 0 for what chance gives and 1 for all."""
    share = (a == b).mean(axis=-1)
    return np.clip((share - 1 / 256) / (1 - 1 / 256), 0, 1)


def in_blocks(docs: DataFrame) -> DataFrame:
    """(block, guest, doc_id, packed): ranges of ids, each with the first row of the next as a guest;
    packed is the text, compressed.

    Bounds are quantiles of the ids, as many as there are shuffle partitions, so texts are shuffled
    once and every row meets its successor in one task. After the last range comes the first.
    """
    spark = docs.sparkSession
    own = documents(docs).withColumn("_id", F.col("doc_id").cast("double"))
    many = int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    bounds = np.unique(np.array(own.approxQuantile(
        "_id", [k / many for k in range(1, many)], 0.2 / many), np.float64))

    @F.pandas_udf("int")
    def block_of(ids: pd.Series) -> pd.Series:  # null ids come first
        return pd.Series(np.searchsorted(
            bounds, ids.fillna(-np.inf).to_numpy(np.float64), side="right").astype(np.int32))

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:  # about half of what the shuffle makes of them
        press = zstandard.ZstdCompressor(level=3).compress
        return texts.map(lambda t: press(t.encode("utf-8", "surrogatepass")))

    placed = own.withColumn("block", block_of("_id"))
    firsts = {r["block"]: r["first"] for r in placed.groupBy("block").agg(
        F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("first")).collect()}
    blocks = sorted(firsts)
    before = {b: blocks[k - 1] for k, b in enumerate(blocks)}
    table = F.create_map(*[F.lit(x) for b in blocks for x in (b, before[b])]) if blocks else None
    if table is None:
        return own.select(F.lit(0).alias("block"), F.lit(False).alias("guest"), "doc_id",
                          packed("text").alias("packed"))
    ids = [r[1] for r in firsts.values() if r[1] is not None]
    null = any(r[1] is None for r in firsts.values())
    first = F.coalesce(F.col("doc_id").isin(ids), F.lit(null))
    spots = F.when(F.col("_first"), F.array(
        F.struct(F.col("block"), F.lit(False).alias("guest")),
        F.struct(F.element_at(table, F.col("block")).alias("block"), F.lit(True).alias("guest")),
    )).otherwise(F.array(F.struct(F.col("block"), F.lit(False).alias("guest"))))
    return (placed.select("doc_id", "block", F.xxhash64("text").alias("_hash"),
                          packed("text").alias("packed"), first.alias("_first"))
            .select("doc_id", "_hash", "packed", F.explode(spots).alias("_at"))
            .select("_at.block", "_at.guest", "doc_id", "_hash", "packed")
            .repartition("block")
            .sortWithinPartitions("block", "guest", F.asc_nulls_first("doc_id"), "_hash")
            .drop("_hash"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row's text and edited text, and their likeness to it and to the next.

    The edited text has its last quarter replaced by as much of the start of the next row's text, in
    ascending order of doc_id (nulls first, rows of one id by a hash of the text), the first row
    following the last.
    """
    id_type = dict(docs.dtypes)["doc_id"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embed, unpack = Embedding(), zstandard.ZstdDecompressor().decompress
        waiting = None  # the last row so far, whose successor is to come
        for batch in batches:
            rows = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
            waiting = rows.iloc[[-1]]
            texts = [unpack(x).decode("utf-8", "surrogatepass") for x in rows["packed"]]
            guest = rows["guest"].tolist()
            block = rows["block"].to_numpy()
            host = [k for k in range(len(rows) - 1) if not guest[k]]
            if any(block[k] != block[k + 1] for k in host):
                raise ValueError("a range of ids without the row that follows it")
            for part in slices([texts[k] for k in host], WALKED):
                own = host[part]
                following = [k + 1 for k in own]
                need = sorted({*own, *following})
                at = {k: n for n, k in enumerate(need)}
                edited = []
                for k in own:
                    cut = len(texts[k]) // 4
                    edited.append(texts[k][:len(texts[k]) - cut] + texts[k + 1][:cut])
                prints = embed([texts[k] for k in need] + edited)
                mine, other = (prints[[at[k] for k in ks]] for ks in (own, following))
                changed = prints[len(need):]
                yield pd.DataFrame({
                    "doc_id": rows["doc_id"].to_numpy()[own],
                    "n_chars": [len(texts[k]) for k in own],
                    "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest()
                                      for t in edited],
                    "fingerprint": [p.tobytes() for p in mine],
                    "edited_fingerprint": [p.tobytes() for p in changed],
                    "near_edited": likeness(mine, changed), "near_next": likeness(mine, other)})

    return in_blocks(docs).mapInPandas(
        work, f"doc_id {id_type}, n_chars long, edited_sha256 binary, fingerprint binary, "
              "edited_fingerprint binary, near_edited double, near_next double")


def agreement(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, as ``likeness`` has it."""
    same = F.size(F.filter(F.sequence(F.lit(1), F.lit(SAMPLES)),
                           lambda k: F.substring(a, k, F.lit(1)) == F.substring(b, k, F.lit(1))))
    return F.greatest(F.lit(0.0), (same / SAMPLES - 1 / 256) / (1 - 1 / 256))


def least_equal(least: float) -> int:
    """The number of equal samples from which on two fingerprints have a likeness of ``least``."""
    if not 0 < least <= 1:
        raise ValueError("the least likeness must be above 0 and at most 1")
    return next(k for k in range(SAMPLES + 1) if (k / SAMPLES - 1 / 256) / (1 - 1 / 256) >= least)


def _other_links(met: DataFrame, rooted: DataFrame, nodes: DataFrame, equal: int) -> DataFrame:
    """Links (a, b) between classes: members of a bucket that are not in the class of its first one
    are compared with all of it. ``rooted`` has the class (root) of nodes that are not alone."""
    def root(n: str) -> DataFrame:
        return rooted.select(F.col("node").alias(n), F.col("root").alias(f"_{n}"))

    seats = stored(met.where(F.col("members") > 2).join(root("node"), "node", "left")
                   .join(root("head"), "head", "left")
                   .select("bucket", "node", "members", F.coalesce("_node", "node").alias("root"),
                           (F.coalesce("_node", "node") != F.coalesce("_head", "head")).alias("asks")))
    many = seats.where("asks").groupBy("bucket").agg(F.count(F.lit(1)).alias("loose"))

    def block(n: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.ceil(F.col(n) / BLOCK)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.ceil(F.col(n) / BLOCK).cast("int") - 1))

    opened = seats.join(many, "bucket")
    asked = opened.where("asks").select("bucket", "node", "root", block("loose").alias("i"),
                                        every("members").alias("j"), "asks")
    others = opened.select("bucket", "node", "root", every("loose").alias("i"),
                           block("members").alias("j"), F.lit(False).alias("asks"))
    spread = (asked.unionByName(others).join(nodes.select("node", "fingerprint"), "node")
              .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j"))
    id_type = dict(nodes.dtypes)["node"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for keys, roots, asks, prints in _runs(batches):
            cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            found = [np.empty((0, 2), roots.dtype)]
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                own, other = a + np.flatnonzero(asks[a:b]), a + np.flatnonzero(~asks[a:b])
                same = np.zeros((len(own), len(other)), np.uint8)
                for k in range(SAMPLES):
                    same += prints[own, k][:, None] == prints[other, k][None, :]
                like = (same >= equal) & (roots[own][:, None] != roots[other][None, :])
                found.append(_stars(roots, own, other, like))
            edges = np.concatenate(found)
            yield pd.DataFrame({"a": edges[:, 0], "b": edges[:, 1]})

    return spread.mapInPandas(compare, f"a {id_type}, b {id_type}").distinct()


def _stars(roots: np.ndarray, own: np.ndarray, other: np.ndarray, like: np.ndarray) -> np.ndarray:
    """(class, least class it is joined to) of the classes that are joined by like pairs."""
    x, y = np.nonzero(like)
    names, at = np.unique(np.concatenate([roots[own[x]], roots[other[y]]]), return_inverse=True)
    x, y = at[:len(x)], at[len(x):]
    least = np.arange(len(names))
    while True:
        best = least.copy()
        np.minimum.at(best, x, least[y])
        np.minimum.at(best, y, best[x])
        if (best == least).all():
            break
        least = best
    joined = least != np.arange(len(names))
    return np.stack([names[joined], names[least[joined]]], axis=1)


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, ...]]:
    """(keys, roots, asks, prints) of whole runs of rows with equal (bucket, i, j), some at a time."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[["bucket", "i", "j"]].to_numpy(np.int64)
        prints = np.frombuffer(b"".join(batch["fingerprint"]), np.uint8).reshape(-1, SAMPLES)
        rows = (keys, batch["root"].to_numpy(), batch["asks"].to_numpy(bool), prints)
        other = np.flatnonzero(np.any(keys != keys[-1], axis=1))
        cut = int(other[-1]) + 1 if len(other) else 0  # the last run may go on
        if not cut and held and (held[-1][0][-1] != keys[0]).any():
            yield tuple(np.concatenate(c) for c in zip(*held))
            held = []
        if cut:
            held.append(tuple(c[:cut] for c in rows))
            yield tuple(np.concatenate(c) for c in zip(*held))
            held = []
        held.append(tuple(c[cut:] for c in rows))
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def near_copies(found: DataFrame, least: float = LIKENESS) -> DataFrame:
    """(fingerprint, class_id) of the fingerprints that are not alone in their class; class_id is the
    least doc_id of the class. Fingerprints of a likeness of ``least`` or more are in one class."""
    nodes = stored(found.where(F.col("doc_id").isNotNull()).groupBy("fingerprint").agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("rows")))
    equal = least_equal(least)
    many = SAMPLES - equal + 1
    edges = [k * SAMPLES // many for k in range(many + 1)]
    bands = nodes.select("node", F.explode(F.array(*[
        F.xxhash64(F.lit(k), F.substring("fingerprint", a + 1, b - a))
        for k, (a, b) in enumerate(zip(edges, edges[1:]))])).alias("bucket"))
    heads = bands.groupBy("bucket").agg(
        F.min("node").alias("head"), F.count(F.lit(1)).alias("members")).where("members > 1")
    met = stored(bands.join(heads, "bucket"))
    pairs = stored(met.where(F.col("node") != F.col("head")).select("node", "head").distinct())
    own, first = (nodes.select(F.col("node").alias(n), F.col("fingerprint").alias(f"_{n}"))
                  for n in ("node", "head"))
    links = (pairs.join(own, "node").join(first, "head")
             .where(agreement(F.col("_node"), F.col("_head")) >= least)
             .select(F.col("node").alias("a"), F.col("head").alias("b")))
    rooted = stored(components(links))
    joined = components(_other_links(met, rooted, nodes, equal))
    stars = rooted.unionByName(joined.join(rooted.select("node"), "node", "left_anti"))
    classes = stars.join(joined.select(F.col("node").alias("root"), F.col("root").alias("_root")),
                         "root", "left").select("node", F.coalesce("_root", "root").alias("root"))
    return nodes.join(classes, "node", "left").where(
        F.col("root").isNotNull() | (F.col("rows") > 1)).select(
        "fingerprint", F.coalesce("root", "node").alias("class_id"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``fingerprint_documents`` in hexadecimal, with the class of near copies of every row: the
    least doc_id in it (null without id)."""
    found = stored(fingerprint_documents(docs))
    classes = stored(near_copies(found))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    names = ("edited_sha256", "fingerprint", "edited_fingerprint")
    return found.join(classes, "fingerprint", "left").select(
        *[F.lower(F.hex(n)).alias(n) if n in names else F.col(n) for n in found.columns],
        own.alias("class_id"))
