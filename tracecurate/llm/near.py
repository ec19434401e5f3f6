"""MinHash near-duplicates by an inverted join of signature coordinates.

Every document is posted under its (coordinate, value) pairs. Two documents as similar as
the threshold agree in so many coordinates, but for a stated chance, that they must share
one of the rarest few pairs of each: only these prefixes are merged. The long lists that were
skipped are not read; the coordinates of a candidate pair are counted directly instead. Pairs
with enough of them are confirmed on their full shingle sets.

Documents with equal sets are one class from the start. In a posting list, members are first
compared with one of them; only what is then still in different components is compared
further. So a large group of near copies is linked without its square of pairs. Before a pair
is formed, bitmaps of the two sets must allow it: they hold for each of 1,024 bins whether
the set has an odd number of shingles there, so as many bins differ as shingles at most, and
no pair that reaches the threshold is turned away.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import byte_texts, narrow, seeds, shingle_hashes, stored, word_hashes
from .components import components

COORDINATES = 64
MISS = 2e-7  # chance that a pair right at the threshold shows too few equal coordinates

_FACTORS = seeds(COORDINATES, 5000) | np.uint64(1)
_OFFSETS = seeds(COORDINATES, 6000)
BINS = 1024
BUCKETS = 1 << 20
_AT_ONCE = 1 << 14  # shingles whose coordinates are held at once


def least_matches(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The most equal coordinates that a pair at the threshold has but for the chance ``miss``."""
    p, below, t = percent / 100, 0.0, 0
    while t < coordinates:
        below += comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > miss:
            break
        t += 1
    return max(t, 1)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The sorted distinct shingles of a text, as hashes; ASCII capitals count as small letters."""
    return shingle_hashes(word_hashes(text.lower()), words)


def signature(shingles: np.ndarray) -> np.ndarray:
    """For each coordinate the least value of its hash over the set."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), _AT_ONCE):
        part = shingles[None, start : start + _AT_ONCE] * _FACTORS[:, None] + _OFFSETS[:, None]
        part ^= part >> np.uint64(29)
        part *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """For each bin whether it holds an odd number of the set's shingles, in 64-bit words."""
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % BINS, minlength=BINS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, digest, coordinates, bits); the last three are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, coordinates, bits = [], [], [], []
            for text in byte_texts(batch.column(1)):
                shingles = shingle_set(text, words)
                sizes.append(len(shingles))
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                coordinates.append(signature(shingles) if len(shingles) else None)
                bits.append(bitmap(shingles) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(coordinates, pa.list_(pa.int32())),
                    pa.array(bits, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "digest", "coordinates", "bits"],
            )

    rows = narrow(docs, doc_id=id_col, text=text_col)
    return rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, coordinates array<int>, bits array<bigint>")


def _prefixes(classes: DataFrame, matches: int, percent: int) -> DataFrame:
    """(id, common, prefix): the rarest pairs of each class, as many as a partner cannot
    avoid; ``common`` says how widespread all its pairs are.

    The nearest other set of one of n shingles has one more: n of n + 1 are shared. Sets that
    are too small for that have no partner but equal ones, their class, and are not posted.

    Pairs that one class alone has come first in that order and can have no partner, so they
    only use up places.
    """
    posted = classes.where(100 * F.col("n_shingles") >= percent * (F.col("n_shingles") + 1))
    pairs = posted.select("id", F.posexplode("coordinates").alias("k", "value")).select(
        "id", ((F.col("k").cast("bigint") * (1 << 32)) + F.col("value") + (1 << 31)).alias("pair")
    )
    shared = pairs.groupBy("pair").agg(F.count("*").alias("n")).where("n > 1").withColumnRenamed("pair", "_pair")
    kept = pairs.join(shared, F.col("pair") == F.col("_pair")).select("id", "n", "pair")
    listed = kept.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "pair"))).alias("rare"), F.sum(F.log("n")).alias("common"))
    places = COORDINATES - matches + 1
    # size(rare) - COORDINATES is minus the number of unshared pairs.
    length = F.greatest(F.lit(0), F.size("rare") - COORDINATES + places)
    return listed.select("id", "common", F.slice("rare", F.lit(1), length)["pair"].alias("prefix")).where("size(prefix) > 0")


def _may_reach(n_a: str, n_b: str, bits_a: str, bits_b: str, percent: int) -> Column:
    """Whether sizes and bitmaps allow the threshold, which bounds the difference of two sets:
    (100 + percent) * difference <= (100 - percent) * sum of sizes."""
    words = [F.bit_count(F.col(bits_a)[k].bitwiseXOR(F.col(bits_b)[k])) for k in range(BINS // 64)]
    sizes = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    return sizes & ((100 + percent) * sum(words[1:], words[0]) <= (100 - percent) * (F.col(n_a) + F.col(n_b)))


def _similar_enough(pairs: DataFrame, classes: DataFrame, matches: int, percent: int) -> DataFrame:
    """(a, b) pairs whose sizes, bitmaps and equal coordinates allow the threshold."""

    def side(name: str) -> DataFrame:
        names = {"id": f"_{name}", "n_shingles": f"n_{name}", "coordinates": f"c_{name}", "bits": f"bits_{name}"}
        return classes.select(*[F.col(old).alias(new) for old, new in names.items()])

    joined = pairs.join(side("a"), F.col("a") == F.col("_a")).join(side("b"), F.col("b") == F.col("_b"))
    equal = F.size(F.filter(F.zip_with("c_a", "c_b", lambda x, y: x == y), lambda x: x))
    return joined.where(_may_reach("n_a", "n_b", "bits_a", "bits_b", percent)).where(equal >= matches).select("a", "b")


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) pairs that reach the threshold on their full sets. The text of ``b`` goes to
    ``a``; each side may hold a hot id, and each join can be split."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            kept = []
            for k, (text_a, text_b) in enumerate(zip(byte_texts(batch.column(2)), byte_texts(batch.column(3)), strict=True)):
                if own is None or text_a != last:  # rows of one id stand together
                    last, own = text_a, shingle_set(text_a, words)
                other = shingle_set(text_b, words)
                both = len(np.intersect1d(own, other, assume_unique=True))
                if both and 100 * both >= percent * (len(own) + len(other) - both):
                    kept.append(k)
            index = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(1).take(index)], ["a", "b"])

    far = texts.select(F.col("id").alias("_b"), F.col("text").alias("text_b"))
    near = texts.select(F.col("id").alias("_a"), F.col("text").alias("text_a"))
    both = pairs.join(far, F.col("b") == F.col("_b")).select("a", "b", "text_b").join(near, F.col("a") == F.col("_a"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of
    ``words``-word shingles; a text of fewer words is one shingle, and one without words has
    an empty set and is linked with nothing. ``component_id`` is the smallest id that a chain
    of links reaches. Rows of one id count as one document with the links of all of them.
    Rows without an id are linked with nothing, have a null component and are kept.
    """
    matches = least_matches(percent)
    rows = stored(signatures(docs, words, id_col, text_col), "signatures")
    linked = rows.where("digest is not null and doc_id is not null")
    firsts = stored(linked.groupBy("digest").agg(F.min("doc_id").alias("id")), "classes")
    classes = stored(
        linked.join(firsts.withColumnRenamed("digest", "_digest"), (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("id")))
        .select("id", "n_shingles", "digest", "coordinates", "bits")
        .dropDuplicates(["id", "digest"])
        .drop("digest"),
        "class-signatures",
    )
    prefixes = stored(_prefixes(classes, matches, percent), "prefixes")
    posted = prefixes.select("id", "common", F.explode("prefix").alias("pair"))

    # Star turn: every member of a list with the one of the most widespread pairs, which is
    # the least edited of a group of copies and mostly the same in all their lists.
    hub = F.max(F.struct("common", F.col("id").alias("hub"))).alias("most")
    hubs = posted.groupBy("pair").agg(hub, F.count("*").alias("n")).where("n > 1").select(F.col("pair").alias("_pair"), "most.hub")
    stars = posted.join(hubs, F.col("pair") == F.col("_pair")).where("id <> hub")
    pairs = stars.select(F.greatest("id", "hub").alias("b"), F.least("id", "hub").alias("a")).distinct()
    candidates = stored(_similar_enough(pairs, classes, matches, percent), "star-pairs")
    texts = narrow(docs, id=id_col, text=text_col)
    links = stored(_confirmed(candidates, _needed(texts, candidates), words, percent), "star-links")
    if not prefixes.isEmpty():
        apart = _unlinked(prefixes, components(links), classes, percent)
        rest = stored(_similar_enough(apart, classes, matches, percent).join(candidates, ["a", "b"], "left_anti"), "rest-pairs")
        links = links.unionByName(stored(_confirmed(rest, _needed(texts, rest), words, percent), "rest-links"))

    # Rows of one id whose texts are in different classes link these, too.
    same = linked.select("doc_id", "digest").join(firsts, "digest").where("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    doubled = linked.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y").select(F.col("doc_id").alias("_double"))
    links = links.unionByName(same.join(doubled, F.col("b") == F.col("_double"), "left_semi"))

    labels = components(links).select(F.col("id").alias("_id"), "component")
    named = firsts.join(labels, F.col("id") == F.col("_id"), "left").select(
        F.col("digest").alias("_digest"), F.coalesce("component", "id").alias("component")
    )
    out = rows.join(named, F.col("digest") == F.col("_digest"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def _needed(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The texts of the documents in ``pairs``, stored once for both sides."""
    ids = stored(pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id"))).distinct(), "candidate-ids")
    # Texts whose id is in no bucket of a wanted one stay where they are. There are BUCKETS
    # numbers at most, however many ids, so their broadcast is bounded; what is left is looked
    # up exactly.
    bucket = lambda name: F.pmod(F.xxhash64(name), F.lit(BUCKETS))
    buckets = F.broadcast(ids.select(bucket("_id").alias("_bucket")).distinct())
    some = texts.join(buckets, bucket("id") == F.col("_bucket"), "left_semi")
    return stored(some.join(ids, F.col("id") == F.col("_id"), "left_semi"), "candidate-texts")


def _unlinked(prefixes: DataFrame, labels: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b) pairs of a list that are in different components after the star turn and may
    reach the threshold.

    In each list one component is the main one, that of most members. Only the others meet
    the rest of the list; no pair inside a component is formed, and a pair that has several
    lists in common is formed in the one of the smallest key.
    """
    placed = prefixes.join(labels.select(F.col("id").alias("_id"), "component"), F.col("id") == F.col("_id"), "left").select(
        "id", F.coalesce("component", "id").alias("component"), "prefix"
    )
    named = placed.select("id", "component", F.explode("prefix").alias("pair"))
    sizes = named.groupBy("pair", "component").agg(F.count("*").alias("n"))
    mains = (
        sizes.groupBy("pair")
        .agg(F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("parts"))
        .where("parts > 1")
        .select(F.col("pair").alias("_pair"), F.col("most.component").alias("main"))
    )
    inside = (F.col("component") == F.col("main")).alias("inside")
    members = named.join(mains, F.col("pair") == F.col("_pair")).select("pair", "id", inside)
    facts = placed.join(classes.select(F.col("id").alias("_id"), "n_shingles", "bits"), F.col("id") == F.col("_id"))
    facts = facts.select(F.col("id").alias("_id"), "component", "prefix", "n_shingles", "bits")
    lists = stored(members.join(facts, F.col("id") == F.col("_id")).drop("_id"), "open-lists")

    def side(rows: DataFrame, name: str) -> DataFrame:
        names = {"id": name, "component": f"c{name}", "prefix": f"p{name}", "n_shingles": f"n{name}", "bits": f"b{name}"}
        return rows.select("pair", "inside", *[F.col(old).alias(new) for old, new in names.items()])

    left = side(lists.where("not inside"), "x").drop("inside")
    right = side(lists, "y").withColumnRenamed("pair", "_pair")
    first = F.array_min(F.array_intersect("px", "py")) == F.col("pair")
    apart = (F.col("cx") != F.col("cy")) & (F.col("inside") | (F.col("x") < F.col("y")))
    near = _may_reach("nx", "ny", "bx", "by", percent)
    both = left.join(right, (F.col("pair") == F.col("_pair")) & apart & near & first)
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document, that of the smallest id, of each group of near-duplicates.
    Of rows that share its id one is kept for each distinct row; rows without an id all stay."""
    ids = near_duplicates(docs, words, percent).where("doc_id is not null").groupBy("doc_id")
    marked = stored(ids.agg(F.min("kept").alias("kept"), F.count("*").alias("n")).where("not kept or n > 1"), "marked-ids")
    rows, same = docs.alias("_d"), F.col("_d.doc_id") == F.col("_g.doc_id")
    # Only rows of an id that occurs more than once move to be compared.
    once = rows.join(marked.alias("_g"), same, "left_anti")
    return once.unionByName(rows.join(marked.where("kept").alias("_g"), same, "left_semi").distinct())
