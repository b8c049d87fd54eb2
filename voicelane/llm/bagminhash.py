"""Near duplicates by BagMinHash signatures of word shingles.

A text is the multiset of its word 5-shingles. For a shingle of weight w, points of
Poisson processes fall on the strip (0, w]. The strip is discretised in bands that
double in width, (0, 1], (1, 2], (2, 4] and so on; each band has a process of its own,
seeded by shingle and band, whose points carry a time, a place in the band and a
register. A band that w cuts keeps the points below w, so texts with different
weights see the same points as far as both reach. The earliest point of each register
is the signature: two registers agree with the probability of the weighted Jaccard
similarity. Points are made in order of time and only up to the time at which all
registers are likely filled, which makes the work nearly linear in the text.

Texts with equal words are one class from the start. Signatures are banded; what
meets in a band is compared by the exact overlap of multisets, and links become
classes. Every member of a bucket is compared with the member that shares most buckets
with others (the centre of the group) first. Where a bucket still holds several classes,
its members are compared with their neighbour in that order, and in small buckets pair by
pair, as far as they are of different classes. Members of large buckets that still hold
several classes are then joined by prefixes: of two texts similar enough, the rarest
shingles of the smaller one and the rarest of the larger one meet, so only texts that
share a rare shingle are compared, whatever else their template puts into both. Classes
that meet there compare their centres, then all their members; in the end each pair that
meets is compared or in one class.

Null and empty texts are classes of their own; a text of one to four words is one
shingle. Rows that repeat an id count as one document (the smallest text hash) and
share its class; a null id has a null class. Extra columns are ignored by ``classes``
and kept by ``dedupe``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voicelane.llm.common import (
    WordHashes, components, folded_words, joined_components, opened, record_batch, sealed, slices, small_batches,
    staged, within, without,
)
from voicelane.llm.shingles import mixed, shingle_hashes, word_hashes


@dataclass(frozen=True)
class Settings:
    similarity: float = 0.8
    bands: int = 16
    rows: int = 4
    #: Buckets up to this size are compared pair by pair.
    small: int = 16

    @property
    def registers(self) -> int:
        return self.bands * self.rows


DEFAULT = Settings()


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """BagMinHash signatures (n_docs x m) of weighted elements; 0 rows for empty texts.

    ``doc`` numbers the text of each entry, ``weight`` is at least 1.
    """
    result = np.zeros((n_docs, m), np.uint64)
    total = np.bincount(doc, weight, n_docs)
    todo = total > 0
    until = np.where(todo, (np.log(m) + 4) / np.maximum(total, 1e-300), 0)
    n_bands = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    source = np.repeat(np.arange(len(doc)), n_bands)
    band = np.arange(len(source)) - np.repeat(np.cumsum(n_bands) - n_bands, n_bands)
    low = np.where(band > 0, 2.0 ** (band - 1), 0)
    width = np.where(band > 0, low, 1.0)
    seed = mixed(element[source] ^ mixed(band.astype(np.uint64) + np.uint64(1)))
    while todo.any():
        use = np.flatnonzero(todo[doc[source]])
        own, key, time = doc[source[use]], seed[use], np.zeros(len(use))
        at, span, cut = low[use], width[use], weight[source[use]]
        found, step = [], 0
        while len(own):
            draw = mixed(key + np.uint64(4 * step + 1))
            time = time - np.log(_uniform(draw)) / (m * span)
            live = time <= until[own]
            own, key, time = own[live], key[live], time[live]
            at, span, cut = at[live], span[live], cut[live]
            inside = at + _uniform(mixed(key + np.uint64(4 * step + 2))) * span <= cut
            place = mixed(key + np.uint64(4 * step + 3))
            register = (place % np.uint64(m)).astype(np.int64)
            found.append((own[inside] * m + register[inside], time[inside], mixed(place[inside])))
            step += 1
        cell, when, point = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((when, cell))
        cell, point = cell[order], point[order]
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        filled = np.bincount(cell[first] // m, minlength=n_docs) == m
        take = first[filled[cell[first] // m]]
        result.reshape(-1)[cell[take]] = point[take]
        todo &= ~filled
        until = np.where(todo, until * 2, 0)
    return result


def bag(texts: list[str | None], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle and weight of every distinct shingle of every text."""
    each = [shingle_hashes(word_hashes(t, hashes)) for t in texts]
    doc = np.repeat(np.arange(len(each)), [len(s) for s in each])
    every = np.concatenate([*each, np.empty(0, np.uint64)])
    order = np.lexsort((every, doc))
    doc, every = doc[order], every[order]
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (every[1:] != every[:-1]))) if len(doc) else np.empty(0, bool)
    first = np.flatnonzero(new)
    weight = np.diff(np.concatenate((first, [len(doc)])))
    return doc[first], every[first], weight


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band (rows are texts)."""
    parts = signature.reshape(len(signature), bands, -1)
    keys = np.zeros(parts.shape[:2], np.uint64)
    for k in range(parts.shape[2]):
        keys = mixed(keys + parts[:, :, k])
    return mixed(keys + np.arange(1, bands + 1, dtype=np.uint64))


def _sign(settings: Settings, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for part in slices(batches):
        texts = part.column("text").to_pylist()
        doc, element, weight = bag(texts, hashes)
        sign = signatures(doc, element, weight, len(texts), settings.registers)
        has_words = np.bincount(doc, minlength=len(texts)) > 0
        keys = band_keys(sign, settings.bands).view(np.int64)
        digests = [xxhash.xxh3_128_digest(b" ".join(folded_words(t))) for t in texts]
        bands = [list(k) if w else None for k, w in zip(keys, has_words, strict=True)]
        yield record_batch(
            [part.column("doc_id"), digests, bands], ["doc_id", "digest", "bands"],
            [pa.int64(), pa.binary(), pa.list_(pa.int64())],
        )


def sign(docs: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """doc_id, digest of the words, bands (keys of the banded signature; null without words)."""
    rows = small_batches(docs).select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(
        functools.partial(_sign, settings), "doc_id bigint, digest binary, bands array<bigint>"
    )


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for part in slices(batches):
        bags = [
            np.sort(shingle_hashes(word_hashes(t, hashes))).tobytes()
            for t in part.column("text").to_pylist()
        ]
        yield record_batch([part.column("doc_id"), bags], ["doc_id", "bag"], [pa.int64(), pa.binary()])


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted multisets."""
    if not len(a) or not len(b):
        return 0.0
    x, n = np.unique(a, return_counts=True)
    y, k = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    shared = int(np.minimum(n[i], k[j]).sum())
    return shared / (len(a) + len(b) - shared)


def _verify(similarity: float, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        same = [
            overlap(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))
            for a, b in zip(pdf["bag_a"], pdf["bag_b"], strict=True)
        ]
        out = pdf[["a", "b"]].assign(similarity=same)
        yield out[out["similarity"] >= similarity]


def verify(pairs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose multisets overlap enough."""
    met = pairs.join(bags.select(F.col("doc_id").alias("b"), F.col("bag").alias("bag_b")), "b")
    met = met.join(bags.select(F.col("doc_id").alias("a"), F.col("bag").alias("bag_a")), "a")
    return met.mapInPandas(
        functools.partial(_verify, similarity), "a bigint, b bigint, similarity double"
    )


def _ordered(a, b):
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def star_pairs(members: DataFrame) -> DataFrame:
    """Each member (key, doc, weight) of a bucket with the centre of the bucket, once."""
    centres = members.groupBy("key").agg(F.min_by("doc", F.struct(-F.col("weight"), "doc")).alias("other"))
    pairs = members.join(centres, "key").filter("doc <> other")
    return pairs.select(*_ordered("doc", "other")).distinct()


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are not of one class yet (roots: node, root)."""
    for side in ("a", "b"):
        own = roots.select(F.col("node").alias(side), F.col("root").alias(f"_{side}"))
        pairs = pairs.join(own, side, "left")
    differ = F.coalesce("_a", "a") != F.coalesce("_b", "b")
    return pairs.filter(differ).select("a", "b")


def bucket_pairs(members: DataFrame, small: int) -> DataFrame:
    """Pairs to compare among the members (key, doc, weight) of buckets."""
    order = W.partitionBy("key").orderBy(F.desc("weight"), "doc")
    seen = members.select(
        "key", "doc", F.first("doc").over(order).alias("centre"), F.lag("doc").over(order).alias("before"),
    )
    stars = seen.filter("before is not null").select(
        "doc", F.explode(F.array_distinct(F.array("centre", "before"))).alias("other")
    )
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") <= small)
    few = members.select("key", "doc").join(sizes.select("key"), "key", "left_semi")
    others = few.select("key", F.col("doc").alias("other"))
    pairs = few.join(others, "key").filter("doc < other").select("doc", "other")
    return stars.union(pairs).select(*_ordered("doc", "other")).distinct()


#: Slots of the sketch of frequencies that orders shingles (8 MB, whatever the texts).
SLOTS = 1 << 20
#: Probing texts of a rare shingle that meet the same indexed texts in one task.
BLOCK = 256
_TWIN = np.uint64(0xD6E8FEB86659FD93)


def numbered(bag: np.ndarray) -> np.ndarray:
    """A sorted multiset as a set: the k-th copy of a shingle is an element of its own."""
    first = np.searchsorted(bag, bag, "left")
    return mixed(bag + (np.arange(len(bag)) - first).astype(np.uint64) * _TWIN)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for bag in batch.column("bag").to_pylist():
            slots = numbered(np.frombuffer(bag, np.uint64)) % np.uint64(SLOTS)
            np.add.at(total, slots.astype(np.int64), 1)
    slots = np.flatnonzero(total)
    yield record_batch([slots, total[slots]], ["slot", "n"], [pa.int32(), pa.int64()])


def frequencies(bags: DataFrame) -> np.ndarray:
    """How often elements of each slot occur; an order of elements common to all texts."""
    rows = bags.select("bag").mapInArrow(_frequencies, "slot int, n bigint")
    found = rows.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most SLOTS rows
    total = np.zeros(SLOTS, np.int64)
    total[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return total


def prefix_sizes(n: int, similarity: float) -> tuple[int, int]:
    """Elements of a text of n that texts at least as large, and at most as large, must meet.

    Two sets of at least this similarity share ``similarity`` of the larger one and
    2s / (1 + s) of the smaller one at least; what is left over may all come first.
    """
    least = lambda share: int(np.ceil(share * n - 1e-9))
    return n - least(2 * similarity / (1 + similarity)) + 1, n - least(similarity) + 1


def _prefix(shared, similarity: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = shared.value
    for batch in batches:
        keys, docs, sizes, places, indexed = [], [], [], [], []
        for doc, bag in zip(batch.column("doc_id").to_pylist(), batch.column("bag").to_pylist(), strict=True):
            element = numbered(np.frombuffer(bag, np.uint64))
            order = np.lexsort((element, total[(element % np.uint64(SLOTS)).astype(np.int64)]))
            index, probe = prefix_sizes(len(element), similarity)
            keys.append(element[order[:probe]].view(np.int64))
            docs.append(np.full(probe, doc))
            sizes.append(np.full(probe, len(element)))
            places.append(np.arange(probe))
            indexed.append(np.arange(probe) < index)
        none = [np.empty(0, np.int64)]
        columns = [np.concatenate(c + none) for c in (keys, docs, sizes, places)]
        columns.append(np.concatenate([*indexed, np.empty(0, bool)]))
        yield record_batch(
            columns, ["key", "doc", "size", "place", "indexed"],
            [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()],
        )


def prefixes(bags: DataFrame, similarity: float) -> DataFrame:
    """key, doc, size, place, indexed: the rarest shingles of each text (doc_id, bag), in order."""
    shared = bags.sparkSession.sparkContext.broadcast(frequencies(bags))
    return bags.select("doc_id", "bag").mapInArrow(
        functools.partial(_prefix, shared, similarity), "key bigint, doc bigint, size int, place int, indexed boolean"
    )


def _mixed(named: DataFrame) -> DataFrame:
    """Rows (key, doc, root, ...) of keys that hold several classes, and rows of the key."""
    several = named.groupBy("key").agg(
        F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most")
    ).filter("least < most").select("key", "n")
    return named.join(several, "key")


def centre_pairs(named: DataFrame, small: int) -> DataFrame:
    """Pairs among the centres (the smallest text) of the classes that meet at a key."""
    heads = _mixed(named).groupBy("key", "root").agg(F.min(F.struct("size", "doc")).alias("head"))
    return bucket_pairs(heads.select("key", "head.doc", (-F.col("head.size")).alias("weight")), small)


def class_pairs(named: DataFrame, similarity: float) -> DataFrame:
    """Pairs of texts of different classes that meet at a key and whose sizes allow a link.

    A smaller text meets by its first, rarest shingles only. Where a pair meets first,
    all that it shares comes at that place or later in both, so places too far back don't
    count. Probing texts of a key are dealt over blocks and each indexed text goes to all
    of them.
    """
    met = _mixed(named).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int").alias("block")
    probing = met.select("key", own, "doc", "root", "size", "place")
    indexed = met.filter("indexed").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.col("doc").alias("other"), F.col("root").alias("other_root"), F.col("size").alias("other_size"),
        F.col("place").alias("other_place"),
    )
    allowed = (F.col("root") != F.col("other_root")) & (F.col("other_size") >= F.col("size") * similarity - 1e-6)
    both = (F.col("size") + F.col("other_size")) * (similarity / (1 + similarity)) - 1e-6
    allowed &= F.least(F.col("size") - F.col("place"), F.col("other_size") - F.col("other_place")) >= both
    smaller = F.struct("other_size", "other") < F.struct(F.col("size").alias("other_size"), F.col("doc").alias("other"))
    pairs = probing.join(indexed, ["key", "block"]).filter(allowed & smaller)
    return pairs.select(*_ordered("doc", "other")).distinct()


def _named(members: DataFrame, roots: DataFrame) -> DataFrame:
    named = members.join(roots.withColumnRenamed("node", "doc"), "doc", "left")
    return named.withColumn("root", F.coalesce("root", "doc"))


def classes(docs: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """doc_id, class_id: the smallest id of the near duplicates of each document row."""
    signed = staged(sign(docs, settings), "signed")
    one = signed.filter("doc_id is not null and bands is not null").groupBy("doc_id").agg(
        F.min(F.struct("digest", "bands")).alias("s")
    ).select("doc_id", "s.*")
    copies = staged(
        one.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "copies"
    )
    buckets = copies.select(F.col("rep").alias("doc"), F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = staged(buckets.join(shared, "key"), "buckets")
    weight = members.groupBy("doc").agg(F.sum("n").alias("weight"))
    members = staged(members.drop("n").join(weight, "doc"), "members")
    wanted = members.select(F.col("doc").alias("doc_id")).distinct()
    texts = within(docs.select(F.col("doc_id").cast("bigint"), "text"), staged(wanted, "wanted"))
    bags = texts.mapInArrow(_bags, "doc_id bigint, bag binary").groupBy("doc_id").agg(F.min("bag").alias("bag"))
    bags = staged(bags, "bags")

    tested = staged(star_pairs(members), "pairs")
    links = staged(verify(tested, bags, settings.similarity), "links")
    roots = components(links, "near")
    # What the centres leave apart in a bucket; members of one class need no other link.
    mixed_buckets = _mixed(_named(members, roots)).select("key", "doc", "weight")
    rest = apart(bucket_pairs(mixed_buckets, settings.small), roots).join(tested, ["a", "b"], "left_anti")
    rest = staged(rest, "pairs")
    found = staged(verify(rest, bags, settings.similarity), "links")
    tested = tested.union(rest)
    if found.limit(1).count():
        roots = joined_components(roots, found, "near")
    large = members.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > settings.small)
    crowd = _mixed(_named(members.join(large.select("key"), "key", "left_semi"), roots))
    crowd = staged(crowd.select(F.col("doc").alias("doc_id")).distinct(), "crowd")
    near = staged(prefixes(bags.join(crowd, "doc_id", "left_semi"), settings.similarity), "prefixes")
    # Most of the rarest shingles are in one text only.
    met = near.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    near = staged(near.join(met, "key", "left_semi"), "prefixes")
    # Rare shingles that several classes hold: the centres of the classes first, then all.
    pairs = staged(centre_pairs(_named(near, roots), settings.small).join(tested, ["a", "b"], "left_anti"), "pairs")
    found = staged(verify(pairs, bags, settings.similarity), "links")
    tested = tested.union(pairs)
    if found.limit(1).count():
        roots = joined_components(roots, found, "near")
    pairs = class_pairs(_named(near, roots), settings.similarity)
    pairs = staged(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
    found = staged(verify(pairs, bags, settings.similarity), "links")
    if found.limit(1).count():
        roots = joined_components(roots, found, "near")
    by_copy = copies.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("root", "rep").alias("class_id")
    )
    known = one.select("doc_id", "digest").join(by_copy, "digest").select(
        F.col("doc_id").alias("_id"), "class_id"
    )
    return signed.select("doc_id").join(known, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id")
    )


def dedupe(docs: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One document of each class (the one with the smallest id), with all columns."""
    rows = sealed(docs, "doc_id", "text")
    extra = classes(rows, settings).filter("doc_id <> class_id").select("doc_id").distinct()
    return opened(without(rows, staged(extra, "copies")), docs, "doc_id", "text")
