"""Benchmark decontamination with one Aho-Corasick automaton.

Every benchmark text becomes windows of consecutive words. One automaton over the
windows scans each whole document once; hits are traced back to words and to
character offsets of the original text.

A text of fewer words than a window, but not none, is one window. Null and empty
texts have no words: as documents they are clean, as items they are ignored.
Repeated rows are treated row by row; an item id that occurs twice counts once.
Extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voicelane.llm.common import (
    folded_words, opened, record_batch, sealed, slices, small_batches, staged, without, word_spans,
)

WINDOW = 10
#: Pattern characters of one automaton. A benchmark beyond it is scanned in blocks,
#: so what a task holds stays bounded however large the benchmark grows.
BLOCK_CHARS = 8_000_000

_RUN = "array<struct<start:int,stop:int>>"
SCHEMA = f"doc_id bigint, n_words bigint, n_hit bigint, items array<bigint>, spans {_RUN}"
CARRIED = f"doc_id bigint, text string, items array<bigint>, runs {_RUN}"


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """phrase, item_ids: each distinct window of words and the items that contain it."""
    folded = F.regexp_replace(
        F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ",
    )
    words = F.filter(F.split(folded, " "), lambda w: w != "")
    last = F.greatest(F.size("words") - window, F.lit(0))
    return (
        benchmark.select("item_id", words.alias("words"))
        .filter("size(words) > 0 and item_id is not null")
        .select("item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
        .select(
            "item_id",
            F.array_join(F.slice("words", F.col("at") + 1, window), " ").alias("phrase"),
        )
        .groupBy("phrase")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    )


class Scanner:
    """The automaton of one block of phrases."""

    def __init__(self, phrases: list[tuple[str, list[int]]]):
        self.items = [ids for _, ids in phrases]
        self.auto = ahocorasick.Automaton()
        for k, (phrase, _) in enumerate(phrases):
            self.auto.add_word(f" {phrase} ", (k, phrase.count(" ") + 1))
        self.auto.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[set[int], np.ndarray]:
        """Items with a window in these words, and the places (start, stop) of windows."""
        if not self.items:  # an automaton without words can't be searched
            return set(), np.empty((0, 2), np.int64)
        joined = " " + b" ".join(words).decode("utf-8", "surrogatepass") + " "
        found = list(self.auto.iter(joined))
        if not found:
            return set(), np.empty((0, 2), np.int64)
        # Blanks before a place tell the number of the word that ends there.
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        stops = np.searchsorted(np.flatnonzero(points == 32), [end for end, _ in found])
        places = np.array([(s - n, s) for s, (_, (_, n)) in zip(stops, found, strict=True)])
        return {i for _, (k, _) in found for i in self.items[k]}, places


def _runs(places: np.ndarray, n_words: int) -> list[tuple[int, int]]:
    """Maximal runs of words that some place covers."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, places[:, 0], 1)
    np.add.at(edge, places[:, 1], -1)
    hit = np.concatenate(([0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]))
    return list(zip(np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1), strict=True))


_RUNS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
_ITEMS = pa.list_(pa.int64())


def _scan_batches(block, last: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner(block.value)
    show = lambda runs: [{"start": int(a), "stop": int(b)} for a, b in runs]
    for part in slices(batches):
        counts, hits, items_of, runs_of = [], [], [], []
        texts = part.column("text").to_pylist()
        before = zip(part.column("items").to_pylist(), part.column("runs").to_pylist(), strict=True)
        for text, (items, runs) in zip(texts, before, strict=True):
            words = folded_words(text)
            runs = [(r["start"], r["stop"]) for r in runs]
            more, places = scanner.scan(words) if words else (set(), None)
            if more:
                runs = _runs(np.concatenate((places, np.array(runs, np.int64).reshape(-1, 2))), len(words))
            counts.append(len(words))
            hits.append(sum(int(b - a) for a, b in runs))
            items_of.append(sorted({*items, *more}))
            if last and runs:
                starts, stops = word_spans(text)
                runs = [(starts[a], stops[b - 1]) for a, b in runs]
            runs_of.append(show(runs))
        ids = part.column("doc_id")
        if last:
            yield record_batch(
                [ids, counts, hits, items_of, runs_of], ["doc_id", "n_words", "n_hit", "items", "spans"],
                [pa.int64(), pa.int64(), pa.int64(), _ITEMS, _RUNS],
            )
        else:
            yield record_batch(
                [ids, part.column("text"), items_of, runs_of], ["doc_id", "text", "items", "runs"],
                [pa.int64(), pa.string(), _ITEMS, _RUNS],
            )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Per document row: words, hit words, matched item ids and hit spans of the text.

    The windows are split into blocks of about ``block_chars`` characters. A benchmark
    that fits one block, the usual case, needs one scan and no shuffle of documents.
    Beyond that the documents pass one block after the other, with what was found so
    far beside them, so a task never holds more than one block.
    """
    phrases = staged(item_windows(benchmark, window), "windows")
    total = phrases.agg(F.sum(F.length("phrase") + 2).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_chars))
    rows = small_batches(docs).select(
        F.col("doc_id").cast("bigint"), "text",
        F.array().cast("array<bigint>").alias("items"), F.array().cast(_RUN).alias("runs"),
    )
    for k in range(blocks):
        own = phrases.filter(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == k)
        # Bounded by block_chars: one block is what a task may hold.
        listed = [(r["phrase"], list(r["item_ids"])) for r in own.toLocalIterator()]
        block = docs.sparkSession.sparkContext.broadcast(listed)
        last = k == blocks - 1
        scan = functools.partial(_scan_batches, block, last)
        rows = rows.mapInArrow(scan, SCHEMA if last else CARRIED)
        rows = rows if last else staged(rows, "scanned")
    return rows


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without any benchmark window, with all their columns.

    Rows are told apart by a hash of id and text, so each text of an id (or of none)
    has a verdict of its own.
    """
    own = F.xxhash64(F.col("doc_id").cast("bigint"), "text")
    rows = sealed(docs, "text", "doc_id").withColumns({"given_id": F.col("doc_id"), "doc_id": own})
    bad = find_contamination(rows, benchmark, window).filter("n_hit > 0").select("doc_id").distinct()
    left = without(rows, staged(bad, "contaminated")).withColumn("doc_id", F.col("given_id"))
    return opened(left, docs, "text", "doc_id")
