"""Phrase mining, ranked search and boosted trees against brute force and odd inputs."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from voicelane.llm import boosted, phrases, ranked
from voicelane.llm.common import folded_words, id_remainder

COLUMNS = "doc_id bigint, text string, lang string, source string, n bigint, score double, phrase string, m bigint"
ODD = [
    (1, None, "en"), (2, "", None), (None, "Some words, here. Some words", None), (3, "one", "en"), (3, "one", "en"),
    (4, "Émile\x1fb c <|endoftext|> " * 40, ""), (5, "word " * 60_000, "b"), (6, " \t. ,\r\n!", "en"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang, "s", 7, 0.5, "p", 3) for i, t, lang in ODD]
    return spark.createDataFrame(rows, COLUMNS), spark.createDataFrame([], COLUMNS)


def mined(rows, top, least, cover=80):
    """All phrases of (text, lang) rows, counted and scored one by one."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        held = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        kept = []
        for p, a in held.items():
            score, _, l, r = min(  # noqa: E741
                (2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            longer = [
                b for q, b in held.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if not any(100 * b >= cover * a for b in longer):
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def own_rows(seed, n):
    """Texts of few words, with repeated runs, so that phrases nest and tie."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["É", "x\x1fy", "the", "of"]
    runs = [[rng.choice(words) for _ in range(rng.randint(2, 7))] for _ in range(25)]
    rows = []
    for _ in range(n):
        parts = [rng.choice(runs) if rng.random() < 0.6 else [rng.choice(words)] for _ in range(rng.randint(1, 30))]
        text = " ".join(w for p in parts for w in [*p, *([rng.choice([".", ",", "\t"])] if rng.random() < 0.2 else [])])
        rows.append((text.title() if rng.random() < 0.3 else text, rng.choice(["en", "de", None, "en"])))
    return rows


@pytest.mark.parametrize("top, frontier", [(5, 1), (40, 1), (2000, 4)])
def test_phrases_equal_all_phrases(spark, top, frontier):
    rows = own_rows(top, 150)
    settings = phrases.Settings(top=top, min_count=4, frontier=frontier)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = sorted(map(tuple, phrases.mine(docs, settings).collect()))
    assert got == mined(rows, top, 4) and len(got) >= min(top, 100) / 2


def test_phrase_scores_are_exact(spark):
    big = 5 * 10**12  # the product passes 64 bits
    row = spark.createDataFrame([(big, big + 1, big + 2)], "a bigint, l bigint, r bigint")
    got = row.select(phrases._score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert got == 2_000_000 * big // (2 * big + 3)


def test_phrases_of_odd_rows(spark, odd):
    rows, none = odd
    got = sorted(map(tuple, phrases.mine(rows, phrases.Settings(min_count=2)).collect()))
    assert got == mined([(t, lang) for _, t, lang in ODD], 2000, 2)
    assert {r[0] for r in got} >= {"und", "b"} and phrases.mine(none).count() == 0


def ranked_plainly(docs, items, top):
    words = [(i, Counter(folded_words(t))) for i, t in docs]
    words = [(i, w, sum(w.values())) for i, w in words if w]
    n, total = len(words), sum(x[2] for x in words)
    df = Counter(w for _, own, _ in words for w in own)
    out = []
    for item, asked in items.items():
        scores = []
        for doc, own, size in words:
            m = 75 + 25 * size * n // total
            score = sum(
                k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * own[w] // (1000 * own[w] + 12 * m))
                for w, k in asked.items() if w in own
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, k, None if null else doc, -s) for k, (s, null, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("settings", [
    ranked.Settings(), ranked.Settings(top=3, part=7, shard_postings=300, window_bytes=2_000, block_bytes=200),
])
def test_ranking_equals_all_scores(spark, settings):
    rng = random.Random(3)
    words = [f"w{int(rng.expovariate(0.05))}" for _ in range(300)]
    docs = [(k if k % 50 else None, " ".join(rng.choice(words) for _ in range(rng.choice([3, 3, 20, 90])))) for k in range(400)]
    docs += [(7, "same text"), (7, "same text"), (8, "same text"), (9, None), (10, "!")]
    items = {k: " ".join(rng.choice(words) for _ in range(12)) for k in range(30)} | {None: "w1 w2", 50: "same SAME", 51: None}
    got = ranked.rank(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
        spark.createDataFrame(list(items.items()), "item_id bigint, text string"), settings,
    ).collect()
    asked = {i: Counter(folded_words(t)) for i, t in items.items() if folded_words(t)}
    assert sorted(map(tuple, got), key=str) == ranked_plainly(docs, asked, settings.top)


def test_ranking_of_odd_rows(spark, odd):
    rows, none = odd
    items = spark.createDataFrame([(1, "words ONE", "x"), (1, "words ONE", "x"), (1, "here", "y"), (2, "", "z")], "item_id bigint, text string, rank string")
    got = ranked.rank(rows, items).collect()
    want = ranked_plainly([(i, t) for i, t, _ in ODD], {1: Counter([b"words", b"one", b"here"])}, 20)
    assert sorted(map(tuple, got), key=str) == want and len(got) == 3
    assert ranked.rank(none, items).count() == 0 and ranked.rank(rows, items.limit(0)).count() == 0


def test_statistics_by_hand():
    got = dict(zip(boosted.STATISTICS, boosted.statistics("Ab cd!\nAb cd!\n12 é | x"), strict=True))
    want = {
        "words": math.log1p(8), "word_bytes": 16 / 8, "distinct_words": 6 / 8, "distinct_pairs": 6 / 7, "top_word": 2 / 8,
        "upper": 2 / 16, "digits": 2 / 16, "symbols": 1 / 8, "shouts": 2 / 8, "beyond_ascii": 2 / 16, "lines": 3 / 8,
        "distinct_lines": 2 / 3, "short_words": 1.0, "long_words": 0.0,
    }
    assert all(got[k] == pytest.approx(v, rel=1e-6) for k, v in want.items())
    for text in (None, "", " \n\t"):
        assert not boosted.statistics(text).any()
    assert np.isfinite(boosted.statistics("\x00")).all() and np.isfinite(boosted.statistics("w " * 100_000)).all()


def grown_plainly(x, y, settings):
    """Margins after boosting, with every split tried row by row."""
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(settings.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), int)
        for _ in range(settings.depth):
            new = node * 2
            for k in np.unique(node):
                own, best = node == k, (1e-9, None)
                for f in range(x.shape[1]):
                    for cut in range(x[:, f].max()):
                        a, b = own & (x[:, f] <= cut), own & (x[:, f] > cut)
                        if min(h[a].sum(), h[b].sum()) < settings.least:
                            continue
                        worth = lambda s: g[s].sum() ** 2 / (h[s].sum() + settings.ridge)
                        gain = worth(a) + worth(b) - worth(own)
                        if gain > best[0] + 1e-7:
                            best = gain, b
                if best[1] is not None:
                    new = new + best[1]
            node = new
        for k in np.unique(node):
            own = node == k
            margin[own] -= settings.rate * g[own].sum() / (h[own].sum() + settings.ridge)
    return margin


def test_trees_equal_plain_growth(spark):
    rng = np.random.default_rng(5)
    values = rng.integers(0, 6, (300, len(boosted.STATISTICS))).astype(np.float32)
    y = (values[:, 2] + values[:, 7] * (values[:, 4] > 2) + rng.normal(size=300) > 5).astype(int)
    settings = boosted.Settings(trees=3, depth=3, bins=8, task_rows=70)
    rows = spark.createDataFrame(
        [(int(k), v.tobytes(), int(t)) for k, (v, t) in enumerate(zip(values, y, strict=True))],
        "doc_id bigint, stats binary, label int",
    )
    forest = boosted.train(rows, settings)
    bins = boosted.binned(values, forest.edges)
    assert np.allclose(forest.margin(bins), grown_plainly(bins.astype(int), y, settings), atol=1e-5)


def test_quality_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/../sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/../sf0.01/labels.parquet")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    rows = boosted.described(docs)
    forest = boosted.train(boosted.labelled(rows, labels.filter(~held_out)))
    seen = boosted.score(rows, forest).filter(held_out).join(labels, "doc_id").select("score", "quality").collect()
    right = [(r["score"] >= 0.5) == (r["quality"] == 1) for r in seen]
    assert len(seen) > 90 and sum(right) / len(right) >= 0.97


def test_boosting_of_odd_rows(spark, odd):
    rows, none = odd
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (5, 0), (None, 1), (6, None)], "doc_id bigint, quality int")
    known = boosted.labelled(boosted.described(rows), labels)
    assert sorted((r["doc_id"], r["label"]) for r in known.collect()) == [(1, 1), (3, 1), (3, 1), (5, 0)]
    scores = boosted.score(boosted.described(rows), boosted.train(known)).collect()
    assert len(scores) == len(ODD) and all(0 < r["score"] < 1 for r in scores)
    assert len({r["score"] for r in scores if r["doc_id"] in (1, 2, 6)}) == 1  # no words at all
    only = boosted.train(known.filter("label = 1"))
    assert [r["score"] for r in boosted.score(boosted.described(rows.limit(1)), only).collect()][0] > 0.99
    blank = boosted.train(known.limit(0))
    assert boosted.score(boosted.described(rows), blank).first()["score"] == 0.5
    assert boosted.score(boosted.described(none), blank).count() == 0


def test_phrases_are_told_apart_in_one_number_or_step_by_step():
    rng = np.random.default_rng(5)
    for size in (2, 3, 4):
        columns = [rng.integers(0, 6, 500) for _ in range(size)]
        want = sorted(Counter(zip(*[c.tolist() for c in columns])).items())
        for words in (6, 1 << 31):  # numbers of so many words fit 64 bits together, or don't
            found, n = phrases._distinct(columns, words)
            assert list(zip(zip(*[c.tolist() for c in found]), n.tolist())) == want
