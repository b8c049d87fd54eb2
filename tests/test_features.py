"""N-grams looked up and counted by arrays: the same as string by string."""

import collections

import numpy as np
import pyarrow as pa
import pytest

from voicelane.operators import features as ft
from voicelane.operators import model as mo

TEXTS = ["a cat, a cat and the catalogue", "", None, "  ", "i \U0001d538\U0001d539 é", "cat", "the cat sat", "at a\0 \0",
         "the cat the cat the cat sat on the cat", "xx", "dé jà vu dé jà vu"]


def listed(read, column):
    return {(int(r), int(s)): int(t) for rows in read(column) for r, s, t in zip(*rows, strict=True)}


@pytest.mark.parametrize("span", [(3, 5), (4, 5), (5, 5), (2, 3)])
def test_known_character_ngrams_by_number(span, monkeypatch):
    grams = [{g for w in (t or "").split(" ") for g in ft._grams_of_word(w, *span)} for t in TEXTS]
    # Some n-grams are in no text, some characters in no n-gram, one term is too long for any.
    terms = sorted(set().union(*grams[:4], *grams[5:8], {"zzz", "toolong"}))
    table = {t: k for k, t in enumerate(terms)}
    want = collections.Counter(
        (row, k) for row, t in enumerate(TEXTS) for w in (t or "").split(" ") for k in ft._slots_of_word(w, table, *span)
    )
    monkeypatch.setattr(ft, "_CHUNK_BYTES", 30)
    as_strings = ft._CharSlots(terms, span)
    as_strings.table = table
    assert want and listed(as_strings.read, pa.array(TEXTS)) == want
    monkeypatch.setattr(ft, "_slots_of_word", None)  # was called for every distinct word
    assert listed(ft._CharSlots(terms, span).read, pa.array(TEXTS)) == want
    assert listed(ft._CharSlots([], span).read, pa.array(TEXTS)) == {}


def test_codes_whose_hashes_meet(monkeypatch):
    monkeypatch.setattr(ft._Numbers, "BITS", 4)
    codes = np.random.default_rng(1).permutation(4000)[:500].astype(np.uint64)
    known, numbers = ft._Numbers(codes, np.arange(500)).of(np.arange(4000, dtype=np.uint64))
    assert set(np.flatnonzero(known)) == set(codes.tolist())
    assert [int(codes[k]) for k in numbers] == np.flatnonzero(known).tolist()


@pytest.mark.parametrize("span", [(1, 1), (1, 2), (2, 3)])
def test_known_word_ngrams_by_number(span):
    words = [None if t is None else t.replace(",", "").split() for t in TEXTS]
    grams = [[" ".join((w or [])[i : i + n]) for n in range(span[0], span[1] + 1) for i in range(len(w or []) - n + 1)] for w in words]
    terms = sorted({*grams[0], *grams[8], "no such", "such", "a b c d"})
    want = collections.Counter((row, terms.index(g)) for row, own in enumerate(grams) for g in own if g in terms)
    column = pa.concat_arrays([pa.array([["cut", "off"]]), pa.array(words, pa.list_(pa.string()))]).slice(1)
    assert want and listed(ft._WordSlots(terms, span).read, column) == want


@pytest.mark.parametrize("span", [(1, 1), (1, 2), (2, 3)])
def test_word_counts_by_arrays_equal_those_of_strings(spark, span):
    df = spark.createDataFrame([(t,) for t in TEXTS * 3], "text string").repartition(2)
    want = sorted(map(tuple, ft._counted(ft.with_ngrams(df, "word", span).select("grams")).collect()))
    got = ft.term_counts(df, "word", span)
    assert "MapInArrow" in got._jdf.queryExecution().toString()  # not one row per occurrence
    assert want and sorted(map(tuple, got.collect())) == want


def test_models_of_one_space_share_a_pass(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS * 3)], "review_id bigint, text string")
    space = mo.fit_space(df)
    rng = np.random.default_rng(3)
    a, b = (mo.ReviewModel(space, rng.normal(size=space.size), 0.1) for _ in range(2))
    both = mo.agreement_on(df, a, b)
    assert both._jdf.queryExecution().optimizedPlan().toString().count("dot(") == 1  # was one each
    p = [[r["p_negative"] for r in m.with_p_negative(df).orderBy("review_id").collect()] for m in (a, b)]
    row = both.first()
    assert row["n"] == len(p[0]) and row["agreement"] == np.mean([(x >= 0.5) == (y >= 0.5) for x, y in zip(*p)])
