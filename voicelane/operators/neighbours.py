"""Pairs of words within a few edits, by an equi-join of their deletions.

Two words within ``k`` edits (a swap of neighbouring letters counts as one) have a common
rest after at most ``k`` deletions from each. So every word lists its rests, equal rests
meet in a hash join, and what meets is tested by the exact distance. The work follows the
words and the matches, not the product of words and terms, for terms by the hundred
thousand; no word is compared with terms it can't be close to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voicelane.functions.edits import within_edits

#: Terms whose rests are sent to all tasks (a hundred rests a term, some 10 MB).
BROADCAST_TERMS = 1_000


def _without_one(word: str, at: str) -> str:
    """SQL: the word without each of its letters in turn."""
    return (
        f"transform(sequence(1, length({word})), "
        f"{at} -> concat(left({word}, {at} - 1), substring({word}, {at} + 1)))"
    )


def rests(word: str, budget: int) -> Column:
    """What is left of a word of two or more letters after up to ``budget`` (1 or 2) deletions."""
    one = _without_one(word, "i")
    every = f"concat(array({word}), {one})"
    if budget == 2:
        two = f"flatten(transform({one}, r -> {_without_one('r', 'j')}))"
        every = f"concat(array({word}), {one}, {two})"
    return F.expr(f"array_distinct({every})")


def _keys(words: DataFrame, column: str, budget: int) -> DataFrame:
    """One row per rest of a word, as a hash; what meets by chance fails the exact test."""
    hashed = F.transform(rests(column, budget), lambda r: F.xxhash64(r))
    return words.select(column, F.explode(hashed).alias("_rest"))


def near(tokens: DataFrame, terms: DataFrame, budget: int) -> DataFrame:
    """token, term: pairs of tokens and terms (one column each, distinct) within ``budget`` edits.

    Tokens whose length no term comes near are left out before they list their rests. The
    rests of few terms go to all tasks, those of many are shuffled; the tokens' rests are
    never sent, though the tokens may be a small file.
    """
    span = terms.agg(
        F.min(F.length("term")).alias("lo"), F.max(F.length("term")).alias("hi"), F.count("term").alias("n")
    ).first()
    if span["lo"] is None:
        return tokens.select("token").limit(0).withColumn("term", F.lit(None).cast("string"))
    if span["lo"] <= budget:
        raise ValueError(f"terms of {budget} edits need more than {budget} letters")
    fitting = F.length("token").between(max(span["lo"] - budget, 1), span["hi"] + budget)
    left = _keys(tokens.filter(fitting), "token", budget)
    right = _keys(terms, "term", budget)
    right = F.broadcast(right) if span["n"] <= BROADCAST_TERMS else right.hint("merge")
    met = left.join(right, "_rest").select("token", "term").distinct()
    return met.filter(F.expr(within_edits("token", "term", str(budget))))


def near_terms(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """token, term for terms (term, budget); each term allows its own budget of 1 or 2 edits."""
    pairs = [near(tokens, terms.filter(F.col("budget") == k), k) for k in (1, 2)]
    return pairs[0].unionByName(pairs[1])
