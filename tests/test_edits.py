"""The built-in edit test against a plain dynamic programme."""

import random

from pyspark.sql import functions as F

from voicelane.functions.edits import edit_budget, within_edits
from voicelane.lexicon import DEFAULT_LEXICON
from voicelane.operators.matching import reachable_terms


def osa(a, b):
    """Restricted edit distance with swaps, unbounded, memoised over suffixes."""
    memo = {}

    def go(i, j):
        if i == len(a) or j == len(b):
            return len(a) - i + len(b) - j
        if (i, j) not in memo:
            best = min(go(i + 1, j) + 1, go(i, j + 1) + 1, go(i + 1, j + 1) + (a[i] != b[j]))
            if a[i:i + 2] == b[j:j + 2][::-1] and len(a[i:i + 2]) == 2:
                best = min(best, go(i + 2, j + 2) + 1)
            memo[i, j] = best
        return memo[i, j]

    return go(0, 0)


def mutate(word, rng):
    word = list(word)
    for _ in range(rng.randrange(5)):
        i = rng.randrange(len(word)) if word else 0
        kind = rng.randrange(4)
        if kind == 0 and word:
            del word[i]
        elif kind == 1:
            word.insert(i, rng.choice("abcdel"))
        elif kind == 2 and word:
            word[i] = rng.choice("abcdel")
        elif i + 1 < len(word):
            word[i], word[i + 1] = word[i + 1], word[i]
    return "".join(word)


def test_within_edits_matches_plain_distance(spark):
    rng = random.Random(7)
    terms = [t for t, _ in DEFAULT_LEXICON.fuzzy_terms()]
    pairs = [(mutate(t, rng), t) for t in terms for _ in range(300)]
    pairs += [("".join(rng.choices("ab", k=rng.randrange(9))),
               "".join(rng.choices("ab", k=rng.randrange(1, 9)))) for _ in range(4000)]
    pairs += [("ca", "abc"), ("axcncelling", "cancelling"), ("cancle", "cancel"),
              ("acnecl", "cancel"), ("", "a"), ("ab", "ba")]
    df = spark.createDataFrame(pairs, "token string, term string").select(
        "token", "term",
        F.expr(within_edits("token", "term", "1")).alias("one"),
        F.expr(within_edits("token", "term", "2")).alias("two"),
    )
    hits = [0, 0]
    for r in df.collect():
        d = osa(r["token"], r["term"])
        assert r["one"] == (d <= 1), (r, d)
        assert r["two"] == (d <= 2), (r, d)
        hits[0] += d <= 1
        hits[1] += d <= 2
    assert min(hits) > 500


def test_first_tests_lose_no_misspelling(spark):
    """The cheap head/middle/tail tests must not reject anything within budget."""
    rng = random.Random(11)
    fuzzy = DEFAULT_LEXICON.fuzzy_terms()
    tokens = sorted({mutate(t, rng) for t, _ in fuzzy for _ in range(400)})
    df = spark.createDataFrame([(t,) for t in tokens], "token string")
    for r in df.select("token", reachable_terms("token", fuzzy).alias("terms")).collect():
        want = [t for t, b in fuzzy if osa(r["token"], t) <= b]
        assert (r["terms"] or []) == want, r


def test_budgets():
    assert [edit_budget(t) for t in ("scam", "stole", "billing", "canceled", "rip off")] == [
        0, 1, 1, 2, 0]
