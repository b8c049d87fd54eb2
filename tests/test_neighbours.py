import random

import numpy as np
import pytest

from tests.test_edits import osa
from tests.test_text import py_norm
from voicelane.lexicon import Lexicon
from voicelane.operators import matching as mt
from voicelane.operators.neighbours import near, near_terms


def spoilt(rng, word, edits):
    letters = list(word)
    for _ in range(edits):
        at = rng.randrange(len(letters))
        kind = rng.choice("dist")
        if kind == "d" and len(letters) > 2:
            del letters[at]
        elif kind == "i":
            letters.insert(at, rng.choice("abcde"))
        elif kind == "s":
            letters[at] = rng.choice("abcde")
        elif at + 1 < len(letters):
            letters[at], letters[at + 1] = letters[at + 1], letters[at]
    return "".join(letters)


@pytest.mark.parametrize("budget", [1, 2])
def test_all_pairs_within_the_budget_are_found(spark, budget):
    rng = random.Random(budget)
    terms = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(4, 7))) for _ in range(60)})
    tokens = sorted({spoilt(rng, rng.choice(terms), rng.randint(0, 4)) for _ in range(300)} | {"", "a", "x" * 40})
    frame = lambda words, name: spark.createDataFrame([(w,) for w in words], f"{name} string")
    got = sorted(map(tuple, near(frame(tokens, "token"), frame(terms, "term"), budget).select("token", "term").collect()))
    want = sorted((a, b) for a in tokens for b in terms if osa(a, b) <= budget)
    assert got == want and len(want) > 100


def test_terms_keep_their_own_budget(spark):
    terms = spark.createDataFrame([("billing", 1), ("furious!", 2)], "term string, budget int")
    tokens = spark.createDataFrame([("biling",), ("bilin",), ("furous",), ("furious!",)], "token string")
    got = sorted(map(tuple, near_terms(tokens, terms).select("token", "term").collect()))
    assert got == [("biling", "billing"), ("furious!", "furious!"), ("furous", "furious!")]
    assert near_terms(tokens, terms.limit(0)).count() == 0
    with pytest.raises(ValueError, match="letters"):
        near(tokens, spark.createDataFrame([("a",)], "term string"), 1)


def test_a_lexicon_of_fifty_thousand_terms(spark):
    rng = random.Random(9)
    terms = sorted({"".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(5, 12))) for _ in range(50_000)})
    assert len(terms) > 49_900
    lexicon = Lexicon(churn=tuple(terms[::2]), money=tuple(terms[1::2]), anger=())
    budget = {t: 1 if len(t) < 8 else 2 for t in terms}
    picked = rng.sample(terms, 60)
    texts = [" ".join(spoilt(rng, t, rng.randint(0, 2)) for t in picked[k : k + 3]) for k in range(0, 60, 3)]
    df = spark.createDataFrame(list(enumerate(texts)), "review_id bigint, text string")
    got = sorted(map(tuple, mt.match_fuzzy(df, lexicon).collect()))
    words = {(k, w) for k, t in enumerate(texts) for w in py_norm(t).split() if w not in lexicon.guard}
    letters = np.array([[t.count(c) for c in "abcdefghijklmnopqrst"] for t in terms])
    want = []
    for k, w in words:
        # Few edits change few counts of letters.
        apart = np.abs(letters - [w.count(c) for c in "abcdefghijklmnopqrst"]).sum(1)
        want += [(k, w, terms[j]) for j in np.flatnonzero(apart <= 4) if osa(w, terms[j]) <= budget[terms[j]]]
    want.sort()
    assert got == want and len(want) > 40
    mined = mt.mine_collisions(df.unionByName(df), lexicon, min_count=2)
    members = {"churn": set(lexicon.churn), "money": set(lexicon.money)}
    groups = {t: g for g, own in members.items() for t in own}
    assert sorted({(r["token"], r["group"], r["term"]) for r in mined.collect()}) == sorted(
        {(w, groups[t], t) for _, w, t in want if w not in members[groups[t]]}
    )


@pytest.mark.parametrize("most", [1_000, 0])
def test_only_the_rests_of_few_terms_are_sent_to_all_tasks(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr("voicelane.operators.neighbours.BROADCAST_TERMS", most)
    path = str(tmp_path / "tokens")
    spark.createDataFrame([("cancle",), ("cancel",), ("winter",)], "token string").write.parquet(path)
    # Rows from Python have no known size, so the tokens' small file looked like the one to send.
    terms = spark.createDataFrame([("cancel",)], "term string")
    got = near(spark.read.parquet(path), terms, 1)
    assert sorted(r["token"] for r in got.collect()) == ["cancel", "cancle"]
    plan = got._jdf.queryExecution().toString()
    assert "BuildLeft" not in plan and ("BuildRight" in plan) == bool(most)


def test_token_counts_are_not_sent_to_all_tasks(reviews):
    report = mt.guard_report(reviews("cancle it", "cancle that"))
    assert {(r["token"], r["n"]) for r in report.collect()} == {("cancle", 2)}
    plan = report._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [token" in plan
