import pytest
from pyspark.sql import functions as F

from voicelane.lexicon import DEFAULT_LEXICON
from voicelane.operators import matching as m
from voicelane.operators.routing import route
from voicelane.operators.urgency import audit, score_urgency

# text, score, churn, money, anger, intensity
CASES = [
    ("I was charged twice and support ignored me. CANCELLING my account NOW!!!", 0.85, "cancel cancelling", "charged", "", 1.0),
    ("Charged twice and nobody replied. I want a REFUND, cancelling today!!!", 0.828, "cancel cancelling refund", "charged", "", 0.778),
    ("Charged twice, I want a REFUND, cancelling today!!!", 0.842, "cancel cancelling refund", "charged", "", 0.917),
    ("Terrible! Charged twice, I want a REFUND, cancelling today!!!", 0.925, "cancel cancelling refund", "charged", "terrible", 1.0),
    ("Charged twice, cancelling!!!", 0.8, "cancel cancelling", "charged", "", 0.5),
    ("cancel my subscription, billed twice", 0.75, "cancel", "billed", "", 0.0),
    ("want to cancle my subscribtion, charged twice", 0.75, "cancle", "charged", "", 0.0),
    ("I want to cancle my subscription", 0.45, "cancle", "", "", 0.0),
    ("i need a refudn NOW", 0.533, "refudn", "", "", 0.833),
    ("unsubscibe me immediately", 0.45, "unsubscibe", "", "", 0.0),
    ("I love this, Id never cancel.", 0.0, "", "", "", 0.0),
    ("I love this service, I would never cancel.", 0.0, "", "", "", 0.0),
    ("Best subscription I have ever had, I will never cancel it.", 0.0, "", "", "", 0.0),
    ("Amazing film. I would never ask for a refund.", 0.0, "", "", "", 0.0),
    ("Fantastic, I would never cancle this.", 0.0, "", "", "", 0.0),
    ("I never watch films like this. I want a refund.", 0.45, "refund", "", "", 0.0),
    ("i dont like it, want to cancle my subscribtion", 0.45, "cancle", "", "", 0.0),
    ("I would never cancel, but now I want to cancel.", 0.45, "cancel", "", "", 0.0),
    ("Its horrible, I dont want my subscription", 0.525, "dont want my subscription", "", "horrible", 0.0),
    ("Its horrible, I don't want my subscription", 0.525, "dont want my subscription", "", "horrible", 0.0),
    ("Terrible service. I no longer want my membership.", 0.525, "no longer want my membership", "", "terrible", 0.0),
    ("Awful. Stop my subscription immediately.", 0.525, "stop my subscription", "", "awful", 0.0),
    ("Disgusting quality, I am not renewing.", 0.525, "not renew", "", "disgusting", 0.0),
    ("Worst app ever, close my account.", 0.525, "close my account", "", "worst", 0.0),
    ("This is awful, I want out.", 0.525, "want out.", "", "awful", 0.0),
    ("I dont want to spoil the ending, but it was boring.", 0.0, "", "", "", 0.0),
    ("You dont want to miss this film! Wonderful.", 0.017, "", "", "", 0.167),
    ("The plot was terrible and I dont want to see it again.", 0.075, "", "", "terrible", 0.0),
    ("I want out of my seat, the pacing dragged.", 0.0, "", "", "", 0.0),
    ("He killed the villain in the final act.", 0.0, "", "", "", 0.0),
    ("The killing scenes were beautifully shot.", 0.0, "", "", "", 0.0),
    ("Great style, and the store scene was lovely.", 0.0, "", "", "", 0.0),
    ("The plot changed halfway through.", 0.0, "", "", "", 0.0),
    ("A moving film about cancer.", 0.0, "", "", "", 0.0),
    ("I was curious about the ending.", 0.0, "", "", "", 0.0),
    ("The pacing was acceptable.", 0.0, "", "", "", 0.0),
    ("the film was borst", 0.075, "", "", "borst", 0.0),
    ("absolutely terrable acting", 0.075, "", "", "terrable", 0.0),
    ("I wont be cancelling", 0.45, "cancel", "", "", 0.0),
    ("I love this, I'd never, ever cancel", 0.45, "cancel", "", "", 0.0),
    ("never again will I switch", 0.45, "never again", "", "", 0.0),
    ("The lawful heir", 0.075, "", "", "awful", 0.0),
    ("CHARGED!!!", 0.4, "", "charged", "", 1.0),
    ("They stole my money! REFUND!", 0.846, "refund", "stole", "", 0.958),
]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, c[0]) for i, c in enumerate(CASES)]
    df = score_urgency(spark.createDataFrame(rows, "review_id bigint, text string"))
    return {r["review_id"]: r for r in df.collect()}


@pytest.mark.parametrize("no", range(len(CASES)))
def test_score_and_signals(scored, no):
    text, score, churn, money, anger, loud = CASES[no]
    got, signals = scored[no], scored[no]["signals"]
    assert got["urgency"] == score, text
    if churn.count(" ") and churn.split()[0] not in ("cancel", "cancelling"):
        assert signals["churn_phrases"] == [churn], text
    else:
        assert signals["churn_phrases"] == churn.split(), text
    assert signals["money_phrases"] == money.split(), text
    assert signals["anger_words"] == anger.split(), text
    assert signals["intensity"] == loud, text


def test_audit_has_one_row_per_term(reviews):
    df = score_urgency(reviews("Terrible, charged twice, cancelling", "fine"))
    rows = sorted((r["review_id"], r["kind"], r["ord"], r["term"]) for r in audit(df).collect())
    assert rows == [(0, "anger", 0, "terrible"), (0, "churn", 0, "cancel"),
                    (0, "churn", 1, "cancelling"), (0, "money", 0, "charged")]


def test_routes(spark):
    cases = [(0.9, 0.8, "support_urgent"), (0.9, 0.1, "feedback_backlog"),
             (0.1, 0.05, "analytics"), (0.238, 0.828, "support_urgent"),
             (0.09, 0.9, "analytics"), (0.1, 0.4, "support_urgent"),
             (0.5, 0.39, "feedback_backlog"), (0.4999, 0.39, "analytics")]
    df = spark.createDataFrame(cases, "p double, u double, want string")
    for r in df.withColumn("got", route(F.col("p"), F.col("u"))).collect():
        assert r["got"] == r["want"], r


def test_filtering_on_the_route_computes_text_once(reviews):
    df = score_urgency(reviews("refund")).withColumn(
        "route", route(F.lit(0.9), F.col("urgency"))).filter("route = 'support_urgent'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(lower(") == 1
    assert df.count() == 1


def test_guard_list_is_filled():
    assert {"killed", "cancer", "changed", "style"} <= set(DEFAULT_LEXICON.guard)
    assert len(DEFAULT_LEXICON.guard) == 29 and len(DEFAULT_LEXICON.fuzzy_terms()) == 22


def test_negation_is_worked_out_once_a_review(reviews):
    df = m.prepare(reviews("I would never cancel, but now I want a refund."))
    hits = df.withColumn("hits", m.group_hits(F.col("norm"), F.col("typos"), DEFAULT_LEXICON.churn))
    kept = m.surviving_churn(hits, "hits", "kept")
    assert [tuple(r) for r in kept.select("hits", "kept").collect()] == [(["cancel", "refund"], ["refund"])]
    # The clauses must not be split inside the test of every hit.
    plan = kept.select("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" in plan and "split(" not in plan.splitlines()[0]


def test_free_tokens_among_some(spark):
    df = spark.sql("SELECT array(array('never', 'cancel', 'it'), array('stop', 'it')) AS c, array('it', 'cancel') AS few")
    assert sorted(df.select(m.free_tokens("c")).first()[0]) == ["it", "never", "stop"]
    assert df.select(m.free_tokens("c", among="few")).first()[0] == ["it"]
