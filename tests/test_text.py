"""Text functions against plain Python on real and awkward texts."""

import re

from pyspark.sql import functions as F

from tests.conftest import SMALL
from voicelane.functions import text as tx
from voicelane.operators import features as ft

AWKWARD = [
    "I don't like it", "SOOOO BAAAAD!!!", "Great film.<br /><br />Loved it.", "", "   ",
    "a b c　d\x1ce\x85f", "tag <a\nb> end", "emoji 😀x é naïve ＡＢ", "x’s `y´",
    "one", "ab", "a b c", "under_score 42 x1", "étude côte", "😀😀 😀ab😀", "NO!! YES no!",
    "ABCdef ABC abcDEF XYZ", "!!! 123", "a<b", "aaaabbbbcccc",
]


def py_norm(text):
    text = re.sub("<[^>]+>", " ", text.lower())
    text = re.sub("[’'`´]", "", text)
    text = re.sub(r"([a-z])\1\1+", r"\1\1", text)
    return " ".join(text.split())


def py_word_grams(norm):
    words = re.findall(r"\b\w\w+\b", norm)
    return sorted(words + [" ".join(p) for p in zip(words, words[1:])])


def py_char_grams(norm, lo=3, hi=5):
    out = []
    for word in norm.split():
        padded = f" {word} "
        if len(padded) < lo:
            out.append(padded)
        for n in range(lo, hi + 1):
            out += [padded[i:i + n] for i in range(len(padded) - n + 1)]
    return sorted(out)


def py_intensity(raw):
    words = re.findall("[A-Za-z]{3,}", raw)
    caps = sum(w.isupper() for w in words) / len(words) if words else 0.0
    return min(1.0, raw.count("!") / 3 * 0.5 + caps * 5 * 0.5)


def corpus(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text")
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select(F.col("html").alias("text"))
    extra = spark.createDataFrame([(t,) for t in AWKWARD], "text string")
    return docs.union(pages).union(extra)


def test_normalize_tokens_counts_and_intensity(spark):
    norm = tx.normalize(F.col("text"))
    rows = corpus(spark).select(
        "text", norm.alias("norm"), tx.tokens(norm).alias("tokens"),
        tx.word_count(F.col("text")).alias("n"), tx.is_blank(F.col("text")).alias("blank"),
        tx.shout_intensity(F.col("text")).alias("loud"), tx.clauses(norm).alias("clauses"),
    ).collect()
    assert len(rows) > 200
    for r in rows:
        want = py_norm(r["text"])
        assert r["norm"] == want
        assert r["tokens"] == re.findall("[a-z]+", want)
        assert r["n"] == len(r["text"].split())
        assert r["blank"] == (not r["text"].strip())
        assert r["loud"] == py_intensity(r["text"])
        clauses = [re.findall("[a-z]+", c) for c in re.split("[.!?;,]+", want) if c.strip()]
        assert r["clauses"] == clauses


def test_ngrams(spark):
    df = corpus(spark)
    words = ft.with_ngrams(df, "word").select("text", "grams").collect()
    chars = ft.with_ngrams(df, "char").select("text", "grams").collect()
    for r in words:
        assert sorted(r["grams"]) == py_word_grams(py_norm(r["text"]))
    for r in chars:
        assert sorted(r["grams"]) == py_char_grams(py_norm(r["text"]))


def test_long_char_ngrams_list_short_words_once(spark):
    df = spark.createDataFrame([("a bc def ghij",)], "text string")
    got = df.select(tx.char_ngrams(F.col("text"), 5, 6).alias("g")).first()["g"]
    assert sorted(got) == py_char_grams("a bc def ghij", 5, 6)


def test_trigrams_of_words(spark):
    df = spark.createDataFrame([("aa bb cc dd",), ("aa bb",)], "text string")
    df = df.withColumn("w", tx.model_words(F.col("text")))
    got = df.select(tx.word_ngrams(F.col("w"), 2, 3).alias("g")).collect()
    assert got[0]["g"] == ["aa bb", "bb cc", "cc dd", "aa bb cc", "bb cc dd"]
    assert got[1]["g"] == ["aa bb"]
