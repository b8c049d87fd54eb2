"""Operators against brute force, exact round trips and odd inputs."""

import collections
import hashlib
import itertools
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.test_queries import canon
from voicelane.llm import (
    bagminhash, bpe, chat, decontam, eliasfano, lm, passages, quality, queries, rollup, toxic, warc,
)
from voicelane.llm.common import WORD, WordHashes, components, joined_components, within, without, word_spans
from voicelane.llm.shingles import shingle_hashes, word_hashes

DOCS = "doc_id bigint, text string, source string, __maybe string, n_words string, label string"
ODD = [
    (1, None, "a", "x", "y", "z"), (2, "", "a", "x", "y", "z"), (None, "some words here", None, "x", "y", "z"),
    (3, "one", "a", "x", "y", "z"), (3, "one", "a", "x", "y", "z"), (4, "Émile\x1fb c <|endoftext|> " * 40, None, "x", "y", "z"),
    (5, "word " * 60_000, "b", "x", "y", "z"), (6, "one", "b", "x", "y", "z"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS), spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


def prose(seed, n):
    rng = random.Random(seed)
    return [rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(n)]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SMALL}/{file}'")
    ours = canon(queries.queries()[name](spark, SMALL).toPandas())
    theirs = canon(con.execute(queries.oracle_sql()[name]).df())
    assert list(ours.columns) == list(theirs.columns) and ours.equals(theirs)


def test_common(spark):
    for t in ("Aé b,c ", "", "é", "!!", " x"):
        starts, stops = word_spans(t)
        assert list(zip(starts, stops, strict=True)) == [m.span() for m in WORD.finditer(t)]
    links = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (9, 9), (3, 7)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(links, "t").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 4: 4, 5: 4, 9: 9}
    docs = spark.createDataFrame([(k,) for k in range(50)] + [(None,)], "doc_id bigint")
    ids = spark.createDataFrame([(k,) for k in range(0, 50, 7)] + [(None,)], "i bigint")
    assert within(docs, ids).count() == 9 and without(docs, ids).count() == 42


def test_quality_lines_and_odd_inputs(spark, odd):
    own = [" ".join(prose(k, 60)) for k in range(30)]
    rows = [(k, own[k] + "\nSame Line  here", "h") for k in range(30)]
    rows += [(100 + k, "boiler " * 2 + " ".join(prose(999, 70)) + f"\nx{k}", "h") for k in range(30)]
    rules = quality.Rules(line_docs=10, line_share=0.1)
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), rules=rules).collect()}
    assert all(got[k]["kept"] for k in range(30)) and got[5]["left_words"] == 60
    assert [k for k in range(100, 130) if got[k]["kept"]] == [100]
    more = [(k, t, "h", 0, "e") for k, t, _ in rows] + [(200, own[3] + "\nsame line here", "other", 0, "e"), (None, own[4] + " z\nSAME line here", "h", 0, "e")]
    df = spark.createDataFrame(more, "doc_id bigint, text string, source string, n_chars int, __hashes_of string")
    left = {r["doc_id"]: r for r in quality.keep(df, rules=rules).collect()}
    assert set(left) == {*range(30), 100, 200, None} and left[None]["text"] == more[-1][1]
    assert all(left[k]["text"] == own[k] and left[k]["n_chars"] == len(own[k]) for k in range(1, 30))
    assert left[0]["text"] == rows[0][1] and left[0]["n_chars"] == 0 and left[200]["text"] == more[-2][1]
    some, none = odd
    assert quality.judge(some).count() == len(ODD) and quality.judge(none).count() == 0
    assert not quality.keep(some).count() and quality.keep(none).count() == 0
    assert quality.describe(None)[:5] == (0, 0, 0, 0, 0)
    assert quality.repeated_words(b"a b c a b c".split()) == 6


def test_verdicts_are_per_text(spark):
    # Rows without an id or with one id, each with a text of its own.
    good, passage = [" ".join(prose(50 + k, 90)) for k in range(5)], prose(60, 80)
    rows = [(None, "short"), (None, good[0]), (1, "short"), (1, good[1]), (2, good[2]), (None, good[3]), (3, "other " + good[3])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("source", lm.F.lit("h"))
    kept = sorted((str(r["doc_id"]), r["text"]) for r in quality.keep(df).collect())
    assert kept == sorted((str(k), t) for k, t in rows if t != "short")
    bench = spark.createDataFrame([(1, " ".join(prose(53, 90)[20:40]))], "item_id bigint, text string")
    clean = sorted((str(r["doc_id"]), r["text"]) for r in decontam.clean(df, bench).collect())
    assert clean == sorted((str(k), t) for k, t in rows if good[3] not in t)
    two = [(1, " ".join(passage)), (2, "a " + " ".join(prose(61, 70) + passage)), (2, "b " + " ".join(passage + prose(62, 70))), (None, good[0])]
    cut = sorted((str(r["doc_id"]), r["text"].split()) for r in passages.cut(spark.createDataFrame(two, "doc_id bigint, text string")).collect())
    assert cut == sorted([("1", passage), ("2", ["a", *prose(61, 70)]), ("2", ["b", *prose(62, 70)]), ("None", good[0].split())])


def test_lines_count_distinct_documents(spark):
    # 40 rows of one document and one other share a line: two documents, no boilerplate.
    long = [" ".join(prose(900 + k, 60)) for k in range(12)]
    rows = [(1, long[0] + "\nshared line", "h")] * 40 + [(2, long[1] + "\nshared line", "h")]
    # A line in six documents of a small host is one, a line in five is not.
    rows += [(10 + k, long[2 + k] + "\nsix have it" + ("\nfive have it" if k < 5 else ""), "small") for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r["doc_id"]: r["text"] for r in quality.keep(df).collect()}
    assert got[1] == rows[0][1] and got[2] == rows[40][1] and quality.keep(df).count() == len(rows)
    assert got[10] == rows[41][1]
    assert all(got[10 + k] == rows[41 + k][1].replace("\nsix have it", "") for k in range(1, 6))


def test_clashing_names_keep_their_values(spark):
    extra = ["__maybe", "__id", "__hash", "__own", "__hashes", "__cut", "__spans", "__doc_id", "_rest", "given_id",
             "text_hash", "line", "rep", "digest", "bands", "items", "spans", "class_id", "n_words", "a", "b", "key"]
    shared = " ".join(prose(70, 90))
    texts = [shared, "x " + shared + " " + " ".join(prose(71, 80)), " ".join(prose(72, 90)), None, "", " ".join(prose(72, 90))]
    rows = [(k if k != 3 else None, t, "h", len(t or ""), *[f"{c}{k}" for c in extra]) for k, t in enumerate(texts)]
    names = ["doc_id bigint", "text string", "source string", "n_chars int", *[f"`{c}` string" for c in extra]]
    df = spark.createDataFrame(rows, ", ".join(names))
    bench = spark.createDataFrame([(1, " ".join(prose(72, 90)[:30]), "z")], "item_id bigint, text string, phrase string")
    made = {
        "keep": (quality.keep(df), [0, 1, 2, 5]), "dedupe": (bagminhash.dedupe(df), [0, 1, 2, 3, 4]),
        "cut": (passages.cut(df), [0, 1, 2, 3, 4]), "clean": (decontam.clean(df, bench), [0, 1, 3, 4]),
    }
    for name, (out, want) in made.items():
        assert out.columns == df.columns, name
        got = sorted(out.collect(), key=lambda r: r["a"])
        assert [r["a"] for r in got] == [f"a{k}" for k in want], name
        for k, r in zip(want, got, strict=True):
            assert [r[c] for c in extra] == [f"{c}{k}" for c in extra] and r["doc_id"] == rows[k][0], name
            if (name, k) != ("cut", 1):
                assert r["text"] == rows[k][1] and r["n_chars"] == rows[k][3], name
    cut = [r for r in made["cut"][0].collect() if r["doc_id"] == 1][0]
    assert shared not in cut["text"] and prose(71, 80)[5] in cut["text"] and cut["n_chars"] == len(cut["text"])


def test_chat_round_trip(spark):
    rng = random.Random(3)
    bits = ["<s>", "</s>", "[INST]", "<\\s>", "<", "\\", "[/INST]", "<+>", "<t>", "é", " ", "<\\\\+>", "\n"]
    rows = [
        (c, t, rng.choice(["user", "assistant", None, "a<t>b"]), rng.choice([None, "".join(rng.choices(bits, k=9))]), 1)
        for c in [*range(40), None] for t in rng.choices([0, 1, 2, 3, None], k=6)
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted int")
    want = collections.defaultdict(list)
    for c, t, role, text, _ in rows:
        want[c].append((t is not None, t or 0, role or "", text or ""))
    out = chat.format_chats(df)
    got = out.select("conv_id", chat.read_back(out["formatted"]).alias("t"), chat.loss_text(out["segments"]).alias("loss")).collect()
    assert len(got) == 41
    for r in got:
        turns = [(role, text) for *_, role, text in sorted(want[r["conv_id"]])]
        assert [tuple(t) for t in r["t"]] == turns
        assert r["loss"] == "".join(text for role, text in turns if role == "assistant")
    assert chat.format_chats(df.limit(0)).count() == 0


def test_ledger(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows or [(0, 'v', 'upsert', 's', 'en', 0)], "doc_id bigint, tokenizer string, action string, source string, lang string, n_tokens bigint")
    book = rollup.Ledger(spark, str(tmp_path / "l"))
    assert book.totals().count() == 0
    first = make([(1, "v", "upsert", "s", "en", 5), (1, "v", "upsert", "s", "en", 5), (2, "v", None, None, "en", None), (None, "v", "upsert", "s", "en", 1)])
    assert book.apply("_a/1", first) and not book.apply("_a/1", first)
    assert book.apply("b", make([(1, "v", "upsert", "t", "en", 7), (9, "v", "delete", None, None, None), (None, "v", "delete", None, None, None)]))
    got = {tuple(r) for r in rollup.Ledger(spark, str(tmp_path / "l")).totals().select("source", "n_docs", "n_tokens").collect()}
    assert got == {("t", 1, 7), (None, 1, 0)} and book.adds_up()
    # A driver that died while it wrote the commit of a batch.
    (tmp_path / "l" / "commits" / "bc" / "_temporary").mkdir(parents=True)
    late = make([(3, "v", "upsert", "s", "en", 4)]).selectExpr("*", "1 as new", "2 as old", "3 as live", "4 as _order")
    assert book.apply("c", late) and not book.apply("c", late)
    assert book.apply("empty", make([]).limit(0)) and book.adds_up()
    got = {tuple(r) for r in book.totals().select("source", "n_docs", "n_tokens").collect()}
    assert got == {("t", 1, 7), (None, 1, 0), ("s", 1, 4)}


def brute_windows(values, width):
    out = set()
    for i in range(len(values)):
        for j in range(i + width - 1, len(values)):
            out.add((i + int(np.argmin(values[i : j + 1])), i, j))
    return out


def test_compact_windows_cover_every_run_once():
    rng = np.random.default_rng(1)
    each = [rng.permutation(2**40)[:n].astype(np.uint64) if False else rng.integers(1, 2**60, n).astype(np.uint64) for n in (6, 9, 30, 57)]
    text, key, left, right = passages.compact_windows(each, 2, 6)
    for k, values in enumerate(each):
        mine = [(int(a), int(b)) for t, a, b in zip(text, left, right, strict=True) if t == k]
        salted = passages.mixed(values ^ passages.mixed(np.array([3], np.uint64))) >> np.uint64(1)
        places = {p for p, _, _ in brute_windows(salted, 6)}
        assert len(mine) == len(places)
        for i, j in ((i, j) for i in range(len(values)) for j in range(i + 5, len(values))):
            assert sum(a <= i and j <= b and a <= i + int(np.argmin(salted[i : j + 1])) <= b for a, b in mine) >= 1


def test_passages_find_and_cut(spark, odd):
    shared, near = prose(1, 80), prose(2, 90)
    changed = [*near[:40], "new", *near[41:]]
    rows = [(k, " ".join(prose(100 + k, 120) + shared + prose(200 + k, 30)), k) for k in range(12)]
    rows += [(50, " ".join(prose(300, 60) + near), 0), (51, " ".join(changed + prose(301, 60)), 0)]
    rows += [(70 + k, " ".join(prose(400 + k, 200)), 0) for k in range(20)]
    rows += [(99, " ".join(prose(500, 100) + shared[:30]), 0)]  # too short to count
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int")
    found = passages.find_passages(df).collect()
    text = {r[0]: r[1] for r in rows}
    assert {r["b"] for r in found} == {*range(1, 12), 51} and all(r["n_words"] >= 50 and r["similarity"] >= 0.8 for r in found)
    assert any(text[r["b"]][r["b_start"] : r["b_stop"]] == " ".join(shared) for r in found)
    cut = {r["doc_id"]: r for r in passages.cut(df).collect()}
    assert len(cut) == len(rows) and cut[0]["text"] == text[0] and cut[99]["text"] == text[99]
    assert all(" ".join(shared) not in cut[k]["text"] and prose(100 + k, 120)[0] in cut[k]["text"] for k in range(1, 12))
    some, none = odd
    assert passages.cut(some).count() == len(ODD) and passages.cut(none).count() == 0


def edited_copies(groups, size, n_words, edits):
    """Groups of copies of one passage with some words exchanged, each in text of its own."""
    rows, k = [], 0
    for g in range(groups):
        passage, rng = prose(7000 + g, n_words), random.Random(g)
        for i in range(size):
            own = list(passage)
            for at in rng.sample(range(5, n_words - 5), edits if i != 1 else 0):
                own[at] = f"edit{rng.randrange(10**9)}"
            rows.append((k, " ".join(prose(8000 + k, 60) + own + prose(9000 + k, 60))))
            k += 1
    return rows


def test_passages_all_partners_of_edited_copies(spark):
    # Copies are alike enough to the second of a group, but not to each other.
    rows = edited_copies(8, 40, 60, 1)
    hashes = WordHashes()
    shingles = [shingle_hashes(word_hashes(t, hashes)) for _, t in rows]
    want = set()
    for b, _ in rows:
        for a in range(b // 40 * 40, b):
            if passages.shared_passages(shingles[b], shingles[a], passages.DEFAULT):
                want.add(b)
                break
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["b"] for r in passages.find_passages(df).select("b").distinct().collect()}
    assert len(want) > 250 and len(want - got) <= 0.02 * len(want) and not got - want


def test_passages_directly_behind_each_other():
    hashes, mine = WordHashes(), []
    sh = lambda words: shingle_hashes(word_hashes(" ".join(words), hashes))
    each = [prose(30 + k, 60) for k in range(3)]
    a = [*each[2], *prose(40, 50), *each[0], *prose(41, 50), *each[1]]
    edited = [[*x[:30], f"new{k}", *x[31:]] for k, x in enumerate(each)]
    x, y, z = each
    for b, starts in (([*z, "u", "v", "w", *x, *y], (0, 63, 123)), ([*edited[0], *edited[1]], (0, 60)), ([*x, *edited[1]], (0, 60))):
        found = passages.shared_passages(sh(b), sh(a), passages.DEFAULT)
        mine.append([any(i <= s + 2 and j >= s + 53 for i, j, *_ in found) for s in starts])
        assert len(found) == len(set(found)) and all(f[4] >= 0.8 for f in found)
    assert mine == [[True] * 3, [True] * 2, [True] * 2]


def test_toxic_held_out(spark, odd):
    rng = random.Random(5)
    rows = []
    for k in range(600):
        words, bad = prose(1000 + k, rng.randrange(5, 80)), k % 5 == 0
        if bad:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["vilest", "slurred", "badword" + rng.choice("xyz")])
        rows.append((k, " ".join(words), int(bad)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    tagger = toxic.train(df.filter("doc_id < 400"), toxic.Settings(sample=200))
    got = {r["doc_id"]: r for r in toxic.tag(df, tagger).collect()}
    wrong = sum((got[k]["score"] >= 0.7) != bool(y) for k, _, y in rows[400:])
    assert wrong <= 4 and got[0]["spans"] and not got[1]["spans"]
    some, none = odd
    assert toxic.tag(some, tagger).count() == len(ODD) and toxic.tag(none, tagger).count() == 0
    assert toxic.train(none.selectExpr("doc_id", "text", "1 AS label")).prior == 0.5
    # jumping over gaps gives the marginals of the plain recursion
    b = np.zeros(300, np.int8)
    b[[40, 41, 120, 299]] = [3, 6, 5, 6]
    places, p, none_log = toxic.marginals(tagger.chain, b)
    odds, chain = tagger.chain.log_odds(b), tagger.chain
    alpha = [chain.start + np.array([0, odds[0]])]
    for t in range(1, 300):
        alpha.append(np.array([np.logaddexp(*(alpha[-1] + chain.move[:, s])) + (odds[t] if s else 0) for s in (0, 1)]))
    beta = [np.zeros(2)]
    for t in range(299, 0, -1):
        ahead = beta[0] + np.array([0, odds[t]])
        beta.insert(0, np.array([np.logaddexp(*(chain.move[s] + ahead)) for s in (0, 1)]))
    total = np.logaddexp(*alpha[-1])
    want = np.exp([alpha[t][1] + beta[t][1] - total for t in places])
    assert np.allclose(p, want) and np.isclose(none_log, chain.start[0] + 299 * chain.move[0, 0] - total)


def test_warc_segments(spark, tmp_path):
    rng = random.Random(2)
    big = "".join(rng.choice("abé<>\r\n中") for _ in range(3000))
    rows = [(1, "u\r\n v", big, 0), (2, None, None, 0), (3, "x", "", 0), (4, "x", "small", 0), (5, "x", "small", 0),
            (6, "x", big, 0), (None, "x", big, 0), (1, "u", big, 0), (8, "x", "y" * 5000 + "\r\n\r\nWARC/1.0", 0)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, block int")
    path = str(tmp_path / "w")
    warc.write_archives(df, path, segment_bytes=300, chunk_bytes=70, records_per_file=7)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(rows) and {r["status"] for r in got} == {"ok"}
    kept = {(r["page_id"], bytes(r["payload"])) for r in got if r["record_type"] == "response"}
    assert kept == {(r[0], (r[2] or "").encode()) for r in rows if r[0] not in (6, None)}
    for r in got:
        if r["page_id"] in (6, None):
            assert r["record_type"] == "revisit" and r["refers_to"] == 1
            assert r["payload_digest"] == hashlib.sha256(big.encode()).hexdigest()
    warc.write_archives(df.limit(0), path + "0")
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc")
    assert warc.unchunked(warc.chunked(b"x" * 1000, 7)) == b"x" * 1000


def test_bpe_against_library(spark, odd, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    theirs, rng = Tokenizer.from_file(path), random.Random(1)
    pool = "abcdefghinoprst'éèßıİΣσςſŉ\x1c\x85  \n\t12½²中ﬁ!#<|>😀"
    every = [*texts.values(), "", None, "a" * 300, "don't WE'LL 'S", "ΑΣ ΣΣ", "<|endoftext|>x<|startoftext|>'s"]
    every += ["".join(rng.choices(pool, k=40)) for _ in range(500)] + [r[1] for r in ODD]
    df = spark.createDataFrame(list(enumerate(every)), "doc_id bigint, text string")
    rows = bpe.encode(df, path).collect()
    want = theirs.encode_batch([t or "" for t in every], add_special_tokens=False)
    assert len(rows) == len(every)
    for r in rows:
        ids = want[r["doc_id"]].ids
        assert r["ids"] == ids and r["decoded"] == theirs.decode(ids, skip_special_tokens=False)
    again = bpe.decode(spark.createDataFrame([(1, [514, 10**6]), (2, None)], "doc_id bigint, ids array<int>"), path)
    assert {r["doc_id"]: r["decoded"] for r in again.collect()} == {1: theirs.decode([514]), 2: ""}
    assert bpe.encode(odd[1], path).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(4)
    for n, top in ((0, 10), (1, 1), (50, 60), (500, 10**9), (3000, 4000)):
        values = np.sort(rng.choice(top, n, replace=False)) if n else np.empty(0, np.int64)
        ef = eliasfano.EliasFano.of(values, top).open()
        ask = np.concatenate((values, rng.integers(0, top, 200)))
        place, found = ef.successor(ask)
        assert (place == np.searchsorted(values, ask)).all() and (found == np.isin(ask, values)).all()
        assert n == 0 or (ef.at(np.arange(n)) == values).all()


def test_language_model(spark, odd):
    train = [(k, " ".join(random.Random(k).choices(["a", "b", "c", "d", "e"], k=30))) for k in range(60)]
    test = [(1000, "A b"), (1001, "zzz a"), (1002, None), (1002, None)]
    df = spark.createDataFrame(train + test, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in lm.score(df, df["doc_id"] >= 1000).collect()}
    count = collections.Counter(w for _, t in train for w in [*t.split(), ""])
    total, kinds = sum(count.values()), len(count)
    base = lambda ws: sum(np.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws)
    assert got[1000]["train_tokens"] == total and got[1001]["n_known"] == 2 and got[1002]["n_tokens"] == 1
    for k, ws in ((1000, ["a", "b", ""]), (1001, ["zzz", "a", ""])):
        assert np.isclose(got[k]["base_score"], base(ws))
    # all next words together have probability 1 (codes are quantised)
    ends = spark.createDataFrame([(2000 + k, f"b {w}") for k, w in enumerate(["a", "b", "c", "d", "e", "zzz"])] + [(3000, "b")], "doc_id bigint, text string")
    s = {r["doc_id"]: r["score"] for r in lm.score(df.filter("doc_id < 1000").union(ends), lm.F.col("doc_id") >= 2000).collect()}
    first = s[3000]
    assert first < 0 and all(v < 0 for v in s.values())
    assert lm.score(odd[0], lm.F.lit(True)).count() == len(ODD) and lm.score(odd[1], lm.F.lit(False)).count() == 0


@pytest.mark.parametrize("frequent", [0, 4, 65_000])
def test_language_model_tells_rare_words_apart(spark, frequent):
    """Bigrams of words that no task holds count as they are, by a plain model in Python."""
    rng = random.Random(5)
    pool = [f"w{k}" for k in range(40)]
    train = [" ".join(rng.choices(pool, [60 / (k + 1) for k in range(40)], k=rng.randint(0, 40))) for _ in range(60)]
    train += ["red car blue sky"] * 3
    held = ["red car", "red sky", "blue car zzz w3 yyy", "w0 w1 w39 red car blue", "", "zzz yyy"]
    df = spark.createDataFrame(list(enumerate(train + held)), "doc_id bigint, text string").repartition(3)
    settings = lm.Settings(frequent=frequent, bundle=7, shard_tokens=100)
    got = {r["doc_id"]: r for r in lm.score(df, lm.F.col("doc_id") >= len(train), settings).collect()}
    counts = spark.createDataFrame(list(collections.Counter(w for t in train for w in lm.tokens(t)).items()), "word binary, n bigint")
    model = lm.unigrams(counts, settings)
    assert (len(model.words) == 0) == (frequent == 0) and (len(model.words) == model.distinct) == (frequent > 4)
    n = {bytes(r["word"]): r["n"] for r in counts.collect()}
    pairs = collections.Counter(p for t in train for p in itertools.pairwise([None, *lm.tokens(t)]))
    ahead, followers = collections.Counter(), collections.Counter()
    for (v, _), c in pairs.items():
        ahead[v], followers[v] = ahead[v] + c, followers[v] + 1
    short = [c for (v, _), c in pairs.items() if v is None or v in model.words]
    once, twice = short.count(1), short.count(2)
    d = once / (once + 2 * twice) if once and twice else 0.5

    def p(v, w):
        c, own = pairs[v, w], float(model.probability(n.get(w, 0)))
        if v is None or v in model.words:
            return max(c - d, 0) / ahead[v] + d * followers[v] / ahead[v] * own
        return (c + settings.prior * own) / (ahead[v] + settings.prior)

    for v in (None, b"red", b"w0", b"zzz"):  # all next words together, with one for the unseen
        assert np.isclose(sum(p(v, w) for w in [*n, b"?"]), 1)
    for k, text in enumerate(train + held):
        words = lm.tokens(text)
        want = sum(np.log10(p(v, w)) for v, w in itertools.pairwise([None, *words]))
        assert abs(got[k]["score"] - want) < (1e-9 if frequent == 0 else 0.02 * len(words)), (k, got[k]["score"], want)
        assert got[k]["n_known"] == sum(w in n for w in words)
        assert np.isclose(got[k]["base_score"], sum(float(model.base(n.get(w, 0))) for w in words))


def test_language_model_hashes(spark):
    words = [b"", b"a", "é😀".encode(), b"x" * 100]
    df = spark.createDataFrame([(w,) for w in words], "word binary")
    for salt in (b"", b"7"):
        got = df.select("word", lm.F.xxhash64(lm.F.concat(lm.F.lit(salt), "word"))).collect()
        assert {bytes(w): h % 2**64 for w, h in got} == {w: lm.word_hash(w, salt) for w in words}
    assert lm.salt_of(df) == b""


def test_bagminhash(spark, odd, texts):
    # registers agree as often as weighted Jaccard says
    a, b = {1: 5, 2: 1, 3: 8, 4: 1}, {1: 2, 2: 1, 3: 9, 5: 3}
    want = sum(min(a.get(k, 0), b.get(k, 0)) for k in {*a, *b}) / sum(max(a.get(k, 0), b.get(k, 0)) for k in {*a, *b})
    doc = np.array([0] * len(a) + [1] * len(b))
    element = passages.mixed(np.array([*a, *b], np.uint64))
    sign = bagminhash.signatures(doc, element, np.array([*a.values(), *b.values()]), 3, 4096)
    assert abs((sign[0] == sign[1]).mean() - want) < 0.03 and not sign[2].any()
    hashes = WordHashes()
    bags = {k: np.sort(shingle_hashes(word_hashes(t, hashes))) for k, t in texts.items()}
    root = {k: k for k in bags}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(bags)
    for i, x in enumerate(ids):
        for y in ids[i + 1 :]:
            if 0.8 * len(bags[y]) <= len(bags[x]) <= len(bags[y]) / 0.8 and bagminhash.overlap(bags[x], bags[y]) >= 0.8:
                p, q = sorted((top(x), top(y)))
                root[q] = p
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.classes(df).collect()}
    assert got == {k: top(k) for k in bags}
    some, none = odd
    classes = [(r["doc_id"], r["class_id"]) for r in bagminhash.classes(some).collect()]
    assert len(classes) == len(ODD) and (6, 3) in classes and (2, 2) in classes and (None, None) in classes
    assert bagminhash.dedupe(some).count() == len(ODD) - 1 and bagminhash.classes(none).count() == 0


def test_more_links_join_known_classes(spark):
    link = lambda *pairs: spark.createDataFrame(pairs, "a bigint, b bigint")
    roots = components(link((1, 2), (2, 3), (4, 5), (7, 8)), "t")
    more = joined_components(roots, link((3, 5), (9, 10), (5, 11), (7, 8)), "t")
    got = sorted((r["node"], r["root"]) for r in more.collect())
    assert got == [*((k, 1) for k in (1, 2, 3, 4, 5)), (7, 7), (8, 7), (9, 9), (10, 9), (11, 1)]


def test_bagminhash_compares_members_of_one_class_once(spark, monkeypatch):
    compared, plain, n = [], bagminhash.verify, 60
    monkeypatch.setattr(bagminhash, "verify", lambda pairs, *a: compared.append(pairs.count()) or plain(pairs, *a))
    words = prose(400, 77)
    rows = [(k, " ".join(words[: 5 * k] + [f"edit{k}"] + words[5 * k + 1 :])) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["class_id"] for r in bagminhash.classes(df).collect()} == {0}
    assert sum(compared) < 2 * n  # 172 where all of a bucket were compared


def test_bagminhash_twins_in_a_template(spark):
    # Pages of one template are 0.77 to each other, a twin is 0.83 to its page.
    template, rows = prose(70, 204), []
    tail = lambda k: [f"own{k}x{i}" for i in range(30)]
    rows += [(k, " ".join(template + tail(k))) for k in range(400)]
    rows += [(1000 + k, " ".join(template + tail(k)[:8] + tail(1000 + k)[:22])) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.classes(df).collect()}
    lost = [k for k in range(200) if got[1000 + k] != k]
    assert not lost and all(got[k] == k for k in range(400))


def test_bagminhash_prefixes_lose_no_pair(spark):
    rng = random.Random(11)
    bags = {}
    for k in range(240):
        base = bags[rng.choice(list(bags))] if k % 3 and bags else np.array([rng.randrange(60) for _ in range(rng.randint(3, 50))], np.uint64)
        some = [x for x in base.tolist() if rng.random() > 0.08] + [rng.randrange(60) for _ in range(rng.randint(0, 3))]
        bags[k] = np.sort(np.array(some or [1], np.uint64))
    df = spark.createDataFrame([(k, b.tobytes(), k) for k, b in bags.items()], "doc_id bigint, bag binary, root bigint")
    near = bagminhash.prefixes(df, 0.8).join(df.select(F.col("doc_id").alias("doc"), "root"), "doc")
    got = {(r["a"], r["b"]) for r in bagminhash.class_pairs(near, 0.8).collect()}
    want = {(x, y) for x in bags for y in bags if x < y and bagminhash.overlap(bags[x], bags[y]) >= 0.8}
    assert want <= got and len(got) < 240 * 239 / 4 and len(want) > 30


def test_decontamination_blocks_and_spans(spark, odd):
    item = prose(7, 14)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "Short, one!"), (3, None), (4, " ..."), (5, " ".join(prose(8, 30)))], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "X, " + "! ".join(w.upper() for w in item) + ". end"), (2, " ".join(item[:9])), (3, "a SHORT one é"), (4, None)], "doc_id bigint, text string")
    one = decontam.find_contamination(docs, bench)
    got = {r["doc_id"]: r for r in one.collect()}
    assert (got[1]["n_hit"], got[1]["items"]) == (14, [1]) and got[2]["n_hit"] == 0 and got[3]["items"] == [2]
    span = got[3]["spans"][0]
    assert "a SHORT one é"[span["start"] : span["stop"]] == "SHORT one"
    many = decontam.find_contamination(docs, bench, block_chars=200)
    key = lambda df: sorted(str(r) for r in df.collect())
    assert key(one) == key(many)
    assert {r["doc_id"] for r in decontam.clean(docs, bench).collect()} == {2, 4}
    assert decontam.find_contamination(odd[0], bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontam.find_contamination(odd[1], bench).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SMALL)
    assert 0 < out.count() < spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "decontaminate", "encode"]
