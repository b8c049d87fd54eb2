"""Lexicon matching: exact phrases, misspellings, patterns, negation.

All of it is row-local column work over small literal word lists. Nothing is
exploded or shuffled on the scoring path, so the cost is linear in the text and
no hot word or hot source can pile up in one task. Only the corpus-wide reports
(``guard_report``, ``mine_collisions``) aggregate, and those count tokens with
plain sums that combine before the shuffle.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voicelane.config import scratch_path
from voicelane.functions import text as tx
from voicelane.functions.edits import edit_budget, within_edits
from voicelane.functions.fence import computed_once
from voicelane.lexicon import DEFAULT_LEXICON, Lexicon
from voicelane.operators.neighbours import near_terms

#: Pairs of misspelt token and term that are sent to all tasks.
BROADCAST_PAIRS = 1_000_000


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_list(values) -> str:
    return ", ".join(sql_string(v) for v in values)


def _string_array(values) -> Column:
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>")


def _pieces(term: str, budget: int) -> tuple[str, str, str]:
    """Head, middle and tail of a term, one unused letter between them.

    ``budget`` edits can spoil at most ``budget`` of ``budget + 1`` pieces: the
    gaps keep a swap from touching two. So a misspelling always starts with the
    head, ends with the tail, or (budget 2) contains the middle.
    """
    count = budget + 1
    letters = len(term) - budget
    sizes = [letters // count + (1 if i >= count - letters % count else 0) for i in range(count)]
    found, at = [], 0
    for size in sizes:
        found.append(term[at : at + size])
        at += size + 1
    return found[0], found[1] if budget == 2 else "#", found[-1]


def _terms_by_length(terms: list[tuple[str, int]]) -> str:
    """SQL literal array: entry L lists the terms a token of length L can be close to."""
    top = max((len(t) + b for t, b in terms), default=0)
    rows = {
        t: dict(zip(("head", "middle", "tail"), _pieces(t, b)), term=t, budget=b)
        for t, b in terms
    }
    table = [
        [rows[t] for t, b in terms if abs(len(t) - n) <= b] for n in range(top + 1)
    ]
    fields = "head:string,middle:string,tail:string,term:string,budget:int"
    return f"from_json({sql_string(json.dumps(table))}, 'array<array<struct<{fields}>>>')"


def _close(token: str, x: str = "x") -> str:
    """SQL: is the token within budget of table entry x? The cheap tests come first."""
    return (
        f"((startswith({token}, {x}.head) OR endswith({token}, {x}.tail) "
        f"OR contains({token}, {x}.middle)) "
        f"AND {within_edits(token, f'{x}.term', f'{x}.budget')})"
    )


def _reachable(token: str, terms: list[tuple[str, int]]) -> str:
    near = f"filter(get({_terms_by_length(terms)}, length({token})), x -> {_close(token)})"
    return f"transform({near}, x -> x.term)"


def reachable_terms(token: str, terms: list[tuple[str, int]]) -> Column:
    """The terms a token column is within budget of, in list order (null if none)."""
    return F.expr(_reachable(token, terms))


def _is_close_to_any(token: str, terms: list[tuple[str, int]]) -> str:
    return f"exists(get({_terms_by_length(terms)}, length({token})), x -> {_close(token)})"


def typos(tokens: str, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """array<struct<token, terms>>: tokens close to lexicon terms, in text order.

    Real words on the guard list are never taken for misspellings.
    """
    terms = lexicon.fuzzy_terms()
    plausible = _is_close_to_any("t", terms)
    if lexicon.guard:
        plausible += f" AND t NOT IN ({_sql_list(lexicon.guard)})"
    survivors = f"filter(array_distinct({tokens}), t -> {plausible})"
    pair = f"named_struct('token', t, 'terms', {_reachable('t', terms)})"
    return F.expr(f"transform({survivors}, t -> {pair})")


def _phrases(terms: tuple[str, ...]) -> Column:
    """Literal array<struct<term, fuzzy>> in list order."""
    rows = [{"term": t, "fuzzy": edit_budget(t) > 0} for t in terms]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<term:string,fuzzy:boolean>>")


def group_hits(norm: Column, typo_list: Column, terms: tuple[str, ...]) -> Column:
    """Hits of one phrase list in list order, each reported once.

    A phrase counts if it occurs anywhere in the normalised text, also inside a
    longer word. Only without such an occurrence is its first misspelling in the
    text taken, reported as typed; members of the same list are not misspellings.
    """
    if not terms:
        return F.array().cast("array<string>")
    usable = F.filter(typo_list, lambda x: ~x["token"].isin(*terms))

    def hit(phrase: Column) -> Column:
        first = F.get(
            F.filter(usable, lambda x: F.array_contains(x["terms"], phrase["term"])), F.lit(0)
        )
        return F.when(norm.contains(phrase["term"]), phrase["term"]).when(
            phrase["fuzzy"], first["token"]
        )

    return F.array_distinct(F.array_compact(F.transform(_phrases(terms), hit)))


def exact_hits(norm: Column, terms: tuple[str, ...]) -> Column:
    """The phrases that occur in the normalised text, in list order."""
    return F.filter(_string_array(terms), lambda t: norm.contains(t))


def _contains_any(norm: Column, needles: tuple[str, ...]) -> Column:
    return reduce(or_, [norm.contains(n) for n in needles])


def pattern_hits(norm: Column, patterns: tuple[tuple[tuple[str, ...], str], ...]) -> Column:
    """What each pattern matched first, in pattern order.

    Patterns come as (needles, regex). Every match contains one of the needles, so
    texts without any skip the regex.
    """
    if not patterns:
        return F.array().cast("array<string>")
    found = [
        F.when(_contains_any(norm, needles), F.regexp_extract(norm, regex, 0)).otherwise("")
        for needles, regex in patterns
    ]
    return F.filter(F.array(*found), lambda m: m != "")


def free_tokens(
    clauses: str, lexicon: Lexicon = DEFAULT_LEXICON, among: str | None = None
) -> Column:
    """Distinct tokens with an occurrence that no negator of its clause reaches.

    ``among`` names an array of the only tokens that are asked for.
    """
    reach = lexicon.negation_window
    before = f"slice(c, greatest(i - {reach}, 0) + 1, least(i, {reach}))"
    negated = f"arrays_overlap({before}, array({_sql_list(lexicon.negators)}))"
    asked = f"array_contains({among}, t) AND " if among else ""
    unreached = f"transform({clauses}, c -> filter(c, (t, i) -> {asked}NOT {negated}))"
    return F.expr(f"array_distinct(flatten({unreached}))")


def _is_negatable(hit: str, lexicon: Lexicon) -> str:
    """SQL: listed terms, and misspellings of one-word ones that are not real words."""
    single = [(t, edit_budget(t)) for t in lexicon.negatable if edit_budget(t) > 0]
    barred = f"contains({hit}, ' ')"
    if lexicon.guard:
        barred += f" OR {hit} IN ({_sql_list(lexicon.guard)})"
    close = f"coalesce({_is_close_to_any(hit, single)}, false)"
    return f"({hit} IN ({_sql_list(lexicon.negatable)}) OR (NOT ({barred}) AND {close}))"


def surviving_churn(
    df: DataFrame, hits: str, into: str, lexicon: Lexicon = DEFAULT_LEXICON
) -> DataFrame:
    """Add churn hits without those negatable ones that are negated wherever they occur.

    ``df`` comes from ``prepare``. A hit is located by its first word as a whole
    token; one found only inside longer words has no location and always stays. The
    clause work is done only for reviews that have a hit to test, once for all of them
    and for their first words only.
    """
    if not lexicon.negatable:
        return df.withColumn(into, F.col(hits))
    head = "split_part(h, ' ', 1)"
    tested = F.expr(f"filter({hits}, h -> {_is_negatable('h', lexicon)} AND array_contains(tokens, {head}))")
    clause_list = F.when(F.size("_tested") > 0, tx.clauses(F.col("norm")))
    out = df.withColumn("_tested", tested)
    out = out.withColumn("_heads", F.expr(f"transform(_tested, h -> {head})")).withColumn("_clauses", clause_list)
    # A column of its own: inside the filter below it would be made again for every hit.
    out = computed_once(out, "_free", free_tokens("_clauses", lexicon, "_heads"))
    negated = f"array_contains(_tested, h) AND NOT array_contains(_free, {head})"
    return out.withColumn(into, F.expr(f"filter({hits}, h -> NOT ({negated}))")).drop(
        "_tested", "_heads", "_clauses", "_free"
    )


def prepare(
    df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON, text: str = "text"
) -> DataFrame:
    """Add ``norm``, ``tokens`` and ``typos``, the inputs of every matcher below.

    A column ``_norm`` of an earlier step is taken as the normalised text.
    """
    norm = F.col("_norm") if "_norm" in df.columns else tx.normalize(F.col(text))
    return (
        df.withColumn("norm", norm)
        .withColumn("tokens", tx.tokens(F.col("norm")))
        .withColumn("typos", typos("tokens", lexicon))
    )


def match_exact(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """Long table of exact phrase hits: review_id, group, term."""
    norm = df.select("review_id", tx.normalize(F.col("text")).alias("norm"))
    per_group = [
        F.struct(F.lit(g).alias("group"), exact_hits(F.col("norm"), terms).alias("terms"))
        for g, terms in lexicon.groups().items()
    ]
    return (
        norm.select("review_id", F.inline(F.array(*per_group)))
        .select("review_id", "group", F.explode("terms").alias("term"))
    )


def match_fuzzy(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """Long table of misspellings: review_id, token, term.

    Distinct tokens meet the terms by their deletions, so a lexicon may have a hundred
    thousand terms; the few tokens found are then looked up in the reviews.
    """
    spark, rows = df.sparkSession, lexicon.fuzzy_terms()
    terms = spark.createDataFrame(rows, "term string, budget int")
    tokens = distinct_tokens(df, *_length_span(lexicon)) if rows else token_counts(df).limit(0)
    if lexicon.guard:
        tokens = tokens.filter(~F.col("token").isin(*lexicon.guard))
    path = scratch_path(spark, "near-tokens")
    near_terms(tokens.select("token"), terms).write.parquet(path)
    found = spark.read.parquet(path)
    if found.count() <= BROADCAST_PAIRS:  # else both sides are shuffled
        found = F.broadcast(found)
    listed = _tokens_between(df, *_length_span(lexicon)) if rows else F.array().cast("array<string>")
    return (
        df.select("review_id", F.explode(F.array_distinct(listed)).alias("token"))
        .join(found, "token")
        .select("review_id", "token", "term")
    )


def match_lexicon(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """review_id with one ordered hit list for each group, before negation."""
    norm, typo_list = F.col("norm"), F.col("typos")
    return prepare(df, lexicon).select(
        "review_id",
        *[group_hits(norm, typo_list, t).alias(g) for g, t in lexicon.groups().items()],
    )


def churn_after_negation(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """review_id, churn hits before and after negation."""
    before = prepare(df, lexicon).withColumn(
        "churn", group_hits(F.col("norm"), F.col("typos"), lexicon.churn)
    )
    return surviving_churn(before, "churn", "kept", lexicon).select(
        "review_id", "churn", "kept"
    )


def negation_scope(
    df: DataFrame, heads: tuple[str, ...], lexicon: Lexicon = DEFAULT_LEXICON
) -> DataFrame:
    """review_id, head, negated: for each head word that occurs in the review."""
    clause_list = tx.clauses(tx.normalize(F.col("text")))
    split = computed_once(df.select("review_id", "text"), "clauses", clause_list)
    seen = (
        split.select(
            "review_id",
            "clauses",
            F.array_intersect(_string_array(heads), F.flatten("clauses")).alias("heads"),
        )
        .filter(F.size("heads") > 0)
        .withColumn("free", free_tokens("clauses", lexicon))
    )
    return seen.select("review_id", "free", F.explode("heads").alias("head")).select(
        "review_id", "head", (~F.array_contains("free", F.col("head"))).alias("negated")
    )


def _tokens_between(df: DataFrame, shortest: int = 1, longest: int | None = None) -> Column:
    norm = F.col("_norm") if "_norm" in df.columns else tx.normalize(F.col("text"))
    return F.filter(
        tx.tokens(norm),
        lambda t: (F.length(t) >= shortest)
        & (F.length(t) <= longest if longest else F.lit(True)),
    )


def token_counts(df: DataFrame, shortest: int = 1, longest: int | None = None) -> DataFrame:
    """token, n over all reviews. Plain sums: hot words combine before the shuffle."""
    return (
        df.select(F.explode(_tokens_between(df, shortest, longest)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def distinct_tokens(df: DataFrame, shortest: int = 1, longest: int | None = None) -> DataFrame:
    """The tokens of all reviews, each once."""
    return token_counts(df, shortest, longest).select("token")


def _near_pairs(counts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """token, n, group, term for every token within budget of a term of the group."""
    spark = counts.sparkSession
    rows = [r for r in lexicon.term_rows() if r[3] > 0]
    terms = spark.createDataFrame(rows, "group string, term string, ord int, budget int")
    members = spark.createDataFrame(
        [r[:2] for r in lexicon.term_rows()], "group string, token string"
    ).distinct().withColumn("member", F.lit(True))
    # The counts are read twice, by the join and for the figures of what it found.
    path = scratch_path(spark, "token-counts")
    counts.write.parquet(path)
    counts = spark.read.parquet(path)
    pairs = near_terms(counts.select("token"), terms.select("term", "budget").distinct())
    return (
        pairs.join(counts.hint("merge"), "token")  # all tokens of the corpus: not to be sent
        .join(terms.select("group", "term").distinct(), "term")
        .join(members, ["group", "token"], "left")
        .select("token", "n", "group", F.coalesce("member", F.lit(False)).alias("member"), "term")
    )


def _length_span(lexicon: Lexicon) -> tuple[int, int]:
    spans = [(len(t) - b, len(t) + b) for t, b in lexicon.fuzzy_terms()]
    return min(s[0] for s in spans), max(s[1] for s in spans)


def guard_report(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """token, group, term, n, verdict for every token of the corpus near a term.

    The verdict says whether the fuzzy matcher may use the pair: ``member`` of the
    group's own list, ``guarded`` real word, or ``typo``.
    """
    pairs = _near_pairs(token_counts(df, *_length_span(lexicon)), lexicon)
    verdict = (
        F.when(F.col("member"), "member")
        .when(F.col("token").isin(*lexicon.guard), "guarded")
        .otherwise("typo")
    )
    return pairs.select("token", "group", "term", "n", verdict.alias("verdict"))


def mine_collisions(
    df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON, min_count: int = 25
) -> DataFrame:
    """Words frequent enough to be real that sit within budget of a lexicon term."""
    counts = token_counts(df, *_length_span(lexicon)).filter(F.col("n") >= min_count)
    pairs = _near_pairs(counts, lexicon)
    return pairs.filter(~F.col("member")).select("token", "group", "term", "n")
