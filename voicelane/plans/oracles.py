"""The catalog's queries as SQL for an independent engine (DuckDB dialect)."""

from __future__ import annotations

import string

from voicelane.lexicon import DEFAULT_LEXICON as LEX
from voicelane.operators import typos as ty
from voicelane.operators.model import PROBE_TEXTS
from voicelane.operators.threshold import Assumptions, default_grid
from voicelane.plans import catalog as cat
from voicelane.plans import studies

WS = (r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
      r"\x{202f}\x{205f}\x{3000}")


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def str_list(values) -> str:
    return "[" + ", ".join(quote(v) for v in values) + "]"


def num(value: float) -> str:
    """A DOUBLE literal with the exact value."""
    text = repr(float(value))
    return text if "e" in text else text + "e0"


def norm(x: str) -> str:
    out = f"regexp_replace(lower({x}), '<[^>]+>', ' ', 'g')"
    out = f"regexp_replace({out}, '[’''`´]', '', 'g')"
    for c in string.ascii_lowercase:
        out = f"regexp_replace({out}, '{c}{{3,}}', '{c}{c}', 'g')"
    return f"trim(regexp_replace({out}, '[{WS}]+', ' ', 'g'))"


def unit(x: str, start: int = 1) -> str:
    return f"(('0x' || substr({x}, {start}, 8))::BIGINT / 4294967296e0)"


def hexint(x: str, start: int) -> str:
    return f"('0x' || substr({x}, {start}, 8))::BIGINT"


def pseudo(label: str = "label", salt: str = "") -> str:
    key = f"review_id || '|' || {quote(salt)}" if salt else "review_id::VARCHAR"
    base = f"(CASE WHEN {label} = 0 THEN 0.35e0 ELSE 0.05e0 END)"
    return f"({base} + 0.6e0 * {unit(f'md5({key})')})"


def exact3(x: str, digits: int = 3) -> str:
    return f"CAST(printf('%.{digits}f', {x}) AS DOUBLE)"


DOCS = "docs AS (SELECT doc_id AS review_id, text FROM documents)"
SEEDED = (
    "docs AS (SELECT doc_id AS review_id, text || '. ' || list_extract("
    f"{str_list(cat.SENTENCES)}, CAST(doc_id % {len(cat.SENTENCES)} AS INT) + 1) AS text "
    "FROM documents)"
)
PROBES = (
    "docs AS (SELECT * FROM (VALUES "
    + ", ".join(f"({no}::BIGINT, {quote(text)})" for no, text in enumerate(PROBE_TEXTS))
    + ") AS probes(review_id, text))"
)
TURNS = f"docs AS (SELECT conv_id * {cat.TURN_IDS} + turn AS review_id, text FROM conversations)"
NORMED = f"normed AS (SELECT review_id, {norm('text')} AS norm FROM docs)"
LABELLED = (
    "labelled AS (SELECT d.doc_id AS review_id, d.text, l.quality AS label, CASE WHEN "
    + hexint("md5(d.doc_id || '|split')", 1)
    + " % 2 = 0 THEN 'train' ELSE 'test' END AS split "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
)
SCORED = f"scored AS (SELECT review_id, label, {pseudo()} AS p_negative FROM labelled)"

LEXTABLE = "lex(term_group, term, ord, budget) AS (VALUES " + ", ".join(
    f"({quote(g)}, {quote(t)}, {o}, {b})" for g, t, o, b in LEX.term_rows()
) + ")"
TOKENS = (
    "toks AS (SELECT review_id, unnest(t) AS token, "
    "unnest(range(len(t))) AS pos FROM (SELECT review_id, "
    "regexp_extract_all(norm, '[a-z]+') AS t FROM normed))"
)
GUARD = f"{str_list(LEX.guard)}"
PAIRS = (
    "words AS (SELECT DISTINCT token FROM toks), "
    "fuzzy AS (SELECT DISTINCT term, budget FROM lex WHERE budget > 0), "
    "pairs AS (SELECT token, term FROM words JOIN fuzzy ON "
    "abs(length(token) - length(term)) <= budget "
    "AND damerau_levenshtein(token, term) <= budget)"
)
EXACT = (
    "exact AS (SELECT review_id, term_group, term, ord FROM normed, lex "
    "WHERE contains(norm, term))"
)
HITS = (
    f"{EXACT}, loose AS (SELECT t.review_id, l.term_group, l.term, l.ord, "
    "arg_min(t.token, t.pos) AS hit FROM toks t JOIN pairs p ON t.token = p.token "
    "JOIN lex l ON l.term = p.term "
    f"WHERE NOT list_contains({GUARD}, t.token) "
    "AND NOT EXISTS (SELECT 1 FROM lex m WHERE m.term_group = l.term_group "
    "AND m.term = t.token) "
    "AND NOT EXISTS (SELECT 1 FROM exact e WHERE e.review_id = t.review_id "
    "AND e.term_group = l.term_group AND e.term = l.term) "
    "GROUP BY ALL), "
    "hits AS (SELECT review_id, term_group, hit, min(ord) AS ord FROM ("
    "SELECT review_id, term_group, term AS hit, ord FROM exact UNION ALL "
    "SELECT review_id, term_group, hit, ord FROM loose) GROUP BY ALL)"
)
CLAUSES = (
    "parts AS (SELECT review_id, list_filter(string_split_regex(norm, '[.!?;,]+'), "
    "lambda c: trim(c) <> '') AS c FROM normed), "
    "clause AS (SELECT review_id, unnest(c) AS clause, unnest(range(len(c))) AS clause_no "
    "FROM parts), "
    "ctoks AS (SELECT review_id, clause_no, unnest(t) AS token, unnest(range(len(t))) AS pos "
    "FROM (SELECT review_id, clause_no, regexp_extract_all(clause, '[a-z]+') AS t "
    "FROM clause))"
)
NEGATED = (
    f"{CLAUSES}, flagged AS (SELECT review_id, token, coalesce(max(CASE WHEN list_contains("
    f"{str_list(LEX.negators)}, token) THEN 1 ELSE 0 END) OVER (PARTITION BY review_id, "
    f"clause_no ORDER BY pos ROWS BETWEEN {LEX.negation_window} PRECEDING AND 1 PRECEDING), 0) "
    "AS neg FROM ctoks), "
    "scope AS (SELECT review_id, token AS head, min(neg) = 1 AS negated FROM flagged "
    "GROUP BY ALL)"
)
SINGLE = str_list(t for t in LEX.negatable if " " not in t)
NEGATABLE = (
    f"(list_contains({str_list(LEX.negatable)}, hit) OR (NOT contains(hit, ' ') "
    f"AND NOT list_contains({GUARD}, hit) AND EXISTS (SELECT 1 FROM pairs p "
    f"WHERE p.token = hit AND list_contains({SINGLE}, p.term))))"
)
KEPT = (
    f"{NEGATED}, kept AS (SELECT h.review_id, h.hit, h.ord FROM hits h LEFT JOIN scope s "
    "ON s.review_id = h.review_id AND s.head = split_part(h.hit, ' ', 1) "
    f"WHERE h.term_group = 'churn' AND NOT ({NEGATABLE} AND coalesce(s.negated, false)))"
)
PATTERNS = (
    "found AS (SELECT review_id, list_filter(["
    + ", ".join(f"regexp_extract(norm, {quote(p)}, 0)" for _, p in LEX.patterns)
    + "], lambda m: m <> '') AS m FROM normed)"
)
SHOUT = (
    "loud AS (SELECT review_id, least(1e0, bangs / 3e0 * 0.5e0 + "
    "(CASE WHEN len(w) > 0 THEN len(list_filter(w, lambda x: x = upper(x))) / len(w)::DOUBLE "
    "ELSE 0e0 END) * 5e0 * 0.5e0) AS intensity FROM (SELECT review_id, "
    "(length(text) - length(replace(text, '!', '')))::DOUBLE AS bangs, "
    "regexp_extract_all(text, '[A-Za-z]{3,}') AS w FROM docs))"
)
CHURN = (
    "churn_all AS (SELECT review_id, hit, min(ord) AS ord FROM ("
    "SELECT review_id, hit, ord FROM kept UNION ALL "
    "SELECT review_id, unnest(m), 1000 + unnest(range(len(m))) FROM found) GROUP BY ALL), "
    "signal AS (SELECT review_id, 'churn' AS kind, hit, ord FROM churn_all UNION ALL "
    "SELECT review_id, term_group, hit, ord FROM hits WHERE term_group <> 'churn')"
)
LISTS = (
    "lists AS (SELECT d.review_id, "
    + ", ".join(
        f"coalesce(string_agg(hit, '|' ORDER BY ord) FILTER (kind = '{k}'), '') AS {k}_text, "
        f"count(*) FILTER (kind = '{k}') AS {k}_n"
        for k in LEX.groups()
    )
    + " FROM docs d LEFT JOIN signal s ON s.review_id = d.review_id GROUP BY d.review_id)"
)
URGENT = (
    "urgent AS (SELECT review_id, churn_text AS churn_phrases, money_text AS money_phrases, "
    f"anger_text AS anger_words, {exact3('intensity')} AS intensity, "
    + exact3(
        "least(1e0, 0.45e0 * least(1e0, churn_n::DOUBLE) + 0.3e0 * least(1e0, money_n::DOUBLE) "
        "+ 0.15e0 * least(1e0, anger_n / 2e0) + 0.1e0 * intensity)"
    )
    + " AS urgency FROM lists JOIN loud USING (review_id))"
)
RULES = ", ".join(
    [NORMED, LEXTABLE, TOKENS, PAIRS, HITS, KEPT, PATTERNS, SHOUT, CHURN, LISTS, URGENT]
)


def route_sql(p: str, u: str, neg: float = 0.5, urg: float = 0.4, floor: float = 0.1) -> str:
    return (
        f"CASE WHEN {u} >= {num(urg)} AND {p} >= {num(floor)} THEN 'support_urgent' "
        f"WHEN {p} >= {num(neg)} THEN 'feedback_backlog' ELSE 'analytics' END"
    )


TRIAGED = (
    f"scores AS (SELECT *, {pseudo('NULL')} AS p FROM urgent), "
    f"triaged AS (SELECT review_id, {exact3('p', 4)} AS p_negative, urgency, "
    f"{route_sql('p', 'urgency')} AS route FROM scores)"
)


def word_grams(src: str, out: str) -> str:
    """Word uni- and bigram occurrences."""
    return (
        f"{out}_w AS (SELECT review_id, regexp_extract_all(norm, '[\\p{{L}}\\p{{N}}_]{{2,}}') "
        f"AS w FROM {src}), "
        f"{out} AS (SELECT review_id, unnest(w) AS term FROM {out}_w UNION ALL "
        f"SELECT review_id, unnest(list_transform(range(1, len(w)), "
        f"lambda i: w[i] || ' ' || w[i + 1])) FROM {out}_w)"
    )


def char_grams(src: str, out: str) -> str:
    """Character 3- to 5-gram occurrences inside padded words."""
    grams = " UNION ALL ".join(
        f"SELECT review_id, unnest(list_transform(range(1, length(p) - {n} + 2), "
        f"lambda i: substr(p, i, {n}))) AS term FROM {out}_p"
        for n in (3, 4, 5)
    )
    return (
        f"{out}_p AS (SELECT review_id, ' ' || unnest(string_split(norm, ' ')) || ' ' AS p "
        f"FROM {src} WHERE norm <> ''), {out} AS ({grams})"
    )


def vocab_cte(block: str, grams: str, out: str, min_df: int) -> str:
    return (
        f"{out}_c AS (SELECT term, count(*) AS tf, count(DISTINCT review_id) AS df "
        f"FROM {grams} GROUP BY term HAVING count(DISTINCT review_id) >= {min_df}), "
        f"{out} AS (SELECT '{block}' AS block, term, tf, df, "
        f"row_number() OVER (ORDER BY term) - 1 AS feature_id FROM "
        f"(SELECT * FROM {out}_c ORDER BY tf DESC, term LIMIT 50000))"
    )


def idf_cte(n_source: str = "docs") -> str:
    """idf with joint ids over both vocabularies."""
    return (
        "idfs AS (SELECT block, term, tf, df, feature_id, feature_id + CASE WHEN block = 'char' "
        "THEN (SELECT count(*) FROM vw) ELSE 0 END AS joint_id, "
        f"ln((1e0 + (SELECT count(*) FROM {n_source})) / (1e0 + df)) + 1e0 AS idf "
        "FROM (SELECT * FROM vw UNION ALL SELECT * FROM vc))"
    )


def vocabulary(source: str) -> str:
    """Vocabulary of a table aliased docs, named apart so that it can differ from docs."""
    return ", ".join(
        [
            source.replace("docs AS", "corpus AS", 1),
            NORMED.replace("normed AS", "cnormed AS", 1).replace("FROM docs", "FROM corpus"),
            word_grams("cnormed", "cw"),
            char_grams("cnormed", "cc"),
            vocab_cte("word", "cw", "vw", 2),
            vocab_cte("char", "cc", "vc", 3),
            idf_cte("corpus"),
        ]
    )


def weights(grams_w: str, grams_c: str) -> str:
    return (
        "tfs AS (SELECT review_id, 'word' AS block, term, count(*) AS tf FROM "
        f"{grams_w} GROUP BY ALL UNION ALL SELECT review_id, 'char', term, count(*) FROM "
        f"{grams_c} GROUP BY ALL), "
        "raws AS (SELECT t.review_id, t.block, i.feature_id, i.joint_id, i.term, "
        "(1e0 + ln(t.tf)) * i.idf AS raw FROM tfs t JOIN idfs i ON t.block = i.block "
        "AND t.term = i.term), "
        "weights AS (SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY review_id, block)) "
        "AS weight FROM raws)"
    )


def coef(salt: str) -> str:
    return f"(({unit(f'''md5(block || '|' || term || '|{salt}')''')} - 0.5e0) * 4e0)"


def margins(salt: str, out: str) -> str:
    return (
        f"{out} AS (SELECT d.review_id, 1e0 - 1e0 / (1e0 + exp(-({num(cat.INTERCEPT)} + "
        f"coalesce(z, 0e0)))) AS p FROM docs d LEFT JOIN (SELECT review_id, "
        f"sum(weight * {coef(salt)}) AS z FROM weights GROUP BY 1) w "
        "ON w.review_id = d.review_id)"
    )


SCORING = ", ".join([vocabulary(DOCS), word_grams("normed", "gw"), char_grams("normed", "gc"),
                     weights("gw", "gc")])
TURN_WEIGHTS = ", ".join([TURNS, NORMED, vocabulary(TURNS), word_grams("normed", "gw"),
                          char_grams("normed", "gc"), weights("gw", "gc")])
DOC_FEATURES = vocabulary(DOCS)


def rates(prefix: str = "") -> str:
    f1 = "CASE WHEN 2*tp+fp+fn = 0 THEN 0e0 ELSE 2e0*tp/(2*tp+fp+fn) END"
    rec = "CASE WHEN tp+fn = 0 THEN 0e0 ELSE tp::DOUBLE/(tp+fn) END"
    pre = "CASE WHEN tp+fp = 0 THEN 0e0 ELSE tp::DOUBLE/(tp+fp) END"
    return (
        f"round({f1}, 6) AS f1_negative, round({rec}, 6) AS recall_negative, "
        f"round({pre}, 6) AS precision_negative, {f1} >= 0.85e0 AS passes_gate"
    )


def counts(t: float = 0.5, p: str = "p_negative") -> str:
    return (
        f"count(*) FILTER (label = 0 AND {p} >= {num(t)}) AS tp, "
        f"count(*) FILTER (label <> 0 AND {p} >= {num(t)}) AS fp, "
        f"count(*) FILTER (label = 0 AND {p} < {num(t)}) AS fn, "
        f"count(*) FILTER (label <> 0 AND {p} < {num(t)}) AS tn"
    )


def curve() -> str:
    a = Assumptions()
    grid = "[" + ", ".join(num(t) for t in default_grid()) + "]"
    return (
        f"{LABELLED}, {SCORED}, grid AS (SELECT unnest({grid}) AS t, "
        f"unnest(range(1, 100)) AS t_no), "
        "flags AS (SELECT t_no, t, count(*) FILTER (p_negative >= t) AS f, "
        "count(*) FILTER (p_negative >= t AND label = 0) AS fneg, "
        f"{num(a.reviews_per_month)} / count(*) AS scale FROM grid, scored GROUP BY t_no, t), "
        "money AS (SELECT t_no, t, f * scale AS contacted, fneg * scale AS caught, "
        f"fneg * scale * {num(a.p_at_risk)} * {num(a.win_back_rate)} AS saved, "
        "CASE WHEN f = 0 THEN 0e0 ELSE fneg::DOUBLE / f END AS precision FROM flags), "
        f"curve AS (SELECT *, saved * {num(a.value_per_save)} - contacted * "
        f"{num(a.contact_cost)} AS profit FROM money)"
    )


def typo_sql() -> str:
    keys = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in ty.NEIGHBOUR_KEYS.items()) + "}"
    seed = studies.TYPO_SEED
    word = (
        "CASE WHEN u >= 0.15e0 OR n < 4 THEN w "
        "WHEN kind = 0 THEN left(w, a - 1) || substr(w, a + 1, 1) || substr(w, a, 1) "
        "|| substr(w, a + 2) "
        "WHEN kind = 1 THEN coalesce(left(w, a - 1) || substr(k, (kd % length(k) + 1)::INT, 1) "
        "|| substr(w, a + 1), w) "
        "WHEN kind = 2 THEN left(w, a - 1) || substr(w, a + 1) "
        "ELSE left(w, a) || substr(w, a) END"
    )
    return (
        f"WITH {DOCS}, split AS (SELECT review_id, regexp_extract_all(text, '[^{WS}]+') AS ws "
        "FROM docs), "
        "w1 AS (SELECT review_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM split), "
        f"w2 AS (SELECT *, length(w) AS n, md5(review_id || '|' || pos || '|{seed}') AS d FROM w1), "
        f"w3 AS (SELECT *, {unit('d')} AS u, {hexint('d', 9)} % 4 AS kind, "
        f"({hexint('d', 17)} % greatest(n - 2, 1) + 2)::INT AS a, {hexint('d', 25)} AS kd FROM w2), "
        f"w4 AS (SELECT *, {keys}[lower(substr(w, a, 1))] AS k FROM w3), "
        f"w5 AS (SELECT review_id, pos, {word} AS w FROM w4) "
        "SELECT s.review_id, coalesce(string_agg(w5.w, ' ' ORDER BY pos), '') AS text FROM split s "
        "LEFT JOIN w5 ON w5.review_id = s.review_id GROUP BY s.review_id"
    )


def sweep_scores() -> str:
    return " UNION ALL ".join(
        f"SELECT {no} AS config_no, '{n}' AS name, label, {pseudo(salt=n)} AS p_negative "
        "FROM labelled"
        for no, n in enumerate(cat.SWEEP_NAMES)
    )


def _blank(x: str) -> str:
    return f"NOT regexp_matches({x}, '[^{WS}]')"


REASON = (
    "CASE WHEN text IS NULL THEN 'missing' WHEN length(text) = 0 THEN 'empty' "
    f"WHEN length(text) > 20000 THEN 'too_long' WHEN {_blank('text')} THEN 'blank' "
    "ELSE 'accepted' END"
)
SIGNAL_COLUMNS = "churn_phrases, money_phrases, anger_words, intensity"


TRAIN = "docs AS (SELECT review_id, text FROM labelled WHERE split = 'train')"
TRAIN_VOCABULARY = ", ".join(
    [
        LABELLED, TRAIN, NORMED, word_grams("normed", "gw"), char_grams("normed", "gc"),
        "g1 AS (SELECT review_id, unnest(w) AS term FROM gw_w)",
        vocab_cte("word", "g1", "v1", 2), vocab_cte("word", "gw", "vw", 2),
        vocab_cte("char", "gc", "vc", 3),
        "n AS (SELECT (SELECT count(*) FROM v1) AS uni, (SELECT count(*) FROM vw) AS word, "
        "(SELECT count(*) FROM vc) AS chars, count(*) FILTER (split = 'test' AND label = 0) AS neg, "
        "count(*) FILTER (split = 'test' AND label <> 0) AS other, "
        "count(*) FILTER (split = 'train') AS train, "
        "count(*) FILTER (split = 'train' AND label = 0) AS train_neg FROM labelled)",
    ]
)
DOC_WEIGHTS = ", ".join([DOCS, NORMED, vocabulary(DOCS), word_grams("normed", "gw"),
                         char_grams("normed", "gc"), weights("gw", "gc")])


def added_oracles(known: dict[str, str]) -> dict[str, str]:
    """Round trips, figures of fitted models and sums over the review corpus."""
    written = (
        f"WITH {SEEDED}, {RULES}, {TRIAGED} SELECT review_id, p_negative, urgency, route FROM triaged"
    )
    sweep_sizes = ("least(3000, uni)", "uni", "word", "word", "word", "word + chars")
    words_only = "'bias', 'word'"
    block_sizes = [(words_only, f"1, {size}") for size in sweep_sizes[:5]]
    block_sizes.append(("'bias', 'word', 'char'", "1, word, chars"))
    per_review = "count(*) AS n_terms, round(sum(weight), 5) AS total, sum(joint_id)::BIGINT AS id_sum"
    return {
        "exported_model": known["model_export"],
        "saved_model": known["score_linear"],
        "written_scores": written,
        "fanned_out": written,
        "delivered_lanes": written,
        "stream_routing_restart": known["stream_scores"],
        "stream_scoring_restart": (
            f"SELECT * FROM ({known['stream_scores']}) WHERE p_negative IS NOT NULL"
        ),
        "incoming_reviews": (
            f"WITH {DOCS} SELECT review_id, text, NULL::VARCHAR AS raw, {REASON} AS status FROM docs "
            "WHERE review_id % 50 <> 7 UNION ALL SELECT NULL, NULL, 'no json: ' || review_id, "
            "'malformed' FROM docs WHERE review_id % 50 = 7"
        ),
        "logged_runs": (
            f"WITH {LABELLED}, {SCORED}, c AS (SELECT lang, {counts(0.4)} FROM scored JOIN documents "
            f"ON doc_id = review_id GROUP BY lang), r AS (SELECT lang, {rates()} FROM c) "
            "SELECT lang AS experiment, lang AS name, '0.4' AS threshold, f1_negative, "
            "recall_negative, precision_negative FROM r"
        ),
        "char_ngrams_documents": (
            f"WITH {DOCS}, {NORMED}, {char_grams('normed', 'gc')} SELECT d.review_id, "
            "count(term) AS n_grams, count(DISTINCT term) AS n_terms FROM docs d LEFT JOIN gc "
            "ON gc.review_id = d.review_id GROUP BY d.review_id"
        ),
        "tfidf_documents": (
            f"WITH {DOC_WEIGHTS} SELECT review_id, block, {per_review} FROM weights "
            "GROUP BY review_id, block"
        ),
        "feature_union_documents": (
            f"WITH {DOC_WEIGHTS} SELECT review_id, {per_review} FROM weights GROUP BY review_id"
        ),
        "fit_model_checks": (
            f"WITH {TRAIN_VOCABULARY} SELECT train AS n_train, train_neg AS train_negative, "
            "neg AS test_negative, other AS test_other, word AS word_features, "
            "chars AS char_features, true AS intercept_settled FROM n"
        ),
        "fit_optimality": (
            f"WITH {TRAIN_VOCABULARY} SELECT unnest(['bias', 'word', 'char']) AS block, "
            "unnest([1, word, chars]) AS n_coefficients, true AS optimal FROM n"
        ),
        "config_sweep_optimality": (
            f"WITH {TRAIN_VOCABULARY} "
            + " UNION ALL ".join(
                f"SELECT {no} AS config_no, {quote(cfg.name)} AS name, unnest([{blocks}]) AS block, "
                f"unnest([{sizes}]) AS n_coefficients, true AS optimal FROM n"
                for no, (cfg, (blocks, sizes)) in enumerate(zip(studies.CONFIGS, block_sizes, strict=True))
            )
        ),
        "robustness_optimality": (
            f"WITH {TRAIN_VOCABULARY} "
            + " UNION ALL ".join(
                f"SELECT {quote(cfg.name)} AS name, unnest([{blocks}]) AS block, "
                f"unnest([{sizes}]) AS n_coefficients, true AS optimal FROM n"
                for cfg, (blocks, sizes) in zip(studies.FEATURE_SETS, (block_sizes[2], block_sizes[5]), strict=True)
            )
        ),
        "config_sweep_checks": (
            f"WITH {TRAIN_VOCABULARY} "
            + " UNION ALL ".join(
                f"SELECT {no} AS config_no, {quote(cfg.name)} AS name, {size} AS n_features, "
                "neg AS n_negative, other AS n_other FROM n"
                for no, (cfg, size) in enumerate(zip(studies.CONFIGS, sweep_sizes, strict=True))
            )
        ),
        "robustness_checks": (
            f"WITH {LABELLED}, n AS (SELECT count(*) AS every, count(*) FILTER ("
            f"len(regexp_extract_all(text, '[^{WS}]+')) <= 40) AS short FROM labelled "
            "WHERE split = 'test') SELECT features, every AS n_clean, every AS n_typo, "
            "short AS n_typo_short, true AS base_has_no_gain FROM n, "
            "(SELECT unnest(['word', 'word+char']) AS features)"
        ),
    }


def oracle_sql() -> dict[str, str]:
    known = base_oracles()
    return known | added_oracles(known)


def base_oracles() -> dict[str, str]:
    even = "round_even({0} * 10000, 0) / 10000"
    return {
        "load_reviews": f"WITH {LABELLED} SELECT review_id, text, label, split FROM labelled",
        "validate_reviews": (
            f"WITH {DOCS}, damaged AS (SELECT -review_id - 1 AS review_id, CASE review_id % 4 "
            "WHEN 0 THEN '' WHEN 1 THEN repeat(' ' || chr(9) || chr(10), "
            "(review_id % 7 + 1)::INT) WHEN 2 THEN rpad(text, 20000, '.') "
            "ELSE rpad(text, 20001, '.') END AS text FROM docs) "
            f"SELECT review_id, {REASON} AS status FROM (SELECT * FROM docs UNION ALL "
            "SELECT * FROM damaged)"
        ),
        "route_support_queue": (
            f"WITH {SEEDED}, {RULES}, {TRIAGED} SELECT review_id, p_negative, urgency "
            "FROM triaged WHERE route = 'support_urgent'"
        ),
        "latest_runs": (
            "WITH runs AS (SELECT source AS experiment, lang AS run_id, max(review_id) AS started, "
            f"{counts(0.4, pseudo())} FROM (SELECT d.doc_id AS review_id, source, lang, "
            "quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id) "
            "GROUP BY source, lang), ranked AS (SELECT *, row_number() OVER (PARTITION BY "
            "experiment ORDER BY started DESC, run_id) AS rn FROM runs) SELECT experiment, run_id, "
            + ", ".join(
                f"{even.format(f'(CASE WHEN {d} = 0 THEN 0e0 ELSE {n}::DOUBLE / ({d}) END)')} AS {m}"
                for m, n, d in (
                    ("f1_negative", "(2*tp)", "2*tp+fp+fn"),
                    ("recall_negative", "tp", "tp+fn"),
                    ("precision_negative", "tp", "tp+fp"),
                )
            )
            + " FROM ranked WHERE rn = 1"
        ),
        "model_export": (
            f"WITH {DOC_FEATURES} SELECT CASE WHEN block = 'word' THEN 0 ELSE 1 END AS block_no, "
            f"block, joint_id AS feature_id, term, {exact3('idf', 5)} AS idf, "
            f"{exact3(coef('m1'), 5)} + 0e0 AS coef FROM idfs "
            f"UNION ALL SELECT 2, 'bias', 0, '', 0e0, {num(cat.INTERCEPT)}"
        ),
        "normalize_text": (
            f"WITH {SEEDED}, texts AS (SELECT 'document' AS kind, review_id, text FROM docs "
            f"UNION ALL SELECT 'turn', conv_id * {cat.TURN_IDS} + turn, text FROM conversations "
            "UNION ALL SELECT 'page', page_id, html FROM pages) "
            f"SELECT kind, review_id, {norm('text')} AS norm FROM texts"
        ),
        "tokenize": f"WITH {SEEDED}, {NORMED}, {TOKENS} SELECT review_id, pos, token FROM toks",
        "clause_tokens": (
            f"WITH {SEEDED}, {NORMED}, {CLAUSES} SELECT review_id, clause_no, pos, token FROM ctoks"
        ),
        "word_count": (
            f"WITH {SEEDED} SELECT review_id, len(regexp_extract_all(text, '[^{WS}]+')) AS n_words "
            "FROM docs"
        ),
        "word_ngrams": (
            f"WITH {SEEDED}, {NORMED}, {word_grams('normed', 'gw')} "
            "SELECT review_id, term, count(*) AS tf FROM gw GROUP BY ALL"
        ),
        "char_ngrams": (
            f"WITH {TURNS}, {NORMED}, {char_grams('normed', 'gc')} "
            "SELECT review_id, term, count(*) AS tf FROM gc GROUP BY ALL"
        ),
        "shout_intensity": (
            f"WITH {SEEDED}, {SHOUT} SELECT review_id, round(intensity, 6) AS intensity FROM loud"
        ),
        "lexicon_exact": (
            f"WITH {SEEDED}, {NORMED}, {LEXTABLE}, {EXACT} "
            "SELECT review_id, term_group, term FROM exact"
        ),
        "lexicon_fuzzy": (
            f"WITH {SEEDED}, {NORMED}, {LEXTABLE}, {TOKENS}, {PAIRS} SELECT DISTINCT review_id, "
            "p.token, p.term FROM toks t JOIN pairs p ON t.token = p.token "
            f"WHERE NOT list_contains({GUARD}, t.token)"
        ),
        "fuzzy_guard": (
            f"WITH {SEEDED}, {NORMED}, {LEXTABLE}, {TOKENS}, {PAIRS} SELECT p.token, l.term_group, "
            "l.term, (SELECT count(*) FROM toks t WHERE t.token = p.token) AS n, "
            "CASE WHEN EXISTS (SELECT 1 FROM lex m WHERE m.term_group = l.term_group "
            "AND m.term = p.token) THEN 'member' "
            f"WHEN list_contains({GUARD}, p.token) THEN 'guarded' ELSE 'typo' END AS verdict "
            "FROM pairs p JOIN lex l ON l.term = p.term"
        ),
        "lexicon_hits": (
            f"WITH {SEEDED}, {NORMED}, {LEXTABLE}, {TOKENS}, {PAIRS}, {HITS} SELECT d.review_id, "
            + ", ".join(
                f"coalesce(string_agg(hit, '|' ORDER BY ord) FILTER (term_group = '{g}'), '') AS {g}"
                for g in LEX.groups()
            )
            + " FROM docs d LEFT JOIN hits h ON h.review_id = d.review_id GROUP BY d.review_id"
        ),
        "churn_patterns": (
            f"WITH {SEEDED}, {NORMED}, {PATTERNS} SELECT review_id, array_to_string(m, '|') AS hits "
            "FROM found"
        ),
        "negation_scope": (
            f"WITH {SEEDED}, {NORMED}, {NEGATED} SELECT review_id, head, negated FROM scope "
            f"WHERE list_contains({str_list(cat.HEADS)}, head)"
        ),
        "churn_after_negation": (
            f"WITH {SEEDED}, {NORMED}, {LEXTABLE}, {TOKENS}, {PAIRS}, {HITS}, {KEPT} "
            "SELECT d.review_id, "
            "coalesce((SELECT string_agg(hit, '|' ORDER BY ord) FROM hits h WHERE "
            "h.review_id = d.review_id AND term_group = 'churn'), '') AS churn, "
            "coalesce((SELECT string_agg(hit, '|' ORDER BY ord) FROM kept k WHERE "
            "k.review_id = d.review_id), '') AS kept FROM docs d"
        ),
        "mine_collisions": (
            f"WITH {SEEDED}, {NORMED}, {LEXTABLE}, {TOKENS}, {PAIRS}, tc AS (SELECT token, "
            "count(*) AS n FROM toks GROUP BY token HAVING count(*) >= 25) "
            "SELECT tc.token, l.term_group, l.term, n FROM tc JOIN pairs p ON p.token = tc.token "
            "JOIN lex l ON l.term = p.term WHERE NOT EXISTS (SELECT 1 FROM lex m "
            "WHERE m.term_group = l.term_group AND m.term = tc.token)"
        ),
        "urgency_score": (
            f"WITH {SEEDED}, {RULES} SELECT review_id, urgency, {SIGNAL_COLUMNS} FROM urgent"
        ),
        "urgency_audit": (
            f"WITH {SEEDED}, {RULES} SELECT review_id, kind, (row_number() OVER (PARTITION BY "
            "review_id, kind ORDER BY ord) - 1)::INT AS ord, hit AS term FROM signal"
        ),
        "route_matrix": (
            f"WITH {SEEDED}, {RULES}, {TRIAGED} SELECT review_id, {route_sql('p', 'urgency')} AS "
            f"route, {route_sql('p', 'urgency', 0.6, 0.5, 0.2)} AS strict_route FROM scores"
        ),
        "score_reviews": (
            f"WITH {SEEDED}, {RULES}, {SCORING}, {margins('m1', 'pm')} SELECT u.review_id, "
            f"{exact3('p', 4)} AS p_negative, urgency, {route_sql('p', 'urgency')} AS route, "
            f"{SIGNAL_COLUMNS} FROM urgent u JOIN pm ON pm.review_id = u.review_id"
        ),
        "probe_scores": (
            f"WITH {PROBES}, {RULES}, {SCORING}, {margins('m1', 'pm')} SELECT u.review_id, d.text, "
            f"{exact3('p', 4)} AS p_negative, {route_sql('p', 'urgency')} AS route "
            "FROM urgent u JOIN pm ON pm.review_id = u.review_id JOIN docs d ON d.review_id = u.review_id"
        ),
        "route_summary": (
            f"WITH {SEEDED}, {RULES}, {TRIAGED} SELECT r.route, count(t.route) AS n, "
            "round(count(t.route) / (SELECT count(*) FROM triaged)::DOUBLE, 6) AS share FROM "
            "(SELECT unnest(['support_urgent', 'feedback_backlog', 'analytics']) AS route) r "
            "LEFT JOIN triaged t ON t.route = r.route GROUP BY r.route"
        ),
        "vocab_word": (
            f"WITH {DOCS}, {NORMED}, {word_grams('normed', 'gw')}, "
            f"{vocab_cte('word', 'gw', 'vw', 2)} SELECT block, term, tf, df, feature_id FROM vw"
        ),
        "vocab_char": (
            f"WITH {DOCS}, {NORMED}, {char_grams('normed', 'gc')}, "
            f"{vocab_cte('char', 'gc', 'vc', 3)} SELECT block, term, tf, df, feature_id FROM vc"
        ),
        "idf_table": (
            f"WITH {DOC_FEATURES} SELECT block, term, tf, df, feature_id, round(idf, 6) AS idf "
            "FROM idfs"
        ),
        "tfidf_weights": (
            f"WITH {TURN_WEIGHTS} SELECT review_id, block, joint_id AS feature_id, "
            "round(weight, 6) AS weight FROM weights"
        ),
        "feature_union": (
            f"WITH {TURN_WEIGHTS} SELECT review_id, joint_id AS feature_id, "
            "round(weight, 6) AS weight FROM weights"
        ),
        "score_linear": (
            f"WITH {SEEDED}, {NORMED}, {SCORING}, {margins('m1', 'pm')} "
            "SELECT review_id, round(p, 6) AS p_negative FROM pm"
        ),
        "model_agreement": (
            f"WITH {SEEDED}, {NORMED}, {SCORING}, {margins('m1', 'pa')}, {margins('m2', 'pb')} "
            "SELECT count(*) AS n, round(avg(((pa.p >= 0.5e0) = (pb.p >= 0.5e0))::INT), 6) "
            "AS agreement FROM pa JOIN pb ON pa.review_id = pb.review_id"
        ),
        "top_weights": (
            f"WITH {DOC_FEATURES}, c AS (SELECT block, term, {coef('m1')} AS coef FROM idfs) "
            "SELECT 'negative' AS side, block, term, round(coef, 6) AS coef FROM (SELECT * FROM c "
            "ORDER BY coef, block, term LIMIT 15) UNION ALL SELECT 'positive', block, term, "
            "round(coef, 6) FROM (SELECT * FROM c ORDER BY coef DESC, block, term LIMIT 15)"
        ),
        "sweep_winner": (
            f"WITH {LABELLED}, s AS ({sweep_scores()}), c AS (SELECT config_no, name, {counts(0.4)} "
            f"FROM s GROUP BY config_no, name), r AS (SELECT config_no, name, {rates()} FROM c) "
            "SELECT config_no, name, f1_negative FROM r ORDER BY f1_negative DESC, config_no LIMIT 1"
        ),
        "batch_score": (
            f"WITH {SEEDED} SELECT review_id, round((length(text) - length(replace(text, 'e', '')))"
            " / length(text)::DOUBLE, 6) AS p_negative FROM docs"
        ),
        "negative_metrics": (
            f"WITH {LABELLED}, {SCORED}, c AS (SELECT {counts()} FROM scored) "
            f"SELECT tp, fp, fn, tn, {rates()} FROM c"
        ),
        "precision_at_k": (
            f"WITH {LABELLED}, {SCORED}, r AS (SELECT label, row_number() OVER (ORDER BY "
            "p_negative DESC, review_id) AS rank FROM scored) SELECT k, "
            "round(avg((label = 0)::INT), 6) AS precision_at_k FROM r, (SELECT unnest([100, 1000]) "
            "AS k) WHERE rank <= k GROUP BY k"
        ),
        "calibration": (
            f"WITH {LABELLED}, {SCORED} SELECT bin, round(avg(p_negative), 6) AS mean_predicted, "
            "round(avg((label = 0)::INT), 6) AS share_negative, count(*) AS n FROM (SELECT *, "
            f"len(list_filter([{', '.join(num(i / 10) for i in range(1, 10))}], "
            "lambda e: p_negative > e))::INT AS bin FROM scored) GROUP BY bin"
        ),
        "profit_curve": (
            f"WITH {curve()} SELECT t_no, "
            + ", ".join(
                f"round({c}, 6) AS {c}"
                for c in ("t", "contacted", "caught", "saved", "profit", "precision")
            )
            + " FROM curve"
        ),
        "optimal_threshold": (
            f"WITH {curve()} SELECT round(t, 6) AS t, round(profit, 6) AS profit, "
            "round(contacted, 6) AS contacted, round(precision, 6) AS precision FROM curve "
            "ORDER BY curve.profit DESC, curve.t LIMIT 1"
        ),
        "threshold_gain": (
            f"WITH {curve()}, b AS (SELECT max(profit) AS o, arg_min(profit, abs(t - 0.5e0)) AS d "
            "FROM curve) SELECT round(o, 6) AS optimal_profit, round(d, 6) AS default_profit, "
            "round(o - d, 6) AS gain FROM b"
        ),
        "above_break_even": (
            f"WITH {curve()} SELECT round(t, 6) AS t, round(precision, 6) AS precision, "
            f"round({num(Assumptions().breakeven_precision)}, 6) AS breakeven_precision FROM curve "
            f"WHERE curve.precision > {num(Assumptions().breakeven_precision)}"
        ),
        "class_balance": (
            f"WITH {LABELLED} SELECT split, label, count(*) AS n FROM labelled GROUP BY ALL"
        ),
        "length_summary": (
            f"WITH {DOCS}, l AS (SELECT len(regexp_extract_all(text, '[^{WS}]+')) AS n FROM docs) "
            "SELECT count(*) AS count, round(avg(n), 1) AS mean, round(stddev_samp(n), 1) AS std, "
            "round(min(n)::DOUBLE, 1) AS min, round(quantile_cont(n, 0.25), 1) AS p25, "
            "round(quantile_cont(n, 0.5), 1) AS p50, round(quantile_cont(n, 0.75), 1) AS p75, "
            "round(max(n)::DOUBLE, 1) AS max FROM l"
        ),
        "length_histogram": (
            f"WITH {DOCS}, l AS (SELECT least(len(regexp_extract_all(text, '[^{WS}]+')), 1000) AS n "
            "FROM docs), r AS (SELECT min(n)::DOUBLE AS lo, (max(n) - min(n)) / 50e0 AS step FROM l), "
            "b AS (SELECT unnest(range(50))::INT AS bin) SELECT bin, "
            "round(bin * step + lo, 6) AS left_edge, (SELECT count(*) FROM l WHERE "
            "n >= bin * step + lo AND (n < (bin + 1) * step + lo OR bin = 49)) AS n FROM b, r"
        ),
        "class_preview": (
            f"WITH {LABELLED} SELECT label, review_id, left(text, 400) AS preview FROM "
            "(SELECT *, row_number() OVER (PARTITION BY label ORDER BY review_id) AS rn "
            "FROM labelled) WHERE rn = 1"
        ),
        "fixed_sample": (
            f"WITH {DOCS} SELECT review_id, text FROM docs ORDER BY md5(review_id || '|42'), "
            "review_id LIMIT 300"
        ),
        "short_slice_metrics": (
            f"WITH {LABELLED}, {SCORED}, c AS (SELECT {counts()} FROM scored JOIN labelled l "
            f"USING (review_id, label) WHERE len(regexp_extract_all(text, '[^{WS}]+')) <= 40) "
            f"SELECT tp, fp, fn, tn, {rates()} FROM c"
        ),
        "typo_corpus": typo_sql(),
        "model_comparison": (
            f"WITH {LABELLED}, s AS (SELECT 'base' AS model, label, {pseudo()} AS p_negative FROM "
            f"labelled UNION ALL SELECT 'word', label, {pseudo(salt='word')} FROM labelled UNION ALL "
            f"SELECT 'word+char', label, {pseudo(salt='word+char')} FROM labelled), "
            f"c AS (SELECT model, {counts()} FROM s GROUP BY model) "
            f"SELECT model, tp, fp, fn, tn, {rates()} FROM c"
        ),
        "stream_scores": (
            f"WITH {SEEDED}, {RULES}, {TRIAGED} SELECT t.review_id, "
            f"CASE WHEN {REASON} = 'accepted' THEN p_negative END AS p_negative, "
            f"CASE WHEN {REASON} = 'accepted' THEN urgency END AS urgency, "
            f"CASE WHEN {REASON} = 'accepted' THEN route ELSE {REASON} END AS route "
            "FROM triaged t JOIN docs d ON d.review_id = t.review_id"
        ),
    }
