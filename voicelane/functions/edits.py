"""Bounded edit distance with adjacent swaps, from built-in functions only.

``levenshtein`` charges two edits for a swap of neighbouring letters; a typo
counts it as one. No letter takes part in a swap and in another edit, so a
token is within ``k`` (1 or 2) edits of a term in one of two ways:

* plain edits alone suffice: ``levenshtein(token, term) <= k``; or
* some neighbouring pair of the term is swapped in the token, everything on one
  side of the pair is untouched, and the other side is within ``k - 1`` edits.

With at most two edits the second case covers every use of a swap: the other
edit lies wholly left or wholly right of the pair. Every swap costs at most two
plain edits, so ``levenshtein(token, term) <= 2 k`` is a cheap first test. A swap brings
no letter in and takes none away, and the other edit one at most: fewer than ``k`` letters
of either word may be missing from the other before swaps are tried place by place.
"""

from __future__ import annotations


def _swapped(a: str, i: str, b: str, k: str) -> str:
    """Letters i, i+1 of ``a`` are letters k, k+1 of ``b`` the other way round."""
    return f"substring({a}, {i}, 2) = reverse(substring({b}, {k}, 2))"


def _one_swap(a: str, b: str) -> str:
    """The two differ by exactly one swapped pair."""
    return (
        f"(length({a}) = length({b}) AND length({b}) >= 2 AND "
        f"exists(sequence(1, length({b}) - 1), j -> {_swapped(a, 'j', b, 'j')} "
        f"AND left({a}, j - 1) = left({b}, j - 1) "
        f"AND substring({a}, j + 2) = substring({b}, j + 2)))"
    )


def _one_swap_one_edit(token: str, term: str) -> str:
    """One swapped pair and at most one more edit, before or after the pair."""
    head, tail = f"left({term}, i - 1)", f"substring({term}, i + 2)"
    right = f"substring({token}, i + 2)"
    after = (
        f"{_swapped(token, 'i', term, 'i')} AND left({token}, i - 1) = {head} "
        f"AND (levenshtein({right}, {tail}, 1) >= 0 OR {_one_swap(right, tail)})"
    )
    # With the tail untouched the pair moves by the difference in length.
    k = f"(i + length({token}) - length({term}))"
    before = (
        f"{k} >= 1 AND {_swapped(token, k, term, 'i')} "
        f"AND substring({token}, {k} + 2) = {tail} "
        f"AND levenshtein(left({token}, {k} - 1), {head}, 1) >= 0"
    )
    return f"exists(sequence(1, length({term}) - 1), i -> ({after}) OR ({before}))"


def within_edits(token: str, term: str, budget: str) -> str:
    """SQL: is the token within ``budget`` (1 or 2) edits of the term, swaps included?"""
    plain = f"levenshtein({token}, {term}, 2 * {budget})"
    return (
        f"(abs(length({token}) - length({term})) <= {budget} AND {plain} >= 0 "
        f"AND ({plain} <= {budget} OR (length(translate({token}, {term}, '')) < {budget} "
        f"AND length(translate({term}, {token}, '')) < {budget} "
        f"AND CASE WHEN {budget} = 1 THEN {_one_swap(token, term)} "
        f"ELSE {_one_swap_one_edit(token, term)} END)))"
    )


def edit_budget(term: str) -> int:
    """Edits a misspelling of the term may have; 0 means exact match only."""
    if " " in term or len(term) < 5:
        return 0
    return 1 if len(term) < 8 else 2
