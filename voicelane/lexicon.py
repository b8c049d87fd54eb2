"""Phrases, patterns and weights of the urgency rules."""

from __future__ import annotations

from dataclasses import dataclass

from voicelane.functions.edits import edit_budget

# --- fixed values -----------------------------------------------------------
CHURN_PHRASES = (
    "cancel", "cancelling", "canceled", "cancellation", "refund", "money back",
    "never again", "never use", "switching to", "switch to",
    "deleting my account", "delete my account", "unsubscribe", "last time",
    "done with",
)
MONEY_PHRASES = (
    "charged", "double charge", "billing", "billed", "overcharged", "payment",
    "credit card", "took my money", "stole",
)
ANGER_WORDS = (
    "furious", "outraged", "unacceptable", "disgusting", "scam", "fraud",
    "worst", "terrible", "horrible", "awful", "rip off", "ripoff",
)
NEGATABLE_CHURN = (
    "cancel", "cancelling", "canceled", "cancellation", "refund",
    "unsubscribe", "switching to", "switch to",
)
NEGATORS = ("not", "never", "wont", "cant", "dont", "no", "nor", "neither")
GUARD_WORDS = (
    "acceptable", "cancelled", "cancer", "changed", "charge", "charges",
    "charmed", "concealed", "curious", "discussing", "disgustingly", "filled",
    "filling", "freud", "horribly", "killed", "killing", "outdated", "outrage",
    "stale", "stolen", "stone", "store", "stowe", "style", "terribly",
    "willed", "willing", "worse",
)
_NOUNS = ("subscription", "membership", "account", "service", "plan")
_NOUN = "(?:subscription|membership|account|service|plan)"
# (texts of which every match contains at least one, pattern)
CHURN_PATTERNS = (
    (("want ",), f"(?:dont|do not|no longer|never) want (?:my|this|the|your) {_NOUN}"),
    (_NOUNS, "(?:stop|end|drop|ditch|get rid of|dont renew|do not renew) "
          f"(?:my|the|this|your) {_NOUN}"),
    ((" renew",), "(?:not|never|wont|will not|not going to|dont want to) renew"),
    ((" account",), "(?:close|deactivate) (?:my|the) account"),
    (("want out",), r"want out(?:\s*[.!,;]|$|\s+of (?:my|this|the) "
                 "(?:subscription|membership|account|service|plan|contract))"),
    (("take my business elsewhere",), "take my business elsewhere"),
)
WEIGHTS = {"churn": 0.45, "money": 0.30, "anger": 0.15, "intensity": 0.10}
NEGATION_WINDOW = 5
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Lexicon:
    """Everything the rule engine looks for. All lists are small parameters."""

    churn: tuple[str, ...] = CHURN_PHRASES
    money: tuple[str, ...] = MONEY_PHRASES
    anger: tuple[str, ...] = ANGER_WORDS
    patterns: tuple[tuple[tuple[str, ...], str], ...] = CHURN_PATTERNS
    negatable: tuple[str, ...] = NEGATABLE_CHURN
    negators: tuple[str, ...] = NEGATORS
    guard: tuple[str, ...] = GUARD_WORDS
    negation_window: int = NEGATION_WINDOW

    def groups(self) -> dict[str, tuple[str, ...]]:
        return {"churn": self.churn, "money": self.money, "anger": self.anger}

    def fuzzy_terms(self) -> list[tuple[str, int]]:
        """(term, budget) of every term that may be misspelt, in list order."""
        seen = dict.fromkeys(t for terms in self.groups().values() for t in terms)
        return [(t, edit_budget(t)) for t in seen if edit_budget(t) > 0]

    def term_rows(self) -> list[tuple[str, str, int, int]]:
        """(group, term, ord, budget) rows."""
        return [
            (group, term, i, edit_budget(term))
            for group, terms in self.groups().items()
            for i, term in enumerate(terms)
        ]


DEFAULT_LEXICON = Lexicon()
