"""Lexicon sentiment as column expressions.

The score is the published VADER normalisation s / sqrt(s^2 + 15) of the summed valences.
"""

import string
from dataclasses import dataclass, field

from pyspark.sql import functions as F

ALPHA = 15.0
PUNCTUATION = r"[!-/:-@\[-`{-~]+"
MARKS = string.punctuation  # the characters of PUNCTUATION


@dataclass(frozen=True)
class Modifiers:
    """Words before a scored word that change its valence (published VADER weights)."""

    negations: tuple = ("not", "no", "never", "none", "nobody", "nor", "neither", "without", "cannot")
    negation_factor: float = -0.74
    boosters: dict = field(
        default_factory=lambda: {
            "very": 0.293,
            "really": 0.293,
            "extremely": 0.293,
            "totally": 0.293,
            "barely": -0.293,
            "hardly": -0.293,
            "slightly": -0.293,
        }
    )
    # How much a booster one, two or three words back still counts.
    decay: tuple = (1.0, 0.95, 0.9)


def raw_tokens(text):
    """Lowered whitespace tokens, with "" where the text begins or ends in whitespace."""
    return F.split(F.lower(text), r"[ \t\n\f\r]+")


def bare(token):
    """``token`` without outer punctuation.

    One that would shrink to two letters or fewer stays as it is (":-)" is a word here).
    """
    inner = F.btrim(token, F.lit(MARKS))
    return F.when(F.length(inner) <= 2, token).otherwise(inner)


def score_tokens(text):
    """Lowered whitespace tokens with outer punctuation removed, "" dropped."""
    return F.filter(F.transform(raw_tokens(text), bare), lambda token: token != "")


def _by_value(pairs):
    groups = {}
    for token, value in pairs:
        groups.setdefault(float(value), []).append(token)
    return groups


def _lookup(token, groups):
    """Value of ``token``: one hash-set test per distinct value, 0.0 if in none."""
    result = None
    for value, tokens in sorted(groups.items()):
        hit = token.isin(tokens)
        result = F.when(hit, F.lit(value)) if result is None else result.when(hit, F.lit(value))
    return F.lit(0.0) if result is None else result.otherwise(F.lit(0.0))


def normalise(total):
    return F.round(total / F.sqrt(total * total + F.lit(ALPHA)), 4)


def words_with_context(text, modifiers=None):
    """One struct per token: ``token``, and with modifiers the modifying words before it, nearest first (else null)."""
    known = [] if modifiers is None else [*modifiers.negations, *modifiers.boosters]
    backs = 0 if modifiers is None else len(modifiers.decay)

    def all_of(tokens):
        def one(token, position):
            earlier = [F.get(tokens, position - F.lit(back)) for back in range(1, backs + 1)]
            kept = [F.when(word.isin(known), word).alias(f"back{i}") for i, word in enumerate(earlier, 1)]
            return F.struct(token.alias("token"), *kept)

        return F.transform(tokens, one)

    # The one-element array binds the token list to a name: it is built once, not once per look back.
    return F.get(F.transform(F.array(score_tokens(text)), all_of), F.lit(0))


def modified(valence, modifiers, scored):
    """``valence`` under the words ``back1``, ``back2``, ...; a word in the array ``scored`` modifies nothing."""
    boosts = _by_value(modifiers.boosters.items())
    for back, weight in enumerate(modifiers.decay, 1):
        word = F.col(f"back{back}")
        plain = word.isNotNull() & ~F.array_contains(scored, word)
        boost = F.when(plain, _lookup(word, boosts)).otherwise(F.lit(0.0)) * F.lit(weight)
        flip = F.when(plain & word.isin(list(modifiers.negations)), F.lit(modifiers.negation_factor)).otherwise(F.lit(1.0))
        valence = (valence + F.signum(valence) * boost) * flip
    return valence


def label_of(score):
    return (
        F.when(score >= 0.05, "positive").when(score <= -0.05, "negative").otherwise("neutral")
    )
