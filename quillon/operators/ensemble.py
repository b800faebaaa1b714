"""Ensemble measures of an utterance: agreement, clique, speech, tier, confidence. Built-in functions only."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import similarity

#: Limits of agreement, silence and the silver tier.
CLIQUE_DISTANCE = 0.2
NO_SPEECH = 0.6
SILVER = 0.3


def pair_similarities(texts: list[Column]) -> dict[tuple[int, int], Column]:
    return {(i, j): similarity(texts[i], texts[j]) for i, j in combinations(range(len(texts)), 2)}


def agreement_score(pairs: list[Column]) -> Column:
    """Mean of the pairs' similarities; 1 for a single voter."""
    return reduce(lambda a, b: a + b, pairs) / float(len(pairs)) if pairs else F.lit(1.0)


def clique_size(pairs: dict[tuple[int, int], Column], voters: int, most: float = CLIQUE_DISTANCE) -> Column:
    """Size of the largest set of voters of which any two are within the distance; 1 at least (0 voters: 0).

    The sets are listed when the plan is built, larger first, so it is one CASE over the given pairs.
    """
    out = F.lit(min(voters, 1))
    for size in range(2, voters + 1):
        sets = [reduce(lambda a, b: a & b, [1 - pairs[p] <= most for p in combinations(s, 2)]) for s in combinations(range(voters), size)]
        out = F.when(reduce(lambda a, b: a | b, sets), size).otherwise(out)
    return out


def is_non_speech(texts: Column, no_speech: Column) -> Column:
    """Half or more of the normal forms blank, or any voter's no-speech probability over the limit. Both are arrays by voter."""
    blanks = F.size(F.filter(texts, lambda t: F.coalesce(t, F.lit("")) == ""))
    return (2 * blanks >= F.size(texts)) | F.exists(no_speech, lambda p: F.coalesce(p, F.lit(0.0)) > NO_SPEECH)


def classify_tier(non_speech: Column, n_agree: Column, voters: int | Column, callsign_ok: Column, score: Column) -> Column:
    return (
        F.when(non_speech, "non_speech").when((n_agree == voters) & callsign_ok, "gold").when(score >= SILVER, "silver").otherwise("tail")
    )


def confidence_score(agreement: Column, rover: Column, advisory_disagree: Column) -> Column:
    """Mean of the signals there are; the third is the advisory's agreement."""
    return F.when(advisory_disagree.isNull(), (agreement + rover) / 2).otherwise((agreement + rover + (1 - advisory_disagree)) / 3)
