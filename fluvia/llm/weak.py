"""Weak supervision: labelers that vote or abstain, reliabilities by expectation-maximisation.

What is fitted on is the number of rows for each pattern of votes: at most
3 ** labelers numbers, counted by Spark over all rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOTES = (-1, 0, 1)


def pattern_counts(df: DataFrame, votes: Mapping[str, Column], weight: Column | None = None) -> dict[tuple[int, ...], int]:
    """How many rows have each pattern of votes."""
    rows = df.groupBy(*[v.cast("int").alias(k) for k, v in votes.items()]).agg(F.sum(F.lit(1) if weight is None else weight).alias("_n"))
    return {tuple(row[k] for k in votes): int(row["_n"]) for row in rows.collect()}


@dataclass(frozen=True)
class Model:
    """Log odds of the positive class: ``bias`` and what each vote of each labeler adds."""

    bias: float
    adds: tuple[dict[int, float], ...]

    def of(self, votes: Sequence[int]) -> float:
        z = self.bias + sum(add[v] for add, v in zip(self.adds, votes, strict=True))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))

    def posterior(self, votes: Sequence[Column]) -> Column:
        z = F.lit(self.bias)
        for add, vote in zip(self.adds, votes, strict=True):
            z = z + F.when(vote > 0, add[1]).when(vote < 0, add[-1]).otherwise(add[0])
        return 1 / (1 + F.exp(-z))


def fit(counts: Mapping[tuple[int, ...], int], n_labelers: int, rounds: int = 200, pseudo: float = 1.0, start: tuple[float, float] = (0.1, 0.95), sure: Mapping[tuple[int, ...], int] | None = None) -> Model:
    """Two classes, each labeler's votes independent within a class.

    Starts with a positive probability of ``start[0]`` for patterns with a negative
    vote and ``start[1]`` for the others.  ``sure``: counts of rows known to be
    positive, besides ``counts``; their belief stays at one.  A labeler never counts against what
    it votes for: such a ratio of likelihoods is held at one.
    """
    sure = sure or {}
    patterns = sorted({*counts, *sure})
    counts = {p: counts.get(p, 0) for p in patterns}
    total = sum(counts.values()) + sum(sure.values())
    if not total:
        return Model(math.log(start[1] / (1 - start[1])), tuple({-1: -1.0, 0: 0.0, 1: 1.0} for _ in range(n_labelers)))
    belief = {p: start[0] if -1 in p else start[1] for p in patterns}
    model = None
    for _ in range(rounds):
        weight = {p: counts[p] * belief[p] + sure.get(p, 0) for p in patterns}
        positive = sum(weight.values())
        prior = min(0.999, max(0.001, (positive + pseudo) / (total + 2 * pseudo)))
        adds = []
        for j in range(n_labelers):
            add = {}
            for v in VOTES:
                good = sum(weight[p] for p in patterns if p[j] == v)
                bad = sum(counts[p] * (1 - belief[p]) for p in patterns if p[j] == v)
                add[v] = math.log((good + pseudo) / (positive + 3 * pseudo)) - math.log((bad + pseudo) / (total - positive + 3 * pseudo))
            add[1], add[-1] = max(0.0, add[1]), min(0.0, add[-1])
            adds.append(add)
        new = Model(math.log(prior / (1 - prior)), tuple(adds))
        belief = {p: new.of(p) for p in patterns}
        if model and max(abs(new.of(p) - model.of(p)) for p in patterns) < 1e-9:
            return new
        model = new
    return model
