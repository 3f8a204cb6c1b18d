"""Probabilistic linkage: agreement levels of compared fields, weighed by expectation-maximization."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns of agreement levels that may occur at most; the driver holds one count for each.
MAX_PATTERNS = 200_000
#: So many pairs' worth of the expected shares is kept in the estimates, which matters only where there are few pairs.
FEW = 20
#: Expected shares of the levels among other pairs: 0 differ, 1 and 2 missing on one side or both, 3 close, 4 equal.
BY_CHANCE = {0: 0.7, 1: 0.12, 2: 0.12, 3: 0.02, 4: 0.04}


def em_weights(patterns: Sequence[tuple[tuple[int, ...], int]], match_like: Sequence[Mapping[int, float]], prior: float = 0.2, rounds: int = 200) -> tuple[float, list[dict[int, float]]]:
    """The log odds of a match before comparison, and what each level of each field adds to it.

    ``patterns`` counts the pairs of each pattern of levels; a missing value is a level like any other. ``match_like`` says, per
    field, how often each level is expected among matches to begin with. Fields are taken as independent within each class.
    """
    total = sum(n for _, n in patterns)
    levels = [sorted({p[k] for p, _ in patterns}) for k in range(len(match_like))]
    m = [{lv: max(like.get(lv, 0.01), 0.01) for lv in levels[k]} for k, like in enumerate(match_like)]
    m = [{lv: x / sum(f.values()) for lv, x in f.items()} for f in m]
    start_u = [{lv: BY_CHANCE.get(lv, 0.05) for lv in f} for f in levels]
    start_u = [{lv: x / sum(f.values()) for lv, x in f.items()} for f in start_u]
    u = [{lv: (sum(n for p, n in patterns if p[k] == lv) + FEW * start_u[k][lv]) / (total + FEW) for lv in levels[k]} for k in range(len(match_like))]
    start_m, start_prior = [dict(f) for f in m], prior
    for _ in range(rounds):
        post = []
        for p, _n in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(m[k][lv] / u[k][lv]) for k, lv in enumerate(p))
            post.append(1 / (1 + math.exp(-max(-500.0, min(500.0, odds)))))
        matched = sum(x * n for x, (_, n) in zip(post, patterns))
        new_prior = (matched + FEW * start_prior) / (total + FEW)
        for k in range(len(match_like)):
            for lv in levels[k]:
                yes = sum(x * n for x, (p, n) in zip(post, patterns) if p[k] == lv)
                no = sum((1 - x) * n for x, (p, n) in zip(post, patterns) if p[k] == lv)
                m[k][lv] = (yes + FEW * start_m[k][lv]) / (matched + FEW)
                u[k][lv] = (no + FEW * start_u[k][lv]) / (total - matched + FEW)
        if abs(new_prior - prior) < 1e-7:
            break
        prior = new_prior
    return math.log(prior / (1 - prior)), [{lv: math.log(m[k][lv] / u[k][lv]) for lv in levels[k]} for k in range(len(match_like))]


def with_probability(pairs: DataFrame, fields: Mapping[str, Mapping[int, float]]) -> DataFrame:
    """Adds ``probability`` of a match to compared pairs; ``fields`` names the columns of levels with their expected shares among matches."""
    names = list(fields)
    counted = [(tuple(r[:-1]), r[-1]) for r in pairs.groupBy(*names).count().limit(MAX_PATTERNS + 1).collect()]
    if len(counted) > MAX_PATTERNS:
        raise ValueError("too many patterns of levels")
    if not counted:
        return pairs.withColumn("probability", F.lit(0.0))
    counted.sort()
    base, weights = em_weights(counted, [fields[n] for n in names])

    def weight(name: str, by_level: Mapping[int, float]) -> Column:
        return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for lv, w in by_level.items() for x in (lv, w)]), F.col(name)), F.lit(0.0))

    odds = reduce(lambda x, y: x + y, [weight(n, w) for n, w in zip(names, weights)], F.lit(base))
    return pairs.withColumn("probability", 1 / (1 + F.exp(-odds)))
