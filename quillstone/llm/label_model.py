"""A label model: the accuracies of noisy labelling functions, found by expectation-maximisation without labels."""

from __future__ import annotations

import math


def fit(patterns: dict[tuple[int | None, ...], int], prior: float, trusted: list[tuple[float, float]], strength: float = 50.0, rounds: int = 50) -> tuple[float, list[tuple[float, float]]]:
    """Share of positives and, per labelling function, how often it fires on positives and on negatives.

    ``patterns``: how often each combination of votes (1 fires, 0 does not,
    None abstains) occurs. ``trusted`` holds the expected firing rates, which
    count as ``strength`` observations each (a Beta prior), so that a function
    that rarely fires keeps a sane estimate.
    """
    total = max(1, sum(patterns.values()))
    share, rates = prior, list(trusted)
    for _ in range(rounds):
        post = {p: posterior(p, share, rates) for p in patterns}
        positives = sum(post[p] * n for p, n in patterns.items())
        share_new = (positives + prior * strength) / (total + strength)
        fresh = []
        for k, (hit0, false0) in enumerate(trusted):
            hit = [hit0 * strength, strength]
            false = [false0 * strength, strength]
            for p, n in patterns.items():
                if p[k] is not None:
                    hit[0] += post[p] * n * p[k]
                    hit[1] += post[p] * n
                    false[0] += (1 - post[p]) * n * p[k]
                    false[1] += (1 - post[p]) * n
            # a labelling function is never taken for worse than chance
            fresh.append((max(hit[0] / hit[1], false[0] / false[1]), false[0] / false[1]))
        moved = abs(share_new - share) + sum(abs(a - c) + abs(b - d) for (a, b), (c, d) in zip(rates, fresh, strict=True))
        share, rates = share_new, fresh
        if moved < 1e-6:
            break
    return share, rates


def posterior(votes: tuple[int | None, ...], share: float, rates: list[tuple[float, float]]) -> float:
    odds = math.log(share / (1 - share))
    for v, (hit, false) in zip(votes, rates, strict=True):
        hit, false = min(0.999, max(0.001, hit)), min(0.9999, max(1e-4, false))
        if v is not None:
            odds += math.log(hit / false) if v else math.log((1 - hit) / (1 - false))
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
