"""Weak supervision: rules that vote or abstain, their accuracies, and posterior labels.

Each rule votes 1 (good), -1 (bad) or 0 (abstains). Given the true class, votes count as
independent; how often a rule votes either way, or abstains, among the good and among the bad is
learned together with the share of good documents, by expectation-maximisation. Documents with
the same votes are the same to the model, so all of them are counted by pattern first: with R
rules at most 3**R rows reach the driver, whatever the number of documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_RULES = 9  # 19,683 patterns

ROUNDS = 200
TOLERANCE = 1e-9
VOTES = (-1, 0, 1)
# What is assumed before any vote is seen, and as how many documents it counts: a rule speaks
# against few good and many bad documents.
AMONG_GOOD = (0.03, 0.50, 0.47)
AMONG_BAD = (0.40, 0.40, 0.20)
SHARE_GOOD = 0.9
ASSUMED = 10.0


@dataclass(frozen=True)
class LabelModel:
    """Log-odds of being good: one number for all, and per rule one for each of ``VOTES``.

    ``accuracy`` is the share of a rule's votes that are right, as the model sees it.
    """

    prior: float
    weights: tuple[tuple[float, float, float], ...]
    accuracy: tuple[float, ...]

    def log_odds(self, votes: list[Column]) -> Column:
        total = F.lit(self.prior)
        for vote, (bad, silent, good) in zip(votes, self.weights):
            total = total + F.when(vote == 1, good).when(vote == -1, bad).otherwise(silent)
        return total

    def posterior(self, votes: list[Column]) -> Column:
        return 1 / (1 + F.exp(-self.log_odds(votes)))


def pattern_counts(voted: DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The patterns of votes that occur, and how often each does."""
    if len(names) > MOST_RULES:
        raise ValueError(f"{len(names)} rules; patterns are counted for {MOST_RULES} at most")
    rows = voted.groupBy(*names).count().toPandas().sort_values(names)
    return rows[names].to_numpy(np.int64), rows["count"].to_numpy(float)


def fit_label_model(patterns: np.ndarray, counts: np.ndarray) -> LabelModel:
    """Expectation-maximisation over counted patterns; without any, what is assumed."""
    rules = patterns.shape[1]
    is_vote = np.stack([patterns == vote for vote in VOTES], axis=2).astype(float)
    among_good = np.tile(AMONG_GOOD, (rules, 1))
    among_bad = np.tile(AMONG_BAD, (rules, 1))
    share = SHARE_GOOD
    for _ in range(ROUNDS):
        odds = np.log(share / (1 - share))
        odds = odds + (is_vote * np.log(among_good / among_bad)).sum(axis=(1, 2))
        good = counts / (1 + np.exp(-odds))
        bad = counts - good
        before = share, among_good, among_bad
        share = (good.sum() + ASSUMED * SHARE_GOOD) / (counts.sum() + ASSUMED)
        among_good = _shares(good, is_vote, AMONG_GOOD)
        among_bad = _shares(bad, is_vote, AMONG_BAD)
        after = share, among_good, among_bad
        if max(np.abs(new - old).max() for new, old in zip(after, before)) < TOLERANCE:
            break
    right = share * among_good[:, 2] + (1 - share) * among_bad[:, 0]
    wrong = share * among_good[:, 0] + (1 - share) * among_bad[:, 2]
    return LabelModel(
        float(np.log(share / (1 - share))),
        tuple(map(tuple, np.log(among_good / among_bad).tolist())),
        tuple((right / (right + wrong)).tolist()),
    )


def _shares(members: np.ndarray, is_vote: np.ndarray, assumed) -> np.ndarray:
    seen = np.einsum("p,prv->rv", members, is_vote)
    return (seen + ASSUMED * np.array(assumed)) / (members.sum() + ASSUMED)
