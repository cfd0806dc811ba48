"""Rewards, judges and policy arithmetic as Column builders. A null correctness means unknown, never false."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VERDICTS = ("correct", "incorrect", "unclear")


def simple(correct: Column, intermediate: Column) -> Column:
    """1 for a right answer, -0.5 for a wrong one, 0 if unknown, plus the sum of intermediate rewards."""
    return F.when(correct, 1.0).when(~correct, -0.5).otherwise(0.0) + F.coalesce(intermediate, F.lit(0.0))


def efficiency(correct: Column, code_blocks: Column, errors: Column, most: Column) -> Column:
    """A right answer earns up to half a point for little code and loses a tenth an error; a wrong one loses more the more code it took."""
    share = code_blocks / F.when(most > 0, most)
    right = 1 + 0.5 * F.greatest(F.lit(0.0), 1 - F.coalesce(share, F.lit(1.0))) - 0.1 * errors
    return F.when(correct, right).otherwise(-0.5 - 0.3 * F.coalesce(share, F.lit(0.0)))


def normalised(total: Column, count: Column) -> Column:
    return total / F.greatest(count, F.lit(1))


def appended(steps: Column, final: Column) -> Column:
    """Step rewards with the final one behind, unless the last already equals it."""
    last = F.try_element_at(steps, F.lit(-1))
    return F.when((F.size(steps) == 0) | ~F.equal_null(last, final), F.array_append(steps, final)).otherwise(steps)


def composite(environment: Column, own: Column, economic: Column | None = None) -> Column:
    """0.6 environment and 0.4 own reward, and 0.5 economic where there is one; to four places, half to even."""
    out = 0.6 * F.coalesce(environment, F.lit(0.0)) + 0.4 * F.coalesce(own, F.lit(0.0))
    return F.bround(out if economic is None else out + 0.5 * F.coalesce(economic, F.lit(0.0)), 4)


def squashed(environment: Column, own: Column) -> Column:
    """Environment reward r as r/(1+|r|) within 0..1, half and half with the own reward."""
    r = F.coalesce(environment, F.lit(0.0))
    return 0.5 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), r / (1 + F.abs(r)))) + 0.5 * F.coalesce(own, F.lit(0.0))


def reward_bin(total: Column) -> Column:
    return F.when(total < -0.5, "below -0.5").when(total < 0, "-0.5 to 0").when(total < 0.5, "0 to 0.5").when(total < 1, "0.5 to 1").when(total >= 1, "1 and over")


def outcome(correct: Column) -> Column:
    return F.when(correct, "correct").when(~correct, "incorrect").otherwise("unknown")


def upper_median(values: Column) -> Column:
    """The element at n // 2 of the sorted values."""
    return F.try_element_at(F.sort_array(values), (F.floor(F.size(values) / 2) + 1).cast("int"))


def vote(verdict: Column, score: Column) -> Column:
    """A vote counts if its verdict is known and it has a score, which is then held within 0..1; null otherwise."""
    return F.when(verdict.isin(*VERDICTS) & score.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def backoff(initial: float, factor: float, attempt: Column, jitter: Column | None = None, most: float | None = None) -> Column:
    """Whole units of initial * factor ** attempt, with a jitter share on top, up to ``most``."""
    out = F.lit(initial) * F.pow(F.lit(factor), attempt)
    out = out if jitter is None else out * (1 + jitter)
    return F.floor(out if most is None else F.least(out, F.lit(most))).cast("long")


def learning_rate(rate: Column, speed: float, reward: Column) -> Column:
    return rate * F.greatest(F.lit(0.5), 1 - speed * reward)
