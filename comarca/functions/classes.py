"""Classification ladders; the order of the steps is part of the definition."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ladder(value: Column, steps: list[tuple[str, float, str]], otherwise: str,
           if_null: str | None = None) -> Column:
    """First label whose test holds; ``steps`` are (operator, bound, label)."""
    tests = {">": lambda b: value > b, ">=": lambda b: value >= b,
             "<": lambda b: value < b, "<=": lambda b: value <= b}
    out = F.when(value.isNull(), if_null)
    for op, bound, label in steps:
        out = out.when(tests[op](F.lit(bound)), label)
    return out.otherwise(otherwise)


def coverage(months: Column) -> Column:
    return ladder(months, [(">=", 11, "complete"), (">=", 6, "partial")],
                  "limited", if_null="limited")


def unemployment_trend(change_pct: Column) -> Column:
    return ladder(change_pct, [(">", 10, "high_increase"), (">", 2, "moderate_increase"),
                               (">", -2, "stable"), (">", -10, "moderate_decrease")],
                  "high_decrease", if_null="no_comparison_data")


def population_trend(change: Column) -> Column:
    return ladder(change, [(">", 0, "growth"), ("<", 0, "decline")], "stable", if_null="no_data")


def population_magnitude(change_pct: Column) -> Column:
    return ladder(change_pct, [(">=", 5, "high_growth"), (">=", 1, "moderate_growth"),
                               (">", -1, "stable"), (">", -5, "moderate_decline")],
                  "high_decline", if_null="no_data")


def unemployment_level(rate: Column, if_null: str) -> Column:
    return ladder(rate, [("<", 5, "low_unemployment"), ("<", 10, "moderate_unemployment"),
                         ("<", 20, "high_unemployment")],
                  "very_high_unemployment", if_null=if_null)


def health(rate: Column, pop_change_pct: Column, strict: bool = False) -> Column:
    """Health of a place.  By default ``struggling`` is tested before the narrower
    ``critical`` and hides it; ``strict`` tests ``critical`` first."""
    critical = ((rate > 20) & (pop_change_pct < -5), "critical")
    steps = [((rate < 8) & (pop_change_pct > 1), "thriving"),
             ((rate < 12) & (pop_change_pct > 0), "growing"),
             ((rate > 15) & (pop_change_pct < -2), "struggling")]
    steps = steps[:2] + [critical] + steps[2:] if strict else steps + [critical]
    out = F
    for test, label in steps:
        out = out.when(test, label)
    return out.otherwise("stable")


def resilience(unemp_change_pct: Column, pop_change_pct: Column) -> Column:
    both = unemp_change_pct.isNotNull() & pop_change_pct.isNotNull()
    return (F.when(~both, None)
             .when((unemp_change_pct > 10) & (pop_change_pct > -2), "resilient")
             .when((unemp_change_pct > 10) & (pop_change_pct < -5), "exodus")
             .when((unemp_change_pct < -10) & (pop_change_pct > 2), "attractive")
             .otherwise("stable"))


def sign_quadrant(pop_change_pct: Column, unemp_change_pct: Column,
                  null_as: str | None = None) -> Column:
    """Direction of people against direction of unemployment."""
    up, down = pop_change_pct > 0, pop_change_pct < 0
    more, less = unemp_change_pct > 0, unemp_change_pct < 0
    return (F.when(pop_change_pct.isNull() | unemp_change_pct.isNull(), null_as)
             .when(up & less, "positive_growth")
             .when(down & more, "economic_decline")
             .when(up & more, "growing_with_challenges")
             .when(down & less, "declining_but_improving")
             .otherwise("stable"))
