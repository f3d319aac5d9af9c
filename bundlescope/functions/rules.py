"""Segment refinement as an ordered list of rule records.

A rule looks at the reference segment (``segment_grp``), at the refined segment
reached so far (``segment_grp_1``) and at the words in an app's name and
details. Rules run in order, each on the outcome of the one before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundlescope import fixed_values as fixed
from bundlescope.functions.text import mentions

TEXT_COLUMNS = ("app_name", "details")


@dataclass(frozen=True)
class SegmentRule:
    name: str
    group: str
    becomes: str
    only_from: tuple[str, ...] = ()
    never_from: tuple[str, ...] = ()
    words: tuple[str, ...] = ()

    def condition(self) -> Column:
        """Cheap equality tests first, so that text is searched only where needed."""
        test = F.col("segment_grp") == self.group
        current = F.col("segment_grp_1")
        if self.only_from:
            test = test & current.isin(*self.only_from)
        if self.never_from:
            test = test & ~current.isin(*self.never_from)
        if self.words:
            test = test & mentions(TEXT_COLUMNS, self.words)
        return test

    def outcome(self) -> Column:
        """New ``segment_grp_1``; a NULL condition leaves the row as it is."""
        return F.when(self.condition(), F.lit(self.becomes)).otherwise(F.col("segment_grp_1"))


SEGMENT_RULES = (
    SegmentRule(
        "budget",
        group=fixed.CORPORATE,
        only_from=(fixed.CORPORATE,),
        words=fixed.BUDGET_WORDS,
        becomes=fixed.BUDGET_MANAGER,
    ),
    SegmentRule(
        "wealth",
        group=fixed.CORPORATE,
        only_from=(fixed.CORPORATE,),
        words=fixed.WEALTH_WORDS,
        becomes=fixed.WEALTH_MANAGER,
    ),
    SegmentRule(
        "corporate_rest",
        group=fixed.CORPORATE,
        never_from=(fixed.WEALTH_MANAGER, fixed.BUDGET_MANAGER),
        becomes=fixed.NOT_FOUND,
    ),
    SegmentRule(
        "entertainer",
        group=fixed.ENTERTAINMENT,
        only_from=(fixed.ENTERTAINMENT,),
        words=fixed.ENTERTAINMENT_WORDS,
        becomes=fixed.PASSIVE_ENTERTAINER,
    ),
    SegmentRule(
        "gamers",
        group=fixed.ENTERTAINMENT,
        never_from=(fixed.PASSIVE_ENTERTAINER,),
        becomes=fixed.GAMERS,
    ),
    SegmentRule(
        "fitness",
        group=fixed.HEALTH,
        only_from=(fixed.HEALTH,),
        words=fixed.FITNESS_WORDS,
        becomes=fixed.FITNESS_JUNKIE,
    ),
    SegmentRule(
        "phone",
        group=fixed.NOT_FOUND,
        words=fixed.PHONE_WORDS,
        becomes=fixed.PHONE_PHREAK,
    ),
)


def refine_segments(apps: DataFrame, rules: Sequence[SegmentRule] = SEGMENT_RULES) -> DataFrame:
    """Apply the rules in order. Map-only and idempotent."""
    for rule in rules:
        apps = apps.withColumn("segment_grp_1", rule.outcome())
    return apps
