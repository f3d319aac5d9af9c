import random

import pytest

from bundlescope import fixed_values as fixed
from bundlescope import schemas
from bundlescope.functions.rules import SEGMENT_RULES, refine_segments
from bundlescope.functions.text import shortest_words
from bundlescope.operators import merging

NAMES = schemas.MASTER_LIST.fieldNames()


def listed(spark, *rows):
    """Rows of the master list from the few columns given by name."""
    return spark.createDataFrame(
        [tuple(row.get(name) for name in NAMES) for row in rows], schemas.MASTER_LIST
    )


def test_old_row_wins_and_blank_apps_go(spark):
    old = listed(spark, dict(bundle="a", details="old"), dict(bundle="", details="x"), dict(bundle=None))
    new = listed(spark, dict(bundle="a", details="new"), dict(bundle="b", details="new"), dict(bundle=""))
    got = {r["bundle"]: r["details"] for r in merging.merge_lists(old, new).collect()}
    assert got == {"a": "old", "b": "new"}


def test_choice_does_not_depend_on_order_or_partitions(spark):
    rows = [dict(bundle=f"b{n % 5}", source=s, details=d) for n in range(40) for s in ("x", None) for d in ("p", "q")]
    first = None
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = listed(spark, *rows).repartition(seed * 3 + 1)
        got = sorted(map(repr, merging.one_row_per_app(df).collect()))
        first = first or got
        assert got == first and len(got) == 5


def test_one_hot_app_is_reduced_before_the_shuffle(spark):
    df = listed(spark, *[dict(bundle="hot", details=str(n)) for n in range(1000)])
    merged = merging.one_row_per_app(df)
    assert merged.first()["details"] == "0"
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_index_is_refreshed_from_the_old_list(spark):
    old = listed(
        spark, dict(bundle="a", segment_grp_1="G", segment_index="1"),
        dict(bundle="b", segment_grp_1="F", segment_index="2"),
        dict(bundle="c", segment_grp_1="F", segment_index="3"),
        dict(bundle="d", segment_grp_1="H", segment_index=None),
    )
    new = listed(
        spark, dict(bundle="x", segment_grp_1="G", segment_index="9"),
        dict(bundle="y", segment_grp_1="F"), dict(bundle="z", segment_grp_1="H", segment_index="9"),
        dict(bundle="w"),
    )
    reference = merging.segment_index_reference(old)
    got = merging.refresh_segment_index(new, reference)
    pairs = sorted(((r["bundle"], r["segment_index"]) for r in got.collect()), key=repr)
    assert pairs == [("w", None), ("x", "1"), ("y", "2"), ("y", "3"), ("z", None)]
    assert merging.align(got, old).columns == NAMES
    assert merging.stack(old, got).count() == 9


def test_align_reports_missing_and_mistyped_columns(spark):
    old = listed(spark, dict(bundle="a"))
    with pytest.raises(Exception, match="ifa_cnt"):
        merging.align(old.drop("ifa_cnt"), old)
    with pytest.raises(ValueError, match="ifa_cnt"):
        merging.align(old.withColumn("ifa_cnt", old.ifa_cnt.cast("string")), old)
    assert merging.align(old.withColumn("extra", old.bundle), old).columns == NAMES


def test_column_names_are_trimmed(spark):
    df = spark.createDataFrame([(1, 2)], "` a ` int, `b ` int")
    assert merging.trim_column_names(df).columns == ["a", "b"]


# ---- rules -----------------------------------------------------------------

CORP, FUN, HEALTH = fixed.CORPORATE, fixed.ENTERTAINMENT, fixed.HEALTH


@pytest.mark.parametrize(
    "grp,grp_1,name,details,want",
    [
        (CORP, CORP, "my bank", None, "Budget Manager"),
        (CORP, CORP, None, "a bank", "Budget Manager"),
        (CORP, CORP, "bank bitcoin", "", "Budget Manager"),
        (CORP, CORP, "bitcoin", "", "Wealth Manager"),
        (CORP, CORP, "TAKA", "", "Wealth Manager"),
        (CORP, CORP, "taka", "", "Not Found"),
        (CORP, CORP, "configuration", "", "Budget Manager"),
        (CORP, CORP, "Bank", "", "Not Found"),
        (CORP, CORP, None, None, "Not Found"),
        (CORP, None, "bank", "", None),
        (CORP, "Bookworm", "bank", "", "Not Found"),
        (CORP, "Wealth Manager", "bank", "", "Wealth Manager"),
        (FUN, FUN, "", "video players", "Passive Entertainer"),
        (FUN, FUN, "chess", "", "Gamers"),
        (FUN, None, "music", "", None),
        (FUN, "Bookworm", "music", "", "Gamers"),
        (HEALTH, HEALTH, "yoga", "", "Fitness Junkie"),
        (HEALTH, HEALTH, "sleep", "", HEALTH),
        ("Not Found", "Bookworm", "wallpaper", "", "Phone Phreak"),
        ("Not Found", None, "", "screen", "Phone Phreak"),
        ("Not Found", "Not Found", "bank", "", "Not Found"),
        (None, CORP, "bank wallpaper", "", CORP),
        ("Bookworm", "Bookworm", "bank", "", "Bookworm"),
    ],
)
def test_rules(spark, grp, grp_1, name, details, want):
    df = listed(spark, dict(segment_grp=grp, segment_grp_1=grp_1, app_name=name, details=details))
    once = refine_segments(df)
    assert once.first()["segment_grp_1"] == want
    assert refine_segments(once).first()["segment_grp_1"] == want


def test_a_corporate_leftover_is_not_taken_for_a_phone_app(spark):
    df = listed(spark, dict(segment_grp=CORP, segment_grp_1=CORP, app_name="wallpaper"))
    assert refine_segments(df).first()["segment_grp_1"] == "Not Found"


def test_rule_list():
    assert [rule.name for rule in SEGMENT_RULES] == [
        "budget", "wealth", "corporate_rest", "entertainer", "gamers", "fitness", "phone",
    ]
    assert shortest_words(fixed.WEALTH_WORDS)[:2] == ["share", "euro"]
    assert "bitcoin" not in shortest_words(fixed.WEALTH_WORDS)
    assert shortest_words(["a", "a"]) == ["a"]
