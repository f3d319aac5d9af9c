from decimal import Decimal

import pytest

from bundlescope import schemas
from bundlescope.functions import personas
from bundlescope.operators.persona_view import persona_table_rows, persona_view

NAMES = schemas.PERSONA_TABLE.fieldNames()


def table(spark, *rows):
    """(bundle, category, segment_grp_1) rows of the persona table."""
    values = [dict(bundle=b, category=c, segment_grp_1=s) for b, c, s in rows]
    return spark.createDataFrame(
        [tuple(v.get(n) for n in NAMES) for v in values], schemas.PERSONA_TABLE
    )


def tags(df):
    return sorted(
        ((r["bundle"], r["persona"], r["rank"], r["app_category"]) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize(
    "category,want",
    [
        ("Music:Downloader", ["Mobile Performance", "Music"]),
        ("Tools:Personalization", ["Personalization"]),
        ("Tools:Downloader", ["Mobile Performance", "Photo, Video & Editing"]),
        ("Tools:Scanner", ["Mobile Performance", None]),
        ("Tools:Security", ["Mobile Performance", None]),
        ("Games:Word", ["Games"]),
        ("Games:Action", ["Games"]),
        ("Gamers", ["Games"]),
        ("Beauty", ["Beauty", "Health & Fitness"]),
        ("beauty", [None]),
        ("Events", ["Lifestyle", "Social"]),
        ("Video:Downloader", ["Mobile Performance", "Photo, Video & Editing"]),
        ("Bookings", ["Books and Comics"]),
        ("", ["Not Found"]),
        ("Not Found", ["Not Found"]),
        (None, ["Not Found"]),
        ("Unlisted", [None]),
        ("Sports", ["Lifestyle", "Sports"]),
    ],
)
def test_categories(spark, category, want):
    got = persona_view(table(spark, ("a", category, "Gamers"))).collect()
    assert sorted((r["app_category"] for r in got), key=repr) == sorted(want, key=repr)
    assert {r["rank"] for r in got} == {Decimal("10.0")}


def test_names_and_ranks(spark):
    df = table(
        spark, ("a", "x", None), ("b", "x", ""), ("c", "x", "Heealth Junkie"), ("d", "x", "Unheard of"),
        ("e", "x", "Fitness Junkie"),
    )
    assert tags(persona_view(df)) == [
        ("a", "Not Found", None, None),
        ("b", "Not Found", None, None),
        ("c", "Health Fanatics", Decimal("2.0"), None),
        ("d", "Unheard of", None, None),
        ("e", "Workout Warrior", Decimal("1.0"), None),
    ]


def test_one_group_differs_between_the_tags(spark):
    df = table(spark, ("a", "Games:Word", "Health and Fitness Junkie"))
    assert tags(persona_view(df)) == [
        ("a", "Health and Fitness Junkie", None, "Games"),
        ("a", "Workout Warrior", None, "Games"),
    ]


def test_equal_rows_collapse_unless_declared_unique(spark):
    df = table(spark, ("a", "Sports", "Gamers"), ("a", "Sports", "Gamers"))
    assert persona_view(df).count() == 2
    assert persona_view(df, unique_rows=True).count() == 4
    assert "Exchange" not in persona_view(df, True)._jdf.queryExecution().executedPlan().toString()


def test_schema(spark):
    view = persona_view(table(spark, ("a", "Sports", "Gamers")))
    assert view.columns == [*NAMES, "persona", "rank", "app_category"]
    assert dict(view.dtypes)["rank"] == "decimal(3,1)"


def test_table_rows_are_text(spark):
    values = {"bundle": "a", "ifa_cnt": 17.0}
    master = spark.createDataFrame(
        [tuple(values.get(n) for n in schemas.MASTER_LIST.fieldNames())], schemas.MASTER_LIST
    )
    rows = persona_table_rows(master)
    assert rows.columns == NAMES and {kind for _, kind in rows.dtypes} == {"string"}
    assert rows.first()["ifa_cnt"] == "17.0"


def test_values_that_would_break_the_text_are_refused():
    with pytest.raises(ValueError):
        personas.literal("it's")
