"""Every word, name, rank and category by its outcome, written out and taken from no module under test."""

from decimal import Decimal

from pyspark.sql import functions as F

from bundlescope import schemas
from bundlescope.functions import personas
from bundlescope.functions.rules import refine_segments

# Group, the words that refine it, and what it becomes with such a word and without.
REFINED = [
    (
        "Corporate Professional",
        "transaction invoice bill trx expenses ratio cash loan money credit calculator bank earn tax income jobs cv resume",
        "Budget Manager",
        "Not Found",
    ),
    (
        "Corporate Professional",
        "share euro rupiah yuan ringgit riyal TAKA invest bit bitcoin coin dollar mining gold stock market exchange",
        "Wealth Manager",
        "Not Found",
    ),
    ("Entertainment Lover", "entertainment music audio video_players", "Passive Entertainer", "Gamers"),
    (
        "Health Junkie & Fitness Junkie",
        "workout fitness yoga exercise trainer weight",
        "Fitness Junkie",
        "Health Junkie & Fitness Junkie",
    ),
    ("Not Found", "wallpaper sticker keyboard theme battery screen", "Phone Phreak", "Not Found"),
]
# Refined group, persona of the first tag, persona of the second tag, rank.
PERSONAS = [
    ("Fitness Junkie", "Workout Warrior", "Workout Warrior", "1.0"),
    ("Health and Fitness Junkie", "Workout Warrior", "Health and Fitness Junkie", None),
    ("Health Junkie", "Health Fanatics", "Health Fanatics", "2.0"),
    ("Heealth Junkie", "Health Fanatics", "Health Fanatics", "2.0"),
    ("Wealth Manager", "Wealth Manager", "Wealth Manager", "3.0"),
    ("Bookworm", "Bookworm", "Bookworm", "4.0"),
    ("Budget Manager", "Budget Managers", "Budget Managers", "5.0"),
    ("Passive Entertainer", "Entertainment Junkies", "Entertainment Junkies", "6.0"),
    ("Social Butterfly", "Social Butterflies", "Social Butterflies", "7.0"),
    ("Creative Crowd", "Creative Crowd", "Creative Crowd", "8.0"),
    ("Phone Phreak", "Phone Enthusiast", "Phone Enthusiast", "9.0"),
    ("Gamers", "Gamers", "Gamers", "10.0"),
    ("Anything else", "Anything else", "Anything else", None),
    ("", "Not Found", "Not Found", None),
    (None, "Not Found", "Not Found", None),
]
# App category, and the store categories that have it.
CATEGORIES = {
    "Art, Graphics & Design": ["Art & Design", "Graphics & Design"],
    "Auto & Vehicles": ["Auto & Vehicles"],
    "Health & Fitness": ["Beauty", "Health & Fitness"],
    "Books and Comics": ["Book", "Books & Reference", "Comics"],
    "Business": ["Business"],
    "Social": ["Communication", "Dating", "Events", "Social", "Social Networking"],
    "Education and Training": ["Dictionary", "Education", "Libraries & Demo", "Quote", "Reference"],
    "Entertainment": ["Entertainment"],
    "Finance": ["Finance"],
    "Food & Drink": ["Food & Drink"],
    "Games": ["Game", "Games:Puzzle", "Simulation"],
    "House & Home": ["House & Home"],
    "Lifestyle": ["Lifestyle", "Lifestyle:x"],
    "Travel": ["Maps & Navigation", "Navigation", "Travel", "Travel & Local"],
    "Medical": ["Medical"],
    "Music": ["Music", "Music:Downloader"],
    "News & Magazines": ["News", "News & Magazines"],
    "Parenting": ["Parenting"],
    "Personalization": ["Personalization", "Tools:Personalization"],
    "Photo, Video & Editing": ["Photo", "Photography", "Tools:Downloader", "Video", "Video Players", "Video:Downloader"],
    "Office & Productivity": ["Productivity", "Tools:File Manager", "Tools:File Share"],
    "Religious": ["Religious"],
    "Shopping": ["Shopping"],
    "Sports": ["Sports"],
    "Tools & Utilities": [
        "Tools", "Tools:Calculator", "Tools:Clock", "Tools:Developer", "Tools:Flashlight", "Tools:Remote", "Utilities",
        "Weather",
    ],
    "Mobile Performance": [
        "Tools:Battery", "Tools:Booster", "Tools:Cleaner", "Tools:Scanner", "Tools:Security", "Tools:SpeedTest",
        "Tools:Browser", "Tools:VPN",
    ],
    "Translation": ["Tools:Translator"],
    "Not Found": ["", "Not Found", None],
    None: ["Tools:Other", "unlisted", "finance", " Finance"],
}
# Store categories with a second tag, and the tag.
SECOND = {
    "Beauty": "Beauty", "Communication": "Communication", "Events": "Lifestyle", "Games:Puzzle": "Games",
    "Games:Trivia": "Games", "Games:Word": "Games", "House & Home": "Lifestyle", "Music:Downloader": "Mobile Performance",
    "Shopping": "Lifestyle", "Sports": "Lifestyle", "Tools:Downloader": "Mobile Performance", "Tools:Scanner": None,
    "Tools:Security": None, "Video:Downloader": "Mobile Performance",
}


def master(spark, rows):
    names = schemas.MASTER_LIST.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.MASTER_LIST)


def test_every_word_refines_its_group(spark):
    rows, wanted = [], {}

    def add(name, group, text, details, becomes):
        app = f"app{len(rows)}"
        rows.append({"bundle": app, "segment_grp": group, "segment_grp_1": group, "app_name": text, "details": details})
        wanted[app] = (name, becomes)

    for group, words, becomes, otherwise in REFINED:
        for word in words.replace("_", " ").split() if "_" not in words else [w.replace("_", " ") for w in words.split()]:
            add(word, group, f"q{word}q", None, becomes)
            add(word, group, None, f"x\n{word}", becomes)
            if word != "TAKA":
                add(word.upper(), group, f"q{word.upper()}q", "", otherwise)
        add("no word", group, "zzz", "zzz", otherwise)
        add("no text", group, None, None, otherwise)
    refined = {r.bundle: r.segment_grp_1 for r in refine_segments(master(spark, rows)).collect()}
    assert {app: (wanted[app][0], group) for app, group in refined.items()} == wanted


def test_every_persona_and_rank(spark):
    rows = spark.createDataFrame([(n, p[0]) for n, p in enumerate(PERSONAS)], "n int, segment_grp_1 string")
    found = rows.select(
        "n", F.expr(personas.persona_name()).alias("first"), F.expr(personas.persona_name(primary=False)).alias("second"),
        F.expr(personas.persona_rank()).alias("rank"),
    )
    for r in found.collect():
        _, first, second, rank = PERSONAS[r["n"]]
        assert (r["first"], r["second"], r["rank"]) == (first, second, Decimal(rank) if rank else None)


def test_every_category(spark):
    wanted = {store: app for app, stores in CATEGORIES.items() for store in stores}
    rows = spark.createDataFrame([(c,) for c in wanted], "category string")
    found = rows.select(
        "category", F.expr(personas.app_category()).alias("first"), F.expr(personas.has_second_tag()).alias("tagged"),
        F.expr(personas.second_category()).alias("second"),
    )
    got = {r["category"]: r for r in found.collect()}
    assert {c: r["first"] for c, r in got.items()} == wanted
    assert {c for c, r in got.items() if r["tagged"]} == set(SECOND) & set(wanted)
    more = spark.createDataFrame([(c,) for c in SECOND], "category string")
    second = more.where(F.expr(personas.has_second_tag())).select("category", F.expr(personas.second_category()).alias("tag"))
    assert {r["category"]: r["tag"] for r in second.collect()} == SECOND
