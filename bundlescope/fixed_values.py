"""Fixed values.

Word lists, names and numbers that results depend on. Nothing here is logic;
the modules under ``functions`` turn these values into Column expressions.
"""

from decimal import Decimal

# ---- usage -----------------------------------------------------------------
COUNTRIES = ("MY", "TH", "PH", "ID")
MIN_DEVICES = 20
BATCH_SIZE = 500
NOT_FOUND = "Not Found"

# ---- store metadata --------------------------------------------------------
METADATA_FIELDS = (
    "app_url",
    "appl_name",
    "app_detail",
    "app_cat",
    "app_rank",
    "app_age_grp",
    "app_age_grp2",
)
LOOKUP_FIELDS = (
    "trackViewUrl",
    "trackName",
    "description",
    "primaryGenreName",
    "averageUserRating",
    "ageRating",
    "contentAdvisoryRating",
)
STORE_A_URL = "https://play.google.com/store/apps/details?id="
STORE_B_URL = "https://arkapk.com/app/"
AGE_BADGE_CLASS = "T75of E1GfKc"

# ---- segment groups and the words that refine them -------------------------
CORPORATE = "Corporate Professional"
ENTERTAINMENT = "Entertainment Lover"
HEALTH = "Health Junkie & Fitness Junkie"

BUDGET_MANAGER = "Budget Manager"
WEALTH_MANAGER = "Wealth Manager"
PASSIVE_ENTERTAINER = "Passive Entertainer"
GAMERS = "Gamers"
FITNESS_JUNKIE = "Fitness Junkie"
PHONE_PHREAK = "Phone Phreak"

BUDGET_WORDS = (
    "transaction", "invoice", "bill", "trx", "expenses", "ratio", "cash", "loan", "money",
    "credit", "calculator", "bank", "earn", "tax", "income", "jobs", "cv", "resume",
)
WEALTH_WORDS = (
    "share", "share price", "euro", "rupiah", "yuan", "ringgit", "riyal", "TAKA", "invest",
    "bit", "bitcoin", "coin", "dollar", "mining", "gold", "stock", "market", "exchange",
)
ENTERTAINMENT_WORDS = ("entertainment", "music", "audio", "video players")
FITNESS_WORDS = ("workout", "fitness", "yoga", "exercise", "trainer", "weight")
PHONE_WORDS = ("wallpaper", "sticker", "keyboard", "theme", "battery", "screen")

# ---- persona names and ranks per refined segment group ---------------------
PERSONA_NAMES = (
    (("Fitness Junkie",), "Workout Warrior"),
    (("Health Junkie", "Heealth Junkie"), "Health Fanatics"),
    (("Wealth Manager",), "Wealth Manager"),
    (("Bookworm",), "Bookworm"),
    (("Budget Manager",), "Budget Managers"),
    (("Passive Entertainer",), "Entertainment Junkies"),
    (("Social Butterfly",), "Social Butterflies"),
    (("Creative Crowd",), "Creative Crowd"),
    (("Phone Phreak",), "Phone Enthusiast"),
    (("Gamers",), "Gamers"),
)
# Renamed on the primary tag only; the second tag keeps this group's own name.
PERSONA_NAMES_PRIMARY_ONLY = ((("Health and Fitness Junkie",), "Workout Warrior"),)

PERSONA_RANKS = (
    (("Fitness Junkie",), Decimal("1.0")),
    (("Health Junkie", "Heealth Junkie"), Decimal("2.0")),
    (("Wealth Manager",), Decimal("3.0")),
    (("Bookworm",), Decimal("4.0")),
    (("Budget Manager",), Decimal("5.0")),
    (("Passive Entertainer",), Decimal("6.0")),
    (("Social Butterfly",), Decimal("7.0")),
    (("Creative Crowd",), Decimal("8.0")),
    (("Phone Phreak",), Decimal("9.0")),
    (("Gamers",), Decimal("10.0")),
)

# ---- app category per store category, first hit wins; % as in LIKE ---------
APP_CATEGORIES = (
    ("Art & Design", "Art, Graphics & Design"),
    ("Auto & Vehicles", "Auto & Vehicles"),
    ("Beauty", "Health & Fitness"),
    ("Book%", "Books and Comics"),
    ("Business", "Business"),
    ("Comics", "Books and Comics"),
    ("Communication", "Social"),
    ("Dating", "Social"),
    ("Dictionary", "Education and Training"),
    ("Education", "Education and Training"),
    ("Entertainment", "Entertainment"),
    ("Events", "Social"),
    ("Finance", "Finance"),
    ("Food & Drink", "Food & Drink"),
    ("Game%", "Games"),
    ("Graphics & Design", "Art, Graphics & Design"),
    ("Health & Fitness", "Health & Fitness"),
    ("House & Home", "House & Home"),
    ("Libraries & Demo", "Education and Training"),
    ("Lifestyle%", "Lifestyle"),
    ("Maps & Navigation", "Travel"),
    ("Medical", "Medical"),
    ("Music%", "Music"),
    ("Navigation", "Travel"),
    ("News%", "News & Magazines"),
    ("Parenting", "Parenting"),
    ("%Personalization%", "Personalization"),
    ("Photo%", "Photo, Video & Editing"),
    ("Productivity%", "Office & Productivity"),
    ("Quote", "Education and Training"),
    ("Reference", "Education and Training"),
    ("Religious", "Religious"),
    ("Shopping", "Shopping"),
    ("Simulation", "Games"),
    ("Social%", "Social"),
    ("Sports", "Sports"),
    ("Tools", "Tools & Utilities"),
    ("Tools:Calculator", "Tools & Utilities"),
    ("Tools:Clock", "Tools & Utilities"),
    ("Tools:Developer", "Tools & Utilities"),
    ("Tools:Flashlight", "Tools & Utilities"),
    ("Tools:Remote", "Tools & Utilities"),
    ("Tools:Battery", "Mobile Performance"),
    ("Tools:Booster", "Mobile Performance"),
    ("Tools:Cleaner", "Mobile Performance"),
    ("Tools:Scanner", "Mobile Performance"),
    ("Tools:Security", "Mobile Performance"),
    ("Tools:SpeedTest", "Mobile Performance"),
    ("Tools:File Manager", "Office & Productivity"),
    ("Tools:File Share", "Office & Productivity"),
    ("Tools:Browser", "Mobile Performance"),
    ("Tools:Downloader", "Photo, Video & Editing"),
    ("Tools:Translator", "Translation"),
    ("Tools:VPN", "Mobile Performance"),
    ("Travel%", "Travel"),
    ("Utilities", "Tools & Utilities"),
    ("Video%", "Photo, Video & Editing"),
    ("Weather", "Tools & Utilities"),
    ("", "Not Found"),
    ("Not Found", "Not Found"),
)

# Store categories that carry a second tag, and that tag (None: tagged, no name).
SECOND_TAGS = (
    ("Beauty", "Beauty"),
    ("Communication", "Communication"),
    ("Events", "Lifestyle"),
    ("Games:Puzzle", "Games"),
    ("Games:Trivia", "Games"),
    ("Games:Word", "Games"),
    ("House & Home", "Lifestyle"),
    ("Music:Downloader", "Mobile Performance"),
    ("Shopping", "Lifestyle"),
    ("Sports", "Lifestyle"),
    ("Tools:Downloader", "Mobile Performance"),
    ("Tools:Scanner", None),
    ("Tools:Security", None),
    ("Video:Downloader", "Mobile Performance"),
)
