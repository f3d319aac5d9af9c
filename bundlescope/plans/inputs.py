"""Input tables for the registered queries, derived from the given tables.

Each entry is one SELECT that Spark and DuckDB both run unchanged, over whole
tables. ``with_inputs`` puts the ones a statement uses in front of it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

# Declared, so that reading a table starts no job for its schema.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}

MASTER_COLUMNS = (
    "source, bundle, store_cat, category, segment, segment_grp, segment_grp_1, segment_grp_2, "
    "segment_index, last_update, platform, app_name, details, link, app_rank, app_age_grp, "
    "app_age_grp2, ifa_cnt"
)


def _bundle(key: str) -> str:
    """App id of a part key: every fifth app has a numeric one."""
    return (
        f"CASE WHEN {key} % 5 = 0 THEN CAST(100000 + {key} AS STRING) "
        f"ELSE 'com.app' || CAST({key} AS STRING) END"
    )


INPUTS = {
    "fx_category": """
SELECT * FROM (VALUES
 (0,'Art & Design'),(1,'Auto & Vehicles'),(2,'Beauty'),(3,'Books & Reference'),
 (4,'Business'),(5,'Comics'),(6,'Communication'),(7,'Dating'),(8,'Dictionary'),
 (9,'Education'),(10,'Entertainment'),(11,'Events'),(12,'Finance'),
 (13,'Food & Drink'),(14,'Games:Puzzle'),(15,'Games:Trivia'),(16,'Games:Word'),
 (17,'Game'),(18,'Graphics & Design'),(19,'Health & Fitness'),
 (20,'House & Home'),(21,'Libraries & Demo'),(22,'Lifestyle'),
 (23,'Maps & Navigation'),(24,'Medical'),(25,'Music:Downloader'),
 (26,'Music & Audio'),(27,'Navigation'),(28,'News & Magazines'),
 (29,'Parenting'),(30,'Tools:Personalization'),(31,'Photography'),
 (32,'Productivity'),(33,'Quote'),(34,'Reference'),(35,'Religious'),
 (36,'Shopping'),(37,'Simulation'),(38,'Social Networking'),(39,'Sports'),
 (40,'Tools'),(41,'Tools:Calculator'),(42,'Tools:Battery'),
 (43,'Tools:Scanner'),(44,'Tools:Security'),(45,'Tools:File Manager'),
 (46,'Tools:Browser'),(47,'Tools:Downloader'),(48,'Tools:Translator'),
 (49,'Tools:VPN'),(50,'Travel & Local'),(51,'Utilities'),
 (52,'Video:Downloader'),(53,'Video Players'),(54,'Weather'),(55,'Not Found'),
 (56,''),(57,'Unlisted'),(58,'beauty'),(59,'Tools:File Share'),
 (60,CAST(NULL AS STRING)),(61,'Tools:Clock'),(62,'Tools:Developer'),
 (63,'Tools:Flashlight'),(64,'Tools:Remote'),(65,'Tools:Booster'),
 (66,'Tools:Cleaner'),(67,'Tools:SpeedTest'),(68,'Games:Action'),
 (69,'Personalization'),(70,'Family:Game')) AS t(k, category)
""",
    "fx_app": f"""
SELECT p.p_partkey, p.p_size, {_bundle("p.p_partkey")} AS bundle,
  p.p_name || CASE p.p_partkey % 13 WHEN 0 THEN ' bank' WHEN 1 THEN ' bitcoin'
    WHEN 2 THEN ' music' WHEN 3 THEN ' yoga' WHEN 4 THEN ' wallpaper'
    WHEN 5 THEN ' bank bitcoin' WHEN 6 THEN ' Bank' ELSE '' END AS app_name,
  CASE p.p_partkey % 17 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN 'calculator'
    WHEN 2 THEN 'battery' WHEN 3 THEN 'fitness' WHEN 4 THEN 'audio' ELSE '' END AS details,
  'https://store.example/' || CAST(p.p_partkey AS STRING) AS link,
  lower(p.p_type) AS app_cat, CAST(p.p_size AS STRING) AS app_rank, c.category
FROM part p LEFT JOIN fx_category c ON p.p_partkey % 71 = c.k
""",
    # A record per order line: a device (customer) of one country on one day with
    # a rarely seen app, a popular one, and the app every device comes with.
    "fx_records": f"""
SELECT CASE c.c_nationkey % 5 WHEN 0 THEN 'MY' WHEN 1 THEN 'TH' WHEN 2 THEN 'PH'
    WHEN 3 THEN 'ID' ELSE 'SG' END AS country,
  replace(CAST(CAST(o.o_orderdate AS DATE) AS STRING), '-', '') AS date,
  CASE WHEN l.l_linenumber = 7 AND c.c_custkey % 10 = 0 THEN CAST(NULL AS STRING)
    ELSE 'ifa-' || CAST(c.c_custkey AS STRING) END AS ifa,
  CASE WHEN l.l_partkey = 59 THEN CAST(NULL AS STRING)
    ELSE {_bundle("l.l_partkey")} END AS rare,
  {_bundle("l.l_suppkey")} AS popular,
  'com.app1' AS everywhere,
  CASE WHEN l.l_quantity = 1 THEN 'no list' WHEN l.l_quantity = 2 THEN 'empty list'
    ELSE 'list' END AS form
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
""",
    "fx_known_apps": """
SELECT bundle, CASE p_partkey % 7 WHEN 0 THEN 'Not Found' WHEN 1 THEN ''
  WHEN 2 THEN CAST(NULL AS STRING) ELSE category END AS category
FROM fx_app WHERE p_size <= 25
""",
    "fx_done": """
SELECT a.bundle FROM lineitem l JOIN fx_app a ON l.l_partkey = a.p_partkey
WHERE l.l_returnflag = 'N' AND l.l_tax >= 0.08
""",
    "fx_ref_app": """
SELECT * FROM (VALUES
 ('ECONOMY','FINANCE','Finance','Corporate Professional'),
 ('SMALL','ENTERTAINMENT','Entertainment','Entertainment Lover'),
 ('MEDIUM','HEALTH','Health & Fitness','Health Junkie & Fitness Junkie'),
 ('PROMO','TOOLS','Tools','Not Found'),
 ('TOOLS','TOOLS','Tools','Not Found'),
 ('STANDARD','BOOKS','Books & Reference','Bookworm')
) AS t(app_cat, store_cat, category, segment_grp)
""",
    "fx_ref_persona": """
SELECT * FROM (VALUES ('Corporate Professional','11'),('Bookworm','4'),
 ('Entertainment Lover','12'),('Not Found','99')) AS t(ref_segment_grp_1, segment_index)
""",
    "fx_persona_rows": """
SELECT a.p_partkey, a.p_size, '20000101-20000131' AS source, a.bundle, r.store_cat, a.category,
  '' AS segment, r.segment_grp,
  CASE a.p_partkey % 19 WHEN 0 THEN 'Fitness Junkie' WHEN 1 THEN 'Health Junkie'
    WHEN 2 THEN 'Wealth Manager' WHEN 3 THEN 'Budget Manager'
    WHEN 4 THEN 'Passive Entertainer' WHEN 5 THEN 'Social Butterfly'
    WHEN 6 THEN 'Creative Crowd' WHEN 7 THEN 'Phone Phreak' WHEN 8 THEN 'Gamers'
    WHEN 9 THEN 'Health and Fitness Junkie' WHEN 10 THEN ''
    WHEN 11 THEN 'Heealth Junkie' WHEN 12 THEN 'Bookworm'
    ELSE r.segment_grp END AS segment_grp_1,
  '' AS segment_grp_2, q.segment_index, '01/02/2000' AS last_update,
  CASE WHEN a.p_partkey % 5 = 0 THEN 'IOS' ELSE 'ANDROID' END AS platform,
  a.app_name, CASE WHEN a.p_partkey % 37 = 0 THEN ' two' || chr(10) || 'lines, "quoted" ' || chr(92) || ' '
    ELSE a.details END AS details, a.link, a.app_rank, '' AS app_age_grp, '' AS app_age_grp2,
  CAST(a.p_partkey AS DOUBLE) AS ifa_cnt
FROM fx_app a
LEFT JOIN fx_ref_app r ON upper(a.app_cat) = r.app_cat
LEFT JOIN fx_ref_persona q ON r.segment_grp = q.ref_segment_grp_1
""",
    "fx_persona_list": f"SELECT {MASTER_COLUMNS} FROM fx_persona_rows",
    "fx_old_list": f"SELECT {MASTER_COLUMNS} FROM fx_persona_rows WHERE p_size <= 30",
    # Overlaps the old list, has blank and NULL apps, and a third of it is one app.
    "fx_new_list": """
SELECT '20000201-20000229' AS source,
  CASE WHEN p_partkey % 23 = 0 THEN '' WHEN p_partkey % 29 = 0 THEN CAST(NULL AS STRING)
    WHEN p_partkey % 3 = 1 THEN 'com.everywhere' ELSE bundle END AS bundle,
  store_cat, category, segment, segment_grp, segment_grp AS segment_grp_1, segment_grp_2,
  segment_index, '01/03/2000' AS last_update, platform, app_name, details, link, app_rank,
  app_age_grp, app_age_grp2, ifa_cnt + 1 AS ifa_cnt
FROM fx_persona_rows WHERE p_size >= 20
""",
    # An earlier batch result per order line: an app is repeated, partly with equal counts.
    "fx_metadata": """
SELECT a.bundle, a.link AS app_url, a.app_name AS appl_name, a.details AS app_detail, a.app_cat,
  a.app_rank, 'Rated for 3+' AS app_age_grp, '' AS app_age_grp2, l.l_quantity AS unique_ifa
FROM lineitem l JOIN fx_app a ON l.l_partkey = a.p_partkey
""",
    "fx_payload": """
SELECT bundle,
  CASE WHEN p_partkey % 11 = 0 THEN CAST(NULL AS STRING)
    WHEN p_partkey % 4 = 0 THEN '{"resultCount":0,"results":[]}'
    ELSE '{"resultCount":1,"results":[{"trackName":"' || app_name || '","primaryGenreName":"'
      || app_cat || '","averageUserRating":4.5,"trackViewUrl":"' || link || '"'
      || CASE p_partkey % 3 WHEN 0 THEN ',"description":null'
         WHEN 1 THEN ',"description":"' || COALESCE(details, '') || '"' ELSE '' END
      || CASE WHEN p_partkey % 31 = 0 THEN '}]' ELSE '}]}' END END AS lookup_json,
  CASE WHEN p_partkey % 19 = 0 THEN CAST(NULL AS STRING) ELSE
    '<html><!-- <h1 itemprop="name">draft</h1> --><h1 class="t" itemprop="name">'
      || '<span>' || app_name || '</span> &amp; more &#8211; caf&eacute;</h1>'
      || CASE WHEN p_partkey % 23 = 0 THEN '<a itemprop="genre">x</a>'
         WHEN p_partkey % 3 = 0 THEN ''
         WHEN p_partkey % 3 = 1 THEN '<a itemprop="genre" href="/store/apps/category/'
           || app_cat || '">x</a>'
         WHEN p_partkey % 5 = 1 THEN '<a title="5" tall" itemprop=genre href=/store/apps/category/'
           || replace(app_cat, ' ', '_') || '>x</a>'
         ELSE '<a href=''/store/apps/category/' || app_cat || ''' itemprop=''genre''>x</a>' END
      || CASE WHEN p_partkey % 2 = 0 THEN '<img alt="Rated for 3+" class="T75of E1GfKc"/>'
         ELSE '<img class="T75of" alt="logo">' END || '</html>' END AS html,
  CASE WHEN p_partkey % 17 = 0 THEN CAST(NULL AS STRING) ELSE
    '<html><h1 itemprop="name">' || app_name || '</h1>'
      || CASE p_partkey % 3 WHEN 1 THEN '<meta itemprop="applicationSubCategory" content="'
           || upper(app_cat) || '">' ELSE '' END
      || '<meta itemprop="applicationCategory" content="tOOls"></html>' END AS alt_html
FROM fx_app
""",
}


def with_inputs(statement: str, views: dict[str, str] = INPUTS) -> str:
    """The statement behind a WITH clause holding the views it uses, directly or not."""
    used: dict[str, None] = {}

    def visit(text: str) -> None:
        words = set(re.findall(r"\w+", text))
        for name in views:
            if name in words and name not in used:
                visit(views[name])
                used[name] = None

    visit(statement)
    clauses = ", ".join(f"{name} AS ({views[name].strip()})" for name in used)
    return f"WITH {clauses} {statement}" if used else statement


class Inputs:
    """The derived inputs of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        """A given table."""
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def sql(self, statement: str) -> DataFrame:
        """Run a statement over the derived inputs and the given tables it names."""
        full = with_inputs(statement)
        words = set(re.findall(r"\w+", full))
        for name in SCHEMAS:
            if name in words:
                self.table(name).createOrReplaceTempView(name)
        return self.spark.sql(full)

    def view(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM {name}")

    def payloads(self) -> DataFrame:
        """Payload documents. What they are made from is spread over tasks by app first: a
        small file is read by one task, which would then make and parse every document."""
        self.table("part").repartition("p_partkey").createOrReplaceTempView("spread_part")
        views = {name: re.sub(r"\bFROM part p\b", "FROM spread_part p", text) for name, text in INPUTS.items()}
        return self.spark.sql(with_inputs("SELECT * FROM fx_payload", views))

    def sightings(self) -> DataFrame:
        """Device records with their apps as a nested list, which may be empty or missing."""
        return self.sql("""
            SELECT country, date, ifa,
              CASE form WHEN 'list' THEN array(named_struct('bundle', rare),
                  named_struct('bundle', popular), named_struct('bundle', everywhere))
                WHEN 'empty list' THEN CAST(array() AS ARRAY<STRUCT<bundle: STRING>>)
              END AS app
            FROM fx_records""")

    def metadata_results(self) -> DataFrame:
        return self.sql("""
            SELECT bundle, unique_ifa,
              named_struct('app_url', app_url, 'appl_name', appl_name, 'app_detail', app_detail,
                'app_cat', app_cat, 'app_rank', app_rank, 'app_age_grp', app_age_grp,
                'app_age_grp2', app_age_grp2) AS mapped_info
            FROM fx_metadata""")
