"""Fixture views over the driver tables.

The reference has no landed data, so event-shaped inputs are derived from the
given tables with portable SQL.  The same text runs on Spark (``spark.sql``
over temp views of the parquet tables) and on DuckDB (the correctness oracle),
so both sides read identical rows.  Every view reads its whole base table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

FIXTURE_SQL: dict[str, str] = {}

# severity 7 and category 'sports' are deliberately invalid
FIXTURE_SQL["raw_events"] = """
SELECT o_orderkey AS id,
 CAST(CASE WHEN o_orderkey % 103 = 0 THEN 0 ELSE 1 + (o_orderkey % 101) * 21 END AS INT) AS year,
 CASE o_orderkey % 8 WHEN 0 THEN 'Global financial crisis deepens' WHEN 1 THEN 'Civil war ends with a treaty'
  WHEN 2 THEN 'National patent reform adopted' WHEN 3 THEN 'European market crash' WHEN 4 THEN 'Major earthquake in Tokyo'
  WHEN 5 THEN 'Harbour opens in New York' WHEN 6 THEN 'ab' ELSE 'Civil war ends with a treaty.' END AS title,
 CASE o_orderkey % 3 WHEN 0 THEN 'A worldwide recession and inflation followed'
  WHEN 1 THEN 'Otto Bismarck met the German Empire & others, in Berlin' ELSE NULL END AS description,
 CASE o_orderkey % 7 WHEN 0 THEN 'economic' WHEN 1 THEN 'political' WHEN 2 THEN 'technological' WHEN 3 THEN 'social'
  WHEN 4 THEN 'environmental' WHEN 5 THEN 'economic' ELSE 'sports' END AS category,
 CASE o_orderkey % 4 WHEN 0 THEN 'wikipedia' WHEN 1 THEN 'world_bank' WHEN 2 THEN 'news_api' ELSE 'historical_database' END AS source,
 CASE WHEN o_orderkey % 11 = 0 THEN 7 WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 5 AS INT) END AS severity,
 CASE WHEN o_orderkey % 13 = 0 THEN 'not a url' ELSE 'https://example.org/e/' || CAST(o_orderkey AS VARCHAR(20)) END AS source_url,
 CASE WHEN o_orderkey % 17 = 0 THEN '2020-02-30' WHEN o_orderkey % 2 = 0 THEN '1999-05-04T10:00:00Z' ELSE NULL END AS date,
 o_orderkey % 6 = 0 AS verified
FROM orders
"""

FIXTURE_SQL["wiki_pages"] = """
SELECT c_custkey AS page_id, 'Page ' || CAST(1000 + c_custkey % 1100 AS VARCHAR(10)) AS title,
 CASE c_custkey % 4 WHEN 0 THEN 'Preamble text is dropped.' || chr(10) || '== Economy ==' || chr(10)
   || 'A deep recession began in Paris. Trade fell across the market! Then recovery came slowly.' || chr(10)
   || '== Empty ==' || chr(10) || '=== Conflicts ===' || chr(10)
   || '* Otto Bismarck led the German Empire in the war, after a coup in 1871'
  WHEN 1 THEN 'No headers at all here, only one sentence about 1950 and 1960.' WHEN 2 THEN 'short' ELSE '' END AS content
FROM customer
"""

# stands for one indicator per country
# Sums are taken over integer cents so that every engine and every
# partitioning gives the same double (a sum of doubles depends on order).
FIXTURE_SQL["yearly_series"] = """
SELECT n_name AS country, year(o_orderdate) AS year,
 CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / CAST(100 AS DOUBLE) AS value
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, year(o_orderdate)
"""

# stands for one stock index per brand
FIXTURE_SQL["monthly_series"] = """
SELECT p_brand AS symbol, year(l_shipdate) * 100 + month(l_shipdate) AS ym,
 CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) / CAST(100 AS DOUBLE) AS close
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_brand, year(l_shipdate) * 100 + month(l_shipdate)
"""

# News articles (title, description, content, url, publishedAt, source name),
# one per order; dates come from the order date in two ISO offsets.
FIXTURE_SQL["news_articles"] = """
SELECT o_orderkey AS article_id,
 CASE o_orderkey % 6 WHEN 0 THEN 'Global recession fears grow in Berlin'
  WHEN 1 THEN 'Election result sparks protest' WHEN 2 THEN 'Major earthquake hits the coast'
  WHEN 3 THEN 'Scientists announce a breakthrough' WHEN 4 THEN 'Angela Merkel meets Emmanuel Macron'
  ELSE '' END AS title,
 CASE o_orderkey % 5 WHEN 0 THEN 'The market crash deepened as unemployment rose.' WHEN 1 THEN NULL
  WHEN 2 THEN 'A historic treaty ended the long conflict.' WHEN 3 THEN 'Officials in Madrid said the pandemic is over.'
  ELSE 'Climate change protest drew a massive crowd at City Hall.' END AS description,
 CASE o_orderkey % 3 WHEN 0 THEN 'Reporters from White House and World Bank attended, said New York Times.'
  WHEN 1 THEN NULL ELSE 'The Spain government announced new sanctions on Tuesday.' END AS content,
 'https://news.example.com/a/' || CAST(o_orderkey AS VARCHAR(20)) AS url,
 CASE WHEN o_orderkey % 19 = 0 THEN 'not a date'
  WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) || 'T10:30:00Z'
  ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) || 'T23:30:00-05:00' END AS published_at,
 CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'Wire ' || CAST(o_orderkey % 7 AS VARCHAR(2)) END AS source_name
FROM orders
"""

# Encyclopaedia page payloads: titles follow the year-page patterns
# ('AD_1871', '1871', '1871_AD', '1871_CE') or are plain page names.
FIXTURE_SQL["encyclopaedia_pages"] = """
SELECT c_custkey AS page_id,
 CASE c_custkey % 5 WHEN 0 THEN 'AD_' || CAST(1000 + c_custkey % 1100 AS VARCHAR(10))
  WHEN 1 THEN CAST(1000 + c_custkey % 1100 AS VARCHAR(10))
  WHEN 2 THEN CAST(1000 + c_custkey % 1100 AS VARCHAR(10)) || '_AD'
  WHEN 3 THEN CAST(1000 + c_custkey % 1100 AS VARCHAR(10)) || '_CE'
  ELSE 'Page ' || CAST(1000 + c_custkey % 1100 AS VARCHAR(10)) END AS title,
 CASE c_custkey % 4 WHEN 0 THEN 'Preamble text is dropped.' || chr(10) || '== Economy ==' || chr(10)
   || 'A deep recession began in Paris. Trade fell across the market! Then recovery came slowly.' || chr(10)
   || '== Empty ==' || chr(10) || '=== Conflicts ===' || chr(10)
   || '* Otto Bismarck led the German Empire in the war, after a coup in 1871'
  WHEN 1 THEN 'No headers at all here, only one sentence about 1950 and 1960.' WHEN 2 THEN 'short' ELSE '' END AS extract,
 'https://en.wikipedia.org/wiki/Page_' || CAST(c_custkey AS VARCHAR(20)) AS fullurl
FROM customer
"""

# Search index: which page titles a category search returns, in rank order.
FIXTURE_SQL["category_hits"] = """
SELECT c_custkey % 32 AS subcategory_idx,
 'Page ' || CAST(1000 + c_custkey % 1100 AS VARCHAR(10)) AS title,
 c_custkey AS search_rank
FROM customer
"""

# Three indicator series per country (stands for GDP, inflation, unemployment).
FIXTURE_SQL["indicator_series"] = """
WITH g AS (
 SELECT n_name AS country, year(o_orderdate) AS year,
  SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents, COUNT(*) AS n,
  SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_f
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 GROUP BY n_name, year(o_orderdate))
SELECT country, 'NY.GDP.MKTP.CD' AS indicator, year, CAST(cents AS DOUBLE) / CAST(100 AS DOUBLE) AS value FROM g
UNION ALL
SELECT country, 'FP.CPI.TOTL.ZG', year, CAST(cents AS DOUBLE) / n / CAST(1000000 AS DOUBLE) FROM g
UNION ALL
SELECT country, 'SL.UEM.TOTL.ZS', year, CAST(100 AS DOUBLE) * n_f / n - CAST(40 AS DOUBLE) FROM g
"""

# The same rows in Spark SQL where the portable text would read a table several
# times: one aggregate, its three indicators as rows of an inline table function.
SPARK_SQL = {"indicator_series": """
SELECT country, x.indicator, year, x.value FROM (
 SELECT n_name AS country, year(o_orderdate) AS year,
  SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents, COUNT(*) AS n,
  SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_f
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 GROUP BY n_name, year(o_orderdate))
LATERAL VIEW stack(3,
 'NY.GDP.MKTP.CD', CAST(cents AS DOUBLE) / CAST(100 AS DOUBLE),
 'FP.CPI.TOTL.ZG', CAST(cents AS DOUBLE) / n / CAST(1000000 AS DOUBLE),
 'SL.UEM.TOTL.ZS', CAST(100 AS DOUBLE) * n_f / n - CAST(40 AS DOUBLE)) x AS indicator, value
"""}

_TABLE_REF = re.compile(r"\b(?:FROM|JOIN)\s+([a-z_]+)", re.IGNORECASE)


def base_tables_of(sql: str) -> list[str]:
    return [t for t in dict.fromkeys(_TABLE_REF.findall(sql)) if t in BASE_TABLES]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a DataFrame (parquet scan; pushdown and pruning apply)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Run a fixture view's SQL over the tables of ``sf_dir``."""
    sql = SPARK_SQL.get(name, FIXTURE_SQL[name])
    register_tables(spark, sf_dir, base_tables_of(sql))
    return spark.sql(sql)


def fixture_cte(*names: str) -> str:
    """``WITH`` clause that defines fixture views for the DuckDB oracle
    (a fixture with its own ``WITH`` becomes a parenthesised subquery)."""
    return "WITH " + ",\n".join(f"{n} AS (SELECT * FROM ({FIXTURE_SQL[n].strip()}))" for n in names) + "\n"
