"""The given tables in the roles of the banking sources.

A role is one SELECT that both engines run unchanged.  The tables are clean, so
the roles add what a load must cope with: padded and lower-case codes, blanks,
NULLs, unlisted codes, references to nothing.  All rows take part.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from starloom.sources import with_audit

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

RUN_TS = dt.datetime(2024, 1, 1)
SOURCE_SYSTEM = "Core Ledger"
#: with this end both age bands occur
OBSERVED_TO = dt.date(2004, 12, 31)

ROLES = {
    # nation in region, with figures summed from its suppliers and customers
    "district": """
        SELECT n.n_nationkey AS district_id,
               CASE WHEN s.low < -500 THEN '   ' WHEN s.low < 0 THEN NULL
                    WHEN s.top > 9500 THEN concat('  ', n.n_name, ' ') ELSE n.n_name END AS district_name,
               CASE WHEN r.r_name = 'ASIA' THEN '  ' ELSE concat(' ', r.r_name, '  ') END AS region_name,
               CAST(c.customers AS INT) AS population,
               CAST(s.top + 0.50 AS DECIMAL(10,2)) AS average_salary,
               CAST(s.top * 0.01 AS DECIMAL(5,2)) AS unemployment_rate_1995,
               CASE WHEN s.low < 0 THEN NULL ELSE CAST(s.low * 0.01 AS DECIMAL(5,2)) END
                   AS unemployment_rate_1996,
               CAST(floor(s.top * 0.01) AS INT) AS entrepreneurs_per_1000_residents,
               CASE WHEN r.r_name = 'AMERICA' THEN NULL ELSE CAST(c.overdrawn AS INT) END
                   AS crimes_committed_1995,
               CASE WHEN r.r_name IN ('EUROPE', 'AMERICA') THEN NULL
                    ELSE CAST(c.customers - c.overdrawn AS INT) END AS crimes_committed_1996
        FROM {nation} n
        JOIN {region} r ON r.r_regionkey = n.n_regionkey
        LEFT JOIN (SELECT s_nationkey, CAST(max(s_acctbal) AS DECIMAL(18,2)) AS top,
                          CAST(min(s_acctbal) AS DECIMAL(18,2)) AS low
                   FROM {supplier} GROUP BY s_nationkey) s ON s.s_nationkey = n.n_nationkey
        LEFT JOIN (SELECT c_nationkey, count(*) AS customers,
                          sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS overdrawn
                   FROM {customer} GROUP BY c_nationkey) c ON c.c_nationkey = n.n_nationkey""",
    # the same district as text columns with junk
    "district_text": """
        SELECT CASE WHEN trim(region_name) = 'EUROPE' THEN concat('E', CAST(district_id AS STRING))
                    ELSE concat(' ', CAST(district_id AS STRING), ' ') END AS district_id,
               district_name, region_name,
               CASE WHEN trim(region_name) = 'AFRICA' THEN 'n/a' ELSE CAST(population AS STRING) END
                   AS population,
               CAST(average_salary AS STRING) AS average_salary,
               coalesce(CAST(unemployment_rate_1995 AS STRING), '?') AS unemployment_rate_1995,
               coalesce(CAST(unemployment_rate_1996 AS STRING), '?') AS unemployment_rate_1996,
               CAST(entrepreneurs_per_1000_residents AS STRING) AS entrepreneurs_per_1000_residents,
               coalesce(CAST(crimes_committed_1995 AS STRING), '  ') AS crimes_committed_1995,
               coalesce(CAST(crimes_committed_1996 AS STRING), '?') AS crimes_committed_1996
        FROM {district}""",
    "account": """
        SELECT c.c_custkey AS account_id,
               CASE WHEN c.c_acctbal < -900 THEN NULL WHEN c.c_acctbal >= 9900 THEN 99
                    ELSE c.c_nationkey END AS district_id,
               CASE c.c_mktsegment WHEN 'BUILDING' THEN 'POPLATEK MESICNE'
                    WHEN 'AUTOMOBILE' THEN '  poplatek tydne ' WHEN 'MACHINERY' THEN 'Poplatek po obratu'
                    WHEN 'HOUSEHOLD' THEN '  '
                    ELSE CASE WHEN c.c_acctbal < 0 THEN NULL ELSE 'denne' END END AS frequency,
               o.opened AS date
        FROM {customer} c
        LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS opened
                   FROM {orders} GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey""",
    "client": """
        SELECT c_custkey AS client_id,
               CASE WHEN c_acctbal > 9950 THEN NULL
                    ELSE DATE '1930-01-01' + CAST(floor(c_acctbal + 1000) AS INT) END AS birth_number,
               CASE WHEN c_acctbal < -950 THEN NULL WHEN c_acctbal >= 9900 THEN 99
                    ELSE c_nationkey END AS district_id
        FROM {customer}""",
    "disp": """
        SELECT o_orderkey AS disp_id,
               CASE WHEN o_orderstatus = 'P' AND o_totalprice < 100000 THEN NULL ELSE o_custkey END
                   AS client_id,
               o_custkey AS account_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN ' owner ' WHEN '2-HIGH' THEN 'DISPONENT'
                    WHEN '3-MEDIUM' THEN 'Disponent ' WHEN '4-NOT SPECIFIED' THEN NULL
                    ELSE 'PROXY' END AS type
        FROM {orders}""",
    "loan": """
        SELECT o_orderkey AS loan_id,
               CASE WHEN o_totalprice > 490000 THEN -7 ELSE o_custkey END AS account_id,
               CASE WHEN o_totalprice BETWEEN 480000 AND 490000 THEN NULL
                    ELSE CAST(o_orderdate AS DATE) END AS date,
               CAST(o_totalprice - 5000 AS DECIMAL(18,2)) AS amount,
               CAST(substr(o_orderpriority, 1, 1) AS INT) * 12 AS duration,
               CAST(floor(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS payments,
               CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN ' b '
                    WHEN o_orderstatus = 'F' THEN 'A'
                    WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'd'
                    WHEN o_orderstatus = 'O' THEN ' C'
                    WHEN o_orderpriority = '1-URGENT' THEN '  '
                    WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'e' END AS status
        FROM {orders}""",
    # (l_orderkey, l_linenumber) repeats in the data; parts beyond the
    # customers are references to no account
    "trans": """
        SELECT l_orderkey * 10 + l_linenumber AS trans_id,
               l_partkey AS account_id,
               CASE WHEN l_tax = 0.08 AND l_discount = 0.1 THEN NULL ELSE CAST(l_shipdate AS DATE) END
                   AS date,
               CASE WHEN l_returnflag = 'N' THEN ' prijem' WHEN l_returnflag = 'A' THEN 'VYDAJ'
                    WHEN l_quantity > 45 THEN 'storno' WHEN l_quantity = 45 THEN NULL
                    ELSE 'vyber ' END AS type,
               CASE WHEN l_discount = 0 THEN NULL WHEN l_discount = 0.01 THEN '  '
                    WHEN l_discount = 0.02 THEN 'akreditiv' WHEN l_discount = 0.03 THEN 'vyber'
                    WHEN l_discount = 0.04 THEN ' VYBER KARTOU' WHEN l_discount = 0.05 THEN 'Cash Deposit'
                    WHEN l_linestatus = 'F' THEN 'vklad ' WHEN l_discount = 0.1 THEN 'PREVOD NA UCET'
                    ELSE 'Prevod z uctu' END AS operation,
               CASE WHEN l_quantity = 50 AND l_tax = 0 THEN NULL
                    ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount,
               CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_quantity * 100 AS DECIMAL(18,2)) END AS balance,
               CASE WHEN l_linestatus = 'O' AND l_tax = 0 THEN ' ' WHEN l_linestatus = 'O' THEN 'sipo'
                    ELSE NULL END AS k_symbol
        FROM {lineitem}""",
    "card": """
        SELECT c_custkey AS card_id, c_custkey AS disp_id, lower(c_mktsegment) AS type,
               CASE WHEN c_acctbal < 0 THEN 'unknown'
                    ELSE concat(substr(CAST(o.opened AS STRING), 3, 2), substr(CAST(o.opened AS STRING), 6, 2),
                                substr(CAST(o.opened AS STRING), 9, 2), ' 08:30:00') END AS issued
        FROM {customer}
        LEFT JOIN (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS opened
                   FROM {orders} GROUP BY o_custkey) o ON o.o_custkey = c_custkey""",
}


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its columns are looked up once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A role as a frame."""
    text = ROLES[name]
    frames = {
        t: (role if t in ROLES else table)(spark, sf_dir, t)
        for t in [*TABLES, *ROLES]
        if "{" + t + "}" in text
    }
    return spark.sql(text, **frames)


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A role as it lies in staging, stamped with the run's time."""
    return with_audit(role(spark, sf_dir, name), RUN_TS)
