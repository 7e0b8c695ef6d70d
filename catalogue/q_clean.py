"""Deduplication and the clean tables."""

from __future__ import annotations


from pyspark.sql import functions as F

from catalogue.bank import Bank
from catalogue.checks import key, latest
from catalogue.registry import query
from catalogue.roles import OBSERVED_TO, SOURCE_SYSTEM, role, table
from starloom import constants as K
from starloom.functions import (
    age_band,
    century_timestamp,
    clean_text,
    date_key,
    first_number,
    try_int,
    try_money,
    try_rate,
    whole,
    year_diff,
    year_month_label,
)
from starloom.operators import latest_per_key, lookup_join
from starloom.plans import clean, dims


@query("""SELECT * FROM lineitem
          QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) = 1""", name="latest_per_key")
def latest_line(spark, sf_dir):
    return latest_per_key(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate",
        ties=["l_partkey", "l_suppkey", "l_extendedprice"],
    )


@query("""SELECT * FROM disp WHERE client_id IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY client_id
              ORDER BY CASE WHEN upper(trim(type)) = 'OWNER' THEN 1 ELSE 2 END, disp_id) = 1""", name="preferred_per_key")
def preferred_disposition(spark, sf_dir):
    return clean.preferred_disposition(role(spark, sf_dir, "disp"))


@query(latest("trans", "trans_id",
              ["account_id", "date", "type", "operation", "amount", "balance", "k_symbol"]))
def latest_transaction(spark, sf_dir):
    return latest_per_key(role(spark, sf_dir, "trans"), "trans_id", [])


@query("""SELECT district_id, coalesce(nullif(trim(district_name), ''), 'Unknown') AS DistrictName,
                 coalesce(nullif(trim(region_name), ''), 'Unknown') AS RegionName FROM district""", name="clean_text")
def clean_district_names(spark, sf_dir):
    return role(spark, sf_dir, "district").select(
        "district_id",
        clean_text("district_name").alias("DistrictName"),
        clean_text("region_name").alias("RegionName"),
    )


@query(f"""SELECT CASE WHEN date IS NULL THEN 'Unknown' WHEN 2004 - year(date) BETWEEN 1 AND 4 THEN '1-4 Years'
                      WHEN 2004 - year(date) BETWEEN 5 AND 9 THEN '5-9 Years' ELSE 'Other' END AS LoanAgeGroup,
                  CAST(2004 - year(date) AS INTEGER) AS LoanAgeYears, count(*) AS NumberOfLoans
           FROM loan GROUP BY ALL""", name="band_groups")
def age_bands(spark, sf_dir):
    return (
        role(spark, sf_dir, "loan")
        .groupBy(
            age_band("date", OBSERVED_TO).alias("LoanAgeGroup"),
            year_diff("date", OBSERVED_TO).alias("LoanAgeYears"),
        )
        .agg(F.count("*").alias("NumberOfLoans"))
    )


@query("""SELECT trim(district_id) AS DistrictID, TRY_CAST(trim(population) AS INTEGER) AS Population,
                 coalesce(TRY_CAST(unemployment_rate_1996 AS DECIMAL(5,2)),
                          TRY_CAST(unemployment_rate_1995 AS DECIMAL(5,2))) AS UnemploymentMeasure,
                 coalesce(TRY_CAST(crimes_committed_1996 AS INTEGER),
                          TRY_CAST(nullif(trim(crimes_committed_1995), '') AS INTEGER)) AS CrimeMeasure,
                 CAST(round(TRY_CAST(average_salary AS DECIMAL(18,2)), 0) AS INTEGER) AS AverageSalary
          FROM district_text""")
def year_fallback(spark, sf_dir):
    return role(spark, sf_dir, "district_text").select(
        F.trim("district_id").alias("DistrictID"),
        try_int("population").alias("Population"),
        first_number(try_rate, "unemployment_rate_1996", "unemployment_rate_1995").alias(
            "UnemploymentMeasure"
        ),
        first_number(try_int, "crimes_committed_1996", "crimes_committed_1995").alias("CrimeMeasure"),
        whole(try_money("average_salary")).alias("AverageSalary"),
    )


@query(f"""SELECT loan_id, coalesce({key('date')}, 19000101) AS LoanDateKey,
                  coalesce(strftime(date, '%Y-%m'), 'none') AS LoanMonth FROM loan""", name="date_key")
def date_keys(spark, sf_dir):
    return role(spark, sf_dir, "loan").select(
        "loan_id",
        date_key("date").alias("LoanDateKey"),
        F.when(F.col("date").isNull(), "none")
        .otherwise(year_month_label(F.year("date"), F.month("date")))
        .alias("LoanMonth"),
    )


@query("""SELECT event_id, CASE WHEN event_type <> 'error'
                               THEN CAST(date_trunc('second', ts) AS TIMESTAMP) END AS issued FROM events""", name="parse_century_timestamp")
def century_timestamps(spark, sf_dir):
    text = F.col("ts").cast("string")
    part = [F.substring(text, a, 2) for a in (3, 6, 9)]
    short = F.concat(*part, F.lit(" "), F.substring(text, 12, 8))
    return (
        table(spark, sf_dir, "events")
        .withColumn("t", F.when(F.col("event_type") == "error", "n/a").otherwise(short))
        .select("event_id", century_timestamp("t", "20").alias("issued"))
    )


@query(f"""WITH s AS (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders),
               d AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS day FROM s),
               n AS (SELECT o_orderdate, count(*) AS n FROM orders GROUP BY 1)
          SELECT {key('day')} AS DateKey, CAST(day AS DATE) AS FullDate, CAST(day(day) AS INTEGER) AS DayNumber,
                 dayname(day) AS DayName, CAST(weekofyear(day) AS INTEGER) AS WeekNumber,
                 CAST(month(day) AS INTEGER) AS MonthNumber, monthname(day) AS MonthName,
                 CAST(quarter(day) AS INTEGER) AS Quarter, CAST(year(day) AS INTEGER) AS Year,
                 strftime(day, '%m') AS YearMonth, coalesce(n, 0) AS Orders
          FROM d LEFT JOIN n ON n.o_orderdate = d.day""", name="calendar")
def calendar_of_orders(spark, sf_dir):
    """The calendar from the first to the last order, with the orders of each day."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    first, last = orders.agg(F.min("day"), F.max("day")).first()
    per_day = orders.groupBy("day").agg(F.count("*").alias("Orders"))
    days = dims.dim_date(spark, first, last)
    return (
        days.join(per_day, days.FullDate == per_day.day, "left")
        .drop("day")
        .fillna(0, ["Orders"])
    )


@query("SELECT * FROM account_clean")
def account_clean(spark, sf_dir):
    return clean.account_clean(Bank(spark, sf_dir).stg("account"), SOURCE_SYSTEM, OBSERVED_TO)


@query("SELECT * FROM district_clean")
def district_clean(spark, sf_dir):
    return clean.district_clean(Bank(spark, sf_dir).stg("district"))


@query("SELECT * FROM client_clean")
def client_clean(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return clean.client_clean(bank.stg("client"), bank.stg("disp"), bank.district_clean, OBSERVED_TO)


@query("""SELECT client_id, CASE WHEN district_id IN (SELECT district_id FROM district) THEN district_id ELSE -1 END
                     AS DistrictID FROM client""")
def invalid_reference_default(spark, sf_dir):
    """A reference to a district that does not exist becomes the unknown id."""
    client = role(spark, sf_dir, "client").select("client_id", "district_id")
    known = role(spark, sf_dir, "district").select("district_id", F.lit(True).alias("known"))
    joined = lookup_join(client, known, "district_id", "left", row_id="client_id")
    return joined.select(
        "client_id",
        F.when(F.col("known"), F.col("district_id")).otherwise(F.lit(K.UNKNOWN_ID)).alias("DistrictID"),
    )


@query("SELECT * FROM loan_clean")
def loan_clean(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return clean.loan_clean(bank.stg("loan"), bank.account_clean)


@query("SELECT * FROM transaction_clean")
def transaction_clean(spark, sf_dir):
    bank = Bank(spark, sf_dir)
    return clean.transaction_clean(bank.stg("trans"), bank.account_clean)


@query("""SELECT StatementFrequency, AccountAgeGroup, count(*) AS NumberOfAccounts
          FROM account_clean GROUP BY ALL""")
def account_groups(spark, sf_dir):
    return (
        account_clean(spark, sf_dir)
        .groupBy("StatementFrequency", "AccountAgeGroup")
        .agg(F.count("*").alias("NumberOfAccounts"))
        .orderBy("StatementFrequency", "AccountAgeGroup")
    )


