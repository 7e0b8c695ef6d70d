"""Sources and sinks: staging, text and JSON files, cards, publishing, samples."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.registry import query
from catalogue.roles import RUN_TS, role, table
from starloom import schemas as S
from starloom.operators import require_unique, row_count_sheet
from starloom.plans import dims
from starloom.plans.rebuild import rebuild
from starloom.session import new_path, stage_table
from starloom.sources import (
    SnapshotTable,
    convert,
    extract,
    read_delimited,
    read_district_file,
    read_json,
    sample_rows,
)

_CSV = {
    "sep": ";", "header": True, "nullValue": "?", "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


@query("SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS ETL_LoadDateTime FROM orders")
def staged_copy(spark, sf_dir):
    return extract(table(spark, sf_dir, "orders"), new_path(spark, "orders"), RUN_TS)


_STAGED = ["account", "client", "disp", "district", "loan", "trans", "card"]


@query(" UNION ALL ".join(
    f"SELECT '{n}' AS TableName, count(*) AS NumberOfRows FROM {n}" for n in _STAGED)
    + " UNION ALL SELECT 'order', count(*) FROM orders")
def staged_tables(spark, sf_dir):
    """Every source extracted in full; the sheet counts the staged copies."""
    sources = {n: role(spark, sf_dir, n) for n in _STAGED}
    sources["order"] = table(spark, sf_dir, "orders")
    return row_count_sheet(
        {n: extract(df, new_path(spark, n), RUN_TS) for n, df in sources.items()}
    )


@query("SELECT * FROM account")
def csv_round_trip(spark, sf_dir):
    """Accounts written as delimited text and read with a declared schema."""
    account = role(spark, sf_dir, "account")
    path = convert(account, new_path(spark, "account_csv"), "csv", **_CSV)
    schema = T.StructType(
        [T.StructField("account_id", T.LongType()), *S.ACCOUNT.fields[1:]]
    )
    return read_delimited(spark, path, schema)


@query("SELECT * REPLACE (CAST(trunc(average_salary) AS INTEGER) AS average_salary) FROM district")
def district_file(spark, sf_dir):
    """Districts in the layout of the raw file, '?' for missing figures."""
    named = S.DISTRICT_NAMES
    raw = role(spark, sf_dir, "district").select(
        *[
            (F.col(named[f.name]) if f.name in named else F.lit(0)).cast(f.dataType).alias(f.name)
            for f in S.DISTRICT_FILE.fields
        ]
    )
    path = convert(raw, new_path(spark, "district"), "csv", **_CSV)
    return read_district_file(spark, path)


@query("SELECT card_id, disp_id, type, issued FROM card")
def json_round_trip(spark, sf_dir):
    """Cards written as JSON records and read with declared columns."""
    path = convert(role(spark, sf_dir, "card"), new_path(spark, "card_json"))
    return read_json(spark, path, _card_schema())


def _card_schema() -> T.StructType:
    return T.StructType(
        [T.StructField(n, T.LongType()) for n in ("card_id", "disp_id")]
        + [T.StructField(n, T.StringType()) for n in ("type", "issued")]
    )


@query("""SELECT card_id, disp_id, type AS card_type,
                 TRY_CAST('19' || substr(issued, 1, 2) || '-' || substr(issued, 3, 2) || '-' ||
                          substr(issued, 5, 2) || substr(issued, 7, 9) AS TIMESTAMP) AS issued
          FROM card""")
def card_load(spark, sf_dir):
    """Cards loaded twice: first the building trade's, then all of them doubled; none doubles."""
    path = convert(role(spark, sf_dir, "card"), new_path(spark, "card_json"))
    cards = read_json(spark, path, _card_schema())
    loaded = SnapshotTable(spark, new_path(spark, "card"))
    loaded.publish(dims.card_rows(cards.filter(F.col("type") == "building")))
    loaded.append(dims.load_cards(loaded.read(), cards.unionByName(cards)))
    result = loaded.read()
    require_unique(result, "card_id")
    return result


@query("SELECT * FROM part")
def publish_snapshot(spark, sf_dir):
    """A rebuilt table replaces the old one once its rows are counted."""
    parts = table(spark, sf_dir, "part")
    published = SnapshotTable(spark, new_path(spark, "part"))
    published.publish(parts.filter("p_size < 10"))
    return published.publish(parts, expected_rows=parts.count())


@query("SELECT * FROM disp")
def gated_rebuild(spark, sf_dir):
    """Dispositions rebuilt under a unique key: gate, copy, count, switch."""
    return rebuild(
        SnapshotTable(spark, new_path(spark, "disp")), role(spark, sf_dir, "disp"), "disp_id"
    )


@query("""SELECT card_id, disp_id, type, issued FROM card
          UNION ALL SELECT card_id, disp_id, type, issued FROM card WHERE card_id = (SELECT min(card_id) FROM card)""")
def json_documents(spark, sf_dir):
    """Cards as documents that each hold an array of a bounded range of ids, and one that holds a single object."""
    cards = role(spark, sf_dir, "card").select("card_id", "disp_id", "type", "issued")
    record = F.struct(*cards.columns)
    arrays = cards.groupBy(F.floor(F.col("card_id") / 10_000)).agg(F.to_json(F.collect_list(record)).alias("value")).select("value")
    single = cards.orderBy("card_id").limit(1).select(F.to_json(record).alias("value"))
    path = new_path(spark, "card_documents")
    # each document in a file of its own
    arrays.repartition(F.xxhash64("value")).write.option("maxRecordsPerFile", 1).text(path)
    single.write.mode("append").text(path)
    return read_json(spark, path, _card_schema(), document=True)


@query("""SELECT o_orderkey, o_orderstatus, o_orderpriority, o_custkey AS c_custkey, c_name, c_mktsegment
          FROM orders JOIN customer ON c_custkey = o_custkey
          UNION ALL SELECT NULL, 'a "}{" b', '[{', c_custkey, c_name, c_mktsegment FROM customer
          WHERE c_custkey = (SELECT min(c_custkey) FROM customer)""")
def json_array(spark, sf_dir):
    """Orders with their customer nested, as arrays of a bounded range of ids, each a file that several tasks read."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    customer = F.struct("c_custkey", "c_name", "c_mktsegment").alias("customer")
    order = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    nested = orders.join(customers, F.col("c_custkey") == F.col("o_custkey")).select(*order, customer)
    odd = customers.orderBy("c_custkey").limit(1).select(
        F.lit(None).cast("long").alias(order[0]), F.lit('a "}{" b').alias(order[1]), F.lit("[{").alias(order[2]), customer)
    arrays = nested.unionByName(odd).groupBy(F.floor(F.coalesce("o_orderkey", F.lit(0)) / 100_000)).agg(
        F.to_json(F.collect_list(F.struct("*"))).alias("value")).select("value")
    path = new_path(spark, "order_arrays")
    arrays.write.option("maxRecordsPerFile", 1).text(path)
    schema = T.StructType.fromDDL(
        "o_orderkey long, o_orderstatus string, o_orderpriority string, "
        "customer struct<c_custkey:long,c_name:string,c_mktsegment:string>")
    return read_json(spark, path, schema, document=True, split_bytes=100_000).select(*order, "customer.*")


@query("""SELECT least(5, count(*)) AS DrawnRows, least(5, count(*)) AS FoundRows FROM lineitem""", name="sample_rows")
def sample_of_lines(spark, sf_dir):
    """Any five lines; which ones is not defined, but they are rows of the table."""
    lines = table(spark, sf_dir, "lineitem")
    drawn = stage_table(sample_rows(lines), "sample").distinct()
    rows = drawn.agg(F.count("*")).first()[0]
    found = lines.join(F.broadcast(drawn), lines.columns, "left_semi").distinct()
    return found.agg(
        F.least(F.lit(5), F.lit(rows)).cast("bigint").alias("DrawnRows"), F.count("*").alias("FoundRows"))
