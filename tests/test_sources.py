import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom import session
from starloom.plans import dims
from starloom.session import new_path, work_dir
from starloom.sources import (
    PublishError,
    SnapshotTable,
    convert,
    extract,
    read_delimited,
    read_district_file,
    read_json,
)
from starloom.streaming import deliver, landing_stream

HEADER = ";".join(f"A{i}" for i in range(1, 17))


def test_district_file(spark, tmp_path, rows):
    file = tmp_path / "district.csv"
    file.write_text(
        HEADER + '\n1;"Hl. mesto";"Capital";1000;0;0;0;1;1;100.0;12541;0.29;0.43;167;85;99\n'
        '2;"Hory; sever";"north";500;4;13;5;1;3;48.4;8173;?;7.01;124;?;13\n')
    assert rows(read_district_file(spark, str(file))) == [
        (1, "Hl. mesto", "Capital", 1000, 12541, D("0.29"), D("0.43"), 167, 85, 99),
        (2, "Hory; sever", "north", 500, 8173, None, D("7.01"), 124, None, 13)]


def test_delimited_text_with_a_wrong_type_stops(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text("account_id;district_id;frequency;date\nabc;1;x;1995-01-01\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_delimited(spark, str(file), S.ACCOUNT).collect()


CARD = '{"card_id": 1, "disp_id": 9, "type": "gold", "issued": "931107 00:00:00"}'


@pytest.mark.parametrize("text", [f"[{CARD}]", CARD, f"[\n  {CARD}\n]\n"])
def test_json_document_may_be_one_record_or_an_array(spark, tmp_path, rows, text):
    file = tmp_path / "card.json"
    file.write_text(text)
    cards = read_json(spark, str(file), S.CARD_JSON, document=True)
    assert rows(dims.card_rows(cards)) == [(1, 9, "gold", dt.datetime(1993, 11, 7))]


def test_cards_already_loaded_are_left_out(spark, rows):
    cards = spark.createDataFrame([(1, 9, "gold", "931107 00:00:00"), (2, 9, "x", "bad")], S.CARD_JSON)
    loaded = spark.createDataFrame([(1, 9, "gold", None)], S.CARD)
    assert rows(dims.load_cards(loaded, cards)) == [(2, 9, "x", None)]


def test_conversion_keeps_every_row(spark, tmp_path, rows):
    cards = spark.createDataFrame([(1, 9, None, " a"), (2, None, "é", "")], S.CARD_JSON)
    path = convert(cards, str(tmp_path / "json"))
    assert rows(read_json(spark, path, S.CARD_JSON)) == rows(cards)


def test_extract_replaces_and_stamps(spark, tmp_path, rows):
    path, day = str(tmp_path / "stg"), dt.datetime(2024, 5, 6, 7, 8, 9)
    extract(spark.range(5), path, day)
    staged = extract(spark.range(2), path, day)
    assert rows(staged) == [(0, day), (1, day)]


def test_publish_keeps_the_old_table_when_counts_differ(spark, rows):
    table = SnapshotTable(spark, new_path(spark, "t"))
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.publish(spark.range(3), 3)
    with pytest.raises(PublishError, match="expected 5"):
        table.publish(spark.range(4), 5)
    assert rows(table.read()) == [(0,), (1,), (2,)]
    table.publish(spark.range(1), 1)
    assert rows(table.read()) == [(0,)] and table.versions().count() == 2


def test_rebuild_is_gated(spark, rows):
    from starloom.operators import LoadGateError
    from starloom.plans.rebuild import rebuild

    table = SnapshotTable(spark, new_path(spark, "disp"))
    rebuild(table, spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), "id")
    with pytest.raises(LoadGateError, match="NULL"):
        rebuild(table, spark.createDataFrame([(None, "x")], "id int, v string"), "id")
    with pytest.raises(LoadGateError, match="duplicate"):
        rebuild(table, spark.createDataFrame([(1, "x"), (1, "y")], "id int, v string"), "id")
    assert rows(table.read()) == [(1, "a"), (2, "b")]


def test_partitioned_append(spark):
    table = SnapshotTable(spark, new_path(spark, "t"), ["y"])
    rows = spark.range(100).withColumn("y", (F.col("id") % 2).cast("int"))
    table.append(rows)
    table.append(rows)
    assert table.read().filter("y = 1").count() == 100


def test_work_dir_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert work_dir(spark) == named.rstrip("/")
    assert new_path(spark, "a") != new_path(spark, "a")


def test_stage_table_cuts_lineage(spark):
    staged = session.stage_table(spark.range(10).withColumn("x", F.rand()))
    assert staged.collect() == staged.collect()
    assert "rand" not in staged._jdf.queryExecution().optimizedPlan().toString()


def test_stream_replay_adds_nothing(spark, tmp_path, rows):
    from starloom.operators import new_rows

    landing = str(tmp_path / "landing")
    spark.range(0, 6).coalesce(2).write.parquet(landing)
    table = SnapshotTable(spark, new_path(spark, "stream"))
    schema = spark.range(1).schema

    def run(checkpoint):
        deliver(
            landing_stream(spark, landing, schema, files_per_trigger=1), table,
            lambda known, batch: new_rows(batch, known, "id", increment=True),
            str(tmp_path / checkpoint), spark.range(0),
        ).awaitTermination()

    run("a")
    assert rows(table.read()) == [(i,) for i in range(6)]
    spark.range(4, 9).write.mode("append").parquet(landing)
    run("a")
    assert rows(table.read()) == [(i,) for i in range(9)]
    run("b")
    assert rows(table.read()) == [(i,) for i in range(9)]


def test_partition_settings_follow_the_input():
    small, large = session.sized_for(10**9), session.sized_for(10**14)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert large["spark.sql.shuffle.partitions"] == "200000"
    assert large["spark.sql.files.maxPartitionBytes"] == "512m"


# --- large arrays ---

NESTED = "id long, t string, o struct<a:int,b:struct<c:string>>, l array<struct<x:string>>"


def documents(n):
    text = ["}{", 'a "quoted" }', "back\\slash\\", "{[", "é}漢", "", None, "\n},{\n", '\\"}']
    return [
        {"id": i, "t": text[i % len(text)], "o": {"a": i, "b": {"c": text[(i + 1) % 9]}} if i % 3 else None,
         "l": [{"x": text[(i + k) % 9]} for k in range(i % 4)]}
        for i in range(n)
    ]


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_gives_several_tasks(spark, tmp_path, rows, monkeypatch, indent):
    import json

    from starloom.sources import json_array

    file = tmp_path / "large.json"
    file.write_text(json.dumps(documents(600), indent=indent, ensure_ascii=indent is None))
    (tmp_path / "single.json").write_text(json.dumps(documents(5)[4]))
    (tmp_path / "none.json").write_text(" [ ] ")
    seen = []
    pieces = json_array._pieces
    monkeypatch.setattr(json_array, "_pieces", lambda *a: seen.append(pieces(*a)) or seen[-1])
    expected = rows(spark.read.schema(NESTED).json(str(tmp_path), multiLine=True))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert rows(read_json(spark, str(tmp_path), S.T.StructType.fromDDL(NESTED), document=True, split_bytes=10)) == expected
        assert seen[0].rdd.getNumPartitions() >= 8 and len(expected) == 601
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("text", ['[{"id": 1}, {"id": 2]', '[{"id": 1}}, {"id": 2}]', '[{"id": 1, "t": "x}]'])
def test_braces_that_do_not_add_up_are_left_to_the_whole_document(spark, tmp_path, rows, text):
    from starloom.sources.json_array import read_json_array

    file = tmp_path / "broken.json"
    file.write_text(text)
    schema = S.T.StructType.fromDDL(NESTED)
    assert read_json_array(spark, str(file), schema) is None
    whole = spark.read.schema(schema).json(str(file), multiLine=True)
    assert rows(read_json(spark, str(file), schema, document=True, split_bytes=0)) == rows(whole)
