"""Every stage of the pipeline against a plain version, each on its own input; accuracy of what is learned."""

import hashlib

import numpy as np
import pytest

pytest.importorskip("starloom.llm")

from test_small import (  # noqa: E402
    components_by_force,
    contamination_by_force,
    fingerprint_by_force,
    library,
    word_library,
)

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from starloom.llm import language, toxicity  # noqa: E402
from starloom.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and gave, as (rows in, rows out); rows by doc_id."""
    from starloom.session import stage_table

    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, columns = {r["doc_id"]: r for r in docs.collect()}, docs.columns
        docs = stage_table(stage(spark, docs, SF), name)
        found[name] = before, {r["doc_id"]: r for r in docs.collect()}
        assert docs.count() == len(found[name][1])
        if name != "byte_bpe":
            assert docs.columns == columns
            assert all(r == before[i] for i, r in found[name][1].items())
    return found


def test_language_stage(spark, stages):
    before, after = stages["language_id"]
    assert set(after) == {i for i, r in before.items() if any(c.isalpha() for c in r["text"] or "")}


def test_toxicity_stage(spark, stages):
    before, after = stages["toxicity"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(f"doc_id IN ({', '.join(map(str, before))})")
    model = toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    toxic = {r["doc_id"] for r in toxicity.severity(docs, model).where("toxic").collect()}
    assert set(after) == set(before) - toxic


def test_dedup_stage(stages):
    before, after = stages["simhash_near_dedup"]
    prints = {i: fingerprint_by_force(r["text"]) for i, r in before.items()}
    root, least = components_by_force(prints.values()), {}
    for i, x in prints.items():
        least[root[x]] = min(least.get(root[x], i), i)
    assert set(after) == set(least.values()) and len(after) < len(before)


def test_decontamination_stage(spark, stages):
    before, after = stages["benchmark_decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {x[0] for x in contamination_by_force([(i, r["text"]) for i, r in before.items()], items) if x[5]}
    assert set(after) == set(before) - hit


def test_encoding_stage(stages):
    before, after = stages["byte_bpe"]
    assert set(after) == set(before)
    for i, r in after.items():
        ids = library().encode_ordinary(before[i]["text"])
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(before[i]["text"].encode()).hexdigest()


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_whole_tables(spark):
    """Every query has a row for each row of its table."""
    for name, table in (("op2_warc", "pages"), ("op3_decontamination", "documents"), ("op4_main_text", "pages"),
                        ("op5_byte_bpe", "documents"), ("op6_token_files", "documents"), ("op7_toxicity", "documents"),
                        ("op8_token_counts", "documents"), ("op9_simhash", "documents"), ("op10_language", "documents")):
        assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count(), name


def test_held_out_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs, language.learn(language.labelled_part(docs))).join(docs, "doc_id")
    right = [r["lang"] == r["lang_pred"] for r in got.where(language.held_out()).collect()]
    assert len(right) > 200 and np.mean(right) > 0.97


def test_token_files_hold_the_library_ids(spark):
    import zlib

    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in QUERIES["op6_token_files"](spark, SF).collect()}
    start, library_ = 0, word_library()
    for r in rows:
        ids = [*library_.encode(r["text"], add_special_tokens=False).ids, 1]
        assert (got[r["doc_id"]]["start"], got[r["doc_id"]]["n_tokens"]) == (start, len(ids))
        assert got[r["doc_id"]]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
