"""The operators applied to the given tables, and comparison SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    bpe,
    decontaminate,
    html,
    language,
    linededup,
    runs,
    simhash,
    spelling,
    tokenbin,
    tokencount,
    topk,
    toxicity,
    warc,
)
from starloom.session import stage_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score
  FROM v AS q JOIN v AS d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


@query(OP1_SQL)
def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors for every vector whose id is divisible by 100."""
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


OP2_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (
  SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)
"""


@query(OP2_SQL)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    return warc.archive_round_trip(_table(spark, sf_dir, "pages")).drop("archive", "offset")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3_SQL = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), size AS (
  SELECT DISTINCT least(len(w), 10) AS n FROM item WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), spot AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size WHERE len(w) >= n)
), hit AS (
  SELECT doc_id, i, n, t FROM spot WHERE t IN (SELECT t FROM win)
), word AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hit JOIN win USING (t)) GROUP BY doc_id
)
SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query(OP3_SQL)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that lie in benchmark windows."""
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query()
def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(_table(spark, sf_dir, "pages"))


@query()
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query()
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written to token files and read back."""
    return tokenbin.token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


@query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return tokencount.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components of every document."""
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


@query()
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = language.learn(language.labelled_part(docs))
    # a held-out document is told by its id alone
    return language.identify(docs, model).withColumn("held_out", language.held_out()).select(
        "doc_id", "held_out", "lang_pred", "score")


OP11_SQL = """
WITH line AS (
  SELECT doc_id, i, list_extract(l, i) AS line, len(l) AS n_lines
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
), shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
)
SELECT doc_id, CAST(any_value(n_lines) AS BIGINT) AS n_lines, count(*) FILTER (WHERE first <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE first IS NULL OR first = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id
"""


@query(OP11_SQL)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier one has."""
    return linededup.dedup_lines(_table(spark, sf_dir, "documents"), min_docs=2, min_chars=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the texts of about a tenth of the ids go round and round from some word on.

    With h the crc32 of the id and g = h div 10, texts of h % 10 = 0 are made of the
    words 0 to a - 1 and then of p words again and again up to their old number n;
    a = g % n, p = 1 + (n - a) div (3 + g % 8).
    """
    return (
        docs.selectExpr("doc_id", "text", "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) AS h")
        .selectExpr("*", "h div 10 AS g", r"""
            CASE WHEN h % 10 = 0 THEN filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '') END AS w""")
        .selectExpr("*", "size(w) AS n", "IF(size(w) > 0, g % size(w), 0) AS a")
        .selectExpr("*", "1 + (n - a) div (3 + g % 8) AS p")
        .selectExpr("doc_id", """
            CASE WHEN n > 0 THEN array_join(transform(sequence(0, n - 1),
              i -> element_at(w, CAST(1 + IF(i < a, i, a + (i - a) % p) AS INT))), ' ') ELSE text END AS text""")
    )


OP12_SQL = r"""
WITH step AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(b AS BIGINT))) AS t
), doc AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
           lambda c, b: xor(c >> 8, list_extract(t, (xor(c, b) & 255) + 1)), CAST(4294967295 AS BIGINT))) AS h
  FROM documents, step
), planned AS (
  SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS looped,
         CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM doc
), made AS (
  SELECT doc_id, n, CASE WHEN looped THEN list_transform(range(n), lambda i: list_extract(w,
           CAST(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END AS BIGINT) + 1)) ELSE w END AS w FROM planned
), gram AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i + 1, i + 16), ' ') AS t
  FROM (SELECT doc_id, n, w, unnest(range(0, n - 15)) AS i FROM made)
), again AS (
  SELECT doc_id, n, i, t FROM gram WHERE n >= 24 QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1
), pair AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM again x JOIN again y
  ON x.doc_id = y.doc_id AND x.t = y.t AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
), stretch AS (
  SELECT doc_id, q, min(i) AS s, max(i) - min(i) + 16 + q AS m
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pair)
  GROUP BY doc_id, q, island HAVING max(i) - min(i) + 16 + q >= greatest(24, 3 * q)
), run AS (
  SELECT * FROM stretch x WHERE NOT EXISTS (
    SELECT 1 FROM stretch y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.s <= x.s AND y.s + y.m >= x.s + x.m)
), lost AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + m)) AS i FROM run
), kept AS (
  SELECT doc_id, string_agg(list_extract(w, i + 1), ' ' ORDER BY i) AS text
  FROM (SELECT doc_id, w, unnest(range(0, n)) AS i FROM made) ANTI JOIN lost USING (doc_id, i) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat_ws(',', s, m, q) || chr(10), '' ORDER BY s, q) AS runs FROM run GROUP BY doc_id
), best AS (
  SELECT doc_id, s, m, q FROM run x WHERE NOT EXISTS (
    SELECT 1 FROM run y WHERE y.doc_id = x.doc_id AND (y.m * x.q > x.m * y.q OR (y.m * x.q = x.m * y.q AND (y.s, y.q) < (x.s, x.q))))
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, m AS length, q AS period, 1000 * m // q AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM made LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query(OP12_SQL)
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, looped ones among them."""
    found = runs.periodic_runs(looped(_table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def misspelt(found: DataFrame) -> DataFrame:
    """The runs of letters (doc_id, word), one in about 199 without the code point at h % length; h is the crc32 of ``<doc_id>:<word>``."""
    h = "crc32(CAST(concat(doc_id, ':', word) AS BINARY))"
    return found.selectExpr("word", f"{h} AS h").selectExpr("""
        IF(h % 199 = 0, concat(substring(word, 1, CAST(h % char_length(word) AS INT)),
                               substring(word, CAST(h % char_length(word) AS INT) + 2)), word) AS word""")


OP13_SQL = r"""
WITH RECURSIVE step AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(b AS BIGINT))) AS t
), spelt AS (
  SELECT doc_id, r, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-z\x{00C0}-\x{00FF}]+')) AS r FROM documents)
  WHERE length(r) >= 6 GROUP BY doc_id, r
), hashed AS (
  SELECT r, n, xor(4294967295, list_reduce(
           list_transform(range(octet_length(encode(k))), lambda i: CAST('0x' || substr(hex(encode(k)), 1 + 2 * i, 2) AS BIGINT)),
           lambda c, b: xor(c >> 8, list_extract(t, (xor(c, b) & 255) + 1)), CAST(4294967295 AS BIGINT))) AS h
  FROM (SELECT r, n, doc_id || ':' || r AS k FROM spelt), step
), voc AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 199 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM voc)
), pair AS (
  SELECT x.word, x.n, y.word AS near, y.n AS m FROM less x JOIN less y ON x.i = y.i AND x.v = y.v AND x.word <> y.word
  UNION SELECT x.word, x.n, y.word, y.n FROM less x JOIN voc y ON x.v = y.word
  UNION SELECT y.word, y.n, x.word, x.n FROM less x JOIN voc y ON x.v = y.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m, arg_min(near, (-m, encode(near))) AS near FROM pair GROUP BY word
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN near END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM voc LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS last FROM formed UNION ALL SELECT chain.word, form FROM chain JOIN formed ON formed.word = chain.last WHERE form IS NOT NULL
)
SELECT f.word, form, c.last AS root, n, n_near, form_n
FROM formed f JOIN (SELECT chain.word, last FROM chain JOIN formed e ON e.word = last WHERE e.form IS NULL) c ON c.word = f.word
"""


@query(OP13_SQL)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frequent form of every spelling in the documents."""
    # a run without one of its code points is no longer than before
    found = spelling.runs_of_letters(_table(spark, sf_dir, "documents")).where("char_length(word) >= 6")
    return spelling.spelling_variants(stage_table(spelling.vocabulary(misspelt(found), 6, 5), "vocabulary"))
