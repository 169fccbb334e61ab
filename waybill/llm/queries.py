"""The registered queries of this package, each over its whole table with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import configure, fresh_dir
from ..sources.tables import read_table
from . import conversation_trie, decontaminate, id_store, jaccard_join, lm_scoring, main_text, paragraphs, periodic_runs, pii, piece_codec, quality, toxicity, vector_dups

TOKENIZERS = "/opt/tokenizers"

Job = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def query(job: Job) -> Job:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return job(configure(spark), folder)

    QUERIES[job.__name__] = run
    return job


@query
def op4_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    decoded = piece_codec.decode(piece_codec.encode(read_table(spark, folder, "documents"), model), model)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query
def op5_id_store(spark: SparkSession, folder: str) -> DataFrame:
    store = fresh_dir(spark, "ids")
    id_store.write(read_table(spark, folder, "documents"), store, f"{TOKENIZERS}/word_bpe_49k.json", 1)
    return id_store.read(spark, store, digest=True)


@query
def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(read_table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("pii_spans")
    counts = [F.size(pii.of_kinds(spans, (k,))).cast("bigint").alias(f"n_{k}") for k in pii.BASE]
    return found.select(
        "doc_id", *counts,
        F.sha2(pii.written_out(spans, pii.BASE), 256).alias("base_sha256"),
        pii.written_out(spans).alias("spans"),
    )


def remainder(n: int) -> Column:
    """What the decimal id's CRC-32 leaves by ``n``; a null id counts as 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % n, F.lit(0))


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = toxicity.train(docs, read_table(spark, folder, "labels"), remainder(3) != 1)
    scored = toxicity.score(docs, model)
    score = F.col("toxicity.score")
    return scored.select(
        "doc_id", (remainder(3) == 1).alias("held_out"), score.alias("score"), (score >= 0.7).cast("int").alias("predicted"),
        F.col("toxicity.threshold").alias("threshold"), F.col("toxicity.toxic").alias("rejected"),
    )


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    net = quality.train(docs, read_table(spark, folder, "labels"), remainder(5) != 0)
    score = F.col("quality_score")
    return quality.score(docs, net).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), score.alias("score"), (score >= 0.3).cast("int").alias("predicted"),
    )


@query
def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard_join.similar_documents(read_table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = (read_table(spark, folder, name) for name in ("documents", "benchmark"))
    return decontaminate.overlaps(docs, items).drop("text_hash").distinct()


@query
def op6_vector_dups(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dups.links(read_table(spark, folder, "embeddings"))


@query
def op9_paragraph_dups(spark: SparkSession, folder: str) -> DataFrame:
    found = paragraphs.repeated(read_table(spark, folder, "documents"))
    return found.select("doc_id", "start", "n_words", "cluster", "kept")


@query
def op1_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    scored = lm_scoring.score(docs, remainder(7) != 2)
    return scored.select("doc_id", (remainder(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extract(read_table(spark, folder, "pages"))


@query
def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = conversation_trie.turn_ids(read_table(spark, folder, "conversations"))
    conv = F.col("conv_id")
    rebuilt = conversation_trie.with_heads(turns, conv - conv % 5, 8, F.crc32(conv.cast("string")) % 9)
    nodes = conversation_trie.prefix_nodes(rebuilt)
    return nodes.drop("turn_hash").withColumnRenamed("saved_bytes", "saved_tokens")


def repeated_tails(ids: list, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For about a tenth of the ids, from which word on and with which period a text repeats itself."""
    tail, period = sizes.copy(), np.ones_like(sizes)
    for i, (ident, n) in enumerate(zip(ids, sizes.tolist())):
        h = None if ident is None else zlib.crc32(str(ident).encode())
        if h is not None and h % 10 == 0 and n > 0:
            g = h // 10
            tail[i] = g % n
            period[i] = 1 + (n - g % n) // (3 + g % 8)
    return tail, period


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = periodic_runs.find(docs, collapsed="sha256", tails=repeated_tails).withColumn("best", periodic_runs.longest("runs"))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"),
    )


ORACLES["op6_vector_dups"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, [CAST(x AS DOUBLE) for x in embedding] AS e FROM embeddings),
n AS (SELECT vec_id, label, e, sqrt(list_sum([x * x for x in e])) AS size FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.size > 0 AND b.size > 0 AND list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.98),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS least_id FROM r GROUP BY 1), k AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY 1)
SELECT v.vec_id, COALESCE(k.n, 0) AS n_links, LEAST(v.vec_id, COALESCE(c.least_id, v.vec_id)) AS component_id,
  v.vec_id = LEAST(v.vec_id, COALESCE(c.least_id, v.vec_id)) AS kept
FROM v LEFT JOIN c ON c.vec_id = v.vec_id LEFT JOIN k ON k.vec_id = v.vec_id"""

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLES["op10_jaccard_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, [x for x in string_split_regex(translate(COALESCE(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), '[\\x20\\x09-\\x0D]+') if x <> ''] AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN [array_to_string(ws[i:i + 3], ' ') for i in range(1, len(ws) - 2)]
  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
h AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * common >= 85 * (x.n + y.n - common)),
l AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS least_id FROM r GROUP BY 1)
SELECT w.doc_id, COALESCE(n.n, 0) AS n_shingles, LEAST(w.doc_id, COALESCE(c.least_id, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id"""

ORACLES["op12_conversation_trie"] = """
WITH RECURSIVE bits(i, k, v) AS (SELECT i, 0, CAST(i AS UBIGINT) FROM range(256) x(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS UBIGINT)) ELSE v >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS crc FROM bits WHERE k = 8),
turns AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p,
  octet_length(encode(COALESCE(role, ''))) || ':' || COALESCE(role, '') || COALESCE(text, '') AS spelled,
  octet_length(encode(COALESCE(text, ''))) AS size FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 5 AS b, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), [CAST(ascii(x) AS UBIGINT) for x in string_split(CAST(c AS VARCHAR), '')]),
    lambda s, x: xor(s >> 8, crc[CAST(xor(s, x) & 255 AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) % 9 AS BIGINT) AS h
  FROM (SELECT DISTINCT c FROM turns), crc),
rebuilt AS (SELECT convs.c, 0 AS part, p, spelled, size FROM convs JOIN turns ON turns.c = convs.b WHERE p <= h
  UNION ALL SELECT convs.c, 1, p, spelled, size FROM convs JOIN turns ON turns.c = convs.c WHERE p > h),
paths AS (SELECT convs.c, COALESCE(path, []) AS path, COALESCE(sizes, []) AS sizes FROM convs LEFT JOIN
  (SELECT c, list(md5(spelled) ORDER BY part, p) AS path, list(size ORDER BY part, p) AS sizes FROM rebuilt GROUP BY 1) USING (c)),
steps AS (SELECT c, path, sizes, unnest(range(0, len(path) + 1)) AS d FROM paths),
nodes AS (SELECT path[1:d] AS node, d, min(c) AS conv_id, count(*) AS n_convs, max(CASE WHEN d > 0 THEN sizes[d] ELSE 0 END) AS size,
  count(DISTINCT path[d + 1]) FILTER (WHERE len(path) > d) AS n_children,
  sha256(COALESCE(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(path) = d), '')) AS ends_sha256 FROM steps GROUP BY 1, 2),
below AS (SELECT node[1:k] AS node, k AS d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM nodes) GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
  CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.d = n.d AND b.node = n.node LEFT JOIN nodes u ON u.d = n.d - 1 AND u.node = n.node[1:n.d - 1]"""
