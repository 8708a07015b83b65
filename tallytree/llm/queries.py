"""The queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_count, chat, decontaminate, hard_negatives, html_extract, merkle, near_duplicates, neighbours, packing, passages, personal_data, quality, repeats, toxicity
from .common import table, texts
from .decontaminate import sized

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.over_limit(bpe_count.token_counts(table(spark, sf_dir, "documents")), 1024)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.quality_scores(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``passage`` says which texts have one of over 50 words that another text has, too,
    however few bytes it is; what is removed is judged by 400 bytes."""
    docs = texts(table(spark, sf_dir, "documents"), "doc_id")
    id_, row = repeats.identity("doc_id", "text")
    found = repeats.remove_repeats(docs.select("doc_id", "text", row.alias("_told")), keep=("_told",))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    told = found.select("doc_id", "_told", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), (F.size("removed") > 0).alias("repeated"))
    shared = sized(passages.repeated_passages(docs.select(id_.alias("id"), row.alias("row"), "text")).select("id", "row"))
    return told.join(shared, (F.coalesce("doc_id", "_told") == F.col("id")) & (F.col("_told") == F.col("row")), "left").select(*(c for c in told.columns if c != "_told"), F.col("id").isNotNull().alias("passage"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: A conversation whose texts look like the marks of turns.
TRICKY = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(TRICKY, "conv_id long, turn long, role string, text string")
    return read_back(chat.formatted(chat.events_of_rows(rows.unionByName(tricky))))


def read_back(formatted: DataFrame) -> DataFrame:
    """The digests of each conversation, from its formatted text and loss mask alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in batches:
            texts, spans = b.column("formatted").to_pylist(), b.column("loss").to_pylist()
            turns = [chat.parse(t) for t in texts]
            loss = [chat.loss_text(t, s) for t, s in zip(texts, spans, strict=True)]
            digests = [sha("".join(f"{role}\n{text}\n" for role, text in t)) for t in turns]
            ints = lambda xs: pa.array(xs, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), ints([len(t) for t in turns]), pa.array(digests), ints([len(x) for x in loss]), pa.array([sha(x) for x in loss]), ints([len(t) for t in texts])],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.toxicity_scores(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, shifted)


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", decontaminate.UPPER, decontaminate.LOWER)
    fields = [merkle.encoded(lowered if f == "text" else F.col(f)) for f in ("doc_id", "source", "lang", "n_chars", "text")]
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    m = merkle.manifest(table(spark, sf_dir, "documents"), tampered=F.when(third, merkle.digest(*fields)))
    root = F.lit(m.root).cast("string")
    proof = merkle.proofs(m).withColumn("folded_root", merkle.folded(F.coalesce("tampered", "digest"), F.col("steps")))
    return proof.select(F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", root.alias("root"), F.sha2(merkle.told(F.col("steps")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == root).alias("verified"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(table(spark, sf_dir, "documents"))
    told = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["base"])
    counts = [F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in personal_data.KINDS]  # noqa: B023
    return found.select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_packing, op2_token_counts, op3_near_duplicates, op4_quality, op5_neighbours, op6_repeats, op7_decontamination, op8_html_extraction, op9_chat_formatting, op10_toxicity, op11_hard_negatives, op12_manifest, op13_personal_data)}

#: DuckDB's SQL of those that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op3_near_duplicates": r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
link AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.k, q.k HAVING 100 * count(*) >= 85 * (p.k + q.k - count(*))),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(k, 0) AS n_shingles, least(d.doc_id, b) AS component_id, least(d.doc_id, b) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.a = d.doc_id""",
    "op9_chat_formatting": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(replace(replace(role, '\', '\\'), ':', '\:')) + 2 + length(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')) + 8) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""",
    "op11_hard_negatives": r"""
WITH e AS MATERIALIZED (SELECT vec_id AS k, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.k AS anchor, b.k AS other, a.l = b.l AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score FROM e a JOIN e b ON a.k <> b.k WHERE a.k % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other) AS INT) AS rank, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor WHERE NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score QUALIFY rank <= 10""",
    "op12_manifest": r"""
WITH RECURSIVE d AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
  coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
  list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END) AS crc FROM documents),
l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM
  (SELECT doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295) % 3 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS tampered FROM d)),
t AS (SELECT g, 0 AS h, i, leaf AS x, n FROM l UNION ALL SELECT g, h + 1, i // 8, sha256(string_agg(x, '' ORDER BY i)), (any_value(n) + 7) // 8 FROM t WHERE n > 1 GROUP BY g, h, i // 8),
s AS MATERIALIZED (SELECT g, x AS subroot, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS h, g AS i, subroot AS x, n FROM s UNION ALL SELECT h + 1, i // 8, sha256(string_agg(x, '' ORDER BY i)), (any_value(n) + 7) // 8 FROM u WHERE n > 1 GROUP BY h, i // 8),
f AS (SELECT g, i AS leaf, 0 AS h, i, coalesce(tampered, leaf) AS x, '' AS proof, n FROM l
  UNION ALL SELECT f.g, leaf, f.h + 1, f.i // 8, sha256(string_agg(CASE WHEN t.i = f.i THEN f.x ELSE t.x END, '' ORDER BY t.i)), any_value(proof) || coalesce(string_agg(t.x, '' ORDER BY t.i) FILTER (t.i <> f.i), ''), (any_value(f.n) + 7) // 8
  FROM f JOIN t ON t.g = f.g AND t.h = f.h AND t.i // 8 = f.i // 8 WHERE f.n > 1 GROUP BY f.g, leaf, f.h, f.i),
v AS (SELECT f.g, leaf, 0 AS h, f.g AS i, x, proof, s.n FROM f JOIN s ON s.g = f.g WHERE f.n = 1
  UNION ALL SELECT v.g, leaf, v.h + 1, v.i // 8, sha256(string_agg(CASE WHEN u.i = v.i THEN v.x ELSE u.x END, '' ORDER BY u.i)), any_value(proof) || coalesce(string_agg(u.x, '' ORDER BY u.i) FILTER (u.i <> v.i), ''), (any_value(v.n) + 7) // 8
  FROM v JOIN u ON u.h = v.h AND u.i // 8 = v.i // 8 WHERE v.n > 1 GROUP BY v.g, leaf, v.h, v.i)
SELECT doc_id, l.leaf, subroot, root, sha256(proof) AS proof_sha256, v.x AS folded_root, v.x = root AS verified
FROM l JOIN s ON s.g = l.g JOIN v ON v.g = l.g AND v.leaf = l.i AND v.n = 1, (SELECT x AS root FROM u WHERE n = 1)""",
    "op7_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bn AS (SELECT item_id, w, least(13, len(w)) AS span FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, span, array_to_string(w[p:p + span - 1], ' ') AS g FROM (SELECT item_id, w, span, unnest(range(1, len(w) - span + 2)) AS p FROM bn)),
spans AS (SELECT DISTINCT span FROM bw),
dw AS (SELECT doc_id, p, span, array_to_string(w[p:p + span - 1], ' ') AS g FROM (SELECT doc_id, w, span, unnest(range(1, len(w) - span + 2)) AS p FROM d, spans)),
hit AS (SELECT doc_id, p, dw.span, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.span = bw.span),
covered AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + span)) AS word FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
