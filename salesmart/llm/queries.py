"""The registered queries of the numbered operators: thin digests of the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import conversation_repair, decontaminate, langid, licenses, packing, pii, ppm, prefix_trie, sharding, simhash, suffix_dedup, topk, toxicity
from salesmart.llm.common import bounded, remainder, table

#: Labels are broadcast up to this many rows (16 bytes each); beyond it they are joined by a shuffle.
LABELS = 2_000_000


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    net = langid.fit(docs.filter(~held_out))
    return langid.identify(docs, net, "doc_id", held_out.alias("held_out"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    shared = F.aggregate("passages", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["start"])
    return found.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), shared.alias("n_shared_words"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out)
    grammar = toxicity.fit(docs.filter("not held_out").join(bounded(labels, LABELS), "doc_id"))
    scored = toxicity.score(docs, grammar, "doc_id", "held_out")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_spans(table(spark, sf_dir, "documents"))
    base, own = F.col("phrases.label"), F.col("spans.label")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.coalesce(F.array_max("spans.share"), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"), F.array_min("phrases.start").alias("first_word"), F.array_max("phrases.start").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"), F.when(F.size("phrases") > 0, 1.0).otherwise(best).alias("score"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.report(table(spark, sf_dir, "documents"))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["number"] < len(pii.KINDS))
    count = lambda number: F.size(F.filter("spans", lambda s: s["number"] == number)).cast("long")
    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def op10_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return ppm.score(docs, ppm.fit(docs.filter("not held_out")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.shared_openings(prefix_trie.turn_lists(table(spark, sf_dir, "conversations"))))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    report = conversation_repair.repair_report(conversation_repair.damaged(turns)).withColumnRenamed("conv_id", "found_id")
    ids = turns.select("conv_id").distinct()
    whole = ids.join(report, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_langid": op2_langid,
    "op3_packing": op3_packing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_topk": op7_topk,
    "op8_licenses": op8_licenses,
    "op9_pii": op9_pii,
    "op10_ppm": op10_ppm,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_sharding": op13_sharding,
}

_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

#: CRC-32 (reflected polynomial 0xEDB88320), which DuckDB lacks: its table of 256 entries from its rule, then byte by byte.
_CRC_TABLE = "list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1))))"


def _crc32(text: str) -> str:
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295)"


#: DuckDB SQL of the queries that SQL can express; the others are tested against brute force.
ORACLE: dict[str, str] = {
    "op1_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, w, least(10, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS phrase FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM i)),
runs AS (SELECT doc_id, k, p, array_to_string(list_slice(w, p, p + k - 1), ' ') AS phrase
         FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k)),
hits AS (SELECT r.doc_id, r.p, r.k, f.item_id FROM runs r JOIN phrases f ON r.k = f.k AND r.phrase = f.phrase),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS pos FROM hits) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(l.n_items, 0) AS n_items,
       sha256(coalesce(l.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN listed l ON d.doc_id = l.doc_id""",
    "op7_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op11_prefix_trie": f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
named AS (SELECT *, sha256(strlen(role) || ':' || role || text) || '/' || len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS id FROM turns),
own AS (SELECT conv_id, list(id ORDER BY turn NULLS FIRST, role, id) AS ids FROM named GROUP BY conv_id),
opened AS (SELECT conv_id, ids, {_crc32('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM own, (SELECT {_CRC_TABLE} AS t)),
rebuilt AS (SELECT o.conv_id, list_concat(coalesce(list_slice(b.ids, 1, h), []), coalesce(list_slice(o.ids, h + 1, len(o.ids)), [])) AS ids
            FROM opened o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
prefixes AS (SELECT conv_id, ids, d, array_to_string(list_slice(ids, 1, d), ' ') AS path FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, arg_min(ids, conv_id) AS ids, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = len(ids)), '') AS ends
          FROM prefixes GROUP BY path, d),
linked AS (SELECT *, CASE WHEN d > 0 THEN array_to_string(list_slice(ids, 1, d - 1), ' ') END AS up, CASE WHEN d > 0 THEN (n - 1) * CAST(split_part(ids[d], '/', 2) AS BIGINT) ELSE 0 END AS saved FROM nodes),
kids AS (SELECT up, d - 1 AS d, count(*) AS n FROM linked WHERE d > 0 GROUP BY up, d),
whole AS (SELECT l.*, coalesce(j.n, 0) AS n_children FROM linked l LEFT JOIN kids j ON j.up = l.path AND j.d = l.d),
sums AS (SELECT array_to_string(list_slice(ids, 1, k), ' ') AS path, k AS d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
         FROM (SELECT *, unnest(range(d + 1)) AS k FROM whole) GROUP BY 1, 2)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n AS n_convs, w.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM whole w JOIN sums s ON s.path = w.path AND s.d = w.d LEFT JOIN whole p ON p.path = w.up AND p.d = w.d - 1""",
    "op13_sharding": f"""
WITH d AS (SELECT doc_id, text_crc32, strlen(text) + 8 AS size, sha256(text) AS print
           FROM (SELECT doc_id, text, {_crc32('text')} AS text_crc32 FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents), (SELECT {_CRC_TABLE} AS t))),
placed AS (SELECT *, sum(size) OVER (ORDER BY print, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS start, sum(size) OVER () AS total FROM d),
cut AS (SELECT *, CAST(((2 * start + size) * 24) // (2 * total) AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY start) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut""",
}
