"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from shopledger.llm import byte_bpe, golay, language, lines, manifest, neighbours, order_minhash, packing, sharding, suffixes, token_files, toxicity, whitening
from shopledger.llm.common import table
from shopledger.session import tune


def op1_toxicity(spark, folder):
    tune(spark)
    return toxicity.toxic_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_line_dedup(spark, folder):
    tune(spark)
    return lines.line_digests(table(spark, folder, "documents"))


def op3_order_minhash(spark, folder):
    tune(spark)
    return order_minhash.compared(table(spark, folder, "documents"))


def op4_language(spark, folder):
    tune(spark)
    return language.identify(table(spark, folder, "documents"))


def op5_byte_bpe(spark, folder):
    tune(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


def op6_neighbours(spark, folder):
    tune(spark)
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_packing(spark, folder):
    tune(spark)
    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_suffix_array(spark, folder):
    tune(spark)
    return suffixes.passage_digests(table(spark, folder, "documents"))


def op9_sharding(spark, folder):
    tune(spark)
    return sharding.shard_documents(table(spark, folder, "documents"))


def op10_golay_simhash(spark, folder):
    tune(spark)
    found = golay.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", golay.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op11_merkle_manifest(spark, folder):
    tune(spark)
    return manifest.manifest(table(spark, folder, "documents")).drop("proof")


def op12_whitening(spark, folder):
    tune(spark)
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_token_files(spark, folder):
    tune(spark)
    return token_files.digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_line_dedup, op3_order_minhash, op4_language, op5_byte_bpe, op6_neighbours, op7_packing, op8_suffix_array,
        op9_sharding, op10_golay_simhash, op11_merkle_manifest, op12_whitening, op13_token_files,
    )
}

STATEMENTS: dict[str, str] = {
    "op11_merkle_manifest": manifest.SQL,
    "op2_line_dedup": """WITH lines AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
keys AS (SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM (SELECT l.*, coalesce(k.owner <> l.doc_id, false) AS lost FROM lines l LEFT JOIN keys k ON k.key = l.key)
GROUP BY doc_id""",
    # all windows of 400 bytes, as 800 hexadecimal digits
    "op8_suffix_array": """WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
counted AS (SELECT doc_id, h, greatest(length(h) // 2 - 399, 0) AS n FROM bytes),
parts AS (SELECT doc_id, n, c, substr(h, 4096 * c + 1, 4896) AS part
  FROM (SELECT doc_id, h, n, unnest(range((n + 2047) // 2048)) AS c FROM counted)),
windows AS (SELECT doc_id, 2048 * c + j AS s, md5(substr(part, 2 * j + 1, 800)) AS w
  FROM (SELECT doc_id, c, part, unnest(range(least(2048, n - 2048 * c))) AS j FROM parts)),
starts AS (SELECT doc_id, s FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
islands AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS n
  FROM (SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 400 THEN 0 ELSE 1 END AS fresh FROM starts)),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 400 AS b FROM islands GROUP BY doc_id, n),
edges AS (SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS a, a AS b FROM spans
  UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id),
kept AS (SELECT e.doc_id, string_agg(substr(h, 2 * e.a + 1, CASE WHEN e.b IS NULL THEN length(h) ELSE 2 * (e.b - e.a) END), '' ORDER BY e.a) AS h
  FROM edges e JOIN bytes ON bytes.doc_id = e.doc_id GROUP BY e.doc_id)
SELECT b.doc_id, length(b.h) // 2 AS n_bytes, CAST(coalesce(r.removed, 0) AS BIGINT) AS n_removed, coalesce(r.spans, 0) AS n_spans,
  sha256(unhex(coalesce(k.h, b.h))) AS kept_sha256
FROM bytes b LEFT JOIN kept k ON k.doc_id = b.doc_id
LEFT JOIN (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM spans GROUP BY doc_id) r ON r.doc_id = b.doc_id""",
}
