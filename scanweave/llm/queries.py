"""One query per operator: the operator on its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_multiprobe(spark: SparkSession, folder: str) -> DataFrame:
    from .ann import nearest

    return nearest(_table(spark, folder, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    from .quality import judged

    return judged(_table(spark, folder, "documents"))


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    from .jaccard import near_duplicates

    return near_duplicates(_table(spark, folder, "documents"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_substring(spark: SparkSession, folder: str) -> DataFrame:
    from .substring import remove_repeats

    return remove_repeats(_table(spark, folder, "documents")).drop("kept")


def op6_suffix(spark: SparkSession, folder: str) -> DataFrame:
    from .suffix import remove_earlier

    return remove_earlier(_table(spark, folder, "documents")).drop("kept")


def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Target: the documents labelled as good."""
    from .lm import score_corpus

    return score_corpus(_table(spark, folder, "documents"), _table(spark, folder, "labels").where("quality = 1"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Web counts twice among the domains; scarce leaves are read up to three times."""
    from .mixing import Target, mix_sources

    target = Target(weights={"domain": {"web": 2.0}}, share=1.0, epochs=3)
    taken = mix_sources(_table(spark, folder, "documents").select("doc_id", "text", "lang", "source"), target)
    return taken.selectExpr("doc_id", "_leaf.domain", "_leaf.lang", "_leaf.source", "_tokens AS n_tokens", "epoch")


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    from .langid import identify, train

    docs = _table(spark, folder, "documents")
    return identify(docs, train(docs))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from .tokens import count_tokens

    return count_tokens(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_shallot(spark: SparkSession, folder: str) -> DataFrame:
    from .kmeans import cluster_vectors

    members, centroids = cluster_vectors(_table(spark, folder, "embeddings"))
    centroids = centroids.selectExpr(  # one row per cluster: eight
        "cluster", "inertia AS cluster_inertia", "total AS inertia",
        "sha2(CAST(array_join(CAST(centroid AS array<string>), ',') AS binary), 256) AS centroid_sha256",
    )
    return members.join(F.broadcast(centroids), "cluster").select("vec_id", "cluster", "distance", *centroids.columns[1:])


def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    from .pieces import round_trip

    rows = round_trip(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.selectExpr(
        "doc_id",
        "CAST(size(ids) AS long) AS n_tokens",
        "sha2(CAST(array_join(CAST(ids AS array<string>), ',') AS binary), 256) AS ids_sha256",
        "sha2(CAST(decoded AS binary), 256) AS decoded_sha256",
    )


def op13_hybrid_search(spark: SparkSession, folder: str) -> DataFrame:
    from .ranking import ranked

    return ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_multiprobe, op2_quality, op3_ngram_jaccard, op4_packing, op5_substring, op6_suffix,
        op7_lm_scoring, op8_mixing, op9_language, op10_token_counts, op11_shallot, op12_sentencepiece, op13_hybrid_search,
    )
}


def _shallot_sql(rounds: int = 10) -> str:
    """Lloyd's rounds written out, every distance computed."""
    near = """a{r} AS MATERIALIZED (SELECT rid, x.c, x.d FROM (SELECT rid, min({{'d': list_sum(list_transform(list_zip(v, m),
  lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'c': c}}) AS x FROM v CROSS JOIN c{r} GROUP BY rid))"""
    move = """c{s} AS MATERIALIZED (SELECT c, coalesce(n.m, c{r}.m) AS m FROM c{r} LEFT JOIN (
  SELECT c, list((s - (s % n + n) % n) // n ORDER BY i) AS m FROM (
    SELECT a{r}.c, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r} JOIN v USING (rid), range(1, 65) t(i) GROUP BY a{r}.c, i) GROUP BY c) n USING (c))"""
    steps = [f.format(r=r, s=r + 1) for r in range(rounds) for f in (near, move)] + [near.format(r=rounds)]
    return f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
  list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256(concat('3:', vec_id)), v) - 1 AS c, v AS m FROM v
  WHERE vec_id IS NOT NULL QUALIFY c < 8),
{", ".join(steps)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256 FROM a{rounds} JOIN v USING (rid) JOIN c{rounds} USING (c)"""


ORACLES: dict[str, str] = {
    "op11_shallot": _shallot_sql(),
    "op13_hybrid_search": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
q AS (SELECT row_number() OVER () AS qid, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
l AS (SELECT rid, doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
s AS (SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM l),
qt AS (SELECT qid, item_id, t, count(*) AS k FROM (SELECT qid, item_id, unnest(ts) AS t FROM q) GROUP BY ALL),
tf AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM qt) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * all_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY t, all_docs),
m AS (SELECT rid, doc_id, 75 + (25 * n * all_docs) // all_terms AS m FROM l, s),
sc AS (SELECT qid, item_id, rid, doc_id, sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM qt JOIN tf USING (t) JOIN w USING (t) JOIN m USING (rid) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0) WHERE rank <= 20
""",
    "op2_quality": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c > 1),
n AS (SELECT rid, sum(least(5, i - coalesce(p, i - 5))) AS n
  FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS p FROM r) GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(n.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
  len(list_filter(ws, lambda x: regexp_matches(x, '\p{L}')))::BIGINT AS n_letter_words
  FROM w LEFT JOIN n USING (rid)),
b AS (SELECT *, ((n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
  + 4 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::BIGINT + 8 * (10 * n_symbols > n_words)::BIGINT
  + 16 * (100 * n_dup_lines > 40 * n_lines)::BIGINT + 32 * (100 * n_letter_words < 60 * n_words)::BIGINT)::BIGINT AS fail_bits FROM m)
SELECT *, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept FROM b
""",
}
