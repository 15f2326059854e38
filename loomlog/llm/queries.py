"""The registered queries of this package, with DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.llm import decontam, filteraudit, langid, linededup, mixing, neardup, neighbours, packing, prefixbpe, quality, tokencounts, tokenfile, vectorcodes
from loomlog.llm.common import fold, table, written
from loomlog.session import scratch_path

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


@query("op5_benchmark_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    return decontam.digest(decontam.scan(docs, bench, keep=["doc_id"]))


@query("op6_token_id_output")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id")) == 0
    trees = langid.freeze(langid.count_runs(docs.where(~held_out), "text", "lang"))
    return langid.identify(docs, trees, held_out=held_out).select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


OP8_SQL = r"""
WITH t AS (
  SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
      '<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'gis'),
      '</?(p|div|br|li|ul|ol|nav|h[1-6]|article|section|header|footer|table|tr|td|title|head|body|html|main|aside|form)(?:\s[^>]*)?/?>', chr(10), 'gi'),
      '<[^>]*>', '', 'g'), '[ \t]*\n\s*', chr(10), 'g') AS text
  FROM pages),
l AS (SELECT page_id, host, generate_subscripts(string_split(text, chr(10)), 1) AS k,
        unnest(string_split(text, chr(10))) AS line FROM t),
n AS (SELECT host, trim(line, ' ') AS line, count(DISTINCT page_id) AS n FROM l WHERE trim(line, ' ') <> '' GROUP BY 1, 2),
h AS (SELECT host, count(*) AS pages FROM t GROUP BY 1),
bad AS (SELECT n.host, n.line FROM n JOIN h USING (host) WHERE n.n >= 4 AND n.n > 0.1 * h.pages),
m AS (SELECT l.*, bad.line IS NOT NULL AS out FROM l LEFT JOIN bad ON l.host = bad.host AND trim(l.line, ' ') = bad.line)
SELECT m.page_id, m.host, any_value(h.pages) AS host_pages,
  count(*) FILTER (trim(m.line, ' ') <> '') AS n_lines, count(*) FILTER (m.out) AS n_dropped,
  coalesce(string_agg(m.line, chr(10) ORDER BY m.k) FILTER (NOT m.out), '') AS text
FROM m JOIN h ON m.host = h.host GROUP BY 1, 2
"""


@query("op8_line_dedup", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.site_lines(table(spark, sf_dir, "pages"))


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), usable=lambda i: fold(i) != 0)
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), F.col("__score").alias("score"),
                         (F.col("__score") >= 0.3).cast("int").alias("predicted"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, lang,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS v1,
    len(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS v2
  FROM documents WHERE doc_id % 7 <> 3)
SELECT source, lang, CASE WHEN doc_id % 5 = 2 THEN 'alnum-v2' ELSE 'words-v1' END AS tokenizer_version,
  count(*) AS n_docs, CAST(sum(CASE WHEN doc_id % 5 = 2 THEN v2 ELSE v1 END) AS BIGINT) AS n_tokens
FROM d GROUP BY 1, 2, 3
"""


@query("op1_token_counts", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in, some go, some are recounted by a newer tokenizer; one batch is delivered twice."""
    docs = table(spark, sf_dir, "documents")
    rollup = tokencounts.TokenRollup(spark, scratch_path(spark, "token-rollup"))

    def changes(op: str, version: str, count, rows: DataFrame) -> DataFrame:
        return rows.select("doc_id", F.lit(op).alias("op"), "source", "lang", F.lit(version).alias("tokenizer_version"),
                           count.alias("n_tokens"))

    rollup.commit(1, changes("insert", "words-v1", tokencounts.words_v1(F.col("text")), docs))
    leaving = changes("delete", "words-v1", F.lit(0), docs.where("doc_id % 7 = 3"))
    rollup.commit(2, leaving)
    rollup.commit(3, changes("revise", "alnum-v2", tokencounts.alnum_v2(F.col("text")), docs.where("doc_id % 5 = 2")))
    rollup.commit(2, leaving)
    return rollup.totals()


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", (tokencounts.words_v1(F.col("text")) + 1).alias("n_tokens"),
                        F.when(F.col("text").isNotNull(), F.xxhash64(F.lower(F.trim(F.regexp_replace("text", r"\s+", " "))))).alias("cluster"))
    return packing.pack(written(sized, "sized"))


@query("op2_nearest_neighbours")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query("op4_lm_scoring")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(table(spark, sf_dir, "documents"), fold(F.col("doc_id")) == 1)


@query("op3_minhash_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op11_byte_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = prefixbpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return prefixbpe.decode(ids, ranks, keep=["doc_id", "ids"]).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def _op13_sql(parts: int = vectorcodes.PARTS, entries: int = vectorcodes.ENTRIES, rounds: int = vectorcodes.ROUNDS) -> str:
    """Every distance in every assignment, as joins."""
    def assigned(k: int) -> str:
        return (f"a{k} AS (SELECT vec_id, part, min(struct_pack(d, entry)) AS best FROM (SELECT v.vec_id, v.part, b.entry, "
                f"sum((v.x - b.x) * (v.x - b.x)) AS d FROM v JOIN b{k} AS b ON v.part = b.part AND v.pos = b.pos GROUP BY 1, 2, 3) GROUP BY 1, 2)")

    def improved(k: int) -> str:
        return (f"b{k + 1} AS (SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x FROM b{k} AS b LEFT JOIN ("
                f"SELECT v.part, a.best.entry AS entry, v.pos, CAST(floor(sum(v.x) / count(*)) AS BIGINT) AS x "
                f"FROM v JOIN a{k} AS a ON v.vec_id = a.vec_id AND v.part = a.part GROUP BY 1, 2, 3) m "
                "ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos)")

    steps = [f"{assigned(k)}, {improved(k)}" for k in range(rounds)] + [assigned(rounds)]
    return f"""
WITH k AS (SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS ints FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
u AS (SELECT vec_id, unnest(ints) AS x, generate_subscripts(ints, 1) - 1 AS place, len(ints) / {parts} AS width FROM k),
v AS (SELECT vec_id, CAST(floor(place / width) AS BIGINT) AS part, CAST(place - width * floor(place / width) AS BIGINT) AS pos, x FROM u),
s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k ORDER BY vec_id LIMIT {entries}),
b0 AS (SELECT part, entry, pos, x FROM v JOIN s USING (vec_id)),
{", ".join(steps)},
c AS (SELECT vec_id, string_agg(format('{{:02x}}', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY 1),
h AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{rounds})
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, h.codebooks_sha256
FROM c JOIN k USING (vec_id), h
"""


@query("op13_vector_codes", _op13_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vectorcodes.compress(table(spark, sf_dir, "embeddings"), keep=["label"])
    return vectorcodes.with_label_error(coded.rows).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256"))


OP12_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (SELECT doc_id, part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id),
m AS (SELECT part, CAST(a AS INT) + 2 * CAST(b AS INT) + 4 * CAST(c AS INT) + 8 * CAST(d AS INT) + 16 * CAST(e AS INT) AS mask,
    coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
    FROM x p, x q, x r, x s, x t WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31
      AND len(list_distinct([p.bit, q.bit, r.bit, s.bit, t.bit])) = 5),
k AS (SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS before
    FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
g AS (SELECT part, filter_order, step, bit, n, good, toxic, (mask & bit) <> 0 AS fails, (mask & before) <> 0 AS earlier, mask = bit AS only_this
    FROM m, k),
z AS (SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (NOT fails AND NOT earlier), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT earlier), 0) AS removed,
    coalesce(sum(n) FILTER (fails AND earlier), 0) AS redundant, coalesce(sum(n) FILTER (only_this), 0) AS unique_fails,
    coalesce(sum(n) FILTER (fails AND NOT earlier AND good = 1), 0) AS good_lost,
    coalesce(sum(n) FILTER (fails AND NOT earlier AND toxic = 1), 0) AS toxic_lost FROM g GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM z
"""


@query("op12_filter_audit", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = filteraudit.FilterAudit(spark, scratch_path(spark, "filter-audit"))
    audit.process(f"{sf_dir.rstrip('/')}/documents.parquet", table(spark, sf_dir, "labels"))
    return audit.report()
