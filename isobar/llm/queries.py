"""The registered queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from isobar.llm import (
    bpe, curriculum, fill_in_middle, filter_audit, histogram_sort, html_density, language_mixture, maxscore, ngram_join,
    order_minhash, super_kmers, toxicity, wacz)
from isobar.llm.common import table


def op1_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best vectors for every vector whose id is divisible by 50, against all vectors."""
    vectors = maxscore.quantised(table(spark, sf_dir, "embeddings"))
    return maxscore.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return order_minhash.fingerprinted_edits(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Token ids of all documents, and the texts decoded from them, as digests."""
    ranks = bpe.read_ranks(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents takes of each, and when it is first and again trained on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = curriculum.assign(docs, curriculum.words(F.col("text")))
    when = lambda i: F.round(F.get("takes", F.lit(i))["position"], 9)
    return mixed.select("doc_id", "size", "source_size", "target", "taken",
                        when(0).alias("position"), when(1).alias("position_again")).orderBy("position", "doc_id")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, number of linked texts and number of equal texts of every document."""
    return ngram_join.join(table(spark, sf_dir, "documents"))


def _fold(folds: int) -> Column:
    """A document's fold; one without an id is in fold 0, as an empty text is."""
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % folds


def fitted_toxicity(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Learned from labels outside the held-out fold."""
    return toxicity.model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), _fold(5) != 0)


def op6_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    scored = toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"), fitted_toxicity(spark, sf_dir))
    return scored.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_density.extract(table(spark, sf_dir, "pages"))


def fitted_languages(docs: DataFrame):
    """Learned from documents outside the held-out fold."""
    return language_mixture.model(docs, _fold(4) != 2)


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    docs = table(spark, sf_dir, "documents")
    found = language_mixture.predict(docs.select("doc_id", "text"), fitted_languages(docs))
    return found.select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score", F.map_keys("mixture").alias("languages"))


def op9_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in ZIP packages, read back."""
    return wacz.round_trip(table(spark, sf_dir, "pages"), least=0)


def op10_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of nearly equal bytes."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").withColumn("text_crc32", F.crc32(F.encode(text, "UTF-8")))
    return histogram_sort.shard_documents(docs, 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 35 words that stand more than once."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return super_kmers.strip_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders, counted for each source."""
    return filter_audit.audit(filter_audit.flagged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut at lines and rearranged, and put together again."""
    made = fill_in_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_in_middle.restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_maxscore, op2_order_minhash, op3_byte_bpe, op4_curriculum, op5_ngram_join,
    op6_compression_toxicity, op7_text_density, op8_language_mixture, op9_zip_warc,
    op10_histogram_sort, op11_super_kmers, op12_filter_audit, op13_fill_in_middle)}

ORACLE = {
    "op1_maxscore": """
        WITH vectors AS (
            SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
        terms AS (SELECT DISTINCT vec_id, list_transform(x, lambda v: CAST(floor(256 * v) AS BIGINT)) AS t FROM vectors),
        scored AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   max(CAST(list_sum(list_transform(list_zip(q.t, v.t), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT)) AS score
            FROM terms q JOIN terms v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, v.vec_id)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        WHERE rank <= 5""",
    "op4_curriculum": """
        WITH sized AS (
            SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
                   CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
            FROM documents),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS kind
            FROM sized GROUP BY source),
        weighed AS (SELECT *, [3, 1, 2][kind + 1] AS weight, 2 * source_size AS most FROM sources),
        ordered AS (
            SELECT *, coalesce(sum(most) OVER low, 0) AS dealt, sum(weight) OVER high AS open_weight,
                   (SELECT sum(source_size) * 1.5 FROM sources)::DOUBLE AS total
            FROM weighed
            WINDOW low AS (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   high AS (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        levels AS (
            SELECT arg_min((total - dealt::DOUBLE) / open_weight::DOUBLE, most / weight)
                   FILTER (WHERE most > weight * ((total - dealt::DOUBLE) / open_weight::DOUBLE)) AS level FROM ordered),
        targets AS (
            SELECT source, source_size, kind, least(most::DOUBLE, weight::DOUBLE * (SELECT level FROM levels)) AS target FROM weighed),
        lined AS (
            SELECT s.doc_id, s.size, t.source_size, t.kind, t.target,
                   CAST(sum(size) OVER (PARTITION BY s.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS first_at
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
        taken AS (
            SELECT *, greatest(least(size, CAST(floor(target) AS BIGINT) - first_at), 0) AS once,
                   greatest(least(size, CAST(floor(target) AS BIGINT) - first_at - source_size), 0) AS twice,
                   [1.5, 0.5, 1.0][kind + 1]::DOUBLE AS rate, [-1.0, 1.0, 0.0][kind + 1]::DOUBLE AS slope FROM lined),
        placed AS (
            SELECT *, CASE WHEN once > 0 THEN least(first_at / target, 1) END AS y1,
                   CASE WHEN twice > 0 THEN least((first_at + source_size) / target, 1) END AS y2 FROM taken)
        SELECT doc_id, size, source_size, target, once + twice AS taken,
               CASE WHEN y1 > 0 THEN round(least(2 * y1 / (rate + sqrt(greatest(rate * rate + 2 * slope * y1, 0))), 1), 9) ELSE y1 END AS position,
               CASE WHEN y2 > 0 THEN round(least(2 * y2 / (rate + sqrt(greatest(rate * rate + 2 * slope * y2, 0))), 1), 9) ELSE y2 END AS position_again
        FROM placed""",
    "op11_super_kmers": """
        WITH lists AS (
            SELECT row_number() OVER () AS r, doc_id,
                   coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
        words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM lists),
        windows AS (
            SELECT r, i, string_agg(word, ' ') OVER f AS s, count(*) OVER f AS n FROM words
            WINDOW f AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
        repeated AS (SELECT s FROM windows WHERE n = 35 GROUP BY s HAVING count(*) > 1),
        starts AS (SELECT r, i, CASE WHEN n = 35 AND s IN (SELECT s FROM repeated) THEN 1 ELSE 0 END AS hit FROM windows),
        covered AS (
            SELECT r, i, max(hit) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM starts),
        kept AS (
            SELECT r, sum(gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '') AS text
            FROM covered JOIN words USING (r, i) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM lists LEFT JOIN kept USING (r)""",
    "op12_filter_audit": """
        WITH texts AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        least AS (SELECT text, min(doc_id) AS least FROM texts GROUP BY text),
        marks AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
            FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        flags AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, {
                'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w),
                'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
                'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(texts.doc_id > least, false)} AS f
            FROM texts JOIN least USING (text) LEFT JOIN marks ON marks.doc_id = texts.doc_id),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
        orders AS (
            SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
            FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l)
            JOIN letters d ON d.l NOT IN (a.l, b.l, c.l) JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)),
        states AS (
            SELECT part, good, toxic, (CASE WHEN f.A THEN 'A' ELSE '' END) || (CASE WHEN f.B THEN 'B' ELSE '' END)
                || (CASE WHEN f.C THEN 'C' ELSE '' END) || (CASE WHEN f.D THEN 'D' ELSE '' END)
                || (CASE WHEN f.E THEN 'E' ELSE '' END) AS failed, count(*) AS n
            FROM flags GROUP BY ALL),
        steps AS (
            SELECT part, filter_order, step, filter_order[step] AS letter, n, good, toxic, length(failed) AS fails,
                   contains(failed, filter_order[step]) AS here,
                   length(translate(filter_order[:step - 1], failed, '')) = step - 1 AS reached,
                   length(translate(filter_order[:step], failed, '')) = step AS passed
            FROM states, orders, (SELECT unnest(range(1, 6)) AS step)),
        counted AS (
            SELECT part, filter_order, CAST(step AS INTEGER) AS step, letter,
                   CAST(sum(CASE WHEN passed THEN n ELSE 0 END) AS BIGINT) AS kept,
                   CAST(sum(CASE WHEN here AND reached THEN n ELSE 0 END) AS BIGINT) AS removed,
                   CAST(sum(CASE WHEN here AND NOT reached THEN n ELSE 0 END) AS BIGINT) AS redundant,
                   CAST(sum(CASE WHEN here AND fails = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
                   CAST(sum(CASE WHEN here AND reached AND good = 1 THEN n ELSE 0 END) AS BIGINT) AS good_lost,
                   CAST(sum(CASE WHEN here AND reached AND toxic = 1 THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
            FROM steps GROUP BY ALL)
        SELECT * EXCLUDE (letter), CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM counted""",
    "op13_fill_in_middle": """
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
                   sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        drawn AS (
            SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS one,
                   CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS two,
                   text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                       OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 100 AS plain,
                   CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 AS spm FROM texts),
        cut AS (
            SELECT *, array_to_string(list_slice(u, 1, least(one, two)), '') AS p,
                   array_to_string(list_slice(u, least(one, two) + 1, greatest(one, two)), '') AS m,
                   array_to_string(list_slice(u, greatest(one, two) + 1, n), '') AS s FROM drawn)
        SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
               CASE WHEN NOT plain THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
               CASE WHEN NOT plain THEN CAST(length(m) AS BIGINT) END AS middle_chars,
               sha256(CASE WHEN plain THEN text WHEN spm THEN '<S>' || s || '<P>' || p || '<M>' || m
                      ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256 FROM cut""",
}
