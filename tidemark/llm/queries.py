"""The registered queries of the subpackage: thin digests of what its operators return."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (alignment, bag_minhash, decontaminate, exact_dedup, html_text, interpolated_lm, line_dedup,
                          packing, pii, quality, sharding, spelling, token_files)
from tidemark.llm.common import fold_of
from tidemark.sources.tables import read_table

WORD_VOCABULARY, BYTE_VOCABULARY, PIECE_MODEL = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (line_dedup.line_dedup(_documents(spark, sf_dir), min_chars=40, min_docs=5)
            .select("doc_id", "n_lines", "n_dropped", _sha256(F.col("kept_text")).alias("kept_sha256")))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(_documents(spark, sf_dir), vocabulary(WORD_VOCABULARY))
    return token_files.read_token_files(files).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(_documents(spark, sf_dir)).select("doc_id", "class_id")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = pii.find(docs, pii.train(docs))
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    counts = [of_kind(kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, _sha256(listed(base)).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, vocabulary(BYTE_VOCABULARY)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = quality.learn(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_size(_documents(spark, sf_dir), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated_spans(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        _sha256(F.array_join("items", ",")).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op9_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score(_documents(spark, sf_dir), held_out_mod=10)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("hash")).alias("text_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_documents(spark, sf_dir), vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_MODEL))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(_documents(spark, sf_dir), min_chars=7, min_count=2, noise=31, ratio=10)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_files": op2_token_files,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_personal_data": op4_personal_data,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_sharding": op7_sharding,
    "op8_decontamination": op8_decontamination,
    "op9_interpolated_lm": op9_interpolated_lm,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_main_text": op12_main_text,
    "op13_spelling_variants": op13_spelling_variants,
}

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE_SQL = {
    "op1_line_dedup": f"""
        WITH split AS (
          SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        lines AS (
          SELECT doc_id, parts[i] AS line, i, translate(trim(parts[i], {_SPACES}), {_AZ}) AS k
          FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM split)),
        hot AS (
          SELECT k, max(doc_id) AS owner FROM lines WHERE length(k) >= 40
          GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
        marked AS (
          SELECT l.doc_id, l.i, l.line, (h.k IS NOT NULL AND l.doc_id <> h.owner) AS gone
          FROM lines l LEFT JOIN hot h ON l.k = h.k)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op8_decontamination": f"""
        WITH b AS (
          SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, {_AZ}), '{_WORD}') AS w
          FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
        phrases AS (
          SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
          FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
        d AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_WORD}') AS w FROM documents),
        sizes AS (SELECT DISTINCT n FROM phrases),
        windows AS (
          SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
        hits AS (SELECT w.doc_id, w.i, w.n, p.item FROM windows w JOIN phrases p ON w.n = p.n AND w.p = p.p),
        words AS (
          SELECT doc_id, count(DISTINCT place) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
        found AS (
          SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op10_exact_dedup": f"""
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS points,
                 translate(coalesce(text, ''), {_SPACES}, '') AS body FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, sha256(body) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id)""",
}
