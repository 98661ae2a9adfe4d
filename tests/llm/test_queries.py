"""The registered queries on sf0.001: oracle SQL, contract columns, the pipeline stage by stage."""

import duckdb
import pytest

from tidemark.llm.queries import ORACLE_SQL, QUERIES

from conftest import SF_SMALL

COLUMNS = {
    "op1_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op2_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op3_near_duplicates": "doc_id bigint, class_id bigint",
    "op4_personal_data": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                         "base_sha256 string, spans string",
    "op5_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                   "sequence_id bigint, offset bigint",
    "op6_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op7_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op8_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
                           "contaminated boolean",
    "op9_interpolated_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                           "base_score double, score double",
    "op10_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op11_token_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
                            "count_sum bigint, groups_sha256 string",
    "op12_main_text": "page_id bigint, url string, text string, n_chars bigint",
    "op13_spelling_variants": "word string, n bigint, n_near bigint, form string, form_n bigint, root string",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name]
    rows = df.collect()
    if "doc_id" not in df.columns:
        assert rows  # test_alignment_html_spelling.py compares them with brute force
        return
    ids = {r["doc_id"] for r in rows}
    assert ids == set(range(200)) and (len(rows) == 200 or name == "op5_packing")
    if name in ORACLE_SQL:
        con = duckdb.connect()
        for t in ("documents", "benchmark"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
        rel = con.sql(ORACLE_SQL[name])
        want = [tuple(r[rel.columns.index(c)] for c in df.columns) for r in rel.fetchall()]
        assert sorted(map(tuple, rows)) == sorted(want)


def test_pipeline(spark):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["quality", "exact", "near", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, ids = docs.columns, set(range(200))
    for name, stage in p.STAGES[:-1]:
        docs = p.written(stage(spark, docs, SF_SMALL), f"test-{name}")
        assert docs.columns == columns
        kept = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert len(kept) == len(set(kept)) and set(kept) <= ids and kept
        ids = set(kept)
    from tidemark.llm import bag_minhash, decontaminate, exact_dedup

    assert exact_dedup.exact_dedup(docs).where("not kept").count() == 0
    assert bag_minhash.near_duplicates(docs).where("doc_id <> class_id").count() == 0
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    assert decontaminate.contaminated_spans(docs, bench).where("size(spans) > 0").count() == 0
    out = p.run(spark, SF_SMALL).toPandas()
    assert set(out.doc_id) == ids
    assert (out.groupby("doc_id").length.sum() == out.groupby("doc_id").doc_tokens.first()).all()
