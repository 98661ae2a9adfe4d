"""Bounds that the operators state: time by length, rows in a group, what lies on the driver."""

import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, packing, pii, token_files
from tidemark.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY, vocabulary

from llm_fixtures import frame, odd_rows  # noqa: F401


@pytest.mark.parametrize("piece", [" @a.b", "@a.b", "a@a.b ", "a@", "@a", "_.%+-@x.y"])
def test_personal_data_takes_linear_time(piece):
    began = time.perf_counter()
    pii.base_spans(piece * (2_000_000 // len(piece)))
    assert time.perf_counter() - began < 3


def test_equal_rows_are_packed_in_many_groups(frame):
    """40,000 equal rows in the groups their size calls for, none much fuller than the others."""
    rows = frame([(1, "the same short text")] * 40_000, clash=False).coalesce(2)
    got = packing.pack(rows, vocabulary(BYTE_VOCABULARY), group_bytes=1 << 20)
    sizes = [r["n"] for r in got.groupBy(F.shiftright("sequence_id", 32)).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == -(-40_000 * (19 + 256) // (1 << 20)) and max(sizes) < 1.2 * min(sizes)


def test_rows_without_an_id_fill_many_parts(frame):
    rows = frame([(None, f"text {i} of no document") for i in range(4000)], clash=False).repartition(8)
    files = token_files.write_token_files(rows, vocabulary(WORD_VOCABULARY))
    parts = [r["n"] for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()]
    assert len(parts) > 4 and max(parts) < 3 * min(parts)


def test_benchmark_blocks_come_one_at_a_time(spark, frame, monkeypatch):
    items = spark.createDataFrame([(i, f"alpha{i} beta{i} gamma{i} delta{i}") for i in range(40)], "item_id long, text string")
    docs = frame([(i, f"some words and alpha{i} beta{i} gamma{i} delta{i} and more") for i in range(0, 40, 3)], clash=False)
    held, most = [], []
    build = decontaminate.Phrases.__init__

    def counted(self, block, window):
        most.append(len(block))
        build(self, block, window)

    destroy = type(spark.sparkContext.broadcast(0)).destroy
    monkeypatch.setattr(decontaminate.Phrases, "__init__", counted)
    monkeypatch.setattr("pyspark.core.broadcast.Broadcast.destroy", lambda self, *a: (held.append(1), destroy(self, *a))[1])
    got = decontaminate.contaminated_spans(docs, items, block_words=100).collect()
    assert len(most) > 3 and sum(most) == 40 and len(held) == len(most)
    assert sorted((r["doc_id"], r["items"]) for r in got) == [(i, [str(i)]) for i in range(0, 40, 3)]


def test_pipeline_stages_keep_columns_of_any_name(spark, frame):
    """Columns called like the stages' own helpers come through unchanged; empty tables give empty tables."""
    from tidemark.llm import bag_minhash, exact_dedup, quality

    names = ("_keep", "_keep1", "_keep2", "_owner1", "_owner2", "_cut1", "_cut2", "_cuts", "_KEEP1_", "copy")
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, text + " one two three"), (2, text + " one two three"), (3, "wholly other words stand in this one"), (4, None)]
    docs = frame(rows)
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{k}:"), F.coalesce("doc_id", F.lit(0))))
    items = spark.createDataFrame([(1, text), (2, "nothing that occurs")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 1)], "doc_id long, quality int")
    stages = [exact_dedup.keep_owners, bag_minhash.keep_one,
              lambda d: decontaminate.remove_spans(d, items), lambda d: decontaminate.remove_spans(d, items, block_words=5),
              lambda d: quality.keep_good(d, quality.learn(d, labels))]
    for stage in stages:
        out = stage(docs)
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(r[name] == f"{k}:{r['doc_id']}" for r in got for k, name in enumerate(names))
        assert stage(docs.limit(0)).collect() == []


def lm_rows(table):
    return sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in table.collect()), key=repr)


def test_language_model_exchange_in_steps(spark, frame, odd_rows, tmp_path):
    """Few rows a cell: the exchange takes several steps and every count is the same."""
    from tidemark.llm import interpolated_lm

    rows = list(odd_rows) + [(100 + i, " ".join(f"w{(i * k) % 37}" for k in range(i % 40))) for i in range(400)]
    frame(rows).repartition(3).write.parquet(f"{tmp_path}/d")
    df = spark.read.parquet(f"{tmp_path}/d")
    want = lm_rows(interpolated_lm.token_counts(df))
    for options in ({"cell_bytes": 3000}, {"cell_bytes": 3000, "fan": 6}, {"cell_bytes": 300, "fan": 4, "buckets": 60}):
        assert lm_rows(interpolated_lm.token_counts(df, **options)) == want


def test_language_model_cells_and_rows(spark, frame, tmp_path, monkeypatch):
    """Cells are bounded by bytes also where long texts follow short ones; what they send grows as they do."""
    from tidemark.llm import interpolated_lm as lm

    def sent(n):
        rows = [(i, "short text") for i in range(40 * n)] + [(10**6 + i, f"long{i} " * 400) for i in range(20 * n)]
        path = f"{tmp_path}/{n}"
        frame(rows, clash=False).coalesce(1).write.parquet(path)
        counts = []
        exchange = lm._exchange

        def counted(asked, senders, fan, buckets, last):
            counts.append((asked.count(), asked.select("cell").distinct().count(), fan))
            return exchange(asked, senders, fan, buckets, last)

        monkeypatch.setattr(lm, "_exchange", counted)
        lm.token_counts(spark.read.parquet(path), cell_bytes=8000, fan=8)
        monkeypatch.setattr(lm, "_exchange", exchange)
        return counts

    small, large = sent(1), sent(6)
    for counts in (small, large):
        for rows, cells, fan in counts:
            assert rows == cells * fan and fan <= 8
    assert 4 * small[0][1] < large[0][1] < 8 * small[0][1]
    for counts in (small, large):  # fan rows a cell and step, not one for every bucket
        assert sum(rows for rows, _, _ in counts) <= 1.5 * len(counts) * 8 * counts[0][1]
