"""The registered queries' columns on the whole table sf0.001, recomputed row by row from the data contract."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm.queries import BYTE_VOCABULARY, QUERIES, WORD_VOCABULARY, vocabulary

from conftest import SF_SMALL
from test_operators import base_expected, lower


@pytest.fixture(scope="module")
def docs():
    t = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"])
    return dict(sorted((d, x or "") for d, x in zip(t["doc_id"].to_pylist(), t["text"].to_pylist())))


def rows(spark, name):
    return QUERIES[name](spark, SF_SMALL).collect()


def ids_of(name, text):
    from tokenizers import Tokenizer

    if name not in _LIBRARY:
        _LIBRARY[name] = Tokenizer.from_file(vocabulary(name))
    return [*_LIBRARY[name].encode(text, add_special_tokens=False).ids, 1]


_LIBRARY = {}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, docs):
    want, start = [], 0
    for d, text in docs.items():
        ids = ids_of(WORD_VOCABULARY, text)
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, rows(spark, "op2_token_files"))) == want


def test_personal_data(spark, docs):
    for r in rows(spark, "op4_personal_data"):
        base = [f"{k}:{a}:{b}" for k, a, b in base_expected(docs[r["doc_id"]])]
        kinds = Counter(s.split(":")[0] for s in base)
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [kinds[k] for k in ("email", "ip", "card", "phone")]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        order = [(("email", "ip", "card", "phone").index(k), int(a)) for k, a, _ in (s.split(":") for s in spans)]
        assert set(base) <= set(spans) and order == sorted(order)


def test_packing(spark, docs):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows(spark, "op5_packing"):
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(docs)
    for d, text in docs.items():
        ids, at = ids_of(BYTE_VOCABULARY, text), 0
        for start, n, check, total in sorted(pieces[d]):
            assert start == at and n > 0 and total == len(ids) and check == crc(ids[start:start + n])
            at += n
        assert at == len(ids)
    for held in sequences.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= 2048
    total = sum(n for held in sequences.values() for _, n in held)
    assert 2048 * len(sequences) < 1.1 * total + 2048


def test_quality(spark, docs):
    for r in rows(spark, "op6_quality"):
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_quality_tells_held_out_labels_apart(spark):
    """sf0.01: area under the curve of documents whose labels were not learned."""
    sf = SF_SMALL.replace("0.001", "0.01")
    labels = pq.read_table(f"{sf}/labels.parquet").to_pydict()
    label = dict(zip(labels["doc_id"], labels["quality"]))
    scored = [(r["score"], label[r["doc_id"]]) for r in QUERIES["op6_quality"](spark, sf).collect()
              if r["held_out"] and label.get(r["doc_id"]) is not None]
    good, bad = ([s for s, y in scored if y == k] for k in (1, 0))
    assert len(good) > 20 and len(bad) > 10
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95, auc


def test_sharding(spark, docs):
    slots, size, shard_of = defaultdict(list), Counter(), defaultdict(set)
    for r in rows(spark, "op7_sharding"):
        text = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "bytes", None)
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
        shard_of[text].add(r["shard"])
    assert set(slots) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shard_of.values())  # equal texts stay together
    largest = max(Counter(len(t) + 1 for t in shard_of).keys())
    groups = Counter(docs.values())
    heaviest = max(n * (len(t.encode()) + 1) for t, n in groups.items())
    assert max(size.values()) <= sum(size.values()) / 16 + max(largest, heaviest)


def test_language_model(spark, docs):
    space = re.compile("[^\x20\x09-\x0d]+")
    words = {d: [*space.findall(lower(t)), None] for d, t in docs.items()}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in docs}
    c = Counter(w for d, ws in words.items() if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    found = rows(spark, "op9_interpolated_lm")
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)
    for r in found:
        ws = words[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held[r["doc_id"]], len(ws), sum(c[w] > 0 for w in ws), n)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)


def test_near_classes(spark, docs):
    """Classes of documents linked by five-word shingles, as multisets, at 0.8 or more."""
    from tidemark.llm.common import words_of

    def shingles(text):
        w = words_of(text.encode())
        return Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else None

    held = {d: shingles(t) for d, t in docs.items()}
    root = {d: d for d in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    some = [d for d in docs if held[d]]
    for i, a in enumerate(some):
        for b in some[:i]:
            x, y = held[a], held[b]
            if docs[a] == docs[b] or (x & y).total() >= 0.8 * (x | y).total():
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    got = {r["doc_id"]: r["class_id"] for r in rows(spark, "op3_near_duplicates")}
    same = defaultdict(set)
    for d, k in got.items():
        same[k].add(d)
    want = defaultdict(set)
    for d in some:
        want[find(d)].add(d)
    assert {frozenset(s) for s in want.values() if len(s) > 1} == {frozenset(s & set(some)) for s in same.values() if len(s & set(some)) > 1}
