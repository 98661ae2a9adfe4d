"""Each operator against a brute-force version, and on odd rows: nulls, empty and very long texts,
repeated rows, shared ids, empty tables, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import (bag_minhash, decontaminate, exact_dedup, interpolated_lm, line_dedup, packing, pii, quality,
                          sharding, token_files)
from tidemark.llm.common import words_of
from tidemark.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY, vocabulary
from tidemark.llm.tokens import Encoder

from llm_fixtures import frame, odd_rows  # noqa: F401

SPACES = " \t\n\x0b\x0c\r"
RND = random.Random(5)
VOCABULARY = ["".join(RND.choice("abcdeéñ") for _ in range(RND.randint(2, 6))) for _ in range(300)]


def sentence(n):
    return " ".join(RND.choice(VOCABULARY) for _ in range(n))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# --- lines ---------------------------------------------------------------------------------------


def lines_expected(rows, min_chars, min_docs):
    key = lambda line: lower(line.strip(SPACES))
    held = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars and d is not None:
                held[key(line)].add(d)
    owner = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or owner.get(key(x), d) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_line_dedup(frame, odd_rows):
    shared = [sentence(12).capitalize() for _ in range(4)]
    rows = [(i, "\n".join([sentence(9), " " + RND.choice(shared).upper() + "\t" if i % 2 else RND.choice(shared),
                           "short", shared[0]])) for i in range(20, 60)]
    for data in (rows, odd_rows, rows + odd_rows, [(i, shared[0]) for i in range(300)], []):
        got = line_dedup.line_dedup(frame(data), 10, 3).collect()
        assert sorted((tuple(r) for r in got), key=repr) == lines_expected(data, 10, 3)


# --- tokens --------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", [WORD_VOCABULARY, BYTE_VOCABULARY])
def test_encoder_is_the_library(name, odd_rows):
    encoder = Encoder(vocabulary(name), cache=50)  # emptied all the time
    alphabet = "aB éÉ\n\t .,'s!1 9́Σςİ<|endoftext|>日\x1c\x85\xa0ª½"
    texts = ["".join(RND.choice(alphabet) for _ in range(RND.randint(0, 30))) for _ in range(1500)]
    texts += [t or "" for _, t in odd_rows] + ["It's we'll DON'T", " a", "a ", "a\n\nb", "a \nb", "\r\n", "ﬁ Å"]
    for text in texts:
        want = encoder.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, text[:80]


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 24, 31, 32])
def test_bit_packing_round_trip(bits):
    for n in (0, 1, 7, 8, 9, 5000):
        ids = np.random.default_rng(n).integers(0, 1 << bits, n).astype(np.uint64)
        packed = token_files.pack_bits(ids, bits)
        assert len(packed) == -(-n // 8) * bits
        assert token_files.unpack_bits(packed, bits, n).tolist() == ids.tolist()


def test_token_files(spark, frame, odd_rows):
    rows = odd_rows + [(i, sentence(i % 50)) for i in range(100, 300)]
    encoder = Encoder(vocabulary(WORD_VOCABULARY)).library
    files = token_files.write_token_files(frame(rows), vocabulary(WORD_VOCABULARY), image_ids=500)
    got = token_files.read_token_files(files).collect()
    ids = lambda t: encoder.encode(t or "", add_special_tokens=False).ids + [1]
    assert sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got), key=repr) == sorted(
        ((d, ids(t)) for d, t in rows), key=repr)
    start = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start
        start += len(r["ids"]) // 4
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    image = token_files.Image(files.orderBy("part", "file").first()["image"])
    every = image.read_ids(0, image.n_ids)
    assert image.read_ids(5, 40).tolist() == every[5:40].tolist()  # random access
    assert token_files.read_token_files(token_files.write_token_files(frame([]), vocabulary(WORD_VOCABULARY))).count() == 0


# --- near duplicates -----------------------------------------------------------------------------


def test_signatures_are_unbiased():
    rng = np.random.default_rng(3)
    x = np.sort(rng.integers(0, 2**63, 200).astype(np.uint64))
    a = rng.integers(1, 12, 200)
    b = np.where(rng.random(200) < 0.6, a, rng.integers(1, 40, 200))
    mark = bag_minhash.signatures(np.repeat([0, 1], 200), np.concatenate([x, x]), np.concatenate([a, b]), 2, 20_000)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((mark[0] == mark[1]).mean() - want) < 4 * math.sqrt(want * (1 - want) / 20_000)
    assert bag_minhash.overlap((x, a), (x, b)) == pytest.approx(want)


def classes_expected(rows):
    bags = []
    for _, t in rows:
        w = words_of((t or "").encode())
        n = min(5, len(w))
        bags.append(Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else Counter())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = sum((bags[i] & bags[j]).values())
            union = sum(bags[i].values()) + sum(bags[j].values()) - both
            alike = both >= 0.8 * union if union else (rows[i][1] or "") == (rows[j][1] or "")
            if alike:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    name = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((rows[i][0], name[find(i)]) for i in range(len(rows))), key=repr)


def edited(text, n):
    words = text.split(" ")
    for _ in range(n):
        words[RND.randrange(len(words))] = RND.choice(VOCABULARY)
    return " ".join(words)


def test_near_duplicates(frame, odd_rows):
    rows = [(i, sentence(60)) for i in range(20, 40)]
    base, chain = sentence(80), sentence(80)
    for i in range(100, 160):  # a large group on both sides of the threshold
        rows.append((i, edited(base, RND.randint(0, 6))))
    for i in range(200, 230):  # a chain that drifts away from its start
        chain = edited(chain, 1)
        rows.append((i, chain))
    rows += [(300 + i, rows[0][1]) for i in range(5)] + [(310, "a b " * 40), (311, "a b " * 45), (312, "a b " * 80)]
    for data in (rows + odd_rows, []):
        got = bag_minhash.near_duplicates(frame(data)).select("doc_id", "class_id").collect()
        assert sorted((tuple(r) for r in got), key=repr) == classes_expected(data)


def test_keep_one_of_each_class(frame):
    base = sentence(60)
    rows = [(3, base), (1, edited(base, 1)), (2, base), (2, base), (9, sentence(30)), (None, "nothing else")]
    df = frame(rows)
    got = bag_minhash.keep_one(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=repr) == sorted([1, 9, None], key=repr)


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(1, 200)] + [(500, 501), (501, 502), (7, 7)]
    RND.shuffle(edges)
    got = {r["node"]: r["root"] for r in bag_minhash.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 201)}, 500: 500, 501: 500, 502: 500}


# --- personal data -------------------------------------------------------------------------------


def base_expected(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    texts = ["a@b.com_c@d.org", "a@b@c.com", "@x.com@y.org", "a@b.c.d.e-f", "1.2.3.4.5.6.7.8", "256.1.1.1 1.256.1.1.1.1",
             "4111 1111-1111 1111", "+1 (017) 555-7713.", "+12345678901234567", "x@y", "00255.0.0.001", ""]
    alphabet = "a1.@+- ()0é%_9"
    texts += ["".join(RND.choice(alphabet) for _ in range(RND.randint(0, 40))) for _ in range(4000)]
    for text in texts:
        found = pii.base_spans(text)
        assert [(k, *s) for k in pii.KINDS for s in found[k]] == base_expected(text), text
    assert pii.base_spans("1" * 300_000 + "." + "a" * 300_000 + "@")["ip"] == []  # no quadratic scan


def test_further_spans(frame, odd_rows):
    rows = list(odd_rows)
    for i in range(200):
        phone = f"({RND.randint(200, 999)}) 555-{RND.randint(1000, 9999)}"
        rows += [(1000 + i, f"{sentence(5)} call +1 {phone} or mail me{i}@mail.example.com"),
                 (2000 + i, f"{sentence(5)} phone {phone}, {sentence(3)}"),
                 (3000 + i, f'{sentence(5)} token = "{hashlib.sha1(bytes([i])).hexdigest()}"')]
    df = frame(rows)
    got = pii.find(df, pii.train(df)).collect()
    spans = defaultdict(list)
    for r in got:
        spans[r["doc_id"]] += [(s["kind"], s["start"], s["end"], s["base"]) for s in r["spans"]]
    for d, t in rows:
        if d is not None and d >= 1000:
            assert [s[:3] for s in spans[d] if s[3]] == base_expected(t)
            assert [s[0] for s in spans[d] if not s[3]] == (["phone"] if 2000 <= d < 3000 else []), (t, spans[d])
    assert pii.find(frame([]), pii.train(frame([]))).count() == 0


# --- packing -------------------------------------------------------------------------------------


def test_first_fit_decreasing():
    for n in (0, 1, 2, 50, 300):
        sizes = [RND.randint(1, 64) for _ in range(n)]
        rooms, want = [], []
        for i in sorted(range(n), key=lambda i: (-sizes[i], i)):
            k = next((k for k, room in enumerate(rooms) if room >= sizes[i]), len(rooms))
            if k == len(rooms):
                rooms.append(64)
                want.append([])
            rooms[k] -= sizes[i]
            want[k].append(i)
        bins = packing.first_fit_decreasing(sizes, 64)
        assert bins == want
        closed = packing.close_gaps(bins, sizes, 64)
        assert len(closed) == -(-sum(sizes) // 64)
        cut = defaultdict(list)
        for b in closed:
            assert sum(x[2] for x in b) <= 64
            for i, start, length in b:
                cut[i].append((start, length))
        for i in range(n):
            at = 0
            for start, length in sorted(cut[i]):
                assert start == at and length > 0
                at += length
            assert at == sizes[i]


def test_packing(frame, odd_rows):
    rows = odd_rows + [(i, sentence(i % 90)) for i in range(100, 400)]
    library = Encoder(vocabulary(BYTE_VOCABULARY)).library
    got = packing.pack(frame(rows), vocabulary(BYTE_VOCABULARY), length=256, group_bytes=100_000).toPandas()
    whole = Counter(repr((d, len(library.encode(t or "", add_special_tokens=False).ids) + 1)) for d, t in rows)
    ids = defaultdict(list)
    for r in got.itertuples():
        assert len(r.ids) == 4 * r.length
        ids[None if r.doc_id != r.doc_id else int(r.doc_id), r.doc_tokens].append((r.start, r.ids))
    for (d, n), pieces in ids.items():  # repeated rows are packed each
        assert sum(len(x) // 4 for _, x in pieces) == n * whole[repr((d, n))]
    for d, t in rows:
        want = library.encode(t or "", add_special_tokens=False).ids + [1]
        pieces = sorted(ids[d, len(want)])
        if whole[repr((d, len(want)))] == 1:
            assert np.frombuffer(b"".join(x for _, x in pieces), "<u4").tolist() == want
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 256
    n = got.groupby("sequence_id").length.sum()
    assert (n < 256).sum() <= -(-sum(len((t or "").encode()) + 256 for _, t in rows) // 100_000)  # one open sequence a group
    assert packing.pack(frame([]), vocabulary(BYTE_VOCABULARY)).count() == 0


# --- quality -------------------------------------------------------------------------------------


def test_quality_rules(spark, frame, odd_rows):
    rows, labels = list(odd_rows), [(6, None), (None, 1), (10**9, 0)]
    for i in range(100, 900):
        good = i % 3 > 0
        text = sentence(40)
        rows.append((i, text if good else " ".join(w + RND.choice(["!!", "***", "$$$"]) for w in text.split(" "))))
        labels += [(i, int(good))]
    df, table = frame(rows), spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.learn(df, table, max_rows=300)
    held = lambda d: zlib.crc32(str(d).encode()) % 3 == 1
    got = {r["doc_id"]: r["score"] for r in quality.score(df, model).collect()}
    truth = dict(labels)
    test = [d for d in range(100, 900) if held(d)]
    assert np.mean([(got[d] >= 0.5) == truth[d] for d in test]) > 0.98
    x = np.array([quality.statistics_of((t or "").encode()) for _, t in rows])
    for (d, _), s in zip(rows, model.score(x)):  # the compiled column is the rule ensemble
        if d is not None and d != 7:
            assert got[d] == pytest.approx(s, abs=1e-12) and 0 <= s <= 1
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} >= {d for d in range(100, 900) if got[d] >= 0.5}
    none = quality.learn(df, table.limit(0))
    assert {r["score"] for r in quality.score(df, none).collect()} == {0.5}
    ones = quality.learn(df, table.where("quality = 1"))
    assert min(r["score"] for r in quality.score(df, ones).collect()) > 0.9
    assert quality.score(frame([]), model).count() == 0


def test_labels_of_the_held_out_fold_teach_nothing(spark, frame):
    rows = [(i, sentence(20) + ("!!!" if i % 2 else "")) for i in range(300)]
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1]
    table = spark.createDataFrame([(i, i % 2) for i in held], "doc_id long, quality int")
    assert quality.learn(frame(rows), table) == quality.RuleEnsemble()


# --- sharding ------------------------------------------------------------------------------------


def test_smallest_capacity():
    for n in (1, 2, 5, 9):
        for _ in range(40):
            sizes, shards = [RND.randint(1, 30) for _ in range(n)], RND.randint(1, 4)
            best = {}

            def least(i, k):
                if i == n:
                    return 0
                if not k:
                    return math.inf
                if (i, k) not in best:
                    best[i, k] = min(max(sum(sizes[i:j]), least(j, k - 1)) for j in range(i + 1, n + 1))
                return best[i, k]

            ends = sharding.smallest_cuts(sizes, shards)
            starts = [0, *ends[:-1]]
            assert ends[-1] == n and len(ends) == shards
            assert max(sum(sizes[a:b]) for a, b in zip(starts, ends)) == least(0, shards)


def test_sharding(frame, odd_rows):
    rows = odd_rows + [(i, sentence(i % 40)) for i in range(100, 600)] + [(1000 + i, "copy of one text") for i in range(200)]
    got = sharding.shard_by_size(frame(rows), 8).collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == sorted(
        ((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows), key=repr)
    slots, of_text = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        of_text[r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    assert all(len(s) == 1 for s in of_text.values())
    assert sharding.shard_by_size(frame([]), 8).count() == 0


# --- decontamination -----------------------------------------------------------------------------


def spans_expected(text, items, window):
    w = words_of((text or "").encode())
    hit, found = [0] * len(w), set()
    for name, item in items:
        if name is None or item is None:
            continue
        p = words_of(item.encode())
        n = min(window, len(p))
        windows = {tuple(p[i:i + n]) for i in range(len(p) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in windows:
                hit[i:i + n] = [1] * n
                found.add(str(name))
    return hit, sorted(found)


def test_suffix_array_and_index():
    rng = np.random.default_rng(2)
    for n in (1, 2, 30, 400):
        text = np.append(rng.integers(0, 4, n), 0)
        breaks = {p: i - len(text) for i, p in enumerate(np.flatnonzero(text == 0))}
        key = lambda i: [breaks.get(j, text[j]) for j in range(i, len(text))]  # noqa: E731, B023
        assert decontaminate.suffix_array(text).tolist() == sorted(range(len(text)), key=key)
        index = decontaminate.FMIndex(text, 4)
        for phrase in ([1], [2, 3], [1, 1, 2], [3, 3, 3, 3], [4]):
            padded = np.array([[0] * (5 - len(phrase)) + phrase])
            low, high = index.search(padded)
            at = sorted(index.locate(np.arange(low[0], high[0])).tolist())
            assert at == [i for i in range(len(text)) if text[i:i + len(phrase)].tolist() == phrase]


@pytest.mark.parametrize("options", [{}, {"shard_words": 40}, {"block_words": 60}])
def test_decontamination(spark, frame, odd_rows, options):
    items = [(i, sentence(14)) for i in range(12)] + [(50, "word " * 12), (51, sentence(4)), (52, ""), (None, sentence(12)),
                                                      (53, None), (54, "one"), (55, "!!")]
    rows = list(odd_rows)
    for i in range(100, 160):
        rows.append((i, " ".join([sentence(RND.randint(0, 30)), lower(RND.choice(items[:12])[1]).upper() if i % 3 else "",
                                  RND.choice(items[:12])[1][:60], sentence(9)])))
    df = frame(rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated_spans(df, bench, **options).collect()
    seen = []
    for r in got:
        hit = [0] * r["n_words"]
        for s in r["spans"]:
            hit[s["start"]:s["end"]] = [1] * (s["end"] - s["start"])
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
        seen.append((r["doc_id"], hit, list(r["items"])))
    assert sorted(seen, key=repr) == sorted(((d, *spans_expected(t, items, 10)) for d, t in rows), key=repr)
    clean = decontaminate.remove_spans(df, bench, **options)
    assert clean.columns == df.columns and clean.count() == len(rows)
    untouched = Counter((d, t) for d, t in rows if not any(spans_expected(t, items, 10)[0]))
    assert not untouched - Counter((r["doc_id"], r["text"]) for r in clean.collect())
    for r in clean.collect():
        n = sum(map(len, [words_of((r["text"] or "").encode())]))
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"])) and n >= 0
    nothing = decontaminate.contaminated_spans(df, bench.limit(0), **options)
    assert all(not r["spans"] and not r["items"] for r in nothing.collect())
    assert decontaminate.contaminated_spans(frame([]), bench, **options).count() == 0


def test_words_and_their_places_agree():
    for text in ["Ab-cd é1 日本x", "", "--", "a\x00b\x7fc", "ΣςİK"]:
        assert [lower(m[0]).encode() for m in decontaminate.WORDS.finditer(text)] == words_of(text.encode())


# --- language model ------------------------------------------------------------------------------


def test_interpolated_lm(spark, frame, odd_rows, tmp_path):
    rows = odd_rows + [(i, " ".join(RND.choice(VOCABULARY[:40]) for _ in range(i % 60)).replace("aa", "A"))
                       for i in range(100, 500)]
    frame(rows).repartition(4).write.parquet(f"{tmp_path}/d")
    df = spark.read.parquet(f"{tmp_path}/d")
    got = interpolated_lm.score(df).collect()
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lower(t or "")) + ["\0"]
    c, pair = Counter(), Counter()
    for d, t in rows:
        if not held(d):
            w = tokens(t)
            c.update(w)
            pair.update(zip(["\0", *w], w))
    n, v = sum(c.values()), len(c)
    base = lambda x: (c[x] + 0.1) / (n + 0.1 * (v + 1))
    table = interpolated_lm.token_counts(df, cell_bytes=2000)  # many cells
    weights = interpolated_lm.learn_weights(interpolated_lm.ratio_histogram(table))
    assert ((0 <= weights) & (weights < 1)).all() and weights.max() > 0.05
    want = []
    for d, t in rows:
        w = tokens(t)
        mixed = 0.0
        for a, b in zip(["\0", *w], w):
            k = float(weights[min(int(math.log2(c[a])), interpolated_lm.BUCKETS - 1)]) if c[a] else 0.0
            mixed += math.log10(k * pair[a, b] / max(c[a], 1) + (1 - k) * base(b))
        want.append((d, held(d), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10(base(x)) for x in w), 6),
                     round(mixed, 6)))
    rounded = [(*tuple(r)[:5], round(r["base_score"], 6), round(r["score"], 6)) for r in got]
    for a, b in zip(sorted(rounded, key=repr), sorted(want, key=repr)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-6, abs=1e-5)


def test_lm_learns_sequences(spark, frame, tmp_path):
    """On held-out text of a corpus with word order the mixture beats the base model."""
    chain = {w: RND.sample(VOCABULARY, 3) for w in VOCABULARY}
    rows = []
    for i in range(600):
        w = [RND.choice(VOCABULARY)]
        while len(w) < 30:
            w.append(RND.choice(chain[w[-1]]))
        rows.append((i, " ".join(w)))
    frame(rows).write.parquet(f"{tmp_path}/d")
    got = interpolated_lm.score(spark.read.parquet(f"{tmp_path}/d")).where("held_out").toPandas()
    assert len(got) > 20 and got.score.sum() > 0.6 * got.base_score.sum()


def test_lm_without_training_rows(spark, frame, tmp_path):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0]
    frame([(i, sentence(3)) for i in held]).write.parquet(f"{tmp_path}/d")
    for r in interpolated_lm.score(spark.read.parquet(f"{tmp_path}/d")).collect():
        assert (r["train_tokens"], r["n_known"], r["base_score"], r["score"]) == (0, 0, 0.0, 0.0)
    frame([]).write.parquet(f"{tmp_path}/e")
    assert interpolated_lm.score(spark.read.parquet(f"{tmp_path}/e")).count() == 0


# --- exact copies --------------------------------------------------------------------------------


@pytest.mark.parametrize("budget", [10**9, 200, 1])
def test_patricia_trie(budget):
    keys = ["".join(RND.choice("ab") for _ in range(RND.randint(0, 14))).encode() for _ in range(800)]
    keys += [b"common prefix " * 20 + bytes([i]) for i in range(100)] * 2
    RND.shuffle(keys)
    trie, want = exact_dedup.PatriciaTrie(budget), {}
    for i, key in enumerate(keys):
        owner = (RND.randint(0, 3), RND.choice([None, i % 50]), 1, key)
        trie.insert(key, owner)
        want[key] = exact_dedup.better(want[key], owner) if key in want else owner
    got = list(trie.items())
    assert len(got) == len(want) and dict(got) == want


def test_exact_dedup(frame, odd_rows):
    rows = odd_rows + [(i, RND.choice(["a b", "ab", " ab\n", "a  b", "abc"])) for i in range(100, 160)]
    reduced = lambda t: (t or "").translate({ord(c): None for c in SPACES})
    groups = defaultdict(list)
    for d, t in rows:
        groups[reduced(t)].append((-len(t or ""), d is None, d or 0, d))
    for budget in (1 << 26, 50):
        got = exact_dedup.exact_dedup(frame(rows), budget).collect()
        want = []
        for d, t in rows:
            best = min(groups[reduced(t)])
            want.append((d, best[3], len(groups[reduced(t)]), (-len(t or ""), d) == (best[0], best[3]),
                         hashlib.sha256(reduced(t).encode()).hexdigest()))
        assert sorted(((*tuple(r)[:4], bytes(r["hash"]).hex()) for r in got), key=repr) == sorted(want, key=repr)
    df = frame(rows)
    kept = exact_dedup.keep_owners(df)
    assert kept.columns == df.columns
    assert Counter(reduced(r["text"]) for r in kept.collect()) == Counter(groups.keys())
    assert exact_dedup.exact_dedup(frame([])).count() == 0 and exact_dedup.keep_owners(frame([])).count() == 0
