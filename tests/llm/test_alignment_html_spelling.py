"""Operators 11 to 13: the registered queries against brute force on whole tables, and odd rows."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment, html_text, spelling
from tidemark.llm.queries import BYTE_VOCABULARY, PIECE_MODEL, QUERIES, vocabulary

from conftest import SF_SMALL
from llm_fixtures import frame, odd_rows  # noqa: F401


def documents():
    import pyarrow.parquet as pq

    t = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))


# --- alignment -----------------------------------------------------------------------------------


def alignment_expected(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(vocabulary(BYTE_VOCABULARY))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_MODEL))
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    b_bytes = lambda p: bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
    found, counts = [], Counter()
    for doc, text in rows:
        text = text or ""
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        a_parts = [bytes(byte_of[c] for c in a_model.id_to_token(i)) for i in a]
        b_parts = [b_bytes(b_model.id_to_piece(i)) for i in b]
        if b"".join(a_parts) != (" " + text).encode() or b"".join(b_parts) != (" " + text).encode():
            a, b, a_parts, b_parts = [], [], [], []
        a_ends, b_ends = (np.cumsum([len(x) for x in parts]).tolist() if parts else [] for parts in (a_parts, b_parts))
        links, groups, j, group_a, group_b = [], [], 0, [], []
        for i, end in enumerate(a_ends):
            start = end - len(a_parts[i])
            while b_ends[j] <= start:
                j += 1
            k = j
            while k < len(b) and b_ends[k] - len(b_parts[k]) < end:
                links.append((a[i], b[k]))
                k += 1
        at = 0
        for i, end in enumerate(a_ends):
            group_a.append(str(a[i]))
            while at < len(b) and b_ends[at] <= end:
                group_b.append(str(b[at]))
                at += 1
            if at and b_ends[at - 1] == end:
                groups.append(",".join(group_a) + "|" + ",".join(group_b))
                group_a, group_b = [], []
        counts.update(links)
        found.append((doc, len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(((doc, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
                   for doc, n_a, n_b, groups, links in found), key=repr)


def test_alignment_query(spark):
    got = QUERIES["op11_token_alignment"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == alignment_expected(documents())


def test_alignment_odd_rows(frame, odd_rows):
    texts = ["<|endoftext|> and <s> </s> <unk>", "a▁b", " leading", "trailing  ", "\n\n  \n", "é ﬁ ½", "\x00 \x7f",
             "😀👩‍👩‍👧 日本語 ΣΑΣ", "  ", "\r\n\t x", "supercalifragilistic" * 40, "ÿ" * 3000, "﻿​"]
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(texts * 2)]
    for data, pairs in ((rows, 10**6), (rows, 0), ([], 0)):  # all counts to all tasks, or to the cells that ask
        got = alignment.align(frame(data), vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_MODEL), 5000, pairs)
        assert sorted(map(tuple, got.collect()), key=repr) == alignment_expected(data)


def test_alignment_passes_a_string_id_on(spark):
    df = spark.createDataFrame([("x", "some text", 1), (None, None, 2)], "doc_id string, text string, cell int")
    got = alignment.align(df, vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_MODEL)).collect()
    assert sorted((r["doc_id"] or "", r["n_a"] > 0) for r in got) == [("", False), ("x", True)]


def test_fast_ids_are_the_librarys():
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    a, library = alignment.ByteTokens(vocabulary(BYTE_VOCABULARY)), Tokenizer.from_file(vocabulary(BYTE_VOCABULARY))
    library.encode_special_tokens = True
    assert a.fast is not None
    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist() if t]
    rnd = random.Random(4)
    odd = [chr(c) for c in (*range(0x250), *range(0x2010, 0x2027))] + ["  ", "\n\n", "'s", "'re", "ing", "12", "の", "\u3000", "\u200b"]
    texts += ["".join(rnd.choice(odd) for _ in range(40)) for _ in range(4000)]
    assert sum(alignment._LATIN.fullmatch(t) is not None for t in texts) > 2500
    for t in texts:
        assert a.encode(t).tolist() == library.encode(" " + t, add_special_tokens=False).ids


def test_gallop():
    rnd = np.random.default_rng(1)
    for n, m, high in [(0, 5, 9), (5, 0, 9), (1, 1, 3), (31, 400, 500), (32, 32, 40), (33, 4000, 10**6), (1000, 70, 2000),
                       (5000, 5000, 6000)]:
        a, b = (np.sort(rnd.choice(high, min(x, high), replace=False)) for x in (n, m))
        assert (alignment.gallop(a, b) == np.searchsorted(b, a, "left")).all()
    a = np.arange(100_000)  # one long way, then short ones
    assert (alignment.gallop(np.array([5, 99_990, 99_991]), a) == [5, 99_990, 99_991]).all()


def test_cells_are_bounded_and_requests_grow_with_the_input(frame):
    rows = [(i, "hot pair " * 200) for i in range(300)]
    cells = alignment.token_cells(frame(rows), vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_MODEL), cell_bytes=20_000)
    of_cell = cells.groupBy("cell").agg(F.count("*").alias("n")).collect()
    assert max(r["n"] for r in of_cell) <= 20_000 // 1800 + 1
    requests = alignment.pair_requests(cells)
    assert requests.count() <= 3 * len(of_cell) * requests.select("pair").distinct().count()


# --- pages ---------------------------------------------------------------------------------------


def test_pages_query(spark):
    """The tables' articles are plain: heading and paragraphs inside one element."""
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    want = {}
    for r in pages:
        article = r["html"].split("<article>")[1].split("</article>")[0].replace("<br>", "\n")
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        want[r["page_id"]] = (r["url"], "\n".join(x for x in blocks if x))
    got = QUERIES["op12_main_text"](spark, SF_SMALL).collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in got} == want and len(got) == len(pages)
    assert all(r["n_chars"] == len(r["text"]) for r in got)


BODY = ("<p>The first paragraph, with commas, tells what happened, and to whom.</p>"
        "<p>The second one goes on, at some length, about the rest of it.</p>")
TEXT = ("The first paragraph, with commas, tells what happened, and to whom.\n"
        "The second one goes on, at some length, about the rest of it.")
LONG = "many, many, words, of, no, interest, " * 5

@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("   \n ", ""), ("just text", "just text"), ("<p>short", "short"),
    ("<script>var a = '<p>x</p>';</script><style>p{}</style>", ""),
    (f"<body><article><h1>Title</h1>{BODY}</article></body>", "Title\n" + TEXT),
    (f"<div id=main><div class=post><h2>Title</h2>{BODY}</div></div><div class=sidebar><p>{LONG}</p></div>", "Title\n" + TEXT),
    (f"<header><h1>Site</h1><p>{LONG}</p></header><main>{BODY}</main><footer><p>{LONG}</p></footer>", TEXT),
    (f"<article><header><h1>Title</h1><p>By someone</p></header>{BODY}<footer>Filed under x</footer></article>", "Title\n" + TEXT),
    (f"<article>{BODY}<section id=comments><article class=comment><p>{LONG}</p></article></section></article>", TEXT),
    (f"<article>{BODY}</article><div class='comments-area'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>", TEXT),
    (f"<article><div class=cookie-notice><p>{LONG}</p></div>{BODY}<aside>{LONG}</aside></article>", TEXT),
    (f"<article>{BODY}<form><p>{LONG}</p><input><button>Send</button></form></article>", TEXT),
    (f"<form id=aspnet><div role=navigation><p>{LONG}</p></div><div>{BODY}</div></form>", TEXT),
    (f"<div class='ad'><p>{LONG}</p></div><div class='has-sidebar'>{BODY}</div><div id='adBox'>{LONG}</div>", TEXT),
    (f"<div class=popup>{BODY}</div>", TEXT),  # all is ruled out: names count for nothing
    (f"<div>{BODY}</div><div><a href=a>one link, of many</a> <a href=b>another link, too</a></div>", TEXT),
    (f"<article><section>{BODY}</section><section><h2>More</h2><p>A few, last words.</p></section></article>",
     TEXT + "\nMore\nA few, last words."),
    ("<article><p>a&amp;b &lt;i&gt; &eacute;&#233;&#x41;&nbsp; c\n\t d &bogus; &amp;amp;</p></article>", "a&b <i> ééA c d &bogus; &amp;"),
    ("<article><p>one<b>two</b> <i>three</i>four<br>five<br><br>six</article>", "onetwo threefour five\nsix"),
    ("<article><p>open <b>bold<p>next</b> para</article>", "open bold\nnext para"),
    ("<article><ul><li>one<li>two<ul><li>in</ul></ul><table><tr><td>a<td>b<tr><td>c</table></article>", "one\ntwo\nin\na\nb\nc"),
    ("<article><p>1 < 2 and 3 <4</p><!-- <p>no</p> --><p title='a > b'>yes</p><p x=\"unclosed>last</p></article>",
     "1 < 2 and 3 <4\nyes\nlast"),
    ("<article><p>seen</p><!-- never closed <p>unseen</p>", "seen"),
    ("<article><p>seen</p><script>never closed <p>unseen</p>", "seen"),
    ("<ARTICLE><P CLASS=x>Upper</P><p hidden>no</p><p style='display: none'>no</p></ARTICLE>", "Upper"),
])
def test_main_text(page, want):
    assert html_text.main_text(page) == want


def test_pages_odd_rows(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (None, None, None), (2, None, "")]
    schema = "page_id long, url string, html string"
    clash = lambda df: df.select("*", *[F.lit(7).alias(c) for c in ("text", "n_chars", "doc_id", "tag")])
    got = html_text.extract(clash(spark.createDataFrame(rows, schema))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (2, None, "", 0)], key=repr)
    assert html_text.extract(clash(spark.createDataFrame([], schema))).collect() == []
    named = spark.createDataFrame([("p1", 5, "<p>a</p>")], "page_id string, url int, html string")
    assert tuple(html_text.extract(named).first()) == ("p1", 5, "a", 1)


@pytest.mark.parametrize("piece", ["<p>", "<div>", "<ul><li>", "<!--", "<script>", '<a href="', "< ", "<td><tr>", "<a href=x>t",
                                   "</div>", "<a b='", '<c d="e>', "&", "<p class=a-b>"])
def test_pages_take_linear_time(piece):
    began = time.perf_counter()
    html_text.main_text(piece * 60_000 + "</section>" * 1000)
    assert time.perf_counter() - began < 5


# --- spelling ------------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling_expected(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    holes = defaultdict(set)  # near words share a word with one letter cut out
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for cut, group in holes.items():
        group = group | ({cut} if cut in words else set())
        for w in group:
            near[w] |= {x for x in group if x != w and x not in near[w] and one_edit(w, x)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], words[form[w]] if form[w] else None, root))
    return sorted(out)


def test_spelling_query(spark):
    got = QUERIES["op13_spelling_variants"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == spelling_expected(documents())


def test_spelling_blocks_and_chains(frame, odd_rows):
    """Tiny blocks, so that every group of words is cut; forms of forms; ties; anagrams; a hot word."""
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abcé") for _ in range(8)) for _ in range(60)]
    words = base + [w[:3] + rnd.choice("abcÿ") + w[3 + rnd.randint(0, 1):] for w in base for _ in range(4)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(40))) for i in range(150)]
    chain = {"alphabet": 3000, "alphabat": 250, "alphobat": 22, "olphobat": 2}
    clean = next(d for d in range(500, 600) if all(zlib.crc32(f"{d}:{w}".encode()) % 31 for w in chain))
    rows += [(clean, " ".join(f"{w} " * n for w, n in chain.items())), (601, "Àlphabet ÀLPHABET àlphabet ×÷×÷×÷×")]
    rows += [(602, ("q" * 9000 + " " + "q" * 9001 + " " + "q" * 8999 + "z ") * 3)]
    for data in (rows + odd_rows, rows + rows, []):
        got = spelling.variant_groups(frame(data), block_bytes=200).collect()
        assert sorted(map(tuple, got)) == spelling_expected(data)
    assert {w: r for w, _, _, _, _, r in spelling_expected(rows)}["olphobat"] == "alphabet"


def test_near_pairs():
    rnd = random.Random(8)
    for length in (1, 2, 5):
        a = sorted({"".join(rnd.choice("abÿ") for _ in range(length)) for _ in range(40)})
        b = sorted({"".join(rnd.choice("abÿ") for _ in range(length + 1)) for _ in range(40)})
        for x, y, same in ((a, b, False), (a, a, True)):
            i, j = spelling.near_pairs(x, y, same)
            want = {(p, q) for p in range(len(x)) for q in range(len(y)) if one_edit(x[p], y[q]) and (not same or p < q)}
            assert len(i) == len(want) and set(zip(i.tolist(), j.tolist())) == want
