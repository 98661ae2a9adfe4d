"""Personal data by weak supervision.

Patterns propose spans (base ones by the strict patterns of the data contract,
further ones by looser patterns), and labelers vote on each: pattern strictness,
a gazetteer (domain endings, card issuers, country codes, address ranges), words of context,
shape and boundary. Expectation-maximisation over the counts of vote
combinations estimates how reliable each labeler is for each kind and how likely each
combination is personal data; a logistic span classifier is trained on those
soft labels over votes and span features. It decides on the further spans; base
ones always stay.

Both fits see one aggregate over all documents: the count of each (kind, votes,
features) combination, at most 4 x 3**5 x 150 rows whatever the input. Documents
are read twice, map-only; candidates are never shuffled.

Edge cases: a null or empty text has no spans. Texts are scanned in full, in linear time per
pattern. Repeated rows are answered each. Without candidates nothing is learned and base spans
alone come out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, slices, text_of

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "gazetteer", "context", "shape", "boundary")

# The strict patterns. A local part is what stands before a domain, so it is read backwards.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# looser ones, for the method's own spans
_LOOSE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}"
                          r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]{1,63}){1,8}")
_LOOSE_IP = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_LOOSE_PHONE = re.compile(r"(?<![0-9])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")

# Gazetteers and context words.
_ENDINGS = frozenset("com org net edu gov info io de fr es it uk eu us ca ch at be nl".split())
_COUNTRIES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47",
              "48", "49", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86",
              "90", "91", "92", "351", "352", "353", "354", "358", "420", "421", "972")
_ISSUERS = ("34", "37", "36", "38", "4", "51", "52", "53", "54", "55", "2", "60", "62", "64", "65")
_CONTEXT = {
    "email": re.compile(r"e-?mail|mail|contact|correo|courriel|kontakt|write", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|adresse|login", re.I),
    "card": re.compile(r"card|visa|karte|carte|tarjeta|credit|payment|iban", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax|telefon|tél|teléfono|appel|ruf", re.I)}
_AGAINST = re.compile(r"version|isbn|order|token|hash|serial|build|sha|=\s*\"?$", re.I)

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _local_start(text: str, end: int, at: int) -> int:
    """Where the local part before place ``at`` begins, not before ``end``; takes time by its own length."""
    width = 64
    while True:
        begin = max(end, at - width)
        start = begin + len(text[begin:at].rstrip(_LOCAL))
        if start > begin or begin == end:
            return start
        width *= 2


def base_spans(text: str) -> dict[str, list[Span]]:
    """The strict spans of each kind, leftmost and non-overlapping."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        end = 0
        for m in _DOMAIN.finditer(text):
            start = _local_start(text, end, m.start())
            if start < m.start():
                out["email"].append((start, m.end()))
                end = m.end()
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out["ip"].append(m.span())
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                out["phone"].append(m.span())
    return out


def loose_spans(text: str, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Further candidates; none overlaps a base span or another candidate."""
    found: list[tuple[int, int, str]] = []
    if "at)" in text or "at]" in text:
        found += [(*m.span(), "email") for m in _LOOSE_EMAIL.finditer(text)]
    if _DIGIT.search(text):
        if ":" in text:
            found += [(*m.span(), "ip") for m in _LOOSE_IP.finditer(text)]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19:
                found.append((*m.span(), "card"))
        found += [(*m.span(), "phone") for m in _LOOSE_PHONE.finditer(text)]
    taken = sorted(s for spans in base.values() for s in spans)
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    end = k = 0
    for start, stop, kind in sorted(found):
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if start >= end and (k == len(taken) or taken[k][0] >= stop):
            out[kind].append((start, stop))
            end = stop
    return out


def _side(c: str) -> int:
    """0: edge, 1: space, 2: letter, 3: digit, 4: other."""
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def votes(text: str, kind: str, span: Span, strict: bool) -> tuple[int, ...]:
    """Votes of LABELERS (1: personal, -1: not, 0: none), then span features: left, right, size."""
    start, end = span
    found = text[start:end]
    digits = "".join(c for c in found if "0" <= c <= "9")
    before, left, right = text[max(0, start - 40):start], text[start - 1:start], text[end:end + 1]
    if kind == "email":
        known = found.rstrip(")]").rpartition(".")[2].lower() in _ENDINGS
        shape = len(found) <= 254 and ".." not in found
    elif kind == "ip":
        first = digits and found.split(".")[0].lstrip("0")
        known = ":" in found or bool(first) and 1 <= int(first) <= 223 and first != "127"
        shape = ":" in found or all(p == "0" or p[:1] != "0" for p in found.split("."))
    elif kind == "card":
        known = digits.startswith(_ISSUERS)
        shape = luhn(digits) and len(re.findall(r"[\x20-]", found)) in (0, 2, 3, 4)
    else:
        known = digits.startswith(_COUNTRIES) if found[:1] == "+" else len(digits) == 10 and digits[0] not in "01"
        shape = found.count("(") == found.count(")") and not re.search(r"[.\x20-]{2,}", found)
    context = 1 if _CONTEXT[kind].search(before) else -1 if _AGAINST.search(before) else 0
    whole = not ((left.isalnum() or left in "_.") and left) and not (right.isalnum() and right)
    sides = (_side(left), _side(right), min(5, len(digits) // 4))
    pattern = 1 if strict else -1 if kind == "card" and not luhn(digits) else 0
    return (pattern, 1 if known else -1, context, 1 if shape else -1, 1 if whole else -1, *sides)


def estimate(table: dict[tuple, int], rounds: int = 50) -> tuple[dict[tuple, float], dict[str, dict[str, float]]]:
    """EM over (kind, votes) counts: P(personal) of each combination, and each labeler's accuracy by kind."""
    posterior, accuracy = {}, {}
    for kind in KINDS:
        rows = [(v, n) for (k, *v), n in table.items() if k == kind]
        if not rows:
            continue
        vote, n = np.array([v for v, _ in rows]), np.array([float(c) for _, c in rows])
        prior, right = 0.5, np.full(vote.shape[1], 0.8)
        for _ in range(rounds):
            yes = np.log(prior) + (np.where(vote == 1, np.log(right), 0) + np.where(vote == -1, np.log(1 - right), 0)).sum(1)
            no = np.log(1 - prior) + (np.where(vote == -1, np.log(right), 0) + np.where(vote == 1, np.log(1 - right), 0)).sum(1)
            p = 1 / (1 + np.exp(no - yes))
            # one span of doubt each way keeps rates off 0 and 1; a labeler is never worse than a coin
            prior = float(np.clip((n @ p + 1) / (n.sum() + 2), 0.01, 0.99))
            hit = (n[:, None] * ((vote == 1) * p[:, None] + (vote == -1) * (1 - p[:, None]))).sum(0)
            right = np.clip((hit + 4) / ((n[:, None] * (vote != 0)).sum(0) + 5), 0.5, 0.99)
        posterior |= {(kind, *v): float(x) for (v, _), x in zip(rows, p)}
        accuracy[kind] = dict(zip(LABELERS, right.tolist()))
    return posterior, accuracy


def _features(rows: list[tuple]) -> np.ndarray:
    """One-hot votes and span features, and a constant."""
    x = np.array(rows)
    parts = [np.ones((len(x), 1))]
    parts += [x[:, [i]] == v for i in range(5) for v in (1, -1)]
    parts += [x[:, [i]] == v for i, most in ((5, 5), (6, 5), (7, 6)) for v in range(most)]
    return np.concatenate(parts, 1).astype(float)


class SpanClassifier:
    """A logistic classifier of each kind over votes and span features."""

    def __init__(self, table: dict[tuple, int]):
        votes_only: Counter = Counter()
        for (kind, *row), n in table.items():
            votes_only[(kind, *row[:5])] += n
        posterior, self.accuracy = estimate(votes_only)
        self.weights = {}
        for kind in KINDS:
            rows = [(tuple(r), n) for (k, *r), n in table.items() if k == kind]
            if not rows:
                continue
            x, n = _features([r for r, _ in rows]), np.array([float(c) for _, c in rows])
            y, beta = np.array([posterior[(kind, *r[:5])] for r, _ in rows]), np.zeros(x.shape[1])
            for _ in range(30):  # Newton with a small ridge
                p = 1 / (1 + np.exp(-(x @ beta)))
                hessian = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1])
                beta = beta + np.linalg.solve(hessian, x.T @ (n * (y - p)) - beta)
            self.weights[kind] = beta

    def probability(self, kind: str, row: tuple[int, ...]) -> float:
        if kind not in self.weights:
            return 0.0
        return float(1 / (1 + np.exp(-(_features([row]) @ self.weights[kind])[0])))


def _candidates(text: str) -> Iterator[tuple[str, Span, bool]]:
    base = base_spans(text)
    for strict, spans in ((True, base), (False, loose_spans(text, base))):
        for kind in KINDS:
            for span in spans[kind]:
                yield kind, span, strict


def train(docs: DataFrame) -> SpanClassifier:
    """EM and the classifier, from the counts of all documents' candidates."""
    schema = pa.schema([("kind", pa.string()), ("row", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        found: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                for kind, span, strict in _candidates(text):
                    found[kind, ",".join(map(str, votes(text, kind, span, strict)))] += 1
        for (kind, row), n in found.items():
            yield kind, row, n

    rows = (text_of(docs).select("text").mapInArrow(lambda b: batches_of(count(b), schema), "kind string, row string, n long")
            .groupBy("kind", "row").agg(F.sum("n").alias("n")).orderBy("kind", "row").collect())
    return SpanClassifier({(r["kind"], *map(int, r["row"].split(","))): r["n"] for r in rows})


def find(docs: DataFrame, model: SpanClassifier, threshold: float = 0.5) -> DataFrame:
    """Per row: doc_id, spans (kind, start, end, base), by kind as in KINDS, then start; code points."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        known: dict[tuple, bool] = {}
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out = []
                for kind, (start, end), strict in _candidates(text):
                    if not strict:
                        row = (kind, *votes(text, kind, (start, end), False))
                        if row not in known:
                            known[row] = shared.value.probability(kind, row[1:]) >= threshold
                        if not known[row]:
                            continue
                    out.append((KINDS.index(kind), start, end, strict))
                yield doc_id, [{"kind": KINDS[k], "start": a, "end": b, "base": s} for k, a, b, s in sorted(out)]

    return text_of(docs).mapInArrow(lambda b: batches_of(run(b), schema),
                                    "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")
