"""Personal data by weak supervision.

Candidates are the matches of fixed base patterns and of wider ones. Labelers of three sorts
(patterns, gazetteers, context) vote yes, no or nothing on each. The votes and the features of a
candidate are a small code; codes are counted over the whole corpus, expectation-maximisation
(two classes, one confusion table per labeler, per kind) estimates from the counts how reliable
each labeler is and how likely each vote pattern means personal data, and a logistic regression
on votes and features is trained on those likelihoods. Base matches are always spans; a wider
candidate is one if the classifier gives it at least `MIN_P`.

The number of codes depends on labelers and features only, so what the driver reads is bounded.
All searches are linear in the length of a text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gondola.sources.shared import materialize

KINDS = ("email", "ip", "card", "phone")
MIN_P = 0.9
ROUNDS = 50

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails at its first digit fails at all of them, hence the look-behind.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Wider candidates: grouped digits, and addresses whose signs are spelled out.
_GROUPED = re.compile(r"(?<![0-9A-Za-z+.,/=_-])\(?[0-9][0-9()./\x20-]{8,30}[0-9](?![0-9A-Za-z])")
_AT = re.compile(r"\s?[\[({]\s?(?:at|AT|@)\s?[\])}]\s?")
_DOT = re.compile(r"\s?(?:\.|[\[({]\s?(?:dot|DOT|\.)\s?[\])}])\s?")
_NAME = re.compile(r"[A-Za-z0-9-]+")
_DIGIT = re.compile("[0-9]")

# Gazetteers and cues.
TLDS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au ch at be pt br mx ar jp cn in".split())
CARD_PREFIX = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35")
CUES = {
    "email": "mail email e-mail contact write correo courriel".split(),
    "ip": "ip host server address addr client login".split(),
    "card": "card visa mastercard credit debit tarjeta carte karte".split(),
    "phone": "phone tel telephone mobile cell call fax whatsapp telefon teléfono téléphone".split(),
}
AGAINST = frozenset(
    "version isbn issn order invoice id ref serial token password key hash sha md5 page pages "
    "section chapter release build score".split()
)
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' leftmost matches that pass their test."""
    spans = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            spans.append((start, 0, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) < 4 and int(p) < 256 or int(p.lstrip("0")[:4] or 0) < 256 for p in m[0].split(".")):
                spans.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if 14 <= len(m[0]):
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    spans.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def wider_spans(text: str) -> list[tuple[int, int, int]]:
    spans = []
    for m in _AT.finditer(text) if ("at" in text or "AT" in text) else ():
        start = m.start()
        while start and text[start - 1] in _LOCAL and m.start() - start < 64:
            start -= 1
        end, dots = _NAME.match(text, m.end()), 0
        while end and (dot := _DOT.match(text, end.end())) and (more := _NAME.match(text, dot.end())):
            end, dots = more, dots + 1
        if start < m.start() and end and dots:
            spans.append((start, 0, end.end()))
    if _DIGIT.search(text):
        for m in _GROUPED.finditer(text):
            digits = "".join(filter(str.isdigit, m[0]))
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
            elif 10 <= len(digits) <= 12 and len(digits) < len(m[0]):
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


YES, NO, NONE = 1, 2, 0


def votes(kind: int, text: str, start: int, end: int, base: bool) -> list[int]:
    """Labelers: base pattern, usual grouping, gazetteer, cue words before, words against."""
    span = text[start:end]
    digits = "".join(filter(str.isdigit, span))
    before = [w.lower() for w in _WORD.findall(text[max(0, start - 40) : start])][-4:]
    if kind == 0:
        grouping = YES if re.fullmatch(r"[A-Za-z][\w.%+-]*@[\w.-]+\.[A-Za-z]{2,}", span) else NONE
        gazetteer = YES if re.split(r"[^A-Za-z]+", span)[-1].lower() in TLDS else NO
    elif kind == 1:
        grouping = YES if all(len(p) <= 3 and (p == "0" or p[0] != "0") for p in span.split(".")) else NO
        gazetteer = NO if digits[:1] == "0" or span.startswith("255.") else YES
    elif kind == 2:
        grouping = YES if re.fullmatch(r"\d{16}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}[ -]\d{6}[ -]\d{5}", span) else NONE
        gazetteer = YES if CARD_PREFIX.match(digits) else NO
    else:
        grouping = YES if re.search(r"\(?\d{2,4}\)?[ .-]\d{3,4}[ .-]\d{3,4}$", span) else NO
        gazetteer = NO if re.search(r"[12][09]\d\d[./-][01]?\d[./-][0-3]?\d|\d/\d", span) else NONE
    return [
        YES if base else NO,
        grouping,
        gazetteer,
        YES if any(w in CUES[KINDS[kind]] for w in before) else NONE,
        NO if any(w in AGAINST for w in before) else NONE,
    ]


def features(text: str, start: int, end: int) -> list[bool]:
    left, right = text[start - 1 : start], text[end : end + 1]
    return [
        not left or left.isspace(), not right or right.isspace() or right in ".,;:!?)",
        end - start > 12, end - start > 20,
    ]


def code(kind: int, cast: list[int], seen: list[bool]) -> int:
    n = kind
    for v in cast:
        n = n * 3 + v
    for f in seen:
        n = n * 2 + f
    return n


N_VOTES, N_FEATURES = 5, 4


def decode(n: int) -> tuple[int, list[int], list[int]]:
    seen, cast = [], []
    for _ in range(N_FEATURES):
        n, f = divmod(n, 2)
        seen.append(f)
    for _ in range(N_VOTES):
        n, v = divmod(n, 3)
        cast.append(v)
    return n, cast[::-1], seen[::-1]


def candidates(text: str | None) -> list[dict]:
    """All base spans, and the wider ones that overlap no base span and no earlier wider one,
    by start and kind."""
    text = text or ""
    base = base_spans(text)
    found = [(s, k, e, True) for s, k, e in base]
    ends = sorted((s, e) for s, _, e in base)
    free = 0
    for s, k, e in wider_spans(text):
        at = bisect_left(ends, (e, 0))
        if s >= free and all(b <= s for _, b in ends[:at]):
            found.append((s, k, e, False))
            free = e
    return [
        {"kind": k, "start": s, "end": e, "base": b, "code": code(k, votes(k, text, s, e, b), features(text, s, e))}
        for s, k, e, b in sorted(found)
    ]


@dataclass
class Model:
    """reliability: kind, labeler -> P(vote | class) as rows clean, personal and columns none,
    yes, no. accepted: the codes of wider candidates that are personal data."""

    reliability: np.ndarray
    weights: np.ndarray
    probability: dict[int, float]

    @property
    def accepted(self) -> list[int]:
        return sorted(c for c, p in self.probability.items() if p >= MIN_P)


def _design(codes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kinds, cast, seen = (np.array(x) for x in zip(*map(decode, codes)))
    columns = [np.ones(len(codes)), *(kinds == k for k in range(1, len(KINDS)))]
    columns += [cast[:, j] == v for j in range(N_VOTES) for v in (YES, NO)]
    columns += [seen[:, j] for j in range(N_FEATURES)]
    return kinds, cast, np.array(columns, float).T


def fit(counts: dict[int, int]) -> Model:
    """Reliabilities by expectation-maximisation and a logistic regression on its results."""
    reliability = np.full((len(KINDS), N_VOTES, 2, 3), 1 / 3)
    if not counts:
        return Model(reliability, np.zeros(0), {})
    codes = sorted(counts)
    n = np.array([counts[c] for c in codes], float)
    kinds, cast, x = _design(codes)
    likely = np.full(len(codes), 0.5)
    for k in range(len(KINDS)):
        at = np.flatnonzero(kinds == k)
        if not len(at):
            continue
        yes, no = (cast[at] == YES).sum(axis=1), (cast[at] == NO).sum(axis=1)
        p = (yes + 0.5) / (yes + no + 1)  # a vote of equals begins
        for _ in range(ROUNDS):
            share = ((p * n[at]).sum() + 1) / (n[at].sum() + 2)
            for j in range(N_VOTES):
                for side, weight in ((1, p), (0, 1 - p)):
                    table = np.array([(weight * n[at] * (cast[at, j] == v)).sum() for v in (NONE, YES, NO)]) + 1
                    reliability[k, j, side] = table / table.sum()
            odds = np.log(share / (1 - share)) + sum(
                np.log(reliability[k, j, 1, cast[at, j]] / reliability[k, j, 0, cast[at, j]]) for j in range(N_VOTES)
            )
            p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        likely[at] = p
    weights = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps with a little shrinkage
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (n * (likely - p)) - weights
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1])
        weights = weights + np.linalg.solve(hessian, gradient)
    p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
    return Model(reliability, weights, dict(zip(codes, p.tolist())))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, candidates) of every row, in order of start and kind; a null or empty text has
    none."""
    schema = "doc_id long, candidates array<struct<kind: int, start: long, end: long, base: boolean, code: int>>"
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("code", pa.int32())]))

    def run(frames):
        for frame in frames:
            found = [candidates(t.as_py()) for t in frame.column(1)]
            yield pa.RecordBatch.from_arrays(
                [frame.column(0), pa.array(found, kind)], names=["doc_id", "candidates"]
            )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, schema)


def train(found: DataFrame) -> Model:
    """A model from the candidates of the whole corpus (an action)."""
    counts = found.select(F.explode("candidates.code").alias("code")).groupBy("code").count().collect()
    return fit({r["code"]: r["count"] for r in counts})


def detect(docs: DataFrame) -> tuple[DataFrame, Model]:
    """The rows (doc_id, spans as array of kind, start, end, base) and the model behind them.

    Positions are code points, ends exclusive. Repeated rows are judged each, a null doc_id
    stays null, an empty table gives no rows. An action: candidates are written to the shared
    folder and counted."""
    found = materialize(find(docs), "pii-candidates")
    model = train(found)
    accepted = F.array(*map(F.lit, model.accepted)) if model.accepted else F.array().cast("array<int>")
    spans = F.filter("candidates", lambda c: c["base"] | F.array_contains(accepted, c["code"]))
    return found.select("doc_id", spans.alias("spans")), model


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )
