"""Personal data by weak supervision.

Strict patterns give base spans, which always stay. Looser patterns give further candidates; labelers
(strict patterns, gazetteers, context words, and rules that speak against) vote on every candidate, base
ones included, or abstain. Expectation-maximisation over all candidates of the table estimates how
reliable each labeler is, without any hand label. The resulting probabilities train the final span
classifier, a logistic regression over the shape and surroundings of a span. Votes against a candidate
lower its log-odds by what EM found them to be worth, none of them is a veto; the candidates that are
still accepted are added to the base spans.

Votes and features are discrete, so the whole table is summed up by groupBy into one row per distinct
combination; their number is bounded by the definition of the features, not by the data.
"""

from __future__ import annotations

import hashlib
import re
import string
from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "name")
BASE_KINDS = KINDS[:4]
# The base rules.
# An address is found from its @ outwards, and no search begins inside a run of its first characters, so
# that long runs take linear time; the matches are those of the plain patterns.
LOCAL = string.ascii_letters + string.digits + "._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser candidates.
HIDDEN_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+ ?[\[({] ?(?:at|AT) ?[\])}] ?[A-Za-z0-9-]+(?: ?(?:\.|[\[({] ?(?:dot|DOT) ?[\])}]) ?[A-Za-z0-9-]+)+")
LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z+.,-])(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[\x20./-]+[0-9]{2,5}){1,5}(?![0-9A-Za-z]|[.,-][0-9])")
NAME = re.compile(r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.? ([A-ZÄÖÜÉ][a-zäöüßéèêçñáíóú]+(?: [A-ZÄÖÜÉ][a-zäöüßéèêçñáíóú]+)?)")
DIGIT = re.compile(r"[0-9]")

#: Context words by kind, in four languages; stems are enough.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "kontakt", "courriel", "correo", "write to", "schreib"),
    "ip": ("ip", "host", "server", "addr", "ping", "login", "client"),
    "card": ("card", "visa", "master", "amex", "credit", "karte", "carte", "tarjeta", "payment", "pay"),
    "phone": ("phone", "tel", "call", "mobile", "cell", "fax", "whatsapp", "anruf", "handy", "appel", "llam", "móvil"),
    "name": ("name", "called", "dear", "sincerely", "heißt", "appelle", "llama", "born", "lives"),
}
#: Whole words; the German ones with all that their compounds go on with.
AGAINST = re.compile(
    r"(?<!\w)(?:orders?|isbn|versions?|invoices?|serial|part no|tickets?|pages?|bestell\w*|rechnung\w*|factures?|pedidos?|usd|eur|euros?)(?!\w)|[€$%]"
)
CUT_WORD = re.compile(r"^\w+")
CUT_END = re.compile(r"\w+$")
GAZETTEER = {
    "email": ("com", "org", "net", "edu", "gov", "de", "fr", "es", "uk", "io", "info"),
    "name": ("james", "john", "robert", "mary", "anna", "maria", "peter", "hans", "thomas", "michael", "paul", "jean", "pierre", "marie", "luis", "jose", "juan", "carmen", "david", "sarah", "laura", "julia"),
}
REACH = 24
LABELERS = ("strict", "gazetteer", "context", "against", "surroundings")
ROUNDS = 60


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of ``[LOCAL]+@DOMAIN``."""
    out = []
    low, at = 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
        low = found.end() if found else at + 1
        at = text.find("@", low)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the strict patterns, by kind as listed, then start."""
    out = []
    if "@" in text:
        out += [("email", s, e) for s, e in emails(text)]
    if DIGIT.search(text):
        if "." in text:
            for m in IP.finditer(text):
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
                    out.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = _digits(m[0])
                if 16 <= len(d) <= 19 and luhn(d):
                    out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= len(_digits(m[0])) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def loose_spans(text: str) -> list[tuple[str, int, int]]:
    """Candidates of the looser patterns."""
    out = []
    if "at" in text or "AT" in text:
        if "[" in text or "(" in text or "{" in text:
            out += [("email", m.start(), m.end()) for m in HIDDEN_EMAIL.finditer(text)]
    if DIGIT.search(text):
        for m in CARD.finditer(text):
            if 13 <= len(_digits(m[0])) <= 19:
                out.append(("card", m.start(), m.end()))
        for m in LOOSE_PHONE.finditer(text):
            if 7 <= len(_digits(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    out += [("name", m.start(1), m.end(1)) for m in NAME.finditer(text)]
    return out


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """All candidates with their being base; looser ones that touch a stricter or earlier one go."""
    base = base_spans(text)
    out = [(*s, True) for s in base]
    taken = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]
    ends = list(accumulate((e for _, e in taken), max))
    upto = 0
    for kind, s, e in sorted(loose_spans(text), key=lambda x: (x[1], -x[2])):
        # the base spans that begin before the end, and the loose span before
        n = bisect_left(starts, e)
        if s >= upto and (not n or ends[n - 1] <= s):
            upto = e
            out.append((kind, s, e, False))
    return out


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def votes(text: str, kind: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """One vote per labeler: 1 for, -1 against, 0 none."""
    span = text[start:end]
    left, right = text[max(0, start - REACH) : start].lower(), text[end : end + REACH // 2].lower()
    around = left + " " + right
    # words that the reach cuts are not whole
    if start > REACH and _word(text[start - REACH - 1]):
        left = CUT_WORD.sub("", left)
    if end + REACH // 2 < len(text) and _word(text[end + REACH // 2]):
        right = CUT_END.sub("", right)
    digits = _digits(span)
    strict = 1 if base else -1 if kind == "card" and not luhn(digits) else 0
    known = 0
    if kind == "email":
        known = 1 if re.split(r"[^a-z]+", span.lower().rstrip(")]} "))[-1] in GAZETTEER["email"] else -1
    elif kind == "name":
        known = 1 if any(w in GAZETTEER["name"] for w in span.lower().split()) else 0
    elif kind == "card":
        known = 1 if digits[:1] in "3456" and len(digits) in (15, 16) else -1
    context = 1 if any(w in around for w in CONTEXT[kind]) else 0
    against = -1 if AGAINST.search(left + " " + right) else 0
    before, after = text[start - 1 : start], text[end : end + 1]
    glued = before.isalnum() or after.isalnum() or before in "_/=#" and before != "" or len(set(digits)) == 1
    return strict, known, context, against, -1 if glued else 0


def shape(text: str, kind: str, start: int, end: int) -> str:
    """Features of a span for the classifier, as a short string (none of them is a labeler's verdict)."""
    span = text[start:end]
    digits = len(_digits(span))
    groups = len(re.findall(r"[0-9]+", span))
    marks = "".join(c for c in "+()-. @" if c in span)
    before, after = text[start - 1 : start], text[end : end + 1]
    side = lambda c: "n" if not c else "s" if c.isspace() else "a" if c.isalnum() else "p"
    return "|".join([kind, str(min(digits, 20)), str(min(groups, 6)), marks, side(before) + side(after)])


@dataclass(frozen=True)
class Model:
    """Weights of the span classifier, and what EM found for each labeler."""

    weights: dict[str, float]
    reliability: dict[str, float]
    threshold: float = 0.5

    def probability(self, features: list[str], cast: tuple[int, ...] = ()) -> float:
        """The classifier's, with the votes against the span weighed by their labelers' reliability."""
        z = sum(self.weights.get(f, 0.0) for f in features)
        for labeler, vote in zip(LABELERS, cast, strict=False):
            if vote < 0:
                right = self.reliability.get(labeler, 0.5)
                z -= np.log(right / (1 - right))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _feature_names(shape_: str, context: int) -> list[str]:
    kind, digits, groups, marks, sides = shape_.split("|")
    return ["bias", f"kind={kind}", f"{kind}.digits={digits}", f"{kind}.groups={groups}", f"{kind}.sides={sides}", f"{kind}.context={context}", *[f"{kind}.mark={m}" for m in marks]]


def expectation_maximisation(patterns: list[tuple[str, tuple[int, ...], int]]) -> tuple[np.ndarray, dict[str, float]]:
    """Probability of every (kind, votes, count) row to be personal data, and labelers' accuracies.

    Each kind has its own share of true spans, each labeler one accuracy; labelers are independent
    given the truth. Starts from accuracies of 0.8, and keeps them above one half, which fixes which
    of the two classes is personal data.
    """
    kinds = sorted({k for k, _, _ in patterns})
    vote = np.array([v for _, v, _ in patterns], float)
    n = np.array([c for _, _, c in patterns], float)
    own = np.array([kinds.index(k) for k, _, _ in patterns])
    accuracy = np.full(len(LABELERS), 0.8)
    share = np.full(len(kinds), 0.5)
    p = np.zeros(len(n))
    for _ in range(ROUNDS):
        weight = np.log(accuracy / (1 - accuracy))
        z = vote @ weight + np.log(share / (1 - share))[own]
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        for j in range(len(LABELERS)):
            right = (n * np.where(vote[:, j] > 0, p, 1 - p))[vote[:, j] != 0].sum()
            total = n[vote[:, j] != 0].sum()
            accuracy[j] = np.clip((right + 4) / (total + 5), 0.55, 0.99)
        for i in range(len(kinds)):
            share[i] = np.clip((n * p)[own == i].sum() / n[own == i].sum(), 0.02, 0.98)
    return p, dict(zip(LABELERS, accuracy.round(4).tolist(), strict=True))


def trained(rows: list[tuple[list[str], float, float]], ridge: float = 1.0) -> dict[str, float]:
    """Logistic regression on (features, soft label, count) rows, by Newton's method."""
    names = sorted({f for fs, _, _ in rows for f in fs})
    at = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for i, (fs, _, _) in enumerate(rows):
        x[i, [at[f] for f in fs]] = 1
    y = np.array([r[1] for r in rows])
    n = np.array([r[2] for r in rows], float)
    w = np.zeros(len(names))
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (n * (y - q)) - ridge * w
        hessian = (x.T * (n * q * (1 - q))) @ x + ridge * np.eye(len(names))
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return dict(zip(names, w.tolist(), strict=True))


def fit(docs: DataFrame) -> Model:
    """EM and classifier from all candidates of the table. Without candidates nothing is added."""

    def look(batches):
        for batch in batches:
            found: dict[tuple, int] = {}
            for text in batch.column(0).to_pylist():
                for kind, s, e, base in candidates(text or ""):
                    key = (kind, shape(text, kind, s, e), *votes(text, kind, s, e, base))
                    found[key] = found.get(key, 0) + 1
            if found:
                columns = list(zip(*found, strict=True))
                yield pa.record_batch(
                    [pa.array(columns[0]), pa.array(columns[1]), *[pa.array(c, pa.int32()) for c in columns[2:]], pa.array(list(found.values()), pa.int64())],
                    names=["kind", "shape", *LABELERS, "n"],
                )

    schema = "kind string, shape string, " + ", ".join(f"{x} int" for x in LABELERS) + ", n long"
    sums = docs.select("text").mapInArrow(look, schema).groupBy("kind", "shape", *LABELERS).agg(F.sum("n").alias("n"))
    rows = sorted(sums.collect())  # one row per distinct combination of discrete features
    if not rows:
        return Model({}, {}, 1.1)
    voted = [(r.kind, tuple(r[x] for x in LABELERS), r.n) for r in rows]
    p, reliability = expectation_maximisation(voted)
    training = [(_feature_names(r["shape"], r["context"]), float(q), r["n"]) for r, q in zip(rows, p, strict=True)]
    return Model(trained(training), reliability)


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def spans_of(text: str, model: Model) -> tuple[list, list]:
    """Base spans, and added spans with their probabilities."""
    base, added = [], []
    for kind, s, e, strict in candidates(text):
        if strict:
            base.append((kind, s, e))
            continue
        cast = votes(text, kind, s, e, False)
        q = model.probability(_feature_names(shape(text, kind, s, e), cast[2]), cast)
        if q >= model.threshold:
            added.append((kind, s, e, q))
    return base, added


def scanned(docs: DataFrame, model: Model) -> DataFrame:
    """Per document the base counts and digest, ``spans`` (base and added, joined) and ``found`` (kind,
    start, end, probability; base spans have 1). NULL counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind_type = docs.schema["doc_id"].dataType.simpleString()
    found_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))

    def look(batches):
        for batch in batches:
            counts = {k: [] for k in BASE_KINDS}
            digest, spans, found = [], [], []
            for text in batch.column(1).to_pylist():
                base, added = spans_of(text or "", shared.value)
                for k in BASE_KINDS:
                    counts[k].append(sum(1 for x in base if x[0] == k))
                digest.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined([*base, *[x[:3] for x in added]]))
                found.append([{"kind": k, "start": s, "end": e, "probability": q} for k, s, e, q in [*[(*x, 1.0) for x in base], *added]])
            yield pa.record_batch(
                [batch.column(0), *[pa.array(counts[k], pa.int64()) for k in BASE_KINDS], pa.array(digest), pa.array(spans), pa.array(found, found_type)],
                names=["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "found"],
            )

    columns = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return docs.select("doc_id", "text").mapInArrow(
        look, f"doc_id {kind_type}, {columns}, base_sha256 string, spans string, found array<struct<kind:string,start:int,end:int,probability:double>>"
    )
