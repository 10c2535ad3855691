"""Personal data: labelers vote on candidate spans, and what they agree on trains the final verdict.

Candidates are the spans of the strict patterns (the base, which always stays) and of looser ones:
spelt-out addresses, numbers without a plus sign, cards that fail their check digit, addresses with
parts out of range. Six labelers, of patterns, check rules, gazetteers, context words and borders,
vote for, against or not at all. How often each vote pattern occurs is counted over all documents;
expectation-maximisation over these counts estimates each labeler's reliability and the probability
that a candidate of a pattern is personal data; a logistic classifier of votes, kind and shape is
trained to these probabilities and judges every candidate.

Only the counts of patterns reach the driver: at most kinds * 3 ** labelers * shapes, whatever the
corpus. Offsets are code points, ends exclusive. Null and empty texts have no spans; long texts are
searched whole, in time that grows in proportion. Of overlapping spans of different kinds all are
reported; ``redact`` merges them. Repeated rows get a row each; an empty table gives an empty result.
Other columns are ignored by ``candidates`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.common import ship_package, written

# Fixed by the contract: kinds in order, and the patterns of the base.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails fails from each of its digits, so a match starts at the run's first.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# The looser patterns; each is bounded, so that a long text takes no longer in proportion.
SPELT = re.compile(
    r"(?<![\w.%+-])[\w.%+-]{1,64}\s?(?:\[at\]|\(at\)|\{at\}| at )\s?[\w-]{1,63}"
    r"(?:\s?(?:\[dot\]|\(dot\)|\{dot\}| dot |\.)\s?[\w-]{2,63}){1,4}", re.IGNORECASE)
LOCAL_PHONE = re.compile(
    r"(?<![\w+.-])(?:\([0-9]{2,5}\)|[0-9]{2,5})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![\w-])")

# Gazetteers and context words: fixed values.
TOP_DOMAINS = frozenset(
    "com org net edu gov mil int info biz io dev app ai co us uk ca au nz ie de at ch fr be nl es pt "
    "it pl cz se no fi dk gr ru ua tr in cn jp kr br mx ar cl za".split())
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "36", "60", "62", "65")
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43",
                 "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "64", "81", "82", "86",
                 "90", "91")
HINTS = {
    "email": ("mail", "contact", "kontakt", "courriel", "correo", "write", "@"),
    "ip": ("ip", "host", "server", "addr", "login", "ssh"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta", "pay"),
    "phone": ("tel", "phone", "call", "fax", "mobile", "cell", "whatsapp", "anruf", "appel", "llam"),
}
AGAINST = ("version", "release", "isbn", "order", "invoice", "serial", "sku", "section", "build",
           "no.", "nr.")
#: Letters before a span that the context labelers read.
NEAR = 32
LABELERS = ("pattern", "rule", "gazetteer", "hint", "against", "border")
SHAPES = 6


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern's matches from left to right: each '@' ends the run of letters before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        before = text[end:at]
        start = at - (len(before) - len(before.rstrip(LOCAL)))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        else:
            # No match reaches over this '@'.
            end = at + 1
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind (its place in ``KINDS``), start and end of the base, by start, then kind."""
    spans = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _HAS_DIGIT.search(text):
        spans += [(m.start(), 1, m.end()) for m in IP.finditer(text)
                  if all(map(_small, m[0].split(".")))]
        spans += [(m.start(), 2, m.end()) for m in CARD.finditer(text)
                  if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                      if 10 <= len(_digits(m[0])) <= 15]
    return [(kind, start, end) for start, kind, end in sorted(spans)]


_HAS_DIGIT = re.compile("[0-9]")
_AT_WORD = re.compile(r"\[at\]|\(at\)|\{at\}| at ", re.IGNORECASE)
_BRACKETED_AT = re.compile(r"\[at\]|\(at\)|\{at\}", re.IGNORECASE)
_PLAIN_DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)+")


def _loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates beyond the base: none overlaps a base span."""
    found = []
    # What is kept below has a bracketed "at", or the word "dot" with any "at".
    if _BRACKETED_AT.search(text) or "dot" in text.lower() and _AT_WORD.search(text):
        found += [(0, m.start(), m.end()) for m in SPELT.finditer(text) if " dot " in m[0].lower()
                  or any(mark in m[0].lower() for mark in ("[", "(", "{"))]
    if _HAS_DIGIT.search(text):
        found += [(1, m.start(), m.end()) for m in IP.finditer(text)]
        found += [(2, m.start(), m.end()) for m in CARD.finditer(text)
                  if 13 <= len(_digits(m[0])) <= 19]
        found += [(3, m.start(), m.end()) for m in LOCAL_PHONE.finditer(text)]
    taken = sorted((start, end) for _, start, end in base)
    loose, i = [], 0
    for kind, start, end in sorted(found, key=lambda s: s[1]):
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        # Base spans of several kinds may overlap; the next few are all that can reach back.
        if not any(s < end and start < e for s, e in taken[max(0, i - 4):i + 4]):
            loose.append((kind, start, end))
    return loose


def votes(text: str, kind: int, start: int, end: int, base: bool) -> str:
    """A letter for each labeler: + for, - against, 0 no vote."""
    span, digits = text[start:end], _digits(text[start:end])
    before = text[max(0, start - NEAR):start].lower()
    if kind == 0:
        top = re.split(r"[\s.\])}]+", span)[-1].lower()
        domain = _AT_WORD.split(span)[-1].strip()
        rule = base or "dot" in span.lower() or bool(_PLAIN_DOMAIN.fullmatch(domain))
        known = top in TOP_DOMAINS
    elif kind == 1:
        parts = span.split(".")
        rule, known = all(map(_small, parts)), not parts[0].startswith("0")
    elif kind == 2:
        rule, known = luhn(digits), digits.startswith(CARD_STARTS)
    else:
        rule, known = 10 <= len(digits) <= 15, digits.startswith(CALLING_CODES)
    edges = text[max(0, start - 1):start] + text[end:end + 1]
    return "".join((
        "+" if base else "0",
        "+" if rule else "-",
        "+" if known else "0",
        "+" if any(hint in before for hint in HINTS[KINDS[kind]]) else "0",
        "-" if any(word in before for word in AGAINST) else "0",
        "-" if any(c.isalnum() or c == "_" for c in edges) else "+"))


def shape(text: str, start: int, end: int) -> int:
    """How long, and how much of it other than digits."""
    span = text[start:end]
    long = 0 if len(span) < 12 else 1 if len(span) < 20 else 2
    return 2 * long + (2 * len(_digits(span)) > len(span))


def spans_of(text: str) -> list[tuple[int, int, int, bool, str]]:
    """Kind, start, end, whether of the base, and the pattern of votes and shape; by start, kind."""
    if not text:
        return []
    base = base_spans(text)
    every = [(s, True) for s in base] + [(s, False) for s in _loose_spans(text, base)]
    every.sort(key=lambda x: (x[0][1], x[0][0]))
    return [(k, s, e, b, f"{k}{votes(text, k, s, e, b)}{shape(text, s, e)}")
            for (k, s, e), b in every]


_SPAN = pa.struct([("kind", pa.int8()), ("start", pa.int64()), ("end", pa.int64()),
                   ("base", pa.bool_()), ("pattern", pa.string())])


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id and spans (kind, start, end, base, pattern); a row for each document."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[dict(zip(("kind", "start", "end", "base", "pattern"), s))
                     for s in spans_of(t or "")] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(_SPAN))], names=["doc_id", "spans"])

    ship_package(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        of, f"doc_id {kind}, spans array<struct<kind: tinyint, start: bigint, end: bigint, "
        "base: boolean, pattern: string>>")


@dataclass
class Verdicts:
    """What was learned: the probability of each pattern, each labeler's chance to vote for a true
    and for a false candidate, and the patterns that count as personal data."""
    probability: dict[str, float] = field(default_factory=dict)
    reliability: dict[str, tuple[float, float]] = field(default_factory=dict)
    accepted: frozenset[str] = frozenset()


def _estimate(ballots: np.ndarray, kinds: np.ndarray, counts: np.ndarray, rounds: int = 100
              ) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of the patterns and the vote rates: [labeler, truth, vote]."""
    score = (ballots == 2).sum(1) - (ballots == 0).sum(1)
    posterior = np.clip(0.5 + 0.15 * score, 0.05, 0.95)
    # Labelers are believed to be right more often than wrong, as strongly as a few candidates.
    prior = np.array([[2.0, 1.5, 1.0], [1.0, 1.5, 2.0]])
    rates = np.zeros((ballots.shape[1], 2, 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - posterior), counts * posterior])
        for j in range(ballots.shape[1]):
            for vote in range(3):
                rates[j, :, vote] = weight[:, ballots[:, j] == vote].sum(1)
            rates[j] += prior
            rates[j] /= rates[j].sum(1, keepdims=True)
        logs = np.log(rates)[np.arange(ballots.shape[1])[None, :], :, ballots].sum(1)
        for kind in range(len(KINDS)):
            of = kinds == kind
            share = (weight[1, of].sum() + 1) / (counts[of].sum() + 2)
            odds = logs[of, 1] - logs[of, 0] + np.log(share / (1 - share))
            posterior[of] = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior, rates


def learn(found: DataFrame, least: float = 0.5) -> Verdicts:
    """From the candidates of all documents, by the counts of their patterns."""
    rows = found.select(F.explode("spans.pattern").alias("pattern")).groupBy("pattern").agg(
        F.count("*").alias("n")).orderBy("pattern").collect()
    if not rows:
        return Verdicts()
    patterns = [r["pattern"] for r in rows]
    counts = np.array([r["n"] for r in rows], float)
    kinds = np.array([int(p[0]) for p in patterns])
    ballots = np.array([["-0+".index(v) for v in p[1:1 + len(LABELERS)]] for p in patterns])
    posterior, rates = _estimate(ballots, kinds, counts)
    # The final classifier, on votes, kind and shape.
    inputs = np.hstack([np.eye(3)[ballots].reshape(len(patterns), -1), np.eye(len(KINDS))[kinds],
                        np.eye(SHAPES)[[int(p[-1]) for p in patterns]]])
    weights = np.zeros(inputs.shape[1])
    share = np.sqrt(counts) / np.sqrt(counts).sum()
    for _ in range(2000):
        out = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        weights -= 2.0 * (inputs.T @ (share * (out - posterior)) + 1e-4 * weights)
    out = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
    return Verdicts(
        dict(zip(patterns, out.tolist())),
        {name: (float(rates[j, 1, 2]), float(rates[j, 0, 2])) for j, name in enumerate(LABELERS)},
        frozenset(p for p, q in zip(patterns, out) if q >= least))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def judged(found: DataFrame, verdicts: Verdicts) -> DataFrame:
    """Columns doc_id, counts of the base by kind, base_sha256 and spans as text, of candidates."""
    accepted = verdicts.accepted

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for spans in batch.column(1).to_pylist():
                base = [(s["kind"], s["start"], s["end"]) for s in spans if s["base"]]
                every = [(s["kind"], s["start"], s["end"]) for s in spans
                         if s["base"] or s["pattern"] in accepted]
                rows.append((*[sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))],
                             hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:4]],
                 *[pa.array(c, pa.string()) for c in columns[4:]]],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "spans").mapInArrow(
        of, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS)
        + ", base_sha256 string, spans string")


def personal_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Candidates of all documents, written once, judged by what they teach."""
    found = written(candidates(docs, doc_id, text), "pii")
    return judged(found, learn(found))


def redacted(text: str, accepted: frozenset[str]) -> str:
    """The text with each span replaced by its kind; overlapping spans are one, of the first's."""
    parts, done = [], 0
    for kind, start, end, base, pattern in spans_of(text):
        if not (base or pattern in accepted):
            continue
        if start >= done:
            parts += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    return "".join(parts) + text[done:] if parts else text


def redact(docs: DataFrame, verdicts: Verdicts, text: str = "text") -> DataFrame:
    """The documents with their personal data replaced; other columns are kept."""
    accepted, columns = verdicts.accepted, docs.columns

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = columns.index(text)
            texts = [None if t is None else redacted(t, accepted)
                     for t in batch.column(at).to_pylist()]
            arrays = [*batch.columns]
            arrays[at] = pc.cast(pa.array(texts, pa.string()), batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    ship_package(docs.sparkSession)
    return docs.mapInArrow(of, docs.schema)
