from __future__ import annotations

import hashlib
import random
import re
import time

from tidewarden.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def plain_luhn(number):
    total = 0
    for i, d in enumerate(reversed(number)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text):
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text)
              if 14 <= len(digits(m[0])) <= 19 and plain_luhn(digits(m[0]))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
              if 10 <= len(digits(m[0])) <= 15]
    return [(k, s, e) for s, k, e in sorted(found)]


def test_base_is_what_the_patterns_match():
    random.seed(3)
    parts = ["ab1.@%", "0123.", "+1 ()-0", "a@b.c", "45-9 ", "é1٣.@", "4111 1111 1111 1111 "]
    for _ in range(20_000):
        text = "".join(random.choice(random.choice(parts)) for _ in range(random.randint(0, 40)))
        assert pii.base_spans(text) == plain_base(text), text
    for text in ("4111 1111 1111 1111", "x 4111111111111111 y", "+1 (652) 555-4544", "1.2.3.256",
                 "001.2.3.255", "a@b.c@d.e", "a@b..c", "@" * 9 + "a@b.c"):
        assert pii.base_spans(text) == plain_base(text)


def test_time_grows_in_proportion():
    text = ("a" * 200_000 + " " + "1" * 200_000 + "." + "%" * 50_000 + "1 " * 100_000
            + "1." * 50_000 + "+1" * 30_000 + "@" * 30_000 + " at " * 30_000 + "dot ")
    start = time.time()
    pii.spans_of(text)
    assert time.time() - start < 20


def documents(spark):
    rows = [(i, f"Contact mail ann{i}@mail.example.com or call +1 (652) 555-{1000 + i} now.")
            for i in range(40)]
    rows += [(100 + i, f"host 10.0.{i}.7 paid by card 4111 1111 1111 1111 today") for i in range(40)]
    rows += [(200 + i, f"write to joe{i} [at] mail [dot] com please") for i in range(20)]
    rows += [(300 + i, f"call tel (652) 555-{2000 + i} now") for i in range(20)]
    rows += [(400 + i, f"release version 300.{i}.1.2 order serial 4111111111111112x") for i in range(30)]
    rows += [(500, None), (501, ""), (None, "ann@b.org"), (502, "x@y.zz"), (502, "x@y.zz")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_votes_add_spelt_and_local_forms_and_leave_versions_alone(spark):
    rows = pii.personal_spans(documents(spark)).collect()
    assert len(rows) == 155
    texts = {r.doc_id: r.text or "" for r in documents(spark).collect()}
    for r in rows:
        base = plain_base(texts[r.doc_id])
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in base)
                                                           for i in range(4)]
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))
        if r.doc_id is not None and 200 <= r.doc_id < 300:
            assert r.spans.startswith("email:9:")
        if r.doc_id is not None and 300 <= r.doc_id < 400:
            assert r.spans.startswith("phone:9:")
        if r.doc_id is not None and 400 <= r.doc_id:
            assert r.spans == text


def test_a_bracketed_at_with_a_plain_dot_is_a_candidate():
    for form in ("jane [at] example.com", "jane(at)example.com", "jane {AT} mail.example.com"):
        text = f"Please write to {form} today."
        (kind, start, end, base, pattern), = pii.spans_of(text)
        assert (kind, text[start:end], base) == (0, form, False)
        assert pattern[1 + pii.LABELERS.index("rule")] == "+"
    for text in ("We met at example.com today.", "jane (at) home", "look at that. Then"):
        assert pii.spans_of(text) == []


def test_reliabilities_are_learned(spark):
    verdicts = pii.learn(pii.candidates(documents(spark)))
    true, false = verdicts.reliability["rule"]
    assert true > 0.9 > false and len(verdicts.accepted) < len(verdicts.probability)


def test_redaction_keeps_other_columns(spark):
    df = spark.createDataFrame([("mail a@b.com, card 4111111111111111.", 1, "x"), (None, 2, "y"),
                                ("clean 12 text", 3, "z")], "text string, spans int, kind string")
    found = pii.candidates(df.withColumnRenamed("spans", "doc_id"))
    got = pii.redact(df, pii.learn(found)).collect()
    assert [tuple(r) for r in got] == [("mail <EMAIL>, card <CARD>.", 1, "x"), (None, 2, "y"),
                                       ("clean 12 text", 3, "z")]


def test_overlapping_spans_are_replaced_once():
    text = "from 1.2.3.4@a.b on"
    assert [s[:3] for s in pii.spans_of(text)] == [(0, 5, 16), (1, 5, 12)]
    assert pii.redacted(text, frozenset()) == "from <EMAIL> on"


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.personal_spans(empty).collect() == []
