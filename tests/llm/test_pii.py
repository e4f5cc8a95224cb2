"""Personal data spans against a plain version with Python's re."""

import hashlib
import re

from conftest import SF_SMALL
from pyspark.sql import functions as F

from starloom.llm import pii
from starloom.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            found, digits = m.group(), re.sub("[^0-9]", "", m.group())
            good = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in found.split(".")),
                    "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


ODD = ["a@b.c", "x@y.com_foo@z.com", "a@b@c.de", "é😀 bob@ex.org 😀 1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.4", "a@b.cc@d.ee.ff@g.hh",
       "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111", "+1 (2)))) 5 +33 1 23 45 67 89. +12345678901234567", "a" * 30000, "1" * 30000,
       "(((((" * 2000, "1.2.3." * 800, "@" * 500, "a@" + "b." * 5000 + "c", "+" * 500 + "1", "5 " * 5000, None, ""]


def test_base_spans_of_odd_texts(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").coalesce(1)
    rows = pii.with_spans(pii.scan(docs), pii.Proposer((), 2.0)).select("text", pii.spans_text(F.col("spans")).alias("s")).collect()
    assert [r.s for r in rows] == [",".join(plain_spans(r.text)) for r in rows]


def test_query_keeps_base_spans(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op4_pii"](spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in base) for k in pii.KINDS]


def test_trees_add_spans_that_no_base_pattern_takes(spark):
    """Phones without a plus look like phones with one; keys and sums do not."""
    rows = [(i, f"please call +1 ({200 + i % 700}) 555-{1000 + i} today") for i in range(400)]
    rows += [(1000 + i, f"token = {i * 7919 % 10 ** 7:07d}{i}x and {i}{i}{i}.{i}") for i in range(400)]
    rows += [(5000, "please call (212) 555-7777 today")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    scanned = pii.scan(docs)
    found = pii.with_spans(scanned, pii.train(scanned))
    added = found.filter("doc_id = 5000").select(pii.redacted(F.col("text"), F.col("spans")).alias("t")).first().t
    assert added == "please call [PHONE] today"
    assert found.filter("doc_id between 1000 and 1400 and size(spans) > 0").count() == 0


def card(i):
    head = f"4{i * 48271 % 10 ** 14:014d}"
    return next(head + str(c) for c in range(10) if luhn(head + str(c)))


def failing(i):
    return card(i)[:-1] + str((int(card(i)[-1]) + 1) % 10)


def lacking_texts(share):
    """``share`` of the phones lack a plus, of the cards stand side by side, and of the addresses are spelled out."""
    rows = []
    for i in range(600):
        cut, phone = i * 7 % 20 < 20 * share, f"1 ({200 + i % 700}) 555-{1000 + i}"
        rows.append((4 * i, f"please call {'' if cut else '+'}{phone} today", ["[PHONE]"]))
        rows.append((4 * i + 1, f"paid by {card(i)}{' ' + card(i) if cut else ''} then", ["[CARD]"] * (2 if cut else 1)))
        rows.append((4 * i + 2, f"write to ann.{i}{' (at) ' if cut else '@'}mail.example{' (dot) ' if cut else '.'}com soon", ["[EMAIL]"]))
        rows.append((4 * i + 3, f"token = a{i * 7919 % 10 ** 9:09d}f and order {failing(i)} of {i}{i}{i}.{i}", []))
    return rows


def test_spans_are_found_at_any_share_of_them(spark):
    """What touches no base span is not an error for that."""
    for share in (0.1, 0.5):
        rows = lacking_texts(share)
        docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").coalesce(2)
        scanned = pii.scan(docs)
        found = pii.with_spans(scanned, pii.train(scanned)).select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("t")).collect()
        got = {r.doc_id: re.findall(r"\[[A-Z]+\]", r.t) for r in found}
        assert [(share, text, got[i]) for i, text, want in rows if got[i] != want] == []


def test_overlapping_spans_are_redacted_once(spark):
    spans = "array(named_struct('kind', 'card', 'start', 2, 'end', 6), named_struct('kind', 'ip', 'start', 4, 'end', 8))"
    row = spark.range(1).select(pii.redacted(F.lit("ab123456cd"), F.expr(spans)).alias("t")).first()
    assert row.t == "ab[CARD]cd"


def test_no_proposals_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "plain", 3, 4), (1, "plain", 3, 4)], "doc_id long, text string, base int, spans int")
    scanned = pii.scan(docs)
    proposer = pii.train(scanned)
    assert proposer.trees == ()
    assert [len(r.spans) for r in pii.with_spans(scanned, proposer).collect()] == [0, 0]
    assert pii.with_spans(pii.scan(docs.limit(0)), proposer).count() == 0


def test_many_matches_in_one_text(spark):
    """Spans of a text of many matches equal ``re``, also where a projection drops the base spans, at a cost about in proportion."""
    import time
    mark = "mail x@y.org or call 555 123 4567 at 10.0.0.1, "

    def run(n):
        docs = spark.createDataFrame([(1, mark * n)], "doc_id long, text string")
        start = time.time()
        narrow = pii.scan(docs).select("candidates").first().candidates
        scanned = pii.scan(docs)
        whole = pii.with_spans(scanned, pii.Proposer((), 0.0)).select(pii.redacted(F.col("text"), F.col("spans")).alias("t")).first().t
        return time.time() - start, narrow, whole

    run(10)
    few, many = run(300), run(3_000)
    spans = [tuple(map(int, s.split(":")[1:])) for s in plain_spans(mark * 3_000)]
    touching = [any(a < c.end and c.start < b for a, b in spans[max(0, i):]) for i, c in ((0, c) for c in many[1][:40])]
    assert [c.touches for c in many[1][:40]] == touching
    assert many[2] == "mail [EMAIL] or call [PHONE] at [IP], " * 3_000
    assert many[0] < 30 * max(few[0], 0.3)


def test_touching_equals_all_pairs(spark):
    import random
    rnd, rows = random.Random(5), []
    for _ in range(40):
        spans = [[(a, a + rnd.randrange(1, 30)) for a in (rnd.randrange(300) for _ in range(rnd.randrange(200)))] for _ in range(2)]
        rows.append(tuple([("x", a, b) for a, b in side] for side in spans))
    frame = spark.createDataFrame(rows, f"base {pii.SPAN}, proposed {pii.SPAN}")
    for r, (base, proposed) in zip(frame.select(pii.touching(F.col("base"), F.col("proposed")).alias("t")).collect(), rows):
        assert r.t == [any(a < d and c < b for _, a, b in base) for _, c, d in proposed]


def test_all_proposals_are_learned_from(spark):
    """No proposal is left out of the fit or the calibration, whatever their number."""
    rows = 21_000
    text = F.concat(F.lit("call +1 555 123 "), F.lpad((F.col("id") % 9000).cast("string"), 4, "0"), F.lit(" id x"), F.col("id") + 10_000_000)
    scanned = pii.scan(spark.range(rows).select(F.col("id").alias("doc_id"), text.alias("text"))).select("doc_id", "base", "candidates").cache()
    proposed = scanned.select(F.explode("candidates")).count()
    assert proposed > 2 * 20_000
    found = pii.shapes(scanned)
    totals = {r.half: r.n for r in found.groupBy("half").agg(F.sum("n").alias("n")).collect()}
    assert sum(totals.values()) == proposed and sorted(totals) == [0, 1]
    seen, fit = [], pii._fit
    pii._fit = lambda known: seen.append(known.agg(F.sum("n")).first()[0]) or fit(known)
    try:
        assert pii.train(scanned).trees
    finally:
        pii._fit = fit
    assert seen == [proposed, totals[1], totals[0]]
    scanned.unpersist()
