"""Fingerprints, edited texts and radius search against plain versions."""

import hashlib
import random

from conftest import SF_SMALL

from starloom.llm import simhash
from starloom.llm.queries import QUERIES


def plain_classes(prints, radius):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def check(rows, docs):
    """``docs`` in order of id, each id once."""
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    for i, (doc_id, text) in enumerate(docs):
        text, following = text or "", docs[(i + 1) % len(docs)]
        cut = len(text) // 2
        edited = text[:len(text) - cut] + (following[1] or "")[:cut]
        row = got[doc_id]
        near = lambda other: 1 - (int(row.fingerprint, 16) ^ int(other, 16)).bit_count() / 128
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.near_edited == near(row.edited_fingerprint) and row.near_next == near(got[following[0]].fingerprint)
    same = {}
    for doc_id, text in docs:
        assert same.setdefault(text or "", got[doc_id].fingerprint) == got[doc_id].fingerprint
    return got


def test_query_over_documents(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    got = check(QUERIES["op5_simhash"](spark, SF_SMALL).collect(), docs)
    better = sum(r.near_edited > r.near_next for r in got.values())
    assert better >= 0.95 * len(docs)
    classes = plain_classes([int(got[d].fingerprint, 16) for d, _ in docs], simhash.RADIUS)
    assert [got[d].class_id for d, _ in docs] == [docs[c][0] for c in classes]


def test_odd_rows(spark):
    docs = [(-5, None), (0, ""), (3, "é😀 x"), (4, "w " * 5000), (9, "one two three"), (2 ** 40, "one two three")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    check(simhash.fingerprint_report(frame).collect(), docs)
    repeated = frame.unionByName(spark.createDataFrame([(9, "one two three"), (None, "no id")], frame.schema))
    rows = simhash.fingerprint_report(repeated).collect()
    assert len(rows) == 8 and len({r.fingerprint for r in rows if r.doc_id == 9}) == 1
    alone = simhash.fingerprint_report(frame.filter("doc_id = 9")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert simhash.fingerprint_report(frame.limit(0)).count() == 0


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(8)
    prints = []
    for _ in range(25):
        base = rng.getrandbits(128)
        prints.append(base)
        for _ in range(8):
            near = base
            for _ in range(rng.randint(1, 5)):
                near ^= 1 << rng.randrange(128)
            prints.append(near)
    prints = sorted(set(prints))
    low = [simhash._signed(p & ((1 << 64) - 1)) for p in prints]
    high = [simhash._signed(p >> 64) for p in prints]
    nodes = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(low, high))], "node long, fa long, fb long")
    got = {r.node: r.component for r in simhash.radius_components(nodes, 3).collect()}
    classes = plain_classes(prints, 3)
    assert [got.get(i, i) for i in range(len(prints))] == classes


def classes_of(spark, prints, radius, **options):
    low = [simhash._signed(p & ((1 << 64) - 1)) for p in prints]
    high = [simhash._signed(p >> 64) for p in prints]
    nodes = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(low, high))], "node long, fa long, fb long")
    got = {r.node: r.component for r in simhash.radius_components(nodes, radius, **options).collect()}
    return [got.get(i, i) for i in range(len(prints))]


def test_crowded_keys_are_keyed_further(spark):
    """A template's fingerprints share most bits, few of them are near each other, and chains run through them."""
    rng = random.Random(4)
    template, free = rng.getrandbits(128), rng.sample(range(128), 40)
    prints = set()
    for _ in range(60):
        near = template
        for bit in rng.sample(free, 12):
            near ^= 1 << bit
        prints.add(near)
        for _ in range(rng.choice([0, 0, 2])):  # a chain of steps of at most 3 bits
            for bit in rng.sample(range(128), 3):
                near ^= 1 << bit
            prints.add(near)
    prints = sorted(prints)
    assert classes_of(spark, prints, 3, crowd=2) == plain_classes(prints, 3)


def test_repeated_and_missing_ids_spread_over_ranges(spark):
    ids = [(None, h, 1) for h in range(40)] + [(7, h, 1) for h in range(40)] + [(i, 0, 1) for i in range(10, 30)]
    rows = simhash.neighbours(spark.createDataFrame(ids, "doc_id long, h long, n long").repartition(4)).collect()
    after = {(r.doc_id, r.h): (r.next.doc_id, r.next.h) for r in rows}
    before = {(r.doc_id, r.h): (r.before.doc_id, r.before.h) for r in rows}
    for i, (doc_id, h, _) in enumerate(ids):
        assert after[doc_id, h] == ids[(i + 1) % len(ids)][:2] and before[doc_id, h] == ids[i - 1][:2]
