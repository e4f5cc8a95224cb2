"""Document fingerprints by SimHash, with DataFrame and SQL functions only.

Every word of a whole text votes with a weight that grows with its length (long words are rare
words): 128 hashed bits vote for or against each bit of the fingerprint, and a bit is set where the
votes for it exceed half.  Two bits share one 64-bit sum, in lanes of 32 bits; with weights of at most 64 a
lane holds the votes of 67 million words.  Partial sums are made where the text is read.

Fingerprints within a Hamming radius r are found by permuted block tables: the bits are dealt into r + 2 blocks,
two fingerprints within r agree on at least two of them, and each pair of blocks keys one table.  Equal
fingerprints are one node.  In ``STAR_ROUNDS`` rounds of a level a key's members are linked to one of them, drawn anew, where they lie
within r, and keys whose members are all connected are set aside.  Keys left with at most ``CROWD`` members give pairs (at most
``CROWD`` / 2 a member).  Larger ones are keyed further: a fresh permutation deals the bits that their members need not
share into blocks, and so on.  Bits run out where a key's members lie within r of each other, so no group is paired whole.
Counts and stars of keys come from map-side combined aggregates, joined back by key.

Defined cases: a null or empty text has the fingerprint of no votes (all bits clear); repeated rows are
fingerprinted each; a table of one document is its own next document; an empty table gives an empty result; null ids come
first in the order; other columns are not returned.
"""

from __future__ import annotations

import random
from itertools import combinations, count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import SPACE, stored, table
from starloom.llm.components import components

BITS = 128
RADIUS = 3
STAR_ROUNDS = 1
CROWD = 64  # largest key whose members are paired: 32 pairs a member cost about what the 10 keys of a further level do, shuffled thrice
_LANES = (1 << 32) + 1


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` with the fingerprint ``fa``, ``fb`` (long, 64 bits each) of ``text``: a row for each different key.

    Rows that share the keys must have equal texts.
    """
    words = texts.select(*keys, F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SPACE)).alias("_w"))
    length = F.least(F.length("_w"), F.lit(8)).cast("long")
    voting = words.select(*keys, F.xxhash64("_w").alias("_ha"), F.xxhash64("_w", F.lit(1)).alias("_hb"), (length * length).alias("_weight"))
    sums = [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_LANES)) * F.col("_weight")).alias(f"{h}_{i}")
            for h in ("_ha", "_hb") for i in range(32)]
    votes = voting.groupBy(*keys).agg(F.sum("_weight").alias("_total"), *sums)

    def bits(h: str) -> Column:
        out = F.lit(0).cast("long")
        for i in range(32):
            low, high = F.col(f"{h}_{i}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"{h}_{i}", 32)
            for lane, at in ((low, i), (high, i + 32)):
                out = out.bitwiseOR(F.shiftleft((lane * 2 > F.col("_total")).cast("long"), at))
        return out

    return votes.select(*keys, bits("_ha").alias("fa"), bits("_hb").alias("fb"))


def shown(a: Column, b: Column) -> Column:
    """A fingerprint as 32 hexadecimal digits."""
    return F.concat(*[F.lpad(F.lower(F.hex(x)), 16, "0") for x in (b, a)])


def distance(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Hamming distance of the fingerprints (a, b) and (c, d)."""
    return F.bit_count(a.bitwiseXOR(c)) + F.bit_count(b.bitwiseXOR(d))


def likeness(a: Column, b: Column, c: Column, d: Column) -> Column:
    return 1 - distance(a, b, c, d) / F.lit(float(BITS))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def dealt_blocks(radius: int, level: int) -> list[tuple[int, int]]:
    """(low, high) bit masks of the ``radius`` + 2 blocks into which a level's permutation deals the bits."""
    order = random.Random(level).sample(range(BITS), BITS)
    blocks = [sum(1 << bit for bit in order[i::radius + 2]) for i in range(radius + 2)]
    return [(_signed(block & ((1 << 64) - 1)), _signed(block >> 64)) for block in blocks]


def keyed(members: DataFrame, radius: int, level: int) -> DataFrame:
    """``members`` (node, fa, fb, component, key, ra, rb) under the keys of ``level``, one for each pair of blocks.

    ``ra`` and ``rb`` mask the bits that the members of a key need not share.
    """
    keys = []
    for t, ((la, ha), (lb, hb)) in enumerate(combinations(dealt_blocks(radius, level), 2)):
        low, high = F.lit(la | lb).cast("long"), F.lit(ha | hb).cast("long")
        keys.append(F.struct(F.xxhash64("key", F.lit(t), F.col("fa").bitwiseAND(F.col("ra")).bitwiseAND(low),
                                        F.col("fb").bitwiseAND(F.col("rb")).bitwiseAND(high)).alias("key"),
                             F.col("ra").bitwiseAND(F.bitwise_not(low)).alias("ra"), F.col("rb").bitwiseAND(F.bitwise_not(high)).alias("rb")))
    return members.select("node", "fa", "fb", "component", F.explode(F.array(*keys)).alias("k")).select("node", "fa", "fb", "component", "k.*")


def unsettled(entries: DataFrame, turn: int) -> DataFrame:
    """``entries`` of the keys whose members are in different components, with the key's size and a star drawn by ``turn``."""
    draw = F.col("node").bitwiseXOR(F.xxhash64(F.lit(turn)))  # one to one
    keys = (entries.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("size"),
                                       *[F.min_by(c, draw).alias(f"star_{c}") for c in ("node", "fa", "fb", "component")])
            .filter("_low <> _high").drop("_low", "_high"))
    return stored(entries.join(keys, "key"))


def radius_components(nodes: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """(node, component) of ``nodes`` (node, fa, fb; different fingerprints) that have another within ``radius``."""
    every = F.lit(-1).cast("long")
    members = nodes.select("node", "fa", "fb", F.col("node").alias("component"), F.lit(0).cast("long").alias("key"), every.alias("ra"), every.alias("rb"))
    columns, links = members.columns, nodes.select("node", F.col("node").alias("other")).limit(0)
    for level in count():
        entries = keyed(members, radius, level)
        for turn in range(STAR_ROUNDS + 1):
            entries = unsettled(entries, level * (STAR_ROUNDS + 1) + turn)
            if turn == STAR_ROUNDS or entries.isEmpty():
                break
            near = distance(F.col("fa"), F.col("fb"), F.col("star_fa"), F.col("star_fb")) <= radius
            met = entries.filter(near & (F.col("component") != F.col("star_component"))).select("node", F.col("star_node").alias("other"))
            links = stored(links.unionByName(met.distinct()))
            labels = components(links, "node", "other").withColumnRenamed("component", "found")
            entries = entries.join(labels, "node", "left").withColumn("component", F.coalesce("found", "component")).select(*columns)
        few = entries.filter(F.col("size") <= crowd)
        right = few.select("key", F.col("node").alias("other"), F.col("fa").alias("oa"), F.col("fb").alias("ob"), F.col("component").alias("with"))
        near = distance(F.col("fa"), F.col("fb"), F.col("oa"), F.col("ob")) <= radius
        pairs = few.join(right, "key").filter((F.col("node") < F.col("other")) & (F.col("component") != F.col("with")) & near)
        links = stored(links.unionByName(pairs.select("node", "other").distinct()))
        members = entries.filter(F.col("size") > crowd).select(*columns)
        if members.isEmpty():
            return components(links, "node", "other")


def neighbours(ids: DataFrame) -> DataFrame:
    """``ids`` (doc_id, h, n; each (doc_id, h) once) with ``next`` and ``before``: structs of the same in cyclic order.

    A range sort by id and hash, so that rows without an id or with the same one spread too, puts them into ranges; a window
    orders each, and the ranges' first and last rows join them up.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("h").asc()]
    ranged = stored(ids.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    row = F.struct("doc_id", "h", "n")
    over = Window.partitionBy("range").orderBy(*order)
    place = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")), F.col("doc_id").isNotNull(), F.col("h"))
    ends = ranged.groupBy("range").agg(F.min_by(row, place).alias("first"), F.max_by(row, place).alias("last"))
    ring = Window.orderBy("range")  # one row a range
    everything = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("range",
                       F.coalesce(F.lead("first").over(ring), F.first("first").over(everything)).alias("_after"),
                       F.coalesce(F.lag("last").over(ring), F.last("last").over(everything)).alias("_behind"))
    linked = ranged.select("*", F.lead(row).over(over).alias("_next"), F.lag(row).over(over).alias("_before"))
    return (linked.join(F.broadcast(ends), "range")
            .select("doc_id", "h", "n", F.coalesce("_next", "_after").alias("next"), F.coalesce("_before", "_behind").alias("before")))


def edited_texts(docs: DataFrame, ring: DataFrame) -> DataFrame:
    """(doc_id, doc_id_key, h, n, text, edited): the last floor(n / 2) code points replaced by the next document's first.

    Both joins are on (doc_id_key, h): the texts are shuffled once, and the donated heads a second time.
    """
    keyed = docs.join(ring, ["doc_id_key", "h"])
    donors = keyed.select(F.coalesce("before.doc_id", F.lit(0)).alias("doc_id_key"), F.col("before.h").alias("h"),
                          F.expr("substring(text, 1, cast(before.n div 2 as int))").alias("donated"))
    joined = keyed.join(donors, ["doc_id_key", "h"])
    kept = F.expr("substring(text, 1, cast(n - n div 2 as int))")
    return joined.select("doc_id", "doc_id_key", "h", "n", "text", F.concat(kept, "donated").alias("edited"))


def fingerprint_report(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """A row a document: digests and fingerprints of its text and edited text, likenesses, and ``class_id``.

    ``class_id`` is the least id whose fingerprint is reachable by steps of at most ``radius`` bits.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("doc_id_key"),
                       F.xxhash64(whole, F.col(key).isNull()).alias("h"), whole.alias("text"))
    ids = stored(rows.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("copies"), F.max(F.length("text")).cast("long").alias("n")))
    ring = stored(neighbours(ids.select("doc_id", "h", "n")))
    once = rows
    if not ids.filter("copies > 1").isEmpty():
        once = rows.dropDuplicates(["doc_id", "h"])
    linked = ring.withColumn("doc_id_key", F.coalesce("doc_id", F.lit(0)))
    edited = edited_texts(once.drop("doc_id"), linked)
    versions = edited.select("doc_id", "doc_id_key", "h", F.sha2("edited", 256).alias("sha"), F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("v"))
    prints = stored(fingerprints(versions.select("doc_id", "doc_id_key", "h", "sha", "v.which", "v.text"), ["doc_id", "doc_id_key", "h", "sha", "which"]))
    own = prints.filter("which = 0").drop("which", "sha")
    changed = prints.filter("which = 1").select("doc_id_key", "h", "sha", F.col("fa").alias("ea"), F.col("fb").alias("eb"))
    after = linked.select("doc_id_key", "h", "n", F.coalesce("next.doc_id", F.lit(0)).alias("nk"), F.col("next.h").alias("nh"))
    of_next = own.select(F.col("doc_id_key").alias("nk"), F.col("h").alias("nh"), F.col("fa").alias("na"), F.col("fb").alias("nb"))

    nodes = stored(own.groupBy("fa", "fb").agg(F.min("doc_id").alias("least")).withColumn("node", F.xxhash64("fa", "fb")))
    labels = radius_components(nodes.select("node", "fa", "fb"), radius)
    named = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = named.join(named.groupBy("component").agg(F.min("least").alias("class_id")), "component").select("fa", "fb", "class_id")

    counted = ids.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id_key"), "h", "copies")
    joined = (own.join(changed, ["doc_id_key", "h"]).join(after, ["doc_id_key", "h"]).join(counted, ["doc_id_key", "h"])
              .join(of_next, ["nk", "nh"]).join(classes, ["fa", "fb"]))
    a, b = F.col("fa"), F.col("fb")
    return joined.withColumn("_copy", F.explode(F.expr("sequence(1L, copies)"))).select(
        "doc_id", F.col("n").alias("n_chars"), F.col("sha").alias("edited_sha256"), shown(a, b).alias("fingerprint"),
        shown(F.col("ea"), F.col("eb")).alias("edited_fingerprint"), likeness(a, b, F.col("ea"), F.col("eb")).alias("near_edited"),
        likeness(a, b, F.col("na"), F.col("nb")).alias("near_next"), "class_id")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    return fingerprint_report(table(spark, sf_dir, "documents").select("doc_id", "text"))
