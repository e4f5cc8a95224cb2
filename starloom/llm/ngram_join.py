"""Near-duplicate documents by a size-aware n-gram Jaccard join.

A document's set holds its distinct word shingles; two documents link when the Jaccard similarity
of their sets reaches ``percent``.  Sets of n and m shingles that link share at least
t(n, m) = ceil(percent * (n + m) / (100 + percent)) of them.

Light sets (few shingles): every subset of t(n, m) shingles is a key, for each partner size m that can
link; sets that meet under a key share t(n, m) shingles and link without another look.
Heavy sets: inverted lists of each set's rarest shingles, n - ceil(percent * n / 100) + L(n) of them, are
scanned, L(n) = ``MEETINGS`` + n / ``SPARE``.  Sets that link meet in at least min(L(n), L(m)) lists.  Each set then leaves the
longest of its lists, L(ceil(percent * n / 100)) - ``MEETINGS`` of them by (length, key): linked sets still meet
``MEETINGS`` times, while shingles that unrelated documents share by chance are mostly left.
Lists hold light sets too where their sizes can link with heavy ones.  The boundary between light and
heavy minimises the number of keys plus ``SCAN_COST`` times the list entries, from the histogram of set sizes.

Rarity comes from counts of all shingles of all documents in 2**18 hashed bins; it only orders the
shingles, so any error in it costs time, never a link.  Equal sets are one node from the start.

Lists are not expanded into pairs.  In ``STAR_ROUNDS`` rounds every member of a list is verified against the
member with the fewest shingles of its own, and lists whose members are all connected are set aside.  Of the lists
that are left, those of at most ``CROWD`` members give pairs (at most ``CROWD`` / 2 a member), which are verified where they
meet ``MEETINGS`` times.  Longer lists are gathered by that same member into groups, and a group is compared in blocks
of ``BLOCK`` whole sets a side, which give only the links that connect something new.

Words and sets are compared by 64-bit hashes.

Defined cases: a null or empty text, or one without words, has the empty set and links with nothing, its
component is its own id; fewer words than a shingle give one shingle of them all; repeated rows
are equal sets; rows without an id link like others, but give a component no id; an empty table gives an empty result; other columns are not returned.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import memory_returned, stored, table
from starloom.llm.components import components
from starloom.llm.shingles import mix, shingle_sets
from starloom.llm.url_filter import build_level

BIN_BITS = 18
MOST_LIGHT = 40  # the largest set size that is considered as light
SCAN_COST = 4.0  # cost of a list entry, its share of a verification included, in subset keys
STAR_ROUNDS = 2
MEETINGS = 3  # lists in which two sets must meet after each has left its longest lists
SPARE = 20  # a set is entered into one more list, to leave the longest, for so many shingles
CROWD = 32  # longest list whose members are paired
BLOCK = 512  # sets of a group that are compared with so many others in one task
SETS_AT_ONCE = 512  # entries (a set's keys of one kind, or whole sets) that are sent on together
FILTER_BITS = 1 << 23  # most bits of the filter that finds the documents of sets to verify
BOTH = 2  # the side of a block that is compared with itself; others are 0 and 1
PLAIN, LESSER, GREATER, LISTED = 0, 1, 2, 3  # what a key's row is: equal sizes, smaller set, larger set, list entry


def least_overlap(n, m, percent: int):
    """t(n, m), for numbers or columns of them."""
    return -((-percent * (n + m)) // (100 + percent))


def prefix_length(n, percent: int):
    """Rarest shingles that are entered: sets that link meet min(L(n), L(m), t(n, m)) times."""
    return min(n, n + (-percent * n) // 100 + MEETINGS + n // SPARE)


def prefix_column(percent: int):
    """:func:`prefix_length` of the column ``n``: it follows from the size, so no key carries it."""
    return F.expr(f"least(n, n - ({percent} * n + 99) div 100 + {MEETINGS} + n div {SPARE})")


def partner_sizes(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subset_cost(n: int, percent: int) -> int:
    return sum(comb(n, least_overlap(n, m, percent)) for m in partner_sizes(n, percent))


def light_boundary(histogram: dict[int, int], percent: int) -> int:
    """The largest light size: the cheapest split of the sets between subset keys and inverted lists."""
    def cost(boundary: int) -> float:
        keys = sum(c * subset_cost(n, percent) for n, c in histogram.items() if n <= boundary)
        entries = sum(c * prefix_length(n, percent) for n, c in histogram.items()
                      if n > boundary or max(partner_sizes(n, percent)) > boundary)
        return keys + SCAN_COST * entries

    return min(range(MOST_LIGHT + 1), key=cost)


def set_id(shingles: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(shingles).sum() + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_id, n, set_id) a row, and (bin, seen) rows: shingles of the documents by hashed bin."""
    def run(batches):
        bins = np.zeros(1 << BIN_BITS, np.int64)
        for batch in batches:
            n, ids = [], []
            for shingles in shingle_sets(batch.column("text"), k):
                n.append(len(shingles))
                ids.append(set_id(shingles) if len(shingles) else None)
                np.add.at(bins, (shingles >> np.uint64(64 - BIN_BITS)).astype(np.int64), 1)
            rows = len(n)
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_id"), pa.array(n, pa.int32()), pa.array(ids, pa.int64()),
                                   pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int64())], schema=out)
        at = np.flatnonzero(bins)
        for part in np.array_split(at, 1 + len(at) // 50_000):
            rows = len(part)
            yield pa.record_batch([pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int64()),
                                   pa.array(part, pa.int32()), pa.array(bins[part])], schema=out)

    out = pa.schema([("doc_id", pa.int64()), ("text_id", pa.int64()), ("n", pa.int32()), ("set_id", pa.int64()), ("bin", pa.int32()), ("seen", pa.int64())])
    return docs.withColumn("text_id", F.xxhash64("text")).mapInArrow(memory_returned(run), "doc_id long, text_id long, n int, set_id long, bin int, seen long")


def keys_of(docs: DataFrame, k: int, percent: int, boundary: int, rarity) -> DataFrame:
    """(kind, key, set_id, n): subset keys of light sets, list entries of heavy ones; equal sets once a task."""
    def subset_keys(shingles: np.ndarray):
        n, marks = len(shingles), mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
        for m in partner_sizes(n, percent):
            if not 0 < m <= boundary:
                continue
            t, tag = least_overlap(n, m, percent), np.uint64(max(n, m) * 1000 + min(n, m))
            at = np.array(list(combinations(range(n), t)), np.int64).reshape(-1, t)
            kind = PLAIN if n == m else GREATER if n > m else LESSER
            yield kind, mix(marks[at].sum(1) + tag)

    def run(batches):
        counts, done = rarity.value, set()  # ids of the task's own sets
        held: list[tuple] = []

        def add(kind, key, own, n):
            held.append((kind, _signed(key), own, n))

        def flushed():
            sizes = [len(x[1]) for x in held]
            whole = [np.repeat(np.array([x[c] for x in held], kind), sizes) if c != 1 else np.concatenate([x[1] for x in held])
                     for c, kind in enumerate((np.int32, np.int64, np.int64, np.int32))]
            held.clear()
            return pa.record_batch([pa.array(x) for x in whole], names=["kind", "key", "set_id", "n"])

        for batch in batches:
            for shingles in shingle_sets(batch.column("text"), k):
                n = len(shingles)
                own = set_id(shingles) if n else None
                if n == 0 or own in done:
                    continue
                done.add(own)
                if n <= boundary:
                    for kind, key in subset_keys(shingles):
                        add(kind, key, own, n)
                if n > boundary or max(partner_sizes(n, percent)) > boundary:
                    p = prefix_length(n, percent)
                    seen = counts[(shingles >> np.uint64(64 - BIN_BITS)).astype(np.int64)]
                    rare = np.argpartition(seen, p - 1)[:p] if p < n else np.arange(n)
                    # all shingles at most as frequent as the p-th, in (count, hash) order
                    within = np.flatnonzero(seen <= seen[rare].max())
                    first = within[np.lexsort((shingles[within], seen[within]))[:p]]
                    add(LISTED, shingles[first], own, n)
                if len(held) >= SETS_AT_ONCE:
                    yield flushed()
        if held:
            yield flushed()

    return docs.select("text").mapInArrow(memory_returned(run), "kind int, key long, set_id long, n int")


def whole_sets(docs: DataFrame, rows: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(set_id, shingles binary) of the sets in ``ids`` (set_id), each once; a few others may come with them.

    A Bloom filter of bounded size picks the documents before their shingles are made, so no text is shuffled, another
    one the sets made from them.  Rows without an id are picked where a set occurs in no other.
    """
    def run(batches):
        for some in (batch.slice(i, SETS_AT_ONCE) for batch in batches for i in range(0, batch.num_rows, SETS_AT_ONCE)):
            ids, sets = [], []
            for shingles in shingle_sets(some.column("text"), k):
                ids.append(set_id(shingles) if len(shingles) else None)
                sets.append(shingles.tobytes())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], schema=out)

    out = pa.schema([("set_id", pa.int64()), ("shingles", pa.binary())])
    wanted = stored(ids.distinct().join(rows.filter("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("doc_id")), "set_id"))
    known, n = wanted.filter("doc_id is not null"), wanted.count()
    passes = build_level(known.select(F.col("doc_id").alias("key")), known.count(), 0.05, 9, FILTER_BITS)
    picked = F.col("doc_id").isNotNull() & passes.passes(F.col("doc_id"))
    if not wanted.filter("doc_id is null").isEmpty():
        picked = picked | F.col("doc_id").isNull()
    of_wanted = build_level(wanted.select(F.col("set_id").alias("key")), n, 0.05, 10, FILTER_BITS)
    made = docs.filter(picked).select("text").mapInArrow(memory_returned(run), "set_id long, shingles binary")
    return made.filter(F.col("set_id").isNotNull() & of_wanted.passes(F.col("set_id"))).dropDuplicates(["set_id"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose whole sets reach the similarity."""
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x")), "a")
    with_b = with_a.join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y")), "b")
    return with_b.select("a", "b", "x", "y").mapInArrow(memory_returned(run), "a long, b long")


def light_links(live: DataFrame) -> DataFrame:
    """Links of the sets under one subset key: to the least of the other side."""
    over = Window.partitionBy("kind_key", "key")
    least = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("set_id"))).over(over)
    keyed = live.filter(F.col("kind") != LISTED).withColumn("kind_key", F.col("kind") == PLAIN)
    other = (F.when(F.col("kind") == PLAIN, least(PLAIN)).when(F.col("kind") == GREATER, least(LESSER)).otherwise(least(GREATER)))
    return (keyed.select(F.col("set_id").alias("a"), other.alias("b")).filter("b is not null and a <> b").distinct())


def overlap_column(n, m, percent: int):
    return F.ceil(percent * (n + m) / F.lit(100 + percent) - 1e-9)


def _block_links(percent: int):
    """Links between the two sides of a block pair that connect different components."""
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        left, right = (group[group["side"].isin([side, BOTH])].sort_values("set_id") for side in (0, 1))
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        ours = [np.frombuffer(x, np.uint64) for x in left["shingles"]]
        theirs = sorted(((np.frombuffer(x, np.uint64), i, c) for x, i, c in zip(right["shingles"], right["set_id"], right["component"])),
                        key=lambda x: len(x[0]))
        sizes = np.array([len(x[0]) for x in theirs])
        ids, parts = np.array([x[1] for x in theirs]), np.array([x[2] for x in theirs])
        tokens, place = np.unique(np.concatenate([x[0] for x in theirs]), return_inverse=True)
        starts, marked = np.concatenate([[0], np.cumsum(sizes)]), np.zeros(len(tokens) + 1, np.int32)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        out = []
        for shingles, own, component in zip(ours, left["set_id"], left["component"]):
            n = len(shingles)
            low, high = np.searchsorted(sizes, -(-percent * n // 100)), np.searchsorted(sizes, 100 * n // percent, "right")
            if low >= high or (parts[low:high] == component).all():
                continue
            at = np.minimum(np.searchsorted(tokens, shingles), len(tokens) - 1)
            at = at[tokens[at] == shingles]
            marked[at] = 1
            common = np.add.reduceat(marked[place[starts[low]:starts[high]]], starts[low:high] - starts[low])
            marked[at] = 0
            linked = (100 * common >= percent * (n + sizes[low:high] - common)) & (parts[low:high] != component)
            for b, other in zip(ids[low:high][linked].tolist(), parts[low:high][linked].tolist()):
                x, y = find(component), find(other)
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((own, b))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")
    return run


def crowd_links(crowded: DataFrame, docs: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame:
    """Links among the members of long lists (star, set_id, component): each star's group in blocks."""
    met = crowded.select("star", "set_id", "component").distinct()
    blocks = met.groupBy("star").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = met.join(blocks, "star").withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    # a block that meets itself is sent once, as both sides
    sides = stored(placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "star", "set_id", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") == F.col("other"), F.lit(BOTH)).otherwise((F.col("block") > F.col("other")).cast("int")).alias("side")))
    sets = stored(whole_sets(docs, rows, sides.select("set_id"), k))
    return sides.join(sets, "set_id").groupBy("star", "i", "j").applyInPandas(_block_links(percent), "a long, b long")


def heavy_links(live: DataFrame, docs: DataFrame, rows: DataFrame, links: DataFrame, k: int, percent: int, boundary: int) -> DataFrame:
    """All links of ``links`` and those that connect further members of the inverted lists."""
    listed = live.filter(F.col("kind") == LISTED).select("key", "set_id", "n", "own")
    over = Window.partitionBy("key")
    n, m = F.col("n"), F.col("m")
    fit = ((n > boundary) | (m > boundary)) & (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (F.col("component") != F.col("other"))

    def pair_sets(pairs: DataFrame) -> DataFrame:
        both = pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id")))
        # stored: a join over an aggregate of its own stage could not have its skewed partitions split
        return stored(whole_sets(docs, rows, both, k))

    def met_often(met: DataFrame) -> DataFrame:
        least = F.least(F.lit(MEETINGS), overlap_column(n, m, percent))
        return (met.filter(fit).groupBy(F.col("set_id").alias("a"), "b").agg(F.count(F.lit(1)).alias("times"), F.max(least).alias("least"))
                .filter("times >= least"))

    for turn in range(STAR_ROUNDS + 1):
        labels = components(links).withColumnRenamed("node", "set_id")
        draw = F.struct("own", F.xxhash64("set_id", F.lit(turn)).alias("draw"), F.col("set_id").alias("b"), F.col("n").alias("m"),
                        F.col("component").alias("other"))
        entries = stored(listed.join(labels, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
                         .withColumn("_low", F.min("component").over(over)).withColumn("_high", F.max("component").over(over))
                         .withColumn("_members", F.count(F.lit(1)).over(over)).withColumn("_star", F.min(draw).over(over))
                         .filter("_low <> _high").select("key", "set_id", "n", "component", "_members", "_star.b", "_star.m", "_star.other"), "zstd")
        if turn < STAR_ROUNDS:
            met = met_often(entries.select("set_id", "n", "component", "b", "m", "other"))
            pairs = stored(met.groupBy("a").agg(F.max_by("b", F.struct("times", "b")).alias("b")))
            links = stored(links.unionByName(verified(pairs, pair_sets(pairs), percent)))
    few = entries.filter(F.col("_members") <= CROWD).select("key", "set_id", "n", "component")
    partner = few.select("key", F.col("set_id").alias("b"), F.col("n").alias("m"), F.col("component").alias("other"))
    pairs = stored(met_often(few.join(partner, "key").filter(F.col("set_id") < F.col("b"))).select("a", "b"))
    crowded = entries.filter(F.col("_members") > CROWD).select(F.col("b").alias("star"), "set_id", "component")
    return stored(links.unionByName(verified(pairs, pair_sets(pairs), percent)).unionByName(crowd_links(crowded, docs, rows, k, percent)))


def jaccard_rows(docs: DataFrame, k: int, percent: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_id, n_shingles, component, component_id) for every row of ``docs``.

    ``text_id`` is xxhash64 of the text; ``component`` names the linked sets, null for the empty set.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    first = stored(signatures(docs, k), "zstd")
    rows = first.filter("bin is null").select("doc_id", "text_id", "n", "set_id")
    sizes = rows.filter(f"n between 1 and {MOST_LIGHT * 2}").groupBy("n").agg(F.countDistinct("set_id").alias("c")).collect()
    boundary = light_boundary({r["n"]: r["c"] for r in sizes}, percent)
    counted = first.filter("bin is not null").groupBy("bin").agg(F.sum("seen").alias("seen")).toArrow()
    counts = np.zeros(1 << BIN_BITS, np.int64)  # the broadcast table: 2 MB, whatever the corpus
    counts[counted["bin"].to_numpy()] = counted["seen"].to_numpy()

    keys = keys_of(docs, k, percent, boundary, spark.sparkContext.broadcast(counts))
    over = Window.partitionBy("key")
    shared = (keys.repartition("key").dropDuplicates(["key", "kind", "set_id"])
              .withColumn("_n", F.count(F.lit(1)).over(over)).filter("_n > 1"))
    shared = shared.withColumn("_listed", F.col("kind") == LISTED)  # named, so that both windows share one exchange
    of_set = Window.partitionBy("set_id", "_listed")
    left = F.expr(f"cast(ceil({percent} * n / 100.0 - 1e-9) as int) div {SPARE}")  # lists that a set of n leaves
    live = stored(shared.withColumn("_rank", F.row_number().over(of_set.orderBy(F.desc("_n"), "key")))
                  .withColumn("own", prefix_column(percent) - F.count(F.lit(1)).over(of_set))  # of a list entry: shingles that no other set lists
                  .filter(~F.col("_listed") | (F.col("_rank") > left)).drop("_n", "_rank", "_listed"), "zstd")
    links = heavy_links(live, docs, rows, stored(light_links(live)), k, percent, boundary)

    labels = components(links).withColumnRenamed("node", "set_id")
    nodes = (rows.filter("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least"))
             .join(labels, "set_id", "left").withColumn("component", F.coalesce("component", "set_id")))
    named = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = nodes.join(named, "component").select("set_id", "component", "component_id")
    return (rows.join(by_set, "set_id", "left").select("doc_id", "text_id", F.col("n").cast("long").alias("n_shingles"), "component",
                                                       F.coalesce("component_id", "doc_id").alias("component_id")))


def jaccard_components(docs: DataFrame, k: int, percent: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    return jaccard_rows(docs, k, percent, key, text).select("doc_id", "n_shingles", "component_id")


def op3_ngram_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
)
SELECT d.doc_id, COALESCE(s.n, 0)::BIGINT AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""
