"""Benchmark decontamination with a distributed positional inverted index.

The index is stored once: a row (segment) for each ``SEGMENT_BYTES`` of training text, cut between documents.
A segment holds, for every word of its documents, the ascending list of its positions; positions go on from
document to document with ``GAP`` places left free, so nothing that is looked for crosses a border.
Segments are written where their documents are read: no text or posting is shuffled, and a word or passage that a
third of all documents share is a longer list in each segment, never one group.

A search takes the windows of the test items, in blocks of ``ITEM_BYTES`` of item text.  In each segment a window
takes the list of its rarest word there, moves it back by the word's offset, and intersects it with the moved
lists of the next rarer words until none or all have passed: exact phrase matches.  ``slop`` also gives proximity
matches: documents in which all different words of a window lie, in any order, within its length plus ``slop``
consecutive words.  All windows of a block are searched together, in arrays of at most ``CANDIDATES`` places.

Words are compared by 64-bit hashes.

Defined cases: a null or empty text has no words and no windows; rows that repeat a doc_id, or have none, are
documents of their own; rows that repeat an item_id are one item; an item without an id marks words, but is
not counted or named; an empty table on either side gives no matches; other columns are not returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored, table
from starloom.llm.shingles import text_bytes, word_hashes

WINDOW = 10
SEGMENT_BYTES = 4_000_000  # text of a segment; a longer document is one of its own
ITEM_BYTES = 16_000_000  # item text that is searched, and sent to the tasks, at a time
CANDIDATES = 1_000_000  # places that are looked at together
GAP = 64  # free positions between documents; proximity spans are no longer

# Word characters after lower-casing A-Z: digits, letters and everything beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

SEGMENT = "segment long, doc_ids array<long>, lengths array<int>, terms array<long>, counts array<int>, positions binary"
FOUND = "segment long, ordinal int, spans array<struct<start:int,end:int>>, items array<long>, near array<long>"


def _starts(lengths: np.ndarray) -> np.ndarray:
    """Position of each document's first word, and the end of all positions."""
    return np.concatenate([[0], np.cumsum(lengths + GAP)]).astype(np.int64)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The segments of ``docs``, stored."""
    def run(batches):
        from pyspark import TaskContext
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SEGMENT_BYTES, "right")) - 1)
                stop = min(stop, batch.num_rows)
                words, before = word_hashes(data[offsets[at]:offsets[stop]], offsets[at:stop + 1] - offsets[at], LETTERS)
                lengths = np.diff(before)
                position = np.arange(len(words)) + np.repeat(GAP * np.arange(len(lengths)), lengths)
                order = np.argsort(words, kind="stable")
                terms, counts = np.unique(words, return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array([segment], pa.int64()), pa.array([batch.column("doc_id").slice(at, stop - at).to_pylist()], pa.list_(pa.int64())),
                    pa.array([lengths.astype(np.int32)], pa.list_(pa.int32())), pa.array([terms.view(np.int64)], pa.list_(pa.int64())),
                    pa.array([counts.astype(np.int32)], pa.list_(pa.int32())), pa.array([position[order].astype(np.int32).tobytes()], pa.binary()),
                ], names=["segment", "doc_ids", "lengths", "terms", "counts", "positions"])
                segment, at = segment + 1, stop

    return stored(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SEGMENT))


class Windows:
    """The different windows of a block of items, and the items of each."""

    def __init__(self, ids: list, texts: pa.Array, width: int):
        data, offsets = text_bytes(texts)
        words, before = word_hashes(data[:offsets[-1]], offsets - offsets[0], LETTERS)
        lengths = np.diff(before)
        size = np.minimum(lengths, width)
        many = np.where(lengths > 0, lengths - size + 1, 0)
        item = np.repeat(np.arange(len(lengths)), many)
        first = before[:-1][item] + np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
        size = size[item]
        within = np.arange(width)[None, :] < size[:, None]
        self.vocabulary, codes = np.unique(words, return_inverse=True)
        place = np.minimum(first[:, None] + np.arange(width), max(len(words) - 1, 0))
        rows = np.where(within, codes[place] if len(words) else 0, -1)
        self.rows, which = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.zeros(0, np.int64))
        self.sizes = (self.rows >= 0).sum(1)
        named = np.array([i is not None for i in ids], bool)[item] if len(item) else np.zeros(0, bool)
        pairs = np.unique(np.stack([which.ravel()[named], item[named]]), axis=1)
        self.ids = np.array([i or 0 for i in ids], np.int64)
        self.items, self.item_starts = pairs[1], np.searchsorted(pairs[0], np.arange(len(self.rows) + 1))

    def items_of(self, owner: np.ndarray, windows: np.ndarray) -> dict[int, list[int]]:
        """The ids of the items whose windows ``owner`` has."""
        pairs = np.unique(np.stack([owner, windows]), axis=1)
        many = np.diff(self.item_starts)[pairs[1]]
        at = np.arange(many.sum()) + np.repeat(self.item_starts[pairs[1]] - (np.cumsum(many) - many), many)
        got = np.unique(np.stack([np.repeat(pairs[0], many), self.ids[self.items[at]]]), axis=1)
        cut = np.flatnonzero(np.diff(got[0])) + 1
        return {int(o[0]): i.tolist() for o, i in zip(np.split(got[0], cut), np.split(got[1], cut)) if len(o)}


class Segment:
    """One segment's lists of the words that the windows use."""

    def __init__(self, windows: Windows, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, length: int):
        self.windows, self.length = windows, length
        at = np.minimum(np.searchsorted(terms, windows.vocabulary), max(len(terms) - 1, 0))
        known = terms[at] == windows.vocabulary if len(terms) else np.zeros(len(at), bool)
        self.many = np.where(known, counts[at] if len(terms) else 0, 0).astype(np.int64)
        begin = (np.cumsum(counts) - counts)[at] if len(terms) else np.zeros(len(at), np.int64)
        self.begin = np.cumsum(self.many) - self.many
        source = np.arange(self.many.sum()) + np.repeat(begin - self.begin, self.many)
        self.places = positions[source].astype(np.int64)
        self.keys = np.repeat(np.arange(len(self.many)), self.many) * length + self.places

        # of each window whose words all occur: its offsets, the rarest word's first
        often = np.where(windows.rows >= 0, self.many[windows.rows], np.iinfo(np.int64).max)
        self.alive = np.flatnonzero(often.min(1) > 0) if len(often) else np.zeros(0, np.int64)
        self.order = np.argsort(often[self.alive], axis=1, kind="stable")

    def first_lists(self):
        """(window, row of ``alive``, position of its rarest word), in bounded parts."""
        rarest = self.windows.rows[self.alive, self.order[:, 0]] if len(self.alive) else np.zeros(0, np.int64)
        many = self.many[rarest]
        ends = np.cumsum(many)
        for begin in range(0, int(ends[-1]) if len(ends) else 0, CANDIDATES):
            flat = np.arange(begin, min(begin + CANDIDATES, int(ends[-1])))
            row = np.searchsorted(ends, flat, "right")
            yield row, self.places[self.begin[rarest[row]] + flat - (ends - many)[row]]

    def has(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the list of ``term`` has a position from ``low`` to ``high``."""
        at = np.searchsorted(self.keys, term * self.length + np.maximum(low, 0))
        found = self.keys[np.minimum(at, len(self.keys) - 1)]
        return (at < len(self.keys)) & (found <= term * self.length + np.minimum(high, self.length - 1))

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """(window, position of its first word) of every occurrence."""
        out = [np.zeros((2, 0), np.int64)]
        for row, place in self.first_lists():
            start = place - self.order[row, 0]
            for turn in range(1, self.windows.rows.shape[1]):
                offset = self.order[row, turn]
                term = self.windows.rows[self.alive[row], offset]
                at = start + offset
                keep = (term < 0) | ((start >= 0) & (at < self.length) & self.has(np.maximum(term, 0), at, at))
                row, start = row[keep], start[keep]
            out.append(np.stack([self.alive[row], start]))
        return tuple(np.concatenate(out, axis=1))

    def nearby(self, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, position of its rarest word) where all its words lie within its length plus ``slop`` words."""
        out = [np.zeros((2, 0), np.int64)]
        for row, place in self.first_lists():
            span = self.windows.sizes[self.alive[row]] + slop
            for turn in range(1, self.windows.rows.shape[1]):
                term = self.windows.rows[self.alive[row], self.order[row, turn]]
                keep = (term < 0) | self.has(np.maximum(term, 0), place - span + 1, place + span - 1)
                row, place, span = row[keep], place[keep], span[keep]
            good = np.zeros(len(row), bool)
            for back in range(int(span.max()) if len(span) else 0):  # the span's first word is so far before the place
                low = place - back
                fits = ~good & (back < span)
                for offset in range(self.windows.rows.shape[1]):
                    term = self.windows.rows[self.alive[row], offset]
                    some = np.flatnonzero(fits & (term >= 0))
                    fits[some] = self.has(term[some], low[some], low[some] + span[some] - 1)
                good |= fits
            out.append(np.stack([self.alive[row[good]], place[good]]))
        return tuple(np.concatenate(out, axis=1))


def _search_segment(windows: Windows, row: dict, slop: int | None) -> list[tuple]:
    """(ordinal, spans of hit words, items, items nearby) of the documents of a segment that have matches."""
    lengths = np.array(row["lengths"], np.int64)
    starts = _starts(lengths)
    segment = Segment(windows, np.array(row["terms"], np.int64).view(np.uint64), np.array(row["counts"], np.int64),
                      np.frombuffer(row["positions"], np.int32), int(starts[-1]))
    window, first = segment.phrases()
    hit = np.zeros(int(starts[-1]) + 1, np.int64)
    np.add.at(hit, first, 1)
    np.add.at(hit, first + windows.sizes[window], -1)
    edge = np.diff(np.concatenate([[0], (np.cumsum(hit) > 0).astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(starts, begin, "right") - 1
    spans: dict[int, list] = {}
    for o, a, b in zip(owner.tolist(), (begin - starts[owner]).tolist(), (end - starts[owner]).tolist()):
        spans.setdefault(o, []).append({"start": a, "end": b})
    items = windows.items_of(np.searchsorted(starts, first, "right") - 1, window)
    near: dict[int, list] = {}
    if slop is not None:
        window, place = segment.nearby(slop)
        near = windows.items_of(np.searchsorted(starts, place, "right") - 1, window)
    return [(o, spans.get(o, []), items.get(o, []), near.get(o, [])) for o in sorted(spans.keys() | near.keys())]


def _blocks(items: DataFrame, key: str, text: str):
    """(ids, texts) of the items, ``ITEM_BYTES`` of text or one long item at a time."""
    rows = items.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).filter("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = 1 + total // ITEM_BYTES
    rows = stored(rows) if count > 1 else rows
    for block in range(count):
        some = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == block).toArrow()
        yield some.column("id").to_pylist(), some.column("text")


def search(index: DataFrame, items: DataFrame, width: int = WINDOW, slop: int | None = None, key: str = "item_id", text: str = "text") -> DataFrame:
    """(segment, ordinal, spans, items, near) of every document with a match.

    ``spans`` are the words inside phrase matches, ``items`` the ids of the items whose windows occur,
    ``near`` those with a proximity match (none without ``slop``).
    """
    if slop is not None and width + slop > GAP:
        raise ValueError(f"width + slop may not exceed {GAP}")
    spark, found = index.sparkSession, None
    for ids, texts in _blocks(items, key, text):
        windows = spark.sparkContext.broadcast(Windows(ids, texts, width))

        def run(batches, windows=windows):
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {"lengths": batch.column("lengths")[i].values, "terms": batch.column("terms")[i].values,
                           "counts": batch.column("counts")[i].values, "positions": batch.column("positions")[i].as_buffer()}
                    got = _search_segment(windows.value, row, slop)
                    if got:
                        segment = batch.column("segment")[i].as_py()
                        yield pa.RecordBatch.from_pylist([{"segment": segment, "ordinal": o, "spans": s, "items": t, "near": u} for o, s, t, u in got], schema)

        schema = pa.schema([("segment", pa.int64()), ("ordinal", pa.int32()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                            ("items", pa.list_(pa.int64())), ("near", pa.list_(pa.int64()))])
        part = stored(index.drop("doc_ids").mapInArrow(run, FOUND))
        found = part if found is None else found.unionByName(part)
    together = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    return found.groupBy("segment", "ordinal").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), together("items").alias("items"), together("near").alias("near"))


def covered(spans):
    """Number of words in ascending ``spans`` that may overlap."""
    def step(s, x):
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), (s["n"] + F.greatest(x["end"] - F.greatest(x["start"], s["at"]), F.lit(0))).alias("n"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("n")), step, lambda s: s["n"])


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, slop: int | None = None) -> DataFrame:
    """A row a document: doc_id, n_words, spans, items and near of :func:`search`."""
    index = build_index(docs)
    found = search(index, items, width, slop)
    rows = (index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("ordinal", "doc"))
            .select("segment", "ordinal", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.lengths").cast("long").alias("n_words")))
    empty = lambda c, kind: F.coalesce(c, F.expr(f"cast(array() as {kind})")).alias(c)
    return rows.join(found, ["segment", "ordinal"], "left").select(
        "doc_id", "n_words", empty("spans", "array<struct<start:int,end:int>>"), empty("items", "array<long>"), empty("near", "array<long>"))


def op12_phrase_index(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = covered(F.col("spans"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


OP12_SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, COALESCE(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ')
    FOR i IN range(1, greatest(len(w) - 10, 0) + 2)]) AS s
  FROM items WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM windows), grams AS (
  SELECT r, size, unnest(range(1, len(w) - size + 2)) AS i, unnest([array_to_string(w[j:j + size - 1], ' ') FOR j IN range(1, len(w) - size + 2)]) AS s
  FROM docs, sizes WHERE len(w) >= size
), matches AS (
  SELECT g.r, g.i, g.size, x.item_id FROM grams g JOIN windows x ON x.s = g.s AND x.size = g.size
), hits AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + size)) AS p FROM matches) GROUP BY r
), named AS (
  SELECT r, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS name FROM matches WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, COALESCE(h.n, 0)::BIGINT AS n_hit, COALESCE(m.n, 0)::BIGINT AS n_items,
  sha256(COALESCE(m.names, '')) AS items_sha256, COALESCE(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON h.r = d.r LEFT JOIN named m ON m.r = d.r
"""
