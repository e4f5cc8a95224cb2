"""Cross-tokenizer alignment by an associative monoid of text fragments.

Two tokenizers cut the same bytes.  A byte offset where tokens of both end is a cut; the tokens between cuts are a group,
and the two tokens that end at a cut are linked.  A byte range of a text gives a fragment: the open prefix (tokens up
to its first cut), the closed groups between its cuts, and the open suffix (tokens after its last cut).  Fragments
compose: the left suffix and the right prefix join into one group, or stay open where a side has no cut.  Composition is
associative, so fragments of one text are reduced as a tree, ``FAN`` neighbours at a time, by Spark aggregates.

A text of at most ``RANGE_BYTES`` is one range, and its fragment is closed where the text is read.  A longer text is dealt out as
byte ranges to all tasks.  A range's tokens are those that end in it.  They are found without the rest of the text: both
tokenizers never join a character that is not white space to a space after it, so a range is encoded from the last such
place before it to the first one after it (the model files are tested for this on loading).  A range border that has no such
place of its own is left out, so a run without spaces is encoded by one task, at most twice.

How often an id pair is linked in the corpus is counted from tables of blocks (texts of ``BLOCK_BYTES`` together): a block sends each of
its different pairs once, to be added up, and gets the sums back, so a pair that occurs in every text is one row a block.

Defined cases: null and empty texts, and texts whose tokens' bytes differ from the text's, have no tokens; rows that repeat a
doc_id, or have none, are texts of their own; an empty table gives an empty result; other columns are not returned.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.bpe import byte_alphabet, tokenizer_path
from starloom.llm.common import stored, table

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
RANGE_BYTES = 32_768
BLOCK_BYTES = 2_000_000
FAN = 8
CACHE_CHUNKS, CACHE_BYTES = 300_000, 8_000_000  # chunks whose tokens a worker keeps, and their text; then it starts anew
ROWS_AT_ONCE = 16  # ranges that are taken out of a batch together
TOGETHER = 64  # chunks that are encoded as one text
# A chunk: a space, and all up to the next space that follows something else than white space.
_CHUNK = re.compile(r" \s*(?:\S+(?:[^\S ]\s*\S+)*(?:[^\S ]\s*\Z)?)?")

FRAGMENT = "struct<cut:boolean,head_a:string,head_b:string,body:string,tail_a:string,tail_b:string>"


class TokenizerPair:
    """Both tokenizers, the bytes of their ids, and the tokens of chunks seen before."""

    def __init__(self, spec_a: str, model_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers
        self.a = tokenizers.Tokenizer.from_str(spec_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        byte_of = {c: i for i, c in enumerate(byte_alphabet())}
        names = {i: name for name, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(byte_of.get(c, 63) for c in names.get(i, "")) for i in range(max(names) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id("▁")
        self._test_cuts(json.loads(spec_a), pieces)
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # decimal ids with what may follow them: in A a comma or the bar, in B a comma, the semicolon or nothing
        self.names = pa.array([f"{i}{end}" for i in range(len(self.bytes_a)) for end in ",|"]
                              + [f"{i}{end}" for i in range(len(self.bytes_b)) for end in (",", ";", "")])
        self._clear()

    def _test_cuts(self, spec_a: dict, pieces: list[str]) -> None:
        """No token of either may hold a space after a character that is none."""
        split = spec_a["pre_tokenizer"]
        plain = spec_a["normalizer"] is None and split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
        if not plain or any(p.lstrip("▁").count("▁") for p in pieces):
            raise ValueError("these tokenizers can join a character to a space after it")

    def _clear(self, most: int = 0):
        most = max(most, CACHE_CHUNKS)
        self.known, self.kept_bytes = {}, 0
        self.same = np.zeros(most, bool)
        # of A and of B: the tokens of all chunks, and where each chunk's begin
        self.flat, self.starts = [np.zeros(1 << 16, np.int32) for _ in "ab"], [np.zeros(most + 1, np.int64) for _ in "ab"]

    def _ids(self, texts: list[str]) -> list[list[np.ndarray]]:
        """The tokens of A and of B of texts that begin with a space; the second tokenizer adds that itself."""
        return [[np.array(e.ids, np.int64) for e in self.a.encode_batch_fast(texts, add_special_tokens=False)],
                # the library takes the added space alone for an empty text
                [np.array(ids or [self.space], np.int64) for ids in self.b.encode([t[1:] for t in texts], num_threads=1)]]

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks and keep their tokens.

        Chunks that end in no white space are encoded many together, since each begins with a safe cut, and told apart by
        their bytes; those of a text whose tokens have other bytes, or do not end with the chunks, again one by one.
        """
        alone = [c for c in chunks if c[-1].isspace()]
        rest = [c for c in chunks if not c[-1].isspace()]
        for i in range(0, len(rest), 4_096):
            groups = [rest[k:min(k + TOGETHER, i + 4_096)] for k in range(i, min(i + 4_096, len(rest)), TOGETHER)]
            for group, a, b in zip(groups, *self._ids(["".join(g) for g in groups])):
                whole = [c.encode("utf-8") for c in group]
                joined, ends = b"".join(whole), np.cumsum([len(w) for w in whole])
                parts = [self._parted(ids, names, sizes, joined, ends) for ids, names, sizes in ((a, self.bytes_a, self.size_a), (b, self.bytes_b, self.size_b))]
                if parts[0] is None or parts[1] is None:
                    alone += group
                else:
                    self._keep(group, [a, b], parts, np.ones(len(group), bool))
        for i in range(0, len(alone), 1_024):
            some = alone[i:i + 1_024]
            got = self._ids(some)
            same = [all(b"".join([names[t] for t in ids.tolist()]) == c.encode("utf-8") for ids, names in ((a, self.bytes_a), (b, self.bytes_b)))
                    for c, a, b in zip(some, *got)]
            self._keep(some, [np.concatenate(rows) for rows in got], [np.array([len(r) for r in rows]) for rows in got], np.array(same, bool))

    @staticmethod
    def _parted(ids: np.ndarray, names: list[bytes], sizes: np.ndarray, whole: bytes, ends: np.ndarray) -> np.ndarray | None:
        """Tokens up to each of the ends, as counts; None where the bytes differ or an end is inside a token."""
        if b"".join([names[t] for t in ids.tolist()]) != whole:
            return None
        stops = np.cumsum(sizes[ids])
        at = np.searchsorted(stops, ends)
        return np.diff(at, prepend=-1) if (stops[at] == ends).all() else None

    def _keep(self, chunks: list[str], ids: list[np.ndarray], counts: list[np.ndarray], same: np.ndarray) -> None:
        first = len(self.known)
        self.known.update(zip(chunks, range(first, first + len(chunks))))
        self.same[first:first + len(chunks)] = same
        self.kept_bytes += sum(map(len, chunks))
        for side in (0, 1):
            used = self.starts[side][first]
            while used + len(ids[side]) > len(self.flat[side]):
                self.flat[side] = np.concatenate([self.flat[side], np.zeros_like(self.flat[side])])
            self.flat[side][used:used + len(ids[side])] = ids[side]
            self.starts[side][first + 1:first + 1 + len(chunks)] = used + np.cumsum(counts[side])

    def encode(self, texts: list[list[str]]) -> tuple:
        """(ids of A, ids of B, tokens of A a text, tokens of B a text) of texts in chunks, and which have their own bytes.

        Texts without tokens have none of either.
        """
        chunks = [c for some in texts for c in some]
        fresh = {c for c, at in zip(chunks, map(self.known.get, chunks)) if at is None}
        if len(self.known) + len(fresh) > CACHE_CHUNKS or self.kept_bytes > CACHE_BYTES:
            fresh = set(chunks)
            self._clear(len(fresh))
        self.learn(list(fresh))
        many = np.array([len(some) for some in texts], np.int64)
        at = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        owner = np.repeat(np.arange(len(texts)), many)
        good = (many > 0) & (np.bincount(owner[~self.same[at]], minlength=len(texts)) == 0)
        at, owner = at[good[owner]], owner[good[owner]]
        out = []
        for flat, starts in zip(self.flat, self.starts):
            size = starts[at + 1] - starts[at]
            place = np.arange(size.sum()) + np.repeat(starts[at] - (np.cumsum(size) - size), size)
            out.append((flat[place], np.bincount(owner, size, len(texts)).astype(np.int64)))
        return out[0][0], out[1][0], out[0][1], out[1][1], good


def chunks_of(text: str | None) -> list[str]:
    """The text, after a space, cut before every space that follows something else."""
    return _CHUNK.findall(" " + text) if text else []


def byte_ranges(chunks: list[str], width: int) -> list[tuple[list[str], int, int, int]]:
    """(chunks, offset of their first byte, low, high) of the ranges of a text: tokens that end after low and up to high are theirs."""
    sizes = np.array([len(c.encode("utf-8")) for c in chunks], np.int64)
    places = np.concatenate([[0], np.cumsum(sizes)])
    borders, last = [0], 0
    for border in range(width, int(places[-1]), width):
        before = int(np.searchsorted(places, border, "right")) - 1
        if before > last:
            borders.append(border)
            last = before
    borders.append(int(places[-1]))
    out = []
    for low, high in zip(borders, borders[1:]):
        first, stop = int(np.searchsorted(places, low, "right")) - 1, int(np.searchsorted(places, high, "left"))
        out.append((chunks[first:stop], int(places[first]), low, high))
    return out


class Alignment:
    """Tokens of several texts (or one range of a text), their cuts and groups."""

    def __init__(self, pair: TokenizerPair, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray):
        self.pair, self.a, self.b = pair, a, b
        at = np.minimum(np.searchsorted(ends_b, ends_a), max(len(ends_b) - 1, 0))
        self.cut_a = ends_b[at] == ends_a if len(ends_b) else np.zeros(len(a), bool)
        self.cut_b = np.zeros(len(b), bool)
        self.cut_b[at[self.cut_a]] = True
        self.group_a = np.cumsum(self.cut_a) - self.cut_a
        self.group_b = np.cumsum(self.cut_b) - self.cut_b

    def links(self) -> np.ndarray:
        """The linked id pairs, as A * 2**32 + B, in order."""
        return (self.a[self.cut_a].astype(np.int64) << 32) | self.b[self.cut_b]

    def digests(self, n_a: np.ndarray, n_b: np.ndarray) -> list[str]:
        """SHA-256 of each text's groups, ``a1,a2|b1;a3|b2``; "" without tokens."""
        groups = int(self.cut_a.sum())
        many_a, many_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + (np.cumsum(many_b) - many_b)[self.group_a]] = self.a.astype(np.int64) * 2 + self.cut_a
        last = np.zeros(len(self.b), bool)
        last[np.cumsum(n_b)[n_b > 0] - 1] = True
        code[np.arange(len(self.b)) + np.cumsum(many_a)[self.group_b]] = 2 * len(self.pair.bytes_a) + self.b.astype(np.int64) * 3 + self.cut_b + last
        text = self.pair.names.take(pa.array(code)).cast(pa.large_string())
        ends = np.frombuffer(text.buffers()[1], np.int64)[np.concatenate([[0], np.cumsum(n_a + n_b)])] if len(code) else np.zeros(len(n_a) + 1, np.int64)
        data = memoryview(text.buffers()[2]) if len(code) else memoryview(b"")
        return [hashlib.sha256(data[i:j]).hexdigest() if j > i else "" for i, j in zip(ends, ends[1:])]

    def fragment(self) -> dict:
        """The tokens as a fragment."""
        join = lambda ids: ",".join(map(str, ids.tolist()))
        stop_a, stop_b = np.flatnonzero(self.cut_a) + 1, np.flatnonzero(self.cut_b) + 1
        if not len(stop_a):
            return {"cut": False, "head_a": join(self.a), "head_b": join(self.b), "body": "", "tail_a": "", "tail_b": ""}
        body = ";".join(join(self.a[i:j]) + "|" + join(self.b[k:m]) for i, j, k, m in zip(stop_a, stop_a[1:], stop_b, stop_b[1:]))
        return {"cut": True, "head_a": join(self.a[:stop_a[0]]), "head_b": join(self.b[:stop_b[0]]), "body": body,
                "tail_a": join(self.a[stop_a[-1]:]), "tail_b": join(self.b[stop_b[-1]:])}


def _listed(x: Column, y: Column, mark: str) -> Column:
    return F.when(x == "", y).when(y == "", x).otherwise(F.concat(x, F.lit(mark), y))


def empty_fragment() -> Column:
    """The neutral element."""
    return F.struct(F.lit(False).alias("cut"), *[F.lit("").alias(c) for c in ("head_a", "head_b", "body", "tail_a", "tail_b")]).cast(FRAGMENT)


def composed(x: Column, y: Column) -> Column:
    """The fragment of ``x`` and, right after it, ``y``."""
    join = lambda p, q: _listed(p, q, ",")
    closing = F.concat(join(x["tail_a"], y["head_a"]), F.lit("|"), join(x["tail_b"], y["head_b"]))  # the group that is open between them
    both = x["cut"] & y["cut"]
    return F.struct(
        (x["cut"] | y["cut"]).alias("cut"),
        F.when(x["cut"], x["head_a"]).otherwise(join(x["head_a"], y["head_a"])).alias("head_a"),
        F.when(x["cut"], x["head_b"]).otherwise(join(x["head_b"], y["head_b"])).alias("head_b"),
        F.when(both, _listed(_listed(x["body"], closing, ";"), y["body"], ";")).when(x["cut"], x["body"]).otherwise(y["body"]).alias("body"),
        F.when(y["cut"], y["tail_a"]).when(x["cut"], join(x["tail_a"], y["head_a"])).otherwise("").alias("tail_a"),
        F.when(y["cut"], y["tail_b"]).when(x["cut"], join(x["tail_b"], y["head_b"])).otherwise("").alias("tail_b")).cast(FRAGMENT)


def groups_text(fragment: Column) -> Column:
    """The groups of a whole text's fragment."""
    head = F.concat(fragment["head_a"], F.lit("|"), fragment["head_b"])
    return F.when(fragment["cut"], _listed(head, fragment["body"], ";")).otherwise("")


def reduced(fragments: DataFrame) -> DataFrame:
    """(row, fragment): fragments (row, no, fragment) composed in order of ``no``, as a tree."""
    most = fragments.agg(F.max("no")).first()[0] or 0
    while most > 0:
        fragments = stored(fragments.groupBy("row", F.expr(f"no div {FAN}").cast("int").alias("up"))
                           .agg(F.array_sort(F.collect_list(F.struct("no", "fragment"))).alias("parts"))
                           .select("row", F.col("up").alias("no"),
                                   F.aggregate("parts", empty_fragment(), lambda s, x: composed(s, x["fragment"])).alias("fragment")))
        most //= FAN
    return fragments.select("row", "fragment")


# A row is a text ("texts"), a byte range of one to be dealt out ("chunks"), or a block's table of linked pairs ("pairs").
ROW = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("no", pa.int32()), ("n_a", pa.int64()),
                 ("n_b", pa.int64()), ("n_links", pa.int64()), ("sha256", pa.string()), ("good", pa.bool_()), ("codes", pa.list_(pa.int32())),
                 ("times", pa.list_(pa.int64())), ("pairs", pa.list_(pa.int64())), ("chunks", pa.list_(pa.string())), ("start", pa.int64()),
                 ("low", pa.int64()), ("high", pa.int64()),
                 ("fragment", pa.struct([("cut", pa.bool_()), *[(c, pa.string()) for c in ("head_a", "head_b", "body", "tail_a", "tail_b")]]))])
ROW_TYPE = ("kind string, block long, row long, doc_id long, no int, n_a long, n_b long, n_links long, sha256 string, good boolean, codes array<int>, "
            f"times array<long>, pairs array<long>, chunks array<string>, start long, low long, high long, fragment {FRAGMENT}")


@lru_cache(maxsize=1)
def _pair(spec_a: str, model_b: bytes) -> TokenizerPair:
    return TokenizerPair(spec_a, model_b)


def _counted(links: np.ndarray, owner: np.ndarray, rows: int) -> tuple:
    """A block's different links and times, and for each row its codes (places among them) and times."""
    pairs, code = np.unique(links, return_inverse=True)
    seen, times = np.unique(owner * max(len(pairs), 1) + code.ravel(), return_counts=True)
    split = np.searchsorted(seen, np.arange(1, rows) * max(len(pairs), 1))
    total = np.bincount(code.ravel(), minlength=len(pairs))
    return pairs, total, np.split((seen % max(len(pairs), 1)).astype(np.int32), split), np.split(times, split)


def _blocks(sizes: list[int]):
    """Slices of rows of about ``BLOCK_BYTES`` together."""
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and total + size > BLOCK_BYTES:
            yield first, i
            first, total = i, 0
        total += size
    if len(sizes) > first:
        yield first, len(sizes)


def aligned_texts(docs: DataFrame, files) -> DataFrame:
    """Rows of all three kinds from ``docs`` (doc_id, text)."""
    def run(batches):
        from pyspark import TaskContext
        pair = _pair(*files.value)
        block = row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id")
            sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in texts]
            for i, j in _blocks(sizes):
                chunks = [chunks_of(t) if size < RANGE_BYTES else [] for t, size in zip(texts.slice(i, j - i).to_pylist(), sizes[i:j])]
                a, b, n_a, n_b, _ = pair.encode(chunks)
                made = Alignment(pair, a, b, np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b]))
                owner = np.repeat(np.arange(j - i), n_a)[made.cut_a]
                n_links = np.bincount(owner, minlength=j - i)
                pairs, total, codes, times = _counted(made.links(), owner, j - i)
                out = [{"kind": "pairs", "block": block, "pairs": pairs, "times": total}]
                for k, sha256 in enumerate(made.digests(n_a, n_b)):
                    if sizes[i + k] < RANGE_BYTES:
                        out.append({"kind": "texts", "block": block, "row": row + k, "doc_id": ids[i + k].as_py(), "n_a": int(n_a[k]), "n_b": int(n_b[k]),
                                    "n_links": int(n_links[k]), "sha256": sha256, "codes": codes[k], "times": times[k]})
                yield pa.RecordBatch.from_pylist(out, ROW)
                for k in range(i, j):
                    if sizes[k] >= RANGE_BYTES:
                        for no, (some, start, low, high) in enumerate(byte_ranges(chunks_of(texts[k].as_py()), RANGE_BYTES)):
                            yield pa.RecordBatch.from_pylist([{"kind": "chunks", "row": row + k - i, "doc_id": ids[k].as_py(), "no": no, "chunks": some,
                                                               "start": start, "low": low, "high": high}], ROW)
                block, row = block + 1, row + j - i

    return docs.mapInArrow(run, ROW_TYPE)


def aligned_ranges(ranges: DataFrame, files) -> DataFrame:
    """Byte ranges with their fragments, and their linked pairs as (pairs, times)."""
    def run(batches):
        pair = _pair(*files.value)
        for some in (batch.slice(i, ROWS_AT_ONCE).to_pylist() for batch in batches for i in range(0, batch.num_rows, ROWS_AT_ONCE)):
            all_a, all_b, n_a, n_b, good = pair.encode([x["chunks"] for x in some])
            for x, a, b, own in zip(some, np.split(all_a, np.cumsum(n_a)[:-1]), np.split(all_b, np.cumsum(n_b)[:-1]), good):
                ends_a, ends_b = x["start"] + np.cumsum(pair.size_a[a]), x["start"] + np.cumsum(pair.size_b[b])
                in_a, in_b = (ends_a > x["low"]) & (ends_a <= x["high"]), (ends_b > x["low"]) & (ends_b <= x["high"])
                made = Alignment(pair, a[in_a], b[in_b], ends_a[in_a], ends_b[in_b])
                pairs, times = np.unique(made.links(), return_counts=True)
                yield pa.RecordBatch.from_pylist([{**{c: x[c] for c in ("row", "doc_id", "no")}, "n_a": int(in_a.sum()), "n_b": int(in_b.sum()), "n_links": int(made.cut_a.sum()),
                                                   "good": bool(own), "pairs": pairs, "times": times, "fragment": made.fragment()}], ROW)

    return ranges.select("row", "doc_id", "no", "chunks", "start", "low", "high").mapInArrow(run, ROW_TYPE)


def blocked_ranges(ranges: DataFrame) -> DataFrame:
    """Rows of kinds "texts" (one a range) and "pairs" from aligned ranges."""
    def run(batches):
        from pyspark import TaskContext
        block = (TaskContext.get().partitionId() << 40) | (1 << 39)  # beside the blocks of whole texts
        for batch in batches:
            rows = batch.to_pylist()
            for i, j in _blocks([8 * len(x["pairs"]) for x in rows]):
                some = rows[i:j]
                links = np.concatenate([np.array(x["pairs"], np.int64) for x in some])
                owner = np.repeat(np.arange(j - i), [len(x["pairs"]) for x in some])
                pairs, code = np.unique(links, return_inverse=True)
                total = np.bincount(code.ravel(), weights=np.concatenate([x["times"] for x in some]) if len(links) else None, minlength=len(pairs)).astype(np.int64)
                out = [{"kind": "pairs", "block": block, "pairs": pairs, "times": total}]
                for k, x in enumerate(some):
                    out.append({**{c: x[c] for c in ("row", "doc_id", "n_a", "n_b", "n_links", "times")}, "kind": "texts", "block": block,
                                "codes": code.ravel()[owner == k].astype(np.int32)})
                yield pa.RecordBatch.from_pylist(out, ROW)
                block += 1

    return ranges.select("row", "doc_id", "n_a", "n_b", "n_links", "pairs", "times").mapInArrow(run, ROW_TYPE)


def pair_counts(tables: DataFrame) -> DataFrame:
    """(pair, a, b, n, best): the links of each id pair in the corpus, and whether its B id has none more often."""
    counts = stored(tables.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
                    .agg(F.sum("x.times").alias("n"))
                    .withColumn("a", F.shiftright("pair", 32).cast("int")).withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1).cast("int")))
    most = stored(counts.groupBy("b").agg(F.max("n").alias("most")))
    # a row an id of B: bounded by its vocabulary
    return counts.join(F.broadcast(most), "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """Texts of one block with the sums over their links, from the block's pairs."""
    codes = right.column("code").to_numpy()
    n, best = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
    n[codes], best[codes] = right.column("n").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
    sums = []
    for code, times in zip(left.column("codes"), left.column("times")):
        code, times = code.values.to_numpy(), times.values.to_numpy()
        sums.append((int(best[code] @ times), int(n[code] @ times)))
    out = left.select(["row", "doc_id", "n_a", "n_b", "n_links", "sha256"])
    return out.append_column("n_best", pa.array([s[0] for s in sums], pa.int64())).append_column("count_sum", pa.array([s[1] for s in sums], pa.int64()))


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, counts, fragments).

    ``texts``: row, doc_id, n_a, n_b, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``; ``counts`` as in
    :func:`pair_counts`; ``fragments``: (row, fragment) of the texts that were dealt out, whole.
    """
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))  # as large as the vocabularies
    rows = stored(aligned_texts(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), files))
    ranges = rows.filter("kind = 'chunks'").select("row", "doc_id", "no", "chunks", "start", "low", "high").repartition("row", "no")
    ranges = stored(aligned_ranges(ranges, files))
    bad = stored(ranges.filter("not good").select("row", "doc_id").distinct())
    good = ranges.join(bad.select("row"), "row", "left_anti")
    fragments = stored(reduced(good.select("row", "no", "fragment")))
    blocks = stored(blocked_ranges(good))

    both = rows.select(*blocks.columns).unionByName(blocks)
    tables = both.filter("kind = 'pairs'").select("block", "pairs", "times")
    counts = stored(pair_counts(tables))
    told = (tables.select("block", F.posexplode("pairs").alias("code", "pair")).join(counts.select("pair", "n", "best"), "pair")
            .select(F.col("block").alias("of"), "code", "n", "best"))
    texts = both.filter("kind = 'texts'").select("block", "row", "doc_id", "n_a", "n_b", "n_links", "sha256", "codes", "times")
    scored = stored(texts.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(
        _scored, "row long, doc_id long, n_a long, n_b long, n_links long, sha256 string, n_best long, count_sum long"))
    sums = ["n_a", "n_b", "n_links", "n_best", "count_sum"]
    whole = scored.filter("sha256 is not null").select("row", "doc_id", *sums, F.col("sha256").alias("groups_sha256"))
    dealt = (scored.filter("sha256 is null").groupBy("row").agg(F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in sums])
             .join(fragments, "row").select("row", "doc_id", *sums, F.sha2(groups_text(F.col("fragment")), 256).alias("groups_sha256")))
    none = bad.select("row", "doc_id", *[F.lit(0).cast("long").alias(c) for c in sums], F.lit("").alias("groups_sha256"))
    return whole.unionByName(dealt).unionByName(none), counts, fragments


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    texts, _, _ = align(table(spark, sf_dir, "documents"), tokenizer_path(FILE_A), tokenizer_path(FILE_B))
    return texts.select("doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256")
