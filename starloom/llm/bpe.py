"""BPE encoding and decoding by speculation and verification.

A word's pieces are proposed by greedy longest match.  A proposal is the BPE result exactly
when every piece encodes to itself and every adjacent pair of pieces is
compatible, i.e. no merge across their boundary would have been applied before the merges
that built them.  Both tests run vectorised over all pairs of a batch: each round looks
up the pair's merge rank and undoes the later of the two pieces' last merges.  Words that
fail undergo exact merging.  Words are verified once per batch of new words and kept in a
bounded cache of the task.

The tokenizer file (BPE with word ends, lower-casing, byte-level pieces, no decoder)
is read on the driver from a path parameter and sent to the executors once; its size is
fixed by the vocabulary.

Defined cases: null or empty text has no tokens and decodes to the empty text; repeated rows
are encoded each; an empty table gives an empty result; other columns stay, except those
named like the result columns, which are replaced.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import memory_returned, table

TOKENIZER_FILE = "word_bpe_49k.json"
CACHE_WORDS = 100_000  # entries of a task's cache; it is emptied when full
DECODE_IDS = 100_000  # ids turned to text at a time
NO_RANK = np.int64(1) << 40
ROWS_AT_ONCE = 64


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class WordBpe:
    def __init__(self, spec: dict):
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab, merges = model["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.names = [""] * size
        for name, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = name
        self._build_trie(vocab)
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

        self.rank = np.full(size, -1, np.int64)
        self.left = np.zeros(size, np.int64)
        self.right = np.zeros(size, np.int64)
        rank_of: dict[tuple[int, int], int] = {}
        unique = True
        for n, (a, b) in enumerate(merges):
            made, a, b = vocab[a + b], vocab[a], vocab[b]
            unique = unique and self.rank[made] < 0
            self.rank[made], self.left[made], self.right[made] = n, a, b
            rank_of[a, b] = n
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = np.array([a * size + b for a, b in rank_of], np.int64)
        order = np.argsort(keys)
        self.size, self.pair_keys = size, keys[order]
        self.pair_ranks = np.array(list(rank_of.values()), np.int64)[order]
        # pairwise tests decide only where every piece has one origin, older than itself
        built = np.flatnonzero(self.rank >= 0)
        self.ordered = bool(unique and np.all(self.rank[built] > np.maximum(self.rank[self.left[built]], self.rank[self.right[built]])))
        self.whole = self._self_encoding(built)
        self.texts = pa.array(self.names)
        self.words: dict[str, int] = {}
        self.forget()

    def _build_trie(self, vocab: dict[str, int]) -> None:
        """Nodes are prefixes of pieces, as bytes; pieces with a word end are kept apart."""
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        edges: dict[int, int] = {}
        inner, final, end = [-1], [-1], len(self.end)
        for name, i in vocab.items():
            ends = name.endswith(self.end)
            node = 0
            for c in name[:-end] if ends else name:
                key = node * 256 + byte_of[c]
                node = edges.get(key, -1)
                if node < 0:
                    node = edges[key] = len(inner)
                    inner.append(-1)
                    final.append(-1)
            (final if ends else inner)[node] = i
        keys = np.fromiter(edges, np.int64, len(edges))
        order = np.argsort(keys)
        self.edge_keys, self.edge_nodes = keys[order], np.fromiter(edges.values(), np.int64, len(edges))[order]
        self.inner_at, self.final_at = np.array(inner, np.int64), np.array(final, np.int64)
        singles = self._child(np.zeros(256, np.int64), np.arange(256))
        self.inner_byte, self.final_byte = self.inner_at[singles], self.final_at[singles]

    def forget(self) -> None:
        """Empty the cache of words."""
        self.words.clear()
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.starts, self.lengths = np.zeros(CACHE_WORDS + 1, np.int64), np.zeros(CACHE_WORDS + 1, np.int64)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_RANK)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For each pair: does no merge across the boundary come before those inside the pieces?

        ``limit`` is the rank up to which a crossing merge counts (the rank of a piece's own
        last merge, when the piece itself is tested).
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), NO_RANK) if limit is None else limit.astype(np.int64)
        tied = np.zeros(len(a), bool)  # a crossing merge of equal rank comes first: it lies further left
        good, todo = np.ones(len(a), bool), np.arange(len(a))
        while len(todo):
            x, y, most = a[todo], b[todo], limit[todo]
            crossing = self.pair_rank(x, y)
            bad = (crossing < most) | (tied[todo] & (crossing == most) & (crossing < NO_RANK))
            good[todo[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            undo_left = rx > ry
            limit[todo], tied[todo] = np.maximum(rx, ry), ~undo_left
            a[todo] = np.where(undo_left, self.right[x], x)
            b[todo] = np.where(undo_left, y, self.left[y])
            todo = todo[~bad & ((rx >= 0) | (ry >= 0))]
        return good

    def _self_encoding(self, built: np.ndarray) -> np.ndarray:
        whole = np.ones(self.size, bool)
        alone = self.compatible(self.left[built], self.right[built], self.rank[built])
        for i, good in sorted(zip(built.tolist(), alone.tolist()), key=lambda x: self.rank[x[0]]):
            whole[i] = good and whole[self.left[i]] and whole[self.right[i]]
        return whole

    def _child(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The trie node below ``node`` for ``byte``, or -1."""
        keys = node * 256 + byte
        at = np.minimum(np.searchsorted(self.edge_keys, keys), len(self.edge_keys) - 1)
        return np.where(self.edge_keys[at] == keys, self.edge_nodes[at], -1)

    def propose(self, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Greedy longest match: the piece that starts at each byte, or -1 where none does.

        ``flat`` has the bytes of all words, ``ends`` the end of the word of each byte.  All
        positions walk the trie together, a byte a round; a walk stops where no piece goes on.
        """
        piece, length = np.full(len(flat), -1, np.int64), np.zeros(len(flat), np.int64)
        active, node, depth = np.arange(len(flat)), np.zeros(len(flat), np.int64), 0
        while len(active):
            node = self._child(node, flat[active + depth])
            active, node, depth = active[node >= 0], node[node >= 0], depth + 1
            last = active + depth == ends[active]
            got = np.where(last, self.final_at[node], self.inner_at[node])
            piece[active[got >= 0]], length[active[got >= 0]] = got[got >= 0], depth
            active, node = active[~last], node[~last]
        starts = np.zeros(len(flat), bool)
        at = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]])) if len(flat) else np.zeros(0, np.int64)
        while len(at):
            starts[at] = True
            stop = ends[at]
            at = at + length[at]
            at = at[at < stop]
        return np.where(starts, piece, -1)

    def merge(self, flat: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of words given as bytes: (ids, owner of each id).

        Each round merges every word's lowest-ranked pair, wherever it occurs, from the left.
        """
        last = np.concatenate([owner[1:] != owner[:-1], [True]])
        ids = np.where(last, self.final_byte[flat], self.inner_byte[flat])
        done_ids, done_owner = [], []
        while len(ids):
            ranks = np.where(owner[:-1] == owner[1:], self.pair_rank(ids[:-1], ids[1:]), NO_RANK)
            ranks = np.append(ranks, NO_RANK)
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.repeat(np.minimum.reduceat(ranks, first), np.diff(np.append(first, len(ids))))
            over = lowest == NO_RANK
            done_ids.append(ids[over])
            done_owner.append(owner[over])
            hit = np.flatnonzero((ranks == lowest) & ~over)
            # in a run such as aaa, every second pair merges
            run = np.concatenate([[True], hit[1:] != hit[:-1] + 1]) if len(hit) else np.zeros(0, bool)
            run_start = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0)) if len(hit) else hit
            hit = hit[(np.arange(len(hit)) - run_start) % 2 == 0]
            ids[hit] = self.made[ranks[hit]]
            keep = ~over
            keep[hit + 1] = False
            ids, owner = ids[keep], owner[keep]
        ids, owner = np.concatenate([np.zeros(0, np.int64), *done_ids]), np.concatenate([np.zeros(0, np.int64), *done_owner])
        order = np.argsort(owner, kind="stable")
        return ids[order], owner[order]

    def encode_words(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, number of ids of each): proposals that verify, else merged."""
        owner_of_byte = np.repeat(np.arange(len(lengths)), lengths)
        piece = self.propose(flat, np.repeat(np.cumsum(lengths), lengths))
        at = piece >= 0
        ids, owner = piece[at], owner_of_byte[at]
        failed = np.zeros(len(lengths), bool)
        failed[owner[~self.whole[ids]]] = True
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        pairs, where = np.unique(ids[inside] * self.size + ids[inside + 1], return_inverse=True)
        fits = self.compatible(pairs // self.size, pairs % self.size)
        failed[owner[inside[~fits[where]]]] = True
        if not self.ordered:
            failed[:] = True
        if failed.any():
            again = failed[owner_of_byte]
            merged, merged_owner = self.merge(flat[again], owner_of_byte[again])
            keep = ~failed[owner]
            ids, owner = np.concatenate([ids[keep], merged]), np.concatenate([owner[keep], merged_owner])
            order = np.argsort(owner, kind="stable")
            ids, owner = ids[order], owner[order]
        return ids, np.bincount(owner, minlength=len(lengths))

    def learn(self, chunks: list[str]) -> None:
        """Encode new chunks (text between white space) and keep their ids."""
        split = list(map(self.pieces.findall, chunks))
        encoded = [w.encode("utf-8") for ws in split for w in ws]
        word_lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ids, counts = self.encode_words(np.frombuffer(b"".join(encoded), np.uint8).astype(np.int64), word_lengths)
        per_chunk = np.fromiter(map(len, split), np.int64, len(split))
        id_ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(per_chunk)]
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        at, n = len(self.words), len(chunks)
        self.lengths[at:at + n] = np.diff(np.concatenate([[0], id_ends]))
        self.starts[at:at + n] = self.used + id_ends - self.lengths[at:at + n]
        self.used += len(ids)
        self.words.update(zip(chunks, range(at, at + n)))

    def chunks_of(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if _SEPARATORS.search(text):
            return [c for c in _WHITE_SPACE.split(text) if c]
        return text.split()

    def encode_rows(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        parts: list[list] = []
        for text in texts:
            if self.special_split is not None and "<" in text:
                parts.append([self.special[s] if s in self.special else self.chunks_of(s)
                              for s in self.special_split.split(text)])
            else:
                parts.append([self.chunks_of(text)])
        fresh = {c for row in parts for p in row if isinstance(p, list) for c in p if c not in self.words}
        if len(self.words) + len(fresh) > CACHE_WORDS:
            self.forget()
            fresh = {c for row in parts for p in row if isinstance(p, list) for c in p}
            if len(fresh) > CACHE_WORDS:
                self.starts, self.lengths = np.zeros(len(fresh) + 1, np.int64), np.zeros(len(fresh) + 1, np.int64)
        if fresh:
            self.learn(list(fresh))
        return [np.concatenate([np.zeros(0, np.int32), *[np.array([p], np.int32) if isinstance(p, int) else self.gather(p) for p in row]])
                for row in parts]

    def gather(self, chunks: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.words.__getitem__, chunks), np.int64, len(chunks))
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        if not len(ends):
            return np.zeros(0, np.int32)
        shift = np.repeat(self.starts[at] - (ends - lengths), lengths)
        return self.flat[shift + np.arange(ends[-1])]

    def decode_rows(self, ids: pa.ListArray) -> pa.Array:
        """Piece names joined by one space: the file has no decoder."""
        out, offsets = [], ids.offsets.to_numpy()
        start = 0
        while start < len(ids):
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + DECODE_IDS, "right")) - 1)
            some = ids.slice(start, min(stop, len(ids)) - start)
            names = pa.LargeListArray.from_arrays(
                pa.array(some.offsets.to_numpy() - some.offsets[0].as_py(), pa.int64()), self.texts.take(some.flatten()))
            out.append(pc.binary_join(names, " ").cast(pa.string()))
            start = stop
        return pa.concat_arrays(out) if out else pa.array([], pa.string())


_SEPARATORS = re.compile("[\x1c-\x1f]")  # str.split() takes these for white space, Unicode does not
_WHITE_SPACE = regex.compile(r"\p{White_Space}+")


@lru_cache(maxsize=1)
def _tokenizer(packed: bytes) -> WordBpe:
    return WordBpe(json.loads(zlib.decompress(packed)))


def _list_array(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *rows])))


def with_tokens(docs: DataFrame, path: str, text: str = "text", ids: str = "ids",
                decoded: str | None = "decoded") -> DataFrame:
    """``docs`` with ``ids`` array<int> of each whole text and, unless None, their ``decoded`` text."""
    with open(path, encoding="utf-8") as file:
        packed = docs.sparkSession.sparkContext.broadcast(zlib.compress(file.read().encode("utf-8")))
    kind = "struct<ids:array<int>,decoded:string>" if decoded else "struct<ids:array<int>>"

    def coded_batch(bpe: WordBpe, texts: pa.Array) -> pa.Array:
        rows, names = [], []
        for start in range(0, len(texts), ROWS_AT_ONCE):
            got = bpe.encode_rows([t or "" for t in texts.slice(start, ROWS_AT_ONCE).to_pylist()])
            rows += got
            if decoded:
                names.append(bpe.decode_rows(_list_array(got)))
        columns = [_list_array(rows)]
        if decoded:
            columns.append(pa.concat_arrays(names) if names else pa.array([], pa.string()))
        return pa.StructArray.from_arrays(columns, ["ids", "decoded"][:len(columns)])

    @F.arrow_udf(kind)
    @memory_returned
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _tokenizer(packed.value)
        try:
            for texts in batches:
                yield coded_batch(bpe, texts)
        finally:
            bpe.forget()  # the tokenizer stays with the worker, the words do not

    kept = [c for c in docs.columns if c not in (ids, decoded)]
    coded = docs.withColumn("_coded", encode(F.col(text)))
    out = [F.col("_coded.ids").alias(ids)] + ([F.col("_coded.decoded").alias(decoded)] if decoded else [])
    return coded.select(*kept, *out)


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and digests of ``ids`` and ``decoded``."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op10_bpe(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(with_tokens(docs, tokenizer_path()))
