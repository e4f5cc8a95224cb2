"""Token alignment against a plain version on whole texts."""

import hashlib
import random

import pytest
import public_tokenizers
import sentencepiece
from conftest import SF_SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm import token_alignment
from starloom.llm.bpe import byte_alphabet
from starloom.llm.common import table

PATHS = [public_tokenizers.path(token_alignment.FILE_A), public_tokenizers.path(token_alignment.FILE_B)]


def plain(rows):
    """Sorted (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of (doc_id, text) rows."""
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    byte_of = {c: i for i, c in enumerate(byte_alphabet())}

    def tokens(text):
        encoded = a.encode(" " + text, add_special_tokens=False)
        in_a = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens)]
        in_b = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            in_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        return in_a, in_b

    out, counts = [], {}
    for doc_id, text in rows:
        in_a, in_b = tokens(text) if text else ([], [])
        if any(b"".join(x for _, x in side) != (" " + (text or "")).encode() for side in (in_a, in_b)):
            out.append((doc_id, 0, 0, [], ""))
            continue
        ends = []
        for side in (in_a, in_b):
            at, here = 0, []
            for _, x in side:
                at += len(x)
                here.append(at)
            ends.append(here)
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
            groups.append(",".join(str(t) for t, _ in in_a[i:p]) + "|" + ",".join(str(t) for t, _ in in_b[j:q]))
            links.append((in_a[p - 1][0], in_b[q - 1][0]))
            i, j = p, q
        for link in links:
            counts[link] = counts.get(link, 0) + 1
        out.append((doc_id, len(in_a), len(in_b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return sorted(((d, n, m, len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha)
                   for d, n, m, links, sha in out), key=str)


def aligned(frame):
    texts, _, _ = token_alignment.align(frame, *PATHS)
    return sorted((tuple(r) for r in texts.select("doc_id", "n_a", "n_b", "n_links", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


def test_documents_equal_the_plain_version(spark):
    docs = table(spark, SF_SMALL, "documents")
    assert aligned(docs.withColumn("block", F.lit(1)).withColumn("kind", F.lit("x"))) == plain([(r.doc_id, r.text) for r in docs.collect()])


ODD = [(1, None), (2, ""), (3, " "), (4, "a"), (5, "x▁y"), (6, "<|endoftext|> <s> </s> <unk> <0x41>"), (7, "\x00 \t\n  b "), (8, "été ﬁ ①  日本語 😀"),
       (9, "same words here"), (9, "same words here"), (None, "no id"), (10, "  two  spaces   three "), (11, "don't  we'll\n\n it's")]


@pytest.mark.parametrize("width", [3, 7, 32_768])
def test_odd_texts_in_ranges_of_any_width(spark, monkeypatch, width):
    monkeypatch.setattr(token_alignment, "RANGE_BYTES", width)
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 40)
    rnd = random.Random(3)
    rows = ODD + [(100 + i, "".join(rnd.choice(["ab", " ", "  ", "\n", "tion", "é", "日", "'s", "123", "."]) for _ in range(rnd.randrange(60)))) for i in range(40)]
    rows += [(200, "x" * 100 + " tail▁ end"), (201, "word " * 40), (202, "▁ " + "many words " * 20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert aligned(frame) == plain(rows)


def test_composition_is_associative_and_neutral(spark):
    """Fragments of consecutive ranges compose to the whole text's, however they are bracketed."""
    with open(PATHS[0], encoding="utf-8") as a, open(PATHS[1], "rb") as b:
        pair = token_alignment.TokenizerPair(a.read(), b.read())
    chunks = token_alignment.chunks_of("unbelievable tokenisations of extraordinary words: naïveté, 12345 日本")
    a, b, _, _, _ = pair.encode([chunks])
    ends_a, ends_b = pair.size_a[a].cumsum(), pair.size_b[b].cumsum()

    def fragment(low, high):
        x, y = (ends_a > low) & (ends_a <= high), (ends_b > low) & (ends_b <= high)
        return token_alignment.Alignment(pair, a[x], b[y], ends_a[x], ends_b[y]).fragment()

    last, rnd, rows = int(ends_a[-1]), random.Random(1), []
    for _ in range(60):
        i, j = sorted(rnd.sample(range(last + 1), 2))
        rows.append((fragment(0, i), fragment(i, j), fragment(j, last)))
    frame = spark.createDataFrame(rows, ", ".join(f"{c} {token_alignment.FRAGMENT}" for c in "xyz"))
    x, y, z = (F.col(c) for c in "xyz")
    join = token_alignment.composed
    got = frame.select(join(join(x, y), z).alias("l"), join(x, join(y, z)).alias("r"), join(token_alignment.empty_fragment(), y).alias("e"),
                       join(y, token_alignment.empty_fragment()).alias("f"), "y").collect()
    assert all(r.l.asDict() == r.r.asDict() == fragment(0, last) and r.e == r.y == r.f for r in got)


def test_very_long_texts_are_composed_from_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "RANGE_BYTES", 500)
    rnd = random.Random(7)
    long = " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(1, 12))) for _ in range(9_000))
    rows = [(1, long), (2, "y" * 3_000), (3, "short")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    texts, counts, fragments = token_alignment.align(frame, *PATHS)
    assert fragments.count() == 2
    assert aligned(frame) == plain(rows)


def test_empty_table(spark):
    assert aligned(spark.createDataFrame([], "doc_id long, text string")) == []


def test_chunks_are_cut_before_spaces_after_something_else():
    import re
    rnd = random.Random(2)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "bc", " ", "  ", "\n", "\t", "\u2003", "\x1c", "é"]) for _ in range(rnd.randrange(1, 30)))
        chunks = token_alignment.chunks_of(text)
        assert chunks == re.split(r"(?<=\S)(?= )", " " + text) and "".join(chunks) == " " + text


def test_chunks_in_one_text_or_alone_have_the_same_tokens(monkeypatch):
    with open(PATHS[0], encoding="utf-8") as a, open(PATHS[1], "rb") as b:
        pair = token_alignment.TokenizerPair(a.read(), b.read())
    rnd = random.Random(4)
    texts = [token_alignment.chunks_of("".join(rnd.choice(["tion", "the", " ", " ", "\n", "▁", "'s", "9", "日", "é"]) for _ in range(40))) for _ in range(200)]
    got = pair.encode(texts)
    monkeypatch.setattr(token_alignment, "TOGETHER", 1)
    pair._clear()
    again = pair.encode(texts)
    assert all((x == y).all() for x, y in zip(got, again)) and not got[4].all()
