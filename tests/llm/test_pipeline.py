"""The pipeline's stages, each against a plain version on its own input."""

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_mixing import plain_targets
from test_ngram_join import plain_components
from test_pii import plain_spans
from tokenizers import Tokenizer

import corpus_pipeline
from starloom.llm import toxicity
from starloom.llm.common import stored, table

COLUMNS = corpus_pipeline.COLUMNS


@pytest.fixture(scope="module")
def steps(spark):
    """The documents, and the rows that each stage makes of its predecessor's."""
    docs = table(spark, SF_SMALL, "documents").select(*COLUMNS)
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF_SMALL)))
    return [sorted(frame.collect(), key=lambda r: (r.doc_id, r.n_chars)) for frame in out]


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "tokens"]
    assert all(rows and rows[0].asDict().keys() == set(COLUMNS) for rows in steps[:-1])


def test_toxic_documents_go(spark, steps):
    docs = table(spark, SF_SMALL, "documents")
    machine = toxicity.train(docs, table(spark, SF_SMALL, "labels").filter(toxicity.fold(F.col("doc_id"), 5) != 0))
    lookup = toxicity._Terms({int(t): i for i, t in enumerate(machine.terms)}).__getitem__
    row, at, n = toxicity._counts([r.text or "" for r in steps[0]], lookup)
    clean = machine.margins(row, at, np.sqrt(n), len(steps[0])) < 0
    assert [r.doc_id for r in steps[1]] == [r.doc_id for r, keep in zip(steps[0], clean) if keep]
    assert 0 < len(steps[1]) < len(steps[0])


def test_one_document_of_each_group_stays(steps):
    groups = plain_components([(r.doc_id, r.text) for r in steps[1]], 5, 80)
    heads = sorted({head for _, _, head in groups})
    assert [r.doc_id for r in steps[2]] == heads
    texts = {r.doc_id: r.text for r in steps[1]}
    assert all(r.text == texts[r.doc_id] for r in steps[2])


def test_personal_data_is_named_not_shown(steps):
    before = {r.doc_id: r.text for r in steps[2]}
    assert len(steps[3]) == len(steps[2])
    for r in steps[3]:
        shown = [before[r.doc_id][int(a):int(b)] for _, a, b in (s.split(":") for s in plain_spans(before[r.doc_id]))]
        assert not any(s in r.text for s in shown)
        assert r.n_chars == len(r.text) and (shown or r.text == before[r.doc_id] or "[" in r.text)


def test_sources_reach_their_budgets(steps):
    sizes, mixed = {}, {}
    for r in steps[3]:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    for r in steps[4]:
        mixed[r.source] = mixed.get(r.source, 0) + len(r.text.split())
    assert {s: int(t + 1e-9) for s, t in plain_targets(sizes).items() if int(t + 1e-9)} == mixed


def test_tokens_equal_the_library(steps):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = sorted((r.doc_id, library.encode(r.text, add_special_tokens=False).ids) for r in steps[4])
    assert sorted((r.doc_id, r.ids) for r in steps[5]) == expected
    assert all(r.n_tokens == len(r.ids) for r in steps[5])


def test_odd_documents_pass_every_stage(spark):
    """Nulls in every column, empty texts, repeated rows and rows without an id."""
    schema = table(spark, SF_SMALL, "documents").select(*COLUMNS).schema
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b c d e f g", "en", "s", 13), (3, "a b c d e f g", "en", "s", 13),
            (4, "A b c d e f g", "en", None, 13), (None, "no id here", "en", "t", 10), (5, "mail x@y.org " * 3000, None, "t", 39000)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL))
    left = docs.collect()
    assert {r.doc_id for r in left} >= {None, 5} and 4 not in {r.doc_id for r in left}


def test_texts_that_share_an_id_stay_apart(spark):
    schema = table(spark, SF_SMALL, "documents").select(*COLUMNS).schema
    one, two = "a b c d e f g h i j", "k l m n o p q r s t u"
    rows = [(3, one, "en", "s", 1), (3, two, "en", "s", 2), (3, two, "en", "s", 2), (4, two, "en", "s", 2), (5, "", "en", "s", 0), (5, None, "en", "s", 0), (6, "", "en", "s", 0)]
    left = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, schema), SF_SMALL).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == [(3, one), (3, two), (5, ""), (5, None), (6, "")]


def test_run_chains_the_stages(spark, monkeypatch):
    stages = [("a", lambda s, docs, d: docs.filter("doc_id < 9")), ("b", lambda s, docs, d: docs.withColumn("n", F.lit(1)))]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    rows = corpus_pipeline.run(spark, SF_SMALL)
    assert rows.count() == 9 and rows.columns == COLUMNS + ["n"]
