"""From raw documents to a tokenised, mixed training corpus.

Stages in order: toxic documents go; of each group of near-duplicates the document of least id
stays; personal data is replaced by the name of its kind; sources are mixed to their target weights (documents
repeat as often as the mix takes them); texts become token ids.  Each stage reads what its predecessor
wrote.  All but the last return the columns of ``documents``.

Defined cases are those of the operators; a row without an id cannot name a group and stays.  Rows that repeat an id and
its text are one document in the near-duplicate stage; other texts under that id are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, mixing, ngram_join, pii, toxicity
from starloom.llm.common import bounded_batches, stored, table, word_count

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE_WORDS, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below one half."""
    learnable = table(spark, sf_dir, "labels").filter(toxicity.fold(F.col("doc_id"), 5) != 0)
    machine = toxicity.train(docs, learnable)
    return toxicity.score(docs, machine, out="_toxic").filter("_toxic < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked shingle sets: of least id, then of least hash of its text."""
    joined = ngram_join.jaccard_rows(docs, SHINGLE_WORDS, PERCENT).filter("doc_id is not null")
    first = joined.filter("component is not null").groupBy("component").agg(F.min(F.struct("doc_id", "text_id")).alias("head")).select("head.*")
    heads = first.unionByName(joined.filter("component is null").select("doc_id", "text_id")).distinct()
    named = docs.select(*COLUMNS, F.xxhash64("text").alias("text_id"))
    kept = named.join(heads, ["doc_id", "text_id"], "left_semi").dropDuplicates(["doc_id", "text_id"])
    return kept.select(*COLUMNS).unionByName(docs.filter("doc_id is null").select(*COLUMNS))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with ``[KIND]`` in place of personal data."""
    scanned = stored(pii.scan(docs))
    found = pii.with_spans(scanned, pii.train(scanned))
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(pii.redacted(F.col("text"), F.col("spans")))
    clean = found.withColumn("text", text)
    changed = F.size("spans") > 0
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document."""
    sized = docs.select(*COLUMNS, word_count(F.col("text")).alias("_size"))
    return mixing.mixed_rows(mixing.mix(sized, size="_size"), size="_size").select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and the digest of the decoded text."""
    coded = bpe.with_tokens(docs.select(*COLUMNS), bpe.tokenizer_path())
    return coded.select("doc_id", "lang", "source", "n_chars", "ids", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [(name, bounded_batches(stage)) for name, stage in [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]]

# Scores of a trained model, code-point spans and token ids are outside SQL; tests hold the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
