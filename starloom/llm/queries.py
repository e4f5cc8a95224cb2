"""Registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from starloom.llm.bpe import op10_bpe
from starloom.llm.common import bounded_batches
from starloom.llm.embedding_join import OP7_SQL, op7_embedding_join
from starloom.llm.html_text import op1_html_text
from starloom.llm.mixing import OP2_SQL, op2_mix_sources
from starloom.llm.ngram_join import OP3_SQL, op3_ngram_join
from starloom.llm.phrase_index import OP12_SQL, op12_phrase_index
from starloom.llm.pii import op4_pii
from starloom.llm.quality import op9_quality
from starloom.llm.simhash import op5_simhash
from starloom.llm.token_alignment import op11_token_alignment
from starloom.llm.toxicity import op8_toxicity
from starloom.llm.url_filter import OP6_SQL, op6_url_filter
from starloom.llm.vector_codes import OP13_SQL, op13_vector_codes

QUERIES = {name: bounded_batches(query) for name, query in {
    "op1_html_text": op1_html_text,
    "op2_mix_sources": op2_mix_sources,
    "op3_ngram_join": op3_ngram_join,
    "op4_pii": op4_pii,
    "op5_simhash": op5_simhash,
    "op6_url_filter": op6_url_filter,
    "op7_embedding_join": op7_embedding_join,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_bpe": op10_bpe,
    "op11_token_alignment": op11_token_alignment,
    "op12_phrase_index": op12_phrase_index,
    "op13_vector_codes": op13_vector_codes,
}.items()}

ORACLE_SQL = {
    "op2_mix_sources": OP2_SQL,
    "op3_ngram_join": OP3_SQL,
    "op6_url_filter": OP6_SQL,
    "op7_embedding_join": OP7_SQL,
    "op12_phrase_index": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
}
