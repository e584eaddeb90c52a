"""Registered queries of the corpus operators and their SQL equivalents."""

from loglens.llm.conversations import op12_query
from loglens.llm.exact_dedup import OP9_SQL, op9_query
from loglens.llm.merkle import OP13_SQL, op13_query
from loglens.llm.near_vectors import op4_query
from loglens.llm.ngram_model import op11_query
from loglens.llm.packing import op5_query
from loglens.llm.quality import op2_query
from loglens.llm.sentencepieces import op1_query
from loglens.llm.sharding import OP7_SQL, op7_query
from loglens.llm.shingle_join import op6_query
from loglens.llm.suffix_dedup import op8_query
from loglens.llm.toxicity import op3_query
from loglens.llm.url_filter import op10_query

QUERIES = {
    "op1_sentencepiece_codec": op1_query,
    "op2_quality_ranking": op2_query,
    "op3_toxicity_kernel": op3_query,
    "op4_near_vectors": op4_query,
    "op5_best_fit_packing": op5_query,
    "op6_jaccard_join": op6_query,
    "op7_extendible_shards": op7_query,
    "op8_suffix_dedup": op8_query,
    "op9_exact_dedup": op9_query,
    "op10_url_filter": op10_query,
    "op11_language_model": op11_query,
    "op12_conversation_repair": op12_query,
    "op13_merkle_manifest": op13_query,
}
ORACLE_SQL = {
    "op7_extendible_shards": OP7_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
