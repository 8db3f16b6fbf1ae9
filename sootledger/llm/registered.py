"""Registered queries of this subpackage and their SQL."""

import corpus_pipeline
from sootledger.llm.exact import OP12_SQL, op12_exact
from sootledger.llm.language import op7_language
from sootledger.llm.mixing import op3_mixing
from sootledger.llm.packing import op8_packing
from sootledger.llm.parsing import op10_parsing
from sootledger.llm.phrases import OP13_SQL, op13_phrases
from sootledger.llm.quality import op1_quality
from sootledger.llm.rules import op2_rules
from sootledger.llm.sharding import op6_sharding
from sootledger.llm.simhash import op5_simhash
from sootledger.llm.tokenfile import op9_tokenfile
from sootledger.llm.urls import OP4_SQL, op4_urls
from sootledger.llm.whitening import op11_whitening

QUERIES = {
    "op1_quality": op1_quality,
    "op2_rules": op2_rules,
    "op3_mixing": op3_mixing,
    "op4_urls": op4_urls,
    "op5_simhash": op5_simhash,
    "op6_sharding": op6_sharding,
    "op7_language": op7_language,
    "op8_packing": op8_packing,
    "op9_tokenfile": op9_tokenfile,
    "op10_parsing": op10_parsing,
    "op11_whitening": op11_whitening,
    "op12_exact": op12_exact,
    "op13_phrases": op13_phrases,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {"op4_urls": OP4_SQL, "op12_exact": OP12_SQL, "op13_phrases": OP13_SQL}
