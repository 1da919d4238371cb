"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from salescope.llm.decontamination import OP4_SQL, op4_decontamination
from salescope.llm.html import op9_html
from salescope.llm.language import op6_language
from salescope.llm.licenses import op8_licenses
from salescope.llm.mixing import op2_mixing
from salescope.llm.neardup import op1_neardup
from salescope.llm.periodic import op13_periodic
from salescope.llm.quality import op7_quality
from salescope.llm.secrets import OP3_SQL, op3_secrets
from salescope.llm.sharding import op5_sharding
from salescope.llm.spelling import op12_spelling
from salescope.llm.suffixes import op10_suffixes
from salescope.llm.toxicity import op11_toxicity

QUERIES = {
    "op1_neardup": op1_neardup,
    "op2_mixing": op2_mixing,
    "op3_secrets": op3_secrets,
    "op4_decontamination": op4_decontamination,
    "op5_sharding": op5_sharding,
    "op6_language": op6_language,
    "op7_quality": op7_quality,
    "op8_licenses": op8_licenses,
    "op9_html": op9_html,
    "op10_suffixes": op10_suffixes,
    "op11_toxicity": op11_toxicity,
    "op12_spelling": op12_spelling,
    "op13_periodic": op13_periodic,
}

ORACLE = {
    "op3_secrets": OP3_SQL,
    "op4_decontamination": OP4_SQL,
}
