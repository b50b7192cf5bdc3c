"""Driver queries of this package and their SQL where SQL can express them."""

from telemetry_lake.llm.conversations import op13_conversations
from telemetry_lake.llm.decontamination import op8_decontamination
from telemetry_lake.llm.exact_dedup import OP6_SQL, op6_exact_dedup
from telemetry_lake.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from telemetry_lake.llm.licenses import op2_licenses
from telemetry_lake.llm.lm_scoring import op5_lm_scoring
from telemetry_lake.llm.near_dedup import op9_near_dedup
from telemetry_lake.llm.packing import op3_packing
from telemetry_lake.llm.quality import op4_quality
from telemetry_lake.llm.secrets import op1_secrets
from telemetry_lake.llm.simhash import op11_simhash
from telemetry_lake.llm.toxicity import op10_toxicity
from telemetry_lake.llm.url_filter import OP7_SQL, op7_url_filter

QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_licenses": op2_licenses,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_decontamination": op8_decontamination,
    "op9_near_dedup": op9_near_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_simhash": op11_simhash,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversations": op13_conversations,
}

ORACLE = {"op6_exact_dedup": OP6_SQL, "op7_url_filter": OP7_SQL, "op12_hard_negatives": OP12_SQL}
