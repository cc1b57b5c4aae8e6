"""The corpus operators' queries, and SQL where it can express them."""

from evidra.llm.byte_bpe import op5_byte_bpe
from evidra.llm.chunk_tokens import op11_chunked_bpe
from evidra.llm.language import op3_language_id
from evidra.llm.lexical import OP12_SQL, op12_lexical_search
from evidra.llm.matroska import op6_media_columns
from evidra.llm.near_dedup import OP7_SQL, op7_near_dedup
from evidra.llm.neighbours import OP10_SQL, op10_nearest_neighbours
from evidra.llm.packing import op1_best_fit_packing
from evidra.llm.periodic import op13_periodic_runs
from evidra.llm.secrets import op8_secret_scan
from evidra.llm.token_records import op4_token_records
from evidra.llm.toxicity import op2_toxicity
from evidra.llm.warc import OP9_SQL, op9_warc

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_toxicity": op2_toxicity,
    "op3_language_id": op3_language_id,
    "op4_token_records": op4_token_records,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_media_columns": op6_media_columns,
    "op7_near_dedup": op7_near_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_warc": op9_warc,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_chunked_bpe": op11_chunked_bpe,
    "op12_lexical_search": op12_lexical_search,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE_SQL = {"op7_near_dedup": OP7_SQL, "op9_warc": OP9_SQL, "op10_nearest_neighbours": OP10_SQL, "op12_lexical_search": OP12_SQL}
