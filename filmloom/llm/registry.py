"""The queries of this subpackage and their SQL, as __spark_entry__.py adds them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filmloom.llm.block_repeats import op13_block_repeats
from filmloom.llm.collocations import op12_collocations
from filmloom.llm.fingerprints import op3_fingerprints
from filmloom.llm.html_text import op8_html_text
from filmloom.llm.license_scan import op9_license_scan
from filmloom.llm.mixing import op10_mixing
from filmloom.llm.near_duplicates import op5_near_duplicates
from filmloom.llm.neighbours import op6_neighbours
from filmloom.llm.packing import op7_packing
from filmloom.llm.sql import OP5, OP10, OP12, OP13
from filmloom.llm.suffix_dedup import op2_suffix_dedup
from filmloom.llm.token_codes import op1_token_codes
from filmloom.llm.toxicity import op4_toxicity
from filmloom.llm.whitening import op11_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_codes": op1_token_codes,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_fingerprints": op3_fingerprints,
    "op4_toxicity": op4_toxicity,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_neighbours": op6_neighbours,
    "op7_packing": op7_packing,
    "op8_html_text": op8_html_text,
    "op9_license_scan": op9_license_scan,
    "op10_mixing": op10_mixing,
    "op11_whitening": op11_whitening,
    "op12_collocations": op12_collocations,
    "op13_block_repeats": op13_block_repeats,
}

SQL: dict[str, str] = {"op5_near_duplicates": OP5, "op10_mixing": OP10, "op12_collocations": OP12, "op13_block_repeats": OP13}
