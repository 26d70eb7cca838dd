"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm.exponion import op12_exponion_codes
from quire.llm.gif import op9_gif_media
from quire.llm.importance import op13_crc_ring_resampling
from quire.llm.language import op7_language_mixture
from quire.llm.neighbours import op4_vantage_point_search
from quire.llm.packing import op5_best_fit_packing
from quire.llm.pieces import op6_sentencepiece_round_trip
from quire.llm.products import op11_ball_tree_search
from quire.llm.secrets import op8_secret_scans
from quire.llm.simhash import op1_simhash_near_dedup
from quire.llm.sql import SQL  # noqa: F401
from quire.llm.substrings import op2_substring_dedup
from quire.llm.suffixes import op3_suffix_array_dedup
from quire.llm.toxicity import op10_toxicity_chain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_substring_dedup,
        op3_suffix_array_dedup,
        op4_vantage_point_search,
        op5_best_fit_packing,
        op6_sentencepiece_round_trip,
        op7_language_mixture,
        op8_secret_scans,
        op9_gif_media,
        op10_toxicity_chain,
        op11_ball_tree_search,
        op12_exponion_codes,
        op13_crc_ring_resampling,
    )
}
