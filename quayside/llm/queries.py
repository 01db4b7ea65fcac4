"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .align import op11_alignment
from .ann import op8_ann
from .bpe import op5_bpe
from .debruijn import op6_de_bruijn
from .decontaminate import op1_decontamination
from .langid import op3_language_id
from .license import op2_license_scan
from .neardup import op4_minhash
from .oracle import ORACLE_SQL
from .packing import op13_packing
from .quality import op10_quality
from .spelling import op12_spelling
from .suffixdedup import op7_suffix_array
from .tokenfile import op9_token_file

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_license_scan": op2_license_scan,
    "op3_language_id": op3_language_id,
    "op4_minhash": op4_minhash,
    "op5_bpe": op5_bpe,
    "op6_de_bruijn": op6_de_bruijn,
    "op7_suffix_array": op7_suffix_array,
    "op8_ann": op8_ann,
    "op9_token_file": op9_token_file,
    "op10_quality": op10_quality,
    "op11_alignment": op11_alignment,
    "op12_spelling": op12_spelling,
    "op13_packing": op13_packing,
}
