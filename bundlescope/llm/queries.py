"""Registered queries of the subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bundlescope.llm.decontamination import op10_benchmark_decontamination
from bundlescope.llm.licenses import OP9_SQL, op9_license_scan
from bundlescope.llm.line_dedup import OP7_SQL, op7_line_dedup
from bundlescope.llm.merkle import OP13_SQL, op13_merkle_manifest
from bundlescope.llm.near_dups import op2_minhash_near_dedup
from bundlescope.llm.packing import op3_best_fit_packing
from bundlescope.llm.pii import op4_pii
from bundlescope.llm.quality import OP6_SQL, op6_quality_rules
from bundlescope.llm.repeats import op8_repeated_strings
from bundlescope.llm.token_files import op1_token_files
from bundlescope.llm.toxicity import op5_toxicity
from bundlescope.llm.warc import OP12_SQL, op12_warc
from bundlescope.llm.whitening import op11_embedding_whitening


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": op1_token_files,
        "op2_minhash_near_dedup": op2_minhash_near_dedup,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_pii": op4_pii,
        "op5_toxicity": op5_toxicity,
        "op6_quality_rules": op6_quality_rules,
        "op7_line_dedup": op7_line_dedup,
        "op8_repeated_strings": op8_repeated_strings,
        "op9_license_scan": op9_license_scan,
        "op10_benchmark_decontamination": op10_benchmark_decontamination,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_warc": op12_warc,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def statements() -> dict[str, str]:
    return {
        "op6_quality_rules": OP6_SQL,
        "op7_line_dedup": OP7_SQL,
        "op9_license_scan": OP9_SQL,
        "op12_warc": OP12_SQL,
        "op13_merkle_manifest": OP13_SQL,
    }
