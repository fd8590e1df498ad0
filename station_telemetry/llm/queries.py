"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from station_telemetry.llm.common import prepare
from station_telemetry.llm.decontamination import op3_benchmark_decontamination
from station_telemetry.llm.hard_negatives import op11_hard_negative_mining
from station_telemetry.llm.merkle_manifest import op13_merkle_manifest
from station_telemetry.llm.oracles import ORACLES  # noqa: F401
from station_telemetry.llm.packing import op1_best_fit_packing
from station_telemetry.llm.quality_classifier import op5_quality_classifier
from station_telemetry.llm.quality_rules import op7_quality_rules
from station_telemetry.llm.simhash_pivots import op10_simhash_near_dedup
from station_telemetry.llm.suffix_array_dedup import op6_suffix_array_dedup
from station_telemetry.llm.suffix_tree_dedup import op9_substring_dedup
from station_telemetry.llm.super_minhash import op12_minhash_near_dedup
from station_telemetry.llm.token_counts import op8_token_counts
from station_telemetry.llm.toxicity import op2_toxicity
from station_telemetry.llm.warc import op4_warc


def _prepared(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return build(spark, sf_dir)

    return run


QUERIES = {
    build.__name__: _prepared(build)
    for build in (
        op1_best_fit_packing,
        op2_toxicity,
        op3_benchmark_decontamination,
        op4_warc,
        op5_quality_classifier,
        op6_suffix_array_dedup,
        op7_quality_rules,
        op8_token_counts,
        op9_substring_dedup,
        op10_simhash_near_dedup,
        op11_hard_negative_mining,
        op12_minhash_near_dedup,
        op13_merkle_manifest,
    )
}
