"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (collocations, decontaminate, jaccard_join, language, licenses, line_dedup, main_text, mixing, packing, quality_rules,
               repair, substring_dedup, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark, sf_dir):
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_quality_rules(spark, sf_dir):
    return quality_rules.report(_table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark, sf_dir):
    return jaccard_join.report(_table(spark, sf_dir, "documents"))


def op4_license_scan(spark, sf_dir):
    return licenses.report(_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark, sf_dir):
    return line_dedup.report(_table(spark, sf_dir, "documents"))


def op6_curriculum_mix(spark, sf_dir):
    return mixing.report(_table(spark, sf_dir, "documents"))


def op7_warc(spark, sf_dir):
    return warc.report(_table(spark, sf_dir, "pages"))


def op8_substring_dedup(spark, sf_dir):
    return substring_dedup.report(_table(spark, sf_dir, "documents"))


def op9_language_mixture(spark, sf_dir):
    return language.report(_table(spark, sf_dir, "documents"))


def op10_main_text(spark, sf_dir):
    return main_text.report(_table(spark, sf_dir, "pages"))


def op11_window_packing(spark, sf_dir):
    return packing.report(_table(spark, sf_dir, "documents"))


def op12_collocations(spark, sf_dir):
    return collocations.report(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark, sf_dir):
    return repair.report(_table(spark, sf_dir, "conversations"))


QUERIES = {q.__name__: q for q in (op1_decontaminate, op2_quality_rules, op3_jaccard_join, op4_license_scan,
                                   op5_line_dedup, op6_curriculum_mix,
                                   op7_warc, op8_substring_dedup, op9_language_mixture, op10_main_text,
                                   op11_window_packing, op12_collocations, op13_conversation_repair)}

ORACLES = {
    "op1_decontaminate": decontaminate.REPORT_SQL,
    "op2_quality_rules": quality_rules.REPORT_SQL,
    "op3_jaccard_join": jaccard_join.REPORT_SQL,
    "op5_line_dedup": line_dedup.REPORT_SQL,
    "op6_curriculum_mix": mixing.REPORT_SQL,
    "op7_warc": warc.REPORT_SQL,
    "op8_substring_dedup": substring_dedup.REPORT_SQL,
    "op12_collocations": collocations.REPORT_SQL,
}
