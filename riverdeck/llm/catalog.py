"""The registered queries of this folder: one per operator, over its whole table."""

from __future__ import annotations

from riverdeck.catalog.entry import Entry
from riverdeck.llm import (audit, html_text, mixing, neighbours, packing, pii, quality, repeats, simhash, spelling,
                           token_counts, toxicity, warc)

ENTRIES: dict[str, Entry] = {}


def _register(name: str, tables: str, build, sql: str | None = None) -> None:
    """`build` gets the tables (space-separated names, in order), whole."""
    ENTRIES[name] = Entry(name, lambda spark, sf_dir: build(
        *[spark.read.parquet(f"{sf_dir}/{table}.parquet") for table in tables.split()]), sql)


_register("op3_count_tokens", "documents", token_counts.count_tokens)
_register("op4_quality_rules", "documents", quality.quality_report, quality.QUALITY_SQL)
_register("op7_mix_sources", "documents", mixing.mixing_report, mixing.MIXING_SQL)
_register("op9_simhash", "documents", simhash.near_copy_report)
_register("op2_personal_data", "documents", pii.personal_data_report)
_register("op6_pack", "documents", packing.packing_report)
_register("op1_nearest", "embeddings", neighbours.neighbour_report)
_register("op8_warc", "pages", warc.archive_report, warc.WARC_SQL)
_register("op10_main_text", "pages", html_text.extract)
_register("op5_repeats", "documents", repeats.repeats_report)
_register("op13_filter_audit", "documents labels", audit.audit, audit.AUDIT_SQL)
_register("op11_spelling_variants", "documents", spelling.spelling_report)
_register("op12_toxicity", "documents labels", toxicity.toxicity_report)
