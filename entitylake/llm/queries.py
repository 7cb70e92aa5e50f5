"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from entitylake.llm import (
    bin_slack,
    bitplanes,
    bradley_terry,
    chat_template,
    chosen_path,
    ecoc_language,
    html_template,
    line_bitmaps,
    prefix_trie,
    rule_table,
    square_catchers,
    syncmers,
    weighted_mix,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_template": html_template.op1_html_template,
    "op2_chosen_path": chosen_path.op2_chosen_path,
    "op3_ecoc_language": ecoc_language.op3_ecoc_language,
    "op4_bradley_terry": bradley_terry.op4_bradley_terry,
    "op5_quality_rules": rule_table.op5_quality_rules,
    "op6_bit_planes": bitplanes.op6_bit_planes,
    "op7_bin_slack": bin_slack.op7_bin_slack,
    "op8_syncmers": syncmers.op8_syncmers,
    "op9_chat_template": chat_template.op9_chat_template,
    "op10_weighted_mix": weighted_mix.op10_weighted_mix,
    "op11_line_dedup": line_bitmaps.op11_line_dedup,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_periodic_runs": square_catchers.op13_periodic_runs,
}

CHECKS: dict[str, str] = {
    "op5_quality_rules": rule_table.SQL,
    "op9_chat_template": chat_template.SQL,
    "op10_weighted_mix": weighted_mix.SQL,
    "op11_line_dedup": line_bitmaps.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}
