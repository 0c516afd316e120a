"""Queries and SQL of this subpackage."""

from __future__ import annotations

from .bpe import op7_byte_bpe
from .decontaminate import OP9_SQL, op9_decontaminate
from .embedding_dedup import OP12_SQL, op12_embedding_dedup
from .fill_in_middle import OP13_SQL, op13_fill_in_middle
from .jaccard_join import op6_jaccard_join
from .language_mixture import op5_language_mixture
from .line_dedup import OP3_SQL, op3_line_dedup
from .oracles import OP4_SQL, OP6_SQL
from .quality_classifier import op1_quality_classifier
from .quality_rules import OP10_SQL, op10_quality_rules
from .source_divergence import OP11_SQL, op11_source_divergence
from .suffix_dedup import op4_suffix_dedup
from .token_counts import op8_token_counts
from .warc import OP2_SQL, op2_warc_derivatives


def queries() -> dict:
    return {
        "op1_quality_classifier": op1_quality_classifier,
        "op2_warc_derivatives": op2_warc_derivatives,
        "op3_line_dedup": op3_line_dedup,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_language_mixture": op5_language_mixture,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_token_counts": op8_token_counts,
        "op9_decontaminate": op9_decontaminate,
        "op10_quality_rules": op10_quality_rules,
        "op11_source_divergence": op11_source_divergence,
        "op12_embedding_dedup": op12_embedding_dedup,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc_derivatives": OP2_SQL,
        "op3_line_dedup": OP3_SQL,
        "op4_suffix_dedup": OP4_SQL,
        "op6_jaccard_join": OP6_SQL,
        "op9_decontaminate": OP9_SQL,
        "op10_quality_rules": OP10_SQL,
        "op11_source_divergence": OP11_SQL,
        "op12_embedding_dedup": OP12_SQL,
        "op13_fill_in_middle": OP13_SQL,
    }
