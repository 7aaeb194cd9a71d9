"""The registered queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from tideline.llm import collocations, conversations, fingerprints, html, jaccard, language, mixing, neighbours, packing, repeats, rules, sharding, simhash

QUERIES = {
    "op1_neighbours": neighbours.op1_neighbours,
    "op2_mixing": mixing.op2_mixing,
    "op3_rules": rules.op3_rules,
    "op4_repeats": repeats.op4_repeats,
    "op5_jaccard": jaccard.op5_jaccard,
    "op6_packing": packing.op6_packing,
    "op7_html": html.op7_html,
    "op8_language": language.op8_language,
    "op9_fingerprints": fingerprints.op9_fingerprints,
    "op10_sharding": sharding.op10_sharding,
    "op11_collocations": collocations.op11_collocations,
    "op12_conversations": conversations.op12_conversations,
    "op13_simhash": simhash.op13_simhash,
}

ORACLES: dict[str, str] = {"op2_mixing": mixing.ORACLE, "op11_collocations": collocations.ORACLE}
