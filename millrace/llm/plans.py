"""The queries of this subpackage by name, and the SQL of those that can be said in it (for the
others see the tests)."""

from millrace.llm import (
    binary_output,
    decontamination,
    language_id,
    line_dedup,
    near_dedup,
    packing,
    quality,
    quality_rules,
    secrets,
    spelling,
    substring_dedup,
    toxicity,
    vector_codes,
)

QUERIES = {
    "op1_decontamination": decontamination.query,
    "op2_secret_scan": secrets.query,
    "op3_binary_records": binary_output.query,
    "op4_quality_classifier": quality.query,
    "op5_substring_dedup": substring_dedup.query,
    "op6_quality_rules": quality_rules.query,
    "op7_toxicity": toxicity.query,
    "op8_near_dedup": near_dedup.query,
    "op9_packing": packing.query,
    "op10_line_dedup": line_dedup.query,
    "op11_vector_codes": vector_codes.query,
    "op12_spelling_variants": spelling.query,
    "op13_language_id": language_id.query,
}
SQL: dict[str, str] = {
    "op11_vector_codes": vector_codes.sql(),
    "op12_spelling_variants": spelling.sql(),
    "op8_near_dedup": near_dedup.sql(),
}
