"""Every training-data query is held against SQL or against a brute-force test that is named here and exists."""

from pathlib import Path

from strata.llm.queries import ORACLES, QUERIES

#: Queries that SQL cannot express, and the tests that check their results.
BRUTE_FORCE = {
    "op2_repeats": ["test_repeats_against_brute_force"],
    "op3_html": ["test_html"],
    "op5_quality": ["test_quality_learns_form", "test_factorisation_machine_identity"],
    "op6_pii": ["test_base_spans_are_those_of_the_rules", "test_pii_adds_and_redacts"],
    "op7_fingerprint": ["test_fingerprints"],
    "op8_neardup": ["test_near_duplicates_against_brute_force"],
    "op9_language": ["test_language"],
    "op12_lm_score": ["test_base_equals_brute_force", "test_state_is_carried_across_windows", "test_training_beats_the_counts_on_held_out_documents"],
}


def test_every_query_has_sql_or_a_named_test():
    assert set(QUERIES) == set(ORACLES) | set(BRUTE_FORCE)
    assert not set(ORACLES) & set(BRUTE_FORCE)
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    text = "".join(p.read_text() for p in Path(__file__).parent.glob("test_*.py"))
    missing = [t for names in BRUTE_FORCE.values() for t in names if f"def {t}(" not in text]
    assert missing == []
