"""Registration and the DuckDB twins of the operators that SQL can express."""

import pytest

import __spark_entry__ as E
from starmart.llm.queries import ORACLE, QUERIES
from tests.oracle_harness import compare, duck, type_mismatches

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    numbers = [n[2:].split("_")[0] for n in E.queries() if n.startswith("op")]
    assert sorted(map(int, numbers)) == list(range(1, 14))
    assert "pipeline" in E.queries() and set(ORACLE) <= set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SF), name, E.queries()[name], ORACLE[name], SF)
    assert r["cols"], (r["spark_cols"], r["duck_cols"])
    assert r["values"], (r["s_only"], r["d_only"])
    assert not type_mismatches(r["schema"], r["duck_types"])


COLUMNS = {
    "op2_embedding_near_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op3_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                         "labels", "score"],
    "op4_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
    "op5_html_extraction": ["page_id", "url", "text", "n_chars"],
    "op6_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op7_repeat_removal": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op8_mix_sources": ["doc_id", "size", "source_size", "target", "taken"],
    "op9_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op11_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                           "runs_sha256", "collapsed_sha256"],
    "op12_token_ids": ["doc_id", "start", "n_tokens", "ids_crc32"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns_and_whole_tables(spark, name):
    out = E.queries()[name](spark, SF)
    assert out.columns[:len(COLUMNS[name])] == COLUMNS[name]
    table = {"op2": "embeddings", "op5": "pages"}.get(name[:3], "documents")
    assert out.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_the_rest_does_without_this_subpackage():
    """Nothing outside imports it, but for the guarded entry."""
    import pathlib
    root = pathlib.Path(E.ROOT)
    for p in root.glob("starmart/**/*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "starmart.llm" not in p.read_text(), p
