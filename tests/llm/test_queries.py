import duckdb
import pytest

import __spark_entry__ as entry
from cratewise.llm.oracle import ORACLE_SQL
from cratewise.llm.queries import QUERIES
from tools.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"

COLUMNS = {
    "op1": "page_id host path rule verdict",
    "op2": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op3": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op4": "doc_id n_shingles component_id",
    "op5": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op6": "doc_id n_words n_removed kept_sha256",
    "op7": "doc_id held_out score predicted",
    "op8": "doc_id held_out lang_pred score",
    "op9": "doc_id keep_id group_size kept text_sha256",
    "op10": "doc_id size source_size target taken",
    "op11": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op12": "vec_id n_links component_id kept",
    "op13": "lang rank phrase a l r n score",
}

SOURCES = {"op1": "pages", "op12": "embeddings"}


def test_all_are_registered():
    found = entry.queries()
    assert set(QUERIES) <= set(found) and "pipeline" in found
    assert [name.split("_")[0] for name in QUERIES] and {n.split("_")[0] for n in QUERIES} == set(COLUMNS)
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_a_row_per_row_of_the_table_with_the_contract_columns(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(df.columns)
    source = SOURCES.get(name.split("_")[0], "documents")
    if name.startswith("op13_"):
        return
    assert df.count() == duckdb.sql(f"select count(*) from '{SF_DIR}/{source}.parquet'").fetchall()[0][0]


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_equal_to_the_oracle(spark, name):
    note, _, _ = compare(spark, duck(SF_DIR), name, SF_DIR)
    assert note is None or note.startswith("types"), note


def test_equal_texts_count_in_both_digests(spark):
    """Base digests of spans by brute force over the whole sample."""
    import hashlib

    from cratewise.llm.tables import table
    from tests.llm.test_pii import brute as personal
    from tests.llm.test_secrets import brute as secret

    texts = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    for name, brute in (("op2_personal_data", personal), ("op5_secret_scan", secret)):
        for row in QUERIES[name](spark, SF_DIR).collect():
            spans = ",".join(f"{k}:{a}:{z}" for k, a, z in brute(texts[row.doc_id]))
            assert row.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
            assert set(filter(None, spans.split(","))) <= set(row.spans.split(","))
