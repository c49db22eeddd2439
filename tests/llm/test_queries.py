"""Every query of the text operators: against its SQL, on awkward rows, on an empty table, and with equal reruns."""

import pytest

import __spark_entry__ as entry
from checks.compare import open_tables, rows
from mediaspark.llm.queries import ORACLES, QUERIES, VARIANT_ORACLES, VARIANTS
from tests.llm.helpers import FOLDER, ROWS, awkward, conversations, folder_of, key_counts, nothing

PER_DOCUMENT = [name for name in QUERIES if not name.startswith(("op10_", "op11_"))]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return folder_of(spark, tmp_path_factory.mktemp("odd"), awkward(spark))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return folder_of(spark, tmp_path_factory.mktemp("empty"), nothing(spark), talks=conversations(spark).where("false"))


def test_thirteen_queries_and_the_pipeline_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    relation = open_tables(FOLDER).sql(ORACLES[name])
    assert rows(df.columns, df.collect()) == rows(relation.columns, relation.fetchall())


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_awkward_rows_give_a_row_each(spark, odd, name):
    expected = sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x or 0))
    assert key_counts(QUERIES[name](spark, odd)) == expected


def test_every_conversation_has_a_row(spark, odd):
    found = key_counts(QUERIES["op11_conversation_repair"](spark, odd), "conv_id")
    assert found == sorted({r[0] for r in ROWS}, key=lambda x: (x is not None, x or 0))


@pytest.mark.parametrize("name", list(QUERIES))
def test_an_empty_table_gives_no_rows(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("op10_")])
def test_reruns_agree(spark, odd, name):
    first, again = (sorted(map(repr, QUERIES[name](spark, odd).collect())) for _ in range(2))
    assert first == again


@pytest.mark.parametrize("name", ["op2_license_scan", "op4_imatch_fingerprints", "op6_rendezvous_sharding"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


@pytest.mark.parametrize("name", list(VARIANT_ORACLES))
def test_variant_equals_its_sql(spark, name):
    df = VARIANTS[name](spark, FOLDER)
    relation = open_tables(FOLDER).sql(VARIANT_ORACLES[name])
    assert rows(df.columns, df.collect()) == rows(relation.columns, relation.fetchall())


@pytest.mark.parametrize("name", list(VARIANTS))
def test_variants_take_awkward_rows_and_empty_tables(spark, odd, empty, name):
    assert name in entry.queries()
    assert key_counts(VARIANTS[name](spark, odd)) == sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x or 0))
    assert VARIANTS[name](spark, empty).count() == 0
