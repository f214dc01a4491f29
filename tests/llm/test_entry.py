import __spark_entry__ as entry

from pagemill.llm.queries import ORACLES, QUERIES


def test_all_thirteen_and_the_pipeline():
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLES) <= set(entry.oracle_sql())
