import importlib.util

import pytest

import __spark_entry__ as E
from tests.compare import differing, views

from .conftest import DATA, needs_data


@needs_data
def test_flagship(spark):
    rows = E.entry(spark).collect()
    assert rows and all(r.text is not None for r in rows)


def test_names():
    assert set(E.oracle_sql()) <= set(E.queries())
    if importlib.util.find_spec("sonoweave.llm"):
        assert {"p1_found", "p3_found", "p4_found", "p6_ids", "p8_found"} <= set(E.queries())


@needs_data
@pytest.mark.parametrize("name", sorted(set(E.oracle_sql())))
def test_query_equals_sql(spark, name):
    con = views(DATA)
    assert differing(E.queries()[name](spark, str(DATA)).toPandas(), con.execute(E.oracle_sql()[name]).df()) == []


@needs_data
@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_query_has_rows_of_its_schema(spark, name):
    """Queries without SQL, whose results are tested against brute force elsewhere: rows and no column that is always null."""
    df = E.queries()[name](spark, str(DATA))
    rows = df.collect()
    assert rows or name == "unsupported_languages"
    for i, c in enumerate(df.columns):
        assert not rows or any(r[i] is not None for r in rows), c
    assert len(set(map(repr, rows))) == len(rows)


def test_a_cluster_must_name_a_shared_folder(monkeypatch):
    from types import SimpleNamespace as N

    from sonoweave import session

    unset = N(isDefined=lambda: False)
    context = N(_jsc=N(sc=lambda: N(getCheckpointDir=lambda: unset)), getConf=lambda: N(get=lambda k, d: d), master="spark://host:7077")
    with pytest.raises(RuntimeError, match="share"):
        session.ensure_checkpoint_dir(N(sparkContext=context))
