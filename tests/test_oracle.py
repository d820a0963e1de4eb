"""Every registered query against its SQL oracle on the smallest driver tables."""

import hashlib

import duckdb
import pytest

from conftest import SF_SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, (list, tuple)):
            return tuple(norm(x) for x in v)
        if isinstance(v, float):
            return repr(v)
        if hasattr(v, "isoformat"):
            return v.isoformat()
        return v

    return sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _names():
    import __spark_entry__ as E

    return sorted(E.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E

    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    a, b = _rows(df.columns, srows), _rows(dcols, drows)
    assert hashlib.sha256("\n".join(a).encode()).digest() == hashlib.sha256(
        "\n".join(b).encode()
    ).digest(), (set(a) - set(b), set(b) - set(a))


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert len(df.columns) == 32
    assert df.count() > 0


def test_every_query_has_oracle():
    import __spark_entry__ as E

    from tickerlake.registry import BY_NAME

    assert set(BY_NAME) <= set(E.queries()) and set(BY_NAME) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_schema_is_the_contract(spark):
    """The smoke-checked flagship has exactly the declared names and types."""
    import __spark_entry__ as E
    from tickerlake import contract
    from tickerlake.registry import BY_NAME

    df = E.entry(spark)
    spec = contract.parse_spec(BY_NAME["daily_stock_analysis"].spec)
    assert [f.name for f in df.schema.fields] == [n for n, _ in spec]
    assert [f.dataType.simpleString() for f in df.schema.fields] == [
        contract.SPARK_TYPES[c] for _, c in spec
    ]
