"""Compare a Spark result with a DuckDB one, row for row, whatever the order."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir, sql):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    types = {d[0]: str(d[1]) for d in relation.description}
    return names, types, relation.fetchall()


# DuckDB type -> Spark type, for the types the results use.
TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
    "DOUBLE": "double", "BLOB": "binary", "BOOLEAN": "boolean",
}


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple("\0null" if row[i] is None else str(row[i]) for i in order) for row in rows)


def assert_same(df, sf_dir, sql):
    names, types, expected = duck(sf_dir, sql)
    assert sorted(df.columns) == sorted(names)
    assert dict(df.dtypes) == {n: TYPES[t] for n, t in types.items()}
    got = multiset(df.columns, [tuple(r) for r in df.collect()])
    want = multiset(names, expected)
    assert len(got) == len(want)
    assert got == want
    return len(got)
