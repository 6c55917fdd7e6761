"""Compare a Spark result with its SQL twin: names, kinds of types, rows as a multiset."""

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def differences(spark_df, con, sql):
    """A text about the first difference, or None."""
    left = spark_df.toArrow()
    right = con.execute(sql).to_arrow_table()
    columns = sorted(left.column_names)
    if columns != sorted(right.column_names):
        return f"columns {columns} / {sorted(right.column_names)}"
    for name in columns:
        kinds = [str(t.schema.field(name).type).replace("large_", "") for t in (left, right)]
        if kinds[0] != kinds[1]:
            return f"type of {name}: {kinds[0]} / {kinds[1]}"
    if left.num_rows != right.num_rows:
        return f"rows {left.num_rows} / {right.num_rows}"
    rows = [sorted(zip(*(t.column(c).to_pylist() for c in columns)), key=repr) for t in (left, right)]
    for a, b in zip(*rows):
        if a != b:
            return f"row {dict(zip(columns, a))} / {dict(zip(columns, b))}"
    return None
