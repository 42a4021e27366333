"""Compare catalogue queries with their SQL statements on the benchmark tables."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _family(kind: str) -> str:
    kind = kind.lower()
    for family, starts in {
        "int": ("tinyint", "smallint", "int", "bigint", "hugeint", "long"),
        "float": ("double", "float", "decimal"),
        "text": ("varchar", "string"),
    }.items():
        if kind.startswith(starts):
            return family
    return kind


def _rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return repr(v + 0.0)
        if isinstance(v, list):
            return repr([cell(x) for x in v])
        return repr(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in data)


def compare(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else a description of the difference."""
    relation = con.sql(sql)
    want_cols, want_types = list(relation.columns), [str(t) for t in relation.types]
    got_cols = spark_df.columns
    if sorted(got_cols) != sorted(want_cols):
        return f"columns differ: {sorted(got_cols)} / {sorted(want_cols)}"
    got_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    for name, kind in zip(want_cols, want_types):
        if _family(got_types[name]) != _family(kind):
            return f"type of {name}: {got_types[name]} / {kind}"
    got = _rows(got_cols, [tuple(r) for r in spark_df.collect()])
    want = _rows(want_cols, relation.fetchall())
    if got == want:
        return None
    extra = [r for r in set(got) - set(want)][:3]
    missing = [r for r in set(want) - set(got)][:3]
    names = sorted(got_cols)
    return f"{len(got)} / {len(want)} rows\n  {names}\n  only here: {extra}\n  only there: {missing}"


def main(sf_dir: str, names: list[str]) -> int:
    from kerbflow.catalogue import all_queries
    from kerbflow.session import get_session

    spark = get_session(
        master="local[8]",
        shuffle_partitions=8,
        conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            df = query.build(spark, sf_dir)
            if query.sql is None:
                problem, note = None, f"rows only: {df.count()}"
            else:
                problem = compare(df, con, query.sql)
                note = f"{con.sql(f'select count(*) from ({query.sql})').fetchall()[0][0]} rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, note = f"{type(error).__name__}: {str(error)[:1500]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - began:.1f}s {note} {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
