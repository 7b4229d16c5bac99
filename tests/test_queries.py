"""Every registered query against its SQL counterpart, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from suite import ENTRIES
from tools.check_queries import normal, rows_of

# Their SQL names the folder the driver checks with.
BY_FOLDER = {"S6_list_databases", "S7_list_tables", "S8_table_sizes"}


@pytest.fixture(scope="module")
def connection(small_folder="/root/testdata/sf0.001"):
    made = duckdb.connect()
    for path in glob.glob(f"{small_folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        made.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return made


@pytest.mark.parametrize("name", sorted(set(ENTRIES) - BY_FOLDER))
def test_query(spark, connection, small, name):
    entry = ENTRIES[name]
    df = entry.run(spark, small)
    names, rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(entry.oracle)
    other_names, other = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert names == other_names
    assert len(rows) == len(other)
    assert rows == other
    assert normal(1.0) == 1.0


def test_every_operator_is_registered():
    groups = {"S": 9, "D": 24, "F": 9, "P": 8, "W": 6, "N": 14, "R": 15, "T": 8}
    registered = {name.split("_")[0] for name in ENTRIES}
    assert {f"{g}{i}" for g, n in groups.items() for i in range(1, n + 1)} == registered
    assert all(entry.oracle for entry in ENTRIES.values())
