import datetime
import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowtide.operators import results, sheets
from rowtide.plans import export as ex
from rowtide.sources import catalog
from rowtide.sources.tables import register_tables, run_sql
from suite import ENTRIES


def cells(df):
    return [tuple(r) for r in results.render(df).collect()]


def test_float_text(spark):
    numbers = [1.0, 0.1, 1e10, 1.5e-7, float("nan"), float("inf"), float("-inf"), -0.0, 2e23, 1e21, 123456789.125, -1234.5, 5e-324, None]
    shown = [
        "1", "0.1", "10000000000", "0.00000015", "NaN", "inf", "-inf", "-0", "2" + "0" * 23, "1" + "0" * 21,
        "123456789.125", "-1234.5", "0." + "0" * 323 + "5", "NULL",
    ]
    df = spark.createDataFrame([(x,) for x in numbers], "x DOUBLE")
    assert [c[0] for c in cells(df)] == shown


def test_float_text_is_shortest(spark):
    import random

    random.seed(7)
    numbers = [random.uniform(-1, 1) * 10 ** random.randint(-30, 30) for _ in range(3000)]
    got = [c[0] for c in cells(spark.createDataFrame([(x,) for x in numbers], "x DOUBLE"))]
    for number, text in zip(numbers, got):
        assert "e" not in text.lower() and float(text) == number
        significant = text.replace("-", "").replace(".", "").strip("0")
        expected = repr(abs(number)).split("e")[0].replace(".", "").strip("0")
        assert len(significant) <= len(expected), (number, text)


def test_single_precision(spark):
    df = spark.sql("SELECT cast(x AS float) AS x FROM VALUES (0.1D), (16777216D), (3.4e38D), (123456.7D) AS t(x)")
    assert [c[0] for c in cells(df)] == ["0.1", "16777216", "34" + "0" * 37, "123456.7"]


def test_other_cells(spark):
    df = spark.sql(
        """SELECT true AS b, 42 AS i, 'x' AS s, cast(NULL AS int) AS n, timestamp'2024-01-01 05:06:07.89' AS z,
           timestamp_ntz'2024-01-01 05:06:07.89' AS p, date'2024-01-01' AS d, array(1) AS a, cast(1.50 AS decimal(9,2)) AS q,
           map('k', 1) AS m, named_struct('a', 1) AS r, X'00' AS y, parse_json('{"b": 1, "a": [true, null]}') AS v,
           cast(NULL AS array<int>) AS na, NULL AS nothing"""
    )
    assert cells(df) == [
        (
            "true", "42", "x", "NULL", "2024-01-01 05:06:07 UTC", "2024-01-01 05:06:07", "2024-01-01", "<array>", "1.50",
            "<map>", "<struct>", "<binary>", '{"a":[true,null],"b":1}', "NULL", "NULL",
        )
    ]


def test_limits(spark):
    df = spark.range(700)
    assert results.display(df, 500).count() == 500
    assert results.render(df, 0).count() == 700
    assert results.row_count(df).first()["rows"] == 700


def test_json_records(spark):
    df = spark.sql("SELECT 'b' AS z, 1 AS a, cast(NULL AS int) AS m")
    assert results.json_records(results.render(df)).first()["record"] == '{"a":"1","m":"NULL","z":"b"}'


def read_all(pattern):
    return "".join(open(path, encoding="utf-8").read() for path in sorted(glob.glob(pattern)))


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([(" a ", 'x"y', "", None)], "a STRING, b STRING, c STRING, d STRING").coalesce(1)
    results.write_csv(df, str(tmp_path / "raw"))
    assert read_all(f"{tmp_path}/raw/part-*").splitlines() == ["a,b,c,d", ' a ,"x""y",,']
    results.write_csv(results.render(df), str(tmp_path / "text"))
    assert read_all(f"{tmp_path}/text/part-*").splitlines()[1] == ' a ,"x""y",,NULL'


def test_export(spark, tmp_path, small):
    register_tables(spark, small, ["orders", "region"])
    none = ex.export(spark, str(tmp_path / "none"), "SELECT * FROM orders WHERE false", format="json")
    assert (none.fetched, none.written) == (0, False) and not (tmp_path / "none").exists()
    some = ex.export(spark, str(tmp_path / "some"), "SELECT * FROM orders;", format="csv", limit=10)
    assert some.written and some.fetched == spark.table("orders").count()
    assert spark.read.option("header", True).csv(str(tmp_path / "some")).count() == 10
    statement = tmp_path / "q.sql"
    statement.write_text("SELECT r_name FROM region\n")
    ex.export(spark, str(tmp_path / "json"), file=str(statement), format="json")
    assert read_all(f"{tmp_path}/json/part-*").count('"r_name"') == 5
    ex.export(spark, str(tmp_path / "sheets"), file=str(statement), sheet="a/b*c")
    assert glob.glob(f"{tmp_path}/sheets/sheet_name=abc/*.csv")
    with pytest.raises(ValueError):
        run_sql(spark)
    with pytest.raises(ValueError):
        run_sql(spark, "SELECT 1", str(statement))
    assert ex.query(spark, "SELECT 1 AS a", as_json=True).first()["record"] == '{"a":"1"}'


def test_sheets(spark, tmp_path):
    df = spark.range(2500).repartition(7).orderBy(F.desc("id")).select(F.col("id").cast("string").alias("id"))
    split = sheets.split_sheets(df, 1000).collect()
    assert sorted((r["row_no"], r["sheet"], r["id"]) for r in split) == [
        (i, i // 1000 + 1, str(2499 - i)) for i in range(2500)
    ]
    sheets.write_sheets(df, str(tmp_path / "out"), "Result", 1000)
    for name, rows, first in (("Result", 1000, "2499"), ("Result (2)", 1000, "1499"), ("Result (3)", 500, "499")):
        files = glob.glob(f"{tmp_path}/out/sheet_name={name}/*.csv".replace("(", "[(]").replace(")", "[)]"))
        assert len(files) == 1
        lines = open(files[0]).read().split()
        assert len(lines) == rows + 1 and lines[:2] == ["id", first]


def test_sheet_names(spark):
    names = ["a/b*c", "[]", "x" * 40, "é" * 40, ""]
    df = spark.createDataFrame([(n,) for n in names], "n STRING")
    first = [r[0] for r in df.select(sheets.sheet_name(F.col("n"), F.lit(1))).collect()]
    assert first == ["abc", "Sheet", "x" * 31, "é" * 15, "Sheet"]
    later = [r[0] for r in df.select(sheets.sheet_name(F.col("n"), F.lit(12))).collect()]
    assert later == ["abc (12)", "Sheet (12)", "x" * 26 + " (12)", "é" * 13 + " (12)", "Sheet (12)"]


def test_cell_kinds(spark):
    kinds = {
        "NULL": "null", "1e5": "number", "007": "number", ".5": "number", "5.": "number", "nan": "number", "-inf": "number",
        "true": "boolean", "True": "text", " 12 ": "text", "1d": "text", "abc": "text", "": "text", "1e": "text", ".": "text",
    }
    df = spark.createDataFrame([(k,) for k in kinds], "c STRING")
    assert [r[0] for r in df.select(sheets.cell_kind(F.col("c"))).collect()] == list(kinds.values())


def test_widths(spark):
    df = spark.createDataFrame([(1, "é" * 10, "x" * 100, "1"), (1, "a", "b", "2")], "sheet INT, w STRING, long STRING, s STRING")
    assert {r["column"]: r["width"] for r in sheets.column_widths(df).collect()} == {"w": 12, "long": 62, "s": 8}


def test_pretty_sizes(spark):
    sizes = {
        0: "0 bytes", 10239: "10239 bytes", 10240: "10 kB", 10 * 2**20 - 513: "10239 kB", 10 * 2**20: "10 MB",
        3 * 2**40: "3072 GB", 5 * 2**50: "5120 TB", 50 * 2**50: "50 PB",
    }
    df = spark.createDataFrame([(k,) for k in sizes], "b BIGINT")
    assert [r[0] for r in df.select(catalog.pretty_size(F.col("b"))).collect()] == list(sizes.values())


def test_pretty_sizes_beyond_bigint(spark):
    unit = 2**50
    sizes = {
        2**63 - 1: "8192 PB", 2**63: "8192 PB", 8200 * unit + unit // 2 - 1: "8200 PB", 8200 * unit + unit // 2: "8201 PB",
        10**37: f"{(10**37 + unit // 2) // unit} PB", -(2**64): f"{-(2**64)} bytes", 10240: "10 kB", 0: "0 bytes",
    }
    df = spark.createDataFrame([(Decimal(k),) for k in [*sizes]] + [(None,)], "b DECIMAL(38,0)")
    assert [r[0] for r in df.select(catalog.pretty_size(F.col("b"))).collect()] == [*sizes.values(), None]


@pytest.mark.parametrize("most", [1_000, 54_000_000])
def test_pretty_size_query_over_large_keys(spark, tmp_path, most):
    rows = [(1, 15_000), (most, 15_000), (most, None), (None, 3), (0, 7), (-2, 5)]
    spark.createDataFrame(rows, "o_orderkey BIGINT, o_custkey BIGINT").write.parquet(f"{tmp_path}/orders.parquet")
    found = ENTRIES["S8_pretty_size"].run(spark, str(tmp_path))
    large = most > 1_000
    assert dict(found.dtypes)["bytes"] == ("decimal(38,0)" if large else "bigint")  # BIGINT wherever SQL has a result
    text = "38849 PB" if large else "14 GB"
    expected = [(1, 15_000, "15 kB"), (most, most * most * 15_000, text), (most, None, None), (None, None, None)]
    expected += [(0, 0, "0 bytes"), (-2, 20, "20 bytes")]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected if not large else [
        (k, None if b is None else Decimal(b), s) for k, b, s in expected
    ], key=str)


def test_catalog(spark, small):
    tables = catalog.list_tables(catalog.table_sizes(spark, small)).collect()
    assert [r["table"] for r in tables] == sorted(r["table"] for r in tables) and len(tables) == 14
    register_tables(spark, small, ["orders"])
    assert ("", "orders") in {tuple(r) for r in catalog.registered_tables(spark).collect()}


def test_activity(spark):
    when = datetime.datetime(2024, 1, 1)
    rows = [(1, "u", None, None, "idle", None), (2, None, "a", None, "active", when), (3, "x", "y", None, None, when)]
    schema = "pid INT, usename STRING, application_name STRING, client_addr STRING, state STRING, query_start TIMESTAMP"
    got = catalog.active_sessions(spark.createDataFrame(rows, schema)).collect()
    assert [tuple(r) for r in got] == [(2, "", "a", "active"), (1, "u", "", "idle")]


def test_names_of_any_kind_are_kept(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS a, 3 AS `b``c`, 0.5D AS sheet, 'keep' AS row_no, 'z' AS _part")
    rendered = results.render(df)
    assert rendered.columns == df.columns
    assert tuple(rendered.first()) == ("1", "2", "3", "0.5", "keep", "z")
    record = results.json_records(rendered).first().record
    assert record == '{"_part":"z","a":"2","b`c":"3","row_no":"keep","sheet":"0.5"}'
    split = sheets.split_sheets(rendered)
    assert tuple(split.first()) == ("1", "2", "3", "0.5", "keep", "z", 0, 1)
    assert split.columns[-2:] == ["_row_no", "_sheet"]
    assert {r.column for r in sheets.column_widths(split).collect()} == set(df.columns)


def test_written_sheets_keep_their_order(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).selectExpr("cast(999 - id AS string) AS value", "'x' AS sheet_name")
    sheets.write_sheets(df, str(tmp_path / "out"), "Numbers", 30)
    folders = sorted(p for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert len(folders) == 34
    seen = []
    for folder in folders:
        (file,) = folder.glob("*.csv")
        header, *rows = file.read_text().splitlines()
        values = [int(r.split(",")[0]) for r in rows]
        assert header == "value,sheet_name" and values == sorted(values, reverse=True)
        seen += values
    assert sorted(seen) == list(range(1000))


def test_line_ends_do_not_pass(spark):
    from rowtide.functions import lsn

    kinds = spark.sql("SELECT explode(array('12', '12\\n')) AS c").select(sheets.cell_kind(F.col("c")).alias("k"))
    assert [r.k for r in kinds.collect()] == ["number", "text"]
    parsed = spark.sql("SELECT explode(array('0/1F', '0/1F\\n')) AS c").select(lsn.parse_lsn(F.col("c"), False).alias("p"))
    assert [r.p for r in parsed.collect()] == [31, None]
    for bad in (" 0x1_0/ 1", "-1/2", "1/" + "F" * 40, "1/2\n"):
        with pytest.raises(ValueError):
            lsn.parse_position(bad)
    assert lsn.parse_position("1/F") == (1 << 32) + 15


def test_nothing_is_cut_unless_asked(spark):
    assert results.display(spark.range(700)).count() == 700
