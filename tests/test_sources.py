import datetime as dt
import json
from decimal import Decimal

import pytest
from helpers import frame, rows_of

from lumbung.plans.pipeline import document_sources, dump_sources, file_sources, jdbc_sources
from lumbung.plans.schemas import SOURCES
from lumbung.sources.readers import (
    SqlDump,
    TableSource,
    csv_to_documents,
    empty_table,
    literal_table,
    read_sql_dump,
    read_table,
)

SCHEMA = "id string, day date, n int"


def test_csv_has_declared_types_and_null_for_malformed_values(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,day,n\na,2024-01-05,1\n"b,c",no date,x\n')
    df = read_table(spark, TableSource("t", SCHEMA, "csv", str(tmp_path / "t.csv")))
    assert rows_of(df) == [("a", dt.date(2024, 1, 5), 1), ("b,c", None, None)]


def test_json_and_parquet(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"id": "a", "n": 1, "other": 2}) + "\n")
    df = read_table(spark, TableSource("t", SCHEMA, "json", str(tmp_path / "t.json")))
    assert rows_of(df) == [("a", None, 1)]
    df.write.parquet(str(tmp_path / "t.parquet"))
    back = read_table(spark, TableSource("t", SCHEMA, "parquet", str(tmp_path / "t.parquet")))
    assert rows_of(back) == rows_of(df)


def test_missing_file(spark, tmp_path):
    path = str(tmp_path / "none.csv")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, TableSource("t", SCHEMA, "csv", path)).collect()
    df = read_table(spark, TableSource("t", SCHEMA, "csv", path, optional=True))
    assert df.count() == 0 and df.columns == ["id", "day", "n"]
    assert df.select("day").where("n > 1").count() == 0


def test_empty_and_literal_tables(spark):
    assert empty_table(spark, SCHEMA).dtypes == [("id", "string"), ("day", "date"), ("n", "int")]
    assert rows_of(literal_table(spark, [("a", None, 1)], SCHEMA)) == [("a", None, 1)]


DUMP = """
-- users
INSERT INTO `u` VALUES
('USR001','O''Brien, Pat','2024-01-05',70,NULL),
('USR002','(brackets), too','2023-12-31',65.5,'x');
INSERT INTO `k` VALUES
('KLS001','not a user','2024-01-01',1,'USR001');
"""


def test_sql_dump(spark, tmp_path):
    path = tmp_path / "dump.sql"
    path.write_text(DUMP)
    schema = "id string, name string, day date, score decimal(5,1), note string"
    df = read_sql_dump(spark, str(path), schema, SqlDump("USR"))
    assert rows_of(df) == [
        ("USR001", "O'Brien, Pat", dt.date(2024, 1, 5), Decimal("70.0"), None),
        ("USR002", "(brackets), too", dt.date(2023, 12, 31), Decimal("65.5"), "x"),
    ]


def test_csv_to_documents(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,day,n\na,2024-01-05,1\n")
    tables = [
        TableSource("t", SCHEMA, "csv", str(tmp_path / "t.csv")),
        TableSource("gone", SCHEMA, "csv", str(tmp_path / "gone.csv")),
    ]
    target = str(tmp_path / "documents")
    assert csv_to_documents(spark, tables, target) == ["t"]
    df = read_table(spark, TableSource("t", SCHEMA, "json", f"{target}/t"))
    assert rows_of(df) == [("a", dt.date(2024, 1, 5), 1)]


def test_source_specifications():
    files = file_sources("/data", {"kj": "json", "pn": "csv"})
    assert files["pn"]["enrolmen_program"].path == "/data/pn/enrolemen.csv"
    assert files["kj"]["pengguna"].path == "/data/kj/pengguna"
    split = {"partitionColumn": "skor", "lowerBound": "0", "upperBound": "1000", "numPartitions": "8"}
    jdbc = jdbc_sources("zb", "jdbc:mysql://h/db", {"user": "u"}, {"nilai_tryout": split})
    assert jdbc["nilai_tryout"].options["numPartitions"] == "8"
    assert jdbc["member"].options == {"url": "jdbc:mysql://h/db", "dbtable": "member", "user": "u"}
    documents = document_sources("kj", "mongodb://h", "kj")
    assert documents["pengguna"].options["collection"] == "pengguna"
    assert set(dump_sources("rc", "/d.sql")) == set(SOURCES["rc"])
    assert sum(len(tables) for tables in SOURCES.values()) == 28


def test_frames_have_no_place_for_silent_schema_drift(spark):
    df = frame(spark, "id string", ("a",))
    from lumbung.sources.readers import conform_schema

    assert conform_schema(df, SCHEMA).columns == ["id"]
