from pyspark.sql import types as T

from farelake.schemas import PASSENGER_CSV_SCHEMA
from farelake.session import Staging
from farelake.sources import rejects

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("t", T.StringType()), T.StructField("x", T.DoubleType())])


def read(spark, path, schema=SCHEMA):
    good, bad = rejects.split_csv(spark, str(path), schema, Staging(spark))
    return good, bad


def test_bad_lines_are_kept_with_file_and_reason(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,t,x\n1,one,1.5\ntwo,two,2\n,"a, ""b""",\n4,four\n\n5,five,5,5\nx,"q, r",y\n')
    (tmp_path / "b.csv").write_text("k,t,x\n6,six,6\n7,seven,seven\n")
    good, bad = read(spark, tmp_path)
    assert sorted(map(tuple, good.collect()), key=str) == [(1, "one", 1.5), (6, "six", 6.0), (None, 'a, "b"', None)]
    assert sorted((r["file"][-5:], r["line"], r["reason"]) for r in bad.collect()) == [
        ("a.csv", "4,four", "number of fields"), ("a.csv", "5,five,5,5", "number of fields"),
        ("a.csv", "two,two,2", "no value: k"), ("a.csv", 'x,"q, r",y', "no value: k, x"), ("b.csv", "7,seven,seven", "no value: x")]
    assert sorted((r["file"][-5:], r["reason"], r["lines"]) for r in rejects.rejects_per_file(bad).collect()) == [
        ("a.csv", "no value: k", 1), ("a.csv", "no value: k, x", 1), ("a.csv", "number of fields", 2), ("b.csv", "no value: x", 1)]


def test_few_columns_do_not_change_which_rows_are_good(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,t,x\n1,one,bad\n2,two,2\n")
    good, bad = read(spark, tmp_path)
    assert [r["t"] for r in good.select("t").collect()] == ["two"] and good.count() == 1 and bad.select("line").count() == 1


def test_files_without_lines_and_passengers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,t,x\n")
    good, bad = read(spark, tmp_path)
    assert good.count() == bad.count() == 0 and good.columns == SCHEMA.names
    header = ",".join(PASSENGER_CSV_SCHEMA.names)
    (tmp_path / "p.csv").write_text(f'{header}\n1,0,3,"B, Mr ""C""",male,22,1,0,A,7.25,,S\n2,1,first,D,female,,0,0,B,8,C1,C\n')
    good, bad = read(spark, tmp_path / "p.csv", PASSENGER_CSV_SCHEMA)
    assert [(r["Name"], r["Cabin"]) for r in good.collect()] == [('B, Mr "C"', None)]
    assert [r["reason"] for r in bad.collect()] == ["no value: Pclass"]
