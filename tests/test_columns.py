import math
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from sluicework.functions.avro_schema import AvroSchemaError, struct_from_avro, struct_from_avsc
from sluicework.functions.text import count_label, decode_base64, encode_base64, join_texts, pack, unpack
from sluicework.operators import columns


def test_clean_names_collisions():
    assert columns.clean_names(["a b", "a-b", "A.B", "c"]) == ["ab", "ab_2", "AB_3", "c"]
    assert columns.clean_names(["a b", "a-b"], "_") == ["a_b", "a_b_2"]


def test_lower_case_collision(spark):
    df = spark.createDataFrame([(1, 2)], ["Aa", "B"])
    assert columns.lower_case_columns(df).columns == ["aa", "b"]
    with pytest.raises(columns.ColumnNameError):
        columns.lower_case_columns(spark.createDataFrame([(1, 2)], ["a", "A"]))


def test_cast_text_record(spark):
    schema = T.StructType.fromDDL("a INT, b DECIMAL(10,2), c STRING, d DATE, e BOOLEAN, f STRING")
    df = spark.createDataFrame([("7", "1,234.5", "", "2024-02-29", "true"), ("", "", None, "", "")], "a string, b string, c string, d string, e string")
    assert rows(columns.cast_text_record(df, schema)) == sorted([
        (7, Decimal("1234.50"), "", date(2024, 2, 29), True, ""), (None, None, "", None, None, "")], key=repr)


def test_cast_text_record_rejects(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        columns.cast_text_record(df, T.StructType.fromDDL("a INT")).collect()
    with pytest.raises(TypeError, match="unsupported"):
        columns.cast_text_record(df, T.StructType.fromDDL("a ARRAY<INT>"))
    required = T.StructType([T.StructField("b", T.IntegerType(), nullable=False)])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        columns.cast_text_record(df, required).collect()


def test_nullify(spark):
    df = spark.createDataFrame([(math.nan, "nan", 1), (1.5, "NaT", 2), (None, "x", None)], "a double, b string, c int")
    assert rows(columns.nullify(df)) == sorted([(None, None, 1), (1.5, None, 2), (None, "x", None)], key=repr)


def test_cast_to_target_order_and_case(spark):
    df = spark.createDataFrame([("1", "2", "x")], "b string, A string, extra string")
    out = columns.cast_to_target(df, T.StructType.fromDDL("a BIGINT, gone INT, B DOUBLE"))
    assert out.dtypes == [("a", "bigint"), ("B", "double")]
    assert rows(out) == [(2, 1.0)]


def test_pack_skips_nulls_and_unpack_out_of_range(spark):
    df = spark.createDataFrame([("a", None, "ü"), ("b", "c", "d")], "x string, y string, z string")
    packed = df.select(pack("x", "y", "z").alias("v"))
    assert rows(packed) == [("a~~ü",), ("b~~c~~d",)]
    assert rows(packed.select(unpack("v", 1), unpack("v", 2))) == sorted([("ü", None), ("c", "d")], key=repr)


def test_count_label_edges(spark):
    df = spark.createDataFrame([(v,) for v in ("0", "1", "10", "11", "20", "21", "50", "51", "x", None)], "v string")
    labels = [r[0] for r in df.select(count_label(F.col("v"))).collect()]
    assert labels == ["50+ Participant", "1 Participant", "10 Participant", "11-20 Participant", "11-20 Participant",
                      "20-50 Participant", "20-50 Participant", "50+ Participant", "50+ Participant", "50+ Participant"]


def test_join_texts_and_base64(spark):
    df = spark.createDataFrame([(["a", "b"], "héllo"), ([], ""), (None, None)], "a array<string>, s string")
    assert [tuple(r) for r in df.select(join_texts("a"), decode_base64(encode_base64("s"))).collect()] == [
        ("a,b", "héllo"), (None, ""), (None, None)]


AVRO = """{"type":"record","name":"R","fields":[
 {"name":"s","type":"string"},{"name":"n","type":["null","int"]},{"name":"l","type":["int","long"]},
 {"name":"f","type":["null","float","double"]},{"name":"b","type":"bytes"},
 {"name":"a","type":{"type":"array","items":["null","string"]}},{"name":"m","type":{"type":"map","values":"double"}},
 {"name":"e","type":{"type":"enum","name":"E","symbols":["A"]}},{"name":"e2","type":"E"},
 {"name":"r","type":["null",{"type":"record","name":"Inner","fields":[{"name":"x","type":"boolean"}]}]},
 {"name":"d","type":{"type":"bytes","logicalType":"decimal","precision":9,"scale":2}},
 {"name":"t","type":{"type":"long","logicalType":"timestamp-millis"}},
 {"name":"u","type":["string","int"]}]}"""


def test_avro_conversion(tmp_path):
    schema = struct_from_avro(AVRO)
    assert schema.simpleString() == (
        "struct<s:string,n:int,l:bigint,f:double,b:binary,a:array<string>,m:map<string,double>,e:string,e2:string,"
        "r:struct<x:boolean>,d:decimal(9,2),t:timestamp,u:struct<member0:string,member1:int>>")
    assert schema["s"].nullable is False and schema["n"].nullable is True and schema["r"].nullable is True
    (tmp_path / "r.avsc").write_text(AVRO)
    assert struct_from_avsc(str(tmp_path), "r") == schema
    with pytest.raises(AvroSchemaError):
        struct_from_avro('"string"')
    with pytest.raises(AvroSchemaError):
        struct_from_avro('{"type":"record","name":"R","fields":[{"name":"a","type":"nope"}]}')
