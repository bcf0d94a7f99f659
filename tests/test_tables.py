"""Tables, views, files and messages."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plan import plan
from strataflow.functions import decode_json, encode_json
from strataflow.sources import (
    append,
    create_table,
    create_table_like,
    export_csv,
    kafka_options,
    overwrite,
    publish,
    read_csv,
    read_table,
    schema_ddl,
    scratch_path,
    write_batch,
    write_messages,
)
from strataflow.spec import FeatureSpec, TableFormat

FORMATS = ["parquet", "orc", "json"]
STREAMED = TableFormat(streamed=True)


def values(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("fmt", FORMATS)
def test_overwrite_replaces_rows_and_schema(spark, database, fmt):
    table, fmt = f"{database}.t", TableFormat(fmt)
    overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string"), table, fmt)
    overwrite(spark.createDataFrame([("c", 3.0)], "z string, w double"), table, fmt)
    assert read_table(spark, table).columns == ["z", "w"]
    assert values(read_table(spark, table)) == [("c", 3.0)]


@pytest.mark.parametrize("fmt", FORMATS)
def test_append_matches_columns_by_name(spark, database, fmt):
    table, fmt = f"{database}.t", TableFormat(fmt)
    create_table(spark, table, "x INT, y STRING", fmt)
    create_table(spark, table, "x INT, y STRING", fmt)
    append(spark.createDataFrame([(1, "a")], "x int, y string"), table, fmt)
    append(spark.createDataFrame([("b", 2)], "y string, x int"), table, fmt)
    assert values(read_table(spark, table)) == [(1, "a"), (2, "b")]
    with pytest.raises(AnalysisException):
        append(spark.createDataFrame([(1,)], "x int"), table, fmt)


def test_ddl_has_every_type(spark, database):
    text = (
        "a string, b double, c bigint, d int, e smallint, f tinyint, g boolean, h decimal(12,3), i date, j timestamp, "
        "k timestamp_ntz, l binary, m array<int>, n map<string,double>, o struct<p:int,q:array<string>>, r float, "
        "`s t` string"
    )
    rows = spark.createDataFrame([], text)
    create_table_like(rows, f"{database}.t")
    found = spark.table(f"{database}.t").schema
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in rows.schema]
    required = T.StructType([T.StructField("a", T.LongType(), False)])
    assert schema_ddl(required) == "a BIGINT"


def test_global_view_is_seen_by_other_sessions(spark):
    view = publish(spark.range(3), "shared_numbers")
    assert spark.newSession().sql(f"SELECT sum(id) AS s FROM {view}").first()["s"] == 3
    publish(spark.range(5), "shared_numbers")
    assert spark.table(view).count() == 5


def test_csv_is_text_and_empty_is_null(spark):
    path = scratch_path(spark, "csv")
    rows = spark.createDataFrame([(1, 'Smith, "Jo"', None), (2, None, 2.5)], "id int, name string, x double")
    export_csv(rows, path)
    found = read_csv(spark, path, escape='"')
    assert {f.dataType for f in found.schema} == {T.StringType()}
    assert values(found.select("id", F.coalesce("name", F.lit("-")), F.coalesce("x", F.lit("-")))) == [
        ("1", 'Smith, "Jo"', "-"),
        ("2", "-", "2.5"),
    ]
    assert read_csv(spark, path, infer=True, escape='"').schema["x"].dataType == T.DoubleType()
    with pytest.raises(AnalysisException):
        export_csv(rows, path)


def test_schema_must_fit_the_header(spark):
    path = scratch_path(spark, "csv")
    export_csv(spark.createDataFrame([(1, "a", 2.5)], "id int, name string, x double"), path)
    assert read_csv(spark, path, "id INT, name STRING, x DOUBLE").first() == (1, "a", 2.5)
    assert read_csv(spark, path, "id INT, name STRING, x DOUBLE").select("x").first() == (2.5,)
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, path, "name STRING, id STRING, x DOUBLE").collect()


def test_single_csv_file(spark):
    path = scratch_path(spark, "csv")
    rows = spark.range(100).repartition(8)
    export_csv(rows, path, single_file=True)
    assert read_csv(spark, path).select(F.input_file_name().alias("f")).distinct().count() == 1
    export_csv(rows, path, mode="overwrite")
    assert read_csv(spark, path).select(F.input_file_name().alias("f")).distinct().count() == 8


@pytest.mark.parametrize("name", FORMATS)
def test_batch_written_twice_counts_once(spark, database, name):
    table, fmt = f"{database}.t", TableFormat(name, streamed=True)
    rows = spark.range(10).select("id", F.lit("it's").alias("text"))
    create_table_like(rows, table, fmt)
    append(spark.createDataFrame([("old", 99)], "text string, id bigint"), table, fmt)
    for batch_id in (0, 1, 1, 0):
        write_batch(rows.filter(F.col("id") % 2 == batch_id), table, fmt, "s'1", batch_id)
    assert sorted(r["id"] for r in read_table(spark, table).collect()) == [*range(10), 99]
    # another stream has batches of its own, and a replay with fewer rows leaves nothing behind
    write_batch(rows, table, fmt, "s2", 0)
    write_batch(rows.limit(0), table, fmt, "s'1", 1)
    assert read_table(spark, table).count() == 1 + 5 + 10
    assert read_table(spark, table).columns == ["id", "text"]
    with pytest.raises(ValueError, match="has the columns"):
        write_batch(rows.drop("text"), table, fmt, "s2", 1)


def test_overwrite_of_a_streamed_table_replaces_batches(spark, database):
    table = f"{database}.t"
    create_table(spark, table, "id BIGINT", STREAMED)
    write_batch(spark.range(5), table, STREAMED, "s", 0)
    overwrite(spark.range(2), table, STREAMED)
    assert values(read_table(spark, table)) == [(0,), (1,)]
    write_batch(spark.range(5), table, STREAMED, "s", 1)
    assert read_table(spark, table).count() == 7


def test_table_options(spark, database):
    fmt = TableFormat(options={"compression": "gzip"})
    for table, make in ((f"{database}.a", overwrite), (f"{database}.b", append)):
        if make is append:
            create_table(spark, table, "id BIGINT", fmt)
        make(spark.range(3), table, fmt)
        (file,) = {r[0] for r in spark.table(table).select(F.input_file_name()).distinct().limit(1).collect()}
        assert file.endswith(".gz.parquet")


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"a": 1310, "b": "x"}', ("1310", "x")),
        ('{"a": 12.50, "b": null}', ("12.5", None)),
        ('{"a": 1e3, "b": "F G73"}', ("1000.0", "F G73")),
        ('{"b": "only"}', (None, "only")),
        ("no json", (None, None)),
        (None, (None, None)),
    ],
)
def test_decode(spark, text, expected):
    rows = spark.createDataFrame([(text,)], "value string")
    assert decode_json(rows, ["a", "b"]).first() == expected
    assert decode_json(rows.select(F.col("value").cast("binary")), ["a", "b"]).first() == expected


def test_decode_parses_once(spark):
    rows = spark.createDataFrame([("{}",)], "value string")
    assert plan(decode_json(rows, list("abcdefghijk"))).count("Generate json_tuple") == 1


def test_encode_has_every_field(spark):
    rows = spark.createDataFrame([(1, None, "ü,\"q\"")], "id bigint, x double, `a b` string")
    assert encode_json(rows).first()["value"] == '{"id":1,"x":null,"a b":"ü,\\"q\\""}'
    assert decode_json(encode_json(rows), rows.columns).first() == ("1", None, 'ü,"q"')
    assert encode_json(rows, ["id"], "body").first()["body"] == '{"id":1}'


def test_messages_to_files(spark):
    path = scratch_path(spark, "messages")
    write_messages(spark.range(3), "text", {}, path)
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == ['{"id":0}', '{"id":1}', '{"id":2}']


def test_kafka_options():
    assert kafka_options("host:1", "topic", maxOffsetsPerTrigger="100") == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "topic",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "100",
    }


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_spec_is_checked():
    with pytest.raises(ValueError, match="twice"):
        FeatureSpec(("a", "A"), ("b",))
    with pytest.raises(ValueError, match="key"):
        FeatureSpec((), ("b",))
    with pytest.raises(ValueError, match="categorical or numeric"):
        FeatureSpec(("a",))
