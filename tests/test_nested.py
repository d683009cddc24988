"""C1-C5, C10, I19, A5"""

import pytest
from pyspark.sql import functions as F

from touchline.operators import nested


def make(spark, json_rows, ddl):
    text = spark.createDataFrame([(r,) for r in json_rows], "j STRING")
    return nested.parse_envelope(text, nested_schema(ddl), "j")


def nested_schema(ddl):
    from touchline.schemas import layout

    return layout(ddl)


def test_null_empty_and_filled_arrays_keep_their_row(spark, rows):
    df = make(
        spark,
        ['{"id":1}', '{"id":2,"a":[]}', '{"id":3,"a":[{"x":1},{"x":2}]}'],
        "id INT, a ARRAY<STRUCT<x: INT>>",
    )
    flat = nested.flatten(df)
    assert flat.columns == ["id", "a_x"]
    assert rows(flat) == [(1, None), (2, None), (3, 1), (3, 2)]


def test_null_struct_gives_null_fields_in_place(spark, rows):
    df = make(spark, ['{"z":5}'], "s STRUCT<p: INT, q: STRUCT<r: INT>>, z INT")
    flat = nested.flatten(df)
    assert flat.columns == ["s_p", "s_q_r", "z"]
    assert rows(flat) == [(None, None, 5)]


def test_two_arrays_multiply_and_go_last(spark, rows):
    df = make(
        spark,
        ['{"a":[{"x":1},{"x":2}],"k":7,"b":[{"y":3},{"y":4}]}'],
        "a ARRAY<STRUCT<x: INT>>, k INT, b ARRAY<STRUCT<y: INT>>",
    )
    flat = nested.flatten(df)
    assert flat.columns == ["k", "a_x", "b_y"]
    assert rows(flat) == [(7, 1, 3), (7, 1, 4), (7, 2, 3), (7, 2, 4)]


def test_array_inside_array_element(spark, rows):
    df = make(
        spark,
        ['{"id":1,"s":[{"t":{"id":9},"v":[{"k":"a"},{"k":"b"}]},{"t":{"id":8}}]}'],
        "id INT, s ARRAY<STRUCT<v: ARRAY<STRUCT<k: STRING>>, t: STRUCT<id: INT>>>",
    )
    flat = nested.flatten(df)
    assert flat.columns == ["id", "s_t_id", "s_v_k"]
    assert rows(flat) == [(1, 8, None), (1, 9, "a"), (1, 9, "b")]


def test_plain_arrays_and_flat_frames_are_untouched(spark):
    df = spark.createDataFrame([(1, [1, 2])], "id INT, a ARRAY<INT>")
    assert nested.flatten(df).schema == df.schema
    assert nested.flatten(df) is df


def test_any_depth_is_opened(spark):
    kind = "v INT"
    text = '{"v":1}'
    for _ in range(15):
        kind, text = f"x STRUCT<{kind.replace(' ', ': ', 1)}>", f'{{"x":{text}}}'
    df = nested.flatten(make(spark, [text], kind))
    assert df.columns == ["_".join(["x"] * 15 + ["v"])]
    assert df.first()[0] == 1


def test_name_collision_is_refused(spark):
    df = make(spark, ["{}"], "a STRUCT<b: INT>, a_b INT")
    with pytest.raises(ValueError, match="a_b"):
        nested.flatten(df)


def test_map_default_literals_and_complete_rows(spark, rows):
    df = spark.createDataFrame([("1", None), ("2", 5)], "a STRING, b INT")
    mapped = nested.map_columns(df, [("a", "x", "bigint"), ("b", "b", None)])
    assert mapped.dtypes == [("x", "bigint"), ("b", "int")]
    defaulted = mapped.select("x", nested.column_or(mapped, "b", 0, "int"),
                              nested.column_or(mapped, "missing", 0, "int"))
    assert rows(defaulted) == [(1, None, 0), (2, 5, 0)]
    literal = nested.with_literals(df, done=(False, "boolean"), at=(None, "timestamp"))
    assert literal.dtypes[-2:] == [("done", "boolean"), ("at", "timestamp")]
    assert rows(nested.complete_rows(df, "a", "b")) == [("2", 5)]


def test_flatten_works_on_a_stream(spark, tmp_path):
    spark.createDataFrame([(1,)], "id INT").select(
        F.struct("id").alias("s"), F.array(F.struct(F.col("id").alias("x"))).alias("a")
    ).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("s STRUCT<id: INT>, a ARRAY<STRUCT<x: INT>>").json(
        str(tmp_path / "in")
    )
    flat = nested.flatten(stream)
    assert flat.isStreaming and flat.columns == ["s_id", "a_x"]
