import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablewright.functions import parse_double
from tablewright.operators import (
    apply_mapping,
    choice_types,
    daily_engagement_kpis,
    enrich,
    latest_per_key,
    open_records,
    preview,
    relationalize,
    resolve_choice,
    schema_report,
    split_rejects,
    stringify,
    summarize,
    unmatched,
    with_counters,
)
from tablewright.operators.joins import heavy_keys
from tests import fixtures

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def records(spark, objects):
    text = [(json.dumps(o) if not isinstance(o, str) else o,) for o in objects]
    return spark.createDataFrame(text, "t string").select(F.try_parse_json("t").alias("record"))


# mapping

def test_apply_mapping_renames_casts_and_drops(spark):
    df = spark.createDataFrame([("K1", "1.5", "x"), ("K2", "", "y"), ("K3", "n/a", "z")], "`cust id` string, `a.b` string, rest string")
    out = apply_mapping(df, [("cust id", "string", "id", "string"), ("a.b", "string", "total", "double")])
    assert out.dtypes == [("id", "string"), ("total", "double")]
    assert tuples(out) == [("K1", 1.5), ("K2", None), ("K3", None)]


def test_apply_mapping_reaches_into_structs_and_choices(spark):
    df = open_records(records(spark, [{"a": {"b": 1}, "c": 5}, {"a": {"b": 2}, "c": "x"}]))
    out = apply_mapping(df, [("a.b", "bigint", "b", "string"), ("c", "variant", "c", "long")])
    assert tuples(out) == [("1", 5), ("2", None)]


def test_apply_mapping_errors(spark):
    df = spark.createDataFrame([("a",)], "x string")
    for mapping in ([], [("y", "string", "y", "string")], [("x", "int", "x", "int")], [("x", "string", "a", "string")] * 2):
        with pytest.raises(ValueError):
            apply_mapping(df, mapping)


@SLOW
@given(texts=st.lists(st.one_of(st.none(), st.text(max_size=6), st.floats(allow_nan=False).map(str)), min_size=1, max_size=20))
def test_apply_mapping_keeps_every_row(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert apply_mapping(df, [("x", "string", "y", "double")]).count() == len(texts)


def test_stringify_and_schema_report(spark):
    df = spark.sql("SELECT 1.5D AS d, named_struct('k', 1) AS s, parse_json('2') AS v, 'x' AS t")
    assert tuples(stringify(df)) == [("1.5", '{"k":1}', "2", "x")]
    assert stringify(df, ["d"]).dtypes[1][1] == "struct<k:int>"
    report = schema_report(df).orderBy("position").collect()
    assert [(r.column_name, r.type, r.is_choice) for r in report][2] == ("v", "variant", True)


def test_preview_is_the_top_of_the_order(spark):
    assert [r.id for r in preview(spark.range(100), 3, [F.desc("id")]).collect()] == [99, 98, 97]
    assert preview(spark.range(100)).count() == 20


# choices

@pytest.fixture
def points(spark):
    return open_records(records(spark, fixtures.customers())).select("customer_id", "loyalty_points")


def by_id(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_only_mixed_fields_stay_choices(spark):
    df = open_records(records(spark, fixtures.customers()))
    assert dict(df.dtypes) == {
        "customer_id": "string",
        "name": "string",
        "address": "struct<city:string,zip:string>",
        "contacts": "array<struct<type:string,value:string>>",
        "loyalty_points": "variant",
    }
    assert choice_types(df) == {"loyalty_points": ["long", "double", "string"]}
    assert df.filter("address.zip = '00977'").count() == 1


def test_cast_long_converts_text_and_project_long_does_not(points):
    cast = by_id(resolve_choice(points, specs=[("loyalty_points", "cast:long")]))
    project = by_id(resolve_choice(points, specs=[("loyalty_points", "project:long")]))
    assert (cast["K001"], cast["K002"], cast["K007"], cast["K008"], cast["K009"]) == ((1200,), (None,), (17,), (12,), (None,))
    assert (project["K001"], project["K002"], project["K007"], project["K008"], project["K009"]) == ((1200,), (None,), (None,), (None,), (None,))


def test_cast_string_is_lossless(points):
    out = by_id(resolve_choice(points, specs=[("loyalty_points", "cast:string")]))
    expected = {c["customer_id"]: c["loyalty_points"] for c in fixtures.customers()}
    assert out == {k: (None if v is None else str(v),) for k, v in expected.items()}


def test_make_cols_and_make_struct(points):
    cols = resolve_choice(points, specs=[("loyalty_points", "make_cols")])
    assert cols.columns == ["customer_id", "loyalty_points_long", "loyalty_points_double", "loyalty_points_string"]
    assert by_id(cols)["K005"] == (None, None, "platinum")
    assert by_id(cols)["K001"] == (1200, None, None)
    struct = resolve_choice(points, choice="make_struct")
    assert dict(struct.dtypes)["loyalty_points"] == "struct<long:bigint,double:double,string:string>"
    assert by_id(struct.select("customer_id", "loyalty_points.*")) == by_id(cols)
    assert struct.filter("loyalty_points is null").count() == 1


def test_given_types_need_no_pass_over_the_data(spark, points):
    out = resolve_choice(points, specs=[("loyalty_points", "make_cols")], types={"loyalty_points": ["long", "string"]})
    assert out.columns == ["customer_id", "loyalty_points_long", "loyalty_points_string"]


@SLOW
@given(values=st.lists(st.one_of(st.integers(-(2**53), 2**53), st.text(max_size=5), st.booleans(), st.none()), min_size=1, max_size=15))
def test_coalesced_make_cols_is_cast_string(spark, values):
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, t string")
    df = df.select("i", F.parse_json("t").alias("v"))
    cols = resolve_choice(df, specs=[("v", "make_cols")])
    merged = cols.select("i", F.coalesce(*(F.col(c).cast("string") for c in cols.columns[1:])).alias("v"))
    assert tuples(merged) == tuples(resolve_choice(df, specs=[("v", "cast:string")]))


def test_choices_inside_structs_and_arrays(spark):
    rows = [
        {"id": 1, "a": {"zip": "01", "n": 1}, "xs": [{"v": 1}, {"v": "s"}], "ys": [1, "t", None]},
        {"id": 2, "a": {"zip": 5, "n": 2}, "xs": [], "ys": None},
        {"id": 3, "a": None, "xs": [{"v": True}], "ys": []},
    ]
    df = open_records(records(spark, rows))
    assert choice_types(df) == {
        "a.zip": ["long", "string"], "xs[].v": ["long", "string", "boolean"], "ys[]": ["long", "string"],
    }
    out = resolve_choice(df, choice="make_struct").orderBy("id")
    assert out.select("id", "a.zip.string", "a.zip.long", "a.n").collect() == [(1, "01", None, 1), (2, None, 5, 2), (3, None, None, None)]
    assert [r[0] for r in out.select(F.to_json("xs")).collect()] == ['[{"v":{"long":1}},{"v":{"string":"s"}}]', "[]", '[{"v":{"boolean":true}}]']
    assert [r[0] for r in out.select(F.to_json("ys")).collect()] == ['[{"long":1},{"string":"t"},null]', None, "[]"]
    one = resolve_choice(df, specs=[("a.zip", "cast:string"), ("xs[].v", "make_cols"), ("ys[]", "project:long")])
    assert [f.name for f in one.schema["xs"].dataType.elementType] == ["v_long", "v_string", "v_boolean"]
    assert [r[0] for r in one.orderBy("id").select("a.zip").collect()] == ["01", "5", None]
    assert [r[0] for r in one.orderBy("id").select("ys").collect()] == [[1, None, None], None, []]


@SLOW
@given(
    values=st.lists(
        st.one_of(
            st.integers(-(2**63), 2**63 - 1), st.integers(-9, 9).map(str), st.sampled_from([0.5, -0.5, 12.75, -3.25]),
            st.sampled_from(["", " 7 ", "x1", "1.5", "1e3"]), st.booleans(), st.none(),
        ),
        min_size=1, max_size=15,
    )
)
def test_cast_to_numbers(spark, values):
    def as_long(v):
        if isinstance(v, str):
            return int(v) if v.strip().lstrip("-").isdigit() else None
        return None if v is None else int(v)

    def as_double(v):
        return None if v is None or v in ("", "x1") else float(v)

    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, t string")
    df = df.select("i", F.parse_json("t").alias("v"))
    for target, expected in (("long", as_long), ("double", as_double)):
        out = resolve_choice(df, specs=[("v", f"cast:{target}")])
        assert [r.v for r in out.orderBy("i").collect()] == [expected(v) for v in values]


def test_extraction_from_a_stored_variant(spark, tmp_path):
    """Spark moves variant_get into a Parquet scan; the branches must hold there as well."""
    df = spark.createDataFrame([('{"v":1}',), ('{"v":"gold"}',), ('{"v":2.5}',)], "t string")
    df.select(F.parse_json("t").alias("r")).write.parquet(f"{tmp_path}/v")
    stored = spark.read.parquet(f"{tmp_path}/v").select(F.variant_get("r", "$.v", "variant").alias("v"))
    out = resolve_choice(stored, specs=[("v", "make_cols")])
    assert tuples(out) == [(1, None, None), (None, 2.5, None), (None, None, "gold")]
    assert tuples(resolve_choice(stored, specs=[("v", "project:long")])) == [(1,), (None,), (None,)]


def test_choice_errors(points):
    for call in (
        {"specs": [("nope", "cast:long")]},
        {"specs": [("loyalty_points", "cast")]},
        {"specs": [("loyalty_points", "project:map")]},
        {"specs": [("loyalty_points", "melt")]},
        {"specs": [("loyalty_points", "make_cols")] * 2},
        {"specs": [], "choice": "make_cols"},
        {},
    ):
        with pytest.raises(ValueError):
            resolve_choice(points, **call)


def test_odd_field_names_and_never_filled_fields(spark):
    df = open_records(records(spark, [{"odd name": 1, "it's": 2, "n": None, "VOID": 1.5}, {"a.b": 3}]))
    assert dict(df.dtypes) == {"odd name": "bigint", "it's": "bigint", "n": "string", "VOID": "double", "a.b": "bigint"}
    assert tuples(df.select("`odd name`", "`it's`", "VOID", "`a.b`")) == [(1, 2, 1.5, None), (None, None, None, 3)]


# relationalize

NESTED = [
    {"id": 1, "a": {"x": 1, "y": {"z": "p"}}, "items": [{"k": "i", "tags": ["s", "t"]}, {"k": "j", "tags": []}], "nums": [7, 8]},
    {"id": 2, "a": {"x": 2, "y": {"z": "q"}}, "items": [], "nums": [9]},
    {"id": 3, "a": None, "items": None, "nums": None},
]
NESTED_DDL = "id bigint, a struct<x:bigint,y:struct<z:string>>, items array<struct<k:string,tags:array<string>>>, nums array<bigint>"


def nested(spark):
    text = spark.createDataFrame([(json.dumps(n),) for n in NESTED], "t string")
    return text.select(F.from_json("t", NESTED_DDL).alias("r")).select("r.*")


def test_relationalize_with_key(spark):
    frames = relationalize(nested(spark), "r", "id")
    assert list(frames) == ["r", "r_items", "r_items_tags", "r_nums"]
    assert frames["r"].columns == ["id", "a_x", "a_y_z", "items_size", "nums_size"]
    assert tuples(frames["r"]) == [(1, 1, "p", 2, 2), (2, 2, "q", 0, 1), (3, None, None, None, None)]
    assert frames["r_items"].columns == ["id", "index", "k", "tags_size"]
    assert tuples(frames["r_items"]) == [(1, 0, "i", 2), (1, 1, "j", 0)]
    assert frames["r_items_tags"].columns == ["id", "items_index", "index", "value"]
    assert tuples(frames["r_items_tags"]) == [(1, 0, 0, "s"), (1, 0, 1, "t")]
    assert tuples(frames["r_nums"]) == [(1, 0, 7), (1, 1, 8), (2, 0, 9)]


def test_relationalize_with_generated_link_agrees_between_tables(spark, tmp_path):
    frames = relationalize(nested(spark), "r", staging_path=str(tmp_path))
    joined = frames["r"].join(frames["r_nums"], "r_id")
    assert tuples(joined.select("id", "value")) == [(1, 7), (1, 8), (2, 9)]


@SLOW
@given(arrays=st.lists(st.one_of(st.none(), st.lists(st.integers(0, 9), max_size=5)), min_size=1, max_size=10))
def test_relationalize_round_trip(spark, arrays):
    df = spark.createDataFrame(list(enumerate(arrays)), "id int, xs array<int>")
    frames = relationalize(df, "r", "id")
    rebuilt = {i: [] if size == 0 else None for i, size in tuples(frames["r"])}
    for i, _, value in sorted(tuples(frames["r_xs"])):
        rebuilt[i] = [*(rebuilt[i] or []), value]
    assert rebuilt == dict(enumerate(arrays))


def test_relationalize_maps_and_arrays_in_arrays(spark):
    df = spark.sql("SELECT 1 AS id, map('a', 1, 'b', 2) AS m, array(array(1), array(2, 3)) AS aa")
    frames = relationalize(df, "r", "id")
    assert tuples(frames["r_m"]) == [(1, "a", 1), (1, "b", 2)]
    assert tuples(frames["r_aa"]) == [(1, 0, 1), (1, 1, 2)]
    assert frames["r_aa"].columns == ["id", "index", "items_size"]
    assert tuples(frames["r_aa_items"]) == [(1, 0, 0, 1), (1, 1, 0, 2), (1, 1, 1, 3)]


def test_relationalize_errors(spark):
    with pytest.raises(ValueError, match="twice"):
        relationalize(spark.sql("SELECT 1 AS id, 2 AS a_b, named_struct('b', 3) AS a"), "r", "id")
    with pytest.raises(ValueError, match="no key"):
        relationalize(spark.range(1), "r", "nope")
    with pytest.raises(TypeError):
        relationalize(spark.sql("SELECT 1 AS id, parse_json('1') AS v"), "r", "id")


# latest row, joins, summaries

def test_latest_per_key_is_total_and_limits_before_the_shuffle(spark):
    rows = [(k, d, v) for k in ("a", "b", None) for d in (1, 2, None) for v in range(4)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, d int, v int").repartition(5)
    out = latest_per_key(df, "k", "d")
    assert tuples(out) == [("a", 2, 3), ("b", 2, 3), (None, 2, 3)]
    assert out.count() == df.select("k").distinct().count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert tuples(latest_per_key(df, "k", [F.col("d").asc_nulls_last(), F.col("v").asc()])) == [("a", 1, 0), ("b", 1, 0), (None, 1, 0)]


def test_enrich_and_unmatched(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("x", 3)], "k string, v int")
    dim = spark.sql("SELECT k, named_struct('city', city) AS address, 9 AS other FROM VALUES ('a', 'A'), ('b', 'B'), ('c', 'C') AS t(k, city)")
    assert tuples(enrich(df, dim, "k", [("address.city", "city")])) == [("a", 1, "A"), ("b", 2, "B"), ("x", 3, None)]
    assert enrich(df, dim, "k", ["other"], how="full").count() == 4
    assert tuples(unmatched(dim, df, "k").select("k")) == [("c",)]
    with pytest.raises(ValueError):
        enrich(df, dim, "k", [("address.city", "v")])


def test_enrich_splits_a_hot_key(spark):
    """A key with a third of the rows is joined by several tasks, and no row is lost."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 90000, 1, 8).selectExpr("if(id % 3 = 0, 7, id) AS k", "sha2(cast(id as string), 256) AS s")
        names = spark.range(0, 90000, 1, 8).selectExpr("id AS k", "concat('name ', id) AS name")
        out = enrich(rows, names, "k", ["name"])
        execution = out._jdf.queryExecution()
        assert execution.toRdd().count() == 90000
        assert "SortMergeJoin(skew=true)" in execution.executedPlan().toString()
        assert out.filter("name = 'name 7'").count() == 30001 - (7 % 3 == 0)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_latest_per_key_with_a_hot_key(spark):
    rows = spark.range(0, 90000, 1, 8).selectExpr("if(id % 3 = 0, 7, id % 100) AS k", "id AS seq", "id % 11 AS x")
    expected = {}
    for i in range(90000):
        expected[7 if i % 3 == 0 else i % 100] = (i, i % 11)
    assert {r.k: (r.seq, r.x) for r in latest_per_key(rows, "k", "seq").collect()} == expected


def test_summarize(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0)], "s string, x double")
    out = summarize(df, "s", {"n": F.count("*"), "total": F.round(F.sum("x"), 2)}, [F.desc("n"), "s"])
    assert [tuple(r) for r in out.collect()] == [("a", 2, 1.0), ("b", 1, 2.0)]
    assert tuples(summarize(df, "s")) == [("a", 2), ("b", 1)]


def test_daily_engagement_kpis(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (timestamp_ntz'2026-01-01 10:00:00', 1, 'view', 0.0D), (timestamp_ntz'2026-01-01 11:00:00', 1, 'view', 0.0D),
        (timestamp_ntz'2026-01-01 12:00:00', 2, 'purchase', 0.1D), (timestamp_ntz'2026-01-01 13:00:00', 2, 'click', 5.0D),
        (timestamp_ntz'2026-01-02 10:00:00', 3, 'purchase', 0.2D) AS t(ts, user_id, event_type, value)"""
    )
    rows = [tuple(r)[1:] for r in daily_engagement_kpis(df).orderBy("event_date").collect()]
    assert rows == [(2, 2, 1, 1, 0.1, 0.5), (1, 0, 0, 1, 0.2, None)]
    assert "add_to_carts" in daily_engagement_kpis(df, interest=("add_to_cart", "add_to_carts")).columns


# quality

def test_split_rejects_and_counters(spark):
    df = spark.createDataFrame([("a", "1.5", "2"), ("b", "n/a", "x"), ("c", "", None), ("d", "3", "y")], "k string, p string, q string")
    rules = {"p": parse_double, "q": parse_double}
    good, rejects = split_rejects(df, rules)
    assert tuples(good) == [("a", 1.5, 2.0), ("c", None, None)]
    assert tuples(rejects.select("k", "p", "reject_column", "reject_value")) == [
        ("b", "n/a", "p", "n/a"), ("b", "n/a", "q", "x"), ("d", "3", "q", "y"),
    ]
    counted, seen = with_counters(df, "run", rules)
    assert counted.count() == 4
    assert seen.get == {"rows": 4, "parsed_p": 2, "failed_p": 1, "parsed_q": 1, "failed_q": 2}


def test_lenient_mapping_survives_what_breaks_a_plain_cast(spark):
    df = spark.createDataFrame([("n/a",)], "x string")
    with pytest.raises(PySparkException):
        df.select(F.col("x").cast("double")).collect()
    assert apply_mapping(df, [("x", "string", "x", "double")]).first()[0] is None


def test_digits_in_arrays_and_maps_stay(spark):
    df = open_records(records(spark, [{"xs": [123456789012345678, 0.5], "o": [{"n": 1}, {"n": 1.5}], "w": [1, 2]}]))
    assert dict(df.dtypes) == {"o": "array<struct<n:variant>>", "w": "array<bigint>", "xs": "array<variant>"}
    out = resolve_choice(df, choice="make_struct").first()
    assert [(x.long, x.double) for x in out.xs] == [(123456789012345678, None), (None, 0.5)]
    assert [(x.n.long, x.n.double) for x in out.o] == [(1, None), (None, 1.5)]


@pytest.mark.parametrize("hot", ["left", "right", "both", "neither"])
def test_full_join_by_heavy_keys(spark, hot):
    draw = random.Random(hot)
    many = [(1, f"l{i % 3}") for i in range(700)] + [(2, "x")] * 90
    few = [(i, f"r{i}") for i in (1, 1, 2, 2, 5, 6)]
    left = [(draw.choice([None, *range(3, 40)]), f"a{i}") for i in range(60)] + (many if hot in ("left", "both") else few)
    right = [(draw.choice([None, *range(20, 60)]), f"b{i}") for i in range(60)] + (many[:300] if hot in ("right", "both") else few)
    a, b = spark.createDataFrame(left, "key int, l string").repartition(5), spark.createDataFrame(right, "key bigint, r string")
    got = enrich(a, b, "key", ["r"], how="full")
    want = a.join(b.select(F.col("key").cast("bigint").alias("key"), "r"), "key", "full")
    assert got.columns == ["key", "l", "r"] and tuples(got) == tuples(want)


def test_full_join_over_two_keys_cuts_a_hot_one(spark):
    lines = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, 1, id % 997) AS a", "if(id % 3 = 0, 'x', cast(id % 7 as string)) AS b", "id")
    dim = spark.range(1000).selectExpr("id AS a", "'x' AS b", "id * 2 AS v")
    assert list(heavy_keys(lines, ["a", "b"]).values()) == [-(-20_000 * 256 // 60_000)]
    got = enrich(lines, dim, ["a", "b"], ["v"], how="full")
    assert tuples(got) == tuples(lines.join(dim, ["a", "b"], "full"))
    settings_ = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings_.items():
        spark.conf.set(name, value)
    try:
        parts = got.where("a = 1 AND b = 'x'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name in settings_:
            spark.conf.unset(name)
    # As even as eight partitions can be.
    assert len(parts) == 8 and max(r["count"] for r in parts) < 20_000 / 4
