"""Raw records as VARIANT, and how landings depart from their shape."""

import json
import re

from marquee.operators.clean import clean_catalogue
from marquee.sources import drift, ingest
from marquee.sources.starview import RAW_KEYS
from tests.helpers import raw_record


def _lines(spark, *records):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "value string")


def _shapes(spark, *records, **kw):
    rows = drift.shapes(drift.as_variant(_lines(spark, *records)), **kw).collect()
    return {(r.path, r.type): r["rows"] for r in rows}


def brute(records, depth=4):
    kinds = {dict: "OBJECT", list: "ARRAY", str: "STRING", int: "BIGINT", bool: "BOOLEAN", float: "DECIMAL",
             type(None): "VOID"}
    out = {}

    def walk(path, value, level):
        key = (path, kinds[type(value)])
        out[key] = out.get(key, 0) + 1
        if level < depth and isinstance(value, (dict, list)):
            for k, v in value.items() if isinstance(value, dict) else enumerate(value):
                walk(f"{path}.{k}" if isinstance(value, dict) else f"{path}[*]", v, level + 1)

    for r in records:
        walk("$", r, 0)
    return out


def test_shapes_count_every_value_once(spark):
    records = [{"a": 1, "b": [{"c": "x", "d": [1, 2]}, {"c": None}, 5], "e": {}}, {"a": "1", "b": [], "e": None},
               {}, {"b": [[1], [2, 3]], "f": True, "g": 1.5}, [1, "x"], "text", {"e": {"f": {"g": {"h": {"i": 1}}}}}]
    for depth in (1, 2, 4):
        assert _shapes(spark, *map(json.dumps, records), depth=depth) == brute(records, depth)


def test_malformed_lines_and_empty_landings(spark):
    assert _shapes(spark, "{oops", '{"a": 1') == {("$", "MALFORMED"): 2}
    assert drift.shapes(drift.as_variant(_lines(spark, "{}").where("value IS NULL"))).count() == 0


def test_drift_names_unknown_keys_and_changed_types(spark):
    records = [raw_record(studio={"name": "S"}, title=7, tagline=None, genres=[{"name": "A", "id": 3}]), "{cut"]
    shaped = drift.shapes(drift.as_variant(_lines(spark, *records)))
    scalars = ("STRING", "BIGINT", "DECIMAL", "BOOLEAN")
    expected = {**drift.expected_types(RAW_KEYS, scalars), "$.title": ["STRING"]}
    found = {(r.path, r.type): r.status for r in drift.drift(shaped, expected, RAW_KEYS).collect()}
    assert found["$.studio", "OBJECT"] == found["$.studio.name", "STRING"] == "unknown key"
    assert found["$.title", "BIGINT"] == found["$", "MALFORMED"] == "type changed"
    assert found["$.tagline", "VOID"] == found["$.budget", "BIGINT"] == found["$.genres[*].name", "STRING"] == "ok"
    assert found["$.genres[*].id", "BIGINT"] == "unread"


def test_the_same_clean_catalogue_through_variant(spark):
    records = [raw_record(id=i, budget=b, title=f"T{i}", overview='say "x"|\n', tagline=None)
               for i, b in ((1, 25_000_000), (2, "25000000"), (3, 2.5), (4, None), (5, "abc"))]
    lines = _lines(spark, *records)
    direct = clean_catalogue(ingest.parse_records(lines, RAW_KEYS)).collect()
    through = clean_catalogue(drift.raw_from_variant(drift.as_variant(lines), RAW_KEYS)).collect()
    assert sorted(through) == sorted(direct) and len(direct) == 5


def test_shapes_are_one_scan(spark, tmp_dir):
    _lines(spark, raw_record()).write.text(f"{tmp_dir}/land")
    df = drift.shapes(drift.as_variant(spark.read.text(f"{tmp_dir}/land")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan text") == 1 and "partial_count" in plan and "CartesianProduct" not in plan


def test_a_level_carries_no_value_of_the_levels_above(spark):
    df = drift.shapes(drift.as_variant(_lines(spark, raw_record())))
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    kept = [x.split("), [", 1)[1].split("]")[0] for x in plan.splitlines() if "Generate variant_explode(" in x]
    assert len(kept) == 4
    for columns in kept:
        assert len([c for c in columns.split(", ") if re.match(r"_?v\d*#", c)]) <= 1
