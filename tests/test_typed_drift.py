"""Types and paths of telemetry that templates do not take."""

from __future__ import annotations

import json

from tidegate.operators import reports
from tidegate.sources.templates import compile_templates, template

TEMPLATES = [template("pump", {"speed": "double", "on": "boolean", "count": "integer"}), template("fan", {})]


def bronze(spark, *messages):
    rows = [(name, m if isinstance(m, str) or m is None else json.dumps({"telemetry": m})) for name, m in messages]
    return spark.createDataFrame(rows, "templateName string, body string")


def found(df):
    return {(r.templateName, r.path, r.type): r.messages for r in df.collect()}


def test_types_and_paths(spark):
    rows = bronze(
        spark,
        ("pump", {"speed": 1, "on": True, "count": 3}),  # all fit
        ("pump", {"speed": 1.5, "on": None, "count": None}),
        ("pump", {"speed": "fast", "on": 1, "count": 2.5}),
        ("pump", {"where": {"lat": 1.5, "tags": ["a", 2, {"deep": {"er": 1}}]}, "big": 12345678901234567890123}),
        ("pump", {"big": 1e300, "Speed": 4}),
        ("fan", {"rpm": 7}),
        ("other", {"rpm": 7}),
        ("pump", None), ("pump", "no json"), ("pump", {}), ("pump", '{"telemetry":[1]}'), ("pump", '{"telemetry":{"x":1,"x":2}}'),
    )
    assert found(reports.typed_drift(rows, TEMPLATES)) == {
        ("pump", "speed", "string"): 1, ("pump", "on", "integer"): 1, ("pump", "count", "double"): 1,
        ("pump", "where", "object"): 1, ("pump", "where.lat", "double"): 1, ("pump", "where.tags", "array"): 1,
        ("pump", "where.tags.[]", "string"): 1, ("pump", "where.tags.[]", "integer"): 1, ("pump", "where.tags.[]", "object"): 1,
        ("pump", "big", "integer"): 1, ("pump", "big", "double"): 1, ("pump", "Speed", "integer"): 1, ("fan", "rpm", "integer"): 1,
    }
    assert ("pump", "where.lat", "double") not in found(reports.typed_drift(rows, TEMPLATES, depth=1))


def test_nothing_to_report(spark):
    rows = bronze(spark, ("pump", {"speed": 1}))
    assert reports.typed_drift(rows, TEMPLATES).count() == 0
    assert reports.typed_drift(rows, []).count() == 0
    assert reports.typed_drift(rows.limit(0), TEMPLATES).count() == 0


def test_proposal_compiles(spark, folder):
    rows = bronze(
        spark,
        *[("pump", {"level": 1, "ok": False, "mixed": 1, "note": "x", "where": {"lat": 1}, "SPEED": 1}) for _ in range(3)],
        ("pump", {"level": 1.5, "mixed": True, "rare": 1}),
    )
    proposed = reports.propose(reports.typed_drift(rows, TEMPLATES), TEMPLATES, least=2)
    files = {}
    for asset, content in proposed.items():
        files[asset] = f"{asset}.json"
        with open(f"{folder}/{asset}.json", "w") as f:
            json.dump(content, f)
    compiled, errors = compile_templates(spark, files, folder)
    assert errors == {}
    names = {name: kind.simpleString() for name, _, kind in compiled["pump"].columns}
    assert names == {"speed": "double", "on": "boolean", "count": "int", "level": "double", "ok": "boolean"}
    assert compiled["fan"].columns == ()
