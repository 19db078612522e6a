"""Records against their schema: none of the three sources departs from it, and planted departures are named."""

import pytest
from pyspark.sql import functions as F

from tilewright.functions import schemas
from tilewright.plans import queries

SF = "/root/testdata/sf0.001"
PLACE = {
    "type": "object",
    "required": ["name"],
    "properties": {
        "$type": {"type": "string", "const": "x.place"},
        "name": {"type": "string", "minLength": 1},
        "importance": {"type": "integer", "minimum": 0, "maximum": 100},
        "variants": {"type": "array", "maxLength": 2, "items": {"type": "ref", "ref": "#variant"}},
        "at": {"type": "string", "format": "datetime"},
        "locations": {"type": "array", "items": {"type": "union", "refs": ["x.geo", "x.other"], "closed": True}},
        "extra": {"type": "unknown"},
        "open": {"type": "boolean"},
        "cid": {"type": "string"},
    },
    "nullable": ["cid"],
}
VARIANT = {"type": "object", "required": ["name"], "properties": {"name": {"type": "string", "maxLength": 5}, "type": {"type": "string", "enum": ["a", "b"]}}}
DOCUMENTS = {
    "x.place": {"id": "x.place", "defs": {"variant": VARIANT, "main": {"type": "record", "record": PLACE}}},
    "x.geo": {"id": "x.geo", "defs": {"main": {"type": "object", "required": ["lat"], "properties": {"lat": {"type": "string"}}}}},
}
ROWS = [
    ("ok", '{"$type":"x.place","name":"n","importance":5,"variants":[{"name":"a","type":"a"}],"at":"2024-01-01T00:00:00Z","locations":[{"$type":"x.geo","lat":"1"},{"$type":"x.other"}],"extra":{"q":1},"open":true,"cid":null}'),
    ("bad", '{"$type":"y","importance":500,"variants":[{"name":"toolong","type":"c"},{},7],"at":"yesterday","locations":[{"$type":"x.geo"},{"$type":"z"},{}],"extra":[1],"name":null,"open":1}'),
    ("text", "no"), ("null", None), ("list", "[1]"), ("num", '{"name":5,"importance":1.5,"variants":{}}'), ("low", '{"name":"","importance":-1}'),
]
WANT = [
    ("bad", "$.$type", "not the value"), ("bad", "$.at", "no datetime"), ("bad", "$.extra", "unknown expected"), ("bad", "$.importance", "too large"), ("bad", "$.locations[]", "no $type"),
    ("bad", "$.locations[]", "unknown $type"), ("bad", "$.locations[].lat", "required"), ("bad", "$.name", "null"), ("bad", "$.open", "boolean expected"), ("bad", "$.variants", "too many"),
    ("bad", "$.variants[]", "object expected"), ("bad", "$.variants[].name", "required"), ("bad", "$.variants[].name", "too long"), ("bad", "$.variants[].type", "not one of the values"),
    ("list", "$", "object expected"), ("low", "$.importance", "too small"), ("low", "$.name", "too short"), ("null", "$", "no JSON"),
    ("num", "$.importance", "integer expected"), ("num", "$.name", "string expected"), ("num", "$.variants", "array expected"), ("text", "$", "no JSON"),
]


def test_every_rule_is_named(spark):
    found = schemas.violations(spark.createDataFrame(ROWS, "rkey string, record_json string"), DOCUMENTS, "x.place")
    assert sorted(map(tuple, found.collect())) == WANT
    assert schemas.violations(spark.createDataFrame([], "rkey string, record_json string"), DOCUMENTS, "x.place").count() == 0
    itself = {"a": {"id": "a", "defs": {"main": {"type": "object", "properties": {"a": {"type": "ref", "ref": "a"}}}}}}
    with pytest.raises(ValueError):
        schemas.violations(spark.createDataFrame(ROWS, "rkey string, record_json string"), itself, "a")


def test_records_of_the_three_sources_keep_the_schema(spark):
    text = {"type": "string", "minLength": 1}
    listed = lambda name: {"type": "array", "items": {"type": "ref", "ref": name}}
    geo = {"type": "object", "required": ["latitude", "longitude"], "properties": {"latitude": text, "longitude": text}}
    box = {"type": "object", "required": ["north", "south", "east", "west"], "properties": dict.fromkeys(("north", "south", "east", "west"), text)}
    properties = {
        "$type": {"type": "string", "const": "org.atgeo.place"}, "rkey": {"type": "string", "format": "record-key"}, "name": text, "importance": {"type": "integer", "minimum": 0, "maximum": 100},
        "locations": {"type": "array", "minLength": 1, "items": {"type": "union", "refs": ["community.lexicon.location.geo", "community.lexicon.location.bbox", "community.lexicon.location.address"], "closed": True}},
        "variants": listed("#variant"), "attributes": {"type": "unknown"}, "relations": {"type": "object", "properties": {"within": listed("#relation")}},
    }
    documents = {
        "org.atgeo.place": {"defs": {"main": {"type": "record", "record": {"type": "object", "required": ["name"], "properties": properties}}, "variant": {"type": "object", "required": ["name"], "properties": {"name": text, "type": text, "language": {"type": "string", "format": "language"}}}, "relation": {"type": "object", "required": ["rkey"], "properties": {"rkey": text, "name": text, "level": {"type": "integer"}}}}},
        "community.lexicon.location.geo": {"defs": {"main": geo}},
        "community.lexicon.location.bbox": {"defs": {"main": box}},
    }
    for records in (queries.place_records, queries.osm_records, queries.division_records):
        frame = records(spark, SF)
        text_column = next(c for c, kind in frame.dtypes if kind == "string" and "json" in c)
        rows = frame.select(F.get_json_object(text_column, "$.rkey").alias("rkey"), F.col(text_column).alias("record_json"))
        assert rows.count() > 0 and [tuple(r) for r in schemas.violations(rows, documents, "org.atgeo.place").limit(5).collect()] == []
