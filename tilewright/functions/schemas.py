"""Record schemas compiled into column expressions: what a table of JSON records does against its schema.

A schema document has an id and definitions (defs), of which main is the record. Types: record, object, array, string,
integer, boolean, unknown (any object), ref and union; a ref names a definition of the document (#name) or another
document's main, and a union is told apart by $type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What the text of a format looks like.
FORMATS = {
    "datetime": r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)$",
    "uri": r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s]+$",
    "record-key": r"^[A-Za-z0-9_~.:-]{1,512}$",
    "nsid": r"^[a-z][a-z0-9-]*(\.[a-z0-9-]+)+(\.[A-Za-z][A-Za-z0-9]*)$",
    "language": r"^[A-Za-z]{2,3}(-[A-Za-z0-9]+)*$",
}
#: Names of types as schema_of_variant() gives them.
KINDS = {"object": "^OBJECT", "array": "^ARRAY", "string": "^STRING", "integer": "^BIGINT", "boolean": "^BOOLEAN", "unknown": "^OBJECT"}
#: Definitions within each other at most.
DEPTH = 16


def member(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f'$["{name}"]', "variant")


class Schema:
    """schemas: documents by id."""

    def __init__(self, schemas: dict[str, dict]):
        self.schemas = schemas

    def definition(self, ref: str, home: str) -> tuple[dict, str]:
        """What a ref in a document names, and the document that has it; KeyError where there is no such."""
        document, _, name = ref.partition("#")
        document = document or home
        return self.schemas[document]["defs"][name or "main"], document

    def check(self, value: Column, rule: dict, path: str, home: str, depth: int = 0) -> Column:
        """The violations of a variant that is there, as an array of struct<path, rule>."""
        if depth > DEPTH:
            raise ValueError(f"{path}: definitions that name themselves aren't compiled")
        kind = rule["type"]
        if kind == "ref":
            found, document = self.definition(rule["ref"], home)
            return self.check(value, found, path, document, depth + 1)
        if kind == "record":
            return self.check(value, rule["record"], path, home, depth + 1)
        if kind == "union":
            return self.union(value, rule, path, home, depth)
        right = F.rlike(F.schema_of_variant(value), F.lit(KINDS[kind]))
        inner = {"object": self.object, "array": self.array, "string": self.string, "integer": self.integer}.get(kind)
        more = inner(value, rule, path, home, depth) if inner else none()
        return F.when(right, more).otherwise(found_at(path, F.lit(f"{kind} expected")))

    def object(self, value: Column, rule: dict, path: str, home: str, depth: int) -> Column:
        out = []
        for name in dict.fromkeys([*rule.get("properties", {}), *rule.get("required", [])]):
            at, own = member(value, name), f"{path}.{name}"
            null = F.coalesce(F.is_variant_null(at), F.lit(False))
            present = self.check(at, rule["properties"][name], own, home, depth + 1) if name in rule.get("properties", {}) else none()
            missing = found_at(own, F.lit("required")) if name in rule.get("required", []) else none()
            empty = none() if name in rule.get("nullable", []) else found_at(own, F.lit("null"))
            out.append(F.when(at.isNull(), missing).when(null, empty).otherwise(present))
        return F.flatten(F.array(*out)) if out else none()

    def array(self, value: Column, rule: dict, path: str, home: str, depth: int) -> Column:
        items = value.cast("array<variant>")
        out = [when(F.size(items) > rule["maxLength"], path, "too many")] if "maxLength" in rule else []
        out += [when(F.size(items) < rule["minLength"], path, "too few")] if "minLength" in rule else []
        out.append(F.flatten(F.transform(items, lambda item: self.check(item, rule["items"], f"{path}[]", home, depth + 1))))
        return F.flatten(F.array(*out))

    def string(self, value: Column, rule: dict, path: str, home: str, depth: int) -> Column:
        text = F.try_variant_get(value, "$", "string")
        out = [when(F.octet_length(text) > rule["maxLength"], path, "too long")] if "maxLength" in rule else []
        out += [when(F.octet_length(text) < rule["minLength"], path, "too short")] if "minLength" in rule else []
        out += [when(~F.rlike(text, F.lit(FORMATS[rule["format"]])), path, f"no {rule['format']}")] if rule.get("format") in FORMATS else []
        return self.given(text, rule, path, out)

    def integer(self, value: Column, rule: dict, path: str, home: str, depth: int) -> Column:
        number = F.try_variant_get(value, "$", "bigint")
        out = [when(number > rule["maximum"], path, "too large")] if "maximum" in rule else []
        out += [when(number < rule["minimum"], path, "too small")] if "minimum" in rule else []
        return self.given(number, rule, path, out)

    def given(self, value: Column, rule: dict, path: str, out: list[Column]) -> Column:
        out += [when(~value.isin(rule["enum"]), path, "not one of the values")] if "enum" in rule else []
        out += [when(value != rule["const"], path, "not the value")] if "const" in rule else []
        return F.flatten(F.array(*out)) if out else none()

    def union(self, value: Column, rule: dict, path: str, home: str, depth: int) -> Column:
        kind = F.try_variant_get(value, '$["$type"]', "string")
        out = F.when(kind.isNull(), found_at(path, F.lit("no $type")))
        for ref in rule["refs"]:
            full = home + ref if ref.startswith("#") else ref
            if full.partition("#")[0] in self.schemas:  # of a document that isn't given nothing is known
                known, document = self.definition(ref, home)
                out = out.when(kind == full, self.check(value, known, path, document, depth + 1))
            else:
                out = out.when(kind == full, none())
        return out.otherwise(found_at(path, F.lit("unknown $type")) if rule.get("closed") else none())


def none() -> Column:
    return F.array().cast("array<struct<path:string,rule:string>>")


def found_at(path: str, rule: Column) -> Column:
    return F.array(F.struct(F.lit(path).alias("path"), rule.alias("rule")))


def when(test: Column, path: str, rule: str) -> Column:
    return F.when(test, found_at(path, F.lit(rule))).otherwise(none())


def violations(records: DataFrame, schemas: dict[str, dict], name: str, key: str = "rkey", text: str = "record_json") -> DataFrame:
    """key, path, rule: everything in which a record departs from the main definition of a schema document; $ is the
    record itself, [] an item of an array. One projection and no shuffle; a null text is no JSON."""
    schema = Schema(schemas)
    rows = records.select(F.col(key), F.try_parse_json(F.col(text)).alias("_value"))
    main, home = schema.definition(name, name)
    found = F.when(F.col("_value").isNull(), found_at("$", F.lit("no JSON"))).otherwise(schema.check(F.col("_value"), main, "$", home))
    return rows.select(key, F.explode(found).alias("v")).select(key, "v.path", "v.rule")
