"""Rules over map-element tags, as tables from which column expressions are made."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results must agree on them.
#: Keys in the order in which the first present one names the category.
CATEGORY_KEYS = (
    "amenity", "shop", "tourism", "leisure", "office", "craft", "healthcare", "historic", "natural", "man_made",
    "aeroway", "railway", "public_transport", "place", "boundary", "waterway", "power", "landuse", "highway",
    "barrier", "emergency", "telecom", "building",
)
#: key -> ("any",) or ("not" | "in", values): an element with a name counts when one of these holds.
WHITELIST: dict[str, tuple[str, tuple[str, ...]]] = {
    "amenity": ("not", (
        "parking", "parking_space", "bench", "waste_basket", "bicycle_parking", "shelter", "recycling", "toilets",
        "post_box", "drinking_water", "vending_machine", "waste_disposal", "hunting_stand", "parking_entrance",
        "grit_bin", "give_box", "bbq",
    )),
    "shop": ("not", ("yes", "vacant")),
    "tourism": ("not", ()),
    "leisure": ("in", (
        "park", "sports_centre", "fitness_centre", "swimming_pool", "golf_course", "stadium", "sports_hall", "marina",
        "nature_reserve", "garden", "playground", "dog_park", "ice_rink", "water_park", "miniature_golf",
        "bowling_alley", "beach_resort", "resort", "horse_riding", "dance", "sauna", "amusement_arcade",
        "adult_gaming_centre", "trampoline_park", "escape_game", "hackerspace", "bird_hide",
    )),
    "office": ("not", ("yes",)),
    "craft": ("not", ("yes",)),
    "healthcare": ("not", ("yes",)),
    "historic": ("in", (
        "castle", "monument", "memorial", "archaeological_site", "ruins", "fort", "manor", "church", "city_gate",
        "building", "mine", "wreck", "wayside_shrine", "tomb", "citywalls", "monastery", "battlefield", "aircraft",
    )),
    "natural": ("in", (
        "peak", "beach", "spring", "bay", "cave_entrance", "volcano", "glacier", "hot_spring", "cape", "hill",
        "valley", "saddle", "ridge", "geyser", "arch", "gorge", "rock", "water", "wood", "wetland", "cliff", "strait",
        "peninsula",
    )),
    "man_made": ("in", (
        "lighthouse", "tower", "pier", "observatory", "windmill", "water_tower", "works", "chimney", "obelisk",
        "watermill", "beacon", "bridge", "wastewater_plant", "water_works", "pumping_station", "adit", "mineshaft",
    )),
    "aeroway": ("in", ("aerodrome", "terminal", "heliport", "helipad")),
    "railway": ("in", ("station", "halt", "tram_stop", "subway_entrance", "yard")),
    "public_transport": ("in", ("station",)),
    "place": ("in", (
        "city", "town", "village", "hamlet", "suburb", "neighbourhood", "quarter", "island", "square", "locality",
        "isolated_dwelling", "farm", "islet", "city_block",
    )),
    "landuse": ("in", ("cemetery", "industrial", "quarry", "allotments", "military", "winter_sports")),
    "waterway": ("in", ("dam", "waterfall")),
    "power": ("in", ("plant", "substation")),
    "boundary": ("in", ("national_park", "protected_area", "aboriginal_lands")),
    "highway": ("in", ("services", "rest_area", "trailhead")),
    "barrier": ("in", ("toll_booth",)),
    "emergency": ("in", ("ambulance_station",)),
    "telecom": ("in", ("data_center",)),
}
#: Buildings count for ways and relations only.
BUILDING = ("not", (
    "house", "detached", "semidetached_house", "terrace", "garage", "garages", "shed", "hut", "barn", "greenhouse",
    "static_caravan", "roof", "no", "construction", "ruins",
))
#: Tags that a record keeps besides name:*.
KEPT_TAGS = (
    "alt_name", "old_name", "official_name", "short_name", "loc_name", "int_name", "cuisine", "sport", "religion",
    "denomination", "opening_hours", "phone", "website", "wikidata", "wheelchair", "internet_access", "addr:street",
    "addr:housenumber", "addr:city", "addr:postcode", "addr:country",
)
#: Suffixes of name tags that are no names; each also as the head of x:...
NO_NAME = ("prefix", "etymology", "signed", "pronunciation", "adjective", "genitive")
#: Name tag -> type of variant.
VARIANT_TYPES = {
    "alt_name": "alternate",
    "int_name": "alternate",
    "official_name": "official",
    "short_name": "short",
    "loc_name": "colloquial",
    "old_name": "historical",
}


def named(tags: Column) -> Column:
    return F.coalesce(F.trim(tags["name"]) != "", F.lit(False))


def qualifies(tags: Column, building: bool = False) -> Column:
    """Whether an element is a place. building: its rule counts too (ways and relations)."""
    test = F.lit(False)
    for key, (kind, values) in {**WHITELIST, **({"building": BUILDING} if building else {})}.items():
        value, listed = tags[key], list(values)
        if kind == "in":
            test = test | F.coalesce(value.isin(listed), F.lit(False))
        else:
            test = test | (value.isNotNull() & ~F.coalesce(value.isin(listed), F.lit(False)) if listed else value.isNotNull())
    return named(tags) & test


def category(tags: Column) -> Column:
    """key=value of the first category key that is present, whether it qualifies or not."""
    return F.coalesce(*[F.concat(F.lit(f"{k}="), tags[k]) for k in CATEGORY_KEYS])


def kept_tags(tags: Column, primary: Column) -> Column:
    """The tags that a record keeps: name:* and KEPT_TAGS, without the category's own key."""
    return F.map_filter(tags, lambda k, _: (k != F.split_part(primary, F.lit("="), F.lit(1))) & (k.startswith("name:") | k.isin(*KEPT_TAGS)))


def dropped_suffix(suffix: Column) -> Column:
    return F.rlike(suffix, F.lit(f"^({'|'.join(NO_NAME)})(:|$)|word_stress$"))


def variant_kind(key: Column) -> Column:
    """struct<type, language> of a name tag, null for any other key and for suffixes that are no names."""
    none = F.lit(None).cast("string")
    kind = lambda name, language: F.struct(F.lit(name).alias("type"), language.alias("language"))
    out = F.when(F.lit(False), kind("", none))
    for tag, name in VARIANT_TYPES.items():
        out = out.when(key == tag, kind(name, none))
    suffix = F.substring_index(key, ":", 1)
    rest = F.substring(key, F.length(suffix) + 2, F.length(key))
    dropped = dropped_suffix(rest)
    name_of = (
        F.when(dropped, F.lit(None))
        .when(rest == "abbr", kind("short", none))
        .when(F.rlike(rest, F.lit(r"^-\d{4}(-\d{4})?$")), kind("historical", none))
        .when(rest == "carnaval", kind("colloquial", none))
        .otherwise(kind("alternate", rest))
    )
    out = out.when(key.startswith("name:"), name_of)
    for tag, name in VARIANT_TYPES.items():
        if tag != "int_name":  # its suffixed form is not recognised
            out = out.when(key.startswith(f"{tag}:"), F.when(~dropped, kind(name, rest)))
    return out


def _after(a: Column, b: Column) -> Column:
    """Order of two values with null last."""
    return F.when(a.eqNullSafe(b), 0).when(a.isNull(), 1).when(b.isNull(), -1).when(a < b, -1).otherwise(1)


def sorted_variants(variants: Column) -> Column:
    """By name, type, language, nulls last: sort_array alone would put them first."""

    def order(a, b):
        name, kind = _after(a["name"], b["name"]), _after(a["type"], b["type"])
        return F.when(name != 0, name).when(kind != 0, kind).otherwise(_after(a["language"], b["language"]))

    return F.array_sort(variants, order)


def osm_variants(tags: Column, name: Column) -> Column:
    """array<struct<name, type, language>> of all name tags, values parted at ';', without blanks and the name itself."""

    def of(entry):
        values = F.filter(F.transform(F.split(entry["value"], ";"), lambda v: F.trim(v)), lambda v: (v != "") & (v != F.trim(name)))
        kind = variant_kind(entry["key"])
        return F.transform(values, lambda v: F.struct(v.alias("name"), kind["type"].alias("type"), kind["language"].alias("language")))

    entries = F.filter(F.map_entries(tags), lambda e: variant_kind(e["key"]).isNotNull())
    return sorted_variants(F.flatten(F.transform(entries, of)))


def name_variants(common: Column, rules: Column) -> Column:
    """Variants from a map of language -> name and from rules <language, value, variant>; blanks go, doubles stay."""
    kinds = {"common": "alternate", "official": "official", "alternate": "alternate", "short": "short"}
    kind = lambda r: F.coalesce(F.create_map(*[F.lit(x) for p in kinds.items() for x in p])[r["variant"]], F.lit("alternate"))
    typed = "array<struct<name:string,type:string,language:string>>"
    one = F.transform(F.map_entries(common), lambda e: F.struct(e["value"].alias("name"), F.lit("alternate").alias("type"), e["key"].alias("language")))
    two = F.transform(rules, lambda r: F.struct(r["value"].alias("name"), kind(r).alias("type"), r["language"].alias("language")))
    empty = F.array().cast(typed)
    both = F.concat(F.coalesce(one.cast(typed), empty), F.coalesce(two.cast(typed), empty))
    return sorted_variants(F.filter(both, lambda v: F.trim(v["name"]) != ""))
