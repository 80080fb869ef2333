"""Columns over one raw document: validity, categories, reasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roamgrid.schemas import MAX_SPECIES, MIN_SPECIES, RAW_LOCATION, RAW_TEXT, RAW_TYPED

# Coordinate categories, in the order in which they are tested.
COORD_CATEGORIES = ["sin_location", "tipo_no_point", "coordinates_malformado", "no_numerico_o_nulo", "nan",
                    "fuera_de_rango", "cero_cero", "ok"]
# Discard reasons, in the order of the rules.
REASONS = ["coordinates", "species", "date"]

_JSON = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}


def is_blank(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(" \t\r\n\x0b\f"))) == 0


def typed_document(line: Column) -> Column:
    return F.from_json(line, RAW_TYPED, _JSON)


# Strings, and whatever else is no brace. Possessive: linear in the line, and no recursion.
_NO_BRACES = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^{}"]++'
_PLAIN_DEPTH = 6


def ends_with_object(line: Column) -> Column:
    """Whether the object at the start of a line is the whole line, for a line that starts with a well-formed object.

    With strings and all but braces removed, what stands between the first and the last brace must pair off. If the first
    object ended before, it would close a brace that it does not open. A pass removes the innermost pairs; few passes
    do for common depths, and deeper lines take as many as they need.
    """
    braces = F.regexp_replace(line, _NO_BRACES, "")
    inner = F.substring(braces, F.lit(2), F.greatest(F.length(braces) - 2, F.lit(0)))
    pair, nothing = F.lit("{}"), F.lit("")
    for _ in range(_PLAIN_DEPTH):
        inner = F.replace(inner, pair, nothing)
    deep = F.aggregate(F.sequence(F.lit(0), F.length(inner)), inner, lambda rest, _: F.replace(rest, pair, nothing))
    closed = F.btrim(line, F.lit(" \t\r\n\x0b\f")).endswith("}")
    return closed & ((inner == "") | (deep == ""))


def is_broken(line: Column, typed: Column) -> Column:
    """Whether the line is no JSON object, or more than one. A type mismatch also marks the typed parse, so only marked lines are
    parsed again with every key as text. The parser reads the first object only, so the end of the line is looked at as well."""
    return F.when(typed.isNull(), True).when(typed["_corrupt"].isNull(), ~ends_with_object(line)).otherwise(
        F.from_json(line, RAW_TEXT, _JSON)["_corrupt"].isNotNull() | ~ends_with_object(line))


def lng_lat(doc: Column) -> tuple[Column, Column]:
    """The two coordinates; NULL unless there are exactly two."""
    pair = doc[RAW_LOCATION]["coordinates"]
    two = F.size(pair) == 2
    return F.when(two, F.try_element_at(pair, F.lit(1))), F.when(two, F.try_element_at(pair, F.lit(2)))


def coord_category(line: Column, doc: Column) -> Column:
    location = doc[RAW_LOCATION]
    pair = location["coordinates"]
    lng, lat = lng_lat(doc)
    # A value that is no number empties the typed array; its text tells a wrong shape from a wrong element.
    shape = F.size(F.from_json(F.get_json_object(line, f"$.{RAW_LOCATION}.coordinates"), "array<string>"))
    shape_of = F.when(pair.isNotNull(), F.size(pair)).otherwise(F.coalesce(shape, F.lit(-1)))
    return (
        F.when(location.isNull(), COORD_CATEGORIES[0])
        .when(~location["type"].eqNullSafe("Point"), COORD_CATEGORIES[1])
        .when(shape_of != 2, COORD_CATEGORIES[2])
        .when(lng.isNull() | lat.isNull(), COORD_CATEGORIES[3])
        .when(F.isnan(lng) | F.isnan(lat), COORD_CATEGORIES[4])
        .when((F.abs(lat) > 90) | (F.abs(lng) > 180), COORD_CATEGORIES[5])
        .when((lat == 0) & (lng == 0), COORD_CATEGORIES[6])
        .otherwise(COORD_CATEGORIES[7])
    )


def valid_coords(kind: Column, lng: Column, lat: Column) -> Column:
    """``kind`` is the GeoJSON type; bounds are inclusive, (0, 0) and NaN are invalid."""
    usable = (kind == "Point") & ~F.isnan(lng) & ~F.isnan(lat) & (F.abs(lat) <= 90) & (F.abs(lng) <= 180) \
        & ~((lat == 0) & (lng == 0))
    return F.coalesce(usable, F.lit(False))


def valid_species(species: Column) -> Column:
    return F.coalesce(species.between(MIN_SPECIES, MAX_SPECIES), F.lit(False))


def discard_reason(kind: Column, lng: Column, lat: Column, species: Column, utc: Column) -> Column:
    """The first rule that fails, NULL for a row to keep."""
    return (F.when(~valid_coords(kind, lng, lat), REASONS[0])
            .when(~valid_species(species), REASONS[1])
            .when(utc.isNull(), REASONS[2]))


def key_signature(line: Column) -> Column:
    """Sorted key names of a document. A document with a bare NaN has its keys read through a map."""
    keys = F.coalesce(F.json_object_keys(line), F.map_keys(F.from_json(line, "map<string,string>", _JSON)))
    return F.array_join(F.array_sort(keys), ",")
