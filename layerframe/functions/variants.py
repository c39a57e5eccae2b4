"""Column helpers over VARIANT values.

Service payloads are untyped JSON.  These helpers read them with null instead
of an error on a mismatch.  Each names its argument as few times as it can: filters are
pushed through projections by copying expressions, so a helper that repeats its argument
would multiply the work below it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT = "map<string,variant>"

# What lax boolean parsing accepts, lower-cased; engine type names of JSON
# values; the JSON texts that are false.
WORDS = "true:true,t:true,yes:true,y:true,on:true,1:true,false:false,f:false,no:false,n:false,off:false,0:false"
KINDS = (
    "VOID:null,BOOLEAN:boolean,BIGINT:integer,DECIMAL:number,DOUBLE:number,"
    "STRING:string,OBJECT:object,ARRAY:array"
)
FALSE_JSON = ["null", "false", "0", "0.0", "-0.0", '""', "[]", "{}"]


def lookup(pairs: str, key: Column) -> Column:
    """``key`` in a literal map; the map itself is folded away."""
    return F.try_element_at(F.str_to_map(F.lit(pairs), F.lit(","), F.lit(":")), key)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once and named, not copied into each mention."""
    return F.element_at(F.transform(F.array(value), use), 1)


def path(*keys: str) -> str:
    """A VARIANT path for literal keys, quoted so dots and blanks are safe."""
    parts = []
    for key in keys:
        if "'" not in key:
            parts.append(f"['{key}']")
        elif '"' not in key:
            parts.append(f'["{key}"]')
        else:
            raise ValueError(f"key {key!r} mixes both quote characters")
    return "$" + "".join(parts)


def get(value: Column, *keys: str, to: str = "variant") -> Column:
    return F.try_variant_get(value, path(*keys), to)


def first_of(value: Column, *keys: str) -> Column:
    """The first key that is present (camel and snake case spellings of one key)."""
    return F.coalesce(*[get(value, key) for key in keys])


def has(value: Column, *keys: str) -> Column:
    """Whether the key is present, also when its value is null."""
    return get(value, *keys).isNotNull()


def non_null(value: Column) -> Column:
    """JSON null turned into SQL null."""
    return F.when(~F.is_variant_null(value), value)


def entries(value: Column) -> Column:
    """The object as ``MAP<STRING, VARIANT>``; null for anything but an object."""
    return F.try_variant_get(value, "$", OBJECT)


def elements(value: Column, *keys: str) -> Column:
    """The array as ``ARRAY<VARIANT>``; null for anything but an array."""
    return F.try_variant_get(value, path(*keys), "array<variant>")


def is_object(value: Column) -> Column:
    """Object test that does not walk the whole value."""
    return F.try_variant_get(value, "$", "struct<_:variant>").isNotNull()


def kind(value: Column) -> Column:
    """``null boolean integer number string object array`` for small values.

    Whole numbers beyond 64 bits and ``4326.0`` are both ``number``.
    """
    shape = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.coalesce(lookup(KINDS, shape), F.lit("null"))


def text(value: Column) -> Column:
    """Strings as they are, everything else as JSON, null as null."""
    return F.try_variant_get(value, "$", "string")


def as_int(value: Column) -> Column:
    """Integer coercion: ``"7"`` is 7, 1.9 is 1, ``"1.9"`` and ``"abc"`` are null."""
    return F.try_variant_get(value, "$", "bigint")


def truthy(value: Column) -> Column:
    """Truth of a JSON value: empty, zero, false and null are false."""
    return F.coalesce(~F.to_json(value).isin(FALSE_JSON), F.lit(False))


def lax_bool(value: Column) -> Column:
    """Booleans, 0/1 and the usual words; null when it is none of them."""
    return lookup(WORDS, F.lower(text(value))).cast("boolean")


def lax_int(value: Column) -> Column:
    """Integers, whole floats, booleans and numeric strings; null otherwise."""
    whole = F.try_variant_get(value, "$", "bigint")
    return F.when(whole.cast("double") == F.try_variant_get(value, "$", "double"), whole)


def strict_text(value: Column) -> Column:
    """The value only when it is a JSON string."""
    return F.when(F.schema_of_variant(value) == "STRING", text(value))


def make_object(**members: Column) -> Column:
    """A VARIANT object of VARIANT members; null members are left out."""
    pairs = F.create_map(*[item for k, v in members.items() for item in (F.lit(k), v)])
    return F.to_variant_object(F.map_filter(pairs, lambda _, v: v.isNotNull()))


def json_literal(document: str) -> Column:
    return F.parse_json(F.lit(document))


def parsed(df, text_column: str, name: str = "body"):
    """Adds the parsed text as VARIANT, null where it is not JSON.

    The value comes out of a generator of one row: a filter on anything derived from it
    then stays above the parse instead of repeating it for every mention.
    """
    value = F.array(F.struct(F.try_parse_json(text_column).alias(name)))
    return df.select("*", F.inline(value))
