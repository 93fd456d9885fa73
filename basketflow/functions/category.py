"""Product category of an event."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketflow.functions.text import WHITE_SPACE, begins_and_ends_visibly, clean, strip

# Where a category may stand, in order of precedence, both as
# columns of the log and as fields of the product metadata.
CATEGORY_FIELDS = [
    "category",
    "category_level_1",
    "category_level_2",
    "category_level_3",
    "category_level_4",
    "product_category",
]

# Fixed value: how a category is found in text which is not valid JSON.
CATEGORY_PATTERN = r'"category"\s*:\s*"([^"]+)"'

# The metadata is parsed as the only field of an enclosing object.  That way
# text after the end of the JSON value counts as an error, and ``_bad`` tells a
# failed parse from metadata without category.
_FIELDS = ", ".join(f"{name}: STRING" for name in CATEGORY_FIELDS)
_OBJECT = f"v STRUCT<{_FIELDS}>, _bad STRING"
_ANY_VALUE = "v STRING, _bad STRING"
_OPTIONS = {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"}

# Metadata that need no parser: an object of plain texts whose category comes first, and once.
# The length of names and the number of fields are bounded, as a parser's and a pattern's are.
_PLAIN, _VISIBLE = r'[ -~&&[^"\\]]', r'[!-~&&[^"\\]]'
_CATEGORY_FIRST = (
    rf'\A\{{"category": ?"({_VISIBLE}(?:{_PLAIN}*{_VISIBLE})?)"'
    rf'(?:, ?"(?!category"){_PLAIN}{{1,100}}": ?"{_PLAIN}*"){{0,50}}\}}\z'
)


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with the value evaluated once however often it is used.

    Steps in columns of their own would do the same only until a filter on the
    result is pushed through them: that repeats each step for every use.
    """
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _parse(text: Column, schema: str) -> Column:
    return F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), schema, _OPTIONS)


def _malformed(text: Column) -> Column:
    """Of a text that gave no object: is it no JSON at all?

    Every field of an object can be read as text, so one that begins as an
    object must be damaged; only the others need another parse to tell.
    """
    return text.startswith("{") | _parse(text, _ANY_VALUE)["_bad"].isNotNull()


def _repaired(text: Column) -> Column:
    """Undo CSV quoting that was left in the text: doubled and enclosing quotes.
    Valid JSON other than an object stays as it is."""
    single = F.replace(text, F.lit('""'), F.lit('"'))
    unquoted = F.regexp_replace(single, r'(?s)^"(.*)"\z', "$1")
    return F.when(_malformed(text), unquoted).otherwise(text)


def _first_filled(fields: Column) -> Column:
    first = fields[CATEGORY_FIELDS[0]]
    values = F.transform(F.array(*[fields[name] for name in CATEGORY_FIELDS]), strip)
    filled = F.get(F.filter(values, lambda value: value != ""), F.lit(0))
    return F.when(begins_and_ends_visibly(first), first).otherwise(filled)


def _searched(text: Column) -> Column:
    found = F.trim(F.regexp_extract(text, CATEGORY_PATTERN, 1), F.lit(WHITE_SPACE))
    return _once(found, lambda value: F.when(value != "", value))


def metadata_category(metadata: Column) -> Column:
    """Category out of a product metadata text.

    Plain objects are read by a pattern.  Other text is parsed as it is; only if it is
    no JSON, its quotes are undone and it is parsed again; only if that fails too, the pattern is searched.
    Valid JSON without a category, or other than an object, gives NULL.
    """
    text = F.when(metadata != "", metadata)

    def from_first(first: Column) -> Column:
        return F.when(first["_bad"].isNull(), _first_filled(first["v"])).otherwise(
            _once(_once(strip(text), _repaired), from_repaired)
        )

    def from_repaired(again: Column) -> Column:
        return _once(
            _parse(again, _OBJECT),
            lambda second: F.when(second["_bad"].isNull(), _first_filled(second["v"])).when(
                _malformed(again), _searched(again)
            ),
        )

    plain = F.regexp_extract(metadata, _CATEGORY_FIRST, 1)
    return _once(plain, lambda found: F.when(found != "", found).otherwise(_once(_parse(text, _OBJECT), from_first)))


def event_category(columns: list[str]) -> Column:
    """Category of an event whose log has ``columns``: a category column if one
    is filled, else what the product metadata says."""
    found = [clean(F.col(name)) for name in CATEGORY_FIELDS if name in columns]
    if "product_metadata" in columns:
        found.append(metadata_category(F.col("product_metadata")))
    return F.coalesce(*found) if found else F.lit(None).cast("string")
