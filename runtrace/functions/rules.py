"""Member rules: a table of names and kinds, checked entry by entry against a VARIANT object."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runtrace import contract

ISSUE_TYPE = "array<struct<code:string,message:string,path:array<string>,event_id:string>>"

_UUID = "(?d)^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
_STABLE_ID = "(?d)^[a-z][a-z0-9_]*$"
_VERSION = "(?d)^[0-9A-Za-z][0-9A-Za-z._-]*$"

# Members of the nested objects: name -> kind, and the names that must be there.
OPTION_FIELDS = {
    "slot": "slot",
    "item_id": "stable_id",
    "rarity": "rarity",
    "acquisition_count_before": "count",
    "effect_type": "stable_id",
    "effect_value_before": "effect",
}
OPTION_REQUIRED = ("slot", "item_id", "rarity")
UPGRADE_FIELDS = {
    "item_id": "stable_id",
    "acquisition_count": "ordinal",
    "effect_type": "stable_id",
    "effect_value": "effect",
}
UPGRADE_REQUIRED = ("item_id", "acquisition_count")


def issue(code: str, message: Column | str, path: Column | list[str], event_id: Column) -> Column:
    message = F.lit(message) if isinstance(message, str) else message
    if isinstance(path, list):
        path = F.array(*[F.lit(part) for part in path]) if path else F.array().cast("array<string>")
    return F.struct(
        F.lit(code).alias("code"), message.alias("message"), path.alias("path"), event_id.alias("event_id")
    )


def when_broken(*rules: tuple[Column, Column]) -> Column:
    """The issues of the rules whose condition holds; an unknown condition breaks nothing."""
    return F.array_compact(F.array(*[F.when(broken, found) for broken, found in rules]))


def members(document: Column) -> Column:
    """A VARIANT object as map<string,variant>."""
    return F.from_json(F.to_json(document), "map<string,variant>")


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _number(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def elements(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


_ENUMS = {
    "event_name": contract.EVENT_NAMES,
    "source_type": contract.SOURCE_TYPES,
    "schema_version": (contract.SCHEMA_VERSION,),
    "choice_source": contract.CHOICE_SOURCES,
    "rarity": contract.RARITIES,
    "end_reason": contract.END_REASONS,
    "death_cause": contract.DEATH_CAUSES,
    "export_schema": (contract.EXPORT_SCHEMA_VERSION,),
    "source_region": (contract.EXPORT_SOURCE_REGION,),
    "destination_region": (contract.EXPORT_DESTINATION_REGION,),
    "privacy_mode": (contract.EXPORT_PRIVACY_MODE,),
    "data_class": contract.EXPORT_DATA_CLASSES,
}
_PATTERNS = {"uuid": (_UUID, 36), "stable_id": (_STABLE_ID, 64), "version": (_VERSION, 32)}
_WHOLE = ("ordinal", "count", "slot")
NUMBER_KINDS = ("ordinal", "count", "slot", "amount", "positive", "percent", "zero")

# How Spark names numbers in the schema text of a VARIANT.
NUMBER_SHAPE = r"(?:BIGINT|DOUBLE|DECIMAL\(\d+,\d+\))"


def object_shape(fields: dict[str, str], required: tuple[str, ...], whole: str = "BIGINT") -> str:
    """A pattern for the schema text of an object with these members; Spark lists members in name order."""
    parts = []
    for name, kind in sorted(fields.items()):
        if kind in _WHOLE:
            stored = whole
        elif kind in NUMBER_KINDS:
            stored = NUMBER_SHAPE
        elif kind == "effect":
            stored = f"(?:BOOLEAN|{NUMBER_SHAPE})"
        elif kind == "options":
            stored = f"ARRAY<{object_shape(OPTION_FIELDS, OPTION_REQUIRED)}>"
        elif kind == "upgrades":
            stored = f"ARRAY<(?:VOID|{object_shape(UPGRADE_FIELDS, UPGRADE_REQUIRED)})>"
        else:
            stored = "STRING"
        parts.append(f"(?:{name}: {stored}(?:, |(?=>)))" + ("" if name in required else "?"))
    return f"OBJECT<{''.join(parts)}>"


def text_holds(kind: str, text: Column) -> Column:
    """Whether a text is a value of a text kind."""
    if kind in _ENUMS:
        return text.isin(*_ENUMS[kind])
    pattern, longest = _PATTERNS[kind]
    return F.length(text).between(1, longest) & text.rlike(pattern)


def number_holds(kind: str, number: Column) -> Column:
    """Whether a number lies in the range of a number kind."""
    return {
        "ordinal": number >= 1,
        "count": number >= 0,
        "slot": number.between(1, 3),
        "amount": number >= 0,
        "positive": number > 0,
        "percent": number.between(0, 100),
        "zero": number == 0,
    }[kind]


def fits(kind: Column, value: Column, nested: bool = True) -> Column:
    """Whether a VARIANT value is of a kind; false for a kind nobody declared."""
    stored = F.schema_of_variant(value)
    string = stored == "STRING"
    numeric = stored.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    whole = numeric & (_number(value) % 1 == 0)
    kinds = {name: string & text_holds(name, _text(value)) for name in (*_ENUMS, *_PATTERNS)}
    kinds |= {name: (whole if name in _WHOLE else numeric) & number_holds(name, _number(value)) for name in NUMBER_KINDS}
    kinds["effect"] = numeric | (stored == "BOOLEAN")
    kinds["date"] = string & _text(value).rlike(r"^\d{4}-\d\d-\d\d$") & _text(value).try_cast("date").isNotNull()
    if nested:
        listed = stored.startswith("ARRAY")
        kinds["options"] = (
            listed
            & F.size(elements(value)).between(2, 3)
            & F.forall(elements(value), lambda item: object_fits(item, OPTION_FIELDS, OPTION_REQUIRED))
        )
        kinds["upgrades"] = (
            listed
            & (F.size(elements(value)) <= contract.MAX_UPGRADE_STATES)
            & F.forall(elements(value), lambda item: object_fits(item, UPGRADE_FIELDS, UPGRADE_REQUIRED))
        )
    chosen = None
    for name, condition in kinds.items():
        chosen = F.when(kind == name, condition) if chosen is None else chosen.when(kind == name, condition)
    return F.coalesce(chosen, F.lit(False))


def kind_table(fields: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in fields.items() for part in pair])


def object_fits(value: Column, fields: dict[str, str], required: tuple[str, ...]) -> Column:
    """A nested object with its required members, no unknown ones, and every value of its kind."""
    entries = members(value)
    return (
        is_object(value)
        & (F.size(F.array_except(F.array(*[F.lit(n) for n in required]), F.map_keys(entries))) == 0)
        & F.forall(
            F.map_entries(entries),
            lambda e: fits(F.try_element_at(kind_table(fields), e["key"]), e["value"], nested=False),
        )
    )
