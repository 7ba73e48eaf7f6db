"""Single members of JSON documents held in text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPTIONS = {"allowSingleQuotes": "false"}
_MAP = "map<string,string>"
_IN_BRACES = r"(?s)^[ \t\r\n]*\{.*\}[ \t\r\n]*$"


def _one_brace(document: Column) -> Column:
    """Whether the first closing brace ends the text, so that nothing follows an object."""
    up_to_brace = F.octet_length(F.substring_index(document, "}", 1))
    return up_to_brace + 1 == F.octet_length(document)


def _alone(document: Column) -> Column:
    """Whether the text is one object and nothing else, braces anywhere.

    The parser stops at the end of an object and does not look at what follows. Here the text
    must parse as the only element of an array and as the member of an outer object: what
    follows could close one of the two early, but never both. Failed parses are costly, hence
    the look at both ends first.
    """
    as_element = F.from_json(
        F.concat(F.lit("["), document, F.lit("]")), f"array<{_MAP}>", _OPTIONS
    )
    as_member = F.from_json(
        F.concat(F.lit('{"d":'), document, F.lit("}")), f"d {_MAP}", _OPTIONS
    )["d"]
    return F.when(
        document.rlike(_IN_BRACES), F.when(F.size(as_element) == 1, as_member.isNotNull())
    )


def with_member(frame: DataFrame, name: str, document: str, key: str) -> DataFrame:
    """Adds ``{name}_text`` and ``{name}_found`` for one member of the JSON objects in a column.

    Found is true where the key is present, false where it is absent, and NULL where the text
    is not exactly one JSON object. A repeated key counts with its last value; a JSON null is
    a key that is present without text.

    A member with text in a document without inner braces, which is the rule, costs one parse.
    Only other documents are looked at again.
    """
    text, column = F.col(f"{name}_text"), F.col(document)
    keys = F.map_keys(F.from_json(column, _MAP, _OPTIONS))
    found = F.when(text.isNotNull() & _one_brace(column), F.lit(True)).when(
        _one_brace(column) | _alone(column), F.array_contains(keys, key)
    )
    return frame.withColumn(
        f"{name}_text", F.from_json(column, f"`{key}` string", _OPTIONS)[key]
    ).withColumn(f"{name}_found", found)


def member_or(name: str, default: str | None) -> Column:
    """Text of a member added by ``with_member``; ``default`` only where the key is absent."""
    found = F.col(f"{name}_found")
    return F.when(found, F.col(f"{name}_text")).when(~found, F.lit(default))
