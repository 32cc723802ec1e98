"""Access to JSON payloads held as VARIANT, with the JSON type kept."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(data: Column, path: str) -> Column:
    """The value at a dotted path; NULL if a level is missing or not an object."""
    return F.variant_get(data, f"$.{path}", "variant")


def text_at(data: Column, path: str) -> Column:
    return F.try_variant_get(data, f"$.{path}", "string")


def long_at(data: Column, path: str) -> Column:
    return F.try_variant_get(data, f"$.{path}", "bigint")


def opened(data: Column, wanted: Mapping[str, str]) -> Column:
    """The values at several dotted paths as one nested struct, read in one pass over the payload.

    ``wanted`` gives the type by path; a value that is missing or has no such type is NULL, as it
    is with ``at``, ``text_at`` and ``long_at``. No path may lead through another one. Where a path
    has three steps, each object is read by itself: that is faster there.
    """
    deep = any(path.count(".") > 1 for path in wanted)
    tree: dict = {}
    for path, kind in wanted.items():
        *above, name = path.split(".")
        node = tree
        for step in above:
            node = node.setdefault(step, {})
            if isinstance(node, str):
                raise ValueError(f"{path} leads through another path")
        if node.setdefault(name, kind) != kind:
            raise ValueError(f"{path} is wanted twice")

    def layout(node: dict | str) -> str:
        if isinstance(node, str):
            return node
        return f"struct<{','.join(f'`{name}`:{layout(below)}' for name, below in node.items())}>"

    def apart(node: dict, above: str) -> Column:
        flat = {name: below for name, below in node.items() if isinstance(below, str)}
        # One look at an object for all that is wanted of it.
        here = F.try_variant_get(data, above, layout(flat)) if flat else None
        return F.struct(
            *[
                (here[name] if name in flat else apart(below, f"{above}.{name}")).alias(name)
                for name, below in node.items()
            ]
        )

    return apart(tree, "$") if deep else F.try_variant_get(data, "$", layout(tree))


def json_type(value: Column) -> Column:
    """JSON type name; NULL when the key is absent, VOID for a JSON null."""
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.coalesce(json_type(value).startswith("OBJECT"), F.lit(False))


def has_key(data: Column, key: str) -> Column:
    """True when the key is present, even with a JSON null as its value."""
    return json_type(at(data, key)).isNotNull()


def truthy(value: Column) -> Column:
    """False for absent, null, false, zero and empty values; true otherwise."""
    rendered = F.to_json(value)
    number = F.try_variant_get(value, "$", "double")
    is_text = json_type(value) == "STRING"
    return F.coalesce(
        F.when(is_text, rendered != '""')
        .when(rendered.isin("null", "false", "[]", "{}"), F.lit(False))
        .when(rendered == "true", F.lit(True))
        .otherwise(F.coalesce(number != 0, F.lit(True)) & rendered.isNotNull()),
        F.lit(False),
    )


def items(value: Column) -> Column:
    """The elements of a JSON array; NULL for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")
