"""Access to members of a VARIANT document by their (dotted) key."""

from pyspark.sql import Column, functions as F


def record(doc: Column, members: dict[str, str]) -> Column:
    """Several members (key -> type) as one struct, read in a single pass.

    A member that is absent, JSON null or not convertible is NULL on its own.
    """
    fields = ", ".join(f"`{key}`: {kind}" for key, kind in members.items())
    return F.try_variant_get(doc, "$", f"struct<{fields}>")


def subtree(doc: Column, key: str) -> Column:
    """One member as a VARIANT; SQL NULL when absent or JSON null."""
    member = F.try_variant_get(doc, f'$["{key}"]', "variant")
    return F.when(~F.is_variant_null(member), member)


def first_member(key: str, *objects: str, kind: str = "string") -> Column:
    """A member from the first object that has it; NULL when not convertible.

    ``objects`` are columns that were read as maps of texts.
    """
    found = [f"try_element_at({o}, '{key}')" for o in objects]
    first = f"coalesce({', '.join(found)})"
    return F.expr(first if kind == 'string' else f'try_cast({first} as {kind})')


def whole_number(text: Column) -> Column:
    """Text to BIGINT, NULL when it is not a number."""
    return text.try_cast("bigint")
