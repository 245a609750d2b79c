"""Reading the JSON payload column: one typed parse per event.

``parse_payload`` declares only the fields an operator reads, so Jackson skips
the rest of the (often tens of kilobytes long) body, and it puts the parsed
struct behind a generator. Without that barrier Catalyst pushes a filter on a
parsed field below the projection and parses the body again for each field the
filter names; with it the plan holds exactly one ``from_json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARSED = "p"
_RAW = "_payload"


def _tree(*paths: str) -> dict:
    """The dotted ``paths`` as nested names; a leaf is its type, STRING unless given."""
    tree: dict = {}
    for path in paths:
        dotted, _, leaf_type = path.partition(":")
        *parents, leaf = dotted.split(".")
        node = tree
        for name in parents:
            node = node.setdefault(name, {})
        node[leaf] = leaf_type or "string"
    return tree


def payload_ddl(*paths: str) -> str:
    """DDL of the smallest struct that holds the dotted ``paths``.

    A leaf is STRING unless given as ``path:type``, for example
    ``commits:array<struct<id:string>>``.
    """

    def render(node: dict | str) -> str:
        if isinstance(node, str):
            is_array = node.startswith("array")
            return _with_variants(T.DataType.fromDDL(node)).simpleString() if is_array else node
        return f"struct<{','.join(f'{name}:{render(child)}' for name, child in node.items())}>"

    return ", ".join(f"{name} {render(child)}" for name, child in _tree(*paths).items())


def _with_variants(kind: T.DataType) -> T.DataType:
    """``kind`` with its string leaves as VARIANT, which keeps what they are in the JSON."""
    if isinstance(kind, T.StringType):
        return T.VariantType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_with_variants(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _with_variants(f.dataType)) for f in kind])
    return kind


def _scalars_of(value: Column, kind: T.DataType) -> Column:
    """A value of type ``_with_variants(kind)`` as ``kind``; an object or array at a string leaf is NULL."""
    if isinstance(kind, T.StringType):
        nested = F.coalesce(F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), F.lit(False))
        return F.when(~nested, F.try_variant_get(value, "$", "string"))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _scalars_of(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = F.struct(*(_scalars_of(value[f.name], f.dataType).alias(f.name) for f in kind))
        return F.when(value.isNotNull(), fields)
    return value


def _scalar_leaves(tree: dict, node: Column, payload: Column, path: str = "$") -> list[Column]:
    """The fields of ``node``, a leaf of type STRING NULL where the payload has an object or array.

    The parse gives such a leaf as its JSON text. Only a text that opens like
    one is looked up by type, since it may also be a genuine string. Inside an
    array the parse keeps string leaves as VARIANT, which have their type with them.
    """
    out = []
    for name, child in tree.items():
        value, at = node[name], f"{path}.{name}"
        if isinstance(child, dict):
            value = F.struct(*_scalar_leaves(child, value, payload, at))
        elif child == "string":
            # The second parse stands inside a branch: anywhere else Spark lifts it
            # out as a common subexpression and runs it for every row.
            kind = variant_kind(F.try_parse_json(payload), at)
            scalar = ~F.coalesce(kind.rlike("^(OBJECT|ARRAY)"), F.lit(False))
            value = F.when(value.rlike(r"^\s*[\[{]"), F.when(scalar, value)).otherwise(value)
        elif child.startswith("array"):
            value = _scalars_of(value, T.DataType.fromDDL(child))
        out.append(value.alias(name))
    return out


def parse_payload(
    df: DataFrame, *paths: str, keep: tuple[str, ...] = (), column: str = "payload"
) -> DataFrame:
    """Columns ``keep`` plus the struct ``p`` of the wanted payload paths."""
    parsed = F.from_json(F.col(column), payload_ddl(*paths))
    raw = df.select(*keep, F.col(column).alias(_RAW), F.explode(F.array(parsed)).alias(PARSED))
    leaves = _scalar_leaves(_tree(*paths), F.col(PARSED), F.col(_RAW))
    return raw.select(*keep, F.struct(*leaves).alias(PARSED))


def timed(events: DataFrame) -> DataFrame:
    """``events`` with a ``received`` column, NULL if they come without one."""
    if "received" in events.columns:
        return events
    return events.withColumn("received", F.lit(None).cast("timestamp"))


def field(path: str) -> Column:
    """A parsed payload field by its dotted path."""
    return F.col(f"{PARSED}.{path}")


# What keeps a row out of its table: a column that ``cast_columns`` adds on demand.
UNREADABLE = "unreadable"


def cast_columns(
    df: DataFrame, types: dict[str, str], aside: bool = False, required: tuple[str, ...] = ()
) -> DataFrame:
    """``df`` with its text columns as ``types``; a text that does not fit fails the query.

    With ``aside`` nothing fails: such a value becomes NULL and the array
    ``unreadable`` lists it as ``column=text``, and a NULL in a ``required``
    column as ``column``. The array of a sound row is empty.
    """
    if not aside:
        return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    value = {c: F.col(c).try_cast(t) for c, t in types.items()}
    faults = [
        F.when(F.col(c).isNotNull() & v.isNull(), F.concat(F.lit(f"{c}="), F.col(c))) for c, v in value.items()
    ]
    faults += [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    columns = [value[c].alias(c) if c in value else F.col(c) for c in df.columns]
    return df.select(*columns, F.array_compact(F.array(*faults)).alias(UNREADABLE))


def json_scalar(column: Column | str, path: str) -> Column:
    """The scalar at a JSON path as text; NULL for objects, arrays, null and missing.

    The strict form for a path whose type is not known beforehand.
    """
    variant = F.try_parse_json(column)
    kind = variant_kind(variant, path)
    return F.when(~kind.rlike("^(OBJECT|ARRAY)"), F.try_variant_get(variant, path, "string"))


def variant_kind(variant: Column, path: str) -> Column:
    """Type name of the value at ``path``: OBJECT<..>, ARRAY<..>, STRING, BIGINT, VOID, NULL if missing."""
    return F.schema_of_variant(F.try_variant_get(variant, path, "variant"))


def variant_is_object(variant: Column, path: str) -> Column:
    """Whether the value at ``path`` is an object. Costs a walk through that value."""
    return F.coalesce(variant_kind(variant, path).startswith("OBJECT"), F.lit(False))


def is_json_object(text: Column, variant: Column) -> Column:
    """Whether a whole text is a JSON object, given its parse result.

    Valid JSON is an object exactly if it opens with a brace, which is far
    cheaper to see than the type of a large value.
    """
    return variant.isNotNull() & text.rlike(r"^\s*\{")


def variant_text(variant: Column, path: str) -> Column:
    """A JSON string at ``path``; NULL for any other type and for the empty string."""
    value = F.when(variant_kind(variant, path) == "STRING", F.try_variant_get(variant, path, "string"))
    return F.nullif(value, F.lit(""))


def variant_id(variant: Column, path: str) -> Column:
    """A JSON number at ``path`` as integer text; NULL for any other type.

    JSON numbers count as doubles, so a fraction is cut off.
    """
    kind = variant_kind(variant, path)
    is_number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    number = F.when(is_number, F.try_variant_get(variant, path, "double"))
    return number.try_cast("bigint").cast("string")
