"""Type mapping and schema-evolution naming.

Source field types map to wire types, wire types map to table types; every integer
becomes 64-bit and every float double so firmware width changes never fork a column.
"""

from __future__ import annotations

from decimal import Decimal
from itertools import chain

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from ._util import as_col

# Source field type -> wire type.
SOURCE_TO_WIRE = {
    "int8_t": "int32",
    "int16_t": "int32",
    "int32_t": "int32",
    "int64_t": "int64",
    "uint8_t": "uint32",
    "uint16_t": "uint32",
    "uint32_t": "uint32",
    "uint64_t": "uint64",
    "float": "float",
    "double": "double",
    "bool": "bool",
    "char": "string",
}

# Wire type -> table (Spark SQL) type.
WIRE_TO_TABLE = {
    "int32": "bigint",
    "int64": "bigint",
    "uint32": "bigint",
    "uint64": "bigint",
    "sint32": "bigint",
    "sint64": "bigint",
    "fixed32": "bigint",
    "fixed64": "bigint",
    "sfixed32": "bigint",
    "sfixed64": "bigint",
    "float": "double",
    "double": "double",
    "bool": "boolean",
    "string": "string",
    "bytes": "binary",
    "enum": "string",
}

# Table type -> sibling-column suffix.
TYPE_SUFFIX = {
    "bigint": "i64",
    "double": "f64",
    "boolean": "bool",
    "string": "str",
    "binary": "bytes",
}

STANDARD_COLUMNS = [
    ("log_time", "timestamp_ntz"),
    ("publish_time", "timestamp_ntz"),
    ("sequence", "bigint"),
    ("mcap_id", "string"),
    ("multi_id", "int"),
    ("offset_us", "bigint"),
    ("log_date", "date"),
    ("time_source", "string"),
]


def _literal_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def wire_type(source_type) -> Column:
    """Source type name -> wire type name (NULL for unknown names)."""
    return F.try_element_at(_literal_map(SOURCE_TO_WIRE), as_col(source_type))


def table_type(wire) -> Column:
    """Wire type name -> table type name (NULL for unknown names)."""
    return F.try_element_at(_literal_map(WIRE_TO_TABLE), as_col(wire))


def type_suffix_col(type_name) -> Column:
    """Suffix code of a table type name; ``array<t>`` -> ``list_<code(t)>``."""
    t = as_col(type_name)
    inner = F.regexp_extract(t, r"^array<(.*)>$", 1)
    scalar = F.try_element_at(_literal_map(TYPE_SUFFIX), t)
    listed = F.concat(F.lit("list_"), F.try_element_at(_literal_map(TYPE_SUFFIX), inner))
    return F.when(t.startswith("array<"), listed).otherwise(scalar)


def type_suffix(dt: T.DataType) -> str:
    """Suffix code of a Spark type: i64 f64 bool str bytes, list_<code> for arrays."""
    if isinstance(dt, T.ArrayType):
        return "list_" + type_suffix(dt.elementType)
    name = dt.simpleString()
    if name not in TYPE_SUFFIX:
        raise ValueError(f"no type suffix for column type {name}")
    return TYPE_SUFFIX[name]


def compatible(a: T.DataType, b: T.DataType) -> bool:
    """Type equality ignoring array element nullability and names."""
    return a.simpleString() == b.simpleString()


def evolved_name(name: str, field_type: T.DataType, table_columns: dict) -> str:
    """Column a field lands in: its own name, or ``<name>__as_<suffix>`` on a type conflict."""
    existing = table_columns.get(name)
    if existing is not None and not compatible(existing, field_type):
        return f"{name}__as_{type_suffix(field_type)}"
    return name


def widen(col, dt: T.DataType) -> Column:
    """Widen a value to its table type: ints -> bigint, floats -> double, u64 wraps."""
    c = as_col(col)
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: widen(x, dt.elementType))
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("bigint")
    if isinstance(dt, T.DecimalType) and dt.scale == 0:
        # unsigned 64-bit values carried as decimal(20,0): two's-complement wrap into bigint
        wide = c.cast("decimal(21,0)")
        low = F.pmod(wide, F.lit(Decimal(2 ** 64)))
        return F.when(low >= F.lit(Decimal(2 ** 63)), (low - F.lit(Decimal(2 ** 64))).cast("bigint")).otherwise(low.cast("bigint"))
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return c.cast("double")
    return c


_DIGITS = r"^-?[0-9]+$"


def variant_value(col, dt: T.DataType) -> Column:
    """A VARIANT field as its wire type; a value that is not of that type fails the job.

    Integers are whole numbers or texts of digits (as JSON has 64-bit integers), bytes are base64 text; a JSON null is NULL.
    """
    c = as_col(col)
    if isinstance(dt, T.ArrayType):
        return F.transform(c.cast("array<variant>"), lambda x: variant_value(x, dt.elementType))
    if isinstance(dt, T.BinaryType):
        return F.unbase64(c.cast("string"))
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        text = c.cast("string")
        return F.when(text.rlike(_DIGITS) | text.isNull(), text.cast(dt)).otherwise(
            F.raise_error(F.concat(F.lit("not an integer in a payload: "), text)).cast(dt))
    return c.cast(dt)


def table_type_of(dt: T.DataType) -> T.DataType:
    """The table type a Spark input type widens to (maps and structs are unsupported)."""
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(table_type_of(dt.elementType), True)
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(dt, T.DecimalType) and dt.scale == 0:
        return T.LongType()
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    return dt


def is_supported(dt: T.DataType) -> bool:
    """Maps and nested messages (structs, also as array elements) are not table columns."""
    if isinstance(dt, T.ArrayType):
        return is_supported(dt.elementType)
    return not isinstance(dt, (T.MapType, T.StructType))


def zero_value(dt: T.DataType) -> Column:
    """The value a field reads as when it is in the writer's schema but not on the wire."""
    if isinstance(dt, T.ArrayType):
        return F.array().cast(dt)
    if isinstance(dt, T.BinaryType):
        return F.lit(bytearray()).cast(dt)
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(dt)
