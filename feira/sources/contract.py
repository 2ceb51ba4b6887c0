"""What a frame's columns are, against what its table declares, before any row is written."""

from dataclasses import dataclass
from enum import StrEnum

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira import schemas

# Whole-number types by width, narrowest first, and how many digits each can have.
_INTEGERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_ORDER = list(_INTEGERS)


class Kind(StrEnum):
    """How a column differs from the one declared."""

    WIDENED = "widened"  # every value of the frame's type is one of the declared type
    NARROWED = "narrowed"  # some values of the frame's type are not
    OTHER_TYPE = "other type"  # neither holds the other's values
    MAY_BE_NULL = "may be null"  # declared as never null
    MISSING = "missing"
    RENAMED = "renamed"  # missing, where a column that is not declared stands in its place
    UNDECLARED = "undeclared"
    MOVED = "moved"  # same columns in another order


# Changes that lose no value: the frame is brought to its declared form.
HARMLESS = {Kind.WIDENED, Kind.MOVED}


@dataclass(frozen=True)
class Change:
    kind: Kind
    column: str
    detail: str = ""

    def __str__(self) -> str:
        return f"{self.column}: {self.kind}{f' ({self.detail})' if self.detail else ''}"


def holds(wide: T.DataType, narrow: T.DataType) -> bool:
    """Whether every value of ``narrow`` is one of ``wide``, exactly."""
    if wide == narrow or isinstance(narrow, T.NullType):
        return True
    if type(wide) in _INTEGERS and type(narrow) in _INTEGERS:
        return _ORDER.index(type(wide)) >= _ORDER.index(type(narrow))
    if isinstance(wide, T.DecimalType):
        whole = wide.precision - wide.scale
        if isinstance(narrow, T.DecimalType):
            return wide.scale >= narrow.scale and whole >= narrow.precision - narrow.scale
        return type(narrow) in _INTEGERS and whole >= _INTEGERS[type(narrow)]
    if isinstance(wide, T.DoubleType):
        return isinstance(narrow, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))
    if isinstance(wide, T.FloatType):
        return isinstance(narrow, (T.ByteType, T.ShortType))
    if isinstance(wide, T.ArrayType) and isinstance(narrow, T.ArrayType):
        return holds(wide.elementType, narrow.elementType) and wide.containsNull >= narrow.containsNull
    if isinstance(wide, T.StructType) and isinstance(narrow, T.StructType):
        pairs = list(zip(wide.fields, narrow.fields, strict=False))
        same = wide.names == narrow.names
        return same and all(holds(a.dataType, b.dataType) and a.nullable >= b.nullable for a, b in pairs)
    return False


def changes(frame: T.StructType, declared: T.StructType) -> list[Change]:
    """Every difference of a frame's columns from those declared, by declared order."""
    found: list[Change] = []
    own = {field.name: field for field in frame}
    known = {field.name for field in declared}
    extra = [field for field in frame if field.name not in known]
    repeated = {name for name in frame.names if frame.names.count(name) > 1}
    for place, field in enumerate(declared):
        if field.name in repeated:
            found.append(Change(Kind.OTHER_TYPE, field.name, "stands there more than once"))
            continue
        if field.name not in own:
            there = frame.fields[place] if place < len(frame.fields) else None
            if there in extra:
                extra.remove(there)
                found.append(Change(Kind.RENAMED, field.name, f"{there.name} stands in its place"))
            else:
                found.append(Change(Kind.MISSING, field.name))
            continue
        has, wants = own[field.name].dataType, field.dataType
        types = f"{has.simpleString()} for {wants.simpleString()}"
        if has != wants:
            kind = (
                Kind.WIDENED if holds(wants, has) else Kind.NARROWED if holds(has, wants) else Kind.OTHER_TYPE
            )
            if kind is Kind.OTHER_TYPE and _both_numbers(has, wants):
                kind = Kind.NARROWED
            found.append(Change(kind, field.name, types))
        if own[field.name].nullable and not field.nullable:
            found.append(Change(Kind.MAY_BE_NULL, field.name))
    found += [Change(Kind.UNDECLARED, field.name) for field in extra]
    if not found and frame.names != declared.names:
        found.append(Change(Kind.MOVED, ", ".join(frame.names)))
    return found


def _both_numbers(a: T.DataType, b: T.DataType) -> bool:
    return isinstance(a, T.NumericType) and isinstance(b, T.NumericType)


def declared_columns(layer: str, table: str) -> T.StructType | None:
    """The columns that a table of this library declares, if it is one."""
    ddl = schemas.LAYERS.get(layer, {}).get(table) or (schemas.DERIVED.get(table) if layer == "gold" else None)
    return schemas.struct(ddl) if ddl else None


def conform(df: DataFrame, declared: T.StructType, table: str) -> DataFrame:
    """``df`` with the declared columns, types and order; raises, before any row is read, if
    that could lose a value: a missing, renamed or undeclared column, a type that holds less,
    a null where there must be none."""
    found = changes(df.schema, declared)
    refused = [str(change) for change in found if change.kind not in HARMLESS]
    if refused:
        raise AnalysisException(f"{table} is not as declared: {'; '.join(refused)}")
    if not found:
        return df
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in declared])
