"""Type lattice for text values and the mapping to catalog type names.

Every value gets a rank and a column's type is the largest rank seen, so
inference is a plain ``max`` that partially aggregates on the map side.
"""

from pyspark.sql import Column, functions as F, types as T

# White space around a value, by the rule of str.strip().
SPACES = "".join(c for c in map(chr, range(0x10000)) if c.isspace())
_STARTS = [c for c in SPACES if chr(max(ord(c) - 1, 0)) not in SPACES]
_ENDS = [c for c in SPACES if chr(ord(c) + 1) not in SPACES]
SPACE = "[" + "".join(f"\\x{{{ord(a):x}}}-\\x{{{ord(b):x}}}" for a, b in zip(_STARTS, _ENDS, strict=True)) + "]*"

# Integer and floating-point literals as int()/float() style
# parsers accept them: optional sign, digit groups joined by single underscores,
# exponent, inf/infinity/nan in any case.
DIGITS = r"[0-9]+(?:_[0-9]+)*"
INT_PATTERN = rf"^{SPACE}-?[0-9]+{SPACE}\z"
DOUBLE_PATTERN = (
    rf"(?i)^{SPACE}[+-]?(?:(?:{DIGITS}(?:\.(?:{DIGITS})?)?|\.{DIGITS})(?:e[+-]?{DIGITS})?"
    rf"|inf|infinity|nan){SPACE}\z"
)

# Most numbers are written plainly; that is found out faster.
PLAIN_INT = r"^-?[0-9]+\z"
PLAIN_DOUBLE = r"^-?[0-9]+\.[0-9]+\z"

# Ranks, narrowest first. 0-3 are integers of growing width.
INT32, INT64, INT128, INT_ANY, DOUBLE, STRING = range(6)

LABELS = ["int", "int", "int", "int", "double", "string"]
WIDE_LABELS = ["int", "bigint", "decimal(38,0)", "string", "double", "string"]
STORAGE = ["bigint", "bigint", "decimal(38,0)", "string", "double", "string"]


def text_rank(value: Column, empty_as: str = "string") -> Column:
    """Rank of a text value; null and empty text rank as string unless ignored.

    A leading letter or a colon settles most text without a regular expression,
    and a point tells which plain form to try. Widths go by length first,
    because a failing cast is slow.
    """
    first = F.ascii(value)
    letter = (first.between(ord("A"), ord("Z")) | first.between(ord("a"), ord("z"))) & ~first.isin(
        [ord(c) for c in "iInN"]
    )
    length, small = F.length(value), value.try_cast("bigint").between(-(2**31), 2**31 - 1)
    width = (
        F.when((length <= 9) | ((length <= 18) & small), INT32)
        .when((length <= 18) | value.try_cast("bigint").isNotNull(), F.when(small, INT32).otherwise(INT64))
        .when(value.try_cast("decimal(38,0)").isNotNull(), INT128)
        .otherwise(INT_ANY)
    )
    point = F.contains(value, F.lit("."))
    whole = ~point & (value.rlike(PLAIN_INT) | value.rlike(INT_PATTERN))
    broken = (point & value.rlike(PLAIN_DOUBLE)) | value.rlike(DOUBLE_PATTERN)
    rank = F.when(letter | F.contains(value, F.lit(":")), STRING).when(whole, width).when(broken, DOUBLE)
    if empty_as == "ignore":
        return F.when(value.rlike(rf"^{SPACE}\z"), None).otherwise(
            F.when(value.isNotNull(), rank.otherwise(STRING))
        )
    return rank.otherwise(STRING)


def value_rank(value: Column, data_type: T.DataType, empty_as: str = "string") -> Column:
    """Rank of a value of any Spark type.

    Typed columns need no look at the value beyond the null check.
    """
    null_rank = F.lit(None).cast("int") if empty_as == "ignore" else F.lit(STRING)

    def typed(rank: int | Column) -> Column:
        return F.when(value.isNull(), null_rank).otherwise(rank)

    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return text_rank(value, empty_as)
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType)):
        return typed(INT32)
    if isinstance(data_type, T.LongType):
        return typed(F.when(value.between(-(2**31), 2**31 - 1), INT32).otherwise(INT64))
    if isinstance(data_type, T.DecimalType):
        return typed(INT128 if data_type.scale == 0 else DOUBLE)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return typed(DOUBLE)
    return F.lit(STRING)


def _pick(rank: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.coalesce(rank, F.lit(STRING)) + 1)


def rank_label(rank: Column, widen: bool = False) -> Column:
    """Catalog label of a merged rank; a missing rank (no value) is string."""
    return _pick(rank, WIDE_LABELS if widen else LABELS)


def rank_storage(rank: Column) -> Column:
    """Spark type that holds every value of a merged rank without loss."""
    return _pick(rank, STORAGE)


def infer_type(value: Column) -> Column:
    """Label of a single text value."""
    return rank_label(text_rank(value))


def merge_types(left: Column, right: Column) -> Column:
    """Merge two labels: equal stays, int with double is double, else string."""
    numeric = left.isin("int", "double") & right.isin("int", "double")
    return F.when(left.eqNullSafe(right), left).when(numeric, "double").otherwise("string")


def parse_value(value: Column, storage: str) -> Column:
    """Convert text to its storage type, accepting every spelling the lattice accepts."""
    if storage == "string":
        return value.cast("string")
    text = value.cast("string")
    # Trimming looks every end up in a list, so values that end in visible ASCII at both sides are left alone.
    visible = F.ascii(text).between(33, 126) & F.ascii(F.right(text, F.lit(1))).between(33, 126)
    text = F.when(visible, text).otherwise(F.trim(text, F.lit(SPACES)))
    if storage != "double":
        return text.try_cast(storage)
    # The cast knows inf and nan; signed nan and digit groups need help, and a
    # bare NaN of a JSON file arrives quoted.
    marked = F.contains(text, F.lit("_")) | F.contains(text, F.lit('"'))
    plain = F.when(marked, F.translate(text, '_"', "")).otherwise(text).try_cast("double")
    signed_nan = F.when(F.lower(text).isin("+nan", "-nan"), float("nan"))
    return F.coalesce(plain, signed_nan)


def catalog_type(data_type: T.DataType, legacy: bool = False) -> str:
    """Catalog name of a Spark type.

    ``legacy`` looks for the letters "int" in the printed type, so bigint and
    array<int> both print as int.
    """
    if legacy and "int" in data_type.simpleString():
        return "int"
    if isinstance(data_type, T.LongType):
        return "bigint"
    if isinstance(data_type, T.IntegralType):
        return "int"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    return "string"


def frame_type(data_type: T.DataType, has_null: bool = False) -> str:
    """Catalog name by the dataframe-dtype rule: integers with gaps become double."""
    if isinstance(data_type, T.IntegralType):
        return "double" if has_null else "int"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "double"
    return "string"
