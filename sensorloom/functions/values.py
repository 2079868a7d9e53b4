"""Value expressions: safe parsing, range checks, rounding, labels, nested JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# a decimal literal, optionally with single underscores between digits
_NUMBER = r"^\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"


def to_number(c: Column, text: bool = False) -> Column:
    """Double, or null when missing, unreadable, NaN or infinite.

    With ``text=True`` only decimal literals are read, so that Java's ``12d`` and hex floats are refused.
    """
    if text:
        c = F.when(c.rlike(_NUMBER), F.regexp_replace(F.trim(c), "_", ""))
    x = c.try_cast("double")
    return F.when(F.abs(x) < float("inf"), x)  # NaN is above infinity


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def in_range(c: Column, low: float | None, high: float | None) -> Column:
    """The value when inside the inclusive range, else null; an open bound is not checked."""
    tests = []
    if low is not None:
        tests.append(c >= F.lit(float(low)))
    if high is not None:
        tests.append(c <= F.lit(float(high)))
    return F.when(reduce(lambda a, b: a & b, tests), c) if tests else c


def round_columns(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round the named double columns in place, by their exact binary value, halves to even.

    2.675 -> 2.67 and 0.125 -> 0.12, as a correctly rounding decimal conversion does. ``rint`` of the scaled
    value is right unless the rounded product falls on a half; there the exact error of the product (Dekker
    1971) tells the side. Each step is its own projection over values that are never null: written as one
    expression the generated code grows past what the JVM compiles, and runs many times slower.
    """
    scale = {c: F.lit(float(10**n)) for c, n in digits.items()}

    def part(step: str, c: str) -> Column:
        return F.col(f"_{step}_{c}")

    def step(name: str, of) -> dict[str, Column]:
        return {f"_{name}_{c}": of(c) for c in digits}

    out = df.withColumns(step("x", lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))))
    out = out.withColumns(
        step("product", lambda c: part("x", c) * scale[c])
        | step("spread", lambda c: part("x", c) * F.lit(134217729.0))  # 2**27 + 1
    )
    out = out.withColumns(
        step("high", lambda c: part("spread", c) - (part("spread", c) - part("x", c)))
        | step("near", lambda c: F.rint(part("product", c)))
    )
    out = out.withColumns(
        step(
            "error",
            lambda c: (part("high", c) * scale[c] - part("product", c)) + (part("x", c) - part("high", c)) * scale[c],
        )
    )

    def rounded(c: str) -> Column:
        product, near, error = part("product", c), part("near", c), part("error", c)
        half = (F.abs(product - near) == F.lit(0.5)) & (error != 0)
        units = F.when(half, product + F.signum(error) * F.lit(0.5)).otherwise(near)
        # adding zero turns minus zero into zero; from 2**52 on there are no decimals left
        whole = F.when(F.abs(product) < F.lit(2.0**52), units / scale[c] + F.lit(0.0)).otherwise(part("x", c))
        return F.when(F.col(c).isNotNull(), whole)

    return out.withColumns({c: rounded(c) for c in digits}).select(*df.columns)


def clean_columns(
    df: DataFrame, ranges: dict[str, tuple[float | None, float | None]], text: bool = False, digits: int = 2
) -> DataFrame:
    """Parse, check the inclusive range and round the named columns in place; anything unusable is null.

    Each step is its own projection, so no step is computed twice.
    """
    def read(c: str, low, high) -> Column:
        closed = low is not None and high is not None and not text
        # a closed range lets neither NaN nor infinity through
        return F.col(c).try_cast("double") if closed else to_number(F.col(c), text)

    out = df.withColumns({c: read(c, low, high) for c, (low, high) in ranges.items()})
    out = out.withColumns({c: in_range(F.col(c), low, high) for c, (low, high) in ranges.items()})
    return round_columns(out, dict.fromkeys(ranges, digits))


def number_text(c: Column) -> Column:
    """Shortest text that reads back as the same number: whole values without a decimal point, the rest plain up to 1e7 and
    with an exponent beyond."""
    whole = (c == F.floor(c)) & (F.abs(c) < F.lit(1e15))
    special = F.when(F.isnan(c), "NaN").when(c == F.lit(float("inf")), "Inf").when(c == F.lit(float("-inf")), "-Inf")
    exact = F.coalesce(special, c.cast("string"))
    return F.when(whole, c.cast("bigint").cast("string")).otherwise(exact)


def zero_if_missing(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def scale(c: Column, factor: float) -> Column:
    return c * F.lit(float(factor))


def argmax_name(columns: dict[str, Column]) -> Column:
    """Name of the largest column; on a tie the first in the given order."""
    top = F.greatest(*columns.values()) if len(columns) > 1 else next(iter(columns.values()))
    pick = None
    for name, c in columns.items():
        pick = F.when(c == top, name) if pick is None else pick.when(c == top, name)
    return pick


def map_code(c: Column, mapping: dict) -> Column:
    """Look a code up in a small fixed mapping; an unknown code gives null."""
    table = F.create_map(*[F.lit(v) for pair in mapping.items() for v in pair])
    return F.try_element_at(table, c)


def map_label(c: Column, mapping: dict[int, str], prefix: str) -> Column:
    """Label of a code, or ``prefix`` followed by the code when it has none."""
    return F.coalesce(map_code(c, mapping), F.concat(F.lit(prefix), c.cast("string")))


def clamp_min(c: Column, floor: float) -> Column:
    return F.greatest(F.lit(float(floor)), c)


def label_if(condition: Column, yes: str, no: str) -> Column:
    return F.when(condition, yes).otherwise(no)


def flag_eq(c: Column, value) -> Column:
    return c == F.lit(value)


def residual(y: Column, yhat: Column) -> Column:
    return y - yhat


def relative_residual(y: Column, yhat: Column) -> Column:
    """``|y - yhat| / |y|``; null where ``y`` is zero."""
    return F.when(y != 0, F.abs((y - yhat) / y))


def json_get(c: Column, path: str, default=None) -> Column:
    """Field of a nested struct by dotted path, with a default for a missing value."""
    value = reduce(lambda col, field: col.getField(field), path.split("."), c)
    return value if default is None else F.coalesce(value, F.lit(default))


def _json_string(c: Column) -> Column:
    listed = F.to_json(F.array(F.coalesce(c, F.lit(""))))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def struct_array_json(c: Column, fields: dict[str, str]) -> Column:
    """Array of structs as JSON text, fields renamed ``{source: target}``; an empty array gives "".

    Separators carry a blank (``", "`` and ``": "``) and non-ASCII characters stay as they are.
    """

    def one(item: Column) -> Column:
        parts = []
        for i, (source, target) in enumerate(fields.items()):
            parts += [F.lit(("" if i == 0 else ", ") + f'"{target}": '), _json_string(item.getField(source))]
        return F.concat(F.lit("{"), *parts, F.lit("}"))

    text = F.concat(F.lit("["), F.array_join(F.transform(c, one), ", "), F.lit("]"))
    return F.when(F.size(c) > 0, text).otherwise(F.lit(""))
