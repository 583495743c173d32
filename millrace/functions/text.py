"""Column expressions: padded ids, run dates, checksums, zipped maps, number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Widths of the two halves of a sequence id.
RUN_DIGITS = 20
ROW_DIGITS = 12


def _column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def run_digits(run_date: Column | str) -> Column:
    """The digits of a run date: ``2021-08-07T02:00:00+00:00`` gives ``202108070200000000``."""
    return F.regexp_replace(_column(run_date), "[^0-9]", "")


def run_hour(run_date: Column | str) -> Column:
    """The run date cut to its hour as written; a zone offset in the text is not applied."""
    parts = F.split(_column(run_date), "[-T: ]")
    year, month, day, hour = (parts[i].cast("int") for i in range(4))
    return F.make_timestamp_ntz(year, month, day, hour, F.lit(0), F.lit(0)).cast("timestamp")


def sequence_id(digits: Column | str, position: Column | str, row_digits: int = ROW_DIGITS) -> Column:
    """Sortable id: run digits padded right to 20, then the row position padded left to ``row_digits``.

    The caller sees to it that no position has more digits.
    """
    return F.concat(
        F.rpad(_column(digits), RUN_DIGITS, "0"),
        F.lpad(_column(position).cast("string"), row_digits, "0"),
    )


def record_checksum(columns: list[str], delimiter: str = "", null_text: str | None = None) -> Column:
    """MD5 hex over the joined text of ``columns``, in the order given.

    With the defaults a null in any column makes the checksum null, and ``('ab','c')`` equals
    ``('a','bc')``; ``null_text`` and ``delimiter`` remove those two properties.
    """
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    if null_text is not None:
        texts = [F.coalesce(t, F.lit(null_text)) for t in texts]
    if delimiter:
        joined = []
        for text in texts:
            joined += [text, F.lit(delimiter)]
        texts = joined[:-1]
    return F.md5(F.concat(*texts))


def zipped_map(keys: Column | str, values: Column | str, separator: str = "|") -> Column:
    """Pair two separated lists into a map.

    The longer side is cut to the shorter; the last value of a repeated key wins.
    """
    pattern = "\\Q" + separator + "\\E"
    left, right = F.split(_column(keys), pattern), F.split(_column(values), pattern)
    pairs = F.slice(F.arrays_zip(left.alias("k"), right.alias("v")), 1, F.least(F.size(left), F.size(right)))
    names = F.transform(pairs, lambda p: p["k"])
    # keep a pair only where no later pair has the same key, so no dedup setting is needed
    last = F.filter(
        pairs,
        lambda p, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), p["k"]),
    )
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["k"].alias("key"), p["v"].alias("value"))))


def _double_text(value: Column) -> Column:
    """Shortest decimal text, plain from 1e-4 up to 1e16 and scientific (``1.5e-05``) outside.

    Before Java 19 a value from 1e16 on may show a digit more than needed.
    """
    shortest = value.cast("string")
    size = F.abs(value)
    decimal = shortest.cast("decimal(38,21)").cast("string")
    plain = F.regexp_replace(decimal, r"(\.\d+?)0+$", "$1")
    # Java before 19 may print digits too many; take the shortest text that reads back as the value. Texts of up
    # to 15 digits are the shortest as they are; where the E stands tells how many digits there can be.
    place = F.instr(shortest, "E")
    tries = [(digits, F.format_string(f"%.{digits - 1}E", value)) for digits in (15, 16, 17)]
    digits = F.coalesce(*[F.when(place > n + 2, F.when(t.cast("double") == value, t)) for n, t in tries], shortest)
    sign = F.when(size >= 1, F.lit("e+")).when(size >= 1e-9, F.lit("e-0")).otherwise(F.lit("e-"))
    # one replacement: Java compiles no method of more than 8,000 bytes, and Spark makes one method of all columns
    scientific = F.regexp_replace(digits, F.lit(r"\.?0*E[+-]?0?"), sign)
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(value == float("inf"), F.lit("inf"))
        .when(value == float("-inf"), F.lit("-inf"))
        .when(~F.contains(shortest, F.lit("E")), shortest)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def number_text(value: Column | str, data_type: T.DataType) -> Column:
    """A number as text: ``10`` for whole types, ``10.0`` for floating ones."""
    column = _column(value)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return _double_text(column.cast("double"))
    return column.cast("string")
