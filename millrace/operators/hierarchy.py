"""Drill-down sums over an ordered list of columns: the long form, and one JSON document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import number_text
from millrace.operators.sequence import with_position
from millrace.staging import Staging

# The wrapper object around each list of children.
ROOT_NAME = "root"
ROOT_VALUE = "0"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def hierarchy_totals(
    df: DataFrame, headers: list[str], value: str, staging: Staging | None = None
) -> DataFrame:
    """One row per tree node: ``level`` (0 = everything), the headers down to it, and the sum.

    Rows with a null header count in every node above that header and form no node of their own.
    Null and NaN values are skipped; a group without values sums to 0. Rows are folded to the deepest level
    first, so the levels above are summed from groups rather than rows. With ``staging`` the
    groups are stored once and the deepest level is not shuffled again, which suits a deepest
    header with very many values.
    """
    if {"level", "value"} & set(headers):
        raise ValueError("headers named level or value would clash with the result's columns")
    number = _c(value)
    if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
        number = F.when(~F.isnan(number), number)
    total = F.coalesce(F.sum(number), F.lit(0))
    folded = df.groupBy(*[_c(h) for h in headers]).agg(total.alias("value"))
    value_type = folded.schema["value"].dataType
    again = F.coalesce(F.sum("value"), F.lit(0)).cast(value_type).alias("value")
    if staging is None:
        depth = sum((F.lit(1) - F.grouping(h) for h in headers), F.lit(0))
        nodes = folded.rollup(*headers).agg(depth.cast("int").alias("level"), again)
        whole = reduce(lambda a, b: a & b, [(F.col("level") <= i) | _c(h).isNotNull() for i, h in enumerate(headers)])
        return nodes.filter(whole).select("level", *[_c(h) for h in headers], "value")

    stored = staging.write(folded, "folded")
    parts = []
    for level in range(len(headers) + 1):
        nodes = stored
        if level < len(headers):
            nodes = stored.groupBy(*[_c(h) for h in headers[:level]]).agg(again)
        shown = [
            _c(h) if i < level else F.lit(None).cast(df.schema[h].dataType).alias(h)
            for i, h in enumerate(headers)
        ]
        named = nodes.dropna(subset=[f"`{h}`" for h in headers[:level]]) if level else nodes
        parts.append(named.select(F.lit(level).alias("level"), *shown, "value"))
    return reduce(DataFrame.unionByName, parts)


def _json_text(value: Column) -> Column:
    """A JSON string literal of ``value``, quotes included."""
    return F.regexp_extract(F.to_json(F.struct(value.cast("string").alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)


def hierarchy_document(df: DataFrame, headers: list[str], value: str, staging: Staging) -> DataFrame:
    """The tree as ordered fragments ``(position, fragment)`` whose concatenation is the document.

    Sorting the nodes by their headers, nulls first, is a walk down the tree. A fragment is its
    node's opening text plus whatever closes before the next node, and the next node's level says
    what that is. No node's children are ever gathered, so the tree may be of any size.
    """
    totals = staging.write(hierarchy_totals(df, headers, value, staging), "totals")
    value_type = totals.schema["value"].dataType
    depth = len(headers)
    walk = with_position(totals, headers, staging, ahead="level", unique=True)

    start = '{"header":"%s","field_name":"%s","value":' % (ROOT_NAME, ROOT_NAME)
    text = F.concat(F.lit('"'), number_text("value", value_type), F.lit('"'))
    opening = F.when(F.col("level") == 0, F.concat(F.lit(start), text, F.lit(',"children":[')))
    for level, name in enumerate(headers, 1):
        inner = "[]}" if level == depth else f'{start}"{ROOT_VALUE}","children":['
        opening = opening.when(
            F.col("level") == level,
            F.concat(
                F.lit('{"header":'),
                _json_text(F.lit(name)),
                F.lit(',"field_name":'),
                _json_text(_c(name)),
                F.lit(',"value":'),
                text,
                F.lit(',"children":' + inner),
            ),
        )
    # levels from the next node's (1 at the end) to this one's are finished; the deepest needs no close
    upper = F.least(F.col("level"), F.lit(depth - 1))
    lower = F.coalesce(F.col("next_level"), F.lit(1))
    closing = F.repeat(F.lit("]}}"), F.greatest(upper - lower + 1, F.lit(0)))
    after = (
        F.when(F.col("next_level").isNull(), F.concat(closing, F.lit("]}")))
        .when(F.col("next_level") > F.col("level"), F.lit(""))
        .otherwise(F.concat(closing, F.lit(",")))
    )
    return walk.select("position", F.concat(opening, after).alias("fragment"))


def write_document(fragments: DataFrame, path: str) -> None:
    """Write the fragments in order; the part files, read in name order, are one JSON document."""
    ordered = fragments.repartitionByRange("position").sortWithinPartitions("position")
    ordered.select("fragment").write.mode("overwrite").text(path)
