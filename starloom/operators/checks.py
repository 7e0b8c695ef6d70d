"""Checks on data: row-count sheets, references, rules, reconciliation, gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import local_rows


class LoadGateError(RuntimeError):
    """A condition that must hold before a load does not."""


def require(offending: DataFrame, message: str) -> None:
    """Stop unless ``offending`` is empty; reads no further than the first row."""
    if not offending.isEmpty():
        raise LoadGateError(message)


def require_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    keys = [key] if isinstance(key, str) else list(key)
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    require(repeated, f"duplicate keys in {', '.join(keys)}")


def pass_fail(left: Column, right: Column) -> Column:
    """'PASS' when equal; anything else, also NULL = NULL, is 'FAIL'."""
    return F.when(left == right, "PASS").otherwise("FAIL")


def row_count_sheet(tables: Mapping[str, DataFrame | int]) -> DataFrame:
    """One row per table: ``TableName``, ``NumberOfRows``; a count that is known stands for its table."""
    rows = [
        df.agg(F.count("*").alias("NumberOfRows")).select(
            F.lit(name).alias("TableName"), "NumberOfRows"
        )
        for name, df in tables.items() if isinstance(df, DataFrame)
    ]
    known = [(name, n) for name, n in tables.items() if not isinstance(n, DataFrame)]
    if known:
        spark = SparkSession.active()
        rows.append(local_rows(spark, known, T.StructType.fromDDL("TableName string, NumberOfRows long")))
    return reduce(DataFrame.unionByName, rows)


def _wide(tables: Mapping[str, DataFrame | int]) -> DataFrame:
    """The count of every table as one row, each table counted once."""
    sheet = row_count_sheet(tables)
    return sheet.agg(
        *[
            F.max(F.when(F.col("TableName") == name, F.col("NumberOfRows"))).alias(name)
            for name in tables
        ]
    )


def counts_match(
    tables: Mapping[str, DataFrame | int], checks: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """Compare table row counts; ``checks`` holds (label, source, target) names."""
    rows = [
        F.struct(
            F.lit(label).alias("ValidationCheck"),
            F.col(source).alias("SourceRows"),
            F.col(target).alias("TargetRows"),
            pass_fail(F.col(source), F.col(target)).alias("ValidationStatus"),
        )
        for label, source, target in checks
    ]
    return _wide(tables).select(F.inline(F.array(*rows)))


def totals_match(checks: Sequence[tuple[str, DataFrame, Column, DataFrame, Column]]) -> DataFrame:
    """Compare one aggregate of two tables per check.

    Each check is (label, warehouse frame, its aggregate, mart frame, its
    aggregate).  Aggregates over the same frame share one scan.
    """
    frames: list[tuple[DataFrame, list[tuple[str, str, Column]]]] = []
    for label, *sides in checks:
        for side, frame, value in (("w", *sides[0:2]), ("m", *sides[2:4])):
            for known, wanted in frames:
                if known is frame:
                    wanted.append((label, side, value))
                    break
            else:
                frames.append((frame, [(label, side, value)]))
    values = reduce(
        DataFrame.unionByName,
        [
            frame.agg(
                F.array(
                    *[
                        F.struct(
                            F.lit(label).alias("ValidationCheck"),
                            F.lit(side).alias("side"),
                            value.cast("bigint").alias("value"),
                        )
                        for label, side, value in wanted
                    ]
                ).alias("r")
            ).select(F.inline("r"))
            for frame, wanted in frames
        ],
    )
    paired = values.groupBy("ValidationCheck").agg(
        F.max(F.when(F.col("side") == "w", F.col("value"))).alias("WarehouseValue"),
        F.max(F.when(F.col("side") == "m", F.col("value"))).alias("DataMartValue"),
    )
    return paired.withColumn(
        "ValidationStatus", pass_fail(F.col("WarehouseValue"), F.col("DataMartValue"))
    )


def orphan_count(
    fact: DataFrame, column: str, dim: DataFrame, dim_column: str, name: str = "InvalidRows"
) -> DataFrame:
    """One row: fact rows whose ``column`` the dimension lacks (NULL included).

    The fact is counted per value before anything moves, so a value that fills
    a third of the table travels as one row per map task.
    """
    per_value = fact.groupBy(F.col(column).alias("_v")).agg(F.count("*").alias("_n"))
    missing = per_value.join(dim.select(F.col(dim_column).alias("_v")), "_v", "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(name))


@dataclass(frozen=True)
class Reference:
    """A fact column that must exist in a dimension."""

    label: str
    column: str
    dim: DataFrame
    dim_column: str


def _text(value: object) -> str:
    """A value as an SQL literal."""
    if isinstance(value, (bool, int, Decimal)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


#: rules whose broken ones stand as bits in one number
_MASK = 60


def _checked(
    df: DataFrame,
    row_rules: Sequence[tuple[str, str]],
    unique: Sequence[str],
    references: Sequence[Reference],
) -> DataFrame:
    """``ValidationCheck``, ``InvalidRows`` per check, in one scan of ``df`` and one exchange.

    A row becomes one (check, value, count) for each unique column, each reference and
    each ``_MASK`` rules, of which the value has a bit for every broken one.  These are
    summed in the task, so rules or a small dimension leave a few rows of it, and then
    meet the keys of all dimensions in one exchange: a reference is broken where no key
    came, a unique value surplus beyond the first.  Values are numbers if all of these
    columns are whole numbers, else text.  ``row_rules`` are (name, SQL that holds for a broken row).
    """
    columns = [df.schema[c].dataType for c in [*unique, *(r.column for r in references)]]
    columns += [r.dim.schema[r.dim_column].dataType for r in references]
    kind = "BIGINT" if all(isinstance(c, T.IntegralType) for c in columns) else "STRING"

    def tagged(tag: int, value: str, n: str) -> str:
        return f"named_struct('_tag', {tag}, '_v', CAST({value} AS {kind}), '_n', CAST({n} AS BIGINT))"

    masks = [row_rules[i : i + _MASK] for i in range(0, len(row_rules), _MASK)]
    labels = [*range(len(masks)), *unique, *references]
    uniques = range(len(masks), len(masks) + len(unique))
    refs = range(len(masks) + len(unique), len(labels))
    rows = [
        *[tagged(i, " + ".join(f"IF({broken}, {1 << bit}L, 0L)" for bit, (_, broken) in enumerate(some)), "1")
          for i, some in enumerate(masks)],
        *[tagged(i, f"`{labels[i]}`", f"IF(`{labels[i]}` IS NULL, 0, 1)") for i in uniques],
        *[tagged(i, f"`{labels[i].column}`", "1") for i in refs],
    ]
    met = df.selectExpr(f"inline(array({', '.join(rows)}))", "0 AS _known").where("_n > 0")
    # references to one column share its keys
    keys: dict[tuple[int, str], tuple[DataFrame, list[int]]] = {}
    for i in refs:
        keys.setdefault((id(labels[i].dim), labels[i].dim_column), (labels[i].dim, []))[1].append(i)
    for (_, column), (dim, tags) in keys.items():
        met = met.union(dim.where(f"`{column}` IS NOT NULL").selectExpr(
            f"explode(array({', '.join(map(str, tags))})) AS _tag", f"CAST(`{column}` AS {kind}) AS _v",
            "CAST(0 AS BIGINT) AS _n", "1 AS _known"))
    per_value = met.groupBy("_tag", "_v").agg(F.sum("_n").alias("_n"), F.max("_known").alias("_known"))
    invalid = [
        *[(name, i, f"IF(TRY_CAST(_v AS BIGINT) & {1 << bit}L = 0, 0, _n)")
          for i, some in enumerate(masks) for bit, (name, _) in enumerate(some)],
        *[(f"{labels[i]} unique", i, "_n - 1") for i in uniques],
        *[(labels[i].label, i, "IF(_known = 0, _n, 0)") for i in refs],
    ]
    counted = per_value.agg(*[
        F.expr(f"sum(IF(_tag = {tag}, {n}, 0)) AS _c{i}") for i, (_, tag, n) in enumerate(invalid)])
    found = [
        f"named_struct('ValidationCheck', {_text(name)}, 'InvalidRows', coalesce(_c{i}, CAST(0 AS BIGINT)))"
        for i, (name, _, _) in enumerate(invalid)
    ]
    return counted.selectExpr(f"inline(array({', '.join(found)}))")


def broken_references(fact: DataFrame, references: Sequence[Reference]) -> DataFrame:
    """``ValidationCheck``, ``InvalidRows`` per reference, in one scan of the fact and one exchange.

    NULL is in no dimension.
    """
    return _checked(fact, (), (), references)


def check_rules(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    allowed: Mapping[str, Sequence[object]] | None = None,
    at_least: Mapping[str, object] | None = None,
    references: Sequence[Reference] = (),
    table: str = "",
) -> DataFrame:
    """Table rules checked as data: ``Rule``, ``Violations``, ``Status``.

    All of it is one scan and one exchange.  NULL passes ``allowed`` and ``at_least``, as
    it would a CHECK constraint; ``unique`` counts surplus rows.
    """
    prefix = f"{table}: " if table else ""
    row_rules = [(f"{c} not null", f"`{c}` IS NULL") for c in not_null]
    row_rules += [(f"{c} in list", f"`{c}` NOT IN ({', '.join(map(_text, v))})") for c, v in (allowed or {}).items()]
    row_rules += [(f"{c} >= {v}", f"`{c}` < {_text(v)}") for c, v in (at_least or {}).items()]
    report = _checked(df, row_rules, unique, references)
    return report.select(
        F.concat(F.lit(prefix), "ValidationCheck").alias("Rule"),
        F.col("InvalidRows").alias("Violations"),
        F.when(F.col("InvalidRows") == 0, "PASS").otherwise("FAIL").alias("Status"),
    )
