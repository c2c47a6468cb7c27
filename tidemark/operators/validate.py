"""Schema checks at plan time, and row checks inside the plan."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SchemaError
from tidemark.functions.types import castable, is_timestamp, same_type
from tidemark.model import CREATED_TS, EVENT_TS, FeatureTable, Field
from tidemark.plans.skew import SkewOptions, salted_join

VALID = "_is_valid"
FAILED = "_failed_checks"


# ---------------------------------------------------------------- schema, before any job


def check_timestamp(df: DataFrame, column: str, what: str) -> None:
    if column not in df.columns:
        raise SchemaError(f"{what}: time column {column!r} is missing, have {df.columns}")
    dtype = df.schema[column].dataType
    if not is_timestamp(dtype):
        raise SchemaError(f"{what}: {column!r} must be a timestamp, is {dtype.simpleString()}")


def check_fields(df: DataFrame, fields: Iterable[Field], what: str, *, allow_cast: bool = False) -> None:
    """Every declared field is present with exactly its declared type."""
    for declared in fields:
        if declared.name not in df.columns:
            raise SchemaError(f"{what}: column {declared.name!r} is missing, have {df.columns}")
        actual = df.schema[declared.name].dataType
        if same_type(declared.spark_type, actual):
            continue
        if allow_cast and castable(actual, declared.spark_type):
            continue
        raise SchemaError(
            f"{what}: column {declared.name!r} is declared {declared.spark_type.simpleString()}"
            f" but is {actual.simpleString()}"
        )


def check_spine(spine: DataFrame, spine_ts: str, table: FeatureTable) -> None:
    """The spine has the event time and every key of the table, with the right types."""
    check_timestamp(spine, spine_ts, "entity frame")
    check_fields(spine, table.entities, f"entity frame for {table.name}")


def check_table_frame(df: DataFrame, table: FeatureTable, *, created: bool = False) -> None:
    """A projected frame holds what the table declares (first mismatch is reported)."""
    check_fields(df, [*table.entities, *table.features], table.name)
    check_timestamp(df, EVENT_TS, table.name)
    if created:
        check_timestamp(df, CREATED_TS, table.name)


# ------------------------------------------------------------------------- row validity


def entities_valid(table: FeatureTable, event_ts: str = EVENT_TS) -> Column:
    """All keys and the event time are present."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*table.keys, event_ts]])


def any_feature_present(table: FeatureTable) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f).isNotNull() for f in table.feature_names])


def row_checks(
    table: FeatureTable, *, need_feature: bool = False, event_ts: str = EVENT_TS
) -> dict[str, Column]:
    """Named structural checks; each column is true for a good row."""
    keys = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in table.keys])
    checks = {"entity_null": keys, "event_timestamp_null": F.col(event_ts).isNotNull()}
    if need_feature:
        checks["no_feature"] = any_feature_present(table)
    return checks


# -------------------------------------------------------------------- expectation suites


@dataclass(frozen=True)
class Expectation:
    """One named expectation. Build them with the helpers below."""

    kind: str
    kwargs: Mapping[str, object] = field(default_factory=dict)

    @property
    def name(self) -> str:
        """The expectation as a call, `kind(column, min_value=0)`: different arguments, lists
        included, give different names."""
        given = {k: v for k, v in self.kwargs.items() if v is not None}
        column = [str(given.pop("column"))] if "column" in given else []
        return f"{self.kind}({', '.join(column + [f'{k}={_shown(v)}' for k, v in sorted(given.items())])})"

    @property
    def is_row_level(self) -> bool:
        return self.kind in _ROW_RULES or self.kind in _SHARED_RULES

    @property
    def shared_columns(self) -> tuple[str, ...]:
        """The columns whose values a rule over other rows compares; none for other rules."""
        if self.kind not in _SHARED_RULES:
            return ()
        return tuple(self.kwargs["column_list"]) if "column_list" in self.kwargs else (self.kwargs["column"],)

    def without_prefix(self, prefix: str) -> Expectation:
        """Columns named as retrieval outputs (`table__feature`) become plain features."""
        kwargs = {
            k: v.removeprefix(prefix)
            if k in ("column", "column_A", "column_B") and isinstance(v, str)
            else tuple(c.removeprefix(prefix) for c in v)
            if k == "column_list"
            else v
            for k, v in self.kwargs.items()
        }
        return replace(self, kwargs=kwargs)

    def predicate(self) -> Column:
        """True where a row meets the expectation. Nulls pass value checks."""
        return F.coalesce(_ROW_RULES[self.kind](self.kwargs), F.lit(True))

    def observed(self) -> Column:
        """The frame-level value this expectation looks at (an aggregate)."""
        return _FRAME_VALUES[self.kind](self.kwargs)


def _shown(value: object) -> str:
    if isinstance(value, (list, tuple, set, frozenset)):
        return f"[{', '.join(map(str, sorted(value, key=str)))}]"
    return str(value)


def _between(value: Column, kw: Mapping) -> Column:
    low, high = kw.get("min_value"), kw.get("max_value")
    inside = F.lit(True)
    if low is not None:
        inside = inside & (value > low if kw.get("strict_min") else value >= low)
    if high is not None:
        inside = inside & (value < high if kw.get("strict_max") else value <= high)
    return F.when(value.isNotNull(), inside)


def _pair_greater(kw: Mapping) -> Column:
    a, b = F.col(kw["column_A"]), F.col(kw["column_B"])
    return a >= b if kw.get("or_equal") else a > b


_ROW_RULES: dict[str, Callable[[Mapping], Column]] = {
    "expect_column_values_to_be_between": lambda kw: _between(F.col(kw["column"]), kw),
    "expect_column_values_to_be_in_set": lambda kw: F.col(kw["column"]).isin(list(kw["value_set"])),
    "expect_column_values_to_not_be_in_set": lambda kw: ~F.col(kw["column"]).isin(
        list(kw["value_set"])
    ),
    "expect_column_values_to_not_be_null": lambda kw: F.col(kw["column"]).isNotNull(),
    "expect_column_values_to_be_null": lambda kw: F.col(kw["column"]).isNull(),
    "expect_column_values_to_match_regex": lambda kw: F.col(kw["column"]).rlike(kw["regex"]),
    "expect_column_value_lengths_to_be_between": lambda kw: _between(F.length(kw["column"]), kw),
    "expect_column_pair_values_A_to_be_greater_than_B": _pair_greater,
}

# Rules over other rows: from the number of rows with a row's values, and the number of rows that
# have values there.
_SHARED_RULES: dict[str, Callable[[Column, Callable[[], Column], Mapping], Column]] = {
    "expect_column_values_to_be_unique": lambda same, total, kw: same == 1,
    "expect_compound_columns_to_be_unique": lambda same, total, kw: same == 1,
    "expect_column_value_shares_to_be_between": lambda same, total, kw: _between(same / total(), kw),
}

_FRAME_VALUES: dict[str, Callable[[Mapping], Column]] = {
    "expect_column_mean_to_be_between": lambda kw: F.avg(kw["column"]),
    "expect_column_min_to_be_between": lambda kw: F.min(kw["column"]),
    "expect_column_max_to_be_between": lambda kw: F.max(kw["column"]),
    "expect_column_sum_to_be_between": lambda kw: F.sum(kw["column"]),
    "expect_column_stdev_to_be_between": lambda kw: F.stddev(kw["column"]),
    "expect_column_unique_value_count_to_be_between": lambda kw: F.count_distinct(kw["column"]),
    "expect_column_proportion_of_unique_values_to_be_between": lambda kw: F.count_distinct(
        kw["column"]
    )
    / F.count(kw["column"]),
    "expect_table_row_count_to_be_between": lambda kw: F.count(F.lit(1)),
}


def expect(kind: str, column: str | None = None, **kwargs) -> Expectation:
    """An expectation by name, e.g. `expect("expect_column_mean_to_be_between", "x", max_value=3)`."""
    if kind not in _ROW_RULES and kind not in _SHARED_RULES and kind not in _FRAME_VALUES:
        raise SchemaError(f"unknown expectation {kind!r}")
    head = {} if column is None else {"column": column}
    return Expectation(kind, {**head, **kwargs})


def expect_between(column: str, min_value=None, max_value=None) -> Expectation:
    return expect(
        "expect_column_values_to_be_between", column, min_value=min_value, max_value=max_value
    )


def expect_in_set(column: str, value_set: Sequence) -> Expectation:
    return expect("expect_column_values_to_be_in_set", column, value_set=tuple(value_set))


@dataclass(frozen=True)
class Suite:
    """Expectations plus, where rules cannot say it, a user function over pandas batches.

    The function takes a DataFrame of all columns and returns a boolean Series. It runs as
    an Arrow-batched pandas UDF.
    """

    expectations: tuple[Expectation, ...] = ()
    function: Callable[[pd.DataFrame], pd.Series] | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "expectations", tuple(self.expectations))

    @staticmethod
    def from_dicts(items: Iterable[Mapping]) -> Suite:
        """From `[{"expectation_type": ..., "kwargs": {...}}, ...]`."""
        return Suite(
            tuple(expect(i["expectation_type"], **i.get("kwargs", {})) for i in items)
        )

    def for_table(self, table: FeatureTable) -> Suite:
        prefix = f"{table.name}__"
        return replace(
            self, expectations=tuple(e.without_prefix(prefix) for e in self.expectations)
        )

    def with_facts(self, df: DataFrame, skew: SkewOptions | None = SkewOptions()) -> tuple[DataFrame, dict[tuple, Column]]:
        """The frame with what rules over other rows need, one column for each set of columns that
        they compare: how many rows have a row's values. Rows with a null there have null.

        Values are counted before the shuffle, and the counts are joined back with the rows of
        very common values spread over salts.
        """
        names, facts = df.columns, {}
        for e in self.expectations:
            columns = e.shared_columns
            if not columns or columns in facts or any(c not in names for c in columns):
                continue
            if df.isStreaming:
                raise SchemaError(f"{e.name} looks at all rows, which a stream does not have")
            fact = f"__tm_fact{len(facts)}"
            counts = df.na.drop(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias(fact))
            kept = [*names, *[f"__tm_fact{i}" for i in range(len(facts) + 1)]]
            facts[columns] = F.col(fact)
            df = salted_join(df, counts, columns, "left", skew).select(*[F.col(f"`{c}`") for c in kept])
        return df, facts

    def usable_checks(
        self, df: DataFrame, facts: Mapping[tuple, Column] | None = None, base: DataFrame | None = None
    ) -> tuple[dict[str, Column], list[str]]:
        """Row checks that resolve on this frame, and the names of those that do not.

        A check that cannot be evaluated is skipped and reported, not fatal. Rules over other rows
        need the `facts` that `with_facts` adds, and `base`, the frame without them.
        """
        usable, skipped = {}, []
        for e in self.expectations:
            if not e.is_row_level:
                continue
            try:
                predicate = e.predicate() if not e.shared_columns else _shared(df if base is None else base, e, (facts or {})[e.shared_columns])
                df.select(predicate)
            except (AnalysisException, KeyError):
                skipped.append(e.name)
            else:
                usable[e.name] = predicate
        if self.function is not None:
            usable[getattr(self.function, "__name__", "function")] = _run_function(df, self.function)
        return usable, skipped


def _shared(df: DataFrame, e: Expectation, same: Column) -> Column:
    def total() -> Column:
        """How many rows have values there, by a small job over these columns."""
        return F.lit(df.select(*e.shared_columns).na.drop().count())

    return F.coalesce(_SHARED_RULES[e.kind](same, total, e.kwargs), F.lit(True))


def _run_function(df: DataFrame, function: Callable[[pd.DataFrame], pd.Series]) -> Column:
    @F.pandas_udf(T.BooleanType())
    def validity(rows: pd.DataFrame) -> pd.Series:
        return function(rows)

    # A null answer counts as invalid.
    return F.coalesce(validity(F.struct(*[F.col(f"`{c}`") for c in df.columns])), F.lit(False))


def with_validity(
    df: DataFrame,
    table: FeatureTable,
    suite: Suite | None = None,
    *,
    need_feature: bool = False,
    extra_checks: Mapping[str, Column] | None = None,
    strict: bool = False,
    skipped: list[str] | None = None,
) -> DataFrame:
    """Add `_failed_checks` (names of all checks a row fails) and `_is_valid`.

    Checks that do not resolve on this frame (a misspelled column) are skipped; their names
    are added to `skipped`, and with `strict` they raise instead.
    """
    checks = dict(extra_checks or {})
    checks.update(row_checks(table, need_feature=need_feature))
    names, base = df.columns, df
    if suite is not None:
        suite = suite.for_table(table)
        df, facts = suite.with_facts(base)
        usable, missed = suite.usable_checks(df, facts, base)
        if missed and strict:
            raise SchemaError(f"{table.name}: checks can not be evaluated: {missed}")
        if skipped is not None:
            skipped += missed
        checks.update(usable)
    failed = F.array_compact(
        F.array(*[F.when(~F.coalesce(good, F.lit(False)), F.lit(n)) for n, good in checks.items()])
    )
    checked = df.withColumn(FAILED, failed).withColumn(VALID, F.size(FAILED) == 0)
    return checked.select(*[F.col(f"`{c}`") for c in [*names, FAILED, VALID]])


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the check columns, invalid rows with their reasons)."""
    valid = checked.filter(F.col(VALID)).drop(VALID, FAILED)
    invalid = checked.filter(~F.col(VALID)).drop(VALID)
    return valid, invalid


def check_report(df: DataFrame, suite: Suite) -> DataFrame:
    """Failing rows per row-level check: (check_name, failed). One pass over the data, and one more
    for each set of columns that rules over other rows compare."""
    base = df
    df, facts = suite.with_facts(base)
    checks, _ = suite.usable_checks(df, facts, base)
    if not checks:
        return df.sparkSession.createDataFrame([], "check_name string, failed long")
    counts = [F.count_if(~good).alias(f"c{i}") for i, good in enumerate(checks.values())]
    pairs = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("failed"))
        for i, name in enumerate(checks)
    ]
    return df.agg(*counts).select(F.inline(F.array(*pairs)))


def observed_report(df: DataFrame, suite: Suite) -> DataFrame:
    """Frame-level checks: (check_name, observed_value, success, reported_value).

    `reported_value` is the observed value times 100 as an integer for a failing check and
    0 for a passing one. Checks that cannot be evaluated are left out.
    """
    checks = []
    for e in suite.expectations:
        if e.is_row_level:
            continue
        try:
            value = e.observed().cast("double")
            df.agg(value)
        except (AnalysisException, KeyError):
            continue
        checks.append((e, value))
    schema = "check_name string, observed_value double, success boolean, reported_value long"
    if not checks:
        return df.sparkSession.createDataFrame([], schema)
    values = [value.alias(f"o{i}") for i, (_, value) in enumerate(checks)]
    rows = []
    for i, (e, _) in enumerate(checks):
        seen = F.col(f"o{i}")
        success = F.coalesce(_between(seen, e.kwargs), F.lit(True))
        reported = F.when(success, F.lit(0)).otherwise(seen * 100).cast("long")
        rows.append(
            F.struct(
                F.lit(e.name).alias("check_name"),
                seen.alias("observed_value"),
                success.alias("success"),
                reported.alias("reported_value"),
            )
        )
    return df.agg(*values).select(F.inline(F.array(*rows)))


def frames_equal(a: DataFrame, b: DataFrame) -> bool:
    """Multiset equality; column order does not matter."""
    if sorted(a.columns) != sorted(b.columns):
        return False
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
