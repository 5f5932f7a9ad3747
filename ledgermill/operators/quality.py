"""Data-quality constraints: each gives the rows that break it, or their count.

The suite reads every table once and shuffles once, whatever the number of rules: each row
gives one entry per broken row rule, unique key, reference and referenced key, and all entries
are counted by (rule, key) together. Counts are partial before the shuffle, so a value that
fills a third of a table moves as a handful of counts. Keys travel as their exact text, two
digits to a byte, so no verdict rests on a hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, FractionalType

VERDICT = "rule int, table_name string, test_name string, severity string"
ENTRY = "struct<rule: int, key: binary, parents: int>"


@dataclass(frozen=True)
class Constraint:
    """A rule on ``table``; ``where`` limits the rows it applies to."""

    table: str
    severity: str = "error"
    where: str | None = None

    @property
    def name(self) -> str:
        raise NotImplementedError

    def _applies(self, broken: Column) -> Column:
        return broken if self.where is None else F.expr(self.where) & broken


@dataclass(frozen=True)
class RowConstraint(Constraint):
    """A rule that each row meets or breaks on its own. NULL neither meets nor breaks it."""

    def broken(self) -> Column:
        raise NotImplementedError

    def violations(self, df: DataFrame) -> DataFrame:
        return df.filter(self._applies(self.broken()))


@dataclass(frozen=True)
class NotNull(RowConstraint):
    column: str = ""

    @property
    def name(self) -> str:
        return f"not_null({self.column})"

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues(RowConstraint):
    column: str = ""
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"accepted_values({self.column})"

    def broken(self) -> Column:
        return ~F.col(self.column).isin(list(self.values))


@dataclass(frozen=True)
class ExpressionIsTrue(RowConstraint):
    """``column expression`` holds; without a column the expression stands alone."""

    column: str = ""
    expression: str = ""

    @property
    def name(self) -> str:
        return f"expression_is_true({self.condition})"

    @property
    def condition(self) -> str:
        return f"{self.column} {self.expression}".strip()

    def broken(self) -> Column:
        return ~F.expr(self.condition)


@dataclass(frozen=True)
class AcceptedRange(RowConstraint):
    column: str = ""
    low: float | None = None
    high: float | None = None
    inclusive: bool = True

    @property
    def name(self) -> str:
        return f"accepted_range({self.column})"

    def broken(self) -> Column:
        value, outside = F.col(self.column), F.lit(False)
        if self.low is not None:
            outside = outside | (value < self.low if self.inclusive else value <= self.low)
        if self.high is not None:
            outside = outside | (value > self.high if self.inclusive else value >= self.high)
        return outside


@dataclass(frozen=True)
class NotExceeding(RowConstraint):
    column: str = ""
    other: str = ""

    @property
    def name(self) -> str:
        return f"not_exceeding({self.column}, {self.other})"

    def broken(self) -> Column:
        return F.col(self.column) > F.col(self.other)


@dataclass(frozen=True)
class Unique(Constraint):
    """No two rows share a value; rows without one are ignored. One violation per value."""

    columns: tuple[str, ...] = ()
    ignore_null: bool = True

    @property
    def name(self) -> str:
        kind = "unique" if len(self.columns) == 1 else "unique_combination"
        return f"{kind}({', '.join(self.columns)})"

    def violations(self, df: DataFrame) -> DataFrame:
        if self.where is not None:
            df = df.filter(self.where)
        if self.ignore_null:
            df = df.dropna(subset=list(self.columns))
        counted = df.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("n_records"))
        return counted.filter(F.col("n_records") > 1)


@dataclass(frozen=True)
class Relationship(Constraint):
    """Every value occurs in the parent's field; rows without a value are ignored."""

    column: str = ""
    to: str = ""
    field: str = ""

    @property
    def name(self) -> str:
        return f"relationship({self.column} -> {self.to}.{self.field})"

    def violations(self, child: DataFrame, parent: DataFrame) -> DataFrame:
        keys = parent.select(F.col(self.field).alias(self.column))
        known = child.filter(self._applies(F.col(self.column).isNotNull()))
        return known.join(keys, self.column, "left_anti")


def key_text(df: DataFrame, columns: tuple[str, ...], kind: DataType | None = None) -> Column:
    """The values of a key as one text; equal keys, and only they, have equal texts.

    Several columns are written with their lengths, a NULL as ``-``. The two zeros of a
    fraction are one value. Timestamps read as UTC, which ``session.configure`` sets.
    """
    parts = []
    for name in columns:
        value, own = F.col(name), df.schema[name].dataType
        if kind is not None and own != kind:
            value, own = value.cast(kind), kind
        if isinstance(own, FractionalType):
            value = value + F.lit(0).cast(own)
        parts.append(value.cast("string"))
    if len(parts) == 1:
        return parts[0]
    sized = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.concat(*[F.coalesce(p, F.lit("-")) for p in sized])


def packed(key: Column) -> Column:
    """The text of a key as bytes; equal texts, and only they, have equal bytes.

    Digits, ``-`` and ``:`` take half a byte each, an odd last one is followed by ``f``. Texts
    with anything else stay as they are, behind a byte that no packed text begins with.
    """
    digits = F.translate(key, "-:abcdefABCDEF", "ab" + 12 * "x")  # x: no hexadecimal digit
    even = F.concat(digits, F.when(F.length(key) % 2 == 1, "f").otherwise(""))
    return F.coalesce(F.unhex(even), F.concat(F.unhex(F.lit("FF")), key.cast("binary")))


def _entry(rule: int, key: Column, applies: Column, parents: int = 0) -> Column:
    fields = [F.lit(rule).alias("rule"), packed(key).alias("key"), F.lit(parents).alias("parents")]
    return F.when(applies, F.struct(*fields)).cast(ENTRY)


def _entries(
    tables: dict[str, DataFrame], table: str, constraints: list[Constraint]
) -> Iterator[Column]:
    """What one row of ``table`` has to say to each constraint; NULL where it has nothing."""
    df = tables[table]
    for number, rule in enumerate(constraints):
        if isinstance(rule, Relationship):
            kind = tables[rule.table].schema[rule.column].dataType
            if rule.table == table:
                known = rule._applies(F.col(rule.column).isNotNull())
                yield _entry(number, key_text(df, (rule.column,)), known)
            if rule.to == table:
                key = key_text(df, (rule.field,), kind)
                yield _entry(number, key, key.isNotNull(), parents=1)
        elif rule.table != table:
            continue
        elif isinstance(rule, RowConstraint):
            yield _entry(number, F.lit(None).cast("string"), rule._applies(rule.broken()))
        elif isinstance(rule, Unique):
            known = [F.col(c).isNotNull() for c in rule.columns if rule.ignore_null]
            counted = rule._applies(reduce(Column.__and__, known, F.lit(True)))
            yield _entry(number, key_text(df, rule.columns), counted)
        else:
            raise TypeError(f"no count for {rule.name}")


def count_failures(
    tables: dict[str, DataFrame], constraints: list[Constraint]
) -> DataFrame:
    """``rule`` (position in ``constraints``) and ``failures``; rules without any are absent."""
    used = {c.table for c in constraints}
    used |= {c.to for c in constraints if isinstance(c, Relationship)}
    heard = []
    for table in sorted(used):
        entries = F.array(*_entries(tables, table, constraints))
        told = tables[table].select(F.explode(entries).alias("e"))
        heard.append(told.filter("e is not null").select("e.*"))
    told_by = {
        kind: F.col("rule").isin([i for i, c in enumerate(constraints) if isinstance(c, kind)])
        for kind in (Unique, Relationship)
    }
    own_rows = F.count_if(F.col("parents") == 0).alias("n")
    counted = reduce(DataFrame.unionAll, heard).groupBy("rule", "key").agg(
        own_rows, F.max("parents").alias("parents")
    )
    failures = (
        F.when(told_by[Unique], (F.col("n") > 1).cast("long"))
        .when(told_by[Relationship] & (F.col("parents") > 0), F.lit(0).cast("long"))
        .otherwise(F.col("n"))
    )
    return counted.groupBy("rule").agg(F.sum(failures).alias("failures"))


def run_constraints(
    tables: dict[str, DataFrame], constraints: list[Constraint]
) -> DataFrame:
    """Failures and status (pass, warn, fail) of each constraint."""
    titles = [
        (i, c.table, c.name if c.where is None else f"{c.name} where {c.where}", c.severity)
        for i, c in enumerate(constraints)
    ]
    counted = count_failures(tables, constraints)
    rules = counted.sparkSession.createDataFrame(titles, VERDICT)
    status = F.when(F.col("failures") == 0, "pass").otherwise(
        F.when(F.col("severity") == "warn", "warn").otherwise("fail")
    )
    return (
        rules.join(counted, "rule", "left_outer")
        .select(
            "table_name", "test_name", "severity",
            F.coalesce("failures", F.lit(0)).cast("long").alias("failures"),
        )
        .withColumn("status", status)
    )
