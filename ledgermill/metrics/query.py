"""Metric queries as DataFrame plans.

Each model is aggregated to the grain of the query on its own, with partial sums before the
shuffle, and only those small results meet. Raw facts of two models never join, so nothing
fans out.
"""

from __future__ import annotations

import warnings
from collections import defaultdict
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions import as_of_column, exact_sum
from ledgermill.functions.calendar import AsOf
from ledgermill.metrics.finance import METRICS, MODELS, YEAR_END_BALANCES
from ledgermill.metrics.model import Cumulative, Derived, Measure, Ratio, SemanticModel, Simple
from ledgermill.operators.prefix import day_block, running_sums
from ledgermill.session import staged

GRAINS = ("day", "week", "month", "quarter", "year")
METRIC_TIME = "metric_time"
SPINE_BIN_DAYS = {"day": 32, "week": 224, "month": 1024, "quarter": 3072, "year": 12288}


@dataclass(frozen=True)
class Leaf:
    """One aggregated measure: plain or cumulative, possibly taken some months earlier.

    ``late_filter`` puts conditions on metric time after the offset, so that the month
    before the first one asked for is still seen.
    """

    model: str
    measure: str
    cumulative: bool = False
    offset_months: int = 0
    late_filter: bool = False

    @property
    def column(self) -> str:
        kind = "cumulative" if self.cumulative else f"back{self.offset_months}"
        late = "late" if self.late_filter else "early"
        return f"leaf_{self.model}_{self.measure}_{kind}_{late}"

    def value(self) -> Column:
        return F.col(self.column)


def _grain_of(item: str) -> str | None:
    last = item.split("__")[-1]
    return last if last in GRAINS else None


def _truncate(grain: str, time: Column) -> Column:
    return F.date_trunc(grain, time).cast("date")


def _step(grain: str) -> Column:
    if grain in ("day", "week"):
        return F.make_dt_interval(days=F.lit(7 if grain == "week" else 1))
    months = {"month": 1, "quarter": 3, "year": 12}[grain]
    return F.make_ym_interval(months=F.lit(months))


@dataclass(frozen=True)
class Condition:
    """One conjunct of a ``where``: its SQL and the columns it names."""

    sql: str
    items: tuple[str, ...]

    @property
    def times(self) -> list[str]:
        return [i for i in self.items if i.split("__")[0] == METRIC_TIME]

    def holds_for_periods(self, time: str | None) -> bool:
        """Whether it names only metric time, in whole periods of ``time``."""
        if time is None or len(self.times) < len(self.items):
            return False
        own = GRAINS.index(_grain_of(time) or "day")
        whole = [GRAINS.index(_grain_of(i) or "day") >= own for i in self.times]
        # a week is no part of a month
        weeks = [_grain_of(i) == "week" and _grain_of(time) not in ("day", "week") for i in self.times]
        return all(whole) and not any(weeks)


def conjuncts(spark: SparkSession, texts: list[str]) -> list[Condition]:
    """The conditions that all must hold, as Spark's own parser reads them."""
    parser = spark._jsparkSession.sessionState().sqlParser()
    found, open_nodes = [], [parser.parseExpression(text) for text in reversed(texts)]
    while open_nodes:
        node = open_nodes.pop()
        if node.getClass().getSimpleName() == "And":
            open_nodes += [node.right(), node.left()]
            continue
        leaves = node.collectLeaves()
        leaves = [leaves.apply(i) for i in range(leaves.size())]
        names = [x.name() for x in leaves if x.getClass().getSimpleName() == "UnresolvedAttribute"]
        found.append(Condition(node.sql(), tuple(dict.fromkeys(names))))
    return found


class MetricStore:
    """Answers metric queries over the mart frames, by name of the semantic model."""

    def __init__(
        self,
        tables: dict[str, DataFrame],
        as_of: AsOf = None,
        models=MODELS,
        metrics=METRICS,
        spine: DataFrame | None = None,
    ):
        """``spine`` (date_day) lists the days cumulative metrics are reported for; without
        one every period from the first to the last with data is."""
        self.tables = tables
        self.spine = spine
        self.as_of = as_of
        self.models = {m.name: m for m in models}
        self.metrics = {m.name: m for m in metrics}
        self.measure_model = {
            measure.name: model for model in models for measure in model.measures
        }

    def query(
        self,
        metrics: list[str],
        group_by: list[str] | None = None,
        where: str | list[str] | None = None,
    ) -> DataFrame:
        """One row per group, one column per metric.

        ``group_by`` and ``where`` name ``metric_time__<grain>``, ``<entity>__<dimension>``
        or ``<entity>__<time dimension>__<grain>``. Several conditions are combined with
        AND. Conditions restrict the rows a metric is computed from, so a cumulative metric
        restarts at the first day they admit. Offset metrics apply a condition on whole
        periods of metric time to the result; one that cuts through periods, or joins metric
        time with something else by OR, moves with the offset: a value taken one month earlier
        comes from the rows that meet it one month later.
        """
        group_by = list(group_by or [])
        texts = [where] if isinstance(where, str) else list(where or [])
        self._warn_about_balances(metrics, group_by)
        leaves: dict[Leaf, None] = {}
        values = {name: self._value(name, leaves) for name in metrics}
        batches: dict[Leaf, list[Leaf]] = defaultdict(list)
        for leaf in leaves:
            batches[replace(leaf, measure="")].append(leaf)
        spark = self._source(self.models[next(iter(leaves)).model]).sparkSession
        conditions = conjuncts(spark, texts) if texts else []
        frames = [self._frame(batch, group_by, conditions) for batch in batches.values()]
        combined = self._combine(frames, group_by)
        return combined.select(*group_by, *[v.alias(name) for name, v in values.items()])

    # what to compute

    def _value(
        self, name: str, leaves: dict[Leaf, None], offset: int = 0, late: bool = False
    ) -> Column:
        """The metric over leaf columns; notes the leaves it needs."""
        metric = self.metrics[name]
        if isinstance(metric, (Simple, Cumulative)):
            leaf = Leaf(
                self.measure_model[metric.measure].name,
                metric.measure,
                isinstance(metric, Cumulative),
                offset,
                late,
            )
            leaves[leaf] = None
            return leaf.value()
        if isinstance(metric, Ratio):
            top = self._value(metric.numerator, leaves, offset, late)
            bottom = self._value(metric.denominator, leaves, offset, late)
            return top / F.nullif(bottom, F.lit(0))
        assert isinstance(metric, Derived)
        late = late or any(i.offset_months for i in metric.inputs)
        parts = [
            self._value(i.metric, leaves, offset + i.offset_months, late) for i in metric.inputs
        ]
        return metric.formula(*parts)

    def _warn_about_balances(self, metrics: list[str], group_by: list[str]) -> None:
        by_year = any("fiscal_year" in i or i.startswith(METRIC_TIME) for i in group_by)
        balances = [m for m in metrics if m in YEAR_END_BALANCES]
        if balances and not by_year:
            warnings.warn(f"{balances} are year-end balances; group by fiscal year", stacklevel=3)

    # columns of a model

    def _expr(self, sql: str) -> Column:
        if "{today}" not in sql:
            return F.expr(sql)
        return F.expr(sql.replace("{today}", "__today"))

    def _source(self, model: SemanticModel) -> DataFrame:
        table = self.tables[model.name]
        if any("{today}" in sql for sql in model.time_dimensions.values()):
            table = table.withColumn("__today", as_of_column(self.as_of).cast("date"))
        return table

    def _local(self, model: SemanticModel, name: str, grain: str | None) -> Column | None:
        if name in model.time_dimensions:
            return _truncate(grain or model.finest_grain, self._expr(model.time_dimensions[name]))
        if grain is None and name in model.dimensions:
            return self._expr(model.dimensions[name])
        if grain is None and name in model.entities and name != model.primary:
            return self._expr(model.entities[name])
        return None

    def _with_items(
        self, df: DataFrame, model: SemanticModel, items: list[str], months: int = 0
    ) -> DataFrame:
        """``df``, of the model's table, with one column per item, joining other models where
        needed. Metric time is taken ``months`` later."""
        joins: dict[tuple[str, str], dict[str, Column]] = defaultdict(dict)
        for item in dict.fromkeys(items):
            grain = _grain_of(item)
            entity, *rest = item.split("__")
            name = rest[0] if rest and rest[0] not in GRAINS else None
            if entity == METRIC_TIME:
                grain = grain or model.finest_grain
                if GRAINS.index(grain) < GRAINS.index(model.finest_grain):
                    raise ValueError(f"{model.name} has no grain finer than {model.finest_grain}")
                time = self._expr(model.time_dimensions[model.metric_time])
                time = F.add_months(time.cast("date"), months) if months else time
                df = df.withColumn(item, _truncate(grain, time))
                continue
            column = self._local(model, name, grain) if entity == model.primary else None
            if column is not None:
                df = df.withColumn(item, column)
                continue
            other, column = self._foreign(model, entity, name, grain, item)
            joins[other.name, entity][item] = column
        for (other_name, entity), columns in joins.items():
            df = self._join(df, model, self.models[other_name], entity, columns)
        return df

    def _foreign(self, model: SemanticModel, entity: str, name: str, grain: str | None, item: str):
        if entity in model.entities:
            for other in self.models.values():
                if other.primary == entity and other.unique_key and other is not model:
                    column = self._local(other, name, grain)
                    if column is not None:
                        return other, column
        raise ValueError(f"{item} cannot be reached from {model.name}")

    def _join(
        self,
        df: DataFrame,
        model: SemanticModel,
        other: SemanticModel,
        entity: str,
        columns: dict[str, Column],
    ) -> DataFrame:
        """Many-to-one join on an entity."""
        key = self._expr(other.entities[entity]).alias("__entity")
        attributes = self._source(other).select(
            key, *[column.alias(item) for item, column in columns.items()]
        )
        keyed = df.withColumn("__own_entity", self._expr(model.entities[entity]))
        joined = keyed.join(attributes, F.col("__own_entity") == F.col("__entity"), "left_outer")
        return joined.drop("__entity", "__own_entity")

    # aggregation

    def _base(
        self, model: SemanticModel, group_by: list[str], conditions: list[Condition], leaf: Leaf
    ) -> DataFrame:
        """The model's rows that meet the conditions, with the columns to group by."""
        time = next((i for i in group_by if i.startswith(METRIC_TIME)), None)
        df = table = self._source(model)
        for condition in conditions:
            if leaf.late_filter and condition.holds_for_periods(time):
                continue
            months = leaf.offset_months if condition.times else 0
            df = self._with_items(df, model, list(condition.items), months).filter(condition.sql)
            df = df.select(table.columns)
        return self._with_items(df, model, group_by)

    def _aggregate(self, df: DataFrame, measure: Measure) -> Column:
        value = F.expr(measure.expr)
        if measure.agg == "count_distinct":
            return F.count_distinct(value)
        if df.select(value).schema[0].dataType.typeName() == "double":
            return exact_sum(value).cast("double")
        return F.sum(value)

    def _frame(self, leaves: list[Leaf], group_by: list[str], conditions: list[Condition]) -> DataFrame:
        """Leaves that share a model, an offset and a kind, at the grain of the query."""
        first = leaves[0]
        model = self.models[first.model]
        df = self._base(model, group_by, conditions, first)
        time = next((i for i in group_by if i.startswith(METRIC_TIME)), None)
        if first.cumulative:
            return self._running(df, leaves, model, group_by, time)
        aggregates = [
            self._aggregate(df, model.measure(leaf.measure)).alias(leaf.column) for leaf in leaves
        ]
        frame = df.groupBy(*[F.col(i) for i in group_by]).agg(*aggregates)
        if first.offset_months:
            frame = self._later(frame, time, first.offset_months)
        if first.late_filter:
            for condition in conditions:
                if condition.holds_for_periods(time):
                    frame = self._late_filter(frame, time, condition)
        return frame

    def _later(self, frame: DataFrame, time: str | None, months: int) -> DataFrame:
        """Values moved to the periods that look ``months`` back at them."""
        if time is None:
            raise ValueError("offset metrics need metric_time in group_by")
        period = F.col(time)
        known = frame.filter(period.isNotNull())
        if _grain_of(time) not in ("day", "week"):
            return known.withColumn(time, F.add_months(period, months))
        # Several days look back at the last day of a short month, and none at a 31st.
        earliest = F.add_months(period, months)
        candidates = F.sequence(earliest, F.date_add(earliest, 3))
        looks_back = F.filter(candidates, lambda day: F.add_months(day, -months) == period)
        return known.withColumn(time, F.explode(looks_back))

    @staticmethod
    def _late_filter(frame: DataFrame, time: str, condition: Condition) -> DataFrame:
        columns = frame.columns
        for item in condition.items:
            if item not in columns:
                frame = frame.withColumn(item, _truncate(_grain_of(item) or "day", F.col(time)))
        return frame.filter(condition.sql).select(*columns)

    def _running(
        self,
        df: DataFrame,
        leaves: list[Leaf],
        model: SemanticModel,
        group_by: list[str],
        time: str | None,
    ) -> DataFrame:
        """Running values of measures, repeated through periods without rows.

        All sums of the model come from one aggregation; a distinct count adds each value in
        the period that shows it first. Running sums are built from blocks of days, and the
        time spine is joined to the span of periods in which each of them holds.
        """
        others = [i for i in group_by if i != time]
        measures = {leaf.column: model.measure(leaf.measure) for leaf in leaves}
        if time is None:
            happened = self._expr(model.time_dimensions[model.metric_time]).isNotNull()
            totals = [self._aggregate(df, m).alias(column) for column, m in measures.items()]
            return df.filter(happened).groupBy(*others).agg(*totals)
        dated = df.filter(F.col(time).isNotNull())
        sums = [c for c, m in measures.items() if m.agg != "count_distinct"]
        frames = []
        if sums:
            amounts = [exact_sum(F.expr(measures[c].expr)).alias(c) for c in sums]
            frames.append(dated.groupBy(*others, time).agg(*amounts))
        for column, measure in measures.items():
            if measure.agg == "count_distinct":
                seen = dated.withColumn("__value", F.expr(measure.expr))
                seen = seen.filter(F.col("__value").isNotNull())
                firsts = seen.groupBy(*others, "__value").agg(F.min(time).alias(time))
                frames.append(firsts.groupBy(*others, time).agg(F.count(F.lit(1)).alias(column)))
        steps = staged(self._combine(frames, [*others, time]), "steps")  # read three times
        running = running_sums(steps, others, time, list(measures), day_block(F.col(time)))
        totals = [
            F.col(f"running_{c}").cast("double" if c in sums else "long").alias(c) for c in measures
        ]
        spans = running.select(
            *others, F.col(time).alias("__from"), F.col(f"next_{time}").alias("__until"), *totals
        )
        first, last = steps.agg(F.min(time), F.max(time)).first()
        if first is None:
            return spans.withColumn(time, F.col("__from")).select(*others, time, *measures)
        return self._along_spine(spans, first, last, time, [*others, time, *measures])

    def _along_spine(
        self, spans: DataFrame, first: date, last: date, time: str, columns: list[str]
    ) -> DataFrame:
        """Each span (from, until) met with the periods of the spine inside it.

        A range join on bins of periods: a span names the bins it touches, up to the last
        period with data, and meets only the periods of those.
        """
        grain = _grain_of(time) or "day"
        width = SPINE_BIN_DAYS[grain]
        if self.spine is None:
            ends = [F.lit(day).cast("date") for day in (first, last)]
            periods = F.explode(F.sequence(*ends, _step(grain))).alias(time)
            listed = spans.sparkSession.range(1).select(periods)
        else:
            period = _truncate(grain, F.col("date_day")).alias(time)
            listed = self.spine.select(period).distinct().filter(F.col(time).between(first, last))
        listed = listed.withColumn("__spine_bin", day_block(F.col(time), width))
        until = F.coalesce(F.date_sub("__until", 1), F.lit(last).cast("date"))
        bins = F.sequence(day_block(F.col("__from"), width), day_block(until, width))
        inside = (F.col("__bin") == F.col("__spine_bin")) & (F.col(time) >= F.col("__from"))
        inside = inside & (F.col("__until").isNull() | (F.col(time) < F.col("__until")))
        return spans.withColumn("__bin", F.explode(bins)).join(listed, inside).select(*columns)

    @staticmethod
    def _combine(frames: list[DataFrame], group_by: list[str]) -> DataFrame:
        """Frames side by side on the group columns, a missing group being NULL.

        A union and one small aggregate do the work of a chain of full outer joins, and
        treat a NULL group as one group.
        """
        if len(frames) == 1:
            return frames[0]
        union = frames[0]
        for frame in frames[1:]:
            union = union.unionByName(frame, allowMissingColumns=True)
        values = [c for c in union.columns if c not in group_by]
        return union.groupBy(*group_by).agg(*[F.max(c).alias(c) for c in values])

