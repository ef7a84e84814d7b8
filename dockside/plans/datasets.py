"""What a dataset is: a query, a schema, a key and the upkeep of its tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockside.functions.dates import DateWindow
from dockside.functions.keys import tolerant_key
from dockside.operators.joins import DEFAULT_BUDGET, JoinBudget
from dockside.plans.breakout import breakout
from dockside.plans.po_inbound import INBOUND_ORDER, po_inbound
from dockside.rules import DAYS_BACK, DAYS_FORWARD, RECENT_DAYS, OrderRules
from dockside.schemas import BREAKOUT_SCHEMA, INBOUND_SCHEMA
from dockside.sources.inputs import SourceTables
from dockside.sources.samples import breakout_sample, inbound_sample

KEY = "record_key"
STAMP = "load_timestamp"


@dataclass(frozen=True)
class DatasetSpec:
    """Everything the load and upkeep jobs need to know about one dataset."""

    name: str
    staging_table: str
    final_table: str
    schema: T.StructType
    date_column: str
    newest_first: tuple[str, ...] = (STAMP,)
    query: Callable[[SourceTables, DateWindow], DataFrame] | None = None
    record_key: Callable[[], Column] | None = None
    sample: Callable[[SparkSession, date], DataFrame] | None = None
    days_back: int = DAYS_BACK
    days_forward: int = DAYS_FORWARD
    recent_days: int = RECENT_DAYS
    cleanup_staging: bool = True
    cleanup_final: bool = True
    cleanup_stale: bool = True
    #: Buckets of the final table; about a gigabyte each is a good size.
    buckets: int = 8
    #: States of the final table that stay readable, the current one included.
    keep_states: int = 2
    #: Written parts that nothing names are dropped from this age on.
    orphan_age: timedelta = timedelta(days=1)

    def columns_of(self, kind: type[T.DataType]) -> list[str]:
        return [f.name for f in self.schema.fields if isinstance(f.dataType, kind)]


def inbound_spec(
    rules: OrderRules = OrderRules(), budget: JoinBudget = DEFAULT_BUDGET, **changes
) -> DatasetSpec:
    spec = DatasetSpec(
        name="po",
        staging_table="po_inbound_daily",
        final_table="po_inbound_final",
        schema=INBOUND_SCHEMA,
        date_column="expected_date",
        newest_first=(STAMP, *INBOUND_ORDER),
        query=lambda src, window: po_inbound(src, window, rules, budget),
        record_key=lambda: tolerant_key(F.col("po"), F.col("sku"), F.col("expected_date")),
        sample=inbound_sample,
    )
    return replace(spec, **changes)


def breakout_spec(
    rules: OrderRules = OrderRules(), budget: JoinBudget = DEFAULT_BUDGET, **changes
) -> DatasetSpec:
    spec = DatasetSpec(
        name="breakout",
        staging_table="po_breakout_staging",
        final_table="po_breakout_final",
        schema=BREAKOUT_SCHEMA,
        date_column="exp_date",
        newest_first=(STAMP, "exp_date"),
        query=lambda src, window: breakout(src, window, rules, budget),
        record_key=lambda: tolerant_key(F.col("po_man"), F.col("sku_num"), F.col("exp_date")),
        sample=breakout_sample,
    )
    return replace(spec, **changes)


def default_datasets(
    rules: OrderRules = OrderRules(), budget: JoinBudget = DEFAULT_BUDGET
) -> dict[str, DatasetSpec]:
    """A further dataset is one more entry: a query, a schema and a key."""
    return {spec.name: spec for spec in (inbound_spec(rules, budget), breakout_spec(rules, budget))}


def with_key(rows: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Add the record key where the query did not give one."""
    if KEY in rows.columns or spec.record_key is None:
        return rows
    return rows.withColumn(KEY, spec.record_key())


def with_missing_keys(rows: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Make the record key of each row that came without one."""
    if KEY not in rows.columns or spec.record_key is None:
        return with_key(rows, spec)
    return rows.withColumn(KEY, F.coalesce(F.nullif(F.col(KEY), F.lit("")), spec.record_key()))


def extract(spec: DatasetSpec, src: SourceTables, window: DateWindow) -> DataFrame:
    """The dataset's query for the window, keyed."""
    return with_key(spec.query(src, window), spec)
