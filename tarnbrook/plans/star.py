"""Star schema: dimension sources, fact source, and their merge clauses."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnbrook.functions.dates import date_parts
from tarnbrook.functions.keys import fact_id, flight_id
from tarnbrook.operators.dedupe import latest_per_key
from tarnbrook.operators.lookup import HotKeys, find_hot_keys, hot_keys_of_written, lookup
from tarnbrook.operators.merge import Matched, Merge, NotMatched, any_difference, from_source
from tarnbrook.operators.surrogate import assign_surrogate_keys
from tarnbrook.schemas import (
    DIM_AIRPORT, DIM_DATE, DIM_FLIGHT, DIM_PASSENGER, DIMENSIONS, FACT, TableSpec,
)
from tarnbrook.session import materialize, scratch_scope, side_by_side

DELETED, ADDED = "s._action = 'DELETE'", "s._action = 'INSERT'"
FLAGGED_UPDATE = f"{ADDED} and s._is_update"
# Never true: change rows carry INSERT and DELETE only.
NAMED_UPDATE = "s._action = 'UPDATE'"


@dataclass(frozen=True)
class DimensionPlan:
    """How one dimension is read out of core rows."""

    spec: TableSpec
    columns: dict[str, str]
    newest_first: bool
    # SQL on core columns for "the dimension column has a value", where the names differ.
    present: dict[str, str] = field(default_factory=dict)

    # Are all columns functions of the key? Then any row of a key will do.
    derived: bool = False
    # Do many rows share a key? Then the day of each key's winner comes out of a hash aggregate.
    few_keys: bool = False

    def project(self, rows: DataFrame, *keep: str) -> DataFrame:
        return rows.selectExpr(*[c if c == e else f"{e} as `{c}`" for c, e in self.columns.items()], *keep)

    def on_last_day(self, rows: DataFrame) -> DataFrame:
        """The rows of the departure date that wins in ``latest``, of every key; reads ``rows`` twice. Newest first only."""
        key = F.struct(*[F.expr(self.columns[c]).alias(c) for c in self.spec.key])
        days = materialize(rows.groupBy(key.alias("_key")).agg(F.max("departure_date").alias("_day")), "last-days")
        wins = key.eqNullSafe(F.col("_key")) & F.col("departure_date").eqNullSafe(F.col("_day"))
        return rows.join(days, wins, "left_semi")

    def latest(self, rows: DataFrame, tie_break: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
        """Key, attributes and ``keep`` of one row per natural key by departure date.

        ``tie_break`` makes the order total. A derived dimension needs no order:
        its distinct rows come out of a hash aggregate.
        """
        columns = [*self.spec.key, *self.spec.attributes, *keep]
        if self.derived and not keep:
            return self.project(rows).select(*columns).distinct()
        others = [c for c in rows.columns if c not in self.columns]
        order = ["departure_date desc" if self.newest_first else "departure_date asc", *tie_break]
        return latest_per_key(self.project(rows, *others), list(self.spec.key), order).select(*columns)


FLIGHT_KEY = flight_id("pilot_name", "flight_status", "departure_date", "arrival_airport")


PASSENGER_PLAN = DimensionPlan(
    DIM_PASSENGER,
    {c: c for c in ("passenger_id", "first_name", "last_name", "gender", "age", "nationality")},
    newest_first=True,
)
_AIRPORT_COLUMNS = {
    "airport_code": "arrival_airport",
    "airport_name": "airport_name",
    "country_code": "airport_country_code",
    "country_name": "country_name",
    "continent_code": "airport_continent",
    "continent_name": "continents",
}
AIRPORT_PLAN = DimensionPlan(
    DIM_AIRPORT,
    _AIRPORT_COLUMNS,
    newest_first=True,
    present={name: f"{source} is not null" for name, source in _AIRPORT_COLUMNS.items()},
    few_keys=True,
)
FLIGHT_PLAN = DimensionPlan(
    DIM_FLIGHT,
    {"flight_id": FLIGHT_KEY, "pilot_name": "pilot_name", "flight_status": "flight_status"},
    newest_first=False,
    present={"flight_id": "pilot_name is not null and flight_status is not null "
                          "and departure_date is not null and arrival_airport is not null"},
)
DATE_PLAN = DimensionPlan(
    DIM_DATE,
    {"date": "departure_date", **date_parts("departure_date")},
    newest_first=True,
    present={c: "departure_date is not null" for c in ("date", "day_of_week", "month", "year", "quarter")},
    derived=True,
)
DIMENSION_PLANS = {p.spec.name: p for p in (PASSENGER_PLAN, AIRPORT_PLAN, FLIGHT_PLAN, DATE_PLAN)}

INDEX_ORDER = ["index_col desc"]


# -- merges ------------------------------------------------------------------


def literal_dimension_merge(target: DataFrame, source: DataFrame, spec: TableSpec) -> Merge:
    """The clauses as first written: an update is expected as action UPDATE, which
    change rows never carry, so this inserts and deletes only."""
    return Merge(
        target, source, list(spec.key),
        matched=[Matched(DELETED), Matched(NAMED_UPDATE, from_source(spec.attributes))],
        not_matched=NotMatched(from_source([*spec.key, *spec.attributes]), ADDED),
        source_is_unique=True,
    )


def scd1_merge(target: DataFrame, source: DataFrame, spec: TableSpec, skip_equal: bool = True) -> Merge:
    """The intent: the newest row of a key overwrites. Rows that would not change are left alone."""
    attributes = spec.attributes
    update = f"{ADDED} and {any_difference(attributes)}" if skip_equal else ADDED
    return Merge(
        target, source, list(spec.key),
        matched=[Matched(DELETED), Matched(update, from_source(attributes))],
        not_matched=NotMatched(from_source([*spec.key, *attributes]), ADDED),
        source_is_unique=True,
    )


def core_merge(target: DataFrame, source: DataFrame, spec: TableSpec, fixed: tuple[str, ...] = ("passenger_id",)) -> Merge:
    """Literal core merge: a plain INSERT on a known key does nothing (first write wins),
    an update needs the update flag and leaves ``fixed`` columns alone, and whatever
    matches nothing is inserted, DELETE rows included and repeated keys as well."""
    assigned = [c for c in spec.attributes if c not in fixed]
    return Merge(
        target, source, list(spec.key),
        matched=[
            Matched(DELETED),
            Matched(FLAGGED_UPDATE, from_source(assigned)),
        ],
        not_matched=NotMatched(from_source(list(spec.columns))),
    )


def checked_core_merge(target: DataFrame, source: DataFrame, spec: TableSpec) -> Merge:
    """Core merge over a source with one row per key: a DELETE of an unknown key has no
    effect and an update assigns every column."""
    return Merge(
        target, source, list(spec.key),
        matched=[
            Matched(DELETED),
            Matched(FLAGGED_UPDATE, from_source(spec.attributes)),
        ],
        not_matched=NotMatched(from_source(list(spec.columns)), ADDED),
        source_is_unique=True,
    )


def literal_fact_merge(target: DataFrame, source: DataFrame) -> Merge:
    """Fact clauses as first written; the source holds INSERT rows only, so facts are
    only ever added, repeated ids of one batch included."""
    return Merge(
        target, source, list(FACT.key),
        matched=[Matched(DELETED), Matched(NAMED_UPDATE, from_source(FACT.attributes))],
        not_matched=NotMatched(from_source(list(FACT.columns)), ADDED),
    )


# -- fact --------------------------------------------------------------------

LOOKUPS = {
    "arrival_airport": (DIM_AIRPORT, "airport_code"),
    "departure_date": (DIM_DATE, "date"),
    "flight_id": (DIM_FLIGHT, "flight_id"),
    "passenger_id": (DIM_PASSENGER, "passenger_id"),
}


def fact_rows(
    rows: DataFrame, dims: dict[str, DataFrame], hot: dict[str, HotKeys] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Fact rows (and the ``keep`` columns) of core rows; the flight key is derived once."""
    facts = rows.withColumn("flight_id", F.expr(FLIGHT_KEY)).select(
        "passenger_id", "flight_id", "arrival_airport", "departure_date", "passenger_status", "ticket_type", *keep
    )
    return keyed_facts(facts, dims, hot).select(*FACT.columns, *keep)


def keyed_facts(facts: DataFrame, dims: dict[str, DataFrame], hot: dict[str, HotKeys] | None = None) -> DataFrame:
    """Rows with a flight key, with surrogate keys from four left lookups and the fact's id.

    Each dimension must be unique on its key. The small dimensions come first:
    Catalyst broadcasts them by size, so only flight and passenger shuffle.
    """
    if hot is None:
        hot = find_hot_keys(facts, list(LOOKUPS))
    spread_by = ["passenger_id", "flight_id", "departure_date"]
    for column, (spec, key) in LOOKUPS.items():
        dim = dims[spec.name].select(F.col(key).alias(column), spec.surrogate)
        facts = lookup(facts, dim, column, hot[column], [c for c in spread_by if c != column])
    return facts.withColumn("id", F.expr(fact_id("passenger_id", "flight_sk", "departure_date")))


# -- whole star from core rows -------------------------------------------------


def build_dimension(core: DataFrame, plan: DimensionPlan, tie_break: list[str]) -> DataFrame:
    spec = plan.spec
    return assign_surrogate_keys(plan.latest(core, tie_break), list(spec.key), spec.surrogate)


# A dimension of at most this many rows is broadcast to the facts, so that hot keys do not matter.
SMALL = 10_000


def _star_dimension(core: DataFrame, plan: DimensionPlan, tie_break: list[str]) -> DataFrame:
    """``build_dimension`` of written core rows. The rows to number are written, since finding ranges reads them twice."""
    spec = plan.spec
    with scratch_scope(core.sparkSession, keep_last=True):
        latest = plan.latest(plan.on_last_day(core) if plan.few_keys else core, tie_break)
        return assign_surrogate_keys(materialize(latest, "latest"), list(spec.key), spec.surrogate)


def build_star(core: DataFrame, tie_break: list[str]) -> dict[str, DataFrame]:
    """Initial load without tables: four dimensions side by side, then the fact, by table name.

    ``core``: written rows, as they are read several times.
    Hot keys are only looked for where the lookup may shuffle.
    """
    dims = side_by_side(
        core.sparkSession,
        [partial(_star_dimension, core, DIMENSION_PLANS[spec.name], tie_break) for spec in DIMENSIONS],
    )
    star = {spec.name: dim for spec, dim in zip(DIMENSIONS, dims)}
    small = {name: dim.limit(SMALL + 1).count() <= SMALL for name, dim in star.items()}
    beside = {name: F.broadcast(dim) if small[name] else dim for name, dim in star.items()}
    sought = [c for c, (spec, _) in LOOKUPS.items() if not small[spec.name]]
    keyed = core.withColumn("flight_id", F.expr(FLIGHT_KEY))
    hot = {c: HotKeys() for c in LOOKUPS} | (hot_keys_of_written(keyed, sought) if sought else {})
    return star | {FACT.name: fact_rows(core, beside, hot)}
