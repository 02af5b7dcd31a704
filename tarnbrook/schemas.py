"""Tables of the passenger warehouse: columns, types and constraints.

Column names, widths and nullability are fixed values of the data model.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING, LONG, INT, DATE = T.StringType(), T.LongType(), T.IntegerType(), T.DateType()
BOOL, LTZ, NTZ = T.BooleanType(), T.TimestampType(), T.TimestampNTZType()


@dataclass(frozen=True)
class TableSpec:
    """One table: types are enforced by Spark, constraints by ``operators.quality``."""

    name: str
    columns: dict[str, T.DataType]
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    widths: dict[str, int] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    surrogate: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in self.columns.items()])

    @property
    def attributes(self) -> list[str]:
        """Columns a merge may update: everything but key and surrogate."""
        return [c for c in self.columns if c not in self.key and c != self.surrogate]


RAW_COLUMNS = [
    "index_col", "passenger_id", "first_name", "last_name", "gender", "age", "nationality",
    "airport_name", "airport_country_code", "country_name", "airport_continent", "continents",
    "departure_date", "arrival_airport", "pilot_name", "flight_status", "ticket_type", "passenger_status",
]

RAW = TableSpec("raw_stage.passengers_wide", {c: STRING for c in RAW_COLUMNS})

CORE = TableSpec(
    "core_stage.passengers_cleaned",
    {**{c: STRING for c in RAW_COLUMNS}, "index_col": LONG, "age": INT, "departure_date": DATE},
    key=("index_col",),
    not_null=(
        "index_col", "passenger_id", "first_name", "last_name", "airport_country_code",
        "airport_continent", "departure_date", "arrival_airport",
    ),
    widths={
        "passenger_id": 6, "first_name": 255, "last_name": 255, "gender": 10, "nationality": 255,
        "airport_name": 255, "airport_country_code": 3, "country_name": 255, "airport_continent": 3,
        "continents": 255, "arrival_airport": 3, "pilot_name": 255, "flight_status": 10,
        "ticket_type": 10, "passenger_status": 10,
    },
)

DIM_PASSENGER = TableSpec(
    "mart_stage.dim_passenger",
    {"passenger_sk": LONG, "passenger_id": STRING, "first_name": STRING, "last_name": STRING,
     "gender": STRING, "age": INT, "nationality": STRING},
    key=("passenger_id",),
    not_null=("passenger_id", "first_name", "last_name", "gender", "age", "nationality"),
    surrogate="passenger_sk",
)

DIM_FLIGHT = TableSpec(
    "mart_stage.dim_flight",
    {"flight_sk": LONG, "flight_id": STRING, "pilot_name": STRING, "flight_status": STRING},
    key=("flight_id",),
    not_null=("flight_id", "pilot_name", "flight_status"),
    surrogate="flight_sk",
)

DIM_AIRPORT = TableSpec(
    "mart_stage.dim_airport",
    {"airport_sk": LONG, "airport_code": STRING, "airport_name": STRING, "country_code": STRING,
     "country_name": STRING, "continent_code": STRING, "continent_name": STRING},
    key=("airport_code",),
    not_null=("airport_code", "airport_name", "country_code", "country_name", "continent_code", "continent_name"),
    surrogate="airport_sk",
)

DIM_DATE = TableSpec(
    "mart_stage.dim_date",
    {"date_sk": LONG, "date": DATE, "day_of_week": INT, "month": INT, "year": INT, "quarter": INT},
    key=("date",),
    not_null=("date", "day_of_week", "month", "year", "quarter"),
    surrogate="date_sk",
)

FACT = TableSpec(
    "mart_stage.fact_passenger_flight",
    {"id": STRING, "passenger_sk": LONG, "flight_sk": LONG, "airport_sk": LONG, "date_sk": LONG,
     "passenger_status": STRING, "ticket_type": STRING},
    key=("id",),
    references={
        "passenger_sk": (DIM_PASSENGER.name, "passenger_sk"),
        "flight_sk": (DIM_FLIGHT.name, "flight_sk"),
        "airport_sk": (DIM_AIRPORT.name, "airport_sk"),
        "date_sk": (DIM_DATE.name, "date_sk"),
    },
)

AUDIT = TableSpec(
    "mart_stage.etl_audit_log",
    {"log_id": LONG, "task_id": STRING, "target_table": STRING, "operation_type": STRING,
     "rows_affected": LONG, "query_id": STRING, "start_timestamp": NTZ, "end_timestamp": NTZ,
     "execution_time": T.DecimalType(10, 2), "error_message": STRING, "log_timestamp": NTZ},
    key=("log_id",),
    not_null=("task_id", "target_table", "operation_type", "rows_affected"),
    widths={"task_id": 255, "target_table": 255, "operation_type": 50, "query_id": 255},
)

LOAD_HISTORY = TableSpec(
    "raw_stage.copy_info_table",
    {"copy_id": LONG, "file_name": STRING, "file_size": LONG, "last_load_time": LTZ, "status": STRING,
     "rows_parsed": LONG, "rows_loaded": LONG, "error_rows": LONG, "first_error_message": STRING,
     "first_error_line_number": LONG},
    key=("copy_id",),
)

# Rows that break a rule, kept as text with the names of the rules.
QUARANTINE = TableSpec(
    "core_stage.quarantine",
    {**{c: STRING for c in RAW_COLUMNS}, "file_name": STRING, "violations": T.ArrayType(STRING)},
)
MART_QUARANTINE = TableSpec(
    "mart_stage.quarantine", {**CORE.columns, "violations": T.ArrayType(STRING)}
)
DIMENSIONS = (DIM_PASSENGER, DIM_AIRPORT, DIM_FLIGHT, DIM_DATE)


def winner_state(spec: TableSpec) -> TableSpec:
    """Per key of a dimension: the place of the core row it shows, and how many core rows have the key."""
    keys = {k: spec.columns[k] for k in spec.key}
    return TableSpec(f"{spec.name}_state", {**keys, "winner_day": DATE, "winner_index": LONG, "uses": LONG}, key=spec.key)


DIMENSION_STATES = {s.name: winner_state(s) for s in DIMENSIONS}

# What a fact is about. Of the core rows that state one, the newest is the fact and the others wait in quarantine.
STATED = ("passenger_id", "flight_id", "departure_date")
_STATING = {
    "passenger_id": STRING, "flight_id": STRING, "departure_date": DATE, "index_col": LONG,
    "arrival_airport": STRING, "passenger_status": STRING, "ticket_type": STRING,
}
FACT_STATE = TableSpec(f"{FACT.name}_state", {**_STATING, "id": STRING}, key=STATED)
FACT_QUARANTINE = TableSpec(
    "mart_stage.fact_quarantine", {**_STATING, "violations": T.ArrayType(STRING)}, key=("index_col",)
)

# Columns a change row carries next to the table's own.
CHANGE_COLUMNS = {"_action": STRING, "_is_update": BOOL, "_row_id": STRING}
