"""Every operator as a query over the driver tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbrook.functions.dates import date_parts, hours_before
from tarnbrook.functions.keys import fact_id, flight_id
from tarnbrook.functions.text import null_tokens
from tarnbrook.operators.changes import as_of, change_pairs, has_changes, net_changes, net_changes_between
from tarnbrook.operators.dedupe import latest_per_key
from tarnbrook.operators.lookup import find_hot_keys, lookup
from tarnbrook.operators.merge import Merge, rows_affected
from tarnbrook.operators.policy import RowPolicy, flights_airports_secure
from tarnbrook.operators.quality import VIOLATIONS, Rule, key_report, not_null, reference_report, tag_violations, width
from tarnbrook.operators.surrogate import assign_surrogate_keys
from tarnbrook.plans.mart import flights_by_continent, flights_by_day
from tarnbrook.plans.passengers import typed_core
from tarnbrook.plans.star import (
    AIRPORT_PLAN, DATE_PLAN, FLIGHT_PLAN, PASSENGER_PLAN, DimensionPlan, build_dimension, build_star, core_merge,
    literal_dimension_merge, literal_fact_merge, scd1_merge,
)
from tarnbrook.plans.trade_feed import as_passengers, csv_line, joined_lines, numbered_rows, passenger_rows, read_table, tie_break
from tarnbrook.plans.warehouse import Warehouse
from tarnbrook.schemas import FACT, LONG, RAW_COLUMNS, STRING, TableSpec
from tarnbrook.session import materialize, scratch_path, scratch_scope
from tarnbrook.sources.csv_files import (
    BAD, list_files, load_history, not_loaded, read_csv, recent_loads, write_lines,
)
from tarnbrook.sources.tables import Catalog, LogTable, live_state, union_all
from tarnbrook.streaming.incremental import load_stream, merge_stream

# Latest event per user: the small table the merge and change queries work on.
USERS = TableSpec(
    "users", {"user_id": LONG, "event_id": LONG, "event_type": STRING, "amount": STRING},
    key=("user_id",),
)
EVENTS = TableSpec("events", {"event_id": LONG, "user_id": LONG, "event_type": STRING, "amount": STRING}, key=("event_id",))


NEWEST = ["ts desc", "event_id desc"]


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# -- loading and typing --------------------------------------------------------


def raw_null_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Null tokens of a text column, here 'P' and the empty text."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return null_tokens(orders, ["o_orderstatus", "o_orderpriority"], ("P", ""))


def _order_lines(spark: SparkSession, folder: str) -> str:
    """Orders as CSV files with deliberate errors: an extra cell on finished urgent
    orders, a missing one on finished low ones, null tokens and quoted cells elsewhere."""
    orders = read_table(spark, folder, "orders")
    status = F.when(F.col("o_orderstatus") == "P", "NULL").otherwise(F.col("o_orderstatus"))
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    low = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    quoted = F.concat(F.lit('"'), F.regexp_replace("o_orderpriority", "-", ',""'), F.lit('"'))
    customer = F.when(F.col("o_orderpriority") == "2-HIGH", "").otherwise(F.col("o_custkey").cast("string"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), customer, status)
    line = F.when(low, line).otherwise(F.concat_ws(",", line, quoted))
    line = F.when(urgent, F.concat_ws(",", line, F.lit("extra"))).otherwise(line)
    target = scratch_path(spark, "csv-orders")
    write_lines(orders, line, ",Customer,Status,Priority", target)
    return target


_ORDER_SCHEMA = TableSpec("orders_text", {c: STRING for c in ("order_key", "cust_key", "status", "priority")}).schema


def csv_load(spark: SparkSession, folder: str) -> DataFrame:
    """Tolerant load: header skipped, quotes undone, null tokens replaced, bad rows left out."""
    rows = materialize(read_csv(spark, _order_lines(spark, folder), _ORDER_SCHEMA), "csv-rows")
    return rows.where(F.col(BAD).isNull()).select(*_ORDER_SCHEMA.names)


def load_history_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Load history of events written as CSV, one file per type in the order of event_id; error rows have a cell too many."""
    events = read_table(spark, folder, "events")
    cells = [F.col(c).cast("string") for c in ("event_id", "user_id", "event_type")]
    line = F.concat_ws(",", *cells, F.when(F.col("value") > 20, F.lit("high")))
    target = scratch_path(spark, "csv-events")
    lines = events.repartition("event_type").sortWithinPartitions("event_type", "event_id").select(line.alias("event,user,type"), F.col("event_type"))
    lines.write.partitionBy("event_type").options(
        header=True, sep="\x01", quote="\x00", escape="\x00", quoteMode="NONE"
    ).csv(target)
    schema = TableSpec("events_text", {c: STRING for c in ("event", "user", "type")}).schema
    rows = materialize(read_csv(spark, f"{target}/*", schema), "csv-rows")
    history = load_history(rows, F.current_timestamp(), 3)
    return history.select(
        F.regexp_extract("file_path", "event_type=([^/]+)", 1).alias("event_type"),
        "status", "rows_parsed", "rows_loaded", "error_rows", "first_error_line_number", "first_error_message",
    )


def csv_quoted_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks and quotes inside cells, written as CSV and read by lines."""
    documents = read_table(spark, folder, "documents").select("doc_id", "text", "source")
    target = scratch_path(spark, "csv-documents")
    documents.write.options(
        header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(target)
    schema = TableSpec("documents_text", {c: STRING for c in ("doc_id", "text", "source")}).schema
    rows = materialize(read_csv(spark, target, schema), "csv-rows")
    breaks = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit("")))
    return rows.where(F.col(BAD).isNull()).select(
        "doc_id", "source", breaks.cast("long").alias("n_breaks"), F.md5(F.col("text").cast("binary")).alias("text_md5")
    )


def load_once(spark: SparkSession, folder: str) -> DataFrame:
    """A second look at a folder loads the files that came since the first; known names stay out."""
    events = _events(spark, folder)
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.col("event_type"))
    inbox = scratch_path(spark, "inbox")
    write_lines(events.where(F.col("ts") < moment(MIDDLE)), line, ",User,Type", inbox)
    history = materialize(list_files(spark, inbox).select("file_name"), "history")
    write_lines(events.where(F.col("ts") >= moment(MIDDLE)), line, ",User,Type", inbox)
    paths = [r["file_path"] for r in not_loaded(list_files(spark, inbox), history).toLocalIterator()]  # names only
    schema = TableSpec("events_text", {c: STRING for c in ("event_id", "user_id", "event_type")}).schema
    return read_csv(spark, paths, schema).select(*schema.names)


def staging_refill(spark: SparkSession, folder: str) -> DataFrame:
    """A staging table filled with one state, then truncated and filled with the next from SELECT."""
    events = _events(spark, folder)
    staging = LogTable(spark, scratch_path(spark, "staging"), EVENTS)
    staging.replace(events.where(F.col("ts") < moment(MIDDLE)))
    staging.replace(events.where(F.col("ts") >= moment(MIDDLE)))
    staging.append(events.where((F.col("ts") < moment(MIDDLE)) & gone()))
    return staging.read()


def recent_load_window(spark: SparkSession, folder: str) -> DataFrame:
    """Events of the hour before the newest one, the events taken as load times."""
    events = read_table(spark, folder, "events")
    newest = events.agg(F.max("ts")).first()[0]
    return recent_loads(events, f"timestamp_ntz '{newest}'", 1, "ts").select("event_id", "user_id", "event_type")


def typed_text(spark: SparkSession, folder: str) -> DataFrame:
    """Typed core columns from text: fractions round, bad numbers and foreign date forms become NULL."""
    lines = read_table(spark, folder, "lineitem")
    text = {c: "cast(null as string)" for c in RAW_COLUMNS}
    text["index_col"] = "cast(cast(l_extendedprice as decimal(12,2)) as string)"
    text["passenger_id"] = "cast(l_orderkey as string)"
    text["first_name"] = "cast(l_partkey as string)"
    text["age"] = "if(l_returnflag = 'R', concat(cast(l_linenumber as string), 'x'), cast(l_quantity as string))"
    text["departure_date"] = "if(l_linestatus = 'F', date_format(l_shipdate, 'yyyy-MM-dd'), date_format(l_shipdate, 'M/d/yyyy'))"
    typed = typed_core(lines.selectExpr(*[f"{e} as {c}" for c, e in text.items()]))
    return typed.select("index_col", F.col("passenger_id").alias("order_key"), F.col("first_name").alias("part_key"),
                        "age", "departure_date")


def scalar_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Every scalar function of the load: hash, trim, case, text of dates, date parts, hour arithmetic, casts."""
    lines = read_table(spark, folder, "lineitem").join(
        read_table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    day = "cast(l_shipdate as date)"
    pilot = "if(l_returnflag <> 'N', concat(' ', upper(s_name), '  '), null)"
    return lines.selectExpr(
        "l_orderkey", "l_partkey", "l_linenumber",
        f"{flight_id(pilot, 'l_linestatus', day, 'cast(l_suppkey as string)')} as flight_id",
        f"{fact_id('cast(l_orderkey as string)', 'l_partkey', day)} as fact_id",
        *[f"{e} as {n}" for n, e in date_parts(day).items()],
        f"date_format({hours_before('cast(l_shipdate as timestamp_ntz)', 1)}, 'yyyy-MM-dd HH:mm') as hour_before",
        f"date_format({day}, 'yyyyMMdd') as day_text",
        "l_returnflag is not null as has_flag",
    )


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that break a rule, with the broken rules in rule order."""
    orders = null_tokens(read_table(spark, folder, "orders"), ["o_orderstatus"], ("P", ""))
    rules = [not_null("o_orderstatus"), width("o_orderpriority", 8),
             Rule("o_totalprice:limit", "o_totalprice <= 300000")]
    tagged = tag_violations(orders, rules).where(F.size(VIOLATIONS) > 0)
    return tagged.select("o_orderkey", F.array_join(VIOLATIONS, ",").alias("violations"))


# -- star schema -----------------------------------------------------------------


def _dimension(plan: DimensionPlan) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return build_dimension(passenger_rows(spark, folder), plan, tie_break())

    return query


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_name")
    return assign_surrogate_keys(customers, ["c_custkey"], "customer_sk")


def star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The joined rows are written once and read by all five loads."""
    return build_star(as_passengers(materialize(joined_lines(spark, folder), "core")), tie_break())


def hot_key_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Surrogate keys of order priorities, each of which holds a fifth of all rows."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    known = orders.where("o_orderpriority <> '3-MEDIUM'").select("o_orderpriority").distinct()
    priorities = assign_surrogate_keys(known, ["o_orderpriority"], "priority_sk")
    hot = find_hot_keys(orders, ["o_orderpriority"])["o_orderpriority"]
    return lookup(orders, priorities, "o_orderpriority", hot, ["o_orderkey"])


def fact_build(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder)[FACT.name]


def mart_daily(spark: SparkSession, folder: str) -> DataFrame:
    return flights_by_day(star(spark, folder))


def mart_region(spark: SparkSession, folder: str) -> DataFrame:
    return flights_by_continent(star(spark, folder))


# -- merges ------------------------------------------------------------------------


def _events(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    return events.select("event_id", "user_id", "event_type", F.col("value").cast("decimal(18,2)").cast("string").alias("amount"),
                         F.col("ts").cast("timestamp_ntz").alias("ts"))


CUT = "2024-01-02 00:00:00"
MIDDLE = "2024-01-16 00:00:00"


def _core_merge(spark: SparkSession, folder: str) -> Merge:
    """Events up to the middle of the month meet all events as changes: errors delete,
    purchases update (a changed user stays out of the update), the rest inserts."""
    events = _events(spark, folder)
    target = events.where(F.col("ts") < moment(MIDDLE)).select(*EVENTS.columns)
    bought = F.col("event_type") == "purchase"
    source = events.select(
        "event_id",
        F.when(bought, F.col("user_id") + 1000).otherwise(F.col("user_id")).alias("user_id"),
        "event_type",
        F.when(bought, F.concat("amount", F.lit("+"))).otherwise(F.col("amount")).alias("amount"),
        F.when(F.col("event_type") == "error", "DELETE").otherwise("INSERT").alias("_action"),
        bought.alias("_is_update"),
    )
    return core_merge(target, source, EVENTS, fixed=("user_id",))


def _users(events: DataFrame, upto: Column) -> DataFrame:
    return latest_per_key(events.where(upto), ["user_id"], NEWEST)


def _user_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Users as of the cut, and the latest later event per user as change (error = delete)."""
    events = _events(spark, folder)
    before = F.col("ts") < moment(CUT)
    target = _users(events, before).where("event_type <> 'error'").select(*USERS.columns)
    source = _users(events, ~before).withColumn(
        "_action", F.when(F.col("event_type") == "error", "DELETE").otherwise("INSERT")
    )
    return target, source.select(*USERS.columns, "_action")


def _scd1(spark: SparkSession, folder: str) -> Merge:
    return scd1_merge(*_user_tables(spark, folder), USERS)


def _literal(spark: SparkSession, folder: str) -> Merge:
    return literal_dimension_merge(*_user_tables(spark, folder), USERS)


def _fact_merge(spark: SparkSession, folder: str) -> Merge:
    """Line items shipped before 1998 as target, all as new facts."""
    day = F.date_format("l_shipdate", "yyyyMMdd")
    facts = read_table(spark, folder, "lineitem").select(
        F.expr(fact_id("cast(l_orderkey as string)", "l_partkey", "cast(l_shipdate as date)")).alias("id"),
        F.col("l_orderkey").alias("passenger_sk"), F.col("l_partkey").alias("flight_sk"),
        F.col("l_suppkey").alias("airport_sk"), day.cast("long").alias("date_sk"),
        F.col("l_linestatus").alias("passenger_status"), F.col("l_returnflag").alias("ticket_type"),
        F.lit("INSERT").alias("_action"),
    )
    target = facts.where(F.col("date_sk") < 19980101).select(*FACT.columns)
    return literal_fact_merge(target, facts)


def merge_core(spark: SparkSession, folder: str) -> DataFrame:
    return _core_merge(spark, folder).result()


def merge_core_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The change rows the same merge commits."""
    return _core_merge(spark, folder).changes()


def merge_scd1(spark: SparkSession, folder: str) -> DataFrame:
    return _scd1(spark, folder).result()


def merge_literal(spark: SparkSession, folder: str) -> DataFrame:
    return _literal(spark, folder).result()


def merge_fact(spark: SparkSession, folder: str) -> DataFrame:
    return _fact_merge(spark, folder).result()


def merge_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rows_affected(_core_merge(spark, folder).metrics())


# -- change capture and time travel ----------------------------------------------

FIRST, SECOND = "2024-01-15 00:00:00", "2024-01-25 00:00:00"


def gone() -> Column:
    return F.col("event_type") == "error"


def _net(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    return net_changes_between(events, ["user_id"], ["ts", "event_id"], moment(FIRST), moment(SECOND), gone())


def cdc_net_changes(spark: SparkSession, folder: str) -> DataFrame:
    return _net(spark, folder).select(
        "user_id", "change", F.col("old.event_id").alias("old_event"), F.col("new.event_id").alias("new_event")
    )


def cdc_snapshot_diff(spark: SparkSession, folder: str) -> DataFrame:
    """The same from two finished states of the table."""
    events = _events(spark, folder)
    states = [
        as_of(events, ["user_id"], NEWEST, F.col("ts") <= moment(m), gone()).select(*USERS.columns)
        for m in (FIRST, SECOND)
    ]
    return net_changes(*states, ["user_id"]).select("user_id", "change", F.col("new.amount").alias("amount"))


def cdc_pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = change_pairs(_net(spark, folder), ["user_id"])
    return pairs.select("user_id", "event_id", "event_type", "_action", "_is_update", "_row_id")


def stream_has_data(spark: SparkSession, folder: str) -> DataFrame:
    return has_changes(_net(spark, folder))


def as_of_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    return as_of(events, ["user_id"], NEWEST, F.col("ts") <= moment(FIRST), gone()).select(*USERS.columns)


def before_statement(spark: SparkSession, folder: str) -> DataFrame:
    """State just before the statement that changed a table, found by the statement's id."""
    table = LogTable(spark, scratch_path(spark, "users"), USERS)
    events = _events(spark, folder)
    table.append(as_of(events, ["user_id"], NEWEST, F.col("ts") <= moment(FIRST), gone()))
    changed = table.apply(change_pairs(_net(spark, folder), ["user_id"]))
    table.compact()
    return LogTable(spark, table.path, USERS).before(changed.statement_id)


def clone_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Two commits to a table, a clone at the moment of the first, a drop and an undrop of the clone."""
    catalog = Catalog(spark, scratch_path(spark, "catalog"))
    catalog.ensure(USERS)
    table = catalog.table(USERS)
    events = _events(spark, folder)
    first = table.append(as_of(events, ["user_id"], NEWEST, F.col("ts") <= moment(FIRST), gone()))
    table.apply(change_pairs(_net(spark, folder), ["user_id"]))
    catalog.clone("users_from_past", table, first.commit_ts)
    catalog.drop("users_from_past")
    catalog.undrop("users_from_past")
    return catalog.table(USERS, "users_from_past").read()


def table_after_changes(spark: SparkSession, folder: str) -> DataFrame:
    """A state plus the net changes to the next state gives the next state."""
    events = _events(spark, folder)
    table = LogTable(spark, scratch_path(spark, "users"), USERS)
    table.append(as_of(events, ["user_id"], NEWEST, F.col("ts") <= moment(FIRST), gone()))
    table.apply(change_pairs(_net(spark, folder), ["user_id"]))
    return table.read()


def undrop(spark: SparkSession, folder: str) -> DataFrame:
    """Names dropped by error events and brought back by sign-ups: the last of both counts."""
    events = _events(spark, folder).where(F.col("event_type").isin("error", "signup"))
    return live_state(events, ["user_id"], ["ts", "event_id"], "event_type", "error").select("user_id", "last_event", "live")


# -- access and constraints --------------------------------------------------------


def secure_view(spark: SparkSession, folder: str) -> DataFrame:
    """First 100 orders by hash id with the customer's nation, then the Europe policy."""
    orders = read_table(spark, folder, "orders").join(
        read_table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    fact = orders.select(
        F.md5(F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_custkey").alias("passenger_sk"), F.col("o_orderkey").alias("flight_sk"),
        F.col("c_nationkey").alias("airport_sk"), F.to_date("o_orderdate").alias("date_sk"),
    )
    airports = read_table(spark, folder, "nation").join(
        read_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        F.col("n_nationkey").alias("airport_sk"), F.col("n_name").alias("airport_name"),
        F.substring("n_name", 8, 2).alias("airport_code"), F.col("n_name").alias("country_name"),
        F.col("r_name").alias("continent_name"),
    )
    europe = RowPolicy("continent_europe", lambda continent: continent == "EUROPE")
    return flights_airports_secure(fact, airports, europe)


def constraint_report(spark: SparkSession, folder: str) -> DataFrame:
    tables = {n: read_table(spark, folder, n) for n in ("lineitem", "orders", "part", "supplier", "customer")}
    return union_all([
        key_report(tables["lineitem"], "lineitem", ["l_orderkey", "l_linenumber"]),
        key_report(tables["orders"], "orders", ["o_orderkey"]),
        reference_report(tables["lineitem"], "lineitem", "l_orderkey", tables["orders"], "o_orderkey"),
        reference_report(tables["lineitem"], "lineitem", "l_partkey", tables["part"], "p_partkey"),
        reference_report(tables["lineitem"], "lineitem", "l_suppkey", tables["supplier"], "s_suppkey"),
        reference_report(tables["orders"], "orders", "o_custkey", tables["customer"], "c_custkey"),
    ])


# -- incremental runs --------------------------------------------------------------

SLICES = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")


def stream_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Events arrive in three steps; each run of the stream takes the new files and merges them."""
    events = _events(spark, folder)
    inbox, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "offsets")
    table = LogTable(spark, scratch_path(spark, "users"), USERS)

    def merge_batch(batch: DataFrame, batch_id: str) -> None:
        if table.has_batch(batch_id):
            return
        newest = latest_per_key(batch, ["user_id"], NEWEST)
        source = newest.withColumn("_action", F.when(gone(), "DELETE").otherwise("INSERT"))
        source = materialize(source.select(*USERS.columns, "_action"), "batch", spark)
        table.apply(scd1_merge(table.read(), source, USERS).changes(), batch_id=batch_id)

    bounds = [None, *SLICES, None]
    for low, high in zip(bounds, bounds[1:]):
        part = events if low is None else events.where(F.col("ts") >= moment(low))
        part = part if high is None else part.where(F.col("ts") < moment(high))
        part.write.mode("append").parquet(inbox)
        arriving = spark.readStream.schema(events.schema).parquet(inbox)
        merge_stream(arriving, merge_batch, checkpoint, "users")
    return table.read()


def warehouse_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files through the whole warehouse in two arrivals, reported by continent and year."""
    with scratch_scope(spark, keep_last=True):
        rows = materialize(numbered_rows(spark, folder).select(*RAW_COLUMNS), "rows")
    inbox, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "offsets")
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    early = F.col("departure_date") < F.lit("1998-06-01").cast("date")
    for arrival in (rows.where(early), rows.where(~early)):
        write_lines(arrival, csv_line(), ",".join(["", *RAW_COLUMNS[1:]]), inbox, compression="gzip")
        load_stream(warehouse, inbox, checkpoint)
    return flights_by_continent(warehouse.star())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_null_tokens": raw_null_tokens,
    "csv_load": csv_load,
    "load_history": load_history_by_type,
    "csv_quoted_breaks": csv_quoted_breaks,
    "load_once": load_once,
    "staging_refill": staging_refill,
    "recent_load_window": recent_load_window,
    "typed_core": typed_text,
    "scalar_functions": scalar_functions,
    "quarantine": quarantine,
    "dim_passenger": _dimension(PASSENGER_PLAN),
    "dim_airport": _dimension(AIRPORT_PLAN),
    "dim_flight": _dimension(FLIGHT_PLAN),
    "dim_date": _dimension(DATE_PLAN),
    "surrogate_keys": surrogate_keys,
    "hot_key_lookup": hot_key_lookup,
    "fact_build": fact_build,
    "mart_daily": mart_daily,
    "mart_region": mart_region,
    "merge_core": merge_core,
    "merge_core_changes": merge_core_changes,
    "merge_scd1": merge_scd1,
    "merge_literal": merge_literal,
    "merge_fact": merge_fact,
    "merge_metrics": merge_metrics,
    "cdc_net_changes": cdc_net_changes,
    "cdc_snapshot_diff": cdc_snapshot_diff,
    "cdc_pairs": cdc_pairs,
    "stream_has_data": stream_has_data,
    "as_of_timestamp": as_of_timestamp,
    "before_statement": before_statement,
    "clone_as_of": clone_as_of,
    "table_after_changes": table_after_changes,
    "undrop": undrop,
    "secure_view": secure_view,
    "constraint_report": constraint_report,
    "stream_incremental": stream_incremental,
    "warehouse_incremental": warehouse_incremental,
}
