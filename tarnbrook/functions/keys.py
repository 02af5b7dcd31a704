"""Hash keys, as SQL over SQL: each is one shared expression, derived once per row."""

from __future__ import annotations


def flight_id(pilot: str, status: str, day: str, airport: str) -> str:
    """Flights carry no key of their own: pilot, status, day and airport identify one.

    ``concat`` (not ``concat_ws``) so that a NULL part gives a NULL key.
    """
    return f"md5(concat(trim(lower({pilot})), {status}, date_format({day}, 'yyyy-MM-dd'), {airport}))"


def fact_id(passenger_id: str, flight_sk: str, day: str) -> str:
    return f"md5(concat({passenger_id}, '|', cast({flight_sk} as string), '|', date_format({day}, 'yyyyMMdd')))"


def row_id(keys: list[str]) -> str:
    """Stable identity of a table row, from its key columns; NULLs stay distinct from text."""
    cells = ", ".join(f"`{k}`" for k in keys)
    return f"sha2(to_json(struct({cells}), map('ignoreNullFields', 'false')), 256)"
