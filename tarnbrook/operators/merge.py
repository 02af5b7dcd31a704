"""MERGE of a change source into a target, as joins.

Conditions and values are SQL expressions that see the target as ``t`` and the
source as ``s``. Of the matched clauses the first whose condition holds
applies. NULL keys match nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION, IS_UPDATE = "_action", "_is_update"


@dataclass(frozen=True)
class Matched:
    """WHEN MATCHED AND ``when`` THEN UPDATE SET ``assign``, or DELETE if that is None."""

    when: str = "true"
    assign: dict[str, str] | None = None


@dataclass(frozen=True)
class NotMatched:
    """WHEN NOT MATCHED AND ``when`` THEN INSERT ``values``."""

    values: dict[str, str]
    when: str = "true"


def from_source(columns: list[str]) -> dict[str, str]:
    return {c: f"s.`{c}`" for c in columns}


def any_difference(columns: list[str]) -> str:
    """True where source and target differ in one of ``columns`` (NULL equals NULL)."""
    return "(" + " or ".join(f"not (s.`{c}` <=> t.`{c}`)" for c in columns) + ")"


class Merge:
    """Lazy plans for one MERGE.

    ``source_is_unique`` promises one source row per key and allows conditions on
    ``t``. Otherwise conditions may use ``s`` only, repeated source rows are
    reduced per key first (a partial aggregate, so a hot key is combined
    map-side) and a target row hit by contradicting clauses raises an error.
    """

    def __init__(
        self,
        target: DataFrame,
        source: DataFrame,
        on: list[str],
        matched: list[Matched],
        not_matched: NotMatched | None = None,
        source_is_unique: bool = False,
    ):
        self.target, self.source, self.on = target, source, list(on)
        self.matched, self.not_matched = matched, not_matched
        self.source_is_unique = source_is_unique
        self.columns = target.columns
        self._types = dict(target.dtypes)

    # -- expressions -------------------------------------------------------

    def _clause(self) -> str:
        """Number of the first matched clause that holds, NULL if none does."""
        cases = " ".join(f"when ({c.when}) then {n}" for n, c in enumerate(self.matched))
        return f"case {cases} end" if cases else "cast(null as int)"

    def _is(self, delete: bool) -> str:
        numbers = [str(n) for n, c in enumerate(self.matched) if (c.assign is None) == delete]
        return f"coalesce(_clause in ({', '.join(numbers)}), false)" if numbers else "false"

    def _updated(self, column: str) -> str:
        cases = " ".join(
            f"when {n} then cast({c.assign[column]} as {self._types[column]})"
            for n, c in enumerate(self.matched) if c.assign and column in c.assign
        )
        return f"case _clause {cases} else t.`{column}` end" if cases else f"t.`{column}`"

    def _inserted(self, column: str) -> str:
        values = self.not_matched.values if self.not_matched else {}
        return f"cast({values.get(column, 'null')} as {self._types[column]})"

    def _insert_when(self) -> str:
        return f"coalesce(({self.not_matched.when}), false)" if self.not_matched else "false"

    def _on(self) -> Column:
        return F.expr(" and ".join(f"s.`{k}` = t.`{k}`" for k in self.on))

    # -- source preparation ------------------------------------------------

    @cached_property
    def _acting(self) -> DataFrame:
        """Non-unique path: per key the one clause that acts, with its source row."""
        present = " and ".join(f"`{k}` is not null" for k in self.on)
        row = ", ".join(f"`{c}`" for c in self.source.columns)
        reduced = (
            self.source.alias("s").selectExpr("s.*", f"{self._clause()} as _clause")
            .where(f"_clause is not null and {present}")
            .groupBy(*self.on)
            .agg(
                F.expr(f"count_if({self._is(delete=False)})").alias("_n_update"),
                F.expr(f"count_if({self._is(delete=True)})").alias("_n_delete"),
                F.min("_clause").alias("_clause"),
                F.expr(f"max(struct({row}))").alias("_row"),
            )
        )
        rest = [f"_row.`{c}` as `{c}`" for c in self.source.columns if c not in self.on]
        clash = "_n_update > 1 or (_n_update > 0 and _n_delete > 0)"
        return reduced.selectExpr(*self.on, *rest, "_clause as _reduced", f"{clash} as _clash")

    def _checked(self) -> str:
        message = f"several source rows change one target row on {', '.join(self.on)}"
        return f"if(s._clash, cast(raise_error('{message}') as int), s._reduced)"

    @cached_property
    def _inserting(self) -> DataFrame:
        """Non-unique path: unmatched source rows the insert clause takes."""
        keys = self.target.select(*self.on)
        return self.source.alias("s").join(keys.alias("t"), self._on(), "left_anti").where(self._insert_when())

    # -- results -----------------------------------------------------------

    def changes(self) -> DataFrame:
        """Net effect as change rows: target columns, ``_action``, ``_is_update``.

        An update is a DELETE row with the old and an INSERT row with the new
        values. The target is cut to the rows the source touches before any of
        its other columns are shuffled; for a small source Catalyst does that
        map-side with a broadcast it has checked the size of.
        """
        keys = self.source.select(*self.on)
        hit = self.target.alias("t").join(keys.alias("s"), self._on(), "left_semi").withColumn("_hit", F.lit(True))
        if self.source_is_unique:
            pairs = self.source.alias("s").join(hit.alias("t"), self._on(), "left")
            pairs = pairs.withColumn("_clause", F.expr(f"if(t._hit, {self._clause()}, null)"))
            return self._images(pairs, f"t._hit is null and {self._insert_when()}")
        acting = self._acting.alias("s").join(hit.alias("t"), self._on())
        acting = acting.withColumn("_clause", F.expr(self._checked()))
        fresh = self._inserting.selectExpr(
            *[f"{self._inserted(c)} as `{c}`" for c in self.columns],
            f"'INSERT' as {ACTION}", f"false as {IS_UPDATE}",
        )
        return self._images(acting, "false").unionByName(fresh)

    def inserts(self) -> DataFrame:
        """Change rows for an empty target: no join, the source rows the insert clause takes."""
        return self.source.alias("s").where(self._insert_when()).selectExpr(
            *[f"{self._inserted(c)} as `{c}`" for c in self.columns],
            f"'INSERT' as {ACTION}", f"false as {IS_UPDATE}",
        )

    def _images(self, pairs: DataFrame, inserts: str) -> DataFrame:
        """Turn each acting pair into its one or two change rows.

        A pair is multiplied by a short array of markers and each column then
        picks its image; that keeps the generated code small for wide tables.
        """
        halves = (
            f"case when {self._is(delete=False)} then array('old', 'new')"
            f" when {self._is(delete=True)} then array('gone')"
            f" when {inserts} then array('fresh') end"
        )
        images = pairs.withColumn("_half", F.explode(F.expr(halves)))
        return images.selectExpr(
            *[
                f"case _half when 'fresh' then {self._inserted(c)} when 'new' then {self._updated(c)}"
                f" else t.`{c}` end as `{c}`"
                for c in self.columns
            ],
            f"if(_half in ('new', 'fresh'), 'INSERT', 'DELETE') as {ACTION}",
            f"_half in ('old', 'new') as {IS_UPDATE}",
        )

    def result(self) -> DataFrame:
        """The whole new target: one full outer join for a unique source."""
        target = self.target.withColumn("_hit", F.lit(True)).alias("t")
        if self.source_is_unique:
            source = self.source.withColumn("_new", F.lit(True)).alias("s")
            both = target.join(source, self._on(), "full_outer")
            both = both.withColumn("_clause", F.expr(f"if(t._hit and s._new, {self._clause()}, null)"))
            both = both.where(
                f"(coalesce(t._hit, false) and not {self._is(delete=True)})"
                f" or (t._hit is null and {self._insert_when()})"
            )
            return both.selectExpr(*[
                f"if(t._hit, {self._updated(c)}, {self._inserted(c)}) as `{c}`" for c in self.columns
            ])
        both = target.join(self._acting.alias("s"), self._on(), "left").withColumn("_clause", F.expr(self._checked()))
        kept = both.where(f"not {self._is(delete=True)}").selectExpr(
            *[f"{self._updated(c)} as `{c}`" for c in self.columns]
        )
        return kept.unionByName(self._inserting.selectExpr(*[f"{self._inserted(c)} as `{c}`" for c in self.columns]))

    def metrics(self) -> DataFrame:
        """One row: rows inserted, updated, deleted."""
        return count_changes(self.changes())


def change_counters() -> list[Column]:
    return [
        F.expr(f"count_if({ACTION} = 'INSERT' and not {IS_UPDATE})").alias("inserted"),
        F.expr(f"count_if({ACTION} = 'INSERT' and {IS_UPDATE})").alias("updated"),
        F.expr(f"count_if({ACTION} = 'DELETE' and not {IS_UPDATE})").alias("deleted"),
    ]


def count_changes(changes: DataFrame) -> DataFrame:
    return changes.agg(*change_counters())


def rows_affected(metrics: DataFrame) -> DataFrame:
    """Sum of the three counters, each NULL counted as 0."""
    parts = [f"coalesce({c}, 0)" for c in ("inserted", "updated", "deleted")]
    return metrics.withColumn("rows_affected", F.expr(" + ".join(parts)))
