"""Changes to tables as copy-on-write: each returns the table as it is afterwards."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update(table: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Rows that meet the condition get the values; where it is null they stay as they are."""
    hit = F.coalesce(condition, F.lit(False))
    return table.withColumns({k: F.when(hit, v).otherwise(F.col(k)) for k, v in values.items()})


def delete(table: DataFrame, condition: Column) -> DataFrame:
    return table.where(~F.coalesce(condition, F.lit(False)))


def _marked(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """A column that is null only where an outer join has no row; no constant, which might be folded past the join."""
    return df.withColumn(name, F.xxhash64(*keys))


def insert_on_conflict(table: DataFrame, rows: DataFrame, keys: list[str], do_nothing: bool = False) -> DataFrame:
    """Insert rows; on a key that the table has, the row's columns replace the table's, or nothing happens."""
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    both = _marked(table, "_t", keys).alias("t").join(_marked(rows, "_s", keys).alias("s"), on, "full")
    old_wins = F.col("_t").isNotNull() & (F.lit(do_nothing) | F.col("_s").isNull())
    columns = [F.when(old_wins, F.col(f"t.{k}")).otherwise(F.col(f"s.{k}") if k in rows.columns else F.col(f"t.{k}")).alias(k) for k in table.columns]
    return both.select(*columns)


@dataclass
class When:
    """A rule of MERGE: for ``matched``, ``not matched`` (by target) or ``not matched by source`` rows,
    under a condition over ``t`` and ``s``: ``update``, ``insert``, ``delete`` or ``nothing``."""

    match: str
    condition: Column | None
    action: str
    values: dict[str, Column] = field(default_factory=dict)


def _acted(table: DataFrame, rows: DataFrame, keys: list[str], rules: list[When]) -> DataFrame:
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    both = _marked(table, "_t", keys).alias("t").join(_marked(rows, "_s", keys).alias("s"), on, "full")
    kind = F.when(F.col("_t").isNull(), "not matched").when(F.col("_s").isNull(), "not matched by source").otherwise("matched")
    rule, action = F.lit(-1), F.lit("nothing")
    for i, r in reversed(list(enumerate(rules))):
        applies = (kind == r.match) & (F.coalesce(r.condition, F.lit(False)) if r.condition is not None else F.lit(True))
        rule, action = F.when(applies, i).otherwise(rule), F.when(applies, r.action).otherwise(action)
    return both.withColumns({"_rule": rule, "_action": action})


def merge(table: DataFrame, rows: DataFrame, keys: list[str], rules: list[When]) -> DataFrame:
    """The table after MERGE: of each row's rules, the first that applies acts."""
    acted = _acted(table, rows, keys, rules)
    kept = acted.where((F.col("_action") != "delete") & (F.col("_t").isNotNull() | (F.col("_action") == "insert")))

    def value(k: str) -> Column:
        out = F.when(F.col("_t").isNull(), F.col(f"s.{k}") if k in rows.columns else F.lit(None)).otherwise(F.col(f"t.{k}"))
        for i, r in enumerate(rules):
            if r.action in ("update", "insert") and k in r.values:
                out = F.when(F.col("_rule") == i, r.values[k]).otherwise(out)
        return out.alias(k)

    return kept.select(*[value(k) for k in table.columns])


def merge_counts(table: DataFrame, rows: DataFrame, keys: list[str], rules: list[When]) -> DataFrame:
    """How many rows MERGE inserts, updates, deletes and leaves."""
    acted = _acted(table, rows, keys, rules)
    return acted.agg(*[F.count_if(F.col("_action") == a).alias(n) for a, n in (("insert", "inserted"), ("update", "updated"), ("delete", "deleted"), ("nothing", "skipped"))])
