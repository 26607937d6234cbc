"""The template dictionary: a plan shape is stored once and later records refer to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rotation import running_total

MAX_TEMPLATES = 4096
#: Dictionaries up to this size are numbered in one task and broadcast; larger ones by ranges and joined by shuffle.
SMALL = 100_000
RANGES = 256


def admitted(log: DataFrame, key: list[str], order: list[str], cap: int | None = MAX_TEMPLATES, within: list[str] | None = None) -> DataFrame:
    """(within.., key.., first, template_id) of the first ``cap`` shapes seen (None: of all), numbered by first sight.

    First sights are found by a map-side minimum. Without ``within`` a small cap is a top-k, so no window ever
    meets more than ``cap`` rows, and beyond ``SMALL`` rows are numbered range by range; with it, dictionaries are numbered apart."""
    within = within or []
    first = log.groupBy(*within, *key).agg(F.min(F.struct(*order)).alias("first"))
    if within:
        w = Window.partitionBy(*within).orderBy("first")
        numbered = first.withColumn("template_id", F.row_number().over(w).cast("long"))
        return numbered if cap is None else numbered.where(F.col("template_id") <= cap)
    if cap is None or cap > SMALL:
        # Ranges of the first column of the order: what is in a range is numbered there, and shifted by what is before it.
        at = F.col(f"first.{order[0]}")
        cuts = first.agg(F.percentile_approx(at, [i / RANGES for i in range(1, RANGES)], 10 * RANGES).alias("c")).first()["c"] or []
        bounds = F.array(*[F.lit(x) for x in sorted(set(cuts))]).cast(f"array<{first.select(at).dtypes[0][1]}>")
        numbered = running_total(first, F.lit(1).cast("long"), F.size(F.filter(bounds, lambda b: b < at)), ["first"], "template_id")
        return numbered if cap is None else numbered.where(F.col("template_id") <= cap)
    top = first.orderBy("first").limit(cap)
    return top.withColumn("template_id", F.row_number().over(Window.orderBy("first")).cast("long"))


def with_mode(log: DataFrame, key: list[str], order: list[str], cap: int | None = MAX_TEMPLATES, within: list[str] | None = None, eligible: Column | None = None) -> DataFrame:
    """Add ``template_mode`` (none, define, ref) and ``template_id``."""
    fit = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    some = log.where(fit) if eligible is not None else log
    names = admitted(some, key, order, cap, within)
    on = [*(within or []), *key]
    right = F.broadcast(names) if not within and cap is not None and cap <= SMALL else names  # without ``within`` there are cap rows at most
    joined = log.withColumn("_fit", fit).join(right, on, "left")
    known = F.col("_fit") & F.col("template_id").isNotNull()
    mode = F.when(~known, "none").when(F.struct(*order) == F.col("first"), "define").otherwise("ref")
    return joined.withColumn("template_mode", F.when(known.isNull(), "none").otherwise(mode)).withColumn("template_id", F.when(known, F.col("template_id"))).drop("first", "_fit")


def restored(log: DataFrame, text: str, within: list[str] | None = None) -> DataFrame:
    """References that left out their text get their template's; the definition of an id that comes last counts."""
    on = [*(within or []), "template_id"]
    texts = log.where("template_mode = 'define'").groupBy(*on).agg(F.max_by(text, "record_no").alias("_text"))
    return log.join(texts, on, "left").withColumn(text, F.coalesce(F.col(text), F.col("_text"))).drop("_text")


def overlay(nodes: DataFrame, metrics: DataFrame, on: list[str], dynamic: list[str]) -> DataFrame:
    """Template nodes with what one execution measured: dynamic columns are replaced, absent ones become
    null; details are the template's followed by the execution's."""
    plain = [c for c in nodes.columns if c not in dynamic and c != "details"]
    m = metrics.withColumnRenamed("details", "_details") if "details" in metrics.columns else metrics
    joined = nodes.select(*plain, *(["details"] if "details" in nodes.columns else [])).join(m, on, "left")
    if "_details" in joined.columns:
        empty = F.array().cast(nodes.schema["details"].dataType)
        joined = joined.withColumn("details", F.concat(F.coalesce("details", empty), F.coalesce("_details", empty))).drop("_details")
    return joined


def static_details(details: Column, dynamic_codes: list[int]) -> Column:
    """What of the details belongs to the shape and not to one execution."""
    return F.filter(details, lambda d: ~d["code"].isin(dynamic_codes))


def unresolved(log: DataFrame, within: list[str] | None = None) -> DataFrame:
    """References that come before their definition, which no reader can resolve."""
    on = [*(within or []), "template_id"]
    first = log.where("template_mode = 'define'").groupBy(*on).agg(F.min("record_no").alias("_first"))
    return log.where("template_mode = 'ref'").join(first, on, "left").where(F.col("_first").isNull() | (F.col("record_no") < F.col("_first"))).drop("_first")
