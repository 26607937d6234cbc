"""Fingerprints of plan shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def portable_id(*parts: Column) -> Column:
    """Sixteen hexadecimal digits of the md5 of the parts: slower than ``shape_hash``, equal in other engines."""
    return F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 16)


def shape_hash(nodes: DataFrame, key: str, static: list[str], profile: str = "simple", verbose: bool = False) -> DataFrame:
    """A 64-bit hash of each plan: its nodes' static columns in pre-order, with path, profile and verbosity.
    A plan's nodes are one row's worth of list, bounded by the plan."""
    node = F.xxhash64(F.concat_ws(",", F.transform("node_path", lambda x: x.cast("string"))), *[F.col(c) for c in static])
    ordered = nodes.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("node_path", node.alias("h")))).alias("tree"))
    seed = F.xxhash64(F.lit(profile), F.lit(verbose))
    return ordered.select(key, F.aggregate("tree", seed, lambda acc, n: F.xxhash64(acc, n["h"])).alias("shape_hash"))
