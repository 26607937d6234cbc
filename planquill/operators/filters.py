"""Which statements are logged, and what of them: threshold, sample, nesting, flags, text, parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Query flags and their bits.
FLAGS = {"analyze": 1, "verbose": 2, "costs": 4, "timing": 8, "buffers": 16, "wal": 32, "query_text": 64, "params": 128}


def slow_enough(log: DataFrame, least_ms: float, duration: str = "duration_ms") -> DataFrame:
    """-1 logs nothing, 0 everything, else what took so long or longer."""
    return log.where(F.lit(False) if least_ms < 0 else F.col(duration) >= least_ms)


def hash_share(key: Column) -> Column:
    """A number in [0, 2**32) from the md5 of a key: the same in every engine."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")


def sampled(log: DataFrame, rate: float, statement: Column) -> DataFrame:
    """Keep ``rate`` of the top-level statements; nested ones go with the statement that they are part of."""
    if rate >= 1 or rate <= 0:
        return log.where(F.lit(rate >= 1))
    return log.where(hash_share(statement) < int(rate * (1 << 32)))


def nesting(log: DataFrame, nested: bool) -> DataFrame:
    return log if nested else log.where("depth = 0")


def encode_flags(values: dict[str, Column]) -> Column:
    """Buffers and WAL are only kept with analyze."""
    analyze = values.get("analyze", F.lit(False))
    out = F.lit(0)
    for name, bit in FLAGS.items():
        on = values.get(name, F.lit(False))
        if name in ("buffers", "wal"):
            on = on & analyze
        out = out + F.when(on, bit).otherwise(0)
    return out


def decode_flags(flags: Column) -> list[Column]:
    return [(flags.bitwiseAND(bit) != 0).alias(name) for name, bit in FLAGS.items()]


def query_text(text: Column, on: bool = True, most: int = -1) -> Column:
    """The text, cut to ``most`` characters if that is not negative; null when it is not logged."""
    if not on:
        return F.lit(None).cast("string")
    return text if most < 0 else F.substring(text, 1, most)


def parameters(values: Column, most: int = -1) -> Column:
    """``$1 = 'v', $2 = NULL``; quotes are doubled, long values end in dots; 0 turns it off."""
    if most == 0:
        return F.lit(None).cast("string")

    def one(v: Column, i: Column) -> Column:
        cut = v if most < 0 else F.when(F.length(v) > most, F.concat(F.substring(v, 1, most), F.lit("..."))).otherwise(v)
        shown = F.when(v.isNull(), F.lit("NULL")).otherwise(F.concat(F.lit("'"), F.replace(cut, F.lit("'"), F.lit("''")), F.lit("'")))
        return F.concat(F.lit("$"), (i + 1).cast("string"), F.lit(" = "), shown)

    return F.array_join(F.transform(values, one), ", ")
