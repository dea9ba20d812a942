"""Scaled samples: fast approximate ones, and exact ones that never sort or gather the table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from runwaylens.schema import SAMPLE_FRACTIONS, SAMPLE_SEED
from runwaylens.sources.readers import input_stats
from runwaylens.sources.scratch import Workspace, move, new_folder, remove, stored
from runwaylens.sources.writers import write_parquet

HASH_BITS = 60
# Prefix bits of the first and of the second count.
LEVEL_BITS = 16
# How many more random draws than wanted are made at first for a larger-than-table sample, and how they are tried again.
DRAW_MARGIN, MORE_DRAWS = 1.25, 2.0


def sample_fraction(df: DataFrame, fraction: float, seed: int = SAMPLE_SEED) -> DataFrame:
    """About ``fraction`` of the rows, without a shuffle: a coin per row, extra copies above 1."""
    if fraction <= 1:
        return df.sample(False, fraction, seed)
    return df.unionByName(df.sample(True, fraction - 1, seed))


def _with_order(df: DataFrame, seed: int, key: Sequence[str] | None) -> DataFrame:
    """Add ``order_hash``, 60 uniform bits, and ``order_tie``, which is unique per row."""
    if key:
        text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
        digits = F.substring(F.md5(text), 1, HASH_BITS // 4)
        # Rows that repeat a key differ by their position.
        return df.withColumn("order_tie", F.struct(*key, F.monotonically_increasing_id().alias("row"))).withColumn(
            "order_hash", F.conv(digits, 16, 10).cast("long")
        )
    row = F.monotonically_increasing_id()
    mixed = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "order_tie"), 64 - HASH_BITS)
    return df.withColumn("order_tie", row).withColumn("order_hash", mixed)


def poisson_steps(rate: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... as far as doubles tell it from 1."""
    steps, total, k = [], 0.0, 0
    while total < 1 - 2**-52 and (k <= rate or not steps or steps[-1] < total):
        steps.append(total)
        total = min(1.0, total + math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)))
        k += 1
    return [*steps[1:], total]


@dataclass(frozen=True)
class Cut:
    """A sample as a condition on rows: ``kind`` of draws, their ``rate``, and the last (hash, tie, copy) that is in."""

    fraction: float
    kind: int
    rate: float
    limit: Row | None


def _draws(kind: int, rate: float, seed: int) -> Column:
    """(kind, hash, tie, copy) of the draws that a row makes: itself for kind 0, else a Poisson number of copies."""
    if kind == 0:
        return F.array(F.struct(F.lit(0).alias("kind"), F.col("order_hash").alias("hash"), F.col("order_tie").alias("tie"), F.lit(0).alias("copy")))
    share = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(kind), "order_tie"), 11) / float(1 << 53)
    number = sum((F.when(share >= step, 1).otherwise(0) for step in poisson_steps(rate)), F.lit(0))

    def draw(copy: Column) -> Column:
        mixed = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), F.lit(kind), F.col("order_tie"), copy), 64 - HASH_BITS)
        return F.struct(F.lit(kind).alias("kind"), mixed.alias("hash"), F.col("order_tie").alias("tie"), copy.alias("copy"))

    return F.transform(F.sequence(F.lit(0), number), draw)


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in kind])
    return F.lit(value).cast(kind)


def cut_offs(df: DataFrame, fractions: Sequence[float], seed: int = SAMPLE_SEED, key: Sequence[str] | None = None) -> list[Cut]:
    """Where samples of all the given sizes end, from two scans of ``df`` however many they are.

    Every row makes one draw with a uniform number, from which all samples up to the whole table are taken, so smaller
    ones lie within larger ones. For a sample of more than the table, rows make a Poisson number of further draws, so
    that together they are somewhat more than wanted; given their number, draws are even and independent, and so are
    the smallest m of them. The first scan counts draws by a prefix of 16 bits, which tells the prefix that holds each
    cut-off; the second stores the few draws under those prefixes, and the rest reads only these.
    """
    spark = df.sparkSession
    rows = _with_order(df, seed, key)
    larger = sorted({f for f in fractions if f > 1})
    rates = {0: 0.0} | {k: (f - 1) * DRAW_MARGIN for k, f in enumerate(larger, 1)}
    prefix = F.shiftright("hash", HASH_BITS - LEVEL_BITS).cast("int")
    with Workspace(spark, "cut-offs") as work:
        for attempt in range(1, 200):
            draws = rows.select(F.inline(F.concat(*[_made(k, rate, seed) for k, rate in rates.items()])))
            counts = work.save(draws.groupBy("kind", prefix.alias("part")).agg(F.count(F.lit(1)).alias("n")), f"counts{attempt}")
            totals = {r.kind: r.n for r in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
            n = totals.get(0, 0)
            wanted = [(i, larger.index(f) + 1, math.floor(n * (f - 1.0))) if f > 1 else (i, 0, round(n * f)) for i, f in enumerate(fractions)]
            short = {k for _, k, m in wanted if totals.get(k, 0) < m}
            if not short:
                break
            rates |= {k: rates[k] * MORE_DRAWS + 1 / n for k in short}
        asked = [(i, k, m) for i, k, m in wanted if m > 0]
        if not asked:
            return [Cut(f, k, rates[k], None) for f, (_, k, _) in zip(fractions, wanted, strict=True)]
        first = _crossing(counts, ["kind"], "part", asked, "sample int, kind int, need long")
        chosen = sorted({(r.kind, r.part) for r in first})
        near = draws.withColumn("part", prefix).where(F.struct("kind", "part").isin(*[F.struct(F.lit(k), F.lit(p)) for k, p in chosen]))
        near = work.save(near, "near")
        second = F.shiftright("hash", HASH_BITS - 2 * LEVEL_BITS).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1)).cast("int")
        fine = near.groupBy("kind", "part", second.alias("fine")).agg(F.count(F.lit(1)).alias("n"))
        asked = [(r.sample, r.kind, r.part, r.need) for r in first]
        found = _crossing(fine, ["kind", "part"], "fine", asked, "sample int, kind int, part int, need long")
        # About one draw in 4 billion is left for each sample.
        place = F.row_number().over(Window.partitionBy("kind", "part", "fine").orderBy("hash", "tie", "copy"))
        ends = spark.createDataFrame([(r.sample, r.kind, r.part, r.fine, r.need) for r in found], "sample int, kind int, part int, fine int, need long")
        last = near.withColumn("fine", second).join(F.broadcast(ends.drop("sample", "need").distinct()), ["kind", "part", "fine"])
        last = last.withColumn("place", place).join(F.broadcast(ends), ["kind", "part", "fine"]).where(F.col("place") == F.col("need"))
        limits = {r.sample: r.end for r in last.select("sample", F.struct("hash", "tie", "copy").alias("end")).collect()}
    return [Cut(f, k, rates[k], limits.get(i)) for f, (i, k, _) in zip(fractions, wanted, strict=True)]


def _crossing(counts: DataFrame, groups: list[str], bucket: str, asked: list[tuple], schema: str) -> list[Row]:
    """For each asked number of draws of a group, the bucket in which the running count reaches it and what it must give.

    A group has at most 2**LEVEL_BITS buckets, so one task can walk it.
    """
    upto = F.sum("n").over(Window.partitionBy(*groups).orderBy(bucket))
    reached = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
    wanted = F.broadcast(counts.sparkSession.createDataFrame(asked, schema))
    met = reached.join(wanted, groups).where((F.col("before") < F.col("need")) & (F.col("need") <= F.col("upto")))
    return met.select("sample", *groups, bucket, (F.col("need") - F.col("before")).alias("need")).collect()


def _made(kind: int, rate: float, seed: int) -> Column:
    """All draws of a row; the list of copies starts with a number 0 that is none."""
    made = _draws(kind, rate, seed)
    return made if kind == 0 else F.filter(made, lambda d: d["copy"] > 0)


def times_in(cut: Cut, tie: T.DataType, seed: int) -> Column:
    """How often a row with order columns is in a sample."""
    base = 1 if cut.kind else 0
    if cut.limit is None:
        return F.lit(base)
    end = F.struct(F.lit(cut.limit["hash"]).cast("long").alias("hash"), _literal(cut.limit["tie"], tie).alias("tie"), F.lit(cut.limit["copy"]).alias("copy"))
    drawn = F.filter(_made(cut.kind, cut.rate, seed), lambda d: F.struct(d["hash"].alias("hash"), d["tie"].alias("tie"), d["copy"].alias("copy")) <= end)
    if cut.kind == 0:
        return F.when(F.struct(F.col("order_hash").alias("hash"), F.col("order_tie").alias("tie"), F.lit(0).alias("copy")) <= end, 1).otherwise(0)
    return F.size(drawn) + base


def _ordered_input(df: DataFrame, key: Sequence[str] | None, fixed_order: bool) -> DataFrame:
    return df if key or fixed_order else stored(df, "sample-input")


def sample_exact(
    df: DataFrame,
    fraction: float,
    seed: int = SAMPLE_SEED,
    key: Sequence[str] | None = None,
    fixed_order: bool = False,
) -> DataFrame:
    """Exactly ``round(fraction * n)`` rows (half to even), uniformly and without replacement.

    Every row gets a uniform number and the smallest ones are taken: see ``cut_offs``. The sample itself is a plain
    filter, with no sort, shuffle or row limit. The cut-off is found when the sample is asked for, not when it is read.

    With ``key`` (columns that identify a row) the same rows are chosen on any cluster; rows that
    repeat a key go by their position. Without a key rows are numbered by position, so copies of a row do not matter; ``df``
    must then yield the same rows in the same order on every scan. Say so with
    ``fixed_order`` (Parquet files read directly), else the rows are first written to
    the shared folder.
    """
    if fraction > 1:
        raise ValueError("fraction must not exceed 1; use oversample_exact")
    df = _ordered_input(df, key, fixed_order)
    (cut,) = cut_offs(df, [fraction], seed, key)
    rows = _with_order(df, seed, key)
    return rows.where(times_in(cut, rows.schema["order_tie"].dataType, seed) == 1).select(df.columns)


def with_row_index(df: DataFrame) -> DataFrame:
    """Add ``row_index`` 0..n-1 and ``row_total`` n, by position, without a sort or shuffle.

    Needs a table that yields the same partitions on every scan. The offsets have one
    row per input partition, so they are small enough to broadcast at any table size.
    """
    row = F.monotonically_increasing_id()
    numbered = df.withColumn("part", F.spark_partition_id()).withColumn(
        "place", row.bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = df.select(F.spark_partition_id().alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(
        "part", F.coalesce(before, F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy()).alias("row_total")
    )
    return numbered.join(F.broadcast(offsets), "part").select(
        *df.columns, (F.col("start") + F.col("place")).alias("row_index"), "row_total"
    )


def oversample_exact(
    df: DataFrame, fraction: float, seed: int = SAMPLE_SEED, fixed_order: bool = False
) -> DataFrame:
    """All rows plus exactly ``int(n * (fraction - 1))`` rows drawn with replacement.

    Every row works out its own copies (see ``cut_offs``), so whole rows are neither shuffled nor joined, whatever
    they hold and however often some repeat.
    """
    if fraction <= 1:
        raise ValueError("fraction must exceed 1; use sample_exact")
    df = _ordered_input(df, None, fixed_order)
    (cut,) = cut_offs(df, [fraction], seed)
    rows = _with_order(df, seed, None)
    times = F.sequence(F.lit(1), times_in(cut, T.LongType(), seed))
    copy = _free_name("copy", df.columns)
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], F.explode(times).alias(copy)).drop(copy)


def _free_name(name: str, taken: Sequence[str]) -> str:
    while name in taken:
        name += "_"
    return name


def scaled_sample(df: DataFrame, fraction: float, seed: int = SAMPLE_SEED, fixed_order: bool = False) -> DataFrame:
    """Exact sample of any size, smaller or larger than the table."""
    if fraction <= 1:
        return sample_exact(df, fraction, seed, fixed_order=fixed_order)
    return oversample_exact(df, fraction, seed, fixed_order=fixed_order)


def sample_name(fraction: float) -> str:
    return f"sample_{int(fraction * 100):03d}pct"


def write_samples(
    df: DataFrame, out: str, fractions: Sequence[float], seed: int = SAMPLE_SEED, fixed_order: bool = False
) -> list[str]:
    """Write an exact sample for every fraction, each to a folder of its own below ``out``; return their names.

    Three scans of ``df`` in all: two find where the samples end, one writes every row into all samples that it is in.
    """
    names = [sample_name(f) for f in fractions]
    if len(set(names)) < len(names):
        raise ValueError(f"samples of one name: {names}")
    spark = df.sparkSession
    df = _ordered_input(df, None, fixed_order)
    cuts = cut_offs(df, fractions, seed)
    rows = _with_order(df, seed, None)
    memberships = [F.array_repeat(F.lit(name), times_in(cut, T.LongType(), seed)) for name, cut in zip(names, cuts, strict=True)]
    column = _free_name("sample", df.columns)
    staged = new_folder(spark, "samples")
    marked = rows.select(*[F.col(f"`{c}`") for c in df.columns], F.explode(F.concat(*memberships)).alias(column))
    write_parquet(marked, staged, partition_by=[column])
    for name in names:
        if not move(spark, f"{staged}/{column}={name}", f"{out}/{name}"):
            write_parquet(df.limit(0), f"{out}/{name}", single_file=True)
    remove(spark, staged)
    return names


def write_sample_suite(
    spark: SparkSession, path: str, out: str, fractions: Sequence[float] = tuple(SAMPLE_FRACTIONS), exact: bool = True
) -> DataFrame:
    """Write one sample per fraction of a Parquet table; return name, fraction, rows and size."""
    df = spark.read.parquet(path)
    if exact:
        write_samples(df, out, fractions, fixed_order=True)
    manifest = None
    for f in fractions:
        name = sample_name(f)
        if not exact:
            write_parquet(sample_fraction(df, f), f"{out}/{name}")
        row = input_stats(spark, f"{out}/{name}").select(
            F.lit(name).alias("name"),
            F.lit(float(f)).alias("fraction"),
            F.col("input_rows").alias("rows"),
            F.col("input_size_mb").alias("size_mb"),
        )
        manifest = row if manifest is None else manifest.unionByName(row)
    return manifest
