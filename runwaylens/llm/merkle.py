"""Merkle manifest of a table: leaf coordinates by bitmap ranks, levels reduced in slot arrays.

Each run (a language) keeps its keys as a compressed bitmap: words of 64 neighbouring keys, empty words left out, built
by partial aggregation and merged by OR. A directory of row counts lies over the words, in levels of 1024 children, so
the rank of a key is a few look-ups and one popcount; nothing is sorted. Ranks are coordinates, so blocks of 256 leaves
fill exactly, whatever the keys; a block hashes eight levels within its slot array, and its node is a leaf above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runwaylens.sources.scratch import Workspace

# Leaves of a block as a power of two, and children of a directory node.
BLOCK_BITS = 8
FAN_BITS = 10
PROOF_TYPE = "array<struct<left:boolean,digest:string>>"
LOWEST = -(1 << 63)


def field(value: Column) -> Column:
    """A value as a leaf holds it: `-` for NULL, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 over the fields of a row."""
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def up(node: Column, p: Column) -> Column:
        pair = F.when(p["left"], F.concat(p["digest"], node)).otherwise(F.concat(node, F.coalesce(p["digest"], F.lit(""))))
        return F.sha2(pair, 256)

    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """SHA-256 over the siblings of a proof, from the leaf to the root."""
    return F.sha2(F.concat_ws("", F.transform(proof, lambda p: p["digest"])), 256)


def manifest(rows: DataFrame, key: str = "doc_id", run: str = "lang", leaf: str = "leaf") -> DataFrame:
    """Every row and column of ``rows`` with ``position``, ``subroot``, ``root`` and ``proof``.

    ``leaf`` holds hex digests. Within a run, leaves ascend by the integer ``key`` (NULL counts as the smallest long);
    equal keys follow by leaf, equal leaves have neighbouring places in any order. While a level has several nodes,
    every two become the hash of both, a last single one the hash of itself. Runs are ordered by name, NULL first, by
    UTF-8 bytes, and their subroots become the root in the same way. ``proof`` lists, from the leaf to the root, the
    sibling on each level (digest NULL where a node had none) and whether it stands left. A NULL leaf counts as the
    empty text. Columns of those four names are replaced. An empty table gives an empty result.
    """
    plain = rows.drop("position", "subroot", "root", "proof")
    work = Workspace(rows.sparkSession, "merkle")
    with work:
        leaves = plain.select(
            F.struct("*").alias("row"),
            F.coalesce(F.concat(F.lit("="), F.col(f"`{run}`").cast("string")), F.lit("")).alias("g"),
            F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LOWEST)).alias("k1"),
            F.coalesce(F.col(f"`{leaf}`"), F.lit("")).alias("digest"),
        )
        # Decides between equal keys: the first 60 bits of the leaf, then the place in the stored table.
        leaves = leaves.withColumn("k2", F.coalesce(F.conv(F.substring("digest", 1, 15), 16, 10).cast("long"), F.lit(0)))
        leaves = work.save(leaves.withColumn("k3", F.monotonically_increasing_id()), "leaves")
        placed, totals = ranked(leaves, ["g"], ["k1", "k2", "k3"], work)
        largest = totals.agg(F.max("total")).first()[0]
        if largest is None:
            nothing = [F.lit(None).cast(t).alias(c) for c, t in [("position", "long"), ("subroot", "string"), ("root", "string"), ("proof", PROOF_TYPE)]]
            return plain.limit(0).select("*", *nothing)
        nodes = placed.select("g", "pos", "digest", "row").join(totals, "g")
        blocks = reduced(nodes, largest, work, "runs")
        subroots = blocks[-1].select("g", F.col("node").alias("digest"))
        runs = subroots.count()
        # One row for each run, however many leaves.
        order = F.row_number().over(Window.orderBy("g")) - 1
        top = subroots.select(
            F.lit("").alias("g"), order.cast("long").alias("pos"), "digest", F.col("g").alias("row"), F.lit(runs).cast("long").alias("total")
        )
        top_blocks = reduced(top, runs, work, "top")
        root = top_blocks[-1].first()["node"]
        tops = downwards(top_blocks, None, work, "top").select(F.col("entry.row").alias("g"), F.col("entry.digest").alias("subroot"), F.col("path").alias("above"))
        tops = work.save(tops.withColumn("block", F.lit(0).cast("long")), "tops")
        out = downwards(blocks, tops, work, "runs", "subroot")
        # What the result reads stays; the rest goes now.
        for name in ["runs0", *(n for n in work.names if n.startswith("runs_path")), "tops"]:
            work.keep(name)
    return out.select(
        *[F.col(f"entry.row.`{c}`").alias(c) for c in plain.columns],
        F.col("pos").alias("position"),
        "subroot",
        F.lit(root).alias("root"),
        F.col("path").alias("proof"),
    )


def ranked(rows: DataFrame, groups: list[str], values: list[str], work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(rows with ``pos``, rows by group): places within each group by the first of ``values``, ties by the next.

    Values are longs without NULL; the last must differ in all rows of equal others. A value that many rows share is
    one bit of one word; its rows are placed by the next value in the same way, spread by that.
    """
    level = len(groups)
    value, low = F.col(values[0]), F.col("low")
    marked = rows.withColumns({"word": F.shiftright(value, 6), "low": value.bitwiseAND(F.lit(63)).cast("int")})
    one = F.expr("shiftleft(1L, low)")
    words = marked.groupBy(*groups, "word").agg(F.bit_or(one).alias("bits"), F.count("*").alias("n"))
    words = work.save(words, f"words{level}")
    totals = work.save(words.groupBy(*groups).agg(F.sum("n").alias("total")), f"totals{level}")
    based = directory(words, groups, work, level)
    joined = marked.join(based, [*groups, "word"])
    below = F.bit_count(F.expr("bits & ~shiftleft(-1L, low)")).cast("long")
    single = F.col("n") == F.bit_count("bits")
    kept = [*rows.columns, "pos"]
    clear = joined.filter(single).withColumn("pos", F.col("base") + below).select(*kept)
    if len(values) == 1 or words.filter(~single).isEmpty():
        return clear, totals
    # Words with repeated values: the rows of smaller values of the word, at most 64 of them, come first.
    tied = joined.filter(~single)
    each = tied.groupBy(*groups, "word", values[0]).agg(F.count("*").alias("c"), F.first("base").alias("base"))
    upto = F.sum("c").over(Window.partitionBy(*groups, "word").orderBy(values[0])) - F.col("c")
    each = work.save(each.select(*groups, values[0], (F.col("base") + upto).alias("first_place")), f"ties{level}")
    inner, _ = ranked(tied.select(*rows.columns), [*groups, values[0]], values[1:], work)
    inner = inner.join(each, [*groups, values[0]])
    return clear.unionByName(inner.withColumn("pos", F.col("first_place") + F.col("pos")).select(*kept)), totals


def directory(words: DataFrame, groups: list[str], work: Workspace, level: int) -> DataFrame:
    """Words with ``base``: the rows of all smaller words of the group, from counts over counts of 1024 children."""
    chain: list[DataFrame] = []
    nodes = words.select(*groups, F.col("word").alias("node"), "n")
    while True:
        widest = nodes.groupBy(*groups).count().agg(F.max("count")).first()[0]
        if widest is None:
            return words.withColumn("base", F.lit(0).cast("long"))
        last = widest <= 1 << FAN_BITS
        nodes = nodes.withColumn("parent", F.lit(0).cast("long") if last else F.shiftright("node", FAN_BITS))
        # At most 1024 rows for each window.
        before = F.sum("n").over(Window.partitionBy(*groups, "parent").orderBy("node")) - F.col("n")
        step = f"{level}_{len(chain)}"
        chain.append(work.save(nodes.select(*groups, "node", "parent", before.alias("base")), f"counts{step}"))
        if last:
            break
        above = nodes.groupBy(*groups, F.col("parent").alias("node")).agg(F.sum("n").alias("n"))
        nodes = work.save(above, f"nodes{step}")
    bases = chain[-1].drop("parent")
    for lower in reversed(chain[:-1]):
        above = bases.select(*groups, F.col("node").alias("parent"), F.col("base").alias("more"))
        bases = lower.join(above, [*groups, "parent"]).select(*groups, "node", (F.col("base") + F.col("more")).alias("base"))
    return words.join(bases.withColumnRenamed("node", "word"), [*groups, "word"])


def reduced(nodes: DataFrame, largest: int, work: Workspace, name: str) -> list[DataFrame]:
    """Stored blocks of each step, lowest first, down to one node for each ``g``.

    ``nodes``: g, pos (0 to total - 1), digest, row, total. A block has its ``entries`` in slot order, the ``levels``
    of digests over them and their last ``node``. A place given twice is an error.
    """
    size, steps = 1 << BLOCK_BITS, []
    while True:
        slot = F.col("pos").bitwiseAND(F.lit(size - 1)).cast("int")
        entry = F.struct(slot.alias("key"), F.struct("digest", "row").alias("value"))
        block = F.shiftright("pos", BLOCK_BITS).alias("block")
        grouped = nodes.groupBy("g", block).agg(F.first("total").alias("total"), F.map_from_entries(F.collect_list(entry)).alias("slots"))
        entries = F.transform(F.sequence(F.lit(0), F.size("slots") - 1), lambda i: F.element_at("slots", i))
        grouped = grouped.select("g", "block", "total", entries.alias("entries"))
        n = F.size("entries")
        alone = F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)
        depth = F.when(F.col("total") <= size, alone).otherwise(BLOCK_BITS)
        leaves = F.array(F.transform("entries", lambda e: e["digest"]))
        levels = F.when(depth == 0, leaves).otherwise(F.aggregate(F.sequence(F.lit(1), depth), leaves, _next_level))
        stored = work.save(grouped.withColumn("levels", levels), f"{name}{len(steps)}")
        stored = stored.withColumn("node", F.element_at(F.element_at("levels", -1), 1))
        steps.append(stored)
        if largest <= size:
            return steps
        largest = -(-largest // size)
        blocks = F.floor((F.col("total") + (size - 1)) / size).cast("long")
        nodes = stored.select("g", F.col("block").alias("pos"), F.col("node").alias("digest"), F.lit(None).cast("string").alias("row"), blocks.alias("total"))


def _next_level(levels: Column, _: Column) -> Column:
    last = F.element_at(levels, -1)

    def pair(i: Column) -> Column:
        return F.sha2(F.concat(F.get(last, 2 * i), F.coalesce(F.get(last, 2 * i + 1), F.lit(""))), 256)

    half = F.floor((F.size(last) - 1) / 2).cast("int")
    return F.concat(levels, F.array(F.transform(F.sequence(F.lit(0), half), pair)))


def downwards(steps: list[DataFrame], above: DataFrame | None, work: Workspace, name: str, *kept: str) -> DataFrame:
    """Entries of the lowest blocks with ``pos`` and their ``path`` of siblings up to the end of ``above``."""

    def own(slot: Column) -> Column:
        def sibling(j: Column) -> Column:
            # The lambda index is no literal, so shifts are by division.
            at = F.floor(slot / F.pow(F.lit(2), j)).cast("int")
            digest = F.get(F.get("levels", j), at.bitwiseXOR(F.lit(1)))
            return F.struct((at.bitwiseAND(F.lit(1)) == 1).alias("left"), digest.alias("digest"))

        some = F.transform(F.sequence(F.lit(0), F.size("levels") - 2), sibling).cast(PROOF_TYPE)
        return F.when(F.size("levels") > 1, some).otherwise(F.array().cast(PROOF_TYPE))

    for i in reversed(range(len(steps))):
        # The end of a whole tree has nothing above it.
        met = steps[i].join(above, ["g", "block"]) if above is not None else steps[i].withColumn("above", F.array().cast(PROOF_TYPE))
        base = F.col("block") * (1 << BLOCK_BITS)
        slots = F.transform(
            "entries", lambda e, s: F.struct(e.alias("entry"), (base + s).alias("pos"), F.concat(own(s), F.col("above")).alias("path"))
        )
        met = met.select("g", *kept, F.inline(slots))
        if i == 0:
            return met
        path = met.select("g", F.col("pos").alias("block"), F.col("path").alias("above"), *kept)
        above = work.save(path, f"{name}_path{i}")
    raise AssertionError("no steps")
