"""Balanced label propagation: linked documents move into one shard, and shards stay even.

Documents are linked when their texts are equal. Every document starts in the shard of its hash. In each round the
groups that have no shard yet ask for one: the shard that holds most of their members, of those with room for all of
them, else any with room. Shards admit the largest groups first, as far as their quota goes; the others ask again,
until nothing moves. Groups larger than a quota are split into as few parts as quotas allow. Documents without links
fill the room that is left. Last, all documents are numbered shard by shard and the numbers are cut into equal runs,
which makes the row counts exact; the cuts fall among documents without links where there are any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runwaylens.llm.common import size_bytes
from runwaylens.sources.scratch import Workspace

SHARDS = 40
# Groups move in every round, or the rounds end; this many are never needed where groups fit well.
ROUNDS = 40
# Groups of about one size that a shard admits together, and cells of a shard in the final order.
PRIORITIES = 64
CELLS = 64
GROUP = ["__g1", "__g2"]
PLACE = ["__to", "__kind", "__c1", "__c2", "__sub"]


def equal_text_key() -> list[Column]:
    return [F.xxhash64("text").alias("__g1"), F.coalesce(F.crc32("text"), F.lit(-1)).alias("__g2")]


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Every row and column of ``docs`` with ``shard`` (int, 0 to shards - 1) and ``slot`` (long, from 0 without gaps).

    Law `rows`: the counts of any two shards differ by one at most. Equal texts share a shard as far as they fit;
    NULL texts count as equal to each other, empty ones too. Rows that repeat a doc_id are rows of their own. Columns
    named shard or slot are replaced. The outcome hangs on the rows alone. An empty table gives an empty result.
    """
    plain = docs.drop("shard", "slot")
    # Columns get names of their own, so that none clashes, with PLACE neither, and those that nobody reads are not shuffled.
    own = {c: f"__own{i}" for i, c in enumerate(plain.columns)}
    keyed = plain.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()], F.col("doc_id").alias("__id"), *equal_text_key())
    with Workspace(docs.sparkSession, "sharding") as work:
        base = work.save(keyed.select("__id", *GROUP, start_of("__id", shards).alias("__start")), "base")
        total = base.count()
        quota = max(1, -(-total // shards))
        groups = group_votes(base, quota)
        placed, load = propagated(work.save(groups, "open0"), shards, quota, rounds, work)
        places = placed.groupBy(*GROUP).agg(
            F.map_from_entries(F.collect_list(F.struct("__part", "label"))).alias("__labels"), F.sum("n").alias("__n")
        )
        places = work.save(places, "places")
        work.keep("places")
        room = [max(0, quota - load[j]) for j in range(shards)]

        def located(df: DataFrame) -> DataFrame:
            """Rows with the shard they go to and their cell: documents without links first and last."""
            known = df.join(places, GROUP, "left")
            label = F.element_at("__labels", part_of("__id", F.size("__labels")))
            linked, large = F.col("__n").isNotNull(), F.col("__n") > quota // CELLS
            h = F.pmod(F.xxhash64("__id", "__g1", F.lit(3)), F.lit(2 * CELLS))
            own = F.pmod(F.xxhash64(*GROUP, F.lit(2)), F.lit(CELLS))
            spread = F.pmod(F.xxhash64("__id", F.lit(7)), F.lit(CELLS))
            # A large group is a cell by itself, spread over sub-cells; a shard holds fewer than CELLS of them.
            columns = {
                "__to": F.coalesce(label, _share(room)),
                "__kind": F.when(~linked, F.when(h < CELLS, 0).otherwise(3)).when(large, 2).otherwise(1),
                "__c1": F.when(~linked, h).when(large, F.col("__g1")).otherwise(own),
                "__c2": F.when(linked & large, F.col("__g2")).otherwise(F.lit(0)).cast("long"),
                "__sub": F.when(linked & ~large, 0).otherwise(spread),
            }
            return known.withColumns(columns)

        counts = located(base).groupBy(*PLACE).agg(F.count("*").alias("c"))
        counts = work.save(counts, "counts")
        # A bounded number of rows for each shard, however many documents there are, and one row for each shard.
        before = F.sum("c").over(Window.partitionBy("__to").orderBy(*PLACE[1:])) - F.col("c")
        whole = counts.groupBy("__to").agg(F.sum("c").alias("all"))
        first = whole.select("__to", (F.sum("all").over(Window.orderBy("__to")) - F.col("all")).alias("__first"))
        offsets = counts.withColumn("__in_shard", before).join(first, "__to")
        offsets = work.save(offsets.select(*PLACE, (F.col("__first") + F.col("__in_shard")).alias("__before")), "offsets")
        work.keep("offsets")
    in_cell = Window.partitionBy(*PLACE).orderBy(*GROUP, "__id")
    numbered = located(keyed).withColumn("__in", F.row_number().over(in_cell) - 1).join(offsets, PLACE)
    numbered = numbered.withColumn("__at", F.col("__before") + F.col("__in"))
    small, large_runs = divmod(total, shards)
    edge = large_runs * (small + 1)
    at = F.col("__at")
    in_large = at < edge
    number = F.when(in_large, F.floor(at / (small + 1))).otherwise(large_runs + F.floor((at - edge) / max(1, small)))
    slot = F.when(in_large, at % (small + 1)).otherwise((at - edge) % max(1, small))
    columns = [F.col(n).alias(c) for c, n in own.items()]
    return numbered.select(*columns, number.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def start_of(key: str, shards: int) -> Column:
    """The shard in which a document starts."""
    return F.pmod(F.xxhash64(key, "__g1", F.lit(1)), F.lit(shards)).cast("int")


def part_of(key: str, parts: Column) -> Column:
    """The part of its group, from 0, that a document belongs to."""
    return F.pmod(F.xxhash64(key, F.lit(4)), parts).cast("int")


def group_votes(base: DataFrame, quota: int) -> DataFrame:
    """One row for each group of two rows or more, or part of a split group: its size ``n`` and ``votes``.

    ``votes`` holds the members in each starting shard. Members that start in one shard are counted before they are
    shuffled, so a text that a third of all rows share is a few rows.
    """
    sizes = base.groupBy(*GROUP).agg(F.count("*").alias("size")).filter("size > 1")
    parts = F.ceil(F.col("size") / F.lit(quota)).cast("int")
    members = base.join(sizes.select(*GROUP, parts.alias("parts")), GROUP)
    members = members.withColumn("__part", part_of("__id", F.col("parts")))
    starts = members.groupBy(*GROUP, "__part", "__start").agg(F.count("*").alias("c"))
    return starts.groupBy(*GROUP, "__part").agg(
        F.sum("c").alias("n"), F.collect_list(F.struct("c", F.col("__start").alias("shard"))).alias("votes")
    )


def propagated(groups: DataFrame, shards: int, quota: int, rounds: int, work: Workspace) -> tuple[DataFrame, list[int]]:
    """(groups with ``label``, rows placed in each shard) after rounds of asking and admitting."""
    load, placed, step = [0] * shards, [], 0
    waiting = groups
    while step < rounds:
        step += 1
        asked = waiting.withColumn("wanted", wanted([quota - x for x in load], step)).filter("wanted is not null")
        admitted = work.save(_admitted(asked, [quota - x for x in load]), f"placed{step}")
        gained = {r.label: r.n for r in admitted.groupBy("label").agg(F.sum("n").alias("n")).collect()}
        if not gained:
            work.drop(f"placed{step}")
            break
        load = [x + gained.get(j, 0) for j, x in enumerate(load)]
        placed.append(admitted)
        rest = waiting.join(admitted.select(*GROUP, "__part"), [*GROUP, "__part"], "left_anti")
        waiting = work.save(rest, f"open{step}")
        work.drop(f"open{step - 1}")
    # What fits nowhere whole goes where most room is left; the final cut into equal runs divides it.
    room = [max(0, quota - x) for x in load]
    roomiest = F.array(*[F.lit(j) for j in sorted(range(shards), key=lambda j: -room[j])])
    number = F.pmod(F.xxhash64(*GROUP, "__part"), F.lit(max(1, sum(r > 0 for r in room)))).cast("int")
    out = waiting.select(*GROUP, "__part", "n", F.get(roomiest, number).alias("label"))
    for part in placed:
        out = out.unionByName(part)
    return out, load


def wanted(room: list[int], step: int) -> Column:
    """The shard a group asks for: that of most of its members with room for all, else one of those with room.

    NULL where no shard has room for the group.
    """
    rooms = F.array(*[F.lit(r) for r in room])
    fitting = F.filter("votes", lambda v: F.get(rooms, v["shard"]) >= F.col("n"))
    best = F.array_max(F.transform(fitting, lambda v: F.struct(v["c"], F.xxhash64(*GROUP, v["shard"], F.lit(step)), v["shard"].alias("shard"))))
    others = F.filter(F.sequence(F.lit(0), F.lit(len(room) - 1)), lambda j: F.get(rooms, j) >= F.col("n"))
    some = F.get(others, F.pmod(F.xxhash64(*GROUP, "__part", F.lit(step)), F.size(others)).cast("int"))
    return F.coalesce(best["shard"], F.when(F.size(others) > 0, some)).cast("int")


def _admitted(asked: DataFrame, room: list[int]) -> DataFrame:
    """The groups that shards take, largest first; groups of about one size are told apart by a hash."""
    octave = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    priority = (64 - octave) * PRIORITIES + F.pmod(F.xxhash64(*GROUP, "__part", F.lit(6)), F.lit(PRIORITIES))
    keyed = asked.withColumn("priority", priority)
    classes = keyed.groupBy("wanted", "priority").agg(F.sum("n").alias("rows"), F.max(F.struct("n", *GROUP, "__part")).alias("head"))
    # At most 64 rows for each octave of sizes and shard. Of the first class that is too large its head may go.
    upto = F.sum("rows").over(Window.partitionBy("wanted").orderBy("priority"))
    free = F.get(F.array(*[F.lit(r) for r in room]), F.col("wanted"))
    judged = classes.withColumns({"before": upto - F.col("rows"), "free": free})
    whole = F.col("before") + F.col("rows") <= F.col("free")
    over = F.sum(F.when(whole, 0).otherwise(1)).over(Window.partitionBy("wanted").orderBy("priority"))
    judged = judged.withColumn("over", over)
    head_fits = (F.col("over") == 1) & ~whole & (F.col("before") + F.col("head.n") <= F.col("free"))
    judged = judged.select("wanted", "priority", ((F.col("over") == 0) & whole).alias("all_in"), head_fits.alias("head_in"), "head")
    taken = keyed.join(judged.filter("all_in or head_in"), ["wanted", "priority"])
    mine = F.struct("n", *GROUP, "__part") == F.col("head")
    return taken.filter(F.col("all_in") | mine).select(*GROUP, "__part", "n", F.col("wanted").alias("label"))


def _share(room: list[int]) -> Column:
    """A shard for a document without links: shards are drawn by the room that they have left."""
    total = sum(room) or 1
    drawn = F.pmod(F.xxhash64("__id", "__g1", F.lit(5)), F.lit(total))
    ends, so_far = [], 0
    for r in room:
        so_far += r
        ends.append(so_far)
    bounds = F.array(*[F.lit(e) for e in ends])
    return F.least(F.size(F.filter(bounds, lambda e: e <= drawn)), F.lit(len(room) - 1)).cast("int")


def cut_links(sharded: DataFrame) -> DataFrame:
    """(linked, cut): documents that share their text with another, and those of them outside the largest part."""
    parts = sharded.groupBy(*equal_text_key(), "shard").agg(F.count("*").alias("c"))
    groups = parts.groupBy("__g1", "__g2").agg(F.sum("c").alias("n"), F.max("c").alias("most")).filter("n > 1")
    return groups.agg(F.sum("n").alias("linked"), F.sum(F.col("n") - F.col("most")).alias("cut"))


def with_digest(docs: DataFrame) -> DataFrame:
    """Rows with ``size`` (UTF-8 bytes and 16) and ``text_crc32``, in place of the text."""
    return docs.select("doc_id", (size_bytes(F.col("text")) + 16).alias("size"), F.crc32("text").alias("text_crc32"), "text")
