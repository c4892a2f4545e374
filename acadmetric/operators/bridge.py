"""Joins through an N:N bridge, without emitting the pairs of a group where the report does not need them.

``links`` ties groups (programs, areas, levels) to members (faculty), and
``items`` ties members to what they produced. A plain join repeats every item
of a member for each of its groups.

Distinct items are counted by sets of bits: 64 neighbouring keys are one word, a set is its words, and sets are united by
``bit_or``. Serial keys lie densely, so the more items a member has, the fewer words they take: a member with a third of
all items has a row for every 64 of them, and the joins and shuffles after that carry words. Where keys lie far apart a word
holds one item and costs what a pair costs. Nothing depends on how dense keys are but the time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SHIFT = 6  # 64 keys in a word

# The members that would emit the most (group, item) pairs get one bit each, so sets of them are numbers below 2^HEAVY.
HEAVY = 10
# The items of every other member are dealt over this many tasks.
SALTS = 8


def path_counts(links: DataFrame, items: DataFrame, member: str,
                link_keys: Sequence[str], item_keys: Sequence[str]) -> DataFrame:
    """``paths``: number of (link, item) paths per link key and item key.

    Both sides are counted per member before the join, so the join carries one
    row per member and key instead of one per path.
    """
    left = links.groupBy(member, *link_keys).agg(F.count("*").alias("_links"))
    right = items.groupBy(member, *item_keys).agg(F.count("*").alias("_items"))
    return (
        left.join(right, member)
        .groupBy(*link_keys, *item_keys)
        .agg(F.sum(F.col("_links") * F.col("_items")).alias("paths"))
    )


def word_of(key: str) -> Column:
    """The number of the word that holds a whole-number key."""
    return F.shiftright(F.col(key).cast("bigint"), _SHIFT)


def bit_of(key: str) -> Column:
    """The key's bit in its word."""
    return F.expr(f"shiftleft(1L, cast(cast(`{key}` as bigint) & 63 as int))")


def key_sets(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per ``by`` and word: ``_word``, ``_bits``, the set of the keys that occur. Missing keys are in no set."""
    known = df.filter(F.col(key).isNotNull())
    return known.groupBy(*by, word_of(key).alias("_word")).agg(F.bit_or(bit_of(key)).alias("_bits"))


def set_counts(links: DataFrame, items: DataFrame, member: str, group: str, item: str,
               known: DataFrame | None = None, members: bool = False) -> DataFrame:
    """``items`` per group: its distinct items through shared members; with ``members``, its distinct members that have any.

    Items count that ``known`` (a table with the column ``item``) holds, if it is given; it is looked up as a set too. Every input is
    read once, and links, items and known keys may be listed twice. Groups without an item are left out. Keys of items, and of
    members where those are counted, must be whole numbers.
    """
    made = key_sets(items, item, [member])
    if known is not None:
        held = key_sets(known, item).withColumnRenamed("_bits", "_held")
        made = made.join(held, "_word").withColumn("_bits", F.col("_bits").bitwiseAND(F.col("_held"))).filter("_bits <> 0")
    met = links.select(group, member).join(made.select(member, "_word", "_bits"), member)
    if not members:
        united = met.groupBy(group, "_word").agg(F.bit_or("_bits").alias("_bits"))
        return united.groupBy(group).agg(F.sum(F.bit_count("_bits").cast("bigint")).alias("items"))
    own = F.struct(F.lit(True).alias("_own"), word_of(member).alias("_word"), bit_of(member).alias("_bits"))
    both = F.inline(F.array(F.struct(F.lit(False).alias("_own"), "_word", "_bits"), own))
    united = met.select(group, both).groupBy(group, "_own", "_word").agg(F.bit_or("_bits").alias("_bits"))
    bits = F.bit_count("_bits").cast("bigint")
    return united.groupBy(group).agg(F.sum(F.when(~F.col("_own"), bits)).alias("items"), F.sum(F.when(F.col("_own"), bits)).alias("members"))


def distinct_items(links: DataFrame, items: DataFrame, member: str, group: str, item: str,
                   heavy: int = HEAVY, salts: int = SALTS) -> DataFrame:
    """``items``: number of distinct items per group, for members that hold many links and many items at once.

    An item counts once per group however many of its members the group has.
    The ``heavy`` members with the most pairs are counted by sets of members,
    all others by distinct (group, item) pairs; the second part skips the pairs
    the first one has counted. The result is exact with any choice of heavy
    members, also when a link or an item is listed twice. It is one plan:
    which members are heavy is found inside it.
    """
    links = links.select(group, member)
    items = items.select(member, item)
    slots = F.broadcast(_heavy_members(links, items, member, heavy))
    marked_links = links.join(slots, member, "left")
    marked_items = items.join(slots, member, "left")
    group_sets = marked_links.filter("_bit IS NOT NULL").groupBy(group).agg(F.bit_or("_bit").alias("_group_set"))
    item_sets = marked_items.filter("_bit IS NOT NULL").groupBy(item).agg(F.bit_or("_bit").alias("_item_set"))

    # At most 2^heavy - 1 different sets on either side, whatever the data.
    sets_of_items = item_sets.groupBy("_item_set").agg(F.count("*").alias("_n"))
    sets_of_groups = group_sets.select("_group_set").distinct()
    met = (
        _per_bit(sets_of_groups, "_group_set", heavy)
        .join(_per_bit(sets_of_items, "_item_set", heavy), "_bit")
        .dropDuplicates(["_group_set", "_item_set"])
        .groupBy("_group_set")
        .agg(F.sum("_n").alias("items"))
    )
    through_heavy = group_sets.join(F.broadcast(met), "_group_set").select(group, "items")

    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    other_links = marked_links.filter("_bit IS NULL").join(group_sets, group, "left").select(
        group, member, "_group_set", every_salt)
    other_items = marked_items.filter("_bit IS NULL").join(item_sets, item, "left").select(
        member, item, "_item_set", F.pmod(F.xxhash64(item), F.lit(salts)).cast("int").alias("_salt"))
    shared = F.coalesce("_group_set", F.lit(0)).bitwiseAND(F.coalesce("_item_set", F.lit(0)))
    pairs = other_links.join(other_items, [member, "_salt"]).filter(shared == 0).select(group, item).distinct()
    others = pairs.groupBy(group).agg(F.count("*").alias("items"))

    return through_heavy.unionByName(others).groupBy(group).agg(F.sum("items").alias("items"))


def _heavy_members(links: DataFrame, items: DataFrame, member: str, heavy: int) -> DataFrame:
    """(member, _bit): the ``heavy`` members with the most pairs, a bit each."""
    groups = links.groupBy(member).agg(F.count("*").alias("_links"))
    held = items.groupBy(member).agg(F.count("*").alias("_items"))
    pairs = F.col("_links").cast("double") * F.col("_items")
    worst = groups.join(held, member).select(member, pairs.alias("_pairs")).orderBy(F.desc("_pairs"), member).limit(heavy)
    # At most ``heavy`` rows reach this window.
    slot = F.row_number().over(Window.orderBy(F.desc("_pairs"), member)) - 1
    return worst.withColumn("_slot", slot).select(member, F.expr("shiftleft(1, _slot)").alias("_bit"))


def _per_bit(df: DataFrame, mask: str, bits: int) -> DataFrame:
    """One row per bit set in ``mask``."""
    slots = F.explode(F.array(*[F.lit(1 << slot) for slot in range(bits)]))
    return df.withColumn("_bit", slots).filter(F.col(mask).bitwiseAND(F.col("_bit")) != 0)
