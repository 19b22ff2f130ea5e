"""Placing keys on a number of owners by how many records they have, with hot keys split.

Hashing keys gives the owner of a hot key that key's whole load.  Here records are counted per key first.  Keys with
a sixteenth of an owner's fair share or more are items of their own, and those above the fair share are cut into
equal pieces; all others fall by hash into sixteen buckets for each owner, which are items too.  So there are at most
33 items for each owner however many keys there are.  Items go largest first to the owner with the least load.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 16

Hash = Callable[[Column], Column]


def _own(key: Column) -> Column:
    return F.coalesce(F.concat(F.lit("k"), key), F.lit("null"))


def _bucket(key: Column, owners: int, hashed: Hash) -> Column:
    return F.pmod(hashed(key), F.lit(owners * BUCKETS))


def _shared(key: Column, owners: int, hashed: Hash) -> Column:
    return F.concat(F.lit("b"), _bucket(key, owners, hashed).cast("string"))


def plan(rows: DataFrame, key: str, owners: int, hashed: Hash = F.xxhash64) -> DataFrame:
    """One row for each piece of an item: item, piece, records, owner.

    An item is ``k`` and a key, ``null`` for rows without a key, or ``b`` and a bucket.  ``key`` is text.  Ties go to
    the smaller item and to the owner with the smaller number; an empty table gives no rows.
    """
    counts = rows.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    large = F.col("n") * F.lit(owners * BUCKETS) >= total
    item = F.when(large, _own(F.col("key"))).otherwise(_shared(F.col("key"), owners, hashed))
    pieces = F.when(large, F.ceil(F.col("n") * F.lit(owners) / total)).otherwise(F.lit(1).cast("long"))
    items = counts.select(item.alias("item"), "n", pieces.alias("pieces"))
    items = items.groupBy("item").agg(F.sum("n").alias("n"), F.max("pieces").alias("pieces"))
    each = items.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"))
    cut = each.select(
        "item", F.col("piece").cast("int").alias("piece"),
        (F.floor(F.col("n") / F.col("pieces")) + (F.col("piece") < F.col("n") % F.col("pieces")).cast("long")).alias("records"),
    )
    # 33 items for each owner, and one owner more for each cut: a bounded list, in one row.
    turn = F.struct((-F.col("records")).alias("less"), "item", "piece")
    listed = cut.agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def give(state: Column, piece: Column) -> Column:
        least = F.array_position(state["loads"], F.array_min(state["loads"]))
        loads = F.transform(state["loads"], lambda load, i: F.when(i + 1 == least, load - piece["less"]).otherwise(load))
        return F.struct(loads.alias("loads"), F.concat(state["owners"], F.array((least - 1).cast("int"))).alias("owners"))

    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), owners).alias("loads"), F.array().cast("array<int>").alias("owners")
    )
    dealt = listed.select("turns", F.aggregate("turns", start, give)["owners"].alias("owners"))
    return dealt.select(F.explode(F.arrays_zip("turns", "owners")).alias("t")).select(
        "t.turns.item", "t.turns.piece", (-F.col("t.turns.less")).alias("records"), F.col("t.owners").alias("owner")
    )


def with_owner(
    rows: DataFrame, placed: DataFrame, key: str, spread_by: str, owners: int, hashed: Hash = F.xxhash64
) -> DataFrame:
    """``rows`` with the owner of each by a plan made with the same key, owners and hash.

    The rows of a key that was cut are dealt to its pieces by the hash of ``spread_by``.  A key that the plan does
    not know goes with its bucket, and a bucket that it does not know to the owner its number falls to.
    """
    # Broadcast is bounded by the number of items, 33 for each owner.
    table = placed.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("piece", "owner"))).alias("pieces"))
    own, shared = (F.broadcast(table.select(F.col("item").alias(f"_{n}"), F.col("pieces").alias(f"_{n}_pieces"))) for n in ("own", "shared"))
    joined = rows.join(own, _own(rows[key]) == F.col("_own"), "left").join(
        shared, _shared(rows[key], owners, hashed) == F.col("_shared"), "left"
    )
    pieces = F.coalesce("_own_pieces", "_shared_pieces")
    chosen = F.get(pieces, F.pmod(hashed(F.col(spread_by)), F.size(pieces)).cast("int"))["owner"]
    unknown = F.pmod(_bucket(F.col(key), owners, hashed), F.lit(owners)).cast("int")
    return joined.select(*[rows[c] for c in rows.columns], F.coalesce(chosen, unknown).alias("owner"))
