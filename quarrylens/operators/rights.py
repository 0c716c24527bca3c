"""Access rights as bitmaps over ranges of document numbers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bit_at(bits: Column, number: Column) -> Column:
    """Whether the bit of ``number`` is set in the bitmap of its range."""
    place = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    return F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1


@dataclass(frozen=True)
class RightsIndex:
    """One bitmap per value of ``on`` and range of 32,768 document numbers.

    Grants are no part of it: a changed membership or grant touches no bitmap.  A caller's rights
    are the OR of the bitmaps of the granted values, and a document is tested by one bit, so a
    range holds at most 32,768 documents however common one value is.  Numbers should lie close
    together; each touched range costs 4 KB per value found in it.  Documents without a number or
    without a value have no bit, so nobody sees them.  Repeated rows set the same bit.
    """

    rows: DataFrame
    on: str
    id_col: str

    @classmethod
    def build(cls, docs: DataFrame, on: str = "source", id_col: str = "doc_id") -> RightsIndex:
        number = F.col(id_col).cast("bigint")
        known = docs.where(F.col(id_col).isNotNull() & F.col(on).isNotNull())
        rows = known.select(on, F.bitmap_bucket_number(number).alias("_range"), F.bitmap_bit_position(number).alias("_place"))
        return cls(rows.groupBy(on, "_range").agg(F.bitmap_construct_agg("_place").alias("_bits")), on, id_col)

    def extend(self, docs: DataFrame) -> RightsIndex:
        """The index with further documents; only their own bits are computed."""
        both = self.rows.unionByName(RightsIndex.build(docs, self.on, self.id_col).rows)
        return RightsIndex(_either(both, self.on), self.on, self.id_col)

    def save(self, path: str) -> None:
        self.rows.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, rows: DataFrame, on: str = "source", id_col: str = "doc_id") -> RightsIndex:
        """``rows`` as written by :meth:`save`."""
        return cls(rows, on, id_col)

    def by_group(self, acl: DataFrame) -> DataFrame:
        """``group_name``, range and bitmap; ``acl`` is (group_name, <on>)."""
        granted = acl.select("group_name", self.on).distinct()
        return _either(self.rows.join(granted, self.on), "group_name")

    def by_principal(self, memberships: DataFrame, acl: DataFrame) -> DataFrame:
        """``principal``, range and bitmap: the OR over the principal's groups."""
        members = memberships.select("principal", "group_name").distinct()
        return _either(self.by_group(acl).join(members, "group_name"), "principal")

    def counts(self, memberships: DataFrame, acl: DataFrame) -> DataFrame:
        """``principal`` and ``documents``: how many each may see; those who see none are left out.

        Principals in the same granted groups see the same: bitmaps are united and counted once per
        set of groups, never per principal.
        """
        granted = acl.select("group_name").distinct()
        members = memberships.select("principal", "group_name").join(granted, "group_name", "left_semi")
        sets = members.groupBy("principal").agg(F.sort_array(F.collect_set("group_name")).alias("_groups"))
        classes = sets.select("_groups").distinct().withColumn("group_name", F.explode("_groups"))
        either = self.by_group(acl).join(classes, "group_name").groupBy("_groups", "_range").agg(F.bitmap_or_agg("_bits").alias("_bits"))
        seen = either.groupBy("_groups").agg(F.sum(F.bitmap_count("_bits")).alias("documents"))
        return sets.join(seen, "_groups").select("principal", "documents")

    def restrict(self, docs: DataFrame, principal: str, memberships: DataFrame, acl: DataFrame) -> DataFrame:
        """The rows of ``docs`` that the principal may see, with their columns."""
        own = memberships.where(F.col("principal") == principal).select("group_name").distinct()
        mine = acl.join(own, "group_name", "left_semi").select(self.on).distinct()
        bits = self.rows.join(mine, self.on, "left_semi").groupBy("_range").agg(F.bitmap_or_agg("_bits").alias("_bits"))
        number = docs[self.id_col].cast("bigint")
        return docs.join(bits, (F.bitmap_bucket_number(number) == bits["_range"]) & bit_at(bits["_bits"], number), "left_semi")


def _either(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key, "_range").agg(F.bitmap_or_agg("_bits").alias("_bits"))
