"""Exact de-duplication by two-pass Bloom filtering, in DataFrame functions only.

Pass one sets a bit position for every text's digest and keeps the positions that were hit at least twice. A digest
that occurs twice hits its position twice, so a row with a position outside that set is certainly unique and
passes straight through. Pass two sends only the other rows through a shuffle, where the digests themselves decide. With one position a row
and 32 bits a row, some 3 percent of the unique rows go through it too; two positions in half the bits would spare half of these, but
would exchange twice as many positions in pass one.

Digests are dealt to ranges by a hash, each with a filter of its own that is small enough to be broadcast, and the narrow table of digests is
gone over once per range, which reads its own files alone. So one path serves any number of rows, and the rows themselves never move to be
tested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, fresh, joined, removed, scratch_path, text_or_empty, written

SEGMENT_BITS = 8 * 4096  # of one bitmap of bitmap_construct_agg
FILTER_BYTES = 32 << 20  # of the filter of one range
BITS_PER_ROW = 32


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. On pure ASCII this is ``lower``, which is much faster than ``translate``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def _bit(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.coalesce(F.getbit(byte, (position % 8).cast("int")), F.lit(0)) == 1


def mark_possible_repeats(rows: DataFrame, digest: str = "digest", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``rows`` with a boolean ``maybe``; where it is false, no other row has the same 16-byte-or-longer digest.

    Rows are narrow: they are written, once as they are and once marked. Equal digests are counted in the tasks first, so one that a third
    of all rows have is a row a task. The filters of all ranges are made together.
    """
    spark, n = rows.sparkSession, rows.count()
    ranges = max(1, -(-n * BITS_PER_ROW // (8 * filter_bytes)))
    segments = max(1, -(-n * BITS_PER_ROW // (ranges * SEGMENT_BITS)))
    at = F.pmod(F.xxhash64(F.col(digest), F.lit(1)), F.lit(segments * SEGMENT_BITS))
    placed = rows.withColumns({"_at": at, "_range": F.pmod(F.xxhash64(F.col(digest), F.lit(0)), F.lit(ranges)).cast("int")})
    folder = scratch_path(spark, "placed")
    placed.write.partitionBy("_range").parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)
    hit = (
        placed.groupBy("_range", "_at").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .groupBy("_range", F.floor(F.col("_at") / SEGMENT_BITS).alias("_segment")).agg(F.bitmap_construct_agg(F.col("_at") % SEGMENT_BITS).alias("_bitmap"))
    )
    filters = written(hit, "bloom")
    path = scratch_path(spark, "marked")
    for k in range(ranges):
        own = placed.where(F.col("_range") == k).withColumn("_segment", F.floor(F.col("_at") / SEGMENT_BITS))
        met = own.join(F.broadcast(filters.where(F.col("_range") == k).select("_segment", "_bitmap")), "_segment", "left")
        met.select(*rows.columns, _bit(F.col("_bitmap"), F.col("_at") % SEGMENT_BITS).alias("maybe")).write.mode("append").parquet(path)
    dropped(filters)
    removed(spark, folder)
    marked = spark.read.parquet(path)
    marked._scratch = path
    return marked


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per row of ``docs``: its id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after lower-casing A-Z only; null counts as empty, so null and empty texts form one
    group. The row with the largest id of a group stays; a null id is smaller than any other. Of repeated rows with
    the same id and text every one gives a row, and all with the largest id are marked as kept. An empty table gives
    an empty result. Other columns of ``docs`` are neither read nor returned, so their names cannot clash.

    Large groups are joined back by broadcast, one row each; their number is bounded (see ``joined``). All others are joined by their digest.
    """
    rows = written(docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(ascii_lower(text_or_empty(text_col)), 256)).alias("digest")), "digests")
    marked = mark_possible_repeats(rows, filter_bytes=filter_bytes)
    dropped(rows)
    alone = marked.where(~F.col("maybe")).select("id", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    again = marked.where("maybe").select("id", "digest")
    groups = written(again.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    return alone.unionByName(joined(again, groups, "digest").select("id", "digest", "keep_id", "group_size")).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", few: int = 200_000) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept; of fully repeated rows (equal id and text) one stays.

    Rows are matched with ``exact_groups`` by id and digest. The list of ids that go is far smaller than the table; it is broadcast while it
    has at most ``few`` rows, and joined beyond.
    """

    own_id, own_sha, key = fresh(docs, "_id", "_sha", "_key")

    def side(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id_col).alias(own_id), F.col("text_sha256").alias(own_sha))
        return F.broadcast(df) if df.count() <= few else df

    groups = written(exact_groups(docs, id_col, text_col), "exact")
    sha = F.sha2(ascii_lower(text_or_empty(text_col)), 256)
    on = F.col(id_col).eqNullSafe(F.col(own_id)) & (sha == F.col(own_sha))
    stay = docs.join(side(groups.where(~F.col("kept")).distinct()), on, "left_anti")
    doubled = groups.where("kept").groupBy(id_col, "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if doubled.isEmpty():
        return stay
    again = side(doubled)
    ones = stay.join(again, on, "left_semi").withColumn(key, sha).dropDuplicates([id_col, key]).drop(key)
    return stay.join(again, on, "left_anti").unionByName(ones)
