"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Lengths and prefix hashes go into a narrow table. A row survives the first
level if its length occurs again, the second if length and prefix hash do; only
survivors have their whole text hashed. Whether a row survives is looked up in
hashed buckets, at most BUCKETS of them, so the broadcast table has a fixed
bound; two keys in one bucket only cause a text to be hashed needlessly. No text
is moved to find the groups.

Texts are equal when identical after lower-casing A-Z; null counts as empty. Of
equal texts the row with the largest doc_id stays. A null id counts as smaller
than any; if all are null, keep_id is null and the rows count as kept. Rows with
the same id and equal text are all marked kept; ``drop_copies`` leaves one of
them. Clashing or extra columns do not matter to the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.llm.common import attach, free_name, text_of, written

BUCKETS = 1 << 20
PREFIX_CHARACTERS = 48
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z in lower case. For ASCII text that is what ``lower`` does, and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def bucket_of(*columns: str | Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def repeated(keys: DataFrame, *columns: str) -> DataFrame:
    """Buckets of the keys that occur more than once."""
    counts = keys.groupBy(*columns).count().filter("count > 1")
    return F.broadcast(counts.select(bucket_of(*columns).alias("bucket")).distinct())


def _survivors(docs: DataFrame, text_column: str) -> DataFrame:
    """Buckets of (length, prefix hash) that survive both cheap levels."""
    text = text_of(text_column)
    keys = written(docs.select(F.octet_length(text).alias("length"), _prefix(text).alias("prefix")), "prefix-keys")
    longs = keys.join(repeated(keys, "length"), bucket_of("length") == F.col("bucket"), "left_semi")
    return written(repeated(longs, "length", "prefix"), "prefix-buckets")


def _prefix(text: Column) -> Column:
    return F.xxhash64(normalised(F.substring(text, 1, PREFIX_CHARACTERS)))


def _split(docs: DataFrame, text_column: str, bucket: str) -> tuple[DataFrame, DataFrame]:
    """The rows that no other row can equal, and the survivors."""
    text = text_of(text_column)
    found = F.broadcast(_survivors(docs, text_column).withColumnRenamed("bucket", bucket))
    tagged = docs.withColumn(bucket, bucket_of(F.octet_length(text), _prefix(text)))
    return tagged.join(found, bucket, "left_anti").drop(bucket), tagged.join(found, bucket, "left_semi").drop(bucket)


def duplicate_groups(docs: DataFrame, hash_all: bool = False) -> DataFrame:
    """One row per row: doc_id, keep_id, group_size, kept, text_hash. The hash
    is null for texts that were never read in full, unless ``hash_all``."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    single, shared = _split(base, "text", "bucket")
    full = F.sha2(normalised(F.col("text")).cast("binary"), 256)
    hashed = written(shared.select("doc_id", full.alias("text_hash")), "full-hashes")
    groups = hashed.groupBy("text_hash").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = written(groups, "groups")
    joined = attach(hashed, groups, ["text_hash"], "group_size", hashed.count())
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_hash"]
    joined = joined.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    alone = single.select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        (full if hash_all else F.lit(None).cast("string")).alias("text_hash"),
    )
    return joined.select(*columns).unionByName(alone.select(*columns))


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; one row of repeated rows.
    The join back uses hash and id together, so a large group is spread."""
    digest, keep, bucket = (free_name(docs, n) for n in ("text_hash", "keep_id", "bucket"))
    single, shared = _split(docs, text_column, bucket)
    hashed = shared.withColumn(digest, F.sha2(normalised(text_of(text_column)).cast("binary"), 256))
    groups = hashed.groupBy(digest).agg(F.max(id_column).alias(keep))
    groups = written(groups.withColumnRenamed(digest, f"{digest}_g"), "groups")
    same = (F.col(digest) == F.col(f"{digest}_g")) & F.col(id_column).eqNullSafe(F.col(keep))
    stay = hashed.join(groups, same, "left_semi").dropDuplicates([digest]).drop(digest)
    return single.unionByName(stay)
