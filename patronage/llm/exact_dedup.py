"""Exact duplicates by a content sort, with DataFrame functions only.

Sampled splitters range-partition the normalised text (by its head, then by a hash of the
whole, so that splitters stay small), an external sort places equal texts side by side,
and comparing neighbours in full finds the groups (the window's group boundary is just
that comparison). A text that holds more than 1/256 of all
rows is dealt over several sort ranges by a salt; the sizes and survivors of these at
most 255 texts come from a count that is combined before its shuffle.

Defined cases: a null text counts as empty. A null identifier is smaller than any
other. Of rows that agree in text and identifier exactly one is kept. An empty table
gives no rows. Other columns, whatever their names, do not take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import ascii_lower, hot_keys

SALTS = 64
#: Characters of the text that the sampled splitters carry; texts that agree in them are dealt by a hash of the whole.
HEAD = 48


def _groups(docs: DataFrame, id_col: str, text_col: str, columns: list[str], salts: int) -> DataFrame:
    """_row (the given columns), keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))
    norm = ascii_lower(F.coalesce(F.col("_row")[text_col], F.lit("")))
    ident = F.col("_row")[id_col]
    digest = F.sha2(norm, 256)
    hot = hot_keys(rows.select(digest.alias("_hot"), ident.alias("_id")), "_hot", F.max("_id").alias("_hot_keep"))
    salt = F.when(F.col("_hot").isNull(), 0).otherwise(F.pmod(F.xxhash64(ident), F.lit(salts)))
    ranged = rows.join(F.broadcast(hot), digest == F.col("_hot"), "left")
    keyed = ranged.select("*", norm.alias("_norm"), F.substring(norm, 1, HEAD).alias("_head"), F.xxhash64(norm).alias("_hash"), salt.alias("_salt"))
    ranged = keyed.repartitionByRange("_head", "_hash", "_salt")
    group = Window.partitionBy("_head", "_hash", "_salt", "_norm")
    mine = ranged.select(
        "*",
        F.row_number().over(group.orderBy(ident.desc_nulls_last())).alias("_nth"),
        F.max(ident).over(group).alias("_keep"),
        F.count(F.lit(1)).over(group).alias("_size"),
    )
    is_hot = F.col("_hot").isNotNull()
    keep = F.when(is_hot, F.col("_hot_keep")).otherwise(F.col("_keep"))
    return mine.select(
        "_row",
        keep.alias("keep_id"),
        F.when(is_hot, F.col("hot_rows")).otherwise(F.col("_size")).alias("group_size"),
        ((F.col("_nth") == 1) & ident.eqNullSafe(keep)).alias("kept"),
        F.sha2(F.col("_norm"), 256).alias("text_sha256"),
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per document: the identifier, keep_id, group_size, kept, text_sha256."""
    found = _groups(docs, id_col, text_col, [id_col, text_col], salts)
    return found.select(F.col("_row")[id_col].alias(id_col), "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The documents that stay, with their own columns."""
    return _groups(docs, id_col, text_col, docs.columns, salts).where("kept").select("_row.*")
