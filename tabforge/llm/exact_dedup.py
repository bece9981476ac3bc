"""Exact duplicates by deterministic naming of blocks.

A text is cut into blocks of fixed size.  Sorting brings equal blocks
together, and each distinct block is named by its smallest occurrence, the
integers (document, hash, block number).  Adjacent pairs of names are then
named in the same way, level after level, until one name is left for each
document.  Names rest on contents alone, so they are free of collisions;
hashes only say which contents are frequent.

A content that makes up more than ``1 / (SPREAD * partitions)`` of all rows is
hot.  There are at most ``SPREAD * partitions`` of these, so their hashes can
be broadcast; their rows are salted, named in each salt, and the few salted
names are then joined into one.

Edge cases: a null or empty text is one empty block; null ids are equal to one
another and smaller than any other id; repeated rows of one id count as the
rows they are, share one fate and are each returned; texts that differ under
one id are different documents; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize, shuffle_partitions

BLOCK_BYTES = 4096
SPREAD = 10
NO_ID = -(1 << 63)

_OCC = ("doc", "h", "k")


def blocks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc, h, k, blocks, block: the blocks of every document, in bytes."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("h"),
                       text.cast("binary").alias("data"))
    last = F.greatest(F.lit(0), F.floor((F.octet_length("data") - 1) / block_bytes).cast("int"))
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col("data"), i * block_bytes + 1, F.lit(block_bytes)))
    rows = rows.select("doc", "h", (last + 1).alias("blocks"), cut.alias("parts"))
    return rows.select("doc", "h", "blocks", F.posexplode("parts").alias("k", "block"))


def name_contents(rows: DataFrame, content: list[str]) -> DataFrame:
    """doc, h, k, blocks, name for ``rows`` (doc, h, k, blocks, content...)."""
    parts = shuffle_partitions(rows.sparkSession)
    key = F.xxhash64(*content)
    counts = materialize(rows.groupBy(key.alias("ch")).count().where("count > 1"), "content-counts")
    total = rows.count()
    share = max(1, total // (SPREAD * parts))
    hot = counts.where(F.col("count") > share).select("ch", F.ceil(F.col("count") / share).cast("int").alias("salts"))
    # at most SPREAD * parts rows, see above
    salted = (rows.withColumn("ch", key).join(F.broadcast(hot), "ch", "left")
              .withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*_OCC), F.col("salts")))))
    own = F.struct(*_OCC)
    local = F.min(own).over(Window.partitionBy(*content, "salt"))
    salted = salted.withColumn("local", local)
    first = F.col("salts").isNotNull() & (F.col("local") == own)
    named = materialize(salted.select(*_OCC, "blocks", F.col("salts").isNotNull().alias("hot"), "local",
                                      F.when(first, F.struct(*content)).alias("seen")), "local-names")
    # one row for each salt of a hot content: at most 2 * SPREAD * parts rows
    heads = named.where("seen IS NOT NULL").select("seen", "local").distinct()
    whole = heads.select(F.col("local").alias("of"), F.min("local").over(Window.partitionBy("seen")).alias("name"))
    cold = named.where("NOT hot").select(*_OCC, "blocks", F.col("local").alias("name"))
    warm = named.where("hot").join(F.broadcast(whole), F.col("local") == F.col("of")).select(*_OCC, "blocks", "name")
    return cold.unionByName(warm)


def identities(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc, h, level, name: equal (level, name) if and only if texts are equal."""
    now = materialize(name_contents(blocks(docs, id_col=id_col, text_col=text_col, block_bytes=block_bytes), ["block"]), "names")
    done, level = [], 0
    while True:
        done.append(now.where("blocks = 1").select("doc", "h", F.lit(level).alias("level"), "name"))
        rest = now.where("blocks > 1")
        if rest.isEmpty():
            break
        half = F.col("k") % 2
        pairs = (rest.groupBy("doc", "h", F.floor(F.col("k") / 2).cast("int").alias("k"),
                              F.ceil(F.col("blocks") / 2).cast("int").alias("blocks"))
                 .agg(F.min(F.when(half == 0, F.col("name"))).alias("left"), F.min(F.when(half == 1, F.col("name"))).alias("right")))
        now = materialize(name_contents(materialize(pairs, "pairs"), ["left", "right"]), "names")
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return materialize(out.distinct(), "identities")


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, h, keep_id, group_size (rows), kept for every document; the largest
    id of equal texts stays.  ``h`` is the xxhash64 of the text."""
    ident = identities(docs, id_col=id_col, text_col=text_col, block_bytes=block_bytes)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows_of = docs.groupBy(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("of_doc"), F.xxhash64(text).alias("of_h")).count()
    more = materialize(rows_of.where("count > 1"), "repeated-rows")
    counted = ident.join(more, (F.col("doc") == F.col("of_doc")) & (F.col("h") == F.col("of_h")), "left")
    sizes = counted.groupBy("level", "name").agg(F.max("doc").alias("keep"), F.sum(F.coalesce("count", F.lit(1))).alias("group_size"))
    sizes = materialize(sizes, "groups")
    rows = ident.join(sizes, ["level", "name"])
    return rows.select(_id("doc").alias("doc_id"), "h", _id("keep").alias("keep_id"), "group_size",
                       (F.col("doc") == F.col("keep")).alias("kept"))


def _id(name: str) -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name))


def exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    found = groups(docs, id_col=id_col, text_col=text_col, block_bytes=block_bytes)
    found = materialize(found, "found").withColumnRenamed("doc_id", "found_id").withColumnRenamed("h", "found_h")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), F.sha2(text.cast("binary"), 256).alias("text_sha256"))
    return (rows.join(found, rows.doc_id.eqNullSafe(found.found_id) & (rows.h == found.found_h))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))
