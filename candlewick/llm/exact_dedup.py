"""Exact deduplication by skew-safe combining (DataFrame operations only).

1. *Local*: the map side of the first aggregation keeps one row per
   ``(digest, salt, text)`` and task, so a task sends at most one copy of a
   text per salt however often it occurs.
2. *Salted groups*: those rows meet by ``(digest, salt, text)``; a text copied
   a billion times is spread over ``salts`` groups.
3. *Global*: the salt winners (at most ``salts`` rows a text) meet by
   ``(digest, text)``.

The whole text is a grouping key at every stage, so equal digests never merge
different texts. A digest found to stand for exactly one text is then enough
to hand the result back to the documents, as a narrow join on the digest; texts
whose digests collide (none, for SHA-256) are joined on digest and text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import hidden, pick, position
from candlewick.session import cut_lineage


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def content_classes(base: DataFrame, salts: int = 16) -> DataFrame:
    """``base`` has ``doc_id, text, digest``. One row per distinct text:
    ``digest, text, keep_id, group_size``."""
    salted = base.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    winners = salted.groupBy("digest", "salt", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    return winners.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))


def mark_duplicates(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    salts: int = 16,
    digest: Callable[[Column], Column] = sha256_digest,
) -> DataFrame:
    """Every row of ``docs`` (all its columns, hidden names ``_inN``) plus
    ``digest, keep_id, group_size, kept``.

    Of equal texts the largest id stays; a null text counts as empty. Rows
    that repeat an id with the same text share one verdict. A null id loses
    to any other; in a group of null ids only, all rows are kept (they cannot
    be told apart), with a null ``keep_id``. An empty table gives an empty
    result. Very long texts are compared whole; extra columns are passed
    through, whatever their names.
    """
    raw, names = hidden(docs)
    doc_id, text = F.col(position(names, id_col)), F.coalesce(F.col(position(names, text_col)), F.lit(""))
    base = pick(docs, id_col, text_col).toDF("doc_id", "text")
    base = base.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    classes = content_classes(base.withColumn("digest", digest(F.col("text"))), salts)
    by_digest = cut_lineage(
        classes.groupBy("digest").agg(
            F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
        ),
        "exact-dedup",
    )
    marked = raw.withColumn("digest", digest(text))
    single = by_digest.where("texts = 1").drop("texts")
    out = marked.join(single, "digest")
    if not by_digest.where("texts > 1").isEmpty():
        clashing = by_digest.where("texts > 1").select("digest")
        exact = classes.join(clashing, "digest", "left_semi").withColumnRenamed("text", "_text")
        out = out.unionByName(marked.withColumn("_text", text).join(exact, ["digest", "_text"]).drop("_text"))
    return out.withColumn("kept", doc_id.eqNullSafe(F.col("keep_id")))


def deduplicate(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    salts: int = 16,
    digest: Callable[[Column], Column] = sha256_digest,
) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``; ties,
    nulls and repeated rows as in ``mark_duplicates``.

    The winners carry their other columns through the same local, salted and
    global stages, so whole rows are shuffled by those alone and never meet a
    join. Only texts whose winning id is null or comes more than once (found
    on narrow columns) are handed back to all rows of that id, by a join.
    """
    raw, names = hidden(docs)
    doc_id, own = position(names, id_col), position(names, text_col)
    rest = [c for c in raw.columns if c not in (doc_id, own)]
    rows = raw.withColumn("text", F.coalesce(F.col(own), F.lit(""))).withColumn("digest", digest(F.col("text")))
    again = cut_lineage(
        rows.groupBy(F.col(doc_id).alias("_id"), F.col("digest").alias("_digest")).agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1 OR _id IS NULL").select("_id", "_digest"),
        "exact-again",
    )
    carried = F.struct(F.col(own).isNull().alias("empty"), *rest)
    salted = rows.select(
        "digest", F.pmod(F.xxhash64(doc_id), F.lit(salts)).alias("salt"), "text", F.col(doc_id).alias("id"), carried.alias("carried")
    )
    best = (F.max("id").alias("id"), F.max_by("carried", "id").alias("carried"))
    winners = salted.groupBy("digest", "salt", "text").agg(*best).groupBy("digest", "text").agg(*best).where("id IS NOT NULL")
    plain = {doc_id: F.col("id"), own: F.when(~F.col("carried.empty"), F.col("text"))}
    out = [plain[c] if c in plain else F.col("carried." + c) for c in raw.columns]
    if again.isEmpty():
        return winners.select(*out).toDF(*names)
    same = lambda i: F.col(i).eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    kept = winners.join(again, same("id"), "left_anti").select(*out).toDF(*raw.columns)
    open_ = rows.join(again, same(doc_id), "left_semi")
    base = rows.select(F.col(doc_id).alias("doc_id"), "text", "digest").join(again.select(F.col("_digest").alias("digest")), "digest", "left_semi")
    decided = open_.join(content_classes(base, salts), ["digest", "text"]).where(F.col(doc_id).eqNullSafe(F.col("keep_id")))
    return kept.unionByName(decided.select(*raw.columns)).toDF(*names)
