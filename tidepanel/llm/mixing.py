"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_size) -> also ord, weight, target.

    Sources in code-point order, null last, take the weights in turn and share `share` times all
    sizes. A target stops at `most` times its source's size and the excess is reshared by weight:
    with sources in the order of cap per weight, the common level is that of the first source which
    stays under its cap. One row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("ord", F.row_number().over(order).cast("int"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("ord") - 1, F.lit(len(weights))) + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), "ord")
    before, after = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    levels = ranked.withColumn(
        "level",
        (F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after),
    ).withColumn("place", F.row_number().over(by_need))
    free = F.col("cap") / F.col("weight") > F.col("level")
    level = F.min_by("level", F.when(free, F.col("place"))).over(whole)
    return levels.withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * level, F.col("cap").cast("double")))).select(
        "source", "source_size", "ord", "target"
    )


def sainte_lague(votes: DataFrame, group: list[str], vote: str, seats: str, order: str, out: str) -> DataFrame:
    """Add `out`: the integer share of `seats` (a column, equal within a group) by highest quotients vote/(2k+1).

    Shares at a divisor safely above the right one are certain; only the few seats between them and
    those at a divisor safely below are settled by ranking quotients, about two rows per voter. Ties
    go to the smaller `order`. Votes of 0 get nothing.
    """
    within = Window.partitionBy(*group)
    n = F.sum(F.when(F.col(vote) > 0, 1).otherwise(0)).over(within)
    total = F.sum(vote).over(within)
    sized = votes.withColumn("_n", n.cast("double")).withColumn("_total", total.cast("double"))
    sure = F.col(seats) - F.col("_n") / 2 - 1
    low = F.when((sure > 0) & (F.col(vote) > 0), F.floor(F.col(vote) * sure / F.col("_total") + 0.5)).otherwise(0).cast("long")
    high = F.when(F.col(vote) > 0, F.floor(F.col(vote) * (F.col(seats) + F.col("_n") / 2 + 1) / F.col("_total") + 0.5) + 1).otherwise(0).cast("long")
    sized = sized.withColumn("_low", low).withColumn("_high", high)
    open_ = sized.withColumn("_left", F.col(seats) - F.sum("_low").over(within)).where("_high > _low")
    quotients = open_.withColumn("_k", F.explode(F.sequence("_low", F.col("_high") - 1))).withColumn("_q", F.col(vote) / (2 * F.col("_k") + 1))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("_q").desc(), order, "_k"))
    won = quotients.withColumn("_r", rank).where("_r <= _left").groupBy(*group, order).agg(F.count("*").alias("_won"))
    return sized.join(won, [*group, order], "left").withColumn(out, F.col("_low") + F.coalesce("_won", F.lit(0))).drop("_n", "_total", "_low", "_high", "_won")


def _digest(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def _mix_plan(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5, most: int = 2, block: int = 64, shard_words: int = 1 << 20, seed: int = 17,
) -> DataFrame:
    """What mix_sources describes, and each document's source and shard: _id, ord, shard, size, source_size, target, taken."""
    size = F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")
    docs = documents.select(F.col(id_column).alias("_id"), F.col(source_column).cast("string").alias("source"), size.alias("size")).where("_id is not null")
    docs = docs.groupBy("_id").agg(F.min(F.struct(F.col("source").isNull().alias("none"), "source", "size")).alias("row"))
    docs = docs.select("_id", "row.source", "row.size")
    digest = lambda *parts: _digest(seed, *parts)

    sources = source_targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    sources = sources.withColumn("_all", F.lit(1)).withColumn("blocks", F.floor(F.sum("target").over(Window.partitionBy()) / block + 0.5).cast("long"))
    sources = sainte_lague(sources, ["_all"], "target", "blocks", "ord", "quota").drop("_all", "blocks")
    sources = sources.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long"))

    placed = docs.join(sources, docs["source"].eqNullSafe(sources["source"])).select(docs["_id"], "size", "ord", "source_size", "target", "quota", "shards")
    placed = placed.withColumn("key", digest(F.col("_id")))
    placed = placed.withColumn("shard", F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), F.col("shards")))
    line = Window.partitionBy("ord", "shard").orderBy("key", "_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("stop", F.sum("size").over(line)).withColumn("start", F.col("stop") - F.col("size"))

    shards = placed.groupBy("ord", "shard", "quota").agg(F.sum("size").alias("words")).where("words > 0")
    shards = sainte_lague(shards, ["ord"], "words", "quota", "shard", "seats")
    # few rows here become all blocks: a number of partitions of their own keeps them from being coalesced into one task
    shards = shards.repartition(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), "ord", "shard")
    cut = shards.select("ord", "shard", "words", "seats", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("words") - 1) / block))).alias("b"))
    rank = F.row_number().over(Window.partitionBy("ord", "shard").orderBy(digest(F.col("ord"), F.col("shard"), F.col("b")), "b"))
    count = F.ceil(F.col("words") / block)
    cut = cut.withColumn("_rank", rank).withColumn("times", sum(F.when(F.col("_rank") <= F.col("seats") - count * p, 1).otherwise(0) for p in range(most)))
    cut = cut.where("times > 0").select("ord", "shard", "b", "times")  # exploded, so Spark takes it for small: not to be broadcast

    spans = placed.where("size > 0").withColumn("b", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("stop") - 1) / block))))
    overlap = F.least(F.col("stop"), (F.col("b") + 1) * block) - F.greatest(F.col("start"), F.col("b") * block)
    taken = spans.select("_id", "ord", "shard", "b", overlap.alias("overlap")).join(cut.hint("merge"), ["ord", "shard", "b"]).groupBy("_id").agg(F.sum(F.col("overlap") * F.col("times")).alias("taken"))
    return placed.join(taken, "_id", "left").select("_id", "ord", "shard", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_sources(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    block: int = 64,
    shard_words: int = 1 << 20,
    seed: int = 17,
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words the mix takes, repeats counted).

    Blocks of `block` words go to sources by highest quotients of their targets, and within a source
    to shards of about `shard_words` words by highest quotients of the shards' words. In a shard the
    documents follow each other in a seeded order, their words are cut into blocks, and the blocks
    with the smallest seeded digests are taken, all of them once before any is taken again, none more
    than `most` times. Sources are cut into shards of bounded size, so no source is one task's work.

    A null text has size 0; null sources are one source, the last; rows that repeat an id are one
    document, the one with the smallest source and size; rows without an id are left out; an empty
    table gives no rows. Reruns agree: every choice hangs on digests of ids.
    """
    plan = _mix_plan(documents, id_column, text_column, source_column, weights, share, most, block, shard_words, seed)
    return plan.select(F.col("_id").alias(id_column), "size", "source_size", "target", "taken")


def mixed_documents(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = 17, **options) -> DataFrame:
    """The documents of the mix as whole texts: floor(taken / size) copies each, and one more for some.

    The words that whole copies leave over are settled per source and shard: documents with a rest
    follow each other by a seeded number over their rest's share of their size, so that each comes in
    about as often as its share says, and those whose middle lies within the shard's sum of rests get
    another copy. A shard's words so differ from those taken by half of one document at most.

    A row without an id is known by its text. Rows that repeat an id, or a text without one, come in
    together, as often as the one document that mix_sources takes them for.
    """
    columns = documents.columns
    key = F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit("text:"), F.sha1(F.coalesce(F.col(text_column), F.lit("")).cast("binary"))))
    name = fresh(documents, "_mix_key")
    documents = documents.withColumn(name, key)
    plan = _mix_plan(documents, name, text_column, seed=seed, **options).where("taken > 0")
    rest = F.col("taken") % F.col("size")
    draw = (F.conv(F.substring(_digest(seed, F.lit("copy"), F.col("_id")), 1, 12), 16, 10).cast("double") + 1) / float(1 << 48)
    plan = plan.withColumn("_rest", rest).withColumn("_key", F.when(rest > 0, draw * F.col("size") / rest))
    shard = Window.partitionBy("ord", "shard")
    line = shard.orderBy(F.col("_key").asc_nulls_last(), "_id").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.sum("size").over(line) - F.col("size") / 2
    more = ((F.col("_rest") > 0) & (middle <= F.sum("_rest").over(shard))).cast("int")
    copies = F.floor(F.col("taken") / F.col("size")).cast("int") + more
    plan = plan.select(F.col("_id").alias("_mix_id"), copies.alias("_copies")).where("_copies > 0")
    joined = documents.join(plan, documents[name] == plan["_mix_id"])
    return joined.select(*[documents[c] for c in columns], F.explode(F.sequence(F.lit(1), plan["_copies"])).alias(fresh(documents, "_copy"))).select(*columns)


ORACLE_SQL = r"""
WITH docs0 AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents WHERE doc_id IS NOT NULL),
docs AS (SELECT doc_id, source, size FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY source NULLS LAST, size) AS rn FROM docs0) WHERE rn = 1),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS ord FROM s0),
s2 AS (SELECT *, ([3, 1, 2])[((ord - 1) % 3) + 1] AS weight, source_size * 2 AS cap FROM s1),
s3 AS (SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / weight, ord) AS place,
  ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
  / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, ord ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM s2),
lvl AS (SELECT min_by(level, place) AS level FROM s3 WHERE cap::DOUBLE / weight > level),
s4 AS (SELECT s3.source, source_size, ord, least(cap::DOUBLE, coalesce(weight * (SELECT level FROM lvl), cap::DOUBLE)) AS target FROM s3),
s5 AS (SELECT *, CAST(floor((sum(target) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) / 64 + 0.5) AS BIGINT) AS blocks FROM s4),
sq AS (SELECT ord, k, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, ord, k) AS r, blocks
  FROM (SELECT ord, target, blocks, unnest(range(0, CAST(floor(target / 64) AS BIGINT) + 66)) AS k FROM s5 WHERE target > 0)),
quota AS (SELECT ord, count(*) AS quota FROM sq WHERE r <= blocks GROUP BY ord),
src AS (SELECT s5.source, s5.ord, source_size, target, coalesce(quota, 0) AS quota, greatest(1, CAST(ceil(source_size / 1048576.0) AS BIGINT)) AS shards FROM s5 LEFT JOIN quota USING (ord)),
p0 AS (SELECT doc_id, size, ord, source_size, target, quota, shards, md5('17|' || CAST(doc_id AS VARCHAR)) AS key FROM docs JOIN src ON docs.source IS NOT DISTINCT FROM src.source),
p1 AS (SELECT *, CAST('0x' || substr(key, 1, 8) AS BIGINT) % shards AS shard FROM p0),
p2 AS (SELECT *, sum(size) OVER (PARTITION BY ord, shard ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM p1),
placed AS (SELECT *, stop - size AS start FROM p2),
sh AS (SELECT ord, shard, quota, sum(size)::BIGINT AS words FROM placed GROUP BY ord, shard, quota HAVING sum(size) > 0),
shq AS (SELECT ord, shard, quota, row_number() OVER (PARTITION BY ord ORDER BY words::DOUBLE / (2 * k + 1) DESC, shard, k) AS r
  FROM (SELECT *, unnest(range(0, CAST(floor(words / 32) AS BIGINT) + 66)) AS k FROM sh)),
seats AS (SELECT ord, shard, count(*) AS seats FROM shq WHERE r <= quota GROUP BY ord, shard),
b0 AS (SELECT sh.ord, sh.shard, words, coalesce(seats, 0) AS seats, unnest(range(0, (words - 1) // 64 + 1)) AS b FROM sh LEFT JOIN seats USING (ord, shard)),
b1 AS (SELECT *, (words + 63) // 64 AS n, row_number() OVER (PARTITION BY ord, shard ORDER BY md5('17|' || ord || '|' || shard || '|' || b), b) AS rk FROM b0),
cut AS (SELECT ord, shard, b, (CASE WHEN rk <= seats THEN 1 ELSE 0 END) + (CASE WHEN rk <= seats - n THEN 1 ELSE 0 END) AS times FROM b1),
sp AS (SELECT doc_id, ord, shard, start, stop, unnest(range(CAST(start // 64 AS BIGINT), CAST((stop - 1) // 64 + 1 AS BIGINT))) AS b FROM placed WHERE size > 0),
taken AS (SELECT doc_id, sum((least(stop, (sp.b + 1) * 64) - greatest(start, sp.b * 64)) * times)::BIGINT AS taken FROM sp JOIN cut USING (ord, shard, b) GROUP BY doc_id)
SELECT placed.doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM placed LEFT JOIN taken USING (doc_id)
"""
