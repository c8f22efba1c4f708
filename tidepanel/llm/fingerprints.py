"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

For a word x of weight w and sample j, r and c are Gamma(2,1) variates and b a uniform one, all fixed
by the hash of (x, j). With t = floor(ln w / r + b), the word's rank is c exp(-r (t - b + 1)); the
word of smallest rank gives the sample (x, t). Two texts agree in a sample with probability equal to
the generalised Jaccard similarity of their word counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SPACES = r"[\x20\x09-\x0D]+"
SAMPLES = 24
SAMPLES_A_ROW = 12  # generated code for more minima at once is too long for the JVM to compile


def word_hashes(text: Column) -> Column:
    """Hashes of a text's lower-cased words."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACES), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def signatures(texts: DataFrame, keys: list[str], text_column: str, samples: int = SAMPLES, carried: str | None = None) -> DataFrame:
    """keys -> print: 4 hexadecimal digits a sample, from the sample of smallest rank; '' for texts without a word.

    Rows must already be unique by keys. All aggregations are by the keys first, so where the
    input is partitioned by some of them nothing moves. A carried string comes along on one row a
    text, beside those of its words, and is a column of the result.
    """
    word = F.explode_outer(word_hashes(F.col(text_column)) if carried is None else F.array_append(word_hashes(F.col(text_column)), F.lit(None).cast("long"))).alias("x")
    more = [] if carried is None else ["more"]
    runs = texts.select(*keys, *[F.col(carried).alias("more") for _ in more], word)
    runs = runs.select(*keys, *[F.when(F.col("x").isNull(), F.col(m)).alias(m) for m in more], "x").groupBy(*keys, *more, "x").agg(F.count("*").alias("w"))
    runs = runs.select(*keys, *more, "x", F.ln(F.col("w").cast("double")).alias("lw"))
    low_bits = (1 << 32) - 1

    def uniform(h: Column, shift: int, bits: int) -> Column:
        """In (0, 1), from some of the bits of a hash."""
        return (F.shiftrightunsigned(h, shift).bitwiseAND((1 << bits) - 1) + 0.5) / float(1 << bits)

    def sample(j: int) -> Column:
        h, g = F.xxhash64("x", F.col("q") + 2 * j), F.xxhash64("x", F.col("q") + 2 * j + 1)
        r = -F.ln(uniform(h, 0, 21) * uniform(h, 21, 21))
        c = -F.ln(uniform(g, 0, 32) * uniform(g, 32, 32))
        b = uniform(h, 42, 22)
        t = F.floor(F.col("lw") / r + b)
        rank = F.least(c * F.exp(-r * (t - b + 1.0)) * float(1 << 27), F.lit(float((1 << 31) - 1))).cast("long")
        mark = F.col("x").bitwiseXOR(F.shiftleft(t, 16))
        return F.min(F.shiftleft(rank, 32).bitwiseOR(mark.bitwiseAND(low_bits))).alias(f"s{j}")  # null where x is: no condition, so that what r is made of is computed once

    width = min(samples, SAMPLES_A_ROW)
    sets = runs.withColumn("q", F.explode(F.array(*[F.lit(2 * width * i) for i in range(samples // width)])))
    minima = sets.groupBy(*keys, *more, "q").agg(*[sample(j) for j in range(width)])
    digits = [F.lpad(F.lower(F.hex(F.shiftrightunsigned(f"s{j}", 16).bitwiseAND(0xFFFF))), 4, "0") for j in range(width)]
    parts = minima.select(*keys, *more, F.struct("q", F.concat(*digits).alias("digits")).alias("part"))
    whole = F.concat_ws("", F.transform(F.array_sort(F.collect_list("part")), lambda p: p["digits"])).alias("print")
    return parts.groupBy(*keys).agg(whole, *[F.max(m).alias(carried) for m in more])


def likeness(a: str, b: str, samples: int = SAMPLES) -> Column:
    """The share of equal samples of two fingerprints; two empty ones are alike, an empty and another are not."""
    same = [F.when(F.substring(a, 4 * j + 1, 4) == F.substring(b, 4 * j + 1, 4), 1).otherwise(0) for j in range(samples)]
    return F.when((F.col(a) == "") | (F.col(b) == ""), (F.col(a) == F.col(b)).cast("double")).otherwise(sum(same) / float(samples))


def next_documents(documents: DataFrame, id_column: str, text_column: str, partitions: int) -> tuple[DataFrame, str]:
    """(doc, n_chars, next): each id's text length and the next larger id, after the last the first.

    Ids are range-partitioned; within a partition the next row is its next one, and across partitions
    the first of the next partition, found from one row a partition.
    """
    lengths = documents.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("doc")).agg(
        F.min(F.coalesce(F.char_length(text_column), F.lit(0))).cast("long").alias("n_chars")
    )
    ranged, path = written(lengths.repartitionByRange(partitions, "doc").withColumn("part", F.spark_partition_id()), "ids")
    heads = ranged.groupBy("part").agg(F.min("doc").alias("head"))
    heads = heads.select("part", F.lead("head").over(Window.orderBy("head")).alias("following"), F.min("head").over(Window.partitionBy()).alias("first"))
    within = F.lead("doc").over(Window.partitionBy("part").orderBy("doc"))
    return ranged.withColumn("within", within).join(F.broadcast(heads), "part").select("doc", "n_chars", F.coalesce("within", "following", "first").alias("next")), path


def fingerprint_documents(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", samples: int = SAMPLES, partitions: int | None = None) -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last quarter of code points replaced by the first as many (or all) of the
    next document's text. A null text is empty; an empty text, or one of blanks, has the empty
    fingerprint, which is like itself alone. Rows that repeat an id are one document, that of the
    shortest text, the smallest of those; rows without an id are left out; an only document is its own
    next; an empty table gives no rows. Texts move twice at most, by id: once whole, once the borrowed quarter.
    """
    spark = documents.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order, ids_path = next_documents(documents, id_column, text_column, parts)
    text = F.coalesce(F.col(text_column), F.lit(""))
    base = documents.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("doc")).agg(F.min(F.struct(F.char_length(text).alias("n"), text.alias("text"))).alias("kept"))
    base = base.select("doc", F.col("kept.text").alias("text"))
    wanted = order.select(F.col("next").alias("doc"), F.col("doc").alias("asker"), F.floor(F.col("n_chars") / 4).cast("int").alias("need"))
    lent = base.join(wanted.hint("shuffle_merge"), "doc").select(F.col("asker").alias("doc"), "need", F.expr("substring(text, 1, need)").alias("head"))
    both = base.join(lent.hint("shuffle_merge"), "doc").withColumn("edited", F.expr("concat(substring(text, 1, char_length(text) - need), head)"))
    sha = F.sha2("edited", 256).alias("edited_sha256")
    texts = F.array(F.struct(F.lit(0).alias("variant"), F.lit("").alias("edited_sha256"), F.col("text").alias("t")), F.struct(F.lit(1).alias("variant"), sha, F.col("edited").alias("t")))
    # the digest goes along, so that the texts are read and cut once for both
    found = signatures(both.select("doc", F.explode(texts).alias("v")).select("doc", "v.*"), ["doc", "variant"], "t", samples, "edited_sha256")
    prints, print_path = written(found, "prints")
    own = prints.where("variant = 0").select("doc", F.col("print").alias("fingerprint"))
    edited = prints.where("variant = 1").select("doc", "edited_sha256", F.col("print").alias("edited_fingerprint"))
    following = own.select(F.col("doc").alias("next"), F.col("fingerprint").alias("next_fingerprint"))
    rows = order.join(edited, "doc").join(own, "doc").join(following, "next")
    return rows.select(
        F.col("doc").alias(id_column), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint", samples).alias("near_edited"), likeness("fingerprint", "next_fingerprint", samples).alias("near_next"),
    )
