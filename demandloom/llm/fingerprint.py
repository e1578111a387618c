"""Document fingerprints: bottom-k sketches of word-shingle hashes, as column expressions.

A sketch is the ascending array of the k smallest distinct 32-bit hashes of a
text's shingles.  Sketches of parts merge into the sketch of the whole, and
two of them estimate resemblance, containment and the distinct shingle count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.llm.common import NO_ID, neighbours, only

WORDS, K = 5, 128

_SPACE = r"[\x20\x09-\x0D]+"


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """Bottom-k sketch of a text's shingles of ``words`` lower-cased words.

    With fewer words the whole sequence is one shingle; null or blank text has
    the empty sketch.
    """
    hashes = F.transform(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPACE), ""), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(h) - words, F.lit(0)))
        full = F.transform(starts, lambda i: F.hash(*[F.get(h, i + j) for j in range(words)]))
        return F.when(F.size(h) == 0, F.array().cast("array<int>")).otherwise(full)

    # bound once: a one-element array keeps the word hashes from being computed at each use
    return bottom(F.flatten(F.transform(F.array(hashes), shingles)), k)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together (shingles across the cut aside)."""
    return bottom(F.concat(a, b), k)


def merge_groups(parts: DataFrame, keys: list[str], column: str, k: int = K, salts: int = 64) -> DataFrame:
    """(keys, column): one sketch for each group of part sketches.

    Hashes are salted by value and cut to k for each salt first, so a group of
    any size ends in one row of at most salts x k values.
    """
    each = parts.select(*keys, F.explode(column).alias("_h")).distinct().withColumn("_salt", F.pmod("_h", F.lit(salts)))
    w = W.partitionBy(*keys, "_salt").orderBy("_h")
    low = each.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    return low.groupBy(*keys).agg(bottom(F.collect_list("_h"), k).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1; exact where both sketches are whole. Two empty ones are alike."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) / the k-th smallest hash as a share of 2**32."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**31)) / F.lit(2.0**32)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has; an empty a is contained in anything."""
    j, na, nb = resemblance(a, b, k), distinct_count(a, k), distinct_count(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j * (na + nb) / (1 + j) / na))


def as_text(a: Column) -> Column:
    """Eight lower-case hexadecimal digits for each hash, ascending as signed numbers."""
    return F.array_join(F.transform(a, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def edited_fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of whole texts, of texts whose end is overwritten by the next document, and their likeness.

    The last floor(n/2) of a text's n code points are replaced by as many of
    the first of the next document (all, if it has fewer), in ascending doc_id;
    the first follows the last.  Null text is empty; a null doc_id comes before
    all others.  Rows that share a doc_id each get a row, and what follows the
    id before is the one whose text is smallest.  Columns other than doc_id
    and text are not read.

    Texts are dealt once by id.  Neighbours are found on ids and lengths alone;
    what goes to the document before is its missing half and a sketch.
    """
    base = only(docs, "doc_id", "text").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = neighbours(base.select("_id", F.char_length("text").alias("n")), "_id", "n")
    # both uses below read every column of this exchange, so that it is made once
    parts = order.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = base.withColumn("s", sketch(F.col("text"), k)).repartition(int(parts), "_id")
    heads = (
        dealt.join(order, "_id")
        .select(F.col("prev_key").alias("_id"), F.struct(F.expr("left(text, prev_carry div 2)").alias("head"), F.col("s").alias("next_s")).alias("h"))
        .groupBy("_id").agg(F.min("h").alias("h"))
    )
    both = dealt.join(heads, "_id").withColumn("n_chars", F.char_length("text").cast("long"))
    edited = both.withColumn(
        "edited", F.expr("concat(left(text, n_chars - n_chars div 2), left(h.head, n_chars div 2))")
    )
    done = edited.select(F.nullif("_id", F.lit(NO_ID)).alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "s", sketch(F.col("edited"), k).alias("e"), "h.next_s")
    return done.select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("s")).alias("fingerprint"), as_text(F.col("e")).alias("edited_fingerprint"),
        resemblance(F.col("s"), F.col("e"), k).alias("near_edited"),
        resemblance(F.col("s"), F.col("next_s"), k).alias("near_next"),
        distinct_count(F.col("s"), k).alias("shingles_estimate"),
    )
