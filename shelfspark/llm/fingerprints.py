"""Bottom-k sketches of shingle hashes.

A document's sketch is the k smallest 52-bit hashes of its distinct five-word
shingles (lower-cased words; a text of fewer words is one shingle). Sketches
of parts merge by keeping the k smallest of their union, and two sketches
estimate resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import kept_table, let, shuffle_partitions, window_hashes, words

SHINGLE = 5
K = 128
HASH_BITS = 52
BUCKET_BYTES = 8 << 20
MOST_BUCKETS = 1 << 20
SAME_ROWS = 1_000
MOST_SAME = 10_000
COPIES_PER_CHUNK = 1_000
MERGE_SALTS = 64


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """Ascending array of the ``k`` smallest distinct shingle hashes; empty for null, empty or blank text."""
    def of_words(w: Column) -> Column:
        whole = F.array(F.xxhash64(F.array_join(w, " ")))
        hashes = F.when(F.size(w) >= shingle, window_hashes(w, shingle)).when(
            F.size(w) > 0, whole).otherwise(F.array().cast("array<bigint>"))
        cut = F.transform(hashes, lambda h: F.shiftrightunsigned(h, 64 - HASH_BITS))
        return F.slice(F.sort_array(F.array_distinct(cut)), 1, k)

    return let(words(F.lower(F.coalesce(text, F.lit("")))), of_words)


def as_text(s: Column) -> Column:
    """The sketch as 13 hex digits per hash."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.lower(F.hex(h)), HASH_BITS // 4, "0")), "")


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of two sketches: the share of the k smallest of the union that
    both hold. Two empty sketches are alike (1.0); an empty one is like no other (0.0)."""
    def over_union(u: Column) -> Column:
        both = F.size(F.array_intersect(u, F.array_intersect(a, b)))
        return F.when(F.size(u) == 0, 1.0).otherwise(both / F.greatest(F.size(u), F.lit(1)))

    return let(F.slice(F.sort_array(F.array_union(a, b)), 1, k), over_union)


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k hashes, else (k - 1) / (k-th hash as a fraction)."""
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise(
        (k - 1) * float(1 << HASH_BITS) / (F.element_at(s, -1) + 1.0))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has: J (|A| + |B|) / ((1 + J) |A|), at most 1; an empty a is contained."""
    j, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(
        F.least(F.lit(1.0), let(j, lambda x: x * (na + nb) / ((1 + x) * F.greatest(na, F.lit(1.0))))))


def merge_sketches(parts: DataFrame, key: str, column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from the sketches of its parts (key, sketch).

    Hashes are made distinct per key, then the k smallest are kept first within
    (key, salt) and then within the key, so no task holds all hashes of a large key. A
    null key is a key; a key whose parts are all empty or null gets an empty sketch.
    """
    keys = parts.select(F.col(key).alias("_key")).distinct()
    hashes = parts.select(F.col(key).alias("_key"), F.explode(column).alias("_h")).distinct()
    salted = hashes.withColumn("_salt", F.pmod("_h", F.lit(MERGE_SALTS)))
    first = salted.withColumn("_r", F.row_number().over(Window.partitionBy("_key", "_salt").orderBy("_h"))).filter(F.col("_r") <= k)
    least = first.withColumn("_r", F.row_number().over(Window.partitionBy("_key").orderBy("_h"))).filter(F.col("_r") <= k)
    merged = least.groupBy("_key").agg(F.sort_array(F.collect_list("_h")).alias("_s"))
    left, right = keys.alias("l"), merged.alias("r")
    return left.join(right, F.col("l._key").eqNullSafe(F.col("r._key")), "left").select(
        F.col("l._key").alias(key), F.coalesce(F.col("r._s"), F.array().cast("array<bigint>")).alias(column))


def _results(pairs: DataFrame, k: int) -> DataFrame:
    """The result columns of rows with a text, its sketch (_s) and the next text and sketch (_next)."""
    n_chars = F.char_length("text")
    edited = pairs.select(
        "doc_id", n_chars.cast("bigint").alias("n_chars"), "_s", F.col("_next._s").alias("_ns"),
        F.concat(F.substring(F.col("text"), F.lit(1), n_chars - F.floor(n_chars / 4).cast("int")),
                 F.substring(F.col("_next.text"), F.lit(1), F.floor(n_chars / 4).cast("int"))).alias("_e"))
    return edited.select(
        "doc_id", "n_chars", F.sha2(F.col("_e"), 256).alias("edited_sha256"), "_s", "_ns", sketch(F.col("_e"), k).alias("_es")).select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("_s")).alias("fingerprint"), as_text(F.col("_es")).alias("edited_fingerprint"),
        resemblance(F.col("_s"), F.col("_es"), k).alias("near_edited"), resemblance(F.col("_s"), F.col("_ns"), k).alias("near_next"),
        distinct_shingles(F.col("_s"), k).alias("distinct_shingles"))


def _copies_of_hot_rows(heads: DataFrame, k: int) -> DataFrame:
    """All copies but one of the rows that are repeated often: each is followed by its own text. The result is made once per
    COPIES_PER_CHUNK copies, and the chunks are dealt before they are repeated."""
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 2) / COPIES_PER_CHUNK))
    dealt = heads.filter("_n > 1").select("doc_id", "text", "_n", F.explode(chunks).alias("_chunk")).withColumn(
        "_times", F.least(F.lit(COPIES_PER_CHUNK), F.col("_n") - 1 - F.col("_chunk") * COPIES_PER_CHUNK).cast("int"))
    spread = dealt.repartition(shuffle_partitions(heads.sparkSession), F.xxhash64("doc_id", "_chunk", "text"))
    own = spread.withColumn("_s", sketch(F.col("text"), k)).withColumn("_next", F.struct("text", "_s"))
    times = own.select(F.struct("doc_id", "text", "_s", "_next").alias("_r"), F.explode(F.array_repeat(F.lit(1), F.col("_times"))).alias("_one"))
    return _results(times.select("_r.*"), k)


def edited_fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited text (its last quarter replaced by the start of the next document).

    The next document is the one with the next higher doc_id (after the last: the first). Null text counts as empty. A
    null doc_id sorts first; rows with equal ids follow one another in the order of their text hash. Other columns
    are left out; an empty table gives an empty result; a single document is its own successor.

    Rows are dealt to ranges of (doc_id, text hash), so that an id that many rows share is cut as well. The ranges start
    at keys that exist, and a range's first row is copied to the range before it: one shuffle of the texts and a window
    per range give every row its successor. A row (id and 64-bit text hash) that is repeated over SAME_ROWS times, and over
    1 / MOST_SAME of all rows, goes through as one row with a count. There is a range per BUCKET_BYTES of text, at most
    MOST_BUCKETS (16 MB of starts, kept in one row that the scan's tasks read); beyond that ranges grow, and their sorts spill.
    """
    base = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2 ** 63)).cast("bigint")).alias("_at")).withColumn(
        "_tie", F.xxhash64("text"))
    keys = kept_table(base.groupBy("_at", "_tie").agg(F.count(F.lit(1)).alias("_n"), F.max(F.octet_length("text")).cast("bigint").alias("_b")), "keys")
    total = keys.agg(F.sum("_n").alias("n"), F.sum("_b").alias("b")).first()
    n = min(MOST_BUCKETS, max(shuffle_partitions(docs.sparkSession) * 2, -(-(total["b"] or 0) // BUCKET_BYTES)))
    ranges = keys.repartitionByRange(n, "_at", "_tie").select(F.struct("_at", "_tie").alias("_key"), F.spark_partition_id().alias("_p"))
    starts = kept_table(ranges.groupBy("_p").agg(F.min("_key").alias("_start")), "starts")
    hot = keys.filter(F.col("_n") > max(SAME_ROWS, (total["n"] or 0) // MOST_SAME)).select("_at", "_tie")
    heads = kept_table(base.join(F.broadcast(hot), ["_at", "_tie"]).groupBy("doc_id", "_at", "_tie").agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("_n")), "heads")  # hot has at most MOST_SAME rows
    rows = base.join(F.broadcast(hot), ["_at", "_tie"], "left_anti").select("doc_id", "text", "_at", "_tie").unionByName(
        heads.select("doc_id", "text", "_at", "_tie"))
    n_starts = starts.count()
    found = starts.agg(F.sort_array(F.collect_list("_start")).alias("_all")).scalar()
    key = F.struct("_at", "_tie")
    bucket = _at_most(F.col("_starts"), key, n_starts)
    place = let(bucket, lambda i: F.struct(i.alias("bucket"), (F.get(F.col("_starts"), i) == key).alias("first")))
    own = F.struct(F.col("_place.bucket").alias("bucket"), F.lit(0).alias("copy"))
    before = F.struct(F.pmod(F.col("_place.bucket") + n_starts - 1, F.lit(max(1, n_starts))).alias("bucket"), F.lit(1).alias("copy"))
    dealt = rows.withColumn("_starts", found).withColumn("_place", place).select("doc_id", "text", "_at", "_tie", F.explode(
        F.when(F.col("_place.first"), F.array(own, before)).otherwise(F.array(own))).alias("_c")).select(
        "doc_id", "text", "_at", "_tie", F.col("_c.bucket").alias("_b"), F.col("_c.copy").alias("_copy"))
    sketched = dealt.repartition(n, "_b").withColumn("_s", sketch(F.col("text"), k))
    w = Window.partitionBy("_b").orderBy("_copy", "_at", "_tie")
    followed = sketched.withColumn("_next", F.lead(F.struct("text", "_s")).over(w)).filter("_copy = 0")
    return _results(followed, k).unionByName(_copies_of_hot_rows(heads, k))


def _at_most(values: Column, key: Column, size: int) -> Column:
    """Index of the last of ``size`` ascending values that is no greater than ``key`` (the first is not): a binary search."""
    steps = [1 << s for s in reversed(range(max(1, size).bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda acc, step: F.when(F.get(values, acc + step) <= key, acc + step).otherwise(acc))
