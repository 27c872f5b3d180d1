"""Host-level quality rules.

Each document is tested by a few rules on its words and lines. Failures are
summed by host (the ``source`` column of documents), each host's failure rate
of each rule is shrunk towards the corpus by an empirical beta prior (fitted
by moments over all hosts), and a host whose shrunk rate of a rule passes the
limit is rejected. The verdict is joined back to the host's documents.

Word windows are compared by 64-bit hashes within one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import NON_SPACE, let, window_hashes, words, written

RULES = ("few_words", "repeats", "symbols", "dup_lines")
HOST_LIMIT = 0.5
SALTS = 32
MAX_BROADCAST_HOSTS = 100_000


def _repeat_words(word_array: Column, size: int = 8) -> Column:
    """Words that lie in a window of ``size`` words found twice or more, the first one included."""
    zero = F.lit(0).cast("bigint")

    def covered(pos: Column) -> Column:
        step = lambda p, j: F.least(F.lit(size), F.coalesce(F.get(pos, j + 1) - p, F.lit(size)))
        return F.aggregate(F.transform(pos, step), zero, lambda a, x: a + x)

    def repeated(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        twin = lambda x, j: ((j > 0) & same(x, j - 1)) | same(x, j + 1)
        return let(F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"])), covered)

    def per_document(g: Column) -> Column:
        by_hash = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), zero).otherwise(let(by_hash, repeated))

    return let(window_hashes(word_array, size), per_document)


def text_stats(text: Column) -> Column:
    """Struct n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (all long) of a text; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    lines = let(F.filter(F.split(whole, "\n"), lambda x: x.rlike(NON_SPACE)),
                lambda a: F.struct(F.size(a).cast("bigint").alias("n"), F.size(F.array_distinct(a)).cast("bigint").alias("d")))
    by_word = let(words(whole), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n"), F.char_length(F.array_join(w, "")).cast("bigint").alias("c"),
        _repeat_words(w).alias("r")))
    symbols = F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("bigint")
    return let(F.struct(by_word.alias("w"), lines.alias("l"), symbols.alias("s")), lambda x: F.struct(
        x["w"]["n"].alias("n_words"), x["w"]["c"].alias("word_chars"), x["s"].alias("n_symbols"),
        x["l"]["n"].alias("n_lines"), (x["l"]["n"] - x["l"]["d"]).alias("n_dup_lines"), x["w"]["r"].alias("n_repeat_words")))


def rule_failures(stats: Column) -> dict[str, Column]:
    return {
        "few_words": stats["n_words"] < 20,
        "repeats": stats["n_repeat_words"] * 100 > stats["n_words"] * 30,
        "symbols": stats["n_symbols"] * 10 > stats["n_words"],
        "dup_lines": stats["n_dup_lines"] * 100 > stats["n_lines"] * 30,
    }


def base_failed(stats: Column) -> Column:
    f = rule_failures(stats)
    return f["few_words"] | f["repeats"]


def host_verdicts(failures: DataFrame, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: n documents, shrunk failure rate of each rule, ``rejected``.

    ``failures`` has the host column and one 0/1 column per rule. A null host is a host of
    its own. The prior of a rule: mean p = all failures / all documents; between-host variance v
    = weighted variance of the host rates less the sampling part p(1-p)H/N; strength
    p(1-p)/v - 1, held within [1, 1e6]. The counts are written and the prior's sums, one row, are taken once, so that
    a filter on the verdicts stays a filter. No failures give no rows.
    """
    counts = written(failures.groupBy(host).agg(
        F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(r).cast("double").alias(f"k_{r}") for r in RULES]))
    m = counts.agg(
        F.sum("n").alias("N"), F.count(F.lit(1)).cast("double").alias("H"),
        *[F.sum(f"k_{r}").alias(f"K_{r}") for r in RULES],
        *[F.sum(F.col(f"k_{r}") * F.col(f"k_{r}") / F.col("n")).alias(f"Q_{r}") for r in RULES]).first()
    rates = []
    for r in RULES:
        p, strength = _prior(m["N"], m["H"], m[f"K_{r}"], m[f"Q_{r}"]) if m["N"] else (0.0, 1.0)
        rates.append(((F.col(f"k_{r}") + F.lit(p * strength)) / (F.col("n") + F.lit(strength))).alias(f"rate_{r}"))
    shrunk = counts.select(host, F.col("n").cast("bigint").alias("n"), *rates)
    return shrunk.withColumn("rejected", F.greatest(*[F.col(f"rate_{r}") for r in RULES]) > limit)


def _prior(docs: float, hosts: float, failures: float, squares: float) -> tuple[float, float]:
    """Mean and strength of a rule's prior from its four sums over hosts."""
    p = failures / docs
    noise = p * (1 - p)
    between = (squares - failures * p) / docs - noise * hosts / docs
    if noise <= between:
        return p, 1.0
    if between * 1e6 <= noise:
        return p, 1e6
    return p, max(1.0, noise / between - 1)


def quality_documents(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Word statistics, base rules and the final verdict of every document.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, and the host's verdict as host_rejected. Null text counts as empty (no words: fails);
    a null host is a host of its own; repeated rows are judged row by row; other columns are left
    out; an empty table gives an empty result. The statistics are computed once and written
    (a few numbers per document); the host verdict is joined on (host, salt) so that a host with
    a third of all rows is dealt over many tasks.
    """
    narrow = docs.select("doc_id", F.col(host).alias("_host"), text_stats(F.col("text")).alias("_s"))
    flags = rule_failures(F.col("_s"))
    stats = written(narrow.select("doc_id", "_host", "_s.*", *[flags[r].cast("int").alias(r) for r in RULES]))
    verdicts = host_verdicts(stats.select("_host", *RULES), "_host", limit).select(
        F.col("_host").alias("_vhost"), "rejected",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_vsalt"))
    salted = stats.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    failed = (F.col("few_words") + F.col("repeats")) > 0
    joined = salted.join(verdicts, F.col("_host").eqNullSafe(F.col("_vhost")) & (F.col("_salt") == F.col("_vsalt")))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & ~F.col("rejected")).alias("kept"),
                         F.col("rejected").alias("host_rejected"))


def keep_good(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The documents that pass the base rules and whose host is not rejected, with all their columns.

    Null text counts as empty and fails; a null host is a host of its own; an empty table gives an empty result. The
    rules are a function of the text, so they are evaluated twice, for the hosts' counts and on the rows that
    stay: writing the texts with their flags would cost the table's size in disk for a sixth of the time.
    Rows with equal or null ids are each judged by their own text. The rejected hosts are counted; up to
    ``MAX_BROADCAST_HOSTS`` they are broadcast, beyond that the anti join is salted.
    """
    flags = rule_failures(F.col("_s"))
    rows = docs.select(F.col(host).alias("_host"), text_stats(F.col("text")).alias("_s")).select(
        "_host", *[flags[r].cast("int").alias(r) for r in RULES])
    bad = written(host_verdicts(rows, "_host", limit).filter("rejected").select(F.col("_host").alias("_bad_host")))
    good = docs.filter(~base_failed(text_stats(F.col("text")))).select(F.struct("*").alias("_doc"), F.col(host).alias("_host"))
    same = F.col("_host").eqNullSafe(F.col("_bad_host"))
    if bad.count() <= MAX_BROADCAST_HOSTS:
        return good.join(F.broadcast(bad), same, "left_anti").select("_doc.*")
    dealt = bad.withColumn("_bad_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("_doc.text"), F.lit(SALTS)).cast("int")
    return good.join(dealt, same & (salt == F.col("_bad_salt")), "left_anti").select("_doc.*")


def quality_sql() -> str:
    """DuckDB SQL of ``quality_documents`` over documents."""
    word = r"[^\x20\x09-\x0D]"
    mean = {r: f"(sum(k_{r}) / sum(n))" for r in RULES}
    prior = ", ".join(
        f"{mean[r]} AS p_{r}, (sum(k_{r} * k_{r} / n) - sum(k_{r}) * {mean[r]}) / sum(n) - {mean[r]} * (1 - {mean[r]}) * count(*) / sum(n) AS v_{r}"
        for r in RULES)
    strength = ", ".join(
        f"p_{r}, CASE WHEN p_{r} * (1 - p_{r}) <= v_{r} THEN 1.0 WHEN v_{r} * 1e6 <= p_{r} * (1 - p_{r}) THEN 1e6 "
        f"ELSE greatest(1.0, p_{r} * (1 - p_{r}) / v_{r} - 1) END AS s_{r}" for r in RULES)
    failed = ", ".join(f"CAST(sum(CAST({r} AS INTEGER)) AS DOUBLE) AS k_{r}" for r in RULES)
    worst = "greatest(" + ", ".join(f"(k_{r} + p_{r} * s_{r}) / (n + s_{r})" for r in RULES) + ")"
    return f"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(words) - 6)) AS i, words FROM w WHERE len(words) >= 9),
keyed AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS k FROM win),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM keyed) WHERE c > 1),
covered AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS r FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id),
s AS (SELECT w.doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, n_words < 20 AS few_words, 100 * n_repeat_words > 30 * n_words AS repeats, n_symbols * 10 > n_words AS symbols,
    n_dup_lines * 100 > n_lines * 30 AS dup_lines FROM s),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, {failed} FROM f GROUP BY source),
prior AS (SELECT {prior} FROM h),
strength AS (SELECT {strength} FROM prior),
verdict AS (SELECT source, {worst} > {HOST_LIMIT} AS rejected FROM h CROSS JOIN strength)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words OR repeats AS base_failed,
    NOT (few_words OR repeats) AND NOT rejected AS kept, rejected AS host_rejected
FROM f JOIN verdict ON f.source IS NOT DISTINCT FROM verdict.source""".strip()
