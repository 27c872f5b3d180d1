"""Merkle manifest of a table: one digest for every row, one for every source and one for all, with sibling proofs.

A row's leaf is the SHA-256 of its named columns. The leaves of a source, in ascending order, are nodes of a tree; every
run of 16 consecutive nodes becomes the digest of their concatenated hex texts, until one is left, the subroot. The
subroots, in order of their sources, are the nodes of one more tree, whose last node is the root.

Nodes are dealt to aligned blocks of 256. A block keeps a level as one string of 64 hex characters a node, so
a parent is the digest of a fixed-width substring, and a node's siblings are the two substrings that flank it. A block
climbs two levels on its own; the tops of a source's blocks are the nodes of the next recursion, which has
a 256th of the rows. On the way down each block gets the sibling segments above it, once for its 256 nodes.

A node's place comes from a range sort over (source, order, leaf): rows and their places in a partition are written,
and a source's rows in earlier partitions are added. A source of any size is so spread over all tasks. Rows that are
equal in all named columns are counted before the sort and dealt by copy number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import kept_table, let, shuffle_partitions

FANOUT = 16
BLOCK = FANOUT * FANOUT
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PAIRS = "array<struct<left:binary,right:binary>>"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 (lowercase hex) of values: each is ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    one = lambda v: F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))
    return F.sha2(F.concat(*[one(v.cast("string")) for v in values]), 256)


def _nodes(part: Column, first: Column, count: Column) -> Column:
    """``count`` digests of a level's string from number ``first`` (0) on; those past its end are left out."""
    return F.substring(part, first * HEX + 1, count * HEX)


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0) in their tree, by ``order``, and ``n``, the tree's rows."""
    parts = shuffle_partitions(rows.sparkSession)
    by_range = rows.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)
    dealt = kept_table(by_range.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "ordered")
    runs = dealt.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    own = Window.partitionBy("tree")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("tree", "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(own).alias("n"))
    return dealt.join(starts, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _blocks(nodes: DataFrame) -> DataFrame:
    """tree, n, block, its nodes' items, low and high (its two levels as strings) and top, of nodes (tree, n, pos, digest, item)."""
    got = nodes.groupBy("tree", "n", F.expr(f"pos div {BLOCK}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "item"))).alias("nodes"))
    low = F.array_join(F.transform("nodes", lambda x: x["digest"]), "").cast("binary")
    strings = got.select("tree", "n", "block", F.transform("nodes", lambda x: x["item"]).alias("items"), low.alias("low"))
    runs = F.sequence(F.lit(0), F.expr(f"(size(items) - 1) div {FANOUT}"))
    high = F.array_join(F.transform(runs, lambda k: F.sha2(_nodes(F.col("low"), k * FANOUT, F.lit(FANOUT)), 256)), "").cast("binary")
    both = strings.withColumn("high", high)
    top = F.when(F.col("n") == 1, F.col("low").cast("string")).when(F.col("n") <= FANOUT, F.col("high").cast("string")).otherwise(F.sha2("high", 256))
    return both.withColumn("top", top)


def _paths(blocks: DataFrame, value) -> DataFrame:
    """tree, subroot, root and ``value(item, digest, path)`` of every node of blocks (with above, subroot and root).

    A path has a pair of sibling segments (left, right) for each level that a node climbs.
    """
    height = F.when(F.col("n") == 1, 0).when(F.col("n") <= FANOUT, 1).otherwise(2)

    def segments(level: str, i: Column) -> Column:
        inner = i % FANOUT
        return F.struct(_nodes(F.col(level), i - inner, inner).alias("left"), _nodes(F.col(level), i + 1, F.lit(FANOUT - 1) - inner).alias("right"))

    def one(item: Column, i: Column) -> Column:
        own = F.array(segments("low", i), segments("high", (i / FANOUT).cast("int")))
        digest = _nodes(F.col("low"), i, F.lit(1))
        return let(F.concat(F.slice(own, F.lit(1), height), F.col("above")), lambda path: value(item, digest, path))

    return blocks.select("tree", "block", "subroot", "root", F.explode(F.transform("items", one)).alias("node"))


def proof(path: Column) -> Column:
    """SHA-256 of all sibling digests of a path, level by level."""
    return F.sha2(F.aggregate(path, F.lit(b""), lambda a, p: F.concat(a, p["left"], p["right"])), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, digest.cast("binary"), lambda a, p: F.sha2(F.concat(p["left"], a, p["right"]), 256).cast("binary")).cast("string")


def _forest(nodes: DataFrame, crown=None) -> DataFrame:
    """The lowest blocks of nodes (tree, n, pos, digest, item) with ``above`` (the path from a block's top on), subroot and root.

    ``crown`` gets the subroots (tree, subroot) and returns tree, path and root above them; without it a tree ends in its subroot.
    """
    levels = []
    while True:
        levels.append(kept_table(_blocks(nodes), "blocks"))
        open_blocks = levels[-1].filter(f"n > {BLOCK}")
        if open_blocks.isEmpty():
            break
        nodes = open_blocks.select("tree", F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("block").alias("pos"),
                                   F.col("top").alias("digest"), F.col("block").alias("item"))
    done = [b.filter(f"n <= {BLOCK}") for b in levels]
    subroots = done[0].select("tree", F.col("top").alias("subroot"))
    for d in done[1:]:
        subroots = subroots.unionByName(d.select("tree", F.col("top").alias("subroot")))
    tops = None if crown is None else crown(subroots).withColumnRenamed("path", "above")
    below = None
    for blocks, ended in reversed(list(zip(levels, done))):
        if tops is None:
            full = ended.select("*", F.array().cast(PAIRS).alias("above"), F.col("top").alias("subroot"), F.col("top").alias("root"))
        else:
            full = ended.join(tops, "tree").withColumn("subroot", F.col("top"))
        if below is not None:
            above = _paths(below, lambda item, digest, path: F.struct(item.alias("block"), path.alias("above")))
            rest = blocks.filter(f"n > {BLOCK}").join(above.select("tree", "subroot", "root", "node.*"), ["tree", "block"])
            full = full.unionByName(rest)
        below = full
    return below


def _over_sources(subroots: DataFrame) -> DataFrame:
    """tree, path and root: the tree of all subroots in order of their trees' names."""
    nodes = _placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("item"), F.col("subroot").alias("digest")), ["item"])
    ends = _paths(_forest(nodes), lambda item, digest, path: F.struct(item.alias("tree"), path.alias("path")))
    return ends.select("node.tree", "node.path", "root")


def manifest(df: DataFrame, fields: Sequence[str], group: str, order: str, other: Column | None = None) -> DataFrame:
    """One row per row of ``df``: group, order, leaf, subroot, root, proof_sha256, other_leaf, folded_root, verified.

    ``other`` is a leaf to hold against the manifest (null: the row's own): folded_root is what it leads to with the
    siblings of the row's leaf, and verified tells whether that is the root. A null group comes before all others, as
    does a null order; rows of one order value are ordered by their leaves, and rows equal in all fields are leaves of
    their own, one after another. Other columns are left out; an empty table gives an empty result.
    """
    tree = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = df.select(tree.alias("tree"), F.col(order).alias("key"), leaf_digest([F.col(f) for f in fields]).alias("digest"),
                       (F.lit(None).cast("string") if other is None else other).alias("other"))
    copies = leaves.groupBy("tree", "key", "digest", "other").agg(F.count(F.lit(1)).alias("n")).select(
        "tree", "key", "digest", "other", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("copy"))
    nodes = _placed(copies, ["key", "digest", "copy"]).select("tree", "n", "pos", "digest", F.struct("key", "other").alias("item"))

    def value(item: Column, digest: Column, path: Column) -> Column:
        return F.struct(item["key"].alias("key"), item["other"].alias("other"), digest.cast("string").alias("leaf"), proof(path).alias("proof"),
                        fold(F.coalesce(item["other"].cast("binary"), digest), path).alias("folded"))

    rows = _paths(_forest(nodes, _over_sources), value)
    name = F.when(F.col("tree") == "", F.lit(None).cast("string")).otherwise(F.expr("substring(tree, 2)"))
    return rows.select(name.alias(group), F.col("node.key").alias(order), F.col("node.leaf").alias("leaf"), "subroot", "root",
                       F.col("node.proof").alias("proof_sha256"), F.col("node.other").alias("other_leaf"),
                       F.col("node.folded").alias("folded_root"), (F.col("node.folded") == F.col("root")).alias("verified"))


def manifest_report(docs: DataFrame) -> DataFrame:
    """The manifest of documents by source, held against documents of which some were changed.

    Where 5 divides the CRC-32 of the decimal doc_id, the capitals A-Z of the text are lower-cased before the check; a null
    doc_id is no such row. Nulls, repeated rows, other columns and the empty table are as in ``manifest``.
    """
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", CAPITALS, SMALL)
    other = F.when(changed, leaf_digest([lowered if f == "text" else F.col(f) for f in FIELDS]))
    got = manifest(docs.select(*FIELDS), FIELDS, "source", "doc_id", other)
    return got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def manifest_sql(levels: int = 6, source_levels: int = 4) -> str:
    """DuckDB SQL of ``manifest_report`` for up to 16^levels documents a source and 16^source_levels sources."""
    def value(x: str) -> str:
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE octet_length(encode(CAST({x} AS VARCHAR))) || ':' || {x} END"

    fields = " || ".join(value(f) for f in FIELDS)
    lowered = " || ".join(value(f"translate(text, '{CAPITALS}', '{SMALL}')" if f == "text" else f) for f in FIELDS)
    out = [f"""
WITH RECURSIVE steps(i, k, c) AS (SELECT i, 0, i FROM range(0, 256) t(i)
    UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END FROM steps WHERE k < 8),
tbl AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
crc AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'),
    lambda x: CAST('0x' || x AS BIGINT))), lambda a, x: xor(a // 256, t[CAST(xor(a, x) % 256 AS BIGINT) + 1])), 4294967295) AS c FROM documents, tbl),
hashed AS (SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({fields}) AS leaf, CASE WHEN c % 5 = 0 THEN sha256({lowered}) END AS other FROM crc),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
t0 AS (SELECT tree, pos, n, leaf AS h FROM placed)"""]

    def climb(name: str, count: int) -> None:
        for k in range(count):
            out.append(f"{name}g{k} AS (SELECT tree, pos // 16 AS run, max(n) AS n, list(h ORDER BY pos) AS hs FROM {name}{k} GROUP BY 1, 2)")
            out.append(f"{name}{k + 1} AS (SELECT tree, run AS pos, (n + 15) // 16 AS n, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}g{k})")

    def follow(name: str, start: str, count: int) -> None:
        for k in range(count):
            row = f"{start if k == 0 else f'{name}d{k}'}"
            left, right = "coalesce(array_to_string(hs[1:d.pos % 16], ''), '')", "coalesce(array_to_string(hs[d.pos % 16 + 2:], ''), '')"
            out.append(f"""{name}d{k + 1} AS (SELECT d.* EXCLUDE (pos, proof, node), d.pos // 16 AS pos, proof || {left} || {right} AS proof,
    CASE WHEN g.n = 1 THEN node ELSE sha256({left} || node || {right}) END AS node FROM {row} d JOIN {name}g{k} g ON d.{'tree' if name == 't' else 'top'} = g.tree AND d.pos // 16 = g.run)""")

    climb("t", levels)
    out.append(f"u0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, h FROM t{levels})")
    out.append(f"named AS (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS spot, h AS subroot FROM t{levels})")
    climb("u", source_levels)
    out.append("start AS (SELECT doc_id, tree, leaf, pos, '' AS proof, coalesce(other, leaf) AS node FROM placed)")
    follow("t", "start", levels)
    out.append(f"mid AS (SELECT d.* EXCLUDE (pos), subroot, spot AS pos, '' AS top FROM td{levels} d JOIN named USING (tree))")
    follow("u", "mid", source_levels)
    return ",\n".join(out) + f"""
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = r.h AS verified FROM ud{source_levels}, u{source_levels} r"""
