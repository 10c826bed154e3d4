"""A Merkle manifest of a dataset, with a membership proof for every row.

Every row is a leaf.  The leaves of a language, by ascending doc_id, are a
binary tree; its top is the language's subroot, and the subroots, by
language, are the leaves of a last tree whose top is the root.

1. *Places.*  Leaves are dealt to sampled ranges of (lang, doc_id, leaf)
   and numbered inside ranges, so no task holds a language.  Only leaves
   move, never texts.
2. *Trees.*  ``BLOCK`` neighbours make ``BLOCK_LEVELS`` levels in one
   task; their tops are the next step's nodes.  Each node of a block gets
   its sibling there: the first segment of its way up.
3. *Pointer jumping.*  A node holds the siblings up to its ancestor
   ``d`` levels above.  A self-join appends the ancestor's own segment, which
   doubles ``d``, until the leaves reach the top: as many joins as the
   height's logarithm.  Only levels divisible by ``2 d`` jump, since no other
   is asked again.  An ancestor of more than ``BLOCK`` nodes is repeated for
   each block of them, so a join group has at most ``BLOCK`` rows.
4. Leaves take their language's way to the root from the last tree.

A segment is the siblings' 32-byte digests, one after another.  Which side
each is on, and whether there is one (the last of an odd number of nodes has
none), follows from the leaf's place and the number of leaves.

Defined cases: a null field is `-`, an empty one `0:`; a null language is
a language of its own, before all others, and a null doc_id comes first;
rows that repeat a doc_id go by their leaf, and equal rows are leaves of their
own; a lone leaf is its subroot, a lone subroot the root, and without any
sibling the proof is empty; an empty table has no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddy.llm.graph import written

BLOCK_LEVELS = 8
BLOCK = 1 << BLOCK_LEVELS
RANGE_ROWS = 1 << 20
PROOF_ROWS = 1 << 15          # of a task that folds proofs
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

def _none() -> Column:
    return F.lit(b"")


def field(c: Column) -> Column:
    """A value with its byte length in front; `-` if null."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """The digest of a row's ``FIELDS`` (binary), some of them changed."""
    return F.unhex(F.sha2(F.concat(*[field(changed.get(c, F.col(c))) for c in FIELDS]), 256))


def hexed(c: Column) -> Column:
    return F.lower(F.hex(c))


def joined(*digests: Column) -> Column:
    """The digest (hex) of hex digests, one after another."""
    return F.sha2(F.concat(*digests), 256)


def height(n: Column) -> Column:
    """Levels above ``n`` leaves."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _width(n: Column, level) -> Column:
    """Nodes of a level of a tree of ``n`` leaves (level 0)."""
    return F.call_function("shiftright", n - 1, level) + 1


def _tasks(df: DataFrame, rows: int) -> int:
    """Partitions of at most ``rows`` rows of a written table, the session's number at least."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // rows + 1)


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``rank``, 0-based by ``order``, over sampled ranges of it."""
    dealt = written(df.repartitionByRange(_tasks(df, RANGE_ROWS), *order).withColumn("_range", F.spark_partition_id()), name)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)      # one row a range
    starts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("n")) \
        .select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_inside", inside).join(starts, "_range") \
        .withColumn("rank", F.col("_start") + F.col("_inside") - 1).drop("_range", "_start", "_inside")


def _parents(level: str, deeper: Column) -> Column:
    """The next level of a block, an array of hex digests; null above the top."""
    at = F.sequence(F.lit(0), F.expr(f"(size({level}) + 1) div 2 - 1"))
    pair = F.transform(at, lambda i: F.sha2(F.concat(
        F.get(F.col(level), 2 * i), F.coalesce(F.get(F.col(level), 2 * i + 1), F.lit(""))), 256))
    return F.when(deeper, pair)


def _blocks(nodes: DataFrame, base: int, name: str) -> DataFrame:
    """Blocks of (tree, n, idx, digest) nodes of level ``base``: arrays l0, l1, .. of their levels."""
    grouped = nodes.groupBy("tree", "n", F.shiftright("idx", BLOCK_LEVELS).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("s"))
    out = grouped.select("tree", "n", "block", F.col("s.digest").alias("l0"))
    for k in range(BLOCK_LEVELS):
        out = out.withColumn(f"l{k + 1}", _parents(f"l{k}", F.lit(base + k) < height(F.col("n"))))
    return written(out, name)


def _segments(blocks: DataFrame, base: int) -> DataFrame:
    """(tree, n, level, idx, seg): each node below the top, with its sibling."""
    def nodes(k: int) -> Column:
        level, first = F.col(f"l{k}"), F.shiftleft(F.col("block"), BLOCK_LEVELS - k)
        return F.transform(level, lambda _, j: F.struct(
            F.lit(base + k).alias("level"), (first + j).alias("idx"),
            F.coalesce(F.unhex(F.get(level, j.bitwiseXOR(F.lit(1)))), _none()).alias("seg")))

    none = F.array().cast("array<struct<level:int,idx:bigint,seg:binary>>")
    levels = [F.when(F.col(f"l{k + 1}").isNotNull(), nodes(k)).otherwise(none) for k in range(BLOCK_LEVELS)]
    return blocks.select("tree", "n", F.explode(F.concat(*levels)).alias("x")).select("tree", "n", "x.*")


def _jump(nodes: DataFrame, d: int) -> DataFrame:
    """Segments of ``d`` levels become segments of ``2 d``, on levels divisible by that."""
    below = nodes.where(F.col("level") % (2 * d) == 0)
    above = nodes.where(F.col("level") % (2 * d) == d).select(
        F.col("tree").alias("t"), (F.col("level") - d).alias("l"), F.col("idx").alias("up"), F.col("seg").alias("more"), F.col("n").alias("m"))
    if d <= BLOCK_LEVELS:
        match = F.shiftright(F.col("idx"), d) == F.col("up")
    else:       # an ancestor of many: once for each block of them
        last = F.least(F.shiftleft(F.col("up") + 1, d) - 1, _width(F.col("m"), F.col("l")) - 1)
        above = above.withColumn("part", F.explode(F.sequence(F.shiftleft(F.col("up"), d - BLOCK_LEVELS), F.shiftright(last, BLOCK_LEVELS))))
        match = F.shiftright(F.col("idx"), BLOCK_LEVELS) == F.col("part")
    out = below.join(above, (F.col("tree") == F.col("t")) & (F.col("level") == F.col("l")) & match, "left")
    return written(out.select("tree", "n", "level", "idx", F.concat("seg", F.coalesce("more", _none())).alias("seg")), f"jump-{2 * d}")


def grow(leaves: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Tops (tree, n, top) and ways up (tree, idx, seg) of trees over (tree, n, idx, digest) leaves.

    Digests and tops are hex; leaves of trees of one have no way up.
    """
    highest = leaves.agg(F.max(height(F.col("n"))).alias("h")).first()["h"] or 0
    nodes, tops, ways = leaves.select("tree", "n", "idx", "digest"), [], []
    for base in range(0, highest or 1, BLOCK_LEVELS):
        blocks = _blocks(nodes, base, f"{name}-{base}")
        h = height(F.col("n"))
        at = F.coalesce(*[F.col(f"l{k}") for k in range(BLOCK_LEVELS, -1, -1)])          # the highest level here
        ended = (h > base) & (h <= base + BLOCK_LEVELS) | ((h == 0) & F.lit(base == 0))
        tops.append(blocks.where(ended).select("tree", "n", F.get(at, F.lit(0)).alias("top")))
        ways.append(_segments(blocks, base))
        nodes = blocks.where(h > base + BLOCK_LEVELS).select("tree", "n", F.col("block").alias("idx"), F.get(at, F.lit(0)).alias("digest"))
    top, way, d = tops[0], ways[0], 1
    for more_tops, more in zip(tops[1:], ways[1:]):
        top, way = top.unionByName(more_tops), way.unionByName(more)
    while d < highest:
        way = _jump(way, d)
        d *= 2
    return top, way.where("level = 0").select("tree", "idx", "seg")


def prove(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Leaf, place and proof of every row of ``docs``.

    (doc_id, lang, leaf, place, n_leaves, subroot, lang_place, n_langs, root,
    proof): digests in hex, ``proof`` the siblings' digests from leaf to root
    (binary), ``place`` of ``n_leaves`` in the language's tree and ``lang_place``
    of ``n_langs`` in the last one.  ``carry`` names columns to take along.
    """
    carried = {c: f"_{i}" for i, c in enumerate(carry)}
    leaves = written(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                                 leaf_digest().alias("leaf"), *[F.col(c).alias(k) for c, k in carried.items()]), "leaves")
    placed = written(ranked(leaves, ["lang", "doc_id", "leaf"], "ranges"), "ranked")
    trees = placed.groupBy("lang").agg(F.min("rank").alias("start"), F.count(F.lit(1)).alias("n"))
    trees = written(ranked(trees, ["lang"], "langs").withColumnRenamed("rank", "tree"), "trees")
    n_langs = trees.count()
    t = trees.select(F.col("lang").alias("tree_lang"), "start", "n", "tree")
    placed = placed.join(t, F.col("lang").eqNullSafe(F.col("tree_lang"))).select(
        "doc_id", "lang", "leaf", *carried.values(), "tree", "n", (F.col("rank") - F.col("start")).alias("idx"))
    placed = written(placed, "placed")

    tops, ways = grow(placed.select("tree", "n", "idx", hexed(F.col("leaf")).alias("digest")), "tree")
    tops = written(tops, "subroots")
    last, last_ways = grow(tops.select(F.lit(0).cast("bigint").alias("tree"), F.lit(n_langs).cast("bigint").alias("n"),
                                       F.col("tree").alias("idx"), F.col("top").alias("digest")), "last")
    root = last.select("top").first()
    over = tops.select("tree", F.col("top").alias("subroot"), F.lit(root and root["top"]).cast("string").alias("root")) \
        .join(last_ways.select(F.col("idx").alias("tree"), F.col("seg").alias("over")), "tree", "left")
    over = written(over, "over")
    dealt = placed.repartition(_tasks(placed, PROOF_ROWS), "tree", "idx")
    out = dealt.join(ways, ["tree", "idx"], "left").join(over, "tree")
    return out.select("doc_id", "lang", hexed(F.col("leaf")).alias("leaf"), F.col("idx").alias("place"), F.col("n").alias("n_leaves"),
                      "subroot", F.col("tree").alias("lang_place"), F.lit(n_langs).cast("bigint").alias("n_langs"), "root",
                      F.concat(F.coalesce("seg", _none()), F.coalesce("over", _none())).alias("proof"),
                      *[F.col(k).alias(c) for c, k in carried.items()])


def _climb(start: Column, place: Column, n: Column, proof: Column) -> Column:
    """struct(digest, at): a leaf folded up one tree with the siblings from byte ``at`` of ``proof`` on."""
    def step(acc: Column, level: Column) -> Column:
        me = F.call_function("shiftright", place, level)
        has = me.bitwiseXOR(F.lit(1)) < _width(n, level)
        sibling = F.when(has, hexed(F.substring(proof, acc["at"] + 1, F.lit(32)))).otherwise("")
        digest = F.when(me % 2 == 1, joined(sibling, acc["digest"])).otherwise(joined(acc["digest"], sibling))
        return F.struct(digest.alias("digest"), (acc["at"] + F.when(has, 32).otherwise(0)).alias("at"))
    levels = F.when(n > 1, F.sequence(F.lit(0), height(n) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(levels, start, step)


def folded_root(leaf: Column) -> Column:
    """The root that ``leaf`` (hex) gives with a row's proof (the columns of ``prove``)."""
    first = F.struct(leaf.alias("digest"), F.lit(0).alias("at"))
    subroot = _climb(first, F.col("place"), F.col("n_leaves"), F.col("proof"))
    return _climb(subroot, F.col("lang_place"), F.col("n_langs"), F.col("proof"))["digest"]


def verify(docs: DataFrame) -> DataFrame:
    """Every row's proof, and what it says of a row that may have been tampered with.

    Where 7 divides crc32 of the decimal doc_id, n_chars is one more when
    the root is folded anew.
    """
    more = (F.col("n_chars").cast("decimal(20,0)") + 1)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf_digest(n_chars=more))
    proofs = prove(docs.select(*FIELDS, tampered.alias("tampered")), carry=("tampered",))
    folded = folded_root(F.coalesce(hexed(F.col("tampered")), F.col("leaf")))
    return proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(hexed(F.col("proof")), 256).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::varchar) || ':' || ({value})::varchar, '-')"


def _leaf_sql(n_chars: str = "n_chars") -> str:
    return "sha256(" + " || ".join(_field_sql(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"


def _levels_sql(name: str, leaves: str) -> str:
    """All nodes (tree, level, idx, digest, n) of trees over leaves (tree, idx, digest, n)."""
    return f"""{name} as (select tree, 0 as level, idx, digest, n from {leaves} union all
      select tree, level + 1, idx // 2, sha256(string_agg(digest, '' order by idx)), (n + 1) // 2 from {name} where n > 1 group by all)"""


def verify_sql() -> str:
    """DuckDB SQL for ``verify``."""
    bit = "case when xor(c, x) & 1 = 1 then xor(xor(c, x) >> 1, 3988292384) else xor(c, x) >> 1 end"
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, flatten([[ord(ch)::bigint, 0, 0, 0, 0, 0, 0, 0] for ch in string_split(doc_id::varchar, '')])), lambda c, x: {bit}), 4294967295)"
    step = ("sha256(case when f.{0} % 2 = 1 then coalesce(s.digest, '') || f.digest else f.digest || coalesce(s.digest, '') end)")
    return f"""with recursive d as (select doc_id, lang, {_leaf_sql()} as leaf, case when doc_id is not null and {crc} % 7 = 0 then {_leaf_sql('n_chars::hugeint + 1')} end as other from documents),
  l as (select row_number() over (order by lang nulls first, doc_id nulls first, leaf) as id, doc_id, lang, leaf, other,
          row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by lang) as n,
          dense_rank() over (order by lang nulls first) as tree from d),
  l0 as (select tree, idx, leaf as digest, n from l),
  {_levels_sql('low', 'l0')},
  tops as (select tree, digest from low where n = 1),
  t0 as (select 0 as tree, tree - 1 as idx, digest, (select count(*) from tops) as n from tops),
  {_levels_sql('high', 't0')},
  root as (select digest as root from high where n = 1),
  up as (select id, tree, idx, 0 as level, coalesce(other, leaf) as digest, '' as proof, n from l union all
    select f.id, f.tree, f.idx // 2, f.level + 1, {step.format('idx')}, f.proof || coalesce(s.digest, ''), (f.n + 1) // 2
    from up f left join low s on s.tree = f.tree and s.level = f.level and s.idx = xor(f.idx, 1) where f.n > 1),
  over as (select id, tree - 1 as idx, 0 as level, digest, proof, (select count(*) from tops) as n from up where n = 1 union all
    select f.id, f.idx // 2, f.level + 1, {step.format('idx')}, f.proof || coalesce(s.digest, ''), (f.n + 1) // 2
    from over f left join high s on s.level = f.level and s.idx = xor(f.idx, 1) where f.n > 1)
  select l.doc_id, l.leaf, tops.digest as subroot, root, sha256(over.proof) as proof_sha256, over.digest as folded_root, over.digest = root as verified
  from l join tops using (tree) join over on over.id = l.id and over.n = 1 cross join root"""
