"""How far the sources of a language differ in their words.

Terms are runs of ASCII letters (lower-cased) and of characters beyond
ASCII.  Every language has its own vocabulary, every (lang, source) group
and every language a smoothed share of each term in it, and every pair of
groups of a language a distance, summed over the whole vocabulary.

1. *Vectors.*  A document is a sparse vector, the count of each of its
   terms; a language's vocabulary are the terms in ``MIN_DF`` or more of its
   documents, ``VOCAB_SIZE`` at most: the largest integer, so none is left
   out, and a larger vocabulary raises an error.  It is what a
   CountVectorizer fitted for each language holds; but that collects its
   vocabulary to the driver and broadcasts it, and this one stays a table.
2. *Group sums.*  Tasks add up the vectors of each group (and count the
   documents of each term) as a summarizer does, a buffer of ``BUFFER_TERMS``
   terms at most; the buffers meet by (lang, source, term), so neither a
   hot source nor a frequent word grows a task.
3. *Pairs.*  Most terms are missing in most groups, and all terms that a
   group lacks have the same share ``z``.  With f(a, b) of two shares, the sum
   over the vocabulary is that of f(a, z_b) over the terms of one, of f(z_a, b)
   over the terms of the other, a correction over the terms of both, and
   f(z_a, z_b) for each of the rest.  The first two need only the distinct
   counts in each group; the terms of both are met in chunks of the vocabulary
   of bounded size, where tasks add up the correction of each pair of
   ``BLOCK_GROUPS`` groups.  No row is made for a term of a pair.

All numbers are whole: shares are computed in decimals, distances in
64-bit integers.

Defined cases: null text, lang or source are empty; a group without terms
has all shares alike; a language without vocabulary has distances of 0 and
no terms; an empty table has no rows; rows that repeat a doc_id are documents
of their own; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddy.llm.graph import written

MIN_DF, VOCAB_SIZE = 10, 2 ** 31 - 1
SCALE, TOP = 1_000_000_000, 10
BUFFER_TERMS = 200_000
CHUNK_ENTRIES, BLOCK_GROUPS = 1 << 15, 256

#: The terms, in UTF-8: what the pattern [^\x00-\x40\x5B-\x60\x7B-\x7F]+ matches, lower-cased.
_TERM = re.compile(rb"[a-z\x80-\xff]+")


def term_counts(text: str | bytes | None) -> Counter:
    """The sparse vector of one text: how often each term (UTF-8) occurs."""
    raw = text.encode() if isinstance(text, str) else text or b""
    return Counter(_TERM.findall(raw.lower()))


def vectorize(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, terms, counts): the documents as sparse vectors over all their terms."""
    def run(batches):
        for b in batches:
            vectors = [term_counts(t.as_buffer().to_pybytes()) for t in b.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "lang", "source")),
                 pa.array([[t.decode() for t in v] for v in vectors], pa.list_(pa.string())),
                 pa.array([list(v.values()) for v in vectors], pa.list_(pa.int64()))],
                names=["doc_id", "lang", "source", "terms", "counts"])
    return _clean(docs).mapInArrow(run, "doc_id bigint, lang string, source string, terms array<string>, counts array<bigint>")


def _clean(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _sum_vectors(batches):
    """Partial sums of the vectors of each group; a term null tells that the group exists.

    Vectors are added to their group's buffer term by term, without being made apart.
    """
    sums: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flush():
        columns = [[], [], [], [], []]
        for (lang, source), (counts, docs) in sums.items():
            n = len(counts) + 1
            columns[0].append(pa.repeat(pa.scalar(lang, pa.string()), n))
            columns[1].append(pa.repeat(pa.scalar(source, pa.string()), n))
            columns[2].append(pa.array([None, *counts], pa.binary()).cast(pa.string()))
            columns[3].append(pa.array([0, *counts.values()], pa.int64()))
            columns[4].append(pa.array([0, *map(docs.__getitem__, counts)], pa.int64()))
        return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], names=["lang", "source", "term", "n", "docs"])

    for b in batches:
        texts = b.column("text").cast(pa.binary())
        for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), texts):
            terms = _TERM.findall(text.as_buffer().to_pybytes().lower())
            counts, docs = sums.setdefault((lang, source), (Counter(), Counter()))
            size -= len(counts)
            counts.update(terms)
            docs.update(set(terms))
            size += len(counts)
            if size >= BUFFER_TERMS:
                yield flush()
                sums, size = {}, 0
    if sums:
        yield flush()


def group_sums(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group.

    A row with a null term stands for each group.
    """
    parts = _clean(docs).select("lang", "source", "text").mapInArrow(
        _sum_vectors, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * size)); ``size`` isn't 0."""
    over = (n + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", over, (total + 2 * size).cast("decimal(20,0)")) + 1


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of two shares."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _f(p: np.ndarray, q) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _both(table: pa.Table) -> pa.Table:
    """Per pair of groups: the terms of both in this chunk, and their correction."""
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    term = np.unique(np.array(table.column("term").to_pylist(), object), return_inverse=True)[1]
    g, block, p, z = (table.column(c).to_numpy() for c in ("g", "block", "p", "z"))
    order = np.argsort(g, kind="stable")
    g, block, term, p, z = g[order], block[order], term[order], p[order], z[order]
    start = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    ends = np.append(start[1:], len(g))
    out = []
    own = np.zeros(term.max() + 1, np.int64)
    for a, b in zip(start, ends):
        if block[a] != i:
            continue
        own[term[a:b]] = p[a:b]
        # the other groups: later ones of this block, or those of block j
        rest = slice(b, None) if i == j else block == j
        q = own[term[rest]]
        hit = q > 0
        if hit.any():
            at, q, other, zero = g[rest][hit], q[hit], p[rest][hit], z[rest][hit]
            fix = _f(q, other) - _f(q, zero) - _f(other, z[a])
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            out.append(np.stack([np.full(len(first), g[a]), at[first], np.diff(np.append(first, len(at))), np.add.reduceat(fix, first)]))
        own[term[a:b]] = 0
    a, b, n, fix = np.concatenate(out, axis=1) if out else np.empty((4, 0), np.int64)
    return pa.table({"a": a, "b": b, "n_both": n, "fix": fix})


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) for each group of ``docs``.

    Part `pair`: all other sources of the language by distance.  Part
    `term`: the ``TOP`` terms that the group has more of than its language, by their
    distance from it.
    """
    sums = written(group_sums(docs), "sums")
    groups = sums.where("term is null").select("lang", "source")
    words = sums.where("term is not null")
    vocabulary = words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("df")) \
        .where(F.col("df") >= MIN_DF).select("lang", "term", "lang_n")
    kept = written(words.select("lang", "source", "term", "n").join(vocabulary, ["lang", "term"]), "kept")
    # the language's rows of the vocabulary, once each
    heads = kept.groupBy("lang", "term").agg(F.any_value("lang_n").alias("n"))
    langs = written(groups.select("lang").distinct().join(heads.groupBy("lang").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("lang_total")), "lang", "left").na.fill(0), "langs")
    largest = langs.agg(F.max("size")).first()[0] or 0
    if largest > VOCAB_SIZE:
        raise ValueError(f"a vocabulary of {largest} terms; {VOCAB_SIZE} at most have a whole number as index")
    totals = groups.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("present")),
                         ["lang", "source"], "left").na.fill(0).join(langs, "lang")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1       # one row a group
    has = F.col("size") > 0
    totals = written(totals.select(
        "lang", "source", "total", "present", "size", "lang_total", number.alias("g").cast("bigint"),
        F.when(has, share(F.lit(0), F.col("total"), F.col("size"))).otherwise(1).alias("z")), "totals")
    shares = kept.join(totals, ["lang", "source"]).select(
        "lang", "source", "g", "term", "n", "z", share(F.col("n"), F.col("total"), F.col("size")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("size")).alias("q"))
    shares = written(shares, "shares")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         distance(F.col("p"), F.col("q")).alias("value")) \
        .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= TOP)
    return terms.unionByName(_pairs(shares, totals).withColumn("rank", F.row_number().over(by_value)))


def _pairs(shares: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, part, item, value): the distances of every group to the others of its language."""
    # one side against the lack of the other: by distinct counts of the group
    counts = written(shares.groupBy("lang", "g", "p").agg(F.count(F.lit(1)).alias("k")), "counts")
    other = totals.select("lang", F.col("g").alias("b"), F.col("z").alias("zero"))
    single = counts.join(other, "lang").where("g <> b").groupBy("lang", F.col("g").alias("a"), "b").agg(
        F.sum(F.col("k") * distance(F.col("p"), F.col("zero"))).alias("single"))
    # terms of both: chunks of the vocabulary, blocks of groups
    size = totals.groupBy("lang").agg(F.sum("present").alias("entries"), F.ceil(F.count(F.lit(1)) / BLOCK_GROUPS).cast("int").alias("blocks"))
    size = written(size, "entries")
    chunk = F.pmod(F.xxhash64("term"), F.floor(F.col("entries") / CHUNK_ENTRIES) + 1)
    dealt = shares.join(size, "lang").select("lang", chunk.alias("chunk"), "term", "g", "p", "z", (F.col("g") % F.col("blocks")).cast("int").alias("block"),
                                             F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = dealt.select("*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).groupBy("lang", "chunk", "i", "j")
    corrected = met.applyInArrow(_named(_both), "lang string, a bigint, b bigint, n_both bigint, fix bigint")
    corrected = corrected.groupBy("lang", "a", "b").agg(F.sum("n_both").alias("n_both"), F.sum("fix").alias("fix"))
    corrected = written(corrected, "corrected")
    corrected = corrected.unionByName(corrected.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "n_both", "fix"))
    # every two sources of a language are a row of the result
    one, two = totals.alias("one"), totals.alias("two")
    pairs = one.join(two, "lang").where("one.g <> two.g").select(
        "lang", F.col("one.g").alias("a"), F.col("two.g").alias("b"), F.col("one.source").alias("source"), F.col("two.source").alias("item"),
        F.col("one.z").alias("za"), F.col("two.z").alias("zb"), F.col("one.size").alias("size"),
        (F.col("one.present") + F.col("two.present")).alias("present"))
    pairs = pairs.join(single, ["lang", "a", "b"], "left") \
        .join(single.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("single").alias("elgnis")), ["lang", "a", "b"], "left") \
        .join(corrected, ["lang", "a", "b"], "left").na.fill(0, ["single", "elgnis", "n_both", "fix"])
    rest = (F.col("size") - F.col("present") + F.col("n_both")) * distance(F.col("za"), F.col("zb"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item",
                        (F.col("single") + F.col("elgnis") + F.col("fix") + rest).alias("value"))


def _named(pairs_of):
    def run(table: pa.Table) -> pa.Table:
        out = pairs_of(table)
        return out.add_column(0, "lang", pa.array([table.column("lang")[0].as_py()] * out.num_rows, pa.string()))
    return run


AUDIT_SQL = f"""with d as (select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as ws from documents),
  t as (select row, lang, source, unnest(ws) as term from d),
  v as (select lang, term, count(*)::hugeint as n from t group by all having count(distinct row) >= {MIN_DF}),
  sizes as (select g.lang, count(v.term)::hugeint as v, coalesce(sum(v.n), 0)::hugeint as total from (select distinct lang from d) g left join v using (lang) group by 1),
  q as (select lang, term, 1 + {SCALE} * (n + 2) // (total + 2 * v) as q from v join sizes using (lang)),
  g as (select distinct lang, source from d),
  c as (select lang, source, term, count(*)::hugeint as n from t semi join v using (lang, term) group by all),
  n as (select lang, source, coalesce(sum(n), 0)::hugeint as total from g left join c using (lang, source) group by all),
  p as (select n.lang, n.source, q.term, coalesce(c.n, 0) as n, q.q, 1 + {SCALE} * (coalesce(c.n, 0) + 2) // (n.total + 2 * sizes.v) as p
        from n join sizes using (lang) join q using (lang) left join c on c.lang = n.lang and c.source = n.source and c.term = q.term),
  f as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
        from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
  r as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0)::bigint as value
        from g a join g b on a.lang = b.lang and a.source <> b.source left join f on f.lang = a.lang and f.source = a.source and f.item = b.source
        union all select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from p where n > 0 and p > q),
  k as (select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from r)
  select * from k where part = 'pair' or rank <= {TOP}"""
