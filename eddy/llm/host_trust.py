"""Url rules and, where none fits, trust carried along links between hosts.

Every operation is a DataFrame function.  A page's host and path are cut
from its url; the longest fitting rule decides.  For the rest:

* *Host edges*: the links in the pages' html that name a host, counted per
  (from, to) pair of different hosts.
* *Seeds*: the pages of a host under an allow rule are its trust seed,
  those under a block rule its distrust seed.
* Personalised PageRank carries trust from a host to the hosts it links to
  and, on the reversed edges, distrust from a host to those that link to
  it, ``ROUNDS`` times.
* A host is blocked when its distrust less its trust is more than
  ``LIMIT`` per page of the host.

Pages are reduced to host and pair counts before anything is shuffled by
host, so a host with a third of all pages is no hot key; its verdict comes
back by a join with the blocked hosts in which its pages are dealt to
``SALTS`` and its row is repeated for each.

Defined cases: a null url or one without ``://`` has an empty host and an
empty path; rules never fit an empty host; a host without any evidence is
allowed; null html has no links; repeated rows each count and each give a
row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddy.llm.graph import written

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DAMPING, ROUNDS, LIMIT = 0.85, 10, 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Scheme and host of a link that names its host: absolute or protocol-relative, quoted or not.
_LINK = r"""href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^/?#"'\s>]+)"""
# Tasks over which the pages of a host are spread when they get their verdict.
SALTS = 32


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as (rule, action); null if none fits."""
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """(a, b, n): links from host a to another host b.

    A link counts if it starts with a host (``http://x/..`` or ``//x/..``), not
    if it only has one inside (``/go?u=http://x``).
    """
    links = F.regexp_extract_all("html", F.lit("(?i)" + _LINK), 1)
    host = F.translate(F.regexp_replace("link", "^[^/]*//", ""), _UPPER, _LOWER)
    return pages.select(host_of(F.col("url")).alias("a"), F.explode(links).alias("link")) \
        .select("a", host.alias("b")).where("a <> b and a <> '' and b <> ''") \
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) after ``rounds`` of personalised PageRank both ways.

    ``seeds``: (host, trust, distrust); ``edges``: (a, b, n).
    """
    # trust runs along an edge, distrust against it; each in shares of what leaves a node
    steps = edges.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("a").alias("from"), F.col("b").alias("to"), "n"),
        F.struct(F.lit("distrust").alias("kind"), F.col("b").alias("from"), F.col("a").alias("to"), "n"))).alias("s")).select("s.*")
    out = steps.groupBy("kind", "from").agg(F.sum("n").alias("all"))
    steps = written(steps.join(out, ["kind", "from"]).select("kind", "from", "to", (F.col("n") / F.col("all")).alias("share")), "steps")
    start = seeds.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), "host", F.col("trust").alias("v")),
        F.struct(F.lit("distrust").alias("kind"), "host", F.col("distrust").alias("v")))).alias("s")).select("s.*").where("v > 0")
    start = written(start, "seeds")
    rank = start
    for k in range(rounds):
        moved = rank.join(steps, (rank["kind"] == steps["kind"]) & (rank["host"] == steps["from"])) \
            .select(rank["kind"], F.col("to").alias("host"), (F.lit(damping) * F.col("v") * F.col("share")).alias("v"))
        kept = start.select("kind", "host", (F.lit(1 - damping) * F.col("v")).alias("v"))
        rank = kept.unionByName(moved).groupBy("kind", "host").agg(F.sum("v").alias("v"))
        if k % 4 == 3:
            rank = written(rank, "rank")
    value = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("v"))), F.lit(0.0)).alias(kind)
    return rank.groupBy("host").agg(value("trust"), value("distrust"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages``."""
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")) \
        .withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    count = lambda action: F.count(F.when(F.col("found.action") == action, 1)).cast("double")
    hosts = written(urls.groupBy("host").agg(count("allow").alias("trust"), count("block").alias("distrust"),
                                             F.count(F.lit(1)).alias("pages")), "hosts")
    ranks = propagate(hosts, host_edges(pages)).select(F.col("host").alias("h"), F.col("trust").alias("t"), F.col("distrust").alias("d"))
    # a host's seed keeps (1 - damping) of its weight: measure against that
    excess = (F.coalesce("d", F.lit(0.0)) - F.coalesce("t", F.lit(0.0))) / F.lit(1 - DAMPING)
    bad = hosts.join(ranks, F.col("host") == F.col("h"), "left") \
        .select(F.col("host").alias("h"), (excess > F.lit(LIMIT) * F.col("pages")).alias("bad")).where("bad")
    # a hot host's pages are dealt to salts; those with a rule look for nothing
    bad = bad.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int") - F.when(F.col("found").isNull(), 0).otherwise(SALTS)
    out = urls.withColumn("salt", salt).join(bad, (F.col("host") == F.col("h")) & (F.col("salt") == F.col("s")), "left")
    verdict = F.coalesce("found.action", F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"))


def judge_urls_sql(rules: Sequence[tuple[str, str]] = RULES) -> str:
    """The same in DuckDB SQL, the rounds written out."""
    def low(x):
        return f"translate(coalesce({x}, ''), '{_UPPER}', '{_LOWER}')"

    def part(url, k):
        return f"regexp_extract({url}, '^.*?://([^/?#]*)([^?#]*)', {k}, 's')"

    rule = action = "null"
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = text.partition("/")
        fits = f"(host = '{name}' or ends_with(host, '.{name}')) and starts_with(path, '/{rest}')"
        rule, action = (f"case when {fits} then '{x}' else {y} end" for x, y in ((text, rule), (what, action)))
    link = _LINK.replace("'", "''")
    rounds = ["r0 as (select * from seeds)"]
    for k in range(ROUNDS):
        rounds.append(f"""r{k + 1} as materialized (select kind, host, sum(v) as v from (
            select kind, host, {1 - DAMPING} * v as v from seeds union all
            select s.kind, s."to", {DAMPING} * r.v * s.share from r{k} r join steps s on r.kind = s.kind and r.host = s."from") group by 1, 2)""")
    return f"""with cut as (select page_id, {low(part('url', 1))} as host, coalesce({part('url', 2)}, '') as path, url, html from pages),
      urls as (select *, {rule} as rule, {action} as action from cut),
      links as (select host as a, unnest(regexp_extract_all(html, '{link}', 1, 'i')) as link from urls),
      edges as (select a, b, count(*) as n from (select a, {low("regexp_replace(link, '^[^/]*//', '')")} as b from links)
        where a <> b and a <> '' and b <> '' group by 1, 2),
      both_ways as (select 'trust' as kind, a as "from", b as "to", n from edges union all select 'distrust', b, a, n from edges),
      steps as materialized (select kind, "from", "to", n / sum(n) over (partition by kind, "from") as share from both_ways),
      hosts as materialized (select host, count(case when action = 'allow' then 1 end) as trust, count(case when action = 'block' then 1 end) as distrust,
        count(*) as pages from urls group by 1),
      seeds as (select 'trust' as kind, host, trust::double as v from hosts where trust > 0
        union all select 'distrust', host, distrust::double from hosts where distrust > 0),
      {', '.join(rounds)},
      bad as (select h.host, (coalesce(d.v, 0) - coalesce(t.v, 0)) / {1 - DAMPING} > {LIMIT} * h.pages as bad from hosts h
        left join r{ROUNDS} t on t.kind = 'trust' and t.host = h.host left join r{ROUNDS} d on d.kind = 'distrust' and d.host = h.host)
      select u.page_id, u.host, u.path, u.rule, coalesce(u.action, case when b.bad then 'block' else 'allow' end) as verdict
      from urls u left join bad b on u.host = b.host"""
