"""DuckDB SQL for the operators on documents that SQL can express.

Written for small tables: the shingle joins and the byte places are spelt
out row by row.
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table: str, key: str) -> str:
    text = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    return f"select {key}, regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+') as ws from {table}"


def _shingles(n: str) -> str:
    """The n-word shingles of a list ``ws`` of n words or more; words have no spaces."""
    return f"list_transform(range(1, len(ws) - {n} + 2), lambda i: array_to_string(ws[i:i + {n} - 1], ' '))"


def _classes(words: int, percent: int, more: str) -> str:
    """Classes of documents linked by the Jaccard similarity of their word shingles."""
    return f"""with recursive w as ({_words('documents', 'doc_id')}),
  s as (select distinct doc_id, unnest({_shingles(f'least({words}, len(ws))')}) as sh from w where len(ws) > 0),
  n as (select doc_id, count(*) as n from s group by 1),
  p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by 1, 2),
  l as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= {percent} * (nx.n + ny.n - c)),
  e as (select x as a, y as b from l union all select y, x from l),
  r(a, b) as (select a, b from e union select r.a, e.b from r join e on r.b = e.a),
  classes as (select a, min(b) as c from r group by a)
  select w.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(c, w.doc_id) as component_id{more}
  from w left join n on n.doc_id = w.doc_id left join classes on a = w.doc_id"""


NEAR_DUPLICATES = _classes(5, 75, ", w.doc_id = coalesce(c, w.doc_id) as kept")

#: For tables whose doc_ids are unique and not null.
NEARLY_EQUAL = _classes(3, 90, "")

CONTAMINATED = f"""with iw as (select distinct * from ({_words('benchmark', 'item_id')}) where len(ws) > 0),
  i as (select distinct item_id, least(5, len(ws)) as k, unnest({_shingles('least(5, len(ws))')}) as sh from iw),
  size as (select item_id, count(*) as n from i group by 1),
  dw as ({_words('documents', 'doc_id')}),
  d as (select distinct doc_id, unnest({_shingles('k')}) as sh from dw, (select distinct k from i) where len(ws) >= k)
  select doc_id, item_id, any_value(n) as item_shingles, count(*) as common
  from d join i using (sh) join size using (item_id) group by doc_id, item_id having 4 * count(*) >= 3 * any_value(n)"""

REMOVED_REPEATS = """with b as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
  p as (select doc_id, h, unnest(range(0, length(h) // 2 - 49)) as i from b),
  k as (select doc_id, i, substr(h, 2 * i + 1, 100) as key from p),
  least_doc as (select key, min(doc_id) as m from k group by 1),
  hit as (select doc_id, i, lag(i) over (partition by doc_id order by i) as before from k join least_doc using (key) where m < doc_id),
  marked as (select doc_id, i, sum(case when before is null or i > before + 50 then 1 else 0 end) over (partition by doc_id order by i) as span from hit),
  spans as (select doc_id, span, min(i) as a, max(i) + 50 as b from marked group by 1, 2),
  cut as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as before from spans),
  per as (select c.doc_id, sum(c.b - a) as removed, count(*) as n, max(c.b) as last_end,
          string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as kept
          from cut c join b on b.doc_id = c.doc_id group by 1)
  select b.doc_id, length(h) // 2 as n_bytes, coalesce(removed, 0)::bigint as n_removed, coalesce(n, 0) as n_spans,
    sha256(unhex(case when n is null then h else kept || substr(h, 2 * last_end + 1) end)) as kept_sha256
  from b left join per on per.doc_id = b.doc_id"""
