"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

import string

LOWER = f"translate(%s, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
TEXT = LOWER % "coalesce(text, '')"
PHRASE_WORDS = rf"regexp_extract_all({TEXT}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
WORD = r"'[^\x20\x09-\x0D]+'"

PHRASES = f"""
with d as (select doc_id, {PHRASE_WORDS} as ws from documents),
i as (select cast(item_id as varchar) as id, {PHRASE_WORDS} as ws, least(10, len(ws)) as k
      from benchmark),
iw as (select id, k, ws[s:s + k - 1] as win from i, unnest(range(1, len(ws) - k + 2)) t(s)
       where k > 0),
dw as (select doc_id, k, s, ws[s:s + k - 1] as win
       from d, (select distinct k from i where k > 0), unnest(range(1, len(ws) - k + 2)) t(s)),
found as (select distinct doc_id, s, k, id from dw join iw using (k, win)),
hits as (select doc_id, count(distinct p) as n_hit from found, unnest(range(s, s + k)) t(p)
         group by doc_id),
items as (select doc_id, count(distinct id) as n_items,
                 string_agg(distinct id, ',' order by id) as ids from found group by doc_id)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join hits using (doc_id) left join items using (doc_id)
"""

NEAR_DUPLICATES = f"""
with recursive d as (select doc_id, regexp_extract_all({TEXT}, {WORD}) as ws from documents),
sh as (select distinct doc_id, ws[s:s + 2] as sh from d, unnest(range(1, len(ws) - 1)) t(s)
       union all select doc_id, ws from d where len(ws) between 1 and 2),
size as (select doc_id, count(*) as n from sh group by doc_id),
common as (select a.doc_id as u, b.doc_id as v, count(*) as c
           from sh a join sh b on a.sh = b.sh and a.doc_id < b.doc_id group by all),
links as (select u, v from common join size x on x.doc_id = u join size y on y.doc_id = v
          where 100 * c >= 85 * (x.n + y.n - c)),
both_ways as (select u, v from links union all select v, u from links),
reach as (select doc_id, doc_id as other from documents
          union select reach.doc_id, v from reach join both_ways on u = other),
least_of as (select doc_id, min(other) as component_id from reach group by doc_id)
select doc_id, coalesce(n, 0) as n_shingles, component_id, component_id = doc_id as kept
from least_of left join size using (doc_id)
"""

LINES = f"""
with p as (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
lines as (select doc_id, i - 1 as line,
                 list_distinct(regexp_extract_all({LOWER % "parts[i]"}, {WORD})) as ws
          from p, unnest(range(1, len(parts) + 1)) t(i)),
tok as (select doc_id, line, len(ws) as n, unnest(ws) as w from lines),
df as (select w, count(*) as c from tok group by w),
ranked as (select doc_id, line, n, w, row_number() over (partition by doc_id, line order by c, w) as r
           from tok join df using (w)),
pre as (select * from ranked where r <= n - (80 * n + 99) // 100 + 1),
cand as (select distinct a.doc_id, a.line, a.n, b.doc_id as bd, b.line as bl, b.n as bn
         from pre a join pre b using (w)
         where (b.doc_id < a.doc_id or b.doc_id = a.doc_id and b.line < a.line)
           and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
alike as (select c.doc_id, c.line
            from cand c join tok x on x.doc_id = c.doc_id and x.line = c.line
                        join tok y on y.doc_id = c.bd and y.line = c.bl and y.w = x.w
            group by c.doc_id, c.line, c.bd, c.bl, c.n, c.bn
            having 100 * count(*) >= 80 * (c.n + c.bn - count(*))),
gone as (select doc_id, count(*) as n, string_agg(line, ',' order by line) as removed
         from (select distinct doc_id, line from alike) group by doc_id)
select doc_id, cast(len(parts) as bigint) as n_lines, coalesce(n, 0) as n_removed,
       coalesce(removed, '') as removed
from p left join gone using (doc_id)
"""

_AWAY = " + ".join(f"(x[{i}] - c[{i}]) * (x[{i}] - c[{i}])" for i in range(1, 5))


def _rounds(rounds: int) -> str:
    """Assignments a0, a1, .. and the codebooks b1, b2, .. they lead to, from b0."""
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"a{r} as (select p, row, arg_min(k, ({_AWAY}) * 64 + k) as k, min({_AWAY}) as d\n"
            f"       from cut join b{r} using (p) group by p, row)"
        )
        if r < rounds:
            means = ", ".join(f"(s{i} - ((s{i} % n) + n) % n) // n" for i in range(1, 5))
            sums = ", ".join(f"sum(x[{i}])::bigint as s{i}" for i in range(1, 5))
            steps.append(
                f"m{r} as (select p, k, count(*) as n, {sums} from a{r} join cut using (p, row) group by p, k),\n"
                f"b{r + 1} as (select p, k, case when n is null then c else [{means}] end as c\n"
                f"       from b{r} left join m{r} using (p, k))"
            )
    return ",\n".join(steps)


PART_CODES = f"""
with kept as (select vec_id, label, row_number() over (order by vec_id, embedding) as row,
                     list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
              from embeddings where embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
cut as (select row, p, v[4 * p + 1:4 * p + 4] as x from kept, unnest(range(16)) t(p)),
b0 as (select p, row - 1 as k, x as c from cut where row <= 64),
{_rounds(2)},
coded as (select row, string_agg(printf('%02x', k), '' order by p) as code, sum(d)::bigint as error
          from a2 group by row),
book as (select sha256(string_agg(array_to_string(c, ','), ',' order by p, k)) as digest from b2)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
       digest as codebooks_sha256
from kept join coded using (row), book
"""
