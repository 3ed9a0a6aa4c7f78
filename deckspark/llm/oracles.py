"""DuckDB SQL of the queries that SQL can express (op11, op12, op13)."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text expression's UTF-8 bytes; DuckDB has
    none.  The polynomial is the public one."""
    byte = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda k: ('0x' || substr(hex(encode({text})), 2 * k - 1, 2))::UBIGINT)"
    bits = "list_reduce(list_concat([xor(c, b)], list_transform(range(8), lambda z: 0::UBIGINT)), lambda x, z: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))"
    return f"xor(list_reduce(list_concat([4294967295::UBIGINT], {byte}), lambda c, b: {bits}), 4294967295::UBIGINT)::BIGINT"


def url_model(rules: list[tuple[str, str]], order: int) -> str:
    longest = sorted(rules, key=lambda r: -len(r[1]))

    def fits(text: str) -> str:
        host, _, path = text.partition("/")
        return f"(host = '{host}' or suffix(host, '.{host}')) and starts_with(path, '/{path}')"

    pick = lambda of: "case " + " ".join(f"when {fits(r[1])} then '{of(r)}'" for r in longest) + " end"
    low, up = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    joins = " ".join(f"join known k{s} on k{s}.size = {s} and k{s}.tail = right(g.gram, {s})" for s in range(1, order + 2))

    def mixed(s: int, x: str) -> str:
        if not s:
            return str(1.0 / 0x110000)
        k = f"k{s}"
        return f"case when {k}.n{x} > 0 then ({k}.{x} + {k}.t{x} * ({mixed(s - 1, x)})) / ({k}.n{x} + {k}.t{x}) else {mixed(s - 1, x)} end"

    return f"""
with u as (select coalesce(url, '') as url, count(*) as n from pages group by 1),
cut1 as (select *, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest from u),
cut2 as (select *, regexp_extract(rest, '^[^/?#]*') as raw from cut1),
hp as (select url, n, translate(raw, '{up}', '{low}') as host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from cut2),
ruled as (select *, {pick(lambda r: r[1])} as rule, {pick(lambda r: r[0])} as verdict, {crc32('url')} % 4 = 2 as fold from hp),
grams as (
  select url, n, verdict, fold, substr(repeat(chr(2), {order}) || url || chr(3), i::int, {order + 1}) as gram
  from (select *, unnest(range(1, length(url) + 2)) as i from ruled)),
counts as (
  select gram, sum(case when not fold and verdict = 'allow' then n else 0 end) as a,
         sum(case when not fold and verdict = 'block' then n else 0 end) as b
  from grams group by 1),
seen as (
  select size, right(gram, size::int) as tail, sum(a)::double as a, sum(b)::double as b
  from counts, range(1, {order + 2}) as t(size) group by all),
after as (
  select size, left(tail, -1) as context, sum(a) as na, sum(b) as nb,
         sum((a > 0)::int)::double as ta, sum((b > 0)::int)::double as tb
  from seen group by all),
known as (select s.*, c.na, c.nb, c.ta, c.tb from seen s join after c on c.size = s.size and c.context = left(s.tail, -1)),
rated as (select g.gram, ln({mixed(order + 1, 'a')}) - ln({mixed(order + 1, 'b')}) as ratio from counts g {joins}),
scored as (
  select url, n, verdict, round(sum(ratio) / count(*), 9) as score
  from grams join rated using (gram) where verdict is null or fold group by all),
binned as (select *, greatest(-10000, least(10000, floor(score / 0.001)::bigint)) as bin from scored),
bins as (
  select bin, sum(case when verdict = 'allow' then n else 0 end) as good, sum(case when verdict = 'block' then n else 0 end) as bad
  from binned where verdict is not null group by 1),
cuts as (select 0 as cut union select bin from bins union select bin + 1 from bins),
errors as (
  select cut, (select sum(good) from bins) * coalesce((select sum(bad) from bins where bin >= cut), 0)
            + (select sum(bad) from bins) * coalesce((select sum(good) from bins where bin < cut), 0) as err
  from cuts),
best as (
  select case when (select sum(good) * sum(bad) from bins) > 0 then
    (select cut from errors order by err, abs(cut), cut limit 1) else 0 end as cut)
select p.page_id, r.host, r.path, r.rule,
       coalesce(r.verdict, case when b.bin >= (select cut from best) then 'allow' else 'block' end) as verdict
from pages p join ruled r on r.url = coalesce(p.url, '') left join binned b on b.url = r.url and b.verdict is null
"""


# A stretch of equal words q apart is an island of equal 16-word strings q
# apart: the pair of any run has 16 words or more in common.
PERIODIC_RUNS = f"""
with w0 as (
  select doc_id, row_number() over () as rid, text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
         {crc32("coalesce(doc_id::varchar, '')")} as h from documents),
w1 as (select *, len(w) as n, h // 10 as g from w0),
w2 as (select *, case when n > 0 then g % n end as a, case when n > 0 then 1 + (n - g % n) // (3 + g % 8) end as p from w1),
docs as (
  select doc_id, rid, case when h % 10 = 0 and n > 0
    then list_transform(range(n), lambda i: case when i < a then w[i + 1] else w[a + (i - a) % p + 1] end) else w end as w from w2),
grams as (
  select rid, i::bigint as i, array_to_string(w[i + 1 : i + 16], ' ') as gram
  from (select rid, w, unnest(range(len(w) - 15)) as i from docs where len(w) >= 24)),
twice as (select rid, gram from grams group by all having count(*) > 1),
twins as (select g.* from grams g join twice using (rid, gram)),
pairs as (select x.rid, x.i, y.i - x.i as q from twins x join twins y on x.rid = y.rid and x.gram = y.gram and x.i < y.i),
marked as (select *, i - row_number() over (partition by rid, q order by i) as island from pairs),
stretches as (select rid, min(i) as s, count(*) + 15 + q as length, q from marked group by rid, q, island),
runs as (
  select rid, s, length, min(q) as q from stretches
  where length >= 24 and length >= 3 * q group by rid, s, length),
listed as (
  select rid, count(*) as n_runs,
    first(struct_pack(s := s, length := length, q := q) order by length / q desc, s, q) as best,
    string_agg(s || ',' || length || ',' || q || chr(10), '' order by s, q) as lines from runs group by rid),
gone as (select distinct rid, unnest(range(s + q, s + length)) as i from runs),
words as (select rid, unnest(range(len(w))) as i, unnest(w) as x from docs),
kept as (select rid, string_agg(x, ' ' order by i) as t from words anti join gone using (rid, i) group by rid)
select d.doc_id, coalesce(l.n_runs, 0)::bigint as n_runs, l.best.s::bigint as start, l.best.length::bigint as length, l.best.q::bigint as period,
  (1000 * l.best.length // l.best.q)::bigint as exponent_milli,
  sha256(coalesce(l.lines, '')) as runs_sha256, sha256(coalesce(k.t, '')) as collapsed_sha256
from docs d left join listed l using (rid) left join kept k using (rid)
"""

HARD_NEGATIVES = """
with ok as (
  select * from embeddings where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
r as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v from ok),
s as (
  select a.vec_id as anchor_id, x.vec_id as other, a.label = x.label as same, list_dot_product(a.v, x.v)::bigint as score
  from r a join r x on x.vec_id <> a.vec_id and len(x.v) = len(a.v) where a.vec_id % 100 = 0),
pos as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, other) <= 5),
neg as (
  select p.anchor_id, p.other as positive_id, n.other as negative_id, p.score as positive_score, n.score as negative_score
  from pos p join s n on n.anchor_id = p.anchor_id and not n.same and 80 * p.score <= 100 * n.score and n.score <= p.score)
select anchor_id, positive_id, (row_number() over (partition by anchor_id, positive_id order by negative_score desc, negative_id))::int as rank,
  negative_id, positive_score, negative_score
from neg qualify rank <= 5
"""
