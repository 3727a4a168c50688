"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations


def _assign(parts: str, book: str) -> str:
    """Nearest entry of each part: all pairs of a position, the smallest (distance, entry)."""
    return f"""
    select n, pos, part, best.d as d, best.e as e from (
      select p.n, p.pos, any_value(p.part) as part,
             min({{'d': list_sum(list_transform(list_zip(p.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::hugeint,
                   'e': b.e}}) as best
      from {parts} p join {book} b on p.pos = b.pos group by p.n, p.pos)"""


def _vector_codes(rounds: int = 4) -> str:
    steps = []
    for k in range(rounds):
        steps.append(f"""
  near{k} as materialized ({_assign('parts', f'book{k}')}),
  mean{k} as (
    select pos, e, list((s - ((s % c) + c) % c) // c order by i)::bigint[] as part from (
      select pos, e, i, sum(x) as s, count(*) as c from (
        select pos, e, unnest(part) as x, generate_subscripts(part, 1) as i from near{k}) group by all) group by all),
  book{k + 1} as materialized (
    select b.pos, b.e, coalesce(m.part, b.part) as part from book{k} b left join mean{k} m on b.pos = m.pos and b.e = m.e)""")
    return f"""
with rows as (
    select row_number() over (order by vec_id nulls last, embedding) as n, vec_id, label,
           list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
    from embeddings
    where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  parts as materialized (
    select n, pos, v[pos * (len(v) // 4) + 1: (pos + 1) * (len(v) // 4)] as part from rows, (select unnest(range(4)) as pos)),
  book0 as materialized (select pos, n - 1 as e, part from parts where n <= 256),{','.join(steps)},
  final as materialized ({_assign('parts', f'book{rounds}')}),
  coded as (select n, string_agg(printf('%02x', e), '' order by pos) as code, sum(d) as error from final group by n),
  digest as (select sha256(string_agg(array_to_string(part, ','), ',' order by pos, e)) as h from book{rounds})
select r.vec_id, c.code, c.error::bigint as error,
       (sum(c.error) over (partition by r.label))::bigint as label_error, h as codebooks_sha256
from rows r join coded c on r.n = c.n, digest"""


VECTOR_CODES = _vector_codes()

COLLOCATIONS = r"""
with pieces as (
    select coalesce(lang, 'und') as lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) as piece from documents),
  words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
  places as (select lang, w, unnest(range(1, len(w) + 1)) as i from words),
  grams as materialized (
    select lang, size, gram, count(*) as f from (
      select lang, size, array_to_string(w[i: i + size - 1], ' ') as gram
      from places, (select unnest([1, 2, 3]) as size) where i + size - 1 <= len(w))
    group by all),
  totals as (select lang, sum(f)::bigint as n from grams where size = 1 group by lang),
  candidates as materialized (select lang, size, gram, f as a, string_split(gram, ' ') as w from grams where size > 1 and f >= 10),
  cuts as (
    select c.lang, c.gram, c.a, k, l.f as l, r.f as r, (1000000::hugeint * c.a * c.a) // (l.f::hugeint * r.f) as score
    from (select *, unnest(range(1, size)) as k from candidates) c
    join grams l on l.lang = c.lang and l.gram = array_to_string(c.w[:c.k], ' ') and l.size = c.k
    join grams r on r.lang = c.lang and r.gram = array_to_string(c.w[c.k + 1:], ' ') and r.size = c.size - c.k),
  inner_grams as (
    select lang, array_to_string(w[i: i + 1], ' ') as gram, max(a) as a
    from (select *, unnest([1, 2]) as i from candidates where size = 3) group by all),
  lowest as (
    select c.* from cuts c left join inner_grams g on g.lang = c.lang and g.gram = c.gram
    where g.a is null or 100 * g.a < 50 * c.a
    qualify row_number() over (partition by c.lang, c.gram order by c.score, c.k) = 1),
  ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, encode(gram)) as rank from lowest)
select lang, rank::bigint as rank, gram as phrase, a, l, r, n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000"""



def url_filters(rules: list[tuple[str, str, str]], listed: list[tuple[str, str, str]]) -> str:
    """Every listing against every URL; of those that fit the first by kind, length, verdict and name."""
    def normal(text: str) -> str:
        code = "(instr('0123456789ABCDEF', upper(p[2])) - 1) * 16 + instr('0123456789ABCDEF', upper(p[3])) - 1"
        return f"""array_to_string(list_transform(regexp_extract_all({text}, '%[0-9A-Fa-f]{{2}}|[^%]+|%'), lambda p:
             case when not regexp_full_match(p, '%[0-9A-Fa-f]{{2}}') then p
                  when regexp_full_match(chr(({code})::int), '[A-Za-z0-9._~-]') then chr(({code})::int) else upper(p) end), '')"""

    def low(text: str) -> str:
        return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    names = [(*r, True) for r in rules] + [(*r, False) for r in listed]
    listings = ", ".join(f"('{h}', '{p}', '{v}', {str(r).lower()})" for h, p, v, r in names)
    bare = r"regexp_replace(regexp_replace(host, '^.*@', '', 's'), ':[0-9]*$', '')"
    return f"""
with listings(h, p, v, is_rule) as (values {listings}),
  urls as (
    select row_number() over () as n, page_id,
           {low("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')")} as host,
           regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path from pages),
  forms as (
    select *, rtrim({low(normal(bare))}, '.') as site, case when path = '' then '/' else {normal('path')} end as place from urls),
  fits as (
    select f.n, f.page_id, f.host, f.path, l.is_rule, l.v, l.h || l.p as name
    from forms f left join listings l on
      (case when is_rule then host else site end = h or ends_with(case when is_rule then host else site end, '.' || h))
      and starts_with(case when is_rule then path else place end, p)
    qualify row_number() over (partition by f.n order by is_rule desc nulls last, length(name) desc, v, name desc) = 1)
select page_id, host, path, case when is_rule then name end as rule, case when not is_rule then name end as listed,
       coalesce(v, 'allow') as verdict
from fits"""
