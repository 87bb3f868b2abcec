"""SQL with the rows of the registered queries, by plain definitions, for an engine that reads the same tables."""

from __future__ import annotations

from pacewright.llm import decontamination as leaks
from pacewright.llm import quality as q

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"

NEAR_DUPLICATES = f"""
with recursive w as (select doc_id, {_WORDS.format(_LOWER.format("text"))} as w from documents),
s as (
  select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as sh
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by all),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
both_ways as (select a, b from e union all select b, a from e),
reach as (select doc_id as x, doc_id as y from documents union select r.x, g.b from reach r join both_ways g on r.y = g.a)
select x as doc_id, cast(coalesce(any_value(n.n), 0) as bigint) as n_shingles, min(y) as component_id, x = min(y) as kept
from reach left join n on n.doc_id = x group by x"""

_DIGEST = """array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * cast(bits[5 * i + 1] as int)
    + 8 * cast(bits[5 * i + 2] as int) + 4 * cast(bits[5 * i + 3] as int) + 2 * cast(bits[5 * i + 4] as int) + cast(bits[5 * i + 5] as int), 1)), '')"""
WARC = f"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
b as (select *, array_to_string(list_transform(string_split(hex, ''), lambda c: lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0')), '') as bits from p),
m as (select hex, max(page_id) as to_page from p group by hex)
select page_id, cast(strlen(html) as bigint) as payload_bytes, {_DIGEST} as payload_digest,
  case when page_id = to_page then 'response' else 'revisit' end as record_type, case when page_id <> to_page then to_page end as refers_to
from b join m using (hex)"""


def _contamination() -> str:
    seeds = lambda source, key: " union all ".join(
        f"select {key}, pos, {m} as m, concat_ws(chr(1), " + ", ".join(f"w[pos + {j + 1}]" for j, bit in enumerate(mask) if bit == "1") + f") as s from {source}, lateral (select unnest(range(0, len(w) - {len(mask)} + 1)) as pos) z"
        for m, mask in enumerate(leaks.MASKS)
    )
    reach, least, coverage, long = leaks.REACH, leaks.LEAST_EQUAL, leaks.COVERAGE, leaks.LONG_OVERLAP
    words = _WORDS.format("lower(text)")
    shortest = min(map(len, leaks.MASKS))
    return f"""
with d as (select distinct doc_id, {words} as w from documents), b as (select distinct item_id, {words} as w from benchmark),
short as (select item_id, len(w) as n, array_to_string(w, chr(1)) as s from b where len(w) between 1 and {shortest - 1}),
whole as (select doc_id, pos, n, array_to_string(w[pos + 1:pos + n], chr(1)) as s from d, (select distinct n from short) l, lateral (select unnest(range(0, len(w) - n + 1)) as pos) z),
hit as (select distinct doc_id, item_id, x.pos - y.pos as start, y.pos as item_at from ({seeds("d", "doc_id")}) x join ({seeds("b", "item_id")}) y using (m, s)
  union select doc_id, item_id, pos, 0 from whole join short using (n, s)),
place as (select distinct doc_id, item_id, start, unnest(range(0, len(b.w))) as j from hit join b using (item_id)),
same as (select doc_id, item_id, start, j from place join d using (doc_id) join b using (item_id) where start + j >= 0 and d.w[start + j + 1] = b.w[j + 1]),
near as (select hit.doc_id, hit.item_id, hit.start, item_at, count(*) as c from hit join same using (doc_id, item_id, start) where abs(j - item_at) <= {reach} group by all),
good as (select distinct doc_id, item_id, start from near join b using (item_id) where c >= least({least}, len(w) - len(w) // 4)),
found as (select doc_id, item_id, count(distinct j) as n_matched, min(start) as first_word from same semi join good using (doc_id, item_id, start) group by all),
longest as (select doc_id, item_id, max(c) as c from near semi join good using (doc_id, item_id, start) group by all)
select doc_id, item_id, cast(len(w) as bigint) as n_item_words, n_matched, n_matched / cast(len(w) as double) as coverage, first_word
from found join longest using (doc_id, item_id) join b using (item_id) where n_matched / cast(len(w) as double) >= {coverage} or c >= {long}"""


def _quality() -> str:
    """The operator's own steps, which both engines read, over statistics by plain definitions."""
    tables: list[tuple[str, str]] = []

    def table(name: str, sql: str, **names: str) -> str:
        tables.append((name, sql.format(**names)))
        return name

    w = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
    table("d", f"select doc_id, coalesce('=' || lang, '?') as gl, coalesce('=' || source, '?') as gs, coalesce(text, '') as text, {w} as w from documents".replace("{", "{{").replace("}", "}}"))
    table("g", "select doc_id, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] as t from d, lateral (select unnest(range(1, len(w) - 1)) as i) z")
    table("rep", "select doc_id, count(distinct k) as n from (select doc_id, unnest([i, i + 1, i + 2]) as k from g join (select doc_id, t from g group by all having count(*) > 1) using (doc_id, t)) group by doc_id")
    table("lin", r"select doc_id, count(*) as n_lines, count(*) - count(distinct l) as dup from (select doc_id, unnest(string_split(text, chr(10))) as l from d) where regexp_matches(l, '[^\x20\x09-\x0D]') group by doc_id")
    table(
        "stats",
        r"select d.doc_id, gl, gs, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars, cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(coalesce(dup, 0) as bigint) as n_dup_lines, cast(coalesce(rep.n, 0) as bigint) as n_repeat_words, cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) as bigint) as n_capitals from d left join rep on rep.doc_id = d.doc_id left join lin on lin.doc_id = d.doc_id",
    )
    table("vectors", q.VECTORS, stats="stats")
    table("grouped", q.GROUPS, vectors="vectors")
    table("rws", q.ROWS, vectors="vectors", groups="grouped")
    table("middle", q.MIDDLE, rows="rws")
    table("spread", q.SPREAD, rows="rws", middle="middle")
    estimate = table("e0", q.FIRST, middle="middle", spread="spread")
    for i in range(q.STEPS):
        distances = table(f"d{i}", q.DISTANCES, rows="rws", estimate=estimate)
        ranks = table(f"r{i}", q.RANKS, distances=distances)
        moments = table(f"m{i}", q.MOMENTS, distances=distances, ranks=ranks)
        estimate = table(f"e{i + 1}", q.ESTIMATE, moments=moments)
    table("lst", q.LAST, estimate=estimate, middle="middle")
    table("placed", "select * from (" + q.PLACED + ") p left join grouped using (gl, gs) left join lst using (pl, ps)", stats="stats")
    table("far", q.verdicts("doc_id"), placed="placed")
    chain = ",\n".join(f"{name} as materialized ({sql})" for name, sql in tables)
    return f"with {chain}\nselect * exclude (distance) from far"


MIDDLE_FILL = r"""
with t as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u
  from documents),
d as (
  select *, len(u) as n, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2, cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4,
    text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') as held
  from t),
c as (
  select doc_id, text, n, case when held or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form,
    array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '') as p,
    array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') as m,
    array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') as s
  from d)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars, case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(text) as restored_sha256
from c"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": _quality(),
        "op3_near_duplicates": NEAR_DUPLICATES,
        "op6_warc": WARC,
        "op8_decontamination": _contamination(),
        "op13_middle_fill": MIDDLE_FILL,
    }
