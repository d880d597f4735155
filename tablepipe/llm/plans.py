"""The registered queries of the operators, with production parameters."""

from __future__ import annotations

from tablepipe.llm import (
    bpe_codec,
    decontaminate,
    filter_audit,
    langid,
    licenses,
    minhash,
    mixing,
    phrases,
    quality_lm,
    substring_dedup,
    token_fst,
    toxicity,
    warc,
)
from tablepipe.plans import table

REGISTRY: dict = {}
# A-Z and a-z, for SQL that lowers ASCII letters only.
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def query(name, sql=None):
    def wrap(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return wrap


def queries() -> dict:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    return token_fst.token_counts(table(spark, sf_dir, "documents"))


@query("op9_bpe_codec")
def op9_bpe_codec(spark, sf_dir):
    return bpe_codec.digests(table(spark, sf_dir, "documents"))


# crc32 and xxhash64 (seed 42, of a long) spelled out; then profiles, ranks and distances as lists
OP2_SQL = rf"""
with recursive k(i, step, c) as (select i, 0, i from range(256) t(i) union all
    select i, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from k where step < 8),
crc as (select list(c order by i) as t from k where step = 8),
d as (select doc_id, lang, text, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])) as crc from documents, crc),
h as (select *, xor(crc, 4294967295) % 5 = 0 as held_out from d),
x0 as (select *, (((doc_id::uhugeint * 14029467366897019727) % 18446744073709551616)::uhugeint) as a from h),
x1 as (select *, ((((a << 31) % 18446744073709551616) | (a >> 33)) * 11400714785074694791) % 18446744073709551616 as b from x0),
x2 as (select *, xor(b::uhugeint, (42 + 2870177450012600261 + 8)::uhugeint) as c from x1),
x3 as (select *, (((((c << 27) % 18446744073709551616) | (c >> 37)) * 11400714785074694791) + 9650029242287828579) % 18446744073709551616 as e from x2),
x4 as (select *, (xor(e, e >> 33) * 14029467366897019727) % 18446744073709551616 as f from x3),
x5 as (select *, (xor(f, f >> 29) * 1609587929392839161) % 18446744073709551616 as g from x4),
x as (select doc_id, lang, text, held_out, (xor(g, g >> 32) % 1073741824)::double / 1073741824 as spot from x5),
sizes as (select lang, {langid.PER_LANGUAGE}::double / count(*) as share from x where not held_out and text is not null and lang is not null group by lang),
w as (select doc_id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) as w from x),
g as (select doc_id, unnest(list_concat(string_split(w, ''), list_concat(
    list_transform(range(1, length(w) + 2), lambda i: substr(' ' || w || ' ', i, 2)),
    list_transform(range(1, length(w) + 1), lambda i: substr(' ' || w || ' ', i, 3))))) as g from w),
n as (select doc_id, g, count(*) as n from g group by all),
own as (select doc_id, g, row_number() over (partition by doc_id order by n desc, length(g), g) - 1 as r from n
  qualify r < {langid.TOP}),
learned as (select x.lang, g, sum(n) as n from n join x using (doc_id) join sizes on sizes.lang = x.lang
  where not held_out and spot < share group by all),
profile as (select lang, g, row_number() over (partition by lang order by n desc, length(g), g) - 1 as r from learned qualify r < {langid.TOP}),
langs as (select distinct lang from profile),
apart as (select doc_id, langs.lang, sum(least(coalesce(abs(p.r - own.r), {langid.TOP}), {langid.TOP})) as apart, count(*) as size
  from own cross join langs left join profile p on p.lang = langs.lang and p.g = own.g group by all),
best as (select doc_id, min_by(lang, (apart, lang)) as lang_pred, 1 - min(apart) / ({langid.TOP} * max(size)) as score from apart group by doc_id)
select x.doc_id, held_out, coalesce(lang_pred, 'und') as lang_pred, coalesce(score, 0)::double as score from x left join best using (doc_id)
"""


@query("op2_language_id", OP2_SQL)
def op2_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def _counts_sql(k):
    """Table c of order ``k``: occurrences of 4-grams, else continuation counts."""
    count = ("select lang, g, count(*) as n from grams group by all" if k == 4
             else f"select lang, substr(g, 2) as g, count(*) as n from c{k + 1} group by all")
    return f"c{k} as materialized ({count}),\n"


def _kneser_ney_sql(k):
    """Tables of order ``k``: d (discounts a language), x (contexts), p (probabilities)."""
    first = ", ".join(f"count(*) filter (n = {j}) as n{j}" for j in range(1, 5))
    y = "(n1 / nullif(n1 + 2 * n2, 0))"
    cuts = ", ".join(f"least({j}, greatest(0.05, coalesce({j} - {j + 1} * {y} * n{j + 1} / nullif(n{j}, 0), {0.5 * j}))) as d{j}" for j in (1, 2, 3))
    below, lower = (f"(select lang, g, p as q from p{k - 1})", "gamma * q") if k > 1 else (None, "gamma / types")
    join = f" join {below} b on b.lang = e.lang and b.g = substr(e.g, 2)" if k > 1 else ""
    return f"""d{k} as (select lang, {cuts} from (select lang, {first} from c{k} group by lang)),
e{k} as (select c.lang, c.g, n, left(c.g, {k - 1}) as x, case n when 1 then d1 when 2 then d2 else d3 end as d from c{k} c join d{k} d on d.lang = c.lang),
x{k} as (select lang, x, sum(n) as total, sum(d) / sum(n) as gamma, count(*) as types from e{k} group by all),
p{k} as materialized (select e.lang, e.g, (n - d) / total + {lower} as p from e{k} e join x{k} x on x.lang = e.lang and x.x = e.x{join}),"""


OP8_SQL = rf"""
with t as (select doc_id, coalesce(lang, 'und') as lang, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, lang, list_concat([chr(1), chr(1), chr(1)], case when t = '' then [] else string_split(regexp_replace(t, '[\x09-\x0D]', ' ', 'g'), '') end) as s from t),
i as (select doc_id, lang, unnest(range(0, greatest(len(s) - 3, 0) // 200 + 1)) as i, s from s),
h as (select doc_id, lang, s[200 * i + 1:200 * i + 203] as s from i),
grams as materialized (select doc_id, lang, unnest(list_transform(range(1, len(s) - 2), lambda i: array_to_string(s[i:i + 3], ''))) as g from h),
{"".join(_counts_sql(k) for k in (4, 3, 2, 1))}{"".join(_kneser_ney_sql(k) for k in (1, 2, 3, 4))}
l as (select doc_id, r.lang, -avg(ln(p)) as l from grams r join p4 on p4.lang = r.lang and p4.g = r.g group by all),
q as (select lang, quantile_disc(l, 0.25) as a, quantile_disc(l, 0.75) as b from l group by lang),
v as (select doc_id, w, unnest(range(0, greatest(len(w) - 2, 0) // 100 + 1)) as c from t),
y as (select doc_id, c, w[100 * c + 1:100 * c + 102] as w from v),
z as (select doc_id, c, w, unnest(range(1, len(w) - 1)) as j from y),
u as (select doc_id, w[j:j + 2] as g, list(100 * c + j) as places from z group by all having count(*) > 1),
r as (select doc_id, count(distinct x) as n from (select doc_id, unnest([j, j + 1, j + 2]) as x from (select doc_id, unnest(places) as j from u)) group by doc_id),
n as (select doc_id, unnest(string_split(t, chr(10))) as line from t),
m as (select doc_id, count(*) - count(distinct line) as n from n where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
b as (select t.doc_id, t.lang, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(m.n, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words
  from t left join m using (doc_id) left join r using (doc_id)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from b)
select f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce(l between a - {quality_lm.SPREAD} * (q.b - a) and q.b + {quality_lm.SPREAD} * (q.b - a), false) as kept
from f left join l using (doc_id) left join q on q.lang = f.lang
"""


@query("op8_quality_rules", OP8_SQL)
def op8_quality_rules(spark, sf_dir):
    return quality_lm.assess(table(spark, sf_dir, "documents")).drop("log_ppl")


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    return toxicity.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


_TEMPLATES = ", ".join(f"({i}, {_quoted(label)}, {_quoted(text)})" for i, (label, text) in enumerate(licenses.TEMPLATES))
_PHRASES = ", ".join(f"({_quoted(p)}, {_quoted(label)})" for p, label in licenses.PHRASES.items())
_WORDS = rf"list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '{licenses.NO_WORD}', ' ', 'g'), ' '), lambda x: x <> '')"
OP6_SQL = rf"""
with d as (select doc_id, {_WORDS} as w from documents),
t as (select template, label, {_WORDS} as w from (values {_TEMPLATES}) as v(template, label, text)),
tg as (select template, label, len(w) as t_len, unnest(range(0, len(w) - {licenses.K} + 1)) as t_pos, w from t),
tk as (select template, label, t_len, t_pos, array_to_string(w[t_pos + 1:t_pos + {licenses.K}], ' ') as g from tg),
dg as (select doc_id, unnest(range(0, greatest(len(w) - {licenses.K} + 1, 0))) as pos, w from d),
dk as (select doc_id, pos, array_to_string(w[pos + 1:pos + {licenses.K}], ' ') as g from dg),
v as (select doc_id, template, label, t_len, pos - t_pos as diagonal, list(distinct t_pos) as places, min(pos) as lo, max(pos) as hi
  from dk join tk using (g) group by all),
m as (select *, coalesce(diagonal - lag(diagonal) over (partition by doc_id, template order by diagonal) > {licenses.GAP}, true)::int as fresh from v),
p as (select *, sum(fresh) over (partition by doc_id, template order by diagonal) as span from m),
s as (select doc_id, label, t_len, flatten(list(places)) as places, min(lo) as first, max(hi) + {licenses.K} - 1 as last from p group by doc_id, template, label, t_len, span),
c as (select doc_id, label, len(list_distinct(flatten(list_transform(places, lambda x: range(x, x + {licenses.K}))))) / greatest(t_len, last - first + 1) as score from s),
f as (select doc_id, list(distinct label) as found, max(score) as score, count(*) as n_spans from c where score >= {licenses.MIN_SCORE} group by doc_id),
b as (select doc_id, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1:i + len(string_split(phrase, ' '))] = string_split(phrase, ' '))) as spot
  from d, (values {_PHRASES}) as v(phrase, label)),
e as (select doc_id, count(*) as n_base, min(spot) as first_word, max(spot) as last_word, list(distinct label) as base from b group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(array_to_string(list_sort(base), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(found, [])))), ','), '') as labels,
  (case when n_base > 0 then 1 else least(coalesce(f.score, 0), 1) end)::double as score, coalesce(n_spans, 0) as n_spans
from d left join e using (doc_id) left join f using (doc_id)
"""


@query("op6_license_scan", OP6_SQL)
def op6_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op10_decontamination")
def op10_decontamination(spark, sf_dir):
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP1_SQL = """
with p as (select page_id, coalesce(html, '') as h, sha1(coalesce(html, '')) as x from pages),
f as (select x, min(page_id) as first from p group by x)
select page_id, cast(strlen(h) as bigint) as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast(((cast('0x' || substr(x, cast(5 * (i // 4) + 1 as int), 5) as bigint) >> cast(15 - 5 * (i % 4) as int)) & 31) + 1 as int), 1)), '')
    as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id = first then null else first end as refers_to
from p join f using (x)
"""


@query("op1_warc_index", OP1_SQL)
def op1_warc_index(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = rf"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') as w from documents),
c as (select doc_id, w, unnest(range(0, greatest(len(w) - 3, 0) // 100 + 1)) as c from w),
v as (select doc_id, w[100 * c + 1:100 * c + 102] as w from c),
s as (select distinct doc_id, unnest(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
  when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from v),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as common from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by all),
l as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * common >= 85 * (a.n + b.n - common)),
e as (select x, y from l union all select y, x from l),
r(doc_id, c) as (select doc_id, doc_id from documents union select e.y, r.c from r join e on e.x = r.doc_id)
select r.doc_id, coalesce(max(n), 0) as n_shingles, min(c) as component_id, r.doc_id = min(c) as kept from r left join n using (doc_id) group by r.doc_id
"""


@query("op5_near_duplicates", OP5_SQL)
def op5_near_duplicates(spark, sf_dir):
    return (minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
            .select("doc_id", "n_shingles", "component_id", "kept"))


# bytes as pairs of hexadecimal digits
OP4_SQL = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
p as (select doc_id, unnest(range(0, length(h) // 2 // 500 + 1)) as j, h from d),
q as (select doc_id, j, substr(h, 1000 * j + 1, 1098) as part from p),
s as (select doc_id, j, unnest(range(0, greatest(0, length(part) // 2 - 49))) as i, part from q),
w as (select doc_id, 500 * j + i as i, substr(part, 2 * i + 1, 100) as w from s),
f as (select w, min(doc_id) as first from w group by w having count(distinct doc_id) > 1),
b as (select w.doc_id, i from w join f using (w) where first < doc_id),
m as (select *, coalesce(i > lag(i) over (partition by doc_id order by i) + 50, true)::int as fresh from b),
g as (select *, sum(fresh) over (partition by doc_id order by i) as span from m),
r as (select doc_id, span, min(i) as a, max(i) + 50 as z from g group by doc_id, span),
c as (select doc_id, sum(z - a) as n_removed, count(*) as n_spans, list(struct_pack(a := a, z := z) order by a) as cuts from r group by doc_id),
k as (select d.doc_id, h, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, coalesce(cuts, []) as cuts from d left join c using (doc_id))
select doc_id, length(h) // 2 as n_bytes, n_removed, n_spans, sha256(unhex(array_to_string(list_transform(range(0, len(cuts) + 1), lambda j:
  substr(h, 2 * case when j = 0 then 0 else cuts[j].z end + 1,
    2 * (case when j = len(cuts) then length(h) // 2 else cuts[j + 1].a end - case when j = 0 then 0 else cuts[j].z end))), ''))) as kept_sha256
from k
"""


@query("op4_substring_dedup", OP4_SQL)
def op4_substring_dedup(spark, sf_dir):
    return (substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


OP11_SQL = r"""
with t as (select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from t),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
g as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) as g
  from w, (values (1), (2), (3), (4)) as k(k) where len(w) >= k),
n as (select lang, count(*) as n from g where k = 1 group by lang),
f as (select lang, k, g, array_to_string(g, ' ') as phrase, count(*) as f from g group by all having count(*) >= 30),
c as (select lang, g, phrase, k, f as a, unnest(range(1, k)) as c from f where k > 1),
s as (select c.lang, c.phrase, c.a, x.f as l, y.f as r, c.c, cast((2000000::hugeint * c.a) // (x.f + y.f) as bigint) as score
  from c join f x on x.lang = c.lang and x.phrase = array_to_string(c.g[1:c.c], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(c.g[c.c + 1:], ' ')),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, c) = 1),
i as (select lang, f, k, g, unnest(range(2, k)) as m from f where k > 2),
j as (select lang, f, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(g[i:i + m - 1], ' '))) as phrase from i),
o as (select lang, phrase, max(f) as longer from j group by all),
r as (select b.*, row_number() over (partition by b.lang order by b.score desc, b.a desc, b.phrase) as rank
  from b left join o on o.lang = b.lang and o.phrase = b.phrase where longer is null or 100 * longer < 80 * b.a)
select r.lang, rank, r.phrase, a, l, r, n, score from r join n on n.lang = r.lang where rank <= 2000
"""


@query("op11_phrase_mining", OP11_SQL)
def op11_phrase_mining(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents")).drop("first_doc")


OP12_SQL = r"""
with d as (select doc_id, source, case when text is null then 0 else len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) end as size,
    cast('0x' || substr(md5(concat_ws(' ', cast(doc_id as varchar), text)), 1, 15) as bigint) as place from documents),
s as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as no
  from d group by source),
w as (select *, [5, 2, 1][no % 3 + 1] as weight, 2 * source_size as cap from s),
o as (select *, row_number() over x as turn, sum(source_size) over () as total,
    coalesce(sum(cap) over (order by cap / weight, no rows between unbounded preceding and 1 preceding), 0) as before,
    sum(weight) over (order by cap / weight, no rows between current row and unbounded following) as rest
  from w window x as (order by cap / weight, no)),
v as (select turn as first, 3 * total - 2 * before as share, rest as among from o
  where cap::hugeint * 2 * rest > weight * (3 * total - 2 * before) order by turn limit 1),
g as (select o.*, cast(case when turn >= first then weight * share / (among * 2) else cap end as double) as target
  from o left join v on true),
q as (select doc_id, no, size, source_size, target, total as words,
    cast(sum(size) over (partition by no order by place, doc_id, size rows unbounded preceding) as bigint) as upto
  from d join g on d.source is not distinct from g.source where size > 0),
c as (select *, upto + round * source_size as place, (upto + round * source_size) / target as finish
  from q, (values (0), (1)) as r(round)),
t as (select *, sum(size) over (order by finish, no, place rows unbounded preceding) as served from c),
a as (select doc_id, no, upto, size, source_size, target, cast(sum(case when served <= (3 * words) // 2 then size else 0 end) as bigint) as taken
  from t group by all)
select doc_id, size, source_size, target, taken from a
union all select doc_id, size, source_size, target, 0 from d join g on d.source is not distinct from g.source where size = 0
"""


@query("op12_source_mixing", OP12_SQL)
def op12_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with recursive p(o) as (select '' union all select o || c from p, (values ('A'), ('B'), ('C'), ('D'), ('E')) as l(c) where not contains(o, c)),
s as (select o as filter_order, step, 1 << (ascii(substr(o, step, 1)) - 65) as own,
    coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(o, cast(i as int), 1)) - 65))), 0) as before
  from p, (values (1), (2), (3), (4), (5)) as k(step) where length(o) = 5),
d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    min(doc_id) over (partition by coalesce(text, '')) as first from documents),
m as (select part, (len(w) < 100)::int + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t))::int
    + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(first < d.doc_id, false)::int as mask,
    coalesce(quality = 1, false) as good, coalesce(toxic = 1, false) as toxic from d left join labels l on l.doc_id = d.doc_id),
n as (select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from m group by all),
r as (select part, filter_order, step, own,
    sum(case when mask & own = 0 and mask & before = 0 then n else 0 end) as kept,
    sum(case when mask & own > 0 and mask & before = 0 then n else 0 end) as removed,
    sum(case when mask & own > 0 and mask & before > 0 then n else 0 end) as redundant,
    sum(case when mask = own then n else 0 end) as unique_fails,
    sum(case when mask & own > 0 and mask & before = 0 then good else 0 end) as good_lost,
    sum(case when mask & own > 0 and mask & before = 0 then toxic else 0 end) as toxic_lost
  from n, s group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) over (partition by part, own) as shapley from r
"""


@query("op13_filter_audit", OP13_SQL)
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
