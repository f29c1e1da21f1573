"""DuckDB SQL for the operators that SQL can express, over the plain tables."""

from __future__ import annotations

from . import fixity, license, mixing, quality, trie, winnowing

_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _quality() -> str:
    levels = {"own": "lang, source, signal", "by_lang": "lang, signal", "by_all": "signal"}
    quart = ",\n".join(
        f"""{name} as (select {keys}, min(edge) filter (4 * cum >= total) as q25, min(edge) filter (4 * cum >= 3 * total) as q75, max(total) as total
  from (select {keys}, edge, sum(n) over (partition by {keys} order by edge rows unbounded preceding) as cum, sum(n) over (partition by {keys}) as total
        from (select {keys}, edge, sum(n) as n from sketch group by all))
  group by {keys})"""
        for name, keys in levels.items()
    )
    signals = " union all ".join(f"select lang, source, '{s}' as signal, s_{s} as x from signals where not base_failed" for s in quality.SIGNALS)
    limits = []
    tests = []
    for s, (side, slack) in quality.SIGNALS.items():
        limits.append(f"max(q75 + {quality.FENCE} * (q75 - q25) + {slack}) filter (signal = '{s}') as hi_{s}")
        tests.append(f"s_{s} <= hi_{s}")
        if side == "both":
            limits.append(f"max(q25 - {quality.FENCE} * (q75 - q25) - {slack}) filter (signal = '{s}') as lo_{s}")
            tests.append(f"s_{s} >= lo_{s}")
    return rf"""
with texts as (select doc_id, lang, source, coalesce(text, '') as t from documents),
words as (select *, {_WORDS.format(text="t")} as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from texts),
grams as (select doc_id, i, w[i] as a, w[i + 1] as b, w[i + 2] as c from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from words)),
repeated as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from grams) where n > 1),
covered as (select doc_id, count(distinct i + k) as n from repeated, (select unnest([0, 1, 2]) as k) group by doc_id),
base as (
  select doc_id, lang, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, len(l)::bigint as n_lines, coalesce(n, 0)::bigint as n_repeat_words
  from words left join covered using (doc_id)),
signals as (
  select *, n_words < {quality.FAILED_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed,
    case when word_chars > 0 then 1000 * n_symbols // word_chars else 0 end as s_symbols,
    case when n_words > 0 then 1000 * n_repeat_words // n_words else 0 end as s_repeats,
    case when n_lines > 0 then 1000 * n_dup_lines // n_lines else 0 end as s_dup_lines,
    case when n_words > 0 then 10 * word_chars // n_words else 0 end as s_word_len
  from base),
sketch as (
  select lang, source, signal, (x >> greatest(length(bin(x)) - 5, 0)) << greatest(length(bin(x)) - 5, 0) as edge, count(*) as n
  from ({signals}) group by all),
{quart},
chosen as (
  select o.lang, o.source, o.signal,
    case when o.total >= {quality.MIN_GROUP} then o.q25 when l.total >= {quality.MIN_GROUP} then l.q25 else a.q25 end as q25,
    case when o.total >= {quality.MIN_GROUP} then o.q75 when l.total >= {quality.MIN_GROUP} then l.q75 else a.q75 end as q75
  from own o join by_lang l on o.lang is not distinct from l.lang and o.signal = l.signal join by_all a on o.signal = a.signal),
limits as (select lang, source, {", ".join(limits)} from chosen group by lang, source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce({" and ".join(tests)}, false) as kept
from signals s left join limits m on s.lang is not distinct from m.lang and s.source is not distinct from m.source
"""


TOP_K = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from vectors q join vectors c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

JACCARD = rf"""
with recursive words as (
  select doc_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents),
grams as (
  select distinct doc_id, array_to_string(w[i:least(i + 4, len(w))], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*)::bigint as n from grams group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id group by all),
links as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * shared >= 80 * (x.n + y.n - shared)),
reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on r.b = l.a)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, coalesce(n_links, 0)::bigint as n_links
from documents d left join sizes using (doc_id) join (select a as doc_id, min(b) as component_id from reach group by a) using (doc_id)
left join (select a as doc_id, count(*) as n_links from links group by a) using (doc_id)
"""

SUBSTRINGS = rf"""
with words as (select doc_id, {_WORDS.format(text="coalesce(text, '')")} as w from documents),
grams as (
  select doc_id, i, array_to_string(w[i:i + 19], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from words where len(w) >= 20)),
repeats as (select doc_id, i from (select doc_id, i, row_number() over (partition by g order by doc_id, i) as r from grams) where r > 1),
gone as (select distinct doc_id, i + k as i from repeats, (select unnest(range(0, 20)) as k)),
placed as (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as i from words),
kept as (select doc_id, string_agg(x, ' ' order by i) as t from placed anti join gone using (doc_id, i) group by doc_id),
lost as (select doc_id, count(*)::bigint as n from gone group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from words left join kept using (doc_id) left join lost using (doc_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _license() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    base = ", ".join(f"({p.split()!r}, {label!r})" for p, label in license.BASE.items())
    parts = ", ".join(f"({i}, {label!r}, {sorted(set(t.split()))!r}, {sorted(license.TELLING.get(label, ())) or ['']!r}, {len(license.TELLING.get(label, ()))})" for i, (label, t) in enumerate(license.TEMPLATES))
    return f"""
with texts as (select doc_id, {_LOWER} as t from documents),
words as (select doc_id, regexp_extract_all(t, '{word}') as w from texts),
phrases(p, label) as (values {base}),
placed as (select doc_id, w, unnest(range(0, len(w))) as i from words),
found as (select doc_id, i, label from placed join phrases on w[i + 1:i + len(p)] = p),
base as (select doc_id, count(*)::bigint as n_base, min(i)::bigint as first_word, max(i)::bigint as last_word, list_distinct(list(label)) as l from found group by doc_id),
lines as (select doc_id, n, regexp_extract_all(line, '{word}') as w from (select doc_id, unnest(string_split(t, chr(10))) as line, unnest(range(0, len(string_split(t, chr(10))))) as n from texts)),
pieces as (
  select distinct doc_id, n, (i // {license.STRIDE}) - k as piece, x
  from (select doc_id, n, unnest(w) as x, unnest(range(0, len(w))) as i from lines), (select unnest([0, 1]) as k) where i // {license.STRIDE} >= k),
templates(id, label, w, telling, n_telling) as (values {parts}),
vocabulary as (select id, label, len(w) as m, telling, n_telling, unnest(w) as x from templates),
common as (
  select doc_id, label, m, count(*) as c from pieces join vocabulary using (x) group by doc_id, n, piece, id, label, m, n_telling
  having 100 * count(*) >= {license.PERCENT} * m and count(*) filter (where list_contains(telling, x)) = n_telling),
method as (select doc_id, list_distinct(list(label)) as l, max(c / m) as score from common group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.l), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.l, []), coalesce(method.l, [])))), ','), '') as labels,
  coalesce(score, 0.0)::double as score
from words left join base using (doc_id) left join method using (doc_id)
"""


def _mixing(seed: int = 9) -> str:
    steps = []
    last = "start"
    for r in range(mixing.ROUNDS):
        for c in mixing.DIMENSIONS:
            steps.append(f"r{r}{c} as (select source, lang, topic, tokens, t_source, t_lang, t_topic, w * t_{c} / sum(w) over (partition by {c}) as w from {last})")
            last = f"r{r}{c}"
    shares = ",\n".join(f"share_{c} as (select {c}, p / sum(p) over () as t_{c} from (select {c}, pow(sum(tokens)::double, {mixing.TEMPER}) as p from cells where tokens > 0 group by {c}))" for c in mixing.DIMENSIONS)
    return rf"""
with words as (select doc_id, coalesce(source, '{mixing.NONE}') as source, coalesce(lang, '{mixing.NONE}') as lang, {_WORDS.format(text="coalesce(text, '')")} as w from documents),
counted as (select x, count(*) as n from (select unnest(list_distinct(w)) as x from words) where length(x) >= {mixing.LONG} group by x),
leaders as (select x, row_number() over (order by n desc, x) as place from counted qualify place <= {mixing.TOPICS}),
held as (select doc_id, x, place, count(*) as n from (select doc_id, unnest(w) as x from words) join leaders using (x) group by all),
topics as (select doc_id, x as topic from held qualify row_number() over (partition by doc_id order by n desc, place) = 1),
docs as (select doc_id, source, lang, coalesce(topic, '{mixing.NONE}') as topic, len(w)::bigint as n_words from words left join topics using (doc_id)),
cells as (select source, lang, topic, sum(n_words)::bigint as tokens from docs group by all),
{shares},
start as (select c.*, t_source, t_lang, t_topic, tokens::double as w from cells c join share_source using (source) join share_lang using (lang) join share_topic using (topic) where tokens > 0),
{(","+chr(10)).join(steps)},
scaled as (
  select *, ({mixing.KEEP} * sum(tokens) over () - coalesce(sum(tokens) over (order by w / tokens desc, source, lang, topic rows between unbounded preceding and 1 preceding), 0))
    / sum(w) over (order by w / tokens desc, source, lang, topic rows between current row and unbounded following) as s
  from {last}),
fitted as (select source, lang, topic, round(least(1.0, max(s) over () * (w / tokens)), 9) as p from scaled),
chosen as (select doc_id, topic, n_words, coalesce(p, 1.0) as p from docs left join fitted using (source, lang, topic))
select doc_id, topic, n_words, round(p, 6) as probability,
  ('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || ':{seed}'), 1, 13))::bigint::double / 4503599627370496.0 < p as kept
from chosen
"""


FIXITY = f"""
with records as (
  select page_id, coalesce(url, '') as url,
    ('0x' || substr(md5(coalesce(page_id::varchar, '') || ' ' || coalesce(url, '')), 1, 8))::bigint % greatest(1, ((select count(*) from pages) + {fixity.FILE_RECORDS - 1}) // {fixity.FILE_RECORDS}) as file,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::varchar, '') || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) as record
  from pages),
short as (select page_id, url, file, strlen(record)::bigint as length, sha256(record) as record_sha256 from records),
placed as (select *, row_number() over (partition by file order by page_id nulls first, url, length, record_sha256) - 1 as position from short)
select page_id, file::bigint as file, position::bigint as position,
  coalesce(sum(length) over (partition by file order by position rows between unbounded preceding and 1 preceding), 0)::bigint as offset, length, record_sha256,
  case when page_id % {fixity.DAMAGED} = 0 then 'corrupt' else 'ok' end as status
from placed
"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

CONTAMINATION = rf"""
with items as (select item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') as w from benchmark where item_id is not null),
held as (
  select distinct item_id, t, array_to_string(w[i:i + t - 1], ' ') as g
  from (select item_id, w, least(len(w), {winnowing.SPAN}) as t, unnest(range(1, greatest(len(w) - {winnowing.SPAN}, 0) + 2)) as i from items where len(w) > 0)),
words as (select doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') as w from documents),
windows as (
  select doc_id, t, i, array_to_string(w[i:i + t - 1], ' ') as g
  from (select doc_id, w, t, unnest(range(1, len(w) - t + 2)) as i from words, (select distinct t from held) where len(w) >= t)),
hits as (select doc_id, t, i, item_id from windows join held using (t, g)),
gone as (select doc_id, count(distinct i + k)::bigint as n_hit from (select doc_id, i, unnest(range(0, t)) as k from hits) group by doc_id),
found as (select doc_id, count(*)::bigint as n_items, sha256(string_agg(x, ',' order by x)) as h from (select distinct doc_id, item_id::varchar as x from hits) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  coalesce(h, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join gone using (doc_id) left join found using (doc_id)
"""

NEGATIVES = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from rows a join rows c on a.vec_id <> c.vec_id where a.vec_id % 50 = 0),
positives as (select anchor_id, vec_id as positive_id, score as positive_score from scored where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank, vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
"""

_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::bigint], flatten(list_transform(range(1, strlen({c}) + 1), lambda i: [ascii(substr({c}, i, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, case when a & 1 = 1 then 3988292384 else 0 end) end))"""

TRIE = f"""
with turns as (
  select conv_id, coalesce(role, '') as r, coalesce(text, '') as x,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as p
  from conversations where conv_id is not null),
convs as (select conv_id, count(*) as n, {_CRC32.format(c="conv_id::varchar")} % {trie.SHARED + 1} as h from turns group by conv_id),
heads as (select c.conv_id, r, x, p from convs c join turns t on t.conv_id = c.conv_id - c.conv_id % 100 where p <= h),
built as (select * from heads union all select t.conv_id, r, x, 1000000000 + p from turns t join convs c on t.conv_id = c.conv_id where p > h),
seqs as (select conv_id, coalesce(s, []) as s from convs left join (select conv_id, list(struct_pack(r := r, x := x) order by p) as s from built group by conv_id) using (conv_id)),
passed as (select conv_id, s, unnest(range(0, len(s) + 1)) as d from seqs),
nodes as (
  select d, s[1:d] as pre, min(conv_id) as conv_id, count(*) as n_convs, case when d > 0 then length(any_value(s[d].x)) else 0 end as size,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(s) = d), '')) as ends_sha256
  from passed group by d, s[1:d]),
children as (select d - 1 as d, pre[1:d - 1] as pre, count(*) as n_children from nodes where d > 0 group by all),
own as (select n.*, coalesce(n_children, 0) as n_children from nodes n left join children using (d, pre)),
below as (
  select u as d, pre[1:u] as pre, count(*) filter (n_children = 0) as n_leaves, sum((n_convs - 1) * size) as saved_tokens
  from (select *, unnest(range(0, d + 1)) as u from own) group by all)
select n.conv_id::bigint as conv_id, n.d::bigint as depth, u.conv_id::bigint as parent_conv_id, n.n_convs::bigint as n_convs, n.n_children::bigint as n_children,
  n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, n.ends_sha256
from own n join below using (d, pre) left join nodes u on u.d = n.d - 1 and u.pre = n.pre[1:n.d - 1]
"""

SQL = {"op12_hard_negatives": NEGATIVES, "op13_conversation_trie": TRIE, "op11_benchmark_decontamination": CONTAMINATION, "op7_warc_fixity": FIXITY, "op9_source_mixing": _mixing(), "op6_license_scan": _license(), "op5_substring_dedup": SUBSTRINGS, "op3_jaccard_join": JACCARD, "op1_quality_rules": _quality(), "op10_exact_top_k": TOP_K}
