"""Registered queries of the corpus operators, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import decontam, dialog, langid, license, linededup, mixing, neardup, phrases, substring, tokenfile, topk, toxicity, warc
from ..plans.session import scratch_dir
from .storage import table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify_languages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.drop_repeated_windows(table(spark, sf_dir, "documents"), digest=True)


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_dir(spark, "token-shards")
    tokenfile.write_token_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return tokenfile.read_token_shards(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = mixing.mix_counts(table(spark, sf_dir, "documents"))
    return counts.select("doc_id", "size", "source_size", "target", "taken")


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.pages_through_warc(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_repeated_lines(table(spark, sf_dir, "documents"), digest=True)


def line_dedup_any_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_repeated_lines(table(spark, sf_dir, "documents"), min_lines=1, digest=True)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_collocations(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return dialog.repair_report(dialog.damage(rows), ids=rows)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license.scan_licenses(table(spark, sf_dir, "documents"))
    return found.drop("places")


# --- DuckDB ------------------------------------------------------------------

# the words of a text, a list of strings (SPACE is [\x20\x09-\x0D])
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLE_SUBSTRING = rf"""
with w as (select row_number() over () as rid, doc_id, {WORDS.format("coalesce(text, '')")} as w from documents),
win as (select rid, i, array_to_string(w[i:i + 34], ' ') as s from (select rid, w, unnest(range(1, len(w) - 33)) as i from w)),
rep as (select rid, i from (select rid, i, count(*) over (partition by s) as n from win) where n > 1),
cov as (select distinct rid, unnest(range(i, i + 35)) as p from rep),
pos as (select rid, unnest(w) as x, unnest(range(1, len(w) + 1)) as p from w),
kept as (select rid, string_agg(x, ' ' order by p) as t, count(*) as n from pos anti join cov using (rid, p) group by 1)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from w left join kept using (rid)
"""

ORACLE_MIXING = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size, ((row_number() over (order by encode(source) nulls last) - 1) % 3 + 1)::bigint as weight
  from d group by 1),
o as (select *, row_number() over (order by source_size / weight, source) as rn from s),
c as (select *, (select sum(source_size) from s) - coalesce(sum(3 * source_size) over (order by rn rows between unbounded preceding and 1 preceding), 0) as rest,
  sum(weight) over (order by rn rows between current row and unbounded following) as share from o),
k as (select rn, rest, share from c where weight * rest <= 3 * source_size * share order by rn limit 1),
t as (select o.source, o.source_size, case when k.rn is null or o.rn < k.rn then (3 * o.source_size)::double
  else k.rest::double * o.weight::double / k.share::double end as target from o left join k on true),
r as (select d.*, source_size, target, case when source_size > 0 then target / source_size else 0 end as rate,
  ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint / 4503599627370496.0::double as draw
  from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target, ((floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end) * size)::bigint as taken from r
"""

ORACLE_TOPK = """
with e as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::bigint as score
  from (select distinct vec_id, v from e where vec_id % 50 = 0) q join e c on c.vec_id <> q.vec_id and len(c.v) = len(q.v)),
r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s)
select * from r where rank <= 5
"""

ORACLE_WARC = """
with p as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages),
f as (select payload_digest, min(page_id) as first_id from p where payload_bytes >= 100 group by 1 having count(*) > 1)
select page_id, payload_bytes, payload_digest,
  case when first_id is not null and page_id is distinct from first_id then 'revisit' else 'response' end as record_type,
  case when page_id is distinct from first_id then first_id end as refers_to
from p left join f using (payload_digest)
"""

ORACLE_NEARDUP = rf"""
with recursive w as (
  select row_number() over () as id, doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w
  from documents),
s as (
  select distinct id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as sh from w),
n as (select id, count(*) as n from s group by 1),
p as (select a.id as a, b.id as b, count(*) as i from s a join s b on a.sh = b.sh and a.id < b.id group by 1, 2),
l as (select a, b from p join n x on x.id = a join n y on y.id = b where 100 * i >= 75 * (x.n + y.n - i)
  union select a.id, b.id from w a join w b on a.doc_id = b.doc_id and a.id < b.id),
e as (select a, b from l union all select b, a from l),
r as (select id as a, id as b from w union select r.a, e.b from r join e on r.b = e.a),
c as (select a, min(doc_id) as component_id from r join w on w.id = r.b group by 1)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.component_id, w.doc_id = c.component_id as kept
from w left join n using (id) join c on c.a = w.id
"""

ORACLE_LINES = r"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
x as (select doc_id, unnest(l) as s, unnest(range(1, len(l) + 1)) as p from d),
y as (select *, not regexp_full_match(s, '[\x20\x09-\x0D]*') as solid from x),
n as (select doc_id, s, p, row_number() over (partition by doc_id order by p) as i from y where solid),
w as (select doc_id, i, hash(s) as h0, s || chr(10) || lead(s) over o || chr(10) || lead(s, 2) over o as win from n
  window o as (partition by doc_id order by i)),
f as (select doc_id, i, row_number() over (partition by win order by doc_id, i) as k from w where win is not null),
g as (select distinct doc_id, unnest([i, i + 1, i + 2]) as i from f where k > 1),
z as (select y.doc_id, y.s, y.p, y.solid, g.i is not null as gone from y left join n using (doc_id, p) left join g on g.doc_id = n.doc_id and g.i = n.i)
select doc_id, count(*) filter (solid)::bigint as n_lines, count(*) filter (gone)::bigint as n_removed,
  sha256(coalesce(string_agg(s, chr(10) order by p) filter (not gone), '')) as kept_sha256
from z group by 1
"""

# the same with runs of one line on
ORACLE_LINES_ANY_RUN = r"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
x as (select doc_id, unnest(l) as s, unnest(range(1, len(l) + 1)) as p from d),
y as (select *, not regexp_full_match(s, '[\x20\x09-\x0D]*') as solid from x),
f as (select doc_id, p, row_number() over (partition by s order by doc_id, p) as k from y where solid),
z as (select y.doc_id, y.s, y.p, y.solid, coalesce(f.k > 1, false) as gone from y left join f using (doc_id, p))
select doc_id, count(*) filter (solid)::bigint as n_lines, count(*) filter (gone)::bigint as n_removed,
  sha256(coalesce(string_agg(s, chr(10) order by p) filter (not gone), '')) as kept_sha256
from z group by 1
"""

ORACLE_PHRASES = r"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as s from documents),
w as (select row_number() over () as id, lang, regexp_extract_all(s, '[^\x20\x09]+') as w from p),
t as (select id, lang, unnest(w) as w1, unnest(range(len(w))) as i from w),
o as (select lang, w1, lead(w1) over q as w2, lead(w1, 2) over q as w3 from t window q as (partition by id order by i)),
f1 as (select lang, w1 as ph, count(*)::hugeint as f from o group by all),
f2 as (select lang, w1, w2, w1 || ' ' || w2 as ph, count(*)::hugeint as f from o where w2 is not null group by all),
f3 as (select lang, w1, w2, w3, w1 || ' ' || w2 || ' ' || w3 as ph, count(*)::hugeint as f from o where w3 is not null group by all having count(*) >= 10),
n as (select lang, sum(f)::bigint as n from f1 group by 1),
c as (
  select x.lang, x.ph, x.f as a, 1 as cut, u.f as l, v.f as r from f2 x
    join f1 u on u.lang = x.lang and u.ph = x.w1 join f1 v on v.lang = x.lang and v.ph = x.w2 where x.f >= 10
  union all select x.lang, x.ph, x.f, 1, u.f, v.f from f3 x
    join f1 u on u.lang = x.lang and u.ph = x.w1 join f2 v on v.lang = x.lang and v.w1 = x.w2 and v.w2 = x.w3
  union all select x.lang, x.ph, x.f, 2, u.f, v.f from f3 x
    join f2 u on u.lang = x.lang and u.w1 = x.w1 and u.w2 = x.w2 join f1 v on v.lang = x.lang and v.ph = x.w3),
s as (select *, (1000000::hugeint * a * a) // (l * r) as score from c),
b as (select * from s qualify row_number() over (partition by lang, ph order by score, cut) = 1),
m as (select lang, ph, max(f) as most from (select lang, w1 || ' ' || w2 as ph, f from f3 union all select lang, w2 || ' ' || w3, f from f3) group by all)
select lang, row_number() over (partition by lang order by score desc, a desc, encode(ph)) as rank,
  ph as phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
from b join n using (lang) left join m using (lang, ph) where most is null or 100 * most < 50 * a
qualify rank <= 2000
"""


def _conversation_oracle() -> str:
    """Cheapest edits by a step per row: for each state the least string of
    cost, in nine digits, and edits."""

    def add(v: str, cost: str, edit: str) -> str:
        return f"lpad((substr({v}, 1, 9)::int + {cost})::varchar, 9, '0') || substr({v}, 10) || '{edit}'"

    def keep(v: str, initial: str) -> str:
        return f"case when not must_go and initial = '{initial}' then {add(v, 'more', 'K')} end"

    def rerole(v: str) -> str:
        return f"case when not must_go then {add(v, '1 + more', 'R')} end"

    inserted = f"least(v2, {add('v0', '5', 'I')}, {add('v1', '5', 'I')}, {add('v3', '5', 'I')}) as u2, least(v3, {add('v2', '5', 'I')}) as u3"
    return rf"""
with recursive tab as (
  select list(c order by i) as t from (select i, list_reduce(range(0, 8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), i) as c from range(0, 256) x(i))),
src as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 as fault
  from conversations, tab),
d as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
    case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from (select *, unnest(case when fault = 3 then [1, 2] else [1] end) from src where fault <> 0)),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from d),
m as (select *, not regexp_matches(text, '[^ 	-
]') as blank, row_number() over (partition by conv_id, role, text order by i) > 1 as again,
  substr(role, 1, 1) as initial, lag(substr(role, 1, 1)) over (partition by conv_id order by i) as before,
  regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) not in ('.', '!', '?') as cut from o),
w as (select conv_id, i, role, text, initial, blank or again as must_go, case when cut and not blank and not again then 5 else 0 end as more from m),
e as (select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) filter (blank) as blank,
  count(*) filter (again and not blank) as duplicate, count(*) filter (cut and not blank and not again) as truncated,
  count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal, count(*) as n from m group by 1),
r as (
  select conv_id, 0::bigint as i, '000000000' as v0, null::varchar as v1, null::varchar as v2, null::varchar as v3 from e
  union all
  select q.conv_id, w.i, {add("v0", "2", "D")}, least({add("v1", "2", "D")}, {keep("v0", "s")}),
    least({add("u2", "2", "D")}, {keep("v0", "u")}, {keep("v1", "u")}, {keep("u3", "u")}, {rerole("v0")}, {rerole("v1")}, {rerole("u3")}),
    least({add("u3", "2", "D")}, {keep("u2", "a")}, {rerole("u2")})
  from (select *, {inserted} from r) q join w on w.conv_id is not distinct from q.conv_id and w.i = q.i + 1),
f as (select conv_id, least(v0, u3) as v from (select r.*, {inserted} from r join e on e.conv_id is not distinct from r.conv_id and e.n = r.i)),
a as (select conv_id, substr(v, 1, 9)::bigint as cost, substr(v, 10) as audit from f),
c as (select conv_id, unnest(string_split(audit, '')) as c, unnest(range(1, len(audit) + 1)) as p from a where audit <> ''),
j as (select *, count(*) filter (c <> 'I') over (partition by conv_id order by p) as i, count(*) filter (c <> 'D') over (partition by conv_id order by p) as k,
  count(*) filter (c <> 'D') over (partition by conv_id) % 2 as odd from c),
t as (select j.conv_id, p, case when c = 'K' then role when (k - odd) % 2 = 1 then 'user' else 'assistant' end || ':' || case when c = 'I' then '' else text end as line
  from j join w on w.conv_id is not distinct from j.conv_id and w.i = greatest(j.i, 1) where c <> 'D'),
h as (select conv_id, string_agg(line, chr(10) order by p) as whole from t group by 1)
select x.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost,
  coalesce(audit, '') as audit, sha256(coalesce(whole, '')) as repaired_sha256
from (select distinct conv_id from conversations) x left join e on e.conv_id is not distinct from x.conv_id
  left join a on a.conv_id is not distinct from x.conv_id left join h on h.conv_id is not distinct from x.conv_id
"""


def _license_oracle() -> str:
    """Base phrases and templates as tables of words, joined by position."""
    words = [(t, j, w) for t, (_, text, _) in enumerate(license.TEMPLATES) for j, w in enumerate(text.split())]
    keys = [(t, k, j, w) for t, (_, _, ms) in enumerate(license.TEMPLATES) for k, m in enumerate(ms) for j, w in enumerate(m.split())]
    base = [(label, j, w) for p, label in license.BASE_PHRASES.items() for j, w in enumerate(p.split())]
    values = lambda rows: ", ".join(str(r) for r in rows)
    labels = [(t, label) for t, (label, _, _) in enumerate(license.TEMPLATES)]
    return rf"""
with t(t, j, w) as (values {values(words)}), m(t, k, j, w) as (values {values(keys)}), b(label, j, w) as (values {values(base)}),
lab(t, label) as (values {values(labels)}), tn as (select t, count(*) as len from t group by 1),
mn as (select t, k, count(*) as len from m group by all), mc as (select t, count(*) as nk from mn group by 1), bn as (select label, count(*) as len from b group by 1),
d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
x as (select r, i, w from (select r, unnest(ws) as w, unnest(range(len(ws))) as i from d) semi join (select w from t union select w from m union select w from b) using (w)),
f as (select w, count(distinct r) as df from x group by 1),
p as (select r, label, i - j as s from x join b using (w) join bn using (label) group by r, label, i - j, len having count(*) = len),
pr as (select r, count(*) as n_base, min(s) as first_word, max(s) as last_word from p group by 1),
rare as (select r, t, w from (select distinct r, t, w from x join t using (w)) join f using (w)
  qualify row_number() over (partition by r, t order by df, encode(w)) <= {license.RARE_WORDS}),
c as (select r, t, i - j as s from rare join x using (r, w) join t using (t, w) group by all having count(distinct w) >= {license.AGREE}),
v as (select r, t, s, len, count(*) / len as share from c join t using (t) join tn using (t) join x using (r, w) where x.i = s + t.j
  group by r, t, s, len having count(*) / len >= {license.IN_PLACE}),
k as (select r, t, k, i - j as q from x join m using (w) join mn using (t, k) group by r, t, k, i - j, mn.len having count(*) = mn.len),
y as (select v.r, v.t, v.s, share from v join k on k.r = v.r and k.t = v.t join mn on mn.t = k.t and mn.k = k.k join mc on mc.t = v.t
  where k.q >= v.s and k.q + mn.len <= v.s + v.len group by v.r, v.t, v.s, share, nk having count(distinct k.k) = nk),
l as (select r, label, true as base, 1.0::double as share from p union all select r, label, false, share from y join lab using (t)),
g as (select r, string_agg(distinct label, ',' order by label) filter (base) as base_labels, string_agg(distinct label, ',' order by label) as labels, max(share) as score from l group by 1)
select doc_id, len(ws)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from d left join pr using (r) left join g using (r)
"""


def build_queries() -> dict[str, QueryFn]:
    return {
        "op1_language_id": op1_language_id,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_token_ids": op3_token_ids,
        "op4_decontamination": op4_decontamination,
        "op5_toxicity": op5_toxicity,
        "op6_mixing": op6_mixing,
        "op7_topk_search": op7_topk_search,
        "op8_warc": op8_warc,
        "op9_minhash_neardup": op9_minhash_neardup,
        "op10_line_dedup": op10_line_dedup,
        "line_dedup_any_run": line_dedup_any_run,
        "op11_collocations": op11_collocations,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_license_scan": op13_license_scan,
        "pipeline": corpus_pipeline.run,
    }


def build_oracle() -> dict[str, str]:
    return {
        "op2_substring_dedup": ORACLE_SUBSTRING,
        "op6_mixing": ORACLE_MIXING,
        "op7_topk_search": ORACLE_TOPK,
        "op8_warc": ORACLE_WARC,
        "op9_minhash_neardup": ORACLE_NEARDUP,
        "op10_line_dedup": ORACLE_LINES,
        "line_dedup_any_run": ORACLE_LINES_ANY_RUN,
        "op11_collocations": ORACLE_PHRASES,
        "op12_conversation_repair": _conversation_oracle(),
        "op13_license_scan": _license_oracle(),
    }
