"""Independent SQL, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

from foliograph.llm.chat_tree import END, TEXT, TURN
from foliograph.llm.license_scan import RULES, SENTENCES, SPDX_PAIR, SPDX_WORDS, absent, licence, pattern

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_RULES = rf"""
with d as (select doc_id, source, coalesce(text, '') t, {WORDS} w from documents),
wins as (
  select doc_id, i, array_to_string(w[i:i + 7], ' ') k
  from (select doc_id, w, unnest(range(1, len(w) - 6)) i from d where len(w) >= 8)),
again as (select doc_id, i from (select *, count(*) over (partition by doc_id, k) c from wins) where c > 1),
rep as (
  select doc_id, count(distinct p) n from (select doc_id, unnest(range(i, i + 8)) p from again) group by 1),
lines as (
  select doc_id, source, t, unnest(string_split(t, chr(10))) l, generate_subscripts(string_split(t, chr(10)), 1) pos
  from d),
worded as (
  select *, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) n,
         trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') line
  from lines where regexp_matches(l, '[^\x20\x09-\x0D]')),
dup as (select doc_id, count(*) - count(distinct l) n from worded group by 1),
hosts as (select source, count(distinct t) documents from d group by 1),
freq as (
  select source, line from (select source, line, count(distinct t) h from worded group by 1, 2) join hosts using (source)
  where h > 20 and h > 0.01 * documents),
gone as (select doc_id, sum(n) n from worded semi join freq using (source, line) group by 1),
base as (
  select d.doc_id, cast(len(w) as bigint) n_words, cast(length(array_to_string(w, '')) as bigint) word_chars,
         cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) n_symbols,
         cast(coalesce(dup.n, 0) as bigint) n_dup_lines, cast(coalesce(rep.n, 0) as bigint) n_repeat_words,
         cast(coalesce(gone.n, 0) as bigint) n_removed_words
  from d left join dup using (doc_id) left join rep using (doc_id) left join gone using (doc_id)),
f as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed from base)
select *, not base_failed and n_words - n_removed_words >= 0.5 * n_words as kept from f
"""

CHAT_TREE = rf"""
with c as (
  select conv_id, turn, coalesce(role, '') r, coalesce(text, '') t from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (
  select *, len(regexp_extract_all(r || t, '[\\<\[]')) extra from c)
select conv_id, count(*) n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn, r, t)) turns_sha256,
  cast(coalesce(sum(length(t)) filter (r = 'assistant'), 0) as bigint) loss_chars,
  sha256(coalesce(string_agg(t, '' order by turn, r, t) filter (r = 'assistant'), '')) loss_sha256,
  cast(sum(length(r) + length(t) + extra + {len(TURN) + len(TEXT) + len(END)}) as bigint) formatted_chars
from e group by conv_id
"""

SUBSTRING_DEDUP = rf"""
with d as (select doc_id, {WORDS} w from documents),
wins as (
  select doc_id, i, array_to_string(w[i:i + 34], ' ') k
  from (select doc_id, w, unnest(range(1, len(w) - 33)) i from d where len(w) >= 35)),
again as (select k from wins group by k having count(*) > 1),
gone as (select distinct doc_id, unnest(range(i, i + 35)) p from wins semi join again using (k)),
words as (select doc_id, unnest(w) x, generate_subscripts(w, 1) p from d),
kept as (select doc_id, string_agg(x, ' ' order by p) s, count(*) n from words anti join gone using (doc_id, p) group by 1)
select doc_id, cast(len(w) as bigint) n_words, cast(len(w) - coalesce(n, 0) as bigint) n_removed,
  sha256(coalesce(s, '')) kept_sha256
from d left join kept using (doc_id)
"""

TOP_K = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
q as (select * from v where vec_id % 50 = 0),
s as (
  select q.vec_id query_id, v.vec_id vec_id,
         cast(list_sum(list_transform(range(1, len(v.v) + 1), lambda i: q.v[i] * v.v[i])) as bigint) score
  from q join v on q.vec_id <> v.vec_id and len(q.v) = len(v.v)),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) "rank" from s)
select query_id, "rank", vec_id, score from r where "rank" <= 5
"""


def _license_scan() -> str:
    known = ", ".join(f"('{s}', '{i}')" for i, s in SENTENCES.items())
    rules = ", ".join(
        f"({n}, '{licence(name)}', '{pattern(seq)}', [{', '.join(repr(x) for x in absent(seq))}]::varchar[])"
        for n, (name, seq) in enumerate(RULES.items())
    )
    t = f"regexp_replace(coalesce(text, ''), '{SPDX_WORDS[0]}', '{SPDX_WORDS[1]}', 'g')"
    pair = SPDX_PAIR[1].replace("$", "\\").replace("\n", "' || chr(10) || '")
    for _ in range(2):
        t = f"regexp_replace({t}, '{SPDX_PAIR[0]}', '{pair}', 'g')"
    return rf"""
with known(sentence, known) as (values {known}),
rules(n, licence, pattern, absent) as (values {rules}),
p as (
  select doc_id, unnest(x) s, generate_subscripts(x, 1) pos
  from (select doc_id, regexp_split_to_array(regexp_replace({t}, '[.!?;:]+([ \t\r\n]|$)', chr(10), 'g'), '\n') x
        from documents)),
s as (
  select doc_id, pos, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'), ' ') sentence from p
  where regexp_matches(s, '[a-zA-Z0-9]')),
n as (select doc_id, count(*) n from s group by 1),
f as (select doc_id, string_agg(known, ',' order by pos) ids from s join known using (sentence) group by 1),
r as (
  select doc_id, licence, min(n) n from f join rules
    on regexp_matches(',' || ids || ',', pattern) and len(list_filter(absent, lambda a: contains(',' || ids || ',', ',' || a || ','))) = 0
  group by 1, 2),
m as (select doc_id, string_agg(licence, ',' order by n) licenses, arg_min(licence, n) license from r group by 1)
select doc_id, cast(coalesce(n, 0) as bigint) n_sentences, coalesce(ids, '') sentence_ids,
  coalesce(licenses, '') licenses, license
from documents left join n using (doc_id) left join f using (doc_id) left join m using (doc_id)
"""


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERMS = rf"regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
with i as (select item_id, {TERMS} w from benchmark),
wins as (
  select item_id, 10 m, array_to_string(w[p:p + 9], ' ') k
  from (select item_id, w, unnest(range(1, len(w) - 8)) p from i where len(w) >= 10)
  union select item_id, len(w), array_to_string(w, ' ') from i where len(w) between 1 and 9),
d as (select doc_id, {TERMS} w from documents),
places as (
  select doc_id, m, p, array_to_string(w[p:p + m - 1], ' ') k
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) p from d join (select distinct m from wins) on len(w) >= m)),
found as (select doc_id, m, p, item_id from places join wins using (m, k)),
words as (
  select doc_id, count(distinct x) n from (select doc_id, unnest(range(p, p + m)) x from (select distinct doc_id, p, m from found))
  group by 1),
named as (
  select doc_id, count(*) n, string_agg(i, ',' order by i) ids
  from (select distinct doc_id, cast(item_id as varchar) i from found) group by 1)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(words.n, 0) as bigint) n_hit,
  cast(coalesce(named.n, 0) as bigint) n_items, sha256(coalesce(ids, '')) items_sha256,
  coalesce(words.n, 0) > 0 contaminated
from d left join words using (doc_id) left join named using (doc_id)
"""

LEXICAL_SEARCH = f"""
with d as (select doc_id, {TERMS} w from documents),
t as (select doc_id, x, count(*) tf from (select doc_id, unnest(w) x from d) group by 1, 2),
c as (select count(*) n, cast(sum(len(w)) as bigint) l from d where len(w) > 0),
f as (select x, cast(floor(1000 * ln((2 * any_value(c.n) + 2) / (2 * count(*) + 1))) as bigint) weight from t, c group by 1),
m as (select doc_id, 75 + (25 * len(w) * c.n) // c.l m from d, c),
q as (select item_id, x, count(*) times from (select item_id, unnest({TERMS}) x from benchmark) group by 1, 2),
s as (
  select item_id, doc_id, cast(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) score
  from q join f using (x) join t using (x) join m using (doc_id) group by 1, 2),
r as (select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) "rank" from s where score > 0)
select item_id, "rank", doc_id, score from r where "rank" <= 20
"""


ORACLES = {
    "op1_quality_rules": QUALITY_RULES,
    "op2_chat_tree": CHAT_TREE,
    "op4_substring_dedup": SUBSTRING_DEDUP,
    "op6_top_k": TOP_K,
    "op8_license_scan": _license_scan(),
    "op12_decontamination": DECONTAMINATION,
    "op13_lexical_search": LEXICAL_SEARCH,
}
