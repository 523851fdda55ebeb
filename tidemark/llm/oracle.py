"""Independent SQL for the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.licenses import TEMPLATES, THRESHOLD

# Every pair that shares a shingle is counted, and labels spread along the links.
_JACCARD = """
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) end as s
  from words),
keyed as (select doc_id, list_sort(s) as s, len(s) as n from sets),
classes as (select s, n, min(doc_id) as rep from keyed where n > 0 group by s, n),
tokens as (select rep, n, unnest(s) as token from classes),
shared as (
  select a.rep as a, b.rep as b from tokens a join tokens b on a.token = b.token and a.rep < b.rep
  group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
both_ways as (select a, b from shared union all select b, a from shared),
reach(node, low) as (
  select rep, rep from classes
  union
  select e.b, r.low from reach r join both_ways e on e.a = r.node where r.low < e.b),
lowest as (select node, min(low) as low from reach group by node)
select k.doc_id, cast(k.n as bigint) as n_shingles, coalesce(l.low, k.doc_id) as component_id
from keyed k left join classes c on c.s = k.s left join lowest l on l.node = c.rep
"""

def _marked(column: str, name: str) -> str:
    """SELECT items that build the tree of a column and its fingerprint."""
    return f"""
  list_transform(string_split({column}, chr(10)), lambda line:
    list_transform(regexp_extract_all(line, '[^.!?]{{1,96}}[.!?]*|[.!?]+'), lambda p: sha256(p))) as {name}_leaves,
  list_transform({name}_leaves, lambda l: sha256(array_to_string(l, ''))) as {name}_sections,
  sha256(array_to_string({name}_sections, '')) || ':' || array_to_string(list_transform(
    range(1, len({name}_sections) + 1), lambda i: array_to_string(list_concat([left({name}_sections[i], 8)],
      list_transform({name}_leaves[i], lambda l: left(l, 8))), '.')), '/') as {name}"""


def _likeness(a: str, b: str) -> str:
    nodes = [f"list_distinct(string_split_regex(split_part({x}, ':', 2), '[./]'))" for x in (a, b)]
    share = f"2.0 * len(list_intersect({nodes[0]}, {nodes[1]})) / (len({nodes[0]}) + len({nodes[1]}))"
    return f"case when {a} = {b} then 1.0 else least(0.9999, cast({share} as double)) end"


_FINGERPRINTS = f"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
next as (
  select doc_id, text, cast(length(text) as bigint) as n_chars,
    coalesce(lead(text) over (order by doc_id), first_value(text) over (order by doc_id)) as next_text
  from texts),
edited as (
  select *, left(text, n_chars - n_chars // 4) || left(next_text, n_chars // 4) as edited from next),
marked as (
  select doc_id, n_chars, sha256(edited) as edited_sha256, {_marked('text', 'fingerprint')},
    {_marked('edited', 'edited_fingerprint')}, {_marked('next_text', 'next_fingerprint')}
  from edited)
select doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  cast({_likeness('fingerprint', 'edited_fingerprint')} as double) as near_edited,
  cast({_likeness('fingerprint', 'next_fingerprint')} as double) as near_next
from marked
"""

# Five hexadecimal digits of SHA-1 are four digits of base 32.
_WARC = """
with payloads as (
  select page_id, coalesce(html, '') as html, max(page_id) over (partition by coalesce(html, '')) as keeper
  from pages),
hashed as (select *, sha1(html) as sha from payloads)
select page_id, cast(strlen(html) as bigint) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast(1 + ((cast('0x' || substr(sha, 5 * (i // 4) + 1, 5) as bigint) >> cast(15 - 5 * (i % 4) as bigint)) & 31)
      as bigint), 1)), '') as payload_digest,
  case when page_id = keeper then 'response' else 'revisit' end as record_type,
  case when page_id <> keeper then keeper end as refers_to
from hashed
"""

_NOTICES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES)


def _bigrams(text: str) -> str:
    words = (
        f"list_filter(regexp_split_to_array(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        "'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\\x{80}-\\x{10FFFF}]+'), lambda w: w <> '')"
    )
    pair = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"list_transform([{words}], lambda w: list_distinct({pair}))[1]"


# Every piece against every notice, without bounds.
_LICENSES = f"""
with notices(license, notice) as (values {_NOTICES}),
lines as (
  select doc_id, unnest(range(0, len(l))) as line, unnest(l) as piece
  from (select doc_id, string_split(text, chr(10)) as l from documents)),
pieces as (
  select doc_id, line, piece from lines
  union all
  select doc_id, line, unnest(string_split(
    regexp_replace(piece, '([.!?])[ \\t]+', '\\1' || chr(10), 'g'), chr(10))) from lines
  union all
  select doc_id, null, unnest(regexp_split_to_array(text, '\\n[ \\t]*\\n')) from documents),
sets as (select distinct doc_id, line, {_bigrams('piece')} as found from pieces),
marks as (select license, {_bigrams('notice')} as notice from notices),
met as (
  select doc_id, license, line,
    2.0 * len(list_intersect(found, notice)) / (len(found) + len(notice)) as dice
  from sets, marks where len(found) > 0)
select doc_id, license, cast(max(dice) as double) as dice, count(distinct line) as n_lines,
  cast(min(line) as bigint) as first_line
from met where dice >= {THRESHOLD} group by doc_id, license
"""

# Every phrase counted, every cut scored, every candidate held against every longer one.
_COLLOCATIONS = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
words as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') as w from pieces),
totals as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
grams as (
  select lang, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)),
    lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
  from words, (select unnest(range(1, 6)) as k)),
counts as (select lang, k, phrase, count(*) as a from grams group by lang, k, phrase having count(*) >= 100),
cuts as (
  select lang, phrase, k, a, cut, string_split(phrase, ' ') as w from (
    select *, unnest(range(1, k)) as cut from counts where k > 1)),
scored as (
  select c.lang, c.phrase, c.k, c.a, c.cut, b.a as l, e.a as r, t.n,
    (1000::hugeint * c.a * t.n) // (b.a::hugeint * e.a) as score
  from cuts c join totals t using (lang)
  join counts b on b.lang = c.lang and b.phrase = array_to_string(c.w[1:c.cut], ' ')
  join counts e on e.lang = c.lang and e.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
weakest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
kept as (
  select * from weakest w where not exists (
    select 1 from counts c where c.lang = w.lang and c.k > w.k and 100 * c.a >= 100 * w.a
      and contains(' ' || c.phrase || ' ', ' ' || w.phrase || ' '))),
ranked as (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
    phrase, a, l, r, n, cast(score as bigint) as score
  from kept)
select * from ranked where rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op1_warc": _WARC,
    "op5_license_scan": _LICENSES,
    "op7_ngram_jaccard_join": _JACCARD,
    "op10_fingerprints": _FINGERPRINTS,
    "op11_collocations": _COLLOCATIONS,
}
