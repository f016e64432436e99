"""SQL twins of the queries, for DuckDB; constants are written out here and not taken from the operators."""

from __future__ import annotations

# The stop words of the rules.
STOP_WORDS = (
    "a and as by con dans das de del den der des die du ein eine el en et for im in is ist la las le les los "
    "mit of on por pour que se sich that the to un una und une von was with y zu"
)

QUALITY_RULES = f"""
with stops as (select string_split('{STOP_WORDS}', ' ') as s),
base as (
  select doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as w,
         [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as l
  from (select doc_id, coalesce(text, '') as t from documents)
),
windows as (
  select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n
  from (
    select doc_id, i, w[i] as a, w[i + 1] as b, w[i + 2] as c
    from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from base)
  )
),
covered as (
  select doc_id, count(distinct i + k) as n
  from (select doc_id, i, unnest([0, 1, 2]) as k from windows where n > 1)
  group by doc_id
),
figures as (
  select b.doc_id, len(w)::bigint as n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         length(regexp_replace(t, '[^!]', '', 'g'))::bigint as n_marks,
         len([x for x in w if list_contains(s, x)])::bigint as n_stops,
         len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
         coalesce(c.n, 0)::bigint as n_repeat_words
  from base b cross join stops left join covered c on b.doc_id = c.doc_id
),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from figures)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and word_chars >= 2.0 * n_words and word_chars <= 15.0 * n_words and n_symbols <= 0.15 * n_words
       and n_marks <= 0.25 * n_words and n_stops >= 0.01 * n_words and n_dup_lines <= 0.5 * n_lines as kept
from judged
"""

JACCARD = """
with recursive cut as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w
  from documents
),
places as (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from cut where len(w) > 0),
grams as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s from places),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as k from grams a join grams b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2
),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 75 * (x.n + y.n - k)
),
reach as (
  select doc_id, doc_id as r from cut
  union
  select reach.doc_id, links.b from reach join links on reach.r = links.a
)
select cut.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(r) as component_id
from cut left join sizes on cut.doc_id = sizes.doc_id join reach on cut.doc_id = reach.doc_id group by cut.doc_id
"""

# Canonical wordings of the one-line notices, as the canonical form gives them.
LICENSES = """
with known(license, f) as (values
  ('Apache-2.0', 'licensed under the apache license version 2 0'),
  ('Apache-2.0', 'licensed under the apache license 2 0'),
  ('Apache-2.0', 'released under the apache license version 2 0'),
  ('Apache-2.0', 'spdx license identifier apache 2 0'),
  ('MIT', 'released under the mit license'),
  ('MIT', 'licensed under the mit license'),
  ('MIT', 'this project is licensed under the mit license'),
  ('MIT', 'spdx license identifier mit'),
  ('MIT', 'the mit license mit'),
  ('GPL-3.0', 'this work is licensed under the gnu general public license version 3'),
  ('GPL-3.0', 'licensed under the gnu general public license version 3'),
  ('GPL-3.0', 'licensed under the gnu general public license v3'),
  ('GPL-3.0', 'spdx license identifier gpl 3 0 only'),
  ('GPL-3.0', 'spdx license identifier gpl 3 0 or later'),
  ('CC-BY-NC-4.0', 'licensed under cc by nc 4 0'),
  ('CC-BY-NC-4.0', 'this work is licensed under cc by nc 4 0'),
  ('CC-BY-NC-4.0', 'spdx license identifier cc by nc 4 0'),
  ('CC-BY-4.0', 'licensed under cc by 4 0'),
  ('CC-BY-4.0', 'this work is licensed under cc by 4 0'),
  ('CC-BY-4.0', 'spdx license identifier cc by 4 0'),
  ('CC0-1.0', 'released under cc0 1 0'),
  ('CC0-1.0', 'spdx license identifier cc0 1 0'),
  ('ISC', 'spdx license identifier isc'),
  ('BSD-2-Clause', 'spdx license identifier bsd 2 clause'),
  ('BSD-3-Clause', 'spdx license identifier bsd 3 clause'),
  ('BSD-3-Clause', 'released under the 3 clause bsd license'),
  ('MPL-2.0', 'spdx license identifier mpl 2 0'),
  ('MPL-2.0', 'licensed under the mozilla public license version 2 0')
),
spelled as (
  select doc_id,
         replace(replace(replace(replace(replace(replace(replace(replace(
           regexp_replace(lower(coalesce(text, '')), '(?m)^[^\\p{L}\\p{N}\\n]*(?:copyright|\\(c\\)|©)[^\\n]*(?:\\(c\\)|©|[0-9]{4})[^\\n]*$', '', 'g'),
           'licence', 'license'), 'licensor''s', 'licensors'), 'copyright holder', 'copyright owner'),
           'acknowledgement', 'acknowledgment'), 'organisation', 'organization'), 'non-commercial', 'noncommercial'),
           'sub-license', 'sublicense'), 'whilst', 'while') as t
  from documents
),
plain as (select doc_id, regexp_replace(t, '[^\\p{L}\\p{N}\\n]+', ' ', 'g') as c from spelled),
units as (
  select doc_id, 'text' as kind, trim(regexp_replace(c, '[ \\n]+', ' ', 'g')) as f from plain
  union all
  select doc_id, 'line', trim(unnest(string_split(c, chr(10)))) from plain
)
select doc_id, min(case when kind = 'text' then license end) as text_license,
       string_agg(distinct license, ' ' order by license) as licenses,
       count(case when kind = 'line' then 1 end) as n_lines
from units join known using (f) group by doc_id
"""

# base32 from the hexadecimal SHA-1: four bits per digit, then five bits per letter
WARC = """
with hashed as (select page_id, coalesce(html, '') as html, sha1(encode(coalesce(html, ''))) as hex from pages),
bits as (
  select page_id, html, hex,
         array_to_string([substr('0000000100100011010001010110011110001001101010111100110111101111',
                                 4 * instr('0123456789abcdef', substr(hex, i, 1)) - 3, 4) for i in range(1, 41)], '') as b
  from hashed
),
named as (
  select page_id, octet_length(encode(html))::bigint as payload_bytes,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             16 * substr(b, 5 * i + 1, 1)::int + 8 * substr(b, 5 * i + 2, 1)::int + 4 * substr(b, 5 * i + 3, 1)::int
             + 2 * substr(b, 5 * i + 4, 1)::int + substr(b, 5 * i + 5, 1)::int + 1, 1) for i in range(0, 32)], '') as payload_digest,
         max(page_id) over (partition by html) as keeper
  from bits
)
select page_id, payload_bytes, payload_digest, case when page_id = keeper then 'response' else 'revisit' end as record_type,
       case when page_id <> keeper then keeper end as refers_to
from named
"""

LEXICAL_SEARCH = r"""
with d as (
  select row_number() over () as d, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents where text is not null
),
sized as (select d, doc_id, terms, len(terms)::bigint as n from d where len(terms) > 0),
totals as (select count(*)::bigint as docs, sum(n)::bigint as length from sized),
tally as (select d, term, count(*)::bigint as tf from (select d, unnest(terms) as term from sized) group by d, term),
asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
),
weighed as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w
  from tally, totals where term in (select term from asked) group by term, docs
),
scored as (
  select item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // length))))::bigint as score
  from asked join weighed using (term) join tally using (term) join sized using (d), totals
  group by item_id, d, doc_id
),
placed as (select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as place from scored where score > 0)
select item_id, place::int as rank, doc_id, score from placed where place <= 50
"""

ORACLES: dict[str, str] = {
    "op11_lexical_search": LEXICAL_SEARCH,
    "op7_warc": WARC,
    "op2_ngram_jaccard_join": JACCARD,
    "op4_license_scan": LICENSES,
    "op1_quality_rules": QUALITY_RULES,
}
