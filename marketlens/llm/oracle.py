"""DuckDB SQL for the operators whose whole result SQL can state."""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _word_rows(text: str) -> str:
    """Rows (doc_id, word, place) of all words."""
    return f"""select doc_id, unnest(found) as word, unnest(range(1, len(found) + 1)) as place
from (select doc_id, regexp_extract_all({text}, {_WORDS}) as found from documents where text is not null)"""


def _run(width: int) -> str:
    """The words of a run that starts at a word, joined; words hold no blanks."""
    following = ", ".join(f"lead(word, {k}) over o" for k in range(1, width))
    return f"concat_ws(' ', word, {following})"


WARC = """
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type,
  case when again then newest end as refers_to
from (select *, payload_bytes >= 1000 and page_id <> newest as again
      from (select *, max(page_id) over (partition by payload_digest, payload_bytes) as newest
            from (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                    sha1(coalesce(html, '')) as payload_digest from pages)))"""

REPEATS = f"""
with words as ({_word_rows("text")}),
runs as (select *, {_run(13)} as run, lead(word, 12) over o is not null as whole
  from words window o as (partition by doc_id order by place)),
firsts as (select run, min(doc_id) as first from runs where whole group by run),
starts as (select runs.*, coalesce(whole and first < doc_id, false) as repeated from runs left join firsts using (run)),
judged as (select *, bool_or(repeated) over (
    partition by doc_id order by place rows between 12 preceding and current row) as gone from starts),
texts as (select doc_id, count(*) as n, count(*) filter (where gone) as g,
    string_agg(word, ' ' order by place) filter (where not gone) as kept from judged group by doc_id)
select doc_id, coalesce(n, 0) as n_words, coalesce(g, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from documents left join texts using (doc_id)"""

NEAR_DUPLICATES = f"""
with recursive words as ({_word_rows(f"translate(text, '{_UPPER}', '{_LOWER}')")}),
counts as (select doc_id, count(*) as n from words group by doc_id),
runs as (select doc_id, place, {_run(5)} as shingle from words window o as (partition by doc_id order by place)),
shingles as (select distinct doc_id, shingle from runs join counts using (doc_id) where place <= greatest(n - 4, 1)),
sizes as (select doc_id, count(*) as size from shingles group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as common
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all),
links as (select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= 75 * (x.size + y.size - common)),
reached(a, b) as (select a, b from links union select r.a, l.b from reached r join links l on l.a = r.b),
lowest as (select a as doc_id, min(b) as low from reached group by a)
select doc_id, coalesce(size, 0) as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id,
  doc_id <= coalesce(low, doc_id) as kept
from documents left join sizes using (doc_id) left join lowest using (doc_id)"""

CHAT = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
    case when conv_id is null then uuid() end as lone from conversations
  union all select -1, turn, role, '<|im_end|><|im_start|>assistant ok', null
  from (values (0, 'user'), (1, 'assistant')) as v(turn, role)),
pieces as (select *, length('<|im_start|>' || url_encode(role)) + 1
    + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + length('<|im_end|>') + 1 as chars from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars
from pieces group by conv_id, lone"""

PHRASES = rf"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
runs as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
totals as (select lang, sum(len(ws))::hugeint as n from runs group by lang),
spans as (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from runs, range(1, 6) as s(k) where len(ws) >= k),
counts as (select lang, array_to_string(ws[i:i + k - 1], ' ') as phrase, k, count(*) as a from spans group by all having count(*) >= 100),
cuts as (select lang, phrase, a, unnest(range(1, k)) as c, string_split(phrase, ' ') as ws from counts where k >= 2),
scored as (select c.lang, c.phrase, c.a, x.a as l, y.a as r, n, c.c, (1000::hugeint * c.a * n) // (x.a::hugeint * y.a) as score
  from cuts c join totals using (lang)
  join counts x on x.lang = c.lang and x.phrase = array_to_string(ws[1:c.c], ' ')
  join counts y on y.lang = c.lang and y.phrase = array_to_string(ws[c.c + 1:], ' ')),
weakest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1),
kept as (select * from weakest p where not exists (select 1 from counts q where q.lang = p.lang
  and 100 * q.a >= 100 * p.a and len(string_split(q.phrase, ' ')) > len(string_split(p.phrase, ' '))
  and contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ')))
select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank,
  phrase, a, l, r, n::bigint as n, score::bigint as score
from kept qualify row_number() over (partition by lang order by score desc, a desc, encode(phrase)) <= 2000"""
