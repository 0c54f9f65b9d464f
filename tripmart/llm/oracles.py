"""SQL equivalents of the queries, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_KEY = (
    "translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),"
    " 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

ORACLES["op2_line_dedup"] = f"""
with docs as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), split as (
  select r, doc_id, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as pos
  from docs
), keys as (
  select r, doc_id, line, pos, {_KEY} as key from split
), shared as (
  select key from keys where key <> '' group by key having count(distinct r) >= 10
), marked as (
  select k.*, s.key is not null as dropped from keys k left join shared s using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), ''))
         as kept_sha256
from marked group by r, doc_id
"""

ORACLES["op6_impact_top_k"] = """
with v as (
  select vec_id, min(embedding) as embedding from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
  group by vec_id
), i as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as x from v
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.x, c.x) as bigint) as score
  from i q join i c on q.vec_id <> c.vec_id and len(q.x) = len(c.x)
  where q.vec_id % 20 = 0
), r as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
         vec_id, score
  from s
)
select * from r where rank <= 20
"""


def _license_sql() -> str:
    """Known sentences marked in the words of each text, and rules over runs of them."""
    from tripmart.llm.licenses import GAP_WORDS, RULES, SENTENCES

    known = ", ".join(f"('{text}', '{name}')" for name, text in SENTENCES.items())
    rules = ", ".join(f"('{name}', '|{'|'.join(ids)}|')" for name, ids in RULES)
    # longest first: of sentences at one place the first alternative counts
    either = "|".join(sorted(SENTENCES.values(), key=lambda text: (-len(text), text)))
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
with known(plain, id) as (values {known}), rules(license, ids) as (values {rules}),
docs as (
  select row_number() over () as r, doc_id,
         regexp_replace(regexp_replace({low}, '[^a-z0-9]*\n[^a-z0-9]*\n[^a-z0-9]*', ' | ', 'g'), '[^a-z0-9|]+', ' ', 'g') as words
  from (select doc_id, replace(text, '|', ' ') as text from documents)
), marked as (
  select r, string_split_regex(regexp_replace(words, '\b({either})\b', '<\1>', 'g'), '[<>]') as parts from docs
), split as (
  select r, unnest(parts) as part, generate_subscripts(parts, 1) as pos from marked
), found as (
  select s.r, s.pos, k.id, len(regexp_extract_all(b.part, '[a-z0-9]+')) as gap
  from split s join known k on s.part = k.plain join split b on b.r = s.r and b.pos = s.pos - 1
  where s.pos % 2 = 0
), steps as (
  select *, case when gap <= {GAP_WORDS} and lag(pos) over w is not null then 0 else 1 end as new
  from found window w as (partition by r order by pos)
), islands as (
  select r, pos, id, sum(new) over (partition by r order by pos) as island from steps
), runs as (
  select r, concat('|', string_agg(id, '|' order by pos), '|') as ids, count(*) as n
  from islands group by r, island
), hits as (
  select distinct r, license from runs join rules
  on contains(runs.ids, rules.ids)
), names as (
  select r, string_agg(license, ',' order by license) as licenses from hits group by r
), counts as (
  select r, sum(n) as n_sentences from runs group by r
)
select doc_id, coalesce(licenses, '') as licenses, cast(coalesce(n_sentences, 0) as bigint) as n_sentences
from docs left join names using (r) left join counts using (r)
"""


ORACLES["op4_license_scan"] = _license_sql()


# Fixed value: the polynomial of CRC-32, with the lowest bit first.
_POLYNOMIAL = 3988292384


# The 256 steps of CRC-32, as a list in the table ``crc``.
_CRC_STEPS = f"""
crc as (
  select list(step order by b) as steps from (
    select b, list_reduce(list_prepend(b, range(0, 8)),
      lambda c, x: case when c & 1 = 1 then xor(c >> 1, {_POLYNOMIAL}) else c >> 1 end) as step
    from range(256) t(b)
  )
)"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of ``text``; ``steps`` is in scope."""
    values = (
        f"list_transform(range(0, octet_length(encode({text}))),"
        f" lambda i: cast(concat('0x', substring(hex(encode({text})), 2 * i + 1, 2)) as bigint))"
    )
    return (
        f"xor(list_reduce(list_prepend(4294967295, {values}),"
        f" lambda c, x: xor(steps[xor(c & 255, x) + 1], c >> 8)), 4294967295)"
    )


ORACLES["op11_prefix_trie"] = f"""
with {_CRC_STEPS},
turns as (
  select conv_id, md5(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, ''))) as token,
         octet_length(encode(coalesce(text, ''))) as size, turn
  from conversations where conv_id is not null
), placed as (
  select conv_id, token, size, row_number() over (partition by conv_id order by turn nulls first, token) as place from turns
), ids as (
  select conv_id, {_crc32("cast(conv_id as varchar)")} % 9 as h
  from (select distinct conv_id from placed) cross join crc
), rebuilt as (
  select i.conv_id, p.token, p.size, 0 as part, p.place
  from ids i join placed p on p.conv_id = i.conv_id - i.conv_id % 5 where p.place <= i.h
  union all
  select i.conv_id, p.token, p.size, 1, p.place from ids i join placed p using (conv_id) where p.place > i.h
), steps as (
  select conv_id, size, row_number() over w as depth, string_agg(token, '') over w as path
  from rebuilt window w as (partition by conv_id order by part, place rows between unbounded preceding and current row)
), prefixes as (
  select conv_id, 0 as depth, '' as path, 0 as size from ids
  union all select conv_id, depth, path, size from steps
), ended as (
  select conv_id, max(depth) as depth from prefixes group by conv_id
), members as (
  select p.*, p.depth = e.depth as last from prefixes p join ended e using (conv_id)
), nodes as (
  select path, depth, max(size) as size, min(conv_id) as conv_id, count(*) as n_convs,
         coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where last), '') as ends
  from members group by path, depth
), kids as (
  select left(path, 32 * (depth - 1)) as path, count(*) as n from nodes where depth > 0 group by 1
), below as (
  select n.path, n.size, n.n_convs, coalesce(k.n, 0) as kids, unnest(range(0, n.depth + 1)) as top
  from nodes n left join kids k using (path)
), sums as (
  select left(path, cast(32 * top as bigint)) as path, count(*) filter (where kids = 0) as leaves,
         sum((n_convs - 1) * size) as saved
  from below group by 1
)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs,
       coalesce(k.n, 0) as n_children, s.leaves as n_leaves, cast(s.saved as bigint) as saved_tokens,
       sha256(n.ends) as ends_sha256
from nodes n join sums s using (path) left join kids k using (path)
left join nodes p on n.depth > 0 and p.path = left(n.path, 32 * (n.depth - 1))
"""

ORACLES["op12_spelling_variants"] = f"""
with recursive {_CRC_STEPS},
runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[a-zÀ-ÿ]+')) as word
  from documents
), met as (
  select coalesce(cast(doc_id as varchar), '') as doc, word, count(*) as n from runs where length(word) >= 6 group by all
), hashed as (
  select word, n, {_crc32("concat(doc, ':', word)")} as h from met cross join crc
), slipped as (
  select case when h % 199 = 0
         then concat(left(word, h % length(word)), substring(word, h % length(word) + 2)) else word end as word, n
  from hashed
), words as (
  select word, cast(sum(n) as bigint) as n from slipped where length(word) >= 6 group by word having sum(n) >= 5
), shorter as (
  select word, n, unnest(range(0, length(word))) as i from words
), masked as (
  select word, n, concat(left(word, i), '*', substring(word, i + 2)) as mask,
         concat(left(word, i), substring(word, i + 2)) as less
  from shorter
), pairs as (
  select a.word, b.word as near, b.n as near_n from masked a join masked b using (mask) where a.word <> b.word
  union select a.word, b.word, b.n from masked a join words b on a.less = b.word
  union select b.word, a.word, a.n from masked a join words b on a.less = b.word
), ranked as (
  select *, count(*) over (partition by word) as n_near,
         row_number() over (partition by word order by near_n desc, near) as place
  from pairs
), forms as (
  select w.word, w.n, coalesce(r.n_near, 0) as n_near, case when near_n >= 5 * w.n then near end as form,
         case when near_n >= 5 * w.n then near_n end as form_n
  from words w left join ranked r on r.word = w.word and r.place = 1
), walk as (
  select word, word as root, 0 as step from forms
  union all
  select walk.word, f.form, step + 1 from walk join forms f on f.word = walk.root where f.form is not null
), roots as (
  select word, max_by(root, step) as root from walk group by word
)
select word, form, root, n, n_near, form_n from forms join roots using (word)
"""
