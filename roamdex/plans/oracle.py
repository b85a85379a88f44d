"""The registered queries as SQL for the side-by-side check, written apart from the Spark plans.

The check's regex engine has no look-around and no possessive repeats, so patterns are spelled without them:
a section is matched together with the next marked word, which is then left out or put back.
"""

from __future__ import annotations

from roamdex import fixed
from roamdex.plans.queries import (
    ANCHOR,
    HITS,
    LINK_PREFIX,
    PRIORITY_HOST,
    ROUND_SIZE,
    SEED_BASE,
)


def _q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


NL = "chr(10)"
WORD = r"[\p{L}\p{N}_]"
TOK = _q(fixed.TOKEN.replace(")*+", ")*"))
TITLE = "regexp_extract(html, '<title>(.*)</title>', 1)"
TITLED = f"select cast(page_id as varchar) as doc_id, url as link, {TITLE} as title from pages"
ORIGIN = "regexp_extract({u}, '(https?://.*?)/', 1)"
RANK = "cast(case when contains({u}, " + _q(PRIORITY_HOST) + ") then 0 else 1 end as bigint)"
EXCLUDED = f"regexp_matches({{u}}, {_q(fixed.EXCLUDED_TYPES)})"
NAME_TAIL = _q(fixed.NAME_TAIL.removeprefix("(?d)"))


def _clean_name(c: str) -> str:
    return f"regexp_replace({c}, {NAME_TAIL}, '', 'g')"


def _quoted(c: str) -> str:
    out = f"url_encode({c})"
    for ch in fixed.QUOTE_KEEP:
        out = f"replace({out}, '%{ord(ch):02X}', {_q(ch)})"
    return out


# --- documents -------------------------------------------------------------------------------------

_RAW = f"replace(replace(concat(url, {NL}, html), chr(13) || {NL}, {NL}), chr(13), {NL})"

PAGE_DOCUMENTS = rf"""
with raw as (select {_RAW} as raw from pages),
     body as (select split_part(raw, {NL}, 1) as link, regexp_extract(raw, '<title>(.*)</title>', 1) as title,
                     regexp_replace(regexp_replace(raw, '<.*?>', '', 'g'), '\n+', {NL}, 'g') as other
              from raw)
select md5(link) as doc_id, link, title, cast(0 as bigint) as num_cat, md5(other) as other_md5,
       cast(length(other) as bigint) as other_chars
from body
"""

_LAST = len(fixed.SECTION_NAMES)
_PARTS = ["'Intro'", NL]
for _i, _name in enumerate(fixed.SECTION_NAMES, 1):
    _body = (
        f"coalesce(lines[{_i}], '')"
        if _i < _LAST
        else f"array_to_string(list_slice(lines, {_i}, len(lines)), {NL})"
    )
    _PARTS += [_q(_name + fixed.EDIT_MARK), NL, f"coalesce({_body}, '')", NL]
_PARTS += [_q("End" + fixed.EDIT_MARK), NL]
WRAPPED = (
    f"wrapped as (select doc_id, concat({', '.join(_PARTS)}) as clean "
    f"from (select doc_id, string_split(text, {NL}) as lines from documents))"
)


def _section(name: str) -> str:
    body = rf"regexp_extract(clean, '(?s)({name}\[edit\].*?){WORD}+\[edit\]', 1)"
    cut = rf"regexp_replace({body}, '\n+', {NL}, 'g')"
    return f"select doc_id, {_q(name)} as name, {cut} as body from wrapped"


_SECTIONS = f"{WRAPPED}, found as ({' union all '.join(_section(n) for n in fixed.SECTION_NAMES)})"

PAGE_SECTIONS = f"""
with {_SECTIONS}
select doc_id, name, md5(body) as body_md5, cast(length(body) as bigint) as body_chars from found where body <> ''
"""
PAGE_SECTIONS_COUNT = f"""
with {_SECTIONS}
select doc_id, cast(count(*) filter (where body <> '') as bigint) as num_cat from found group by doc_id
"""


def _remainder() -> str:
    rest = "clean"
    for name in fixed.SECTION_NAMES:
        rest = rf"regexp_replace({rest}, '(?s){name}\[edit\].*?({WORD}+\[edit\])', '\1', 'g')"
    return rf"""
with {WRAPPED},
     rest as (select doc_id, regexp_replace({rest}, '\n+', {NL}, 'g') as rest from wrapped)
select doc_id, md5(rest) as rest_md5, cast(length(rest) as bigint) as rest_chars from rest
"""


_CRUMBED = f"""crumbed as (
  select page_id, url as link, html,
         concat('<span class="ext-geocrumbs-breadcrumbs"><a title="', split_part(url, '/', 3), '"></a><a title="',
                split_part(url, '/', 4), '"></a>',
                case when starts_with(url, 'https://') then concat('<bdi>a</bdi><bdi>', url, '</bdi>') else '' end) as line
  from pages),
crumbs as (
  select page_id, link, html,
         list_concat(regexp_extract_all(line, 'title="(.*?)"', 1),
                     case when starts_with(link, 'https://') then [link] else [] end) as categories
  from crumbed)"""

BREADCRUMBS = f"""
with {_CRUMBED}
select page_id, cast(unnest(range(len(categories))) as bigint) as pos, unnest(categories) as category from crumbs
"""

CLEAN_NAMES = f"""
with t as (select page_id, {TITLE} as t, url from pages),
     k as (select page_id, t, url, cast(unnest(range(7)) as bigint) as kind,
                  unnest([' - ', ' (', ' |', ' – ', ' — ', '-', {NL}]) as tail from t)
select page_id, kind, {_clean_name('concat(t, tail, url)')} as name from k
"""

GAZETTEER = f"""
with {_CRUMBED},
     names as (select distinct page_id, {_clean_name('name')} as value
               from (select page_id, unnest(list_prepend({TITLE}, categories)) as name from crumbs))
select value, count(*) as n_docs from names group by value
"""

_HEADINGS = f"select unnest(regexp_extract_all(html, {_q(ANCHOR)}, 1)) as heading from pages"
HEADING_COUNTS = f"select heading, count(*) as n from ({_HEADINGS}) group by heading"
HEADLINE_COUNTS = """
select heading, count(*) as n from (
  select 'See' as heading from pages union all select split_part(url, '/', 3) from pages)
group by heading
"""
TOP_HEADINGS = f"{HEADING_COUNTS} order by n desc, heading"
_ESCAPED = r"replace(replace(replace(replace(heading, '\', '\\'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t')"
_QUOTED = rf"""case when contains(heading, chr(39)) and not contains(heading, '"') then '"' || {_ESCAPED} || '"'
 else chr(39) || replace({_ESCAPED}, chr(39), '\' || chr(39)) || chr(39) end"""
HEADING_TEXT = f"select '(' || {_QUOTED} || ', ' || n || ')' as value from ({HEADING_COUNTS})"

# --- links -----------------------------------------------------------------------------------------

_ABS = fixed.ABSOLUTE_LINK_PARTS
ABSOLUTE_LINKS = f"""
with l as (select page_id, regexp_extract_all(concat_ws(' ', url, url || '.png', url || '/a.b,', html), {_q(_ABS)}, 0) as ls
           from pages),
     e as (select page_id, cast(unnest(range(len(ls))) as bigint) as pos, unnest(ls) as link from l)
select page_id, pos, link from e where not {EXCLUDED.format(u='link')}
"""
_HOST = "split_part(url, '/', 3)"
_LINKED = f"""concat(html, chr(13), {NL}, 'see https://www.example.org/wiki/', page_id % 7, '. https://', {_HOST}, '/top, https://', {_HOST},
 '/a.png https://guide.example.org/p/', page_id % 40)"""


def _edges(origin: str) -> str:
    return f"""edges as (
  select src, dst, kind, pos from (
    select url as src, root || unnest(rel) as dst, cast(0 as bigint) as kind, cast(unnest(range(len(rel))) as bigint) as pos
    from (select url, {origin} as root, regexp_extract_all({_LINKED}, 'href="(/.*?)"', 1) as rel from pages)
    where root <> ''
    union all
    select url, unnest(found), cast(1 as bigint), cast(unnest(range(len(found))) as bigint)
    from (select url, regexp_extract_all({_LINKED}, {_q(_ABS)}, 0) as found from pages))
  where not {EXCLUDED.format(u='dst')})"""


EDGES = _edges(ORIGIN.format(u="url"))
LINK_GRAPH_HTTPS = f"""
with {_edges("regexp_extract(url, '(https://.*?)/', 1)")}
select src, cast(count(*) filter (where kind = 0) as bigint) as n_relative, count(*) as n_links from edges group by src
"""
LINK_GRAPH = f"with {EDGES} select src, dst, kind, pos from edges"
QUEUE_CLASSES = f"""
with {EDGES}
select {RANK.format(u='dst')} as queue_rank, count(*) as n_links, count(distinct dst) as n_urls from edges group by 1
"""
URL_KEYS = f"""
with u as (select page_id, unnest([url, concat_ws('*~''&+<é>! ', url, {TITLE})]) as u from pages),
     k as (select page_id, {_quoted('u')} as quoted from u)
select page_id, quoted, md5(quoted) || '.txt' as url_key from k
"""
SEED_FRONTIER = f"""
select url, {RANK.format(u='url')} as queue_rank, seq
from (select {_q(SEED_BASE)} || trim(c_name) as url, c_custkey as seq from customer)
"""
_NEXT = """next as (
  select url, row_number() over (order by queue_rank, seq, url) as turn from {queue}
  qualify turn <= """ + str(ROUND_SIZE) + ")"  # fmt: skip
_QUEUE = f"queue as (select url, {RANK.format(u='url')} as queue_rank, page_id as seq from pages)"
FRONTIER_NEXT = f"with {_QUEUE}, {_NEXT.format(queue='queue')} select url, turn from next"
_SPLIT = f"""{_QUEUE},
waiting as (select * from queue where not starts_with(url, 'https://')),
visited as (select url from queue where starts_with(url, 'https://'))"""
FRONTIER_ADD = f"""
with {EDGES}, {_SPLIT}
select dst as url, {RANK.format(u='dst')} as queue_rank, min(pos) as seq from edges
where dst not in (select url from visited) and dst not in (select url from waiting)
group by dst
"""
FRONTIER_ROUND = f"""
with {EDGES}, {_SPLIT}, {_NEXT.format(queue='waiting')},
     seen as (select url from visited union select url from next),
     new as (select distinct dst as url from edges where src in (select url from next)
             and dst not in (select url from seen) and dst not in (select url from waiting))
select url, 'queued' as state, cast(0 as bigint) as round from waiting where url not in (select url from next)
union all select url, 'queued', cast(1 as bigint) from new
union all select url, 'visited', cast(-1 as bigint) from seen
"""
FRONTIER_RECONCILE = f"""
with {EDGES},
     q as (select distinct {_quoted('url')} as url from (select dst as url from edges union all select url from pages)),
     keys as (select distinct md5({_quoted('url')}) || '.txt' as url_key from pages)
select url, case when md5(url) || '.txt' in (select url_key from keys) then 'visited' else 'queued' end as state from q
union all
select url, 'visited' from (select {_q(SEED_BASE)} || trim(c_name) as url from customer) where url not in (select url from q)
"""
FRONTIER_RESUME = f"""
with {EDGES},
     seen as (select url from pages where page_id % 5 = 0 union select dst from edges where ends_with(dst, '/top')),
     first as (select dst as url, {RANK.format(u='dst')} as queue_rank, min(pos) as seq from edges group by dst),
     turns as (select url, row_number() over (order by queue_rank, seq, url) as turn from first
               where url not in (select url from seen))
select url, turn from turns where turn <= {3 * ROUND_SIZE} union all select url, -1 from seen
"""
FRONTIER_DEDUP = f"""
with {EDGES}
select dst as url, {RANK.format(u='dst')} as queue_rank, min(pos) as seq from edges group by dst
"""

# --- infoboxes ---------------------------------------------------------------------------------------

_BODY = f"""concat('{{{{Infobox', {NL}, '|name = [[', p_name, ']]', {NL}, '|size=', cast(p_size as varchar),
 ' <ref>a</ref> | x', {NL}, '| br{{a}}nd  = ', p_brand, {NL}, '|size = ', p_type, {NL}, '}}}}')"""


def _box_clean(c: str) -> str:
    bare = rf"regexp_replace(trim({c}, ' ' || chr(9) || {NL}), '[\[\]\{{\}}\=]|<.*?>', '', 'g')"
    return f"regexp_replace(replace({bare}, '|', ' '), ' +', ' ', 'g')"


_PAIRS = rf"""
dump as (select cast(p_partkey as varchar) as title, p_name, p_type, {_BODY} as body from part),
raw as (select title, p_name, p_type, regexp_extract_all(body, '\n\|(.*?)=(.*)', 1) as ks,
               regexp_extract_all(body, '\n\|(.*?)=(.*)', 2) as vs from dump),
pairs as (select title, p_name, p_type, pos, {_box_clean('k')} as mod_key, {_box_clean('v')} as mod_val
          from (select title, p_name, p_type, cast(unnest(range(len(ks))) as bigint) as pos, unnest(ks) as k, unnest(vs) as v from raw))
"""
INFOBOX_PAIRS = f"with {_PAIRS} select title, pos, mod_key, mod_val from pairs"
INFOBOX_MAP = f"""
with {_PAIRS} select title, mod_key as key, arg_max(mod_val, pos) as value from pairs group by title, mod_key
"""
INFOBOX_MISSING = f"with {_PAIRS} select title, count(*) as n_pairs from pairs group by title"
SEMI_GAZETTEER = f"""
with {_PAIRS}
select p_name as title, count(distinct title) as n_rows, count(*) as n_pairs from pairs
where p_name in (select p_name from part where p_type = 'ECONOMY') group by p_name
"""

# --- search --------------------------------------------------------------------------------------------

TEXT_TOKENS = f"""
toks as (select cast(doc_id as varchar) as doc_id, regexp_extract_all(lower(text), {TOK}, 0) as ts from documents),
lens as (select doc_id, cast(len(ts) as bigint) as doc_len from toks where len(ts) > 0),
post as (select doc_id, term, count(*) as tf from (select doc_id, unnest(ts) as term from toks) group by doc_id, term)"""
TITLE_TOKENS = f"""
titled as ({TITLED}),
toks as (select doc_id, link, title, regexp_extract_all(lower(title), {TOK}, 0) as ts from titled),
lens as (select doc_id, cast(len(ts) as bigint) as doc_len from toks where len(ts) > 0),
occurs as (select doc_id, unnest(ts) as term, cast(unnest(range(len(ts))) as bigint) as pos from toks),
post as (select doc_id, term, count(*) as tf from occurs group by doc_id, term)"""
_K1, _B = fixed.BM25_K1, fixed.BM25_B
BM25 = f"""
stat as (select count(*) as n, sum(doc_len) / count(*) as avg_len from lens),
df as (select term, count(*) as df from post group by term),
bm as (select post.doc_id, post.term,
              ln(1 + (n - df.df + 0.5) / (df.df + 0.5)) * (tf / (tf + {_K1} * (1 - {_B} + {_B} * doc_len / avg_len))) as s
       from post join df using (term) join lens using (doc_id), stat)"""

POSTINGS = f"with {TEXT_TOKENS} select 'other' as field, term, doc_id, tf, doc_len from post join lens using (doc_id)"
TITLE_POSITIONS = f"""
with {TITLE_TOKENS}
select term, doc_id, count(*) as tf, string_agg(cast(pos as varchar), ',' order by pos) as positions from occurs group by term, doc_id
"""
KEYWORD_POSTINGS = """
select 'lang' as field, lang as term, cast(doc_id as varchar) as doc_id, cast(1 as bigint) as tf, cast(1 as bigint) as doc_len from documents
union all select 'categories', lang, cast(doc_id as varchar), 2, 3 from documents
union all select 'categories', source, cast(doc_id as varchar), 1, 3 from documents
"""
TERM_STATISTICS = f"""
with {TEXT_TOKENS}
select 'other' as field, term, count(*) as df, cast(sum(tf) as bigint) as cf from post group by term
"""
FIELD_STATISTICS = f"""
with {TITLE_TOKENS}
select 'title' as field, count(*) as n_docs, cast(sum(doc_len) as bigint) as total_len from lens
union all select 'link', count(*), count(*) from titled
"""


def _sum_query(tokens: str, should: list[tuple[str, float]], where: str = "true", extra: str = "0") -> str:
    """Sum of term scores times boosts per document, over documents that pass ``where``."""
    boosts = " ".join(f"when {_q(t)} then {b}" for t, b in should)
    terms = ", ".join(_q(t) for t, _ in should)
    return f"""
with {tokens}, {BM25},
     hit as (select doc_id, sum(s * case term {boosts} end) as score from bm where term in ({terms}) group by doc_id)
select doc_id, round(score + {extra}, 6) as score from hit where {where}
"""


def _has(term: str) -> str:
    return f"doc_id in (select doc_id from post where term = {_q(term)})"


def _constant(condition: str) -> str:
    return f"with {TEXT_TOKENS} select distinct doc_id, cast(1.0 as double) as score from post where {condition}"


def _phrase(tokens: list[str]) -> str:
    """Occurrences of a phrase per document and the sum of its terms' weights."""
    joins = " ".join(
        f"join occurs a{i} on a{i}.doc_id = a0.doc_id and a{i}.pos = a0.pos + {i} and a{i}.term = {_q(t)}"
        for i, t in enumerate(tokens)
        if i
    )
    terms = ", ".join(_q(t) for t in tokens)
    return f"""
occ as (select a0.doc_id, count(*) as f from occurs a0 {joins} where a0.term = {_q(tokens[0])} group by a0.doc_id),
w as (select sum(ln(1 + (n - df + 0.5) / (df + 0.5))) as w from df, stat where term in ({terms})),
phrase as (select occ.doc_id, w * (f / (f + {_K1} * (1 - {_B} + {_B} * doc_len / avg_len))) as s
           from occ join lens using (doc_id), w, stat)"""


SEARCH_PHRASE = f"""
with {TITLE_TOKENS}, {BM25}, {_phrase(['the', 'and'])}
select doc_id, round(s, 6) as score from phrase
"""
SEARCH_PHRASE_OR_TERM = f"""
with {TITLE_TOKENS}, {BM25}, {_phrase(['and', 'attion', 'to'])},
     parts as (select doc_id, s * 1.5 as s from phrase union all select doc_id, s from bm where term = 'is')
select doc_id, round(sum(s), 6) as score from parts group by doc_id
"""
SEARCH_CATEGORY = f"""
with {_CRUMBED},
     toks as (select md5(link) as doc_id, categories, regexp_extract_all(lower({TITLE}), {TOK}, 0) as ts from crumbs),
     lens as (select doc_id, cast(len(ts) as bigint) as doc_len from toks where len(ts) > 0),
     post as (select doc_id, term, count(*) as tf from (select doc_id, unnest(ts) as term from toks) group by doc_id, term),
     {BM25},
     cats as (select doc_id, len(categories) as cat_len, len(list_filter(categories, lambda x: x = 'en')) as tf from toks),
     cstat as (select count(*) as n, sum(cat_len) / count(*) as avg_len, count(*) filter (where tf > 0) as df from cats),
     cat as (select doc_id, ln(1 + (n - df + 0.5) / (df + 0.5)) * (tf / (tf + {_K1} * (1 - {_B} + {_B} * cat_len / avg_len))) as s
             from cats, cstat where tf > 0),
     word as (select doc_id, s as ws from bm where term = 'the')
select doc_id, round(s + coalesce(ws, 0), 6) as score from cat left join word using (doc_id)
"""
_THE_HITS = f"""
{_CRUMBED},
doc as (select md5(link) as doc_id, {TITLE} as title, categories from crumbs),
toks as (select doc_id, regexp_extract_all(lower(title), {TOK}, 0) as ts from doc),
lens as (select doc_id, cast(len(ts) as bigint) as doc_len from toks where len(ts) > 0),
post as (select doc_id, term, count(*) as tf from (select doc_id, unnest(ts) as term from toks) group by doc_id, term),
{BM25},
hit as (select doc_id, round(s, 6) as score from bm where term = 'the')"""
HIT_TITLES = f"with {_THE_HITS} select doc_id, score, title as value from hit join doc using (doc_id)"
HIT_FIELDS = f"""
with {_THE_HITS}
select doc_id, unnest(['categories', 'id', 'link', 'other', 'title']) as value,
       cast(unnest([len(categories), 1, 1, 1, 1]) as bigint) as n
from hit join doc using (doc_id)
"""

_KEYWORDS = f"""
keywords as (select distinct keyword from (
  select unnest(string_split(text, ' ')) as keyword from benchmark union all select title from titled)),
last_word as (
  select keyword, list_filter(list_transform(regexp_split_to_array(trim(keyword, ' ' || chr(9) || {NL}), '\\s+'),
                              lambda x: regexp_extract_all(lower(x), {TOK}, 0)), lambda t: len(t) > 0) as words from keywords),
wanted as (select distinct keyword, unnest(words[len(words)]) as term from last_word where len(words) > 0)"""


def _counts(prefix: str, name: str) -> str:
    return f"""{name} as (
  select keyword, count(distinct doc_id) as hits
  from keywords left join wanted using (keyword)
  left join (select doc_id, term from post join titled using (doc_id) where starts_with(link, {_q(prefix)})) p using (term)
  group by keyword)"""


SEARCH_BATCH_COUNTS = f"""
with {TITLE_TOKENS}, {_KEYWORDS}, {_counts(LINK_PREFIX, 'counts')}
select keyword, hits from counts
"""
SEARCH_BATCH = f"""
with {TEXT_TOKENS}, {BM25},
     asked as (select item_id as query_id, unnest(list_distinct(regexp_extract_all(lower(text), {TOK}, 0))) as term from benchmark),
     hit as (select query_id, doc_id, sum(s) as score from asked join bm using (term) group by query_id, doc_id)
select query_id, doc_id, round(score, 6) as score, row_number() over (partition by query_id order by round(score, 9) desc, doc_id) as rank
from hit qualify rank <= {HITS}
"""
_SPACE = " || ".join(
    f"chr({c})"
    for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
KEYWORD_LIST = f"""
select distinct md5(trim(line, {_SPACE})) as keyword_md5 from (select unnest(string_split(text, {NL})) as line from documents)
"""

# --- enrichment --------------------------------------------------------------------------------------

_BOXES = rf"""
titled as ({TITLED}),
boxes as (select distinct array_to_string(list_slice(string_split(title, ' '), 1, 2), ' ') as title from titled where title <> ''),
phrases as (select title, array_to_string(regexp_extract_all(lower(regexp_replace(title, {_q(fixed.QUERY_SPECIAL)}, '', 'g')), {TOK}, 0), ' ') as phrase
            from boxes),
padded as (select doc_id, title, ' ' || array_to_string(regexp_extract_all(lower(title), {TOK}, 0), ' ') || ' ' as words from titled),
matches as (select phrases.title, padded.doc_id, phrase, padded.title as doc_title
            from phrases join padded on phrase <> '' and contains(words, ' ' || phrase || ' '))"""
TITLE_PHRASE_JOIN = f"with {_BOXES} select title, doc_id, phrase from matches"
PHRASES_OF_ANY_LENGTH = rf"""
with titled as ({TITLED}),
boxes as (select distinct title from (
  select array_to_string(list_slice(string_split(title, ' '), 1, 1 + cast(doc_id as int) % 6), ' ') as title from titled
  union all select unnest(list_prepend(p_name, string_split(p_name, ' '))) from part) where title <> ''),
{_BOXES[_BOXES.index("phrases as"):]}
select title, doc_id, phrase from matches
"""
_COPIES = "select '_' || doc_id as doc_id, doc_title as title, 'cap' as extra_keys, 'about ' || title as cap from matches"
_MERGED = """select '_' || doc_id as doc_id, any_value(doc_title) as title, 'cap' as extra_keys,
 arg_max('about ' || title, title) as cap from matches group by doc_id"""
_KEPT = "select doc_id, title, '' as extra_keys, '' as cap from titled where doc_id not in (select doc_id from matches)"

# --- evaluation ----------------------------------------------------------------------------------------

MACRO_RECALL = """
with lab as (select distinct label from (select quality as label from labels union all select toxic from labels)),
     r as (select label, coalesce(avg(case when toxic = quality then 1.0 else 0.0 end) filter (where quality is not null), 0) as recall
           from lab left join labels on quality = label group by label)
select round(avg(recall), 6) as macro_recall from r
"""


def _average_precision(rows: str, truth: str, score: str) -> str:
    return f"""
steps as (select cast({score} as double) as score, sum(case when {truth} then 1 else 0 end) as tp, count(*) as n from {rows} group by 1),
cum as (select tp, sum(tp) over (order by score desc) as ctp, sum(n) over (order by score desc) as cn from steps),
ap as (select coalesce(sum(tp * ctp / cn) / nullif(sum(tp), 0), 0) as ap from cum)"""


AVERAGE_PRECISION = f"""
with rows as (select quality, n_chars from labels join documents using (doc_id)), {_average_precision('rows', 'quality > 0', 'n_chars')}
select round(ap, 6) as average_precision from ap
"""
EVALUATE_KEYWORDS = f"""
with {TITLE_TOKENS}, {_KEYWORDS}, {_counts('http', 'truths')}, {_counts(LINK_PREFIX, 'counts')},
     rows as (select keyword, truths.hits as truth, counts.hits as pred from truths join counts using (keyword)),
     {_average_precision('rows', 'truth > 0', 'pred')},
     lab as (select distinct label from (select truth as label from rows union all select pred from rows)),
     r as (select label, coalesce(avg(case when pred = truth then 1.0 when pred <> truth then 0.0 end), 0) as recall
           from lab left join rows on truth = label group by label)
select 'average_precision' as metric, round(ap * 100, 6) as percent from ap
union all select 'macro_recall', round(avg(recall) * 100, 6) from r
"""


def _keyword_search() -> str:
    where = f"{_has('the')} and doc_id in (select doc_id from titled where starts_with(link, {_q(LINK_PREFIX)}))"
    return _sum_query(TITLE_TOKENS, [("is", 1.0), ("on", 1.0), ("the", 1.0)], where, "1.0")


SEARCH_GROUP = f"""
with {TEXT_TOKENS}, {BM25},
     hit as (select doc_id, sum(case when term in ('the', 'la') then 2 * s else s end) as score from bm
             where term in ('the', 'la', 'und') group by doc_id)
select doc_id, round(score, 6) as score from hit
where ({_has('the')} or {_has('la')}) and not ({_has('and')} and {_has('in')})
"""
SEARCH_RANGE_OPEN = f"""
with {TEXT_TOKENS}
select doc_id, cast(cast(bool_or(term > 'ton') as int) + cast(bool_or(term <= 'aa') as int) as double) as score
from post where term > 'ton' or term <= 'aa' group by doc_id
"""
SEARCH_LATE_WORD = """
select url as link, cast(length(url) + 1 + 7 * 5000 + 9 as bigint) as n_chars from pages where page_id % 9 = 3
"""
SEARCH_LIVE_VS_STORED = f"""
with {_CRUMBED}
select link, way from crumbs, (values ('live'), ('stored')) w(way)
"""
_FULL_RAW = f"""replace(replace(concat(link, {NL}, line, {NL}, 'title="no"', {NL}, html, chr(13), {NL}, replace(clean, {NL}, chr(13) || {NL}),
 'https://www.example.org/x', chr(13)), chr(13) || {NL}, {NL}), chr(13), {NL})"""


def _full_documents() -> str:
    rest = "clean"
    for name in fixed.SECTION_NAMES:
        rest = rf"regexp_replace({rest}, '(?s){name}\[edit\].*?({WORD}+\[edit\])', '\1', 'g')"
    names = " union all ".join(
        rf"select link, {_q(n)} as name from tags where regexp_matches(clean, '(?s){n}\[edit\].*?{WORD}+\[edit\]')"
        for n in fixed.SECTION_NAMES
    )
    return rf"""
with {_CRUMBED}, {WRAPPED},
     raws as (select c.link, {TITLE.replace('html', 'c.html')} as title, categories, {_FULL_RAW} as raw
              from crumbs c join crumbed using (page_id, link, html) join wrapped on wrapped.doc_id = page_id),
     tags as (select link, title, categories, regexp_replace(raw, '<[^
>]*>', '', 'g') as clean from raws),
     named as ({names}),
     n as (select link, count(*) as num_cat, md5(string_agg(name, ',' order by name)) as names_md5 from named group by link)
select tags.link, title, coalesce(num_cat, 0) as num_cat, array_to_string(categories, '|') as categories,
       coalesce(names_md5, md5('')) as names_md5,
       md5(regexp_replace(regexp_extract(clean, '(?s)(See\[edit\].*?){WORD}+\[edit\]', 1), '
+', {NL}, 'g')) as see_md5,
       md5(regexp_replace({rest}, '
+', {NL}, 'g')) as other_md5
from tags left join n on n.link = tags.link
"""


GAZETTEER_ROUND_TRIP = f"""
with {_CRUMBED},
     names as (select distinct {_clean_name('name')} as value from (select unnest(list_prepend({TITLE}, categories)) as name from crumbs))
select trim(value, {_SPACE}) as value, count(*) as n from names where value <> '' group by 1
"""
KEYWORDS_ROUND_TRIP = f"""
select distinct trim(line, {_SPACE}) as keyword from (select unnest(string_split(text, {NL})) as line from benchmark)
"""
PAGE_FILES_ROUND_TRIP = f"select url as link, {TITLE} as title, 2 * count(*) as n from pages group by 1, 2"
STATE_ROUND_TRIP = f"""
with {_SPLIT}
select url, queue_rank, seq from waiting union all select url, null, null from visited
"""
RESULT_COUNTS = "select url, case when page_id % 4 > 0 then page_id * 37 end as truth from pages"


PAGE_STORE = f"""
select md5({_quoted('url')}) || '.txt' as url_key, url as link,
       cast(length(replace(replace(concat(url, {NL}, {_LINKED}), chr(13) || {NL}, {NL}), chr(13), {NL})) as bigint) as n_chars
from pages
"""
SEED_LIST = f"""
select {_q(SEED_BASE)} || trim(c_name) as url, row_number() over (order by c_custkey) - 1 as seq from customer
"""
_SAVED = f"""
{EDGES}, {_SPLIT},
saved as (select dst as url, {RANK.format(u='dst')} as queue_rank, pos as seq from edges group by all
          union all select url, queue_rank, seq from waiting)"""
# Rows equal in queue, place and URL are one string of the state.
STATE_JSON_ROUND_TRIP = f"""
with {_SAVED},
     strings as (select distinct url, queue_rank, seq from saved),
     places as (select url, row_number() over (order by queue_rank, seq, url) as place from strings)
select url, queue_rank, count(*) as n from strings group by url, queue_rank
union all select url, 2, 1 from (select distinct url from visited)
union all select url, 3, max(place) from places group by url
"""
STATE_OR_SEEDS = f"""
with {_SAVED}
select {_q(SEED_BASE)} || trim(c_name) as url, {RANK.format(u=_q(SEED_BASE) + " || trim(c_name)")} as queue_rank, 'seeds' as way from customer
union all select url, min(queue_rank), 'state' from saved where url not in (select url from visited) group by url
union all select distinct url, -1, 'state' from visited
"""
EMPTY_PAGES = rf"""
with raws as (select case page_id % 3 when 0 then {_RAW} when 1 then url else '' end as raw from pages),
     docs as (select split_part(raw, {NL}, 1) as link, regexp_extract(raw, '<title>(.*)</title>', 1) as title,
                     md5(regexp_replace(regexp_replace(raw, '<.*?>', '', 'g'), '\n+', {NL}, 'g')) as other_md5 from raws)
select link, title, cast(0 as bigint) as num_cat, cast(0 as bigint) as n_cat, other_md5, count(*) as n from docs group by all
"""
SEARCH_BATCH_PREFIX = f"""
with {TITLE_TOKENS}, {BM25},
     words as (select item_id as query_id, list_distinct_kept as ts from (
       select item_id, list_filter(ts, lambda x, i: list_position(ts, x) = i) as list_distinct_kept
       from (select item_id, regexp_extract_all(lower(text), {TOK}, 0) as ts from benchmark))),
     asked as (select query_id, unnest(ts) as term from words),
     need as (select query_id, ts[len(ts)] as term from words),
     allowed as (select doc_id from titled where starts_with(link, {_q(LINK_PREFIX)})),
     hit as (select query_id, doc_id, sum(s) + 1.0 as score from asked join bm using (term) join allowed using (doc_id)
             group by query_id, doc_id)
select query_id, doc_id, round(score, 6) as score, row_number() over (partition by query_id order by round(score, 9) desc, doc_id) as rank
from hit where exists (select 1 from need n join post p on p.term = n.term where n.query_id = hit.query_id and p.doc_id = hit.doc_id)
qualify rank <= {HITS}
"""


def _expanded() -> str:
    ascii_only = r"regexp_replace(term, '[^\x00-\x7F]', '#', 'g')"
    tests = {
        "wildcard": r"regexp_full_match(term, '(?s)t.e.*n')",
        "tail": "ends_with(term, 'ing')",
        "fuzzy": f"damerau_levenshtein({ascii_only}, 'thier') <= 2",
        "fuzzy_one": f"damerau_levenshtein({ascii_only}, 'attoin') <= 1",
        "range": "term between 'la' and 'le'",
        "prefix": "starts_with(term, 'an')",
    }
    parts = [f"select distinct doc_id, cast(1.0 as double) as score, {_q(k)} as kind from post where {t}" for k, t in tests.items()]
    return f"with {TITLE_TOKENS} {' union all '.join(parts)}"


def _phrase_scores(terms: list[str], boost: float) -> str:
    joins = " and ".join(f"ts[i + {k}] = {_q(t)}" for k, t in enumerate(terms))
    weights = " + ".join(f"(select ln(1 + (n - df + 0.5) / (df + 0.5)) from df, stat where term = {_q(t)})" for t in terms)
    return f"""
select doc_id, {boost} * ({weights}) * (f / (f + {_K1} * (1 - {_B} + {_B} * doc_len / avg_len))) as s
from (select doc_id, len(list_filter(range(1, len(ts) - {len(terms) - 2}), lambda i: {joins})) as f from toks) join lens using (doc_id), stat
where f > 0"""


SEARCH_BODY_PHRASE = f"""
with {TEXT_TOKENS}, {BM25},
     parts as ({_phrase_scores(['of', 'the'], 1.0)} union all {_phrase_scores(['and', 'of', 'the'], 2.0)}
               union all select doc_id, s from bm where term = 'to')
select doc_id, round(sum(s), 6) as score from parts group by doc_id
"""
INDEX_SEGMENTS = f"""
with titled as (
  select cast(page_id as varchar) as doc_id,
         case when page_id % 10 = 1 then {TITLE} || ' the changed one' else {TITLE} end as title
  from pages where not (page_id % 3 <> 0 and page_id % 5 = 2)),
toks as (select doc_id, regexp_extract_all(lower(title), {TOK}, 0) as ts from titled),
lens as (select doc_id, cast(len(ts) as bigint) as doc_len from toks where len(ts) > 0),
post as (select doc_id, term, count(*) as tf from (select doc_id, unnest(ts) as term from toks) group by doc_id, term),
{BM25},
hit as (select doc_id, round(sum(case when term = 'changed' then 2 * s else s end), 6) as score from bm where term in ('the', 'changed') group by doc_id)
select doc_id, score, way from hit, (values ('segments'), ('merged')) w(way)
"""


def _crawl_rounds(rounds: int) -> str:
    """Rounds unrolled: what waits, what is taken, what is found on the taken pages and new."""
    start = f"q0 as (select url, queue_rank, 0 as round, seq, {{none}} as place from waiting)".format(none="0")
    steps = [start, "v0 as (select url from visited)", "known0 as (select url from q0 union select url from v0)"]
    for k in range(1, rounds + 1):
        steps.append(
            f"t{k} as (select url, row_number() over (order by queue_rank, round, seq, url) as turn from q{k - 1} qualify turn <= {ROUND_SIZE})"
        )
        place = "cast(turn as bigint) * 4294967296 + kind * 2147483648 + pos"
        steps.append(
            f"""n{k} as (select dst as url, min({place}) as seq from edges join t{k} on {_quoted('edges.src')} = {_quoted('t' + str(k) + '.url')}
             where dst not in (select url from known{k - 1}) group by dst)"""
        )
        steps.append(
            f"""q{k} as (select * from q{k - 1} where url not in (select url from t{k})
             union all select url, {RANK.format(u='url')}, {k}, seq, 0 from n{k})"""
        )
        steps.append(f"known{k} as (select url from known{k - 1} union select url from n{k})")
    taken = " union all ".join(
        ["select url, 'visited' as state, cast(0 as bigint) as round from v0"]
        + [f"select url, 'visited', cast({k} as bigint) from t{k}" for k in range(1, rounds + 1)]
    )
    return f"with {EDGES}, {_SPLIT}, {', '.join(steps)} {taken} union all select url, 'queued', cast(round as bigint) from q{rounds}"


ORACLE: dict[str, str] = {
    "page_documents": PAGE_DOCUMENTS,
    "page_sections": PAGE_SECTIONS,
    "page_sections_count": PAGE_SECTIONS_COUNT,
    "page_remainder": _remainder(),
    "breadcrumbs": BREADCRUMBS,
    "clean_names": CLEAN_NAMES,
    "gazetteer": GAZETTEER,
    "heading_counts": HEADING_COUNTS,
    "top_headings": TOP_HEADINGS,
    "headline_counts": HEADLINE_COUNTS,
    "heading_text": HEADING_TEXT,
    "absolute_links": ABSOLUTE_LINKS,
    "link_graph": LINK_GRAPH,
    "link_graph_https": LINK_GRAPH_HTTPS,
    "frontier_resume": FRONTIER_RESUME,
    "infobox_missing": INFOBOX_MISSING,
    "search_range_open": SEARCH_RANGE_OPEN,
    "search_fuzzy_one": _constant(r"damerau_levenshtein(regexp_replace(term, '[^\x00-\x7F]', '#', 'g'), 'thier') <= 1"),
    "search_group": SEARCH_GROUP,
    "search_keyword_tail": _keyword_search(),
    "search_late_word": SEARCH_LATE_WORD,
    "search_live_vs_stored": SEARCH_LIVE_VS_STORED,
    "full_documents": _full_documents(),
    "dump_round_trip": INFOBOX_MAP,
    "gazetteer_round_trip": GAZETTEER_ROUND_TRIP,
    "keywords_round_trip": KEYWORDS_ROUND_TRIP,
    "page_files_round_trip": PAGE_FILES_ROUND_TRIP,
    "state_round_trip": STATE_ROUND_TRIP,
    "result_counts": RESULT_COUNTS,
    "queue_classes": QUEUE_CLASSES,
    "url_keys": URL_KEYS,
    "seed_frontier": SEED_FRONTIER,
    "frontier_next": FRONTIER_NEXT,
    "frontier_add": FRONTIER_ADD,
    "frontier_round": FRONTIER_ROUND,
    "frontier_reconcile": FRONTIER_RECONCILE,
    "frontier_dedup": FRONTIER_DEDUP,
    "infobox_pairs": INFOBOX_PAIRS,
    "infobox_map": INFOBOX_MAP,
    "semi_gazetteer": SEMI_GAZETTEER,
    "postings": POSTINGS,
    "title_positions": TITLE_POSITIONS,
    "keyword_postings": KEYWORD_POSTINGS,
    "term_statistics": TERM_STATISTICS,
    "field_statistics": FIELD_STATISTICS,
    "search_term": _sum_query(TEXT_TOKENS, [("the", 1.0)]),
    "search_bool": _sum_query(
        TEXT_TOKENS, [("the", 1.0), ("and", 1.0), ("ing", 2.0)], f"{_has('the')} and {_has('and')}"
    ),
    "search_not": _sum_query(TEXT_TOKENS, [("the", 1.0), ("in", 1.0)], f"not {_has('and')}"),
    "search_topk": _sum_query(TEXT_TOKENS, [("the", 1.0), ("la", 1.0), ("und", 1.0)])
    + f" order by round(hit.score, 9) desc, doc_id limit {HITS}",
    "search_wildcard": _constant(r"regexp_full_match(term, '(?s)t.e.*n')"),
    "search_fuzzy": _constant(r"damerau_levenshtein(regexp_replace(term, '[^\x00-\x7F]', '#', 'g'), 'thier') <= 2"),
    "search_range": _constant("term >= 'la' and term <= 'le'"),
    "search_prefix": _sum_query(
        TITLE_TOKENS,
        [("the", 1.0)],
        "doc_id in (select doc_id from titled where starts_with(link, 'https://'))",
        "1.0",
    ),
    "search_phrase": SEARCH_PHRASE,
    "search_phrase_or_term": SEARCH_PHRASE_OR_TERM,
    "search_keyword": _keyword_search(),
    "search_category": SEARCH_CATEGORY,
    "hit_titles": HIT_TITLES,
    "hit_fields": HIT_FIELDS,
    "search_batch_counts": SEARCH_BATCH_COUNTS,
    "search_batch": SEARCH_BATCH,
    "keyword_list": KEYWORD_LIST,
    "title_phrase_join": TITLE_PHRASE_JOIN,
    "phrases_of_any_length": PHRASES_OF_ANY_LENGTH,
    "enrich": f"with {_BOXES} {_COPIES}",
    "enrich_replace": f"with {_BOXES} {_COPIES} union all {_KEPT}",
    "enrich_merge": f"with {_BOXES} {_MERGED} union all {_KEPT}",
    "delete_by_id": "select doc_id, n_chars from documents where doc_id not in (select doc_id from labels where toxic = 1)",
    "dense_ids": "select md5(url) as doc_id, row_number() over (order by md5(url)) - 1 as n from pages",
    "macro_recall": MACRO_RECALL,
    "average_precision": AVERAGE_PRECISION,
    "evaluate_keywords": EVALUATE_KEYWORDS,
    "page_store": PAGE_STORE,
    "listed_sections": PAGE_SECTIONS_COUNT,
    "seed_list": SEED_LIST,
    "state_json_round_trip": STATE_JSON_ROUND_TRIP,
    "state_or_seeds": STATE_OR_SEEDS,
    "empty_pages": EMPTY_PAGES,
    "search_batch_prefix": SEARCH_BATCH_PREFIX,
    "search_dictionary": _expanded(),
    "search_body_phrase": SEARCH_BODY_PHRASE,
    "index_segments": INDEX_SEGMENTS,
    "crawl_rounds": _crawl_rounds(3),
}
