"""The operators' registered queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, collocations, html_text, licences, mixing, neardup, pii, quality, token_counts, url_rules,
               variants, vectors)
from .common import literal_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public vocabulary file, the same on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


#: Target weights of the mix: the largest source is held to a fifth, the
#: others share the rest in proportion to their rows.
WEIGHTS = {"src0": 0.2}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the mix of sources."""
    return mixing.schedule(table(spark, sf_dir, "documents"), WEIGHTS)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and the risk-controlled verdict."""
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, 0.85."""
    return neardup.groups(table(spark, sf_dir, "documents"), width=3, percent=85).drop("n_links")


def op4_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best rows by inner product for each vec_id divisible by 100."""
    return vectors.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base matches and the field's spans."""
    return pii.find(table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that says control strings, read back."""
    text = r"\### Assistant: </turn> ok"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = literal_rows(spark, [(-7, 0, "user", text), (-7, 1, "assistant", text)],
                           ("conv_id", "turn", "role", "text")).withColumns(
        {c: F.col(c).cast("long") for c in ("conv_id", "turn")})
    return chat.digests(chat.format_conversations(given.unionByName(planted)))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every document."""
    return licences.scan(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram of encoded lengths of all documents, with suffix sums."""
    return token_counts.report(table(spark, sf_dir, "documents"), vocabulary_path())


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.encode_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, their forms and roots."""
    return variants.group(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language over all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_quality": op2_quality,
    "op3_neardup": op3_neardup,
    "op4_search": op4_search,
    "op5_pii": op5_pii,
    "op6_chat": op6_chat,
    "op7_html": op7_html,
    "op8_licences": op8_licences,
    "op9_token_counts": op9_token_counts,
    "op10_bpe": op10_bpe,
    "op11_variants": op11_variants,
    "op12_collocations": op12_collocations,
    "op13_urls": op13_urls,
}


def _op2_sql() -> str:
    w = quality.WINDOW
    limits = quality.LIMITS
    tests = ", ".join(f"({i}, {c}::double)" for i, c in enumerate(quality.CUTOFFS))
    upper = f"length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))"
    return rf"""
with base as (
  select doc_id, lang, row_number() over () as rid, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents),
wins as (
  select rid, i, list_slice(ws, i, i + {w - 1}) as win
  from (select rid, ws, unnest(range(1, len(ws) - {w - 2})) as i from base)),
places as (
  select distinct rid, unnest(range(i, i + {w})) as p
  from (select rid, i, count(*) over (partition by rid, win) as n from wins) where n > 1),
again as (select rid, count(*) as n from places group by rid),
split_lines as (
  select rid, count(*) as n, count(distinct line) as kinds
  from (select rid, unnest(string_split(t, chr(10))) as line from base)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid),
counted as (
  select b.rid, doc_id, lang, len(ws)::bigint as n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         coalesce(s.n - s.kinds, 0)::bigint as n_dup_lines, coalesce(s.n, 0) as n_lines,
         coalesce(a.n, 0)::bigint as n_repeat_words,
         {upper} as n_upper, length(t) - length(replace(t, '!', '')) as n_bangs
  from base b left join split_lines s using (rid) left join again a using (rid)),
scored as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
         greatest(
           case when word_chars > 0 then n_symbols::double / word_chars / {limits["symbols"]}::double else 0 end,
           case when n_lines > 0 then n_dup_lines::double / n_lines / {limits["dup_lines"]}::double else 0 end,
           case when n_words > 0 then n_repeat_words::double / n_words / {limits["repeat_words"]}::double else 0 end,
           case when word_chars > 0 then n_upper::double / word_chars / {limits["upper"]}::double else 0 end,
           case when n_words > 0 then n_bangs::double / n_words / {limits["bangs"]}::double else 0 end) as risk
  from counted),
labelled as (
  select lang, risk, quality > 0 as good from scored join labels using (doc_id) where quality is not null),
tested as (
  select lang, step, cutoff, count(*) filter (good) as n,
         count(*) filter (good and risk > cutoff) as k,
         count(*) filter (not good and risk > cutoff) as caught
  from labelled, (values {tests}) as c(step, cutoff) group by lang, step, cutoff),
tail as (
  select *, list_sum(list_transform(range(0, k + 1), lambda i:
           exp(case when n = 0 then 0 else lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) end
               + i * ln({quality.ALPHA}) + (n - i) * ln(1 - {quality.ALPHA})))) as p,
         (select count(distinct coalesce(lang, '')) from labelled) as strata
  from tested),
safe as (
  select *, bool_and(p <= {quality.DELTA} / strata) over (partition by lang order by step) as ok from tail),
chosen as (
  select lang, cutoff from safe where ok
  qualify row_number() over (partition by lang order by caught - k desc, step) = 1)
select s.doc_id, s.lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, risk, cutoff,
       not base_failed and (cutoff is null or risk <= cutoff) as kept
from scored s left join chosen c on s.lang is not distinct from c.lang
"""


def _op3_sql() -> str:
    return r"""
with recursive base as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
shingles as (
  select distinct doc_id, case when len(ws) < 3 then ws else list_slice(ws, i, i + 2) end as s
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) as i from base where len(ws) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach as (
  select doc_id as a, doc_id as b from documents
  union select r.a, l.b from reach r join links l on l.a = r.b),
least_of as (select a, min(b) as c from reach group by a)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, c as component_id, d.doc_id = c as kept
from documents d left join sizes using (doc_id) join least_of on a = d.doc_id
"""


def _op4_sql() -> str:
    return f"""
with given as (
  select vec_id, list_transform(embedding, lambda x: floor({vectors.SCALE} * x::double)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from given q join given c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0)
select query_id, rank::integer as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 10
"""


def _op8_sql() -> str:
    between = licences.BETWEEN
    sets = licences.template_words(licences.TEMPLATES)
    templates = ", ".join(f"('{label}', {ws!r})" for label, ws in sets.items())
    phrases = ", ".join(f"({p.split()!r}, '{label}')" for p, label in licences.PHRASES.items())
    return rf"""
with base as (
  select row_number() over () as rid, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
worded as (
  select *, list_filter(regexp_split_to_array(t, '{between}'), lambda w: w <> '') as ws from base),
phrases(p, label) as (values {phrases}),
hits as (
  select rid, label, i - 1 as pos
  from (select rid, ws, unnest(range(1, len(ws) + 1)) as i from worded), phrases
  where list_slice(ws, i, i + len(p) - 1) = p),
base_hits as (
  select rid, count(*) as n, min(pos) as lo, max(pos) as hi, list_distinct(list(label)) as labels from hits group by rid),
blocks as (
  select rid, list_distinct(regexp_split_to_array(unnest(regexp_split_to_array(t, '{licences.BLANK}')), '{between}')) as b
  from base),
templates(label, w) as (values {templates}),
met as (
  select rid, list_distinct(list(label)) as labels, max(len(list_intersect(b, w))::double / len(w)) as score
  from blocks, templates where 100 * len(list_intersect(b, w)) >= {licences.CONTAINED} * len(w) group by rid)
select doc_id, len(ws)::bigint as n_words, coalesce(n, 0)::bigint as n_base, lo::bigint as first_word,
       hi::bigint as last_word, coalesce(array_to_string(list_sort(h.labels), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(h.labels, m.labels))), ','), '') as labels,
       coalesce(score, 0)::double as score
from worded d left join base_hits h using (rid) left join met m using (rid)
"""


def _op6_sql() -> str:
    def esc(x: str) -> str:
        return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"

    # Each turn adds its text, and either the marks of a new block or a separator.
    new = len(chat.OPEN) + len(chat.HEAD_END) + len(chat.END)
    return rf"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
ordered as (
  select *, lag(role) over (partition by conv_id order by turn nulls first, role, text) as before from given)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = '{chat.ASSISTANT}'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text)
                       filter (role = '{chat.ASSISTANT}'), '')) as loss_sha256,
       sum(length({esc("text")}) + case when before is not distinct from role then {len(chat.MORE)}
           else length({esc("role")}) + {new} end)::bigint as formatted_chars
from ordered group by conv_id
"""


def _op11_sql() -> str:
    # The checksum goes bit by bit, the lowest first; a letter is one or two bytes of UTF-8.
    letters = "A-Za-z" + chr(0xC0) + "-" + chr(0xFF)
    return rf"""
with recursive runs as materialized (
  select coalesce(doc_id::varchar, '') as d, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run,
         count(*) as c
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[{letters}]+')) as run from documents)
  where length(run) >= {variants.LETTERS} group by 1, 2),
hashed as (
  select run, c, xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
           flatten(list_transform(string_split(d || ':' || run, ''),
             lambda x: case when unicode(x) < 128 then [unicode(x)] else [192 | (unicode(x) >> 6), 128 | (unicode(x) & 63)] end)),
           lambda x: list_transform(range(8), lambda i: ((x >> i::integer) & 1)::bigint)))),
         lambda s, b: xor(s >> 1, 3988292384 * xor(s & 1, b))), 4294967295::bigint) as h
  from runs),
slipped as (
  select case when h % {variants.SLIP} = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word, c
  from hashed),
counted as materialized (
  select word, sum(c)::bigint as n from slipped where length(word) >= {variants.LETTERS} group by word
  having sum(c) >= {variants.OCCURRENCES}),
cuts as materialized (
  select word, n, i, word[:i - 1] as head, word[i + 1:] as tail
  from (select word, n, unnest(range(1, length(word) + 1)) as i from counted)),
pairs as (
  select a.word, b.word as near, b.n as near_n from cuts a join cuts b
    on a.i = b.i and a.head = b.head and a.tail = b.tail and a.word <> b.word
  union select a.word, b.word, b.n from cuts a join counted b on b.word = a.head || a.tail
  union select b.word, a.word, a.n from cuts a join counted b on b.word = a.head || a.tail),
nears as (
  select word, count(*) as n_near, max(near_n) as best_n,
         arg_min(near, (-near_n, near)) as best from pairs group by word),
judged as (
  select c.word, n, coalesce(n_near, 0)::bigint as n_near,
         case when best_n >= {variants.RATIO} * n then best end as form,
         case when best_n >= {variants.RATIO} * n then best_n end as form_n
  from counted c left join nears using (word)),
ways as (
  select word, word as root from judged
  union all select w.word, j.form from ways w join judged j on j.word = w.root where j.form is not null)
select word, form, root, n, n_near, form_n from ways join judged using (word)
where root in (select word from judged where form is null)
"""


def _op12_sql() -> str:
    c = collocations
    return rf"""
with pieces as (
  select lang, row_number() over () as p, regexp_extract_all(piece, '[^\x20\x09]+') as ws
  from (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece
        from (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') as t from documents))),
starts as (
  select lang, w, lead(w) over z as w2, lead(w, 2) over z as w3
  from (select lang, p, unnest(ws) as w, generate_subscripts(ws, 1) as i from pieces)
  window z as (partition by p order by i)),
f as materialized (
  select lang, 1 as size, w as phrase, count(*) as f from starts group by all
  union all select lang, 2, w || ' ' || w2, count(*) from starts where w2 is not null group by all
  union all select lang, 3, w || ' ' || w2 || ' ' || w3, count(*) from starts where w3 is not null group by all),
totals as (select lang, sum(f)::bigint as n from f where size = 1 group by lang),
candidates as (select * from f where size > 1 and f >= {c.OCCURRENCES}),
cut as (
  select lang, size, phrase, f, k, array_to_string(string_split(phrase, ' ')[:k], ' ') as head,
         array_to_string(string_split(phrase, ' ')[k + 1:], ' ') as tail
  from candidates, (values (1), (2)) x(k) where k < size),
scored as (
  select cut.*, x.f as l, y.f as r, (1000000::hugeint * cut.f * cut.f // (x.f::hugeint * y.f))::bigint as score
  from cut join f x on x.lang = cut.lang and x.phrase = head join f y on y.lang = cut.lang and y.phrase = tail),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
  select lang, part, max(f) as f
  from (select lang, f, unnest([array_to_string(string_split(phrase, ' ')[:2], ' '),
                                array_to_string(string_split(phrase, ' ')[2:], ' ')]) as part
        from candidates where size = 3) group by all)
select o.lang, row_number() over (partition by o.lang order by score desc, o.f desc, phrase) as rank,
       phrase, o.f as a, l, r, n, score
from lowest o join totals using (lang) left join inside i on i.lang = o.lang and i.part = o.phrase and o.size = 2
where i.f is null or 100 * i.f < {c.REPLACED} * o.f
qualify row_number() over (partition by o.lang order by score desc, o.f desc, phrase) <= {c.TOP}
"""


def _op13_sql() -> str:
    u = url_rules
    parts = "(?s)^.*?://([^/?#]*)([^?#]*)(.*)$"
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def marked(mark: str, part: str, between: str) -> str:
        return (f"list_transform(list_filter(regexp_split_to_array({low.format(part)}, '{between}'), lambda x: x <> ''), "
                f"lambda x: '{mark}' || case when regexp_full_match(x, '[0-9]+') then '#' else x end)")

    fits = " ".join(
        f"when (host = '{name}' or ends_with(host, '.{name}')) and starts_with(path, '/{rest}') then '{rule}'"
        for rule, (name, _, rest) in ((r, r.partition("/")) for r in sorted(u.RULES, key=len, reverse=True)))
    verdicts = " ".join(f"when '{rule}' then '{verdict}'" for rule, verdict in u.RULES.items())
    return rf"""
with parted as (
  select page_id, url, {low.format("regexp_extract(t, '" + parts + "', 1)")} as host, regexp_extract(t, '{parts}', 2) as path,
         regexp_extract(t, '{parts}', 3) as ending
  from (select page_id, url, coalesce(url, '') as t from pages)),
ruled as (
  select *, case {fits} end as rule, row_number() over () as row,
         list_distinct({marked("h:", "host", "[.]")} || {marked("p:", "path", "[/._-]")}
                       || {marked("q:", "ending", "[?#&=]")}) as tokens,
         try_cast(regexp_extract(path, '/([0-9]{{1,18}})([.][a-z]+)?/?$', 1) as bigint) as number
  from parted),
known as (
  select doc_id, max((coalesce(quality, 1) <= 0 or coalesce(toxic, 0) > 0)::int) = 1 as bad
  from labels where doc_id is not null and (quality is not null or toxic is not null) group by doc_id),
given as (select row, tokens, bad from ruled join known on doc_id = number),
least as (select greatest({u.SUPPORT}, ceil({u.SUPPORT_SHARE} * count(*) filter (bad)))::bigint as least from given),
exploded as (select row, bad, unnest(tokens) as token from given),
counts as (select token, count(*) filter (bad) as n_bad, count(*) as n from exploded group by token
           having count(*) filter (bad) >= (select least from least)),
items as (
  select row, token from exploded join counts using (token) where bad
  qualify row_number() over (partition by row order by n_bad::double / n desc, n_bad desc, token) <= {u.ITEMS}),
mined as (
  select [token] as tokens from items group by all having count(*) >= (select least from least)
  union all select [a.token, b.token] from items a join items b on a.row = b.row and a.token < b.token
    group by all having count(*) >= (select least from least)
  union all select [a.token, b.token, c.token] from items a join items b on a.row = b.row and a.token < b.token
    join items c on c.row = a.row and b.token < c.token group by all having count(*) >= (select least from least)),
sure as (
  select m.tokens from mined m join given g on list_has_all(g.tokens, m.tokens) group by all
  having count(*) filter (bad) >= (select least from least)
     and 100 * count(*) filter (bad) >= {u.CONFIDENCE} * count(*))
select page_id, host, path, rule,
       case rule {verdicts}
       else case when exists (select 1 from sure s where list_has_all(r.tokens, s.tokens)) then 'block' else 'allow' end
       end as verdict
from ruled r
"""


ORACLE: dict[str, str] = {
    "op2_quality": _op2_sql(),
    "op3_neardup": _op3_sql(),
    "op4_search": _op4_sql(),
    "op6_chat": _op6_sql(),
    "op8_licences": _op8_sql(),
    "op11_variants": _op11_sql(),
    "op12_collocations": _op12_sql(),
    "op13_urls": _op13_sql(),
}
