"""The queries of ``queries.py`` as plain SQL over the same tables, written independently."""

from __future__ import annotations

_EVENTS = """
revisions as (
  select distinct user_id as article, date_trunc('day', ts)::timestamp as rev_id,
         date_trunc('day', ts)::timestamp as ts from events),
links as (
  select user_id as article, date_trunc('day', ts)::timestamp as rev_id, event_type as target,
         count(*) as cnt from events group by 1, 2, 3)
"""

_ORDERS = """
revisions as (
  select o_custkey as article, o_orderkey as rev_id, o_orderdate::timestamp as ts from orders),
links as (
  select o_custkey as article, o_orderkey as rev_id, p_brand as target, count(*) as cnt
  from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey
  group by 1, 2, 3)
"""

_RUNS = """,
s as (
  select *, row_number() over w as seq, lead(ts) over w as next_ts
  from revisions window w as (partition by article order by ts, rev_id)),
j as (
  select s.article, l.target, l.cnt, s.ts, s.next_ts,
         seq - row_number() over (partition by s.article, l.target, l.cnt order by seq) as grp
  from s join links l using (article, rev_id)),
closed as (
  select article, target, cnt, min(ts) as valid_from, max(next_ts) as valid_to
  from j group by article, target, cnt, grp having count(*) = count(next_ts))
"""

_CLOSED = "select article, target, cnt, valid_from, valid_to from closed"

_CHANGES = """,
s as (
  select *, lead(rev_id) over w as next_rev, lead(ts) over w as next_ts
  from revisions window w as (partition by article order by ts, rev_id)),
now_ as (select s.article, s.ts, l.target, l.cnt from s join links l using (article, rev_id)),
before_ as (
  select s.article, s.next_ts as ts, l.target, l.cnt
  from s join links l using (article, rev_id) where s.next_rev is not null)
"""

_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
_ANCHOR = "<a [^>]*>([^<]*)</a>"

_PAGE_TARGETS = f"""
targets as (
  select page_id, target, count(*) as anchors
  from (select page_id, unnest(regexp_extract_all(html, '{_ANCHOR}', 1)) as target from pages)
  where target not like 'User:%' and target not like 'User talk:%' and target not like 'Talk:%'
    and target not like '/%' and length(target) < 256 and target <> ''
  group by 1, 2),
counted as (
  select page_id, target, anchors,
         cast((length(rest) - length(replace(rest, target, ''))) / length(target) as bigint) as mentions
  from targets
  join (select page_id, regexp_replace(html, '{_ANCHOR}', '', 'g') as rest from pages)
  using (page_id))
"""

_PAGE_TEXTS = f"""
page_texts as (
  select page_id, page_id % 10 <> 9 as whole,
         case page_id % 4 when 0 then '' when 1 then 'Category:' when 2 then 'File:'
              else 'Template:' end || {_TITLE} as title,
         case when page_id % 5 = 0
              then '#REDIRECT [[' || {_TITLE} || ']]'
              else html end as text
  from pages)
"""

_PARSED = """
select case when whole then title else '' end as title,
       md5(case when whole then text else '' end) as text_md5,
       whole and page_id % 4 = 1 as is_category,
       whole and page_id % 4 = 2 as is_file,
       whole and page_id % 4 = 3 as is_template
"""

_REDIRECTS = f"""
with {_PAGE_TEXTS},
found as (
  select title as page_title,
         trim(regexp_extract(text, '(?i)^\\s*#redirect\\s*:?\\s*\\[\\[([^\\]|#]+)', 1)) as redirect_title
  from page_texts where whole and page_id % 4 = 0)
select page_title, redirect_title from found where redirect_title <> ''
"""

_CONVERSATIONS = """
conv as (
  select 'R&D ' || conv_id as article, conv_id, turn as rev_id, role, text as body,
         timestamp '2020-01-01 00:00:00' + to_minutes(turn) as ts,
         regexp_extract(text, '^[^\\s\\[\\]|#]+', 0) as word,
         '[[' || regexp_extract(text, '^[^\\s\\[\\]|#]+', 0) || ']] [[' || role || '|by]] [[User:'
           || role || ']] ' || text as text
  from conversations)
"""


_PLAIN_TEXTS = f"""
page_texts as (
  select page_id, true as whole,
         case page_id % 4 when 0 then '' when 1 then 'Category:' when 2 then 'File:'
              else 'Template:' end || {_TITLE} as title, html as text
  from pages)
"""

_HISTORY = """
        select article, (seq - 1) // 10 as part, (seq - 1) // 10 * 10 + 1 as first_pos,
               least((seq - 1) // 10 * 10 + 10, n) as last_pos, seq as pos, ts,
               cast(row_number() over (partition by article, rev_id order by target, cnt) - 1 as integer)
                 as link_at, target, cnt
        from (select *, row_number() over (partition by article order by ts, rev_id) as seq,
                     count(*) over (partition by article) as n from revisions)
        join links using (article, rev_id)"""

# Links of the pages with anchors of five kinds, told from the plain anchors they are made of.
_WILD = f"""
plain as (
  select page_id, html, {_TITLE} as page_title,
         unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) as label
  from pages),
wild as (
  select page_id, page_title, html, case page_id % 5 when 3 then 'Talk:' || label else label end as target
  from plain where page_id % 5 in (0, 1, 3))
"""


def _graph(where: str = "") -> str:
    return f"""with {_CONVERSATIONS},
        revisions as (select article, rev_id, ts from conv where conv_id % 7 <> 0 {where}),
        linked as (
          select article, rev_id, text, unnest([word, role]) as target from conv
          where conv_id % 7 <> 0 {where}),
        links as (
          select article, rev_id, target, count(*) + any_value(cast(
                   (length(rest) - length(replace(rest, target, ''))) / length(target) as bigint)) as cnt
          from (select *, regexp_replace(text, '\\[\\[[^\\[\\]]*\\]\\]', '', 'g') as rest
                from linked where target <> '')
          group by 1, 2, 3)
        {_RUNS} {_CLOSED}"""


def _delta(body: str) -> str:
    return f"with {_EVENTS} {_CHANGES} {body}"


ORACLES = {
    "temporal_edges": f"with {_EVENTS} {_RUNS} {_CLOSED}",
    "temporal_edges_arrays": f"with {_EVENTS} {_RUNS} {_CLOSED}",
    "edge_sink_roundtrip": f"with {_EVENTS} {_RUNS} {_CLOSED}",
    "temporal_edges_orders": f"with {_ORDERS} {_RUNS} {_CLOSED}",
    "temporal_edges_open": f"""with {_EVENTS} {_RUNS}
        select article, target, cnt, min(ts) as valid_from,
               case when count(*) = count(next_ts) then max(next_ts) end as valid_to
        from j group by article, target, cnt, grp""",
    "temporal_edges_hot": f"with {_EVENTS} {_RUNS} {_CLOSED}",
    "edge_lines": f"""with {_EVENTS} {_RUNS}
        select article, '[' || strftime(valid_from, '%Y-%m-%dT%H:%M:%S') || ','
               || strftime(valid_to, '%Y-%m-%dT%H:%M:%S') || '] ' || target || ' ' || cnt as line
        from closed""",
    "edge_text_sink": f"""with {_EVENTS} {_RUNS}
        select article || chr(9) || '[' || strftime(valid_from, '%Y-%m-%dT%H:%M:%S') || ','
               || strftime(valid_to, '%Y-%m-%dT%H:%M:%S') || '] ' || target || ' ' || cnt as value
        from closed""",
    "edge_article_sink": f"""with {_EVENTS} {_RUNS}
        select article || chr(9) || '[' || strftime(valid_from, '%Y-%m-%dT%H:%M:%S') || ','
               || strftime(valid_to, '%Y-%m-%dT%H:%M:%S') || '] ' || target || ' ' || cnt as value
        from closed""",
    "edge_article_manifest": f"""with {_EVENTS} {_RUNS}
        select cast(article as varchar) as file_key, article, count(*) as n_rows from closed group by article""",
    "revision_order": f"""with {_EVENTS}
        select article, ts, row_number() over w as seq, lead(ts) over w as next_ts
        from revisions window w as (partition by article order by ts, rev_id)""",
    "revisions_grouped": f"""with {_EVENTS}
        select article, count(*) as n_revisions, min(ts) as first_ts, max(ts) as last_ts
        from revisions group by article""",
    "article_history": f"with {_EVENTS} {_HISTORY}",
    "article_history_hot": f"with {_EVENTS} {_HISTORY}",
    "link_changes_hot": _delta("""
        select *, 'kept' as change from (select * from now_ intersect select * from before_)
        union all select *, 'removed' from (select * from before_ except select * from now_)
        union all select *, 'added' from (select * from now_ except select * from before_)"""),
    "delta_kept": _delta("select * from now_ intersect select * from before_"),
    "delta_removed": _delta("select * from before_ except select * from now_"),
    "delta_added": _delta("select * from now_ except select * from before_"),
    "delta_merged": _delta("select * from now_"),
    "link_delta": _delta("""
        , c as (
          select *, 'kept' as name from (select * from now_ intersect select * from before_)
          union all select *, 'removed' from (select * from before_ except select * from now_)
          union all select *, 'added' from (select * from now_ except select * from before_)
          union all select *, 'merged' from now_),
        every as (select article, ts, unnest(['kept', 'removed', 'added', 'merged']) as name from revisions)
        select every.article, every.ts, every.name,
               case when target is not null then cast(row_number() over (
                 partition by every.article, every.ts, every.name order by target, cnt) - 1 as integer) end as at,
               target, cnt
        from every left join c using (article, ts, name)"""),
    "distinct_links": f"""with {_EVENTS}
        select article, target, cnt, min(rev_id) as valid_from from links group by 1, 2, 3""",
    "min_ts_filter": f"""with {_EVENTS}
        select article, ts from revisions where ts > timestamp '2024-01-10 00:00:00'""",
    "links_flat": f"""
        select page_title, target, cast(1 as integer) as cnt
        from (select {_TITLE} as page_title, unnest(regexp_extract_all(html, '{_ANCHOR}', 1)) as target
              from pages)
        where target not like 'User:%' and target not like 'User talk:%'""",
    "links_strict": f"""
        select page_id, target from (
          select page_id, case page_id % 4 when 0 then '' when 1 then 'User:' when 2 then 'Talk:'
                          else '/' end || unnest(regexp_extract_all(html, '{_ANCHOR}', 1)) as target
          from pages)
        where target not like 'User:%' and target not like 'User talk:%' and target not like 'Talk:%'
          and target not like '/%' and length(target) < 256 and target <> ''""",
    "link_anchor_counts": f"with {_PAGE_TARGETS} select page_id, target, anchors as cnt from counted",
    "link_mention_counts": f"with {_PAGE_TARGETS} select page_id, target, mentions from counted",
    "link_mention_counts_text": f"""with {_PAGE_TARGETS}
        select page_id, target,
               cast((length(plain) - length(replace(plain, target, ''))) / length(target) as bigint)
                 as mentions
        from counted
        join (select page_id, regexp_replace(regexp_replace(html, '{_ANCHOR}', '', 'g'), '<[^>]*>', '', 'g')
                as plain from pages)
        using (page_id)""",
    "link_total_counts": f"""with {_PAGE_TARGETS}
        select page_id, target, anchors + mentions as cnt from counted""",
    "page_links_grouped": f"""with {_PAGE_TARGETS}
        select {_TITLE} as title,
               case when target is not null then cast(row_number() over (
                 partition by pages.page_id order by encode(target)) - 1 as integer) end as at,
               target, anchors + mentions as cnt
        from pages left join counted on counted.page_id = pages.page_id and pages.page_id % 10 <> 9""",
    "links_title": f"""with {_WILD}
        select page_title, target, cast(1 as integer) as cnt from wild
        where target not like 'User:%' and target not like 'User talk:%'""",
    "link_title_counts": f"""with {_WILD},
        targets as (
          select page_id, target, count(*) as anchors, any_value(html) as html from wild
          where target not like 'User:%' and target not like 'User talk:%' and target not like 'Talk:%'
            and target not like '/%' and length(target) < 256 and target <> ''
          group by 1, 2),
        counted as (
          select page_id, target, anchors, cast((length(rest) - length(replace(rest, target, ''))) / length(target)
                   as bigint) as mentions
          from (select *, regexp_replace(html, '<a href="[^"]*">[^<]*</a>', '', 'g') as rest from targets))
        select page_id, target, anchors, mentions, anchors + mentions as cnt from counted""",
    # Of the six forms only the first, second and last are links; the others stay in the text, as they are.
    "link_html_counts": """
        with plain as (
          select page_id, html, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) as label from pages),
        links as (
          select page_id, html, label || case page_id % 6 when 1 then '>x' else '' end as target
          from plain where page_id % 6 in (0, 1, 5)),
        targets as (
          select page_id, target, count(*) as anchors, any_value(html) as html from links
          where not regexp_matches(target, '^(User:|User talk:|Talk:|/)') and length(target) < 256 and target <> ''
          group by 1, 2),
        counted as (
          select page_id, target, anchors, cast((length(rest) - length(replace(rest, target, ''))) / length(target)
                   as bigint) as mentions
          from (select *, case when page_id % 6 = 5
                  then regexp_replace(html, '<a href="[^"]*">([^<]*)</a>', '<style>/* <a title="\\1">z</a> */</style>', 'g')
                  else regexp_replace(html, '<a href="[^"]*">[^<]*</a>', '', 'g') end as rest from targets))
        select page_id, target, anchors, mentions, anchors + mentions as cnt from counted""",
    "wikitext_hidden": """
        select conv_id, turn, target, cast(1 as bigint) as anchors, mentions, 1 + mentions as cnt from (
          select conv_id, turn, role as target, cast((length(rest) - length(replace(rest, role, ''))) / length(role)
                   as bigint) as mentions
          from (select conv_id, turn, role, ' <nowiki>' || role || '</nowiki>  [[Open and ' || role as rest
                from conversations))""",
    "title_entities": f"""
        select page_id, replace(replace({_TITLE}, '&quot;', '"'), '&amp;', '&') as title from pages""",
    "file_keys": f"select page_id, regexp_replace({_TITLE}, '\\s', '', 'g') as file_key from pages",
    "page_slice": "select page_id, url from pages order by page_id limit 20 offset 10",
    "page_parse": f"with {_PAGE_TEXTS} {_PARSED}, page_id from page_texts",
    "dump_pages": f"with {_PLAIN_TEXTS} {_PARSED} from page_texts",
    "page_redirects": _REDIRECTS,
    "redirect_table": _REDIRECTS,
    "page_split": f"""
        select n, n || '-' || title || '.xml' as page_file, md5(html) as block_md5
        from (select row_number() over (order by page_id) - 1 as n, {_TITLE} as title, html
              from pages)""",
    "tag_blocks": """
        with lines as (
          select page_id, page_id // 100 as part, replace(html, chr(10), ' ') as line,
                 coalesce(sum(strlen(html) + 1) over (partition by page_id // 100
                   order by page_id rows between unbounded preceding and 1 preceding), 0) as before
          from pages),
        pieces as (
          select part, before, string_split(line, '</li>') as p from lines),
        numbered as (
          select part, before, p, unnest(range(1, len(p))) as k from pieces)
        select part, substr(p[k], instr(p[k], '<li>')) || '</li>' as block,
               cast(before + coalesce(list_sum(list_transform(p[1 : k - 1], lambda x: strlen(x) + 5)), 0)
                 + strlen(substr(p[k], 1, instr(p[k], '<li>') - 1)) as bigint) as offset
        from numbered where contains(p[k], '<li>')""",
    "dump_revisions": f"""with {_CONVERSATIONS}
        select article, rev_id, ts, md5(text) as text_md5 from conv where conv_id % 7 <> 0""",
    "wikitext_links": f"""with {_CONVERSATIONS}
        select article as page_title, word as target, cast(1 as integer) as cnt from conv
        where word <> ''
        union all select article, role, 1 from conv""",
    "evolving_graph": _graph(),
    "evolving_graph_cutoff": _graph("and ts > timestamp '2020-01-01 00:01:00'"),
    "page_link_extract": f"""with {_PLAIN_TEXTS}, {_PAGE_TARGETS}
        select title, case when target is not null then cast(row_number() over (
                 partition by page_texts.page_id order by encode(target)) - 1 as integer) end as at,
               target, anchors + mentions as cnt
        from page_texts left join counted using (page_id)""",
    "flat_link_list": f"""with {_PLAIN_TEXTS}
        select page_title, target, cast(1 as integer) as cnt
        from (select title as page_title, unnest(regexp_extract_all(text, '{_ANCHOR}', 1)) as target
              from page_texts where whole)
        where target not like 'User:%' and target not like 'User talk:%'""",
}
