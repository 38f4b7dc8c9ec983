"""DuckDB twins of the registered queries (same keys, same column names).

The adapters of :mod:`newslake.fixtures` are restated as CTEs so both
engines start from identical rows.
"""

from __future__ import annotations

A = """articles as (
  select cast(doc_id as varchar) as id, source,
         concat('https://', source, '.example.com/', cast(doc_id as varchar), '/', lang) as url,
         lang as category,
         case when doc_id % 10 = 0 then null when doc_id % 10 = 1 then 'No title'
              else split_part(text, chr(10), 1) end as title,
         cast(null as varchar) as author,
         cast(date '2024-01-01' + cast(doc_id % 90 as integer) as date) as date,
         cast(date '2024-01-01' + cast(doc_id % 90 as integer) as timestamp) as publish_time,
         text as content, concat(lang, ',', source) as tags
  from documents)"""

E = """articles_e as (
  select cast(event_id as varchar) as id, concat('u', cast(user_id % 4 as varchar)) as source,
         event_type as category, cast(ts as date) as date
  from events)"""

V = """versions as (
  select cast(conv_id as varchar) as id, role as source, concat('turn-', cast(turn as varchar)) as url,
         cast(null as varchar) as category,
         case when role = 'user' then null else split_part(text, chr(10), 1) end as title,
         cast(null as varchar) as author, cast(null as date) as date, cast(null as timestamp) as publish_time,
         text as content, cast(null as varchar) as tags, turn as seq
  from conversations)"""

ACOLS = "id, source, url, category, title, author, date, publish_time, content, tags"

ORACLE: dict[str, str] = {}

ORACLE["src_articles_table"] = f"with {A} select * from articles"
ORACLE["src_scan"] = "select doc_id, source, n_chars from documents where lang = 'de'"
ORACLE["sql_adhoc"] = """
select c_mktsegment as grp, count(*) as n
from orders join customer on o_custkey = c_custkey
group by c_mktsegment having count(*) > 10
union all
select o_orderstatus as grp, count(*) as n from orders group by o_orderstatus"""
ORACLE["sql_params"] = """
select o_orderpriority, count(*) as n, max(o_totalprice) as max_price, min(o_totalprice) as min_price
from orders where o_orderstatus = 'F' and o_totalprice > 100000.0
group by o_orderpriority"""
ORACLE["src_csv_query"] = "select n_nationkey, n_name, n_regionkey from nation"
ORACLE["csv_category_count"] = "select n_regionkey, count(*) as count from nation group by n_regionkey"
ORACLE["sink_parquet"] = f"""with {A}
select * from articles where date >= cast((select max(date) from articles) - interval 30 day as date)"""
ORACLE["src_parquet_query"] = "select o_orderstatus, count(*) as n from orders group by o_orderstatus"

ORACLE["by_source"] = f"""with {A}
select source, count(*) as article_count, count(distinct category) as unique_categories
from articles group by source"""
ORACLE["source_comparison"] = f"""with {A}
select source, count(*) as total_articles, count(distinct category) as categories_covered,
       avg(length(content)) as avg_article_length, min(date) as earliest_article, max(date) as latest_article
from articles group by source"""
ORACLE["daily_counts"] = f"with {E} select date, source, count(*) as daily_count from articles_e group by date, source"
ORACLE["weekly_counts"] = f"""with {E}
select category, cast(date_trunc('week', date) as date) as week, count(*) as weekly_count
from articles_e group by category, cast(date_trunc('week', date) as date)"""
ORACLE["table_count"] = "select count(*) as row_count from documents"
ORACLE["date_window"] = """
select o_orderkey, cast(o_orderdate as date) as date from orders
where cast(o_orderdate as date) >= cast((select max(cast(o_orderdate as date)) from orders) - interval 365 day as date)"""
ORACLE["rolling_7"] = f"""with {E}
select date, count(*) as daily_articles,
       avg(count(*)) over (order by date rows between 6 preceding and current row) as rolling_7day_avg
from articles_e where date >= cast((select max(date) from articles_e) - interval 30 day as date)
group by date"""
ORACLE["rolling_7_by_source"] = f"""with {E}
select date, source, count(*) as daily_count,
       avg(count(*)) over (partition by source order by date rows between 6 preceding and current row) as moving_avg_7d
from articles_e where date >= cast((select max(date) from articles_e) - interval 90 day as date)
group by date, source"""
ORACLE["week_over_week"] = f"""with {E}, w as (
  select category, cast(date_trunc('week', date) as date) as week, count(*) as articles_this_week
  from articles_e where date >= cast((select max(date) from articles_e) - interval 14 day as date)
  group by 1, 2)
select category, week, articles_this_week,
       lag(articles_this_week) over (partition by category order by week) as articles_last_week,
       round(100.0::double * (articles_this_week - lag(articles_this_week) over (partition by category order by week))
             / nullif(lag(articles_this_week) over (partition by category order by week), 0)::double, 1)
         as percent_change
from w"""
ORACLE["ordered_report"] = ORACLE["daily_counts"]
ORACLE["dedupe_latest"] = f"""with {V}
select {ACOLS}, seq from (
  select *, row_number() over (partition by id order by (title is not null) desc, seq desc) as rn from versions)
where rn = 1"""
ORACLE["first_wins"] = """
select host, page_id, url from (
  select regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) as host, page_id, url,
         row_number() over (partition by regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)
                            order by page_id) as rn
  from pages)
where rn = 1"""

ORACLE["new_only"] = f"""with {A}
select * from articles where id not in (select cast(doc_id as varchar) from labels)"""
ORACLE["record_exists"] = f"""with {A}
select id, source, id in (select cast(doc_id as varchar) from labels) as exists from articles"""
ORACLE["exists_limit1"] = f"with {A} select 1 as present from articles where id = '42' limit 1"
ORACLE["distinct_ids"] = f"with {A} select distinct id from articles where source = 'src3'"
ORACLE["missing_rows"] = f"with {A} select * from articles where cast(id as bigint) % 3 = 0"

ORACLE["insert_ignore"] = f"""with {A},
tbl as (select * from articles where cast(id as bigint) % 2 = 0),
batch as (
  select *, cast(id as bigint) as seq from articles
  union all
  select id, source, url, category, 'v2' as title, author, date, publish_time, content, tags,
         cast(id as bigint) + 100000 as seq from articles where cast(id as bigint) % 5 = 0
  union all
  select id, source, url, category, 'v0' as title, author, date, publish_time, content, tags,
         cast(id as bigint) - 100000 as seq from articles where cast(id as bigint) % 7 = 0),
winners as (
  select * from (select *, row_number() over (partition by id order by seq) as rn from batch) where rn = 1)
select {ACOLS} from tbl
union all
select {ACOLS} from winners where id not in (select id from tbl)"""

ORACLE["upsert_two_phase"] = f"""with {V},
firsts as (select * from (select *, row_number() over (partition by id order by seq) as rn from versions)
           where rn = 1),
lasts as (select * from (select *, row_number() over (partition by id order by seq desc) as rn
                         from versions where title is not null) where rn = 1)
select f.id, f.source, f.url, f.category, l.title, l.author, f.date, l.publish_time, l.content, l.tags
from firsts f left join lasts l on f.id = l.id"""

ORACLE["compact"] = ORACLE["dedupe_latest"]

ORACLE["conditional_update"] = f"""with {A}
select id, source, url, category,
       case when source = 'src3' and contains(content, ' is ') then trim(replace(title, chr(10) || chr(10), ' '))
            else title end as title,
       author, date, publish_time,
       case when source = 'src3' and contains(content, ' is ')
            then trim(replace(split_part(content, ' is ', 1), chr(10) || chr(10), ' ')) else content end as content,
       tags
from articles"""

ORACLE["sync_incremental"] = f"""with {A},
src as (select * from articles),
tgt as (select * from articles where cast(id as bigint) % 2 = 0),
ins as (select count(*) as n from src where id not in (select id from tgt))
select (select count(*) from src) as source_total, (select n from ins) as inserted,
       (select count(*) from src) - (select n from ins) as skipped,
       (select count(*) from tgt) + (select n from ins) as target_total"""

ORACLE["dq_unique"] = """
select conv_id, count(*) as n from conversations group by conv_id having count(*) > 1"""
ANULL = f"""{A}, anull as (
  select case when cast(id as bigint) % 17 = 0 then null else id end as id,
         source, url, category, title, author, date, publish_time, content, tags from articles)"""
ORACLE["dq_not_null"] = f"with {ANULL} select * from anull where id is null"
ORACLE["dq_report"] = f"""with {ANULL}
select 'not_null' as "check", 'id' as "column", cast(count_if(id is null) as bigint) as failures from anull
union all select 'not_null', 'title', cast(count_if(title is null) as bigint) from anull
union all select 'unique', 'id', coalesce(sum(n - 1), 0)::bigint from
  (select id, count(*) as n from anull where id is not null group by id)
union all select 'unique', 'category', coalesce(sum(n - 1), 0)::bigint from
  (select category, count(*) as n from anull where category is not null group by category)
union all select 'single_source', 'id', cast(count_if(k > 1) as bigint) from
  (select id, count(distinct source) as k from anull where id is not null group by id)"""

# ---------------------------------------------------------------- record normalisation
DOCS_TS = """docs_ts as (
  select *, timestamp '2024-03-01 00:00:00' - to_seconds(doc_id * 3607) as ts from documents)"""
NORM_A = """norm_a as (
  select cast(doc_id as varchar) as id, 'abs-cbn' as source,
         concat('https://www.abs-cbn.com/', lang, '/', cast(doc_id as varchar)) as url, upper(lang) as category,
         split_part(text, chr(10), 1) as title, source as author, cast(ts as date) as date, ts as publish_time,
         case when doc_id % 11 != 0 then text else 'No content found' end as content,
         concat(lang, ',', source) as tags
  from docs_ts where doc_id % 13 != 0 and ts >= timestamp '2024-02-01')"""
NORM_A_ALL = NORM_A.replace(" and ts >= timestamp '2024-02-01'", "")
NORM_B = """norm_b as (
  select cast(doc_id as varchar) as id, 'manila_bulletin' as source,
         concat('https://sections.example.com/', lang, '/', cast(doc_id as varchar)) as url,
         case when doc_id % 6 = 0 then 'Unknown' else upper(lang) end as category,
         case when doc_id % 9 = 0 then 'No title found' else split_part(text, chr(10), 1) end as title,
         case when doc_id % 5 = 0 then 'Unknown' else source end as author,
         cast(ts as date) as date, ts as publish_time,
         case when doc_id % 4 != 0 and text != '' then text
              when doc_id % 8 != 0 then split_part(text, chr(10), 1) else 'No content found' end as content,
         concat(lang, ',', source) as tags
  from docs_ts where doc_id % 19 != 0 and doc_id % 23 != 0)"""
NORM_C = """norm_c as (
  select cast(doc_id as varchar) as id, 'rappler' as source,
         concat('https://posts.example.com/', lang, '/', cast(doc_id as varchar), '/') as url, lang as category,
         case when doc_id % 9 = 0 then 'No title found' else split_part(text, chr(10), 1) end as title,
         cast(null as varchar) as author, cast(ts as date) as date, ts as publish_time, text as content,
         concat(lang, ',', source) as tags
  from docs_ts)"""
ORACLE["norm_listing_detail"] = f"with {DOCS_TS}, {NORM_A} select * from norm_a"
ORACLE["norm_sectioned"] = f"with {DOCS_TS}, {NORM_B} select * from norm_b"
ORACLE["sectioned_walk"] = f"""with {DOCS_TS}, {NORM_B},
k as (select cast(doc_id as varchar) as id from labels),
r as (select source as section, doc_id // 200 as page, cast(doc_id as varchar) as id, ts >= timestamp '2024-02-10' as recent,
             cast(doc_id as varchar) in (select id from k) as known
      from docs_ts where doc_id % 19 != 0),
f as (select section, min(page) as first_page from r group by section),
pg as (select section, page, row_number() over (partition by section order by page) - 1 as nth
       from (select distinct section, page from r where recent and not known)),
walked as (select pg.section, pg.page from pg join f on pg.section = f.section where first_page <= 1 and page = first_page + nth)
select b.* from norm_b b join r on b.id = r.id join walked w on r.section = w.section and r.page = w.page
where r.recent and not r.known"""
ORACLE["norm_nested_posts"] = f"with {DOCS_TS}, {NORM_C} select * from norm_c"
ORACLE["union_sources"] = f"""with {DOCS_TS}, {NORM_A}, {NORM_B}, {NORM_C}
select * from norm_a union all select * from norm_b union all select * from norm_c"""
ORACLE["load_normalise"] = f"""with {DOCS_TS}
select cast(doc_id as varchar) as id, source, concat('https://example.com/', cast(doc_id as varchar)) as url,
       lang as category, split_part(text, chr(10), 1) as title,
       case when doc_id % 3 = 0 then null else source end as author, cast(ts as date) as date,
       ts as publish_time, text as content, case when doc_id % 4 = 0 then null else lang end as tags
from docs_ts"""

ORACLE["listing_bodies"] = rf"""with {DOCS_TS}, {NORM_A_ALL}, {NORM_B}, {NORM_C},
x as (select id, source, case when content = 'No content found' then content else content || ' end of text' end as content from norm_a
      union all select id, source, case when cast(id as bigint) % 4 = 0 then content else content || ' end of text' end from norm_b
      union all select id, source, content || ' end of text' from norm_c)
select id, source, md5(array_to_string(regexp_extract_all(content, '(\p{{L}}+)', 1), ' ')) as words_md5 from x"""
ORACLE["load_rejects"] = f"""with {DOCS_TS},
j as (select *, concat_ws(', ', case when doc_id % 13 = 0 then 'id missing' end, case when doc_id % 7 = 2 then 'date unreadable' end,
                          case when doc_id % 11 = 3 then 'publish_time unreadable' end) as reasons from docs_ts)
select case when doc_id % 13 <> 0 then cast(doc_id as varchar) end as id,
       case when reasons = '' and doc_id % 5 <> 1 then cast(ts as date) end as date, case when reasons = '' then ts end as publish_time,
       reasons, case when reasons <> '' then concat('https://example.com/', cast(doc_id as varchar)) end as url
from j"""
ORACLE["csv_rejects"] = """
select case when c_custkey % 9 not in (1, 2, 3) then c_custkey end as c_custkey, case when c_custkey % 9 not in (1, 2, 3) then c_name end as c_name,
       case when c_custkey % 9 not in (1, 2, 3) then cast(c_acctbal as double) end as c_acctbal,
       case c_custkey % 9 when 1 then concat_ws(',', c_custkey, c_name) when 2 then concat_ws(',', c_custkey, c_name, c_acctbal, 'more')
                          when 3 then concat_ws(',', c_custkey, c_name, 'plenty') end as raw
from customer"""
ORACLE["listing_rejects"] = """
with a as (select 'detail' as shape, concat_ws(', ', case when doc_id % 13 = 0 then 'slug missing' end) as reasons, doc_id // 50 as page, '' as section from documents),
b as (select 'sectioned' as shape, case when doc_id % 19 = 0 then 'time unreadable' else '' end as reasons, doc_id // 200 as page, source as section from documents),
c as (select 'posts' as shape, '' as reasons, doc_id // 10 as page, '' as section from documents),
items as (select * from a union all select * from b union all select * from c),
broken as (select *, page % 11 = 4 or page % 7 = 3 as bad from items),
rows as (select shape, reasons from broken where not bad
         union all select shape, 'malformed page' from (select distinct shape, section, page from broken where bad)
         union all select 'detail record', '' from documents where doc_id % 11 <> 0
         union all select 'sectioned record', case when doc_id % 23 = 0 then 'failed response' else '' end from documents)
select shape, reasons, count(*) as n from rows group by all"""

PAGE_PARTS = """parts as (
  select page_id, url,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) as auth,
         regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ';[^/]*$', ''), '^/+|/+$', '', 'g') as p
  from pages),
parts2 as (
  select page_id, url, split_part(auth, '.', 1) as subdomain, split_part(auth, '.', 2) as origin,
         split_part(p, '/', 1) as article_id,
         case when strpos(p, '/') > 0 then substr(p, strpos(p, '/') + 1) else '' end as slug
  from parts)"""
ORACLE["url_parts"] = f"with {PAGE_PARTS} select page_id, subdomain, origin, article_id, slug from parts2"
ORACLE["article_key"] = f"""with {PAGE_PARTS}
select page_id, concat(subdomain, ':', article_id, ':', slug) as article_key from parts2"""
ORACLE["url_absolute"] = f"with {PAGE_PARTS} select page_id, concat('https://www.example.com/', slug) as abs_url from parts2"
ORACLE["url_category"] = """
select page_id, split_part(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ';[^/]*$', ''), '/', 2) as category
from pages"""
ORACLE["publish_time_parse"] = """
select event_id,
       case event_id % 5 when 0 then date_trunc('second', ts) when 1 then date_trunc('second', ts)
                         when 2 then ts when 3 then date_trunc('day', ts) end as publish_time
from events"""
ORACLE["api_time_parse"] = """
select event_id, cast(ts as date) as date, date_trunc('second', ts) as publish_time from events"""
RAW_TAGS = """raw_tags as (
  select p_partkey,
         case when p_partkey % 11 = 0 then null
              else concat(' ', p_brand, ' ,, ', replace(p_type, ' ', ' , '), ', ') end as raw
  from part)"""
ORACLE["tags_normalise"] = f"""with {RAW_TAGS}
select p_partkey,
       coalesce(array_to_string(list_filter(list_transform(string_split(raw, ','), lambda x: trim(x)), lambda x: x != ''), ','), '')
         as tags
from raw_tags"""
ORACLE["tags_to_array"] = f"with {RAW_TAGS} select p_partkey, string_split(raw, ',') as tags from raw_tags"
ORACLE["fill_defaults"] = f"""with {A}
select id, coalesce(title, 'No title found') as title, coalesce(author, 'Unknown') as author,
       case when cast(id as bigint) % 6 = 0 then 'Unknown' else category end as category,
       case when cast(id as bigint) % 8 = 0 then 'No content found' else content end as content
from articles"""
ORACLE["whitespace_collapse"] = r"""
select doc_id,
       regexp_replace(regexp_replace(regexp_replace(text, '\n{3,}', chr(10) || chr(10), 'g'), ' +', ' ', 'g'),
                      '^\s+|\s+$', '', 'g') as text
from documents"""
ORACLE["boilerplate_cut"] = """
select doc_id, trim(replace(split_part(text, ' the ', 1), chr(10) || chr(10), ' ')) as text from documents"""
ORACLE["date_to_text"] = "select o_orderkey, cast(cast(o_orderdate as date) as varchar) as date from orders"
ORACLE["date_spine"] = """
with b as (select o_orderstatus, min(cast(o_orderdate as date)) as s, max(cast(o_orderdate as date)) as e
           from orders group by o_orderstatus),
days as (select o_orderstatus, cast(unnest(generate_series(cast(s as timestamp), cast(e as timestamp), interval 1 day))
                                    as date) as day from b)
select o_orderstatus, day, concat('https://www.inquirer.net/article-index/?d=', cast(day as varchar)) as index_url
from days"""

ORACLE["pending_articles"] = f"""with {A}
select url, category, cast(date as varchar) as date from articles where title is null"""
ORACLE["unextracted_articles"] = f"""with {A}
select id, url, category, cast(date as varchar) as date from articles
where lower(title) like '%no title%' or lower(content) like '%cannot extract article%'"""
ORACLE["category_allow"] = f"""with {A}
select id, category from articles where upper(trim(category)) in ('EN', 'FR')"""
ORACLE["https_only"] = "select page_id, url from pages where starts_with(url, 'https://')"
ORACLE["slug_block"] = f"""with {PAGE_PARTS}
select page_id, subdomain, slug from parts2
where not coalesce(contains(slug, '5') or (subdomain = 'blog' and contains(slug, '1')), false)"""
ORACLE["challenge_page_flag"] = """
select page_id,
       coalesce(contains(lower(substring(html, 1, 2000)), 'ad 1 -->')
                or contains(lower(substring(html, 1, 2000)), 'lang="de"'), false) as is_challenge
from pages"""
ORACLE["slug_block_rules"] = f"""with {PAGE_PARTS},
rules as (select distinct substr(url, -7, 4) as needle, case when page_id % 80 = 0 then subdomain end as scope from parts2 where page_id % 40 = 0)
select page_id, subdomain from parts2
where not exists (select 1 from rules where length(needle) > 0 and contains(url, needle) and (scope is null or scope = subdomain))"""
ORACLE["challenge_page_rules"] = """
with rules as (select distinct lower(substr(html, 400, 14)) as needle from pages where page_id % 100 = 0)
select page_id, exists (select 1 from rules where length(needle) > 0 and contains(lower(substr(html, 1, 2000)), needle)) as is_challenge from pages"""
ORACLE["newest_first_cutoff"] = """
with s as (select event_type, max(ts) as last from events where ts < timestamp '2024-01-15' and event_id % 97 <> 0 group by event_type)
select e.event_id, e.event_type from events e left join s on e.event_type = s.event_type where s.last is null or e.ts > s.last"""
ORACLE["has_key"] = f"""with {A},
x as (select case when cast(id as bigint) % 17 = 0 then null else id end as id,
             case when cast(id as bigint) % 13 = 0 then '' else url end as url from articles)
select id, url from x where id is not null and id != '' and url is not null and url != ''"""
ORACLE["listing_detail"] = """
select d.doc_id, d.source, coalesce(cast(l.quality as varchar), 'No content found') as detail
from documents d left join labels l on d.doc_id = l.doc_id"""
ORACLE["tag_lookup"] = """
select cast(l_orderkey as varchar) as id,
       coalesce(string_agg(p_name, ',' order by l_linenumber, l_partkey, p_name), '') as tags
from lineitem left join part on l_partkey = p_partkey group by l_orderkey"""
ORACLE["listing_frontier"] = """
with m as (select max(event_id) as newest from events),
l as (
  select event_type as section, cast(floor((m.newest - event_id) / 25) + 1 as bigint) as page,
         m.newest - event_id as pos,
         case when event_id % 97 = 0 then null else ts end as ts, user_id < 75 as known
  from events, m),
stops as (select section, page, min(pos) as stop_pos from l
          where ts is not null and ts < timestamp '2024-01-25' group by section, page),
pg as (
  select l.section, l.page,
         cast(count_if(l.ts is not null and (s.stop_pos is null or l.pos < s.stop_pos)) as bigint) as n_in_range,
         cast(count_if(l.ts is not null and (s.stop_pos is null or l.pos < s.stop_pos) and not l.known) as bigint) as n_new,
         bool_or(s.stop_pos is not null) as reached_old
  from l left join stops s on l.section = s.section and l.page = s.page group by l.section, l.page),
nxt as (select p.section, p.page, q.page is not null as has_next
        from pg p left join pg q on q.section = p.section and q.page = p.page + 1),
gaps as (select section, case when min(page) > 1 then 1 else min(case when not has_next then page + 1 end) end as gp
         from nxt group by section),
w as (select *, n_in_range = 0 or n_new = 0 or reached_old as stop_here from pg),
fs as (select section, min(page) as sp from w where stop_here group by section)
select w.section, w.page, w.n_in_range, w.n_new, w.reached_old
from w join gaps g on w.section = g.section left join fs on w.section = fs.section
where w.page < g.gp
  and (fs.sp is null or w.page < fs.sp or (w.page = fs.sp and w.n_in_range > 0 and w.n_new > 0 and w.reached_old))"""

# ---------------------------------------------------------------- HTML jobs
# Entities in titles: &quot; and &amp; (also without ';', as an HTML parser accepts).
DECODE_TITLE = ("regexp_replace(regexp_replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&quot;?', '\"', 'g'), "
                "'&amp;?', '&', 'g')")
ORACLE["page_fields"] = f"""
select page_id, {DECODE_TITLE} as title,
       cast(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as integer) as n_links,
       cast(len(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<li><a href="([^"]*)"', 1)) as integer) as n_list_links,
       regexp_extract(html, '<html lang="([^"]*)"', 1) as lang, regexp_extract(html, '<meta charset="([^"]*)"', 1) as charset,
       cast(len(regexp_extract_all(html, '<div class="ad">')) as integer) as n_ads
from pages"""
ORACLE["page_titles"] = f"""
select page_id, case when {DECODE_TITLE} != '' then regexp_replace({DECODE_TITLE}, '^\\s+|\\s+$', '', 'g')
                     else 'No title' end as title
from pages"""
W = """w as (
  select *, doc_id % 7 as k, 'Title ' || doc_id || ' of ' || source as t, 'Writer ' || doc_id % 37 as a,
         ['newsinfo', 'lifestyle', 'pop', 'cebudailynews', 'bandera', 'newsinfo', 'newsinfo'][doc_id % 7 + 1] as host,
         '<' || ['div id="FOR_target_content"', 'div class="x elementor-widget-theme-post-content"', 'div id="TO_target_content"', 'div id="article-content"',
                 'div id="FOR_target_content"', 'div id="FOR_target_content"', 'div id="other"'][doc_id % 7 + 1] || '><h2>Part</h2><p>'
             || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p><table><tr><td>c1</td><td>c2</td></tr></table></div>' as block
  from documents),
wf as (select *, case when k = 6 then 'No title' else t end as title, case when k = 6 then 'No author' else a end as author,
              case when k = 6 then 'Cannot extract article content' end as none from w)"""
ORACLE["title_fallback"] = f"with {W} select doc_id, title from wf"
ORACLE["author_fallback"] = f"with {W} select doc_id, author from wf"
ORACLE["content_fallback"] = f"with {W} select doc_id, md5(coalesce(none, block)) as block_md5, length(coalesce(none, block)) as n_chars from wf"
ORACLE["article_details"] = rf"""with {W}
select host || ':' || doc_id || ':story' as id, 'press' as source, title, author, case when k in (2, 5) then lang else '' end as tags, lang as category,
       cast(date '2024-01-01' + cast(doc_id % 90 as integer) as date) as date,
       md5(array_to_string(regexp_extract_all(coalesce(none, 'Part ' || text || ' c c'), '(\p{{L}}+)', 1), ' ')) as words_md5
from wf"""
ORACLE["two_phase_crawl"] = rf"""with {W}
select host || ':' || doc_id || ':story' as id, 'press' as source, 'https://' || host || '.press.example/' || doc_id || '/story' as url,
       title, author, case when k in (2, 5) then lang else '' end as tags, lang as category,
       cast(date '2024-01-01' + cast(doc_id % 90 as integer) as date) as date,
       md5(array_to_string(regexp_extract_all(coalesce(none, 'Part ' || text || ' c c'), '(\p{{L}}+)', 1), ' ')) as words_md5
from wf"""
ORACLE["tags_from_hrefs"] = """
select page_id,
       array_to_string(list_transform(list_filter(regexp_extract_all(html, '<a href="([^"]*)"', 1),
                                                  lambda h: contains(h, '/t')),
                                      lambda h: split_part(h, '/t', 2)), ', ') as tags
from pages"""
# Text of the page minus head, scripts, styles, comments and the dropped ad
# blocks; inline tags join, block tags separate; entities (also the legacy
# names an HTML parser accepts without ';') are not letters.
ORACLE["html_clean_text"] = r"""
with a as (select page_id, regexp_replace(html, '<head>.*?</head>|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<div class="ad">.*?</div>', ' ', 'gs') as h from pages),
b as (select page_id, regexp_replace(regexp_replace(h, '</?(b|a|i|em|strong|span)( [^>]*)?>', '', 'g'), '<[^>]*>', ' ', 'g') as t from a),
c as (select page_id, regexp_extract_all(regexp_replace(t, '&(#[0-9]+;|#[xX][0-9A-Fa-f]+;|[A-Za-z][A-Za-z0-9]*;|amp|lt|gt|quot|copy|reg|nbsp)', ' ', 'g'), '(\p{L}+)', 1) as w from b)
select page_id, array_to_string(w, ' ') as words, cast(len(w) as integer) as n_words, true as markup_free from c"""

HARVEST = """idx as (
  select page_id, url as page_url, cast(date '2024-01-01' + cast(page_id % 7 as integer) as date) as date,
         regexp_extract_all(html, '<li><a href="([^"]*)"', 1) as hrefs
  from pages),
l as (select page_id, page_url, date, unnest(hrefs) as href, generate_subscripts(hrefs, 1) as pos from idx),
r as (select *, case when starts_with(href, '/') and not starts_with(href, '//')
                     then regexp_extract(page_url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1) || href
                     else href end as link from l),
h as (select *, regexp_extract(link, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1) as auth,
             regexp_replace(regexp_replace(regexp_extract(link, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', ''),
                            '^/+|/+$', '', 'g') as p
      from r where starts_with(link, 'https://')),
hp as (select *, split_part(auth, '.', 1) as subdomain, split_part(auth, '.', 2) as origin,
              split_part(p, '/', 1) as article_id,
              case when strpos(p, '/') > 0 then substr(p, strpos(p, '/') + 1) else '' end as slug from h),
keyed as (select concat(subdomain, ':', article_id, ':', slug) as id, origin as source, link as url,
                 '' as category, date, page_url, pos, page_id
          from hp where not coalesce(contains(slug, 'lotto')
                                     or (subdomain = 'cebudailynews' and contains(slug, 'daily-gospel')), false)),
known as (select distinct id from keyed where page_id % 2 = 0)"""
ORACLE["link_harvest"] = f"""with {HARVEST},
fresh as (select * from keyed where id not in (select id from known))
select id, source, url, category, date from (
  select *, row_number() over (partition by id order by date, page_url, pos) as rn from fresh) where rn = 1"""
ORACLE["harvest_counters"] = f"""with {HARVEST},
firsts as (select id, min(struct_pack(d := date, u := page_url, p := pos)) as f from keyed group by id),
m as (select k.date, k.id in (select id from known) as is_known,
             struct_pack(d := k.date, u := k.page_url, p := k.pos) = f.f as is_first
      from keyed k join firsts f on k.id = f.id)
select date, cast(count_if(not is_known and is_first) as bigint) as accepted, cast(count_if(is_known or not is_first) as bigint) as skipped
from m group by date"""

# ---------------------------------------------------------------- text trends
TOKS = r"""pieces as (
  select doc_id, unnest(parts) as piece, cast(generate_subscripts(parts, 1) as integer) as pos
  from (select doc_id, regexp_split_to_array(text, '[^\p{L}\p{N}_''\-]+') as parts from documents)),
stripped as (
  select doc_id, pos,
         regexp_replace(regexp_replace(regexp_replace(piece, '^''+', ''), '(?i)(n''t|''s|''m|''re|''ve|''ll|''d)$', ''),
                        '''+$', '') as raw
  from pieces),
toks as (select doc_id, pos, raw, lower(raw) as token from stripped where regexp_full_match(raw, '\p{L}+'))"""
STOPWORDS_SQL = None  # filled below from the fixed list


def _stopwords_sql() -> str:
    from newslake.constants import ENGLISH_STOPWORDS
    return ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOPWORDS)


STOPWORDS_SQL = _stopwords_sql()
ORACLE["tokenise"] = f"with {TOKS} select doc_id, pos, token from toks"
ORACLE["stopword_anti"] = f"with {TOKS} select doc_id, pos, token from toks where raw not in ({STOPWORDS_SQL})"
TERMS = f"""{TOKS},
terms as (select doc_id, token, count(*) as n, min(pos) as first_pos from toks
          where raw not in ({STOPWORDS_SQL}) group by doc_id, token)"""
ORACLE["term_counts"] = f"with {TERMS} select * from terms"
ORACLE["top_terms"] = f"""with {TERMS}
select * from (select *, cast(row_number() over (partition by doc_id order by n desc, first_pos, token) as integer) as rank from terms)
where rank <= 10"""
ORACLE["lemma_lookup"] = f"""with {TOKS},
lem as (select distinct token as word, substring(token, 1, length(token) - 1) as lemma from toks
        where regexp_full_match(token, '\\p{{L}}{{3,}}s'))
select t.doc_id, t.pos, coalesce(l.lemma, t.token) as lemma from toks t left join lem l on t.token = l.word"""
ORACLE["token_bag"] = f"""with {A}, {TOKS},
lem as (select distinct token as word, substring(token, 1, length(token) - 1) as lemma from toks
        where regexp_full_match(token, '\\p{{L}}{{3,}}s')),
bag as (select doc_id, coalesce(l.lemma, t.token) as lemma, count(*) as n, min(pos) as first_pos
        from toks t left join lem l on t.token = l.word where raw not in ({STOPWORDS_SQL}) group by 1, 2),
ranked as (select *, cast(row_number() over (partition by doc_id order by n desc, first_pos) as integer) as rank from bag)
select r.*, a.title, a.date from ranked r join articles a on cast(r.doc_id as varchar) = a.id where rank <= 10"""
TREND_TOKS = TOKS.replace("from documents", "from documents_dated where date >= (select max(date) from documents_dated) - 13")
ORACLE["trending_terms"] = f"""with documents_dated as (
  select doc_id, text, cast(date '2024-01-01' + cast(doc_id % 90 as integer) as date) as date from documents),
{TREND_TOKS},
cur as (select doc_id, date >= (select max(date) from documents_dated) - 6 as is_cur from documents_dated),
c as (select token as term, cast(count_if(is_cur) as bigint) as this_window, cast(count_if(not is_cur) as bigint) as prev_window
      from toks join cur using (doc_id) where raw not in ({STOPWORDS_SQL}) group by token)
select term, this_window, prev_window, this_window - prev_window as growth from c
order by growth desc, term limit 20"""

ORACLE["insert_filtered"] = ORACLE["insert_ignore"]
ORACLE["new_only_filtered"] = ORACLE["new_only"]
ORACLE["record_exists_filtered"] = ORACLE["record_exists"]
ORACLE["sync_digests"] = f"with {A} select * from articles"
ORACLE["bucketed_upsert"] = ORACLE["upsert_two_phase"]
ORACLE["update_touched_files"] = ORACLE["conditional_update"]
ORACLE["upsert_touched_files"] = ORACLE["upsert_two_phase"]

# ---------------------------------------------------------------- streaming
ORACLE["stream_ingest"] = f"""with {A},
arrivals as (
  select *, cast(id as bigint) as seq from articles
  union all
  select id, source, url, category, 'again' as title, author, date, publish_time, content, tags,
         cast(id as bigint) + 1000000 as seq from articles where cast(id as bigint) % 4 = 0)
select {ACOLS} from (select *, row_number() over (partition by id order by seq) as rn from arrivals) where rn = 1"""
ORACLE["stream_upsert"] = ORACLE["upsert_two_phase"]
ORACLE["stream_upsert_table"] = ORACLE["upsert_two_phase"]
ORACLE["stream_progress"] = """select event_id % 6 as batch_id, count(*) as num_input_rows from events group by all"""
ORACLE["stream_known_ids"] = f"""with {E},
ea as (select id, source, cast(null as varchar) as url, category, cast(null as varchar) as title,
              cast(null as varchar) as author, date, cast(null as timestamp) as publish_time,
              cast(null as varchar) as content, cast(null as varchar) as tags, cast(id as bigint) as seq
       from articles_e),
arrivals as (
  select * from ea
  union all
  select id, source, url, 'again' as category, title, author, date, publish_time, content, tags,
         seq + 1000000 as seq from ea where seq % 5 = 0)
select {ACOLS}, seq from (select *, row_number() over (partition by id order by seq) as rn from arrivals)
where rn = 1 and seq % 3 != 0"""

# ---------------------------------------------------------------- marts
ORACLE["stg_articles"] = f"""with {A}
select id, source, url, category,
       case when source = 'src3' and contains(content, ' is ') then trim(replace(title, chr(10) || chr(10), ' '))
            else title end as title,
       author, date, publish_time,
       case when source = 'src3' and contains(content, ' is ')
            then trim(replace(split_part(content, ' is ', 1), chr(10) || chr(10), ' ')) else content end as content,
       string_split(tags, ',') as tags
from articles"""
VERSIONED = f"""{A},
versioned as (
  select * from articles
  union all
  select id, source, url, category, 'newer' as title, author, date, publish_time + interval 1 day as publish_time,
         content, tags from articles where cast(id as bigint) % 5 = 0),
bad_pages as (select url from articles where contains(lower(substring(content, 1, 2000)), ' und ')),
cleaned as (
  select id, source, url, category, title, author, date, publish_time, content, string_split(tags, ',') as tags
  from (select *, row_number() over (partition by id order by publish_time desc) as rn
        from versioned
        where title is not null
          and not coalesce(contains(lower(title), 'no title') or contains(lower(content), 'cannot extract article'),
                           false)
          and url not in (select url from bad_pages))
  where rn = 1)"""
ORACLE["int_articles_cleaned"] = f"with {VERSIONED} select * from cleaned"
ORACLE["fct_articles"] = f"""with {VERSIONED}
select id, source, url, category, title, author, date, publish_time, cast(length(content) as bigint) as content_length,
       cast(coalesce(len(list_filter(tags, lambda t: trim(t) != '')), 0) as integer) as tag_count,
       cast(date_trunc('week', date) as date) as week
from cleaned"""
DIM = """select source, count(*) as total_articles, count(distinct category) as categories_covered,
       avg(length(content)) as avg_article_length, min(date) as earliest_article, max(date) as latest_article,
       cast('0x' || substr(md5(source), 1, 15) as bigint) as source_id
from {src} group by source"""
ORACLE["dim_sources"] = f"with {A} " + DIM.format(src="articles")
ORACLE["agg_daily_trends"] = f"""with {E},
daily as (select date, source, category, count(*) as daily_count from articles_e group by date, source, category),
b as (select source, category, min(date) as s, max(date) as e from daily group by source, category),
spine as (select source, category,
                 cast(unnest(generate_series(cast(s as timestamp), cast(e as timestamp), interval 1 day)) as date) as date
          from b),
f as (select sp.date, sp.source, sp.category, coalesce(d.daily_count, 0) as daily_count
      from spine sp left join daily d on sp.date = d.date and sp.source = d.source and sp.category = d.category)
select *, avg(daily_count) over (partition by source, category order by date
                                 rows between 6 preceding and current row) as moving_avg_7d
from f"""
ORACLE["incremental_refresh"] = f"""with {E}
select source, count(*) as daily_count, date from articles_e group by date, source"""
ORACLE["layered_build"] = f"""with {A},
c as (select * from articles where title is not null
      and not coalesce(contains(lower(title), 'no title') or contains(lower(content), 'cannot extract article'), false))
""" + DIM.format(src="c")
