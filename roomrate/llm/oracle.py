"""DuckDB SQL of the registered queries whose results SQL can state."""

from __future__ import annotations


def _attribute(name: str) -> str:
    """The value of an attribute of ``tag``."""
    at, quoted = rf"(?is)\s{name}\s*=\s*", '"([^"]*)"'
    return (f"coalesce(nullif(regexp_extract(tag, '{at}{quoted}', 1), ''), "
            f"nullif(regexp_extract(tag, '{at}''([^'']*)''', 1), ''), "
            rf"""regexp_extract(tag, '{at}([^\s"''>]+)', 1)) as "{name}" """)


def _host(rest: str) -> str:
    return (f"translate(regexp_extract(coalesce({rest}, ''), '^[^/?#]*'), "
            "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


def _path(rest: str) -> str:
    return f"regexp_extract(coalesce({rest}, ''), '^[^/?#]*([^?#]*)', 1)"


def _rule(rules: list[tuple[str, str]], value) -> str:
    """``value(action, rule)`` of the longest rule that fits ``host`` and ``path``."""
    whens = []
    for action, rule in sorted(rules, key=lambda r: -len(r[1])):
        host, _, path = rule.partition("/")
        whens.append(f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '/{path}') "
                     f"then '{value(action, rule)}'")
    return "case " + "\n    ".join(whens) + " end"


def url_filter(rules: list[tuple[str, str]]) -> str:
    """Rules, links of the html, and the reach of each url over links."""
    return rf"""
with recursive p as (
  select *, {_host("rest")} as host, {_path("rest")} as path
  from (select page_id, url, html,
               case when contains(url, '://') then substr(url, instr(url, '://') + 3) end as rest from pages)),
tags as (
  select *, unnest(regexp_extract_all(regexp_replace(
      html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'),
      '(?is)<(?:link|meta)\s[^>]*>')) as tag
  from p where rest is not null),
attributes as (
  select url, rest, path, tag, {_attribute("rel")}, {_attribute("href")}, {_attribute("http-equiv")},
         {_attribute("content")}
  from tags),
links as (
  select url, regexp_extract(url, '^[^:/?#]*') as scheme, regexp_extract(rest, '^[^/?#]*') as authority,
         regexp_extract(path, '^(?:.*/)?') as folder,
         trim(regexp_replace(case
           when regexp_matches(tag, '(?i)^<link') and list_contains(regexp_split_to_array(lower(rel), '\s+'), 'canonical')
             then href
           when regexp_matches(tag, '(?i)^<meta') and lower(trim("http-equiv")) = 'refresh'
             then regexp_extract(content, '(?is)^[^;,]*[;,]\s*(?:url\s*=\s*)?[''"]?([^''"]*)', 1) end,
           '(?i)&amp;|&#38;|&#x26;', '&', 'g')) as link
  from attributes),
targets as (
  select url as src, case
      when link = '' then null
      when regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') then link
      when regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') then null
      when starts_with(link, '//') then scheme || ':' || link
      when starts_with(link, '/') then scheme || '://' || authority || link
      when starts_with(link, '#') then url
      when starts_with(link, '?') then regexp_replace(url, '[?#].*$', '') || link
      else scheme || '://' || authority || case when folder = '' then '/' else folder end || link end as dst
  from links where link is not null),
nodes as (
  select url, {_host("rest")} || case when {_path("rest")} = '' then '/' else {_path("rest")} end
         || case when query = '?' then '' else query end as node
  from (select url, rest, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) as query
        from (select url, substr(url, instr(url, '://') + 3) as rest
              from (select url from p union select src from targets union select dst from targets)
              where contains(url, '://')))),
steps as (
  select a.node as u, b.node as v from targets t join nodes a on a.url = t.src join nodes b on b.url = t.dst
  union
  select b.node, a.node from targets t join nodes a on a.url = t.src join nodes b on b.url = t.dst),
reach(u, v) as (
  select u, v from steps
  union
  select r.u, s.v from reach r join steps s on r.v = s.u),
own as (
  select node, {_rule(rules, lambda action, rule: action)} as action
  from (select distinct node, regexp_extract(node, '^[^/]*') as host, regexp_extract(node, '^[^/]*([^?]*)', 1) as path
        from nodes)),
blocked as (
  select r.u as node from reach r join own o on o.node = r.v
  group by r.u having bool_or(o.action = 'block') and not coalesce(bool_or(o.action = 'allow'), false)),
judged as (
  select page_id, url, host, path, {_rule(rules, lambda action, rule: rule)} as rule,
         {_rule(rules, lambda action, rule: action)} as action
  from p)
select j.page_id, j.host, j.path, j.rule,
       coalesce(j.action, case when b.node is not null then 'block' else 'allow' end) as verdict
from judged j left join nodes n on n.url = j.url left join blocked b on b.node = n.node
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def decontamination(window: int) -> str:
    """Every window of every benchmark item against every window of as many
    words of every document."""
    words = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
with d as (select row_number() over () as r, doc_id, {words} as ws from documents),
b as (select item_id, ws, least(len(ws), {window}) as m from (select item_id, {words} as ws from benchmark)
      where len(ws) > 0),
patterns as (
  select distinct cast(item_id as varchar) as item, m, array_to_string(ws[i + 1:i + m], ' ') as words
  from (select *, unnest(range(len(ws) - m + 1)) as i from b)),
windows as (
  select r, m, i, array_to_string(ws[i + 1:i + m], ' ') as words
  from (select r, ws, m, unnest(range(len(ws) - m + 1)) as i
        from d, (select distinct m from patterns) l where len(ws) >= m)),
found as (select w.r, w.i, w.m, p.item from windows w join patterns p on w.m = p.m and w.words = p.words),
hit as (
  select r, count(distinct place) as n_hit
  from (select r, unnest(range(i, i + m)) as place from (select distinct r, i, m from found)) group by r),
items as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct r, item from found where item is not null) group by r)
select d.doc_id, cast(len(d.ws) as bigint) as n_words, coalesce(h.n_hit, 0) as n_hit,
       coalesce(t.n_items, 0) as n_items, sha256(coalesce(t.items, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 as contaminated
from d left join hit h on h.r = d.r left join items t on t.r = d.r
"""


def near_duplicates(shingle: int, percent: int) -> str:
    """All pairs that share a shingle, and the reach of each document over
    similar ones."""
    words = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"
    return rf"""
with recursive d as (select doc_id, {words} as ws from documents),
shingles as (
  select distinct doc_id, array_to_string(ws[i + 1:i + {shingle}], ' ') as s
  from (select *, unnest(range(greatest(len(ws) - {shingle} + 1, 1))) as i from d where len(ws) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as u, b.doc_id as v, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id),
links as (
  select u, v from shared s join sizes a on a.doc_id = u join sizes b on b.doc_id = v
  where 100 * s.n >= {percent} * (a.n + b.n - s.n)),
steps as (select u, v from links union select v, u from links),
reach(u, v) as (select u, v from steps union select r.u, s.v from reach r join steps s on r.v = s.u),
low as (select u, min(v) as v from reach group by u)
select d.doc_id, coalesce(z.n, 0) as n_shingles, least(d.doc_id, coalesce(l.v, d.doc_id)) as component_id,
       d.doc_id <= coalesce(l.v, d.doc_id) as kept
from d left join sizes z on z.doc_id = d.doc_id left join low l on l.u = d.doc_id
"""
