"""Inputs derived from the given tables, one SQL text for every engine.

``pages`` has neither cards, prices, JSON, XML, paging nor status codes, so one
response per page and three per part are built from whole tables, row by row:
no grouping, no sampling, and the work grows with the tables. ``@name@`` stands
for a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import relation, spread_relation

_RETAIL = "cast(cast(p_retailprice as decimal(12,2)) as string)"
_KEY = "cast(p_partkey as string)"
_NAME = "p_name || case p_partkey % 3 when 1 then ' caf&eacute;' else '' end"

PAGE_CAPTURES = """
select cast(page_id * 4 as bigint) as capture_id, cast('2024-01-01 00:00:00' as timestamp) + interval '1' second * (page_id * 4) as fetched_at,
  cast(page_id * 4 as bigint) as job_id, url,
  case page_id % 7 when 0 then 'title,url,price' when 1 then ' Title , URL ,' when 2 then 'title,Password'
    when 3 then 'email,name' when 4 then 'private_email,url,ssn' when 5 then 'availability,heading'
    else 'href,the,the' end as fields_text,
  case page_id % 3 when 1 then 'csv, sqlite' when 2 then 'sqlite' end as outputs_text,
  case when page_id % 13 = 12 then null else
    cast(case page_id % 11 when 6 then 500 when 7 then 403 when 8 then 429 when 9 then 401 when 10 then 404 else 200 end as int)
  end as status,
  case page_id % 6 when 3 then 'Text/HTML' when 4 then 'application/json; charset=utf-8'
    when 5 then 'application/rss+xml' else 'text/html; charset=utf-8' end as content_type,
  case when page_id % 13 = 12 then 'connection timed out' end as error,
  case when page_id % 13 = 12 then null else
  case page_id % 9 when 3 then '<html><body><h1>Access denied</h1>' || html
    when 5 then '<html>' || repeat('<script>var x=1;</script>', 8) || '<body><p>Hi</p></body></html>'
    when 7 then '<html><body><p>short</p></body></html>'
    when 8 then html || '<nav class="pager"><a rel="next" href="?page=2">Next</a></nav>'
    else html end end as body
from @pages@
"""

LISTING_CAPTURES = f"""
select cast(p_partkey * 4 + 1 as bigint) as capture_id, cast('2024-01-01 00:00:00' as timestamp) + interval '1' second * (p_partkey * 4 + 1) as fetched_at,
  cast(p_partkey * 4 + 1 as bigint) as job_id,
  'https://shop' || cast(cast(floor(p_partkey / 25) as bigint) as string) || '.example.com/list?page=' || cast(p_partkey % 25 as string) as url,
  case p_partkey % 4 when 0 then 'title,url,price' when 1 then 'name,link' when 2 then 'title' else 'heading,href,price' end as fields_text,
  case p_partkey % 2 when 0 then 'csv' else 'csv,sqlite' end as outputs_text,
  cast(case when p_partkey % 17 = 5 then 403 else 200 end as int) as status,
  'text/html; charset=utf-8' as content_type,
  cast(null as string) as error,
  '<!DOCTYPE html><html><head><title>' || p_brand || ' &amp; more&hellip;</title><style>.card{{x:y}}</style></head><body><!-- <a href="/hidden">no</a> -->'
  || case when p_partkey % 10 = 9 then '<section class="rows">' else '<section class="listing">' end
  || '<div class="' || case when p_partkey % 10 = 9 then 'row' else 'product-card' end || '" data-note="1 > 0"><h2>' || {_NAME} || '</h2><a href="/p/' || {_KEY}
  || '">View</a><p class="price"> ' || case p_partkey % 10 when 1 then '£' when 2 then '' when 3 then 'N/A ' when 4 then '$1,'
    when 6 then '&pound;' when 7 then '' when 8 then '&euro;' when 9 then '&pound' else '$' end
  || {_RETAIL} || case p_partkey % 5 when 2 then ' JOD' else '' end || '</p></div>'
  || '<div class=' || chr(39) || case when p_partkey % 10 = 9 then 'row' else 'Item' end || chr(39) || '><a class="more" title="x > y" href="../t/./' || {_KEY}
  || '?a=1&amp;b=2">' || p_type || ' <b>part</b></a><span>Price: ' || {_RETAIL} || ' USD</span></div>'
  || '<div class="' || case when p_partkey % 10 = 9 then 'row' else 'product-card' end || '"><h2>' || {_NAME} || '</h2><a href="/p/' || {_KEY}
  || '">Again</a><p class="price">1</p></div><div class="' || case when p_partkey % 10 = 9 then 'row' else 'card-empty' end || '"><p>.</p></div></section>'
  || '<nav class="pager"><a href="/list?page=' || cast(p_partkey % 25 + 3 as string) || '">skip</a> <a rel="next nofollow" href="?page='
  || cast(p_partkey % 25 + 1 as string) || '">Next</a><a href="/list?all=1">all</a></nav><a href="https://other.example/list?page=2">next</a><a href="#">top</a></body></html>' as body
from @part@
"""

_RECORD = (
    f"""'{{"title":"' || p_name || '","' || case p_partkey % 3 when 0 then 'href' when 1 then 'path' else 'url' end"""
    f""" || '":"/p/' || {_KEY} || '","price":"$' || {_RETAIL} || '","stock":' || cast(p_partkey % 3 as string) || ',"note":null}}'"""
)
_ODD_RECORD = """'{"title":0,"url":null,"href":"/x","price":12.5,"stock":"  two   words "}'"""

JSON_CAPTURES = f"""
select cast(p_partkey * 4 + 2 as bigint) as capture_id, cast('2024-01-01 00:00:00' as timestamp) + interval '1' second * (p_partkey * 4 + 2) as fetched_at,
  cast(p_partkey * 4 + 2 as bigint) as job_id,
  'https://api' || cast(p_partkey % 7 as string) || '.example.com/v1/' || {_KEY} || case p_partkey % 4 when 3 then '.JSON?x=1' else '' end as url,
  case p_partkey % 5 when 0 then 'title,url,price' when 1 then 'title,link' when 2 then 'title,url,stock,note'
    when 3 then 'url' else 'price,title,url,title' end as fields_text,
  cast(null as string) as outputs_text,
  cast(case when p_partkey % 19 = 7 then 429 else 200 end as int) as status,
  case p_partkey % 4 when 0 then 'application/json' when 1 then 'text/json; charset=utf-8' when 2 then 'application/ld+json' else 'text/plain' end as content_type,
  cast(null as string) as error,
  case p_partkey % 9
    when 0 then '[' || {_RECORD} || ',5,"x{{",' || {_ODD_RECORD} || ']'
    when 1 then '{{"meta":{{"n":1}},"items":[' || {_RECORD} || ',' || {_ODD_RECORD} || ']}}'
    when 2 then '{{"products":[' || {_RECORD} || '],"data":[{{"title":"later"}}]}}'
    when 3 then '{{"items":[],"data":[' || {_RECORD} || ']}}'
    when 4 then ' {{"data":{{"items":[' || {_RECORD} || ',' || {_ODD_RECORD} || ']}}}} '
    when 5 then '{{"tags":["a"],"results":[' || {_RECORD} || ']}}'
    when 6 then '{{"products":[{{"title":"second"}}],"items":{{"page":{{"rows":[' || {_RECORD} || ']}}}}}}'
    when 7 then '{{"items":[' || {_RECORD}
    else '{{"items":[],"data":{{"list":[]}}}}' end as body
from @part@
"""

_XML_URL = f"'</title><url>/p/' || {_KEY} || '</url>'"

XML_CAPTURES = f"""
select cast(p_partkey * 4 + 3 as bigint) as capture_id, cast('2024-01-01 00:00:00' as timestamp) + interval '1' second * (p_partkey * 4 + 3) as fetched_at,
  cast(p_partkey * 4 + 3 as bigint) as job_id,
  'https://feeds' || cast(p_partkey % 5 as string) || '.example.com/f/' || {_KEY} || case p_partkey % 7 when 1 then '.rss' else '' end as url,
  case p_partkey % 4 when 0 then 'title,url' when 1 then 'title,url,price' when 2 then 'title,link' else 'title,item,note' end as fields_text,
  'csv,sqlite' as outputs_text,
  cast(case when p_partkey % 23 = 9 then 401 else 200 end as int) as status,
  case p_partkey % 5 when 0 then 'application/rss+xml' when 1 then 'text/xml; charset=utf-8' else 'application/xml' end as content_type,
  cast(null as string) as error,
  case p_partkey % 6
    when 0 then '<catalog><item><title> ' || p_name || {_XML_URL} || '</item><item><title>' || p_type || {_XML_URL} || '<price>' || {_RETAIL} || '</price></item></catalog>'
    when 1 then '<feed xmlns="http://ns.example.com/a"><entry><title>old</title><title>' || p_name || '</title><link>/p/' || {_KEY} || '</link><note></note></entry></feed>'
    when 2 then '<?xml version="1.0"?><products><product><title>' || p_name || {_XML_URL} || '<price>' || {_RETAIL} || '</price></product></products>'
    when 3 then '<catalog><record><title>' || p_name || {_XML_URL} || '</record><record><title>' || p_type || {_XML_URL} || '</record><other><a>1</a></other></catalog>'
    when 4 then '<items><item><title>Broken</items>'
    else '<root><a>' || p_name || '</a><b>2</b></root>' end as body
from @part@
"""

CAPTURES = " union all ".join([PAGE_CAPTURES, LISTING_CAPTURES, JSON_CAPTURES, XML_CAPTURES])

# Price texts in several forms, one per line item.
PRICE_TEXTS = """
select l_orderkey, cast(l_linenumber as bigint) as l_linenumber,
  case l_linenumber % 7 when 0 then '$' when 1 then ' £ ' when 2 then 'from ' when 3 then 'N/A ' when 4 then '€' when 5 then 'usd ' else '' end
  || cast(cast(l_extendedprice as decimal(12,2)) as string)
  || case l_linenumber % 7 when 2 then ' sarongs' when 6 then ' JOD or 5,00 ' when 1 then ',00 EUR' else '' end as price
from @lineitem@
"""

# Fetches of part pages and jobs that ask for them, in time: captures of a URL keep coming, a job may use the last.
FETCHES = """
select cast(l_orderkey * 8 + l_linenumber as bigint) as capture_id, '/p/' || cast(l_partkey as string) as url,
  cast(l_shipdate as timestamp) + interval '1' second * (l_orderkey % 80000) as fetched_at
from @lineitem@
"""
ASKS = """
select cast(l_orderkey * 8 + l_linenumber as bigint) as job_id, '/p/' || cast(l_partkey as string) as url,
  case when l_orderkey % 50 = 0 then null else cast(l_shipdate as timestamp) + interval '1' second * (l_suppkey * 1000 - 40000) end as asked_at
from @lineitem@
"""

# One sentence per order that may speak of availability.
STOCK_TEXTS = """
select o_orderkey, 'Status: ' || case o_orderstatus when 'O' then 'In-Stock, ships today' when 'F' then 'reavailable item'
  else 'sold out' end || case when o_orderpriority like '1%' then ' (pre order)' else '.' end as text
from @orders@
"""

# One robots file per origin that occurs in the captures.
ROBOTS_FILES = f"""
select origin,
  cast(case when length(origin) % 11 = 7 then null else
    case length(origin) % 13 when 4 then 404 when 5 then 403 when 6 then 503 else 200 end end as int) as status,
  case when length(origin) % 11 = 7 then 'connection refused' end as error,
  case length(origin) % 5
    when 0 then 'User-agent: *' || chr(10) || 'Disallow: /de/' || chr(10) || 'Disallow: /list%3Fpage%3D9' || chr(10) || 'Allow: /' || chr(13) || chr(10) || 'Disallow: /list'
    when 1 then '# none' || chr(10) || 'USER-AGENT: pagesieve # us' || chr(10) || 'user-agent: other' || chr(10) || 'Allow: /en/1' || chr(10)
      || 'Disallow: /en/' || chr(10) || 'Disallow: /list%3Fpage%3D7' || chr(10) || chr(10) || 'Disallow: /lost' || chr(10) || 'User-agent: *' || chr(10) || 'Disallow: /'
    when 2 then 'Disallow: /early' || chr(10) || 'User-agent: gone' || chr(10) || chr(10) || 'User-agent: *' || chr(10) || 'Crawl-delay: 3' || chr(10)
      || 'User-agent: sieve' || chr(10) || 'Disallow: /fr/' || chr(10) || 'Disallow: /v1/*' || chr(10) || 'Disallow:'
    when 3 then ''
    else 'User-agent: *' || chr(10) || 'Disallow:' || chr(10) || 'Disallow: /' end as body
from (select distinct regexp_extract(url, '^(https?://[^/?#]+)', 1) as origin from ({CAPTURES}) c) t
"""


def for_views(sql: str) -> str:
    return sql.replace("@", "")


def derive(spark: SparkSession, sql: str, sf_dir: str) -> DataFrame:
    """The derived rows; bodies are built where their pages or parts were dealt to (see ``spread_relation``)."""
    for name, read in (("pages", spread_relation), ("part", spread_relation), ("lineitem", relation), ("orders", relation)):
        if f"@{name}@" in sql:
            sql = sql.replace(f"@{name}@", read(spark, sf_dir, name))
    return spark.sql(sql)
