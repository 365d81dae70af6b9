"""Expected results in SQL, written apart from the engine, for DuckDB.

Each answer is a chain of named steps (common table expressions); ``answer``
collects the steps a query needs. Only fixed values and the derived inputs are
shared with the engine.
"""

from __future__ import annotations

import re

from pagesieve.functions import fixed
from pagesieve.sources import derived


def text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(pattern: str) -> str:
    """The pattern for an engine that has no possessive repetition, and no need for it."""
    return text(re.sub(r"([*+?])\+", r"\1", pattern.replace("(?iu)", "(?i)")))


def names(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


WS = text(fixed.WS_CHARS)
WORD = r"[^\p{L}\p{N}_]"


def trim(x: str) -> str:
    return f"trim({x}, {WS})"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, {rx(fixed.WS + '+')}, ' ', 'g'), ' ')"


# The references that occur in the tables; the whole table of names has tests of its own.
REFERENCES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\xa0", "&copy;": "©", "&middot;": "·",
    "&hellip;": "…", "&eacute;": "é", "&euro;": "€", "&pound;": "£", "&pound": "£", "&amp;": "&",
}


def decode(x: str) -> str:
    out = x
    for name, char in REFERENCES.items():
        out = f"replace({out}, '{name}', {text(char)})"
    return out

def nodes(x: str) -> str:
    pieces = f"regexp_split_to_array({x}, {rx(fixed.TAG)})"
    return f"list_filter(list_transform({pieces}, lambda t: {trim(decode('t'))}), lambda t: t <> '')"


def plain(x: str, sep: str = " ") -> str:
    return f"array_to_string({nodes(x)}, '{sep}')"


def count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {rx(pattern)}))"


VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s>"']*)"""
# The inside of a tag up to its '>', and attributes one after another.
INSIDE = r"""(?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*"""
ATTRIBUTES = rf"""(?:[\s/]*[^\s>"'/=][^\s=>"'/]*(?:\s*=\s*{VALUE})?)*?"""
QUOTES = r"""^["']|["']$"""


def attr(tag: str, name: str) -> str:
    found = rf"""(?is)^{ATTRIBUTES}(?:^|[\s/])[\s/]*{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    raw = f"regexp_extract({tag}, {rx(found)}, 1)"
    bare = f"regexp_replace({raw}, {rx(QUOTES)}, '', 'g')"
    return f"case when {raw} <> '' then {decode(bare)} end"

def usable(href: str) -> str:
    return f"({href} <> '' and not starts_with({href}, 'javascript:') and {href} <> '#')"


SCHEME = "'^([A-Za-z][A-Za-z0-9+.-]*):'"
SITE = "'^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)'"


def resolve(base: str, ref: str) -> str:
    """urljoin for the references that occur: dots only as '/./' and leading '/../'."""
    site = f"regexp_extract({base}, {SITE}, 1)"
    base_path = f"regexp_extract({base}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
    base_query = f"regexp_extract({base}, '^[^?#]*(\\?[^#]+)', 1)"
    folder = f"regexp_replace({base_path}, '[^/]*$', '')"
    folder = f"case when {folder} = '' then '/' else {folder} end"
    path = f"regexp_extract({ref}, '^([^?#]*)', 1)"
    rest = f"{ref}[length({path}) + 1:]"
    joined = f"case when starts_with({ref}, '/') then {path} else ({folder}) || {path} end"
    dots = f"regexp_replace(regexp_replace({joined}, '/\\./', '/', 'g'), '^(/\\.\\.)+/', '/')"
    return (
        f"case when {ref} = '' then {base} "
        f"when regexp_matches({ref}, {SCHEME}) then regexp_replace({ref}, '\\??#?$', '') "
        f"when starts_with({ref}, '//') then regexp_extract({base}, {SCHEME}, 0) || {ref} "
        f"when starts_with({ref}, '?') then {site} || {base_path} || {ref} "
        f"when starts_with({ref}, '#') then {site} || {base_path} || {base_query} || regexp_replace({ref}, '^#$', '') "
        f"else {site} || {dots} || {rest} end"
    )


def is_number(x: str) -> str:
    return f"regexp_matches({x}, {rx(fixed.NUMBER)})"


def when_equal(column: str, table: dict) -> str:
    rows = " ".join(
        f"when {text(k) if isinstance(k, str) else k} then {text(v)}" for k, v in table.items()
    )
    return f"case {column} {rows} end"


def list_repr(x: str) -> str:
    return f"case when len({x}) = 0 then '[]' else '[''' || array_to_string({x}, ''', ''') || ''']' end"


def bool_repr(x: str) -> str:
    return f"case when {x} then 'True' else 'False' end"


PAGING_WORD = "(?:pagination|pager|next-page)"
PAGING_ELEMENT = (
    r"(?is)<[a-z][^>]*\s(?:class|id)\s*=\s*"
    rf"""(?:"[^">]*{PAGING_WORD}|'[^'>]*{PAGING_WORD}|[^\s"'>]*{PAGING_WORD})"""
)
RECORD_WORD = "(?:item|product|card|result)"
RECORD_CLASS = (
    r"(?s)<[a-zA-Z][^>]*\s(?i:class)\s*=\s*"
    rf"""(?:"[^">]*{RECORD_WORD}|'[^'>]*{RECORD_WORD}|[^\s"'>]*{RECORD_WORD})"""
)
AGENT = fixed.USER_AGENT.split("/")[0].lower()
BLOCKED = "(401, 403, 429)"
LABELS = [
    ("list_contains(string_split(lower({rel}), ' '), 'next')", text(fixed.SIGNAL_REL)),
    ("{txt} in " + names(fixed.NEXT_TEXTS), text(fixed.SIGNAL_TEXT) + " || {txt}"),
    ("regexp_matches({href}, " + rx(fixed.PAGING_HREF) + ")", text(fixed.SIGNAL_HREF)),
    (
        "(regexp_matches({cls}, " + rx(fixed.PAGING_CLASS) + ") or regexp_matches({id}, "
        + rx(fixed.PAGING_CLASS) + "))",
        text(fixed.SIGNAL_ANCHOR),
    ),
]


def label_list(**columns) -> str:
    def filled(part: str) -> str:
        for name, sql in columns.items():
            part = part.replace("{" + name + "}", sql)
        return part

    cases = ", ".join(f"case when {filled(t)} then {filled(label)} end" for t, label in LABELS)
    return f"list_filter([{cases}], lambda x: x is not null)"


def anchors_of(source: str, markup: str) -> str:
    """SQL for the anchors (with href) of each row of ``source``."""
    tag = f"regexp_extract(piece, {rx(f'^({INSIDE})>')}, 1)"
    behind = f"regexp_extract(piece, {rx(f'(?s)^{INSIDE}>(.*)$')}, 1)"
    inner = rf"regexp_split_to_array({behind}, '(?i)</a\s*>')[1]"
    return f"""
      select job_id, url, no, href, coalesce({attr('tag', 'rel')}, '') as rel,
        coalesce({attr('tag', 'class')}, '') as cls, coalesce({attr('tag', 'id')}, '') as id,
        {nodes('inner_html')} as texts
      from (
        select job_id, url, no, {tag} as tag, {inner} as inner_html, {attr(tag, 'href')} as href
        from (
          select job_id, url, unnest(pieces) as piece, generate_subscripts(pieces, 1) - 1 as no
          from (select job_id, url, regexp_split_to_array({markup}, '(?i)<a\\s')[2:] as pieces from {source})
        )
      ) where href is not null"""


def structure(markup: str) -> str:
    anchors = (
        f"len(list_filter(regexp_split_to_array({markup}, '(?i)<a\\s')[2:], "
        rf"lambda p: regexp_matches(regexp_extract(p, {rx(f'^({INSIDE})>')}, 1), '(?i)(?:^|\s)href\s*=')))"
    )
    blocks = count(markup, r"(?i)<(?:article|table|ul|ol|h[1-3])\b")
    return f"{blocks} + {anchors} + {count(markup, RECORD_CLASS)}"


def profiled(condition: str, value: str, empty: str) -> str:
    return f"case when reached then case when {condition} then {value} else {empty} end end"


# --- steps ------------------------------------------------------------------------
STEPS: dict[str, str] = {}

STEPS["captures"] = derived.for_views(derived.CAPTURES)
STEPS["requests"] = f"""
  select *,
    list_filter(list_transform(string_split(fields_text, ','), lambda x: {trim('x')}), lambda x: x <> '') as fields,
    list_filter(list_transform(string_split(coalesce(outputs_text, 'csv'), ','), lambda x: {trim('x')}), lambda x: x <> '') as outputs
  from captures"""
STEPS["gate"] = f"""
  select *, list_transform(fields, lambda f: lower({trim('f')})) as requested,
    list_filter(list_transform(fields, lambda f: lower({trim('f')})), lambda f: f in {names(fixed.SENSITIVE_FIELDS)}) as blocked_fields,
    case when len(blocked_fields) > 0 then 'high' else 'low' end as risk_level,
    case when len(blocked_fields) > 0 then 'blocked' else 'permitted' end as risk_decision,
    case when len(blocked_fields) > 0
      then 'Requested fields contain sensitive data categories: ' || {list_repr('blocked_fields')} || '. Collection of these fields is not permitted.'
      else 'All requested fields (' || {list_repr('requested')} || ') passed sensitive-field check. Risk level: low.' end as risk_reason
  from requests"""
STEPS["flags"] = f"""
  select *, error is null as reached, coalesce(status in {BLOCKED}, false) as stop_,
    case when error is null then lower(content_type) end as low_type,
    case when error is null then not coalesce(status in {BLOCKED}, false) and (contains(lower(content_type), 'application/json') or contains(lower(content_type), 'text/json')) end as is_json,
    case when error is null then not coalesce(status in {BLOCKED}, false) and (contains(lower(content_type), 'application/xml') or contains(lower(content_type), 'text/xml')) end as is_xml,
    case when error is null then not coalesce(status in {BLOCKED}, false) and contains(lower(content_type), 'text/html') end as is_html
  from gate"""
STEPS["doms"] = f"""
  select job_id, url, status, fields, requested, body as html, regexp_replace(body, {rx(fixed.TRIVIA)}, '<!>', 'g') as dom
  from flags where is_html"""
STEPS["page_text"] = f"select job_id, {plain('dom')} as txt from doms"
STEPS["anchors"] = anchors_of("doms", "dom")
STEPS["labels"] = (
    "select job_id, no, "
    + label_list(rel="rel", txt="lower(array_to_string(texts, ' '))", href="href", cls="cls", id="id")
    + " as labels, len(texts) > 0 as has_text from anchors"
)
STEPS["signal_order"] = """
  select job_id, label, min(no * 10 + ix) as first_at
  from (select job_id, no, unnest(labels) as label, generate_subscripts(labels, 1) as ix from labels)
  group by job_id, label"""
STEPS["signals"] = f"""
  select d.job_id, list_concat(coalesce(s.found, []), case when regexp_matches(d.dom, {rx(PAGING_ELEMENT)})
    then [{text(fixed.SIGNAL_ELEMENT)}] else [] end) as signals
  from doms d left join (select job_id, list(label order by first_at) as found from signal_order group by job_id) s using (job_id)"""
STEPS["anchor_counts"] = """
  select job_id, count(*) as n, count(*) filter (where len(labels) > 0) as next_n, bool_or(has_text) as with_text
  from labels group by job_id"""
STEPS["measures"] = f"""
  select d.job_id, d.requested, t.txt, g.signals, coalesce(a.n, 0) as links, coalesce(a.next_n, 0) as next_n,
    {count('d.dom', '(?i)<h[1-3]' + chr(92) + 'b')} as headings,
    {count('t.txt', fixed.PROFILE_PRICE)} as prices,
    len(list_filter(regexp_extract_all(d.html, {rx(fixed.TRIVIA)}), lambda x: lower(x[1:7]) = '<script')) as scripts,
    regexp_extract(d.dom, '(?is)<title\\b[^>]*>([^<]*)</title', 1) <> ''
      or {count('d.dom', '(?i)<h[1-3]' + chr(92) + 'b')} > 0 or coalesce(a.with_text, false) as title_seen,
    regexp_matches(t.txt, {rx(fixed.AVAILABILITY)}) as stock_seen
  from doms d join page_text t using (job_id) join signals g using (job_id) left join anchor_counts a using (job_id)"""
STEPS["hits"] = f"""
  select *, list_filter(requested, lambda f: case when f in {names(fixed.TITLE_NAMES)} then title_seen
    when f in {names(fixed.URL_NAMES)} then links > 0 when f = 'price' then prices > 0
    when f = 'availability' then stock_seen else contains(lower(txt), f) end) as hits
  from measures"""
STEPS["profile"] = f"""
  select f.job_id, f.url, f.fields, f.outputs, f.body, f.error, f.reached, f.stop_, f.requested, f.blocked_fields,
    f.risk_level, f.risk_decision, f.risk_reason, f.is_json, f.is_xml, f.is_html,
    case when reached then f.status end as status_code, f.low_type as content_type,
    case when reached then strlen(f.body) end as html_size,
    {profiled('h.job_id is not null', 'h.scripts > 5 and length(h.txt) < 200', 'false')} as js_heavy,
    {profiled('h.job_id is not null', 'h.signals', '[]')} as pagination_signals,
    {profiled('h.job_id is not null', 'h.next_n', '0')} as next_page_candidates_count,
    {profiled('h.job_id is not null', 'h.hits', '[]')} as visible_field_hits,
    {profiled('h.job_id is not null', 'h.links', '0')} as link_count,
    {profiled('h.job_id is not null', 'h.headings', '0')} as title_candidates_count,
    {profiled('h.job_id is not null', 'h.prices', '0')} as price_candidates_count,
    len(pagination_signals) > 0 as has_pagination,
    len(visible_field_hits) > 0 as data_visible_in_html,
    case when not reached then 'Network error while profiling ' || f.url || ': ' || f.error end as profile_error
  from flags f left join hits h using (job_id)"""

# --- robots ---
STEPS["robots_files"] = derived.for_views(derived.ROBOTS_FILES)
STEPS["outcomes"] = """
  select origin, status, error, body, case when error is not null then 'warning' when status in (401, 403) then 'disallow_all'
    when status between 400 and 499 then 'allow_all' when status >= 500 then 'unread' else 'parse' end as outcome
  from robots_files"""
STEPS["robots_lines"] = f"""
  select origin, line_no, line, key_, url_decode({trim("regexp_replace(clean, '(?s)^[^:]*:', '')")}) as value
  from (select *, case when contains(clean, ':') then lower({trim("split_part(clean, ':', 1)")}) else '' end as key_
    from (select *, {trim("split_part(line, '#', 1)")} as clean
      from (select origin, unnest(lines) as line, generate_subscripts(lines, 1) as line_no
        from (select origin, regexp_split_to_array(body, '\\r\\n|[\\n\\r]') as lines from outcomes where outcome = 'parse'))))"""
STEPS["robots_events"] = """
  select * from (select *, case when line = '' then 'e' when key_ = 'user-agent' then 'a'
    when key_ in ('allow', 'disallow', 'crawl-delay', 'request-rate') then 'r' end as event
  from robots_lines) where event is not null"""
STEPS["robots_numbered"] = """
  select *, sum(case when event = 'e' then 1 else 0 end) over (partition by origin, group_no order by line_no) as ends
  from (select *, sum(opens) over (partition by origin order by line_no) as group_no
    from (select *, case when event = 'a' and coalesce(lag(event) over (partition by origin order by line_no), '') <> 'a' then 1 else 0 end as opens
      from robots_events))"""
STEPS["robots_groups"] = """
  select origin, group_no, list(value order by line_no) filter (where event = 'a') as agents
  from robots_numbered where group_no > 0 and ends = 0
  group by origin, group_no having bool_or(event = 'r')"""
STEPS["robots_rules"] = """
  select g.origin, g.group_no, g.agents, r.rule_no, r.allow, r.path from robots_groups g left join (
    select origin, group_no, row_number() over (partition by origin, group_no order by line_no) - 1 as rule_no,
      key_ = 'allow' or value = '' as allow,
      replace(url_encode(regexp_replace(value, '\\??#?$', '')), '%2F', '/') as path
    from robots_numbered where ends = 0 and key_ in ('allow', 'disallow')) r using (origin, group_no)"""
STEPS["robots_chosen"] = f"""
  select origin, group_no from (
    select origin, group_no, list_contains(agents, '*') as star,
      len(list_filter(agents, lambda a: contains('{AGENT}', lower(a)))) > 0 as named
    from robots_groups)
  where star or named
  qualify row_number() over (partition by origin order by star, group_no) = 1"""
STEPS["asked"] = """
  select job_id, url, origin, shown, case when p = '' then '/' else p end as path_query
  from (select job_id, url, regexp_extract(url, '^(https?://[^/?#]*)', 1) as origin,
      case when regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) = '' then '/' else regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) end as shown,
      replace(url_encode(regexp_replace(regexp_replace(url_decode(url), '^https?://[^/?#]*', ''), '\\??#?$', '')), '%2F', '/') as p
    from captures)"""
STEPS["matched"] = """
  select a.job_id, arg_min(r.allow, r.rule_no) as allow
  from asked a join robots_chosen c using (origin) join robots_rules r on r.origin = c.origin and r.group_no = c.group_no
  where r.rule_no is not null and starts_with(a.path_query, r.path) group by a.job_id"""
STEPS["robots"] = f"""
  select *, case robots_decision
    when 'warning' then 'Could not read robots.txt at ' || origin || '/robots.txt: ' || coalesce(robots_error, 'not captured') || '. Proceeding with caution.'
    when 'permitted' then 'robots.txt at ' || origin || '/robots.txt permits ''{fixed.USER_AGENT}'' to access path ''' || shown || '''.'
    else 'robots.txt at ' || origin || '/robots.txt disallows ''{fixed.USER_AGENT}'' from accessing path ''' || shown || '''. Job blocked.' end as robots_reason
  from (select a.job_id, a.url, a.origin, a.shown, o.error as robots_error,
      case when o.outcome is null or o.outcome = 'warning' then 'warning' when o.outcome in ('disallow_all', 'unread') then 'blocked'
        when o.outcome = 'allow_all' then 'permitted' when coalesce(m.allow, true) then 'permitted' else 'blocked' end as robots_decision
    from asked a left join outcomes o using (origin) left join matched m using (job_id))"""
STEPS["authorized"] = f"""
  select job_id, robots_decision, robots_reason,
    case when risk_level = 'high' then 'risk_engine' when robots_decision = 'blocked' then 'robots_checker'
      when error is not null or stop_ then 'source_profiler' end as blocked_by,
    blocked_by is null as allowed,
    case when risk_level = 'high' or robots_decision = 'blocked' or (error is null and stop_) then 'blocked' else robots_decision end as authorization_status
  from flags join robots using (job_id)"""


def strategy_case(allowed: str) -> str:
    return f"""case when not ({allowed}) then 'blocked' when coalesce(is_json, false) then 'api_json' when coalesce(is_xml, false) then 'api_xml'
      when coalesce(is_html, false) and data_visible_in_html and has_pagination then 'scrapy'
      when coalesce(is_html, false) and data_visible_in_html and not js_heavy then 'static_html'
      when coalesce(is_html, false) and js_heavy then 'selenium' else 'manual_review' end"""


LOCAL = f"(risk_level = 'low' and reached and not stop_)"
JSON_URL = "ends_with(lower(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)), '.json')"
XML_URL = "regexp_matches(lower(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)), '\\.(xml|rss|atom)$')"


def route_sql(source: str, html: bool) -> str:
    """Route, confidence, reasons and next step of each row of ``source``."""
    phrase = "blocked_pattern" if html else "null"
    json_text = "json_like_content" if html else "false"
    xml_text = "xml_like_content" if html else "false"
    kind = "lower(coalesce(content_type, ''))"
    provided = "html_provided" if html else "false"
    seen = "" if not html else f"""
        when html_length < 80 then 'short'
        when script_count >= 6 and visible_text_length < 120 then 'scripts'
        when visible_text_length >= 120 or target_like_structure_count > 0 or coalesce(data_visible_in_html, false)
          then case when html_has_pagination or coalesce(has_pagination, false) then 'crawl' else 'static' end"""
    routes = {"json": "api_like_json", "xml": "api_like_xml", "unseen_js": "browser_render", "unseen_crawl": "scrapy_crawl",
              "unseen_static": "static_html", "short": "browser_render", "scripts": "browser_render", "crawl": "scrapy_crawl",
              "static": "static_html"}
    colors = {"json": "green", "xml": "green", "crawl": "green", "static": "green", "stop": "red", "unclear": "red"}
    steps = {"stop": "stop", "json": "json", "xml": "xml", "unseen_js": "render", "unseen_crawl": "crawl", "unseen_static": "static",
             "unseen": "fetch", "short": "short", "scripts": "scripts", "crawl": "crawl", "static": "static", "unclear": "unclear"}
    f = fixed
    a, b = f.REASON_STATUS
    structure_count = "target_like_structure_count > 0" if html else "false"
    reasons = [
        ("case_ = 'stop' and blocked_status", f"{text(a)} || status_code || {text(b)}"),
        ("case_ = 'stop' and profile_error is not null", text(f.REASON_PROFILE_ERROR)),
        (f"case_ = 'stop' and {phrase} is not null", f"{text(f.REASON_PHRASE)} || {phrase}"),
        ("case_ = 'json'", text(f.REASON_JSON)),
        (f"case_ = 'json' and {JSON_URL}", text(f.REASON_JSON_URL)),
        ("case_ = 'xml'", text(f.REASON_XML)),
        (f"case_ = 'xml' and {XML_URL}", text(f.REASON_XML_URL)),
        ("case_ = 'xml' and coalesce(is_xml, false)", text(f.REASON_XML_PROFILE)),
        ("starts_with(case_, 'unseen')", text(f.REASON_NO_HTML)),
        ("case_ = 'unseen_js'", text(f.REASON_JS)),
        ("case_ in ('unseen_crawl', 'unseen_static')", text(f.REASON_VISIBLE)),
        ("case_ = 'unseen_crawl'", text(f.REASON_PAGED)),
        ("case_ = 'short'", text(f.REASON_SHORT)),
        ("case_ = 'scripts'", text(f.REASON_SCRIPTS)),
        ("case_ = 'scripts'", text(f.REASON_LOW_TEXT)),
        ("case_ = 'crawl'", text(f.REASON_HTML_VISIBLE)),
        ("case_ = 'crawl'", text(f.REASON_HTML_PAGED)),
        ("case_ = 'static'", text(f.REASON_STATIC)),
        (f"case_ = 'static' and {structure_count}", text(f.REASON_STRUCTURE)),
        ("case_ = 'unclear'", text(f.REASON_NONE)),
    ]
    reason_list = ", ".join(f"case when {t} then {v} end" for t, v in reasons)
    return f"""
      select * exclude (case_, blocked_status),
        coalesce({when_equal('case_', routes)}, 'fallback_manual_review') as route,
        coalesce({when_equal('case_', colors)}, 'yellow') as confidence,
        list_filter([{reason_list}], lambda x: x is not null) as route_reasons,
        {when_equal('case_', {k: f.NEXT_STEP[v] for k, v in steps.items()})} as recommended_next_step
      from (select *, coalesce(status_code in {BLOCKED}, false) as blocked_status,
        case when coalesce(status_code in {BLOCKED}, false) or profile_error is not null or {phrase} is not null then 'stop'
          when {JSON_URL} or contains({kind}, 'json') or coalesce(is_json, false) or {json_text} then 'json'
          when {XML_URL} or contains({kind}, 'xml') or contains({kind}, 'rss') or contains({kind}, 'atom') or coalesce(is_xml, false) or {xml_text} then 'xml'
          when not {provided} and coalesce(js_heavy, false) then 'unseen_js'
          when not {provided} and coalesce(data_visible_in_html, false) and coalesce(has_pagination, false) then 'unseen_crawl'
          when not {provided} and coalesce(data_visible_in_html, false) then 'unseen_static'
          when not {provided} then 'unseen'{seen} else 'unclear' end as case_
        from {source})"""


EXPLANATION = (
    "'Scrape route: ' || route || ' (' || confidence || ')' || chr(10) || 'Reasons:' || chr(10) || "
    "array_to_string(list_transform(route_reasons, lambda r: '  - ' || r), chr(10)) || chr(10) || "
    "'Recommended next step: ' || recommended_next_step"
)
JSON_LIKE = f"(coalesce({trim('body')}[1] in ('{{', '['), false) and json_valid({trim('body')}))"
XML_LIKE = (
    f"(starts_with({trim('body')}, '<') and ("
    + " or ".join(f"starts_with(lower({trim('body')}), {text(s)})" for s in fixed.XML_STARTS)
    + " or "
    + " or ".join(f"regexp_matches(body, '(?is)<{t}\\b[^>]*>.*</{t}>')" for t in fixed.XML_RECORD_TAGS)
    + "))"
)
PHRASE = (
    "case " + " ".join(f"when contains(lower(body), {text(p)}) then {text(p)}" for p in fixed.BLOCKED_PHRASES) + " end"
)
STEPS["content"] = f"""
  select *, body is not null as html_provided, coalesce(length(body), 0) as html_length, {PHRASE} as blocked_pattern,
    coalesce({JSON_LIKE}, false) as json_like_content,
    coalesce(not {JSON_LIKE} and {XML_LIKE}, false) as xml_like_content
  from profile"""
STEPS["content_dom"] = f"""
  select job_id, url, body, dom, regexp_replace(dom, {rx(fixed.NOSCRIPT)}, '<!>', 'g') as bare
  from (select job_id, url, body, regexp_replace(body, {rx(fixed.TRIVIA)}, '<!>', 'g') as dom
    from content where html_provided and not json_like_content and not xml_like_content)"""
STEPS["content_anchors"] = anchors_of("content_dom", "dom")
STEPS["content_labels"] = (
    "select job_id, no, "
    + label_list(rel="rel", txt="lower(array_to_string(texts, ' '))", href="href", cls="cls", id="id")
    + " as labels from content_anchors"
)
STEPS["content_order"] = """
  select job_id, list(label order by first_at) as found, max(next_n) as next_n from (
    select job_id, label, min(no * 10 + ix) as first_at, any_value(next_n) as next_n
    from (select job_id, no, unnest(labels) as label, generate_subscripts(labels, 1) as ix,
        count(*) over (partition by job_id) as all_n, n.next_n as next_n
      from content_labels join (select job_id, count(*) filter (where len(labels) > 0) as next_n from content_labels group by job_id) n using (job_id))
    group by job_id, label) group by job_id"""
STEPS["html_signals"] = f"""
  select c.*, coalesce({count('d.body', '(?i)<script' + chr(92) + 'b')}, 0) as script_count,
    coalesce(length({plain('d.bare')}), 0) as visible_text_length,
    coalesce({structure('d.bare')}, 0) as target_like_structure_count,
    case when d.job_id is null then [] else list_concat(coalesce(o.found, []),
      case when regexp_matches(d.dom, {rx(PAGING_ELEMENT)}) then [{text(fixed.SIGNAL_ELEMENT)}] else [] end) end as html_pagination_signals,
    len(html_pagination_signals) > 0 as html_has_pagination,
    coalesce(o.next_n, 0) as html_next_page_candidates_count
  from content c left join content_dom d using (job_id) left join content_order o using (job_id)"""
STEPS["routed"] = route_sql("html_signals", html=True)
STEPS["local_route"] = route_sql(f"(select *, {strategy_case(LOCAL)} as strategy from profile)", html=False)
STEPS["seen_profile"] = """
  select p.job_id, p.url, p.fields, p.outputs, p.risk_level, p.risk_decision, p.risk_reason, a.robots_decision, a.robots_reason,
    a.blocked_by, a.allowed, a.authorization_status,
    case when a.blocked_by in ('risk_engine', 'robots_checker') then null else p.profile_error end as profile_error,
    """ + ", ".join(
    f"case when a.blocked_by in ('risk_engine', 'robots_checker') then null else p.{c} end as {c}"
    for c in ["status_code", "content_type", "html_size", "is_json", "is_xml", "is_html", "js_heavy", "has_pagination",
              "pagination_signals", "next_page_candidates_count", "data_visible_in_html", "visible_field_hits",
              "link_count", "title_candidates_count", "price_candidates_count"]
) + " from profile p join authorized a using (job_id)"
STEPS["decided_route"] = route_sql(f"(select *, {strategy_case('allowed')} as strategy from seen_profile)", html=False)
STEPS["decided"] = """
  select *, case when allowed then case when route = 'api_like_json' then 'api_like_json' else strategy end end as extractor
  from decided_route"""
STEPS["local"] = f"""
  select job_id, url, fields, body, case when {LOCAL} then case when route = 'api_like_json' then 'api_like_json' else strategy end end as extractor
  from local_route"""

# --- one-page items ---
STEPS["link_rows"] = f"""
  select job_id, url, row_number() over (partition by job_id order by no) - 1 as pos,
    case when array_to_string(texts, '') = '' then {trim('href')} else array_to_string(texts, '') end as title, {trim('href')} as href
  from anchors where {usable(trim('href'))}"""
STEPS["title_rows"] = f"""
  select d.job_id, d.url, case when t = '' then d.url else {trim('t')} end as title
  from (select job_id, url, {decode("regexp_extract(dom, '(?is)<title" + chr(92) + "b[^>]*>([^<]*)</title', 1)")} as t from doms) d
  where not exists (select 1 from link_rows l where l.job_id = d.job_id)"""
JSON_PATHS = ["$.items", "$.items.page.rows", "$.products", "$.data", "$.data.items", "$.results"]


def json_list(body: str, path: str) -> str:
    return f"list_filter(json_extract({body}, '{path}[*]'), lambda x: json_type(x) = 'OBJECT')"


STEPS["json_lists"] = f"""
  select job_id, url, fields, status, error, body, valid_, case when valid_ then case when json_type(body) = 'ARRAY' then {json_list('body', '$')}
    {' '.join(f"when len({json_list('body', p)}) > 0 then {json_list('body', p)}" for p in JSON_PATHS)} else [] end end as found
  from (select job_id, url, fields, status, error, coalesce(json_valid(body), false) as valid_,
      case when json_valid(body) then body end as body
    from requests where contains(url, '//api'))"""
STEPS["json_rows"] = """
  select job_id, url, fields, unnest(found) as rec, generate_subscripts(found, 1) - 1 as pos from json_lists"""
STEPS["json_fields"] = """
  select * from (select job_id, url, fields, pos, rec, field, case when json_exists(rec, '$.' || field) then field
      when field = 'url' and json_exists(rec, '$.href') then 'href' when field = 'url' and json_exists(rec, '$.link') then 'link'
      when field = 'url' and json_exists(rec, '$.path') then 'path' end as holder
  from (select job_id, url, fields, pos, rec, unnest(list_distinct(fields)) as field from json_rows))
  where holder is not null"""
STEPS["json_values"] = """
  select job_id, url, fields, pos, field, json_extract_string(rec, '$.' || holder) as value, json_type(rec, '$.' || holder) as kind
  from json_fields"""
STEPS["json_items"] = """
  select r.job_id, r.url as base_url, r.fields, r.pos, max(v.value) filter (where v.field = 'title') as title,
    max(v.value) filter (where v.field = 'url') as url, max(v.value) filter (where v.field = 'price') as price,
    max(v.kind) filter (where v.field = 'title') as title_kind, max(v.kind) filter (where v.field = 'price') as price_kind,
    max(v.value) filter (where v.field = 'stock') as stock, max(v.value) filter (where v.field = 'note') as note,
    max(v.kind) filter (where v.field = 'stock') as stock_kind
  from json_rows r left join json_values v on v.job_id = r.job_id and v.pos = r.pos
  group by r.job_id, r.url, r.fields, r.pos"""
STEPS["xml_docs"] = """
  select job_id, url, fields, status, error, body, len(regexp_extract_all(body, '<[a-z]+[^>]*>')) = len(regexp_extract_all(body, '</[a-z]+>')) as valid_
  from requests where contains(url, '//feeds')"""
STEPS["xml_lists"] = """
  select job_id, url, fields, tag, case tag when 'none' then [] else regexp_extract_all(body, '(?s)<' || tag || '>(.*?)</' || tag || '>', 1) end as found
  from (select *, case when contains(body, '<item>') then 'item' when contains(body, '<product>') then 'product' when contains(body, '<entry>') then 'entry'
      when len(regexp_extract_all(body, '<record>')) > 1 then 'record' else 'none' end as tag from xml_docs where valid_)"""
STEPS["xml_rows"] = """
  select job_id, url, fields, tag, unnest(found) as rec, generate_subscripts(found, 1) - 1 as pos from xml_lists"""
STEPS["xml_values"] = f"""
  select job_id, url, fields, pos, key, {trim('value')} as value
  from (select job_id, url, fields, pos, unnest(regexp_extract_all(rec, '<([a-z]+)>([^<]*)</', 1)) as key,
      unnest(regexp_extract_all(rec, '<([a-z]+)>([^<]*)</', 2)) as value, generate_subscripts(regexp_extract_all(rec, '<([a-z]+)>([^<]*)</', 1), 1) as ix
    from xml_rows)
  where {trim('value')} <> '' qualify row_number() over (partition by job_id, pos, key order by ix desc) = 1"""
STEPS["xml_items"] = """
  select r.job_id, r.url as base_url, r.fields, r.pos, max(v.value) filter (where v.key = 'title') as title,
    max(v.value) filter (where v.key = 'url') as url, max(v.value) filter (where v.key = 'price') as price
  from xml_rows r left join xml_values v on v.job_id = r.job_id and v.pos = r.pos and list_contains(r.fields, v.key)
  group by r.job_id, r.url, r.fields, r.pos"""

# --- listing pages and walks ---
STEPS["walk_pages"] = f"""
  select job_id, url, regexp_replace(body, {rx(fixed.TRIVIA)}, '<!>', 'g') as dom
  from captures where contains(lower(content_type), 'text/html') and coalesce(status not in {BLOCKED}, true) and body is not null"""
STEPS["fetched_pages"] = "select * from walk_pages where job_id in (select job_id from robots where robots_decision <> 'blocked')"
STEPS["walk_anchors"] = anchors_of("walk_pages", "dom")
CARD = r"""(?s)<div class=["'](?:product-card|Item|card-empty)["'](?: data-note="1 > 0")?>(.*?)</div>"""
STEPS["cards"] = f"""
  select job_id, url, unnest(found) as card, generate_subscripts(found, 1) - 1 as pos
  from (select job_id, url, list_concat(regexp_extract_all(dom, '(?s)<section class="listing">(.*)</section>', 1), regexp_extract_all(dom, {rx(CARD)}, 1)) as found
    from walk_pages)"""


def inner(tag: str) -> str:
    found = rf"(?is)<{tag}(?:\s{INSIDE})?>(.*?)</{tag}>"
    return squeeze(plain(f"regexp_extract(card, {rx(found)}, 1)"))


CARD_HREF = trim(decode(r"""regexp_extract(card, '(?is)<a\s(?:[^>=]|=\s*"[^"]*")*?href\s*=\s*"([^"]*)"', 1)"""))
CARD_PRICE_TEXT = squeeze(plain(r"""regexp_extract(card, '(?s)<p class="price">(.*?)</p>', 1)"""))
STEPS["card_values"] = f"""
  select job_id, url as page_url, pos, card,
    coalesce(nullif({inner('h1')}, ''), nullif({inner('h2')}, ''), nullif({inner('h3')}, ''), nullif({inner('a')}, ''), '') as title,
    case when {usable(CARD_HREF)} then {resolve('url', CARD_HREF)} else '' end as url,
    coalesce(nullif({CARD_PRICE_TEXT}, ''), {squeeze(f"regexp_extract({plain('card')}, {rx(fixed.CARD_PRICE)}, 0)")}) as price
  from cards"""
STEPS["card_records"] = """
  select job_id, page_url, row_number() over (partition by job_id order by pos) - 1 as pos, title, url, price
  from card_values where title <> '' or url <> ''"""
STEPS["card_first"] = """
  select * from card_records qualify row_number() over (partition by job_id, title, url order by pos) = 1"""
STEPS["link_records"] = f"""
  select job_id, url as page_url, row_number() over (partition by job_id order by no) - 1 as pos,
    case when {squeeze("array_to_string(texts, ' ')")} = '' then {trim('href')} else {squeeze("array_to_string(texts, ' ')")} end as title,
    {resolve('url', trim('href'))} as url, '' as price
  from walk_anchors where {usable(trim('href'))}"""
STEPS["link_first"] = """
  select * from link_records l where not exists (select 1 from card_records c where c.job_id = l.job_id)
  qualify row_number() over (partition by job_id, title, url order by pos) = 1"""
STEPS["records"] = "select * from card_first union all select * from link_first"
STEPS["edges"] = f"""
  select job_id, url, next_url, min(no) as no from (
    select a.job_id, a.url, a.no, {resolve('a.url', trim('a.href'))} as next_url
    from walk_anchors a join (select job_id, len(regexp_extract_all(split_part(dom, '<nav class="pager">', 1), '(?i)<a\\s')) as lo,
        len(regexp_extract_all(regexp_extract(dom, '(?s)<nav class="pager">(.*?)</nav>', 1), '(?i)<a\\s')) as n, contains(dom, '<nav class="pager">') as has_nav
      from walk_pages) w using (job_id)
    where len({label_list(rel='a.rel', txt=squeeze("lower(array_to_string(a.texts, ' '))"), href='a.href', cls='a.cls', id='a.id')}) > 0
      or (has_nav and a.no >= lo and a.no < lo + n))
  where lower(regexp_extract(next_url, '^https?://([^/?#]*)', 1)) = lower(regexp_extract(url, '^https?://([^/?#]*)', 1))
  group by job_id, url, next_url"""
STEPS["edge_lists"] = """
  select w.url, coalesce(e.next_urls, []) as next_urls
  from (select url, min(job_id) as job_id from fetched_pages group by url) w
  left join (select job_id, list(next_url order by no) as next_urls from edges group by job_id) e using (job_id)"""


def walk_steps(seeds: str, prefix: str) -> dict[str, str]:
    """Recursive walk: one queue entry per step, each seed at most five pages."""
    return {
        f"{prefix}steps": f"""
          select url as seed, cast([] as varchar[]) as visited, [url] as queue from (select distinct url from {seeds})
          union all
          select s.seed, case when e.url is not null and not list_contains(s.visited, s.queue[1]) then list_append(s.visited, s.queue[1]) else s.visited end,
            case when e.url is not null and not list_contains(s.visited, s.queue[1]) then list_concat(s.queue[2:], e.next_urls) else s.queue[2:] end
          from {prefix}steps s left join edge_lists e on e.url = s.queue[1]
          where len(s.queue) > 0 and len(s.visited) < {fixed.MAX_PAGES}""",
        f"{prefix}pages": f"""
          select seed, unnest(visited) as url, generate_subscripts(visited, 1) - 1 as page_seq
          from (select seed, arg_max(visited, len(visited)) as visited from {prefix}steps group by seed)""",
    }


STEPS["html_seeds"] = "select url from doms"
STEPS |= walk_steps("html_seeds", "all_walk_")
STEPS["crawl_jobs"] = "select job_id, url, fields from decided where extractor = 'scrapy'"
STEPS |= walk_steps("crawl_jobs", "job_walk_")
STEPS["record_of_url"] = """
  select r.*, w.url as at_url from records r join (select url, min(job_id) as job_id from fetched_pages group by url) w using (job_id)"""


def shaped(fields: str) -> str:
    wanted = f"list_transform({fields}, lambda f: lower({trim('f')}))"
    return (
        f"case when list_has_any({wanted}, ['title', 'name', 'heading']) then nullif(r.title, '') end as title, "
        f"case when list_has_any({wanted}, ['url', 'href', 'link']) then nullif(r.url, '') end as url, "
        f"case when list_has_any({wanted}, ['price']) then nullif(r.price, '') end as price"
    )


STEPS["crawled"] = f"""
  select j.job_id, j.url as base_url, p.page_seq, r.pos, {shaped('j.fields')},
    row_number() over (partition by j.job_id order by p.page_seq, r.pos) as nth
  from crawl_jobs j join job_walk_pages p on p.seed = j.url join record_of_url r on r.at_url = p.url"""

# --- all items of allowed jobs ---
NO_KINDS = "null as title_kind, null as price_kind, null as stock, null as note, null as stock_kind"
STEPS["raw_items"] = f"""
  select d.job_id, d.url as base_url, 0 as page_seq, l.pos, l.title, l.href as url, null as price, 'static_html' as source, {NO_KINDS}
  from decided d join link_rows l using (job_id) where extractor = 'static_html'
  union all by name
  select d.job_id, d.url as base_url, 0 as page_seq, 0 as pos, t.title, t.url, null as price, 'static_html_fallback' as source, {NO_KINDS}
  from decided d join title_rows t using (job_id) where extractor = 'static_html'
  union all by name
  select i.job_id, i.base_url, 0 as page_seq, i.pos, i.title, i.url, i.price, 'api_like_json' as source, i.title_kind, i.price_kind, i.stock, i.note, i.stock_kind
  from decided d join json_items i using (job_id) where extractor in ('api_json', 'api_like_json')
  union all by name
  select i.job_id, i.base_url, 0 as page_seq, i.pos, i.title, i.url, i.price, 'api_xml' as source, {NO_KINDS}
  from decided d join xml_items i using (job_id) where extractor = 'api_xml'
  union all by name
  select job_id, base_url, page_seq, pos, title, url, price, 'scrapy' as source, {NO_KINDS} from crawled where nth <= {fixed.MAX_ITEMS}"""


def cleaned_price(x: str) -> str:
    bare = f"regexp_replace({x}, {rx(fixed.PRICE_STRIP)}, '', 'g')"
    return f"case when {is_number(bare)} then {bare} end"


def clean_sql(source: str) -> str:
    number = "('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN')"
    return f"""
      select * exclude (title, url, price, stock, title_, url_, price_), title_ as title, url_ as url, price_ as price,
        case when stock_kind = 'VARCHAR' then {squeeze('stock')} else stock end as stock
      from (select *, case when title_kind in {number} then title else {squeeze('title')} end as title_,
        case when url is not null then {resolve('base_url', squeeze('url'))} end as url_,
        case when price_kind in {number} then price when {squeeze('price')} = '' then '' else {cleaned_price('price')} end as price_
        from {source})"""


def rule_sql(title="title", url="url", price="price", kind="title_kind") -> tuple[str, str, str]:
    return (
        f"case when {title} is null or {trim(title)} = '' or ({kind} <> 'VARCHAR' and {title} in ('0', '0.0', 'false', '[]', '{{}}')) then {text(fixed.ERROR_TITLE)} end",
        f"case when {url} is null or {url} = '' then {text(fixed.ERROR_URL)} when not (starts_with({url}, 'http://') or starts_with({url}, 'https://')) "
        f"then {text(fixed.ERROR_SCHEME)} || {url} || '''.' end",
        f"case when {price} is not null and not {is_number(price)} then {text(fixed.ERROR_PRICE)} || {price} || '''.' end",
    )


STEPS["clean_items"] = clean_sql("raw_items")
STEPS["checked"] = f"select *, coalesce({', '.join(rule_sql())}) as validation_error from clean_items"
STEPS["unique_items"] = """
  select *, count(*) over (partition by job_id, url) as copies from checked where validation_error is null
  qualify row_number() over (partition by job_id, url order by page_seq, pos) = 1"""
STEPS["item_counts"] = """
  select job_id, count(*) as raw_n, count(*) filter (where validation_error is null) as good_n,
    count(distinct case when validation_error is null then url end) as unique_n,
    count(*) filter (where validation_error is not null) as bad_n
  from checked group by job_id"""
STEPS["jobs"] = """
  select d.*, coalesce(c.raw_n, 0) as raw_n, coalesce(c.good_n, 0) as good_n, coalesce(c.unique_n, 0) as unique_n, coalesce(c.bad_n, 0) as bad_n,
    coalesce(jl.valid_, false) as json_read, coalesce(x.valid_, false) as xml_read
  from decided d left join item_counts c using (job_id)
  left join (select job_id, coalesce(json_valid(body), false) as valid_ from captures) jl using (job_id)
  left join xml_docs x using (job_id)"""
EXTRACTED = """case when extractor in ('api_json', 'api_like_json') then case when json_read then 'json_extracted' else 'json_parse_failed' end
    when extractor = 'api_xml' then case when xml_read then 'xml_extracted' else 'xml_parse_failed' end
    when extractor in ('static_html', 'scrapy') then 'extracted' when extractor is not null then extractor || '_skipped' end"""
SKIPPED = (
    "'Strategy ''' || extractor || ''' was selected but its extractor is not implemented in V1. ' || "
    + when_equal("extractor", fixed.SKIPPED_NOTE) + " || ' No items extracted.'"
)
NOTE = f"""case when {EXTRACTED} = 'json_parse_failed' then 'json_extractor: invalid JSON from ' || url
    when {EXTRACTED} = 'xml_parse_failed' then 'xml_extractor: invalid XML from ' || url
    when extractor in ('selenium', 'manual_review') then {SKIPPED} end"""
STATUS_REASON = when_equal("status_code", fixed.BLOCKED_STATUS_REASON)
STEPS["messages"] = f"""
  select job_id, 'warning' as severity, robots_reason as message from jobs where risk_level = 'low' and robots_decision = 'warning'
  union all select job_id, 'warning', {NOTE} from jobs where {NOTE} is not null
  union all select job_id, 'error', risk_reason from jobs where blocked_by = 'risk_engine'
  union all select job_id, 'error', robots_reason from jobs where blocked_by = 'robots_checker'
  union all select job_id, 'error', coalesce(profile_error, {STATUS_REASON}) from jobs where blocked_by = 'source_profiler'"""
EARLIER = "blocked_by in ('risk_engine', 'robots_checker')"
PROFILED = (
    "'Profiled ' || url || ': status=' || status_code || ', is_html=' || " + bool_repr("is_html") + " || ', is_json=' || "
    + bool_repr("is_json") + " || ', is_xml=' || " + bool_repr("is_xml") + " || ', js_heavy=' || " + bool_repr("js_heavy")
    + " || ', pagination=' || " + bool_repr("has_pagination") + " || ', pagination_signals=' || " + list_repr("pagination_signals")
    + " || ', next_page_candidates=' || next_page_candidates_count || ', data_visible=' || " + bool_repr("data_visible_in_html")
    + " || ', field_hits=' || " + list_repr("visible_field_hits") + " || ', links=' || link_count || '.'"
)
STEPS["decisions"] = f"""
  select job_id, 0 as seq, 'risk_engine' as layer, risk_decision as decision, risk_reason as reason from jobs
  union all select job_id, 1, 'robots_checker', case when risk_level = 'high' then 'skipped' else robots_decision end,
    case when risk_level = 'high' then 'Job already blocked by a previous layer; robots check skipped.' else robots_reason end from jobs
  union all select job_id, 2, 'source_profiler', case when {EARLIER} then 'skipped' when blocked_by is not null then 'blocked' else 'profiled' end,
    case when {EARLIER} then 'Job already blocked by a previous layer; profiling skipped.' when profile_error is not null then profile_error
      when blocked_by is not null then {STATUS_REASON} else {PROFILED} end from jobs
  union all select job_id, 3, 'strategy_selector', strategy, {when_equal('strategy', fixed.STRATEGY_REASON)} from jobs
  union all select job_id, 4, 'routing', route, array_to_string(route_reasons, '; ') from jobs
  union all select job_id, 5, 'extractor', {EXTRACTED}, coalesce({NOTE}, case
      when extractor = 'static_html' then 'Extracted ' || raw_n || ' raw item(s) from ' || url || ' using static HTML extraction (requests + BeautifulSoup).'
      when extractor = 'scrapy' then 'Extracted ' || raw_n || ' raw item(s) from paginated HTML using Scrapy with max_pages=5, max_items=100, same-domain pagination only.'
      when extractor = 'api_xml' then 'Extracted ' || raw_n || ' raw item(s) from ' || url || ' using XML extraction.'
      else 'Extracted ' || raw_n || ' raw item(s) from ' || url || ' using API-like JSON extraction.' end) from jobs where extractor is not null
  union all select job_id, 6, 'cleaner', case when raw_n = 0 then 'skipped' else 'cleaned' end, case when raw_n = 0 then 'No raw items to clean.'
    else 'Cleaned ' || raw_n || ' item(s): normalised whitespace, resolved relative URLs against ''' || url || ''', cleaned price strings.' end from jobs
  union all select job_id, 7, 'validator', 'validated', good_n || ' item(s) valid, ' || bad_n || ' item(s) invalid. Rules: title required, url must be http/https, price must be numeric.' from jobs
  union all select job_id, 8, 'deduplicator', 'deduplicated', 'Removed ' || (good_n - unique_n) || ' duplicate(s) using ''url'' as the key. ' || unique_n || ' unique item(s) remain.' from jobs
  union all select job_id, 9, 'csv_exporter', case when unique_n = 0 then 'skipped' else 'exported' end,
    case when unique_n = 0 then 'No valid items to export.' else 'Wrote ' || unique_n || ' item(s) to CSV: csv' end from jobs where list_contains(outputs, 'csv')
  union all select job_id, 10, 'sqlite_store', case when unique_n = 0 then 'skipped' else 'stored' end,
    case when unique_n = 0 then 'No valid items to store.' else 'Inserted ' || coalesce(s.inserted, 0) || ' new item(s) into SQLite at store. Duplicate URLs were ignored (url is UNIQUE).' end
    from jobs left join job_inserts s using (job_id) where list_contains(outputs, 'sqlite')"""
STEPS["job_inserts"] = """
  select job_id, count(*) as inserted from (
    select u.job_id, u.url from unique_items u join decided d using (job_id) where list_contains(d.outputs, 'sqlite')
    qualify row_number() over (partition by u.url order by u.job_id, u.page_seq, u.pos) = 1)
  group by job_id"""

# --- plain pages in two batches ---
STEPS["page_doms"] = f"""
  select page_id as job_id, url, regexp_replace(html, {rx(fixed.TRIVIA)}, '<!>', 'g') as dom from pages"""
STEPS["page_anchors"] = anchors_of("page_doms", "dom")
STEPS["page_items"] = f"""
  select job_id, pos, {squeeze('title')} as title, {resolve('base', squeeze('href'))} as url, base
  from (select job_id, url as base, row_number() over (partition by job_id order by no) - 1 as pos,
      case when array_to_string(texts, '') = '' then {trim('href')} else array_to_string(texts, '') end as title, {trim('href')} as href
    from page_anchors where {usable(trim('href'))})
  where {squeeze('title')} <> ''"""
STEPS["page_batches"] = """
  select 1 as batch, * from page_items where starts_with(base, 'https:')
  union all select 2 as batch, * from page_items"""
STEPS["page_store"] = """
  select * from page_batches where starts_with(url, 'http://') or starts_with(url, 'https://')
  qualify row_number() over (partition by url order by batch, job_id, pos) = 1"""

_RECURSIVE = {"all_walk_steps", "job_walk_steps"}


def answer(final: str) -> str:
    """``final`` with every step it uses, directly or through others, before it."""
    needed: list[str] = []

    def visit(sql: str, inside: str | None = None) -> None:
        words = set(re.findall(r"[a-z_]+", sql))
        for name, step in STEPS.items():
            if name in words and name != inside and name not in needed:
                uses = re.search(rf"(?:from|join)\s+\(?\s*{name}\b", sql)
                if uses:
                    visit(step, name)
                    if name not in needed:
                        needed.append(name)

    visit(final)
    parts = ",\n".join(f"{n} as ({STEPS[n]})" for n in needed)
    if not parts:
        return final
    recursive = "recursive " if _RECURSIVE & set(needed) else ""
    return f"with {recursive}{parts}\n{final}"


# --- answers: one per query -----------------------------------------------------------
def joined(x: str) -> str:
    return f"array_to_string({x}, '|')"


HTML_FLAG = "contains(lower(content_type), 'text/html')"
RULES = rule_sql()
ONE_PAGE = clean_sql(f"""(
  select job_id, l.url as base_url, pos, l.title, l.href as url, null as price, 'static_html' as source, {NO_KINDS}
  from local join link_rows l using (job_id) where extractor = 'static_html'
  union all by name
  select job_id, t.url as base_url, 0 as pos, t.title, t.url, null as price, 'static_html_fallback' as source, {NO_KINDS}
  from local join title_rows t using (job_id) where extractor = 'static_html'
  union all by name
  select job_id, i.base_url, pos, i.title, i.url, i.price, 'api_like_json' as source, title_kind, price_kind, stock, note, stock_kind
  from local join json_items i using (job_id) where extractor in ('api_json', 'api_like_json')
  union all by name
  select job_id, i.base_url, pos, i.title, i.url, i.price, 'api_xml' as source, {NO_KINDS}
  from local join xml_items i using (job_id) where extractor = 'api_xml')""")
STEPS["one_page"] = ONE_PAGE
PRICES = f"({derived.for_views(derived.PRICE_TEXTS)}) p"
FETCH = {
    kind: (
        f"case when error is not null then '{kind}_fetch_failed' when coalesce(status in {BLOCKED}, false) then '{kind}_blocked_status' "
        f"when not valid_ then '{kind}_parse_failed' else '{kind}_extracted' end"
    )
    for kind in ("json", "xml")
}


def failures(kind: str, source: str) -> str:
    return f"""select job_id, decision, case decision
        when '{kind}_fetch_failed' then '{kind}_extractor: network error fetching ' || url || ': ' || error
        when '{kind}_blocked_status' then '{kind}_extractor: HTTP ' || status || ' indicates the endpoint is blocked, private, or rate limited. No extraction attempted.'
        when '{kind}_parse_failed' then '{kind}_extractor: invalid {kind.upper()} from ' || url end as warning
      from (select *, {FETCH[kind]} as decision from {source})"""


_FINAL = {
    "capture_scan": "select page_id as job_id, url, cast(200 as bigint) as status, 'text/html' as content_type, strlen(html) as body_bytes from pages",
    "job_request_scan": f"select job_id, url, {joined('fields')} as fields, len(fields) as n_fields, {joined('outputs')} as outputs from requests",
    "export_csv": "select u.job_id, u.title, u.url, u.source, u.price, case when list_contains(d.fields, 'stock') then u.stock end as stock, "
                  "u.note from unique_items u join decided d using (job_id) where list_contains(d.outputs, 'csv')",
    "store_insert_or_ignore": "select title, url, 'static_html' as source from page_store",
    "store_insert_count": "select batch as batch_id, job_id, count(*) as inserted from page_store group by batch, job_id",
    "run_report_json": """select url, risk_level, allowed, authorization_status, strategy as selected_strategy, route, confidence, link_count, profile_error,
        raw_n as raw_items_count, raw_n as clean_items_count, unique_n as valid_items_count, bad_n as invalid_items_count, good_n - unique_n as duplicates_removed,
        coalesce(m.warnings, 0) as warnings, coalesce(m.errors, 0) as errors, l.decisions,
        case when list_contains(outputs, 'csv') and unique_n > 0 then 'csv' end as csv_path,
        case when list_contains(outputs, 'sqlite') and unique_n > 0 then 'store' end as store_path
      from jobs left join (select job_id, count(*) filter (where severity = 'warning') as warnings, count(*) filter (where severity = 'error') as errors from messages group by job_id) m using (job_id)
      join (select job_id, string_agg(concat_ws(': ', layer, decision, reason), '|' order by seq) as decisions from decisions group by job_id) l using (job_id)""",
    "decision_log": "select job_id, seq, layer, decision, reason from decisions",
    "quarantine_sink": "select job_id, page_seq, pos, title, url, price, validation_error as _validation_error from checked where validation_error is not null",
    "warning_error_log": "select job_id, severity, message from messages",
    "field_normalise": f"select job_id, {joined('requested')} as requested from gate",
    "sensitive_field_gate": f"select job_id, risk_level, risk_decision, {joined('blocked_fields')} as blocked_fields, risk_reason from gate",
    "robots_rule_table": f"select origin, group_no, {joined('agents')} as agents, rule_no, allow, path from robots_rules",
    "robots_url_decision": "select job_id, url, robots_decision, robots_reason from robots",
    "robots_fetch_outcome": "select origin, status, outcome from outcomes",
    "authorization_gate": "select job_id, blocked_by, allowed, authorization_status from authorized",
    "status_block": f"select job_id, status, coalesce(status in {BLOCKED}, false) as blocked, {when_equal('status', fixed.BLOCKED_STATUS_REASON)} as reason from captures",
    "content_type_flags": """select job_id, contains(lower(content_type), 'application/json') or contains(lower(content_type), 'text/json') as is_json,
        contains(lower(content_type), 'application/xml') or contains(lower(content_type), 'text/xml') as is_xml, contains(lower(content_type), 'text/html') as is_html from captures""",
    "html_size": "select job_id, strlen(body) as html_size from captures",
    "anchor_explode": "select job_id, no, href, rel, cls, id, array_to_string(texts, ' ') as text from anchors",
    "link_count": "select d.job_id, count(a.no) as link_count from doms d left join anchors a using (job_id) group by d.job_id",
    "title_candidates_count": f"select job_id, {count('dom', '(?i)<h[1-3]' + chr(92) + 'b')} as title_candidates_count from doms",
    "visible_text": f"select job_id, {plain('dom')} as profiler_text, {plain(f'regexp_replace(dom, {rx(fixed.NOSCRIPT)}, {text(chr(60) + chr(33) + chr(62))}, {text(chr(103))})')} as router_text from doms",
    "js_heavy": f"""select m.job_id, m.scripts, {count('d.html', '(?i)<script' + chr(92) + 'b')} as script_tags,
        m.scripts > 5 and length(m.txt) < 200 as profiler_js_heavy,
        {count('d.html', '(?i)<script' + chr(92) + 'b')} >= 6 and length({plain(f"regexp_replace(d.dom, {rx(fixed.NOSCRIPT)}, '<!>', 'g')")}) < 120 as router_js_heavy
      from measures m join doms d using (job_id)""",
    "pagination_signals": f"select job_id, {joined('signals')} as signals from signals",
    "next_page_candidates_count": "select job_id, next_n as next_page_candidates from measures",
    "price_candidates_count": f"select l_orderkey, l_linenumber, {count('price', fixed.PROFILE_PRICE)} as prices from {PRICES}",
    "field_evidence_title": "select job_id, title_seen as evidence from measures",
    "field_evidence_url": "select job_id, links > 0 as evidence from measures",
    "field_evidence_price": "select job_id, prices > 0 as evidence from measures",
    "field_evidence_availability": f"select o_orderkey, regexp_matches(text, {rx(fixed.AVAILABILITY)}) as evidence from ({derived.for_views(derived.STOCK_TEXTS)}) s",
    "field_evidence_generic": "select doc_id, array_to_string(list_filter(['the', 'que', 'und', 'para', 'license'], lambda f: contains(lower(text), f)), '|') as hits from documents",
    "visible_field_hits": f"select job_id, {joined('visible_field_hits')} as hits, data_visible_in_html from profile",
    "source_profile": f"""select job_id, status_code, html_size, next_page_candidates_count, link_count, title_candidates_count, price_candidates_count, content_type, is_json, is_xml, is_html,
        js_heavy, has_pagination, has_pagination as pagination_detected, data_visible_in_html, {joined('pagination_signals')} as pagination_signals,
        {joined('visible_field_hits')} as visible_field_hits, profile_error from profile""",
    "strategy_select": f"select job_id, strategy, {when_equal('strategy', fixed.STRATEGY_REASON)} as strategy_reason from local_route",
    "looks_like_json": f"select job_id, coalesce({JSON_LIKE}, false) as json_like from captures",
    "looks_like_xml": f"select job_id, coalesce({XML_LIKE}, false) as xml_like from captures",
    "url_suffix_test": f"select job_id, {JSON_URL} as json_url, {XML_URL} as xml_url from captures",
    "blocked_pattern": f"select job_id, {PHRASE} as pattern from captures",
    "target_structure_count": "select job_id, target_like_structure_count from html_signals",
    "html_signals": f"""select job_id, html_provided, html_length, script_count, visible_text_length, target_like_structure_count, html_next_page_candidates_count,
        blocked_pattern, json_like_content, xml_like_content, html_has_pagination, {joined('html_pagination_signals')} as html_pagination_signals from html_signals""",
    "metadata_signals": f"""select job_id, status_code, coalesce(next_page_candidates_count, 0) as meta_next_page_candidates, coalesce(content_type, '') as meta_content_type,
        coalesce(is_json, false) as meta_is_json, coalesce(is_xml, false) as meta_is_xml, coalesce(is_html, false) as meta_is_html, coalesce(js_heavy, false) as meta_js_heavy,
        coalesce(data_visible_in_html, false) as meta_data_visible, coalesce(has_pagination, false) as meta_has_pagination,
        coalesce({joined('pagination_signals')}, '') as meta_pagination_signals, coalesce({joined('visible_field_hits')}, '') as meta_field_hits, profile_error from profile""",
    "scrape_route": "select job_id, route, confidence, recommended_next_step from routed",
    "scrape_route_metadata": "select job_id, route, confidence, recommended_next_step from local_route",
    "route_reasons": f"select job_id, {joined('route_reasons')} as reasons from routed",
    "route_explanation": f"select job_id, {EXPLANATION} as explanation from routed",
    "effective_extractor": "select job_id, allowed, strategy, route, extractor from decided",
    "dispatch_union": "select job_id, page_seq, pos, title, url, price, source from raw_items",
    "manual_review_queue": " union all ".join(
        f"select job_id, url, strategy, '{name}_skipped' as decision, 'Strategy ''{name}'' was selected but its extractor is not implemented in V1. "
        f"{note} No items extracted.' as note from decided where extractor = '{name}'"
        for name, note in fixed.SKIPPED_NOTE.items()
    ),
    "strategy_route_disagreement": "select strategy, " + ", ".join(
        f"count(*) filter (where route = '{r}') as {r}"
        for r in ["static_html", "scrapy_crawl", "browser_render", "api_like_json", "api_like_xml", "fallback_manual_review"]
    ) + " from decided group by strategy",
    "json_records": "select job_id, pos, json_extract_string(rec, '$.title') as title, json_extract_string(rec, '$.price') as price, "
                    "json_extract_string(rec, '$.stock') as stock, json_extract_string(rec, '$.href') as href from json_rows",
    "json_project_fields": "select job_id, pos, field as key, value from json_values union all select job_id, pos, 'source', 'api_like_json' from json_rows",
    "json_url_alias": "select job_id, pos, value as url from json_values where field = 'url'",
    "json_failures": failures("json", "json_lists"),
    "xml_records": "select job_id, pos, tag from xml_rows",
    "xml_repeated_children": "select job_id, pos, tag from xml_rows where tag = 'record'",
    "xml_node_to_map": "select job_id, pos, key, value from xml_values",
    "xml_project_fields": """select r.job_id, r.pos, max(v.value) filter (where v.key = 'title') as title, max(v.value) filter (where v.key = 'url') as url,
        max(v.value) filter (where v.key = 'price') as price, 'api_xml' as source, max(v.value) filter (where v.key = 'note') as note, count(v.key) + 1 as n_keys
      from xml_rows r left join xml_values v on v.job_id = r.job_id and v.pos = r.pos and list_contains(r.fields, v.key) group by r.job_id, r.pos""",
    "xml_failures": failures("xml", "xml_docs"),
    "html_links": "select job_id, pos, title, href as url, 'static_html' as source from link_rows",
    "html_title_fallback": "select job_id, title, url, 'static_html_fallback' as source from title_rows",
    "card_segments": "select job_id, pos, card from cards",
    "card_title": "select job_id, pos, title from card_values",
    "card_url": "select job_id, pos, url from card_values",
    "card_price": "select job_id, pos, price from card_values",
    "in_page_dedup": "select job_id, pos, title, url, price from records",
    "card_link_fallback": "select job_id, pos, title, url from link_first",
    "shape_item": f"""select job_id, pos, title, url, price, concat_ws('|', case when title is not null then 'title' end, case when url is not null then 'url' end,
        case when price is not null then 'price' end, 'source') as keys
      from (select r.job_id, r.pos, {shaped('q.fields')} from records r join requests q using (job_id))""",
    "next_page_edges": "select job_id, row_number() over (partition by job_id order by no) - 1 as ord, next_url from edges",
    "bounded_crawl": "select seed, page_seq, url from all_walk_pages",
    "item_limit": f"""select job_id, page_seq, pos, title, url, price from (select d.job_id, p.page_seq, r.pos, {shaped('d.fields')},
        row_number() over (partition by d.job_id order by p.page_seq, r.pos) as nth
      from doms d join all_walk_pages p on p.seed = d.url join record_of_url r on r.at_url = p.url) where nth <= 8""",
    "crawl_status_skip": """select w.url, len(e.next_urls) as links, coalesce(r.n, 0) as items from (select url, min(job_id) as job_id from fetched_pages group by url) w
      join edge_lists e using (url) left join (select job_id, count(*) as n from records group by job_id) r using (job_id)""",
    "squeeze_whitespace": f"select doc_id, {squeeze('text')} as text from documents",
    "url_resolve": f"select job_id, no, href, {resolve('url', squeeze('href'))} as url from anchors",
    "price_clean": f"select l_orderkey, l_linenumber, {cleaned_price('price')} as price from {PRICES}",
    "clean_items": "select job_id, pos, title, url, price, source from one_page",
    "rule_title": f"select job_id, pos, source, {RULES[0]} as error from one_page",
    "rule_url": f"select job_id, pos, source, {RULES[1]} as error from one_page",
    "rule_price": f"select l_orderkey, l_linenumber, {RULES[2]} as error from {PRICES}",
    "validate_split": "select job_id, page_seq, pos, title, url, price, validation_error from checked",
    "validation_summary": f"""select job_id, count(*) filter (where validation_error is null) as valid_count, count(*) filter (where validation_error is not null) as invalid_count,
        count(*) filter (where starts_with(validation_error, 'Missing or empty')) as title_errors,
        count(*) filter (where starts_with(validation_error, 'Missing ''url') or starts_with(validation_error, 'Invalid URL')) as url_errors,
        count(*) filter (where contains(validation_error, 'is not numeric')) as price_errors from checked group by job_id""",
    "dedup_first_by_url": "select job_id, page_seq, pos, title, url, price, copies from unique_items",
    "duplicates_removed": "select job_id, good_n - unique_n as duplicates_removed from jobs",
    "job_metrics": "select job_id, raw_n as raw_items_count, raw_n as clean_items_count, unique_n as valid_items_count, bad_n as invalid_items_count, good_n - unique_n as duplicates_removed from jobs",
    "job_status": "select job_id, not allowed or job_id in (select job_id from messages where severity = 'error') as failed from jobs",
    "run_summary": """select job_id, url, risk_level, allowed, authorization_status, strategy, route, confidence, raw_n as raw_items_count, unique_n as valid_items_count,
        bad_n as invalid_items_count, good_n - unique_n as duplicates_removed, not allowed as failed from jobs""",
    "audit_trail_query": "select job_id, seq, layer, decision, substring(reason, 1, 100) as reason from decisions order by job_id, seq",
    "items_per_page": """select job_id, count(*) as raw_items_count, count(*) as clean_items_count,
        count(distinct case when regexp_matches(url, '^https?://') then url end) as valid_items_count,
        count(*) filter (where not regexp_matches(url, '^https?://')) as invalid_items_count,
        count(*) filter (where regexp_matches(url, '^https?://')) - count(distinct case when regexp_matches(url, '^https?://') then url end) as duplicates_removed
      from page_items group by job_id""",
    "stream_ingest": f"select job_id, pos, title, url, price, source, coalesce({', '.join(RULES)}) as validation_error from one_page where job_id in (select job_id from robots where robots_decision <> 'blocked')",
    "stream_dedup_url": f"select distinct url from one_page where coalesce({', '.join(RULES)}) is null and job_id in (select job_id from robots where robots_decision <> 'blocked')",
    "stream_crawl_queue": f"select job_id, page_seq, pos, title, url, price from crawled where nth <= {fixed.MAX_ITEMS}",
    "job_capture_asof": f"""with asks as (select *, row_number() over () as ask from ({derived.for_views(derived.ASKS)}) j),
        met as (select a.ask, f.capture_id, f.fetched_at, max(f.fetched_at) over (partition by a.ask) as last_at
          from asks a join ({derived.for_views(derived.FETCHES)}) f on a.url = f.url and f.fetched_at <= coalesce(a.asked_at, timestamp '9999-01-01'))
      select any_value(a.job_id) as job_id, max(m.capture_id) filter (where m.fetched_at = m.last_at) as capture_id
      from asks a left join met m using (ask) group by a.ask""",    "stream_store": f"select distinct url from one_page where coalesce({', '.join(RULES)}) is null and job_id in (select job_id from robots where robots_decision <> 'blocked')",
}


def answers() -> dict[str, str]:
    return {name: answer(sql) for name, sql in _FINAL.items()}
