"""Fixed values.

Word lists, thresholds, patterns and message texts that results depend on.
Patterns are written for Java; every construct used also exists in RE2, but for
the flag ``u`` (Unicode case folding, which RE2 always does).
"""

# --- characters -------------------------------------------------------------
# White space as Unicode text sees it (Java's \s is ASCII only).
WS = r"[\t-\r\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WS_CHARS = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
NOT_WORD = r"[^\p{L}\p{N}_]"

# --- requests and policy ----------------------------------------------------
DEFAULT_OUTPUTS = "csv"
SENSITIVE_FIELDS = [
    "password", "passwd", "pwd",
    "token", "access_token", "refresh_token", "auth_token", "api_key",
    "cookie", "session", "session_id",
    "credit_card", "card_number", "cvv", "ccv",
    "national_id", "ssn", "social_security",
    "private_email", "phone_number", "phone", "mobile",
]
# Sent to robots.txt matching; pass another one to the operators if needed.
USER_AGENT = "PageSieve/1.0"

BLOCKED_STATUS = [401, 403, 429]
BLOCKED_STATUS_REASON = {
    401: "401 Unauthorized - page requires login. Login-required pages are not collected.",
    403: "403 Forbidden - server explicitly denied access.",
    429: "429 Too Many Requests - rate limited. Stopping to be a good citizen.",
}

# --- profile ----------------------------------------------------------------
TITLE_NAMES = ["title", "name", "heading"]
URL_NAMES = ["url", "href", "link"]
# The profiler's price words. Its euro "sign" is the three characters U+00E2
# U+0082 U+00AC, so a real euro sign is not found here (the code EUR is).
PROFILE_PRICE = (
    r"(?iu)(?:\$|[\xE2\xC2]\x{82}\xAC|\xA3|\xA5|USD|EUR|GBP|JOD|SAR|AED|EGP|CAD|AUD)"
    + WS + r"*[\p{Nd},]+\.?\p{Nd}*"
    + r"|[\p{Nd},]+\.?\p{Nd}*" + WS + r"*(?:USD|EUR|GBP|JOD|SAR|AED|EGP|CAD|AUD)"
)
AVAILABILITY = (
    r"(?iu)(?:^|" + NOT_WORD + r")"
    r"(?:available|in(?:" + WS + r"|-)stock|out(?:" + WS + r"|-)of(?:" + WS + r"|-)stock"
    r"|sold(?:" + WS + r"|-)out|ships|unavailable|pre(?:" + WS + r"|-)order|back(?:" + WS + r"|-)order)"
    r"(?:$|" + NOT_WORD + r")"
)
NEXT_TEXTS = ["next", ">", "»", "التالي", "الصفحة التالية"]
PAGING_HREF = r"(?iu)[?&]page=|/page/\p{Nd}+(?:$|" + NOT_WORD + r")|[?&]offset=|[?&]cursor="
PAGING_CLASS = r"(?iu)pagination|pager|next-page"
PROFILE_SCRIPTS_OVER = 5
PROFILE_TEXT_UNDER = 200

SIGNAL_REL = "a[rel=next]"
SIGNAL_TEXT = "next-like anchor text: "
SIGNAL_HREF = "pagination href pattern"
SIGNAL_ANCHOR = "pagination class/id on anchor"
SIGNAL_ELEMENT = "pagination class/id on element"

# --- routing ----------------------------------------------------------------
ROUTE_SCRIPTS_FROM = 6
ROUTE_TEXT_UNDER = 120
ROUTE_SHORT_UNDER = 80
BLOCKED_PHRASES = [
    "access denied", "captcha", "cf-challenge", "cloudflare ray id", "forbidden",
    "please enable cookies", "verify you are human", "unusual traffic", "too many requests",
]
XML_STARTS = ["<?xml", "<rss", "<feed", "<items", "<products", "<entries"]
XML_RECORD_TAGS = ["item", "product", "entry"]
STRATEGY_REASON = {
    "blocked": "Job was blocked by an earlier layer (risk engine or robots checker). "
               "No extraction will take place.",
    "api_json": "Response Content-Type is JSON. "
                "API-like JSON extraction is available and should be used by the extractor registry.",
    "api_xml": "Response Content-Type is XML. "
               "XML extraction is available and should be used by the extractor registry.",
    "scrapy": "HTML data is visible and pagination was detected, so Scrapy crawling is recommended.",
    "static_html": "HTML page has visible data and no JavaScript-rendering required. "
                   "Using static HTML extractor (requests + BeautifulSoup).",
    "selenium": "Page appears to be JavaScript-rendered (many scripts, little visible text). "
                "Selenium extractor is planned for V3; skipping.",
    "manual_review": "No automatic strategy matched the source profile. Manual inspection required.",
}
REASON_STATUS = ("HTTP status ", " indicates access is blocked or rate limited")
REASON_PROFILE_ERROR = "Source profiler reported an error"
REASON_PHRASE = "Detected blocked/captcha/access denied pattern: "
REASON_JSON = "Detected JSON-like content"
REASON_JSON_URL = "URL path ends with .json"
REASON_XML = "Detected XML-like content"
REASON_XML_URL = "URL path ends with .xml/.rss/.atom"
REASON_XML_PROFILE = "Source profiler detected XML content"
REASON_NO_HTML = "HTML content was not provided to the router"
REASON_JS = "Profiler marked the page as JavaScript-heavy"
REASON_VISIBLE = "Profiler found visible target-like data in HTML"
REASON_PAGED = "Profiler detected pagination, so this is a crawl case"
REASON_SHORT = "HTML is missing or very short"
REASON_SCRIPTS = "HTML contains many script tags"
REASON_LOW_TEXT = "Visible text length is low"
REASON_HTML_VISIBLE = "Static HTML contains visible target-like data"
REASON_HTML_PAGED = "Pagination was detected, so this is a crawl case"
REASON_STATIC = "Static HTML appears sufficient"
REASON_STRUCTURE = "HTML contains target-like structure"
REASON_NONE = "No reliable automatic route matched the available signals"
NEXT_STEP = {
    "stop": "Stop automatic extraction and inspect access, permissions, or anti-bot requirements manually.",
    "json": "Use a JSON/API parser when that extractor is available.",
    "xml": "Use the XML extractor through the api_xml strategy when available.",
    "render": "Recommend browser rendering, but keep V1 extraction unchanged until a browser extractor is installed.",
    "crawl": "Use bounded Scrapy crawling for paginated static HTML. Review crawl limits, "
             "extracted records, and the audit report before scaling beyond the local demo.",
    "static": "Use the existing static HTML extractor.",
    "fetch": "Fetch and inspect the page content before choosing an extractor.",
    "short": "Try browser rendering or inspect the response manually if the page remains empty.",
    "scripts": "Recommend browser rendering; do not force it until Playwright/Selenium support exists.",
    "unclear": "Inspect the page manually and add a source-specific extractor only if appropriate.",
}
SKIPPED_NOTE = {
    "selenium": "JavaScript-rendering via Selenium planned for V3.",
    "manual_review": "No automatic extractor available; manual review required.",
}

# --- extraction -------------------------------------------------------------
JSON_CONTAINERS = ["items", "products", "data"]
JSON_URL_ALIASES = ["url", "href", "link", "path"]
SOURCE_JSON = "api_like_json"
SOURCE_XML = "api_xml"
SOURCE_LINKS = "static_html"
SOURCE_TITLE = "static_html_fallback"
SOURCE_CARDS = "scrapy"
CARD_CLASS = r"(?iu)product|item|card|listing"
CARD_PRICE = (
    r"(?iu)(?:\$|\x{20AC}|\xA3|USD|JOD|SAR)" + WS + r"*[\p{Nd},]+\.?\p{Nd}*"
    + r"|[\p{Nd},]+\.?\p{Nd}*" + WS + r"*(?:USD|JOD|SAR)"
)
MAX_PAGES = 5
MAX_ITEMS = 100

# --- cleaning and validation ------------------------------------------------
PRICE_STRIP = r"[£$€¥,\t-\r\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NUMBER = (
    r"(?i)^" + WS + r"*[+-]?(?:nan|inf|infinity|"
    r"(?:\p{Nd}+(?:_\p{Nd}+)*(?:\.(?:\p{Nd}+(?:_\p{Nd}+)*)?)?|\.\p{Nd}+(?:_\p{Nd}+)*)"
    r"(?:e[+-]?\p{Nd}+(?:_\p{Nd}+)*)?)" + WS + r"*$"
)
ERROR_TITLE = "Missing or empty 'title' field."
ERROR_URL = "Missing 'url' field."
ERROR_SCHEME = "Invalid URL scheme (must be http or https): '"
ERROR_PRICE = "'price' field is not numeric: '"
CSV_FIRST = ["title", "url", "source"]
TRAIL_WIDTH = 100

# --- markup -----------------------------------------------------------------
TRIVIA = (
    r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
)
NOSCRIPT = r"(?is)<noscript\b.*?(?:</noscript\s*>|\z)"
# A tag's inside up to its '>': quoted values are stepped over, a quote nobody closes is a character.
INSIDE = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+"""
TAG = r"</?[a-zA-Z!?]" + INSIDE + ">"
# Elements without content, so without an end.
VOID = [
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
]

# Numeric references to the C1 range mean the Windows-1252 character there, if it has one.
C1 = "".join(map(chr, range(0x80, 0xA0)))
C1_SHOWN = "".join(bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0))
