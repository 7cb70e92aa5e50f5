"""Fixed values that results depend on: limits, names, patterns and formats.

Everything here is data. Patterns stay inside the syntax that Java regular
expressions and RE2 share, so the DuckDB checks can use the very same text.
"""

# --- Fixed values: limits -------------------------------------------------
MAX_SEARCH_LIMIT = 10_000
MAX_CHILD_PAGES = 500
MAX_CONVERSION_CHARS = 400_000
SEARCH_BODY_CHARS = 200
ENTITY_BODY_CHARS = 6_000
MAX_PREVIEW_CHARS = 50_000
MAX_BODY_CHARS = 50_000
DEFAULT_VALUES_PER_FIELD = 20
MAX_VALUES_PER_FIELD = 200
MAX_LISTED_KEYS = 20
MAX_DISPLAY_JSON_CHARS = 800
MAX_DISPLAY_ARRAY_DEPTH = 4
DEFAULT_TOP_HITS = 2
MAX_TOP_HITS = 50
DEFAULT_HIGHLIGHT_COUNT = 3
MAX_HIGHLIGHT_COUNT = 100
DEFAULT_HIGHLIGHT_LENGTH = 100
MAX_HIGHLIGHT_LENGTH = 50_000
LOG_FILE_BODY_CHARS = 500_000
LOG_CONSOLE_BODY_CHARS = 12_000
BOUNDARY_KEEP = 0.45
SOURCE_CUT_KEEP = 0.85
BM25_K1 = 1.2
BM25_B = 0.75

# --- Fixed values: names --------------------------------------------------
UNKNOWN_SCHEMA = "Unknown"
EMAIL_SCHEMA = "email"
PAGE_SCHEMAS = ("page", "pages")
PARENT_SCHEMA = "pages"
CHILD_SCHEMA = "Page"
HEAVY_FIELDS = ("bodyHtml", "bodyText", "translatedText", "indexText", "rawText")
PAGE_TEXT_FIELDS = ("bodyText", "indexText", "rawText")
PROCESSING_FIELDS = ("processingAgent", "processingStatus")
REFERENCE_FIELDS = ("parent", "ancestors", "recipients")
API_LINK_KEYS = ("self", "expand", "tags")
UI_LINK_KEY = "ui"
NO_KEYS_NOTE = "(no non-empty properties)"

# --- Fixed values: characters and joiners ---------------------------------
# White space as ECMAScript's String.prototype.trim defines it.
WHITESPACE = "\t\n\x0b\f\r " + "".join(
    chr(point)
    for point in (0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)
)
WHITESPACE_CLASS = (
    r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
)
ELLIPSIS = "…"
PREVIEW_SUFFIX = "..."
PARAGRAPH = "\n\n"
HIGHLIGHT_JOINER = "\n...\n"

# --- Fixed values: URL shapes ---------------------------------------------
SEARCH_PATH_PATTERN = r"/api/2/search\z"
ENTITY_PATH_PATTERN = r"/api/2/entities/([^/]+)/?\z"
ENTITY_RELATIVE_PATTERN = r"/api/2/entities/([^/?#]+)"
UI_PATH_PATTERN = r"/entities/([^/]+)/?\z"
UI_RELATIVE_PATTERN = r"/entities/([^/?#]+)"
ABSOLUTE_URL_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?([^?#]*)"

# --- Fixed values: credentials in logged headers --------------------------
API_KEY_PATTERN = r"(?i)^apikey" + WHITESPACE_CLASS + "+"
API_KEY_MASK = "ApiKey ***"
OTHER_MASK = "***"

# --- Fixed values: mail HTML noise, removed in this order -----------------
MAIL_NOISE_PATTERNS = (
    r"(?s)<!--.*?-->",
    r"(?is)<!--\s*\[if.*?<!\s*\[endif\]\s*-->",
    r"(?is)<style\b[^>]*>.*?</style>",
    r"(?is)<script\b[^>]*>.*?</script>",
    r"(?is)<head\b[^>]*>.*?</head>",
    r"(?i)<\?xml\b[^?]*\?>",
)
STYLE_LINE_PATTERN = (
    r"(?i)^" + WHITESPACE_CLASS + r"*(@font-face|@page|@media|font-family:|panose-|mso-|\.Mso|\.WordSection"
    r"|div\.WordSection|size:\s*[0-9])"
)
LEFTOVER_TAG_PATTERN = r"</?[a-zA-Z][a-zA-Z0-9:._-]*(?:" + WHITESPACE_CLASS + r"[^<>]*)?>"
COMMENT_PATTERN = r"(?s)<!--.*?-->"
HIGHLIGHT_TAG_PATTERN = r"<[^>]+>"
