"""Values that decide the results and so are fixed, kept together and in plain text.

Every pattern is in the Java regex form Spark uses. ``(?d)`` makes ``.`` stop at line feeds only.
``[\\p{L}\\p{N}_]`` is the Unicode word class.
"""

# --- fixed values: page layout -------------------------------------------------------------
# Patterns that may find an opening without its end take the rest of the line in one go, so that a line of nothing but
# openings is read once and not once for each of them.
TITLE = r"(?d)<title>.*</title>|<title>[^\n]*+"
CRUMB_LINE = r'(?d)<span class="ext-geocrumbs-breadcrumbs">.*'
CRUMB_TITLE = r'(?d)title="(.*?)"'
CRUMB_LEAF = r"<bdi>(?:[^<\n]|<(?!/bdi>))*+</bdi>|<bdi>[^\n]*+"
TAG = r"<[^>\n]*+>|(<[^>\n]*+)"
HEADING = r'<span class="mw-headline"[^>]*>([^<]*)</span>'
EDIT_MARK = "[edit]"

# --- fixed values: section names, in the order they are taken out of a page -----------------
SECTION_NAMES = (
    "Get in",
    "Get around",
    "See",
    "Do",
    "Eat",
    "Sleep",
    "Drink",
    "Buy",
    "Understand",
    "Go next",
    "Stay safe",
    "By plane",
    "Connect",
    "History",
    "By bus",
    "By car",
    "Climate",
    "Respect",
    "By train",
    "By boat",
    "Talk",
    "Stay healthy",
    "Cities",
    "Money",
    "Other destinations",
    "Work",
    "Regions",
    "Info",
    "By taxi",
)

# --- fixed values: entity names --------------------------------------------------------------
NAME_TAIL = r"(?d)( -.*)|( \(.*)|( \|.*)|( –.*)|( —.*)|(\n)"
QUOTED_NAME = r"""(?d)'.*'|".*\""""

# --- fixed values: infobox lines ---------------------------------------------------------------
INFOBOX_LINE = r"(?d)\n\|(.*?)=(.*)"
INFOBOX_MARKS = r"[\[\]\{\}\=]"
SPACES = r" +"
STRIP = r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"

# --- fixed values: links -----------------------------------------------------------------------
# An absolute link is https, a dotted host, then at least one more character; it never ends in . , or :
ABSOLUTE_LINK = (
    r"https://[\p{L}\p{N}_-]+\.[\p{L}\p{N}_-]"
    r"[\p{L}\p{N}_.,@?^=%&:/~+#-]*[\p{L}\p{N}_@?^=%&/~+#-]"
)
# The same links with scheme, host and path as groups, for engines that do not recurse on repeats.
ABSOLUTE_LINK_PARTS = (
    r"(https):\/\/([\p{L}\p{N}_-]+(?:(?:\.[\p{L}\p{N}_-]+)+))"
    r"([\p{L}\p{N}_.,@?^=%&:\/~+#-]*[\p{L}\p{N}_@?^=%&\/~+#-])"
)
RELATIVE_LINK = r'(?d)href="(/.*?)"'
ORIGIN_HTTPS = r"(?d)(https://.*?)/"
ORIGIN_ANY = r"(?d)(https?://.*?)/"
EXCLUDED_TYPES = r"\.png|\.jpg|\.jpeg|\.gif|\.svg|\.pdf|\.docx"
QUOTE_KEEP = "<>=/:!"  # left as they are by percent-quoting, beside letters, digits and _.-~

# --- fixed values: search ----------------------------------------------------------------------
QUERY_SPECIAL = r'[\+\-&\|!\(\){}\[\]\^\"~\*\?:\\\/]+'
# The closing possessive *+ keeps Java from recursing once per part of a long 1,2,3,... run.
TOKEN = (
    r"[\p{L}\p{M}\p{N}_]+"
    r"(?:['’.:·]\p{L}[\p{L}\p{M}\p{N}_]*|[.,;']\p{N}[\p{L}\p{M}\p{N}_]*)*+"
)
BM25_K1 = 1.2
BM25_B = 0.75
FUZZY_EDITS = 2
RESULT_TOTAL = r'(?d)data-mw-num-results-total="(.*?)"'
COUNT_LINK_PREFIX = "https://en."  # links the evaluation counts
