"""Names, orders, patterns and sentences that results depend on.

Everything here is data. The rules that use it live in `functions` and `operators`.
"""

# Quality classes, worst to best, and the weight of each class in the weighted score.
CLASSES = ("Stub", "Start", "C", "B", "GA", "FA")
CLASS_WEIGHTS = {"Stub": 1, "Start": 2, "C": 3, "B": 4, "GA": 5, "FA": 6}

# Revisions are scored in requests of this many rows.
SCORE_CHUNK = 50

# Added to the paragraph count before dividing by it.
EPS = 1e-8

# Runs of characters that count as plain text inside links, headings and references.
PLAIN = "[a-zA-Z0-9.,!? ]"

# Kinds of pages that are not articles, in the order in which they are tested.
TAGS = ("redirect", "disambig", "template", "category", "file", "wikipedia_related", "portal", "help")
REDIRECT_PREFIX = "#redirect"
DISAMBIG_PATTERN = r"\{\{(disambig|[a-z0-9 |]*disambiguation[|a-z0-9 ]*)\}\}"
TITLE_PREFIXES = {
    "template": "template:",
    "category": "category:",
    "file": "file:",
    "wikipedia_related": "wikipedia:",
    "portal": "portal:",
    "help": "help:",
}

HEADING_LEVELS = (2, 3, 4, 5, 6)
CITATION_SOURCES = ("book", "journal", "web", "news")

# Feature table, in column order.
FEATURES = (
    "n_words", "n_internal_links", "n_external_links",
    "level2", "level3", "level4", "level5", "level6",
    "book_citations", "journal_citations", "web_citations", "news_citations",
    "average_external_links", "average_internal_links",
    "n_paragraphs", "n_unreferenced", "n_images",
)

# Earlier feature table, in column order.
FEATURES_V1 = (
    "n_words", "level2", "level3", "level4", "level5", "level6",
    "book_citations", "journal_citations",
    "n_internal_links", "n_external_links",
    "n_paragraphs", "n_unreferenced", "n_categories", "n_images",
)

# Columns of a raw page table that say little about a page.
PROFILE_COLUMNS = ("format", "model", "ns", "contributor.username", "contributor.ip")

# Characters stripped from both ends of element text.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Sentences of the article report.
CLASS_SENTENCES = {
    "Stub": "- this article provides very little meaningful content",
    "Start": "- this article provised some meaningful content, but most readers will need more",
    "C": "- this article has a middle level of content and references",
    "B": "- this article has a good amount of content and references",
    "GA": "- this article very useful for readers: a fairly complete treatment of the subject",
    "FA": "- this is featured article: professional, outstanding and thorough",
}
CLUSTER_SENTENCES = {
    0: "- the page is pretty well cited and argumented",
    1: "- the page is medium cited and argumented",
    2: "- the page is poorly cited and argumented",
}
CITATION_NAMES = {
    "book": "books",
    "journal": "scientific papers (journals, publications, etc)",
    "web": "internet resources (news, archive, etc)",
    "news": "media materials (prints)",
}
TAG_SENTENCES = {
    "redirect": "Not assessed: this title leads to another page.",
    "disambig": "Not assessed: this title has several meanings, each with a page of its own.",
    "template": "Not assessed: a template, which other pages include.",
    "category": "Not assessed: a category, which lists pages.",
    "file": "Not assessed: the description of a file.",
    "wikipedia_related": "Not assessed: a page about the project itself.",
    "portal": "Not assessed: a portal, which leads to pages of a subject.",
    "help": "Not assessed: a help page.",
}
MIX_TITLE = "- the references distribution:"
