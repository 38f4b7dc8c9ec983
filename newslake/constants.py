"""Fixed values.

Everything in this module must equal what the source pipeline uses, so that
results match it: sentinel texts, marker phrases, zone labels, CSS selectors
per site layout, element lists removed before text conversion and the English
stopword list.  They are stated here once, in their natural order.
"""

# ---------------------------------------------------------------- fixed values
# Sentinels written when a field cannot be extracted from an article page.
NO_TITLE = "No title"
NO_AUTHOR = "No author"
NO_CONTENT_EXTRACTED = "Cannot extract article content"

# Defaults used by the JSON listing normalisers.
NO_TITLE_FOUND = "No title found"
UNKNOWN = "Unknown"
NO_CONTENT_FOUND = "No content found"

# Work-list markers for articles whose extraction failed.
UNEXTRACTED_TITLE_MARKER = "no title"
UNEXTRACTED_CONTENT_MARKER = "cannot extract article"

# Boilerplate marker cut from content in staging, and the source it applies to.
BOILERPLATE_MARKER = "Read Next"
BOILERPLATE_SOURCE = "inquirer"

# Weekday abbreviations accepted in RFC-822-like publish times (any case).
WEEKDAY_ABBREVIATIONS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]

# Zone labels stripped (not converted) from RFC-822-like publish times.
ZONE_LABELS = ["PST", "PHT", "UTC", "GMT"]
# Minutes ahead of UTC that the labels stand for where they are converted (PST: Philippine time).
ZONE_OFFSETS = {"PST": 480, "PHT": 480, "UTC": 0, "GMT": 0}

# Access-challenge detection: phrases searched in the first 2,000 lower-cased
# characters of a page; the live check uses only the first phrase.
CHALLENGE_PHRASES = ["just a moment", "cf-browser-verification", "attention required"]
CHALLENGE_LIVE_PHRASES = ["just a moment"]
CHALLENGE_STATUSES = [403, 503]
CHALLENGE_SCAN_CHARS = 2000

# Link-harvest block rules: (slug substring, subdomain or None for any).
SLUG_BLOCK_RULES = [("lotto", None), ("daily-gospel", "cebudailynews")]

# Elements dropped (with their content) before crawled HTML becomes text.
CRAWL_UNWANTED_IDS = ["billboard_article", "article-new-featured", "taboola-mid-article-thumbnails",
                      "taboola-mid-article-thumbnails-stream", "fb-root"]
CRAWL_UNWANTED_CLASSES = ["ztoop", "sib-form", "cdn_newsletter"]
CRAWL_UNWANTED_TAGS = ["script", "style"]
# Elements dropped from listing bodies.
LISTING_UNWANTED_TAGS = ["img", "figure", "iframe"]

# Per-subdomain selectors (CSS) used by the article-page extractors.
TITLE_SELECTORS = {
    "lifestyle": ["h1.elementor-heading-title"],
    "pop": ["div.single-post-banner-inner > h1"],
    "cebudailynews": ["#b-masthead .bmhead-headline h1", "#landing-headline h1", "#art-hgroup h1"],
    "bandera": ["#landing-headline h1"],
    "*": ["h1.entry-title"],
}
AUTHOR_META_SELECTORS = ['meta[name="author"]', 'meta[name="twitter:data1"]', 'meta[property="article:author"]']
AUTHOR_SELECTORS = {
    "lifestyle": ["div.elementor-widget-post-info ul.elementor-post-info li span.elementor-post-info__terms-list a"],
    "pop": ["ul.blog-meta-list a[href*='/byline/']"],
    "cebudailynews": ['.bmhead-headline .bpdate a[href*="/byline/"]'],
}
# Byline forms read with a regular expression from span text.
AUTHOR_SPAN_SELECTOR = "#m-pd2 span"
AUTHOR_SPAN_PATTERN_CEBU = r"By:\s*(.+)"
AUTHOR_SPAN_PATTERN_BANDERA = r"^([\w\s.]+)\s+-"
AUTHOR_CEBU_LAST = ".art-byline a"
AUTHOR_DEFAULT_BYLINE_ATTR = ("div#art_author", "data-byline-strips")
AUTHOR_DEFAULT_PLATFORM = "div#art_plat"
CONTENT_SELECTORS = {
    "lifestyle": "div.elementor-widget-theme-post-content",
    "pop": "div#TO_target_content",
    "cebudailynews": "div#article-content",
    "usa": "div#TO_target_content",
    "*": "div#FOR_target_content",
}
TAG_LINK_SELECTORS = {
    "pop": "div.tags-box span.tags-links a",
    "*": "div#article_tags a",
}
TAG_MARKER = "/tag/"
PUBLISH_META_SELECTORS = ['meta[property="article:published_time"]', 'meta[name="parsely-pub-date"]']
PUBLISH_BODY_SELECTOR = ".bmhead-headline .bpdate"

# Source labels written by the three listing normalisers.
SOURCE_LISTING_DETAIL = "abs-cbn"
SOURCE_SECTIONED = "manila_bulletin"
SOURCE_NESTED_POSTS = "rappler"

# Site roots used to make listing links absolute.
LISTING_A_SITE_ROOT = "https://www.abs-cbn.com/"
INDEX_URL_TEMPLATE = "https://www.inquirer.net/article-index/?d={date}"

# English stopwords (179 words), compared case-sensitively against tokens.
ENGLISH_STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll",
    "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's",
    "her", "hers", "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "that'll", "these", "those", "am",
    "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while",
    "of", "at", "by", "for", "with", "about", "against", "between", "into", "through", "during",
    "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "don't", "should", "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren",
    "aren't", "couldn", "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn",
    "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't",
    "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't", "weren",
    "weren't", "won", "won't", "wouldn", "wouldn't",
]
# ------------------------------------------------------------ end fixed values
