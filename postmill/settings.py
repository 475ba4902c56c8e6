"""Defaults of the public functions; every one of them is a parameter as well."""

# Fixed values of the data source.
BODY_PLACEHOLDERS = ("", "[removed]", "[deleted]")
AUTHOR_PLACEHOLDER = "[deleted]"
MISSING_FLAIR = "unflaired"
SITE = "https://reddit.com"

# Fixed sizes. POSTS_PER_CHANNEL and EMBED_CHARS are limits a caller may ask for; no job applies them
# by itself. PREVIEW_CHARS is what a result shows.
POSTS_PER_CHANNEL = 500
TOP_POSTS = 50
EMBED_TOP = 100
EMBED_CHARS = 2000
EMBED_BATCH = 256
SEARCH_K = 5
PREVIEW_CHARS = 1500
REPORT_ROWS = 20
ALL_GROUPS = "All"
MODEL_NAME = "all-MiniLM-L6-v2"
