"""Settings with their default values.  Lists, patterns and numbers here are fixed values of the rubric."""

from __future__ import annotations

from dataclasses import dataclass, field

# Rubric weights in declaration order, and the largest penalty.
WEIGHTS = {
    "answer_first": 20.0,
    "question_headings": 10.0,
    "comparison_table": 15.0,
    "qa_faq_block": 15.0,
    "stats_count": 10.0,
    "citations_count": 5.0,
    "schema_completeness": 10.0,
    "freshness": 5.0,
    "gifting_persona_language": 10.0,
}
PENALTY = "keyword_stuffing_penalty"

# Content types in order of precedence, their patterns in order, and whether a decision page.
PATTERNS = (
    ("comparison_vs", (r"\bvs\b", r"versus", r"compare"), True),
    ("buying_guide", (r"\bbest\b", r"guide", r"choosing", r"which"), True),
    ("gift_guide", (r"gift", r"for-him", r"for-her", r"for-home"), True),
    ("price_bracket", (r"under[- ]?\$?\d+", r"budget", r"cheap"), True),
)
FALLBACK_TYPE = "informational"
# Slugs typed by hand, with their content type and whether a decision page.
OVERRIDES = {
    "compact-fabric-steamer-for-trips": ("buying_guide", True),
    "multi-purpose-fabric-steamer-guide": ("buying_guide", True),
    "Ecommerce-Beginners-Guide-How-to-use-a-steamer": ("informational", False),
}

# Word lists.
QUESTION_WORDS = ("who", "what", "why", "how", "when", "which", "is", "does", "can")
GIFT_PHRASES = ("gift", "for him", "for her", "present")
STOPWORDS = (
    "the", "a", "an", "and", "or", "but", "of", "to", "in", "on", "for", "with", "is", "are", "was", "were", "be", "been", "it", "its",
    "this", "that", "as", "at", "by", "from", "your", "you", "will", "can", "if", "not", "so", "than", "into", "up", "out", "about",
    "then", "also", "our", "we",
)
EXPECTED_SCHEMA = ("Article", "FAQPage", "BreadcrumbList")
COLOURS = ("black", "silver", "blue", "green", "red coral", "yellow", "aqua green", "copper", "metal", "white")
REVIEW_START = ("reviews", "customer reviews", "rating snapshot", "ratings & reviews", "ratings and reviews")
REVIEW_END = ("faq", "faqs", "frequently asked questions")
FAQ_HEADINGS = ("FAQ", "FAQS", "FREQUENTLY ASKED QUESTIONS")
BLOCK_WORDS = ("access denied", "just a moment", "attention required", "captcha", "forbidden", "are you a robot")
# What a page capture leaves out, where it looks, and which elements are blocks.
SKIP_TAGS = ("header", "nav", "footer", "script", "style", "noscript")
SKIP_ATTRIBUTES = (("role", "dialog"), ("aria-modal", "true"))
SKIP_MARKED = "data-bv-show"
SKIP_IDS = ("BVRR", "bv-")
SKIP_CLASSES = ("bv-cv2", "bv_main")
MAIN_TAG, MAIN_ID, MAIN_CLASS = "main", "maincontent", "page-main"
BLOCK_TAGS = ("h1", "h2", "h3", "h4", "p", "li", "td", "th", "dt", "dd", "figcaption", "blockquote", "label")
LEAF_TAGS = ("div", "span")
HEADING_TAGS = ("h1", "h2", "h3", "h4")
SPEC_RESERVED = ("category", "product_name", "sku", "url", "source", "last_verified")
QUESTION_KEYS = ("isA", "used_for_audience", "used_for_function", "used_for_event", "capable_of", "cause_benefit")
EDIT_ACTIONS = ("replace", "add", "remove")
PRIORITY_CATEGORIES = ("steam_iron", "handheld_steamer", "suction_steamer")


@dataclass(frozen=True)
class Rubric:
    """What page scoring may be told to do otherwise."""

    own_domain: str = "own.example"
    weights: dict = field(default_factory=lambda: dict(WEIGHTS))
    answer_words: tuple[int, int] = (15, 80)
    low_density: float = 0.02
    high_density: float = 0.06
    stopwords: tuple[str, ...] = STOPWORDS
    fresh_days: tuple[int, int] = (365, 730)
