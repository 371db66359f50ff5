"""Results depend on them being exactly these."""

from __future__ import annotations

# Ukrainian month names in the genitive -> month number.
UKRAINIAN_MONTHS = {
    "січня": 1,
    "лютого": 2,
    "березня": 3,
    "квітня": 4,
    "травня": 5,
    "червня": 6,
    "липня": 7,
    "серпня": 8,
    "вересня": 9,
    "жовтня": 10,
    "листопада": 11,
    "грудня": 12,
}

# English month names -> month number.
ENGLISH_MONTHS = {
    "january": 1,
    "february": 2,
    "march": 3,
    "april": 4,
    "may": 5,
    "june": 6,
    "july": 7,
    "august": 8,
    "september": 9,
    "october": 10,
    "november": 11,
    "december": 12,
}

# Zone names of RFC 2822 dates -> offset in hours.
RFC_ZONES = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -4, "ADT": -3,
    "EST": -5, "EDT": -4,
    "CST": -6, "CDT": -5,
    "MST": -7, "MDT": -6,
    "PST": -8, "PDT": -7,
}

# The term dictionary of the monthly trend, label -> pattern.
TREND_TERMS = {
    "незламно": "незламн",
    "потужно": "потужн",
    "дякую": "дякую",
    "перемога": "перемо[гзж]",
    "партнер": "партнер",
    "корупція": "корупці",
}
MONTH_COLUMN = "місяць"

# Markers of a page that blocks crawlers.
BLOCKED_HEAD_MARKER = "Access Denied"
BLOCKED_HEAD_CHARS = 500
BLOCKED_BODY_MARKER = "sec-if-cpt-container"

# Class names of the crawled site's markup.
ARTICLE_CLASS = "article_content"
LISTING_CLASS = "cat_list"
HEADLINE_CLASS = "item_stat_headline"
DATE_CLASS = "date"

# Thresholds and sizes of the reports.
MAX_FOREIGN_FRACTION = 0.035
MIN_WORD_CHARS = 5
TOP_WORDS = 20
