"""Schemas of all datasets."""

from __future__ import annotations

PAGES = "title string, ns int, is_redirect boolean, text string, ordinal long"
ARTICLES = "article_name string, article_text string"
TERMS = "article_name string, term string, article_ref string, term_distance int"
TERM_DF = "term string, df float"
TERM_SCORES = "term string, doc string, tf_idf float"
CATEGORIES = "name string, parents array<string>"
REDIRECTS = "from_title string, to_title string"
DISAMBIGS = "title string"
COUNTERS = "counter string, value long"
EDGES = "child string, parent string"

# Sub-directories of a working directory.
TERMS_DIR, TERM_DF_DIR, TERM_SCORES_DIR, COUNTERS_DIR, REJECTS_DIR = "terms", "term_df", "term_scores", "counters", "rejects"
