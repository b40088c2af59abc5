"""Reviews and links from a table of raw HTML pages.

Pages are independent, so each Arrow batch is parsed where it lies (no shuffle)
with the standard-library parser; everything after tag matching is Spark
expressions.
"""

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.functions import parsing as pr
from starsift.functions import text as tx

# --- Fixed values: where a page keeps each review field (data-hook or class) ---
REVIEW_HOOK = "review"
REVIEW_CLASSES = {"a-section", "review"}
FIELD_HOOKS = {
    "review-star-rating": "stars_label",
    "review-title": "review_title",
    "review-body": "review_text",
    "review-collapsed": "review_text",
    "review-date": "review_date",
    "avp-badge": "badge",
    "helpful-vote-statement": "votes_label",
}
NAME_CLASSES = ("a-profile-name", "reviewer-name")
IMAGE_SECTIONS = ("review-image-tile-section", "review-image-tile", "review-image")
NEXT_CLASS, NEXT_HOOK, NEXT_LABEL = "a-last", "pagination-bar-next-button", "Next page"

FIELDS = ["reviewer_name", "stars_label", "review_title", "review_text", "review_date", "badge", "votes_label"]
RAW_SCHEMA = "page_id bigint, url string, position int, " + ", ".join(f"{f} string" for f in FIELDS) + (
    ", images array<string>"
)
LINK_SCHEMA = "page_id bigint, url string, position int, href string, is_next boolean"
VOID = {"img", "br", "hr", "meta", "link", "input", "area", "base", "col", "embed", "source", "track", "wbr"}


class ReviewTags(HTMLParser):
    """Collects review fields and links of one page.

    Open tags are kept on a stack so that unclosed elements do not shift the
    nesting: a closing tag pops back to its opener.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.reviews, self.links = [], [], []
        self.opened = {}  # region name -> stack depth at which it was opened
        self.field = None

    def _open(self, region):
        self.opened.setdefault(region, len(self.stack))

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        hook, css = a.get("data-hook") or "", (a.get("class") or "").split()
        if tag not in VOID:
            self.stack.append(tag)
        if tag == "div" and "review" not in self.opened and (hook == REVIEW_HOOK or REVIEW_CLASSES <= set(css)):
            self._open("review")
            self.reviews.append({"primary": hook == REVIEW_HOOK, "images": []})
        if tag == "li" and NEXT_CLASS in css:
            self._open("pager")
        if tag == "a" and a.get("href"):
            is_next = "pager" in self.opened or hook == NEXT_HOOK or a.get("aria-label") == NEXT_LABEL
            self.links.append((a["href"], is_next))
        if "review" in self.opened:
            self._review_tag(tag, a, hook, css)

    def _review_tag(self, tag, a, hook, css):
        review = self.reviews[-1]
        field = FIELD_HOOKS.get(hook)
        if any(n in c for c in css for n in NAME_CLASSES):
            field = "reviewer_name"
        elif any("verified-purchase" in c for c in css):
            field = "badge"
        elif tag == "a" and any("star-rating" in c for c in css):
            field = "stars_label"
        if hook in IMAGE_SECTIONS or any(c in IMAGE_SECTIONS for c in css):
            if tag not in VOID:
                self._open("images")
        if tag == "img" and ("images" in self.opened or hook in IMAGE_SECTIONS):
            review["images"].append(a.get("src") or a.get("data-src") or "")
        label = a.get("aria-label") or a.get("title")
        if label and "stars_label" in (field, self.field):
            review["stars_label"] = review.get("stars_label") or label
        if field and self.field is None and tag not in VOID and field not in review:
            self.field = field
            self._open("field")
            review[field] = ""
        if field == "stars_label" and label:
            review["stars_label"] = review.get("stars_label") or label

    def handle_endtag(self, tag):
        if tag not in self.stack:
            return
        while self.stack.pop() != tag:
            pass
        self.opened = {r: d for r, d in self.opened.items() if d <= len(self.stack)}
        if "field" not in self.opened:
            self.field = None

    def handle_data(self, data):
        if self.field is not None and self.field != "stars_label":
            self.reviews[-1][self.field] += data.strip()


def _parse(html: str) -> ReviewTags:
    parser = ReviewTags()
    parser.feed(html or "")
    return parser


def _review_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for page in pdf.itertuples(index=False):
            found = _parse(page.html).reviews
            chosen = [r for r in found if r["primary"]] or found
            for i, r in enumerate(chosen):
                rows.append((page.page_id, page.url, i, *[r.get(f) for f in FIELDS], r["images"]))
        yield pd.DataFrame(rows, columns=["page_id", "url", "position", *FIELDS, "images"])


def _link_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [
            (page.page_id, page.url, i, urljoin(page.url or "", href), is_next)
            for page in pdf.itertuples(index=False)
            for i, (href, is_next) in enumerate(_parse(page.html).links)
        ]
        yield pd.DataFrame(rows, columns=["page_id", "url", "position", "href", "is_next"])


def pages_to_reviews(pages: DataFrame) -> DataFrame:
    """One row per review on each page, ready for ``type_scraped_reviews``."""
    raw = pages.select("page_id", "url", "html").mapInPandas(_review_batches, RAW_SCHEMA)
    name = F.nullif(tx.strip(F.coalesce("reviewer_name", F.lit(""))), F.lit(""))
    urls = pr.image_urls(F.col("images"))
    return raw.select(
        "page_id",
        "position",
        F.coalesce(name, F.lit("Anonymous")).alias("reviewer_name"),
        pr.parse_stars(F.col("stars_label")).alias("star_rating"),
        tx.strip(F.coalesce("review_title", F.lit(""))).alias("review_title"),
        tx.strip(F.coalesce("review_text", F.lit(""))).alias("review_text"),
        tx.strip(F.coalesce("review_date", F.lit(""))).alias("review_date"),
        F.col("badge").isNotNull().alias("verified"),
        pr.parse_votes(F.col("votes_label")).alias("helpful_votes"),
        F.array_join(urls, "|").alias("image_urls"),
        F.col("url").alias("source_url"),
    )


def links(pages: DataFrame) -> DataFrame:
    """Every link of every page, resolved against the page's URL."""
    return pages.select("page_id", "url", "html").mapInPandas(_link_batches, LINK_SCHEMA)


def next_page_links(pages: DataFrame) -> DataFrame:
    """Edge table page -> next page: the first pager link of each page."""
    firsts = links(pages).filter("is_next").groupBy("page_id", "url").agg(F.min_by("href", "position").alias("to_url"))
    return firsts.select("page_id", F.col("url").alias("from_url"), "to_url")
