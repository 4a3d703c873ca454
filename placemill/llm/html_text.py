r"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block of text in page order. The text of menus, headers, footers, sidebars, notices,
adverts, forms, scripts and reader comments leaves a line of length 0 where it stood; text inside links does not count
as length. Containers outside an article stand ``WINDOW`` empty lines apart. Over windows of ``WINDOW`` lines the lengths are
summed. A run of text begins where the sums surge above 0 and ends where they dive back to 0. Main text reaches from the
surge of the first run whose sums come up to the threshold to the dive of the last one; runs between them are kept whole. The
threshold is ``LONG_RUN``, or on pages of short texts ``SHARE`` of the page's largest sum. This decides on every page: an article
element only makes text in its links count as length and keeps its containers together.

Defined results: a NULL or empty html gives an empty text; a page that breaks off inside a tag, comment, script or
style loses that rest; repeated rows are extracted alike; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.llm.common import map_batches

WINDOW = 3      # lines summed at a time
LONG_RUN = 240  # characters outside links in one window that make a run of lines main text,
SHARE = 1 / 3   # or this share of the page's largest window, if that is less

# fixed values: element names of HTML by their effect on the text
UNSEEN = {"head", "title", "script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "audio",
          "video", "select", "button", "textarea", "datalist", "map"}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "search"}
MAIN = {"article", "main"}
CONTAINERS = {"body", "div", "section", "center", "details", "fieldset", "table"} | ASIDE | MAIN
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
          "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
          "var", "wbr", "img", "picture", "source", "br", "input"}
SPACED = {"br", "td", "th", "img"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "svg")
# fixed values: words of a class, id or role that tell what a container is for
PURPOSE = re.compile(
    r"^(?:ads?|adv|advert.*|adsense|banners?|sponsor.*|promo.*|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlay|newsletter|"
    r"subscri.*|shar(?:e|ing)|social|sidebars?|sidenav|widgets?|related|recommend.*|nav|navbar|navigation|menus?|breadcrumbs?|header|"
    r"masthead|topbar|footers?|comments?|commentlist|repl(?:y|ies)|respond|disqus|discussion|login|signin|signup|search|searchbox|"
    r"pagination|pager|toolbar|copyright|disclaimer|skip|hidden|complementary|contentinfo|dialog)$")

# fixed values: first words of names of an article's own parts, and what may then follow without setting it apart
ARTICLE_WORDS = {"article", "post", "entry", "story", "content"}
OF_ARTICLE = {"header", "notice", "notices"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][\w:-]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][\w:-]*)([^>]*)>|<(?=[a-zA-Z/])[^>]*\Z", re.S)
_RAW_END = {name: re.compile(rf"</{name}\s*[^>]*>", re.I) for name in RAW}
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|itemprop\s*=\s*[\"']?comment", re.I)
_BODY = re.compile(r"itemprop\s*=\s*[\"']?articleBody", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")


def _set_apart(name: str, attributes: str) -> bool:
    """Whether an element's content is not main text, by its attributes."""
    if name in MAIN or name in {"html", "body"} or not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    for value in _NAMED.findall(attributes):
        for word in re.sub(r"([a-z0-9])([A-Z])", r"\1-\2", "".join(value)).lower().split():
            parts = _PARTS.split(word)
            own = OF_ARTICLE if parts[0] in ARTICLE_WORDS else set()
            if parts[0] not in {"with", "has", "no"} and any(PURPOSE.match(p) and p not in own for p in parts):
                return True
    return False


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    """(text, characters outside links, whether in the article) of each line; lines set apart are empty."""
    lines: list[tuple[str, int, bool]] = []
    buffer: list[str] = []
    linked = link = main = 0
    skipped, depth, skipped_text = "", 0, False
    at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(buffer)).split()) if buffer else ""
        if text:
            lines.append((text, max(0, len(text) - linked), main > 0))
        buffer.clear()
        linked = 0

    def part() -> None:
        while not main and lines and any(text for text, _, _ in lines[-WINDOW:]):
            lines.append(("", 0, False))

    for token in _TOKEN.finditer(page):
        start = token.start()
        if start < at:
            continue
        text = page[at:start]
        at = token.end()
        if text:
            if skipped:
                skipped_text = skipped_text or not text.isspace()
            else:
                buffer.append(text)
                if link:
                    linked += len(text.strip())
        name = (token[2] or token[5] or "").lower()
        if not name:
            continue
        closing = bool(token[1] or token[4])
        attributes = token[3] or token[6] or ""
        if skipped:
            if name == skipped:
                depth += -1 if closing else 0 if attributes.endswith("/") else 1
            if depth and not (name in MAIN and not closing and not main):
                continue
            if skipped_text:
                lines.append(("", 0, main > 0))
                if skipped in CONTAINERS:
                    part()
            at_main = depth > 0
            skipped, depth = "", 0
            if not at_main:
                continue
        if not closing and name in _RAW_END:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            if name not in INLINE:
                flush()
            continue
        if not closing and name not in VOID and (
                name in UNSEEN or (name in ASIDE and not (name == "header" and main)) or _set_apart(name, attributes)):
            if name not in INLINE:
                flush()
            if not attributes.endswith("/"):
                skipped, depth, skipped_text = name, 1, False
            continue
        if name == "a":
            link = 0 if closing else 1
        if name in INLINE or name in {"td", "th"}:
            if name in SPACED:
                buffer.append(" ")
            continue
        flush()
        if name in CONTAINERS:
            part()
        if name in MAIN or (not closing and _BODY.search(attributes)):
            main = max(0, main + (-1 if closing else 1)) if name in MAIN else 1
            part()
    if not skipped:
        buffer.append(page[at:])
    flush()
    return lines


def main_lines(lines: list[tuple[str, int, bool]]) -> list[str]:
    """The lines from the first surge to the last dive of the window sums that come up to the threshold."""
    sizes = [0 if not text else len(text) if main else n for text, n, main in lines]
    sums = [sum(sizes[i:i + WINDOW]) for i in range(len(sizes))]
    threshold = max(1, min(LONG_RUN, SHARE * max(sums, default=0)))
    runs: list[tuple[int, int, bool]] = []
    i = 0
    while i < len(sums):
        if not sums[i]:
            i += 1
            continue
        dive = i
        while dive < len(sums) and sums[dive]:
            dive += 1
        surge = i
        while not sizes[surge]:  # a window sees the surge before its first line does
            surge += 1
        runs.append((surge, dive, max(sums[i:dive]) >= threshold))
        i = dive
    high = [k for k, run in enumerate(runs) if run[2]]
    kept = runs[high[0]:high[-1] + 1] if high else []
    return [text for surge, dive, _ in kept for text, _, _ in lines[surge:dive] if text]


def main_text(page: str | None) -> str:
    return "\n\n".join(main_lines(page_lines(page))) if page else ""


def _batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [main_text(h) for h in batch.column(2).to_pylist()]
    return pa.record_batch([*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                           names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_batches(rows, _batch, "page_id long, url string, text string, n_chars long")
