"""Main-text extraction by equivalence-class template deduction.

Tokens are the element openings of a page, named by their path of tags and
classes.  A token's occurrence vector over a host's pages (how often on which
page) is kept as sums of hashes, so vectors of any length group by equality.
Tokens of one host with equal vectors form an equivalence class; a class is
valid if its tokens occur at most once a page, so that they are ordered by
position and nested by path.  Valid classes nest into the host's template; the
places where they say that text goes are its slots.  The content slot of a class
is its innermost container that still holds most of the page's running text, an
article or main element before others, and a page is read from the first such
slot that it has.

Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts
and styles are known by element name, role or whole class and belong to no slot;
a class or role doesn't count where the page's article or most of its text is below.
Text is cut at block elements; white space (also of character references)
becomes one space.

Per host and token one row is kept, so a hot host costs its share of the scan
and no more.  The template table is written once; whether it is broadcast is
left to the planner, which knows its size.

Edge cases: null or empty html gives empty text; a null url is a host of its own;
pages of a host with other layouts are read by their own classes, or from the
body; repeated rows give repeated results; broken markup is closed at the end.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged, unused

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Element names and class words, by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title iframe select button".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = "article main section div body html td center".split()
CHROME = frozenset("nav aside form footer menu dialog head".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar toolbar form".split())
CHROME_WORDS = frozenset("ad ads advert advertisement advertising sponsor sponsored promo cookie cookies consent notice popup modal menu "
                         "nav navbar navigation breadcrumb breadcrumbs sidebar comment comments disqus newsletter subscribe".split())
OUTER_WORDS = frozenset("header footer banner masthead".split())
# what a chrome word is put together with: ad-banner, cookie-notice, left_sidebar
CHROME_PARTS = frozenset("area bar block bottom box container footer header banner holder inner left list main outer panel primary right "
                         "secondary section site slot top unit widget wrap wrapper".split())
ROOTS = frozenset("html body main article".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


def _chrome_token(token: str) -> bool:
    """A whole class or id that is a chrome word, or a compound of nothing else."""
    parts = [p for p in re.split(r"[-_]+", token) if p]
    return any(p in CHROME_WORDS for p in parts) and all(p in CHROME_WORDS or p in CHROME_PARTS for p in parts)


def _is_chrome(name: str, tokens: list[str], role: str, inside: bool) -> str:
    """"" for content, "name" for what an element's name tells, "word" for what
    its class, id or role tells, which the page's text can refute."""
    if name in ROOTS:
        return ""
    if name in CHROME or (name == "header" and not inside):
        return "word" if name in ("form", "dialog") else "name"
    if role in CHROME_ROLES or any(_chrome_token(t) or (t in OUTER_WORDS and not inside) for t in tokens):
        return "word"
    return ""


def read_page(page: str | None) -> tuple[dict[str, list[int]], list[tuple[str, str]]]:
    """(path -> [openings, characters of running text below], blocks as (path, text))."""
    page = page or ""
    opened: list[tuple[str, tuple[int, ...]]] = []  # block elements: path, marks
    texts: list[tuple[str, list[tuple[str, tuple[int, ...]]]]] = []  # blocks: path, pieces with their marks
    # a mark is an element that looks like chrome: known by name, in an article, holds an article
    marks: list[list[bool]] = []
    stack: list[tuple[str, str, tuple[int, ...], bool]] = [("", "", (), False)]  # name, path, marks, inside an article
    held: list[tuple[str, tuple[int, ...]]] = []
    at = 0

    def flush() -> None:
        if held:
            texts.append((next(p for n, p, _, _ in reversed(stack) if n in BLOCK or not n), held.copy()))
            held.clear()

    def close(depth: int) -> None:
        if any(n in BLOCK for n, _, _, _ in stack[depth:]):
            flush()
        del stack[depth:]

    while m := _TOKEN.match(page, at):
        at = m.end()
        name = m[2]
        if name is None:
            if not m[0].startswith(("<!", "<?")):
                held.append((m[0], stack[-1][2]))
            continue
        name = name.lower()
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if depth:
                close(depth)
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at) if not m[3].rstrip().endswith("/") else None
            at = end.end() if end else (len(page) if name in ("script", "style", "textarea", "title") else at)
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name == "br":
                held.append((" ", stack[-1][2]))
            continue
        if name in BLOCK:
            flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p" or stack[i][0] in CLOSES.get(name, ()):
                    del stack[i:]
                    break
                if stack[i][0] in BLOCK:
                    break
        found = {a.lower(): (x or y or z).lower() for a, x, y, z in _ATTRIBUTE.findall(m[3])}
        classes = found.get("class", "").split()
        tokens = [*classes, *found.get("id", "").split()]
        _, above, under, inside = stack[-1]
        chrome = "name" if found.get("aria-hidden") == "true" and name not in ROOTS else _is_chrome(name, tokens, found.get("role", ""), inside)
        if name in ("article", "main"):
            for i in under:
                marks[i][2] = True
        if chrome:
            under = (*under, len(marks))
            marks.append([chrome == "name", inside, False])
        path = above
        if name in BLOCK:
            own = ".".join([name, *sorted(c.replace("/", "") for c in classes)])
            path = f"{above}/{own}" if above else own
            opened.append((path, under))
        stack.append((name, path, under, inside or name in ("article", "main")))
    flush()
    return _running_text(opened, texts, marks)


def _running_text(opened: list, texts: list, marks: list[list[bool]]) -> tuple[dict[str, list[int]], list[tuple[str, str]]]:
    """Elements and blocks without chrome.  An element marked by class, id or role
    is content if it holds an article (but for those within an article, as
    comments are) or, on a page without an unmarked article, more than half of the
    text that no name marks."""
    plain = any(not under and path.rpartition("/")[2].split(".")[0] in ("article", "main") for path, under in opened)
    size, total = [0] * len(marks), 0
    for _, pieces in texts:
        for text, under in pieces:
            if not any(marks[i][0] for i in under):
                n = len("".join(text.split()))
                total += n
                for i in under:
                    size[i] += n
    chrome = [named or not ((holds and not inside) or (2 * n > total and not plain)) for (named, inside, holds), n in zip(marks, size)]
    elements: dict[str, list[int]] = {"": [1, 0]}
    for path, under in opened:
        if not any(chrome[i] for i in under):
            elements.setdefault(path, [0, 0])[0] += 1
    blocks: list[tuple[str, str]] = []
    for path, pieces in texts:
        if text := " ".join(unescape("".join(t for t, under in pieces if not any(chrome[i] for i in under))).split()):
            blocks.append((path, text))
            parts = path.split("/") if path else []
            for i in range(len(parts) + 1):
                elements.setdefault("/".join(parts[:i]), [0, 0])[1] += len(text)
    return elements, blocks


def host(url: str = "url"):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def deduce_templates(pages: DataFrame, share: float = 0.8) -> DataFrame:
    """(host, slots): the paths of the host's content slots, articles first, then
    deepest first.

    A class's content slot is its container whose text makes at least ``share``
    of the running text of the pages that have it, in that order."""
    def tokens(batches):
        for pdf in batches:
            seen: dict[tuple[str, str], list[int]] = {}
            for h, page in zip(pdf["host"], pdf["html"]):
                elements, _ = read_page(page)
                name = xxhash.xxh64_intdigest((page or "").encode("utf-8", "surrogatepass"))
                one, two = name & 0x7FFFFFFF, name >> 33
                whole = elements[""][1]
                for path, (n, chars) in elements.items():
                    row = seen.setdefault((h, path), [0, 0, 0, 0, 0, 0])
                    for i, v in enumerate((1, n, n * one, n * two, chars, whole)):
                        row[i] += v
            yield pd.DataFrame([(*k, *v) for k, v in seen.items()], columns=["host", "path", "pages", "n", "v1", "v2", "chars", "whole"])

    sums = ["pages", "n", "v1", "v2", "chars", "whole"]
    found = (pages.select(host().alias("host"), "html").mapInPandas(tokens, "host string, path string, " + ", ".join(f"{c} long" for c in sums))
             .groupBy("host", "path").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in sums]))
    vector = ["host", "pages", "n", "v1", "v2"]
    name = F.regexp_extract("path", r"([^/.]*)(?:\.[^/]*)?$", 1)
    once = found.where((F.col("n") == F.col("pages")) & (F.col("chars") >= share * F.col("whole")) & name.isin("", *CONTAINER))
    slot = once.groupBy(*vector).agg(F.max(F.struct(name.isin("article", "main").alias("article"), F.size(F.split("path", "/")).alias("depth"), F.length("path").alias("size"), "path")).alias("s"))
    return slot.groupBy("host").agg(F.sort_array(F.collect_set("s"), asc=False).alias("s")).select("host", F.col("s.path").alias("slots"))


def extract_text(pages: DataFrame, out: str = "text") -> DataFrame:
    """``pages`` (url, html and others) with the main text in ``out``."""
    templates = staged(deduce_templates(pages), "html-templates")

    @F.pandas_udf("string")
    def read(html: pd.Series, slots: pd.Series) -> pd.Series:
        made = []
        for page, paths in zip(html, slots):
            elements, blocks = read_page(page)
            slot = next((p for p in (paths if paths is not None else ()) if p in elements and elements[p][0] == 1), "")
            below = slot + "/"
            made.append("\n".join(t for p, t in blocks if not slot or p == slot or p.startswith(below)))
        return pd.Series(made)

    own, other, slots = unused(pages, "__host", "__of", "__slots")
    joined = pages.withColumn(own, host()).join(templates.select(F.col("host").alias(other), F.col("slots").alias(slots)),
                                                F.col(own) == F.col(other), "left")
    return joined.withColumn(out, read(F.coalesce("html", F.lit("")), slots)).drop(own, other, slots)
