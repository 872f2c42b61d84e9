"""Main text of web pages by templates deduced from the pages of a host.

Every page is read as tokens: tags told apart by the path of tags above them, the text of
blocks, and elements in an article whose names speak of a surrounding. On each host, tokens whose
occurrence vectors (how often on which page) agree form an equivalence class. A vector is never
gathered: it is summed up as the sum over pages of a hash of (page, count), which adds up in the scan
tasks. Classes that occur on enough pages with at least ``CLASS_SIZE`` tokens are valid; as paths
tell where a token stands, classes nest by them, and together they make the host's template.
A page is read again with it: text of the template is left out, text between is a slot.

- In an article (or ``main``), text is the template's if it is in the class of the article's own tag, on
  every page of a host of ``LEAST_FIXED`` pages or more: what each article repeats. Text that only
  some pages share, such as a common passage, stays, and so does all of an article that has
  nothing else, such as copies of one page.
- Elements there with a name that has a word of ``MARKS`` (``related-work``, ``lunch menu``) hold article
  text, unless the template has them; only elements all of whose names are such words
  (``comments``) are left out on a host without a template.
- Then tag roles choose between the slots: those of articles, unless the slots around hold more than
  ``TEASER`` times as much; else the slots of the body but those of menus, notices and the like.

Roles of tags are taken from HTML itself: ``nav``, ``footer``, ``form``, ``script``... and the
usual class names of adverts, notices and comments. A null or empty html gives an empty text. Tags
that are not closed end with the element around them. Repeated rows each give their row.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemark.llm.common import cut, query, small_batches, table
from rulemark.llm.url_filter import host_and_path

#: A class is valid on this share of a host's pages, and on so many at least.
SUPPORT, LEAST_PAGES = 0.3, 4
#: Tokens of a valid class, texts in articles not counted.
CLASS_SIZE = 3
#: Pages of a host whose articles can be told from what they all repeat.
LEAST_FIXED = 8
#: An article is a teaser if the slots around it hold so many times as much.
TEASER = 3
#: Kinds of tokens: tags and texts of the page, texts in an article, the tag of an article.
AROUND, WITHIN, OPENING = range(3)
#: Tokens (of 8 bytes) of all templates that may be broadcast; beyond it pages are shuffled by host.
BROADCAST_TOKENS = 1_000_000

#: Elements of HTML without content, and those whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas audio video select".split())
#: Elements that never hold main text, and those that do.
ASIDE = frozenset("nav footer aside form button dialog menu fieldset".split())
MAIN = ("article", "main")
OPENINGS = tuple(f"|{name}" for name in MAIN)
BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Closed by the start of one of the same kind, as HTML has it.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Class, id and role words of what surrounds an article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent notice notices alert popup modal newsletter "
    "subscribe sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments reply replies disqus "
    "share sharing social related recommended widget pagination toolbar login search skip".split()
)

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
#: Ends of elements whose content is no markup, so that neither ``a<b`` nor ``<!--`` in a script counts.
ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
#: Elements that hold the page, and headings, whose names tell of the page or of a place in it.
UNMARKED = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
#: Names that tell what is elsewhere on the page, or is not: ``has-sidebar``, ``no-comments``.
ELSEWHERE = re.compile(r"(?:has|no|with|without|is|hide|show)[-_]")
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
SPACE = re.compile(r"\s+")


def marks_of(attributes: str) -> tuple[bool, bool, str]:
    """Has an element a name with a word of ``MARKS``, are all its names such words, and the names."""
    some, every, all_names = False, True, []
    for name, *values in NAMED.findall(attributes):
        names = [n for v in values for n in v.lower().split() if not ELSEWHERE.match(n)]
        if name.lower() == "role":
            names = ["nav"] if {"navigation", "banner", "contentinfo", "complementary", "search"} & {*names} else []
        some = some or any(not MARKS.isdisjoint(re.split(r"[^a-z0-9]+", n)) for n in names)
        every = every and MARKS.issuperset(names)
        all_names += names
    return some, some and every, " ".join(sorted(all_names))


def blocks(page: str, template: frozenset[int] = frozenset()):
    """(path, aside, inside main, text) of each block, and (path, None, None, None) of each tag.

    In an article, the template tells which elements with a name that has a mark are aside.
    """
    stack: list[tuple[str, bool, bool]] = []  # name, aside, main
    parts: list[str] = []
    at = 0
    where = ("", False, False)

    def path() -> str:
        return "/".join(n for n, _, _ in stack if n in BLOCKS)

    def flush():
        text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        parts.clear()
        return text

    while m := TOKEN.search(page, at):
        parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name in BLOCKS:
            if text := flush():
                yield (*where, text)
        elif name == "br":
            parts.append(" ")
        if m[1]:
            if any(n == name for n, _, _ in stack):
                while stack.pop()[0] != name:
                    pass
        elif name not in VOID and not m[3].rstrip().endswith("/"):
            for other in IMPLIED.get(name, {"p"} if name in BLOCKS else ()):
                # Inline tags left open inside a paragraph end with it.
                inner = [n for n, _, _ in reversed(stack)]
                depth = next((i for i, n in enumerate(inner) if n in BLOCKS), None)
                if depth is not None and inner[depth] == other:
                    del stack[len(stack) - depth - 1 :]
            _, aside, main = stack[-1] if stack else ("", False, False)
            header = name == "header" and not main
            if name in RAW:
                end = ENDS[name].search(page, at)
                at = end.end() if end else len(page)
                continue
            some, every, names = marks_of(m[3]) if name not in UNMARKED and m[3] else (False, False, "")
            if some and main and not every:
                element = f"{path()}|{name}#{names}"
                some = key_of(element, None) in template
                yield element, None, None, None
            aside = aside or header or name in ASIDE or some
            stack.append((name, aside, main or name in MAIN))
        if name in BLOCKS:
            where = (path(), *(stack[-1][1:] if stack else (False, False)))
            yield path() + ("|/" if m[1] else "|") + name, None, None, None
    parts.append(page[at:])
    if text := flush():
        yield (*where, text)


def key_of(path: str, text: str | None) -> int:
    return xxhash.xxh64_intdigest(f"{path}\0{text or ''}") - (1 << 63)


def tokens_of(page: str) -> dict[int, tuple[int, int]]:
    """How often each token stands on a page, and its kind."""
    found: dict[int, tuple[int, int]] = {}
    for path, _, main, text in blocks(page):
        kind = (OPENING if path.endswith(OPENINGS) else AROUND) if text is None else WITHIN if main else AROUND
        key = key_of(path, text)
        found[key] = (found.get(key, (0, kind))[0] + 1, kind)
    return found


def _tokens(batches):
    for batch in batches:
        out: list[tuple] = []
        for row, host, page in zip(*(batch.column(c).to_pylist() for c in ("row", "host", "html"))):
            out += ((row, host, token, n, kind) for token, (n, kind) in tokens_of(page or "").items())
        columns = list(zip(*out)) or [()] * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["row", "host", "token", "n", "kind"])


def templates(pages: DataFrame) -> DataFrame:
    """``host``, ``template``: the tokens of the host's valid classes.

    A host's template is bounded: each token stands on ``SUPPORT`` of the pages.
    """
    host, _ = host_and_path(F.col("url"))
    rows = small_batches(pages).select(F.xxhash64("page_id", "url").alias("row"), host.alias("host"), "html")
    tokens = rows.mapInArrow(_tokens, "row bigint, host string, token bigint, n bigint, kind int")
    # The vector's sum fits a long: 2**31 pages of a host at 2**31 each.
    vector = F.sum(F.xxhash64("row", "n").bitwiseAND((1 << 31) - 1)).alias("vector")
    counted = tokens.groupBy("host", "token", "kind").agg(vector, F.count("*").alias("pages"))
    named = cut(counted.filter(F.col("pages") >= LEAST_PAGES))
    sizes = rows.groupBy(F.col("host").alias("_host")).agg(F.count("*").alias("all_pages"))
    often = named.join(sizes, F.col("host") == F.col("_host")).filter(F.col("pages") >= SUPPORT * F.col("all_pages"))
    tokens_where = lambda c: F.collect_list(F.when(c, F.col("token")))
    classes = often.groupBy("host", "vector", "pages", "all_pages").agg(
        tokens_where(F.col("kind") != WITHIN).alias("tokens"),
        tokens_where(F.col("kind") == WITHIN).alias("within"),
        F.max(F.col("kind") == OPENING).alias("opening"),
    )
    fixed = F.col("opening") & (F.col("pages") == F.col("all_pages")) & (F.col("pages") >= LEAST_FIXED)
    none = F.array().cast("array<bigint>")
    valid = classes.filter(F.size("tokens") >= CLASS_SIZE)
    valid = valid.select("host", F.concat("tokens", F.when(fixed, F.col("within")).otherwise(none)).alias("tokens"))
    return valid.groupBy("host").agg(F.sort_array(F.flatten(F.collect_list("tokens"))).alias("template"))


def main_text(page: str, template: frozenset[int]) -> str:
    """The slots of the article, or those of the body."""
    inside, repeated, outside = [], [], []
    for path, aside, main, text in blocks(page, template):
        if text is None or aside:
            continue
        known = key_of(path, text) in template
        if main:
            (repeated if known else inside).append(text)
        elif not known:
            outside.append(text)
    slots = inside or repeated  # articles that are alike on all pages
    size = lambda texts: sum(map(len, texts))
    return "\n\n".join(slots if slots and size(outside) <= TEASER * size(slots) else outside or slots)


def _extract(batches):
    for batch in batches:
        texts = []
        for page, template in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist()):
            texts.append(main_text(page or "", frozenset(template or ())))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars``."""
    host, _ = host_and_path(F.col("url"))
    known = cut(templates(pages)).withColumnRenamed("host", "_host")
    held = known.agg(F.sum(F.size("template") + 8)).first()[0] or 0
    if held <= BROADCAST_TOKENS:
        known = F.broadcast(known)
    read = small_batches(pages).select(F.col("page_id").cast("bigint").alias("page_id"), "url", host.alias("host"), "html")
    joined = read.join(known, read["host"] == known["_host"], "left").select("page_id", "url", "html", "template")
    return joined.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")


@query()
def op5_html_text(spark, sf):
    return extract(table(spark, sf, "pages"))
