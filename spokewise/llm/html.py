"""Main text of web pages by removing what a site's pages share.

Every page is read into a tree of elements, and each element's subtree (its tag, class,
id and text) is hashed. Spark counts, per host, the pages that hold each hash. A subtree
on at least ``SHARE`` of a host's pages, and on ``LEAST_PAGES``, is template and is
deleted. What a page declares as something else than its article (menus, forms,
adverts, comments, ...) goes as well, recurring or not. A form, or an element that only
its class, id or role declares so, stays if it holds the page's article or main.

Inside ``article`` or ``main`` only containers count as template, never single
paragraphs, headings or list items: an article that a site carries many times is still
an article. Without such an element all that is left of the body is the text.

Results for odd input: a NULL, empty or text-less page gives an empty text; an unclosed
element ends with its parent, stray end tags are ignored, an unclosed comment or script
runs to the end; a NULL or malformed address belongs to one common empty host; repeated
pages count each; an empty table gives an empty result; other columns do no harm.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from spokewise.llm.batches import batch_of, extended, map_batches
from spokewise.session import stage

SHARE = 0.5
LEAST_PAGES = 5

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
# A start tag on the left ends an open element on the right, up to the border given.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Elements that are not the article, and words in class, id or role that say so.
OTHER_TAGS = frozenset("aside button canvas dialog footer form head nav object select svg".split())
OTHER_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notices pager pagination popup promo promoted recommended related search share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar widget".split()
)
_MAIN = frozenset(("article", "main"))
_NEVER = frozenset(("html", "body", "article", "main"))
# Inside an article these are its own text, however often it recurs.
_OWN = frozenset(
    "p h1 h2 h3 h4 h5 h6 li blockquote pre td th tr tbody thead tfoot dt dd figcaption figure caption address".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")


class Element:
    __slots__ = ("tag", "names", "parts", "other", "inside_main", "header", "digest", "has_text", "heading", "by_name", "holds")

    def __init__(self, tag: str, names: str, other: bool, inside_main: bool, by_name: bool = False):
        self.tag, self.names, self.other, self.inside_main, self.by_name = tag, names, other, inside_main, by_name
        self.parts: list[str | Element] = []
        self.digest, self.has_text, self.heading, self.holds = b"", False, False, False


def _attributes(text: str) -> tuple[str, bool]:
    """Class, id and role of a tag as one text, and whether they or the tag hide it."""
    if not text or text.isspace():
        return "", False
    names, hidden = [], False
    for name, a, b, c in _ATTRIBUTE.findall(text):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id", "role"):
            names.append(f"{name}={value}")
        elif name == "hidden" or (name == "style" and "display:none" in value.replace(" ", "")):
            hidden = True
    return " ".join(names), hidden


def _says_other(names: str) -> bool:
    return any(word in OTHER_WORDS for word in _WORD.findall(names.replace("class=", " ").replace("id=", " ").replace("role=", " ")))


def parse(page: str, hashed: bool = True) -> Element:
    """The tree of a page. Element parts are texts (decoded) and elements in order."""
    root = Element("html", "", False, False)
    stack = [root]

    def close(count: int) -> None:
        del stack[count:]

    def add_text(piece: str) -> None:
        if piece:
            stack[-1].parts.append(entities.unescape(piece) if "&" in piece else piece)

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        if token is None:
            add_text(page[at:])
            break
        add_text(page[at : token.start()])
        at = token.end()
        tag = token.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if token.group(1):
            crossing = tag not in BLOCKS
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if crossing and stack[k].tag in BLOCKS:
                    break
            if tag == "p" or tag in _HEADINGS:
                stack[-1].parts.append("\n")
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                stack[-1].parts.append(" ")
            continue
        if tag in ("html", "body") and len(stack) > 1 and any(e.tag == tag for e in stack[1:]):
            continue
        if tag == "html":
            continue
        if tag in BLOCKS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in BLOCKS:
                    break
        if tag in _ENDS:
            ended, border = _ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ended:
                    close(k)
                    if tag != "tr" or not any(e.tag == "tr" for e in stack[k - 1 :]):
                        break
                elif stack[k].tag in border:
                    break
        names, hidden = _attributes(token.group(3))
        other = hidden or tag in OTHER_TAGS or (tag not in _NEVER and bool(names) and _says_other(names))
        by_name = other and not hidden and (tag == "form" or tag not in OTHER_TAGS)
        inside = stack[-1].inside_main or stack[-1].tag in _MAIN
        element = Element(tag, names, other, inside, by_name)
        stack[-1].parts.append(element)
        if not token.group(3).rstrip().endswith("/") or tag in BLOCKS or tag in OTHER_TAGS:
            stack.append(element)
    if _finish(root, hashed):
        _open_wrappers(root)
    return root


def _finish(root: Element, hashed: bool) -> bool:
    """Note which subtrees have text or a heading, and hash them, children first, without recursion.

    True if an element that is other by its name holds an article or main.
    """
    order, todo, wrapped = [], [root], False
    while todo:
        element = todo.pop()
        order.append(element)
        todo.extend(p for p in element.parts if isinstance(p, Element))
    for element in reversed(order):
        content = []
        for part in element.parts:
            if isinstance(part, Element):
                content.append(b"\x01" + part.digest)
                element.has_text |= part.has_text
                element.holds |= part.holds or (part.has_text and _is_main(part))
                element.heading |= part.heading or part.tag in _HEADINGS
            elif not part.isspace():
                element.has_text = True
                if hashed:
                    content.append(b"\x02" + " ".join(part.split()).encode("utf-8", "replace"))
        if hashed:
            head = f"{element.tag} {element.names}".encode("utf-8", "replace")
            element.digest = blake2b(head + b"".join(content), digest_size=8).digest()
        # A header in the article that holds its heading is the article's own.
        if element.tag == "header" and not (element.inside_main and element.heading):
            element.other, element.by_name = True, False
        wrapped |= element.by_name and element.holds
    return wrapped


def _is_main(element: Element) -> bool:
    return element.tag in _MAIN or "role=main" in element.names


def _size(element: Element) -> int:
    """Characters of an element's text without what is other in it."""
    size, todo = 0, [element]
    while todo:
        for part in todo.pop().parts:
            if isinstance(part, str):
                size += sum(map(len, part.split()))
            elif not part.other:
                todo.append(part)
    return size


def _has_title(element: Element) -> bool:
    todo = [element]
    while todo:
        element = todo.pop()
        if element.tag == "h1" and element.has_text:
            return True
        todo.extend(p for p in element.parts if isinstance(p, Element) and not p.other)
    return False


def _open_wrappers(root: Element) -> None:
    """Elements around the page's article or main are not other, whatever their names say.

    Boxes of comments or related pages can be made of articles, too. So an article in an
    element that is other by name is the page's own only if it has the page's title, or if
    no article stands elsewhere and the first one has more text than all around it; those
    in elements of the same names follow the first.
    """
    articles: list[tuple[Element, tuple[Element, ...]]] = []
    mains: list[Element] = []
    plain = False
    todo: list[tuple[Element, tuple[Element, ...]]] = [(root, ())]
    while todo:
        element, wrappers = todo.pop()
        if element.other:
            if not (element.by_name and element.holds):
                # One that is the main itself holds no other one.
                if not (element.by_name and element.has_text and _is_main(element)):
                    continue
            wrappers = (*wrappers, element)
        if element.tag == "article" and element.has_text:
            articles.append((element, wrappers))
            plain |= not wrappers
            continue
        if element.has_text and _is_main(element):
            mains.append(element)
            for wrapper in wrappers:
                wrapper.other = False
        if element.holds:
            todo.extend((p, wrappers) for p in reversed(element.parts) if isinstance(p, Element))
    titled = [(a, w) for a, w in articles if w and _has_title(a)]
    for _, wrappers in titled:
        for wrapper in wrappers:
            wrapper.other = False
    if articles and not plain and not titled:
        article, wrappers = articles[0]
        around = sum(map(_size, mains)) if mains else _size(root)
        if all(not w.other for w in wrappers) or _size(article) > around:
            names = [w.names for w in wrappers]
            for _, alike in articles:
                if [w.names for w in alike] == names:
                    for wrapper in alike:
                        wrapper.other = False


def _number(digest: bytes) -> int:
    return int.from_bytes(digest, "little", signed=True)


def _may_be_template(element: Element) -> bool:
    if element.tag in _NEVER or not element.has_text:
        return False
    return element.tag in BLOCKS and element.tag not in _OWN if element.inside_main else True


def template_candidates(page: str) -> set[int]:
    """Hashes of the subtrees that can be template; those deleted anyway are left out."""
    found, todo = set(), [parse(page)]
    while todo:
        element = todo.pop()
        if element.other:
            continue
        if _may_be_template(element):
            found.add(_number(element.digest))
        todo.extend(p for p in element.parts if isinstance(p, Element))
    return found


def main_text(page: str, template: frozenset[int] | set[int] = frozenset()) -> str:
    """Text of the article, block by block, without template subtrees."""
    root = parse(page, bool(template))

    def gone(element: Element) -> bool:
        return element.other or (bool(template) and _may_be_template(element) and _number(element.digest) in template)

    mains: list[Element] = []
    todo = [root]
    while todo:
        element = todo.pop()
        if gone(element):
            continue
        if element.tag == "article" and element.has_text:
            mains.append(element)
            continue
        todo.extend(p for p in reversed(element.parts) if isinstance(p, Element))
    if not mains:
        todo = [root]
        while todo:
            element = todo.pop()
            if gone(element):
                continue
            if (element.tag == "main" or "role=main" in element.names) and element.has_text:
                mains.append(element)
                continue
            todo.extend(p for p in reversed(element.parts) if isinstance(p, Element))
    out: list[str] = []
    work: list[Element | str] = list(reversed(mains or [root]))
    while work:
        part = work.pop()
        if isinstance(part, str):
            out.append(part)
        elif not gone(part):
            border = "\n" if part.tag in BLOCKS else ""
            if border:
                out.append(border)
                work.append(border)
            work.extend(reversed(part.parts))
    return " ".join("".join(out).split())


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def site_templates(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(host, hashes): subtrees that recur across a host's pages.

    At most ``1 / SHARE`` times the subtrees of one page can reach the share, so the
    list of a host is bounded by the size of its pages, not by their number.
    """
    rows = pages.select(host_of(F.col(f"`{url_column}`")), F.col(f"`{html_column}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, hashes = [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = template_candidates(page.as_py() or "")
                hosts.append(host)
                hashes.append(list(own))
            yield batch_of(pa.array(hosts, pa.string()), pa.array(hashes, pa.list_(pa.int64())))

    found = map_batches(rows, run, "host string, hashes array<long>")
    # NULL stands for the page itself, so that one pass counts pages and subtrees.
    each = found.select("host", F.explode(F.concat(F.array(F.lit(None).cast("long")), "hashes")).alias("hash"))
    counts = stage(each.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("pages")), "subtrees")
    hosts = counts.filter("hash is null").select("host", F.col("pages").alias("all_pages"))
    often = counts.filter((F.col("pages") >= LEAST_PAGES) & F.col("hash").isNotNull()).join(hosts, "host")
    often = often.filter(F.col("pages") >= SHARE * F.col("all_pages"))
    return often.groupBy("host").agg(F.collect_list("hash").alias("hashes"))


def extract(
    pages: DataFrame, keep: list[str], url_column: str = "url", html_column: str = "html", name: str = "text"
) -> DataFrame:
    """The columns ``keep`` and the main text of each page."""
    templates = stage(site_templates(pages, url_column, html_column), "templates")
    rows = pages.select(
        *[F.col(f"`{n}`").alias(f"k{i}") for i, n in enumerate(keep)],
        host_of(F.col(f"`{url_column}`")).alias("p_host"),
        F.col(f"`{html_column}`").alias("p_html"),
    )
    # Spark broadcasts the templates if their written size is small, and splits a large host otherwise.
    rows = rows.join(templates, F.col("p_host") == F.col("host"), "left")
    rows = rows.select(*[f"k{i}" for i in range(len(keep))], "p_html", "hashes")
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            known: dict[tuple, frozenset] = {}
            for page, hashes in zip(batch.column(at), batch.column(at + 1)):
                own = tuple(hashes.as_py() or ())
                template = known.setdefault(own, frozenset(own))
                texts.append(main_text(page.as_py() or "", template))
            yield batch_of(*batch.columns[:at], pa.array(texts, pa.string()))

    return map_batches(rows, run, extended([pages.schema[n] for n in keep], **{name: T.StringType()}))
