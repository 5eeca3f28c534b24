"""Main text of web pages by site template removal.

Every page is read into elements. The subtree of each candidate element (containers anywhere, text elements directly in
the body) is hashed from its place, which is the path of elements down to it, its tags, classes and text. Spark counts on
how many different pages of a host each subtree occurs, pages with the same main text being one; those on many pages are
the site's template and are deleted first, with all text in them. A headline or paragraph among others in a container is
no candidate, so text that several pages quote stays where unique text is around it. Elements that are boilerplate by their
meaning (menus, headers, footers, sidebars, notices, adverts, forms, comments) then go on every host, as a host
may have too few pages for anything to recur, and an advert may be another on every page; `lists=False` leaves that step
out. What is left of the article, else of the main element, else of the body, is the text: one line per block.

A class name, id or role counts as a whole, and never drops an article, the main element or what holds them. An article in
an element so named stays beside the other text of its main element or body, unless an article elsewhere is the page's
main part; one among comments goes with them.

Only (page, host, hash) rows are shuffled; a page is moved only where the lists of templates on pages are too large for a
size-checked broadcast. A page of any length and depth is read in time that grows with its length.

Defined cases: null or empty html has empty text; a null url belongs to the host ''; unclosed and misnested elements end
with their parent; unclosed comments, scripts and styles end with the page; rows that repeat an id are extracted each;
only page_id, url and html are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesframe.llm.text import slices
from seriesframe.llm.work import stage

#: A subtree is template when it is on so many different pages of its host, however many the host has.
LEAST_PAGES = 10

# Element names by role, and the words that mark boilerplate in class, id and role attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
NO_TEXT = frozenset(
    "audio canvas head iframe map noscript object script select style svg template textarea title video".split()
)
BOILERPLATE = frozenset("aside button dialog footer form menu nav".split())
CONTAINERS = frozenset(
    "aside center details dialog div dl fieldset figure footer form header menu nav ol section table ul".split()
)
TEXT_BLOCKS = frozenset(
    "address blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 hr legend li p pre summary tr".split()
)
BLOCKS = CONTAINERS | TEXT_BLOCKS | {"article", "body", "html", "main", "tbody", "thead", "tfoot"}
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disqus footer gdpr menu modal nav navbar navigation newsletter notice notices popup promo promoted related search"
    " share sharing sidebar social sponsor sponsored subscribe toolbar widget contentinfo complementary".split()
)
MARKED_OUTSIDE = frozenset("header masthead alert".split())
#: Words that may stand beside a marked one in a name: post-comments is boilerplate, but with-sidebar and ad-free are not.
PLAIN = frozenset(
    "area articles block box button buttons container div entry form gpt google icons inner links list page post posts"
    " section site slot stories title user wrap wrapper".split()
)
#: Articles in an element of these are comments.
COMMENTS = frozenset("comment comments disqus".split())
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
    "p": BLOCKS - {"tbody", "thead", "tfoot", "tr", "caption"},
}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_CUT_OFF = re.compile(r"<!--.*\Z|<[!?].*\Z", re.S)
_MARKS = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")
_PARTS = re.compile(r"[^a-z0-9]+")


def marked(name: str, words: frozenset[str]) -> bool:
    """Whether a whole class name, id or role tells boilerplate: words of boilerplate, with nothing but plain words of layout."""
    parts = [p for p in _PARTS.split(name) if p and p.isalpha()]
    return any(p in words for p in parts) and all(p in words or p in MARKED or p in PLAIN for p in parts)


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


class _Element:
    """gone: 0 not, 1 by a class name, 2 by its tag or as comments, 3 never text; kept: in an article that a class name
    would drop; path: hash of the elements down to it; top: none of them but the body."""

    __slots__ = ("tag", "gone", "place", "kept", "parts", "number", "path", "top", "holds_main")

    def __init__(self, tag: str, gone: int, place: int, kept: bool, parts: list[str] | None, number: int, path: int, top: bool):
        self.tag, self.gone, self.place, self.kept, self.parts, self.number = tag, gone, place, kept, parts, number
        self.path, self.top, self.holds_main = path, top, False


class Page:
    """blocks: (text, place, number of the nearest candidate element around it, or -1); hashes and above (the candidate
    around it, or -1): by candidate number, a hash being None for what holds the main text; listed: the nearest candidates
    around text in boilerplate elements, whose blocks are left out.

    Places: 2 in an article, 1 in the main element, 0 elsewhere. Without `lists` only what is never text is left out, and
    an article or main element is like any other.
    """

    def __init__(self, source: str, lists: bool = True):
        self._lists = lists
        self.listed: set[int] = set()
        self.blocks: list[tuple[str, int, int]] = []
        self.hashes: list[int | None] = []
        self.above: list[int] = []
        self.place = 0
        self._open = [_Element("", 0, 0, False, None, -1, 0, True)]
        self._around, self._parts = [-1], []  # numbers and hashed parts of the open candidates
        self._text: list[str] = []
        self._read(source)
        self._flush()
        while len(self._open) > 1:
            self._close()

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        last = source.rfind(">")  # behind it only a comment or declaration can begin
        while at < size:
            found = (_TOKEN if at <= last else _CUT_OFF).search(source, at)
            if found is None:
                self._add(source[at:])
                return
            if found.start() > at:
                self._add(source[at : found.start()])
            at = found.end()
            if found.re is _CUT_OFF:
                continue
            slash, tag, attributes = found.group(1, 2, 3) if found[2] else found.group(4, 5, 6)
            if not tag:
                continue
            tag = tag.lower()
            if slash:
                self._end(tag)
            else:
                self._start(tag, attributes)
                if tag in RAW:
                    close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                    at = close.start() if close else size

    def _add(self, raw: str) -> None:
        gone = self._open[-1].gone
        if gone == 3:  # scripts may name the page, and are no part of a subtree's text
            return
        if not gone:
            self._text.append(raw)
        words = raw.split()
        if words:
            if gone:
                self.listed.add(self._around[-1])
            self._note(" ".join(words))

    def _note(self, part: str) -> None:
        """Add to the hash of the nearest candidate; its own hash goes to the next one when it closes."""
        if self._parts:
            self._parts[-1].append(part)

    def _start(self, tag: str, attributes: str) -> None:
        ends = [t for t, closers in CLOSED_BY.items() if tag in closers]
        for t in ends:
            self._end(t, implied=True)
        above = self._open[-1]
        if tag in BLOCKS:
            self._flush()
        elif tag in ("br", "td", "th") and not above.gone:
            self._text.append(" ")
        names = frozenset(n for m in _MARKS.findall(attributes) for n in m.strip("\"'").lower().split()) if attributes else frozenset()
        words = frozenset(w for n in names for w in _WORD.findall(n))
        name = f"<{tag} {' '.join(sorted(words))}>" if words else f"<{tag}>"
        self._note(name)
        if tag in VOID:
            return
        inside = above.place > 0 or above.kept
        gone = above.gone
        if tag in NO_TEXT:
            gone = 3
        elif not self._lists:
            pass
        elif tag in BOILERPLATE or (tag == "header" and not inside):
            gone = max(gone, 2)
        elif tag not in ("html", "body", "article", "main"):
            if any(marked(n, MARKED) or (not inside and marked(n, MARKED_OUTSIDE)) for n in names):
                gone = max(gone, 2 if any(not COMMENTS.isdisjoint(_PARTS.split(n)) and marked(n, MARKED) for n in names) else 1)
        place, kept = above.place, above.kept
        if tag == "main" and gone < 2:
            gone, kept = 0, False
        elif tag == "article" and gone == 1 and place < 2:
            gone, kept = 0, True
        if self._lists and tag in ("article", "main") and not gone and not kept:
            place = max(place, 2 if tag == "article" else 1)
            self.place = max(self.place, place)
            for element in reversed(self._open):
                if element.holds_main:
                    break
                element.holds_main = True
        candidate = tag in CONTAINERS or (tag in TEXT_BLOCKS and above.top)
        path = xxhash.xxh3_64_intdigest(f"{above.path:x}{name}".encode("utf-8", "replace"))
        top = above.top and tag in ("html", "body")
        number = -1
        if candidate:
            number = len(self.hashes)
            self.hashes.append(None)
            self.above.append(self._around[-1])
            self._around.append(number)
            self._parts.append([tag])
        self._open.append(_Element(tag, gone, place, kept, self._parts[-1] if candidate else None, number, path, top))

    def _end(self, tag: str, implied: bool = False) -> None:
        block = tag in BLOCKS or tag in CLOSED_BY
        for depth in range(len(self._open) - 1, 0, -1):
            other = self._open[depth].tag
            if other == tag:
                break
            if implied and other in CONTAINERS | {"article", "main", "body", "td", "th"} or not block and other in BLOCKS:
                return
        else:
            return
        if tag in BLOCKS:
            self._flush()
        while len(self._open) > depth:
            self._close()

    def _close(self) -> None:
        if self._open[-1].tag in BLOCKS:
            self._flush()
        element = self._open.pop()
        if element.parts is not None:
            self._around.pop()
            self._parts.pop()
            digest = xxhash.xxh3_64_intdigest("\x00".join(element.parts).encode("utf-8", "replace"))
            if not element.holds_main:
                self.hashes[element.number] = _signed(xxhash.xxh3_64_intdigest(f"{element.path:x} {digest:x}"))
            self._note(f"{digest:x}")

    def _flush(self) -> None:
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            self._text = []
            if text:
                self.blocks.append((text, self._open[-1].place, self._around[-1]))

    def main(self) -> list[tuple[str, int]]:
        """Text and nearest candidate of the blocks of the page's main part."""
        return [(text, around) for text, place, around in self.blocks if place == self.place]

    def around_text(self) -> set[int]:
        """Hashes of the candidates around any text, but for what is left out by its place alone."""
        seen: set[int] = set()
        for number in [*(n for _, n in self.main()), *self.listed]:
            while number >= 0 and number not in seen:
                seen.add(number)
                number = self.above[number]
        return {h for n in seen if (h := self.hashes[n]) is not None}

    def without(self, template: frozenset[int] | set[int]) -> tuple[str, int]:
        """The main part's blocks, but for those in a template's subtree, and the number of such subtrees that are in no
        other one."""
        dead: list[bool] = []
        n = 0
        for digest, above in zip(self.hashes, self.above):
            inside = above >= 0 and dead[above]
            n += not inside and digest in template
            dead.append(inside or digest in template)
        return "\n".join(text for text, number in self.main() if number < 0 or not dead[number]), n

    def text(self) -> str:
        return self.without(frozenset())[0]


_PARSED = "key long, key2 long, host string, content long, hashes array<long>, matter array<long>"


def parse(pages: DataFrame, lists: bool = True) -> DataFrame:
    """One row per page: its host, hashes of its main text and of its subtrees, and of those with text to delete or keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, _, _ in slices(batch.column(3)):
                part = batch.slice(low, high - low)
                content, hashes, matter = [], [], []
                for source in part.column(3).to_pylist():
                    page = Page(source, lists)
                    content.append(_signed(xxhash.xxh3_64_intdigest(page.text().encode("utf-8", "replace"))))
                    hashes.append(list({h for h in page.hashes if h is not None}))
                    matter.append(list(page.around_text()))
                yield pa.RecordBatch.from_arrays(
                    part.columns[:3] + [pa.array(content, pa.int64())] + [pa.array(x, pa.list_(pa.int64())) for x in (hashes, matter)],
                    names=["key", "key2", "host", "content", "hashes", "matter"],
                )

    return pages.select("key", "key2", "host", "html").mapInArrow(run, _PARSED)


def without_templates(pages: DataFrame, lists: bool = True) -> DataFrame:
    """page_id, url, text and n_template of (page_id, url, html, template) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, _, _ in slices(batch.column(2)):
                part = batch.slice(low, high - low)
                pairs = zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)
                texts, counts = zip(*(Page(source, lists).without(set(template or ())) for source, template in pairs))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                    names=["page_id", "url", "text", "n_template"],
                )

    return pages.select("page_id", "url", "html", "template").mapInArrow(
        run, "page_id long, url string, text string, n_template long"
    )


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, lists: bool = True) -> DataFrame:
    """page_id, url and text of every page, and n_template: the subtrees deleted from it as its site's template."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1))
    source = pages.select(
        F.xxhash64("page_id", "url", "html").alias("key"),
        F.xxhash64(F.lit("second"), "html", "url", "page_id").alias("key2"),
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        host.alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    subtrees = stage(
        parse(source, lists).select(
            "key", "key2", "host", "content", F.explode("hashes").alias("hash"), F.array_contains("matter", F.col("hash")).alias("matters")
        ),
        "subtrees",
    )
    templates = (
        subtrees.groupBy("host", "hash")
        .agg(F.countDistinct("content").alias("n"))
        .filter(F.col("n") >= least_pages)
        .select("host", "hash")
    )
    hits = stage(
        subtrees.filter("matters")
        .join(templates, ["host", "hash"])
        .groupBy("key", "key2")
        .agg(F.collect_set("hash").alias("template")),
        "template-hits",
    )
    return without_templates(source.join(hits, ["key", "key2"], "left"), lists)
