"""Main text of web pages by a consensus of each host's pages.

Every page scores its containers and votes for the generalised tag-class path of
the best one.  Votes are counted per host and path (partial sums, so a hot host
costs no more than its paths); each page is then read again and its text taken
from the host's strongest path that it has.  Where several containers of a page share
the path, the text is that of the container around all of them, or of them all where
only the body is.

Defined results: null or empty html gives an empty text; a page without a host
shares the empty host; a page that has none of its host's winning paths uses its
own best container; html without tags is one text.  Boilerplate elements are left
out whatever container wins, and headings stay in a header inside an article.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import BROADCAST_ROWS, at_most, written
from . import arrays

#: Share of a host's votes that makes a path one of its winners, so a host has 20 at most.
MIN_SHARE = 0.05

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg math object select canvas".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul video audio".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
WHOLE = set("#page html body".split())
CONTAINERS = set("#page body article main section div td center".split())
#: Elements that are never part of the article.
BOILERPLATE_TAGS = set("head nav footer aside form dialog menu button input label fieldset option".split())
BOILERPLATE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words of class and id names, cut at hyphens, underscores and capitals.  A name marks boilerplate by its head, the last
#: word that says what the element is: `article-comments` and `ad-box` do, `ad-free-content` and `widget-text` do not.
BOILERPLATE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsors sponsored promo promos promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent notice notices popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social comment comments commenter reply replies respond responses feedback discussion discussions disqus "
    "related recommended recommendations teaser teasers widget widgets pagination pager search toolbar skip hidden".split()
)
#: Words that say where or how an element stands, not what it is.
NEUTRAL_NAMES = set(
    "box bar block container wrap wrapper wrapping inner outer area zone region slot unit panel row col column list item items section group holder "
    "button buttons link links icon icons top bottom left right middle center inline fixed sticky small large wide mobile desktop form thread "
    "js id the".split()
)
#: Of these the first word decides: `related-posts`, `sponsored-content`.
BOILERPLATE_FIRST = set("related recommended sponsored promoted sponsor".split())
CONTENT_NAMES = set("content article post entry story main text body page".split())
#: Opening one of these ends an open element of the same family.
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _is_boilerplate(words: list[str]) -> bool:
    """Whether a class or id name, as words, names boilerplate."""
    heads = [w for w in words if w not in NEUTRAL_NAMES]
    return bool(heads) and (heads[-1] in BOILERPLATE_NAMES or heads[0] in BOILERPLATE_FIRST)


_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


class Page:
    """Elements of a page in document order, and its text blocks outside boilerplate."""

    def __init__(self, source: str):
        self.tags, self.parents, self.ends, self.names = ["#page"], [-1], [0], [frozenset()]
        # A path is a number: that of the path around it and one more step.  Memory does not grow with the depth.
        self.paths, self.steps, self._numbers = [0], [(-1, "")], {}
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters inside links
        self._read(source)

    def _read(self, source: str) -> None:
        stack, skipped, in_header, links = [0], 0, 0, 0
        piece: list[str] = []
        linked = 0
        at = 0

        def flush() -> None:
            nonlocal piece, linked
            if piece:
                text = " ".join("".join(piece).split())
                if text:
                    self.blocks.append((owner(), text, linked))
            piece, linked = [], 0

        def owner() -> int:
            for n in reversed(stack):
                if self.tags[n] in BLOCK or n == 0:
                    return n
            return 0

        def close(depth: int) -> None:
            """Close all open elements from position `depth` of the stack on."""
            nonlocal skipped, in_header, links
            for n in reversed(stack[depth:]):
                self.ends[n] = len(self.tags) - 1
                kind = state.pop(n, 0)
                skipped -= kind == 1
                in_header -= kind == 2
                links -= self.tags[n] == "a"
                opened[self.tags[n]] -= 1
            del stack[depth:]

        def last_open(wanted: set[str], stop: set[str]) -> int:
            for d in range(len(stack) - 1, 0, -1):
                tag = self.tags[stack[d]]
                if tag in wanted:
                    return d
                if tag in stop:
                    break
            return -1

        state: dict[int, int] = {}
        opened = Counter()
        raw = None
        for m in _TOKEN.finditer(source):
            if raw is not None:
                if (m[1] or m[4]) and (m[2] or m[5]).lower() == raw:
                    raw, at = None, m.end()
                continue
            if m.start() < at:
                continue
            text = source[at : m.start()]
            at = m.end()
            if text and not skipped and (not in_header or last_open(HEADINGS, {"header"}) > 0):
                text = html.unescape(text) if "&" in text else text
                piece.append(text)
                if links:
                    linked += len(text)
            tag = m[2] or m[5]
            if tag is None:
                continue
            tag = tag.lower()
            attributes = m[3] or m[6] or ""
            if m[1] or m[4]:
                if tag in BLOCK:
                    flush()
                depth = last_open({tag}, set() if tag in BLOCK else BLOCK) if opened[tag] > 0 else -1
                if depth > 0:
                    close(depth)
                continue
            if tag in ("br", "hr"):
                flush()
            if tag in VOID:
                continue
            if tag in RAW:
                if not attributes.rstrip().endswith("/"):
                    raw = tag
                continue
            if tag in BLOCK:
                flush()
                depth = last_open({"p"}, CONTAINERS | {"td", "th", "li", "table", "button"})
                if depth > 0:
                    close(depth)
                if tag in ENDS_SAME:
                    depth = last_open(ENDS_SAME[tag], {"ul", "ol", "dl", "table", "select", "menu"})
                    if depth > 0:
                        close(depth)
            self._open(tag, attributes, stack[-1])
            n = len(self.tags) - 1
            stack.append(n)
            opened[tag] += 1
            links += tag == "a"
            kind = self._kind(n, stack)
            if kind:
                state[n] = kind
                skipped += kind == 1
                in_header += kind == 2
        if raw is None and at < len(source) and not skipped and not in_header:
            text = source[at:]
            piece.append(html.unescape(text) if "&" in text else text)
        flush()
        close(0)

    def _open(self, tag: str, attributes: str, parent: int) -> None:
        names: set[str] = set()
        step = tag
        if attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                value = m[2] or m[3] or m[4] or ""
                kind = m[1].lower()
                if kind == "role":
                    if value.lower() in BOILERPLATE_ROLES:
                        names.add("#role")
                elif kind == "hidden":
                    names.add("#hidden")
                else:
                    for name in value.split():
                        words = [w.lower() for w in _WORD.findall(name)]
                        names.update(words)
                        if _is_boilerplate(words):
                            names.add("#name")
                    if kind == "class" and value.split():
                        step = f"{tag}.{re.sub('[0-9]+', '#', value.split()[0].lower()).replace('>', '')}"
        self.tags.append(tag)
        self.names.append(frozenset(names))
        self.parents.append(parent)
        self.ends.append(len(self.tags) - 1)
        key = self.paths[parent], step
        number = self._numbers.setdefault(key, len(self.steps))
        if number == len(self.steps):
            self.steps.append(key)
        self.paths.append(number)

    def path(self, number: int) -> str:
        """A path in words, from the outermost element on."""
        steps = []
        while number > 0:
            number, step = self.steps[number]
            steps.append(step)
        return ">".join(reversed(steps))

    def number(self, path: str) -> int:
        """The number of a path in words; -1 where the page has no such element."""
        number = 0
        for step in path.split(">"):
            number = self._numbers.get((number, step), -1)
            if number < 0:
                break
        return number

    def _kind(self, n: int, stack: list[int]) -> int:
        """1: boilerplate; 2: a header inside an article, of which headings stay; 0: neither."""
        tag, names = self.tags[n], self.names[n]
        if tag in BOILERPLATE_TAGS or "#role" in names:
            return 1
        if tag in ("html", "body", "main"):
            return int("#hidden" in names)
        if "#hidden" in names:
            return 1
        header = tag == "header" or "header" in names and "#name" in names
        if header and any(self.tags[a] in ("article", "main") for a in stack[:-1]):
            return 2
        return int(bool(header or "#name" in names))

    def scores(self) -> dict[int, float]:
        """Container scores: unlinked text near a container counts in full, further down by halves."""
        out: dict[int, float] = {}
        for n, text, linked in self.blocks:
            weight = max(1.0, len(text) - 2.0 * linked)
            while n >= 0 and weight > 0.05:
                if self.tags[n] in CONTAINERS:
                    out[n] = out.get(n, 0.0) + weight
                    weight /= 2
                n = self.parents[n]
        for n in out:
            if self.tags[n] in ("article", "main"):
                out[n] *= 1.5
            elif self.names[n] & CONTENT_NAMES:
                out[n] *= 1.25
        return out

    def best(self, scores: dict[int, float]) -> int:
        """The best container, or the article around it."""
        if not scores:
            return 0
        top = max(scores, key=lambda n: (scores[n], -n))
        for wanted in ("article", "main"):
            n = top
            while n >= 0:
                if self.tags[n] == wanted:
                    return n
                n = self.parents[n]
        return top

    def region(self, path: int, scores: dict[int, float]) -> list[int]:
        """The container with the path; of several, the element around all of them, or all if that is the body."""
        nodes = sorted(n for n in scores if self.paths[n] == path) or [n for n, p in enumerate(self.paths) if p == path]
        if len(nodes) > 1:
            around = self.parents[nodes[0]]
            while self.ends[around] < nodes[-1]:
                around = self.parents[around]
            if self.tags[around] not in WHOLE:
                return [around]
        return nodes

    def text(self, *nodes: int) -> str:
        """The text of elements, none inside another, in page order."""
        inside = ((bisect_right(nodes, at) - 1, at, t) for at, t, _ in self.blocks)
        return "\n".join(t for i, at, t in inside if i >= 0 and at <= self.ends[nodes[i]])

    def vote(self, scores: dict[int, float]) -> str:
        """The path of the best container, or of the one around all that share it."""
        path = self.paths[self.best(scores)]
        around = self.region(path, scores)[0]
        return self.path(self.paths[around] if around in scores else path)


def _html_values(block: pa.RecordBatch) -> list[str]:
    return [(x or b"").decode("utf-8", "replace") for x in block.column("html").cast(pa.large_binary()).to_pylist()]


def _votes(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in arrays.text_blocks(batch, "html"):
            paths = []
            for source in _html_values(block):
                page = Page(source)
                scores = page.scores()
                paths.append(page.vote(scores) if scores else None)
            yield pa.RecordBatch.from_arrays([block.column("host"), pa.array(paths, pa.string())], names=["host", "path"])


def _texts(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in arrays.text_blocks(batch, "html"):
            out = []
            for source, winners in zip(_html_values(block), block.column("winners").to_pylist()):
                page = Page(source)
                scores = page.scores()
                own = {page.paths[n] for n in scores}
                path = next((w for w in map(page.number, winners or ()) if w in own), page.paths[page.best(scores)])
                out.append(page.text(*page.region(path, scores)))
            kept = [c for c in block.schema.names if c not in ("html", "winners")]
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in kept), pa.array(out, pa.string())], names=[*kept, "text"])


def host_paths(pages: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, winners): each host's paths with at least `min_share` of its votes, the strongest first."""
    votes = pages.mapInArrow(_votes, "host string, path string").where("path IS NOT NULL").groupBy("host", "path").agg(F.count("*").alias("votes"))
    totals = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    strong = votes.join(totals, "host").where(F.col("votes") >= F.lit(min_share) * F.col("total"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("rank"), "path")))
    return strong.groupBy("host").agg(F.transform(ranked, lambda r: r["path"]).alias("winners"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url_col}`"), _HOST, 1)), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), host.alias("host"), F.col(f"`{html_col}`").alias("html"))
    winners = written(host_paths(rows.select("host", "html")), "host-paths")
    if at_most(winners, BROADCAST_ROWS // 10):  # a few short paths a host
        winners = F.broadcast(winners)
    joined = rows.join(winners, "host", "left").select("page_id", "url", "html", "winners")
    schema = T.StructType([joined.schema["page_id"], joined.schema["url"], T.StructField("text", T.StringType())])
    return joined.mapInArrow(_texts, schema).withColumn("n_chars", F.char_length("text").cast("long"))
