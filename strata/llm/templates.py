"""Main text of web pages, with what a site repeats on its pages removed.

Pages are parsed into elements.  Every block element's subtree (tags and text, not
attributes) is hashed, and Spark counts, per host, on how many different pages it occurs in
its place: below the same path of tags and beside the same neighbour, before or after it
(the beginning and the end of its parent count as one).  Copies of a page count once.  A
subtree on ``min_pages`` pages or more is the site's template, however many pages the host
has, and is deleted wherever it stands in that place on that host.

Subtrees are counted on every page, with an ``article`` or without.  Inside an article only
those are that half or more of consists of links, so menus and not what an author repeats,
and not on different pages but in that many articles that differ in their words outside
links: an article that stands on many pages counts once.

Never taken for a template: an ``article`` or ``main`` and what is around an article; paragraphs, list items
and table cells of both; headings; and a subtree that holds half of its page's (or article's) text or more, if
that is ``LONG`` characters and not, outside an article, mostly links; where such a subtree recurs outside an article,
nothing inside it is a template either.  Elements whose tag, role, class or id says that they are no
article text, and hidden ones, go as well, so that a host's only page is clean too.  Outside
an article a class or id says so by any of its words.  Inside one, and inside ``main``, only
a name whose words are all of that kind does (``share-buttons``, not ``share-price``).  An
``article``, or an element around one, goes by a whole name, and not at all if the page
would be left without an article; ``main``, or an element around it, never.

The text that stays is cut into blocks at block elements; character references are
decoded, white space becomes one space, and blocks are joined by an empty line.

Where a page has ``article`` elements (or else ``main``), its text is theirs.  Defined
results: a null html has no text; a page with a null or odd url has no host, and no template; rows that
repeat a page are each returned; an end of input inside a tag or comment ends the text
there; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import html as entities
import re
from functools import cached_property

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, written

# Fixed values of HTML: elements without content, with raw content, and those that end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp noscript template svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section"
    " summary table tbody tfoot thead tr caption ul".split()
)
CLOSES_P = BLOCKS - frozenset("dd dt li body head html legend option optgroup tbody tfoot thead tr caption".split())
# Fixed values of HTML: an opening tag ends an open one of these, up to the given container.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Words of the author: never taken for a template inside main; headings nowhere.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dt dd li tr td th".split())
# Elements, roles and words of a class or id that mark what is no article text.
NOT_TEXT = frozenset("nav footer aside form script style title textarea iframe noembed noframes noscript template svg math head button select dialog menu object audio video canvas".split())
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
NOT_TEXT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies"
    " consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar"
    " sidenav menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer comment comments respond reply"
    " replies disqus related recommended share sharing social widget toolbar skip".split()
)
# Words that say nothing of their own beside the words above.
WITH_NAMES = frozenset(
    "area bar block body bottom box button buttons container content count form icon icons inner item items left link links"
    " list new outer panel post posts articles right row section site slot small text top unit wrap wrapper".split()
)
#: Whole names that an article's own parts have too.
NOT_ALONE = frozenset("toolbar skip promotion alert".split())
#: Characters from which a subtree with half of the page's text is no template, unless most of it is links.
LONG = 200
#: As above, but only outside an article, whose own header holds its title.
NOT_TEXT_OUTSIDE = frozenset("header masthead topbar".split())
NEVER_TEMPLATE = frozenset("html body article main".split())

_TAG = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|style)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\s(?:hidden)(?=[\s/=]|\Z)""", re.I)
_QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_NAME = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")
_HOST = re.compile(r"^\s*[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _is_noise_name(name: str) -> bool:
    """Whether all words of a class or id are of the kind that marks what is no article text."""
    words = [w for w in _NAME.findall(name) if not w.isdigit()]
    return name not in NOT_ALONE and all(w in NOT_TEXT_NAMES or w in WITH_NAMES for w in words) and not NOT_TEXT_NAMES.isdisjoint(words)


class Page:
    """Elements and texts of a page in page order.

    ``tags``, ``parents`` and ``flags`` are by element; ``parts`` holds texts (element,
    decoded text) and block borders (element, None).
    """

    def __init__(self, source: str):
        self.tags, self.parents, self.inside = ["#"], [-1], [False]
        self.own, self.named, self.whole = [False], [False], [False]  # noise by tag or role; by a word, a whole name of class or id
        self.parts: list[tuple[int, str | None]] = []
        stack, at, end = [0], 0, len(source)
        while at < end:
            found = _TAG.search(source, at)
            text_end = found.start() if found else end
            if text_end > at:
                self.parts.append((stack[-1], entities.unescape(source[at:text_end])))
            if not found:
                break
            at = found.end()
            tag = (found[2] or "").lower()
            if not tag or source[at - 1] != ">":
                continue
            if found[1]:
                self._close(stack, tag)
                continue
            self._open(stack, tag, found[3])
            if tag in VOID:
                self._close(stack, tag)
            elif tag in RAW and not found[3].endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
                at = close.start() if close else end
        self.noise = self._noise()

    def _open(self, stack: list[int], tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            self._end(stack, {"p"}, {"button", "table", "td", "th", "div", "article", "section", "li"} - {tag} if tag == "p" else {"button"})
        if tag in ENDS:
            self._end(stack, *ENDS[tag])
        parent = stack[-1]
        inside = self.inside[parent] or tag in ("article", "main")
        own, named, whole = tag in NOT_TEXT or (tag in NOT_TEXT_OUTSIDE and not inside), False, False
        if not own and attributes and tag not in ("html", "body"):
            own = "hidden" in attributes.lower() and bool(_HIDDEN.search(_QUOTED.sub("= ", attributes)))
            for name, *values in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), "".join(values).lower()
                if name == "style":
                    own = own or bool(_UNSEEN.search(value))
                elif name == "role":
                    marks = NOT_TEXT_ROLES if inside else NOT_TEXT_ROLES | NOT_TEXT_OUTSIDE
                    own = own or not marks.isdisjoint(_NAME.findall(value))
                elif inside and tag not in ("article", "main"):
                    named = named or any(map(_is_noise_name, value.split()))
                    whole = named
                else:
                    marks = NOT_TEXT_NAMES if inside else NOT_TEXT_NAMES | NOT_TEXT_OUTSIDE
                    named = named or not marks.isdisjoint(_NAME.findall(value))
                    whole = whole or not marks.isdisjoint(value.split())
        if tag in BLOCKS:
            self.parts.append((parent, None))
        elif tag in ("br", "td", "th"):
            self.parts.append((parent, " "))
        self.tags.append(tag)
        self.parents.append(parent)
        self.own.append(own)
        self.named.append(named)
        self.whole.append(whole)
        self.inside.append(inside)
        stack.append(len(self.tags) - 1)

    def _noise(self) -> list[bool]:
        """By element, whether it or one around it is marked as no article text."""
        n = len(self.tags)
        article, main = [t == "article" for t in self.tags], [t == "main" for t in self.tags]
        hidden = [False] * n  # by tag or role, which also takes the articles inside
        for i in range(1, n):
            hidden[i] = self.own[i] or hidden[self.parents[i]]
        for i in range(n - 1, 0, -1):  # children come after their parents
            if not hidden[i]:
                article[self.parents[i]] |= article[i]
                main[self.parents[i]] |= main[i]

        def spread(whole_names: bool) -> list[bool]:
            out = [False] * n
            for i in range(1, n):
                named = self.named[i]
                if main[i]:
                    named = False
                elif article[i]:
                    named = self.whole[i] and whole_names
                out[i] = out[self.parents[i]] or self.own[i] or named
            return out

        noise = spread(True)
        if all(noise[i] or self.tags[i] not in ("article", "main") for i in range(n)) and (article[0] or main[0]):
            noise = spread(False)
        return noise

    def _pop(self, stack: list[int], depth: int) -> None:
        while len(stack) > depth:
            element = stack.pop()
            if self.tags[element] in BLOCKS:
                self.parts.append((self.parents[element], None))

    def _end(self, stack: list[int], tags: set[str], until: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[depth]]
            if tag in tags:
                return self._pop(stack, depth)
            if tag in until:
                return None
        return None

    def _close(self, stack: list[int], tag: str) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if self.tags[stack[depth]] == tag:
                return self._pop(stack, depth)
            if self.tags[stack[depth]] in ("td", "th", "table", "article", "main", "body") and tag not in BLOCKS:
                return None  # a stray inline end tag ends nothing outside its cell or article
        return None

    def roots(self) -> list[int]:
        """The elements that the text is in: articles, or else main elements, or else the page."""
        of = lambda tag: [i for i in range(1, len(self.tags)) if self.tags[i] == tag and not self.noise[i]]
        return of("article") or of("main") or [0]

    def subtrees(self) -> tuple[list[list[bytes]], list[bytes]]:
        """By element, the hashes of its texts and children in page order, and a hash of its tag and these."""
        placed = 1
        order: list[list] = [[] for _ in self.tags]
        for element, text in self.parts:
            while placed <= element:
                order[self.parents[placed]].append(placed)
                placed += 1
            if text and (text := _SPACE.sub(" ", text).strip()):
                order[element].append(text)
        for element in range(placed, len(self.tags)):
            order[self.parents[element]].append(element)
        out = [b""] * len(self.tags)
        contents: list[list[bytes]] = [[] for _ in self.tags]
        for element in range(len(self.tags) - 1, -1, -1):  # children come after their parents
            content = [xxhash.xxh3_128_digest(x.encode("utf-8", "replace")) if isinstance(x, str) else out[x] for x in order[element]]
            contents[element] = [x for x in content if x]
            if contents[element]:
                out[element] = xxhash.xxh3_128_digest(self.tags[element].encode("utf-8", "replace") + b"\x00" + b"".join(contents[element]))
        return contents, out

    def lengths(self) -> tuple[list[int], list[int]]:
        """By element, the characters of its subtree, and those of links, without noise."""
        n = len(self.tags)
        all_, links, in_link = [0] * n, [0] * n, [False] * n
        for i in range(1, n):
            in_link[i] = self.tags[i] == "a" or in_link[self.parents[i]]
        for element, text in self.parts:
            if text and not self.noise[element]:
                size = len(_SPACE.sub(" ", text).strip())
                all_[element] += size
                links[element] += size * in_link[element]
        for i in range(n - 1, 0, -1):
            all_[self.parents[i]] += all_[i]
            links[self.parents[i]] += links[i]
        return all_, links

    def articles(self) -> tuple[list[int], list[bool]]:
        """By element, the article that it is in or is (0: none), and whether one lies in it."""
        n = len(self.tags)
        within, around = [0] * n, [False] * n
        for i in range(1, n):
            within[i] = i if self.tags[i] == "article" else within[self.parents[i]]
        for i in range(n - 1, 0, -1):
            if not self.noise[i]:
                around[self.parents[i]] |= around[i] or self.tags[i] == "article"
        return within, around

    def own_words(self) -> dict[int, bytes]:
        """By article, a hash of its texts outside links and noise."""
        within, _ = self.articles()
        in_link, words = [False] * len(self.tags), {}
        for i in range(1, len(self.tags)):
            in_link[i] = self.tags[i] == "a" or in_link[self.parents[i]]
        for element, text in self.parts:
            if text and within[element] and not in_link[element] and not self.noise[element] and (text := _SPACE.sub(" ", text).strip()):
                words.setdefault(within[element], []).append(text)
        return {a: xxhash.xxh3_128_digest("\x00".join(w).encode("utf-8", "replace")) for a, w in words.items()}

    @cached_property
    def candidates(self) -> dict[int, bool]:
        """Block elements that may be template (True) or hold most of the text (False)."""
        all_, links = self.lengths()
        within, around = self.articles()
        total = sum(all_[r] for r in self.roots())
        out = {}
        for i in range(1, len(self.tags)):
            tag = self.tags[i]
            if tag not in BLOCKS or tag in NEVER_TEMPLATE or tag in HEADINGS:
                continue
            if (self.inside[i] and tag in PROSE) or self.noise[self.parents[i]]:
                continue
            article = within[i]
            if article:
                if 0 < all_[i] <= 2 * links[i] and all_[i] < max(LONG, all_[article] / 2):
                    out[i] = True
                continue
            most = all_[i] >= max(LONG, total / 2) and links[i] < all_[i] / 2
            if most or not around[i]:
                out[i] = not most
        return out

    def places(self) -> dict[int, tuple[bytes, tuple[bytes, ...]]]:
        """The candidates' articles (their own words; empty outside one) and keys: its path of tags
        and subtree with what stands before it, and with what follows; of one that holds most of
        the text, path and subtree."""
        wanted = self.candidates
        if not wanted:
            return {}
        contents, hashes = self.subtrees()
        within, _ = self.articles()
        own_words = self.own_words() if any(within[i] for i in wanted) else {}
        paths = [b""] * len(self.tags)
        for i in range(1, len(self.tags)):
            above, tag = paths[self.parents[i]], self.tags[i]
            paths[i] = above if tag in ("html", "body") else xxhash.xxh3_64_digest(above + tag.encode("utf-8", "replace"))
        at: list[int] = [0] * len(self.tags)  # how many of the parent's contents came before
        out = {}
        for i in range(1, len(self.tags)):
            parent = self.parents[i]
            if not hashes[i]:
                continue
            beside = contents[parent]
            while beside[at[parent]] != hashes[i]:
                at[parent] += 1
            place = at[parent]
            at[parent] += 1
            article = own_words.get(within[i], b"no words") if within[i] else b""
            if wanted.get(i) is False:
                out[i] = (article, (b"most" + paths[i] + hashes[i],))
            elif i in wanted:
                before = beside[place - 1] if place else b"first"
                after = beside[place + 1] if place + 1 < len(beside) else b"last"
                out[i] = (article, (paths[i] + hashes[i] + b"<" + before, paths[i] + hashes[i] + b">" + after))
        return out

    def text(self, template: set[int]) -> str:
        """Blocks of the article without the given subtrees, but for those inside one that holds most of the text."""
        kept = {i for i in template if self.candidates.get(i) is False}
        if kept:
            safe = [False] * len(self.tags)
            for i in range(1, len(self.tags)):
                safe[i] = i in kept or safe[self.parents[i]]
            template = {i for i in template if not safe[i]}
        gone = [False] * len(self.tags)
        main = [False] * len(self.tags)
        chosen = set(self.roots())
        blocks, block = [], []
        for i in range(len(self.tags)):
            parent = self.parents[i]
            gone[i] = self.noise[i] or i in template or (parent >= 0 and gone[parent])
            main[i] = i in chosen or (parent >= 0 and main[parent])
        for element, text in self.parts:
            if text is None:
                if block:
                    blocks.append("".join(block))
                    block = []
            elif main[element] and not gone[element]:
                block.append(text)
        blocks.append("".join(block))
        return "\n\n".join(b for b in (_SPACE.sub(" ", b).strip() for b in blocks) if b)


def _column(batch, name):
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def page_subtrees(url: str | None, source: str) -> tuple[Page, dict[bytes, list[tuple[int, bytes]]]]:
    """The page and its candidate subtrees, with their articles, by a key of host, subtree and place."""
    page = Page(source)
    host, keys = host_of(url).encode(), {}
    if host:
        for element, (article, places) in page.places().items():
            for place in places:
                keys.setdefault(xxhash.xxh3_128_digest(place + host), []).append((element, article))
    return page, keys


def _subtree_rows(batch):
    """(seen, subtree) of the different subtrees in their places, and the page or, inside one, the article they are seen in."""
    seen, subtrees = [], []
    for url, source in zip(_column(batch, "url"), _column(batch, "html"), strict=True):
        _, keys = page_subtrees(url, source or "")
        page = xxhash.xxh3_128_digest((source or "").encode("utf-8", "replace"))
        for key, found in keys.items():
            for where in {article or page for _, article in found}:
                seen.append(xxhash.xxh3_64_intdigest(where) - (1 << 63))
                subtrees.append(key)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(subtrees, pa.binary())], names=["seen", "subtree"])


def site_templates(pages: DataFrame, min_pages: int = 5) -> DataFrame:
    """(subtree) keys, of host, subtree and place, that recur on many pages, or in many articles, of their host."""
    rows = mapped(pages.select("url", "html"), _subtree_rows, "seen long, subtree binary").distinct()
    return rows.groupBy("subtree").count().filter(f"count >= {min_pages}").select("subtree")


def _text_batch(batch, templates_of):
    found = []
    for i, (url, source) in enumerate(zip(_column(batch, "url"), _column(batch, "html"), strict=True)):
        page, keys = page_subtrees(url, source or "")
        templates = templates_of(i)
        found.append(page.text({e for k, found_at in keys.items() if k in templates for e, _ in found_at}))
    keep = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url")]
    yield pa.RecordBatch.from_arrays(
        [*keep, pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
        names=["page_id", "url", "text", "n_chars"],
    )


RESULT = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame, min_pages: int = 5, broadcast_rows: int = 200_000) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Templates go to the pages by broadcast up to ``broadcast_rows`` keys of 16 bytes, and
    beyond that by a join on the subtree keys; both ways give the same result.
    """
    spark = pages.sparkSession
    pages = pages.select("page_id", "url", "html")
    templates = written(site_templates(pages, min_pages), "templates")
    if templates.count() <= broadcast_rows:
        keys = spark.sparkContext.broadcast(frozenset(bytes(r[0]) for r in templates.collect()))
        return mapped(pages, lambda batch: _text_batch(batch, lambda _: keys.value), RESULT)

    def page_keys(batch):
        tags, owners, subtrees = _column(batch, "tag"), [], []
        for tag, url, source in zip(tags, _column(batch, "url"), _column(batch, "html"), strict=True):
            _, found = page_subtrees(url, source or "")
            owners += [tag] * len(found)
            subtrees += found
        yield pa.RecordBatch.from_arrays([pa.array(owners, pa.string()), pa.array(subtrees, pa.binary())], names=["tag", "subtree"])

    tag = F.md5(F.concat_ws("\x00", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))).cast("binary"))
    tagged = pages.withColumn("tag", tag)
    held = mapped(tagged, page_keys, "tag string, subtree binary").distinct().join(templates, "subtree")
    per_page = held.groupBy("tag").agg(F.collect_list("subtree").alias("subtrees"))
    joined = tagged.join(per_page, "tag", "left")

    def with_keys(batch):
        own = [frozenset(map(bytes, x or ())) for x in _column(batch, "subtrees")]
        return _text_batch(batch, own.__getitem__)

    return mapped(joined.drop("tag"), with_keys, RESULT)
