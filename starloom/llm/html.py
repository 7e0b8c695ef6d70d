"""Main-text extraction by container paths that the pages of a host agree on.

A page is read tag by tag into containers and blocks of text.  A container's
path is its chain of tags and classes from the body down, with digits in
classes replaced, so pages of one template share it.  Each page scores its
containers by the text they hold directly or a little deeper, less what is
linked, and gives each path its share of the page's score.  The shares are
added up by host and the best path wins.  It is left for the container around
it while that adds plain text on at least half of the host's pages; an
``article`` or ``main``, or a path whose next container adds nothing, is left only for a
headline (``h1``) it does not have.  Every page's text is taken from its containers of the
path found.  A page without such a container uses its own best; without any
that has more plain than linked text, all its blocks that are not noise.

Left out are menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments, known by their tag, role, class or id.
A form, header or aside that holds more than half of the page's plain text
stays, as some pages are wrapped in one, unless there is an ``article`` or ``main`` with
text beside it; a header inside an article is a part of it.
Of classes and ids only those of blocks count, not those of inline tags, and an
element that holds more than half of the page's plain (not linked) text is not
left out by one, unless it is marked by a whole class or id and lies beside an
``article`` or ``main`` with text, or holds reader comments and a tenth of the
text is something else.
A word that is only a part of a class or id (``post-sidebar``) leaves out what is
linked by half or more, or holds, together with the other elements of that
word, less than ``SMALL`` of the plain text.  The winning container stays on
every page, whatever marks it.
Character references are decoded, white space inside a block becomes one space,
and blocks are joined by one line feed.  Inline tags do not part words; ``br``
is white space.

A null or empty html has the empty text, as has a page without text.  A null
url is a host of its own.  Repeated rows give a row each and vote each.  An
empty table gives none; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.arrow import send_code
from starloom.operators.joins import fits_broadcast
from starloom.session import stage_table

#: Tags whose content is not text, up to their end tag.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object", "canvas")

#: Tags without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: Tags that hold no main text, and those of them that some pages put around it.
NOISE_TAGS = frozenset("nav header footer aside form button select menu dialog head".split())
WRAPPERS = frozenset("header aside form".split())

NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())

#: Words in a class or id of containers that hold no main text.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead topbar footer copyright "
    "sidebar aside widget widgets related recommended recommendations teaser share sharing social follow "
    "notice notices cookie cookies consent gdpr alert newsletter subscribe subscription signup login "
    "comment comments disqus respond replies reply form search toolbar skip".split()
)

#: Words of reader comments.
COMMENT_WORDS = frozenset("comment comments disqus respond replies reply".split())

#: Elements marked by a word inside a class are noise below this share of the page's plain text.
SMALL = 0.25

#: Reader comments are noise where at least this share of the page's plain text is something else.
OTHER = 0.1

#: Tags that begin and end a block of text.
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html "
    "legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
) | NOISE_TAGS

#: Sections and cells are parts of the container around them.
CONTAINERS = frozenset("body article main div center".split())

#: How much more a container counts that says it is the main one.
BONUS = {"article": 3.0, "main": 3.0}

#: A start tag ends these open tags, as far as the last of the second list.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}

#: A longer path goes on from a digest of itself; such a container is not left for the one around it.
LONG_PATH = 4_096

#: Share of a block's score that goes to its container, the next one, and so on.
FALL = (1.0, 0.5, 0.25)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)",
    re.S,
)
_STOP = re.compile(r"[>\"']")
#: One attribute: its name ends at white space, a slash or "="; what follows "=" is its value, whatever it holds.
_ATTRIBUTE = re.compile(r"(=?[^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_READ = frozenset(("class", "id", "role", "hidden"))
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: A class that says what the element is next to, not what it is.
_STATE = re.compile(r"(?:has|no|with|without)[-_]", re.I)


def _tag(path: str) -> str:
    """The tag of a path's container."""
    return path.rpartition(">")[2].split(".")[0].split("#")[0]


@dataclass
class _Open:
    """An open tag."""

    name: str
    path: int  # of the container it is in, or is
    noise: bool
    link: bool
    mark: int  # of the marked element it is in, or is, -1 for none
    title: bool  # whether it is in a h1, or is
    article: bool  # whether it is in an article, or is


@dataclass
class _Mark:
    """An element whose class or id has words of noise."""

    above: int  # the marked element around it, -1 for none
    whole: frozenset[str]  # words that are a class or the id
    parts: frozenset[str]  # words inside one
    at: int  # the container it is in, or is
    wraps: bool = False  # marked by its tag
    plain: int = 0  # characters that are not linked
    linked: int = 0


@dataclass
class Page:
    """A page's containers, as paths, and its blocks with the containers around them.

    Blocks of marked elements are kept; ``judge`` says which marks are noise.
    """

    paths: list[str] = field(default_factory=list)
    above: list[int] = field(default_factory=list)  # the container around a container, -1 for none
    marked: list[int] = field(default_factory=list)  # the innermost mark at or around a container
    marks: list[_Mark] = field(default_factory=list)
    noise: list[bool] = field(default_factory=list)  # whether a mark is noise
    blocks: list[tuple[str, int, int, int]] = field(default_factory=list)  # text, container, linked characters, mark
    titles: set[int] = field(default_factory=set)  # blocks that are a h1

    def judge(self) -> None:
        """Which marks are noise, by what they hold of the page."""
        if any(mark.wraps for mark in self.marks):
            self._judge_tags()
        total = 0
        for text, _, linked, mark in self.blocks:
            plain = max(len(text) - linked, 0)
            total += plain
            if mark >= 0:
                self.marks[mark].plain += plain
                self.marks[mark].linked += min(linked, len(text))
        for mark in reversed(self.marks):  # a mark comes after the one around it
            if mark.above >= 0:
                self.marks[mark.above].plain += mark.plain
                self.marks[mark.above].linked += mark.linked
        whole = self._together([m.whole for m in self.marks], [m.plain for m in self.marks])
        either = self._together([m.whole | m.parts for m in self.marks], [m.plain for m in self.marks])
        comments = sum(
            m.plain for m, n in zip(self.marks, self._outer([bool(m.whole & COMMENT_WORDS) for m in self.marks])) if n
        )
        many = total - comments >= OTHER * total
        self.noise = []
        for mark, by_whole, by_any in zip(self.marks, whole, either):
            if mark.wraps:
                self.noise.append(False)  # what is left of them stays
            elif many and mark.whole & COMMENT_WORDS:
                self.noise.append(True)
            elif 2 * mark.plain > total:
                self.noise.append(bool(mark.whole) and self._beside_main(len(self.noise)))
            else:
                self.noise.append(
                    mark.linked >= mark.plain or any(2 * n <= total for n in by_whole.values())
                    or any(by_any[w] < SMALL * total for w in mark.parts)
                )

    def _judge_tags(self) -> None:
        """Leave out the blocks of forms, headers and asides that are noise, unless no text would be left."""
        total, plain = 0, [0] * len(self.marks)
        for text, _, linked, mark in self.blocks:
            n = max(len(text) - linked, 0)
            total += n
            if mark >= 0:
                plain[mark] += n
        for i in range(len(self.marks) - 1, -1, -1):
            if self.marks[i].above >= 0:
                plain[self.marks[i].above] += plain[i]
        out: list[bool] = []  # in or around which there is one
        for i, mark in enumerate(self.marks):
            inside = mark.above >= 0 and out[mark.above]
            out.append(inside or mark.wraps and (2 * plain[i] <= total or self._beside_main(i)))
        left = [i for i, (*_, mark) in enumerate(self.blocks) if mark < 0 or not out[mark]]
        if left:
            self.titles = {new for new, old in enumerate(left) if old in self.titles}
            self.blocks = [self.blocks[i] for i in left]

    def _beside_main(self, mark: int) -> bool:
        """Whether text of an article or main lies neither in nor around a mark that is none itself."""
        at, around = self.marks[mark].at, set()
        if at >= 0 and self.marked[at] == mark and _tag(self.paths[at]) in BONUS:
            return False
        while at >= 0:
            around.add(at)
            at = self.above[at]
        for text, at, linked, inner in self.blocks:
            while inner > mark:
                inner = self.marks[inner].above
            if inner == mark or linked >= len(text):
                continue
            while at >= 0:
                if at not in around and _tag(self.paths[at]) in BONUS:
                    return True
                at = self.above[at]
        return False

    def _outer(self, chosen: list[bool]) -> list[bool]:
        """Which chosen marks have no chosen one around them."""
        inside: list[bool] = []
        for mark in self.marks:
            inside.append(mark.above >= 0 and (inside[mark.above] or chosen[mark.above]))
        return [c and not i for c, i in zip(chosen, inside)]

    def _together(self, words: list[frozenset[str]], plain: list[int]) -> list[dict[str, int]]:
        """For each mark and word: what all marks of the word hold, those around it not counted as a whole."""
        near: list[dict[str, int]] = []  # the next mark around of each word
        held: dict[tuple[int, str], int] = {}  # by that mark and the word
        for i, mark in enumerate(self.marks):
            up = near[mark.above] | dict.fromkeys(words[mark.above], mark.above) if mark.above >= 0 else {}
            near.append(up)
            for w in words[i]:
                key = up.get(w, -1), w
                held[key] = held.get(key, 0) + plain[i]
        found: list[dict[str, int]] = []
        for i in range(len(self.marks)):
            found.append({})
            for w in words[i]:
                up = near[i].get(w, -1)
                found[i][w] = held[up, w] + (found[up][w] - plain[up] if up >= 0 else 0)
        return found

    def kept(self, mark: int, top: int = -1) -> bool:
        """Whether no mark from ``mark`` out to ``top`` (left out) is noise."""
        while mark > top:
            if self.noise[mark]:
                return False
            mark = self.marks[mark].above
        return True

    def scores(self) -> dict[str, float]:
        """The score of each path on this page."""
        total: dict[str, float] = {}
        for text, at, linked, mark in self.blocks:
            if not self.kept(mark):
                continue
            plain = max(len(text) - 2 * linked, 0)
            for share in FALL:
                if at < 0:
                    break
                path = self.paths[at]
                bonus = BONUS.get(_tag(path), 1.0)
                total[path] = total.get(path, 0.0) + plain * share * bonus
                at = self.above[at]
        return {path: score for path, score in total.items() if score > 0}

    def climbs(self) -> dict[str, bool]:
        """For each path that holds plain text, whether the container around it is to be taken in its place.

        It is if it adds plain text; around article and main, and beyond
        containers that add nothing, only for the page's headline.
        """
        plain, titled = [0] * len(self.paths), [0] * len(self.paths)
        for i, (text, at, linked, mark) in enumerate(self.blocks):
            if at >= 0 and 2 * linked < len(text) and self.kept(mark):
                plain[at] += len(text) - linked
                titled[at] += i in self.titles
        for i in range(len(self.paths) - 1, -1, -1):
            if self.above[i] >= 0:
                plain[self.above[i]] += plain[i]
                titled[self.above[i]] += titled[i]
        held: dict[str, list[int]] = {}  # plain text, headlines
        outer: dict[str, str] = {}
        for path, above, n, h in zip(self.paths, self.above, plain, titled):
            if above >= 0 and path.startswith(self.paths[above] + ">"):
                outer[path] = self.paths[above]
            if n:
                sums = held.setdefault(path, [0, 0])
                sums[0] += n
                sums[1] += h
        found: dict[str, bool] = {}
        for path, (n, h) in held.items():
            top, adds = path, path in outer and _tag(path) not in BONUS and held[outer[path]][0] > n
            while not adds and not h and top in outer:
                top = outer[top]
                adds = held[top][1] > 0
            found[path] = adds
        return found

    def best(self) -> str | None:
        """The path this page would choose by itself; None without a positive score."""
        scores = self.scores()
        if not scores:
            return None
        path, climbs = min(scores, key=lambda p: (-scores[p], p)), self.climbs()
        while climbs.get(path):
            path = path.rpartition(">")[0]
        return path

    def whole(self) -> str:
        """All blocks that are not noise."""
        return "\n".join(text for text, _, _, mark in self.blocks if self.kept(mark))

    def text(self, path: str | None) -> str | None:
        """The blocks inside the containers of ``path``; None if there is no such container.

        The path was chosen, so marks at or around such a container do not count.
        """
        inside: list[int] = []  # -2 if not inside, else the mark of the container of the path
        for own, above, mark in zip(self.paths, self.above, self.marked):  # a container comes after the one around it
            inside.append(mark if own == path else inside[above] if above >= 0 else -2)
        if all(top == -2 for top in inside):
            return None
        return "\n".join(
            text for text, at, _, mark in self.blocks if at >= 0 and inside[at] > -2 and self.kept(mark, inside[at])
        )


def _attributes(rest: str) -> dict[str, str]:
    """class, id, role and hidden of a tag; of one given twice the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest) if rest else ():
        if (name := m[1].lower()) in _READ:
            found.setdefault(name, html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _noise(name: str, attributes: dict[str, str]) -> bool:
    return name in NOISE_TAGS - WRAPPERS or "hidden" in attributes or attributes.get("role", "").lower() in NOISE_ROLES


def _words(name: str, attributes: dict[str, str]) -> tuple[frozenset[str], frozenset[str]]:
    """Words of noise that are a class or the id of a block, and those inside one."""
    if name not in BLOCKS or name in ("body", "html"):
        return frozenset(), frozenset()
    classes = attributes.get("class", "").split()
    whole = NOISE_WORDS.intersection(c.lower() for c in classes)
    if name in ("article", "main"):  # such a tag is told by whole classes
        return whole, frozenset()
    names = [*classes, *attributes.get("id", "").split()]
    whole = NOISE_WORDS.intersection(c.lower() for c in names)
    parts = NOISE_WORDS.intersection(w.lower() for c in names if not _STATE.match(c) for w in _WORD.findall(c))
    return whole, parts - whole


class _Tags:
    """Finds where tags end.  A quote that is never closed does not count, and is looked for once."""

    def __init__(self, source: str):
        self.source = source
        self.open: set[str] = set()

    def end(self, at: int) -> tuple[int, int]:
        """(end of the attributes, end of the tag) of a tag whose name ends at ``at``."""
        while stop := _STOP.search(self.source, at):
            at = stop.end()
            if stop[0] == ">":
                return at - 1, at
            if stop[0] not in self.open:
                close = self.source.find(stop[0], at)
                if close < 0:
                    self.open.add(stop[0])
                else:
                    at = close + 1
        return len(self.source), len(self.source)


def parse(source: str) -> Page:
    page, stack, at, size = Page(), [], 0, len(source)
    tags = _Tags(source)
    pieces: list[str] = []
    linked = 0

    def close_block() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            if stack and stack[-1].title:
                page.titles.add(len(page.blocks))
            page.blocks.append((text, stack[-1].path if stack else root(), linked, stack[-1].mark if stack else -1))
        linked = 0

    def root() -> int:
        """The container of text outside of any."""
        if not page.paths:
            page.paths.append("body")
            page.above.append(-1)
            page.marked.append(-1)
        return 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not (stack and stack[-1].noise):
            raw = html.unescape(raw) if "&" in raw else raw
            pieces.append(raw)
            if stack and stack[-1].link:
                linked += len(raw)

    def pop(index: int) -> None:
        """Close the tags from ``index`` on."""
        if any(x.name in BLOCKS for x in stack[index:]):
            close_block()
        del stack[index:]

    for token in iter(lambda: _TOKEN.search(source, at), None):
        add(source[at : token.start()])
        at = token.end()
        name = token["name"]
        if name is None:
            if token["cdata"]:
                add(token["cdata"].replace("&", "&amp;"))
            continue
        name = name.lower()
        begin = at
        stop, at = tags.end(begin)
        if token["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    pop(i)
                    break
                if name not in BLOCKS and stack[i].name in BLOCKS:  # an inline end tag closes no block
                    break
            else:
                if name == "p":
                    close_block()
            continue
        rest = source[begin:stop]
        if name in RAW:
            if not rest.rstrip().endswith("/"):
                end = _RAW_END[name].search(source, at)
                at = end.end() if end else size
            continue
        if name == "br":
            if not (stack and stack[-1].noise):
                pieces.append(" ")
            continue
        if name in BLOCKS:
            # a paragraph ends where a block begins
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == "p":
                    pop(i)
                    break
                if stack[i].name in BLOCKS:
                    break
        if name in IMPLIED:
            ends, until = IMPLIED[name]
            last = None
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name in until:
                    break
                if stack[i].name in ends:
                    last = i
            if last is not None:
                pop(last)
        if name in BLOCKS:
            close_block()
        if name in VOID:
            continue
        attributes = _attributes(rest)
        outer = stack[-1] if stack else None
        noise = bool(outer and outer.noise) or _noise(name, attributes)
        path = outer.path if outer else (0 if page.paths else -1)
        if path < 0 and name not in ("html", "head", "body"):
            path = root()  # a page need not say where its body begins
        mark = outer.mark if outer else -1
        article = bool(outer and outer.article) or name == "article"
        if name in WRAPPERS and not noise and not (name == "header" and article):
            page.marks.append(_Mark(mark, frozenset(), frozenset(), path, wraps=True))
            mark = len(page.marks) - 1
        whole, parts = _words(name, attributes) if attributes and not noise else ((), ())
        if whole or parts:
            # its container comes next, if it is one
            page.marks.append(_Mark(mark, whole, parts, len(page.paths) if name in CONTAINERS else path))
            mark = len(page.marks) - 1
        if name in CONTAINERS and not noise:
            classes = sorted(re.sub(r"[\d>]+", "#", c) for c in attributes.get("class", "").split())
            own = ".".join([name, *classes])
            around = page.paths[path] if path >= 0 else ""
            if len(around) > LONG_PATH:
                around = "#" + hashlib.md5(around.encode("utf-8", "replace")).hexdigest()
            page.paths.append(f"{around}>{own}" if around else own)
            page.above.append(path)
            page.marked.append(mark)
            path = len(page.paths) - 1
        if rest.rstrip().endswith("/") and name not in BLOCKS:
            continue
        stack.append(_Open(name, path, noise, bool(outer and outer.link) or name == "a", mark,
                           bool(outer and outer.title) or name == "h1", article))
    add(source[at:])
    close_block()
    # text between <html> and a container lies in no container yet
    page.blocks = [(text, max(where, 0) if page.paths else root(), n, mark) for text, where, n, mark in page.blocks]
    page.judge()
    return page


def host_of(url: str | None) -> str:
    """A url's host, lower case, without port, user and a leading www."""
    host = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", url or "")
    host = host[1].rpartition("@")[2].partition(":")[0].lower() if host else ""
    return host.removeprefix("www.")


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, score, n, climbs): what the pages of each host give each path.

    ``n`` pages have plain text in the path, and ``climbs`` of them would take
    the container around it.  Task and partial sums come before the shuffle, so
    a host of any size sends a row per path and task.
    """
    send_code(pages.sparkSession)

    def task(batches):
        for batch in batches:
            found: dict[tuple[str, str], list] = {}
            for url, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page, host = parse(source or ""), host_of(url)
                scores = page.scores()
                total = sum(scores.values())
                for path, climbs in page.climbs().items() if scores else ():
                    # whole numbers add up alike in any order
                    vote = found.setdefault((host, path), [0, 0, 0])
                    vote[0] += round(1_000_000 * scores.get(path, 0.0) / total)
                    vote[1] += 1
                    vote[2] += climbs
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in found], pa.string()), pa.array([p for _, p in found], pa.string()),
                 *[pa.array([v[i] for v in found.values()], pa.int64()) for i in range(3)]],
                ["host", "path", "score", "n", "climbs"],
            )

    plain = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return (
        plain.mapInArrow(task, "host string, path string, score long, n long, climbs long")
        .groupBy("host", "path").agg(F.sum("score").alias("score"), F.sum("n").alias("n"), F.sum("climbs").alias("climbs"))
    )


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with the most votes of each host, ties to the first by name, or one around it.

    A path is left for the one around it while at least half of the pages that
    have it want that.
    """
    by = Window.partitionBy("host").orderBy(F.desc("score"), "path")
    cast = stage_table(votes(pages), "votes")
    won = cast.withColumn("k", F.row_number().over(by)).where("k = 1").select("host", F.col("path").alias("won"))
    won = stage_table(won, "won")
    stops = cast.where("2 * climbs < n").join(F.broadcast(won) if fits_broadcast(won) else won, "host")
    around = (F.col("path") == F.col("won")) | F.expr("startswith(won, concat(path, '>'))")
    return stops.where(around).groupBy("host").agg(F.max_by("path", F.length("path")).alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    send_code(pages.sparkSession)
    # a row per host: where they are few, pages stay where they lie; else the join splits a host with many pages
    won = stage_table(winning_paths(pages), "paths")
    won = F.broadcast(won) if fits_broadcast(won) else won
    # the same host as host_of gives
    host = F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1)
    host = F.lower(F.substring_index(F.substring_index(host, "@", -1), ":", 1))
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).withColumn("host", F.regexp_replace(host, r"^www\.", ""))

    def task(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts = []
                for source, path in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    page = parse(source or "")
                    text = page.text(path) if path else None
                    if not text:
                        best = page.best()
                        text = page.text(best) if best else page.whole()
                    texts.append(text or "")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return plain.join(won, "host", "left").select("page_id", "url", "html", "path").mapInArrow(
        task, "page_id long, url string, text string, n_chars long")
