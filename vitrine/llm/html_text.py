"""Main text of web pages by consensus paths of each host.

1. Each page's containers are scored: characters of text outside links and boilerplate, more with sentence marks, and with
   a tag or class that names content. Containers on one path of tags and classes (digits taken out: "generalised") count
   together; the deepest path with the best score is the page's vote, and paths beside it that are named content or like
   the best one, and have a quarter of its score, are its further votes.
2. Spark counts the votes per host, so that pages made from one template agree. The path with most votes wins (then most
   text, then by name), and with it the further paths that are voted for more than half as often.
3. Every page is read again and its text taken from all containers on the host's paths. A page that has no text there is
   taken by its own votes.

Boilerplate (menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts) is left out by tag and role, and by
a class or id whose name ends in a word for it (``site-footer``, ``ad-slot``). A name that only mentions such a word
(``social-contract``) is a hint: the host decides. Its pages' texts on that path are compared, and where more than half of at
least three pages say the same there, it is boilerplate. Pages with the same longest paragraph count once, so that copies of
an article do not vote it out.

Broken markup is read as browsers do in the main: a block ends an open paragraph, an end tag closes what is open inside it,
stray end tags are nothing, raw text runs to its end tag. A tag whose quotes run to the end of the page is read without
quotes, and so is the rest of that page. A page costs time and memory in proportion to its length, however broken or nested.

Scale: votes are counted with partial aggregation, a row for each host and path in a task; a host with a third of all pages
has as many rows as it has paths. Pages meet their host's paths (a row per host, its numbers of paths) by a broadcast of at
most ``broadcast_bytes``, beyond that by a join whose hot hosts can be split. Every page is parsed twice, as a whole.

Edge cases: a NULL, empty or text-free page has the empty text; a NULL or odd url belongs to host ''; repeated rows vote
and come back as often as they occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from string import ascii_letters

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.storage import settled
from vitrine.llm.text import slices
from vitrine.operators.joins import lookup

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_EDGE = re.compile(r"""[>"']""")
_PLAIN_EDGE = re.compile(r"[<>]")
_COMMENT_END = re.compile(r"--!?>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Text up to the end tag is no markup; only that of a title or text area could be read at all, and neither is main text.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template", "svg", "math"}
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in _RAW}
_SKIPPED = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "object", "audio", "video", "canvas", "head"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form"}
_PARAGRAPHS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "li", "dt", "dd", "figcaption", "caption", "summary", "address"}
_CONTAINERS = {"html", "body", "main", "article", "section", "div", "table", "tbody", "thead", "tfoot", "tr", "td", "th", "ul", "ol", "dl", "figure", "center", "details", "fieldset", "hgroup"}
_BLOCKS = _PARAGRAPHS | _CONTAINERS | _SKIPPED | {"hr"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
#: What an opening tag ends, up to the nearest of the second set.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
#: Words that name boilerplate, and words that only say what kind of box it is in.
_BOILERPLATE = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs sidebar "
    "aside footer header masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login share sharing social related "
    "recommended comment comments commentlist respond reply replies disqus pagination pager widget widgets skip toolbar search alert disclaimer".split()
)
_BOXES = set(
    "area bar block blocks body bottom box button buttons center col column container content count fixed form global group header holder icons inner item items "
    "label leaderboard left link links list main message module outer page panel policy post posts articles stories reading rectangle region right row section site slot "
    "small text thread title to toggle top unit wrap wrapper zone".split()
)
_WORD_EDGE = re.compile(r"[^a-zA-Z\u0080-\U0010ffff]+|(?<=[a-z])(?=[A-Z])")
_CONTENT = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion|banner|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|sidebar|"
    r"aside|footer|header|masthead|cookie|cookies|consent|gdpr|notice|notices|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|"
    r"recommended|comment|comments|commentlist|respond|reply|replies|disqus|pagination|pager|widget|skip|toolbar|search|alert|disclaimer)(?:$|[\s_\d-])", re.I
)
_CONTENT = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|body|text|blog)(?:$|[\s_-])", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_DIGITS = re.compile(r"\d+")


_PRIME = (1 << 61) - 1
_BASE = 0x1F3D5B79_2468ACE


def _number(text: str) -> int:
    """64 bits of a text, as a signed number."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


@lru_cache(4096)
def _named(names: str) -> int:
    """2 where a class or id names boilerplate, 1 where it only mentions it, else 0."""
    found = 0
    for name in names.split():
        words = [w.lower() for w in _WORD_EDGE.split(name) if w]
        if not any(w in _BOILERPLATE for w in words):
            continue
        while words and words[-1] not in _BOILERPLATE and (words[-1] in _BOXES or len(words[-1]) == 1):
            words.pop()
        found = max(found, 2 if words and words[-1] in _BOILERPLATE else 1)
    return found


class Page:
    """Containers and the blocks of text in them, both in page order.

    The blocks of a container lie side by side: from ``first`` up to ``last``. ``place`` is the number of a container's path.
    """

    def __init__(self, source: str):
        self.place: list[int] = [0]
        self.step: list[tuple[int, str]] = [(-1, "")]  # the container around it, tag and classes
        self.factor: list[int] = [2]  # quarters
        self.hinted: list[bool] = [False]
        self.first: list[int] = [0]
        self.last: list[int] = [0]
        self.blocks: list[tuple[str, int]] = []  # text, characters in links
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int, bool]] = []  # tag, container, skipped
        opened: dict[str, list[int]] = defaultdict(list)  # places in the stack of each tag
        numbers: dict[tuple[int, str], int] = {}
        here, skipped, links = 0, False, 0
        words: list[str] = []
        in_link = 0
        quotes, last_end = True, source.rfind(">")

        def flush() -> None:
            nonlocal in_link
            if words:
                text = " ".join(entities.unescape("".join(words)).split())
                if text:
                    self.blocks.append((text, min(in_link, len(text))))
                words.clear()
            in_link = 0

        def take(text: str) -> None:
            nonlocal in_link
            if text and not skipped:
                words.append(text)
                if links:
                    in_link += len(text)

        def close(k: int) -> None:
            nonlocal here, skipped
            flush()
            for tag, node, _ in reversed(stack[k:]):
                opened[tag].pop()
                self.last[node] = len(self.blocks)
            del stack[k:]
            here, skipped = (stack[-1][1], stack[-1][2]) if stack else (0, False)

        def innermost(tags: set[str]) -> int:
            return max((opened[t][-1] for t in tags if opened[t]), default=-1)

        taken = at = 0
        while (start := source.find("<", at)) >= 0:
            mark = source[start + 1 : start + 2]
            end = mark == "/"
            letter = source[start + 2 : start + 3] if end else mark
            if not letter or letter not in ascii_letters:
                if mark not in ("!", "?", "/") or not mark:
                    at = start + 1  # no markup
                    continue
                if source.startswith("<!--", start):
                    done = _COMMENT_END.search(source, start + 4)
                    stop = done.end() if done else len(source)
                else:
                    stop = source.find(">", start) + 1 or len(source)
                take(source[taken:start])
                taken = at = stop
                continue
            if start > last_end:
                at = start + 1
                continue
            stop = -1
            name = start + 1 + end
            if quotes:
                look = _NAME.match(source, name).end()
                while edge := _EDGE.search(source, look):
                    if edge[0] == ">":
                        stop = edge.start()
                        break
                    look = source.find(edge[0], edge.end()) + 1
                    if not look:
                        break
                quotes = stop >= 0
            if not quotes:
                edge = _PLAIN_EDGE.search(source, name)
                if not edge or edge[0] == "<":
                    at = start + 1
                    continue
                stop = edge.start()
            take(source[taken:start])
            taken = at = stop + 1
            whole = _NAME.match(source, name, stop)
            tag, attributes = whole[0].lower(), source[whole.end() : stop]
            if tag in _RAW and not end:
                if not attributes.endswith("/") or tag not in ("svg", "math"):
                    done = _RAW_END[tag].search(source, at)
                    taken = at = (source.find(">", done.end()) + 1 or len(source)) if done else len(source)
                continue
            if tag == "a":
                links = 0 if end else 1
                continue
            if tag == "br":
                take(" ")
                continue
            if tag not in _BLOCKS:
                continue
            if end:
                if opened[tag]:
                    close(opened[tag][-1])
                continue
            flush()
            if tag == "hr":
                continue
            while stack and stack[-1][0] in _PARAGRAPHS and (stack[-1][0] == "p" or (stack[-1][0][0] == "h" and tag[0] == "h" and tag[1:].isdigit())):
                close(len(stack) - 1)
            if tag in _ENDS:
                ended, within = _ENDS[tag]
                while (k := innermost(ended)) > innermost(within):
                    close(k)
                    if tag != "tr":
                        break
            names = ids = ""
            hidden = False
            if attributes.strip(" /"):
                for key, a, b, c in _ATTRIBUTE.findall(attributes):
                    key, value = key.lower(), a or b or c
                    if key == "class":
                        names = entities.unescape(value)
                    elif key == "id":
                        ids = value
                    elif key == "role":
                        hidden = hidden or value.strip().lower() in _ROLES
                    elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDDEN.search(value)):
                        hidden = True
            judge = _named if len(names) + len(ids) < 500 else _named.__wrapped__  # keeps the cache small
            named = max(0 if tag in ("article", "main") else judge(names), judge(ids))
            if tag in ("html", "body"):
                hidden, named = False, 0
            skipped = skipped or hidden or named == 2 or tag in _SKIPPED
            if (tag in _CONTAINERS or named) and not skipped:
                classes = ".".join(sorted({_DIGITS.sub("", x).lower().strip("-_") for x in names.split()} - {""}))
                step = f"{tag}.{classes}" if classes else tag
                key = (self.place[here], step)
                if key not in numbers:
                    numbers[key] = _number(f"{key[0]}/{step}")
                self.place.append(numbers[key])
                self.step.append((here, step))
                self.factor.append(6 if tag in ("article", "main") else 2 if tag in ("html", "body") else 5 if _CONTENT.search(names) or _CONTENT.search(ids) else 4)
                self.hinted.append(named == 1)
                self.first.append(len(self.blocks))
                self.last.append(len(self.blocks))
                here = len(self.place) - 1
            opened[tag].append(len(stack))
            stack.append((tag, here, skipped))
        take(source[taken:])
        close(0)
        self.last[0] = len(self.blocks)

    def path(self, node: int) -> str:
        """Tags and classes from the page down to a container."""
        steps = []
        while node > 0:
            node, step = self.step[node]
            steps.append(step)
        return "".join(f"/{x}" for x in reversed(steps))

    def votes(self) -> tuple[int, list[int], int]:
        """A container on the best path, one on each further path, and the characters on the best one. Scores are whole numbers."""
        total, size, score, chars = [0], [0], defaultdict(int), defaultdict(int)
        for text, linked in self.blocks:
            marks = sum(text.count(x) for x in ".,;!?")
            total.append(total[-1] + max(0, len(text) - 2 * linked) * (10 + min(marks, 5)) * 1000 + 1)
            size.append(size[-1] + len(text))
        weight, last_on = defaultdict(int), {}
        for k, (place, a, b) in enumerate(zip(self.place, self.first, self.last, strict=True)):
            weight[place] += total[b] - total[a]
            score[place] += (total[b] - total[a]) * self.factor[k]
            chars[place] += size[b] - size[a]
            last_on[place] = k
        best = max((p for p in weight if 10 * weight[p] >= 4 * total[-1]), key=lambda p: (score[p], last_on[p]))
        inside = self._covered({best})
        taken = [0]
        for x in inside:
            taken.append(taken[-1] + x)
        further, until = [], 0
        for k, (place, a, b) in enumerate(zip(self.place, self.first, self.last, strict=True)):
            beside = a >= until and a < b and taken[a] == taken[b]
            if beside and 4 * score[place] >= score[best] and (self.factor[k] > 4 or self.step[k][1] == self.step[last_on[best]][1]):
                further.append(k)
                until = b
        return last_on[best], list({self.place[k]: k for k in further}.values()), chars[best]

    def hints(self) -> tuple[int, list[tuple[int, int]]]:
        """A number for the page (of its longest block outside hinted containers), and path and text of those, as numbers."""
        if not any(self.hinted):
            return 0, []
        outside = self._covered({k for k, hinted in enumerate(self.hinted) if hinted}, by_node=True)
        longest = max((text for (text, _), inside in zip(self.blocks, outside, strict=True) if not inside), key=len, default="")
        sums, powers = [0], [1]
        for text, _ in self.blocks:
            sums.append((sums[-1] * _BASE + _number(text)) % _PRIME)
            powers.append(powers[-1] * _BASE % _PRIME)
        found = []
        for k, hinted in enumerate(self.hinted):
            a, b = self.first[k], self.last[k]
            if hinted and a < b:
                found.append((self.place[k], (sums[b] - sums[a] * powers[b - a]) % _PRIME))
        return _number(longest), found

    def _covered(self, those: set[int], by_node: bool = False) -> list[bool]:
        """For each block, whether it lies in one of the containers, given by their paths or themselves."""
        edge = [0] * (len(self.blocks) + 1)
        for k, place in enumerate(self.place):
            if (k if by_node else place) in those:
                edge[self.first[k]] += 1
                edge[self.last[k]] -= 1
        open_, covered = 0, []
        for x in edge[:-1]:
            open_ += x
            covered.append(open_ > 0)
        return covered

    def text(self, places: list[int], dropped: list[int]) -> str:
        """Text of all containers on the paths but for those on the dropped ones; of all, if that leaves nothing."""
        inside = [t for (t, _), x in zip(self.blocks, self._covered(set(places)), strict=True) if x]
        if dropped and inside:
            out = self._covered(set(dropped))
            inside = [t for (t, _), x, no in zip(self.blocks, self._covered(set(places)), out, strict=True) if x and not no] or inside
        return "\n\n".join(inside)


_VOTES = "host string, kind int, place long, part long, page long, path string, size long"


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Votes for the best path (kind 0), for further ones (1), and texts on hinted paths (2)."""
    for batch in slices(batches, "html"):
        rows: list[tuple] = []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = Page(source or "")
            if not page.blocks:
                continue
            best, further, size = page.votes()
            rows.append((host, 0, page.place[best], 0, 0, page.path(best), size))
            rows += [(host, 1, page.place[k], 0, 0, "", 0) for k in further]
            whole, parts = page.hints()
            rows += [(host, 2, place, part, whole, "", 0) for place, part in parts]
        columns = list(zip(*rows, strict=True)) or [()] * 7
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "kind", "place", "part", "page", "path", "size"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        out = []
        columns = (batch.column(c).to_pylist() for c in ("html", "places", "dropped"))
        for source, places, dropped in zip(*columns, strict=True):
            page = Page(source or "")
            text = page.text(places or [], dropped or [])
            if not text and page.blocks:
                best, further, _ = page.votes()
                text = page.text([page.place[k] for k in (best, *further)], dropped or [])
            out.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])


def host_paths(pages: DataFrame) -> DataFrame:
    """A row for each host of pages (host, html): the winning ``path``, its votes and those of all paths, and the numbers of all
    paths to read (``places``) and of hinted ones to leave out (``dropped``)."""
    votes = pages.select("host", "html").mapInArrow(_votes, _VOTES)
    counted = settled(votes.groupBy("host", "kind", "place", "part", "page").agg(F.count("*").alias("votes"), F.sum("size").alias("size"), F.max("path").alias("path")))
    order = F.struct((-F.col("votes")).alias("votes"), (-F.col("size")).alias("size"), "path", "place")
    best = counted.where("kind = 0").groupBy("host").agg(F.min(order).alias("best"), F.sum("votes").alias("all_votes"))
    further = lookup(counted.where("kind = 1").select("host", "place", "votes"), best.select("host", "best"), ["host"])
    further = further.where(2 * F.col("votes") > -F.col("best.votes")).groupBy("host").agg(F.collect_set("place").alias("further"))
    alike = counted.where("kind = 2").groupBy("host", "place", "part").agg(F.count("*").alias("pages"))  # a row for each page number
    alike = alike.groupBy("host", "place").agg(F.sum("pages").alias("all"), F.max("pages").alias("most"))
    dropped = alike.where((F.col("all") >= 3) & (2 * F.col("most") > F.col("all"))).groupBy("host").agg(F.collect_set("place").alias("dropped"))
    none = F.array().cast("array<bigint>")
    return best.join(further, "host", "left").join(dropped, "host", "left").select(
        "host", "best.path", (-F.col("best.votes")).alias("votes"), "all_votes",
        F.concat(F.array("best.place"), F.coalesce("further", none)).alias("places"), F.coalesce("dropped", none).alias("dropped"),
    )


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", broadcast_bytes: int = 16 << 20) -> DataFrame:
    """page_id, url and text of each page. Hosts' paths are broadcast up to ``broadcast_bytes``, beyond that joined by shuffle."""
    host = F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    kind = pages.schema[page_id].dataType.simpleString()
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host.alias("host"))
    paths = settled(host_paths(rows).select("host", "places", "dropped"))
    held = paths.agg(F.sum(F.octet_length("host") + 8 * (F.size("places") + F.size("dropped")) + 64)).first()[0] or 0
    found = rows.join(F.broadcast(paths), "host", "left") if held <= broadcast_bytes else lookup(rows, paths, ["host"])
    texts = found.select("page_id", "url", "html", "places", "dropped").mapInArrow(_texts, f"page_id {kind}, url string, text string")
    return texts.withColumnsRenamed({"page_id": page_id, "url": url})
