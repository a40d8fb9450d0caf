"""Main text of web pages by consensus paths of their hosts.

1. Each page is scanned into blocks of text, each with the innermost element around it; elements know their parents.
   Menus, footers, sidebars, controls, scripts, styles and hidden elements are left out by tag, role and attribute, and
   headers unless an article or main element holds them.
2. Elements whose class or id only has words for what isn't the main text (``cookie-notice``, ``ad-slot``; not ``related-work``), and
   forms, are judged one by one, by what they hold and never by their share of the page:

   - reader comments go, unless they hold a main element; on paragraphs and the like the name counts only where two
     or more have it, as one alone may be the author's;
   - adverts, notices and the like go, unless they hold an article or main element with text;
   - buttons for sharing go, unless they hold a sentence, no controls, and less than half of their text is links;
   - one word that also names content (``related``, ``privacy``), on a grouping element: it goes if half of its text or more is links;
   - a form goes, unless it holds an article or main element, a title or a hundred characters for each of its controls, as a
     form around the whole page does.

   What is kept under a name of the last but one and the one before is left out where other texts of the host repeat it, by votes that Spark counts.
   If nothing at all would be left, the one element but comments that holds most is kept, with those around it.
3. Containers are scored by the text below them that isn't link text; from the top, the best
   container is the deepest that still holds most of its parent's score, and the title if the parent
   has one; an article isn't taken apart, nor is text that is nested step by step.
4. Each page votes for its container's generalised path (tags and first classes, digits removed), by a running hash
   that is as short at any depth, and Spark counts votes by host and path, map-side first, so a hot host is no harder than another.
5. Pages are scanned again with their host's winning path: the blocks below the elements on that
   path are the text. A page on which these hold less than ``SHARE`` of the score of its own best container uses that one, and
   so does a host on which no path has ``LEAST_VOTES`` of the votes.

Edge cases: a null html is empty and gives an empty text; text without markup is one block; truncated
and badly nested markup closes as browsers close it, in time linear in the page's length at any depth; pages without a host (null url) vote together; ties
between paths go to the shorter, then the lesser; repeated pages each vote for a path, and count as one text for repeated blocks; long pages are scanned
whole; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm.common import bounded_batches, materialize, table

# Elements by what they do to text, and words of names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img math mi mn mo ms mtext mrow msup msub mfrac msqrt".split())
LEFT_OUT = frozenset("nav footer aside button select option datalist script style noscript template iframe object svg canvas audio video head title dialog menu".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
STRONG = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored consent gdpr popup modal overlay newsletter subscribe subscription signup login paywall sidebar nav navbar breadcrumb "
    "breadcrumbs toolbar masthead topbar outbrain taboola pagination pager skip".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist commentform commenter commenters respond replies disqus".split())
SHARE_WORDS = frozenset("share sharing".split())
WEAK = frozenset("alert aside banner cookie cookies disclaimer discussion footer header hidden menu menus navigation notice notices privacy promo promotion recommendations recommended related social tags widget widgets".split())
#: Words that say what an element is for its layout only.
NEUTRAL = frozenset(
    "a area bar block body bottom box btn button buttons center col column container count div first form group icon icons id inner item items label last layout left link links list main module outer panel post posts region right row section "
    "site slot page top title unit wrap wrapper".split()
)
STRONG_STARTS = ("advert", "sponsor", "newsletter", "breadcrumb", "navbar")
GROUPING = frozenset("div section ul ol dl table tbody tr td center main article".split())
CONTAINERS = frozenset("html body main article section div td table tbody tr center blockquote form".split())
#: What a form can ask with, and single pieces of text, which share a name with others of their kind where it is a list's.
CONTROLS = frozenset("input button select textarea".split())
PIECES = frozenset("p pre blockquote figure figcaption address".split())
#: What the name of an element says of it.
NOTHING, DOUBTFUL, SHARING, STRONG_HINT, COMMENTS, FORM = range(6)
#: Elements of one kind that end when the next begins.
_CLOSES = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
#: How much of a container's score one below it needs, to be taken instead.
MOST = 0.6
#: How much of the page's score may be right in the containers passed on the way down.
OWN = 0.2
BOOST = {"article": 3.0, "main": 2.0}
#: How much of the own best container's score the host's path has to hold on a page, and of the host's votes the path.
SHARE, LEAST_VOTES = 0.5, 0.2
#: Characters that a form needs for each control, to be more than a form; and a sentence, at least.
FORM_TEXT, SENTENCE = 100, 30
#: Texts of a host that have to have a block, for it to be a repeated one.
REPEATED = 3

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_DIGITS = re.compile(r"\d+")


@dataclass(slots=True)
class Block:
    text: str
    at: int  # the innermost element, or -1
    links: int


@dataclass(slots=True)
class Page:
    """Blocks of text, and the elements around them by number, parents first: tag, parent, hash of the generalised path, what the name says, controls right in it."""

    blocks: list[Block] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    keys: list[bytes] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    controls: list[int] = field(default_factory=list)

    def path(self, at: int) -> str:
        """The generalised path of an element, to be read; the middle of a very deep one is cut."""
        names: list[str] = []
        while at >= 0:
            names.append(self.names[at])
            at = self.parents[at]
        return "/" + "/".join(names[::-1] if len(names) <= 64 else [*names[:-33:-1], "...", *names[31::-1]]) if names else ""

    def below(self, tops: set[int] | None, key: bytes | None = None) -> list[bool]:
        """For each element whether it is one of ``tops``, or on the path with this key, or below such a one."""
        inside: list[bool] = []
        for number, parent in enumerate(self.parents):
            inside.append(parent >= 0 and inside[parent] or (number in tops if tops is not None else self.keys[number] == key))
        return inside


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in reversed(list(_ATTRIBUTE.finditer(text)))}


def left_out(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element is none of the main text, by its tag, role and attributes."""
    if tag == "aside" and in_article and any(w.endswith("quote") for w in _name_words(attributes)):
        return False
    if tag in LEFT_OUT or tag == "header" and not in_article or attributes.get("role", "").lower() in LEFT_OUT_ROLES:
        return True
    return bool(attributes) and ("hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")) is not None)


def _name_words(attributes: dict[str, str]) -> list[str]:
    return [w.lower() for w in _NAME_WORDS.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")]


def hint(tag: str, attributes: dict[str, str]) -> int:
    """What the classes and the id of an element say of it; the most that one of them says."""
    found = NOTHING
    if tag in ("html", "body", "main"):
        return found
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        said = [w for w in _name_words({"id": name}) if w not in NEUTRAL and not w.isdigit()]
        comment, share = sum(w in COMMENT_WORDS for w in said), sum(w in SHARE_WORDS for w in said)
        strong, weak = sum(w in STRONG or w.startswith(STRONG_STARTS) for w in said), sum(w in WEAK for w in said)
        if not said or comment + share + strong + weak < len(said):
            continue
        found = max(found, COMMENTS if comment else STRONG_HINT if strong or weak + share > 1 else SHARING if share else DOUBTFUL if tag in GROUPING else NOTHING)
    return found if tag != "article" or found == COMMENTS else NOTHING


def scan(source: str) -> Page:
    """The blocks of a page's text that aren't left out."""
    page = Page()
    stack: list[tuple[str, int, bool]] = []  # tag, number of the element or -1 for inline ones, left out
    places: dict[str, list[int]] = defaultdict(list)  # of each tag, where it stands in the stack
    pieces: list[str] = []
    links = at = out = in_link = 0
    here = -1  # the innermost element

    def flush() -> None:
        nonlocal links
        text = " ".join(entities.unescape("".join(pieces)).split()) if pieces else ""
        if text:
            page.blocks.append(Block(text, here, min(links, len(text))))
        pieces.clear()
        links = 0

    def push(tag: str, number: int, off: bool) -> None:
        nonlocal out, in_link
        places[tag].append(len(stack))
        stack.append((tag, number, off))
        out += off
        in_link += tag == "a"

    def pop(to: int) -> None:
        """Close elements until ``to`` are open."""
        nonlocal out, here, in_link
        if any(number >= 0 for _, number, _ in stack[to:]):
            flush()
        while len(stack) > to:
            tag, number, off = stack.pop()
            places[tag].pop()
            out -= off
            in_link -= tag == "a"
            if number >= 0:
                here = page.parents[number]

    def text(part: str) -> None:
        nonlocal links
        if part and not out:
            pieces.append(part)
            if in_link:
                links += len(part)

    def open_above(tag: str, *walls: str) -> int:
        """The place of the nearest open ``tag`` that no wall hides, or -1."""
        i = places[tag][-1] if places[tag] else -1
        return -1 if any(places[w] and places[w][-1] > i for w in walls) else i

    while found := _MARKUP.search(source, at):
        text(source[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            i = open_above(tag, "td", "th", "article", "main") if tag in ("p", "li") or tag in INLINE else open_above(tag)
            if i >= 0:
                pop(i)
            elif tag not in INLINE:
                flush()
            continue
        if tag in CONTROLS and here >= 0:
            page.controls[here] += tag != "input" or not re.search(r"type\s*=\s*[\"']?hidden", found[3] or found[6] or "", re.I)
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                text(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        given = _attributes(found[3] or found[6] or "")
        if tag in INLINE:
            push(tag, -1, bool(given) and (left_out(tag, given, True) or hint(tag, given) == STRONG_HINT))
            continue
        if tag in _CLOSES and (i := open_above(tag, *_CLOSES[tag])) >= 0:
            pop(i)
        if (i := open_above("p", "td", "th", "table", "article", "main", "button")) >= 0:
            pop(i)
        flush()
        number, classes = len(page.tags), given.get("class", "").split()
        name = tag + ("." + _DIGITS.sub("#", classes[0]) if classes else "")
        told = hint(tag, given) if given else NOTHING
        page.tags.append(tag)
        page.parents.append(here)
        page.names.append(name)
        page.keys.append(hashlib.blake2b((page.keys[here] if here >= 0 else b"") + name.encode("utf-8", "replace"), digest_size=16).digest())
        page.kinds.append(FORM if tag in ("form", "fieldset") and told < STRONG_HINT else told)
        page.controls.append(0)
        here = number
        push(tag, number, left_out(tag, given, bool(places["article"] or places["main"])))
    text(source[at:])
    flush()
    return page


def judged(page: Page) -> list[int]:
    """Of each block: -1 if it is left out, 0 if not, or the number, from 1, of the element around it that goes where the host repeats the block."""
    n = len(page.tags)
    if not any(page.kinds):
        return [0] * len(page.blocks)
    text, links, controls = [0] * n, [0] * n, page.controls.copy()
    says, title, main, article = [False] * n, [False] * n, [False] * n, [False] * n  # what there is in or below an element
    for block in page.blocks:
        if (at := block.at) >= 0:
            text[at] += len(block.text)
            links[at] += block.links
            says[at] |= len(block.text) - block.links >= SENTENCE and block.text.rstrip("\"'”’»)")[-1:] in tuple(".!?…。")
            title[at] |= page.tags[at] == "h1"
    for number in range(n - 1, -1, -1):
        if text[number] and page.kinds[number] != COMMENTS:
            main[number] |= page.tags[number] == "main"
            article[number] |= page.tags[number] == "article"
        if (up := page.parents[number]) >= 0:
            text[up] += text[number]
            links[up] += links[number]
            controls[up] += controls[number]
            says[up] |= says[number]
            title[up] |= title[number]
            main[up] |= main[number]
            article[up] |= article[number]
    alike: dict[str, int] = defaultdict(int)
    for name, kind in zip(page.names, page.kinds, strict=True):
        alike[name] += kind == COMMENTS

    def goes(k: int) -> bool:
        kind, linked = page.kinds[k], 2 * links[k] >= text[k]
        if kind == COMMENTS:
            return not main[k] and (page.tags[k] not in PIECES or alike[page.names[k]] > 1)
        if kind == STRONG_HINT:
            return not (main[k] or article[k])
        if kind == SHARING:
            return linked or controls[k] > 0 or not says[k]
        if kind == FORM:
            return not (main[k] or article[k] or title[k] or text[k] - links[k] >= FORM_TEXT * controls[k])
        return kind == DOUBTFUL and linked

    gone = [goes(k) for k in range(n)]

    def of_blocks() -> list[int]:
        told = [0] * n
        for k, up in enumerate(page.parents):
            above = told[up] if up >= 0 else 0
            told[k] = -1 if above < 0 or gone[k] else above or (k + 1 if page.kinds[k] in (DOUBTFUL, SHARING) else 0)
        return [told[b.at] if b.at >= 0 else 0 for b in page.blocks]

    out = of_blocks()
    if not any(t >= 0 and len(b.text) > b.links for t, b in zip(out, page.blocks, strict=True)):
        nearest, held = [-1] * n, defaultdict(int)  # the innermost element around that goes; none below comments
        for k, up in enumerate(page.parents):
            lost = up >= 0 and nearest[up] == -2 or gone[k] and page.kinds[k] == COMMENTS
            nearest[k] = -2 if lost else k if gone[k] else nearest[up] if up >= 0 else -1
        for b in page.blocks:
            if b.at >= 0 and nearest[b.at] >= 0:
                held[nearest[b.at]] += len(b.text) - b.links
        k = max(held, key=lambda x: (held[x], -x), default=-1)
        while k >= 0:
            gone[k], k = False, page.parents[k]
        out = of_blocks()
    return out


def best_container(page: Page) -> tuple[int, list[float]]:
    """The number of the element that holds the main text, -1 for the page itself; and each element's score, the page's as the last."""
    n = len(page.tags)
    chain, home, boost, score, titles = [False] * n, [-1] * n, [1.0] * n, [0.0] * (n + 1), [0] * (n + 1)
    inner: dict[int, list[int]] = defaultdict(list)  # of containers, those right below
    for number, (tag, parent) in enumerate(zip(page.tags, page.parents, strict=True)):
        above = parent < 0 or chain[parent]
        chain[number] = above and tag in CONTAINERS
        home[number] = number if chain[number] else home[parent] if parent >= 0 else -1
        boost[number] = boost[parent] if parent >= 0 and boost[parent] > 1.0 else BOOST.get(tag, 1.0)
        if chain[number]:
            inner[parent].append(number)
    for block, told in zip(page.blocks, judged(page), strict=True):
        if told >= 0:
            score[home[block.at] if block.at >= 0 else -1] += (len(block.text) - block.links) * (boost[block.at] if block.at >= 0 else 1.0)
            titles[block.at] += block.at >= 0 and page.tags[block.at] == "h1"
    own = score.copy()  # of the blocks right in a container
    for number in range(n - 1, -1, -1):
        titles[page.parents[number]] += titles[number]
        if chain[number]:
            score[page.parents[number]] += score[number]
    at, first, passed = -1, None, 0.0
    while inner[at]:
        top = max(inner[at], key=lambda k: (score[k], -k))
        if score[top] <= 0 or score[top] < MOST * score[at]:
            break
        if at >= 0 and (page.tags[at] == "article" or page.tags[at] == "main" and page.tags[top] != "article"):
            break
        if titles[top] < titles[at]:  # the title would be lost
            break
        if own[at] > 0:
            first, passed = at if first is None else first, passed + own[at]
            if passed > OWN * score[-1]:  # text nested step by step is one text
                return first, score
        at = top
    return at, score


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def main_path(source: str) -> tuple[bytes, str, int, list[int]]:
    """Of a page's best container the path's hash (empty for the page itself), the path and its depth; and the hashes of the blocks there in doubt."""
    page = scan(source)
    at, _ = best_container(page)
    inside = page.below({at}) if at >= 0 else [True] * len(page.tags)
    weak = {digest(b.text) for b, told in zip(page.blocks, judged(page), strict=True) if told > 0 and inside[b.at]}
    depth, up = 0, at
    while up >= 0:
        depth, up = depth + 1, page.parents[up]
    return (page.keys[at] if at >= 0 else b"", page.path(at), depth, sorted(weak))


def main_text(source: str, key: bytes | None, repeated: list[int] | None = None) -> str:
    """The text below the elements on the path with this hash, or below the page's own best container."""
    page = scan(source)
    at, score = best_container(page)
    inside = page.below({at}) if at >= 0 else [True] * len(page.tags)
    if key:
        on = page.below(None, key)
        tops = [n for n, yes in enumerate(on) if yes and not (page.parents[n] >= 0 and on[page.parents[n]])]
        if sum(score[n] for n in tops) >= SHARE * score[at] and tops and any(score[n] > 0 for n in tops):
            at, inside = tops[0], on
    often, blocks = set(repeated or ()), []
    for block, told in zip(page.blocks, judged(page), strict=True):
        if (at < 0 or block.at >= 0 and inside[block.at]) and told >= 0 and not (told > 0 and digest(block.text) in often):
            blocks.append(block.text)
    return "\n".join(blocks)


def host(url: str) -> Column:
    """The host of a URL, in lower case; null without one."""
    return F.nullif(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _votes(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """A row per page: host, page (a hash of its html), key, path, depth, weak."""
    bounded_batches(pages.sparkSession)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key, path, depth, weak = zip(*[main_path(x or "") for x in batch.column(2).to_pylist()], strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(key, pa.binary()), pa.array(path, pa.string()), pa.array(depth, pa.int64()), pa.array(weak, pa.list_(pa.int64()))], names=["host", "page", "key", "path", "depth", "weak"])

    html = F.col(html_col).cast("string")
    return materialize(pages.select(host(url_col).alias("host"), F.xxhash64(html).alias("page"), html.alias("html")).mapInArrow(vote, "host string, page long, key binary, path string, depth long, weak array<long>"), "votes")


def _winners(votes: DataFrame) -> DataFrame:
    counts = votes.groupBy("host", "key").agg(F.min("path").alias("path"), F.min("depth").alias("depth"), F.count("*").alias("votes"))
    rank = F.struct(-F.col("votes"), "depth", "path", "key")
    won = counts.groupBy("host").agg(F.min_by(F.struct("key", "path"), rank).alias("won"), F.max("votes").alias("votes"), F.sum("votes").alias("n_pages"))
    return won.select("host", "won.key", "won.path", "votes", "n_pages")


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row per host: host, key and path (those with most votes), votes, n_pages."""
    return _winners(_votes(pages, url_col, html_col))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row per page: page_id, url, text, n_chars, host, path (the host's)."""
    votes = _votes(pages, url_col, html_col)
    agreed = F.col("votes") >= LEAST_VOTES * F.col("n_pages")
    won = materialize(_winners(votes).select(F.col("host").alias("h"), F.when(agreed, F.col("key")).alias("key"), F.when(agreed, F.col("path")).alias("path")), "paths")
    weak = votes.where(F.size("weak") > 0).select("host", "page", F.explode("weak").alias("block")).distinct()
    often = weak.groupBy("host", "block").agg(F.count("*").alias("texts")).where(F.col("texts") >= REPEATED).select(F.col("host").alias("h"), "block")
    repeated = weak.join(often, weak["host"].eqNullSafe(often["h"]) & (weak["block"] == often["block"]), "left_semi")
    repeated = materialize(repeated.groupBy(F.col("host").alias("rh"), F.col("page").alias("rp")).agg(F.collect_list("block").alias("repeated")), "repeated")
    html = F.col(html_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host(url_col).alias("host"), F.xxhash64(html).alias("page"), html.alias("html"))
    rows = rows.join(won, F.col("host").eqNullSafe(F.col("h")))
    if repeated.limit(1).count():
        rows = rows.join(repeated, F.col("host").eqNullSafe(F.col("rh")) & (F.col("page") == F.col("rp")), "left")
    else:
        rows = rows.withColumn("repeated", F.lit(None).cast("array<long>"))
    rows = rows.select("page_id", "url", "host", "path", "key", "repeated", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x or "", key, often) for key, often, x in zip(*(batch.column(i).to_pylist() for i in (4, 5, 6)), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "host", "path", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, host string, path string, text string, n_chars long")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages: page_id, url, text, n_chars."""
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
