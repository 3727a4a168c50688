"""Main text of HTML pages by maximum-scoring subsequence.

A page is a sequence of tags and pieces of text. Words score +1, tags score at most 0; the region is the contiguous
run with the highest sum, found by one linear scan. A visible tag's cost is learned from labelled pages, those whose main
region is marked by a closed ``article`` or ``main`` element: the larger the part of its occurrences outside of that
region (or at its border), the more it costs. Words of links outside of the article and of
paragraphs and headings score -1, such links inside of the article 0.

Elements that are never main text (scripts, styles, menus, forms, adverts and the like, by name or by class, id or
role) are taken out with all they hold and cost nothing, also within the region. A class, id or role does not take out a
layout wrapper, whose tags cost what others of their name do: an element that holds an ``article`` or ``main`` or, if
none lies apart from it, over half of the words (of the ``article`` or ``main`` around it, else of the page). An
``article`` or ``main`` that is itself marked, as comments may be, counts for this only as the first of its page.
Tag counts are summed by a partial aggregation over a
fixed set of tag names; extraction needs no shuffle.

NULL and empty pages have an empty text; broken markup is read as far as it goes; long pages are read whole; repeated
rows give repeated rows. Without labelled pages every tag costs ``PRIOR``. Other input columns are not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from productlens.llm.tasks import prepare, slices, texts_of

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template iframe textarea title svg object annotation annotation-xml".split()
INLINE = set("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp
    small span strike strong sub sup time tt u var wbr math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover
    mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover
    semantics""".split())
BLOCK = set("""address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html input legend li link main menu meta nav
    ol option p pre section select summary table tbody td tfoot th thead tr ul""".split())
NEVER = set("head nav footer aside form button select menu dialog option".split())
CLOSES_P = BLOCK - {"br", "input", "button", "select", "option", "link", "meta"}
# Words in class, id and role that mark what is not main text.
MARKS = set("""ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments
    consent cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices
    pagination popup promo related respond reply replies share sharing sidebar social sponsor sponsored subscribe
    toolbar widget alert""".split())
# The same as a part of a longer word.
MARK_PARTS = re.compile("advert|breadcrumb|comment(?!ary)|cookie|disqus|navbar|newsletter|pagination|sidebar|sponsor")
# Words in an id that tell where a part is or what holds it.
PLACES = set("""area aside bar block bottom box center column container content group inner left list main outer panel right
    section side top wrap wrapper""".split())
HEADINGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
REGION = ("article", "main")
NAMES = sorted(INLINE | BLOCK)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/>])[^>]*/>"
    rf"|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+(?:>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)", re.I | re.S)
MARKED = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
PART = re.compile(r"[a-z]+")
#: Cost of a tag that is always outside; smallest cost of any tag; cost without labelled pages.
OUTSIDE, LEAST, PRIOR = 30.0, 0.001, 0.2


def is_marked(attrs: str) -> bool:
    """Some class or role names a part that is not main text, or an id does whose words after the last such name only tell
    its place: other ids are often the slug of a heading."""
    for kind, v in MARKED.findall(attrs):
        words = PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", v).lower())
        if kind.lower() == "id":
            while words and words[-1] in PLACES:
                words.pop()
            if words and (words[-1] in MARKS or MARK_PARTS.search(words[-1])):
                return True
        elif not MARKS.isdisjoint(words) or MARK_PARTS.search(v.lower()):
            return True
    return False


def hiding(found: list, marked: list[list[int]], regions: list[list[int]]) -> list[tuple[int, int]]:
    """Of the ``marked`` spans of events those that hide: all but layout wrappers."""
    words, starts = None, [a for a, _ in regions]
    out = []
    for a, b in marked:
        if out and a < out[-1][1]:
            continue  # hidden with the element around it
        if bisect_left(starts, a) < bisect_left(starts, b):
            continue
        scope = max(((c, d) for c, d in regions if c < a and b <= d), default=(-1, len(found)))
        if not any(scope[0] < c and d <= scope[1] for c, d in regions):
            if words is None:
                words = [0, *accumulate(len(v.split()) if k == "text" and not hid and not linked else 0
                                        for k, v, hid, linked in found)]
            if 2 * (words[b] - words[a]) > words[scope[1]] - words[max(0, scope[0])]:
                continue
        out.append((a, b))
    return out


def events(page: str) -> list[tuple[str, str, bool, bool | None]]:
    """(kind, value, hidden, linked): kind is ``tag`` (value: name, with / if it ends) or ``text`` (value: decoded
    text); hidden inside an element that is never main text, linked inside of ``a`` and outside
    of paragraphs and headings (None if inside of the article, too).

    Open elements are found by their names and by the block around them, so the time is linear in the page."""
    found: list[tuple[str, str, bool, bool | None]] = []
    # open elements, whether each hides by its name, its span of events if that is of use, and the place of the nearest
    # block at or below it
    stack: list[tuple[str, bool, list[int] | None, int]] = []
    places: dict[str, list[int]] = {}
    marked: list[list[int]] = []
    regions: list[list[int]] = []
    hidden = links = paragraphs = 0

    def close(upto: int, end: int) -> None:
        nonlocal hidden, links, paragraphs
        for name, hides, span, _ in stack[upto:]:
            places[name].pop()
            hidden -= hides
            links -= name == "a"
            paragraphs -= name in HEADINGS
            if span:
                span[1] = end
        del stack[upto:]

    for m in TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            linked = links > 0 and not paragraphs
            found.append(("text", html.unescape(text), hidden > 0, None if linked and any(map(places.get, REGION)) else linked))
            continue
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["end"]:
            was_hidden = hidden > 0
            # an end tag of an inline element does not close blocks
            if places.get(name) and not (name in INLINE and stack[-1][3] > places[name][-1]):
                close(places[name][-1], len(found) + 1)
            found.append(("tag", "/" + name, was_hidden, False))
            continue
        if name in CLOSES_P and places.get("p") and stack[-1][3] == places["p"][-1]:
            close(places["p"][-1], len(found))
        inside = any(map(places.get, REGION))
        hides = name in NEVER or name == "header" and not inside
        span = None
        if not hides and not hidden and name not in ("html", "body"):
            mark = is_marked(m["attrs"])
            if mark if name not in REGION else not mark or not regions:
                span = [len(found), len(found) + 1]
                (regions if name in REGION else marked).append(span)
        found.append(("tag", name, hidden > 0 or hides, False))
        if name not in VOID and not m["attrs"].rstrip().endswith("/"):
            below = stack[-1][3] if stack else -1
            places.setdefault(name, []).append(len(stack))
            stack.append((name, hides, span, below if name in INLINE else len(stack)))
            hidden += hides
            links += name == "a"
            paragraphs += name in HEADINGS
    close(0, len(found))
    for a, b in hiding(found, marked, regions):
        found[a:b] = [(kind, value, True, linked) for kind, value, _, linked in found[a:b]]
    return found


def tag_counts(page: str) -> Counter:
    """(tag, 1 inside or 0 outside of the region) counts of a labelled page, empty if the page is not labelled."""
    counts, inside, region, seen = Counter(), Counter(), None, False
    for kind, value, hidden, _ in events(page):
        if kind != "tag" or hidden:
            continue
        name = value.lstrip("/")
        if region is None and value in REGION and not seen:
            region = value
            counts[name, 0] += 1
        elif region is not None and value == "/" + region:
            region, seen = None, True
            counts[name, 0] += 1
            counts.update(inside)
        elif region is not None:
            inside[name, 1] += 1
        else:
            counts[name, 0] += 1
    return counts if seen else Counter()


def learn_costs(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Cost of each tag name from all labelled pages."""
    prepare(pages.sparkSession)

    def run(batches):
        for b in slices(batches, "html"):
            total = Counter()
            for page in texts_of(b, "html"):
                total.update(tag_counts(page))
            known = [(n, i, c) for (n, i), c in total.items() if n in INLINE or n in BLOCK]
            if known:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*known)], ["name", "inside", "n"])

    rows = (pages.select(pages[html_col].alias("html")).mapInArrow(run, "name string, inside long, n long")
            .groupBy("name").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("inside")).alias("inside")).collect())
    return {r.name: max(LEAST, OUTSIDE * (1 - (r.inside + 0.5) / (r.n + 1)) if r.inside < r.n else LEAST)
            for r in rows}


def main_text(page: str, costs: dict[str, float]) -> str:
    """Blocks of the best region, joined by a space."""
    blocks: list[list[str]] = []  # the pieces of each block
    before: list[float] = []  # cost of the tags between the block before and this one
    inner: list[float] = []  # words of the block less the cost of its tags
    cost, fresh = 0.0, True
    for kind, value, hidden, linked in events(page):
        if kind == "tag":
            name = value.lstrip("/")
            cost += 0.0 if hidden else costs.get(name, PRIOR)
            fresh = fresh or name not in INLINE
        elif not hidden:
            words = len(value.split())
            if fresh and not words:
                continue
            if fresh:
                blocks.append([])
                before.append(cost)
                inner.append(0.0)
                fresh = False
            else:
                inner[-1] -= cost
            cost = 0.0
            inner[-1] += 0 if linked is None else -words if linked else words  # links between paragraphs break no article
            blocks[-1].append(value)
    best, best_at, run, begin = 0.0, (0, 0), 0.0, 0
    for i, (gap, own) in enumerate(zip(before, inner)):
        if run - gap <= 0:
            run, begin = own, i
        else:
            run += own - gap
        if run > best:
            best, best_at = run, (begin, i + 1)
    return " ".join(" ".join("".join(b).split()) for b in blocks[best_at[0]: best_at[1]])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of every page row."""
    costs = learn_costs(pages, html_col)

    def run(batches):
        for b in slices(batches, "html"):
            text = pa.array([main_text(p, costs) for p in texts_of(b, "html")], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), text], ["id", "url", "text"])

    kinds = dict(pages.dtypes)
    return (pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
            .mapInArrow(run, f"id {kinds[id_col]}, url {kinds[url_col]}, text string").toDF(id_col, url_col, "text"))
