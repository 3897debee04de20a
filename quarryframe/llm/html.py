"""Operator 9: main text of web pages by consensus paths of each host.

Pass one scores the containers of each page by the net length of their text blocks and lets every page vote, with the score's
share, for the containers' generalised paths (tags with classes, digits folded). Votes are summed for each host in Spark. Pass
two parses again and takes the containers at that of the page's paths which its host voted for most.

A host's strong paths (1/50 of its votes and more, so 50 at most) travel with its pages. Only pages that have none of them go on to
a join of their own paths with the votes, and are then parsed a third time; so the choice is the same as if all paths of the host
were compared. Parsing only moves forward through the page, and elements are nested 512 deep at most, as in browsers.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import chunks, cut

#: Elements that hold no article text, and words of classes, ids and roles that mark such containers.
SKIPPED = frozenset("head title nav footer aside form menu dialog iframe object svg math button select option textarea input label fieldset noscript template canvas audio video map script style".split())
MARKS = (
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "sidebar side rail widget widgets menu nav navbar navigation breadcrumb breadcrumbs toc pagination pager header masthead topbar footer bottom copyright legal comment comments "
    "reply replies respond disqus discussion related recommended recommendations share sharing social newsletter subscribe subscription signup login search skip toolbar tags meta byline complementary contentinfo"
)
#: Parts of a name that say what a container has or how it is laid out, so that the words after them mark nothing.
_UNMARKED = r"(?!(?:has|with|no|without|not|layout)[-_]|side[-_]by[-_]side|(?:post|entry|article|story)[-_]+header|elementor[-_]+widget)"
_MARKED = re.compile(r"(?:^|\s)(?:" + _UNMARKED + r"[a-z0-9]++[-_]++){0,3}?" + _UNMARKED + "(?:" + "|".join(MARKS.split()) + r")(?:[-_][a-z0-9_-]*|\d*)?(?=\s|$)")
#: Of a leaf (paragraph, item, heading) the last part of a name has to be the mark.
_MARKED_LEAF = re.compile(r"(?:^|\s)(?:" + _UNMARKED + r"[a-z0-9]++[-_]++){0,3}?" + _UNMARKED + "(?:" + "|".join(MARKS.split()) + r")\d*(?=\s|$)")
#: Marked containers whose articles are not the page's own.
_OTHERS = re.compile(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies)|respond|disqus|discussion|related|recommended|recommendations|ads?|adverts?|advertisement|sponsor(?:ed)?|promo|promotion)(?=[\s_-]|$)")
CONTAINERS = frozenset("html body div section article main table tbody thead tfoot tr td th ul ol dl center figure details header content".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote address figcaption caption summary hr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
WHOLE = frozenset("html body article main".split())
RAW = frozenset("script style noscript template textarea iframe".split())
_OPEN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_STEP = re.compile(r"[>\"']")
_LONG_NUMBER = re.compile(r"&#0*([0-9]{8,});?")
#: What an element ends besides an open p.
_ENDS = {"li": ("li",), "td": ("td",), "tr": ("tr",), "dt": ("dt", "dd"), "dd": ("dd", "dt")}
DEEPEST = 512
PATH_CHARS = 400
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.I)
_DIGITS = re.compile(r"\d+")
LEAST_SHARE = 50  # a path with 1/50 of its host's votes is strong: at most 50 for each host


def tokens(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, lowered tag, is end tag, attributes) of each tag; tag "" for comments, raw elements and declarations.

    Each search begins where the last one ended. A `<` that no `>` follows is text. A quote after `=` hides the `>` up to its fellow; if a
    tag's quotes leave it open until the end of the page, quotes do not pair in this page, and from there on tags end at the next `>`.
    """
    lowered, last_end, paired, at = None, page.rfind(">"), True, 0
    while opened := _OPEN.search(page, at):
        start, tag = opened.start(), (opened[2] or "").lower()
        if opened[0] == "<!--":
            end = page.find("-->", opened.end() - 2)
            at = end + 3 if end >= 0 else len(page)
            yield start, at, "", False, ""
            continue
        if start > last_end:
            return
        if not tag:
            at = page.find(">", start) + 1
            yield start, at, "", False, ""
            continue
        end, inside = -1, opened.end()
        while paired and (step := _STEP.search(page, inside)):
            if step[0] == ">":
                end = step.start()
                break
            inside = step.end()
            if page[opened.end() : step.start()].rstrip()[-1:] == "=" if step.start() - opened.end() < 64 else page[step.start() - 64 : step.start()].rstrip()[-1:] == "=":
                close = page.find(step[0], inside)
                if close < 0:
                    break
                inside = close + 1
        if end < 0:
            paired = False
            end = page.find(">", opened.end())
        at, attributes = end + 1, page[opened.end() : end]
        if not opened[1] and (tag in RAW or tag == "svg") and not (tag == "svg" and attributes.endswith("/")):
            if lowered is None:
                lowered = page.lower() if len(page.lower()) == len(page) else re.sub("[A-Z]+", lambda m: m[0].lower(), page)
            close = lowered.find(f"</{tag}", at)
            while close >= 0 and lowered[close + len(tag) + 2 : close + len(tag) + 3] not in ("", ">", "/", " ", "\t", "\n", "\r", "\f"):
                close = lowered.find(f"</{tag}", close + 1)
            shut = page.find(">", close) if close >= 0 else -1
            at = shut + 1 if shut >= 0 else len(page)
            yield start, at, "", False, ""
            continue
        yield start, at, tag, bool(opened[1]), attributes


def decode(piece: str) -> str:
    """Character references; numbers beyond Unicode (however long) are the replacement character."""
    return html.unescape(_LONG_NUMBER.sub("\ufffd", piece)) if "&" in piece else piece


def parse(page: str, marks: bool = True) -> tuple[list[tuple[str, int, int]], list[tuple[int, str, str]]]:
    """(blocks, nodes). A block: text, characters of it inside links, its container; a node: its parent, its generalised path (a digest
    of it, if it is long), its tag.

    Missing end tags are repaired as browsers do for the common cases: a block ends an open p, an item the one before. An article
    or main element in a container that is skipped for its mark is not skipped with it. Without `marks` no class, id or role
    marks a container, and forms are read. Marks hold for containers; of a paragraph, item or heading only if the last part of a name
    is a mark ("social-share", not "share-price").
    """
    blocks: list[tuple[str, int, int]] = []
    nodes: list[tuple[int, str, str]] = [(-1, "", "")]
    stack: list[tuple[str, int, int]] = []  # tag, node at this depth, skipped (1: for a mark that does not hold for an article inside)
    buffer: list[str] = []
    is_open: Counter[str] = Counter()  # how many of each tag the stack has
    node, skipping, links, link_chars, at = 0, 0, 0, 0, 0

    def flush() -> None:
        nonlocal link_chars
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                blocks.append((text, min(link_chars, len(text)), node))
            buffer.clear()
        link_chars = 0

    def leave(depth: int) -> None:
        nonlocal node, skipping, links
        for x in stack[depth:]:
            is_open[x[0]] -= 1
        links = is_open["a"]
        del stack[depth:]
        node, skipping = (stack[-1][1], stack[-1][2]) if stack else (0, 0)

    def text_until(end: int) -> None:
        nonlocal link_chars
        if end > at and not skipping:
            piece = decode(page[at:end])
            buffer.append(piece)
            if links:
                link_chars += len(piece)

    for start, end, tag, closing, attributes in tokens(page):
        text_until(start)
        at = end
        if not tag or tag in ("svg", "math") and attributes.endswith("/"):
            continue
        container = tag in CONTAINERS
        block = container or tag in LEAVES or tag in SKIPPED
        if block:
            flush()
        if closing:
            for depth in range(len(stack) - 1 if is_open[tag] else -1, -1, -1):
                if stack[depth][0] == tag:
                    leave(depth)
                    break
                if not (container or tag in SKIPPED) and stack[depth][0] in CONTAINERS:
                    break
            continue
        if block and tag != "br":
            ends = ("p", *_ENDS.get(tag, ()))
            for depth in range(len(stack) - 1 if any(is_open[x] for x in ends) else -1, -1, -1):
                open_tag = stack[depth][0]
                if open_tag in ends:
                    leave(depth)
                    break
                if open_tag in CONTAINERS:
                    break
        if tag in VOID or attributes.endswith("/") and not block:
            continue
        below, skip = node, skipping
        if skip == 1 and tag in ("article", "main") and not (is_open["article"] or is_open["main"]):
            skip = 0
        if not skip and (container or tag in SKIPPED or tag in LEAVES):
            found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
            if tag in SKIPPED and (marks or tag != "form") or tag == "header" and not (is_open["article"] or is_open["main"]):
                skip = 2
            if marks and found and tag not in WHOLE and not skip and any((_MARKED_LEAF if tag in LEAVES else _MARKED).search(v) for v in found.values()):
                skip = 2 if any(_OTHERS.search(v) for v in found.values()) else 1
            if attributes and skip < 2 and _HIDDEN.search(re.sub(r"=\s*(\"[^\"]*\"|'[^']*')", lambda m: m[0] if "none" in m[0] else "", attributes)):
                skip = 2
            if marks and tag in WHOLE and found and re.search(r"(?:^|[\s_-])(?:comments?|reply|ad|ads|related|promo|teaser)(?=[\s_-]|$)", found.get("class", "") + " " + found.get("id", "")) and tag == "article":
                skip = 2
            if container and not skip:
                classes = ".".join(sorted(_DIGITS.sub("0", found.get("class", "")).split()))
                above = node if len(stack) < DEEPEST else stack[-2][1]  # deeper elements lie beside each other
                path = f"{nodes[above][1]}/{tag}" + (f".{classes}" if classes else "")
                nodes.append((above, path if len(path) <= PATH_CHARS else "#" + hashlib.blake2b(path.encode("utf-8", "replace"), digest_size=16).hexdigest(), tag))
                below = len(nodes) - 1
        if len(stack) >= DEEPEST:
            is_open[stack.pop()[0]] -= 1
        stack.append((tag, below, skip))
        is_open[tag] += 1
        links = is_open["a"]
        node, skipping = below, skip
    text_until(len(page))
    flush()
    return blocks, nodes


def parse_or_all(page: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, str, str]]]:
    """`parse`; if the marks leave nothing of the page, without them."""
    blocks, nodes = parse(page)
    return (blocks, nodes) if blocks else parse(page, marks=False)


def container_scores(blocks: list[tuple[str, int, int]], nodes: list[tuple[int, str, str]]) -> dict[str, int]:
    """Path -> its share, in thousandths, of the page's net text; nearer containers count more, article and main most."""
    score: dict[str, float] = {}
    for text, link_chars, node in blocks:
        net, weight, seen = len(text) - 2 * link_chars, 1.0, set()
        if net <= 0:
            continue
        while node > 0:
            parent, path, tag = nodes[node]
            if path not in seen:
                seen.add(path)
                score[path] = score.get(path, 0.0) + net * (1.2 if tag in ("article", "main") else weight)
            weight, node = weight * 0.6, parent
    total = sum(score.values())
    return {path: int(1000 * x / total) for path, x in score.items() if 1000 * x >= total} if total else {}


def _best(scores: dict[str, int]) -> str | None:
    return min(scores, key=lambda p: (-scores[p], p), default=None)


def take(blocks: list[tuple[str, int, int]], nodes: list[tuple[int, str, str]], path: str) -> str:
    """All blocks below containers at `path`, in page order."""
    inside = [False] * len(nodes)
    for i, (parent, own, _) in enumerate(nodes):
        inside[i] = own == path or parent >= 0 and inside[parent]
    return "\n".join(text for text, _, node in blocks if inside[node])


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, column="html"):
        votes: dict[tuple[str, str], int] = {}
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            for path, share in container_scores(*parse_or_all(page)).items() if page else ():
                votes[host, path] = votes.get((host, path), 0) + share
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in votes], pa.string()), pa.array([k[1] for k in votes], pa.string()), pa.array(list(votes.values()), pa.int64())], names=["host", "path", "votes"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts by the first of `paths` (the host's strong ones, best first) that the page has. `own`: the paths that the page itself votes
    for, if it has none of them; its text is still to be taken then."""
    for batch in chunks(batches, column="html"):
        texts, own = [], []
        for page, paths in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist()):
            text, mine = "", None
            if page:
                blocks, nodes = parse_or_all(page)
                there = {nodes[n][1] for n in _with_ancestors({b[2] for b in blocks}, nodes)}
                path = next((p for p in paths or () if p in there), None)
                if path:
                    text = take(blocks, nodes, path)
                else:
                    mine = list(container_scores(blocks, nodes)) or None
                    text = "" if mine else "\n".join(b[0] for b in blocks)
            texts.append(text)
            own.append(mine)
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), batch.column("host"), batch.column("row"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(own, pa.list_(pa.string()))],
            names=["page_id", "url", "host", "row", "text", "n_chars", "own"],
        )


def _extract_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of pages at the given path of theirs."""
    for batch in chunks(batches, column="html"):
        texts = [take(*parse_or_all(page), path) for page, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def _with_ancestors(some: set[int], nodes: list[tuple[int, str, str]]) -> set[int]:
    out: set[int] = set()
    for n in some:
        while n > 0 and n not in out:
            out.add(n)
            n = nodes[n][0]
    return out


def path_votes(pages: DataFrame) -> DataFrame:
    """(host, html) -> host, path, votes."""
    return pages.mapInArrow(_vote, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))


def strong_paths(votes: DataFrame) -> DataFrame:
    """Votes -> host, paths: those with at least 1/50 of the host's votes, best first (ties: by path)."""
    whole = votes.groupBy("host").agg(F.sum("votes").alias("all"))
    strong = votes.join(whole, "host").where(F.col("votes") * LEAST_SHARE >= F.col("all"))
    ranked = strong.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path"))).alias("ranked"))
    return ranked.select("host", F.transform("ranked", lambda x: x["path"]).alias("paths"))


def main_text(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) -> page_id, url, text, n_chars.

    Blocks in page order, joined by one \\n; inside a block white space is one space. Null or empty html: empty text. Pages whose
    url is null or has no host vote as one host. Ties of votes go to the path that sorts first. Repeated rows vote each and are
    each returned; other columns are ignored; an empty table gives an empty result. A host may hold any share of the pages: its
    votes are summed map-side.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"))
    slim = slim.withColumn("row", F.xxhash64("page_id", "url", "html"))
    # Written, so that the join knows the size: few strong paths are sent to the pages, and the pages are not shuffled.
    votes = cut(path_votes(slim.select("host", "html")))
    paths = cut(strong_paths(votes))
    fields = "page_id long, url string, host string, row long, text string, n_chars long, own array<string>"
    first = cut(slim.join(paths, "host", "left").select("page_id", "url", "host", "row", "html", "paths").mapInArrow(_extract, fields))
    done = first.where("own is null").select("page_id", "url", "text", "n_chars")
    open_pages = first.where("own is not null").select("row", "host", F.explode("own").alias("path")).distinct()
    if not open_pages.limit(1).count():
        return done
    best = open_pages.join(votes, ["host", "path"]).groupBy("row").agg(F.min(F.struct((-F.col("votes")).alias("v"), "path"))["path"].alias("path"))
    rest = slim.join(cut(best), "row").select("page_id", "url", "html", "path")
    return done.unionByName(rest.mapInArrow(_extract_at, "page_id long, url string, text string, n_chars long"))
