"""Operator 10: main text of web pages, by their structure and the repeats among the pages of a host."""

from __future__ import annotations

import html as entities
import re
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.fingerprints import mixed
from tillroll.llm.tables import map_batches, table, written
from tillroll.operators.lookup import join_lookup

RUN = 8             # tokens of the shortest repeat
DISTINCT_PAGES = 3  # pages of different content that a repeat must be found on
FRAME_SHARE = 0.5   # share of a host's different articles beyond which a whole block of theirs is a frame

# An article lifts what is around it, but not out of what is sunk, such as a comment or a sidebar.
ARTICLE, OPEN, CHROME, SUNK = 2, 1, 0, -1
# Zones from here on are parts of articles whose name alone does not tell: they are chrome if they are mostly links.
DOUBTFUL = 3
LINKED = 0.5  # share of a doubtful part's characters within links beyond which it is chrome

# HTML's elements and the names that web authors give to what is not main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())  # text up to the end tag
EMBEDDED = frozenset("noscript template iframe object svg math canvas select".split())  # elements without text of the page
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody tfoot thead tr ul".split())
CELLS = frozenset("td th br".split())
SUNK_TAGS = frozenset("nav footer aside head dialog menu".split())
CHROME_TAGS = frozenset("form button fieldset".split())
CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CHROME_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup sidebar menu submenu nav navbar navigation breadcrumb breadcrumbs pagination pager masthead topbar header "
    "footer share sharing social related recommended widget toolbar login search skip".split())
# Names that sections of an article have too.
DOUBTFUL_NAMES = frozenset(
    "header footer menu navigation notice notices notification overlay pager recommended related search share sharing skip "
    "social subscription widget".split())
COMMENT_NAMES = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option".split())

_TAG = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>"""
    r"""|(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}


def _zone(tag: str, attributes: str, outer: int) -> int:
    """The zone of an element within one of zone ``outer``; ``DOUBTFUL`` for a new part that its links decide."""
    if outer == SUNK:
        return SUNK
    found = {}
    if attributes:
        found = {m[1].lower(): (m[2] or "").strip("\"'").lower() for m in _ATTRIBUTE.finditer(attributes)}
    names = set(_NAME.findall(f"{found.get('class', '')} {found.get('id', '')}"))
    role = found.get("role")
    if tag in SUNK_TAGS or "hidden" in found or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "")):
        return SUNK
    if tag in ("body", "html"):
        return outer
    if names & COMMENT_NAMES and tag != "main":
        return SUNK
    if tag in ("article", "main") or role in ("main", "article") or found.get("itemprop") == "articlebody":
        return max(outer, ARTICLE)
    if tag in CHROME_TAGS or role in CHROME_ROLES or tag == "header" and outer < ARTICLE:
        return CHROME
    telling = names & CHROME_NAMES
    if telling and outer >= ARTICLE and telling <= DOUBTFUL_NAMES:
        return max(outer, DOUBTFUL)
    return CHROME if telling else outer


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of the blocks of a page, in page order.

    Markup may be broken or cut off. Character references are decoded, white space within a block becomes one
    space, and empty blocks are left out. A cell of a table and a line break part words, not blocks. Embedded elements
    are left out without parting blocks; without an end tag they reach to that of an element around them.

    Within an article a name such as ``related`` or ``social`` makes a part chrome only if more than ``LINKED`` of its
    characters are in links; a section about related work stays.
    """
    found: list[tuple[int, str]] = []
    parts: list[list[int]] = []  # characters, and those in links, of each doubtful part
    stack: list[tuple[str, int]] = []
    zone, at, buffer = OPEN, 0, []
    embedded = None  # place in the stack of the embedded element that all is in

    def flush() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(buffer))).strip()
        if text:
            found.append((zone, text))
        buffer.clear()

    while at < len(page):
        match = _TAG.search(page, at)
        if embedded is None:
            buffer.append(page[at:match.start() if match else len(page)])
            if zone >= DOUBTFUL:
                size = len(_SPACE.sub("", buffer[-1]))
                parts[zone - DOUBTFUL][0] += size
                parts[zone - DOUBTFUL][1] += size * any(tag == "a" for tag, _ in stack)
        if match is None:
            break
        at = match.end()
        tag = match[2] or match[5]
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(match[1] or match[4])
        if tag in RAW and not closing:
            end = _RAW_ENDS[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        depth = None
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
        if embedded is not None:
            if not closing and tag not in VOID and not _is_empty(match):
                stack.append((tag, zone))
            elif depth is not None and depth >= embedded:
                del stack[depth:]
                embedded = embedded if depth > embedded else None
            if depth is None or depth >= len(stack):
                continue
            embedded = None
        elif tag in EMBEDDED and not closing:
            if not _is_empty(match):
                embedded = len(stack)
                stack.append((tag, zone))
            continue
        if tag in CELLS:
            buffer.append(" ")
        elif tag in BLOCKS:
            flush()
        if tag in VOID:
            continue
        if closing:
            if depth is None:
                continue
            if any(before != zone for _, before in stack[depth:]):
                flush()
            zone = stack[depth][1]
            del stack[depth:]
            continue
        if tag in CLOSED_BY_SAME:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    zone = stack[i][1]
                    del stack[i:]
                    break
                if stack[i][0] in BLOCKS:
                    break
        inner = _zone(tag, match[3] or match[6], zone)
        if inner == DOUBTFUL and zone < DOUBTFUL:
            inner = DOUBTFUL + len(parts)
            parts.append([0, 0])
        if inner != zone:
            flush()
        stack.append((tag, zone))  # what holds again after it
        zone = inner
    flush()
    settled = [CHROME if linked > LINKED * size else ARTICLE for size, linked in parts]
    return [(settled[zone - DOUBTFUL] if zone >= DOUBTFUL else zone, text) for zone, text in found]


def _is_empty(match: re.Match) -> bool:
    """Whether a tag ends in ``/>``."""
    return (match[3] or match[6] or "").rstrip().endswith("/")


def host_of(url: Column) -> Column:
    """The host of an address, lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def run_hashes(tokens: list[str]) -> np.ndarray:
    """One hash per suffix of a block's tokens, cut to its first ``RUN``; a shorter block is one suffix."""
    ids = np.fromiter((xxhash.xxh3_64_intdigest(token) for token in tokens), np.uint64, len(tokens))
    size = min(RUN, len(ids))
    if not size:
        return np.zeros(0, np.int64)
    total = np.full(len(ids) - size + 1, size, np.uint64)
    for shift in range(size):
        total = mixed(total * np.uint64(5) + ids[shift:len(ids) - size + 1 + shift])
    return total.view(np.int64)


def _parsed(batch: dict[str, list]) -> dict[str, list]:
    out = {"text": [], "content": [], "outside": [], "runs": [], "articles": []}
    for page in batch["html"]:
        own = blocks(page or "")
        article = "\n\n".join(text for zone, text in own if zone == ARTICLE)
        is_open = any(zone == OPEN for zone, _ in own)
        outside = [(zone, text) for zone, text in own if zone != ARTICLE]
        content = article or "\n\n".join(text for zone, text in own if zone == OPEN)
        out["text"].append(None if is_open else article)
        out["content"].append(int.from_bytes(blake2b(content.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True))
        out["outside"].append([{"zone": zone, "text": text} for zone, text in own] if is_open else None)
        out["runs"].append(np.concatenate([np.zeros(0, np.int64), *[run_hashes(text.split(" ")) for _, text in outside]]))
        out["articles"].append([_block_hash(text) for zone, text in own if zone == ARTICLE])
    return {**batch, **out, "runs": pa.array(out["runs"], pa.list_(pa.int64()))}


def _block_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def frame_of(texts: list[str], repeats: list[int] | None) -> set[int]:
    """Which blocks of an article are its frame, of those at the places ``repeats``, which its host repeats.

    A block of fewer than ``RUN`` tokens may be a heading. It stays between blocks that stay, and at an edge too unless the
    article has longer repeats, which show that it is framed. Where repeats hold half of the text or more, the page is a variant of others
    instead of framed, and all stays.
    """
    places = set(repeats or ())
    if not places or 2 * sum(len(texts[i]) for i in places) >= sum(map(len, texts)):
        return set()
    own = [i for i in range(len(texts)) if i not in places]
    long = {i for i in places if len(texts[i].split(" ")) >= RUN}
    return long | {i for i in places if long and not own[0] < i < own[-1]}


def _unframed(batch: dict[str, list]) -> dict[str, list]:
    texts = []
    for text, repeats in zip(batch["text"], batch["frame"], strict=True):
        own = text.split("\n\n")
        gone = frame_of(own, repeats)
        texts.append("\n\n".join(one for i, one in enumerate(own) if i not in gone))
    return {**batch, "text": texts}


def _unique_runs(batch: dict[str, list]) -> dict[str, list]:
    """Drop frames of articles and the tokens of open blocks that a repeat covers, keep the others in their blocks."""
    texts = []
    for own, starts, frame in zip(batch["outside"], batch["repeats"], batch["frame"], strict=True):
        found, at, kept = set(starts or ()), 0, []
        places = [i for i, block in enumerate(own) if block["zone"] == ARTICLE]
        gone = {places[i] for i in frame_of([own[i]["text"] for i in places], frame)}
        for i, block in enumerate(own):
            if block["zone"] == ARTICLE:
                kept.append("" if i in gone else block["text"])
                continue
            tokens = block["text"].split(" ")
            suffixes = max(1, len(tokens) - RUN + 1)
            if block["zone"] == OPEN:
                covered = {start + i for start in range(suffixes) if at + start in found for i in range(RUN)}
                kept.append(" ".join(token for i, token in enumerate(tokens) if i not in covered))
            at += suffixes
        texts.append("\n\n".join(text for text in kept if text))
    return {**batch, "text": texts}


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html); null html is empty.

    Elements say what is article and what is not (menus, footers, adverts, forms, comments and so on). Of articles, whole
    blocks go that more than ``FRAME_SHARE`` of the host's different articles hold, see ``frame_of``; other passages that
    articles share stay. Blocks that stand in neither are judged by the host's suffix
    array: the suffixes of the blocks outside articles are brought together by host and first ``RUN`` tokens, and a
    group from ``DISTINCT_PAGES`` pages of different content is a repeat (a shorter block, only whole). A token is in
    a repeat of any greater length just if it is in one of ``RUN``, so suffixes need no more tokens and are grouped
    by a hash of them instead of being sorted: no task holds a host. What repeats cover goes, unique runs stay.
    Pages without a host form one; copies of a page count once. Rows are handled one by one; no rows: no rows.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    prepared = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    parsed = written(map_batches(prepared, _parsed, (
        f"page_id {kind}, url string, host string, text string, content long, "
        "outside array<struct<zone: int, text: string>>, runs array<long>, articles array<long>"
    )).withColumn("row", F.monotonically_increasing_id()))
    repeats = written(
        parsed.select("host", "content", F.explode("runs").alias("run")).distinct()
        .groupBy("host", "run").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= DISTINCT_PAGES)
        .select("host", "run"))
    frames = _frames(parsed)
    open_pages = parsed.filter("outside is not null")
    hits = (
        open_pages.select("row", "host", F.posexplode("runs").alias("at", "run"))
        .join(repeats.hint("merge"), ["host", "run"])
        .groupBy("row").agg(F.collect_list("at").alias("repeats")))
    judged = map_batches(
        join_lookup(open_pages.select("row", "page_id", "url", "outside"), frames, "row", "left").join(
            hits, "row", "left").drop("row"), _unique_runs,
        f"page_id {kind}, url string, text string")
    settled = join_lookup(
        parsed.filter("outside is null").select("row", "page_id", "url", "text"), frames, "row", "left").drop("row")
    framed = map_batches(settled.filter("frame is not null"), _unframed, f"page_id {kind}, url string, text string")
    return settled.filter("frame is null").drop("frame").unionByName(framed).unionByName(judged).withColumn("n_chars", F.length("text").cast("long"))


def _frames(parsed: DataFrame) -> DataFrame:
    """(row, frame): places of the article blocks that most different articles of the page's host hold, a written table."""
    placed = parsed.select("row", "host", "content", F.posexplode("articles").alias("at", "block"))
    pages = parsed.filter(F.size("articles") > 0).select("host", "content").distinct().groupBy("host").agg(
        F.count(F.lit(1)).alias("of"))
    counted = placed.select("host", "content", "block").distinct().groupBy("host", "block").agg(
        F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= DISTINCT_PAGES)
    common = join_lookup(counted, written(pages), "host").filter(F.col("pages") > FRAME_SHARE * F.col("of")).select("host", "block")
    return written(placed.join(written(common).hint("merge"), ["host", "block"]).groupBy("row").agg(
        F.collect_list("at").alias("frame")))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
