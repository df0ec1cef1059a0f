"""Main text of web pages: markup and the host's suffix array, for every page.

Markup comes first: scripts, forms, menus, page headers and footers, side columns, notices, adverts
and reader comments go by element, role, class and id, and an article or main element, where there
is one, holds the text. What markup leaves of a page, article or not, is decided with its host: the
token streams of the host's distinct pages are concatenated with separators, their suffixes are
ordered by prefix doubling, neighbours get their longest common prefix, and a stretch of suffixes
that share ``RUN`` tokens or more is a repeated substring. Those on a large share of the host's
pages are boilerplate. (Every longer repeat lies in such substrings, on as many pages at least, so
these decide which tokens are covered.)

Repetition alone would be wrong both ways: menus and adverts can differ on every page, and articles
share passages that belong to them. So a passage is no boilerplate for being on a few pages of a
large host, and within an article element only whole blocks go, if they are on most pages of a
host that has many. Pages with and without an article are compared among themselves.

A host of more than ``GROUP`` tokens and ``GROUP_PAGES`` pages is dealt into groups by page, each
with a suffix array of its own. A substring on a share of the host's pages is on that share in one of the groups at least, so
the substrings that are frequent in some group are all candidates, and their pages are then counted
in every group of the host.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.common import written

#: Tokens of a long substring, a power of two.
RUN = 8
#: Tokens of a host that share a suffix array, about, and pages at least; memory is some hundred bytes a token.
GROUP, GROUP_PAGES = 1 << 16, 64

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(script|style|noscript|template|iframe|svg|math|textarea|select|title|canvas|object|audio|video)\b[^>]*+(?:(?<=/)>|>.*?(?:</\1\s*+[^>]*+>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>"
    r"|<[/!?a-zA-Z][^>]*+(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset("nav footer aside menu form button fieldset dialog head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words in a class or id that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adblock adbox adcontainer adsbygoogle adsense adslot adunit alert "
    "announcement banner breadcrumb breadcrumbs comment commentlist comments consent cookie cookies copyright discussion "
    "disqus footer gdpr leaderboard login mainnav masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "outbrain overlay pager pagination paywall popup promo promoted promotion promotions recommendations recommended related "
    "replies respond responses share sharing sidebar sidenav signin signup sitenav skyscraper social sponsor sponsored "
    "sponsors submenu subscribe subscription taboola teaser toolbar topbar topnav widget widgets".split()
)
#: Words that turn a mark into a remark about the page's layout.
LAYOUT = frozenset("with has no without enabled layout".split())
MAIN_MARKS = re.compile(r"(?:article|post|entry|story|main)[-_]?(?:body|content|text)", re.I)

#: TITLES: a header within the article, of which headings stay. FORM: out, but for an article in it.
NEUTRAL, MAIN, OUT, TITLES, FORM = 0, 1, 2, 3, 4


def _zone(tag: str, attributes: str, zone: int) -> int:
    """The zone that an element opens inside ``zone``."""
    if zone == OUT and tag != "main" or zone == FORM and tag not in ("article", "main"):
        return zone
    found = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)} if attributes.strip(" /") else {}
    role = found.get("role", "").lower()
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return OUT
    if tag not in ("html", "body", "main"):
        for name in f"{found.get('class', '')} {found.get('id', '')}".split():
            words = {w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", name)}
            marked = words & MARKS
            if marked and not words & LAYOUT and not (marked == {"sidebar"} and "content" in words):
                return OUT
            if "header" in words and not words & LAYOUT:
                return TITLES if zone in (MAIN, TITLES) else OUT
    if role in DROPPED_ROLES:
        return OUT
    if tag in ("article", "main") or role in ("main", "article") or found.get("itemprop") == "articleBody":
        return MAIN
    if tag in DROPPED:
        return FORM if tag == "form" else OUT
    if tag == "header":
        return TITLES if zone in (MAIN, TITLES) else OUT
    if zone == TITLES and tag in HEADINGS:
        return MAIN
    if zone == NEUTRAL and MAIN_MARKS.fullmatch(found.get("class", "").strip() or found.get("id", "")):
        return MAIN
    return zone


def blocks(html: str) -> tuple[bool, list[str], list[float]]:
    """Whether markup names the article; its blocks, or else all that are not ruled out; their share of link text."""
    stack: list[tuple[str, int]] = []
    open_tags: Counter[str] = Counter()  # what is on the stack: an end tag without a start costs no search
    parts: dict[int, list[list]] = {MAIN: [], NEUTRAL: []}  # per zone: [text pieces, letters in links, letters]
    zone, links, fresh, at = NEUTRAL, 0, True, 0

    def text(piece: str) -> None:
        nonlocal fresh
        if zone not in parts or not piece:
            return
        rows = parts[zone]
        if fresh or not rows:
            rows.append([[], 0, 0])
            fresh = False
        rows[-1][0].append(piece)
        rows[-1][1] += len(piece) if links else 0
        rows[-1][2] += len(piece)

    for m in TOKEN.finditer(html):
        if m.start() > at:
            text(html[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            while open_tags[tag]:
                closed, before = stack.pop()
                open_tags[closed] -= 1
                links -= closed == "a"
                if closed == tag:
                    zone = before
                    break
        elif tag not in VOID and not m[4].endswith("/"):
            stack.append((tag, zone))
            open_tags[tag] += 1
            links += tag == "a"
            zone = _zone(tag, m[4], zone)
        if tag not in INLINE:
            fresh = True
    text(html[at:])
    chosen, share = [], []
    named = any(not p.isspace() for pieces, _, _ in parts[MAIN] for p in pieces)
    for pieces, in_links, size in parts[MAIN if named else NEUTRAL]:
        block = " ".join(unescape("".join(pieces)).split())
        if block:
            chosen.append(block)
            share.append(in_links / size)
    return named, chosen, share


def suffix_keys(tokens: np.ndarray, run: int = RUN) -> np.ndarray:
    """A key for each suffix of ``tokens`` with at least ``run`` left: equal if their first ``run`` agree.

    Prefix doubling: keys of 2k tokens come from the keys of k tokens at a place and k further on.
    """
    keys = tokens.astype(np.uint64)
    size = 1
    with np.errstate(over="ignore"):
        while size < run:
            if len(keys) <= size:
                return keys[:0]
            left, right = keys[:-size], keys[size:]
            keys = (left ^ (left >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + right * np.uint64(0x94D049BB133111EB)
            keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
            size *= 2
    return keys


def token_stream(blocks_of_page: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w.encode()) for b in blocks_of_page for w in b.split()], np.uint64)


def without_repeats(blocks_of_page: list[str], repeated: np.ndarray, run: int = RUN) -> list[str]:
    """Blocks less those that repeated substrings cover for the most part; unique runs of them stay.

    ``repeated`` are places in the page's token stream where a repeated substring of ``run``
    tokens begins. A page that would lose everything keeps everything.
    """
    sizes = [len(b.split()) for b in blocks_of_page]
    covered = np.zeros(sum(sizes) + 1, np.int64)
    for shift in range(run if len(repeated) else 0):
        covered[np.minimum(repeated + shift, len(covered) - 1)] = 1
    kept, at = [], 0
    for block, n in zip(blocks_of_page, sizes):
        gone = covered[at : at + n] > 0
        at += n
        if 2 * gone.sum() <= n:
            kept.append(block)
            continue
        words = np.array(block.split(), object)
        for part in np.split(np.arange(n), np.flatnonzero(np.diff(gone)) + 1):
            if not gone[part[0]] and len(part) >= run:
                kept.append(" ".join(words[part]))
    return kept or blocks_of_page


def without_notices(blocks_of_page: list[str], repeated: np.ndarray, run: int = RUN) -> list[str]:
    """Blocks of an article less those that repeated substrings cover whole.

    An article that would lose over half of its tokens is a near copy of others and keeps everything.
    """
    sizes = np.array([len(b.split()) for b in blocks_of_page])
    covered = np.zeros(sizes.sum() + 1, np.int64)
    for shift in range(run):
        covered[np.minimum(repeated + shift, len(covered) - 1)] = 1
    gone = np.add.reduceat(covered[:-1], np.cumsum(sizes) - sizes) == sizes
    if 2 * sizes[gone].sum() > sizes.sum():
        return blocks_of_page
    return [b for b, g in zip(blocks_of_page, gone) if not g]


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of ``tokens`` in order, and each one's longest common prefix with the one before.

    Prefix doubling: suffixes ordered by 2k tokens come from the ranks by k tokens at a place and k
    further on. Only suffixes whose rank is shared are ordered again. Ranks of each round stay, as
    two suffixes have 2**j tokens in common where their ranks of round j agree.
    """
    n = len(tokens)
    order = np.argsort(tokens, kind="stable")
    rank = np.empty(n + 1, np.int32)
    rank[n] = -1  # the empty suffix, before all others
    new = np.ones(n, bool)
    new[1:] = tokens[order[1:]] != tokens[order[:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = first
    rounds, size = [rank.copy()], 1
    slots = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(slots):
        open_ = order[slots]
        own, further = rank[open_].astype(np.int64), rank[np.minimum(open_ + size, n)].astype(np.int64)
        keys = own * (n + 1) + further + 1
        by = np.argsort(keys, kind="stable")
        open_, keys = open_[by], keys[by]
        order[slots] = open_
        new = np.ones(len(slots), bool)
        new[1:] = keys[1:] != keys[:-1]
        rank[open_] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        slots = slots[~(new & np.append(new[1:], True))]
        size *= 2
        rounds.append(rank.copy())
    common = np.zeros(n, np.int64)
    left, right = order[:-1].copy(), order[1:].copy()
    for j in range(len(rounds) - 1, -1, -1):
        same = np.flatnonzero(rounds[j][left] == rounds[j][right])
        same = same[(left[same] < n) & (right[same] < n)]
        common[same + 1] += 1 << j
        left[same] = np.minimum(left[same] + (1 << j), n)
        right[same] = np.minimum(right[same] + (1 << j), n)
    return order, common


def repeats(pages: list[list[str]], groups: np.ndarray, least: np.ndarray, run: int = RUN):
    """Where substrings of ``run`` tokens begin that are on ``least[g]`` pages of their group g or more.

    ``pages`` are blocks, ``groups`` the group of each, ascending from 0. Returns the page and the
    place in it of each, in page order, and a key of the substring.
    """
    words = pc.list_flatten(pc.split_pattern(pa.array([" ".join(b) for b in pages], pa.large_string()), " ")).dictionary_encode()
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.array([sum(b.count(" ") + 1 for b in p) for p in pages])
    known = len(words.dictionary)
    # A separator of its own ends each page, and groups share no token.
    page = np.repeat(np.arange(len(pages)), sizes + 1)
    ends = np.cumsum(sizes + 1) - 1
    inside = np.ones(len(page), bool)
    inside[ends] = False
    stream = np.empty(len(page), np.int64)
    stream[inside] = codes + groups[page[inside]] * known
    stream[ends] = known * (groups[-1] + 1) + np.arange(len(pages))
    order, common = suffix_array(stream)
    stretch = np.cumsum(common < run) - 1
    at = page[order]
    whole = order + run <= ends[at]
    held = np.unique(stretch[whole] * len(pages) + at[whole])
    count = np.bincount(held // len(pages), minlength=stretch[-1] + 1)
    found = np.sort(order[whole & (count[stretch] >= least[groups[at]])])
    hashes = np.zeros(len(page), np.uint64)
    if len(found):
        hashes[inside] = token_stream(words.dictionary.to_pylist())[codes]
    keys = suffix_keys(hashes, run).view(np.int64)
    return page[found], (found - (ends - sizes)[page[found]]).astype(np.int32), keys[found]


def main_text(
    pages: DataFrame, run: int = RUN, min_pages: int = 2, min_share: float = 0.3, article_pages: int = 20, article_share: float = 0.5,
    group: int = GROUP, group_pages: int = GROUP_PAGES,
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (page_id, url, html).

    White space within a block is one space, blocks are joined by one space in page order. A null
    or empty html has an empty text. Pages without a host (null or odd url) count as one host. Pages
    with the same text left by markup count as one page, so copies are no boilerplate of each other.
    Rows that repeat a page_id are returned each; null ids are kept. An empty table gives an empty
    table; other columns are ignored. A substring of ``run`` tokens
    is boilerplate if it is on ``min_pages`` distinct pages of its host (2 or more) that are
    ``min_share`` of them or more; within articles, on ``article_pages`` that are ``article_share``.
    """
    if min(min_pages, article_pages) < 2 or run & (run - 1):
        raise ValueError("substrings are boilerplate from two pages on, and their length is a power of two")
    limits = {False: (min_pages, min_share), True: (article_pages, article_share)}

    def parse(batches):
        seen = set()
        pack = zstandard.ZstdCompressor().compress
        for batch in batches:
            left, kind, page, sizes, fresh = [], [], [], [], []
            for html, host in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist()):
                named, found, share = blocks(html or "")
                if not named:
                    # Blocks of links are menus.
                    found = [b for b, s in zip(found, share) if s < 0.6]
                lines = "\n".join(found).encode()
                left.append(pack(lines))
                kind.append(named)
                page.append(xxhash.xxh64_intdigest(lines) - (1 << 63))
                sizes.append(sum(b.count(" ") + 1 for b in found))
                # Copies in a partition go once into the suffix array.
                fresh.append(bool(found) and (host, named, page[-1]) not in seen)
                seen.add((host, named, page[-1]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)), pa.array(kind, pa.bool_()), pa.array(left, pa.binary()),
                    pa.array(page, pa.int64()), pa.array(sizes, pa.int64()), pa.array(fresh, pa.bool_()),
                ],
                names=["page_id", "url", "host", "named", "packed", "page", "size", "fresh"],
            )

    def unpack(packed: bytes) -> list[str]:
        lines = zstandard.ZstdDecompressor().decompress(packed).decode()
        return lines.split("\n") if lines else []

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.make_valid_utf8(F.col("url").cast("string")).alias("url"),
        F.make_valid_utf8(F.col("html").cast("string")).alias("html"),
    )
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)", 1))
    parsed = rows.select("page_id", "url", host.alias("host"), "html").mapInArrow(
        parse, "page_id long, url string, host string, named boolean, packed binary, page long, size long, fresh boolean"
    )
    parsed = written(parsed, "parsed-pages")
    site = ["host", "named"]
    fresh = parsed.filter("fresh")
    hosts = fresh.groupBy(*site, "page").agg(F.max("size").alias("size")).groupBy(*site).agg(F.count("*").alias("of"), F.sum("size").alias("size"))
    parts = F.least(F.ceil(F.col("size") / group), F.ceil(F.col("of") / group_pages)).alias("parts")
    hosts = written(hosts.select(*site, "of", parts), "hosts")
    # At most one host for each `group` tokens of input.
    large = F.broadcast(hosts.filter("parts > 1").select(F.col("host").alias("_h"), F.col("named").alias("_n"), "parts"))
    of_large = (F.col("host") == F.col("_h")) & (F.col("named") == F.col("_n"))
    streams = fresh.join(large, of_large, "left").select(
        *site, F.expr("coalesce(pmod(page, parts), 0)").alias("part"), "page", "packed", F.col("parts").isNull().alias("whole")
    )

    def frequent(batches):
        def solve(held):
            group_of = np.cumsum([i > 0 and held[i][:3] != held[i - 1][:3] for i in range(len(held))])
            first = np.flatnonzero(np.diff(group_of, prepend=-1))
            least = []
            for i, n in zip(first, np.bincount(group_of)):
                pages_, share = limits[held[i][1]]
                # A part of a host answers for its share only; a little less does no harm to candidates.
                least.append(max(pages_, share * n) if held[i][5] else max(1, share * n - 1e-6))
            at, place, key = repeats([r[4] for r in held], group_of, np.array(least), run)
            pages_at, part_at = (np.flatnonzero(np.diff(x, prepend=-1)) for x in (at, group_of[at]))
            out = [(*held[at[i]][:2], held[at[i]][3], p, None) for i, p in zip(pages_at, np.split(place, pages_at[1:])) if held[at[i]][5]]
            out += [(*held[at[i]][:2], None, None, np.unique(k)) for i, k in zip(part_at, np.split(key, part_at[1:])) if not held[at[i]][5]]
            cols = list(zip(*out)) or [()] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.bool_(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())))],
                names=["host", "named", "page", "places", "keys"],
            )

        held, tokens = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if held and row[:4] == held[-1][:4]:
                    continue
                if tokens >= group and row[:3] != held[-1][:3]:
                    yield solve(held)
                    held, tokens = [], 0
                held.append((*row[:4], unpack(row[4]), row[5]))
                tokens += sum(b.count(" ") + 1 for b in held[-1][4])
        if held:
            yield solve(held)

    dealt = streams.repartition(*site, "part").sortWithinPartitions(*site, "part", "page")
    found = written(dealt.mapInArrow(frequent, "host string, named boolean, page long, places array<int>, keys array<long>"), "repeated-substrings")

    # Candidates of large hosts, counted in all their parts: each part gets them in a row before its pages.
    candidates = found.filter("page is null").select(*site, F.explode("keys").alias("key")).groupBy(*site).agg(F.collect_set("key").alias("keys"))
    candidates = written(candidates, "candidates")
    asked = candidates.join(large, of_large).select(
        *site, F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), F.lit(None).cast("long").alias("page"),
        F.lit(None).cast("binary").alias("packed"), "keys",
    )
    searched = streams.filter("not whole").join(F.broadcast(candidates.select(*site)), site, "left_semi")
    searched = searched.select(*site, "part", "page", "packed", F.lit(None).cast("array<long>").alias("keys"))

    def search(batches):
        keys, last = None, None
        for batch in batches:
            out = []
            for h, named, _, page, packed, asked_ in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if page is None:
                    keys, last = np.array(asked_, np.int64), None
                elif page != last:
                    last = page
                    own = suffix_keys(token_stream(unpack(packed)), run).view(np.int64)
                    places = np.flatnonzero(np.isin(own, keys))
                    if len(places):
                        out.append((h, named, page, places.astype(np.int32), own[places]))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.bool_(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())))],
                names=["host", "named", "page", "places", "keys"],
            )

    both = asked.unionByName(searched).repartition(*site, "part").sortWithinPartitions(*site, "part", "page")
    places = written(both.mapInArrow(search, "host string, named boolean, page long, places array<int>, keys array<long>"), "places")
    counted = places.select(*site, F.explode(F.array_distinct("keys")).alias("key")).groupBy(*site, "key").agg(F.count("*").alias("n"))
    enough = F.when(F.col("named"), (F.col("n") >= article_pages) & (F.col("n") >= F.lit(article_share) * F.col("of"))).otherwise(
        (F.col("n") >= min_pages) & (F.col("n") >= F.lit(min_share) * F.col("of"))
    )
    shared = written(counted.join(hosts, site).filter(enough).select(*site, "key"), "shared-substrings")
    marked = (
        places.select(*site, "page", F.explode(F.arrays_zip("keys", "places")).alias("x"))
        .select(*site, "page", F.col("x.keys").alias("key"), F.col("x.places").alias("place"))
        .join(shared, [*site, "key"]).groupBy(*site, "page").agg(F.collect_list("place").alias("places"))
    )
    marked = written(marked.unionByName(found.filter("page is not null").select(*site, "page", "places")), "repeats")

    def remove(batches):
        for batch in batches:
            texts = []
            for named, packed, at in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                left = unpack(packed)
                if at:
                    left = (without_notices if named else without_repeats)(left, np.array(at, np.int64), run)
                texts.append(" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    out = parsed.join(marked, [*site, "page"], "left").select("page_id", "url", "named", "packed", "places")
    return out.mapInArrow(remove, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
