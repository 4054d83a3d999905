"""Main text of HTML pages, with nearest-URL page differencing.

Pages are cut into text blocks (lines).  Pages are sorted by URL path within their host
(a range sort: a host may hold any share of the pages), each is paired with the
neighbour whose path is nearer, the two sequences of lines are aligned by longest
common subsequence, and shared lines are deleted.

Differencing alone would delete article text that two pages share, and keep what
differs in menus and adverts.  So the lines of the page's longest article or main
element are never deleted, and its other lines take part in the alignment but go
in any case, unless they are in another article element: those go where the partner
has them too.  Elements that are boilerplate by their tag, class, id or role go on
every page.  Pages without an article element keep what differs; one that has nearly
nothing for itself is a copy of its partner, or a part of it, and keeps everything.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Fixed sets of element names.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav noscript ol option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split())
SKIP_TAGS = frozenset(
    "aside button canvas datalist dialog footer form head iframe input label math menu nav noscript object select svg "
    "template textarea title".split())
RAW_TAGS = ("script", "style")
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN_TAGS = frozenset(("article", "main"))
TRACKED_TAGS = SKIP_TAGS | MAIN_TAGS | frozenset("div section header ul ol table blockquote body p span figure".split()) - VOID_TAGS
#: Parts of class and id names that mark boilerplate, and parts that say nothing by themselves.
SKIP_PARTS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion promoted banner banners "
    "cookie cookies consent gdpr notice notices alert alerts sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer "
    "masthead siteheader pageheader topbar toolbar comment comments commentlist disqus reply replies respond related recommended "
    "recommendation recommendations share sharing social newsletter newsletters subscribe subscription signup login search popup popups modal overlay "
    "widget widgets pagination pager complementary contentinfo hidden".split())
PLAIN_PARTS = frozenset(
    "site page global main primary secondary mobile desktop top bottom left right upper lower inner outer side bar box boxes block area "
    "wrap wrapper container section group panel slot unit list lists item items link links button buttons icon icons row col column grid text "
    "title header heading head content form field inline sticky fixed small large bg posts articles stories news card cards tools media zone".split())
#: Compounds of plain parts that mark boilerplate outside of the article.
SKIP_NAMES = frozenset("site-header page-header side-bar top-bar".split())
#: Elements that hold other elements: inside an article only those are boilerplate by their names.
HOLDERS = frozenset("div section ul ol table figure".split())
_MARK = re.compile(r"""\s(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"""\s(?:hidden(?=[\s=/>]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_MAIN_ROLE = re.compile(r"""\srole\s*=\s*["']?main""", re.I)
_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[a-zA-Z/!?][^>]*(?:>|$)", re.S | re.I)


#: Elements whose text no reader sees as lines of the page.
UNSEEN_TAGS = frozenset("canvas datalist head iframe math object select svg template textarea title".split())
#: Where a line stands: in a boilerplate element, outside the article elements, or in article element number 0, 1, ...
SKIPPED, OUTSIDE = -2, -1
#: Bits of one table of alignment rows; larger alignments are halved first.
TABLE_BITS = 64 << 20
#: A page without an article element is a copy of its partner if the lines that it has for itself hold fewer letters: a time, a counter.
COPY_LETTERS = 12


def marked(names: str, in_article: bool = False) -> bool:
    """Whether one of the names in a class, id or role value marks boilerplate.

    A name does as a whole: each of its parts must be a word for boilerplate or say nothing, and one must be
    such a word.  So "share-buttons" does, "share-price-analysis" doesn't.
    """
    for name in names.split():
        parts = [p.lower() for p in _PARTS.findall(name)]
        if any(p in SKIP_PARTS for p in parts) and all(p in SKIP_PARTS or p in PLAIN_PARTS for p in parts):
            return True
        if not in_article and "-".join(parts) in SKIP_NAMES:
            return True
    return False


def page_lines(page: str | None) -> list[tuple[str, int]]:
    """(text, where it stands) of the blocks of a page, in page order."""
    lines: list[tuple[str, int]] = []
    stack: list[tuple[str, bool, bool]] = []
    open_: dict[str, int] = {}  # elements on the stack by name: an end tag without a start needs no search
    skip = main = unseen = n_mains = at = 0
    parts: list[str] = []
    skipped: list[str] = []

    def flush() -> None:
        for buffer, where in ((parts, n_mains - 1 if main else OUTSIDE), (skipped, SKIPPED)):
            if buffer:
                text = " ".join(html.unescape("".join(buffer)).split())
                buffer.clear()
                if text:
                    lines.append((text, where))

    def close(i: int) -> None:
        nonlocal skip, main, unseen
        for name, s, a in stack[i:]:
            skip -= s
            main -= a
            unseen -= name in UNSEEN_TAGS
            open_[name] -= 1
        del stack[i:]

    page = page or ""
    for m in _TAG.finditer(page):
        if not unseen and m.start() > at:
            (skipped if skip else parts).append(page[at : m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        block = name in BLOCK_TAGS
        if block:
            flush()
        if m[2]:  # an end tag closes back to its start, if that is open
            if open_.get(name):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        close(i)
                        break
            continue
        if block and stack and stack[-1][0] == "p":  # a paragraph ends where a block starts
            close(len(stack) - 1)
        if name in VOID_TAGS or name not in TRACKED_TAGS or m[4].endswith("/") and name not in BLOCK_TAGS:
            continue
        rest = m[4]
        is_main = name in MAIN_TAGS
        is_skip = name in SKIP_TAGS or (name == "header" and not main)
        if len(rest) > 3:
            is_main = is_main or bool(_MAIN_ROLE.search(rest))
            if not is_skip and name != "body":
                is_skip = bool(_HIDDEN.search(rest)) or (not main or name in HOLDERS) and any(marked(v.strip("\"'"), main > 0) for v in _MARK.findall(rest))
        is_main = is_main and not is_skip
        if name in ("p", "span") and not is_skip:
            continue
        stack.append((name, is_skip, is_main))
        open_[name] = open_.get(name, 0) + 1
        n_mains += is_main and not main
        skip += is_skip
        main += is_main
        unseen += name in UNSEEN_TAGS
    if not unseen and at < len(page):
        (skipped if skip else parts).append(page[at:])
    flush()
    return lines


def _lcs(a: list[int], b: list[int]) -> list[int]:
    """Places of ``a`` on a longest common subsequence with ``b``, by bit-parallel rows.

    Row i is a number whose bit j is 0 where the length of the best match of a[:i] and
    b[: j + 1] exceeds that of b[:j].  Where the table of rows is large, ``a`` is cut in
    the middle and ``b`` where the lengths of both halves add up to the most, so memory
    stays bounded and the result is exact for all inputs.
    """
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1

    def step(row: int, x: int) -> int:
        hit = row & places.get(x, 0)
        return ((row + hit) | (row - hit)) & full

    if len(a) * len(b) <= TABLE_BITS or len(a) == 1:
        rows = [full]
        for x in a:
            rows.append(step(rows[-1], x))
        out, i, j = [], len(a), len(b) - 1
        while i and j >= 0:
            if rows[i] >> j & 1:
                j -= 1
            elif rows[i - 1] >> j & 1:
                out.append(i - 1)
                i, j = i - 1, j - 1
            else:
                i -= 1
        return out[::-1]
    half = len(a) // 2
    cut = _best_cut(a[:half], a[half:], b)
    return _lcs(a[:half], b[:cut]) + [half + i for i in _lcs(a[half:], b[cut:])]


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a`` and b[:0], b[:1], ..."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    row = full = (1 << len(b)) - 1
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _best_cut(first: list[int], second: list[int], b: list[int]) -> int:
    return int(np.argmax(_lengths(first, b) + _lengths(second[::-1], b[::-1])[::-1]))


def lcs_mask(a: list[int], b: list[int]) -> list[bool]:
    """Which places of ``a`` lie on a longest common subsequence with ``b``."""
    start, end = 0, 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    mask = [True] * start + [False] * (len(a) - start - end) + [True] * end
    left, right = a[start : len(a) - end], b[start : len(b) - end]
    both = set(left) & set(right)  # other lines match nothing
    at = [i for i, x in enumerate(left) if x in both]
    if at:
        for i in _lcs([left[i] for i in at], [x for x in right if x in both]):
            mask[start + at[i]] = True
    return mask


def _main_number(lines: list[tuple[str, int]]) -> int | None:
    """The number of the page's longest article element; None if there is none with text."""
    sizes: dict[int, int] = {}
    for t, where in lines:
        if where >= 0:
            sizes[where] = sizes.get(where, 0) + len(t)
    return max(sizes, key=lambda n: (sizes[n], -n)) if sizes else None


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of all lines of each page."""
    for b in batches:
        hashes = []
        for page in b["html"].to_pylist():
            lines = page_lines(page)
            hashes.append(np.fromiter((_hash(t) for t, _ in lines), np.uint64, len(lines)).tobytes())
        yield pa.record_batch([b["key"], b["check"], b["url"], pa.array(hashes, pa.binary())], names=["key", "check", "url", "hashes"])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's lines: all their places, the texts that may stay, and the hashes of the others."""
    pack = zstandard.ZstdCompressor(level=6).compress
    for b in batches:
        where, kept, gone = [], [], []
        for page in b["html"].to_pylist():
            lines = page_lines(page)
            main = _main_number(lines)
            least = 0 if main is not None else OUTSIDE
            places = [w if w < 0 or w != main else MAIN for _, w in lines]
            where.append(np.array(places, np.int32).tobytes())
            kept.append(pack("\n".join(t for t, w in lines if w >= least).encode()))
            gone.append(np.array([_hash(t) for t, w in lines if w < least], np.uint64).tobytes())
        yield pa.record_batch(
            [b["key"], b["check"], b["id"], b["url"], pa.array(where, pa.binary()), pa.array(kept, pa.binary()), pa.array(gone, pa.binary())],
            names=["key", "check", "id", "url", "places", "kept", "gone"])


#: The place of lines of the longest article element.
MAIN = 2**31 - 1


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for b in batches:
        out = [_decided(unpack(k).decode(), np.frombuffer(p, np.int32), g, o) for k, p, g, o in zip(
            *(b[c].to_pylist() for c in ("kept", "places", "gone", "other")), strict=True)]
        texts, n_lines, n_shared, n_deleted = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.record_batch(
            [b["id"], b["url"], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64()),
             pa.array(n_lines, pa.int64()), pa.array(n_shared, pa.int64()), pa.array(n_deleted, pa.int64())],
            names=["id", "url", "text", "n_chars", "n_lines", "n_shared", "n_deleted"])


def _decided(text: str, places: np.ndarray, gone: bytes, other: bytes | None) -> tuple[str, int, int, int]:
    """The page's text, its lines, those that it shares with its partner, and those that differencing deletes."""
    stays = places >= (0 if (places == MAIN).any() else OUTSIDE)
    lines = text.split("\n") if stays.any() else []
    own = np.empty(len(places), np.uint64)
    own[stays] = [_hash(t) for t in lines]
    own[~stays] = np.frombuffer(gone, np.uint64)
    shared = np.zeros(len(places), bool)
    if other and len(own):
        theirs = np.frombuffer(other, np.uint64).tolist()
        shared = np.array(lcs_mask(own.tolist(), theirs))
        deleted = shared & (places != MAIN)
        mine = "".join(t for t, d in zip(lines, deleted[stays].tolist(), strict=True) if not d)
        if (places == MAIN).any() or sum(map(str.isalpha, mine)) >= COPY_LETTERS:
            lines = [t for t, d in zip(lines, deleted[stays].tolist(), strict=True) if not d]
        else:
            deleted[:] = False
        return " ".join(lines), len(places), int(shared.sum()), int(deleted.sum())
    return " ".join(lines), len(places), 0, 0


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars, n_lines, n_shared, n_deleted.

    n_lines counts all lines, n_shared those shared with the paired page, n_deleted
    those of them that differencing deletes.  Null and empty pages have an empty text.
    Pages without a host (null URL too) have no partner.  Pages of one path are
    neighbours, in an order that their hashes fix.  Rows alike in id, URL and html are
    one page to their neighbours, and get the same result each.  Other columns are
    ignored, whatever their names; an empty table gives an empty result; a page is
    aligned whole, whatever its length.
    """
    url = F.col(f"`{url_col}`")
    page = (F.col(f"`{id_col}`"), url, F.col(f"`{html_col}`"))
    rows = pages.select(
        page[0].alias("id"), url.alias("url"), page[2].alias("html"),
        F.xxhash64(*page).alias("key"), F.xxhash64(F.lit(1), *page[::-1]).alias("check"))
    prints = rows.select("key", "check", "url", "html").mapInArrow(_fingerprints, "key long, check long, url string, hashes binary")
    bare = F.regexp_replace("url", r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    prints = C.stored(prints.select(
        "key", "check", F.lower(F.regexp_extract(bare, r"^//([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(bare, r"^(?://[^/?#]*)?([^?#]*)", 1).alias("path"), "hashes",
    ).where("host != ''"))
    placed = C.ranked(prints.select("host", "path", "key", "check").distinct(), "host", "path", "key", "check")
    side = lambda step, p: placed.select(
        (F.col("rank") + step).alias("rank"), *[F.col(c).alias(f"{p}_{c}") for c in ("host", "path", "key", "check")])
    pairs = placed.join(side(1, "prev"), "rank", "left").join(side(-1, "next"), "rank", "left")
    prev_ok, next_ok = F.col("prev_host") == F.col("host"), F.col("next_host") == F.col("host")
    nearer = F.levenshtein("path", "next_path") < F.levenshtein("path", "prev_path")
    to_prev = prev_ok & ~F.coalesce(next_ok & nearer, F.lit(False))
    pick = lambda c: F.when(to_prev, F.col(f"prev_{c}")).when(next_ok, F.col(f"next_{c}"))
    pairs = pairs.select("key", "check", pick("key").alias("p_key"), pick("check").alias("p_check"))
    other = prints.select(F.col("key").alias("p_key"), F.col("check").alias("p_check"), F.col("hashes").alias("other"))
    other = other.dropDuplicates(["p_key", "p_check"])
    paired = pairs.join(other, ["p_key", "p_check"]).select("key", "check", "other")
    kind = rows.schema["id"].dataType.simpleString()
    lines = rows.mapInArrow(_parse, f"key long, check long, id {kind}, url string, places binary, kept binary, gone binary")
    return (
        lines.join(paired, ["key", "check"], "left").select("id", "url", "places", "kept", "gone", "other")
        .mapInArrow(_difference, f"id {kind}, url string, text string, n_chars long, n_lines long, n_shared long, n_deleted long")
        .withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
    )
