"""Main text of HTML pages; host-wide repeats decide where markup does not.

A page is read into blocks of text by the HTML parser's rules for comments,
quotes and end tags that are left out. Scripts, styles, menus, headers, footers,
sidebars, forms, notices, adverts and reader comments go by their elements,
roles and class names. If the page marks its article (``article``, else
``main``), its main text is there only.

All words of all pages are then judged per host by a suffix array, those that
markup leaves out too: the token streams of a host's pages are concatenated,
suffixes are ranked by prefix doubling up to ``RUN`` tokens, and pages are
counted of every stretch of ``RUN`` tokens. A stretch that one in ``ONE_IN`` of
the host's distinct pages has, and ``LEAST_PAGES`` or more, is boilerplate if it
is in the main text of ``LEAST_PAGES`` (a headline that other pages' sidebars
list is in that of its own page only). It goes wherever it is outside of running
text. Running text (``p`` and ``blockquote``, unless mostly links; in a marked
article lists, tables, code and captions, too) may be shared by articles:
quotations, whole syndicated bodies. Such a block goes if all its words are in
stretches that ``NOTICE_PERCENT`` of the host's distinct pages have in their main
text, and ``NOTICE_PAGES`` or more: a notice. If that were half of a page's running
text or more, it stays. In a marked article a stretch has to lie in one run of words
outside of running text, and marked and other pages of a host are judged apart.
Pages of equal main text count as one page, and a page that would lose
everything keeps its text.

A host of many pages is cut into shards of bounded size. What is on a share of
the host's pages is on that share of the pages of one shard at least, so a shard
hands on these stretches alone, with their number of pages. Numbers are added up
across the host's shards; where shards that did not hand a stretch on could decide
about it, all of the host's shards count it again. So the result does not depend
on the cut, and no host, however large, makes a large group.

Defined results: null or empty html gives an empty text. Repeated rows give
their text each. Very long pages are read whole. A page without a url belongs
to the host ''.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropgate.llm.common import written
from dropgate.llm.neardup import _groups
from dropgate.llm.words import U64, mix, ngrams, pieces

RUN = 12                # tokens of the shortest repeated stretch
ONE_IN = 5              # of a host's distinct pages: boilerplate is on one at least
LEAST_PAGES = 3         # that boilerplate is on, whatever the host's size
NOTICE_PERCENT = 90     # of a host's distinct pages that a notice in a paragraph is on, at least
NOTICE_PAGES = 30       # that a notice in a paragraph is on, whatever the host's size
SHARD_TOKENS = 400_000  # of a host's shard, about
BYTES = 8               # of html a token, about
PART_SHARDS = 4         # of a partition, at most about

DROPPED = frozenset("""script style template noscript nav header footer aside form head title iframe object embed svg
    select textarea button menu dialog audio video canvas map""".split())
RAW = frozenset("script style textarea title iframe noembed noframes".split())  # their content is no markup, and not shown as text
VERBATIM = frozenset("xmp plaintext".split())  # their content is no markup, but text
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol option p plaintext pre section
    summary table tbody td tfoot th thead tr ul xmp""".split())
PARAGRAPH = frozenset("p blockquote".split())
KEPT = PARAGRAPH | frozenset("pre listing xmp plaintext table ul ol dl figure".split())  # in a marked article
# HTML lets end tags be left out; these are the parser's rules for where such elements end
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("base link meta noframes noscript script style template title".split())
SCOPE = frozenset("html table td th caption template object".split())  # an end tag ends nothing beyond these
ENDS_P = BLOCK - frozenset("body br html legend option tbody td tfoot th thead tr".split())
ITEMS = {"li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]), "dt": frozenset(["dd", "dt"]), "td": frozenset(["td", "th"]),
         "th": frozenset(["td", "th"]), "tr": frozenset(["tr"])}  # an item ends the item before
WALLS = {"p": SCOPE | {"button"}, "li": SCOPE | {"ul", "ol"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tr": {"table"},
         "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}, "table": {"template"}, "caption": {"table"}, "template": set(), "html": set(),
         "body": set()}
ITEM_WALLS = {"li": (BLOCK | SCOPE) - {"address", "div", "p"}, "dd": (BLOCK | SCOPE) - {"address", "div", "p"},
              "dt": (BLOCK | SCOPE) - {"address", "div", "p"}, "td": WALLS["td"], "th": WALLS["th"], "tr": WALLS["tr"]}
WITHIN_BLOCK = SCOPE | BLOCK
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
NAMES = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner
    nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside header masthead footer cookie cookies consent gdpr
    notice notices newsletter subscribe subscription signup login comment comments commentlist disqus replies respond related
    recommended recommendations share sharing social popup modal overlay widget widgets toolbar pagination pager copyright""".split())

_TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</(?![a-zA-Z])[^>]*>
    |<(/?)([a-zA-Z][^\s/>]*)((?>[\s/]+|=?[^\s/>=]+(?>\s*=\s*(?>"[^"]*"|'[^']*'|[^\s>"'][^\s>]*|(?=>)))?)*+)>
    |<(/?)([a-zA-Z][^\s/>]*)[^>]*>""", re.S | re.X)
_UNENDED = re.compile(r"<[!?].*", re.S)  # all there can be where no tag ends
_ATTR = re.compile(r"""([^\s=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_FLAGS = ("has", "no", "with", "without", "is", "not")


def _named_boilerplate(names: str) -> bool:
    for name in names.lower().split():
        if name in NAMES:
            return True
        parts = re.split(r"[-_]+", name)
        if parts[0] not in _FLAGS and (parts[0] in NAMES or parts[-1] in NAMES):
            return True
    return False


def _excluded(tag: str, attrs: str) -> bool:
    """Whether an element, by its kind or attributes, is no part of the main text."""
    if tag in DROPPED:
        return True
    if not attrs or attrs.isspace():
        return False
    found = {}
    for m in _ATTR.finditer(attrs):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", "")):
        return True
    if tag in ("html", "body", "main"):
        return False
    return found.get("role", "").lower() in ROLES or _named_boilerplate(found.get("class", "")) or _named_boilerplate(found.get("id", ""))


def _judged_blocks(page: str) -> tuple[bool, list[tuple[str, bool]], str]:
    """As ``blocks``, each block with whether it is running text; and all other words of the page's text."""
    stack: list[str] = []        # tags
    opened: dict[str, int] = {}  # how often each tag is in the stack
    shut = -1                    # place there of the element whose text is left out
    out: list[tuple[str | None, str, bool]] = []
    held: list[str] = []
    linked: list[str] = []
    at, n, last = 0, len(page), page.rfind(">")

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            if text and shut >= 0:
                out.append((None, text, False))
            elif text:
                kind = "article" if opened.get("article") else "main" if opened.get("main") else ""
                running = any(opened.get(t) for t in (KEPT if kind else PARAGRAPH)) and 2 * len(" ".join("".join(linked).split())) <= len(text)
                out.append((kind, text, running))
            held.clear()
            linked.clear()

    def end(i: int, alone: bool = False) -> None:
        """Ends the element at ``i`` and, unless ``alone``, those in it."""
        nonlocal shut
        gone = stack[i: i + 1 if alone else None]
        if i <= shut < i + len(gone):
            flush()  # what was left out ends here
            shut = -1
        elif i < shut:
            shut -= 1
        for t in gone:
            opened[t] -= 1
        del stack[i: i + len(gone)]

    def nearest(tags, walls) -> int:
        """Place of the innermost open element of ``tags`` that lies within no inner wall; -1 without one."""
        for t in tags:
            if opened.get(t):
                break
        else:
            return -1
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] in tags:
                return i
            if stack[i] in walls:
                break
        return -1

    def end_tag(tag: str) -> None:
        block = tag in BLOCK or tag in WALLS
        if (i := nearest(HEADINGS if tag in HEADINGS else (tag,), WALLS.get(tag, SCOPE) if block else WITHIN_BLOCK)) >= 0:
            end(i)
        elif shut >= 0 and stack[shut] == tag and opened[tag] == 1:  # whatever is open in it
            end(shut)
        elif tag == "a" and (i := nearest(("a",), SCOPE)) >= 0:  # crossed with blocks, which go on
            end(i, alone=True)

    def implied_ends(tag: str) -> None:
        """Ends what a start tag ends."""
        if tag in BLOCK and (opened.get("svg") or opened.get("math")) and not opened.get("foreignobject"):
            end(next(i for i, t in enumerate(stack) if t in ("svg", "math")))
        if opened.get("head") and (tag == "body" or stack[-1] == "head" and tag not in IN_HEAD):
            end(nearest(("head",), ()))
        if tag in ENDS_P and opened.get("p") and (i := nearest(("p",), WALLS["p"])) >= 0:
            end(i)
        if tag in ITEMS:
            if (i := nearest(ITEMS[tag], ITEM_WALLS[tag])) >= 0:
                end(i)
        elif tag in HEADINGS:
            if stack and stack[-1] in HEADINGS:
                end(len(stack) - 1)
        elif tag in ("tbody", "thead", "tfoot"):
            if 0 <= (i := nearest(("table",), ())) < len(stack) - 1:
                end(i + 1)
        elif tag in ("a", "button") and (i := nearest((tag,), WITHIN_BLOCK)) >= 0:
            end(i)

    def hold(text: str) -> None:
        if opened.get("head") and stack[-1] == "head" and not text.isspace():
            end(len(stack) - 1)
        held.append(text)
        if opened.get("a"):
            linked.append(text)

    while at < n:
        m = (_TAG if at <= last else _UNENDED).search(page, at)
        upto = m.start() if m else n
        if upto > at:
            hold(html.unescape(page[at:upto]))
        if not m:
            break
        at = m.end()
        tag, attrs = ((m[2] or m[5] or "").lower(), m[3] or "") if m.re is _TAG else ("", "")
        if not tag:  # a comment or a declaration
            continue
        if tag in BLOCK:
            flush()
        if m[1] or m[4]:
            end_tag(tag)
            continue
        implied_ends(tag)
        if tag in VOID or attrs.endswith("/") and (tag in ("svg", "math") or opened.get("svg") or opened.get("math")):
            continue
        if shut < 0 and _excluded(tag, attrs):
            flush()  # what stood before belongs to the element around
            shut = len(stack)
        stack.append(tag)
        opened[tag] = opened.get(tag, 0) + 1
        if tag in RAW or tag in VERBATIM:
            close = re.compile(f"</{re.escape(tag)}", re.I).search(page, at) if tag != "plaintext" else None
            upto = close.start() if close else n
            if tag in VERBATIM:
                hold(page[at:upto])
            at = upto
    flush()
    found = [container for container, _, _ in out]
    main = "article" if "article" in found else "main" if "main" in found else ""
    mine = [kind is not None and (kind == main or not main) for kind in found]
    return bool(main), [(t, r) for (_, t, r), own in zip(out, mine, strict=True) if own], " ".join(
        t for (_, t, _), own in zip(out, mine, strict=True) if not own)


def blocks(page: str) -> tuple[bool, list[str]]:
    """Whether the page marks its main text, and the blocks of that text (else of the whole page)."""
    marked, out, _ = _judged_blocks(page)
    return marked, [t for t, _ in out]


def _running(parts: list[tuple[str, bool]]) -> list[int]:
    """First and last + 1 word of each block of running text, one after the other."""
    out, at = [], 0
    for text, running in parts:
        end = at + text.count(" ") + 1
        if running:
            out += [at, end]
        at = end
    return out


def _key(*parts: str) -> int:
    """A 64-bit hash."""
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _texts(pages: DataFrame) -> DataFrame:
    """site, shards, marked, same (equal: pages of equal main text), rest_key, text, running and rest of (site, shards, html).

    Of a task's pages of equal main text only those come that have the least ``rest_key`` so far, so copies don't pile up.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple[int, int], int] = {}
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.slice(lo, 256)
                rows = []
                for site, shards, page in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    marked, blocks, rest = _judged_blocks(page)
                    text, running = " ".join(t for t, _ in blocks), _running(blocks)
                    if text:
                        same, order = _key(str(marked), text, str(running)), _key(rest)
                        if order < least.get((site, same), 1 << 63):
                            if len(least) >= 200_000:
                                least.clear()
                            least[site, same] = order
                            rows.append((site, shards, marked, same, order, text, running, rest))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 8, types, strict=True)], names=names)

    names = ["site", "shards", "marked", "same", "rest_key", "text", "running", "rest"]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.string()]
    return pages.select("site", "shards", "html").mapInArrow(
        run, "site long, shards long, marked boolean, same long, rest_key long, text string, running array<int>, rest string")


def truncated_ranks(tokens: np.ndarray, run: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``run`` tokens (prefix doubling; ends sort first)."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while width < run:
        step = min(width, run - width)  # the last step overlaps
        pair = rank * (len(rank) + 1)  # ranks are at most their number
        pair[: len(rank) - step] += rank[step:]
        order = np.argsort(pair)
        pair = pair[order]
        new = np.ones(len(rank), bool)
        new[1:] = pair[1:] != pair[:-1]
        rank = np.empty(len(rank), np.int64)
        rank[order] = np.cumsum(new)
        width += step
    return rank


def _first_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first of neighbouring rows of one host, shard and ``same``, also across batches."""
    last = None
    for b in batches:
        if len(b):
            keys = np.stack([b.column(c).to_numpy() for c in ("host", "shard", "same")])
            new = np.ones(len(b), bool)
            new[1:] = (keys[:, 1:] != keys[:, :-1]).any(0)
            new[0] = last != keys[:, 0].tolist()
            last = keys[:, -1].tolist()
            yield b.filter(pa.array(new))


def _loose(texts: pa.Table) -> np.ndarray:
    """Of each word of the texts, whether it is outside of running text."""
    words = np.array([x.count(" ") + 1 for x in texts["text"].to_pylist()])
    edge, first = np.zeros(words.sum() + 1, np.int64), 0
    for n, running in zip(words.tolist(), texts["running"].to_pylist(), strict=True):
        np.add.at(edge, np.array(running[::2], np.int64) + first, 1)
        np.add.at(edge, np.array(running[1::2], np.int64) + first, -1)
        first += n
    return np.cumsum(edge)[:-1] == 0


def _hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word."""
    found = [(p.hashes(), p.doc() + p.lo) for p in pieces(texts)]
    return np.concatenate([h for h, _ in found]), np.concatenate([d for _, d in found])


def _grams(h: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of hash of the ``run`` words from each place on."""
    return ngrams(h, run).view(np.int64), ngrams(mix(h ^ U64(0x2545F491)), run).view(np.int64)


def _stretches(texts: pa.Table, run: int) -> tuple[np.ndarray, ...]:
    """Of each distinct stretch of (marked, text, running, rest) of a shard's pages: its hash (two columns), on how many
    pages it is, on how many in the main text, and whether it is judged there: if the page is marked, all its words
    have to be loose, else one of them."""
    (h, doc), (other, other_doc) = _hashes(texts["text"]), _hashes(texts["rest"])
    inside, loose = len(h), np.append(0, np.cumsum(_loose(texts)))
    h, doc, part = np.concatenate([h, other]), np.concatenate([doc, other_doc]), np.concatenate([doc, other_doc + len(texts)])
    if len(h) < run:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    whole = np.flatnonzero(part[: len(h) - run + 1] == part[run - 1:])  # a stretch lies in one page, in or beside its main text
    rank, d, main = truncated_ranks(h, run)[whole], doc[whole], whole < inside
    judged = np.zeros(len(whole), bool)
    places = whole[main]
    count = loose[places + run] - loose[places]
    judged[main] = count >= np.where(texts["marked"].to_numpy()[d[main]], run, 1)
    key = rank * len(texts) + d
    order = np.argsort(key)
    key, rank = key[order], rank[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    pages = np.flatnonzero(first)  # a page's places of a stretch
    first[1:] = rank[1:] != rank[:-1]
    stretch = np.flatnonzero(first)
    if not len(stretch):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    of = np.searchsorted(pages, stretch)
    on = np.diff(np.append(of, len(pages)))
    within = np.add.reduceat(np.logical_or.reduceat(main[order], pages).astype(np.int64), of)
    g1, g2 = (g[whole[order[stretch]]] for g in _grams(h, run))
    return g1, g2, on, within, np.logical_or.reduceat(judged[order], stretch)


def _settle(run: int):
    """mapInArrow body over shards (host, shard, site, shards, same, marked, text, running, rest): rows of host, shard, site,
    pages (of the shard) and floor, and of each stretch on ``floor`` pages: g1, g2 (null in a row of the shard itself), found
    (pages it is on), inside (in the main text of) and judged.

    What is on a share of the host's pages is on that share of some shard's pages, so no other stretch need be handed on.
    """

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(_first_copies(batches), 2):
            host, shard, site, shards = (t[c][0].as_py() for c in ("host", "shard", "site", "shards"))
            g1, g2, found, inside, judged = _stretches(t, run)
            floor = max(-(-len(t) // ONE_IN), LEAST_PAGES if shards == 1 else 1)
            of = np.flatnonzero(found >= floor)
            same = [pa.array(np.full(len(of) + 1, x, np.int64)) for x in (host, shard, site, len(t), floor)]
            null = pa.nulls(1, pa.int64())
            grams = [pa.chunked_array([null, pa.array(g[of], pa.int64())]).combine_chunks() for g in (g1, g2)]
            counts = [pa.array(np.append(0, c[of])) for c in (found, inside)]
            yield pa.RecordBatch.from_arrays([*same, *grams, *counts, pa.array(np.append(False, judged[of]).astype(bool))],
                                             names=["host", "shard", "site", "pages", "floor", "g1", "g2", "found", "inside", "judged"])

    return body


def _recount(run: int):
    """Counts, in a shard (host, shard, ..., text), of the stretches (host, shard, g1, g2) given with it."""

    def body(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        host, g1, g2 = (wanted[c].to_numpy() for c in ("host", "g1", "g2"))
        texts = pa.Table.from_batches(_first_copies(texts.sort_by([("same", "ascending"), ("rest_key", "ascending")]).combine_chunks().to_batches()), texts.schema)
        if not len(g1) or not len(texts):
            return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
        h1, h2, *counts = _stretches(texts, run)
        pair = np.dtype([("a", np.int64), ("b", np.int64)])
        have, want = (np.rec.fromarrays(x, dtype=pair) for x in ((h1, h2), (g1, g2)))
        of = np.flatnonzero(np.isin(h1, g1))
        of = of[np.isin(have[of], want)]
        return pa.Table.from_arrays([pa.array(np.full(len(of), host[0]), pa.int64()), *(pa.array(x[of], t) for x, t in zip((h1, h2, *counts), types[1:], strict=True))], names=names)

    names, types = ["host", "g1", "g2", "found", "inside", "judged"], [pa.int64()] * 5 + [pa.bool_()]
    return body


def _boilerplate(pages: DataFrame, run: int, parts: int) -> DataFrame:
    """site, marked, cut, notice, g1, g2: of (site, shards, html), the stretches (by hash) that are boilerplate on the site's
    marked pages or on its others. ``parts``: the least number of partitions."""
    def dealt(pages: DataFrame) -> DataFrame:
        # what marked articles share is no evidence against other pages, nor the other way round
        return _texts(pages).select(F.xxhash64("site", "marked").alias("host"), F.pmod("same", "shards").alias("shard"),
                                    "site", "shards", "same", "rest_key", "marked", "text", "running", "rest")

    few = parts <= int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_shard = dealt(pages).repartition(*([] if few else [parts]), "host", "shard")
    counted = written(by_shard.sortWithinPartitions("host", "shard", "same", "rest_key").mapInArrow(
        _settle(run), "host long, shard long, site long, pages long, floor long, g1 long, g2 long, found long, inside long, judged boolean"), "html-stretches")
    shards = counted.filter("g1 IS NULL")
    hosts = shards.groupBy("host", "site").agg(F.sum("pages").alias("of"), F.sum(F.col("floor") - 1).alias("missed"))
    hosts = hosts.withColumn("need", F.greatest(F.lit(LEAST_PAGES), F.ceil(F.col("of") / ONE_IN))).withColumn(
        "notice_need", F.greatest(F.lit(NOTICE_PAGES), F.ceil(F.col("of") * NOTICE_PERCENT / 100)))
    sums = counted.filter("g1 IS NOT NULL").groupBy("host", "g1", "g2").agg(
        F.sum("found").alias("found"), F.sum("inside").alias("inside"), F.max("judged").alias("judged"),
        F.sum(F.col("floor") - 1).alias("own"))
    # a shard that did not hand a stretch on has it on fewer than ``floor`` pages
    near = written(sums.join(hosts, "host").filter("found + missed - own >= need"), "html-near")
    exact, open_ = near.filter("missed = own"), near.filter("missed > own")
    if not open_.isEmpty():
        wanted = open_.select("host", "g1", "g2").join(shards.select("host", "shard"), "host")
        sites = F.broadcast(open_.select("site").distinct())  # of several shards each, so they are few
        again = (dealt(pages.join(sites, "site", "left_semi")).groupBy("host", "shard").cogroup(wanted.groupBy("host", "shard"))
                 .applyInArrow(_recount(run), "host long, g1 long, g2 long, found long, inside long, judged boolean"))
        again = again.groupBy("host", "g1", "g2").agg(F.sum("found").alias("found"), F.sum("inside").alias("inside"), F.max("judged").alias("judged"))
        exact = exact.select(again.columns + ["site", "need", "notice_need"]).union(
            again.join(hosts, "host").select(again.columns + ["site", "need", "notice_need"]))
    cut = F.expr(f"judged AND found >= need AND inside >= {LEAST_PAGES}")
    return exact.select("site", (F.col("host") == F.xxhash64("site", F.lit(True))).alias("marked"), cut.alias("cut"),
                        F.expr("inside >= notice_need").alias("notice"), "g1", "g2").filter("cut OR notice")


def _cut(marked: bool, blocks: list[tuple[str, bool]], h: np.ndarray, stretches: tuple[np.ndarray, ...], run: int) -> str:
    """The words of a page without those of the stretches (marked, cut, notice, g1, g2)."""
    kind, cut, notice, g1, g2 = stretches
    mine, other = _grams(h, run)
    ws = " ".join(t for t, _ in blocks).split(" ")
    running = _running(blocks)
    loose = np.ones(len(ws), bool)
    for i, j in zip(running[::2], running[1::2], strict=True):
        loose[i:j] = False

    def covered(which: np.ndarray, all_loose: bool) -> np.ndarray:
        have = set(zip(g1[which].tolist(), g2[which].tolist(), strict=True))
        edge = np.zeros(len(ws) + 1, np.int64)
        for s in np.flatnonzero(np.isin(mine, g1[which])).tolist():
            if (int(mine[s]), int(other[s])) in have and (not all_loose or loose[s: s + run].all()):
                edge[s] += 1
                edge[s + run] -= 1
        return np.cumsum(edge)[:-1] > 0

    gone = covered(cut & (kind == marked), marked) & loose
    seen = covered(notice & (kind == marked), False)
    notices = [(i, j) for i, j in zip(running[::2], running[1::2], strict=True) if seen[i:j].all()]
    if 2 * sum(j - i for i, j in notices) < (~loose).sum():  # else it is the page's article
        for i, j in notices:
            gone[i:j] = True
    kept = [w for w, c in zip(ws, gone.tolist(), strict=True) if not c]
    return " ".join(kept or ws)


def main_text(pages: DataFrame, run: int = RUN, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``pages`` without html, with text and n_chars."""
    columns = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    host = F.regexp_extract(F.lower(F.coalesce(F.col("url"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    source = pages.select(F.struct(*columns).alias("row"), F.coalesce("html", F.lit("")).alias("html"), F.xxhash64(host).alias("site"))
    sizes = written(source.groupBy("site").agg(F.sum(F.octet_length("html")).alias("bytes")), "html-hosts")
    shards = F.ceil(F.col("bytes") / (BYTES * shard_tokens))
    large = F.broadcast(sizes.select("site", shards.alias("shards")).filter("shards > 1"))  # a row for SHARD_TOKENS words at least
    parts = (sizes.agg(F.sum("bytes")).first()[0] or 0) // (PART_SHARDS * BYTES * shard_tokens)
    found = _boilerplate(source.select("site", "html").join(large, "site", "left").select(
        "site", F.coalesce("shards", F.lit(1)).alias("shards"), "html"), run, parts)
    found = written(found.groupBy("site").agg(F.collect_list(F.struct("marked", "cut", "notice", "g1", "g2")).alias("found")), "html-boilerplate")
    kind = source.schema["row"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.slice(lo, 256)
                got = [_judged_blocks(t) for t in part.column(1).to_pylist()]
                text = [" ".join(t for t, _ in blocks) for _, blocks, _ in got]
                judged = np.flatnonzero(part.column(2).is_valid())
                if len(judged):
                    h, doc = _hashes(pa.array([text[i] for i in judged.tolist()], pa.string()))
                    first = np.searchsorted(doc, np.arange(len(judged) + 1))
                    for n, i in enumerate(judged.tolist()):
                        if text[i]:
                            stretches = part.column(2)[i].values
                            text[i] = _cut(*got[i][:2], h[first[n]: first[n + 1]], tuple(
                                stretches.field(f).to_numpy(zero_copy_only=False) for f in range(5)), run)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(text, pa.string())], names=["row", "text"])

    done = source.join(found, "site", "left").select("row", "html", "found").mapInArrow(read, f"row {kind}, text string")
    return done.select(*[F.col("row")[c].alias(c) for c in columns], "text", F.length("text").cast("long").alias("n_chars"))


def op9(pages: DataFrame) -> DataFrame:
    return main_text(pages.select("page_id", "url", "html"))
