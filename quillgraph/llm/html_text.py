"""Main text of HTML pages by equivalence classes of template tokens.

Tokens are the elements of a page, named by their path of tags and class names (of names that differ in digits only, elements of
one parent are told apart by their order), and texts: of a block, and of a box that stands once in its page. A token's
occurrence vector is how often it stands in each page of its host; sums of a hash per page and count stand for it, so that
vectors can be put together across tasks. Element tokens of one host with equal vectors form a class; a class is valid if it
has two tokens at least (or an article or main element) and occurs in at least half of the pages, and a token of it is in
the template if its parent is as well. A slot lies between two template tokens inside one template element; what a page has
there, elements that are not in the template included, is data.
The main slot is the deepest template element that holds most of the host's running text outside of menus, headers,
footers, sidebars, notices, adverts, forms and reader comments. In it two kinds of texts are template: those of a box (not of a
paragraph) that at least half of the pages with the main slot have alike but for digits, if it is less than a third of the page's text; and
the blocks that close the slot word for word alike on half of those pages. A sentence that articles share at any
other place is theirs.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix, pieces, read, ship
from .urls import split_url

# Elements by the way they are laid out, and names of what surrounds an article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "iframe", "template", "svg", "textarea", "title", "math", "object", "canvas")
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head"
    " header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
DROPPED = frozenset("head nav footer aside form dialog menu button select option label input fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
AROUND = frozenset(
    "ad ads adv adbox adslot nav navbar aside notice notices alert alerts modal overlay login signin signup search pager pagination toolbar topbar gdpr"
    " consent respond replies discussion disqus copyright colophon skip".split()
)
AROUND_START = ("comment", "advert", "sponsor", "navig", "breadcrumb", "sidebar", "cookie", "footer", "newsletter", "subscri", "recommend", "related", "share", "sharing", "social", "promo", "popup", "banner", "masthead", "menu", "widget")
#: Inside an article a class name is that of a surrounding only if all its other words are such as these.
HOLDERS = frozenset("bar box block buttons button links link list items item posts section widget banner popup panel container wrapper wrap area form slot unit icons icon holder inner outer count".split())
#: Elements that can be a box of fixed text.
BOXES = frozenset("div section ul ol dl table figure details center dir".split())
CLOSES = {"li": {"li"}, "p": {"p"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
MAIN_TAGS = ("article", "main")
_LISTS = frozenset("ul ol dl table".split())

_piece = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^\"'>]|\"[^\"]*\"|'[^']*')*(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S | re.I,
)
_attr = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_digits = re.compile(r"\d+")


def surrounds(tag: str, attrs: dict[str, str], in_main: bool) -> bool:
    """Whether an element is something around the article."""
    if tag in DROPPED or (tag == "header" and not in_main):
        return True
    if attrs.get("role", "").lower() in ROLES:
        return True
    if tag in ("html", "body", *MAIN_TAGS):
        return False
    for name in (attrs.get("class", "") + " " + attrs.get("id", "")).lower().split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        if words and words[0] in ("with", "has", "no", "without"):
            continue
        named = [w in AROUND or w.startswith(AROUND_START) or (w == "header" and not in_main) for w in words]
        if in_main:
            if named and named[0] and all(n or w in HOLDERS for n, w in zip(named, words, strict=True)):
                return True
        elif any(named):
            return True
    return False


class Block:
    """A run of text between borders of blocks: its text, where it stands, and how much of it is in links."""

    __slots__ = ("text", "path", "around", "linked", "opened")

    def __init__(self, text: str, path: tuple, around: bool, linked: int, opened: int):
        self.text, self.path, self.around, self.linked, self.opened = text, path, around, linked, opened


_named: dict = {}


def token(parent: int, name: str) -> int:
    """The 64-bit name of an element by its path."""
    key = (parent, name)
    found = _named.get(key)
    if found is None:
        if len(_named) > 200_000:
            _named.clear()
        found = _named[key] = int.from_bytes(hashlib.blake2b(f"{parent}>{name}".encode(), digest_size=8).digest(), "little", signed=True)
    return found


def parse(source: str) -> tuple[list[Block], dict[int, int], dict[int, tuple[int, str]], list[int]]:
    """Blocks in page order, how often each element token occurs, each token's parent and tag, and tokens as they open."""
    blocks: list[Block] = []
    counts: dict[int, int] = defaultdict(int)
    parents: dict[int, tuple[int, str]] = {}
    order: list[int] = []
    stack: list[tuple[str, int, bool, dict]] = []  # block elements: tag, token, around, children so far by name
    inline: list[str] = []
    text: list[str] = []
    linked = size = 0
    path: tuple = ()

    def end_block():
        nonlocal linked, size
        if text:
            joined = " ".join(html_lib.unescape("".join(text)).split())
            if joined:
                blocks.append(Block(joined, path, bool(stack) and stack[-1][2], linked if size else 0, len(order)))
            text.clear()
        linked = size = 0

    at = 0
    for m in _piece.finditer(source):
        if m.start() > at:
            run = source[at : m.start()]
            text.append(run)
            size += len(run)
            if "a" in inline:
                linked += len(run)
        at = m.end()
        tag = m.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if m.group("close"):
            if tag in BLOCK:
                end_block()
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        inline.clear()
                        path = tuple(s[1] for s in stack)
                        break
            elif tag in inline:
                while inline.pop() != tag:
                    pass
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in BLOCK and tag not in DROPPED:
            if tag not in VOID:
                inline.append(tag)
            continue
        end_block()
        if tag in VOID:
            continue
        if tag in CLOSES:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in CLOSES[tag]:
                    del stack[i:]
                    inline.clear()
                    break
                if stack[i][0] in _LISTS or stack[i][0] not in ("p", "b", "td", "th"):
                    break
        elif stack and stack[-1][0] == "p":
            stack.pop()
        attrs = {k.lower(): a or b or c for k, a, b, c in _attr.findall(m.group("attrs"))} if "=" in m.group("attrs") else {}
        in_main = any(s[0] in MAIN_TAGS for s in stack)
        around = (bool(stack) and stack[-1][2]) or surrounds(tag, attrs, in_main)
        parent = stack[-1][1] if stack else 0
        name = tag
        if "class" in attrs:
            name = tag + "." + _digits.sub("#", attrs["class"])
            if "#" in name and stack:
                before = stack[-1][3]
                before[name] = before.get(name, 0) + 1
                name = f"{name}@{before[name]}"
        own = token(parent, name)
        counts[own] += 1
        order.append(own)
        parents[own] = (parent, tag)
        stack.append((tag, own, around, {}))
        path = tuple(s[1] for s in stack)
    if at < len(source):
        text.append(source[at:])
    end_block()
    return blocks, counts, parents, order


def text_token(block: Block) -> int:
    return int.from_bytes(hashlib.blake2b(f"{block.path[-1] if block.path else 0}|{block.text}".encode(), digest_size=8).digest(), "little", signed=True)


def boxes(blocks: list[Block], counts: dict[int, int], parents: dict[int, tuple[int, str]]) -> dict[int, tuple[int, int]]:
    """Of each box that stands once in the page: a token of its text with digits as one sign, and how long the text is."""
    out: dict[int, list[int]] = {}
    for b in blocks:
        if b.around:
            continue
        h = 0
        for t in b.path:
            if counts[t] == 1 and parents[t][1] in BOXES:
                h = h or int.from_bytes(hashlib.blake2b(_digits.sub("#", b.text).encode(), digest_size=8).digest(), "little")
                s = out.setdefault(t, [t & (2**64 - 1), 0])
                s[0] = (s[0] * 0x9E3779B97F4A7C15 + h) & (2**64 - 1)
                s[1] += len(b.text)
    return {t: (h - (1 << 64) if h >> 63 else h, n) for t, (h, n) in out.items()}


def choose_main(rows: list[tuple[int, int, str, int, int]], template: set[int]) -> int:
    """rows: token, parent, tag, running text in and below it, depth. The deepest template element that holds at least
    70 % of the running text; an article or main element comes first."""
    total = max((c for _, _, _, c, _ in rows), default=0)
    held = [r for r in rows if r[0] in template and r[3] * 10 >= 7 * total and r[2] not in ("p", "li", "td", "h1", "h2", "h3", "blockquote", "pre")]
    marked = [r for r in rows if r[0] in template and r[2] in MAIN_TAGS and r[3] * 2 >= total]
    best = max(marked or held, key=lambda r: (r[4], r[3], -r[0]), default=None)
    return best[0] if best and total else 0


def weigh(blocks: list[Block]) -> dict[int, int]:
    """Running text (outside links and of what surrounds the article) in and below each element."""
    out: dict[int, int] = defaultdict(int)
    for b in blocks:
        if not b.around:
            n = max(0, len(b.text) - b.linked)
            for t in set(b.path):
                out[t] += n
    return out


def slots(blocks: list[Block], order: list[int], template: set[int]) -> list[tuple[tuple[int, int], list[Block]]]:
    """Blocks by slot in page order. A slot is named by the template element it lies in and the last one opened before it."""
    out: list[tuple[tuple[int, int], list[Block]]] = []
    at = last = 0
    for b in blocks:
        while at < b.opened:
            last = order[at] if order[at] in template else last
            at += 1
        name = (next((t for t in reversed(b.path) if t in template), 0), last)
        if not out or out[-1][0] != name:
            out.append((name, []))
        out[-1][1].append(b)
    return out


def main_text(source: str | None, main: int | None, template: set[int], fixed: set[int]) -> str:
    """The data of the slots in the main element. A page in which the host's main element is missing chooses by itself."""
    if not source:
        return ""
    blocks, counts, parents, order = parse(source)
    if not main or main not in counts:
        weights = weigh(blocks)
        depth: dict[int, int] = {0: 0}
        for t, (p, _) in parents.items():  # parents come first
            depth[t] = depth.get(p, 0) + 1
        own = [(t, p, tag, weights.get(t, 0), depth[t]) for t, (p, tag) in parents.items()]
        template = {t for t in counts if counts[t] == 1 or parents[t][1] in MAIN_TAGS}
        main = choose_main(own, template)
    inside = {0: not main}
    for t, (p, _) in parents.items():
        inside[t] = t == main or inside.get(p, not main)
    keep = [b for (around, _), run in slots(blocks, order, template) if inside[around] for b in run if not b.around]
    if not fixed:
        return "\n".join(b.text for b in keep)
    length = sum(len(b.text) for b in keep)
    alike = {t for t, (h, n) in boxes(blocks, counts, parents).items() if h in fixed and t != main and inside[t] and 3 * n < length}
    data = [b for b in keep if alike.isdisjoint(b.path)]
    while data and text_token(data[-1]) in fixed:
        data.pop()
    return "\n".join(b.text for b in (data or keep))


PART = "host string, tok long, kind int, low long, high long, pages long, occ long, chars long, parent long, tag string, depth int"


def deduce(pages: DataFrame, scratch: Scratch, min_fixed_pages: int = 3) -> DataFrame:
    """pages: page_id, host, html. A row per host: the tokens that can be in its template. A text block counts from min_fixed_pages
    pages that hold it; pages that are null or empty count for nothing."""

    def count(batches):
        for batch in batches:
            keys, hosts, source = batch.column(0), batch.column(1), batch.column(2)
            for a, b in pieces(source):
                sums: dict[tuple, list] = {}
                seen: dict[str, int] = defaultdict(int)
                for i in range(a, b):
                    host, page = hosts[i].as_py(), keys[i].as_py()
                    blocks, counts, parents, _ = parse(source[i].as_py() or "")
                    if not blocks and not counts:
                        continue
                    seen[host] += 1
                    weights = weigh(blocks)
                    depth: dict[int, int] = {0: 0}
                    once = np.uint64((hash((page, i, 0x5BD1)) if page is None else page) & 0xFFFFFFFFFFFFFFFF)
                    with np.errstate(over="ignore"):
                        for t, n in counts.items():
                            p, tag = parents[t]
                            depth[t] = depth.get(p, 0) + 1
                            vec = int(mix(np.array([once * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)], np.uint64))[0])
                            s = sums.setdefault((host, t, 0), [0, 0, 0, 0, 0, p, tag, depth[t]])
                            s[0] += vec & 0xFFFFFFFF
                            s[1] += vec >> 32
                            s[2] += 1
                            s[3] += n
                            s[4] += weights.get(t, 0)
                    texts = {text_token(x) for x in blocks if not x.around}
                    texts.update(h for h, _ in boxes(blocks, counts, parents).values())
                    for t in texts:
                        sums.setdefault((host, t, 1), [0, 0, 0, 0, 0, 0, None, 0])[2] += 1
                for host, n in seen.items():
                    sums[(host, 0, 2)] = [0, 0, n, n, 0, 0, None, 0]
                rows = list(sums.items())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k, _ in rows], pa.string()),
                        pa.array([k[1] for k, _ in rows], pa.int64()),
                        pa.array([k[2] for k, _ in rows], pa.int32()),
                        *[pa.array([s[j] for _, s in rows], pa.int64()) for j in range(6)],
                        pa.array([s[6] for _, s in rows], pa.string()),
                        pa.array([s[7] for _, s in rows], pa.int32()),
                    ],
                    ["host", "tok", "kind", "low", "high", "pages", "occ", "chars", "parent", "tag", "depth"],
                )

    parts = pages.select("page_id", "host", "html").mapInArrow(count, PART)
    total = parts.groupBy("host", "kind", "tok").agg(*[F.sum(c).alias(c) for c in ("low", "high", "pages", "occ", "chars")], F.max("parent").alias("parent"), F.max("tag").alias("tag"), F.max("depth").alias("depth"))
    total = scratch.table(total.where(f"kind <> 1 OR pages >= {min_fixed_pages}"))
    # A host's rows that can be in its template: few, as each is in a quarter of its pages (text: half of the pages that hold
    # the main slot, which are half of all at least). One or two pages have nothing to compare and choose by themselves
    n = total.where("kind = 2 AND pages > 2").select("host", F.col("pages").alias("n"))
    kept = total.where("kind < 2").join(n, "host").where("pages * IF(kind = 0, 2, 4) >= n")
    one = F.collect_list(F.struct("kind", "tok", "low", "high", "pages", "n", "chars", "parent", "tag", "depth"))
    return kept.groupBy("host").agg(one.alias("tokens"))


def template_of(tokens: list[dict]) -> tuple[int, set[int], set[int]]:
    """Main slot, template tokens and fixed blocks from a host's tokens."""
    elements = {t["tok"]: t for t in tokens if t["kind"] == 0}
    classes: dict[tuple[int, int], list[int]] = defaultdict(list)
    for t in elements.values():
        classes[t["low"], t["high"]].append(t["tok"])
    template: set[int] = set()
    for t in sorted(elements.values(), key=lambda t: t["depth"]):  # outer tokens first: a token nests in its parent
        if (t["parent"] == 0 or t["parent"] in template) and (len(classes[t["low"], t["high"]]) >= 2 or t["tag"] in MAIN_TAGS):
            template.add(t["tok"])
    rows = [(t["tok"], t["parent"], t["tag"], t["chars"], t["depth"]) for t in elements.values()]
    main = choose_main(rows, template)
    held = elements[main]["pages"] if main else max((t["n"] for t in tokens), default=0)
    return main, template, {t["tok"] for t in tokens if t["kind"] == 1 and t["pages"] * 2 >= held}


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", max_broadcast_tokens: int = 200_000) -> DataFrame:
    """page_id, url, text, n_chars of every page from its whole html.

    Templates (a row per host) are broadcast if they have at most `max_broadcast_tokens` tokens altogether, else joined
    by host, where adaptive execution splits the pages of hot hosts. Defined results: null or empty html gives an empty
    text; very long html is read whole, in a block of its own; pages without url share one host; a page on a host of one or two is read by its own
    elements; of main slots that tie the one with more text, then the smaller token counts; br is white space inside its
    block; text outside any element counts; tags that are never closed end with what holds them; rows that repeat are each
    extracted and each count for the template; a slot that has fixed texts alone keeps them; other columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    ship(spark)
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    base = base.withColumn("host", F.coalesce(split_url("url")["host"], F.lit("")))
    scratch = Scratch(spark)
    templates = scratch.table(deduce(base, scratch))
    size = templates.agg(F.sum(F.size("tokens"))).first()[0] or 0
    joined = base.join(F.broadcast(templates) if size <= max_broadcast_tokens else templates.hint("merge"), "host", "left")

    def read_pages(batches):
        known: dict[str, tuple] = {}
        for batch in batches:
            keys, urls, source, hosts, tokens = (batch.column(i) for i in range(5))
            for a, b in pieces(source):
                out = []
                for i in range(a, b):
                    host = hosts[i].as_py()
                    if host not in known:
                        if len(known) > 10_000:
                            known.clear()
                        known[host] = template_of(tokens[i].as_py() or [])
                    out.append(main_text(source[i].as_py(), *known[host]))
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), urls.slice(a, b - a), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "host", "tokens").mapInArrow(read_pages, "page_id long, url string, text string, n_chars long")


def op1_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
