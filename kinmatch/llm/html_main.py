"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its structural tags, told apart by their path of open elements with classes
and ids, and the text blocks outside of article bodies. A token's occurrence vector says how
often it occurs on each page of its host. Vectors are never built: each page adds a hash of
(page, count) to a sum for (host, token), so tokens of equal vectors have equal sums, whatever
the number of pages, and everything is pre-aggregated before the shuffle. Tokens of equal sums
are a class; classes on at least SUPPORT of a host's pages are valid. The largest class whose
tokens occur once a page is the host's template; the other valid classes nest in the slots
between its tokens.

The pages of a host are aligned with its template, and the slots between the template's tags are
judged by what all pages have in them: text in all, in links, in headings, and text that is the
template's own. Prose is what is neither in links nor the template's. The slots of the smallest
template element that holds most of the host's prose are the main text; an element around it is
taken instead if what it adds is prose rather than links or the template's text, and holds a
heading or at least half as much prose again. Slots that are mostly links are menus. A heading
before the element belongs to it if it has none. On a host of one page, copies not counted, the
page's own tags are the template and the element must hold nearly all of the prose.

An element `article` or `main` in the template says by itself what the main text is. In any case
elements for navigation, footers, sidebars, forms and the like are dropped by their tags, and
notices, adverts and reader comments by class, id or role if all words of it are such names: their
texts differ on every page, so that no statistics tell them from short paragraphs. A name is
overruled around the template's body where that holds more text than the slots beside it, and
where nothing else of the page is left. Repeated lines inside the body stay.

Defined results: a null or empty html gives the empty text; a null or odd url belongs to the
host ''; a very long page is read whole; broken markup is closed where its parent closes; a quote
in an unquoted value is part of it, and one that the page never closes ends at the next `>`; rows
with equal ids are pages of their own; rows with equal content have one vote on their host's
template, and each has its text; ties between classes go by their sums, those between elements to
the inner one; the template never removes all blocks of a page, which then stay; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, texts, written

SUPPORT = 0.5
LEAST_TOKENS = 3
#: Share of the prose that the main element holds: on hosts with a template, and on single pages.
MOST, NEARLY_ALL = 0.5, 0.8
#: Share of a slot's text in links from which on it is a menu.
MENU = 0.6

# Names of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
#: Elements that an element of the same or a listed name ends.
CLOSED_BY = {"p": frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl div table article section blockquote pre form hr header footer nav aside main figure address fieldset".split()), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
HEADINGS = frozenset("h1 h2 h3".split())
#: Elements that hold one text, or rows of them, and are no containers of a main text.
TEXTUAL = HEADINGS | frozenset("h4 h5 h6 p pre blockquote ul ol li dl dt dd table thead tbody tfoot tr th caption figure figcaption address fieldset details summary option".split())
BODIES = frozenset(["article", "main"])
DROPPED = frozenset("head nav footer aside form select button menu dialog svg canvas object audio video map".split())
DROPPED_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted promotion related respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split()
)
#: Of these the names that say nothing inside an article, which has a header of its own.
OUTSIDE = frozenset("banner header masthead".split())

# Attributes as HTML reads them: a quote starts a value only right after `=`. The second form of a
# tag is for one whose quotes are never closed: it ends at the next `>`.
_ATTRIBUTES = r"""(?>[\s/]+|[^\s/>][^\s/>=]*+(?>\s*+=\s*+(?>"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))?+)*+"""
_TAG = re.compile(rf"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES}(?=>|\Z)|[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""(?:^|[\s/"'])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)


class Block(NamedTuple):
    text: str
    path: str  # the innermost structural element
    body: bool  # in an article body
    dropped: bool
    by_tag: bool  # dropped by a tag's own name, not by a class, id or role
    depth: int  # of the innermost element that drops it, or -1
    inside: tuple[str, ...]  # paths of all open structural elements
    at: int  # the number of structural tokens before it
    linked: int  # characters of it in links
    heading: bool


def _named(attributes: str) -> tuple[str, list[list[str]]]:
    """What an element is called beside its tag, and the words of each of these names."""
    found = {k.lower(): v.strip("\"'").lower() for k, v in _NAMES.findall(attributes)} if "=" in attributes else {}
    names = [re.split(r"[^a-z]+", x) for x in " ".join(found.values()).split()]
    mark = "".join(f".{x}" for x in found.get("class", "").split()) + (f"#{found['id']}" if found.get("id", "").isalpha() else "")
    return mark, [[w for w in ws if w] for ws in names if any(ws)]


@lru_cache(1 << 16)
def _path(parent: str, name: str, mark: str) -> str:
    """An element's path, as its tag and a hash of all that is open, since paths may be long."""
    return f"{name}:{xxhash.xxh64_hexdigest(f'{parent}>{name}{mark}', 1)}"


def read_page(page: str | None) -> tuple[list[tuple[str, int]], list[Block]]:
    """Structural tokens with the text length in their element, and the text blocks, in order."""
    page = page or ""
    stack: list[tuple[str, str, bool, bool, int, bool, int]] = []  # name, path, in a body, dropped, its token, dropped by tag, depth
    tokens: list[list] = []
    blocks: list[Block] = []
    text: list[str] = []
    pos, linked, link = 0, 0, False

    def said(x: str) -> None:
        nonlocal linked
        text.append(x)
        if link:
            linked += len(x.strip())

    def flush() -> None:
        nonlocal linked
        if text:
            whole = " ".join(html_lib.unescape("".join(text)).split())
            text.clear()
            if whole:
                top = stack[-1] if stack else ("", "", False, False, -1, False, -1)
                blocks.append(Block(whole, top[1], top[2], top[3], top[5], top[6], tuple(s[1] for s in stack), len(tokens), min(linked, len(whole)), top[0] in HEADINGS))
                for s in stack:
                    tokens[s[4]][1] += len(whole)
            linked = 0

    def close() -> None:
        nonlocal link
        tokens.append(["/" + stack.pop()[1], 0])
        link = False

    for m in iter(lambda: _TAG.search(page, pos), None):
        said(page[pos : m.start()])
        pos = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in RAW:
            if not m[1]:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, pos)
                pos = end.end() if end else len(page)
                if name not in ("script", "style"):
                    flush()
            continue
        if name in INLINE:
            if name == "a":
                link = not m[1]
            continue
        if name in ("br", "wbr") or name in VOID - {"hr"}:
            text.append(" " if name != "wbr" else "")
            continue
        flush()
        if m[1]:
            if any(s[0] == name for s in stack):
                while stack[-1][0] != name:
                    close()
                close()
            continue
        while stack and name in CLOSED_BY.get(stack[-1][0], ()):
            close()
        if name == "hr":
            continue
        mark, names = _named(m[3])
        body, dropped, by_tag, depth = (stack[-1][2], stack[-1][3], *stack[-1][5:]) if stack else (False, False, False, -1)
        odd = name not in ("html", "body", "article", "main", "h1") and any(all(w in DROPPED_NAMES and not (body and w in OUTSIDE) for w in ws) for ws in names)
        tag = name in DROPPED or (name == "header" and not body)
        dropped, by_tag, depth = dropped or tag or odd, by_tag or tag, len(stack) if tag or odd else depth
        path = _path(stack[-1][1] if stack else "", name, mark)
        tokens.append([path, 0])
        stack.append((name, path, body or name in BODIES, dropped, len(tokens) - 1, by_tag, depth))
    said(page[pos:])
    flush()
    while stack:
        close()
    return [(t, n) for t, n in tokens], blocks


def _tag(token: str) -> str:
    return token.lstrip("/").partition(":")[0]


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", url or "")
    return m[1].lower() if m else ""


def _host() -> Column:
    """host_of as a column of the url."""
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^(?:[a-zA-Z][\\w+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1))


def _text_token(block: Block) -> str:
    return "|" + xxhash.xxh64_hexdigest(f"{block.path}|{block.text}".encode("utf-8", "surrogatepass"), 2)


class Mark(NamedTuple):
    """A token that occurs once on its page, or text that is no such token (token '')."""

    token: str
    place: int
    chars: int  # for a tag the text in its element, for a text what isn't dropped of it
    linked: int
    heading: int


def marks_of(tokens: list[tuple[str, int]], blocks: list[Block]) -> tuple[list[Mark], list[tuple[str, int, int, int]]]:
    """What a page consists of in order, and (token, count, place, chars) of repeated tokens."""
    names = ["" if x.body or x.dropped else _text_token(x) for x in blocks]
    count = Counter([t for t, _ in tokens])
    count.update(t for t in names if t)
    out: list[Mark] = []
    many: dict[str, list[int]] = {}
    k = 0
    for at in range(len(tokens) + 1):
        while k < len(blocks) and blocks[k].at == at:
            x, t = blocks[k], names[k]
            n = 0 if x.dropped else len(x.text)
            if t and count[t] > 1:
                many.setdefault(t, [count[t], at + k, 0])[2] += n
                t = ""
            new = Mark(t, at + k, n, x.linked if n else 0, n if x.heading else 0)
            if not t and out and not out[-1].token:
                out[-1] = Mark("", out[-1].place, out[-1].chars + n, out[-1].linked + new.linked, out[-1].heading + new.heading)
            else:
                out.append(new)
            k += 1
        if at < len(tokens):
            t, n = tokens[at]
            if count[t] == 1:
                out.append(Mark(t, at + k, n, 0, 0))
            else:
                many.setdefault(t, [count[t], at + k, 0])[2] += n
    return out, [(t, *x) for t, x in many.items()]


_MARK = "struct<token: string, place: int, chars: int, linked: int, heading: int>"
_MANY = "struct<token: string, n: int, place: int, chars: int>"
PAGE = f"host string, vote string, marks array<{_MARK}>, many array<{_MANY}>"


def _lists(rows: list[list[tuple]], fields: list[tuple[str, pa.DataType]]) -> pa.Array:
    """A list of structs for each row."""
    offsets = [0]
    for r in rows:
        offsets.append(offsets[-1] + len(r))
    flat = [x for r in rows for x in r]
    columns = list(zip(*flat)) or [[] for _ in fields]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, fields)], names=[n for n, _ in fields]))


def read_pages(pages: DataFrame) -> DataFrame:
    """PAGE rows: of each page the host, a hash of its tokens, and what marks_of says."""
    numbers = [("place", pa.int32()), ("chars", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, max(1, whole.num_rows), 500):
                b = whole.slice(start, 500)
                hosts, votes, marks, many = [], [], [], []
                for url, page in zip(b.column(0).to_pylist(), b.column(1)):
                    tokens, blocks = read_page(page.as_py())
                    once, more = marks_of(tokens, blocks)
                    content = xxhash.xxh3_128()
                    for t, _ in tokens:
                        content.update(t + "\n")
                    for x in blocks:
                        content.update(f"{x.at} {x.text}\n".encode("utf-8", "surrogatepass"))
                    hosts.append(host_of(url))
                    votes.append(content.hexdigest())
                    marks.append(once)
                    many.append(more)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hosts, pa.string()),
                        pa.array(votes, pa.string()),
                        _lists(marks, [("token", pa.string()), *numbers, ("linked", pa.int32()), ("heading", pa.int32())]),
                        _lists(many, [("token", pa.string()), ("n", pa.int32()), *numbers]),
                    ],
                    names=["host", "vote", "marks", "many"],
                )

    return map_batches(pages.select("url", "html"), run, PAGE)


def vectors(read: DataFrame) -> DataFrame:
    """Of PAGE rows one row for each token of a page, to be summed by (host, token): pages with
    the token, its occurrences, two sums of hashes of (page, count), its places, the text in it.
    The token '' stands for the page itself."""
    one = F.transform(F.filter("marks", lambda m: m["token"] != ""), lambda m: F.struct(m["token"].alias("token"), F.lit(1).alias("n"), m["place"].alias("place"), m["chars"].alias("chars")))
    page = F.array(F.struct(F.lit("").alias("token"), F.lit(1).alias("n"), F.lit(0).alias("place"), F.lit(0).alias("chars")))
    rows = read.select("host", "vote", F.explode(F.concat(page, one, "many")).alias("x"))
    h = F.xxhash64("vote", "x.n", F.lit(3))
    return rows.select(
        "host",
        "x.token",
        F.lit(1).cast("long").alias("pages"),
        F.col("x.n").cast("long").alias("total"),
        h.bitwiseAND(F.lit(0xFFFFFFFF)).alias("low"),
        F.shiftrightunsigned(h, 32).alias("high"),
        F.col("x.place").cast("double").alias("place"),
        F.col("x.chars").cast("long").alias("chars"),
    )


def occurrences(pages: DataFrame) -> DataFrame:
    return vectors(read_pages(pages))


def distinct_pages(pages: DataFrame) -> DataFrame:
    """PAGE rows, written: copies have one vote, or their own text would be a class."""
    return written(read_pages(pages).dropDuplicates(["host", "vote"]), "page-tokens")


def templates_of(read: DataFrame) -> DataFrame:
    """One row per host: n_pages, root (the template's tokens in order), nested (tokens of the
    other valid classes with the slot they are in), body (the path of the article body, or null)
    and texts (the text blocks that belong to valid classes)."""
    sums = [F.sum(c).alias(c) for c in ("pages", "total", "low", "high", "place", "chars")]
    stats = vectors(read).groupBy("host", "token").agg(*sums).where("token = '' or pages > 1")
    stats = written(stats, "occurrences")
    hosts = stats.where("token = ''").select(F.col("host").alias("_host"), F.col("pages").alias("n_pages"))
    vector = ["host", "n_pages", "pages", "total", "low", "high"]
    valid = stats.where("token <> '' and pages > 1").join(hosts, F.col("host") == F.col("_host")).where(F.col("pages") >= F.col("n_pages") * SUPPORT)
    # from here on the rows are bounded by the markup that a host's pages share
    token = F.struct((F.col("place") / F.col("pages")).alias("place"), "token", "chars")
    classes = valid.groupBy(*vector).agg(F.sort_array(F.collect_list(token)).alias("tokens"))
    best = Window.partitionBy("host").orderBy((F.col("total") == F.col("pages")).desc(), (F.size("tokens") >= LEAST_TOKENS).desc(), F.col("pages").desc(), F.size("tokens").desc(), "low", "high")
    ranked = classes.withColumn("k", F.row_number().over(best))
    is_root = (F.col("k") == 1) & (F.col("total") == F.col("pages")) & (F.size("tokens") >= LEAST_TOKENS)
    gathered = ranked.groupBy("host", "n_pages").agg(
        F.first(F.when(is_root, F.col("tokens")), ignorenulls=True).alias("r"), F.flatten(F.collect_list(F.when(~is_root, F.col("tokens")))).alias("others"), F.flatten(F.collect_list("tokens")).alias("every")
    )
    opened = F.filter("r", lambda t: F.split_part(t["token"], F.lit(":"), F.lit(1)).isin(*BODIES))
    body = F.array_max(F.transform(opened, lambda t: F.struct(t["chars"].alias("chars"), (-t["place"]).alias("first"), t["token"].alias("token"))))["token"]
    return gathered.select(
        "host",
        "n_pages",
        F.transform("r", lambda t: t["token"]).alias("root"),
        F.transform("others", lambda t: F.struct(F.size(F.filter("r", lambda r: r["place"] <= t["place"])).alias("slot"), t["token"].alias("token"))).alias("nested"),
        body.alias("body"),
        F.transform(F.filter("every", lambda t: t["token"].startswith("|")), lambda t: t["token"]).alias("texts"),
    )


def templates(pages: DataFrame) -> DataFrame:
    return templates_of(distinct_pages(pages))


class Slot:
    """What is in a slot, on one page or on all of a host: characters."""

    __slots__ = ("chars", "fixed", "heading", "linked")

    def __init__(self, chars: int = 0, linked: int = 0, fixed: int = 0, heading: int = 0):
        self.chars, self.linked, self.fixed, self.heading = chars, linked, fixed, heading

    def add(self, chars: int, linked: int, fixed: bool, heading: int) -> None:
        self.chars += chars
        if fixed:
            self.fixed += chars
        else:
            self.linked += linked
            self.heading += heading

    @property
    def prose(self) -> int:
        return max(0, self.chars - self.linked - self.fixed)


def frame_of(root: Iterable[str]) -> list[str]:
    """The tags of a template, between which its slots are."""
    return [t for t in root if not t.startswith("|")]


def aligned(order: list[str], frame: list[str]) -> bool:
    """Whether the tags of `frame` occur once each, in this order."""
    held = set(frame)
    return [t for t in order if t in held] == frame


def choose(frame: list[str], slots: dict[int, Slot], least: float) -> tuple[frozenset[int], bool] | None:
    """The slots that hold the main text, and whether the element that holds them is the page as
    a whole; None without prose or an element with the share `least` of it. Slot k is what comes
    after k tags of the frame."""
    total = sum(x.prose for x in slots.values())
    if not total:
        return None
    filled = sorted(slots)
    inside = lambda a, b, f: sum(f(slots[k]) for k in filled if a <= k <= b)
    opened = {t: k for k, t in enumerate(frame) if not t.startswith("/")}
    pairs = [(opened[t[1:]] + 1, k, _tag(t)) for k, t in enumerate(frame) if t.startswith("/") and opened.get(t[1:], k) < k]
    prose = {p: inside(p[0], p[1], lambda x: x.prose) for p in pairs if p[2] not in TEXTUAL}
    chain = sorted((p for p, n in prose.items() if n >= least * total), key=lambda p: p[1] - p[0])
    if not chain:
        return None
    best = chain[0]
    for p in chain[1:]:
        more = prose[p] - prose[best]
        noise = inside(p[0], p[1], lambda x: x.chars - x.prose) - inside(best[0], best[1], lambda x: x.chars - x.prose)
        titled = inside(p[0], p[1], lambda x: x.heading) > inside(best[0], best[1], lambda x: x.heading)
        if more > 0 and more >= noise and (titled or 2 * more >= prose[best]):
            best = p
    kept = {k for k in filled if best[0] <= k <= best[1] and slots[k].linked < MENU * slots[k].chars}
    if not inside(best[0], best[1], lambda x: x.heading):
        titles = [k for k in filled if k < best[0] and slots[k].heading]
        kept |= set(titles[-1:])
    return frozenset(kept), best[2] in ("html", "body")


SLOT = "host string, slot int, chars long, linked long, fixed long, heading long"


def slot_statistics(read: DataFrame, by_host: DataFrame) -> DataFrame:
    """SLOT rows, to be summed by (host, slot): pages aligned with the template of their host."""
    rows = read.select("host", "marks").join(by_host.select(F.col("host").alias("_host"), "root", "texts"), F.col("host") == F.col("_host")).select("host", "marks", "root", "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def drain() -> pa.RecordBatch:
            columns = list(zip(*[(*k, x.chars, x.linked, x.fixed, x.heading) for k, x in found.items()])) or [[]] * 6
            kinds = [pa.string(), pa.int32(), *[pa.int64()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in SLOT.split(", ")])

        found: dict[tuple[str, int], Slot] = {}
        for b in batches:
            for host, marks, root, texts in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
                frame, own = frame_of(root), set(texts or ())
                marks = marks.as_py()
                if not aligned([m["token"] for m in marks], frame):
                    continue
                held, at = set(frame), 0
                for m in marks:
                    if m["token"] in held:
                        at += 1
                    elif not m["token"] or m["token"].startswith("|"):
                        found.setdefault((host, at), Slot()).add(m["chars"], m["linked"], m["token"] in own, m["heading"])
            if len(found) > 50_000:
                yield drain()
                found = {}
        yield drain()

    return map_batches(rows, run, SLOT)


def decisions(read: DataFrame, by_host: DataFrame) -> DataFrame:
    """host, kept and whole (see choose) of the hosts whose template has no article body."""
    open_ = by_host.where("body is null and root is not null")
    slots = slot_statistics(read, open_).groupBy("host", "slot").agg(*[F.sum(c).alias(c) for c in ("chars", "linked", "fixed", "heading")])
    gathered = slots.groupBy("host").agg(F.collect_list(F.struct("slot", "chars", "linked", "fixed", "heading")).alias("slots"))  # as many as the template has tags
    rows = gathered.join(open_.select(F.col("host").alias("_host"), "root"), F.col("host") == F.col("_host")).select("host", "root", "slots")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for host, root, slots in zip(*(b.column(k).to_pylist() for k in range(3))):
                found = choose(frame_of(root), {x["slot"]: Slot(x["chars"], x["linked"], x["fixed"], x["heading"]) for x in slots}, MOST)
                if found:
                    out.append((host, sorted(found[0]), found[1]))
            columns = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.list_(pa.int32()), pa.bool_()))], names=["host", "kept", "whole"])

    return map_batches(rows, run, "host string, kept array<int>, whole boolean")


class Template(NamedTuple):
    body: str | None = None
    texts: frozenset[str] = frozenset()
    frame: tuple[str, ...] = ()
    kept: frozenset[int] | None = None
    whole: bool = False


def _in_slots(order: list[str], blocks: list[Block], frame: Iterable[str]) -> list[int]:
    """The slot of each block: how many tags of the frame come before it."""
    held, before = set(frame), [0]
    for t in order:
        before.append(before[-1] + (t in held))
    return [before[x.at] for x in blocks]


def by_slots(tokens: list[tuple[str, int]], kept: list[Block], host: Template) -> list[Block]:
    """The blocks in the slots that hold the main text, by the host's decision where the page has
    its template, else by the page alone."""
    order = [t for t, _ in tokens]
    frame, found = list(host.frame), (host.kept, host.whole) if host.kept is not None else None
    if not found or not aligned(order, frame):
        count = Counter(order)
        frame = [t for t in order if count[t] == 1]
        slots: dict[int, Slot] = {}
        for x, k in zip(kept, _in_slots(order, kept, frame)):
            slots.setdefault(k, Slot()).add(len(x.text), x.linked, _text_token(x) in host.texts, len(x.text) if x.heading else 0)
        found = choose(frame, slots, NEARLY_ALL)
    if found:
        chosen, whole = found
        said = [x for x, k in zip(kept, _in_slots(order, kept, frame)) if k in chosen]
        if said and not whole:
            return said
        kept = said or kept
    return [x for x in kept if _text_token(x) not in host.texts] or kept


def main_text(page: str | None, host: Template = Template()) -> str:
    """The main text of one page under its host's template."""
    tokens, blocks = read_page(page)
    body = host.body
    kept = [x for x in blocks if not x.dropped]
    # a name around the template's body, or around all of a page, does not speak for what is in it
    within = [x for x in blocks if body and body in x.inside and not x.by_tag and x.depth < x.inside.index(body)]
    if within:
        beside = [x for x in kept if body not in x.inside and _text_token(x) not in host.texts]
        if sum(len(x.text) for x in within) > sum(len(x.text) for x in beside):
            return "\n".join(x.text for x in within)
    kept = kept or [x for x in blocks if not x.by_tag]
    in_body = [x for x in kept if body in x.inside] if body else []
    if body and (in_body or not within) and any(t == body for t, _ in tokens):
        kept = in_body
    elif any(x.body for x in kept):
        kept = [x for x in kept if x.body]
    else:
        kept = by_slots(tokens, kept, host)
    return "\n".join(x.text for x in kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row."""
    read = distinct_pages(pages)
    by_host = written(templates_of(read), "templates")
    chosen = decisions(read, by_host).select(F.col("host").alias("_h"), "kept", "whole")
    by_host = by_host.join(chosen, F.col("host") == F.col("_h"), "left").select(F.col("host").alias("_host"), "body", "texts", "root", "kept", "whole")
    by_host = written(by_host, "decisions")
    # the template table is joined by what its size allows: broadcast below Spark's threshold,
    # else shuffled, where AQE splits the pages of a large host
    rows = pages.select("page_id", "url", "html", _host().alias("_h")).join(by_host, F.col("_h") == F.col("_host"), "left").select("page_id", "url", "html", "body", "texts", "root", "kept", "whole")
    kind = dict(pages.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for page, body, texts, root, kept, whole in zip(*(b.column(k) for k in range(2, 8))):
                kept = kept.as_py()
                root = frame_of(root.as_py() or ()) if kept is not None else ()
                host = Template(body.as_py(), frozenset(texts.as_py() or ()), tuple(root), None if kept is None else frozenset(kept), bool(whole.as_py()))
                out.append(main_text(page.as_py(), host))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return map_batches(rows, run, f"page_id {kind}, url string, text string, n_chars long")


def op6_equivalence_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(texts(spark, sf_dir, "pages"))
