"""Main text of web pages, by the template that pages of a host share.

Every page is a sequence of tokens: its elements (by their path of tags and names) and its blocks of
text. Over the pages of a group, each token has an occurrence vector (how often it stands in each
page); tokens with the same vector form an equivalence class. Groups are a host and its layouts: pages
with the same element paths of up to ``LAYOUT_DEPTH`` levels outside of articles and of what is left out by name, if
they are at least ``LAYOUT_PAGES`` pages and ``LAYOUT_SHARE`` of the host's, so that a host has a bounded number. Classes of at
least ``CLASS_TOKENS`` tokens that stand in at least ``CLASS_PAGES`` pages and ``CLASS_SHARE`` of the group's pages are candidates.
In a page, a class is valid if its tokens stand in its order, and is nested into the template if they all lie in one
gap of each class taken before, or around it. What the tokens of the host's and the layout's template leave over are
the page's slots.

The main text is what stands in the slots of the article: the page's ``article`` or ``main`` element,
or, where it names none, the element that holds most of the text of its layout, else of its host, less blocks
that are template tokens. Tokens count inside articles, too. A class that holds more than ``COPY_SHARE``
of what the group's articles hold on average is not template but a copied article, and an article
of nothing but template text stays whole. Elements that are by tag, role or name a menu, header, footer, sidebar,
notice, advert, form or comment are left out outside of articles. Inside, a tag or role does the same and a name is
a hint: a whole name counts where elements of that path and name stand in at least ``CLASS_PAGES`` pages of the
host, a part of one where a template holds the element, and both where a template holds all of its text.
Where a host has no template (a null url, few pages), a whole name or the last part of one
decides. An id says nothing of a heading, nor a part of one of a section.

Occurrence vectors are summed as two hashes, so no vector is ever held; templates are one row a host.
Pages cross one exchange, compressed, dealt by host and a salt. A host that holds more than its share of one of the
session's shuffle partitions has as many salts as such shares, so no group of a host and a salt is expected to outgrow one
partition's share, whatever the size of the input; there are fewer such hosts than partitions. Pages without a host
have no template to meet and are dealt over all salts.

Defined cases: a null or empty html has an empty text; a null url belongs to no host and is extracted
by names alone; rows that repeat a page count as pages of their own; broken markup is read as far
as it goes, an unclosed comment, script or style to its end. Extra columns are ignored.
"""

from __future__ import annotations

import html as references
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, same, small_batches
from .urls import host_of

CLASS_TOKENS = 2
CLASS_PAGES = 3
CLASS_SHARE = 0.5
#: Levels of elements that make a layout; the pages and the share of the host's pages that one needs.
LAYOUT_DEPTH = 4
LAYOUT_PAGES = 10
LAYOUT_SHARE = 0.05
#: The share of a group's text outside of articles that the main element holds, where pages name no article.
MAIN_SHARE = 0.5
#: The share of the group's mean article text above which a class is a copied article.
COPY_SHARE = 0.5

#: Elements without an end tag, elements that start a block of text, elements with no text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "textarea")
#: Tags, roles and words in names of what is not the article.
OTHER_TAGS = frozenset("head title nav footer aside form menu dialog button select datalist fieldset".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
OTHER_NAMES = frozenset(
    "ad adbox ads adsbygoogle adslot advert advertisement adverts advertising alert alerts banner breadcrumb breadcrumbs comment "
    "commentarea commentlist comments consent cookie cookiebanner cookiebar cookies copyright disclaimer disqus footer gdpr login "
    "mainmenu masthead menu menus modal nav navbar navigation navmenu newsletter notice notices notification pager pagination popup "
    "promo promoted promotion related replies reply respond search share sharing sidebar sidebars sidenav signup social sponsor "
    "sponsored submenu subscribe toolbar topbar topnav widget widgets".split()
)
HEADER_NAMES = frozenset("header head".split())
ARTICLE_NAMES = frozenset("article content entry main page post story text body wrapper container".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MODIFIERS = frozenset("has with without no is js not".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<({'|'.join(RAW)})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*|[^>]*)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|style|aria-hidden|aria-label)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_NAMED = re.compile(r"class|id|role|style|aria-", re.IGNORECASE).search  # "id" is in "hidden"
_PARTS = re.compile(r"[-_\s\d]+|(?<=[a-z])(?=[A-Z])")


def _attributes(raw: str) -> dict[str, str]:
    if not raw or not _NAMED(raw):
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)}


def is_other(tag: str, named: dict[str, str], in_article: bool) -> bool:
    """Whether an element is, by tag, role or name, no part of an article."""
    if tag in ("html", "body"):
        return False
    if tag in OTHER_TAGS or tag == "header" and not in_article:
        return True
    if not named:
        return False
    if named.get("role", "").lower() in OTHER_ROLES or "hidden" in named or named.get("aria-hidden") == "true":
        return True
    if "display:none" in named.get("style", "").replace(" ", "").lower():
        return True
    if in_article:
        return False
    words = " ".join(named.get(a, "") for a in ("class", "id", "aria-label")).split()
    whole = {w.lower() for w in words}
    other = OTHER_NAMES | HEADER_NAMES
    if whole & other:
        return True
    if tag in ("article", "main") or whole & ARTICLE_NAMES:
        return False
    for word in words:
        parts = [p.lower() for p in _PARTS.split(word) if p]
        if parts and parts[0] not in MODIFIERS and other.intersection(parts):
            return True
    return False


def _names(tag: str, named: dict[str, str]) -> list[tuple[str, str]]:
    """(attribute, name) of an element in an article; a label is one name."""
    out = [(a, w) for a in ("class", "id") for w in named.get(a, "").split() if a == "class" or tag not in HEADINGS]
    return out + [("aria-label", named["aria-label"])] if named.get("aria-label") else out


#: What the name of a candidate says: a part of it, its last part, or the whole name.
PART, LAST, WHOLE = range(3)


def candidate(tag: str, named: dict[str, str]) -> tuple[str, int] | None:
    """The name of an element in an article that may be no part of it, and how far it says so."""
    names = _names(tag, named)
    whole = sorted(OTHER_NAMES.intersection(w.lower() for _, w in names))
    if whole:
        return " ".join([tag, *whole]), WHOLE
    if tag in ("article", "main") or ARTICLE_NAMES & {w.lower() for _, w in names}:
        return None
    found, last = [], PART
    for attribute, word in names:
        parts = [p.lower() for p in _PARTS.split(word) if p]
        if parts and parts[0] not in MODIFIERS and OTHER_NAMES.intersection(parts) and not (tag == "section" and attribute == "id"):
            found.append("-".join(parts))
            last = LAST if parts[-1] in OTHER_NAMES else last
    return (" ".join([tag, *found]), last) if found else None


class Block:
    """A block of text: its path, whether it stands in an article, the token before it, and its parts
    with the candidates around each, if there are any."""

    __slots__ = ("article", "parts", "path", "text", "tokens")

    def __init__(self, text: str, path: tuple[str, ...], article: bool, tokens: int, parts: list[tuple[str, tuple]]):
        self.text, self.path, self.article, self.tokens, self.parts = text, path, article, tokens, parts

    def without(self, dropped: set[int]) -> str:
        """The text less what stands in these candidates."""
        if not any(c in dropped for _, around in self.parts for c in around):
            return self.text
        return " ".join(references.unescape("".join(t for t, around in self.parts if not dropped.intersection(around))).split())


def parse(page: str) -> tuple[list[Block], list[int], dict[int, int], int]:
    """The blocks that are not something else by name, all tokens of the page, its candidates: {token: what the name says},
    and its layout."""
    blocks: list[Block] = []
    tokens: list[int] = []
    candidates: dict[int, int] = {}
    outline: set[str] = set()
    stack: list[tuple[str, bool, bool, str, tuple[int, ...]]] = []  # tag, other, article, label, candidates around
    parts: list[tuple[str, bool, tuple[int, ...]]] = []  # text, whether it stands in something else, candidates around
    digest = xxhash.xxh64_intdigest

    def flush() -> None:
        if not parts:
            return
        article = bool(stack) and stack[-1][2]
        own = "".join(t for t, other, _ in parts if not other)
        text = " ".join(references.unescape(own).split())
        aside = not text
        if aside:
            text = " ".join(references.unescape("".join(t for t, _, _ in parts)).split())
        kept = [(t, around) for t, other, around in parts if not other] if candidates else []
        parts.clear()
        if not text:
            return
        path = tuple(s[3] for s in stack if s[0] in CONTAINERS)
        tokens.append(digest("/".join(path) + "\0" + text))
        if not aside:
            blocks.append(Block(text, path, article, len(tokens), kept))

    def hold(text: str) -> None:
        parts.append((text, stack[-1][1], stack[-1][4]) if stack else (text, False, ()))

    at = 0
    for m in _MARKUP.finditer(page):
        if m.start() > at:
            hold(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            flush()
        if m[2]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if tag not in BLOCKS and any(s[0] in CONTAINERS for s in stack[k + 1 :]):
                        break  # an inline end tag closes no element around it
                    del stack[k:]
                    break
            continue
        if tag in VOID or m[4].endswith("/") and tag not in CONTAINERS:
            continue
        if tag in ("p", "li", "dt", "dd", "option", "tr", "td", "th"):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if stack[k][0] in CONTAINERS:
                    break
        if tag == "body":  # ends a head that has no end tag
            stack = [s for s in stack if s[0] == "html"]
        named = _attributes(m[4])
        _, other, article, _, around = stack[-1] if stack else ("", False, False, "", ())
        outside = not article
        out = is_other(tag, named, article)
        if tag in ("article", "main") and not out:
            # an article inside a form or header that wraps the whole page is still one
            wraps = all(s[0] in ("form", "header", "fieldset") for i, s in enumerate(stack) if s[1] and (i == 0 or not stack[i - 1][1]))
            other, article = other and not wraps, True
        label = tag + "".join(f".{w}" for w in sorted(named.get("class", "").split())[:4])
        stack.append((tag, other or out, article, label, around))
        if tag in CONTAINERS:
            path = [s[3] for s in stack if s[0] in CONTAINERS]
            tokens.append(digest("/".join(path)))
            if outside and not (other or out) and len(path) <= LAYOUT_DEPTH:
                outline.add("/".join(path))
        maybe = candidate(tag, named) if named and article and not (other or out) else None
        if maybe:  # its start and its name
            start = "/".join(s[3] for s in stack[:-1] if s[0] in CONTAINERS) + "\0" + maybe[0]
            tokens += [digest(start, 2), digest(start, 3)]
            candidates[tokens[-1]] = maybe[1]
            stack[-1] = (tag, other or out, article, label, (*around, tokens[-1]))
    if at < len(page):
        hold(page[at:])
    flush()
    return blocks, tokens, candidates, digest("\0".join(sorted(outline)))


#: Elements whose nesting makes a path.
CONTAINERS = frozenset(
    "article aside blockquote body details div dl fieldset figure footer form header html main menu nav ol section table ul".split()
)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _path_token(path: tuple[str, ...]) -> int:
    return _signed(xxhash.xxh64_intdigest("/".join(path), 1))


def page_tokens(page: str) -> tuple[dict[int, tuple[int, int, int]], dict[int, tuple[int, int]], list[int], int]:
    """{token: (count, first place, characters in articles)}, of blocks outside articles {path: (depth, characters)},
    the candidates whose whole name says what they are, and the layout."""
    blocks, tokens, candidates, layout = parse(page)
    named = {c for c, says in candidates.items() if says == WHOLE}
    seen: dict[int, tuple[int, int, int]] = {}
    for place, token in enumerate(tokens):
        n, first, _ = seen.get(token, (0, place, 0))
        seen[token] = n + 1, first, 0
    mass: dict[int, tuple[int, int]] = {}
    for b in blocks:
        if b.article:
            n, first, chars = seen[tokens[b.tokens - 1]]
            seen[tokens[b.tokens - 1]] = n, first, chars + len(b.without(named))
        else:
            for depth in range(len(b.path) + 1):
                path = _path_token(b.path[:depth])
                mass[path] = depth, mass.get(path, (0, 0))[1] + len(b.text)
    return {_signed(t): x for t, x in seen.items()}, mass, list(map(_signed, named)), _signed(layout)


def host_templates(pages: DataFrame) -> DataFrame:
    """(host, classes, main, names, layouts): of each host the candidate classes, each with its tokens in order and whether
    it is a copied article, the path of the element that holds most text outside of articles, the named elements
    of its articles that stand in ``CLASS_PAGES`` pages, and (layout, classes, main) of each layout."""
    own = pages.where("host IS NOT NULL").select("host", F.xxhash64("page_id", "html").alias("page"), "html")
    names = ["host", "layout", "kind", "token", "page", "n", "place", "mass"]

    def run(batches):
        for batch in batches:
            out = []
            for host, page, text in zip(batch.column("host").to_pylist(), batch.column("page").to_pylist(), batch.column("html"), strict=True):
                tokens, mass, named, layout = page_tokens(text.as_py() or "")
                inside = sum(chars for _, _, chars in tokens.values())
                out.append((host, layout, 0, 0, page, 1, int(inside > 0), inside))
                out += [(host, layout, 1, t, page, n, first, chars) for t, (n, first, chars) in tokens.items()]
                out += [(host, layout, 2, t, page, 1, depth, chars) for t, (depth, chars) in mass.items()]
                out += [(host, layout, 3, t, page, 1, 0, 0) for t in named]
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    rows = own.mapInArrow(run, "host long, layout long, kind int, token long, page long, n long, place long, mass long")
    # every row counts for its host (no layout) and for its layout
    group = ["host", "layout"]
    rows = rows.withColumn("layout", F.explode(F.array(F.lit(None).cast("long"), F.col("layout")))).where("kind <> 3 OR layout IS NULL")
    # the occurrence vector as two sums of 32-bit hashes of (page, count)
    vector = F.xxhash64("page", "n")
    low, high = vector.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(vector, 32)
    sums = rows.groupBy(*group, "kind", "token").agg(
        F.count("*").alias("pages"), F.sum(low).alias("v1"), F.sum(high).alias("v2"), F.sum("place").alias("places"), F.sum("mass").alias("mass")
    )
    # read several times below, so that pages are parsed once for it
    often = keep(sums.where((F.col("pages") >= CLASS_PAGES) | (F.col("kind") == 0) | (F.col("kind") == 2)), "tokens")
    mean = F.col("mass") / F.greatest("places", F.lit(1))
    counted = often.where("kind = 0").select("host", "layout", F.col("pages").alias("all_pages"), mean.alias("mean"))
    of_host = counted.where("layout IS NULL").select(F.col("host").alias("h"), F.col("all_pages").alias("host_pages"))
    large = (F.col("all_pages") >= LAYOUT_PAGES) & (F.col("all_pages") >= LAYOUT_SHARE * F.col("host_pages"))
    groups = counted.join(of_host, F.col("host") == F.col("h"))
    groups = groups.where(F.col("layout").isNull() | large & (F.col("all_pages") < F.col("host_pages")))
    groups = groups.select(F.col("host").alias("h"), F.col("layout").alias("l"), "all_pages", "mean")
    in_group = (F.col("host") == F.col("h")) & same(F.col("layout"), F.col("l"))
    frequent = often.where("kind = 1").join(groups, in_group).where(F.col("pages") >= CLASS_SHARE * F.col("all_pages"))
    member = F.struct((F.col("places") / F.col("pages")).alias("place"), F.col("token"))
    copied = (F.sum(F.col("mass") / F.col("pages")) > COPY_SHARE * F.max("mean")).alias("copied")
    classes = frequent.groupBy(*group, "pages", "v1", "v2").agg(F.array_sort(F.collect_list(member)).alias("members"), copied)
    classes = classes.where(F.size("members") >= CLASS_TOKENS)
    one = F.struct(F.col("pages"), F.transform("members", lambda x: x["token"]).alias("tokens"), F.col("copied"))
    classes = classes.groupBy(*group).agg(F.sort_array(F.collect_list(one), asc=False).alias("classes"))
    paths = often.where("kind = 2").join(groups, in_group).select(*group, "token", F.col("mass"), (F.col("places") / F.col("pages")).alias("depth"))
    whole = paths.where("depth = 0").select(F.col("host").alias("h"), F.col("layout").alias("l"), F.col("mass").alias("all_mass"))
    most = paths.join(whole, in_group).where(F.col("mass") >= MAIN_SHARE * F.col("all_mass"))
    mains = most.groupBy(*group).agg(F.max(F.struct("depth", "mass", "token")).getField("token").alias("main"))
    named = often.where("kind = 3").groupBy("host").agg(F.collect_list("token").alias("names"))
    # one row a host: its own template, and its layouts' in a list
    made = classes.select(*group, "classes", F.lit(None).cast("long").alias("main"))
    made = made.unionByName(mains.select(*group, F.lit(None).cast(classes.schema["classes"].dataType).alias("classes"), "main"))
    made = made.groupBy(*group).agg(F.max("classes").alias("classes"), F.max("main").alias("main"))
    of_layout = F.when(F.col("layout").isNotNull(), F.struct("layout", "classes", "main"))
    own_part = lambda c: F.max(F.when(F.col("layout").isNull(), F.col(c))).alias(c)
    made = made.groupBy("host").agg(own_part("classes"), own_part("main"), F.sort_array(F.collect_list(of_layout)).alias("layouts"))
    return made.join(named, "host", "left")


class Template:
    """What a host's row says of a page of some layout."""

    def __init__(self, row: dict | None):
        row = row or {}
        self.known = row.get("classes") is not None
        self.host, self.main = row.get("classes") or [], row.get("main")
        self.names = set(row.get("names") or ())
        self.layouts = {x["layout"]: x for x in row.get("layouts") or ()}

    def of(self, layout: int) -> tuple[list[list[dict]], int | None]:
        """The classes of each template of such a page, and its main path."""
        own = self.layouts.get(_signed(layout))
        if own is None:
            return [self.host], self.main
        return [self.host, own["classes"] or []], self.main if own["main"] is None else own["main"]


def template_tokens(tokens: list[int], classes: list[dict] | None) -> set[int]:
    """Tokens of the classes that are valid in this page and nest into one template."""
    first: dict[int, int] = {}
    for place, t in enumerate(tokens):
        first.setdefault(_signed(t), place)
    taken: list[np.ndarray] = []
    out: set[int] = set()
    for c in classes or ():
        places = np.array([first.get(t, -1) for t in c["tokens"]])
        if (places < 0).any() or (np.diff(places) < 0).any():
            continue
        nested = all(
            len(set(np.searchsorted(other, places).tolist())) == 1 or len(set(np.searchsorted(places, other).tolist())) == 1 for other in taken
        )
        if nested:
            taken.append(places)
            out.update(c["tokens"])
    return out


def dropped_candidates(blocks: list[Block], tokens: list[int], candidates: dict[int, int], fixed: set[int], template: Template) -> set[int]:
    """The candidates that stand in the template or whose blocks all do, and whole names that the host repeats; without a
    template, by name."""
    if not template.known:
        return {c for c, says in candidates.items() if says != PART}
    out = {c for c, says in candidates.items() if _signed(c) in (template.names if says == WHOLE else fixed)}
    held: dict[int, bool] = {}
    for b in blocks:
        for c in {c for _, around in b.parts for c in around}:
            whole = all(c in around or not t.strip() for t, around in b.parts)
            held[c] = held.get(c, True) and whole and _signed(tokens[b.tokens - 1]) in fixed
    return out | {c for c, template in held.items() if template}


def main_text(page: str, template: Template) -> str:
    blocks, tokens, candidates, layout = parse(page)
    templates, main = template.of(layout)
    fixed = set().union(*(template_tokens(tokens, classes) for classes in templates))
    named = [b for b in blocks if b.article]
    if named:
        fixed = fixed.difference(*(c["tokens"] for classes in templates for c in classes if c["copied"]))
        dropped = dropped_candidates(named, tokens, candidates, fixed, template) if candidates else set()
        left = [(b, t) for b in named if (t := b.without(dropped))]
        own = [t for b, t in left if _signed(tokens[b.tokens - 1]) not in fixed]
        return "\n".join(own or [t for _, t in left])
    slots = [b for b in blocks if _signed(tokens[b.tokens - 1]) not in fixed]
    inside = [b for b in slots if main is not None and any(_path_token(b.path[:k]) == main for k in range(len(b.path) + 1))]
    return "\n".join(b.text for b in inside or slots)


def large_hosts(pages: DataFrame, shares: int) -> DataFrame:
    """(large, salts): the hosts that hold more than one of ``shares`` equal parts of all pages, fewer than ``shares`` rows,
    and how many such parts each holds, rounded up."""
    total = max(pages.count(), 1)
    counts = pages.where("host IS NOT NULL").groupBy("host").agg(F.count("*").alias("pages"))
    salts = F.ceil(F.col("pages") * shares / F.lit(total)).cast("int").alias("salts")
    return keep(counts.where(F.col("pages") * shares > total).select(F.col("host").alias("large"), salts), "hosts")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of (page_id, url, html)."""
    small_batches(pages.sparkSession)
    host = F.xxhash64(host_of(F.col("url")))
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.when(host_of(F.col("url")).isNotNull(), host).alias("host"))
    shares = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = F.broadcast(large_hosts(own, shares))  # fewer rows than ``shares``
    salted = host_templates(own).join(large, F.col("host") == F.col("large"), "left")
    salted = salted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    salted = salted.select(F.col("host").alias("h"), F.col("salt").alias("s"), F.struct("classes", "main", "names", "layouts").alias("template"))

    def pack(batches):
        for batch in batches:
            data = [pa.compress(t, codec="zstd", asbytes=True) if len(t) else b"" for t in (x.as_py().encode() for x in batch.column("html"))]
            sizes = [len(x.as_py().encode()) for x in batch.column("html")]
            keys = ["page_id", "url", "host", "salt"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, keys), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())], names=[*keys, "n", "data"])

    salts = F.when(F.col("host").isNull(), F.lit(shares)).otherwise(F.coalesce("salts", F.lit(1)))
    salt = F.pmod(F.xxhash64("page_id", "url"), salts).cast("int").alias("salt")
    slim = own.join(large, F.col("host") == F.col("large"), "left").select("page_id", "url", "host", salt, "html")
    packed = slim.mapInArrow(pack, slim.drop("html").schema.add("n", "long").add("data", "binary"))
    both = packed.join(salted, (F.col("host") == F.col("h")) & (F.col("salt") == F.col("s")), "left")
    both = both.select("page_id", "url", "n", "data", "host", "template")

    def run(batches):
        host, template = None, Template(None)  # the last page's
        for batch in batches:
            texts = []
            for n, data, h, row in zip(*(batch.column(c) for c in ("n", "data", "host", "template")), strict=True):
                size = n.as_py()
                page = pa.decompress(data.as_py(), decompressed_size=size, codec="zstd", asbytes=True).decode() if size else ""
                if h.as_py() != host:
                    host, template = h.as_py(), Template(row.as_py())
                texts.append(main_text(page, template))
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    schema = both.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return both.mapInArrow(run, schema)
