"""Main text of web pages by template deduction over equivalence classes.

Pages of a host share a template. Its tokens are element paths and fixed texts at a path; a token's
occurrence vector says how often it stands on each differing page of the host. Tokens with the same vector
form an equivalence class; classes that occur on enough pages make up the template. Its fixed texts are
dropped; inside an article only those that stand in elements of the template that are no headings, paragraphs,
list items or cells, for these are what the slots of an article hold. Which of the slots hold the article is told by
elements and by names in class, id and role, not by classes. Inside an article a name counts only where a whole label
says nothing else.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from comptoir.llm.arrays import U64, arrow_map
from comptoir.operators.skew import splittable_join
from comptoir.session import cut_lineage

SUPPORT = 0.5
"""Share of a host's pages that a template's tokens occur on, at least."""
LEAST_PAGES = 3
"""Differing pages that a template's tokens occur on, at least; two pages may be versions of one text."""
_MAIN_BIT, _OUT_BIT = 1 << 61, 1 << 60
# Elements whose texts belong to an article wherever they stand in it.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th caption blockquote pre figcaption summary details address center hgroup".split())

# Elements that end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noframes noscript object ol optgroup "
    "option p pre search section select summary svg table tbody td template textarea tfoot th thead title tr ul video audio canvas".split()
)
# Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no running text of a page.
LEFT_OUT = frozenset(
    "head title script style noscript template iframe object svg canvas audio video nav menu footer aside form button select option "
    "optgroup textarea dialog frameset noframes search dir fieldset legend".split()
)
# Words in class, id or role that name something other than the article.
LEFT_OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert alerts popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer "
    "masthead complementary contentinfo search comment comments reply replies discussion disqus respond share sharing social related "
    "recommended newsletter subscribe subscription signup login toolbar pagination pager skip hidden widget widgets form tooltip".split()
)
# Words that tell of place and shape alone, so that a label of them and the words above says nothing else.
PLAIN_NAMES = frozenset(
    "left right top bottom side main page pages site post posts article articles entry entries blog stories box block container wrapper wrap inner outer section area list lists "
    "item items bar link links button buttons icon icons header head body content panel card unit slot zone group row col column grid area "
    "first last small large sticky fixed view js id class the of in for by and".split()
)
# Names of parts of an article as well.
_PARTS_TOO = frozenset(("discussion", "form", "search", "related", "social", "alert", "alerts"))
_WHOLE = "="
MAIN = frozenset(("article", "main"))
# Labels such as "has-sidebar", and those of whole pages, tell what stands elsewhere.
_ABOUT_OTHERS = frozenset(("has", "with", "without", "no", "not"))
_NAMED_FOR_OTHERS = frozenset(("html", "body", "main"))
_NO_ARTICLE = frozenset("comment comments reply replies ad ads advert advertisement promo sponsored related recommended hidden".split())
_OUTSIDE_MAIN = frozenset(("header", "hgroup"))
_OUTSIDE_MAIN_NAMES = frozenset(("header", "topbar"))
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
_PHRASING = frozenset("p h1 h2 h3 h4 h5 h6".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|iframe|noframes|xmp)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*>|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
_NOT_WORD = re.compile(r"[^a-z0-9]+")


def _step(tag: str, attributes: str) -> str:
    """An element's step in a path: its name, and the names from its attributes that tell what it is for."""
    if not attributes or attributes.isspace():
        return tag
    found = set()
    for m in _NAMED.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            found.update(("hidden", _WHOLE + "hidden"))
        elif name in ("class", "id", "role") and tag not in _NAMED_FOR_OTHERS:
            for label in value.split():
                words = _NOT_WORD.split(label)
                if not _ABOUT_OTHERS.intersection(words):
                    telling = [w for w in words if w in LEFT_OUT_NAMES]
                    found.update(telling, (w for w in words if w in _OUTSIDE_MAIN_NAMES or w in MAIN))
                    nothing_else = all(not w or w.isdigit() or w in LEFT_OUT_NAMES or w in PLAIN_NAMES for w in words)
                    if nothing_else and (len(words) > 1 or not _PARTS_TOO.issuperset(telling)):
                        found.update(_WHOLE + w for w in telling)
    if tag == "article":
        found = {w for w in found if w.removeprefix(_WHOLE) in _NO_ARTICLE}
    return ".".join([tag, *sorted(found)])


def chunks(page: str) -> Iterator[tuple[str, str, bool]]:
    """(path, text, begins a block) of each text between tags, in order, and (path, "", True) where an element opens."""
    path: list[str] = []
    names: list[str] = []
    at, fresh = 0, True

    def close_from(i: int) -> None:
        del path[i:], names[i:]

    for m in _MARKUP.finditer(page):
        if m.start() > at:
            yield "/".join(path), page[at : m.start()], fresh
            fresh = False
        at = m.end()
        raw = m[1]
        if raw:
            if raw.lower() in BLOCKS:
                fresh = True
            continue
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag == "br":
            yield "/".join(path), "\n", fresh
            fresh = False
            continue
        if tag not in BLOCKS:
            continue
        fresh = True
        if m[2]:
            for i in range(len(names) - 1, -1, -1):
                if names[i] == tag:
                    close_from(i)
                    break
            continue
        if tag in VOID or m[4].endswith("/"):
            continue
        if names and names[-1] in _PHRASING and tag not in ("button", "select", "option", "textarea", "svg", "object", "video", "audio", "canvas", "iframe", "template", "noscript"):
            close_from(len(names) - 1)  # a paragraph or heading ends where the next block begins
        if tag in _CLOSES:
            for i in range(len(names) - 1, -1, -1):
                if names[i] in _SCOPES[tag]:
                    break
                if names[i] in _CLOSES[tag]:
                    close_from(i)
                    break
        if tag in ("html", "body") and tag in names:
            continue
        if tag == "body" and "head" in names:
            close_from(names.index("head"))
        names.append(tag)
        path.append(_step(tag, m[4]))
        yield "/".join(path), "", True
    if at < len(page):
        yield "/".join(path), page[at:], fresh


_verdicts: dict[str, tuple[bool, bool]] = {}


def verdict(path: str) -> tuple[bool, bool]:
    """Whether a path is left out by what its steps are for, and whether it lies in an article or main element."""
    found = _verdicts.get(path)
    if found is None:
        out = main = False
        for step in path.split("/"):
            tag, *named = step.split(".")
            inside, main = main, main or tag in MAIN or any(n in MAIN for n in named)
            out = out or tag in LEFT_OUT or any(n.startswith(_WHOLE) or not inside and n in LEFT_OUT_NAMES for n in named)
            out = out or not main and (tag in _OUTSIDE_MAIN or any(n in _OUTSIDE_MAIN_NAMES for n in named))
        if len(_verdicts) > 100_000:
            _verdicts.clear()
        found = _verdicts[path] = (out, main)
    return found


def _tidy(text: str) -> str:
    return " ".join(html.unescape(text).split())


def _text_token(path: str, words: str, out: bool, main: bool) -> int:
    """A text at a path as a number: a hash (60 bits) and the path's verdict."""
    mark = int.from_bytes(blake2b(f"{path}\0{words}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")
    return 1 << 62 | main << 61 | out << 60 | mark >> 4


def tokens(page: str) -> dict[tuple[str, int], int]:
    """How often each token stands on a page: (path, 0) for an element, (path, text token) for a text at a path, and
    ("", 0) for the page itself."""
    found: Counter = Counter()
    found["", 0] = 1
    for path, text, _ in chunks(page):
        if not text:
            found[path, 0] += 1
        elif not text.isspace():
            words, (out, main) = _tidy(text), verdict(path)
            found[path, _text_token(path, words, out, main)] += 1
    return found


def _packed(found: dict[tuple[str, int], int]) -> bytes:
    """Tokens as lines, one for each path; pages with the same tokens have the same bytes."""
    lines: dict[str, list[str]] = {}
    for (path, text), times in sorted(found.items()):
        lines.setdefault(path, [path]).append(f"{text:x}.{times:x}")
    return "\n".join("\t".join(line) for line in lines.values()).encode("utf-8", "surrogatepass")


def _unpacked(packed: bytes) -> Iterator[tuple[str, int, int]]:
    for line in packed.decode("utf-8", "surrogatepass").split("\n"):
        path, *entries = line.split("\t")
        for entry in entries:
            text, _, times = entry.partition(".")
            yield path, int(text, 16), int(times, 16)


def host(url: str = "url"):
    """The host of an address in lower case, without user and port; null where there is none."""
    return F.lower(F.nullif(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def occurrence_vectors(pages: DataFrame) -> DataFrame:
    """``host, path, text, pages, times, vector`` of each token, from ``host`` and ``html``, over the differing
    pages of a host: those with the same tokens count once.

    An occurrence vector is as long as its host has pages, so it is carried as a sum over pages of a hash of
    the page times the count: equal vectors have equal sums, and sums are combined in every task and again by
    key, whatever share of the pages a host has. Copies are dropped in every task first, so that a page with
    very many copies does not gather in one.
    """
    def parsed(batches):
        seen: set[tuple[str, int]] = set()
        for batch in batches:
            hosts, marks, packs = [], [], []
            for name, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packed = _packed(tokens(page))
                mark = int.from_bytes(blake2b(packed, digest_size=8).digest(), "big", signed=True)
                if (name, mark) in seen:
                    continue
                if len(seen) > 100_000:
                    seen.clear()
                seen.add((name, mark))
                hosts.append(name)
                marks.append(mark)
                packs.append(packed)
            yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(marks, pa.int64()), pa.array(packs, pa.binary())], ["host", "mark", "tokens"])

    def summed_up(batches):
        held: dict[tuple, list[int]] = {}
        last = None

        def batch_of():
            keys = list(held)
            values = np.array(list(held.values()), U64).view(np.int64).reshape(-1, 3)
            return pa.record_batch([
                pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.int64()),
                *[pa.array(values[:, i]) for i in range(3)],
            ], ["host", "path", "text", "pages", "times", "vector"])

        mask = (1 << 64) - 1
        for batch in batches:
            marks = np.asarray(batch.column(1)).astype(np.int64).view(U64).tolist()
            for name, mark, packed in zip(batch.column(0).to_pylist(), marks, batch.column(2).to_pylist()):
                if (name, mark) == last:
                    continue
                last = (name, mark)
                for path, text, times in _unpacked(packed):
                    entry = held.get((name, path, text))
                    if entry is None:
                        held[name, path, text] = [1, times, mark * times & mask]
                    else:
                        entry[0] += 1
                        entry[1] += times
                        entry[2] = (entry[2] + mark * times) & mask
                if len(held) > 100_000:
                    yield batch_of()
                    held.clear()
        if held:
            yield batch_of()

    differing = pages.select("host", "html").transform(arrow_map, parsed, "host string, mark long, tokens binary").repartition("mark", "host").sortWithinPartitions("mark", "host")
    found = differing.transform(arrow_map, summed_up, "host string, path string, text long, pages long, times long, vector long")
    # halves, so that sums cannot overflow; their remainders modulo 2**32 are what is compared
    low, high = F.col("vector").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("vector", 32)
    summed = found.groupBy("host", "path", "text").agg(
        F.sum("pages").alias("pages"), F.sum("times").alias("times"),
        F.sum(low.cast("decimal(20,0)")).alias("low"), F.sum(high.cast("decimal(20,0)")).alias("high"),
    )
    return summed.select(
        "host", "path", "text", "pages", "times",
        F.struct((F.col("low") % (1 << 32)).cast("long").alias("low"), ((F.col("high") + F.floor(F.col("low") / (1 << 32))) % (1 << 32)).cast("long").alias("high")).alias("vector"),
    )


def deduce(vectors: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``host`` and ``template``: its fixed texts, as text tokens, of hosts with LEAST_PAGES differing pages.

    A class is the tokens of a host with one vector. Outside article and main elements, a text that occurs on
    enough pages is fixed if its class has another token. Inside, it is fixed if its class holds the element that it
    stands in, so that the element belongs to the template and never holds another text, and if that element is none
    of those that articles are written in. An element never stands on a page without those around it, so paths of a
    template nest by themselves.

    A fixed text stands on ``support`` of the pages, so a host has no more of them than ``1 / support`` times
    what its average page has texts: whatever the size of a template, it is sent whole, in 8 bytes a text.
    """
    often = cut_lineage(vectors.filter(F.col("pages") >= LEAST_PAGES))
    hosts = often.filter("path = '' AND text = 0").select("host", F.col("pages").alias("of"))
    enough = often.join(hosts.hint("shuffle_merge"), "host").filter(F.col("pages") >= F.col("of") * support)
    same = ["host", "vector", "pages", "times"]
    main = F.col("text").bitwiseAND(F.lit(_MAIN_BIT)) != 0
    tag = F.regexp_extract("path", r"([^/.]*)(?:\.[^/]*)?$", 1)
    classes = enough.select(
        "host", "text", main.alias("main"), tag.alias("tag"), F.count(F.lit(1)).over(Window.partitionBy(*same)).alias("size"),
        F.count_if(F.col("text") == 0).over(Window.partitionBy(*same, "path")).alias("own_element"),
    )
    used = (F.col("text") != 0) & (F.col("text").bitwiseAND(F.lit(_OUT_BIT)) == 0)  # what is left out anyway is not sent
    in_slot = F.col("main") & F.col("tag").isin(*sorted(PROSE))
    fixed = classes.filter(used & ~in_slot & F.expr("IF(main, own_element > 0, size > 1)"))
    return fixed.groupBy("host").agg(F.collect_list("text").alias("template"))


def main_text(page: str, fixed: frozenset[int] | None) -> str:
    """The article of a page: blocks in order with one blank between, without the ``fixed`` texts of its host.

    If the page has texts inside an article or main element, those are extracted, else all that are not left
    out by what elements and their names are for.
    """
    found: list[tuple[bool, bool, str]] = []
    any_main = False
    for path, text, fresh in chunks(page):
        if not text:
            continue
        out, main = verdict(path)
        if not out:
            filled = not text.isspace()
            if fixed and filled and _text_token(path, _tidy(text), out, main) in fixed:
                text = " "
            found.append((main, fresh, text))
            any_main = any_main or main and filled
        elif fresh:
            found.append((False, True, " "))
    if any_main:
        found = [f if f[0] else (True, f[1], " ") for f in found]
    return _tidy("".join(("\n" if fresh else "") + text for _, fresh, text in found))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", support: float = SUPPORT) -> DataFrame:
    """``key``, ``url`` and ``text``, the main text of every page (empty if it has none).

    Character references are decoded; white space in a block becomes one blank. A null body is empty. Pages
    without an address, and those of a host with fewer than LEAST_PAGES differing pages, have no template and
    are read by their own elements. Rows stay as they are, repeated ones too; an empty table gives no rows. Only the three named
    columns are read. A host's template is the only thing joined to its pages, many to one, so Spark can split
    a host with very many pages.
    """
    source = pages.select(F.col(key).alias("page"), F.col(url).alias("url"), F.coalesce(F.col(body), F.lit("")).alias("html"), host(url).alias("host"))
    # written, so that Spark knows its size and moves no page if it is small
    templates = cut_lineage(deduce(occurrence_vectors(source.filter("host IS NOT NULL").select("host", "html")), support))

    def run(batches):
        known: dict[str, frozenset] = {}
        for batch in batches:
            ids, urls, bodies, hosts, templates_of = [batch.column(i) for i in range(5)]
            texts = []
            for i, (page, name) in enumerate(zip(bodies.to_pylist(), hosts.to_pylist())):
                template = None
                if name is not None and templates_of[i].is_valid:
                    if name not in known:
                        if len(known) > 1000:
                            known.clear()
                        known[name] = frozenset(templates_of[i].as_py())
                    template = known[name]
                texts.append(main_text(page, template))
            yield pa.record_batch([ids, urls, pa.array(texts, pa.string())], ["page", "url", "text"])

    joined = splittable_join(source, templates, "host", "left").select("page", "url", "html", "host", "template")
    kind = joined.schema["page"].dataType.simpleString()
    return joined.transform(arrow_map, run, f"page {kind}, url string, text string").toDF(key, "url", "text")
