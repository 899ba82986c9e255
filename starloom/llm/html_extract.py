"""Main text of web pages by a template deduced per host, with tags and names as hints.

A page is a sequence of tokens: tags, told apart by their place among the open
elements, and text blocks with their place.  Tokens of a host that are met equally often on every page - their
occurrence vectors are the same - form a class.  A class is kept if it is large (two tokens or more), is met on enough pages of
different content, and is valid: on every page its tokens come in one and the same order (tokens whose rank in the class
changes leave it first), its repetitions do not cross those of another class, and they begin in the same slot (between the same two
tokens) of the class around them.  Where two classes cross, the one that begins later is not valid.  Order and nesting are judged
page by page among the classes that are ordered on the page.  Valid classes, nested in each other, are the template; what stands
between their tokens are its slots.

Parts inside navigation, headers, footers, forms and comments - by element name, role or class - are left out.
If a page has an article or main element, its text is what that holds, also where the text itself is met on many pages.
In there, an ``aside`` or the like and names that may as well be names of article text (``related``, ``side``) are
left out only where the template confirms them: their opening tag is one of its tokens.  On other pages the text is what the slots hold.

Defined cases: NULL and empty pages give empty text; a NULL url or one without a
host belongs to the host ``''``; broken markup is read as browsers do in the main
(an unclosed element ends with its parent; a quote that never closes ends with the
tag; ``noscript``, ``svg`` and the like without an end tag are not left out); pages of any length are read whole; repeated rows are
treated alike and count once in the template; an empty table gives no rows; other columns
are not looked at.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..limits import DEFAULT, Limits
from ..operators.skew import skew_join
from ..scratch import materialize
from .words import mix64

# A token is part of the template if at least this share of the host's pages, and so many, have it.
TEMPLATE_SHARE = 0.3
TEMPLATE_PAGES = 5

# Elements whose content is not markup, and elements whose content is not text of the page.
_RAW = ("script", "style", "iframe", "textarea", "title", "xmp")
_SKIPPED = frozenset("noscript template svg object select".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that begin and end a block.
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_PARAGRAPH_ENDS = _BLOCK - {"body", "html", "head"}
_LEFT_OUT = frozenset("nav footer form head button menu dialog".split())
_LEFT_OUT_BESIDE = frozenset("aside search fieldset label".split())  # in an article only if the template confirms it
_MAIN = frozenset(("article", "main"))
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
# Words that name a part that is not text of the page, if they are a whole class or id ...
_NAME = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|sidebar|"
    r"side|menu|nav|navbar|navigation|breadcrumbs?|comments?|commentlist|disqus|repl(?:y|ies)|respond|footer|masthead|"
    r"newsletter|subscribe|signup|login|share|sharing|social|related|recommended|widget|toolbar|pagination|pager|skip"
)
# These say so even of a part of an article; of the others the template must confirm it there.
_SURE = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|sidebar|nav|navbar|navigation|breadcrumbs?|comments?|commentlist|"
    r"disqus|replies|respond|footer|newsletter|subscribe|pagination"
)
_SURE_OF_PART = re.compile("share|sharing|social")  # unless they are a paragraph or heading themselves
_TEXT_ELEMENTS = frozenset("p h1 h2 h3 h4 h5 h6".split())
# ... or all of it but these: what holds such a part, and where.
_BESIDE = frozenset(
    "area bar block box button buttons container form group holder inner items links list outer panel section slot unit wrap wrapper "
    "bottom left main mobile page primary right secondary site top to".split()
)
_PARTS = re.compile(r"[-_]+")


def _names_part(mark: str, name: str) -> str:
    """Whether a class or id of an element names a part that is left out, one of its blank-separated words being such a name as a whole:
    ``sure``, ``maybe`` or nothing."""
    found = ""
    for token in mark.lower().split():
        parts = [w for w in _PARTS.split(token) if w]
        named = [bool(_NAME.fullmatch(w)) for w in parts]
        if token == "site-header" or any(named) and all(n or w in _BESIDE or w.isdigit() for n, w in zip(named, parts)):
            if token == "site-header" or any(_SURE.fullmatch(w) or name not in _TEXT_ELEMENTS and _SURE_OF_PART.fullmatch(w) for w in parts):
                return "sure"
            found = "maybe"
    return found


_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(" + "|".join(_RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class _Name:
    """An open element that may be left out: taken back by an article or main further in, or a matter of the template."""

    __slots__ = ("holds", "sure", "at")

    def __init__(self, sure: bool, at: int) -> None:
        self.holds, self.sure, self.at = True, sure, at


class _Open:
    __slots__ = ("name", "path", "out", "main", "named")

    def __init__(self, name: str, path: str, out: bool, main: bool, named: tuple[_Name, ...]) -> None:
        self.name, self.path, self.out, self.main, self.named = name, path, out, main, named


class Token(NamedTuple):
    """A tag or text block of a page; ``by``: which tokens, if they are in the template, leave it out."""

    place: str
    text: str  # empty for a tag
    out: bool
    main: bool
    by: tuple[int, ...]


def page_tokens(page: str) -> list[Token]:
    """Tokens in page order."""
    # What a name leaves out is known at the end only: an article or main further in takes it back.
    found = []
    for place, text, out, main, named in _tokens(page):
        holds = [n for n in named if n.holds]
        left = out or any(n.sure or not main for n in holds)
        found.append(Token(place, text, left, main, () if left else tuple(n.at for n in holds)))
    return found


def page_blocks(page: str) -> list[tuple[str, str, bool, bool]]:
    """Tokens in page order as a page without a template has them: place, text, left out, inside the main slot."""
    return [t[:4] for t in page_tokens(page)]


def _skipped_ends(marks: list[re.Match]) -> dict[int, int]:
    """For each element whose content is skipped and that has an end tag: which tag opens and which ends it."""
    open_: dict[str, list[int]] = {}
    ends = {}
    for i, m in enumerate(marks):
        name = m[3].lower() if m[3] else ""
        if name in _SKIPPED:
            if not m[2]:
                if not m[4].endswith("/"):
                    open_.setdefault(name, []).append(i)
            elif open_.get(name):
                ends[open_[name].pop()] = i
    return ends


def _tokens(page: str) -> Iterator[tuple[str, str, bool, bool, tuple[_Name, ...]]]:
    """Tokens with the open elements that may be left out."""
    open_ = [_Open("", "", False, False, ())]
    text: list[str] = []
    at = count = 0

    def block() -> Iterator[tuple[str, str, bool, bool, tuple[_Name, ...]]]:
        nonlocal count
        words = entities.unescape("".join(text)).split()
        text.clear()
        if words:
            count += 1
            yield open_[-1].path, " ".join(words), open_[-1].out, open_[-1].main, open_[-1].named

    marks = list(_TOKEN.finditer(page))
    ends, upto = _skipped_ends(marks), -1
    for i, m in enumerate(marks):
        if i <= upto:
            continue
        text.append(page[at : m.start()])
        at = m.end()
        name = m[3].lower() if m[3] else ""
        if not name:
            continue
        if name in _SKIPPED and not m[2] and i in ends:
            upto = ends[i]
            at = marks[upto].end()
            continue
        if name in ("br", "wbr", "img"):
            text.append(" " if name != "wbr" else "")
            continue
        if name not in _BLOCK:
            continue  # inline: neither ends a block nor holds one
        yield from block()
        if m[2]:
            for j in range(len(open_) - 1, 0, -1):
                if open_[j].name == name:
                    del open_[j:]
                    break
            continue
        if name in _VOID:
            continue
        if name in _PARAGRAPH_ENDS and open_[-1].name == "p" or name in ("li", "option", "td", "th", "tr", "dt", "dd") and open_[-1].name == name:
            open_.pop()
        marked = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(m[4])}
        up = open_[-1]
        role = marked.get("role", "").lower()
        out = up.out or name in _LEFT_OUT or name == "header" and not up.main or role in _ROLES
        holds = name in _MAIN or role == "main"
        named = up.named
        if holds and (name != "article" or not up.main):  # an article inside another is a comment on it or the like
            for n in named:
                n.holds = False
        elif not holds and name not in ("body", "html"):
            said = {_names_part(marked.get(k, ""), name) for k in ("class", "id")}
            if "sure" in said or "maybe" in said or name in _LEFT_OUT_BESIDE:
                named = (*named, _Name("sure" in said or name in _LEFT_OUT_BESIDE and not up.main, count))
        label = name + "".join("." + w for w in sorted(marked.get("class", "").split()))
        main = up.main or holds
        open_.append(_Open(name, f"{up.path}>{label}", out, main, named))
        count += 1
        yield open_[-1].path, "", out, main, named
    text.append(page[at:])
    yield from block()


def _hash(values: list[str]) -> np.ndarray:
    """64 bits of each text, the same in every task."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(v.encode("utf-8", "surrogatepass")) for v in values), np.uint64, len(values))


def host_of(url_col: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url_col}`"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def parse(pages: DataFrame) -> DataFrame:
    """Read each page once: host, page_id, url, hash of the content, its tokens in order, and the text blocks that are not left
    out (text, which token it is, in the main slot, which tokens leave it out if they are in the template).

    ``pages`` has page_id, url, host, page_key and html.
    """
    block = pa.struct([("text", pa.string()), ("at", pa.int32()), ("main", pa.bool_()), ("by", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, kept = [], []
            for page in batch.column(4):
                found = page_tokens(page.as_py() or "")
                tokens.append(_hash([f"{t.place}\0{t.text}" for t in found]).view(np.int64))
                kept.append([{"text": t.text, "at": i, "main": t.main, "by": t.by} for i, t in enumerate(found) if t.text and not t.out])
            columns = [*batch.columns[:4], pa.array(tokens, pa.list_(pa.int64())), pa.array(kept, pa.list_(block))]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "host", "page_key", "tokens", "blocks"])

    kind = pages.schema["page_id"].dataType.simpleString()
    shape = "tokens array<long>, blocks array<struct<text: string, at: int, main: boolean, by: array<int>>>"
    return pages.select("page_id", "url", "host", "page_key", "html").mapInArrow(run, f"page_id {kind}, url string, host long, page_key long, {shape}")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page and distinct token: its part of the occurrence vector, a hash of page and count."""
    for batch in batches:
        hosts, keys, tokens, vectors = [], [], [], []
        for host, key, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            distinct, counts = np.unique(found.values.to_numpy(zero_copy_only=False), return_counts=True)
            # Three bytes less, so that sums over very many pages stay within 64 bits.
            part = mix64(counts.astype(np.uint64) + np.uint64(key & ((1 << 64) - 1))) >> np.uint64(24)
            hosts.append(np.full(len(distinct), host))
            keys.append(np.full(len(distinct), key))
            tokens.append(distinct)
            vectors.append(part.view(np.int64))
        if hosts:
            arrays = [pa.array(np.concatenate(c).astype(np.int64)) for c in (hosts, keys, tokens, vectors)]
            yield pa.RecordBatch.from_arrays(arrays, names=["host", "page_key", "token", "vector"])


def classes_of(parsed: DataFrame, share: float = TEMPLATE_SHARE, least: int = TEMPLATE_PAGES) -> DataFrame:
    """host, tokens, classes: tokens with the same occurrence vector have the same class, the vector.

    Classes are those met on enough pages, with two tokens or more.  Pages of a host with the same content count once.
    """
    met = parsed.select("host", "page_key", "tokens").mapInArrow(_parts, "host long, page_key long, token long, vector long")
    # Copies have the same key, hence the same vector.
    once = met.groupBy("host", "token", "page_key").agg(F.min("vector").alias("vector"))
    summed = once.groupBy("host", "token").agg(F.sum("vector").alias("vector"), F.count(F.lit(1)).alias("pages"))
    summed = materialize(summed.filter(F.col("pages") >= least), "tokens")
    size = parsed.select("host", "page_key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    often = summed.join(size, "host").filter(F.col("pages") >= share * F.col("of"))
    # A host has at most 1 / share times the tokens of a page.
    return _grouped(often)


def _grouped(tokens: DataFrame) -> DataFrame:
    """host, class_tokens (ascending), classes: large classes of tokens (host, token, vector)."""
    grouped = tokens.groupBy("host", "vector").agg(F.collect_list("token").alias("of_class")).filter(F.size("of_class") > 1)
    named = grouped.select("host", F.explode("of_class").alias("token"), F.col("vector").alias("class"))
    return named.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("token", "class"))).alias("found")).select(
        "host", F.col("found.token").alias("class_tokens"), F.col("found.class").alias("classes")
    )


def _on_page(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, dict[int, int]]]:
    """Per page with the classes of its host: host, tokens in a class in page order, their classes, and sizes of classes."""
    for host, tokens, known, classes in zip(batch.column(0).to_pylist(), *(batch.column(i) for i in (1, 2, 3))):
        tokens, known, classes = (x.values.to_numpy(zero_copy_only=False) for x in (tokens, known, classes))
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        here = known[at] == tokens
        numbers, counts = np.unique(classes, return_counts=True)
        yield host, tokens[here], classes[at[here]], dict(zip(numbers.tolist(), counts.tolist()))


def _ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, token, rank: the place of each token of a class in its repetition of the class on a page.

    Tokens of a class are equally often on a page, so repetitions are runs of as many tokens as the class has.
    """
    for batch in batches:
        found = []
        for host, tokens, classes, sizes in _on_page(batch):
            order = np.argsort(classes, kind="stable")
            by_class = classes[order]
            number = np.arange(len(by_class)) - np.searchsorted(by_class, by_class)
            rank = number % np.array([sizes[c] for c in by_class.tolist()], np.int64)
            found.append((np.full(len(rank), host), tokens[order], by_class, rank))
        if found:
            arrays = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays(arrays, names=["host", "token", "vector", "rank"])


def judge(sequence: list[tuple[int, int]], sizes: dict[int, int]) -> dict[int, tuple[int, bool, int]]:
    """What one page says of the classes on it: the order of their tokens, whether that is kept and nothing is crossed, and the
    slot in which they begin.  ``sequence`` has class and token in page order."""
    import xxhash

    def number(values: list[int]) -> int:
        return xxhash.xxh3_64_intdigest(np.array(values, np.int64).tobytes()) >> 1

    by_class: dict[int, list[int]] = {}
    for c, t in sequence:
        by_class.setdefault(c, []).append(t)
    place = {c: {t: i for i, t in enumerate(ts[: sizes[c]])} for c, ts in by_class.items()}
    bad = {c for c, ts in by_class.items() if len(place[c]) != sizes[c] or ts != ts[: sizes[c]] * (len(ts) // sizes[c])}
    unordered, begins = set(bad), {}
    open_: list[list[int]] = []  # class, tokens of it that were met
    for c, t in sequence:
        if c in unordered:
            continue
        i = place[c][t]
        if i == 0:
            slot = number(open_[-1]) if open_ else 0
            if begins.setdefault(c, slot) != slot:
                bad.add(c)
            open_.append([c, 1])
            continue
        while any(o[0] == c for o in open_) and open_[-1][0] != c:
            bad.add(open_.pop()[0])
        if not open_ or open_[-1][0] != c:
            bad.add(c)
            continue
        open_[-1][1] += 1
        if open_[-1][1] == sizes[c]:
            open_.pop()
    return {c: (number(ts[: sizes[c]]), c not in bad, begins.get(c, 0)) for c, ts in by_class.items()}


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``judge`` for pages with the classes of their host."""
    for batch in batches:
        rows = []
        for host, tokens, classes, sizes in _on_page(batch):
            found = judge(list(zip(classes.tolist(), tokens.tolist())), sizes)
            rows += [(host, c, order, valid, slot) for c, (order, valid, slot) in found.items()]
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["host", "class", "order", "valid", "slot"])


def _with_hosts(pages: DataFrame, known: DataFrame, how: str, limits: Limits) -> DataFrame:
    """Pages with the row of their host in ``known``, which is stored.  The measured size decides between a broadcast and a salted join."""
    numbers = sum((F.size(c) * 8 for c, t in known.dtypes if t.startswith("array")), F.lit(64))
    if (known.agg(F.sum(numbers)).first()[0] or 0) <= limits.broadcast_bytes // 8:
        return pages.join(F.broadcast(known), "host", how)
    return skew_join(pages, known, "host", how, limits, small=False)


def templates(parsed: DataFrame, share: float = TEMPLATE_SHARE, least: int = TEMPLATE_PAGES, limits: Limits = DEFAULT) -> DataFrame:
    """host, template: the tokens of the valid classes of each host."""
    pages, columns = parsed.select("host", "tokens"), ("host", "tokens", "class_tokens", "classes")
    classes = materialize(classes_of(parsed, share, least), "classes")
    met = _with_hosts(pages, classes, "inner", limits).select(*columns)
    ranks = met.mapInArrow(_ranks, "host long, token long, vector long, rank long")
    firm = ranks.groupBy("host", "token", "vector").agg(F.min("rank").alias("least"), F.max("rank").alias("most"))
    known = materialize(_grouped(firm.filter("least = most")), "ordered_classes")
    met = _with_hosts(pages, known, "inner", limits).select(*columns)
    said = met.mapInArrow(_judged, "host long, class long, order long, valid boolean, slot long")
    sums = [f(c) for c in ("order", "slot") for f in (F.min, F.max)]
    agreed = said.groupBy("host", "class").agg(F.min("valid").alias("valid"), *[s.alias(f"_{i}") for i, s in enumerate(sums)])
    valid = agreed.filter("valid and _0 = _1 and _2 = _3").groupBy("host").agg(F.collect_list("class").alias("valid"))
    of_valid = F.filter(F.arrays_zip("class_tokens", "classes"), lambda t: F.array_contains("valid", t["classes"]))
    return known.join(valid, "host").select("host", F.transform(of_valid, lambda t: t["class_tokens"]).alias("template"))


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    share: float = TEMPLATE_SHARE,
    least: int = TEMPLATE_PAGES,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"),
        host_of(url_col).alias("host"),
    )
    parsed = materialize(parse(rows.withColumns({"page_key": F.xxhash64("html"), "host": F.xxhash64("host")})), "parsed_pages")
    found = materialize(templates(parsed, share, least, limits), "templates")
    joined = _with_hosts(parsed.select("page_id", "url", "host", "tokens", "blocks"), found, "left", limits)
    template = F.coalesce("template", F.array().cast("array<long>"))

    def left_out(b):
        return F.exists(b["by"], lambda i: F.array_contains(template, F.get("tokens", i)))

    main = F.filter("blocks", lambda b: b["main"] & ~left_out(b))
    slots = F.filter("blocks", lambda b: ~F.array_contains(template, F.get("tokens", b["at"])))
    chosen = F.when(F.exists("blocks", lambda b: b["main"]), main).otherwise(slots)
    text = F.array_join(F.transform(chosen, lambda b: b["text"]), "\n\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
