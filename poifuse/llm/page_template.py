"""Main text of web pages by template deduction over the pages of a host (operator 1).

Tokens of a page are its element starts and ends, told apart by their path
(tags with ids and classes), and its text runs, told apart by path and words. Tokens with one occurrence vector over the pages of a host (the
same count on every page) form an equivalence class. A class is valid if it has two tokens
or more and is on at least SUPPORT of the host's pages; an element is in the
template if its mean end place doesn't come before its mean start place (the order
within a class is not checked further). Valid classes nest by their paths into the
host's template. Text runs in valid classes are fixed text. What remains are slots,
one per template path; the slots of navigation, adverts, forms, notices and the like
are told by tag, by words in ids and classes, and by the share of their text that is
links over all pages. The main slot is chosen from the text that is neither fixed nor
linked: an article or main element if it holds most of it and holds no further such
elements with text, or else the deepest path that holds most of it. Extraction keeps
what stands in the main slot, in order, without its linked slots; fixed text goes
only where the main slot is the whole body. Pages without the host's main slot, and
pages of hosts whose slot is the whole body, are read by tags where these hold most.

Names in ids, classes and roles, headers and forms set an element apart only while
it holds less than APART_SHARE (forms FORM_SHARE) of the text that isn't linked, and
not most of the text in main elements where all of that would be set apart; this is
counted over the host's pages, or in the page where its tags decide. Elements such
as nav, footer, aside or hidden ones are always apart, html and body never.

Occurrence vectors are never gathered: a token's vector is the xor of one hash per
page and count. A host's template is bounded by the tokens that most of its pages
share. Hosts with fewer than MIN_PAGES pages have no template; their
pages are read by tags and words in ids and classes alone.

Nulls and ties: a null html gives an empty text, a null url is a host of its own;
markup that is cut off or badly nested is read as far as it goes; repeated rows
are extracted alike; other columns are not looked at. No pages give no rows."""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poifuse.llm import common
from poifuse.llm.url_filter import host_and_path

SUPPORT = 0.5
MIN_PAGES = 4
LINK_SHARE = 0.6
MAIN_SHARE = 0.6
APART_SHARE = 0.5
FORM_SHARE = 0.25
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(id|class|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=\s|/|$)""", re.I)
_RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg select object video audio canvas".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_DROP = frozenset("nav footer aside button dialog menu head fieldset".split())
_MAIN = frozenset(("article", "main"))
_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice "
    "notices notification popup modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus respond reply replies share sharing social related recommended recommendations "
    "pagination pager toolbar widget copyright legal disclaimer search searchform form".split()
)
_BODY_NAMES = frozenset("content article post entry story maincontent articlebody postbody entrybody".split())
#: A name that ends so is apart even beside a name of the body, as in post-ad; an entry-header holds the title.
_ENDS_APART = _NAMES - {"header", "masthead"}
_HEAD, _TAIL = 32, 8  # segments of a path kept from its start, and as many below them as are told apart one by one
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


@lru_cache(maxsize=100_000)
def _segment(tag: str, attributes: str) -> str:
    """Path segment of an element; after a blank, * marks a main element, ! one set apart from content, !! one always apart."""
    found = {}
    for name, *value in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), next((v for v in value if v), ""))
    words = (found.get("id", "") + " " + found.get("class", "") + " " + found.get("role", "")).lower()
    names = set(re.split(r"[\s_\-:]+", words)) - {""}
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    main = tag in _MAIN or "main" in names & {"main"} and found.get("role", "").lower() == "main"
    never = tag in ("html", "body")
    always = not never and (hidden or tag in _DROP)
    ends = {re.split(r"[\s_\-:]+", word)[-1] for word in words.split()}
    named = bool(names & _NAMES) and not names & _BODY_NAMES or bool(names & _BODY_NAMES and ends & _ENDS_APART)
    apart = always or not never and (tag == "form" or (not main and named))
    # running numbers in ids and classes are no part of the template
    label = re.sub(r"\d+", "0", ".".join(sorted(found.get("class", "").lower().split()))).replace("/", "_")
    ident = re.sub(r"\d+", "0", "_".join(found.get("id", "").lower().split())).replace("/", "_")
    marks = "*" * main + "!" * (apart + always)
    return tag + (f"#{ident}" if ident else "") + (f".{label}" if label else "") + (f" {marks}" if marks else "")


@lru_cache(maxsize=200_000)
def _flags(path: str) -> tuple[bool, tuple[str, ...], bool]:
    """Whether a path is always apart from content; the elements on it that are unless they hold most; whether it is in a main element."""
    always, apart, main, at = False, [], False, 0
    for part in path.split("/"):
        at += len(part) + 1
        marks = part.partition(" ")[2]
        always, main = always or "!!" in marks, main or "*" in marks
        if marks.endswith("!"):
            apart.append(path[: at - 1])
    return always, tuple(apart), main


def _apart(path: str, wrappers: frozenset[str]) -> bool:
    always, apart, _ = _flags(path)
    return always or bool(apart) and not wrappers.issuperset(apart)


def _wrappers(text: dict[str, int]) -> frozenset[str]:
    """Elements that would be set apart but hold most of the text (characters that aren't linked, by path)."""
    held: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    whole = mains = 0
    free = False
    for path, chars in text.items():
        always, apart, main = _flags(path)
        if chars > 0 and not always:
            whole, mains, free = whole + chars, mains + chars * main, free or main and not apart
            for p in apart:
                held[p][0] += chars
                held[p][1] += chars * main
    share = lambda p: FORM_SHARE if re.split(r"[#. ]", p.rpartition("/")[2])[0] == "form" else APART_SHARE
    return frozenset(p for p, (c, m) in held.items() if c >= share(p) * whole or mains and not free and m >= APART_SHARE * mains)


def _join(path: str, segment: str) -> str:
    """Path of a child. Very deep paths keep their start; what lies between is one segment, a hash with all marks."""
    if path.count("/") < _HEAD + _TAIL:
        return f"{path}/{segment}"
    parts = path.split("/")
    marks = [part.partition(" ")[2] for part in parts[_HEAD:]]
    own = "*" * any("*" in m for m in marks) + ("!!" if any("!!" in m for m in marks) else "!" * any(m.endswith("!") for m in marks))
    return "/".join([*parts[:_HEAD], f"~{_hash(path):x}" + (f" {own}" if own else ""), segment])


class Page:
    """One pass over a page: text runs with their structural path and flags, and the starts and ends of elements."""

    def __init__(self, source: str) -> None:
        self.runs: list[tuple[str, str, bool, bool]] = []  # path, text, in a link, break before
        self.tags: list[str] = []
        stack: list[tuple[str, str]] = [("", "")]  # tag, path
        open_: Counter[str] = Counter()

        def shut(k: int) -> None:
            open_.subtract(s[0] for s in stack[k:])
            del stack[k:]

        def push(tag: str, path: str) -> None:
            stack.append((tag, path))
            open_[tag] += 1

        at, links, split = 0, 0, True

        def text(raw: str) -> None:
            nonlocal split
            if raw:
                self.runs.append((stack[-1][1], html.unescape(raw) if "&" in raw else raw, links > 0, split))
                split = False

        while True:
            m = _TAG.search(source, at)
            if m is None:
                text(source[at:])
                break
            text(source[at : m.start()])
            at = m.end()
            closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not tag:
                continue
            tag = tag.lower()
            if tag in _RAW and not closing:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = end.end() if end else (len(source) if tag in ("script", "style", "textarea", "title") else at)
                split = split or tag not in ("script", "style")
                continue
            if tag not in _INLINE:
                split = True
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
            if closing:
                if open_[tag] > 0:
                    k = len(stack) - 1
                    while stack[k][0] != tag:
                        k -= 1
                    if tag not in _INLINE:
                        self.tags.append("/" + stack[k][1])
                    shut(k)
                continue
            if tag in _VOID:
                continue
            segment = _segment(tag, attributes.strip().rstrip("/") if attributes else "")
            if tag in _INLINE:
                if "!" in segment.partition(" ")[2]:
                    push(tag, _join(stack[-1][1], segment))
                continue
            if tag in _CLOSES_P and any(s[0] == "p" for s in stack[-4:]):
                shut(max(i for i in range(max(0, len(stack) - 4), len(stack)) if stack[i][0] == "p"))
            elif tag in ("li", "tr", "td", "th", "dt", "dd", "option") and stack[-1][0] == tag:
                shut(len(stack) - 1)
            path = stack[-1][1]
            if tag == "header":
                segment = segment.partition(" ")[0] + (" !!" if "!!" in segment else "" if _flags(path)[2] else " !")
            path = _join(path, segment)
            push(tag, path)
            self.tags.append(path)


def _hash(*words: str) -> int:
    return int.from_bytes(__import__("hashlib").blake2b("\x00".join(words).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _below(path: str, top: str) -> bool:
    return path == top or path.startswith(top + "/")


def _wide(path: str) -> bool:
    """Whether a path is the whole body."""
    return re.split(r"[#. ]", path.rpartition("/")[2])[0] == "body"


def page_text(source: str | None, template: dict | None = None) -> str:
    """Main text of one page, with its host's template if there is one."""
    if not source:
        return ""
    page = Page(source)
    linked, fixed, main, wrappers = (template["linked"], template["fixed"], template["main"], template["wrappers"]) if template else (frozenset(), frozenset(), "", frozenset())
    words = [len(" ".join(r[1].split())) for r in page.runs]
    keep = [_below(r[0], main) and r[0] not in linked and not _apart(r[0], wrappers) for r in page.runs] if main and not _wide(main) else []
    if not any(k and n for k, n in zip(keep, words)):  # the page has another layout, or the host's slot is the whole body
        if not template or not any(n and not _apart(r[0], wrappers) for r, n in zip(page.runs, words)):
            own: dict[str, int] = defaultdict(int)
            for r, n in zip(page.runs, words):
                own[r[0]] += n * (not r[2])
            wrappers |= _wrappers(own)
        apart = [_apart(r[0], wrappers) for r in page.runs]
        keep = [not out and _flags(r[0])[2] for r, out in zip(page.runs, apart)]
        rest = [not out and not (template and (r[0] in linked or _hash(r[0], " ".join(r[1].split())) in fixed)) for r, out in zip(page.runs, apart)]
        by_tag = sum(n for k, n in zip(keep, words) if k)
        if not by_tag or template and 2 * by_tag < sum(n for k, n in zip(rest, words) if k):
            keep = rest
    out: list[str] = []
    for k, (_, text, _, split) in zip(keep, page.runs):
        if split:
            out.append(" ")
        if k:
            out.append(text)
    return " ".join("".join(out).split())


_TOKENS = pa.schema([("host", pa.string()), ("token", pa.int64()), ("path", pa.string()), ("tag", pa.bool_()), ("pages", pa.int64()), ("vector", pa.int64()), ("place", pa.float64()), ("chars", pa.int64()), ("link_chars", pa.int64())])
_TOKENS_DDL = "host string, token long, path string, tag boolean, pages long, vector long, place double, chars long, link_chars long"


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of tokens, added up per batch and host; the empty path stands for the page itself."""
    for batch in batches:
        sums: dict[tuple[str, int], list] = {}
        for page_id, host, source in zip(*[batch.column(n).to_pylist() for n in ("page_id", "host", "html")]):
            page = Page(source or "")
            seen: dict[int, list] = defaultdict(lambda: [None, False, 0, 0.0, 0, 0])
            chars: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for path, text, link, _ in page.runs:
                words = " ".join(text.split())
                if words:
                    chars[path][0] += len(words)
                    chars[path][1] += len(words) * link
                    token = seen[_hash(path, words)]
                    token[0], token[2] = path, token[2] + 1
                    token[4], token[5] = token[4] + len(words), token[5] + len(words) * link
            for k, tag in enumerate(page.tags):
                token = seen[_hash(tag)]
                token[0], token[1], token[2] = tag, True, token[2] + 1
                token[3] += k / max(1, len(page.tags))
            for path, (n, m) in chars.items():
                token = seen[_hash(path)]
                token[0], token[1], token[4], token[5] = path, True, n, m
            root = seen[_hash("")]
            root[0], root[1], root[2] = "", True, 1
            own = _hash(str(page_id))
            for token, (path, tag, count, place, n, m) in seen.items():
                vote = _hash(str(own), str(count))
                row = sums.get((host, token))
                if row is None:
                    sums[host, token] = [path, tag, 1, vote, place / max(1, count), n, m]
                else:
                    row[2] += 1
                    row[3] ^= vote
                    row[4] += place / max(1, count)
                    row[5] += n
                    row[6] += m
        keys = list(sums)
        cols = list(zip(*sums.values())) or [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), *[pa.array(c, f.type) for c, f in zip(cols, list(_TOKENS)[2:])]], schema=_TOKENS)


def _template(frame: pd.DataFrame) -> pd.DataFrame:
    """Template of one host from its well-supported tokens."""
    host, total = frame["host"].iloc[0], int(frame["all_pages"].iloc[0])
    size = frame.groupby("vector")["token"].transform("size")
    valid = frame[(size >= 2) | (frame["path"] == "")]
    # nesting: an element start counts if its end's mean place doesn't come before it
    tags = valid[valid["tag"]].set_index("path")["place"].to_dict()
    good = {p for p, place in tags.items() if not p.startswith("/" * 2) and tags.get("/" + p, place) >= place}
    paths = frame[frame["tag"] & ~frame["path"].str.startswith("//")]
    linked = sorted(set(paths["path"][(paths["chars"] > 0) & (paths["link_chars"] > LINK_SHARE * paths["chars"]) & paths["path"].isin(good)]))
    runs = valid[~valid["tag"]]
    fixed = sorted(runs["token"].tolist())
    text = {p: c - m for p, c, m in zip(paths["path"], paths["chars"], paths["link_chars"]) if p not in linked}
    loose = dict(text)
    for p, c, m in zip(runs["path"], runs["chars"], runs["link_chars"]):
        if p in loose:
            loose[p] -= c - m
    loose = loose if any(c > 0 and not _flags(p)[0] for p, c in loose.items()) else text
    wrappers = _wrappers(loose)
    main = _main_slot({p: c for p, c in loose.items() if c > 0 and not _apart(p, wrappers)}, {p for p in good if not _apart(p, wrappers)})
    return pd.DataFrame({"host": [host], "pages": [total], "linked": [linked], "fixed": [fixed], "main": [main], "wrappers": [sorted(wrappers)], "template": [sorted(good)]})


def _main_slot(text: dict[str, int], good: set[str]) -> str:
    """The template path of the main slot, from the characters of each path; empty if there is none."""
    whole = sum(text.values())
    fits = [p for p in sorted(good) if whole and sum(c for q, c in text.items() if _below(q, p)) >= MAIN_SHARE * whole]
    fits.sort(key=len)
    tagged = [p for p in fits if "*" in p.rpartition("/")[2].partition(" ")[2]]
    if tagged and not any("*" in part.partition(" ")[2] for q in text if _below(q, tagged[-1]) for part in q[len(tagged[-1]) :].split("/")):
        return tagged[-1]
    blocks = [p for p in fits if re.split(r"[#. ]", p.rpartition("/")[2])[0] in ("div", "section", "td", "body", "article", "main")]
    return blocks[-1] if blocks else ""


def templates(pages: DataFrame) -> DataFrame:
    """Per host (page_id, host, html): linked paths, fixed text tokens, main path, elements not set apart and template paths."""
    tokens = pages.select("page_id", "host", "html").mapInArrow(_tokens, _TOKENS_DDL)
    sums = tokens.groupBy("host", "token").agg(
        F.min("path").alias("path"), F.bool_or("tag").alias("tag"), F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"),
        (F.sum("place") / F.sum("pages")).alias("place"), F.sum("chars").alias("chars"), F.sum("link_chars").alias("link_chars"),
    )
    sums = common.stage(sums.where(F.col("tag") | (F.col("pages") >= 2)), "tokens")
    hosts = sums.where((F.col("path") == "") & (F.col("pages") >= MIN_PAGES)).select("host", F.col("pages").alias("all_pages"))
    # at most (tokens of a page / SUPPORT) rows of a host are left
    common_ones = sums.join(hosts, "host").where(F.col("pages") >= SUPPORT * F.col("all_pages"))
    return common_ones.groupBy("host").applyInPandas(_template, "host string, pages long, linked array<string>, fixed array<long>, main string, wrappers array<string>, template array<string>")


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: dict[str, dict | None] = {}
    for batch in batches:
        hosts = batch.column("host").to_pylist()
        texts = []
        for k, (host, source) in enumerate(zip(hosts, batch.column("html").to_pylist())):
            if host not in kept:
                if len(kept) >= 10_000:
                    kept.clear()
                found = batch.column("template")[k].as_py()
                kept[host] = {"linked": frozenset(found["linked"]), "fixed": frozenset(found["fixed"]), "main": found["main"], "wrappers": frozenset(found["wrappers"])} if found else None
            texts.append(page_text(source, kept[host]))
        yield common.table({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}, _OUT)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("host", host_and_path(F.coalesce("url", F.lit("")))[0])
    found = common.stage(templates(rows), "templates").select("host", F.struct("linked", "fixed", "main", "wrappers").alias("template"))
    return rows.join(found, "host", "left").select("page_id", "url", "host", "html", "template").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
