"""Main text of web pages by templates deduced from occurrence vectors.

A page is read as tokens: each block-level tag with the path of block-level tags
around it (names with their classes and ids, digits levelled), and each block of text
with its path. For every host the occurrence vector of a token (how often it is in each
page) is fingerprinted by a sum over pages, so pages are reduced where they are read and a
host of any size arrives as one row per token. Tokens of equal vectors form an equivalence class.

Deduction, for hosts of MIN_PAGES pages or more, over the tokens found in half of the pages
or more (their number is bounded by twice the tokens of an average page):
* a container all of whose texts have a tag around them in their class is constant: it is
  part of the template, not of the slot that varies, and goes wherever it stands, also in
  the article. A page most of whose main text is constant is a copy and keeps it;
* the article is the ``article`` or ``main`` token; else, page by page, the deepest
  container around all varying text that is neither links nor in a side part. All of its
  subtree is main text but its side parts;
* side parts are nav, footer, aside, form, menu and dialog, and containers that a whole
  word of class, role or id names as menu, advert, comments or the like, or a part of a
  compound class does (comment-list, adSlot, related-posts), if they are in
  MIN_PAGES pages of the host. Names decide here because comments and adverts vary from
  page to page as the article does: occurrence alone cannot tell them from it.
On hosts of fewer pages nothing is constant and names alone mark side parts. A page without
its host's article token is read by its own tokens.

Cases: null and empty html give empty text; a null url has host ''; scripts, styles and comments are
never text, an unclosed one reaches to the end of the page, a self-closed one has no content; unclosed
tags end with the block around them, buttons, selects and objects also with the next block; a repeated
page counts each time; very long pages are read whole; extra columns are kept, whatever their names.
"""

from __future__ import annotations

import html
import re
from zlib import crc32

import pyarrow as pa
from xxhash import xxh3_64_hexdigest
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowlog.llm.common import as_bytes, materialise, ship_package
from flowlog.llm.url_filter import url_host

MIN_PAGES = 3           # pages of a host from which on it tells what is beside the main text
SUPPORT = 0.5           # share of a host's pages that a template token is in

VARYING = 0.5           # share of an article that varies over the host, at least, unless the page is a copy

# fixed values: HTML element names
RAW = "script|style|noscript|template|iframe|svg|textarea"     # their content is skipped up to the end tag
CONTROLS = {"button", "select", "object"}      # side parts that end with the block around them or the next block
BLOCK = set("html head title body article section main header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd "
            "table caption thead tbody tfoot tr td th blockquote pre figure figcaption address form fieldset details summary "
            "dialog menu center button select object".split())
BREAK = {"br", "hr"}
ENDS_P = BLOCK - {"html", "head", "title", "body"} - CONTROLS
# fixed values: names that mark parts of a page other than its main text
SIDE_TAGS = set("head title nav footer aside form menu dialog".split()) | CONTROLS
SIDE_WORDS = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo nav navbar navigation menu "
                 "breadcrumb breadcrumbs sidebar footer cookie cookies consent cookie-notice cookie-banner gdpr popup modal newsletter "
                 "subscribe signup login share sharing social related recommended comment comments disqus reply replies "
                 "widget toolbar pagination".split())
#: parts of compound names (comment-list, ad_slot, relatedPosts) that mark a side part wherever they stand
SIDE_PARTS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo comment comments reply replies disqus cookie cookies "
                 "consent gdpr newsletter subscribe sidebar breadcrumb breadcrumbs pagination popup".split())
#: pairs of neighbouring parts that mark one
SIDE_PAIRS = {(a, b) for a in ("related", "recommended", "popular", "share", "social")
              for b in ("posts", "articles", "stories", "links", "items", "list", "box", "buttons", "bar", "widget", "icons")}
NOTICE_WORDS = set("notice alert banner".split())       # whole words on a container inside the article
SITE_WORDS = set("header masthead banner notice alert overlay search skip".split())      # only where no article holds them
# containers that a name may mark
NAMED = set("div section ul ol dl table center".split())
MAIN_TAGS = ("article", "main")
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
HOLDERS = set("html body article section main div center".split())     # what may hold a whole text: no list, table or paragraph

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:svg|iframe)\b(?:[^>\"'/]|/(?!>)|\"[^\"]*\"|'[^']*')*+/>|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|</?[a-zA-Z][^>]*>|<[!?][^>]*>", re.S | re.I)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_LABEL = re.compile(r"\s(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[a-z]+")
_PART = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HEADING = re.compile(r"\s*(?:<(?!h[1-6]\b)[^>]*>\s*){0,4}<h[1-6]\b[^>]*>(.{0,200}?)</h[1-6]", re.S | re.I)


def _slug(text: str) -> str:
    return " ".join(_WORDS.findall(html.unescape(re.sub(r"<[^>]*>", " ", text)).lower()))


def _label(name: str, tag: str, page: str, end: int) -> str:
    """Name and marks as .class=.., .id=.., .role=..; an id that repeats the heading it stands before is marked .own=.."""
    if "=" not in tag:
        return name
    out = name
    for kind, value in sorted((k.lower(), a or b or c) for k, a, b, c in _LABEL.findall(tag)):
        words = _CAMEL.sub("-", _DIGITS.sub("0", value)).replace("/", " ").replace(".", "_").lower().split()
        if kind == "id" and not SIDE_WORDS.isdisjoint(words):
            heading = _HEADING.match(page, end)
            if heading and _slug(heading.group(1)) == _slug(value):
                kind = "own"
        out += f".{kind}={' '.join(words)}"
    return out


def page_blocks(page: str):
    """(tokens, blocks): the paths of the block tags, and (path, text, of it in links) in page order."""
    tokens, blocks = [], []
    stack: list[tuple[str, str]] = []           # (name, path)
    parts: list[str] = []
    links, in_link, at = 0, 0, 0

    def close_block():
        nonlocal links
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                blocks.append((stack[-1][1] if stack else "", text, links))
            parts.clear()
        links = 0

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at:m.start()])
            links += (m.start() - at) if in_link else 0
        at = m.end()
        tag = m.group()
        if m.group(1) or tag[1] in "!?":
            if m.group(1):
                close_block()
            continue
        name = _NAME.match(tag).group(1).lower()
        closing = tag[1] == "/"
        if name == "a":
            in_link = 0 if closing else 1
        if name in BREAK:
            close_block()
        if name not in BLOCK:
            continue
        close_block()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        while stack and stack[-1][0] in CONTROLS:
            stack.pop()
        if name in ENDS_P and stack and stack[-1][0] == "p":
            stack.pop()
        if name in ("li", "dt", "dd", "tr", "td", "th") and stack and stack[-1][0] == name:
            stack.pop()
        path = (stack[-1][1] if stack else "") + "/" + _label(name, tag, page, m.end())
        tokens.append(path)
        stack.append((name, path))
    if at < len(page):
        parts.append(page[at:])
    close_block()
    return tokens, blocks


def is_side(label: str, confirmed: bool = False) -> bool:
    """Whether a tag is beside the main text by its name, or a container by a whole word of its class, role or id.

    An id that repeats the container's heading counts only if ``confirmed``: in many pages of the host."""
    name, _, marks = label.partition(".")
    if name in SIDE_TAGS:
        return True
    if not marks or name not in NAMED:
        return False
    for mark in marks.split("."):
        kind, _, words = mark.partition("=")
        if (kind != "own" or confirmed) and not SIDE_WORDS.isdisjoint(words.split()):
            return True
        if kind in ("class", "role") and any(w in NOTICE_WORDS or _compound_side(w) for w in words.split()):
            return True
    return False


def _compound_side(word: str) -> bool:
    """Whether a class of several parts names a side part: by one of its parts, or by two in a row."""
    parts = _PART.split(word)
    return len(parts) > 1 and (not SIDE_PARTS.isdisjoint(parts) or any(pair in SIDE_PAIRS for pair in zip(parts, parts[1:])))


def side_part(path: str, sides: set[str] | None, start: int = 0) -> bool:
    """Whether a step of ``path`` after its first ``start`` characters opens a side part: by names alone, or if
    ``sides`` is known (the named containers in MIN_PAGES pages of the host or more) by these and by side tags."""
    at = path.find("/", start)
    while at >= 0:
        end = path.find("/", at + 1)
        label = path[at + 1:] if end < 0 else path[at + 1:end]
        if (is_side(label) if sides is None else label.partition(".")[0] in SIDE_TAGS or (path if end < 0 else path[:end]) in sides):
            return True
        at = end
    return False


def _name(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


def _site_part(path: str) -> bool:
    """Whether a container around ``path`` is named like the head of a site, and no heading."""
    labels = [x.partition(".") for x in path.split("/")[1:]]
    return labels[-1:] != [] and _name(path) not in HEADINGS and any(
        name == "header" or name in NAMED and not SITE_WORDS.isdisjoint(marks.replace(".", " ").replace("=", " ").split()) for name, _, marks in labels)


def main_roots(weights: dict[str, tuple[int, int]], sides: set[str] | None = None) -> list[str]:
    """Paths of the article; ``weights`` has (characters, of them in links) directly below each path."""
    for wanted in MAIN_TAGS:
        found = sorted(p for p in weights if _name(p) == wanted and not side_part(p, sides))
        if found:
            return [p for p in found if not any(p.startswith(q + "/") for q in found)]
    around = None
    for path, (chars, links) in weights.items():
        if not chars or 2 * links > chars or side_part(path, sides) or _site_part(path):
            continue
        steps = path.split("/")
        if around is not None:
            same = next((i for i, (x, y) in enumerate(zip(steps, around)) if x != y), min(len(steps), len(around)))
            steps = steps[:same]
        around = steps
    if around is None:
        return []
    while len(around) > 1 and around[-1].partition(".")[0] not in HOLDERS:
        around.pop()
    return ["/".join(around)]


def extract(blocks, roots: list[str], sides: set[str] | None, constant: set[str]) -> str:
    """Text of the blocks in the article, in no side part of it and not constant over the host.

    Constant texts that are most of what a page has are kept: such pages are copies, not fillings of a template."""
    varying = [b for b in blocks if text_token(b[0], b[1]) not in constant] if constant else blocks
    whole = _main_blocks(blocks, roots, sides)
    main = whole if varying is blocks else _main_blocks(varying, roots, sides)
    if sum(map(len, main)) < sum(map(len, whole)) * (VARYING if roots else VARYING / 5):     # without an article, whole has the site's parts too
        main = whole
    return " ".join(main)


def _main_blocks(blocks, roots: list[str], sides: set[str] | None) -> list[str]:
    if not roots or not any(b[0] == r or b[0].startswith(r + "/") for b in blocks for r in roots):
        weights: dict[str, tuple[int, int]] = {}
        for path, text, links in blocks:
            chars, linked = weights.get(path, (0, 0))
            weights[path] = (chars + len(text), linked + min(links, len(text)))
        steps = {"/".join(p.split("/")[:i]): (0, 0) for p in weights for i in range(2, p.count("/") + 2)}
        roots = main_roots({**steps, **weights}, sides)
    return [text for path, text, _ in blocks
            if any((path == r or path.startswith(r + "/")) and not side_part(path, sides, len(r)) for r in roots)]


def text_token(path: str, text: str) -> str:
    return f"{path}\t{xxh3_64_hexdigest(text.encode('utf-8', 'replace'))}"


def _page_key(page_id, raw: bytes) -> int:
    return crc32(raw, crc32(str(page_id).encode()))


def token_counts(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Rows (host, token, va, vb, pages, times, chars, links) reduced per batch; token '' stands for the page itself."""
    def run(batches):
        for batch in batches:
            found: dict[tuple[str, str], list[int]] = {}
            hosts, ids = batch.column("host").to_pylist(), batch.column(id_col).to_pylist()
            for host, page_id, raw in zip(hosts, ids, as_bytes(batch.column(html_col))):
                tokens, blocks = page_blocks(raw.decode("utf-8", "replace"))
                own: dict[str, list[int]] = {"": [1, 0, 0]}
                for t in tokens:
                    own.setdefault(t, [0, 0, 0])[0] += 1
                for path, text, links in blocks:
                    for row in (own.setdefault(path, [0, 0, 0]), own.setdefault(text_token(path, text), [0, 0, 0])):
                        row[1] += len(text)
                        row[2] += min(links, len(text))
                    row[0] += 1
                a = _page_key(page_id, raw)
                b = crc32(b"vector", a)
                for token, (times, chars, links) in own.items():
                    row = found.setdefault((host, token), [0] * 6)
                    for i, x in enumerate((a * times, b * times, 1, times, chars, links)):
                        row[i] += x
            columns = list(zip(*[(*k, *v) for k, v in found.items()])) if found else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                                              *[pa.array(c, pa.int64()) for c in columns[2:]]],
                                             names=["host", "token", "va", "vb", "pages", "times", "chars", "links"]).append_column(
                                                 "side", pa.array(["\t" not in t and is_side(t.rpartition("/")[2], confirmed=True) for t in columns[1]], pa.bool_()))

    counted = pages.select(id_col, "host", html_col).mapInArrow(
        run, "host string, token string, va long, vb long, pages long, times long, chars long, links long, side boolean")
    sums = [F.sum(F.col(c).cast("decimal(38,0)") if c in ("va", "vb") else F.col(c)).alias(c) for c in ("va", "vb", "pages", "times", "chars", "links")]
    # a text of fewer pages cannot be a template's
    return (counted.groupBy("host", "token").agg(*sums, F.max("side").alias("side"))
            .where(~F.col("token").contains("\t") | (F.col("pages") >= MIN_PAGES)))


def _ends(path: str) -> list[int]:
    return [*[m.start() for m in re.finditer("/", path)][1:], len(path)]


def deduce(rows: list[dict]) -> tuple[list[str], list[str], list[str]]:
    """(side parts, article paths, constant texts) of one host of MIN_PAGES pages or more.

    Article paths are empty if most pages have none. A text repeats if its class holds a tag around it: it is in every page that
    has the tag, as often as the tag. A container is constant if all its text repeats, and so are its texts; a repeated
    paragraph or heading beside others that vary is the author's as far as its place tells."""
    pages = max((r["host_pages"] for r in rows), default=0)
    tags = [r for r in rows if "\t" not in r["token"]]
    sides = {r["token"] for r in tags if r["pages"] >= MIN_PAGES and is_side(r["token"].rpartition("/")[2], confirmed=True)}
    template = [r for r in tags if r["token"] and r["pages"] >= pages * SUPPORT]
    classes: dict[tuple, list[str]] = {}
    for r in template:
        classes.setdefault((r["va"], r["vb"]), []).append(r["token"])
    repeated: dict[str, int] = {}
    for r in rows:
        path, tab, _ = r["token"].partition("\t")
        if tab and r["pages"] >= max(MIN_PAGES, pages * SUPPORT):
            if any(path == t or path.startswith(t + "/") for t in classes.get((r["va"], r["vb"]), ())):
                repeated[r["token"]] = r["chars"]
    varying: dict[str, int] = {}        # container -> characters below it, less those that repeat
    for token, chars in [*((r["token"], r["chars"]) for r in tags), *((t, -n) for t, n in repeated.items())]:
        steps = token.partition("\t")[0].split("/")
        for i in range(2, len(steps) + 1):
            if steps[i - 1].partition(".")[0] in NAMED:
                around = "/".join(steps[:i])
                varying[around] = varying.get(around, 0) + chars
    constant = {t for t in repeated if any(varying.get(t.partition("\t")[0][:i]) == 0 for i in _ends(t.partition("\t")[0]))}
    # without an article token each page is read by its own tokens: its own markup may hold a part of its text
    roots = [p for p in main_roots({r["token"]: (r["chars"], r["links"]) for r in template}, sides) if _name(p) in MAIN_TAGS]
    return sorted(sides), roots, sorted(constant)


def templates(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """One row per host: its side parts (null for a host of few pages), article paths and constant texts."""
    counts = materialise(token_counts(pages, id_col, html_col), "html-tokens")
    size = counts.where("token = ''").select(F.col("host").alias("h"), F.col("pages").alias("host_pages"))
    frequent = (counts.join(size, F.col("host") == F.col("h"))
                .where((F.col("pages") >= F.col("host_pages") * SUPPORT) | (F.col("side") & (F.col("pages") >= MIN_PAGES)))
                .select("host", "token", F.col("va").cast("string").alias("va"), F.col("vb").cast("string").alias("vb"),
                        "pages", "times", "chars", "links", "host_pages"))

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sides, roots, constant = deduce(rows)
        known = rows[0]["host_pages"] >= MIN_PAGES
        kind = pa.list_(pa.string())
        return pa.table({"host": pa.array([rows[0]["host"]], pa.string()), "sides": pa.array([sides if known else None], kind),
                         "roots": pa.array([roots if known else []], kind), "constant": pa.array([constant], kind)})

    return frequent.groupBy("host").applyInArrow(run, "host string, sides array<string>, roots array<string>, constant array<string>")


def _free_name(pages: DataFrame, name: str) -> str:
    """A column name that the table lacks."""
    taken = {c.lower() for c in pages.columns}
    while name.lower() in taken:
        name += "_"
    return name


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      text_col: str = "main_text") -> DataFrame:
    """``pages`` without its html, with the main text of every page."""
    ship_package(pages.sparkSession)
    rest = [f for f in pages.schema.fields if f.name not in (html_col, text_col)]
    raw_col, host_col, known_col = (_free_name(pages, n) for n in ("raw_html", "host_of_page", "host_of_template"))
    side_col, root_col, constant_col = (_free_name(pages, n) for n in ("sides", "roots", "constant"))
    hosted = pages.select(*[F.col(f"`{f.name}`") for f in rest], F.col(html_col).alias(raw_col),
                          url_host(F.coalesce(F.col(url_col), F.lit(""))).alias(host_col))
    known = materialise(templates(hosted.select(F.col(id_col).alias("page"), F.col(host_col).alias("host"), F.col(raw_col).alias("raw")), "page", "raw"),
                        "html-templates").toDF(known_col, side_col, root_col, constant_col)
    joined = hosted.join(known, F.col(host_col) == F.col(known_col), "left").drop(known_col)
    schema = StructType([*rest, StructField(text_col, StringType())])

    def run(batches):
        memo: dict[str, tuple[list, set | None, set]] = {}
        for batch in batches:
            hosts = batch.column(host_col).to_pylist()
            texts = []
            for i, (host, raw) in enumerate(zip(hosts, as_bytes(batch.column(raw_col)))):
                if host not in memo:
                    if len(memo) > 1000:
                        memo.clear()
                    sides, roots, constant = (batch.column(c)[i].as_py() for c in (side_col, root_col, constant_col))
                    memo[host] = (roots or [], None if sides is None else set(sides), set(constant or ()))
                texts.append(extract(page_blocks(raw.decode("utf-8", "replace"))[1], *memo[host]))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in rest], pa.array(texts, pa.string())],
                                             names=[f.name for f in schema.fields])

    return joined.mapInArrow(run, schema)
