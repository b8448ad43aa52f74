"""Main text of web pages by wrapper induction.

Pages become trees of block elements. The trees of a host are aligned by simple
tree matching, child lists in order with the matching of most nodes, and merged
into one template: each of its nodes knows how often it occurs, whether its text
is the same wherever it occurs, and how much text stands in it. Nodes of constant
text on pages of different titles are template; the slot that holds the varying
text is content. Extraction aligns a page with its host's wrapper in the same way
and keeps the text of the content slot, less what names, tags or constancy tell
to be around it.

Templates merge like counts do: tasks return partial ones for their pages, which
are merged host by host in two steps, so that no task sees all pages of a host.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.llm.common import sized_join, stored

#: Different page titles beside which a text has to stand unchanged before it counts as template.
MIN_TITLES = 5
#: Levels of a tree (deeper elements give their text to the last of them), children up to which lists are matched in
#: order (longer ones are matched by label), and nodes of templates that a task holds before it hands them on.
MAX_DEPTH, MAX_KIDS, HELD_NODES = 80, 48, 100_000
#: First merges of a host's partial templates are dealt over so many groups.
SALTS = 32
#: Share of a node's varying text that one child must hold to be looked into for the content slot.
SLOT_SHARE = 0.8

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_DROPPED = frozenset("head script style noscript template iframe object embed svg canvas audio video map select button textarea datalist input".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEAD_ONLY = frozenset("base link meta noscript script style template title".split())
#: An open element of the first kind ends where one of the second starts.
_P_ENDS = _BLOCKS - {"body", "html", "caption", "dd", "dt", "legend", "li", "summary", "tbody", "td", "tfoot", "th", "thead", "tr"}
_SIBLING_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "option": ("option",)}
_SCOPES = frozenset("table ul ol dl article section body html div".split())
_ALWAYS_AROUND = frozenset("nav aside footer dialog search menu".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words in a class or id that tell what an element is for.
_AROUND_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer "
    "masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations comment comments disqus replies respond pagination pager widget copyright skip search form".split()
)
_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+>|[^>]*>))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    """A block element of a page, or one that is dropped; inline elements are part of the text around them."""

    __slots__ = ("around", "kids", "label", "root", "tag")

    def __init__(self, tag: str, label: str, around: bool):
        self.tag, self.label, self.around, self.kids, self.root = tag, label, around, [], False


def _named(tag: str, attributes: str) -> tuple[str, bool]:
    """The label of an element, its tag with the letters of class and id, and whether it stands around a page's main text."""
    around = tag in _DROPPED or tag in _ALWAYS_AROUND or tag == "form"
    if len(attributes) < 2:
        return tag, around
    words: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            words.update(w.lower() for w in _WORD.findall(value[:400]))
        elif name == "role":
            around |= value.lower() in _ROLES
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            around = True
    if tag not in ("html", "body", "main"):
        around |= bool(words & _AROUND_WORDS)
    return f"{tag}.{'.'.join(sorted(words)[:6])}" if words else tag, around


def parse(page: str) -> tuple[Node, str]:
    """The tree of a page and its title. Any text is a page; unclosed and stray tags are put up with."""
    top = Node("html", "html", False)
    stack, title, pos, skipped = [top], "", 0, 0
    match, end = _TAG.search, len(page)
    while pos < end:
        found = match(page, pos)
        text = page[pos : found.start() if found else end]
        if text:
            # a "<" that opens no tag is text, and the search goes on behind it
            stack[-1].kids.append(entities.unescape(text) if "&" in text else text)
        if not found:
            break
        pos = found.end()
        closing, tag, rest = found.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if tag in _BLOCKS or tag in _DROPPED:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
                    if stack[k].tag in ("td", "th", "table") and tag not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "body", "html", "article", "main"):
                        break
            continue
        if tag in _RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, pos)
            if tag == "title" and not title:
                title = " ".join(entities.unescape(page[pos : close.start() if close else end]).split())
            pos = close.end() if close else end
            continue
        if tag in ("html", "body"):
            while len(stack) > 1 and stack[-1].tag == "head":
                stack.pop()
            continue
        if tag not in _BLOCKS and tag not in _DROPPED:
            if tag == "br":
                stack[-1].kids.append(" ")
                continue
            if tag in _VOID or "=" not in rest:
                continue
            label, around = _named(tag, rest)
            if not around:
                continue  # an inline element like others
        else:
            label, around = _named(tag, rest)
        if len(stack) > 1 and stack[-1].tag == "head" and tag not in _HEAD_ONLY:
            stack.pop()
        if tag in _P_ENDS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in _BLOCKS:
                    break
        ended = _SIBLING_ENDS.get(tag)
        if ended:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ended:
                    del stack[k:]
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
                elif stack[k].tag in _SCOPES:
                    break
        node = Node(tag, label, around)
        if tag in _VOID or rest.endswith("/>") and tag not in _BLOCKS:
            if tag == "hr":
                stack[-1].kids.append(node)
            continue
        if len(stack) >= MAX_DEPTH and not around:
            stack[-1].kids.append(node)  # a block's edge; what it holds stays with its parent
            continue
        stack[-1].kids.append(node)
        stack.append(node)
    _settle(top, False)
    return top, title


def _settle(node: Node, inside: bool) -> bool:
    """Sets which elements stand around the main text; whether an article, a main part or a first heading is in the node."""
    inside |= node.tag in ("article", "main")
    holds = False
    for kid in node.kids:
        if not isinstance(kid, str):
            holds |= _settle(kid, inside)
    if node.tag == "header":
        node.around |= not inside
    elif node.around and holds and node.tag not in _DROPPED and node.tag not in _ALWAYS_AROUND and node.tag != "article":
        node.around = False
    return not node.around and (holds or node.tag in ("article", "main", "h1"))


class Part:
    """A node of a template: equal siblings of a page are one node of it.

    ``fixed`` is the digest of the node's own text, 0 once it differs from page to
    page and None while there is none. ``titles`` are the smallest digests of the
    titles of pages on which it had text, MIN_TITLES at most; ``chars`` counts its text.
    """

    __slots__ = ("around", "chars", "fixed", "free", "kids", "label", "n", "nodes", "titles")

    def __init__(self, label: str, around: bool):
        self.label, self.around, self.n, self.fixed, self.titles, self.chars, self.kids, self.free, self.nodes = label, around, 1, None, (), 0, [], False, []

    def size(self) -> int:
        return 1 + sum(k.size() for k in self.kids)


def part_of(nodes: list[Node], title: int) -> Part:
    """Equal siblings as one node, with runs of equal children in it as one node each."""
    out = Part(nodes[0].label, nodes[0].around)
    out.nodes = nodes
    text = []
    lists = []
    for node in nodes:
        runs: list[list[Node]] = []
        for kid in node.kids:
            if isinstance(kid, str):
                if not kid.isspace():
                    text.append(" ".join(kid.split()))
            elif runs and runs[-1][0].label == kid.label and runs[-1][0].around == kid.around:
                runs[-1].append(kid)
            else:
                runs.append([kid])
        if runs:
            lists.append(runs)
    own = " ".join(text)
    if own:
        out.fixed, out.titles, out.chars = xxhash.xxh3_64_intdigest(own) >> 1 | 1, (title,), len(own)
    for runs in lists:
        by_label: dict[str, list[Node]] = {}
        if len(runs) > MAX_KIDS or out.free:
            out.free = True
            for run in runs:
                by_label.setdefault(run[0].label, []).extend(run)
            runs = list(by_label.values())
            if len(runs) > MAX_KIDS:  # names that never repeat
                by_tag: dict[str, list[Node]] = {}
                for run in runs:
                    by_tag.setdefault(run[0].tag, []).extend(run)
                runs = list(by_tag.values())
                for run in runs:
                    for node in run:
                        node.label = node.tag
        merge_kids(out, [part_of(run, title) for run in runs])
    return out


def similarity(a: Part, b: Part) -> int:
    """Simple tree matching: the most nodes of two trees that match with parents and order kept."""
    if a.label != b.label:
        return 0
    if not a.kids or not b.kids:
        return 1
    row = [0] * (len(b.kids) + 1)
    for x in a.kids:
        last = row
        row = [0]
        for j, y in enumerate(b.kids):
            row.append(max(row[j], last[j + 1], last[j] + similarity(x, y)))
    return 1 + row[-1]


def matched(a: list[Part], b: list[Part]) -> list[tuple[int, int]]:
    """Pairs of indices of two child lists, in order, whose trees match in most nodes."""
    if [x.label for x in a] == [y.label for y in b]:
        return [(i, i) for i in range(len(a))]
    start = 0
    while start < min(len(a), len(b)) and a[start].label == b[start].label:
        start += 1
    stop = 0
    while stop < min(len(a), len(b)) - start and a[-1 - stop].label == b[-1 - stop].label:
        stop += 1
    if start + stop in (len(a), len(b)):  # one list only adds to the other
        return [(i, i) for i in range(start)] + [(len(a) - k, len(b) - k) for k in range(stop, 0, -1)]
    weight = [[similarity(x, y) for y in b] for x in a]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + weight[i][j])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if weight[i][j] and best[i][j] == best[i + 1][j + 1] + weight[i][j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


def merge(a: Part, b: Part) -> None:
    """Adds a template of the same label to ``a``."""
    a.n += b.n
    a.around &= b.around
    if b.fixed is not None:
        a.fixed = b.fixed if a.fixed is None or a.fixed == b.fixed else 0
        a.titles = tuple(sorted({*a.titles, *b.titles})[:MIN_TITLES])
        a.chars += b.chars
    if b.free and not a.free:
        _free(a)
    if b.kids:
        merge_kids(a, b.kids)


def _free(a: Part) -> None:
    a.free, kids, a.kids = True, a.kids, []
    merge_kids(a, kids)


def merge_kids(a: Part, kids: list[Part]) -> None:
    if not a.kids and not a.free:
        a.kids = list(kids)
    elif a.free:
        known = {k.label: k for k in a.kids}
        for kid in kids:
            if kid.label in known:
                merge(known[kid.label], kid)
            else:
                known[kid.label] = kid
                a.kids.append(kid)
    else:
        out, done, at = [], 0, 0
        for i, j in matched(a.kids, kids):
            out += a.kids[done:i] + kids[at:j]
            merge(a.kids[i], kids[j])
            out.append(a.kids[i])
            done, at = i + 1, j + 1
        a.kids = out + a.kids[done:] + kids[at:]
        if len(a.kids) > MAX_KIDS:
            _free(a)


def dump(a: Part) -> list:
    return [a.label, a.around, a.n, a.fixed, list(a.titles), a.chars, a.free, [dump(k) for k in a.kids]]


def load(x: list) -> Part:
    out = Part(x[0], x[1])
    out.n, out.fixed, out.titles, out.chars, out.free = x[2], x[3], tuple(x[4]), x[5], x[6]
    out.kids = [load(k) for k in x[7]]
    return out


def _constant(a: Part) -> bool:
    return bool(a.fixed) and len(a.titles) >= MIN_TITLES


def _tag_of(a: Part) -> str:
    return a.label.split(".", 1)[0]


def compile_wrapper(template: Part) -> str:
    """The wrapper of a host as JSON: label, whether lists are matched by label, what a node is (0 slot, 1 template, 2 content), children."""

    def varying(a: Part) -> int:
        return 0 if a.around else (0 if _constant(a) else a.chars) + sum(map(varying, a.kids))

    def outermost(a: Part, tag: str) -> list[Part]:
        if a.around:
            return []
        return [a] if _tag_of(a) == tag else [x for k in a.kids for x in outermost(k, tag)]

    roots = [x for x in outermost(template, "article") if varying(x)] or [x for x in outermost(template, "main") if varying(x)]
    if not roots:
        at = template
        while True:
            total = varying(at)
            inner = [k for k in at.kids if _tag_of(k) in ("div", "section", "center", "table", "tbody", "tr", "td") and varying(k) >= SLOT_SHARE * total > 0]
            if not inner:
                break
            at = inner[0]
        roots = [at]
    chosen = {id(x) for x in roots}

    def pack(a: Part) -> list:
        kind = 2 if id(a) in chosen else 1 if _constant(a) else 0
        return [a.label, int(a.free), kind, [pack(k) for k in a.kids]]

    return json.dumps(pack(template), ensure_ascii=False, separators=(",", ":"))


def load_wrapper(text: str) -> Part:
    """A compiled wrapper as parts; ``n`` holds what a node is."""

    def build(x: list) -> Part:
        out = Part(x[0], False)
        out.free, out.n, out.kids = bool(x[1]), x[2], [build(k) for k in x[3]]
        return out

    return build(json.loads(text))


def _mark(wrapper: Part, page: Part) -> None:
    """Carries over what the wrapper's nodes are to the page's nodes that align with them."""
    for node in page.nodes:
        node.root |= wrapper.n == 2
        if wrapper.n == 1:
            node.kids = [k for k in node.kids if not isinstance(k, str)]
    if wrapper.free:
        known = {k.label: k for k in wrapper.kids}
        for kid in page.kids:
            if kid.label in known:
                _mark(known[kid.label], kid)
    else:
        for i, j in matched(wrapper.kids, page.kids):
            _mark(wrapper.kids[i], page.kids[j])


def main_text(page: str, wrapper: Part) -> str:
    """The blocks of a page that stand in the content slot of its host's wrapper, one a line."""
    top, _ = parse(page)
    _mark(wrapper, part_of([top], 0))

    def has_root(node: Node) -> bool:
        return not node.around and (node.root or any(has_root(k) for k in node.kids if not isinstance(k, str)))

    # a page without its host's slot is content as far as nothing speaks against it
    everywhere = not has_root(top)
    explicit = any(True for _ in _articles(top))
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    def walk(node: Node, inside: bool) -> None:
        if node.around:
            if node.tag in _BLOCKS:
                flush()
            return
        inside |= node.root or node.tag == "h1" and not explicit
        if node.tag in _BLOCKS:
            flush()
        for kid in node.kids:
            if not isinstance(kid, str):
                walk(kid, inside)
            elif inside:
                line.append(kid)
        if node.tag in _BLOCKS:
            flush()

    walk(top, everywhere)
    flush()
    return "\n".join(out)


def _articles(node: Node) -> Iterator[Node]:
    if not node.around:
        if node.tag == "article":
            yield node
        for kid in node.kids:
            if not isinstance(kid, str):
                yield from _articles(kid)


def host_of(url: str) -> F.Column:
    """The host of an address in lower case, '' where there is none."""
    return F.coalesce(F.lower(F.nullif(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))), F.lit(""))


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial templates of the hosts in a task's pages, handed on whenever they are many."""
    held: dict[str, Part] = {}
    nodes = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array([json.dumps(dump(t)) for t in held.values()], pa.string())], ["host", "template"])

    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
            top, title = parse(page.as_py() or "")
            part = part_of([top], xxhash.xxh3_64_intdigest(title) >> 1)
            if host in held:
                merge(held[host], part)
                nodes += 2
            else:
                held[host] = part
                nodes += part.size()
            if nodes >= HELD_NODES:
                nodes = sum(t.size() for t in held.values())
                if nodes >= HELD_NODES // 2:
                    yield out()
                    held, nodes = {}, 0
    if held:
        yield out()


def _merged(last: bool):
    """Merges templates of a host that stand together; the last time they are compiled to wrappers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, held = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([host]), pa.array([compile_wrapper(held) if last else json.dumps(dump(held))])], ["host", "template"])

        for batch in batches:
            for h, t in zip(batch.column("host").to_pylist(), batch.column("template"), strict=True):
                part = load(json.loads(t.as_py()))
                if held is not None and h == host:
                    merge(held, part)
                    continue
                if held is not None:
                    yield out()
                host, held = h, part
        if held is not None:
            yield out()

    return run


def induce_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host and template, the wrapper of all pages of each host as JSON (see compile_wrapper)."""
    rows = pages.select(host_of(url_col).alias("host"), F.col(html_col).alias("html"))
    parts = rows.mapInArrow(_induce, "host string, template string").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    once = parts.repartition("host", "salt").sortWithinPartitions("host", "salt").select("host", "template").mapInArrow(_merged(False), "host string, template string")
    return once.repartition("host").sortWithinPartitions("host").mapInArrow(_merged(True), "host string, template string")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wrappers: dict[str, Part] = {}
    for batch in batches:
        texts = []
        for page, template in zip(batch.column("html"), batch.column("template"), strict=True):
            key = template.as_py()
            wrapper = wrappers.get(key)
            if wrapper is None:
                if len(wrappers) > 2000:
                    wrappers.clear()
                wrapper = wrappers[key] = load_wrapper(key)
            texts.append(main_text(page.as_py() or "", wrapper))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def html_extraction(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Null html is an empty page with an empty text; pages without an address or a
    host in it are those of the host ''. Repeated rows and rows with a null id each
    give a row, an empty table none; other columns are not read. Cells of tables are
    blocks. A host of one page has a wrapper of that page, in which all text varies.
    """
    wrappers = stored(induce_wrappers(pages, url_col, html_col))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(url_col).alias("host"))
    return sized_join(rows, wrappers, ["host"], "left").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main texts of the whole pages table."""
    return html_extraction(spark.read.parquet(f"{sf_dir}/pages.parquet"))
