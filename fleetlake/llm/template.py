"""Main text of web pages by deducing each host's template from equivalence classes of tokens.

Method. A page is a sequence of tokens: elements, named by their path of structural tags and classes, and
blocks of text, named by the path they stand in, their text and their number among equal ones. Pages of a host with equal html
count once. A token's occurrence vector tells how often it occurs on each page of a host. Tokens of one host with
equal vectors form an equivalence class; vectors are compared by a hash that adds up over pages. A token is
frequent if it stands on at least ``SUPPORT`` of the host's pages, once on each. The class on the most pages is
the outermost; the others nest in its gaps: tokens of one vector in one gap are a class, a token that changes
gaps belongs to none. A class loses what does not keep the order of its members on every page, and is valid if
``MEMBERS`` are left; what is merely frequent is no template. The valid classes make the template, as far as the elements around
each of its elements and texts are in it too. What lies directly in one template element is a slot. The main text is in the slots that
are mostly text outside links and mostly new from page to page, without template text, whatever their elements are called, and
without what names itself a menu, header, footer, sidebar, notice, advert, form or comment. Only where no valid
template is found do article and main elements tell the main text. Pages of hosts with fewer than ``FEW`` distinct pages
share one template, that of all pages.

Scale. Tokens are packed and brought together by the html's digest, then added up per task before the shuffle, so a host with a third of
all pages sends a row per token and task. Tokens on less than SUPPORT of a host's pages are dropped before its template is
formed: a template is bounded by the length of a page. Frequent tokens, and later templates, are joined to pages by host;
adaptive execution splits a host with many pages.

Text. Character references are decoded, white space in a block becomes one space, blocks are joined in page
order by one space. Markup that ends in the middle is read as far as it goes.

Rows: null or empty html gives an empty text. A null url, or one without "://", has the empty host. Repeated
rows are extracted each and counted once. An empty table gives an empty result. Only page_id, url and
html are read.
"""

import bisect
import html
import json
import re
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

from fleetlake.llm.common import stored
from fleetlake.llm.urls import parsed

SUPPORT, FEW, MEMBERS = 0.6, 5, 2

# Elements as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg head title iframe object select textarea button".split())
BLOCK = frozenset(
    "html body address article aside blockquote br center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that a start tag ends when they are open directly around it.
CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: Elements that end an open paragraph.
ENDS_P = BLOCK - {"html", "body", "br", "td", "th", "tr", "tbody", "thead", "tfoot"}
CONTENT = frozenset(("article", "main"))
ASIDE = frozenset("nav header footer aside form menu dialog".split())
#: Words in classes, ids and roles that mark what is no main text.
MARKS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie consent disclaimer footer header "
    "menu nav navbar navigation newsletter notice pager pagination popup promo related respond share sharing sidebar "
    "social sponsor sponsored subscribe toolbar widget".split()
)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(?![a-zA-Z/!?])|</[^a-zA-Z][^>]*(?:>|\Z)", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-zA-Z]+")


def marked(attributes):
    """Words of an element's class, id and role, without digits."""
    return [w.lower() for m in _NAMED.finditer(attributes) for w in _WORD.findall(m[2] or m[3] or m[4] or "")]


def tokens(page):
    """The page as (kind, path, aside, text): kind is "tag" for a structural element, "text" for a run of text.

    The path names the structural elements around; aside tells whether one of them, or an inline one,
    marks what is no main text. "br" ends a block without being one; its kind is "break".
    """
    stack = []  # tag, step of the path or "", aside
    names, offs, at = [], 0, 0
    silent = None

    def text(run):
        if run:
            yield ("text", ">".join(names), offs > 0, run, any(tag == "a" for tag, _, _ in stack))

    def pop():
        nonlocal offs
        _, step, off = stack.pop()
        if step:
            names.pop()
        offs -= off

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        if silent:
            # Raw text goes on to its own end tag, whatever it holds.
            close = re.compile(rf"</{silent}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
            silent = None
            if m.start() < at:
                continue
        yield from text(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0] == "<":
                at = m.start()
                yield from text("<")
                at = m.end()
            continue
        tag = m[2].lower()
        if m[1]:
            if any(t == tag for t, _, _ in stack):
                while stack[-1][0] != tag:
                    pop()
                pop()
                if tag in BLOCK:
                    yield ("break", "", False, "", False)
            continue
        if tag in SILENT and tag not in ("head", "title", "select", "object", "button", "svg"):
            silent = tag
            continue
        if tag == "br" or tag == "hr":
            yield ("break", "", False, "", False)
        if tag in VOID:
            continue
        ended = CLOSES.get(tag, ())
        while stack and (stack[-1][0] in ended):
            pop()
        if tag in ENDS_P and any(t == "p" for t, _, _ in stack):
            last = max(k for k, (t, _, _) in enumerate(stack) if t == "p")
            if not any(t in BLOCK for t, _, _ in stack[last + 1:]):
                while len(stack) > last:
                    pop()
        words = marked(m[3])
        off = tag in ASIDE or tag in SILENT or bool(MARKS.intersection(words))
        step = ".".join([tag, *words]) if tag in BLOCK or tag in SILENT else ""
        stack.append((tag, step, off))
        offs += off
        if step:
            names.append(step)
            yield ("tag", ">".join(names), offs > 0, "", False)
            yield ("break", "", False, "", False)
        if m[3].rstrip().endswith("/") and tag not in BLOCK:
            pop()
    if silent is None:
        rest = page[at:]
        cut = rest.find("<")
        yield from text(rest if cut < 0 else rest[:cut])


def clean(run):
    return " ".join(html.unescape(run).split())


def pieces(page):
    """The page as (path, off, value, links): elements with an empty value, and blocks of text that nothing marks as aside."""
    block, of, linked = [], "", 0
    for kind, path, off, run, link in (*tokens(page), ("break", "", False, "", False)):
        if kind == "text":
            if not off:
                block.append(run)
                of, linked = path, linked + len(clean(run)) * link
            continue
        value = clean("".join(block)) if block else ""
        if value:
            yield of, False, value, min(linked, len(value))
        block, linked = [], 0
        if kind == "tag":
            yield path, off, "", 0


def numbered(page):
    """The page's tokens as (path, value, off, size, links, text). Equal blocks in one path are told apart by their number."""
    seen = {}
    for path, off, text, links in pieces(page):
        value = ""
        if text:
            value = text if len(text) <= 64 else xxhash.xxh3_128_hexdigest(text)
            seen[path, value] = n = seen.get((path, value), 0) + 1
            value = f"{value}#{n}"
        yield path, value, off, len(text), links, text


def contents(pages):
    """One row per distinct html: its digest, its tokens packed, and the hosts it stands on."""

    def pack(batches):
        import pandas as pd

        for batch in batches:
            made = {}
            for host, page in zip(batch["host"], batch["html"]):
                page = page or ""
                content = xxhash.xxh3_128_hexdigest(page)
                if (host, content) not in made:
                    made[host, content] = zlib.compress(json.dumps([t[:5] for t in numbered(page)]).encode(), 1)
            yield pd.DataFrame([(*k, v) for k, v in made.items()], columns=["host", "content", "tokens"], dtype=object)

    rows = pages.select("host", "html").mapInPandas(pack, "host string, content string, tokens binary")
    return rows.groupBy("content").agg(F.min("tokens").alias("tokens"), F.collect_set("host").alias("hosts"))


def occurrences(found):
    """Per host and token, added up per task: pages, hash of the occurrence vector, order and lengths. Host "" has all pages."""

    def count(batches):
        import pandas as pd

        for batch in batches:
            found = {}
            for content, packed, hosts in zip(batch["content"], batch["tokens"], batch["hosts"]):
                own = {}
                for order, (path, value, off, size, links) in enumerate(json.loads(zlib.decompress(packed))):
                    n, first, _, _, _ = own.get((path, value), (0, order, off, 0, 0))
                    own[path, value] = (n + 1, first, off, size, links)
                for (path, value), (n, first, off, size, links) in own.items():
                    seen = xxhash.xxh3_64_intdigest(f"{content}/{n}")
                    for of in {*hosts, ""}:
                        state = found.setdefault((of, path, value), [0, 0, 0, off, 0, 0, 0])
                        state[0] += 1
                        state[1] ^= seen
                        state[2] += first
                        state[4] += size
                        state[5] += links
                        state[6] = max(state[6], n)
            rows = [(*token, s[0], np.uint64(s[1]).astype(np.int64), s[2], bool(s[3]), s[4], s[5], s[6]) for token, s in found.items()]
            yield pd.DataFrame(rows, columns=["host", "path", "value", "pages", "vector", "order", "off", "size", "links", "most"], dtype=object)

    schema = "host string, path string, value string, pages long, vector long, order long, off boolean, size long, links long, most long"
    return found.mapInPandas(count, schema).groupBy("host", "path", "value").agg(
        F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"), F.sum("order").alias("order"), F.max("off").alias("off"),
        F.sum("size").alias("size"), F.sum("links").alias("links"), F.max("most").alias("most"),
    )


def outside(places):
    """Which of ``places`` lie outside a longest increasing run of them."""
    ends, at, before = [], [], []
    for k, place in enumerate(places):
        n = bisect.bisect_left(ends, place)
        ends[n:n + 1], at[n:n + 1] = [place], [k]
        before.append(at[n - 1] if n else -1)
    k, inside = at[-1] if at else -1, set()
    while k >= 0:
        inside.add(k)
        k = before[k]
    return [k for k in range(len(places)) if k not in inside]


def ranked(members):
    """{(path, value): (class, place in it)} of a host's frequent tokens; class 0 is on the most pages, then the largest."""
    classes = {}
    for m in members:
        classes.setdefault((m["vector"], m["pages"]), []).append(m)
    order = sorted(classes.items(), key=lambda c: (-c[0][1], -len(c[1]), c[0]))
    return {
        (m["path"], m["value"]): (k, place) for k, (_, own) in enumerate(order)
        for place, m in enumerate(sorted(own, key=lambda m: (m["order"] / m["pages"], m["path"], m["value"])))
    }


def tested(found, frequent):
    """Per host and frequent token, over all its pages: whether it ever leaves the order of its class, and the gaps of class 0 it stands in."""
    members = stored(frequent.groupBy("host").agg(F.collect_list(F.struct("path", "value", "vector", "pages", "order")).alias("members")), "members")
    common = members.where("host = ''").first()  # one row, bounded by a page's length
    shared = ranked([m.asDict() for m in common["members"]]) if common else {}
    spread = found.select("tokens", F.posexplode("hosts").alias("nth", "host"))
    joined = spread.join(members.where("host <> ''"), "host", "left").select("host", "nth", "tokens", "members")

    def place(batches):
        import pandas as pd

        known, of = {}, None
        for batch in batches:
            state = {}
            for host, nth, packed, own in zip(batch["host"], batch["nth"], batch["tokens"], batch["members"]):
                if own is not None and host != of:
                    known, of = ranked(own), host
                page = json.loads(zlib.decompress(packed))
                for name, classes in ((host, known if own is not None else {}), ("", shared if nth == 0 else {})):
                    runs, gap = {}, -1
                    for path, value, *_ in page if classes else ():
                        if (path, value) not in classes:
                            continue
                        k, at = classes[path, value]
                        runs.setdefault(k, []).append((at, path, value, gap if k else -2))
                        gap = gap if k else at
                    for run in runs.values():
                        astray = set(outside([r[0] for r in run]))
                        for n, (_, path, value, stands) in enumerate(run):
                            token = state.setdefault((name, path, value), [False, stands, stands])
                            token[0] |= n in astray
                            token[1], token[2] = min(token[1], stands), max(token[2], stands)
            yield pd.DataFrame([(*k, *v) for k, v in state.items()], columns=["host", "path", "value", "astray", "low", "high"], dtype=object)

    placed = joined.mapInPandas(place, "host string, path string, value string, astray boolean, low long, high long")
    return placed.groupBy("host", "path", "value").agg(F.max("astray").alias("astray"), F.min("low").alias("low"), F.max("high").alias("high"))


def templates(pages):
    """One row per host: elements of its template, its template text, and its main slots."""
    held = stored(contents(pages), "contents")
    found = stored(occurrences(held), "tokens")
    counts = held.select(F.explode(F.array_union("hosts", F.array(F.lit("")))).alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    counts = stored(counts, "hosts")
    # What a path holds, however its text varies: sizes, and how much of it had been on the host before.
    paths = found.groupBy("host", "path").agg(
        F.max("off").alias("off"), F.sum("size").alias("size"), F.sum("links").alias("links"), F.sum(F.col("size") * (1 - 1 / F.col("pages"))).alias("again"),
    )
    often = found.join(counts, "host").where((F.col("pages") >= SUPPORT * F.col("of")) & (F.col("most") == 1))
    often = stored(often.select("host", "path", "value", "vector", "pages", "order"), "frequent")
    orderly = tested(held, often).where("not astray and low = high")
    # Classes by vector and gap; a token that no other goes with is merely frequent.
    classes = often.join(orderly, ["host", "path", "value"]).groupBy("host", "vector", "pages", "low").agg(
        F.collect_list(F.struct("path", "value")).alias("members")
    ).where(F.size("members") >= MEMBERS)
    elements = classes.groupBy("host").agg(F.flatten(F.collect_list("members")).alias("members"))
    elements = elements.withColumn("elements", F.transform(F.filter("members", lambda m: m["value"] == ""), lambda m: m["path"]))

    def around(path):
        """Whether every element around one of the template is in the template."""
        return F.forall(
            F.sequence(F.lit(1), F.size(F.split(path, ">"))),
            lambda n: F.array_contains("elements", F.array_join(F.slice(F.split(path, ">"), 1, n), ">")),
        )

    elements = elements.withColumn("elements", F.filter("elements", around))
    fixed = F.filter("members", lambda m: (m["value"] != "") & F.array_contains("elements", m["path"]))
    elements = elements.select("host", "elements", F.transform(fixed, lambda m: F.concat_ws("\n", m["path"], m["value"])).alias("fixed"))
    # A path's slot is its longest beginning among the template's elements.
    slots = paths.join(elements, "host").withColumn("slot", F.reverse(F.filter(
        F.transform(F.sequence(F.lit(1), F.size(F.split("path", ">"))), lambda n: F.array_join(F.slice(F.split("path", ">"), 1, n), ">")),
        lambda p: F.array_contains("elements", p),
    )))
    slots = slots.withColumn("slot", F.coalesce(F.get("slot", F.lit(0)), F.lit(""))).groupBy("host", "slot").agg(
        F.max(F.when(F.col("path") == F.col("slot"), F.col("off"))).alias("off"), F.sum("size").alias("size"), F.sum("links").alias("links"), F.sum("again").alias("again")
    )
    told = F.coalesce("off", F.lit(False))
    varied = (F.col("links") < 0.4 * F.col("size")) & (F.col("again") < 0.6 * F.col("size"))
    main = slots.groupBy("host").agg(F.collect_set(F.when(~told & varied, F.col("slot"))).alias("main"))
    return elements.join(main, "host", "left").join(counts, "host").select(
        "host", "of", "elements", "fixed", F.coalesce("main", F.array().cast("array<string>")).alias("main")
    )


def main_text(page, elements, fixed, main):
    """The text in a page's main slots, without template text; without a template, what its article or main element holds, or else all."""
    elements, fixed, main = set(elements), set(fixed), set(main)
    held, slots = list(numbered(page)), {}
    named = not elements and any(step.split(".")[0] in CONTENT for path, *_ in held for step in path.split(">"))
    blocks = []
    for path, value, _, _, _, text in held:
        if not text:
            continue
        if path not in slots:
            steps = path.split(">")
            if elements:
                slots[path] = next((p for p in (">".join(steps[:n]) for n in range(len(steps), 0, -1)) if p in elements), "") in main
            else:
                slots[path] = not named or any(step.split(".")[0] in CONTENT for step in steps)
        if slots[path] and f"{path}\n{value}" not in fixed:
            blocks.append(text)
    return " ".join(blocks)


def extracted(pages):
    """One row per page: page_id, url, text, n_chars."""
    host, _ = parsed(F.col("url"))
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html")).withColumn("host", host)
    made = stored(templates(rows), "templates")
    own = made.where((F.col("of") >= FEW) & (F.col("host") != ""))
    common = made.where("host = ''").select([F.col(c).alias(f"all_{c}") for c in ("elements", "fixed", "main")])
    shared = common.first()  # one row, bounded by a page's length
    joined = rows.join(own.drop("of"), "host", "left")

    def extract(batches):
        import pandas as pd

        for batch in batches:
            texts = []
            for page, *template in zip(batch["html"], batch["elements"], batch["fixed"], batch["main"]):
                if template[0] is None:
                    template = list(shared) if shared else [(), (), ()]
                texts.append(main_text(page or "", *template))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": pd.Series(texts, dtype=object), "n_chars": [len(t) for t in texts]})

    kind = dict(pages.dtypes)
    return joined.select("page_id", "url", "html", "elements", "fixed", "main").mapInPandas(
        extract, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long"
    )
