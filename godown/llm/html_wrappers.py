"""HTML main text (operator 12): wrappers as union-free regular expressions, inferred per host.

A page becomes a stream of start tags, text slots and end tags, kept nested.
A wrapper is such a stream in which an item may be optional (``?``) or
repeated (``+``, ``*``) and items may be grouped; there is no choice between
items.  Two streams are aligned item by item (longest common subsequence of
their tokens); a mismatch is resolved

* inside one stream, where items or sequences of up to ``PERIOD`` items
  follow themselves: they become a repeated item or group;
* between streams: what only one has becomes optional;
* texts that differ become slots, texts that are equal on all pages are the
  template's own.

1. Per page: its stream, folded (its *shape*), and for each text slot length,
   link text and hash.  Both are added up per (host, shape) before they move.
2. Per host: the distinct shapes are aligned, ``FAN`` at a time and round
   after round, into one wrapper, so no task holds all shapes of a host.
3. Every distinct shape is aligned with its host's wrapper, which brings the
   figures of all pages to the wrapper's slots; per host it is decided which
   slots are main text.
4. Per page: the shape is aligned with the wrapper (once per task and shape)
   and the texts in main slots are the page's text.  A page that has none of
   its host's main slots is judged by its own figures.

Decisions on a slot: elements and class names that say what they are (menu,
footer, form, comment ...) are never main text; then text in ``article``
(else ``main``, else in the element that holds most of the host's text) is,
unless it is the same on all pages.  Outside of ``article`` and ``main`` a slot
that is mostly links isn't either.
"""

from __future__ import annotations

import hashlib
import html
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.llm.common import out_batch, slices, written

#: Shapes that one task aligns at a time.
FAN = 256
#: Longest sequence of items that is looked for behind itself.
PERIOD = 3
#: Elements below this depth are taken for part of the element above; no text is lost.
DEPTH = 90
#: A text is the template's own if that many different pages (counted by a 64-bit map) have it.
ALIKE = 5
#: Wrappers of all hosts are broadcast up to this many bytes, else joined by host.
BROADCAST_BYTES = 32 << 20
SLICE = 2 << 20

# Element names of HTML, and words of class, id and role that name parts around an article.
INLINE = set("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp
    small span strike strong sub sup time tt u var""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe noscript noembed noframes xmp".split())
NOT_MAIN = set("""head title script style noscript noembed noframes iframe object svg math canvas template nav footer
    aside form button select option datalist fieldset legend textarea label dialog menu audio video map""".split())
NOT_MAIN_WORDS = set("""ad ads advert adverts advertisement advertising advertorial alert announcement banner breadcrumb
    breadcrumbs comment comments complementary contentinfo cookie cookies consent copyright dialog disqus footer gdpr
    form login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager
    pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar
    signup skip social sponsor sponsored subscribe subscription toolbar widget widgets""".split())
HEADER_WORDS = {"header"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = set("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dt dd""".split())
SCOPE = set("html table td th caption template button object".split())
#: name: (open elements that its start ends, elements beyond which they stay open)
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
        "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
        "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
CONTAINERS = set("html body div section center table tbody tr td main article".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?/](?![a-zA-Z])[^>]*+(?:>|\Z)|<![^>]*+(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S | re.X)
ATTR = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"']|$)""", re.I)
WORD = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def token(name: str, attrs: str) -> tuple[str, bool]:
    """The token of a start tag (name and the letters of its class, id and role), and whether it names a part that is not main."""
    if not attrs or attrs.isspace():
        return name, name in NOT_MAIN
    words, hidden = [], False
    for kind, a, b, c in ATTR.findall(attrs):
        value = (a or b or c).lower()
        kind = kind.lower()
        if kind == "hidden":
            hidden = True
        elif kind == "style":
            hidden |= bool(HIDDEN.search(value))
        else:
            words += WORD.findall(value)
    full = ".".join([name, *dict.fromkeys(words), *(["-hidden"] if hidden else [])])
    return full, name in NOT_MAIN or hidden or not NOT_MAIN_WORDS.isdisjoint(words)


def parse(page: str) -> tuple[list, list[str], list[int]]:
    """(items, texts, link_chars): nested [token, quantifier, items]; a text slot is ["#", quantifier, [text number]]."""
    items: list = []
    stack: list = [("", items, True)]              # (name, its items or those it adds to, is an element of the stream)
    texts: list[str] = []
    links: list[int] = []
    run: list[str] = []
    state = [0, 0]                                 # open links, link characters of the run

    def flush() -> None:
        if not run:
            return
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            stack[-1][1].append(["#", "1", [len(texts)]])
            texts.append(text)
            links.append(min(state[1], len(text)))
        state[1] = 0

    def pop() -> None:
        if stack[-1][2]:
            flush()
        if stack.pop()[0] == "a" and state[0]:
            state[0] -= 1

    def close(names: set, until: set) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                while len(stack) > k:
                    pop()
                return
            if stack[k][0] in until:
                return

    def say(raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        run.append(text)
        if state[0]:
            state[1] += len(text.strip())

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        start, stop = m.span()
        if start > at:
            say(page[at:start])
        at = stop
        end, name, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        inline = name in INLINE
        if end:
            if name in VOID:
                continue
            if inline:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        if all(x[0] in INLINE for x in stack[k:]) or stack[k][2]:
                            while len(stack) > k:
                                pop()
                        else:                      # ends outside of the block in which it stands
                            del stack[k]
                            if name == "a" and state[0]:
                                state[0] -= 1
                        break
                    if stack[k][0] in SCOPE:
                        break
            else:
                flush()
                close({name}, SCOPE - {name} if name in CLOSES_P or name == "p" else set())
            continue
        if name in VOID:
            if name == "hr":
                flush()
                close({"p"}, SCOPE)
            else:
                run.append(" " if name in ("br", "wbr", "img", "input", "embed") and name != "wbr" else "")
            continue
        full, bad = token(name, attrs) if attrs else (name, name in NOT_MAIN)
        if inline and not bad:
            stack.append((name, stack[-1][1], False))
            if name == "a":
                state[0] += 1
            continue
        flush()
        if name in CLOSES_P:
            close({"p"}, SCOPE)
        if name in ENDS:
            close(*ENDS[name])
        if len(stack) > DEPTH and not bad:
            stack.append((name, stack[-1][1], True))
        else:
            node = [full, "1", []]
            stack[-1][1].append(node)
            stack.append((name, node[2], True))
        if name in RAW:
            m = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            stop = n if m is None else m.start()
            if name not in ("script", "style"):
                say(page[at:stop])
            at = stop
        elif attrs.rstrip().endswith("/") and not inline and name not in CLOSES_P:
            pop()
    flush()
    while len(stack) > 1:
        pop()
    return folded(items), texts, links


def name_of(item: list) -> str:
    """What items are aligned by: the token; of a group those of its items."""
    return item[0] if item[0] != "(" else "(" + " ".join(map(name_of, item[2])) + ")"


def joined(a: str, b: str) -> str:
    """The quantifier that covers both."""
    optional, many = a in "?*" or b in "?*", a in "+*" or b in "+*"
    return "*" if optional and many else "?" if optional else "+" if many else "1"


def merged(a: list, b: list) -> list:
    return [a[0], joined(a[1], b[1]), a[2] + b[2] if a[0] == "#" else aligned(a[2], b[2])]


def repeated(a: list, b: list) -> list:
    out = merged(a, b)
    out[1] = joined(out[1], "+")
    return out


def folded(items: list) -> list:
    """Items and sequences of items that follow themselves become one repeated item or group."""
    for x in items:
        if x[0] != "#":
            x[2] = folded(x[2])
    out: list = []
    for x in items:
        if out and name_of(out[-1]) == name_of(x):
            out[-1] = repeated(out[-1], x)
        else:
            out.append(x)
    for period in range(2, PERIOD + 1):
        if len(out) < 2 * period:
            break
        names = [name_of(x) for x in out]
        k, kept = 0, []
        while k < len(out):
            copies = 1
            while names[k:k + period] == names[k + copies * period:k + (copies + 1) * period] and k + period <= len(out):
                copies += 1
            if copies > 1:
                body = out[k:k + period]
                for c in range(1, copies):
                    body = [merged(p, q) for p, q in zip(body, out[k + c * period:k + (c + 1) * period])]
                kept.append(["(", "+", body])
                k += copies * period
            else:
                kept.append(out[k])
                k += 1
        out = kept
    return out


def gathered(items: list, other: list) -> list:
    """``items`` with sequences that are a group in ``other`` made into that group."""
    for group in (g for g in other if g[0] == "("):
        names = [name_of(x) for x in group[2]]
        k, out = 0, []
        while k < len(items):
            if [name_of(x) for x in items[k:k + len(names)]] == names:
                mine = ["(", "1", items[k:k + len(names)]]
                out.append(mine)
                k += len(names)
            else:
                out.append(items[k])
                k += 1
        items = out
    return items


def aligned(a: list, b: list) -> list:
    """One list of items that covers both: common items merged, others optional, in order."""
    if any(x[0] == "(" for x in b):
        a = gathered(a, b)
    if any(x[0] == "(" for x in a):
        b = gathered(b, a)
    left, right = [name_of(x) for x in a], [name_of(x) for x in b]
    if left == right:
        return [merged(x, y) for x, y in zip(a, b)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, under = best[i], best[i + 1]
        for j in range(len(b) - 1, -1, -1):
            row[j] = under[j + 1] + 1 if left[i] == right[j] else max(under[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and left[i] == right[j]:
            out.append(merged(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append([a[i][0], joined(a[i][1], "?"), a[i][2]])
            i += 1
        else:
            out.append([b[j][0], joined(b[j][1], "?"), b[j][2]])
            j += 1
    return folded(out)


def slots(items: list, path: tuple = ()):
    """(path of tokens, slot) of every text slot, in order."""
    for x in items:
        if x[0] == "#":
            yield path, x
        else:
            yield from slots(x[2], path if x[0] == "(" else (*path, x[0]))


def blank(items: list) -> list:
    """The stream without its text numbers."""
    return [[k, q, [] if k == "#" else blank(sub)] for k, q, sub in items]


def numbered(items: list, number) -> list:
    """Text slots get ``number(0), number(1), ...``, in order."""
    count = iter(range(1 << 60))
    go = lambda xs: [[k, q, [number(next(count))] if k == "#" else go(sub)] for k, q, sub in xs]
    return go(items)


def wrapper_of(shapes: list[str]) -> str:
    """The shapes aligned one after the other."""
    out: list | None = None
    for s in sorted(set(shapes)):
        items = json.loads(s)
        out = items if out is None else aligned(out, items)
    return json.dumps(out or [], separators=(",", ":"))


def slots_of_shape(wrapper: list, shape: list) -> list[int]:
    """For each text slot of the shape that slot of the wrapper on which it falls; -1 if none."""
    both = aligned(numbered(wrapper, lambda k: k), numbered(shape, lambda k: -1 - k))
    out = [-1] * sum(1 for _ in slots(shape))
    for _, x in slots(both):
        own = min((k for k in x[2] if k >= 0), default=-1)
        for k in x[2]:
            if k < 0:
                out[-1 - k] = own
    return out


def not_main(path: tuple, in_region: bool) -> bool:
    for k, full in enumerate(path):
        name, *words = full.split(".")
        if name in NOT_MAIN or "-hidden" in words or not NOT_MAIN_WORDS.isdisjoint(words):
            return True
        head = name == "header" or not HEADER_WORDS.isdisjoint(words)
        if head and not (in_region and any(p.split(".")[0] in ("article", "main") for p in path[:k])):
            return True
    return False


def main_slots(paths: list[tuple], figures: dict) -> list[bool]:
    """Which slots of a wrapper are main text; ``figures``: slot -> (pages, chars, link chars, one text, map of pages)."""
    none = (0, 0, 0, False, 0)
    good = [not not_main(p, True) for p in paths]
    chars = [figures.get(k, none)[1] for k in range(len(paths))]
    within = {r: [k for k, p in enumerate(paths) if good[k] and any(x.split(".")[0] == r or r in x.split(".")[1:] for x in p)]
              for r in ("article", "main")}
    every = [k for k in range(len(paths)) if good[k]]
    total = sum(chars[k] for k in every)
    region = next((within[r] for r in ("article", "main") if within[r] and 3 * sum(chars[k] for k in within[r]) >= total), None)
    semantic = region is not None
    if region is None:
        region, depth = every, 0
        while True:
            below: dict[str, int] = {}
            for k in region:
                if len(paths[k]) > depth and paths[k][depth].split(".")[0] in CONTAINERS:
                    below[paths[k][depth]] = below.get(paths[k][depth], 0) + chars[k]
            most = max(below, key=below.get, default=None)
            if most is None or 10 * below[most] < 8 * sum(chars[k] for k in region):
                break
            region, depth = [k for k in region if len(paths[k]) > depth and paths[k][depth] == most], depth + 1
    out = [False] * len(paths)
    for k in region:
        pages, c, link, same, bits = figures.get(k, none)
        heading = any(x.split(".")[0] in HEADINGS for x in paths[k])
        template = same and bin(bits & (1 << 64) - 1).count("1") >= ALIKE and not heading
        out[k] = not template and (semantic or 2 * link <= c or heading)
    return out


def hash64(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


STATS = "host string, shape string, slot int, pages long, chars long, links long, low long, high long, bits long"


def page_figures(batches):
    """Step 1: per host, shape and slot the pages, characters, link characters, least and greatest text hash, map of pages."""
    names = [c.split(" ")[0] for c in STATS.split(", ")]
    for part in slices(batches, "html", SLICE):
        sums: dict = {}
        for host, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            items, texts, links = parse(page)
            shape = json.dumps(blank(items), separators=(",", ":"))
            bit = signed(1 << (hash64("\n".join(texts)) & 63))
            sums.setdefault((host, shape, -1), [0, 0, 0, 0, 0, 0])[0] += 1      # a page without text has its shape, too
            for k, (_, x) in enumerate(slots(items)):
                h = hash64("\n".join(texts[t] for t in x[2]))
                s = sums.setdefault((host, shape, k), [0, 0, 0, h, h, 0])
                s[0] += 1
                s[1] += sum(len(texts[t]) for t in x[2])
                s[2] += sum(links[t] for t in x[2])
                s[3], s[4], s[5] = min(s[3], h), max(s[4], h), s[5] | bit
        if sums:
            yield out_batch(names, [pa.array([key[i] for key in sums], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int32()))]
                            + [pa.array([s[i] for s in sums.values()], pa.int64()) for i in range(6)])


def aligned_group(table: pa.Table) -> pa.Table:
    return pa.table({"host": table["host"][:1].cast(pa.string()), "wrapper": [wrapper_of(table["wrapper"].to_pylist())]},
                    schema=pa.schema([("host", pa.string()), ("wrapper", pa.string())]))


def wrappers(shapes: DataFrame) -> DataFrame:
    """Step 2: (host, wrapper) of (host, shape) rows, aligned FAN at a time."""
    found = written(shapes.select("host", F.col("shape").alias("wrapper")), "html_shapes")
    while True:
        most = found.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        parts = max(1, -(-most // FAN))
        part = F.pmod(F.xxhash64("wrapper"), F.lit(parts))
        found = written(found.withColumn("part", part).groupBy("host", "part").applyInArrow(aligned_group, "host string, wrapper string"),
                        "html_wrappers")
        if parts == 1:
            return found


def shape_figures(batches):
    """Step 3: the figures of a shape's slots at the slots of its host's wrapper."""
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        out: list[list] = [[] for _ in range(8)]
        seen: dict = {}
        for host, shape, slot, wrapper, *figures in zip(*cols):
            key = (wrapper, shape)
            if key not in seen:
                seen[key] = slots_of_shape(json.loads(wrapper), json.loads(shape))
            for x, y in zip(out, (host, seen[key][slot], *figures)):
                x.append(y)
        yield out_batch(["host", "slot", "pages", "chars", "links", "low", "high", "bits"],
                        [pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), *(pa.array(x, pa.int64()) for x in out[2:])])


def decided(batches):
    """(host, wrapper, main): which of the wrapper's slots are main text."""
    for batch in batches:
        main = []
        for wrapper, figures in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            by_slot = {f["slot"]: (f["pages"], f["chars"], f["links"], f["low"] == f["high"], f["bits"]) for f in figures or []}
            main.append(main_slots([p for p, _ in slots(json.loads(wrapper))], by_slot))
        yield out_batch(["host", "wrapper", "main"], [batch.column(0), batch.column(1), pa.array(main, pa.list_(pa.bool_()))])


def main_texts(batches):
    """Step 4: each page's texts in main slots."""
    seen: dict = {}
    for part in slices(batches, "html", SLICE):
        cols = {n: part.column(i) for i, n in enumerate(part.schema.names)}
        out = []
        for page, wrapper, main in zip(cols["html"].to_pylist(), cols["wrapper"].to_pylist(), cols["main"].to_pylist()):
            items, texts, links = parse(page)
            shape = json.dumps(blank(items), separators=(",", ":"))
            key = (wrapper, shape)
            if key not in seen:
                if len(seen) >= 10_000:            # only a memo
                    seen.clear()
                at = slots_of_shape(json.loads(wrapper), json.loads(shape))
                paths = [p for p, _ in slots(items)]
                keep = [main[w] if w >= 0 else not not_main(p, True) for w, p in zip(at, paths)]
                seen[key] = keep, paths
            keep, paths = seen[key]
            own = [x[2] for _, x in slots(items)]
            if not any(keep):                      # a page unlike the others of its host
                keep = main_slots(paths, {k: (1, sum(len(texts[t]) for t in x), sum(links[t] for t in x), False, 0)
                                          for k, x in enumerate(own)})
            runs = sorted(t for k, x in zip(keep, own) if k for t in x)
            out.append("\n\n".join(texts[t] for t in runs).encode("utf-8", "replace").decode())
        yield out_batch(["row", "text"], [cols["row"], pa.array(out, pa.string())])


def host_of(url):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text: the main text of every row of ``pages``.

    Blocks are in page order, joined by two line feeds; inside a block white
    space is one space.  Null or empty html gives an empty text.  Pages
    without a host (no ``://`` or a null url) share a wrapper.  Repeated rows
    and ids (null ones too) give a row each; equal pages count as one when
    it is judged whether a text is the template's own.  Other columns don't
    matter, whatever their names.  An empty table gives none.
    """
    rows = pages.select(F.struct(pages[id_col].alias("page_id"), pages[url_col].alias("url")).alias("row"),
                        host_of(pages[url_col]).alias("host"), F.coalesce(pages[html_col], F.lit("")).alias("html"))
    sums = (F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.sum("links").alias("links"),
            F.min("low").alias("low"), F.max("high").alias("high"), F.bit_or("bits").alias("bits"))
    figures = written(rows.select("host", "html").mapInArrow(page_figures, STATS).groupBy("host", "shape", "slot").agg(*sums),
                      "html_figures")
    found = wrappers(figures.where("slot = -1"))
    at = (figures.where("slot >= 0").join(found, "host")
          .select("host", "shape", "slot", "wrapper", "pages", "chars", "links", "low", "high", "bits")
          .mapInArrow(shape_figures, STATS.replace("shape string, ", "")).groupBy("host", "slot").agg(*sums))
    per_host = at.groupBy("host").agg(F.collect_list(F.struct("slot", "pages", "chars", "links", "low", "high", "bits")).alias("figures"))
    told = written(found.join(per_host, "host", "left").select("host", "wrapper", "figures")
                   .mapInArrow(decided, "host string, wrapper string, main array<boolean>"), "html_decisions")
    size = told.agg(F.sum(F.length("wrapper") + F.size("main") + F.length("host"))).first()[0] or 0
    side = F.broadcast(told) if size <= BROADCAST_BYTES else told
    kind = rows.schema["row"].dataType.simpleString()
    return (rows.join(side, "host").select("row", "html", "wrapper", "main")
            .mapInArrow(main_texts, f"row {kind}, text string").select("row.page_id", "row.url", "text"))
