"""HTML extraction by wrappers: union-free regular expressions inferred from the token streams of a host.

1. **Tokens.** A page is a stream of block tags (inline markup is dropped, unclosed paragraphs and items are
   closed as browsers do) and text slots; equal neighbouring groups fold into one repeated group, from short
   to long, so pages of one template have few distinct streams.
2. **Inference.** The distinct streams of a host (with their counts, folded before they are shuffled) are
   aligned one after the other to one expression of tokens, groups, `?` and `+`: what only one side has
   becomes optional, a group that follows its like becomes a repetition. Streams are dealt to chunks of at
   most `chunk` streams by salt; the chunks' expressions are aligned in further rounds until one is left
   per host, so no task holds all of a large host.
3. **Slots.** A slot of the expression is known by the path of tags (with class, id and role) around it. Slots
   in menus, headers, footers, sidebars, notices, adverts, forms, comments and teasers of other articles are left
   out, by tag or by name and never by size; an element that encloses the page's only main region is none of them.
   Text that pages repeat is kept: how often a block occurs on a host decides nothing.
4. **Extraction.** Each page's blocks at the host's content slots, in page order: those in the page's own main
   regions (article, main or a like class) and its headline, else all. A headline outside them brings the
   blocks around it along if no main region stands among these.

Defined results: null or empty html gives an empty text; a page without url (or host) is of host ''; pages
without a main region give all their blocks outside boilerplate; repeated rows give equal rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import looked_up, store

ATTRS = r"""(?:(?>"[^"]*"|'[^']*'|[^>"']|["'])*+)"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<![^>]*>|<\?[^>]*>"
    rf"|<(?P<raw>script|style|textarea|title|xmp)\b{ATTRS}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<inner>noscript|template|iframe|svg|math|object|select)\b{ATTRS}>.*?</(?P=inner)\s*>"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>{ATTRS})>",
    re.S | re.I,
)
CUT_TAG = re.compile(r"<[a-zA-Z/!?][^<]*\Z")
ATTRIBUTE = re.compile(r"""([a-zA-Z_:-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base basefont col embed hr img input link meta param source track wbr frame".split())
# What a start tag closes: unclosed paragraphs, list items, cells and options.
CLOSES = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
    "th": {"td", "th", "p"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
    "option": {"option"},
}
SCOPES = frozenset("ul ol dl table article section div nav aside main header footer form blockquote td th body".split())
# Elements that are never part of an article, and words of class, id and role that say the same.
BOILER_TAGS = frozenset("nav footer aside form button dialog menu head audio video canvas input fieldset".split())
BOILER_WORDS = frozenset(
    "nav navbar navigation menu menubar header masthead footer sidebar aside ad ads advert adverts advertisement advertising adsense sponsor "
    "sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup login form search breadcrumb breadcrumbs pagination pager share sharing social related recommended comment comments commentlist "
    "disqus reply replies respond widget toolbar skip copyright disclaimer toast contentinfo complementary feedback discussion "
    "teaser teasers readmore bio adsbygoogle".split()
)
MAIN_TAGS = frozenset(["article", "main"])
MAIN_WORDS = frozenset(["article", "articlebody", "main", "maincontent", "postcontent", "entrycontent", "articlecontent", "storybody", "pagecontent"])
NEVER_BY_WORD = frozenset(["html", "body", "main", "article"])
STATES = ("has", "with", "no", "is", "without")
# Words at the end of a name that only say how the element is laid out: the word before them is its head.
FORMS = frozenset("area bar block box button buttons container content default group icon icons inner item items link links list outer panel posts section slot slots stories unit wrap wrapper".split())
# Words that say where an element stands or what it holds; after a leading boilerplate word they change nothing.
PLACES = frozenset("top bottom left right center middle text body thread articles message wide small large mobile desktop fixed sticky".split())
# Words before a name that only say whose it is.
OWNERS = frozenset("site page global".split())
# Words that name parts of an article when they stand in its region (or on a heading).
PART_WORDS = frozenset("header masthead discussion".split())
# What readers or other articles add is no main region, whatever its tag.
OTHERS_WORDS = frozenset("comment comments commentlist disqus reply replies respond related recommended teaser teasers".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
# A form with page parts in it (such as a footer) frames the page and is not what readers fill in.
FRAMES = frozenset(["form", "fieldset"])
# Boilerplate tags that stand in forms that readers fill in.
CONTROLS = frozenset("form fieldset button dialog input canvas audio video".split())


def _head_words(name: str) -> set[str]:
    """The words of a name that decide: its head, the name as one word, and the leading word if only FORMS and PLACES follow.

    site-footer, ad-slot, sidebar-right, cookie-consent-text; not layout-sidebar-right, content-with-sidebar.
    """
    words = [w.lower() for w in PART.findall(name)]
    state = next((i for i, w in enumerate(words) if w in STATES), len(words))
    words = words[:state]
    head = next((w for w in reversed(words) if w not in FORMS and not w.isdigit()), "")
    own = words[1:] if words and words[0] in OWNERS else words
    plain = own and all(w in FORMS or w in PLACES or w in BOILER_WORDS or w.isdigit() for w in own[1:])
    return {head, "".join(words), *(own[:1] if plain else [])}


def _node(tag: str, attrs: str, inside: bool = False) -> tuple[str, bool]:
    """A tag with the marks that decide its role: b (left out), m (main region), . (neither); then tag, class and id.

    Also whether a `b` is taken back where the element frames the page. `inside`: it stands in a main region.
    """
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attrs)} if attrs.strip() else {}
    names = [n for key in ("class", "id", "role", "itemprop") for n in found.get(key, "").split()]
    heads = set().union(*map(_head_words, names))
    others = bool(OTHERS_WORDS & heads)
    by_tag = tag in BOILER_TAGS
    main = not others and (tag in MAIN_TAGS or any("".join(PART.findall(n)).lower() in MAIN_WORDS for n in names))
    words = BOILER_WORDS - PART_WORDS if inside or tag in HEADINGS else BOILER_WORDS
    by_word = not main and (tag not in NEVER_BY_WORD or (others and tag == "article")) and bool(words & heads)
    style = found.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
    boiler = by_tag or by_word or hidden
    label = ".".join([tag, *re.sub(r"\d+", "0", " ".join(names)).split()][:4])
    free = not hidden and not others and (not by_tag or tag in FRAMES or tag == "header")
    return ("b" if boiler else "m" if main else ".") + label, free


def blocks(page: str | None) -> tuple[list[str], list[tuple[str, str]]]:
    """(token stream, [(path, text)]): block tags and slots in page order, and the text of every filled slot.

    An element that its name or tag marks as boilerplate is none if it encloses the page's only main region, nor is
    a form outside main regions that encloses marked parts of the page.
    """
    stream, texts, free = _blocks(page, frozenset())
    taken: frozenset[int] = frozenset()
    while free:  # what is taken back may show others within it
        taken |= free
        stream, texts, free = _blocks(page, taken)
    return stream, texts


def _blocks(page: str | None, taken: frozenset[int]) -> tuple[list[str], list[tuple[str, str]], frozenset[int]]:
    """The same with the elements `taken` (by number) unmarked, and the further elements to unmark."""
    stream: list[str] = []
    texts: list[tuple[str, str]] = []
    if not page:
        return stream, texts, frozenset()
    stack: list[tuple[str, str, int]] = []
    piece: list[str] = []
    freeable: set[int] = set()
    around: set[int] = set()  # marked elements with a main region within
    frames: set[int] = set()  # forms with parts of the page within
    opened = 0
    clear = False  # a main region outside marked elements

    def flush() -> None:
        nonlocal clear
        text = " ".join(entities.unescape("".join(piece)).split())
        piece.clear()
        if text:
            path = "/".join(n for _, n, _ in stack)
            marked = [i for i, (_, n, _) in enumerate(stack) if n[0] == "b"]
            last_main = max((i for i, (_, n, _) in enumerate(stack) if n[0] == "m"), default=-1)
            clear = clear or (last_main >= 0 and not marked)
            around.update(stack[i][2] for i in marked if i < last_main)
            if stream[-1:] != ["#"]:
                stream.append("#")
            texts.append((path, text))

    def pop(depth: int) -> None:
        flush()
        while len(stack) > depth:
            stream.append("/" + stack.pop()[1])

    last = 0
    for m in TOKEN.finditer(page):
        piece.append(page[last : m.start()])
        last = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                piece.append(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        if tag == "br":
            piece.append(" ")
        elif tag in INLINE:
            continue
        elif tag in VOID:
            flush()
        elif m["close"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                pop(depth)
            else:
                flush()
        else:
            flush()
            shut = CLOSES.get(tag, {"p"})
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in shut:
                    pop(i)
                elif stack[i][0] in SCOPES and not (tag in ("tr", "tbody", "tfoot") and stack[i][0] in ("td", "th")):
                    break
            inside = any(n[0] == "m" for _, n, _ in stack)
            node, free = _node(tag, m["attrs"] or "", inside)
            if node[0] == "." and tag == "header" and not inside:
                node = "b" + node[1:]
            opened += 1
            if opened in taken:
                node = "." + node[1:]
            elif free:
                freeable.add(opened)
            if node[0] == "b" and not inside and tag not in CONTROLS:
                frames.update(n for t, m, n in stack if t in FRAMES and m[0] == "b")
            stack.append((tag, node, opened))
            stream.append(node)
    piece.append(CUT_TAG.sub("", page[last:]))
    pop(0)
    return stream, texts, frozenset(i for i in freeable if i in frames or (i in around and not clear))


# ---------------------------------------------------------------- union-free expressions
# A term is (content, mark): content a token or a tuple of terms, mark one of "", "?", "+", "*".

Term = tuple


def _loose(a: str, b: str) -> str:
    """The mark that covers both."""
    return {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}[
        ("?" in a or "*" in a or "?" in b or "*" in b, "+" in a or "*" in a or "+" in b or "*" in b)
    ]


def _shape(terms: tuple) -> tuple:
    """Terms without marks: what decides whether two groups are alike."""
    return tuple(c if isinstance(c, str) else _shape(c) for c, _ in terms)


def fold(terms: list[Term], longest: int = 12) -> list[Term]:
    """Equal neighbouring groups, shortest first, become one repeated group."""
    keys = [t[0] if isinstance(t[0], str) else _shape(t[0]) for t in terms]
    for size in range(1, longest + 1):
        if 2 * size > len(terms):
            break
        i, out, out_keys = 0, [], []
        while i < len(terms):
            n = 1
            if keys[i] != "#":
                while keys[i : i + size] == keys[i + n * size : i + (n + 1) * size]:
                    n += 1
            if n > 1:
                group = terms[i : i + size]
                for j in range(1, n):
                    group = [_join(x, y) for x, y in zip(group, terms[i + j * size : i + (j + 1) * size])]
                inner = group[0] if size == 1 else (tuple(group), "")
                out.append((inner[0], _loose(inner[1], "+")))
                out_keys.append(keys[i] if size == 1 else tuple(keys[i : i + size]))
                i += n * size
            else:
                out.append(terms[i])
                out_keys.append(keys[i])
                i += 1
        terms, keys = out, out_keys
    return terms


def _join(a: Term, b: Term) -> Term:
    """One term for two of the same shape."""
    content = a[0] if isinstance(a[0], str) else tuple(_join(x, y) for x, y in zip(a[0], b[0]))
    return content, _loose(a[1], b[1])


def nested(stream: list[str]) -> list[Term]:
    """A stream as terms: every element with its content is one group, so folding works on whole elements."""
    level: list[list[Term]] = [[]]
    names: list[str] = []

    def close() -> None:
        inner = level.pop()
        term = ((("<" + names.pop(), ""), *(inner if len(inner) < 2 else fold(inner))), "")
        before = level[-1][-1] if level[-1] else None
        if before and (before[0] == term[0] or not isinstance(before[0], str) and _shape(before[0]) == _shape(term[0])):
            content = before[0] if before[0] == term[0] else _join(before, term)[0]
            level[-1][-1] = (content, _loose(before[1], "+"))  # a run of like elements is folded as it grows
        else:
            level[-1].append(term)

    for token in stream:
        if token == "#":
            level[-1].append(("#", ""))
        elif token.startswith("/"):
            close()
        else:
            names.append(token)
            level.append([])
    while names:
        close()
    return fold(level[0])


def _head(t: Term) -> tuple[str, str]:
    """What terms are aligned by: the kind (token, element or folded group of elements) and the first token within.

    A group begins as its first element does, but aligning the two would mix their levels.
    """
    content = t[0]
    kind = "token" if isinstance(content, str) else "element" if isinstance(content[0][0], str) else "group"
    while not isinstance(content, str):
        content = content[0][0]
    return kind, content


def align(a: list[Term], b: list[Term]) -> list[Term]:
    """The expression that covers both: terms of one kind with the same head are aligned within, the rest becomes optional."""
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], 1 + best[i + 1][j + 1] if _head(a[i]) == _head(b[j]) else 0)
    out: list[Term] = []
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and _head(a[i]) == _head(b[j]) and best[i][j] == 1 + best[i + 1][j + 1]:
            x, y = a[i], b[j]
            content = x[0] if isinstance(x[0], str) else tuple(align(list(x[0]), list(y[0])))
            out.append((content, _loose(x[1], y[1])))
            i, j = i + 1, j + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append((a[i][0], _loose(a[i][1], "?")))
            i += 1
        else:
            out.append((b[j][0], _loose(b[j][1], "?")))
            j += 1
    return merge_like(out)


def merge_like(terms: list[Term]) -> list[Term]:
    """Neighbours with one head become one repetition, aligned within."""
    out: list[Term] = []
    for t in terms:
        if out and _head(out[-1]) == _head(t) and not isinstance(t[0], str):
            prev = out.pop()
            mark = _loose("+", "?" if ("?" in prev[1] or "*" in prev[1]) and ("?" in t[1] or "*" in t[1]) else "")
            out.append((tuple(align(list(prev[0]), list(t[0]))), mark))
        else:
            out.append(t)
    return out


def show(terms: list[Term] | tuple) -> str:
    """The expression as text."""
    return " ".join((c if isinstance(c, str) else "(" + show(c) + ")") + mark for c, mark in terms)


def parse(text: str) -> list[Term]:
    """The terms of an expression written by `show`."""
    level: list[list[Term]] = [[]]
    for token in re.findall(r"\(|\)[?+*]?|[^\s()]+", text):
        if token == "(":
            level.append([])
        elif token.startswith(")"):
            inner = tuple(level.pop())
            level[-1].append((inner, token[1:]))
        else:
            mark = token[-1] if token[-1] in "?+*" else ""
            level[-1].append((token.removesuffix(mark) if mark else token, mark))
    return level[0]


def slots(terms: list[Term] | tuple, path: tuple[str, ...] = ()) -> Iterator[str]:
    """The paths of all slots of an expression."""
    for content, _ in terms:
        if isinstance(content, str):
            if content.startswith("<"):
                path = (*path, content[1:])
            elif content == "#":
                yield "/".join(path)
        else:
            yield from slots(content, path)


def content_paths(expression: str) -> list[str]:
    """The paths of the slots that are no boilerplate."""
    return [p for p in dict.fromkeys(slots(parse(expression))) if not any(n[:1] == "b" for n in p.split("/"))]


def article(texts: list[tuple[str, str]], paths: frozenset[str]) -> list[str]:
    """The blocks of a page's article, of its (path, text) blocks at the content slots `paths`."""
    clean = [(p, p.split("/"), t) for p, t in texts if p in paths]
    main = [any(n[:1] == "m" for n in nodes) for _, nodes, _ in clean]
    if not any(main):
        return [t for _, _, t in clean]
    is_heading = [any(n[1:].split(".")[0] in HEADINGS for n in nodes) for _, nodes, _ in clean]
    keep = list(main)
    top = next((i for i, (_, nodes, _) in enumerate(clean) if any(n[1:].split(".")[0] == "h1" for n in nodes)), None)
    if top is not None and not main[top]:
        keep[top] = True
        nodes = clean[top][1]
        for depth in range(len(nodes) - 1, 0, -1):  # the smallest element around the headline that holds more than headings
            around = [i for i, (_, other, _) in enumerate(clean) if other[:depth] == nodes[:depth]]
            if not all(is_heading[i] for i in around):
                if not any(main[i] for i in around):
                    keep = [k or i in around for i, k in enumerate(keep)]
                break
    return [t for (_, _, t), k in zip(clean, keep) if k]


def safe(stream: list[str]) -> list[str]:
    """Tokens without the characters that the expression's own syntax uses."""
    return [t if t == "#" else re.sub(r"[\s()?+*<#]", "_", t) for t in stream]


# ---------------------------------------------------------------- jobs


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def _aligned(streams: list[str]) -> str:
    terms: list[Term] = []
    for i, s in enumerate(streams):
        terms = parse(s) if i == 0 else align(terms, parse(s))
    return show(terms)


def wrappers(pages: DataFrame, chunk: int = 64) -> DataFrame:
    """(host, expression) from (host, expression, n): aligned by chunks until one expression is left for each host."""

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(["n", "expression"], ascending=[False, True])
        return pd.DataFrame({"host": [group["host"].iloc[0]], "expression": [_aligned(ordered["expression"].tolist())], "n": [int(group["n"].sum())]})

    now = store(pages)
    while True:
        sizes = now.groupBy("host").agg(F.count("*").alias("streams"))
        most = sizes.agg(F.max("streams")).first()[0] or 0
        if most <= 1:
            return now.select("host", "expression")
        salted = now.join(sizes, "host").withColumn("salt", F.pmod(F.xxhash64("expression"), F.ceil(F.col("streams") / chunk).cast("int")))
        now = store(salted.groupBy("host", "salt").applyInPandas(merged, "host string, expression string, n long"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: the article of every page, whole."""
    keyed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))

    def streams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shown = [show(nested(safe(blocks(page)[0]))) for page in batch["html"]]
            yield pd.DataFrame({"host": batch["host"], "expression": shown})

    parsed = keyed.select("host", "html").mapInPandas(streams, "host string, expression string")
    found = wrappers(parsed.groupBy("host", "expression").agg(F.count("*").alias("n")))
    rules = store(found)

    def texts_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, frozenset[str]] = {}
        for batch in batches:
            out = []
            for page, expression in zip(batch["html"], batch["expression"]):
                if expression not in known:
                    if len(known) > 5000:
                        known.clear()
                    known[expression] = frozenset(content_paths(expression or ""))
                found = [("/".join(safe(p.split("/"))), t) for p, t in blocks(page)[1]]
                kept = article(found, known[expression])
                out.append("\n".join(kept))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": out})

    shaped = looked_up(keyed, rules, "host", "html", wide="expression").select("page_id", "url", "html", "expression")
    made = shaped.mapInPandas(texts_of, "page_id long, url string, text string")
    return made.withColumn("n_chars", F.length("text").cast("long"))
