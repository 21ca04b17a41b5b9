"""HTML extraction: a tree-structured graphical model over DOM nodes.

A page becomes a tree of its block elements (and of inline ones with attributes);
scripts, styles, form controls, comments and markup are no part of it;
formulas and the texts inside media elements are. Each
node is content or not. Its own features (tag, words of its attributes, text
length, link density, a few telling words) give a unary potential, each parent and child
share a pairwise one. Sum-product messages, upward then downward, give exact
marginals; text whose nearest node is content with a marginal of one half or more is kept.

The potentials are trained by maximum likelihood on labelled pages.
``labelled_pages`` makes such pages by rule, of many layouts with known labels;
pages labelled by hand can be added.

Text: character references decoded, white space within a block turned into one
space (a line break of the page is white space), trimmed; blocks in page order
joined by a newline. Nothing else is dropped or capped.

Edge cases. A null or empty page has an empty text; a page whose tags are cut
short or unbalanced is read as browsers do, roughly: a paragraph ends where the next
block begins, list items, cells and rows end where the next begins, stray end tags
are ignored, unclosed elements end with the page. Every row gives one result
row. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# Fixed lists: names of elements by the role they play in parsing.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: No tags are read inside these; all but the last have no text of the page.
RAW = frozenset("script style textarea title noscript iframe noembed noframes template xmp".split())
#: Their texts are no part of the page: what a browser needs, and controls of forms.
DROPPED = frozenset("head select button datalist".split())
#: What may stand in a head; any other element, or text, begins the body.
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template".split())
#: Elements that begin and end blocks; all others, unknown ones too, stand within a line.
BLOCKS = frozenset(
    "address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup legend li listing main menu nav ol optgroup option "
    "p plaintext pre search section summary table tbody td tfoot th thead tr ul xmp".split()
)
#: A start tag of the key's group ends an open element of the value, up to a boundary.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul xmp".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": {"tr", "td", "th"}, "tfoot": {"tr", "td", "th", "tbody"}}
BOUNDARY = frozenset("ul ol dl table html body div article section main aside nav header footer form".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)(?:>|\Z)",
    re.DOTALL,
)
ATTR = re.compile(r"([^\s=/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.DOTALL)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Fixed lists: words of class, id and role attributes that speak for or against content; each is a feature.
FOR = "article articlebody content entry main post story text body copy prose page abstract chapter".split()
AGAINST = (
    "ad ads advert advertisement adsense banner breadcrumb breadcrumbs byline comment comments reply replies discussion disqus consent cookie cookies gdpr privacy notice alert message copyright legal disclaimer "
    "footer foot header head masthead nav navbar navigation menu menubar sidebar side aside rail widget form login signup search subscribe newsletter related recommended more promo promoted promotion sponsor sponsored partner share sharing social "
    "popup modal overlay dialog toolbar tags pagination pager skip contentinfo complementary hidden toc author meta infobox feedback rating review reviews hero cta teaser"
).split()
WORD_AT = {w: k for k, w in enumerate([*FOR, *AGAINST])}
TAGS = "article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th tbody thead caption blockquote pre figure figcaption nav header footer aside form fieldset address details summary dialog menu body html span a other".split()
TAG_AT = {t: k for k, t in enumerate(TAGS)}
#: Telling words, and how many words of a node's own text one of them may speak for.
SIGN_WORDS = 60
SIGNS = re.compile(r"©|\bcopyright\b|\bcookies?\b|\ball rights reserved\b|\bnewsletter\b|\bsubscribe\b|\bsponsored\b|\badvertisement\b|\blog ?in\b|\bsign up\b", re.IGNORECASE)
LENGTHS, LINKS = (1, 5, 15, 50), (0.01, 0.35, 0.75)
N_FEATURES = len(TAGS) + len(WORD_AT) + 3 + len(LENGTHS) + 1 + len(LINKS) + 1 + 3


class Page:
    """The tree of a page: parents come before their children, node 0 is the root."""

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.attrs = ["html"], [-1], [""]
        #: In page order: (node, text or None for a block's edge, whether in a link).
        self.runs: list[tuple[int, str | None, bool]] = []
        self._parse(source)

    def _parse(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]  # names and nodes of open elements
        links, at, raw = 0, 0, None
        dropped: list[str] = []  # names of open elements from a dropped one on
        runs = self.runs

        def pop(k: int) -> None:
            while len(stack) > k:
                name, node = stack.pop()
                if name in BLOCKS:
                    runs.append((node, None, False))

        def close(names: set[str] | frozenset[str], stop: frozenset[str]) -> None:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in names:
                    pop(k)
                    return
                if stack[k][0] in stop:
                    return

        while True:
            if raw is not None:
                m = re.compile(rf"</{re.escape(raw)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
                if raw == "xmp" and not dropped:
                    runs += [(stack[-1][1], None, False), (stack[-1][1], source[at : m.start() if m else len(source)], False), (stack[-1][1], None, False)]
                at, raw = (m.end() if m else len(source)), None
            m = TOKEN.search(source, at)
            text = source[at : m.start() if m else len(source)]
            if dropped == ["head"] and text.strip():
                dropped = []
            if text and not dropped:
                runs.append((stack[-1][1], html.unescape(text) if "&" in text else text, links > 0))
            if m is None:
                break
            at = m.end()
            name = m["name"]
            if name is None:
                continue
            name = name.lower()
            if m["end"]:
                if dropped:
                    if name in dropped:
                        while dropped.pop() != name:
                            pass
                        continue
                    if name not in BLOCKS or all(name != open_ for open_, _ in stack):
                        continue
                    dropped = []  # what is around it ends, so it does
                if name == "a":
                    links = max(0, links - 1)
                    if stack[-1][0] == "a":
                        pop(len(stack) - 1)
                elif name not in BLOCKS:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == name:
                            pop(k)
                            break
                        if stack[k][0] in BLOCKS:
                            break
                elif name != "body":
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == name:
                            pop(k)
                            links = 0
                            break
                        # A paragraph's or an item's end doesn't reach out of the box around it.
                        if name in ("p", "li", "td", "tr") and stack[k][0] in BOUNDARY and stack[k][0] != name:
                            break
                continue
            attrs = m["attrs"] or ""
            closed = attrs.rstrip().endswith("/")
            if dropped and (dropped[0] == "head" and name not in IN_HEAD or dropped[0] == "select" and name in ("select", "input", "textarea") or dropped[0] == "button" and name == "button"):
                dropped = []
            if name == "br":
                if not dropped:
                    runs.append((stack[-1][1], " ", False))
                continue
            if name in VOID:
                if name == "hr" and not dropped:
                    close({"p"}, BOUNDARY)
                continue
            if name in RAW:
                if not (closed and name in ("iframe", "template")):
                    raw = name
                if name == "xmp" and not dropped:
                    close({"p"}, BOUNDARY)
                continue
            if dropped or name in DROPPED:
                if not closed:
                    dropped.append(name)
                continue
            if name == "html":
                continue
            if name == "a":
                links += 1
            if name not in BLOCKS:
                if attrs.strip() and ("class" in attrs or "id" in attrs or "role" in attrs or "hidden" in attrs) and not closed and name != "a":
                    stack.append((name, self._node(name, attrs, stack[-1][1])))
                continue
            if name in ENDS_P:
                close({"p"}, BOUNDARY)
            if name in SIBLINGS:
                close(SIBLINGS[name], BOUNDARY if name not in ("tbody", "tfoot", "thead") else frozenset(("table",)))
            links = 0 if name in ENDS_P else links
            node = self._node(name, attrs, stack[-1][1])
            runs.append((node, None, False))
            if not closed:
                stack.append((name, node))
        pop(0)

    def _node(self, name: str, attrs: str, parent: int) -> int:
        self.tags.append(name)
        self.attrs.append(attrs)
        self.parents.append(parent)
        return len(self.tags) - 1

    def features(self) -> list[list[int]]:
        """The numbers of the features that each node has."""
        n = len(self.tags)
        size, linked, signs, own = [0] * n, [0] * n, [0] * n, [0] * n
        for node, text, link in self.runs:
            if text:
                k = len(text.split())
                size[node] += k
                own[node] += k
                linked[node] += k * link
                signs[node] += len(SIGNS.findall(text))
        for k in range(n - 1, 0, -1):
            size[self.parents[k]] += size[k]
            linked[self.parents[k]] += linked[k]
        out = []
        words = len(TAGS)
        rest = words + len(WORD_AT)
        for k in range(n):
            row = [TAG_AT.get(self.tags[k], TAG_AT["other"])]
            has_for = has_against = 0
            if self.attrs[k]:
                found: set[int] = set()
                for a, *values in ATTR.findall(self.attrs[k]):
                    a = a.lower()
                    if a in ("class", "id", "role", "aria-label", "itemprop", "name", "data-role", "data-component"):
                        for p in PART.findall("".join(values)):
                            p = p.lower()
                            if p in WORD_AT:
                                found.add(WORD_AT[p])
                    elif a == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", "".join(values), re.IGNORECASE):
                        found.add(WORD_AT["hidden"])
                if re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", re.sub(r"=\s*(\"[^\"]*\"|'[^']*')", "=", self.attrs[k])):
                    found.add(WORD_AT["hidden"])
                row += [words + f for f in found]
                has_for, has_against = any(f < len(FOR) for f in found), any(f >= len(FOR) for f in found)
            row += [rest + j for j, yes in enumerate((has_for and not has_against, has_against, has_for and has_against)) if yes]
            row.append(rest + 3 + sum(size[k] >= x for x in LENGTHS))
            share = linked[k] / size[k] if size[k] else 0.0
            row.append(rest + 4 + len(LENGTHS) + sum(share >= x for x in LINKS))
            if SIGN_WORDS * signs[k] > own[k]:
                row.append(rest + 5 + len(LENGTHS) + len(LINKS))
            row.append(rest + 6 + len(LENGTHS) + len(LINKS) + (k == 0))
            out.append(row)
        return out

    def blocks(self, kept: list[bool]) -> list[str]:
        """The texts of blocks of kept nodes, in page order."""
        out: list[str] = []
        now: list[str] = []
        for node, text, _ in [*self.runs, (0, None, False)]:
            if text is None:
                if line := " ".join("".join(now).split()):
                    out.append(line)
                now = []
            elif kept[node]:
                now.append(text)
        return out


# ------------------------------------------------------------------- the model


#: Edges are of two kinds by the parent: boxes that say nothing of what they hold, and others.
PLAIN = frozenset("html body div main section center table tbody tr".split())


def edge_kinds(page: Page) -> list[int]:
    """Of the edge above each node (the root's is of no use): 1 below a plain box without attributes, else 0."""
    plain = [t in PLAIN and not a.strip() or t in ("html", "body") for t, a in zip(page.tags, page.attrs, strict=True)]
    return [int(p >= 0 and plain[p]) for p in page.parents]


class Forest:
    """The trees of many pages, for messages level by level."""

    def __init__(self, pages: list[Page]) -> None:
        sizes = [len(p.parents) for p in pages]
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.starts, self.n = starts, int(starts[-1])
        self.parent = np.concatenate([np.array(p.parents) + (s if len(p.parents) else 0) for p, s in zip(pages, starts, strict=False)])
        self.parent[starts[:-1]] = -1
        self.kind = np.concatenate([edge_kinds(p) for p in pages]).astype(np.int64)
        rows = [row for p in pages for row in p.features()]
        self.feature = np.array([f for row in rows for f in row])
        self.owner = np.repeat(np.arange(self.n), [len(row) for row in rows])
        depth: list[int] = []
        for p in self.parent.tolist():
            depth.append(depth[p] + 1 if p >= 0 else 0)
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(np.array(depth)[order])) + 1)

    def odds(self, weights: np.ndarray) -> np.ndarray:
        """Log odds of the nodes by their own features."""
        return np.bincount(self.owner, weights[self.feature], self.n)

    def messages(self, unary: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(content) of each node by sum-product, and of each node with its parent: P of (0, 1), (1, 0), (1, 1).

        edge: for either kind, log potentials of (parent, child) = (0, 1), (1, 0), (1, 1); (0, 0) has 0.
        """
        w01, w10, w11 = np.exp(edge).reshape(2, 3)[self.kind].T
        odds = lambda x: np.exp(np.clip(x, -40, 40))
        below, message = unary.copy(), np.zeros(self.n)  # of a node by all at or below it; to its parent
        for level in self.levels[:0:-1]:
            b = odds(below[level])
            message[level] = np.log((w10[level] + w11[level] * b) / (1 + w01[level] * b))
            below += np.bincount(self.parent[level], message[level], self.n)
        total, pairs = below.copy(), np.zeros((self.n, 3))
        for level in self.levels[1:]:
            # The parent without this child's own message, then down the edge.
            r, b = odds(total[self.parent[level]] - message[level]), odds(below[level])
            total[level] = below[level] + np.log((w01[level] + w11[level] * r) / (1 + w10[level] * r))
            joint = np.stack([w01[level] * b, w10[level] * r, w11[level] * r * b], 1)
            pairs[level] = joint / (1 + joint.sum(1, keepdims=True))
        return 1 / (1 + np.exp(-np.clip(total, -40, 40))), pairs


def train(pages: list[tuple[Page, list[int]]], ridge: float = 0.5, steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights and edge potentials of maximum likelihood, from pages and the labels of their nodes."""
    forest = Forest([p for p, _ in pages])
    y = np.concatenate([labels for _, labels in pages]).astype(float)
    child = np.flatnonzero(forest.parent >= 0)
    above = y[forest.parent[child]]
    seen = np.zeros((forest.n, 3))
    seen[child] = np.stack([(1 - above) * y[child], above * (1 - y[child]), above * y[child]], 1)
    beta = np.zeros(N_FEATURES + 6)
    first, second = np.zeros_like(beta), np.zeros_like(beta)
    for step in range(1, steps + 1):
        p, pairs = forest.messages(forest.odds(beta[:N_FEATURES]), beta[N_FEATURES:])
        slope = np.empty_like(beta)
        slope[:N_FEATURES] = np.bincount(forest.feature, (y - p)[forest.owner], N_FEATURES)
        for kind in (0, 1):
            slope[N_FEATURES + 3 * kind : N_FEATURES + 3 * kind + 3] = (seen - pairs)[child][forest.kind[child] == kind].sum(0)
        slope -= ridge * beta
        # Steps sized by the slopes so far, smaller towards the end.
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        beta += 0.15 * (1 - step / (steps + 1)) * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return beta[:N_FEATURES], beta[N_FEATURES:]


# --------------------------------------------------------------- labelled pages

#: Fixed: words for made-up texts.
FILLER = "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so der die und das ist nicht von mit le la les des est une dans pour que el los las una por con para como river stone history theory method result village engine garden winter market letter signal figure".split()


def labelled_pages(n: int = 300, seed: int = 7) -> list[tuple[str, list[int]]]:
    """Made-up pages: (html, labels of the nodes of its ``Page``, by a marker in the source that the labels replace)."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        source = _layout(rng)
        marked = Page(source)
        labels = []
        for k, attrs in enumerate(marked.attrs):
            m = re.search(r"data-y=(\d)", attrs)
            labels.append(int(m[1]) if m else labels[marked.parents[k]] if k else 0)
        out.append((re.sub(r" data-y=\d", "", source), labels))
    return out


def _layout(rng: random.Random) -> str:
    words = lambda a, b: " ".join(rng.choice(FILLER) for _ in range(rng.randint(a, b)))
    sentence = lambda a, b: words(a, b).capitalize() + "."
    links = lambda n: "".join(f'<li><a href="/{rng.randint(1, 999)}">{words(1, 3)}</a></li>' for _ in range(n))
    pick = rng.choice

    def attr(*names: str) -> str:
        name = pick(names)
        return pick((f' class="{name}"', f' id="{name}"', f' class="{name} x{rng.randint(1, 9)}"', f' class="c-{name}"'))

    def paragraph() -> str:
        inner = " ".join(sentence(3, 25) for _ in range(rng.randint(1, 5))) if rng.random() < 0.75 else sentence(1, 6)
        if rng.random() < 0.3:
            inner += f' <a href="/x">{words(1, 4)}</a> <b>{words(1, 3)}</b> {sentence(2, 9)}'
        end = pick(("</p>", "</p>", "<br>", ""))
        return f"<p{pick(('', '', '', attr('lead', 'text', 'intro')))}>{inner}{end}"

    def content() -> str:
        parts = [f"<h1>{words(3, 9)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(pick((rng.randint(1, 9), rng.randint(1, 9), rng.randint(10, 70)))):
            r = rng.random()
            if r < 0.66:
                parts.append(paragraph())
            elif r < 0.74:
                parts.append(f"<h{pick('23456')}>{words(1, 6)}</h{2}>")
            elif r < 0.80:
                parts.append(f"<{(t := pick(('ul', 'ol')))}>" + "".join(f"<li>{sentence(2, 14)}</li>" for _ in range(rng.randint(2, 6))) + f"</{t}>")
            elif r < 0.84:
                parts.append(f"<blockquote><p>{sentence(5, 25)}</p></blockquote>")
            elif r < 0.87:
                parts.append(f"<pre>{words(4, 20)}</pre>")
            elif r < 0.91:
                parts.append("<table>" + "".join(f"<tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr>" for _ in range(rng.randint(1, 4))) + "</table>")
            elif r < 0.94:
                parts.append(f'<figure><img src="a.png"><figcaption>{sentence(3, 12)}</figcaption></figure>')
            else:
                parts.append(f"<div>{paragraph()}</div><p>{words(1, 4)}.</p>")
            if rng.random() < 0.05:
                parts.append(noise())
        return "".join(parts)

    def noise() -> str:
        """What is no content, anywhere on the page."""
        kind = rng.randint(0, 11)
        tag = pick(("div", "div", "section", "aside"))
        if kind == 0:
            return f"<nav data-y=0><ul>{links(rng.randint(2, 8))}</ul></nav>"
        if kind == 1:
            return f"<{tag}{attr('menu', 'navbar', 'nav', 'breadcrumb', 'toc', 'tags', 'pagination')} data-y=0><ul>{links(rng.randint(2, 8))}</ul></{tag}>"
        if kind == 2:
            return f"<{tag}{attr('ad', 'ads', 'advert', 'banner', 'sponsor', 'promo', 'advertisement', 'sponsored')} data-y=0>{pick((sentence(3, 20), paragraph(), f'<p>{sentence(3, 20)}</p>'))}</{tag}>"
        if kind == 3:
            return f"<{tag}{attr('sidebar', 'side', 'widget', 'related', 'rail', 'recommended', 'more')} data-y=0><h3>{words(1, 3)}</h3>{pick((paragraph(), f'<ul>{links(4)}</ul>', f'<p>{sentence(4, 30)}</p>'))}</{tag}>"
        if kind == 4:
            return f"<aside data-y=0>{pick((paragraph(), sentence(4, 30), f'<ul>{links(4)}</ul>', f'<h4>{words(1, 4)}</h4><p>{sentence(5, 20)}</p>'))}</aside>"
        if kind == 5:
            return f"<{tag}{attr('cookie', 'notice', 'consent', 'gdpr', 'alert', 'message', 'disclaimer', 'privacy', 'popup', 'modal')} data-y=0>{pick(('', '<p>'))}We use cookies. {sentence(3, 20)} <button>OK</button></{tag}>"
        if kind in (6, 7):
            body = "".join(f"<{(t := pick(('div', 'li', 'article', 'section')))}{attr('comment', 'reply', 'comment-body')}><{(u := pick(('p', 'div', 'span')))}>{' '.join(sentence(3, 25) for _ in range(rng.randint(1, 4)))}</{u}></{t}>" for _ in range(rng.randint(1, 5)))
            return f"<{tag}{attr('comments', 'discussion', 'replies', 'disqus', 'reader-comments', 'comment-list')} data-y=0>{pick(('', f'<h3>{words(1, 2)}</h3>'))}{body}</{tag}>"
        if kind == 8:
            return f'<form action="/s" data-y=0><label>{words(1, 3)}</label> <input name="q"> <p>{sentence(2, 14)}</p><button>{words(1, 1)}</button></form>'
        if kind == 9:
            return f"<{tag}{attr('share', 'social', 'newsletter', 'subscribe', 'login', 'search', 'author', 'feedback')} data-y=0><p>{sentence(2, 14)}</p>{pick(('', f'<ul>{links(3)}</ul>'))}</{tag}>"
        if kind == 10:
            return f'<div{pick((" hidden", chr(32) + "style=" + chr(34) + "display:none" + chr(34)))} data-y=0><p>{sentence(4, 20)}</p></div>'
        return f"<!-- {words(2, 6)} --><script>var x = '</p>';</script><noscript>{words(3, 9)}</noscript>"

    tops = [noise() for _ in range(rng.randint(0, 3))]
    if rng.random() < 0.7:
        tops.insert(0, f"<{(h := pick(('header', 'header', 'div' + attr('header', 'masthead', 'head'))))} data-y=0>{pick(('', f'<h2>{words(1, 4)}</h2>'))}<p>{words(2, 9)}</p></{h.split()[0]}>")
    if rng.random() < 0.7:
        tops.append(f"<nav data-y=0><ul>{links(rng.randint(3, 9))}</ul></nav>")
    ends = [noise() for _ in range(rng.randint(0, 3))]
    if rng.random() < 0.8:
        ends.append(f"<{(h := pick(('footer', 'footer', 'div' + attr('footer', 'foot', 'legal', 'copyright'))))} data-y=0>{pick(('', '<p>'))}&copy; {words(2, 20)}{pick(('', f'<ul>{links(3)}</ul>'))}</{h.split()[0]}>")
    box = pick(("article", "article", "article", "main", "div" + attr("content", "post", "entry", "article", "main", "story", "article-body"), "section" + attr("content", "article", "story"), "div", "none"))
    inner = content()
    middle = inner.replace("<h1>", "<h1 data-y=1>") if box == "none" else f"<{box} data-y=1>{inner}</{box.split()[0]}>"
    if box == "none":
        middle = re.sub(r"<(p|h\d|ul|ol|blockquote|pre|table|figure|div)(?=[ >])(?![^>]*data-y)", r"<\1 data-y=1", inner)
        # Blocks of noise inside keep their own mark, all inside them too.
        middle = re.sub(r"(<(?:nav|form|aside|div|section)[^>]* data-y=0>.*?</(?:nav|form|aside|div|section)>)", lambda m: m[1].replace(" data-y=1", ""), middle, flags=re.DOTALL)
    if rng.random() < 0.3:
        middle = f"<div{pick(('', attr('container', 'wrapper', 'page')))} data-y=0>{middle}{noise()}</div>"
    elif rng.random() < 0.2:
        middle = f"<main data-y=0>{middle}</main>" if not middle.startswith("<main") else middle
    head = f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><style>p{{margin:0}}</style></head><body data-y=0>"
    return head + "".join(tops) + middle + "".join(ends) + pick(("</body></html>", "</body></html>", ""))


def default_model() -> tuple[np.ndarray, np.ndarray]:
    """Potentials trained on the made-up pages; the same at every call."""
    return train([(Page(source), labels) for source, labels in labelled_pages()])


def main_texts(sources: list[str | None], model: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """The main texts of pages."""
    if not sources:
        return []
    pages = [Page(s or "") for s in sources]
    forest = Forest(pages)
    kept = (forest.messages(forest.odds(model[0]), model[1])[0] >= 0.5).tolist()
    return ["\n".join(p.blocks(kept[a:b])) for p, a, b in zip(pages, forest.starts[:-1].tolist(), forest.starts[1:].tolist(), strict=True)]


def extract(pages: DataFrame, model: tuple[np.ndarray, np.ndarray] | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars. No shuffle."""
    small_batches(pages.sparkSession)
    potentials = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = main_texts(batch.column(2).to_pylist(), potentials)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
