"""Operator 13 - main text of web pages by a linear-chain conditional random
field over DOM leaf blocks.

* Blocks. A page is read once, front to back, with a stack of open elements
  (implied end tags as in HTML: a paragraph ends where a block starts, a list
  item at the next one, and so on). Text between two block boundaries, ``br``
  among them, is a leaf block; scripts, styles, templates, the title, comments
  and other markup make none. Reading is linear in the page's length.
* Features of a block: its own tag, the regions it lies in (any depth), the
  innermost one and the one around it, class, id and role words of the
  ``NEAR`` innermost elements, length, share of link text, punctuation, signs
  of a notice, and tag and length of its neighbours.
* Model. Two labels, main text or not, with learned start and transition
  weights; trained by forward-backward (maximum likelihood, Adagrad) at the
  driver on ``PAGES`` labelled pages; decoded by Viterbi, all pages of a slice
  together.
* Labelled pages. The tables hold no labels for pages. ``labelled_page`` makes
  them: pages of many layouts (elements, class names, tables, bare bodies) with
  menus, headers, notices, adverts, side bars, forms, related links, comments
  and footers before, after and inside the article, in invented words; each
  piece of text is labelled as it is made. The number is a parameter.

Work is one pass over the pages, with no shuffle; a task holds a slice of about
half a MB of pages, or one page.

Defined results: null or empty html, and pages without main text, give an
empty text; character references are decoded, white space (as Python's
``str.split`` sees it) inside a block becomes one space; an unclosed comment,
script or tag reaches to the end, a tag with an unclosed quote to its ``>``; repeated rows are extracted each; an empty
table gives an empty result; other columns stay in ``extract``.
"""

from __future__ import annotations

import html as _html
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast.llm import common as C

PAGES = 1000  # labelled pages that the model is trained on
EPOCHS = 60
NEAR = 12  # innermost elements whose class words are features
BINS = 1 << 14

_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav noscript ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("iframe noembed noframes script style template textarea title".split())
_REGION = frozenset(
    "address article aside blockquote button details dialog dl fieldset figure footer form header li main menu nav noscript ol pre search section select table td ul".split()
)
#: start tag -> (elements that it ends, elements that hide them)
_P = (("p",), ("button", "caption", "table", "td", "th"))
_ENDS = {t: _P for t in _BLOCK - {"body", "button", "caption", "head", "html", "legend", "noscript", "optgroup", "option", "select", "summary", "tbody", "td", "tfoot", "th", "thead", "tr"}}
_LIST = (("li",), ("article", "aside", "main", "menu", "nav", "ol", "section", "table", "td", "ul"))
_MORE = {
    "li": _LIST,
    "dd": (("dd", "dt"), ("dl",)),
    "dt": (("dd", "dt"), ("dl",)),
    "td": (("td", "th"), ("table",)),
    "th": (("td", "th"), ("table",)),
    "tr": (("tr",), ("table",)),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
    "thead": (("tbody", "thead", "tfoot"), ("table",)),
    "option": (("option",), ("select",)),
}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_INSIDE = re.compile(r"""(?:[^>"'=]+|=\s*"[^"]*"|=\s*'[^']*'|=|["'])*""")
_NAMED = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in _RAW}


class Block:
    """A leaf block: its text, its own tag and the features of its place."""

    __slots__ = ("text", "tag", "place", "linked")

    def __init__(self, text: str, tag: str, place: list[str], linked: float):
        self.text, self.tag, self.place, self.linked = text, tag, place, linked


class _Stack:
    """Open elements, with the places of each name."""

    def __init__(self):
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.at: dict[str, list[int]] = {}

    def push(self, name: str, words: tuple[str, ...]) -> None:
        self.at.setdefault(name, []).append(len(self.open))
        self.open.append((name, words))

    def cut(self, place: int) -> None:
        while len(self.open) > place:
            self.at[self.open.pop()[0]].pop()

    def last(self, names: tuple[str, ...]) -> int:
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)

    def end(self, rule: tuple[tuple[str, ...], tuple[str, ...]]) -> None:
        place = self.last(rule[0])
        if place > self.last(rule[1]):
            self.cut(place)

    def close(self, name: str) -> None:
        places = self.at.get(name)
        if not places:
            return
        if name not in _BLOCK:  # an inline element does not end the blocks in it
            for i in range(len(self.open) - 1, places[-1], -1):
                if self.open[i][0] in _BLOCK:
                    return
        self.cut(places[-1])

    def place(self) -> tuple[str, list[str]]:
        """(own tag, features of the place)."""
        own = next((n for n, _ in reversed(self.open[-NEAR:]) if n in _BLOCK), "body")
        regions = sorted((self.at[n][-1], n) for n in _REGION if self.at.get(n))
        near = [n for _, n in regions[-2:]]
        out = ["own " + own, "in " + ">".join(near), "inner " + (near[-1] if near else "")]
        out += ["under " + n for _, n in regions]
        words = dict.fromkeys(w for _, ws in self.open[-NEAR:] for w in ws)
        out += ["word " + w for w in words] or ["wordless " + (near[-1] if near else own), "wordless"]
        inner = next((ws for _, ws in reversed(self.open[-NEAR:]) if ws), ())
        out += ["near " + w for w in inner] + ["stem " + w[:4] for w in inner]
        return own, out


def leaf_blocks(page: str) -> list[Block]:
    """The page's leaf blocks, in order."""
    stack, blocks = _Stack(), []
    parts: list[str] = []
    linked = 0
    here: tuple[str, list[str]] | None = None
    links: list[int] = stack.at.setdefault("a", [])

    def flush() -> None:
        nonlocal linked, here
        if here is not None:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, *here, min(1.0, linked / len(text))))
        parts.clear()
        linked, here = 0, None

    pos, size = 0, len(page)
    while pos < size:
        lt = page.find("<", pos)
        chunk = page[pos : lt if lt >= 0 else size]
        if chunk:
            chunk = _html.unescape(chunk) if "&" in chunk else chunk
            if here is None and not chunk.isspace():
                here = stack.place()
            parts.append(chunk)
            if links:
                linked += len(chunk)
        if lt < 0:
            break
        tag = _TAG.match(page, lt)
        if tag is None:
            nxt = page[lt + 1 : lt + 2]
            if nxt and nxt in "!?/":
                if page.startswith("<!--", lt):
                    end = page.find("-->", lt + 2)  # "<!-->" is one, too
                    pos = end + 3 if end >= 0 else size
                else:
                    end = page.find(">", lt)
                    pos = end + 1 if end >= 0 else size
            else:
                if here is None:
                    here = stack.place()
                parts.append("<")
                pos = lt + 1
            continue
        closing, name = tag.group(1), tag.group(2).lower()
        at = tag.end()
        inside = _INSIDE.match(page, at)
        attributes, pos = inside.group(0), inside.end() + 1
        if closing:
            if name in _BLOCK or name == "br":
                flush()
            stack.close(name)
            continue
        if name in _RAW:
            end = _RAW_END[name].search(page, pos)
            pos = end.start() if end else size
            continue
        if name in _BLOCK or name in ("br", "hr"):
            flush()
            if name in _ENDS or name == "hr":
                stack.end(_P)
            if name in _MORE:
                stack.end(_MORE[name])
        if name in _VOID:
            continue
        words: tuple[str, ...] = ()
        if "=" in attributes:
            found = " ".join(a or b or c for a, b, c in _NAMED.findall(attributes))
            words = tuple(dict.fromkeys(w.lower() for w in _WORD.findall(found)))
        stack.push(name, words)
    flush()
    return blocks


_LENGTHS = (2, 3, 5, 9, 17, 41)
_NOTICE = re.compile(r"[©®]")


def _size(block: Block) -> int:
    words = block.text.count(" ") + 1
    return sum(words >= x for x in _LENGTHS)


def features(blocks: list[Block]) -> list[list[int]]:
    """Feature numbers of each block."""
    sizes = [_size(b) for b in blocks]
    shape = [f"{b.tag} {s}" for b, s in zip(blocks, sizes)]
    out = []
    for i, b in enumerate(blocks):
        link = 0 if not b.linked else 1 + int(b.linked > 0.3) + int(b.linked > 0.8)
        names = b.place + [
            "bias",
            f"size {sizes[i]}",
            f"link {link}",
            f"shape {shape[i]} {link}",
            f"end {b.text[-1] in '.!?…:;。！？'}",
            f"commas {min(2, b.text.count(','))}",
            f"sign {_NOTICE.search(b.text) is not None}",
            f"before {shape[i - 1] if i else 'none'}",
            f"after {shape[i + 1] if i + 1 < len(blocks) else 'none'}",
        ]
        out.append([zlib.crc32(n.encode()) & (BINS - 1) for n in names])
    return out


class Chain:
    """Pages of some lengths side by side: blocks of page p are the places
    ``first[p]`` on; at step t the pages longer than t are ``rows[:many[t]]``."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        first = np.cumsum(counts) - counts
        self.rows = np.argsort(-counts, kind="stable")
        self.first = first[self.rows]
        steps = int(counts.max()) if len(counts) else 0
        self.many = np.searchsorted(-counts[self.rows], -np.arange(steps), "left")


class BlockCrf:
    def __init__(self):
        self.weight = np.zeros((BINS, 2))
        self.start = np.zeros(2)
        self.switch = np.zeros((2, 2))

    def emissions(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not len(first):
            return np.zeros((0, 2))
        return np.add.reduceat(self.weight[ids], first, axis=0)

    def marginals(self, e: np.ndarray, chain: Chain) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward-backward: marginals (blocks, labels), expected starts and
        expected label pairs."""
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        for t, m in enumerate(chain.many):
            at = chain.first[:m] + t
            if t == 0:
                alpha[at] = e[at] + self.start
            else:
                before = alpha[at - 1]
                alpha[at] = e[at] + np.logaddexp(before[:, :1] + self.switch[0], before[:, 1:] + self.switch[1])
        pairs = np.zeros((2, 2))
        total = np.zeros(len(chain.rows))
        for t in range(len(chain.many) - 1, -1, -1):
            m = chain.many[t]
            at = chain.first[:m] + t
            more = chain.many[t + 1] if t + 1 < len(chain.many) else 0
            if more:
                a = at[:more]
                nxt = e[a + 1] + beta[a + 1]
                beta[a] = np.logaddexp(self.switch[:, 0] + nxt[:, :1], self.switch[:, 1] + nxt[:, 1:])
            total[more:m] = np.logaddexp(*alpha[at[more:]].T)
            if more:
                joint = alpha[a][:, :, None] + self.switch + nxt[:, None, :] - total[:more, None, None]
                pairs += np.exp(joint).sum(axis=0)
        marginal = np.exp(alpha + beta - np.logaddexp(alpha[:, :1] + beta[:, :1], alpha[:, 1:] + beta[:, 1:]))
        starts = marginal[chain.first[chain.counts[chain.rows] > 0]].sum(axis=0)
        return marginal, starts, pairs

    def viterbi(self, e: np.ndarray, chain: Chain) -> np.ndarray:
        """The best labels; ties go to "not main text"."""
        best, came = np.empty_like(e), np.zeros(e.shape, np.int8)
        for t, m in enumerate(chain.many):
            at = chain.first[:m] + t
            if t == 0:
                best[at] = e[at] + self.start
            else:
                through = best[at - 1][:, :, None] + self.switch
                came[at] = through.argmax(axis=1)
                best[at] = e[at] + through.max(axis=1)
        label = np.zeros(len(e), np.int8)
        for t in range(len(chain.many) - 1, -1, -1):
            m = chain.many[t]
            at = chain.first[:m] + t
            more = chain.many[t + 1] if t + 1 < len(chain.many) else 0
            label[at[more:]] = best[at[more:]].argmax(axis=1)
            label[at[:more]] = came[at[:more] + 1, label[at[:more] + 1]]
        return label


def _flat(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray, Chain]:
    ids = [f for blocks in pages for f in features(blocks)]
    sizes = np.array([len(x) for x in ids], np.int64)
    return np.array([i for x in ids for i in x], np.int64), np.cumsum(sizes) - sizes, Chain(np.array([len(b) for b in pages], np.int64))


# -------------------------------------------------------------- labelled pages

MARK = "\ue000"  # starts each piece of main text in a labelled page

_NAMES = {
    "nav": "nav navbar navigation menu main-menu topnav breadcrumb breadcrumbs site-nav tabs pager pagination toc",
    "header": "header masthead site-header page-header top topbar branding banner",
    "notice": "cookie cookie-banner consent gdpr notice alert announcement popup modal overlay message privacy-notice disclaimer",
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner-ad ad-slot google-ad",
    "side": "sidebar side aside widget widgets rail secondary column-right panel",
    "form": "newsletter subscribe signup login search search-form contact-form survey poll",
    "related": "related related-posts recommended more-stories see-also popular trending read-next tags share share-buttons sharing social social-links",
    "comments": "comments comment-list discussion responses replies disqus respond reader-comments",
    "footer": "footer site-footer page-footer bottom colophon copyright legal credits",
    "main": "content main article post entry entry-content article-body story post-body text page-content body-text",
}
_NAMES = {k: v.split() for k, v in _NAMES.items()}
_ROLE = {"nav": "navigation", "header": "banner", "notice": "dialog", "side": "complementary", "form": "search", "footer": "contentinfo", "main": "main"}
_TAGS = {"nav": "nav", "header": "header", "side": "aside", "form": "form", "footer": "footer", "ad": "aside", "notice": "dialog", "comments": "section", "related": "aside"}


class _Composer:
    """Composes one labelled page."""

    def __init__(self, rng: random.Random):
        self.rng = rng
        self.main = False
        self.semantic = rng.random() < 0.6
        self.loose = rng.random() < 0.3  # end tags of p and li left out
        self.noise = rng.random() < 0.2  # signs between the words

    def words(self, n: int) -> str:
        letters = "etaoinshrdlucmfwypvbgkjq"
        return " ".join("".join(self.rng.choice(letters[: self.rng.randrange(4, 24)]) for _ in range(self.rng.randrange(1, 10))) for _ in range(n))

    def text(self, n: int, end: str = "") -> str:
        out = self.words(n).capitalize()
        if n > 6 and self.rng.random() < 0.6:
            out = out.replace(" ", ", ", 1)
        if self.noise:
            out = " ".join(w + self.rng.choice(["", "", " |", "***", "&amp;&amp;", "%%", " #", " @", "$"]) for w in out.split())
        if self.rng.random() < 0.1:
            out += self.rng.choice([" &amp; ", " &copy; ", " &#39;", " &lt;b&gt;"]) + self.words(1)
        return (MARK if self.main else "") + out + end

    def link(self, n: int) -> str:
        return f'<a href="/{self.words(1)}">{self.text(n)}</a>'

    def tag(self, name: str, inside: str) -> str:
        return f"<{name}>{inside}" + ("" if self.loose and name in ("p", "li") else f"</{name}>")

    def sentences(self, most: int = 6) -> str:
        parts = [self.text(self.rng.randrange(1, 28), ".") for _ in range(self.rng.randrange(1, most))]
        out = " ".join(parts)
        r = self.rng.random()
        if r < 0.15:
            out += " " + self.link(self.rng.randrange(1, 4)) + " " + self.text(5, ".")
        elif r < 0.3:
            out = self.rng.choice(["<b>%s</b>", "<em>%s</em> x", "<span>%s</span>"]) % out
        return out.replace(". ", ".<br>", 1) if self.rng.random() < 0.1 else out

    def around(self, kind: str, inside: str, element: str = "div") -> str:
        """``inside`` in an element that shows what it is by tag, class, id or
        role."""
        rng = self.rng
        name = rng.choice(_NAMES[kind]) + rng.choice(["", "", "", "", "-area", "list", "Box", "_2"])
        shown = rng.random()
        if self.semantic and kind in _TAGS and shown < 0.6:
            extra = f' class="{name}"' if rng.random() < 0.4 else ""
            return f"<{_TAGS[kind]}{extra}>{inside}</{_TAGS[kind]}>"
        if kind in _ROLE and shown > 0.9:
            return f'<{element} role="{_ROLE[kind]}">{inside}</{element}>'
        where = rng.choice(["class", "class", "id"])
        name = name + " " + self.words(1) if where == "class" and rng.random() < 0.15 else name
        more = rng.choice(["", "", " box", " block", " wrap", " container"]) if where == "class" else ""
        inside = f"<div>{inside}</div>" if rng.random() < 0.2 else inside
        return f'<{element} {where}="{name}{more}">{inside}</{element}>'

    def links(self, least: int, most: int, words: int = 3) -> str:
        items = [self.link(self.rng.randrange(1, words + 1)) for _ in range(self.rng.randrange(least, most))]
        r = self.rng.random()
        if r < 0.7:
            return "<ul>" + "".join(self.tag("li", x) for x in items) + "</ul>"
        return " | ".join(items) if r < 0.85 else "".join(f"<div>{x}</div>" for x in items)

    def other(self, kind: str) -> str:
        """Text that is not the article."""
        rng, kept, self.main = self.rng, self.main, False
        some = lambda: rng.choice([self.text(rng.randrange(1, 12), "."), self.tag("p", self.sentences(4))])
        if kind == "nav":
            out = self.around(kind, self.links(2, 12))
        elif kind == "header":
            out = self.around(kind, rng.choice([f"<h1>{self.text(3)}</h1>", f"<h2>{self.link(2)}</h2>", f"<div>{self.text(2)}</div>"]) + rng.choice(["", f"<p>{self.text(7)}</p>", self.links(2, 7)]))
        elif kind in ("notice", "ad"):
            out = self.around(kind, some() + rng.choice(["", "", self.link(2), f"<button>{self.text(2)}</button>", some()]), rng.choice(["div", "div", "section", "p"]) if kind == "ad" else "div")
        elif kind == "side":
            out = self.around(kind, "".join(rng.choice([f"<h3>{self.text(2)}</h3>" + self.links(2, 8, 8), some(), f"<h4>{self.text(3)}</h4>" + some()]) for _ in range(rng.randrange(1, 4))))
        elif kind == "form":
            fields = "".join(rng.choice([f"<label>{self.text(2)} <input name=x></label>", f"<p>{self.text(9)}</p>", f"<select><option>{self.text(1)}<option>{self.text(2)}</select>", f"<h3>{self.text(4)}</h3>"]) for _ in range(rng.randrange(1, 4)))
            form = f"<form action='/x'>{fields}<button>{self.text(1)}</button></form>"
            out = form if rng.random() < 0.5 else self.around(kind, form)
        elif kind == "related":
            out = self.around(kind, f"<h3>{self.text(2)}</h3>" + self.links(2, 7, 10))
        elif kind == "comments":
            element = rng.choice(["article", "li", "div", "div"])
            each = "".join(f'<{element} class="{rng.choice(["comment", "reply", "comment-body", "response"])}"><b>{self.text(2)}</b>{self.tag("p", self.sentences(4))}</{element}>' for _ in range(rng.randrange(1, 6)))
            out = self.around(kind, f"<h3>{self.text(2)}</h3>" + each, rng.choice(["div", "section"]))
        else:
            out = self.around(kind, rng.choice(["&copy; ", "© ", ""]) + self.text(rng.randrange(2, 14), rng.choice(["", "."])) + rng.choice(["", self.links(2, 6), f"<p>{self.text(8)}</p>"]))
        self.main = kept
        return out

    def piece(self) -> str:
        """A piece of the article."""
        rng, r = self.rng, self.rng.random()
        if r < 0.7:
            return self.tag("p", self.sentences())
        if r < 0.78:
            return f"<h{rng.choice('234')}>{self.text(rng.randrange(1, 8))}</h{rng.choice('234')}>"
        if r < 0.84:
            return "<ul>" + "".join(self.tag("li", self.text(rng.randrange(1, 20), ".")) for _ in range(rng.randrange(2, 6))) + "</ul>"
        if r < 0.88:
            return f"<blockquote>{self.tag('p', self.sentences(3))}</blockquote>"
        if r < 0.91:
            return "<table>" + "".join(f"<tr><td>{self.text(1)}<td>{self.text(rng.randrange(1, 5))}</tr>" for _ in range(rng.randrange(1, 4))) + "</table>"
        if r < 0.93:
            return f"<figure><img src=x><figcaption>{self.text(7)}</figcaption></figure>"
        if r < 0.95:
            return f"<pre>{self.text(6)}\n  {self.words(4)}</pre>"
        return f"<div>{self.sentences()}</div>"

    def page(self) -> str:
        rng = self.rng
        self.main = True
        pieces = [self.piece() for _ in range(rng.choice([1, 2, 4, 8, 14, 25]))]
        for kind in ("ad", "form", "related", "side", "notice"):
            if rng.random() < 0.2:
                pieces.insert(rng.randrange(len(pieces) + 1), self.other(kind))
        title = f"<h1>{self.text(rng.randrange(1, 12), rng.choice(['', '', '.']))}</h1>"
        title = f"<header>{title}</header>" if rng.random() < 0.1 else title
        body = (title if rng.random() < 0.8 else "") + "".join(pieces)
        alone = rng.random() < 0.15  # a page with little or nothing around
        if alone and rng.random() < 0.4:
            body = rng.choice([self.sentences(), self.tag("p", self.sentences(3)), self.tag("p", self.text(3, ".")), self.text(rng.randrange(1, 9))])
        r = rng.random()
        if self.semantic and r < 0.7:
            body = rng.choice(["<article>%s</article>", "<article>%s</article>", "<main>%s</main>", "<main><article>%s</article></main>", '<article class="post">%s</article>', "<main><div>%s</div></main>"]) % body
        elif r < 0.9:
            body = self.around("main", body)
        elif r < 0.95:
            body = f"<table><tr><td>{body}</td></tr></table>"
        if not alone and rng.random() < 0.35:
            comments = self.other("comments")
            body = body[: -len("</article>")] + comments + "</article>" if body.endswith("</article>") and rng.random() < 0.3 else body + comments
        if not alone and rng.random() < 0.4:
            # what stands around the article may lie in one element with it
            near = [self.other(k) for k in ("side", "related", "ad", "notice") if rng.random() < 0.3]
            body = rng.choice(near + [""]) + body + "".join(near)
            outer = rng.choice("page wrapper container primary site layout content main row col-8 center inner".split())
            body = f'<div {rng.choice(["class", "id"])}="{outer}">{body}</div>'
        before = [k for k in ("notice", "header", "nav", "ad", "form", "side") if rng.random() < 0.5]
        after = [k for k in ("related", "side", "ad", "form", "nav") if rng.random() < 0.3] + (["footer"] if rng.random() < 0.9 else [])
        if alone:
            before, after = before[: rng.randrange(2)], after[: rng.randrange(2)]
        rng.shuffle(before)
        start, end = ("".join(self.other(k) for k in kinds) for kinds in (before, after))
        self.main = False
        head = f"<!DOCTYPE html><html><head><title>{self.text(4)}</title><style>p{{}}</style><script>var a='</p>';</script></head>"
        close = "</body></html>" if rng.random() < 0.8 else ""
        return f"{head}<body>{start}{body}{end}{close}"


def labelled_page(seed: int) -> str:
    """A page whose pieces of main text each start with ``MARK``."""
    return _Composer(random.Random(seed)).page()


def labelled(page: str) -> tuple[list[Block], list[int]]:
    """Blocks of a labelled page without the marks, and their labels."""
    blocks, labels = [], []
    for b in leaf_blocks(page):
        labels.append(int(MARK in b.text))
        b.text = " ".join(b.text.replace(MARK, "").split())
        blocks.append(b)
    keep = [i for i, b in enumerate(blocks) if b.text]
    return [blocks[i] for i in keep], [labels[i] for i in keep]


def fit(pages: int = PAGES, epochs: int = EPOCHS, seed: int = 0) -> BlockCrf:
    """Train on ``pages`` labelled pages."""
    made = [labelled(labelled_page(seed + i)) for i in range(pages)]
    made = [x for x in made if x[0]]
    ids, first, chain = _flat([b for b, _ in made])
    gold = np.array([y for _, ys in made for y in ys], np.int64)
    counts = chain.counts
    target = np.eye(2)[gold]
    block = np.repeat(np.arange(len(gold)), np.diff(np.append(first, len(ids))))
    begin = np.cumsum(counts) - counts
    inner = np.ones(len(gold), bool)
    inner[begin] = False
    pairs = np.zeros((2, 2))
    at = np.flatnonzero(inner)
    np.add.at(pairs, (gold[at - 1], gold[at]), 1)
    starts = target[begin].sum(axis=0)
    model, rate, squares = BlockCrf(), 0.3, {}
    scale = 1000.0 / len(gold)

    def climb(name: str, g: np.ndarray) -> None:
        value = getattr(model, name)
        g = g * scale - 2e-3 * value
        squares[name] = squares.get(name, 1e-2) + g * g
        value += rate * g / np.sqrt(squares[name])

    for _ in range(epochs):
        marginal, began, moved = model.marginals(model.emissions(ids, first), chain)
        miss = target - marginal
        climb("weight", np.stack([np.bincount(ids, miss[block, y], minlength=BINS) for y in (0, 1)], axis=1))
        climb("start", starts - began)
        climb("switch", pairs - moved)
    return model


# ------------------------------------------------------------------ extraction


def main_texts(pages: list[str | None], model: BlockCrf) -> list[str]:
    """The main text of each page."""
    parsed = [leaf_blocks(p) if p else [] for p in pages]
    ids, first, chain = _flat(parsed)
    label = model.viterbi(model.emissions(ids, first), chain)
    at = np.cumsum(chain.counts) - chain.counts
    return [" ".join(b.text for b, y in zip(blocks, label[lo : lo + len(blocks)].tolist()) if y) for blocks, lo in zip(parsed, at.tolist())]


def extract(pages: DataFrame, model: BlockCrf, html: str = "html", out: str = "main_text") -> DataFrame:
    """``pages`` with the main text in column ``out`` (replaced if there)."""
    sent = pages.sparkSession.sparkContext.broadcast(model)  # 256 KB, whatever the input
    rows = pages.drop(out)
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.StringType())])
    place = rows.columns.index(html)
    rows = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])  # mapInArrow takes no names with dots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in C.text_slices(batches, f"c{place}"):
            texts = main_texts(piece.column(place).to_pylist(), sent.value)
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(texts, pa.string())], schema.names)

    return rows.mapInArrow(run, schema)


def op13_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = C.read(spark, sf_dir, "pages").select("page_id", "url", F.col("html").cast("string").alias("html"))
    found = extract(pages, fit(), out="text")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
