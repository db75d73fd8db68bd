"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks, stretches of text between the boundaries of
block elements. Features of a block are its ancestors' tags, the words in their
class, id and role attributes, and the shape of its text; neighbouring labels
weigh in as transitions. Weights are trained on labelled pages, which this
module composes in many layouts, and a page's labels are decoded by Viterbi.
"""

from __future__ import annotations

import html
import random
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import extended, forgotten, small_batches

# Element names of HTML by their part in the tree. All others stand in a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style".split())
PLAIN = frozenset("textarea title".split())  # what looks like markup in these is text
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
BLOCKS = CLOSES_P | frozenset(
    "html head title body li dt dd tr td th caption colgroup thead tbody tfoot legend select option optgroup textarea frameset noframes listing plaintext xmp".split()
)
MARKED = frozenset("noscript template iframe object video audio canvas".split())  # these stand in a line, and yet say something about what is in them
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("table td th ul ol dl html body select".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)")
_REST_OF_TAG = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_ENDS = re.compile(r"[>\"']")
_CLOSE = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.I) for tag in UNSEEN | PLAIN}
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden|data-main)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_MEMO_BYTES = 4 << 20


@dataclass
class Block:
    """A leaf block: what its ancestors say (features, or their weight), its text, and how much of it is in links."""

    above: tuple[str, ...] | float
    text: str
    linked: int
    gold: int = 0


def element_features(tag: str, rest: str) -> tuple[str, ...]:
    """What an element says about the blocks in it: its tag, and the words of its attributes."""
    found = {f"in {tag}"}
    for name, value in _ATTRIBUTE.findall(rest) if rest.strip() and tag not in MARKED else ():
        name = name.lower()
        if name in ("class", "id", "role"):
            found.update(f"word {w.lower()}" for w in _NAME_WORD.findall(value))
        elif name == "hidden" or name == "aria-hidden" and "true" in value or name == "style" and _HIDDEN.search(value):
            found.add("hidden")
    return tuple(sorted(found))


class _Ends:
    """Where tags end. Most are matched; once one does not end, every place's end is worked out in one pass from behind."""

    def __init__(self, page: str) -> None:
        self.page, self.at, self.ends = page, None, None

    def after(self, begin: int) -> int:
        """The place of the ``>`` that ends a tag whose attributes begin here, or -1."""
        if self.at is None:
            found = _REST_OF_TAG.match(self.page, begin)
            if found:
                return found.end() - 1
            marks = [(m.start(), m[0]) for m in _ENDS.finditer(self.page, begin)]
            self.at, self.ends = array("q", [i for i, _ in marks]), array("q", [-1] * (len(marks) + 1))
            plain = single = double = -1
            for k in range(len(marks) - 1, -1, -1):
                i, mark = marks[k]
                if mark == ">":
                    plain = i
                elif mark == '"':
                    plain, double = double, plain
                else:
                    plain, single = single, plain
                self.ends[k] = plain
        return self.ends[bisect_left(self.at, begin)]


class _Open:
    """The open elements of a page: block elements in a stack, each with the elements of the line in it.

    Counts of what is open answer most questions, so that the work is in
    proportion to the page whatever it nests.
    """

    def __init__(self, weights: dict[str, float] | None, memo: dict) -> None:
        self.get, self.memo = (weights or {}).get, memo
        self.plain = weights is None
        self.stack: list[tuple[str, tuple[str, ...], list[str], dict[str, int], int]] = [("", (), [], {}, 0)]
        self.tags: dict[str, int] = {}
        self.frames: list[dict[str, int]] = [{}]
        self.counts: dict[str, int] = {}
        self.total = 0.0
        self.links = 0

    def features(self, tag: str, rest: str) -> tuple[str, ...]:
        key = (tag, rest)
        found = self.memo.get(key)
        if found is None:
            found = element_features(tag, rest)
            size = self.memo.get(None, 0) + 400 + len(rest) + 100 * len(found)
            if size > _MEMO_BYTES:
                self.memo.clear()
                size = 0
            if len(rest) <= 1000:
                self.memo[key] = found
                self.memo[None] = size
        return found

    def add(self, found: tuple[str, ...]) -> None:
        for f in found:
            n = self.counts.get(f, 0)
            if not n:
                self.total += self.get(f, 0.0)
            self.counts[f] = n + 1

    def drop(self, found: tuple[str, ...]) -> None:
        for f in found:
            n = self.counts[f] - 1
            if n:
                self.counts[f] = n
            else:
                del self.counts[f]
                self.total -= self.get(f, 0.0)

    def above(self) -> tuple[str, ...] | float:
        """What the open elements say: of each tag and word once, and of the nearest two tags."""
        last = self.stack[-1][0]
        near = (f"at {last}", f"at {self.stack[-2][0]}/{last}" if len(self.stack) > 2 else f"at {last}/") if last else ()
        if self.plain:
            return (*sorted(self.counts), *near)
        return self.total + sum(self.get(f, 0.0) for f in near)

    def push(self, tag: str, rest: str) -> None:
        found = self.features(tag, rest)
        gold = 1 if "data-main" in rest else 0 if "data-" in rest else self.stack[-1][4]
        self.stack.append((tag, found, [], {}, gold))
        self.tags[tag] = self.tags.get(tag, 0) + 1
        if tag in SCOPES:
            self.frames.append({})
        self.frames[-1][tag] = self.frames[-1].get(tag, 0) + 1
        self.add(found)

    def pop(self) -> str:
        self.close_line(None)
        tag, found, _, _, _ = self.stack.pop()
        self.tags[tag] -= 1
        self.frames[-1][tag] -= 1
        if tag in SCOPES:
            self.frames.pop()
        self.drop(found)
        return tag

    def push_line(self, tag: str) -> None:
        _, _, line, open_, _ = self.stack[-1]
        line.append(tag)
        open_[tag] = open_.get(tag, 0) + 1
        self.links += tag == "a"
        if tag in MARKED:
            self.add((f"in {tag}",))

    def close_line(self, tag: str | None) -> None:
        """Close a tag of the innermost block's line and all in it; all of the line for None."""
        _, _, line, open_, _ = self.stack[-1]
        if tag is not None and not open_.get(tag):
            return
        while line:
            last = line.pop()
            open_[last] -= 1
            self.links -= last == "a"
            if last in MARKED:
                self.drop((f"in {last}",))
            if last == tag:
                return

    def close(self, tag: str) -> None:
        """Close a block element and all in it, if one of that tag is open."""
        while self.tags.get(tag):
            if self.pop() == tag:
                return

    def make_way(self, tag: str) -> None:
        """Close what a new block element of this tag ends by itself."""
        if tag in CLOSES_P and self.stack[-1][0] == "p":
            self.pop()
        others = SIBLINGS.get(tag, ())
        while any(self.frames[-1].get(x) for x in others):
            while self.pop() not in others:
                pass
            if tag != "tr" or self.stack[-1][0] not in others:
                break


def blocks(page: str | None, weights: dict[str, float] | None = None, memo: dict | None = None) -> list[Block]:
    """The non-empty leaf blocks of a page in order; with ``weights`` their ancestors are summed up by these.

    Broken markup is closed as browsers do, roughly; text outside any element
    counts, and so does a tag that never ends. Only scripts and styles are no
    text. The work grows in proportion to the page's length.
    """
    page = page or ""
    out: list[Block] = []
    tree, ends = _Open(weights, {} if memo is None else memo), _Ends(page)
    parts: list[str] = []
    above: tuple[str, ...] | float = ()
    linked, gold, at, n = 0, 0, 0, len(page)
    bare = False  # no further ">"

    def text(raw: str) -> None:
        nonlocal above, linked, gold
        if "&" in raw:
            raw = html.unescape(raw)
        if not parts:
            if not raw.strip():
                return
            above, gold = tree.above(), tree.stack[-1][4]
        parts.append(raw)
        if tree.links:
            linked += len(raw.strip())

    def flush() -> None:
        nonlocal linked
        found = " ".join("".join(parts).split())
        if found:
            out.append(Block(above, found, min(linked, len(found)), gold))
        parts.clear()
        linked = 0

    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            text(page[at:])
            break
        if begin > at:
            text(page[at:begin])
        at = begin + 1
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), begin):
            end = -1 if bare else page.find(">", begin)
            bare = end < 0
            if bare:
                text("<")
            else:
                at = end + 1
            continue
        found = _TAG.match(page, begin)
        end = ends.after(found.end()) if found else -1
        if end < 0:
            text("<")
            continue
        at, tag, rest = end + 1, found[2].lower(), page[found.end():end]
        if tag in PLAIN and "svg" in tree.stack[-1][3]:
            tag = f"svg-{tag}"
        if tag in BLOCKS:
            flush()
        elif tag == "br" and parts:
            parts.append(" ")
        if found[1]:
            tree.close(tag) if tag in BLOCKS else tree.close_line(tag)
        elif tag in UNSEEN or tag in PLAIN:
            close = _CLOSE[tag].search(page, at)
            if tag in PLAIN:
                tree.push(tag, rest)
                text(page[at:close.start() if close else n])
                flush()
                tree.pop()
            end = page.find(">", close.end()) if close else -1
            at = n if end < 0 else end + 1
        elif tag in VOID:
            pass
        elif tag in BLOCKS:
            tree.make_way(tag)
            tree.push(tag, rest)
        else:
            if tag == "a":
                tree.close_line("a")
            if not rest.endswith("/"):
                tree.push_line(tag)
    flush()
    return out


def text_features(block: Block) -> list[str]:
    n = block.text.count(" ") + 1
    share = block.linked / max(1, len(block.text))
    end = block.text[-1]
    out = [f"words {min(n.bit_length(), 6)}", f"linked {min(3, int(share * 4))}"]
    if end in ".!?…\"»”":
        out.append("sentence")
    if "©" in block.text or "copyright" in block.text.lower():
        out.append("copyright")
    return out


@dataclass
class Model:
    """Weights of features for main text against the rest, transitions [from][to], and the start."""

    weights: dict[str, float]
    moves: tuple[tuple[float, float], tuple[float, float]]
    start: tuple[float, float]
    memo: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}}

    def forget(self) -> None:
        """Drop what was looked up."""
        self.memo = {}

    def emissions(self, found: list[Block]) -> list[float]:
        get, out = self.weights.get, []
        for b in found:
            above = b.above if isinstance(b.above, float) else sum(get(f, 0.0) for f in b.above)
            out.append(above + sum([get(f, 0.0) for f in text_features(b)]) + get("any", 0.0))
        return out

    def decode(self, found: list[Block]) -> list[int]:
        """The best labels of a page's blocks by Viterbi; on a tie the rest, not main text."""
        if not found:
            return []
        (m00, m01), (m10, m11) = self.moves
        e = self.emissions(found)
        zero, one, back = self.start[0], self.start[1] + e[0], []
        for x in e[1:]:
            to0 = (zero + m00, 0) if zero + m00 >= one + m10 else (one + m10, 1)
            to1 = (zero + m01, 0) if zero + m01 >= one + m11 else (one + m11, 1)
            back.append((to0[1], to1[1]))
            zero, one = to0[0], to1[0] + x
        label = int(one > zero)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]

    def main_text(self, page: str | None) -> str:
        """The main text's blocks in order, a line each."""
        found = blocks(page, self.weights, self.memo)
        return "\n".join(b.text for b, y in zip(found, self.decode(found)) if y)


def fit(pages: list[list[Block]], steps: int = 250, rate: float = 0.1, decay: float = 1e-4) -> Model:
    """A model from the blocks of labelled pages, by Adam on the conditional likelihood (forward-backward over all pages at once)."""
    pages = [p for p in pages if p]
    names: dict[str, int] = {}
    flat, starts, where = [], [], []
    for i, page in enumerate(pages):
        for j, b in enumerate(page):
            starts.append(len(flat))
            where.append((i, j))
            flat += [names.setdefault(f, len(names)) for f in ("any", *b.above, *text_features(b))]
    flat, starts = np.array(flat), np.array(starts)
    owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(flat))))
    page_of, at = np.array(where).T
    n, longest = len(pages), max(map(len, pages))
    real = np.zeros((n, longest), bool)
    gold = np.zeros((n, longest), int)
    real[page_of, at] = True
    gold[page_of, at] = [b.gold for p in pages for b in p]
    w, moves, start = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)
    both = real[:, 1:] & real[:, :-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    params = [w, moves, start]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        e = np.zeros((n, longest, 2))
        e[page_of, at, 1] = np.add.reduceat(w[flat], starts)
        fwd, bwd = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        fwd[:, 0] = start + e[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(fwd[:, t - 1, :, None] + moves, axis=1) + e[:, t]
            fwd[:, t] = np.where(real[:, t, None], new, fwd[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(moves[None] + (e[:, t + 1] + bwd[:, t + 1])[:, None, :], axis=2)
            bwd[:, t] = np.where(real[:, t + 1, None], new, 0)
        total = np.logaddexp.reduce(fwd[:, -1], axis=1)
        node = np.exp(fwd + bwd - total[:, None, None])
        pair = np.exp(fwd[:, :-1, :, None] + moves + (e + bwd)[:, 1:, None, :] - total[:, None, None, None])
        miss = node[page_of, at, 1] - gold[page_of, at]
        slopes = [
            np.bincount(flat, weights=miss[owner], minlength=len(w)) / n + decay * w,
            ((pair * both[:, :, None, None]).sum(axis=(0, 1)) - seen) / n + decay * moves,
            (node[:, 0].sum(axis=0) - np.bincount(gold[:, 0], minlength=2)) / n + decay * start,
        ]
        for p, g, a, b in zip(params, slopes, m1, m2):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return Model(
        dict(zip(names, w.tolist())), (tuple(moves[0].tolist()), tuple(moves[1].tolist())), tuple(start.tolist())
    )


# Labelled pages.

# Words that pages use in class and id attributes for their parts.
_BODY = "content post entry story main body text page single".split()
_REST = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topbar links toc skip pagination pager".split(),
    "header": "header masthead banner top logo brand".split(),
    "footer": "footer bottom colophon copyright legal credits imprint".split(),
    "aside": "sidebar widget aside related recommended more popular trending rail teaser tags archive".split(),
    "ad": "ad ads advert advertisement advertising adsense sponsor sponsored promo promotion banner ad-slot".split(),
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay message warning announcement paywall".split(),
    "form": "form search login signup subscribe newsletter contact poll survey".split(),
    "comments": "comments comment respond reply discussion disqus replies thread feedback commentlist".split(),
    "share": "share social follow byline meta author date".split(),
}


def labelled_pages(n: int = 400, seed: int = 5) -> list[str]:
    """Pages in many layouts and of made-up words, in which ``data-main`` marks the elements that hold main text."""
    rng = random.Random(seed)
    pick = rng.choice

    def word() -> str:
        return "".join(pick("bcdfghjklmnprstvwzaeiouéäñü") for _ in range(rng.randint(1, 9)))

    def words(a: int, b: int) -> str:
        mark = pick(["", "", "", "", "", "", "###", "!!", " |", "%%%"])
        return " ".join(word() + mark for _ in range(rng.randint(a, b)))

    def sentences() -> str:
        if rng.random() < 0.12:
            return words(1, 3) + pick(["", "."])
        out = []
        for _ in range(rng.randint(1, 5)):
            s = words(3, 22)
            if rng.random() < 0.08:
                s += f' <a href="/{word()}">{words(1, 3)}</a> {words(1, 4)}'
            if rng.random() < 0.1:
                s = f"<{pick(['b', 'em', 'i', 'span', 'strong'])}>{s}"
            if rng.random() < 0.03:
                s += pick([" <math><mi>{}</mi><mo>=</mo><mn>2</mn></math>", " <svg><text>{}</text></svg>", " <noscript>{}</noscript>", " <object>{}</object>", " <video>{}</video>"]).format(words(1, 3))
            out.append(s.capitalize() + pick([".", ".", ".", "?", "!", ""]))
        return " ".join(out) + pick(["", "", "<br>"])

    def links(a: int, b: int) -> list[str]:
        return [f'<a href="/{word()}">{words(1, 3)}</a>' for _ in range(rng.randint(a, b))]

    def named(tags: list[str], names: list[str], inner: str) -> str:
        tag = pick(tags)
        semantic = tag not in ("div", "section", "p", "span")
        if semantic and rng.random() < 0.6:
            return f"<{tag}>{inner}</{tag}>"
        name = pick(names)
        name = pick([name, f"{name}-{word()}", f"site-{name}", f"{word()}_{name}"])
        return f'<{tag} {pick(["class", "class", "id"])}="{name}">{inner}</{tag}>'

    def rest(kind: str) -> str:
        names = _REST[kind]
        listed = lambda a, b: "<ul>" + "".join(f"<li>{x}</li>" for x in links(a, b)) + "</ul>"
        plain = lambda: pick([words(1, 14) + pick(["", "."]), f"<p>{words(2, 20)}{pick(['', '.'])}</p>"])
        if kind == "nav":
            return named(["nav", "nav", "div", "ul"], names, pick([listed(2, 8), " ".join(links(2, 6))]))
        if kind == "header":
            return named(["header", "header", "div"], names, pick([plain(), f"<h1>{words(1, 3)}</h1>", listed(1, 4), f"<div>{words(1, 4)}</div>" + listed(2, 4)]))
        if kind == "footer":
            return named(["footer", "footer", "div"], names, pick(["&copy; ", "", ""]) + pick([plain(), " &middot; ".join(links(1, 4)), words(1, 4) + " &middot; " + sentences()]))
        if kind == "aside":
            return named(["aside", "aside", "div"], names, pick([f"<h3>{words(1, 3)}</h3>{listed(2, 6)}", plain(), f"<h2>{words(1, 3)}</h2><p>{sentences()}</p>"]))
        if kind == "form":
            body = f"<label>{words(1, 3)}</label><input><button>{words(1, 2)}</button>"
            body += pick(["", "", f"<textarea>{words(1, 9)}</textarea>", f"<select><option>{words(1, 2)}<option>{words(1, 2)}</select>"])
            return pick([f"<form>{plain()}{body}</form>", f"<form><p>{sentences()}</p>{body}</form>", named(["div"], names, plain() + body)])
        if kind == "comments":
            each = lambda: pick(["<p>{}</p>", "<div class=\"comment\"><p>{}</p></div>", "<li>{}</li>", "<article class=\"comment\"><p>{}</p></article>"]).format(sentences())
            return named(["section", "div", "div", "ol"], names, f"<h3>{words(1, 3)}</h3>" + "".join(each() for _ in range(rng.randint(1, 5))))
        if kind == "notice" and rng.random() < 0.2:
            return f"<noscript>{pick([words(2, 12), f'<div>{sentences()}</div>'])}</noscript>"
        if kind == "notice":
            return named(["div", "section", "aside", "dialog"], names, pick([plain(), f"<p>{sentences()}</p><button>{words(1, 2)}</button>"]))
        return named(["div", "div", "aside", "p"], names, pick([plain(), sentences(), listed(1, 3)]))

    def main() -> str:
        parts = []
        if rng.random() < 0.8:
            parts.append(f"<h1 data-main>{words(1, 9)}</h1>")
        for _ in range(rng.randint(0, 9)):
            parts.append(pick([f"<p data-main>{sentences()}</p>"] * 9 + [
                f"<h2 data-main>{words(1, 6)}</h2>", "<ul data-main>" + "".join(f"<li>{sentences()}</li>" for _ in range(rng.randint(1, 4))) + "</ul>",
                f"<blockquote data-main><p>{sentences()}</p></blockquote>", f"<pre data-main>{words(2, 12)}</pre>", f"<div data-main>{sentences()}</div>",
                f"<p data-main>{sentences()}", f"<table data-main><tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr></table>",
                f"<figure data-main><img><figcaption>{sentences()}</figcaption></figure>",
                f"<noscript><p data-main>{sentences()}</p></noscript>",
            ]))
            if rng.random() < 0.25:
                parts.append(rest(pick(["ad", "ad", "aside", "share", "notice", "form", "nav"])))
        if rng.random() < 0.15:
            parts.append(rest(pick(["comments", "share", "footer", "aside"])))
        inner = "".join(parts)
        frame = rng.random()
        if frame < 0.4:
            return f"<article>{inner}</article>"
        if frame < 0.55:
            return f"<main><article>{inner}</article></main>"
        if frame < 0.7:
            return f"<main>{inner}</main>"
        name = pick(_BODY)
        return f'<div {pick(["class", "id"])}="{pick([name, f"{name}-{word()}", f"article-{name}"])}">{inner}</div>'

    pages = []
    for _ in range(n):
        kinds = [k for k in ("header", "nav", "ad", "notice", "form", "share") if rng.random() < 0.5]
        rng.shuffle(kinds)
        after = [k for k in ("comments", "aside", "ad", "share", "form", "footer") if rng.random() < (0.9 if k == "footer" else 0.35)]
        inner = "".join(map(rest, kinds)) + main() + "".join(map(rest, after))
        if rng.random() < 0.3:
            inner = f'<div class="{pick(["wrapper", "container", "page", "site", "layout"])}">{inner}</div>'
        pages.append(f"<!DOCTYPE html><html><head><title>{words(1, 4)}</title></head><body>{inner}</body></html>")
    return pages


@lru_cache(1)
def default_model() -> Model:
    """The model trained on the pages of ``labelled_pages``; always the same."""
    return fit([blocks(p) for p in labelled_pages()])


def extract(df: DataFrame, model: Model | None = None, id_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """(row, text) of every row of ``df``, row being a struct of ``id_cols``: the main text, empty if there is none or html is null.

    Character references are decoded, white space in a block is one space, and
    blocks are joined by a line end. Repeated rows each get a row; other columns
    are ignored; an empty table gives an empty one.
    """
    from pyspark.sql import functions as F

    spark = df.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model or default_model())
    rows = df.select(F.struct(*id_cols).alias("row"), F.col(html_col).alias("html"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.main_text(p.as_py()) for p in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["row", "text"])

    def forgetting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return forgotten(of(batches), lambda: shared.value.forget())

    return rows.mapInArrow(forgetting, extended(rows, "row", "text string"))
