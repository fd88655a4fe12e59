"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the DOM.

A page is parsed into leaf blocks (text between block-level tags) with the tags, classes and ids above each. Two labels,
main text or not, are decoded by Viterbi from ancestor and text features and the label before. The model is trained by
stochastic gradient on the log-likelihood (forward-backward). Pages label themselves where they mark their article with <article> or
<main>; a sample of at most ``TRAIN_PAGES`` such pages (by hash of the id) is fitted. So that pages without such marks are read
too, each is also trained on in variants: its article in a plain container, and sidebars, notices, comments, forms and the like
of other pages' words around and inside it.

Scripts, styles, comments, head, form controls, drawings and frames never give blocks; formulas and what stands in for media are text of their line. Parsing
keeps going on unclosed or misnested tags of any depth: a head ends at the first thing that can't stand in one, a drawing or formula at the first HTML
tag that ends it in browsers, a form control without an end tag at the next block; only script, style, textarea, title, iframe, noscript and template
take the rest with them, as in browsers. An unknown declaration is a comment up to the next ``>``.

Nulls and odd input: a null or empty html, or one without main text, gives the empty string and n_chars 0; a null id or url stays
null; very long pages are read whole; rows that repeat or tie are each extracted; if no page of the table marks its article, a model trained on built-in
pages of the same variants is used; an empty table gives an empty result; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import table

TRAIN_PAGES = 60
#: Longer pages are left out of training (never out of extraction).
TRAIN_CHARS = 100_000
EPOCHS = 6
SEED = 9
N_FEATURES = 1 << 14

INLINE = frozenset("a abbr acronym audio b bdi bdo big br canvas cite code data del dfn em font i img ins kbd label mark object q rp rt ruby s samp small span strike strong sub sup time tt u var video wbr".split())
#: Formulas are part of their line.
MATH = frozenset("math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
INLINE |= MATH
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("script style noscript template svg annotation annotation-xml textarea select option optgroup button iframe head title datalist".split())
#: What may stand in a head; anything else ends it, also where its end tag is left out.
IN_HEAD = frozenset("html head base basefont bgsound link meta title script style noscript noframes template".split())
#: Nothing in these is a tag but their own end.
RAW = frozenset("script style textarea title iframe noscript".split())
#: Form controls. One without an end tag ends at the next block.
CONTROLS = frozenset("select option optgroup datalist button".split())
#: Tags that end an svg or a formula that is still open (fixed by the HTML standard).
BREAK_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var article section main aside".split())
#: An opening tag of the first ends an open one of the second kind.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": set(), "tbody": {"thead", "tbody", "tr"}}
ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Words of class names and ids.
OTHER_WORDS = frozenset("ad ads advert advertisement advertising banner sponsor sponsored promo promotion sidebar side rail widget menu nav navbar navigation breadcrumb breadcrumbs header masthead footer foot copyright comment comments reply replies respond disqus notice notices cookie cookies consent gdpr alert warning popup modal overlay newsletter subscribe subscription signup login register form search share sharing social related recommended more popular trending tags meta byline author pagination pager toolbar disclaimer legal hidden".split())
MAIN_WORDS = frozenset("article content main post entry story body text prose page".split())
_NAME = re.compile(r"[a-z]+|[0-9]+")
_COPY = re.compile(r"©|\(c\)|copyright", re.I)
_SECTION = re.compile(r"<!\[(?:temp|cdata|ignore|include|rcdata)\b", re.I)
#: No character has a number of so many digits, and the standard parser can't read thousands of them.
_LONG_REFERENCE = re.compile(r"&#([0-9]{8,})")


class Block:
    """Text with the block tags, the last two of them, and the names above it."""

    __slots__ = ("text", "tags", "ends", "names", "linked", "hidden")

    def __init__(self, text: str, tags: frozenset, ends: tuple, names: frozenset, linked: float, hidden: bool):
        self.text, self.tags, self.ends, self.names, self.linked, self.hidden = text, tags, ends, names, linked, hidden


_TOP: tuple = ("", frozenset(), False, (), False, False)


_COMMENT_END = re.compile(r"--!?>")


class _Parser(HTMLParser):
    """Every open tag is tracked. Steps don't grow with depth: places by tag find partners, and what stands above is counted."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        #: Of each open tag: itself, its own names, and of it and those above: hidden, last two block tags, no text, in a link.
        self.stack: list[tuple[str, frozenset, bool, tuple, bool, bool]] = []
        self.places: dict[str, list[int]] = {}
        self.counts: dict[str, int] = {}
        #: Open block tags and names, made anew only when one comes or goes.
        self.tags: frozenset | None = frozenset()
        self.names: frozenset | None = frozenset()
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.in_link = 0
        self.sections = True
        self.at = 0
        self.no_end: dict[str, int] = {}

    def updatepos(self, i: int, j: int) -> int:
        self.at = j  # line numbers are not needed
        return j

    def _has_end(self, tag: str) -> bool:
        """Whether an end tag follows before the next tag of the same name opens."""
        if self.at >= self.no_end.get(tag, len(self.rawdata) + 1):
            return False
        end = re.compile(f"</{tag}[\\s/>]", re.I).search(self.rawdata, self.at)
        if not end:
            self.no_end[tag] = self.at
            return False
        return not re.compile(f"<{tag}[\\s/>]", re.I).search(self.rawdata, self.at, end.start())

    def _leave(self, tags: frozenset | set) -> None:
        """Closes the outermost open one of these tags and all in it."""
        self._pop(min(self.places[t][0] for t in tags if t in self.places))

    def parse_html_declaration(self, i: int) -> int:
        return super().parse_html_declaration(i) if not self.rawdata.startswith("<![", i) else self.parse_marked_section(i)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """As browsers do, a comment up to the next >; sections of text that do end with ]]> go up to there."""
        if self.sections and _SECTION.match(self.rawdata, i):
            end = self.rawdata.find("]]>", i)
            if end >= 0:
                return end + 3
            self.sections = False
        return self.parse_bogus_comment(i, report)

    def parse_comment(self, i: int, report: int = 1) -> int:
        """As browsers do: <!--> and <!---> are whole comments, --!> ends one too, and one without an end takes the rest of the page."""
        for short in (">", "->"):
            if self.rawdata.startswith(short, i + 4):
                return i + 4 + len(short)
        end = _COMMENT_END.search(self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                _, _, hidden, ends, _, _ = self.stack[-1] if self.stack else _TOP
                if self.tags is None:
                    self.tags = frozenset(t for t in self.places if t not in INLINE)
                if self.names is None:
                    self.names = frozenset(self.counts)
                self.blocks.append(Block(text, self.tags, ends, self.names, self.in_link / max(1, sum(map(len, self.parts))), hidden))
            self.parts, self.in_link = [], 0

    def _pop(self, to: int) -> None:
        for _ in range(len(self.stack) - to):
            tag, names, *_ = self.stack.pop()
            at = self.places[tag]
            at.pop()
            if not at:
                del self.places[tag]
                self.tags = None
            for x in names:
                self.counts[x] -= 1
                if not self.counts[x]:
                    del self.counts[x]
                    self.names = None

    def _last(self, tags: frozenset | set) -> int:
        return max((self.places[t][-1] for t in tags if t in self.places), default=-1)

    def _close_open(self, tags: frozenset | set, until: frozenset | set = frozenset()) -> None:
        at = self._last(tags)
        if at >= 0 and at >= self._last(until):
            self._pop(at)

    def _raw(self) -> str | None:
        tag = self.stack[-1][0] if self.stack else None
        return tag if tag in RAW and "svg" not in self.places else None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self._raw():
            return
        if tag not in INLINE:
            self._flush()
        elif tag == "br":
            self.parts.append(" ")
        if "head" in self.places and tag not in IN_HEAD:
            self._flush()
            self._leave({"head"})
        if tag in BREAK_OUT and ("svg" in self.places or "math" in self.places) and "foreignobject" not in self.places:
            self._flush() if tag not in INLINE or "svg" in self.places else None
            self._leave({"svg", "math"})
        if tag not in INLINE and tag not in CONTROLS and tag not in VOID and tag != "svg":
            lost = {t for t in CONTROLS if t in self.places and not self._has_end(t)}
            if lost and not any(t in self.places and t not in lost for t in ("select", "datalist", "button")):
                self._leave(lost)
        if tag in ENDS_P:
            self._close_open({"p"}, frozenset(("div", "article", "section", "td", "li", "body", "main", "aside", "blockquote", "button")))
        if tag in IMPLIED:
            self._close_open(IMPLIED[tag], frozenset(("ul", "ol", "dl", "table")))
        if tag in VOID:
            return
        names, hidden = frozenset(), False
        for k, v in attrs:
            if k in ("class", "id", "role") and v:
                names |= frozenset(_NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", v).lower()))
            elif k == "hidden" or (k == "style" and v and "display:none" in v.replace(" ", "").lower()) or (k == "aria-hidden" and v == "true"):
                hidden = True
        _, _, was_hidden, ends, no_text, in_link = self.stack[-1] if self.stack else _TOP
        if tag not in self.places:
            self.places[tag], self.tags = [], None
        self.places[tag].append(len(self.stack))
        for x in names:
            if x not in self.counts:
                self.names = None
            self.counts[x] = self.counts.get(x, 0) + 1
        self.stack.append((tag, names, hidden or was_hidden, ends if tag in INLINE else (*ends[-1:], tag), no_text or tag in NO_TEXT, in_link or tag == "a"))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # browsers read <div/> as <div>

    def handle_endtag(self, tag: str) -> None:
        if self._raw() not in (None, tag):
            return
        if tag not in INLINE:
            self._flush()
        self._close_open({tag})

    def handle_data(self, data: str) -> None:
        top = self.stack[-1] if self.stack else _TOP
        if top[0] == "head" and data.strip():
            self._leave({"head"})
            top = self.stack[-1] if self.stack else _TOP
        if top[4]:
            return
        self.parts.append(data)
        if top[5]:
            self.in_link += len(data)


def _short_reference(m: re.Match) -> str:
    digits = m[1].lstrip("0") or "0"
    return "&#" + (digits if len(digits) < 8 else "9999999")


def blocks(html: str) -> list[Block]:
    parser = _Parser()
    parser.feed(_LONG_REFERENCE.sub(_short_reference, html))
    parser.close()
    parser._flush()
    return parser.blocks


@lru_cache(1 << 16)
def _slot(name: str) -> int:
    """Place of a feature (FNV-1a)."""
    h = 0x811C9DC5
    for c in name.encode():
        h = (h ^ c) * 0x01000193 & 0xFFFFFFFF
    return h % N_FEATURES


@lru_cache(1 << 14)
def _above(tags: frozenset, ends: tuple, names: frozenset, hidden: bool) -> tuple[int, ...]:
    """Places of the features of what stands above a block."""
    out = [f"tag={t}" for t in sorted(tags)] + [f"leaf={ends[-1] if ends else ''}", f"two={'>'.join(ends)}", "bias"]
    out += [f"name={x}" for x in sorted(names)] + ["othername"] * bool(names & OTHER_WORDS) + ["mainname"] * bool(names & MAIN_WORDS) + ["hidden"] * hidden
    return tuple(map(_slot, out))


def features(found: list[Block]) -> list[tuple[int, ...]]:
    """Places of each block's features."""
    out, n = [], len(found)
    for i, b in enumerate(found):
        words, end = b.text.count(" ") + 1, b.text[-1]
        own = (f"words={words if words < 4 else min(7, 2 + words.bit_length())}", f"linked={round(b.linked * 4)}", f"ends={end if end in '.!?:;|' else ''}", f"at={4 * i // n}", "first" if i == 0 else "last" if i == n - 1 else "within", "copy" if b.text[0] in "©(Cc" and _COPY.match(b.text) else "nocopy")
        out.append(_above(b.tags, b.ends, b.names, b.hidden) + tuple(map(_slot, own)))
    return out


class Crf:
    """Two labels; weights[label, feature] and moves[before, label]."""

    def __init__(self):
        self.w, self.t = np.zeros((2, N_FEATURES)), np.zeros((2, 2))
        self.plain: list[list[float]] | None = None  # the weights as lists, for decoding

    def scores(self, feats: list) -> np.ndarray:
        return np.array([self.w[:, f].sum(axis=1) for f in map(list, feats)])

    def fit(self, pages: list[tuple[list[list[int]], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, seed: int = SEED) -> Crf:
        rng, gw, gt = random.Random(seed), np.full((2, N_FEATURES), 1e-6), np.full((2, 2), 1e-6)
        for _ in range(epochs):
            rng.shuffle(pages)
            for feats, labels in pages:
                if not feats:
                    continue
                p, pair = self._marginals(self.scores(feats))
                for i, f in enumerate(map(list, feats)):
                    for y in (0, 1):
                        g = (labels[i] == y) - p[i, y]
                        if abs(g) > 1e-4:
                            gw[y, f] += g * g
                            self.w[y, f] += rate * g / np.sqrt(gw[y, f])
                g = -pair
                for a, b in zip(labels, labels[1:], strict=False):
                    g[a, b] += 1
                gt += g * g
                self.t += rate * g / np.sqrt(gt)
                self.t *= 0.999
        return self

    def _marginals(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(label of block i), and the expected number of each pair of neighbours."""
        n, e = len(s), np.exp(self.t)
        x = np.exp(s - s.max(axis=1, keepdims=True))
        a, b, pair = np.empty((n, 2)), np.ones((n, 2)), np.zeros((2, 2))
        a[0] = x[0] / x[0].sum()
        for i in range(1, n):
            a[i] = (a[i - 1] @ e) * x[i]
            a[i] /= a[i].sum()
        for i in range(n - 2, -1, -1):
            b[i] = e @ (x[i + 1] * b[i + 1])
            b[i] /= b[i].sum()
        p = a * b
        p /= p.sum(axis=1, keepdims=True)
        for i in range(1, n):
            q = a[i - 1][:, None] * e * (x[i] * b[i])[None]
            pair += q / q.sum()
        return p, pair

    def decode(self, feats: list[list[int]]) -> list[int]:
        """The likeliest labels (Viterbi)."""
        if not feats:
            return []
        if self.plain is None:
            self.plain = [self.w[y].tolist() for y in (0, 1)]
        w0, w1 = self.plain
        (t00, t01), (t10, t11) = self.t.tolist()
        back: list[tuple[bool, bool]] = []
        best0 = best1 = 0.0
        for i, f in enumerate(feats):
            s0, s1 = sum([w0[k] for k in f]), sum([w1[k] for k in f])
            if i == 0:
                best0, best1 = s0, s1
                continue
            from0, from1 = best1 + t10 > best0 + t00, best1 + t11 > best0 + t01
            back.append((from0, from1))
            best0, best1 = (best1 + t10 if from0 else best0 + t00) + s0, (best1 + t11 if from1 else best0 + t01) + s1
        out = [int(best1 > best0)]
        for b in reversed(back):
            out.append(int(b[out[-1]]))
        return out[::-1]


_ARTICLE = re.compile(r"<(article|main)\b[^>]*>(.*)</\1\s*>", re.S | re.I)


def _is_main(b: Block) -> bool:
    return bool({"article", "main"} & b.tags) and not {"nav", "aside", "footer", "form"} & b.tags and not b.names & OTHER_WORDS and not b.hidden


def variants(html: str, words: list[str], rng: random.Random) -> list[tuple[list[Block], list[int]]]:
    """The page, and pages made from it with known labels: blocks and their labels."""
    own = blocks(html)
    out = [(own, [int(_is_main(b)) for b in own])]
    m = _ARTICLE.search(html)
    if not m:
        return out
    some = lambda a, b: " ".join(rng.choice(words) for _ in range(rng.randint(a, b)))
    junk = [
        lambda: f'<aside class="{rng.choice(["sidebar", "related", "widget", "side-rail"])}"><h3>{some(1, 3)}</h3><ul>{"".join(f"<li><a href=x>{some(1, 6)}</a></li>" for _ in range(rng.randint(1, 5)))}</ul><p>{some(3, 30)}.</p></aside>',
        lambda: f'<div class="{rng.choice(["notice", "cookie-notice", "alert", "cookie-banner", "newsletter", "disclaimer"])}"><p>{some(3, 25)}.</p></div>',
        lambda: f'<{(t := rng.choice(["section", "div"]))} {rng.choice(["class", "id"])}="{rng.choice(["comments", "comment-list", "user-comments", "replies"])}"><h2>{some(1, 3)}</h2>{"".join(f"<div class=comment><b>{some(1, 2)}</b><p>{some(2, 40)}.</p></div>" for _ in range(rng.randint(1, 4)))}</{t}>',
        lambda: f'<form action="/x"><label>{some(1, 4)}</label><input name=q><p>{some(2, 12)}</p><button>{some(1, 2)}</button></form>',
        lambda: f'<div class="{rng.choice(["ad", "advert", "sponsored", "promo", "ads"])}">{some(2, 20)}.</div>',
        lambda: f'<header>{rng.choice(["", "<div class=logo>"])}<h2>{some(1, 4)}</h2><p>{some(2, 8)}</p></header>',
        lambda: f'<footer><p>{some(2, 14)}</p><p>&copy; {some(1, 4)}</p></footer>',
        lambda: f'<nav class="{rng.choice(["menu", "breadcrumb", "main-nav"])}">{" ".join(f"<a href=x>{some(1, 2)}</a>" for _ in range(rng.randint(2, 7)))}</nav>',
        lambda: f'<div class="{rng.choice(["menu", "breadcrumbs", "share", "tags", "pagination"])}"><ul>{"".join(f"<li><a href=x>{some(1, 2)}</a></li>" for _ in range(rng.randint(2, 7)))}</ul></div>',
    ]
    mark = "\u0001"
    inner = re.sub(r"(<(?:p|h[1-6]|li|blockquote|pre)\b[^>]*>)", rf"\1{mark}", m[2])
    for k in range(4):
        tag, attr = rng.choice([("article", ""), ("main", ""), ("div", ' class="content"'), ("div", ' id="main"'), ("div", ' class="post-body entry"'), ("section", ' class="story"'), ("div", ""), ("div", ' class="article-text"')])
        body = inner
        if k % 2:
            cut = body.find("</p>")
            if cut >= 0:
                body = body[: cut + 4] + rng.choice(junk)() + body[cut + 4 :]
        if rng.random() < 0.4:
            body = rng.choice(["<div>{}</div>", "<section>{}</section>"]).format(body)
        if rng.random() < 0.3:
            body += f"<ul><li>{mark}{some(3, 12)}.</li><li>{mark}{some(3, 12)}</li></ul><blockquote>{mark}{some(4, 20)}.</blockquote><h2>{mark}{some(1, 4)}</h2><p>{mark}{some(1, 2)}.</p>"
        around = [rng.choice(junk)() for _ in range(rng.randint(2, 6))]
        cut = rng.randint(0, len(around))
        page = f"<html><body>{''.join(around[:cut])}<{tag}{attr}>{body}</{tag}>{''.join(around[cut:])}</body></html>"
        found = blocks(page)
        labels = [int(mark in b.text) for b in found]
        for b in found:
            b.text = b.text.replace(mark, "").strip() or "-"
        out.append((found, labels))
    return out


def train(pages: list[str], seed: int = SEED) -> Crf:
    rng, words = random.Random(seed), []
    for html in pages:
        words += [w for b in blocks(html) for w in b.text.split()[:200]]
    words = words or ["word", "text", "page"]
    rows = [v for html in pages for v in variants(html, words, rng)]
    return Crf().fit([(features(b), y) for b, y in rows])


def _built_in(n: int = 40) -> list[str]:
    rng = random.Random(SEED)
    some = lambda a, b: " ".join("".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(a, b)))
    return [f"<html><body><nav><ul><li><a href=x>{some(1, 2)}</a></li></ul></nav><article><h1>{some(2, 8)}</h1>{''.join(f'<p>{some(2, 60)}.</p>' for _ in range(rng.randint(1, 9)))}</article><footer>&copy; {some(2, 6)}</footer></body></html>" for _ in range(n)]


def fit(pages: DataFrame, limit: int = TRAIN_PAGES) -> Crf:
    marked = pages.filter(F.col("html").rlike("(?i)<(article|main)[\\s>]") & (F.length("html") <= TRAIN_CHARS))
    h = F.pmod(F.xxhash64(F.lit(SEED), "page_id"), F.lit(1 << 30))
    # The least hashes of all marked pages: each task holds no more than limit of them.
    some = marked.select("html", h.alias("h")).orderBy("h", "html").limit(limit)
    return train([r["html"] for r in some.collect()] or _built_in())


def main_text(html: str | None, model: Crf) -> str:
    found = blocks(html or "")
    return "\n\n".join(b.text for b, y in zip(found, model.decode(features(found)), strict=True) if y)


def extract(pages: DataFrame, model: Crf, html_col: str = "html") -> DataFrame:
    """pages as ``row`` with text and n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h, shared.value) for h in batch]
            yield pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    told = F.pandas_udf(run, "text string, n_chars long")
    return pages.select(F.struct("*").alias("row")).withColumn("p", told(F.col(f"row.{html_col}"))).select("row", "p.text", "p.n_chars")


def op5(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, fit(pages)).select("row.page_id", "row.url", "text", "n_chars")
