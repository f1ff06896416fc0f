"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: kinds of elements ---
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style template head title option textarea".split())
CONTROLS = {"button", "select"}  # their text goes once their own end tag comes
CLOSABLE = SILENT | CONTROLS | set("noscript iframe svg math canvas object audio video".split())  # by <x/>
RAW = ("script", "style", "textarea", "title", "template")
MATH = set("mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder "
           "mover munderover mmultiscripts mprescripts mtable mtr mtd menclose maction semantics annotation annotation-xml".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp "
             "small span strike strong sub sup time tt u var wbr br math".split()) | MATH
CLOSED_BY = {  # an open element that the start of another one ends
    "p": set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
             "main nav ol p pre section table ul".split()),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "option": {"option", "optgroup"},
}
CLOSED_BY["option"] |= CLOSED_BY["p"]
IN_HEAD = set("base basefont bgsound head html link meta noframes noscript script style template title".split())
# --- end of fixed values ---

SAMPLE_PAGES = 240  # pages of the input that teach, about; the bound of what reaches the driver
SAMPLE_BYTES = 65_536  # longer pages do not teach
EPOCHS, RATE, DECAY = 25, 0.3, 1e-4
STATES = 2  # 0 other, 1 main text

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW_END = {t: re.compile(rf"</{t}\s*[^>]*(?:>|\Z)", re.I) for t in RAW}
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]  # open elements: tag, words of class, id and role
    link_chars: int


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks of a page in order: runs of text between starts and ends of block elements.

    Character references are decoded, white space becomes one space, empty
    blocks go.  Scripts, styles, templates, comments, the head and form controls
    give none; formulas, drawings and fallback text do.  Start and end tags may
    be missing or misplaced: a head ends where its own text or an element starts
    that cannot stand in it, and a button or list without an end silences nothing.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    controls: list[tuple[int, int]] = []  # open ones: place in the stack, blocks before
    endless: set[str] = set()  # raw elements without an end in what is left
    links = silent = inside_link = math_end = 0

    def flush() -> None:
        nonlocal links
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            if text:
                path = tuple(e for e in stack if e[0] not in INLINE)
                out.append(Block(text, path, links))
            held.clear()
        links = 0

    def close(upto: int) -> None:
        nonlocal silent, inside_link
        while controls and controls[-1][0] >= upto:
            controls.pop()
        while len(stack) > upto:
            tag, _ = stack.pop()
            silent -= tag in SILENT
            inside_link -= tag == "a"

    def leave_head() -> None:
        for i, (open_, _) in enumerate(stack):
            if open_ == "head":
                close(i)
                break

    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if silent and stack[-1][0] in ("head", "noscript") and not page[at:end].isspace() and end > at:
            leave_head()
        if end > at and not silent:
            piece = page[at:end]
            held.append(piece)
            if inside_link:
                links += len(piece)
        if m is None:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag not in INLINE:
                flush()
            elif tag in MATH:
                math_end = at
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if tag in CONTROLS:
                        del out[next(n for at_, n in controls if at_ == i):]
                    close(i)
                    break
                if tag in INLINE and stack[i][0] not in INLINE:
                    break  # an inline end does not close blocks
            continue
        if silent and tag not in IN_HEAD:
            leave_head()
        if tag == "br" or (tag in MATH and math_end == m.start()):
            held.append(" ")
        if tag not in INLINE:
            flush()
            if tag in CONTROLS:  # none stands inside another of its kind
                close(next((i for i, e in enumerate(stack) if e[0] == tag), len(stack)))
            while stack and tag in CLOSED_BY.get(_block_top(stack), ()):
                top = _block_top(stack)
                close(max(i for i, e in enumerate(stack) if e[0] == top))
        if tag in VOID or (m[3].endswith("/") and (
                tag in CLOSABLE or tag in MATH or any(t == "svg" for t, _ in stack))):
            continue
        if tag in _RAW_END:
            done = None if tag in endless else _RAW_END[tag].search(page, at)
            if done:
                at = done.end()
            elif tag in ("title", "textarea"):
                endless.add(tag)  # what follows is not known to be its own
            else:
                break
            continue
        if tag in CONTROLS:
            controls.append((len(stack), len(out)))
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(m[3])) if m[3] else ""
        stack.append((tag, tuple(_WORD.findall(names.lower())) if names else ()))
        silent += tag in SILENT
        inside_link += tag == "a"
    flush()
    return out


def _block_top(stack: list) -> str:
    for tag, _ in reversed(stack):
        if tag not in INLINE:
            return tag
    return ""


def features(block: Block) -> list[str]:
    """Ancestor tags with the words of their class, id and role, and what the text looks like."""
    out = ["bias"]
    tags = [t for t, _ in block.path]
    out.append("leaf=" + (tags[-1] if tags else ""))
    for tag, words in block.path:
        if tag not in ("html", "body", "div", "section"):
            out.append("in=" + tag)
        out += ["word=" + w for w in words]
    text = block.text
    n = len(text)
    out.append(f"size={min(6, n.bit_length() // 2)}")
    out.append("links=" + ("none" if not block.link_chars else "some" if 2 * block.link_chars < n else "most"))
    out.append("ends=" + ("stop" if text[-1] in ".!?…" else "other"))
    if "©" in text:
        out.append("copyright")
    return list(dict.fromkeys(out))


# ---------------------------------------------------------------- the model


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Crf:
    """Weights of each feature for the two states, and of the step from state to state."""

    names: dict[str, int]
    weights: np.ndarray
    steps: np.ndarray

    def emissions(self, blocks: list[Block]) -> np.ndarray:
        get, w = self.names.get, self.weights
        out = np.zeros((len(blocks), STATES))
        for i, b in enumerate(blocks):
            at = [k for f in features(b) if (k := get(f)) is not None]
            out[i] = w[at].sum(0)
        return out

    def decode(self, blocks: list[Block]) -> list[int]:
        """The best sequence of states, by Viterbi."""
        if not blocks:
            return []
        e = self.emissions(blocks).tolist()
        (s00, s01), (s10, s11) = self.steps.tolist()
        a, b = e[0]
        back = []
        for x, y in e[1:]:
            from0, from1 = (a + s00 >= b + s10), (a + s01 > b + s11)
            back.append((0 if from0 else 1, 0 if from1 else 1))
            a, b = (a + s00 if from0 else b + s10) + x, (a + s01 if from1 else b + s11) + y
        state = int(b > a)
        path = [state]
        for pair in reversed(back):
            state = pair[state]
            path.append(state)
        return path[::-1]


def marginals(e: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of states, and expected numbers of steps, by forward-backward."""
    n = len(e)
    f, b = np.zeros_like(e), np.zeros_like(e)
    f[0] = e[0]
    for i in range(1, n):
        f[i] = e[i] + _logsum(f[i - 1][:, None] + steps, 0)
    for i in range(n - 2, -1, -1):
        b[i] = _logsum(steps + (e[i + 1] + b[i + 1])[None, :], 1)
    z = _logsum(f[-1], 0)
    moves = np.zeros_like(steps)
    if n > 1:
        moves = np.exp(f[:-1, :, None] + steps[None] + (e[1:] + b[1:])[:, None, :] - z).sum(0)
    return np.exp(f + b - z), moves


def train(pages: list[tuple[list[Block], list[int]]], seed: int = 0) -> Crf:
    """Weights of the largest penalised likelihood, by adaptive stochastic gradient."""
    names: dict[str, int] = {}
    seen: dict[str, int] = {}
    coded = []
    for blocks, _ in pages:
        for b in blocks:
            for f in features(b):
                seen[f] = seen.get(f, 0) + 1
    for f, n in sorted(seen.items()):
        if n > 1:
            names[f] = len(names)
    for blocks, states in pages:
        coded.append(([[names[f] for f in features(b) if f in names] for b in blocks], np.array(states)))
    w, steps = np.zeros((len(names), STATES)), np.zeros((STATES, STATES))
    gw, gs = np.full_like(w, 1e-6), np.full_like(steps, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(coded)):
            at, y = coded[k]
            if not at:
                continue
            e = np.array([w[a].sum(0) for a in at])
            p, moves = marginals(e, steps)
            want = np.zeros_like(p)
            want[np.arange(len(y)), y] = 1
            flat = np.concatenate([np.array(a, int) for a in at])
            diff = np.repeat(want - p, [len(a) for a in at], axis=0)
            rows, inverse = np.unique(flat, return_inverse=True)
            grad = np.zeros((len(rows), STATES))
            np.add.at(grad, inverse, diff)
            grad -= DECAY * w[rows]
            gw[rows] += grad ** 2
            w[rows] += RATE * grad / np.sqrt(gw[rows])
            found = np.zeros_like(steps)
            np.add.at(found, (y[:-1], y[1:]), 1)
            step = found - moves - DECAY * steps
            gs += step ** 2
            steps += RATE * step / np.sqrt(gs)
    return Crf(names, w, steps)


# ---------------------------------------------------------------- labelled pages

#: Parts of the labelled pages of our own: where they stand, and whether they are main text.
_PARTS = [
    ("<header class='{k}'>{b}</header>", 0, ("site-header", "masthead", "top", "banner")),
    ("<div id='{k}'>{b}</div>", 0, ("header", "masthead", "logo", "branding", "topbar")),
    ("<nav class='{k}'><ul>{l}</ul></nav>", 0, ("menu", "navbar", "primary", "nav", "main-nav")),
    ("<div class='{k}'><ul>{l}</ul></div>", 0, ("menu", "breadcrumb", "breadcrumbs", "navigation", "pagination", "tags", "share", "social")),
    ("<div class='{k}'>{b}</div>", 0, ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner")),
    ("<div class='{k}'>{b}</div>", 0, ("cookie", "cookie-notice", "consent", "notice", "gdpr", "alert", "popup", "modal", "newsletter", "subscribe", "legal", "disclaimer")),
    ("<aside class='{k}'>{h}{b}<ul>{l}</ul></aside>", 0, ("sidebar", "widget", "related", "right")),
    ("<div id='{k}'>{h}<ul>{l}</ul></div>", 0, ("sidebar", "related", "recommended", "widget", "trending")),
    ("<form class='{k}'><label>{w}</label>{b}<input name='q'></form>", 0, ("search", "login", "signup", "contact")),
    ("<section class='{k}'>{h}{t}</section>", 0, ("comments", "comment-list", "responses", "discussion", "reviews")),
    ("<div id='{k}'>{h}{t}</div>", 0, ("comments", "disqus", "respond", "replies")),
    ("<ol class='{k}'><li class='comment'>{t}</li><li class='comment'>{t}</li></ol>", 0, ("comments", "commentlist")),
    ("<footer class='{k}'>{c}<ul>{l}</ul></footer>", 0, ("site-footer", "footer", "bottom")),
    ("<div id='{k}'>{c}{b}</div>", 0, ("footer", "copyright", "colophon", "bottom")),
    ("<article class='{k}'>{h}{t}</article>", 1, ("post", "article", "story", "entry")),
    ("<main id='{k}'>{h}{t}</main>", 1, ("main", "content", "page")),
    ("<div class='{k}'>{h}{t}</div>", 1, ("content", "article-body", "entry-content", "post-body", "story", "text", "main")),
    ("<article><h1>{w}</h1>{t}<blockquote>{b}</blockquote><ul><li>{w}</li><li>{w}</li></ul>{t}<pre>{w}</pre></article>", 1, ("x",)),
    ("<noscript><div class='{k}'>{b}</div></noscript>", 0, ("noscript", "notice", "warning", "no-js")),
    ("<div class='{k}'><object>{b}</object><iframe>{b}</iframe><svg><text>{w}</text></svg></div>", 0, ("player", "widget", "embed", "ad")),
    ("<article class='{k}'>{h}{t}<noscript>{t}</noscript><object>{t}</object><iframe>{b}</iframe><svg><text>{w}</text></svg>"
     "<canvas>{b}</canvas>{t}</article>", 1, ("post", "article", "story", "entry")),
]
#: Parts that stand inside the main text of such a page and are none.
_NESTED = [i for i, (_, main, _) in enumerate(_PARTS) if not main]


def own_pages(n: int = 160, seed: int = 1) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages made from the parts above, with words of no language.

    Each block's label is that of the part it came from, known by its place.
    """
    rng = np.random.default_rng(seed)
    made = []

    def word() -> str:
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9)))

    def sentence(a: int, b: int) -> str:
        return (" ".join(word() for _ in range(rng.integers(a, b))) + rng.choice([".", ".", "", "!"])).capitalize()

    def fill(k: int) -> str:
        pattern, _, names = _PARTS[k]
        def paragraphs() -> str:
            return "".join(f"<p>{' '.join(sentence(3, 25) for _ in range(rng.integers(1, 5)))}</p>"
                           for _ in range(rng.integers(1, 6)))
        values = {
            "{k}": str(rng.choice(names)), "{b}": f"<p>{sentence(2, 14)}</p>" if rng.random() < 0.5 else sentence(2, 14),
            "{l}": "".join(f"<li><a href='/{word()}'>{sentence(1, 3)}</a></li>" for _ in range(rng.integers(2, 7))),
            "{h}": f"<h{rng.integers(1, 4)}>{sentence(1, 9)}</h1>" if rng.random() < 0.8 else "", "{w}": sentence(1, 5),
            "{c}": f"© {word()} {sentence(1, 8)}",
        }
        for name, value in values.items():
            pattern = pattern.replace(name, value)
        while "{t}" in pattern:
            pattern = pattern.replace("{t}", paragraphs(), 1)
        return pattern

    main = [i for i, (_, m, _) in enumerate(_PARTS) if m]
    for _ in range(n):
        before = rng.choice(_NESTED, rng.integers(1, 5))
        after = rng.choice(_NESTED, rng.integers(1, 5))
        order = [*before, int(rng.choice(main)), *after]
        blocks, states = [], []
        for k in order:
            part = fill(int(k))
            inner = ""
            if _PARTS[k][1] and rng.random() < 0.3:  # something else inside the article
                inner = fill(int(rng.choice(_NESTED)))
            cut = part.rfind("</")
            for b in blocks_of(f"<body><div>{part[:cut]}<hr>{part[cut:]}</div></body>"):
                blocks.append(b)
                states.append(_PARTS[k][1])
            if inner:
                wrapped = f"<body><div>{part[:part.find('>') + 1]}{inner}{part[cut:]}</div></body>"
                for b in blocks_of(wrapped):
                    blocks.append(b)
                    states.append(0)
        made.append((blocks, states))
    return made


_NOT_MAIN = set("nav header footer aside form".split())


def marked_states(blocks: list[Block]) -> list[int] | None:
    """Labels that a page states itself: text in ``article`` or ``main``, outside parts that are never main."""
    tags = [{t for t, _ in b.path} for b in blocks]
    if not any(t & {"article", "main"} for t in tags):
        return None
    return [int(bool(t & {"article", "main"}) and not t & _NOT_MAIN) for t in tags]


def learn(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE_PAGES) -> Crf:
    """Train on our own labelled pages and about ``sample`` pages of the input that mark their text."""
    short = pages.where(F.octet_length(html_col) <= SAMPLE_BYTES).select(F.col(html_col).alias("h"))
    n = short.count()
    labelled = own_pages()
    if n:
        slot = F.pmod(F.xxhash64("h"), F.lit(1 << 30))
        rows = short.where(slot < int(min(1.0, sample / n) * (1 << 30))).limit(2 * sample).collect()
        for page in sorted({r["h"] for r in rows}):
            blocks = blocks_of(page)
            states = marked_states(blocks)
            if states:
                labelled.append((blocks, states))
    return train(labelled)


def main_text(page: str | None, model: Crf) -> str:
    blocks = blocks_of(page or "")
    states = model.decode(blocks)
    if not any(states) and all({t for t, _ in b.path} <= {"html", "body"} for b in blocks):
        states = [1] * len(blocks)  # text without elements has no part that could be anything else
    return "\n".join(b.text for b, s in zip(blocks, states) if s)


def extract(pages: DataFrame, model: Crf, key: str = "page_id", url: str = "url", html_col: str = "html") -> DataFrame:
    """``key, url, text, n_chars``: the main text of every page, from the whole html.

    A null, empty or broken page gives the text its blocks have, if any; keys
    and urls may be null or repeat; an empty table gives an empty result.  The
    broadcast model has as many weights as features of its bounded sample.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def text_of(htmls: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, shared.value) for h in htmls], dtype=object)

    out = pages.select(F.col(key).alias(key), F.col(url).alias(url), text_of(F.col(html_col)).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
