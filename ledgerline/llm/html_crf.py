"""Main text of web pages: a linear-chain conditional random field.

A page is cut into DOM leaf blocks: runs of text between block-level tags, in
page order, each with the elements it stands in. Features of a block are the
tags, class words and ids of its ancestors, its own element, and its text
(length, links, punctuation, place). A chain with the labels "content" and
"other" gives each block a score and each pair of neighbours a transition;
Viterbi finds the best labels, and the content blocks are the text.

Training: labelled pages are made from a sample of at most ``FIT_PAGES`` pages
whose mark-up names the article (``article`` or ``main``): each as it is,
labelled by that mark-up, and its blocks set again in ``LAYOUTS``, page layouts
with other elements and class names around them (menus, sidebars, notices,
forms, comments and so on), where the place in the layout is the label. Weights
maximise the conditional likelihood by gradient steps over forward-backward
sums. This fit alone uses a sample: of a sampled page the first 4 *
``FIT_BLOCKS`` blocks as a chain, and ``FIT_BLOCKS`` texts for the layouts.
Every page is extracted whole.

Defined cases: null and empty html give an empty text. Broken mark-up is read
as browsers do: unclosed elements end with their parents, an unclosed comment
or script swallows the rest, a tag cut off by the end is dropped. ``br`` is
white space. Text inside math, svg, object, canvas, video and audio belongs to
the block around it. Repeated pages give repeated rows; without any page to learn from
the layouts are filled with fixed text. Columns of the input that are named
like a result column give way, others are carried.
"""

from __future__ import annotations

import html as entities
import re
from math import exp, log

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import annotate, prepare

FIT_PAGES = 200
FIT_BLOCKS = 40
ROUNDS = 60
L2 = 0.3

# Kinds of HTML elements.
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search
    section select summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page; that of all others is.
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
#: Elements of other vocabularies, inside which a tag that ends with / has no content.
FOREIGN = frozenset(("svg", "math"))
#: An opening tag also ends the nearest open element of these, unless one of the second kind is in between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
_NO_P = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var "
                  "input img br option optgroup select button object canvas video audio source track param embed svg math".split())

_TOKEN = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(>?)|[^<]++|<""", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_CLASS_WORD = re.compile(r"[A-Za-z][a-z]+|[A-Z]+(?![a-z])")
_END = (".", "!", "?", "…", ":", "。", ".”", ".»", '."')


def _marks(attrs: str) -> tuple[str, ...]:
    out = []
    if attrs and "=" in attrs or "hidden" in attrs:
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
                out.append("hidden")
            elif name != "style":
                out += ["c=" + w.lower() for w in _CLASS_WORD.findall(value)]
    return tuple(out)


def blocks(page: str | None, weight=None, most: int | None = None) -> list[tuple]:
    """(text, features) of the leaf blocks of a page, in page order; blocks
    after the first ``most`` go without the features of their ancestors. With
    ``weight``, the weight of a feature, (text, own features, sum of the
    ancestors' weights): that sum is kept for each open element, so the work
    does not grow with the depth."""
    out: list[tuple] = []
    sums = [0.0]  # weights of the features of all elements up to each depth
    stack: list[tuple[str, tuple[str, ...]]] = []  # open elements with their features
    open_count: dict[str, int] = {}
    open_at: dict[str, list[int]] = {}  # depths of the open elements of each tag
    block_at: list[int] = []  # depths of the open block elements
    parts: list[str] = []
    links = 0  # characters of the current block inside links
    foreign = None  # depth of the outermost open svg or math

    def flush():
        nonlocal links
        if parts:
            raw = "".join(parts)
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                own = stack[block_at[-1]][0] if block_at else "none"
                marks = (f"own={own}", *_text_marks(text, links))
                if weight is not None:
                    out.append((text, marks, sums[-1]))
                else:
                    out.append((text, (*open_count, *marks) if most is None or len(out) < most else marks))
        parts.clear()
        links = 0

    def push(tag, marks):
        nonlocal foreign
        if foreign is None and tag in FOREIGN:
            foreign = len(stack)
        open_at.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            block_at.append(len(stack))
        stack.append((tag, marks))
        total = sums[-1]
        for f in marks:
            if weight is not None and f not in open_count:
                total += weight(f, 0.0)
            open_count[f] = open_count.get(f, 0) + 1
        sums.append(total)

    def pop():
        nonlocal foreign
        tag, marks = stack.pop()
        sums.pop()
        open_at[tag].pop()
        if tag in BLOCK:
            block_at.pop()
        for f in marks:
            open_count[f] -= 1
            if not open_count[f]:
                del open_count[f]
        if foreign is not None and len(stack) <= foreign:
            foreign = None

    def innermost(names):
        return max((open_at[n][-1] for n in names if open_at.get(n)), default=-1)

    def close(names, stops=()):
        """End the nearest open element of ``names``, if none of ``stops`` is nearer."""
        k = innermost(names)
        if k >= 0 and innermost(stops) <= k:
            while len(stack) > k:
                pop()

    page, at = page or "", 0
    while m := _TOKEN.match(page, at):
        at = m.end()
        tag = m[2]
        if tag is None:
            text = m[0]
            if text[:2] not in ("<!", "<?"):
                parts.append(text)
                if "a" in open_count:
                    links += len(text.strip())
            continue
        if not m[4]:  # cut off by the end, or an unclosed quote: take the tag to the next >
            end = page.find(">", m.start())
            if end < 0:
                break
            at = end + 1
        tag = tag.lower()
        if tag in BLOCK:
            flush()
        if tag == "br":
            parts.append(" ")
        elif m[1]:
            close({tag})
        elif tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
        else:
            other = tag in FOREIGN or foreign is not None and tag not in BLOCK
            if tag not in _NO_P and not other:
                close({"p"}, {"td", "th", "button", "div", "section", "article", "li", "table"})
            if tag in ENDS:
                close(*ENDS[tag])
            if tag not in VOID and not (other and m[3].endswith("/")):
                marks = _marks(m[3])
                push(tag, (tag, *marks) if tag in BLOCK or tag == "a" else marks)
    flush()
    return out


def _text_marks(text: str, links: int) -> tuple[str, ...]:
    n = text.count(" ") + 1
    share = links / len(text)
    return (f"words={min(n.bit_length(), 7)}", "links=" + ("0" if not links else "1" if share < 0.3 else "2" if share < 0.8 else "3"),
            "end=" + str(text.endswith(_END)), "sign" if "©" in text or "®" in text or "|" in text else "plain",
            "commas" if text.count(",") * 12 > n else "few", f"words={min(n.bit_length(), 7)}&links={int(share > 0.5)}")


def sequence(found: list[tuple[str, tuple[str, ...]]]) -> list[tuple[str, ...]]:
    """Features of a page's blocks, with their places."""
    n = len(found)
    return [(*f, "bias", "first" if i == 0 else "last" if i == n - 1 else "inner", f"place={4 * i // n}") for i, (_, f) in enumerate(found)]


# ---- training ----

SAMPLE = ["Rain fell on the harbour all night, and by morning the boats were full of it.", "Nobody had expected the old bridge to hold.",
          "They walked past the mill, talking about the harvest and the price of grain.", "In the end, the council agreed to wait until spring."]
LINKS = ["Home", "About us", "Contact", "Archive", "News", "Sign in", "Help", "Next page", "Kontakt", "Accueil", "Inicio", "Datenschutz"]

#: Page layouts: {t} title, {b} the blocks in the paragraph tag given after it, {l} links, {s} a sentence, {o} other text. What lies in
#: [[ ]] is content.
LAYOUTS = """
<body><nav><ul>{l}</ul></nav><div class="ad">{o}</div><article>[[<h1>{t}</h1>{b:p}]]</article><footer>&copy; {s}</footer>
<body><header class="site-header"><a href="/">{s}</a><nav>{l}</nav></header><main>[[<h1>{t}</h1>{b:p}]]</main><aside class="sidebar"><h3>{s}</h3><ul>{l}</ul><p>{o}</p></aside><footer><p>{o}</p></footer>
<body><div id="top" class="menu">{l}</div><div class="breadcrumbs">{l}</div><div id="content" class="post entry">[[<h2>{t}</h2>{b:p}]]</div><div class="share social"><a href="#">{s}</a></div><div id="footer">{s}<ul>{l}</ul></div>
<body><div class="cookie-notice"><p>{o}</p><button>OK</button></div><div class="wrapper"><div class="article-body">[[<h1>{t}</h1>{b:div}]]</div><div class="related"><h4>{s}</h4><ul>{l}</ul><p>{o}</p></div></div><div class="copyright">&copy; {s}</div>
<body><header><h1>{s}</h1><p>{o}</p></header><article>[[<h1>{t}</h1>{b:p}]]<section id="comments" class="comments"><h3>{s}</h3><div class="comment"><p>{o}</p></div><div class="comment"><p>{o}</p></div><form class="reply"><label>{s}</label><textarea>{s}</textarea><button>{s}</button></form></section></article><footer>{l}</footer>
<body><table><tr><td class="nav" width="150">{l}</td><td class="main">[[<h1>{t}</h1>{b:p}]]</td><td class="right-column">{o}<p>{o}</p></td></tr></table><center>{s}</center>
<body><section class="hero banner"><p>{o}</p></section><section class="story"><div class="text">[[<h1>{t}</h1>{b:p}]]</div><aside class="advert"><p>{o}</p></aside></section><section class="newsletter subscribe"><form><p>{o}</p><input name="e"><button>{s}</button></form></section><nav class="pagination">{l}</nav>
<body><div role="navigation">{l}</div><div role="main">[[<h1>{t}</h1>{b:p}<ul><li>{s}</li><li>{s}</li></ul><blockquote><p>{s}</p></blockquote>]]<div class="discussion"><ol class="replies"><li>{o}</li><li>{o}</li></ol></div></div><div role="contentinfo">{o}</div>
<body><div class="popup modal consent gdpr">{o}</div><div class="promo sponsored">{o}</div><div class="page"><div class="column">[[<h1>{t}</h1>{b:p}]]</div><div class="widget side"><p>{o}</p><ul>{l}</ul></div></div><div class="disqus feedback"><p>{o}</p><p>{o}</p></div><div class="legal bottom"><p>{o}</p></div>
<body><main><div class="alert warning notice">{o}</div><article class="news">[[<h1>{t}</h1>{b:p}]]<div class="ads"><p>{o}</p></div>[[<p>{s}</p><p>{s}</p>]]<div class="tags">{l}</div></article><aside>{o}<p>{o}</p></aside></main><footer><form class="search"><label>{s}</label></form><p>{o}</p></footer>
<body><p>{l}</p><hr>[[<h1>{t}</h1>{b:p}]]<hr><address>{s}</address>
""".strip().split("\n")


def _fill(layout: str, texts: list[str], others: list[str], rng) -> str:
    def pick(options):
        return entities.escape(options[rng.integers(len(options))])

    def put(m):
        kind, tag = m[1], m[2]
        if kind == "t":
            return entities.escape(texts[0][:60])
        if kind == "b":
            return "".join(f"<{tag}>{entities.escape(x)}</{tag}>" for x in texts)
        if kind == "l":
            return "".join(f'<li><a href="/{i}">{pick(LINKS + [w for x in others[:3] for w in x.split()[:3]])}</a></li>' for i in range(rng.integers(2, 8)))
        return pick(others if kind == "o" else SAMPLE + [x[:80] for x in others])

    return re.sub(r"\{([tblso])(?::(\w+))?\}", put, layout)


def labelled(layout: str) -> list[tuple[tuple[str, ...], int]]:
    """(features, label) of the blocks of a filled layout."""
    found = [(t.replace("⟦", "").replace("⟧", ""), f, t) for t, f in blocks(re.sub(r"\[\[", "<hr>⟦<hr>", layout).replace("]]", "<hr>⟧<hr>"))]
    out, inside = [], 0
    rows = []
    for text, f, raw in found:
        if raw == "⟦":
            inside = 1
        elif raw == "⟧":
            inside = 0
        else:
            rows.append((text, f, inside))
    for f, (_, _, y) in zip(sequence([(t, f) for t, f, _ in rows]), rows):
        out.append((f, y))
    return out


#: Ancestors and class words that take a block of an article out of its text.
_OUTSIDE = {"nav", "aside", "footer", "form", "c=comment", "c=comments", "c=ad", "c=ads", "c=advert", "c=sidebar", "c=menu"}


def training_set(pages: list[str], seed: int = 5) -> list[list[tuple[tuple[str, ...], int]]]:
    """Labelled block sequences from pages whose mark-up names the article."""
    rng = np.random.default_rng(seed)
    chains, texts, others = [], [], list(SAMPLE)
    for page in pages:
        found = blocks(page, most=4 * FIT_BLOCKS)
        marks = [bool({"article", "main"} & set(f)) and not _OUTSIDE & set(f) for _, f in found]
        if any(marks):
            chains.append(list(zip(sequence(found), map(int, marks)))[:4 * FIT_BLOCKS])
            texts.append([t for (t, _), y in zip(found, marks) if y][:FIT_BLOCKS])
            others += [t for (t, _), y in zip(found, marks) if not y and len(t) > 20][:3]
    texts = texts or [SAMPLE, SAMPLE[::-1], SAMPLE[:1]]
    pool = others + [x[0] for x in texts if x][:200] + [x[-1][:400] for x in texts][:200]
    for k, own in enumerate(texts):
        for j in range(3):
            chains.append(labelled(_fill(LAYOUTS[(3 * k + j) % len(LAYOUTS)], own, pool, rng)))
    for layout in LAYOUTS:
        chains.append(labelled(_fill(layout, SAMPLE, SAMPLE, rng)))
    return [c for c in chains if c]


class Model:
    """Weights of block features (for "content") and of label transitions."""

    def __init__(self, weights: dict[str, float], transitions: list[list[float]]):
        self.weights, self.transitions = weights, transitions

    def labels(self, features: list[tuple[str, ...]], before: list[float] | None = None) -> list[int]:
        """Viterbi: the most likely labels of a page's blocks, from their
        features (and the sums of those that are not listed)."""
        get, ((t00, t01), (t10, t11)) = self.weights.get, self.transitions
        back, a, b = [], 0.0, 0.0  # best scores that end in "other" and in "content"
        for i, fs in enumerate(features):
            s = sum([get(f, 0.0) for f in fs]) + (before[i] if before else 0.0)
            if i:
                from0, from1 = int(b + t10 > a + t00), int(b + t11 > a + t01)
                a, b = max(a + t00, b + t10), max(a + t01, b + t11) + s
                back.append((from0, from1))
            else:
                b = s
        if not features:
            return []
        out = [int(b > a)]
        for choice in reversed(back):
            out.append(choice[out[-1]])
        return out[::-1]


def train(chains, rounds: int = ROUNDS, l2: float = L2) -> Model:
    """Maximise the penalised conditional log-likelihood by resilient gradient
    steps (a step per weight that grows while its sign holds)."""
    index: dict[str, int] = {}
    flat, starts, ys, lengths = [], [0], [], []
    for chain in chains:
        lengths.append(len(chain))
        for fs, y in chain:
            flat += [index.setdefault(f, len(index)) for f in fs]
            starts.append(len(flat))
            ys.append(y)
    flat, ys = np.array(flat), np.array(ys, float)
    row = np.repeat(np.arange(len(ys)), np.diff(starts))
    w, t = np.zeros(len(index)), np.zeros(4)
    observed = np.zeros(4)
    at = np.concatenate(([0], np.cumsum(lengths)))
    for a, b in zip(at, at[1:]):
        np.add.at(observed, (2 * ys[a:b - 1] + ys[a + 1:b]).astype(int), 1)
    step, last = np.full(len(w) + 4, 0.1), np.zeros(len(w) + 4)
    for _ in range(rounds):
        s = np.bincount(row, w[flat], len(ys))
        p, expected = _forward_backward(s.tolist(), t.tolist(), at.tolist())
        grad = np.concatenate((np.bincount(flat, (ys - p)[row], len(w)) - l2 * w, observed - expected - l2 * t))
        agree = np.sign(grad) * last
        step = np.clip(np.where(agree > 0, step * 1.2, np.where(agree < 0, step * 0.5, step)), 1e-4, 1.0)
        last = np.where(agree < 0, 0, np.sign(grad))
        move = step * last
        w, t = w + move[:-4], t + move[-4:]
    return Model({f: float(w[i]) for f, i in index.items()}, [[float(t[0]), float(t[1])], [float(t[2]), float(t[3])]])


def _forward_backward(s: list[float], t: list[float], at: list[int]):
    """Probability of "content" for each block and expected transitions."""
    e00, e01, e10, e11 = (exp(x) for x in t)
    p, expected = np.empty(len(s)), [0.0] * 4
    for a, b in zip(at, at[1:]):
        gain = [exp(max(-30.0, min(30.0, x))) for x in s[a:b]]
        fwd = []
        x, y = 1.0, gain[0]
        for i in range(b - a):
            if i:
                x, y = x * e00 + y * e10, (x * e01 + y * e11) * gain[i]
            z = x + y
            x, y = x / z, y / z
            fwd.append((x, y))
        u = v = 1.0
        for i in range(b - a - 1, -1, -1):
            x, y = fwd[i]
            z = x * u + y * v
            p[a + i] = y * v / z
            if i:
                px, py = fwd[i - 1]
                g = gain[i]
                m = (px * e00 * u, px * e01 * g * v, py * e10 * u, py * e11 * g * v)
                z = sum(m)
                for k in range(4):
                    expected[k] += m[k] / z
                u, v = e00 * u + e01 * g * v, e10 * u + e11 * g * v
                z = u + v
                u, v = u / z, v / z
    return p, np.array(expected)


def log_likelihood(model: Model, chain) -> float:
    """Log probability of a chain's labels."""
    s = [sum(model.weights.get(f, 0.0) for f in fs) for fs, _ in chain]
    ys = [y for _, y in chain]
    own = sum(x for x, y in zip(s, ys) if y) + sum(model.transitions[a][b] for a, b in zip(ys, ys[1:]))
    z = [0.0, s[0]]
    for x in s[1:]:
        z = [log(sum(exp(z[a] + model.transitions[a][b]) for a in (0, 1))) + b * x for b in (0, 1)]
    return own - log(exp(z[0]) + exp(z[1]))


# ---- the operator ----

def main_text(page: str | None, model: Model) -> str:
    found = blocks(page, model.weights.get)
    labels = model.labels(sequence([(t, f) for t, f, _ in found]), [x for *_, x in found])
    return "\n".join(t for (t, *_), y in zip(found, labels) if y)


def fit(pages: DataFrame, *, html_col: str = "html", fit_pages: int = FIT_PAGES) -> Model:
    """A model from at most ``fit_pages`` different pages, those of the
    smallest hashes among the pages whose mark-up names the article. Tasks
    rank hashes; only the chosen pages reach the driver, once each."""
    h = F.col(f"`{html_col}`")
    named = pages.where(h.contains("<article") | h.contains("<main")).select(h.alias("html"), F.xxhash64(h).alias("k"))
    chosen = [r.k for r in named.select("k").distinct().orderBy("k").limit(fit_pages).collect()]
    rows = named.where(F.col("k").isin(chosen)).groupBy("k").agg(F.min("html").alias("html")).orderBy("k").collect() if chosen else []
    return train(training_set([r.html for r in rows]))


def extract(pages: DataFrame, model: Model | None = None, *, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` (or its columns in ``keep``) with text and n_chars."""
    spark = prepare(pages.sparkSession)
    shared = spark.sparkContext.broadcast(model or fit(pages, html_col=html_col))  # some hundred weights

    def make():
        m = shared.value

        def fn(rows):
            texts = [main_text(p, m) for p in rows]
            return [(t, len(t)) for t in texts]

        return fn

    return annotate(pages, html_col, "text string, n_chars long", make, keep)
