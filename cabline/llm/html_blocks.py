"""Main-text extraction: a recurrent labeller over a page's text blocks.

A page becomes the sequence of its leaf blocks: the text between two block-level
tags (or line breaks), with character references decoded and white space
collapsed.  A block's input is its tag path (every open element's name, classes
and id, hashed), its words (hashed) and a few figures (size, share of linked
text, place).  A bidirectional LSTM in numpy reads the whole sequence both ways
and labels every block with the context of the whole document; blocks labelled
as main text are joined in page order.

The labeller is trained on a bounded sample: ``train_pages`` pages, chosen by a hash of
page_id, and of each at most ``TRAIN_BLOCKS`` blocks, from both ends.  Their hashes are
chosen first, so only the pages themselves reach the driver.  Labels come from the page's own markup (a teacher rule:
inside an article or main element or one named so, and not inside anything
named as navigation, notice, advert, form or comments), and every page is also
shown in other layouts: its blocks are put into varied markup, with and without
semantic elements, so that the network can't lean on one template.

Cases: a null or empty page gives an empty text; unclosed, crossed or unknown
tags are tolerated; an unclosed script, style or comment hides the rest, any other hidden
element only up to its end, if it has one; of a deeper path the innermost 256 steps
count; pages that repeat are extracted alike; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.llm._common import per_process, shared

TRAIN_PAGES = 300
TRAIN_BLOCKS = 60           # of a training page: half from its start, half from its end
PATH_BUCKETS, WORD_BUCKETS, FIGURES = 64, 32, 6
HIDDEN, EPOCHS, RATE, BATCH = 16, 4, 0.02, 16
MAX_CELLS = 1 << 14         # blocks of a batch of pages, when labelling

# Elements by their role, and names of parts.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins "
                   "kbd label mark nobr picture q rp rt ruby s samp small source span strike strong "
                   "sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_PARTS = frozenset("script style noscript template title textarea select svg iframe "
                         "object".split())
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option thead tbody".split())
CONTENT_NAMES = re.compile(r"(?<![a-z])(article|main|content|post|entry|story|body-text)(?![a-z])")
OTHER_TAGS = frozenset("nav header footer aside form button fieldset menu dialog".split())
OTHER_NAMES = re.compile(r"(?<![a-z])(ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|"
                         r"disclaimer|footer|form|header|login|menu|nav\w*|newsletter|notice|pager|"
                         r"popup|promo|related|respond|search|share|sharing|sidebar|social|sponsor\w*"
                         r"|subscribe|tags|toolbar|widget)(?![a-z])")

#: of the hidden elements, those that hide the rest of a page that doesn't close them
UNENDING = frozenset("script style".split())
#: the innermost steps of a block's path that are kept
PATH_STEPS = 256

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                  r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in HIDDEN_PARTS}
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class Block:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple[str, ...], text: str, linked: int) -> None:
        self.path, self.text, self.linked = path, text, linked


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order; a path step is ``tag name name ...``."""
    page = page or ""
    open_: list[str] = []           # tags
    times: Counter = Counter()      # of each tag among them
    steps: list[str] = []
    blocks: list[Block] = []
    text: list[str] = []
    linked, in_link = 0, False
    never_closed: set[str] = set()  # hidden elements without an end from here on

    def close_block() -> None:
        nonlocal text, linked
        words = html.unescape("".join(text)).split()
        if words:
            blocks.append(Block(tuple(steps[-PATH_STEPS:]), " ".join(words), linked))
        text, linked = [], 0

    def close_element() -> str:
        steps.pop()
        times[open_[-1]] -= 1
        return open_.pop()

    at = 0
    while m := _TAG.search(page, at):
        if m.start() > at:
            part = page[at:m.start()]
            text.append(part)
            linked += len(part) if in_link else 0
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in HIDDEN_PARTS and not closing:
            if tag == "svg" and attributes.endswith("/"):       # empty
                continue
            end = None if tag in never_closed else _CLOSING[tag].search(page, at)
            if end or tag in UNENDING:
                at = end.end() if end else len(page)
                text.append(" ")
                continue
            never_closed.add(tag)
        if tag in INLINE:
            if tag == "a":
                in_link = not closing
            continue
        close_block()
        if tag in VOID:
            continue
        if closing:
            if times[tag]:
                while close_element() != tag:
                    pass
        else:
            if tag in CLOSED_BY_SAME and open_ and open_[-1] == tag:
                close_element()
            names = " ".join(x for found in _NAMES.findall(attributes) for x in found if x)
            open_.append(tag)
            times[tag] += 1
            steps.append(f"{tag} {names.lower()}".strip())
        in_link = False
    text.append(page[at:])
    close_block()
    return blocks


def teacher_label(path: tuple[str, ...]) -> bool:
    inside = False
    for step in path:
        tag, _, names = step.partition(" ")
        if tag in OTHER_TAGS or OTHER_NAMES.search(names):
            return False
        inside = inside or tag in ("article", "main") or bool(CONTENT_NAMES.search(names))
    return inside


def _bucket(text: str, buckets: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % buckets


class _PathVectors(dict):
    def __missing__(self, path: tuple[str, ...]) -> np.ndarray:
        if len(self) > 20_000:
            self.clear()
        v = np.zeros(PATH_BUCKETS, np.float32)
        for depth, step in enumerate(reversed(path)):
            for part in re.split(r"[^a-z0-9]+", step):
                if part:
                    v[_bucket(part, PATH_BUCKETS)] += 1 / (1 + 0.25 * depth)
        self[path] = v
        return v


class _WordBuckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = _bucket(word, WORD_BUCKETS)
        return value


def inputs(blocks: list[Block]) -> np.ndarray:
    paths = per_process("block_paths", _PathVectors)
    buckets = per_process("block_words", _WordBuckets)
    x = np.zeros((len(blocks), PATH_BUCKETS + WORD_BUCKETS + FIGURES), np.float32)
    for i, b in enumerate(blocks):
        words = b.text.split(" ")
        counts = np.bincount(list(map(buckets.__getitem__, words)), minlength=WORD_BUCKETS)
        x[i, :PATH_BUCKETS] = paths[b.path]
        x[i, PATH_BUCKETS:PATH_BUCKETS + WORD_BUCKETS] = counts / len(words)
        x[i, -FIGURES:] = (np.log1p(len(words)) / 4, min(1.0, b.linked / max(1, len(b.text))),
                           i / len(blocks), 1 / (1 + i), 1 / (len(blocks) - i),
                           sum(b.text.count(c) for c in ".,;:!?") / len(words))
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs over (time, batch, inputs), their states joined to one score a block."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 5) -> None:
        rng, n = np.random.default_rng(seed), PATH_BUCKETS + WORD_BUCKETS + FIGURES
        self.p = {}
        for d in "fb":
            self.p[f"w{d}"] = rng.normal(0, 0.15, (n, 4 * hidden)).astype(np.float32)
            self.p[f"u{d}"] = rng.normal(0, 0.15, (hidden, 4 * hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden:2 * hidden] = 1             # forget gates start open
            self.p[f"b{d}"] = bias
        self.p["o"] = rng.normal(0, 0.15, 2 * hidden).astype(np.float32)
        self.p["ob"] = np.zeros(1, np.float32)
        self.hidden = hidden

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """States over time; padded steps leave the state as it was."""
        hidden = self.hidden
        z_in = x @ self.p[f"w{d}"] + self.p[f"b{d}"]
        times = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        h = np.zeros((x.shape[1], hidden), np.float32)
        c, states, tape = h, np.empty((*x.shape[:2], hidden), np.float32), []
        for t in times:
            z = z_in[t] + h @ self.p[f"u{d}"]
            i, f, o = (_sigmoid(z[:, k * hidden:(k + 1) * hidden]) for k in range(3))
            g, on = np.tanh(z[:, 3 * hidden:]), mask[t][:, None]
            new_c = f * c + i * g
            tc = np.tanh(new_c)
            if keep:
                tape.append((t, h, c, i, f, o, g, tc))
            h = np.where(on, o * tc, h)
            c = np.where(on, new_c, c)
            states[t] = h
        return states, tape

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        hidden = self.hidden
        f, b = (self._run(x, mask, d, False)[0] for d in "fb")
        return f @ self.p["o"][:hidden] + b @ self.p["o"][hidden:] + self.p["ob"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict:
        """Of the mean logistic loss, by backpropagation through time."""
        hidden, grads = self.hidden, {k: np.zeros_like(v) for k, v in self.p.items()}
        runs = {d: self._run(x, mask, d, True) for d in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], 2)
        d_score = (_sigmoid(both @ self.p["o"] + self.p["ob"]) - y) * mask / mask.sum()
        grads["o"], grads["ob"][0] = np.einsum("tb,tbh->h", d_score, both), d_score.sum()
        for k, d in enumerate("fb"):
            out = d_score[:, :, None] * self.p["o"][k * hidden:(k + 1) * hidden]
            d_h = np.zeros((x.shape[1], hidden), np.float32)
            d_c = np.zeros_like(d_h)
            for t, h, c, i, f, o, g, tc in reversed(runs[d][1]):
                on = mask[t][:, None]
                whole = out[t] + d_h
                d_new = (d_c + whole * o * (1 - tc * tc)) * on
                d_z = np.concatenate([d_new * g * i * (1 - i), d_new * c * f * (1 - f),
                                      whole * on * tc * o * (1 - o), d_new * i * (1 - g * g)], 1)
                grads[f"w{d}"] += x[t].T @ d_z
                grads[f"u{d}"] += h.T @ d_z
                grads[f"b{d}"] += d_z.sum(0)
                d_h = d_z @ self.p[f"u{d}"].T + whole * (1 - on)
                d_c = d_new * f + d_c * (1 - on)
        return grads

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS,
            rate: float = RATE, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = sorted(rng.permutation(len(pages)).tolist(), key=lambda i: len(pages[i][0]))
            batches = [order[i:i + BATCH] for i in range(0, len(order), BATCH)]
            for k in rng.permutation(len(batches)).tolist():
                x, mask = stacked([pages[i][0] for i in batches[k]])
                y = np.zeros(mask.shape, np.float32)
                for j, i in enumerate(batches[k]):
                    y[:len(pages[i][1]), j] = pages[i][1]
                step += 1
                for name, g in self.gradients(x, mask, y).items():      # Adam
                    mean[name] += 0.1 * (g - mean[name])
                    square[name] += 0.01 * (g * g - square[name])
                    self.p[name] -= rate * (mean[name] / (1 - 0.9 ** step)) / (
                        np.sqrt(square[name] / (1 - 0.99 ** step)) + 1e-6)

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Flags of main-text blocks per page."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        while order:
            longest, n = len(pages[order[-1]]), 1
            while n < len(order) and (n + 1) * longest <= MAX_CELLS:
                n += 1
            part, order = order[-n:], order[:-n]
            x, mask = stacked([inputs(pages[i]) for i in part])
            flags = self.scores(x, mask) > 0
            for j, i in enumerate(part):
                out[i] = flags[:len(pages[i]), j]
        return out


def stacked(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(time, batch, inputs) and the mask of real steps."""
    longest = max(map(len, sequences))
    x = np.zeros((longest, len(sequences), sequences[0].shape[1]), np.float32)
    mask = np.zeros((longest, len(sequences)), np.float32)
    for j, s in enumerate(sequences):
        x[:len(s), j], mask[:len(s), j] = s, 1
    return x, mask


# Layouts for training: what wraps the main text, and parts before, within and after it.
_MAIN = ("article", "main", "div class=content", "div id=content", "div class=post-body",
         "section class=story", "div class=entry-content", "div id=main-content", "td class=body",
         "div class=article-text")
_BEFORE = ("header", "nav>ul>li", "div class=menu>ul>li", "div id=header", "div class=cookie-notice",
           "div class=breadcrumbs", "ul class=navbar>li", "div class=banner>p", "div class=ad",
           "form class=search", "div class=notice>p")
_WITHIN = ("aside", "div class=ad", "div class=share>ul>li", "figure class=advert",
           "div class=newsletter>form>p", "div class=related>ul>li")
_AFTER = ("footer", "aside class=sidebar>p", "div class=comments>div class=comment>p",
          "section id=comments>ul>li>p", "div id=footer>p", "div class=related>ul>li>p",
          "form id=respond>p", "div class=sidebar>div class=widget>p", "div class=cookie-consent>p",
          "div class=disclaimer>p", "ol class=comment-list>li class=comment>p")


def _step_of(part: str) -> str:
    tag, _, name = part.partition(" ")
    return f"{tag} {name.partition('=')[2]}".strip()


def relaid(main: list[str], other: list[str], rng: np.random.Generator
           ) -> tuple[list[Block], list[bool]]:
    """The same texts in another layout, with their labels."""
    shell = ("html", "body") + (("div wrapper",) if rng.random() < 0.5 else ())
    blocks, labels = [], []

    def part(spec: str, prefix: tuple[str, ...]) -> None:
        path = prefix + tuple(map(_step_of, spec.split(">")))
        many = path[-1].startswith("li") or path[-1].startswith("p") and rng.random() < 0.5
        for _ in range(int(rng.integers(2, 7)) if many else 1):
            # readers' comments and notices are prose as the article is
            source = main if main and rng.random() < 0.4 else other
            words = source[int(rng.integers(len(source)))].split(" ")
            n = int(rng.integers(1, 60)) if source is main else len(words)
            text = " ".join(words[:n])
            blocks.append(Block(path, text, len(text) if path[-1].startswith("li") else 0))
            labels.append(False)

    for spec in rng.permutation(_BEFORE)[:int(rng.integers(0, 4))]:
        part(str(spec), shell)
    inner = shell + (_step_of(_MAIN[int(rng.integers(len(_MAIN)))]),)
    for i, text in enumerate(main):
        tag = "h1" if not i else "p" if rng.random() < 0.85 else str(
            rng.choice(["h2", "blockquote", "li", "pre", "td"]))
        blocks.append(Block(inner + (tag,) if tag != "li" else inner + ("ul", "li"), text, 0))
        labels.append(True)
        if rng.random() < 0.06:
            part(str(rng.choice(_WITHIN)), inner)
    for spec in rng.permutation(_AFTER)[:int(rng.integers(0, 5))]:
        part(str(spec), inner if rng.random() < 0.3 else shell)
    return blocks, labels


def train_labeller(pages: list[str], layouts: int = 4, seed: int = 1) -> Labeller:
    rng, examples = np.random.default_rng(seed), []
    for page in pages:
        blocks = blocks_of(page)
        labels = [teacher_label(b.path) for b in blocks]
        views = [(blocks, labels)]
        main = [b.text for b, y in zip(blocks, labels) if y]
        other = [b.text for b, y in zip(blocks, labels) if not y]
        if main and other:
            views += [relaid(main, other, rng) for _ in range(layouts)]
        for seen, flags in views:
            if seen:
                x, y = inputs(seen), np.array(flags, np.float32)
                if len(x) > TRAIN_BLOCKS:       # both ends, where the borders are
                    ends = np.r_[:TRAIN_BLOCKS // 2, len(x) - TRAIN_BLOCKS // 2:len(x)]
                    x, y = x[ends], y[ends]
                examples.append((x, y))
    model = Labeller()
    if examples:
        model.fit(examples)
    return model


def _sample(pages: DataFrame, n: int) -> list[str]:
    """The html of ``n`` pages, equal rows once, in the order of their hashes."""
    hashed = pages.where("length(html) > 0").withColumns(
        {"h": F.xxhash64("page_id"), "g": F.xxhash64("html")})
    chosen = hashed.select("h", "g").distinct().orderBy("h", "g").limit(n).collect()
    keys = [(r["h"], r["g"]) for r in chosen]
    found = hashed.where(F.col("h").isin([h for h, _ in keys]) & F.col("g").isin([g for _, g in keys]))
    html_of = {(r["h"], r["g"]): r["html"] for r in
               found.groupBy("h", "g").agg(F.first("html").alias("html")).collect()}
    return [html_of[k] for k in keys]


def extract_main_text(pages: DataFrame, train_pages: int = TRAIN_PAGES, id_col: str = "page_id",
                      url_col: str = "url", html_col: str = "html",
                      model: Labeller | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars.  ``model``: a trained labeller to use."""
    spark = pages.sparkSession
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
    if model is None:
        model = train_labeller(_sample(pages, train_pages))
    sent = shared(spark, model)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = sent()
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                found = [blocks_of(x) for x in part.column("html").to_pylist()]
                texts = ["\n".join(x.text for x, keep in zip(blocks, flags) if keep)
                         for blocks, flags in zip(found, labeller.label(found))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                    ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return (pages.mapInArrow(extract, f"page_id {kind}, url string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
