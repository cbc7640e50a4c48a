"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

Method.  A page is cut into leaf blocks: stretches of text between block-level
tags, each with the tags and class words of its ancestors.  The features of a
block are its ancestor tags, their class words and its text (length, share of
link text, end mark, figures).  An ancestor that holds most of the page's text
counts apart, since a wrapper named for the layout, or a form around a whole
page, is no side matter; names of ``html`` and ``body`` count nothing.  Weights of features and of label changes are
fitted to labelled pages by maximum likelihood; a page's labels are the best
path by Viterbi.  The blocks labelled as main text are joined in page order.

The labelled pages are made here by ``labelled_pages``: every fragment of a
page comes with the label of its blocks.  Their number is the parameter
``pages``, which bounds the fit whatever the input.

Defined results: a null or empty page has the empty text and n_chars 0; so
does a page without main text.  A page is read as far as it goes: tags left
open end with the page, a tag cut off at the end is dropped.  Rows are judged
one by one, so ties, repeated rows and null ids need no rule.  Other columns
are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import by_size

BATCH_BYTES = 4 << 20
TRAIN_PAGES = 600
TRAIN_SEED = 6

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = frozenset("head script style title noscript template iframe object svg math textarea select option button canvas audio video".split())
ENDS_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = BLOCK_TAGS - {"body", "html"}
WORDS_IN_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, frozenset[str], int], ...]  # tag, class words and number of every ancestor, outermost first
    linked: float  # share of the characters that stand in links

    @property
    def tags(self) -> tuple[str, ...]:
        return tuple(tag for tag, _, _ in self.path)


class Blocks(HTMLParser):
    """Leaf blocks of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, frozenset[str], int]] = []
        self.begun = 0
        self.found: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.silent = 0
        self.links = 0

    def end_block(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.found.append(Block(text, tuple(self.open), min(1.0, self.linked / len(text))))
        self.parts, self.linked = [], 0

    def pop_to(self, depth: int):
        for tag, _, _ in self.open[depth:]:
            self.silent -= tag in SILENT_TAGS
            self.links -= tag == "a"
        del self.open[depth:]

    def close_open(self, closing, stop):
        """End the innermost open element of ``closing``, unless one of ``stop`` is in between."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in closing:
                self.pop_to(i)
                return
            if self.open[i][0] in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in BLOCK_TAGS or tag in SILENT_TAGS:
            if tag in BLOCK_TAGS:
                self.end_block()
                self.close_open({"head"}, {"body"})
            if tag in ENDS_P:
                self.close_open({"p"}, {"table", "td", "th", "button", "div", "section", "article", "li"})
            if tag in ENDS_ITSELF:
                self.close_open(ENDS_ITSELF[tag], {"ul", "ol", "dl", "table", "select", "menu"} if tag != "td" and tag != "th" else {"tr", "table"})
        if tag in VOID_TAGS:
            return
        names = frozenset(w.lower() for k, v in attrs if k in ("class", "id", "role") and v for w in WORDS_IN_NAME.findall(v))
        self.begun += 1
        self.open.append((tag, names, self.begun))
        self.silent += tag in SILENT_TAGS
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):  # elsewhere a slash does not end an element
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                if tag in BLOCK_TAGS:
                    self.end_block()
                self.pop_to(i)
                return
            if self.open[i][0] in BLOCK_TAGS and tag not in BLOCK_TAGS:
                return  # an inline end tag does not reach out of its block

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


def blocks_of(page: str | None) -> list[Block]:
    page = page or ""
    cut = page.rfind("<")
    if cut >= 0 and ">" not in page[cut:] and (cut + 1 == len(page) or page[cut + 1].isalpha() or page[cut + 1] in "/!?"):
        page = page[:cut]
    parser = Blocks()
    parser.feed(page)
    parser.close()
    parser.end_block()
    return parser.found


def bin_of(x: float, edges: tuple) -> int:
    return sum(x >= e for e in edges)


def features(blocks: list[Block]) -> list[list[str]]:
    out, before, held = [], None, Counter()
    for b in blocks:
        held.update(dict.fromkeys((number for _, _, number in b.path), len(b.text)))
    half = sum(len(b.text) for b in blocks) * WIDE
    for b in blocks:
        words, f = b.text.split(), set()
        for tag, names, number in b.path:
            wide = "wide_" if held[number] > half else ""
            f.add(f"{wide if tag in SIDE_TAGS else ''}in:{tag}")
            if tag not in ("html", "body"):
                f.update(f"{wide}name:{n}" for n in names)
                f.update({f"{wide}side_name"} if not names.isdisjoint(SIDE_NAMES) else ())
        f = sorted(f)
        leaf = next((t for t in reversed(b.tags) if t in BLOCK_TAGS), "none")
        f += [f"leaf:{leaf}", f"words:{bin_of(len(words), (2, 5, 10, 25))}", f"linked:{bin_of(b.linked, (0.01, 0.34, 0.67))}"]
        f += [f"end:{b.text[-1] in '.!?…”\"'}", f"copy:{'©' in b.text[:16]}", f"figures:{any(c.isdigit() for c in b.text)}", "bias"]
        if before is not None and before.tags == b.tags:
            f.append("like_before")
        out.append(f)
        before = b
    return out


# --- labelled pages ---------------------------------------------------------

SYLLABLES = "ba be bi da de do fa fe ga go ha he ka ke ki la le lo ma me mo na ne no pa pe ra re ri sa se so ta te ti to va ve vi wa za".split()
BAD_NAMES = (
    "nav menu navbar header masthead footer sidebar aside rail widget ad ads advert advertisement banner promo sponsor sponsored cookie consent notice "
    "alert warning popup modal overlay newsletter subscribe signup share social related recommended more trending breadcrumb breadcrumbs pagination pager "
    "comment comments reply replies respond discussion disqus form search login register copyright legal tags toolbar skip links meta print feedback"
).split()
LAYOUT_NAMES = "sidebar header nav menu footer ads banner form search widget toolbar social meta aside layout wrapper container theme".split()
GOOD_NAMES = "content article post entry story main body text page single blog news".split()
BAD_TAGS = "nav header footer aside form".split()
SIDE_TAGS, SIDE_NAMES = frozenset(BAD_TAGS), frozenset(BAD_NAMES)
WIDE = 0.5  # share of a page's text from which on an ancestor counts as a wrapper


def labelled_page(rng: random.Random) -> list[tuple[str, int | None]]:
    """Pieces of one page; a piece's label holds for all blocks it begins, None for markup without text."""

    def sentence(low=4, high=18):
        words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        return " ".join(words).capitalize() + rng.choice([".", ".", ".", "!", "?"])

    def prose(low=1, high=6):
        return " ".join(sentence() for _ in range(rng.randint(low, high)))

    def short(high=5):
        return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(rng.randint(1, high)))

    def bad(name=None):
        """A piece that is no main text."""
        name = name or rng.choice(BAD_NAMES)
        tag = rng.choice(BAD_TAGS) if rng.random() < 0.4 else rng.choice(["div", "section", "div", "ul", "p"])
        attr = f' {rng.choice(["class", "class", "id"])}="{rng.choice(["", "site-", "page_", "the-"])}{name}{rng.choice(["", "-box", "_wrap", "-1"])}"'
        if tag in BAD_TAGS and rng.random() < 0.6:
            attr = ""
        kind = rng.random()
        if kind < 0.4:
            inner = "".join(f'<li><a href="/{i}">{short(3)}</a></li>' for i in range(rng.randint(2, 7)))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif kind < 0.7:
            inner = prose(1, 4) if rng.random() < 0.5 or tag in ("p", "ul") else "".join(f"<p>{prose(1, 3)}</p>" for _ in range(rng.randint(1, 4)))
        elif kind < 0.85:
            inner = f"&copy; 20{rng.randint(10, 25)} {short(3)} &middot; {sentence(2, 8)}"
        else:
            inner = short(6) if tag in ("p", "ul") else f"<h3>{short(3)}</h3>" + "".join(f"<div>{sentence(3, 12)}</div>" for _ in range(rng.randint(1, 4)))
        return (f"<{tag}{attr}>{inner}</{tag}>", 0)

    def good():
        kind, out = rng.random(), []
        if kind < 0.68:
            text = prose()
            if rng.random() < 0.06:
                text = f"{sentence(5, 14)} {short(3)} © {sentence(3, 14)}" + rng.choice(["", f" {text}"])
            if rng.random() < 0.14:  # cut off, or the words parted by other marks
                text = text[: rng.randint(len(text) // 2, len(text))].rstrip(".!? ") + rng.choice(["", ".", ",", "%%%", " |"])
            if rng.random() < 0.06:
                text = text.replace(" ", rng.choice([" | ", "## ", "&amp;&amp; "]))
            if rng.random() < 0.15:
                text = text.replace(" ", f' <a href="/x">{short(2)}</a> ', 1)
            if rng.random() < 0.2:
                text = f"<b>{text}<br>" if rng.random() < 0.5 else f"<em>{text}</em>"
            out.append((f"<p>{text}" + ("</p>" if rng.random() < 0.85 else ""), 1))
        elif kind < 0.8:
            level = rng.choice("123")
            out.append((f"<h{level}>{sentence(1, 8).rstrip('.!?')}</h{level}>", 1))
        elif kind < 0.87:
            out.append(("<ul>" + "".join(f"<li>{sentence(2, 10)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>", 1))
        elif kind < 0.92:
            out.append((f"<blockquote>{prose(1, 3)}</blockquote>", 1))
        elif kind < 0.96:
            out.append((f"<pre>{short(8)}</pre>", 1))
        else:
            out.append(("<table>" + "".join(f"<tr><td>{short(3)}</td><td>{rng.randint(1, 999)}</td></tr>" for _ in range(rng.randint(1, 3))) + "</table>", 1))
        return out

    def bare():
        """Side matter in plain elements, told by its text alone."""
        kind = rng.random()
        if kind < 0.5:
            return ("<div>" + rng.choice([" ", " | ", " &raquo; "]).join(f'<a href="/{i}">{short(2)}</a>' for i in range(rng.randint(2, 7))) + "</div>", 0)
        if kind < 0.8:
            return (f"<div>&copy; 20{rng.randint(10, 25)} {short(3)}{rng.choice(['', '. ' + sentence(2, 5)])}</div>", 0)
        return (f"<div>{short(3)}</div>", 0)

    plain = rng.random() < 0.12
    if plain:
        wrap = rng.choice(["", "<div>"])
        pieces = [(f"<html><head><title>{short()}</title></head><body>{wrap}", None)]
        pieces += [bare() for _ in range(rng.randint(0, 2))]
        deep = rng.choice(["", "", "<div>"])
        for _ in range(rng.randint(1, 10)):
            pieces.append((f"{deep}<div>{prose(2, 6) if rng.random() < 0.9 else sentence(8, 18)}</div>{deep.replace('<', '</')}", 1))
        pieces += [bare() for _ in range(rng.randint(0, 3))]
        return [*pieces, (f"{wrap.replace('<', '</')}</body></html>", None)]

    kind = rng.random()
    if kind < 0.45:
        start, end = "<article>", "</article>"
    elif kind < 0.6:
        start, end = "<main>", "</main>"
    elif kind < 0.7:
        start, end = "<main><article>", "</article></main>"
    elif kind < 0.93:
        name = rng.choice(GOOD_NAMES)
        start, end = f'<div class="{rng.choice(["", "post-", "the-"])}{name}{rng.choice(["", "-body", "_main"])}">', "</div>"
    else:
        start, end = rng.choice([("<div>", "</div>"), ("", "")])
    pieces: list[tuple[str, int | None]] = [(f"<!DOCTYPE html><html><head><title>{short()}</title><script>var a='</p>';</script></head><body>", None)]
    wraps = []
    if rng.random() < 0.3:  # a wrapper whose class words tell the layout
        said = [rng.choice(["has-", "no-", "with-", "page-with-", ""]) + rng.choice(LAYOUT_NAMES) for _ in range(rng.randint(1, 3))]
        wraps.append((f'<div {rng.choice(["class", "class", "id"])}="{rng.choice([" ", "-", "_"]).join(said)}">', "</div>"))
    if rng.random() < 0.12:  # a form around the whole page
        wraps.append((f'<form {rng.choice(["", "id=form1 ", "class=page-form "])}method="post"><input type="hidden" name="state">', "</form>"))
    rng.shuffle(wraps)
    pieces += [(before, None) for before, _ in wraps]
    pieces += [bad(rng.choice(["nav", "menu", "header", "notice", "ad", "search", "breadcrumb"])) for _ in range(rng.randint(0, 4))]
    pieces.append((start, None))
    if rng.random() < 0.75:
        pieces.append((f"<h1>{sentence(2, 10).rstrip('.')}</h1>", 1))
    for _ in range(rng.randint(1, 12)):
        pieces += good()
        if rng.random() < 0.06:
            pieces.append(bad(rng.choice(["ad", "related", "share", "newsletter", "promo", "notice"])))
    inside = rng.random() < 0.12
    if not inside:
        pieces.append((end, None))
    if rng.random() < 0.3:
        tag = rng.choice(["section", "div"])
        note = rng.choice(['<div class="comment">{}</div>', "<p>{}</p>", '<article class="comment"><p>{}</p></article>', '<li class="reply">{}</li>'])
        notes = "".join(note.format(prose(1, 3)) for _ in range(rng.randint(1, 5)))
        pieces.append((f'<{tag} class="{rng.choice(["comments", "comment-list", "replies", "discussion", "reader-comments"])}"><h2>{short(2)}</h2>{notes}</{tag}>', 0))
    if inside:
        pieces.append((end, None))
    pieces += [bad(rng.choice(["sidebar", "related", "footer", "newsletter", "ad", "form"])) for _ in range(rng.randint(0, 3))]
    pieces.append(bad("footer"))
    pieces += [(after, None) for _, after in reversed(wraps)]
    pieces.append(("</body></html>" if rng.random() < 0.9 else "", None))
    return pieces


def labelled_pages(pages: int, seed: int) -> list[tuple[str, list[Block], list[int]]]:
    """Pages with their blocks and labels; a marker in front of every piece tells where it begins."""
    out = []
    for k in range(pages):
        pieces = labelled_page(random.Random(f"{seed}/{k}"))
        labels: list[int] = []
        blocks = blocks_of("".join(p for p, _ in pieces))
        # Blocks follow the pieces in order: count those of each labelled piece on its own.
        for piece, label in pieces:
            if label is not None:
                labels += [label] * len(blocks_of(piece))
        if len(labels) == len(blocks) and blocks:
            out.append(("".join(p for p, _ in pieces), blocks, labels))
    return out


# --- the field --------------------------------------------------------------


@dataclass
class Model:
    weights: dict[str, np.ndarray]  # feature -> score of each label
    start: np.ndarray
    change: np.ndarray  # from label, to label


def fit(pages: list[tuple[str, list[Block], list[int]]], rounds: int = 120, rate: float = 0.15, decay: float = 1e-3) -> Model:
    """Maximum likelihood with a quadratic penalty; all pages advance together, padded to the longest."""
    names = sorted({f for _, blocks, _ in pages for fs in features(blocks) for f in fs})
    index = {f: i for i, f in enumerate(names)}
    n, longest = len(pages), max(len(b) for _, b, _ in pages)
    x = np.zeros((n, longest, len(names)), np.float32)
    y, live = np.zeros((n, longest), np.int64), np.zeros((n, longest), bool)
    for k, (_, blocks, labels) in enumerate(pages):
        for t, fs in enumerate(features(blocks)):
            x[k, t, [index[f] for f in fs]] = 1
        y[k, : len(labels)], live[k, : len(labels)] = labels, True
    target = np.eye(2)[y] * live[..., None]
    pairs = np.einsum("nti,ntj->ij", target[:, :-1], target[:, 1:])
    flat = x.reshape(n * longest, -1)
    theta = [np.zeros((len(names), 2)), np.zeros(2), np.zeros((2, 2))]
    first, second = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta]
    for step in range(1, rounds + 1):
        w, start, change = theta
        score = (flat @ w.astype(np.float32)).reshape(n, longest, 2).astype(float)
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = start + score[:, 0]
        for t in range(1, longest):
            on = np.logaddexp.reduce(forward[:, t - 1, :, None] + change, axis=1) + score[:, t]
            forward[:, t] = np.where(live[:, t, None], on, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            on = np.logaddexp.reduce(change + (score[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(live[:, t + 1, None], on, 0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        node = np.exp(forward + backward - total[:, None, None]) * live[..., None]
        edge = np.exp(forward[:, :-1, :, None] + change + (score + backward)[:, 1:, None, :] - total[:, None, None, None]) * live[:, 1:, None, None]
        gap = (target - node).reshape(n * longest, 2)
        slopes = [flat.T @ gap.astype(np.float32) / n - decay * w, (target[:, 0] - node[:, 0]).sum(0) / n, (pairs - edge.sum((0, 1))) / n]
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope**2
            theta[i] = theta[i] + rate * first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    return Model({f: theta[0][i] for f, i in index.items()}, theta[1], theta[2])


def decode(model: Model, blocks: list[Block]) -> list[int]:
    """The most likely labels by Viterbi; features never met in training count nothing."""
    if not blocks:
        return []
    zero = np.zeros(2)
    score = [sum((model.weights.get(f, zero) for f in fs), zero) for fs in features(blocks)]
    (a, b), back = model.start + score[0], []
    (c00, c01), (c10, c11) = model.change.tolist()
    for s in score[1:]:
        to0, to1 = (a + c00, b + c10), (a + c01, b + c11)
        back.append((int(to0[1] > to0[0]), int(to1[1] > to1[0])))
        a, b = max(to0) + s[0], max(to1) + s[1]
    labels = [int(b > a)]
    for step in reversed(back):
        labels.append(step[labels[-1]])
    return labels[::-1]


@lru_cache(maxsize=2)
def trained(pages: int = TRAIN_PAGES, seed: int = TRAIN_SEED) -> Model:
    return fit(labelled_pages(pages, seed))


def main_text(model: Model, page: str | None) -> str:
    blocks = blocks_of(page)
    return " ".join(b.text for b, label in zip(blocks, decode(model, blocks)) if label)


def extract_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "html", BATCH_BYTES):
            texts = [main_text(model, page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return run


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page, read where the page is."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(extract_rows(model or trained()), "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
