"""Main text of web pages by a linear-chain CRF over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, with character
references decoded and white space runs as one space. Scripts, styles, comments,
text areas, frames, titles and drawings never form blocks. Each block has features of its ancestor tags, their
class and id words (of inline and custom elements around it too, whatever their length),
its length, links and punctuation; a two-label chain (content,
other) scores features and label transitions; Viterbi decoding picks the labels, and
the content blocks, in page order and joined by a newline, are the main text.

Training is by conditional log-likelihood (Adam over forward-backward gradients, all
pages at once, packed without padding, so memory follows the blocks). Labelled pages are a bounded sample of pages whose address ends in a
document's number: a block is content when its text is a line of that document or
begins it (the headline).

Scale. Pages are parsed and decoded where they are read, without a shuffle; the model
is a few thousand numbers.

Defined results. Null or empty html gives '' and 0. Unclosed, misnested and truncated
markup is parsed leniently: an inline element that is never closed ends with the block
around it, and its end tag does not reach over an open block other than those whose end
tag may be left out; an open ``select`` or drawing ends at the next block that cannot
be in it; quotes delimit an attribute only right after its ``=``; a page without content blocks gives ''. Without labelled
pages the model falls back to its starting weights, where only the ancestors named in
``OTHER`` speak against a block. Repeated rows get equal results; extra columns do not
matter; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm.labels import sample

DIM = 2048
#: Fixed values of HTML: tags that end a line of text, tags whose content is no markup.
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
 fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu
 nav noscript ol optgroup option p pre search section select summary table tbody td template textarea tfoot th thead
 title tr ul""".split())
RAW = ("script", "style", "iframe", "noembed", "noframes", "textarea", "title")
IN_SELECT = frozenset("button div hr legend optgroup option select".split())
#: Blocks whose end tag may be left out.
OPEN_END = frozenset("p li dt dd option optgroup tr td th thead tbody tfoot".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Ancestor names (tags, and words of class, id and role) that speak against content.
OTHER = frozenset("""nav menu navigation header masthead banner footer aside sidebar side ad ads advert advertisement
 sponsor sponsored promo notice cookie consent gdpr popup modal form comment comments reply replies discussion
 disqus share social related breadcrumb breadcrumbs pagination subscribe newsletter login signup search button
 dialog noscript select template""".split())

#: Comment, declaration, or tag; possessive, so that no page makes the search go back.
_TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>"
                  r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*+(?:\"[^\"]*\"|'[^']*')|[^<>])*+)>", re.S)
#: A drawing's end, or the start of a block, which a drawing cannot hold.
_DRAWN = re.compile(rf"(</svg\s*>)|<(?:{'|'.join(sorted(BLOCK - {'title'}))})[\s/>]", re.I)
_ATTR = re.compile(r"(?:^|[\s\"'])(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_NAME = re.compile(r"[a-zA-Z]+")
_SPACE = re.compile(r"\s+")


def blocks(page: str) -> list[tuple[str, list[str], list[str], int]]:
    """(text, ancestor tags, words of their class, id and role, characters in links)."""
    out, stack, run = [], [], []
    links = in_link = 0

    def flush():
        nonlocal links
        text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
        if text:  # an inline element matters by its class only
            out.append((text, [t for t, ws in stack if ws or t in BLOCK], [w for _, ws in stack for w in ws], min(links, len(text))))
        run.clear()
        links = 0

    def close(names):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return

    def close_inline(name):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                if any(t in BLOCK for t, _ in stack[i:]):
                    flush()
                del stack[i:]
                return
            if stack[i][0] in BLOCK and stack[i][0] not in OPEN_END:
                return

    def around():
        """Index of the innermost open block (-1: none); inline elements may be open in it."""
        i = len(stack) - 1
        while i >= 0 and stack[i][0] not in BLOCK:
            i -= 1
        return i

    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        piece = page[at:m.start() if m else len(page)]
        if piece:
            run.append(piece)
            if in_link:
                links += len(piece.strip())
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if not m[1] and tag in RAW and not m[0].endswith("/>"):
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            if tag in BLOCK:
                flush()
        elif tag == "svg":
            if not m[1] and not m[0].endswith("/>"):
                end = _DRAWN.search(page, at)
                at = len(page) if not end else end.end() if end[1] else end.start()
        elif tag == "br":
            run.append(" ")
        elif tag == "a":
            in_link = 0 if m[1] else 1
        elif m[1]:
            if tag in BLOCK:
                flush()
                close((tag,))
            else:
                close_inline(tag)
        elif tag in VOID:
            if tag in BLOCK:
                flush()
        else:
            words = [w.lower() for v in _ATTR.findall(m[3]) for w in _NAME.findall(v)]
            if tag in BLOCK:
                flush()
                in_link = 0
                if tag not in IN_SELECT:
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] == "select":
                            del stack[i:]
                            break
                        if stack[i][0] in BLOCK and stack[i][0] not in IN_SELECT:
                            break
                i = around()
                if i >= 0 and stack[i][0] == "p":
                    del stack[i:]
                    i = around()
                if tag in ("li", "option", "tr", "td", "th", "dt", "dd") and i >= 0 and (
                        stack[i][0] == tag or tag in ("dt", "dd") and stack[i][0] in ("dt", "dd")
                        or tag in ("td", "th") and stack[i][0] in ("td", "th")):
                    del stack[i:]
                stack.append((tag, words))
            elif not m[0].endswith("/>"):
                stack.append((tag, words))
    flush()
    return out


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % (DIM - 1) + 1


#: Slot 0 counts names in OTHER.
def block_features(items: list[tuple]) -> list[list[int]]:
    out = []
    n = len(items)
    for i, (text, tags, words, links) in enumerate(items):
        f = {_slot(f"in {t}") for t in tags} | {_slot(f"word {w}") for w in words}
        if OTHER.intersection(tags) or OTHER.intersection(words):
            f.add(0)
        f.add(_slot(f"tag {tags[-1] if tags else ''}"))
        f.add(_slot(f"length {min(len(text).bit_length(), 10)}"))
        f.add(_slot(f"links {4 * links // max(len(text), 1)}"))
        f.add(_slot(f"ends {text[-1] in '.!?…:;»”'}"))
        f.add(_slot(f"sign {bool(re.search('[©|·»]', text))}"))
        f.add(_slot("first" if i == 0 else "last" if i == n - 1 else "inner"))
        out.append(sorted(f))
    return out


class Model:
    """Emission weights per feature and label (0 other, 1 content), transitions, start."""

    def __init__(self):
        self.emit = np.zeros((DIM, 2))
        self.emit[0] = (2.0, -2.0)
        self.move = np.zeros((2, 2))
        self.start = np.zeros(2)
        self.bias = np.array([0.0, 0.5])

    def emissions(self, feats: list[list[int]]) -> np.ndarray:
        n = [len(f) for f in feats]
        flat = self.emit[[i for f in feats for i in f]]
        ends = np.cumsum(n)
        total = np.concatenate((np.zeros((1, 2)), np.cumsum(flat, axis=0)))
        return total[ends] - total[ends - n] + self.bias

    def decode(self, e: np.ndarray) -> list[int]:
        """Viterbi labels of one page; a tie takes the lower label."""
        (m00, m01), (m10, m11) = self.move.tolist()
        rows = e.tolist()
        a, b = rows[0][0] + self.start[0], rows[0][1] + self.start[1]
        back = []
        for x, y in rows[1:]:
            p, q = int(b + m10 > a + m00), int(b + m11 > a + m01)
            back.append((p, q))
            a, b = max(a + m00, b + m10) + x, max(a + m01, b + m11) + y
        y = int(b > a)
        out = [y]
        for step in reversed(back):
            y = step[y]
            out.append(y)
        return out[::-1]


def fit(pages: list[tuple[list[list[int]], list[int]]], steps: int = 150, rate: float = 0.1,
        ridge: float = 1e-3) -> Model:
    """Maximum conditional likelihood on (features, labels) of pages."""
    model = Model()
    pages = [p for p in pages if p[0]]
    if not pages:
        return model
    # longest first, then all first blocks, all second blocks and so on: the pages that have a
    # block j are a prefix, so every step below works on slices
    pages.sort(key=lambda p: -len(p[0]))
    n, length = len(pages), np.array([len(f) for f, _ in pages])
    live = [int(np.searchsorted(-length, -j, "left")) for j in range(length[0])]
    at = np.concatenate(([0], np.cumsum(live)))
    total, last = at[-1], at[length - 1] + np.arange(n)
    labels = np.array([pages[i][1][j] for j, c in enumerate(live) for i in range(c)])
    rows = [pages[i][0][j] for j, c in enumerate(live) for i in range(c)]
    flat = np.array([x for r in rows for x in r], int)
    owner = np.repeat(np.arange(total), [len(r) for r in rows])
    gold = np.eye(2)[labels]
    later = np.arange(n, total)                     # blocks with a block before them
    before = later - np.repeat(live[:-1], live[1:])  # of the same page
    gold_move = np.zeros((2, 2))
    np.add.at(gold_move, (labels[before], labels[later]), 1)
    params = [model.emit, model.move, model.start, model.bias]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    lse = lambda v, axis: np.logaddexp.reduce(v, axis=axis)
    page_of = np.concatenate([np.arange(c) for c in live])
    for step in range(1, steps + 1):
        e = np.stack([np.bincount(owner, model.emit[flat, k], total) for k in (0, 1)], 1) + model.bias
        f, b = np.empty((total, 2)), np.zeros((total, 2))
        f[:n] = e[:n] + model.start
        for j in range(1, len(live)):
            x, y, c = at[j - 1], at[j], live[j]
            f[y:y + c] = lse(f[x:x + c, :, None] + model.move, 1) + e[y:y + c]
        z = lse(f[last], 1)[page_of][:, None]
        for j in range(len(live) - 2, -1, -1):
            x, y, c = at[j], at[j + 1], live[j + 1]
            b[x:x + c] = lse(model.move + (e[y:y + c] + b[y:y + c])[:, None, :], 2)
        gap = np.exp(f + b - z) - gold
        pair = f[before][:, :, None] + model.move + (e[later] + b[later])[:, None, :] - z[later][:, :, None]
        g_emit = np.stack([np.bincount(flat, gap[owner, k], DIM) for k in (0, 1)], 1)
        grads = [g_emit, np.exp(np.minimum(pair, 0)).sum(axis=0) - gold_move, gap[:n].sum(axis=0), gap.sum(axis=0)]
        for k, (p, g) in enumerate(zip(params, grads)):
            g = g / n + ridge * p
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            p -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for pid, page, text in zip(*(b.column(c).to_pylist() for c in ("page_id", "html", "text"))):
            items = blocks(page or "")
            lines = {_SPACE.sub(" ", x).strip() for x in (text or "").split("\n")}
            whole = _SPACE.sub(" ", text or "").strip()
            y = [int(t in lines or whole.startswith(t)) for t, *_ in items]
            if any(y):
                rows.append((pid, block_features(items), y))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.list_(pa.int64()))),
             pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["page_id", "features", "labels"])


def train(pages: DataFrame, docs: DataFrame, *, max_pages: int = 1000) -> Model:
    """``pages``: page_id, url, html; ``docs``: doc_id, text. A page's document is the
    number its path ends in. At most ``max_pages`` labelled pages are fitted."""
    doc = F.regexp_extract("url", r"/(\d{1,18})(?:[?#].*)?$", 1)
    known = pages.where(doc != "").select("page_id", doc.cast("long").alias("doc_id"))
    chosen = sample(known, max_pages, "page_id", "doc_id")
    some = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id")  # max_pages ids
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id")
    rows = (some.join(texts, "doc_id").select("page_id", "html", "text")
            .mapInArrow(_label, "page_id long, features array<array<long>>, labels array<long>")
            .orderBy("page_id", F.xxhash64("features", "labels")).limit(max_pages).collect())  # ids may repeat
    rows.sort(key=lambda r: (r.page_id, len(r.labels), r.labels))
    return fit([(r.features, r.labels) for r in rows])


def extract(pages: DataFrame, model: Model, *, page_id: str = "page_id", url: str = "url",
            page: str = "html") -> DataFrame:
    """Per row: ``page_id``, ``url``, ``text`` and ``n_chars`` (code points)."""
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (page_id, url)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for x in b.column("html"):
                items = blocks(x.as_py() or "")
                keep = model.decode(model.emissions(block_features(items))) if items else []
                texts.append("\n".join(t for (t, *_), y in zip(items, keep) if y))
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    return rows.mapInArrow(task, f"page_id {kinds[page_id]}, url {kinds[url]}, text string, n_chars long")
