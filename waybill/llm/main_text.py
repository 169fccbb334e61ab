"""The main text of web pages, by rules on blocks in two passes.

A block is the text between two block-level tags. The first pass decides what it can:

* blocks inside navigation, page header, footer, sidebar, form, script and the like, or inside an element whose class, id or role
  says so (advert, notice, comments, ...), are left out;
* a page that marks its article (``article``, ``main``) is taken at its word: what lies outside is left out;
* of the others, blocks that are mostly links are left out, and blocks that are long or rich in stop words are kept.

What is left is short, or long without stop words. The second pass gives it the label of the nearest decided block, of two at the same
distance the one that keeps it; a heading goes with the block that follows. Blocks that an element's name or class leaves out
are no neighbours. Without any neighbour a block is kept.

Character references are decoded, white space within a block is one space, blocks are joined by an empty line in page order; nothing
else is changed or left out, and whole pages are read, in time in proportion to their length. Markup that is never closed ends with
the page, as in browsers; a quote that is never closed ends with its tag. Null and empty pages give an empty text. Each row gives
one row; columns that are not named are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .chunks import slices

LONG = 140  # characters of a block that is not short
MOSTLY_LINKS = 0.5
STOP_DENSITY, LEAST_WORDS = 0.25, 5

# fixed values: function words of the four languages
STOP_WORDS = frozenset(
    """a about after all an and are as at be been but by can for from had has have he her his if in into is it its more no not of on one
    or our she so than that the their there they this to was we were what when which who will with would you
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa
    sans se ses son sont sur un une vous
    als am auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer es für hat ich im ist mit nach nicht noch
    nur oder sich sie sind so über um und von vor war wie wird zu zum zur
    al como con del el ella entre era ese esta este ha hay las lo los más me mi muy para pero por porque que si sin sobre su sus también
    una uno y ya""".split()
)
# fixed values: names of elements
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul""".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
# closed by the next of their kind
ENDS_BEFORE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}, "a": {"a"}}
LEFT_OUT = {
    "nav": "nav", "menu": "nav", "footer": "edge", "header": "header", "aside": "edge", "form": "hint", "fieldset": "hint", "button": "hint",
    "select": "hint", "noscript": "hint", "template": "hint", "svg": "hint", "dialog": "hint", "search": "hint", "head": "hint",
    "canvas": "hint", "audio": "hint", "video": "hint", "object": "hint",
}
ROLES = {
    "navigation": "nav", "menu": "nav", "menubar": "nav", "banner": "hint", "contentinfo": "edge", "complementary": "edge", "search": "hint",
    "form": "hint", "dialog": "hint", "alertdialog": "hint", "alert": "hint",
}
HINTS = frozenset(
    """ad ads adbox adslot advert advertisement advertising adverts banner sponsor sponsored sponsors promo promoted promotion
    sidebar sidebars rail widget widgets related recommended recommendations outbrain taboola nav navbar navigation navi menu
    menus submenu breadcrumb breadcrumbs masthead topbar footer colophon copyright cookie cookies consent gdpr notice notices alert alerts
    popup modal overlay lightbox newsletter subscribe subscription signup login signin register paywall share sharing social pagination pager
    toolbar skip searchbox searchform disclaimer""".split()
)
READERS = frozenset("comment comments commentlist commentform reply replies respond responses disqus discussion feedback guestbook".split())
ENTRIES = {"article", "main"}

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORDS = re.compile(r"[^\W\d_]+")
_RIGHTS = re.compile(r"^(©|\(c\)\s|copyright\b)|\ball rights reserved\b", re.IGNORECASE)


@dataclass
class Block:
    text: str
    link: int  # characters in links
    heading: bool
    scope: int  # number of the entry that holds it, 0 outside
    kind: str  # why its element is left out, or ""
    keep: bool | None = None


@dataclass
class Open:
    name: str
    kind: str
    scope: int
    link: bool = False


@dataclass
class Reader:
    """Cuts a page into blocks."""

    page: str
    blocks: list[Block] = field(default_factory=list)
    stack: list[Open] = field(default_factory=lambda: [Open("", "", 0)])
    pieces: list[str] = field(default_factory=list)
    links: int = 0
    heading: bool = False
    entries: int = 0
    open_now: Counter = field(default_factory=Counter)  # names and kinds on the stack, so that no search of it is in vain

    def read(self) -> list[Block]:
        page, at, pattern = self.page, 0, _TAG
        while True:
            to = page.find("<", at)
            if to < 0:
                self.text(page[at:])
                break
            if to > at:
                self.text(page[at:to])
            if page.startswith("<!--", to):
                # "<!-->" and "<!--->" are whole
                short = next((s for s in ("<!-->", "<!--->") if page.startswith(s, to)), None)
                end = to + len(short) if short else page.find("-->", to + 4)
                at = len(page) if end < 0 else end if short else end + 3
            elif page.startswith(("<!", "<?", "</"), to) and not page[to + 2:to + 3].isalpha() or page.startswith("<!", to):
                end = page.find(">", to)
                at = len(page) if end < 0 else end + 1
            elif not page[to + 1:to + 2].isalpha() and not page.startswith("</", to):
                self.text("<")
                at = to + 1
            else:
                tag = pattern.match(page, to)
                if tag is None and pattern is _TAG:
                    pattern = _LOOSE
                    tag = pattern.match(page, to)
                if tag is None:
                    break
                at = self.tag(bool(tag[1]), tag[2].lower(), tag[3], tag.end())
        self.flush()
        return self.blocks

    def text(self, raw: str) -> None:
        if raw:
            plain = html.unescape(raw) if "&" in raw else raw
            self.pieces.append(plain)
            if self.stack[-1].link:
                self.links += len(plain.strip())

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            top = self.stack[-1]
            self.blocks.append(Block(text, self.links, self.heading, top.scope, top.kind))
        self.pieces, self.links = [], 0

    def tag(self, closing: bool, name: str, rest: str, end: int) -> int:
        """Takes a tag in; where to read on."""
        if name == "br" or name in ("td", "th"):
            self.pieces.append(" ")
        block = name in BLOCKS
        if block:
            self.flush()
            self.heading = name in HEADINGS and not closing
        if closing:
            if self.open_now[name]:
                self.close(next(k for k in range(len(self.stack) - 1, 0, -1) if self.stack[k].name == name))
            return end
        if name in RAW:
            return self.after_raw(name, end)
        if name in VOID:
            return end
        if block and self.open_now["p"]:  # no paragraph holds a block
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].name == "p":
                    self.close(k)
                if self.stack[k - 1].name in BLOCKS and self.stack[k - 1].name != "p":
                    break
        ends = ENDS_BEFORE.get(name, ())
        if any(self.open_now[e] for e in ends):
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].name in ends:
                    self.close(k)
                    break
                if self.stack[k].name in BLOCKS:
                    break
        if name == "body" or name in ENTRIES:
            while self.open_now["head"] or self.open_now["kind nav"]:
                self.close(next(k for k in range(len(self.stack) - 1, 0, -1) if self.stack[k].kind == "nav" or self.stack[k].name == "head"))
        up = self.stack[-1]
        kind, entry = self.judge(name, rest, up)
        if not (block or name == "a" or kind != up.kind or name in LEFT_OUT):
            return end
        if rest.rstrip().endswith("/") and name in ("svg", "canvas"):
            return end
        if kind != up.kind and not block:
            self.flush()
        scope = up.scope
        if entry:
            self.entries += 1
            scope = self.entries
        self.stack.append(Open(name, kind, scope, up.link or name == "a"))
        self.open_now.update((name, f"kind {kind}"))
        return end

    def close(self, k: int) -> None:
        if any(o.kind != self.stack[k - 1].kind for o in self.stack[k:]):
            self.flush()
        for o in self.stack[k:]:
            self.open_now.subtract((o.name, f"kind {o.kind}"))
        del self.stack[k:]

    def after_raw(self, name: str, at: int) -> int:
        """The place after the end of an element whose content is no markup."""
        found = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(self.page, at)
        if not found:
            return len(self.page)
        end = self.page.find(">", found.end())
        return len(self.page) if end < 0 else end + 1

    def judge(self, name: str, rest: str, up: Open) -> tuple[str, bool]:
        """Why the element is left out, if it is, and whether it marks an article."""
        kind = LEFT_OUT.get(name, "")
        if kind == "header" and up.scope:
            kind = ""  # of the article
        entry = name in ENTRIES
        if rest.strip():
            values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)}
            role = values.get("role", "").lower()
            entry = entry or role in ENTRIES or values.get("itemprop") == "articleBody"
            kind = kind or ROLES.get(role, "")
            if "hidden" in values:
                kind = kind or "hint"
            if name not in ("html", "body"):
                before = ""
                for part in _PARTS.findall(f"{values.get('class', '')} . {values.get('id', '')}"):
                    part = part.lower()
                    if before not in ("has", "with", "no"):
                        if part in READERS:
                            kind, entry = "readers", False
                        elif part in HINTS and not entry:
                            kind = kind or "hint"
                    before = part
        if entry and up.kind in ("edge", "readers"):
            entry = False
        if entry:
            return "", not up.scope
        return kind or up.kind, False


def stop_density(words: list[str]) -> float:
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def classify(blocks: list[Block]) -> None:
    """Decides which blocks are kept."""
    marked = any(b.scope and not b.kind for b in blocks)
    for b in blocks:
        if b.kind or (marked and not b.scope):
            b.keep = False
            continue
        words = _WORDS.findall(b.text.lower())
        if b.link > MOSTLY_LINKS * len(b.text) and not b.heading or not b.scope and _RIGHTS.search(b.text):
            b.keep = False
        elif not b.heading and len(words) >= LEAST_WORDS and stop_density(words) >= STOP_DENSITY:
            b.keep = True
        elif b.scope and len(b.text) >= LONG:
            b.keep = True
    open_ones = [b for b in blocks if not b.kind and not (marked and not b.scope)]
    decided = [b.keep for b in open_ones]
    n = len(decided)
    before: list[tuple[int, bool | None]] = []  # distance and label of the last decided block
    last: tuple[int, bool | None] = (n + 1, None)
    for keep in decided:
        last = (0, keep) if keep is not None else (last[0] + 1, last[1])
        before.append(last)
    last = (n + 1, None)
    for i in range(n - 1, -1, -1):
        last = (0, decided[i]) if decided[i] is not None else (last[0] + 1, last[1])
        if decided[i] is not None:
            continue
        (back, left), (ahead, right) = before[i], last
        if open_ones[i].heading and right is not None:
            open_ones[i].keep = right
        elif left is None or right is None:
            open_ones[i].keep = True if left is right is None else left if right is None else right
        else:
            open_ones[i].keep = left if back < ahead else right if ahead < back else left or right


def main_text(page: str) -> str:
    blocks = Reader(page).read()
    classify(blocks)
    return "\n\n".join(b.text for b in blocks if b.keep)


def extract(pages: DataFrame, *, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The columns ``keep``, then text and n_chars of each page."""
    rows = pages.select(*[pages[c].alias(f"k{i}") for i, c in enumerate(keep)], pages[html_col].alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(p) if p else "" for p in batch.column("html").to_pylist()]
            yield pa.record_batch(
                [*batch.columns[:len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*(f"k{i}" for i in range(len(keep))), "text", "n_chars"])

    kinds = ", ".join(f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(rows.schema.fields[:-1]))
    found = rows.mapInArrow(run, f"{kinds}, text string, n_chars bigint")
    return found.select(*[found[f"k{i}"].alias(c) for i, c in enumerate(keep)], "text", "n_chars")
