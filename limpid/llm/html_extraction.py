"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the page.

A page is read once into blocks: the text between two block-level tags, with the tags and class names it
stands in.  The chain labels blocks from these and from the text's form; Viterbi picks the labels, and the
blocks labelled main make the text.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Container, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm import crf
from limpid.llm.labelled_pages import labelled_pages

#: Labelled pages made for training.
TRAINING_PAGES = 900
#: Blocks of a page that are scored at once.
ROWS = 4096
#: Elements by how a browser lays them out.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr "
                   "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms "
                   "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: All up to the end tag is text that isn't shown, or up to the end of the page without one.
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in "script style title textarea iframe noembed noframes xmp".split()}
#: What stands between these tags isn't shown; without its end tag, such an element hides nothing.
UNSEEN = frozenset("noscript template select button svg object audio video canvas annotation annotation-xml".split())
#: In these, an opening tag that ends in a slash is closed.
FOREIGN = frozenset(("svg", "math"))
#: An opening tag ends these open elements by itself.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
#: Where the search for an element to end by itself stops.
SCOPES = frozenset("ul ol dl table tbody body html article section div main td th".split())

#: Where markup begins; what is no tag is known to its end at once.
START = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)", re.S | re.I)
STOP = re.compile(r"[\"'>]")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]{2,}")
DIGIT = re.compile(r"[0-9]")
#: Character numbers too long to be any character, which the decoder of references refuses.
HUGE = re.compile(r"&#([0-9]{1000,});?")


def unescaped(text: str) -> str:
    return entities.unescape(HUGE.sub(lambda m: f"&#{n};" if len(n := m[1].lstrip("0") or "0") < 8 else "\ufffd", text))


class Tags:
    """The tags of a page from left to right, in time that grows with the page alone.

    A tag ends at the first ``>`` outside quotes; one that doesn't end so is text.  Quotes from which no end was found
    are remembered, so that no later beginning looks behind them again.
    """

    def __init__(self, html: str):
        self.html, self.last, self.hopeless = html, html.rfind(">"), set()

    def end(self, at: int) -> int:
        """Where the ``>`` stands that ends a tag whose attributes begin there, or -1."""
        seen = []
        while at <= self.last:
            stop = STOP.search(self.html, at)
            at = stop.start()
            if stop[0] == ">":
                return at
            if at in self.hopeless:
                break
            seen.append(at)
            at = self.html.find(stop[0], at + 1) + 1
            if not at:
                break
        self.hopeless.update(seen)
        return -1

    def __iter__(self) -> Iterator[tuple[int, int, str | None, str, str]]:
        """Start and end of what is no text, with the tag (None for comments), its slash and its attributes."""
        self.at = 0
        look = 0
        while token := START.search(self.html, look):
            if token["tag"] is None:
                self.at = look = token.end()
                yield token.start(), look, None, "", ""
                continue
            close = self.end(token.end())
            if close < 0:
                look = token.start() + 1
                continue
            self.at = look = close + 1
            yield token.start(), look, token["tag"].lower(), token["end"], self.html[token.end():close]
            look = self.at  # the reader may have gone on to the end of raw text


class Block:
    __slots__ = ("text", "inside", "at", "linked", "main")

    def __init__(self, text: str, place: Place, linked: int):
        self.text, self.inside, self.at, self.linked, self.main = text, place.inside, place.at, linked, place.main


class Place:
    """What a block inherits from its open elements; elements that add nothing new share one set.

    ``inside``: signs of tags and names; ``at``: the innermost element that isn't inline; ``inline``: inline elements open
    since then; ``near``: elements that an opening tag could end; ``foreign`` and ``main``: whether one such is open.
    """

    __slots__ = ("inside", "at", "inline", "near", "foreign", "main")

    def __init__(self):
        self.inside = self.inline = self.near = frozenset()
        self.at, self.foreign, self.main = "", False, False

    def within(self, tag: str, names: frozenset[str], known: Container[str] | None) -> Place:
        new = Place()
        inline = tag in INLINE
        signs = {f"name {w}" for w in names}
        if not inline and tag != "main-text":
            signs.add(f"in {tag}")
        if known is not None:
            signs = {s for s in signs if s in known}
        new.inside = self.inside if signs <= self.inside else self.inside | signs
        new.at = self.at if inline or tag == "main-text" else tag
        new.inline = (self.inline if tag in self.inline else self.inline | {tag}) if inline else frozenset()
        near = frozenset() if tag in SCOPES or tag in UNSEEN else self.near
        new.near = near | {tag} if tag in ENDABLE and tag not in near else near
        new.foreign, new.main = self.foreign or tag in FOREIGN, self.main or tag == "main-text"
        return new


ENDABLE = frozenset({"p"}.union(*ENDS.values()))
NOWHERE = Place()


def _names(attributes: str) -> frozenset[str]:
    return _few_names(attributes) if len(attributes) < 500 else _few_names.__wrapped__(attributes)


@lru_cache(4096)
def _few_names(attributes: str) -> frozenset[str]:
    found = " ".join(a or b or c for a, b, c in NAMES.findall(attributes)).lower()
    return frozenset(w[:-1] if len(w) > 3 and w.endswith("s") else w for w in WORDS.findall(found))


def blocks(html: str, known: Container[str] | None = None) -> list[Block]:
    """Leaf blocks in page order; blocks without text are left out.  Only ``known`` signs are noted, if given."""
    out: list[Block] = []
    open_: list[tuple[str, Place]] = []
    opened: Counter[str] = Counter()
    run: list[str] = []
    linked = 0
    #: Of every open unseen element: its place in open_, and the run, the linked characters and the blocks before it.
    aside: list[tuple[int, list[str], int, int]] = []

    def place(depth: int) -> Place:
        return open_[depth - 1][1] if depth else NOWHERE

    def block(parts: list[str], depth: int, own_linked: int) -> list[Block]:
        text = " ".join("".join(parts).split())
        return [Block(text, place(depth), own_linked)] if text else []

    def flush() -> None:
        nonlocal linked
        if run:
            out.extend(block(run, len(open_), linked))
            run.clear()
        linked = 0

    def enter(tag: str, attributes: str) -> None:
        open_.append((tag, place(len(open_)).within(tag, _names(attributes) if attributes else frozenset(), known)))
        opened[tag] += 1

    def close(n: int, ended: bool = False) -> None:
        """Close the open elements from n on; ``ended``: the n-th by its own end tag, which is what hides it."""
        nonlocal run, linked
        while aside and aside[-1][0] >= n:
            where, before, before_linked, count = aside.pop()
            if ended and where == n:
                del out[count:]
                run, linked = before, before_linked
            else:  # what closes others has ended the run
                out[count:count] = block(before, where, before_linked)
        opened.subtract(tag for tag, _ in open_[n:])
        del open_[n:]

    at = 0
    tags = Tags(html)
    for start, at_end, tag, slash, attributes in tags:
        if start > at:
            text = unescaped(html[at:start])
            run.append(text)
            if opened["a"]:
                linked += len(text)
        at = at_end
        if tag is None:
            continue
        named = not attributes or attributes[0] in " \t\n\r\f/"
        if named and not slash and tag in RAW:
            if not (attributes.endswith("/") and place(len(open_)).foreign):
                end = RAW[tag].search(html, at)
                close_at = html.find(">", end.end()) if end else -1
                at = tags.at = close_at + 1 if close_at >= 0 else len(html)
            continue
        if named and not slash and tag in UNSEEN:
            if not attributes.endswith("/"):
                aside.append((len(open_), run, linked, len(out)))
                run, linked = [], 0
                enter(tag, attributes)
            continue
        if slash:
            n = -1
            # an inline element is closed only if nothing but inline ones opened since
            if opened[tag] and (tag not in INLINE or tag in place(len(open_)).inline):
                n = next(k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == tag)
            if tag not in INLINE and (n < 0 or tag not in UNSEEN):
                flush()
            if n >= 0:
                close(n, ended=True)
            if tag in ("br", "mtd", "mtr"):
                run.append(" ")
            continue
        if tag not in INLINE:
            flush()
        elif tag in ("br", "mtd", "mtr"):
            run.append(" ")
        if tag in VOID or attributes.endswith("/"):
            continue
        ends = ENDS.get(tag, frozenset()) if tag in INLINE or tag in ENDS else frozenset("p") if tag != "main-text" else frozenset()
        if ends & place(len(open_)).near:
            close(next(k for k in range(len(open_) - 1, -1, -1) if open_[k][0] in ends))
        enter(tag, attributes)
    rest = html[at:]
    if rest:
        run.append(unescaped(rest))
        linked += len(rest) if opened["a"] else 0
    flush()
    close(0)
    return out


class Features:
    """Numbers of the signs seen in training; unknown tags and names count for nothing."""

    SHAPE = 16

    def __init__(self, pages: list[list[Block]]):
        seen: dict[str, int] = {}
        for page in pages:
            for sign in {s for b in page for s in self.signs(b)}:
                seen[sign] = seen.get(sign, 0) + 1
        self.column = {s: n for n, s in enumerate(sorted(s for s, c in seen.items() if c > 2), self.SHAPE)}
        self.width = self.SHAPE + len(self.column)

    @staticmethod
    def signs(block: Block) -> set[str]:
        return block.inside | {f"at {block.at}"} if block.at else set(block.inside)

    @staticmethod
    def shape(block: Block) -> list[float]:
        text, n = block.text, len(block.text)
        words = text.count(" ") + 1
        share = min(1.0, block.linked / n)
        return [1.0, min(words, 60) / 60, words < 3, words < 8, words > 20, share, share > 0.5, share > 0.9,
                text[-1] in ".!?…\"”:", text.count(",") / words, bool(DIGIT.search(text)) or not text.isascii() and any(map(str.isdigit, text)),
                "©" in text or "copyright" in text.lower()]

    def matrix(self, page: list[Block], start: int = 0, stop: int | None = None) -> np.ndarray:
        part = page[start:stop]
        out = np.zeros((len(part), self.width))
        for n, block in enumerate(part):
            shape = self.shape(block)
            out[n, :len(shape)] = shape
            out[n, 13], out[n, 14] = start + n == 0, start + n == len(page) - 1
            for sign in self.signs(block):
                column = self.column.get(sign)
                if column is not None:
                    out[n, column] = 1
        return out


class Extractor:
    def __init__(self, pages: list[str]):
        found = [p for p in map(blocks, pages) if p]
        self.features = Features(found)
        self.chain = crf.train([self.features.matrix(p) for p in found],
                               [np.array([int(b.main) for b in p]) for p in found], rounds=16, rate=0.2)

    def texts(self, pages: list[str]) -> list[str]:
        found = [blocks(p, self.features.column) for p in pages]
        # long pages are scored in parts; the chain then only has two numbers a block to decide on
        scores = [np.concatenate([self.features.matrix(p, n, n + ROWS) @ self.chain.weights for n in range(0, len(p), ROWS)])
                  if p else np.zeros((0, 2)) for p in found]
        labels = crf.Chain(np.eye(2), self.chain.moves, self.chain.first).viterbi(scores)
        return ["\n".join(b.text for b, main in zip(p, y) if main) for p, y in zip(found, labels)]


@lru_cache(1)
def trained(pages: int = TRAINING_PAGES) -> Extractor:
    return Extractor(labelled_pages(pages))


def _extracted(extractor: Extractor):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 100):
                part = whole.slice(start, 100)
                made = pa.array(extractor.texts(part.column("html").to_pylist()), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], made], names=[*part.schema.names[1:], "made"])
    return run


def extract(df: DataFrame, html_column: str, text_column: str = "text", extractor: Extractor | None = None) -> DataFrame:
    """Add the main text of every whole page: its main blocks in order, joined by line breaks.

    A missing or empty page, or one without main blocks, gives an empty text.  Broken markup is read as far as
    it goes, in time that grows with the page: a tag without an end is text.  Repeated rows stay, an empty table stays empty, other columns pass; a column of the new name raises.
    """
    if text_column in df.columns:
        raise ValueError(f"column {text_column} is there already")
    own = [f"c{n}" for n in range(len(df.columns))]
    read = df.select(F.coalesce(F.col(html_column), F.lit("")).alias("html"),
                     *[df[c].alias(o) for c, o in zip(df.columns, own)])
    read = read.drop(own[df.columns.index(html_column)])
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in read.schema.fields[1:])
    out = read.mapInArrow(_extracted(extractor or trained()), f"{kinds}made string")
    return out.select(*[F.col(o).alias(c) for c, o in zip(df.columns, own) if c != html_column],
                      F.col("made").alias(text_column))
