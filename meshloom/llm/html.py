"""Main text of web pages: flat text blocks, described by their own and their neighbours' figures, classified by a decision tree.

A page becomes a flat list of text blocks. A block's features are its words and link density and those of
the two blocks on either side, with a few cues of the elements around it beside them. The tree learns from
the blocks of a small table of labelled pages, whose noise names itself in tags and classes only in part and
whose articles and wrappers have names of that kind too: what a name says counts by its share of the name, and
not at all on an element that holds most of the page's text.
"""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, small_batches

#: Fixed values of the HTML standard: elements that end a block, hold text that isn't shown or have no content.
BLOCK_TAGS = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td template textarea tfoot th thead title tr ul xmp".split())
RAW_TAGS = frozenset("script style textarea title iframe noembed noframes template".split())
#: Of those, the ones that run to the end of the page if they aren't closed.
SWALLOWING = RAW_TAGS - {"template"}
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements, and words in class or id of containers, that speak for or against article text; features of the tree, not rules.
NOISE_TAGS = frozenset("nav aside footer form button dialog menu head fieldset search label select datalist noscript audio video canvas".split())
CONTAINERS = frozenset("div section aside ul ol dl li table span article main figure form center details".split())
NOISE_WORDS = re.compile(
    r"(?:ads?|advert\w*|adsense|banner|promo\w*|sponsor\w*|nav\w*|menu|sidebar|aside|footer|foot|masthead|topbar|breadcrumbs?|cookies?|consent|notice|popup|modal|overlay|newsletter|subscribe|signup|login|related|recommend\w*|share|sharing|social|widget|comment\w*|replies|reply|respond|disqus|pagination|pager|tags?|toolbar|skip|hidden|copyright|legal|disclaimer|alert|search)$",
    re.I,
)
#: Words that say nothing about what a container holds.
PLAIN_WORDS = re.compile(r"(?:list|box|area|wrap(?:per)?|container|block|items?|body|content|bar|buttons?|links?|posts?|stor(?:y|ies)|articles?|news|text|form|inner|outer|main|page|site|col(?:umn)?|row|section|group|panel|unit|slot|top|bottom|left|right|header|title|thread|policy|sticky|global|primary|secondary|js|[a-z]?\d*)$", re.I)
_HEADER = re.compile(r"(?:^|[\s_-])(?:page|site|main|top)?-?header(?:$|[\s_-])", re.I)
ROLES = re.compile(r"^(?:navigation|banner|contentinfo|complementary|search|form|dialog|alert|alertdialog|menu|menubar|toolbar)$", re.I)

_TAG = re.compile(r"<(?:(?P<comment>!--)|(?P<bang>[!?])|(?P<end>/)?(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>)")
_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW_TAGS}
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(eq=False)
class _Open:
    """An element: what its tag and names say, and the words outside links below it."""

    name: str
    noise: float
    article: bool
    header: bool
    hidden: bool
    plain: int = 0
    holds_article: bool = False

    @property
    def told(self) -> bool:
        return bool(self.noise or self.article or self.header)


def name_strength(names: str) -> float:
    """How much of the name that says most is about page furniture: 1 for `comment-list`, 0.5 for `share-price`, 0 for `story`."""
    best = 0.0
    for name in names.split():
        parts = [w for w in re.split(r"[_-]+|(?<=[a-z])(?=[A-Z])", name) if w and not PLAIN_WORDS.match(w)]
        if parts:
            best = max(best, sum(bool(NOISE_WORDS.match(w)) for w in parts) / len(parts))
    return best


@dataclass
class Block:
    text: str
    words: int
    linked: int
    heading: bool
    inside: tuple[_Open, ...]  # the elements around it that say something
    article: bool = False
    noise: float = 0.0
    header: bool = False

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


@dataclass
class _State:
    stack: list[_Open] = field(default_factory=list)
    links: int = 0
    pieces: list[tuple[str, bool]] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    heading: bool = False

    def close_block(self) -> None:
        if not self.pieces:
            return
        text = " ".join("".join(t for t, _ in self.pieces).split())
        if text:
            linked = sum(len(t.split()) for t, inside in self.pieces if inside)
            told = tuple(e for e in self.stack if e.told)
            for e in told:
                e.plain += len(text.split()) - linked
            self.blocks.append(Block(text, len(text.split()), linked, self.heading, told))
        self.pieces.clear()


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)} if rest.strip() else {}


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page in order. Character references are decoded; white space (of Unicode, no-break spaces too) is one space; scripts, styles, comments and hidden elements are left out. Unclosed and stray tags are tolerated."""
    s, at, n = _State(), 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            s.pieces.append((html.unescape(page[at:lt]), s.links > 0))
        if lt == n:
            break
        m = _TAG.match(page, lt)
        if not m:
            if lt + 1 < n and (page[lt + 1].isascii() and page[lt + 1].isalpha() or page[lt + 1] == "/"):
                gt = page.find(">", lt)  # a broken tag ends at the next bracket
                at = n if gt < 0 else gt + 1
            else:
                s.pieces.append(("<", s.links > 0))
                at = lt + 1
            continue
        if m["comment"]:
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if m["bang"]:
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        at, name = m.end(), m["name"].lower()
        if m["end"]:
            if name in BLOCK_TAGS:
                s.close_block()
            if name == "a":
                s.links = max(0, s.links - 1)
            if name in ("h1", "h2", "h3", "h4", "h5", "h6"):
                s.heading = False
            for k in range(len(s.stack) - 1, -1, -1):
                if s.stack[k].name == name:
                    del s.stack[k:]
                    break
            continue
        if name in BLOCK_TAGS:
            s.close_block()
        found = _attributes(m["rest"])
        if name in RAW_TAGS and not m["rest"].endswith("/"):
            end = _END[name].search(page, at)
            if end or name in SWALLOWING:
                at = end.end() if end else n
                continue
        if name == "a":
            s.links = 1
        if name in ("h1", "h2", "h3", "h4", "h5", "h6"):
            s.heading = True
        if name in VOID_TAGS or m["rest"].endswith("/"):
            continue
        hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(found.get("style", "")))
        named = f"{found.get('class', '')} {found.get('id', '')}".strip()
        article = name in ("article", "main") or found.get("role", "").lower() in ("main", "article")
        noise = name_strength(named) if named and name in CONTAINERS else 0.0
        if hidden or not article and (name in NOISE_TAGS or ROLES.match(found.get("role", ""))):
            noise = 1.0
        if article:
            for e in s.stack:
                e.holds_article = True
        if name == "p":  # a paragraph ends the one before it
            for k in range(len(s.stack) - 1, -1, -1):
                if s.stack[k].name == "p":
                    del s.stack[k]
                    break
                if s.stack[k].name in BLOCK_TAGS:
                    break
        s.stack.append(_Open(name, noise, article, name == "header" or name in CONTAINERS and bool(_HEADER.search(named)), hidden))
    s.close_block()
    _settle(s.blocks)
    return s.blocks


def _settle(found: list[Block]) -> None:
    """article, noise and header of each block, now that the page is known.

    What is said by the name or tag of an element that holds most of the page's words outside links doesn't count:
    it is a wrapper, if its name says other things too, it is a form, or it holds an article element.
    """
    whole = sum(b.words - b.linked for b in found)

    def counts(e: _Open) -> float:
        wrapper = not e.hidden and 2 * e.plain >= whole and (e.noise < 1 or e.name == "form" or e.holds_article or e.article)
        return 0.0 if wrapper else e.noise

    for b in found:
        said = [counts(e) for e in b.inside]
        b.noise = max(said, default=0.0)
        article = [e.article and n < 1 for e, n in zip(b.inside, said, strict=True)]
        inner = max((k for k, a in enumerate(article) if a), default=-1)
        b.article = inner >= 0
        header = [e.header and 2 * e.plain < whole for e in b.inside]
        b.header = any(header) if inner < 0 else any(header[:inner])


FEATURES = (
    "words", "density", "before_words", "before_density", "after_words", "after_density", "before2_words", "before2_density", "after2_words", "after2_density",
    "near_text", "place", "noise", "header", "heading",
)


def features(found: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block: words and link density of its own and of the two blocks on either side, the words without links in those five, and the cues.

    place is 1 inside and -1 outside article elements, if these hold at least half of the page's words outside
    links and noise, else 0: a teaser in one doesn't make it the page's text.
    """
    own = np.array([(b.words, b.density) for b in found], float).reshape(-1, 2)
    wide = np.vstack([np.zeros((2, 2)), own, np.zeros((2, 2))])
    before, after, before2, after2 = (wide[k : k + len(own)] for k in (1, 3, 0, 4))
    near = sum(x[:, :1] * (1 - x[:, 1:]) for x in (own, before, after, before2, after2))
    cues = np.array([(b.article, b.noise, b.header, b.heading) for b in found], float).reshape(-1, 4)
    plain = (own[:, 0] * (1 - own[:, 1])) * (cues[:, 1] < 1) * (1 - cues[:, 2])
    share = float((plain * cues[:, 0]).sum() / plain.sum()) if plain.sum() else float(cues[:, 0].any())
    place = (2 * cues[:, :1] - 1) * (share >= 0.5)
    return np.hstack([own, before, after, before2, after2, near, place, cues[:, 1:]])


_FURNITURE = ("ad", "advert", "banner", "promo", "nav", "menu", "sidebar", "footer", "notice", "cookie", "newsletter", "login", "related", "share", "social", "comments", "comment", "reply", "tag", "search", "widget", "copyright", "popup")


def labelled_page(seed: int) -> str:
    """A page of the labelled table: words of its article begin with m, all others with n.

    Its article stands in an article or main element, in a named or nameless division or in a table
    cell, some with names that are in part about furniture, as are those of sections and wrappers; menus, adverts, notices, teasers, comments and footers are named as such or not.
    """
    r = random.Random(seed)

    def words(n: int, first: str) -> str:
        return " ".join(first + "".join(r.choices("aeiloprst", k=r.randint(1, 9))) for _ in range(n))

    def links(n: int, low: int, high: int, first: str = "n") -> str:
        return "<ul>" + "".join(f"<li><a href=/x>{words(r.randint(low, high), first)}</a></li>" for _ in range(n)) + "</ul>"

    def half(word: str = "") -> str:
        """A name of which a part only is about furniture, as articles, wrappers and furniture all have."""
        other = "".join(r.choices("bcdfgkmvz", k=4)) + r.choice("aeiou")
        parts = [word or r.choice(_FURNITURE), other, *[other[::-1]] * (r.random() < 0.3)]
        r.shuffle(parts)
        return r.choice("-_").join(parts)

    def box(inner: str, tag: str, name: str, told: float = 0.6) -> str:
        if r.random() < told:
            name = half(name) if r.random() < 0.15 and name != "comments" else name
            return f"<{tag}>{inner}</{tag}>" if tag != "div" and r.random() < 0.5 else f'<div class="{name}">{inner}</div>'
        return f'<div class="c{r.randint(1, 9)}">{inner}</div>'

    def advert(told: float) -> str:
        return box(words(r.randint(3, 20), "n") if r.random() < 0.6 else f"<a href=/y>{words(r.randint(3, 8), 'n')}</a>", "div", r.choice(("ad", "promo", "sponsor-box", "notice")), told)

    def paragraph(brief: bool = False) -> str:
        kind = 0.1 if brief else r.random()
        if kind < 0.03:
            return f"<p><a href=/z>{words(r.randint(1, 8), 'm')}</a></p>"
        n = r.randint(1, 3) if kind < 0.2 else r.randint(4, 12) if kind < 0.4 else r.randint(13, 60) if kind < 0.85 else r.randint(61, 300)
        linked = r.randint(1, max(1, n // 4)) if n > 4 and r.random() < 0.3 else 0
        text = words(n - linked, "m") + (f" <a href=/z>{words(linked, 'm')}</a>" if linked else "")
        return f"<p>{text}</p>" if r.random() < 0.95 else f"<blockquote>{text}</blockquote>"

    def body() -> str:
        out = [f"<h1>{words(r.randint(1, 25), 'm')}</h1>"] if r.random() < 0.9 else []
        brief = r.random() < 0.15  # all paragraphs of a few words
        for _ in range(r.randint(6, 30) if brief else r.choice((1, 1, 2, 3, 5, 8, 12))):
            out.append(paragraph(brief))
            chance = r.random()
            if chance < 0.1:
                out.append(f"<h2>{words(r.randint(1, 7), 'm')}</h2>{paragraph()}")
            elif chance < 0.16:
                out.append("<ul>" + "".join(f"<li>{words(r.randint(2, 14), 'm')}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
            elif chance < 0.24:
                out.append(advert(1.0))
            elif chance < 0.34:  # parts of an article have such names too
                out.append(f'<{(tag := r.choice(("div", "section", "ul")))} {r.choice(("class", "id"))}="{half()}">{"".join(f"<li>{words(r.randint(2, 14), 'm')}</li>" for _ in range(r.randint(2, 6))) if tag == "ul" else paragraph() + (paragraph() if r.random() < 0.5 else "")}</{tag}>')
        return "".join(out)

    kind = r.choice(("article",) * 6 + ("main",) * 2 + ("content",) * 3 + ("plain",) * 4 + ("table",) * 2)
    comments = box("".join(f"<div><b>{words(1, 'n')}</b><p>{words(r.randint(5, 60), 'n')}</p></div>" for _ in range(r.randint(1, 6))), "div", "comments", 1.0) if r.random() < 0.4 else ""
    inner = body()
    named = f' class="post {half()}"' if r.random() < 0.3 else ""
    if kind in ("article", "main"):
        text = f"<{kind}{named}>{inner}{comments if r.random() < 0.4 else ''}</{kind}>{comments if r.random() < 0.5 else ''}"
    else:
        text = {"content": f'<div class="content">{inner}</div>', "plain": f"<div{named}>{inner}</div>", "table": f"<table><tr><td>{inner}</td></tr></table>"}[kind] + comments
    name = words(r.randint(1, 4), "n")
    title = r.choice((f"<a href=/>{name}</a>", f"<h1>{name}</h1>", f"<h1><a href=/>{name}</a></h1>", f"<p>{name}</p>"))
    head = box(title + (f"<p>{words(r.randint(2, 15), 'n')}</p>" if r.random() < 0.4 else ""), "header", "page-header", 0.8) if r.random() < 0.6 else ""
    menu = box(links(r.randint(1, 10), 1, 2), "nav", "menu") if r.random() < 0.85 else ""
    side = box(links(r.randint(1, 8), 1, 10), "aside", "sidebar") if r.random() < 0.5 else ""
    if kind not in ("article", "main") and inner.count(" ") > 60 and r.random() < 0.4:  # beside a longer text
        side += f"<article><h3><a href=/t>{words(r.randint(3, 8), 'n')}</a></h3>" + (f"<p>{words(r.randint(4, 12), 'n')}</p>" if r.random() < 0.5 else "") + "</article>"
    form = f"<form><label>{words(r.randint(1, 3), 'n')}</label><input><button>{words(1, 'n')}</button></form>" if r.random() < 0.3 else ""
    foot = box(words(r.randint(3, 25), "n") + (links(r.randint(1, 5), 1, 3) if r.random() < 0.5 else ""), "footer", "footer", 0.8) if r.random() < 0.6 else links(r.randint(1, 4), 1, 3) if r.random() < 0.4 else ""
    page = f"{head}{menu}{advert(0.7) if r.random() < 0.4 else ''}{text}{side}{form}{foot}"
    if r.random() < 0.3:
        page = f'<div {r.choice(("class", "id"))}="{half()}">{page}</div>' if r.random() < 0.8 else f"<form id=all>{page}</form>"
    return f"<html><head><title>n</title></head><body>{page}</body></html>"


#: Pages of the labelled table.
PAGES = 1200


def labelled_blocks(seeds=range(PAGES)) -> tuple[np.ndarray, np.ndarray]:
    """The features of all blocks of the labelled pages, and 1 for article text."""
    found = [blocks(labelled_page(seed)) for seed in seeds]
    return np.vstack([features(f) for f in found]), np.array([b.text[0] == "m" for f in found for b in f], float)


@dataclass(frozen=True)
class Node:
    share: float
    feature: int = -1
    threshold: float = 0.0
    low: Node | None = None
    high: Node | None = None


def _bits(ones: np.ndarray, n: np.ndarray) -> np.ndarray:
    """n times the entropy of a share ones / n."""
    x = np.stack([ones, n - ones]).astype(float)
    return (x * (np.log2(np.maximum(n, 1)) - np.log2(np.maximum(x, 1)))).sum(axis=0)


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 16, least: int = 2) -> Node:
    """A decision tree by information gain, less the bits that name a threshold (so cues of few values win close calls and no split is made for a few rows); of equal splits the first feature and least threshold."""
    share, n = float(y.mean()), len(y)
    if depth == 0 or share in (0.0, 1.0):
        return Node(share)
    best, sizes = (1e-9, -1, 0.0), np.arange(1, n)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        step = v[1:] != v[:-1]
        gain = _bits(ones[-1:], np.array([n]))[0] - _bits(ones[:-1], sizes) - _bits(ones[-1] - ones[:-1], n - sizes) - np.log2(max(1, step.sum()))
        gain[~step | (np.minimum(sizes, n - sizes) < least)] = -np.inf
        at = int(np.argmax(gain)) if n > 1 else 0
        if n > 1 and gain[at] > best[0] + 1e-9:
            best = (float(gain[at]), f, float((v[at] + v[at + 1]) / 2))
    if best[1] < 0:
        return Node(share)
    low = x[:, best[1]] <= best[2]
    return Node(share, best[1], best[2], train_tree(x[low], y[low], depth - 1, least), train_tree(x[~low], y[~low], depth - 1, least))


@lru_cache(maxsize=1)
def default_tree() -> Node:
    return train_tree(*labelled_blocks())


def _shares(tree: Node, x: np.ndarray) -> np.ndarray:
    out = np.full(len(x), tree.share)
    if tree.feature >= 0:
        low = x[:, tree.feature] <= tree.threshold
        out[low], out[~low] = _shares(tree.low, x[low]), _shares(tree.high, x[~low])
    return out


def main_texts(pages: list[str | None], tree: Node | None = None) -> list[str]:
    """The blocks of each page classified as article text, in page order, joined by one space; empty if there are none or the page is null."""
    found = [blocks(p) if p else [] for p in pages]
    some = [features(f) for f in found if f]
    good = iter(_shares(tree or default_tree(), np.vstack(some)) > 0.5) if some else iter(())
    return [" ".join([b.text for b in f if next(good)]) for f in found]


def main_text(page: str | None, tree: Node | None = None) -> str:
    return main_texts([page], tree)[0]


def extract_text(pages: DataFrame, html_col: str = "html", tree: Node | None = None) -> DataFrame:
    """The same rows without html_col, with text and n_chars, its code points (columns of those names in pages are replaced).

    The whole page is read, whatever its length; null, empty and textless pages give an empty text.
    Repeated rows stay, equal pages give equal texts. Row by row, no shuffle.
    """
    small_batches(pages.sparkSession)
    kept = [c for c in pages.columns if c not in ("text", "n_chars", html_col)]
    tree = tree or default_tree()

    def run(batches):
        for batch in batches:
            texts = main_texts(batch.column(len(kept)).to_pylist(), tree)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [*kept, "text", "n_chars"])

    asked = pages.select(*[F.col(c) for c in kept], F.col(html_col).alias("_html"))
    schema = asked.drop("_html").withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema
    return asked.mapInArrow(run, schema)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
