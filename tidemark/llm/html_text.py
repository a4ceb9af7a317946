"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of block elements; runs of text between block borders
are its leaves. Each node is content or not. The model has a potential of each
node's own features (words of its class and id, length and links of its text)
and one between parent and child, by the child's tag. Messages are summed upward and
downward over the trees of a whole batch, level by level, which yields the
exact probability of content for every node. Leaves above one half are the
text, in page order.

Potentials are counted from labelled pages: in labelled HTML, the elements
marked ``data-content="1"`` or, where nothing is marked, a page's own
``article`` or ``main`` without its known foreign parts. At most ``limit``
pages of a table are learned from; all are extracted.

Defined cases: null and empty html, and html without content, give the empty
text; html without tags is one leaf; unclosed and stray tags are borne;
repeated rows get equal results; other columns stay, but those with names of
the results are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import ast
import html as entities
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from tidemark.llm.common import with_block_columns

# Elements whose content is no markup, elements whose text is
# never read, of these the ones that hold no blocks, elements of a head,
# elements without an end, elements that stand within a line, and those that a
# new block ends.
RAW = "script style textarea title"
SILENT = "head template select datalist optgroup option button title"
SILENT_INLINE = "select datalist optgroup option button"
OF_HEAD = "base link meta noscript script style template title"
VOID = "area base br col embed hr img input link meta param source track wbr"
INLINE = (
    "a abbr b bdi bdo big br cite code data dfn em font i img ins del kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr input math mi mn mo mrow ms mtext msup msub msubsup mfrac msqrt mroot mover munder "
    "munderover semantics annotation svg g text tspan object canvas iframe"
)
ENDS_PARAGRAPH = (
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p "
    "pre section table ul"
)
# Elements that a sibling of their own kind ends.
SIBLINGS = {
    "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "p": "p",
    "option": "option", "optgroup": "option optgroup", "button": "button", "select": "select",
}
# Elements nested deeper hang at this depth, as in browsers; their text is read all the same.
DEEPEST = 512

# Words of class, id and role, by what they say about an element.
KINDS = {
    "advert": "ad ads advert adverts advertisement banner sponsor sponsored promo promoted",
    "comment": "comment comments reply replies discussion disqus respond",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toolbar",
    "side": "sidebar aside side widget related recommended share sharing social tags meta",
    "frame": "header masthead footer foot copyright site",
    "notice": "notice cookie cookies consent gdpr popup modal alert newsletter subscribe signup",
    "content": "article content main post entry story body text prose",
}
_KIND_OF = {word: kind for kind, words in KINDS.items() for word in words.split()}

_RAW, _SILENT, _SILENT_INLINE, _OF_HEAD, _VOID, _INLINE, _ENDS_P = (
    set(x.split()) for x in (RAW, SILENT, SILENT_INLINE, OF_HEAD, VOID, INLINE, ENDS_PARAGRAPH)
)
_WITHIN_P = {"article", "aside", "div", "section", "td", "li", "blockquote", "main"}
_WITHIN_SIBLING = {"ul", "ol", "dl", "table", "article", "div", "section", "select", "datalist"}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role|data-content)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
LEAF = "#text"
# Potentials of a node that is known not to be content.
NEVER = (0.0, -1000.0)


@dataclass
class Tree:
    """Nodes in page order. ``parent`` of the root is -1.

    ``around``: the kind of the innermost element around a node that has one.
    ``hidden``: 2 in elements that are never read, 1 in forms, but not in an
    article that a form is put around.
    """

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    kind: list[str] = field(default_factory=list)
    marked: list[bool] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    around: list[str] = field(default_factory=list)
    hidden: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, kind: str = "none", marked: bool = False, text: str = "", links: int = 0) -> int:
        for row, value in zip(
            (self.parent, self.tag, self.kind, self.marked, self.text, self.links),
            (parent, tag, kind, marked, text, links),
            strict=True,
        ):
            row.append(value)
        inside = parent >= 0
        own = self.kind[parent] if inside else "none"
        self.around.append(own if own != "none" else self.around[parent] if inside else "none")
        above = self.hidden[parent] if inside else 0
        if tag in _SILENT or above == 2:
            above = 2
        elif tag == "form":
            above = 1
        elif tag in ("article", "main"):
            above = 0
        self.hidden.append(above)
        return len(self.parent) - 1


def _attributes(raw: str) -> tuple[str, bool]:
    kind, marked = "none", False
    for name, *values in _ATTRIBUTE.findall(raw) if "=" in raw else ():
        value = "".join(values).lower()
        if name.lower() == "data-content":
            marked = value == "1"
        elif kind == "none":
            kind = next((_KIND_OF[w] for w in _WORD.findall(value) if w in _KIND_OF), "none")
    return kind, marked


def parse(page: str) -> Tree:
    tree = Tree()
    root = tree.add(-1, "html")
    open_: list[tuple[str, int]] = []  # block elements, with their nodes
    places: dict[str, list[int]] = {}  # where elements of each tag stand in it
    pieces: list[str] = []
    linked, in_link, in_svg, at = 0, 0, 0, 0
    endless: set[str] = set()  # raw elements that have no further end tag

    def above() -> int:
        return open_[min(len(open_), DEEPEST) - 1][1] if open_ else root

    def end_run() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                tree.add(above(), LEAF, text=text, links=min(linked, len(text)))
        linked = 0

    def close(tags: set[str], within: set[str] = frozenset()) -> None:
        """Ends the innermost open element of ``tags``, and what is in it, unless ``within`` is met first."""
        last = lambda names: max((places[n][-1] for n in names if places.get(n)), default=-1)
        i = last(tags)
        if i < 0 or last(within) > i:
            return
        while len(open_) > i:
            places[open_.pop()[0]].pop()

    def skip_raw(name: str, at: int) -> int:
        """Behind the end tag of a raw element; one that never ends hides nothing, unless it is a script or a style."""
        after = None if name in endless else re.compile(rf"</{name}\s*>", re.I).search(page, at)
        if after:
            return after.end()
        endless.add(name)
        return len(page) if name in ("script", "style") else at

    while at < len(page):
        found = _TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            pieces.append(text)
            linked += len(text) if in_link else 0
        if not found:
            break
        at = found.end()
        closing, name, raw, slash = found.groups()
        if name is None:
            continue
        name = name.lower()
        if not closing and places.get("head") and name not in _OF_HEAD:
            # A head without an end tag ends where anything else begins.
            end_run()
            close({"head"})
        if name in _RAW and not in_svg:
            if not closing:
                end_run()
                at = skip_raw(name, at)
        elif name in ("script", "style", "textarea"):
            if not closing and not slash:
                at = skip_raw(name, at)
        elif name in _INLINE:
            if name == "a":
                in_link = 0 if closing else 1
            elif name == "br":
                pieces.append(" ")
            elif name == "svg":
                in_svg = 0 if closing or slash else 1
                if closing and places.get("title"):
                    end_run()
                    close({"title"})
        else:
            end_run()
            in_link = 0
            if closing:
                close({name})
            else:
                if name in _ENDS_P:
                    # Buttons and lists of choices hold no blocks, so one that is still open was not ended.
                    while open_ and (open_[-1][0] in _SILENT_INLINE or open_[-1][0] == "title"):
                        close({open_[-1][0]})
                    close({"p"}, _WITHIN_P)
                if name in SIBLINGS:
                    close(set(SIBLINGS[name].split()), _WITHIN_SIBLING)
                kind, marked = _attributes(raw)
                node = tree.add(above(), name, kind, marked)
                if name not in _VOID and not raw.endswith("/"):
                    places.setdefault(name, []).append(len(open_))
                    open_.append((name, node))
    end_run()
    return tree


def features(tree: Tree, node: int) -> tuple[str, ...]:
    if tree.tag[node] != LEAF:
        return (f"kind {tree.kind[node]}",)
    size = len(tree.text[node])
    return f"size {min(size.bit_length(), 10)}", f"links {4 * tree.links[node] // max(size, 1)}"


# Parts of an article that are not its text, for labels of unmarked pages.
_FOREIGN_TAGS = {"nav", "header", "footer", "aside", "form", "menu"}
_FOREIGN_KINDS = {"advert", "comment", "menu", "side", "frame", "notice"}
# Kinds within which an article is none of the page: a comment, an offer, an entry of a list.
_CLOSED_KINDS = {"advert", "comment", "menu", "notice"}


def relation(tree: Tree, node: int) -> tuple[str, str | None]:
    """What the potential between a node and its parent goes by: the tag, and within a closed kind that kind too."""
    tag, around = tree.tag[node], tree.around[node]
    return (f"{tag} in {around}", f"any in {around}") if around in _CLOSED_KINDS else (tag, None)


def labels(tree: Tree) -> list[bool] | None:
    """Content or not for each node; None if nothing tells."""
    marked = any(tree.marked)
    if not marked and not {"article", "main"} & set(tree.tag):
        return None
    out: list[bool] = []
    for node, (parent, tag, kind, mark) in enumerate(zip(tree.parent, tree.tag, tree.kind, tree.marked, strict=True)):
        if tree.hidden[node]:
            out.append(False)
        elif marked:
            out.append(mark or (parent >= 0 and out[parent] and tag not in _FOREIGN_TAGS and kind not in _FOREIGN_KINDS))
        elif tag in _FOREIGN_TAGS or kind in _FOREIGN_KINDS or tree.around[node] in _CLOSED_KINDS:
            out.append(False)
        else:
            out.append(tag in ("article", "main") or (parent >= 0 and out[parent]))
    return out


def counts(pages: list[str]) -> Counter:
    """What the potentials are made of: labels, labels by parent, and features by label."""
    total: Counter = Counter()
    for page in pages:
        tree = parse(page)
        known = labels(tree)
        if known is None:
            continue
        for node, label in enumerate(known):
            total["label", label] += 1
            if tree.parent[node] >= 0:
                total["pair", known[tree.parent[node]], label] += 1
                for name in filter(None, relation(tree, node)):
                    total["tag", name, known[tree.parent[node]], label] += 1
            for f in features(tree, node):
                total["feature", f, label] += 1
    return total


# Labelled pages with the parts that a table's own pages may lack.
EXAMPLES = [
    "<body><header><h1>Site</h1><p>Slogan</p></header><nav><ul><li><a href=x>Home</a></li></ul></nav>"
    '<main data-content="1"><h1>Title</h1><p>First paragraph of the text.</p><h2>Part</h2><ul><li>Point</li></ul>'
    "<blockquote><p>Words of another.</p></blockquote><pre>lines</pre><table><tr><td>cell</td></tr></table></main>"
    '<aside><h3>Related</h3><ul><li><a href=y>Other</a></li></ul></aside><footer><p>Copyright</p></footer></body>',
    '<body><div class="navbar"><a href=x>Home</a></div><div class="cookie-notice"><p>We use cookies.</p></div>'
    '<div class="content" data-content="1"><h2>Title</h2><div>Text in a division.</div><p>More of it.</p></div>'
    '<div class="sidebar"><p>Popular</p></div><div class="ad">Buy now</div><form><p>Your address</p><label>Mail</label>'
    '</form><section class="comments"><h3>Comments</h3><article class="comment"><p>I agree.</p></article></section>'
    '<div class="footer">Imprint</div></body>',
    '<body><article data-content="1"><header><h1>Title</h1></header><section><p>Body text.</p><p>And more.</p></section>'
    '<aside class="advert"><p>Offer</p></aside><div class="share"><a href=z>Share</a></div></article>'
    '<div id="comments"><p>First!</p><ol><li>Nice.</li></ol></div><div class="newsletter"><p>Subscribe</p></div></body>',
    '<body><article data-content="1"><h1>Title</h1><p>Body text of it.</p><form><p>Your mail</p><button>Send</button></form>'
    '<p>The end of it.</p></article><div class="comment-list"><article><p>I read it twice.</p></article>'
    "<article><h4>Reply</h4><p>So did I.</p></article></div></body>",
]


@dataclass(frozen=True)
class Model:
    """Log potentials: ``own`` of (feature, label), ``prior`` of a root, ``pair`` of parent and child labels by tag.

    ``pair`` has an entry None for tags that were not seen.
    """

    own: dict[str, tuple[float, float]]
    prior: tuple[float, float]
    pair: dict[str | None, tuple[tuple[float, float], tuple[float, float]]]


def model(total: Counter, smoothing: float = 0.5) -> Model:
    """Potentials from counts. A leaf's label is also that of the element it is in, as pairs say."""
    number = [total["label", label] for label in (False, True)]
    own = {}
    for name in {k[1] for k in total if k[0] == "feature"}:
        group = name.split(" ")[0]
        kinds = sum(1 for k in total if k[0] == "feature" and k[2] is True and k[1].startswith(group + " ")) + 10
        own[name] = tuple(
            float(np.log((total["feature", name, label] + smoothing) / (number[label] + smoothing * kinds)))
            for label in (False, True)
        )
    shares = {
        parent: [(total["pair", parent, child] + smoothing) / (sum(total["pair", parent, c] for c in (False, True)) + 2 * smoothing)
                 for child in (False, True)]
        for parent in (False, True)
    }
    pair: dict[str | None, tuple] = {}
    for tag in [None, *{k[1] for k in total if k[0] == "tag"}]:
        rows = []
        for parent in (False, True):
            # A tag's own counts, with the shares of all tags as one more node.
            row = [total["tag", tag, parent, child] + shares[parent][child] for child in (False, True)]
            rows.append(tuple(float(np.log(x / sum(row))) for x in row))
        pair[tag] = tuple(rows)
    return Model(own, (float(np.log(0.99)), float(np.log(0.01))), pair)


def marginals(trees: list[Tree], potentials: Model) -> np.ndarray:
    """Probability of content for every node of all trees, in order, by messages up and down the levels."""
    sizes = [len(t.parent) for t in trees]
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    parent = np.concatenate([np.where(np.array(t.parent) < 0, -1, np.array(t.parent) + s) for t, s in zip(trees, starts, strict=False)])
    depth = np.zeros(len(parent), dtype=np.int64)
    for i, p in enumerate(parent.tolist()):
        depth[i] = depth[p] + 1 if p >= 0 else 0
    own = np.zeros((len(parent), 2))
    cache: dict[tuple[str, ...], np.ndarray] = {}
    unknown = (0.0, 0.0)
    for t, s in zip(trees, starts, strict=False):
        for node in range(len(t.parent)):
            names = features(t, node)
            if names not in cache:
                cache[names] = np.sum([potentials.own.get(n, unknown) for n in names], axis=0)
            own[s + node] = cache[names]
    own[parent < 0] += potentials.prior
    tables = np.array(list(potentials.pair.values()))  # tag, parent, child
    number = {tag: i for i, tag in enumerate(potentials.pair)}
    known = lambda names: next((number[n] for n in names if n in number), number[None])
    pair = tables[[known(relation(t, node)) for t in trees for node in range(len(t.parent))]]
    hidden = np.concatenate([np.array(t.hidden) > 0 for t in trees])
    # They say nothing about the elements they stand in.
    own[hidden], pair[hidden] = NEVER, 0.0
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    up, message = own.copy(), np.zeros_like(own)
    for nodes in reversed(levels[1:]):
        message[nodes] = np.logaddexp(up[nodes, :1] + pair[nodes, :, 0], up[nodes, 1:] + pair[nodes, :, 1])
        np.add.at(up, parent[nodes], message[nodes])
    down = np.zeros_like(own)
    for nodes in levels[1:]:
        above = up[parent[nodes]] + down[parent[nodes]] - message[nodes]
        down[nodes] = np.logaddexp(above[:, :1] + pair[nodes, 0], above[:, 1:] + pair[nodes, 1])
    belief = up + down
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700)))


def extract(pages: list[str], potentials: Model) -> list[str]:
    trees = [parse(page) for page in pages]
    if not trees:
        return []
    content = marginals(trees, potentials) > 0.5
    out, at = [], 0
    for t in trees:
        out.append("\n\n".join(text for text, yes in zip(t.text, content[at : at + len(t.text)], strict=True) if text and yes))
        at += len(t.text)
    return out


LEARN_FROM = 2000
# The part of the learned pages that each example counts as much as.
EXAMPLE_SHARE = 1 / 6


def fit(pages: DataFrame, *, html: str = "html", id_column: str = "page_id", limit: int = LEARN_FROM) -> Model:
    """A model from the examples and at most ``limit`` pages, chosen by the hash of their ids."""
    own = pages.select(F.col(id_column).alias("id"), F.col(html).alias("html")).where("id IS NOT NULL AND html IS NOT NULL")
    own = own.withColumn("h", F.xxhash64("html"))
    # Distinct pages, as one id can stand on any number of rows.
    chosen = own.select("id", "h").distinct().orderBy(F.xxhash64("id", "h"), "id", "h").limit(limit)
    sample = own.join(F.broadcast(chosen), ["id", "h"], "left_semi").groupBy("id", "h").agg(F.first("html").alias("html")).drop("h")
    fields = [StructField("counted", StringType())]

    def start():
        def block(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            made = []
            for page in batch.column(batch.schema.get_field_index("html")).to_pylist():
                made.append(repr(dict(counts([page]))))
            return {"counted": pa.array(made, pa.string())}

        return block

    learned = [ast.literal_eval(r.counted) for r in with_block_columns(sample, fields, start, ("html", "id")).collect()]
    weight = max(1, round(EXAMPLE_SHARE * len(learned)))
    total = Counter({k: weight * n for k, n in counts(EXAMPLES).items()})
    for own in learned:
        total.update(own)
    return model(total)


def texts(pages: DataFrame, potentials: Model, *, html: str = "html", keep_html: bool = False) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``."""

    def start():
        def block(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            values = [p or "" for p in batch.column(batch.schema.get_field_index(html)).to_pylist()]
            out: list[str] = []
            for a in range(0, len(values), 200):
                out += extract(values[a : a + 200], potentials)
            return {"text": pa.array(out, pa.string()), "n_chars": pa.array([len(t) for t in out], pa.int64())}

        return block

    fields = [StructField("text", StringType()), StructField("n_chars", LongType())]
    return with_block_columns(pages, fields, start, () if keep_html else (html,))
