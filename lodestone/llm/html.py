"""Main text of web pages by site style trees.

All pages of a host are merged into one tree of element paths. Each node gets an importance from two entropies: of its
presentation, that is, how the child sequences at this path vary over the pages, and of its content, that is, how few pages
share the text blocks below it. A branch is a template, and is cut from each page, if its node and all nodes and texts below
are of low importance. What a page declares itself (its article, its menus, adverts, forms and comments) goes before the
statistics, because a host of few pages has none.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lodestone.llm.rows import sliced, unwrapped, wrapped
from lodestone.session import stored

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe)\b(?:[^>=]|=\s*\"[^\"]*+\"|=\s*'[^']*+'|=)*+>.*?(?:</(?P=raw)\s*>|\Z)"
    # only up to an end tag of its own: without one, or with '/>', the tag alone goes
    r"|<(?P<shut>svg|select|button)\b(?:[^>=]|=\s*\"[^\"]*+\"|=\s*'[^']*+'|=)*+(?<!/)>(?:[^<]++|<(?!/?(?P=shut)\b))*+</(?P=shut)\s*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]|=\s*\"[^\"]*+\"|=\s*'[^']*+'|=)*+)>"
    r"|<[!?/][^>]*+>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr"
                   " math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup"
                   " msup mtable mtd mtext mtr munder munderover none semantics".split())
VOID = frozenset("area base br button col embed hr img input link meta param select source svg track wbr".split())
#: Elements that end when one of these starts inside them.
ENDS = {"p": frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dt dd".split()),
        "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr"}), "td": frozenset({"td", "th", "tr"}),
        "th": frozenset({"td", "th", "tr"}), "option": frozenset({"option"}), "head": frozenset({"body"})}
NOISE_TAGS = frozenset("head nav menu footer aside form fieldset label dialog audio video canvas map".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
#: Words of class and id values that name parts which are not the article.
NOISE_WORDS = re.compile(
    r"^(?:ads?|adv|advert\w*|adbox|adslot|adsense|sponsor\w*|promo\w*|banner|sidebar\w*|aside|menu\w*|nav\w*|breadcrumbs?|footer\w*|header\w*|masthead|cookies?"
    r"|consent|notice\w*|gdpr|newsletter\w*|subscri\w*|popup|modal|overlay|share|sharing|social\w*|related|recommend\w*|comments?|commentlist|repl(?:y|ies)|disqus"
    r"|respond|widgets?|login|signup|search\w*|toolbar|paginat\w*|pager|copyright|disclaimer|alert|skip)$"
)
COMMENT_WORDS = re.compile(r"^(?:comments?|commentlist|repl(?:y|ies)|disqus|respond)$")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


@dataclass
class Block:
    text: str
    paths: tuple[int, ...]  # of the element and all above it, the element last
    plain: tuple[bool, ...]  # whether the element has neither class nor id
    article: int  # place in `paths` from which on the block is inside an article or main element; -1 if it is not
    kind: str  # "article", "main" or ""
    links_only: bool


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    styles: dict[int, set[tuple[str, ...]]] = field(default_factory=dict)
    above: dict[int, int] = field(default_factory=dict)  # the path of the element above


@dataclass
class _Open:
    tag: str
    path: int
    plain: bool
    noise: bool
    comment: bool
    children: list[str] = field(default_factory=list)


def _word(value: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", value.lower()) if w]


def parse(source: str, hashes: dict[tuple[int, str], int]) -> Page:
    """Blocks of text that the page does not itself declare to be something else, and the child sequences of each path."""
    page = Page()
    root = _Open("", 0, True, False, False)
    stack, parts, links, n_links, linked = [root], [], 0, 0, 0
    at = 0

    def end_block() -> None:
        nonlocal n_links, linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text and not stack[-1].noise:
                kind, place = "", -1
                for i, e in enumerate(stack):
                    if e.tag in ("article", "main") and (kind != "article"):
                        kind, place = e.tag, i
                page.blocks.append(Block(text, tuple(e.path for e in stack), tuple(e.plain for e in stack), place, kind, n_links > 1 and linked >= 0.9 * len(text)))
            parts.clear()
        n_links = linked = 0

    def pop() -> None:
        done = stack.pop()
        page.styles.setdefault(done.path, set()).add(tuple(done.children))
        page.above[done.path] = stack[-1].path

    for match in TOKEN.finditer(source):
        if match.start() > at:
            piece = source[at:match.start()]
            parts.append(piece)
            if links:
                linked += len(piece)
        at = match.end()
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        closing = bool(match["close"])
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
                n_links += not closing
            if closing:
                if stack[-1].tag == tag:
                    end_block()
                    pop()
                continue
            attrs = match["attrs"]
            if not attrs or not _named_noise(attrs):
                continue
        if tag in ("br", "hr"):
            parts.append(" ")
            continue
        if tag in VOID:
            continue
        end_block()
        links = 0
        if closing:
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if place:
                while len(stack) > place:
                    pop()
            continue
        while stack[-1].tag in ENDS and tag in ENDS[stack[-1].tag]:
            pop()
        _open(stack, tag, match["attrs"], hashes)
    if at < len(source):
        parts.append(source[at:])
    end_block()
    while len(stack) > 1:
        pop()
    page.styles.setdefault(0, set()).add(tuple(root.children))
    return page


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(text)}


def _named_noise(attrs: str) -> bool:
    found = _attributes(attrs)
    words = _word(found.get("class", "") + " " + found.get("id", ""))
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    return hidden or found.get("role", "").lower() in NOISE_ROLES or any(map(NOISE_WORDS.match, words))


def _open(stack: list[_Open], tag: str, attrs: str, hashes: dict[tuple[int, str], int]) -> None:
    above = stack[-1]
    found = _attributes(attrs) if attrs.strip() else {}
    names = _word(found.get("class", "") + " " + found.get("id", ""))
    if tag not in ("article", "main") and (found.get("role", "").lower() == "main" or found.get("itemprop", "").lower() == "articlebody"):
        tag = "main"
    comment = above.comment or any(map(COMMENT_WORDS.match, names))
    if tag in ("article", "main"):
        noise = comment or (above.noise and any(e.tag in ("nav", "aside", "footer") for e in stack))
    elif tag in ("html", "body"):
        noise = False
    elif tag == "header":
        # the heading of an article stands in its header
        noise = True
    elif tag in HEADINGS and above.tag == "header" and any(e.tag in ("article", "main") and not e.noise for e in stack):
        noise = False
    else:
        noise = above.noise or tag in NOISE_TAGS or (bool(attrs) and _named_noise(attrs))
    sign = ".".join([tag, *(re.sub(r"\d+", "0", n) for n in sorted(set(names)))])
    key = (above.path, sign)
    path = hashes.get(key)
    if path is None:
        if len(hashes) > 200_000:
            hashes.clear()
        path = hashes[key] = xxhash.xxh3_64_intdigest(f"{above.path}/{sign}") >> 1
    if not above.children or above.children[-1] != sign:  # a run of equal children is one
        above.children.append(sign)
    stack.append(_Open(tag, path, not names, noise, comment))


def digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1


def chosen(page: Page, low: frozenset[int] | set[int]) -> list[str]:
    """The texts of the blocks to keep: of articles if the page has any, else of its main element, else of the body.

    A block goes if a node of its path is in `low`, or its own text at its path. Inside an article or main element, nodes
    without class and id are the text itself, which many pages of a host may well share, and are never cut.
    """
    kinds = {b.kind for b in page.blocks}
    wanted = "article" if "article" in kinds else "main" if "main" in kinds else ""
    out = []
    for b in page.blocks:
        if b.kind != wanted:
            continue
        if low and any(p in low and (b.article < 0 or (i > b.article and not b.plain[i])) for i, p in enumerate(b.paths)):
            continue
        if b.article < 0 and (b.links_only or (low and b.paths[-1] ^ digest(b.text) in low)):
            continue
        out.append(b.text)
    return out


STYLE, OWN, BELOW, INSIDE, UNDER = 0, 1, 2, 3, 4
#: Rows that leave Python at once; a page of very deep elements has many.
ROWS = 200_000


def distinct_pages(pages: DataFrame, host: str, html_col: str) -> DataFrame:
    """(host, page, features) of every page of a host, those with the same blocks at the same paths once.

    features: rows of path, kind and feature as 64-bit integers; see `style_counts`. UNDER has the path of the element above.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: dict[tuple[int, str], int] = {}
        for batch in sliced(batches):
            found, features = [], []
            for source in batch.column(1).to_pylist():
                page = parse(source, hashes)
                rows = {(path, STYLE, digest(repr(sorted(styles)))) for path, styles in page.styles.items()}
                texts = [digest(b.text) for b in page.blocks]
                for b, feature in zip(page.blocks, texts):
                    rows.update((path, BELOW, feature) for path in b.paths[:-1])
                    rows.add((b.paths[-1], OWN if b.article < 0 else INSIDE, feature))
                rows.update((path, UNDER, above) for path, above in page.above.items())
                found.append(digest(repr([(b.paths[-1], feature) for b, feature in zip(page.blocks, texts)])))
                features.append(np.array(sorted(rows), "<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64()), pa.array(features, pa.binary())], names=["host", "page", "features"])

    rows = pages.select(F.col(host).alias("host"), F.col(html_col).alias("html")).where("html IS NOT NULL").mapInArrow(run, "host string, page bigint, features binary")
    return rows.groupBy("host", "page").agg(F.min("features").alias("features"))


def style_counts(pages: DataFrame, host: str, html_col: str) -> DataFrame:
    """(host, path, kind, feature, count): on how many distinct pages of the host a node has a feature.

    A feature is the child sequence of the node (STYLE), or the text of a block: at its own path as OWN if it stands outside
    the article, else as INSIDE, and at all nodes above it as BELOW. UNDER rows have each node below the path, their count says
    nothing. Large hosts are dealt out by feature.
    """

    def packed(hosts: list[str], sizes: list[int], rows: np.ndarray) -> pa.RecordBatch:
        names = pa.array(hosts, pa.string()).take(pa.array(np.repeat(np.arange(len(hosts)), sizes)))
        return pa.RecordBatch.from_arrays([names, pa.array(rows[:, 0]), pa.array(rows[:, 1].astype(np.int32)), pa.array(rows[:, 2])], names=["host", "path", "kind", "feature"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[str, int]] = set()
        for batch in sliced(batches):
            hosts = batch.column(0).to_pylist()
            pages = [np.frombuffer(f, "<i8").reshape(-1, 3) for f in batch.column(1).to_pylist()]
            rows = np.concatenate(pages)
            sizes = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
            plain = rows[:, 1] != UNDER
            yield packed(hosts, np.bincount(sizes[plain], minlength=len(pages)), rows[plain])
            names, chains = [], []
            for name, page in zip(hosts, pages):
                own = page[page[:, 1] == UNDER]
                above = dict(zip(own[:, 0].tolist(), own[:, 2].tolist()))
                for path in above:
                    if (name, path) in told:
                        continue
                    if len(told) > 200_000:
                        told.clear()
                    told.add((name, path))
                    up = path
                    while up:  # the root is 0
                        up = above[up]
                        names.append(name)
                        chains.append((up, UNDER, path))
                    if len(chains) >= ROWS:
                        yield packed(names, [1] * len(names), np.array(chains, np.int64))
                        names, chains = [], []
            if chains:
                yield packed(names, [1] * len(names), np.array(chains, np.int64))

    rows = distinct_pages(pages, host, html_col).select("host", "features").mapInArrow(run, "host string, path bigint, kind int, feature bigint")
    return rows.groupBy("host", "path", "kind", "feature").count()


def node_importance(counts: DataFrame, gamma: float = 0.9) -> DataFrame:
    """(host, path, pages, importance, text) of every node of the style tree of every host; text is that of its own texts, or NULL.

    With m pages that have the node: presentation = entropy of its child sequences, to the base m; content = 1 - mean of
    log_m(pages with the block) over the text blocks below it; importance = (1 - gamma^k) presentation + gamma^k content for k
    child sequences. Texts that stand in the node itself are leaves, with the content of them alone.
    """
    style, content, own = F.col("kind") == STYLE, F.col("kind").isin(OWN, INSIDE, BELOW), F.col("kind").isin(OWN, INSIDE)
    nodes = counts.groupBy("host", "path").agg(
        F.sum(F.when(style, F.col("count"))).alias("pages"),
        F.sum(F.when(style, F.col("count") * F.log("count"))).alias("n_log_n"),
        F.count(F.when(style, 1)).alias("styles"),
        F.avg(F.when(content, F.log("count"))).alias("shared"),
        F.avg(F.when(own, F.log("count"))).alias("own"),
    )
    m = F.log("pages")
    presentation = F.when(F.col("pages") > 1, (m - F.col("n_log_n") / F.col("pages")) / m).otherwise(1.0)
    text = F.when(F.col("pages") > 1, 1 - F.col("shared") / m).otherwise(1.0)
    weight = F.when(F.col("shared").isNull(), 0.0).otherwise(F.pow(F.lit(gamma), F.col("styles")))
    leaf = F.when(F.col("own").isNull(), None).when(F.col("pages") > 1, 1 - F.col("own") / m).otherwise(1.0)
    return nodes.select("host", "path", "pages", ((1 - weight) * presentation + weight * F.coalesce(text, F.lit(0.0))).alias("importance"), leaf.alias("text"))


def template_parts(counts: DataFrame, threshold: float, least_pages: int) -> DataFrame:
    """(host, part): nodes of low importance with nothing above `threshold` below them, and single blocks outside articles
    that most pages of the host share at one path: more than half of them, whatever their number.
    """
    found = node_importance(counts)
    high = found.where(F.greatest("importance", "text") >= threshold).select("host", F.col("path").alias("feature"))
    under = counts.where(F.col("kind") == UNDER).select("host", "path", "feature").join(high, ["host", "feature"]).select("host", "path").distinct()
    nodes = found.where(F.col("pages") >= least_pages)
    low = nodes.where(F.greatest("importance", "text") < threshold).select("host", "path").join(under, ["host", "path"], "left_anti")
    blocks = counts.where((F.col("kind") == OWN) & (F.col("count") >= least_pages)).join(nodes.select("host", "path", "pages"), ["host", "path"])
    shared = blocks.where(1 - F.log("count") / F.log("pages") < threshold)
    shared = shared.join(found.where("path = 0").select("host", F.col("pages").alias("all_pages")), "host").where(2 * F.col("count") > F.col("all_pages"))
    return low.select("host", F.col("path").alias("part")).unionByName(shared.select("host", F.col("path").bitwiseXOR(F.col("feature")).alias("part")))


def with_main_text(pages: DataFrame, url_col: str, html_col: str, threshold: float = 0.2, least_pages: int = 4, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """All rows and columns, with `text` and `n_chars`, replacing columns of these names.

    Parts below `threshold` on at least `least_pages` pages of their host are cut. The host is that of the URL, lower-cased;
    a NULL URL is the host ''. A NULL or empty page has an empty text; repeated rows keep rows of their own, but pages with equal
    blocks count once. What is cut is stored; they reach the pages by broadcast if they take at most `broadcast_bytes`, else by a join on the host, whose large
    partitions Spark splits.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col).cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/?#:]*)", 1), F.lit("")))
    source = F.col(html_col).cast("string")
    counts = stored(style_counts(pages.select(host.alias("host"), source.alias("html")), "host", "html"), "style-counts")
    low = template_parts(counts, threshold, least_pages)
    cut = stored(low.groupBy("host").agg(F.sort_array(F.collect_set("part")).alias("low")), "style-trees")
    size = cut.agg(F.sum(F.size("low") * 8 + 64)).first()[0] or 0
    cut = F.broadcast(cut) if size <= broadcast_bytes else cut
    rows = wrapped(pages, host=host, html=source).join(cut, "host", "left").select("row", "html", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: dict[tuple[int, str], int] = {}
        for batch in batches:
            texts = []
            known: dict[bytes, frozenset] = {}
            for source, paths in zip(batch.column(1).to_pylist(), batch.column(2)):
                low = frozenset()
                if paths.is_valid:
                    values = paths.values.to_numpy(zero_copy_only=False)
                    key = values.tobytes()
                    if key not in known:
                        known[key] = frozenset(values.tolist())
                    low = known[key]
                texts.append(" ".join(chosen(parse(source, hashes), low)) if source else "")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    found = rows.mapInArrow(run, StructType([rows.schema["row"]]).add("text", StringType()))
    return unwrapped(found, pages.columns, text=F.col("text"), n_chars=F.length("text").cast("long"))
