"""Operator 10: main text of HTML pages by deducing each host's template.

Every page becomes a sequence of tokens: the start and the end of each block
element, told by its path, and the blocks of text, told by path and text. Across
the pages of a host a token has an occurrence vector: how often it occurs on each
page. Tokens with equal vectors form an equivalence class; vectors are compared by
an order-free sum of hashes of (page, count), so no host's pages are gathered
anywhere. A class of two tokens or more that occur on most pages of a host is
valid on a page when its tokens come there as whole rounds in the class's order:
once each, or several times for what a list repeats. Valid classes nest: a class
lies in a slot of the class that holds the closest path above its first token, and
a round counts only inside one slot of its parent, so it never straddles a
template token. What lies between the tokens of the nested template are slots.
A page's main text is what fills them: all slots, whatever container they are in,
but those under page furniture (menus, headers, footers, sidebars, notices,
adverts, forms, reader comments), which the template's paths name. Texts that are
template tokens themselves are dropped, nothing else.

Where a block that would be template is by far the longest of a page, as with
copies and near copies of a page, the page keeps all its blocks. Pages without a template (no host in the url, a host of
fewer than three pages) are read by their elements alone: the article element
where there is one, else what is no furniture.

Defined results: a null or empty page gives an empty text; repeated pages each get
a row, equal pages equal texts; pages of any length are read whole; columns besides
page_id, url and html are not read and may have any name; a tie between two slots
cannot arise, as all are kept; an empty table gives no rows.
"""

from __future__ import annotations

import html as html_lib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import cut, small_batches, table

# Fixed values of the HTML standard: elements without content, elements whose content is no text, block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math select option button canvas audio video".split())
OPAQUE = frozenset("script style textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
FURNITURE = frozenset("nav header footer aside form dialog menu head".split())
FURNITURE_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|banner\w*|promo\w*|sponsor\w*|cookie\w*|consent|gdpr|notice\w*|alert|popup|modal|overlay|subscribe|newsletter|"
    r"nav|navbar|navigation|menu\w*|breadcrumbs?|sidebar|side|widget\w*|footer|foot|header|masthead|topbar|comments?|comment-\w+|replies|disqus|respond|"
    r"related|recommend\w*|share|sharing|social|login|signup|search|pagination|pager|toolbar|skip)(?:$|[\s_-])",
    re.I,
)
FURNITURE_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S
)
ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|style|aria-hidden|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
# Which open elements an opening tag closes (the standard's implied end tags).
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}}
BLANK = re.compile(r"[\s ]+")


Block = tuple[str, str, bool, bool]


def blocks(page: str | None) -> list[Block]:
    """(path, text, in furniture, in an article) of each block with text, in page order."""
    return [t for t in tokens(page) if t[1] is not None]


def tokens(page: str | None) -> list[tuple[str, str | None, bool, bool]]:
    """Blocks of text as in ``blocks``, and between them the starts of block elements: (path, None, in furniture, in an article)."""
    out: list[tuple[str, str | None, bool, bool]] = []
    stack: list[tuple[str, str, bool, bool]] = []  # name, path, furniture, article
    buffer: list[str] = []

    def flush() -> None:
        if buffer:
            text = BLANK.sub(" ", "".join(buffer)).strip()
            buffer.clear()
            if text:
                _, path, furniture, article = stack[-1] if stack else ("", "", False, False)
                out.append((block_path or path, text, block_furniture, block_article))

    block_path, block_furniture, block_article = "", False, False
    page = page or ""
    at, end = 0, len(page)
    while at < end:
        m = TOKEN.match(page, at)
        at = m.end()
        name = m.group(2)
        if name is None:
            said = m.group()
            if said[0] != "<" or said == "<":
                top = stack[-1] if stack else ("", "", False, False)
                if not buffer:
                    block_path, block_furniture, block_article = top[1], top[2], top[3]
                if not any(s[0] in RAW for s in stack):
                    buffer.append(html_lib.unescape(said))
            continue
        name = name.lower()
        if name in BLOCK:
            flush()
        if m.group(1):
            if any(s[0] == name for s in stack):
                while stack.pop()[0] != name:
                    pass
            continue
        attrs = {a.lower(): (b or c or d or "") for a, b, c, d in ATTR.findall(m.group(3))}
        while stack and (
            (stack[-1][0] in CLOSES.get(name, ()) and stack[-1][0] not in SCOPE.get(name, ())) or (stack[-1][0] == "p" and name in BLOCK and name != "br")
        ):
            stack.pop()
        top = stack[-1] if stack else ("", "", False, False)
        label = " ".join((attrs.get("class", ""), attrs.get("id", ""))).strip()
        step = name + ("." + "-".join(sorted(set(label.lower().split()))) if label else "")
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")
        main = name in ("article", "main") or attrs.get("role") in ("main", "article") or attrs.get("itemprop") == "articleBody"
        furniture = top[2] or hidden or (not main and (name in FURNITURE or name in RAW or attrs.get("role") in FURNITURE_ROLE or bool(label and FURNITURE_NAME.search(label))))
        if name in VOID or m.group(3).endswith("/") and name not in BLOCK:
            continue
        if name in OPAQUE:
            close = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        # Bold, links and the like are no places of their own: a block's path names block elements alone.
        path = f"{top[1]}/{step}" if name in BLOCK and name != "p" else top[1]
        stack.append((name, path, furniture, top[3] or main))
        if name in BLOCK:
            out.append((path + "/p" * (name == "p"), None, furniture, top[3] or main))
    flush()
    return out


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def _token(path: str, text: str | None) -> int:
    return _hash("path", path) if text is None else _hash("text", f"{path}\x1f{text}")


def page_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, token, its path, where it first stands on the page, and a hash of (page, count)."""
    for b in batches:
        rows: list[tuple] = []
        for host, url, page in zip(*(b.column(c).to_pylist() for c in ("host", "url", "html"))):
            page_key, first, count = str(_hash(url or "", page or "")), {}, Counter()
            for i, (path, text, *_) in enumerate(tokens(page)):
                token = _token(path, text)
                first.setdefault(token, (i, path))
                count[token] += 1
            rows += [(host, token, first[token][1], first[token][0], _hash(page_key, str(n))) for token, n in count.items()]
        cols = list(zip(*rows)) or [()] * 5
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["host", "token", "path", "place", "vector"])


def templates(pages: DataFrame, min_pages: int = 3, support: float = 0.5, least: int = 2) -> DataFrame:
    """host and ``classes`` of each host with a template, from (host, url, html): for each class of ``least`` tokens or more its tokens and their paths in page order.

    A token of a template is on ``support`` of a host's pages, so a host has at most 1 / support times a page's tokens.
    """
    size = pages.groupBy("host").agg(F.count("*").alias("host_pages")).where(F.col("host_pages") >= min_pages)
    toks = small_batches(pages).mapInArrow(page_tokens, "host string, token long, path string, place long, vector long")
    per = toks.groupBy("host", "token").agg(F.count("*").alias("pages"), F.first("path").alias("path"), F.sum("place").alias("place"), F.sum(F.col("vector").cast("decimal(38,0)")).alias("fingerprint"))
    per = per.where(F.col("pages") >= min_pages).join(size, "host").where(F.col("pages") >= support * F.col("host_pages"))
    # Tokens of a class are on the same pages, so their sums of places are in the order of their mean places.
    classes = per.groupBy("host", "fingerprint", "pages").agg(F.array_sort(F.collect_list(F.struct("place", "token", "path"))).alias("tokens")).where(F.size("tokens") >= least)
    return classes.groupBy("host").agg(F.collect_list(F.struct(F.col("tokens.token").alias("tokens"), F.col("tokens.path").alias("paths"))).alias("classes"))


class Template:
    """A host's classes, each below the class that holds the closest path above its first token, outer ones first."""

    def __init__(self, classes: list[dict]):
        self.classes = sorted(([*c["tokens"]], [*c["paths"]]) for c in classes)
        self.classes.sort(key=lambda c: min(p.count("/") for p in c[1]))
        holder: dict[str, int] = {}
        for k, (_, paths) in enumerate(self.classes):
            for p in paths:
                holder.setdefault(p, k)
        self.parents = []
        for k, (_, paths) in enumerate(self.classes):
            above, parent = paths[0], None
            while above and parent is None:
                above = above.rpartition("/")[0]
                if holder.get(above, k) != k:
                    parent = holder[above]
            self.parents.append(parent)
        self.of = {t: (k, j) for k, (tokens, _) in enumerate(self.classes) for j, t in enumerate(tokens)}

    def marked(self, found: list[int]) -> set[int]:
        """Which of a page's tokens (by number) belong to the template that is on this page."""
        at: list[list[tuple[int, int]]] = [[] for _ in self.classes]
        for i, t in enumerate(found):
            if t in self.of:
                k, j = self.of[t]
                at[k].append((i, j))
        out: set[int] = set()
        rounds: dict[int, list[list[int]]] = {}
        for k, (tokens, _) in enumerate(self.classes):
            own = [r for r in whole_rounds(at[k], len(tokens))]
            parent = self.parents[k]
            if parent in rounds:  # a round lies in one slot of its parent
                walls = sorted(i for r in rounds[parent] for i in r)
                own = [r for r in own if bisect_right(walls, r[0]) == bisect_right(walls, r[-1])]
            rounds[k] = own
            out.update(i for r in own for i in r)
        return out


def whole_rounds(places: list[tuple[int, int]], size: int, least: int = 2) -> list[list[int]]:
    """Rounds of a class among its tokens' (place, rank) on a page: each runs through the ranks in order. What breaks the order is left
    out, as long as ``least`` tokens of a class that occurs once keep it."""
    if len({j for _, j in places}) < size:
        return []
    if len(places) == size:
        kept = in_order([j for _, j in places])
        return [[places[k][0] for k in kept]] if len(kept) >= least else []
    out, now = [], []
    for i, j in places:
        if j == len(now):
            now.append(i)
        else:
            now = [i] if j == 0 else []
        if len(now) == size:
            out.append(now)
            now = []
    return out


def in_order(places: list[int]) -> list[int]:
    """Indexes of a longest subsequence of ``places`` that does not fall."""
    ends: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for i, x in enumerate(places):
        k = bisect_right(ends, x)
        back.append(last[k - 1] if k else -1)
        ends[k : k + 1], last[k : k + 1] = [x], [i]
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def main_text(page: str | None, template: Template | None, copied: float = 3.0) -> str:
    """The text in the slots of the page; ``template`` None: of a page that is read by its elements alone."""
    every = tokens(page)
    only = template is None and any(article for _, text, _, article in every if text is not None)
    own = [i for i, (_, text, furniture, article) in enumerate(every) if text is not None and not furniture and (article or not only)]
    fixed = template.marked([_token(path, text) for path, text, *_ in every]) if template else set()
    slots = [i for i in own if i not in fixed]
    # Where a block that others of the host repeat is by far the longest, the page is a copy of theirs and keeps it.
    longest = lambda part: max((len(every[i][1]) for i in part), default=0)
    if longest(i for i in own if i in fixed) >= copied * longest(slots):
        slots = own
    return "\n".join(every[i][1] for i in slots)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, Template] = {}
    for b in batches:
        texts = []
        for host, page, classes in zip(*(b.column(c).to_pylist() for c in ("host", "html", "classes"))):
            if classes and host not in known:
                if len(known) > 1000:
                    known.clear()
                known[host] = Template(classes)
            texts.append(main_text(page, known[host] if classes else None))
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
        )


#: Templates of up to this many hosts are broadcast (some 10 KB each); of more, pages and templates meet in a shuffle.
FEW_HOSTS = 2_000


def extract_main_text(pages: DataFrame, pages_a_salt: int = 5_000) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Where templates are too many to broadcast, a host's pages are dealt over as many salts as ``pages_a_salt`` asks for; each gets the template.
    """
    host = F.lower(F.regexp_replace(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?i)^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1), "^.*@", ""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.nullif(host, F.lit("")).alias("host"))
    hosted = keyed.where(F.col("host").isNotNull())
    found = cut(templates(hosted.select("host", "url", "html")))
    if found.count() <= FEW_HOSTS:
        joined = keyed.join(F.broadcast(found), "host", "left")
    else:
        salts = hosted.groupBy("host").agg(F.ceil(F.count("*") / pages_a_salt).cast("int").alias("salts"))
        found = cut(found.join(salts, "host"))
        # Host sizes are small rows; Spark broadcasts them or splits the join's large keys.
        sized = keyed.join(found.select("host", "salts"), "host", "left")
        sized = sized.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
        spread = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
        joined = sized.join(spread, ["host", "salt"], "left")
    rows = small_batches(joined.select("host", "page_id", "url", "html", "classes"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
