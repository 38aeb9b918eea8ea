"""Main text of web pages by template deduction.

Pages of one host share a template. Each page becomes a sequence of tokens: tags, and runs of text, each told apart by the
path of tags above it. A token's occurrence vector says how often it stands in each page of the host; tokens with the
same vector that stand in nearly all pages form an equivalence class. A class is valid if its tokens come in the same order in
every page that has them. Valid classes are nested by their paths into the host's template, whose remaining slots hold
what differs between pages.

The slots to keep are those below the template's content node: the innermost one that holds nearly all of the host's running
text outside links and outside nodes whose tag or class marks a menu, header, footer, sidebar, notice, advert, form or
reader comments. Text runs that belong to the template are left out only outside of that node or if they stand alone
in a node of their own, so a sentence that many articles share stays.

Vectors are summed as hashes by Spark, never gathered: a host with a third of all pages costs a row per token and
task. A host with fewer than ``support`` pages has no template of its own and is read by its tags alone. NULL and empty
pages give the empty text; pages without a URL form one host; repeated rows are extracted one by one; an empty table gives
an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickward.llm.common import rows_of, stored

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(>|\Z)|</[^>]*(?:>|\Z)",
    re.DOTALL,
)
NAME = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
BREAK = re.compile(r"[-_\s]+|(?<=[a-z])(?=[A-Z])")
SPACE = re.compile(r"\s+")

# Elements by what they are in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
BLOCKS = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CLOSED_BY = {
    **dict.fromkeys(("p", "h1", "h2", "h3", "h4", "h5", "h6"), BLOCKS),
    "li": frozenset(["li"]),
    **dict.fromkeys(("dt", "dd"), frozenset(["dt", "dd"])),
    "tr": frozenset(["tr"]),
    **dict.fromkeys(("td", "th"), frozenset(["td", "th", "tr"])),
    "option": frozenset(["option"]),
    "head": frozenset(["body"]),
}
MAX_DEPTH = 200  # deeper elements have the path of the one above, so that paths stay short; what sets them aside counts all the same
SET_ASIDE = frozenset("head nav header footer aside form button select dialog menu".split()) | RAW
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie cookies disclaimer discussion "
    "footer header login masthead menu nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related reply "
    "replies share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
CONTENT_TAGS = ("article", "main")
CONTAINERS = frozenset("html body center div section table tbody tr td".split()) | frozenset(CONTENT_TAGS)


def host_of(url: Column) -> Column:
    """The host of a URL, lower case, without user and port; empty for none."""
    name = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(name)


@dataclass(slots=True)
class Run:
    """A run of text: the path of its node, whether it lies in a link or a set-aside node, and whether it begins a block."""

    path: str
    text: str
    link: bool
    aside: bool
    starts: bool


def set_aside(tag: str, attributes: str, path: str) -> bool:
    """Whether an element's tag or names mark it as something other than the article."""
    if tag in SET_ASIDE:
        return not (tag == "header" and "/article" in path)
    if tag in ("html", "body", *CONTENT_TAGS):
        return False
    names = " ".join(" ".join(found) for found in NAME.findall(attributes))
    return bool(ASIDE_WORDS.intersection(word.lower() for word in BREAK.split(names)))


def read_page(page: str | None) -> tuple[list[str], list[Run]]:
    """The tag tokens of a page, as paths from the root in page order, and its runs of text."""
    page = (page or "").removesuffix("<")
    tags: list[str] = []
    runs: list[Run] = []
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]  # tag, path, in a link, set aside
    at, fresh = 0, True

    def text(part: str) -> None:
        nonlocal fresh
        if part and not (fresh and part.isspace()):
            _, path, link, aside = stack[-1]
            runs.append(Run(path, entities.unescape(part), link, aside, fresh))
            fresh = False

    def block() -> int:
        """Where the innermost open block element stands."""
        return next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] not in INLINE)

    while at < len(page):
        found = MARKUP.search(page, at)
        text(page[at : found.start() if found else len(page)])
        if not found:
            break
        at = found.end()
        tag = (found.group(2) or "").lower()
        if not tag:
            continue
        if tag == "br" and not fresh:
            text(" ")
        fresh = fresh or tag not in INLINE
        if found.group(1):
            closed = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            if closed and (tag not in INLINE or closed > block()):
                del stack[closed:]
            continue
        while tag not in INLINE and tag in CLOSED_BY.get(stack[block()][0], ()):
            del stack[block() :]
        attributes = found.group(3) or ""
        _, path, link, aside = stack[-1]
        names = sorted({n for f in NAME.findall(attributes) for n in " ".join(f).split() if not n[-1:].isdigit()})
        if len(stack) < MAX_DEPTH:
            path = f"{path}/{'.'.join([tag, *names])}"
            tags.append(path)
        if tag in RAW:
            end = re.compile(f"</{tag}\\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.append((tag, path, link or tag == "a", aside or set_aside(tag, attributes, path)))
    return tags, runs


def blocks_of(runs: list[Run]) -> list[tuple[Run, str]]:
    """Runs joined into blocks, white space as single spaces: each block's first run and its text."""
    blocks: list[tuple[Run, list[str]]] = []
    for run in runs:
        if run.starts or not blocks:
            blocks.append((run, []))
        blocks[-1][1].append(run.text)
    joined = ((first, SPACE.sub(" ", "".join(parts)).strip()) for first, parts in blocks)
    return [(first, text) for first, text in joined if text]


def tag_of(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


def text_token(path: str, text: str) -> str:
    return f"{path}|{xxhash.xxh3_64_hexdigest(text)}"


TOKEN_SCHEMA = "host string, token string, pages long, vector long, place double, once boolean, chars long"


def token_rows(pages: DataFrame) -> DataFrame:
    """Per host and token: pages that have it, a hash of its occurrence vector, its mean place in a page, whether it stands
    at most once in each, and how much running text its node holds itself. ``pages`` has host and html."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in TOKEN_SCHEMA.split(", ")]
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.int64()]
        task, seen = TaskContext.get().partitionId(), 0
        table: dict[tuple[str, str], list] = {}

        def out() -> pa.RecordBatch:
            rows = [(*key, *values) for key, values in table.items()]
            table.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

        for host, page in rows_of(batches, "host", "html"):
            seen += 1
            tags, runs = read_page(page)
            found: dict[str, list] = {"": [1, 0, 0]}  # the page itself
            for place, tag in enumerate(tags):
                found.setdefault(tag, [0, place, 0])[0] += 1
            for run in runs:
                if not run.link and not run.aside:
                    found.setdefault(run.path, [0, len(tags), 0])[2] += len(run.text)
            for first, text in blocks_of(runs):
                found.setdefault(text_token(first.path, text), [0, len(tags), 0])[0] += 1
            for token, (count, place, chars) in found.items():
                row = table.setdefault((host, token), [0, 0, 0.0, True, 0])
                row[0] += 1
                row[1] ^= xxhash.xxh3_64_intdigest(f"{task} {seen} {count}") - (1 << 63)
                row[2] += place / max(1, len(tags))
                row[3] = row[3] and count == 1
                row[4] += chars
            if len(table) > 200_000:
                yield out()
        yield out()

    rows = pages.mapInArrow(gather, TOKEN_SCHEMA)
    return rows.groupBy("host", "token").agg(
        F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"), F.sum("place").alias("place"), F.min("once").alias("once"), F.sum("chars").alias("chars")
    )


TEMPLATE_SCHEMA = "host string, content string, skeleton array<string>, fixed array<string>"


def deduce_templates(tokens: DataFrame, support: int = 5, text_support: int = 20, share: float = 0.8, text_share: float = 0.95, class_size: int = 3) -> DataFrame:
    """Per host with a template: its content node, the order of its once-only tags, and its fixed text blocks."""

    def deduce(rows: pd.DataFrame) -> pd.DataFrame:
        host, pages = rows["host"].iloc[0], int(rows.loc[rows["token"] == "", "pages"].max())
        is_text = rows["token"].str.contains("|", regex=False)
        tags = rows[~is_text & (rows["token"] != "")]
        often = tags[tags["pages"] >= share * pages]
        classes = often.groupby("vector")["token"].transform("size")
        skeleton = often[often["once"] & (classes >= class_size)].assign(place=lambda t: t["place"] / t["pages"]).sort_values(["place", "token"])
        chars = dict(zip(tags["token"], tags["chars"], strict=True))
        total = sum(chars.values())
        content = ""
        for node in sorted(skeleton["token"], key=lambda p: (p.count("/"), p)):
            inside = sum(n for path, n in chars.items() if path == node or path.startswith(node + "/"))
            if total and inside >= share * total and node.startswith(content) and tag_of(node) in CONTAINERS:
                content = node
                if tag_of(node) in CONTENT_TAGS:  # what marks itself as the article is taken whole
                    break
        fixed = rows[is_text & (rows["pages"] >= max(text_support, text_share * pages))]["token"].tolist()
        return pd.DataFrame([{"host": host, "content": content, "skeleton": skeleton["token"].tolist(), "fixed": fixed}])

    sizes = tokens.where("token = ''").select("host", F.col("pages").alias("_pages")).where(F.col("_pages") >= support)
    kept = tokens.join(sizes, "host").where((F.col("chars") > 0) | (F.col("pages") >= share * F.col("_pages"))).drop("_pages")
    return kept.groupBy("host").applyInPandas(deduce, TEMPLATE_SCHEMA)


def in_order(tags: list[str], skeleton: list[str]) -> bool:
    """Whether the skeleton's tags that a page has come in the skeleton's order."""
    places = {tag: k for k, tag in enumerate(skeleton)}
    found = [places[t] for t in tags if t in places]
    return found == sorted(set(found))


def main_text(page: str | None, content: str | None = None, skeleton: list[str] | None = None, fixed: frozenset[str] = frozenset()) -> str:
    """The text in the slots below the content node; without a template that fits, all that no tag or name sets aside."""
    tags, runs = read_page(page)
    runs = [r for r in runs if not r.aside]
    if content and content in tags and in_order(tags, skeleton or []):
        runs = [r for r in runs if r.path == content or r.path.startswith(content + "/")]
    else:
        inside = [r for r in runs if any(f"/{tag}" in r.path for tag in CONTENT_TAGS)]
        runs = inside or runs
    blocks = blocks_of(runs)
    varying = [text for first, text in blocks if text_token(first.path, text) not in fixed]
    whole = [text for _, text in blocks]
    if sum(map(len, varying)) < 0.7 * sum(map(len, whole)):  # pages that are copies of each other have no other text
        varying = whole
    return "\n\n".join(varying)


def extract(pages: DataFrame, **options) -> DataFrame:
    """``pages`` (page_id, url, html) with their main text: page_id, url, text."""
    named = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    tokens = stored(token_rows(named.select("host", "html")), "tokens")
    templates = stored(deduce_templates(tokens, **options), "templates")

    @F.pandas_udf("string")
    def text_of(html: pd.Series, content: pd.Series, skeleton: pd.Series, fixed: pd.Series) -> pd.Series:
        sets: dict[str, frozenset[str]] = {}
        out = []
        for page, node, order, texts in zip(html, content, skeleton, fixed, strict=True):
            known = node is not None
            key = "\n".join(texts) if known else ""
            out.append(main_text(page, node, list(order) if known else None, sets.setdefault(key, frozenset(texts) if known else frozenset())))
        return pd.Series(out, dtype=object)

    # The planner sends the templates to all executors only if their files are small.
    both = named.join(templates, "host", "left")
    return both.select("page_id", "url", text_of("html", "content", "skeleton", "fixed").alias("text"))
