"""Main text of web pages by template deduction over each host's pages (op 9).

Tokens of a page are the paths of its elements (names with class and id, digits folded) and
its whole text blocks.  A token's occurrence vector says how often each page of the host
has it.  Tokens with equal vectors form an equivalence class; the vector is compared as
pages, occurrences and sums of one hash per (page, count), so it is aggregated map-side, no
host's pages ever meet in one task, and repeated pages count as often as they are there.

The class of tokens that every page has exactly once is the root of the host's template.
Other classes of tokens on most pages, but at least three, are its optional and repeated parts.
A text token has the path of the element that holds it, so a class is nested by itself.  It is
valid if it has two or more texts and is ordered: by their first places over all pages and by
their last ones, its texts come in the same order.  Texts of valid classes are template; all
other slots hold content, also a paragraph that pages share alone.  The root's article and main
elements are its main slots.

Templates, one small row per host, are written to scratch and joined back by host; the
planner broadcasts them by their true size.  The second pass extracts the blocks of the
page's main slots that are neither marked boilerplate (see ``markup``) nor template.  A page
without text in such slots uses its own article or main elements, or else all unmarked
blocks: no other slot is chosen over its neighbours.  If words of classes would mark all of
a page's text, they mark nothing there.

Edge cases: null or empty html gives empty text; a null url, or one without host, belongs to
the host of the empty name; pages of one-page hosts work by the same rules; template text is
deducted from two pages on, but never if it is all a page has, and never inside article and main
elements; repeated rows are extracted each; other columns are not read.  A ``br`` is white space in its block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import text_of
from touchline.llm.markup import MAIN_TAGS, blocks
from touchline.llm.urls import host_and_path
from touchline.scratch import spill

SUPPORT = 0.5
CLASS_TOKENS = 2
CLASS_PAGES = 3
_TOKENS = "host string, path string, text long, times long, chars long, vector long, place long"


def _hash(*parts: object) -> int:
    raw = "\0".join(map(str, parts)).encode()
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _is_main(path: str) -> bool:
    return path.rsplit("/", 1)[-1].split(".", 1)[0] in MAIN_TAGS


def _prefixes(path: str) -> Iterator[str]:
    at = len(path)
    while at > 0:
        yield path[:at]
        at = path.rfind("/", 0, at)


def page_tokens(pages: DataFrame) -> DataFrame:
    """From (row, host, html): one row per token of a page, with its part of the vector.

    ``text`` is null for an element path; ``chars`` is the unmarked text below the path and
    ``place`` the number of a text's first block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for row, host, page in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                found, opened = blocks(page)
                chars: dict[str, int] = {}
                texts: dict[int, list[int]] = {}
                for place, block in enumerate(found):
                    if not block.boiler:
                        for path in _prefixes(block.path):
                            chars[path] = chars.get(path, 0) + len(block.text)
                    key = _hash(block.path, block.text)
                    texts.setdefault(key, []).append(place)
                rows = [(p, None, n, chars.get(p, 0), None) for p, n in opened.items()]
                rows += [(None, t, len(at), 0, at[0]) for t, at in texts.items()]
                for path, text, times, below, place in rows:
                    values = (host, path, text, times, below, _hash(row, times), place)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            types = (pa.string(), pa.string(), *[pa.int64()] * 5)
            names = ["host", "path", "text", "times", "chars", "vector", "place"]
            arrays = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return pages.select("row", "host", "html").mapInArrow(run, _TOKENS)


def templates(pages: DataFrame) -> DataFrame:
    """Per host: mains (paths of main slots, null if none), constants (hashes of texts)."""
    low, high = F.col("vector").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("vector", 32)
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    vectors = (
        page_tokens(pages)
        .groupBy("host", "path", "text")
        .agg(
            F.count(F.lit(1)).alias("on_pages"),
            F.sum("times").alias("times"),
            F.sum("chars").alias("chars"),
            F.struct(F.sum(low).alias("low"), F.sum(high).alias("high")).alias("vector"),
            F.min("place").alias("first"),
            F.max("place").alias("last"),
        )
        .filter(F.col("path").isNotNull() | (F.col("on_pages") > 1))
    )
    tokens = spill(vectors.join(hosts.withColumnRenamed("host", "__host"), F.col("host") == F.col("__host")).drop("__host"), "html-tokens")
    often = tokens.filter((F.col("on_pages") > 1) & (F.col("on_pages") > SUPPORT * F.col("n_pages")))
    texts = often.filter(F.col("text").isNotNull())
    # Equivalence classes of texts: one row per host and vector; few, as each is on most pages.
    vector = ["host", "on_pages", "times", "vector"]
    places = F.sort_array(F.collect_list(F.struct("first", "last"))).alias("places")
    firsts = F.transform("places", lambda p: p["first"])
    lasts = F.transform("places", lambda p: p["last"])
    classes = texts.groupBy(*vector).agg(places)
    # What comes later on every page has a later first and a later last place.
    apart = (F.size(F.array_distinct(firsts)) == F.size("places")) & (
        F.size(F.array_distinct(lasts)) == F.size("places")
    )
    valid = (F.size("places") >= CLASS_TOKENS) & apart & (F.sort_array(lasts) == lasts)
    classes = spill(classes.filter(valid).select(*vector), "html-classes")
    everywhere = F.col("on_pages") == F.col("n_pages")
    paths = tokens.filter(F.col("path").isNotNull())
    slots = paths.filter(everywhere & (F.col("times") == F.col("n_pages")))
    last = F.element_at(F.split(F.element_at(F.split("path", "/"), -1), "[.]"), 1)
    named = slots.filter((F.col("chars") > 0) & last.isin(*MAIN_TAGS))
    main = named.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("mains"))
    enough = everywhere | (F.col("on_pages") >= CLASS_PAGES)
    constant = texts.filter(enough).join(classes, vector, "left_semi")
    constants = constant.groupBy("host").agg(F.sort_array(F.collect_set("text")).alias("constants"))
    return hosts.select("host").join(main, "host", "left").join(constants, "host", "left")


def _below(path: str, slot: str) -> bool:
    return path == slot or path.startswith(slot + "/")


def main_text(page: str, mains: list[str], constants: frozenset[int]) -> str:
    """The article's blocks of one page under its host's template."""
    every = blocks(page)[0]
    # Where no text is unmarked, words of classes mark nothing.
    found = [b for b in every if not b.boiler] or [b for b in every if b.worded]
    chosen = [b for b in found if any(_below(b.path, slot) for slot in mains)]
    if not chosen:
        # Without text in the template's main slots, the page's own elements decide first.
        chosen = [b for b in found if any(map(_is_main, _prefixes(b.path)))]
    if not chosen:
        chosen = [b for b in found if _hash(b.path, b.text) not in constants] or found
    return "\n".join(b.text for b in chosen)


def extracted(
    pages: DataFrame, html: str = "html", url: str = "url", id_column: str = "page_id"
) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    host, _ = host_and_path(F.col(url))
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        host.alias("host"),
        text_of(html).alias("html"),
    )
    row: Column = F.xxhash64("page_id", "url", "html")
    found = spill(templates(rows.withColumn("row", row)), "html-templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(page, mains or [], frozenset(constants or ()))
                for page, mains, constants in zip(
                    *(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    joined = rows.join(found.withColumnRenamed("host", "__host"), F.col("host") == F.col("__host"), "left")
    return joined.select("page_id", "url", "html", "mains", "constants").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
